"""License scans by Dice coefficient over word bigrams, in DataFrame functions only.

A text's lines and its paragraphs of several lines are normalised to lower-case words. A unit
is compared only with the templates whose number of bigrams allows the coefficient that is asked
for; shared bigrams are counted by a join with the templates, a table of fixed size.

Long templates are compared with runs of paragraphs, too, and with whole texts. A paragraph at
either end of a run can only raise the coefficient if it shares about half as much of its bigrams,
so runs go from the first to the last of neighbouring paragraphs that do, or over several such stretches.

A unit that lacks all of some words of a short template, or too many words of a long one, lacks too
many of its bigrams, so texts and units are searched for these words first. No match is lost by that.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.llm.registry import query, table

#: The least Dice coefficient of a match.
DICE = 0.8
#: Bigrams of a template that is compared with runs of paragraphs.
LONG = 30
#: Where paragraphs are parted.
PARTED = r"\n[ \t\r]*\n"
#: Fixed value: words too common to search for.
COMMON = frozenset(
    "a all an and any are as at be but by can for from has have how if in is it its may more no not of on one only or other out such than that the their them "
    "then there these they this to under use used was were what when where which will with without work you your 0 1 2 3 4 5 6 7 8 9".split())


def _full(name: str) -> str:
    """A licence text as published, up to the end of its terms."""
    return re.split(r"\n *END OF TERMS AND CONDITIONS", (Path(__file__).parent / "texts" / name).read_text(encoding="utf-8"))[0]


def _affero(text: str) -> str:
    """The Affero licence, which differs by its name and its section 13."""
    text = re.sub(r"(?i)\bGNU(\s+)(General\s+Public\s+License)", r"GNU\1Affero \2", text)
    return re.sub(r"(?s)  13\. Use with.*?(?=\n  14\.)", """  13. Remote Network Interaction; Use with the GNU General Public License.

  Notwithstanding any other provision of this License, if you modify the Program, your modified version must prominently offer all users interacting with it
remotely through a computer network (if your version supports such interaction) an opportunity to receive the Corresponding Source of your version by providing
access to the Corresponding Source from a network server at no charge, through some standard or customary means of facilitating copying of software. This
Corresponding Source shall include the Corresponding Source for any work covered by version 3 of the GNU General Public License that is incorporated pursuant to
the following paragraph.

  Notwithstanding any other provision of this License, you have permission to link or combine any covered work with a work licensed under version 3 of the GNU
General Public License into a single combined work, and to convey the resulting work. The terms of this License will continue to apply to the part which is the
covered work, but the work with which it is combined will remain governed by version 3 of the GNU General Public License.
""", text)


def _notice(what: str, name: str, version: str) -> str:
    """The notice that is put into the files of a program."""
    return f"""This {what} is free software; you can redistribute it and/or modify it under the terms of the GNU {name} as published by the Free Software
Foundation; either version {version} of the License, or (at your option) any later version.

This {what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A
PARTICULAR PURPOSE. See the GNU {name} for more details."""


_BSD = _full("BSD").split("All rights reserved.")[1].replace("THE REGENTS AND CONTRIBUTORS", "THE COPYRIGHT HOLDERS AND CONTRIBUTORS").replace(
    "THE REGENTS OR CONTRIBUTORS", "THE COPYRIGHT HOLDER OR CONTRIBUTORS").replace("the University", "the copyright holder")

#: Texts and notices of public licences, by identifier.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "MIT License"),
    ("MIT", "The MIT License"),
    ("MIT", "The MIT License (MIT)"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files
(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute,
sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS
FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER
IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the
above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD
TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS
ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.
You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for
the specific language governing permissions and limitations under the License."""),
    ("GPL-3.0", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be
useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License
for more details."""),
    ("MPL-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file,
You can obtain one at https://mozilla.org/MPL/2.0/."""),
    ("GPL-2.0", _notice("program", "General Public License", "2")),
    ("LGPL-2.1", _notice("library", "Lesser General Public License", "2.1")),
    ("LGPL-3.0", _notice("program", "Lesser General Public License", "3")),
    ("AGPL-3.0", _notice("program", "Affero General Public License", "3")),
    ("BSD-3-Clause", _BSD),
    ("BSD-2-Clause", _BSD[: _BSD.index("3. Neither")] + _BSD[_BSD.index("THIS SOFTWARE") :]),
    ("Apache-2.0", _full("Apache-2.0")),
    ("GPL-2.0", _full("GPL-2")),
    ("GPL-3.0", _full("GPL-3")),
    ("AGPL-3.0", _affero(_full("GPL-3"))),
    ("LGPL-2.1", _full("LGPL-2.1")),
    ("LGPL-3.0", _full("LGPL-3")),
    ("MPL-2.0", _full("MPL-2.0")),
    ("CC0-1.0", _full("CC0-1.0")),
)


def _words(text: Column) -> Column:
    """The words in lower case and without signs."""
    return F.split(F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " ")), " ")


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of one value, which is computed once however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _once(rows: DataFrame, value: Column, name: str) -> DataFrame:
    """``rows`` with a column that is computed once for each row; later filters on it are not worked into it."""
    return rows.select("*", F.explode(F.array(value)).alias(name))


def _bigrams(text: Column) -> Column:
    """The distinct pairs of neighbouring words."""
    def pairs(words: Column) -> Column:
        firsts = F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0)))
        return F.array_distinct(F.zip_with(firsts, F.slice(words, 2, F.size(words)), lambda a, b: F.concat_ws(" ", a, b)))

    return _bound(_words(text), pairs)


def _needed(size: int, dice: float) -> int:
    """Bigrams of a template that a unit must share for the coefficient to be possible."""
    return max(1, math.ceil(size * dice / (2.0 - dice) - 1e-9))


def _signal(pairs: list[str], dice: float) -> set[str]:
    """Words of which a unit must hold one to be like a template: without them too many of its bigrams are missing."""
    of = defaultdict(set)
    for pair in pairs:
        for word in pair.split(" "):
            of[word].add(pair)
    chosen, touched = set(), set()
    while len(touched) <= len(pairs) - _needed(len(pairs), dice):
        word = max(sorted(of.keys() - chosen), key=lambda w: len(of[w] - touched) / (50 if w in COMMON else 1))
        chosen.add(word)
        touched |= of[word]
    return chosen


def _holding(words: set[str]) -> str:
    """A pattern of lower-case texts that hold one of the words; it may find more, as it knows fewer letters than the words have."""
    return "(?<![a-z0-9])(?:" + "|".join(sorted(map(re.escape, words))) + ")(?![a-z0-9])"


def _vocabulary(pairs: list[str], dice: float) -> tuple[list[str], int]:
    """The words of a long template that are not common, and how many of them a unit must hold.

    A bigram is missing if one of its words is, so a missing word costs half of each bigram that it forms with
    another word of the list, and all of each with a common one.
    """
    cost = defaultdict(float)
    for pair in pairs:
        rare = set(pair.split(" ")) - COMMON
        for word in rare:
            cost[word] += 1.0 / len(rare)
    spare, held = len(pairs) - _needed(len(pairs), dice), len(cost)
    for c in sorted(cost.values()):
        spare -= c
        if spare < -1e-9:
            break
        held -= 1
    return sorted(cost), held


def _shared(unit: Column, pairs: Column) -> Column:
    return F.size(F.array_intersect(unit, pairs))


def _runs(docs: DataFrame, long: DataFrame, dice: float) -> DataFrame:
    """The runs of paragraphs of each (id, text, words) that are like a template, as units with the number of paragraphs, negative, for a line.

    Of runs that overlap, and are like templates of similar size, the best counts, and the shortest and first of equals;
    one that holds a paragraph or line that is no less like the template does not count.
    """
    docs = _once(docs.withColumn("ps", F.split("text", PARTED)).where(F.size("ps") > 1).withColumn("key", F.sha2("text", 256)), _bigrams(F.col("text")), "of_text")
    # what a paragraph is made of does not depend on the template
    docs = _once(docs, F.transform("ps", _bigrams), "own")
    count = F.transform("ps", lambda p: F.size(F.filter(_words(p), lambda w: w != "")))
    docs = _once(docs.drop("text"), F.aggregate(count, F.array(F.lit(0)), lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n))), "upto")
    met = docs.join(F.broadcast(long), F.size(F.array_intersect("vocabulary", "words")) >= F.col("held")).drop("words")
    met = met.where(_shared(F.col("of_text"), F.col("pairs")) >= F.col("need")).drop("of_text").dropDuplicates(["id", "key", "nth"])
    members = F.transform("own", lambda b: (F.size(b) > 0) & (_shared(b, F.col("pairs")) >= F.size(b) * F.lit(dice / 2)))
    met = _once(met, members, "member").drop("own")

    def member(i: Column) -> Column:
        return F.coalesce(F.get("member", i), F.lit(False))

    last = F.size("ps") - 1
    at = F.sequence(F.lit(0), last)
    met = met.withColumn("begin", F.filter(at, lambda i: member(i) & ~member(i - 1))).withColumn("end", F.filter(at, lambda i: member(i) & ~member(i + 1)))

    def fits(a: Column, b: Column) -> Column:
        held = F.get("upto", b + 1) - F.get("upto", a) - 1
        return (b > a) & (held >= F.col("need")) & (held <= F.col("most"))

    found = F.flatten(F.transform("begin", lambda a: F.transform(F.filter("end", lambda b: fits(a, b)), lambda b: F.struct(a.alias("a"), b.alias("b")))))
    whole = F.filter(F.array(F.struct(F.lit(0).alias("a"), last.alias("b"))), lambda r: fits(r["a"], r["b"]))
    met = met.withColumn("r", F.explode(F.array_distinct(F.concat(found, whole)))).select("*", "r.a", "r.b")
    met = met.withColumn("ps", F.slice("ps", F.col("a") + 1, F.col("b") - F.col("a") + 1))
    met = _once(met, _bigrams(F.array_join("ps", "\n\n")), "run")

    def alike(pairs: Column) -> Column:
        return F.lit(2.0) * _shared(pairs, F.col("pairs")) / (F.size(pairs) + F.col("size"))

    met = _once(met, alike(F.col("run")), "dice").where(F.col("dice") >= dice)
    units = F.concat(F.col("ps"), F.split(F.array_join("ps", "\n"), "\n"))
    met = _once(met, F.array_max(F.transform(units, lambda u: _bound(_bigrams(u), alike))), "best_unit").where(F.col("dice") > F.col("best_unit"))
    met = met.groupBy("id", "key").agg(F.collect_list(F.struct((-F.col("dice")).alias("less"), (F.col("b") - F.col("a") + 1).alias("k"), "a", "license", "nth", "b", "size")).alias("all"))
    best = F.filter("all", lambda x: ~F.exists("all", lambda y: (y < x) & (y["a"] <= x["b"]) & (y["b"] >= x["a"]) & (y["size"] * 2 >= x["size"])))
    return met.select("id", F.explode(best).alias("x")).select("id", F.col("x.a").alias("paragraph"), (-F.col("x.k")).alias("line"), "x.license", (-F.col("x.less")).alias("dice")).distinct()


def scan(docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, dice: float = DICE, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """(id, paragraph, line, license, dice) of every unit of a text that is like a template.

    Paragraphs are parted by empty lines and counted from 0, lines within them too; ``line``
    is -1 for a paragraph of several lines as a whole, and -k for a run of k paragraphs from that one on. Of several templates the best one counts,
    of equally good ones the first license by name. A null or empty text, and a unit of one word, is like none. Rows that repeat
    an id give their matches once; of several texts of one id the best match of a place counts. Other columns, whatever their names, are left out.
    """
    spark = docs.sparkSession
    known = spark.createDataFrame([(k, n, t) for k, (n, t) in enumerate(templates)], "nth int, license string, body string")
    known = known.select("nth", "license", _bigrams(F.col("body")).alias("pairs"), F.size(_words(F.col("body"))).alias("words")).collect()
    least, most = dice / (2.0 - dice), (2.0 - dice) / dice  # of a unit's bigrams to a template's, for the coefficient to be possible
    known = [r for r in known if r["pairs"]]
    sizes = [len(r["pairs"]) for r in known] or [0]
    low, high = max(1, math.floor(min(sizes) * least)), math.ceil(max(sizes) * most)
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    short, long = [r for r in known if len(r["pairs"]) < LONG], [r for r in known if len(r["pairs"]) >= LONG]
    short_signal = F.lit(False) if not short else F.lower("text").rlike(_holding(set().union(*(_signal(r["pairs"], dice) for r in short))))
    rows = [(r["nth"], r["license"], r["pairs"], len(r["pairs"]), _needed(len(r["pairs"]), dice), math.ceil((r["words"] - 1) * most),
             *_vocabulary(r["pairs"], dice)) for r in long]
    need = min((r[4] for r in rows), default=high + 1)
    vocabulary = F.array(*[F.lit(w) for w in sorted(set().union(*(r[6] for r in rows)))]).cast("array<string>")
    docs = _once(docs, F.array_distinct(_words(F.col("text"))), "words")
    docs = _once(docs, _shared(vocabulary, F.col("words")) >= min((r[7] for r in rows), default=0), "legal")
    legal = docs.where("legal").select("id", "text", "words")
    runs = _runs(legal, spark.createDataFrame(rows, "nth int, license string, pairs array<string>, size int, need int, most int, vocabulary array<string>, held int"), dice)
    known = spark.createDataFrame([(r["nth"], r["license"], r["pairs"], len(r["pairs"])) for r in known], "nth int, license string, pairs array<string>, size int")
    known = known.select("nth", "license", "size", F.explode("pairs").alias("pair"))
    # texts of one id are told apart: what two of them share with a template does not add up
    paragraphs = docs.where(short_signal | F.col("legal")).select("id", F.xxhash64("text").alias("key"), "legal", F.posexplode(F.split("text", PARTED)).alias("paragraph", "body"))
    lines = F.split("body", "\n")
    whole = F.when(F.size(lines) > 1, F.array(F.struct(F.lit(-1).alias("line"), F.col("body").alias("unit"))))
    none = F.array().cast("array<struct<line:int,unit:string>>")
    units = paragraphs.select("id", "key", "legal", "paragraph", F.explode(F.concat(
        F.coalesce(whole, none), F.transform(lines, lambda x, i: F.struct(i.alias("line"), x.alias("unit"))))).alias("u"))
    # a bigram takes three characters at least
    units = units.select("id", "key", "legal", "paragraph", "u.line", F.col("u.unit").alias("text")).where(F.length("text") >= F.lit(3))
    # a bigram more takes a word of one character and a sign at least
    units = units.where(short_signal | (F.col("legal") & (F.length("text") > 2 * need)))
    units = _once(units, _bigrams(F.col("text")), "pairs").select("id", "key", "paragraph", "line", "pairs", F.size("pairs").alias("n")).where(F.col("n").between(low, high))
    pairs = units.select("id", "key", "paragraph", "line", "n", F.explode("pairs").alias("pair"))
    met = pairs.join(F.broadcast(known), "pair").where((F.col("n") >= F.col("size") * least - 1e-9) & (F.col("n") <= F.col("size") * most + 1e-9))
    shared = met.groupBy("id", "key", "paragraph", "line", "n", "nth", "license", "size").agg(F.countDistinct("pair").alias("shared"))
    alike = shared.withColumn("dice", F.lit(2.0) * F.col("shared") / (F.col("n") + F.col("size"))).where(F.col("dice") >= dice)
    best = alike.groupBy("id", "paragraph", "line").agg(F.min(F.struct((-F.col("dice")).alias("less"), "license")).alias("b"))
    best = best.select("id", "paragraph", "line", "b.license", (-F.col("b.less")).alias("dice")).union(runs)
    return best.select(F.col("id").alias(id_col), F.col("paragraph").cast("long"), F.col("line").cast("long"), "license", "dice")


def _oracle() -> str:
    quoted = ", ".join("(%d, '%s', '%s')" % (k, n, t.replace("'", "''")) for k, (n, t) in enumerate(TEMPLATES))
    words = "string_split(trim(regexp_replace(lower({0}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')), ' ')"
    return f"""
    WITH tw AS (SELECT nth, license, {words.format('body')} AS w FROM (VALUES {quoted}) v(nth, license, body)),
    tp AS (SELECT nth, license, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS pairs FROM tw),
    p AS (SELECT row_id, doc_id, generate_subscripts(ps, 1) - 1 AS paragraph, unnest(ps) AS body FROM (
        SELECT row_number() OVER () AS row_id, doc_id, string_split_regex(text, '\\n[ \\t\\r]*\\n') AS ps FROM documents WHERE text IS NOT NULL)),
    l AS (SELECT row_id, doc_id, paragraph, body, string_split(body, chr(10)) AS ls FROM p),
    u AS (SELECT row_id, doc_id, paragraph, generate_subscripts(ls, 1) - 1 AS line, unnest(ls) AS unit FROM l
        UNION ALL SELECT row_id, doc_id, paragraph, -1, body FROM l WHERE len(ls) > 1),
    uw AS (SELECT row_id, doc_id, paragraph, line, {words.format('unit')} AS w FROM u WHERE length(unit) >= 3),
    up AS (SELECT row_id, doc_id, paragraph, line, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS pairs FROM uw),
    ux AS (SELECT row_id, doc_id, paragraph, line, len(pairs) AS n, unnest(pairs) AS pair FROM up WHERE len(pairs) >= 1),
    tx AS (SELECT nth, license, len(pairs) AS size, unnest(pairs) AS pair FROM tp),
    s AS (SELECT row_id, doc_id, paragraph, line, license, 2.0::DOUBLE * count(*) / (n + size) AS dice FROM ux JOIN tx USING (pair)
        GROUP BY row_id, doc_id, paragraph, line, n, nth, license, size),
    b AS (SELECT doc_id, paragraph, line, min({{'less': -dice, 'license': license}}) AS b FROM s WHERE dice >= {DICE} GROUP BY doc_id, paragraph, line)
    {_runs_oracle()}
    SELECT doc_id, paragraph::BIGINT AS paragraph, line::BIGINT AS line, b.license AS license, -b.less AS dice FROM b
    UNION ALL SELECT DISTINCT doc_id, a::BIGINT, -k::BIGINT, license, dice FROM rbest"""


def _runs_oracle() -> str:
    """The runs of paragraphs, from all whole texts that share enough bigrams with a long template."""
    words = "string_split(trim(regexp_replace(lower({0}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')), ' ')"
    pairs = "list_distinct(list_transform(range(1, len({0})), lambda i: {0}[i] || ' ' || {0}[i + 1]))"
    least, most = DICE / (2.0 - DICE), (2.0 - DICE) / DICE
    return f""",
    tl AS (SELECT nth, license, pairs AS tps, len(pairs) AS size, ceil(len(pairs) * {least!r}::DOUBLE - 1e-9) AS need, ceil((len(w) - 1) * {most!r}::DOUBLE) AS most
        FROM tp JOIN tw USING (nth, license) WHERE len(pairs) >= {LONG}),
    d AS (SELECT row_number() OVER () AS row_id, doc_id, string_split_regex(text, '\\n[ \\t\\r]*\\n') AS ps, {words.format('text')} AS w FROM documents WHERE text IS NOT NULL),
    dx AS (SELECT row_id, unnest({pairs.format('w')}) AS pair FROM d WHERE len(ps) > 1),
    c AS (SELECT row_id, nth FROM dx JOIN tx USING (pair) JOIN tl USING (nth) GROUP BY row_id, nth, need HAVING count(*) >= need),
    pp AS (SELECT row_id, nth, generate_subscripts(ps, 1) - 1 AS i, unnest(ps) AS body FROM c JOIN d USING (row_id)),
    pw AS (SELECT row_id, nth, i, {words.format('body')} AS w FROM pp),
    pm AS (SELECT row_id, nth, i, len(list_filter(w, lambda x: x <> '')) AS words, {pairs.format('w')} AS own FROM pw),
    pk AS (SELECT row_id, nth, i, words, len(own) > 0 AND len(list_intersect(own, tps)) >= len(own) * {DICE / 2!r}::DOUBLE AS member FROM pm JOIN tl USING (nth)),
    pe AS (SELECT row_id, nth, i, member, sum(words) OVER o AS upto, sum(words) OVER o - words AS before, coalesce(lag(member) OVER o, false) AS m0,
        coalesce(lead(member) OVER o, false) AS m1, count(*) OVER (PARTITION BY row_id, nth) AS n FROM pk WINDOW o AS (PARTITION BY row_id, nth ORDER BY i)),
    ab AS (SELECT x.row_id, x.nth, x.i AS a, y.i AS b FROM pe x JOIN pe y ON x.row_id = y.row_id AND x.nth = y.nth AND y.i > x.i JOIN tl ON tl.nth = x.nth
        WHERE ((x.member AND NOT x.m0 AND y.member AND NOT y.m1) OR (x.i = 0 AND y.i = y.n - 1)) AND y.upto - x.before - 1 BETWEEN need AND most),
    r AS (SELECT row_id, doc_id, nth, license, tps, size, a, b, ps[a + 1 : b + 1] AS ps FROM ab JOIN d USING (row_id) JOIN tl USING (nth)),
    ru AS (SELECT row_id, nth, a, b, tps, size, true AS whole, array_to_string(ps, chr(10) || chr(10)) AS unit FROM r
        UNION ALL SELECT row_id, nth, a, b, tps, size, false, unnest(list_concat(ps, string_split(array_to_string(ps, chr(10)), chr(10)))) FROM r),
    rw AS (SELECT row_id, nth, a, b, tps, size, whole, {words.format('unit')} AS w FROM ru),
    rp AS (SELECT row_id, nth, a, b, tps, size, whole, {pairs.format('w')} AS own FROM rw),
    rd AS (SELECT row_id, nth, a, b, size, whole, 2.0::DOUBLE * len(list_intersect(own, tps)) / (len(own) + size) AS dice FROM rp),
    rr AS (SELECT row_id, nth, a, b, b - a + 1 AS k, size, max(dice) FILTER (whole) AS dice FROM rd GROUP BY row_id, nth, a, b, size
        HAVING max(dice) FILTER (whole) >= {DICE} AND max(dice) FILTER (whole) > max(dice) FILTER (NOT whole)),
    rl AS (SELECT rr.*, license, doc_id FROM rr JOIN tl USING (nth) JOIN d USING (row_id)),
    rbest AS (SELECT * FROM rl x WHERE NOT EXISTS (SELECT 1 FROM rl y WHERE y.row_id = x.row_id AND y.a <= x.b AND y.b >= x.a AND y.size * 2 >= x.size
        AND (-y.dice, y.k, y.a, y.license, y.nth) < (-x.dice, x.k, x.a, x.license, x.nth)))"""


@query("op3_licenses", _oracle())
def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line or paragraph of every document that is like a licence."""
    return scan(table(spark, sf_dir, "documents"))
