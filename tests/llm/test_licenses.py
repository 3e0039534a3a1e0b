import re
from pathlib import Path

import duckdb

from pageloom.llm import licenses


def bigrams(text):
    words = re.sub(r"[\W_]+", " ", text.lower()).strip().split(" ")
    return {(a, b) for a, b in zip(words, words[1:])}


def brute(text):
    out = {}
    for p, body in enumerate(re.split(r"\n[ \t\r]*\n", text or "")):
        lines = body.split("\n")
        for n, unit in [(-1, body)] * (len(lines) > 1) + list(enumerate(lines)):
            own = bigrams(unit)
            best = []
            for name, template in licenses.TEMPLATES:
                other = bigrams(template)
                dice = 2 * len(own & other) / (len(own) + len(other))
                if dice >= licenses.DICE:
                    best.append((-dice, name))
            if best:
                out[p, n] = (min(best)[1], -min(best)[0])
    return out


def test_units_as_by_hand(spark):
    mit = [t for n, t in licenses.TEMPLATES if n == "MIT"][-1]
    texts = [
        "Released under the MIT License.", "some text\nLicensed under the Apache License, Version 2.0.\nmore", f"head\n\n{mit}\n\ntail",
        mit.replace("\n", " ").replace("Software", "Program", 2), "released   UNDER the (MIT) license", "License", "", None, "x " * 2_000,
        "This work is licensed under the GNU General Public License, version 3.", f"{mit} and then some",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "1 AS id", "'clash' AS license")
    got = {}
    for r in licenses.scan(docs).collect():
        got.setdefault(r["doc_id"], {})[r["paragraph"], r["line"]] = (r["license"], r["dice"])
    for k, text in enumerate(texts):
        assert got.get(k, {}) == brute(text), text
    assert (1, -1) in got[2]


def published(name):
    return (Path(licenses.__file__).parent / "texts" / name).read_text(encoding="utf-8")


def flowed(text):
    return "\n\n".join(" ".join(p.split()) for p in re.split(r"\n\s*\n", text))


MIT = [t for n, t in licenses.TEMPLATES if n == "MIT" and len(t) > 500][0].replace("conditions:\n", "conditions:\n\n").replace("of the Software.\nTHE", "of the Software.\n\nTHE")
GPL = [t for n, t in licenses.TEMPLATES if n == "GPL-3.0" and "free software:" in t][0].replace("later version. This", "later version.\n\nThis")
GPL += "\n\nYou should have received a copy of the GNU General Public License along with this program.  If not, see <https://www.gnu.org/licenses/>."
APACHE = [t for n, t in licenses.TEMPLATES if n == "Apache-2.0" and 300 < len(t) < 1000][0].replace("\n", " ")
APACHE = APACHE.replace("License. You may", "License.\nYou may").replace("LICENSE-2.0 Unless", "LICENSE-2.0\n\nUnless").replace("You may obtain a copy of the License at http", "You may obtain a copy of the License at\n\n    http")
MPL = ("This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not distributed with this\n"
       "file, You can obtain one at https://mozilla.org/MPL/2.0/.")
LAYOUTS = [
    ("MIT", f"MIT License\n\nCopyright (c) 2020 A. Writer\n\n{MIT}"), ("GPL-3.0", f"Name of the program\nCopyright (C) 2020 A. Writer\n\n{GPL}"),
    ("Apache-2.0", f"Copyright 2020 A. Writer\n\n{APACHE}"), ("MPL-2.0", MPL), ("MPL-2.0", flowed(MPL)), ("BSD-3-Clause", published("BSD")), ("MIT", "MIT License"),
    ("BSD-2-Clause", re.sub(r"(?s)3\. Neither.*?permission\.\n", "", published("BSD"))), ("GPL-2.0", GPL.replace("version 3", "version 2").replace("software:", "software;")),
    *[(name, published(file)) for name, file in [("Apache-2.0", "Apache-2.0"), ("GPL-2.0", "GPL-2"), ("GPL-3.0", "GPL-3"), ("LGPL-2.1", "LGPL-2.1"),
                                                 ("LGPL-3.0", "LGPL-3"), ("MPL-2.0", "MPL-2.0"), ("CC0-1.0", "CC0-1.0")]],
]


def test_published_layouts(spark):
    around = "A page of other things.\n\n{}\n\nThat was all, and here goes on what has nothing to do with it."
    two = f"{LAYOUTS[0][1]}\n\nThe other part\n\n{MIT}\n\nIt ends."
    texts = [t for _, t in LAYOUTS] + [flowed(t) for _, t in LAYOUTS] + [around.format(t) for _, t in LAYOUTS] + [two, MIT.split("\n\n")[0], None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = [tuple(r) for r in licenses.scan(docs).collect()]
    found = {}
    for d, p, line, name, dice in rows:
        found.setdefault(d, []).append((name, p, line, dice))
    for k, text in enumerate(texts[: 3 * len(LAYOUTS)]):
        name = LAYOUTS[k % len(LAYOUTS)][0]
        assert {n for n, *_ in found.get(k, [])} == {name}, (name, found.get(k), text[:200])
        if len(text) > 5_000:  # the whole of it, not some notice at its end
            parts = len(re.split(licenses.PARTED, text))
            assert any(-line > parts / 2 for _, _, line, _ in found[k]), found[k]
    k = 3 * len(LAYOUTS)
    assert sorted((p, line) for n, p, line, _ in found[k] if line < -1) == [(2, -3), (6, -3)] and not found.keys() & {k + 1, k + 2, k + 3}
    con = duckdb.connect()
    con.execute("CREATE TABLE documents AS SELECT unnest(range(?)) AS doc_id, unnest(?) AS text", [len(texts), texts])
    want = con.sql(licenses._oracle()).fetchall()
    assert sorted((*r[:4], round(r[4], 9)) for r in rows) == sorted((*r[:4], round(r[4], 9)) for r in want)


def test_odd_rows(spark, odd_docs, empty_docs):
    assert licenses.scan(odd_docs).collect() == []
    assert licenses.scan(empty_docs).collect() == []


def test_no_python_in_the_plan(spark, sf):
    plan = licenses.op3_licenses(spark, sf)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "ArrowEval", "MapInArrow"))


def test_texts_of_one_id_do_not_add_up(spark):
    text = "This work is licensed under the GNU Lesser General Public License, version 3."
    words = text.split()
    halves = [" ".join(words[:7] + ["x"] * 5), " ".join(["y"] * 6 + words[6:])]
    docs = spark.createDataFrame([(1, halves[0]), (1, halves[1]), (2, text), (2, halves[0]), (2, text)], "doc_id long, text string")
    assert all(not brute(h) for h in halves)
    assert [tuple(r) for r in licenses.scan(docs).collect()] == [(2, 0, 0, "LGPL-3.0", 1.0)]


def test_words_are_made_once(spark, sf):
    plan = licenses.op3_licenses(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") <= 12 and "Python" not in plan
