"""Secret scans over an incremental ledger of blobs, in DataFrame functions only.

Every version of every path is content-addressed. Only pairs of a blob and a rule version
that the ledger does not hold are scanned, and findings go back to all paths by their blob.

Splitting a text at a pattern gives the stretches between its matches, so the lengths of
stretches and matches add up to the places of the matches; no position function is needed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pageloom.llm.registry import query, table


@dataclass(frozen=True)
class Rule:
    """One kind of secret. A match counts if ``group`` of it has ``least`` characters.

    A new ``version`` makes blobs be scanned again for this rule alone. ``plain`` is the pattern
    for engines that never go back, without possessive loops.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    version: int = 1
    plain: str = ""


def _any_case(words: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words)


#: The base kinds, in the order in which spans with one start are listed.
BASE = (
    Rule("assign", "(" + _any_case("password|passwd|secret|token|api_?key") + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", "AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", "[0-9a-f]+", 0, 32),
)
def _pem(more: str) -> str:
    """A private key from its first marker to its last; without that to the end of its lines, of which the first has 20 characters at least.

    ``more`` stands behind every loop: a plus makes loops possessive, so that a key of any length takes a constant stack.
    Each loop ends where nothing in it fits, so giving nothing back loses no match.
    """
    sign = "[A-Za-z0-9+/=]"
    ended = "(?!-)" if more else ""
    whole = f"[^-]*{more}(?:-{{1,4}}{more}{ended}[^-]+{more})*{more}-----END [A-Z ]*PRIVATE KEY-----"
    heads = rf"(?:\s*{more}[A-Za-z-]+{more}:\x20[^\n]*{more})*{more}"
    lines = rf"[\s\\]*{more}{sign}{{20}}{sign}*{more}(?:\x20{sign}{{20}}{sign}*{more})*{more}(?:[\x20\t\r]*{more}[\n\\][\s\\]*{more}{sign}+{more})*{more}"
    return f"-----BEGIN [A-Z ]*PRIVATE KEY-----(?:{whole}|{heads}{lines}|)"


#: Kinds beyond the base, listed after it.
MORE = (
    Rule("private_key", _pem("+"), version=3, plain=_pem("")),
    Rule("github", "gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
)
RULES = BASE + MORE


def blob_of(text: Column) -> Column:
    """The address of a content; a null text has that of the empty one."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def _apart() -> Column:
    """A part of the blob to group by beside it, so that the join back to the paths has exchanges that can be split."""
    return F.substring("blob", 1, 1).alias("apart")


def _screen(rule: Rule) -> str:
    """A pattern that a text with a match that counts must hold, so that most texts are read once."""
    if rule.group or rule.least == 1:
        return rule.pattern
    fixed = len(rule.pattern.split("[")[0])  # a run is matched whole, so its length decides
    return rule.pattern[:-1] + "{%d,}" % (rule.least - fixed)


def _listed(rules: tuple[Rule, ...]) -> Column:
    """The rules as an array of structs."""
    return F.array(*[
        F.struct(F.lit(_name(r)).alias("rule"), F.lit(k).alias("order"), F.lit(r.kind).alias("kind"), F.lit(r.pattern).alias("pattern"),
                 F.lit(_screen(r)).alias("screen"), F.lit(r.group).alias("part"), F.lit(r.least).alias("least"))
        for k, r in enumerate(rules)
    ])


def _name(rule: Rule) -> str:
    return f"{rule.kind}@{rule.version}"


def scan(versions: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES,
         text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Findings and ledger entries of what the ledger does not hold yet.

    ``versions`` has one row per version of a path; only ``text_col`` is read. ``ledger``
    has (blob, rule) of earlier scans. Returns findings (blob, kind, order, start, end),
    code points with an exclusive end, and the new entries (blob, rule) to append to the
    ledger once the findings are stored. Null texts count as empty; equal texts are one
    blob however many paths have them; an empty table gives empty results.
    """
    content = versions.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    blobs = content.withColumn("blob", blob_of(F.col("text"))).groupBy("blob", _apart()).agg(F.first("text").alias("text"))
    todo = _listed(rules)
    if ledger is not None:
        done = ledger.groupBy("blob").agg(F.collect_set("rule").alias("done"))
        blobs = blobs.join(done, "blob", "left")
        todo = F.filter(todo, lambda r: ~F.coalesce(F.array_contains("done", r["rule"]), F.lit(False)))
    pairs = blobs.select("blob", "text", F.explode(todo).alias("r")).select("blob", "text", "r.*")
    gap = F.split("text", F.col("pattern"), -1)
    hit = F.regexp_extract_all("text", F.col("pattern"), F.lit(0))
    value = F.regexp_extract_all("text", F.col("pattern"), F.col("part"))
    matched = pairs.where(F.expr("text RLIKE screen")).select(
        "blob", "order", "kind", "least", F.posexplode(F.arrays_zip(gap.alias("gap"), hit.alias("hit"), value.alias("value"))).alias("nth", "m"))
    rows = matched.where(F.col("m.hit").isNotNull()).select(
        "blob", "order", "kind", "nth", F.length("m.gap").cast("long").alias("gap"), F.length("m.hit").cast("long").alias("size"),
        (F.length("m.value") >= F.col("least")).alias("good"))
    so_far = Window.partitionBy("blob", "order").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    findings = rows.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(so_far)).where("good").select(
        "blob", "kind", "order", (F.col("end") - F.col("size")).alias("start"), "end")
    return findings, pairs.select("blob", "rule")


def by_path(paths: DataFrame, findings: DataFrame) -> DataFrame:
    """``paths`` (with its ``blob``) and ``secrets``: all findings of its content, in order.

    A content that very many paths share makes its key a hot one; the left side of this
    join is then split by adaptive execution, and its findings are one row.
    """
    listed = findings.groupBy("blob", _apart()).agg(
        F.sort_array(F.collect_list(F.struct("start", "order", "kind", "end"))).alias("secrets")).drop("apart")
    none = F.array().cast("array<struct<start:bigint,order:int,kind:string,end:bigint>>")
    return paths.join(listed, "blob", "left").withColumn("secrets", F.coalesce("secrets", none))


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by a mark, and ``n_chars`` counted anew.

    Secrets that overlap become one mark. A null text stays null; other columns stay as they are.
    """
    findings, _ = scan(docs, None, rules)
    ahead = Window.partitionBy("blob").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("blob").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, 0)
    fresh = (F.col("start") >= F.coalesce(F.max("end").over(ahead), F.lit(-1))).cast("int")
    islands = findings.withColumn("fresh", fresh).withColumn("island", F.sum("fresh").over(upto))
    islands = islands.groupBy("blob", "island").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    cuts = islands.groupBy("blob", _apart()).agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("cuts")).drop("apart")
    # the rows go through the join under names of their own
    held = {c: f"c{k}" for k, c in enumerate(docs.columns)}
    joined = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in held.items()], blob_of(F.col("text")).alias("blob")).join(cuts, "blob", "left")
    old = F.col(held["text"])
    before = F.transform(
        "cuts",
        lambda c, i: F.concat(
            F.substring(old, F.when(i == 0, F.lit(0)).otherwise(F.element_at("cuts", F.greatest(i, F.lit(1)))["end"]).cast("int") + 1,
                        (c["start"] - F.when(i == 0, F.lit(0)).otherwise(F.element_at("cuts", F.greatest(i, F.lit(1)))["end"])).cast("int")),
            F.lit(mark),
        ),
    )
    tail = F.substring(old, F.element_at("cuts", -1)["end"].cast("int") + 1, F.length(old))
    text = F.when(F.col("cuts").isNull(), old).otherwise(F.concat(F.array_join(before, ""), tail))
    out = {c: F.col(n) for c, n in held.items()} | {"text": text}
    if "n_chars" in held:
        out["n_chars"] = F.when(F.col("cuts").isNull(), out["n_chars"]).otherwise(F.length(text).cast("long"))
    return joined.select(*[column.alias(c) for c, column in out.items()])


def digest(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, a hash of the base spans, and all spans as text."""
    def count(kind: str) -> Column:
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def listed(secrets: Column) -> Column:
        return F.array_join(F.transform(secrets, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("secrets", lambda s: s["order"] < len(BASE))
    return found.select("doc_id", *[count(r.kind) for r in BASE], F.sha2(listed(base), 256).alias("base_sha256"),
                        listed(F.col("secrets")).alias("spans"))


def _oracle() -> str:
    """The same rows in DuckDB SQL, straight from the texts of all documents."""
    kinds = " UNION ALL ".join(
        f"""SELECT row_id, {k} AS o, '{r.kind}' AS kind, generate_subscripts(hit, 1) AS nth, unnest(hit) AS h, unnest(gap[:len(hit)]) AS g,
        unnest(value) AS v, {r.least} AS least FROM (SELECT row_id, regexp_extract_all(text, p, 0) AS hit, string_split_regex(text, p) AS gap,
        regexp_extract_all(text, p, {r.group}) AS value FROM (SELECT row_id, text, '{(r.plain or r.pattern).replace("'", "''")}' AS p FROM t))"""
        for k, r in enumerate(RULES))
    counts = ", ".join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in BASE)
    span = "kind || ':' || (e - length(h)) || ':' || e"
    return f"""
    WITH t AS (SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS text FROM documents),
    m AS ({kinds}),
    s AS (SELECT *, sum(length(g) + length(h)) OVER (PARTITION BY row_id, o ORDER BY nth) AS e FROM m),
    f AS (SELECT row_id, {counts}, string_agg({span}, ',' ORDER BY e - length(h), o) FILTER (o < {len(BASE)}) AS base,
        string_agg({span}, ',' ORDER BY e - length(h), o) AS spans FROM s WHERE length(v) >= least GROUP BY row_id)
    SELECT doc_id, {', '.join(f'coalesce(n_{r.kind}, 0)::BIGINT AS n_{r.kind}' for r in BASE)},
        sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM t LEFT JOIN f USING (row_id)"""


@query("op2_secrets", _oracle())
def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's secrets, found by scanning each distinct content once."""
    docs = table(spark, sf_dir, "documents")
    findings, _ = scan(docs)
    return digest(by_path(docs.select("doc_id", blob_of(F.col("text")).alias("blob")), findings))
