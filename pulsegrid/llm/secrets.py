"""Incremental secret scan over a content-addressed blob ledger.

Every version of every path is addressed by the SHA-256 of its text.  A scan
step looks only at (blob, rule, rule version) triples that the ledger does not
hold, appends what it found and what it looked at, and findings are joined back
to every path that has the blob.  All work is done in JVM expressions.

Positions come from the two halves of one regular expression pass: the matched
strings (``regexp_extract_all``) and the pieces between them (``split``) have
the same order, so running sums of their lengths give each match's start and
end in code points, end exclusive.  A match that its rule's check refuses is
dropped without a retry.

A very long text is matched whole: no rule repeats a group without bound, so no text
overflows the stack, and the spans of one text are gathered in time near their number.

Edge cases: a NULL text is the empty blob; repeated rows and copies share a
blob and all get its findings; an empty table gives no rows; further columns
of the input, whatever their names, are not touched.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import written


@dataclass(frozen=True)
class Rule:
    """One kind of secret. ``least`` characters of group ``group`` make a match count."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    version: int = 1


# The base patterns and lengths, in their order; the kinds after them are additions.
BASE_RULES = (
    Rule("assign", "(?i:(password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    Rule("access", "AKIA[A-Z0-9]{16,}"),
    Rule("hex", "[0-9a-f]{24,}"),
)
RULES = (
    *BASE_RULES,
    Rule("forge", "gh[pousr]_[A-Za-z0-9]{36,}"),
    # Few words before the key: a group repeated without bound recurses once a repeat in Java's engine.
    Rule("pem", "-----BEGIN (?:[A-Z]+ ){0,4}PRIVATE KEY-----", version=2),
)
SPANS = "array<struct<start:int,end:int>>"
#: Matches of one text that are gathered by one fold.
GATHERED = 256


def blob_id(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def once(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.transform(F.array(value), lambda v: body(v))[0]


def rule_spans(text: Column, rule: Rule) -> Column:
    """Accepted matches of one rule, in order, as (start, end)."""
    hits = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    marks = F.transform(
        F.arrays_zip(hits.alias("hit"),
                     (F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else hits).alias("part"),
                     F.slice(F.split(text, rule.pattern, -1), 1, F.size(hits)).alias("gap")),
        lambda x: F.struct(F.length(x["gap"]).alias("gap"), F.length(x["hit"]).alias("hit"), (F.length(x["part"]) >= rule.least).alias("good")))
    # A fold copies its state at every step, so the spans of a text with many matches are gathered block by block.
    def cut(all_marks: Column) -> Column:
        last = F.ceil(F.size(all_marks) / GATHERED).cast("int") - 1
        return F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(all_marks, b * GATHERED + 1, GATHERED))

    def widths(blocks: Column) -> Column:
        return F.transform(blocks, lambda block: F.aggregate(block, F.lit(0), lambda a, x: a + x.gap + x.hit))

    def step(a: Column, x: Column) -> Column:
        start, end = a.pos + x.gap, a.pos + x.gap + x.hit
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct(end.alias("pos"), F.when(x.good, F.concat(a.out, span)).otherwise(a.out).alias("out"))

    def spans(block: Column, before: Column) -> Column:
        return F.aggregate(block, F.struct(before.alias("pos"), F.array().cast(SPANS).alias("out")), step, lambda a: a.out)

    def gathered(blocks: Column) -> Column:
        return once(widths(blocks), lambda sizes: F.flatten(F.transform(blocks, lambda block, b: spans(
            block, F.aggregate(F.slice(sizes, F.lit(1), b), F.lit(0), lambda a, x: a + x)))))

    at = once(marks, lambda all_marks: once(cut(all_marks), gathered))
    return F.when(text.rlike(rule.pattern), at).otherwise(F.array().cast(SPANS))


def empty_ledger(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(ledger, findings) before the first step."""
    spark = docs.sparkSession
    return (spark.createDataFrame([], "blob string, kind string, version int"),
            spark.createDataFrame([], f"blob string, kind string, version int, spans {SPANS}"))


def scan_step(versions: DataFrame, ledger: DataFrame, findings: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(ledger, findings) after scanning the unseen pairs of ``versions``, both written tables.

    ``findings`` keeps one row per blob, rule and version with spans.  Copies of
    a blob meet in a map-side aggregate before the shuffle, so a text with a
    third of all rows sends one row per task.  The scan itself runs behind an
    anti join: a blob with no unseen rule is gone before any pattern is tried.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    blobs = versions.select(blob_id(body).alias("blob"), body.alias("body")).groupBy("blob").agg(F.first("body").alias("body"))
    wanted = {r.kind: r.version for r in rules}
    known = F.create_map(*[x for k, v in wanted.items() for x in (F.lit(k), F.lit(v))])
    seen = (ledger.where(known[F.col("kind")] == F.col("version"))
            .groupBy("blob").agg(F.collect_set("kind").alias("seen")))
    if ledger.isEmpty():
        todo = blobs.withColumn("seen", F.array().cast("array<string>"))
    else:
        todo = (blobs.join(seen, "blob", "left").withColumn("seen", F.coalesce("seen", F.array().cast("array<string>")))
                .where(F.size("seen") < len(rules)))
    scanned = todo.select("blob", "seen", *[
        F.when(~F.array_contains("seen", r.kind), rule_spans(F.col("body"), r)).alias(r.kind) for r in rules])
    result = F.array(*[F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version"), F.col(r.kind).alias("spans")) for r in rules])
    step = written(scanned.select("blob", F.explode(F.filter(result, lambda x: x.spans.isNotNull())).alias("r"))
                   .select("blob", "r.kind", "r.version", "r.spans"), "secret-step")
    return (ledger.unionByName(step.drop("spans")),
            findings.unionByName(step.where(F.size("spans") > 0)))


def current_spans(findings: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(blob, found): all spans of a blob under the rules' current versions, by start, then rule order."""
    wanted = F.create_map(*[x for r in rules for x in (F.lit(r.kind), F.lit(r.version))])
    rank = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.kind), F.lit(i))])
    return (findings.where(wanted[F.col("kind")] == F.col("version"))
            .groupBy("blob").agg(F.collect_list(F.struct("kind", "spans")).alias("kinds"))
            .select("blob", F.array_sort(F.flatten(F.transform("kinds", lambda k: F.transform(k.spans, lambda s: F.struct(
                s.start.alias("start"), rank[k.kind].alias("rank"), s.end.alias("end"), k.kind.alias("kind")))))).alias("found")))


def at_paths(versions: DataFrame, findings: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """``versions`` with ``blob`` and ``found`` (NULL where nothing was found)."""
    return versions.withColumn("blob", blob_id(F.col(text))).join(current_spans(findings, rules), "blob", "left")


def span_text(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")


def redacted(text: Column, found: Column, mark: str = "[secret]") -> Column:
    """``text`` with every span of ``found`` (in order of start) replaced; overlapping spans become one mark."""
    size = F.length(text)
    state = F.aggregate(
        found, F.struct(F.lit(0).alias("pos"), F.lit("").alias("out")),
        lambda a, s: F.struct(
            F.greatest(a.pos, s.end).alias("pos"),
            F.when(s.start >= a.pos, F.concat(a.out, F.substring(text, a.pos + 1, s.start - a.pos), F.lit(mark))).otherwise(a.out).alias("out")))
    return F.when(F.coalesce(F.size(found), F.lit(0)) < 1, text).otherwise(
        F.concat(state["out"], F.substring(text, state["pos"] + 1, size - state["pos"])))


def scan_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One step from an empty ledger, joined back to all rows: counts, digest and spans per row."""
    _, findings = scan_step(docs.select(F.col(text)), *empty_ledger(docs), rules, text)
    rows = at_paths(docs.select(key, text), findings, rules, text)
    found = F.coalesce("found", F.array().cast("array<struct<start:int,rank:int,end:int,kind:string>>"))
    base = [r.kind for r in BASE_RULES]
    rows = rows.select(key, found.alias("found"))

    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")

    return rows.select(
        key, *[count(k) for k in base],
        F.sha2(span_text(F.filter("found", lambda s: s.kind.isin(*base))).cast("binary"), 256).alias("base_sha256"),
        span_text(F.col("found")).alias("spans"))
