"""The stages of the corpus pipeline against brute force, on small tables."""

import re

import pytest

import corpus_pipeline
from tests.conftest import SF001
from tests.llm.test_models import WORD, sort_rows
from tests.llm.test_scans import contamination, lower, pairs, secret_spans, windows


def shingle_sets(rows, n):
    words = [WORD.findall(lower(t or "")) for _, t in rows]
    return [{tuple(w[i: i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set() for w in words]


def brute_kept(rows, n=None):
    """One row (id, text) of each group: smallest id, NULL last; rows without words all stay."""
    sets = shingle_sets(rows, n or NEAR_WORDS)
    left, kept = set(range(len(rows))), []
    while left:
        group, todo = set(), [left.pop()]
        while todo:
            a = todo.pop()
            group.add(a)
            near = {b for b in left if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
            left -= near
            todo += near
        kept.append(min((rows[i] for i in group), key=lambda r: (r[0] is None, r[0] or 0)))
    return kept


NEAR_WORDS = 5


def plain(i, n=40):
    return " ".join(f"d{i}w{j}" for j in range(n))


def ids_and_sets(rows, n):
    """Rows comparable where copies of a text may stand for each other."""
    return sort_rows([(i, len(s), str(sorted(s))) for (i, _), s in zip(rows, shingle_sets(rows, n), strict=True)])


def near(spark, docs):
    return corpus_pipeline.near_duplicate_stage(spark, docs, SF001)


def test_rows_of_one_id_or_none_are_not_one_document(spark):
    rows = [(7, plain(i)) for i in range(5)] + [(None, plain(10 + i)) for i in range(5)] + [(7, plain(0)), (None, plain(10)), (3, plain(2)), (None, plain(4) + " more")]
    rows += [(None, None), (None, None), (7, " "), (7, " ")]
    got = pairs(near(spark, spark.createDataFrame(rows, "doc_id long, text string")))
    assert len(got) == 14
    assert ids_and_sets(got, NEAR_WORDS) == ids_and_sets(brute_kept(rows), NEAR_WORDS)


@pytest.mark.parametrize("which", ["documents", "edge"])
def test_near_duplicate_stage_equals_brute_force(spark, which, request):
    docs = request.getfixturevalue(which)
    got = near(spark, docs)
    assert got.columns == docs.columns
    assert ids_and_sets(pairs(got), NEAR_WORDS) == ids_and_sets(brute_kept(pairs(docs)), NEAR_WORDS)


def test_five_isolated_edits_in_200_words_are_no_near_duplicate(spark):
    words = plain(0, 200).split()
    edited = [f"x{j}" if j % 40 == 20 else w for j, w in enumerate(words)]
    rows = [(1, " ".join(words)), (2, " ".join(edited))]
    a, b = shingle_sets(rows, 4)
    assert 100 * len(a & b) >= 80 * len(a | b)
    assert near(spark, spark.createDataFrame(rows, "doc_id long, text string")).count() == 2


CLASHING = ["score", "predicted", "n_words", "hit_ranges", "hit_items", "blob", "found", "_text", "_row", "_row0"]


@pytest.mark.parametrize("stage", [s for s in corpus_pipeline.STAGES if s[0] != "packing"], ids=lambda s: s[0])
def test_columns_named_like_results_come_through(spark, stage, monkeypatch):
    # Every text passes the classifier, so that a stage's rows depend on nothing else here.
    monkeypatch.setattr(corpus_pipeline.quality, "fit", lambda *a, **k: corpus_pipeline.quality.constant(0.9))
    rows = [(i, plain(i), *(f"{c} of {i}" for c in CLASHING)) for i in range(4)] + [(None, None, *(f"{c} of none" for c in CLASHING))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{c} string" for c in CLASHING))
    got = stage[1](spark, docs, SF001)
    assert got.columns == docs.columns
    assert sort_rows(map(tuple, got.collect())) == sort_rows(rows)
    assert stage[1](spark, docs.where("false"), SF001).count() == 0


def spans_out(text):
    """The text with every secret replaced, overlapping ones by one mark."""
    if text is None:
        return None
    spans = [(a, b) for a, _, b, _ in secret_spans(text)]
    spans += [m.span() for p in ("gh[pousr]_[A-Za-z0-9]{36,}", "-----BEGIN (?:[A-Z]+ ){0,4}PRIVATE KEY-----") for m in re.finditer(p, text)]
    out, at = [], 0
    for a, b in sorted(spans):
        if a >= at:
            out += [text[at:a], "[secret]"]
        at = max(at, b)
    return "".join(out) + text[at:]


def raw_pairs(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


def benchmark_items(spark):
    return [(r["item_id"], windows(r["text"])) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]


@pytest.mark.parametrize("which", ["documents", "edge"])
def test_decontamination_stage_equals_brute_force(spark, which, request):
    docs = request.getfixturevalue(which)
    items = benchmark_items(spark)
    got = dict(corpus_pipeline.STAGES)["benchmark_decontamination"](spark, docs, SF001)
    assert got.columns == docs.columns
    assert sort_rows(raw_pairs(got)) == sort_rows((i, t) for i, t in raw_pairs(docs) if not contamination(t or "", items)[-1])


@pytest.mark.parametrize("which", ["documents", "edge"])
def test_secret_stage_equals_brute_force(spark, which, request):
    docs = request.getfixturevalue(which)
    got = dict(corpus_pipeline.STAGES)["secret_scans"](spark, docs, SF001)
    assert got.columns == docs.columns
    assert sort_rows(raw_pairs(got)) == sort_rows((i, spans_out(t)) for i, t in raw_pairs(docs))
    if "n_chars" in docs.columns:
        sizes = {r["doc_id"]: r["n_chars"] for r in docs.collect()}
        assert all(r["n_chars"] == (len(r["text"]) if "[secret]" in r["text"] else sizes[r["doc_id"]]) for r in got.collect() if r["text"] is not None)


def kept_by_quality(spark, docs):
    labels = spark.read.parquet(f"{SF001}/labels.parquet")
    return {r["doc_id"] for r in corpus_pipeline.quality.report(docs, labels).where("predicted = 1").collect()}


def test_quality_stage_keeps_what_the_report_predicts(spark, documents):
    got = dict(corpus_pipeline.STAGES)["quality_classifier"](spark, documents, SF001)
    assert got.columns == documents.columns
    assert sorted(r["doc_id"] for r in got.collect()) == sorted(kept_by_quality(spark, documents))


def test_packing_stage_ignores_columns_named_like_results(spark):
    names = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    rows = [(i, plain(i), *(f"{c} of {i}" for c in names)) for i in range(4)] + [(None, None, *("none" for _ in names)), (2, plain(2), *("again" for _ in names))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{c} string" for c in names))
    pack = dict(corpus_pipeline.STAGES)["packing"]
    got, bare = pack(spark, docs, SF001), pack(spark, docs.select("doc_id", "text"), SF001)
    assert got.columns == bare.columns
    key = lambda df: sort_rows(tuple(r) for r in df.select("doc_id", "start", "length", "ids_crc32", "doc_tokens").collect())
    assert key(got) == key(bare) and sum(r[2] for r in key(got) if r[1] == 0) >= 6
    assert pack(spark, docs.where("false"), SF001).count() == 0


def test_run_equals_the_chain_of_its_stages(spark, documents):
    kept = kept_by_quality(spark, documents)
    rows = brute_kept([(i, t) for i, t in raw_pairs(documents) if i in kept], NEAR_WORDS)
    items = benchmark_items(spark)
    rows = [(i, spans_out(t)) for i, t in rows if not contamination(t or "", items)[-1]]
    packed = corpus_pipeline.run(spark, SF001)
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == {i for i, _ in rows}
    assert packed.where("start = 0").count() == len(rows)


def test_pipeline_runs_its_stages(spark):
    documents = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id").distinct()
    packed = corpus_pipeline.run(spark, SF001)
    assert 0 < packed.count()
    assert packed.select("doc_id").distinct().join(documents, "doc_id", "left_anti").count() == 0
