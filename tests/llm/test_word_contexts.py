"""op8's restaurants, draws and probabilities."""

import math
import zlib

import numpy as np
import pytest

from pulsegrid.llm import hpylm
from tests.llm.test_models import sort_rows

DOCS = [(1, "a b a c"), (2, "b a"), (3, "c c c d"), (4, None)] + [(10 + i, "a b a b c a a a d b a") for i in range(4)]
WORDS = ["a", "b", "c", "d", "zz"]


def small_parts(monkeypatch):
    for name, value in (("FLUSH_TOKENS", 40), ("RANGE_BYTES", 60), ("HOT_TOKENS", 8), ("MERGED", 1)):
        monkeypatch.setattr(hpylm, name, value)


@pytest.mark.parametrize("small", [False, True])
def test_every_context_is_a_distribution(spark, small, monkeypatch):
    if small:
        small_parts(monkeypatch)
    model = hpylm.fit(spark.createDataFrame(DOCS, "doc_id long, text string"))
    assert (model.n_tokens, model.n_types) == (14 + 48, 5)
    rows = [hpylm.Lookup(r.asDict(), model.customers, model.totals) for r in model.state.collect()]
    keys, contexts, _ = hpylm.tokens([w.encode() for w in WORDS])
    word = dict(zip(["a", "end", "b", "end", "c", "end", "d", "end", "zz"], keys, strict=False))
    asked = np.array([word[w] for w in ("a", "b", "c", "d", "end", "zz")], np.uint64)

    def p(context):
        out = []
        for w in asked:
            own = next((r for r in rows if w in r.words), rows[0])
            out.append(own.of(np.array([w], np.uint64), np.array([1]), np.array([context], np.uint32), model.shares, model.unknown())[1][0])
        return out

    for context in np.unique(np.append(contexts, hpylm.restaurants(asked))):
        assert sum(p(context)) == pytest.approx(1, abs=1e-6)
    # Scores are sums of these.
    start, after = hpylm.restaurants(np.array([hpylm._END]))[0], {w: hpylm.restaurants(np.array([word[w]]))[0] for w in WORDS}
    place = {w: i for i, w in enumerate(["a", "b", "c", "d", "end", "zz"])}
    texts = [(u, w) for u in WORDS for w in WORDS]
    df = spark.createDataFrame([(i, False, f"{u}\n{w.upper()}") for i, (u, w) in enumerate(texts)], "doc_id long, held_out boolean, text string")
    got = {r["doc_id"]: r["score"] for r in hpylm.score(df, model).collect()}
    for i, (u, w) in enumerate(texts):
        want = math.log10(p(start)[place[u]]) + math.log10(p(after[u])[place[w]]) + math.log10(p(after[w])[place["end"]])
        assert got[i] == pytest.approx(want, abs=1e-5)


def seatings(n, d):
    """(tables, weight) of all seatings of n customers of one dish, one after the other."""
    out = {(): 1.0}
    for _ in range(n):
        more = {}
        for sizes, weight in out.items():
            for i in range(len(sizes)):
                key = tuple(sorted((*sizes[:i], sizes[i] + 1, *sizes[i + 1:])))
                more[key] = more.get(key, 0) + weight * (sizes[i] - d)
            key = tuple(sorted((*sizes, 1)))
            more[key] = more.get(key, 0) + weight
        out = more
    by = {}
    for sizes, weight in out.items():
        by[len(sizes)] = by.get(len(sizes), 0) + weight
    return by


@pytest.mark.parametrize("d", [0.1, 0.5, 0.8])
def test_stirling_numbers_count_seatings(d):
    table = hpylm.log_stirling(d, 12)
    for n in range(1, 11):
        for t, weight in seatings(n, d).items():
            assert math.exp(table[n, t]) == pytest.approx(weight, rel=1e-9)
    large = hpylm.log_stirling(d, 400)
    off = hpylm.log_stirling_large(d, 400, np.arange(1, 380)) + math.lgamma(401) - large[400, 1:380]
    assert np.abs(np.diff(off)).max() < 0.04 and np.abs(off).max() < 0.04


def test_log_gamma():
    x = np.array([0.1, 0.5, 1, 2.5, 7.9, 8, 100, 1e6])
    assert np.allclose(hpylm.log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-10, atol=1e-9)


def conditional(n, d, others, c, tables, totals):
    """p(t) by enumeration: seatings times the probability of each new table here and at the parent."""
    out = {}
    for t, weight in seatings(n, d).items():
        p, pc, pt = weight, c, tables
        for i in range(t):
            p *= (hpylm.STRENGTH + d * (others + i)) * (pc - totals.parent_d * pt + totals.fresh if pc else totals.fresh) / (totals.all + i)
            pc, pt = pc + 1, max(pt, 1)
        out[t] = p
    whole = sum(out.values())
    return {t: p / whole for t, p in out.items()}


@pytest.mark.parametrize("n,others,c,tables", [(2, 0, 0, 0), (5, 3, 0, 0), (5, 0, 4, 2), (10, 7, 1, 1), (20, 40, 9, 3)])
def test_table_counts_equal_enumeration(n, others, c, tables):
    d = 0.5
    totals = hpylm.Totals(d, 0.6, 30, 200.0, 60.0)
    want = conditional(n, d, others, c, tables, totals)
    rows = 40_000
    served = float(c - totals.parent_d * tables + totals.fresh)
    each = lambda v: np.full(rows, float(v))
    seats = hpylm.Seats(d, hpylm.log_stirling(d, 64), np.full(rows, n), each(others), each(served if c else totals.fresh),
                        each(served if c else totals.fresh - totals.parent_d), each(totals.all))
    got = seats.drawn((np.arange(rows) + 0.5) / rows)
    for t, p in want.items():
        assert (got == t).mean() == pytest.approx(p, abs=1e-3)


def test_large_counts_go_on_from_the_exact_ones(monkeypatch):
    """The same draws by the table and by the saddle point."""
    d, rows = 0.6, 400
    totals = hpylm.Totals(d, 0.6, 30_000, 2e5, 6e4)
    each = lambda v: np.full(rows, float(v))
    args = (np.full(rows, 900), each(50), each(40.0), each(40.0), each(totals.all))
    table = hpylm.log_stirling(d, hpylm.EXACT)
    u = (np.arange(rows) + 0.5) / rows
    exact = hpylm.Seats(d, table, *args).drawn(u)
    monkeypatch.setattr(hpylm, "EXACT", 100)
    near = hpylm.Seats(d, table, *args).drawn(u)
    assert abs(exact.mean() - near.mean()) < 0.05 * max(1, exact.std()) and np.abs(exact - near).max() <= 2


def test_own_tables_are_taken_out():
    """A word alone in one restaurant: the sweep's draw has the conditional without its own tables."""
    n = 6
    counts = {t: 0 for t in range(1, n + 1)}
    totals = hpylm.Totals(0.5, 0.5, 10, 40.0, 10.0)
    stirling = hpylm.log_stirling(0.5, 64), hpylm.log_stirling(0.5, 64)
    rows = 4000
    words = np.arange(1, rows + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    r = hpylm.Range(words, np.ones(rows, np.int64), np.zeros(rows, np.uint32), np.full(rows, n), np.full(rows, 3), np.full(rows, 2))
    tables = np.zeros(hpylm.RESTAURANTS, np.int64)
    tables[0] = 8  # five others
    out = hpylm.swept(r, tables, totals, stirling, 0)
    want = conditional(n, 0.5, 5, 0, 0, hpylm.Totals(0.5, 0.5, 10, 40.0 - 3, 10.0))
    for t in counts:
        assert (out.tables == t).mean() == pytest.approx(want[t], abs=0.03)
    assert (out.parent_tables <= out.customers()).all() and (out.parent_tables >= 1).all()


def test_scores_do_not_depend_on_the_layout(spark, monkeypatch):
    docs = spark.createDataFrame([*DOCS, *[(100 + i, f"w{i % 7} w{i % 3} w{i % 7} x") for i in range(60)]], "doc_id long, text string")
    whole = sort_rows(tuple(r) for r in hpylm.score_documents(docs.repartition(1)).collect())
    dealt = sort_rows(tuple(r) for r in hpylm.score_documents(docs.repartition(9)).collect())
    small_parts(monkeypatch)
    parts = sort_rows(tuple(r) for r in hpylm.score_documents(docs.repartition(4)).collect())
    for other in (dealt, parts):
        assert [r[:5] for r in other] == [r[:5] for r in whole]
        assert np.allclose([r[5:] for r in other], [r[5:] for r in whole], atol=1e-5)


def test_restaurants_tell_previous_words_apart(spark):
    docs = spark.createDataFrame([(i, "xxab one zz" if i % 2 else "yyab two zz") for i in range(60)], "doc_id long, text string")
    probe = spark.createDataFrame([(1, True, "xxab one zz"), (2, True, "xxab two zz")], "doc_id long, held_out boolean, text string")
    right, wrong = (r["score"] for r in sorted(hpylm.score(probe, hpylm.fit(docs)).collect()))
    assert right > wrong + 1


def test_held_out_texts_are_likelier_than_by_word_counts(spark, documents):
    rows = [r for r in hpylm.score_documents(documents).collect() if r["held_out"]]
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2 for r in rows)
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


def test_packed_arrays_come_back():
    rng = np.random.default_rng(1)
    arrays = [rng.integers(0, 2**63, 100).astype("<u8"), np.zeros(0, "<u4"), rng.integers(0, 9, 7).astype("<i8"), rng.normal(size=5).astype("<f4")]
    for a, b in zip(arrays, hpylm.unpack(hpylm.pack(*arrays), "<u8", "<u4", "<i8", "<f4"), strict=True):
        assert a.dtype == b.dtype and (a == b).all()
    for n in (1, 5, 64):
        part = hpylm.range_of(np.sort(rng.integers(0, 2**64, 50, dtype=np.uint64)), n)
        assert (np.diff(part) >= 0).all() and part.max() < n
