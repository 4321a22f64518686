"""Filter audit against brute force over all orders."""

from itertools import permutations

import duckdb

from pulsegrid.llm import audit
from pulsegrid.llm.common import BLOCK_BYTES
from pulsegrid.llm.oracles import ORACLES

NAMES = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def brute(rows, labels):
    """rows: (doc_id, text, source); labels: (doc_id, quality, toxic)."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    docs = []
    for i, t, source in rows:
        t = t or ""
        words = [w for w in t.translate(str.maketrans("\t\n\v\f\r", "     ")).split(" ") if w]
        fails = {
            "A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t), "D": any(c in "#$%&*|" for c in t),
            "E": i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in rows)}
        docs.append((source or "", {k for k, v in fails.items() if v}, i in good, i in toxic))
    out = {}
    for part in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            for step, f in enumerate(order, 1):
                gone = set(order[: step - 1])
                removed = [d for d in mine if f in d[1] and not d[1] & gone]
                shapley[f] += len(removed)
                out[part, "".join(order), step] = [
                    sum(not d[1] & (gone | {f}) for d in mine), len(removed), sum(f in d[1] and bool(d[1] & gone) for d in mine),
                    sum(d[1] == {f} for d in mine), sum(d[2] for d in removed), sum(d[3] for d in removed)]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return out


def collected(df):
    rows = df.collect()
    out = {(r["part"], r["filter_order"], r["step"]): [r[n] for n in NAMES] for r in rows}
    assert len(out) == len(rows)
    return out


def edge_docs(spark, edge):
    plain = " ".join(f"word{i}" for i in range(60))
    rows = [(r["doc_id"], r["text"], s) for r, s in zip(edge.collect(), ["a", "b", None, ""] * 20)]
    rows += [(100 + i, plain, "hot") for i in range(40)] + [(100, plain, "hot"), (None, plain, "hot"), (None, plain, "a"), (3, plain, "b")]
    rows += [(200, "NO " * 60, "a"), (201, plain + " #", "a"), (202, "same " * 200, "hot"), (203, "É" * 10 + "A", None)]
    return rows


def test_audit_equals_brute_force(spark, edge, monkeypatch):
    monkeypatch.setattr(audit, "SALT_ROWS", 7)
    rows = edge_docs(spark, edge)
    labels = [(100, 1, 0), (100, 0, 1), (101, 1, 1), (102, None, None), (None, 1, 1), (200, 0, 1), (3, 1, 0), (7, 1, 0)]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, source string, bits int, part string")
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = collected(audit.audit(docs, table))
    assert got == brute(rows, labels)
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    con.register("labels", table.toPandas())
    sql = con.execute(ORACLES["op11_filter_audit"]).fetchall()
    assert {tuple(r[:3]): list(r[3:]) for r in sql} == got


def test_shuffled_hashes_give_the_same(spark, edge, monkeypatch):
    docs = spark.createDataFrame(edge_docs(spark, edge), "doc_id long, text string, source string")
    table = spark.createDataFrame([(100, 1, 0)], "doc_id long, quality int, toxic int")
    want = collected(audit.audit(docs, table))
    monkeypatch.setattr(audit, "BROADCAST_ROWS", 0)
    assert collected(audit.audit(docs.repartition(5), table)) == want


def test_no_documents(spark, no_rows):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert audit.audit(docs, none).count() == 0


def test_long_texts_are_counted_in_blocks():
    words = [f"w{i % 5003}" for i in range(400_000)]
    text = " \t\n".join(words).encode()
    assert len(text) > 2 * BLOCK_BYTES
    assert audit.word_counts(text) == (400_000, 5003)
    giant = b"x" * (2 * BLOCK_BYTES + 5) + b"\n y x"
    assert audit.word_counts(giant) == (3, 3)
