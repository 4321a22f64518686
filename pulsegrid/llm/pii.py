"""Personal data: patterns propose spans, checksums confirm them, context scores them.

Kinds: e-mail addresses, IPv4 addresses, payment cards (Luhn), phone numbers,
and IBANs (mod 97).  Each kind's spans are leftmost and do not overlap; a
proposal that its check refuses is dropped without a retry.  A confirmed span
has a base score; words near it that speak for or against the kind move it.
Scores never remove a span: the caller sets the cut.

Every pattern is walked in time linear in the text (anchored at an ``@``, a
``+`` or the start of a run of digits, with possessive quantifiers), so a long
run of digits or letters costs no more than other text.

Edge cases: a NULL text is empty; an empty table gives no rows; repeated rows
give equal results; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The order of kinds, and each kind's shape.
KINDS = ("email", "ip", "card", "phone", "iban")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_DIGIT = re.compile(r"[0-9]")
#: Words that raise (or lower) the score of a kind within ``REACH`` characters before the span.
CONTEXT = {
    "email": (("mail", "contact", "write", "@"), ("example", "noreply")),
    "ip": (("ip", "host", "address", "server"), ("version", "release", "section")),
    "card": (("card", "visa", "credit", "payment", "pay"), ("order", "serial", "isbn")),
    "phone": (("phone", "tel", "call", "mobile", "fax"), ("id", "order", "ref")),
    "iban": (("iban", "bank", "account", "transfer"), ("serial", "part")),
}
BASE = {"email": 0.9, "ip": 0.6, "card": 0.7, "phone": 0.5, "iban": 0.8}
REACH, STEP = 40, 0.1


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def mod97(code: str) -> bool:
    moved = code[4:] + code[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _emails(t: str) -> Iterator[tuple[int, int]]:
    free, at = 0, t.find("@")
    while at >= 0:
        start = at
        while start > free and _LOCAL.match(t, start - 1):
            start -= 1
        if start < at and (m := _DOMAIN.match(t, at + 1)):
            yield start, m.end()
            free = m.end()
        # Between this @ and the next one no other match can end, and none is tried twice.
        free = max(free, at + 1)
        at = t.find("@", free)


def _at_most_255(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def _digits(s: str) -> str:
    return "".join(_DIGIT.findall(s))


def find_spans(t: str) -> list[tuple[int, int, str]]:
    """(start, rank of the kind, end) of all confirmed spans, sorted."""
    out = []
    if "@" in t:
        out += [(a, 0, b) for a, b in _emails(t)]
    if _DIGIT.search(t):
        if "." in t:
            out += [(m.start(), 1, m.end()) for m in _IP.finditer(t) if all(_at_most_255(p) for p in m[0].split("."))]
        for m in _CARD.finditer(t):
            if m.end() - m.start() >= 14 and 14 <= len(d := _digits(m[0])) <= 19 and luhn(d):
                out.append((m.start(), 2, m.end()))
        if "+" in t:
            out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(t) if 10 <= len(_digits(m[0])) <= 15]
        for m in _IBAN.finditer(t):
            code = m[0].replace(" ", "")
            if 15 <= len(code) <= 34 and mod97(code):
                out.append((m.start(), 4, m.end()))
    return sorted(out)


def score(t: str, start: int, rank: int) -> float:
    """The kind's base score, moved by the words just before the span; between 0 and 1."""
    near = t[max(0, start - REACH): start].lower()
    words = set(re.findall(r"[a-z@]+", near))
    good, bad = CONTEXT[KINDS[rank]]
    return round(min(1.0, max(0.0, BASE[KINDS[rank]] + STEP * (sum(w in words for w in good) - sum(w in words for w in bad)))), 3)


def scan(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and ``found``: array of (start, end, kind, score), by start, then kind order. One map-only pass."""
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("score", pa.float64())]))
    frame = docs.select(*keep, F.col(text).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for t in batch.column("_text"):
                t = t.as_py() or ""
                rows.append([{"start": a, "end": b, "kind": KINDS[k], "score": score(t, a, k)} for a, k, b in find_spans(t)])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(rows, span)], [*keep, "found"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema if f.name != "_text")
    return frame.mapInArrow(run, f"{fields}, found array<struct<start:int,end:int,kind:string,score:double>>")


def report(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts, digest of the base spans, all spans, and the highest score of each row."""
    found = scan(docs, keep=(key,))
    base = KINDS[:4]

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")

    count = lambda k: F.size(F.filter("found", lambda s: s.kind == k)).cast("long").alias(f"n_{k}")
    return found.select(
        key, *[count(k) for k in base],
        F.sha2(joined(F.filter("found", lambda s: s.kind.isin(*base))).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("found")).alias("spans"), count("iban"), F.array_max(F.transform("found", lambda s: s.score)).alias("max_score"))
