"""Seeded, layout-independent row hashing.

``hash_unit(seed, key)`` maps a row key to a number in [0, 1): the first 8 hex
digits of ``md5('<seed>:<key>')`` read as an unsigned 32-bit integer, divided
by 2^32.  The same value comes out of any engine that has md5 (the DuckDB
oracle uses ``cast('0x' || substr(md5(...), 1, 8) as bigint) / 4294967296.0``),
and it does not depend on how the rows are partitioned, unlike ``randomSplit``.

Key columns are rendered as text before hashing.  Integers and strings print
the same in every engine; doubles do not (``1.0E10`` vs ``10000000000.0``), so
for results that must match another engine, key on integers or strings (e.g.
prices as integer cents).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_POW_32 = 4294967296.0


def _key_string(key: str | Column | Sequence[str | Column]) -> Column:
    if isinstance(key, (str, Column)):
        key = [key]
    cols = [F.col(k) if isinstance(k, str) else k for k in key]
    return F.concat_ws(":", *[c.cast("string") for c in cols])


def hash_hex(seed: int, key: str | Column | Sequence[str | Column]) -> Column:
    """md5 hex digest of ``'<seed>:<key1>:<key2>...'``."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), _key_string(key)))


def hash_unit(seed: int, key: str | Column | Sequence[str | Column]) -> Column:
    """Uniform-looking value in [0, 1) from a seeded md5 of the key."""
    prefix = F.substring(hash_hex(seed, key), 1, 8)
    return F.conv(prefix, 16, 10).cast("bigint").cast("double") / F.lit(TWO_POW_32)
