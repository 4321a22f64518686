"""Column expressions (JVM-side, codegen-friendly)."""

from pulsegrid.functions.hashing import hash_hex, hash_unit
from pulsegrid.functions.scalar import (
    affine_array,
    bce_with_logits,
    dot,
    elapsed_seconds,
    fixed_decimals,
    percent_of,
    rint,
    sigmoid,
    zscore,
)

__all__ = [
    "affine_array", "hash_hex", "hash_unit", "bce_with_logits", "dot", "elapsed_seconds",
    "fixed_decimals", "percent_of", "rint", "sigmoid", "zscore",
]
