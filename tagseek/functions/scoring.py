"""BM25 as column arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..params import B, K1


def idf(n_docs: int, df: Column) -> Column:
    return F.log(1 + (F.lit(float(n_docs)) - df + 0.5) / (df + 0.5))


def saturation(freq: Column, length: Column, avg_length: float) -> Column:
    """Frequency damped by itself and by the record's length, below 1."""
    norm = K1 * (1 - B) + K1 * B / max(avg_length, 1e-9) * length
    return freq / (freq + norm)


def coarse_length(length: Column) -> Column:
    """A length as one byte can hold it: exact below 40, above that only the
    four leading bits of what exceeds 24."""
    over = length - 24
    drop = F.length(F.bin(over)) - 4
    step = F.pow(F.lit(2.0), drop)
    return F.when(length < 40, length).otherwise((24 + F.floor(over / step) * step).cast("int"))
