"""Bounded samples for fitting: by a hash of the key, so they don't depend on how the table is split.

An ordered limit would send as many rows from every partition to the driver; a threshold on the hash
sends about n in all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SPACE = 1 << 31


def hash_sample(df: DataFrame, key: Column, n: int, total: int) -> DataFrame:
    """All rows if there are at most n, else those with the lowest hashes, n of them on average."""
    return df if total <= n else df.where(F.pmod(F.xxhash64(key), F.lit(_SPACE)) < int(n / total * _SPACE))
