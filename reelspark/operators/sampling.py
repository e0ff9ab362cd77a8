"""Random rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sample_exactly(df: DataFrame, n: int, identity: Column, seed: int = 0) -> DataFrame:
    """Exactly n rows (or all, if fewer) in a pseudo-random order fixed by the seed and the row identity.

    Hashing the identity instead of drawing random numbers keeps the sample the same under any partitioning and
    after task retries. Runs as a distributed top-k.
    """
    ticket = F.md5(F.concat_ws("|", F.lit(str(seed)), identity.cast("string")))
    return df.orderBy(ticket, identity).limit(n)
