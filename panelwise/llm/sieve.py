"""A fixed-size bitmap of hashes, to leave most rows out before a join. It only saves work: the join decides."""

from __future__ import annotations

import numpy as np
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwise.llm.common import sent

#: Bits of every bitmap: 4 MB, whatever the data.
BITS = 1 << 25


def sieve(df: DataFrame, column: str) -> Broadcast:
    """A broadcast bitmap that holds every value of a 64-bit hash column."""
    place = F.pmod(F.col(column), F.lit(BITS))
    words = df.select(place.alias("p")).groupBy(F.expr("p div 64").cast("int").alias("w"))
    rows = words.agg(F.bit_or(F.expr("shiftleft(1L, cast(p % 64 AS int))")).alias("bits")).toArrow()
    bitmap = np.zeros(BITS // 64, np.int64)
    bitmap[rows.column("w").to_numpy()] = rows.column("bits").to_numpy()
    return sent(df.sparkSession, bitmap.view(np.uint64))


def passes(bitmap: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Whether each value (64-bit, signed as in the column) may be in the bitmap."""
    place = values.astype(np.int64) % BITS
    return (bitmap[place >> 6] >> (place & 63).astype(np.uint64)) & np.uint64(1) == 1
