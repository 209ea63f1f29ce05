"""Documents in ascending order of their ids, dealt into ranges, without one task that sees them all."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters of text a range is planned for.
RANGE_CHARS = 12 << 20
#: Ranges there are at most; with more text they grow, and are read and written as streams.
RANGES = 1 << 13


def range_starts(docs: DataFrame, range_chars: int = RANGE_CHARS) -> list[int]:
    """Ids, each of which opens a range; the ranges have about equally many rows, the first id is the least.

    One pass over ids and lengths. The list holds one number for each ``range_chars`` characters of all text, RANGES at most.
    """
    row = docs.agg(F.sum(F.length("text")), F.count("doc_id"), F.min("doc_id")).first()
    if not row[1]:
        return []
    n = max(1, min(int(row[1]), RANGES, -(-(row[0] or 0) // range_chars)))
    if n == 1:
        return [row[2]]
    cuts = docs.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], max(10_000, 50 * n))).first()[0]
    return sorted({row[2], *cuts})


def range_of(starts: list[int]) -> Column:
    """The number of the range that ``doc_id`` lies in; rows with a null id are spread over all ranges."""
    edges = np.array(starts, dtype=np.int64)

    @F.pandas_udf("int")
    def number(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(edges, ids.to_numpy(dtype=np.int64), side="right") - 1)

    n = max(1, len(starts))
    if n == 1:
        return F.lit(0)
    ids = F.col("doc_id").cast("long")
    return F.when(ids.isNull(), F.pmod(F.xxhash64("text"), F.lit(n)).cast("int")).otherwise(number(F.coalesce(ids, F.lit(starts[0]))))
