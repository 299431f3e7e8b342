"""Latest or earliest row per key by aggregation.

Copies of a key are combined on the map side, so a key that holds a large share of the rows costs no more
than any other; a window over the key would bring all its rows into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[str], choose, extreme) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates(list(keys))
    if set(rest) <= set(order):
        # The order names every column: its extreme is the row, which then travels once instead of twice.
        chosen = extreme(F.struct(*order)).alias("_row")
    else:
        chosen = choose(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(chosen).select(*[f"_row.{c}" if c in rest else c for c in df.columns])


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return _pick(df, keys, order, F.max_by, F.max)


def earliest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return _pick(df, keys, order, F.min_by, F.min)
