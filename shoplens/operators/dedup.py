"""Keep one row per key, chosen by a total order.

Implemented as an aggregate, not a window: ``max(struct(order..., rest...))``
per key is a partial (map-side) aggregate, so a key repeated across a
third of all rows is reduced inside every map task before the shuffle,
instead of sending the whole group to one task. (Spark plans a struct maximum as
a sort aggregate, so each side sorts its rows by key.) The struct holds every
column, so the winner is fixed even when the order columns tie.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_max(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str],
             keep_null_keys: bool = True) -> DataFrame:
    """One row per ``keys``: the greatest by ``order`` (NULL lowest), then
    by the remaining columns in schema order.

    Rows whose key is NULL cannot duplicate anything; with
    ``keep_null_keys`` they pass through unchanged.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    order_cols = [F.col(o) if isinstance(o, str) else o for o in order]
    packed = F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order_cols)],
                      *[F.col(c).alias(c) for c in rest])
    group = list(keys)
    if keep_null_keys:
        # each row with a NULL key is a group of its own, so one scan does
        any_null = F.lit(False)
        for k in keys:
            any_null = any_null | F.col(k).isNull()
        df = df.withColumn("_alone", F.when(any_null, F.monotonically_increasing_id()))
        group.append("_alone")
    return (df.groupBy(*group).agg(F.max(packed).alias("_best"))
            .select(*keys, *[F.col("_best").getField(c).alias(c) for c in rest])
            .select(*[c for c in df.columns if c != "_alone"]))
