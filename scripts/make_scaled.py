"""A copy of the shop tables with ``n`` times the rows, keys shifted, for
benchmarks where data and not plan building takes the time.

Usage: python scripts/make_scaled.py SF_DIR OUT_DIR N
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from shoplens.session import get_session  # noqa: E402

# Table -> its key columns; the other tables are copied as they are.
SHIFTED = {"customer": ("c_custkey",), "orders": ("o_orderkey", "o_custkey"), "lineitem": ("l_orderkey",),
           "events": ("event_id", "user_id")}
COPIED = ("region", "nation", "part", "supplier")


def main() -> None:
    source, out, n = sys.argv[1], sys.argv[2], int(sys.argv[3])
    spark = get_session(master="local[8]", shuffle_partitions=8)
    for name, keys in SHIFTED.items():
        rows = spark.read.parquet(f"{source}/{name}.parquet")
        rows = rows.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
        for k in keys:
            # a multiple of 840 keeps every remainder that the fixtures look at
            rows = rows.withColumn(k, (F.col(k) + F.col("_copy") * F.lit(840_000_000)).cast(rows.schema[k].dataType))
        rows.drop("_copy").write.parquet(f"{out}/{name}.parquet")
    for name in COPIED:
        spark.read.parquet(f"{source}/{name}.parquet").write.parquet(f"{out}/{name}.parquet")
    spark.stop()


if __name__ == "__main__":
    main()
