"""Purchases kept as mergeable parts by day, for a matrix of any ``as_of``
without re-reading history (A1-A12, F0 incrementally).

Three tables by day or month, and an index:

- ``detail``: the latest copy of every purchase, by day;
- ``days``: parts by (customer, store) of each day;
- ``months``: parts by customer of each month;
- ``ids``: a keyed table, purchase id -> time of the stored copy.

A load looks its ids up in the index, so it knows which days hold an older copy
of what it brings: these and its own days are the changed days. Only they are
read and written again, and only their months; a re-sent purchase that moved to
another day leaves its old day. A copy older than the stored one is dropped; of
two copies with the same time the later load's stays. Purchases without an id
cannot be sent again and are added; purchases without a time have a "day" of
their own.

A matrix needs single days and stores only where an age window reaches, so it
reads the days of these two or so months and the months of all others.

One pointer names the version of every day, month and index run (see
``snapshot``): a load is visible as a whole or not at all, and a load that is
repeated under its ``tag`` changes nothing.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.config import Thresholds, as_of_text
from shoplens.functions.time import AGE_WINDOWS
from shoplens.operators import features
from shoplens.operators.dedup import keep_max
from shoplens.session import remove_path, scratch_table
from shoplens.sinks import keyed, snapshot

UNKNOWN = "none"  # the "day" of purchases without a time
DETAIL_DDL = ("purchase_id STRING, customer_id STRING, store_id STRING, purchase_ts TIMESTAMP, total_amount DOUBLE, "
              "payment_method STRING, is_delivery INT")
IDS_DDL = "purchase_id STRING, purchase_ts TIMESTAMP"


def day_sql(ts: str) -> str:
    return f"coalesce(date_format({ts}, 'yyyy-MM-dd'), '{UNKNOWN}')"


@dataclass(frozen=True)
class Rollup:
    spark: SparkSession
    root: str
    ids: keyed.Keyed
    th: Thresholds = Thresholds()
    tag: str | None = None
    versions: dict[str, dict[str, str]] = field(default_factory=lambda: {"detail": {}, "days": {}, "months": {}})

    # --------------------------------------------------------------- reading
    def _read(self, table: str, names, ddl: str) -> DataFrame:
        """The live versions of some days or months of a table."""
        live = self.versions[table]
        paths = [f"{self.root}/{table}/{live[x]}/p={x}" for x in sorted(names) if x in live]
        return self.spark.read.schema(ddl).parquet(*paths) if paths else self.spark.createDataFrame([], ddl)

    def detail(self, days) -> DataFrame:
        return self._read("detail", days, DETAIL_DDL)

    def days(self, days) -> DataFrame:
        return self._read("days", days, f"customer_id STRING, store_id STRING, day STRING, {features.DAY_PARTS_DDL}")

    def months(self, months) -> DataFrame:
        return self._read("months", months, f"customer_id STRING, month STRING, {features.DAY_PARTS_DDL}")

    def aggregates(self, as_of) -> DataFrame:
        """``features.customer_aggregates`` of everything loaded."""
        day = dt.date.fromisoformat(as_of_text(as_of)[:10])
        oldest = max(hi for _, hi in AGE_WINDOWS.values())
        near = {str(day - dt.timedelta(n))[:7] for n in range(oldest + 1)}
        single = [d for d in self.versions["days"] if d[:7] in near]
        whole = [m for m in self.versions["months"] if m not in near]
        parts = features.parts_of_days(self.days(single), as_of).unionByName(features.parts_of_months(self.months(whole)))
        return features.aggregates_of_parts(parts)

    def matrix(self, customers: DataFrame, as_of) -> DataFrame:
        """F0 of everything loaded."""
        joined = features.join_customers(features.conform_customers(customers), self.aggregates(as_of))
        return features.to_matrix(features.fill_defaults(joined), as_of, self.th)

    # --------------------------------------------------------------- loading
    def loaded(self, purchases: DataFrame, tag: str | None = None) -> Rollup:
        """The next state, with a batch of mart purchases; not committed yet."""
        if tag is not None and tag == self.tag:
            return self
        batch = keep_max(features.conform_purchases(purchases), ["purchase_id"], ["purchase_ts"])
        with scratch_table(batch, "rollup-batch") as rows:
            known = rows.where("purchase_id IS NOT NULL").select("purchase_id")
            old = self.ids.lookup(known).selectExpr("purchase_id", "purchase_ts AS old_ts", "true AS found")
            newer = rows.join(old, "purchase_id", "left").where("found IS NULL OR old_ts IS NULL OR purchase_ts >= old_ts")
            with scratch_table(newer, "rollup-winners") as winners:
                return self._with(winners, tag)

    def _with(self, winners: DataFrame, tag: str | None) -> Rollup:
        found = winners.selectExpr(f"{day_sql('purchase_ts')} AS day").unionByName(
            winners.where("found").selectExpr(f"{day_sql('old_ts')} AS day")).distinct()
        changed = {r.day for r in found.collect()}  # a number for each day of the calendar at most
        if not changed:
            return replace(self, tag=tag)
        new = winners.drop("old_ts", "found")
        kept = self.detail(changed).join(new.select("purchase_id"), "purchase_id", "left_anti")
        now = self._written("detail", kept.unionByName(new).selectExpr("*", f"{day_sql('purchase_ts')} AS p"), "customer_id", changed)
        by_day = features.day_level(now.detail(changed), self.th)
        now = now._written("days", by_day.withColumn("p", F.col("day")), "customer_id", changed)
        months = {d if d == UNKNOWN else d[:7] for d in changed}
        by_month = features.month_level(now.days([d for d in now.versions["days"] if (d if d == UNKNOWN else d[:7]) in months]))
        now = now._written("months", by_month.withColumn("p", F.col("month")), "customer_id", months)
        ids = now.ids.upserted(new.where("purchase_id IS NOT NULL").select("purchase_id", "purchase_ts"))
        return replace(now, ids=ids, tag=tag)

    def _written(self, table: str, rows: DataFrame, order: str, names) -> Rollup:
        """Rows with their place ``p``, as the new version of ``names``."""
        run = uuid.uuid4().hex
        path = f"{self.root}/{table}/{run}"
        rows.hint("rebalance", F.col("p")).sortWithinPartitions("p", order).write.partitionBy("p").parquet(path)
        have = {x[2:] for x in snapshot.names(self.spark, path) if x.startswith("p=")}
        live = {x: v for x, v in self.versions[table].items() if x not in names} | {x: run for x in have}
        return replace(self, versions={**self.versions, table: live})

    def commit(self) -> Rollup:
        """Makes this state the live one; files that neither it nor the state
        before names are removed."""
        text = json.dumps({"ids": self.ids.manifest(), "versions": self.versions, "tag": self.tag})
        snapshot.publish_pointer(self.spark, self.root, text)
        kept = [json.loads(t) for n in snapshot.versions(self.spark, self.root)[-snapshot.KEPT:]
                if (t := snapshot.read_pointer(self.spark, self.root, n))]
        snapshot.remove_pointers(self.spark, self.root)
        for table in self.versions:
            live = {run for m in kept for run in m["versions"][table].values()}
            for name in snapshot.names(self.spark, f"{self.root}/{table}"):
                if name not in live:
                    remove_path(self.spark, f"{self.root}/{table}/{name}")
        self.ids.remove_runs_but(r["id"] for m in kept for r in m["ids"]["runs"])
        return self


def open_rollup(spark: SparkSession, root: str, th: Thresholds = Thresholds(), buckets: int = 64) -> Rollup:
    """The live state of a rollup; a new, empty one where there is none."""
    root = root.rstrip("/")
    have = snapshot.versions(spark, root)
    text = snapshot.read_pointer(spark, root, have[-1]) if have else ""
    if not text:
        ids = keyed.create(spark, f"{root}/ids", IDS_DDL, ["purchase_id"], "purchase_ts", buckets, pointers=False)
        return Rollup(spark, root, ids, th)
    m = json.loads(text)
    return Rollup(spark, root, keyed.Keyed.of_manifest(spark, f"{root}/ids", m["ids"]), th, m["tag"], m["versions"])
