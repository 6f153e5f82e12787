"""Keyed tables merged on read (U1-U6): a base and a few runs of changes.

A row with a NULL in its key is no row of the table and is left out of what is
loaded (``upsert.missing_ids`` counts such rows beforehand).

A table is a set of *runs*. A run holds one row per key, dealt into hash
buckets (one folder each) and sorted by key inside. An upsert writes its batch
as one more run and nothing else, so its cost follows the batch, not the table.
A read merges runs by key: the greatest ``seq`` wins (NULL lowest), then the
newest run, or without ``newest_wins`` the greatest row, so that the order in
which batches arrive does not matter. Without ``seq`` the newest run wins.

Runs are compacted in levels: ``fanout`` runs of a level become one of the next,
and when all changes together exceed ``1 / fanout`` of the base, they and the
base become a new base. A row is rewritten a few times in its life, however many
batches come.

With each run goes a *filter*: a Bloom filter per bucket, kept as rows (bucket,
word, bits). A load that must not touch existing keys asks the filters, and reads
only the key columns of buckets with a possible hit.

A table's state is a manifest (which runs are live); committing writes it as the
next numbered pointer (see ``snapshot``). Several tables can also be committed
together by keeping their manifests in one pointer: ``Keyed`` values are
immutable, and ``upserted`` returns the next one without committing it.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shoplens.operators.dedup import keep_max
from shoplens.operators.upsert import KeyError_, _copies, last_wins
from shoplens.session import remove_path, scratch_table
from shoplens.sinks import snapshot

BUCKET = "_bucket"
RUN = "_run"
PROBES = 4  # bits set per key
BITS_PER_KEY = 10  # about 1 % of strange keys pass


@dataclass(frozen=True)
class Run:
    id: str
    no: int  # newer runs have larger numbers
    level: int  # -1: the base
    rows: int
    buckets: tuple[int, ...]  # those that have rows
    bits: int  # size of each bucket's filter


@dataclass(frozen=True)
class Keyed:
    spark: SparkSession
    root: str
    schema: StructType
    keys: tuple[str, ...]
    seq: str | None
    buckets: int
    fanout: int
    runs: tuple[Run, ...] = ()
    tag: str | None = None
    newest_wins: bool = True  # between rows of the same ``seq``

    # ------------------------------------------------------------ manifests
    def manifest(self) -> dict:
        return {"schema": self.schema.jsonValue(), "keys": self.keys, "seq": self.seq, "buckets": self.buckets,
                "fanout": self.fanout, "runs": [vars(r) for r in self.runs], "tag": self.tag, "newest_wins": self.newest_wins}

    @classmethod
    def of_manifest(cls, spark: SparkSession, root: str, m: dict) -> Keyed:
        runs = tuple(Run(**{**r, "buckets": tuple(r["buckets"])}) for r in m["runs"])
        return cls(spark, root.rstrip("/"), StructType.fromJson(m["schema"]), tuple(m["keys"]), m["seq"], m["buckets"],
                   m["fanout"], runs, m["tag"], m["newest_wins"])

    def commit(self, tag: str | None = None) -> Keyed:
        """Makes this state the live one; runs that neither it nor the state
        before names are removed."""
        done = replace(self, tag=tag)
        snapshot.publish_pointer(self.spark, self.root, json.dumps(done.manifest()))
        live = set()
        for n in snapshot.versions(self.spark, self.root)[-snapshot.KEPT:]:
            text = snapshot.read_pointer(self.spark, self.root, n)
            live |= {r["id"] for r in json.loads(text)["runs"]} if text else set()
        snapshot.remove_pointers(self.spark, self.root)
        self.remove_runs_but(live)
        return done

    def remove_runs_but(self, live: Iterable[str]) -> None:
        live = set(live)
        for name in snapshot.names(self.spark, f"{self.root}/runs"):
            if name not in live:
                remove_path(self.spark, f"{self.root}/runs/{name}")
                remove_path(self.spark, f"{self.root}/filters/{name}")

    # --------------------------------------------------------------- reading
    def _data(self, run: Run, buckets: Iterable[int] | None = None) -> DataFrame:
        fields = StructType([*self.schema.fields]).add(BUCKET, "integer")
        rows = self.spark.read.schema(fields).parquet(f"{self.root}/runs/{run.id}")
        if buckets is not None:
            rows = rows.where(F.col(BUCKET).isin([int(b) for b in buckets]))
        return rows.withColumn(RUN, F.lit(run.no))

    def _merged(self, parts: Sequence[DataFrame]) -> DataFrame:
        rows = parts[0]
        for p in parts[1:]:
            rows = rows.unionByName(p)
        if len(parts) == 1:
            return rows
        order = [self.seq, *([RUN] if self.newest_wins else [])] if self.seq else [RUN]
        return keep_max(rows, [*self.keys, BUCKET], order, keep_null_keys=False)

    @property
    def base(self) -> Run | None:
        return next((r for r in self.runs if r.level < 0), None)

    @property
    def changes(self) -> tuple[Run, ...]:
        return tuple(r for r in self.runs if r.level >= 0)

    def _rows(self, buckets: Iterable[int] | None = None) -> DataFrame:
        """Live rows with BUCKET and RUN. Changes are merged among themselves;
        the base is streamed against them and never sorted."""
        changed = [self._data(r, buckets) for r in self.changes]
        if self.base is None:
            return self._merged(changed)
        base = self._data(self.base, buckets)
        if not changed:
            return base
        new = self._merged(changed)
        on = [BUCKET, *self.keys]
        touched = new.select(*on)
        if self.seq:
            new = self._merged([new, base.join(touched, on, "left_semi")])
        return base.join(touched, on, "left_anti").unionByName(new)

    def read(self, buckets: Iterable[int] | None = None) -> DataFrame:
        """All live rows, or those of some buckets."""
        if not self.runs:
            return self.spark.createDataFrame([], self.schema)
        return self._rows(buckets).select(*self.schema.names)

    def lookup(self, wanted: DataFrame) -> DataFrame:
        """Live rows of the keys in ``wanted`` (settled; each key once). Only
        buckets and runs that may have one of them are read."""
        return self._at(self.possible(wanted))

    def _at(self, hits: DataFrame) -> DataFrame:
        with_hits = self._hit_buckets(hits)
        parts = [self._data(r, with_hits[r.no]).join(hits.where(F.col(RUN) == r.no).select(BUCKET, *self.keys), [BUCKET, *self.keys], "left_semi")
                 for r in self.runs if r.no in with_hits]
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        return self._merged(parts).select(*self.schema.names)

    # --------------------------------------------------------------- filters
    def _bucketed(self, rows: DataFrame) -> DataFrame:
        bucket = F.pmod(F.xxhash64(*[F.col(k) for k in self.keys]), F.lit(self.buckets)).cast("int")
        return rows.withColumn(BUCKET, bucket)

    def _probes(self, rows: DataFrame) -> DataFrame:
        """Each key's bit places, before they are cut to a filter's size."""
        one, two = (F.xxhash64(F.lit(salt), *[F.col(k) for k in self.keys]) for salt in ("first", "second"))
        return rows.withColumns({"_one": one, "_two": two}).withColumn("_i", F.explode(F.array(*[F.lit(i) for i in range(PROBES)])))

    def _place(self, bits) -> str:
        return f"pmod(shiftrightunsigned(_one, 8) + _i * shiftrightunsigned(_two, 8), {bits})"

    def _write_filter(self, run: Run) -> None:
        rows = self._probes(self._data(run).select(BUCKET, *self.keys)).withColumn("_at", F.expr(self._place(run.bits)))
        words = rows.groupBy(BUCKET, F.expr("_at div 64").alias("word")).agg(
            F.expr("bit_or(shiftleft(1L, CAST(_at % 64 AS INT)))").alias("bits"))
        words.repartitionByRange(BUCKET).sortWithinPartitions(BUCKET, "word").write.parquet(f"{self.root}/filters/{run.id}")

    def possible(self, wanted: DataFrame) -> DataFrame:
        """_run, _bucket, keys: which keys of ``wanted`` a run may hold, by the
        filters alone; none is missed."""
        asked = self._probes(self._bucketed(wanted.select(*self.keys)))
        found = None
        for run in self.runs:
            words = self.spark.read.schema(f"{BUCKET} INT, word LONG, bits LONG").parquet(f"{self.root}/filters/{run.id}")
            mine = asked.where(F.col(BUCKET).isin(list(run.buckets))).withColumn("_at", F.expr(self._place(run.bits)))
            hit = (mine.withColumn("word", F.expr("_at div 64")).join(words, [BUCKET, "word"])
                   .where("shiftrightunsigned(bits, CAST(_at % 64 AS INT)) & 1L = 1L")
                   .groupBy(BUCKET, *self.keys).agg(F.count_distinct("_i").alias("set")).where(f"set = {PROBES}")
                   .select(F.lit(run.no).alias(RUN), BUCKET, *self.keys))
            found = hit if found is None else found.unionByName(hit)
        if found is None:
            return self._bucketed(wanted.select(*self.keys)).where("false").select(F.lit(0).alias(RUN), BUCKET, *self.keys)
        return found

    def _hit_buckets(self, hits: DataFrame) -> dict[int, list[int]]:
        """Per run, the buckets with a possible hit (at most ``buckets`` numbers a run)."""
        out: dict[int, list[int]] = {}
        for r in hits.select(RUN, BUCKET).distinct().collect():
            out.setdefault(r[RUN], []).append(r[BUCKET])
        return out

    def conflicts(self, batch: DataFrame) -> DataFrame:
        """Keys of ``batch`` (settled) that an insert would reject: those
        that exist, and those repeated in the batch."""
        copies = _copies(batch.dropna(subset=list(self.keys)), self.keys)
        hits = self.possible(copies)
        with_hits = self._hit_buckets(hits)
        dup = copies.where("copies > 1").select(*self.keys, F.lit("duplicate_in_batch").alias("reason"))
        parts = [self._data(r, with_hits[r.no]).select(BUCKET, *self.keys)
                 .join(hits.where(F.col(RUN) == r.no).select(BUCKET, *self.keys), [BUCKET, *self.keys], "left_semi")
                 for r in self.runs if r.no in with_hits]
        for p in parts:
            dup = dup.unionByName(p.select(*self.keys, F.lit("exists").alias("reason")))
        return dup.distinct() if len(parts) > 1 else dup

    # --------------------------------------------------------------- writing
    def _write(self, rows: DataFrame, no: int, level: int) -> Run:
        """Rows with BUCKET as a new run. Small buckets share a task, and a
        bucket over the advisory partition size is split among several."""
        run_id = uuid.uuid4().hex
        obs = Observation("rows")
        path = f"{self.root}/runs/{run_id}"
        (rows.select(*self.schema.names, BUCKET).observe(obs, F.count(F.lit(1)).alias("n")).hint("rebalance", F.col(BUCKET))
         .sortWithinPartitions(BUCKET, *self.keys).write.partitionBy(BUCKET).parquet(path))
        n = obs.get.get("n", 0)
        buckets = tuple(sorted(int(x.rpartition("=")[2]) for x in snapshot.names(self.spark, path) if x.startswith(f"{BUCKET}=")))
        bits = max(64, 1 << math.ceil(math.log2(max(1, BITS_PER_KEY * n / max(1, len(buckets))))))
        run = Run(run_id, no, level, n, buckets, bits)
        if n:
            self._write_filter(run)
        return run

    def _latest(self, batch: DataFrame) -> DataFrame:
        return last_wins(batch.select(*self.schema.names).dropna(subset=list(self.keys)), list(self.keys), self.seq)

    def _next(self) -> int:
        return max((r.no for r in self.runs), default=0) + 1

    def loaded(self, rows: DataFrame) -> Keyed:
        """These rows alone, whatever was there; one row per key."""
        run = self._write(self._bucketed(self._latest(rows)), self._next(), -1)
        return replace(self, runs=(run,) if run.rows else ())

    def upserted(self, batch: DataFrame) -> Keyed:
        """``batch`` as one more run, then what is due of compaction."""
        run = self._write(self._bucketed(self._latest(batch)), self._next(), 0)
        if not run.rows:
            return self
        return replace(self, runs=(*self.runs, run)).compacted()

    def inserted(self, batch: DataFrame, sample: int = 3) -> Keyed:
        """``batch`` if none of its keys exists or is repeated; otherwise
        an error that names some, and nothing is written."""
        with scratch_table(batch.select(*self.schema.names), "insert-batch") as rows:
            bad = self.conflicts(rows).limit(sample).collect()
            if bad:
                raise KeyError_(f"insert would collide on {len(bad)}+ keys; first: {[r.asDict() for r in bad]}")
            return self.upserted(rows)

    def compacted(self) -> Keyed:
        now = self
        level = 0
        while True:
            changes = now.changes
            rows = sum(r.rows for r in changes)
            if len(changes) > 1 and (now.base is None and len(changes) >= now.fanout
                                     or now.base is not None and rows * now.fanout >= now.base.rows):
                run = now._write(now._rows(), max(r.no for r in now.runs), -1)
                return replace(now, runs=(run,))
            some = [r for r in changes if r.level == level]
            if len(some) < now.fanout:
                if not any(r.level > level for r in changes):
                    return now
                level += 1
                continue
            run = now._write(now._merged([now._data(r) for r in some]), max(r.no for r in some), level + 1)
            now = replace(now, runs=(*[r for r in now.runs if r not in some], run))

    def stats(self, batch: DataFrame) -> DataFrame:
        """Counts of what an upsert of ``batch`` (settled) would do; only
        buckets with a possible hit are read."""
        new = self._latest(batch)
        vals = [c for c in self.schema.names if c not in self.keys]
        old = self.lookup(new).select(*self.keys, F.struct(*vals).alias("_old"))
        both = new.select(*self.keys, F.struct(*vals).alias("_new")).join(old, list(self.keys), "left")
        total = both.agg(F.count(F.lit(1)).alias("affected"), F.count("_old").alias("matched"),
                         F.count_if(F.col("_old").isNotNull() & ~F.col("_old").eqNullSafe(F.col("_new"))).alias("modified"))
        return total.selectExpr("affected - matched AS inserted", "matched", "modified", "affected")


def create(spark: SparkSession, root: str, schema: StructType | str, keys: Sequence[str], seq: str | None = None,
           buckets: int = 64, fanout: int = 4, pointers: bool = True, newest_wins: bool = True) -> Keyed:
    """An empty table. ``buckets``: about one per few hundred MB of the table.
    Without ``pointers`` its manifest is kept by another table."""
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if not keys or not set(keys) <= set(schema.names) or (seq and seq not in schema.names):
        raise ValueError("keys and seq are columns of the table")
    if pointers and not snapshot.versions(spark, root):
        snapshot.publish_pointer(spark, root, "")
    return Keyed(spark, root.rstrip("/"), schema, tuple(keys), seq, buckets, fanout, newest_wins=newest_wins)


def open_table(spark: SparkSession, root: str) -> Keyed | None:
    """The live state of a table, or None where there is none."""
    have = snapshot.versions(spark, root)
    if not have and snapshot.names(spark, f"{root.rstrip('/')}/runs"):
        raise snapshot.SnapshotError(f"{root} holds runs but no pointer")
    text = snapshot.read_pointer(spark, root, have[-1]) if have else ""
    return Keyed.of_manifest(spark, root, json.loads(text)) if text else None
