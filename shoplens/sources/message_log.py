"""L0 message log (S5, K2): a topic log in files, as a Spark data source.

A log is a folder of segments and numbered commits. A write adds rows of
(topic, value) to partitions of their topics: every task writes segments of its
own, and one commit, written last, names them and gives them their offsets. So a
log only grows, rows of a write are seen as a whole or not at all, and segments of
a write that was stopped are never read.

Read it as a batch or a stream of (topic, partition, offset, value), in Arrow
batches. A stream's position is the number of the last commit it has read; a
restart goes on after that, and reads only later commits and their segments.

    message_log.register(spark)
    df.write.format("message_log").mode("append").save(root)
    spark.readStream.format("message_log").option("topic", "retail.purchases.l0").load(root)

Options: ``path``; ``topic`` (all if not given); ``partitions`` of a topic when
writing (8). One writer at a time; a second one that takes the same commit number
fails. Files are reached through pyarrow's file systems (local, HDFS, S3), as they
are read and written by Python workers.
"""

from __future__ import annotations

import json
import sys
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    DataSourceStreamReader,
    InputPartition,
    WriterCommitMessage,
)

SCHEMA = "topic STRING, partition INT, offset LONG, value STRING"
ARROW = pa.schema([("topic", pa.string()), ("partition", pa.int32()), ("offset", pa.int64()), ("value", pa.string())])
SEGMENT = pa.schema([("value", pa.string())])
BATCH_ROWS = 8192


class LogError(RuntimeError):
    """Another writer committed at the same time, or a commit is missing."""


class Folder:
    """A log's folder: commits and segments by name."""

    def __init__(self, path: str):
        if not path:
            raise ValueError("message_log needs a path")
        self.path = path.rstrip("/")

    def at(self, *names: str) -> tuple[pafs.FileSystem, str]:
        whole = "/".join([self.path, *names])
        if "://" not in whole and not whole.startswith("file:"):
            return pafs.LocalFileSystem(), whole
        return pafs.FileSystem.from_uri("file://" + whole[5:] if whole.startswith("file:/") and "://" not in whole else whole)

    def commits(self, after: int = -1) -> list[int]:
        """Numbers of the commits later than ``after``, without a gap."""
        system, place = self.at("commits")
        found = system.get_file_info(pafs.FileSelector(place, allow_not_found=True))
        numbers = sorted(int(f.base_name[:-5]) for f in found if f.base_name.endswith(".json") and f.base_name[0].isdigit())
        if numbers != list(range(len(numbers))):
            raise LogError(f"{self.path} misses a commit")
        return numbers[after + 1:]

    def commit(self, n: int) -> dict:
        system, place = self.at("commits", f"{n:020d}.json")
        with system.open_input_stream(place) as f:
            return json.loads(f.read())

    def add_commit(self, n: int, content: dict) -> None:
        system, place = self.at("commits", f"{n:020d}.json")
        system.create_dir(place.rpartition("/")[0], recursive=True)
        tmp = f"{place.rpartition('/')[0]}/_{uuid.uuid4().hex}"
        with system.open_output_stream(tmp) as f:
            f.write(json.dumps(content).encode())
        if system.get_file_info(place).type != pafs.FileType.NotFound:
            raise LogError(f"another writer made commit {n} of {self.path}")
        system.move(tmp, place)


class Segment(InputPartition):
    """One segment and the offset of its first row."""

    def __init__(self, topic: str, partition: int, file: str, base: int):
        super().__init__((topic, partition, file, base))


class _Read:
    def __init__(self, options: dict):
        self.folder = Folder(options.get("path", ""))
        self.topic = options.get("topic")

    def segments(self, numbers: list[int]) -> list[Segment]:
        return [Segment(s["topic"], s["partition"], s["file"], s["base"]) for n in numbers
                for s in self.folder.commit(n)["segments"] if self.topic in (None, s["topic"])]

    def read(self, part: Segment) -> Iterator[pa.RecordBatch]:
        if part is None:
            return
        topic, partition, file, base = part.value
        system, place = self.folder.at("segments", file)
        with system.open_input_file(place) as f:
            for batch in pq.ParquetFile(f).iter_batches(BATCH_ROWS):
                n = batch.num_rows
                yield pa.RecordBatch.from_arrays(
                    [pa.array([topic] * n, pa.string()), pa.array([partition] * n, pa.int32()),
                     pa.array(range(base, base + n), pa.int64()), batch.column(0)], schema=ARROW)
                base += n


class LogReader(_Read, DataSourceReader):
    def partitions(self):
        return self.segments(self.folder.commits())


class LogStreamReader(_Read, DataSourceStreamReader):
    def initialOffset(self) -> dict:
        return {"commit": -1}

    def latestOffset(self) -> dict:
        return {"commit": (self.folder.commits() or [-1])[-1]}

    def partitions(self, start: dict, end: dict):
        return self.segments([n for n in self.folder.commits(start["commit"]) if n <= end["commit"]])


class Written(WriterCommitMessage):
    def __init__(self, segments: list[dict]):
        self.segments = segments


class LogWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.folder = Folder(options.get("path", ""))
        self.partitions = int(options.get("partitions", "8"))
        if self.partitions < 1:
            raise ValueError("partitions is 1 or more")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        """A task's rows; whole Arrow batches go to one partition in turn."""
        turn = TaskContext.get().partitionId()
        files: dict[tuple[str, int], tuple[dict, pq.ParquetWriter, object]] = {}
        for batch in iterator:
            topics = batch.column(batch.schema.get_field_index("topic"))
            values = batch.column(batch.schema.get_field_index("value")).cast(pa.string())
            for topic in pc.unique(topics).to_pylist():
                if topic is None:
                    raise ValueError("a message without a topic")
                some = values.filter(pc.equal(topics, topic))
                key = (topic, turn % self.partitions)
                if key not in files:
                    name = f"{uuid.uuid4().hex}.parquet"
                    system, place = self.folder.at("segments", name)
                    system.create_dir(place.rpartition("/")[0], recursive=True)
                    out = system.open_output_stream(place)
                    files[key] = ({"topic": topic, "partition": key[1], "file": name, "rows": 0},
                                  pq.ParquetWriter(out, SEGMENT, compression="zstd"), out)
                info, writer, _ = files[key]
                writer.write_batch(pa.RecordBatch.from_arrays([some], schema=SEGMENT))
                info["rows"] += len(some)
            turn += 1
        for _, writer, out in files.values():
            writer.close()
            out.close()
        return Written([info for info, _, _ in files.values()])

    def commit(self, messages) -> None:
        """Offsets go on where the last commit left them."""
        have = self.folder.commits()
        ends = self.folder.commit(have[-1])["ends"] if have else {}
        segments = []
        for m in messages:
            for s in m.segments if m is not None else []:
                of_topic = ends.setdefault(s["topic"], {})
                base = of_topic.get(str(s["partition"]), 0)
                segments.append({**s, "base": base})
                of_topic[str(s["partition"])] = base + s["rows"]
        if segments:
            self.folder.add_commit(len(have), {"segments": segments, "ends": ends})

    def abort(self, messages) -> None:
        """Nothing to undo: segments that no commit names are never read."""


class MessageLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return "message_log"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> LogReader:
        return LogReader(self.options)

    def streamReader(self, schema) -> LogStreamReader:
        return LogStreamReader(self.options)

    def writer(self, schema, overwrite: bool) -> LogWriter:
        if overwrite:
            raise ValueError("a log is only appended to")
        if not {"topic", "value"} <= set(schema.names):
            raise ValueError("messages have the columns topic and value")
        return LogWriter(self.options)


def register(spark: SparkSession) -> None:
    """Makes ``message_log`` known to the session. Workers get this module by
    value, so they need no copy of the package."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(MessageLog)


def messages(spark: SparkSession, root: str, topic: str | None = None) -> DataFrame:
    """All messages of a log so far."""
    register(spark)
    r = spark.read.format("message_log")
    return (r if topic is None else r.option("topic", topic)).load(root)


def message_stream(spark: SparkSession, root: str, topic: str | None = None) -> DataFrame:
    """A log's messages as a stream."""
    register(spark)
    r = spark.readStream.format("message_log")
    return (r if topic is None else r.option("topic", topic)).load(root)


def append(rows: DataFrame, root: str, partitions: int = 8) -> None:
    """Adds (topic, value) rows to a log."""
    register(rows.sparkSession)
    rows.select("topic", "value").write.format("message_log").option("partitions", partitions).mode("append").save(root)
