"""A stream source with offsets over a log of files.

A topic is a folder ``partition=P/segment=S`` of Parquet files with columns
``offset`` and ``value``; offsets count from 0 in each partition and a segment
holds the next ``segment_rows`` of them. :func:`append_to_topic` writes it with
Spark, :class:`ReplaySource` reads it as a stream: start at the earliest or
latest offset, at most ``maxOffsetsPerTrigger`` new records a batch over all
partitions, one task per segment, and a check that no offset between the last
batch and the oldest segment has gone.

Spark 4.1 does not tell a Python source where a restarted query stands before
it asks for the next end, so the source reads that from the query's own offset
log (option ``checkpoint``): batches after a restart obey the limit as well.
Under ``availableNow`` Spark asks for one end only, so limits need a
processing-time trigger.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.dataset as pads
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

SCHEMA = "partition int, offset long, value string"
ARROW = pa.schema([("partition", pa.int32()), ("offset", pa.int64()), ("value", pa.string())])


class OffsetsLost(RuntimeError):
    """Offsets that a query still has to read are no longer in the topic."""


def append_to_topic(records: DataFrame, topic: str, partition: Column, value: Column, order: list[str], next_offsets: dict[int, int] | None = None,
                    segment_rows: int = 10_000) -> None:
    """Append records in ``order`` to their partitions, from ``next_offsets``
    on (0 where it has none). Rows are numbered by :func:`dense_ids`, so a
    partition with most of the records is not numbered in one task."""
    from quayside.operators.keys import dense_ids

    rows = records.select(partition.cast("int").alias("partition"), value.alias("value"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)])
    keys = ["partition", *[f"_o{i}" for i in range(len(order))]]
    numbered = dense_ids(rows, keys, "_n").checkpoint()
    first = numbered.groupBy("partition").agg(F.min("_n").alias("_first"))  # a row a partition
    base = F.coalesce(*[F.when(F.col("partition") == p, F.lit(n)) for p, n in (next_offsets or {}).items()], F.lit(0).cast("long"))
    out = numbered.join(F.broadcast(first), "partition").withColumn("offset", F.col("_n") - F.col("_first") + base) \
        .withColumn("segment", F.floor(F.col("offset") / segment_rows).cast("long"))
    out.select("partition", "segment", "offset", "value").repartition("partition", "segment").sortWithinPartitions("offset") \
        .write.mode("append").partitionBy("partition", "segment").parquet(topic)


@dataclass
class Segment(InputPartition):
    partition: int
    paths: tuple[str, ...]
    start: int
    end: int


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def _folders(fs: pafs.FileSystem, path: str, key: str) -> list[tuple[int, str]]:
    found = fs.get_file_info(pafs.FileSelector(path, allow_not_found=True))
    return sorted((int(f.base_name.split("=")[1]), f.path) for f in found if f.base_name.startswith(f"{key}="))


class ReplayReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        options = {k.lower(): v for k, v in options.items()}  # as Spark hands them over
        self.topic = options["path"].rstrip("/")
        self.from_latest = options.get("startingoffsets", "earliest") == "latest"
        self.limit = int(options.get("maxoffsetspertrigger", 0))
        self.fail = options.get("failondataloss", "true").lower() == "true"
        self.checkpoint = options.get("checkpoint")
        self.position: dict[str, int] | None = None

    def segments(self) -> dict[int, list[tuple[int, int, str]]]:
        """Of each partition the files of its segments: first offset, end, path."""
        fs, root = _open(self.topic)
        out: dict[int, list[tuple[int, int, str]]] = {}
        for partition, folder in _folders(fs, root, "partition"):
            for _, segment in _folders(fs, folder, "segment"):
                for f in fs.get_file_info(pafs.FileSelector(segment)):
                    if f.base_name.endswith(".parquet") and not f.base_name.startswith(("_", ".")):
                        meta = pq.read_metadata(fs.open_input_file(f.path))
                        stats = [meta.row_group(g).column(0).statistics for g in range(meta.num_row_groups)]
                        if stats:
                            out.setdefault(partition, []).append((min(s.min for s in stats), max(s.max for s in stats) + 1, f.path))
        return {p: sorted(files) for p, files in out.items()}

    def initialOffset(self) -> dict:
        return {str(p): files[-1][1] if self.from_latest else files[0][0] for p, files in self.segments().items()}

    def _restart(self) -> dict[str, int] | None:
        """Where the query's own offset log ends, if there is one."""
        if not self.checkpoint:
            return None
        fs, root = _open(self.checkpoint.rstrip("/") + "/offsets")
        found = [f for f in fs.get_file_info(pafs.FileSelector(root, allow_not_found=True)) if f.base_name.isdigit()]
        if not found:
            return None
        last = max(found, key=lambda f: int(f.base_name))
        return json.loads(fs.open_input_stream(last.path).read().decode().splitlines()[-1])

    def latestOffset(self) -> dict:
        ends = {str(p): max(end for _, end, _ in files) for p, files in self.segments().items()}
        if self.position is None:
            self.position = self._restart() or self.initialOffset()
        if not self.limit:
            self.position = self.position | ends
            return dict(self.position)
        free, left = self.limit, sorted(ends, key=lambda p: ends[p] - self.position.get(p, 0))
        for n, p in enumerate(left):  # what one partition does not use goes to the others
            at = self.position.get(p, 0)
            take = max(0, min(ends[p] - at, free // (len(left) - n)))
            self.position[p], free = at + take, free - take
        return dict(self.position)

    def partitions(self, start: dict, end: dict) -> list[Segment]:
        held, out = self.segments(), []
        for p, to in end.items():
            at, files = start.get(p, 0), held.get(int(p), [])
            if to <= at:
                continue
            there = sum(min(to, e) - max(at, b) for b, e, _ in files if b < to and e > at)
            if there < to - at and self.fail:
                raise OffsetsLost(f"partition {p}: offsets {at} to {to} are wanted, {there} of {to - at} are there")
            out += [Segment(int(p), (path,), max(at, b), min(to, e)) for b, e, path in files if b < to and e > at]
        return out

    def read(self, partition: Segment) -> Iterator[pa.RecordBatch]:
        fs, _ = _open(self.topic)
        wanted = (pads.field("offset") >= partition.start) & (pads.field("offset") < partition.end)
        for batch in pads.dataset(list(partition.paths), filesystem=fs, format="parquet").to_batches(columns=["offset", "value"], filter=wanted):
            columns = [pa.array([partition.partition] * batch.num_rows, pa.int32()), batch.column(0).cast(pa.int64()), batch.column(1).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(columns, schema=ARROW)


class ReplaySource(DataSource):
    """``spark.readStream.format("replay").option("path", topic)``."""

    @classmethod
    def name(cls) -> str:
        return "replay"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> ReplayReader:
        return ReplayReader(dict(self.options))
