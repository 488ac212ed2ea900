"""Streaming CDC apply and streaming risk enrichment."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quayside.operators.broadcast import DEFAULT_MAX_BROADCAST_ROWS
from quayside.operators.geojoin import points_broadcastable, prepare_points
from quayside.operators.cdc import OP_DELETE, apply_changes, latest_changes, live_rows
from quayside.plans.risk import risk_fact
from quayside.sinks.bucketed import merge_into_bucketed, read_bucketed, replace_into_bucketed
from quayside.sinks.tables import (MAX_RECORDS_PER_FILE, path_exists, publish, read_marker, read_published,
                                   write_marker)


def read_change_stream(spark: SparkSession, fmt: str, path: str | None = None, *,
                       schema=None, options: dict | None = None,
                       max_per_trigger: int | None = None) -> DataFrame:
    """A stream of change messages.

    ``fmt="kafka"``: options ``kafka.bootstrap.servers``, ``subscribe``; the
    rate limit becomes ``maxOffsetsPerTrigger``. File formats (``json``,
    ``text``, ``parquet``) read new files under ``path``; the rate limit
    becomes ``maxFilesPerTrigger``. Kafka starts from ``earliest`` unless told
    otherwise, so a first run does not skip what is already in the topic.
    """
    reader = spark.readStream.format(fmt)
    opts = dict(options or {})
    if fmt == "kafka":
        opts.setdefault("startingOffsets", "earliest")
        if max_per_trigger:
            opts["maxOffsetsPerTrigger"] = str(max_per_trigger)
    elif max_per_trigger:
        opts["maxFilesPerTrigger"] = str(max_per_trigger)
    if schema is not None:
        reader = reader.schema(schema)
    reader = reader.options(**opts)
    return reader.load(path) if path else reader.load()


def run_stream(df: DataFrame, on_batch: Callable[[DataFrame, int], None], checkpoint: str, *,
               trigger: dict | None = None, name: str | None = None) -> StreamingQuery:
    """Start ``df.writeStream.foreachBatch(on_batch)`` with a checkpoint.

    ``trigger`` defaults to ``{"availableNow": True}`` (drain what is there,
    then stop); production runs pass ``{"processingTime": "30 seconds"}``.
    """
    w = df.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start()


_BATCH_MARK = "_LAST_BATCH"
MONTHS_OPEN = 12  # files that a task of the risk stream holds open; with more months its rows are sorted by month


def checkpoint_scope(spark: SparkSession, checkpoint: str) -> str:
    """A name for a checkpoint that lasts as long as it does. Batch ids are
    told apart by it: a new checkpoint counts from 0 again."""
    marker = f"{checkpoint.rstrip('/')}/_SCOPE"
    scope = read_marker(spark, marker)
    if scope is None:
        scope = uuid.uuid4().hex[:12]
        write_marker(spark, marker, scope)
    return scope


def stream_apply_changes(changes: DataFrame, state_base: str, checkpoint: str, keys: list[str], *,
                         op: str = "op", seq: str | list[str] = "seq", value_cols: list[str] | None = None,
                         mode: str = "upsert", trigger: dict | None = None,
                         layout: str = "bucketed", buckets: int = 4096) -> StreamingQuery:
    """Fold each micro-batch into the state table published at ``state_base``.

    Per batch (an empty batch is skipped, F8): latest change per key, merge
    with the current state, publish. A batch id at or below the last one
    committed under the same checkpoint is skipped, and a replay of a batch whose commit was cut short is harmless:
    a change that is not newer than the stored sequence is ignored.
    Deleted keys stay as tombstones so batches may arrive out of order; read
    the state with :func:`read_stream_state`.

    ``layout="versioned"`` publishes the whole state as a new version per
    batch (simple, atomic for readers). ``layout="bucketed"`` rewrites only
    the hash buckets a batch touches (see :mod:`quayside.sinks.bucketed`),
    so the per-batch cost follows the batch size, not the table size. Failures propagate and stop the
    query (nothing is silently dropped).
    """
    if layout not in ("versioned", "bucketed"):
        raise ValueError("layout must be 'versioned' or 'bucketed'")
    scope = checkpoint_scope(changes.sparkSession, checkpoint)
    mark = f"{state_base.rstrip('/')}/{_BATCH_MARK}-{scope}"

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if layout == "bucketed":
            if not batch.isEmpty():
                batch = batch.persist()
                try:
                    merge_into_bucketed(spark, state_base, batch, keys, batch_id=batch_id, buckets=buckets, op=op,
                                        seq=seq, value_cols=value_cols, mode=mode, scope=scope)
                finally:
                    batch.unpersist()
            return
        last = read_marker(spark, mark)
        if (last is not None and batch_id <= int(last)) or batch.isEmpty():
            return
        current = read_published(spark, state_base)
        publish(apply_changes(current, batch, keys, op=op, seq=seq, value_cols=value_cols, mode=mode,
                              tombstones=True), state_base)
        write_marker(spark, mark, str(batch_id))

    return run_stream(changes, on_batch, checkpoint, trigger=trigger, name=None)


def read_stream_state(spark: SparkSession, state_base: str) -> DataFrame | None:
    """Live rows of a stream's state table, in either layout."""
    if path_exists(spark, f"{state_base.rstrip('/')}/data"):
        return read_bucketed(spark, state_base)
    state = read_published(spark, state_base)
    return None if state is None else live_rows(state)


def stream_risk(quakes: DataFrame, ports: DataFrame, fact_path: str, checkpoint: str, *,
                key: str = "unid", seq: str | None = None, op: str | None = None,
                trigger: dict | None = None, risk_options: dict | None = None,
                mode: str = "append", buckets: int = 4096,
                max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> StreamingQuery:
    """Append the risk fact of each micro-batch of quake changes.

    Each batch is collapsed to the latest change per quake (deletes are not
    scored), scored against the static port table, and written under
    ``EVENT_YEAR/EVENT_MONTH/run=<checkpoint>/batch_id=<n>`` with dynamic
    partition overwrite, so a replayed batch replaces its own output instead
    of appending it twice, and a new checkpoint, whose ids start at 0 again,
    leaves the output of the old one alone. The port-table broadcast decision
    is made once, not per batch.

    ``mode="replace"`` keeps one set of rows per quake instead: the fact is a
    table bucketed by quake key, and a re-scored quake's rows replace its
    earlier ones, rewriting only the buckets of the batch's quakes (read it
    with :func:`quayside.sinks.bucketed.read_bucketed`, ``live=False``). With
    ``seq`` the rows keep it (``_SEQ``), and an older change that comes in a
    later batch does not replace them.
    """
    port_cols = ports.select("port_key", "port_latitude", "port_longitude")
    broadcast_ok = points_broadcastable(port_cols, max_broadcast_rows)
    opts = dict(risk_options or {})
    # the static side of every batch's join, placed on the grid once; kept
    # in memory only when it passed the broadcast bound
    prepared = prepare_points(port_cols, mode=opts.get("mode", "box"), broadcast=broadcast_ok)
    if broadcast_ok:
        prepared = prepared.coalesce(8).persist()
    parts = ["EVENT_YEAR", "EVENT_MONTH", "run", "batch_id"]
    scope = checkpoint_scope(quakes.sparkSession, checkpoint)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        b = batch.persist()  # scored and joined back: read the source once
        try:
            if seq is not None:
                b = latest_changes(b, [key], seq)
            if op is not None:
                b = b.filter(F.col(op).isNull() | (F.col(op) != OP_DELETE))
            fact = risk_fact(b, ports, broadcast_ports=broadcast_ok, prepared_ports=prepared, **opts) \
                .withColumns({"run": F.lit(scope), "batch_id": F.lit(batch_id)})
            if mode == "replace":
                rows = fact.drop("run", "batch_id")
                if seq is not None:
                    order = b.select(F.col(key).cast("string").alias("EARTHQUAKE_KEY"), F.col(seq).alias("_SEQ"))
                    rows = rows.join(order, "EARTHQUAKE_KEY")
                rows = rows.persist()  # scored once: read for the bucket list, the merge and the write
                try:
                    replace_into_bucketed(b.sparkSession, fact_path, rows, ["EARTHQUAKE_KEY"], batch_id=batch_id,
                                          buckets=buckets, seq=None if seq is None else "_SEQ", scope=scope)
                finally:
                    rows.unpersist()
                return
            # the pairs lie by day and place already: they outnumber the quakes and are written where they are made,
            # unsorted, to as many files at a time as a task has months (the session is the stream's own)
            b.sparkSession.conf.set("spark.sql.maxConcurrentOutputFileWriters", MONTHS_OPEN)
            (fact.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).partitionBy(*parts).parquet(fact_path))
        finally:
            batch.unpersist()

    return run_stream(quakes, on_batch, checkpoint, trigger=trigger)
