"""Keyed state table with bucket-scoped rewrites.

The table is Parquet partitioned by ``_bucket = pmod(xxhash64(keys), B)``.
Merging a change batch touches only the buckets its keys hash to: they are
read with a literal partition filter, merged, written to a staging folder
named after the batch, and then copied over the live buckets with dynamic
partition overwrite. Untouched buckets are neither read nor written, so the
cost of a batch follows the batch, not the table.

Batch ids count per checkpoint, so a batch is known by its checkpoint's scope
and its id: after a checkpoint is reset, ids start again without being taken
for replays (a replayed change is not newer than the stored sequence and does
nothing).

Crash safety: the staging folder is complete (``_STAGED``) before the live
table is touched. If the copy is interrupted, the replayed batch finds the
complete staging folder, skips the merge and repeats the copy; after the batch
is recorded the folder is removed. The state
keeps tombstones, so a bucket whose keys were all deleted still has rows and
is overwritten like any other; a replace (``replace_into_bucketed``) always
writes the new rows of every touched key.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.operators.cdc import fold_changes, live_rows, merge_folded, sequence
from quayside.sinks.tables import MAX_RECORDS_PER_FILE, path_exists, read_marker, remove_path, replace_by_key, write_marker

BUCKET = "_bucket"
_BUCKETS_FILE = "_BUCKETS"
_BATCH_FILE = "_LAST_BATCH"
_COMPLETE_FILE = "_STAGED"


def bucket_of(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")


def _check_buckets(spark: SparkSession, base: str, buckets: int) -> None:
    marker = f"{base}/{_BUCKETS_FILE}"
    stored = read_marker(spark, marker)
    if stored is None:
        write_marker(spark, marker, str(buckets))
    elif int(stored) != buckets:
        raise ValueError(f"state at {base} has {stored} buckets, not {buckets}")


def read_bucketed(spark: SparkSession, base: str, live: bool = True) -> DataFrame | None:
    data = f"{base.rstrip('/')}/data"
    if not path_exists(spark, data):
        return None
    state = spark.read.option("basePath", data).parquet(data).drop(BUCKET)
    return live_rows(state) if live else state


def rewrite_buckets(spark: SparkSession, base: str, batch: DataFrame, keys: list[str], *, batch_id: int,
                    buckets: int, merge: Callable[[DataFrame | None, DataFrame], DataFrame], scope: str = "batch") -> bool:
    """Rewrite the buckets that ``batch``'s keys hash to with
    ``merge(current_rows_of_those_buckets_or_None, batch)``.

    Returns False when the batch was already applied (replay), else True.
    """
    base = base.rstrip("/")
    done = f"{base}/{_BATCH_FILE}-{scope}"
    last = read_marker(spark, done)
    if last is not None and batch_id <= int(last):
        return False
    _check_buckets(spark, base, buckets)
    data, staging = f"{base}/data", f"{base}/staging/{scope}-{batch_id}"
    if read_marker(spark, f"{staging}/{_COMPLETE_FILE}") is None:
        # the touched bucket ids: at most ``buckets`` small integers
        touched = [r[0] for r in batch.select(bucket_of(keys, buckets).alias("b")).distinct().collect()]
        if not touched:
            write_marker(spark, done, str(batch_id))
            return True
        current = None
        if path_exists(spark, data):
            current = (spark.read.option("basePath", data).parquet(data)
                       .filter(F.col(BUCKET).isin(touched)).drop(BUCKET))
        merged = merge(current, batch)
        # static overwrite: a re-run replaces the whole staging folder
        (merged.withColumn(BUCKET, bucket_of(keys, buckets)).hint("rebalance", BUCKET)
               .write.mode("overwrite").option("partitionOverwriteMode", "static")
               .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).partitionBy(BUCKET).parquet(staging))
        write_marker(spark, f"{staging}/{_COMPLETE_FILE}", str(batch_id))
    (spark.read.option("basePath", staging).parquet(staging)
          .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
          .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).partitionBy(BUCKET).parquet(data))
    write_marker(spark, done, str(batch_id))
    remove_path(spark, staging)
    return True


def merge_into_bucketed(spark: SparkSession, base: str, changes: DataFrame, keys: list[str], *, batch_id: int,
                        buckets: int = 4096, op: str = "op", seq: str | list[str] = "seq",
                        value_cols: list[str] | None = None, mode: str = "upsert", scope: str = "batch") -> bool:
    """Fold one change batch into the bucketed state at ``base`` (CDC apply
    with tombstones)."""
    value_cols = value_cols or [c for c in changes.columns if c not in [*keys, op, *sequence(seq)]]
    # the folded batch feeds the bucket list, the merge and the staging write:
    # keep it for the duration of this call only
    latest = fold_changes(changes, keys, op=op, seq=seq, value_cols=value_cols, mode=mode).persist()

    def merge(current: DataFrame | None, batch: DataFrame) -> DataFrame:
        return merge_folded(current, batch, keys, seq=seq, value_cols=value_cols, mode=mode, tombstones=True)

    try:
        return rewrite_buckets(spark, base, latest, keys, batch_id=batch_id, buckets=buckets, merge=merge, scope=scope)
    finally:
        latest.unpersist()


def replace_into_bucketed(spark: SparkSession, base: str, rows: DataFrame, keys: list[str], *, batch_id: int,
                          buckets: int = 4096, seq: str | None = None, scope: str = "batch") -> bool:
    """Replace all stored rows of the keys present in ``rows`` with ``rows``
    (e.g. a re-scored quake's fact rows), touching only their buckets. With
    ``seq``, a column of ``rows`` that is stored too, rows older than those
    stored for their key are left out."""
    def merge(current: DataFrame | None, batch: DataFrame) -> DataFrame:
        if seq is not None and current is not None:
            stored = current.groupBy(*keys).agg(F.max(seq).alias("_stored"))
            batch = batch.join(stored, keys, "left").filter(F.col("_stored").isNull() | (F.col(seq) >= F.col("_stored"))).drop("_stored")
        return replace_by_key(current, batch, keys)

    return rewrite_buckets(spark, base, rows, keys, batch_id=batch_id, buckets=buckets, merge=merge, scope=scope)
