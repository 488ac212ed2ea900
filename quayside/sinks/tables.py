"""Table writes (K1-K3, K7, K8) and versioned publishing.

Overwriting a path that the same job reads fails (or worse, loses data), so
tables that are read and rewritten (the gold dimension, the CDC state, the
watermark control table) are published as immutable versions
``<base>/v=<n>/`` plus a ``_CURRENT`` pointer moved over the old one, in one
atomic rename, after the version is complete. Readers resolve the pointer;
an interrupted publish leaves the previous version current. The version
before the current one is kept for its readers; older ones are removed.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession

_POINTER = "_CURRENT"
# bounded output files whatever the partition size
MAX_RECORDS_PER_FILE = 5_000_000


def cluster_for_write(df: DataFrame, partition_by: list[str]) -> DataFrame:
    """Cluster rows by the output partition columns before a partitioned write.

    Uses the ``rebalance`` hint: rows are shuffled by the partition columns
    so each task writes to few partitions, and AQE splits a skewed output
    partition (e.g. one day holding a third of the rows) over several tasks
    and merges small ones -- sized from the measured shuffle, with no
    sampling pass.
    """
    return df.hint("rebalance", *partition_by)


def _jvm_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _jvm_path(spark, path)
    return bool(fs.exists(p))


def write_marker(spark: SparkSession, path: str, text: str) -> None:
    """Replace a one-line file; a reader sees the old or the new line, never none."""
    jvm = spark.sparkContext._jvm
    hadoop = jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    fs, p = _jvm_path(spark, path)
    tmp = hadoop.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    out = fs.create(tmp, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    options = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 1)
    options[0] = getattr(hadoop, "Options$Rename").OVERWRITE
    hadoop.FileContext.getFileContext(fs.getUri(), conf).rename(fs.makeQualified(tmp), fs.makeQualified(p), options)


def remove_path(spark: SparkSession, path: str) -> None:
    fs, p = _jvm_path(spark, path)
    fs.delete(p, True)


def _versions(spark: SparkSession, base: str) -> list[int]:
    fs, p = _jvm_path(spark, base.rstrip("/"))
    if not fs.exists(p):
        return []
    names = [x.getPath().getName() for x in fs.listStatus(p)]
    return sorted(int(n[2:]) for n in names if n.startswith("v=") and n[2:].isdigit())


def read_marker(spark: SparkSession, path: str) -> str | None:
    fs, p = _jvm_path(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    reader = spark.sparkContext._jvm.java.io.BufferedReader(
        spark.sparkContext._jvm.java.io.InputStreamReader(stream, "UTF-8"))
    line = reader.readLine()
    reader.close()
    return line


def current_version(spark: SparkSession, base: str) -> int | None:
    """The version the pointer names; None before the first publish. More than
    a first, unfinished version without a pointer is a damaged table."""
    text = read_marker(spark, f"{base.rstrip('/')}/{_POINTER}")
    if text:
        return int(text.strip())
    if any(v > 1 for v in _versions(spark, base)):
        raise FileNotFoundError(f"{base} holds versions but no {_POINTER}")
    return None


def publish(df: DataFrame, base: str, partition_by: list[str] | None = None) -> int:
    """Write ``df`` as the next version of the table at ``base`` and make it current."""
    spark = df.sparkSession
    version = (current_version(spark, base) or 0) + 1
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{base.rstrip('/')}/v={version}")
    write_marker(spark, f"{base.rstrip('/')}/{_POINTER}", str(version))
    for old in _versions(spark, base):
        if old < version - 1:
            remove_path(spark, f"{base.rstrip('/')}/v={old}")
    return version


def read_published(spark: SparkSession, base: str, schema=None) -> DataFrame | None:
    """The current version of a published table, or None before the first publish."""
    version = current_version(spark, base)
    if version is None:
        return None
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{base.rstrip('/')}/v={version}")


def write_snapshot(df: DataFrame, path: str, partition_by: list[str]) -> int:
    """Overwrite only the partitions present in ``df`` (dynamic overwrite), so
    earlier snapshots survive a partial re-run. Returns the rows written,
    observed by the write itself (no extra count)."""
    from pyspark.sql import Observation
    from pyspark.sql import functions as F

    obs = Observation("written")
    # observed above the exchange, so only the write (not the range sampling) runs it
    clustered = cluster_for_write(df, partition_by).observe(obs, F.count(F.lit(1)).alias("rows"))
    (clustered.write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
       .partitionBy(*partition_by).parquet(path))
    return int(obs.get.get("rows", 0))


def append_partitioned(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Append, clustering rows by the partition columns first so each task
    writes few files."""
    (cluster_for_write(df, partition_by).write.mode("append")
       .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).partitionBy(*partition_by).parquet(path))


def append_fact(fact: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Bulk append of fact rows (never row-by-row inserts from the driver)."""
    parts = partition_by or ["EVENT_YEAR", "EVENT_MONTH"]
    append_partitioned(fact, path, parts)


def replace_by_key(current: DataFrame | None, new_rows: DataFrame, keys: list[str]) -> DataFrame:
    """All rows of ``new_rows`` plus the rows of ``current`` whose key does
    not occur in ``new_rows``: re-scoring a quake replaces its fact rows
    instead of adding a second set."""
    if current is None:
        return new_rows
    return current.join(new_rows.select(*keys).distinct(), keys, "left_anti").unionByName(new_rows)


def register_table(spark: SparkSession, name: str, path: str, schema_ddl: str | None = None,
                   partition_by: list[str] | None = None) -> None:
    """External Parquet table over ``path`` plus partition discovery."""
    cols = f"({schema_ddl})" if schema_ddl else ""
    parts = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} {cols} USING parquet{parts} LOCATION '{path}'")
    if partition_by:
        spark.sql(f"MSCK REPAIR TABLE {name}")


def write_csv(df: DataFrame, path: str, skip_empty: bool = True) -> bool:
    """CSV with header; the commit protocol makes the output appear atomically.
    Returns False (and writes nothing) for an empty frame when ``skip_empty``."""
    if skip_empty and df.isEmpty():
        return False
    df.write.mode("overwrite").option("header", True).csv(path)
    return True


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """The values of a table's first partition column, from the names of its
    folders (no file is opened); NULL's folder is left out."""
    fs, p = _jvm_path(spark, path)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
    values = [n.split("=", 1)[1] for n in names if n.startswith(f"{column}=")]
    return sorted(v for v in values if v != "__HIVE_DEFAULT_PARTITION__")


def expire_partitions(spark: SparkSession, path: str, ts: str, cutoff: dt.datetime, day: str = "day") -> dict[str, list[str]]:
    """Delete the rows older than ``cutoff`` from a Parquet table partitioned by
    ``day``, the date of its time stamp ``ts`` without a zone.

    Folders of earlier days are removed unread. Of all others only that of the
    cut-off's own day is rewritten, and only if it holds an older row; the rest
    keep their files. Rows whose ``ts`` is NULL stay. The rewrite goes through
    the shared scratch folder and dynamic partition overwrite, and every step
    may be repeated: a run that died is finished by the next one. Returns the
    days removed and rewritten (names of folders, never rows).
    """
    from pyspark.sql import functions as F

    from quayside.session import scratch_path

    edge = cutoff.date().isoformat()
    days = partition_values(spark, path, day)
    removed, rewritten = [d for d in days if d < edge], []
    if edge in days and cutoff.time() != dt.time():
        # read with the partition column as the folders name it: one folder is listed
        table = spark.read.option("basePath", path).parquet(f"{path.rstrip('/')}/{day}={edge}")
        old = F.col(ts) < F.lit(cutoff).cast("timestamp_ntz")
        if not table.filter(old).isEmpty():
            staging = scratch_path(spark, "retention")
            table.filter(~F.coalesce(old, F.lit(False))).write.mode("overwrite").parquet(staging)
            kept = spark.read.schema(table.schema).parquet(staging)
            if kept.isEmpty():
                removed.append(edge)
            else:
                write_snapshot(kept, path, [day])
                rewritten.append(edge)
    for value in removed:
        remove_path(spark, f"{path.rstrip('/')}/{day}={value}")
    return {"removed": removed, "rewritten": rewritten}
