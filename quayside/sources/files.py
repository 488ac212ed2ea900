"""File and query sources."""

from __future__ import annotations

import csv
import datetime as dt
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.operators.broadcast import DEFAULT_MAX_BROADCAST_ROWS, broadcast_if_bounded
from quayside.operators.quality import assert_not_empty
from quayside.sinks.tables import cluster_for_write


def read_snapshot_csv(spark: SparkSession, path: str, *, header: bool = True, sep: str = ",",
                      base_path: str | None = None) -> DataFrame:
    """Raw landed CSV: every column a string (no inference pass, no drift),
    plus ``year=/month=`` directory columns from partition discovery."""
    reader = spark.read.option("header", header).option("sep", sep).option("inferSchema", False) \
        .option("mode", "PERMISSIVE")
    if base_path:
        reader = reader.option("basePath", base_path)
    return reader.csv(path)


def read_parquet(spark: SparkSession, path: str, base_path: str | None = None) -> DataFrame:
    reader = spark.read.option("basePath", base_path) if base_path else spark.read
    return reader.parquet(path)


def read_query(spark: SparkSession, query: str, *, fmt: str | None = None,
               options: dict | None = None) -> DataFrame:
    """Run ``query`` where the data lives: with ``fmt`` (e.g. ``jdbc``) the
    query is pushed to the external system; without it, it runs on Spark's
    catalog. Connection options are always supplied by the caller."""
    if fmt is None:
        return spark.sql(query)
    return spark.read.format(fmt).options(**(options or {})).option("query", query).load()


def lookup(df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """A small reference table to join against: broadcast when its row count
    is within the bound (no eager cache + count)."""
    out, _ = broadcast_if_bounded(df, max_rows)
    return out


def dated_file_date(prefix: str, path_col: str = "_source_path"):
    """The ``YYYY-MM-DD`` of ``<prefix>_YYYY-MM-DD.csv`` in a path, as a date
    (NULL when the name does not follow the pattern or the date is invalid)."""
    # the dated name may be the file itself or a landing folder (``x=name``)
    pat = rf"(?:^|[/=]){prefix}_([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}})\.csv(?:/|$)"
    return F.to_date(F.nullif(F.regexp_extract(F.col(path_col), pat, 1), F.lit("")), "yyyy-MM-dd")


def file_lines(spark: SparkSession, path: str, partitions: bool = True) -> DataFrame:
    """Lines of the files under ``path``, with their file, block and place."""
    reader = spark.read if partitions else spark.read.option("recursiveFileLookup", True)
    return reader.text(path).select("value", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_block"),
                                    F.monotonically_increasing_id().alias("_at"))


def file_starts(lines: DataFrame) -> DataFrame:
    """Place of each file's first line. The place alone is aggregated, one
    number a file: with the line beside it Spark sorts all lines by file."""
    return lines.filter("_block = 0").groupBy("_path").agg(F.min("_at").alias("_at"))


def read_csv_by_name(spark: SparkSession, path: str, partitions: bool = True) -> DataFrame:
    """CSV files with a header under ``path``, every column a string, by the
    names in each file's own header. Quoted values may hold separators, quotes
    (doubled) and line breaks, and a record equal to the header is data.

    One scan finds where each file begins and one fetches those lines, in
    memory that does not grow with the files; files with one header are then
    read together by Spark's own reader, so each file is parsed once, and the
    groups are joined by column name. ``_source_path`` is a row's file;
    ``partitions`` adds the columns of the folders' names. The driver holds the
    files' paths, as it does to plan any scan."""
    lines = file_lines(spark, path, partitions)
    starts = file_starts(lines).collect()
    heads = lines.filter(F.col("_at").isin([r["_at"] for r in starts])).select("_path", "value").collect() if starts else []
    if sorted(r["_path"] for r in heads) != sorted(r["_path"] for r in starts):
        raise RuntimeError(f"the files under {path} changed while their headers were read")
    groups: dict[str, list[str]] = {}
    for r in heads:
        groups.setdefault(r["value"], []).append(unquote(r["_path"]))
    out = None
    for head in sorted(groups):
        schema = T.StructType([T.StructField(c, T.StringType()) for c in next(csv.reader([head]))])
        opened = spark.read.options(**CSV_QUOTING, header=True, multiLine=True)
        if partitions:
            opened = opened.option("basePath", path)
        part = opened.schema(_ddl(schema)).csv(sorted(groups[head])).withColumn("_source_path", F.col("_metadata.file_path"))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:
        raise FileNotFoundError(f"no file with a header under {path}")
    return out


# quotes inside a quoted value are doubled; blanks around values stay
CSV_QUOTING = {"escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` STRING" for f in schema.fields)


def land_dated_files(spark: SparkSession, src: str, dst: str, prefix: str) -> DataFrame:
    """Land ``<prefix>_YYYY-MM-DD.csv`` files under
    ``dst/year=YYYY/month=MM/file_date=YYYY-MM-DD``.

    The date comes from each file's name; files whose name does not match are
    skipped. Only the dates of ``src`` are replaced (dynamic overwrite):
    landing a file again overwrites it, and the other days of its month stay.
    Columns go by the names in each file's header. Returns all that is landed,
    as read back.
    """
    raw = read_csv_by_name(spark, src, partitions=False)
    dated = raw.withColumn("file_date", dated_file_date(prefix)).filter(F.col("file_date").isNotNull())
    out = dated.withColumns({"year": F.year("file_date"), "month": F.format_string("%02d", F.month("file_date"))})
    (cluster_for_write(out, ["year", "month", "file_date"]).drop("_source_path")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .options(**CSV_QUOTING, header=True).partitionBy("year", "month", "file_date").csv(dst))
    return read_csv_by_name(spark, dst).drop("_source_path")


def month_snapshot(df: DataFrame, as_of: dt.date, date_col: str = "snapshot_date") -> DataFrame:
    """Tag a monthly pull with the first day of its month; an empty pull fails."""
    assert_not_empty(df, "monthly snapshot")
    return df.withColumn(date_col, F.trunc(F.lit(as_of), "month"))
