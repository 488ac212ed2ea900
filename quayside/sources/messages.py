"""Decoding of change-stream and seismic messages.

All decoding is ``from_json`` with a fixed schema; nothing is inferred per
batch. Malformed messages are flagged instead of silently becoming all-NULL
rows, so a caller can route them to a reject table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions.parse import parse_event_time

CORRUPT = "_corrupt_record"

# The change-row schema (times are epoch milliseconds)
CHANGE_SCHEMA = T.StructType([
    T.StructField("unid", T.StringType()),
    T.StructField("source_id", T.StringType()),
    T.StructField("source_catalog", T.StringType()),
    T.StructField("lastupdate", T.LongType()),
    T.StructField("time", T.LongType()),
    T.StructField("flynn_region", T.StringType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("depth", T.DoubleType()),
    T.StructField("evtype", T.StringType()),
    T.StructField("auth", T.StringType()),
    T.StructField("mag", T.DoubleType()),
    T.StructField("magtype", T.StringType()),
    T.StructField("action", T.StringType()),
    T.StructField("received_at", T.LongType()),
    T.StructField("__op", T.StringType()),
    T.StructField("__ts_ms", T.LongType()),
])


# Time stamps in messages keep microseconds
JSON_TIME_OPTIONS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
                     "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def decode_json(df: DataFrame, schema: T.StructType, value_col: str = "value",
                keep: list[str] | None = None, options: dict | None = None) -> DataFrame:
    """Parse ``value_col`` (string or binary) into top-level columns plus a
    ``_malformed`` flag (unparsable text or a NULL message)."""
    with_corrupt = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])
    text = F.col(value_col).cast("string")
    opts = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, **JSON_TIME_OPTIONS, **(options or {})}
    parsed = F.from_json(text, with_corrupt, opts)
    out = df.select(*(keep or []), text.alias("_text"), parsed.alias("_m"))
    malformed = F.col("_text").isNull() | F.col(f"_m.{CORRUPT}").isNotNull() | F.col("_m").isNull()
    return out.select(*(keep or []), *[F.col(f"_m.{f.name}").alias(f.name) for f in schema.fields],
                      malformed.alias("_malformed"))


def decode_drift(df: DataFrame, schema: T.StructType, value_col: str = "value", keep: list[str] | None = None) -> DataFrame:
    """Parse messages whose fields grow and change type over time.

    A message is parsed once, to VARIANT. Fields of ``schema`` are cast where
    the cast works and NULL where not; ``_mistyped`` names those that were there
    but did not fit, ``_extra`` keeps the fields outside the schema (name to
    JSON text), so neither is lost silently. ``_malformed`` marks a NULL
    message, text that is no JSON, and JSON that is no object.
    """
    text = F.col(value_col).cast("string")
    known = [f.name for f in schema.fields]
    # behind a generator, so that the one parse is not inlined into each field
    out = df.select(*(keep or []), text.alias("_text"), F.explode(F.array(F.try_parse_json(text))).alias("_v"))

    def at(name: str, kind: str) -> Column:
        return F.try_variant_get("_v", f'$["{name}"]', kind)

    is_object = F.coalesce(F.schema_of_variant("_v").startswith("OBJECT"), F.lit(False))
    mistyped = F.array_compact(F.array(*[
        F.when(at(f.name, "variant").isNotNull() & ~F.is_variant_null(at(f.name, "variant"))
               & at(f.name, f.dataType.simpleString()).isNull(), F.lit(f.name))
        for f in schema.fields]))
    extra = F.map_filter(F.from_json("_text", T.MapType(T.StringType(), T.StringType())), lambda k, _: ~k.isin(*known))
    return out.select(*(keep or []), *[F.when(is_object, at(f.name, f.dataType.simpleString())).alias(f.name) for f in schema.fields],
                      F.when(is_object, mistyped).alias("_mistyped"), F.when(is_object, extra).alias("_extra"), (~is_object).alias("_malformed"))


def field_kinds(df: DataFrame, schema: T.StructType, value_col: str = "value") -> DataFrame:
    """What fields the messages really have: field, kind (text, number, boolean,
    object, array, null), known (in ``schema``) and the number of messages."""
    parsed = df.select(F.try_parse_json(F.col(value_col).cast("string")).alias("_v")).filter("schema_of_variant(_v) LIKE 'OBJECT%'")
    fields = parsed.lateralJoin(parsed.sparkSession.tvf.variant_explode(F.col("_v").outer()))
    kind = F.schema_of_variant("value")
    named = (F.when(kind == "STRING", "text").when(kind.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)"), "number").when(kind == "BOOLEAN", "boolean")
             .when(kind.startswith("OBJECT"), "object").when(kind.startswith("ARRAY"), "array").when(kind == "VOID", "null").otherwise(kind))
    return fields.groupBy(F.col("key").alias("field"), named.alias("kind")).agg(F.count(F.lit(1)).alias("messages")) \
        .withColumn("known", F.col("field").isin(*[f.name for f in schema.fields]))


def decode_change_json(df: DataFrame, value_col: str = "value") -> DataFrame:
    return decode_json(df, CHANGE_SCHEMA, value_col)


def cdc_envelope_schema(row_schema: T.StructType) -> T.StructType:
    return T.StructType([
        T.StructField("before", row_schema),
        T.StructField("after", row_schema),
        T.StructField("op", T.StringType()),
        T.StructField("ts_ms", T.LongType()),
    ])


def unwrap_cdc_envelope(df: DataFrame, row_schema: T.StructType, value_col: str = "value") -> DataFrame:
    """``{before, after, op, ts_ms}`` -> the row image plus ``__op``, ``__ts_ms``.

    Deletes carry only a before-image; it supplies the key, so deletes are
    never lost the way a flattened after-image-only stream loses them.
    """
    env = decode_json(df, cdc_envelope_schema(row_schema), value_col)
    # a delete's after-image is NULL, so the before-image supplies its fields
    image = [F.when(F.col("after").isNotNull(), F.col(f"after.{f.name}"))
             .otherwise(F.col(f"before.{f.name}")).alias(f.name)
             for f in row_schema.fields]
    return env.select(*image, F.col("op").alias("__op"), F.col("ts_ms").alias("__ts_ms"), "_malformed")


# Source message layout and defaults for absent fields
SEISMIC_PROPERTIES = ["source_id", "source_catalog", "lastupdate", "time", "flynn_region", "evtype",
                      "auth", "mag", "magtype", "unid"]
SEISMIC_DEFAULT_TEXT = "N/A"
SEISMIC_DEFAULT_ACTION = "unknown"

SEISMIC_SCHEMA = T.StructType([
    T.StructField("action", T.StringType()),
    T.StructField("data", T.StructType([
        T.StructField("geometry", T.StructType([
            T.StructField("coordinates", T.ArrayType(T.DoubleType()))])),
        T.StructField("properties", T.MapType(T.StringType(), T.StringType())),
    ])),
])


def _has_properties() -> Column:
    props = F.col("data.properties")
    return props.isNotNull() & (F.size(props) > 0)


def seismic_rejects(df: DataFrame, value_col: str = "value") -> DataFrame:
    """The messages that :func:`flatten_seismic_messages` leaves out, or whose
    ``time`` it cannot read (the row then has no time), with the reason."""
    m = decode_json(df.withColumn("_raw", F.col(value_col)), SEISMIC_SCHEMA, value_col, keep=["_raw"])
    time = F.col("data.properties").getItem("time")
    reason = F.when(F.col("_malformed"), F.lit("malformed")) \
        .when(~F.coalesce(_has_properties(), F.lit(False)), F.lit("no properties")) \
        .when(time.isNotNull() & parse_event_time(time).isNull(), F.lit("time"))
    return m.select(F.col("_raw").alias("value"), reason.alias("reason")).filter(F.col("reason").isNotNull())


def flatten_seismic_messages(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Raw seismic messages -> one change row per message.

    Messages without properties are dropped; absent text fields become
    ``N/A``; coordinates are ``[lon, lat, depth]`` with 0 for missing
    elements and ``abs`` depth; time fields accept epoch ms or ISO text.
    """
    m = decode_json(df, SEISMIC_SCHEMA, value_col)
    props = F.col("data.properties")
    coords = F.coalesce(F.col("data.geometry.coordinates"), F.array().cast("array<double>"))

    def prop(name: str) -> Column:
        return props.getItem(name)

    def text(name: str) -> Column:
        return F.coalesce(prop(name), F.lit(SEISMIC_DEFAULT_TEXT))

    def coord(i: int) -> Column:
        return F.coalesce(F.try_element_at(coords, F.lit(i + 1)), F.lit(0.0))

    out = m.filter(~F.col("_malformed") & _has_properties())
    return out.select(
        text("unid").alias("unid"),
        text("source_id").alias("source_id"),
        text("source_catalog").alias("source_catalog"),
        parse_event_time(prop("lastupdate")).alias("lastupdate"),
        parse_event_time(prop("time")).alias("time"),
        text("flynn_region").alias("flynn_region"),
        coord(1).alias("lat"),
        coord(0).alias("lon"),
        F.abs(coord(2)).alias("depth"),
        text("evtype").alias("evtype"),
        text("auth").alias("auth"),
        F.coalesce(prop("mag").try_cast("double"), F.lit(0.0)).alias("mag"),
        text("magtype").alias("magtype"),
        F.coalesce(F.col("action"), F.lit(SEISMIC_DEFAULT_ACTION)).alias("action"),
    )
