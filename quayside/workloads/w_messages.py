"""Message decoding workloads.

Messages are produced by Spark from ``events`` (JSON text with the edge
cases of FIXTURES.md: absent properties/geometry, two-element coordinates,
negative depth, time as a number, as ISO text and as garbage, malformed and
NULL messages); the oracle derives the expected decoded rows directly.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.session import ensure_utc
from quayside.sources.messages import decode_drift, decode_json, field_kinds, flatten_seismic_messages, unwrap_cdc_envelope
from quayside.workloads import register
from quayside.workloads.fixtures import CHANGES_SQL, QUAKES_SQL, changes, quakes, with_ctes


def _q(s):
    return F.concat(F.lit('"'), s, F.lit('"'))


def seismic_messages(spark, sf_dir):
    q = quakes(spark, sf_dir)
    eid = F.col("unid")
    ms = F.unix_millis(F.col("time").cast("timestamp"))
    iso = F.date_format("time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    time_json = (F.when(eid % 3 == 0, ms.cast("string"))
                 .when(eid % 3 == 1, _q(iso)).otherwise(F.lit('"garbage"')))

    def kv(k, v):
        return F.concat(F.lit(f'"{k}":'), v)

    props = F.concat_ws(",",
        kv("unid", _q(eid.cast("string"))),
        F.when(eid % 13 != 0, kv("source_id", _q(F.concat(F.lit("src-"), F.col("user_id").cast("string"))))),
        kv("source_catalog", F.lit('"EMSC"')),
        kv("time", time_json),
        kv("lastupdate", ms.cast("string")),
        F.when(eid % 11 != 0, kv("flynn_region", _q(F.col("flynn_region")))),
        F.when(eid % 10 != 3, kv("mag", F.col("mag").cast("string"))),
        kv("magtype", F.lit('"ml"')), kv("evtype", F.lit('"ke"')), kv("auth", F.lit('"AUTH"')))
    coords = F.when(eid % 17 == 0, F.concat_ws(",", F.col("lon").cast("string"), F.col("lat").cast("string"))) \
        .otherwise(F.concat_ws(",", F.col("lon").cast("string"), F.col("lat").cast("string"),
                               (-F.col("depth")).cast("string")))
    geometry = F.concat(F.lit('"geometry":{"coordinates":['), coords, F.lit("]}"))
    data = F.concat(F.lit("{"), F.concat_ws(",",
        F.when(eid % 19 != 0, geometry),
        F.when(eid % 23 != 0, F.concat(F.lit('"properties":{'), props, F.lit("}")))), F.lit("}"))
    action = F.when(eid % 10 == 0, "delete").when(eid % 2 == 0, "update").otherwise("create")
    msg = F.concat(F.lit('{"action":'), _q(action), F.lit(',"data":'), data, F.lit("}"))
    return q.select(msg.alias("value"))


@register("seismic_flatten", with_ctes(QUAKES_SQL) + """
SELECT CAST(unid AS VARCHAR) AS unid,
       CASE WHEN unid % 13 = 0 THEN 'N/A' ELSE 'src-' || CAST(user_id AS VARCHAR) END AS source_id,
       'EMSC' AS source_catalog,
       make_timestamp((epoch_us(time) // 1000) * 1000) AS lastupdate,
       CASE unid % 3 WHEN 0 THEN make_timestamp((epoch_us(time) // 1000) * 1000) WHEN 1 THEN time END AS time,
       CASE WHEN unid % 11 = 0 THEN 'N/A' ELSE flynn_region END AS flynn_region,
       CASE WHEN unid % 19 = 0 THEN 0.0 ELSE lat END AS lat,
       CASE WHEN unid % 19 = 0 THEN 0.0 ELSE lon END AS lon,
       CASE WHEN unid % 19 = 0 OR unid % 17 = 0 THEN 0.0 ELSE depth END AS depth,
       'ke' AS evtype, 'AUTH' AS auth,
       CASE WHEN unid % 10 = 3 THEN 0.0 ELSE mag END AS mag,
       'ml' AS magtype,
       CASE WHEN unid % 10 = 0 THEN 'delete' WHEN unid % 2 = 0 THEN 'update' ELSE 'create' END AS action
FROM quakes WHERE unid % 23 <> 0""")
def seismic_flatten(spark, sf_dir):
    ensure_utc(spark)
    return flatten_seismic_messages(seismic_messages(spark, sf_dir))


CHANGE_ROW = T.StructType([
    T.StructField("key", T.LongType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("event_type", T.StringType()),
])


@register("cdc_unwrap", with_ctes(CHANGES_SQL) + """
SELECT key, value, event_type, op AS __op, seq AS __ts_ms, false AS _malformed FROM changes""")
def cdc_unwrap(spark, sf_dir):
    ch = changes(spark, sf_dir)
    row = F.struct("key", "value", "event_type")
    before_row = F.struct("key", (F.col("value") - 1).alias("value"), "event_type")
    before = F.when(F.col("op") == "u", before_row).when(F.col("op") == "d", row)
    after = F.when(F.col("op") != "d", row)
    env = F.to_json(F.struct(before.alias("before"), after.alias("after"), F.col("op"), F.col("seq").alias("ts_ms")))
    return unwrap_cdc_envelope(ch.select(env.alias("value")), CHANGE_ROW)


MESSAGE_SCHEMA = T.StructType([
    T.StructField("key", T.LongType()),
    T.StructField("seq", T.LongType()),
    T.StructField("op", T.StringType()),
    T.StructField("value", T.DoubleType()),
])


@register("decode_json", with_ctes(CHANGES_SQL) + """
SELECT CASE WHEN seq % 29 = 0 OR seq % 31 = 0 THEN NULL ELSE key END AS key,
       CASE WHEN seq % 29 = 0 OR seq % 31 = 0 THEN NULL ELSE seq END AS seq,
       CASE WHEN seq % 29 = 0 OR seq % 31 = 0 THEN NULL ELSE op END AS op,
       CASE WHEN seq % 29 = 0 OR seq % 31 = 0 THEN NULL ELSE value END AS value,
       (seq % 29 = 0 OR seq % 31 = 0) AS _malformed
FROM changes""")
def decode_json_q(spark, sf_dir):
    ch = changes(spark, sf_dir)
    text = F.to_json(F.struct("key", "seq", "op", "value"))
    msg = (F.when(F.col("seq") % 29 == 0, F.substring(text, 1, 12))   # truncated JSON
           .when(F.col("seq") % 31 == 0, F.lit(None).cast("string"))  # NULL message
           .otherwise(text))
    return decode_json(ch.select(msg.alias("value")), MESSAGE_SCHEMA)


# --- messages whose fields grow and change type ---------------------------------

DRIFT_SQL = with_ctes(CHANGES_SQL)


def drifting_messages(spark, sf_dir):
    """Every fifth message has a field more, every third a nested one; some
    values are text, which may be a number; some messages are no object."""
    seq = F.col("seq")
    value = (F.when(seq % 7 == 0, F.lit('"n/a"')).when(seq % 11 == 0, F.lit('"12.5"'))
             .otherwise(F.coalesce(F.col("value").cast("string"), F.lit("null"))))
    text = F.concat(F.lit('{"key":'), F.to_json(F.array("key")), F.lit(',"seq":'), seq.cast("string"), F.lit(',"value":'), value,
                    F.when(seq % 5 == 0, F.lit(',"note":"late"')).otherwise(""), F.when(seq % 3 == 0, F.lit(',"zone":{"id":1}')).otherwise(""), F.lit("}"))
    text = F.regexp_replace(text, r'^\{"key":\[(.*?)\],', r'{"key":$1,')
    msg = F.when(seq % 29 == 0, F.substring(text, 1, 12)).when(seq % 31 == 0, F.lit("[1]")).otherwise(text)
    return changes(spark, sf_dir).select(seq.alias("sent"), msg.alias("value"))


DRIFT_SCHEMA = T.StructType([f for f in MESSAGE_SCHEMA.fields if f.name != "op"])


@register("decode_drift", DRIFT_SQL + """
SELECT seq AS sent, CASE WHEN ok THEN key END AS key, CASE WHEN ok THEN seq END AS seq,
       CASE WHEN NOT ok OR seq % 7 = 0 THEN NULL WHEN seq % 11 = 0 THEN 12.5 ELSE value END AS value,
       CASE WHEN ok THEN CASE WHEN seq % 7 = 0 THEN 'value' ELSE '' END END AS mistyped,
       CASE WHEN ok AND seq % 5 = 0 THEN 'late' END AS note,
       CASE WHEN ok AND seq % 3 = 0 THEN '{"id":1}' END AS zone, NOT ok AS _malformed
FROM (SELECT *, seq % 29 <> 0 AND seq % 31 <> 0 AS ok FROM changes)""")
def decode_drift_q(spark, sf_dir):
    """Known fields, fields that do not fit and unknown fields of such messages."""
    out = decode_drift(drifting_messages(spark, sf_dir), DRIFT_SCHEMA, keep=["sent"])
    return out.select("sent", "key", "seq", "value", F.array_join("_mistyped", ",").alias("mistyped"),
                      F.col("_extra")["note"].alias("note"), F.col("_extra")["zone"].alias("zone"), "_malformed")


@register("field_kinds", DRIFT_SQL + """, m AS (SELECT * FROM changes WHERE seq % 29 <> 0 AND seq % 31 <> 0), f AS (
  SELECT 'key' AS field, CASE WHEN key IS NULL THEN 'null' WHEN typeof(key) = 'VARCHAR' THEN 'text' ELSE 'number' END AS kind, TRUE AS known FROM m
  UNION ALL SELECT 'seq', 'number', TRUE FROM m
  UNION ALL SELECT 'value', CASE WHEN seq % 7 = 0 OR seq % 11 = 0 THEN 'text' WHEN value IS NULL THEN 'null' ELSE 'number' END, TRUE FROM m
  UNION ALL SELECT 'note', 'text', FALSE FROM m WHERE seq % 5 = 0
  UNION ALL SELECT 'zone', 'object', FALSE FROM m WHERE seq % 3 = 0)
SELECT field, kind, known, count(*) AS messages FROM f GROUP BY ALL""")
def field_kinds_q(spark, sf_dir):
    """Which fields of which kind the messages hold, known or not."""
    return field_kinds(drifting_messages(spark, sf_dir), DRIFT_SCHEMA)


# --- current quake state and fact from change messages on the change schema -----

def quake_change_messages(spark, sf_dir):
    """One change message per event: the quake is the user (about 67 changes
    each), the sequence is the event id, times are epoch milliseconds."""
    from quayside.workloads.fixtures import OP_OF_EVENT_TYPE, table

    e = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    op = None
    for et, o in OP_OF_EVENT_TYPE.items():
        op = F.when(F.col("event_type") == et, F.lit(o)) if op is None else op.when(F.col("event_type") == et, F.lit(o))
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    row = F.struct(
        F.concat(F.lit("q"), F.col("user_id").cast("string")).alias("unid"),
        F.concat(F.lit("src-"), eid.cast("string")).alias("source_id"), F.lit("EMSC").alias("source_catalog"),
        (ms + 60000).alias("lastupdate"), ms.alias("time"), F.col("event_type").alias("flynn_region"),
        (((eid * 37) % 140 - 70).cast("double") + 0.5).alias("lat"),
        (((eid * 53) % 360 - 180).cast("double") + 0.5).alias("lon"),
        (eid % 50).cast("double").alias("depth"), F.lit("ke").alias("evtype"), F.lit("AUTH").alias("auth"),
        (2 + eid % 7).cast("double").alias("mag"), F.lit("ml").alias("magtype"), F.col("event_type").alias("action"),
        (ms + 1000).alias("received_at"), op.alias("__op"), eid.alias("__ts_ms"))
    return e.select(F.to_json(row).alias("value"))


@register("fact_earthquake", """
WITH latest AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1),
cur AS (
  SELECT 'q' || CAST(user_id AS VARCHAR) AS unid,
         make_timestamp((epoch_us(ts) // 1000) * 1000) AS t,
         make_timestamp((epoch_us(ts) // 1000) * 1000 + 60000000) AS lu,
         CAST((event_id * 37) % 140 - 70 AS DOUBLE) + 0.5 AS lat,
         CAST((event_id * 53) % 360 - 180 AS DOUBLE) + 0.5 AS lon,
         CAST(2 + event_id % 7 AS DOUBLE) AS mag, 'src-' || CAST(event_id AS VARCHAR) AS source_id, event_type,
         CAST(event_id % 50 AS DOUBLE) AS depth, make_timestamp((epoch_us(ts) // 1000) * 1000 + 1000000) AS received
  FROM latest WHERE event_type <> 'error')
SELECT CAST(row_number() OVER (ORDER BY unid) AS BIGINT) AS EARTHQUAKE_SK, unid AS UNID, t AS TIME, lat AS LAT,
       lon AS LON, mag AS MAG, CAST(t AS DATE) AS EVENT_DATE,
       CAST(strftime(t, '%Y%m%d') AS INTEGER) AS TIME_DATE_KEY, CAST(strftime(t, '%H%M%S') AS INTEGER) AS TIME_TIME_KEY,
       CAST(strftime(lu, '%Y%m%d') AS INTEGER) AS LAST_UPDATE_DATE_KEY,
       CAST(strftime(lu, '%H%M%S') AS INTEGER) AS LAST_UPDATE_TIME_KEY,
       CAST(strftime(t, '%Y%m%d') AS INTEGER) AS EVENT_DATE_KEY,
       source_id AS SOURCE_ID, 'EMSC' AS SOURCE_CATALOG, event_type AS FLYNN_REGION, depth AS DEPTH, 'ml' AS MAGNITUDE_TYPE,
       'ke' AS EVENT_TYPE, 'AUTH' AS AUTHORITY, received AS RECEIVED_AT,
       CAST(year(t) AS INTEGER) AS EVENT_YEAR, CAST(month(t) AS INTEGER) AS EVENT_MONTH
FROM cur""")
def fact_earthquake_q(spark, sf_dir):
    from quayside.operators.cdc import live_rows
    from quayside.plans.quakes import apply_quake_changes, fact_earthquake, stage_quake_changes
    from quayside.sources.messages import decode_change_json

    ensure_utc(spark)
    decoded = decode_change_json(quake_change_messages(spark, sf_dir)).filter(~F.col("_malformed"))
    state = live_rows(apply_quake_changes(None, stage_quake_changes(decoded)))
    return fact_earthquake(state)
