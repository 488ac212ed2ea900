"""Messages whose fields grow and change type."""

from pyspark.sql import types as T

from quayside.sources.messages import decode_drift, field_kinds

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("mag", T.DoubleType()), T.StructField("place", T.StringType())])
MESSAGES = ['{"id":1,"mag":2.5,"place":"A"}', '{"id":"2","mag":"strong","depth":{"km":[1,2]}}', '{"id":3,"mag":null,"place":"","tags":["x"]}',
            '{}', '{"id":4', '[1,2]', '"text"', 'null', '', None, '{"id":{"n":5},"place":7}']


def test_decode(spark):
    df = spark.createDataFrame([(k, m) for k, m in enumerate(MESSAGES)], "n long, value string")
    out = decode_drift(df, SCHEMA, keep=["n"])
    assert out.columns == ["n", "id", "mag", "place", "_mistyped", "_extra", "_malformed"]
    rows = {r.n: r for r in out.collect()}
    assert len(rows) == len(MESSAGES) and [n for n in rows if rows[n]._malformed] == [4, 5, 6, 7, 8, 9]
    assert (rows[0].id, rows[0].mag, rows[0].place, rows[0]._mistyped, rows[0]._extra) == (1, 2.5, "A", [], {})
    assert (rows[1].id, rows[1].mag, rows[1]._mistyped, rows[1]._extra) == (2, None, ["mag"], {"depth": '{"km":[1,2]}'})
    assert (rows[2].mag, rows[2].place, rows[2]._mistyped, rows[2]._extra) == (None, "", [], {"tags": '["x"]'})
    assert (rows[3].id, rows[3]._mistyped, rows[3]._extra) == (None, [], {})
    assert all(rows[n].id is None and rows[n]._mistyped is None and rows[n]._extra is None for n in (4, 5, 6, 7, 8, 9))
    assert (rows[10].id, rows[10].place, rows[10]._mistyped) == (None, "7", ["id"])


def test_one_parse_in_the_plan(spark):
    df = spark.createDataFrame([(1, MESSAGES[0])], "n long, value string").repartition(2)
    plan = decode_drift(df, SCHEMA).filter("NOT _malformed")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") + plan.count("parse_json") <= 1, plan


def test_kinds(spark):
    rows = field_kinds(spark.createDataFrame([(m,) for m in MESSAGES], "value string"), SCHEMA).collect()
    assert {(r.field, r.kind): (r.known, r.messages) for r in rows} == {
        ("id", "number"): (True, 2), ("id", "text"): (True, 1), ("id", "object"): (True, 1), ("mag", "number"): (True, 1),
        ("mag", "text"): (True, 1), ("mag", "null"): (True, 1), ("place", "text"): (True, 2), ("place", "number"): (True, 1),
        ("depth", "object"): (False, 1), ("tags", "array"): (False, 1)}
    assert field_kinds(spark.createDataFrame([], "value string"), SCHEMA).count() == 0
