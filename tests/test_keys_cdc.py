import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quayside.operators.cdc import apply_changes, change_counts, insert_if_absent, live_rows, upsert
from quayside.operators.keys import KeyRegistry, assign_surrogate_keys, dense_ids
from quayside.plans.archive import incremental_archive, read_watermark
from quayside.session import scratch_path


def test_dense_ids_consecutive_in_order(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7 % 1000).alias("k"), F.lit("x").alias("v")).repartition(5)
    out = dense_ids(df, ["k"], "key", start=10, num_partitions=6).collect()
    by_k = {r.k: r.key for r in out}
    assert sorted(by_k.values()) == list(range(10, 1010))
    assert all(by_k[a] < by_k[b] for a, b in zip(sorted(by_k), sorted(by_k)[1:]))


def test_incremental_keys_documented_example(spark):
    existing = spark.createDataFrame([(101, 1), (205, 2), (310, 3)], "oid int, port_key long")
    snap = spark.createDataFrame([(o,) for o in [101, 205, 310, 450, 500]], "oid int")
    got = {r.oid: r.port_key for r in assign_surrogate_keys(snap, existing, "oid", "port_key").collect()}
    assert got == {101: 1, 205: 2, 310: 3, 450: 4, 500: 5}


def test_key_registry_never_reissues(spark):
    reg = KeyRegistry(spark, scratch_path(spark, "registry"), "oid", "port_key")
    first = {r.oid: r.port_key for r in reg.assign(spark.createDataFrame([(1,), (2,), (3,)], "oid int")).collect()}
    # 3 (the maximum key) leaves, 4 arrives: 4 must not get key 3
    second = {r.oid: r.port_key for r in reg.assign(spark.createDataFrame([(1,), (2,), (4,)], "oid int")).collect()}
    # 3 returns and keeps its key
    third = {r.oid: r.port_key for r in reg.assign(spark.createDataFrame([(3,), (4,)], "oid int")).collect()}
    assert first == {1: 1, 2: 2, 3: 3} and second == {1: 1, 2: 2, 4: 4} and third == {3: 3, 4: 4}


SCHEMA = "key int, seq long, op string, v string"


def _state(df):
    return {r.key: (r.v, r.seq) for r in df.collect()}


def test_cdc_edge_cases_upsert_and_strict(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (3, "c", 1)], "key int, v string, seq long")
    changes = spark.createDataFrame([
        (1, 5, "d", None),        # delete existing
        (2, 6, "u", "b2"),        # update existing
        (3, 7, "c", "c-new"),     # create on an existing row
        (4, 8, "u", "d-upd"),     # update of a missing row
        (5, 9, "r", "e"),         # snapshot read of a new row
        (6, 11, "u", "late"), (6, 10, "c", "first"),  # two changes, out of order
    ], SCHEMA)
    up = _state(apply_changes(target, changes, ["key"], value_cols=["v"]))
    assert up == {2: ("b2", 6), 3: ("c-new", 7), 4: ("d-upd", 8), 5: ("e", 9), 6: ("late", 11)}
    strict = _state(apply_changes(target, changes, ["key"], value_cols=["v"], mode="strict"))
    # merged one by one: the create of 6 comes first, so its update finds a row
    assert strict == {2: ("b2", 6), 3: ("c", 1), 5: ("e", 9), 6: ("late", 11)}
    c = change_counts(changes).first()
    assert (c.inserts, c.updates, c.deletes) == (3, 3, 1)


def test_cdc_replay_and_late_change_after_delete(spark):
    b1 = spark.createDataFrame([(1, 1, "c", "a"), (1, 3, "d", None)], SCHEMA)
    late = spark.createDataFrame([(1, 2, "u", "zombie")], SCHEMA)
    s1 = apply_changes(None, b1, ["key"], value_cols=["v"], tombstones=True)
    s2 = apply_changes(s1, late, ["key"], value_cols=["v"], tombstones=True)
    assert live_rows(s2).count() == 0
    s3 = apply_changes(s2, b1, ["key"], value_cols=["v"], tombstones=True)   # replay
    assert [tuple(r) for r in s3.collect()] == [tuple(r) for r in s2.collect()]


def _fold(changes):
    state, seen = {}, {}
    for key, seq, op, v in sorted(changes, key=lambda c: c[1]):
        if op == "d":
            state.pop(key, None)
        else:
            state[key] = (v, seq)
        seen[key] = seq
    return state


@settings(max_examples=6, deadline=None, derandomize=True)
@given(st.lists(st.tuples(st.integers(0, 4), st.sampled_from(["c", "r", "u", "d"])), min_size=1, max_size=30),
       st.integers(1, 4))
def test_apply_changes_equals_fold_in_any_batching(spark, ops, n_batches):
    rows = [(k, i, op, None if op == "d" else f"v{i}") for i, (k, op) in enumerate(ops)]
    want = _fold(rows)
    # batches in reverse order of sequence: arrival order must not matter
    state = None
    for b in reversed(range(n_batches)):
        part = [r for r in rows if r[1] % n_batches == b]
        if part:
            state = apply_changes(state, spark.createDataFrame(part, SCHEMA), ["key"], value_cols=["v"],
                                  tombstones=True)
    assert _state(live_rows(state)) == want


def _merge_one_by_one(changes):
    state = {}
    for key, seq, op, v in sorted(changes, key=lambda c: (c[1], c[2] == "d")):
        if op == "d":
            state.pop(key, None)
        elif (op == "u") == (key in state):
            state[key] = (v, seq)
    return state


@settings(max_examples=6, deadline=None, derandomize=True)
@given(st.lists(st.tuples(st.integers(0, 3), st.sampled_from(["c", "r", "u", "u", "d"])), min_size=1, max_size=30),
       st.integers(1, 4))
def test_strict_equals_merging_one_by_one(spark, ops, n_batches):
    rows = [(k, i, op, None if op == "d" else f"v{i}") for i, (k, op) in enumerate(ops)]
    state, size = None, -(-len(rows) // n_batches)
    for at in range(0, len(rows), size):
        state = apply_changes(state, spark.createDataFrame(rows[at:at + size], SCHEMA), ["key"], value_cols=["v"], mode="strict")
    assert _state(state) == _merge_one_by_one(rows)


def test_ties_and_sequence_lists(spark):
    ties = spark.createDataFrame([(1, 5, "u", "a"), (1, 5, "d", None), (2, 5, "c", "b")], SCHEMA)
    state = apply_changes(None, ties, ["key"], value_cols=["v"], tombstones=True)
    assert _state(live_rows(state)) == {2: ("b", 5)}
    state = apply_changes(state, spark.createDataFrame([(2, 5, "d", None)], SCHEMA), ["key"], value_cols=["v"], tombstones=True)
    assert live_rows(state).count() == 0  # a delete of the same millisecond in the next batch
    kind = "key int, ms long, offset long, op string, v string"
    one = spark.createDataFrame([(1, 5, 1, "c", "a"), (1, 5, 2, "u", "b")], kind)
    two = spark.createDataFrame([(1, 5, 3, "u", "c"), (1, 4, 9, "u", "old")], kind)
    state = apply_changes(apply_changes(None, one, ["key"], seq=["ms", "offset"], value_cols=["v"]), two, ["key"],
                          seq=["ms", "offset"], value_cols=["v"])
    assert [tuple(r) for r in state.select("key", "v", "ms", "offset").collect()] == [(1, "c", 5, 3)]


def test_surrogate_keys_of_repeated_and_null_business_keys(spark):
    rows = spark.createDataFrame([(7, "a"), (7, "b"), (None, "c"), (9, "d")], "oid int, v string")
    for existing in (None, spark.createDataFrame([(9, 4)], "oid int, port_key long")):
        got = {(r.oid, r.v): r.port_key for r in assign_surrogate_keys(rows, existing, "oid", "port_key").collect()}
        assert got[(7, "a")] == got[(7, "b")] and got[(None, "c")] is None and got[(9, "d")] not in (None, got[(7, "a")])


def test_archive_after_a_crash_and_within_one_second(spark, monkeypatch):
    import quayside.plans.archive as plan

    src, archive, control = _events(spark), scratch_path(spark, "arch2"), scratch_path(spark, "ctl2")
    whole = plan.write_watermark

    def crash(*_):
        raise RuntimeError("killed")

    monkeypatch.setattr(plan, "write_watermark", crash)
    try:
        _archive(spark, src, archive, control, dt.datetime(2024, 1, 3))
    except RuntimeError:
        pass
    monkeypatch.setattr(plan, "write_watermark", whole)
    for micros in (0, 250_000, 500_000):  # the next scheduled run, and two more in the same second
        _archive(spark, src, archive, control, dt.datetime(2024, 1, 6, 0, 0, 0, micros))
    late = _events(spark).withColumns({"event_id": F.col("event_id") + 1000, "ts": F.lit(dt.datetime(2024, 1, 6, 0, 0, 0, 600_000)).cast("timestamp_ntz")})
    _archive(spark, src.unionByName(late.limit(3)), archive, control, dt.datetime(2024, 1, 6, 0, 0, 0, 700_000))
    got = sorted(r.event_id for r in spark.read.parquet(archive).collect())
    assert got == [*range(21), 1000, 1001, 1002]


def test_upsert_and_insert_if_absent(spark):
    t = spark.createDataFrame([("a", 1), ("b", 2)], "p string, w int")
    u = spark.createDataFrame([("b", 20), ("c", 30)], "p string, w int")
    assert sorted(tuple(r) for r in upsert(t, u, ["p"]).collect()) == [("a", 1), ("b", 20), ("c", 30)]
    assert sorted(tuple(r) for r in insert_if_absent(t, u, ["p"]).collect()) == [("a", 1), ("b", 2), ("c", 30)]


def _events(spark):
    rows = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(hours=6 * i)) for i in range(40)]
    return spark.createDataFrame(rows, "event_id long, ts timestamp_ntz")


def _archive(spark, src, archive, control, run_end):
    return incremental_archive(spark, src, archive_path=archive, control_base=control, pipeline="p",
                               slice_col="ts", event_ts="ts", keys=["event_id"], run_end=run_end,
                               as_of=dt.datetime(2024, 2, 1))


def test_archive_watermark_slices_rerun_and_empty(spark):
    src = _events(spark)
    archive, control = scratch_path(spark, "arch"), scratch_path(spark, "ctl")
    r1 = _archive(spark, src, archive, control, dt.datetime(2024, 1, 3))
    assert r1.status == "OK" and r1.expected_rows == 9  # (1970, Jan 3 00:00] holds ids 0..8
    assert read_watermark(spark, control, "p") == dt.datetime(2024, 1, 3)
    # re-running a finished run leaves nothing new (empty slice, watermark kept)
    again = _archive(spark, src, archive, control, dt.datetime(2024, 1, 3))
    assert again.status == "EMPTY" and not again.watermark_advanced
    r2 = _archive(spark, src, archive, control, dt.datetime(2024, 1, 11))
    assert r2.lower == dt.datetime(2024, 1, 3) and r2.expected_rows == 31
    got = sorted(r.event_id for r in spark.read.parquet(archive).collect())
    assert got == list(range(40))
    # k slices equal one slice
    one = scratch_path(spark, "arch1")
    _archive(spark, src, one, scratch_path(spark, "ctl1"), dt.datetime(2024, 1, 11))
    assert spark.read.parquet(one).drop("run_id").exceptAll(spark.read.parquet(archive).drop("run_id")).count() == 0


def test_dense_ids_split_a_hot_ordering_value(spark):
    # a third of the rows share one ordering value: still numbered 1..n in
    # order, and spread over several range partitions
    rows = [(0 if i % 3 == 0 else i, i) for i in range(600)]
    df = spark.createDataFrame(rows, "grp int, other int")
    out = dense_ids(df, ["grp"], "key", num_partitions=6)
    got = sorted((r.grp, r.other, r.key) for r in out.collect())
    assert [k for _, _, k in sorted(got, key=lambda t: t[2])] == list(range(1, 601))
    assert all(a[0] <= b[0] for a, b in zip(sorted(got, key=lambda t: t[2]), sorted(got, key=lambda t: t[2])[1:]))
    hot = df.filter("grp = 0").repartitionByRange(6, "grp", "other") \
        .groupBy(F.spark_partition_id().alias("p")).count()
    assert hot.count() > 1
