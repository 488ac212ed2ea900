import os

import pytest

from quayside.operators.cdc import apply_changes
from quayside.session import scratch_path
from quayside.sinks import bucketed
from quayside.sinks.bucketed import merge_into_bucketed, read_bucketed

SCHEMA = "key int, seq long, op string, v string"


def _files(base):
    root = base.replace("file:", "") + "/data"
    out = {}
    for d in sorted(os.listdir(root)):
        if d.startswith("_bucket="):
            out[d] = sorted(f for f in os.listdir(os.path.join(root, d)) if f.endswith(".parquet"))
    return out


def test_bucketed_merge_equals_batch_fold_and_scopes_rewrites(spark):
    base = scratch_path(spark, "bstate")
    b1 = [(k, k, "c", f"v{k}") for k in range(40)]
    b2 = [(3, 100, "u", "x"), (5, 101, "d", None), (3, 102, "u", "y")]
    assert merge_into_bucketed(spark, base, spark.createDataFrame(b1, SCHEMA), ["key"], batch_id=0, buckets=8,
                               value_cols=["v"])
    before = _files(base)
    assert merge_into_bucketed(spark, base, spark.createDataFrame(b2, SCHEMA), ["key"], batch_id=1, buckets=8,
                               value_cols=["v"])
    after = _files(base)
    changed = [b for b in before if before[b] != after[b]]
    assert 1 <= len(changed) <= 2, changed  # only the buckets of keys 3 and 5 were rewritten
    got = {r.key: r.v for r in read_bucketed(spark, base).collect()}
    want = {r.key: r.v for r in apply_changes(None, spark.createDataFrame(b1 + b2, SCHEMA), ["key"],
                                              value_cols=["v"]).collect()}
    assert got == want and got[3] == "y" and 5 not in got
    # a replayed batch id is skipped
    assert not merge_into_bucketed(spark, base, spark.createDataFrame(b2, SCHEMA), ["key"], batch_id=1, buckets=8,
                                   value_cols=["v"])
    with pytest.raises(ValueError):
        merge_into_bucketed(spark, base, spark.createDataFrame(b2, SCHEMA), ["key"], batch_id=2, buckets=16,
                            value_cols=["v"])


@pytest.mark.parametrize("crash_at", ["_STAGED", "_LAST_BATCH"])
def test_bucketed_recovers_from_a_crash_between_steps(spark, monkeypatch, crash_at):
    """Killed before the staging folder is marked complete, or after the copy
    but before the batch is recorded: the replayed batch gives the result."""
    base = scratch_path(spark, "bstate2")
    merge_into_bucketed(spark, base, spark.createDataFrame([(k, k, "c", "a") for k in range(20)], SCHEMA), ["key"],
                        batch_id=0, buckets=4, value_cols=["v"])
    batch = spark.createDataFrame([(1, 50, "u", "b")], SCHEMA)
    whole = bucketed.write_marker

    def crash(session, path, text):
        if crash_at in path:
            raise RuntimeError("killed")
        whole(session, path, text)

    monkeypatch.setattr(bucketed, "write_marker", crash)
    with pytest.raises(RuntimeError, match="killed"):
        merge_into_bucketed(spark, base, batch, ["key"], batch_id=1, buckets=4, value_cols=["v"])
    monkeypatch.setattr(bucketed, "write_marker", whole)
    assert merge_into_bucketed(spark, base, batch, ["key"], batch_id=1, buckets=4, value_cols=["v"])
    got = {r.key: r.v for r in read_bucketed(spark, base).collect()}
    assert len(got) == 20 and got[1] == "b"
    root = base.replace("file:", "")
    assert not os.path.exists(f"{root}/staging") or not any(d.startswith("batch-") for d in os.listdir(f"{root}/staging"))


def test_a_new_checkpoint_counts_from_zero_again(spark):
    base = scratch_path(spark, "bstate3")
    for scope, batch_id, row in (("one", 0, (1, 1, "c", "a")), ("one", 1, (2, 2, "c", "b")), ("two", 0, (3, 3, "c", "c")),
                                 ("two", 1, (2, 2, "c", "replayed"))):
        assert merge_into_bucketed(spark, base, spark.createDataFrame([row], SCHEMA), ["key"], batch_id=batch_id, buckets=4,
                                   value_cols=["v"], scope=scope)
    assert {r.key: r.v for r in read_bucketed(spark, base).collect()} == {1: "a", 2: "b", 3: "c"}


def test_pointer_is_never_missing_and_old_versions_go(spark):
    from quayside.sinks.tables import current_version, publish, read_published, remove_path

    base = scratch_path(spark, "published")
    for n in range(4):
        assert publish(spark.range(n + 1), base) == n + 1
        assert read_published(spark, base).count() == n + 1
    assert sorted(d for d in os.listdir(base.replace("file:", "")) if d.startswith("v=")) == ["v=3", "v=4"]
    remove_path(spark, f"{base}/_CURRENT")
    with pytest.raises(FileNotFoundError):
        current_version(spark, base)
