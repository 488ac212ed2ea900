"""Change-data-capture apply and keyed upserts.

A change batch is folded to its latest change per key (a map-side-combined
aggregate, so a hot key is reduced before the shuffle), then merged with the
target in one full outer join: each side is read once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.operators.dedupe import dedupe

# Change operation codes
OP_CREATE, OP_READ, OP_UPDATE, OP_DELETE = "c", "r", "u", "d"
INSERT_OPS = [OP_CREATE, OP_READ]


def change_counts(changes: DataFrame, op: str = "op") -> DataFrame:
    """Inserts (``c``/``r``), updates and deletes in one pass (A4; the op
    filters of F3 folded into one aggregate)."""
    o = F.col(op)
    return changes.agg(
        F.count_if(o.isin(*INSERT_OPS)).alias("inserts"),
        F.count_if(o == OP_UPDATE).alias("updates"),
        F.count_if(o == OP_DELETE).alias("deletes"),
    )


def sequence(seq: list[str] | str) -> list[str]:
    return [seq] if isinstance(seq, str) else list(seq)


def latest_changes(changes: DataFrame, keys: list[str], seq: list[str] | str) -> DataFrame:
    """The last change per key by sequence (ties broken by the other columns)."""
    return dedupe(changes, keys, order=sequence(seq), keep="last")


DELETED = "_deleted"


def _at(op: str, seqs: list[str]) -> Column:
    """Where a change stands: its sequence, of equal ones a delete last."""
    return F.struct(*[F.col(c) for c in seqs], (F.col(op) == OP_DELETE).cast("int").alias("_rank"))


def fold_changes(changes: DataFrame, keys: list[str], *, op: str = "op", seq: str | list[str] = "seq",
                 value_cols: list[str], mode: str = "upsert") -> DataFrame:
    """What the changes of a batch come to, one row per key, as
    :func:`merge_folded` takes it. Grouped aggregates, so a hot key is reduced
    before the shuffle.

    ``upsert``: the last change (``_last``). ``strict``: the last delete
    (``_del``), and after it the first insert (``_ins``) and the last update
    (``_upd``): all that a sequence of MERGEs depends on.
    """
    if mode not in ("upsert", "strict"):
        raise ValueError("mode must be 'upsert' or 'strict'")
    row = F.struct(_at(op, sequence(seq)).alias("at"), *[F.col(v) for v in value_cols])
    is_delete = F.col(op) == OP_DELETE
    if mode == "upsert":
        return changes.groupBy(*keys).agg(F.max(F.struct(row.alias("row"), is_delete.alias("gone"))).alias("_last"))
    rows = changes.select(*keys, F.col(op).alias("_op"), row.alias("_row"))
    deletes = rows.filter(F.col("_op") == OP_DELETE).groupBy(*keys).agg(F.max("_row.at").alias("_del"))
    after = rows.join(deletes, keys, "left").filter(F.col("_del").isNull() | (F.col("_row.at") >= F.col("_del")))
    return after.groupBy(*keys).agg(
        F.max("_del").alias("_del"), F.min(F.when(F.col("_op").isin(*INSERT_OPS), F.col("_row"))).alias("_ins"),
        F.max(F.when(F.col("_op") == OP_UPDATE, F.col("_row"))).alias("_upd"))


def merge_folded(target: DataFrame | None, folded: DataFrame, keys: list[str], *, seq: str | list[str] = "seq",
                 value_cols: list[str], mode: str = "upsert", tombstones: bool = False) -> DataFrame:
    """Merge the output of :func:`fold_changes` into ``target``: one full outer
    join on the key, or no join where there is no target yet."""
    seqs = sequence(seq)
    has_target = target is not None
    if has_target:
        t = target.select(*keys, F.struct(*value_cols).alias("_t"),
                          F.struct(*[F.col(x) if x in target.columns else F.lit(None).cast("long").alias(x) for x in seqs]).alias("_t_at"),
                          (~F.col(DELETED) if DELETED in target.columns else F.lit(True)).alias("_live"), F.lit(True).alias("_stored"))
        both = t.join(folded, keys, "full_outer")
    else:
        both = folded
    stored = F.coalesce("_stored", F.lit(False)) if has_target else F.lit(False)
    live = stored & F.col("_live") if has_target else F.lit(False)

    def newer(at: Column) -> Column:
        change = F.struct(*[at[x].alias(x) for x in seqs])
        if not has_target:
            return at.isNotNull()
        # of equal sequences a delete is last, in a later batch too
        return at.isNotNull() & (F.col(f"_t_at.{seqs[0]}").isNull() | ~stored | (change > F.col("_t_at"))
                                 | ((change == F.col("_t_at")) & (at["_rank"] == 1) & live))

    if mode == "upsert":
        change, gone = F.col("_last.row"), F.coalesce(F.col("_last.gone"), F.lit(False))
        fresh = newer(change["at"])
        write, delete, gone_at = fresh & ~gone, fresh & gone, change["at"]
    else:
        stays = live & F.col("_del").isNull()
        updated = F.col("_upd").isNotNull() & (stays | (F.col("_upd.at") > F.col("_ins.at")))
        change = F.when(updated, F.col("_upd")).when(~stays, F.col("_ins"))
        write = F.coalesce(newer(change["at"]), F.lit(False))
        gone_at = F.col("_del")
        delete = ~write & live & newer(gone_at)
    keep = ~write & ~delete & stored
    out = both.filter(write | keep | delete) if tombstones else both.filter(write | (keep & live))

    def pick(written: Column, deleted: Column, kept: str) -> Column:
        column = F.when(write, written).when(delete, deleted)
        return column.otherwise(F.col(kept)) if has_target else column

    cols = [F.col(k) for k in keys] + [pick(change[v], F.lit(None), f"_t.{v}").alias(v) for v in value_cols]
    cols += [pick(change["at"][x], gone_at[x], f"_t_at.{x}").alias(x) for x in seqs]
    if tombstones:
        cols.append(F.when(write, F.lit(False)).when(delete, F.lit(True)).otherwise(~live).alias(DELETED))
    return out.select(*cols)


def apply_changes(target: DataFrame | None, changes: DataFrame, keys: list[str], *,
                  op: str = "op", seq: str | list[str] = "seq", value_cols: list[str] | None = None,
                  mode: str = "upsert", tombstones: bool = False) -> DataFrame:
    """Fold ``changes`` into ``target``; returns the new target.

    ``seq`` is a column or a list of columns (say a time and an offset) that
    order the changes. The target keeps those of the change that produced
    each row, so a replayed or late change (sequence not newer) is ignored;
    of equal sequences a delete is last.
    ``tombstones=True`` keeps deleted keys as rows flagged ``_deleted`` (with
    the delete's sequence), so a late change cannot resurrect a deleted row
    and batches may arrive in any order; read with :func:`live_rows`.

    ``mode="upsert"``: create/read/update all write the row, delete removes it.
    ``mode="strict"``: the warehouse MERGE rules (update needs an existing row,
    insert needs a missing one), as if the changes were merged one by one in
    their order: the result does not depend on how a log is cut into batches.
    """
    value_cols = value_cols or [c for c in changes.columns if c not in [*keys, op, *sequence(seq)]]
    folded = fold_changes(changes, keys, op=op, seq=seq, value_cols=value_cols, mode=mode)
    return merge_folded(target, folded, keys, seq=seq, value_cols=value_cols, mode=mode, tombstones=tombstones)


def live_rows(state: DataFrame) -> DataFrame:
    """Rows of a tombstoned state table that are not deleted."""
    if DELETED not in state.columns:
        return state
    return state.filter(~F.col(DELETED)).drop(DELETED)


def upsert(target: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """Last write wins: rows of ``updates`` replace target rows with the same key."""
    updates = updates.select(*target.columns)
    return target.join(updates.select(*keys), keys, "left_anti").unionByName(updates)


def delete_keys(target: DataFrame, deletes: DataFrame, keys: list[str]) -> DataFrame:
    return target.join(deletes.select(*keys), keys, "left_anti")


def insert_if_absent(target: DataFrame, seeds: DataFrame, keys: list[str]) -> DataFrame:
    """``INSERT ... WHERE NOT EXISTS`` as an anti join plus union."""
    seeds = seeds.select(*target.columns)
    return target.unionByName(seeds.join(target.select(*keys), keys, "left_anti"))
