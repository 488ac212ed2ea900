"""Spec-driven silver build (D12): raw landed snapshot -> typed, validated,
de-duplicated snapshot table.

S1 read -> P1 standardise names -> Q1 column check -> P3 blank->NULL ->
P5 trim -> P4 cast -> Q2 not-null -> P6 snapshot columns -> A6 dedupe per
(key, snapshot) -> P7 column order -> K1 partitioned write.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.operators.clean import blank_to_null, cast_to_spec, standardize_columns, trim_strings
from quayside.operators.dedupe import dedupe
from quayside.operators.quality import DataQualityError, check_columns, raise_on_nulls
from quayside.sinks.tables import write_snapshot
from quayside.spec import SchemaSpec

PARTITION_SOURCES = {"snapshot_year": "year", "snapshot_month": "month", "snapshot_day": "day"}


def clean_snapshot(raw: DataFrame, spec: SchemaSpec, *, on_null: str = "fail") -> DataFrame:
    """Everything up to the write. ``on_null``: ``fail`` raises on NULLs in
    non-nullable columns, ``drop`` removes such rows, ``keep`` keeps them."""
    df = standardize_columns(raw, spec.name_overrides)
    partition_src = [PARTITION_SOURCES.get(p, p) for p in spec.partition_columns]
    data_cols = [c for c in df.columns if c not in partition_src]
    check_columns(df.select(*data_cols), spec.required_columns, allow_extra=spec.allow_extra_columns,
                  allow_missing=spec.allow_missing_columns)
    missing_parts = [p for p in partition_src if p not in df.columns]
    if missing_parts:
        raise DataQualityError(f"partition columns missing from the landed data: {missing_parts}")
    if not spec.allow_empty_file and df.isEmpty():
        raise DataQualityError("empty input and allow_empty_file is false")
    # a column that may be missing and is, is NULL: the table's schema stays
    df = df.withColumns({c: F.lit(None).cast("string") for c in spec.names if c not in df.columns and c not in spec.partition_columns})
    df = trim_strings(blank_to_null(df))
    df = cast_to_spec(df, spec.types, spec.formats)
    if spec.not_null:
        if on_null == "fail":
            raise_on_nulls(df, spec.not_null)
        elif on_null == "drop":
            df = df.filter(_all_not_null(spec.not_null))
        elif on_null != "keep":
            raise ValueError("on_null must be 'fail', 'drop' or 'keep'")
    snap = {p: F.col(PARTITION_SOURCES.get(p, p)).cast(t if t != "integer" else "int")
            for p, t in spec.partition_columns.items()}
    df = df.withColumns(snap).drop(*[s for s in partition_src if s not in spec.partition_columns])
    keys = (spec.business_key or spec.names[:1]) + list(spec.partition_columns)
    present = [c for c in spec.names if c in df.columns]
    df = dedupe(df.select(*present, *spec.partition_columns), keys, order=[], keep="first")
    return df.select(*present, *spec.partition_columns)


def _all_not_null(columns: list[str]):
    cond = F.lit(True)
    for c in columns:
        cond = cond & F.col(c).isNotNull()
    return cond


def build_silver(raw: DataFrame, spec: SchemaSpec, out_path: str, *, on_null: str = "fail") -> dict:
    """Clean ``raw`` and overwrite only the snapshots it contains. Returns the
    rows written, observed by the write (no extra count)."""
    written = write_snapshot(clean_snapshot(raw, spec, on_null=on_null), out_path, list(spec.partition_columns))
    return {"rows_out": written}
