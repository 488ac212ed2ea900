"""Conformance and cleaning.

Every multi-column step is one ``select`` over all columns, so a 109-column
table adds one projection to the plan, not 109.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions.names import standardize_column_name


def standardize_columns(df: DataFrame, overrides: dict[str, str] | None = None) -> DataFrame:
    """Rename every column by the standard rule (metadata only).

    Raises when two source names collapse onto one standard name.
    """
    overrides = overrides or {}
    names = [overrides.get(c, standardize_column_name(c)) for c in df.columns]
    seen: dict[str, str] = {}
    for src, dst in zip(df.columns, names):
        if dst in seen:
            raise ValueError(f"columns {seen[dst]!r} and {src!r} both standardise to {dst!r}")
        seen[dst] = src
    return df.toDF(*names)


def _string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def blank_to_null(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Empty or space-only strings become NULL (only string columns can be blank)."""
    targets = set(columns if columns is not None else _string_columns(df))
    return df.select(*[
        F.when(F.trim(F.col(c)) == "", F.lit(None).cast("string")).otherwise(F.col(c)).alias(c)
        if c in targets else F.col(c)
        for c in df.columns])


def trim_strings(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    targets = set(columns if columns is not None else _string_columns(df))
    return df.select(*[F.trim(F.col(c)).alias(c) if c in targets else F.col(c) for c in df.columns])


def _cast_expr(c: str, type_name: str, fmt: str | None) -> Column:
    col = F.col(c)
    if type_name in ("timestamp", "timestamp_ntz") and fmt:
        parsed = F.try_to_timestamp(col.cast("string"), F.lit(fmt))
        return parsed.cast(type_name)
    if type_name == "date" and fmt:
        return F.try_to_timestamp(col.cast("string"), F.lit(fmt)).cast("date")
    return col.try_cast(type_name)


def cast_to_spec(df: DataFrame, types: dict[str, str], formats: dict[str, str] | None = None,
                 on_error: str = "null") -> DataFrame:
    """Cast columns to the declared types in one projection.

    ``on_error="null"``: unparsable values become NULL (pre-ANSI behaviour).
    ``on_error="fail"``: plain ``cast``; the first bad value fails the job.
    For a reject table use :func:`cast_rejects` on the same input.
    """
    formats = formats or {}
    exprs = []
    for c in df.columns:
        if c not in types:
            exprs.append(F.col(c))
        elif on_error == "fail":
            exprs.append(F.col(c).cast(types[c]).alias(c))
        elif on_error == "null":
            exprs.append(_cast_expr(c, types[c], formats.get(c)).alias(c))
        else:
            raise ValueError("on_error must be 'null' or 'fail'")
    return df.select(*exprs)


def cast_rejects(df: DataFrame, types: dict[str, str], formats: dict[str, str] | None = None,
                 reason_col: str = "_rejected_columns") -> DataFrame:
    """Rows where a non-NULL value does not parse as its declared type."""
    formats = formats or {}
    bad = [F.when(F.col(c).isNotNull() & _cast_expr(c, t, formats.get(c)).isNull(), F.lit(c))
           for c, t in types.items() if c in df.columns]
    if not bad:
        return df.limit(0).withColumn(reason_col, F.lit(None).cast("string"))
    reasons = F.concat_ws(",", *bad)
    return df.withColumn(reason_col, reasons).filter(F.col(reason_col) != "")


def conform(df: DataFrame, names: list[str], missing: str = "fail", fill=None,
            types: dict[str, str] | None = None) -> DataFrame:
    """Project to ``names`` in order.

    ``missing="fail"`` raises on absent columns; ``missing="fill"`` adds them
    as the literal ``fill`` (cast to ``types[name]`` when given).
    """
    types = types or {}
    absent = [n for n in names if n not in df.columns]
    if absent and missing == "fail":
        raise ValueError(f"missing columns: {absent}")
    exprs = []
    for n in names:
        if n in df.columns:
            exprs.append(F.col(n))
        else:
            lit = F.lit(fill)
            exprs.append((lit.cast(types[n]) if n in types else lit).alias(n))
    return df.select(*exprs)


def fill_unknown(df: DataFrame, values: dict[str, object]) -> DataFrame:
    """NULL -> replacement per column, one projection."""
    return df.select(*[
        F.coalesce(F.col(c), F.lit(values[c])).alias(c) if c in values else F.col(c)
        for c in df.columns])


def null_tokens(df: DataFrame, columns: list[str], tokens: list[str]) -> DataFrame:
    """Placeholder tokens (``-``, ``""``, ...) -> NULL."""
    targets = set(columns)
    return df.select(*[
        F.when(F.trim(F.col(c)).isin(*tokens), F.lit(None).cast("string")).otherwise(F.col(c)).alias(c)
        if c in targets else F.col(c) for c in df.columns])


def exclude_containing(df: DataFrame, column: str, needle: str) -> DataFrame:
    """Drop rows whose ``column`` contains ``needle`` in any case; NULL kept."""
    pattern = "%" + needle.replace("%", "\\%").replace("_", "\\_") + "%"
    return df.filter(~F.coalesce(F.col(column).ilike(pattern), F.lit(False)))
