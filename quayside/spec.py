"""Schema specs (section 1.3): columns with type, nullability and format,
required columns, partition columns, output column lists and the
extra/missing/empty-file flags, loaded from YAML or a dict. Every flag is
honoured by the jobs that use the spec."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import types as T

# spec type name -> Spark SQL type name
TYPE_NAMES = {
    "string": "string", "integer": "int", "int": "int", "long": "bigint", "bigint": "bigint",
    "float": "float", "double": "double", "boolean": "boolean", "date": "date",
    "timestamp": "timestamp_ntz", "timestamp_ntz": "timestamp_ntz",
}

_STRFTIME = [("%Y", "yyyy"), ("%m", "MM"), ("%d", "dd"), ("%H", "HH"), ("%M", "mm"), ("%S", "ss"),
             ("%b", "MMM"), ("%y", "yy"), ("%f", "SSSSSS")]


def spark_datetime_pattern(fmt: str) -> str:
    """strftime-style format -> Spark datetime pattern."""
    out = fmt
    for a, b in _STRFTIME:
        out = out.replace(a, b)
    return re.sub(r"T", "'T'", out)


@dataclass
class ColumnSpec:
    name: str
    type: str = "string"
    nullable: bool = True
    format: str | None = None

    @property
    def spark_type(self) -> str:
        try:
            return TYPE_NAMES[self.type]
        except KeyError as exc:
            raise ValueError(f"unknown type {self.type!r} for column {self.name}") from exc

    @property
    def spark_format(self) -> str | None:
        return spark_datetime_pattern(self.format) if self.format else None


@dataclass
class SchemaSpec:
    columns: list[ColumnSpec]
    required_columns: list[str] = field(default_factory=list)
    partition_columns: dict[str, str] = field(default_factory=dict)
    output_columns: list[str] | None = None
    business_key: list[str] = field(default_factory=list)
    allow_extra_columns: bool = True
    allow_missing_columns: bool = False
    allow_empty_file: bool = True
    name_overrides: dict[str, str] = field(default_factory=dict)

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def types(self) -> dict[str, str]:
        return {c.name: c.spark_type for c in self.columns}

    @property
    def formats(self) -> dict[str, str]:
        return {c.name: c.spark_format for c in self.columns if c.format}

    @property
    def not_null(self) -> list[str]:
        return [c.name for c in self.columns if not c.nullable]

    def struct(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, T._parse_datatype_string(c.spark_type), c.nullable)
                             for c in self.columns])

    @classmethod
    def from_dict(cls, d: dict) -> SchemaSpec:
        validation = d.get("validation", {})
        cols = [ColumnSpec(name=n, type=(v or {}).get("type", "string"), nullable=(v or {}).get("nullable", True),
                           format=(v or {}).get("format")) for n, v in (d.get("columns") or {}).items()]
        required = validation.get("required_columns", d.get("required_columns", [c.name for c in cols]))
        flags = {k: validation.get(k, d.get(k)) for k in
                 ("allow_extra_columns", "allow_missing_columns", "allow_empty_file")}
        return cls(
            columns=cols, required_columns=list(required),
            partition_columns=dict(d.get("partition_columns") or {}),
            output_columns=d.get("gold_columns") or d.get("output_columns"),
            business_key=list(d.get("business_key") or []),
            name_overrides=dict(d.get("name_overrides") or {}),
            **{k: v for k, v in flags.items() if v is not None},
        )

    @classmethod
    def from_yaml(cls, path: str, source: str) -> SchemaSpec:
        import yaml

        with open(path, encoding="utf-8") as fh:
            doc = yaml.safe_load(fh)
        sources = doc.get("sources", doc)
        if source not in sources:
            raise ValueError(f"source {source!r} not in {path}")
        return cls.from_dict(sources[source])
