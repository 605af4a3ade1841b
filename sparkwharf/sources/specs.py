"""Declared tables: schema, keys, write mode and time column; and the projection onto them."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class TableSpec:
    name: str
    schema: T.StructType
    keys: tuple[str, ...] = ()
    mode: str = "append"  # append, upsert, insert_absent, current, replace_day
    time_column: str | None = None
    interval_min: int = 60
    critical: bool = False
    also_unique: tuple[tuple[str, ...], ...] = ()
    source: str = ""


def schema_of(ddl: str) -> T.StructType:
    """A schema from its text, which needs no session."""
    kinds = {"string": T.StringType(), "double": T.DoubleType(), "long": T.LongType(), "int": T.IntegerType()}
    return T.StructType([T.StructField(name, kinds[kind]) for name, kind in (x.split() for x in ddl.split(","))])


@dataclass
class Registry:
    """Source name to table specs; several tables may take one source's rows."""

    tables: dict[str, TableSpec] = field(default_factory=dict)

    def add(self, spec: TableSpec) -> TableSpec:
        if spec.name in self.tables:
            raise ValueError(f"{spec.name} is declared twice")
        if spec.mode not in ("append", "upsert", "insert_absent", "current", "replace_day"):
            raise ValueError(f"{spec.name}: no write mode {spec.mode}")
        if spec.mode != "append" and not spec.keys:
            raise ValueError(f"{spec.name}: mode {spec.mode} needs keys")
        missing = [c for k in (spec.keys, *spec.also_unique) for c in k if c not in spec.schema.names]
        if missing:
            raise ValueError(f"{spec.name}: keys without a column: {missing}")
        self.tables[spec.name] = spec
        return spec

    def of_source(self, source: str) -> list[TableSpec]:
        return [s for s in self.tables.values() if s.source == source]


def conform(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """The declared columns in order: missing ones null, others dropped, types cast without failing."""
    have = set(rows.columns)
    return rows.select(*[(F.col(f.name).try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in spec.schema])


#: Normalisers by source name: raw frame to clean frame.
NORMALISERS: dict[str, object] = {}


def normaliser(source: str):
    def add(f):
        NORMALISERS[source] = f
        return f

    return add
