"""Schema sync of tables kept in place (H3).

A record beside the table (``<path>_schema.json``) holds its schema, a version and the
columns it dropped. Files keep the columns they were written with; a reader asks for the
recorded schema, so a file from before a column was added reads it as NULL, a file with
a narrower type is widened, and a dropped column is not asked for. A change is decided
by ``plan_sync`` and published by the writer: before any partition of the new schema
can be seen, since old files read under the new schema but not the other way round.

What the files can't express - a type that is not wider, a name that comes back after it
was dropped - needs all partitions rewritten once (``Sync.rewrite``).
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlake.plans.tables import exists, read_marker, write_marker

#: Types that hold every value of those before them, and that Parquet readers widen to.
_CHAINS: tuple[tuple[type[T.DataType], ...], ...] = (
    (T.ByteType, T.ShortType, T.IntegerType, T.LongType),
    (T.ByteType, T.ShortType, T.IntegerType, T.DoubleType),
    (T.FloatType, T.DoubleType),
    (T.DateType, T.TimestampNTZType),
)


def wider(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The one of two types that holds all values of both, or None."""
    if a == b:
        return a
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        whole, scale = max(a.precision - a.scale, b.precision - b.scale), max(a.scale, b.scale)
        both = T.DecimalType(min(38, whole + scale), scale)
        return both if whole + scale <= 38 and both in (a, b) else None
    for chain in _CHAINS:
        if type(a) in chain and type(b) in chain:
            return max(a, b, key=lambda t: chain.index(type(t)))
    return None


@dataclass(frozen=True)
class Record:
    schema: T.StructType
    version: int = 0
    dropped: tuple[str, ...] = ()

    def to_json(self) -> dict:
        return {"version": self.version, "dropped": list(self.dropped), "schema": json.loads(self.schema.json())}

    @staticmethod
    def from_json(value: dict) -> Record:
        return Record(T.StructType.fromJson(value["schema"]), value["version"], tuple(value["dropped"]))


@dataclass(frozen=True)
class Sync:
    record: Record
    added: tuple[str, ...] = ()
    removed: tuple[str, ...] = ()
    retyped: tuple[str, ...] = ()
    rewrite: bool = False

    @property
    def changed(self) -> bool:
        return bool(self.added or self.removed or self.retyped)


def plain(schema: T.StructType) -> T.StructType:
    """The schema with every column nullable, as files are read."""
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


def plan_sync(record: Record, incoming: T.StructType) -> Sync:
    """The record after rows of ``incoming`` arrive: its columns in its order. A column
    keeps the wider of both types; one that neither holds takes the incoming type."""
    old = {f.name: f.dataType for f in record.schema.fields}
    fields, added, retyped, rewrite = [], [], [], False
    for f in plain(incoming).fields:
        kind = f.dataType
        if f.name not in old:
            added.append(f.name)
            rewrite |= f.name in record.dropped
        else:
            both = wider(old[f.name], f.dataType)
            kind = both or f.dataType
            rewrite |= both is None
            if kind != old[f.name]:
                retyped.append(f.name)
        fields.append(T.StructField(f.name, kind, True))
    names = {f.name for f in fields}
    removed = [n for n in old if n not in names]
    dropped = () if rewrite else tuple(sorted({*record.dropped, *removed}))
    schema = T.StructType(fields)
    if not (added or removed or retyped):
        return Sync(Record(schema, record.version, record.dropped))
    return Sync(Record(schema, record.version + 1, dropped), tuple(added), tuple(removed), tuple(retyped), rewrite)


def reshape(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with the columns and types of ``schema``; a column it lacks is NULL."""
    have = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for f in schema.fields:
        if f.name not in have:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif have[f.name] == f.dataType:
            out.append(F.col(f"`{f.name}`"))
        else:
            out.append(F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name))
    return df.select(*out)


def synced(kept: DataFrame, rebuilt: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both frames in the schema that the table has once ``rebuilt`` arrives."""
    schema = plan_sync(Record(kept.schema), rebuilt.schema).record.schema
    return reshape(kept, schema), reshape(rebuilt, schema)


def record_path(path: str) -> str:
    return path.rstrip("/") + "_schema.json"


def read_record(spark: SparkSession, path: str) -> Record | None:
    """The table's record; a table written before it had one is described by its files."""
    value = read_marker(spark, record_path(path))
    if value is not None:
        return Record.from_json(value)
    return Record(plain(spark.read.parquet(path).schema)) if exists(spark, path) else None


def write_record(spark: SparkSession, path: str, record: Record) -> None:
    write_marker(spark, record_path(path), record.to_json())


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The table in its recorded schema, or None if there is none."""
    record = read_record(spark, path)
    if record is None or not exists(spark, path):
        return None
    return spark.read.schema(record.schema).parquet(path).select(*[f"`{n}`" for n in record.schema.names])
