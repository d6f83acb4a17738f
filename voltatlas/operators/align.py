"""Fit a table to a target schema."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltatlas.functions.timestamps import coerce_ts_column, warehouse_ts
from voltatlas.specs import struct

_NESTED = (T.StructType, T.ArrayType, T.MapType)


def _repeated(names: Sequence[str]) -> list[str]:
    return sorted(n for n, k in Counter(x.lower() for x in names).items() if k > 1)


def lower_columns(df: DataFrame) -> DataFrame:
    clash = _repeated(df.columns)
    if clash:
        raise ValueError(f"columns differ only in case: {clash}")
    return df.toDF(*[c.lower() for c in df.columns])


def align(df: DataFrame, target: T.StructType | str, ts_mode: str = "warehouse") -> DataFrame:
    """Columns of ``target``, in its order and types.

    Names match in any case; missing columns become typed NULLs, extra ones
    go.  Timestamps that cannot be read become NULL; every other bad value
    stops the job.  ``ts_mode`` 'warehouse' reads timestamp text as the load
    does, 'coerce' applies the unit rules of ``coerce_ts``.
    """
    target = struct(target)
    for what, names in (("target", target.names), ("source", df.columns)):
        clash = _repeated(names)
        if clash:
            raise ValueError(f"duplicate {what} columns: {clash}")
    found = {c.lower(): c for c in df.columns}

    def fit(field: T.StructField) -> Column:
        name = found.get(field.name.lower())
        if name is None:
            return F.lit(None).cast(field.dataType).alias(field.name)
        source, c = df.schema[name].dataType, df[name]
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            if isinstance(source, T.StringType):
                c = warehouse_ts(c) if ts_mode == "warehouse" else coerce_ts_column(df, name, "struct_first")
            elif not isinstance(source, (T.TimestampType, T.TimestampNTZType, T.DateType)):
                c = coerce_ts_column(df, name, "struct_first")
        elif isinstance(field.dataType, T.StringType) and isinstance(source, _NESTED):
            c = F.to_json(c, {"ignoreNullFields": "false"})
        return c.cast(field.dataType).alias(field.name)

    return df.select(*[fit(f) for f in target.fields])


def evolve(target: T.StructType | str, wanted: T.StructType | str) -> T.StructType:
    """``target`` plus the columns of ``wanted`` it lacks; nothing is changed or dropped."""
    target, wanted = struct(target), struct(wanted)
    have = {n.lower() for n in target.names}
    return T.StructType([*target.fields, *[f for f in wanted.fields if f.name.lower() not in have]])


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    """All rows of all parts by column name; a column missing in one part is NULL there."""
    if not parts:
        raise ValueError("nothing to union")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def union_levels(parts: dict[str, DataFrame], column: str = "level") -> DataFrame:
    """The parts as one table, each labelled with its key."""
    return union_all([df.withColumn(column, F.lit(k)) for k, df in parts.items()])
