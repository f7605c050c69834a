"""One row of those that agree in some columns, the same one in every run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _ordered(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_ordered(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _ordered(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType))


def one_of_each(frame: DataFrame, keys: list[str]) -> DataFrame:
    """Of the rows with equal ``keys`` (nulls are equal) the least by the other columns, without the key columns.

    Partial minimums meet, so keys that very many rows share are no burden. Columns that have no order (maps) don't
    decide, but come from the chosen row.
    """
    names = [c for c in frame.columns if c not in keys]
    least = [F.col(f"`{f.name}`") for f in frame.schema.fields if f.name not in keys and _ordered(f.dataType)]
    row = F.struct(*(F.col(f"`{c}`") for c in names))
    best = F.min(row) if len(least) == len(names) else F.min_by(row, F.struct(*(least or [F.lit(0)])))
    return frame.groupBy(*keys).agg(best.alias("__row")).select("__row.*")
