"""Column addressing, type classes and seeded hashing."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def col(name: str) -> Column:
    """Column by its literal name: spaces, dots and leading digits are allowed."""
    return F.col("`" + name.replace("`", "``") + "`")


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def string_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType) and f.name not in skip]


def is_fractional(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType))


def present(df: DataFrame, name: str) -> Column:
    """The value with NaN read as NULL, so that one missing concept is left."""
    if is_fractional(df, name):
        return F.nanvl(col(name), F.lit(None).cast(df.schema[name].dataType))
    return col(name)


def missing(df: DataFrame, name: str) -> Column:
    return present(df, name).isNull()


def as_double(df: DataFrame, name: str) -> Column:
    return present(df, name).cast("double")


def require(df: DataFrame, names: Iterable[str]) -> None:
    absent = [n for n in names if n not in df.columns]
    if absent:
        raise KeyError(f"column(s) {absent} are required; available: {sorted(df.columns)[:10]}")


def require_unique(df: DataFrame, id_cols: Sequence[str]) -> None:
    """One shuffle on the key; run it once at the edge, not in every operator."""
    repeated = df.groupBy(*[col(c) for c in id_cols]).count().filter("count > 1").limit(1).count()
    if repeated:
        raise ValueError(f"{list(id_cols)} is not a unique row key")


def id_hash(id_cols: Sequence[str], seed: int, *salt: Column) -> Column:
    """64-bit order key that depends on the row id and seed, never on partitioning."""
    return F.xxhash64(F.lit(int(seed)), *salt, *[col(c) for c in id_cols])


def batches(items: Sequence, size: int) -> list[Sequence]:
    """Wide aggregates are issued in slices so that generated code stays small."""
    return [items[i : i + size] for i in range(0, len(items), size)]
