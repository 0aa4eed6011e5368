"""Table scans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import col, present

# fixed values: texts read as missing in delimited files
MISSING_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def _number(c: str, kind: str) -> Column:
    """A plain decimal number; Spark alone would also read 1D or 3f as one."""
    return F.when(col(c).rlike(NUMBER), col(c).try_cast(kind))


def read_delimited(
    spark: SparkSession, path: str, sep: str = "\t", schema: T.StructType | str | None = None
) -> DataFrame:
    """Headed, delimited text.

    With a schema the file is scanned once; without one a pass over the text decides
    the types. All usual missing texts become NULL before a type is chosen: the
    columns are read as text and tried as whole numbers, then as doubles. Anything
    that is not a plain decimal number, true and false included, stays text.
    """
    reader = spark.read.option("sep", sep).option("header", True).option("nullValue", "NA")
    raw = reader.csv(path)
    clean = raw.select(
        *[F.when(~col(c).isin(*MISSING_TEXTS), col(c)).alias(c) for c in raw.columns]
    )
    if schema is not None:
        wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        kinds = {f.name: f.dataType for f in wanted}
    else:
        kinds = _inferred(clean)
    return clean.select(*[col(c).try_cast(kinds.get(c, T.StringType())).alias(c) for c in clean.columns])


def _inferred(clean: DataFrame) -> dict[str, T.DataType]:
    exprs = []
    for i, c in enumerate(clean.columns):
        exprs += [
            F.count(col(c)).alias(f"n{i}"),
            F.count(_number(c, "long")).alias(f"l{i}"),
            F.count(_number(c, "double")).alias(f"d{i}"),
        ]
    row = clean.agg(*exprs).first()
    kinds = {}
    for i, c in enumerate(clean.columns):
        if row[f"d{i}"] < row[f"n{i}"]:
            kinds[c] = T.StringType()
        elif row[f"n{i}"] and row[f"l{i}"] == row[f"n{i}"]:
            kinds[c] = T.LongType()
        else:
            kinds[c] = T.DoubleType()
    return kinds


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def nan_as_null(df: DataFrame) -> DataFrame:
    return df.select(*[present(df, c).alias(c) for c in df.columns])
