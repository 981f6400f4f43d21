"""CSV extracts."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

WIDE = T.DecimalType(38, 18)
# What a column becomes if values do not fit its declared type: the first that holds all of them, text at last.
WIDER: dict[str, tuple[T.DataType, ...]] = {
    "int": (T.LongType(), T.DoubleType(), WIDE),
    "bigint": (T.DecimalType(38, 0), T.DoubleType(), WIDE),
    "double": (WIDE,),
}


def read_csv(
    spark: SparkSession,
    path: str,
    types: Mapping[str, T.DataType] | None = None,
    multi_line: bool = True,
) -> DataFrame:
    """Read CSV with a header, quoted fields and doubled quotes; short rows are
    padded with NULL and surplus fields dropped.

    ``types`` declares the known columns. They are bound by header name, so column
    order does not matter; columns it does not name pass through as text. No value is lost to
    a type: a column with values that do not fit becomes wider, text in the end (see
    ``fitting_types``), which takes one more pass over the data, as inference does. With ``types=None`` Spark
    infers all types.

    ``multi_line`` allows line breaks inside quoted fields. Such a file cannot be
    split, so a large extract should come as a folder of many files (or be read
    with ``multi_line=False`` where no field can hold a line break).
    """
    reader = (
        spark.read.option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .option("multiLine", multi_line)
    )
    if types is None:
        return reader.option("inferSchema", True).csv(path)
    header = reader.csv(path).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
    # enforceSchema=False: a file in the folder with another header is an error, not a silent shift
    raw = reader.schema(schema).option("enforceSchema", False).csv(path)
    return as_types(raw, fitting_types(raw, types))


def as_types(raw: DataFrame, types: Mapping[str, T.DataType]) -> DataFrame:
    """Text columns in the given types, which must fit; a blank is NULL unless the column stays text."""
    return raw.select(*[_parsed(F.col(f"`{c}`"), types.get(c, T.StringType())).alias(c) for c in raw.columns])


def fitting_types(raw: DataFrame, types: Mapping[str, T.DataType]) -> dict[str, T.DataType]:
    """For each declared column of a table of texts the first type that holds all its values: the declared
    one, one of ``WIDER``, or text. One aggregate over all columns by their declared types, and another one by wider types only
    over columns that do not fit and have no value that none of these takes."""
    fitting = {c: t for c, t in types.items() if c in raw.columns and t != T.StringType()}
    if not fitting:
        return {}
    wider = {c: WIDER.get(t.simpleString(), ()) for c, t in fitting.items()}
    counts = []
    for i, (c, t) in enumerate(fitting.items()):
        lost = misfit(F.col(f"`{c}`"), t)
        text = reduce(Column.__and__, [F.trim(F.col(f"`{c}`")).try_cast(w).isNull() for w in wider[c]], lost)
        counts += [F.count_if(lost).alias(f"{i}_lost"), F.count_if(text).alias(f"{i}_text")]
    row = raw.agg(*counts).first()
    texts = {c: row[f"{i}_text"] for i, c in enumerate(fitting) if row[f"{i}_lost"]}
    fitting.update(dict.fromkeys(texts, T.StringType()))
    ladders = {c: wider[c] for c, n in texts.items() if not n}
    if not ladders:
        return fitting
    counts = [F.count_if(misfit(F.col(f"`{c}`"), t)).alias(f"{i}_{k}") for i, (c, ladder) in enumerate(ladders.items()) for k, t in enumerate(ladder)]
    row = raw.agg(*counts).first()
    for i, (c, ladder) in enumerate(ladders.items()):
        fitting[c] = next((t for k, t in enumerate(ladder) if not row[f"{i}_{k}"]), T.StringType())
    return fitting


def misfits(raw: DataFrame, types: Mapping[str, T.DataType]) -> DataFrame:
    """(columna, desajustes): how many values of each declared column its type would lose."""
    counts = raw.agg(*[F.count_if(misfit(F.col(f"`{c}`"), t)).alias(c) for c, t in types.items() if c in raw.columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("columna"), F.col(f"`{c}`").alias("desajustes")) for c in counts.columns])
    return counts.select(F.explode(pairs).alias("p")).select("p.*")


def misfit(text: Column, kind: T.DataType) -> Column:
    """Whether a value would be lost or changed as ``kind``."""
    value = F.trim(text)
    parsed = value.try_cast(kind)
    lost = parsed.isNull()
    if isinstance(kind, T.DecimalType):
        # more digits than the type has places for are rounded off; exponents are not looked into
        fraction = F.length(F.regexp_extract(value, r"\.([0-9]*?)0*$", 1))
        lost = lost | (value.contains(".") & (fraction > kind.scale)) | F.rlike(value, F.lit("[eE]"))
    elif isinstance(kind, T.DoubleType):
        # up to 15 digits a double gives back; of longer ones those it prints itself
        digits = F.length(F.regexp_replace(F.regexp_replace(value, "[eE].*$", ""), "[^0-9]", ""))
        lost = lost | ((F.length(value) > 15) & (digits > 15) & (parsed.cast("string") != value))
    return (F.length(value) > 0) & lost


def _parsed(text: Column, kind: T.DataType) -> Column:
    if kind == T.StringType():
        return text
    value = F.trim(text)
    return F.when(F.length(value) > 0, value.try_cast(kind))
