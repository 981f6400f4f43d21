"""Types that hold all values of a column whose type has changed."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, functions as F, types as T

DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}
WIDE = T.DecimalType(38, 18)
TEXT = T.StringType()
#: What two types that neither holds the other's values of may become, the first that fits, text in the end.
LADDER = (T.LongType(), T.DecimalType(38, 0), T.DoubleType(), WIDE, T.TimestampNTZType(), T.TimestampType())


def holds(wide: T.DataType, kind: T.DataType) -> bool | None:
    """Whether type ``wide`` has every value of ``kind`` exactly; None if that depends on the values (see ``fits``)."""
    if wide == kind or wide == TEXT:
        return True
    whole = DIGITS.get(kind.simpleString())
    if whole:
        if isinstance(wide, T.DecimalType):
            return wide.precision - wide.scale >= whole
        if isinstance(wide, T.DoubleType):
            return True if whole <= 10 else None
        return DIGITS.get(wide.simpleString(), 0) >= whole
    if isinstance(kind, T.FloatType) and isinstance(wide, T.DoubleType):
        return True
    if isinstance(kind, T.DecimalType):
        if isinstance(wide, T.DecimalType):
            return wide.scale >= kind.scale and wide.precision - wide.scale >= kind.precision - kind.scale
        return None if isinstance(wide, T.DoubleType) else False
    if isinstance(kind, T.DoubleType) and isinstance(wide, T.DecimalType):
        return None
    return isinstance(kind, T.DateType) and isinstance(wide, (T.TimestampType, T.TimestampNTZType))


def fits(value: Column, kind: T.DataType, wide: T.DataType) -> Column:
    """Whether a value of ``kind`` is the same as ``wide``; NULL is."""
    if isinstance(kind, T.LongType):
        same = F.abs(value.cast("decimal(19,0)")) <= F.lit(2**53)
    else:
        same = value.try_cast(wide).try_cast(kind) == value
    return value.isNull() | F.coalesce(same, F.lit(False))


def widest(a: T.DataType, b: T.DataType, measured: Callable[[T.DataType, T.DataType], bool]) -> T.DataType:
    """The first of both types, ``LADDER`` and text that holds the values of both. ``measured(kind, wide)`` tells whether the stored values of a
    type fit another where the types alone do not tell."""

    def takes(wide: T.DataType, kind: T.DataType) -> bool:
        known = holds(wide, kind)
        return measured(kind, wide) if known is None else known

    return next((t for t in (a, b, *LADDER) if t != TEXT and takes(t, a) and takes(t, b)), TEXT)


def as_type(value: Column, kind: T.DataType, wide: T.DataType) -> Column:
    return value if kind == wide else value.cast(wide)


def key_text(value: Column, kind: T.DataType) -> Column:
    """A key as text that does not depend on the type it has in one extract: 7, 7.0 and '7' are one key, an instant is shown in UTC."""
    text = value.cast("string")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        whole = (value == F.floor(value)) & (F.abs(value) < F.lit(1e18))
        return F.when(whole, value.cast("decimal(38,0)").cast("string")).otherwise(text)
    if isinstance(kind, T.DecimalType) and kind.scale:
        return F.regexp_replace(text, r"\.?0+$", "")
    if isinstance(kind, T.TimestampType):
        return F.convert_timezone(None, F.lit("UTC"), value.cast("timestamp_ntz")).cast("string")
    if isinstance(kind, T.DateType):
        return value.cast("timestamp_ntz").cast("string")
    if isinstance(kind, T.BinaryType):
        return F.hex(value)
    return text


def alike(a: T.DataType, b: T.DataType) -> bool:
    """Whether keys of both types can be compared as they are."""
    return a == b or (a.simpleString() in DIGITS and b.simpleString() in DIGITS)


def merged_schema(
    before: T.StructType, own: T.StructType, measured: Callable[[str, str, T.DataType, T.DataType], bool]
) -> T.StructType:
    """The columns of both, in the widest types that are needed, all nullable. ``measured(side, column, kind, wide)``: side is
    "before" or "own"."""
    new: Mapping[str, T.StructField] = {f.name: f for f in own.fields}

    def kind_of(field: T.StructField) -> T.DataType:
        other = new.get(field.name)
        if other is None or other.dataType == field.dataType:
            return field.dataType
        a, b = field.dataType, other.dataType
        return widest(a, b, lambda kind, wide: measured("before" if kind == a else "own", field.name, kind, wide))

    known = set(before.fieldNames())
    kept = [T.StructField(f.name, kind_of(f)) for f in before.fields]
    return T.StructType(kept + [T.StructField(f.name, f.dataType) for f in own.fields if f.name not in known])
