"""Column typing, missing values, lenient parsing and rounding."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FLOATS = (T.FloatType, T.DoubleType)
_TIMES = (T.DateType, T.TimestampType, T.TimestampNTZType)
_NESTED = (T.ArrayType, T.MapType, T.StructType, T.BinaryType, T.VariantType)


def quote(name: str) -> str:
    """Backtick a column name so that dots and blanks in it are taken literally."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    return F.col(quote(name))


def field_type(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def flat_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Columns that hold one plain value; nested ones pass through operators untouched."""
    skip = set(exclude)
    return [f.name for f in df.schema if not isinstance(f.dataType, _NESTED) and f.name not in skip]


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Numeric columns in schema order. Booleans are not numeric."""
    skip = set(exclude)
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def non_numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    numeric = set(numeric_columns(df))
    return [c for c in flat_columns(df, exclude) if c not in numeric]


def infer_columns(
    df: DataFrame,
    target: str | None = None,
    numeric: Sequence[str] | None = None,
    categorical: Sequence[str] | None = None,
) -> tuple[list[str], list[str]]:
    """Numeric and categorical feature lists; an explicit list wins over the schema."""
    skip = [target] if target else []
    return (
        list(numeric) if numeric else numeric_columns(df, skip),
        list(categorical) if categorical else non_numeric_columns(df, skip),
    )


def first_columns(names: Sequence[str], k: int | None) -> list[str]:
    return list(names) if k is None else list(names)[:k]


def nan_to_null(df: DataFrame) -> DataFrame:
    """One missing concept: NaN in a float column becomes NULL. A pure projection."""
    floats = {f.name for f in df.schema if isinstance(f.dataType, _FLOATS)}
    if not floats:
        return df
    return df.select(
        *[F.nanvl(col(c), F.lit(None)).alias(c) if c in floats else col(c) for c in df.columns]
    )


def is_time(dtype: T.DataType) -> bool:
    return isinstance(dtype, _TIMES)


def timestamp_of(df: DataFrame, name: str, formats: Sequence[str] = ()) -> Column:
    """A zone-free timestamp for a time column, or a lenient parse of a text column.

    Text that matches neither ISO nor one of ``formats`` becomes NULL.
    """
    dtype = field_type(df, name)
    if is_time(dtype):
        return col(name).cast("timestamp_ntz")
    text = col(name).cast("string")
    parsed = F.expr(f"try_cast({quote(name)} AS string)").try_cast("timestamp_ntz")
    for pattern in formats:
        parsed = F.coalesce(parsed, F.try_to_timestamp(text, F.lit(pattern)).cast("timestamp_ntz"))
    return parsed


def number_of(df: DataFrame, name: str) -> Column:
    """``name`` as double; what does not parse becomes NULL, and so does NaN."""
    dtype = field_type(df, name)
    value = col(name) if isinstance(dtype, T.NumericType) else col(name).cast("string")
    return F.nanvl(value.try_cast("double"), F.lit(None))


def seconds_between(later: Column, earlier: Column) -> Column:
    """Exact seconds between two zone-free timestamps, as double."""
    return (later - earlier).cast("interval second").cast("decimal(20,6)").cast("double")


def rounded(value: Column, digits: int | None) -> Column:
    """Half-even rounding, as NumPy rounds; ``None`` leaves the value as it is."""
    return value if digits is None else F.bround(value, digits)


def value_text(df: DataFrame, name: str) -> Column:
    """A text form of a value in which equal values are equal (``-0.0`` is ``0.0``)."""
    if isinstance(field_type(df, name), _FLOATS):
        return (col(name) + F.lit(0.0)).cast("string")
    return col(name).cast("string")
