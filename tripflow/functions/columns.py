"""Small column helpers: sentinels, safe casts, flags, names."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripflow.schema import FEATURE_MISSING


def with_sentinel(col: Column, sentinel: str = FEATURE_MISSING) -> Column:
    """Null -> sentinel, then string (doubles print as pandas does: 1.0 -> '1.0')."""
    return F.coalesce(col.cast("string"), F.lit(sentinel))


def lax_double(col: Column) -> Column:
    """Numeric coercion that turns junk and NaN into null instead of failing."""
    return F.nanvl(col.try_cast("double"), F.lit(None).cast("double"))


def same_value_flag(a: Column, b: Column) -> Column:
    """1 when both are known and equal; null on either side gives 0 (not null-safe on purpose)."""
    return F.coalesce(a == b, F.lit(False)).cast("int")


def route_key(pu: Column, do: Column) -> Column:
    return F.concat_ws("_", with_sentinel(pu.cast("bigint")), with_sentinel(do.cast("bigint")))


def safe_name(name: str) -> str:
    """Physical column name usable by VectorAssembler (no dots or spaces)."""
    return re.sub(r"[^0-9A-Za-z_]", "_", name)


def safe_names(names: list[str]) -> list[str]:
    """Physical names for display names: ``safe_name``, with the position where two would be the same column."""
    out, taken = [], set()
    for i, name in enumerate(names):
        own = safe_name(name)
        while own.lower() in taken:
            own = f"{own}__{i}"
        taken.add(own.lower())
        out.append(own)
    return out


def round6(col: Column) -> Column:
    return F.round(col, 6)


INTEGER_SIGNATURE_COLUMNS = ("VendorID", "PULocationID", "DOLocationID")
FLOAT_SIGNATURE_COLUMNS = ("passenger_count", "trip_type")


#: Text of an integer and of any number; Spark's casts would also take a type suffix ("2d").
INTEGER_TEXT = r"^\s*[+-]?[0-9]+\s*$"
NUMBER_TEXT = r"^\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def number_or_null(col: Column) -> Column:
    """Text of a finite number as a double, anything else null."""
    s = col.cast("string")
    return F.when(s.rlike(NUMBER_TEXT), s.try_cast("double"))


def integer_or_null(col: Column) -> Column:
    """Text of a whole number as a bigint, exactly (``2.0`` too); anything else null."""
    s, d = col.cast("string"), number_or_null(col)
    return F.when(s.rlike(INTEGER_TEXT), F.trim(s).try_cast("bigint")).otherwise(
        F.when(d == F.floor(d), d.try_cast("bigint")))


def strict_bigint(col: Column, name: str) -> Column:
    """Numeric-or-fail, then truncated to an integer (a missing id fails too); large ids stay exact."""
    d = number_or_null(col)
    whole = F.coalesce(integer_or_null(col), d.try_cast("bigint"))
    return F.when(whole.isNull(), F.raise_error(F.lit(f"{name} must be numeric"))).otherwise(whole)


def signature_cast(df):
    """Ids must be numeric (raise), counts coerced (junk -> null)."""
    out = df
    for c in INTEGER_SIGNATURE_COLUMNS:
        out = out.withColumn(c, strict_bigint(F.col(c), c))
    for c in FLOAT_SIGNATURE_COLUMNS:
        if c in out.columns:
            out = out.withColumn(c, lax_double(F.col(c)))
    return out
