"""Column helpers shared by the operators. All of them stay inside JVM codegen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def half_up(value: Column, digits: int) -> Column:
    """Round a double half up on its decimal value.

    A quotient such as 16263208.62 / 108 is exactly a tie, but its nearest double
    falls just below it; a few spare decimals restore the tie before rounding.
    """
    scale = {2: 9, 4: 14, 6: 12}[digits]
    return F.round(value.cast(f"decimal(38,{scale})"), digits).cast("double")


def safe_ratio(num: Column, den: Column, digits: int, default: float = 0.0) -> Column:
    """``num / den`` rounded, or ``default`` unless ``den`` is positive."""
    ratio = num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))
    return F.when(den > 0, half_up(ratio, digits)).otherwise(F.lit(default))


def ratio(num: Column, den: Column, digits: int = 2, scale: float | None = None) -> Column:
    """``num / den`` rounded, null on a zero denominator.

    Numerator and denominator are exact (decimal or integer) until this point, so
    the quotient does not depend on the order in which rows were summed.
    """
    value = num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))
    return half_up(value * scale if scale else value, digits)


def percent(num: Column, den: Column) -> Column:
    return ratio(num, den, 2, 100.0)


def digits_only(value: Column, at_least: int = 9) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    return F.when(F.length(digits) >= at_least, digits)


def pick(value: Column, synonyms: dict[str, list[str]], default: str) -> Column:
    """The canonical name whose synonym list holds ``value`` (compared in lower case)."""
    out = None
    for name, words in synonyms.items():
        test = F.lower(value).isin(words)
        out = F.when(test, name) if out is None else out.when(test, name)
    return out.otherwise(default)


def date_key(day: Column) -> Column:
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def with_ymd(df: DataFrame, day: str) -> DataFrame:
    return df.withColumns(
        {"year": F.year(day), "month": F.month(day), "day": F.dayofmonth(day)}
    )


def with_audit(df: DataFrame, name: str = "_transformed_at") -> DataFrame:
    """Add a load timestamp. Call it at the sink only: it differs on every run."""
    return df.withColumn(name, F.current_timestamp())
