"""Column expressions.  All run inside the JVM; none raises on bad input under ANSI."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlens.schemas import quoted

__all__ = [
    "DATE_FORMAT",
    "lenient_double", "lenient_int", "as_double", "as_date", "as_timestamp", "nan_to_null", "without_nan",
    "ratio_return", "percent_change", "variation_class", "quartile_label",
    "day_name", "friday_label", "strip_suffix", "join_name", "round_half_up",
]

DATE_FORMAT = "dd/MM/yyyy"


def lenient_double(text: Column) -> Column:
    """Text to double; blanks, ``"null"`` in any case, NaN and junk become null."""
    t = F.lower(F.trim(text))
    # The JVM also reads 1.5d, 1.5f and hexadecimal floats as numbers; plain text does not mean those.
    foreign = F.endswith(t, F.lit("d")) | (F.endswith(t, F.lit("f")) & ~F.endswith(t, F.lit("inf"))) | F.contains(t, F.lit("x"))
    return nan_to_null(F.when(~foreign, text.try_cast("double")))


def lenient_int(text: Column) -> Column:
    """Text to whole number, halves going to the even neighbour."""
    return F.bround(lenient_double(text)).try_cast("bigint")


def nan_to_null(x: Column) -> Column:
    return F.nullif(x, F.lit(float("nan")))


def without_nan(df: DataFrame, name: str) -> Column:
    """The column as it is, but for NaN, which becomes null."""
    real = isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType))
    return nan_to_null(F.col(quoted(name))) if real else F.col(quoted(name))


def as_double(df: DataFrame, name: str) -> Column:
    """The column as a nullable double, whatever type it has."""
    kind, c = df.schema[name].dataType, F.col(quoted(name))
    if isinstance(kind, T.StringType):
        return lenient_double(c)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return nan_to_null(c.cast("double"))
    return c.try_cast("double")


def as_date(df: DataFrame, name: str, fmt: str | None = None) -> Column:
    kind, c = df.schema[name].dataType, F.col(quoted(name))
    if isinstance(kind, T.StringType):
        return F.try_to_date(c, fmt) if fmt else c.try_cast("date")
    return c.try_cast("date")


def as_timestamp(df: DataFrame, name: str) -> Column:
    """Text, dates and both kinds of timestamp as a zone-less timestamp."""
    return F.col(quoted(name)).try_cast("timestamp_ntz")


def ratio_return(now: Column, before: Column) -> Column:
    return F.try_divide(now, before) - F.lit(1.0)


def percent_change(now: Column, before: Column) -> Column:
    return F.try_divide(now - before, before) * F.lit(100.0)


def variation_class(percent: Column) -> Column:
    """Five classes of a percentage; both outer bounds and the neutral band are closed."""
    # Class names and their bounds.
    return (
        F.when(percent <= -15, "Bajada Fuerte")
        .when(percent < -1, "Bajada")
        .when(percent <= 1, "Neutra")
        .when(percent < 15, "Subida")
        .when(percent >= 15, "Subida Fuerte")
    )


def quartile_label(x: Column, q1: Column, q2: Column, q3: Column) -> Column:
    """``q1`` to ``q4``.  A missing value is labelled ``q4``; a series without cuts has no label."""
    return F.when(
        q1.isNotNull(),
        F.when(x <= q1, "q1").when(x <= q2, "q2").when(x <= q3, "q3").otherwise("q4"),
    )


def day_name(d: Column) -> Column:
    """English name of the day; looked up, since formatting a date costs far more."""
    # Names in the order of dayofweek().
    names = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]
    return F.element_at(F.array(*[F.lit(n) for n in names]), F.dayofweek(d))


def friday_label(d: Column) -> Column:
    return F.when(F.dayofweek(d) == 6, "Friday").otherwise("Weekday")


def strip_suffix(text: Column, suffix: str) -> Column:
    cut = text.substr(F.lit(1), F.length(text) - len(suffix))
    return F.when(F.endswith(text, F.lit(suffix)), cut).otherwise(text)


def join_name(*parts: Column) -> Column:
    """Parts joined by ``_`` without leading or trailing underscores."""
    return F.btrim(F.concat_ws("_", *parts), F.lit("_"))


def round_half_up(x: Column, digits: int) -> Column:
    """Rounding on decimals, so that 1.005 to two digits does not depend on its binary form; on doubles beyond their range."""
    return F.coalesce(F.round(x.try_cast("decimal(38,12)"), digits).cast("double"), F.round(x.cast("double"), digits))
