"""Renames, casts and reshapes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlens.functions import (
    DATE_FORMAT, as_date, as_double, as_timestamp, day_name, strip_suffix, without_nan,
)
from marketlens.operators.skew import ROWS_PER_SLICE, row_index
from marketlens.schemas import BAR_COLUMNS, BAR_ESSENTIALS, MEASURES, TICKER_NAMES, quoted


# --- wide close tables ------------------------------------------------------

def parse_date(df: DataFrame, column: str = "Fecha", fmt: str = DATE_FORMAT) -> DataFrame:
    """Text to date; a column that already is a date passes unchanged."""
    return df.withColumn(column, as_date(df, column, fmt))


def remove_suffix(df: DataFrame, suffix: str = ".MC") -> DataFrame:
    renames = {c: c.removesuffix(suffix) for c in df.columns if c.endswith(suffix)}
    return _renamed(df, renames)


def remove_ticker_suffix(df: DataFrame, suffix: str = ".MC") -> DataFrame:
    """The long form of ``remove_suffix``."""
    return df.withColumn("Ticker", strip_suffix(F.col("Ticker"), suffix))


def rename_tickers(df: DataFrame, names: dict[str, str] = TICKER_NAMES) -> DataFrame:
    """Ticker columns to company names; refuses if two columns would get one name."""
    return _renamed(df, {c: names[c] for c in df.columns if c in names})


def rename_column(df: DataFrame, old: str, new: str) -> DataFrame:
    return df.withColumnRenamed(old, new)


def _renamed(df: DataFrame, renames: dict[str, str]) -> DataFrame:
    names = [renames.get(c, c) for c in df.columns]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"several columns would be called {twice}; use the long form")
    return df.select(*[F.col(quoted(c)).alias(n) for c, n in zip(df.columns, names)])


def cast_measures(df: DataFrame, keep: Sequence[str] = ("Dia", "Fecha")) -> DataFrame:
    """Every column but the date as double."""
    return df.select(*[
        F.col(quoted(c)) if c in keep else as_double(df, c).alias(c) for c in df.columns
    ])


def drop_empty_columns(df: DataFrame) -> DataFrame:
    """Leave out columns without any value; an empty table keeps them all.

    One aggregate reads all counts; its single row decides the schema.
    """
    counts = df.agg(
        F.count(F.lit(1)).alias("rows"), *[F.count(without_nan(df, c)).alias(f"c{i}") for i, c in enumerate(df.columns)]
    ).first()
    if counts["rows"] == 0:
        return df
    return df.select(*[quoted(c) for i, c in enumerate(df.columns) if counts[f"c{i}"] > 0])


def wide_to_long(df: DataFrame, date: str = "Fecha", value: str = "Close") -> DataFrame:
    """``(Date, Ticker, Close)`` from one column per ticker; missing cells stay as nulls."""
    names = [c for c in df.columns if c != date]
    typed = df.select(F.col(quoted(date)).alias("Date"), *[as_double(df, c).alias(c) for c in names])
    return typed.unpivot("Date", [quoted(c) for c in names], "Ticker", value)


def long_to_wide(df: DataFrame, tickers: Sequence[str], date: str = "Fecha", value: str = "Close") -> DataFrame:
    """Listing the tickers spares the pass that would look for them."""
    return df.groupBy(F.col("Date").alias(date)).pivot("Ticker", list(tickers)).agg(F.max(value))


# --- wide OHLCV tables --------------------------------------------------------

def wide_ohlcv(df: DataFrame, tickers: Sequence[str], fields: Sequence[str] = tuple(MEASURES)) -> DataFrame:
    """``Date`` and ``{ticker}_{field}`` columns."""
    return df.groupBy("Date").pivot("Ticker", list(tickers)).agg(*[F.max(f).alias(f) for f in fields])


def long_ohlcv(df: DataFrame, tickers: Sequence[str], fields: Sequence[str] = tuple(MEASURES)) -> DataFrame:
    """One row per date and ticker from a wide OHLCV table; rows without any value are left out."""
    per_ticker = F.array(*[
        F.struct(F.lit(t).alias("Ticker"), *[F.col(quoted(f"{t}_{f}")).alias(f) for f in fields]) for t in tickers
    ])
    return df.select("Date", F.inline(per_ticker)).na.drop("all", subset=list(fields))


def flatten_name(parts: Sequence[str]) -> str:
    """A two-level column label as one name: ``("BBVA.MC", "Close")`` to ``BBVA.MC_Close``."""
    return "_".join(p for p in parts if p).strip("_")


# --- bars ---------------------------------------------------------------------

def standardize_records(df: DataFrame, as_of: str | None = None) -> DataFrame:
    """Records of any feed as ``Date, Open, High, Low, Close, Volume, Ticker``.

    Lower-case names are read where the proper one is missing.  Close falls back to
    open, the date to ``as_of`` (today if not given), the ticker to a fixed word.
    """
    def pick(name: str, *others: str) -> str | None:
        return next((c for c in (name, *others) if c in df.columns), None)

    def number(*names: str) -> Column:
        source = pick(*names)
        return as_double(df, source) if source else F.lit(None).cast("double")

    day, ticker = pick("Date", "Datetime", "date"), pick("Ticker", "ticker")
    today = F.lit(as_of).cast("date") if as_of else F.current_date()
    close = pick("Close") or pick("Open", "price")
    return df.select(
        (as_date(df, day) if day else today).alias("Date"),
        number("Open", "price").alias("Open"),
        number("High", "high").alias("High"),
        number("Low", "low").alias("Low"),
        (as_double(df, close) if close else F.lit(None).cast("double")).alias("Close"),
        number("Volume", "volume").alias("Volume"),
        (F.col(ticker).cast("string") if ticker else F.lit("DESCONOCIDO")).alias("Ticker"),
    )


def conform_bars(df: DataFrame, drop_incomplete: bool = True) -> DataFrame:
    """Any OHLCV table in the bar layout; bad values become null.

    With ``drop_incomplete`` rows without date, price or ticker are left out and a
    missing close column is taken from open.
    """
    aliases = {"Date": ("Datetime",), "Close": ("Adj Close", "AdjClose")}

    def source(name: str) -> str | None:
        return next((c for c in (name, *aliases.get(name, ())) if c in df.columns), None)

    def measure(name: str) -> Column:
        found = source(name)
        if found is None and name == "Close" and drop_incomplete:
            found = source("Open")
        return as_double(df, found) if found else F.lit(None).cast("double")

    day, ticker = source("Date"), source("Ticker")
    out = df.select(
        (as_date(df, day) if day else F.lit(None).cast("date")).alias("Date"),
        *[measure(c).alias(c) for c in MEASURES],
        (F.col(ticker).cast("string") if ticker else F.lit(None).cast("string")).alias("Ticker"),
    ).select(*BAR_COLUMNS)
    return out.na.drop(subset=BAR_ESSENTIALS) if drop_incomplete else out


def open_close(df: DataFrame) -> DataFrame:
    return df.select("Date", *[as_double(df, c).alias(c) for c in ("Open", "Close")]).na.drop(subset=["Open", "Close"])


def range_features(df: DataFrame) -> DataFrame:
    spread = F.col("High") - F.col("Low")
    return df.withColumns({
        "RangeOpen": F.try_divide(spread, F.col("Open")),
        "RangeLow": F.try_divide(spread, F.col("Low")),
    })


# --- ticks --------------------------------------------------------------------

def map_ticks(df: DataFrame, eurusd: Column | float, clock: Column | None = None) -> DataFrame:
    """Raw tick text as live bars.

    ``clock`` is the time of receipt, shared by the rows of a batch unless a column
    is given.  Every part of the time is taken from the same value.
    """
    now = clock if clock is not None else F.current_timestamp()
    price = as_double(df, "price")
    rate = eurusd if isinstance(eurusd, Column) else F.lit(float(eurusd))
    return df.select(
        now.alias("EventTS"),
        F.to_date(now).alias("Date"),
        F.hour(now).alias("Hour"),
        F.minute(now).alias("Minute"),
        day_name(now).alias("DayOfWeek"),
        F.col("ticker").alias("Ticker"),
        price.alias("Open"),
        as_double(df, "high").alias("High"),
        as_double(df, "low").alias("Low"),
        price.alias("Close"),
        as_double(df, "volume").alias("Volume"),
        rate.alias("EURUSD"),
        row_json(df).alias("RawJSON"),
    )


def row_json(df: DataFrame) -> Column:
    return F.to_json(F.struct(*[quoted(c) for c in df.columns]))


def stringify_temporal(df: DataFrame) -> DataFrame:
    """Dates and timestamps as text, for sinks without those types."""
    formats = {
        T.DateType: "yyyy-MM-dd",
        T.TimestampType: "yyyy-MM-dd HH:mm:ss",
        T.TimestampNTZType: "yyyy-MM-dd HH:mm:ss",
    }
    return df.select(*[
        F.date_format(quoted(f.name), formats[type(f.dataType)]).alias(f.name)
        if type(f.dataType) in formats else F.col(quoted(f.name))
        for f in df.schema
    ])


def _sortable(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_sortable(f.dataType) for f in kind)
    if isinstance(kind, T.ArrayType):
        return _sortable(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType, T.CalendarIntervalType))


def derive_event_ts(
    df: DataFrame, order: Sequence[str] | None = None, rows_per_slice: int = ROWS_PER_SLICE, timed: bool = False
) -> DataFrame:
    """Event time from ``EventTS``, else ``Datetime``, else ``Date``, else one second per row from 1970.

    The last resort also applies where the chosen column has no usable value at all.  Rows are
    numbered by ``order``, without it by all columns that can be sorted, so that only equal rows tie.
    Whether any time is known is found while the result is computed; rows without a time keep null if so.
    ``timed`` states that some time is known, which leaves the numbering out of the plan.
    """
    source = next((c for c in ("EventTS", "Datetime", "Date") if c in df.columns), None)
    rest = [quoted(c) for c in df.columns if c != "EventTS"]
    stamp = as_timestamp(df, source) if source else F.lit(None).cast("timestamp_ntz")
    stamped = df.select(stamp.alias("EventTS"), *rest)
    if timed:
        return stamped
    lost, kept = stamped, None
    if source:
        known = stamped.agg(F.max("EventTS")).scalar()
        none_known = F.col("EventTS").isNull() & known.isNull()
        lost, kept = stamped.filter(none_known), stamped.filter(~none_known)
    order = order or [f.name for f in stamped.schema if _sortable(f.dataType)]
    numbered = row_index(lost, [quoted(c) for c in order], "__i", rows_per_slice)
    start = F.lit("1970-01-01").cast("timestamp_ntz")
    # Days and seconds apart: the seconds of an interval are a decimal of twelve digits in all.
    days, seconds = F.floor(F.col("__i") / 86400).cast("int"), F.pmod(F.col("__i"), F.lit(86400))
    made = numbered.select((start + F.make_dt_interval(days=days, secs=seconds)).alias("EventTS"), *rest)
    return kept.unionByName(made) if source else made


def normalize_any(
    df: DataFrame, order: Sequence[str] | None = None, rows_per_slice: int = ROWS_PER_SLICE, timed: bool = False
) -> DataFrame:
    """Any stored tick or bar table as ``EventTS, Ticker, Close, High, Low, Volume``.

    Rows without ticker or close are left out; other missing measures are null.
    """
    stamped = derive_event_ts(df, order, rows_per_slice, timed)

    def number(*names: str) -> Column:
        found = next((c for c in names if c in stamped.columns), None)
        return as_double(stamped, found) if found else F.lit(None).cast("double")

    ticker = next((c for c in ("Ticker", "ticker") if c in stamped.columns), None)
    return stamped.select(
        "EventTS",
        (F.col(ticker).cast("string") if ticker else F.lit("UNKNOWN")).alias("Ticker"),
        number("Close", "price", "Open").alias("Close"),
        number("High", "high").alias("High"),
        number("Low", "low").alias("Low"),
        number("Volume", "volume").alias("Volume"),
    ).na.drop(subset=["Ticker", "Close"])
