"""Table layouts and lookup values."""

from __future__ import annotations

from pyspark.sql import types as T

# Exchange code of each listed share and the company it stands for.
TICKER_NAMES = {
    "IBE.MC": "Iberdrola",
    "REP.MC": "Repsol",
    "NTGY.MC": "Naturgy",
    "ELE.MC": "Endesa",
    "ENG.MC": "Enagás",
    "RED.MC": "Red Eléctrica",
    "SAN.MC": "Banco Santander",
    "BBVA.MC": "BBVA",
    "CABK.MC": "Caixabank",
    "BKT.MC": "Bankinter",
    "SAB.MC": "Banco Sabadell",
    "UNI.MC": "Unicaja Banco",
    "MAP.MC": "Mapfre",
    "ACS.MC": "ACS",
    "ANA.MC": "Aena",
    "ANE.MC": "Aena",
    "ACX.MC": "Acciona",
    "MTS.MC": "MasMovil",
    "SCYR.MC": "Sacyr",
    "CLNX.MC": "Cellnex",
    "TEF.MC": "Telefónica",
    "AENA.MC": "Aena",
    "FER.MC": "Ferrovial",
    "ITX.MC": "Inditex",
    "AMS.MC": "Amadeus",
    "IAG.MC": "IAG",
    "GRF.MC": "Grifols",
    "FDR.MC": "Ferrovial",
    "SLR.MC": "Solaria",
    "ROVI.MC": "Rovi",
    "LOG.MC": "Logista",
    "IDR.MC": "Indra",
    "MEL.MC": "Melia",
    "PUIG.MC": "Puig",
    "COL.MC": "Colonial",
    "MRL.MC": "Merlin",
}

# How far back an intraday interval may reach.
INTRADAY_LOOKBACK_DAYS = {
    "1m": 7,
    "2m": 60,
    "5m": 60,
    "15m": 60,
    "30m": 60,
    "90m": 60,
    "60m": 730,
    "1h": 730,
}

PRICES = ["Open", "High", "Low", "Close"]
MEASURES = [*PRICES, "Volume"]
BAR_COLUMNS = ["Date", *MEASURES, "Ticker"]
BAR_ESSENTIALS = ["Date", *PRICES, "Ticker"]

BAR_SCHEMA = T.StructType(
    [T.StructField("Date", T.DateType(), False)]
    + [T.StructField(c, T.DoubleType(), False) for c in PRICES]
    + [T.StructField("Volume", T.DoubleType(), True), T.StructField("Ticker", T.StringType(), False)]
)

# Ticks arrive as text: a measure may be the word "null", and a typed schema
# would turn the whole line into a corrupt record.
TICK_TEXT_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType(), True) for c in ("ticker", "price", "high", "low", "volume")]
)

TICK_BAR_SCHEMA = T.StructType([
    T.StructField("EventTS", T.TimestampType(), False),
    T.StructField("Date", T.DateType(), False),
    T.StructField("Hour", T.IntegerType(), False),
    T.StructField("Minute", T.IntegerType(), False),
    T.StructField("DayOfWeek", T.StringType(), False),
    T.StructField("Ticker", T.StringType(), False),
    T.StructField("Open", T.DoubleType(), False),
    T.StructField("High", T.DoubleType(), False),
    T.StructField("Low", T.DoubleType(), False),
    T.StructField("Close", T.DoubleType(), False),
    T.StructField("Volume", T.DoubleType(), True),
    T.StructField("EURUSD", T.DoubleType(), False),
    T.StructField("RawJSON", T.StringType(), True),
])

RUN_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("params", T.MapType(T.StringType(), T.StringType()), False),
    T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType()), False),
    T.StructField("experiment", T.StringType()),
])


def wide_close_schema(tickers: list[str] | None = None) -> T.StructType:
    """``Fecha`` as a date, then one text column per ticker."""
    return T.StructType(
        [T.StructField("Fecha", T.DateType(), True)]
        + [T.StructField(t, T.StringType(), True) for t in tickers or TICKER_NAMES]
    )


def quoted(name: str) -> str:
    """A column name safe to reference although it holds dots (``BBVA.MC_Close``)."""
    return "`" + name.replace("`", "``") + "`"
