"""Instrument keys: what the documented key formats say about a symbol."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.schema import FREQUENCIES, MONTH_CODES, SORT_FIELDS

# Documented key formats.
OPTION = r"^(.{6})(\d{6})([CP])(\d{5})(\d{3})$"
FUTURE = rf"^/([A-Z0-9]+)([{MONTH_CODES}])(\d{{2}})$"
FUTURE_OPTION = rf"^\./([A-Z0-9]+)([{MONTH_CODES}])(\d{{2}})([CP])(\d+(?:\.\d+)?)$"
FOREX = r"^([A-Z]{3})/([A-Z]{3})$"
SCREENER = rf"^(.+?)_({'|'.join(sorted(SORT_FIELDS, key=len, reverse=True))})_({'|'.join(map(str, FREQUENCIES))})$"


def parse_instruments(df: DataFrame, key: str = "symbol") -> DataFrame:
    """Add class, underlying, expiry (`yyyy-MM-dd` or `yyyy-MM`), right and strike.

    For forex the underlying is the from-currency; for screeners it is the prefix.
    """
    k = F.col(key)
    kind = (
        F.when(k.rlike(OPTION), "option")
        .when(k.rlike(FUTURE_OPTION), "future_option")
        .when(k.rlike(FUTURE), "future")
        .when(k.rlike(FOREX), "forex")
        .when(k.rlike(SCREENER), "screener")
        .otherwise("ticker")
    )

    out = df.withColumn("class", kind)
    is_a = {c: F.col("class") == c for c in ("option", "future", "future_option", "forex", "screener")}

    def year_month(pattern: str):
        code = F.regexp_extract(k, pattern, 2)
        number = F.lpad(F.instr(F.lit(MONTH_CODES), code).cast("string"), 2, "0")
        return F.concat(F.lit("20"), F.regexp_extract(k, pattern, 3), F.lit("-"), number)

    day = F.regexp_extract(k, OPTION, 2)
    strike = F.concat(F.regexp_extract(k, OPTION, 4), F.lit("."), F.regexp_extract(k, OPTION, 5))
    return out.withColumns(
        {
            "underlying": F.when(is_a["option"], F.rtrim(F.regexp_extract(k, OPTION, 1)))
            .when(is_a["future"], F.regexp_extract(k, FUTURE, 1))
            .when(is_a["future_option"], F.regexp_extract(k, FUTURE_OPTION, 1))
            .when(is_a["forex"], F.regexp_extract(k, FOREX, 1))
            .when(is_a["screener"], F.regexp_extract(k, SCREENER, 1))
            .otherwise(k),
            "expiry": F.when(
                is_a["option"],
                F.concat(F.lit("20"), day.substr(1, 2), F.lit("-"), day.substr(3, 2), F.lit("-"), day.substr(5, 2)),
            )
            .when(is_a["future"], year_month(FUTURE))
            .when(is_a["future_option"], year_month(FUTURE_OPTION)),
            "right": F.when(is_a["option"], F.regexp_extract(k, OPTION, 3)).when(
                is_a["future_option"], F.regexp_extract(k, FUTURE_OPTION, 4)
            ),
            "strike": F.when(is_a["option"], strike.cast("double")).when(
                is_a["future_option"], F.regexp_extract(k, FUTURE_OPTION, 5).cast("double")
            ),
        }
    )


def instrument_dimension(ticks: DataFrame, key: str = "symbol") -> DataFrame:
    """Distinct instruments of a tick table, parsed."""
    return parse_instruments(ticks.select(key).where(F.col(key).isNotNull()).distinct(), key)


def chain_summary(instruments: DataFrame) -> DataFrame:
    """Instruments per class, underlying and expiry, with the strike range."""
    return instruments.groupBy("class", "underlying", "expiry").agg(
        F.count(F.lit(1)).alias("instruments"),
        F.min("strike").alias("min_strike"),
        F.max("strike").alias("max_strike"),
    )
