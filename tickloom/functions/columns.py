"""Column helpers: every function takes and returns `Column`, and stays in generated code."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_MICROS = 24 * 60 * 60 * 1_000_000


def micros(ts: Column) -> Column:
    """Microseconds since the epoch of a timestamp with or without zone (UTC session)."""
    return F.unix_micros(ts.cast("timestamp"))


def order_key(ts: Column, seq: Column) -> Column:
    """(ts, seq) as one number in the same order.

    `min_by` / `max_by` over a number aggregate by hashing; over a struct Spark
    has to sort each partition first. A null `seq` comes before all others.
    """
    high = micros(ts).cast("decimal(20,0)") * F.lit(Decimal(2**64))
    return (high + F.coalesce(seq.cast("bigint"), F.lit(-(2**63))).cast("decimal(20,0)")).cast("decimal(38,0)")


def direction(change: Column, labels: Sequence[str] = ("up", "down", "flat")) -> Column:
    """Label a change by its sign; a null change is flat."""
    up, down, flat = labels
    return F.when(change > 0, up).when(change < 0, down).otherwise(flat)


def price_signal(price: Column, low: float = 100.0, high: float = 200.0) -> Column:
    """'buy' strictly below `low`, 'sell' strictly above `high`, else null."""
    return F.when(price < low, "buy").when(price > high, "sell")


def in_session(
    ts: Column, zone: str = "America/New_York", pre_hours: bool = False, after_hours: bool = False
) -> Column:
    """Monday to Friday, local time within the inclusive market session (UTC session)."""
    local = F.from_utc_timestamp(ts.cast("timestamp"), zone)
    # Session times.
    start = "07:59:00" if pre_hours else "09:29:00"
    end = "20:00:00" if after_hours else "16:00:00"
    of_day = F.pmod(micros(local), F.lit(DAY_MICROS))
    return (F.weekday(local) < 5) & of_day.between(_day_micros(start), _day_micros(end))


def _day_micros(hms: str) -> int:
    hours, minutes, seconds = (int(p) for p in hms.split(":"))
    return ((hours * 60 + minutes) * 60 + seconds) * 1_000_000


def number_text(value: Column) -> Column:
    """A double as plain decimal text with at least one decimal; NaN, infinity and null give null.

    A plain cast writes 1e7 as `1.0E7`; values out of the decimal range keep that form.
    """
    value = value.cast("double")
    big = F.regexp_replace(value.try_cast("decimal(38,10)").cast("string"), r"(\.\d+?)0+$", "$1")
    small = F.regexp_replace(value.try_cast("decimal(38,34)").cast("string"), r"(\.\d+?)0+$", "$1")
    magnitude = F.abs(value)
    return (
        F.when(F.isnan(value) | (magnitude == float("inf")), F.lit(None))
        .when((magnitude >= 1e-3) & (magnitude < 1e7) | (magnitude == 0), value.cast("string"))
        .when(magnitude >= 1e7, F.coalesce(big, value.cast("string")))
        .when(magnitude >= 1e-16, small)
        .otherwise(value.cast("string"))
    )


def _escape(text: Column) -> Column:
    """Spaces, commas and equals signs get a backslash; line breaks, which end a point, become spaces."""
    return F.regexp_replace(F.regexp_replace(text, r"[\r\n]+", " "), r"([ ,=])", r"\\$1")


def _escaped(name: str, signs: str) -> str:
    return re.sub(f"([{signs}])", r"\\\1", re.sub(r"[\r\n]+", " ", name))


def line_protocol(
    measurement: str, tags: Mapping[str, Column], fields: Mapping[str, Column], ts: Column
) -> Column:
    """`m[,tag=v…] field=v[,…] epoch_ms`; null and empty tags are left out, and fields that are null or not finite.

    Null when no field has a value or there is no time, as such a point cannot be written. Names
    and tag values are escaped so that option symbols stay one tag.
    """
    texts = {k: _escape(v.cast("string")) for k, v in tags.items()}
    tag_text = F.concat_ws(",", *[F.when(v != "", F.concat(F.lit(f"{_escaped(k, ' ,=')}="), v)) for k, v in texts.items()])
    field_text = F.concat_ws(",", *[F.concat(F.lit(f"{_escaped(k, ' ,=')}="), number_text(v)) for k, v in fields.items()])
    head = F.concat(F.lit(_escaped(measurement, " ,")), F.when(tag_text != "", F.concat(F.lit(","), tag_text)).otherwise(""))
    return F.when(
        field_text != "",
        F.concat(head, F.lit(" "), field_text, F.lit(" "), F.unix_millis(ts.cast("timestamp")).cast("string")),
    )


def as_list(text_or_array: Column, is_array: bool) -> Column:
    """Lists and comma strings mean the same in a subscription request."""
    return text_or_array if is_array else F.split(text_or_array, ",")
