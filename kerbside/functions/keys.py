"""Surrogate and smart keys."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kerbside.functions.temporal import _col

# Fixed value: text form of a microsecond timestamp inside the trip key.
KEY_TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
KEY_SEPARATOR = "|"


def surrogate_key(*parts: Column) -> Column:
    """Upper-case hex MD5 of the parts joined by ``|``.

    ``concat`` propagates NULL: one NULL part gives a NULL key.  Callers wrap
    optional parts in ``coalesce(part, '')`` to keep them out of that rule.
    """
    joined = []
    for i, part in enumerate(parts):
        if i:
            joined.append(F.lit(KEY_SEPARATOR))
        joined.append(part)
    return F.upper(F.md5(F.concat(*joined)))


def key_text(c: Column | str) -> Column:
    """Text of one key part.  Timestamps print all six fraction digits."""
    return _col(c).cast("string")


def trip_key(pickup_ts="pickup_ts", dropoff_ts="dropoff_ts", pickup_zone_id="pickup_zone_id",
             dropoff_zone_id="dropoff_zone_id", trip_distance="trip_distance",
             total_amount="total_amount", passenger_count="passenger_count") -> Column:
    """Natural key of a trip over its seven attributes.

    The pickup zone is deliberately *not* coalesced: a trip without a pickup
    zone has no key and is routed to the reject output by the fact build.
    """
    return surrogate_key(
        F.date_format(_col(pickup_ts), KEY_TS_FORMAT),
        F.date_format(_col(dropoff_ts), KEY_TS_FORMAT),
        key_text(pickup_zone_id),
        F.coalesce(key_text(dropoff_zone_id), F.lit("")),
        key_text(trip_distance),
        key_text(total_amount),
        F.coalesce(key_text(passenger_count), F.lit("")),
    )


def date_key(ts: Column | str) -> Column:
    """``yyyymmdd`` as int."""
    return F.date_format(_col(ts), "yyyyMMdd").cast("int")


def hour_key(ts: Column | str) -> Column:
    """``yyyymmddHH`` as bigint."""
    return F.date_format(_col(ts), "yyyyMMddHH").cast("bigint")
