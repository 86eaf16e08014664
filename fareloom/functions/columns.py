"""Money, text, time and ordering expressions."""

from __future__ import annotations

import datetime as dt
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom.schemas import APP_STATUS, APP_STATUS_DEFAULT, DEFAULT_COUNTRY, DEFAULT_SERVICE, MONEY

HUNDREDTH = "0.01"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


# --- money ------------------------------------------------------------------------------


def percent_of(amount: Column | str, percent: Column | str) -> Column:
    """``percent`` % of ``amount``, exact in decimals, half away from zero to cents."""
    return F.round(_col(amount) * _col(percent) * F.lit(HUNDREDTH).cast("decimal(3,2)"), 2).cast(MONEY)


def zero_if_null(amount: Column | str) -> Column:
    return F.coalesce(_col(amount), F.lit(0).cast(MONEY))


def exact_mean(total: Column, n: Column) -> Column:
    """``total / n`` to cents, NULL over no rows.

    Spark's ``avg`` on decimals keeps four more digits and would round twice.
    """
    return F.round(total / F.nullif(n, F.lit(0)), 2).cast("decimal(20,2)")


def ratio(part: Column | str, whole: Column | str) -> Column:
    """Row ratio with a fixed scale, so that its sum does not depend on row order."""
    quotient = _col(part).cast("double") / F.nullif(_col(whole).cast("double"), F.lit(0.0))
    return F.round(quotient, 10).cast("decimal(18,10)")


# --- text -------------------------------------------------------------------------------


def full_name(first: Column | str, last: Column | str) -> Column:
    """First and last name; NULL only if both are."""
    first, last = _col(first), _col(last)
    return F.when(first.isNotNull() | last.isNotNull(), F.trim(F.concat_ws(" ", first, last)))


def has_promo(promo_code: Column | str = "promo_code") -> Column:
    promo_code = _col(promo_code)
    return F.coalesce(promo_code != "", F.lit(False))


def country_of(country: Column | str = "country") -> Column:
    return F.coalesce(_col(country), F.lit(DEFAULT_COUNTRY))


def service_of(service: Column | str = "service_type") -> Column:
    return F.coalesce(_col(service), F.lit(DEFAULT_SERVICE))


def app_status(status: Column | str = "status") -> Column:
    """The status the apps show; anything unknown counts as pending."""
    names = F.create_map(*(F.lit(x) for x in chain.from_iterable(APP_STATUS.items())))
    return F.coalesce(F.try_element_at(names, _col(status)), F.lit(APP_STATUS_DEFAULT))


def text_or(value: Column | str, default: str | None = None) -> Column:
    """``value`` unless it is NULL or empty: the projection treats both as absent."""
    value = _col(value)
    return F.coalesce(F.when(value != "", value), F.lit(default))


def number_or(value: Column | str, default: object = None) -> Column:
    """``value`` unless it is NULL or zero: the projection treats both as absent."""
    value = _col(value)
    return F.coalesce(F.when(value != 0, value), F.lit(default))


def natural_id(*parts: Column | str) -> Column:
    """Id from the natural key: the same under replay, unlike a random one."""
    return F.sha2(F.concat_ws("|", *parts), 256)


# --- places and time --------------------------------------------------------------------


def geo_point(latitude: Column | str, longitude: Column | str) -> Column:
    """A point only if both coordinates are there."""
    latitude, longitude = _col(latitude), _col(longitude)
    point = F.struct(latitude.alias("latitude"), longitude.alias("longitude"))
    return F.when(latitude.isNotNull() & longitude.isNotNull(), point)


def iso_text(moment: Column | str) -> Column:
    return F.date_format(_col(moment), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def instant(df: DataFrame, column: str, value: dt.datetime | dt.date | str) -> Column:
    """``value`` as a literal of the column's own timestamp type, so a comparison still pushes down."""
    return F.lit(str(value)).cast(df.schema[column].dataType)


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Elapsed seconds with a microsecond fraction, for either timestamp type."""
    def micros(c: Column | str) -> Column:
        return F.unix_micros(_col(c).cast("timestamp"))

    return ((micros(end) - micros(start)).cast("decimal(20,0)") * F.lit("0.000001").cast("decimal(7,6)")).cast("decimal(20,6)")


# --- ordering ---------------------------------------------------------------------------


def descending(column: Column | str) -> Column:
    """Largest first with NULLs before everything, the order the reports promise."""
    return _col(column).desc_nulls_first()


def ascending(column: Column | str) -> Column:
    """Smallest first with NULLs at the end."""
    return _col(column).asc_nulls_last()
