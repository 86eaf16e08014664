"""Change capture: bookings to events, events to latest-state documents, delivery, retention."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareloom.functions.columns import (
    app_status,
    country_of,
    full_name,
    geo_point,
    instant,
    iso_text,
    natural_id,
    number_or,
    seconds_between,
    service_of,
    text_or,
)
from fareloom.operators.joins import lookup, maybe_newest, newest
from fareloom.schemas import CACHE_HOURS, DEPOSIT_PAID_STATUSES, MAX_RETRY, RATING, RETENTION_DAYS

# --- building events --------------------------------------------------------------------

# payload field -> booking column; a leading "@" marks a time written as ISO text
PAYLOAD_COLUMNS = {
    "status": "status",
    "pickupAddress": "pickup_location",
    "destination": "destination",
    "startDate": "start_date",
    "startTime": "start_time",
    "durationHours": "duration_hours",
    "vehicleType": "vehicle_type",
    "specialRequirements": "special_requirements",
    "requiresForeignLanguage": "requires_foreign_language",
    "passengerCount": "passenger_count",
    "luggageCount": "luggage_count",
    "basePrice": "base_price",
    "foreignLanguageSurcharge": "foreign_language_surcharge",
    "overtimeFee": "overtime_fee",
    "tipAmount": "tip_amount",
    "totalAmount": "total_amount",
    "depositAmount": "deposit_amount",
    "depositPaid": "deposit_paid",
    "platformFee": "platform_fee",
    "driverEarning": "driver_earning",
    "tourPackageId": "tour_package_id",
    "tourPackageName": "tour_package_name",
    "promoCode": "promo_code",
    "influencerId": "influencer_id",
    "influencerCommission": "influencer_commission",
    "originalPrice": "original_price",
    "discountAmount": "discount_amount",
    "finalPrice": "final_price",
    "taxId": "tax_id",
    "country": "country",
    "serviceType": "service_type",
    "createdAt": "@created_at",
    "updatedAt": "@updated_at",
    "actualStartTime": "@actual_start_time",
    "actualEndTime": "@actual_end_time",
    "completedAt": "@completed_at",
}


def people(users: DataFrame, profiles: DataFrame) -> DataFrame:
    """One row per user: external id, name and phone."""
    named = profiles.select(F.col("user_id").alias("id"), "first_name", "last_name", "phone")
    return users.select("id", "external_uid").join(named, "id", "left").select(
        "id", "external_uid", full_name("first_name", "last_name").alias("name"), "phone"
    )


def driver_cards(users: DataFrame, profiles: DataFrame, drivers: DataFrame, vehicles: DataFrame) -> DataFrame:
    """People who may drive, with rating and primary vehicle where known; one row per user."""
    primary = (
        vehicles.filter(F.col("is_primary"))
        .groupBy("driver_id")
        .agg(F.min_by(F.struct("plate_number", "model"), "plate_number").alias("vehicle"))
    )
    known = (
        drivers.select(F.col("id").alias("driver_id"), F.col("user_id").alias("id"), "rating")
        .join(primary, "driver_id", "left")
        .select("id", "rating", "vehicle.plate_number", "vehicle.model")
    )
    return people(users, profiles).join(known, "id", "left")


class Dimensions(NamedTuple):
    """The tables a booking event is enriched from."""

    users: DataFrame
    profiles: DataFrame
    drivers: DataFrame
    vehicles: DataFrame


def with_payload(
    changes: DataFrame, dimensions: Dimensions, limit: int | None = None, keys_from: DataFrame | None = None
) -> DataFrame:
    """Booking changes with the payload as a struct ``p``: one lookup for the rider, one for the driver.

    Heavy keys are looked for in ``keys_from``, the rows that ``changes`` were chosen from, so that they
    need not be chosen again for that.
    """
    keys_from = changes if keys_from is None else keys_from
    riders = people(dimensions.users, dimensions.profiles).select(
        F.col("id").alias("customer_id"), F.struct("external_uid", "name", "phone").alias("_rider")
    )
    cards = driver_cards(*dimensions).select(
        F.col("id").alias("driver_id"),
        F.struct("external_uid", "name", "phone", "plate_number", "model", "rating").alias("_driver"),
    )
    rows = lookup(changes, riders, "customer_id", limit=limit, keys_from=keys_from, spread_by=("id", "version"))
    rows = lookup(rows, cards, "driver_id", limit=limit, keys_from=keys_from, spread_by=("id", "version"))
    fields: list[Column] = [
        F.col("id"),
        F.col("booking_number").alias("bookingNumber"),
        F.col("_rider.external_uid").alias("customerId"),
        F.col("_rider.name").alias("customerName"),
        F.col("_rider.phone").alias("customerPhone"),
        F.col("_driver.external_uid").alias("driverId"),
        F.col("_driver.name").alias("driverName"),
        F.col("_driver.phone").alias("driverPhone"),
        F.col("_driver.plate_number").alias("driverVehiclePlate"),
        F.col("_driver.model").alias("driverVehicleModel"),
        F.col("_driver.rating").alias("driverRating"),
    ]
    computed = {"country": country_of(), "service_type": service_of(), "start_date": F.col("start_date").cast("string")}
    for name, column in PAYLOAD_COLUMNS.items():
        value = iso_text(column[1:]) if column.startswith("@") else computed.get(column, F.col(column))
        fields.append(value.alias(name))
    fields.append(geo_point("pickup_latitude", "pickup_longitude").alias("pickupLocation"))
    fields.append(geo_point("dropoff_latitude", "dropoff_longitude").alias("dropoffLocation"))
    return rows.withColumn("p", F.struct(*fields)).drop("_rider", "_driver")


def _event_type(changes: DataFrame) -> Column:
    kind = F.when(F.col("version") == 1, "created").otherwise("updated")
    return F.when(F.col("op") == "delete", "deleted").otherwise(kind) if "op" in changes.columns else kind


def booking_events(
    changes: DataFrame,
    dimensions: Dimensions,
    limit: int | None = None,
    keys_from: DataFrame | None = None,
    superseded: bool = True,
) -> DataFrame:
    """Event rows with a JSON payload from booking changes.

    ``changes`` carries the booking's columns plus ``version``, ``changed_at`` and, if there
    are deletes, ``op``. Without ``superseded``, changes that have a newer one of the same booking are left out
    where that is cheap to tell, for a caller who looks at each booking's newest event alone.
    """
    rows = changes
    if not superseded:
        rows, keys_from = maybe_newest(changes, "id", "changed_at"), changes if keys_from is None else keys_from
    return with_payload(rows, dimensions, limit, keys_from).select(
        natural_id(F.lit("booking"), "id", F.col("version").cast("string")).alias("id"),
        F.lit("booking").alias("aggregate_type"),
        F.col("id").alias("aggregate_id"),
        _event_type(changes).alias("event_type"),
        F.to_json("p", {"ignoreNullFields": "false"}).alias("payload"),
        F.col("changed_at").alias("created_at"),
    )


def backfill_events(
    bookings: DataFrame,
    predicate: Column,
    dimensions: Dimensions,
    emitted_at: dt.datetime | str,
    limit: int | None = None,
    keys_from: DataFrame | None = None,
) -> DataFrame:
    """``updated`` events for all bookings that meet ``predicate``, without a change of theirs."""
    rows = (
        bookings.filter(predicate)
        .withColumn("deposit_paid", F.coalesce("deposit_paid", F.lit(False)))
        .withColumn("changed_at", instant(bookings, "created_at", emitted_at))
        .withColumn("version", F.concat(F.lit("backfill "), iso_text("changed_at")))
    )
    return booking_events(rows, dimensions, limit, keys_from).withColumn("event_type", F.lit("updated"))


def needs_promo_backfill() -> Column:
    return F.col("promo_code").isNotNull() | F.col("tax_id").isNotNull()


def needs_deposit_backfill() -> Column:
    return F.col("deposit_paid") & F.col("status").isin(*DEPOSIT_PAID_STATUSES)


def reemit(bookings: DataFrame, ids: DataFrame) -> DataFrame:
    """The bookings named in ``ids`` (column ``id``), for ``backfill_events``."""
    return bookings.join(ids.select("id").distinct(), "id", "left_semi")


# --- delivery ---------------------------------------------------------------------------

# kinds of events that somebody consumes
CONSUMED = ("booking", "chat_message")


def pending_events(log: DataFrame, state: DataFrame, max_retry: int = MAX_RETRY) -> DataFrame:
    """Events neither delivered nor out of attempts. ``state`` is unique per event."""
    done = state.filter(F.col("delivered_at").isNotNull() | (F.col("attempts") >= max_retry))
    return log.join(done.select(F.col("event_id").alias("id")), "id", "left_anti")


def dead_letters(log: DataFrame, state: DataFrame, max_retry: int = MAX_RETRY) -> DataFrame:
    """Undelivered events that used up their attempts, and events of a kind nobody consumes."""
    known = F.col("aggregate_type").isin(*CONSUMED)
    parked = state.filter(F.col("delivered_at").isNull() & (F.col("attempts") >= max_retry))
    rows = log.join(parked.select(F.col("event_id").alias("id"), "attempts"), "id", "left")
    reason = F.when(~known, "unknown_type").when(F.col("attempts").isNotNull(), "retries_exhausted")
    return rows.withColumn("reason", reason).filter(F.col("reason").isNotNull()).select(
        "id", "aggregate_type", "aggregate_id", "event_type", "reason"
    )


def delivery_outcome(attempts: DataFrame) -> DataFrame:
    """Per event: delivered to all targets, to some (a warning), or to none (retry)."""
    counts = attempts.groupBy("event_id").agg(
        F.count_if("ok").alias("targets_ok"), F.count_if(~F.col("ok")).alias("targets_failed")
    )
    outcome = (
        F.when(F.col("targets_failed") == 0, "success").when(F.col("targets_ok") > 0, "partial").otherwise("retry")
    )
    return counts.select("event_id", "targets_ok", "targets_failed", outcome.alias("outcome"))


def next_delivery_state(state: DataFrame, outcomes: DataFrame, at: dt.datetime | str) -> DataFrame:
    """Delivery state after a round: delivered stays delivered, a retry counts one more attempt."""
    got = outcomes.select("event_id", F.col("outcome").alias("_outcome"))
    rows = state.join(got, "event_id", "full")
    ok = F.col("_outcome").isin("success", "partial")
    tries = F.coalesce("attempts", F.lit(0))
    return rows.select(
        "event_id",
        F.when(F.col("_outcome") == "retry", tries + 1).otherwise(tries).alias("attempts"),
        F.coalesce("delivered_at", F.when(ok, instant(state, "delivered_at", at))).alias("delivered_at"),
        F.when(F.col("_outcome") == "retry", "all targets failed").otherwise(F.col("last_error")).alias("last_error"),
    )


# --- projection -------------------------------------------------------------------------

_POINT = "struct<latitude:decimal(10,8),longitude:decimal(11,8)>"

# what the projection reads from a payload
PAYLOAD_SCHEMA = f"""
    customerId string, customerName string, customerPhone string,
    driverId string, driverName string, driverPhone string,
    driverVehiclePlate string, driverVehicleModel string, driverRating decimal(3,2),
    status string, pickupAddress string, destination string, startDate string, startTime string,
    specialRequirements string, passengerCount int, luggageCount int,
    overtimeFee decimal(10,2), tipAmount decimal(10,2), totalAmount decimal(10,2),
    depositAmount decimal(10,2), depositPaid boolean, platformFee decimal(10,2), driverEarning decimal(10,2),
    tourPackageId string, tourPackageName string, promoCode string, influencerId string,
    influencerCommission decimal(10,2), originalPrice decimal(10,2), discountAmount decimal(10,2),
    finalPrice decimal(10,2), taxId string, country string, serviceType string,
    createdAt string, actualStartTime string, actualEndTime string,
    pickupLocation {_POINT}, dropoffLocation {_POINT}
"""


def latest_event(events: DataFrame) -> DataFrame:
    """The newest event per aggregate; the id breaks ties."""
    return newest(events, "aggregate_id", ["created_at", "id"])


def _time(field: str) -> Column:
    return F.col(f"p.{field}").cast("timestamp_ntz")


def _document(rows: DataFrame, booking_id: str, at: str, *keep: str | Column) -> DataFrame:
    """The documents of payload structs ``p``: app status, defaults for absent, zero and empty values."""
    zero = F.lit(0).cast("decimal(10,2)")

    def text(field: str) -> Column:
        return text_or(f"p.{field}").alias(field)

    def amount(field: str, name: str | None = None) -> Column:
        return F.coalesce(f"p.{field}", zero).alias(name or field)

    has_time = text_or("p.startDate").isNotNull() & text_or("p.startTime").isNotNull()
    start = F.concat(F.col("p.startDate"), F.lit("T"), F.col("p.startTime")).cast("timestamp_ntz")
    return rows.select(
        F.col(booking_id).alias("id"),
        F.col("p.customerId").alias("customerId"),
        text("driverId"), text("customerName"), text("customerPhone"),
        text("driverName"), text("driverPhone"), text("driverVehiclePlate"), text("driverVehicleModel"),
        number_or("p.driverRating").cast(RATING).alias("driverRating"),
        F.coalesce("p.pickupAddress", F.lit("")).alias("pickupAddress"),
        F.col("p.pickupLocation").alias("pickupLocation"),
        F.coalesce("p.destination", F.lit("")).alias("dropoffAddress"),
        F.col("p.dropoffLocation").alias("dropoffLocation"),
        F.when(has_time, start).otherwise(_time("createdAt")).alias("bookingTime"),
        number_or("p.passengerCount", 1).alias("passengerCount"),
        number_or("p.luggageCount").alias("luggageCount"),
        text_or("p.specialRequirements").alias("notes"),
        text("tourPackageId"), text("tourPackageName"), text("promoCode"), text("influencerId"),
        amount("influencerCommission"),
        number_or("p.originalPrice").alias("originalPrice"),
        amount("discountAmount"),
        number_or("p.finalPrice").alias("finalPrice"), text("taxId"),
        text_or("p.country", "TW").alias("country"),
        text_or("p.serviceType", "charter").alias("serviceType"),
        amount("totalAmount", "estimatedFare"),
        amount("depositAmount"), amount("overtimeFee"), amount("tipAmount"),
        amount("platformFee"), amount("driverEarning"),
        F.coalesce("p.depositPaid", F.lit(False)).alias("depositPaid"),
        app_status("p.status").alias("status"),
        _time("createdAt").alias("createdAt"),
        _time("actualStartTime").alias("matchedAt"),
        _time("actualEndTime").alias("completedAt"),
        F.col(at).alias("event_at"),
        *keep,
    )


def booking_document(events: DataFrame) -> DataFrame:
    """The document of each event."""
    return _document(events.withColumn("p", F.from_json("payload", PAYLOAD_SCHEMA)), "aggregate_id", "created_at")


def documents_of_events(events: DataFrame, latest: Callable[[DataFrame], DataFrame] = latest_event) -> DataFrame:
    """The document of each booking's newest event, deletions marked rather than dropped.

    ``event_at`` and ``event_id`` order documents of the same booking. ``latest`` finds the newest events, as
    ``latest_event`` does, where the caller has a cheaper way to them.
    """
    parsed = latest(events).withColumn("p", F.from_json("payload", PAYLOAD_SCHEMA))
    deleted = (F.col("event_type") == "deleted").alias("is_deleted")
    return _document(parsed, "aggregate_id", "created_at", F.col("id").alias("event_id"), deleted)


def documents_of_changes(
    changes: DataFrame, dimensions: Dimensions, limit: int | None = None, keys_from: DataFrame | None = None
) -> DataFrame:
    """The document of each booking change, without the detour over a JSON payload."""
    rows = with_payload(changes, dimensions, limit, keys_from)
    deleted = (_event_type(changes) == "deleted").alias("is_deleted")
    return _document(rows, "id", "changed_at", "version", deleted)


def project_bookings(events: DataFrame) -> DataFrame:
    """The current document of each booking; one whose newest event deletes it is gone.

    Most events that are not the newest are told by bookings and times alone, so few payloads are parsed that
    are not needed. What the projection takes from a payload is less to move than its text, so it is parsed
    before the newest are chosen.
    """
    own = maybe_newest(events.filter(F.col("aggregate_type") == "booking"), "aggregate_id", "created_at")
    parsed = own.select("aggregate_id", "id", "event_type", "created_at", F.from_json("payload", PAYLOAD_SCHEMA).alias("p"))
    return _document(latest_event(parsed).filter(F.col("event_type") != "deleted"), "aggregate_id", "created_at")


def project_changes(changes: DataFrame, deletions: DataFrame, dimensions: Dimensions, limit: int | None = None) -> DataFrame:
    """``project_bookings`` of the events of ``changes`` and of ``deletions`` (events), without the events.

    Which change is the newest is found on ids and times alone; only that one row of a booking is then
    read whole and enriched, and no payload is written or parsed.
    """
    own = natural_id(F.lit("booking"), "id", F.col("version").cast("string"))
    marks = changes.select("id", F.col("changed_at").alias("at"), own.alias("event_id"), "version").unionByName(
        deletions.select(F.col("aggregate_id").alias("id"), F.col("created_at").alias("at"), F.col("id").alias("event_id")),
        allowMissingColumns=True,
    )
    last = newest(marks, "id", ["at", "event_id"]).filter(F.col("version").isNotNull())
    rows = changes.join(last.select("id", "version"), ["id", "version"], "left_semi").select(changes.columns)
    return documents_of_changes(rows, dimensions, limit, changes).drop("version", "is_deleted")


def projection_tombstones(events: DataFrame) -> DataFrame:
    """Bookings whose newest event deletes them: to be dropped from both collections, there or not.

    No payload is moved for it.
    """
    bare = events.filter(F.col("aggregate_type") == "booking").select("aggregate_id", "id", "event_type", "created_at")
    latest = latest_event(bare)
    return latest.filter(F.col("event_type") == "deleted").select(
        "aggregate_id", F.col("id").alias("event_id"), F.col("created_at").alias("deleted_at")
    )


# document field -> kind of its tagged form; "number" is decided by value
DOCUMENT_KINDS = {
    "customerId": "string", "driverId": "string", "customerName": "string", "customerPhone": "string",
    "driverName": "string", "driverPhone": "string", "driverVehiclePlate": "string", "driverVehicleModel": "string",
    "driverRating": "number", "pickupAddress": "string", "pickupLocation": "geo", "dropoffAddress": "string",
    "dropoffLocation": "geo", "bookingTime": "timestamp", "passengerCount": "number", "luggageCount": "number",
    "notes": "string", "tourPackageId": "string", "tourPackageName": "string", "promoCode": "string",
    "influencerId": "string", "influencerCommission": "number", "originalPrice": "number", "discountAmount": "number",
    "finalPrice": "number", "taxId": "string", "country": "string", "serviceType": "string", "estimatedFare": "number",
    "depositAmount": "number", "overtimeFee": "number", "tipAmount": "number", "platformFee": "number",
    "driverEarning": "number", "depositPaid": "boolean", "status": "string", "createdAt": "timestamp",
    "matchedAt": "timestamp", "completedAt": "timestamp",
}


def document_fields_long(documents: DataFrame) -> DataFrame:
    """Documents as (doc_id, field, type_tag, value) rows, one per field."""

    def entry(field: str, kind: str) -> Column:
        column = F.col(field)
        if kind == "number":
            # no trailing zeros: 120.50 reads 120.5, and 120.00 is the integer 120
            text, type_ = column.cast("string"), documents.schema[field].dataType
            if isinstance(type_, T.DecimalType) and 0 < type_.scale <= 6:  # digits and a point, never an exponent
                text = F.rtrim(F.rtrim(text, F.lit("0")), F.lit("."))
            elif not isinstance(type_, T.IntegralType):
                text = F.regexp_replace(F.regexp_replace(text, r"(\.\d*?)0+$", "$1"), r"\.$", "")
            tag = F.when(F.contains(text, F.lit(".")), "double").otherwise("integer")
        elif kind == "geo":
            text = F.concat_ws(",", column["latitude"].cast("string"), column["longitude"].cast("string"))
            tag = F.lit("geo")
        elif kind == "timestamp":
            text, tag = iso_text(column), F.lit("timestamp")
        else:
            text, tag = column.cast("string"), F.lit(kind)
        return F.struct(
            F.lit(field).alias("field"),
            F.when(column.isNull(), "null").otherwise(tag).alias("type_tag"),
            F.when(column.isNotNull(), text).alias("value"),
        )

    entries = F.array(*(entry(f, k) for f, k in DOCUMENT_KINDS.items()))
    return documents.select(F.col("id").alias("doc_id"), F.inline(entries))


# --- collections ------------------------------------------------------------------------


def backfill_missing(source: DataFrame, target: DataFrame, key: str = "id") -> DataFrame:
    """Documents of ``source`` that ``target`` lacks, to be appended to it."""
    return source.join(target.select(key), key, "left_anti")


def backfill_stats(source: DataFrame, target: DataFrame, key: str = "id") -> DataFrame:
    """What the backfill finds: documents in all, there already, copied."""
    seen = target.select(key).withColumn("_there", F.lit(True))
    return source.select(key).join(seen, key, "left").agg(
        F.count(F.lit(1)).alias("total"),
        F.count("_there").alias("already_exists"),
        F.count_if(F.col("_there").isNull()).alias("copied"),
    )


# --- retention and cache ----------------------------------------------------------------


def _cutoff(df: DataFrame, column: str, as_of: dt.datetime | str, **back: int) -> Column:
    moment = as_of if isinstance(as_of, dt.datetime) else dt.datetime.fromisoformat(str(as_of))
    return instant(df, column, moment - dt.timedelta(**back))


def retain(
    df: DataFrame, column: str, as_of: dt.datetime | str, days: int = RETENTION_DAYS, keep_null: bool = True
) -> DataFrame:
    """The rows that stay: younger than ``days``, and with ``keep_null`` those without a time."""
    young = F.col(column) >= _cutoff(df, column, as_of, days=days)
    return df.filter(young | F.col(column).isNull() if keep_null else young)


def retention_counts(
    df: DataFrame, column: str, as_of: dt.datetime | str, days: int = RETENTION_DAYS
) -> DataFrame:
    """Rows in all and rows the retention deletes."""
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col(column) < _cutoff(df, column, as_of, days=days)).alias("deleted"),
    )


def cache_lookup(
    requests: DataFrame,
    cache: DataFrame,
    as_of: dt.datetime | str,
    hours: int = CACHE_HOURS,
    limit: int | None = None,
) -> DataFrame:
    """The newest valid cache entry per request, by query and language; NULLs on a miss."""
    fresh = cache.filter(
        (F.col("created_at") > _cutoff(cache, "created_at", as_of, hours=hours))
        & (F.col("created_at") <= instant(cache, "created_at", as_of))
    ).select("search_query", "language_code", F.col("id").alias("cache_id"), "name", F.col("created_at").alias("cached_at"))
    keys = ["search_query", "language_code"]
    best = newest(fresh, keys, ["cached_at", "cache_id"])
    rows = lookup(requests, best, keys, limit=limit)
    return rows.select(
        "request_id", "search_query", "language_code", "cache_id", "name", "cached_at",
        F.col("cache_id").isNotNull().alias("is_hit"),
    )


# parts of the validity in which entries and requests are brought together
CACHE_PARTS = 24


def cache_lookup_as_of(requests: DataFrame, cache: DataFrame, hours: int = CACHE_HOURS, parts: int = CACHE_PARTS) -> DataFrame:
    """The newest entry of the ``hours`` before each request (``requested_at``), by query and language.

    Time is cut into slices of a part of the validity. Entries and requests of one slice are put in
    order together; of each earlier slice that may still matter only the newest entry is carried
    over, to at most ``parts`` later slices. So a task sorts no more than a slice of a query, however
    often it is asked, and no request meets all entries. An entry of the very moment of the request
    counts, one exactly ``hours`` old does not; of entries of one time the greatest id wins. Requests
    without a query, language or time miss.
    """
    keys = ["search_query", "language_code"]
    width = hours * 3600 * 1_000_000 // parts

    def at(column: str) -> Column:
        return F.unix_micros(F.col(column).cast("timestamp"))

    known = F.col("search_query").isNotNull() & F.col("language_code").isNotNull()
    entry = F.struct(F.col("created_at").alias("cached_at"), F.col("id").alias("cache_id"), "name")
    entries = cache.filter(known & F.col("created_at").isNotNull()).select(
        *keys, at("created_at").alias("_at"), F.floor(at("created_at") / width).alias("_slice"), entry.alias("_entry")
    )
    best = entries.groupBy(*keys, "_slice").agg(F.max("_entry").alias("_entry"))
    carried = best.select(*keys, F.explode(F.sequence(F.col("_slice") + 1, F.col("_slice") + parts)).alias("_slice"), "_entry")
    carried = carried.groupBy(*keys, "_slice").agg(F.max("_entry").alias("_entry")).withColumn("_at", F.lit(None).cast("long"))
    asked = requests.filter(known & F.col("requested_at").isNotNull()).select(
        *keys, at("requested_at").alias("_at"), F.floor(at("requested_at") / width).alias("_slice"), "request_id", "requested_at"
    )
    rows = entries.unionByName(carried).unionByName(asked, allowMissingColumns=True)
    # what is carried stands first, an entry before a request of the same moment
    order = [F.col("_at").asc_nulls_first(), F.col("requested_at").isNotNull(), F.col("_entry.cache_id")]
    before = Window.partitionBy(*keys, "_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    found = rows.withColumn("_found", F.last("_entry", ignorenulls=True).over(before)).filter(F.col("requested_at").isNotNull())
    fresh = F.col("_found.cached_at") > F.col("requested_at") - F.make_dt_interval(hours=F.lit(hours))
    found = found.select("request_id", *keys, "requested_at", F.when(fresh, F.col("_found")).alias("_found"))
    missed = requests.filter(~known | F.col("requested_at").isNull()).select("request_id", *keys, "requested_at")
    rows = found.unionByName(missed, allowMissingColumns=True)
    return rows.select(
        "request_id", *keys, "requested_at", "_found.cache_id", "_found.name", "_found.cached_at",
        F.col("_found").isNotNull().alias("is_hit"),
    )


# --- chat -------------------------------------------------------------------------------


# what the projection reads from a chat message's payload
MESSAGE_SCHEMA = """
    id string, bookingId string, senderId string, receiverId string, senderName string, receiverName string,
    messageText string, translatedText string, createdAt string, readAt string,
    bookingData struct<customerId: string, driverId: string, customerName: string, driverName: string,
                       pickupAddress: string, bookingTime: string>
"""


def messages_of_events(events: DataFrame) -> DataFrame:
    """The message of each chat event's payload, with the event's id, type and time.

    The message is named by the aggregate; a deletion need not carry more than its booking.
    """
    rows = events.withColumn("p", F.from_json("payload", MESSAGE_SCHEMA))
    return rows.select(
        F.col("p.bookingId").alias("booking_id"),
        F.col("aggregate_id").alias("message_id"),
        F.col("p.senderId").alias("sender_id"), F.col("p.receiverId").alias("receiver_id"),
        F.coalesce("p.senderName", F.lit("")).alias("sender_name"),
        F.coalesce("p.receiverName", F.lit("")).alias("receiver_name"),
        F.col("p.messageText").alias("message_text"),
        text_or("p.translatedText").alias("translated_text"),
        F.col("p.createdAt").cast("timestamp_ntz").alias("created_at"),
        F.col("p.readAt").cast("timestamp_ntz").alias("read_at"),
        F.col("p.bookingData").alias("booking"),
        F.col("created_at").alias("event_at"),
        F.col("id").alias("event_id"),
        (F.col("event_type") == "deleted").alias("is_deleted"),
    )


ROOM_SIDES = ("customerId", "driverId", "customerName", "driverName", "pickupAddress")


#: The columns of a booking change that a room needs.
ROOM_SOURCE = (
    "id", "version", "changed_at", "customer_id", "driver_id", "pickup_location", "start_date", "start_time", "created_at",
)


def with_blanks(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """``rows`` with the columns of ``schema`` they lack, as NULL: for operators that want whole rows of
    which the caller keeps few columns, so that the others are not moved before."""
    return rows.withColumns({f.name: F.lit(None).cast(f.dataType) for f in schema if f.name not in rows.columns})


def rooms_of_messages(messages: DataFrame) -> DataFrame:
    """The room of each message of ``messages_of_events``: the message and the booking it names."""
    return messages.filter(~F.col("is_deleted")).select(
        "booking_id",
        *(F.coalesce(f"booking.{c}", F.lit("")).alias(c) for c in ROOM_SIDES),
        F.col("booking.bookingTime").cast("timestamp_ntz").alias("bookingTime"),
        F.coalesce("message_text", F.lit("")).alias("lastMessage"),
        F.col("created_at").alias("lastMessageTime"),
        "event_at", "event_id",
    )


def project_messages(events: DataFrame) -> DataFrame:
    """Current chat messages: newest event per (booking, message), withdrawn ones dropped.

    A deletion carries no text, so it only removes the message.
    """
    latest = newest(events, ["booking_id", "message_id"], ["created_at", "seq"])
    return latest.filter(F.col("event_type") != "deleted").select(
        "booking_id", "message_id", "sender_id", "receiver_id",
        F.coalesce("sender_name", F.lit("")).alias("sender_name"),
        F.coalesce("receiver_name", F.lit("")).alias("receiver_name"),
        "message_text",
        text_or("translated_text").alias("translated_text"),
        F.col("message_at").alias("created_at"),
        "read_at",
    )


def chat_rooms(events: DataFrame, documents: DataFrame) -> DataFrame:
    """Room state per booking: the last message written and the two sides of the booking.

    Deleting a message does not touch the room, so withdrawn messages still count. Messages
    are reduced to one row per booking before the documents (one per booking) are joined.
    """
    order = F.struct("created_at", "message_at", "message_id")
    rooms = (
        events.filter(F.col("event_type") != "deleted")
        .groupBy(F.col("booking_id").alias("id"))
        .agg(F.max_by(F.struct("message_text", "message_at"), order).alias("m"))
    )
    sides = ["customerId", "driverId", "customerName", "driverName", "pickupAddress"]
    joined = rooms.join(documents.select("id", *sides, "bookingTime"), "id", "left")
    return joined.select(
        F.col("id").alias("booking_id"),
        *(F.coalesce(c, F.lit("")).alias(c) for c in sides),
        "bookingTime",
        F.coalesce("m.message_text", F.lit("")).alias("lastMessage"),
        F.col("m.message_at").alias("lastMessageTime"),
    )


# --- monitoring -------------------------------------------------------------------------


def outbox_backlog(outbox: DataFrame, as_of: dt.datetime | str) -> DataFrame:
    """Undelivered events: how many, the oldest and newest, the age of the oldest in seconds."""
    open_ = outbox.filter(F.col("processed_at").isNull()).agg(
        F.count(F.lit(1)).alias("unprocessed_count"),
        F.min("created_at").alias("oldest_event"),
        F.max("created_at").alias("newest_event"),
    )
    return open_.withColumn(
        "oldest_event_age_seconds", seconds_between("oldest_event", instant(outbox, "created_at", as_of))
    )


def sync_latency(outbox: DataFrame) -> DataFrame:
    """Delivery delay per aggregate type, in whole seconds: count, extremes, mean, percentiles.

    Exact percentiles from a histogram: the groups are (type, second), a number bounded by
    the retention time, so the percentile buffers stay small however many events there are.
    """
    delay = F.floor(seconds_between("created_at", "processed_at")).cast("bigint")
    histogram = (
        outbox.filter(F.col("processed_at").isNotNull())
        .groupBy("aggregate_type", delay.alias("s"))
        .agg(F.count(F.lit(1)).alias("n"))
    )

    def at(p: float) -> Column:
        return F.round(F.percentile("s", p, F.col("n")), 4)

    return histogram.groupBy("aggregate_type").agg(
        F.sum("n").alias("events"),
        F.min("s").alias("min_seconds"),
        F.max("s").alias("max_seconds"),
        F.round(F.sum(F.col("s") * F.col("n")).cast("double") / F.sum("n"), 4).alias("avg_seconds"),
        at(0.5).alias("p50_seconds"),
        at(0.95).alias("p95_seconds"),
    )


_PICKED = """
    status string, depositPaid string, promoCode string, totalAmount decimal(10,2),
    pickupLocation struct<latitude:decimal(10,8)>
"""


def payload_fields(outbox: DataFrame) -> DataFrame:
    """Fields out of the payload beside the event's own columns; the payload is parsed once."""
    return outbox.withColumn("p", F.from_json("payload", _PICKED)).select(
        "id",
        "event_type",
        F.col("p.status").alias("status"),
        F.col("p.depositPaid").alias("deposit_paid"),
        F.col("p.promoCode").alias("promo_code"),
        F.col("p.totalAmount").alias("total_amount"),
        F.col("p.pickupLocation.latitude").alias("pickup_latitude"),
        "created_at",
    )


def payload_completeness(events: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """Per event type: events, and for each field how many payloads carry it.

    The payload is parsed once for all fields.
    """
    parsed = events.select("event_type", F.from_json("payload", ", ".join(f"{f} string" for f in fields)).alias("p"))
    return parsed.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("events"), *(F.count(f"p.{f}").alias(f"with_{f}") for f in fields)
    )


def outbox_by_booking(outbox: DataFrame, bookings: DataFrame, status: str = "matched", limit: int | None = None) -> DataFrame:
    """Events of bookings in ``status`` that have a driver.

    The log's aggregate ids repeat, one booking may own much of the log: a skew-safe lookup.
    """
    wanted = bookings.filter((F.col("status") == status) & F.col("driver_id").isNotNull()).select(
        F.col("id").alias("aggregate_id"), "booking_number", "driver_id"
    )
    rows = outbox.select("id", "aggregate_id", "event_type", "created_at", "processed_at")
    state = F.when(F.col("processed_at").isNotNull(), "synced").otherwise("pending")
    return lookup(rows, wanted, "aggregate_id", "inner", limit).select(
        "id", "aggregate_id", "booking_number", "event_type", "created_at", "processed_at", state.alias("sync_state")
    )
