"""Every query by name, over the generated test tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.functions.columns import app_status, seconds_between
from fareloom.operators import cdc, commission, payments, quality, reports, split, tables
from fareloom.schemas import INSTANT_SERVICE, WIDE_DOCUMENT_COLUMNS, WIDE_PHOTO_COLUMNS
from fareloom.session import work_path
from fareloom.sources import sinks
from fareloom.sources.marketplace import Marketplace, StreamingMarketplace
from fareloom.sources.tables import load
from fareloom.streaming import commissions, delivery, event_log, expiry, history, jobs, rollup

Query = Callable[[SparkSession, str], DataFrame]

START, END = dt.date(1996, 1, 1), dt.date(2000, 12, 31)
AS_OF = "2024-01-29 00:00:00"
PAYMENTS_AS_OF = "1999-01-01 00:00:00"
EMITTED_AT = "2024-02-01 00:00:00"

_QUERIES: dict[str, Query] = {}


def query(fn: Callable[[Marketplace], DataFrame]) -> Callable[[Marketplace], DataFrame]:
    """Register a query under its function name."""

    def run(spark: SparkSession, directory: str) -> DataFrame:
        return fn(Marketplace(spark, directory))

    _QUERIES[fn.__name__] = run
    return fn


def registered() -> dict[str, Query]:
    return dict(_QUERIES)


# --- scans and the event log ------------------------------------------------------------


@query
def scan_bookings(m: Marketplace) -> DataFrame:
    return m.bookings.select("id", "customer_id", "driver_id", "status", "total_amount", "service_type", "country", "created_at")


@query
def load_older_bookings(m: Marketplace) -> DataFrame:
    """Bookings from files that were written before country and service type were added."""
    path = work_path(m.spark, "entities")
    m.bookings.drop("country", "service_type").write.parquet(f"{path}/bookings")
    rows = load(m.spark, path, ["bookings"])["bookings"]
    return tables.fill_defaults(rows).select("id", "total_amount", "country", "service_type", "original_price", "final_price")


def _state(m: Marketplace) -> DataFrame:
    return m.outbox.select(
        F.col("id").alias("event_id"), F.col("retry_count").alias("attempts"), F.col("processed_at").alias("delivered_at")
    )


@query
def outbox_pending(m: Marketplace) -> DataFrame:
    rows = cdc.pending_events(m.outbox.drop("processed_at", "retry_count"), _state(m))
    return rows.select("id", "aggregate_type", "aggregate_id", "event_type", "created_at")


def _dimensions(m: Marketplace) -> cdc.Dimensions:
    return cdc.Dimensions(m.users, m.profiles, m.drivers, m.vehicles)


def _events(m: Marketplace) -> DataFrame:
    return cdc.booking_events(m.changes, _dimensions(m))


@query
def outbox_build(m: Marketplace) -> DataFrame:
    return _events(m)


def _backfilled(m: Marketplace, rows: DataFrame, predicate: Column) -> DataFrame:
    return cdc.backfill_events(rows, predicate, _dimensions(m), EMITTED_AT)


@query
def outbox_backfill_promo(m: Marketplace) -> DataFrame:
    return _backfilled(m, m.bookings, cdc.needs_promo_backfill())


@query
def outbox_backfill_deposit(m: Marketplace) -> DataFrame:
    return _backfilled(m, m.bookings, cdc.needs_deposit_backfill())


@query
def outbox_reemit(m: Marketplace) -> DataFrame:
    """Events again for every booking that has a failed payment."""
    failed = m.payments.filter(F.col("status") == "failed").select(F.col("booking_id").alias("id"))
    rows = cdc.reemit(m.bookings, failed)
    return cdc.backfill_events(rows, F.lit(True), _dimensions(m), EMITTED_AT, keys_from=m.bookings)


def _deletions(m: Marketplace) -> DataFrame:
    deletes = m.outbox.filter((F.col("aggregate_type") == "booking") & (F.col("event_type") == "deleted"))
    return deletes.select("id", "aggregate_type", "aggregate_id", "event_type", "payload", "created_at")


def _log_with_deletes(m: Marketplace) -> DataFrame:
    """Built events of bookings, plus the deletions in the event log from the same bookings."""
    return _events(m).unionByName(_deletions(m))


@query
def projection_of_events(m: Marketplace) -> DataFrame:
    """The projection from the events' payloads, as a consumer of the log alone sees them."""
    return _flat_points(cdc.project_bookings(_log_with_deletes(m)))


def _flat_points(rows: DataFrame) -> DataFrame:
    """Documents with their points as plain columns."""
    flat = [c for c in rows.columns if c not in ("pickupLocation", "dropoffLocation")]
    return rows.select(
        *flat,
        F.col("pickupLocation.latitude").alias("pickup_latitude"),
        F.col("pickupLocation.longitude").alias("pickup_longitude"),
        F.col("dropoffLocation.latitude").alias("dropoff_latitude"),
        F.col("dropoffLocation.longitude").alias("dropoff_longitude"),
    )


@query
def projection_latest(m: Marketplace) -> DataFrame:
    return _flat_points(cdc.project_changes(m.changes, _deletions(m), _dimensions(m)))


@query
def projection_tombstones(m: Marketplace) -> DataFrame:
    return cdc.projection_tombstones(_log_with_deletes(m))


@query
def delivery_outcome(m: Marketplace) -> DataFrame:
    return cdc.delivery_outcome(m.delivery_attempts)


def _collections(m: Marketplace) -> tuple[DataFrame, DataFrame]:
    """All bookings as one collection; the other one lacks those nobody paid for."""
    paid = m.payments.filter(F.col("status") == "completed").select(F.col("booking_id").alias("id"), "amount")
    return m.bookings.select("id", "customer_id", "total_amount"), paid


@query
def backfill_missing(m: Marketplace) -> DataFrame:
    return cdc.backfill_missing(*_collections(m))


@query
def backfill_stats(m: Marketplace) -> DataFrame:
    return cdc.backfill_stats(*_collections(m))


@query
def chat_messages_latest(m: Marketplace) -> DataFrame:
    return cdc.project_messages(m.chat_events)


@query
def chat_room_rollup(m: Marketplace) -> DataFrame:
    # only bookings with a room need a document, and only with what the room shows
    rooms = m.chat_events.select(F.col("booking_id").alias("id")).distinct()
    log = m.changes.select(*cdc.ROOM_SOURCE)
    changes = commission.newest_changes(log.join(rooms, "id", "left_semi"))
    documents = cdc.documents_of_changes(cdc.with_blanks(changes, m.changes.schema), _dimensions(m), keys_from=log)
    return cdc.chat_rooms(m.chat_events, documents)


@query
def outbox_retention(m: Marketplace) -> DataFrame:
    return cdc.retain(m.outbox, "processed_at", AS_OF).select("id", "aggregate_id", "created_at", "processed_at")


@query
def cache_retention(m: Marketplace) -> DataFrame:
    return cdc.retention_counts(m.place_cache, "created_at", AS_OF)


@query
def cache_lookup(m: Marketplace) -> DataFrame:
    return cdc.cache_lookup(m.place_requests, m.place_cache, AS_OF)


@query
def cache_lookup_as_of(m: Marketplace) -> DataFrame:
    return cdc.cache_lookup_as_of(m.place_requests_timed, m.place_cache)


@query
def payment_validate(m: Marketplace) -> DataFrame:
    rows = payments.validate_intents(m.payment_requests)
    return rows.select("request_id", "is_valid", F.array_join("errors", ",").alias("errors"))


@query
def webhook_validate(m: Marketplace) -> DataFrame:
    rows = payments.validate_webhooks(m.webhooks)
    return rows.select("webhook_id", "is_valid", F.array_join("errors", ",").alias("errors"))


@query
def upsert_users(m: Marketplace) -> DataFrame:
    """Profiles as they arrive from sign-ups, merged into the profiles there are."""
    arriving = m.users.filter(F.col("status") == "active").select(
        F.col("id").alias("user_id"),
        F.lit("New").alias("first_name"),
        F.col("name").alias("last_name"),
        F.lit(None).cast("string").alias("phone"),
    )
    return tables.upsert(m.profiles, arriving, "user_id", ["first_name", "last_name"])


@query
def insert_missing_profiles(m: Marketplace) -> DataFrame:
    return tables.insert_missing(m.profiles, tables.default_profiles(m.users, "Test", "Driver", "0912345678"), "user_id")


# --- projections and filters ------------------------------------------------------------


@query
def completed_in_window(m: Marketplace) -> DataFrame:
    return reports.completed_in_window(m.bookings, START, END).select("id", "driver_id", "total_amount", "completed_at")


@query
def deposit_backfill(m: Marketplace) -> DataFrame:
    return tables.deposit_backfill(m.bookings).select("id", "status", "deposit_paid")


@query
def fill_defaults(m: Marketplace) -> DataFrame:
    return tables.fill_defaults(m.bookings).select(
        "id", "country", "service_type", "original_price", "final_price", "discount_amount"
    )


@query
def fill_service_types(m: Marketplace) -> DataFrame:
    filled = tables.fill_service_types(m.drivers)
    return filled.select("user_id", F.array_join("service_types", ",").alias("service_types"))


@query
def fill_commission_type(m: Marketplace) -> DataFrame:
    unset = m.influencers.withColumn("commission_type", F.nullif("commission_type", F.lit("by_service_type")))
    return tables.fill_commission_type(unset).select(F.col("id").alias("influencer_id"), "commission_type")


@query
def fee_repair(m: Marketplace) -> DataFrame:
    return split.fee_repair(m.bookings)


@query
def settings_set(m: Marketplace) -> DataFrame:
    return tables.settings_set(m.outbox.select("id", "payload"), "payload", {"currency": '"TWD"', "depositRate": "0.25"})


@query
def payload_fields(m: Marketplace) -> DataFrame:
    return cdc.payload_fields(_events(m))


@query
def status_mapping(m: Marketplace) -> DataFrame:
    return m.changes.select("id", "version", "status", app_status().alias("app_status"))


@query
def deposit_status_check(m: Marketplace) -> DataFrame:
    return payments.deposit_status_check(m.bookings)


@query
def apply_status_patches(m: Marketplace) -> DataFrame:
    patches = payments.booking_status_from_payments(m.payments).select(
        "id", "status", F.when(F.col("status") == "completed", F.col("confirmed_at")).alias("completed_at")
    )
    return tables.apply_status_patches(m.bookings.select("id", "status", "completed_at"), patches)


@query
def document_fields_long(m: Marketplace) -> DataFrame:
    events = cdc.booking_events(m.changes, _dimensions(m), superseded=False)
    return cdc.document_fields_long(cdc.project_bookings(events))


@query
def visible_rows(m: Marketplace) -> DataFrame:
    """Driver files open to change by the drivers in good standing."""
    drivers = m.users.filter((F.col("role") == "driver") & (F.col("status") == "active")).select("id", "role")
    return tables.visible_rows(m.driver_documents, "driver_id", drivers, "update")


@query
def visible_rows_admin(m: Marketplace) -> DataFrame:
    """Driver files that all users together may read: admins reach every file."""
    return tables.visible_rows(m.driver_documents, "driver_id", m.users.select("id", "role"), "read")


@query
def visible_rows_read(m: Marketplace) -> DataFrame:
    """Driver files that suspended drivers may still read."""
    drivers = m.users.filter((F.col("role") == "driver") & (F.col("status") == "suspended")).select("id", "role")
    return tables.visible_rows(m.driver_documents, "driver_id", drivers, "read")


# --- joins ------------------------------------------------------------------------------


@query
def driver_earnings_ranking_left(m: Marketplace) -> DataFrame:
    return reports.driver_earnings_ranking(m.bookings, m.users, START, END, how="left")


@query
def driver_earnings_ranking(m: Marketplace) -> DataFrame:
    return reports.driver_earnings_ranking(m.bookings, m.users, START, END)


@query
def driver_directory(m: Marketplace) -> DataFrame:
    return tables.driver_directory(m.users, m.profiles, m.drivers)


@query
def available_drivers(m: Marketplace) -> DataFrame:
    return tables.available_drivers(m.users, m.profiles, m.drivers)


@query
def profiles_of_drivers(m: Marketplace) -> DataFrame:
    return tables.profiles_of_drivers(m.profiles, m.users)


@query
def revenue_share_lookup(m: Marketplace) -> DataFrame:
    return split.revenue_share_lookup(m.bookings, m.rules)


@query
def revenue_share_fallback(m: Marketplace) -> DataFrame:
    return split.revenue_share_fallback(m.bookings, m.rules, m.settings)


@query
def commission_audit(m: Marketplace) -> DataFrame:
    return commission.commission_audit(m.usage, m.bookings)


@query
def referral_directory(m: Marketplace) -> DataFrame:
    return commission.referral_directory(m.referrals, m.influencers)


@query
def outbox_by_booking(m: Marketplace) -> DataFrame:
    return cdc.outbox_by_booking(m.outbox, m.bookings)


# --- aggregates -------------------------------------------------------------------------


def _driver_ids(m: Marketplace) -> DataFrame:
    return m.users.filter(F.col("role") == "driver").select(F.col("id").alias("driver_id"))


@query
def driver_earnings(m: Marketplace) -> DataFrame:
    return reports.driver_earnings(m.bookings, _driver_ids(m), START, END)


@query
def driver_earnings_daily(m: Marketplace) -> DataFrame:
    return reports.driver_earnings_daily(m.bookings, START, END)


@query
def driver_earnings_json(m: Marketplace) -> DataFrame:
    return reports.driver_earnings_json(m.bookings, _driver_ids(m), START, END)


@query
def platform_earnings(m: Marketplace) -> DataFrame:
    return reports.platform_earnings(m.bookings, START, END)


@query
def platform_earnings_daily(m: Marketplace) -> DataFrame:
    return reports.platform_earnings_daily(m.bookings, START, END)


@query
def platform_earnings_json(m: Marketplace) -> DataFrame:
    return reports.platform_earnings_json(m.bookings, START, END)


@query
def daily_earnings_summary(m: Marketplace) -> DataFrame:
    return reports.daily_earnings_summary(m.bookings, START, END)


@query
def drivers_earnings_page(m: Marketplace) -> DataFrame:
    return reports.drivers_earnings_page(m.bookings, m.users, START, END, page=2, limit=7)


@query
def drivers_earnings_page_by_orders(m: Marketplace) -> DataFrame:
    return reports.drivers_earnings_page(
        m.bookings, m.users, START, END, page=1, limit=15, sort_by="orders", sort_order="asc", how="left"
    )


@query
def drivers_earnings_summary(m: Marketplace) -> DataFrame:
    return reports.drivers_earnings_summary(m.bookings, START, END)


@query
def drivers_page_json(m: Marketplace) -> DataFrame:
    return reports.drivers_page_json(m.bookings, m.users, START, END, page=1, limit=5)


@query
def deposit_by_status(m: Marketplace) -> DataFrame:
    return reports.deposit_by_status(m.bookings)


@query
def fee_statistics(m: Marketplace) -> DataFrame:
    return reports.fee_statistics(m.bookings)


@query
def fee_correctness(m: Marketplace) -> DataFrame:
    return split.fee_correctness(m.bookings)


@query
def orders_by_status(m: Marketplace) -> DataFrame:
    return reports.orders_by_status(m.bookings)


@query
def influencer_referral_counts(m: Marketplace) -> DataFrame:
    return commission.influencer_referral_counts(m.influencers, m.referrals)


@query
def driver_referral_counts(m: Marketplace) -> DataFrame:
    """Referrals made, less those of drivers suspended since."""
    made = m.driver_referrals.select("referrer_driver_id", "referee_driver_id", F.lit("insert").alias("op"))
    suspended = m.users.filter(F.col("status") == "suspended").select(F.col("id").alias("referee_driver_id"))
    gone = made.join(suspended, "referee_driver_id", "left_semi").withColumn("op", F.lit("delete"))
    return commission.driver_referral_counts(m.driver_affiliates, made.unionByName(gone))


def _accrued(m: Marketplace) -> DataFrame:
    return m.usage.filter(F.col("commission_status") == "completed").select("booking_id")


def _affiliate_ledger(m: Marketplace, attribution: str = "first_referrer") -> DataFrame:
    return commission.affiliate_commission(m.changes, m.referrals, m.influencers, _accrued(m), attribution)


@query
def influencer_total_earnings(m: Marketplace) -> DataFrame:
    influencers = m.influencers.select(F.col("id").alias("influencer_id"))
    return commission.beneficiary_totals(_affiliate_ledger(m), influencers, "influencer_id")


def _referral_commissions(m: Marketplace) -> DataFrame:
    columns = ["driver_id", "country", "service_type", "promo_code", "influencer_id", "total_amount"]
    completed = commission.first_completions(m.changes, columns)
    rows = split.split_bookings(completed, m.rules, m.settings, m.influencers)
    return commission.driver_referral_commission(rows, m.driver_referrals, m.driver_affiliates, keys_from=m.changes)


@query
def driver_affiliate_earnings(m: Marketplace) -> DataFrame:
    ledger = commission.referral_ledger(_referral_commissions(m))
    return commission.beneficiary_totals(ledger, m.driver_affiliates, "driver_id")


@query
def outbox_backlog(m: Marketplace) -> DataFrame:
    return cdc.outbox_backlog(m.outbox, AS_OF)


@query
def driver_completeness_counts(m: Marketplace) -> DataFrame:
    return quality.driver_completeness_counts(m.users, m.profiles, m.drivers)


@query
def dimension_fill(m: Marketplace) -> DataFrame:
    return reports.dimension_fill(m.bookings)


@query
def daily_summary_json(m: Marketplace) -> DataFrame:
    return reports.daily_summary_json(m.bookings, START, END)


# --- latest rows, edges, top rows -------------------------------------------------------


@query
def latest_event(m: Marketplace) -> DataFrame:
    return cdc.latest_event(m.outbox.select("id", "aggregate_id", "event_type", "amount", "created_at"))


@query
def completion_edges(m: Marketplace) -> DataFrame:
    return commission.completion_edges(m.changes)


@query
def recent_events(m: Marketplace) -> DataFrame:
    rows = m.outbox.select("id", "aggregate_id", "event_type", "created_at", "processed_at")
    newest = reports.recent(rows, "processed_at", "id", 10)
    return newest.withColumn("delay_seconds", seconds_between("created_at", "processed_at"))


# --- ledger -----------------------------------------------------------------------------


@query
def financial_split_legacy(m: Marketplace) -> DataFrame:
    return split.financial_split_legacy(m.bookings)


@query
def financial_split_settings(m: Marketplace) -> DataFrame:
    return split.financial_split_settings(m.bookings, m.settings, m.influencers)


@query
def financial_split(m: Marketplace) -> DataFrame:
    return split.financial_split(m.bookings, m.rules, m.settings, m.influencers)


@query
def influencer_commission(m: Marketplace) -> DataFrame:
    return split.influencer_commission(m.bookings, m.influencers)


@query
def platform_fee_net(m: Marketplace) -> DataFrame:
    rows = split.split_bookings(m.bookings.select(*split.SPLIT_INPUT), m.rules, m.settings, m.influencers)
    return split.platform_fee_net(rows)


@query
def affiliate_commission(m: Marketplace) -> DataFrame:
    return _affiliate_ledger(m)


@query
def affiliate_usage_upsert(m: Marketplace) -> DataFrame:
    accruals = commission.affiliate_accruals(m.changes, m.referrals, m.influencers)
    return commission.affiliate_usage_upsert(m.usage.drop("used_at"), accruals)


@query
def affiliate_usage_settle(m: Marketplace) -> DataFrame:
    accruals = commission.affiliate_accruals(m.changes, m.referrals, m.influencers)
    return commission.affiliate_usage_upsert(m.usage.drop("used_at"), accruals, "completed", insert=False)


@query
def commission_by_code_owner(m: Marketplace) -> DataFrame:
    return _affiliate_ledger(m, "code_owner")


@query
def driver_referral_commission(m: Marketplace) -> DataFrame:
    return _referral_commissions(m)


@query
def referral_binding(m: Marketplace) -> DataFrame:
    return commission.referral_binding(m.referral_claims)


@query
def completed_at_resolution(m: Marketplace) -> DataFrame:
    return commission.completed_at_resolution(m.changes.withColumn("completed_at", F.lit(None).cast("timestamp_ntz")))


@query
def completed_at_kept(m: Marketplace) -> DataFrame:
    """The same where some changes bring the time along; only edges set it anew."""
    known = F.when(F.col("duration_hours") % 2 == 0, F.col("completed_at"))
    return commission.completed_at_resolution(m.changes.withColumn("completed_at", known))


@query
def commission_decision_log(m: Marketplace) -> DataFrame:
    return commission.commission_decision_log(m.changes, m.referrals, m.influencers, _accrued(m))


# --- payments ---------------------------------------------------------------------------


@query
def payment_intents_accepted(m: Marketplace) -> DataFrame:
    return payments.payment_intents_accepted(m.payment_requests, m.bookings, m.payments)


@query
def payment_confirm_outcome(m: Marketplace) -> DataFrame:
    return payments.payment_confirm_outcome(m.confirmations, m.payments)


@query
def webhook_outcomes(m: Marketplace) -> DataFrame:
    return payments.webhook_outcomes(m.webhooks, m.payments)


@query
def payment_latest_status(m: Marketplace) -> DataFrame:
    return payments.payment_latest_status(m.webhooks, m.payments)


@query
def booking_status_from_payments(m: Marketplace) -> DataFrame:
    return payments.booking_status_from_payments(m.payments)


@query
def payments_expired(m: Marketplace) -> DataFrame:
    return payments.payments_expired(m.payments, PAYMENTS_AS_OF)


# --- streams ----------------------------------------------------------------------------


@query
def dead_letters(m: Marketplace) -> DataFrame:
    return cdc.dead_letters(m.outbox.drop("processed_at", "retry_count"), _state(m))


@query
def delivery_state_next(m: Marketplace) -> DataFrame:
    """Delivery state after a round over all undelivered events."""
    state = _state(m).withColumn("last_error", F.lit(None).cast("string"))
    due = cdc.pending_events(m.outbox, _state(m)).select(F.col("id").alias("event_id"))
    outcomes = cdc.delivery_outcome(m.delivery_attempts).join(due, "event_id", "left_semi")
    return cdc.next_delivery_state(state, outcomes, AS_OF)


@query
def sync_latency(m: Marketplace) -> DataFrame:
    return cdc.sync_latency(m.outbox)


@query
def stream_projection(m: Marketplace) -> DataFrame:
    live = StreamingMarketplace(m.spark, m.directory, "orders")
    path = work_path(m.spark, "projection")
    jobs.write_projection(live.changes, _dimensions(m), f"{path}/out", f"{path}/checkpoint").awaitTermination()
    held = [
        _flat_points(sinks.current(m.spark, f"{path}/out/{name}", "id", ["event_at", "version"])).withColumn("collection", F.lit(name))
        for name in sinks.COLLECTIONS
    ]
    return held[0].unionByName(held[1]).drop("version")


@query
def stream_completion_edges(m: Marketplace) -> DataFrame:
    live = StreamingMarketplace(m.spark, m.directory, "orders")
    path = work_path(m.spark, "edges")
    edges = jobs.completion_edges_stream(live.changes)
    jobs.append_to(edges, f"{path}/out", f"{path}/checkpoint").awaitTermination()
    return m.spark.read.parquet(f"{path}/out").withColumn("changed_at", F.col("changed_at").cast("timestamp_ntz"))


@query
def stream_payment_ingest(m: Marketplace) -> DataFrame:
    """Webhooks split on arrival, counted by folder and status."""
    live = StreamingMarketplace(m.spark, m.directory, "events")
    path = work_path(m.spark, "ingest")
    jobs.write_validated(live.webhooks, payments.validate_webhooks, f"{path}/out", f"{path}/checkpoint").awaitTermination()
    folders = [
        sinks.read_batches(m.spark, f"{path}/out/{name}").select(F.lit(name).alias("folder"), "status")
        for name in ("good", "quarantine")
    ]
    return folders[0].unionByName(folders[1]).groupBy("folder", "status").agg(F.count(F.lit(1)).alias("n_webhooks"))


@query
def stream_dedup(m: Marketplace) -> DataFrame:
    """The event log delivered twice, each event kept once."""
    twice = m.outbox.select("id", "aggregate_id", "event_type", "created_at", F.explode(F.array(F.lit(1), F.lit(2))).alias("n"))
    path = work_path(m.spark, "dedup")
    log = jobs.arrivals(twice, f"{path}/in")
    jobs.append_to(jobs.dedup_stream(log.drop("n"), "id"), f"{path}/out", f"{path}/checkpoint").awaitTermination()
    return m.spark.read.parquet(f"{path}/out")


@query
def stream_expiry(m: Marketplace) -> DataFrame:
    live = StreamingMarketplace(m.spark, m.directory, "orders")
    path = work_path(m.spark, "expiry")
    expired = jobs.expiry_stream(live.payments.withColumn("status_at", F.col("created_at")))
    jobs.append_to(expired, f"{path}/out", f"{path}/checkpoint").awaitTermination()
    return m.spark.read.parquet(f"{path}/out").drop("created_at")


@query
def stream_daily_earnings(m: Marketplace) -> DataFrame:
    live = StreamingMarketplace(m.spark, m.directory, "orders")
    path = work_path(m.spark, "daily")
    totals = jobs.daily_earnings_stream(live.bookings)
    jobs.write_running_totals(totals, f"{path}/out", f"{path}/checkpoint").awaitTermination()
    return sinks.latest_totals(m.spark, f"{path}/out", "date")


def _event_log(m: Marketplace) -> DataFrame:
    """Bookings, their deletions, chat messages and events of unknown kind as one log."""
    chat = m.chat_events
    gone = F.col("event_type") == "deleted"
    booking = F.struct(
        F.replace("booking_id", F.lit("B"), F.lit("uid-c")).alias("customerId"), F.replace("booking_id", F.lit("B"), F.lit("uid-d")).alias("driverId"),
        F.concat(F.lit("Stop "), "booking_id").alias("pickupAddress"), F.date_format("message_at", "yyyy-MM-dd'T'00:00:00").alias("bookingTime"),
    )
    said = F.struct(
        F.col("message_id").alias("id"), F.col("booking_id").alias("bookingId"), F.col("sender_id").alias("senderId"), F.col("receiver_id").alias("receiverId"),
        F.col("sender_name").alias("senderName"), F.col("message_text").alias("messageText"), F.col("translated_text").alias("translatedText"),
        F.col("message_at").cast("string").alias("createdAt"), F.col("read_at").cast("string").alias("readAt"), booking.alias("bookingData"),
    )
    withdrawn = F.struct(F.col("message_id").alias("id"), F.col("booking_id").alias("bookingId"))
    messages = chat.select(
        F.concat_ws("-", "message_id", F.col("seq").cast("string")).alias("id"), F.lit("chat_message").alias("aggregate_type"),
        F.col("message_id").alias("aggregate_id"), "event_type", F.when(gone, F.to_json(withdrawn)).otherwise(F.to_json(said)).alias("payload"), "created_at",
    )
    other = m.outbox.filter(F.col("aggregate_type") == "other").select(*messages.columns)
    return _log_with_deletes(m).unionByName(messages).unionByName(other)


@query
def stream_event_log(m: Marketplace) -> DataFrame:
    """The whole event log, out of order and some of it twice, in its five sinks."""
    path = work_path(m.spark, "event-log")
    twice = F.explode(F.when(F.crc32(F.col("id").cast("binary")) % 5 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    log = jobs.arrivals(_event_log(m).withColumn("n", twice), f"{path}/in", by=["id", "n"], shuffled=False).drop("n")
    event_log.write_event_log(log, f"{path}/out", f"{path}/checkpoint").awaitTermination()
    held = {name: _flat_points(event_log.documents(m.spark, f"{path}/out", name)) for name in sinks.COLLECTIONS}
    held |= {event_log.MESSAGES: event_log.messages(m.spark, f"{path}/out"), event_log.ROOMS: event_log.rooms(m.spark, f"{path}/out")}
    held |= {event_log.PARKED: event_log.parked(m.spark, f"{path}/out")}
    every = [rows.withColumn("sink", F.lit(name)) for name, rows in held.items()]
    found = every[0]
    for rows in every[1:]:
        found = found.unionByName(rows, allowMissingColumns=True)
    return found


@query
def stream_delivery(m: Marketplace) -> DataFrame:
    """Delivery state and parked events after four rounds whose answers arrive in any order."""
    path = work_path(m.spark, "delivery")
    inputs = delivery.delivery_inputs(m.outbox.select("id", "aggregate_type"), m.delivery_answers)
    changes = delivery.delivery_changes(jobs.arrivals(inputs, f"{path}/in"))
    delivery.write_delivery(changes, f"{path}/out", f"{path}/checkpoint").awaitTermination()
    parked = delivery.parked_events(m.spark, f"{path}/out")
    return delivery.delivery_state(m.spark, f"{path}/out").join(parked, "event_id", "left")


@query
def stream_edges_any_order(m: Marketplace) -> DataFrame:
    path = work_path(m.spark, "edges")
    log = jobs.arrivals(m.changes.select("id", "version", "status", "changed_at"), f"{path}/in")
    jobs.append_changes(history.edge_changes(log), f"{path}/out", f"{path}/checkpoint").awaitTermination()
    return history.current_edges(m.spark, f"{path}/out")


@query
def stream_expiry_corrected(m: Marketplace) -> DataFrame:
    """Payments that are over and still open, whatever order their states arrive in."""
    path = work_path(m.spark, "expiry")
    states = jobs.arrivals(m.payment_states, f"{path}/in")
    jobs.append_changes(expiry.expiry_changes(states), f"{path}/out", f"{path}/checkpoint").awaitTermination()
    return expiry.expired_now(m.spark, f"{path}/out")


def _rollup(m: Marketplace) -> DataFrame:
    path = work_path(m.spark, "rollup")
    log = m.changes_with_deletes.select(
        "id", "version", "op", "status", "completed_at", "driver_id", "driver_earning", "platform_fee", "total_amount"
    )
    shares = rollup.share_changes(jobs.arrivals(log, f"{path}/in"))
    rollup.write_rollup(shares, f"{path}/out", f"{path}/checkpoint").awaitTermination()
    return rollup.rollup(m.spark, f"{path}/out", START, END)


@query
def stream_driver_earnings(m: Marketplace) -> DataFrame:
    return rollup.driver_earnings(_rollup(m), m.users.filter("role = 'driver'").select(F.col("id").alias("driver_id")))


@query
def stream_platform_earnings(m: Marketplace) -> DataFrame:
    return rollup.platform_earnings(_rollup(m))


@query
def stream_daily_summary(m: Marketplace) -> DataFrame:
    return rollup.daily_summary(_rollup(m))


def _commission_stream(m: Marketplace) -> str:
    path = work_path(m.spark, "commissions")
    terms = commissions.Terms(m.referrals, m.influencers, m.rules, m.settings, m.driver_referrals, m.driver_affiliates, _accrued(m))
    log = jobs.arrivals(m.changes.select("id", "version", "status", "changed_at", *commissions.COLUMNS), f"{path}/in")
    commissions.write_commissions(log, terms, f"{path}/out", f"{path}/checkpoint").awaitTermination()
    return f"{path}/out"


@query
def stream_commissions(m: Marketplace) -> DataFrame:
    return commissions.ledger(m.spark, _commission_stream(m))


@query
def stream_commission_totals(m: Marketplace) -> DataFrame:
    return commissions.totals(m.spark, _commission_stream(m))


# --- quality ----------------------------------------------------------------------------


@query
def constraint_violations(m: Marketplace) -> DataFrame:
    return (
        quality.constraint_violations("bookings", m.bookings, quality.booking_constraints())
        .unionByName(quality.constraint_violations("revenue_rules", m.rules, quality.rule_constraints()))
        .unionByName(quality.constraint_violations("drivers", m.drivers, quality.driver_constraints()))
    )


@query
def duplicate_keys(m: Marketplace) -> DataFrame:
    live_documents = m.driver_documents.filter(F.col("status") != "rejected")
    return (
        quality.duplicate_keys("one referrer per referee", m.referral_claims, ["referee_id"])
        .unionByName(quality.duplicate_keys("one live document per type", live_documents, ["driver_id", "type"]))
        .unionByName(quality.duplicate_keys("one bank account per driver", m.bank_accounts, ["driver_id"]))
        .unionByName(quality.duplicate_keys("one referrer per driver", m.driver_referrals, ["referee_driver_id"]))
        .unionByName(
            quality.duplicate_keys(
                "one active rule per key",
                m.rules.filter("is_active"),
                ["country", "region", "service_type", "has_promo_code"],
            )
        )
    )


@query
def orphan_rows(m: Marketplace) -> DataFrame:
    return quality.orphan_rows("booking without driver record", m.bookings, "driver_id", m.drivers, "user_id").unionByName(
        quality.orphan_rows("event without booking", m.outbox, "aggregate_id", m.bookings.filter(F.col("status") != "cancelled"), "id")
    )


@query
def driver_completeness(m: Marketplace) -> DataFrame:
    return quality.driver_completeness(m.users, m.profiles, m.drivers)


@query
def document_compliance(m: Marketplace) -> DataFrame:
    return quality.document_compliance(m.drivers, m.driver_documents, tables.offers(INSTANT_SERVICE))


@query
def available_for_instant_rides(m: Marketplace) -> DataFrame:
    return tables.available_drivers(m.users, m.profiles, m.drivers, INSTANT_SERVICE)


@query
def documents_unpivot(m: Marketplace) -> DataFrame:
    return quality.wide_to_long(m.driver_documents_wide, "driver_id", WIDE_DOCUMENT_COLUMNS, "type")


@query
def documents_pivot(m: Marketplace) -> DataFrame:
    """The current documents of the long table, under the wide table's columns."""
    return quality.long_to_wide(quality.current_documents(m.driver_documents), "driver_id", WIDE_DOCUMENT_COLUMNS, "type")


@query
def photos_unpivot(m: Marketplace) -> DataFrame:
    return quality.wide_to_long(m.driver_photos_wide, "driver_id", WIDE_PHOTO_COLUMNS, "photo_type")


@query
def photos_pivot(m: Marketplace) -> DataFrame:
    long = quality.wide_to_long(m.driver_photos_wide, "driver_id", WIDE_PHOTO_COLUMNS, "photo_type")
    return quality.long_to_wide(long, "driver_id", WIDE_PHOTO_COLUMNS, "photo_type")


@query
def payload_completeness(m: Marketplace) -> DataFrame:
    return cdc.payload_completeness(_events(m), ("depositPaid", "driverId", "driverName", "promoCode", "completedAt"))


@query
def stuck_matched_orders(m: Marketplace) -> DataFrame:
    return quality.stuck_matched_orders(m.bookings)


@query
def settings_drift(m: Marketplace) -> DataFrame:
    return tables.settings_drift(m.outbox, "payload", "id", {"k": "42", "currency": "TWD"})


@query
def fee_anomalies(m: Marketplace) -> DataFrame:
    return quality.fee_anomalies(_referral_commissions(m))


@query
def split_residual(m: Marketplace) -> DataFrame:
    rows = split.split_bookings(m.bookings.select(*split.SPLIT_INPUT), m.rules, m.settings, m.influencers)
    return quality.split_residual(rows)


@query
def missing_commissions(m: Marketplace) -> DataFrame:
    paid = _affiliate_ledger(m).select("booking_id").unionByName(_accrued(m))
    return commission.missing_commissions(m.changes, m.referrals, paid)
