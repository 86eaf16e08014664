"""Payment lifecycle: requests, confirmations, webhooks, and their effect on bookings."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom.functions.columns import instant, natural_id
from fareloom.operators.joins import lookup, newest, oldest, previous_value
from fareloom.schemas import (
    BOOKING_STATUS_BY_PAYMENT,
    CONFIRMABLE_STATUSES,
    PAYMENT_MINUTES,
    PAYMENT_STATUSES,
    PAYMENT_TYPES,
)

# --- validation -------------------------------------------------------------------------


def _missing(column: str) -> Column:
    return F.coalesce(F.col(column) == "", F.lit(True))


def _not_positive(column: str) -> Column:
    return F.coalesce(F.col(column) <= 0, F.lit(True))


def _not_in(column: str, allowed: Sequence[str]) -> Column:
    return ~F.coalesce(F.col(column).isin(*allowed), F.lit(False))


def _with_errors(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    codes = F.array_compact(F.array(*(F.when(broken, F.lit(code)) for code, broken in rules.items())))
    return df.withColumn("errors", codes).withColumn("is_valid", F.size("errors") == 0)


def validate_intents(requests: DataFrame) -> DataFrame:
    """Payment requests with the codes of the rules they break; valid ones have none."""
    return _with_errors(
        requests,
        {
            "booking_id": _missing("booking_id"),
            "customer_id": _missing("customer_id"),
            "amount": _not_positive("amount"),
            "currency": _missing("currency"),
            "payment_type": _not_in("payment_type", PAYMENT_TYPES),
        },
    )


def validate_webhooks(webhooks: DataFrame) -> DataFrame:
    return _with_errors(
        webhooks,
        {
            "transaction_id": _missing("transaction_id"),
            "external_transaction_id": _missing("external_transaction_id"),
            "status": _not_in("status", PAYMENT_STATUSES),
            "amount": _not_positive("amount"),
            "currency": _missing("currency"),
            "sent_at": F.col("sent_at").isNull(),
        },
    )


def split_valid(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantined rows)."""
    good = validated.filter("is_valid").drop("errors", "is_valid")
    return good, validated.filter(~F.col("is_valid")).drop("is_valid")


# --- intents ----------------------------------------------------------------------------


def payment_intents_accepted(requests: DataFrame, bookings: DataFrame, payments: DataFrame) -> DataFrame:
    """New pending payments from valid requests, the first per (booking, type) of the batch.

    The booking must exist and must not have a completed payment of the type. Requests are
    reduced to one per (booking, type) before any join, so a booking with very many of them
    reaches the joins as one row per type.
    """
    valid = validate_intents(requests).filter("is_valid").drop("errors", "is_valid")
    first = oldest(valid, ["booking_id", "payment_type"], ["requested_at", "request_id"])
    paid = payments.filter(F.col("status") == "completed").select("booking_id", F.col("type").alias("payment_type")).distinct()
    accepted = first.join(bookings.select(F.col("id").alias("booking_id")), "booking_id", "left_semi").join(
        paid, ["booking_id", "payment_type"], "left_anti"
    )
    return accepted.select(
        natural_id("booking_id", "payment_type", "request_id").alias("transaction_id"),
        "request_id",
        "booking_id",
        "customer_id",
        F.col("payment_type").alias("type"),
        "amount",
        "currency",
        F.lit("pending").alias("status"),
        (F.col("requested_at") + F.expr(f"INTERVAL {PAYMENT_MINUTES} MINUTES")).alias("expires_at"),
    )


# --- confirmations ----------------------------------------------------------------------


def payment_confirm_outcome(
    confirmations: DataFrame,
    payments: DataFrame,
    allowed: Sequence[str] = CONFIRMABLE_STATUSES,
    limit: int | None = None,
) -> DataFrame:
    """What each confirm request leads to.

    ``missing``, ``already_completed``, ``not_allowed``, ``expired`` or ``completed``. Of
    several requests for one payment the first decides; once it completes the payment, the
    later ones find it completed.
    """
    first = confirmations.groupBy("transaction_id").agg(
        F.min(F.struct("requested_at", "request_id")).alias("_first")
    )
    state = payments.select(
        "transaction_id", "booking_id", F.col("type").alias("payment_type"), F.struct("status", "expires_at").alias("_p")
    )
    # one row per transaction on both sides; only then are the requests, which may pile up on one, looked up
    known = state.join(first, "transaction_id")
    rows = lookup(confirmations, known, "transaction_id", limit=limit)
    status, expires = F.col("_p.status"), F.col("_p.expires_at")
    opens = status.isin(*allowed)
    first_at = F.col("_first.requested_at")
    expired_first = expires.isNotNull() & (first_at > expires)
    is_first = F.col("_first.request_id") == F.col("request_id")
    outcome = (
        F.when(F.col("_p").isNull(), "missing")
        .when(status == "completed", "already_completed")
        .when(status == "expired", "expired")
        .when(~opens, "not_allowed")
        .when(expired_first, "expired")
        .when(is_first, "completed")
        .otherwise("already_completed")
    )
    return rows.select(
        "request_id",
        "transaction_id",
        "booking_id",
        "payment_type",
        outcome.alias("outcome"),
        outcome.isin("completed", "already_completed").alias("success"),
        F.when(outcome == "completed", F.col("requested_at")).alias("confirmed_at"),
    )


# --- webhooks ---------------------------------------------------------------------------


def webhook_outcomes(webhooks: DataFrame, payments: DataFrame, limit: int | None = None) -> DataFrame:
    """Per valid webhook: rejected (unknown payment), no-op (same status) or applied.

    Webhooks apply in the order they were sent, starting from the payment's own status. A
    payment's webhooks are windowed minute by minute, so a flood on one transaction spreads.
    """
    good = validate_webhooks(webhooks).filter("is_valid").drop("errors", "is_valid")
    state = payments.select("transaction_id", "booking_id", F.col("type").alias("payment_type"), F.col("status").alias("_initial"))
    known = lookup(good, state, "transaction_id", limit=limit, keys_from=webhooks)
    minute = F.date_trunc("minute", "sent_at")
    rows = previous_value(known, "transaction_id", ["sent_at", "webhook_id"], "status", minute, "_before", keys_from=webhooks)
    before = F.coalesce(F.col("_before.value"), F.col("_initial"))
    outcome = F.when(F.col("_initial").isNull(), "rejected").when(F.col("status") == before, "no_op").otherwise("applied")
    return rows.select(
        "webhook_id", "transaction_id", "booking_id", "payment_type", "status", "sent_at", outcome.alias("outcome")
    )


def payment_latest_status(webhooks: DataFrame, payments: DataFrame, limit: int | None = None) -> DataFrame:
    """Status of every payment after its webhooks, and when it was last confirmed."""
    applied = F.col("outcome") == "applied"
    effect = (
        webhook_outcomes(webhooks, payments, limit)
        .filter(F.col("outcome") != "rejected")
        .groupBy("transaction_id")
        .agg(
            F.max_by("status", F.struct("sent_at", "webhook_id")).alias("_status"),
            F.max(F.when(applied & (F.col("status") == "completed"), F.col("sent_at"))).alias("_confirmed_at"),
            F.count_if(applied).alias("n_applied"),
            F.count_if(~applied).alias("n_no_op"),
        )
    )
    return payments.join(effect, "transaction_id", "left").select(
        "transaction_id",
        "booking_id",
        "type",
        F.coalesce("_status", "status").alias("status"),
        F.coalesce("_confirmed_at", "confirmed_at").alias("confirmed_at"),
        F.coalesce("n_applied", F.lit(0)).alias("n_applied"),
        F.coalesce("n_no_op", F.lit(0)).alias("n_no_op"),
    )


# --- effects ----------------------------------------------------------------------------


def booking_status_from_payments(payments: DataFrame) -> DataFrame:
    """Status patch per booking from its completed payments; the last one that changes a status wins."""
    status = F.lit(None).cast("string")
    for kind, effect in BOOKING_STATUS_BY_PAYMENT.items():
        status = F.when(F.col("type") == kind, effect).otherwise(status)
    effects = (
        payments.filter(F.col("status") == "completed")
        .withColumn("_new", status)
        .filter(F.col("_new").isNotNull())
        .select(F.col("booking_id").alias("id"), F.col("_new").alias("status"), "confirmed_at", "transaction_id")
    )
    return newest(effects, "id", ["confirmed_at", "transaction_id"])


def payments_expired(payments: DataFrame, as_of: dt.datetime | str) -> DataFrame:
    """Open payments past their expiry."""
    return payments.filter(
        F.col("status").isin(*CONFIRMABLE_STATUSES) & (F.col("expires_at") < instant(payments, "expires_at", as_of))
    ).select("transaction_id", "booking_id", F.col("status").alias("old_status"), F.lit("expired").alias("status"), "expires_at")


def deposit_status_check(bookings: DataFrame) -> DataFrame:
    """Bookings by whether deposit flag and status agree, and by how far the driver got."""
    paid, status = F.col("deposit_paid"), F.col("status")
    check = (
        F.when(paid & (status == "paid_deposit"), "deposit_paid")
        .when(~paid & (status == "pending_payment"), "awaiting_deposit")
        .otherwise("inconsistent")
    )
    stage = (
        F.when(F.col("driver_id").isNull(), "no_driver")
        .when(status == "matched", "awaiting_driver_confirmation")
        .when(status == "driver_confirmed", "driver_confirmed")
        .otherwise("other")
    )
    return bookings.groupBy("status", check.alias("deposit_check"), stage.alias("driver_stage")).agg(
        F.count(F.lit(1)).alias("n_bookings")
    )
