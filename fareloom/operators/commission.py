"""Completion edges and the commissions they trigger, as ledger rows.

A commission is a row keyed by booking, not a running total: replaying the change log gives
the same ledger, and totals are sums over it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom.functions.columns import percent_of, service_of, zero_if_null
from fareloom.operators.joins import lookup, newest, oldest, previous_value
from fareloom.schemas import MONEY, RATE, TOTAL

# versions per window slice of one booking; bounds the rows a task sorts for one booking
VERSIONS_PER_SLICE = 4096


# --- edges ------------------------------------------------------------------------------


def with_edges(changes: DataFrame, slice_size: int = VERSIONS_PER_SLICE) -> DataFrame:
    """Change rows with ``previous_status``, ``is_insert`` and ``is_edge`` (now completed, not before)."""
    part = F.floor(F.col("version") / slice_size)
    rows = previous_value(changes, "id", ["version"], "status", part, "_before")
    before = F.col("_before.value")
    return (
        rows.withColumn("previous_status", before)
        .withColumn("is_insert", F.col("_before").isNull())
        .withColumn("is_edge", (F.col("status") == "completed") & (before.isNull() | (before != "completed")))
        .drop("_before")
    )


def newest_changes(changes: DataFrame) -> DataFrame:
    """The last version of each booking."""
    return newest(changes, "id", ["version"])


def completion_edges(changes: DataFrame, slice_size: int = VERSIONS_PER_SLICE) -> DataFrame:
    """Changes at which a booking becomes completed, also at creation and on completion after reopening."""
    return (
        with_edges(changes.select("id", "version", "status", "changed_at"), slice_size)
        .filter(F.col("is_edge"))
        .select(F.col("id").alias("booking_id"), "version", "previous_status", "is_insert", "changed_at")
    )


def completed_at_resolution(changes: DataFrame, slice_size: int = VERSIONS_PER_SLICE) -> DataFrame:
    """Completion time after each change: the change's time on an edge, else what was known, else the trip's end."""
    rows = changes.select("id", "version", "status", "changed_at", "completed_at", "actual_end_time")
    resolved = F.when(F.col("is_edge"), F.col("changed_at")).otherwise(F.coalesce("completed_at", "actual_end_time"))
    return with_edges(rows, slice_size).select(
        F.col("id").alias("booking_id"), "version", "status", resolved.alias("completed_at")
    )


# --- referral binding -------------------------------------------------------------------


def referral_binding(claims: DataFrame) -> DataFrame:
    """One referrer per referee for life: the earliest claim wins, nobody refers themselves."""
    valid = claims.filter(F.col("referrer_id") != F.col("referee_id"))
    return oldest(valid, "referee_id", ["created_at", "claim_id"])


# --- customer affiliates ----------------------------------------------------------------

AFFILIATE_INPUT = ("id", "version", "status", "changed_at", "customer_id", "influencer_id", "promo_code", "total_amount")


def _affiliate_outcome(
    rows: DataFrame,
    changes: DataFrame,
    referrals: DataFrame,
    influencers: DataFrame,
    attribution: str,
    limit: int | None,
) -> DataFrame:
    """Attach the beneficiary and the commission to rows of ``changes`` that carry edge flags."""
    if attribution == "first_referrer":
        # the rider's referrer for life
        bound = referrals.select(
            F.col("referee_id").alias("customer_id"),
            F.col("influencer_id").alias("_owner"),
            F.col("promo_code").alias("_code"),
        )
        rows = lookup(rows, bound, "customer_id", limit=limit, keys_from=changes)
        owners = lookup(changes.select("customer_id"), bound, "customer_id", limit=limit, keys_from=changes)
    elif attribution == "code_owner":
        # the owner of the code used on this very booking
        rows = rows.withColumn("_owner", F.col("influencer_id")).withColumn("_code", F.col("promo_code"))
        owners = changes.select(F.col("influencer_id").alias("_owner"))
    else:
        raise ValueError(f"unknown attribution {attribution!r}")
    active = influencers.filter(F.col("is_active")).select(
        F.col("id").alias("_owner"),
        F.struct(
            "commission_fixed", "commission_percent", "is_commission_fixed_active", "is_commission_percent_active"
        ).alias("_i"),
    )
    rows = lookup(rows, active, "_owner", limit=limit, keys_from=owners)
    fixed = F.coalesce(F.col("_i.is_commission_fixed_active"), F.lit(False))
    percent = F.coalesce(F.col("_i.is_commission_percent_active"), F.lit(False)) & ~fixed
    rate = F.when(percent, F.col("_i.commission_percent").cast(RATE))
    amount = F.when(fixed, F.col("_i.commission_fixed").cast(MONEY)).when(
        percent, percent_of("total_amount", F.col("_i.commission_percent").cast(RATE))
    )
    return (
        rows.withColumn("type", F.when(fixed, "fixed").when(percent, "percent"))
        .withColumn("rate", rate)
        .withColumn("amount", amount)
        .withColumn("_active", F.col("_i").isNotNull())
        .drop("_i")
    )


def affiliate_accruals(
    changes: DataFrame,
    referrals: DataFrame,
    influencers: DataFrame,
    accrued: DataFrame | None = None,
    attribution: str = "first_referrer",
    slice_size: int = VERSIONS_PER_SLICE,
    limit: int | None = None,
) -> DataFrame:
    """Ledger rows of ``affiliate_commission`` with the rider and the code they are due to."""
    rows = with_edges(changes.select(*AFFILIATE_INPUT), slice_size)
    edges = rows.filter(F.col("is_edge") & ~F.col("is_insert"))
    first = oldest(edges, "id", ["version"])
    if accrued is not None:
        first = first.join(accrued.select(F.col("booking_id").alias("id")).distinct(), "id", "left_anti")
    return affiliate_ledger(first, changes, referrals, influencers, attribution, limit)


def affiliate_ledger(
    edges: DataFrame,
    changes: DataFrame,
    referrals: DataFrame,
    influencers: DataFrame,
    attribution: str = "first_referrer",
    limit: int | None = None,
) -> DataFrame:
    """Ledger rows of the edges that are paid for, one per booking; ``changes`` is what they come from."""
    outcome = _affiliate_outcome(edges, changes, referrals, influencers, attribution, limit)
    return outcome.filter(F.col("type").isNotNull()).select(
        F.col("id").alias("booking_id"),
        F.lit("affiliate").alias("scheme"),
        F.col("_owner").alias("beneficiary_id"),
        F.col("total_amount").alias("base_amount"),
        "rate",
        "type",
        "amount",
        F.lit("accrued").alias("reason_code"),
        F.col("changed_at").alias("accrued_at"),
        "customer_id",
        F.col("_code").alias("code"),
    )


def affiliate_commission(
    changes: DataFrame,
    referrals: DataFrame,
    influencers: DataFrame,
    accrued: DataFrame | None = None,
    attribution: str = "first_referrer",
    slice_size: int = VERSIONS_PER_SLICE,
    limit: int | None = None,
) -> DataFrame:
    """Ledger rows for the riders' referrers, one per booking, from its first completion by update.

    A booking created as completed earns nothing: the rule runs on updates only. ``accrued``
    (column ``booking_id``) names bookings already in the ledger.
    """
    rows = affiliate_accruals(changes, referrals, influencers, accrued, attribution, slice_size, limit)
    return rows.drop("customer_id", "code")


def commission_decision_log(
    changes: DataFrame,
    referrals: DataFrame,
    influencers: DataFrame,
    accrued: DataFrame | None = None,
    slice_size: int = VERSIONS_PER_SLICE,
    limit: int | None = None,
) -> DataFrame:
    """Why each update of a booking did or did not earn a commission, one reason per update.

    ``duplicate``: an earlier completion, or ``accrued`` (column ``booking_id``), has it already.
    Only edges can earn, so only they meet the referrals; all other updates are ``not_completed``.
    """
    rows = with_edges(changes.select(*AFFILIATE_INPUT), slice_size).filter(~F.col("is_insert"))
    is_edge = F.coalesce("is_edge", F.lit(False))
    first = rows.filter(is_edge).groupBy("id").agg(F.min("version").alias("_first"))
    if accrued is not None:
        done = accrued.select(F.col("booking_id").alias("id")).distinct().withColumn("_done", F.lit(True))
        first = first.join(done, "id", "left")
    else:
        first = first.withColumn("_done", F.lit(None).cast("boolean"))
    # one pass over all updates: those that are no edges go through the lookups without a key
    rows = rows.withColumn("customer_id", F.when(is_edge, F.col("customer_id")))
    marked = lookup(rows, first, "id", limit=limit, keys_from=changes)
    outcome = _affiliate_outcome(marked, changes, referrals, influencers, "first_referrer", limit)
    reason = (
        F.when(~is_edge, "not_completed")
        .when(F.col("_owner").isNull(), "no_referral")
        .when(~F.col("_active"), "influencer_inactive")
        .when(F.col("type").isNull(), "no_scheme")
        .when(F.col("_done").isNotNull() | (F.col("version") > F.col("_first")), "duplicate")
        .otherwise("accrued")
    )
    computed = F.col("reason_code").isin("accrued", "duplicate")
    return outcome.withColumn("reason_code", reason).select(
        F.col("id").alias("booking_id"), "version", "previous_status", "status", "reason_code",
        F.when(computed, F.col("amount")).alias("amount"),
    )


def affiliate_usage_upsert(usage: DataFrame, accruals: DataFrame, status: str = "pending", insert: bool = True) -> DataFrame:
    """The code-usage table after the accruals.

    The earlier scheme sets the rows ``pending`` and adds one where a booking has none; the
    current one sets them ``completed`` and adds nothing (``insert=False``). ``usage`` and
    ``accruals`` are unique per booking, so the outer join is the upsert.
    """
    due = accruals.select(
        "booking_id", F.struct("beneficiary_id", "customer_id", "code", "base_amount", "rate", "type", "amount").alias("_a")
    )
    rows = usage.withColumn("_known", F.lit(True)).join(due, "booking_id", "full" if insert else "left")
    new, hit = F.col("_known").isNull(), F.col("_a").isNotNull()

    def kept(column: str, inserted: Column) -> Column:
        return F.when(new, inserted).otherwise(F.col(column)).alias(column)

    def set_(column: str, value: Column) -> Column:
        return F.when(hit, value).otherwise(F.col(column)).alias(column)

    return rows.select(
        "booking_id",
        kept("influencer_id", F.col("_a.beneficiary_id")),
        kept("promo_code", F.col("_a.code")),
        kept("original_price", F.col("_a.base_amount")),
        kept("discount_amount_applied", F.lit(0).cast(MONEY)),
        kept("final_price", F.col("_a.base_amount")),
        set_("commission_amount", F.col("_a.amount")),
        set_("commission_status", F.lit(status)),
        set_("commission_type", F.col("_a.type")),
        set_("commission_rate", F.col("_a.rate")),
        set_("order_amount", F.col("_a.base_amount")),
        set_("referee_id", F.col("_a.customer_id")),
    )


# --- driver referrals -------------------------------------------------------------------


def driver_referral_commission(
    completed: DataFrame,
    driver_referrals: DataFrame,
    affiliates: DataFrame,
    record_null_semantics: str = "found",
    limit: int | None = None,
    keys_from: DataFrame | None = None,
) -> DataFrame:
    """Commission of the driver who referred the booking's driver, taken from the platform fee.

    ``completed`` has one row per booking (id, driver_id, service_type, platform_fee after the
    influencer's commission, completed_at). Fixed before percent, never above the fee.
    """
    if record_null_semantics not in ("found", "strict"):
        raise ValueError(f"unknown record_null_semantics {record_null_semantics!r}")
    bound = driver_referrals.select(
        F.col("referee_driver_id").alias("driver_id"), F.col("referrer_driver_id").alias("_referrer")
    )
    active = affiliates.filter((F.col("affiliate_status") == "active") & F.col("is_active"))
    if record_null_semantics == "strict":
        # a record equals "not null" only if all its fields are set
        for field in affiliates.columns:
            active = active.filter(F.col(field).isNotNull())
    terms = active.select(
        F.col("driver_id").alias("_referrer"),
        F.struct(
            "commission_fixed_enabled",
            "commission_fixed",
            "commission_percent_enabled",
            "commission_percent",
            "commission_percent_charter",
            "commission_percent_instant_ride",
        ).alias("_a"),
    )
    # the referral and its terms form one row per referee: joined before they meet the bookings
    referee_terms = bound.join(terms, "_referrer", "inner")
    rows = lookup(completed, referee_terms, "driver_id", limit=limit, keys_from=keys_from)
    base, service = zero_if_null("platform_fee"), service_of()
    fixed = F.coalesce(F.col("_a.commission_fixed_enabled") & (F.col("_a.commission_fixed") > 0), F.lit(False))
    percent = F.coalesce(F.col("_a.commission_percent_enabled"), F.lit(False)) & ~fixed
    own = F.when(service == "charter", F.col("_a.commission_percent_charter")).when(
        service == "instant_ride", F.col("_a.commission_percent_instant_ride")
    )
    rate = F.when(percent, F.coalesce(own, F.col("_a.commission_percent"), F.lit(0).cast(RATE))).otherwise(
        F.lit(0).cast(RATE)
    )
    computed = (
        F.when(fixed, F.col("_a.commission_fixed"))
        .when(percent, percent_of(base, rate.cast(RATE)))
        .otherwise(F.lit(0).cast(MONEY))
    )
    has_terms = F.col("_a").isNotNull()
    amount = F.when(has_terms, F.least(computed.cast(MONEY), base)).otherwise(F.lit(0).cast(MONEY))
    return rows.select(
        F.col("id").alias("booking_id"),
        "driver_id",
        F.when(has_terms, F.col("_referrer")).alias("driver_referrer_id"),
        F.when(has_terms, F.when(fixed, "fixed").when(percent, "percent")).alias("driver_referral_commission_type"),
        rate.cast(RATE).alias("driver_referral_commission_rate"),
        F.col("platform_fee").alias("platform_fee_before"),
        amount.alias("driver_referral_commission"),
        (F.col("platform_fee") - amount).cast(MONEY).alias("platform_fee"),
        "completed_at",
    )


def first_completions(changes: DataFrame, columns: list[str]) -> DataFrame:
    """The first completion of each booking, at creation included, with ``columns`` and its time.

    The earliest completed version is an edge by definition, so no window is needed.
    """
    wanted = list(dict.fromkeys(["id", "version", "changed_at", *columns]))
    first = oldest(changes.filter(F.col("status") == "completed").select(*wanted), "id", ["version"])
    return first.select("id", *(c for c in columns if c != "id"), F.col("changed_at").alias("completed_at"))


def referral_ledger(referral_commission: DataFrame) -> DataFrame:
    """Driver-referral commissions in the shape of the commission ledger."""
    return referral_commission.filter(F.col("driver_referrer_id").isNotNull()).select(
        "booking_id",
        F.lit("driver_referral").alias("scheme"),
        F.col("driver_referrer_id").alias("beneficiary_id"),
        F.col("platform_fee_before").alias("base_amount"),
        F.col("driver_referral_commission_rate").alias("rate"),
        F.col("driver_referral_commission_type").alias("type"),
        F.col("driver_referral_commission").alias("amount"),
        F.lit("accrued").alias("reason_code"),
        F.col("completed_at").alias("accrued_at"),
    )


# --- totals -----------------------------------------------------------------------------


def beneficiary_totals(ledger: DataFrame, beneficiaries: DataFrame, key: str) -> DataFrame:
    """Total earnings of every beneficiary, zero without a ledger row."""
    sums = ledger.groupBy(F.col("beneficiary_id").alias(key)).agg(
        F.sum("amount").cast(TOTAL).alias("total"), F.count(F.lit(1)).alias("n")
    )
    return beneficiaries.select(key).join(sums, key, "left").select(
        key,
        F.coalesce("total", F.lit(0).cast(TOTAL)).alias("total_earnings"),
        F.coalesce("n", F.lit(0)).alias("n_commissions"),
    )


def influencer_referral_counts(influencers: DataFrame, referrals: DataFrame) -> DataFrame:
    """Referred riders per influencer, zero included."""
    counts = referrals.groupBy(F.col("influencer_id").alias("id")).agg(F.count(F.lit(1)).alias("n"))
    return influencers.select("id").join(counts, "id", "left").select(
        F.col("id").alias("influencer_id"), F.coalesce("n", F.lit(0)).alias("total_referrals")
    )


def driver_referral_counts(affiliates: DataFrame, referral_changes: DataFrame) -> DataFrame:
    """Referred drivers per affiliate from an insert/delete log (column ``op``), never below zero."""
    delta = F.when(F.col("op") == "insert", 1).when(F.col("op") == "delete", -1).otherwise(0)
    counts = referral_changes.groupBy(F.col("referrer_driver_id").alias("driver_id")).agg(F.sum(delta).alias("n"))
    return affiliates.select("driver_id").join(counts, "driver_id", "left").select(
        "driver_id", F.greatest(F.lit(0).cast("bigint"), F.coalesce("n", F.lit(0))).alias("total_referrals")
    )


# --- directories and checks -------------------------------------------------------------


def commission_audit(usage: DataFrame, bookings: DataFrame) -> DataFrame:
    """Code uses beside their booking. Both are unique per booking."""
    rows = usage.select("booking_id", "influencer_id", "commission_amount", "commission_status", "order_amount", "used_at")
    return rows.join(
        bookings.select(F.col("id").alias("booking_id"), "booking_number", F.col("status").alias("order_status")),
        "booking_id",
    ).select(
        "booking_id", "booking_number", "order_status", "influencer_id", "commission_amount", "commission_status",
        "order_amount", "used_at",
    )


def referral_directory(referrals: DataFrame, influencers: DataFrame, limit: int | None = None) -> DataFrame:
    """Referrals with the influencer's settings."""
    dim = influencers.select(
        F.col("id").alias("influencer_id"),
        F.col("name").alias("influencer_name"),
        "commission_percent",
        "is_commission_percent_active",
        "is_active",
    )
    return lookup(referrals.select("referee_id", "influencer_id", "promo_code"), dim, "influencer_id", "inner", limit)


def missing_commissions(
    changes: DataFrame,
    referrals: DataFrame,
    ledger: DataFrame,
    slice_size: int = VERSIONS_PER_SLICE,
    limit: int | None = None,
) -> DataFrame:
    """Bookings completed by an update for a referred rider that have no ledger row."""
    rows = with_edges(changes.select("id", "version", "status", "changed_at", "customer_id"), slice_size)
    first = oldest(rows.filter(F.col("is_edge") & ~F.col("is_insert")), "id", ["version"])
    unpaid = first.join(ledger.select(F.col("booking_id").alias("id")).distinct(), "id", "left_anti")
    bound = referrals.select(F.col("referee_id").alias("customer_id"), F.col("influencer_id").alias("beneficiary_id"))
    return lookup(unpaid, bound, "customer_id", "inner", limit, changes).select(
        F.col("id").alias("booking_id"), "customer_id", "beneficiary_id", F.col("changed_at").alias("completed_at")
    )
