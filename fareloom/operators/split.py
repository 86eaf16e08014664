"""How a booking's amount is divided between platform, driver and influencer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom.functions.columns import country_of, has_promo, percent_of, service_of, zero_if_null
from fareloom.operators.joins import lookup
from fareloom.schemas import MONEY, PERCENT, SHARE_NO_PROMO, SHARE_WITH_PROMO

RULE_FIELDS = ("id", "company_percentage", "driver_percentage", "company_base_percentage")


# --- flat split -------------------------------------------------------------------------


def financial_split_legacy(bookings: DataFrame) -> DataFrame:
    """25 % to the platform, 75 % to the driver; the completion time falls back to the trip's end."""
    total = zero_if_null("total_amount")
    return bookings.select(
        "id",
        percent_of(total, F.lit(25).cast(PERCENT)).alias("platform_fee"),
        percent_of(total, F.lit(75).cast(PERCENT)).alias("driver_earning"),
        F.coalesce("completed_at", "actual_end_time").alias("completed_at"),
    )


# --- settings ---------------------------------------------------------------------------

# settings key, its company-share field, and the default shares, by whether a promo code is used
SHARE_SETTINGS = {
    True: ("revenue_share_with_promo", "company_base_percentage", SHARE_WITH_PROMO),
    False: ("revenue_share_no_promo", "company_percentage", SHARE_NO_PROMO),
}


def fallback_shares(settings: DataFrame) -> DataFrame:
    """Two rows, with and without promo code: the settings row's shares, else the fixed defaults.

    The choice is per row: a settings row that lacks a field yields NULL, not the default.
    """
    wanted = F.array(
        *(
            F.struct(
                F.lit(promo).alias("_promo"), F.lit(key).alias("key"), F.lit(field).alias("field"),
                F.lit(company).cast(PERCENT).alias("company"), F.lit(driver).cast(PERCENT).alias("driver"),
            )
            for promo, (key, field, (company, driver)) in SHARE_SETTINGS.items()
        )
    )
    defaults = settings.sparkSession.range(1).select(F.inline(wanted))
    stored = settings.filter(F.col("value").isNotNull()).groupBy("key").agg(F.min("value").alias("value"))
    is_set = F.col("value").isNotNull()
    own_company = F.try_variant_get(F.try_parse_json("value"), F.concat(F.lit("$."), "field"), "string")
    own_driver = F.get_json_object("value", "$.driver_percentage")
    return defaults.join(stored, "key", "left").select(
        "_promo",
        F.when(is_set, own_company.try_cast(PERCENT)).otherwise(F.col("company")).alias("_company"),
        F.when(is_set, own_driver.try_cast(PERCENT)).otherwise(F.col("driver")).alias("_driver"),
        F.when(is_set, "settings").otherwise("default").alias("_origin"),
    )


def _with_fallback(rows: DataFrame, settings: DataFrame) -> DataFrame:
    """Attach the fallback shares by column ``_promo``; there are two, so they are broadcast."""
    return rows.join(F.broadcast(fallback_shares(settings)), "_promo", "left")


# --- rule lookup ------------------------------------------------------------------------


def best_rules(rules: DataFrame) -> DataFrame:
    """The one rule per (country, region, service, promo): highest priority, then newest.

    Missing priorities or dates rank first, as a descending sort puts them.
    """
    rank = F.struct(
        F.col("priority").isNull(), "priority", F.col("created_at").isNull(), "created_at", F.col("id")
    )
    key = ("country", "region", "service_type", "has_promo_code")
    return (
        rules.filter(F.col("is_active"))
        .groupBy(*key)
        .agg(F.max_by(F.struct(*RULE_FIELDS), rank).alias("rule"))
    )


def _attach_rule(
    rows: DataFrame, rules: DataFrame, limit: int | None = None, keys_from: DataFrame | None = None
) -> DataFrame:
    """Add struct ``rule`` for columns ``_country, _region, _service, _promo``; a region's own rule wins.

    Two equi lookups against the pre-ranked rules, one by region and one for rules of every region.
    """
    best = best_rules(rules).select(
        F.col("country").alias("_country"),
        F.col("region").alias("_region"),
        F.col("service_type").alias("_service"),
        F.col("has_promo_code").alias("_promo"),
        "rule",
    )
    of_region = best.filter(F.col("_region").isNotNull()).withColumnRenamed("rule", "_exact")
    of_all = best.filter(F.col("_region").isNull()).drop("_region").withColumnRenamed("rule", "_wide")
    keys_from = rows if keys_from is None else keys_from
    matched = lookup(rows, of_region, ["_country", "_region", "_service", "_promo"], limit=limit, keys_from=keys_from)
    matched = lookup(matched, of_all, ["_country", "_service", "_promo"], limit=limit, keys_from=keys_from)
    return matched.withColumn("rule", F.coalesce("_exact", "_wide")).drop("_exact", "_wide")


def _with_keys(bookings: DataFrame, region: Column) -> DataFrame:
    return bookings.withColumns(
        {"_country": country_of(), "_region": region, "_service": service_of(), "_promo": has_promo()}
    )


_KEYS = ("_country", "_region", "_service", "_promo")


def revenue_share_lookup(bookings: DataFrame, rules: DataFrame, limit: int | None = None) -> DataFrame:
    """The revenue rule of each booking, by its region where it has one; NULLs where no rule applies."""
    rows = _with_keys(bookings.select("id", "country", "region", "service_type", "promo_code"), F.col("region"))
    return _attach_rule(rows, rules, limit).select(
        "id",
        F.col("rule.id").alias("rule_id"),
        "rule.company_percentage",
        "rule.driver_percentage",
        "rule.company_base_percentage",
    )


def _rule_found(record_null_semantics: str) -> Column:
    """Whether a rule row counts as found.

    ``found``: a row came back. ``strict``: every field of the row must be set, which is how
    a record compares with NULL in the row-wise original.
    """
    if record_null_semantics == "found":
        return F.col("rule").isNotNull()
    if record_null_semantics == "strict":
        every = F.col("rule").isNotNull()
        for field in RULE_FIELDS:
            every = every & F.col(f"rule.{field}").isNotNull()
        return every
    raise ValueError(f"unknown record_null_semantics {record_null_semantics!r}")


def _with_shares(
    bookings: DataFrame,
    rules: DataFrame,
    settings: DataFrame,
    record_null_semantics: str,
    limit: int | None,
    keys_from: DataFrame | None = None,
) -> DataFrame:
    """Add ``company_percentage``, ``driver_percentage``, ``share_origin`` and ``rule_id``.

    The split passes no region, so only rules for every region apply.
    """
    no_region = F.lit(None).cast("string")
    base = _with_keys(bookings if keys_from is None else keys_from, no_region)
    rows = _attach_rule(_with_keys(bookings, no_region), rules, limit, base)
    found = _rule_found(record_null_semantics)
    return (
        _with_fallback(rows, settings)
        .withColumns(
            {
                "company_percentage": F.when(found, F.col("rule.company_percentage")).otherwise(F.col("_company")),
                "driver_percentage": F.when(found, F.col("rule.driver_percentage")).otherwise(F.col("_driver")),
                "share_origin": F.when(found, "rule").otherwise(F.col("_origin")),
                "rule_id": F.when(found, F.col("rule.id")),
            }
        )
        .drop("rule", "_company", "_driver", "_origin", *_KEYS)
    )


def revenue_share_fallback(
    bookings: DataFrame,
    rules: DataFrame,
    settings: DataFrame,
    record_null_semantics: str = "found",
    limit: int | None = None,
) -> DataFrame:
    """Percentages per booking: rule, else settings row, else fixed default, chosen per row."""
    return _with_shares(
        bookings.select("id", "country", "service_type", "promo_code"), rules, settings, record_null_semantics, limit
    ).select("id", "rule_id", "share_origin", "company_percentage", "driver_percentage")


# --- influencer commission --------------------------------------------------------------

INFLUENCER_FIELDS = (
    "commission_fixed",
    "commission_percent",
    "commission_type",
    "commission_percent_charter",
    "commission_percent_instant_ride",
    "is_commission_fixed_active",
    "is_commission_percent_active",
)


def _with_influencer_commission(
    bookings: DataFrame, influencers: DataFrame, by_service: bool, limit: int | None
) -> DataFrame:
    dim = influencers.select(F.col("id").alias("influencer_id"), F.struct(*INFLUENCER_FIELDS).alias("_i"))
    base = bookings.drop(
        "influencer_commission_type", "influencer_commission_rate", "influencer_commission_fixed", "influencer_commission"
    )
    rows = lookup(base, dim, "influencer_id", limit=limit, keys_from=bookings)
    zero_money, zero_rate = F.lit(0).cast(MONEY), F.lit(0).cast(PERCENT)
    percent = F.col("_i.commission_percent")
    if by_service:
        service = service_of()
        own = F.when(service == "charter", F.col("_i.commission_percent_charter")).when(
            service == "instant_ride", F.col("_i.commission_percent_instant_ride")
        )
        percent = F.coalesce(F.when(F.col("_i.commission_type") == "by_service_type", own), percent)
    has_influencer = F.col("influencer_id").isNotNull()
    is_fixed = F.coalesce(F.col("_i.is_commission_fixed_active"), F.lit(False))
    is_percent = F.coalesce(F.col("_i.is_commission_percent_active"), F.lit(False)) & ~is_fixed
    rate = F.when(is_percent, F.coalesce(percent.cast(PERCENT), zero_rate)).otherwise(zero_rate)
    fixed = F.when(is_fixed, zero_if_null("_i.commission_fixed")).otherwise(zero_money)
    kind = F.when(is_fixed, "fixed").when(is_percent, "percent").otherwise("none")
    return (
        rows.withColumn("influencer_commission_type", F.when(has_influencer, kind))
        .withColumn("influencer_commission_rate", rate)
        .withColumn("influencer_commission_fixed", fixed)
        .withColumn(
            "influencer_commission",
            F.when(is_fixed, fixed)
            .when(is_percent, percent_of(zero_if_null("total_amount"), F.col("influencer_commission_rate")))
            .otherwise(zero_money),
        )
        .drop("_i")
    )


def influencer_commission(bookings: DataFrame, influencers: DataFrame, limit: int | None = None) -> DataFrame:
    """Commission of the influencer on the booking: fixed before percent, percent by service if so set.

    The rate is narrowed to two digits before it is applied; inactive influencers still earn here.
    """
    rows = bookings.select("id", "influencer_id", "service_type", "total_amount")
    return _with_influencer_commission(rows, influencers, True, limit).select(
        "id",
        "influencer_id",
        "influencer_commission_type",
        "influencer_commission_rate",
        "influencer_commission_fixed",
        "influencer_commission",
    )


# --- complete split ---------------------------------------------------------------------


def _split_columns(rows: DataFrame) -> DataFrame:
    """Gross fee, driver share and the fee net of the influencer's commission; the fee may go below zero."""
    total = zero_if_null("total_amount")
    commission = F.col("influencer_commission")
    return (
        rows.withColumn("platform_fee_gross", percent_of(total, "company_percentage"))
        .withColumn("driver_earning", percent_of(total, "driver_percentage"))
        .withColumn(
            "platform_fee",
            F.when((commission > 0) & has_promo(), F.col("platform_fee_gross") - commission)
            .otherwise(F.col("platform_fee_gross"))
            .cast(MONEY),
        )
    )


def split_bookings(
    bookings: DataFrame,
    rules: DataFrame,
    settings: DataFrame,
    influencers: DataFrame,
    record_null_semantics: str = "found",
    limit: int | None = None,
) -> DataFrame:
    """The bookings with every split column added (all input columns stay)."""
    rows = _with_influencer_commission(bookings, influencers, True, limit)
    rows = _with_shares(rows.drop("platform_fee", "driver_earning"), rules, settings, record_null_semantics, limit, bookings)
    return _split_columns(rows)


SPLIT_INPUT = ("id", "country", "service_type", "promo_code", "influencer_id", "total_amount")


def financial_split(
    bookings: DataFrame,
    rules: DataFrame,
    settings: DataFrame,
    influencers: DataFrame,
    record_null_semantics: str = "found",
    limit: int | None = None,
) -> DataFrame:
    """The split by rule (country, service, promo), settings or default, less the influencer's commission."""
    rows = split_bookings(bookings.select(*SPLIT_INPUT), rules, settings, influencers, record_null_semantics, limit)
    return rows.select(
        "id", "rule_id", "share_origin", "company_percentage", "driver_percentage", "platform_fee_gross",
        "influencer_commission_type", "influencer_commission_rate", "influencer_commission", "platform_fee",
        "driver_earning",
    )


def financial_split_settings(
    bookings: DataFrame, settings: DataFrame, influencers: DataFrame, limit: int | None = None
) -> DataFrame:
    """The earlier split: settings rows only, one percentage for all services."""
    rows = _with_influencer_commission(
        bookings.select("id", "promo_code", "influencer_id", "total_amount"), influencers, False, limit
    )
    rows = _with_fallback(rows.withColumn("_promo", has_promo()), settings).withColumnsRenamed(
        {"_company": "company_percentage", "_driver": "driver_percentage", "_origin": "share_origin"}
    )
    return _split_columns(rows).select(
        "id", "share_origin", "platform_fee_gross", "influencer_commission", "platform_fee", "driver_earning"
    )


def platform_fee_net(split: DataFrame) -> DataFrame:
    """Fee before and after the influencer's commission."""
    return split.select("id", "platform_fee_gross", "influencer_commission", "platform_fee", (F.col("platform_fee") < 0).alias("is_negative"))


# --- repair -----------------------------------------------------------------------------


def _flat(amount: str, share: str) -> Column:
    return F.col(amount) * F.lit(share).cast("decimal(3,2)")


def fee_is_wrong() -> Column:
    """Fee or earning missing, or not exactly 25 % / 75 % of the total."""
    return ~(
        F.col("platform_fee").eqNullSafe(_flat("total_amount", "0.25"))
        & F.col("driver_earning").eqNullSafe(_flat("total_amount", "0.75"))
    )


def fee_repair(bookings: DataFrame) -> DataFrame:
    """Bookings whose flat split is wrong, with the right one; the others are not touched."""
    return bookings.filter(F.col("total_amount").isNotNull() & fee_is_wrong()).select(
        "id",
        F.col("platform_fee").alias("old_platform_fee"),
        F.col("driver_earning").alias("old_driver_earning"),
        F.round(_flat("total_amount", "0.25"), 2).cast(MONEY).alias("platform_fee"),
        F.round(_flat("total_amount", "0.75"), 2).cast(MONEY).alias("driver_earning"),
    )


def fee_correctness(bookings: DataFrame) -> DataFrame:
    """How many bookings with a total need the repair, and how many are right, in one pass."""
    return bookings.filter(F.col("total_amount").isNotNull()).agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.count_if(fee_is_wrong()).alias("orders_to_update"),
        F.count_if(~fee_is_wrong()).alias("correct_orders"),
    )
