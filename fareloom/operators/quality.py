"""Data-quality, compliance and consistency checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom.operators.joins import newest
from fareloom.schemas import (
    DOCUMENT_TYPES,
    INSTANT_RIDE_DOCUMENT_TYPES,
    LEGACY_DOCUMENT_TYPES,
    SERVICE_TYPES,
)

# --- value constraints ------------------------------------------------------------------


def booking_constraints() -> dict[str, Column]:
    return {
        "passenger_count": F.col("passenger_count").between(1, 20),
        "luggage_count": F.col("luggage_count").between(0, 50),
        "country_code": F.col("country").rlike("^[A-Z]{2}$"),
        "service_type": F.col("service_type").isin(*SERVICE_TYPES),
    }


def rule_constraints() -> dict[str, Column]:
    company, driver = F.col("company_percentage"), F.col("driver_percentage")
    return {
        "company_percentage": company.between(0, 100),
        "driver_percentage": driver.between(0, 100),
        "percentage_sum": (company + driver) == 100,
    }


def driver_constraints() -> dict[str, Column]:
    return {"company_tax_id": F.col("company_tax_id").rlike("^[0-9]{8}$")}


def constraint_violations(table: str, df: DataFrame, constraints: Mapping[str, Column]) -> DataFrame:
    """Rows that break each constraint, counted in one pass; a NULL result passes, as in SQL."""
    counts = df.agg(*(F.count_if(~ok).alias(code) for code, ok in constraints.items()))
    rows = F.array(*(F.struct(F.lit(code).alias("constraint"), F.col(code).alias("violations")) for code in constraints))
    return counts.select(F.lit(table).alias("table_name"), F.inline(rows))


def duplicate_keys(label: str, df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once; NULLs compare equal, so duplicates among them show too."""
    text = F.concat_ws("|", *(F.coalesce(F.col(k).cast("string"), F.lit("(null)")) for k in keys))
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .filter(F.col("n_rows") > 1)
        .select(F.lit(label).alias("check_name"), text.alias("key"), "n_rows")
    )


def orphan_rows(label: str, child: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Values of ``column`` without a parent, and how many rows carry them.

    Counted per value before the anti join: a value with very many rows is one row there.
    """
    used = child.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n_rows"))
    return used.join(parent.select(F.col(parent_key).alias("value")), "value", "left_anti").select(
        F.lit(label).alias("check_name"), "value", "n_rows"
    )


# --- drivers ----------------------------------------------------------------------------


def driver_completeness(users: DataFrame, profiles: DataFrame, drivers: DataFrame) -> DataFrame:
    """Driver users that lack a profile or a driver record."""
    has_profile = profiles.select(F.col("user_id").alias("id"), F.lit(True).alias("_p"))
    has_driver = drivers.select(F.col("user_id").alias("id"), F.lit(True).alias("_d"))
    rows = (
        users.filter(F.col("role") == "driver")
        .select("id")
        .join(has_profile, "id", "left")
        .join(has_driver, "id", "left")
    )
    return rows.select(
        F.col("id").alias("user_id"),
        F.col("_p").isNull().alias("lacks_profile"),
        F.col("_d").isNull().alias("lacks_driver_record"),
    ).filter(F.col("lacks_profile") | F.col("lacks_driver_record"))


def driver_completeness_counts(users: DataFrame, profiles: DataFrame, drivers: DataFrame) -> DataFrame:
    """Driver users, their profiles and driver records, and how many lack which."""
    has_profile = profiles.select(F.col("user_id").alias("id"), F.lit(True).alias("_p"))
    has_driver = drivers.select(F.col("user_id").alias("id"), F.lit(True).alias("_d"))
    rows = (
        users.filter(F.col("role") == "driver")
        .select("id")
        .join(has_profile, "id", "left")
        .join(has_driver, "id", "left")
    )
    return rows.agg(
        F.count(F.lit(1)).alias("driver_users"),
        F.count("_p").alias("with_profile"),
        F.count("_d").alias("with_driver_record"),
        F.count_if(F.col("_p").isNull()).alias("lacking_profile"),
        F.count_if(F.col("_d").isNull()).alias("lacking_driver_record"),
    )


def current_documents(documents: DataFrame) -> DataFrame:
    """The newest document per driver and current type that is not rejected; legacy types are folded in."""
    known = (*DOCUMENT_TYPES, *INSTANT_RIDE_DOCUMENT_TYPES)
    folded = F.array(F.col("type"))
    for old, new in LEGACY_DOCUMENT_TYPES.items():
        folded = F.when(F.col("type") == old, F.array(*(F.lit(n) for n in new))).otherwise(folded)
    rows = documents.filter(F.col("status") != "rejected").select(
        "driver_id", F.explode(folded).alias("type"), "status", "uploaded_at", "url"
    )
    return newest(rows.filter(F.col("type").isin(*known)), ["driver_id", "type"], ["uploaded_at", "url"])


def document_compliance(drivers: DataFrame, documents: DataFrame, needs_instant: Column) -> DataFrame:
    """Required documents each driver lacks or has not had approved.

    ``drivers`` is unique per ``user_id``; ``needs_instant`` tells who takes instant rides and
    so needs two more. One flag per type is aggregated, not a list.
    """
    known = (*DOCUMENT_TYPES, *INSTANT_RIDE_DOCUMENT_TYPES)
    state = (
        current_documents(documents)
        .groupBy(F.col("driver_id").alias("user_id"))
        .agg(
            *(F.max(F.when(F.col("type") == t, 1)).alias(f"_has_{t}") for t in known),
            *(F.max(F.when((F.col("type") == t) & (F.col("status") == "approved"), 1)).alias(f"_ok_{t}") for t in known),
        )
    )
    rows = drivers.withColumn("_instant", needs_instant).select("user_id", "_instant").join(state, "user_id", "left")

    def listed(prefix: str, also: Column | None = None) -> Column:
        codes = []
        for t in known:
            absent = F.col(f"{prefix}{t}").isNull()
            if also is not None:
                absent = absent & F.col(f"_has_{t}").isNotNull()
            if t in INSTANT_RIDE_DOCUMENT_TYPES:
                absent = absent & F.col("_instant")
            codes.append(F.when(absent, F.lit(t)))
        return F.array_join(F.array_sort(F.array_compact(F.array(*codes))), ",")

    missing = listed("_has_")
    unapproved = listed("_ok_", F.lit(True))
    return rows.select(
        "user_id",
        F.col("_instant").alias("needs_instant"),
        missing.alias("missing"),
        unapproved.alias("unapproved"),
        ((missing == "") & (unapproved == "")).alias("is_compliant"),
    )


def wide_to_long(wide: DataFrame, key: str, columns: Mapping[str, str], kind: str) -> DataFrame:
    """One row per URL column that is set, under its type name."""
    entries = F.array(*(F.struct(F.lit(name).alias(kind), F.col(c).alias("url")) for c, name in columns.items()))
    return wide.select(key, F.inline(entries)).filter(F.col("url").isNotNull())


def long_to_wide(long: DataFrame, key: str, columns: Mapping[str, str], kind: str) -> DataFrame:
    """The inverse of ``wide_to_long``; types are given, so no pass over the data finds them."""
    return long.groupBy(key).agg(*(F.max(F.when(F.col(kind) == name, F.col("url"))).alias(c) for c, name in columns.items()))


# --- bookings and ledger ----------------------------------------------------------------


def stuck_matched_orders(bookings: DataFrame) -> DataFrame:
    """Bookings matched with a driver who has not confirmed."""
    return bookings.filter((F.col("status") == "matched") & F.col("driver_id").isNotNull()).select(
        "id", "booking_number", "driver_id", "created_at", "updated_at"
    )


def fee_anomalies(referral_commission: DataFrame) -> DataFrame:
    """Completed bookings whose platform fee is below zero or was used up by the referral commission."""
    before, after, paid = F.col("platform_fee_before"), F.col("platform_fee"), F.col("driver_referral_commission")
    kind = F.when(before < 0, "negative_fee").when((paid > 0) & (paid == before), "capped").when(after < 0, "over_deducted")
    return referral_commission.withColumn("anomaly", kind).filter(F.col("anomaly").isNotNull()).select(
        "booking_id", "platform_fee_before", "driver_referral_commission", "platform_fee", "anomaly"
    )


def split_residual(split: DataFrame) -> DataFrame:
    """What the two rounded shares and the commission leave of the total, where it is not zero."""
    taken = F.when(F.col("platform_fee") == F.col("platform_fee_gross"), F.lit(0).cast("decimal(10,2)")).otherwise(
        F.col("influencer_commission")
    )
    residual = F.coalesce("total_amount", F.lit(0).cast("decimal(10,2)")) - F.col("platform_fee") - taken - F.col("driver_earning")
    return split.select("id", "total_amount", "platform_fee", "driver_earning", residual.cast("decimal(10,2)").alias("residual")).filter(
        F.col("residual") != 0
    )
