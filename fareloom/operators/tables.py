"""Set-wise maintenance of tables: upserts, patches, default fills, JSON edits, row policies."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom.functions.columns import full_name
from fareloom.operators.joins import lookup
from fareloom.schemas import DEFAULT_COUNTRY, DEFAULT_SERVICE, DEPOSIT_PAID_STATUSES, INSTANT_SERVICE, MONEY


def upsert(target: DataFrame, source: DataFrame, key: str | Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """``target`` after inserting the rows of ``source`` or, where the key exists, setting ``columns``.

    Both sides are unique on ``key``, so the full outer join has no heavy key. A NULL in a
    set column is set too; columns outside ``columns`` keep the target's value.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in target.columns if c not in keys]
    columns = rest if columns is None else list(columns)
    given = source.select(*keys, F.struct(*rest).alias("_new"))
    rows = target.withColumn("_old", F.lit(True)).join(given, keys, "full")
    inserted, hit = F.col("_old").isNull(), F.col("_new").isNotNull()

    def merged(c: str) -> Column:
        takes = hit if c in columns else inserted
        return F.when(takes, F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c)

    return rows.select(*keys, *(merged(c) for c in rest))


def insert_missing(target: DataFrame, source: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """``target`` plus the rows of ``source`` whose key it lacks."""
    keys = [key] if isinstance(key, str) else list(key)
    return target.unionByName(source.select(*target.columns).join(target.select(*keys), keys, "left_anti"))


def default_profiles(users: DataFrame, first_name: str, last_name: str, phone: str) -> DataFrame:
    """Placeholder profiles for all drivers, to be inserted where missing."""
    return users.filter(F.col("role") == "driver").select(
        F.col("id").alias("user_id"), F.lit(first_name).alias("first_name"), F.lit(last_name).alias("last_name"), F.lit(phone).alias("phone")
    )


def apply_status_patches(bookings: DataFrame, patches: DataFrame) -> DataFrame:
    """Bookings after status patches: the status is set, the other patched columns only where given.

    ``patches`` is unique per id and may carry completed_at, deposit_paid and tip_amount.
    """
    optional = [c for c in ("completed_at", "deposit_paid", "tip_amount") if c in patches.columns]
    given = patches.select("id", F.struct("status", *optional).alias("_patch"))
    rows = bookings.join(given, "id", "left")
    hit = F.col("_patch").isNotNull()
    out = rows.withColumn("status", F.when(hit, F.col("_patch.status")).otherwise(F.col("status")))
    for c in optional:
        out = out.withColumn(c, F.coalesce(F.col(f"_patch.{c}"), F.col(c)))
    return out.withColumn("is_patched", hit).drop("_patch")


# --- fills ------------------------------------------------------------------------------


def deposit_backfill(bookings: DataFrame) -> DataFrame:
    """``deposit_paid`` derived from the status where the status implies it."""
    implied = F.col("status").isin(*DEPOSIT_PAID_STATUSES)
    return bookings.withColumn("deposit_paid", F.when(implied, F.lit(True)).otherwise(F.col("deposit_paid")))


def fill_defaults(bookings: DataFrame) -> DataFrame:
    """Defaults for the columns added over time.

    The three price columns are filled together, where the original or the final price is missing.
    """
    unpriced = F.col("original_price").isNull() | F.col("final_price").isNull()
    total = F.col("total_amount")
    return (
        bookings.withColumn("country", F.coalesce("country", F.lit(DEFAULT_COUNTRY)))
        .withColumn("service_type", F.coalesce("service_type", F.lit(DEFAULT_SERVICE)))
        .withColumn("_unpriced", unpriced)
        .withColumn("original_price", F.when(F.col("_unpriced"), total).otherwise(F.col("original_price")))
        .withColumn("final_price", F.when(F.col("_unpriced"), total).otherwise(F.col("final_price")))
        .withColumn("discount_amount", F.when(F.col("_unpriced"), F.lit(0).cast(MONEY)).otherwise(F.col("discount_amount")))
        .drop("_unpriced")
    )


def fill_commission_type(influencers: DataFrame) -> DataFrame:
    return influencers.withColumn("commission_type", F.coalesce("commission_type", F.lit("unified")))


def fill_service_types(drivers: DataFrame) -> DataFrame:
    """Drivers without service types offer charter trips and instant rides."""
    every = F.array(F.lit(DEFAULT_SERVICE), F.lit(INSTANT_SERVICE))
    return drivers.withColumn("service_types", F.coalesce("service_types", every))


def offers(service: str) -> Column:
    """Whether a driver (column ``service_types``) takes trips of ``service``; one who has not chosen takes all."""
    return F.col("service_types").isNull() | F.coalesce(F.array_contains("service_types", service), F.lit(False))


# --- JSON columns -----------------------------------------------------------------------


def json_set(column: str, values: Mapping[str, str]) -> Column:
    """The JSON object with the given fields (as JSON text) set; its other fields keep their values."""
    current = F.from_json(F.col(column), "map<string,variant>")
    names = F.array(*(F.lit(k) for k in values))
    kept = F.map_filter(current, lambda k, _: ~F.array_contains(names, k))
    new = F.create_map(*(x for k, v in values.items() for x in (F.lit(k), F.parse_json(F.lit(v)))))
    return F.to_json(F.map_concat(kept, new), {"ignoreNullFields": "false"})


def settings_set(settings: DataFrame, column: str, values: Mapping[str, str]) -> DataFrame:
    """Set fields in a JSON column of every row."""
    return settings.withColumn(column, json_set(column, values))


def settings_drift(settings: DataFrame, column: str, key: str, expected: Mapping[str, str]) -> DataFrame:
    """Fields of a JSON column whose value differs from the expected text; an absent field differs."""
    wanted = F.array(*(F.struct(F.lit(f).alias("field"), F.lit(v).alias("expected")) for f, v in expected.items()))
    fields = F.try_variant_get(F.try_parse_json(column), "$", "map<string,variant>")
    rows = settings.select(key, fields.alias("_fields"), F.inline(wanted))
    return (
        rows.withColumn("actual", F.try_element_at("_fields", F.col("field")).cast("string"))
        .filter(~F.col("actual").eqNullSafe(F.col("expected")))
        .drop("_fields")
    )


# --- directories ------------------------------------------------------------------------


def driver_directory(users: DataFrame, profiles: DataFrame, drivers: DataFrame) -> DataFrame:
    """All driver users with profile and driver record where there is one."""
    named = profiles.select(F.col("user_id").alias("id"), "first_name", "last_name", "phone")
    cars = drivers.select(F.col("user_id").alias("id"), F.col("id").alias("driver_id"), "vehicle_type", "rating", "is_available")
    return (
        users.filter(F.col("role") == "driver")
        .select("id", "email", "role", "status")
        .join(named, "id", "left")
        .join(cars, "id", "left")
    )


def available_drivers(users: DataFrame, profiles: DataFrame, drivers: DataFrame, service: str | None = None) -> DataFrame:
    """Active drivers open for trips, of ``service`` if one is named, best rated first, then most trips."""
    named = profiles.select(F.col("user_id").alias("id"), "first_name", "last_name", "phone")
    cars = drivers.filter("is_available" if service is None else F.col("is_available") & offers(service)).select(F.col("user_id").alias("id"), "vehicle_type", "rating", "total_trips")
    rows = (
        users.filter((F.col("role") == "driver") & (F.col("status") == "active"))
        .select("id", "email")
        .join(named, "id")
        .join(cars, "id")
    )
    return rows.select(
        F.col("id").alias("user_id"), "email", full_name("first_name", "last_name").alias("driver_name"), "phone",
        "vehicle_type", "rating", "total_trips",
    ).orderBy(F.col("rating").desc_nulls_first(), F.col("total_trips").desc_nulls_first(), "user_id")


def profiles_of_drivers(profiles: DataFrame, users: DataFrame) -> DataFrame:
    driver_ids = users.filter(F.col("role") == "driver").select(F.col("id").alias("user_id"))
    return profiles.join(driver_ids, "user_id", "left_semi")


# --- row policies -----------------------------------------------------------------------


def visible_rows(rows: DataFrame, owner: str, principals: DataFrame, action: str = "read", limit: int | None = None) -> DataFrame:
    """The rows a set of principals (id, role) may see or change.

    Owners reach their own rows, for a change only while those are pending; admins reach all.
    Admins are one yes/no value, so no row meets more than its owner.
    """
    if action not in ("read", "update"):
        raise ValueError(f"unknown action {action!r}")
    is_admin = principals.filter(F.col("role") == "admin").agg((F.count(F.lit(1)) > 0).alias("any")).scalar()
    owners = principals.select(F.col("id").alias(owner)).distinct().withColumn("_own", F.lit(True))
    seen = lookup(rows, owners, owner, limit=limit)
    own = F.col("_own").isNotNull()
    if action == "update":
        own = own & F.coalesce(F.col("status") == "pending", F.lit(False))
    return (
        seen.withColumn("by_owner", own)
        .withColumn("by_admin", is_admin)
        .filter(F.col("by_owner") | F.col("by_admin"))
        .drop("_own")
    )
