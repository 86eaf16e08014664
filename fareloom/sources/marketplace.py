"""The booking platform's entities, derived from the generated test tables.

Every view keeps all rows of the table it comes from, or drops rows by a business column
(account balance, for example) so that incomplete records occur. The views are lazy:
Catalyst prunes the columns a query does not use, and drops the line-item side of
``bookings`` where no driver is needed.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.schemas import LATITUDE, LONGITUDE, MONEY, RATE, RATING, WIDE_DOCUMENT_COLUMNS, WIDE_PHOTO_COLUMNS
from fareloom.sources.tables import read_table

RULES = """
    ('R1', 'TW', CAST(NULL AS STRING), 'charter', false, 25, 75, CAST(NULL AS INT), true, 0, '2024-01-01'),
    ('R2', 'TW', NULL, 'charter', true, 30, 70, 30, true, 0, '2024-01-01'),
    ('R3', 'TW', NULL, 'instant_ride', false, 20, 80, NULL, true, 0, '2024-01-01'),
    ('R4', 'TW', NULL, 'instant_ride', false, 22, 78, NULL, true, 5, '2024-01-01'),
    ('R5', 'JP', NULL, 'charter', false, 28, 72, NULL, true, 0, '2024-01-01'),
    ('R6', 'TW', 'north', 'charter', false, 26, 74, NULL, true, 0, '2024-01-01'),
    ('R7', 'TW', 'north', 'charter', false, 27, 73, NULL, true, 0, '2024-02-01'),
    ('R8', 'TW', 'south', 'charter', true, 33, 67, 33, false, 9, '2024-01-01')
"""

SETTINGS = """
    ('revenue_share_with_promo', '{"company_base_percentage": 32, "driver_percentage": 68}'),
    ('pricing_config', '{"currency": "TWD", "depositRate": 0.25}')
"""

DOCUMENT_NAMES = (
    "id_card_front",
    "id_card_back",
    "drivers_license",
    "vehicle_registration",
    "insurance_policy",
    "police_clearance",
    "no_accident_record",
    "selfie_photo",
    "taxi_permit",
    "id_card",
    "license",
    "insurance",
)


def _id(prefix: str, key: str | Column) -> Column:
    return F.concat(F.lit(prefix), (F.col(key) if isinstance(key, str) else key).cast("string"))


def _money(column: str) -> Column:
    return F.col(column).cast(MONEY)


def _plus(moment: str, interval: str) -> Column:
    return F.col(moment) + F.expr(f"INTERVAL {interval}")


class Marketplace:
    """Entities over one folder of generated tables."""

    def __init__(self, spark: SparkSession, directory: str) -> None:
        self.spark = spark
        self.directory = directory
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """The raw table; its schema is read once per object."""
        if name not in self._tables:
            self._tables[name] = read_table(self.spark, self.directory, name)
        return self._tables[name]

    # --- people ---------------------------------------------------------------------

    @cached_property
    def users(self) -> DataFrame:
        riders = self.table("customer").select(
            _id("C", "c_custkey").alias("id"),
            F.when(F.col("c_acctbal") >= 9800, "admin").otherwise("customer").alias("role"),
            F.col("c_name").alias("name"),
            F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@rider.example")).alias("email"),
            F.when(F.col("c_acctbal") < 0, "suspended").otherwise("active").alias("status"),
            _id("uid-c", "c_custkey").alias("external_uid"),
        )
        drivers = self.table("supplier").select(
            _id("D", "s_suppkey").alias("id"),
            F.lit("driver").alias("role"),
            F.col("s_name").alias("name"),
            F.concat(F.lower(F.replace("s_name", F.lit("#"), F.lit("."))), F.lit("@driver.example")).alias("email"),
            F.when(F.col("s_acctbal") < 0, "suspended").otherwise("active").alias("status"),
            _id("uid-d", "s_suppkey").alias("external_uid"),
        )
        return riders.unionByName(drivers)

    @cached_property
    def profiles(self) -> DataFrame:
        def of(table: str, prefix: str, key: str, name: str, nation: str, balance: str) -> DataFrame:
            nation_key = F.col(nation)
            return self.table(table).filter(F.col(balance) >= -400).select(
                _id(prefix, key).alias("user_id"),
                F.when(~nation_key.isin(3, 4), F.split_part(name, F.lit("#"), F.lit(1))).alias("first_name"),
                F.when(~nation_key.isin(4, 5), F.split_part(name, F.lit("#"), F.lit(2))).alias("last_name"),
                F.when(nation_key >= 5, F.concat(F.lit("+886-"), F.col(key).cast("string"))).alias("phone"),
            )

        riders = of("customer", "C", "c_custkey", "c_name", "c_nationkey", "c_acctbal")
        return riders.unionByName(of("supplier", "D", "s_suppkey", "s_name", "s_nationkey", "s_acctbal"))

    @cached_property
    def drivers(self) -> DataFrame:
        balance, nation = F.col("s_acctbal"), F.col("s_nationkey")
        return self.table("supplier").filter(balance >= 0).select(
            _id("DR", "s_suppkey").alias("id"),
            _id("D", "s_suppkey").alias("user_id"),
            F.when(balance < 5000, "small").otherwise("large").alias("vehicle_type"),
            ((300 + 8 * nation).cast("decimal(5,0)") * F.lit("0.01").cast("decimal(3,2)")).cast(RATING).alias("rating"),
            F.floor(balance / 40).cast("int").alias("total_trips"),
            (balance > 1000).alias("is_available"),
            F.when(nation < 12, F.lpad(F.col("s_suppkey").cast("string"), 8, "0"))
            .when(nation < 15, F.col("s_suppkey").cast("string"))
            .alias("company_tax_id"),
            # a third take charter trips only, a third have not chosen
            F.when(nation % 3 == 0, F.array(F.lit("charter")))
            .when(nation % 3 == 1, F.array(F.lit("instant_ride"), F.lit("charter")))
            .alias("service_types"),
        )

    @cached_property
    def vehicles(self) -> DataFrame:
        rows = F.array(
            F.struct(F.lit("P-").alias("tag"), (F.col("s_nationkey") != 7).alias("is_primary")),
            F.struct(F.lit("S-").alias("tag"), F.lit(False).alias("is_primary")),
        )
        return (
            self.table("supplier")
            .select("s_suppkey", "s_nationkey", F.inline(rows))
            .select(
                _id("DR", "s_suppkey").alias("driver_id"),
                F.concat("tag", F.col("s_suppkey").cast("string")).alias("plate_number"),
                F.concat(F.lit("Model "), F.col("s_nationkey").cast("string")).alias("model"),
                "is_primary",
            )
        )

    # --- bookings -------------------------------------------------------------------

    @cached_property
    def bookings(self) -> DataFrame:
        """One booking per order; the driver is the smallest supplier on the order."""
        driver = self.table("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.min("l_suppkey").alias("sk"))
        rows = self.table("orders").join(driver, "o_orderkey", "left")
        key, rider, priority, state = (F.col(c) for c in ("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus"))
        total = _money("o_totalprice")
        promo = (rider % 3) == 0
        done = state == "F"
        status = (
            F.when(done, "completed")
            .when(state == "P", "trip_ended")
            .when(priority == "1-URGENT", "paid_deposit")
            .when(priority == "2-HIGH", "matched")
            .when(priority == "3-MEDIUM", "pending_payment")
            .when(priority == "4-NOT SPECIFIED", "driver_confirmed")
            .otherwise("cancelled")
        )
        def share(x: str) -> Column:
            return (total * F.lit(x).cast("decimal(3,2)")).cast(MONEY)

        return rows.select(
            _id("B", key).alias("id"),
            F.concat(F.lit("BK"), F.lpad(key.cast("string"), 12, "0")).alias("booking_number"),
            _id("C", rider).alias("customer_id"),
            _id("D", "sk").alias("driver_id"),
            status.alias("status"),
            F.to_date(_plus("o_orderdate", "2 DAYS")).alias("start_date"),
            F.when(key % 6 != 0, F.concat(F.lpad((key % 24).cast("string"), 2, "0"), F.lit(":30:00"))).alias("start_time"),
            (4 + key % 8).cast("int").alias("duration_hours"),
            F.when(priority.isin("1-URGENT", "2-HIGH"), "large").otherwise("small").alias("vehicle_type"),
            _id("Stop ", rider).alias("pickup_location"),
            F.when(rider % 10 != 0, _id("Stop ", rider % 10)).alias("destination"),
            (25 + (rider % 1000).cast("decimal(10,0)") * F.lit("0.001").cast("decimal(4,3)")).cast(LATITUDE).alias("pickup_latitude"),
            F.when(rider % 9 != 0, (121 + (rider % 500).cast("decimal(10,0)") * F.lit("0.002").cast("decimal(4,3)")).cast(LONGITUDE)).alias("pickup_longitude"),
            F.when(priority != "5-LOW", F.lit("24.5").cast(LATITUDE)).alias("dropoff_latitude"),
            F.when(priority != "5-LOW", F.lit("120.25").cast(LONGITUDE)).alias("dropoff_longitude"),
            F.when(rider % 4 == 0, "child seat").when(rider % 4 == 1, "").alias("special_requirements"),
            (rider % 6 == 0).alias("requires_foreign_language"),
            (key % 24).cast("int").alias("passenger_count"),
            (rider % 60).cast("int").alias("luggage_count"),
            total.alias("base_price"),
            F.when(rider % 6 == 0, F.lit(500)).otherwise(0).cast(MONEY).alias("foreign_language_surcharge"),
            F.when(key % 5 == 0, F.lit("120.50").cast(MONEY)).alias("overtime_fee"),
            F.when(key % 7 == 0, F.lit("66.60").cast(MONEY)).alias("tip_amount"),
            total.alias("total_amount"),
            share("0.25").alias("deposit_amount"),
            F.when(key % 13 != 0, key % 4 != 0).alias("deposit_paid"),
            F.when(key % 10 == 1, share("0.30")).when(key % 10 != 0, share("0.25")).alias("platform_fee"),
            F.when(key % 10 == 1, share("0.70")).when(key % 10 != 0, share("0.75")).alias("driver_earning"),
            F.when(rider % 8 == 0, _id("TP", rider % 40)).alias("tour_package_id"),
            F.when(rider % 8 == 0, _id("Tour ", rider % 40)).alias("tour_package_name"),
            F.when(promo, _id("P", rider % 20)).alias("promo_code"),
            F.when(promo, _id("I", rider % 20)).alias("influencer_id"),
            F.when(promo, share("0.05")).alias("influencer_commission"),
            F.when(promo, total + F.lit(1000)).cast(MONEY).alias("original_price"),
            F.when(promo, F.lit(1000)).cast(MONEY).alias("discount_amount"),
            F.when(promo, total).alias("final_price"),
            F.when(rider % 7 == 0, F.lpad(rider.cast("string"), 8, "0")).when(rider % 7 == 1, rider.cast("string")).alias("tax_id"),
            F.when(rider % 5 == 4, "JP").when(rider % 5 != 3, "TW").alias("country"),
            F.when(rider % 4 == 0, "north").when(rider % 4 == 1, "south").alias("region"),
            F.when(priority.isin("1-URGENT", "2-HIGH"), "instant_ride").when(priority != "5-LOW", "charter").alias("service_type"),
            F.col("o_orderdate").alias("created_at"),
            _plus("o_orderdate", "1 DAY").alias("updated_at"),
            F.when(state != "O", _plus("o_orderdate", "20 HOURS")).alias("actual_start_time"),
            F.when(done & (key % 3 != 0), _plus("o_orderdate", "23 HOURS")).alias("actual_end_time"),
            F.when(done, _plus("o_orderdate", "1 DAY")).alias("completed_at"),
        )

    @cached_property
    def changes(self) -> DataFrame:
        """The booking change log, with the booking's columns on every change.

        A booking is created, reaches its status a day later, and some completed ones are
        reopened and completed again. Some are completed at creation.
        """
        done = F.col("final_status") == "completed"

        def step(version: int, status: Column, interval: str) -> Column:
            return F.struct(
                F.lit(version).alias("version"), status.alias("status"), _plus("created_at", interval).alias("changed_at")
            )

        first = F.when(done & (F.col("duration_hours") == 7), "completed").otherwise("pending_payment")
        steps = [step(1, first, "0 DAYS"), step(2, F.col("final_status"), "1 DAY")]
        again = [step(3, F.lit("pending_balance"), "2 DAYS"), step(4, F.lit("completed"), "3 DAYS")]
        log = F.when(done & (F.col("vehicle_type") == "large"), F.array(*steps, *again)).otherwise(F.array(*steps))
        rows = self.bookings.withColumnRenamed("status", "final_status")
        return rows.select("*", F.inline(log)).drop("final_status")

    @cached_property
    def changes_with_deletes(self) -> DataFrame:
        """The change log with ``op``; the bookings of five passengers are deleted at the end."""
        log = self.changes.withColumn("op", F.lit("write"))
        deleted = self.bookings.filter(F.col("passenger_count") == 5).withColumns(
            {"version": F.lit(9), "changed_at": _plus("created_at", "9 DAYS"), "op": F.lit("delete")}
        )
        return log.unionByName(deleted)

    # --- commissions ----------------------------------------------------------------

    @cached_property
    def influencers(self) -> DataFrame:
        k = F.col("k")
        return self.table("customer").select((F.col("c_custkey") % 20).alias("k")).distinct().select(
            _id("I", k).alias("id"),
            (1000 + 100 * k).cast(MONEY).alias("commission_fixed"),
            (5 + k.cast("decimal(4,0)") * F.lit("0.125").cast("decimal(4,3)")).cast(RATE).alias("commission_percent"),
            (k % 4 == 0).alias("is_commission_fixed_active"),
            (k % 5 != 1).alias("is_commission_percent_active"),
            F.when(k % 2 == 0, "unified").otherwise("by_service_type").alias("commission_type"),
            F.when(k % 3 != 0, F.lit("4.5").cast(RATE)).alias("commission_percent_charter"),
            F.when(k % 3 != 1, F.lit("6.25").cast(RATE)).alias("commission_percent_instant_ride"),
            (k != 7).alias("is_active"),
            F.concat(F.lit("Influencer "), k.cast("string")).alias("name"),
        )

    @cached_property
    def referrals(self) -> DataFrame:
        key = F.col("c_custkey")
        return self.table("customer").filter(F.col("c_acctbal") >= 2000).select(
            _id("C", key).alias("referee_id"),
            _id("C", F.floor(key / 2).cast("bigint")).alias("referrer_id"),
            _id("I", key % 20).alias("influencer_id"),
            _id("P", key % 20).alias("promo_code"),
            F.lit(None).cast("string").alias("first_booking_id"),
        )

    @cached_property
    def referral_claims(self) -> DataFrame:
        """Every use of somebody's code; the first one of a rider binds them."""
        key = F.col("o_custkey")
        return self.table("orders").select(
            _id("B", "o_orderkey").alias("claim_id"),
            _id("C", key).alias("referee_id"),
            _id("C", F.col("o_orderkey") % 50).alias("referrer_id"),
            _id("P", F.col("o_orderkey") % 20).alias("promo_code"),
            F.col("o_orderdate").alias("created_at"),
        )

    @cached_property
    def driver_affiliates(self) -> DataFrame:
        key, nation = F.col("s_suppkey"), F.col("s_nationkey")
        return self.table("supplier").filter(F.col("s_acctbal") >= 1000).select(
            _id("D", key).alias("driver_id"),
            F.when(nation % 8 == 0, "suspended").otherwise("active").alias("affiliate_status"),
            (nation % 9 != 1).alias("is_active"),
            (key % 2 == 0).alias("commission_fixed_enabled"),
            (key % 4 * 2000).cast(MONEY).alias("commission_fixed"),
            (nation % 10 != 3).alias("commission_percent_enabled"),
            F.lit("1.5").cast(RATE).alias("commission_percent"),
            F.when(nation > 15, F.lit("2").cast(RATE)).alias("commission_percent_charter"),
            F.when(nation < 10, F.lit("3.25").cast(RATE)).alias("commission_percent_instant_ride"),
        )

    @cached_property
    def driver_referrals(self) -> DataFrame:
        key = F.col("s_suppkey")
        half = F.floor(key / 2).cast("bigint")
        return self.table("supplier").filter(half != key).select(
            _id("D", half).alias("referrer_driver_id"), _id("D", key).alias("referee_driver_id"), _id("Q", half).alias("promo_code")
        )

    @cached_property
    def rules(self) -> DataFrame:
        names = "id, country, region, service_type, has_promo_code, c, d, b, is_active, priority, since"
        return self.spark.sql(f"SELECT * FROM VALUES {RULES} AS t({names})").select(
            "id", "country", "region", "service_type", "has_promo_code",
            F.col("c").cast("decimal(5,2)").alias("company_percentage"),
            F.col("d").cast("decimal(5,2)").alias("driver_percentage"),
            F.col("b").cast("decimal(5,2)").alias("company_base_percentage"),
            "is_active", "priority",
            F.to_timestamp_ntz("since", F.lit("yyyy-MM-dd")).alias("created_at"),
        )

    @cached_property
    def settings(self) -> DataFrame:
        return self.spark.sql(f"SELECT * FROM VALUES {SETTINGS} AS t(key, value)")

    @cached_property
    def usage(self) -> DataFrame:
        """Recorded uses of a promo code, some already accrued."""
        b = self.bookings.filter(F.col("promo_code").isNotNull())
        return b.select(
            F.col("id").alias("booking_id"),
            "influencer_id",
            "promo_code",
            "original_price",
            F.col("discount_amount").alias("discount_amount_applied"),
            "final_price",
            F.lit(0).cast(MONEY).alias("commission_amount"),
            F.when(F.col("duration_hours") == 5, "completed").when(F.col("duration_hours") != 6, "pending").alias("commission_status"),
            F.lit(None).cast("string").alias("commission_type"),
            F.lit(None).cast(RATE).alias("commission_rate"),
            F.lit(None).cast(MONEY).alias("order_amount"),
            F.lit(None).cast("string").alias("referee_id"),
            F.col("created_at").alias("used_at"),
        )

    # --- event log ------------------------------------------------------------------

    @cached_property
    def outbox(self) -> DataFrame:
        key, kind = F.col("event_id"), F.col("event_type")
        open_ = key % 4 == 0
        return self.table("events").select(
            key.cast("string").alias("id"),
            F.when(kind == "error", "other").when(kind == "click", "chat_message").otherwise("booking").alias("aggregate_type"),
            _id("B", "user_id").alias("aggregate_id"),
            F.when(key % 17 == 0, "deleted").when(kind == "signup", "created").otherwise("updated").alias("event_type"),
            F.col("props").alias("payload"),
            F.col("value").cast(MONEY).alias("amount"),
            F.col("ts").alias("created_at"),
            F.when(~open_, F.col("ts") + F.make_dt_interval(secs=(key % 120).cast("decimal(18,6)"))).alias("processed_at"),
            F.when(open_, key % 5).otherwise(0).cast("int").alias("retry_count"),
        )

    @cached_property
    def delivery_attempts(self) -> DataFrame:
        """Two write attempts per event, one per target collection."""
        key = F.col("event_id")
        targets = F.array(
            F.struct(F.lit("orders_rt").alias("target"), (key % 5 != 0).alias("ok")),
            F.struct(F.lit("bookings").alias("target"), (F.col("value") > 10).alias("ok")),
        )
        return self.table("events").select(key.cast("string").alias("event_id"), F.inline(targets))

    @cached_property
    def delivery_answers(self) -> DataFrame:
        """What the two targets answered in four rounds of tries, whether an event was still due or not."""
        key, number = F.col("event_id"), F.col("round")
        sent = F.to_timestamp_ntz(F.lit("2024-01-29 00:00:00"), F.lit("yyyy-MM-dd HH:mm:ss"))
        targets = F.array(
            F.struct(F.lit("orders_rt").alias("target"), ((key + number) % 4 == 0).alias("ok")),
            F.struct(F.lit("bookings").alias("target"), ((key + 2 * number) % 5 == 0).alias("ok")),
        )
        rounds = self.table("events").select("event_id", F.explode(F.sequence(F.lit(1), F.lit(4))).alias("round"))
        return rounds.select(
            key.cast("string").alias("event_id"), "round", F.inline(targets),
        ).withColumn("at", sent + F.make_dt_interval(mins=F.col("round")))

    @cached_property
    def place_cache(self) -> DataFrame:
        return self.table("events").filter(F.col("event_type").isin("signup", "view")).select(
            F.col("event_id").cast("string").alias("id"),
            _id("place ", "user_id").alias("search_query"),
            F.when(F.col("event_type") == "view", "en").otherwise("zh").alias("language_code"),
            _id("Place ", "event_id").alias("name"),
            F.col("ts").alias("created_at"),
        )

    @cached_property
    def place_requests_timed(self) -> DataFrame:
        """Requests of every hour of the log, each with its own time."""
        return self.table("events").filter(F.col("event_type").isin("click", "purchase")).select(
            F.col("event_id").cast("string").alias("request_id"),
            F.when(F.col("event_id") % 50 != 0, _id("place ", "user_id")).alias("search_query"),
            F.when(F.col("value") > 30, "en").otherwise("zh").alias("language_code"),
            F.col("ts").alias("requested_at"),
        )

    @cached_property
    def place_requests(self) -> DataFrame:
        return self.table("events").filter(F.col("event_type") == "click").select(
            F.col("event_id").cast("string").alias("request_id"),
            _id("place ", "user_id").alias("search_query"),
            F.when(F.col("value") > 30, "en").otherwise("zh").alias("language_code"),
        )

    @cached_property
    def chat_events(self) -> DataFrame:
        """Chat messages as change events: created, translated later, short ones withdrawn."""
        sent = F.to_timestamp_ntz(F.lit("2024-01-01 00:00:00"), F.lit("yyyy-MM-dd HH:mm:ss"))
        at = sent + F.make_dt_interval(days=(F.col("conv_id") % 30).cast("int"), mins=F.col("turn").cast("int"))
        base = self.table("conversations").select(
            _id("B", "conv_id").alias("booking_id"),
            F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("message_id"),
            F.when(F.col("role") == "user", _id("C", "conv_id")).otherwise(_id("D", "conv_id")).alias("sender_id"),
            F.when(F.col("role") == "user", _id("D", "conv_id")).otherwise(_id("C", "conv_id")).alias("receiver_id"),
            F.when(F.col("role") != "system", F.concat(F.lit("the "), "role")).alias("sender_name"),
            F.lit(None).cast("string").alias("receiver_name"),
            F.col("text").alias("message_text"),
            F.col("role"),
            at.alias("message_at"),
            F.when(F.col("turn") < 2, at + F.expr("INTERVAL 1 HOUR")).alias("read_at"),
        )

        def event(kind: str, order: int, delay: str, translated: Column) -> Column:
            return F.struct(
                F.lit(kind).alias("event_type"), F.lit(order).alias("seq"),
                (F.col("message_at") + F.expr(f"INTERVAL {delay}")).alias("created_at"),
                translated.alias("translated_text"),
            )

        none = F.lit(None).cast("string")
        created = event("created", 1, "0 SECONDS", none)
        translated = event("updated", 2, "5 SECONDS", F.concat(F.lit("["), "message_text", F.lit("]")))
        withdrawn = event("deleted", 3, "9 SECONDS", none)
        log = F.filter(
            F.array(
                created,
                F.when(F.col("role") == "assistant", translated),
                F.when(F.length("message_text") < 60, withdrawn),
            ),
            lambda e: e.isNotNull(),
        )
        return base.select("*", F.inline(log)).drop("role")

    # --- payments -------------------------------------------------------------------

    @cached_property
    def payments(self) -> DataFrame:
        key = F.col("o_orderkey")
        statuses = ("pending", "processing", "completed", "failed", "cancelled", "expired", "refunded")
        status = F.element_at(F.array(*(F.lit(s) for s in statuses)), (key % 7 + 1).cast("int"))
        return self.table("orders").select(
            _id("T", key).alias("transaction_id"),
            _id("B", key).alias("booking_id"),
            _id("C", "o_custkey").alias("customer_id"),
            F.when(key % 3 == 0, "deposit").when(key % 3 == 1, "balance").otherwise("tip").alias("type"),
            (_money("o_totalprice") * F.lit("0.25").cast("decimal(3,2)")).cast(MONEY).alias("amount"),
            F.lit("TWD").alias("currency"),
            status.alias("status"),
            F.col("o_orderdate").alias("created_at"),
            _plus("o_orderdate", "30 MINUTES").alias("expires_at"),
            F.when(key % 7 == 2, _plus("o_orderdate", "10 MINUTES")).alias("confirmed_at"),
        )

    @cached_property
    def payment_states(self) -> DataFrame:
        """Each payment as it began, and as it is."""
        steps = F.array(
            F.struct(F.lit("pending").alias("status"), F.col("created_at").alias("status_at")),
            F.struct(F.col("final").alias("status"), _plus("created_at", "10 MINUTES").alias("status_at")),
        )
        rows = self.payments.withColumnRenamed("status", "final")
        return rows.select("transaction_id", "booking_id", "created_at", F.inline(steps))

    @cached_property
    def payment_requests(self) -> DataFrame:
        """Payment intents from line items: some bookings do not exist, some amounts are not positive."""
        key = F.col("l_orderkey")
        return self.table("lineitem").select(
            F.concat_ws("-", key.cast("string"), F.col("l_linenumber").cast("string")).alias("request_id"),
            F.when(F.col("l_tax") > 0.07, F.lit("")).when(F.col("l_quantity") > 48, _id("X", key)).otherwise(_id("B", key)).alias("booking_id"),
            F.when(F.col("l_discount") < 0.09, _id("C", "l_suppkey")).alias("customer_id"),
            (F.col("l_extendedprice") - 2000).cast(MONEY).alias("amount"),
            F.when(F.col("l_linestatus") == "O", "TWD").when(F.col("l_tax") > 0.01, "JPY").alias("currency"),
            F.when(F.col("l_returnflag") == "A", "deposit")
            .when(F.col("l_returnflag") == "N", "balance")
            .when(F.col("l_linestatus") == "O", "tip")
            .otherwise("voucher")
            .alias("payment_type"),
            F.col("l_shipdate").alias("requested_at"),
        )

    @cached_property
    def webhooks(self) -> DataFrame:
        kind = F.col("event_type")
        return self.table("events").select(
            F.col("event_id").cast("string").alias("webhook_id"),
            F.when(F.col("value") > 1, _id("T", "user_id")).otherwise("").alias("transaction_id"),
            F.when(F.col("event_id") % 9 != 0, _id("ext-", "event_id")).alias("external_transaction_id"),
            F.when(kind == "signup", "pending")
            .when(kind == "click", "processing")
            .when(kind == "purchase", "completed")
            .when(kind == "view", "failed")
            .otherwise("invalid-status")
            .alias("status"),
            (F.col("value") - 5).cast(MONEY).alias("amount"),
            F.lit("TWD").alias("currency"),
            F.col("ts").alias("sent_at"),
        )

    @cached_property
    def confirmations(self) -> DataFrame:
        """Confirm requests: two per payment, and one for a transaction nobody knows per processed one."""
        key = F.col("o_orderkey")
        tries = F.array(
            F.struct(F.lit("1").alias("n"), F.lit("T").alias("p"), (key % 45).cast("int").alias("wait")),
            F.struct(F.lit("2").alias("n"), F.lit("T").alias("p"), F.lit(25).alias("wait")),
            F.struct(F.lit("3").alias("n"), F.lit("U").alias("p"), F.lit(5).alias("wait")),
        )
        return self.table("orders").select("o_orderkey", "o_orderdate", F.inline(tries)).select(
            F.concat_ws("-", key.cast("string"), "n").alias("request_id"),
            F.concat("p", key.cast("string")).alias("transaction_id"),
            (F.col("o_orderdate") + F.make_dt_interval(mins=F.col("wait"))).alias("requested_at"),
        )

    # --- driver files ---------------------------------------------------------------

    @cached_property
    def driver_documents(self) -> DataFrame:
        names = F.array(*(F.lit(n) for n in DOCUMENT_NAMES))
        flag = F.col("l_returnflag")
        return self.table("lineitem").select(
            _id("D", "l_suppkey").alias("driver_id"),
            F.element_at(names, (F.col("l_partkey") % len(DOCUMENT_NAMES) + 1).cast("int")).alias("type"),
            F.concat_ws("/", F.lit("doc"), F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("url"),
            F.when(flag == "A", "approved").when(flag == "N", "pending").otherwise("rejected").alias("status"),
            F.col("l_shipdate").alias("uploaded_at"),
        )

    @cached_property
    def driver_documents_wide(self) -> DataFrame:
        """The wide document table: seven URL columns, some not yet handed in."""
        nation, names = F.col("s_nationkey"), list(WIDE_DOCUMENT_COLUMNS)

        def url(i: int, column: str) -> Column:
            value = F.concat_ws("/", F.lit("doc"), F.col("s_suppkey").cast("string"), F.lit(column))
            return F.when((nation + i) % 4 != 0, value).alias(column)

        return self.table("supplier").select(_id("D", "s_suppkey").alias("driver_id"), *(url(i, c) for i, c in enumerate(names)))

    @cached_property
    def bank_accounts(self) -> DataFrame:
        """Where drivers are paid; some have handed in a second account."""
        nation = F.col("s_nationkey")
        codes = F.when(nation % 6 == 0, F.array(F.lit("004"), F.lit("822"))).otherwise(F.array(F.lit("004")))
        return self.table("supplier").filter(F.col("s_acctbal") >= 0).select(
            _id("D", "s_suppkey").alias("driver_id"), F.explode(codes).alias("bank_code"),
            F.lpad(F.col("s_suppkey").cast("string"), 12, "0").alias("account_number"), F.col("s_name").alias("account_holder_name"),
        )

    @cached_property
    def driver_photos_wide(self) -> DataFrame:
        """The wide photo table: nine URL columns, the rear seats missing on small vehicles."""
        small = F.col("s_acctbal") < 5000

        def url(column: str) -> Column:
            value = F.concat_ws("/", F.lit("photo"), F.col("s_suppkey").cast("string"), F.lit(column))
            return F.when(~small, value) if "rear" in column else value

        return self.table("supplier").select(
            _id("D", "s_suppkey").alias("driver_id"), *(url(c).alias(c) for c in WIDE_PHOTO_COLUMNS)
        )


class StreamingMarketplace(Marketplace):
    """The same entities with one table read as a stream."""

    def __init__(self, spark: SparkSession, directory: str, streamed: str, max_files: int | None = None) -> None:
        super().__init__(spark, directory)
        self.streamed = streamed
        self.max_files = max_files

    def table(self, name: str) -> DataFrame:
        static = super().table(name)
        if name != self.streamed:
            return static
        reader = self.spark.readStream.schema(static.schema)
        if self.max_files:
            reader = reader.option("maxFilesPerTrigger", self.max_files)
        # written as a glob, so that the table may be one file or a folder of files
        return reader.parquet(f"{self.directory}/{{{name}}}.parquet")
