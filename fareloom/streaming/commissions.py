"""Commissions as a stream: edges, one accrual per booking and scheme, ledger and running totals.

``history.AccrualChanges`` keeps each booking's versions and puts out which change each scheme pays for,
again if a version that arrives later makes it another one. A micro-batch of those is valued with the same
functions as the batch ledger (referrals, influencers, rules and affiliates are static tables) and written
to the ledger's folder. Beside it, the batch's sums per scheme, beneficiary and day are written with their
sign: what an accrual adds, less what the ledger held for it before. The totals are the sums over all folders, so late
and corrected accruals need no special care, and no state grows with the number of beneficiaries.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fareloom.operators import commission, split
from fareloom.operators.joins import newest
from fareloom.schemas import MONEY, RATE, TOTAL
from fareloom.sources.sinks import read_batches, write_batch
from fareloom.streaming.history import accrual_changes
from fareloom.streaming.run import start

#: What the schemes need to know of a booking.
BOOKING = "customer_id string, driver_id string, country string, service_type string, influencer_id string, promo_code string, total_amount decimal(10,2)"
COLUMNS = tuple(field.strip().split(" ")[0] for field in BOOKING.replace("(10,2)", "").split(","))

LEDGER = ["scheme", "booking_id", "beneficiary_id", "base_amount", "rate", "type", "amount", "accrued_at"]


class Terms(NamedTuple):
    """The tables that decide who earns how much."""

    referrals: DataFrame
    influencers: DataFrame
    rules: DataFrame
    settings: DataFrame
    driver_referrals: DataFrame
    driver_affiliates: DataFrame
    #: Bookings (``booking_id``) that the affiliate scheme has paid before the stream began.
    accrued: DataFrame


def _valued(due: DataFrame, terms: Terms) -> DataFrame:
    """Ledger rows of the accruals (id, version, changed_at and the booking's columns) of a batch."""
    affiliate = due.filter(F.col("scheme") == "affiliate")
    affiliate = affiliate.join(terms.accrued.select(F.col("booking_id").alias("id")).distinct(), "id", "left_anti")
    paid = commission.affiliate_ledger(affiliate, affiliate, terms.referrals, terms.influencers)
    completed = due.filter(F.col("scheme") == "driver_referral").withColumn("completed_at", F.col("changed_at"))
    shares = split.split_bookings(completed.drop("scheme", "version", "changed_at"), terms.rules, terms.settings, terms.influencers)
    referred = commission.driver_referral_commission(shares, terms.driver_referrals, terms.driver_affiliates, keys_from=completed)
    both = paid.unionByName(commission.referral_ledger(referred), allowMissingColumns=True)
    return both.select(
        "scheme", "booking_id", "beneficiary_id", F.col("base_amount").cast(MONEY).alias("base_amount"), F.col("rate").cast(RATE).alias("rate"),
        "type", F.col("amount").cast(MONEY).alias("amount"), "accrued_at",
    )


def _sums(rows: DataFrame, sign: int) -> DataFrame:
    return rows.groupBy("scheme", "beneficiary_id", F.to_date("accrued_at").alias("date")).agg(
        (sign * F.sum("amount")).cast(TOTAL).alias("amount"), (sign * F.count(F.lit(1))).alias("n_commissions")
    )


def write_commissions(changes: DataFrame, terms: Terms, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Keep ledger and totals of a stream of booking changes."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        write_batch(batch, f"{path}/accruals", batch_id)
        moved = spark.read.schema(batch.schema).parquet(f"{path}/accruals/batch={batch_id}")
        parsed = moved.filter(F.col("version").isNotNull()).withColumn("b", F.from_json("row", BOOKING))
        rows = _valued(parsed.select("scheme", F.col("booking_id").alias("id"), "version", "changed_at", "b.*"), terms)
        # an accrual that no longer stands, or earns nothing now, replaces what was there by an empty row
        keys = moved.select("scheme", "booking_id", "corrects")
        write_batch(keys.join(rows, ["scheme", "booking_id"], "left").select(*LEDGER, "corrects"), f"{path}/ledger", batch_id)
        written = read_batches(spark, f"{path}/ledger")
        here = written.filter(F.col("batch") == batch_id)
        sums = _sums(here.filter(F.col("amount").isNotNull()), 1)
        corrected = here.filter("corrects").select("scheme", "booking_id")
        if not corrected.isEmpty():
            before = written.filter(F.col("batch") < batch_id).join(corrected, ["scheme", "booking_id"], "left_semi")
            old = newest(before, ["scheme", "booking_id"], ["batch"]).filter(F.col("amount").isNotNull())
            sums = sums.unionByName(_sums(old, -1))
        write_batch(sums, f"{path}/totals", batch_id)

    return start(accrual_changes(changes, COLUMNS), sink, checkpoint, every=every, by_clock=True)


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """The commissions that stand after all batches, one per scheme and booking."""
    rows = newest(read_batches(spark, f"{path}/ledger"), ["scheme", "booking_id"], ["batch"])
    return rows.filter(F.col("amount").isNotNull()).select(*LEDGER)


def totals(spark: SparkSession, path: str, by_day: bool = False) -> DataFrame:
    """Running totals per scheme and beneficiary, and per day if asked for."""
    keys = ["scheme", "beneficiary_id", *(["date"] if by_day else [])]
    sums = read_batches(spark, f"{path}/totals").groupBy(*keys).agg(
        F.sum("amount").cast(TOTAL).alias("total_earnings"), F.sum("n_commissions").alias("n_commissions")
    )
    return sums.filter("n_commissions > 0")
