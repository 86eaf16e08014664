import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from fareloom.operators import commission, quality, split

T0 = dt.datetime(2026, 1, 20, 9)

RULES = (
    "id string, country string, region string, service_type string, has_promo_code boolean, company_percentage decimal(5,2),"
    " driver_percentage decimal(5,2), company_base_percentage decimal(5,2), is_active boolean, priority int, created_at timestamp_ntz"
)
BOOKINGS = (
    "id string, customer_id string, driver_id string, country string, region string, service_type string, promo_code string,"
    " influencer_id string, total_amount decimal(10,2)"
)
INFLUENCERS = (
    "id string, is_active boolean, commission_type string, commission_fixed decimal(10,2), commission_percent decimal(9,6),"
    " commission_percent_charter decimal(9,6), commission_percent_instant_ride decimal(9,6),"
    " is_commission_fixed_active boolean, is_commission_percent_active boolean"
)
AFFILIATES = (
    "driver_id string, affiliate_status string, is_active boolean, commission_fixed_enabled boolean, commission_fixed decimal(10,2),"
    " commission_percent_enabled boolean, commission_percent decimal(9,6), commission_percent_charter decimal(9,6),"
    " commission_percent_instant_ride decimal(9,6)"
)
CHANGES = "id string, version int, status string, changed_at timestamp_ntz, customer_id string, influencer_id string, promo_code string, total_amount decimal(10,2)"
REFERRALS = "referee_id string, influencer_id string, promo_code string"


def rules(spark, *extra):
    seed = [
        ("S1", "TW", None, "charter", False, D(25), D(75), None, True, 0, T0),
        ("S2", "TW", None, "charter", True, D(30), D(70), D(30), True, 0, T0),
    ]
    return spark.createDataFrame([*seed, *extra], RULES)


def settings(spark, **values):
    return spark.createDataFrame([(k, v) for k, v in values.items()], "key string, value string")


def influencers(spark):
    return spark.createDataFrame(
        [
            ("A", True, "unified", D(0), D(5), None, None, False, True),
            ("B", True, "by_service_type", D(300), D(5), D("4.125"), None, False, True),
            ("F", True, "unified", D(700), D(5), None, None, True, True),
            ("N", True, "unified", D(700), D(5), None, None, False, False),
            ("X", False, "unified", D(0), D(10), None, None, False, True),
        ],
        INFLUENCERS,
    )


def booking(id="1", promo="QQQ111", influencer="A", total=D(2000), service="charter", country="TW", region=None, driver="d2"):
    return (id, "c" + id, driver, country, region, service, promo, influencer, total)


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_worked_split_and_referral(spark):
    """2000 with code: fee 600 less 100 for the influencer, then 1.5 % of 500 for the referrer."""
    rows = split.split_bookings(
        spark.createDataFrame([booking()], BOOKINGS), rules(spark), settings(spark, x="{}"), influencers(spark)
    )
    r = one(rows)
    assert (r.platform_fee_gross, r.driver_earning, r.influencer_commission, r.platform_fee) == (D("600.00"), D("1400.00"), D("100.00"), D("500.00"))
    affiliates = spark.createDataFrame([("d1", "active", True, False, D(0), True, D("1.5"), None, None)], AFFILIATES)
    referrals = spark.createDataFrame([("d1", "d2")], "referrer_driver_id string, referee_driver_id string")
    done = rows.withColumn("completed_at", F.lit(T0))
    r = one(commission.driver_referral_commission(done, referrals, affiliates))
    assert (r.driver_referral_commission, r.platform_fee, r.driver_referrer_id) == (D("7.50"), D("492.50"), "d1")
    strict = one(commission.driver_referral_commission(done, referrals, affiliates, "strict"))
    assert (strict.driver_referral_commission, strict.driver_referrer_id) == (D("0.00"), None)


def test_commission_shapes(spark):
    data = [
        booking("fixed", influencer="F"),
        booking("service", influencer="B"),
        booking("fallback", influencer="B", service="instant_ride"),
        booking("none", influencer="N"),
        booking("unknown", influencer="??"),
        booking("nobody", influencer=None),
        booking("null", total=None),
    ]
    got = {r.id: r for r in split.influencer_commission(spark.createDataFrame(data, BOOKINGS), influencers(spark)).collect()}
    assert (got["fixed"].influencer_commission_type, got["fixed"].influencer_commission) == ("fixed", D("700.00"))
    # 4.125 % is narrowed to 4.13 % before it is applied
    assert (got["service"].influencer_commission_rate, got["service"].influencer_commission) == (D("4.13"), D("82.60"))
    assert got["fallback"].influencer_commission == D("100.00")
    assert (got["none"].influencer_commission_type, got["none"].influencer_commission) == ("none", D("0.00"))
    assert got["unknown"].influencer_commission_type == "none"
    assert got["nobody"].influencer_commission_type is None
    assert got["null"].influencer_commission == D("0.00")


def test_fee_may_go_negative_and_needs_a_code(spark):
    data = [booking("neg", influencer="F", total=D(1000)), booking("nocode", promo="", influencer="F", total=D(1000))]
    rows = split.financial_split(spark.createDataFrame(data, BOOKINGS), rules(spark), settings(spark, x="{}"), influencers(spark))
    got = {r.id: r for r in rows.collect()}
    assert got["neg"].platform_fee == D("-400.00")
    assert got["nocode"].platform_fee == D("250.00")


def test_rule_then_settings_then_default(spark):
    data = [booking("rule"), booking("settings", country="JP"), booking("default", country="JP", promo=None)]
    df = spark.createDataFrame(data, BOOKINGS)
    conf = settings(spark, revenue_share_with_promo='{"company_base_percentage": 40, "driver_percentage": 60}')
    got = {r.id: (r.share_origin, r.company_percentage, r.driver_percentage) for r in split.revenue_share_fallback(df, rules(spark), conf).collect()}
    assert got == {
        "rule": ("rule", D("30.00"), D("70.00")),
        "settings": ("settings", D("40.00"), D("60.00")),
        "default": ("default", D("25.00"), D("75.00")),
    }
    partial = settings(spark, revenue_share_with_promo='{"driver_percentage": 60}')
    got = {r.id: r.company_percentage for r in split.revenue_share_fallback(df, rules(spark), partial).collect()}
    assert got["settings"] is None  # chosen per row, not per column


def test_strict_record_semantics_ignores_a_rule_with_an_empty_field(spark):
    odd = ("S3", "TW", None, "instant_ride", False, D(10), D(90), None, True, 0, T0)
    df = spark.createDataFrame([booking(service="instant_ride", promo=None)], BOOKINGS)
    none = settings(spark, x="{}")
    assert one(split.revenue_share_fallback(df, rules(spark, odd), none)).company_percentage == D("10.00")
    assert one(split.revenue_share_fallback(df, rules(spark, odd), none, "strict")).company_percentage == D("25.00")
    with pytest.raises(ValueError):
        split.revenue_share_fallback(df, rules(spark), none, "other")


def test_rule_lookup_equals_order_by_limit_one(spark):
    import random

    rng = random.Random(7)
    pool = [
        (f"r{i:02}", rng.choice(["TW", "JP"]), rng.choice([None, "n", "s"]), rng.choice(["charter", "instant_ride"]),
         rng.random() < 0.5, D(i), D(100 - i), None, rng.random() < 0.8, rng.choice([None, 0, 1]),
         rng.choice([None, T0, T0 + dt.timedelta(days=1)]))
        for i in range(60)
    ]
    data = [
        booking(str(i), promo=rng.choice([None, "", "P"]), country=rng.choice(["TW", "JP", None]), region=rng.choice([None, "n", "s", "w"]),
                service=rng.choice(["charter", "instant_ride", None]))
        for i in range(300)
    ]
    df = spark.createDataFrame(data, BOOKINGS)
    table = spark.createDataFrame(pool, RULES)

    def best(b):
        hits = [
            r for r in pool
            if r[8] and r[1] == (b[3] or "TW") and r[2] in (None, b[4]) and r[3] == (b[5] or "charter") and r[4] == bool(b[6])
        ]
        key = lambda r: (r[2] is not None, r[9] is None, r[9] or 0, r[10] is None, r[10] or T0, r[0])
        return max(hits, key=key)[0] if hits else None

    want = {b[0]: best(b) for b in data}
    for limit in (1 << 40, -1):
        assert {r.id: r.rule_id for r in split.revenue_share_lookup(df, table, limit).collect()} == want


def changes(spark, *rows):
    full = [(i, v, s, T0 + dt.timedelta(hours=v), "c1" if len(r) == 0 else r[0], "C", "P", D(2000)) for i, v, s, *r in rows]
    return spark.createDataFrame(full, CHANGES)


def test_edges(spark):
    log = changes(
        spark, ("a", 1, "pending_payment"), ("a", 2, "completed"), ("a", 3, "completed"), ("a", 4, "pending_balance"), ("a", 9, "completed"),
        ("b", 1, "completed"), ("b", 2, "completed"), ("c", 1, "matched"), ("c", 2, "cancelled"),
    )
    for size in (1, 4, 4096):
        got = {(r.booking_id, r.version, r.previous_status, r.is_insert) for r in commission.completion_edges(log, size).collect()}
        assert got == {("a", 2, "pending_payment", False), ("a", 9, "pending_balance", False), ("b", 1, None, True)}


def golden(spark):
    log = spark.createDataFrame(
        [
            ("o1", 1, "pending_payment", T0, "c1", "Z", "Z9", D(2000)),
            ("o1", 2, "completed", T0 + dt.timedelta(hours=1), "c1", "Z", "Z9", D(2000)),
            ("o1", 3, "trip_ended", T0 + dt.timedelta(hours=2), "c1", "Z", "Z9", D(2000)),
            ("o1", 4, "completed", T0 + dt.timedelta(hours=3), "c1", "Z", "Z9", D(2000)),
            ("o2", 1, "trip_ended", T0, "c1", None, None, D(2800)),
            ("o2", 2, "completed", T0 + dt.timedelta(hours=1), "c1", None, None, D(2800)),
            ("o3", 1, "completed", T0, "c1", None, None, D(999)),
            ("o4", 1, "matched", T0, "c9", None, None, D(50)),
            ("o4", 2, "completed", T0, "c9", None, None, D(50)),
            ("o5", 1, "matched", T0, "cx", None, None, D(50)),
            ("o5", 2, "completed", T0, "cx", None, None, D(50)),
        ],
        CHANGES,
    )
    refs = spark.createDataFrame([("c1", "A", "QQQ111"), ("cx", "X", "XXX")], REFERRALS)
    return log, refs, influencers(spark)


def test_golden_affiliate_commissions(spark):
    """2000 and 2800 at 5 %: 100 and 140, 240 in all; a second completion earns nothing more."""
    log, refs, infl = golden(spark)
    ledger = commission.affiliate_commission(log, refs, infl)
    assert {(r.booking_id, r.amount) for r in ledger.collect()} == {("o1", D("100.00")), ("o2", D("140.00"))}
    total = commission.beneficiary_totals(ledger, infl.select(F.col("id").alias("influencer_id")), "influencer_id")
    got = {r.influencer_id: (r.total_earnings, r.n_commissions) for r in total.collect()}
    assert got["A"] == (D("240.00"), 2)
    assert got["N"] == (D("0.00"), 0)


def test_replay_changes_nothing(spark):
    log, refs, infl = golden(spark)
    once = commission.affiliate_commission(log, refs, infl)
    assert commission.affiliate_commission(log, refs, infl, accrued=once).count() == 0


def test_decision_log(spark):
    log, refs, infl = golden(spark)
    got = {(r.booking_id, r.version): r.reason_code for r in commission.commission_decision_log(log, refs, infl).collect()}
    assert got == {
        ("o1", 2): "accrued", ("o1", 3): "not_completed", ("o1", 4): "duplicate", ("o2", 2): "accrued",
        ("o4", 2): "no_referral", ("o5", 2): "influencer_inactive",
    }


def test_attribution_first_referrer_or_code_owner(spark):
    log, refs, infl = golden(spark)
    infl = infl.unionByName(spark.createDataFrame([("Z", True, "unified", D(0), D(5), None, None, False, True)], INFLUENCERS))
    first = {r.booking_id: r.beneficiary_id for r in commission.affiliate_commission(log, refs, infl).collect()}
    owner = {r.booking_id: r.beneficiary_id for r in commission.affiliate_commission(log, refs, infl, attribution="code_owner").collect()}
    assert first == {"o1": "A", "o2": "A"}
    assert owner == {"o1": "Z"}
    with pytest.raises(ValueError):
        commission.affiliate_commission(log, refs, infl, attribution="other")


def test_binding_is_first_and_never_to_oneself(spark):
    claims = spark.createDataFrame(
        [("k1", "u", "u", T0), ("k2", "u", "v", T0 + dt.timedelta(1)), ("k3", "u", "w", T0 + dt.timedelta(2)), ("k4", "x", "x", T0)],
        "claim_id string, referee_id string, referrer_id string, created_at timestamp_ntz",
    )
    assert [(r.referee_id, r.referrer_id) for r in commission.referral_binding(claims).collect()] == [("u", "v")]


def test_referral_commission_is_capped_by_the_fee(spark):
    done = spark.createDataFrame(
        [("1", "d2", "charter", D("40.00"), T0), ("2", "d2", "charter", D("-5.00"), T0), ("3", "d2", None, D("900.00"), T0), ("4", None, None, D("9.00"), T0)],
        "id string, driver_id string, service_type string, platform_fee decimal(10,2), completed_at timestamp_ntz",
    )
    affiliates = spark.createDataFrame([("d1", "active", True, True, D(100), False, None, None, None)], AFFILIATES)
    refs = spark.createDataFrame([("d1", "d2")], "referrer_driver_id string, referee_driver_id string")
    for limit in (1 << 40, -1):
        rows = commission.driver_referral_commission(done, refs, affiliates, limit=limit)
        got = {r.booking_id: (r.driver_referral_commission, r.platform_fee) for r in rows.collect()}
        assert got == {
            "1": (D("40.00"), D("0.00")), "2": (D("-5.00"), D("0.00")), "3": (D("100.00"), D("800.00")), "4": (D("0.00"), D("9.00")),
        }
    kinds = {r.booking_id: r.anomaly for r in quality.fee_anomalies(rows).collect()}
    assert kinds == {"1": "capped", "2": "negative_fee"}


def test_ledger_conserves_the_total(spark):
    data = [booking(str(i), influencer=["A", "B", "F", None][i % 4], total=D(i * 37 + 1) / 3, promo=["P", None][i % 2]) for i in range(200)]
    rows = split.split_bookings(spark.createDataFrame(data, BOOKINGS), rules(spark), settings(spark, x="{}"), influencers(spark))
    worst = quality.split_residual(rows).agg(F.max(F.abs("residual"))).first()[0]
    assert worst is None or worst <= D("0.01")


def test_driver_referral_counter_never_goes_below_zero(spark):
    affiliates = spark.createDataFrame([("a",), ("b",), ("c",)], "driver_id string")
    log = spark.createDataFrame([("a", "insert"), ("a", "insert"), ("a", "delete"), ("b", "delete")], "referrer_driver_id string, op string")
    got = {r.driver_id: r.total_referrals for r in commission.driver_referral_counts(affiliates, log).collect()}
    assert got == {"a": 1, "b": 0, "c": 0}
