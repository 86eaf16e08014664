"""Entity schemas and the fixed value sets of the booking domain."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(10, 2)
TOTAL = T.DecimalType(20, 2)
PERCENT = T.DecimalType(5, 2)
RATE = T.DecimalType(9, 6)
RATING = T.DecimalType(3, 2)
LATITUDE = T.DecimalType(10, 8)
LONGITUDE = T.DecimalType(11, 8)

# --- fixed values: they must equal the ones the booking platform uses -------------------

DEFAULT_COUNTRY = "TW"
DEFAULT_SERVICE = "charter"
INSTANT_SERVICE = "instant_ride"
SERVICE_TYPES = ("charter", "instant_ride")

# company share, driver share when neither a rule nor a settings row applies
SHARE_WITH_PROMO = (30, 70)
SHARE_NO_PROMO = (25, 75)

MAX_RETRY = 3
RETENTION_DAYS = 7
CACHE_HOURS = 24
PAYMENT_MINUTES = 30

# booking status -> status shown in the rider and driver apps
APP_STATUS = {
    "pending_payment": "PENDING_PAYMENT",
    "paid_deposit": "pending",
    "assigned": "awaitingDriver",
    "matched": "awaitingDriver",
    "driver_confirmed": "matched",
    "driver_departed": "ON_THE_WAY",
    "driver_arrived": "ON_THE_WAY",
    "trip_started": "inProgress",
    "in_progress": "inProgress",
    "trip_ended": "awaitingBalance",
    "pending_balance": "awaitingBalance",
    "completed": "completed",
    "cancelled": "cancelled",
}
APP_STATUS_DEFAULT = "pending"

# statuses that imply a paid deposit
DEPOSIT_PAID_STATUSES = (
    "paid_deposit",
    "assigned",
    "matched",
    "driver_confirmed",
    "driver_departed",
    "driver_arrived",
    "trip_started",
    "trip_ended",
    "pending_balance",
    "completed",
)

PAYMENT_TYPES = ("deposit", "balance", "tip", "refund")
PAYMENT_STATUSES = ("pending", "processing", "completed", "failed", "cancelled", "expired", "refunded")
CONFIRMABLE_STATUSES = ("pending", "processing")
BOOKING_STATUS_BY_PAYMENT = {"deposit": "paid_deposit", "balance": "completed"}

DOCUMENT_TYPES = (
    "id_card_front",
    "id_card_back",
    "drivers_license",
    "vehicle_registration",
    "insurance_policy",
    "police_clearance",
    "no_accident_record",
)
INSTANT_RIDE_DOCUMENT_TYPES = ("selfie_photo", "taxi_permit")
# legacy type name -> current names it stands for
LEGACY_DOCUMENT_TYPES = {
    "id_card": ("id_card_front", "id_card_back"),
    "license": ("drivers_license",),
    "insurance": ("insurance_policy",),
}

# column of the wide document table -> document type
WIDE_DOCUMENT_COLUMNS = {
    "id_card_front_url": "id_card_front",
    "id_card_back_url": "id_card_back",
    "driver_license_url": "drivers_license",
    "vehicle_registration_url": "vehicle_registration",
    "insurance_url": "insurance_policy",
    "police_clearance_url": "police_clearance",
    "no_accident_record_url": "no_accident_record",
}
# column of the wide photo table -> photo type
WIDE_PHOTO_COLUMNS = {
    "front_left_url": "front_left",
    "front_right_url": "front_right",
    "rear_left_url": "rear_left",
    "rear_right_url": "rear_right",
    "interior_front_url": "front_seat",
    "interior_rear1_url": "rear_seat_1",
    "interior_rear2_url": "rear_seat_2",
    "interior_rear3_url": "rear_seat_3",
    "trunk_url": "trunk",
}


def _struct(**fields: str | T.DataType) -> T.StructType:
    out = T.StructType()
    for name, kind in fields.items():
        required = isinstance(kind, str) and kind.endswith("!")
        dtype = kind if isinstance(kind, T.DataType) else T._parse_datatype_string(kind.rstrip("!"))
        out.add(name, dtype, not required)
    return out


def entity_schemas() -> dict[str, T.StructType]:
    """Explicit read schemas (needs an active session to parse the type names)."""
    return {
        "bookings": _struct(
            id="string!", booking_number="string", customer_id="string!", driver_id="string", status="string!",
            start_date="date", start_time="string", duration_hours="int", vehicle_type="string",
            pickup_location="string", destination="string",
            pickup_latitude=LATITUDE, pickup_longitude=LONGITUDE,
            dropoff_latitude=LATITUDE, dropoff_longitude=LONGITUDE,
            special_requirements="string", requires_foreign_language="boolean",
            passenger_count="int", luggage_count="int",
            base_price=MONEY, foreign_language_surcharge=MONEY, overtime_fee=MONEY, tip_amount=MONEY,
            total_amount=MONEY, deposit_amount=MONEY, deposit_paid="boolean",
            platform_fee=MONEY, driver_earning=MONEY,
            tour_package_id="string", tour_package_name="string",
            promo_code="string", influencer_id="string", influencer_commission=MONEY,
            original_price=MONEY, discount_amount=MONEY, final_price=MONEY, tax_id="string",
            country="string", region="string", service_type="string",
            created_at="timestamp!", updated_at="timestamp", actual_start_time="timestamp",
            actual_end_time="timestamp", completed_at="timestamp",
        ),
        "users": _struct(id="string!", external_uid="string", role="string", name="string", email="string", status="string"),
        "user_profiles": _struct(user_id="string!", first_name="string", last_name="string", phone="string"),
        "drivers": _struct(
            id="string!", user_id="string!", vehicle_type="string", rating=RATING, total_trips="int", is_available="boolean",
            company_tax_id="string", service_types="array<string>",
        ),
        "vehicles": _struct(driver_id="string!", plate_number="string", model="string", is_primary="boolean"),
        "influencers": _struct(
            id="string!", is_active="boolean", commission_type="string", commission_fixed=MONEY, commission_percent=RATE,
            commission_percent_charter=RATE, commission_percent_instant_ride=RATE,
            is_commission_fixed_active="boolean", is_commission_percent_active="boolean",
        ),
        "referrals": _struct(
            id="string", referee_id="string!", referrer_id="string!", influencer_id="string!", promo_code="string!",
            first_booking_id="string", created_at="timestamp!",
        ),
        "driver_affiliates": _struct(
            driver_id="string!", affiliate_status="string!", is_active="boolean", commission_fixed_enabled="boolean",
            commission_fixed=MONEY, commission_percent_enabled="boolean", commission_percent=RATE,
            commission_percent_charter=RATE, commission_percent_instant_ride=RATE,
        ),
        "driver_referrals": _struct(
            referrer_driver_id="string!", referee_driver_id="string!", promo_code="string!", created_at="timestamp!"
        ),
        "revenue_rules": _struct(
            id="string!", country="string!", region="string", service_type="string!", has_promo_code="boolean!",
            company_percentage=PERCENT, driver_percentage=PERCENT, company_base_percentage=PERCENT,
            is_active="boolean", priority="int", created_at="timestamp",
        ),
        "system_settings": _struct(key="string!", value="string"),
        "promo_code_usage": _struct(
            booking_id="string!", influencer_id="string", promo_code="string", original_price=MONEY,
            discount_amount_applied=MONEY, final_price=MONEY, commission_amount=MONEY, commission_status="string",
            commission_type="string", commission_rate=RATE, order_amount=MONEY, referee_id="string", used_at="timestamp",
        ),
        "commission_ledger": _struct(
            booking_id="string!", scheme="string!", beneficiary_id="string", base_amount=MONEY, rate=RATE,
            type="string", amount=MONEY, reason_code="string!", accrued_at="timestamp",
        ),
        "outbox": _struct(
            id="string!", aggregate_type="string!", aggregate_id="string!", event_type="string!", payload="string",
            created_at="timestamp!",
        ),
        "delivery_state": _struct(event_id="string!", attempts="int!", delivered_at="timestamp", last_error="string"),
        "payments": _struct(
            transaction_id="string!", booking_id="string!", customer_id="string", type="string!", amount=MONEY,
            currency="string!", status="string!", expires_at="timestamp", confirmed_at="timestamp", is_test_mode="boolean",
        ),
        "places_cache": _struct(
            id="string!", search_query="string!", language_code="string!", name="string", latitude=LATITUDE,
            longitude=LONGITUDE, created_at="timestamp!",
        ),
        "driver_documents": _struct(
            driver_id="string!", type="string!", url="string!", status="string!", uploaded_at="timestamp", reviewed_at="timestamp"
        ),
        "driver_bank_accounts": _struct(
            driver_id="string!", bank_name="string", bank_code="string!", branch_name="string", account_holder_name="string",
            account_number="string!",
        ),
        "driver_vehicle_photos": _struct(driver_id="string!", photo_type="string!", url="string!"),
    }
