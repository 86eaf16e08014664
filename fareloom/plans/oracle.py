"""For every registered query the SQL that states its result over the raw tables."""

from __future__ import annotations

from fareloom.plans.views import PAID_STATUSES, app_status, mean, pct, with_views
from fareloom.schemas import DOCUMENT_TYPES, INSTANT_RIDE_DOCUMENT_TYPES, WIDE_DOCUMENT_COLUMNS, WIDE_PHOTO_COLUMNS

S: dict[str, str] = {}

_INSTANT = "(d.service_types IS NULL OR list_contains(d.service_types, 'instant_ride'))"

# --- scans and the event log ------------------------------------------------------------

S["scan_bookings"] = "SELECT id, customer_id, driver_id, status, total_amount, service_type, country, created_at FROM m_bookings"
S["outbox_pending"] = """
SELECT id, aggregate_type, aggregate_id, event_type, created_at FROM m_outbox WHERE processed_at IS NULL AND retry_count < 3
"""
S["outbox_build"] = "SELECT * FROM m_events"
S["outbox_backfill_promo"] = """
SELECT e.* FROM m_backfill e JOIN m_bookings b ON e.aggregate_id = b.id WHERE b.promo_code IS NOT NULL OR b.tax_id IS NOT NULL
"""
S["outbox_backfill_deposit"] = f"""
SELECT e.* FROM m_backfill e JOIN m_bookings b ON e.aggregate_id = b.id WHERE b.deposit_paid AND b.status IN ({PAID_STATUSES})
"""
S["outbox_reemit"] = "SELECT * FROM m_backfill WHERE aggregate_id IN (SELECT booking_id FROM m_payments WHERE status = 'failed')"
S["projection_latest"] = """
SELECT d.* FROM m_documents_now d JOIN m_latest_log l ON d.id = l.aggregate_id WHERE l.event_type <> 'deleted'
"""
S["projection_of_events"] = S["projection_latest"]
S["projection_tombstones"] = """
SELECT aggregate_id, id AS event_id, created_at AS deleted_at FROM m_latest_log WHERE event_type = 'deleted'
"""
S["delivery_outcome"] = """
SELECT event_id, CAST(ok1 + ok2 AS BIGINT) AS targets_ok, CAST(2 - ok1 - ok2 AS BIGINT) AS targets_failed,
       CASE ok1 + ok2 WHEN 2 THEN 'success' WHEN 1 THEN 'partial' ELSE 'retry' END AS outcome
FROM (SELECT CAST(event_id AS VARCHAR) AS event_id, CASE WHEN event_id % 5 <> 0 THEN 1 ELSE 0 END AS ok1,
             CASE WHEN value > 10 THEN 1 ELSE 0 END AS ok2 FROM events)
"""
S["backfill_missing"] = """
SELECT id, customer_id, total_amount FROM m_bookings b
WHERE NOT EXISTS (SELECT 1 FROM m_payments p WHERE p.booking_id = b.id AND p.status = 'completed')
"""
S["backfill_stats"] = """
SELECT count(*) AS total, count(p.booking_id) AS already_exists, count(*) - count(p.booking_id) AS copied
FROM m_bookings b LEFT JOIN m_payments p ON p.booking_id = b.id AND p.status = 'completed'
"""
S["chat_messages_latest"] = """
SELECT booking_id, message_id, sender_id, receiver_id, coalesce(sender_name, '') AS sender_name, '' AS receiver_name,
       message_text, translated_text, message_at AS created_at, read_at
FROM (SELECT * FROM m_chat_events QUALIFY row_number() OVER (PARTITION BY booking_id, message_id ORDER BY created_at DESC, seq DESC) = 1)
WHERE event_type <> 'deleted'
"""
S["chat_room_rollup"] = """
SELECT booking_id, coalesce(customerId, '') AS customerId, coalesce(driverId, '') AS driverId, coalesce(customerName, '') AS customerName,
       coalesce(driverName, '') AS driverName, coalesce(pickupAddress, '') AS pickupAddress, bookingTime,
       message_text AS lastMessage, message_at AS lastMessageTime
FROM (SELECT * FROM m_chat_events WHERE event_type <> 'deleted'
      QUALIFY row_number() OVER (PARTITION BY booking_id ORDER BY created_at DESC, message_at DESC, message_id DESC) = 1) c
LEFT JOIN m_documents_now d ON c.booking_id = d.id
"""
S["outbox_retention"] = """
SELECT id, aggregate_id, created_at, processed_at FROM m_outbox
WHERE processed_at IS NULL OR processed_at >= TIMESTAMP '2024-01-22 00:00:00'
"""
S["cache_retention"] = """
SELECT count(*) AS total, count(*) FILTER (WHERE ts < TIMESTAMP '2024-01-22 00:00:00') AS deleted
FROM events WHERE event_type IN ('signup', 'view')
"""
S["cache_lookup_as_of"] = """
SELECT request_id, r.search_query, r.language_code, requested_at, c.id AS cache_id, c.name, c.created_at AS cached_at, c.id IS NOT NULL AS is_hit
FROM (SELECT CAST(event_id AS VARCHAR) AS request_id, CASE WHEN event_id % 50 <> 0 THEN 'place ' || user_id END AS search_query,
             CASE WHEN value > 30 THEN 'en' ELSE 'zh' END AS language_code, ts AS requested_at FROM events WHERE event_type IN ('click', 'purchase')) r
LEFT JOIN (SELECT CAST(event_id AS VARCHAR) AS id, 'place ' || user_id AS search_query, CASE WHEN event_type = 'view' THEN 'en' ELSE 'zh' END AS language_code,
                  'Place ' || event_id AS name, ts AS created_at FROM events WHERE event_type IN ('signup', 'view')) c
  ON c.search_query = r.search_query AND c.language_code = r.language_code AND c.created_at <= requested_at AND c.created_at > requested_at - INTERVAL 24 HOUR
QUALIFY row_number() OVER (PARTITION BY request_id ORDER BY c.created_at DESC, c.id DESC) = 1
"""
S["cache_lookup"] = """
SELECT CAST(r.event_id AS VARCHAR) AS request_id, 'place ' || r.user_id AS search_query,
       CASE WHEN r.value > 30 THEN 'en' ELSE 'zh' END AS language_code, CAST(c.event_id AS VARCHAR) AS cache_id,
       'Place ' || c.event_id AS name, c.ts AS cached_at, c.event_id IS NOT NULL AS is_hit
FROM events r LEFT JOIN (
  SELECT * FROM events WHERE event_type IN ('signup', 'view') AND ts > TIMESTAMP '2024-01-28 00:00:00' AND ts <= TIMESTAMP '2024-01-29 00:00:00'
  QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, CAST(event_id AS VARCHAR) DESC) = 1
) c ON r.user_id = c.user_id AND (r.value > 30) = (c.event_type = 'view')
WHERE r.event_type = 'click'
"""
S["payment_validate"] = "SELECT request_id, errors = '' AS is_valid, errors FROM m_requests_checked"
S["webhook_validate"] = "SELECT webhook_id, errors = '' AS is_valid, errors FROM m_webhooks_checked"
S["upsert_users"] = """
SELECT coalesce(p.user_id, u.id) AS user_id, CASE WHEN u.id IS NOT NULL THEN 'New' ELSE first_name END AS first_name,
       CASE WHEN u.id IS NOT NULL THEN u.name ELSE last_name END AS last_name, phone
FROM m_profiles p FULL JOIN (SELECT id, name FROM m_users WHERE status = 'active') u ON p.user_id = u.id
"""
S["insert_missing_profiles"] = """
SELECT user_id, first_name, last_name, phone FROM m_profiles
UNION ALL SELECT id, 'Test', 'Driver', '0912345678' FROM m_users WHERE role = 'driver' AND id NOT IN (SELECT user_id FROM m_profiles)
"""

# --- projections and filters ------------------------------------------------------------

S["completed_in_window"] = "SELECT id, driver_id, total_amount, completed_at FROM m_completed"
S["deposit_backfill"] = f"""
SELECT id, status, CASE WHEN status IN ({PAID_STATUSES}) THEN TRUE ELSE deposit_paid END AS deposit_paid FROM m_bookings
"""
S["fill_defaults"] = """
SELECT id, coalesce(country, 'TW') AS country, coalesce(service_type, 'charter') AS service_type,
       CASE WHEN original_price IS NULL OR final_price IS NULL THEN total_amount ELSE original_price END AS original_price,
       CASE WHEN original_price IS NULL OR final_price IS NULL THEN total_amount ELSE final_price END AS final_price,
       CASE WHEN original_price IS NULL OR final_price IS NULL THEN CAST(0 AS DECIMAL(10,2)) ELSE discount_amount END AS discount_amount
FROM m_bookings
"""
S["fill_service_types"] = """
SELECT user_id, array_to_string(coalesce(service_types, ['charter', 'instant_ride']), ',') AS service_types FROM m_drivers
"""
S["fill_commission_type"] = "SELECT id AS influencer_id, 'unified' AS commission_type FROM m_influencers"
_WRONG = """(platform_fee IS NULL OR platform_fee <> total_amount * CAST(0.25 AS DECIMAL(3,2))
    OR driver_earning IS NULL OR driver_earning <> total_amount * CAST(0.75 AS DECIMAL(3,2)))"""
S["fee_repair"] = f"""
SELECT id, platform_fee AS old_platform_fee, driver_earning AS old_driver_earning,
       CAST(round(total_amount * CAST(0.25 AS DECIMAL(3,2)), 2) AS DECIMAL(10,2)) AS platform_fee,
       CAST(round(total_amount * CAST(0.75 AS DECIMAL(3,2)), 2) AS DECIMAL(10,2)) AS driver_earning
FROM m_bookings WHERE total_amount IS NOT NULL AND {_WRONG}
"""
S["settings_set"] = """
SELECT id, CAST(json_merge_patch(payload, '{"currency":"TWD","depositRate":0.25}') AS VARCHAR) AS payload FROM m_outbox
"""
S["payload_fields"] = """
SELECT e.id, event_type, b.status, CAST(b.deposit_paid AS VARCHAR) AS deposit_paid, b.promo_code, b.total_amount,
       CASE WHEN b.pickup_longitude IS NOT NULL THEN b.pickup_latitude END AS pickup_latitude, e.created_at
FROM m_events e JOIN m_changes b ON e.aggregate_id = b.id AND e.created_at = b.changed_at
"""
S["status_mapping"] = f"SELECT id, version, status, {app_status('status')} AS app_status FROM m_changes"
S["deposit_status_check"] = """
SELECT status, CASE WHEN deposit_paid AND status = 'paid_deposit' THEN 'deposit_paid'
                    WHEN NOT deposit_paid AND status = 'pending_payment' THEN 'awaiting_deposit' ELSE 'inconsistent' END AS deposit_check,
       CASE WHEN driver_id IS NULL THEN 'no_driver' WHEN status = 'matched' THEN 'awaiting_driver_confirmation'
            WHEN status = 'driver_confirmed' THEN 'driver_confirmed' ELSE 'other' END AS driver_stage, count(*) AS n_bookings
FROM m_bookings GROUP BY 1, 2, 3
"""
S["apply_status_patches"] = """
SELECT b.id, CASE WHEN p.type = 'deposit' THEN 'paid_deposit' WHEN p.type = 'balance' THEN 'completed' ELSE b.status END AS status,
       CASE WHEN p.type = 'balance' THEN p.confirmed_at ELSE b.completed_at END AS completed_at, p.type IS NOT NULL AS is_patched
FROM m_bookings b LEFT JOIN (SELECT * FROM m_payments WHERE status = 'completed' AND type IN ('deposit', 'balance')) p ON b.id = p.booking_id
"""


def _long() -> str:
    texts = [
        "customerId", "driverId", "customerName", "customerPhone", "driverName", "driverPhone", "driverVehiclePlate",
        "driverVehicleModel", "pickupAddress", "dropoffAddress", "notes", "tourPackageId", "tourPackageName", "promoCode",
        "influencerId", "taxId", "country", "serviceType", "status",
    ]
    numbers = [
        "driverRating", "passengerCount", "luggageCount", "influencerCommission", "originalPrice", "discountAmount", "finalPrice",
        "estimatedFare", "depositAmount", "overtimeFee", "tipAmount", "platformFee", "driverEarning",
    ]
    times = ["bookingTime", "createdAt", "matchedAt", "completedAt"]
    parts = [f"SELECT id AS doc_id, '{c}' AS field, 'string' AS tag, {c} AS value FROM m_documents_now" for c in texts]
    for c in numbers:
        tag = f"CASE WHEN {c} = floor({c}) THEN 'integer' ELSE 'double' END"
        value = f"CASE WHEN {c} = floor({c}) THEN CAST(CAST({c} AS BIGINT) AS VARCHAR) ELSE rtrim(CAST({c} AS VARCHAR), '0') END"
        parts.append(f"SELECT id, '{c}', {tag}, {value} FROM m_documents_now")
    parts += [f"SELECT id, '{c}', 'timestamp', strftime({c}, '%Y-%m-%dT%H:%M:%S.%f') FROM m_documents_now" for c in times]
    parts.append("SELECT id, 'depositPaid', 'boolean', CAST(depositPaid AS VARCHAR) FROM m_documents_now")
    for c in ("pickup", "dropoff"):
        parts.append(f"SELECT id, '{c}Location', 'geo', {c}_latitude || ',' || {c}_longitude FROM m_documents_now")
    rows = "\nUNION ALL ".join(parts)
    return f"SELECT doc_id, field, CASE WHEN value IS NULL THEN 'null' ELSE tag END AS type_tag, value FROM ({rows})"


S["document_fields_long"] = _long()
S["visible_rows"] = """
SELECT driver_id, type, url, status, uploaded_at, TRUE AS by_owner, FALSE AS by_admin FROM m_documents
WHERE status = 'pending' AND driver_id IN (SELECT id FROM m_users WHERE role = 'driver' AND status = 'active')
"""
S["visible_rows_admin"] = """
SELECT driver_id, type, url, status, uploaded_at, driver_id IN (SELECT id FROM m_users) AS by_owner,
       (SELECT count(*) FROM m_users WHERE role = 'admin') > 0 AS by_admin
FROM m_documents WHERE driver_id IN (SELECT id FROM m_users) OR (SELECT count(*) FROM m_users WHERE role = 'admin') > 0
"""
S["visible_rows_read"] = """
SELECT driver_id, type, url, status, uploaded_at, TRUE AS by_owner, FALSE AS by_admin FROM m_documents
WHERE driver_id IN (SELECT id FROM m_users WHERE role = 'driver' AND status = 'suspended')
"""

# --- joins ------------------------------------------------------------------------------

_RANKED = """
SELECT row_number() OVER (ORDER BY total_earnings DESC NULLS FIRST, driver_id) AS rank, driver_id, {name} AS driver_name,
       email AS driver_email, total_earnings, total_orders, average_earnings
FROM m_driver_list {how} JOIN m_users u ON driver_id = u.id
ORDER BY total_earnings DESC NULLS FIRST, driver_id LIMIT 10
"""
S["driver_earnings_ranking_left"] = _RANKED.format(name="name", how="LEFT")
S["driver_earnings_ranking"] = _RANKED.format(name="coalesce(name, email)", how="")
S["driver_directory"] = """
SELECT u.id, email, role, status, first_name, last_name, phone, d.id AS driver_id, vehicle_type, rating, is_available
FROM m_users u LEFT JOIN m_profiles p ON u.id = p.user_id LEFT JOIN m_drivers d ON u.id = d.user_id WHERE role = 'driver'
"""
S["available_drivers"] = """
SELECT u.id AS user_id, email, CASE WHEN first_name IS NOT NULL OR last_name IS NOT NULL THEN trim(concat_ws(' ', first_name, last_name)) END AS driver_name,
       phone, vehicle_type, rating, total_trips
FROM m_users u JOIN m_profiles p ON u.id = p.user_id JOIN m_drivers d ON u.id = d.user_id
WHERE role = 'driver' AND status = 'active' AND is_available ORDER BY rating DESC, total_trips DESC, user_id
"""
S["available_for_instant_rides"] = S["available_drivers"].replace("AND is_available", "AND is_available AND " + _INSTANT)
S["load_older_bookings"] = """
SELECT id, total_amount, 'TW' AS country, 'charter' AS service_type, coalesce(original_price, total_amount) AS original_price,
       coalesce(final_price, total_amount) AS final_price FROM m_bookings
"""
S["profiles_of_drivers"] = "SELECT * FROM m_profiles WHERE user_id IN (SELECT id FROM m_users WHERE role = 'driver')"
S["revenue_share_lookup"] = """
SELECT b.id, r.id AS rule_id, company_percentage, driver_percentage, company_base_percentage
FROM m_bookings b LEFT JOIN m_rules r ON r.is_active AND r.country = coalesce(b.country, 'TW')
 AND (r.region = b.region OR r.region IS NULL) AND r.service_type = coalesce(b.service_type, 'charter')
 AND r.has_promo_code = (coalesce(b.promo_code, '') <> '')
QUALIFY row_number() OVER (PARTITION BY b.id ORDER BY CASE WHEN r.region IS NOT NULL THEN 1 ELSE 0 END DESC,
                           r.priority DESC NULLS FIRST, r.created_at DESC NULLS FIRST, r.id DESC) = 1
"""
S["revenue_share_fallback"] = "SELECT id, rule_id, share_origin, company_percentage, driver_percentage FROM m_shares"
S["commission_audit"] = """
SELECT booking_id, booking_number, status AS order_status, u.influencer_id, commission_amount, commission_status, order_amount, used_at
FROM m_usage u JOIN m_bookings b ON u.booking_id = b.id
"""
S["referral_directory"] = """
SELECT influencer_id, referee_id, promo_code, name AS influencer_name, commission_percent, is_commission_percent_active, is_active
FROM m_referrals r JOIN m_influencers i ON r.influencer_id = i.id
"""
S["outbox_by_booking"] = """
SELECT o.id, aggregate_id, booking_number, event_type, o.created_at, processed_at,
       CASE WHEN processed_at IS NOT NULL THEN 'synced' ELSE 'pending' END AS sync_state
FROM m_outbox o JOIN m_bookings b ON o.aggregate_id = b.id WHERE b.status = 'matched' AND b.driver_id IS NOT NULL
"""

# --- aggregates -------------------------------------------------------------------------

_DRIVER_TOTALS = f"""
SELECT u.id AS driver_id, coalesce(e, 0) AS total_earnings, coalesce(n, 0) AS total_orders,
       coalesce({mean("cents", "paid")}, 0) AS average_earnings
FROM (SELECT id FROM m_users WHERE role = 'driver') u
LEFT JOIN (SELECT driver_id, CAST(sum(driver_earning) AS DECIMAL(20,2)) AS e, count(*) AS n, count(driver_earning) AS paid,
                  CAST(sum(driver_earning) * 100 AS BIGINT) AS cents
           FROM m_completed GROUP BY driver_id) b ON u.id = b.driver_id
"""
S["driver_earnings"] = _DRIVER_TOTALS
S["driver_earnings_daily"] = """
SELECT driver_id, CAST(completed_at AS DATE) AS date, CAST(sum(driver_earning) AS DECIMAL(20,2)) AS earnings, count(*) AS orders
FROM m_completed WHERE driver_id IS NOT NULL GROUP BY 1, 2
"""
S["driver_earnings_json"] = f"""
SELECT t.driver_id, '{{"totalEarnings":' || CAST(total_earnings AS DECIMAL(20,2)) || ',"totalOrders":' || total_orders || ',"averageEarnings":'
       || CAST(average_earnings AS DECIMAL(20,2)) || ',"dailyEarnings":' || coalesce('[' || days || ']', 'null') || '}}' AS report
FROM ({_DRIVER_TOTALS}) t
LEFT JOIN (SELECT driver_id, string_agg('{{"date":"' || date || '","earnings":' || coalesce(CAST(earnings AS VARCHAR), 'null') || ',"orders":' || orders || '}}', ',' ORDER BY date) AS days
           FROM (SELECT driver_id, CAST(completed_at AS DATE) AS date, CAST(sum(driver_earning) AS DECIMAL(20,2)) AS earnings, count(*) AS orders
                 FROM m_completed WHERE driver_id IS NOT NULL GROUP BY 1, 2) GROUP BY 1) d ON t.driver_id = d.driver_id
"""


def _mean_ratio(part: str, where: str) -> str:
    return f"""CAST(round(CAST(sum(CAST(round(CAST({part} AS DOUBLE) / nullif(CAST(total_amount AS DOUBLE), 0), 10) AS DECIMAL(18,10))) AS DOUBLE)
       / nullif(count({part}) FILTER (WHERE {where}), 0), 4) AS DECIMAL(10,4))"""


_PLATFORM = f"""
SELECT CAST(coalesce(sum(platform_fee), 0) AS DECIMAL(20,2)) AS total_platform_fee, CAST(coalesce(sum(total_amount), 0) AS DECIMAL(20,2)) AS total_revenue,
       count(*) AS total_orders, CAST(coalesce({_mean_ratio("platform_fee", "total_amount <> 0")}, 0) AS DECIMAL(10,4)) AS average_commission_rate
FROM m_completed
"""
_PLATFORM_DAILY = """
SELECT CAST(completed_at AS DATE) AS date, CAST(sum(platform_fee) AS DECIMAL(20,2)) AS platform_fee,
       CAST(sum(total_amount) AS DECIMAL(20,2)) AS revenue, count(*) AS orders
FROM {source} GROUP BY 1
"""
S["platform_earnings"] = _PLATFORM
S["platform_earnings_daily"] = _PLATFORM_DAILY.format(source="m_completed")
S["platform_earnings_json"] = f"""
SELECT '{{"totalPlatformFee":' || total_platform_fee || ',"totalRevenue":' || total_revenue || ',"totalOrders":' || total_orders
       || ',"averageCommissionRate":' || CAST(average_commission_rate AS DECIMAL(10,4)) || ',"dailyEarnings":' || coalesce('[' || days || ']', 'null') || '}}' AS report
FROM ({_PLATFORM}) p,
     (SELECT string_agg('{{"date":"' || date || '","platform_fee":' || coalesce(CAST(platform_fee AS VARCHAR), 'null') || ',"revenue":' || revenue || ',"orders":' || orders || '}}', ',' ORDER BY date) AS days
      FROM ({_PLATFORM_DAILY.format(source=f"m_completed")})) d
"""
_DAILY = """
SELECT CAST(completed_at AS DATE) AS date, CAST(sum(total_amount) AS DECIMAL(20,2)) AS total_revenue,
       CAST(sum(driver_earning) AS DECIMAL(20,2)) AS driver_earnings, CAST(sum(platform_fee) AS DECIMAL(20,2)) AS platform_fee,
       count(*) AS orders, count(DISTINCT driver_id) AS drivers_count
FROM {source} GROUP BY 1
"""
S["daily_earnings_summary"] = _DAILY.format(source="m_completed")
S["daily_summary_json"] = f"""
SELECT '[' || coalesce(string_agg('{{"date":"' || date || '","total_revenue":' || total_revenue || ',"driver_earnings":' || coalesce(CAST(driver_earnings AS VARCHAR), 'null')
       || ',"platform_fee":' || coalesce(CAST(platform_fee AS VARCHAR), 'null') || ',"orders":' || orders || ',"drivers_count":' || drivers_count || '}}', ',' ORDER BY date), '') || ']' AS report
FROM ({_DAILY.format(source=f"m_completed")})
"""
_PAGE = """
SELECT driver_id, {name} AS driver_name, email AS driver_email, total_earnings, total_orders, average_earnings, {page} AS page, {limit} AS page_limit,
       (SELECT count(*) FROM m_per_driver) AS total, CAST(ceil((SELECT count(*) FROM m_per_driver) / {limit}.0) AS BIGINT) AS total_pages
FROM m_driver_list {how} JOIN (SELECT * FROM m_users {where}) u ON driver_id = u.id
ORDER BY {order}, driver_id LIMIT {limit} OFFSET ({page} - 1) * {limit}
"""
S["drivers_earnings_page"] = _PAGE.format(
    name="coalesce(name, email)", page=2, limit=7, how="", where="", order="total_earnings DESC NULLS FIRST"
)
S["drivers_earnings_page_by_orders"] = _PAGE.format(
    name="name", page=1, limit=15, how="LEFT", where="", order="total_orders ASC NULLS LAST"
)
S["drivers_earnings_summary"] = f"""
SELECT CAST(coalesce(sum(total_earnings), 0) AS DECIMAL(20,2)) AS total_earnings, CAST(coalesce(sum(total_orders), 0) AS BIGINT) AS total_orders,
       coalesce({mean("CAST(sum(cents) AS BIGINT)", "CAST(sum(paid) AS BIGINT)")}, 0) AS average_earnings, count(*) AS active_drivers
FROM m_per_driver
"""
S["drivers_page_json"] = f"""
SELECT '{{"success":true,"data":{{"drivers":[' || string_agg('{{"driverId":"' || driver_id || '","driverName":"' || driver_name || '","driverEmail":"' || driver_email
       || '","totalEarnings":' || total_earnings || ',"totalOrders":' || total_orders || ',"averageEarnings":' || average_earnings || '}}', ',' ORDER BY total_earnings DESC, driver_id)
       || '],"summary":{{"totalEarnings":' || min(s.e) || ',"totalOrders":' || min(s.n) || ',"averageEarnings":' || min(s.a) || ',"activeDrivers":' || min(s.d)
       || '}},"pagination":{{"page":1,"limit":5,"total":' || min(total) || ',"totalPages":' || min(total_pages) || '}}}}}}' AS report
FROM ({_PAGE.format(name="coalesce(name, email)", page=1, limit=5, how="", where="", order="total_earnings DESC NULLS FIRST")}) p,
     (SELECT total_earnings AS e, total_orders AS n, average_earnings AS a, active_drivers AS d FROM ({S["drivers_earnings_summary"]})) s
"""
S["deposit_by_status"] = """
SELECT status, count(*) AS n_bookings, sum(CASE WHEN deposit_paid = TRUE THEN 1 ELSE 0 END)::BIGINT AS paid_count,
       sum(CASE WHEN deposit_paid = FALSE THEN 1 ELSE 0 END)::BIGINT AS unpaid_count
FROM m_bookings GROUP BY status
"""
S["fee_statistics"] = f"""
SELECT count(*) AS total_orders, count(platform_fee) AS orders_with_platform_fee, count(driver_earning) AS orders_with_driver_earning,
       {_mean_ratio("platform_fee", "total_amount <> 0")} AS avg_platform_fee_rate,
       {_mean_ratio("driver_earning", "total_amount <> 0")} AS avg_driver_earning_rate
FROM m_bookings WHERE total_amount IS NOT NULL
"""
S["fee_correctness"] = f"""
SELECT count(*) AS total_orders, count(*) FILTER (WHERE {_WRONG}) AS orders_to_update,
       count(*) FILTER (WHERE platform_fee = total_amount * CAST(0.25 AS DECIMAL(3,2)) AND driver_earning = total_amount * CAST(0.75 AS DECIMAL(3,2))) AS correct_orders
FROM m_bookings WHERE total_amount IS NOT NULL
"""
S["orders_by_status"] = f"SELECT status, {app_status('status')} AS app_status, count(*) AS orders FROM m_bookings GROUP BY status"
S["influencer_referral_counts"] = """
SELECT i.id AS influencer_id, (SELECT count(*) FROM m_referrals r WHERE r.influencer_id = i.id) AS total_referrals FROM m_influencers i
"""
S["driver_referral_counts"] = """
SELECT a.driver_id, count(r.referee_driver_id) FILTER (WHERE u.status = 'active') AS total_referrals
FROM m_driver_affiliates a LEFT JOIN m_driver_referrals r ON a.driver_id = r.referrer_driver_id LEFT JOIN m_users u ON r.referee_driver_id = u.id
GROUP BY a.driver_id
"""
S["influencer_total_earnings"] = """
SELECT i.id AS influencer_id, CAST(coalesce(sum(amount), 0) AS DECIMAL(20,2)) AS total_earnings, count(l.booking_id) AS n_commissions
FROM m_influencers i LEFT JOIN m_ledger l ON i.id = l.beneficiary_id GROUP BY i.id
"""
S["driver_affiliate_earnings"] = """
SELECT a.driver_id, CAST(coalesce(sum(driver_referral_commission), 0) AS DECIMAL(20,2)) AS total_earnings, count(c.booking_id) AS n_commissions
FROM m_driver_affiliates a LEFT JOIN m_referral_commission c ON a.driver_id = c.driver_referrer_id GROUP BY a.driver_id
"""
S["outbox_backlog"] = """
SELECT count(*) AS unprocessed_count, min(created_at) AS oldest_event, max(created_at) AS newest_event,
       CAST(CAST(epoch_us(TIMESTAMP '2024-01-29 00:00:00') - epoch_us(min(created_at)) AS DECIMAL(18,0)) * CAST(0.000001 AS DECIMAL(7,6)) AS DECIMAL(20,6)) AS oldest_event_age_seconds
FROM m_outbox WHERE processed_at IS NULL
"""
S["driver_completeness_counts"] = """
SELECT count(*) AS driver_users, count(p.user_id) AS with_profile, count(d.user_id) AS with_driver_record,
       count(*) - count(p.user_id) AS lacking_profile, count(*) - count(d.user_id) AS lacking_driver_record
FROM m_users u LEFT JOIN m_profiles p ON u.id = p.user_id LEFT JOIN m_drivers d ON u.id = d.user_id WHERE role = 'driver'
"""
S["dimension_fill"] = """
SELECT count(*) AS total_bookings, count(country) AS with_country, count(service_type) AS with_service_type FROM m_bookings
"""

# --- latest rows, edges, top rows -------------------------------------------------------

S["latest_event"] = """
SELECT id, aggregate_id, event_type, amount, created_at FROM m_outbox
QUALIFY row_number() OVER (PARTITION BY aggregate_id ORDER BY created_at DESC, id DESC) = 1
"""
_EDGES = "SELECT id AS booking_id, version, previous_status, is_insert, changed_at FROM m_edges_all WHERE is_edge"
S["completion_edges"] = _EDGES
S["recent_events"] = """
SELECT id, aggregate_id, event_type, created_at, processed_at,
       CAST(CAST(epoch_us(processed_at) - epoch_us(created_at) AS DECIMAL(18,0)) * CAST(0.000001 AS DECIMAL(7,6)) AS DECIMAL(20,6)) AS delay_seconds
FROM m_outbox ORDER BY processed_at DESC NULLS LAST, id DESC LIMIT 10
"""

# --- ledger -----------------------------------------------------------------------------

S["financial_split_legacy"] = f"""
SELECT id, {pct("coalesce(total_amount, 0)", "25")} AS platform_fee, {pct("coalesce(total_amount, 0)", "75")} AS driver_earning,
       coalesce(completed_at, actual_end_time) AS completed_at
FROM m_bookings
"""
S["financial_split_settings"] = f"""
SELECT id, CASE WHEN promo THEN 'settings' ELSE 'default' END AS share_origin, gross AS platform_fee_gross, commission AS influencer_commission,
       CAST(gross - CASE WHEN promo AND commission > 0 THEN commission ELSE 0 END AS DECIMAL(10,2)) AS platform_fee,
       CASE WHEN promo THEN {pct("amount", "68")} ELSE {pct("amount", "75")} END AS driver_earning
FROM (SELECT id, coalesce(promo_code, '') <> '' AS promo, coalesce(total_amount, 0) AS amount,
             CASE WHEN coalesce(promo_code, '') <> '' THEN {pct("coalesce(total_amount, 0)", "32")} ELSE {pct("coalesce(total_amount, 0)", "25")} END AS gross,
             CASE WHEN f THEN CAST(fixed AS DECIMAL(10,2)) WHEN p THEN {pct("coalesce(total_amount, 0)", "coalesce(commission_percent, 0)")}
                  ELSE CAST(0 AS DECIMAL(10,2)) END AS commission
      FROM m_influenced)
"""
S["financial_split"] = """
SELECT id, rule_id, share_origin, company_percentage, driver_percentage, platform_fee_gross, influencer_commission_type,
       influencer_commission_rate, influencer_commission, platform_fee, driver_earning
FROM m_split
"""
S["influencer_commission"] = """
SELECT id, influencer_id, influencer_commission_type, influencer_commission_rate, influencer_commission_fixed, influencer_commission FROM m_commissions
"""
S["platform_fee_net"] = "SELECT id, platform_fee_gross, influencer_commission, platform_fee, platform_fee < 0 AS is_negative FROM m_split"
S["affiliate_commission"] = "SELECT * EXCLUDE (customer_id) FROM m_ledger"
S["affiliate_usage_upsert"] = """
SELECT coalesce(u.booking_id, l.booking_id) AS booking_id, coalesce(u.influencer_id, CASE WHEN u.booking_id IS NULL THEN l.beneficiary_id END) AS influencer_id,
       CASE WHEN u.booking_id IS NULL THEN r.promo_code ELSE u.promo_code END AS promo_code,
       CASE WHEN u.booking_id IS NULL THEN base_amount ELSE original_price END AS original_price,
       CASE WHEN u.booking_id IS NULL THEN CAST(0 AS DECIMAL(10,2)) ELSE discount_amount_applied END AS discount_amount_applied,
       CASE WHEN u.booking_id IS NULL THEN base_amount ELSE final_price END AS final_price,
       CASE WHEN l.booking_id IS NULL THEN commission_amount ELSE amount END AS commission_amount,
       CASE WHEN l.booking_id IS NULL THEN commission_status ELSE 'pending' END AS commission_status,
       type AS commission_type, rate AS commission_rate, base_amount AS order_amount, customer_id AS referee_id
FROM m_usage u FULL JOIN m_accruals l ON u.booking_id = l.booking_id LEFT JOIN m_referrals r ON l.customer_id = r.referee_id
"""
S["affiliate_usage_settle"] = """
SELECT u.booking_id, influencer_id, promo_code, original_price, discount_amount_applied, final_price,
       CASE WHEN l.booking_id IS NULL THEN commission_amount ELSE amount END AS commission_amount,
       CASE WHEN l.booking_id IS NULL THEN commission_status ELSE 'completed' END AS commission_status,
       type AS commission_type, rate AS commission_rate, base_amount AS order_amount, customer_id AS referee_id
FROM m_usage u LEFT JOIN m_accruals l ON u.booking_id = l.booking_id
"""
S["commission_by_code_owner"] = "SELECT * EXCLUDE (customer_id) FROM m_owner_ledger"
S["driver_referral_commission"] = "SELECT * FROM m_referral_commission"
S["referral_binding"] = """
SELECT 'B' || o_orderkey AS claim_id, 'C' || o_custkey AS referee_id, 'C' || (o_orderkey % 50) AS referrer_id, 'P' || (o_orderkey % 20) AS promo_code,
       o_orderdate AS created_at
FROM orders WHERE o_custkey <> o_orderkey % 50
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, 'B' || o_orderkey) = 1
"""
S["completed_at_resolution"] = """
SELECT id AS booking_id, version, status, CASE WHEN is_edge THEN changed_at ELSE actual_end_time END AS completed_at FROM m_edges_all
"""
S["completed_at_kept"] = """
SELECT e.id AS booking_id, e.version, e.status,
       CASE WHEN is_edge THEN changed_at WHEN b.duration_hours % 2 = 0 THEN coalesce(b.completed_at, b.actual_end_time) ELSE b.actual_end_time END AS completed_at
FROM m_edges_all e JOIN m_bookings b ON e.id = b.id
"""
S["commission_decision_log"] = """
SELECT booking_id, version, previous_status, status, reason_code, CASE WHEN reason_code IN ('accrued', 'duplicate') THEN amount END AS amount
FROM (SELECT *, CASE WHEN NOT is_edge THEN 'not_completed' WHEN owner IS NULL THEN 'no_referral'
                     WHEN NOT active THEN 'influencer_inactive' WHEN type IS NULL THEN 'no_scheme' WHEN nth > 1 THEN 'duplicate'
                     WHEN booking_id IN (SELECT booking_id FROM m_usage WHERE commission_status = 'completed') THEN 'duplicate'
                     ELSE 'accrued' END AS reason_code
      FROM m_affiliate_outcomes WHERE NOT is_insert)
"""

# --- payments ---------------------------------------------------------------------------

S["payment_intents_accepted"] = """
SELECT sha256(booking_id || '|' || payment_type || '|' || request_id) AS transaction_id, request_id, booking_id, customer_id, payment_type AS type,
       amount, currency, 'pending' AS status, requested_at + INTERVAL 30 MINUTE AS expires_at
FROM (SELECT * FROM m_requests_checked WHERE errors = ''
      QUALIFY row_number() OVER (PARTITION BY booking_id, payment_type ORDER BY requested_at, request_id) = 1) r
WHERE booking_id IN (SELECT id FROM m_bookings)
  AND NOT EXISTS (SELECT 1 FROM m_payments p WHERE p.booking_id = r.booking_id AND p.type = r.payment_type AND p.status = 'completed')
"""
S["payment_confirm_outcome"] = """
SELECT c.request_id, c.transaction_id, p.booking_id, p.type AS payment_type, outcome, outcome IN ('completed', 'already_completed') AS success,
       CASE WHEN outcome = 'completed' THEN requested_at END AS confirmed_at
FROM (SELECT q.*, CASE WHEN p.transaction_id IS NULL THEN 'missing' WHEN p.status = 'completed' THEN 'already_completed'
                       WHEN p.status = 'expired' THEN 'expired' WHEN p.status NOT IN ('pending', 'processing') THEN 'not_allowed'
                       WHEN min(requested_at) OVER (PARTITION BY q.transaction_id) > p.expires_at THEN 'expired'
                       WHEN row_number() OVER (PARTITION BY q.transaction_id ORDER BY requested_at, request_id) = 1 THEN 'completed'
                       ELSE 'already_completed' END AS outcome
      FROM (SELECT o_orderkey || '-1' AS request_id, 'T' || o_orderkey AS transaction_id, o_orderdate + INTERVAL 1 MINUTE * (o_orderkey % 45) AS requested_at FROM orders
            UNION ALL SELECT o_orderkey || '-2', 'T' || o_orderkey, o_orderdate + INTERVAL 25 MINUTE FROM orders
            UNION ALL SELECT o_orderkey || '-3', 'U' || o_orderkey, o_orderdate + INTERVAL 5 MINUTE FROM orders) q
      LEFT JOIN m_payments p ON q.transaction_id = p.transaction_id) c
LEFT JOIN m_payments p ON c.transaction_id = p.transaction_id
"""
S["webhook_outcomes"] = "SELECT * FROM m_webhook_outcomes"
S["payment_latest_status"] = """
SELECT p.transaction_id, p.booking_id, p.type, coalesce(w.status, p.status) AS status, coalesce(w.confirmed_at, p.confirmed_at) AS confirmed_at,
       coalesce(n_applied, 0) AS n_applied, coalesce(n_no_op, 0) AS n_no_op
FROM m_payments p LEFT JOIN (
  SELECT transaction_id, arg_max(status, (sent_at, webhook_id)) AS status,
         max(sent_at) FILTER (WHERE outcome = 'applied' AND status = 'completed') AS confirmed_at,
         count(*) FILTER (WHERE outcome = 'applied') AS n_applied, count(*) FILTER (WHERE outcome = 'no_op') AS n_no_op
  FROM m_webhook_outcomes WHERE outcome <> 'rejected' GROUP BY transaction_id) w ON p.transaction_id = w.transaction_id
"""
S["booking_status_from_payments"] = """
SELECT booking_id AS id, CASE type WHEN 'deposit' THEN 'paid_deposit' ELSE 'completed' END AS status, confirmed_at, transaction_id
FROM m_payments WHERE status = 'completed' AND type IN ('deposit', 'balance')
"""
S["payments_expired"] = """
SELECT transaction_id, booking_id, status AS old_status, 'expired' AS status, expires_at FROM m_payments
WHERE status IN ('pending', 'processing') AND expires_at < TIMESTAMP '1999-01-01 00:00:00'
"""

# --- streams ----------------------------------------------------------------------------

S["dead_letters"] = """
SELECT id, aggregate_type, aggregate_id, event_type, reason
FROM (SELECT *, CASE WHEN aggregate_type = 'other' THEN 'unknown_type' WHEN processed_at IS NULL AND retry_count >= 3 THEN 'retries_exhausted' END AS reason
      FROM m_outbox) WHERE reason IS NOT NULL
"""
S["delivery_state_next"] = """
SELECT id AS event_id, CAST(retry_count + CASE WHEN tried AND hits = 0 THEN 1 ELSE 0 END AS INT) AS attempts,
       coalesce(processed_at, CASE WHEN tried AND hits > 0 THEN TIMESTAMP '2024-01-29 00:00:00' END) AS delivered_at,
       CASE WHEN tried AND hits = 0 THEN 'all targets failed' END AS last_error
FROM (SELECT o.*, processed_at IS NULL AND retry_count < 3 AS tried,
             CASE WHEN event_id % 5 <> 0 THEN 1 ELSE 0 END + CASE WHEN value > 10 THEN 1 ELSE 0 END AS hits
      FROM m_outbox o JOIN events e ON o.id = CAST(e.event_id AS VARCHAR))
"""
S["sync_latency"] = """
SELECT aggregate_type, count(*) AS events, min(s) AS min_seconds, max(s) AS max_seconds, round(CAST(sum(s) AS DOUBLE) / count(*), 4) AS avg_seconds,
       round(quantile_cont(s, 0.5), 4) AS p50_seconds, round(quantile_cont(s, 0.95), 4) AS p95_seconds
FROM (SELECT aggregate_type, (epoch_us(processed_at) - epoch_us(created_at)) // 1000000 AS s FROM m_outbox WHERE processed_at IS NOT NULL)
GROUP BY aggregate_type
"""
S["stream_projection"] = """
SELECT *, unnest(['orders_rt', 'bookings']) AS collection FROM m_documents_now
"""
S["stream_event_log"] = f"""
SELECT *, unnest(['orders_rt', 'bookings']) AS sink FROM ({S["projection_latest"]})
UNION ALL BY NAME SELECT *, 'messages' AS sink FROM ({S["chat_messages_latest"]})
UNION ALL BY NAME
SELECT booking_id, replace(booking_id, 'B', 'uid-c') AS customerId, replace(booking_id, 'B', 'uid-d') AS driverId, '' AS customerName, '' AS driverName,
       'Stop ' || booking_id AS pickupAddress, date_trunc('day', message_at) AS bookingTime, message_text AS lastMessage, message_at AS lastMessageTime, 'rooms' AS sink
FROM (SELECT * FROM m_chat_events WHERE event_type <> 'deleted'
      QUALIFY row_number() OVER (PARTITION BY booking_id ORDER BY created_at DESC, message_id || '-' || seq DESC) = 1)
UNION ALL BY NAME
SELECT id, aggregate_type, aggregate_id, event_type, 'unknown_type' AS reason, 'parked' AS sink FROM m_outbox WHERE aggregate_type = 'other'
"""
# the first round with an answer, unless three rounds without one came before
S["stream_delivery"] = """
SELECT id AS event_id, CAST(least(coalesce(hit - 1, 4), 3) AS INT) AS attempts,
       CASE WHEN hit <= 3 THEN TIMESTAMP '2024-01-29 00:00:00' + INTERVAL 1 MINUTE * hit END AS delivered_at,
       CASE WHEN coalesce(hit, 9) > 1 THEN 'all targets failed' END AS last_error,
       CASE WHEN aggregate_type = 'other' THEN 'unknown_type' WHEN coalesce(hit, 9) > 3 THEN 'retries_exhausted' END AS reason
FROM m_outbox JOIN (SELECT event_id, min(CASE WHEN (event_id + r) % 4 = 0 OR (event_id + 2 * r) % 5 = 0 THEN r END) AS hit
                    FROM events, range(1, 5) AS rounds (r) GROUP BY event_id) ON id = CAST(event_id AS VARCHAR)
"""
S["stream_edges_any_order"] = _EDGES.replace("version,", "CAST(version AS BIGINT) AS version,")
S["stream_expiry_corrected"] = """
SELECT transaction_id, booking_id, status AS old_status, 'expired' AS status FROM m_payments WHERE status IN ('pending', 'processing')
"""
S["stream_commissions"] = """
SELECT scheme, booking_id, beneficiary_id, base_amount, rate, type, amount, accrued_at FROM m_ledger
UNION ALL SELECT 'driver_referral', booking_id, driver_referrer_id, platform_fee_before, driver_referral_commission_rate,
                 driver_referral_commission_type, driver_referral_commission, completed_at
FROM m_referral_commission WHERE driver_referrer_id IS NOT NULL
"""
S["stream_commission_totals"] = f"""
SELECT scheme, beneficiary_id, CAST(sum(amount) AS DECIMAL(20,2)) AS total_earnings, count(*) AS n_commissions
FROM ({S["stream_commissions"]}) GROUP BY scheme, beneficiary_id
"""
S["stream_completion_edges"] = _EDGES.replace("version,", "CAST(version AS BIGINT) AS version,")
S["stream_payment_ingest"] = """
SELECT CASE WHEN errors = '' THEN 'good' ELSE 'quarantine' END AS folder, status, count(*) AS n_webhooks FROM m_webhooks_checked GROUP BY 1, 2
"""
S["stream_dedup"] = "SELECT id, aggregate_id, event_type, created_at FROM m_outbox"
S["stream_expiry"] = """
SELECT transaction_id, booking_id, status AS old_status, 'expired' AS status FROM m_payments
WHERE status IN ('pending', 'processing') AND expires_at <= (SELECT max(created_at) FROM m_payments)
"""
S["stream_daily_earnings"] = _PLATFORM_DAILY.format(
    source="(SELECT * FROM m_bookings WHERE status = 'completed' AND completed_at IS NOT NULL)"
)

_LIVE = "m_live WHERE status = 'completed' AND completed_at IS NOT NULL AND CAST(completed_at AS DATE) BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'"
S["stream_daily_summary"] = _DAILY.format(source=_LIVE)
S["stream_platform_earnings"] = _PLATFORM.replace("m_completed", f"(SELECT * FROM {_LIVE})")
S["stream_driver_earnings"] = f"""
SELECT u.id AS driver_id, coalesce(total, CAST(0 AS DECIMAL(20,2))) AS total_earnings, coalesce(orders, 0) AS total_orders,
       coalesce({mean("cents", "paid")}, CAST(0 AS DECIMAL(20,2))) AS average_earnings
FROM m_users u LEFT JOIN (SELECT driver_id, CAST(sum(driver_earning) AS DECIMAL(20,2)) AS total, count(*) AS orders, count(driver_earning) AS paid,
                                 CAST(sum(driver_earning) * 100 AS BIGINT) AS cents
                          FROM {_LIVE} AND driver_id IS NOT NULL GROUP BY driver_id) d ON d.driver_id = u.id
WHERE u.role = 'driver'
"""

# --- quality ----------------------------------------------------------------------------

S["constraint_violations"] = """
SELECT 'bookings' AS table_name, 'passenger_count' AS "constraint", count(*) AS violations FROM m_bookings WHERE NOT (passenger_count BETWEEN 1 AND 20)
UNION ALL SELECT 'bookings', 'luggage_count', count(*) FROM m_bookings WHERE NOT (luggage_count BETWEEN 0 AND 50)
UNION ALL SELECT 'bookings', 'country_code', count(*) FROM m_bookings WHERE NOT regexp_matches(country, '^[A-Z]{2}$')
UNION ALL SELECT 'bookings', 'service_type', count(*) FROM m_bookings WHERE service_type NOT IN ('charter', 'instant_ride')
UNION ALL SELECT 'revenue_rules', 'company_percentage', count(*) FROM m_rules WHERE NOT (company_percentage BETWEEN 0 AND 100)
UNION ALL SELECT 'revenue_rules', 'driver_percentage', count(*) FROM m_rules WHERE NOT (driver_percentage BETWEEN 0 AND 100)
UNION ALL SELECT 'revenue_rules', 'percentage_sum', count(*) FROM m_rules WHERE company_percentage + driver_percentage <> 100
UNION ALL SELECT 'drivers', 'company_tax_id', count(*) FROM m_drivers WHERE NOT regexp_matches(company_tax_id, '^[0-9]{8}$')
"""
S["duplicate_keys"] = """
SELECT 'one referrer per referee' AS check_name, 'C' || o_custkey AS key, count(*) AS n_rows FROM orders GROUP BY o_custkey HAVING count(*) > 1
UNION ALL SELECT 'one live document per type', driver_id || '|' || type, count(*) FROM m_documents WHERE status <> 'rejected' GROUP BY driver_id, type HAVING count(*) > 1
UNION ALL SELECT 'one bank account per driver', 'D' || s_suppkey, 2 FROM supplier WHERE s_acctbal >= 0 AND s_nationkey % 6 = 0
UNION ALL SELECT 'one referrer per driver', referee_driver_id, count(*) FROM m_driver_referrals GROUP BY referee_driver_id HAVING count(*) > 1
UNION ALL SELECT 'one active rule per key', country || '|' || coalesce(region, '(null)') || '|' || service_type || '|' || CAST(has_promo_code AS VARCHAR), count(*)
          FROM m_rules WHERE is_active GROUP BY country, region, service_type, has_promo_code HAVING count(*) > 1
"""
S["orphan_rows"] = """
SELECT 'booking without driver record' AS check_name, driver_id AS value, count(*) AS n_rows FROM m_bookings
WHERE driver_id IS NOT NULL AND driver_id NOT IN (SELECT user_id FROM m_drivers) GROUP BY driver_id
UNION ALL SELECT 'event without booking', aggregate_id, count(*) FROM m_outbox
          WHERE aggregate_id NOT IN (SELECT id FROM m_bookings WHERE status <> 'cancelled') GROUP BY aggregate_id
"""
S["driver_completeness"] = """
SELECT u.id AS user_id, p.user_id IS NULL AS lacks_profile, d.user_id IS NULL AS lacks_driver_record
FROM m_users u LEFT JOIN m_profiles p ON u.id = p.user_id LEFT JOIN m_drivers d ON u.id = d.user_id
WHERE role = 'driver' AND (p.user_id IS NULL OR d.user_id IS NULL)
"""
_REQUIRED = ", ".join(f"('{t}', FALSE)" for t in DOCUMENT_TYPES) + ", " + ", ".join(
    f"('{t}', TRUE)" for t in INSTANT_RIDE_DOCUMENT_TYPES
)
S["document_compliance"] = f"""
SELECT d.user_id, (d.service_types IS NULL OR list_contains(d.service_types, 'instant_ride')) AS needs_instant, coalesce(string_agg(CASE WHEN c.status IS NULL THEN q.type END, ',' ORDER BY q.type), '') AS missing,
       coalesce(string_agg(CASE WHEN c.status = 'pending' THEN q.type END, ',' ORDER BY q.type), '') AS unapproved,
       bool_and(c.status IS NOT NULL AND c.status = 'approved') AS is_compliant
FROM m_drivers d JOIN (VALUES {_REQUIRED}) AS q(type, instant_only) ON NOT q.instant_only OR (d.service_types IS NULL OR list_contains(d.service_types, 'instant_ride'))
LEFT JOIN (SELECT * FROM (SELECT driver_id, url, status, uploaded_at, unnest(CASE type WHEN 'id_card' THEN ['id_card_front', 'id_card_back'] WHEN 'license' THEN ['drivers_license']
                            WHEN 'insurance' THEN ['insurance_policy'] ELSE [type] END) AS type FROM m_documents WHERE status <> 'rejected')
           QUALIFY row_number() OVER (PARTITION BY driver_id, type ORDER BY uploaded_at DESC, url DESC) = 1) c
  ON d.user_id = c.driver_id AND q.type = c.type
GROUP BY d.user_id, d.service_types
"""
S["photos_unpivot"] = "SELECT * FROM (" + "\nUNION ALL ".join(
    f"SELECT driver_id, '{name}' AS photo_type, {column} AS url FROM m_photos_wide" for column, name in WIDE_PHOTO_COLUMNS.items()
) + ") WHERE url IS NOT NULL"
S["photos_pivot"] = "SELECT * FROM m_photos_wide"
S["documents_unpivot"] = "SELECT * FROM (" + "\nUNION ALL ".join(
    f"SELECT 'D' || s_suppkey AS driver_id, '{name}' AS type, CASE WHEN (s_nationkey + {i}) % 4 <> 0 THEN 'doc/' || s_suppkey || '/{column}' END AS url FROM supplier"
    for i, (column, name) in enumerate(WIDE_DOCUMENT_COLUMNS.items())
) + ") WHERE url IS NOT NULL"
S["documents_pivot"] = f"""
SELECT driver_id, {", ".join(f"max(CASE WHEN type = '{name}' THEN url END) AS {column}" for column, name in WIDE_DOCUMENT_COLUMNS.items())}
FROM (SELECT * FROM (
        SELECT driver_id, url, status, uploaded_at, unnest(CASE type WHEN 'id_card' THEN ['id_card_front', 'id_card_back'] WHEN 'license' THEN ['drivers_license']
               WHEN 'insurance' THEN ['insurance_policy'] ELSE [type] END) AS type FROM m_documents WHERE status <> 'rejected')
      QUALIFY row_number() OVER (PARTITION BY driver_id, type ORDER BY uploaded_at DESC, url DESC) = 1)
GROUP BY driver_id
"""
S["payload_completeness"] = """
SELECT CASE WHEN version = 1 THEN 'created' ELSE 'updated' END AS event_type, count(*) AS events, count(deposit_paid) AS "with_depositPaid",
       count(d.external_uid) AS "with_driverId", count(d.name) AS "with_driverName", count(promo_code) AS "with_promoCode", count(completed_at) AS "with_completedAt"
FROM m_changes b LEFT JOIN m_cards d ON b.driver_id = d.id GROUP BY 1
"""
S["stuck_matched_orders"] = """
SELECT id, booking_number, driver_id, created_at, updated_at FROM m_bookings WHERE status = 'matched' AND driver_id IS NOT NULL
"""
S["settings_drift"] = """
SELECT id, field, expected, json_extract_string(payload, '$.' || field) AS actual
FROM m_outbox, (VALUES ('k', '42'), ('currency', 'TWD')) AS e(field, expected)
WHERE json_extract_string(payload, '$.' || field) IS DISTINCT FROM expected
"""
S["fee_anomalies"] = """
SELECT * FROM (SELECT booking_id, platform_fee_before, driver_referral_commission, platform_fee,
       CASE WHEN platform_fee_before < 0 THEN 'negative_fee' WHEN driver_referral_commission > 0 AND driver_referral_commission = platform_fee_before THEN 'capped'
            WHEN platform_fee < 0 THEN 'over_deducted' END AS anomaly FROM m_referral_commission)
WHERE anomaly IS NOT NULL
"""
S["split_residual"] = """
SELECT * FROM (SELECT id, total_amount, platform_fee, driver_earning,
       CAST(coalesce(total_amount, 0) - platform_fee - (platform_fee_gross - platform_fee) - driver_earning AS DECIMAL(10,2)) AS residual FROM m_split)
WHERE residual <> 0
"""
S["missing_commissions"] = """
SELECT booking_id, customer_id, owner AS beneficiary_id, changed_at AS completed_at FROM m_affiliate_outcomes
WHERE is_edge AND NOT is_insert AND nth = 1 AND owner IS NOT NULL AND type IS NULL
  AND booking_id NOT IN (SELECT booking_id FROM m_usage WHERE commission_status = 'completed')
"""


def statements() -> dict[str, str]:
    return {name: with_views(sql) for name, sql in S.items()}
