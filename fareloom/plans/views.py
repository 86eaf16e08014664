"""The entity views once more, as SQL over the raw tables, for the statements in ``oracle``.

Written apart from the DataFrame views on purpose: a mistake in one shows as a difference.
"""

from __future__ import annotations

import re

from fareloom.schemas import DEPOSIT_PAID_STATUSES

# view name -> SQL; a view may use the ones above it
VIEWS: dict[str, str] = {}

VIEWS["m_users"] = """
SELECT 'C' || c_custkey AS id, CASE WHEN c_acctbal >= 9800 THEN 'admin' ELSE 'customer' END AS role, c_name AS name,
       lower(replace(c_name, '#', '.')) || '@rider.example' AS email,
       CASE WHEN c_acctbal < 0 THEN 'suspended' ELSE 'active' END AS status, 'uid-c' || c_custkey AS external_uid
FROM customer
UNION ALL
SELECT 'D' || s_suppkey, 'driver', s_name, lower(replace(s_name, '#', '.')) || '@driver.example',
       CASE WHEN s_acctbal < 0 THEN 'suspended' ELSE 'active' END, 'uid-d' || s_suppkey
FROM supplier
"""

VIEWS["m_profiles"] = """
SELECT prefix || k AS user_id,
       CASE WHEN n NOT IN (3, 4) THEN split_part(full_name, '#', 1) END AS first_name,
       CASE WHEN n NOT IN (4, 5) THEN split_part(full_name, '#', 2) END AS last_name,
       CASE WHEN n >= 5 THEN '+886-' || k END AS phone
FROM (SELECT 'C' AS prefix, c_custkey AS k, c_name AS full_name, c_nationkey AS n, c_acctbal AS bal FROM customer
      UNION ALL SELECT 'D', s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier)
WHERE bal >= -400
"""

VIEWS["m_drivers"] = """
SELECT 'DR' || s_suppkey AS id, 'D' || s_suppkey AS user_id,
       CASE WHEN s_acctbal < 5000 THEN 'small' ELSE 'large' END AS vehicle_type,
       CAST(CAST(300 + 8 * s_nationkey AS DECIMAL(5,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(3,2)) AS rating,
       CAST(floor(s_acctbal / 40) AS INT) AS total_trips, s_acctbal > 1000 AS is_available,
       CASE WHEN s_nationkey < 12 THEN lpad(CAST(s_suppkey AS VARCHAR), 8, '0')
            WHEN s_nationkey < 15 THEN CAST(s_suppkey AS VARCHAR) END AS company_tax_id,
       CASE s_nationkey % 3 WHEN 0 THEN ['charter'] WHEN 1 THEN ['instant_ride', 'charter'] END AS service_types
FROM supplier WHERE s_acctbal >= 0
"""

VIEWS["m_vehicles"] = """
SELECT 'DR' || s_suppkey AS driver_id, 'P-' || s_suppkey AS plate_number, 'Model ' || s_nationkey AS model,
       s_nationkey <> 7 AS is_primary FROM supplier
UNION ALL SELECT 'DR' || s_suppkey, 'S-' || s_suppkey, 'Model ' || s_nationkey, FALSE FROM supplier
"""


def _share(percent: str) -> str:
    return f"CAST(total_amount * CAST({percent} AS DECIMAL(3,2)) AS DECIMAL(10,2))"


VIEWS["m_bookings"] = f"""
SELECT 'B' || k AS id, 'BK' || lpad(CAST(k AS VARCHAR), 12, '0') AS booking_number, 'C' || c AS customer_id,
       'D' || sk AS driver_id,
       CASE WHEN st = 'F' THEN 'completed' WHEN st = 'P' THEN 'trip_ended' WHEN pr = '1-URGENT' THEN 'paid_deposit'
            WHEN pr = '2-HIGH' THEN 'matched' WHEN pr = '3-MEDIUM' THEN 'pending_payment'
            WHEN pr = '4-NOT SPECIFIED' THEN 'driver_confirmed' ELSE 'cancelled' END AS status,
       CAST(t + INTERVAL 2 DAY AS DATE) AS start_date,
       CASE WHEN k % 6 <> 0 THEN lpad(CAST(k % 24 AS VARCHAR), 2, '0') || ':30:00' END AS start_time,
       CAST(4 + k % 8 AS INT) AS duration_hours,
       CASE WHEN pr IN ('1-URGENT', '2-HIGH') THEN 'large' ELSE 'small' END AS vehicle_type,
       'Stop ' || c AS pickup_location, CASE WHEN c % 10 <> 0 THEN 'Stop ' || (c % 10) END AS destination,
       CAST(25 + CAST(c % 1000 AS DECIMAL(10,0)) * CAST(0.001 AS DECIMAL(4,3)) AS DECIMAL(10,8)) AS pickup_latitude,
       CASE WHEN c % 9 <> 0 THEN CAST(121 + CAST(c % 500 AS DECIMAL(10,0)) * CAST(0.002 AS DECIMAL(4,3)) AS DECIMAL(11,8)) END AS pickup_longitude,
       CASE WHEN pr <> '5-LOW' THEN CAST(24.5 AS DECIMAL(10,8)) END AS dropoff_latitude,
       CASE WHEN pr <> '5-LOW' THEN CAST(120.25 AS DECIMAL(11,8)) END AS dropoff_longitude,
       CASE WHEN c % 4 = 0 THEN 'child seat' WHEN c % 4 = 1 THEN '' END AS special_requirements,
       c % 6 = 0 AS requires_foreign_language, CAST(k % 24 AS INT) AS passenger_count, CAST(c % 60 AS INT) AS luggage_count,
       total_amount AS base_price,
       CAST(CASE WHEN c % 6 = 0 THEN 500 ELSE 0 END AS DECIMAL(10,2)) AS foreign_language_surcharge,
       CASE WHEN k % 5 = 0 THEN CAST(120.50 AS DECIMAL(10,2)) END AS overtime_fee,
       CASE WHEN k % 7 = 0 THEN CAST(66.60 AS DECIMAL(10,2)) END AS tip_amount,
       total_amount, {_share("0.25")} AS deposit_amount,
       CASE WHEN k % 13 <> 0 THEN k % 4 <> 0 END AS deposit_paid,
       CASE WHEN k % 10 = 1 THEN {_share("0.30")} WHEN k % 10 <> 0 THEN {_share("0.25")} END AS platform_fee,
       CASE WHEN k % 10 = 1 THEN {_share("0.70")} WHEN k % 10 <> 0 THEN {_share("0.75")} END AS driver_earning,
       CASE WHEN c % 8 = 0 THEN 'TP' || (c % 40) END AS tour_package_id,
       CASE WHEN c % 8 = 0 THEN 'Tour ' || (c % 40) END AS tour_package_name,
       CASE WHEN c % 3 = 0 THEN 'P' || (c % 20) END AS promo_code, CASE WHEN c % 3 = 0 THEN 'I' || (c % 20) END AS influencer_id,
       CASE WHEN c % 3 = 0 THEN {_share("0.05")} END AS influencer_commission,
       CASE WHEN c % 3 = 0 THEN CAST(total_amount + 1000 AS DECIMAL(10,2)) END AS original_price,
       CASE WHEN c % 3 = 0 THEN CAST(1000 AS DECIMAL(10,2)) END AS discount_amount,
       CASE WHEN c % 3 = 0 THEN total_amount END AS final_price,
       CASE WHEN c % 7 = 0 THEN lpad(CAST(c AS VARCHAR), 8, '0') WHEN c % 7 = 1 THEN CAST(c AS VARCHAR) END AS tax_id,
       CASE WHEN c % 5 = 4 THEN 'JP' WHEN c % 5 <> 3 THEN 'TW' END AS country,
       CASE WHEN c % 4 = 0 THEN 'north' WHEN c % 4 = 1 THEN 'south' END AS region,
       CASE WHEN pr IN ('1-URGENT', '2-HIGH') THEN 'instant_ride' WHEN pr <> '5-LOW' THEN 'charter' END AS service_type,
       t AS created_at, t + INTERVAL 1 DAY AS updated_at,
       CASE WHEN st <> 'O' THEN t + INTERVAL 20 HOUR END AS actual_start_time,
       CASE WHEN st = 'F' AND k % 3 <> 0 THEN t + INTERVAL 23 HOUR END AS actual_end_time,
       CASE WHEN st = 'F' THEN t + INTERVAL 1 DAY END AS completed_at
FROM (SELECT o_orderkey AS k, o_custkey AS c, o_orderstatus AS st, o_orderpriority AS pr, o_orderdate AS t, sk,
             CAST(o_totalprice AS DECIMAL(10,2)) AS total_amount
      FROM orders LEFT JOIN (SELECT l_orderkey, min(l_suppkey) AS sk FROM lineitem GROUP BY l_orderkey) ON o_orderkey = l_orderkey)
"""

VIEWS["m_changes"] = """
SELECT * REPLACE (CASE WHEN status = 'completed' AND duration_hours = 7 THEN 'completed' ELSE 'pending_payment' END AS status),
       1 AS version, created_at AS changed_at FROM m_bookings
UNION ALL SELECT *, 2, created_at + INTERVAL 1 DAY FROM m_bookings
UNION ALL SELECT * REPLACE ('pending_balance' AS status), 3, created_at + INTERVAL 2 DAY FROM m_bookings
          WHERE status = 'completed' AND vehicle_type = 'large'
UNION ALL SELECT *, 4, created_at + INTERVAL 3 DAY FROM m_bookings WHERE status = 'completed' AND vehicle_type = 'large'
"""

# the newest change of each booking that is not deleted, as if it were the booking
VIEWS["m_live"] = """
SELECT * FROM m_changes WHERE passenger_count <> 5 QUALIFY row_number() OVER (PARTITION BY id ORDER BY version DESC) = 1
"""

VIEWS["m_influencers"] = """
SELECT 'I' || k AS id, CAST(1000 + 100 * k AS DECIMAL(10,2)) AS commission_fixed,
       CAST(5 + CAST(k AS DECIMAL(4,0)) * CAST(0.125 AS DECIMAL(4,3)) AS DECIMAL(9,6)) AS commission_percent,
       k % 4 = 0 AS is_commission_fixed_active, k % 5 <> 1 AS is_commission_percent_active,
       CASE WHEN k % 2 = 0 THEN 'unified' ELSE 'by_service_type' END AS commission_type,
       CASE WHEN k % 3 <> 0 THEN CAST(4.5 AS DECIMAL(9,6)) END AS commission_percent_charter,
       CASE WHEN k % 3 <> 1 THEN CAST(6.25 AS DECIMAL(9,6)) END AS commission_percent_instant_ride,
       k <> 7 AS is_active, 'Influencer ' || k AS name
FROM (SELECT DISTINCT c_custkey % 20 AS k FROM customer)
"""

VIEWS["m_referrals"] = """
SELECT 'C' || c_custkey AS referee_id, 'C' || (c_custkey // 2) AS referrer_id, 'I' || (c_custkey % 20) AS influencer_id,
       'P' || (c_custkey % 20) AS promo_code
FROM customer WHERE c_acctbal >= 2000
"""

VIEWS["m_driver_affiliates"] = """
SELECT 'D' || s_suppkey AS driver_id, CASE WHEN s_nationkey % 8 = 0 THEN 'suspended' ELSE 'active' END AS affiliate_status,
       s_nationkey % 9 <> 1 AS is_active, s_suppkey % 2 = 0 AS commission_fixed_enabled,
       CAST(s_suppkey % 4 * 2000 AS DECIMAL(10,2)) AS commission_fixed, s_nationkey % 10 <> 3 AS commission_percent_enabled,
       CAST(1.5 AS DECIMAL(9,6)) AS commission_percent,
       CASE WHEN s_nationkey > 15 THEN CAST(2 AS DECIMAL(9,6)) END AS commission_percent_charter,
       CASE WHEN s_nationkey < 10 THEN CAST(3.25 AS DECIMAL(9,6)) END AS commission_percent_instant_ride
FROM supplier WHERE s_acctbal >= 1000
"""

VIEWS["m_driver_referrals"] = """
SELECT 'D' || (s_suppkey // 2) AS referrer_driver_id, 'D' || s_suppkey AS referee_driver_id
FROM supplier WHERE s_suppkey // 2 <> s_suppkey
"""

VIEWS["m_rules"] = """
SELECT id, country, region, service_type, has_promo_code, CAST(c AS DECIMAL(5,2)) AS company_percentage,
       CAST(d AS DECIMAL(5,2)) AS driver_percentage, CAST(b AS DECIMAL(5,2)) AS company_base_percentage, is_active, priority,
       CAST(since AS TIMESTAMP) AS created_at
FROM (VALUES ('R1', 'TW', NULL, 'charter', FALSE, 25, 75, NULL, TRUE, 0, '2024-01-01'),
             ('R2', 'TW', NULL, 'charter', TRUE, 30, 70, 30, TRUE, 0, '2024-01-01'),
             ('R3', 'TW', NULL, 'instant_ride', FALSE, 20, 80, NULL, TRUE, 0, '2024-01-01'),
             ('R4', 'TW', NULL, 'instant_ride', FALSE, 22, 78, NULL, TRUE, 5, '2024-01-01'),
             ('R5', 'JP', NULL, 'charter', FALSE, 28, 72, NULL, TRUE, 0, '2024-01-01'),
             ('R6', 'TW', 'north', 'charter', FALSE, 26, 74, NULL, TRUE, 0, '2024-01-01'),
             ('R7', 'TW', 'north', 'charter', FALSE, 27, 73, NULL, TRUE, 0, '2024-02-01'),
             ('R8', 'TW', 'south', 'charter', TRUE, 33, 67, 33, FALSE, 9, '2024-01-01'))
     AS t(id, country, region, service_type, has_promo_code, c, d, b, is_active, priority, since)
"""

VIEWS["m_outbox"] = """
SELECT CAST(event_id AS VARCHAR) AS id,
       CASE WHEN event_type = 'error' THEN 'other' WHEN event_type = 'click' THEN 'chat_message' ELSE 'booking' END AS aggregate_type,
       'B' || user_id AS aggregate_id,
       CASE WHEN event_id % 17 = 0 THEN 'deleted' WHEN event_type = 'signup' THEN 'created' ELSE 'updated' END AS event_type,
       props AS payload, CAST(value AS DECIMAL(10,2)) AS amount, ts AS created_at,
       CASE WHEN event_id % 4 <> 0 THEN ts + INTERVAL 1 SECOND * (event_id % 120) END AS processed_at,
       CAST(CASE WHEN event_id % 4 = 0 THEN event_id % 5 ELSE 0 END AS INT) AS retry_count
FROM events
"""

VIEWS["m_payments"] = """
SELECT 'T' || o_orderkey AS transaction_id, 'B' || o_orderkey AS booking_id, 'C' || o_custkey AS customer_id,
       CASE o_orderkey % 3 WHEN 0 THEN 'deposit' WHEN 1 THEN 'balance' ELSE 'tip' END AS type,
       CAST(CAST(o_totalprice AS DECIMAL(10,2)) * CAST(0.25 AS DECIMAL(3,2)) AS DECIMAL(10,2)) AS amount, 'TWD' AS currency,
       CASE o_orderkey % 7 WHEN 0 THEN 'pending' WHEN 1 THEN 'processing' WHEN 2 THEN 'completed' WHEN 3 THEN 'failed'
            WHEN 4 THEN 'cancelled' WHEN 5 THEN 'expired' ELSE 'refunded' END AS status,
       o_orderdate AS created_at, o_orderdate + INTERVAL 30 MINUTE AS expires_at,
       CASE WHEN o_orderkey % 7 = 2 THEN o_orderdate + INTERVAL 10 MINUTE END AS confirmed_at
FROM orders
"""

VIEWS["m_usage"] = """
SELECT id AS booking_id, influencer_id, promo_code, original_price, discount_amount AS discount_amount_applied, final_price,
       CAST(0 AS DECIMAL(10,2)) AS commission_amount,
       CASE WHEN duration_hours = 5 THEN 'completed' WHEN duration_hours <> 6 THEN 'pending' END AS commission_status,
       CAST(NULL AS VARCHAR) AS commission_type, CAST(NULL AS DECIMAL(9,6)) AS commission_rate,
       CAST(NULL AS DECIMAL(10,2)) AS order_amount, CAST(NULL AS VARCHAR) AS referee_id, created_at AS used_at
FROM m_bookings WHERE promo_code IS NOT NULL
"""

VIEWS["m_chat"] = """
SELECT booking_id, message_id, sender_id, receiver_id, sender_name, message_text, message_at, read_at, 'created' AS event_type, 1 AS seq,
       message_at AS created_at, CAST(NULL AS VARCHAR) AS translated_text, role
FROM (SELECT 'B' || conv_id AS booking_id, conv_id || '-' || turn AS message_id,
             CASE WHEN role = 'user' THEN 'C' || conv_id ELSE 'D' || conv_id END AS sender_id,
             CASE WHEN role = 'user' THEN 'D' || conv_id ELSE 'C' || conv_id END AS receiver_id, text AS message_text, role,
             CASE WHEN role <> 'system' THEN 'the ' || role END AS sender_name,
             TIMESTAMP '2024-01-01 00:00:00' + INTERVAL 1 DAY * (conv_id % 30) + INTERVAL 1 MINUTE * turn AS message_at,
             CASE WHEN turn < 2 THEN TIMESTAMP '2024-01-01 01:00:00' + INTERVAL 1 DAY * (conv_id % 30) + INTERVAL 1 MINUTE * turn END AS read_at
      FROM conversations)
"""

VIEWS["m_chat_events"] = """
SELECT * EXCLUDE (role) FROM m_chat
UNION ALL SELECT * EXCLUDE (role) REPLACE ('updated' AS event_type, 2 AS seq, message_at + INTERVAL 5 SECOND AS created_at,
                                           '[' || message_text || ']' AS translated_text) FROM m_chat WHERE role = 'assistant'
UNION ALL SELECT * EXCLUDE (role) REPLACE ('deleted' AS event_type, 3 AS seq, message_at + INTERVAL 9 SECOND AS created_at)
          FROM m_chat WHERE length(message_text) < 60
"""

VIEWS["m_requests"] = """
SELECT l_orderkey || '-' || l_linenumber AS request_id,
       CASE WHEN l_tax > 0.07 THEN '' WHEN l_quantity > 48 THEN 'X' || l_orderkey ELSE 'B' || l_orderkey END AS booking_id,
       CASE WHEN l_discount < 0.09 THEN 'C' || l_suppkey END AS customer_id,
       CAST(l_extendedprice - 2000 AS DECIMAL(10,2)) AS amount,
       CASE WHEN l_linestatus = 'O' THEN 'TWD' WHEN l_tax > 0.01 THEN 'JPY' END AS currency,
       CASE WHEN l_returnflag = 'A' THEN 'deposit' WHEN l_returnflag = 'N' THEN 'balance' WHEN l_linestatus = 'O' THEN 'tip'
            ELSE 'voucher' END AS payment_type,
       l_shipdate AS requested_at
FROM lineitem
"""

VIEWS["m_requests_checked"] = """
SELECT *, concat_ws(',', CASE WHEN coalesce(booking_id, '') = '' THEN 'booking_id' END,
                    CASE WHEN coalesce(customer_id, '') = '' THEN 'customer_id' END,
                    CASE WHEN amount IS NULL OR amount <= 0 THEN 'amount' END,
                    CASE WHEN coalesce(currency, '') = '' THEN 'currency' END,
                    CASE WHEN payment_type IS NULL OR payment_type NOT IN ('deposit', 'balance', 'tip', 'refund') THEN 'payment_type' END) AS errors
FROM m_requests
"""

VIEWS["m_webhooks"] = """
SELECT CAST(event_id AS VARCHAR) AS webhook_id, CASE WHEN value > 1 THEN 'T' || user_id ELSE '' END AS transaction_id,
       CASE WHEN event_id % 9 <> 0 THEN 'ext-' || event_id END AS external_transaction_id,
       CASE event_type WHEN 'signup' THEN 'pending' WHEN 'click' THEN 'processing' WHEN 'purchase' THEN 'completed'
            WHEN 'view' THEN 'failed' ELSE 'invalid-status' END AS status,
       CAST(value - 5 AS DECIMAL(10,2)) AS amount, 'TWD' AS currency, ts AS sent_at
FROM events
"""

VIEWS["m_webhooks_checked"] = """
SELECT *, concat_ws(',', CASE WHEN coalesce(transaction_id, '') = '' THEN 'transaction_id' END,
                    CASE WHEN coalesce(external_transaction_id, '') = '' THEN 'external_transaction_id' END,
                    CASE WHEN status NOT IN ('pending', 'processing', 'completed', 'failed', 'cancelled', 'expired', 'refunded') THEN 'status' END,
                    CASE WHEN amount IS NULL OR amount <= 0 THEN 'amount' END) AS errors
FROM m_webhooks
"""

VIEWS["m_webhook_outcomes"] = """
SELECT webhook_id, w.transaction_id, p.booking_id, p.type AS payment_type, w.status, sent_at,
       CASE WHEN p.transaction_id IS NULL THEN 'rejected'
            WHEN w.status = coalesce(lag(w.status) OVER (PARTITION BY w.transaction_id ORDER BY sent_at, webhook_id), p.status)
            THEN 'no_op' ELSE 'applied' END AS outcome
FROM m_webhooks_checked w LEFT JOIN m_payments p ON w.transaction_id = p.transaction_id
WHERE errors = ''
"""

VIEWS["m_documents"] = """
SELECT 'D' || l_suppkey AS driver_id,
       (['id_card_front', 'id_card_back', 'drivers_license', 'vehicle_registration', 'insurance_policy', 'police_clearance',
         'no_accident_record', 'selfie_photo', 'taxi_permit', 'id_card', 'license', 'insurance'])[CAST(l_partkey % 12 + 1 AS INT)] AS type,
       'doc/' || l_orderkey || '/' || l_linenumber AS url,
       CASE l_returnflag WHEN 'A' THEN 'approved' WHEN 'N' THEN 'pending' ELSE 'rejected' END AS status, l_shipdate AS uploaded_at
FROM lineitem
"""

VIEWS["m_photos_wide"] = """
SELECT 'D' || s_suppkey AS driver_id,
       'photo/' || s_suppkey || '/front_left_url' AS front_left_url, 'photo/' || s_suppkey || '/front_right_url' AS front_right_url,
       CASE WHEN s_acctbal >= 5000 THEN 'photo/' || s_suppkey || '/rear_left_url' END AS rear_left_url,
       CASE WHEN s_acctbal >= 5000 THEN 'photo/' || s_suppkey || '/rear_right_url' END AS rear_right_url,
       'photo/' || s_suppkey || '/interior_front_url' AS interior_front_url,
       CASE WHEN s_acctbal >= 5000 THEN 'photo/' || s_suppkey || '/interior_rear1_url' END AS interior_rear1_url,
       CASE WHEN s_acctbal >= 5000 THEN 'photo/' || s_suppkey || '/interior_rear2_url' END AS interior_rear2_url,
       CASE WHEN s_acctbal >= 5000 THEN 'photo/' || s_suppkey || '/interior_rear3_url' END AS interior_rear3_url,
       'photo/' || s_suppkey || '/trunk_url' AS trunk_url
FROM supplier
"""

# --- derived steps that several statements share ----------------------------------------

VIEWS["m_edges_all"] = """
SELECT *, lag(status) OVER w AS previous_status, lag(version) OVER w IS NULL AS is_insert,
       status = 'completed' AND (lag(status) OVER w IS NULL OR lag(status) OVER w <> 'completed') AS is_edge
FROM m_changes WINDOW w AS (PARTITION BY id ORDER BY version)
"""

VIEWS["m_completed"] = """
SELECT * FROM m_bookings
WHERE status = 'completed' AND completed_at IS NOT NULL
  AND CAST(completed_at AS DATE) BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'
"""

def mean(cents: str, n: str) -> str:
    """Mean of an amount given in whole cents, half up; integers throughout, so exact."""
    rounded = f"CAST((2 * {cents} + {n}) // (2 * {n}) AS DECIMAL(18,0))"
    return f"CASE WHEN {n} > 0 THEN CAST({rounded} * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(20,2)) END"


VIEWS["m_per_driver"] = """
SELECT driver_id, CAST(sum(driver_earning) AS DECIMAL(20,2)) AS total_earnings, count(*) AS total_orders,
       count(driver_earning) AS paid, CAST(sum(driver_earning) * 100 AS BIGINT) AS cents
FROM m_completed WHERE driver_id IS NOT NULL GROUP BY driver_id
"""

VIEWS["m_driver_list"] = f"""
SELECT driver_id, total_earnings, total_orders, {mean("cents", "paid")} AS average_earnings
FROM m_per_driver
"""

VIEWS["m_influenced"] = """
SELECT b.*, i.id IS NOT NULL AS known, coalesce(i.is_commission_fixed_active, FALSE) AS f,
       coalesce(i.is_commission_percent_active, FALSE) AND NOT coalesce(i.is_commission_fixed_active, FALSE) AS p,
       coalesce(i.commission_fixed, 0) AS fixed, i.commission_percent,
       CASE WHEN i.commission_type = 'by_service_type' AND coalesce(service_type, 'charter') = 'charter'
            THEN coalesce(i.commission_percent_charter, i.commission_percent)
            WHEN i.commission_type = 'by_service_type' AND coalesce(service_type, 'charter') = 'instant_ride'
            THEN coalesce(i.commission_percent_instant_ride, i.commission_percent)
            ELSE i.commission_percent END AS percent_by_service
FROM m_bookings b LEFT JOIN m_influencers i ON b.influencer_id = i.id
"""


def pct(amount: str, percent: str, kind: str = "DECIMAL(5,2)") -> str:
    """``percent`` of ``amount`` to cents: decimals throughout, no division."""
    return f"CAST(round({amount} * CAST({percent} AS {kind}) * CAST(0.01 AS DECIMAL(3,2)), 2) AS DECIMAL(10,2))"


VIEWS["m_commissions"] = f"""
SELECT * EXCLUDE (known, f, p, fixed, commission_percent, percent_by_service, influencer_commission),
       CASE WHEN influencer_id IS NOT NULL THEN CASE WHEN f THEN 'fixed' WHEN p THEN 'percent' ELSE 'none' END END AS influencer_commission_type,
       CASE WHEN p THEN CAST(coalesce(percent_by_service, 0) AS DECIMAL(5,2)) ELSE CAST(0 AS DECIMAL(5,2)) END AS influencer_commission_rate,
       CASE WHEN f THEN CAST(fixed AS DECIMAL(10,2)) ELSE CAST(0 AS DECIMAL(10,2)) END AS influencer_commission_fixed,
       CASE WHEN f THEN CAST(fixed AS DECIMAL(10,2))
            WHEN p THEN {pct("coalesce(total_amount, 0)", "coalesce(percent_by_service, 0)")}
            ELSE CAST(0 AS DECIMAL(10,2)) END AS influencer_commission
FROM m_influenced
"""

VIEWS["m_shares"] = """
SELECT b.id, r.id AS rule_id,
       CASE WHEN r.id IS NOT NULL THEN 'rule' WHEN coalesce(promo_code, '') <> '' THEN 'settings' ELSE 'default' END AS share_origin,
       CAST(CASE WHEN r.id IS NOT NULL THEN r.company_percentage WHEN coalesce(promo_code, '') <> '' THEN 32 ELSE 25 END AS DECIMAL(5,2)) AS company_percentage,
       CAST(CASE WHEN r.id IS NOT NULL THEN r.driver_percentage WHEN coalesce(promo_code, '') <> '' THEN 68 ELSE 75 END AS DECIMAL(5,2)) AS driver_percentage
FROM m_bookings b
LEFT JOIN (SELECT * FROM m_rules WHERE is_active AND region IS NULL
           QUALIFY row_number() OVER (PARTITION BY country, service_type, has_promo_code ORDER BY priority DESC, created_at DESC, id DESC) = 1) r
  ON r.country = coalesce(b.country, 'TW') AND r.service_type = coalesce(b.service_type, 'charter')
 AND r.has_promo_code = (coalesce(b.promo_code, '') <> '')
"""

VIEWS["m_split"] = f"""
SELECT c.* EXCLUDE (platform_fee, driver_earning), s.* EXCLUDE (id),
       {pct("coalesce(total_amount, 0)", "company_percentage")} AS platform_fee_gross,
       {pct("coalesce(total_amount, 0)", "driver_percentage")} AS driver_earning,
       CAST({pct("coalesce(total_amount, 0)", "company_percentage")}
            - CASE WHEN influencer_commission > 0 AND coalesce(promo_code, '') <> '' THEN influencer_commission ELSE 0 END
            AS DECIMAL(10,2)) AS platform_fee
FROM m_commissions c JOIN m_shares s ON c.id = s.id
"""

VIEWS["m_first_completion"] = """
SELECT id, changed_at AS done_at FROM m_edges_all WHERE is_edge
QUALIFY row_number() OVER (PARTITION BY id ORDER BY version) = 1
"""

VIEWS["m_referral_commission"] = f"""
SELECT id AS booking_id, driver_id, CASE WHEN a IS NOT NULL THEN referrer_driver_id END AS driver_referrer_id,
       CASE WHEN a IS NOT NULL THEN kind END AS driver_referral_commission_type,
       CAST(CASE WHEN kind = 'percent' THEN rate ELSE 0 END AS DECIMAL(9,6)) AS driver_referral_commission_rate,
       platform_fee AS platform_fee_before, amount AS driver_referral_commission,
       CAST(platform_fee - amount AS DECIMAL(10,2)) AS platform_fee, done_at AS completed_at
FROM (SELECT *, CASE WHEN a IS NULL THEN CAST(0 AS DECIMAL(10,2))
                     ELSE CAST(least(CASE kind WHEN 'fixed' THEN commission_fixed
                                     WHEN 'percent' THEN {pct("coalesce(platform_fee, 0)", "rate", "DECIMAL(9,6)")}
                                     ELSE CAST(0 AS DECIMAL(10,2)) END, coalesce(platform_fee, 0)) AS DECIMAL(10,2)) END AS amount
      FROM (SELECT s.id, s.driver_id, s.platform_fee, f.done_at, r.referrer_driver_id, a.driver_id AS a, a.commission_fixed,
                   CASE WHEN a.commission_fixed_enabled AND a.commission_fixed > 0 THEN 'fixed'
                        WHEN a.commission_percent_enabled THEN 'percent' END AS kind,
                   coalesce(CASE coalesce(s.service_type, 'charter') WHEN 'charter' THEN a.commission_percent_charter
                                 WHEN 'instant_ride' THEN a.commission_percent_instant_ride END, a.commission_percent, 0) AS rate
            FROM m_split s JOIN m_first_completion f ON s.id = f.id
            LEFT JOIN m_driver_referrals r ON s.driver_id = r.referee_driver_id
            LEFT JOIN (SELECT * FROM m_driver_affiliates WHERE affiliate_status = 'active' AND is_active) a
              ON r.referrer_driver_id = a.driver_id))
"""


def _affiliate(owner: str, join: str) -> str:
    return f"""
SELECT e.id AS booking_id, version, previous_status, status, is_insert, is_edge, customer_id, {owner} AS owner, total_amount, changed_at,
       i.id IS NOT NULL AS active,
       CASE WHEN i.is_commission_fixed_active THEN 'fixed' WHEN i.is_commission_percent_active THEN 'percent' END AS type,
       CASE WHEN NOT i.is_commission_fixed_active AND i.is_commission_percent_active THEN i.commission_percent END AS rate,
       CASE WHEN i.is_commission_fixed_active THEN i.commission_fixed
            WHEN i.is_commission_percent_active THEN {pct("total_amount", "i.commission_percent", "DECIMAL(9,6)")} END AS amount,
       row_number() OVER (PARTITION BY e.id ORDER BY CASE WHEN is_edge AND NOT is_insert THEN 0 ELSE 1 END, version) AS nth
FROM m_edges_all e {join} LEFT JOIN (SELECT * FROM m_influencers WHERE is_active) i ON {owner} = i.id
"""


VIEWS["m_affiliate_outcomes"] = _affiliate("r.influencer_id", "LEFT JOIN m_referrals r ON e.customer_id = r.referee_id")
VIEWS["m_owner_outcomes"] = _affiliate("e.influencer_id", "")

_LEDGER = """
SELECT booking_id, 'affiliate' AS scheme, owner AS beneficiary_id, total_amount AS base_amount, rate, type, amount,
       'accrued' AS reason_code, changed_at AS accrued_at, customer_id
FROM {source} WHERE is_edge AND NOT is_insert AND nth = 1 AND type IS NOT NULL {also}
"""
_NOT_YET = "AND booking_id NOT IN (SELECT booking_id FROM m_usage WHERE commission_status = 'completed')"
VIEWS["m_ledger"] = _LEDGER.format(source="m_affiliate_outcomes", also=_NOT_YET)
VIEWS["m_owner_ledger"] = _LEDGER.format(source="m_owner_outcomes", also=_NOT_YET)
VIEWS["m_accruals"] = _LEDGER.format(source="m_affiliate_outcomes", also="")

VIEWS["m_people"] = """
SELECT u.id, external_uid, phone,
       CASE WHEN first_name IS NOT NULL OR last_name IS NOT NULL THEN trim(concat_ws(' ', first_name, last_name)) END AS name
FROM m_users u LEFT JOIN m_profiles p ON u.id = p.user_id
"""

VIEWS["m_cards"] = """
SELECT p.*, rating, plate_number, model
FROM m_people p LEFT JOIN m_drivers d ON p.id = d.user_id
LEFT JOIN (SELECT driver_id, min(plate_number) AS plate_number, min_by(model, plate_number) AS model
           FROM m_vehicles WHERE is_primary GROUP BY driver_id) v ON d.id = v.driver_id
"""


# --- payloads ---------------------------------------------------------------------------


def _text(sql: str) -> str:
    return f"coalesce('\"' || {sql} || '\"', 'null')"


def _bare(sql: str) -> str:
    return f"coalesce(CAST({sql} AS VARCHAR), 'null')"


def _time(sql: str) -> str:
    return _text(f"strftime({sql}, '%Y-%m-%dT%H:%M:%S.%f')")


def _point(prefix: str) -> str:
    lat, long = f"b.{prefix}_latitude", f"b.{prefix}_longitude"
    return f"""coalesce('{{"latitude":' || {lat} || ',"longitude":' || {long} || '}}', 'null')"""


def payload(deposit_paid: str = "b.deposit_paid") -> str:
    fields = [
        ("id", _text("b.id")), ("bookingNumber", _text("b.booking_number")),
        ("customerId", _text("r.external_uid")), ("customerName", _text("r.name")), ("customerPhone", _text("r.phone")),
        ("driverId", _text("d.external_uid")), ("driverName", _text("d.name")), ("driverPhone", _text("d.phone")),
        ("driverVehiclePlate", _text("d.plate_number")), ("driverVehicleModel", _text("d.model")), ("driverRating", _bare("d.rating")),
        ("status", _text("b.status")), ("pickupAddress", _text("b.pickup_location")), ("destination", _text("b.destination")),
        ("startDate", _text("CAST(b.start_date AS VARCHAR)")), ("startTime", _text("b.start_time")),
        ("durationHours", _bare("b.duration_hours")), ("vehicleType", _text("b.vehicle_type")),
        ("specialRequirements", _text("b.special_requirements")), ("requiresForeignLanguage", _bare("b.requires_foreign_language")),
        ("passengerCount", _bare("b.passenger_count")), ("luggageCount", _bare("b.luggage_count")),
        ("basePrice", _bare("b.base_price")), ("foreignLanguageSurcharge", _bare("b.foreign_language_surcharge")),
        ("overtimeFee", _bare("b.overtime_fee")), ("tipAmount", _bare("b.tip_amount")), ("totalAmount", _bare("b.total_amount")),
        ("depositAmount", _bare("b.deposit_amount")), ("depositPaid", _bare(deposit_paid)),
        ("platformFee", _bare("b.platform_fee")), ("driverEarning", _bare("b.driver_earning")),
        ("tourPackageId", _text("b.tour_package_id")), ("tourPackageName", _text("b.tour_package_name")),
        ("promoCode", _text("b.promo_code")), ("influencerId", _text("b.influencer_id")),
        ("influencerCommission", _bare("b.influencer_commission")), ("originalPrice", _bare("b.original_price")),
        ("discountAmount", _bare("b.discount_amount")), ("finalPrice", _bare("b.final_price")), ("taxId", _text("b.tax_id")),
        ("country", _text("coalesce(b.country, 'TW')")), ("serviceType", _text("coalesce(b.service_type, 'charter')")),
        ("createdAt", _time("b.created_at")), ("updatedAt", _time("b.updated_at")),
        ("actualStartTime", _time("b.actual_start_time")), ("actualEndTime", _time("b.actual_end_time")),
        ("completedAt", _time("b.completed_at")), ("pickupLocation", _point("pickup")), ("dropoffLocation", _point("dropoff")),
    ]
    return "'{' || " + " || ',' || ".join(f"'\"{name}\":' || {sql}" for name, sql in fields) + " || '}'"


_EVENT = """
SELECT sha256('booking|' || b.id || '|' || {version}) AS id, 'booking' AS aggregate_type, b.id AS aggregate_id, {kind} AS event_type,
       {payload} AS payload, {at} AS created_at
FROM {source} b LEFT JOIN m_people r ON b.customer_id = r.id LEFT JOIN m_cards d ON b.driver_id = d.id
"""

VIEWS["m_events"] = _EVENT.format(
    version="b.version", kind="CASE WHEN b.version = 1 THEN 'created' ELSE 'updated' END", payload=payload(),
    at="b.changed_at", source="m_changes",
)

VIEWS["m_backfill"] = _EVENT.format(
    version="'backfill 2024-02-01T00:00:00.000000'", kind="'updated'", payload=payload("coalesce(b.deposit_paid, FALSE)"),
    at="TIMESTAMP '2024-02-01 00:00:00'", source="m_bookings",
)

VIEWS["m_latest_log"] = """
SELECT * FROM (SELECT * FROM m_events
               UNION ALL SELECT id, aggregate_type, aggregate_id, event_type, payload, created_at FROM m_outbox
               WHERE aggregate_type = 'booking' AND event_type = 'deleted')
QUALIFY row_number() OVER (PARTITION BY aggregate_id ORDER BY created_at DESC, id DESC) = 1
"""

_APP = "CASE {s} " + " ".join(
    f"WHEN '{a}' THEN '{b}'"
    for a, b in (
        ("pending_payment", "PENDING_PAYMENT"), ("paid_deposit", "pending"), ("assigned", "awaitingDriver"),
        ("matched", "awaitingDriver"), ("driver_confirmed", "matched"), ("driver_departed", "ON_THE_WAY"),
        ("driver_arrived", "ON_THE_WAY"), ("trip_started", "inProgress"), ("in_progress", "inProgress"),
        ("trip_ended", "awaitingBalance"), ("pending_balance", "awaitingBalance"), ("completed", "completed"),
        ("cancelled", "cancelled"),
    )
) + " ELSE 'pending' END"


def app_status(column: str) -> str:
    return _APP.format(s=column)


# the document of a booking's last change, from the booking itself rather than from a payload
VIEWS["m_documents_now"] = f"""
SELECT b.id, r.external_uid AS customerId, d.external_uid AS driverId, r.name AS customerName, r.phone AS customerPhone,
       d.name AS driverName, d.phone AS driverPhone, d.plate_number AS driverVehiclePlate, d.model AS driverVehicleModel,
       nullif(d.rating, 0) AS driverRating, coalesce(b.pickup_location, '') AS pickupAddress, coalesce(b.destination, '') AS dropoffAddress,
       CASE WHEN b.start_time IS NOT NULL THEN CAST(b.start_date || ' ' || b.start_time AS TIMESTAMP) ELSE b.created_at END AS bookingTime,
       CASE WHEN b.passenger_count = 0 THEN 1 ELSE b.passenger_count END AS passengerCount, nullif(b.luggage_count, 0) AS luggageCount,
       nullif(b.special_requirements, '') AS notes, b.tour_package_id AS tourPackageId, b.tour_package_name AS tourPackageName,
       b.promo_code AS promoCode, b.influencer_id AS influencerId, CAST(coalesce(b.influencer_commission, 0) AS DECIMAL(10,2)) AS influencerCommission,
       nullif(b.original_price, 0) AS originalPrice, CAST(coalesce(b.discount_amount, 0) AS DECIMAL(10,2)) AS discountAmount,
       nullif(b.final_price, 0) AS finalPrice, b.tax_id AS taxId, coalesce(b.country, 'TW') AS country,
       coalesce(b.service_type, 'charter') AS serviceType, CAST(coalesce(b.total_amount, 0) AS DECIMAL(10,2)) AS estimatedFare,
       CAST(coalesce(b.deposit_amount, 0) AS DECIMAL(10,2)) AS depositAmount, CAST(coalesce(b.overtime_fee, 0) AS DECIMAL(10,2)) AS overtimeFee,
       CAST(coalesce(b.tip_amount, 0) AS DECIMAL(10,2)) AS tipAmount, CAST(coalesce(b.platform_fee, 0) AS DECIMAL(10,2)) AS platformFee,
       CAST(coalesce(b.driver_earning, 0) AS DECIMAL(10,2)) AS driverEarning, coalesce(b.deposit_paid, FALSE) AS depositPaid,
       {app_status("b.status")} AS status, b.created_at AS createdAt, b.actual_start_time AS matchedAt,
       b.actual_end_time AS completedAt, b.changed_at AS event_at,
       CASE WHEN b.pickup_longitude IS NOT NULL THEN b.pickup_latitude END AS pickup_latitude,
       CASE WHEN b.pickup_latitude IS NOT NULL THEN b.pickup_longitude END AS pickup_longitude, b.dropoff_latitude, b.dropoff_longitude
FROM (SELECT * FROM m_changes QUALIFY row_number() OVER (PARTITION BY id ORDER BY version DESC) = 1) b
LEFT JOIN m_people r ON b.customer_id = r.id LEFT JOIN m_cards d ON b.driver_id = d.id
"""

PAID_STATUSES = ", ".join(f"'{s}'" for s in DEPOSIT_PAID_STATUSES)

_NAME = re.compile(r"\bm_[a-z_]+\b")


def with_views(statement: str) -> str:
    """The statement with the views it needs in front, and the ones those need."""
    needed: set[str] = set()
    todo = set(_NAME.findall(statement))
    while todo:
        name = todo.pop()
        if name in VIEWS and name not in needed:
            needed.add(name)
            todo |= set(_NAME.findall(VIEWS[name]))
    if not needed:
        return statement.strip()
    parts = ",\n".join(f"{name} AS ({VIEWS[name].strip()})" for name in VIEWS if name in needed)
    return f"WITH {parts}\n{statement.strip()}"
