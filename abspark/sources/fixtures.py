"""Domain inputs derived from the driver's star-schema tables.

The driver ships TPC-H-like tables and an ``events`` click stream, but no
experiment data.  Every experiment source of the pipeline is derived here by
arithmetic on those tables, so that the work grows with them.

The derivation is written ONCE, as shared-dialect SQL that runs unchanged in
Spark SQL and in DuckDB.  Spark runs it through ``spark.sql(text, **frames)``
(each ``{name}`` placeholder binds a DataFrame); the DuckDB oracle runs the
same text as CTEs.  Both engines therefore start from identical flat rows.
:mod:`abspark.sources.tables` then nests the flat rows into the source
schemas of :mod:`abspark.sources.schemas` (arrays of structs, as in the
warehouse), which is what the pipeline reads.

Dialect rules that keep both engines equal: integer division is
``CAST(FLOOR(a/b) AS BIGINT)``; fractional literals are cast to DOUBLE (Spark
reads ``0.5`` as DECIMAL); money is an integer amount scaled by 1/100, 1/10
or 1/4 so every sum is an exact cent value; ``ABS`` removes the ``-0.0`` of
the source discounts.
"""

from __future__ import annotations

# Fixed values of the fixture (not taken from anywhere; chosen so that every
# branch of the pipeline is reached):
#   entity ids FP_E0, FP_E1, TB_E2, HS_E3, DN_E4 with countries c0..c4 and
#   regions Europe, Asia, MENA, Americas, MENA (DN_E4 is removed by the
#   entity exclusion list, Europe/Asia take the platform-fee branch);
#   tests k = 0..6 per entity, test_id = 10*e + k, k = 0 and 1 valid,
#   k = 2 active, 3 misconfigured, 4 shorter than 7 days, 5 with a schedule,
#   6 with a customer condition; priority 1 / 2 -> vendor_group_id 101 / 102;
#   variants Control, Variation1, Variation2 -> price_scheme_id
#   10*priority + variant index (123 in place of 12 for entity 3, test 0);
#   zones 10*e + 0..3 are the test zones, zone 10*e + 4 is inactive, the
#   second city of each entity is inactive.
# Setup rows that share a key (entity, test, priority, variant) with another
# row: a second vendor group with its own vendors (entity 0), a scheduled twin
# (entity 0), a twin without vendors (entity 1), a NULL vendor group (entity
# 2); a test k = 7 whose rows all lack vendors (entity 1).
# One more valid test and one more zone per supplier: the setups grow with
# the data.
START_FLOOR = "1995-01-01"

F_ENTITIES = """
SELECT * FROM (VALUES
  (0, 'FP_E0', 'c0', 'Europe', 'Country 0'),
  (1, 'FP_E1', 'c1', 'Asia', 'Country 1'),
  (2, 'TB_E2', 'c2', 'MENA', 'Country 2'),
  (3, 'HS_E3', 'c3', 'Americas', 'Country 3'),
  (4, 'DN_E4', 'c4', 'MENA', 'Country 4')
) AS t(e, entity_id, country_code, region, country_name)
"""

F_VENDORS = """
SELECT CAST(s.s_suppkey AS STRING) AS vendor_id,
       s.s_suppkey AS vendor_key,
       CAST(s.s_suppkey % 5 AS INT) AS e,
       en.entity_id AS global_entity_id,
       (CAST(FLOOR(s.s_suppkey / 5) AS BIGINT) + s.s_suppkey % 5) % 4 AS grp,
       CASE CAST(FLOOR(s.s_suppkey / 20) AS BIGINT) % 3
         WHEN 0 THEN 'restaurants' WHEN 1 THEN 'groceries' ELSE 'darkstores' END AS vertical_type
FROM {supplier} s
JOIN {f_entities} en ON en.e = CAST(s.s_suppkey % 5 AS INT)
"""

# One row per setup row.  vendor_list_id and zone_list_id name its vendor and
# zone lists.
F_SETUPS = """
SELECT e, entity_id, country_code, test_id, k, vendor_list_id, zone_list_id, test_name,
       CAST(CAST('1995-01-01' AS DATE) + (3 * e + k) AS TIMESTAMP) AS test_start_date,
       CAST(CAST('1995-01-01' AS DATE) + (3 * e + k + days) AS TIMESTAMP) AS test_end_date,
       k = 2 AS is_active, k = 3 AS misconfigured,
       CASE WHEN k = 5 OR scheduled = 1 THEN CAST(1 AS BIGINT) ELSE CAST(NULL AS BIGINT) END AS schedule_id,
       CASE WHEN k = 6 THEN CAST(1 AS BIGINT) ELSE CAST(NULL AS BIGINT) END AS customer_condition_id,
       CAST(vendor_group_id AS BIGINT) AS vendor_group_id, CAST(priority AS BIGINT) AS priority, variation_group,
       CAST(price_scheme_id AS BIGINT) AS price_scheme_id
FROM (
  SELECT en.e, en.entity_id, en.country_code, CAST(en.e * 10 + t.k AS BIGINT) AS test_id, t.k,
         CAST(10 * t.priority + CASE WHEN t.k = 1 THEN 1 ELSE 0 END AS BIGINT) AS vendor_list_id,
         CAST(0 AS BIGINT) AS zone_list_id, CONCAT(en.entity_id, '_test_', CAST(t.k AS STRING)) AS test_name,
         t.len0 + t.len_step * en.e AS days, 0 AS scheduled, 100 + t.priority AS vendor_group_id, t.priority,
         t.variation_group,
         CASE WHEN en.e = 3 AND t.k = 0 AND t.priority = 1 AND t.vi = 2 THEN 123
              ELSE 10 * t.priority + t.vi END AS price_scheme_id
  FROM {f_entities} en
  JOIN (SELECT * FROM (VALUES (0, 7, 14), (1, 70, 4), (2, 30, 0), (3, 30, 0), (4, 6, 0), (5, 30, 0), (6, 30, 0)) AS k(k, len0, len_step)
        CROSS JOIN (VALUES (1), (2)) AS p(priority)
        CROSS JOIN (VALUES (0, 'Control'), (1, 'Variation1'), (2, 'Variation2')) AS v(vi, variation_group)) t ON en.e >= 0
  UNION ALL
  SELECT en.e, en.entity_id, en.country_code, CAST(en.e * 10 + x.k AS BIGINT), x.k, CAST(x.vendor_list_id AS BIGINT),
         CAST(x.zone_list_id AS BIGINT), CONCAT(en.entity_id, '_test_', CAST(x.k AS STRING)), x.days, x.scheduled,
         x.vendor_group_id, x.priority, x.variation_group, x.price_scheme_id
  FROM (VALUES (0, 0, 30, 0, 7, 0, 103, 1, 'Control', 13),
               (0, 0, 31, 0, 7, 1, 104, 1, 'Control', 97),
               (1, 0, 99, 1, 21, 0, 101, 1, 'Control', 99),
               (2, 1, 30, 0, 78, 0, CAST(NULL AS INT), 3, 'Variation1', 31),
               (1, 7, 99, 1, 30, 0, 101, 1, 'Control', 10))
       AS x(e, k, vendor_list_id, zone_list_id, days, scheduled, vendor_group_id, priority, variation_group, price_scheme_id)
  JOIN {f_entities} en ON en.e = x.e
  UNION ALL
  SELECT en.e, en.entity_id, en.country_code, CAST(1000 + s.s_suppkey AS BIGINT), 10, CAST(1000 + s.s_suppkey AS BIGINT),
         CAST(1000 + s.s_suppkey AS BIGINT), CONCAT(en.entity_id, '_test_s', CAST(s.s_suppkey AS STRING)), 14, 0, 101, 1,
         v.variation_group, 10 + v.vi
  FROM {supplier} s JOIN {f_entities} en ON en.e = CAST(s.s_suppkey % 5 AS INT)
  JOIN (VALUES (0, 'Control'), (1, 'Variation1')) AS v(vi, variation_group) ON v.vi >= 0
) r
"""

# Vendors of a vendor list: grp 0 and 2 -> priority 1, grp 1 and 2 ->
# priority 2 (grp 2 overlaps, grp 3 is outside every group: Non_TG).  The
# lists of test k = 1 leave out the darkstores vendors, so that the
# vertical-type filter removes orders.  Lists 30 and 31 split grp 3; list 99
# is empty; the supplier tests list their supplier.
F_SETUP_VENDORS = """
SELECT v.e, CAST(l.list_id AS BIGINT) AS list_id, v.vendor_id
FROM {f_vendors} v
JOIN (VALUES (10, 0, 1, 1), (10, 2, 1, 1), (11, 0, 1, 0), (11, 2, 1, 0), (20, 1, 1, 1), (20, 2, 1, 1), (21, 1, 1, 0),
             (21, 2, 1, 0), (30, 3, 1, 0), (31, 3, 0, 1)) AS l(list_id, grp, others, dark)
  ON v.grp = l.grp AND ((v.vertical_type = 'darkstores' AND l.dark = 1) OR (v.vertical_type <> 'darkstores' AND l.others = 1))
UNION ALL
SELECT e, CAST(1000 + vendor_key AS BIGINT) AS list_id, vendor_id FROM {f_vendors}
"""

# Parent verticals per test: one for k <> 1, two for k = 1, none for
# entity 3 / k = 1 (that test is then not valid).
F_SETUP_PARENTS = """
SELECT e, test_id, parent_vertical FROM (
  SELECT DISTINCT e, test_id,
         CASE WHEN k = 1 AND e = 3 THEN NULL
              WHEN k = 1 AND e = 2 THEN 'darkstores'
              WHEN k = 1 THEN 'shop'
              WHEN e % 3 = 0 THEN 'Restaurant'
              WHEN e % 3 = 1 THEN 'restaurants'
              ELSE 'restaurant' END AS parent_vertical
  FROM {f_setups}
  UNION ALL
  SELECT DISTINCT e, test_id,
         CASE WHEN k = 1 AND e = 2 THEN 'Shop'
              WHEN k = 1 AND e <> 3 THEN 'Restaurant'
              ELSE NULL END AS parent_vertical
  FROM {f_setups}
) t WHERE parent_vertical IS NOT NULL
"""

F_SETUP_ZONES = """
SELECT en.e, CAST(z.list_id AS BIGINT) AS list_id, CAST(en.e * 10 + z.z AS BIGINT) AS zone_id
FROM {f_entities} en JOIN (VALUES (0, 0), (0, 1), (0, 2), (0, 3), (1, 4), (1, 5)) AS z(list_id, z) ON en.e >= 0
UNION ALL
SELECT e, CAST(1000 + vendor_key AS BIGINT), CAST(100000 + vendor_key AS BIGINT) FROM {f_vendors}
"""

# Zones.  City 100e+1 is active and holds the four test zones plus an
# inactive zone 10e+4 (zone 13 of entity 1 is inactive too) and the supplier
# zones; city 100e+2 is inactive and holds a second copy of zone 10e+1 that
# covers everything.
F_ZONES = """
SELECT en.e, en.entity_id, en.country_code, CAST(en.e * 100 + z.city AS BIGINT) AS city_id,
       CONCAT('city_', CAST(en.e AS STRING), CASE WHEN z.city = 1 THEN '_a' ELSE '_b' END) AS city_name,
       z.city = 1 AS city_active, CAST(en.e * 10 + z.z AS BIGINT) AS zone_id,
       CONCAT('zone_', CAST(en.e * 10 + z.z AS STRING), CASE WHEN z.city = 1 THEN '' ELSE '_old' END) AS zone_name,
       NOT (z.z = 4 OR (en.e = 1 AND z.z = 3 AND z.city = 1)) AS zone_active,
       z.shape, CAST(10 * en.e + 2 * z.z AS DOUBLE) AS x0
FROM {f_entities} en
JOIN (VALUES (1, 0, 0), (1, 1, 1), (1, 2, 2), (1, 3, 3), (1, 4, 4), (2, 1, 5)) AS z(city, z, shape) ON en.e >= 0
UNION ALL
SELECT en.e, en.entity_id, en.country_code, CAST(en.e * 100 + 1 AS BIGINT), CONCAT('city_', CAST(en.e AS STRING), '_a'),
       TRUE, CAST(100000 + v.vendor_key AS BIGINT), CONCAT('zone_s', v.vendor_id), TRUE, 4,
       CAST(1000000 + 2 * v.vendor_key AS DOUBLE)
FROM {f_vendors} v JOIN {f_entities} en ON en.e = v.e
"""

# Ring points of the zones, relative to x0: 0 a square, 1 a square with a
# hole, 2 a concave shape, 3 two polygons, 4 a triangle, 5 a box over all.
F_ZONE_POINTS = """
SELECT z.entity_id, z.country_code, z.city_id, z.zone_id, p.ring, p.pt,
       z.x0 + CAST(p.dx AS DOUBLE) AS x, CAST(p.dy AS DOUBLE) AS y
FROM {f_zones} z
JOIN (VALUES
  (0, 0, 0, 0.0, 0.0), (0, 0, 1, 1.0, 0.0), (0, 0, 2, 1.0, 1.0), (0, 0, 3, 0.0, 1.0),
  (1, 0, 0, 0.0, 0.0), (1, 0, 1, 1.0, 0.0), (1, 0, 2, 1.0, 1.0), (1, 0, 3, 0.0, 1.0),
  (1, 1, 0, 0.31, 0.26), (1, 1, 1, 0.77, 0.26), (1, 1, 2, 0.77, 0.69), (1, 1, 3, 0.31, 0.69),
  (2, 0, 0, 0.0, 0.0), (2, 0, 1, 1.0, 0.0), (2, 0, 2, 1.0, 1.0), (2, 0, 3, 0.52, 0.33), (2, 0, 4, 0.0, 1.0),
  (3, 0, 0, 0.0, 0.0), (3, 0, 1, 0.44, 0.0), (3, 0, 2, 0.44, 1.0), (3, 0, 3, 0.0, 1.0),
  (3, 1, 0, 0.61, 0.0), (3, 1, 1, 1.0, 0.0), (3, 1, 2, 1.0, 1.0), (3, 1, 3, 0.61, 1.0),
  (4, 0, 0, 0.0, 0.0), (4, 0, 1, 1.0, 0.0), (4, 0, 2, 0.5, 1.0),
  (5, 0, 0, -2000.0, -2000.0), (5, 0, 1, 2000.0, -2000.0), (5, 0, 2, 2000.0, 2000.0), (5, 0, 3, -2000.0, 2000.0)
) AS p(shape, ring, pt, dx, dy) ON p.shape = z.shape
"""

# One row per lineitem: the order fact of the sessions-to-orders table.
F_ORDERS = """
SELECT t.*,
       CONCAT('PO', CAST(t.order_id AS STRING)) AS platform_order_code,
       CONCAT('u', CAST(t.client_id AS STRING)) AS perseus_client_id,
       CONCAT('u', CAST(t.client_id AS STRING), '-', CAST(t.created_date AS STRING)) AS ga_session_id,
       CONCAT('zone_', CAST(t.zone_id AS STRING)) AS zone_name,
       CASE WHEN t.order_id % 3 = 0 THEN CAST(NULL AS DOUBLE) ELSE CAST(t.order_id % 4 AS DOUBLE) END AS mov_customer_fee_local,
       CAST(t.order_id % 7 AS DOUBLE) AS pd_delivery_fee_local,
       t.order_id % 10 <> 0 AS in_pd_orders
FROM (
SELECT l.l_orderkey * 8 + l.l_linenumber AS order_id,
       CAST(l.l_suppkey AS STRING) AS vendor_id,
       CAST(l.l_suppkey % 5 AS INT) AS e,
       en.entity_id, en.country_code, en.region,
       o.o_custkey AS client_id,
       CAST(l.l_suppkey % 5 AS BIGINT) * 10 + o.o_custkey % 2 AS test_id,
       CASE CAST(FLOOR(o.o_custkey / 2) AS BIGINT) % 3
         WHEN 0 THEN 'Control' WHEN 1 THEN 'Variation1' ELSE 'Variation2' END AS variant,
       CASE WHEN l.l_linenumber = 7 THEN CAST(999 AS BIGINT)
            ELSE (CASE WHEN (CAST(FLOOR(l.l_suppkey / 5) AS BIGINT) + l.l_suppkey % 5) % 4 = 1 THEN 2 ELSE 1 END) * 10
                 + CAST(FLOOR(o.o_custkey / 2) AS BIGINT) % 3 END AS scheme_id,
       CAST(l.l_suppkey % 5 AS BIGINT) * 10 + o.o_custkey % 4 AS zone_id,
       CAST(l.l_suppkey % 5 AS BIGINT) * 100 + 1 AS city_id,
       CONCAT('city_', CAST(l.l_suppkey % 5 AS STRING), '_a') AS city_name,
       CAST(10 * (l.l_suppkey % 5) + 2 * (o.o_custkey % 4) AS DOUBLE)
         + (CAST(l.l_orderkey % 97 AS DOUBLE) + CAST(0.5 AS DOUBLE)) / 90 AS lon,
       (CAST((l.l_orderkey * 7 + l.l_linenumber * 13) % 89 AS DOUBLE) + CAST(0.5 AS DOUBLE)) / 80 AS lat,
       CASE WHEN o.o_orderstatus = 'P' THEN 'cancelled' ELSE 'completed' END AS delivery_status,
       CAST(o.o_orderdate AS DATE) AS created_date,
       o.o_orderdate AS order_placed_at,
       FLOOR(l.l_extendedprice) / CAST(100 AS DOUBLE) AS gfv_local,
       FLOOR(ABS(l.l_discount) * 1000) / CAST(10 AS DOUBLE) AS delivery_fee_local,
       FLOOR(l.l_extendedprice * ABS(l.l_tax)) / CAST(100 AS DOUBLE) AS commission_local,
       FLOOR(l.l_quantity) / CAST(4 AS DOUBLE) AS delivery_costs_local,
       CASE WHEN l.l_linenumber = 3 THEN CAST(0.25 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS joker_vendor_fee_local,
       CASE WHEN l.l_linenumber = 2 THEN CAST(NULL AS DOUBLE) ELSE CAST(0.5 AS DOUBLE) END AS service_fee,
       CAST(l.l_partkey % 5 AS DOUBLE) * 100 AS dps_minimum_order_value_local,
       CASE l.l_partkey % 7 WHEN 0 THEN TRUE WHEN 1 THEN CAST(NULL AS BOOLEAN) ELSE FALSE END AS is_delivery_fee_covered_by_discount,
       CASE l.l_partkey % 11 WHEN 0 THEN TRUE WHEN 1 THEN CAST(NULL AS BOOLEAN) ELSE FALSE END AS is_delivery_fee_covered_by_voucher,
       l.l_linenumber % 2 = 0 AS is_own_delivery,
       CAST(0.25 AS DOUBLE) AS exchange_rate,
       CASE WHEN o.o_custkey % 3 = 0 THEN 'New' ELSE 'Existing' END AS dps_customer_tag,
       'Automatic' AS vendor_price_scheme_type,
       CONCAT('ch', CAST(l.l_suppkey % 3 AS STRING)) AS chain_id,
       CONCAT('Chain ', CAST(l.l_suppkey % 3 AS STRING)) AS chain_name,
       CASE CAST(FLOOR(l.l_suppkey / 20) AS BIGINT) % 3
         WHEN 0 THEN 'restaurants' WHEN 1 THEN 'groceries' ELSE 'darkstores' END AS vertical_type,
       CASE WHEN l.l_partkey % 10 = 0 THEN NULL
            WHEN l.l_partkey % 10 = 1 THEN 'Other'
            WHEN CAST(FLOOR(l.l_suppkey / 20) AS BIGINT) % 3 = 0 THEN
              (CASE WHEN l.l_partkey % 2 = 0 THEN 'Restaurant' ELSE 'restaurants' END)
            WHEN CAST(FLOOR(l.l_suppkey / 20) AS BIGINT) % 3 = 1 THEN 'Shop'
            ELSE 'darkstores' END AS vendor_vertical_parent
FROM {lineitem} l
JOIN {orders} o ON l.l_orderkey = o.o_orderkey
JOIN {f_entities} en ON en.e = CAST(l.l_suppkey % 5 AS INT)
) t
"""

# One row per click-stream event; a GA session is one user on one day.
F_SESSION_EVENTS = """
SELECT t.*,
       CASE WHEN t.vendor_key IS NULL OR t.event_id % 13 = 0 THEN NULL
            WHEN CAST(FLOOR(t.vendor_key / 20) AS BIGINT) % 3 = 0 THEN 'restaurants'
            WHEN CAST(FLOOR(t.vendor_key / 20) AS BIGINT) % 3 = 1 THEN 'groceries'
            ELSE 'darkstores' END AS vertical_type,
       CAST(t.vendor_key AS STRING) AS vendor_code
FROM (
SELECT ev.event_id,
       ev.ts AS event_time,
       CAST(ev.ts AS DATE) AS created_date,
       ev.user_id AS client_id,
       CONCAT('u', CAST(ev.user_id AS STRING)) AS perseus_client_id,
       CAST((ev.user_id + EXTRACT(DAY FROM ev.ts)) % 5 AS INT) AS e,
       en.entity_id, en.country_code,
       CAST((ev.user_id + EXTRACT(DAY FROM ev.ts)) % 5 AS BIGINT) * 10 + ev.user_id % 2 AS test_id,
       CASE (CAST(FLOOR(ev.user_id / 2) AS BIGINT)
             + CASE WHEN ev.user_id % 50 = 0 AND EXTRACT(DAY FROM ev.ts) % 2 = 1 THEN 1 ELSE 0 END) % 3
         WHEN 0 THEN 'Control' WHEN 1 THEN 'Variation1' ELSE 'Variation2' END AS variant,
       CONCAT('u', CAST(ev.user_id AS STRING), '-', CAST(CAST(ev.ts AS DATE) AS STRING)) AS ga_session_id,
       CAST(EXTRACT(DAY FROM ev.ts) AS BIGINT) AS day_of_month,
       CASE ev.event_type WHEN 'signup' THEN 'home_screen.loaded' WHEN 'view' THEN 'shop_list.loaded'
            WHEN 'click' THEN 'shop_details.loaded' WHEN 'error' THEN 'checkout.loaded'
            ELSE 'transaction' END AS event_action,
       CASE WHEN ev.event_type IN ('signup', 'view') THEN CAST(NULL AS BIGINT)
            ELSE CAST((ev.user_id + EXTRACT(DAY FROM ev.ts)) % 5 AS BIGINT)
                 + 5 * (ev.event_id % (SELECT CAST(FLOOR(COUNT(*) / 5) AS BIGINT) FROM {supplier})) END AS vendor_key,
       CASE WHEN ev.event_type = 'purchase' THEN CONCAT('PO', CAST(ev.event_id AS STRING)) ELSE NULL END AS transaction_id,
       CASE WHEN ev.event_id % 5 = 0 THEN 'pickup' ELSE 'delivery' END AS expedition_type
FROM {events} ev
JOIN {f_entities} en ON en.e = CAST((ev.user_id + EXTRACT(DAY FROM ev.ts)) % 5 AS INT)
) t
"""

# One row per GA session with its session-level attributes.
F_SESSIONS = """
SELECT ga_session_id AS events_ga_session_id,
       created_date, entity_id, country_code, e, client_id, perseus_client_id, test_id, variant, day_of_month,
       CASE client_id % 3 WHEN 0 THEN 'iOS' WHEN 1 THEN 'Android' ELSE 'Web' END AS platform,
       CONCAT('brand_', CAST(e AS STRING)) AS brand,
       CONCAT('fv', CAST(client_id AS STRING)) AS fullvisitor_id,
       CAST(day_of_month AS STRING) AS visit_id,
       MAX(transaction_id IS NOT NULL) AS has_transaction,
       COUNT(transaction_id) AS total_transactions,
       CONCAT('dps-', ga_session_id) AS ga_dps_session_id,
       CAST(10 * e AS DOUBLE) + CAST(0.5 AS DOUBLE) AS ga_longitude,
       CAST(0.5 AS DOUBLE) AS ga_latitude,
       MIN(event_time) AS dps_session_timestamp,
       'multiple_fee' AS endpoint,
       CASE client_id % 4 WHEN 0 THEN 'Restaurant' WHEN 1 THEN 'restaurants' WHEN 2 THEN 'Shop' ELSE NULL END AS vertical_parent,
       CASE WHEN client_id % 2 = 0 THEN 'new' ELSE 'existing' END AS customer_status,
       CONCAT('loc', CAST(client_id % 7 AS STRING)) AS location
FROM {f_session_events}
GROUP BY ga_session_id, created_date, entity_id, country_code, e, client_id, perseus_client_id, test_id, variant, day_of_month
"""

# Delivery zones seen in a session: two per session, none when client_id % 7 = 0.
F_SESSION_ZONES = """
SELECT events_ga_session_id, slot, zone_id,
       CONCAT('zone_', CAST(zone_id AS STRING)) AS zone_name,
       CAST(e * 100 + 1 AS BIGINT) AS city_id,
       CONCAT('city_', CAST(e AS STRING), '_a') AS city_name,
       'UTC' AS timezone
FROM (
  SELECT events_ga_session_id, e, client_id, 0 AS slot, CAST(e * 10 + client_id % 4 AS BIGINT) AS zone_id FROM {f_sessions}
  UNION ALL
  SELECT events_ga_session_id, e, client_id, 1 AS slot, CAST(e * 10 + (client_id + day_of_month) % 6 AS BIGINT) AS zone_id FROM {f_sessions}
) z
WHERE client_id % 7 <> 0
"""

# Zones on the globe, where great-circle edges and straight lines in longitude
# and latitude differ: 0 a box in high latitudes, 1 a concave zone across the
# 180th meridian, 2 around the north pole, 3 around the south pole with a hole,
# 4 a long triangle, 5 two polygons.  Every entity has all of them.
F_GLOBE_POINTS = """
SELECT en.entity_id, en.country_code, CAST(200000 + p.shape AS BIGINT) AS zone_id, p.ring, p.pt,
       CAST(p.lon AS DOUBLE) AS x, CAST(p.lat AS DOUBLE) AS y
FROM {f_entities} en
JOIN (VALUES
  (0, 0, 0, 0, 55), (0, 0, 1, 60, 55), (0, 0, 2, 60, 70), (0, 0, 3, 0, 70),
  (1, 0, 0, 170, -10), (1, 0, 1, -170, -10), (1, 0, 2, -170, 20), (1, 0, 3, 179, 2), (1, 0, 4, 170, 20),
  (2, 0, 0, 10, 75), (2, 0, 1, 100, 75), (2, 0, 2, -170, 75), (2, 0, 3, -80, 75),
  (3, 0, 0, 5, -60), (3, 0, 1, -55, -60), (3, 0, 2, -115, -60), (3, 0, 3, -175, -60), (3, 0, 4, 125, -60), (3, 0, 5, 65, -60),
  (3, 1, 0, 0, -80), (3, 1, 1, 90, -80), (3, 1, 2, 180, -80), (3, 1, 3, -90, -80),
  (4, 0, 0, 100, 0), (4, 0, 1, 140, 5), (4, 0, 2, 120, 85),
  (5, 0, 0, -30, 40), (5, 0, 1, -10, 40), (5, 0, 2, -10, 50), (5, 0, 3, -30, 50),
  (5, 1, 0, 0, 40), (5, 1, 1, 20, 40), (5, 1, 2, 20, 50), (5, 1, 3, 0, 50)
) AS p(shape, ring, pt, lon, lat) ON en.e >= 0
"""

# Every order with a point on the globe, spread over a box around one of those zones.
F_GLOBE_ORDERS = """
SELECT DISTINCT entity_id, country_code, zone_id, order_id, platform_order_code,
       CASE WHEN lon > 180 THEN lon - 360 ELSE lon END AS lon, lat
FROM (
  SELECT o.entity_id, o.country_code, CAST(200000 + b.shape AS BIGINT) AS zone_id, o.order_id, o.platform_order_code,
         CAST(b.lon0 AS DOUBLE) + CAST(b.width AS DOUBLE) * (CAST(o.order_id % 97 AS DOUBLE) + CAST(0.5 AS DOUBLE)) / 97 AS lon,
         CAST(b.lat0 AS DOUBLE) + CAST(b.height AS DOUBLE) * (CAST(o.order_id * 7 % 89 AS DOUBLE) + CAST(0.5 AS DOUBLE)) / 89 AS lat
  FROM {f_orders} o
  JOIN (VALUES (0, -5, 70, 50, 28), (1, 165, 30, -15, 40), (2, -180, 360, 65, 25), (3, -180, 360, -90, 40),
               (4, 95, 50, -5, 95), (5, -35, 60, 35, 20)) AS b(shape, lon0, width, lat0, height)
    ON b.shape = CAST(FLOOR(o.order_id / 8) AS BIGINT) % 6
) t
"""

# Small tests for the exact rank distribution: each customer is a test, its
# orders are the users, dealt to Control and two variants; totals in cents hardly
# ever tie, and most samples have at most eight values.
F_SMALL_TESTS = """
SELECT CONCAT('N', CAST(o_custkey % 25 AS STRING)) AS entity_id, CAST(o_custkey AS BIGINT) AS test_id,
       CASE o_orderkey % 3 WHEN 0 THEN 'Control' WHEN 1 THEN 'Variation1' ELSE 'Variation2' END AS variant,
       FLOOR(o_totalprice * 100) / CAST(100 AS DOUBLE) AS profit_per_user
FROM {orders}
"""

# Flat views in dependency order: (name, sql, placeholders).
FLAT_VIEWS: list[tuple[str, str]] = [
    ("f_entities", F_ENTITIES),
    ("f_vendors", F_VENDORS),
    ("f_setups", F_SETUPS),
    ("f_setup_vendors", F_SETUP_VENDORS),
    ("f_setup_parents", F_SETUP_PARENTS),
    ("f_setup_zones", F_SETUP_ZONES),
    ("f_zones", F_ZONES),
    ("f_zone_points", F_ZONE_POINTS),
    ("f_orders", F_ORDERS),
    ("f_session_events", F_SESSION_EVENTS),
    ("f_sessions", F_SESSIONS),
    ("f_session_zones", F_SESSION_ZONES),
    ("f_globe_points", F_GLOBE_POINTS),
    ("f_globe_orders", F_GLOBE_ORDERS),
    ("f_small_tests", F_SMALL_TESTS),
]

BASE_TABLES = ("supplier", "lineitem", "orders", "events")

# The joins under F_ORDERS.  Spark keeps the joined lines, of the columns that the
# view names, instead of the view's own wide rows.
ORDER_LINES = """FROM {lineitem} l
JOIN {orders} o ON l.l_orderkey = o.o_orderkey
JOIN {f_entities} en ON en.e = CAST(l.l_suppkey % 5 AS INT)"""


def duckdb_ctes() -> list[tuple[str, str]]:
    """The flat views as (name, sql) pairs for a DuckDB WITH clause."""
    names = {n: n for n in BASE_TABLES}
    names.update({n: n for n, _ in FLAT_VIEWS})
    return [(n, sql.format(**names)) for n, sql in FLAT_VIEWS]
