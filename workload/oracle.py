"""The registered queries as SQL over the given tables, for an independent engine."""

from __future__ import annotations

from workload.queries import (
    CUSTOMER, DAY, DRAWN_CUSTOMERS, LOST_FROM, MEDIA_BYTES, NEW_FORM_FROM, PUBLISHED_ROWS, SAMPLE_ROWS, SERVICE,
    SHORTENED, STORE_FILES, TOP_K,
)

KEY = "l_orderkey, l_linenumber, l_partkey, l_suppkey"

# Line items with the columns of a trip.
ITEMS = """
items AS (
  SELECT *, l_partkey AS id_customer,
    CASE WHEN l_returnflag = 'R' THEN 'green' ELSE 'yellow' END AS service,
    l_shipdate + ((l_orderkey * 37 + l_linenumber * 61) % 1440) * INTERVAL 1 MINUTE AS pickup_datetime,
    CAST(NULLIF(l_suppkey % 30, 29) AS INTEGER) AS pulocationid,
    CAST(l_partkey % 30 AS INTEGER) AS dolocationid,
    l_quantity AS passenger_count, l_quantity / 2 AS trip_distance,
    floor(l_extendedprice) AS fare_amount, CAST(l_linenumber AS DOUBLE) * 0.5 AS extra,
    CAST(0.5 AS DOUBLE) AS mta_tax,
    floor(l_extendedprice * l_discount * 4) / 4 AS tip_amount,
    floor(l_extendedprice * l_tax * 4) / 4 AS tolls_amount,
    CAST(1 AS DOUBLE) AS improvement_surcharge,
    CAST(l_suppkey % 2 AS DOUBLE) * 2.5 AS congestion_surcharge,
    CAST(1 + l_suppkey % 2 AS INTEGER) AS vendorid,
    CAST(1 + l_linenumber % 6 AS DOUBLE) AS ratecodeid,
    CASE WHEN l_orderkey % 50 <> 0 THEN CAST(1 + l_linenumber % 5 AS DOUBLE) END AS payment_type,
    CASE WHEN l_linestatus = 'F' THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
    CASE WHEN l_orderkey % 40 <> 0 THEN CAST(1 + l_linenumber % 2 AS DOUBLE) END AS trip_type,
    CASE WHEN l_partkey % 70 <> 0 THEN CAST(1.25 AS DOUBLE) END AS fee,
    concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS id,
    1 + CAST(l_orderkey % 9 AS DOUBLE) * 0.5 AS rate
  FROM lineitem),
trips AS (
  SELECT *, CAST(dropoff_datetime AS DATE) AS trip_day, CAST(pickup_datetime AS DATE) AS pickup_date,
    dayname(pickup_datetime) AS pickup_day,
    CASE WHEN hour(pickup_datetime) BETWEEN 5 AND 11 THEN 'Sáng'
         WHEN hour(pickup_datetime) BETWEEN 12 AND 17 THEN 'Chiều'
         WHEN hour(pickup_datetime) BETWEEN 18 AND 22 THEN 'Tối' ELSE 'Đêm' END AS pickup_time_of_day
  FROM (SELECT *,
          pickup_datetime + CAST(l_quantity + 5 AS INTEGER) * INTERVAL 1 MINUTE AS dropoff_datetime,
          floor(l_extendedprice * (1.0::DOUBLE + l_tax) * 4) / 4 AS total_amount
        FROM items))"""

# Trips with the amounts of one green day doubled.
DOUBLED = ITEMS.replace("trips AS (", "stored AS (") + f""",
trips AS (
  SELECT * REPLACE (CASE WHEN service = 'green' AND trip_day = DATE '{DAY}' THEN 2 ELSE 1 END * total_amount AS total_amount) FROM stored)"""

ZONES = """
zones AS (
  SELECT n_nationkey AS "LocationID", r_name AS "Borough", n_name AS zone, r_name AS service_zone,
    40.5 + CAST(n_nationkey AS DOUBLE) * 0.125 AS latitude, -74.5 + CAST(n_nationkey AS DOUBLE) * 0.25 AS longitude
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""

CUSTOMERS = """
customers AS (SELECT c_custkey AS id, c_mktsegment AS segment FROM customer)"""


def _with(body: str, *tables: str) -> str:
    return f"WITH {', '.join(tables or (ITEMS, ZONES))} {body}"


MEASURES = """sum(total_amount) AS revenue_of_day, sum(tip_amount) / count(tip_amount) AS avg_tip_amount,
    sum(fare_amount) AS total_fare, sum(trip_distance) AS total_trip_distance,
    CAST(sum(date_diff('second', pickup_datetime, dropoff_datetime)) AS DOUBLE) / (count(*) * 60) AS avg_trip_time,
    sum(passenger_count) AS total_customer"""

DAILY = f"""
month_totals AS (
  SELECT a.service, a.trip_day, sum(b.revenue) AS revenue_of_month
  FROM (SELECT DISTINCT service, trip_day FROM trips) a
  JOIN (SELECT service, trip_day, sum(total_amount) AS revenue FROM trips GROUP BY ALL) b
    ON a.service = b.service AND date_trunc('month', a.trip_day) = date_trunc('month', b.trip_day)
   AND b.trip_day <= a.trip_day
  GROUP BY a.service, a.trip_day),
days AS (
  SELECT service, trip_day, {MEASURES} FROM trips WHERE pickup_date = trip_day GROUP BY service, trip_day),
daily AS (
  SELECT service, trip_day AS date, revenue_of_day, revenue_of_month, avg_tip_amount, total_fare,
    total_trip_distance, avg_trip_time, total_customer
  FROM days JOIN month_totals USING (service, trip_day))"""

DAILY_NAMES = """date, revenue_of_day, revenue_of_month, avg_tip_amount, total_fare, total_trip_distance,
    avg_trip_time, total_customer"""


def _zone_kpis(join: str) -> str:
    return f"""SELECT service, trip_day AS date, pulocationid, any_value(zone) AS zone,
        sum(total_amount) AS total_amount, sum(tip_amount) / count(*) AS avg_tip_amount,
        sum(fare_amount) AS total_fare, sum(trip_distance) / count(*) AS avg_trip_distance,
        sum(tolls_amount) / count(*) AS avg_tolls_amount,
        sum(congestion_surcharge) / count(*) AS avg_congestion_surcharge,
        count(pulocationid) AS total_trip_count
      FROM trips {join} zones ON pulocationid = "LocationID" GROUP BY service, trip_day, pulocationid"""


PROCESSED = """congestion_surcharge, dolocationid, o.latitude AS dropoff_latitude, o.longitude AS dropoff_longitude,
    dropoff_datetime, extra, fare_amount, id, id_customer, improvement_surcharge, mta_tax, passenger_count,
    p.latitude AS pickup_latitude, p.longitude AS pickup_longitude, pickup_datetime, pulocationid, ratecodeid,
    tip_amount, tolls_amount, total_amount, trip_distance, vendorid"""


def _cleaned(service: str, policy: str = "strict") -> str:
    """Rows of known zones; the strict policy also wants the columns that are dropped."""
    own = {"green": "trip_type", "yellow": "fee"}[service]
    rate = ", rate" if service == "green" else ""
    lost = f" AND payment_type IS NOT NULL AND {own} IS NOT NULL" if policy == "strict" else ""
    return f"""SELECT {PROCESSED}, CAST(coalesce(payment_type, 0) AS INTEGER) AS payment_type{rate}
      FROM trips JOIN zones p ON pulocationid = p."LocationID" JOIN zones o ON dolocationid = o."LocationID"
      WHERE service = '{service}'{lost}"""


def _audit(service: str) -> str:
    own = {"green": "trip_type", "yellow": "fee"}[service]
    complete = f"payment_type IS NOT NULL AND {own} IS NOT NULL AND pulocationid IS NOT NULL"
    return f"""SELECT '{service}' AS service, count(*) AS rows_in,
        count(*) FILTER ({complete} AND p.latitude IS NOT NULL AND o.latitude IS NOT NULL) AS rows_out,
        count(*) FILTER (NOT ({complete})) AS missing_value,
        count(*) FILTER (payment_type IS NULL) AS missing_payment_type,
        count(*) FILTER (pulocationid IS NOT NULL AND p.latitude IS NULL) AS unknown_pickup_zone,
        count(*) FILTER (o.latitude IS NULL) AS unknown_dropoff_zone,
        min(pickup_datetime) AS first_pickup, max(pickup_datetime) AS last_pickup
      FROM trips LEFT JOIN zones p ON pulocationid = p."LocationID" LEFT JOIN zones o ON dolocationid = o."LocationID"
      WHERE service = '{service}'"""


CLEANED_BOTH = f"""
green AS (SELECT * EXCLUDE (rate) FROM ({_cleaned('green')})),
yellow AS ({_cleaned('yellow')}),
cleaned AS (SELECT *, 1 AS service_type FROM yellow UNION ALL BY NAME SELECT *, 2 AS service_type FROM green)"""

TOP = f"""
top AS (SELECT id_customer, count(*) AS trip_count FROM trips GROUP BY id_customer
        ORDER BY trip_count DESC, id_customer LIMIT {TOP_K})"""

HABITS = """
habit_counts AS (SELECT id_customer, pickup_day, pickup_time_of_day, pulocationid, count(*) AS trips
                 FROM trips GROUP BY ALL),
habits AS (SELECT *, CAST(row_number() OVER (PARTITION BY id_customer
             ORDER BY trips DESC, pickup_day, pickup_time_of_day, pulocationid NULLS FIRST) AS INTEGER) AS rank
           FROM habit_counts QUALIFY rank = 1)"""


def _usual(name: str) -> str:
    """The most frequent value of one column for each customer."""
    return f"""
usual_{name} AS (
  SELECT id_customer, {name}, n FROM (SELECT id_customer, {name}, count(*) AS n FROM trips GROUP BY id_customer, {name})
  QUALIFY row_number() OVER (PARTITION BY id_customer ORDER BY n DESC, {name} NULLS FIRST) = 1)"""


TOTALS = """
totals AS (SELECT id_customer, count(*) AS trip_count, sum(total_amount) AS total_spent,
             sum(total_amount) / count(*) AS avg_spent, sum(tip_amount) AS total_tip,
             sum(tip_amount) / count(*) AS avg_tip
           FROM trips GROUP BY id_customer)"""

PROFILE = """SELECT id_customer AS "customerID", z.n AS count, trip_count, total_spent, avg_spent, total_tip, avg_tip,
    pulocationid AS "LocationID", zone, service_zone, pickup_time_of_day
  FROM totals JOIN usual_pulocationid z USING (id_customer) JOIN usual_pickup_time_of_day USING (id_customer)
  JOIN zones ON pulocationid = "LocationID" """


def _draw(seed: int) -> str:
    key = f"concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, {seed})"
    return f"CAST('0x' || substr(md5({key}), 1, 13) AS BIGINT)"


def _zero_filled(name: str) -> str:
    text = f"CAST({name} AS VARCHAR)"
    return f"lpad({text}, CAST(greatest(8, length({text})) AS INTEGER), '0')"


AFTER = """vendorid, lpep_pickup_datetime, lpep_dropoff_datetime, store_and_fwd_flag, ratecodeid, pulocationid,
    dolocationid, passenger_count, trip_distance, fare_amount, extra, mta_tax, tip_amount, tolls_amount,
    improvement_surcharge, total_amount, payment_type, trip_type, congestion_surcharge, id, id_customer, rate"""
NUMBERED = f"""
numbered AS (
  SELECT * EXCLUDE (id), year || month || {_zero_filled('number')} AS id
  FROM (SELECT *, strftime(pickup_datetime, '%Y') AS year, strftime(pickup_datetime, '%m') AS month,
          row_number() OVER (PARTITION BY date_trunc('month', pickup_datetime)
            ORDER BY pickup_datetime, {KEY}) AS number
        FROM trips))"""


def _id_draw(seed: int) -> str:
    return f"CAST('0x' || substr(md5(numbered.id || '-{seed}'), 1, 13) AS BIGINT)"


CHANGES = """
changes AS (SELECT *, pickup_datetime AS lpep_pickup_datetime, dropoff_datetime AS lpep_dropoff_datetime,
    CASE WHEN l_orderkey % 101 = 0 THEN 'malformed' WHEN l_orderkey % 103 = 0 THEN 'empty'
         WHEN l_orderkey % 97 = 0 THEN 'delete' END AS reason
  FROM trips WHERE service = 'green')"""
APPENDED = _with(f"SELECT {AFTER} FROM changes WHERE reason IS NULL", ITEMS, CHANGES)

COUNTED = _with(
    "SELECT id_customer, count(*) AS customer_count FROM changes WHERE reason IS NULL GROUP BY id_customer", ITEMS, CHANGES
)

MEDIA = """
files AS (SELECT doc_id, CASE WHEN doc_id % 50 = 7 THEN '' ELSE CAST(doc_id AS VARCHAR) END AS id,
    '2024' AS year, lpad(CAST(doc_id % 12 + 1 AS VARCHAR), 2, '0') AS month,
    lpad(CAST(doc_id % 28 + 1 AS VARCHAR), 2, '0') AS day, text, base64(encode(text)) AS image_data,
  FROM documents),
messages AS (SELECT *, CAST(octet_length(encode('{"image_data":"' || image_data || '","metadata":{"id":"' || id
    || '","year":"' || year || '","month":"' || month || '","day":"' || day || '"}}')) AS BIGINT) AS n_bytes
  FROM files),
objects AS (SELECT format('image/{}/{}/{}/{}.jpg', year, month, day, id) AS path, 'image/jpeg' AS content_type,
    octet_length(encode(text)) AS n_bytes, md5(text) AS digest
  FROM messages WHERE id <> '' AND n_bytes <= 5242880)"""

# The fields of an after-image: times as microseconds, nothing for a delete.
ENCODED = ", ".join(
    f"CASE WHEN l_orderkey % 97 <> 0 THEN {f'epoch_us({name})' if name.endswith('_datetime') else name} END AS {name}"
    for name in AFTER.replace("\n", " ").replace(" ", "").split(",")
)


def _gate(limit: int) -> str:
    return f"""SELECT id, n_bytes, CASE WHEN id = '' THEN 'no_id' WHEN n_bytes > {limit} THEN 'too_long' END AS reason
      FROM messages"""


STORED = "service = '{0}' AND trip_day BETWEEN date_trunc('month', DATE '{1}') AND DATE '{1}'".format(SERVICE, DAY)

ORACLE: dict[str, str] = {
    "daily_kpis": _with("SELECT * FROM daily", ITEMS, DAILY),
    "daily_kpis_one_day": _with(
        f"SELECT {DAILY_NAMES} FROM daily WHERE service = '{SERVICE}' AND date = DATE '{DAY}'", ITEMS, DAILY
    ),
    "daily_kpis_joined_form": _with(
        f"SELECT {DAILY_NAMES} FROM daily WHERE service = '{SERVICE}' AND date = DATE '{DAY}'", ITEMS, DAILY
    ),
    "month_to_date_revenue": _with(f"SELECT sum(total_amount) AS revenue_of_month FROM trips WHERE {STORED}"),
    "revenue_running_month": _with(
        """SELECT service, pickup_date AS date, sum(total_amount) AS revenue_of_day,
             sum(sum(total_amount)) OVER (PARTITION BY service, date_trunc('month', pickup_date)
               ORDER BY pickup_date ROWS UNBOUNDED PRECEDING) AS running_revenue
           FROM trips GROUP BY service, pickup_date"""
    ),
    "zone_kpis": _with(_zone_kpis("LEFT JOIN")),
    "zone_kpis_known_only": _with(_zone_kpis("JOIN")),
    "zone_kpis_one_day": _with(
        f"SELECT * EXCLUDE (service) FROM ({_zone_kpis('LEFT JOIN')}) WHERE service = '{SERVICE}' AND date = DATE '{DAY}'"
    ),
    "part_of_day_mix": _with("SELECT service, pickup_time_of_day, count(*) AS trips FROM trips GROUP BY ALL"),
    "calendar_mix": _with(
        """SELECT CAST(year(pickup_datetime) AS INTEGER) AS year, strftime(pickup_datetime, '%b') AS month,
             dayname(pickup_datetime) AS dow, CAST(hour(pickup_datetime) AS INTEGER) AS pickup_hour, pickup_date,
             CAST(month(pickup_datetime) AS INTEGER) AS pickup_month, count(*) AS trips,
             'data/' || strftime(pickup_date, '%Y/%m/%d') AS folder
           FROM trips GROUP BY ALL"""
    ),
    "clean_trips_strict": _with(_cleaned("yellow")),
    "clean_trips_strict_green": _with(_cleaned("green")),
    "clean_trips_intent": _with(_cleaned("yellow", "intent")),
    "clean_trips_intent_green": _with(_cleaned("green", "intent")),
    "clean_trips_inner_form": _with(_cleaned("yellow")),
    "clean_audit": _with(f"{_audit('yellow')} UNION ALL {_audit('green')}"),
    "all_trips_cleaned": _with("SELECT * EXCLUDE (service_type) FROM cleaned", ITEMS, ZONES, CLEANED_BOTH),
    "fact_rollup_all": _with(
        """SELECT CAST(year(pickup_datetime) AS INTEGER) AS year, strftime(pickup_datetime, '%b') AS month,
             dayname(pickup_datetime) AS dow, vendorid AS vendor_id, ratecodeid AS rate_code_id,
             pulocationid AS pickup_location_id, dolocationid AS dropoff_location_id,
             payment_type AS payment_type_id, pickup_datetime, dropoff_datetime, pickup_latitude, pickup_longitude,
             dropoff_latitude, dropoff_longitude, sum(passenger_count) AS passenger_count,
             sum(trip_distance) AS trip_distance, sum(extra) AS extra, sum(mta_tax) AS mta_tax,
             sum(fare_amount) AS fare_amount, sum(tip_amount) AS tip_amount, sum(tolls_amount) AS tolls_amount,
             sum(total_amount) AS total_amount, sum(improvement_surcharge) AS improvement_surcharge,
             sum(congestion_surcharge) AS congestion_surcharge, service_type
           FROM cleaned GROUP BY ALL""",
        ITEMS,
        ZONES,
        CLEANED_BOTH,
    ),
    "top_customers": _with("SELECT * FROM top", ITEMS, TOP),
    "top_customers_by_sketch": _with("SELECT * FROM top", ITEMS, TOP),
    "busiest_zones_by_sketch": _with(
        f"""SELECT pulocationid, count(*) AS trips FROM trips GROUP BY pulocationid
            ORDER BY trips DESC, pulocationid NULLS FIRST LIMIT {TOP_K}"""
    ),
    "top_customer_trips": _with(
        f"""SELECT id_customer, {KEY}, service, pickup_datetime, pulocationid, total_amount
            FROM trips WHERE id_customer IN (SELECT id_customer FROM top)""",
        ITEMS,
        TOP,
    ),
    "top_customer_habits": _with(
        """SELECT id_customer AS "customerID", pickup_day, pickup_time_of_day, "LocationID", zone, service_zone
           FROM top JOIN habits USING (id_customer) JOIN zones ON pulocationid = "LocationID" """,
        ITEMS,
        ZONES,
        TOP,
        HABITS,
    ),
    "top_customer_habits_each": _with(
        """SELECT id_customer AS "customerID", pickup_day, pickup_time_of_day, "LocationID", zone, service_zone
           FROM top JOIN usual_pickup_day USING (id_customer) JOIN usual_pickup_time_of_day USING (id_customer)
           JOIN usual_pulocationid USING (id_customer) JOIN zones ON pulocationid = "LocationID" """,
        ITEMS,
        ZONES,
        TOP,
        _usual("pickup_day"),
        _usual("pickup_time_of_day"),
        _usual("pulocationid"),
    ),
    "customer_habits": _with(
        """SELECT id_customer, trip_count, pickup_day, pickup_time_of_day, pulocationid
           FROM totals JOIN habits USING (id_customer)""",
        ITEMS,
        TOTALS,
        HABITS,
    ),
    "customer_habits_ranked": _with("SELECT * FROM habits", ITEMS, HABITS),
    "customer_totals": _with("SELECT * FROM totals", ITEMS, TOTALS),
    "customer_totals_drawn": _with(
        "SELECT * FROM totals",
        ITEMS.replace("l_partkey AS id_customer", f"{_draw(17)} % {DRAWN_CUSTOMERS} + 1 AS id_customer"),
        TOTALS,
    ),
    "customer_profile": _with(
        PROFILE, ITEMS, ZONES, TOTALS, _usual("pulocationid"), _usual("pickup_time_of_day")
    ),
    "customer_profile_one": _with(
        f"{PROFILE} WHERE id_customer = {CUSTOMER}",
        ITEMS,
        ZONES,
        TOTALS,
        _usual("pulocationid"),
        _usual("pickup_time_of_day"),
    ),
    "trips_with_ids": _with(
        f"SELECT {KEY}, pickup_datetime, year, month, id FROM numbered", ITEMS, NUMBERED
    ),
    "trips_with_customers": _with(
        f"""SELECT {KEY}, service, listed.id AS id_customer
            FROM (SELECT {KEY}, service, {_draw(7)} % (SELECT count(*) FROM customers) AS place FROM trips)
            JOIN (SELECT id, row_number() OVER (ORDER BY id) - 1 AS place FROM customers) listed USING (place)""",
        ITEMS,
        CUSTOMERS,
    ),
    "trips_with_rating": _with(
        f"""SELECT {KEY}, least(round({_draw(11)} / CAST(4503599627370496 AS DOUBLE) * 5, 1) + 1, 5.0) AS rate
            FROM lineitem""",
        ITEMS,
    ),
    "trips_augmented": _with(
        f"""SELECT {KEY}, pickup_datetime, year, month, numbered.id, listed.id AS id_customer,
              least(round({_id_draw(43)} / CAST(4503599627370496 AS DOUBLE) * 5, 1) + 1, 5.0) AS rate
            FROM numbered
            JOIN (SELECT id, row_number() OVER (ORDER BY id) - 1 AS place FROM customers) listed
              ON place = {_id_draw(42)} % (SELECT count(*) FROM customers)""",
        ITEMS,
        CUSTOMERS,
        NUMBERED,
    ),
    "customers_normalized": _with(
        f"SELECT {_zero_filled('id')} AS id, segment FROM customers",
        CUSTOMERS,
    ),
    "customer_id_collisions": _with(
        f"""SELECT {_zero_filled('id')} AS id, segment
           FROM customers WHERE id IN (SELECT s_suppkey FROM supplier)""",
        CUSTOMERS,
    ),
    "customer_id_unused": _with(
        f"""SELECT {_zero_filled('id')} AS id, segment
           FROM customers WHERE id NOT IN (SELECT s_suppkey FROM supplier)""",
        CUSTOMERS,
    ),
    "trip_sample": _with(
        f"SELECT {KEY}, service, total_amount FROM trips ORDER BY {_draw(13)}, {KEY} LIMIT {SAMPLE_ROWS}"
    ),
    "trip_sample_third": _with(
        f"SELECT {KEY}, service, total_amount FROM trips ORDER BY {_draw(13)}, {KEY} LIMIT (SELECT count(*) // 3 FROM lineitem)"
    ),
    "month_files_read": _with(
        f"""SELECT service, strftime(pickup_datetime, '%Y') AS year, strftime(pickup_datetime, '%m') AS month,
              count(*) AS trips, sum(passenger_count) AS passengers,
              count(*) FILTER (year(pickup_datetime) >= {NEW_FORM_FROM}) AS in_new_form
            FROM trips WHERE service = 'yellow' GROUP BY ALL"""
    ),
    "month_files_cleaned": _with(f"{_cleaned('yellow', 'intent')} AND payment_type IS NOT NULL"),
    "month_files_augmented": _with(
        f"""SELECT {KEY}, pickup_datetime, numbered.id, listed.id AS id_customer,
              least(round({_id_draw(43)} / CAST(4503599627370496 AS DOUBLE) * 5, 1) + 1, 5.0) AS rate
            FROM numbered
            JOIN (SELECT id, row_number() OVER (ORDER BY id) - 1 AS place FROM customers) listed
              ON place = {_id_draw(42)} % (SELECT count(*) FROM customers)""",
        ITEMS.replace("FROM lineitem)", "FROM lineitem WHERE l_returnflag = 'R')"),
        CUSTOMERS,
        NUMBERED,
    ),
    "store_file_counts": _with(
        f"SELECT service, CAST({STORE_FILES} AS BIGINT) AS files, count(*) AS trips FROM trips GROUP BY service"
    ),
    "unwanted_columns_dropped": _with(f"SELECT {KEY}, total_amount FROM trips"),
    "coordinates_added_once": _with(
        f"""SELECT {KEY}, pulocationid, dolocationid, CAST(1.5 AS DOUBLE) AS pickup_latitude, CAST(2.5 AS DOUBLE) AS pickup_longitude,
              latitude AS dropoff_latitude, longitude AS dropoff_longitude
            FROM trips LEFT JOIN zones ON dolocationid = "LocationID" """
    ),
    "trips_split_by_day": _with(
        """SELECT service, trip_day, count(*) AS trips, min(dropoff_datetime) AS first_dropoff,
             max(dropoff_datetime) AS last_dropoff FROM trips GROUP BY ALL"""
    ),
    "store_month_to_date": _with(
        f"SELECT pickup_date, count(*) AS trips, sum(total_amount) AS revenue FROM trips WHERE {STORED} GROUP BY ALL"
    ),
    "store_one_day": _with(
        f"""SELECT {KEY}, pickup_date, pickup_datetime, total_amount FROM trips
            WHERE service = '{SERVICE}' AND trip_day = DATE '{DAY}'"""
    ),
    "publish_one_day": _with(f"SELECT service, {DAILY_NAMES} FROM daily WHERE date = DATE '{DAY}'", ITEMS, DAILY),
    "publish_one_day_zones": _with(f"SELECT * FROM ({_zone_kpis('LEFT JOIN')}) WHERE date = DATE '{DAY}'"),
    "day_overwrite": _with(
        """SELECT service, trip_day, count(*) AS trips,
             sum(CASE WHEN service = 'green' AND month(trip_day) = 1 THEN 2 ELSE 1 END * total_amount) AS revenue
           FROM trips GROUP BY ALL"""
    ),
    "write_roundtrip": _with(
        f"""SELECT service, trip_day, pickup_datetime, dropoff_datetime, pulocationid, dolocationid, passenger_count,
              trip_distance, fare_amount, extra, mta_tax, tip_amount, tolls_amount, improvement_surcharge,
              total_amount, congestion_surcharge, id_customer, {KEY} FROM trips"""
    ),
    "convert_formats": _with(f"SELECT service, {KEY}, pickup_datetime, pulocationid, total_amount FROM trips"),
    "append_tables": _with(f"SELECT service, {KEY}, total_amount FROM trips"),
    "processed_store_kpis": _with(
        _zone_kpis("JOIN").replace("GROUP BY", """JOIN zones o ON dolocationid = o."LocationID"
          WHERE payment_type IS NOT NULL AND CASE WHEN service = 'green' THEN trip_type ELSE fee END IS NOT NULL
          GROUP BY""").replace("any_value(zone)", "any_value(zones.zone)").replace(
            '= "LocationID"', '= zones."LocationID"'
        )
    ),
    "publish_daily": _with("SELECT *, strftime(date, '%Y-%m') AS month FROM daily", ITEMS, DAILY),
    "publish_twice": _with(f"SELECT *, CAST(year(date) AS INTEGER) AS year FROM ({_zone_kpis('LEFT JOIN')})"),
    "publish_limited": _with(
        f"{_zone_kpis('LEFT JOIN')} ORDER BY date, service, pulocationid NULLS FIRST LIMIT {PUBLISHED_ROWS}"
    ),
    "csv_roundtrip": _with(f"SELECT {KEY}, service, trip_day, total_amount FROM trips"),
    "recursive_scan": _with(
        """SELECT service AS folder, service AS kept_service, count(*) AS trips, sum(total_amount) AS revenue
           FROM trips GROUP BY ALL"""
    ),
    "latest_file_of_store": _with("SELECT * FROM zones", ZONES),
    "ingest_overlapping_years": _with(
        "SELECT service, trip_day, count(*) AS trips, sum(total_amount) AS revenue FROM trips GROUP BY ALL"
    ),
    "ingest_default_layout": _with(
        f"""SELECT service, trip_day, count(*) AS trips, sum(total_amount) AS revenue FROM trips
            WHERE service = 'green' AND NOT (year(pickup_datetime) = {SHORTENED} AND pickup_datetime >= DATE '{LOST_FROM}') GROUP BY ALL"""
    ),
    "daily_kpis_from_partials": _with("SELECT * FROM daily", DOUBLED, DAILY),
    "zone_kpis_from_partials": _with(_zone_kpis("LEFT JOIN"), DOUBLED, ZONES),
    "lookup_csv_pinned": _with("SELECT * FROM zones", ZONES),
    "lookup_csv_inferred": _with("SELECT * FROM zones", ZONES),
    "cdc_parse": APPENDED,
    "cdc_encode": _with(
        f"""SELECT {KEY}, CASE WHEN l_orderkey % 97 = 0 THEN 'd' WHEN l_orderkey % 3 = 0 THEN 'u' ELSE 'c' END AS op,
              {ENCODED}
            FROM (SELECT *, pickup_datetime AS lpep_pickup_datetime, dropoff_datetime AS lpep_dropoff_datetime FROM trips)
            WHERE service = 'green'"""
    ),
    "cdc_stream_rejects": _with("SELECT reason, count(*) AS messages FROM changes WHERE reason IS NOT NULL GROUP BY reason", ITEMS, CHANGES),
    "cdc_rejects": _with("SELECT reason, count(*) AS messages FROM changes WHERE reason IS NOT NULL GROUP BY reason", ITEMS, CHANGES),
    "cdc_stream_append": APPENDED,
    "cdc_stream_customer_count": COUNTED,
    "cdc_stream_count_table": COUNTED,
    "cdc_state_after_stop": COUNTED,
    "cdc_recovery_gaps": _with(
        """SELECT count(DISTINCT id_customer) AS customers, count(*) AS changes, CAST(0 AS BIGINT) AS gaps
           FROM changes WHERE reason IS NULL""",
        ITEMS,
        CHANGES,
    ),
    "cdc_replay": APPENDED,
    "media_encode": _with("SELECT id, image_data FROM messages WHERE id <> '' AND n_bytes <= 5242880", MEDIA),
    "media_gate": _with(_gate(MEDIA_BYTES), MEDIA),
    "media_gate_product": _with(_gate(5242880), MEDIA),
    "media_stream_speech": _with(
        """SELECT replace(replace(path, 'image/', 'speech/'), '.jpg', '.mp3') AS path, 'audio/mpeg' AS content_type,
             n_bytes, digest FROM objects""",
        MEDIA,
    ),
    "media_stream_latest": _with("SELECT path, content_type, n_bytes, digest FROM objects", MEDIA),
    "media_stream_rejects": _with(
        """SELECT reason, count(*) AS messages
           FROM (SELECT doc_id, 'no_path' AS reason FROM messages WHERE id <> '' AND n_bytes <= 5242880 AND doc_id % 7 = 0
                 UNION ALL
                 SELECT doc_id, 'no_content' FROM messages WHERE id <> '' AND n_bytes <= 5242880 AND doc_id % 11 = 0)
           GROUP BY reason""",
        MEDIA,
    ),
    "media_rejects": _with(
        f"""SELECT id, n_bytes, CASE WHEN id = '' THEN 'no_id' ELSE 'too_long' END AS reason
            FROM messages WHERE id = '' OR n_bytes > {MEDIA_BYTES}""",
        MEDIA,
    ),
    "media_decode": _with("SELECT path, content_type, n_bytes, digest FROM objects", MEDIA),
    "media_stream_objects": _with("SELECT path, content_type, n_bytes, digest FROM objects", MEDIA),
    "media_stream_files": _with("SELECT path, n_bytes, digest FROM objects", MEDIA),
}
