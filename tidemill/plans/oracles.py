"""DuckDB SQL for the registered queries."""

from __future__ import annotations

FB = """
fb0 AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, CAST(user_id AS VARCHAR) AS uid,
  CAST(user_id AS VARCHAR) || '_' || strftime(ts, '%Y%m%d') AS session_id FROM events),
fb AS (SELECT uid AS user_id, CAST(k AS VARCHAR) AS experience_id, k, CAST(event_id AS VARCHAR) AS event_id, event_id AS eid,
  CASE event_type WHEN 'view' THEN 'VIEW' WHEN 'click' THEN 'CLICK' WHEN 'purchase' THEN 'ACTION' WHEN 'error' THEN 'NEGATIVE' WHEN 'signup' THEN 'IMPRESSION' END AS kind,
  event_type AS raw_type, CASE WHEN event_id % 2 = 0 THEN session_id END AS request_id, session_id, k % 50 AS position, CAST(ts AS TIMESTAMP) AS ts, CAST(round(value * 100) AS BIGINT) AS dwell FROM fb0)"""
EX = """
ex AS (SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS name, p_brand AS category_id, p_type AS category_name, (p_partkey % 1800) / 10.0::DOUBLE - 90 AS lat, (p_partkey % 3600) / 10.0::DOUBLE - 180 AS lng,
  'C' || CAST(p_partkey % 25 AS VARCHAR) AS city, p_retailprice AS price, p_partkey % 21 - 7 AS until, p_partkey % 5 AS hours, p_size * (p_partkey % 4) AS seats, p_partkey % 90 AS age FROM part)"""
PF = """
pf AS (SELECT CAST(c_custkey AS VARCHAR) AS id, c_custkey % 3 AS gender, CAST(floor(c_acctbal / 1000) AS INTEGER) AS score, n_name AS city, (c_custkey % 1790) / 10.0::DOUBLE - 89 AS lat, (c_custkey % 3590) / 10.0::DOUBLE - 179 AS lng,
  c_mktsegment AS segment, c_custkey % 40 AS age FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey)"""
SERVED = """
sv AS (SELECT user_id, session_id AS request_id, experience_id, k, min(ts) AS t FROM fb GROUP BY ALL),
items AS (SELECT user_id, request_id, experience_id, CAST(row_number() OVER (PARTITION BY request_id ORDER BY t, k) - 1 AS INTEGER) AS position, min(t) OVER (PARTITION BY request_id) AS served_at FROM sv)"""
LABELS = (
    SERVED
    + """,
ff AS (SELECT * FROM fb WHERE kind IN ('CLICK', 'VIEW', 'ACTION')),
ru AS (SELECT request_id, user_id, experience_id, max(CAST(kind = 'CLICK' AS INTEGER)) AS c, max(CAST(kind = 'ACTION' AS INTEGER)) AS a, max(CAST(kind = 'VIEW' AS INTEGER)) AS v, max(dwell) FILTER (kind = 'VIEW') AS d FROM ff WHERE request_id IS NOT NULL GROUP BY ALL),
su AS (SELECT session_id, user_id, experience_id, max(CAST(kind = 'CLICK' AS INTEGER)) AS c, max(CAST(kind = 'ACTION' AS INTEGER)) AS a, max(CAST(kind = 'VIEW' AS INTEGER)) AS v, max(dwell) FILTER (kind = 'VIEW') AS d FROM ff GROUP BY ALL),
l0 AS (SELECT i.*, coalesce(r.c, s.c, 0) AS clicked, coalesce(r.a, s.a, 0) AS acted, coalesce(r.v, s.v, 0) AS viewed, coalesce(r.d, s.d, 0) AS dwell_ms FROM items i
  LEFT JOIN ru r ON r.request_id = i.request_id AND r.user_id = i.user_id AND r.experience_id = i.experience_id LEFT JOIN su s ON s.session_id = i.request_id AND s.user_id = i.user_id AND s.experience_id = i.experience_id),
lab AS (SELECT *, CAST(CASE WHEN acted = 1 THEN 1.0 WHEN dwell_ms >= 10000 THEN 0.7 WHEN clicked = 1 THEN 0.5 WHEN dwell_ms >= 3000 THEN 0.3 WHEN viewed = 1 THEN 0.1 ELSE 0.0 END AS DOUBLE) AS label FROM l0)"""
)
KM = "CASE WHEN u.lat IS NOT NULL AND e.lat IS NOT NULL THEN 2 * 6371.0 * asin(sqrt(least(power(sin(radians(e.lat - u.lat) / 2), 2) + cos(radians(u.lat)) * cos(radians(e.lat)) * power(sin(radians(e.lng - u.lng) / 2), 2), 1.0))) END"
BUCKET = f"CASE WHEN {KM} IS NULL THEN 'unknown' WHEN {KM} <= 5 THEN 'nearby' WHEN {KM} <= 20 THEN 'local' WHEN {KM} <= 50 THEN 'regional' ELSE 'distant' END"
PRICE = "CASE WHEN price IS NULL OR price = 0 THEN 'free' WHEN price < 500 THEN 'budget' WHEN price < 2000 THEN 'standard' WHEN price < 5000 THEN 'premium' ELSE 'luxury' END"
WEEK = "ts >= TIMESTAMP '2024-01-23'"
SEG = """
seg AS (SELECT user_id, strftime(ts, '%Y%m%d') AS day, k, eid, raw_type, ts, (epoch_us(ts) // 1000) AS ms FROM fb)"""


def _user(n: str, d: str) -> str:
    return f"CASE WHEN {d} > 0 THEN {n} / CAST({d} AS DOUBLE) ELSE 0.0 END"


def _engagement(smoothed: bool) -> str:
    dwell = "CASE WHEN dwell < 1000 THEN 1000 WHEN dwell > 600000 THEN 600000 ELSE dwell END" if smoothed else "dwell"
    r = (lambda n, d, k: f"{n} / CAST({d} + {k} AS DOUBLE)") if smoothed else (lambda n, d, k: _user(n, d))
    cold = "i7 < 10" if smoothed else "i30 + i7 < 10"
    avg = "coalesce(dw, 0.0)" if smoothed else "dw"
    return f"""WITH {FB},
a AS (SELECT user_id, {", ".join(f"count(*) FILTER (kind = '{k}' AND {WEEK}) AS {k[0].lower()}7, count(*) FILTER (kind = '{k}') AS {k[0].lower()}30" for k in ("IMPRESSION", "CLICK", "VIEW", "ACTION", "NEGATIVE"))},
  count(DISTINCT CASE WHEN kind = 'CLICK' AND {WEEK} THEN experience_id END) AS uc, avg(CASE WHEN kind = 'VIEW' AND {WEEK} THEN {dwell} END) AS dw
  FROM fb WHERE ts >= TIMESTAMP '2023-12-31' AND ts < TIMESTAMP '2024-01-31' GROUP BY user_id)
SELECT user_id, i7 AS user_impressions_7d, c7 AS user_clicks_7d, v7 AS user_views_7d, a7 AS user_actions_7d, n7 AS user_negatives_7d, i30 AS user_impressions_30d, c30 AS user_clicks_30d, v30 AS user_views_30d, a30 AS user_actions_30d,
  uc AS user_unique_clicks_7d, round({avg}, 6) AS user_avg_dwell_time_ms_7d, round({r("c7", "i7", 10)}, 6) AS user_ctr_7d, round({r("c30", "i30", 10)}, 6) AS user_ctr_30d, round({r("a7", "c7", 5)}, 6) AS user_action_rate_7d,
  round({r("v7", "c7", 5)}, 6) AS user_view_rate_7d, {cold} AS user_is_cold_start FROM a"""


def _items(smoothed: bool) -> str:
    r = (lambda n, d, k: f"{n} / CAST({d} + {k} AS DOUBLE)") if smoothed else (lambda n, d, k: _user(n, d))
    more = "" if smoothed else ", count(*) FILTER (kind = 'VIEW' AND ts >= TIMESTAMP '2024-01-29') AS v1"
    end = (
        ", CASE WHEN rk <= total * 0.1 THEN 'hot' WHEN rk <= total * 0.3 THEN 'popular' WHEN rk <= total * 0.7 THEN 'normal' ELSE 'cold' END AS exp_popularity_tier"
        if smoothed
        else ", v1 AS exp_total_views_1d, CAST(0.1 AS DOUBLE) AS exp_avg_engagement_7d, v AS exp_total_views_7d, CAST(0 AS DOUBLE) AS exp_bookmark_rate_7d, CAST(0 AS DOUBLE) AS exp_share_rate_7d, CASE WHEN v + 5 * c > 1000 THEN 'hot' WHEN v + 5 * c > 100 THEN 'popular' WHEN v + 5 * c > 10 THEN 'normal' ELSE 'cold' END AS exp_popularity_tier"
    )
    return f"""WITH {FB},
a AS (SELECT experience_id, count(*) FILTER (kind = 'IMPRESSION') AS i, count(*) FILTER (kind = 'CLICK') AS c, count(*) FILTER (kind = 'VIEW') AS v, count(*) FILTER (kind = 'ACTION') AS a, count(DISTINCT user_id) AS uv,
  count(DISTINCT CASE WHEN kind = 'CLICK' THEN user_id END) AS uk, avg(position) AS ap, min(position) AS bp {more} FROM fb WHERE {WEEK} AND ts < TIMESTAMP '2024-01-31' GROUP BY experience_id),
b AS (SELECT *, row_number() OVER (ORDER BY i DESC, experience_id) AS rk, count(*) OVER () AS total FROM a)
SELECT experience_id, i AS exp_impressions_7d, c AS exp_clicks_7d, v AS exp_views_7d, a AS exp_actions_7d, uv AS exp_unique_viewers_7d, uk AS exp_unique_clickers_7d, round(ap, 6) AS exp_avg_position_7d, bp AS exp_best_position_7d,
  round({r("c", "i", 10)}, 6) AS exp_ctr_7d, round({r("a", "c", 5)}, 6) AS exp_booking_rate_7d, round({r("v", "c", 5)}, 6) AS exp_view_rate_7d {end} FROM b"""


_TOP = f"""tc AS (SELECT user_id, category_name, count(*) AS n FROM fb JOIN ex ON ex.id = fb.experience_id WHERE kind IN ('CLICK', 'ACTION', 'VIEW') AND category_name IS NOT NULL AND ts >= TIMESTAMP '2023-12-31' AND ts < TIMESTAMP '2024-01-31' GROUP BY ALL),
tk AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, category_name) AS rk FROM tc),
top AS (SELECT user_id, string_agg(category_name, '|' ORDER BY rk) AS user_top_categories FROM tk WHERE rk <= 5 GROUP BY user_id)"""
_POS = """p0 AS (SELECT *, CASE WHEN kind = 'ACTION' THEN 3 WHEN kind = 'VIEW' AND dwell >= 3000 THEN 2 WHEN kind = 'CLICK' THEN 1 END AS strength FROM fb),
pos AS (SELECT * FROM p0 WHERE strength IS NOT NULL QUALIFY row_number() OVER (PARTITION BY user_id, experience_id ORDER BY strength DESC, ts DESC, event_id) = 1)"""
_NEG = """num AS (SELECT id, row_number() OVER (ORDER BY CAST(('0x' || substr(md5(id), 1, 15)) AS BIGINT) % 65536, id) - 1 AS r FROM ex),
size AS (SELECT count(*) AS total FROM num),
usr AS (SELECT user_id, count(*) AS n, CAST(('0x' || substr(md5(user_id || '|start'), 1, 15)) AS BIGINT) % (SELECT total FROM size) AS b0, CAST(('0x' || substr(md5(user_id || '|step'), 1, 15)) AS BIGINT) % (SELECT total FROM size) + 1 AS near FROM pos GROUP BY user_id),
step AS (SELECT *, near + (SELECT min(d) FROM range(128) t(d) WHERE gcd(near + d, (SELECT total FROM size)) = 1) AS s FROM usr),
walk AS (SELECT user_id, n, unnest(range(least(5 * n, (SELECT total FROM size)))) AS k, b0, s FROM step),
free AS (SELECT w.user_id, num.id AS experience_id, w.n, row_number() OVER (PARTITION BY w.user_id ORDER BY w.k) AS turn FROM walk w JOIN num ON num.r = (w.b0 + w.k * (w.s % (SELECT total FROM size))) % (SELECT total FROM size)
  WHERE NOT EXISTS (SELECT 1 FROM pos WHERE pos.user_id = w.user_id AND pos.experience_id = num.id)),
neg AS (SELECT user_id, experience_id FROM free WHERE turn <= 4 * n)"""
_WHO = "LEFT JOIN pf u ON u.id = {0}.user_id LEFT JOIN ex e ON e.id = {0}.experience_id"
_DEDUP = "md5('events.raw:' || CAST(event_id % 4 AS VARCHAR) || ':' || CAST(event_id AS VARCHAR) || ':' || CAST((epoch_us(ts) // 1000) AS VARCHAR))"

_DEVICE = "dc AS (SELECT request_id, arg_min('p' || CAST(eid % 3 AS VARCHAR), (ts, event_id)) AS platform, min(ts) AS t0 FROM fb WHERE request_id IS NOT NULL GROUP BY 1)"
_DEVICE_ENGAGED = _DEVICE.replace("request_id IS NOT NULL", "request_id IS NOT NULL AND kind IN ('CLICK', 'VIEW', 'ACTION')")
_HOUR = "CAST(coalesce(hour(t0), 12) AS INTEGER)"


def _last(column: str, n: int, name: str) -> str:
    """The last n distinct values of a user's day in order of first appearance, as one text."""
    return f"""{name} AS (SELECT user_id, day, string_agg(v, '|' ORDER BY first) AS {name} FROM (SELECT user_id, day, {column} AS v, min(rn) AS first FROM o GROUP BY user_id, day, {column} QUALIFY row_number() OVER (PARTITION BY user_id, day ORDER BY min(rn) DESC) <= {n}) GROUP BY ALL)"""


ORACLES = {
    "user_engagement_raw": _engagement(False),
    "user_engagement_smoothed": _engagement(True),
    "experience_engagement_raw": _items(False),
    "experience_engagement_smoothed": _items(True),
    "session_features": f"""WITH {FB},
a AS (SELECT *, epoch_us(ts) // 1000000 AS s, lag(epoch_us(ts) // 1000000) OVER (PARTITION BY user_id ORDER BY ts) AS p, lag(position % 3) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS was FROM fb WHERE ts >= TIMESTAMP '2024-01-30' AND ts < TIMESTAMP '2024-01-31'),
b AS (SELECT *, sum(CASE WHEN s - p > 1800 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts) AS n FROM a)
SELECT user_id, user_id || '_' || CAST(CAST(n AS BIGINT) AS VARCHAR) AS session_id, CAST(max(s) - min(s) AS BIGINT) AS session_duration_seconds, count(*) AS session_event_count, count(*) FILTER (was <> position % 3) AS session_location_changes,
  count(DISTINCT experience_id) AS session_unique_experiences, (epoch_us(TIMESTAMP '2024-01-30') // 1000) AS event_timestamp FROM b GROUP BY user_id, n""",
    "user_top_categories": f"WITH {FB}, {EX}, {_TOP} SELECT * FROM top",
    "latest_profile": f"WITH {FB} SELECT user_id, event_id, 'EVENT_TYPE_' || kind AS event_type, (epoch_us(ts) // 1000) AS event_timestamp FROM fb QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, eid) = 1",
    "latest_content": f"WITH {FB} SELECT experience_id, event_id, user_id, (epoch_us(ts) // 1000) AS event_timestamp FROM fb QUALIFY row_number() OVER (PARTITION BY experience_id ORDER BY ts DESC, eid) = 1",
    "user_features_full": f"""WITH {FB}, {EX}, {PF}, {_TOP}, g AS (SELECT user_id, count(*) FILTER (kind = 'IMPRESSION' AND {WEEK}) AS i7, count(*) FILTER (kind = 'CLICK' AND {WEEK}) AS c7, count(*) FILTER (kind = 'IMPRESSION') AS i30, count(*) FILTER (kind = 'CLICK') AS c30 FROM fb WHERE ts >= TIMESTAMP '2023-12-31' AND ts < TIMESTAMP '2024-01-31' GROUP BY user_id)
SELECT g.user_id, i7 AS user_impressions_7d, c30 AS user_clicks_30d, round({_user("c7", "i7")}, 6) AS user_ctr_7d, i30 + i7 < 10 AS user_is_cold_start, coalesce(segment, '') AS user_interests, round(lat, 6) AS user_location_lat, city AS user_city, coalesce(user_top_categories, '') AS user_top_categories, true AS is_valid
FROM g LEFT JOIN pf ON pf.id = g.user_id LEFT JOIN top USING (user_id)""",
    "user_profile": f"""WITH {PF} SELECT id AS user_id, round(lat, 6) AS user_location_lat, round(lng, 6) AS user_location_lng, city AS user_city, CAST(gender AS INTEGER) AS user_gender, score AS user_social_score, CAST(gender AS INTEGER) AS user_onboarding_status, lower(segment) AS user_interest_ids,
  segment AS user_interest_names, 1 AS user_interests_count, CAST(age AS INTEGER) AS user_account_age_days, age < 7 AS user_is_new, gender = 2 AS user_onboarding_complete, true AS user_has_location, lat BETWEEN -90 AND 90 AND lng BETWEEN -180 AND 180 AS is_valid FROM pf""",
    "experience_profile": f"""WITH {EX} SELECT id AS experience_id, category_id AS exp_category_id, category_name AS exp_category_name, round(lat, 6) AS exp_location_lat, round(lng, 6) AS exp_location_lng, city AS exp_city, round(price, 6) AS exp_price_amount, 1 AS exp_price_currency, CAST(until AS INTEGER) AS exp_days_until_start,
  until BETWEEN 0 AND 7 AS exp_is_upcoming, until < 0 AS exp_is_past, CAST(hours AS DOUBLE) AS exp_duration_hours, CAST(seats AS INTEGER) AS exp_total_capacity, seats > 0 AS exp_has_capacity, price = 0 AS exp_is_free, {PRICE} AS exp_price_tier, CAST(age AS INTEGER) AS exp_age_days, CAST(length(name) AS INTEGER) AS exp_description_length,
  replace(name, ' ', '|') AS exp_tag_names, CAST(len(string_split(name, ' ')) AS INTEGER) AS exp_tags_count, lat BETWEEN -90 AND 90 AND lng BETWEEN -180 AND 180 AND price BETWEEN 0 AND 1000000 AS content_valid FROM ex""",
    "merged_user_features": f"""WITH {FB}, {PF}, g AS (SELECT user_id, count(*) FILTER (kind = 'IMPRESSION' AND {WEEK}) AS i, count(*) FILTER (kind = 'CLICK' AND {WEEK}) AS c FROM fb WHERE ts >= TIMESTAMP '2023-12-31' AND ts < TIMESTAMP '2024-01-31' GROUP BY user_id)
SELECT id AS user_id, city AS user_city, age < 7 AS user_is_new, c AS user_clicks_7d, round(c / CAST(i + 10 AS DOUBLE), 6) AS user_ctr_7d, i < 10 AS user_is_cold_start FROM pf LEFT JOIN g ON g.user_id = pf.id""",
    "merged_experience_features": f"""WITH {FB}, {EX}, g AS (SELECT experience_id, count(*) FILTER (kind = 'IMPRESSION') AS i, count(*) FILTER (kind = 'CLICK') AS c FROM fb WHERE {WEEK} AND ts < TIMESTAMP '2024-01-31' GROUP BY 1),
h AS (SELECT *, row_number() OVER (ORDER BY i DESC, experience_id) AS rk, count(*) OVER () AS total FROM g)
SELECT id AS experience_id, {PRICE} AS exp_price_tier, c AS exp_clicks_7d, round(c / CAST(i + 10 AS DOUBLE), 6) AS exp_ctr_7d, CASE WHEN rk IS NULL THEN NULL WHEN rk <= total * 0.1 THEN 'hot' WHEN rk <= total * 0.3 THEN 'popular' WHEN rk <= total * 0.7 THEN 'normal' ELSE 'cold' END AS exp_popularity_tier FROM ex LEFT JOIN h ON h.experience_id = ex.id""",
    "training_positives": f"WITH {FB}, {_POS} SELECT user_id, experience_id, strength AS engagement_strength, (epoch_us(ts) // 1000) AS event_timestamp, CAST(1 AS DOUBLE) AS label, 'positive' AS sample_type FROM pos",
    "training_negatives": f"WITH {FB}, {EX}, {_POS}, {_NEG} SELECT user_id, experience_id, CAST(0 AS DOUBLE) AS label FROM neg",
    "two_tower": f"""WITH {FB}, {EX}, {PF}, {_POS}, {_NEG}, both_ AS (SELECT user_id, experience_id, CAST(1 AS DOUBLE) AS label, strength, 'positive' AS kind FROM pos UNION ALL SELECT user_id, experience_id, CAST(0 AS DOUBLE), 0, 'random' FROM neg)
SELECT b.user_id, b.experience_id, label, strength AS engagement_strength, kind AS sample_type, score AS user_social_score, {PRICE.replace("price", "e.price")} AS exp_price_tier, round({KM}, 3) AS cross_distance_km, coalesce(lower(trim(u.city)) = lower(trim(e.city)), false) AS cross_same_city FROM both_ b {_WHO.format("b")}""",
    "served_exploded": f"WITH {FB}, {SERVED} SELECT request_id, position, experience_id, CAST(0.5 AS DOUBLE) AS ranking_score FROM items",
    "ranking_labels": f"WITH {FB}, {LABELS} SELECT request_id, position, experience_id, clicked, acted, dwell_ms, label FROM lab",
    "label_distribution": f"WITH {FB}, {LABELS} SELECT label, count(*) AS n FROM lab GROUP BY label",
    "ranking_context": f"""WITH {FB}, {LABELS}, {_DEVICE}
SELECT lab.request_id, position, experience_id, platform AS ctx_platform, {_HOUR} AS ctx_hour_of_day, CAST(coalesce(dayofweek(t0) + 1, 1) AS INTEGER) AS ctx_day_of_week, coalesce(dayofweek(t0) + 1, 1) IN (1, 7) AS ctx_is_weekend,
  CASE WHEN {_HOUR} < 6 THEN 'night' WHEN {_HOUR} < 12 THEN 'morning' WHEN {_HOUR} < 17 THEN 'afternoon' WHEN {_HOUR} < 21 THEN 'evening' ELSE 'night' END AS ctx_time_bucket FROM lab LEFT JOIN dc USING (request_id)""",
    "ranking_training": f"""WITH {FB}, {EX}, {PF}, {LABELS}, {_DEVICE_ENGAGED} SELECT l.request_id, l.experience_id, l.position, label, round(l.position / 50.0::DOUBLE, 3) AS position_normalized, CAST(l.position <= 3 AS INTEGER) AS is_top_3, {_HOUR} AS ctx_hour_of_day, score AS user_social_score,
  {PRICE.replace("price", "e.price")} AS exp_price_tier, round({KM}, 3) AS cross_distance_km, {BUCKET} AS cross_distance_bucket FROM lab l LEFT JOIN dc USING (request_id) {_WHO.format("l")}""",
    "pit_join": f"""WITH {FB}, c AS (SELECT * FROM fb WHERE kind = 'CLICK'), v AS (SELECT user_id, ts, max(dwell) AS dwell FROM fb WHERE kind = 'VIEW' GROUP BY ALL)
SELECT c.event_id, c.user_id, CASE WHEN v.ts >= c.ts - INTERVAL 1 DAY THEN v.dwell END AS dwell, CASE WHEN v.ts >= c.ts - INTERVAL 1 DAY THEN (epoch_us(v.ts) // 1000) END AS feature_timestamp FROM c ASOF LEFT JOIN v ON c.user_id = v.user_id AND c.ts >= v.ts""",
    "dq_null_rates": f"""WITH {FB}, a AS (SELECT count(*) AS total, count(*) FILTER (user_id IS NULL) AS u, count(*) FILTER (request_id IS NULL) AS r, count(*) FILTER (kind IS NULL) AS k FROM fb),
b AS (SELECT 'user_id' AS column_name, total, u AS nulls FROM a UNION ALL SELECT 'request_id', total, r FROM a UNION ALL SELECT 'event_type', total, k FROM a) SELECT *, round(nulls / CAST(total AS DOUBLE), 6) AS null_rate, nulls / CAST(total AS DOUBLE) <= 0.05 AS ok FROM b""",
    "dq_numeric_range": " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) AS total, round(CAST(min({c}) AS DOUBLE), 6) AS min_value, round(CAST(max({c}) AS DOUBLE), 6) AS max_value, CAST(0 AS BIGINT) AS nan_count FROM lineitem" for c in ("l_quantity", "l_extendedprice", "l_linenumber")),
    "dq_duplicates": "SELECT CAST(sum(n) AS BIGINT) AS total, count(*) AS distinct_keys, CAST(sum(n) - count(*) AS BIGINT) AS duplicates FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)",
    "dq_timestamp_validity": "SELECT count(*) AS total, count(*) FILTER (ts IS NULL) AS null_times, count(*) FILTER (ts > TIMESTAMP '2024-01-29') AS future_times, count(*) FILTER (ts < TIMESTAMP '2020-01-01') AS old_times FROM events",
    "dq_split_valid": "SELECT CAST(event_id AS VARCHAR) AS event_id, event_id % 7 <> 0 AS valid FROM events",
    "dq_flags": "SELECT p_partkey, p_retailprice BETWEEN 950 AND 1500 AND length(p_name) BETWEEN 3 AND 30 AND p_brand IN ('Brand#11', 'Brand#12', 'Brand#21', 'Brand#32') AND p_size IS NOT NULL AS is_valid FROM part",
    "dq_validity_rate": "WITH f AS (SELECT p_retailprice BETWEEN 950 AND 1500 AND length(p_name) BETWEEN 3 AND 30 AND p_brand IN ('Brand#11', 'Brand#12', 'Brand#21', 'Brand#32') AND p_size IS NOT NULL AS ok FROM part) SELECT count(*) AS total, count(*) FILTER (ok) AS valid, round(count(*) FILTER (ok) / CAST(count(*) AS DOUBLE), 6) AS validity_rate FROM f",
    "dq_skew": "WITH g AS (SELECT count(*) AS n FROM events GROUP BY user_id) SELECT count(*) AS keys, max(n) AS max_rows, min(n) AS min_rows, round(avg(n), 6) AS avg_rows, round(max(n) / CAST(min(n) AS DOUBLE), 6) AS skew, max(n) / CAST(min(n) AS DOUBLE) <= 100 AS ok FROM g",
    "dq_freshness": "WITH m AS (SELECT floor((epoch_us(TIMESTAMP '2024-01-31') - epoch_us(max(ts))) / 1000000.0::DOUBLE) / 3600.0::DOUBLE AS age FROM events) SELECT round(age, 6) AS age_hours, age <= 24 AS fresh FROM m",
    "dq_input_report": f"WITH {FB} SELECT count(*) AS total, count(*) FILTER (user_id IS NULL) AS null_user_id, count(*) FILTER (request_id IS NULL) AS null_request_id, count(*) FILTER (ts IS NULL OR ts > TIMESTAMP '2024-01-31' OR ts < TIMESTAMP '2020-01-01') AS bad_times, CAST(0 AS BIGINT) AS bad_ids FROM fb",
    "dq_output": "SELECT DISTINCT l_orderkey, (epoch_us(l_shipdate) // 1000) AS event_timestamp FROM lineitem WHERE l_orderkey IS NOT NULL",
    "event_validator": "SELECT CASE WHEN event_id % 11 = 0 THEN 'malformed' WHEN event_id % 13 = 0 THEN 'null_values' WHEN event_id % 17 = 0 THEN 'missing_fields' WHEN event_id % 19 = 0 THEN 'invalid_latitude' WHEN event_id % 23 = 0 THEN 'invalid_longitude' WHEN event_id % 29 = 0 THEN 'empty_event' WHEN event_id % 31 = 0 THEN 'type_error' WHEN event_id % 37 = 0 THEN 'invalid_timestamp' WHEN event_id % 41 = 0 THEN 'null value' END AS error_type, count(*) AS n FROM events GROUP BY 1",
    "message_dedup": f"SELECT {_DEDUP} AS message_id, event_id AS \"offset\" FROM events",
    "schema_union": f"WITH {FB} SELECT event_id, user_id, NULL AS category_name FROM fb UNION ALL SELECT CAST(p_partkey AS VARCHAR), NULL, p_type FROM part",
    "lake_roundtrip": f"WITH {FB} SELECT event_id, user_id, experience_id, 'EVENT_TYPE_' || kind AS event_type, (epoch_us(ts) // 1000) AS event_timestamp FROM fb WHERE {WEEK} AND ts < TIMESTAMP '2024-01-31'",
    "partition_listing": "SELECT DISTINCT 'recommendation_feedback_v1' AS partition_event_type, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day FROM events",
    "latest_partition": f"WITH {FB} SELECT event_id, user_id, (epoch_us(ts) // 1000) AS event_timestamp FROM fb WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM fb)",
    "stream_tumbling_features": f"""WITH {FB}, {SEG} SELECT user_id, CAST(count(*) AS INTEGER) AS activity_count, CAST(count(DISTINCT raw_type) AS INTEGER) AS unique_event_types, arg_max(raw_type, (ms, raw_type)) AS last_event_type,
  round(least(sum(CASE raw_type WHEN 'view' THEN 1.0 WHEN 'click' THEN 2.0 ELSE 0.5 END) / (5 * count(*)), 1.0), 4) AS engagement_score, day FROM seg GROUP BY user_id, day""",
    "stream_session_features": f"""WITH {FB}, {SEG}, a AS (SELECT *, lag(ms) OVER (PARTITION BY user_id ORDER BY ms) AS p FROM seg), b AS (SELECT *, sum(CASE WHEN p IS NULL OR ms - p >= 21600000 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ms) AS n FROM a)
SELECT user_id, CAST(count(*) AS INTEGER) AS activity_count, strftime(min(ts), '%Y%m%d%H%M%S') AS began, round((max(ms) - min(ms)) / 1000.0::DOUBLE, 3) AS session_duration_seconds FROM b GROUP BY user_id, n""",
    "stream_realtime_user": f"""WITH {FB}, {SEG}, o AS (SELECT *, 'cat' || CAST(k % 7 AS VARCHAR) AS cat, 't' || CAST(k % 13 AS VARCHAR) AS tag, CAST(k AS VARCHAR) AS item, row_number() OVER (PARTITION BY user_id, day ORDER BY ms, raw_type, eid) AS rn FROM seg),
{_last("cat", 5, "recent_categories_viewed")}, {_last("tag", 10, "recent_tags_interacted")}, {_last("item", 50, "user_viewed_experiences")},
focus AS (SELECT user_id, day, cat AS session_category_focus FROM o GROUP BY user_id, day, cat QUALIFY row_number() OVER (PARTITION BY user_id, day ORDER BY count(*) DESC, min(rn)) = 1)
SELECT * FROM recent_categories_viewed JOIN recent_tags_interacted USING (user_id, day) JOIN user_viewed_experiences USING (user_id, day) JOIN focus USING (user_id, day)""",
    "experience_features": f"""WITH {FB}, {EX}, a AS (SELECT *, eid % 5 AS m FROM fb WHERE {WEEK} AND ts < TIMESTAMP '2024-01-31')
SELECT a.experience_id, count(*) FILTER (m = 0) AS exp_views_7d, count(*) FILTER (m IN (3, 4)) AS exp_actions_7d, round(avg(CASE m WHEN 0 THEN 0.2 WHEN 1 THEN 0.4 WHEN 2 THEN 0.6 WHEN 3 THEN 0.8 ELSE 1.0 END), 6) AS exp_avg_engagement_7d, any_value(e.city) AS exp_city,
  any_value({PRICE.replace("price", "e.price")}) AS exp_price_tier, true AS is_valid, (epoch_us(TIMESTAMP '2024-01-30') // 1000) AS event_timestamp FROM a LEFT JOIN ex e ON e.id = a.experience_id GROUP BY a.experience_id""",
    "message_routing": """SELECT 'experience.events' AS topic, CAST(p_partkey AS BIGINT) AS "offset", 'experience' AS kind, CASE WHEN p_partkey % 17 = 0 THEN 'missing experience_id/id in experience' END AS error_reason, CAST(CASE WHEN p_partkey % 17 = 0 THEN 8 ELSE 9 END AS INTEGER) AS n_fields FROM part
UNION ALL SELECT 'user.profile.events', c_custkey, 'profile', NULL, CASE WHEN c_custkey % 7 = 0 THEN 0 ELSE 1 END FROM customer
UNION ALL SELECT 'location.streams', event_id, 'all', CASE WHEN event_id % 25 = 0 THEN 'missing latitude/longitude in location' WHEN event_id % 110 > 90 THEN 'invalid latitude or longitude' END, CASE WHEN event_id % 25 = 0 THEN 2 ELSE 3 END FROM events WHERE event_id % 5 = 0
UNION ALL SELECT 'recommendation.feedback.v1', event_id, 'all', CASE WHEN event_id % 7 = 1 THEN 'missing user_id in feedback' WHEN event_id % 11 = 0 THEN 'missing event_id in feedback' END, CASE WHEN event_id % 11 = 0 THEN 3 ELSE 4 END FROM events WHERE event_id % 5 <> 0""",
    "message_payloads": f"""WITH {EX} SELECT id, name, round(price, 6) AS price_amount, city AS event_location_city, round(lat, 6) AS event_location_latitude, category_id, category_name, replace(name, ' ', '|') AS tags, CAST(NULL AS VARCHAR) AS description
FROM ex WHERE CAST(id AS BIGINT) % 17 <> 0 AND CAST(id AS BIGINT) % 3 <> 0""",
    "message_feedback": "SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id, CAST(event_id AS VARCHAR) AS experience_id, CAST(event_id % 9 AS BIGINT) AS view_data_dwell_time_ms FROM events WHERE event_id % 5 <> 0 AND event_id % 7 <> 1 AND event_id % 11 <> 0",
    "mixed_rows": f"WITH {PF}, {EX} SELECT id, CAST(score AS VARCHAR) AS said FROM pf UNION ALL SELECT id, category_name FROM ex",
    "top_elements": f"""WITH {FB}, n AS (SELECT user_id, 'EVENT_TYPE_' || kind AS t, count(*) AS c, min(eid) AS f FROM fb GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY c DESC, f) AS rn FROM n)
SELECT user_id, string_agg(t, '|' ORDER BY rn) AS top_types FROM r WHERE rn <= 2 GROUP BY user_id""",
    "online_upsert_diff": f"WITH {PF} SELECT 'u:' || id AS key, city, CAST(score AS VARCHAR) AS score FROM pf WHERE CAST(id AS BIGINT) % 5 = 0 AND score IS DISTINCT FROM -1",
    "position_features": f"WITH {FB} SELECT event_id, position, round(position / 50.0::DOUBLE, 6) AS position_normalized, CAST(position <= 3 AS INTEGER) AS is_top_3, CAST(position <= 10 AS INTEGER) AS is_top_10, CAST(position <= 20 AS INTEGER) AS is_top_20, position <= 10 AS is_first_page, CASE WHEN position <= 3 THEN 'top_3' WHEN position <= 10 THEN 'top_10' WHEN position <= 20 THEN 'top_20' ELSE 'below_20' END AS position_bucket FROM fb",
    "cross_features": f"WITH {FB}, {EX}, {PF}, d AS (SELECT DISTINCT user_id, experience_id FROM fb) SELECT d.user_id, d.experience_id, round({KM}, 3) AS cross_distance_km, {BUCKET} AS cross_distance_bucket, coalesce(lower(trim(u.city)) = lower(trim(e.city)), false) AS cross_same_city FROM d {_WHO.format('d')}",
}
