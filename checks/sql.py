"""The registered queries in DuckDB SQL, over the same tables.

Written from the definitions; of the library's values they take the cue words and the names of the
review categories. Each text names the common table expressions it needs, and `text` puts those (and
what they need) in front.
"""

from __future__ import annotations

import re

from checks.frames import AS_OF, BRAND, CATEGORY_SHIFT, EARLIER_RUN
from ordermill.operators.quality import REVIEW_CATEGORIES


def r(x: str, n: int) -> str:
    """Half-up rounding through a decimal."""
    return f"CAST(round(CAST(({x}) AS DECIMAL(28,10)), {n}) AS DOUBLE)"


def cents(total: str, count: str) -> str:
    return r(f"CAST({total} AS DOUBLE) / nullif({count}, 0)", 2)


def share(predicate: str) -> str:
    return r(f"avg(CASE WHEN {predicate} THEN 1.0 ELSE 0.0 END)", 4)


def points(c: str, unlisted: str) -> str:
    return f"CASE {c} WHEN 'minor' THEN 1.0 WHEN 'moderate' THEN 2.0 WHEN 'severe' THEN 3.0 ELSE {unlisted} END"


def severity(shift: int) -> str:
    return f"CASE (doc_id + {shift}) % 4 WHEN 0 THEN 'none' WHEN 1 THEN 'minor' WHEN 2 THEN 'moderate' ELSE 'severe' END"


SHORT = {c: "portion" if c == "portion_size" else c for c in REVIEW_CATEGORIES}

CTES: dict[str, str] = {}

CTES["fx_venue"] = f"""
SELECT 'V' || n_nationkey AS restaurant_id, '{BRAND} - ' || n_name AS name, r_name AS city, 'Earth' AS country,
       'Street ' || n_nationkey AS address, CAST(DATE '1994-01-01' + CAST(n_nationkey * 30 AS INTEGER) AS DATE) AS opening_date,
       '+' || n_nationkey AS phone
FROM nation JOIN region ON n_regionkey = r_regionkey"""

CTES["fx_order_venue"] = """
SELECT l.l_orderkey, l.item_count, 'V' || s.s_nationkey AS restaurant_id
FROM (SELECT l_orderkey, min(l_suppkey) AS l_suppkey, count(*) AS item_count FROM lineitem GROUP BY l_orderkey) l
JOIN supplier s ON l.l_suppkey = s.s_suppkey"""

CTES["fx_order"] = """
SELECT o_orderkey, 'O' || o_orderkey AS order_id, o_orderdate + to_seconds(o_orderkey * 7919 % 86400) AS order_timestamp,
       restaurant_id, 'C' || o_custkey AS customer_id,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'delivery' WHEN '2-HIGH' THEN 'delivery'
            WHEN '3-MEDIUM' THEN 'takeaway' ELSE 'dine_in' END AS order_type,
       item_count, CAST(o_totalprice AS DECIMAL(10,2)) AS total_amount,
       CASE o_orderkey % 3 WHEN 0 THEN 'cash' WHEN 1 THEN 'card' ELSE 'wallet' END AS payment_method,
       CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'P' THEN 'delivered' ELSE 'pending' END AS order_status
FROM orders LEFT JOIN fx_order_venue ON o_orderkey = l_orderkey"""

CTES["fx_fact_orders"] = """
SELECT *, CAST(order_timestamp AS DATE) AS order_date, hour(order_timestamp) AS order_hour,
       dayname(order_timestamp) AS day_of_week, dayname(order_timestamp) = 'Friday' AS is_weekend
FROM fx_order WHERE restaurant_id IS NOT NULL AND total_amount > 0"""

CTES["fx_valid"] = "SELECT * FROM fx_fact_orders WHERE order_status IN ('completed', 'delivered')"

CTES["fx_unified"] = """
SELECT * REPLACE (CASE WHEN o_orderkey % 10 < 8 THEN order_status ELSE 'pending' END AS order_status),
       CASE WHEN o_orderkey % 10 < 8 THEN 'historical_batch' ELSE 'streaming_kafka' END AS source_system
FROM fx_order"""

CTES["fx_lines"] = """
SELECT l_orderkey, l_partkey, 'P' || l_partkey AS item_id, p_name AS item_name, CAST(l_quantity AS INTEGER) AS quantity,
       CAST(CAST(floor(l_extendedprice * 100 / l_quantity) AS DECIMAL(18,0)) * 0.01 AS DECIMAL(10,2)) AS unit_price,
       CAST(l_extendedprice AS DECIMAL(10,2)) AS subtotal
FROM lineitem JOIN part ON l_partkey = p_partkey"""

CTES["fx_items"] = """
SELECT order_id, item_id, restaurant_id, order_timestamp, CAST(order_timestamp AS DATE) AS order_date,
       item_name, quantity, unit_price, subtotal
FROM fx_lines JOIN fx_order ON l_orderkey = o_orderkey WHERE restaurant_id IS NOT NULL"""

CTES["fx_line_list"] = """
SELECT l_orderkey, array_to_string(list_sort(list(concat_ws(':', item_id, item_name, quantity, unit_price, subtotal))), ',') AS lines
FROM fx_lines GROUP BY l_orderkey"""

CTES["fx_menu_whole"] = """
SELECT restaurant_id, 'P' || p_partkey AS item_id, p_name AS name, p_type AS category,
       CAST(p_retailprice AS DECIMAL(10,2)) AS price, p_brand AS ingredients, p_size % 2 = 0 AS is_vegetarian
FROM (SELECT DISTINCT restaurant_id, l_partkey FROM lineitem JOIN fx_order_venue USING (l_orderkey))
JOIN part ON l_partkey = p_partkey"""

CTES["fx_menu"] = """
SELECT restaurant_id, 'P' || p_partkey AS item_id, p_name AS name, p_type AS category,
       CAST(p_retailprice AS DECIMAL(10,2)) AS price, p_brand AS ingredients, p_size % 2 = 0 AS is_vegetarian
FROM (SELECT DISTINCT restaurant_id, l_partkey FROM lineitem JOIN fx_order_venue USING (l_orderkey)
      WHERE l_partkey % 10 <> 0) JOIN part ON l_partkey = p_partkey"""

CTES["fx_review_base"] = """
SELECT doc_id, 'R' || doc_id AS review_id, order_id, customer_id, restaurant_id, 1 + n_chars % 5 AS rating,
       text, order_timestamp + to_days(CAST(1 + doc_id % 7 AS INTEGER)) AS review_timestamp
FROM documents JOIN fx_order ON doc_id = o_orderkey"""

CTES["fx_review"] = f"""
SELECT b.*,
       CASE WHEN toxic = 1 OR quality = 0 THEN 'negative' WHEN quality = 1 THEN 'positive' ELSE 'neutral' END AS sentiment,
       {', '.join(f"(b.doc_id + {k}) % 4 <> 0 AS issue_{c}, {severity(k).replace('doc_id', 'b.doc_id')} AS {c}_severity"
                  for c, k in CATEGORY_SHIFT.items())}
FROM fx_review_base b LEFT JOIN labels l ON b.doc_id = l.doc_id"""

CTES["fx_pairs"] = f"""
SELECT *, {r('CAST(order_count AS DOUBLE) / customer_total_orders', 4)} AS order_share FROM (
  SELECT customer_id, restaurant_id, count(DISTINCT order_id) AS order_count, sum(total_amount) AS total_spend,
         min(order_timestamp) AS first_order_timestamp, max(order_timestamp) AS last_order_timestamp
  FROM fx_valid GROUP BY customer_id, restaurant_id)
JOIN (SELECT customer_id, count(DISTINCT order_id) AS customer_total_orders FROM fx_valid GROUP BY customer_id)
USING (customer_id)"""

CTES["fx_pair_reviews"] = f"""
SELECT customer_id, restaurant_id, count(DISTINCT review_id) AS review_count, {r('avg(rating)', 2)} AS avg_rating,
       {share("sentiment = 'positive'")} AS positive_ratio, {share("sentiment = 'negative'")} AS negative_ratio,
       {', '.join(r(f"avg({points(c + '_severity', '0.0')})", 4) + f' AS avg_{SHORT[c]}_severity' for c in REVIEW_CATEGORIES)}
FROM fx_review GROUP BY customer_id, restaurant_id"""


def _shrunk(x: str, trust: str) -> str:
    return f"coalesce({trust} * ({x}) + (1 - {trust}) * 0.5, 0.5)"


CTES["fx_scored"] = f"""
SELECT *, {r('0.40 * order_share + 0.20 * recency_score + 0.40 * experience_score', 4)} AS preference_score FROM (
  SELECT *, {r('0.50 * rating_score + 0.20 * sentiment_score + 0.15 * food_quality_score + 0.10 * pricing_score'
               ' + 0.05 * portion_score', 4)} AS experience_score FROM (
    SELECT *, exp(-days_since_last_order / 90.0::DOUBLE) AS recency_score,
           {_shrunk('(avg_rating - 1.0::DOUBLE) / 4.0', 'trust')} AS rating_score,
           ((positive_ratio - negative_ratio) + 1.0) / 2.0 AS sentiment_score,
           {', '.join(_shrunk(f'1.0::DOUBLE - avg_{c}_severity / 3.0', 'trust') + f' AS {c}_score'
                      for c in ('food_quality', 'pricing', 'portion'))}
    FROM (
      SELECT p.*, date_diff('day', CAST(last_order_timestamp AS DATE), DATE '{AS_OF}') AS days_since_last_order,
             coalesce(v.review_count, 0) AS review_count, avg_rating,
             coalesce(positive_ratio, 0.0) AS positive_ratio, coalesce(negative_ratio, 0.0) AS negative_ratio,
             {', '.join(f'avg_{SHORT[c]}_severity' for c in REVIEW_CATEGORIES)},
             CAST(coalesce(v.review_count, 0) AS DOUBLE) / (coalesce(v.review_count, 0) + 3.0) AS trust,
             order_count >= 2 AS is_eligible
      FROM fx_pairs p LEFT JOIN fx_pair_reviews v
        ON p.customer_id = v.customer_id AND p.restaurant_id = v.restaurant_id)))"""

CTES["fx_preference"] = """
SELECT *, CASE WHEN eligible_restaurant_count = 0 THEN 'insufficient_data' WHEN preference_rank = 1 THEN 'preferred'
               WHEN is_eligible THEN 'candidate' ELSE 'not_eligible' END AS preference_status
FROM (SELECT *, CAST(sum(CASE WHEN is_eligible THEN 1 ELSE 0 END) OVER (PARTITION BY customer_id) AS BIGINT)
                  AS eligible_restaurant_count,
             CASE WHEN is_eligible THEN row_number() OVER (PARTITION BY customer_id
               ORDER BY CAST(is_eligible AS INTEGER) DESC, preference_score DESC, order_count DESC, total_spend DESC,
                        restaurant_id) END AS preference_rank
      FROM fx_scored)"""

CTES["fx_preferred"] = """
SELECT customer_id, p.restaurant_id AS preferred_restaurant_id, name AS preferred_restaurant_name,
       preference_score, order_share
FROM fx_preference p LEFT JOIN fx_venue v ON p.restaurant_id = v.restaurant_id WHERE preference_rank = 1"""

CTES["fx_customer_360"] = f"""
SELECT c.customer_id, coalesce(total_orders, 0) AS total_orders, coalesce(lifetime_spend, 0) AS lifetime_spend,
       avg_order_value, last_order_date, avg_order_hour, weekend_order_ratio, days_since_last_order,
       coalesce(loyalty_segment, 'No Orders Yet') AS loyalty_segment,
       coalesce(total_reviews_given, 0) AS total_reviews_given, avg_rating_given,
       {', '.join(f'coalesce({x}, 0.0) AS {x}' for x in ('positive_review_ratio', 'negative_review_ratio',
                  'food_quality_issue_ratio', 'pricing_issue_ratio', 'portion_issue_ratio'))},
       preferred_restaurant_id, preferred_restaurant_name, preference_score, order_share,
       CASE WHEN preferred_restaurant_id IS NOT NULL THEN 'has_preference'
            WHEN coalesce(total_orders, 0) = 0 THEN 'no_orders_yet' ELSE 'insufficient_data' END AS customer_preference_status,
       CASE WHEN days_since_last_order <= 30 THEN 'active' WHEN days_since_last_order <= 90 THEN 'at_risk'
            WHEN days_since_last_order > 90 THEN 'churned' ELSE 'no_orders_yet' END AS customer_activity_status
FROM (SELECT 'C' || c_custkey AS customer_id FROM customer) c
LEFT JOIN (
  SELECT *, date_diff('day', last_order_date, DATE '{AS_OF}') AS days_since_last_order,
         CASE WHEN lifetime_spend >= 3000000 THEN 'Platinum' WHEN lifetime_spend >= 2000000 THEN 'Gold'
              WHEN lifetime_spend >= 1000000 THEN 'Silver' ELSE 'Bronze' END AS loyalty_segment
  FROM (SELECT customer_id, count(DISTINCT order_id) AS total_orders, sum(total_amount) AS lifetime_spend,
               {cents('sum(total_amount)', 'count(total_amount)')} AS avg_order_value, max(order_date) AS last_order_date,
               {r('avg(order_hour)', 1)} AS avg_order_hour, {share('is_weekend')} AS weekend_order_ratio
        FROM fx_valid GROUP BY customer_id)) o ON c.customer_id = o.customer_id
LEFT JOIN (
  SELECT customer_id, count(DISTINCT review_id) AS total_reviews_given, {r('avg(rating)', 2)} AS avg_rating_given,
         {share("sentiment = 'positive'")} AS positive_review_ratio, {share("sentiment = 'negative'")} AS negative_review_ratio,
         {', '.join(share(f'issue_{c}') + f' AS {SHORT[c]}_issue_ratio' for c in ('food_quality', 'pricing', 'portion_size'))}
  FROM fx_review GROUP BY customer_id) v ON c.customer_id = v.customer_id
LEFT JOIN fx_preferred p ON c.customer_id = p.customer_id"""

CTES["fx_repeat"] = f"""
SELECT restaurant_id, count(DISTINCT customer_id) AS unique_customers,
       count(DISTINCT CASE WHEN n >= 2 THEN customer_id END) AS repeat_customers,
       {r("CAST(count(DISTINCT CASE WHEN n >= 2 THEN customer_id END) AS DOUBLE) / count(DISTINCT customer_id)", 4)}
         AS repeat_customer_rate
FROM (SELECT restaurant_id, customer_id, count(DISTINCT order_id) AS n FROM fx_valid GROUP BY restaurant_id, customer_id)
GROUP BY restaurant_id"""

CTES["fx_venue_360"] = f"""
SELECT *, {r('0.35 * rating_score + 0.25 * repeat_customer_rate + 0.20 * positive_ratio + 0.20 * quality_score', 4)}
            AS restaurant_health_score
FROM (SELECT *, {_shrunk('(avg_rating - 1) / 4', 'review_confidence')} AS rating_score,
             {_shrunk('1 - avg_food_quality_severity / 3', 'review_confidence')} AS quality_score
      FROM (
  SELECT v.restaurant_id, v.name AS restaurant_name, v.city, coalesce(total_orders, 0) AS total_orders,
         coalesce(total_revenue, 0) AS total_revenue, avg_order_value, last_order_date, days_since_last_order,
         coalesce(unique_customers, 0) AS unique_customers, coalesce(repeat_customers, 0) AS repeat_customers,
         coalesce(repeat_customer_rate, 0.0) AS repeat_customer_rate,
         coalesce(delivery_order_count, 0) AS delivery_order_count, coalesce(delivery_revenue, 0) AS delivery_revenue,
         coalesce(total_reviews, 0) AS total_reviews, avg_rating, coalesce(positive_ratio, 0.0) AS positive_ratio,
         coalesce(negative_ratio, 0.0) AS negative_ratio,
         {', '.join(f'coalesce({s}_complaint_count, 0) AS {s}_complaint_count, avg_{s}_severity' for s in SHORT.values())},
         coalesce({r('CAST(total_reviews AS DOUBLE) / (total_reviews + 10)', 4)}, 0.0) AS review_confidence,
         {r('CAST(coalesce(total_orders, 0) AS DOUBLE) / nullif(unique_customers, 0)', 2)} AS avg_orders_per_customer,
         coalesce({r('CAST(coalesce(delivery_order_count, 0) AS DOUBLE) / nullif(total_orders, 0)', 4)}, 0.0)
           AS delivery_order_ratio
  FROM fx_venue v
  LEFT JOIN (SELECT restaurant_id, count(DISTINCT order_id) AS total_orders, sum(total_amount) AS total_revenue,
                    {cents('sum(total_amount)', 'count(total_amount)')} AS avg_order_value,
                    max(order_date) AS last_order_date, date_diff('day', max(order_date), DATE '{AS_OF}') AS days_since_last_order
             FROM fx_valid GROUP BY restaurant_id) o ON v.restaurant_id = o.restaurant_id
  LEFT JOIN fx_repeat f ON v.restaurant_id = f.restaurant_id
  LEFT JOIN (SELECT restaurant_id, count(DISTINCT order_id) AS delivery_order_count, sum(total_amount) AS delivery_revenue
             FROM fx_valid WHERE order_type = 'delivery' GROUP BY restaurant_id) d ON v.restaurant_id = d.restaurant_id
  LEFT JOIN (SELECT restaurant_id, count(DISTINCT review_id) AS total_reviews, {r('avg(rating)', 2)} AS avg_rating,
                    {share("sentiment = 'positive'")} AS positive_ratio, {share("sentiment = 'negative'")} AS negative_ratio,
                    {', '.join(f"count(DISTINCT CASE WHEN issue_{c} THEN review_id END) AS {s}_complaint_count, "
                               + r(f"avg({points(c + '_severity', 'NULL')})", 2) + f" AS avg_{s}_severity"
                               for c, s in SHORT.items())}
             FROM fx_review GROUP BY restaurant_id) w ON v.restaurant_id = w.restaurant_id))"""

CTES["fx_summary"] = """
SELECT order_date, count(order_id) AS total_orders, sum(total_amount) AS total_revenue,
       count(DISTINCT restaurant_id) AS unique_restaurants,
       count(CASE WHEN order_type = 'dine_in' THEN order_id END) AS dine_in_orders,
       count(CASE WHEN order_type = 'takeaway' THEN order_id END) AS takeaway_orders,
       count(CASE WHEN order_type = 'delivery' THEN order_id END) AS delivery_orders
FROM fx_valid GROUP BY order_date"""

CTES["fx_venue_reviews"] = f"""
SELECT v.restaurant_id, v.name, v.city, coalesce(total_reviews, 0) AS total_reviews, coalesce(avg_rating, 0.0) AS avg_rating,
       {', '.join(f'coalesce(s{n}, 0) AS rating_{n}_stars' for n in range(1, 6))},
       {', '.join(f'coalesce({m}, 0) AS sentiment_{m}_review' for m in ('positive', 'negative', 'neutral'))}
FROM fx_venue v LEFT JOIN (
  SELECT restaurant_id, count(DISTINCT review_id) AS total_reviews, {r('avg(rating)', 2)} AS avg_rating,
         {', '.join(f'count(CASE WHEN rating = {n} THEN 1 END) AS s{n}' for n in range(1, 6))},
         {', '.join(f"count(CASE WHEN sentiment = '{m}' THEN 1 END) AS {m}" for m in ('positive', 'negative', 'neutral'))}
  FROM fx_review GROUP BY restaurant_id) w ON v.restaurant_id = w.restaurant_id"""

CTES["fx_popularity"] = f"""
SELECT d.*, m.name AS item_name, category, is_vegetarian
FROM (SELECT o.order_date, restaurant_id, item_id, count(DISTINCT order_id) AS order_count, sum(quantity) AS total_quantity_sold,
             sum(subtotal) AS total_revenue, {cents('sum(unit_price)', 'count(unit_price)')} AS avg_unit_price
      FROM (SELECT order_id, restaurant_id, item_id, quantity, subtotal, unit_price FROM fx_items) i
      JOIN (SELECT order_id, restaurant_id, order_date FROM fx_valid) o USING (order_id, restaurant_id)
      GROUP BY o.order_date, restaurant_id, item_id) d
JOIN fx_menu m USING (restaurant_id, item_id)"""

CTES["fx_performance"] = f"""
SELECT c.restaurant_id, c.activity_date, dayname(c.activity_date) AS day_of_week,
       dayname(c.activity_date) = 'Friday' AS is_weekend, coalesce(daily_orders, 0) AS daily_orders,
       coalesce(daily_revenue, 0) AS daily_revenue, coalesce(daily_unique_customers, 0) AS daily_unique_customers,
       avg_order_value, coalesce(delivery_orders, 0) AS delivery_orders, coalesce(delivery_revenue, 0) AS delivery_revenue,
       coalesce(daily_reviews, 0) AS daily_reviews, daily_avg_rating, daily_positive_ratio, daily_negative_ratio,
       v.city AS restaurant_city, date_diff('day', v.opening_date, c.activity_date) AS restaurant_age_days
FROM (SELECT restaurant_id, CAST(unnest(generate_series(first_day, DATE '{AS_OF}', INTERVAL 1 DAY)) AS DATE) AS activity_date
      FROM (SELECT restaurant_id, min(order_date) AS first_day FROM fx_valid GROUP BY restaurant_id)) c
LEFT JOIN (SELECT restaurant_id, order_date AS activity_date, count(DISTINCT order_id) AS daily_orders,
                  sum(total_amount) AS daily_revenue, count(DISTINCT customer_id) AS daily_unique_customers,
                  {cents('sum(total_amount)', 'count(total_amount)')} AS avg_order_value,
                  count(DISTINCT CASE WHEN order_type = 'delivery' THEN order_id END) AS delivery_orders,
                  sum(CASE WHEN order_type = 'delivery' THEN total_amount END) AS delivery_revenue
           FROM fx_valid GROUP BY restaurant_id, order_date) s
  ON c.restaurant_id = s.restaurant_id AND c.activity_date = s.activity_date
LEFT JOIN (SELECT restaurant_id, CAST(review_timestamp AS DATE) AS activity_date, count(DISTINCT review_id) AS daily_reviews,
                  {r('avg(rating)', 2)} AS daily_avg_rating, {share("sentiment = 'positive'")} AS daily_positive_ratio,
                  {share("sentiment = 'negative'")} AS daily_negative_ratio
           FROM fx_review GROUP BY restaurant_id, CAST(review_timestamp AS DATE)) w
  ON c.restaurant_id = w.restaurant_id AND c.activity_date = w.activity_date
LEFT JOIN fx_venue v ON c.restaurant_id = v.restaurant_id"""


def _series(source: str) -> str:
    """Gap-free daily series with positions: i from 1 up, back from 0 (the last day) up."""
    return f"""
SELECT b.restaurant_id, b.d, coalesce(v, 0.0) AS v, count(*) OVER (PARTITION BY b.restaurant_id) AS n,
       row_number() OVER (PARTITION BY b.restaurant_id ORDER BY b.d) AS i,
       row_number() OVER (PARTITION BY b.restaurant_id ORDER BY b.d DESC) - 1 AS back
FROM (SELECT restaurant_id, CAST(unnest(generate_series(min(d), max(d), INTERVAL 1 DAY)) AS DATE) AS d
      FROM ({source}) GROUP BY restaurant_id) b
LEFT JOIN (SELECT restaurant_id, d, CAST(sum(v) AS DOUBLE) AS v FROM ({source}) GROUP BY restaurant_id, d) s
  ON b.restaurant_id = s.restaurant_id AND b.d = s.d"""


def _sales_until(day: str) -> str:
    return (
        "SELECT restaurant_id, order_date AS d, total_amount AS v FROM fx_valid "
        f"WHERE order_date <= DATE '{day}'"
    )


CTES["s_now"] = _series(_sales_until(AS_OF))
CTES["s_earlier"] = _series(_sales_until(EARLIER_RUN))
CTES["s_events"] = _series("SELECT event_type AS restaurant_id, CAST(ts AS DATE) AS d, value AS v FROM events")

CTES["ar_logs"] = "SELECT restaurant_id, i, ln(1 + v) AS x FROM s_now WHERE n >= 90"
CTES["ar_tested"] = """
SELECT restaurant_id, t, coalesce(t >= -2.86154 - 2.8903 / m - 4.234 / (m * m) - 40.040 / (m * m * m), FALSE) AS differenced
FROM (SELECT restaurant_id, count(*)::DOUBLE AS m, CASE WHEN regr_syy(d, l) - regr_slope(d, l) * regr_sxy(d, l) > 0
             THEN regr_slope(d, l) / sqrt((regr_syy(d, l) - regr_slope(d, l) * regr_sxy(d, l)) / (count(*) - 2) / regr_sxx(d, l)) END AS t
      FROM (SELECT restaurant_id, lag(x) OVER w AS l, x - lag(x) OVER w AS d FROM ar_logs
            WINDOW w AS (PARTITION BY restaurant_id ORDER BY i))
      WHERE l IS NOT NULL GROUP BY restaurant_id)"""
CTES["ar_centred"] = """
SELECT restaurant_id, i, z - avg(z) OVER (PARTITION BY restaurant_id) AS c
FROM (SELECT restaurant_id, i, CASE WHEN differenced THEN x - lag(x) OVER (PARTITION BY restaurant_id ORDER BY i) ELSE x END AS z
      FROM ar_logs JOIN ar_tested USING (restaurant_id))
WHERE z IS NOT NULL"""
CTES["ar_covariances"] = """
SELECT restaurant_id, count(*) AS m, sum(c * c) / count(*) AS r0, sum(c * c1) / count(*) AS r1,
       sum(c * c2) / count(*) AS r2, sum(c * c3) / count(*) AS r3
FROM (SELECT *, lag(c, 1) OVER w AS c1, lag(c, 2) OVER w AS c2, lag(c, 3) OVER w AS c3 FROM ar_centred
      WINDOW w AS (PARTITION BY restaurant_id ORDER BY i))
GROUP BY restaurant_id"""
# The normal equations of order 1 to 3 by hand: partial correlations, coefficients, variances.
CTES["ar_first"] = "SELECT *, r1 / r0 AS k1, r0 * (1 - (r1 / r0) ** 2) AS v1 FROM ar_covariances"
CTES["ar_second"] = "SELECT *, (r2 - k1 * r1) / v1 AS k2, k1 - (r2 - k1 * r1) / v1 * k1 AS a1, v1 * (1 - ((r2 - k1 * r1) / v1) ** 2) AS v2 FROM ar_first"
CTES["ar_third"] = "SELECT *, (r3 - a1 * r2 - k2 * r1) / v2 AS k3, v2 * (1 - ((r3 - a1 * r2 - k2 * r1) / v2) ** 2) AS v3 FROM ar_second"
CTES["ar_orders"] = " UNION ALL ".join(
    f"SELECT restaurant_id, {p} AS p, m * ln({v}) + 2.0 * {p + 1} + 2.0 * {p + 1} * {p + 2} / (m - {p + 1} - 1) AS aicc, "
    f"{', '.join(f'{x} AS phi_{k + 1}' for k, x in enumerate(phi))} FROM ar_third"
    for p, v, phi in (
        (0, "r0", ("NULL", "NULL", "NULL")),
        (1, "v1", ("k1", "NULL", "NULL")),
        (2, "v2", ("a1", "k2", "NULL")),
        (3, "v3", ("a1 - k3 * k2", "k2 - k3 * a1", "k3")),
    )
)

for _tag in ("now", "earlier"):
    _s = f"s_{_tag}"
    CTES[f"lagged_{_tag}"] = f"""
SELECT *, ln(1 + v) AS x,
       {', '.join(f'lag(ln(1 + v), {k}) OVER (PARTITION BY restaurant_id ORDER BY d) AS x{k}' for k in (7, 14))},
       {', '.join(f'lag(v, {k}) OVER (PARTITION BY restaurant_id ORDER BY d) AS v{k}' for k in range(7, 36, 7))}
FROM {_s} WHERE n >= 90"""
    CTES[f"lines_{_tag}"] = f"""
SELECT restaurant_id, b, y - b * z AS a, held_b, held_y - held_b * held_z AS held_a
FROM (SELECT restaurant_id, avg(x) AS y, avg(x7) AS z, CASE WHEN var_pop(x7) > 0 THEN regr_slope(x, x7) ELSE 0 END AS b,
             avg(CASE WHEN back >= 14 THEN x END) AS held_y, avg(CASE WHEN back >= 14 THEN x7 END) AS held_z,
             CASE WHEN var_pop(CASE WHEN back >= 14 THEN x7 END) > 0
                  THEN regr_slope(CASE WHEN back >= 14 THEN x END, x7) ELSE 0 END AS held_b
      FROM lagged_{_tag} WHERE x7 IS NOT NULL GROUP BY restaurant_id)"""
    CTES[f"holdout_{_tag}"] = f"""
SELECT restaurant_id, d, v AS actual, CASE WHEN back > 6 THEN v7 ELSE v14 END AS naive,
       CASE WHEN back > 6 THEN v7 + v14 + v21 + v28 ELSE v14 + v21 + v28 + v35 END / 4.0 AS recent,
       exp(CASE WHEN back > 6 THEN held_a + held_b * x7 ELSE held_a + held_b * (held_a + held_b * x14) END) - 1 AS lagged
FROM lagged_{_tag} JOIN lines_{_tag} USING (restaurant_id)
WHERE back < 14"""
    CTES[f"scores_{_tag}"] = f"""
SELECT restaurant_id, lag_wins, holdout_mape_pct, naive_wape_pct,
       CASE WHEN naive_wape_pct > 0 THEN (1 - holdout_mape_pct / naive_wape_pct) * 100 END AS skill_vs_naive_pct
FROM (SELECT *, coalesce(lag_pct < mean_pct, FALSE) AS lag_wins,
             CASE WHEN lag_pct < mean_pct THEN lag_pct ELSE mean_pct END AS holdout_mape_pct
      FROM (SELECT restaurant_id,
                   CASE WHEN sum(actual) > 0 THEN sum(abs(recent - actual)) / sum(actual) * 100 END AS mean_pct,
                   CASE WHEN sum(actual) > 0 THEN sum(abs(lagged - actual)) / sum(actual) * 100 END AS lag_pct,
                   CASE WHEN sum(actual) > 0 THEN sum(abs(naive - actual)) / sum(actual) * 100 END AS naive_wape_pct
            FROM holdout_{_tag} GROUP BY restaurant_id))"""
    CTES[f"errors_{_tag}"] = f"""
SELECT restaurant_id, d, lag_wins, CASE WHEN lag_wins THEN x - a - b * x7 ELSE v - (v7 + v14 + v21 + v28) / 4.0 END AS e
FROM lagged_{_tag} JOIN lines_{_tag} USING (restaurant_id) JOIN scores_{_tag} USING (restaurant_id)
WHERE i > CASE WHEN lag_wins THEN 7 ELSE 28 END"""
    CTES[f"changes_{_tag}"] = f"""
SELECT restaurant_id, d, e - avg(e) OVER (PARTITION BY restaurant_id) AS x FROM errors_{_tag}"""
    CTES[f"tests_{_tag}"] = f"""
SELECT restaurant_id, p, CASE WHEN p > 0.05 THEN 'PASS' ELSE 'FAIL' END AS residuals_pass FROM (
  SELECT restaurant_id, exp(-h) * (1 + h + h**2 / 2 + h**3 / 6 + h**4 / 24) AS p FROM (
    SELECT restaurant_id, m * (m + 2.0) / 2 * ({' + '.join(f'(c{k} / c0) ** 2 / (m - {k})' for k in range(1, 11))}) AS h
    FROM (SELECT restaurant_id, count(*) AS m, sum(x * x) AS c0, {', '.join(f'sum(x * x{k}) AS c{k}' for k in range(1, 11))}
          FROM (SELECT *, {', '.join(f'lag(x, {k}) OVER (PARTITION BY restaurant_id ORDER BY d) AS x{k}' for k in range(1, 11))}
                FROM changes_{_tag})
          GROUP BY restaurant_id)))"""
    CTES[f"fits_{_tag}"] = f"""
SELECT *, aic + 2.0 * k * (k + 1) / (m - k - 1) AS aicc
FROM (SELECT *, CASE WHEN variance > 0 THEN m * ln(variance) + 2.0 * k END AS aic
      FROM (SELECT restaurant_id, any_value(lag_wins) AS lag_wins, count(*) AS m, avg(e * e) AS variance,
                   CASE WHEN any_value(lag_wins) THEN 3 ELSE 1 END AS k
            FROM errors_{_tag} GROUP BY restaurant_id))"""
    CTES[f"judged_{_tag}"] = f"""
SELECT restaurant_id, CASE WHEN f.lag_wins THEN 'weekly lag' WHEN NOT f.lag_wins THEN 'mean of 4 weeks' END AS sarima_order,
       CASE WHEN n >= 90 THEN '7' END AS sarima_seasonal_order, {r('aic', 4)} AS aic,
       {r('aicc', 4)} AS aicc, {r('p', 6)} AS ljung_box_pvalue, residuals_pass,
       holdout_mape_pct, naive_wape_pct, skill_vs_naive_pct, n AS n_obs_used,
       CASE WHEN n < 90 THEN 'SKIPPED_INSUFFICIENT_HISTORY (n=' || n || ' < 90)'
            WHEN residuals_pass = 'PASS' AND skill_vs_naive_pct > 0 THEN 'OK' ELSE 'OK_FALLBACK_SEASONAL_MEDIAN' END AS status,
       '{AS_OF if _tag == "now" else EARLIER_RUN}' AS model_run_date
FROM (SELECT DISTINCT restaurant_id, n FROM {_s}) LEFT JOIN tests_{_tag} USING (restaurant_id)
LEFT JOIN scores_{_tag} USING (restaurant_id) LEFT JOIN fits_{_tag} f USING (restaurant_id)"""

CTES["latest"] = """
SELECT * EXCLUDE (place) FROM (
  SELECT *, row_number() OVER (PARTITION BY restaurant_id ORDER BY model_run_date DESC) AS place
  FROM (SELECT * FROM judged_now UNION ALL SELECT * FROM judged_earlier)) WHERE place = 1"""

CTES["caps"] = """
SELECT restaurant_id, n AS n_obs_used, max(d) AS last_date, quantile_cont(v, 0.99) * 1.25 AS capacity_cap
FROM s_now GROUP BY restaurant_id, n"""

CTES["fx_median"] = """
SELECT restaurant_id, forecast_date, n_obs_used, least(greatest(middle, 0.0), capacity_cap) AS predicted_revenue,
       greatest(middle - 1.28 * dev, 0.0) AS lower_ci, least(greatest(middle + 1.28 * dev, 0.0), capacity_cap) AS upper_ci
FROM (SELECT *, last_date + CAST(step AS INTEGER) AS forecast_date
      FROM caps, (SELECT unnest(range(1, 15)) AS step) WHERE n_obs_used >= 90) f
JOIN (SELECT restaurant_id, isodow(d) AS dow, median(v) AS middle, coalesce(stddev_samp(v), 0.0) AS dev
      FROM s_now WHERE back < 28 GROUP BY restaurant_id, isodow(d)) w USING (restaurant_id)
WHERE isodow(f.forecast_date) = w.dow"""

# The four values of each future day's weekday serve the mean, the median and, the newest of them, the lag model.
CTES["ahead"] = """
SELECT restaurant_id, step, avg(v) AS mean, median(v) AS middle, coalesce(stddev_samp(v), 0.0) AS dev,
       max(CASE WHEN back < 7 THEN ln(1 + v) END) AS x
FROM s_now, (SELECT unnest(range(1, 15)) AS step)
WHERE back < 28 AND back % 7 = 6 - (step - 1) % 7 AND n >= 90 GROUP BY restaurant_id, step"""
CTES["modelled"] = """
SELECT restaurant_id, step, status, middle, dev, capacity_cap, last_date, n_obs_used,
       CASE WHEN lag_wins THEN exp(u) - 1 ELSE mean END AS point,
       CASE WHEN lag_wins THEN exp(u - reach) - 1 ELSE mean - reach END AS low,
       CASE WHEN lag_wins THEN exp(u + reach) - 1 ELSE mean + reach END AS high
FROM (SELECT *, 1.2815515655446004::DOUBLE * sqrt(variance) AS reach, CASE WHEN step <= 7 THEN a + b * x ELSE a + b * (a + b * x) END AS u
      FROM ahead JOIN lines_now USING (restaurant_id) JOIN fits_now USING (restaurant_id)
      JOIN (SELECT restaurant_id, status FROM judged_now) USING (restaurant_id) JOIN caps USING (restaurant_id))"""
CTES["forecasts"] = """
SELECT restaurant_id, last_date + CAST(step AS INTEGER) AS forecast_date, n_obs_used,
       CASE WHEN status = 'OK' THEN least(greatest(point, 0.0), capacity_cap)
            ELSE least(greatest(middle, 0.0), capacity_cap) END AS predicted_revenue,
       CASE WHEN status = 'OK' THEN greatest(low, 0.0) ELSE greatest(middle - 1.28 * dev, 0.0) END AS lower_ci,
       CASE WHEN status = 'OK' THEN least(greatest(high, 0.0), capacity_cap)
            ELSE least(greatest(middle + 1.28 * dev, 0.0), capacity_cap) END AS upper_ci,
       CASE WHEN status = 'OK' THEN 'WEEKLY_MODEL' ELSE 'SEASONAL_MEDIAN_FALLBACK' END AS forecast_method
FROM modelled"""

QUERIES: dict[str, str] = {}


def _day(c: str, name: str | None = None) -> str:
    return f"CAST({c} AS VARCHAR) AS {name or c.split('.')[-1]}"


def _big(c: str, name: str | None = None) -> str:
    return f"CAST({c} AS BIGINT) AS {name or c.split('.')[-1]}"


def _dbl(c: str, name: str | None = None) -> str:
    return f"CAST({c} AS DOUBLE) AS {name or c.split('.')[-1]}"


def _counts(checks: dict[str, str], source: str, kept: str) -> str:
    """One row per rule: how many rows fail it; unknown fails."""
    parts = [
        f"SELECT 'rows_in' AS rule, count(*) AS row_count FROM {source}",
        f"SELECT 'rows_kept', count(*) FROM {source} WHERE {kept}",
    ]
    parts += [f"SELECT '{n}', count(*) FROM {source} WHERE NOT coalesce({c}, FALSE)" for n, c in checks.items()]
    return " UNION ALL ".join(parts)


def _all(checks: dict[str, str]) -> str:
    return " AND ".join(f"coalesce({c}, FALSE)" for c in checks.values())


ISO = "strftime(order_timestamp, '%Y-%m-%dT%H:%M:%S')"

QUERIES["src_kafka_decode"] = f"""
SELECT restaurant_id AS kafka_key, order_id, {ISO} || '+00:00' AS "timestamp", restaurant_id, customer_id, order_type,
       lines AS items, {_dbl('total_amount')}, payment_method, 'pending' AS order_status, {ISO} || '+00:00' AS created_at,
       {_day('order_timestamp', 'kafka_timestamp')}, o_orderkey % 4 AS "partition", o_orderkey AS "offset",
       concat_ws('|', order_id, {ISO} || '+00:00', restaurant_id, customer_id, order_type, payment_method, 'pending',
                 {ISO} || '+00:00') AS raw_fields, CAST(total_amount AS DOUBLE) AS raw_amount, lines AS raw_items
FROM fx_order LEFT JOIN fx_line_list ON o_orderkey = l_orderkey"""

QUERIES["snk_kafka_payload"] = f"""
SELECT restaurant_id AS "key", order_id, {_day('order_timestamp')}, {_day('order_date')}, {_big('order_hour')}, day_of_week,
       is_weekend, restaurant_id, customer_id, order_type, item_count, {_dbl('total_amount')}, payment_method, order_status
FROM fx_fact_orders"""

QUERIES["orders_unified"] = f"""
SELECT order_id, {_day('order_timestamp', '"timestamp"')}, restaurant_id, customer_id, order_type, lines AS items,
       {_dbl('total_amount')}, payment_method, order_status, {_day('order_timestamp', 'created_at')}, source_system
FROM fx_unified LEFT JOIN fx_line_list ON o_orderkey = l_orderkey"""

QUERIES["orders_dedup_survivor"] = """
SELECT order_id, CASE WHEN o_orderkey % 10 >= 6 THEN 'streaming_kafka' ELSE 'historical_batch' END AS source_system,
       CASE WHEN o_orderkey % 10 >= 6 THEN 'pending' ELSE order_status END AS order_status FROM fx_order"""

QUERIES["fact_orders"] = f"""
SELECT order_id, {_day('order_timestamp')}, CAST(CAST(order_timestamp AS DATE) AS VARCHAR) AS order_date,
       {_big('hour(order_timestamp)', 'order_hour')}, dayname(order_timestamp) AS day_of_week,
       dayname(order_timestamp) = 'Friday' AS is_weekend, restaurant_id, customer_id, order_type, item_count,
       {_dbl('total_amount')}, payment_method, order_status
FROM fx_unified WHERE restaurant_id IS NOT NULL AND item_count > 0 AND total_amount > 0"""

# Rule names and the vocabularies they check.
ORDER_CHECKS = {
    "valid_order_id": "order_id IS NOT NULL",
    "valid_order_timestamp": "order_timestamp IS NOT NULL",
    "valid_customer_id": "customer_id IS NOT NULL",
    "valid_restaurant_id": "restaurant_id IS NOT NULL",
    "valid_item_count": "item_count > 0",
    "valid_total_amount": "total_amount > 0",
    "valid_order_status": "order_status IN ('completed', 'pending', 'ready', 'delivered', 'preparing', 'confirmed')",
    "valid_payment_method": "payment_method IN ('wallet', 'card', 'cash')",
}
_readable = {**ORDER_CHECKS, "readable_total_amount": "TRUE", "plausible_order_timestamp": "order_timestamp >= TIMESTAMP '1970-01-01'"}
QUERIES["fact_orders_dq_counts"] = _counts(_readable, "fx_unified", _all(_readable))
CTES["fx_gaps"] = """
SELECT order_id, order_timestamp, customer_id, restaurant_id, item_count, total_amount, order_status, payment_method
FROM fx_unified WHERE o_orderkey % 7 <> 0
UNION ALL SELECT NULL, order_timestamp, customer_id, restaurant_id, item_count, total_amount, order_status, payment_method
FROM fx_order WHERE o_orderkey % 7 = 0 AND o_orderkey % 10 < 8
UNION ALL SELECT NULL, order_timestamp, customer_id, restaurant_id, item_count, total_amount, 'pending', payment_method
FROM fx_order WHERE o_orderkey % 7 = 0 AND o_orderkey % 10 >= 6"""
QUERIES["dq_counts_without_ids"] = _counts(_readable, "fx_gaps", _all(_readable))
_failing = ", ".join(f"CASE WHEN NOT coalesce({check}, FALSE) THEN '{name}' END" for name, check in _readable.items())
QUERIES["dq_reasons_without_ids"] = f"""
SELECT order_id, customer_id, {_day('order_timestamp')}, array_to_string(list_sort([{_failing}]), ',') AS reasons
FROM fx_gaps WHERE NOT ({_all(_readable)})"""

QUERIES["fact_order_items"] = f"""
SELECT order_id, item_id, restaurant_id, {_day('order_timestamp')}, {_day('order_date')}, item_name, {_big('quantity')},
       {_dbl('unit_price')}, {_dbl('subtotal')}
FROM fx_items WHERE quantity > 0 AND unit_price > 0 AND subtotal > 0"""

QUERIES["dim_restaurant"] = f"SELECT restaurant_id, name, city, country, address, {_day('opening_date')}, phone FROM fx_venue"
QUERIES["dim_customer"] = """
SELECT 'C' || c_custkey AS customer_id, c_name AS name, '+' || c_custkey AS phone, c_mktsegment AS city,
       CAST(CAST(DATE '1994-01-01' + CAST(c_custkey % 365 AS INTEGER) AS DATE) AS VARCHAR) AS join_date FROM customer"""
QUERIES["dim_menu_item"] = f"""
SELECT restaurant_id, item_id, name, category, {_dbl('price')}, ingredients, is_vegetarian, 'None' AS spice_level FROM fx_menu_whole"""


# The cue words of the default classifier, stated here on their own.
POSITIVE_CUES = ("great", "excellent", "delicious", "perfect", "loved", "best", "friendly")
NEGATIVE_CUES = (
    "terrible", "awful", "bad", "worst", "disappointed", "never again",
    "worthless", "disgusting", "pathetic", "trash", "stupid", "idiot",
)
ISSUE_CUES = {
    "delivery": {
        "severe": ("never arrived", "hours late"), "moderate": ("very late", "late delivery", "wrong address"),
        "minor": ("bit late", "slightly late", "slow delivery"),
    },
    "food_quality": {
        "severe": ("disgusting", "inedible", "spoiled", "raw"), "moderate": ("stale", "undercooked", "burnt"),
        "minor": ("bland", "lukewarm", "too salty"),
    },
    "pricing": {
        "severe": ("rip off", "daylight robbery"), "moderate": ("overpriced", "not worth"), "minor": ("pricey", "a bit expensive"),
    },
    "portion_size": {"severe": ("left hungry",), "moderate": ("tiny portion", "half empty"), "minor": ("small portion", "rather small")},
}


def _classified(source: str, keep: str) -> str:
    def hit(cues) -> str:
        return "(" + " OR ".join(f"contains(t, ' {cue} ')" for cue in cues) + ")"

    levels, fields, answer = [], [], []
    for c, by_level in ISSUE_CUES.items():
        order = ("severe", "moderate", "minor")
        cases = " ".join(f"WHEN {hit(by_level[s])} THEN '{s}'" for s in order)
        cues = " ".join(f"WHEN {hit([cue])} THEN '{cue}'" for s in order for cue in by_level[s])
        levels.append(f"CASE {cases} ELSE 'none' END AS {c}_severity, CASE {cues} ELSE '' END AS issue_{c}_reason")
        fields.append(f"{c}_severity <> 'none' AS issue_{c}, {c}_severity, issue_{c}_reason")
        answer.append(
            f"""',"issue_{c}":' || ({c}_severity <> 'none') || ',"{c}_severity":"' || {c}_severity || '","issue_{c}_reason":"' || issue_{c}_reason || '"'"""
        )
    mood = f"CASE WHEN {hit(NEGATIVE_CUES)} THEN 'negative' WHEN {hit(POSITIVE_CUES)} THEN 'positive' ELSE 'neutral' END"
    return f"""
SELECT {keep}, sentiment, {', '.join(fields)}, '{{"sentiment":"' || sentiment || '"' || {' || '.join(answer)} || '}}' AS analysis_json FROM (
  SELECT *, {mood} AS sentiment, {', '.join(levels)}
  FROM (SELECT *, ' ' || regexp_replace(lower(full_text), '[^\\p{{L}}\\p{{M}}]+', ' ', 'g') || ' ' AS t
        FROM ({source})))"""


QUERIES["classify_review"] = _classified("SELECT doc_id, text AS full_text FROM documents", "doc_id")

# The remark that ends a review, per category and severity.
REMARKS = {
    "delivery": ("bit late", "very late", "never arrived"),
    "food_quality": ("bland", "stale", "inedible"),
    "pricing": ("pricey", "overpriced", "rip off"),
    "portion_size": ("small portion", "tiny portion", "left hungry"),
}
REMARKED = "SELECT *, text || '. ' || " + " || '. ' || ".join(
    f"(CASE (doc_id + {k}) % 4 WHEN 0 THEN 'fine' WHEN 1 THEN '{REMARKS[c][0]}' WHEN 2 THEN '{REMARKS[c][1]}' ELSE '{REMARKS[c][2]}' END)"
    for c, k in CATEGORY_SHIFT.items()
) + " AS full_text FROM fx_review_base"
QUERIES["fact_review"] = _classified(
    REMARKED,
    "review_id, order_id, customer_id, restaurant_id, rating, full_text AS review_text, "
    "CAST(review_timestamp AS VARCHAR) AS review_timestamp",
)

QUERIES["fact_review_dq_counts"] = (
    lambda checks, source: _counts(checks, source, _all(checks))
)(
    {
        "valid_sentiment": "doc_id % 11 <> 0 AND doc_id % 13 <> 0",
        **{
            f"valid_{c}_severity": f"doc_id % 11 <> 0 AND doc_id % {17 + k} <> 0"
            for k, c in enumerate(REVIEW_CATEGORIES)
        },
        "non_negative_rating": "n_chars % 7 - 1 >= 0",
    },
    "documents",
)

_contract = {
    **{f"valid_{c}": f"{c} IS NOT NULL" for c in ("review_id", "order_id", "customer_id", "restaurant_id")},
    "valid_review_text": "text IS NOT NULL",
    "valid_review_timestamp": "review_timestamp IS NOT NULL",
    "rating_in_range": "rating BETWEEN 1 AND 5",
}
QUERIES["dq_review_contract"] = _counts(_contract, "fx_review_base", _all(_contract))

_lines = {
    "valid_item_id": "item_id IS NOT NULL",
    "quantity_in_range": "quantity > 0 AND quantity <= 20",
    "valid_unit_price": "unit_price > 0",
    "subtotal_matches": "subtotal > 0 AND abs(subtotal - round(unit_price * quantity, 2)) <= 0.05",
}
QUERIES["dq_item_consistency"] = _counts(_lines, "fx_lines", _all(_lines))

_header = {
    **{k: v for k, v in ORDER_CHECKS.items() if k != "valid_total_amount"},
    "valid_order_type": "order_type IN ('dine_in', 'takeaway', 'delivery')",
    "total_matches_items": "total_amount > 0 AND abs(total_amount - items_total) <= 0.05",
}
_headers = (
    "(SELECT u.*, items_total FROM fx_unified u LEFT JOIN (SELECT l_orderkey, sum(subtotal) AS items_total FROM fx_lines "
    "GROUP BY l_orderkey) l ON u.o_orderkey = l.l_orderkey)"
)
QUERIES["dq_order_total_consistency"] = _counts(_header, _headers, _all(_header))

QUERIES["dq_reconcile_orders"] = """
SELECT restaurant_id, count(*) AS left_total, count(DISTINCT order_id) AS right_total, CAST(0 AS BIGINT) AS difference
FROM fx_valid GROUP BY restaurant_id"""

QUERIES["dq_quarantine_reasons"] = """
SELECT order_id, 'valid_item_count,valid_restaurant_id' AS reasons FROM fx_unified
WHERE restaurant_id IS NULL AND item_count IS NULL AND total_amount > 0"""

QUERIES["load_summary"] = """
SELECT count(restaurant_id) AS rows_kept, count(*) - count(restaurant_id) AS rows_rejected,
       CAST(min(CASE WHEN restaurant_id IS NOT NULL THEN order_timestamp END) AS VARCHAR) AS first_timestamp,
       CAST(max(CASE WHEN restaurant_id IS NOT NULL THEN order_timestamp END) AS VARCHAR) AS last_timestamp,
       CAST(sum(CASE WHEN restaurant_id IS NOT NULL THEN total_amount END) AS DOUBLE) AS total_amount
FROM fx_order"""

QUERIES["rating_distribution"] = "SELECT rating, count(*) AS row_count FROM fx_review GROUP BY rating"

QUERIES["daily_sales_summary"] = f"""
SELECT {_day('order_date')}, total_orders, {_dbl('total_revenue')}, unique_restaurants, dine_in_orders, takeaway_orders,
       delivery_orders FROM fx_summary"""
QUERIES["daily_sales_hll"] = f"""
SELECT {_day('order_date')}, count(DISTINCT customer_id) AS exact_customers, TRUE AS within_5_pct
FROM fx_valid GROUP BY order_date"""
QUERIES["hll_union_error"] = """
SELECT strftime(order_date, '%Y-%m') AS month, count(DISTINCT customer_id) AS exact_customers, TRUE AS within_5_pct
FROM fx_valid GROUP BY strftime(order_date, '%Y-%m')"""
QUERIES["restaurant_reviews"] = "SELECT * EXCLUDE (name) FROM fx_venue_reviews"
QUERIES["customer_order_share"] = f"""
SELECT customer_id, restaurant_id, order_count, {_dbl('total_spend')}, {_day('first_order_timestamp')},
       {_day('last_order_timestamp')}, customer_total_orders, order_share FROM fx_pairs"""

SCORES = ("recency_score", "rating_score", "sentiment_score", "food_quality_score", "pricing_score", "portion_score")
QUERIES["customer_restaurant_preference"] = f"""
SELECT * EXCLUDE (trust) REPLACE (CAST(total_spend AS DOUBLE) AS total_spend,
         CAST(first_order_timestamp AS VARCHAR) AS first_order_timestamp,
         CAST(last_order_timestamp AS VARCHAR) AS last_order_timestamp,
         {', '.join(f'{r(c, 6)} AS {c}' for c in SCORES)})
FROM fx_preference"""
QUERIES["preferred_restaurant"] = "SELECT * FROM fx_preferred"
QUERIES["customer_360"] = """
SELECT * REPLACE (CAST(lifetime_spend AS DOUBLE) AS lifetime_spend, CAST(last_order_date AS VARCHAR) AS last_order_date)
FROM fx_customer_360"""
QUERIES["repeat_customer_stats"] = "SELECT * FROM fx_repeat"
QUERIES["restaurant_360"] = f"""
SELECT * REPLACE (CAST(total_revenue AS DOUBLE) AS total_revenue, CAST(delivery_revenue AS DOUBLE) AS delivery_revenue,
         CAST(last_order_date AS VARCHAR) AS last_order_date, {r('rating_score', 6)} AS rating_score,
         {r('quality_score', 6)} AS quality_score) FROM fx_venue_360"""
QUERIES["daily_item_popularity"] = f"""
SELECT {_day('order_date')}, restaurant_id, item_id, order_count, {_big('total_quantity_sold')}, {_dbl('total_revenue')},
       avg_unit_price, item_name, category, is_vegetarian FROM fx_popularity"""
QUERIES["daily_restaurant_performance"] = """
SELECT * REPLACE (CAST(activity_date AS VARCHAR) AS activity_date, CAST(daily_revenue AS DOUBLE) AS daily_revenue,
         CAST(delivery_revenue AS DOUBLE) AS delivery_revenue) FROM fx_performance"""

QUERIES["daily_series_regular"] = f"SELECT restaurant_id, {_day('d', 'activity_date')}, v AS daily_revenue FROM s_now"
QUERIES["forecast_history_gate"] = """
SELECT restaurant_id, n AS n_obs_used,
       CASE WHEN n >= 90 THEN 'FITTED' ELSE 'SKIPPED_INSUFFICIENT_HISTORY (n=' || n || ' < 90)' END AS status
FROM (SELECT DISTINCT restaurant_id, n FROM s_now UNION ALL SELECT DISTINCT restaurant_id, n FROM s_events)"""
QUERIES["forecast_capacity_cap"] = f"""
SELECT restaurant_id, n_obs_used, {_day('last_date')}, {r('capacity_cap', 6)} AS capacity_cap FROM caps"""
QUERIES["forecast_naive"] = f"SELECT restaurant_id, {_day('d', 'activity_date')}, naive, actual FROM holdout_now"
QUERIES["forecast_naive_wape"] = f"SELECT restaurant_id, {r('naive_wape_pct', 4)} AS naive_wape_pct FROM scores_now"


def _score_columns(*names: str, digits: int = 4) -> str:
    return ", ".join(f"{r(c, digits)} AS {c}" for c in names)


QUERIES["forecast_skill"] = f"""
SELECT restaurant_id, {_score_columns('holdout_mape_pct', 'naive_wape_pct', 'skill_vs_naive_pct')} FROM judged_now"""
QUERIES["ljung_box"] = "SELECT restaurant_id, ljung_box_pvalue, residuals_pass FROM judged_now"
QUERIES["forecast_rows"] = f"""
SELECT restaurant_id, {_day('forecast_date')}, {_score_columns('predicted_revenue', 'lower_ci', 'upper_ci')}, n_obs_used,
       '{AS_OF}' AS model_run_date, forecast_method FROM forecasts"""
QUERIES["forecast_diagnostics"] = f"""
SELECT * EXCLUDE (holdout_mape_pct, naive_wape_pct, skill_vs_naive_pct),
       {_score_columns('holdout_mape_pct', 'naive_wape_pct', 'skill_vs_naive_pct')} FROM judged_now"""
QUERIES["forecast_median_fallback"] = f"""
SELECT restaurant_id, {_day('forecast_date')}, n_obs_used, {_score_columns('predicted_revenue', 'lower_ci', 'upper_ci', digits=6)}
FROM fx_median"""
QUERIES["forecast_fallback_decision"] = "SELECT restaurant_id, residuals_pass, status FROM judged_now"
QUERIES["forecast_diagnostics_latest"] = f"""
SELECT * EXCLUDE (holdout_mape_pct, naive_wape_pct, skill_vs_naive_pct),
       {_score_columns('holdout_mape_pct', 'naive_wape_pct', 'skill_vs_naive_pct')} FROM latest"""

QUERIES["forecast_difference_test"] = f"SELECT restaurant_id, {r('t', 6)} AS dickey_fuller, differenced FROM ar_tested"
QUERIES["forecast_ar_order"] = f"""
SELECT restaurant_id, differenced, CAST(p AS BIGINT) AS ar_order, {_score_columns('aicc')}, {_score_columns('phi_1', 'phi_2', 'phi_3', digits=6)}
FROM ar_orders JOIN ar_tested USING (restaurant_id)
QUALIFY row_number() OVER (PARTITION BY restaurant_id ORDER BY aicc, p) = 1"""

NAMED = "LEFT JOIN (SELECT restaurant_id, name FROM fx_venue) r USING (restaurant_id)"
QUERIES["db_forecast_total"] = f"""
SELECT restaurant_id, {r('sum(predicted_revenue) / 1e6', 4)} AS expected_total_m, coalesce(name, restaurant_id) AS restaurant_name
FROM fx_median {NAMED} GROUP BY restaurant_id, name"""
QUERIES["db_forecast_feed"] = f"""
SELECT {r('predicted_revenue / 1e6', 4)} AS predicted_revenue_m, restaurant_id, coalesce(name, restaurant_id) AS restaurant_name
FROM fx_median {NAMED}"""
QUERIES["db_diagnostics_footer"] = f"""
SELECT CASE WHEN count(DISTINCT restaurant_id) = 1 THEN
         'Branch: ' || max(coalesce(name, restaurant_id)) || ' | Order: ' || max(sarima_order) || ' | Holdout WAPE: '
         || {r('max(holdout_mape_pct)', 1)} || '% | Residuals: ' || max(residuals_pass) || ' | Model used: '
         || CASE WHEN max(status) = 'OK' THEN 'Weekly model' ELSE 'Seasonal-median fallback' END
       ELSE 'Chain-Wide Status (as of ' || max(model_run_date) || ') | Avg Holdout WAPE: ' || {r('avg(holdout_mape_pct)', 1)}
         || '% | Passing Residual Diagnostics: ' || count(CASE WHEN residuals_pass = 'PASS' THEN 1 END) || '/' || count(*)
         || ' Branches | On Fallback: ' || count(CASE WHEN status = 'OK_FALLBACK_SEASONAL_MEDIAN' THEN 1 END) || '/'
         || count(*) || ' Branches' END AS diagnostics_footer
FROM latest {NAMED}"""
QUERIES["db_expected_peak"] = f"""
SELECT {_day('forecast_date')}, dayname(forecast_date) AS peak_day_name,
       {r('sum(predicted_revenue) / 1e6', 1)} || '(Upper: ' || {r('sum(upper_ci) / 1e6', 1)} || ')' AS display_value,
       restaurant_id, coalesce(name, restaurant_id) AS restaurant_name
FROM fx_median {NAMED} GROUP BY forecast_date, restaurant_id, name"""
STRIPPED = rf"trim(regexp_replace(coalesce(name, restaurant_id), '{BRAND.replace(' ', chr(92) + 's*')}\s*[-–—]?\s*', '', 'gi'))"
QUERIES["db_issue_pivot"] = " UNION ALL ".join(
    f"SELECT {STRIPPED} AS restaurant_name, '{label}' AS issue_dimension, {c}_complaint_count AS complaint_count, "
    f"coalesce(avg_{c}_severity, 0.0) AS avg_severity FROM fx_venue_360 {NAMED}"
    for label, c in (("Food Quality", "food_quality"), ("Pricing", "pricing"), ("Portion Size", "portion"), ("Delivery", "delivery"))
)
QUERIES["db_orders_line"] = f"""
SELECT {_day('order_date')}, {_big('sum(total_orders)', 'total_orders')},
       {cents('sum(total_revenue)', 'sum(total_orders)')} AS avg_order_value
FROM fx_summary WHERE order_date >= DATE '1997-01-01' AND order_date <= DATE '1999-12-31' GROUP BY order_date"""
QUERIES["db_actual_vs_forecast"] = f"""
SELECT {_day('activity_date', 'date')}, {r('daily_revenue / 1e6', 4)} AS amount, 'Actual' AS metric_type,
       CAST(NULL AS DOUBLE) AS lower_ci, CAST(NULL AS DOUBLE) AS upper_ci, restaurant_id,
       coalesce(name, restaurant_id) AS restaurant_name
FROM fx_performance {NAMED} WHERE activity_date >= DATE '{AS_OF}' - INTERVAL 14 DAY
UNION ALL
SELECT CAST(forecast_date AS VARCHAR), {r('predicted_revenue / 1e6', 4)}, 'Forecast', {r('lower_ci / 1e6', 4)},
       {r('upper_ci / 1e6', 4)}, restaurant_id, coalesce(name, restaurant_id) FROM fx_median {NAMED}"""
QUERIES["db_star_breakdown"] = " UNION ALL ".join(
    f"SELECT coalesce(name, restaurant_id) AS restaurant_name, '{n} Star{'s' if n > 1 else ''}' AS rating_label, "
    f"CAST({n} AS BIGINT) AS star_rank, {_big(f'sum(rating_{n}_stars)', 'rating_count')} "
    "FROM fx_venue_reviews GROUP BY name, restaurant_id"
    for n in range(5, 0, -1)
)
QUERIES["db_sentiment_distribution"] = " UNION ALL ".join(
    f"SELECT coalesce(name, restaurant_id) AS restaurant_name, '{m.capitalize()}' AS sentiment_category, "
    f"{_big(f'sum(sentiment_{m}_review)', 'review_count')} FROM fx_venue_reviews GROUP BY name, restaurant_id"
    for m in ("positive", "neutral", "negative")
)
QUERIES["db_entity_health"] = f"""
SELECT {r('restaurant_health_score', 4)} AS restaurant_health_score, {r('repeat_customer_rate * 100', 2)} AS repeat_customer_rate_pct,
       avg_order_value, total_orders, {_dbl('total_revenue')}, restaurant_id, coalesce(name, restaurant_id) AS restaurant_name
FROM fx_venue_360 {NAMED}"""
QUERIES["db_category_revenue"] = f"""
SELECT coalesce(category, 'Uncategorized') AS category, {_dbl('sum(total_revenue)', 'category_revenue')}
FROM fx_popularity WHERE order_date >= DATE '1996-01-01' GROUP BY 1 HAVING sum(total_revenue) > 0"""
QUERIES["db_top_items"] = f"""
SELECT item_name, {_big('sum(total_quantity_sold)', 'total_units_sold')} FROM fx_popularity
WHERE order_date <= DATE '2000-12-31' GROUP BY item_name ORDER BY total_units_sold DESC, item_name LIMIT 10"""
QUERIES["db_live_kpis"] = f"""
SELECT {_big('sum(total_orders)', 'total_orders')}, {_dbl('sum(total_revenue)', 'total_revenue')},
       {cents('sum(total_revenue)', 'sum(total_orders)')} AS avg_order_value,
       (SELECT count(*) FROM fx_customer_360 WHERE customer_activity_status = 'active') AS active_customers,
       (SELECT count(DISTINCT customer_id) FROM fx_valid) AS exact_customers, TRUE AS customers_within_5_pct
FROM fx_summary"""

QUERIES["fn_brand_strip"] = f"SELECT restaurant_id, name, {STRIPPED} AS short_name FROM fx_venue"
QUERIES["fn_calendar_features"] = f"""
SELECT restaurant_id, {_day('d', 'activity_date')}, {r('ln(1 + v)', 6)} AS log_value,
       CAST(isodow(d) = 4 AS BIGINT) AS is_weekday_3, CAST(isodow(d) = 5 AS BIGINT) AS is_weekday_4,
       back < 14 AS is_holdout FROM s_now"""
QUERIES["fn_date_scaffold"] = """
SELECT restaurant_id, CAST(CAST(unnest(generate_series(opening_date, DATE '1996-01-31', INTERVAL 1 DAY)) AS DATE) AS VARCHAR) AS day
FROM fx_venue"""
QUERIES["fn_json_items"] = """
SELECT order_id, item_count, CAST(units AS BIGINT) AS units FROM fx_order
LEFT JOIN (SELECT l_orderkey, sum(quantity) AS units FROM fx_lines GROUP BY l_orderkey) l ON o_orderkey = l_orderkey"""


def text(query: str) -> str:
    """The query with every common table expression it depends on, in definition order."""
    needed: set[str] = set()

    def visit(sql: str) -> None:
        for name in CTES:
            if name not in needed and re.search(rf"\b{name}\b", sql):
                needed.add(name)
                visit(CTES[name])

    visit(query)
    listed = ",\n".join(f"{name} AS ({CTES[name]})" for name in CTES if name in needed)
    return f"WITH {listed}\n{query}" if listed else query


def all_queries() -> dict[str, str]:
    return {name: text(query) for name, query in QUERIES.items()}
