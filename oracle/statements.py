"""One SQL statement per query name."""

from __future__ import annotations

from oracle.base import AS_OF, CUT, choose, pick, r2, ratio, with_

S: dict[str, str] = {}
STATEMENTS = S

# ---- staging, intermediate, marts ----

S["stg_users"] = choose("staged", "s_users", "*")
S["stg_products"] = choose(
    "staged",
    "s_products",
    "product_id product_name category supplier_id unit_cost:d category_group",
)
S["stg_orders"] = choose(
    "staged",
    "s_orders",
    "order_id user_id order_date order_status total_amount:d is_completed is_cancelled "
    "is_high_value_order order_month order_week day_of_week",
)
S["stg_order_items"] = choose(
    "staged",
    "s_items",
    "order_item_id order_id product_id quantity unit_price:d line_total:d",
)
S["stg_returns"] = choose(
    "staged",
    "s_returns",
    "return_id order_item_id return_date return_reason refund_amount:d "
    "return_reason_category is_quality_issue return_month",
)
S["int_order_items_enriched"] = choose(
    "enriched",
    "lines",
    "order_item_id order_id product_id user_id order_date order_status is_completed "
    "is_cancelled product_name category category_group supplier_id unit_cost:d quantity "
    "unit_price:d gross_amount:d total_cost:d gross_profit:d gross_margin_pct is_returned "
    "return_id return_date return_reason return_reason_category is_quality_issue "
    "refund_amount:d net_revenue:d",
)
S["int_orders_enriched"] = choose(
    "enriched",
    "full_orders",
    "order_id user_id order_date email customer_segment country region signup_date "
    "order_status is_completed is_cancelled is_high_value_order item_count:l total_units:l "
    "total_amount:d total_cost:d total_gross_profit:d total_refund_amount:d net_revenue:d "
    "has_returns avg_gross_margin_pct order_month order_week day_of_week "
    "days_since_signup:i order_surrogate_key",
)
S["int_customer_orders"] = choose(
    "enriched",
    "customer_orders",
    "user_id total_orders completed_orders cancelled_orders high_value_orders "
    "total_revenue:d total_net_revenue:d total_gross_profit:d avg_order_value "
    "first_order_date last_order_date total_items_ordered:l avg_items_per_order "
    "total_returned_items:l total_refunds:d orders_with_returns:l",
)
S["int_product_performance"] = choose(
    "enriched",
    "product_sales",
    "product_id total_units_sold:l order_count unique_customers total_revenue:d "
    "net_revenue:d avg_selling_price min_selling_price:d max_selling_price:d "
    "total_gross_profit:d avg_gross_margin_pct:6 return_count total_refund_amount:d "
    "quality_issue_count return_rate quality_issue_pct",
)
S["dim_customers"] = choose(
    "marts",
    "customers",
    "customer_id email customer_segment country region signup_date total_orders:l "
    "total_revenue:d avg_order_value first_order_date last_order_date "
    "days_since_last_order:i lifetime_orders:l cancelled_orders:l high_value_orders:l "
    "total_net_revenue:d total_gross_profit:d avg_items_per_order total_returned_items:l "
    "total_refunds:d orders_with_returns:l customer_tier activity_status days_as_customer:i "
    "is_repeat_customer",
)
S["dim_date"] = with_(
    "entities",
    f"""
SELECT d AS date_id, year(d) AS year, month(d) AS month, day(d) AS day, quarter(d) AS quarter,
       weekofyear(d) AS week_of_year, dayofweek(d) AS day_of_week, dayofyear(d) AS day_of_year,
       monthname(d) AS month_name, left(monthname(d), 3) AS month_short, dayname(d) AS day_name,
       left(dayname(d), 3) AS day_short, strftime(d, '%Y-%m') AS year_month,
       concat(year(d), '-Q', quarter(d)) AS year_quarter,
       d - CAST(isodow(d) - 1 AS INT) AS week_start_date,
       d + CAST(7 - isodow(d) AS INT) AS week_end_date,
       make_date(year(d), month(d), 1) AS month_start_date, last_day(d) AS month_end_date,
       make_date(year(d), quarter(d) * 3 - 2, 1) AS quarter_start_date,
       last_day(make_date(year(d), quarter(d) * 3, 1)) AS quarter_end_date,
       isodow(d) > 5 AS is_weekend, isodow(d) < 6 AS is_weekday,
       d = {AS_OF} AS is_today, d = {AS_OF} - 1 AS is_yesterday,
       d >= DATE '2001-08-01' AND d <= {AS_OF} AS is_current_month,
       d >= DATE '2001-07-01' AND d <= {AS_OF} AS is_current_quarter
FROM (SELECT CAST(unnest(generate_series(min(order_date), max(order_date), INTERVAL 1 DAY))
                  AS DATE) AS d FROM heads)""",
)
FACT_ORDER = (
    "order_id user_id order_date customer_email customer_segment country region order_status "
    "is_completed is_cancelled total_items:l total_quantity:l subtotal:d is_returned "
    "days_to_return:i refund_amount:d net_revenue:d gross_profit:d avg_gross_margin_pct "
    "is_high_value_order is_multi_item_order order_month order_week day_of_week "
    "days_since_signup:i"
)
S["fct_orders"] = choose("marts", "order_facts", FACT_ORDER)
S["fct_order_items"] = choose(
    "marts",
    "item_facts",
    "order_item_id order_id product_id customer_id order_date_id product_name category "
    "category_group supplier_id quantity unit_price:d unit_cost:d gross_amount:d "
    "gross_profit:d gross_margin_pct is_returned return_id return_date return_reason "
    "return_reason_category refund_amount:d is_quality_issue net_revenue:d order_status "
    "is_completed order_month",
)
S["mart_product_performance"] = choose(
    "marts",
    "product_mart",
    "product_id product_name category category_group supplier_id unit_cost:d "
    "total_quantity_sold:l total_revenue:d total_orders:l unique_customers:l total_returns:l "
    "return_rate gross_profit:d profit_margin avg_selling_price min_selling_price:d "
    "max_selling_price:d net_revenue:d total_refund_amount:d quality_issue_returns:l "
    "quality_issue_pct performance_tier",
)
S["fct_daily_revenue"] = choose(
    "marts",
    "daily_full",
    "date_id order_count unique_customers gross_revenue:d total_refunds:d net_revenue:d "
    "gross_profit:d avg_order_margin_pct:6 total_items:l total_units:l avg_order_value "
    "high_value_order_count high_value_revenue:d orders_with_returns high_value_order_pct "
    "refund_rate_pct cumulative_revenue:d revenue_7day_avg",
)
S["fct_product_profitability"] = with_(
    "marts",
    f"""
SELECT product_id, month_id, p.product_name, p.category, p.category_group,
       p.unit_cost::DOUBLE AS unit_cost,
       {pick("items_sold units_sold:l order_count unique_customers")},
       gross_revenue::DOUBLE AS gross_revenue, t.net_revenue::DOUBLE AS net_revenue,
       t.total_cost::DOUBLE AS total_cost, t.gross_profit::DOUBLE AS gross_profit,
       round(avg_margin_pct, 6) AS avg_margin_pct,
       ifnull({ratio("t.gross_profit", "gross_revenue")} * 100, 0) AS net_margin_pct,
       return_count, refund_amount::DOUBLE AS refund_amount,
       return_count::DOUBLE / items_sold * 100 AS return_rate_pct,
       ifnull({ratio("gross_revenue - t.total_cost", "t.total_cost")} * 100, 0) AS roi_pct
FROM (SELECT product_id, order_month AS month_id, count(DISTINCT order_item_id) AS items_sold,
             sum(quantity) AS units_sold, count(DISTINCT order_id) AS order_count,
             count(DISTINCT customer_id) AS unique_customers,
             sum(gross_amount) AS gross_revenue, sum(net_revenue) AS net_revenue,
             sum(total_cost) AS total_cost, sum(gross_profit) AS gross_profit,
             avg(gross_margin_pct) AS avg_margin_pct,
             count(*) FILTER (is_returned) AS return_count, sum(refund_amount) AS refund_amount
      FROM item_facts GROUP BY ALL) t
LEFT JOIN s_products p USING (product_id)""",
)
S["fct_customer_cohorts"] = with_(
    "marts",
    f"""
SELECT cohort_month, months_since_signup, cohort_size, active_customers, order_count,
       active_customers::DOUBLE / cohort_size * 100 AS retention_rate_pct,
       gross_revenue::DOUBLE AS gross_revenue, net_revenue::DOUBLE AS net_revenue,
       {ratio("gross_revenue", "order_count")} AS avg_order_value,
       {ratio("gross_revenue", "cohort_size")} AS revenue_per_cohort_customer,
       so_far::DOUBLE AS cumulative_revenue,
       {ratio("so_far", "cohort_size")} AS cumulative_revenue_per_customer
FROM (SELECT *, sum(net_revenue) OVER (PARTITION BY cohort_month ORDER BY months_since_signup
                                       ROWS UNBOUNDED PRECEDING) AS so_far
      FROM (SELECT cohort_month, datediff('month', cohort_month, order_date)
                     AS months_since_signup,
                   count(DISTINCT user_id) AS active_customers,
                   count(DISTINCT order_id) AS order_count, sum(subtotal) AS gross_revenue,
                   sum(net_revenue) AS net_revenue
            FROM order_facts JOIN cohorts USING (user_id) GROUP BY ALL))
LEFT JOIN sizes USING (cohort_month)""",
)
S["fct_customer_segments"] = with_(
    "marts",
    f"""
SELECT customer_segment, customer_tier, region, activity_status, count(*) AS customer_count,
       sum(lifetime_orders)::BIGINT AS total_orders,
       sum(c.total_orders)::BIGINT AS completed_orders,
       {ratio("sum(lifetime_orders)", "count(*)")} AS avg_orders_per_customer,
       sum(c.total_revenue)::DOUBLE AS total_revenue,
       sum(c.total_net_revenue)::DOUBLE AS total_net_revenue,
       {ratio("sum(c.total_revenue)", "count(*)")} AS avg_revenue_per_customer,
       round(avg(c.avg_order_value), 6) AS avg_order_value,
       sum(c.total_gross_profit)::DOUBLE AS total_gross_profit,
       round(avg({ratio("c.total_gross_profit", "c.total_revenue")}) * 100, 6)
         AS avg_margin_pct,
       sum(total_returned_items)::BIGINT AS total_returns,
       sum(c.total_refunds)::DOUBLE AS total_refunds,
       round(avg({ratio("orders_with_returns", "c.total_orders")}) * 100, 6)
         AS avg_return_rate_pct,
       count(*) FILTER (is_repeat_customer) AS repeat_customers,
       sum(c.high_value_orders)::BIGINT AS high_value_orders,
       count(*) FILTER (is_repeat_customer)::DOUBLE / count(*) * 100 AS repeat_customer_pct,
       ifnull({ratio("sum(c.total_refunds)", "sum(c.total_revenue)")}, 0) * 100
         AS refund_rate_pct,
       {ratio("sum(c.total_net_revenue)", "count(*)")} AS avg_customer_ltv
FROM customers c GROUP BY 1, 2, 3, 4""",
)
S["fct_rfm_analysis"] = choose(
    "marts",
    "rfm_full",
    "customer_id email country region customer_segment recency_days:i frequency:l monetary:d "
    "recency_score frequency_score monetary_score rfm_total_score rfm_segment "
    "rfm_customer_segment recommended_action",
)

# ---- filters, joins, aggregations ----

S["filter_completed"] = with_(
    "entities",
    "SELECT order_id, user_id, order_date, total_amount::DOUBLE AS total_amount FROM heads "
    "WHERE status = 'completed'",
)
S["join_items_orders_products"] = with_(
    "staged",
    "SELECT order_item_id, order_id, product_id, quantity, unit_price::DOUBLE AS unit_price, "
    "line_total::DOUBLE AS line_total, user_id, order_date, category, "
    "unit_cost::DOUBLE AS unit_cost "
    "FROM s_items JOIN s_orders USING (order_id) JOIN s_products USING (product_id)",
)
S["join_items_returns"] = with_(
    "staged",
    "SELECT order_item_id, line_total::DOUBLE AS line_total, return_id, return_reason, "
    "ifnull(refund_amount, 0)::DOUBLE AS refund_amount, is_quality_issue "
    "FROM s_items LEFT JOIN s_returns USING (order_item_id)",
)
S["theta_cohort_periods"] = with_(
    "marts",
    """
SELECT cohort_month, period_month,
       datediff('month', cohort_month, period_month) AS months_since_signup
FROM (SELECT DISTINCT cohort_month FROM cohorts),
     (SELECT DISTINCT order_month AS period_month FROM s_orders)
WHERE period_month >= cohort_month""",
)
S["anti_orphans"] = with_(
    "staged",
    """
SELECT 'order' AS kind, order_id::VARCHAR AS id FROM s_orders
WHERE user_id NOT IN (SELECT user_id FROM s_users WHERE region <> 'Other')
UNION ALL
SELECT 'item', order_item_id FROM s_items
WHERE order_id NOT IN (SELECT order_id FROM s_orders WHERE is_completed)""",
)
S["order_rollup"] = choose(
    "enriched",
    "per_order",
    "order_id item_count total_units:l total_amount:d total_cost:d total_gross_profit:d "
    "total_refund_amount:d net_revenue:d has_returns",
)
S["conditional_distinct"] = with_(
    "staged",
    """
SELECT user_id, count(DISTINCT order_id) AS total_orders,
       count(DISTINCT CASE WHEN is_completed THEN order_id END) AS completed_orders,
       count(DISTINCT CASE WHEN is_cancelled THEN order_id END) AS cancelled_orders,
       count(DISTINCT CASE WHEN is_completed AND is_high_value_order THEN order_id END)
         AS high_value_orders
FROM s_orders GROUP BY user_id""",
)
S["distinct_months"] = with_("staged", "SELECT DISTINCT order_month FROM s_orders")

# ---- windows ----

HEADERS = """
header_{unit} AS (
  SELECT date_trunc('{unit}', order_date)::DATE AS period, sum(total_amount) AS amount,
         count(order_id) AS orders
  FROM heads GROUP BY 1)"""
COHORT_MONTHS = """
cohort_steps AS (
  SELECT cohort_month, datediff('month', cohort_month, order_date) AS age,
         sum(total_amount) AS amount, count(*) AS orders
  FROM heads JOIN cohorts USING (user_id) GROUP BY ALL)"""

S["win_running_total"] = with_(
    "entities",
    "SELECT period, amount::DOUBLE AS amount, (sum(amount) OVER (ORDER BY period ROWS UNBOUNDED "
    "PRECEDING))::DOUBLE AS running FROM header_day",
    HEADERS.format(unit="day"),
)
S["join_bucketed_facts"] = with_(
    "staged",
    """SELECT o.order_id, order_status, total_amount::DOUBLE AS total_amount, items,
  items_total::DOUBLE AS items_total
FROM s_orders o LEFT JOIN (
  SELECT order_id, count(order_item_id) AS items, sum(line_total) AS items_total
  FROM s_items GROUP BY 1) USING (order_id)""",
)
S["win_over_orders"] = with_(
    "entities",
    """SELECT order_id, order_date, status, total_amount::DOUBLE AS total_amount,
  (sum(total_amount) OVER (s ROWS UNBOUNDED PRECEDING))::DOUBLE AS status_running,
  (sum(total_amount) OVER (s ROWS 6 PRECEDING))::DOUBLE
    / count(*) OVER (s ROWS 6 PRECEDING) AS status_mean_7_rows,
  lag(order_id) OVER s AS previous_order_id,
  (sum(total_amount) OVER (ORDER BY order_date, order_id ROWS UNBOUNDED PRECEDING))::DOUBLE
    AS running
FROM heads WINDOW s AS (PARTITION BY status ORDER BY order_date, order_id)""",
)
S["win_moving_avg"] = with_(
    "entities",
    "SELECT period, amount::DOUBLE AS amount, (sum(amount) OVER w)::DOUBLE / count(*) OVER w "
    "AS mean_7_rows FROM header_day WINDOW w AS (ORDER BY period ROWS 6 PRECEDING)",
    HEADERS.format(unit="day"),
)
S["win_cohort_cumulative"] = with_(
    "marts",
    """
SELECT cohort_month, age, so_far::DOUBLE AS so_far,
       so_far::DOUBLE / cohort_size AS so_far_per_customer
FROM (SELECT cohort_month, age, sum(amount) OVER (PARTITION BY cohort_month ORDER BY age
                                                  ROWS UNBOUNDED PRECEDING) AS so_far
      FROM cohort_steps) JOIN sizes USING (cohort_month)""",
    COHORT_MONTHS,
)
S["win_lag"] = with_(
    "marts",
    """
SELECT NULL::DATE AS cohort_month, period::VARCHAR AS step, orders,
       lag(orders) OVER (ORDER BY period) AS previous_orders FROM header_week
UNION ALL
SELECT cohort_month, age::VARCHAR, orders,
       lag(orders) OVER (PARTITION BY cohort_month ORDER BY age) FROM cohort_steps""",
    COHORT_MONTHS + "," + HEADERS.format(unit="week"),
)
S["win_first_value"] = with_(
    "marts",
    "SELECT cohort_month, age, amount::DOUBLE AS amount, (first_value(amount) OVER "
    "(PARTITION BY cohort_month ORDER BY age))::DOUBLE AS first_amount FROM cohort_steps",
    COHORT_MONTHS,
)
S["win_row_number"] = with_(
    "entities",
    """
SELECT order_id, status, total_amount::DOUBLE AS total_amount,
       row_number() OVER (ORDER BY total_amount DESC, order_id) AS overall_rank,
       row_number() OVER (PARTITION BY status ORDER BY total_amount DESC, order_id)
         AS status_rank
FROM heads""",
)
S["win_ntile"] = with_(
    "entities",
    """
SELECT order_id, order_date, total_amount::DOUBLE AS total_amount,
       (ntile(5) OVER (ORDER BY order_date DESC, order_id))::INT AS date_tile,
       (ntile(7) OVER (ORDER BY total_amount, order_id))::INT AS amount_tile
FROM heads""",
)
S["win_rank_over_agg"] = with_(
    "enriched",
    """
SELECT product_id, category, sum(quantity)::BIGINT AS total_sold,
       row_number() OVER (PARTITION BY category ORDER BY sum(quantity) DESC, product_id)
         AS category_rank
FROM lines GROUP BY product_id, category""",
)
S["topk_products"] = with_(
    "marts",
    "SELECT product_id, product_name, net_revenue::DOUBLE AS net_revenue FROM product_mart p "
    "WHERE total_revenue > 0 ORDER BY p.net_revenue DESC, product_id LIMIT 20",
)
S["return_analysis"] = with_(
    "enriched",
    f"""
SELECT analysis_type, dimension, count(*) AS return_count,
       sum(refund)::DOUBLE AS total_refunds,
       {r2(ratio("sum(refund)", "count(*)"))} AS avg_refund
FROM (SELECT 'By Reason' AS analysis_type, reason AS dimension, refund FROM detail
      UNION ALL SELECT 'By Category', category, refund FROM detail
      UNION ALL SELECT 'By Customer Segment', segment, refund FROM detail
      UNION ALL SELECT 'Quality Issues by Supplier', supplier_id::VARCHAR, refund FROM detail
                WHERE quality)
GROUP BY 1, 2""",
    """
detail AS (
  SELECT r.return_reason AS reason, r.refund_amount AS refund, r.is_quality_issue AS quality,
         l.category, l.supplier_id, o.customer_segment AS segment
  FROM s_returns r JOIN lines l USING (order_item_id)
  JOIN full_orders o ON o.order_id = l.order_id)""",
)

# ---- scalar functions ----

BROKEN = "if(user_id % 9 = 0, split_part(email, '@', 1), email)"
S["fn_email_domain"] = with_(
    "entities", f"SELECT user_id, split_part({BROKEN}, '@', 2) AS email_domain FROM users"
)
S["fn_region"] = choose("staged", "s_users", "user_id region")
S["fn_date_trunc"] = with_(
    "entities",
    "SELECT order_id, order_date AS day_start, "
    + ", ".join(
        f"date_trunc('{u}', order_date)::DATE AS {u}_start"
        for u in ("week", "month", "quarter", "year")
    )
    + " FROM heads",
)
S["fn_datediff"] = with_(
    "entities",
    """
SELECT order_id, (order_date - signup_date)::INT AS days,
       (order_date - signup_date)::DOUBLE / 7 AS weeks,
       datediff('month', signup_date, order_date)::INT AS months,
       datediff('year', signup_date, order_date)::INT AS years
FROM heads JOIN users USING (user_id)""",
)
S["fn_safe_divide"] = with_(
    "entities",
    """
SELECT order_item_id,
       if(quantity % 7 = 0, 0, price::DOUBLE / (quantity % 7)::DOUBLE) AS per_unit,
       if(quantity % 7 = 0, NULL, price::DOUBLE / (quantity % 7)::DOUBLE) AS per_unit_or_null
FROM items""",
)
S["fn_surrogate_key"] = with_(
    "entities",
    """
SELECT order_id, md5(order_id::VARCHAR || '-' || user_id::VARCHAR) AS order_key,
       md5(order_date::VARCHAR || '-'
           || if(status = 'cancelled', '_dbt_utils_surrogate_key_null_', status)) AS state_key
FROM heads""",
)
S["fn_cents"] = with_(
    "entities",
    """
SELECT order_item_id, (price * 100)::BIGINT AS cents, price::DOUBLE AS dollars,
       round(price, 1)::DOUBLE AS dollars_1
FROM items""",
)
S["fn_date_parts"] = with_(
    "entities",
    "SELECT order_id, year(order_date) AS year, month(order_date) AS month, "
    "day(order_date) AS day, quarter(order_date) AS quarter, weekofyear(order_date) AS week, "
    "dayofweek(order_date) AS dow, dayofyear(order_date) AS doy FROM heads",
)
S["fn_date_format"] = with_(
    "entities",
    "SELECT order_id, strftime(order_date, '%B') AS month_name, "
    "strftime(order_date, '%b') AS month_short, strftime(order_date, '%A') AS day_name, "
    "strftime(order_date, '%a') AS day_short, strftime(order_date, '%Y-%m') AS year_month, "
    "concat(year(order_date), '-Q', quarter(order_date)) AS year_quarter FROM heads",
)
S["fn_period_bounds"] = with_(
    "entities",
    """
SELECT order_id, order_date - CAST(isodow(order_date) - 1 AS INT) AS week_first,
       order_date + CAST(7 - isodow(order_date) AS INT) AS week_last,
       make_date(year(order_date), month(order_date), 1) AS month_first,
       last_day(order_date) AS month_last,
       make_date(year(order_date), quarter(order_date) * 3 - 2, 1) AS quarter_first,
       last_day(make_date(year(order_date), quarter(order_date) * 3, 1)) AS quarter_last
FROM heads""",
)
S["fn_case_tier"] = with_(
    "entities",
    f"""
SELECT user_id,
       CASE WHEN revenue >= 2500000 AND n >= 8 THEN 'VIP'
            WHEN revenue >= 1500000 OR n >= 6 THEN 'Loyal'
            WHEN n >= 1 THEN 'Active' ELSE 'New' END AS tier,
       CASE WHEN {AS_OF} - last_day <= 90 THEN 'Active'
            WHEN {AS_OF} - last_day <= 365 THEN 'At Risk' ELSE 'Churned' END AS activity
FROM (SELECT user_id, sum(total_amount) AS revenue, count(*) FILTER (status = 'completed') AS n,
             max(order_date) AS last_day FROM heads GROUP BY user_id)""",
)
S["fn_concat_code"] = with_(
    "entities",
    "SELECT order_id, dayofweek(order_date) || month(order_date)::VARCHAR || status AS code, "
    "year(order_date) || nullif(quarter(order_date), 4)::VARCHAR AS code_or_null FROM heads",
)
S["fn_pct_change"] = with_(
    "entities",
    """
SELECT period, if(prior > 0, (amount - prior)::DOUBLE / prior::DOUBLE * 100, NULL) AS growth_pct
FROM (SELECT period, amount, lag(amount) OVER (ORDER BY period) AS prior FROM header_month)""",
    HEADERS.format(unit="month"),
)

# ---- spine, incremental, history, streams ----

S["date_spine"] = with_(
    "entities",
    "SELECT CAST(unnest(generate_series(min(order_date), max(order_date), INTERVAL 1 DAY)) "
    "AS DATE) AS date_day FROM heads",
)


def facts(name: str, keep_order: str, keep_return: str) -> str:
    """Order facts from the orders and returns that are known."""
    return f"""
{name} AS (
  SELECT order_id, order_date, status AS order_status, count(i.order_item_id) AS total_items,
         ifnull(sum(price * quantity), 0)::DOUBLE AS subtotal,
         ifnull(sum(refund_amount), 0)::DOUBLE AS refund_amount,
         ifnull(sum(price * quantity - ifnull(refund_amount, 0)), 0)::DOUBLE AS net_revenue,
         count(return_id) > 0 AS is_returned,
         min(return_date - order_date)::INT AS days_to_return
  FROM heads LEFT JOIN items i USING (order_id)
  LEFT JOIN (SELECT * FROM rets WHERE {keep_return}) r USING (order_item_id)
  WHERE {keep_order} GROUP BY ALL)"""


BOTH = facts("tgt", f"order_date < {CUT}", f"return_date < {CUT}") + "," + facts(
    "src", "true", "true"
)
NEWEST = "(SELECT max(order_date) FROM tgt)"


def merged(due: str, columns: str = "*", old_columns: str = "*") -> str:
    return with_(
        "entities",
        f"SELECT {columns} FROM src WHERE {due} UNION ALL "
        f"SELECT {old_columns} FROM tgt WHERE order_id NOT IN (SELECT order_id FROM src WHERE {due})",
        BOTH,
    )


S["incremental_merge"] = merged(f"order_date >= {NEWEST} - 3")
S["catch_up_window"] = merged(f"order_date >= {NEWEST} - 7")
S["incremental_changed_keys"] = merged(
    f"(order_date >= {NEWEST} - 3 OR order_id IN (SELECT order_id FROM rets JOIN items "
    f"USING (order_item_id) WHERE return_date >= {CUT}))"
)
S["schema_sync"] = merged(
    f"order_date >= {NEWEST} - 3",
    "order_id, order_date, order_status, total_items, subtotal, net_revenue, is_returned, "
    "days_to_return",
    "order_id, order_date, order_status, total_items, subtotal, NULL, NULL, days_to_return",
)
S["full_refresh"] = with_("entities", "SELECT * FROM src", facts("src", "true", "true"))

RUNS = "(1, DATE '1996-01-01'), (2, DATE '1998-01-01'), (3, DATE '2000-01-01')"


def history(name: str, key: str, rows: str, check: str, columns: str) -> str:
    """Versions from a grid of keys and runs: a version opens where a key is present and
    was absent or different in the run before, and closes at the next run that opens
    another one or misses the key."""
    prior = f"(PARTITION BY {key} ORDER BY run)"
    return f"""
runs(run, day) AS (VALUES {RUNS}),
seen AS ({rows}),
grid AS (
  SELECT k.{key}, r.run, r.day, s.run IS NOT NULL AS present, s.* EXCLUDE ({key}, run)
  FROM (SELECT DISTINCT {key} FROM seen) k CROSS JOIN runs r
  LEFT JOIN seen s ON s.{key} = k.{key} AND s.run = r.run),
marked AS (
  SELECT *, present AND (NOT lag(present, 1, false) OVER {prior}
                         OR lag({check}) OVER {prior} IS DISTINCT FROM {check}) AS opens
  FROM grid),
{name} AS (
  SELECT {key}, {columns}, md5(concat({key}::VARCHAR, '|', day::VARCHAR)) AS scd_id,
         day AS updated_at, day AS valid_from,
         (SELECT min(n.day) FROM marked n
          WHERE n.{key} = m.{key} AND n.run > m.run AND (n.opens OR NOT n.present)) AS valid_to
  FROM marked m WHERE opens)"""


CUSTOMER_HISTORY = history(
    "hist",
    "user_id",
    """
  SELECT user_id, run, email, signup_date, country,
         if(run > 1 AND user_id % 10 = 0, 'EX-', '') || customer_segment AS customer_segment
  FROM users, runs
  WHERE run = 1 OR user_id % 50 <> 0 OR (run = 3 AND user_id % 100 = 0)""",
    "(customer_segment, country)",
    "email, signup_date, country, customer_segment",
)
PRODUCT_HISTORY = history(
    "hist",
    "product_id",
    """
  SELECT product_id, run, product_name,
         if(run = 3 AND product_id % 11 = 0, 'MOVED', category) AS category, supplier_id,
         if(run > 1 AND product_id % 7 = 0, cost + 100, cost)::DOUBLE AS cost
  FROM products, runs WHERE run <> 2 OR product_id % 13 <> 0""",
    "(cost, category)",
    "product_name, category, supplier_id, cost",
)
S["scd2_customers"] = with_("entities", "SELECT * FROM hist", CUSTOMER_HISTORY)
S["scd2_products"] = with_("entities", "SELECT * FROM hist", PRODUCT_HISTORY)
S["scd2_point_in_time"] = with_(
    "entities",
    "SELECT user_id, country, customer_segment, valid_from FROM hist "
    "WHERE valid_from <= DATE '1999-06-01' AND ifnull(valid_to, DATE '9999-12-31') "
    "> DATE '1999-06-01'",
    CUSTOMER_HISTORY,
)
S["asof_product_cost"] = with_(
    "entities",
    """
SELECT order_item_id, i.product_id, order_date, h.cost, h.cost * quantity AS total_cost
FROM items i JOIN heads USING (order_id)
LEFT JOIN hist h ON h.product_id = i.product_id AND h.valid_from <= order_date
     AND order_date < ifnull(h.valid_to, DATE '9999-12-31')""",
    PRODUCT_HISTORY,
)
S["stream_upsert"] = with_(
    "entities",
    f"""
SELECT order_id, user_id, order_date,
       if(order_date < {CUT} - 30, 'completed', status) AS status,
       total_amount::DOUBLE AS total_amount, date_trunc('month', order_date)::DATE AS order_month,
       if(order_date < {CUT} - 30, 1, 2) AS arrival
FROM heads""",
)
S["stream_daily_revenue"] = with_(
    "entities",
    """
SELECT order_date AS day, count(*) AS order_count,
       count(*) FILTER (status = 'completed') AS completed_orders,
       sum(total_amount)::DOUBLE AS revenue
FROM heads GROUP BY order_date""",
)

# ---- analyses, documented queries, metrics ----

S["executive_summary"] = with_(
    "marts",
    f"""
SELECT o.first_day AS period_start, o.last_day AS period_end, o.total_orders,
       o.ordering_customers, o.gross::DOUBLE AS gross_revenue, o.net::DOUBLE AS net_revenue,
       o.profit::DOUBLE AS gross_profit, {r2(ratio("o.gross", "o.n"))} AS avg_order_value,
       {r2(ratio("o.profit", "o.gross") + " * 100")} AS gross_margin_pct,
       c.total_customers, c.repeat_customers,
       {r2(ratio("c.repeat_customers", "c.total_customers") + " * 100")} AS repeat_rate_pct,
       {r2("c.ltv")} AS avg_customer_ltv, p.active_products,
       {r2("p.rate * 100")} AS avg_return_rate_pct, o.returned AS orders_with_returns,
       {r2(ratio("o.returned", "o.total_orders") + " * 100")} AS order_return_rate_pct
FROM (SELECT min(order_date) AS first_day, max(order_date) AS last_day,
             count(DISTINCT order_id) AS total_orders,
             count(DISTINCT user_id) AS ordering_customers, sum(subtotal) AS gross,
             sum(net_revenue) AS net, sum(gross_profit) AS profit, count(*) AS n,
             count(*) FILTER (is_returned) AS returned FROM order_facts) o,
     (SELECT count(*) AS total_customers,
             count(*) FILTER (is_repeat_customer) AS repeat_customers,
             sum(total_revenue)::DOUBLE / count(*) AS ltv FROM customers) c,
     (SELECT count(*) AS active_products, avg(return_rate) AS rate FROM product_mart
      WHERE total_revenue > 0) p""",
)
S["customer_segmentation_summary"] = with_(
    "marts",
    f"""
SELECT rfm_customer_segment, n AS customer_count,
       {r2(ratio("n", "sum(n) OVER ()") + " * 100")} AS pct_of_customers,
       {r2(ratio("days", "n"), 0)} AS avg_recency_days, {r2(ratio("bought", "n"), 1)} AS avg_orders,
       {r2(ratio("revenue", "n"))} AS avg_revenue, revenue::DOUBLE AS total_revenue,
       {r2(ratio("revenue", "sum(revenue) OVER ()") + " * 100")} AS pct_of_revenue,
       recommended_action
FROM (SELECT rfm_customer_segment, recommended_action, count(*) AS n, sum(recency_days) AS days,
             sum(frequency) AS bought, sum(monetary) AS revenue
      FROM rfm_full GROUP BY 1, 2)""",
)
S["top_products_by_revenue"] = with_(
    "marts",
    f"""
SELECT product_id, product_name, category, category_group,
       {pick("total_orders:l total_quantity_sold:l unique_customers:l")},
       t.total_revenue::DOUBLE AS total_revenue, t.net_revenue::DOUBLE AS net_revenue,
       t.gross_profit::DOUBLE AS gross_profit,
       {r2("profit_margin * 100")} AS profit_margin_pct, performance_tier,
       {r2("return_rate * 100")} AS return_rate_pct, total_returns::BIGINT AS total_returns,
       row_number() OVER (ORDER BY t.net_revenue DESC, product_id) AS revenue_rank,
       row_number() OVER (ORDER BY t.gross_profit DESC, product_id) AS profit_rank,
       row_number() OVER (PARTITION BY category ORDER BY t.net_revenue DESC, product_id)
         AS category_revenue_rank
FROM product_mart t WHERE t.total_revenue > 0
ORDER BY t.net_revenue DESC, product_id LIMIT 20""",
)
S["weekly_revenue_trend"] = with_(
    "marts",
    f"""
SELECT week_start, orders, customers, gross::DOUBLE AS gross_revenue,
       net::DOUBLE AS net_revenue, {r2(ratio("gross", "n"))} AS avg_order_value,
       {r2("if(net0 > 0, (net - net0)::DOUBLE / net0::DOUBLE * 100, NULL)")}
         AS revenue_wow_growth_pct,
       {r2("(orders - orders0)::DOUBLE / orders0 * 100")} AS orders_wow_growth_pct,
       so_far::DOUBLE AS cumulative_revenue
FROM (SELECT *, lag(net) OVER w AS net0, lag(orders) OVER w AS orders0,
             sum(net) OVER (ORDER BY week_start ROWS UNBOUNDED PRECEDING) AS so_far
      FROM (SELECT order_week AS week_start, count(DISTINCT order_id) AS orders,
                   count(DISTINCT user_id) AS customers, sum(subtotal) AS gross,
                   sum(net_revenue) AS net, count(*) AS n
            FROM order_facts GROUP BY order_week) WINDOW w AS (ORDER BY week_start))""",
)
S["cohort_retention_matrix"] = with_(
    "marts",
    f"""
SELECT strftime(cohort_month, '%Y-%m') AS cohort_label, cohort_size, period, active_customers,
       retention_rate_pct, total_orders,
       {r2(ratio("total_orders", "active_customers"))} AS orders_per_active_customer,
       revenue::DOUBLE AS period_revenue, {r2(ratio("revenue", "total_orders"))} AS avg_order_value,
       {r2(ratio("sum(revenue) OVER so_far", "cohort_size"))} AS cumulative_ltv_per_customer,
       active_customers - lag(active_customers) OVER step AS churn_indicator,
       {r2(ratio("revenue", "first_value(revenue) OVER step") + " * 100")}
         AS revenue_retention_pct,
       CASE WHEN period = 0 THEN 'New' WHEN retention_rate_pct >= 50 THEN 'Excellent'
            WHEN retention_rate_pct >= 30 THEN 'Good' WHEN retention_rate_pct >= 15 THEN 'Average'
            ELSE 'At Risk' END AS retention_health
FROM (SELECT *, {r2(ratio("active_customers", "cohort_size") + " * 100")} AS retention_rate_pct
      FROM (SELECT cohort_month, datediff('month', cohort_month, order_month) AS period,
                   count(DISTINCT user_id) AS active_customers,
                   count(DISTINCT order_id) AS total_orders, sum(subtotal) AS revenue
            FROM order_facts JOIN cohorts USING (user_id)
            WHERE is_completed AND order_month >= cohort_month GROUP BY ALL)
      JOIN sizes USING (cohort_month))
WINDOW step AS (PARTITION BY cohort_month ORDER BY period),
       so_far AS (PARTITION BY cohort_month ORDER BY period ROWS UNBOUNDED PRECEDING)""",
)
S["clv_premium_top10"] = choose(
    "marts",
    "customers",
    "customer_id email customer_segment total_orders:l total_revenue:d avg_order_value "
    "first_order_date last_order_date days_since_last_order:i",
    "WHERE customer_segment = 'BUILDING' ORDER BY customers.total_revenue DESC, customer_id "
    "LIMIT 10",
)
S["high_return_products"] = choose(
    "marts",
    "product_mart",
    "product_id product_name category total_quantity_sold:l total_revenue:d total_returns:l "
    "return_rate gross_profit:d profit_margin",
    "WHERE return_rate > 0.02",
)
S["returned_orders_recent"] = choose(
    "marts",
    "order_facts",
    "order_id order_date customer_email customer_segment order_status total_items:l "
    "total_quantity:l subtotal:d is_returned days_to_return:i",
    "WHERE is_returned ORDER BY order_date DESC, order_id LIMIT 5",
)
S["monthly_trends"] = with_(
    "marts",
    f"""
SELECT order_month, count(DISTINCT order_id) AS total_orders,
       count(DISTINCT user_id) AS unique_customers, sum(subtotal)::DOUBLE AS total_revenue,
       {ratio("sum(subtotal)", "count(*)")} AS avg_order_value
FROM order_facts WHERE order_status = 'completed' GROUP BY order_month""",
)
S["items_revenue_returns"] = with_(
    "marts",
    "SELECT product_name, category, sum(gross_amount)::DOUBLE AS revenue, "
    "count(*) FILTER (is_returned) AS returns FROM item_facts GROUP BY 1, 2",
)
S["daily_recent"] = choose(
    "marts",
    "daily_full",
    "date_id net_revenue:d cumulative_revenue:d revenue_7day_avg",
    "ORDER BY date_id DESC LIMIT 30",
)
S["metric_rollup"] = with_(
    "marts",
    f"""
SELECT order_month AS period, region, sum(subtotal)::DOUBLE AS revenue, count(*) AS order_count,
       {ratio("sum(subtotal)", "count(*)")} AS average_order_value
FROM order_facts GROUP BY 1, 2""",
)

# ---- data quality ----

EMAIL_REGEX = r"^[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z0-9-.]+$"
S["dq_unique"] = with_(
    "entities",
    "SELECT user_id, count(*) AS n_records FROM heads GROUP BY user_id HAVING count(*) > 1",
)
S["dq_not_null"] = choose("marts", "customers", "customer_id email", "WHERE total_orders = 0")
S["dq_accepted_values"] = choose(
    "entities", "rets", "return_id return_reason", "WHERE return_reason = 'unspecified'"
)
S["dq_relationships"] = with_(
    "staged",
    "SELECT order_id, user_id FROM heads JOIN s_users USING (user_id) WHERE region = 'Other'",
)
S["dq_positive_value"] = "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal < 0"
S["dq_valid_email"] = with_(
    "entities",
    "SELECT user_id, split_part(email, '@', 1) AS email FROM users WHERE user_id % 9 = 0",
)
S["dq_date_not_in_future"] = choose(
    "entities", "rets", "return_id return_date", f"WHERE return_date > {AS_OF}"
)
S["dq_unique_combination"] = with_(
    "entities",
    "SELECT order_id, product_id, count(*) AS n_records FROM items GROUP BY 1, 2 "
    "HAVING count(*) > 1",
)
S["dq_match_regex"] = with_(
    "entities",
    f"SELECT * FROM (SELECT user_id, {BROKEN} AS email FROM users) "
    f"WHERE NOT regexp_matches(email, '{EMAIL_REGEX}')",
)
S["dq_between"] = choose(
    "marts", "order_facts", "order_id subtotal:d", "WHERE order_facts.subtotal > 5000000"
)
S["dq_column_type"] = """
SELECT 'o_orderdate' AS column_name,
       replace(lower(min(typeof(o_orderdate))), 'timestamp', 'timestamp_ntz') AS actual_type,
       'date' AS expected_type, count(o_orderdate) AS n_values
FROM orders HAVING min(typeof(o_orderdate)) <> 'DATE'
UNION ALL
SELECT 'o_orderkey', lower(min(typeof(o_orderkey))), 'bigint', count(o_orderkey)
FROM orders HAVING min(typeof(o_orderkey)) <> 'BIGINT'"""
S["dq_order_totals"] = with_(
    "entities",
    """
SELECT order_id, any_value(h.total_amount)::DOUBLE AS total_amount,
       sum(price * quantity)::DOUBLE AS calculated_total,
       abs(any_value(h.total_amount) - sum(price * quantity))::DOUBLE AS difference
FROM heads h JOIN items USING (order_id) WHERE status = 'completed' GROUP BY order_id
HAVING abs(any_value(h.total_amount) - sum(price * quantity)) > 1""",
)
S["dq_refund_limit"] = with_(
    "staged",
    """
SELECT order_item_id, return_id, r.refund_amount::DOUBLE AS refund_amount,
       line_total::DOUBLE AS item_total
FROM s_returns r JOIN s_items i USING (order_item_id)
WHERE r.refund_amount * 2 > line_total""",
)
S["dq_orphans"] = with_(
    "entities",
    f"""
SELECT 'orders without user' AS "check", order_id::VARCHAR AS id, user_id AS parent_id FROM heads
WHERE user_id IN (SELECT user_id FROM users WHERE customer_segment = 'BUILDING')
UNION ALL
SELECT 'items without order', order_item_id, order_id FROM items
WHERE order_id IN (SELECT order_id FROM heads WHERE order_date < {CUT})""",
)


def lag_row(name: str, source: str, column: str, warn: int, error: int) -> str:
    hours = f"datediff('second', max({column})::TIMESTAMP, {AS_OF}::TIMESTAMP) / 3600.0"
    return f"""
SELECT '{name}' AS table_name, max({column})::TIMESTAMP AS max_loaded_at,
       ({hours})::DOUBLE AS lag_hours,
       CASE WHEN {hours} > {error} THEN 'error' WHEN {hours} > {warn} THEN 'warn'
            ELSE 'pass' END AS status FROM {source}"""


S["dq_freshness"] = with_(
    "entities",
    " UNION ALL ".join(
        [
            lag_row("users", "users", "signup_date", 12, 24),
            lag_row("orders", "heads", "order_date", 6, 36),
            lag_row("returns", "rets", "return_date", 12, 24),
        ]
    ),
)
S["dq_row_count_change"] = """
SELECT * FROM (
  SELECT count(*) FILTER (o_orderdate < DATE '1997-01-01') AS rows_before, count(*) AS rows_after,
         abs(rows_after - rows_before) * 100.0::DOUBLE / rows_before AS change_pct FROM orders)
WHERE change_pct > 50 OR rows_after < 100"""


def suite(parts: list[tuple[str, str, str, str, str]]) -> str:
    """One row per (table, check, severity, failing rows FROM ... )."""
    selects = [
        f"""SELECT '{table}' AS "table", '{check}' AS "check", '{severity}' AS severity,
       count(*) AS failures, if(count(*) = 0, 'pass', '{severity}') AS status
FROM {source} {condition}"""
        for table, check, severity, source, condition in parts
    ]
    return "\nUNION ALL\n".join(selects)


S["dq_contract"] = with_(
    "entities",
    suite(
        [
            ("orders", check, "error", "heads", condition)
            for check, condition in [
                ("type order_id string", ""),
                ("type total_amount decimal(14,2)", "WHERE false"),
                ("not_null order_id", "WHERE order_id IS NULL"),
                ("not_null total_amount", "WHERE total_amount IS NULL"),
                ("check total_amount >= 0", "WHERE total_amount < 0"),
                ("check total_amount < 400000", "WHERE total_amount >= 400000"),
                ("unique order_id", "GROUP BY order_id HAVING count(*) > 1"),
            ]
            if "GROUP" not in condition
        ]
        + [
            (
                "orders",
                "unique order_id",
                "error",
                "(SELECT order_id FROM heads GROUP BY order_id HAVING count(*) > 1)",
                "",
            )
        ]
    ),
)

# (table, columns with their checks); only accepted values, dates in the future, order
# totals can fail on the sales tables, but every check is counted.
SUITE_COLUMNS = {
    "s_users": "user_id email signup_date country customer_segment",
    "s_products": "product_id product_name category supplier_id unit_cost",
    "s_orders": "order_id user_id order_date order_status total_amount",
    "s_items": "order_item_id order_id product_id quantity unit_price line_total",
    "s_returns": "return_id order_item_id return_date return_reason refund_amount",
}
STG = {
    "s_users": "stg_users",
    "s_products": "stg_products",
    "s_orders": "stg_orders",
    "s_items": "stg_order_items",
    "s_returns": "stg_returns",
}
SUITE_RULES = [
    ("s_users", "valid_email email", "email NOT LIKE '%@%.%'"),
    ("s_users", "not_future signup_date", f"signup_date > {AS_OF}"),
    ("s_users", "accepted country", "NOT regexp_matches(country, '^NATION_(1?[0-9]|2[0-4])$')"),
    (
        "s_users",
        "accepted customer_segment",
        "customer_segment NOT IN ('BUILDING', 'AUTOMOBILE', 'MACHINERY', 'HOUSEHOLD', 'FURNITURE')",
    ),
    (
        "s_products",
        "accepted category",
        "category NOT IN ('STANDARD', 'ECONOMY', 'MEDIUM', 'LARGE', 'SMALL', 'PROMO')",
    ),
    ("s_products", "positive unit_cost", "unit_cost <= 0"),
    ("s_orders", "not_future order_date", f"order_date > {AS_OF}"),
    ("s_orders", "accepted order_status", "order_status <> 'completed'"),
    ("s_items", "positive quantity", "quantity <= 0"),
    ("s_items", "positive unit_price", "unit_price <= 0"),
    ("s_returns", "not_future return_date", f"return_date > {AS_OF}"),
    ("s_returns", "accepted return_reason", "return_reason = 'unspecified'"),
    ("s_returns", "positive refund_amount", "refund_amount <= 0"),
    (
        "s_orders",
        "parent(stg_users.user_id) user_id",
        "user_id NOT IN (SELECT user_id FROM s_users)",
    ),
    (
        "s_orders",
        "orders reference known users",
        "user_id NOT IN (SELECT user_id FROM s_users)",
    ),
    (
        "s_items",
        "parent(stg_orders.order_id) order_id",
        "order_id NOT IN (SELECT order_id FROM s_orders)",
    ),
    (
        "s_items",
        "items belong to known orders",
        "order_id NOT IN (SELECT order_id FROM s_orders)",
    ),
    (
        "s_items",
        "parent(stg_products.product_id) product_id",
        "product_id NOT IN (SELECT product_id FROM s_products)",
    ),
]
_parts = [
    (STG[t], f"not_null {col}", "error", t, f"WHERE {col} IS NULL")
    for t, cols in SUITE_COLUMNS.items()
    for col in cols.split()
]
_parts += [(STG[t], check, "error", t, f"WHERE {rule}") for t, check, rule in SUITE_RULES]
_parts += [
    (
        STG[t],
        f"unique {col}",
        "error",
        f"(SELECT {col} FROM {t} GROUP BY {col} HAVING count(*) > 1)",
        "",
    )
    for t, col in [
        ("s_users", "user_id"),
        ("s_users", "email"),
        ("s_products", "product_id"),
        ("s_orders", "order_id"),
        ("s_items", "order_item_id"),
        ("s_returns", "return_id"),
    ]
]
_parts += [
    (
        "stg_order_items",
        "items add up to the order total",
        "warn",
        "(SELECT order_id FROM s_orders o JOIN s_items USING (order_id) WHERE is_completed "
        "GROUP BY order_id HAVING abs(any_value(o.total_amount) - sum(line_total)) > 1)",
        "",
    ),
    (
        "stg_returns",
        "refund within the limit",
        "error",
        "s_returns r JOIN s_items i USING (order_item_id)",
        "WHERE r.refund_amount > line_total * 1.1",
    ),
]
S["dq_suite"] = with_("staged", suite(_parts))

# ---- all declared checks ----

# Tables and where their rows come from.
SOURCE_OF = {
    "raw_users": with_("entities", "SELECT * FROM users"),
    "raw_products": with_("entities", "SELECT * FROM products"),
    "raw_orders": with_("entities", "SELECT * FROM heads"),
    "raw_order_items": with_("entities", "SELECT * FROM items"),
    "raw_returns": with_("entities", "SELECT * FROM rets"),
    "stg_users": with_("staged", "SELECT * FROM s_users"),
    "stg_products": with_("staged", "SELECT * FROM s_products"),
    "stg_orders": with_("staged", "SELECT * FROM s_orders"),
    "stg_order_items": with_("staged", "SELECT * FROM s_items"),
    "stg_returns": with_("staged", "SELECT * FROM s_returns"),
    "snap_customers": S["scd2_customers"],
    "snap_products": S["scd2_products"],
}
# Columns per kind of check.
UNIQUE = """
raw_users user_id email|raw_products product_id|raw_orders order_id
raw_order_items order_item_id|raw_returns return_id|stg_users user_id email
stg_products product_id|stg_orders order_id|stg_order_items order_item_id|stg_returns return_id
int_customer_orders user_id|int_order_items_enriched order_item_id|int_orders_enriched order_id
int_product_performance product_id|dim_customers customer_id email|dim_date date_id
fct_order_items order_item_id|fct_orders order_id|mart_product_performance product_id
fct_daily_revenue date_id|fct_rfm_analysis customer_id
raw_users user_id email|raw_products product_id|raw_orders order_id
raw_order_items order_item_id|raw_returns return_id
"""
NOT_NULL = """
raw_users user_id email signup_date country customer_segment
raw_products product_id product_name category supplier_id cost
raw_orders order_id user_id order_date status total_amount
raw_order_items order_item_id order_id product_id quantity price
raw_returns return_id order_item_id return_date return_reason refund_amount
raw_users user_id|raw_products product_id|raw_orders order_id
raw_order_items order_item_id|raw_returns return_id
stg_users user_id email signup_date country customer_segment
stg_products product_id product_name category supplier_id unit_cost
stg_orders order_id user_id order_date order_status total_amount
stg_order_items order_item_id order_id product_id quantity unit_price line_total
stg_returns return_id order_item_id return_date return_reason refund_amount
int_customer_orders user_id|int_order_items_enriched order_item_id|int_orders_enriched order_id
int_product_performance product_id|dim_customers customer_id email customer_segment
dim_date date_id|fct_order_items order_item_id order_id product_id quantity
fct_orders order_id order_date|mart_product_performance product_id product_name
fct_daily_revenue date_id|fct_product_profitability product_id month_id
fct_customer_cohorts cohort_month months_since_signup|fct_rfm_analysis customer_id
snap_customers user_id|snap_products product_id
"""
RULED = [
    (t.replace("stg", level) if level == "raw" else t, check, rule)
    for level in ("raw", "stg")
    for t, check, rule in [
        ("stg_users", "accepted country", SUITE_RULES[2][2]),
        ("stg_users", "accepted customer_segment", SUITE_RULES[3][2]),
        ("stg_products", "accepted category", SUITE_RULES[4][2]),
        ("stg_returns", "accepted return_reason", "return_reason = 'unspecified'"),
    ]
]
RULED += [
    ("raw_orders", "accepted status", "status <> 'completed'"),
    ("dim_customers", "accepted customer_segment", SUITE_RULES[3][2]),
    ("fct_orders", "type(date) order_date", "false"),
    ("fct_orders", "email_regex customer_email", f"NOT regexp_matches(customer_email, '{EMAIL_REGEX}')"),
    ("fct_orders", "subtotal_bounds subtotal", "subtotal NOT BETWEEN 0 AND 5000000"),
]
RULED += [
    (STG[t], check, rule.replace("s_users", "stg_users").replace("s_orders", "stg_orders")
     .replace("s_products", "stg_products"))
    for t, check, rule in SUITE_RULES if not check.startswith("accepted") or "status" in check
]
TOGETHER = [
    ("fct_product_profitability", "product_id,month_id"),
    ("fct_customer_cohorts", "cohort_month,months_since_signup"),
]


def listed(text: str) -> list[tuple[str, str]]:
    return [
        (words.split()[0], column)
        for line in text.strip().splitlines() for words in line.split("|")
        for column in words.split()[1:]
    ]


_all = [(t, f"not_null {c}", "error", t, f"WHERE {c} IS NULL") for t, c in listed(NOT_NULL)]
_all += [
    (t, f"unique {c}", "error",
     f"(SELECT {c} FROM {t} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)", "")
    for t, c in listed(UNIQUE)
]
_all += [
    (t, f"together({c}) *", "error", f"(SELECT {c} FROM {t} GROUP BY {c} HAVING count(*) > 1)", "")
    for t, c in TOGETHER
]
_all += [(t, check, "error", t, f"WHERE {rule}") for t, check, rule in RULED]
_all += [
    (t, check, severity, source.replace("s_orders", "stg_orders").replace("s_items", "stg_order_items")
     .replace("s_returns", "stg_returns"), condition)
    for t, check, severity, source, condition in _parts[-2:]
]
_made = dict.fromkeys(t for t, *_ in _all)
S["dq_all"] = (
    "WITH " + ", ".join(f"{t} AS MATERIALIZED ({SOURCE_OF.get(t) or S[t]})" for t in _made)
    + "\n" + suite(_all)
)
