"""Shared SQL: the sales tables as retail entities, and the marts as plain joins.

Amounts stay decimal inside; ``pick`` casts them at the end. Means are written as
total over count, so that both sides round once.
"""

from __future__ import annotations

AS_OF = "DATE '2001-08-02'"
CUT = "DATE '2000-01-01'"

ENTITIES = """
users AS (
  SELECT c_custkey AS user_id,
         concat(lower(replace(c_name, '#', '')), '@', lower(replace(r_name, ' ', '')),
                '.example.com') AS email,
         DATE '1994-01-01' + CAST(c_custkey % 360 AS INT) AS signup_date,
         n_name AS country, r_name AS region_name, c_mktsegment AS customer_segment
  FROM customer JOIN nation ON c_nationkey = n_nationkey
                JOIN region ON n_regionkey = r_regionkey),
products AS (
  SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
         p_size AS supplier_id,
         CAST(CAST(p_retailprice AS DECIMAL(12,2)) * 40 AS DECIMAL(14,2)) AS cost
  FROM part),
heads AS (
  SELECT o_orderkey AS order_id, o_custkey AS user_id, CAST(o_orderdate AS DATE) AS order_date,
         if(o_orderstatus = 'P', 'cancelled', 'completed') AS status,
         CAST(if(o_orderstatus = 'P', 0, o_totalprice) AS DECIMAL(14,2)) AS total_amount
  FROM orders),
item_source AS (
  SELECT md5(concat(l_orderkey::VARCHAR, '-', l_partkey::VARCHAR, '-', l_suppkey::VARCHAR, '-',
                    l_linenumber::VARCHAR, '-', CAST(l_shipdate AS DATE)::VARCHAR))
           AS order_item_id,
         l_orderkey AS order_id, l_partkey AS product_id, CAST(l_quantity AS INT) AS quantity,
         CAST(l_extendedprice AS DECIMAL(14,2)) AS price, l_linenumber, l_returnflag
  FROM lineitem),
items AS (SELECT order_item_id, order_id, product_id, quantity, price FROM item_source),
rets AS (
  SELECT concat('R-', order_item_id) AS return_id, order_item_id,
         order_date + CAST((order_id * 7 + l_linenumber) % 60 AS INT) AS return_date,
         CASE l_linenumber % 5 WHEN 0 THEN 'defective' WHEN 1 THEN 'changed_mind'
              WHEN 2 THEN 'wrong_item' WHEN 3 THEN 'damaged_shipping'
              ELSE 'unspecified' END AS return_reason,
         price AS refund_amount
  FROM item_source JOIN heads USING (order_id) WHERE l_returnflag = 'R')"""

STAGED = """
s_users AS (
  SELECT user_id, email, split_part(email, '@', 2) AS email_domain, signup_date, country,
         coalesce(MAP {'AMERICA': 'North America', 'EUROPE': 'Europe',
                       'ASIA': 'Asia Pacific'}[region_name], 'Other') AS region,
         customer_segment
  FROM users),
s_products AS (
  SELECT product_id, product_name, category, supplier_id, cost AS unit_cost,
         coalesce(MAP {'STANDARD': 'Core', 'ECONOMY': 'Core', 'MEDIUM': 'Sized',
                       'LARGE': 'Sized'}[category], 'Other') AS category_group
  FROM products),
s_orders AS (
  SELECT order_id, user_id, order_date, status AS order_status, total_amount,
         ifnull(status = 'completed', false) AS is_completed,
         ifnull(status = 'cancelled', false) AS is_cancelled,
         ifnull(total_amount >= 400000, false) AS is_high_value_order,
         date_trunc('month', order_date)::DATE AS order_month,
         date_trunc('week', order_date)::DATE AS order_week,
         dayofweek(order_date)::INT AS day_of_week
  FROM heads),
s_items AS (
  SELECT order_item_id, order_id, product_id, quantity, price AS unit_price,
         price * quantity AS line_total
  FROM items),
s_returns AS (
  SELECT return_id, order_item_id, return_date, return_reason, refund_amount,
         coalesce(MAP {'defective': 'Quality Issue', 'damaged_shipping': 'Quality Issue',
                       'wrong_item': 'Fulfillment Error',
                       'changed_mind': 'Customer Decision'}[return_reason], 'Other')
           AS return_reason_category,
         ifnull(return_reason IN ('defective', 'damaged_shipping'), false) AS is_quality_issue,
         date_trunc('month', return_date)::DATE AS return_month
  FROM rets)"""

ENRICHED = """
lines AS (
  SELECT i.*, i.line_total AS gross_amount, o.user_id, o.order_date, o.order_status,
         o.is_completed, o.is_cancelled, p.product_name, p.category, p.category_group,
         p.supplier_id, p.unit_cost, p.unit_cost * i.quantity AS total_cost,
         i.line_total - p.unit_cost * i.quantity AS gross_profit,
         if(i.line_total > 0, (i.line_total - p.unit_cost * i.quantity)::DOUBLE
                              / i.line_total::DOUBLE, 0) AS gross_margin_pct,
         r.return_id IS NOT NULL AS is_returned, r.return_id, r.return_date, r.return_reason,
         r.return_reason_category, r.is_quality_issue,
         ifnull(r.refund_amount, 0) AS refund_amount,
         i.line_total - ifnull(r.refund_amount, 0) AS net_revenue
  FROM s_items i JOIN s_orders o USING (order_id) JOIN s_products p USING (product_id)
  LEFT JOIN s_returns r USING (order_item_id)),
per_order AS (
  SELECT order_id, count(DISTINCT order_item_id) AS item_count, sum(quantity) AS total_units,
         sum(gross_amount) AS total_amount, sum(total_cost) AS total_cost,
         sum(gross_profit) AS total_gross_profit, sum(refund_amount) AS total_refund_amount,
         sum(net_revenue) AS net_revenue, bool_or(is_returned) AS has_returns,
         min(return_date) AS first_return_date
  FROM lines GROUP BY order_id),
full_orders AS (
  SELECT o.* EXCLUDE (total_amount), u.email, u.customer_segment, u.country, u.region,
         u.signup_date, ifnull(l.item_count, 0) AS item_count,
         ifnull(l.total_units, 0) AS total_units, ifnull(l.total_amount, 0) AS total_amount,
         ifnull(l.total_cost, 0) AS total_cost,
         ifnull(l.total_gross_profit, 0) AS total_gross_profit,
         ifnull(l.total_refund_amount, 0) AS total_refund_amount,
         ifnull(l.net_revenue, 0) AS net_revenue, ifnull(l.has_returns, false) AS has_returns,
         ifnull(l.total_gross_profit::DOUBLE / nullif(l.total_amount::DOUBLE, 0) * 100, 0)
           AS avg_gross_margin_pct,
         l.first_return_date, o.order_date - u.signup_date AS days_since_signup,
         md5(o.order_id::VARCHAR || '-'
             || ifnull(o.user_id::VARCHAR, '_dbt_utils_surrogate_key_null_'))
           AS order_surrogate_key
  FROM s_orders o LEFT JOIN s_users u USING (user_id) LEFT JOIN per_order l USING (order_id)),
per_customer AS (
  SELECT user_id, count(DISTINCT order_id) AS total_orders,
         count(DISTINCT order_id) FILTER (is_completed) AS completed_orders,
         count(DISTINCT order_id) FILTER (is_cancelled) AS cancelled_orders,
         count(DISTINCT order_id) FILTER (is_completed AND is_high_value_order)
           AS high_value_orders,
         ifnull(sum(total_amount) FILTER (is_completed), 0) AS total_revenue,
         ifnull(sum(net_revenue) FILTER (is_completed), 0) AS total_net_revenue,
         ifnull(sum(total_gross_profit) FILTER (is_completed), 0) AS total_gross_profit,
         sum(total_amount) FILTER (is_completed)::DOUBLE
           / nullif(count(*) FILTER (is_completed), 0) AS avg_order_value,
         min(order_date) FILTER (is_completed) AS first_order_date,
         max(order_date) FILTER (is_completed) AS last_order_date
  FROM full_orders GROUP BY user_id),
customer_items AS (
  SELECT user_id, sum(quantity) AS total_items_ordered,
         sum(quantity)::DOUBLE / count(quantity) AS avg_items_per_order,
         count(DISTINCT order_item_id) FILTER (is_returned) AS total_returned_items,
         sum(refund_amount) FILTER (is_returned) AS total_refunds,
         count(DISTINCT order_id) FILTER (is_returned) AS orders_with_returns
  FROM lines WHERE is_completed GROUP BY user_id),
customer_orders AS (
  SELECT a.*, ifnull(b.total_items_ordered, 0) AS total_items_ordered,
         ifnull(b.avg_items_per_order, 0) AS avg_items_per_order,
         ifnull(b.total_returned_items, 0) AS total_returned_items,
         ifnull(b.total_refunds, 0) AS total_refunds,
         ifnull(b.orders_with_returns, 0) AS orders_with_returns
  FROM per_customer a LEFT JOIN customer_items b USING (user_id)),
product_sales AS (
  SELECT product_id, sum(quantity) AS total_units_sold, count(DISTINCT order_id) AS order_count,
         count(DISTINCT user_id) AS unique_customers, sum(gross_amount) AS total_revenue,
         sum(net_revenue) AS net_revenue,
         sum(unit_price)::DOUBLE / count(unit_price) AS avg_selling_price,
         min(unit_price) AS min_selling_price, max(unit_price) AS max_selling_price,
         sum(gross_profit) AS total_gross_profit, avg(gross_margin_pct) AS avg_gross_margin_pct,
         count(*) FILTER (is_returned) AS return_count,
         sum(refund_amount) AS total_refund_amount,
         count(*) FILTER (is_quality_issue) AS quality_issue_count,
         ifnull(count(*) FILTER (is_returned)::DOUBLE / nullif(sum(quantity), 0), 0)
           AS return_rate,
         ifnull(count(*) FILTER (is_quality_issue)::DOUBLE
                / nullif(count(*) FILTER (is_returned), 0), 0) AS quality_issue_pct
  FROM lines WHERE is_completed GROUP BY product_id)"""

MARTS = f"""
customers AS (
  SELECT u.user_id AS customer_id, u.email, u.customer_segment, u.country, u.region,
         u.signup_date, ifnull(completed_orders, 0) AS total_orders,
         ifnull(c.total_revenue, 0) AS total_revenue,
         ifnull(avg_order_value, 0) AS avg_order_value, first_order_date, last_order_date,
         ({AS_OF} - last_order_date) AS days_since_last_order,
         ifnull(c.total_orders, 0) AS lifetime_orders,
         ifnull(cancelled_orders, 0) AS cancelled_orders,
         ifnull(high_value_orders, 0) AS high_value_orders,
         ifnull(total_net_revenue, 0) AS total_net_revenue,
         ifnull(total_gross_profit, 0) AS total_gross_profit,
         ifnull(avg_items_per_order, 0) AS avg_items_per_order,
         ifnull(total_returned_items, 0) AS total_returned_items,
         ifnull(total_refunds, 0) AS total_refunds,
         ifnull(orders_with_returns, 0) AS orders_with_returns,
         CASE WHEN c.total_revenue >= 50000000 AND completed_orders >= 8 THEN 'VIP'
              WHEN c.total_revenue >= 30000000 OR completed_orders >= 6 THEN 'Loyal'
              WHEN completed_orders > 0 THEN 'Active' ELSE 'New' END AS customer_tier,
         CASE WHEN first_order_date IS NULL THEN 'Never Ordered'
              WHEN {AS_OF} - last_order_date <= 90 THEN 'Active'
              WHEN {AS_OF} - last_order_date <= 365 THEN 'At Risk'
              ELSE 'Churned' END AS activity_status,
         {AS_OF} - u.signup_date AS days_as_customer,
         ifnull(completed_orders, 0) > 1 AS is_repeat_customer
  FROM s_users u LEFT JOIN customer_orders c USING (user_id)),
order_facts AS (
  SELECT order_id, user_id, order_date, email AS customer_email, customer_segment, country,
         region, order_status, is_completed, is_cancelled, item_count AS total_items,
         total_units AS total_quantity, total_amount AS subtotal, has_returns AS is_returned,
         first_return_date - order_date AS days_to_return,
         total_refund_amount AS refund_amount, net_revenue,
         total_gross_profit AS gross_profit, avg_gross_margin_pct, is_high_value_order,
         item_count > 1 AS is_multi_item_order, order_month, order_week, day_of_week,
         days_since_signup
  FROM full_orders),
item_facts AS (
  SELECT * EXCLUDE (user_id, order_date), user_id AS customer_id, order_date AS order_date_id,
         date_trunc('month', order_date)::DATE AS order_month
  FROM lines WHERE is_completed),
product_mart AS (
  SELECT p.*, ifnull(total_units_sold, 0) AS total_quantity_sold,
         ifnull(s.total_revenue, 0) AS total_revenue, ifnull(order_count, 0) AS total_orders,
         ifnull(unique_customers, 0) AS unique_customers,
         ifnull(return_count, 0) AS total_returns, ifnull(return_rate, 0) AS return_rate,
         ifnull(total_gross_profit, 0) AS gross_profit,
         ifnull(total_gross_profit::DOUBLE / nullif(s.total_revenue::DOUBLE, 0), 0)
           AS profit_margin,
         ifnull(avg_selling_price, 0) AS avg_selling_price,
         ifnull(min_selling_price, 0) AS min_selling_price,
         ifnull(max_selling_price, 0) AS max_selling_price,
         ifnull(s.net_revenue, 0) AS net_revenue,
         ifnull(total_refund_amount, 0) AS total_refund_amount,
         ifnull(quality_issue_count, 0) AS quality_issue_returns,
         ifnull(quality_issue_pct, 0) AS quality_issue_pct,
         CASE WHEN s.total_revenue >= 30000000 AND return_rate < 0.02 THEN 'Star'
              WHEN s.total_revenue >= 25000000 THEN 'Strong'
              WHEN s.total_revenue >= 15000000 THEN 'Average'
              WHEN s.total_revenue > 0 THEN 'Underperforming'
              ELSE 'No Sales' END AS performance_tier
  FROM s_products p LEFT JOIN product_sales s USING (product_id)),
daily AS (
  SELECT order_date AS date_id, count(DISTINCT order_id) AS order_count,
         count(DISTINCT user_id) AS unique_customers, sum(subtotal) AS gross_revenue,
         sum(refund_amount) AS total_refunds, sum(net_revenue) AS net_revenue,
         sum(gross_profit) AS gross_profit, avg(avg_gross_margin_pct) AS avg_order_margin_pct,
         sum(total_items) AS total_items, sum(total_quantity) AS total_units,
         sum(subtotal)::DOUBLE / count(*) AS avg_order_value,
         count(*) FILTER (is_high_value_order) AS high_value_order_count,
         ifnull(sum(subtotal) FILTER (is_high_value_order), 0) AS high_value_revenue,
         count(*) FILTER (is_returned) AS orders_with_returns
  FROM order_facts GROUP BY order_date),
daily_full AS (
  SELECT *, high_value_order_count::DOUBLE / order_count * 100 AS high_value_order_pct,
         ifnull(total_refunds::DOUBLE / nullif(gross_revenue::DOUBLE, 0) * 100, 0)
           AS refund_rate_pct,
         sum(net_revenue) OVER (ORDER BY date_id ROWS UNBOUNDED PRECEDING)
           AS cumulative_revenue,
         (sum(net_revenue) OVER last7)::DOUBLE / count(*) OVER last7 AS revenue_7day_avg
  FROM daily WINDOW last7 AS (ORDER BY date_id ROWS 6 PRECEDING)),
cohorts AS (
  SELECT user_id, date_trunc('month', signup_date)::DATE AS cohort_month FROM s_users),
sizes AS (SELECT cohort_month, count(*) AS cohort_size FROM cohorts GROUP BY 1),
rfm AS (
  SELECT customer_id, email, country, region, customer_segment,
         {AS_OF} - last_order_date AS recency_days, total_orders AS frequency,
         total_revenue AS monetary,
         ntile(5) OVER (ORDER BY {AS_OF} - last_order_date DESC, customer_id) AS r,
         ntile(5) OVER (ORDER BY total_orders, customer_id) AS f,
         ntile(5) OVER (ORDER BY total_revenue, customer_id) AS m
  FROM customers WHERE total_orders > 0),
segment_rules(place, r0, r1, f0, f1, m0, label) AS (VALUES
  (1, 4, 5, 4, 5, 4, 'Champions'), (2, 4, 5, 3, 5, 1, 'Loyal Customers'),
  (3, 4, 5, 1, 2, 1, 'New Customers'), (4, 3, 5, 3, 5, 3, 'Potential Loyalists'),
  (5, 3, 5, 1, 5, 4, 'Big Spenders'), (6, 1, 2, 4, 5, 1, 'At Risk'),
  (7, 1, 2, 2, 5, 1, 'Hibernating'), (8, 1, 2, 1, 2, 1, 'Lost'), (9, 1, 5, 1, 5, 1, 'Other')),
action_rules(place, r0, r1, f0, f1, label) AS (VALUES
  (1, 4, 5, 4, 5, 'Reward them, make them brand advocates'),
  (2, 4, 5, 3, 5, 'Upsell higher value products'),
  (3, 4, 5, 1, 2, 'Build relationship, offer onboarding'),
  (4, 3, 5, 3, 5, 'Offer membership/loyalty program'),
  (5, 1, 2, 4, 5, 'Send personalized reactivation campaigns'),
  (6, 1, 2, 2, 5, 'Offer comeback promotions'),
  (7, 1, 2, 1, 2, 'Revive interest with aggressive offers'),
  (8, 1, 5, 1, 5, 'Monitor and engage')),
rfm_full AS (
  SELECT rfm.* EXCLUDE (r, f, m), r::INT AS recency_score, f::INT AS frequency_score,
         m::INT AS monetary_score, (r + f + m)::INT AS rfm_total_score,
         format('{{}}{{}}{{}}', r, f, m) AS rfm_segment,
         (SELECT arg_min(label, place) FROM segment_rules
          WHERE r BETWEEN r0 AND r1 AND f BETWEEN f0 AND f1 AND m >= m0)
           AS rfm_customer_segment,
         (SELECT arg_min(label, place) FROM action_rules
          WHERE r BETWEEN r0 AND r1 AND f BETWEEN f0 AND f1) AS recommended_action
  FROM rfm)"""

LEVELS = {
    "entities": [ENTITIES],
    "staged": [ENTITIES, STAGED],
    "enriched": [ENTITIES, STAGED, ENRICHED],
    "marts": [ENTITIES, STAGED, ENRICHED, MARTS],
}

CASTS = {
    "d": "DOUBLE",
    "l": "BIGINT",
    "i": "INTEGER",
    "s": "VARCHAR",
}


def pick(columns: str) -> str:
    """Select list from ``name``, ``name:type`` (d double, l bigint, i int, s text) and
    ``name:6`` (rounded to six digits)."""
    out = []
    for word in columns.split():
        name, _, kind = word.partition(":")
        if kind == "6":
            out.append(f"round(CAST({name} AS DOUBLE), 6) AS {name}")
        elif kind:
            out.append(f"CAST({name} AS {CASTS[kind]}) AS {name}")
        else:
            out.append(name)
    return ", ".join(out)


def with_(level: str, body: str, extra: str = "") -> str:
    """``body`` with the shared tables up to ``level`` and ``extra`` ones in front."""
    parts = LEVELS[level] + ([extra] if extra else [])
    return "WITH " + ",".join(parts) + "\n" + body


def choose(level: str, source: str, columns: str, rest: str = "") -> str:
    return with_(level, f"SELECT {pick(columns)} FROM {source} {rest}")


def r2(expression: str, digits: int = 2) -> str:
    return f"round(CAST({expression} AS DOUBLE), {digits})"


def ratio(top: str, bottom: str) -> str:
    return f"(CAST({top} AS DOUBLE) / nullif(CAST({bottom} AS DOUBLE), 0))"
