"""ANSI SQL (for DuckDB) of the queries in ``__spark_entry__``.

One shared prefix rebuilds the star from the raw tables; each query adds its own
SELECT, mostly over one wide view of the sales. Plain windows, joins and subqueries.
"""

from __future__ import annotations

# Published labels, with their limits in SQL; the first that holds counts.
_RFM_CASE = """CASE WHEN r_score >= 4 AND f_score >= 4 AND m_score >= 4 THEN 'Champions'
    WHEN r_score >= 3 AND f_score >= 3 THEN 'Loyal Customers'
    WHEN r_score >= 4 AND f_score <= 2 THEN 'New Customers'
    WHEN r_score <= 2 AND f_score >= 3 THEN 'At Risk'
    WHEN r_score <= 2 AND f_score <= 2 THEN 'Lost' ELSE 'Regular' END"""
_ABC_CASE = """CASE WHEN cumulative_pct <= 80 THEN 'A' WHEN cumulative_pct <= 95 THEN 'B'
    ELSE 'C' END"""
_CHURN_CASE = """CASE WHEN days_since_last IS NULL THEN 'Never Purchased'
    WHEN days_since_last > 180 THEN 'Churned' WHEN days_since_last > 90 THEN 'At Risk'
    ELSE 'Active' END"""
_DISCOUNT_CASE = """CASE WHEN discount_pct = 0 THEN 'No Discount'
    WHEN discount_pct <= 5 THEN '1-5%' WHEN discount_pct <= 10 THEN '6-10%'
    WHEN discount_pct <= 15 THEN '11-15%' ELSE '16-20%' END"""
_SHIPPING_CASE = """CASE WHEN shipping_cost < 5 THEN 'Economy (< 5)'
    WHEN shipping_cost < 8 THEN 'Standard (5-8)' ELSE 'Express (> 8)' END"""

LINE_ORDER = (
    "l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, "
    "l_returnflag, l_linestatus, l_orderkey, l_linenumber"
)
CALENDAR_MONTHS = 84


def rnd(x: str, n: int) -> str:
    """Half away from zero, without a negative zero."""
    s = f"{10**n}.0::DOUBLE"
    return (
        f"(CASE WHEN abs({x}) * {s} < 0.5 THEN 0.0::DOUBLE "
        f"ELSE sign({x}) * floor(abs({x}) * {s} + 0.5::DOUBLE) / {s} END)"
    )


def avg(total: str, count: str, n: int) -> str:
    return rnd(f"(CAST({total} AS DOUBLE) / nullif({count}, 0))", n)


def pct(part: str, whole: str) -> str:
    return f"(CAST({part} AS DOUBLE) * 100.0::DOUBLE / nullif(CAST({whole} AS DOUBLE), 0))"


def _orders(dirty: bool = False) -> str:
    quantity = "CAST(l_quantity AS INT)"
    price = "floor(l_extendedprice * 100 / l_quantity) / 100"
    discount = "CAST(round(l_discount * 100) AS DOUBLE)"
    customer, product = "o_custkey", "l_partkey"
    status = (
        "CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending' "
        "ELSE 'cancelled' END"
    )
    if dirty:
        quantity = f"CASE WHEN l_orderkey % 97 = 0 THEN -{quantity} ELSE {quantity} END"
        price = (
            f"CASE WHEN l_orderkey % 101 = 0 THEN NULL WHEN l_orderkey % 127 = 0 THEN -({price}) "
            f"ELSE {price} END"
        )
        discount = f"CASE WHEN l_orderkey % 103 = 0 THEN 150.0::DOUBLE ELSE {discount} END"
        customer = "o_custkey + CASE WHEN l_orderkey % 107 = 0 THEN 1000000000 ELSE 0 END"
        product = "l_partkey + CASE WHEN l_orderkey % 109 = 0 THEN 1000000000 ELSE 0 END"
        status = f"CASE WHEN l_orderkey % 113 <> 0 THEN {status} END"
    return f"""
    SELECT l_orderkey || '-' || l_linenumber AS order_id,
           CAST({customer} AS VARCHAR) AS customer_id,
           CAST({product} AS VARCHAR) AS product_id,
           {quantity} AS quantity, {price} AS unit_price, {discount} AS discount_pct,
           CAST(o_orderdate AS DATE) AS order_date, {status} AS status,
           {LINE_ORDER}
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""


def _prefix(dirty: bool = False) -> str:
    return f"""
WITH raw_orders AS ({_orders(dirty)}),
clean AS (
    SELECT order_id, customer_id, product_id, quantity,
           CAST(unit_price AS DECIMAL(18,2)) AS unit_price,
           CAST(discount_pct AS INT) AS discount_pct, order_date, status, {LINE_ORDER}
    FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY {LINE_ORDER}) AS rn
          FROM raw_orders)
    WHERE rn = 1 AND status IS DISTINCT FROM 'cancelled' AND quantity > 0 AND unit_price > 0
),
returned AS (
    SELECT DISTINCT l_orderkey || '-' || l_linenumber AS order_id
    FROM lineitem WHERE l_returnflag = 'R'
),
shipped AS (
    SELECT order_id, cost FROM (
        SELECT l_orderkey || '-' || l_linenumber AS order_id,
               CAST(round(l_tax * 100) AS INT) + 3.99::DECIMAL(18,2) AS cost,
               row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                   ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC,
                       l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC,
                       l_linestatus DESC) AS rn
        FROM lineitem WHERE l_tax > 0)
    WHERE rn = 1
),
enriched AS (
    SELECT c.*,
           CAST(round(quantity * unit_price * (100 - discount_pct) * 0.01, 2)
               AS DECIMAL(18,2)) AS total_amount,
           r.order_id IS NOT NULL AS is_returned,
           CAST(coalesce(s.cost, 0) AS DECIMAL(18,2)) AS shipping_cost
    FROM clean c LEFT JOIN returned r ON c.order_id = r.order_id
    LEFT JOIN shipped s ON c.order_id = s.order_id
),
dim_customer AS (
    SELECT row_number() OVER (ORDER BY c_custkey) AS customer_key,
           CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS name,
           lower(replace(c_name, '#', '.')) || '@example.com' AS email,
           r_name AS region, n_name AS city, c_mktsegment AS segment,
           DATE '1995-01-01' + CAST(c_custkey % 365 AS INT) AS signup_date
    FROM customer JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey
),
dim_supplier AS (
    SELECT row_number() OVER (ORDER BY s_suppkey) AS supplier_key,
           CAST(s_suppkey AS VARCHAR) AS supplier_id, s_name AS name, n_name AS country,
           3 + s_suppkey % 28 AS lead_time_days,
           CAST(s_suppkey % 26 + 25 AS DOUBLE) / 10 AS reliability_rating
    FROM supplier JOIN nation ON s_nationkey = n_nationkey
),
priced AS (
    SELECT p_partkey, p_name, p_type, p_size, p_brand, supp,
           CAST(p_retailprice AS DECIMAL(18,2)) AS retail_price,
           CAST(round(CAST(p_retailprice AS DECIMAL(18,2)) * (40 + (p_size % 5) * 10) * 0.01, 2)
               AS DECIMAL(18,2)) AS cost_price
    FROM part LEFT JOIN (SELECT l_partkey, min(l_suppkey) AS supp FROM lineitem GROUP BY 1)
        ON p_partkey = l_partkey
),
dim_product AS (
    SELECT row_number() OVER (ORDER BY p_partkey) AS product_key,
           CAST(p_partkey AS VARCHAR) AS product_id, p_name AS name, p_type AS category,
           CAST(p_size AS VARCHAR) AS subcategory, p_brand AS brand,
           coalesce(supplier_key, 0) AS supplier_key, cost_price, retail_price,
           {rnd('(CAST(retail_price - cost_price AS DOUBLE)'
                ' / nullif(CAST(retail_price AS DOUBLE), 0) * 100)', 1)} AS margin_pct
    FROM priced LEFT JOIN dim_supplier ON CAST(supp AS VARCHAR) = supplier_id
),
dim_date AS (
    SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS BIGINT) AS date_key, d AS full_date,
           CAST(year(d) AS BIGINT) AS year, CAST(quarter(d) AS BIGINT) AS quarter,
           CAST(month(d) AS BIGINT) AS month, monthname(d) AS month_name,
           CAST(weekofyear(d) AS BIGINT) AS week, CAST(isodow(d) AS BIGINT) AS day_of_week,
           dayname(d) AS day_name, isodow(d) >= 6 AS is_weekend,
           'FQ' || quarter(d) || '/' || year(d) AS fiscal_quarter
    FROM (SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '2001-12-31',
              INTERVAL 1 DAY)) AS DATE) AS d)
),
facts AS (
    SELECT e.*, coalesce(customer_key, 0) AS customer_key,
           coalesce(product_key, 0) AS product_key, coalesce(supplier_key, 0) AS supplier_key,
           CAST(year(order_date) * 10000 + month(order_date) * 100 + day(order_date)
               AS BIGINT) AS date_key,
           CAST(total_amount - coalesce(cost_price, 0) * quantity - shipping_cost AS DOUBLE)
               / nullif(CAST(total_amount AS DOUBLE), 0) * 100 AS margin
    FROM enriched e LEFT JOIN dim_customer c ON e.customer_id = c.customer_id
    LEFT JOIN dim_product p ON e.product_id = p.product_id
),
fact_sales AS (
    SELECT row_number() OVER (ORDER BY {LINE_ORDER}) AS order_key, order_id, order_date,
           date_key, customer_key, product_key, supplier_key, quantity, unit_price,
           discount_pct, total_amount, shipping_cost,
           CAST(coalesce({rnd('margin', 1)}, 0) AS DECIMAL(18,1)) AS profit_margin, is_returned
    FROM facts
)"""


# Every sale with the attributes of its members; NULL where a member is unknown.
_SALES = """,
sales AS (
    SELECT f.*, full_date, year, quarter, month, month_name, day_of_week, day_name,
           customer_id, c.name AS customer_name, segment, region,
           product_id, p.name AS product_name, category,
           supplier_id, s.name AS supplier_name, country, reliability_rating
    FROM fact_sales f
    LEFT JOIN dim_date d ON d.date_key = f.date_key
    LEFT JOIN dim_customer c ON c.customer_key = f.customer_key
    LEFT JOIN dim_product p ON p.product_key = f.product_key
    LEFT JOIN dim_supplier s ON s.supplier_key = f.supplier_key
)"""

_AMOUNT = "CAST(sum(total_amount) AS DOUBLE)"
_MEAN_AMOUNT = avg("sum(total_amount)", "count(total_amount)", 2)
_RETURNS = "count(*) FILTER (WHERE is_returned)"


_RFM = f"""{_SALES},
buyers AS (
    SELECT customer_id, customer_name AS name, count(*) AS frequency,
           CAST(DATE '2001-08-02' - max(full_date) AS DOUBLE) AS recency_days,
           sum(total_amount) AS spent
    FROM sales WHERE customer_id IS NOT NULL AND full_date IS NOT NULL GROUP BY ALL
),
tiles AS (
    SELECT customer_id, name, recency_days, frequency, CAST(spent AS DOUBLE) AS monetary,
           CAST(ntile(5) OVER oldest AS BIGINT) AS r_score,
           CAST(ntile(5) OVER rarest AS BIGINT) AS f_score,
           CAST(ntile(5) OVER smallest AS BIGINT) AS m_score
    FROM buyers
    WINDOW oldest AS (ORDER BY recency_days DESC, customer_id),
           rarest AS (ORDER BY frequency, customer_id),
           smallest AS (ORDER BY spent, customer_id)
),
rfm AS (SELECT *, {_RFM_CASE} AS segment FROM tiles)"""

_ABC = f"""{_SALES},
per_product AS (
    SELECT product_id, product_name AS name, category, sum(total_amount) AS amount
    FROM sales WHERE product_id IS NOT NULL GROUP BY ALL
),
shares AS (
    SELECT a.product_id, a.name, a.category, CAST(a.amount AS DOUBLE) AS revenue,
           {rnd(pct('(SELECT sum(b.amount) FROM per_product b WHERE b.amount >= a.amount)',
                    '(SELECT sum(amount) FROM per_product)'), 1)} AS cumulative_pct
    FROM per_product a
),
abc AS (SELECT *, {_ABC_CASE} AS abc_class FROM shares)"""

_COHORT = f"""{_SALES},
starts AS (
    SELECT customer_key, min_by(full_date, date_key) AS started
    FROM (SELECT customer_key, date_key, full_date FROM sales) GROUP BY customer_key
),
cohort AS (
    SELECT strftime(started, '%Y-%m') AS cohort_month,
           datediff('month', started, full_date) AS months_since_first,
           count(DISTINCT customer_key) AS active_customers
    FROM sales JOIN starts USING (customer_key)
    WHERE started IS NOT NULL AND full_date IS NOT NULL GROUP BY ALL
)"""

_LTV = f"""{_SALES},
ltv AS (
    SELECT customer_id, customer_name AS name, segment, region, count(*) AS total_orders,
           {_AMOUNT} AS lifetime_value, {_MEAN_AMOUNT} AS avg_order_value,
           min(full_date) AS first_purchase, max(full_date) AS last_purchase,
           CAST(max(full_date) - min(full_date) AS DOUBLE) AS customer_tenure_days
    FROM sales WHERE customer_id IS NOT NULL AND full_date IS NOT NULL GROUP BY ALL
)"""


def _dirty_issues() -> str:
    def rule(field, value, name, message, where):
        return (
            f"SELECT 'orders' AS source, row_index, order_id, '{field}' AS field, "
            f"{value} AS value, '{name}' AS rule, '{message}' AS message "
            f"FROM positioned WHERE {where}"
        )

    columns = [
        "order_id",
        "customer_id",
        "product_id",
        "quantity",
        "unit_price",
        "discount_pct",
        "order_date",
        "status",
    ]
    rules = [
        rule(c, "'NULL'", "not_null", f"Missing required field: {c}", f"{c} IS NULL")
        for c in columns
    ]
    rules += [
        rule("quantity", "CAST(quantity AS VARCHAR)", "positive_value",
             "Quantity must be positive", "quantity <= 0"),
        rule("unit_price", "CAST(unit_price AS VARCHAR)", "positive_value",
             "Unit price must be positive", "unit_price <= 0"),
        rule("discount_pct", "CAST(discount_pct AS VARCHAR)", "range_check",
             "Discount must be between 0 and 100", "discount_pct < 0 OR discount_pct > 100"),
    ]
    return " UNION ALL ".join(rules)


def _link_issues() -> str:
    return """
    SELECT 'orders' AS source, row_index, order_id, 'customer_id' AS field, customer_id AS value,
           'referential_integrity' AS rule,
           'Customer ID not found in customers table' AS message
    FROM positioned WHERE customer_id NOT IN (SELECT customer_id FROM dim_customer)
    UNION ALL
    SELECT 'orders', row_index, order_id, 'product_id', product_id, 'referential_integrity',
           'Product ID not found in products table'
    FROM positioned WHERE product_id NOT IN (SELECT product_id FROM dim_product)"""


_POSITIONED = f""",
positioned AS (
    SELECT *, row_number() OVER (ORDER BY {LINE_ORDER}) - 1 AS row_index FROM raw_orders
)"""

_SUMMARY = f"""{_POSITIONED},
row_issues AS ({_dirty_issues()}),
link_issues AS ({_link_issues()}),
counts AS (
    SELECT (SELECT count(*) FROM raw_orders) AS total_rows,
           (SELECT count(DISTINCT row_index) FROM row_issues)
               + (SELECT count(*) FROM link_issues) AS invalid_rows
),
summary AS (
    SELECT 'orders' AS source_name, total_rows, total_rows - invalid_rows AS valid_rows,
           invalid_rows,
           {rnd('(CAST(total_rows - invalid_rows AS DOUBLE) / CAST(total_rows AS DOUBLE) * 100)',
                1)} AS quality_score
    FROM counts
    UNION ALL SELECT 'customers', count(*), count(*), 0, 100.0::DOUBLE FROM customer
    UNION ALL SELECT 'products', count(*), count(supp), count(*) - count(supp),
        {rnd('(CAST(count(supp) AS DOUBLE) / CAST(count(*) AS DOUBLE) * 100)', 1)} FROM priced
    UNION ALL SELECT 'suppliers', count(*), count(*), 0, 100.0::DOUBLE FROM supplier
    UNION ALL SELECT 'returns', count(*), count(*), 0, 100.0::DOUBLE
        FROM lineitem WHERE l_returnflag = 'R'
    UNION ALL SELECT 'shipping', count(*), count(*), 0, 100.0::DOUBLE
        FROM lineitem WHERE l_tax > 0
)"""


def oracle_sql() -> dict[str, str]:
    star, dirty = _prefix(), _prefix(dirty=True)
    sql = {}

    sql["revenue_trends"] = star + _SALES + f""",
months AS (
    SELECT year, month, month_name, sum(total_amount) AS amount, count(*) AS orders
    FROM sales WHERE year IS NOT NULL GROUP BY ALL
),
trend AS (
    SELECT *, sum(amount) OVER so_far AS running, lag(amount) OVER so_far AS earlier
    FROM months WINDOW so_far AS (ORDER BY year, month)
)
SELECT year, month, month_name, orders, CAST(amount AS DOUBLE) AS revenue,
       CAST(running AS DOUBLE) AS cumulative_revenue,
       CAST(earlier AS DOUBLE) AS prev_month_revenue,
       {rnd(pct('(amount - earlier)', 'earlier'), 1)} AS mom_growth_pct
FROM trend"""

    sql["seasonal_index"] = star + _SALES + f""",
seasons AS (
    SELECT month, month_name, {_AMOUNT} AS revenue, sum(total_amount) AS amount
    FROM sales WHERE month IS NOT NULL GROUP BY ALL
),
levelled AS (
    SELECT *, {avg('sum(amount) OVER ()', 'count(amount) OVER ()', 2)} AS avg_monthly_revenue
    FROM seasons
)
SELECT month, month_name, revenue, avg_monthly_revenue,
       {rnd('(revenue / avg_monthly_revenue * 100)', 1)} AS seasonal_index FROM levelled"""

    sql["rfm_segmentation"] = star + _RFM + "\nSELECT * FROM rfm"
    sql["segment_counts"] = star + _RFM + (
        "\nSELECT segment, count(*) AS customers FROM rfm GROUP BY segment"
    )
    sql["abc_analysis"] = star + _ABC + "\nSELECT * FROM abc"
    sql["abc_class_counts"] = star + _ABC + """
SELECT label AS abc_class, nullif(count(product_id), 0) AS products
FROM (VALUES ('A'), ('B'), ('C')) AS classes(label) LEFT JOIN abc ON abc_class = label
GROUP BY label"""

    sql["top_products_by_category"] = star + _SALES + f"""
SELECT category, product_name, {_AMOUNT} AS revenue,
       CAST(sum(quantity) AS BIGINT) AS units_sold,
       dense_rank() OVER (PARTITION BY category ORDER BY sum(total_amount) DESC) AS rank
FROM sales WHERE product_id IS NOT NULL GROUP BY category, product_name
QUALIFY rank <= 3"""

    sql["yoy_category_growth"] = star + _SALES + f""",
pair AS (
    SELECT category, sum(total_amount) FILTER (WHERE year = 1999) AS a,
           sum(total_amount) FILTER (WHERE year = 2000) AS b
    FROM sales WHERE product_id IS NOT NULL AND year IS NOT NULL GROUP BY category
)
SELECT category, CAST(a AS DOUBLE) AS revenue_1999, CAST(b AS DOUBLE) AS revenue_2000,
       {rnd(pct('(b - a)', 'a'), 1)} AS yoy_growth_pct FROM pair"""

    sql["cohort_retention"] = star + _COHORT + "\nSELECT * FROM cohort"
    months = ", ".join(
        f"max(active_customers) FILTER (WHERE months_since_first = {m}) AS \"{m}\""
        for m in range(CALENDAR_MONTHS)
    )
    sql["cohort_matrix"] = star + _COHORT + (
        f"\nSELECT cohort_month, {months} FROM cohort GROUP BY cohort_month"
    )

    sql["customer_ltv"] = star + _LTV + "\nSELECT * FROM ltv"
    sql["top20_ltv"] = star + _LTV + (
        "\nSELECT * FROM ltv ORDER BY lifetime_value DESC, customer_id LIMIT 20"
    )

    sql["customer_churn"] = star + _SALES + f""",
bought AS (
    SELECT customer_key, max(full_date) AS latest, count(*) AS orders, {_AMOUNT} AS spent
    FROM sales GROUP BY customer_key
),
state AS (
    SELECT customer_id, name, segment, region, latest AS last_purchase_date,
           coalesce(orders, 0) AS total_orders, spent AS lifetime_value,
           CAST(DATE '2001-08-02' - latest AS BIGINT) AS days_since_last
    FROM dim_customer LEFT JOIN bought USING (customer_key)
)
SELECT *, {_CHURN_CASE} AS churn_status FROM state"""

    sql["basket_analysis"] = star + _SALES + f"""
SELECT segment, concat(year, '-Q', quarter) AS quarter, count(*) AS orders,
       {avg('sum(sales.quantity)', 'count(sales.quantity)', 1)} AS avg_items_per_order,
       {_MEAN_AMOUNT} AS avg_order_value, {_AMOUNT} AS total_revenue
FROM sales WHERE customer_id IS NOT NULL AND year IS NOT NULL
GROUP BY segment, year, sales.quarter"""

    sql["day_of_week_patterns"] = star + _SALES + f""",
weekdays AS (
    SELECT day_name, day_of_week, count(*) AS total_orders, {_AMOUNT} AS total_revenue,
           {_MEAN_AMOUNT} AS avg_order_value, sum(total_amount) AS amount
    FROM sales WHERE day_name IS NOT NULL GROUP BY ALL
),
levelled AS (
    SELECT *, {avg('sum(amount) OVER ()', 'count(amount) OVER ()', 2)} AS usual FROM weekdays
)
SELECT day_name, day_of_week, total_orders, total_revenue, avg_order_value,
       {rnd('((total_revenue - usual) / usual * 100)', 1)} AS pct_vs_avg FROM levelled"""

    sql["discount_impact"] = star + f"""
SELECT {_DISCOUNT_CASE} AS discount_tier, count(*) AS orders,
       {_MEAN_AMOUNT} AS avg_order_value,
       {avg('sum(profit_margin)', 'count(profit_margin)', 1)} AS avg_margin_pct,
       {_AMOUNT} AS total_revenue
FROM fact_sales GROUP BY ALL"""

    sql["shipping_efficiency"] = star + f"""
SELECT {_SHIPPING_CASE} AS shipping_tier, count(*) AS orders,
       {avg('sum(shipping_cost)', 'count(*)', 2)} AS avg_shipping_cost,
       {_MEAN_AMOUNT} AS avg_order_value,
       {rnd(pct('sum(shipping_cost)', 'sum(total_amount)'), 1)} AS shipping_pct
FROM fact_sales WHERE shipping_cost > 0 GROUP BY ALL"""

    sql["return_rate_analysis"] = star + _SALES + f""",
rates AS (
    SELECT product_id IS NOT NULL AS known, category, count(*) AS orders, {_RETURNS} AS returns
    FROM sales GROUP BY ALL
),
compared AS (
    SELECT *, {pct('returns', 'orders')} AS own,
           {pct('sum(returns) OVER ()', 'sum(orders) OVER ()')} AS usual
    FROM rates
)
SELECT category, orders AS total_orders, returns, {rnd('own', 1)} AS return_rate_pct,
       {rnd('usual', 1)} AS company_avg_pct, {rnd('(own - usual)', 1)} AS vs_avg
FROM compared WHERE known"""

    sql["supplier_scorecard"] = star + _SALES + f"""
SELECT supplier_id, supplier_name, country, reliability_rating, count(*) AS total_orders,
       {_AMOUNT} AS total_revenue,
       {avg('sum(profit_margin)', 'count(profit_margin)', 1)} AS avg_margin,
       {rnd(pct(_RETURNS, 'count(*)'), 1)} AS return_rate_pct
FROM sales WHERE supplier_id IS NOT NULL GROUP BY ALL"""

    kpis = f"""
SELECT {_AMOUNT} AS total_revenue, count(DISTINCT order_key) AS total_orders,
       {_MEAN_AMOUNT} AS avg_order_value, count(DISTINCT customer_key) AS unique_customers,
       {rnd(pct(_RETURNS, 'count(*)'), 1)} AS return_rate
FROM fact_sales"""
    sql["kpi_snapshot"] = star + kpis
    sql["kpi_snapshot_dirty"] = dirty + kpis

    category = f"""
SELECT category, {_AMOUNT} AS revenue FROM sales WHERE product_id IS NOT NULL GROUP BY category"""
    sql["category_revenue"] = star + _SALES + category
    sql["category_revenue_dirty"] = dirty + _SALES + category

    sql["agg_daily_sales"] = star + _SALES + f"""
SELECT full_date AS date, {_AMOUNT} AS total_revenue, count(DISTINCT order_key) AS total_orders,
       {_MEAN_AMOUNT} AS avg_order_value, count(DISTINCT customer_key) AS unique_customers
FROM sales WHERE full_date IS NOT NULL GROUP BY full_date"""

    order_columns = """order_id, customer_id, product_id, CAST(quantity AS BIGINT) AS quantity,
       CAST(unit_price AS DOUBLE) AS unit_price, CAST(discount_pct AS DOUBLE) AS discount_pct,
       order_date, status"""
    sql["clean_orders"] = star + f"\nSELECT {order_columns} FROM clean"
    sql["clean_orders_dirty"] = dirty + f"\nSELECT {order_columns} FROM clean"
    sql["enriched_orders"] = star + f"""
SELECT {order_columns}, CAST(total_amount AS DOUBLE) AS total_amount, is_returned,
       CAST(shipping_cost AS DOUBLE) AS shipping_cost FROM enriched"""
    sql["clean_returns"] = f"""
SELECT return_id, order_id, return_date, reason FROM (
    SELECT 'R' || l_orderkey || '-' || l_linenumber AS return_id,
           l_orderkey || '-' || l_linenumber AS order_id, CAST(l_shipdate AS DATE) AS return_date,
           l_linestatus AS reason,
           row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINE_ORDER}) AS rn
    FROM lineitem WHERE l_returnflag = 'R') WHERE rn = 1"""
    sql["clean_shipping"] = """
SELECT l_orderkey || '-' || l_linenumber AS order_id, 'carrier-' || l_suppkey % 5 AS carrier,
       CAST(l_shipdate AS DATE) AS shipped_date,
       CAST(l_shipdate AS DATE) + l_linenumber AS delivered_date,
       CAST(CAST(round(l_tax * 100) AS INT) + 3.99::DECIMAL(18,2) AS DOUBLE) AS shipping_cost
FROM lineitem WHERE l_tax > 0"""

    sql["dim_date"] = star + "\nSELECT * FROM dim_date"
    sql["dim_customer"] = star + "\nSELECT * FROM dim_customer"
    sql["dim_supplier"] = star + "\nSELECT * FROM dim_supplier"
    sql["dim_product"] = star + """
SELECT product_key, product_id, name, category, subcategory, brand, supplier_key,
       CAST(cost_price AS DOUBLE) AS cost_price, CAST(retail_price AS DOUBLE) AS retail_price,
       margin_pct FROM dim_product"""
    fact_columns = """order_key, order_id, date_key, customer_key, product_key, supplier_key,
       CAST(quantity AS BIGINT) AS quantity, CAST(unit_price AS DOUBLE) AS unit_price,
       CAST(discount_pct AS DOUBLE) AS discount_pct, CAST(total_amount AS DOUBLE) AS total_amount,
       CAST(shipping_cost AS DOUBLE) AS shipping_cost,
       CAST(profit_margin AS DOUBLE) AS profit_margin, is_returned"""
    sql["fact_sales"] = star + f"\nSELECT {fact_columns} FROM fact_sales"

    sql["quality_issues"] = dirty + _POSITIONED + f"\n{_dirty_issues()}\nUNION ALL {_link_issues()}"
    sql["referential_issues"] = dirty + _POSITIONED + _link_issues()
    sql["quality_summary"] = dirty + _SUMMARY + "\nSELECT * FROM summary"
    sql["quality_overall"] = dirty + _SUMMARY + f"""
SELECT {rnd('(CAST(sum(CAST(round(quality_score * 10) AS BIGINT)) AS DOUBLE)'
            ' / (count(*) * 10.0::DOUBLE))', 1)} AS overall_score,
       CAST(sum(invalid_rows) AS BIGINT) AS total_quarantined FROM summary"""
    sql["issues_by_source"] = dirty + _SUMMARY + """
SELECT source, count(*) AS issues
FROM (SELECT source FROM row_issues UNION ALL SELECT source FROM link_issues
      UNION ALL SELECT 'products' FROM priced WHERE supp IS NULL) GROUP BY source"""
    score = "((1.0::DOUBLE - CAST(total_issues AS DOUBLE) / greatest(rows_loaded + total_issues, 1)) * 100)"
    sql["warehouse_quality"] = dirty + _SUMMARY + f""",
totals AS (
    SELECT (SELECT count(*) FROM row_issues) + (SELECT count(*) FROM link_issues)
               + (SELECT count(*) FROM priced WHERE supp IS NULL) AS total_issues,
           (SELECT count(*) FROM fact_sales) AS rows_loaded
)
SELECT {rnd(score, 1)} AS quality_score, total_issues, rows_loaded FROM totals"""
    sql["issue_sample"] = dirty + _SUMMARY + """
SELECT source, field, rule, message, value FROM (
    SELECT source, row_index, field, value, rule, message FROM row_issues
    UNION ALL SELECT source, row_index, field, value, rule, message FROM link_issues
) ORDER BY source, row_index, field, rule LIMIT 50"""
    bad = """(SELECT row_index FROM row_issues UNION SELECT row_index FROM link_issues)"""
    sql["quarantined_orders"] = dirty + _SUMMARY + f"""
SELECT order_id, customer_id, product_id, CAST(quantity AS BIGINT) AS quantity, unit_price,
       discount_pct, order_date, status
FROM positioned WHERE row_index IN {bad}"""

    sql["incremental_new_facts"] = star + """
SELECT order_id, date_key, CAST(total_amount AS DOUBLE) AS total_amount
FROM fact_sales WHERE date_key >= 20010101"""
    sql["dimension_upsert"] = """
SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS name,
       CASE WHEN c_acctbal < 5000 THEN 'BATCH' ELSE c_mktsegment END AS segment
FROM customer"""
    sql["stable_keys"] = star + """,
known AS (
    SELECT customer_id, row_number() OVER (ORDER BY customer_key) AS customer_key
    FROM dim_customer WHERE month(signup_date) < 7
)
SELECT customer_key, customer_id FROM known
UNION ALL
SELECT (SELECT max(customer_key) FROM known) + row_number() OVER (ORDER BY customer_key),
       customer_id
FROM dim_customer WHERE month(signup_date) >= 7"""
    sql["declared_issue_counts"] = dirty + _SUMMARY + """
SELECT source, field, rule, count(*) AS issues FROM (
    SELECT source, field, rule FROM row_issues
    UNION ALL SELECT source, field, rule FROM link_issues
    UNION ALL SELECT 'products', 'supplier_id', 'not_null' FROM priced WHERE supp IS NULL
    UNION ALL SELECT 'products', 'cost_price', 'positive_value' FROM priced WHERE cost_price <= 0
    UNION ALL SELECT 'customers', 'segment', 'domain' FROM customer
        WHERE c_mktsegment NOT IN ('B2B', 'B2C')
) GROUP BY ALL"""
    distinct_bad = f"(SELECT count(*) FROM {bad})"
    sql["quality_summary_distinct_rows"] = dirty + _SUMMARY + f"""
SELECT source_name, total_rows,
       CASE WHEN source_name = 'orders' THEN total_rows - {distinct_bad} ELSE valid_rows END
           AS valid_rows,
       CASE WHEN source_name = 'orders' THEN {distinct_bad} ELSE invalid_rows END AS invalid_rows,
       CASE WHEN source_name = 'orders' THEN
           {rnd(f'(CAST(total_rows - {distinct_bad} AS DOUBLE) / CAST(total_rows AS DOUBLE) * 100)',
                1)} ELSE quality_score END AS quality_score
FROM summary"""
    sql["valid_orders"] = sql["quarantined_orders"].replace("row_index IN", "row_index NOT IN")
    sql["csv_customers"] = star + """
SELECT customer_id, name, email, region, city, segment, signup_date FROM dim_customer"""
    sql["jsonl_suppliers"] = star + """
SELECT supplier_id, name, country, lead_time_days, reliability_rating FROM dim_supplier"""
    sql["parquet_products"] = star + """
SELECT product_id, name, category, subcategory, brand, CAST(supp AS VARCHAR) AS supplier_id,
       CAST(d.cost_price AS DOUBLE) AS cost_price, CAST(d.retail_price AS DOUBLE) AS retail_price,
       margin_pct
FROM dim_product d JOIN priced p ON d.product_id = CAST(p.p_partkey AS VARCHAR)"""
    sql["loaded_daily_sales"] = sql["agg_daily_sales"]
    sql["loaded_row_counts"] = star + """
SELECT table_name, records_processed, 'incremental' AS load_mode FROM (
    SELECT 'dim_date' AS table_name, count(*) AS records_processed FROM dim_date
    UNION ALL SELECT 'dim_customer', count(*) FROM dim_customer
    UNION ALL SELECT 'dim_supplier', count(*) FROM dim_supplier
    UNION ALL SELECT 'dim_product', count(*) FROM dim_product
    UNION ALL SELECT 'fact_sales', count(*) FROM (
        SELECT * FROM fact_sales WHERE order_date >= DATE '2001-01-01'))"""
    sql["console_sql"] = star + """
SELECT p.category, d.year || '-Q' || d.quarter AS quarter, count(*) AS orders,
       CAST(DATE '2001-08-02' - min(d.full_date) AS DOUBLE) AS oldest_days
FROM fact_sales f JOIN dim_product p ON f.product_key = p.product_key
JOIN dim_date d ON f.date_key = d.date_key GROUP BY p.category, d.year, d.quarter"""
    return sql
