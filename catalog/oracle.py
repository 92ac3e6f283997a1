"""The registered queries as SQL for an independent engine, over the same tables.

Every text is the chain of layer tables as CTEs plus one final SELECT. Float sums
and averages are rounded through DECIMAL on both sides; integer results are cast
to the width Spark returns.
"""

from __future__ import annotations


def _round(value: str, places: int = 2) -> str:
    return f"CAST(ROUND(CAST({value} AS DECIMAL(38,6)), {places}) AS DOUBLE)"


_RAIN = "CASE WHEN precipitation > 0 THEN 1 ELSE 0 END"
_TEMPERATURE = (
    "CASE WHEN avg_temp < 10 THEN 'Cold' WHEN avg_temp >= 10 AND avg_temp < 20 "
    "THEN 'Moderate' ELSE 'Hot' END"
)
_SALES = (
    "CASE WHEN total_sales < 500 THEN 'Low' WHEN total_sales >= 500 AND total_sales < 2000 "
    "THEN 'Medium' ELSE 'High' END"
)


def _city(key: str) -> str:
    return (
        f"CASE {key} % 5 WHEN 0 THEN 'London' WHEN 1 THEN 'Manchester' "
        f"WHEN 2 THEN 'Birmingham' WHEN 3 THEN 'Leeds' ELSE 'Glasgow' END"
    )


def _dense_id(*keys: str) -> str:
    names = ", ".join(keys)
    return f"row_number() OVER (ORDER BY md5(concat_ws('|', {names})), {names}) - 1"


_TABLES = {
    "raw_sales": """
        SELECT CASE WHEN l.l_returnflag='R' THEN 'C' || CAST(l.l_orderkey AS VARCHAR(20))
                    ELSE CAST(l.l_orderkey AS VARCHAR(20)) END AS InvoiceNo,
               CAST(l.l_partkey AS VARCHAR(20)) AS StockCode,
               CASE WHEN l.l_partkey % 50 = 0 THEN '  ' WHEN l.l_partkey % 50 = 1 THEN NULL
                    WHEN l.l_linenumber = 1 THEN ' ' || p.p_name
                    WHEN l.l_linenumber = 7 THEN upper(p.p_name) ELSE p.p_name END AS Description,
               CAST(CASE WHEN l.l_returnflag='R' THEN -l.l_quantity ELSE l.l_quantity END AS INT)
                   AS Quantity,
               CASE WHEN l.l_linenumber = 6 AND l.l_partkey % 10 = 3 THEN 0.0E0
                    ELSE CAST(round(l.l_extendedprice / l.l_quantity) AS INT) / 100.0E0 END
                   AS UnitPrice,
               CASE WHEN o.o_custkey % 20 = 19 THEN NULL ELSE CAST(o.o_custkey AS DOUBLE) END
                   AS CustomerID,
               n.n_name AS Country, o.o_orderdate AS InvoiceDate
        FROM lineitem l JOIN orders o ON l.l_orderkey=o.o_orderkey
             JOIN customer c ON o.o_custkey=c.c_custkey
             JOIN nation n ON c.c_nationkey=n.n_nationkey
             JOIN part p ON l.l_partkey=p.p_partkey""",
    "raw_weather": f"""
        SELECT {_city("user_id")} AS city,
               CAST(DATE '2022-01-01' + CAST(event_id % 1096 AS INT) AS VARCHAR(10)) AS date,
               max(CAST(floor(value) AS INT)) / 4.0E0 AS temp_max,
               min(CAST(floor(value) AS INT)) / 4.0E0 - 5.0E0 AS temp_min,
               CASE WHEN min(event_id) % 97 = 0 THEN NULL
                    ELSE sum(CASE WHEN event_type IN ('error','view')
                                  THEN CAST(floor(value) AS INT) ELSE 0 END) / 100.0E0 END
                   AS precipitation
        FROM events GROUP BY 1,2""",
    "bronze_sales": f"""
        SELECT InvoiceNo, StockCode, Description, Quantity, UnitPrice,
               CAST(CustomerID AS INTEGER) AS CustomerID, Country,
               {_city("CAST(CustomerID AS INTEGER)")} AS city,
               CAST(InvoiceDate + INTERVAL 324 MONTH AS DATE) AS date
        FROM raw_sales WHERE CustomerID IS NOT NULL""",
    "product_grain": """
        SELECT date, city, StockCode, Description, Quantity, UnitPrice,
               Quantity * UnitPrice AS total_price
        FROM bronze_sales WHERE Quantity > 0 AND UnitPrice > 0""",
    "daily": """
        SELECT date, city, sum(total_price) AS total_sales
        FROM product_grain GROUP BY date, city""",
    "weather": """
        SELECT CAST(date AS DATE) AS date, city, (temp_max + temp_min) / 2 AS avg_temp,
               precipitation FROM raw_weather""",
    "gold": f"""
        SELECT d.date, d.city, total_sales, avg_temp, precipitation,
               {_RAIN} AS is_rainy, {_TEMPERATURE} AS temp_category, {_SALES} AS sales_category,
               avg(total_sales) OVER (PARTITION BY d.city ORDER BY d.date
                   ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS rolling_7d_sales
        FROM daily d JOIN weather w ON d.date = w.date AND d.city = w.city""",
    "dim_date": """
        SELECT date, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
               CAST(day(date) AS INTEGER) AS day,
               CAST(dayofweek(date) + 1 AS INTEGER) AS day_of_week,
               CAST(weekofyear(date) AS INTEGER) AS week_of_year,
               CAST(date AS VARCHAR) AS date_id
        FROM (SELECT DISTINCT date FROM gold)""",
    "dim_location": f"""
        SELECT city, {_dense_id("city")} AS location_id FROM (SELECT DISTINCT city FROM gold)""",
    "dim_product": f"""
        SELECT stock_code, product_description,
               {_dense_id("stock_code", "product_description")} AS product_id
        FROM (SELECT DISTINCT StockCode AS stock_code, trim(Description) AS product_description
              FROM product_grain)
        WHERE stock_code IS NOT NULL AND product_description IS NOT NULL
              AND product_description <> ''""",
    "fact_product": f"""
        SELECT dd.date_id, dl.location_id, p.product_id, s.StockCode AS stock_code,
               s.Description AS product_description, s.Quantity, s.UnitPrice, s.total_price,
               w.avg_temp, w.precipitation, {_RAIN} AS is_rainy, {_TEMPERATURE} AS temp_category
        FROM product_grain s
             JOIN weather w ON s.date = w.date AND s.city = w.city
             JOIN dim_date dd ON dd.date = s.date
             JOIN dim_location dl ON dl.city = s.city
             LEFT JOIN dim_product p ON p.stock_code = s.StockCode""",
    "payload_days": """
        SELECT city, substr(date, 1, 4) AS year, min(date) AS first_day, max(date) AS last_day,
               CAST(count(*) AS INTEGER) AS days
        FROM raw_weather GROUP BY 1, 2""",
}

_CTES = ",\n".join(f"{name} AS ({body})" for name, body in _TABLES.items())

_REASON = (
    "CASE WHEN city = 'Leeds' AND year = '2023' THEN 'daily is missing' "
    "WHEN city = 'Glasgow' AND year = '2022' THEN 'daily.time is empty' "
    "WHEN city = 'Birmingham' AND year = '2024' THEN 'not a JSON object' "
    "WHEN city = 'Manchester' AND year = '2022' THEN 'not a JSON object' END"
)
_META = (
    "CASE city WHEN 'London' THEN {} WHEN 'Manchester' THEN {} WHEN 'Birmingham' THEN {} "
    "WHEN 'Leeds' THEN {} ELSE {} END"
)
_WEEKDAY = (
    "CASE dayofweek(date) WHEN 0 THEN 'Sunday' WHEN 1 THEN 'Monday' WHEN 2 THEN 'Tuesday' "
    "WHEN 3 THEN 'Wednesday' WHEN 4 THEN 'Thursday' WHEN 5 THEN 'Friday' ELSE 'Saturday' END"
)
# A mean may end in half a cent; both engines round it up.
_AVG, _SUM = "ROUND(avg(total_sales) + 1e-9, 2)", "ROUND(sum(total_sales), 2)"
_TOTAL, _ROLLING = _round("total_sales"), _round("rolling_7d_sales", 4)
_MINUTE = "strftime(InvoiceDate, '%Y-%m-%d %H:%M')"
_UPLOAD = (
    "InvoiceNo, StockCode, {}, Quantity, " + _MINUTE + " AS InvoiceDate, UnitPrice, "
    "CustomerID, Country"
)
_RAINY_PRODUCTS = f"""
    SELECT product_description, {_round("total_revenue")} AS total_revenue, total_units
    FROM (SELECT product_description, sum(total_price) AS total_revenue,
                 CAST(sum(Quantity) AS BIGINT) AS total_units
          FROM fact_product WHERE is_rainy = 1 GROUP BY product_description
          ORDER BY sum(total_price) DESC, product_description NULLS FIRST LIMIT 15)"""

_PARTS = {
    "temp_category": "temp_category", "city": "city", "is_rainy": "is_rainy",
    "month": "CAST(month(date) AS INTEGER)", "year": "CAST(year(date) AS INTEGER)",
    "week": "CAST(weekofyear(date) AS INTEGER)", "day_name": _WEEKDAY,
}


def _grouped(report: str, *keys: str) -> str:
    columns = ", ".join(f"{v if k in keys else 'NULL'} AS {k}" for k, v in _PARTS.items())
    by = ", ".join(_PARTS[k] for k in keys)
    return f"SELECT {columns}, '{report}' AS report, {_AVG} AS avg_sales, ROUND(sum(total_sales + 1e-9), 2) AS revenue FROM gold GROUP BY {by}"


_SELECTS = {
    "reports_one_pass": " UNION ALL ".join(
        _grouped(*report)
        for report in (
            ("temperature", "temp_category"), ("monthly", "month"), ("city", "city"), ("rain", "is_rainy"),
            ("weekly", "week"), ("day_of_week", "day_name"),
            ("peak_conditions", "city", "temp_category", "is_rainy"), ("growth", "year", "month"),
        )
    ),
    "scan_csv_encoding": "SELECT "
    + _UPLOAD.format("Description || ' é' AS Description")
    + ", CASE WHEN InvoiceNo LIKE 'C%' THEN 't1' END AS Till FROM raw_sales",
    "upload_date_votes": f"""
        SELECT InvoiceNo, StockCode, {_MINUTE} AS InvoiceDate,
               CASE CAST(StockCode AS INTEGER) % 3 WHEN 0 THEN 'day.csv' WHEN 1 THEN 'month.csv'
                    ELSE 'mixed.csv' END AS _source_file
        FROM raw_sales""",
    "landing_once": """
        SELECT InvoiceNo, StockCode, Quantity,
               CASE WHEN InvoiceNo LIKE 'C%' THEN '2025-02-01T00:00:00+00:00'
                    ELSE '2025-01-01T00:00:00+00:00' END AS _ingested_at
        FROM raw_sales""",
    "upload_rejects": """
        SELECT reason, count(*) AS lines
        FROM (SELECT unnest(CASE CAST(StockCode AS INTEGER) % 50
                       WHEN 7 THEN ['Quantity is not a number: many']
                       WHEN 8 THEN ['UnitPrice is not a number: ?']
                       WHEN 9 THEN ['quoted line break, read with multiline=True',
                                    'quoted line break, read with multiline=True']
                       ELSE [''] END) AS reason
              FROM raw_sales)
        GROUP BY reason""",
    "scan_parquet": "SELECT " + _UPLOAD.format("Description") + " FROM raw_sales",
    "add_provenance": """
        SELECT o_orderkey, o_custkey, o_orderstatus, 'orders.parquet' AS _source_file,
               'retail_sales' AS _entity, '2025-01-01T00:00:00+00:00' AS _ingested_at
        FROM orders""",
    "validate_nonempty": """
        SELECT CAST(year(InvoiceDate) AS VARCHAR) AS batch, count(*) AS rows, TRUE AS accepted
        FROM raw_sales GROUP BY 1
        UNION ALL SELECT 'none', CAST(0 AS BIGINT), FALSE""",
    "year_month_partition": """
        SELECT InvoiceNo, StockCode, strftime(InvoiceDate, '%Y-%m-%d %H:%M') AS InvoiceDate,
               CAST(year(InvoiceDate) AS INTEGER) AS year, strftime(InvoiceDate, '%m') AS month
        FROM (SELECT InvoiceNo, StockCode, CASE WHEN StockCode LIKE '%7' THEN NULL
                     ELSE InvoiceDate END AS InvoiceDate FROM raw_sales)""",
    "raw_sink_roundtrip": "SELECT "
    + _UPLOAD.format("Description")
    + """, '.csv' AS _source_file, 'retail_sales' AS _entity, '2025-01-01T00:00:00+00:00' AS _ingested_at,
           CAST(year(InvoiceDate) AS INTEGER) AS year, CAST(month(InvoiceDate) AS INTEGER) AS month
        FROM raw_sales""",
    "weather_payload_valid": f"""
        SELECT city, first_day, last_day, days FROM payload_days WHERE {_REASON} IS NULL""",
    "weather_payload_rejects": f"""
        SELECT city, {_REASON} AS reason FROM payload_days WHERE {_REASON} IS NOT NULL""",
    "weather_enrich_meta": f"""
        SELECT city, 'GB' AS country,
               CAST({_META.format(51.5074, 53.4808, 52.4862, 53.8008, 55.8642)} AS DOUBLE) AS lat,
               CAST({_META.format(-0.1278, -2.2426, -1.8904, -1.5491, -4.2518)} AS DOUBLE) AS lon,
               '2025-01-01T00:00:00+00:00' AS extracted_at, 'open_meteo_archive' AS source, days
        FROM payload_days WHERE {_REASON} IS NULL""",
    "weather_raw_document": """
        SELECT city, min(date) AS first_day, CAST(count(*) AS INTEGER) AS days,
               25.5::DOUBLE AS elevation, sum(temp_max) AS sunshine,
               '2025-01-01T00:00:00+00:00' AS extracted_at
        FROM raw_weather GROUP BY city, substr(date, 1, 4)""",
    "raw_sales_mixed_uploads": """
        SELECT InvoiceNo, StockCode, CASE WHEN Description <> '' THEN Description END AS Description,
               Quantity, UnitPrice, CustomerID,
               CASE WHEN CAST(StockCode AS INTEGER) % 3 <> 1 THEN Country END AS Country, city,
               CASE WHEN CAST(StockCode AS INTEGER) % 3 <> 0 THEN date END AS date
        FROM bronze_sales""",
    "read_dispatch": """
        SELECT city, date, temp_max, temp_min, precipitation, f.format
        FROM raw_weather CROSS JOIN (VALUES ('parquet'), ('json')) AS f(format)""",
    "write_dispatch": """
        SELECT InvoiceNo, StockCode, Quantity, CustomerID, Country, city, date
        FROM bronze_sales""",
    "schema_evolution": """
        SELECT date, city, avg_temp,
               CASE WHEN date < DATE '2023-01-01' THEN NULL ELSE precipitation END AS precipitation
        FROM weather""",
    "bronze_sales": "SELECT * FROM bronze_sales",
    "bronze_weather": "SELECT city, date, temp_max, temp_min, precipitation FROM raw_weather",
    "filter_customer": """
        SELECT InvoiceNo, StockCode, CustomerID FROM raw_sales WHERE CustomerID IS NOT NULL""",
    "filter_positive": """
        SELECT InvoiceNo, StockCode, Quantity, UnitPrice FROM bronze_sales
        WHERE Quantity > 0 AND UnitPrice > 0""",
    "cast_conform": """
        SELECT o_orderkey, CASE WHEN o_orderpriority LIKE '1%' THEN NULL
                                ELSE CAST(o_custkey AS INTEGER) END AS customer_id,
               CAST(o_orderdate AS DATE) AS order_date,
               CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date_id,
               CAST(o_totalprice > 150000 AS INTEGER) AS is_large
        FROM orders""",
    "assign_city": f"""
        SELECT o_orderkey, customer_id, {_city("customer_id")} AS city
        FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN -o_custkey ELSE o_custkey END
                     AS customer_id FROM orders)""",
    "silver_product_grain": "SELECT * FROM product_grain",
    "silver_sales_daily": f"SELECT date, city, {_TOTAL} AS total_sales FROM daily",
    "silver_weather": "SELECT * FROM weather",
    "sales_latest_only": """
        SELECT InvoiceNo, StockCode,
               CASE WHEN year(InvoiceDate) >= 1998 THEN Quantity + 1 ELSE Quantity END AS Quantity,
               'sales_' || CAST(year(InvoiceDate) AS VARCHAR) || '.csv' AS _source_file,
               CASE WHEN year(InvoiceDate) >= 1998 THEN '2025-02-01T00:00:00+00:00'
                    ELSE '2025-01-01T00:00:00+00:00' END AS _ingested_at
        FROM raw_sales""",
    "weather_latest_only": """
        SELECT city, date,
               CASE WHEN city IN ('London', 'Leeds') THEN temp_max + 1 ELSE temp_max END AS temp_max,
               temp_min, precipitation
        FROM raw_weather""",
    "flag_rainy": f"SELECT date, city, {_RAIN} AS is_rainy FROM weather",
    "bucket_temperature": f"SELECT date, city, {_TEMPERATURE} AS temp_category FROM weather",
    "bucket_sales": f"SELECT date, city, {_SALES} AS sales_category FROM daily",
    "join_sales_weather": f"""
        SELECT d.date, d.city, {_TOTAL} AS total_sales, avg_temp, precipitation
        FROM daily d JOIN weather w ON d.date = w.date AND d.city = w.city""",
    "join_product_weather": """
        SELECT s.date, s.city, StockCode, Description, Quantity, UnitPrice, total_price,
               avg_temp, precipitation
        FROM product_grain s JOIN weather w ON s.date = w.date AND s.city = w.city""",
    "join_left_product": """
        SELECT s.*, p.product_id
        FROM product_grain s LEFT JOIN dim_product p ON p.stock_code = s.StockCode""",
    "rolling_sales": f"""
        SELECT date, city, {_ROLLING} AS rolling_7d_sales
        FROM (SELECT date, city, avg(total_sales) OVER (PARTITION BY city ORDER BY date
                  ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS rolling_7d_sales FROM daily)""",
    "rolling_sales_days": f"""
        SELECT date, city, {_ROLLING} AS rolling_7d_sales
        FROM (SELECT date, city, avg(total_sales) OVER (PARTITION BY city ORDER BY date
                  RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW) AS rolling_7d_sales
              FROM daily)""",
    "gold_sales_weather": f"""
        SELECT date, city, {_TOTAL} AS total_sales, avg_temp, precipitation, is_rainy,
               temp_category, sales_category, {_ROLLING} AS rolling_7d_sales
        FROM gold""",
    "distinct_dates": "SELECT DISTINCT date FROM gold",
    "distinct_cities": "SELECT DISTINCT city FROM gold",
    "distinct_products": """
        SELECT DISTINCT StockCode AS stock_code, trim(Description) AS product_description
        FROM product_grain""",
    "surrogate_location": f"""
        SELECT city, {_dense_id("city")} AS location_id
        FROM (SELECT DISTINCT city FROM bronze_sales)""",
    "surrogate_product": f"""
        SELECT stock_code, product_description,
               {_dense_id("stock_code", "product_description")} AS product_id
        FROM (SELECT DISTINCT StockCode AS stock_code, trim(Description) AS product_description
              FROM bronze_sales)""",
    "growing_keys": f"""
        SELECT p.stock_code, p.product_description, p.product_id, coalesce(lines, 0) AS lines
        FROM (SELECT stock_code, product_description,
                     {_dense_id("stock_code", "product_description").replace("ORDER BY", "ORDER BY late,")}
                       AS product_id, late
              FROM (SELECT StockCode AS stock_code, trim(Description) AS product_description,
                           min(date) >= DATE '2025-01-01' AS late
                    FROM product_grain GROUP BY 1, 2)
              WHERE stock_code IS NOT NULL AND product_description <> '') p
             LEFT JOIN (SELECT StockCode AS stock_code, count(*) AS lines FROM product_grain
                        WHERE date < DATE '2025-01-01' GROUP BY 1) f
               ON f.stock_code = p.stock_code AND NOT late""",
    "dim_date": "SELECT * FROM dim_date",
    "dim_location": "SELECT * FROM dim_location",
    "dim_product": "SELECT * FROM dim_product",
    "fact_sales_weather": f"""
        SELECT date_id, location_id, {_TOTAL} AS total_sales, avg_temp, precipitation, is_rainy,
               {_ROLLING} AS rolling_7d_sales
        FROM gold JOIN dim_date USING (date) JOIN dim_location USING (city)""",
    "fact_sales_weather_product": "SELECT * FROM fact_product",
    "fact_product_matched": f"""
        SELECT dd.date_id, dl.location_id, p.product_id, s.StockCode AS stock_code,
               s.Description AS product_description, s.Quantity, s.UnitPrice, s.total_price,
               w.avg_temp, w.precipitation, {_RAIN} AS is_rainy, {_TEMPERATURE} AS temp_category
        FROM product_grain s
             JOIN weather w ON s.date = w.date AND s.city = w.city
             JOIN dim_date dd ON dd.date = s.date
             JOIN dim_location dl ON dl.city = s.city
             LEFT JOIN dim_product p ON p.stock_code = s.StockCode
                  AND p.product_description = trim(s.Description)""",
    "report_temperature": f"""
        SELECT temp_category, {_AVG} AS avg_sales FROM gold GROUP BY temp_category""",
    "report_monthly": f"""
        SELECT CAST(month(date) AS INTEGER) AS month, {_SUM} AS revenue FROM gold GROUP BY 1""",
    "report_city": f"SELECT city, {_AVG} AS avg_sales FROM gold GROUP BY city",
    "report_rain": f"SELECT is_rainy, {_AVG} AS avg_sales FROM gold GROUP BY is_rainy",
    "report_top_days": f"""
        SELECT date, city, {_TOTAL} AS total_sales
        FROM (SELECT * FROM gold ORDER BY total_sales DESC, date, city LIMIT 10)""",
    "report_sql_views": """
        SELECT 'day' AS grain, city, count(*) AS rows, CAST(sum(is_rainy) AS BIGINT) AS rainy,
               CAST(NULL AS BIGINT) AS units FROM gold GROUP BY city
        UNION ALL
        SELECT 'line', temp_category, count(*), CAST(sum(is_rainy) AS BIGINT),
               CAST(sum(Quantity) AS BIGINT) FROM fact_product GROUP BY temp_category""",
    "report_top_days_label": f"""
        SELECT date, city, {_TOTAL} AS total_sales,
               CAST(date AS VARCHAR) || ' (' || city || ')' AS label
        FROM (SELECT * FROM gold ORDER BY total_sales DESC, date, city LIMIT 10)""",
    "report_weekly": f"""
        SELECT CAST(weekofyear(date) AS INTEGER) AS week, {_AVG} AS avg_sales
        FROM gold GROUP BY 1""",
    "report_day_of_week": f"""
        SELECT {_WEEKDAY} AS day_name, {_AVG} AS avg_sales FROM gold GROUP BY 1""",
    "report_peak_conditions": f"""
        SELECT city, temp_category, is_rainy, {_AVG} AS avg_sales
        FROM gold GROUP BY city, temp_category, is_rainy
        ORDER BY avg_sales DESC, city, temp_category, is_rainy LIMIT 10""",
    "report_growth": f"""
        SELECT CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
               {_SUM} AS revenue
        FROM gold GROUP BY 1, 2""",
    "report_rainy_products": _RAINY_PRODUCTS,
    "report_rainy_products_from_fact": _RAINY_PRODUCTS,
    "check_sample": f"""
        SELECT date, city, {_TOTAL} AS total_sales, avg_temp, precipitation, is_rainy,
               temp_category, sales_category, {_ROLLING} AS rolling_7d_sales
        FROM (SELECT * FROM gold ORDER BY date, city LIMIT 10)""",
    "gold_rules": f"""
        SELECT rule, count(*) AS checked, CAST(count_if(failed) AS BIGINT) AS failed
        FROM (
          SELECT unnest(['date is set', 'city is listed', 'sales are positive',
                         'rain flag fits the rain', 'temperature bucket fits', 'sales bucket fits',
                         'rolling mean is set', 'rain is not negative']) AS rule,
                 unnest([date IS NULL, city NOT IN ('London', 'Manchester', 'Birmingham', 'Leeds', 'Glasgow'),
                         NOT coalesce(total_sales > 0, false), is_rainy IS DISTINCT FROM {_RAIN},
                         temp_category IS DISTINCT FROM {_TEMPERATURE},
                         sales_category IS DISTINCT FROM {_SALES},
                         NOT coalesce(rolling_7d_sales > 0, false), precipitation < 0]) AS failed
          FROM (
          SELECT * REPLACE (CASE WHEN day(date) = 1 THEN 'Paris' ELSE city END AS city,
                   CASE WHEN day(date) = 2 THEN 1 - is_rainy ELSE is_rainy END AS is_rainy,
                   CASE WHEN day(date) = 3 THEN NULL ELSE temp_category END AS temp_category,
                   CASE WHEN day(date) = 4 THEN -total_sales ELSE total_sales END AS total_sales,
                   CASE WHEN day(date) = 5 THEN -1.0 ELSE precipitation END AS precipitation)
          FROM gold))
        GROUP BY rule""",
    "check_row_count": "SELECT count(*) AS row_count FROM gold",
    "check_date_range": "SELECT min(date) AS first_date, max(date) AS last_date FROM gold",
    "check_avg_city": f"""
        SELECT city, {_round("avg(total_sales)", 4)} AS avg_sales FROM gold GROUP BY city""",
    "check_avg_rain": f"""
        SELECT is_rainy, {_round("avg(total_sales)", 4)} AS avg_sales FROM gold GROUP BY is_rainy""",
    "check_avg_temp": f"""
        SELECT temp_category, {_round("avg(total_sales)", 4)} AS avg_sales
        FROM gold GROUP BY temp_category""",
    "check_nulls": "SELECT "
    + ", ".join(
        f"CAST(sum(CAST({c} IS NULL AS INTEGER)) AS BIGINT) AS {c}"
        for c in (
            "date", "city", "total_sales", "avg_temp", "precipitation", "is_rainy",
            "temp_category", "sales_category", "rolling_7d_sales",
        )
    )
    + " FROM gold",
}


def oracle_sql() -> dict[str, str]:
    return {name: f"WITH {_CTES}\n{select}" for name, select in _SELECTS.items()}
