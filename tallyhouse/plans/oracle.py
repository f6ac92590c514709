"""The registered queries as ANSI SQL over the sample tables, for DuckDB."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

AUDIT = "TIMESTAMP '2024-06-01 00:00:00'"


def _continent(country_id: str) -> str:
    return f"""CASE left({country_id}, 2)
        WHEN '11' THEN 'Europe'
        WHEN '22' THEN 'Africa'
        WHEN '33' THEN 'Asia'
        WHEN '44' THEN 'Australia and Oceania'
        WHEN '55' THEN 'North America'
        WHEN '66' THEN 'South America'
        WHEN '13' THEN 'Transcontinental (Europe/Asia)'
        WHEN '10' THEN 'Europe/Global Territories (UK, France)'
        WHEN '50' THEN 'North America/Global Territories (USA)'
        ELSE 'UNKNOWN' END"""


# Named sub-queries, each with the names it needs.
PARTS: dict[str, tuple[tuple[str, ...], str]] = {
    "nations": ((), """
        SELECT n_nationkey,
               CASE r_name WHEN 'AFRICA' THEN '22' WHEN 'AMERICA' THEN '55'
                           WHEN 'ASIA' THEN '33' WHEN 'EUROPE' THEN '11'
                           WHEN 'MIDDLE EAST' THEN '99' END
               || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS country_id,
               n_name AS country_name
        FROM nation JOIN region ON n_regionkey = r_regionkey"""),
    "countries": (("nations",), f"""
        SELECT country_id, country_name, {_continent('country_id')} AS continent FROM nations"""),
    "known": (("countries",), """
        SELECT * FROM countries WHERE continent <> 'UNKNOWN'"""),
    "order_lines": (("nations",), """
        SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey JOIN nations ON c_nationkey = n_nationkey"""),
    "tx": (("order_lines",), f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS invoice_no,
               CAST(l_partkey AS VARCHAR) AS stock_code,
               CAST(l_quantity AS INTEGER) AS quantity,
               o_orderdate AS invoice_date,
               CAST(o_custkey AS VARCHAR) AS customer_id,
               country_id,
               CAST(l_suppkey % 6 + 1 AS VARCHAR) AS region_code,
               {AUDIT} AS ingestion_timestamp
        FROM order_lines"""),
    "prices": ((), """
        SELECT stock_code || '-' || CAST(price_date AS VARCHAR) AS product_id,
               stock_code, unit_price, price_date
        FROM (SELECT CAST(l_partkey AS VARCHAR) AS stock_code,
                     CAST(l_shipdate AS DATE) AS price_date,
                     floor(max(l_extendedprice / l_quantity) * 100 + 0.5) / 100 AS unit_price
              FROM lineitem GROUP BY ALL)"""),
    "intervals": (("prices",), """
        SELECT product_id, stock_code, unit_price, price_date AS effective_start_date,
               lead(price_date) OVER (PARTITION BY stock_code ORDER BY price_date)
                 AS effective_end_date
        FROM prices"""),
    "bands": ((), """
        SELECT stock_code || '-' || CAST(price_date AS VARCHAR) AS product_id,
               stock_code, unit_price, price_date, source
        FROM (SELECT CAST(l_partkey AS VARCHAR) AS stock_code,
                     CAST(l_shipdate AS DATE) AS price_date, l_linestatus AS source,
                     floor(max(l_extendedprice / l_quantity) / 2000) * 2000 AS unit_price
              FROM lineitem GROUP BY ALL)"""),
    "batch": (("bands",), "SELECT * EXCLUDE (source) FROM bands WHERE source = 'O'"),
    "history": (("bands",), "SELECT * EXCLUDE (source) FROM bands WHERE source = 'F'"),
    "log_lines": (("order_lines",), """
        SELECT CASE
            WHEN l_linenumber = 3 AND l_returnflag = 'R' AND l_linestatus = 'F' THEN '   '
            WHEN l_linenumber = 4 AND l_returnflag = 'R' THEN head
            ELSE concat(head, sep, qty, sep, date_text, sep, o_custkey, sep, geo) END AS value
        FROM (
            SELECT *, concat(o_orderkey, sep, l_partkey) AS head
            FROM (
                SELECT *,
                    CASE WHEN l_linestatus = 'O' THEN ' , ' ELSE ',' END AS sep,
                    CASE left(o_orderpriority, 1)
                        WHEN '1' THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
                        WHEN '2' THEN strftime(o_orderdate, '%d/%m/%Y')
                        WHEN '3' THEN strftime(o_orderdate, '%Y-%m-%d')
                        WHEN '4' THEN strftime(o_orderdate, '%m-%d-%Y')
                        ELSE 'unknown' END AS date_text,
                    CASE WHEN l_linenumber = 7 THEN 'x'
                         WHEN l_linenumber = 5 THEN CAST(l_quantity AS INTEGER) || '.7'
                         WHEN l_linenumber = 2 AND l_returnflag = 'N'
                         THEN chr(9) || CAST(l_quantity AS INTEGER) || chr(9) || ' '
                         ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS qty,
                    CASE WHEN l_linenumber = 6 AND o_orderstatus = 'P' THEN country_id
                         ELSE country_id || '-' || (l_suppkey % 6 + 1) END AS geo
                FROM order_lines))"""),
    "log_fields": (("log_lines",), """
        SELECT value, trim(f[1]) AS invoice_no, trim(f[2]) AS stock_code,
               CAST(trunc(try_cast(trim(f[3], ' ' || chr(9)) AS DOUBLE)) AS INTEGER) AS quantity, trim(f[4]) AS date_text,
               trim(f[5]) AS customer_id, trim(f[6]) AS geo
        FROM (SELECT value, string_split(value, ',') AS f FROM log_lines
              WHERE trim(value) <> '')"""),
    "log_tagged": (("log_fields",), f"""
        SELECT *, coalesce(parsed, TIMESTAMP '1900-01-01 00:00:00') AS invoice_date,
               parsed IS NULL AS is_date_error,
               left(geo, 4) AS country_id, right(geo, 1) AS region_code,
               {AUDIT} AS ingestion_timestamp,
               CASE WHEN coalesce(invoice_no, '') = '' OR coalesce(stock_code, '') = '' THEN 'key'
                    WHEN quantity IS NULL THEN 'quantity'
                    WHEN geo IS NULL OR NOT contains(geo, '-') THEN 'region' END AS reject_reason
        FROM (SELECT *, coalesce(try_strptime(date_text, '%Y-%m-%d %H:%M:%S'),
                                 try_strptime(date_text, '%Y-%m-%d'),
                                 try_strptime(date_text, '%d/%m/%Y'),
                                 try_strptime(date_text, '%m-%d-%Y')) AS parsed
              FROM log_fields)"""),
    "product_lines": ((), """
        SELECT concat_ws(',', l_partkey,
                 CASE WHEN p_size >= 45 THEN p_name || ', ' || p_brand ELSE p_name END,
                 pad || CASE WHEN l_discount >= 0.1 THEN 'on request'
                      ELSE CAST(CAST(floor(l_extendedprice / l_quantity * 100 + 0.5) / 100
                                     AS DECIMAL(12,2)) AS VARCHAR) END || pad,
                 strftime(l_shipdate, '%Y-%m-%d')) AS value
        FROM lineitem
        JOIN (SELECT *, CASE WHEN p_size <= 5 THEN chr(9) ELSE '' END AS pad FROM part)
          ON l_partkey = p_partkey"""),
    "product_tagged": (("product_lines",), """
        SELECT *, CASE WHEN coalesce(stock_code, '') = '' THEN 'key'
                       WHEN unit_price IS NULL THEN 'price'
                       WHEN price_date IS NULL THEN 'date' END AS reject_reason
        FROM (SELECT value, trim(f[1]) AS stock_code, trim(f[2]) AS description,
                     try_cast(trim(f[3], ' ' || chr(9)) AS DOUBLE) AS unit_price,
                     CAST(try_strptime(trim(f[4]), '%Y-%m-%d') AS DATE) AS price_date
              FROM (SELECT value, string_split(value, ',') AS f FROM product_lines))"""),
    "country_rows": (("nations",), f"""
        SELECT country_id, country_name || ' v' || s_suppkey AS country_name,
               {_continent('country_id')} AS continent, s_suppkey AS load_no
        FROM supplier JOIN nations ON s_nationkey = n_nationkey"""),
    "priced": (("tx", "prices"), """
        SELECT tx.*, p.product_id, p.unit_price, p.price_date
        FROM tx ASOF JOIN prices p
          ON tx.stock_code = p.stock_code AND CAST(tx.invoice_date AS DATE) >= p.price_date"""),
    "priced_left": (("tx", "prices"), """
        SELECT tx.*, p.product_id, p.unit_price, p.price_date
        FROM tx ASOF LEFT JOIN prices p
          ON tx.stock_code = p.stock_code AND CAST(tx.invoice_date AS DATE) >= p.price_date"""),
    "fact": (("priced", "known"), f"""
        SELECT concat_ws('-', invoice_no, invoice_date) AS transaction_id,
               invoice_no, product_id, country_id, region_code, customer_id, quantity,
               unit_price, quantity * unit_price AS total_amount, '$' AS currency,
               invoice_date, {AUDIT} AS ingestion_timestamp
        FROM priced WHERE country_id IN (SELECT country_id FROM known)"""),
    "stats": (("tx",), """
        SELECT stock_code, median(quantity) AS median_qty, stddev_samp(quantity) AS stddev_qty
        FROM tx GROUP BY stock_code"""),
    "flagged": (("tx", "stats"), """
        SELECT tx.*, median_qty, stddev_qty,
               median_qty + 2 * coalesce(stddev_qty, 0) AS median_stddev
        FROM tx JOIN stats USING (stock_code)
        WHERE quantity > median_qty + 2 * coalesce(stddev_qty, 0)"""),
    "event_tx": ((), """
        SELECT CAST(event_id AS VARCHAR) AS invoice_no, CAST(user_id AS VARCHAR) AS customer_id,
               event_type AS stock_code, "value" AS quantity, ts AS invoice_date FROM events"""),
    "event_stats": (("event_tx",), """
        SELECT stock_code, median(quantity) AS median_qty, stddev_samp(quantity) AS stddev_qty
        FROM event_tx GROUP BY stock_code"""),
    "event_flagged": (("event_tx", "event_stats"), """
        SELECT event_tx.*, median_qty, stddev_qty, median_qty + 2 * stddev_qty AS median_stddev
        FROM event_tx JOIN event_stats USING (stock_code)
        WHERE quantity > median_qty + 2 * stddev_qty"""),
    "records": (("flagged",), f"""
        SELECT invoice_no AS order_id, stock_code, quantity, median_qty,
               stddev_qty AS std_deviation,
               (quantity - median_qty) / nullif(stddev_qty, 0) AS z_score,
               {AUDIT} AS alert_timestamp, 'NEW' AS status
        FROM flagged"""),
}


def _with_parts(needs: tuple[str, ...], sql: str) -> str:
    ordered: list[str] = []

    def add(name: str) -> None:
        for need in PARTS[name][0]:
            add(need)
        if name not in ordered:
            ordered.append(name)

    for name in needs:
        add(name)
    if not ordered:
        return sql
    return "WITH " + ",\n".join(f"{n} AS ({PARTS[n][1]})" for n in ordered) + "\n" + sql


def _oracle(name: str, needs: tuple[str, ...], sql: str) -> None:
    ORACLE[name] = _with_parts(needs, sql)


LOG_COLUMNS = """invoice_no, stock_code, quantity, invoice_date, customer_id, country_id,
    region_code, ingestion_timestamp, is_date_error"""
ERROR_COLUMNS = f"""invoice_no, stock_code, customer_id, quantity, invoice_date, country_id,
    region_code, error_message, CAST(0 AS INTEGER) AS retry_count,
    {AUDIT} AS ingestion_timestamp, FALSE AS is_date_error"""
MONEY = "CAST(sum(CAST(total_amount AS DECIMAL(18,2))) AS DOUBLE)"

# --- parsing and derivation

_oracle("parse_log_lines", ("log_tagged",),
        f"SELECT {LOG_COLUMNS} FROM log_tagged WHERE reject_reason IS NULL")
_oracle("ingest_twice", ("log_tagged",),
        f"SELECT {LOG_COLUMNS} FROM log_tagged WHERE reject_reason IS NULL")
_oracle("parse_log_rejects", ("log_tagged",),
        "SELECT value, reject_reason FROM log_tagged WHERE reject_reason IS NOT NULL")
_oracle("parse_products", ("product_tagged",), """
    SELECT stock_code || '-' || CAST(price_date AS VARCHAR) AS product_id, stock_code,
           description, unit_price, price_date
    FROM product_tagged WHERE reject_reason IS NULL""")
_oracle("parse_product_rejects", ("product_tagged",),
        "SELECT value, reject_reason FROM product_tagged WHERE reject_reason IS NOT NULL")
_oracle("text_round_trip", ("product_lines",), "SELECT value FROM product_lines")
_oracle("parse_countries", ("country_rows",),
        "SELECT country_id, country_name, continent FROM country_rows")
_oracle("parse_date_formats", ("log_tagged",), """
    SELECT date_text, count(*) AS n_lines, invoice_date AS parsed, is_date_error
    FROM log_tagged WHERE date_text IS NOT NULL GROUP BY ALL""")
_oracle("continent_counts", ("tx",), f"""
    SELECT {_continent('country_id')} AS continent, count(*) AS n_lines,
           CAST(sum(quantity) AS BIGINT) AS total_quantity,
           min(quantity) AS min_quantity, max(quantity) AS max_quantity
    FROM tx GROUP BY 1""")
TIME_ATTRIBUTES = """CAST(year(t) AS INTEGER) AS year, CAST(quarter(t) AS INTEGER) AS quarter,
    CAST(month(t) AS INTEGER) AS month, CAST(day(t) AS INTEGER) AS day,
    CAST(dayofweek(t) + 1 AS INTEGER) AS day_of_week, dayofweek(t) IN (0, 6) AS is_weekend"""
_oracle("order_time_attributes", (), f"""
    SELECT o_orderkey, {TIME_ATTRIBUTES}
    FROM (SELECT o_orderkey, o_orderdate AS t FROM orders)""")
_oracle("event_time_attributes", (), f"""
    SELECT *, count(*) AS n_events
    FROM (SELECT {TIME_ATTRIBUTES} FROM (SELECT ts AS t FROM events)) GROUP BY ALL""")
_oracle("txn_key_concat", ("tx",), """
    SELECT invoice_no, stock_code, concat_ws('-', invoice_no, invoice_date) AS transaction_id
    FROM tx""")
_oracle("txn_key_sha", ("tx",), """
    SELECT invoice_no, stock_code,
           sha256(concat_ws('-', invoice_no, invoice_date, stock_code, customer_id, quantity))
             AS transaction_id
    FROM tx""")
_oracle("transaction_lines", ("tx",), """
    SELECT concat_ws(',', invoice_no, stock_code, quantity, invoice_date, customer_id) AS value
    FROM tx""")
_oracle("row_count", ("tx",), "SELECT count(*) AS n_rows FROM tx")
_oracle("distinct_products", ("tx",), "SELECT DISTINCT stock_code FROM tx")
_oracle("preview", ("tx",), "SELECT * FROM tx ORDER BY ALL LIMIT 10")

# --- slowly changing dimensions

_oracle("dedup_latest_price", ("prices",), """
    SELECT * FROM prices
    QUALIFY row_number() OVER (PARTITION BY stock_code ORDER BY price_date DESC) = 1""")
NEWEST = "QUALIFY row_number() OVER (PARTITION BY stock_code ORDER BY price_date DESC) = 1"
_oracle("scd2_bootstrap", ("bands",), """
    SELECT product_id, stock_code, max(unit_price) AS unit_price, price_date
    FROM bands GROUP BY ALL""")
_oracle("scd2_bootstrap_merge", ("bands",), """
    SELECT product_id, stock_code, unit_price, price_date
    FROM (SELECT *, lag(unit_price) OVER (PARTITION BY stock_code ORDER BY price_date) AS before
          FROM (SELECT product_id, stock_code, max(unit_price) AS unit_price, price_date
                FROM bands GROUP BY ALL))
    WHERE before IS DISTINCT FROM unit_price""")
CHANGES = f"""
    SELECT fresh.* FROM (SELECT * FROM batch {NEWEST}) fresh
    LEFT JOIN (SELECT * FROM history {NEWEST}) latest USING (stock_code)
    WHERE (latest.unit_price IS NULL OR fresh.unit_price <> latest.unit_price)
      AND NOT EXISTS (SELECT 1 FROM history h
                      WHERE h.stock_code = fresh.stock_code AND h.price_date = fresh.price_date
                        AND h.unit_price = fresh.unit_price)"""
_oracle("scd2_changes", ("batch", "history"), CHANGES)
_oracle("scd2_changes_twice", ("batch", "history"), f"SELECT * FROM history UNION ALL {CHANGES}")
_oracle("scd2_late_changes", ("batch", "history"), """
    SELECT product_id, stock_code, unit_price, price_date
    FROM (SELECT *, lag(unit_price) OVER (PARTITION BY stock_code ORDER BY price_date, side)
                      AS before
          FROM (SELECT *, 1 AS side FROM batch UNION ALL SELECT *, 0 FROM history))
    WHERE side = 1 AND before IS DISTINCT FROM unit_price""")
_oracle("scd2_late_merge", ("batch", "history"), """
    SELECT product_id, stock_code, unit_price, price_date
    FROM (SELECT *, lag(unit_price) OVER (PARTITION BY stock_code ORDER BY price_date) AS before
          FROM (SELECT * FROM batch
                UNION ALL
                SELECT h.* FROM history h ANTI JOIN batch USING (stock_code, price_date)))
    WHERE before IS DISTINCT FROM unit_price""")
_oracle("scd2_intervals", ("intervals",),
        "SELECT *, effective_end_date IS NULL AS is_current FROM intervals")
LAST_LOAD = "QUALIFY row_number() OVER (PARTITION BY country_id ORDER BY load_no DESC) = 1"
_oracle("scd0_countries", ("country_rows",), f"SELECT * FROM country_rows {LAST_LOAD}")
_oracle("dim_countries", ("country_rows",),
        f"SELECT country_id, country_name, continent FROM country_rows {LAST_LOAD}")
_oracle("dim_products", ("intervals",), """
    SELECT i.*, '$' AS currency, p_name AS description
    FROM intervals i JOIN part ON stock_code = CAST(p_partkey AS VARCHAR)""")
_oracle("dim_customers", ("tx",), "SELECT DISTINCT customer_id FROM tx")
_oracle("upsert_latest", ("batch", "history"), f"""
    SELECT * FROM batch {NEWEST}
    UNION ALL
    SELECT * FROM (SELECT * FROM history {NEWEST})
    WHERE stock_code NOT IN (SELECT stock_code FROM batch)""")

# --- reference checks and joins

_oracle("fk_valid", ("tx", "known"), "SELECT tx.* FROM tx SEMI JOIN known USING (country_id)")
_oracle("fk_missing", ("tx", "known"), "SELECT tx.* FROM tx ANTI JOIN known USING (country_id)")
_oracle("fk_errors", ("tx", "known"), f"""
    SELECT {ERROR_COLUMNS}
    FROM (SELECT tx.*, 'Missing Country ID' AS error_message
          FROM tx ANTI JOIN known USING (country_id))""")
_oracle("fk_errors_two_rules", ("tx", "known", "prices"), f"""
    SELECT {ERROR_COLUMNS}
    FROM (SELECT *, CASE WHEN country_id NOT IN (SELECT country_id FROM known)
                         THEN 'Missing Country ID'
                         WHEN stock_code NOT IN (SELECT stock_code FROM prices)
                         THEN 'Missing Product' END AS error_message
          FROM (SELECT * FROM tx
                UNION ALL
                SELECT 'e' || event_id, event_type, CAST(trunc("value") AS INTEGER), ts,
                       CAST(user_id AS VARCHAR), '2200', '1', {AUDIT}
                FROM events))
    WHERE error_message IS NOT NULL""")
_oracle("error_payload", ("tx", "known"), f"""
    SELECT sha256(payload) AS error_id, payload, 'Missing Country ID' AS error_message,
           CAST(NULL AS VARCHAR) AS source_file, CAST(0 AS INTEGER) AS attempts,
           {AUDIT} AS ingestion_timestamp
    FROM (SELECT CAST(to_json(struct_pack(
              invoice_no := invoice_no, stock_code := stock_code, customer_id := customer_id,
              quantity := CAST(quantity AS VARCHAR),
              invoice_date := CAST(invoice_date AS VARCHAR), country_id := country_id,
              region_code := region_code)) AS VARCHAR) AS payload
          FROM tx ANTI JOIN known USING (country_id))""")
_oracle("asof_price", ("priced",), "SELECT * FROM priced")
_oracle("asof_union_last", ("priced",), "SELECT * FROM priced")
_oracle("asof_timestamp_prices", ("priced",), """
    SELECT * EXCLUDE (price_date), CAST(price_date AS TIMESTAMP) AS price_time FROM priced""")
_oracle("asof_left", ("priced_left",), "SELECT * FROM priced_left")
_oracle("asof_unpriced", ("priced_left",), """
    SELECT * EXCLUDE (product_id, unit_price, price_date)
    FROM priced_left WHERE product_id IS NULL""")
_oracle("asof_one_per_key", ("priced",), """
    SELECT * FROM priced
    QUALIFY row_number() OVER (
        PARTITION BY invoice_no, stock_code, customer_id
        ORDER BY price_date DESC, country_id DESC, ingestion_timestamp DESC, invoice_date DESC,
                 product_id DESC, quantity DESC, region_code DESC, unit_price DESC) = 1""")
_oracle("price_validity_join", ("tx", "intervals"), """
    SELECT tx.*, i.product_id, p_name AS description, i.unit_price, '$' AS currency,
           i.effective_start_date, i.effective_end_date
    FROM tx JOIN intervals i ON tx.stock_code = i.stock_code
      AND i.effective_start_date <= CAST(invoice_date AS DATE)
      AND (i.effective_end_date IS NULL OR CAST(invoice_date AS DATE) < i.effective_end_date)
    JOIN part ON i.stock_code = CAST(p_partkey AS VARCHAR)""")
_oracle("fact_transactions", ("fact",), "SELECT * FROM fact")
_oracle("fact_hashed_keys", ("priced", "known"), f"""
    SELECT sha256(concat_ws('-', invoice_no, invoice_date, stock_code, customer_id, quantity))
             AS transaction_id,
           invoice_no, product_id, country_id, region_code, customer_id, quantity,
           unit_price, quantity * unit_price AS total_amount, 'GBP' AS currency,
           invoice_date, {AUDIT} AS ingestion_timestamp
    FROM priced WHERE country_id IN (SELECT country_id FROM known)""")
_oracle("fact_unpriced", ("priced_left", "known"), f"""
    SELECT {ERROR_COLUMNS}
    FROM (SELECT *, 'Missing Price' AS error_message FROM priced_left
          WHERE product_id IS NULL AND country_id IN (SELECT country_id FROM known))""")
_oracle("fact_date_errors", ("log_tagged",), f"""
    SELECT invoice_no, stock_code, customer_id, quantity, invoice_date, country_id, region_code,
           'Invalid Date' AS error_message, CAST(0 AS INTEGER) AS retry_count,
           {AUDIT} AS ingestion_timestamp, TRUE AS is_date_error
    FROM log_tagged WHERE reject_reason IS NULL AND is_date_error""")
_oracle("recover_twice", ("priced",), f"""
    SELECT sha256(concat_ws('-', invoice_no, invoice_date, stock_code, customer_id, quantity,
                            country_id, region_code, line_no)) AS transaction_id,
           invoice_no, product_id, country_id, region_code, customer_id, quantity,
           unit_price, quantity * unit_price AS total_amount, '$' AS currency,
           invoice_date, {AUDIT} AS ingestion_timestamp
    FROM (SELECT *, row_number() OVER (PARTITION BY invoice_no, invoice_date, stock_code,
                        customer_id, quantity, country_id, region_code) AS line_no
          FROM priced)""")
_oracle("fact_two_drops", ("log_tagged", "prices", "known"), f"""
    SELECT sha256(concat_ws('-', invoice_no, invoice_date, r.stock_code, customer_id, quantity,
                            country_id, region_code, line_no)) AS transaction_id,
           invoice_no, product_id, country_id, region_code, customer_id, quantity,
           unit_price, quantity * unit_price AS total_amount, '$' AS currency,
           invoice_date, {AUDIT} AS ingestion_timestamp
    FROM (SELECT *, row_number() OVER (PARTITION BY invoice_no, invoice_date, stock_code,
                        customer_id, quantity, country_id, region_code) AS line_no
          FROM (SELECT * FROM log_tagged WHERE length(value) % 3 < 2
                UNION ALL SELECT * FROM log_tagged WHERE length(value) % 3 > 0)
          WHERE reject_reason IS NULL) r
    ASOF JOIN prices p ON r.stock_code = p.stock_code AND CAST(invoice_date AS DATE) >= p.price_date
    WHERE NOT is_date_error AND country_id IN (SELECT country_id FROM known)""")
RECOVERED = f"""
    SELECT concat_ws('-', invoice_no, invoice_date) AS transaction_id,
           invoice_no, product_id, country_id, region_code, customer_id, quantity,
           unit_price, quantity * unit_price AS total_amount, '$' AS currency,
           invoice_date, {AUDIT} AS ingestion_timestamp
    FROM priced WHERE country_id NOT IN (SELECT country_id FROM known)"""
_oracle("recover_fixed", ("priced", "known"), RECOVERED)
_oracle("replay_payloads", ("priced", "known"), RECOVERED)
_oracle("recover_still_broken", ("priced_left",), f"""
    SELECT invoice_no, stock_code, customer_id, quantity, invoice_date, country_id, region_code,
           'Missing Price' AS error_message, CAST(1 AS INTEGER) AS retry_count,
           {AUDIT} AS ingestion_timestamp, FALSE AS is_date_error
    FROM priced_left WHERE product_id IS NULL""")

# --- anomalies

_oracle("product_baseline", ("stats",),
        "SELECT stock_code, median_qty, round(stddev_qty, 6) AS stddev_qty FROM stats")
_oracle("product_baseline_approx", ("tx",), """
    SELECT stock_code, CAST(quantile_disc(quantity, 0.5) AS DOUBLE) AS median_qty,
           round(stddev_samp(quantity), 6) AS stddev_qty
    FROM tx GROUP BY stock_code""")
_oracle("event_baseline", ("event_stats",), """
    SELECT stock_code, round(median_qty, 6) AS median_qty, round(stddev_qty, 6) AS stddev_qty
    FROM event_stats""")
_oracle("anomalies", ("flagged",), """
    SELECT invoice_no, customer_id, stock_code, quantity, median_qty,
           round(median_stddev, 6) AS median_stddev FROM flagged""")
_oracle("event_anomalies", ("event_flagged",), """
    SELECT invoice_no, customer_id, stock_code, quantity, round(median_qty, 6) AS median_qty,
           round(median_stddev, 6) AS median_stddev FROM event_flagged""")
_oracle("alert_lines", ("flagged",), """
    SELECT printf('%-15s %-15s %-15s %-10s %-10.2f %-10.2f', invoice_no, customer_id, stock_code,
                  CAST(quantity AS VARCHAR), median_qty, median_stddev) AS line
    FROM flagged""")
_oracle("anomaly_records", ("records",), """
    SELECT * REPLACE (round(std_deviation, 6) AS std_deviation, round(z_score, 6) AS z_score)
    FROM records""")
_oracle("baseline_refresh", ("tx", "records"), """
    SELECT stock_code, median(quantity) AS median_qty,
           round(stddev_samp(quantity), 6) AS stddev_qty
    FROM tx ANTI JOIN (SELECT order_id AS invoice_no, stock_code, quantity
                       FROM records WHERE z_score >= 2.05)
      USING (invoice_no, stock_code, quantity)
    GROUP BY stock_code""")
_oracle("baseline_two_days", ("tx", "records"), """
    SELECT stock_code, median(quantity) AS median_qty,
           round(stddev_samp(quantity), 6) AS stddev_qty
    FROM tx ANTI JOIN (SELECT order_id AS invoice_no, stock_code, quantity
                       FROM records WHERE z_score >= 2.05)
      USING (invoice_no, stock_code, quantity)
    GROUP BY stock_code""")
_oracle("median_by_period", ("tx",), """
    SELECT m.stock_code, m.period, CAST(quantile_disc(tx.quantity, 0.5) AS BIGINT) AS median_qty,
           count(*) AS n_lines
    FROM (SELECT DISTINCT stock_code, CAST(date_trunc('month', invoice_date) + to_months(CAST(r.range AS INTEGER)) AS DATE)
            AS period FROM tx, range(3) r) m
    JOIN tx ON tx.stock_code = m.stock_code AND invoice_date >= m.period - INTERVAL 2 MONTH
      AND invoice_date < m.period + INTERVAL 1 MONTH
    GROUP BY ALL""")
_oracle("baseline_of_ids", (), """
    SELECT event_type, round(median(user_id), 6) AS median_qty,
           round(stddev_samp(user_id), 6) AS stddev_qty
    FROM events GROUP BY event_type""")
_oracle("anomalies_second_run", ("tx", "records"), f"""
    SELECT * FROM (WITH reviewed AS (
        SELECT * REPLACE (CASE WHEN z_score < 2.05 THEN 'RESOLVED'
                               WHEN z_score < 2.2 THEN 'REVIEWED' ELSE 'NEW' END AS status)
        FROM records),
    base AS (
        SELECT stock_code, median(quantity) AS median_qty, stddev_samp(quantity) AS stddev_qty
        FROM tx ANTI JOIN (SELECT order_id AS invoice_no, stock_code, quantity
                           FROM reviewed WHERE status <> 'RESOLVED')
          USING (invoice_no, stock_code, quantity)
        GROUP BY stock_code),
    found AS (
        SELECT invoice_no AS order_id, stock_code, quantity, median_qty,
               stddev_qty AS std_deviation,
               (quantity - median_qty) / nullif(stddev_qty, 0) AS z_score,
               {AUDIT} AS alert_timestamp, 'NEW' AS status
        FROM tx JOIN base USING (stock_code)
        WHERE quantity > median_qty + 2 * coalesce(stddev_qty, 0))
    SELECT * REPLACE (round(std_deviation, 6) AS std_deviation, round(z_score, 6) AS z_score)
    FROM (SELECT * FROM reviewed
          UNION ALL
          SELECT found.* FROM found ANTI JOIN reviewed USING (order_id, stock_code, quantity)))""")
_oracle("anomaly_trend", ("flagged",), """
    SELECT CAST(date_trunc('month', invoice_date) AS DATE) AS period, count(*) AS n_anomalies,
           max(quantity) AS max_quantity, round(min(median_stddev), 6) AS min_limit,
           round(max(median_stddev), 6) AS max_limit
    FROM flagged GROUP BY 1""")
_oracle("event_anomaly_trend", ("event_flagged",), """
    SELECT CAST(invoice_date AS DATE) AS period, count(*) AS n_anomalies,
           round(max(quantity), 6) AS max_quantity, round(min(median_stddev), 6) AS min_limit,
           round(max(median_stddev), 6) AS max_limit
    FROM event_flagged GROUP BY 1""")
_oracle("anomaly_drill", ("event_flagged",), f"""
    SELECT invoice_no AS order_id, stock_code, quantity, round(median_qty, 6) AS median_qty,
           round(stddev_qty, 6) AS std_deviation,
           round((quantity - median_qty) / stddev_qty, 6) AS z_score,
           {AUDIT} AS alert_timestamp, 'NEW' AS status, invoice_date
    FROM event_flagged
    WHERE stock_code = 'purchase' AND invoice_date >= TIMESTAMP '2024-01-05 00:00:00'
      AND invoice_date < TIMESTAMP '2024-01-20 00:00:00'
      AND (quantity - median_qty) / stddev_qty >= 2.5""")

# --- reports

_oracle("revenue_by_country", ("fact", "known"), f"""
    SELECT country_id, country_name, {MONEY} AS revenue, count(*) AS n_lines,
           count(DISTINCT invoice_no) AS n_orders
    FROM fact JOIN known USING (country_id) GROUP BY ALL""")
_oracle("sales_by_region", ("fact",), f"""
    SELECT region_code, {MONEY} AS revenue, CAST(sum(quantity) AS BIGINT) AS total_quantity,
           count(*) AS n_lines FROM fact GROUP BY ALL""")
_oracle("sales_by_continent", ("fact",), f"""
    SELECT {_continent('country_id')} AS continent, {MONEY} AS revenue,
           CAST(sum(quantity) AS BIGINT) AS total_quantity, count(*) AS n_lines
    FROM fact GROUP BY 1""")
_oracle("top20_quantity", ("fact", "prices"), """
    SELECT stock_code, CAST(sum(quantity) AS BIGINT) AS total_quantity
    FROM fact JOIN prices USING (product_id)
    GROUP BY ALL ORDER BY total_quantity DESC, stock_code LIMIT 20""")
_oracle("top20_revenue", ("fact", "prices"), f"""
    SELECT stock_code, {MONEY} AS revenue
    FROM fact JOIN prices USING (product_id)
    GROUP BY ALL ORDER BY revenue DESC, stock_code LIMIT 20""")
_oracle("order_frequency", ("fact",), """
    SELECT CAST(floor(n / 2) * 2 AS BIGINT) AS orders_from, count(*) AS n_customers
    FROM (SELECT customer_id, count(DISTINCT invoice_no) AS n FROM fact GROUP BY ALL) GROUP BY 1""")
_oracle("order_frequency_sketch", ("fact",), """
    SELECT CAST(floor(n / 2) * 2 AS BIGINT) AS orders_from, count(*) AS n_customers
    FROM (SELECT customer_id, count(DISTINCT invoice_no) AS n FROM fact GROUP BY ALL) GROUP BY 1""")
_oracle("cross_border", ("nations",), """
    SELECT CAST(o_custkey AS VARCHAR) AS customer_id, count(DISTINCT country_id) AS n_countries
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    JOIN supplier ON l_suppkey = s_suppkey JOIN nations ON s_nationkey = n_nationkey
    GROUP BY ALL HAVING count(DISTINCT country_id) > 1""")
_oracle("sales_by_year_sql", ("fact",), f"""
    SELECT CAST(year(invoice_date) AS INTEGER) AS sales_year, count(*) AS n_lines,
           {MONEY} AS revenue FROM fact GROUP BY ALL""")

# --- sinks and repeatable ingest

_oracle("ingest_equal_lines", ("log_tagged",), f"""
    SELECT {LOG_COLUMNS} FROM log_tagged, range(2) WHERE reject_reason IS NULL""")
_oracle("dated_drop", ("product_lines",), "SELECT value FROM product_lines")
_oracle("catalog_append", ("batch", "history"),
        "SELECT * FROM history UNION ALL SELECT * FROM batch")
_oracle("catalog_overwrite", ("batch",), "SELECT * FROM batch")
_oracle("self_replace", ("prices",),
        "SELECT * REPLACE (unit_price * 4 AS unit_price) FROM prices")
_oracle("upsert_catalog", ("batch", "history"), f"""
    SELECT * FROM batch {NEWEST}
    UNION ALL
    SELECT * FROM (SELECT * FROM history {NEWEST})
    WHERE stock_code NOT IN (SELECT stock_code FROM batch)""")
DATED = "CAST(year(price_date) AS INTEGER) AS year, CAST(month(price_date) AS INTEGER) AS month"
_oracle("upsert_partitioned", ("batch", "history"), f"""
    SELECT *, {DATED} FROM (
        SELECT * FROM batch {NEWEST}
        UNION ALL
        SELECT * FROM (SELECT * FROM history {NEWEST})
        WHERE stock_code NOT IN (SELECT stock_code FROM batch))""")
_oracle("replace_partitioned", ("prices",), f"""
    SELECT * REPLACE (unit_price * 4 AS unit_price), {DATED}
    FROM prices WHERE year(price_date) < 2000""")
_oracle("upsert_null_keys", ("bands",), """
    SELECT * EXCLUDE (source) FROM (
        SELECT * REPLACE (CASE WHEN CAST(stock_code AS INTEGER) % 5 > 0 THEN stock_code END AS stock_code)
        FROM bands)
    QUALIFY row_number() OVER (
        PARTITION BY stock_code ORDER BY source DESC, price_date DESC, unit_price DESC, product_id DESC) = 1""")
_oracle("table_or_default_rows", ("batch", "history"), """
    SELECT *, TRUE AS first_load FROM history UNION ALL SELECT *, FALSE FROM batch""")
_oracle("written_if_any", ("product_tagged",),
        "SELECT value, reject_reason FROM product_tagged WHERE reject_reason IS NOT NULL")
_oracle("snapshot_days", ("batch", "history"), """
    SELECT DATE '2024-05-31' AS snapshot_date, count(*) AS n_rows,
           count(DISTINCT stock_code) AS n_products FROM history
    UNION ALL
    SELECT DATE '2024-06-01', count(*), count(DISTINCT stock_code) FROM batch""")
_oracle("reload_new_rows", ("bands", "history"), """
    SELECT bands.* EXCLUDE (source) FROM bands ANTI JOIN history USING (stock_code, price_date)""")
_oracle("outcome_counts", ("priced_left", "known"), """
    SELECT CASE WHEN error_message IS NULL THEN 'valid' ELSE 'error' END AS outcome,
           error_message, count(*) AS n_lines, CAST(sum(quantity) AS BIGINT) AS total_quantity
    FROM (SELECT quantity,
                 CASE WHEN country_id NOT IN (SELECT country_id FROM known)
                      THEN 'Missing Country ID'
                      WHEN product_id IS NULL THEN 'Missing Price' END AS error_message
          FROM priced_left)
    GROUP BY ALL""")
_oracle("fact_by_month", ("fact",), f"""
    SELECT CAST(year(invoice_date) AS INTEGER) AS year,
           CAST(month(invoice_date) AS INTEGER) AS month, count(*) AS n_lines, {MONEY} AS revenue
    FROM fact GROUP BY ALL""")
_oracle("expired_snapshots", ("history",), """
    SELECT DATE '2024-05-24' + CAST(range AS INTEGER) AS snapshot_date,
           (SELECT count(*) FROM history) AS n_rows FROM range(8)""")
_oracle("recover_changed", ("priced", "tx", "known"), """
    SELECT invoice_no, product_id, country_id, 'fixed' AS state FROM priced
    WHERE country_id NOT IN (SELECT country_id FROM known) AND country_id < '9920'
    UNION ALL
    SELECT invoice_no, NULL, country_id, 'waiting' FROM (
        SELECT tx.invoice_no, tx.country_id, p.product_id FROM tx ASOF LEFT JOIN prices p
          ON tx.stock_code = p.stock_code AND CAST(tx.invoice_date AS DATE) >= p.price_date)
    WHERE CASE WHEN country_id IN (SELECT country_id FROM known) THEN product_id IS NULL
               ELSE country_id >= '9920' END""")
_oracle("retain_recent", (), """
    SELECT event_id, CAST(ts AS DATE) AS day, event_type FROM events
    WHERE CAST(ts AS DATE) >= DATE '2024-01-18'""")
