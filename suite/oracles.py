"""DuckDB SQL giving the expected rows of each query in `suite.queries`.

Inputs come from the same expressions as in Spark; results are computed by SQL of their own.
"""

from __future__ import annotations

from suite.inputs import (
    AS_OF,
    BUCKET,
    CUSTOMER_ID,
    CUSTOMER_SPEC,
    EMAIL,
    EMAIL_KINDS,
    FIRST_NAME,
    FOLDER_KEY,
    FORMAT_KEY,
    JOB,
    KEY,
    LAST_NAME,
    MESSAGE,
    MISSING_PAGE,
    PHONE,
    PRODUCT_NAME,
    PRODUCT_PRICE,
    RUN_ID,
    RUN_TIME,
    TABLE_KEY,
    URL_KEY,
)

# The rules for clean e-mails and names, in DuckDB's dialect.
_EMAIL_RULE = "^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+[.][a-zA-Z]{2,}$"


def _email(raw: str) -> str:
    return f"CASE WHEN regexp_matches(trim({raw}), '{_EMAIL_RULE}') THEN lower(trim({raw})) END"


def _name(raw: str) -> str:
    spaced = rf"regexp_replace({raw}, '[\t\n\x0B\f\r ]+', ' ', 'g')"
    return f"nullif(trim(regexp_replace({spaced}, '[^A-Za-z0-9_ ''-]', '', 'g')), '')"


def _full(first: str, last: str) -> str:
    return f"CASE WHEN {first} IS NULL THEN NULL WHEN {last} IS NULL THEN {first} ELSE {first} || ' ' || {last} END"


_CUSTOMERS = f"""raw AS (
    SELECT CAST(c_custkey AS INTEGER) AS customer_id, {FIRST_NAME} AS first_name, {LAST_NAME} AS last_name,
           {EMAIL} AS email, {PHONE} AS phone
    FROM customer),
clean AS (
    SELECT customer_id, {_name("first_name")} AS first_name, {_name("last_name")} AS last_name,
           {_email("email")} AS email, phone
    FROM raw)"""

_IN_FILES = f"""{_CUSTOMERS},
ids AS (SELECT customer_id AS own, {CUSTOMER_ID} AS text_id FROM raw),
files AS (SELECT TRY_CAST(text_id AS BIGINT) AS customer_id, first_name, last_name, email, phone, text_id, own
          FROM clean JOIN ids ON customer_id = own)"""
# Empty cells of files are null, also in what is taken as it is.
_FILE_PHONE = "nullif(phone, '') AS phone"

_STAMP = f"TIMESTAMP '{RUN_TIME}' AS processed_timestamp, '{JOB}' AS processed_by_job, '{RUN_ID}' AS job_run_id"

_PRODUCTS = f"""products AS (
    SELECT CAST(event_id AS INTEGER) AS id, {PRODUCT_NAME} AS name, concat('u', user_id) AS category,
           CAST({PRODUCT_PRICE} AS DECIMAL(10, 2)) AS price, props AS description, event_id, event_type
    FROM events)"""

_EVENTS = f"""base AS (SELECT event_id, event_id % 10 AS kind, {BUCKET} AS b, {KEY} AS k FROM events),
found AS (
    SELECT event_id, 1 AS event_no, b AS bucket, k AS object_key,
           CASE kind WHEN 0 THEN 'ObjectCreated:Put' WHEN 1 THEN 'Object Created' WHEN 2 THEN 'ObjectCreated:Copy'
                     WHEN 3 THEN 'Put' ELSE 'ObjectCreated' END AS event_name
    FROM base WHERE kind IN (0, 1, 2, 3, 8, 9)
    UNION ALL
    SELECT event_id, 2, b, k || '.bak', 'ObjectCreated' FROM base WHERE kind = 9)"""

_PLAN = f"""{_EVENTS},
jobs AS (
    SELECT *, CASE WHEN starts_with(object_key, 'data/special/') THEN 'special_load'
                   WHEN starts_with(object_key, 'data/') THEN 'bulk_load'
                   WHEN starts_with(object_key, 'inventory/') THEN 'stock_load'
                   WHEN starts_with(object_key, 'sales/') THEN 'test-sales_etl'
                   WHEN starts_with(object_key, 'customers/') THEN 'test-customer_import' END AS job_name
    FROM found),
plan AS (
    SELECT base.event_id, event_no, bucket, object_key, event_name, job_name,
           CASE WHEN job_name IS NOT NULL THEN
               concat('{{"--bucket":"', bucket, '","--object_key":"', object_key,
                      '","--env":"test","--enable_metrics":"true"}}') END AS arguments,
           CASE WHEN kind = 5 THEN 'error' WHEN job_name IS NOT NULL THEN 'matched' ELSE 'skipped' END AS status,
           CASE WHEN kind = 5 OR job_name IS NOT NULL THEN NULL
                WHEN event_no IS NULL THEN 'No S3 events found' ELSE 'No matching Glue job' END AS reason
    FROM base LEFT JOIN jobs USING (event_id))"""

_DELIVERED = """numbered AS (SELECT row_number() OVER (ORDER BY event_id) AS rn FROM events),
status AS (
    SELECT CAST((rn - 1) // 100 + 1 AS BIGINT) AS batch_number, count(*) AS records FROM numbered GROUP BY 1)"""

_SUMMARY = """SELECT CAST(coalesce(sum(records), 0) AS BIGINT) AS total_records,
       CAST(ceil(coalesce(sum(records), 0) / 100.0) AS BIGINT) AS total_batches,
       count(*) FILTER (WHERE batch_number % 4 <> 0) AS successful_batches,
       count(*) FILTER (WHERE batch_number % 4 = 0) AS failed_batches,
       CAST(count(*) FILTER (WHERE batch_number % 4 <> 0) AS DOUBLE) / greatest(count(*), 1) AS success_rate
FROM status"""

_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
]

_COLUMNS = " UNION ALL ".join(
    f"""SELECT '{name}' AS table_name, CAST(count(*) OVER () AS INTEGER) AS column_count,
       CAST(row_number() OVER () AS INTEGER) AS position, column_name AS name, CASE column_type
         WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double'
         WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz'
         WHEN 'FLOAT[]' THEN 'array<float>' ELSE column_type END AS type
    FROM (DESCRIBE {name})"""
    for name in _TABLES
)

_KEYS = f"SELECT page_id, {URL_KEY} AS object_key, url FROM pages"


def _range(condition: str) -> str:
    return f"SELECT * FROM events WHERE {condition}"


_RULES = f"""WITH e AS (SELECT event_id, event_type, event_id % 10 AS kind, {BUCKET} AS b, {KEY} AS k FROM events),
        rules AS (SELECT DISTINCT b || ':' || event_type AS rule, b AS bucket,
                         'customers/' || event_type || '/' AS prefix, '.csv' AS suffix FROM e
                  UNION SELECT DISTINCT b, b, '', '1.csv' FROM e)
        SELECT event_id, rule, b AS bucket, k AS object_key,
               concat('{{"--bucket":"', b, '","--object_key":"', k, '","--env":"test"}}') AS arguments
        FROM e JOIN rules ON bucket = b AND starts_with(k, prefix) AND ends_with(k, suffix) WHERE kind = 1"""


def _exported(cap: int | None) -> str:
    return f"""WITH selected AS (
            SELECT row_number() OVER (ORDER BY event_id) AS rn FROM events
            WHERE CAST(ts AS DATE) >= DATE '{AS_OF}' - 7 AND (value > 2 OR user_id = 1)),
        numbered AS (SELECT * FROM selected WHERE {f"rn <= {cap}" if cap else "true"}),
        status AS (SELECT (rn - 1) // 100 + 1 AS batch_number, count(*) AS records FROM numbered GROUP BY 1),
        summary AS ({_SUMMARY})
        SELECT *, (SELECT CAST(coalesce(sum(records), 0) AS BIGINT) FROM status WHERE batch_number % 4 <> 0) AS delivered_records,
               (SELECT count(*) FROM selected) AS selected_records,
               (SELECT count(*) FROM selected) > total_records AS truncated FROM summary"""


_PAYLOADS = """WITH numbered AS (
            SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // 100 + 1 AS batch_number,
                   count(*) OVER () AS n FROM orders)
        SELECT CAST(batch_number AS BIGINT) AS batch_number, CAST(ceil(max(n) / 100.0) AS BIGINT) AS total_batches,
               count(*) AS records, CAST(count(*) AS INTEGER) AS sent_records,
               min(o_orderkey) AS min_key, max(o_orderkey) AS max_key
        FROM numbered GROUP BY ALL"""


ORACLES = {
    "scan_csv": "SELECT * FROM customer",
    "scan_dat": "SELECT * FROM part",
    "scan_json": "SELECT conv_id, turn, role, text FROM conversations",
    "scan_parquet": "SELECT * FROM lineitem",
    "scan_glob": "SELECT * FROM orders",
    "scan_fallback": f"WITH {_CUSTOMERS} SELECT customer_id, first_name, email FROM raw",
    "detect_format": f"""SELECT page_id, {FORMAT_KEY} AS object_key,
        CASE regexp_extract(lower({FORMAT_KEY}), '([^.]*)$', 1)
          WHEN 'dat' THEN 'dat' WHEN 'tsv' THEN 'dat' WHEN 'json' THEN 'json' WHEN 'parquet' THEN 'parquet'
          ELSE 'csv' END AS file_format FROM pages""",
    "pages_assemble": f"""WITH {_PRODUCTS},
        placed AS (SELECT *, event_id // 1000 AS run, (event_id % 1000) // 20 + 1 AS page FROM products),
        sizes AS (SELECT run, page, count(*) FILTER (WHERE event_type = 'purchase') AS n FROM placed GROUP BY ALL),
        there AS (SELECT * FROM sizes WHERE NOT ({MISSING_PAGE})),
        gaps AS (SELECT run, min(page) AS gap FROM sizes WHERE {MISSING_PAGE} GROUP BY run),
        stops AS (SELECT run, coalesce(min(page) FILTER (WHERE n < 3), max(page)) AS stop FROM there GROUP BY run),
        ends AS (SELECT run, least(stop, coalesce(gap - 1, stop)) AS last FROM stops LEFT JOIN gaps USING (run))
        SELECT run, page, id, name, category, price, description
        FROM placed JOIN ends USING (run) WHERE event_type = 'purchase' AND page <= last""",
    "pages_assemble_single": f"""WITH {_PRODUCTS},
        placed AS (SELECT *, event_id // 100 + 1 AS page FROM products),
        sizes AS (SELECT page, count(*) AS n FROM placed WHERE page <> 7 GROUP BY page),
        stop AS (SELECT least(coalesce(min(page) FILTER (WHERE n < 90), 6), 6) AS last FROM sizes)
        SELECT page, id, name, category, price, description FROM placed, stop WHERE page <= last""",
    "parse_products": """SELECT CAST(p_partkey AS INTEGER) AS id, p_name AS name, p_brand AS category,
        CAST(p_retailprice AS DECIMAL(10, 2)) AS price, p_type AS description FROM part""",
    "table_info": _COLUMNS,
    "sql_view_filter": "SELECT event_id, event_type, value FROM events WHERE value > 120",
    "stream_ingest": "SELECT * FROM events",
    "write_table": "SELECT * FROM orders",
    "write_partitions": """SELECT * FROM orders WHERE o_orderstatus <> 'F' OR o_orderstatus IS NULL
        UNION ALL SELECT * REPLACE (-o_totalprice AS o_totalprice) FROM orders WHERE o_orderstatus = 'F' AND o_orderkey % 2 = 0""",
    "preview": "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 10",
    "table_from_key": f"""SELECT page_id, {TABLE_KEY} AS object_key, CASE page_id % 3
        WHEN 0 THEN 'dev_customers_silver' WHEN 1 THEN concat('prod_t', page_id % 10, '_silver')
        ELSE concat('prod_t', page_id % 7, '_bronze') END AS table_name FROM pages""",
    "deliver_batches": f"""WITH {_DELIVERED}
        SELECT batch_number, records, batch_number % 4 <> 0 AS ok,
               CASE WHEN batch_number % 4 = 0 THEN 'rejected' END AS error FROM status""",
    "deliver_resumed": f"""WITH {_DELIVERED}
        SELECT batch_number, records, true AS ok, CAST(NULL AS VARCHAR) AS error, batch_number % 4 <> 0 AS resumed FROM status""",
    "delivery_summary": f"WITH {_DELIVERED} {_SUMMARY}",
    "run_report": f"""SELECT 'job_success' AS event_type, 'dev' AS environment, '{JOB}' AS job_name,
        '{RUN_ID}' AS job_run_id, 'scheduled' AS trigger_type, count(*) AS records_processed,
        'dev_customers_silver' AS output_paths, CAST(NULL AS VARCHAR) AS error FROM customer""",
    "run_report_failure": f"""SELECT 'job_failure' AS event_type, '{JOB}' AS job_name, '{RUN_ID}' AS job_run_id,
        CAST(NULL AS BIGINT) AS records_processed, '' AS output_paths,
        'RuntimeError: the quality gate turned the rows down' AS error""",
    "clean_email": f"""SELECT c_custkey, raw, {_email("raw")} AS email
        FROM (SELECT c_custkey, {EMAIL_KINDS} AS raw FROM customer)""",
    "standardize_phone": f"""WITH digits AS (
            SELECT c_custkey, {PHONE} AS raw, regexp_replace({PHONE}, '[^0-9]', '', 'g') AS d FROM customer)
        SELECT c_custkey, raw, CASE WHEN length(d) = 10
            THEN '(' || substr(d, 1, 3) || ') ' || substr(d, 4, 3) || '-' || substr(d, 7, 4) ELSE raw END AS phone
        FROM digits""",
    "standardize_name": f"SELECT doc_id, {_name('text')} AS name FROM documents",
    "full_name": f"""WITH {_CUSTOMERS}
        SELECT customer_id, {_full("first_name", "last_name")} AS full_name FROM raw""",
    "categorize_amount": f"""SELECT event_id,
        CASE WHEN amount < 100 THEN 'small' WHEN amount < 1000 THEN 'medium' ELSE 'large' END AS category,
        CASE WHEN amount < 50 THEN 'small' WHEN amount < 250 THEN 'medium' ELSE 'large' END AS custom
        FROM (SELECT event_id, {PRODUCT_PRICE} AS amount FROM events)""",
    "when_category": "SELECT p_partkey, 'adult' AS category FROM part WHERE p_size >= 18",
    "add_metadata": f"SELECT o_orderkey, o_totalprice, {_STAMP} FROM orders",
    "json_cells": "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k, event_type FROM events",
    "customers_silver": f"""WITH {_CUSTOMERS}
        SELECT customer_id, first_name, last_name, email, phone, {_full("first_name", "last_name")} AS full_name,
               {_STAMP} FROM clean""",
    "customers_files": f"""WITH {_IN_FILES}
        SELECT customer_id, first_name, last_name, email, {_FILE_PHONE}, {_full("first_name", "last_name")} AS full_name,
               {_STAMP} FROM files WHERE customer_id IS NOT NULL""",
    "customers_rescued": f"""WITH {_IN_FILES}
        SELECT text_id AS rescued_id, customer_id, raw.first_name, raw.last_name, nullif(raw.email, '') AS email,
               nullif(raw.phone, '') AS phone, 1 AS cells
        FROM (SELECT text_id, own, customer_id FROM files WHERE customer_id IS NULL) AS odd
        JOIN (SELECT customer_id AS raw_id, first_name, last_name, email, phone FROM raw) AS raw ON raw_id = own""",
    "customers_incremental": f"""WITH {_IN_FILES}
        SELECT customer_id, first_name, last_name, email, {_FILE_PHONE}, {_full("first_name", "last_name")} AS full_name,
               {_STAMP}, CAST(CASE WHEN own % 3 = 0 THEN 0 ELSE 1 END AS BIGINT) AS batch_id
        FROM files WHERE customer_id IS NOT NULL""",
    "products_bronze": f"""WITH {_PRODUCTS}
        SELECT id, name, category, price, description,
               CASE WHEN price < 10 THEN 'budget' WHEN price < 50 THEN 'mid_range' ELSE 'premium' END AS price_category,
               CAST(length(name) AS INTEGER) AS name_length, {_STAMP}
        FROM products WHERE name IS NOT NULL AND price IS NOT NULL""",
    "products_job": f"""WITH {_PRODUCTS}
        SELECT id, name, category, price, description,
               CASE WHEN price < 10 THEN 'budget' WHEN price < 50 THEN 'mid_range' ELSE 'premium' END AS price_category,
               CAST(length(name) AS INTEGER) AS name_length, {_STAMP}
        FROM products WHERE name IS NOT NULL AND price IS NOT NULL""",
    "group_count": "SELECT event_type, count(*) AS n FROM events GROUP BY event_type",
    "quality_base": "SELECT count(*) AS total, '' AS missing, count(*) > 0 AS passed FROM customer",
    "quality_customers": f"""WITH {_CUSTOMERS},
        c AS (SELECT count(*) AS total, count(email) AS valid_email, count(first_name) AS valid_name FROM clean),
        r AS (SELECT *, CAST(valid_email AS DOUBLE) / total AS email_rate,
                     CAST(valid_name AS DOUBLE) / total AS name_rate FROM c)
        SELECT *, total > 0 AND email_rate >= 0.7 AND name_rate >= 0.9 AS passed FROM r""",
    "quality_products": f"""WITH {_PRODUCTS},
        c AS (SELECT count(*) AS total, count(id) AS valid_id, count(name) AS valid_name,
                     count(*) FILTER (WHERE price > 0) AS valid_price FROM products),
        r AS (SELECT *, CAST(valid_id AS DOUBLE) / total AS id_rate, CAST(valid_name AS DOUBLE) / total AS name_rate,
                     CAST(valid_price AS DOUBLE) / total AS price_rate FROM c)
        SELECT *, total >= 10 AND id_rate >= 0.95 AND name_rate >= 0.9 AS passed FROM r""",
    "export_today": _range(f"CAST(ts AS DATE) = DATE '{AS_OF}'"),
    "export_yesterday": _range(f"CAST(ts AS DATE) = DATE '{AS_OF}' - 1"),
    "export_last_week": _range(f"CAST(ts AS DATE) >= DATE '{AS_OF}' - 7"),
    "export_select": f"""SELECT event_id, ts, event_type, value FROM events
        WHERE CAST(ts AS DATE) >= DATE '{AS_OF}' - 7 AND (value > 200 OR event_type = 'purchase')""",
    "export_limit": f"""SELECT event_id, value FROM events WHERE CAST(ts AS DATE) >= DATE '{AS_OF}' - 7
        ORDER BY event_id LIMIT 500""",
    "export_limit_large": """SELECT l_returnflag, l_orderkey, l_linenumber FROM lineitem
        ORDER BY l_returnflag, l_orderkey, l_linenumber LIMIT 150000""",
    "export_limit_text": """SELECT 'lake://returns/' || l_returnflag || '/' || l_linestatus AS object_key, l_orderkey, l_linenumber
        FROM lineitem ORDER BY 1, 2, 3 LIMIT 2000""",
    "batch_records": """SELECT o_orderkey, CAST((row_number() OVER (ORDER BY o_orderkey) - 1) // 100 + 1 AS BIGINT) AS batch_number,
        CAST(ceil(count(*) OVER () / 100.0) AS BIGINT) AS total_batches FROM orders""",
    "batch_payloads": _PAYLOADS,
    "batch_payloads_ordered": _PAYLOADS,
    "lake_export": _exported(None),
    "lake_export_capped": _exported(750),
    "events_envelope": f"""WITH base AS (SELECT event_id, event_type, {BUCKET} AS b, {KEY} AS k FROM events),
        m AS (SELECT event_id, {MESSAGE} AS message FROM base)
        SELECT event_id, CAST(CASE event_id % 4 WHEN 1 THEN 2 ELSE 1 END AS INTEGER) AS record_no,
               CASE WHEN event_id % 4 < 3 THEN message END AS message FROM m WHERE event_id % 7 <> 0
        UNION ALL SELECT event_id, 2, ' ' || message FROM m WHERE event_id % 4 = 2 AND event_id % 7 <> 0
        UNION ALL SELECT event_id, NULL, NULL FROM m WHERE event_id % 7 = 0 AND event_id % 3 < 2""",
    "events_normalize": f"WITH {_EVENTS} SELECT * FROM found",
    "event_rule_match": f"""SELECT event_id,
        kind = 1 AND b = 'lake-1' AND starts_with(k, 'customers/') AND ends_with(k, '7.csv') AS matches,
        kind = 1 AND b = 'lake-0' AS matches_bucket
        FROM (SELECT event_id, event_id % 10 AS kind, {BUCKET} AS b, {KEY} AS k FROM events)""",
    "event_rule_targets": _RULES,
    "route_spec_parse": f"""WITH specs AS (SELECT c_custkey, string_split({CUSTOMER_SPEC}, ',') AS entries FROM customer),
        entries AS (SELECT c_custkey, unnest(entries) AS entry, generate_subscripts(entries, 1) AS pos FROM specs),
        parts AS (SELECT c_custkey, pos, trim(split_part(entry, ':', 1)) AS prefix,
                         trim(substr(entry, strpos(entry, ':') + 1)) AS job FROM entries WHERE contains(entry, ':'))
        SELECT c_custkey, prefix, arg_max(job, pos) AS job FROM parts GROUP BY ALL""",
    "route_longest_prefix": f"""WITH keys AS ({_KEYS}),
        parts AS (SELECT split_part(object_key, '/', 1) AS host, split_part(object_key, '/', 2) AS lang
                  FROM keys WHERE starts_with(url, 'https:')),
        routes AS (SELECT DISTINCT host || '/' AS prefix, 'h-' || host AS job FROM parts
                   UNION SELECT DISTINCT host || '/' || lang || '/', 'l-' || lang FROM parts
                   WHERE starts_with(host, 'm.') OR starts_with(host, 'blog.'))
        SELECT page_id, any_value(object_key) AS object_key, arg_max(job, length(prefix)) AS job_name
        FROM keys LEFT JOIN routes ON starts_with(object_key, prefix) GROUP BY page_id""",
    "route_many": f"""WITH keys AS ({_KEYS}),
        parts AS (SELECT split_part(object_key, '/', 1) AS host, split_part(object_key, '/', 2) AS lang
                  FROM keys WHERE starts_with(url, 'https:')),
        routes AS (SELECT DISTINCT host || '/' AS prefix, 'h-' || host AS job FROM parts
                   UNION SELECT DISTINCT host || '/' || lang || '/', 'l-' || lang FROM parts
                   WHERE starts_with(host, 'm.') OR starts_with(host, 'blog.')
                   UNION SELECT object_key, 'j' || (page_id % 3) FROM keys),
        one AS (SELECT prefix, min(job) AS job FROM routes GROUP BY prefix)
        SELECT page_id, any_value(object_key) AS object_key, arg_max(job, length(prefix)) AS job_name
        FROM keys LEFT JOIN one ON starts_with(object_key, prefix) GROUP BY page_id""",
    "route_default": f"""SELECT page_id, {FOLDER_KEY} AS object_key, CASE page_id % 6 WHEN 0 THEN 'test-sales_etl'
        WHEN 1 THEN 'test-customer_import' WHEN 2 THEN 'test-inventory_sync' WHEN 3 THEN 'test-product_catalog'
        END AS job_name FROM pages""",
    "dispatch_plan": f"WITH {_PLAN} SELECT * FROM plan",
    "dispatch_summary": f"""WITH {_PLAN}
        SELECT event_id, CASE WHEN max(status) FILTER (WHERE status = 'error') IS NOT NULL THEN 'error'
                              WHEN count(event_no) = 0 THEN 'skipped' ELSE 'success' END AS status,
               count(job_name) AS jobs_started
        FROM plan GROUP BY event_id""",
    "envelope_dispatch": f"""WITH {_PLAN},
        outcome AS (SELECT event_id, CASE WHEN max(status) FILTER (WHERE status = 'error') IS NOT NULL THEN 'error'
                           WHEN count(event_no) = 0 THEN 'skipped' ELSE 'success' END AS status,
                           count(job_name) AS jobs_started FROM plan GROUP BY event_id),
        sent AS (SELECT event_id, CAST(CASE event_id % 4 WHEN 1 THEN 2 ELSE 1 END AS INTEGER) AS record_no FROM events
                 WHERE event_id % 7 <> 0
                 UNION ALL SELECT event_id, 2 FROM events WHERE event_id % 4 = 2 AND event_id % 7 <> 0
                 UNION ALL SELECT event_id, NULL FROM events WHERE event_id % 7 = 0 AND event_id % 3 < 2)
        SELECT event_id, record_no, CASE WHEN event_id % 4 = 3 OR record_no IS NULL THEN 'error' ELSE status END AS status,
               CASE WHEN event_id % 4 = 3 OR record_no IS NULL THEN 0 ELSE jobs_started END AS jobs_started
        FROM sent JOIN outcome USING (event_id)""",
    "event_rule_targets_many": _RULES,
    "stream_dispatch": f"WITH {_PLAN} SELECT * FROM plan",
    "stream_dispatch_once": f"WITH {_PLAN} SELECT * FROM plan",
}
