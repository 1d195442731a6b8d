"""DuckDB SQL with the results the registered queries must have."""

from __future__ import annotations

from sparge.registry.queries import BILLING_PERIOD, DAYS, LATER, MIN_REVIEWS, MONTH, NOW, ORDER_DAYS, YEAR

# (name, pattern, score), written down apart from the operators they check.
_PII = (
    ("email", "[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]{1,63}([.][A-Za-z0-9-]{1,63}){1,8}", 0.99),
    ("phone", "[+][0-9]{1,3}[ -]?[(]?[0-9]{2,4}[)]?[ -]?[0-9]{3,4}[ -][0-9]{4}", 0.9),
    ("card", "[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}", 0.85),
    ("ip_address", "[0-9]{1,3}[.][0-9]{1,3}[.][0-9]{1,3}[.][0-9]{1,3}", 0.8),
    ("secret", "(AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|-----BEGIN [A-Z0-9 ]*PRIVATE KEY-----)", 0.95),
)

_REVIEW = """
    SELECT l_orderkey * 10 + l_linenumber AS review_id, l_suppkey AS brewery_id, l_partkey AS beer_id,
           o_custkey AS profile_id, l_quantity AS review_overall, l_discount AS review_aroma,
           l_tax AS review_appearance, l_extendedprice AS review_palate,
           nullif(l_discount, 0.0) AS review_taste, CAST(epoch(l_shipdate) AS BIGINT) AS review_time,
           o_orderdate AS created_at, o_orderdate AS updated_at,
           CASE WHEN l_returnflag = 'R' THEN o_orderdate END AS deleted_at,
           strftime(o_orderdate, '%Y%m%d') AS partitioned_at,
           CAST(year(l_shipdate) AS INTEGER) AS review_year, CAST(month(l_shipdate) AS INTEGER) AS review_month
    FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey"""

_BEER = """
    SELECT p_partkey AS beer_id, CAST(regexp_extract(p_brand, '([0-9]+)$', 1) AS BIGINT) AS brewery_id,
           p_name AS beer_name, p_type AS beer_style, CAST(p_size AS DOUBLE) AS beer_abv, p_brand AS brand
    FROM part"""

_PROFILE = """
    SELECT c_custkey AS profile_id, c_name AS profile_name, c_name || '@example.com' AS email, n_name AS state
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey"""

_FLAT = f"""WITH review AS ({_REVIEW}), beer AS ({_BEER}), profile AS ({_PROFILE}),
flat AS (
    SELECT r.*, s_name AS brewery_name, b.beer_name, b.beer_style, b.beer_abv, b.brand,
           p.profile_name, p.email, p.state
    FROM review r LEFT JOIN beer b ON r.beer_id = b.beer_id
    LEFT JOIN supplier ON r.brewery_id = s_suppkey
    LEFT JOIN profile p ON r.profile_id = p.profile_id)
"""

_FLAT_COLUMNS = """review_id, brewery_id, beer_id, profile_id, brewery_name, beer_name, beer_style, beer_abv,
    profile_name, email, state, review_overall, review_aroma, review_appearance, review_palate, review_taste,
    review_time, created_at, updated_at, deleted_at, partitioned_at"""

_OPERATION = "CASE event_type WHEN 'signup' THEN 'insert' WHEN 'error' THEN 'delete' ELSE 'update' END"
_CHANGES = f"SELECT user_id, event_id, value, props, {_OPERATION} AS operation, ts AS control_ts FROM events"


def _days(days) -> str:
    return ", ".join(f"'{d}'" for d in days)


def _mart(keys: str, least: int, measures: str = "avg(review_overall) AS avg_rating, count(*) AS total_reviews",
          where: str = "true") -> str:
    return f"""{_FLAT} SELECT {keys}, review_year, review_month, {measures} FROM flat WHERE {where}
        GROUP BY {keys}, review_year, review_month HAVING count(*) >= {least}"""


def _state(source: str, suffix: str = "") -> str:
    """Last change per user of the rows in `source`, with the audit columns."""
    return f"""
    SELECT user_id, event_id, value, props, coalesce(inserted_at, first_at) AS created_at, control_ts AS updated_at,
           CASE WHEN operation = 'delete' THEN control_ts END AS deleted_at,
           strftime(control_ts, '%Y%m%d') AS partitioned_at
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY control_ts DESC, event_id DESC) AS rn,
                 max(CASE WHEN operation = 'insert' THEN control_ts END) OVER (PARTITION BY user_id) AS inserted_at,
                 min(control_ts) OVER (PARTITION BY user_id) AS first_at
          FROM {source}) WHERE rn = 1{suffix}"""


_PERIOD_COSTS = f"""WITH costs AS (
    SELECT p_type AS service, l_returnflag AS kind, l_linestatus AS usage, l_shipdate AS shipped,
           CAST(l_extendedprice AS DECIMAL(18,4)) AS cost
    FROM lineitem LEFT JOIN part ON l_partkey = p_partkey
    WHERE strftime(l_shipdate, '%Y-%m') = '{BILLING_PERIOD}')
"""
_SUM = "CAST(sum(cost) AS DOUBLE)"


def _mask(column: str) -> str:
    return (
        f"CASE WHEN length({column}) <= 4 THEN repeat('*', length({column})) ELSE"
        f" {column}[1] || repeat('*', length({column}) - 2) || {column}[-1] END AS {column}"
    )


def _count(column: str, pattern: str) -> str:
    return f"len(regexp_extract_all({column}, '{pattern}'))"


def _pii_sample(field: str) -> str:
    text = f"CAST({field} AS VARCHAR)"
    matches = " + ".join(f"sum({_count(text, pattern)})" for name, pattern, score in _PII)
    score = " + ".join(f"sum({_count(text, pattern)}) * CAST({score} AS DOUBLE)" for name, pattern, score in _PII)
    return f"""SELECT '{field}' AS field, count(*) FILTER (trim(coalesce({text}, '')) <> '') AS non_empty,
        coalesce({matches}, 0) AS matches, coalesce({score}, 0) AS score FROM sample"""


# The rule that gives envelopes their defects, and what becomes of each.
_ENVELOPE = f"""
    SELECT event_id, user_id, value,
           CASE WHEN value < 1 OR (value >= 3 AND value < 4) THEN 'unparsed' WHEN value < 2 THEN 'unknown'
                ELSE event_type END AS table_name,
           CASE WHEN value < 1 OR (value >= 3 AND value < 4) THEN '' ELSE {_OPERATION} END AS operation,
           CASE WHEN value < 1 OR (value >= 3 AND value < 4) THEN 'unparsed' WHEN value < 2 THEN 'missing_table'
                WHEN value < 3 THEN 'data_not_object' END AS drop_reason
    FROM events"""


def _file_key(number: str) -> str:
    return f"""('raw/' || ['brewery', 'beer', 'profile', 'review'][{number} % 4 + 1]
        || CASE WHEN {number} % 2 = 0 THEN '/dm-batch-process-' ELSE '/part-' END || {number}
        || CASE WHEN {number} % 2 = 0 THEN '.csv.gz' ELSE '.json.gz' END)"""


_LOG = f"""
    SELECT sha256('dm_bronze|' || split_part(object_key, '/', 2) || '|' || object_key) AS control_id, object_key,
           'dm_bronze' AS schema_name, split_part(object_key, '/', 2) AS table_name, whole * 2000 AS record_count,
           CASE WHEN contains(object_key, 'dm-batch-process') THEN 'csv' ELSE 'json' END AS file_format,
           whole * 64 AS file_size, sha256(props) AS checksum, status,
           CAST(floor(value / 20) AS INTEGER) AS attempt_count,
           CASE WHEN whole * 2000 <= 100000 THEN 'small' ELSE 'bulk' END AS compute_target,
           CASE WHEN status <> 'pending' THEN ts END AS started_at,
           CASE WHEN status IN ('success', 'error') THEN ts + to_seconds(whole) END AS finished_at,
           ts AS created_at, ts AS updated_at,
           CASE WHEN status IN ('success', 'error') THEN whole * 1000 END AS duration,
           CASE WHEN status = 'error' THEN props END AS error_message
    FROM (SELECT *, {_file_key('user_id')} AS object_key, CAST(floor(value) AS BIGINT) AS whole,
                 CASE event_type WHEN 'signup' THEN 'pending' WHEN 'purchase' THEN 'success'
                      WHEN 'error' THEN 'error' ELSE 'running' END AS status FROM events)"""

_CURRENT = f"""log AS ({_LOG}), current AS (
    SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY control_id ORDER BY created_at DESC, updated_at DESC, attempt_count DESC,
               list_position(['pending', 'running', 'success', 'error'], status) DESC) AS rn FROM log) WHERE rn = 1)"""

_ELIGIBLE = "status = 'pending' OR (status = 'error' AND attempt_count < 3)"

_FLAT_ENTRIES = """flat_entries AS (
    SELECT 'silver/review/partitioned_at=' || strftime(created_at, '%Y%m%d') AS object_key,
           CAST(sum(record_count) AS BIGINT) AS record_count, strftime(created_at, '%Y%m%d') AS day
    FROM current GROUP BY ALL)"""

_MARTS = (
    "['top_beers_by_rating', 'top_breweries_by_rating', 'state_by_review_volume', 'top_styles_by_popularity',"
    " 'top_drinkers']"
)


def _job_oracles() -> dict[str, str]:
    """What jobs and streams leave behind; the numbers are those of `job_queries`."""
    rejected, broken, no = "c_custkey % 5 = 4", "c_custkey % 5 = 3", "CAST(NULL AS BIGINT)"
    rank = "avg_rating DESC, brewery_id, brewery_name, review_year, review_month"
    return {
        "ledger_partial_failure": f"""SELECT CAST(c_custkey % 5 AS INTEGER) AS file_no,
            CASE WHEN {broken} THEN 'error' ELSE 'success' END AS status, CAST(1 AS INTEGER) AS attempt_count,
            CASE WHEN {broken} THEN {no} WHEN {rejected} THEN 0 ELSE count(*) END AS record_count,
            CASE WHEN {broken} OR {rejected} THEN {no} ELSE count(*) END AS pending_rows,
            CASE WHEN {rejected} THEN count(*) ELSE {no} END AS rejected_rows
            FROM customer GROUP BY c_custkey % 5""",
        "ledger_by_key": f"""WITH {_CURRENT}, k AS (SELECT {_file_key('c_custkey')} AS object_key FROM customer ORDER BY c_custkey LIMIT 5)
            SELECT object_key, control_id, status, attempt_count, updated_at FROM current SEMI JOIN k USING (object_key)""",
        "stream_route": f"SELECT event_id, table_name, operation, drop_reason FROM ({_ENVELOPE})",
        "stream_raw_to_bronze": f"""WITH p AS (SELECT profile_id, profile_name, state,
                CASE WHEN profile_id > 10 THEN email ELSE 'unknown' END AS email FROM ({_PROFILE}))
            SELECT profile_id, profile_name, CASE WHEN profile_id % 50 <> 7 THEN masked END AS email,
                CASE WHEN profile_id % 50 <> 7 THEN state END AS state,
                CAST(CASE WHEN profile_id % 50 <> 7 THEN 0 ELSE 1 END AS INTEGER) AS rejected,
                CAST((SELECT count(*) FROM customer WHERE c_custkey % 50 <> 7) AS BIGINT) AS handed_on
            FROM (SELECT * EXCLUDE (email), {_mask("email").removesuffix("email")} masked FROM p)""",
        "stream_apply_cdc": _state(f"({_CHANGES})"),
        "stream_bootstrap": """SELECT p_partkey AS beer_id, p_name || CASE WHEN p_size > 40 OR p_size < 5 THEN ' (new)' ELSE '' END AS beer_name,
            p_type AS beer_style, p_size < 5 AS is_deleted FROM part""",
        "job_file_order": """SELECT c_custkey AS profile_id, CASE WHEN c_custkey % 5 = 0 THEN 'old' ELSE 'new' END AS state,
            c_custkey % 15 = 0 AS is_deleted FROM customer""",
        "job_mixed_formats": f"""SELECT profile_id, profile_name, CASE WHEN profile_id % 4 = 0 THEN 'moved' ELSE state END AS state
            FROM ({_PROFILE})""",
        "pii_masked_probe": """SELECT layer, field, field = 'email' AS is_tagged,
            CASE WHEN layer = 'raw' AND field = 'email' THEN (SELECT count(*) FROM customer) ELSE 0 END AS row_count
            FROM (SELECT unnest(['raw', 'bronze']) AS layer), (SELECT unnest(['profile_name', 'email', 'state']) AS field)""",
        "guard_empty_input": """SELECT event_type, count(*) AS row_count, false AS is_refused, true AS is_written FROM events GROUP BY event_type
            UNION ALL SELECT 'none such', NULL, true, false""",
        "gold_ordered": f"""SELECT *, row_number() OVER (ORDER BY {rank}) AS rating_rank
            FROM ({_mart("brewery_id, brewery_name", MIN_REVIEWS["top_breweries_by_rating"])})""",
        "costs_add_partition": """SELECT strftime(l_shipdate, '%Y-%m') AS billing_period, count(*) AS line_count,
            CAST(sum(CASE WHEN l_discount = 0 THEN 0 WHEN l_quantity > 25 THEN 2 ELSE 1 END) AS BIGINT) AS tag_count
            FROM lineitem GROUP BY ALL""",
    }


def all_oracles() -> dict[str, str]:
    top_beers = _mart("beer_id, beer_name, beer_style", 1)
    top_breweries = _mart("brewery_id, brewery_name", 1)
    month = f"review_year = {YEAR} AND review_month = {MONTH}"
    both = "count(*) AS total_reviews, avg(review_overall) AS avg_rating"
    daily_events = f"SELECT *, strftime(control_ts, '%Y%m%d') AS partitioned_at FROM ({_CHANGES})"
    pending = f"WITH {_CURRENT} SELECT * FROM current WHERE {_ELIGIBLE}"
    return _job_oracles() | {
        "scan_parquet": f"""SELECT event_id, user_id, operation, date_trunc('day', control_ts)::TIMESTAMP AS control_ts
            FROM ({_CHANGES})""",
        "scan_dims": """SELECT 'brewery' AS entity, s_suppkey AS id, s_name AS name FROM supplier
            UNION ALL SELECT 'beer', p_partkey, p_name FROM part
            UNION ALL SELECT 'profile', c_custkey, c_name FROM customer""",
        "scan_partition_pruned": f"""SELECT event_id, user_id, value, partitioned_at FROM ({daily_events})
            WHERE partitioned_at IN ({_days(DAYS)})""",
        "probe_partition": f"""SELECT partitioned_at, count(*) AS row_count,
            count(*) FILTER (operation = 'delete') AS deleted_count, min(event_id) AS first_event,
            max(event_id) AS last_event FROM ({daily_events}) GROUP BY partitioned_at""",
        "compact_partition_counts": f"""SELECT partitioned_at, count(*) AS row_count,
            CAST(sum(event_id) AS BIGINT) AS event_sum FROM ({daily_events}) GROUP BY partitioned_at""",
        "bronze_partition_layout": """SELECT strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month,
            strftime(ts, '%d') AS day, count(*) AS row_count FROM events GROUP BY ALL""",
        "bronze_csv_roundtrip": f"""SELECT review_id, brewery_id, beer_id, profile_id, review_overall, review_aroma,
            review_appearance, review_palate, review_taste, review_time FROM ({_REVIEW})""",
        "bronze_json_roundtrip": _PROFILE,
        "file_manifest": """SELECT 'profile' AS table_name, 'csv' AS file_format, count(*) AS record_count,
            count(*) AS data_lines FROM customer
            UNION ALL SELECT 'review', 'json', count(*), count(*) FROM lineitem""",
        "costs_scan": """SELECT strftime(l_shipdate, '%Y-%m') AS billing_period,
            strftime(l_shipdate, '%Y-%m-%dT00:00:00Z/') || strftime(l_shipdate + INTERVAL 1 DAY, '%Y-%m-%dT00:00:00Z')
                AS identity_time_interval,
            p_type AS line_item_product_code, l_returnflag AS line_item_line_item_type,
            l_linestatus AS line_item_usage_type, l_extendedprice AS line_item_unblended_cost,
            CAST(CASE WHEN l_discount = 0 THEN 0 WHEN l_quantity > 25 THEN 2 ELSE 1 END AS INTEGER) AS tag_count
            FROM lineitem LEFT JOIN part ON l_partkey = p_partkey""",
        "validate_valid": f"""SELECT review_id, brewery_id, beer_id,
            CASE WHEN review_overall <> 5 THEN review_overall END AS review_overall, review_time
            FROM ({_REVIEW}) WHERE review_overall NOT IN (1, 2, 3, 4, 6)""",
        "validate_rejected": f"""SELECT CASE review_overall WHEN 1 THEN 'review_overall' WHEN 4 THEN 'beer_id'
                WHEN 6 THEN 'brewery_id' ELSE '' END AS field,
            CASE review_overall WHEN 1 THEN 'invalid_double' WHEN 4 THEN 'missing_value'
                WHEN 6 THEN 'invalid_long' ELSE 'malformed_row' END AS reason, count(*) AS row_count
            FROM ({_REVIEW}) WHERE review_overall IN (1, 2, 3, 4, 6) GROUP BY ALL""",
        "normalize_blanks": """WITH b AS (SELECT string_agg(chr(c), '') AS blanks FROM (SELECT unnest([9, 10, 11, 12, 13, 32, 133, 160,
                5760, 8192, 8193, 8194, 8195, 8196, 8197, 8198, 8199, 8200, 8201, 8202, 8232, 8233, 8239, 8287, 12288]) AS c))
            SELECT doc_id, md5(nullif(trim(text, blanks), '')) AS text_md5, nullif(trim(lang, blanks), '') AS lang,
                   nullif(trim(source, blanks), '') AS source FROM documents, b""",
        "conform_types": """SELECT o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey, o_totalprice, o_orderdate,
            CAST(NULL AS INTEGER) AS o_orderpriority FROM orders""",
        "cdc_split_counts": f"SELECT operation, count(*) AS row_count FROM ({_CHANGES}) GROUP BY operation",
        "cdc_audit_columns": f"""SELECT user_id, event_id, value, operation,
            CASE WHEN operation = 'insert' THEN control_ts END AS created_at, control_ts AS updated_at,
            CASE WHEN operation = 'delete' THEN control_ts END AS deleted_at,
            strftime(control_ts, '%Y%m%d') AS partitioned_at FROM ({_CHANGES})""",
        "cdc_latest": f"""SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY control_ts DESC, event_id DESC) AS rn
            FROM ({_CHANGES}) WHERE operation <> 'insert') WHERE rn = 1""",
        "silver_state": _state(f"({_CHANGES})"),
        "silver_soft_deleted": f"""SELECT user_id, event_id, created_at, deleted_at
            FROM ({_state(f"({_CHANGES})")}) WHERE deleted_at IS NOT NULL""",
        "silver_active": f"""SELECT user_id, event_id, updated_at
            FROM ({_state(f"({_CHANGES})")}) WHERE deleted_at IS NULL""",
        "silver_partition_move": f"""SELECT n.user_id, o.partitioned_at AS old_partition, n.partitioned_at AS new_partition
            FROM ({_state(f"({_CHANGES})")}) n
            JOIN ({_state(f"({_CHANGES} WHERE ts < TIMESTAMP '2024-01-16')")}) o ON n.user_id = o.user_id
            WHERE o.partitioned_at <> n.partitioned_at""",
        "silver_strict_append": f"""WITH c AS ({_CHANGES}),
            m AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY control_ts DESC, event_id DESC)
                  AS rn FROM c WHERE operation <> 'insert') WHERE rn = 1),
            rows AS (
                SELECT i.user_id, coalesce(m.event_id, i.event_id) AS event_id, i.control_ts AS created_at,
                       coalesce(m.control_ts, i.control_ts) AS updated_at,
                       CASE WHEN m.operation = 'delete' THEN m.control_ts END AS deleted_at
                FROM c i LEFT JOIN m ON i.user_id = m.user_id WHERE i.operation = 'insert'
                UNION ALL
                SELECT user_id, event_id, control_ts, control_ts, CASE WHEN operation = 'delete' THEN control_ts END
                FROM m WHERE user_id NOT IN (SELECT user_id FROM c WHERE operation = 'insert'))
            SELECT user_id, count(*) AS row_count, max(event_id) AS event_id, min(created_at) AS first_created,
                   max(updated_at) AS updated_at, count(deleted_at) AS deleted_count FROM rows GROUP BY user_id""",
        "review_flat": f"{_FLAT} SELECT {_FLAT_COLUMNS} FROM flat",
        "review_flat_active": f"""{_FLAT} SELECT review_id, beer_id, profile_id, state, review_overall
            FROM flat WHERE deleted_at IS NULL""",
        "fk_orphans": f"""{_FLAT}, missing AS (
            SELECT 'review.beer_id' AS reference, beer_id AS key FROM review WHERE beer_id NOT IN (SELECT beer_id FROM beer)
            UNION ALL SELECT 'review.brewery_id', brewery_id FROM review WHERE brewery_id NOT IN (SELECT s_suppkey FROM supplier)
            UNION ALL SELECT 'review.profile_id', profile_id FROM review WHERE profile_id NOT IN (SELECT c_custkey FROM customer)
            UNION ALL SELECT 'beer.brewery_id', brewery_id FROM beer WHERE brewery_id NOT IN (SELECT s_suppkey FROM supplier)
            UNION ALL SELECT 'document.label', doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)),
            refs AS (SELECT unnest(['review.beer_id', 'review.brewery_id', 'review.profile_id', 'beer.brewery_id',
                'document.label']) AS reference)
            SELECT refs.reference, count(DISTINCT key) AS orphan_keys, count(key) AS orphan_rows
            FROM refs LEFT JOIN missing ON refs.reference = missing.reference GROUP BY refs.reference""",
        "affected_months": f"""SELECT DISTINCT review_year, review_month FROM ({_REVIEW})
            WHERE partitioned_at IN ({_days(ORDER_DAYS)})""",
        "gold_top_beers": _mart("beer_id, beer_name, beer_style", MIN_REVIEWS["top_beers_by_rating"]),
        "gold_top_breweries": _mart("brewery_id, brewery_name", MIN_REVIEWS["top_breweries_by_rating"]),
        "gold_state_volume": _mart("state", 0, "count(*) AS total_reviews"),
        "gold_top_styles": _mart("beer_style", 25, both),
        "gold_top_drinkers": _mart("profile_id, profile_name, state", 0, both),
        "gold_top_brands": _mart("brand", 25),
        "gold_active_styles": _mart("beer_style", 25, both, "deleted_at IS NULL"),
        "gold_published_styles": _mart("beer_style", 25, both),
        "gold_affected_states": _mart(
            "state", 0, "count(*) AS total_reviews",
            f"""(review_year, review_month) IN (SELECT (review_year, review_month) FROM review
                WHERE partitioned_at IN ({_days(ORDER_DAYS)}))""",
        ),
        "dash_years": f"""SELECT DISTINCT CAST(review_year AS VARCHAR) AS review_year
            FROM ({_mart("brewery_id, brewery_name", MIN_REVIEWS["top_breweries_by_rating"])})""",
        "dash_months": f"""SELECT DISTINCT lpad(CAST(review_month AS VARCHAR), 2, '0') AS review_month
            FROM ({_mart("brewery_id, brewery_name", MIN_REVIEWS["top_breweries_by_rating"])})""",
        "dash_top_beers": f"""SELECT beer_name AS "Beer", avg_rating AS "Avg Rating" FROM ({top_beers}) WHERE {month}
            ORDER BY avg_rating DESC, beer_name, beer_id LIMIT 10""",
        "dash_top_breweries": f"""SELECT brewery_name AS "Brewery", avg_rating AS "Avg Rating" FROM ({top_breweries})
            WHERE {month} ORDER BY avg_rating DESC, brewery_name, brewery_id LIMIT 10""",
        "dash_state_volume": f"""SELECT state AS "State", total_reviews AS "Reviews"
            FROM ({_mart("state", 0, "count(*) AS total_reviews")}) WHERE {month}""",
        "dash_styles": f"""SELECT beer_style AS "Style", total_reviews AS "Reviews", avg_rating AS "Avg Rating"
            FROM ({_mart("beer_style", 25, both)}) WHERE {month}""",
        "dash_top_drinkers": f"""SELECT profile_name AS "Profile", total_reviews AS "Tastings"
            FROM ({_mart("profile_id, profile_name, state", 0, both)}) WHERE {month}
            ORDER BY total_reviews DESC, profile_name, profile_id LIMIT 10""",
        "costs_periods": "SELECT DISTINCT strftime(l_shipdate, '%Y-%m') AS billing_period FROM lineitem",
        "costs_by_service": f"""{_PERIOD_COSTS} SELECT service AS "Service", {_SUM} AS "Total Cost" FROM costs
            GROUP BY service ORDER BY "Total Cost" DESC, "Service" LIMIT 10""",
        "costs_detail": f"""{_PERIOD_COSTS} SELECT kind AS "Type", service AS "Service", usage AS "Usage Type",
            {_SUM} AS "Cost" FROM costs GROUP BY kind, service, usage""",
        "costs_daily": f"""{_PERIOD_COSTS} SELECT date_trunc('day', shipped)::TIMESTAMP AS "Time", {_SUM} AS "Total Cost"
            FROM costs GROUP BY 1""",
        "costs_cumulative": f"""{_PERIOD_COSTS} SELECT date_trunc('day', shipped)::TIMESTAMP AS "Time",
            CAST(sum(sum(cost)) OVER (ORDER BY date_trunc('day', shipped)) AS DOUBLE) AS "Cumulative Cost"
            FROM costs GROUP BY date_trunc('day', shipped)""",
        "pii_fields": f"""WITH sample AS ({_PROFILE}), found AS (
            {" UNION ALL ".join(_pii_sample(c) for c in ("profile_id", "profile_name", "email", "state"))})
            SELECT field, non_empty, CAST(matches AS BIGINT) AS matches,
                coalesce(matches / nullif(non_empty, 0) >= 0.5 AND score / nullif(matches, 0) >= 0.7, false) AS is_pii
            FROM found""",
        "mask_profile": f"""SELECT profile_id, {_mask("profile_name")}, {_mask("email")}, {_mask("state")}
            FROM ({_PROFILE})""",
        "pii_document_counts": " UNION ALL ".join(
            f"""SELECT 'text' AS field, '{name}' AS rule,
                CAST(coalesce(sum({_count("text", pattern)}), 0) AS BIGINT) AS match_count,
                count(*) FILTER ({_count("text", pattern)} > 0) AS row_count FROM documents"""
            for name, pattern, score in _PII
        ),
        "pii_documents": f"""SELECT doc_id,
            {", ".join(f'CAST({_count("text", pattern)} AS INTEGER) AS {name}_count' for name, pattern, score in _PII)}
            FROM documents WHERE {" + ".join(_count("text", pattern) for name, pattern, score in _PII)} > 0""",
        "router_accepted": f"""SELECT table_name, event_id, user_id, value, operation FROM ({_ENVELOPE})
            WHERE drop_reason IS NULL""",
        "router_dropped": f"""SELECT event_id, table_name, operation, drop_reason FROM ({_ENVELOPE})
            WHERE drop_reason IS NOT NULL""",
        "router_summary": f"""SELECT table_name, CASE WHEN drop_reason IS NULL THEN 'accepted' ELSE 'dropped' END AS status,
            count(*) AS row_count FROM ({_ENVELOPE}) GROUP BY ALL""",
        "ledger_current": f"WITH {_CURRENT} SELECT * FROM current",
        "ledger_eligible": f"SELECT control_id, table_name, status, attempt_count, updated_at FROM ({pending})",
        "ledger_pending_tables": f"""WITH {_CURRENT} SELECT DISTINCT table_name FROM current WHERE status = 'pending'""",
        "ledger_register": f"""WITH fresh AS (SELECT *, {_file_key('c_custkey')} AS object_key FROM customer)
            SELECT sha256('dm_bronze|' || split_part(object_key, '/', 2) || '|' || object_key) AS control_id, object_key,
                'dm_bronze' AS schema_name, split_part(object_key, '/', 2) AS table_name,
                c_custkey * 150 AS record_count,
                CASE WHEN contains(object_key, 'dm-batch-process') THEN 'csv' ELSE 'json' END AS file_format,
                c_custkey * 64 AS file_size, sha256(c_name) AS checksum, 'pending' AS status,
                CAST(0 AS INTEGER) AS attempt_count,
                CASE WHEN c_custkey * 150 <= 100000 THEN 'small' ELSE 'bulk' END AS compute_target,
                TIMESTAMP '{NOW}' AS created_at, TIMESTAMP '{NOW}' AS updated_at
            FROM fresh WHERE object_key NOT IN (SELECT object_key FROM ({_LOG}))""",
        "ledger_size_class": """SELECT CASE WHEN c_custkey * 150 <= 100000 THEN 'small' ELSE 'bulk' END AS size_class,
            count(*) AS file_count, CAST(sum(c_custkey * 150) AS BIGINT) AS record_count FROM customer GROUP BY 1""",
        "ledger_run": f"""SELECT control_id, table_name,
            CASE WHEN table_name = 'review' THEN 'error' ELSE 'success' END AS status,
            attempt_count + 1 AS attempt_count, TIMESTAMP '{NOW}' AS started_at, TIMESTAMP '{LATER}' AS finished_at,
            CAST(epoch_ms(TIMESTAMP '{LATER}') - epoch_ms(TIMESTAMP '{NOW}') AS BIGINT) AS duration,
            CASE WHEN table_name = 'review' THEN 'no such file' END AS error_message FROM ({pending})""",
        "ledger_next_layer": f"""WITH {_CURRENT}, next AS (
            SELECT 'bronze/' || table_name || strftime(created_at, '/year=%Y/month=%m/day=%d/')
                || regexp_replace(split_part(object_key, '/', 3), '[.](csv|json)[.]gz$', '') || '.parquet' AS object_key,
                table_name, record_count FROM current WHERE status = 'success')
            SELECT sha256('dm_silver|' || table_name || '|' || object_key) AS control_id, object_key,
                'dm_silver' AS schema_name, table_name, record_count, 'parquet' AS file_format, 'emr' AS compute_target,
                'pending' AS status FROM next""",
        "ledger_flat_days": f"""WITH {_CURRENT}, {_FLAT_ENTRIES}
            SELECT sha256('dm_silver|review_flat|' || object_key) AS control_id, object_key, 'dm_silver' AS schema_name,
                'review_flat' AS table_name, record_count, 'pending' AS status, CAST(0 AS INTEGER) AS attempt_count
            FROM flat_entries""",
        "ledger_mart_fanout": f"""WITH {_CURRENT}, {_FLAT_ENTRIES}, marts AS (
            SELECT 'silver/review_flat/partitioned_at=' || day AS object_key, record_count,
                unnest({_MARTS}) AS table_name FROM flat_entries)
            SELECT sha256('dm_gold|' || table_name || '|' || object_key) AS control_id, object_key,
                'dm_gold' AS schema_name, table_name, record_count, 'pending' AS status FROM marts""",
        "ledger_health": f"""SELECT time_bucket(INTERVAL 1 HOUR, finished_at) AS window_start, table_name, status,
            count(*) AS run_count, avg(duration) AS avg_duration, max(attempt_count) AS max_attempts
            FROM ({_LOG}) WHERE finished_at IS NOT NULL GROUP BY ALL""",
    }
