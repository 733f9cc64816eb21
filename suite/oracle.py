"""The queries of ``queries.py`` as SQL over the same tables, written independently."""

from __future__ import annotations

from suite.queries import RULE_NAMES

_LANDING = [
    "row_id", "order_id", "order_date", "ship_date", "ship_mode", "customer_id", "customer_name",
    "segment", "country", "city", "postal_code", "sub_category", "sales",
]
_BUSINESS = ", ".join(_LANDING)
_RAW = "_raw_order_date, _raw_ship_date"
_DAY = "order_year, order_month, order_day"
_TYPED = f"{_BUSINESS}, {_RAW}, {_DAY}"
_WEEK = "DATE '1996-02-26' AND DATE '1996-03-03'"

_JOINED = """lineitem JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"""

_RULES = [
    ("row_id IS NULL", "row_id is null"),
    ("order_id IS NULL OR order_id = ''", "order_id is null"),
    ("order_date IS NULL", "order_date cannot be parsed"),
    ("ship_date IS NULL", "ship_date cannot be parsed"),
    ("customer_id IS NULL OR customer_id = ''", "customer_id is null"),
    ("customer_name IS NULL OR customer_name = ''", "customer_name is null or blank"),
    ("ship_date < order_date", "ship_date is earlier than order_date"),
    ("sales IS NULL OR sales <= 0", "sales is null or not greater than zero"),
    ("row_id IS NOT NULL AND copy > 1", "duplicate row_id"),
]


def _date(text: str) -> str:
    return (
        rf"CASE WHEN regexp_full_match({text}, '\d{{2}}/\d{{2}}/\d{{4}}') THEN CAST(try_strptime({text}, '%d/%m/%Y') AS DATE)"
        rf" WHEN regexp_full_match({text}, '\d{{4}}-\d{{2}}-\d{{2}}') THEN try_cast({text} AS DATE) END"
    )


def _long(text: str) -> str:
    return rf"try_cast(nullif(regexp_extract({text}, '^([+-]?\d+)(\.\d*)?$', 1), '') AS BIGINT)"


def _parts(day: str, prefix: str) -> str:
    return ", ".join(f"CAST({part}({day}) AS INTEGER) AS {prefix}_{part}" for part in ("year", "month", "day"))


def _landing(ship_by_order: bool = False, through_csv: bool = False, shared_ids: bool = False) -> str:
    """Text columns of the landing file; a CSV has no empty strings, only nulls."""
    day = "CAST(o_orderdate AS DATE)"
    shared = "WHEN 14 THEN CAST(-l_suppkey AS VARCHAR)" if shared_ids else ""
    ship = f"{day} + 5" if ship_by_order else "CAST(l_shipdate AS DATE)"
    key = "CAST(l_orderkey * 10 + l_linenumber AS VARCHAR)"
    values = {
        "row_id": f"CASE l_quantity WHEN 1 THEN NULL WHEN 2 THEN 'R' || {key} WHEN 3 THEN {key} || '.0' {shared} ELSE {key} END",
        "order_id": "CASE l_quantity WHEN 4 THEN '  ' ELSE 'O-' || l_orderkey END",
        "order_date": f"CASE l_quantity WHEN 5 THEN strftime({day}, '%Y-%m-%d') WHEN 6 THEN 'not-a-date'"
        f" ELSE strftime({day}, '%d/%m/%Y') END",
        "ship_date": f"CASE l_quantity WHEN 7 THEN 'unknown' ELSE strftime({ship}, '%d/%m/%Y') END",
        "ship_mode": "o_orderpriority",
        "customer_id": "CASE l_quantity WHEN 8 THEN '' ELSE 'C-' || c_custkey END",
        "customer_name": "CASE l_quantity WHEN 9 THEN NULL WHEN 10 THEN '   ' ELSE c_name || '  of  ' || c_mktsegment END",
        "segment": "c_mktsegment",
        "country": "n_name",
        "city": "'  City, ' || n_name || ' '",
        "postal_code": "CASE WHEN l_linestatus <> 'O' THEN CAST(c_custkey + 10000 AS VARCHAR) END",
        "sub_category": "l_returnflag",
        "sales": "CASE l_quantity WHEN 11 THEN '-1.5' WHEN 12 THEN 'n/a' WHEN 13 THEN '0'"
        " ELSE CAST(l_extendedprice AS VARCHAR) END",
    }
    wrap = "nullif({}, '')" if through_csv else "{}"
    columns = ", ".join(f"{wrap.format(value)} AS {name}" for name, value in values.items())
    return f"landing AS (SELECT {columns} FROM {_JOINED})"


def _upto_bronze(ship_by_order: bool = False, through_csv: bool = False, shared_ids: bool = False) -> str:
    columns = ", ".join(f"{_date(c)} AS {c}" if c.endswith("_date") else c for c in _LANDING)
    return (
        f"WITH {_landing(ship_by_order, through_csv, shared_ids)}, parsed AS (SELECT {columns}, order_date AS _raw_order_date,"
        f" ship_date AS _raw_ship_date FROM landing), bronze AS (SELECT *, {_parts('order_date', 'order')} FROM parsed)"
    )


def _prepared(source: str) -> str:
    columns = []
    for name in [*_LANDING, "_raw_order_date", "_raw_ship_date", "order_year", "order_month", "order_day"]:
        if name == "row_id":
            columns.append(f"{_long('trim(row_id)')} AS row_id")
        elif name == "sales":
            columns.append("try_cast(trim(sales) AS DOUBLE) AS sales")
        elif name in ("order_date", "ship_date", "order_year", "order_month", "order_day"):
            columns.append(name)
        else:
            columns.append(f"trim({name}) AS {name}")
    return f"prepared AS (SELECT {', '.join(columns)} FROM {source})"


_FINGERPRINT = (
    "sha256(concat_ws('||', "
    + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '<null>')" for c in [*_LANDING, *_DAY.split(", ")])
    + "))"
)


def _upto_silver(ship_by_order: bool = False, through_csv: bool = False, shared_ids: bool = False) -> str:
    reason = ", ".join(f"CASE WHEN {test} THEN '{text}' END" for test, text in _RULES)
    return (
        f"{_upto_bronze(ship_by_order, through_csv, shared_ids)}, {_prepared('(SELECT * FROM bronze WHERE order_date IS NOT NULL)')},"
        f" ranked AS (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY {_FINGERPRINT}) AS copy FROM prepared),"
        f" evaluated AS (SELECT *, concat_ws('; ', {reason}) AS _rejection_reason FROM ranked),"
        " silver AS (SELECT * FROM evaluated WHERE _rejection_reason = ''),"
        " rejected AS (SELECT * FROM evaluated WHERE _rejection_reason <> '')"
    )


_SALES = f"""SELECT order_id, order_date, shipment_date, shipment_mode, city, {_parts('order_date', 'order')}
    FROM (SELECT order_id, min(order_date) AS order_date, min(ship_date) AS shipment_date,
                 min(ship_mode) AS shipment_mode, min(city) AS city FROM silver GROUP BY order_id)"""


def _within(months: int, end: str, day: str = "order_date") -> str:
    return f"{day} BETWEEN CAST({end} - INTERVAL {months} MONTH AS DATE) AND {end}"


_NAME = r"string_split_regex(trim(customer_name), '\s+')"
_CUSTOMERS = f"""SELECT customer_id, min({_NAME}[1]) AS customer_first_name,
        min(CASE WHEN len({_NAME}) > 1 THEN array_to_string({_NAME}[2:], ' ') END) AS customer_last_name,
        min(segment) AS customer_segment, min(country) AS country,
        count(DISTINCT CASE WHEN {_within(1, 'latest')} THEN order_id END) AS orders_last_month,
        count(DISTINCT CASE WHEN {_within(6, 'latest')} THEN order_id END) AS orders_last_6_months,
        count(DISTINCT order_id) AS orders_all_time,
        min(latest) AS snapshot_date, {_parts('min(latest)', 'snapshot')}
    FROM silver, (SELECT max(order_date) AS latest FROM silver) GROUP BY customer_id"""

_CUSTOMER_LINES = f"""WITH silver AS (SELECT c_custkey AS customer_id, o_orderkey AS order_id,
        CAST(o_orderdate AS DATE) AS order_date FROM {_JOINED}),
    latest AS (SELECT max(order_date) AS latest FROM silver)"""


def _conflict(column: str, null_is_value: bool = False) -> str:
    value = f"coalesce({column}, '<null>')" if null_is_value else column
    return f"count(DISTINCT {value}) > 1 AS {column}_conflict"


def _conflicts(key: str, columns: list[str], null_is_value: bool = False) -> str:
    flags = ", ".join(_conflict(c, null_is_value) for c in columns)
    anyone = " OR ".join(f"{c}_conflict" for c in columns)
    return f"SELECT * FROM (SELECT {key}, {flags} FROM {{}} GROUP BY {key}) WHERE {anyone}"


_ORDER_CONFLICTS = _conflicts("order_id", ["order_date", "ship_date", "ship_mode", "city"]).format("silver")
_CUSTOMER_CONFLICTS = _conflicts("customer_id", ["customer_name", "segment", "country"], True).format(
    f"""(SELECT c_custkey AS customer_id, c_name AS customer_name,
        CASE WHEN o_orderstatus <> 'P' THEN c_mktsegment END AS segment, n_name AS country FROM {_JOINED})"""
)

_LAYERS = _upto_silver(ship_by_order=True, through_csv=True)
_COUNTS = f"""{_LAYERS}, c AS (SELECT (SELECT count(*) FROM landing) AS landed,
    (SELECT count(*) FROM bronze WHERE order_date IS NOT NULL) AS b, (SELECT count(*) FROM bronze WHERE order_date IS NULL) AS bq,
    (SELECT count(*) FROM silver) AS s, (SELECT count(*) FROM rejected) AS sq,
    (SELECT count(*) FROM rejected WHERE _rejection_reason LIKE '%duplicate row_id%') AS d,
    (SELECT count(DISTINCT order_id) FROM silver) AS o, (SELECT count(DISTINCT customer_id) FROM silver) AS k,
    (SELECT max(order_date) FROM silver) AS latest,
    (SELECT count(DISTINCT order_id) FROM silver WHERE {_within(1, '(SELECT max(order_date) FROM silver)')}) AS o1,
    (SELECT count(DISTINCT order_id) FROM silver WHERE {_within(6, '(SELECT max(order_date) FROM silver)')}) AS o6)"""


def _metrics(values: dict[str, str]) -> str:
    return " UNION ALL ".join(f"SELECT '{n}' AS metric, CAST({v} AS VARCHAR) AS actual FROM c" for n, v in values.items())


def _events() -> str:
    """(job, event, status, dataset, input, output, rejected, duplicate) of one full run."""
    n = "NULL"
    rows = [
        ("bronze_ingestion", "job_start", "started", n, n, n, n, n),
        ("bronze_ingestion", "input_read", n, n, "landed", n, n, n),
        ("bronze_ingestion", "data_transformed", n, n, n, "b", "bq", n),
        ("bronze_ingestion", "output_written", n, "bronze", n, "b", n, n),
        ("bronze_ingestion", "output_written", n, "bronze_quarantine", n, "bq", n, n),
        ("bronze_ingestion", "catalog_registered", n, "retail_sales_bronze", n, n, n, n),
        ("bronze_ingestion", "job_end", "succeeded", n, "landed", "b", "bq", n),
        ("silver_cleansing", "job_start", "started", n, n, n, n, n),
        ("silver_cleansing", "input_read", n, n, "b", n, n, n),
        ("silver_cleansing", "data_transformed", n, n, "b", "s", "sq", "d"),
        ("silver_cleansing", "output_written", n, "silver", n, "s", n, n),
        ("silver_cleansing", "output_written", n, "silver_quarantine", n, "sq", n, n),
        ("silver_cleansing", "catalog_registered", n, "retail_sales_silver", n, n, n, n),
        ("silver_cleansing", "job_end", "succeeded", n, "b", "s", "sq", "d"),
    ]
    for job, rolled_up in (("gold_sales", "o"), ("gold_customer", "k")):
        rows += [
            (job, "job_start", "started", n, n, n, n, n),
            (job, "input_read", n, n, "s", n, n, n),
            (job, "data_transformed", n, n, "s", rolled_up, n, n),
            (job, "output_written", n, job, n, rolled_up, n, n),
            (job, "catalog_registered", n, f"retail_sales_{job}", n, n, n, n),
            (job, "output_written", n, f"{job}_csv", n, rolled_up, n, n),
            (job, "job_end", "succeeded", n, "s", rolled_up, n, n),
        ]
    names = ("input_row_count", "output_row_count", "rejected_row_count", "duplicate_row_count")
    selects = []
    for job, event, status, dataset, *counts in rows:
        text, name = ("NULL" if v == n else f"'{v}'" for v in (status, dataset))
        numbers = ", ".join(f"CAST({v} AS BIGINT) AS {name}" for v, name in zip(counts, names))
        selects.append(
            f"SELECT '{job}' AS job_name, 'run-1' AS pipeline_run_id, '{event}' AS event,"
            f" CAST({text} AS VARCHAR) AS status, {numbers}, CAST({name} AS VARCHAR) AS dataset FROM c"
        )
    return " UNION ALL ".join(selects)


_QUARANTINED = ", ".join(c for c in _TYPED.split(", ") if c not in ("row_id", "sales"))

ORACLE: dict[str, str] = {
    "normalized_names": f"WITH {_landing()} SELECT * FROM landing",
    "renamed_collisions": "SELECT p_partkey AS part_key, p_name AS part_name, p_brand AS part_name_2,"
    " p_type AS part_name_3 FROM part",
    "parsed_dates": f"{_upto_bronze()} SELECT row_id, {_RAW}, order_date, ship_date FROM bronze",
    "date_columns": f"SELECT event_id, CAST(ts AS DATE) AS day, {_parts('ts', 'event')} FROM events",
    "trimmed_strings": f"WITH {_landing()} SELECT {', '.join(f'trim({c}) AS {c}' for c in _LANDING)} FROM landing",
    "lenient_numbers": f"""WITH {_landing()} SELECT row_id AS row_text, {_long('row_id')} AS row_long,
        sales AS sales_text, try_cast(sales AS DOUBLE) AS sales_double, {_long('sales')} AS sales_long,
        {_long('order_date')} AS date_long FROM landing""",
    "split_names": r"""SELECT p_partkey, p_name AS name, string_split_regex(trim(p_name), '\s+')[1] AS first_name,
        CASE WHEN len(string_split_regex(trim(p_name), '\s+')) > 1
             THEN array_to_string(string_split_regex(trim(p_name), '\s+')[2:], ' ') END AS last_name FROM part""",
    "parsed_event_days": "SELECT event_id, CAST(ts AS DATE) AS from_date, CAST(ts AS DATE) AS from_timestamp,"
    " CAST(ts AS DATE) AS from_text FROM events",
    "bronze_valid": f"{_upto_bronze()} SELECT {_TYPED}, 'run-1' AS _pipeline_run_id FROM bronze WHERE order_date IS NOT NULL",
    "bronze_malformed": f"{_upto_bronze()} SELECT {_TYPED}, 'order_date cannot be parsed' AS _rejection_reason"
    " FROM bronze WHERE order_date IS NULL",
    "lineage": """SELECT 'run-1' AS _pipeline_run_id, count(*) AS "rows", CAST(1 AS BIGINT) AS times,
        count(*) AS with_source FROM lineitem""",
    "silver_prepared": f"{_upto_silver()} SELECT {_TYPED} FROM prepared",
    "row_fingerprints": f"{_upto_silver()} SELECT row_id, sales, {_FINGERPRINT} AS fingerprint FROM prepared",
    "kept_of_repeated": f"""{_upto_silver()}, printed AS (SELECT *, {_FINGERPRINT} AS fingerprint FROM prepared
            WHERE row_id IS NOT NULL),
        counted AS (SELECT *, count(*) OVER (PARTITION BY row_id) AS n,
            row_number() OVER (PARTITION BY row_id ORDER BY fingerprint) AS place FROM printed)
        SELECT {_BUSINESS}, fingerprint FROM counted WHERE place = 1 AND n > 1""",
    "silver_valid": f"{_upto_silver()} SELECT {_TYPED} FROM silver",
    "silver_rejected": f"{_upto_silver()} SELECT {_TYPED}, _rejection_reason FROM rejected",
    "silver_rejection_profile": f"""{_upto_silver()} SELECT reason, count(*) AS "rows"
        FROM (SELECT unnest(string_split(_rejection_reason, '; ')) AS reason FROM rejected) GROUP BY reason""",
    "silver_duplicate_count": f"""{_upto_silver()} SELECT count(*) AS "rows" FROM rejected
        WHERE _rejection_reason LIKE '%duplicate row_id%'""",
    "rule_duplicate_row_id": f"{_upto_silver()} SELECT {_BUSINESS} FROM ranked WHERE row_id IS NOT NULL AND copy > 1",
    "order_conflicts": f"{_upto_silver()} {_ORDER_CONFLICTS}",
    "customer_conflicts": _CUSTOMER_CONFLICTS,
    "gold_sales": f"{_upto_silver(ship_by_order=True)} {_SALES}",
    "gold_customers": f"{_upto_silver(ship_by_order=True)} {_CUSTOMERS}",
    "latest_order_date": "SELECT CAST(max(o_orderdate) AS DATE) AS snapshot_date FROM orders",
    "rolling_orders": f"""{_CUSTOMER_LINES} SELECT customer_id,
        count(DISTINCT CASE WHEN {_within(1, 'latest')} THEN order_id END) AS orders_last_month,
        count(DISTINCT CASE WHEN {_within(6, 'latest')} THEN order_id END) AS orders_last_6_months,
        count(DISTINCT order_id) AS orders_all_time FROM silver, latest GROUP BY customer_id""",
    "rolling_distinct_orders": f"""{_CUSTOMER_LINES}, c AS (SELECT
        count(DISTINCT CASE WHEN {_within(1, 'latest')} THEN order_id END) AS o1,
        count(DISTINCT CASE WHEN {_within(6, 'latest')} THEN order_id END) AS o6,
        count(DISTINCT order_id) AS o FROM silver, latest) """
    + _metrics({"orders_last_month": "o1", "orders_last_6_months": "o6", "orders_all_time": "o"}),
    "csv_round_trip": f"WITH {_landing(through_csv=True)} SELECT * FROM landing",
    "csv_text_round_trip": "SELECT doc_id, nullif(text, '') AS text, nullif(lang, '') AS lang,"
    " nullif(source, '') AS source, n_chars FROM documents",
    "partitioned_round_trip": f"{_upto_bronze()} SELECT {_TYPED} FROM bronze WHERE order_date IS NOT NULL",
    "days_read_from_partitions": f"{_upto_bronze()} SELECT {_TYPED} FROM bronze WHERE order_date BETWEEN {_WEEK}",
    "partitions_overwritten": f"""{_upto_bronze()} SELECT * REPLACE
        (CASE WHEN order_date BETWEEN {_WEEK} THEN 'moved' ELSE city END AS city) FROM bronze WHERE order_date IS NOT NULL""",
    "published_table": f"{_upto_bronze()} SELECT {_TYPED} FROM bronze WHERE order_date IS NOT NULL",
    "layered_silver": f"{_LAYERS} SELECT {_TYPED} FROM silver",
    "layered_quarantines": f"""{_LAYERS} SELECT {_QUARANTINED}, 'order_date cannot be parsed' AS _rejection_reason,
            row_id AS row_id_text, sales AS sales_text, CAST(NULL AS BIGINT) AS row_id, CAST(NULL AS DOUBLE) AS sales
        FROM bronze WHERE order_date IS NULL
        UNION ALL SELECT {_QUARANTINED}, _rejection_reason, NULL, NULL, row_id, sales FROM rejected""",
    "layered_gold_sales": f"{_LAYERS} {_SALES}",
    "layered_gold_customers": f"{_LAYERS} {_CUSTOMERS}",
    "gold_csv_copy": f"{_LAYERS} SELECT CAST(COLUMNS(*) AS VARCHAR) FROM ({_SALES})",
    "layer_counts": f"{_COUNTS} "
    + _metrics(
        {"bronze": "b", "bronze_quarantine": "bq", "silver": "s", "silver_quarantine": "sq", "sales": "o", "customers": "k"}
    ),
    "reconciled_layers": f"{_COUNTS}, m AS ("
    + _metrics(
        {
            "bronze_rows": "b",
            "silver_valid_rows": "s",
            "silver_quarantine_rows": "sq",
            "gold_sales_rows": "o",
            "gold_customer_rows": "k",
            "gold_sales_csv_rows": "o",
            "gold_customer_csv_rows": "k",
            "latest_order_date": "latest",
            "last_month_distinct_orders": "o1",
            "last_six_month_distinct_orders": "o6",
            "all_time_distinct_orders": "o",
        }
    )
    + """), e AS (SELECT metric, actual, CASE metric WHEN 'silver_quarantine_rows' THEN '0' ELSE actual END AS expected
            FROM m)
        SELECT metric, actual, expected, actual = expected AS ok FROM e""",
    "run_events": f"{_COUNTS} {_events()}",
    "daily_increments": f"""{_upto_silver(through_csv=True, shared_ids=True)} SELECT {_TYPED},
        CASE WHEN order_date >= DATE '1995-07-01' OR (order_date >= DATE '1995-06-01' AND ship_mode = '1-URGENT')
             THEN 'late' ELSE 'early' END AS _pipeline_run_id FROM silver""",
    "daily_gold_customers": f"{_upto_silver(through_csv=True)} {_CUSTOMERS}",
    "daily_order_conflicts": f"{_upto_silver(through_csv=True)} {_ORDER_CONFLICTS}",
    "customer_csv_copy": f"{_LAYERS} SELECT CAST(COLUMNS(*) AS VARCHAR) FROM ({_CUSTOMERS})",
    "published_layers": f"{_COUNTS} "
    + _metrics(
        {
            "retail_sales_bronze": "b",
            "retail_sales_silver": "s",
            "retail_sales_gold_sales": "o",
            "retail_sales_gold_customer": "k",
        }
    ),
    "missing_columns": """SELECT count(*) AS "rows", 'Missing required columns: city, sales' AS message FROM lineitem""",
    "conflicting_orders_message": f"""{_upto_silver()}, found AS (SELECT order_id FROM ({_ORDER_CONFLICTS}))
        SELECT (SELECT count(*) FROM silver) AS "rows",
            'Conflicting order-level attributes detected for order_id(s): ' || (SELECT string_agg(order_id, ', ' ORDER BY order_id)
                FROM (SELECT order_id FROM found ORDER BY order_id LIMIT 10)) AS message""",
}
for _position, _name in enumerate(RULE_NAMES):
    _test, _text = _RULES[_position]
    _all = f"{_upto_bronze()}, {_prepared('bronze')}"
    ORACLE[_name] = f"{_all} SELECT {_BUSINESS}, '{_text}' AS reason FROM prepared WHERE {_test}"
