"""One query per operator, over whole tables."""

from __future__ import annotations

import datetime
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from assayer import (
    RETAIL_CLEAN,
    RETAIL_CUSTOMERS,
    RETAIL_INGEST,
    RETAIL_ORDERS,
    KeyIndex,
    Publish,
    between_days,
    check_orders,
    normalize_columns,
    publish_table,
    read_csv,
    read_parquet,
    require_columns,
    run_all,
    run_bronze,
    run_facts,
    run_gold_customers,
    run_gold_sales,
    run_silver,
    split_bronze,
    split_silver,
    to_bronze,
    to_gold_customers,
    to_gold_sales,
    write_csv,
    write_parquet,
)
from assayer.functions import date_parts, parse_date, split_name, to_double, to_long
from assayer.operators.cleanse import prepare, trim_strings
from assayer.operators.consistency import conflicts
from assayer.operators.duplicates import first_per_key, repeated_keys, with_fingerprint
from assayer.operators.ingest import parse_dates
from assayer.operators.rollups import distinct_orders, latest_date, roll_up_customers, snapshot_date
from assayer.operators.rules import count_rejected_for, rejection_profile
from assayer.plans.facts import Facts
from assayer.plans.jobs import BRONZE_TABLE, CUSTOMER_TABLE, FOLDERS, SALES_TABLE, SILVER_TABLE
from assayer.plans.metrics import as_metrics, count_rows, layer_metrics, reconcile
from assayer.sources.scratch import Scratch
from suite.shape import RUN_ID, bronze, bronze_table, landing, lines, silver_table, stage, table

Query = Callable[[SparkSession, str], DataFrame]

_BUSINESS = [
    "row_id", "order_id", "order_date", "ship_date", "ship_mode", "customer_id", "customer_name",
    "segment", "country", "city", "postal_code", "sub_category", "sales",
]
_RAW = ["_raw_order_date", "_raw_ship_date"]
_DAY = RETAIL_CLEAN.partitions
_TYPED = [*_BUSINESS, *_RAW, *_DAY]
_WEEK = (datetime.date(1996, 2, 26), datetime.date(1996, 3, 3))


def _fresh(spark: SparkSession) -> str:
    """A new folder below the shared scratch folder, for queries that write."""
    return Scratch(spark).path


# --- columns and expressions -------------------------------------------------


def normalized_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize_columns(landing(spark, sf_dir))


def renamed_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headers that differ only in letter case and punctuation."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    return normalize_columns(part.toDF("Part-Key", "Part Name", "part_name", "PART  NAME"))


def parsed_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = landing(spark, sf_dir).transform(normalize_columns).transform(parse_dates, RETAIL_INGEST)
    return parsed.select("row_id", *_RAW, "order_date", "ship_date")


def date_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("date").alias("day"))
    return events.withColumns(date_parts(F.col("day"), "event"))


def trimmed_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trim_strings(normalize_columns(landing(spark, sf_dir)))


def lenient_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole numbers and doubles out of text of all kinds."""
    raw = normalize_columns(landing(spark, sf_dir))
    return raw.select(
        F.col("row_id").alias("row_text"),
        to_long(F.col("row_id"), StringType()).alias("row_long"),
        F.col("sales").alias("sales_text"),
        to_double(F.col("sales")).alias("sales_double"),
        to_long(F.col("sales"), StringType()).alias("sales_long"),
        to_long(F.col("order_date"), StringType()).alias("date_long"),
    )


def split_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("name"))
    first, last = split_name(F.col("name"))
    return names.withColumns({"first_name": first, "last_name": last})


def parsed_event_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates that are typed already, and ISO timestamps as text, pass the parser."""
    ts = F.col("ts")
    return table(spark, sf_dir, "events").select(
        "event_id",
        parse_date(ts.cast("date"), "dd/MM/yyyy").alias("from_date"),
        parse_date(ts, "dd/MM/yyyy").alias("from_timestamp"),
        parse_date(F.date_format(ts, "dd/MM/yyyy"), "dd/MM/yyyy").alias("from_text"),
    )


# --- bronze ------------------------------------------------------------------


def bronze_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_bronze(bronze(spark, sf_dir)).valid.select(*_TYPED, "_pipeline_run_id")


def bronze_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejected = split_bronze(bronze(spark, sf_dir)).rejected
    return rejected.select(*_BUSINESS, *_RAW, *_DAY, "_rejection_reason")


def lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stamps over a written file: one run, one time, one source folder."""
    path = _fresh(spark)
    write_csv(landing(spark, sf_dir), path)
    stamped = to_bronze(read_csv(spark, path), RUN_ID)
    return stamped.groupBy("_pipeline_run_id").agg(
        F.count(F.lit(1)).alias("rows"),
        F.countDistinct("_ingestion_timestamp").alias("times"),
        F.count_if(F.col("_source_file").contains(path.rsplit("/", 1)[1])).alias("with_source"),
    )


# --- silver ------------------------------------------------------------------


def silver_prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid = split_bronze(bronze(spark, sf_dir)).valid
    return prepare(valid, RETAIL_CLEAN).select(*_TYPED)


def row_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepared = prepare(split_bronze(bronze(spark, sf_dir)).valid, RETAIL_CLEAN)
    return with_fingerprint(prepared, name="fingerprint").select("row_id", "sales", "fingerprint")


def kept_of_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The row with the smallest fingerprint, for keys that repeat."""
    prepared = with_fingerprint(prepare(bronze_table(spark, sf_dir), RETAIL_CLEAN), name="fingerprint")
    contested = prepared.join(repeated_keys(prepared, "row_id"), "row_id", "left_semi")
    return first_per_key(contested, "row_id", "fingerprint").select(*_BUSINESS, "fingerprint")


def silver_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_silver(bronze_table(spark, sf_dir)).valid.select(*_TYPED)


def silver_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_silver(bronze_table(spark, sf_dir)).rejected.select(*_TYPED, "_rejection_reason")


def silver_rejection_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejection_profile(split_silver(bronze_table(spark, sf_dir)).rejected)


def silver_duplicate_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_rejected_for(split_silver(bronze_table(spark, sf_dir)).rejected, RETAIL_CLEAN.duplicate_reason)


def _rule(position: int) -> Query:
    def broken(spark: SparkSession, sf_dir: str) -> DataFrame:
        rule = RETAIL_CLEAN.rules[position]
        prepared = prepare(bronze(spark, sf_dir), RETAIL_CLEAN)
        return prepared.where(rule.broken()).select(*_BUSINESS, F.lit(rule.reason).alias("reason"))

    return broken


def rule_duplicate_row_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejected = split_silver(bronze_table(spark, sf_dir)).rejected
    return rejected.where(F.col("_rejection_reason").contains(RETAIL_CLEAN.duplicate_reason)).select(*_BUSINESS)


# --- gold --------------------------------------------------------------------


def order_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conflicts(silver_table(spark, sf_dir), RETAIL_ORDERS.key, list(RETAIL_ORDERS.attributes))


def customer_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The segment is missing on pending orders, and a missing value counts as a value."""
    rows = lines(spark, sf_dir).select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.when(F.col("o_orderstatus") != "P", F.col("c_mktsegment")).alias("segment"),
        F.col("n_name").alias("country"),
    )
    return conflicts(rows, RETAIL_CUSTOMERS.key, RETAIL_CUSTOMERS.stable, null_is_value=True)


def gold_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_gold_sales(silver_table(spark, sf_dir, ship_by_order=True))


def gold_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_gold_customers(silver_table(spark, sf_dir, ship_by_order=True))


def latest_order_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("order_date"))
    return latest_date(dated, "order_date")


def _customer_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines(spark, sf_dir).select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.col("c_mktsegment").alias("segment"),
        F.col("n_name").alias("country"),
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
    )


def rolling_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trailing order counts per customer."""
    rows = _customer_lines(spark, sf_dir)
    counts = roll_up_customers(rows, RETAIL_CUSTOMERS, snapshot_date(rows, "order_date"))
    return counts.select("customer_id", *RETAIL_CUSTOMERS.windows)


def rolling_distinct_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trailing order counts of the whole table."""
    rows = _customer_lines(spark, sf_dir)
    end = snapshot_date(rows, "order_date")
    return as_metrics(distinct_orders(rows, "order_id", "order_date", end, RETAIL_CUSTOMERS.windows))


# --- sources, sinks, jobs ----------------------------------------------------


def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _fresh(spark)
    write_csv(landing(spark, sf_dir), path)
    return normalize_columns(read_csv(spark, path))


def csv_text_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents with their line breaks, commas and quotes."""
    path = _fresh(spark)
    write_csv(table(spark, sf_dir, "documents"), path)
    numbers = {name: F.col(name).cast("long") for name in ("doc_id", "n_chars")}
    return read_csv(spark, path).withColumns(numbers)


def partitioned_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _fresh(spark)
    write_parquet(split_bronze(bronze(spark, sf_dir)).valid, path, _DAY)
    return read_parquet(spark, path).select(*_TYPED)


def days_read_from_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _fresh(spark)
    write_parquet(split_bronze(bronze(spark, sf_dir)).valid, path, _DAY)
    return between_days(read_parquet(spark, path), *_WEEK).select(*_TYPED)


def partitions_overwritten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A week is written a second time, with other cities; the other days stay."""
    path = _fresh(spark)
    valid = split_bronze(bronze(spark, sf_dir)).valid
    write_parquet(valid, path, _DAY)
    week = valid.where(F.col("order_date").between(*map(F.lit, _WEEK)))
    write_parquet(week.withColumn("city", F.lit("moved")), path, _DAY, "overwrite_partitions")
    return read_parquet(spark, path).select(*_TYPED)


def published_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _fresh(spark)
    database = "published_" + path.rsplit("-", 1)[1]
    valid = split_bronze(bronze(spark, sf_dir)).valid
    write_parquet(valid, f"{path}/lines", _DAY)
    publish_table(spark, valid.schema, database, "lines", f"{path}/lines", _DAY, f"{path}/db")
    return spark.table(f"{database}.lines").select(*_TYPED)


def _landed(spark: SparkSession, sf_dir: str) -> str:
    """A root folder with the landing file in it."""
    root = _fresh(spark)
    write_csv(landing(spark, sf_dir, ship_by_order=True), f"{root}/landing", compression="gzip")
    return root


def _layers(spark: SparkSession, sf_dir: str, *gold: Callable) -> dict[str, str]:
    """The places of Bronze and Silver after their jobs, and of Gold after the jobs given."""
    root = _landed(spark, sf_dir)
    at = {name: f"{root}/{folder}" for name, folder in FOLDERS.items()}
    run_bronze(spark, f"{root}/landing", at["bronze"], RUN_ID, at["bronze_quarantine"])
    run_silver(spark, at["bronze"], at["silver"], at["silver_quarantine"], RUN_ID)
    for job in gold:
        name = "sales" if job is run_gold_sales else "customers"
        job(spark, at["silver"], at[name], RUN_ID, csv_path=at[f"{name}_csv"])
    return at


def _all_layers(spark: SparkSession, sf_dir: str) -> tuple[dict[str, str], str]:
    """The places of the input and all outputs of a full run, and the database they are published in."""
    root = _landed(spark, sf_dir)
    database = "layers_" + root.rsplit("-", 1)[1]
    run_all(spark, f"{root}/landing", root, RUN_ID, publish=Publish(database, database_location=f"{root}/db"))
    return {"landing": f"{root}/landing"} | {name: f"{root}/{folder}" for name, folder in FOLDERS.items()}, database


def layered_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_parquet(spark, _layers(spark, sf_dir)["silver"]).select(*_TYPED)


def layered_quarantines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze keeps row id and sales as text, Silver as numbers."""
    at = _layers(spark, sf_dir)
    both = [read_parquet(spark, at[name]) for name in ("bronze_quarantine", "silver_quarantine")]
    same = [c for c in _TYPED if c not in ("row_id", "sales")] + ["_rejection_reason"]
    texts = [F.col(c).alias(f"{c}_text") for c in ("row_id", "sales")]
    bronze_rows = both[0].select(*same, *texts, F.lit(None).cast("long").alias("row_id"), F.lit(None).cast("double").alias("sales"))
    no_texts = [F.lit(None).cast("string").alias(f"{c}_text") for c in ("row_id", "sales")]
    return bronze_rows.union(both[1].select(*same, *no_texts, "row_id", "sales"))


def layered_gold_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_parquet(spark, _layers(spark, sf_dir, run_gold_sales)["sales"]).select(*RETAIL_ORDERS.columns)


def layered_gold_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = _layers(spark, sf_dir, run_gold_customers)
    return read_parquet(spark, at["customers"]).select(*RETAIL_CUSTOMERS.columns)


def gold_csv_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As text, the way an inspector of the copy reads it."""
    return read_csv(spark, _layers(spark, sf_dir, run_gold_sales)["sales_csv"])


def customer_csv_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_csv(spark, _layers(spark, sf_dir, run_gold_customers)["customers_csv"])


def layer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    at, _ = _all_layers(spark, sf_dir)
    counted = ("bronze", "bronze_quarantine", "silver", "silver_quarantine", "sales", "customers")
    return count_rows({name: read_parquet(spark, at[name]) for name in counted})


def published_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the tables that a full run publishes."""
    _, database = _all_layers(spark, sf_dir)
    names = (BRONZE_TABLE, SILVER_TABLE, SALES_TABLE, CUSTOMER_TABLE)
    return count_rows({name: spark.table(f"{database}.{name}") for name in names})


def reconciled_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All metrics of the written layers against those of the layers as functions, one of them made wrong."""
    at, _ = _all_layers(spark, sf_dir)
    parquet = [at[n] for n in ("bronze", "silver", "silver_quarantine", "sales", "customers")]
    copies = [read_csv(spark, at[n]) for n in ("sales_csv", "customers_csv")]
    metrics = layer_metrics(*[read_parquet(spark, path) for path in parquet], *copies)

    lines_read = read_csv(spark, at["landing"])
    valid = Scratch(spark).stage(split_bronze(to_bronze(lines_read, RUN_ID)).valid, "bronze")
    silver, rejected = split_silver(valid)
    sales, customers = to_gold_sales(silver), to_gold_customers(silver)
    expected = layer_metrics(valid, silver, rejected, sales, customers, sales, customers)
    wanted = {r["metric"]: r["actual"] for r in expected.collect()} | {"silver_quarantine_rows": 0}
    return reconcile(spark, metrics, wanted)


def run_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    at, database = _all_layers(spark, sf_dir)
    return read_parquet(spark, at["events"]).select(
        "job_name", "pipeline_run_id", "event", "status", "input_row_count", "output_row_count",
        "rejected_row_count", "duplicate_row_count",
        F.regexp_replace("dataset", f"^{database}[.]", "").alias("dataset"),
    )


def daily_increments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries, split at a day, the first of them loaded twice. The second brings late rows of the
    last month before that day, and row ids that also occur on earlier days."""
    root = _fresh(spark)
    raw = stage(landing(spark, sf_dir, shared_ids=True), "landing")  # joined once for all deliveries
    day, cut, month = parse_date(F.col("Order Date"), "dd/MM/yyyy"), datetime.date(1995, 7, 1), datetime.date(1995, 6, 1)
    late = (day >= F.lit(cut)) | ((day >= F.lit(month)) & (F.col("Ship Mode") == "1-URGENT"))
    late = F.coalesce(late, F.lit(True))
    deliveries = {
        "early": (raw.where(~late), (datetime.date(1970, 1, 1), datetime.date(1995, 6, 30))),
        "late": (raw.where(late), (month, datetime.date(2069, 12, 31))),
    }
    for name, (rows, _) in deliveries.items():
        write_csv(rows, f"{root}/landing/{name}", compression="gzip")
    index = KeyIndex(f"{root}/index")
    for name in ("early", "late", "early"):
        run_bronze(spark, f"{root}/landing/{name}", f"{root}/bronze", name, mode="overwrite_partitions", index=index)
        run_silver(spark, f"{root}/bronze", f"{root}/silver", f"{root}/rejected", name, days=deliveries[name][1], index=index)
    return read_parquet(spark, f"{root}/silver").select(*_TYPED, "_pipeline_run_id")


def _daily_facts(spark: SparkSession, sf_dir: str, kind: str) -> tuple[Facts, str]:
    """The facts of orders or customers, and where the layers lie, after three deliveries. The second one brings the
    last months with wrong customers and cities on urgent orders, the third brings the same days as they should be."""
    root = _fresh(spark)
    raw = stage(landing(spark, sf_dir), "landing")  # joined once for all deliveries
    day, cut, end = parse_date(F.col("Order Date"), "dd/MM/yyyy"), datetime.date(1998, 4, 1), datetime.date(2069, 12, 31)
    late = raw.where(F.coalesce(day >= F.lit(cut), F.lit(True)))
    urgent = F.col("Ship Mode") == "1-URGENT"
    wrong = late.withColumns(
        {name: F.when(urgent, F.concat(name, F.lit(" wrong"))).otherwise(F.col(name)) for name in ("Customer ID", "City")}
    )
    deliveries = [
        ("early", raw.where(day < F.lit(cut)), (datetime.date(1970, 1, 1), cut - datetime.timedelta(1))),
        ("late", wrong, (cut, end)),
        ("late", late, (cut, end)),
    ]
    index, facts = KeyIndex(f"{root}/index"), None
    with ThreadPoolExecutor(1) as pool:
        for i, (name, rows, days) in enumerate(deliveries):
            # Facts read Silver alone, so Bronze takes the next delivery in beside them.
            write_csv(rows, f"{root}/landing/{i}", compression="gzip")
            run_bronze(spark, f"{root}/landing/{i}", f"{root}/bronze", name, mode="overwrite_partitions", index=index)
            if facts:
                facts.result()
            run = run_silver(spark, f"{root}/bronze", f"{root}/silver", f"{root}/rejected", name, days=days, index=index)
            facts = pool.submit(
                run_facts, spark, f"{root}/silver", f"{root}/facts", name, days=run.days if i else None, kinds=(kind,)
            )
        return facts.result()[kind], root


def daily_gold_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer snapshot of facts that were kept from delivery to delivery."""
    facts, root = _daily_facts(spark, sf_dir, "customers")
    run_gold_customers(spark, facts, f"{root}/customers", RUN_ID)
    return read_parquet(spark, f"{root}/customers").select(*RETAIL_CUSTOMERS.columns)


def daily_order_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders in conflict, judged anew where a delivery touched them."""
    facts, _ = _daily_facts(spark, sf_dir, "orders")
    return facts.conflicts(spark)


# --- errors, as the text that a caller gets ------------------------------------


def _error(work: Callable[[], object]) -> str:
    try:
        work()
    except ValueError as error:
        return str(error)
    return ""


def missing_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = normalize_columns(landing(spark, sf_dir)).drop("city", "sales")
    message = _error(lambda: require_columns(rows, RETAIL_CLEAN.required))
    return rows.agg(F.count(F.lit(1)).alias("rows")).withColumn("message", F.lit(message))


def conflicting_orders_message(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first ten orders whose lines disagree, in the error of the check."""
    silver = silver_table(spark, sf_dir)
    message = _error(lambda: check_orders(silver))
    return silver.agg(F.count(F.lit(1)).alias("rows")).withColumn("message", F.lit(message))


RULE_NAMES = [
    "rule_row_id_missing",
    "rule_order_id_missing",
    "rule_order_date_unparsed",
    "rule_ship_date_unparsed",
    "rule_customer_id_missing",
    "rule_customer_name_blank",
    "rule_shipped_before_ordered",
    "rule_sales_not_positive",
]

QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        normalized_names,
        renamed_collisions,
        parsed_dates,
        date_columns,
        trimmed_strings,
        lenient_numbers,
        split_names,
        parsed_event_days,
        bronze_valid,
        bronze_malformed,
        lineage,
        silver_prepared,
        row_fingerprints,
        kept_of_repeated,
        silver_valid,
        silver_rejected,
        silver_rejection_profile,
        silver_duplicate_count,
        rule_duplicate_row_id,
        order_conflicts,
        customer_conflicts,
        gold_sales,
        gold_customers,
        latest_order_date,
        rolling_orders,
        rolling_distinct_orders,
        csv_round_trip,
        csv_text_round_trip,
        partitioned_round_trip,
        days_read_from_partitions,
        partitions_overwritten,
        published_table,
        layered_silver,
        layered_quarantines,
        layered_gold_sales,
        layered_gold_customers,
        gold_csv_copy,
        layer_counts,
        reconciled_layers,
        run_events,
        daily_increments,
        daily_gold_customers,
        daily_order_conflicts,
        customer_csv_copy,
        published_layers,
        missing_columns,
        conflicting_orders_message,
    )
} | {name: _rule(position) for position, name in enumerate(RULE_NAMES)}
