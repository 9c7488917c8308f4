"""Registered queries: each takes a session and a data folder and returns a DataFrame.

Operators run straight on the feed derived from ``events`` (or on ``lineitem``); sources,
sinks and streams write to a new folder under the shared scratch folder first.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import normalize_op, parse_amount, parse_event_ts
from tidemark.operators import (
    change_counts,
    latest_per_key,
    matched_updates,
    normalize_orders,
    observed_counts,
    row_count,
    unmatched_updates,
    upsert,
)
from tidemark.plans.feed import feed_from_events, lines_with_malformed, read_events
from tidemark.plans.workspace import AVAILABLE_NOW, PARTS, Workspace
from tidemark.schema import BATCH, KEY, ORDERS, TIEBREAK, TS
from tidemark.session import scratch_dir
from tidemark.sources import (
    append_table,
    drop_table,
    ensure_table,
    infer_landing,
    overwrite_table,
    read_landing,
    read_landing_with_corrupt,
    read_quarantine,
    read_table,
    split_malformed,
    stream_table,
    write_landing,
    write_quarantine,
)
from tidemark.streaming import append_stream, ensure_raw

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

KEYS = [KEY]
LINEITEM_ORDER = (
    "l_linenumber",
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
)


def query(function: Query) -> Query:
    @wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        # Feed timestamps mean UTC, whatever zone the session came with.
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return function(spark, sf_dir)

    QUERIES[function.__name__] = run
    return run


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed_from_events(read_events(spark, sf_dir))


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize_orders(feed(spark, sf_dir), source_file=F.lit("events"))


def newest(df: DataFrame) -> DataFrame:
    return latest_per_key(df, KEYS, TS, TIEBREAK)


def business(df: DataFrame) -> DataFrame:
    """The columns that do not vary from run to run; event time as it is stored in ``events``."""
    names = [name for name in ORDERS.fieldNames() if name not in ("etl_timestamp", "source_filename")]
    return df.select(*names).withColumn(TS, F.col(TS).cast("timestamp_ntz"))


# -- landing zone ------------------------------------------------------------------------------


def landed(spark: SparkSession, sf_dir: str, label: str) -> str:
    path = f"{scratch_dir(spark, label)}/orders"
    write_landing(feed(spark, sf_dir), path)
    return path


@query
def landing_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = landed(spark, sf_dir, "landing-write")
    return (
        read_landing(spark, path)
        .groupBy("event_date")
        .agg(F.count("*").alias("n_rows"), F.count("amount").alias("n_amounts"))
    )


@query
def landing_scan_declared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_landing(spark, landed(spark, sf_dir, "scan-declared"))


@query
def landing_scan_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = landed(spark, sf_dir, "scan-inferred")
    return read_landing(spark, path, infer_landing(spark, path))


@query
def landing_partition_prune(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The date filter is the feature: only the folders of these dates are read.
    path = landed(spark, sf_dir, "prune")
    return read_landing(spark, path).where(F.col("event_date") >= F.lit("2024-01-16").cast("date"))


def landed_with_malformed(spark: SparkSession, sf_dir: str, label: str) -> tuple[str, str]:
    root = scratch_dir(spark, label)
    lines = lines_with_malformed(read_events(spark, sf_dir)).hint("rebalance", "event_date")
    path = f"{root}/landing/orders"
    lines.write.partitionBy("event_date").option("compression", "gzip").text(path)
    return path, f"{root}/landing/errors/orders"


@query
def quarantine_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, errors = landed_with_malformed(spark, sf_dir, "quarantine")
    good, bad = split_malformed(read_landing_with_corrupt(spark, path))
    write_quarantine(bad, errors)
    amounts = normalize_orders(good).groupBy("event_date").agg(
        F.count("*").alias("n_good"), F.sum("amount").alias("good_amount")
    )
    lines = read_quarantine(spark, errors).groupBy("event_date").agg(
        F.count("*").alias("n_bad"), F.sum(F.length("line")).alias("bad_chars")
    )
    return amounts.join(lines, "event_date", "full").fillna(0, ["n_good", "n_bad", "bad_chars"])


@query
def quarantine_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, errors = landed_with_malformed(spark, sf_dir, "quarantine-stream")
    space = Workspace(spark, sf_dir, "quarantine-raw")
    space.ingest(errors, landing=path)
    return read_quarantine(spark, errors).select("event_date", "line")


# -- normalise ---------------------------------------------------------------------------------


@query
def normalize_orders_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return business(orders(spark, sf_dir))


@query
def parse_amount_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    cents = F.col("value").cast("decimal(12,2)").cast("string")
    with_comma = F.replace(cents, F.lit("."), F.lit(","))
    kind = F.col("event_type")
    text = (
        F.when(kind == "signup", cents)
        .when(kind == "purchase", F.concat(F.lit(" -"), with_comma, F.lit(" ")))
        .when(kind == "click", F.concat(F.lit("1,"), cents))
        .when(kind == "view", F.concat(cents, F.lit("5E3")))
        .otherwise(F.concat(F.lit("99999999999"), cents))
    )
    return read_events(spark, sf_dir).select(
        "event_id", "event_type", text.alias("amount_text"), parse_amount(text).alias("amount")
    )


@query
def normalize_op_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    text = (
        F.when(kind == "signup", "INSERT")
        .when(kind == "purchase", "Upsert")
        .when(kind == "click", F.concat(F.lit("U"), F.col("event_id").cast("string")))
        .when(kind == "view", F.concat(F.lit(" u"), F.col("event_id").cast("string")))
    )
    return read_events(spark, sf_dir).select(
        "event_id", text.alias("operation_text"), normalize_op(text).alias("database_operation")
    )


@query
def parse_event_ts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    text = (
        F.when(kind == "signup", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
        .when(kind == "purchase", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
        .when(kind == "click", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
        .when(kind == "view", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'-03:00'"))
        .otherwise(F.date_format("ts", "yyyy-'13'-dd'T'HH:mm:ss"))
    )
    return read_events(spark, sf_dir).select(
        "event_id",
        text.alias("timestamp_text"),
        parse_event_ts(text).cast("timestamp_ntz").alias("event_timestamp"),
    )


@query
def lineage_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = normalize_orders(read_landing(spark, landed(spark, sf_dir, "lineage")))
    folder = F.regexp_extract("source_filename", r"/orders/event_date=(\d{4}-\d{2}-\d{2})/[^/]+\.json\.gz$", 1)
    return rows.groupBy("event_date").agg(
        F.count("*").alias("n_rows"),
        F.count("etl_timestamp").alias("n_stamped"),
        F.count_if(folder == F.col("event_date").cast("string")).alias("n_from_folder"),
        F.count_distinct("etl_timestamp").alias("n_load_times"),
    )


# -- newest row per key ------------------------------------------------------------------------


@query
def latest_per_key_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return business(newest(orders(spark, sf_dir)))


@query
def latest_per_key_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return latest_per_key(lineitem, ["l_orderkey"], "l_shipdate", LINEITEM_ORDER)


@query
def latest_per_two_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return latest_per_key(lineitem, ["l_orderkey", "l_linenumber"], "l_shipdate", LINEITEM_ORDER[1:])


@query
def latest_per_key_missing_col(spark: SparkSession, sf_dir: str) -> DataFrame:
    return newest(business(orders(spark, sf_dir)).drop(TS))


@query
def load_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return change_counts(orders(spark, sf_dir), KEYS)


@query
def target_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_count(newest(orders(spark, sf_dir)))


@query
def observed_counts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch_dir(spark, 'observed')}/newest"
    return observed_counts(orders(spark, sf_dir), newest, lambda rows: rows.write.parquet(path))


# -- upsert ------------------------------------------------------------------------------------


# A user's change to a product: keys that occur on one side only, and keys on both.
PAIR = ["order_id", "product_id"]


def is_old() -> Column:
    """Rows of the target; those without a date are updates."""
    return F.coalesce(F.col("event_date") < F.lit("2024-01-15").cast("date"), F.lit(False))


def is_returned() -> Column:
    return F.col("l_returnflag").eqNullSafe("R")


def target_and_updates(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = orders(spark, sf_dir)
    target, updates = (latest_per_key(rows.where(side), PAIR, TS, TIEBREAK) for side in (is_old(), ~is_old()))
    return target, updates


@query
def upsert_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, updates = target_and_updates(spark, sf_dir)
    return business(upsert(target, updates, PAIR))


@query
def upsert_matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, updates = target_and_updates(spark, sf_dir)
    return business(matched_updates(target, updates, PAIR))


@query
def upsert_not_matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, updates = target_and_updates(spark, sf_dir)
    return business(unmatched_updates(target, updates, PAIR))


@query
def upsert_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    keys = ["l_orderkey", "l_linenumber"]
    target, updates = (
        latest_per_key(rows, keys, "l_shipdate", LINEITEM_ORDER[1:])
        for rows in (lineitem.where(~is_returned()), lineitem.where(is_returned()))
    )
    return upsert(target, updates, keys)


@query
def upsert_out_of_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = orders(spark, sf_dir)
    batches = [newest(rows.where(part)) for part in reversed(PARTS)]
    current = batches[0]
    for batch in batches[1:]:
        current = upsert(current, batch, KEYS)
    return business(current)


@query
def upsert_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = orders(spark, sf_dir)
    # Changes paid by pix lose their key.
    keyless = rows.withColumn(KEY, F.when(F.col("payment_method") != "pix", F.col(KEY)))
    first, second = (newest(keyless.where(part)) for part in (PARTS[0], f"NOT coalesce({PARTS[0]}, false)"))
    return business(upsert(first, second, KEYS))


# -- tables ------------------------------------------------------------------------------------


def new_table(space: Workspace, name: str) -> str:
    table = f"{space.database}.{name}"
    ensure_table(space.spark, table, f"{space.root}/{name}")
    return table


@query
def table_ddl(spark: SparkSession, sf_dir: str) -> DataFrame:
    space = Workspace(spark, sf_dir, "ddl")
    staging, table = new_table(space, "staging"), new_table(space, "orders_copy")
    append_table(orders(spark, sf_dir), staging)
    append_table(read_table(spark, staging), table)
    ensure_table(spark, table, f"{space.root}/orders_copy")
    drop_table(spark, staging)
    types = F.map_from_arrays(
        F.array(*(F.lit(f.name) for f in read_table(spark, table).schema)),
        F.array(*(F.lit(f.dataType.simpleString()) for f in read_table(spark, table).schema)),
    )
    counts = read_table(spark, table).agg(*(F.count(name).alias(name) for name in ORDERS.fieldNames()))
    listing = counts.unpivot([], ORDERS.fieldNames(), "col_name", "n_values")
    return listing.select(
        "col_name",
        types[F.col("col_name")].alias("data_type"),
        "n_values",
        F.lit(spark.catalog.tableExists(staging)).alias("staging_exists"),
    )


@query
def table_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    space = Workspace(spark, sf_dir, "append")
    table = new_table(space, "orders_copy")
    for part in PARTS:
        append_table(orders(spark, sf_dir).where(part), table)
    return business(read_table(spark, table))


@query
def table_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    space = Workspace(spark, sf_dir, "overwrite")
    table = new_table(space, "orders_copy")
    overwrite_table(orders(spark, sf_dir), table)
    overwrite_table(newest(orders(spark, sf_dir)), table)
    return business(read_table(spark, table))


# -- jobs --------------------------------------------------------------------------------------


@query
def raw_stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    space = Workspace(spark, sf_dir, "ingest")
    space.land()
    space.ingest()
    return business(space.raw())


@query
def restart_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    space = Workspace(spark, sf_dir, "restart")
    for part in range(len(PARTS)):
        space.land(part)
        space.ingest()
    return business(space.raw())


@query
def raw_table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    space = Workspace(spark, sf_dir, "raw-scan")
    space.land()
    space.ingest()
    return space.raw().groupBy("event_date", "database_operation").agg(
        F.count("*").alias("n_rows"), F.sum("amount").alias("sum_amount")
    )


@query
def raw_table_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    space = Workspace(spark, sf_dir, "raw-stream")
    space.land()
    space.ingest()
    copy = f"{space.database}.orders_copy"
    ensure_raw(spark, copy, f"{space.root}/orders_copy")
    rows = stream_table(spark, space.raw_table).drop(BATCH)
    append_stream(rows, copy, f"{space.root}/checkpoints/copy", trigger=AVAILABLE_NOW).awaitTermination()
    return business(read_table(spark, copy))


@query
def initial_load_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    space = Workspace(spark, sf_dir, "initial")
    space.land()
    space.ingest()
    space.initial_load()
    return business(space.current.read())


@query
def initial_load_of_nothing(spark: SparkSession, sf_dir: str) -> DataFrame:
    space = Workspace(spark, sf_dir, "load-nothing")
    first = space.initial_load()
    space.land()
    space.ingest()
    space.initial_load()
    return business(space.current.read()).withColumn("first_run", F.lit(first.status))


@query
def processed_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    space = Workspace(spark, sf_dir, "by-name")
    space.land(0)
    space.ingest()
    space.initial_load()
    for part in (1, 2):
        space.land(part)
        space.ingest()
        space.upsert()
    return spark.sql(
        f"SELECT payment_method, event_date, count(*) AS n_orders, sum(amount) AS total "
        f"FROM {space.processed} GROUP BY payment_method, event_date"
    )


@query
def initial_load_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    space = Workspace(spark, sf_dir, "guard")
    space.land(0)
    space.ingest()
    space.initial_load()
    space.land(1)
    space.land(2)
    space.ingest()
    second = space.initial_load()
    return business(space.current.read()).withColumn("second_run", F.lit(second.status))


@query
def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    space = Workspace(spark, sf_dir, "upsert")
    for part in range(len(PARTS)):
        space.land(part)
        space.ingest()
        space.upsert()
    return business(space.current.read())


@query
def stream_upsert_out_of_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    space = Workspace(spark, sf_dir, "upsert-late")
    for part in reversed(range(len(PARTS))):
        space.land(part)
        space.ingest()
        space.upsert()
    return business(space.current.read())


@query
def batch_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    space = Workspace(spark, sf_dir, "replay")
    for part in range(2):
        space.land(part)
        space.ingest()
        space.upsert()
    # The last batch again, as after a crash between its write and the checkpoint's; then
    # the whole table again from a new checkpoint.
    space.current.apply(space.raw().where(PARTS[1]), space.current.commits()[-1])
    space.land(2)
    space.ingest()
    space.upsert(checkpoint="processed-again")
    return business(space.current.read())


@query
def failed_batch_retried(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch that fails once its rows are written fails its stream; the restart repeats it."""
    space = Workspace(spark, sf_dir, "failed-batch")
    commits = []

    def fail_once(commit: int, records: int) -> None:
        commits.append(commit)
        if len(commits) == 1:
            raise RuntimeError("failed once")

    space.land()
    space.ingest()
    status = "finished"
    try:
        space.upsert(after_batch=fail_once)
    except StreamingQueryException:
        status = "failed"
    space.upsert(after_batch=fail_once)
    counts = {"first_run": F.lit(status), "n_tries": F.lit(commits.count(commits[0]))}
    return business(space.current.read()).withColumns(counts)


@query
def bootstrap_then_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    space = Workspace(spark, sf_dir, "bootstrap")
    space.land(0)
    space.ingest()
    space.initial_load()
    for part in (1, 2):
        space.land(part)
        space.ingest()
        space.upsert()
    return business(space.current.read())


def registered() -> dict[str, Query]:
    """Query key to callable; a ``_query`` ending only avoids clashing with an operator."""
    return {name.removesuffix("_query"): function for name, function in QUERIES.items()}
