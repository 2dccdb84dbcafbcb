"""Every operator and metric as a query over the parquet test tables.

Each takes ``(spark, sf_dir)`` and returns a frame over whole tables. Queries of sinks and jobs write
into a fresh database under the shared root and return what reads back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DecimalType, TimestampNTZType, TimestampType

from lakemill.functions import times
from lakemill.functions.times import normalise_times
from lakemill.operators import dedupe, incremental, merge, sequences, shape
from lakemill.plans import behaviour, compare, consumption, jobs, model, reports, series, toplists
from lakemill.plans.feeds import Kept, RESULTS, TableSpec
from lakemill.session import fresh_database, fresh_dir
from lakemill.sinks import keyed, layers, tables
from lakemill.sources.tables import META_PREFIX, from_rows, hide_meta, read_cols, read_keyed, read_path
from lakemill.streaming import ingest, sliding, upsert

Query = Callable[[SparkSession, str], DataFrame]

RUN_DAY = "20240131"
FIRST_RUN, SECOND_RUN = "2024-01-30 02:30:00", "2024-01-31 02:30:00"
SPLIT = "2000-01-01 00:00:00"  # rows before it are stored already, later ones are new
TOP_YEAR = 1997
TARGET_USER = 1

_REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Register under the function's name; a trailing underscore keeps it apart from an import."""
    _REGISTRY[fn.__name__.rstrip("_")] = lambda spark, sf_dir: plain(fn(spark, sf_dir))
    return fn


def registry() -> dict[str, Query]:
    return dict(_REGISTRY)


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles and times as text, so that both engines deliver the same value types."""
    columns = []
    for f in df.schema.fields:
        value = F.col(f"`{f.name}`")
        if isinstance(f.dataType, DecimalType):
            value = value.cast("double")
        elif isinstance(f.dataType, (TimestampType, TimestampNTZType)):
            value = F.date_format(value, "yyyy-MM-dd HH:mm:ss")
        columns.append(value.alias(f.name))
    return df.select(*columns)


def _split(df: DataFrame, time: str) -> tuple[DataFrame, DataFrame]:
    at = F.lit(SPLIT).cast("timestamp_ntz")
    return df.filter(F.col(time) < at), df.filter(F.col(time) >= at)


def _valid(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    orders = model.orders(spark, sf_dir).withColumn("order_id", F.col("order_sn"))  # the row id of the test orders
    return consumption.valid_orders(orders, *columns, excluded=model.REFUNDED)


def _valid_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model.city_orders(spark, sf_dir, _valid(spark, sf_dir, "customer_id", "order_money", "create_time"))


def _catalog(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Name of a catalog table over one of the test files."""
    full = f"{fresh_database(spark, 'scan')}.{name}"
    spark.catalog.createTable(full, path=f"{sf_dir}/{name}.parquet", source="parquet")
    return full


# --- sources -----------------------------------------------------------------------------------


@query
def catalog_scan(spark, sf_dir):
    return spark.table(_catalog(spark, sf_dir, "orders"))


@query
def read_cols_(spark, sf_dir):
    return read_cols(spark, _catalog(spark, sf_dir, "lineitem"), ["l_orderkey", "l_partkey", "l_quantity"])


@query
def keyed_scan(spark, sf_dir):
    """Bookkeeping columns are written with the rows and hidden by name on reading."""
    marks = ("commit_time", "commit_seqno", "record_key", "partition_path", "file_name")
    rows = model.orders(spark, sf_dir).withColumns({f"{META_PREFIX}{m}": F.lit(m) for m in marks})
    table = f"{fresh_database(spark, 'keyed')}.orders"
    tables.write_partitioned(rows, table, ["order_status"])
    return read_keyed(spark, table)


@query
def empty_like(spark, sf_dir):
    """First load of a dimension: merge into an empty table of the same schema."""
    incoming = shape.audit_stamp(model.customers(spark, sf_dir), SECOND_RUN)
    return merge.dim_merge(incoming, shape.empty_like(incoming), ["customer_id"], ["customer_name"])


# --- extract -----------------------------------------------------------------------------------

_LINES = TableSpec("lines", "lines", ("order_sn", "line_no"), ("modified_time",), "", drops=("no_such",), partition="etldate")


@query
def full_extract(spark, sf_dir):
    """Snapshot of the customers without an optional column."""
    source = model.table(spark, sf_dir, "customer")
    spec = TableSpec("customer", "customer", ("c_custkey",), (), "", drops=("c_mktsegment", "absent"), partition="etldate")
    ods = fresh_database(spark, "ods")
    jobs.extract_full(source, spec, ods, RUN_DAY, SECOND_RUN)
    return spark.table(f"{ods}.customer")


@query
def full_extract_keyed(spark, sf_dir):
    ods = fresh_database(spark, "ods")
    jobs.extract_full(model.lines(spark, sf_dir), _LINES, ods, RUN_DAY, SECOND_RUN, keyed=True)
    return spark.table(f"{ods}.lines")


@query
def incr_ts(spark, sf_dir):
    orders = model.orders(spark, sf_dir)
    stored, _ = _split(orders, "create_time")
    return incremental.incremental(orders, stored, incremental.Watermark("ts", ("create_time",)))


@query
def incr_two_ts(spark, sf_dir):
    """Finished orders were operated on a month after they were created, the others never."""
    done = F.when(F.col("order_status") == "F", F.col("create_time") + F.expr("interval 30 days"))
    orders = model.orders(spark, sf_dir).withColumn("operate_time", done)
    stored, _ = _split(orders, "create_time")
    mark = incremental.Watermark("greatest", ("create_time", "operate_time"))
    return incremental.incremental(orders, stored, mark)


@query
def incr_id(spark, sf_dir):
    """Party ids held as text compare as numbers ("100" is above "99"): suppliers are stored, customers arrive."""
    customers = model.customers(spark, sf_dir)
    arriving = customers.withColumn("customer_id", F.col("customer_id").cast("string"))
    stored = model.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("customer_id"))
    return incremental.incremental(arriving, stored, incremental.Watermark("id", ("customer_id",)))


@query
def stamp_load_time(spark, sf_dir):
    loaded = shape.stamp_load_time(model.customers(spark, sf_dir), SECOND_RUN)
    return shape.stamp_partition(loaded, RUN_DAY)


@query
def fill_operate_time(spark, sf_dir):
    done = F.when(F.col("order_status") == "F", F.col("create_time") + F.expr("interval 30 days"))
    return shape.backfill(model.orders(spark, sf_dir).withColumn("operate_time", done), "operate_time", "create_time")


# --- clean -------------------------------------------------------------------------------------


@query
def audit_stamp(spark, sf_dir):
    return shape.audit_stamp(model.customers(spark, sf_dir), SECOND_RUN)


@query
def normalise_times_(spark, sf_dir):
    """Event times as text in five spellings, one per event type."""
    at, kind = F.col("ts"), F.col("event_type")
    text = (
        F.when(kind == "click", F.date_format(at, "yyyy-MM-dd HH:mm:ss"))
        .when(kind == "view", F.concat(F.date_format(at, "yyyy-MM-dd HH:mm:ss"), F.lit(".0")))
        .when(kind == "purchase", F.date_format(at, "yyyyMMddHHmmss"))
        .when(kind == "error", F.lit("NULL"))
        .otherwise(F.lit("n/a"))
    )
    events = model.table(spark, sf_dir, "events").select("event_id", "event_type", text.alias("event_time"))
    return normalise_times(events, ["event_time"])


@query
def dim_merge(spark, sf_dir):
    """Order lines as versions of a product: stored versions stamped by the first run, new ones by the second."""
    old, new = _split(model.lines(spark, sf_dir), "modified_time")
    return merge.dim_merge(
        shape.audit_stamp(new, SECOND_RUN), shape.audit_stamp(old, FIRST_RUN), ["product_id"], ["modified_time"]
    )


@query
def dedupe_latest(spark, sf_dir):
    return dedupe.dedupe_latest(model.lines(spark, sf_dir), ["order_sn", "line_no"], ["modified_time"])


@query
def dedupe_earliest(spark, sf_dir):
    return dedupe.dedupe_earliest(model.lines(spark, sf_dir), ["order_sn", "line_no"], ["modified_time"])


@query
def key_lifecycle(spark, sf_dir):
    versions = model.lines(spark, sf_dir).withColumn("insert_time", F.col("modified_time"))
    return dedupe.key_lifecycle(versions, ["product_id"], "insert_time", "modified_time")


@query
def event_partition(spark, sf_dir):
    return shape.event_partition(model.orders(spark, sf_dir), "create_time")


@query
def fact_clean(spark, sf_dir):
    """Orders with compact text times; cities with long names fail the quality rule."""
    raw = model.city_orders(spark, sf_dir).withColumn("create_time", F.date_format("create_time", "yyyyMMddHHmmss"))
    return shape.fact_clean(raw, "create_time", [], SECOND_RUN, [F.length("city") <= 8])


@query
def conform(spark, sf_dir):
    return shape.conform(model.lines(spark, sf_dir), ["product_id", "order_sn", "line_no", "product_price"])


# --- rows: filters, joins, unions --------------------------------------------------------------


@query
def filter_predicates(spark, sf_dir):
    line = model.table(spark, sf_dir, "lineitem")
    wanted = (
        ((F.col("l_returnflag") == "A") & (F.col("l_linestatus") != "F") & (F.col("l_quantity") > 10))
        | ((F.col("l_discount") >= 0.05) & (F.col("l_tax") <= 0.02) & F.col("l_shipdate").isNotNull())
    )
    return line.filter(wanted).select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


@query
def not_in(spark, sf_dir):
    return model.orders(spark, sf_dir).filter(~F.col("order_status").isin(*model.REFUNDED))


@query
def join_inner(spark, sf_dir):
    orders, customers = model.orders(spark, sf_dir), model.customers(spark, sf_dir)
    return orders.join(customers, "customer_id").select("order_sn", "customer_name", "order_money")


@query
def join_left(spark, sf_dir):
    """Customers whose nation lies in Asia find no province and keep NULLs."""
    regions = model.regions(spark, sf_dir).filter(F.col("region_name") != "ASIA")
    provinces = model.nations(spark, sf_dir).join(regions, "region_id")
    customers = model.customers(spark, sf_dir).alias("c")
    joined = customers.join(provinces.alias("p"), F.col("c.nation_id") == F.col("p.province_id"), "left")
    return joined.select("customer_id", "nation_id", "province_name", "region_name")


@query
def ref_filter(spark, sf_dir):
    """Lines of known products whose order belongs to a known customer; dimensions hold a part of the keys."""
    products = model.table(spark, sf_dir, "part").filter("p_size <= 25").select(F.col("p_partkey").alias("product_id"))
    customers = model.table(spark, sf_dir, "customer").filter("c_mktsegment = 'BUILDING'")
    customers = customers.select(F.col("c_custkey").alias("customer_id"))
    orders = behaviour.known_only(model.orders(spark, sf_dir), customers, "customer_id")
    lines = behaviour.known_only(model.lines(spark, sf_dir), products, "product_id")
    return lines.join(orders.select("order_sn", "customer_id"), "order_sn").select(
        "order_sn", "line_no", "product_id", "customer_id"
    )


@query
def union_by_name(spark, sf_dir):
    """Customers and suppliers as one list of parties, columns in different order."""
    buyers = model.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation_id"))
    sellers = model.table(spark, sf_dir, "supplier").select(
        F.col("s_nationkey").alias("nation_id"), F.col("s_name").alias("name"), F.col("s_suppkey").alias("id"))
    return shape.union_by_name(buyers, sellers)


# --- metrics -----------------------------------------------------------------------------------


@query
def valid_orders(spark, sf_dir):
    return consumption.valid_orders(model.orders(spark, sf_dir), excluded=model.REFUNDED)


@query
def user_day_consumption(spark, sf_dir):
    valid = _valid(spark, sf_dir, "customer_id", "order_money", "create_time")
    return consumption.user_day_consumption(valid, model.customers(spark, sf_dir))


@query
def user_day_consumption_all(spark, sf_dir):
    """The keyed-table variant: every order counts, refunded or not."""
    orders = model.province_orders(spark, sf_dir)
    users = model.customers(spark, sf_dir).select(
        F.col("customer_id").alias("user_id"), F.col("customer_name").alias("user_name"))
    return consumption.user_day_consumption(orders, users, "user_id", "user_name", "final_total_amount")


@query
def city_month_consumption(spark, sf_dir):
    return consumption.city_month_consumption(_valid_cities(spark, sf_dir))


@query
def region_rollup(spark, sf_dir):
    return consumption.region_rollup(
        model.province_orders(spark, sf_dir), model.nations(spark, sf_dir), model.regions(spark, sf_dir))


@query
def region_rollup_keyed(spark, sf_dir):
    """Every row with its record key, a digest."""
    return consumption.keyed_rollup(region_rollup(spark, sf_dir))


@query
def avg_vs_parent(spark, sf_dir):
    return compare.avg_vs_parent(_valid_cities(spark, sf_dir))


@query
def median_vs_parent(spark, sf_dir):
    return compare.median_vs_parent(_valid_cities(spark, sf_dir))


@query
def avg_vs_region(spark, sf_dir):
    return compare.province_avg_vs_region(model.placed_orders(spark, sf_dir))


@query
def avg_vs_all(spark, sf_dir):
    return compare.province_avg_vs_all(model.placed_orders(spark, sf_dir))


@query
def nation_median(spark, sf_dir):
    return compare.nation_median(model.placed_orders(spark, sf_dir), TOP_YEAR)


@query
def top_n_per_group(spark, sf_dir):
    return toplists.top_cities(_valid_cities(spark, sf_dir), TOP_YEAR)


@query
def region_top_three(spark, sf_dir):
    return toplists.top_provinces(model.placed_orders(spark, sf_dir), TOP_YEAR)


@query
def top_n_pair(spark, sf_dir):
    return toplists.top_products(model.lines(spark, sf_dir), products=model.products(spark, sf_dir))


@query
def repurchase_rate(spark, sf_dir):
    return behaviour.repurchase_rate(_valid(spark, sf_dir, "customer_id", "create_time"))


@query
def repurchase_ratio(spark, sf_dir):
    return behaviour.repurchase_ratio(_valid(spark, sf_dir, "customer_id", "create_time"))


@query
def pivot_counts(spark, sf_dir):
    nations = [r[0] for r in spark.read.parquet(f"{sf_dir}/nation.parquet").select("n_name").distinct().collect()]
    return series.pivot_counts(_valid_cities(spark, sf_dir), nations, "city")


@query
def running_total(spark, sf_dir):
    return series.running_total(model.event_amounts(spark, sf_dir))


@query
def running_total_range(spark, sf_dir):
    """Closed range: the metric's own parameter."""
    return series.running_total(
        model.event_amounts(spark, sf_dir), "2024-01-10 00:00:00", "2024-01-20 09:59:59")


@query
def sliding_window(spark, sf_dir):
    return series.sliding_window(model.event_amounts(spark, sf_dir))


@query
def sliding_window_range(spark, sf_dir):
    return series.sliding_window(model.event_amounts(spark, sf_dir), "2024-01-10 04", "2024-01-20 09")


@query
def prefix_sum(spark, sf_dir):
    return sequences.prefix_sum(model.orders(spark, sf_dir), "order_sn", "order_money")


@query
def range_self_join(spark, sf_dir):
    """Pairs of orders 20 to 40 ids apart with their running totals."""
    sums = sequences.prefix_sum(model.orders(spark, sf_dir), "order_sn", "order_money", out="total")
    return sequences.banded_pairs(sums, "order_sn", ["order_money", "total"], 20, 40)


@query
def max_avg_run(spark, sf_dir):
    """Valid orders only, so that ids are missing."""
    ids = model.orders(spark, sf_dir).filter(~F.col("order_status").isin(*model.REFUNDED))
    return sequences.best_average_run(
        _valid(spark, sf_dir, "order_sn", "order_money"), "order_sn", "order_money",
        bounds=sequences.id_bounds(ids, "order_sn"), every_length=True)


@query
def item_overlap(spark, sf_dir):
    return behaviour.item_overlap(
        model.orders(spark, sf_dir), model.lines(spark, sf_dir), model.customers(spark, sf_dir),
        model.products(spark, sf_dir), TARGET_USER)


@query
def item_overlap_with_self(spark, sf_dir):
    return behaviour.item_overlap(
        model.orders(spark, sf_dir), model.lines(spark, sf_dir), model.customers(spark, sf_dir),
        model.products(spark, sf_dir), TARGET_USER, exclude_self=False)


@query
def consecutive_day_users(spark, sf_dir):
    users = model.customers(spark, sf_dir).select(
        F.col("customer_id").alias("user_id"), F.col("customer_name").alias("user_name"))
    return behaviour.consecutive_day_users(model.province_orders(spark, sf_dir), users)


@query
def order_amount_diff(spark, sf_dir):
    orders = model.orders(spark, sf_dir).select(
        F.col("order_sn").alias("order_id"), F.col("order_money").alias("final_total_amount"))
    lines = model.lines(spark, sf_dir).select(
        F.col("order_sn").alias("order_id"), F.col("product_price").alias("line_amount"))
    return behaviour.order_amount_diff(orders, lines)


# --- read-backs (top-k reports) ----------------------------------------------------------------


@query
def top_k(spark, sf_dir):
    return reports.read_back(user_day_consumption(spark, sf_dir), "user_consumption_day_aggr")


@query
def city_month_top(spark, sf_dir):
    return reports.read_back(city_month_consumption(spark, sf_dir), "city_consumption_day_aggr")


@query
def region_rollup_top(spark, sf_dir):
    return reports.read_back(region_rollup(spark, sf_dir), "province_consumption_day_aggr")


@query
def avg_vs_parent_top(spark, sf_dir):
    return reports.read_back(avg_vs_parent(spark, sf_dir), "cityavgcmpprovince")


@query
def median_vs_parent_top(spark, sf_dir):
    return reports.read_back(median_vs_parent(spark, sf_dir), "citymidcmpprovince")


@query
def running_total_top(spark, sf_dir):
    return reports.read_back(running_total(spark, sf_dir), "accumulateconsumption")


# --- sinks and maintenance ---------------------------------------------------------------------


@query
def write_partitioned(spark, sf_dir):
    table = f"{fresh_database(spark, 'sink')}.orders"
    rows = model.orders(spark, sf_dir).withColumn("year", F.year("create_time"))
    tables.write_partitioned(rows, table, ["year", "order_status"])
    return spark.table(table)


@query
def append_partition(spark, sf_dir):
    """Two loads into one table, each under its own day."""
    table = f"{fresh_database(spark, 'sink')}.orders"
    first, second = _split(model.orders(spark, sf_dir), "create_time")
    tables.write_partitioned(shape.stamp_partition(first, "20240130"), table, ["etl_date"])
    tables.append_rows(shape.stamp_partition(second, RUN_DAY), table)
    return spark.table(table)


@query
def precombine_write(spark, sf_dir):
    table = f"{fresh_database(spark, 'sink')}.lines"
    rows = model.lines(spark, sf_dir).withColumn("ship_year", F.year("modified_time"))
    keyed.precombine_write(rows, table, ["order_sn", "line_no"], ["modified_time"], ["ship_year"])
    return spark.table(table)


@query
def keyed_upsert(spark, sf_dir):
    """Lines shipped before the split are stored by ship year; later ones move their key to a later year."""
    table = f"{fresh_database(spark, 'sink')}.lines"
    rows = model.lines(spark, sf_dir).withColumn("ship_year", F.year("modified_time"))
    old, new = _split(rows, "modified_time")
    keyed.precombine_write(old, table, ["order_sn", "line_no"], ["modified_time"], ["ship_year"])
    keyed.keyed_upsert(new, table, ["order_sn", "line_no"], ["modified_time"])
    return spark.table(table)


@query
def dynamic_overwrite(spark, sf_dir):
    """Months since the split are replaced by valid orders only, earlier months stay on all orders."""
    database = fresh_database(spark, "dws")
    table = f"{database}.city_consumption_day_aggr"
    columns, parts = RESULTS["city_consumption_day_aggr"]
    layers.create_table(spark, table, columns, parts)
    tables.overwrite_partitions(consumption.city_month_consumption(model.city_orders(spark, sf_dir)), table)
    _, recent = _split(_valid_cities(spark, sf_dir), "create_time")
    consumption.city_month_consumption(recent).createOrReplaceTempView("recent_city_months")
    tables.overwrite_partitions_sql("recent_city_months", table, spark)
    return spark.table(table)


@query
def layer_bootstrap(spark, sf_dir):
    """Declared raw table, cleaned table copied from it with stamp columns, filled from one into the other."""
    database = fresh_database(spark, "boot")
    raw, cleaned = f"{database}.customer", f"{database}.dim_customer"
    layers.create_table(
        spark, raw, "customer_id bigint, customer_name string, nation_id int, etl_date string", ["etl_date"])
    layers.create_like(
        spark, cleaned, raw,
        "dwd_insert_user string, dwd_insert_time timestamp_ntz, dwd_modify_user string, dwd_modify_time timestamp_ntz")
    tables.append_rows(shape.stamp_partition(model.customers(spark, sf_dir), RUN_DAY), raw)
    tables.append_rows(shape.audit_stamp(spark.table(raw), SECOND_RUN), cleaned)
    return spark.table(cleaned)


@query
def repair_partitions(spark, sf_dir):
    """Files written beside the catalog become visible after the repair."""
    database, folder = fresh_database(spark, "repair"), fresh_dir(spark, "orders")
    rows = model.orders(spark, sf_dir)
    tables.write_folder(rows, folder, ["order_status"])
    layers.create_table(spark, f"{database}.orders", rows.schema, ["order_status"], location=folder)
    layers.repair_partitions(spark, f"{database}.orders")
    return spark.table(f"{database}.orders")


@query
def layer_counts(spark, sf_dir):
    """Rows per table of a layer."""
    names = ["orders", "lineitem", "customer", "part", "nation", "region"]
    database = fresh_database(spark, "scan")
    for name in names:
        spark.catalog.createTable(f"{database}.{name}", path=f"{sf_dir}/{name}.parquet", source="parquet")
    counts = layers.row_counts(spark, [f"{database}.{n}" for n in names])
    return counts.withColumn("table_name", F.substring_index("table_name", ".", -1))


# --- whole warehouse ---------------------------------------------------------------------------

_E2E_SPECS = (
    TableSpec(
        "customer", "dim_customer", ("customer_id",), ("customer_name",),
        "customer_id bigint, customer_name string, nation_id int, create_time timestamp_ntz",
        incremental.Watermark("id", ("customer_id",)), dimension=True, load_time="create_time",
    ),
    TableSpec(
        "orders", "fact_orders", ("order_sn",), ("create_time",),
        "order_sn bigint, customer_id bigint, order_money decimal(18,2), create_time timestamp_ntz, "
        "order_status string, month_start string",
        incremental.Watermark("ts", ("create_time",)), event_time="month_start",
        kept=(Kept("valid", ("order_sn",), ("create_time",), "order_status not in ('P')"),),
        keys_move=False,  # an order stays in the month it was created in
    ),
)


@query
def warehouse_e2e(spark, sf_dir):
    """Two nightly runs from source to metric: extract, clean, merge, then consumption by user and day.

    The first night sees the orders before the split, the second the whole source. Facts are
    partitioned by the first day of their month.
    """
    month = F.date_format(F.date_trunc("month", F.col("create_time")), "yyyy-MM-dd HH:mm:ss")
    orders = model.orders(spark, sf_dir).withColumn("month_start", month)
    first, _ = _split(orders, "create_time")
    ods, dwd = fresh_database(spark, "ods"), fresh_database(spark, "dwd")
    jobs.set_up(spark, _E2E_SPECS, ods, dwd)
    for day, run_ts, seen in (("20240130", FIRST_RUN, first), (RUN_DAY, SECOND_RUN, orders)):
        sources = {"customer": model.customers(spark, sf_dir), "orders": seen}
        jobs.extract_feed(spark, _E2E_SPECS, sources.__getitem__, ods, day, run_ts)
        jobs.clean_feed(spark, _E2E_SPECS, ods, dwd, day, run_ts)
    valid = spark.table(f"{dwd}.fact_orders_valid").select("customer_id", "order_money", "create_time")
    return consumption.user_day_consumption(valid, spark.table(f"{dwd}.dim_customer"))


_NIGHTS = (
    TableSpec(
        "orders", "fact_orders", ("order_sn",), ("modified_time",),
        "order_sn bigint, customer_id bigint, order_money decimal(18,2), create_time timestamp_ntz, "
        "order_status string, modified_time timestamp_ntz, month_start string",
        incremental.Watermark("ts", ("modified_time",)), event_time="month_start", inclusive=True,
        kept=(Kept("valid", ("order_sn",), ("create_time", "modified_time"), "order_status not in ('P')"),),
    ),
)


def _two_nights(spark: SparkSession, sf_dir: str) -> str:
    """A fact layer after two nights; orders whose number divides by three are refunded in the second.

    A refund is stamped with the second night. Of the orders up to the split only those with an even number are
    seen in the first night; the odd ones of the last moment seen arrive late, with the very time the high-water has.
    """
    month = F.date_format(F.date_trunc("month", F.col("create_time")), "yyyy-MM-dd HH:mm:ss")
    orders = model.orders(spark, sf_dir).withColumns({"modified_time": F.col("create_time"), "month_start": month})
    names = [f.split()[0] for f in _NIGHTS[0].columns.split(", ")]
    early = orders.filter((F.col("create_time") < F.lit(SPLIT).cast("timestamp_ntz")) & (F.col("order_sn") % 2 == 0))
    refunded = orders.filter(F.col("order_sn") % 3 == 0).withColumns({
        "order_status": F.lit("P"), "modified_time": F.lit(SECOND_RUN).cast("timestamp_ntz")})
    ods, dwd = fresh_database(spark, "ods"), fresh_database(spark, "dwd")
    jobs.set_up(spark, _NIGHTS, ods, dwd)
    for day, run_ts, seen in (("20240130", FIRST_RUN, early), (RUN_DAY, SECOND_RUN, orders.unionByName(refunded))):
        jobs.extract_feed(spark, _NIGHTS, lambda _: seen.select(*names), ods, day, run_ts)
        jobs.clean_feed(spark, _NIGHTS, ods, dwd, day, run_ts)
    jobs.clean_feed(spark, _NIGHTS, ods, dwd, RUN_DAY, SECOND_RUN)  # a rerun changes nothing
    return dwd


_NIGHT_COLUMNS = ("order_sn", "customer_id", "order_money", "create_time", "order_status", "modified_time", "etl_date")


@query
def current_facts(spark, sf_dir):
    """The last version of each order, refunds included."""
    return spark.table(f"{_two_nights(spark, sf_dir)}.fact_orders_last").select(*_NIGHT_COLUMNS)


@query
def valid_facts(spark, sf_dir):
    """The last valid version of each order: a refund hides no earlier version that was valid."""
    return spark.table(f"{_two_nights(spark, sf_dir)}.fact_orders_valid").select(*_NIGHT_COLUMNS)


@query
def fact_history(spark, sf_dir):
    """Every version received, by load and event day; the one at the high-water neither lost nor doubled."""
    return spark.table(f"{_two_nights(spark, sf_dir)}.fact_orders").select(*_NIGHT_COLUMNS, "load_day")


# --- streams -----------------------------------------------------------------------------------


def _stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    schema = model.table(spark, sf_dir, name).schema
    return ingest.file_stream(spark, sf_dir, schema, f"{name}.parquet")


@query
def stream_sliding(spark, sf_dir):
    """Windows that closed before the end of the input, with one hour allowed for late events."""
    events = _stream(spark, sf_dir, "events").select(
        F.col("ts").alias("create_time"), F.col("value").cast("decimal(18,2)").alias("order_money"))
    out = fresh_dir(spark, "sliding")
    ingest.drain_to_path(sliding.sliding_stream(events), f"{out}/rows", f"{out}/checkpoint")
    return spark.read.parquet(f"{out}/rows")


@query
def stream_extract(spark, sf_dir):
    out = fresh_dir(spark, "extract")
    ingest.extract_stream(_stream(spark, sf_dir, "orders"), f"{out}/rows", f"{out}/checkpoint", RUN_DAY)
    # A second run finds no new file and adds nothing.
    ingest.extract_stream(_stream(spark, sf_dir, "orders"), f"{out}/rows", f"{out}/checkpoint", RUN_DAY)
    return spark.read.option("basePath", f"{out}/rows").parquet(f"{out}/rows/etl_date={RUN_DAY}").withColumn(
        "etl_date", F.col("etl_date").cast("string"))


@query
def stream_upsert(spark, sf_dir):
    """Lines stored before the split, then the whole table streamed into the same keyed table."""
    table = f"{fresh_database(spark, 'stream')}.lines"
    stored, _ = _split(model.lines(spark, sf_dir).withColumn("ship_year", F.year("modified_time")), "modified_time")
    keyed.precombine_write(stored, table, ["order_sn", "line_no"], ["modified_time"], ["ship_year"])
    arriving = _stream(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_sn"), F.col("l_partkey").alias("product_id"),
        F.col("l_linenumber").alias("line_no"), F.col("l_quantity").cast("bigint").alias("product_cnt"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("product_price"),
        F.col("l_shipdate").alias("modified_time"), F.year("l_shipdate").alias("ship_year"))
    upsert.upsert_stream(
        arriving, table, ["order_sn", "line_no"], ["modified_time"], f"{fresh_dir(spark, 'upsert')}/checkpoint")
    return hide_meta(spark.table(table))


@query
def stream_dim_merge(spark, sf_dir):
    """Order lines as versions of a product, two deliveries, a micro-batch each: the streamed form of ``dim_merge``."""
    lines = model.lines(spark, sf_dir).withColumn("line_group", (F.col("product_id") % 4).cast("int"))
    old, new = _split(lines, "modified_time")
    folder, table = fresh_dir(spark, "versions"), f"{fresh_database(spark, 'stream')}.products"
    tables.write_partitioned(shape.audit_stamp(shape.empty_like(lines), FIRST_RUN), table, ["line_group"])
    # The first run takes up what lies there, the next one what came since.
    for rows, run_ts in ((old, FIRST_RUN), (new, SECOND_RUN)):
        rows.write.mode("append").parquet(folder)
        stream = ingest.file_stream(spark, folder, lines.schema)
        upsert.dim_merge_stream(stream, table, ["product_id"], ["modified_time"], f"{folder}-checkpoint", lambda: run_ts)
    return spark.table(table)


# --- reading and looking -----------------------------------------------------------------------


@query
def raw_scan(spark, sf_dir):
    """A keyed table by its location, bookkeeping columns and partition included."""
    rows = model.orders(spark, sf_dir).withColumn(f"{META_PREFIX}record_key", F.col("order_sn").cast("string"))
    folder = fresh_dir(spark, "orders")
    tables.write_folder(rows, folder, ["order_status"])
    return read_path(spark, folder)


@query
def rows_to_frame(spark, sf_dir):
    """Orders per status, looked at on the driver (a row per status) and turned into a frame again."""
    counts = model.orders(spark, sf_dir).groupBy("order_status").agg(F.count("*").alias("n"))
    return from_rows(spark, [tuple(r) for r in counts.collect()], counts.schema)


@query
def layer_preview(spark, sf_dir):
    """The first rows of each table of a layer, as many as the preview shows, told by their number."""
    database = fresh_database(spark, "scan")
    for name in ("orders", "customer", "region"):
        spark.catalog.createTable(f"{database}.{name}", path=f"{sf_dir}/{name}.parquet", source="parquet")
    shown = layers.preview(spark, [f"{database}.{n}" for n in ("orders", "customer", "region")], 20)
    counts = [df.agg(F.lit(t.split(".")[-1]).alias("table_name"), F.count("*").alias("n")) for t, df in shown.items()]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query
def default_run_day(spark, sf_dir):
    """Customers stamped with yesterday, the day a job takes when none is given."""
    return model.customers(spark, sf_dir).withColumn("etl_date", times.default_run_day())
