"""The registered queries: each operator on the star-schema tables.

Each callable takes ``(spark, sf_dir)``. Results hold plain types only (long, double,
string, boolean, timestamp without zone), so they compare across engines.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.functions.casts import double_to_int, to_bool, to_day, to_decimal, to_int, to_ntz, to_text
from siltstone.functions.exprs import (
    hours_between,
    lookback_window,
    ntz_literal,
    ratio_else_null,
    ratio_else_zero,
    risk_band,
    surrogate_key,
    within_days,
    zero_if_null,
)
from siltstone.functions.jsonx import (
    encode_complex_columns,
    explode_text,
    first_element,
    first_element_key,
    is_valid_json,
)
from siltstone.operators import quality
from siltstone.operators.incremental import add_columns, delete_insert, high_water_mark, newer_than
from siltstone.operators.interval import interval_aggregate, interval_join
from siltstone.operators.tables import Layers, Table
from siltstone.operators.unnest import element_sums
from siltstone.plans import daily, gold, kpi, reports, roles, silver
from siltstone.plans.models import Fact, Model, default_project
from siltstone.plans.roles import AS_OF, table
from siltstone.session import configure, fresh_path
from siltstone.sources.catalog import CONTRACTS, DatasetSpec, contract, datasets
from siltstone.sources.flatten import flatten_struct
from siltstone.sources.landed import read_responses, records_at

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

CUTOFF = dt.datetime(1998, 1, 1)
ALL_DAYS = ("1900-01-01", "2100-01-01")


def plain(df: DataFrame) -> DataFrame:
    def one(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            return c.cast("double").alias(f.name)
        if isinstance(f.dataType, T.TimestampType):  # the session is in UTC
            return c.cast("timestamp_ntz").alias(f.name)
        if isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            return c.cast("long").alias(f.name)
        return c

    return df.select(*(one(f) for f in df.schema.fields))


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(fn(configure(spark, sf_dir), sf_dir))

    run.__name__ = fn.__name__
    _QUERIES[fn.__name__] = run
    return run


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


# -- silver -----------------------------------------------------------------------------


@query
def silver_launches(spark, sf):
    return silver.launches(roles.shipment_launches(spark, sf))


@query
def silver_rockets(spark, sf):
    return silver.rockets(roles.supplier_rockets(spark, sf))


@query
def silver_payloads(spark, sf):
    return silver.payloads(roles.part_payloads(spark, sf))


@query
def silver_cores(spark, sf):
    return silver.cores(roles.customer_cores(spark, sf))


@query
def silver_solar_events(spark, sf):
    return silver.solar_events(roles.order_solar_events(spark, sf))


@query
def silver_rename_cast(spark, sf):
    price, status = F.col("o_totalprice"), F.col("o_orderstatus")
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        to_ntz(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm'+05:30'")).alias("ordered_at"),
        to_bool(F.when(status == "F", "yes").when(status == "O", "off")).alias("is_final"),
        to_decimal("o_totalprice").alias("price"),
        to_int(F.col("o_orderkey") / 2).alias("half_away"),
        double_to_int(F.col("o_orderkey") / 2).alias("half_even"),
        to_text("o_custkey").alias("customer"),
        to_day("o_orderdate").cast("string").alias("day"),
        F.lit("orders").alias("origin"),
        F.when(price > 0, price).alias("positive_price"),
    )


@query
def window_filter(spark, sf):
    start, end = lookback_window(dt.date(1998, 12, 31))
    return table(spark, sf, "orders").where(within_days("o_orderdate", start, end)).select(
        "o_orderkey", "o_orderdate"
    )


# -- JSON and nested data ---------------------------------------------------------------


@query
def json_key_text(spark, sf):
    listed = F.concat(F.lit("["), F.col("props"), F.lit("]"))
    return table(spark, sf, "events").select(
        "event_id",
        first_element_key(listed, "k").alias("k"),
        first_element_key(listed, "absent").alias("absent"),
        first_element(F.to_json(F.array("event_type", "props"))).alias("first"),
        first_element(F.col("props")).alias("not_a_list"),
        is_valid_json("props").alias("valid"),
        is_valid_json("event_type").alias("bare_word_valid"),
    )


@query
def json_array_unnest(spark, sf):
    launches = silver.launches(roles.shipment_launches(spark, sf))
    return explode_text(launches, "payload_ids", "payload_id", "launch_id")


@query
def to_json_roundtrip(spark, sf):
    nested = table(spark, sf, "customer").select(
        "c_custkey",
        F.array("c_mktsegment", "c_name").alias("tags"),
        F.struct("c_nationkey", F.nullif("c_mktsegment", F.lit("FURNITURE")).alias("segment")).alias("info"),
        F.when(F.col("c_nationkey") > 10, F.array("c_nationkey")).alias("maybe"),
    )
    return encode_complex_columns(nested)


@query
def flatten_nested_columns(spark, sf):
    customer, nation = table(spark, sf, "customer"), table(spark, sf, "nation")
    nested = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey",
        F.struct(
            F.col("c_name").alias("name"),
            F.struct(F.col("n_name").alias("nation"), F.col("n_regionkey").alias("region")).alias("place"),
        ).alias("who"),
    )
    return flatten_struct(nested)


@query
def response_records(spark, sf):
    """Response bodies, one per event, descended to the record list.

    Errors arrive as one object instead of a list, clicks below a path that does not
    exist, purchases as text where an object should be.
    """
    record = F.struct(
        F.col("event_id").alias("id"),
        F.col("value"),
        F.struct("user_id").alias("who"),
        F.array("event_type", "props").alias("tags"),
    )
    kind = F.col("event_type")
    body = (
        F.when(kind == "error", F.to_json(F.struct(F.struct(record.alias("events")).alias("data"))))
        .when(kind == "click", F.to_json(F.struct(F.struct(F.array(record).alias("rows")).alias("data"))))
        .when(kind == "purchase", F.to_json(F.struct(F.lit("not an object").alias("data"))))
        .otherwise(F.to_json(F.struct(F.struct(F.array(record, record).alias("events")).alias("data"))))
    )
    schema = T.StructType.fromDDL("id long, value double, who struct<user_id: long>, tags array<string>")
    rows = records_at(table(spark, sf, "events").select(body.alias("body")), "body", "data.events", schema)
    return flatten_struct(rows).select("id", "value", "`who.user_id`", F.size("tags").alias("n_tags"))


@query
def landed_files(spark, sf):
    """Orders landed as JSON Lines and read back with the declared dataset schema."""
    location = fresh_path(spark, "landed")
    roles.order_launches(spark, sf).drop("ingestion_timestamp").withColumn(
        "payloads", F.from_json("payloads", "array<string>")
    ).write.json(location)
    spec = replace(datasets()["launches"], json_lines=True)
    return flatten_struct(read_responses(spark, spec, location)).select(
        "id", "flight_number", "name", "date_utc", "rocket", "success", "details", "payloads", "cores", "launchpad",
        "crew", "window", "`links.patch.small`",
    )


@query
def response_shapes(spark, sf):
    """Orders landed as one list per file, as one object per file, and as an empty list."""
    location = fresh_path(spark, "shapes")
    orders = table(spark, sf, "orders")
    record = F.struct(F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderpriority").alias("name"))
    # a page holds at most a thousand of the unique keys
    page = F.expr("o_orderkey div 1000").alias("page")
    listed = orders.where("o_orderstatus <> 'P'").groupBy(page).agg(F.collect_list(record).alias("r"))
    newest = orders.where("o_orderstatus = 'P'").agg(F.max(record).alias("r"))
    pages = {
        "list": listed.select(F.to_json("r").alias("value")),
        "object": newest.select(F.to_json("r").alias("value")),
        "empty": newest.select(F.lit("[]").alias("value")),
    }
    spec = DatasetSpec("pages", "id string, name string")
    out = []
    for shape, bodies in pages.items():
        # one response a file: a page is one task's single row
        bodies.repartition(F.col("value")).write.option("maxRecordsPerFile", 1).text(f"{location}/{shape}")
        rows = read_responses(spark, spec, f"{location}/{shape}")
        out.append(rows.groupBy().agg(F.count("id").alias("n"), F.max("name").alias("top")).withColumn("shape", F.lit(shape)))
    return out[0].unionByName(out[1]).unionByName(out[2])


@query
def datasource_responses(spark, sf):
    """Orders landed as pages with their records below a path, one page a file, and read record by
    record; a page without the path and a page with one object are among them."""
    location = fresh_path(spark, "responses")
    orders = table(spark, sf, "orders")
    record = F.struct(
        F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("name"), F.array("o_orderstatus").alias("tags"), "o_totalprice"
    )
    # a page holds at most a thousand of the unique keys
    pages = orders.groupBy(F.expr("o_orderkey div 1000").alias("page")).agg(F.sort_array(F.collect_list(record)).alias("orders"))
    last = orders.agg(F.max(record).alias("orders"))
    bodies = [
        pages.select(F.to_json(F.struct("page", F.struct("orders", F.lit(1).alias("more")).alias("data"))).alias("value")),
        last.select(F.to_json(F.struct(F.struct("orders").alias("data"))).alias("value")),
        last.select(F.to_json(F.struct(F.struct(F.array("orders").alias("others")).alias("data"))).alias("value")),
    ]
    for i, body in enumerate(bodies):
        body.write.option("maxRecordsPerFile", 1).text(f"{location}/{i}")
    spec = DatasetSpec("pages", "id long, name string, tags string, o_totalprice double", json_path="data.orders", streamed=True)
    return read_responses(spark, spec, location)


# -- filters and joins ------------------------------------------------------------------


@query
def bool_filter_nulls(spark, sf):
    launches = silver.launches(roles.shipment_launches(spark, sf))
    return launches.where((F.col("is_success") == F.lit(True)) & F.col("payload_ids").isNotNull()).select(
        "launch_id", "launch_at_utc"
    )


@query
def dim_join_inner(spark, sf):
    orders, customer = table(spark, sf, "orders"), table(spark, sf, "customer")
    return (
        orders.select("o_orderkey", F.col("o_custkey").alias("c_custkey"), "o_orderdate")
        .join(customer.select("c_custkey", "c_name", "c_acctbal"), "c_custkey")
        .select("o_orderkey", "c_name", "c_acctbal", "o_orderdate")
    )


def _shipment_sums(spark, sf, keys, how):
    return element_sums(
        silver.launches(roles.shipment_launches(spark, sf)),
        "payload_ids",
        keys,
        silver.payloads(roles.part_payloads(spark, sf)),
        "payload_id",
        "mass_kg",
        "total_mass",
        how,
    )


@query
def exploded_left_join_sum(spark, sf):
    return _shipment_sums(spark, sf, ["launch_id"], "left")


@query
def exploded_inner_join_sum(spark, sf):
    return _shipment_sums(spark, sf, ["launch_id", "rocket_id", "launch_at_utc"], "inner")


@query
def interval_join_trailing_24h(spark, sf):
    """Errors in the 24 hours up to each signup: count and highest value."""
    events = table(spark, sf, "events")
    signups = events.where(F.col("event_type") == "signup").select("event_id", F.col("ts").alias("signup_at"))
    errors = events.where(F.col("event_type") == "error").select(
        F.col("event_id").alias("error_id"), F.col("ts").alias("error_at"), F.col("value").alias("error_value")
    )
    found = interval_aggregate(
        signups,
        errors,
        "signup_at",
        "error_at",
        dt.timedelta(hours=24),
        dt.timedelta(0),
        {"errors": ("count", "error_id"), "top_value": ("max", "error_value")},
    )
    return signups.join(found, "signup_at", "left").select(
        "event_id", zero_if_null("errors").alias("errors"), "top_value"
    )


@query
def interval_join_pm7d(spark, sf):
    """Each signup with every error of the same user at most seven days away."""
    events = table(spark, sf, "events")
    signups = events.where(F.col("event_type") == "signup").select(
        "event_id", "user_id", F.col("ts").alias("signup_at")
    )
    errors = events.where(F.col("event_type") == "error").select(
        F.col("event_id").alias("error_id"), F.col("user_id").alias("error_user"), F.col("ts").alias("error_at")
    )
    week = dt.timedelta(days=7)
    same_user = [("user_id", "error_user")]
    return interval_join(signups, errors, "signup_at", "error_at", week, week, "inner", on=same_user).select(
        "event_id", "user_id", "error_id", "error_at", hours_between("signup_at", "error_at").alias("hours_diff")
    )


@query
def risk_bands(spark, sf):
    return table(spark, sf, "events").select(
        "event_id",
        risk_band(F.when(F.col("event_type") != "view", F.col("value") * 10)).alias("risk"),
        zero_if_null(F.when(F.col("event_type") != "view", F.col("value"))).alias("value_or_zero"),
    )


def _part_ratio(spark, sf, ratio):
    cost, mass = F.col("p_retailprice"), F.col("p_size") - 10
    return table(spark, sf, "part").select("p_partkey", ratio(cost, mass).alias("ratio"))


@query
def ratio_zero(spark, sf):
    return _part_ratio(spark, sf, ratio_else_zero)


@query
def ratio_null(spark, sf):
    return _part_ratio(spark, sf, ratio_else_null)


@query
def ratio_tiny_mass(spark, sf):
    """Masses from 0.00004 on, which four decimals would turn into nothing."""
    mass = to_decimal((F.col("p_size") / 25000).cast("string"))
    return table(spark, sf, "part").select("p_partkey", ratio_else_zero("p_retailprice", mass).alias("ratio"))


@query
def surrogate_keys(spark, sf):
    segment = F.nullif("c_mktsegment", F.lit("FURNITURE"))
    return table(spark, sf, "customer").select("c_custkey", surrogate_key("c_custkey", segment).alias("key"))


# -- marts ------------------------------------------------------------------------------


def _performance(spark, sf):
    return gold.performance(
        silver.launches(roles.shipment_launches(spark, sf)),
        silver.rockets(roles.supplier_rockets(spark, sf)),
        silver.payloads(roles.part_payloads(spark, sf)),
        silver.solar_events(roles.order_solar_events(spark, sf)),
        AS_OF,
    )


def _roi(spark, sf):
    return gold.roi(
        roles.shipment_launches(spark, sf),
        silver.rockets(roles.supplier_rockets(spark, sf)),
        silver.payloads(roles.part_payloads(spark, sf)),
        AS_OF,
    )


def _weather(spark, sf):
    return gold.weather(
        silver.launches(roles.order_launches(spark, sf)),
        silver.solar_events(roles.shipping_day_solar_events(spark, sf)),
        AS_OF,
    )


@query
def mart_performance(spark, sf):
    return _performance(spark, sf)


@query
def mart_roi(spark, sf):
    return _roi(spark, sf)


@query
def mart_weather(spark, sf):
    return _weather(spark, sf)


# -- reports ----------------------------------------------------------------------------


@query
def top5_cheapest(spark, sf):
    return reports.cheapest(_roi(spark, sf))


@query
def sort_by_hours(spark, sf):
    return reports.under_solar_influence(_weather(spark, sf)).select("surrogate_key", "hours_diff")


@query
def report_raw_sample(spark, sf):
    return reports.raw_launch_sample(roles.order_launches(spark, sf))


@query
def report_solar_sample(spark, sf):
    return reports.solar_sample(silver.solar_events(roles.order_solar_events(spark, sf)))


@query
def report_rocket_overview(spark, sf):
    return reports.rocket_overview(silver.rockets(roles.supplier_rockets(spark, sf)))


@query
def report_performance_sample(spark, sf):
    best = gold.performance(
        silver.launches(roles.order_launches(spark, sf)),
        silver.rockets(roles.priority_rockets(spark, sf)),
        silver.payloads(roles.customer_payloads(spark, sf)),
        silver.solar_events(roles.shipping_day_solar_events(spark, sf)),
        AS_OF,
    )
    return reports.performance_sample(best)


@query
def profile_union_all(spark, sf):
    return reports.time_coverage(
        {
            "launches": (silver.launches(roles.shipment_launches(spark, sf)), "launch_at_utc"),
            "solar_events": (silver.solar_events(roles.order_solar_events(spark, sf)), "event_at_utc"),
        }
    )


@query
def adhoc_sql(spark, sf):
    layers = Layers(spark, fresh_path(spark, "views"))
    layers.view("silver", "launches", silver.launches(roles.shipment_launches(spark, sf)))
    return reports.ask(
        spark,
        "SELECT rocket_id, count(*) AS launches, max(launch_at_utc) AS last_at "
        "FROM silver_launches WHERE is_success GROUP BY rocket_id",
    )


# -- incremental loads and tables -------------------------------------------------------


def _before_cutoff(orders):
    return orders.where(F.col("o_orderdate") < ntz_literal(CUTOFF))


def _recalculated(orders):
    """A batch of all final orders with a new price."""
    return orders.where(F.col("o_orderstatus") == "F").withColumn("o_totalprice", F.col("o_totalprice") * 2)


@query
def incremental_new_rows(spark, sf):
    orders = table(spark, sf, "orders")
    mark = high_water_mark(_before_cutoff(orders), "o_orderdate")
    return newer_than(orders, "o_orderdate", mark).select("o_orderkey", "o_orderdate")


@query
def incremental_in_sql(spark, sf):
    """The same predicate as a scalar subquery over common table expressions."""
    layers = Layers(spark, fresh_path(spark, "views"))
    layers.view("raw", "orders", table(spark, sf, "orders"))
    return reports.ask(
        spark,
        "WITH target AS (SELECT * FROM raw_orders WHERE o_orderdate < TIMESTAMP_NTZ'1998-01-01 00:00:00'), "
        "source AS (SELECT * FROM raw_orders) "
        "SELECT o_orderkey, o_orderdate FROM source "
        "WHERE o_orderdate > (SELECT max(o_orderdate) FROM target)",
    )


@query
def incremental_empty_target(spark, sf):
    orders = table(spark, sf, "orders")
    mark = high_water_mark(orders.where(F.col("o_totalprice") < 0), "o_orderdate")
    counts = [
        newer_than(orders, "o_orderdate", mark, empty_target=mode)
        .agg(F.count(F.lit(1)).alias("rows_loaded"))
        .select(F.lit(mode).alias("mode"), "rows_loaded")
        for mode in ("nothing", "full")
    ]
    return counts[0].unionByName(counts[1])


@query
def delete_and_insert(spark, sf):
    orders = table(spark, sf, "orders")
    return delete_insert(_before_cutoff(orders), _recalculated(orders), "o_orderkey").select(
        "o_orderkey", "o_totalprice"
    )


@query
def append_new_columns(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    late = orders.where(F.col("o_orderdate") >= ntz_literal(CUTOFF))
    batch = late.withColumn("o_band", risk_band(F.col("o_totalprice") / 250)).drop("o_totalprice")
    return add_columns(_before_cutoff(orders), batch)


@query
def published_incremental(spark, sf):
    """Two published versions of a table: a first load, then delete-and-insert of a batch
    that replaces old rows, adds new ones and brings a new column."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus", "o_totalprice")
    target = Table(spark, fresh_path(spark, "gold"), "o_orderdate", key="o_orderkey")
    target.publish(target.stage_delete_insert(_before_cutoff(orders), "o_orderkey"))
    batch = _recalculated(orders).withColumn("o_band", risk_band(F.col("o_totalprice") / 250))
    target.publish(target.stage_delete_insert(batch, "o_orderkey"))
    return target.read()


@query
def full_refresh_load(spark, sf):
    """A raw table loaded twice: the second load replaces the rows and keeps the structure."""
    layers = Layers(spark, fresh_path(spark, "raw"))
    spec = DatasetSpec("launches", "", required=("id", "flight_number", "date_utc"))
    rows = roles.order_launches(spark, sf).drop("ingestion_timestamp").withColumn("extra", F.array("id"))
    target = layers.table("raw", "launches")
    daily.load_raw(target, rows, spec, AS_OF)
    daily.load_raw(target, rows.select(*reversed(rows.columns)).drop("details"), spec, AS_OF)
    return target.read()


def _specs():
    return [replace(s, json_lines=True) for s in datasets().values()]


@query
def daily_run_performance(spark, sf):
    """Landed files through the whole daily run; the published performance fact."""
    location, root = fresh_path(spark, "landed"), fresh_path(spark, "layers")
    roles.land(spark, sf, location)
    daily.run(spark, root, location, AS_OF, window=ALL_DAYS, specs=_specs())
    layers = Layers(spark, root)
    return layers.table("gold", "launches_performance", "launch_at_utc").read()


@query
def daily_run_incremental(spark, sf):
    """Two daily runs: the first sees the launches before the cutoff, the second all of
    them. The fact then holds what one run over everything would give."""
    root = fresh_path(spark, "layers")
    for known in (_before_cutoff, lambda orders: orders):
        location = fresh_path(spark, "landed")
        roles.land(spark, sf, location, known)
        daily.run(spark, root, location, AS_OF, window=ALL_DAYS, specs=_specs(), tag="roi")
    return Layers(spark, root).table("gold", "launch_roi", "launch_at_utc").read()


@query
def catalog_tables(spark, sf):
    """What another session reads from the catalog after a run that published and a run that its
    gate stopped: the fact by name, and the raw launches of each month."""
    root, prefix = fresh_path(spark, "layers"), "entry_"
    for copies in (1, 2):
        location = fresh_path(spark, "landed")
        roles.land(spark, sf, location, lambda orders, n=copies: orders.withColumn("_", F.explode(F.sequence(F.lit(1), F.lit(n)))))
        try:
            daily.run(spark, root, location, AS_OF, window=ALL_DAYS, specs=_specs(), tag="roi", prefix=prefix)
        except daily.GateFailed:
            pass
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "UTC")
    fact = other.table(f"{prefix}gold.launch_roi").select("launch_id", "rocket_name", "usd_per_kg", "launch_at_utc")
    landed = other.sql(
        f"SELECT concat('raw ', substr(date_utc, 1, 7)) AS launch_id, count(*) AS n FROM {prefix}raw.launches GROUP BY 1"
    )
    return fact.withColumn("n", F.lit(1).cast("long")).unionByName(landed, allowMissingColumns=True)


def _accounts_project():
    """The launches' customers as a dataset of its own, a view, and two facts: one that grows with
    the launches, one built on facts."""
    accounts = Model(
        "accounts",
        lambda f, at: f["raw.accounts"].select(F.col("id").alias("account_id"), "segment", to_decimal("balance").alias("balance")),
        ("raw.accounts",),
    )

    def per_launch(f, at):
        carried = explode_text(f["silver.launches"], "payload_ids", "account_id", "launch_id", "launch_at_utc")
        return carried.join(f["silver.accounts"], "account_id").select("launch_id", "launch_at_utc", "segment", "balance")

    def per_segment(f, at):
        joined = f["gold.launch_accounts"].select("launch_id", "segment", "balance").join(f["gold.launch_roi"], "launch_id")
        return joined.groupBy("segment").agg(
            F.count(F.lit(1)).alias("launches"),
            F.sum("balance").alias("balance"),
            F.max("launch_at_utc").alias("last_at"),
            F.max("usd_per_kg").alias("dearest"),
        )

    return default_project().with_datasets(
        DatasetSpec("accounts", "id string, segment string, balance double", required=("segment",), json_lines=True)
    ).with_models(
        accounts,
        Fact("launch_accounts", per_launch, ("silver.launches", "silver.accounts"), key="launch_id", loads="silver.launches"),
        Fact("segment_costs", per_segment, ("gold.launch_accounts", "gold.launch_roi"), ("segments",), key="segment", event_time=None),
    )


@query
def added_dataset(spark, sf):
    """A sixth dataset through two daily runs, the first before the cutoff: the fact built on two
    facts that the runs added to, selected by its own tag."""
    root, prefix = fresh_path(spark, "layers"), "added_"
    customers = table(spark, sf, "customer")
    for known in (_before_cutoff, lambda orders: orders):
        location = fresh_path(spark, "landed")
        roles.land(spark, sf, location, known)
        customers.select(
            F.col("c_custkey").cast("string").alias("id"), F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance")
        ).write.json(f"{location}/accounts")
        daily.run(
            spark, root, location, AS_OF, window=ALL_DAYS, specs=_specs(), tag="segments", project=_accounts_project(), prefix=prefix
        )
    return spark.table(f"{prefix}gold.segment_costs")


@query
def ingest_alerts(spark, sf):
    """Alerts of an ingestion in which one dataset lacks a required column, one has no
    file and the others load."""
    location, root = fresh_path(spark, "landed"), fresh_path(spark, "layers")
    roles.land(spark, sf, location)
    specs = [
        replace(s, required=(*s.required, "details")) if s.name == "payloads" else s for s in _specs()
    ]
    broken = {"payloads": "id string, name string, details string", "cores": None}
    specs = [replace(s, ddl=broken[s.name]) if broken.get(s.name) else s for s in specs]
    specs = [replace(s, name="cores_lost") if s.name == "cores" else s for s in specs]
    layers = Layers(spark, root)
    loaded = daily.ingest(layers, location, AS_OF, specs)
    message = F.col("message")
    shown = F.when(~message.startswith("["), message)  # an exception's text holds a path of this run
    alerts = layers.alerts().select("severity", "dataset", message, shown.alias("rejected_for"))
    rows = [(name, verdict.rows) for name, verdict in loaded.items() if verdict and verdict.ok]
    done = spark.createDataFrame(rows, "dataset string, total_rows long")
    return alerts.select(
        "dataset",
        "severity",
        message.startswith("[").alias("is_error"),
        F.lit(None).cast("long").alias("total_rows"),
        "rejected_for",
    ).unionByName(
        done.select(
            "dataset",
            F.lit("LOADED").alias("severity"),
            F.lit(False).alias("is_error"),
            "total_rows",
            F.lit(None).cast("string").alias("rejected_for"),
        )
    )


# -- data quality -----------------------------------------------------------------------


@query
def dq_unique(spark, sf):
    return quality.union_checks(
        [
            quality.unique(table(spark, sf, "events"), "events_id", "event_id"),
            quality.unique(table(spark, sf, "customer"), "customer_id", "c_custkey"),
            quality.unique(table(spark, sf, "part"), "part_id", "p_partkey"),
            quality.unique(table(spark, sf, "lineitem"), "lineitem_id", "l_orderkey", "l_linenumber"),
        ]
    )


@query
def dq_not_null(spark, sf):
    payloads = silver.payloads(roles.part_payloads(spark, sf))
    return quality.union_checks(
        [
            quality.not_null(payloads, "payload_id", "payload_id"),
            quality.not_null(payloads, "payload_mass", "mass_kg"),
            quality.not_null(payloads, "payload_mass_warning", "mass_kg", "warn"),
        ]
    )


CHECK_TIMES = {
    "first": dt.datetime(2024, 1, 31, 12),
    "second": dt.datetime(2024, 2, 1, 6),
    "third": dt.datetime(2024, 2, 3),
}


@query
def dq_recency(spark, sf):
    events = table(spark, sf, "events")
    return quality.union_checks([quality.recency(events, n, "ts", at) for n, at in CHECK_TIMES.items()])


@query
def dq_freshness(spark, sf):
    events = table(spark, sf, "events")
    return quality.union_checks([quality.freshness(events, n, "ts", at) for n, at in CHECK_TIMES.items()])


@query
def dq_expression(spark, sf):
    return quality.union_checks(
        [
            quality.expression_is_true(table(spark, sf, "customer"), "balance", F.col("c_acctbal") >= 0),
            quality.expression_is_true(table(spark, sf, "part"), "price", F.col("p_retailprice") >= 0),
            quality.expression_is_true(
                silver.payloads(roles.part_payloads(spark, sf)), "mass", F.col("mass_kg") > 0
            ),
        ]
    )


@query
def dq_accepted_values(spark, sf):
    orders = table(spark, sf, "orders")
    status = (
        F.when(F.col("o_orderstatus") == "F", "success").when(F.col("o_orderstatus") == "O", "failure")
    )
    named = orders.select(status.alias("launch_status"), "o_orderstatus")
    return quality.union_checks(
        [
            quality.accepted_values(named, "launch_status", "launch_status", quality.LAUNCH_STATUSES),
            quality.accepted_values(named, "order_status", "o_orderstatus", ("F", "O")),
        ]
    )


@query
def dq_at_least_one(spark, sf):
    customer = table(spark, sf, "customer").withColumn("nothing", F.nullif("c_name", "c_name"))
    return quality.union_checks(
        [quality.at_least_one(customer, "name", "c_name"), quality.at_least_one(customer, "nothing", "nothing")]
    )


@query
def dq_singular_same_day(spark, sf):
    """Purchases earlier than an error of the same user and day, with each such error."""
    events = table(spark, sf, "events")
    bought = events.where(F.col("event_type") == "purchase").select(
        F.col("event_id").alias("purchase_id"), "user_id", F.col("ts").alias("bought_at")
    )
    failed = events.where(F.col("event_type") == "error").select(
        F.col("event_id").alias("error_id"), F.col("user_id").alias("error_user"), F.col("ts").alias("failed_at")
    )
    pairs = quality.same_day_before(bought, failed, "bought_at", "failed_at", on=[("user_id", "error_user")])
    return pairs.drop("error_user")


@query
def dq_singular_gate(spark, sf):
    """All purchases earlier than any error of the same day, counted without pairs."""
    events = table(spark, sf, "events")
    bought = events.where(F.col("event_type") == "purchase").select(F.col("ts").alias("bought_at"))
    failed = events.where(F.col("event_type") == "error").select(F.col("ts").alias("failed_at"))
    return quality.same_day_before_check(bought, failed, "bought_before_error", "bought_at", "failed_at")


@query
def preflight_report(spark, sf):
    """Verdicts on batches: a good one, one without a required column, an empty one, one
    with null ids."""
    launches = roles.order_launches(spark, sf)
    spec = datasets()["launches"]
    batches = {
        "good": launches,
        "no_time": launches.drop("date_utc"),
        "time_never_set": launches.withColumn("date_utc", F.lit(None).cast("string")),
        "empty": launches.where(F.col("flight_number") < 0),
        "null_ids": launches.withColumn("id", F.nullif("details", F.lit("P"))),
    }
    verdicts = [(name, quality.preflight(df, spec)) for name, df in batches.items()]
    rows = [(n, v.rows, v.ok, "; ".join(v.errors), "; ".join(v.warnings)) for n, v in verdicts]
    return spark.createDataFrame(
        rows, "batch string, total_rows long, accepted boolean, errors string, warnings string"
    )


@query
def contract_report(spark, sf):
    """The launch contract on a frame that meets it, and on two that do not."""
    launches = roles.order_launches(spark, sf)
    batches = {
        "good": launches,
        "no_success": launches.drop("success", "name"),
        "empty": launches.where(F.col("flight_number") < 0),
    }
    rows = []
    for name, df in batches.items():
        try:
            CONTRACTS["launches"].validate(df)
            rows.append((name, "ok"))
        except ValueError as error:
            rows.append((name, str(error)))
    return spark.createDataFrame(rows, "batch string, verdict string")


@query
def frame_assertions(spark, sf):
    """Which assertion on the orders holds, and which raises."""
    orders = table(spark, sf, "orders")
    nulls = orders.withColumn("gone", F.nullif("o_orderstatus", F.lit("P")))
    trials = {
        "has_columns": lambda: quality.assert_has_columns(orders, ["o_orderkey", "o_custkey"]),
        "lacks_columns": lambda: quality.assert_has_columns(orders, ["o_orderkey", "nothing"]),
        "no_nulls": lambda: quality.assert_no_nulls(orders, "o_orderkey"),
        "nulls": lambda: quality.assert_no_nulls(nulls, "gone"),
        "type": lambda: quality.assert_column_type(orders, "o_orderkey", int),
        "other_type": lambda: quality.assert_column_type(orders, "o_orderkey", str),
        "row_count": lambda: quality.assert_row_count(orders, orders.select("o_orderkey").count()),
        "other_row_count": lambda: quality.assert_row_count(orders, -1),
    }
    rows = []
    for name, trial in trials.items():
        try:
            trial()
            rows.append((name, True))
        except AssertionError:
            rows.append((name, False))
    return spark.createDataFrame(rows, "assertion string, holds boolean")


@query
def unknown_contract(spark, sf):
    """Contracts asked for by name: a registered one, and ones named like an order priority."""
    ends = table(spark, sf, "orders").agg(F.min("o_orderpriority"), F.max("o_orderpriority")).first()
    rows = []
    for name in ("launches", *ends):
        try:
            rows.append((name, contract(name).name))
        except ValueError as error:
            rows.append((name, type(error).__name__))
    return spark.createDataFrame(rows, "name string, found string")


@query
def gate_blocks(spark, sf):
    """Two daily runs, the second with every launch landed twice: its gate raises, so the
    published fact is still that of the first; the alert names the check."""
    root = fresh_path(spark, "layers")
    outcomes = []
    for copies in (1, 2):
        location = fresh_path(spark, "landed")
        roles.land(spark, sf, location, lambda orders, n=copies: orders.withColumn("_", F.explode(F.sequence(F.lit(1), F.lit(n)))))
        try:
            daily.run(spark, root, location, AS_OF, window=ALL_DAYS, specs=_specs(), tag="performance")
            outcomes.append("published")
        except daily.GateFailed as error:
            outcomes.append(str(error))
    layers = Layers(spark, root)
    fact = layers.table("gold", "launches_performance", "launch_at_utc").read().agg(F.count(F.lit(1)).alias("rows"))
    alerts = layers.alerts().select(F.concat_ws(" ", "severity", "dataset", "message").alias("what"), F.lit(None).cast("long").alias("rows"))
    ended = spark.createDataFrame([(f"run {i}: {o}", None) for i, o in enumerate(outcomes, 1)], "what string, rows long")
    return fact.select(F.lit("fact").alias("what"), "rows").unionByName(alerts).unionByName(ended)


# -- KPIs -------------------------------------------------------------------------------


@query
def kpi_success_rate_by_year(spark, sf):
    launches = silver.launches(roles.shipment_launches(spark, sf))
    return kpi.success_rate_by_year(launches, "launch_at_utc", "is_success")


@query
def kpi_density(spark, sf):
    launches = roles.shipment_launches(spark, sf).select(F.col("rocket").alias("id"), "launchpad")
    rockets = roles.supplier_rockets(spark, sf).select("id", F.col("type").alias("rocket_type"))
    return kpi.density(launches.join(rockets, "id"), "rocket_type", "launchpad")


@query
def kpi_mean_time_between(spark, sf):
    launches = silver.launches(roles.shipment_launches(spark, sf))
    rockets = silver.rockets(roles.supplier_rockets(spark, sf)).select("rocket_id", "rocket_type")
    failures = launches.where(~F.col("is_success")).join(rockets, "rocket_id")
    return kpi.mean_days_between(failures, "rocket_type", "launch_at_utc")


@query
def kpi_status_summary(spark, sf):
    return kpi.status_summary(table(spark, sf, "orders"), "o_orderstatus", "o_totalprice")
