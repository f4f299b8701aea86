"""The operators' input tables, derived from the star-schema test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowline.operators.catalog import TableSpec

FLOW = "tpch"

# Where the ids of each kind of vertex and edge start.
NATION, CUSTOMER, ORDER, SUPPLIER, DEPENDENT = 100, 10**12, 10**13, 10**14, 10**15

CUSTOMER_SPEC = TableSpec(
    name="customer",
    columns=(
        ("c_custkey", "bigint"),
        ("c_name", "string"),
        ("c_nationkey", "int"),
        ("c_acctbal", "decimal(18,2)"),
        ("c_mktsegment", "string"),
    ),
    keys=("c_custkey",),
    clustered_by="c_nationkey",
    buckets=8,
)
ORDERS_SPEC = TableSpec(
    name="orders",
    columns=(
        ("o_orderkey", "bigint"),
        ("o_custkey", "bigint"),
        ("o_orderstatus", "string"),
        ("o_totalprice", "decimal(18,2)"),
        ("o_orderdate", "timestamp_ntz"),
        ("o_orderpriority", "string"),
    ),
    keys=("o_orderkey",),
    clustered_by="o_custkey",
    buckets=8,
)


def as_of() -> Column:
    """The time every run of the check queries is stamped with."""
    return F.expr("TIMESTAMP_NTZ '2024-02-01 00:00:00'")


SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def named(prefix: str, key: Column | str) -> Column:
    return F.concat(F.lit(f"{prefix}-"), (F.col(key) if isinstance(key, str) else key).cast("string"))


# -- ingestion ------------------------------------------------------------------


def staged(spark: SparkSession, sf_dir: str, spec: TableSpec) -> DataFrame:
    """An extract in the column types of the catalog."""
    return table(spark, sf_dir, spec.name).select(*[F.col(c).cast(t).alias(c) for c, t in spec.columns])


def earlier_state(delta: DataFrame, spec: TableSpec, shift: int, wrap: int | None = None) -> DataFrame:
    """A current table older than ``delta``: some keys missing, some checksums outdated.

    The cluster column differs throughout, to show that an update keeps it.
    """
    key, cluster = F.col(spec.keys[0]), F.col(spec.clustered_by)
    moved = cluster + shift if wrap is None else (cluster + shift) % wrap
    return delta.filter(key % 10 != 0).withColumns(
        {
            "checksum": F.when(key % 7 == 0, "old").otherwise(F.col("checksum")),
            spec.clustered_by: moved.cast(spec.type_of(spec.clustered_by)),
            "watermark": F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00'"),
        }
    )


def catalog_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalog rows: every part is a column, every 20 parts are one object."""
    p = table(spark, sf_dir, "part")
    changes = F.when(F.col("p_size") % 9 == 0, F.lit("_ChangeTS")).otherwise(F.lit(""))
    kinds = {"STANDARD": "STRING", "ECONOMY": "int", "MEDIUM": "BIGINT", "PROMO": "decimal(18,2)", "LARGE": "double"}
    kind = F.lit("timestamp")
    for part_type, data_type in kinds.items():
        kind = F.when(F.col("p_type") == part_type, data_type).otherwise(kind)
    return p.select(
        F.col("p_partkey").alias("id"),
        F.floor(F.col("p_partkey") / 20).alias("haoid"),
        F.concat(F.initcap(F.replace("p_name", F.lit(" "), F.lit("_"))), changes).alias("column_name"),
        (F.col("p_size") <= 10).alias("is_key"),
        (F.lit(100) - F.col("p_size")).cast("int").alias("col_order"),
        kind.alias("infer_data_type"),
    )


def catalog_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.filter(F.col("p_partkey") % 20 == 0).select(
        F.floor(F.col("p_partkey") / 20).alias("id"),
        F.upper(F.replace("p_brand", F.lit("#"), F.lit("_"))).alias("namespace"),
        F.lower("p_type").alias("package_id"),
        F.concat(F.lit("Object"), F.floor(F.col("p_partkey") / 20).cast("string")).alias("db_object_name"),
    )


def catalog_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every supplier asks for the object of its own number; some do not exist."""
    asked = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"))
    return catalog_headers(spark, sf_dir).join(asked, "id", "left_semi").drop("id")


# -- lineage graph --------------------------------------------------------------

COMPONENT_COLUMNS = (
    "flow_id", "seq", "kind", "group_depth", "id", "parent_group_id", "name", "properties",
    "source_group_id", "destination_group_id",
)


def _component(df: DataFrame, kind: str, **columns: Column) -> DataFrame:
    none = F.lit(None).cast("string")
    defaults = {
        "flow_id": F.lit(FLOW),
        "kind": F.lit(kind),
        "group_depth": F.lit(0),
        "parent_group_id": none,
        "name": none,
        "properties": F.lit(None).cast("map<string,string>"),
        "source_group_id": none,
        "destination_group_id": none,
    }
    chosen = {**defaults, **columns}
    return df.select(*[chosen[c].alias(c) for c in COMPONENT_COLUMNS])


def star_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions, nations and customers as nested groups, orders and suppliers as processors.

    Connections lead from the customer's nation to the supplier's nation of
    every line, one per pair of nations.
    """
    t = lambda name: table(spark, sf_dir, name)
    # As a column rather than a literal: joins on a constant would lose their key.
    root = t("region").agg(F.max(F.lit("root")).alias("root"))
    parts = [
        _component(root, "rootGroup", seq=F.lit(0).cast("bigint"), id=F.col("root"), name=F.lit("TPCH")),
        _component(
            t("region"), "processGroup", seq=F.col("r_regionkey").cast("bigint") + 1, id=named("region", "r_regionkey"),
            parent_group_id=F.lit("root"), name=F.col("r_name"),
        ),
        _component(
            t("nation"), "processGroup", seq=F.col("n_nationkey").cast("bigint") + NATION, group_depth=F.lit(1),
            id=named("nation", "n_nationkey"), parent_group_id=named("region", "n_regionkey"), name=F.col("n_name"),
        ),
        _component(
            t("customer"), "processGroup", seq=F.col("c_custkey") + CUSTOMER, group_depth=F.lit(2),
            id=named("customer", "c_custkey"), parent_group_id=named("nation", "c_nationkey"), name=F.col("c_name"),
        ),
        _component(
            t("orders"), "processor", seq=F.col("o_orderkey") + ORDER, group_depth=F.lit(3),
            id=named("order", "o_orderkey"), parent_group_id=named("customer", "o_custkey"),
            name=F.concat(F.lit("Order#"), F.col("o_orderkey").cast("string")),
            properties=F.create_map(
                F.lit("status"), "o_orderstatus", F.lit("priority"), "o_orderpriority",
                F.lit("total"), F.col("o_totalprice").cast("decimal(18,2)").cast("string"),
            ),
        ),
        _component(
            t("supplier"), "processor", seq=F.col("s_suppkey") + SUPPLIER, group_depth=F.lit(2),
            id=named("supplier", "s_suppkey"), parent_group_id=named("nation", "s_nationkey"), name=F.col("s_name"),
            properties=F.create_map(F.lit("balance"), F.col("s_acctbal").cast("decimal(18,2)").cast("string")),
        ),
        nation_connections(spark, sf_dir),
    ]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union


def nation_connections(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = lambda name: table(spark, sf_dir, name)
    buyers = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_nationkey")
    sellers = t("lineitem").join(t("supplier"), F.col("l_suppkey") == F.col("s_suppkey")).select("l_orderkey", "s_nationkey")
    pairs = (
        sellers.join(buyers, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(F.col("c_nationkey").alias("a"), F.col("s_nationkey").alias("b"))
        .distinct()
    )
    number = F.col("a").cast("bigint") * 100 + F.col("b")
    return _component(
        pairs, "connection", seq=number + DEPENDENT, id=named("link", number), parent_group_id=F.lit("root"),
        source_group_id=named("nation", "a"), destination_group_id=named("nation", "b"),
    )


# -- status ---------------------------------------------------------------------


def order_connections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as connections of their customer; open ones have a queue."""
    queued = F.when(F.col("o_orderstatus") == "O", F.format_number(F.round("o_totalprice"), 0)).otherwise(F.lit("0"))
    return table(spark, sf_dir, "orders").select(
        F.lit(FLOW).alias("flow_id"),
        named("order", "o_orderkey").alias("entity_id"),
        named("customer", "o_custkey").alias("parent_id"),
        queued.alias("queued_count"),
    )


def group_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status rows of regions, nations and customers.

    A nation divisible by 5 reports an empty queue although its customers have
    one, so a pruned descent must not reach them.
    """
    t = lambda name: table(spark, sf_dir, name)
    status = F.col("o_orderstatus")
    per_customer = (
        t("orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(
            F.count_if(status == "F").alias("running"),
            F.count_if(status == "O").alias("stopped"),
            F.count_if(status == "P").alias("disabled"),
            F.sum(F.when(status == "O", F.round("o_totalprice").cast("bigint")).otherwise(0)).alias("queue"),
        )
    )
    zero = F.lit(0).cast("bigint")
    customers = t("customer").join(per_customer, "c_custkey", "left").select(
        "c_custkey", "c_nationkey", *[F.coalesce(c, zero).alias(c) for c in ("running", "stopped", "disabled", "queue")]
    )
    per_nation = customers.groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.sum("queue").alias("queue"))
    shown = F.when(F.col("n_nationkey") % 5 == 0, zero).otherwise(F.coalesce("queue", zero))
    nations = t("nation").join(per_nation, "n_nationkey", "left").select(
        "n_nationkey",
        "n_regionkey",
        shown.alias("queue"),
        (F.col("n_nationkey") % 3).cast("bigint").alias("active"),
        ((F.col("n_nationkey") + 1) % 2).cast("bigint").alias("inactive"),
    )
    regions = nations.groupBy("n_regionkey").agg(
        *[F.sum(c).alias(c) for c in ("queue", "active", "inactive")]
    )

    def rows(df: DataFrame, entity: Column, parent: Column, remote: bool, counts: bool) -> DataFrame:
        return df.select(
            F.lit(FLOW).alias("flow_id"),
            entity.alias("entity_id"),
            parent.alias("parent_id"),
            *[(F.col(c) if counts else zero).alias(c) for c in ("running", "stopped", "disabled")],
            zero.alias("invalid"),
            F.format_number("queue", 0).alias("queued_count"),
            (F.col("active") if remote else zero).alias("active_remote"),
            (F.col("inactive") if remote else zero).alias("inactive_remote"),
        )

    return (
        rows(customers, named("customer", "c_custkey"), named("nation", "c_nationkey"), False, True)
        .unionByName(rows(nations, named("nation", "n_nationkey"), named("region", "n_regionkey"), True, False))
        .unionByName(rows(regions, named("region", "n_regionkey"), F.lit("root"), True, False))
    )


def customer_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_status(spark, sf_dir).filter(F.col("entity_id").startswith("customer-"))


def roots(spark: SparkSession) -> DataFrame:
    return spark.range(1).select(F.lit(FLOW).alias("flow_id"), F.lit("root").alias("entity_id"))


def line_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as services, their lines as the components referencing them."""
    return table(spark, sf_dir, "lineitem").select(
        F.lit(FLOW).alias("flow_id"),
        named("order", "l_orderkey").alias("service_id"),
        named("part", "l_partkey").alias("ref_id"),
        F.col("l_linestatus").alias("state"),
        F.col("l_linenumber").cast("bigint").alias("revision"),
    )


def event_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.lit(FLOW).alias("flow_id"),
        named("user", "user_id").alias("entity_id"),
        F.when(F.col("event_type") == "error", "INVALID").otherwise(F.col("event_type")).alias("state"),
        F.col("event_id").alias("version"),
        F.col("ts").cast("timestamp").alias("ts"),
    )


# -- reconciliation ---------------------------------------------------------------


def part_kind() -> Column:
    kinds = {
        "STANDARD": "processGroup", "ECONOMY": "inputPort", "MEDIUM": "outputPort",
        "PROMO": "processor", "LARGE": "connection",
    }
    kind = F.lit("remoteProcessGroup")
    for part_type, name in kinds.items():
        kind = F.when(F.col("p_type") == part_type, name).otherwise(kind)
    return kind


def live_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as live components of their brand's flow; some names in capitals."""
    name = F.when(F.col("p_size") % 4 == 0, F.upper("p_name")).otherwise(F.col("p_name"))
    return table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("flow_id"),
        part_kind().alias("kind"),
        named("part", "p_partkey").alias("id"),
        name.alias("name"),
        F.col("p_partkey").alias("pos"),
    )


def template_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("template"), part_kind().alias("kind"), F.col("p_name").alias("name")
    )


def variables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What users said, as the variables of their conversation."""
    c = table(spark, sf_dir, "conversations").filter(F.col("role") == "user")
    return c.select(
        F.lit("conv").alias("flow_id"), named("conv", "conv_id").alias("pg_id"),
        F.concat(F.lit("var_"), F.col("turn").cast("string")).alias("name"), F.col("text").alias("value"),
    )


def parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers as parameters: same name, other case or new name; some null or blank."""
    c = table(spark, sf_dir, "conversations").filter(F.col("role") == "assistant")
    n = F.length("text")
    before, turn = (F.col("turn") - 1).cast("string"), F.col("turn").cast("string")
    name = (
        F.when(n % 3 == 0, F.concat(F.lit("var_"), before))
        .when(n % 3 == 1, F.concat(F.lit("VAR_"), before))
        .otherwise(F.concat(F.lit("new_"), turn))
    )
    value = F.when(n % 5 == 0, F.lit(None)).when(n % 7 == 0, F.lit("  ")).otherwise(F.col("text"))
    return c.select(
        F.lit("conv").alias("flow_id"), named("conv", "conv_id").alias("pg_id"), name.alias("name"), value.alias("value")
    )


# -- configuration checks ---------------------------------------------------------


def checked_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as processors and lines as connections, with values that break rules."""
    o, priority = table(spark, sf_dir, "orders"), F.col("o_orderpriority")
    status = F.col("o_orderstatus")
    procs = o.select(
        named("cust", "o_custkey").alias("flow_id"),
        F.lit("processor").alias("kind"),
        F.lit(1).alias("group_depth"),
        named("order", "o_orderkey").alias("id"),
        F.when(priority == "5-LOW", "").otherwise(F.concat(F.lit("Order#"), F.col("o_orderkey").cast("string"))).alias("name"),
        priority.alias("class"),
        F.when(status == "F", "RUNNING").when(status == "O", "STOPPED").otherwise("PAUSED").alias("scheduled_state"),
        F.when(status == "F", "TIMER_DRIVEN").when(status == "O", "timer").alias("scheduling_strategy"),
        F.lit("0 sec").alias("scheduling_period"),
        F.when(priority == "1-URGENT", "soon").otherwise("30 sec").alias("penalization_period"),
        F.when(priority != "2-HIGH", F.concat((F.col("o_custkey") % 60).cast("string"), F.lit("mins"))).alias("yield_period"),
        F.when(priority == "3-MEDIUM", "LOUD").otherwise("WARN").alias("bulletin_level"),
        F.when(status == "P", "primary").when(status == "O", "PRIMARY").alias("execution_node"),
        F.floor(F.col("o_totalprice") / 1000 - 100).cast("string").alias("max_concurrent_tasks"),
        F.when(F.col("o_orderkey") % 7 != 0, F.when(status == "P", "perhaps").otherwise("false")).alias("loss_tolerant"),
        F.create_map(F.when(F.col("o_orderkey") % 11 == 0, "").otherwise("Key"), status).alias("properties"),
    )
    flag = F.col("l_returnflag")
    lines = table(spark, sf_dir, "lineitem").select(
        named("supp", "l_suppkey").alias("flow_id"),
        F.lit("connection").alias("kind"),
        F.lit(1).alias("group_depth"),
        named("line", F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")).alias("id"),
        F.when(flag != "N", "").alias("name"),
        named("order", "l_orderkey").alias("source_id"),
        F.when(F.col("l_linenumber") == 7, "").otherwise(named("cust", "l_orderkey")).alias("source_group_id"),
        F.lit("PROCESSOR").alias("source_type"),
        named("part", "l_partkey").alias("destination_id"),
        named("supp", "l_suppkey").alias("destination_group_id"),
        F.when(flag != "A", "PROCESSOR").alias("destination_type"),
        F.when(flag != "R", F.array(F.lit("success"))).alias("relationships"),
        (F.col("l_quantity").cast("bigint") - 3).cast("string").alias("max_work_queue_size"),
        F.when(flag == "R", F.concat(F.col("l_linenumber").cast("string"), F.lit(" GB"))).when(flag == "A", "plenty").alias("max_work_queue_data_size"),
        F.when(F.col("l_linestatus") == "F", "0 sec").otherwise("never").alias("flow_file_expiration"),
        F.when((flag == "R") & (F.col("l_linenumber") == 7) & (F.col("l_quantity") > 45), "ROUND_ROBIN").alias("load_balance_strategy"),
        F.when((flag == "R") & (F.col("l_linenumber") == 6) & (F.col("l_quantity") > 48), "attr").alias("partitioning_attribute"),
        F.lit(None).cast("string").alias("load_balance_compression"),
    )
    number = F.col("s_suppkey")
    services = table(spark, sf_dir, "supplier").select(
        F.lit("services").alias("flow_id"), F.lit("controllerService").alias("kind"), F.lit(1).alias("group_depth"),
        named("service", "s_suppkey").alias("id"), F.when(number % 4 != 0, F.col("s_name")).alias("name"),
        F.when(number % 5 == 0, "").otherwise("Service").alias("class"),
        F.when(number % 6 == 0, "on").otherwise("true").alias("enabled"),
        F.create_map(F.when(number % 9 == 0, "").otherwise("Key"), F.lit("v")).alias("properties"),
    )
    nation = F.col("n_nationkey")
    remotes = table(spark, sf_dir, "nation").select(
        F.lit("remotes").alias("flow_id"), F.lit("remoteProcessGroup").alias("kind"), F.lit(1).alias("group_depth"),
        named("remote", "n_nationkey").alias("id"), F.col("n_name").alias("name"),
        F.when(nation % 2 == 0, "http://host").alias("url"), F.when(nation % 3 == 0, "30 sec").alias("timeout"),
        F.when(nation % 4 == 0, "yes").when(nation % 4 == 1, "false").alias("transmitting"),
    )
    rows = procs.unionByName(lines, allowMissingColumns=True).unionByName(services, allowMissingColumns=True)
    return rows.unionByName(remotes, allowMissingColumns=True)


# -- flow documents ---------------------------------------------------------------

#: Flow documents that one task parses, and flow files that one writes.
ORDERS_PER_TASK = 20_000
SUPPLIERS_PER_TASK = 500


def _tasks(rows: DataFrame, per_task: int) -> int:
    """All cores have some of the work, and tasks do not grow with the table."""
    return max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // per_task))


def flow_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One configuration file per order; pending urgent ones are cut short.

    Root group: the customer, holding a processor, two ports, a link to the
    order's group; that group holds a processor, a nested group with one more
    processor, a link into it and a link that stays inside.
    """
    key = F.col("o_orderkey").cast("string")

    def text(template: str) -> Column:
        pieces = []
        for i, piece in enumerate(template.split("@")):
            pieces += [F.lit(piece)] if i % 2 == 0 else [columns[piece]]
        return F.concat(*pieces)

    columns = {
        "k": key, "c": F.col("o_custkey").cast("string"), "status": F.col("o_orderstatus"),
        "priority": F.col("o_orderpriority"), "total": F.col("o_totalprice").cast("decimal(18,2)").cast("string"),
    }
    xml = text(
        '<?xml version="1.0" encoding="UTF-8"?><flowController><maxThreadCount>1</maxThreadCount>'
        '<rootGroup encoding-version="1.3"><id>cust-@c@</id><name>Customer @c@</name>'
        "<processor><id>intake-@k@</id><name>intake</name></processor>"
        "<inputPort><id>in-@k@</id><name>in</name><scheduledState>RUNNING</scheduledState>"
        "<maxConcurrentTasks>1</maxConcurrentTasks></inputPort>"
        "<outputPort><id>out-@k@</id><name>out</name><scheduledState>STOPPED</scheduledState>"
        "<maxConcurrentTasks>2</maxConcurrentTasks></outputPort>"
        "<processGroup><id>order-@k@</id><name>Order &amp; @k@</name>"
        "<processor><id>price-@k@</id><name>price</name><class>Pricing</class>"
        "<property><name>status</name><value>@status@</value></property>"
        "<property><name>priority</name><value> @priority@ </value></property>"
        "<property><name>unset</name></property></processor>"
        "<processGroup><id>ship-@k@</id><name>Ship</name>"
        "<processor><id>send-@k@</id><name>send</name><property><name>total</name><value>@total@</value></property></processor>"
        "</processGroup>"
        "<connection><id>ab-@k@</id><name/><sourceId>price-@k@</sourceId><sourceGroupId>order-@k@</sourceGroupId>"
        "<sourceType>PROCESSOR</sourceType><destinationId>send-@k@</destinationId>"
        "<destinationGroupId>ship-@k@</destinationGroupId><destinationType>PROCESSOR</destinationType>"
        "<relationship>success</relationship><relationship>retry</relationship></connection>"
        "<connection><id>aa-@k@</id><name>loop</name><sourceId>price-@k@</sourceId><sourceGroupId>order-@k@</sourceGroupId>"
        "<destinationId>price-@k@</destinationId><destinationGroupId>ORDER-@k@</destinationGroupId></connection>"
        "</processGroup>"
        "<connection><id>ra-@k@</id><name>in to order</name><sourceId>in-@k@</sourceId><sourceGroupId>cust-@c@</sourceGroupId>"
        "<destinationId>price-@k@</destinationId><destinationGroupId>order-@k@</destinationGroupId></connection>"
        "</rootGroup></flowController>"
    )
    cut = (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "1-URGENT")
    content = F.when(cut, F.substring(xml, 1, 400)).otherwise(xml)
    # Parsing is heavy for the few bytes of an order: spread it over all cores,
    # whatever the size of the table's files, in tasks that do not grow with it.
    orders = table(spark, sf_dir, "orders")
    spread = orders.repartition(_tasks(orders, ORDERS_PER_TASK))
    return spread.select(F.concat(F.lit("flow-"), key).alias("path"), F.encode(content, "UTF-8").alias("content"))


def flow_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(flow, value): one configuration file per supplier; each tenth is cut short.

    A file of its own takes time, not bytes: many tasks write them, all rows of a flow in one of them.
    """
    key = F.col("s_suppkey")
    xml = F.format_string(
        "<?xml version='1.0'?><flowController><rootGroup><id>root-%1$d</id><name>%2$s</name><processGroup><id>area-%1$d</id>"
        "<name>Area &amp; more</name><processor><id>send-%1$d</id><name>send</name></processor></processGroup></rootGroup>%3$s",
        key, F.col("s_name"), F.when(key % 10 == 3, "").otherwise("</flowController>"),
    )
    suppliers = table(spark, sf_dir, "supplier")
    files = suppliers.select(named("supplier", "s_suppkey").alias("flow"), xml.alias("value"))
    return files.repartition(_tasks(suppliers, SUPPLIERS_PER_TASK), "flow")
