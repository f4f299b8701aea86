"""Check queries of the status analytics."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import binding as b
from checks.registry import check
from flowline.operators import status as st
from flowline.session import scratch_path
from flowline.streaming.streams import (
    command_outcomes,
    read_latest_state,
    read_open_commands,
    read_reached_state,
    stream_latest_state,
    stream_reached_state,
)

DAY = 86400

CUSTOMERS = """
cust AS (
    SELECT c_custkey, c_nationkey,
        count(o_orderkey) FILTER (WHERE o_orderstatus = 'F') AS running,
        count(o_orderkey) FILTER (WHERE o_orderstatus = 'O') AS stopped,
        count(o_orderkey) FILTER (WHERE o_orderstatus = 'P') AS disabled, CAST(0 AS BIGINT) AS invalid,
        CAST(coalesce(sum(CAST(round(o_totalprice) AS BIGINT)) FILTER (WHERE o_orderstatus = 'O'), 0) AS BIGINT) AS queue
    FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey, c_nationkey),
nat AS (
    SELECT n_nationkey, n_regionkey, n_nationkey % 3 AS active, (n_nationkey + 1) % 2 AS inactive,
        CASE WHEN n_nationkey % 5 = 0 THEN 0 ELSE coalesce((SELECT sum(queue) FROM cust WHERE c_nationkey = n_nationkey), 0) END AS queue
    FROM nation),
tree AS (
    SELECT 'customer-' || c_custkey AS entity, 'nation-' || c_nationkey AS parent, queue, 0 AS active, 0 AS inactive FROM cust
    UNION ALL SELECT 'nation-' || n_nationkey, 'region-' || n_regionkey, queue, active, inactive FROM nat
    UNION ALL SELECT 'region-' || n_regionkey, 'root', sum(queue), sum(active), sum(inactive) FROM nat GROUP BY n_regionkey)"""


def visited(name, prune):
    return f"""{name} AS (
    SELECT 'root' AS entity UNION ALL SELECT t.entity FROM {name} v JOIN tree t ON t.parent = v.entity WHERE t.{prune} > 0)"""


@check(
    "status_activity",
    f"""WITH {CUSTOMERS}
    SELECT 'customer-' || c_custkey AS entity_id, running, stopped, disabled, invalid,
        running + stopped + disabled + invalid AS total,
        running * CAST(100 AS DOUBLE) / nullif(running + stopped + disabled + invalid, 0) AS pct,
        coalesce(running * CAST(100 AS DOUBLE) / nullif(running + stopped + disabled + invalid, 0) > 10, FALSE) AS is_active
    FROM cust""",
)
def status_activity(spark, sf_dir):
    return st.group_activity(b.customer_status(spark, sf_dir)).select(
        "entity_id", "running", "stopped", "disabled", "invalid", "total", "pct", "is_active"
    )


@check(
    "status_queued",
    """SELECT 'customer-' || o_custkey AS parent_id,
        CAST(sum(CASE WHEN o_orderstatus = 'O' THEN CAST(round(o_totalprice) AS BIGINT) ELSE 0 END) AS BIGINT) AS queued,
        count(*) FILTER (WHERE o_orderstatus = 'O' AND round(o_totalprice) > 0) AS non_empty
    FROM orders GROUP BY o_custkey""",
)
def status_queued(spark, sf_dir):
    return st.queued_totals(b.order_connections(spark, sf_dir)).drop("flow_id")


@check(
    "status_drain",
    f"""WITH RECURSIVE {CUSTOMERS}, {visited('seen', 'queue')}
    SELECT 'root' AS root_id, 'customer-' || o_custkey AS parent_id, 'order-' || o_orderkey AS entity_id,
        CAST(round(o_totalprice) AS BIGINT) AS queued
    FROM orders JOIN seen ON entity = 'customer-' || o_custkey WHERE o_orderstatus = 'O' AND round(o_totalprice) > 0""",
)
def status_drain(spark, sf_dir):
    found = st.connections_to_drain(
        b.group_status(spark, sf_dir), b.order_connections(spark, sf_dir), b.roots(spark)
    )
    return found.select("root_id", "parent_id", "entity_id", "queued")


@check(
    "status_drain_own",
    """SELECT 'customer-' || o_custkey AS root_id, 'order-' || o_orderkey AS entity_id,
        CAST(round(o_totalprice) AS BIGINT) AS queued
    FROM orders WHERE o_orderstatus = 'O' AND round(o_totalprice) > 0 AND o_custkey IN (SELECT c_custkey FROM customer)""",
)
def status_drain_own(spark, sf_dir):
    """Each customer is a root; only its own connections are looked at."""
    own = b.table(spark, sf_dir, "customer").select(
        F.lit(b.FLOW).alias("flow_id"), b.named("customer", "c_custkey").alias("entity_id")
    )
    found = st.connections_to_drain(None, b.order_connections(spark, sf_dir), own, recursive=False)
    return found.select("root_id", "entity_id", "queued")


@check(
    "status_remote_toggle",
    f"""WITH RECURSIVE {CUSTOMERS}, {visited('dis', 'active')}, {visited('ena', 'inactive')}
    SELECT 'disable' AS mode, 'nation-' || s_nationkey AS parent_id, 'supplier-' || s_suppkey AS entity_id
    FROM supplier JOIN dis ON entity = 'nation-' || s_nationkey
    UNION ALL
    SELECT 'enable', 'nation-' || s_nationkey, 'supplier-' || s_suppkey FROM supplier JOIN ena ON entity = 'nation-' || s_nationkey""",
)
def status_remote_toggle(spark, sf_dir):
    groups = b.group_status(spark, sf_dir)
    remotes = b.table(spark, sf_dir, "supplier").select(
        F.lit(b.FLOW).alias("flow_id"), b.named("nation", "s_nationkey").alias("parent_id"),
        b.named("supplier", "s_suppkey").alias("entity_id"),
    )

    def toggled(enable, mode):
        found = st.remote_groups_to_toggle(groups, remotes, b.roots(spark), enable)
        return found.select(F.lit(mode).alias("mode"), "parent_id", "entity_id")

    return toggled(False, "disable").unionByName(toggled(True, "enable"))


@check(
    "status_converged",
    f"""WITH {CUSTOMERS}
    SELECT 'customer-' || c_custkey AS entity_id, 'STOPPED' AS target, running = 0 AS children_converged,
        running = 0 AND queue = 0 AS converged FROM cust
    UNION ALL
    SELECT 'customer-' || c_custkey, 'RUNNING', stopped = 0, stopped = 0 FROM cust""",
)
def status_converged(spark, sf_dir):
    """Orders as child groups of their customer."""
    status = F.col("o_orderstatus")
    children = b.table(spark, sf_dir, "orders").select(
        F.lit(b.FLOW).alias("flow_id"), b.named("order", "o_orderkey").alias("entity_id"),
        b.named("customer", "o_custkey").alias("parent_id"), (status == "F").cast("int").alias("running"),
        (status == "O").cast("int").alias("stopped"), F.lit("0").alias("queued_count"),
    )
    parents = b.customer_status(spark, sf_dir)

    def state(target):
        done = st.children_converged(children, parents, target)
        return done.select("entity_id", F.lit(target).alias("target"), "children_converged", "converged")

    return state("STOPPED").unionByName(state("RUNNING"))


@check(
    "status_refs_converged",
    """SELECT 'order-' || o_orderkey AS service_id, coalesce(bool_and(l_linestatus = 'F'), TRUE) AS converged
    FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey""",
)
def status_refs_converged(spark, sf_dir):
    services = b.table(spark, sf_dir, "orders").select(
        F.lit(b.FLOW).alias("flow_id"), b.named("order", "o_orderkey").alias("service_id")
    )
    return st.references_converged(services, b.line_references(spark, sf_dir), "F").drop("flow_id")


@check(
    "status_revisions",
    """SELECT 'order-' || l_orderkey AS service_id, 'part-' || l_partkey AS ref_id,
        CAST(max(l_linenumber) AS BIGINT) AS revision FROM lineitem GROUP BY l_orderkey, l_partkey""",
)
def status_revisions(spark, sf_dir):
    return st.collect_revisions(b.line_references(spark, sf_dir)).drop("flow_id")


LATEST = """
SELECT 'user-' || user_id AS entity_id, CASE WHEN event_type = 'error' THEN 'INVALID' ELSE event_type END AS state,
    event_id AS version, ts
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC, ts DESC) AS rn FROM events) WHERE rn = 1"""


def local_time(df, *columns):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


@check("status_latest", LATEST)
def status_latest(spark, sf_dir):
    return local_time(st.latest_per_entity(b.event_states(spark, sf_dir)), "ts").drop("flow_id")


@check("status_controllable", f"SELECT * FROM ({LATEST}) WHERE lower(state) <> 'invalid'")
def status_controllable(spark, sf_dir):
    latest = st.latest_per_entity(b.event_states(spark, sf_dir))
    return local_time(st.filter_controllable(latest), "ts").drop("flow_id")


@check(
    "status_revision_default",
    """SELECT event_id AS id, CASE WHEN event_type <> 'error' THEN 'user-' || user_id END AS client_id,
        CASE WHEN event_type <> 'error' THEN CAST(event_id AS VARCHAR) END AS version FROM events""",
)
def status_revision_default(spark, sf_dir):
    """Events in error have no revision; they get the empty one."""
    revision = F.struct(F.col("entity_id").alias("client_id"), F.col("version"))
    events = b.event_states(spark, sf_dir).withColumn("revision", F.when(F.col("state") != "INVALID", revision))
    found = st.with_revision(events).select(F.col("version").alias("id"), "revision.*")
    return found.withColumn("version", F.col("version").cast("string"))


# The state that an event of each type asks its user to reach.
ASKED_FOR = {"signup": "PURCHASE", "purchase": "View", "view": "click", "click": "invalid", "INVALID": "SignUp"}

REACHED = """
SELECT 'user-' || c.user_id AS entity_id, c.target_state, c.ts, min(p.ts) AS reached_ts, min(p.ts) IS NOT NULL AS reached
FROM (SELECT *, CASE event_type WHEN 'signup' THEN 'PURCHASE' WHEN 'purchase' THEN 'View' WHEN 'view' THEN 'click'
        WHEN 'click' THEN 'invalid' ELSE 'SignUp' END AS target_state FROM events) c
LEFT JOIN (SELECT user_id, ts, CASE event_type WHEN 'error' THEN 'invalid' ELSE event_type END AS state FROM events) p
    ON p.user_id = c.user_id AND p.state = lower(c.target_state) AND p.ts BETWEEN c.ts AND c.ts + INTERVAL 1 DAY
GROUP BY c.event_id, c.user_id, c.target_state, c.ts"""


def commands_of(events):
    """Every event as a command to reach the state its type asks for."""
    target = F.create_map(*[F.lit(x) for pair in ASKED_FOR.items() for x in pair])[F.col("state")]
    return events.select("flow_id", "entity_id", target.alias("target_state"), "ts")


@check("status_reached", REACHED)
def status_reached(spark, sf_dir):
    events = b.event_states(spark, sf_dir)
    found = st.reached_state(commands_of(events), events, DAY)
    return local_time(found, "ts", "reached_ts").select("entity_id", "target_state", "ts", "reached_ts", "reached")


# -- streams --------------------------------------------------------------------


def event_stream(spark, sf_dir):
    """The events table as a stream of event states."""
    stream = spark.readStream.schema(b.SCHEMAS["events"]).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return stream.select(
        F.lit(b.FLOW).alias("flow_id"), b.named("user", "user_id").alias("entity_id"),
        F.when(F.col("event_type") == "error", "INVALID").otherwise(F.col("event_type")).alias("state"),
        F.col("event_id").alias("version"), F.col("ts").cast("timestamp").alias("ts"),
    )


@check("stream_latest", LATEST)
def stream_latest(spark, sf_dir):
    base = scratch_path(spark, "stream-latest")
    stream_latest_state(event_stream(spark, sf_dir), f"{base}/checkpoint").awaitTermination()
    return local_time(read_latest_state(spark, f"{base}/checkpoint"), "ts").drop("flow_id")


@check(
    "stream_reached",
    f"""SELECT entity_id, target_state, ts, CASE WHEN outcome = 'reached' THEN reached_ts END AS reached_ts, outcome
    FROM (SELECT *, CASE WHEN reached_ts <= passed THEN 'reached'
            WHEN NOT reached AND ts + INTERVAL 1 DAY <= passed THEN 'missed' ELSE 'open' END AS outcome
        FROM ({REACHED}), (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 1 HOUR AS passed FROM events))""",
)
def stream_reached(spark, sf_dir):
    """The events arrive in four files by time, all as commands and statuses; every command is answered or open."""
    base = scratch_path(spark, "stream-reached")
    events = b.event_states(spark, sf_dir)
    cuts = events.select(F.percentile_approx(F.unix_micros("ts"), [0.25, 0.5, 0.75])).first()[0]
    for low, high in zip([None, *cuts], [*cuts, None]):
        after = F.lit(True) if low is None else F.unix_micros("ts") > low
        until = F.lit(True) if high is None else F.unix_micros("ts") <= high
        events.filter(after & until).repartition(1).write.mode("append").parquet(f"{base}/in")
    arriving = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    out, checkpoint = f"{base}/out", f"{base}/checkpoint"
    stream_reached_state(commands_of(arriving), arriving, DAY, 3600, out, checkpoint).awaitTermination()
    found = command_outcomes(commands_of(events), read_reached_state(spark, out), read_open_commands(spark, checkpoint))
    return local_time(found, "ts", "reached_ts").select("entity_id", "target_state", "ts", "reached_ts", "outcome")
