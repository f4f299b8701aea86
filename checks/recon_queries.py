"""Check queries of reconciliation and configuration checks."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from checks import binding as b
from checks.registry import check
from flowline.operators import quality as q
from flowline.operators import reconcile as r

KIND = """CASE p_type WHEN 'STANDARD' THEN 'processGroup' WHEN 'ECONOMY' THEN 'inputPort' WHEN 'MEDIUM' THEN 'outputPort'
    WHEN 'PROMO' THEN 'processor' WHEN 'LARGE' THEN 'connection' ELSE 'remoteProcessGroup' END"""
LIVE = f"""live AS (
    SELECT p_brand AS flow_id, {KIND} AS kind, 'part-' || p_partkey AS id,
        CASE WHEN p_size % 4 = 0 THEN upper(p_name) ELSE p_name END AS name, p_partkey AS pos FROM part),
template AS (SELECT p_brand AS template, {KIND} AS kind, p_name AS name FROM part)"""


@check("recon_names", f"WITH {LIVE} SELECT DISTINCT template, kind, name FROM template")
def recon_names(spark, sf_dir):
    return r.template_names(b.template_components(spark, sf_dir))


@check(
    "recon_covered",
    f"""WITH {LIVE} SELECT DISTINCT template, flow_id, kind, id, name FROM live JOIN template USING (kind, name)""",
)
def recon_covered(spark, sf_dir):
    found = r.covered_by_template(b.live_components(spark, sf_dir), b.template_components(spark, sf_dir))
    return found.select("template", "flow_id", "kind", "id", "name")


@check(
    "recon_find",
    f"""WITH {LIVE},
    wanted AS (SELECT flow_id, kind, initcap_name AS wanted FROM (SELECT flow_id, kind, upper(name) AS initcap_name FROM live)
        UNION SELECT 'Brand#' || (s_suppkey % 25 + 1), 'processor', s_name FROM supplier),
    hits AS (SELECT w.flow_id, w.kind, w.wanted, min_by(l.id, l.pos) AS id, min_by(l.name, l.pos) AS name
        FROM wanted w LEFT JOIN live l ON l.flow_id = w.flow_id AND l.kind = w.kind AND lower(l.name) = lower(w.wanted)
        GROUP BY ALL),
    firsts AS (SELECT flow_id, kind, min_by(id, pos) AS id, min_by(name, pos) AS name FROM live GROUP BY ALL)
    SELECT FALSE AS fallback, flow_id, kind, wanted, id, name, id IS NOT NULL AS matched FROM hits
    UNION ALL
    SELECT TRUE, h.flow_id, h.kind, h.wanted, coalesce(h.id, f.id), coalesce(h.name, f.name), h.id IS NOT NULL
    FROM hits h LEFT JOIN firsts f USING (flow_id, kind)""",
)
def recon_find(spark, sf_dir):
    live = b.live_components(spark, sf_dir)
    brand = F.concat(F.lit("Brand#"), (F.col("s_suppkey") % 25 + 1).cast("string"))
    names = live.select("flow_id", "kind", F.upper("name").alias("name")).unionByName(
        b.table(spark, sf_dir, "supplier").select(
            brand.alias("flow_id"), F.lit("processor").alias("kind"), F.col("s_name").alias("name")
        )
    )

    def found(fallback):
        return r.find_by_name(live, names, fallback).withColumn("fallback", F.lit(fallback))

    return found(False).unionByName(found(True))


@check(
    "recon_pick_version",
    """WITH v AS (SELECT o_custkey AS flow, CAST(month(o_orderdate) AS INTEGER) AS version, o_orderkey AS pos FROM orders)
    SELECT 'cust-' || flow AS flow, coalesce(min_by(version, pos) FILTER (WHERE version = 6), min_by(version, pos)) AS version,
        coalesce(min(pos) FILTER (WHERE version = 6), min(pos)) AS pos FROM v GROUP BY flow""",
)
def recon_pick_version(spark, sf_dir):
    """Orders as versions of their customer, numbered by month."""
    versions = b.table(spark, sf_dir, "orders").select(
        F.lit("prod").alias("registry"), F.lit("prod").alias("bucket"), b.named("cust", "o_custkey").alias("flow"),
        F.month("o_orderdate").alias("version"), F.col("o_orderkey").alias("pos"),
    )
    return r.pick_version(versions, 6).drop("registry", "bucket")


@check(
    "recon_space_match",
    f"""WITH {LIVE} SELECT flow_id, kind, id, name FROM live
    WHERE lower(regexp_replace(name, '\\s', '', 'g')) IN (
        SELECT lower(replace(p_name, ' ', '')) || CASE WHEN p_size % 5 = 0 THEN '' ELSE p_partkey::VARCHAR END FROM part)""",
)
def recon_space_match(spark, sf_dir):
    other = F.when(F.col("p_size") % 5 == 0, "").otherwise(F.col("p_partkey").cast("string"))
    squeezed = b.table(spark, sf_dir, "part").select(
        F.concat(F.upper(F.replace("p_name", F.lit(" "), F.lit(""))), other).alias("name")
    )
    found = r.match_name_ignoring_space(b.live_components(spark, sf_dir), squeezed)
    return found.select("flow_id", "kind", "id", "name")


@check(
    "recon_template_exists",
    """WITH new AS (SELECT DISTINCT upper(p_name) AS name FROM part WHERE p_type = 'PROMO' UNION SELECT s_name FROM supplier)
    SELECT new.name, min('tpl-' || p_partkey) AS id FROM new LEFT JOIN part ON lower(p_name) = lower(new.name) GROUP BY new.name""",
)
def recon_template_exists(spark, sf_dir):
    parts = b.table(spark, sf_dir, "part")
    live = parts.select(b.named("tpl", "p_partkey").alias("id"), F.col("p_name").alias("name"))
    new = parts.filter("p_type = 'PROMO'").select(F.upper("p_name").alias("name")).unionByName(
        b.table(spark, sf_dir, "supplier").select(F.col("s_name").alias("name"))
    )
    return r.template_exists(live, new)


VARIABLES = """WITH registry AS (
    SELECT 'conv-' || conv_id AS pg_id, 'var_' || turn AS name, text AS value FROM conversations WHERE role = 'user'),
params AS (
    SELECT 'conv-' || conv_id AS pg_id,
        CASE length(text) % 3 WHEN 0 THEN 'var_' || (turn - 1) WHEN 1 THEN 'VAR_' || (turn - 1) ELSE 'new_' || turn END AS name,
        CASE WHEN length(text) % 5 = 0 THEN NULL WHEN length(text) % 7 = 0 THEN '  ' ELSE text END AS value
    FROM conversations WHERE role = 'assistant')
"""


@check(
    "recon_upsert_vars",
    VARIABLES + """SELECT r.pg_id, r.name, coalesce(p.value, r.value) AS value
    FROM registry r LEFT JOIN params p ON p.pg_id = r.pg_id AND p.name = r.name
    UNION ALL
    SELECT pg_id, min(name), min_by(value, name) FROM params p
    WHERE NOT EXISTS (SELECT 1 FROM registry r WHERE r.pg_id = p.pg_id AND lower(r.name) = lower(p.name))
    GROUP BY pg_id, lower(name)""",
)
def recon_upsert_vars(spark, sf_dir):
    return r.upsert_variables(b.variables(spark, sf_dir), b.parameters(spark, sf_dir)).drop("flow_id")


@check(
    "recon_update_vars",
    VARIABLES + """SELECT r.pg_id, r.name, CASE WHEN trim(p.value) <> '' THEN p.value ELSE r.value END AS value
    FROM registry r LEFT JOIN params p ON p.pg_id = r.pg_id AND p.name = r.name""",
)
def recon_update_vars(spark, sf_dir):
    return r.update_variables(b.variables(spark, sf_dir), b.parameters(spark, sf_dir)).drop("flow_id")


STEPS = """steps(mode, kind, step, action, target) AS (VALUES
    ('undeploy', 'processGroup', 11, 'disable', 'controllerService'), ('undeploy', 'processGroup', 12, 'stop', 'processor'),
    ('undeploy', 'processGroup', 13, 'disable', 'remoteProcessGroup'), ('undeploy', 'inputPort', 20, 'stop', 'inputPort'),
    ('undeploy', 'outputPort', 30, 'stop', 'outputPort'), ('undeploy', 'processor', 40, 'stop', 'processor'),
    ('undeploy', 'rootGroup', 45, 'drain', 'connection'), ('undeploy', 'inputPort', 50, 'delete', 'inputPort'),
    ('undeploy', 'outputPort', 60, 'delete', 'outputPort'), ('undeploy', 'processor', 70, 'delete', 'processor'),
    ('undeploy', 'processGroup', 81, 'delete', 'controllerService'), 
    ('undeploy', 'processGroup', 84, 'delete', 'processGroup'),
    ('deploy', 'inputPort', 10, 'start', 'inputPort'), ('deploy', 'outputPort', 20, 'start', 'outputPort'),
    ('deploy', 'processor', 30, 'start', 'processor'), ('deploy', 'processGroup', 41, 'enable', 'controllerService'),
    ('deploy', 'processGroup', 42, 'start', 'processor'), ('deploy', 'processGroup', 43, 'enable', 'remoteProcessGroup'))"""


@check(
    "recon_plan",
    f"""WITH {LIVE}, {STEPS},
    covered AS (SELECT DISTINCT template, flow_id, kind, id, name FROM live JOIN template USING (kind, name)),
    acted AS (SELECT * FROM covered UNION ALL SELECT DISTINCT template, flow_id, 'rootGroup', 'root-' || flow_id, 'root' FROM covered)
    SELECT mode, template, flow_id, step, action, target, kind, id, name,
        row_number() OVER (PARTITION BY mode, template, flow_id ORDER BY step, id) AS place
    FROM acted JOIN steps USING (kind)""",
)
def recon_plan(spark, sf_dir):
    """Plans of all templates; ``place`` is where the ordered plan has the row."""
    live = b.live_components(spark, sf_dir).drop("pos")
    roots = live.select("flow_id").distinct().select(
        "flow_id", F.lit("rootGroup").alias("kind"), F.concat(F.lit("root-"), "flow_id").alias("id"), F.lit("root").alias("name")
    )
    live = live.unionByName(roots)

    def plan(mode):
        ordered = r.action_plan(live, b.template_components(spark, sf_dir), mode)
        numbered = ordered.withColumn("at", F.monotonically_increasing_id())
        place = F.row_number().over(Window.partitionBy("template", "flow_id").orderBy("at")).cast("bigint")
        return numbered.select(F.lit(mode).alias("mode"), *ordered.columns, place.alias("place"))

    return plan("undeploy").unionByName(plan("deploy"))


PERIOD = "'[0-9]+\\s*(ns|nano|nanos|nanosecond|nanoseconds|ms|milli|millis|millisecond|milliseconds|s|sec|secs|second|seconds|m|min|mins|minute|minutes|h|hr|hrs|hour|hours|d|day|days|w|wk|wks|week|weeks)'"
CHECKED = """WITH procs AS (
    SELECT 'cust-' || o_custkey AS flow_id, 'order-' || o_orderkey AS id,
        CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE 'Order#' || o_orderkey END AS name,
        CASE o_orderstatus WHEN 'F' THEN 'RUNNING' WHEN 'O' THEN 'STOPPED' ELSE 'PAUSED' END AS scheduled_state,
        CASE o_orderstatus WHEN 'F' THEN 'TIMER_DRIVEN' WHEN 'O' THEN 'timer' END AS scheduling_strategy,
        CASE WHEN o_orderpriority = '1-URGENT' THEN 'soon' ELSE '30 sec' END AS penalization_period,
        CASE WHEN o_orderpriority <> '2-HIGH' THEN (o_custkey % 60) || 'mins' END AS yield_period,
        CASE WHEN o_orderpriority = '3-MEDIUM' THEN 'LOUD' ELSE 'WARN' END AS bulletin_level,
        CASE o_orderstatus WHEN 'P' THEN 'primary' WHEN 'O' THEN 'PRIMARY' END AS execution_node,
        CAST(CAST(floor(o_totalprice / 1000 - 100) AS BIGINT) AS VARCHAR) AS max_concurrent_tasks,
        CASE WHEN o_orderkey % 7 <> 0 THEN CASE WHEN o_orderstatus = 'P' THEN 'perhaps' ELSE 'false' END END AS loss_tolerant,
        o_orderkey % 11 = 0 AS nameless
    FROM orders),
services AS (
    SELECT 'services' AS flow_id, 'service-' || s_suppkey AS id, CASE WHEN s_suppkey % 4 <> 0 THEN s_name END AS name,
        CASE WHEN s_suppkey % 5 = 0 THEN '' ELSE 'Service' END AS class, CASE WHEN s_suppkey % 6 = 0 THEN 'on' ELSE 'true' END AS enabled,
        s_suppkey % 9 = 0 AS nameless
    FROM supplier),
remotes AS (
    SELECT 'remotes' AS flow_id, 'remote-' || n_nationkey AS id, CASE WHEN n_nationkey % 2 = 0 THEN 'http://host' END AS url,
        CASE WHEN n_nationkey % 3 = 0 THEN '30 sec' END AS timeout,
        CASE n_nationkey % 4 WHEN 0 THEN 'yes' WHEN 1 THEN 'false' END AS transmitting
    FROM nation),
conns AS (
    SELECT 'supp-' || l_suppkey AS flow_id,
        'line-' || concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS id,
        CASE WHEN l_returnflag <> 'N' THEN '' END AS name,
        CASE WHEN l_linenumber = 7 THEN '' ELSE 'cust-' || l_orderkey END AS source_group_id,
        CASE WHEN l_returnflag <> 'A' THEN 'PROCESSOR' END AS destination_type,
        l_returnflag = 'R' AS no_relationship,
        CAST(CAST(l_quantity AS BIGINT) - 3 AS VARCHAR) AS max_work_queue_size,
        CASE l_returnflag WHEN 'R' THEN l_linenumber || ' GB' WHEN 'A' THEN 'plenty' END AS max_work_queue_data_size,
        CASE WHEN l_linestatus = 'F' THEN '0 sec' ELSE 'never' END AS flow_file_expiration,
        l_returnflag = 'R' AND l_linenumber = 7 AND l_quantity > 45 AS balanced,
        l_returnflag = 'R' AND l_linenumber = 6 AND l_quantity > 48 AS partitioned
    FROM lineitem)
"""


def broken(source, rule, value, bad):
    return f"SELECT flow_id, id AS component_id, '{rule}' AS rule, {value} AS value FROM {source} WHERE {bad}"


@check(
    "dq_violations",
    CHECKED
    + " UNION ALL ".join(
        [
            broken("procs", "name_not_empty", "name", "name = ''"),
            broken("procs", "scheduled_state", "scheduled_state", "scheduled_state = 'PAUSED'"),
            broken("procs", "scheduling_strategy", "scheduling_strategy", "scheduling_strategy = 'timer'"),
            broken("procs", "penalization_period", "penalization_period", f"NOT regexp_full_match(penalization_period, {PERIOD})"),
            broken("procs", "yield_period", "yield_period", f"NOT coalesce(regexp_full_match(yield_period, {PERIOD}), FALSE)"),
            broken("procs", "bulletin_level", "bulletin_level", "bulletin_level = 'LOUD'"),
            broken("procs", "execution_node", "execution_node", "execution_node = 'primary'"),
            broken("procs", "max_concurrent_tasks", "max_concurrent_tasks", "CAST(max_concurrent_tasks AS BIGINT) < 0"),
            broken("conns", "name_present", "name", "name IS NULL"),
            broken("conns", "source_group_id_not_empty", "source_group_id", "source_group_id = ''"),
            broken("conns", "destination_type_not_empty", "destination_type", "destination_type IS NULL"),
            broken("conns", "relationship_present", "NULL", "no_relationship"),
            broken("conns", "max_work_queue_size", "max_work_queue_size", "CAST(max_work_queue_size AS BIGINT) < 0"),
            broken("conns", "max_work_queue_data_size", "max_work_queue_data_size", "max_work_queue_data_size = 'plenty'"),
            broken("conns", "flow_file_expiration", "flow_file_expiration", "flow_file_expiration = 'never'"),
            broken("procs", "loss_tolerant", "loss_tolerant", "coalesce(loss_tolerant, 'perhaps') = 'perhaps'"),
            broken("procs", "property_name_not_empty", "NULL", "nameless"),
            broken("services", "name_not_empty", "name", "name IS NULL"),
            broken("services", "class_not_empty", "class", "class = ''"),
            broken("services", "enabled", "enabled", "enabled = 'on'"),
            broken("services", "property_name_not_empty", "NULL", "nameless"),
            broken("remotes", "url_present", "url", "url IS NULL"),
            broken("remotes", "timeout_present", "timeout", "timeout IS NULL"),
            broken("remotes", "transmitting", "transmitting", "coalesce(transmitting, 'yes') = 'yes'"),
        ]
    ),
)
def dq_violations(spark, sf_dir):
    return q.validate_components(b.checked_components(spark, sf_dir))


@check(
    "dq_version",
    CHECKED
    + """SELECT flow_id, bool_or(balanced) AS has_load_balance_strategy, bool_or(partitioned) AS has_partitioning_attribute,
        FALSE AS has_load_balance_compression,
        CASE WHEN bool_or(balanced) OR bool_or(partitioned) THEN '1.8' ELSE '1.7' END AS schema_version
    FROM (SELECT flow_id, balanced, partitioned FROM conns UNION ALL SELECT flow_id, FALSE, FALSE FROM procs
        UNION ALL SELECT flow_id, FALSE, FALSE FROM services UNION ALL SELECT flow_id, FALSE, FALSE FROM remotes) GROUP BY flow_id""",
)
def dq_version(spark, sf_dir):
    return q.schema_version_diff(b.checked_components(spark, sf_dir))
