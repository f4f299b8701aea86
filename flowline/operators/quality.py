"""Checks of flow components against the configuration rules; reported, never fatal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The enumerations and text patterns of the configuration format.
SCHEDULED_STATES = ("DISABLED", "RUNNING", "STOPPED")
LOG_LEVELS = ("TRACE", "DEBUG", "INFO", "WARN", "ERROR", "FATAL", "NONE")
SCHEDULING_STRATEGIES = ("EVENT_DRIVEN", "TIMER_DRIVEN", "PRIMARY_NODE_ONLY", "CRON_DRIVEN")
EXECUTION_NODES = ("ALL", "PRIMARY")
TIME_PERIOD = (
    r"^\d+\s*(ns|nano|nanos|nanosecond|nanoseconds|ms|milli|millis|millisecond|milliseconds"
    r"|s|sec|secs|second|seconds|m|min|mins|minute|minutes|h|hr|hrs|hour|hours"
    r"|d|day|days|w|wk|wks|week|weeks)$"
)
DATA_SIZE = r"^\d+\s*(B|KB|MB|GB|TB|b|kb|mb|gb|tb)$"
COUNT = r"^\+?\d+$"
POSITIVE = r"^\+?0*[1-9]\d*$"

BOOLEAN = r"^\s*(true|false|1|0)\s*$"

NAMED = ("rootGroup", "processGroup", "processor", "inputPort", "outputPort", "controllerService")
PORTS = ("inputPort", "outputPort")


def _present(c: str) -> Column:
    return F.coalesce(F.col(c) != "", F.lit(False))


def _optional(c: str, ok: Column) -> Column:
    return F.col(c).isNull() | ok


def _required(c: str, ok: Column) -> Column:
    return F.col(c).isNotNull() & ok


def _rules() -> list[tuple[str, tuple[str, ...] | None, str, Column]]:
    """(rule name, kinds it applies to, column, condition that must hold)."""
    proc, conn, service, remote = ("processor",), ("connection",), ("controllerService",), ("remoteProcessGroup",)
    nameless = F.coalesce(F.map_contains_key("properties", F.lit("")), F.lit(False))
    root_ports = F.col("kind").isin(*PORTS) & (F.col("group_depth") == 0)
    rules = [
        ("id_not_empty", None, "id", _present("id")),
        ("name_not_empty", NAMED, "name", _present("name")),
        ("name_present", conn + remote, "name", F.col("name").isNotNull()),
        ("class_not_empty", proc + service, "class", _present("class")),
        ("loss_tolerant", proc, "loss_tolerant", _required("loss_tolerant", F.col("loss_tolerant").rlike(BOOLEAN))),
        ("property_name_not_empty", proc + service, "properties", ~nameless),
        ("enabled", service, "enabled", _required("enabled", F.col("enabled").rlike(BOOLEAN))),
        ("url_present", remote, "url", F.col("url").isNotNull()),
        ("timeout_present", remote, "timeout", F.col("timeout").isNotNull()),
        ("transmitting", remote, "transmitting", _required("transmitting", F.col("transmitting").rlike(BOOLEAN))),
        ("scheduled_state", proc + PORTS, "scheduled_state",
         _required("scheduled_state", F.col("scheduled_state").isin(*SCHEDULED_STATES))),
        ("scheduling_strategy", proc, "scheduling_strategy",
         _optional("scheduling_strategy", F.col("scheduling_strategy").isin(*SCHEDULING_STRATEGIES))),
        ("scheduling_period_not_empty", proc, "scheduling_period", _present("scheduling_period")),
        ("penalization_period", proc, "penalization_period",
         _required("penalization_period", F.col("penalization_period").rlike(TIME_PERIOD))),
        ("yield_period", proc, "yield_period", _required("yield_period", F.col("yield_period").rlike(TIME_PERIOD))),
        ("remote_yield_period", remote, "yield_period",
         _optional("yield_period", F.col("yield_period").rlike(TIME_PERIOD))),
        ("bulletin_level", proc, "bulletin_level",
         _required("bulletin_level", F.col("bulletin_level").isin(*LOG_LEVELS))),
        ("execution_node", proc, "execution_node",
         _optional("execution_node", F.col("execution_node").isin(*EXECUTION_NODES))),
        ("max_concurrent_tasks", proc, "max_concurrent_tasks",
         _required("max_concurrent_tasks", F.col("max_concurrent_tasks").rlike(COUNT))),
        ("root_port_concurrent_tasks", PORTS, "max_concurrent_tasks",
         ~root_ports | _required("max_concurrent_tasks", F.col("max_concurrent_tasks").rlike(POSITIVE))),
        ("max_work_queue_size", conn, "max_work_queue_size",
         _required("max_work_queue_size", F.col("max_work_queue_size").rlike(COUNT))),
        ("max_work_queue_data_size", conn, "max_work_queue_data_size",
         _optional("max_work_queue_data_size", F.col("max_work_queue_data_size").rlike(DATA_SIZE))),
        ("flow_file_expiration", conn, "flow_file_expiration",
         _optional("flow_file_expiration", F.col("flow_file_expiration").rlike(TIME_PERIOD))),
        ("relationship_present", conn, "relationships", F.size(F.coalesce("relationships", F.array())) > 0),
    ]
    ends = ("source_id", "source_group_id", "source_type", "destination_id", "destination_group_id", "destination_type")
    return rules + [(f"{c}_not_empty", conn, c, _present(c)) for c in ends]


def validate_components(components: DataFrame) -> DataFrame:
    """(flow_id, component_id, rule, value), one row per broken rule, in a single pass.

    Of every rule that does not hold the number is exploded; name and value are
    looked up for the numbers that are left, so what holds costs its test only.
    All of it stays in generated code, where a lambda over an array would not.
    """
    rules = _rules()
    shown = list(dict.fromkeys(column for _, _, column, _ in rules if column not in ("relationships", "properties")))
    numbers = []
    for number, (_, kinds, _, holds) in enumerate(rules):
        applies = F.lit(True) if kinds is None else F.col("kind").isin(*kinds)
        numbers.append(F.when(applies & ~holds, F.lit(number)))
    found = components.select("flow_id", F.col("id").alias("component_id"), F.array(*shown).alias("shown"), F.explode(F.array(*numbers)).alias("n"))
    # Small lookups keep the generated method at a size the virtual machine compiles.
    rule = F.element_at(F.array(*[F.lit(rule) for rule, _, _, _ in rules]), F.col("n") + 1)
    place = F.array(*[F.lit(shown.index(column) if column in shown else -1) for _, _, column, _ in rules])
    value = F.get("shown", F.element_at(place, F.col("n") + 1))
    return found.filter("n IS NOT NULL").select("flow_id", "component_id", rule.alias("rule"), value.alias("value"))


# Connection fields that came with version 1.8 of the format.
NEW_IN_1_8 = ("load_balance_strategy", "partitioning_attribute", "load_balance_compression")


def schema_version_diff(components: DataFrame) -> DataFrame:
    """Per flow: which of the newer connection fields occur, and the version that implies."""
    connections = F.col("kind") == "connection"
    present = components.groupBy("flow_id").agg(
        *[F.bool_or(connections & F.col(c).isNotNull()).alias(f"has_{c}") for c in NEW_IN_1_8]
    )
    newer = F.col(f"has_{NEW_IN_1_8[0]}")
    for c in NEW_IN_1_8[1:]:
        newer = newer | F.col(f"has_{c}")
    return present.withColumn("schema_version", F.when(newer, "1.8").otherwise("1.7"))
