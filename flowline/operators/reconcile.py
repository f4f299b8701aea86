"""Template versus live components: coverage, lookups, variables, planned actions.

template_components: template, kind, name
live_components:     flow_id, kind, id, name, parent_id
variables:           flow_id, pg_id, name, value
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowline.functions import strip_whitespace
from flowline.operators.keys import distinct_apart, group_apart


def template_names(components: DataFrame) -> DataFrame:
    return components.select("template", "kind", "name").distinct()


def covered_by_template(live: DataFrame, template: DataFrame) -> DataFrame:
    """Live components whose kind and (case-sensitive) name a template holds, and ``template`` that does.

    Any number of templates at once; a component that several hold is there once for each.
    """
    return live.join(distinct_apart(template, "template", "kind", "name"), ["kind", "name"])


def find_by_name(
    live: DataFrame,
    names: DataFrame,
    fallback: bool = False,
    pos: str = "pos",
    by: Sequence[str] = ("flow_id", "kind"),
) -> DataFrame:
    """First live component per wanted name, ignoring case.

    ``names`` holds the ``by`` columns and ``name``. Without a match the first
    component of the same ``by`` values is taken if ``fallback``, else null.
    """
    by = list(by)
    wanted = names.select(*by, F.col("name").alias("wanted"), F.lower("name").alias("name_key")).distinct()
    entry = F.struct("id", "name")
    keyed = live.withColumn("name_key", F.lower("name"))
    by_name = (
        keyed.join(distinct_apart(wanted, *by, "name_key"), [*by, "name_key"], "left_semi")
        .groupBy(*by, "name_key")
        .agg(F.min_by(entry, pos).alias("hit"))
    )
    found = wanted.join(by_name, [*by, "name_key"], "left")
    chosen = F.col("hit")
    if fallback:
        first = group_apart(live, by, F.min_by(entry, pos).alias("first"))
        found = found.join(first, by, "left")
        chosen = F.coalesce("hit", "first")
    return found.select(
        *by, "wanted", chosen["id"].alias("id"), chosen["name"].alias("name"), F.col("hit").isNotNull().alias("matched")
    )


def pick_version(versions: DataFrame, wanted: int, by: Sequence[str] = ("registry", "bucket", "flow")) -> DataFrame:
    """Per flow the first row of the wanted version, else the first row listed."""
    row = F.struct("version", "pos")
    return (
        versions.groupBy(*by)
        .agg(
            F.min_by(row, F.when(F.col("version") == wanted, F.col("pos"))).alias("exact"),
            F.min_by(row, "pos").alias("first"),
        )
        .withColumn("v", F.coalesce("exact", "first"))
        .select(*by, "v.version", "v.pos")
    )


def match_name_ignoring_space(df: DataFrame, wanted: str | DataFrame) -> DataFrame:
    """Rows whose name equals a wanted one apart from whitespace and case."""

    def bare(c: Column) -> Column:
        return F.lower(strip_whitespace(c))

    if isinstance(wanted, str):
        return df.filter(bare(F.col("name")) == bare(F.lit(wanted)))
    keys = distinct_apart(wanted.select(bare(F.col("name")).alias("bare_name")), "bare_name")
    return df.withColumn("bare_name", bare(F.col("name"))).join(keys, "bare_name", "left_semi").drop("bare_name")


def template_exists(live_templates: DataFrame, new_templates: DataFrame) -> DataFrame:
    """Id of the first live template of the same name (any case), else null."""
    live = live_templates.groupBy(F.lower("name").alias("name_key")).agg(F.min("id").alias("id"))
    new = new_templates.select("name").distinct().withColumn("name_key", F.lower("name"))
    return new.join(live, "name_key", "left").select("name", "id")


# -- variables ----------------------------------------------------------------

GROUP = ["flow_id", "pg_id"]


def upsert_variables(registry: DataFrame, params: DataFrame) -> DataFrame:
    """Registry after setting ``params``: names match in any case, values only exactly.

    A parameter spelled differently from the registered name counts as present
    but leaves the value alone; null leaves it alone as well. Parameters without
    any match are added, one per name whatever its case.
    """
    values = params.groupBy(*GROUP, "name").agg(F.max("value").alias("new_value"))
    updated = registry.join(values, [*GROUP, "name"], "left").select(
        *GROUP, "name", F.coalesce("new_value", "value").alias("value")
    )
    known = registry.select(*GROUP, F.lower("name").alias("name_key")).distinct()
    added = (
        params.withColumn("name_key", F.lower("name"))
        .groupBy(*GROUP, "name_key")
        .agg(F.min_by(F.struct("name", "value"), "name").alias("p"))
        .join(known, [*GROUP, "name_key"], "left_anti")
        .select(*GROUP, "p.name", "p.value")
    )
    return updated.unionByName(added)


def update_variables(registry: DataFrame, params: DataFrame) -> DataFrame:
    """Registry after setting non-blank ``params`` on exactly equal names; nothing is added."""
    filled = params.filter(F.col("value").rlike(r"[^\x00-\x20]"))
    values = filled.groupBy(*GROUP, "name").agg(F.max("value").alias("new_value"))
    return registry.join(values, [*GROUP, "name"], "left").select(
        *GROUP, "name", F.coalesce("new_value", "value").alias("value")
    )


# -- action plan --------------------------------------------------------------

# The order in which a template's components are stopped, drained,
# deleted and started: (step, action, what it acts on), by kind of component.
UNDEPLOY_STEPS = {
    "processGroup": [
        (11, "disable", "controllerService"),
        (12, "stop", "processor"),
        (13, "disable", "remoteProcessGroup"),
        (81, "delete", "controllerService"),
        (84, "delete", "processGroup"),
    ],
    "inputPort": [(20, "stop", "inputPort"), (50, "delete", "inputPort")],
    "outputPort": [(30, "stop", "outputPort"), (60, "delete", "outputPort")],
    "processor": [(40, "stop", "processor"), (70, "delete", "processor")],
    "rootGroup": [(45, "drain", "connection")],
}
DEPLOY_STEPS = {
    "inputPort": [(10, "start", "inputPort")],
    "outputPort": [(20, "start", "outputPort")],
    "processor": [(30, "start", "processor")],
    "processGroup": [
        (41, "enable", "controllerService"),
        (42, "start", "processor"),
        (43, "enable", "remoteProcessGroup"),
    ],
}


def action_plan(live: DataFrame, template: DataFrame, mode: str = "undeploy", ordered: bool = True) -> DataFrame:
    """Intended actions on the live components that templates cover, per template; nothing is called.

    Each component is matched once per template and expands into the steps of
    its kind. The root group is not matched by name: its own queues are drained
    for every template that covers something in its flow. For a group the
    ``target`` is the kind of member acted on inside it.
    """
    if mode not in ("undeploy", "deploy"):
        raise ValueError(f"unknown mode {mode!r}")
    steps = UNDEPLOY_STEPS if mode == "undeploy" else DEPLOY_STEPS
    covered = covered_by_template(live.filter(F.col("kind") != "rootGroup"), template)
    if "rootGroup" in steps:
        flows = distinct_apart(covered, "flow_id", "template")
        roots = live.filter(F.col("kind") == "rootGroup").join(flows, "flow_id")
        covered = covered.unionByName(roots.select(covered.columns))
    planned = F.lit(None)
    for kind, entries in steps.items():
        literal = F.array(
            *[
                F.struct(F.lit(s).alias("step"), F.lit(a).alias("action"), F.lit(t).alias("target"))
                for s, a, t in entries
            ]
        )
        planned = F.when(F.col("kind") == kind, literal).otherwise(planned)
    plan = covered.select("template", "flow_id", "kind", "id", "name", F.explode(planned).alias("s")).select(
        "template", "flow_id", "s.step", "s.action", "s.target", "kind", "id", "name"
    )
    return plan.orderBy("template", "flow_id", "step", "id") if ordered else plan
