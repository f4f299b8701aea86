"""Status analytics over snapshots of groups, connections, services and remotes.

status: flow_id, entity_id, parent_id, kind, name, state, version, ts, running,
stopped, disabled, invalid, queued_count, active_remote, inactive_remote
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowline.functions import equals_ignore_case, grouped_count, percentage, revision_or_empty
from flowline.operators.graph import search_processors
from flowline.session import cut_lineage

# Fixed value: the share of running processors (percent) up to which a group
# counts as inactive.
INACTIVE_UP_TO = 10.0

ENTITY = ("flow_id", "entity_id")


def latest_per_entity(status: DataFrame, by: Sequence[str] = ENTITY) -> DataFrame:
    """Newest row per entity, by version and then time.

    An aggregate, so all but one row per entity and task go before the shuffle.
    """
    others = [c for c in status.columns if c not in by]
    newest = F.max_by(F.struct(*others), F.struct("version", "ts")).alias("s")
    return status.groupBy(*by).agg(newest).select(*by, "s.*")


# -- activity -----------------------------------------------------------------


def group_activity(status: DataFrame) -> DataFrame:
    """Share of running processors per group; exactly 10 % is still inactive."""
    total = F.col("running") + F.col("stopped") + F.col("disabled") + F.col("invalid")
    return (
        status.withColumn("total", total)
        .withColumn("pct", percentage("running", "total"))
        .withColumn("is_active", (F.col("total") > 0) & (F.col("pct") > INACTIVE_UP_TO))
    )


def filter_active(report: DataFrame, status: DataFrame) -> DataFrame:
    """Report rows whose immediate parent group is active."""
    active = group_activity(status).filter("is_active")
    keys = active.select("flow_id", F.col("entity_id").alias("immediate_parent_pg_id"))
    return report.join(keys, ["flow_id", "immediate_parent_pg_id"], "left_semi")


def active_search(
    vertices: DataFrame,
    edges: DataFrame,
    status: DataFrame,
    text: str,
    max_depth: int = -1,
    max_edges: int = -1,
    with_dependents: bool = True,
    nested: bool = False,
) -> DataFrame:
    found = search_processors(vertices, edges, text, max_depth, max_edges, with_dependents, nested)
    return filter_active(found, status)


def filter_controllable(df: DataFrame, keep_skipped: bool = False) -> DataFrame:
    """Entities that may be started, stopped or enabled: all but those in state INVALID."""
    skipped = F.coalesce(equals_ignore_case("state", F.lit("INVALID")), F.lit(False))
    if keep_skipped:
        return df.withColumn("skipped", skipped)
    return df.filter(~skipped)


# -- queues and remotes -------------------------------------------------------


def queued_totals(connections: DataFrame) -> DataFrame:
    """Queue depth per group, summed over its connections."""
    return connections.groupBy("flow_id", "parent_id").agg(
        F.sum(grouped_count("queued_count")).alias("queued"),
        F.count_if(grouped_count("queued_count") > 0).alias("non_empty"),
    )


def _descend(groups: DataFrame, roots: DataFrame, worth_visiting: Column) -> DataFrame:
    """(flow_id, root_id, entity_id) of each root and the groups visited below it.

    Level by level; a child is visited only where ``worth_visiting`` holds, so
    whatever lies below a pruned child stays out. ``groups`` may be an archive
    of snapshots: a group that moved hangs under every parent it had, and a
    group reached before is not entered again, so circles and repeated rows end.
    The links worth following are written out once, narrow, pruned and distinct,
    and so is each level: read back with its true size, a small frontier is
    broadcast against the links instead of shuffling them.
    """
    children = groups.filter(worth_visiting).select(
        "flow_id", F.col("entity_id").alias("child_id"), F.col("parent_id").alias("entity_id")
    )
    children = cut_lineage(children.distinct(), "descent-links")
    key = ["flow_id", "root_id", "entity_id"]
    frontier = roots.select("flow_id", F.col("entity_id").alias("root_id"), "entity_id").distinct()
    visited = frontier
    while True:
        below = frontier.join(children, ["flow_id", "entity_id"]).select(
            "flow_id", "root_id", F.col("child_id").alias("entity_id")
        )
        frontier = cut_lineage(below.distinct().join(visited, key, "left_anti"), "descent")
        if frontier.isEmpty():
            return visited
        visited = visited.unionByName(frontier)


def connections_to_drain(
    groups: DataFrame, connections: DataFrame, roots: DataFrame, recursive: bool = True
) -> DataFrame:
    """Non-empty connections under each root: (root_id, parent_id, entity_id, queued).

    The recursive form enters only child groups that report a queue; the other
    form looks at the root's own connections.
    """
    if recursive:
        visited = _descend(groups, roots, grouped_count("queued_count") > 0)
    else:
        visited = roots.select("flow_id", F.col("entity_id").alias("root_id"), "entity_id").distinct()
    filled = connections.withColumn("queued", grouped_count("queued_count")).filter(F.col("queued") > 0)
    return filled.select("flow_id", "parent_id", "entity_id", "queued").join(
        visited.select("flow_id", F.col("entity_id").alias("parent_id"), "root_id"), ["flow_id", "parent_id"]
    )


def remote_groups_to_toggle(
    groups: DataFrame, remotes: DataFrame, roots: DataFrame, enable: bool
) -> DataFrame:
    """Remote groups to enable or disable under each root.

    Disabling enters child groups with active remote ports, enabling those with
    inactive ones.
    """
    ports = F.col("inactive_remote" if enable else "active_remote")
    visited = _descend(groups, roots, ports > 0)
    return remotes.select("flow_id", "parent_id", "entity_id").join(
        visited.select("flow_id", F.col("entity_id").alias("parent_id"), "root_id"), ["flow_id", "parent_id"]
    )


# -- convergence --------------------------------------------------------------


def _settled(target_state: str) -> Column:
    """Whether one group is where ``target_state`` wants it; other states ask nothing.

    A count that is not known settles nothing.
    """
    wanted = target_state.upper()
    if wanted == "STOPPED":
        settled = (F.col("running") <= 0) & (grouped_count("queued_count") <= 0)
    elif wanted == "RUNNING":
        settled = F.col("stopped") <= 0
    else:
        return F.lit(True)
    return F.coalesce(settled, F.lit(False))


def children_converged(groups: DataFrame, parents: DataFrame, target_state: str) -> DataFrame:
    """Per parent: have all direct children, and the parent itself, reached the state?

    One row per group is expected; reduce an archive by :func:`latest_per_entity` first.
    """
    children = (
        groups.filter(F.col("parent_id").isNotNull())
        .groupBy("flow_id", F.col("parent_id").alias("entity_id"))
        .agg(F.bool_and(_settled(target_state)).alias("children"))
    )
    own = parents.select("flow_id", "entity_id", _settled(target_state).alias("self"))
    return own.join(children, ["flow_id", "entity_id"], "left").select(
        "flow_id",
        "entity_id",
        F.coalesce("children", F.lit(True)).alias("children_converged"),
        (F.col("self") & F.coalesce("children", F.lit(True))).alias("converged"),
    )


def references_converged(services: DataFrame, service_refs: DataFrame, target_state: str) -> DataFrame:
    """Per service: are all referencing components in the state? True without references."""
    states = service_refs.groupBy("flow_id", "service_id").agg(
        F.bool_and(F.coalesce(equals_ignore_case("state", F.lit(target_state)), F.lit(False))).alias("all_there")
    )
    return services.select("flow_id", "service_id").join(states, ["flow_id", "service_id"], "left").select(
        "flow_id", "service_id", F.coalesce("all_there", F.lit(True)).alias("converged")
    )


def collect_revisions(service_refs: DataFrame) -> DataFrame:
    """Revision per (service, referencing component), newest where repeated.

    Kept as rows: one service may be referenced by very many components.
    """
    return service_refs.groupBy("flow_id", "service_id", "ref_id").agg(F.max("revision").alias("revision"))


def with_revision(entities: DataFrame) -> DataFrame:
    """Entities with a never-null ``revision`` struct (client_id, version)."""
    return entities.withColumn("revision", revision_or_empty("revision"))


# -- bounded wait -------------------------------------------------------------


def reached_state(
    commands: DataFrame, statuses: DataFrame, within_seconds: float, bucket_seconds: int = 60
) -> DataFrame:
    """For every command: first time its entity was in the target state in time.

    commands (flow_id, entity_id, target_state, ts) and statuses (flow_id,
    entity_id, state, ts) give the commands with ``reached_ts`` and ``reached``;
    the window is closed, ``[ts, ts + within_seconds]``.

    No command-status pairs are formed. Only distinct instants matter, so copies
    go before the shuffle, and these are cut into time buckets per entity: a
    running minimum finds the next status inside the bucket, the bucket minima
    tell the first one after it. Whatever share of the rows one entity has, a
    bucket holds no more instants than fit into its seconds, and an entity no
    more buckets than its time span.
    """
    key = ["flow_id", "entity_id", "state_key"]

    def instants(df: DataFrame, state: str, is_command: bool) -> DataFrame:
        return df.select(
            "flow_id", "entity_id", F.lower(state).alias("state_key"), "ts", F.lit(is_command).alias("is_command")
        )

    bucket = F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / F.lit(bucket_seconds))
    events = (
        instants(commands, "target_state", True)
        .unionByName(instants(statuses, "state", False))
        .distinct()
        .withColumn("bucket", bucket)
    )
    status_ts = F.when(~F.col("is_command"), F.col("ts"))
    # Newest first, statuses before commands of the same instant: the last
    # status seen is the earliest one not before the command.
    later = (
        Window.partitionBy(*key, "bucket")
        .orderBy(F.col("ts").desc(), "is_command")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    asked = events.withColumn("in_bucket", F.last(status_ts, ignorenulls=True).over(later)).filter("is_command")
    following = Window.partitionBy(*key).orderBy(F.col("bucket").desc()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    buckets = (
        events.groupBy(*key, "bucket")
        .agg(F.min(status_ts).alias("first_ts"))
        .withColumn("after_bucket", F.last("first_ts", ignorenulls=True).over(following))
        .select(*key, "bucket", "after_bucket")
    )
    answers = asked.join(buckets, [*key, "bucket"]).select(
        *key, "ts", F.coalesce("in_bucket", "after_bucket").alias("next_ts")
    )
    in_time = F.col("next_ts") <= F.col("ts") + F.make_dt_interval(secs=F.lit(within_seconds).cast("decimal(18,6)"))
    asked_for = commands.select("flow_id", "entity_id", "target_state", "ts", F.lower("target_state").alias("state_key"))
    return asked_for.join(answers, [*key, "ts"], "left").select(
        "flow_id",
        "entity_id",
        "target_state",
        "ts",
        F.when(in_time, F.col("next_ts")).alias("reached_ts"),
        F.coalesce(in_time, F.lit(False)).alias("reached"),
    )
