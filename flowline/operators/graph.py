"""Lineage graph of flows: groups and processors with parent and dependent edges.

vertices: flow_id, id, label, is_root, pg_id, pg_name, proc_id, proc_name, properties
edges:    flow_id, id, src, dst, label

Every question is answered for all requested components at once. Work that is
the same for all processors of a group is done once per group and joined on.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowline.functions import contains_ignore_case, equals_ignore_case
from flowline.operators.keys import group_apart
from flowline.session import cut_lineage
from flowline.sources.flow_xml import cross_group_connections, is_processor

# Vertex and edge labels.
GROUP = "processGroup"
PROCESSOR = "processor"
PARENT = "parent"
DEPENDENT = "dependent"

# Spark prunes row_number() <= n before the shuffle up to this n
# (spark.sql.optimizer.windowGroupLimitThreshold).
PRUNED_RANK_LIMIT = 1000

# -- building ---------------------------------------------------------------


def build_vertices(components: DataFrame, include_root_processors: bool = False) -> DataFrame:
    """Root, groups and processors as vertices; ids follow document order.

    The id is the component's ``seq``, which the reader assigns in document
    order within blocks per kind, so no per-flow numbering pass is needed.
    """
    groups = F.col("kind").isin("rootGroup", GROUP)
    wanted = components.filter(groups | is_processor(include_root_processors))
    only = lambda when, c: F.when(when, F.col(c))
    is_proc = F.col("kind") == PROCESSOR
    return wanted.select(
        "flow_id",
        F.col("seq").alias("id"),
        F.when(is_proc, PROCESSOR).otherwise(GROUP).alias("label"),
        F.when(~is_proc, F.col("kind") == "rootGroup").alias("is_root"),
        only(~is_proc, "id").alias("pg_id"),
        only(~is_proc, "name").alias("pg_name"),
        only(is_proc, "id").alias("proc_id"),
        only(is_proc, "name").alias("proc_name"),
        only(is_proc, "properties").alias("properties"),
    )


def build_edges(components: DataFrame, include_root_processors: bool = False) -> DataFrame:
    """parent edges (group -> child) and dependent edges (source group -> destination group)."""
    groups = components.filter(F.col("kind").isin("rootGroup", GROUP))
    by_id = groups.select("flow_id", F.col("id").alias("group_ref"), F.col("seq").alias("vid"))

    def resolve(df: DataFrame, ref: str, alias: str) -> DataFrame:
        side = by_id.withColumnsRenamed({"group_ref": ref, "vid": alias})
        return df.join(side, ["flow_id", ref])

    children = components.filter((F.col("kind") == GROUP) | is_processor(include_root_processors))
    parent = resolve(
        children.select("flow_id", F.col("seq").alias("id"), F.col("seq").alias("dst"), "parent_group_id"),
        "parent_group_id",
        "src",
    )
    links = cross_group_connections(components).select(
        "flow_id", F.col("seq").alias("id"), "source_group_id", "destination_group_id"
    )
    dependent = resolve(resolve(links, "source_group_id", "src"), "destination_group_id", "dst")
    columns = ["flow_id", "id", "src", "dst"]
    return parent.select(*columns, F.lit(PARENT).alias("label")).unionByName(
        dependent.select(*columns, F.lit(DEPENDENT).alias("label"))
    )


def label_counts(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    def counts(df: DataFrame, element: str) -> DataFrame:
        return df.groupBy("label").agg(F.count("*").alias("n")).select(F.lit(element).alias("element"), "*")

    return counts(vertices, "vertex").unionByName(counts(edges, "edge"))


# -- lists and lookups --------------------------------------------------------


def filter_label(vertices: DataFrame, label: str) -> DataFrame:
    return vertices.filter(F.col("label") == label)


def group_struct(id_col: str = "id") -> Column:
    """The result shape of a group."""
    return F.struct(F.col("is_root"), F.col(id_col).alias("id"), F.col("pg_name"), F.col("pg_id"))


def processor_struct() -> Column:
    """The result shape of a processor found by a list call."""
    return F.struct(F.col("id"), F.col("proc_id"), F.col("proc_name"))


def _first_by_id(df: DataFrame, max_rows: int) -> DataFrame:
    """First rows by id; -1 lists all, 0 and anything below -1 nothing."""
    ordered = df.orderBy("id", "flow_id")
    return ordered if max_rows == -1 else ordered.limit(max(max_rows, 0))


def list_groups(vertices: DataFrame, max_rows: int) -> DataFrame:
    return _first_by_id(
        filter_label(vertices, GROUP).select("flow_id", "is_root", "id", "pg_name", "pg_id"), max_rows
    )


def list_processors(vertices: DataFrame, max_rows: int) -> DataFrame:
    return _first_by_id(
        filter_label(vertices, PROCESSOR).select("flow_id", processor_struct().alias("p")).select("flow_id", "p.*"), max_rows
    )


def groups_by_id(vertices: DataFrame, ids: DataFrame) -> DataFrame:
    """One row per requested (flow_id, pg_id); struct ``pg`` is all null when unknown.

    Of several groups with one id the last by vertex id is taken. The ids are
    compared first, as numbers are hashed; the fields are then looked up.
    """
    wanted = ids.select("flow_id", "pg_id").distinct()
    groups = filter_label(vertices, GROUP).join(wanted, ["flow_id", "pg_id"], "left_semi")
    last = groups.groupBy("flow_id", "pg_id").agg(F.max("id").alias("id"))
    found = groups.select("flow_id", "id", "is_root", "pg_name").join(last, ["flow_id", "id"])
    return wanted.join(found, ["flow_id", "pg_id"], "left").select(
        "flow_id",
        "pg_id",
        F.struct("is_root", "id", "pg_name", F.when(F.col("id").isNotNull(), F.col("pg_id")).alias("pg_id")).alias("pg"),
    )


# -- edges ------------------------------------------------------------------


def attach_endpoints(edges: DataFrame, vertices: DataFrame) -> DataFrame:
    """Edges with the vertices at both ends as structs ``out_vertex`` and ``in_vertex``."""
    vertex = F.struct("id", "label", "is_root", "pg_id", "pg_name", "proc_id", "proc_name")

    def end(key: str, alias: str) -> DataFrame:
        return vertices.select("flow_id", F.col("id").alias(key), vertex.alias(alias))

    return edges.join(end("src", "out_vertex"), ["flow_id", "src"]).join(
        end("dst", "in_vertex"), ["flow_id", "dst"]
    )


def first_edge_per_vertex(edges: DataFrame, label: str, direction: str = "both") -> DataFrame:
    """The lowest-id incident edge of every vertex.

    Aggregates rather than a ranking window: they are combined on the map side,
    so a vertex with very many edges costs one row per task. One per plain
    column, as these are hashed where a struct would be sorted.
    """
    chosen = edges.filter(F.col("label") == label)
    if direction == "both":
        ends = F.explode(F.array("src", "dst"))
    else:
        ends = F.col({"in": "dst", "out": "src"}[direction])
    incident = chosen.select("flow_id", "id", "src", "dst", ends.alias("vertex"))
    return incident.groupBy("flow_id", "vertex").agg(
        F.min("id").alias("id"), F.min_by("src", "id").alias("src"), F.min_by("dst", "id").alias("dst")
    )


def immediate_parent(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """(flow_id, id, parent): the group each vertex hangs under, as a group struct."""
    groups = filter_label(vertices, GROUP).select(
        "flow_id", F.col("id").alias("parent_id"), group_struct().alias("parent")
    )
    first = first_edge_per_vertex(edges, PARENT, "in").select(
        "flow_id", F.col("vertex").alias("id"), F.col("src").alias("parent_id")
    )
    return first.join(groups, ["flow_id", "parent_id"]).select("flow_id", "id", "parent")


def _requested_groups(vertices: DataFrame, ids: DataFrame | None) -> DataFrame:
    groups = filter_label(vertices, GROUP)
    if ids is None:
        return groups
    return groups.join(ids.select("flow_id", "pg_id").distinct(), ["flow_id", "pg_id"], "left_semi")


def _doubled(jump: DataFrame) -> DataFrame:
    """(flow_id, at, pg) of twice as many hops: from each group to where the jump leads from where the jump leads."""
    near = jump.select("flow_id", "at", F.col("pg.id").alias("via"))
    far = jump.select("flow_id", F.col("at").alias("via"), "pg")
    return near.join(far, ["flow_id", "via"]).select("flow_id", "at", "pg")


def _jumps(links: DataFrame, hops: int) -> tuple[list[DataFrame], bool]:
    """Jumps of 1, 2, 4, ... hops along the links, until none is left or ``hops`` are spanned; and whether none is.

    Every second kind is written, so a chain of n groups takes about half the
    logarithm of n rounds, each of them one join of the links that are left.
    """
    found = [links]
    while (1 << len(found)) <= hops:
        jump = _doubled(found[-1])
        if len(found) % 2 == 0:
            jump = cut_lineage(jump, "jumps")
            if jump.isEmpty():
                return found, True
        found.append(jump)
    return found, False


def _climb(start: DataFrame, jumps: Sequence[DataFrame], max_depth: int | None) -> DataFrame:
    """(flow_id, group_id, depth, pg) of each start and all that the jumps can reach from it.

    The widest jumps come first; after each kind a row stands for itself and for
    where it leads, so that every depth, a sum of jumps, comes out once.
    """
    rows = start
    for kind in reversed(range(len(jumps))):
        jump = jumps[kind].select("flow_id", F.col("at").alias("node"), F.col("pg").alias("next"))
        # Groups without such a jump go through; the roots, on which most walks end, have none at all.
        there = F.col("next").isNotNull()
        if max_depth is not None:
            there = there & (F.col("depth") + (1 << kind) <= max_depth)
        after = F.struct((F.col("depth") + (1 << kind)).alias("depth"), F.col("next").alias("pg"))
        both = F.array(F.struct("depth", "pg"), F.when(there, after))
        rows = (
            rows.withColumn("node", F.col("pg.id"))
            .join(jump, ["flow_id", "node"], "left")
            .select("flow_id", "group_id", F.explode(both).alias("step"))
            .filter("step IS NOT NULL")
            .select("flow_id", "group_id", "step.depth", "step.pg")
        )
    return rows


def _around(circle_links: DataFrame) -> DataFrame:
    """(flow_id, at, depth, pg): from each group of a circle once around it, the group itself left out."""
    rows = circle_links.select("flow_id", "at", F.lit(1).alias("depth"), "pg").filter("at <> pg.id")
    steps = circle_links.select("flow_id", F.col("at").alias("node"), F.col("pg").alias("next"))
    parts, last = [], cut_lineage(rows, "circle")
    while not last.isEmpty():
        parts.append(last)
        on = last.withColumn("node", F.col("pg.id")).join(steps, ["flow_id", "node"])
        on = on.filter(F.col("next.id") != F.col("at"))
        last = cut_lineage(on.select("flow_id", "at", (F.col("depth") + 1).alias("depth"), F.col("next").alias("pg")), "circle")
    return reduce(DataFrame.unionByName, parts, last)


def group_ancestors(
    vertices: DataFrame, edges: DataFrame, ids: DataFrame | None = None, max_depth: int = -1
) -> DataFrame:
    """Each group followed by its parents up to the root, or ``max_depth`` hops if that is not -1.

    (flow_id, group_id, depth, pg), depth 0 being the group itself. Jumps of 1,
    2, 4, ... hops are made by joining each kind with itself, so the number of
    rounds grows with the logarithm of the depth; the walks then take each kind
    at most once. The parent's fields travel with the jump, so ancestors are
    never looked up again (all of them converge on a few hot groups near the
    root). Without a limit a group met again ends its walk, so circles end too;
    these are gone around hop by hop, by themselves.
    """
    if max_depth < -1:
        raise ValueError("max_depth must be -1 (no limit) or at least 0")
    start = _requested_groups(vertices, ids).select(
        "flow_id", F.col("id").alias("group_id"), F.lit(0).alias("depth"), group_struct().alias("pg")
    )
    if max_depth == 0:
        return start
    groups = filter_label(vertices, GROUP)
    links = (
        immediate_parent(vertices, edges)
        .join(groups.filter(~F.col("is_root")).select("flow_id", "id"), ["flow_id", "id"], "left_semi")
        .select("flow_id", F.col("id").alias("at"), F.col("parent").alias("pg"))
    )
    if 0 < max_depth < 4:  # two kinds of jumps at most, in one go with the walk
        return _climb(start, _jumps(links, max_depth)[0], max_depth)
    links = cut_lineage(links, "parent-links")
    if max_depth > 0:
        return _climb(start, _jumps(links, max_depth)[0], max_depth)

    jumps, ended = _jumps(links, 2 * links.count())
    if ended or jumps[-1].isEmpty():
        return _climb(start, jumps, None)
    # A jump over more hops than there are groups leads into a circle, and to all groups of it from within.
    circles = cut_lineage(jumps[-1].select("flow_id", F.col("pg.id").alias("at")).distinct(), "circles")
    tails = cut_lineage(links.join(circles, ["flow_id", "at"], "left_anti"), "parent-links")
    climbed = cut_lineage(_climb(start, _jumps(tails, 2 * tails.count())[0], None), "ancestors")
    around = _around(links.join(circles, ["flow_id", "at"], "left_semi"))
    entered = climbed.select("flow_id", "group_id", F.col("depth").alias("before"), F.col("pg.id").alias("at"))
    rest = entered.join(around, ["flow_id", "at"]).select(
        "flow_id", "group_id", (F.col("before") + F.col("depth")).alias("depth"), "pg"
    )
    return climbed.unionByName(rest)


def _first_edges(incident: DataFrame, limit: int) -> DataFrame:
    """The ``limit`` lowest-id incident edges of every vertex; -1 keeps all.

    Up to 1000, Spark prunes each task's rows to the limit before the shuffle.
    Above that, a first pass over salted groups does the same, so a hub's edges
    are never ranked in one task.
    """
    if limit == -1:
        return incident
    order = ["id", "direction"]
    if limit > PRUNED_RANK_LIMIT:
        salted = Window.partitionBy("flow_id", "vertex", "salt").orderBy(*order)
        incident = (
            incident.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(64)))
            .withColumn("rank", F.row_number().over(salted))
            .filter(F.col("rank") <= limit)
            .drop("salt", "rank")
        )
    ranked = F.row_number().over(Window.partitionBy("flow_id", "vertex").orderBy(*order))
    return incident.withColumn("rank", ranked).filter(F.col("rank") <= limit).drop("rank")


def dependents(
    vertices: DataFrame,
    edges: DataFrame,
    ids: DataFrame | None = None,
    limit: int = -1,
    direction: str = "both",
) -> DataFrame:
    """Groups one ``dependent`` hop away: (flow_id, group_id, direction, edge_id, pg).

    The limit counts a group's incident edges of *both* directions in edge-id
    order, before the direction is looked at; -1 lifts it. Neighbours reached
    over several edges are repeated, the group itself is left out.
    """
    if limit < -1:
        raise ValueError("limit must be -1 (all) or at least 0")
    if direction not in ("upstream", "downstream", "both"):
        raise ValueError(f"unknown direction {direction!r}")
    groups = filter_label(vertices, GROUP).select("flow_id", "id", group_struct().alias("pg"))
    links = edges.filter(F.col("label") == DEPENDENT).select("flow_id", "id", "src", "dst")
    out_side = F.struct(
        F.col("src").alias("vertex"), F.col("dst").alias("other"), F.lit("downstream").alias("direction")
    )
    in_side = F.struct(
        F.col("dst").alias("vertex"), F.col("src").alias("other"), F.lit("upstream").alias("direction")
    )
    incident = links.select("flow_id", "id", F.explode(F.array(in_side, out_side)).alias("s")).select(
        "flow_id", "id", "s.*"
    )
    if ids is not None:
        wanted = _requested_groups(vertices, ids).select("flow_id", F.col("id").alias("vertex"))
        incident = incident.join(wanted, ["flow_id", "vertex"], "left_semi")
    incident = _first_edges(incident, limit)
    if direction != "both":
        incident = incident.filter(F.col("direction") == direction)
    me = groups.select("flow_id", F.col("id").alias("vertex"), F.col("pg.pg_id").alias("own_pg_id"))
    other = groups.select("flow_id", F.col("id").alias("other"), "pg")
    return (
        incident.filter(F.col("vertex") != F.col("other"))
        .join(me, ["flow_id", "vertex"])
        .join(other, ["flow_id", "other"])
        .filter(~equals_ignore_case("own_pg_id", "pg.pg_id"))
        .select(
            "flow_id", F.col("vertex").alias("group_id"), "direction", F.col("id").alias("edge_id"), "pg"
        )
    )


def upstream(vertices: DataFrame, edges: DataFrame, ids: DataFrame | None = None, limit: int = -1) -> DataFrame:
    return dependents(vertices, edges, ids, limit, "upstream")


def downstream(vertices: DataFrame, edges: DataFrame, ids: DataFrame | None = None, limit: int = -1) -> DataFrame:
    return dependents(vertices, edges, ids, limit, "downstream")


# -- processor reports ------------------------------------------------------


def _placed_processors(
    vertices: DataFrame, edges: DataFrame, proc_ids: DataFrame | None
) -> tuple[DataFrame, DataFrame | None]:
    """Processors with their parent group, and the groups needed; None means all of both.

    There is one row per processor id: of several vertices with it the last by
    vertex id, under the parent of the first of their parent edges. Requested
    processors are written out once: they decide which groups are walked and are
    then joined with the result.
    """
    procs = filter_label(vertices, PROCESSOR)
    if proc_ids is not None:
        wanted = proc_ids.select("flow_id", "proc_id").distinct()
        procs = procs.join(wanted, ["flow_id", "proc_id"], "left_semi")
    procs = procs.select("flow_id", "id", "proc_id", "proc_name")
    first = first_edge_per_vertex(edges, PARENT, "in").select(
        "flow_id", F.col("vertex").alias("id"), F.col("id").alias("edge_id")
    )
    # Which of an id's vertices is shown, and which one says where it hangs.
    one = (
        procs.select("flow_id", "id", "proc_id")
        .join(first, ["flow_id", "id"], "left")
        .groupBy("flow_id", "proc_id")
        .agg(F.max("id").alias("id"), F.min_by("id", "edge_id").alias("placed_by"))
    )
    parents = immediate_parent(vertices, edges).withColumnRenamed("id", "placed_by")
    placed = (
        one.join(procs.select("flow_id", "id", "proc_name"), ["flow_id", "id"])
        .join(parents, ["flow_id", "placed_by"])
        .select(
            "flow_id", "id", "proc_id", "proc_name", F.col("parent.id").alias("group_id"),
            F.col("parent.pg_id").alias("immediate_parent_pg_id"),
        )
    )
    if proc_ids is None:
        return placed, None
    placed = cut_lineage(placed, "placed-processors")
    return placed, placed.select("flow_id", F.col("immediate_parent_pg_id").alias("pg_id")).distinct()


def _group_lists(
    vertices: DataFrame, edges: DataFrame, groups: DataFrame | None, max_depth: int, max_edges: int, with_dependents: bool
) -> DataFrame:
    """(flow_id, group_id, list, ord, pg): ancestors and neighbours once per group."""
    lists = group_ancestors(vertices, edges, groups, max_depth).select(
        "flow_id", "group_id", F.lit("parents").alias("list"), F.col("depth").cast("bigint").alias("ord"), "pg"
    )
    if with_dependents:
        near = dependents(vertices, edges, groups, max_edges)
        lists = lists.unionByName(
            near.select("flow_id", "group_id", F.col("direction").alias("list"), F.col("edge_id").alias("ord"), "pg")
        )
    return lists


def processor_report(
    vertices: DataFrame,
    edges: DataFrame,
    proc_ids: DataFrame | None = None,
    max_depth: int = -1,
    max_edges: int = -1,
    with_dependents: bool = True,
) -> DataFrame:
    """Parents, upstream and downstream groups of processors, one row per list entry.

    ``max_depth`` bounds the hops to the root and ``max_edges`` the incident
    edges looked at; -1 means no limit in both. ``ord`` orders a list: the depth
    for parents, the edge id for neighbours. Unknown processor ids are absent.
    """
    placed, groups = _placed_processors(vertices, edges, proc_ids)
    lists = _group_lists(vertices, edges, groups, max_depth, max_edges, with_dependents)
    return placed.join(lists, ["flow_id", "group_id"]).drop("group_id")


def nested_processor_report(
    vertices: DataFrame,
    edges: DataFrame,
    proc_ids: DataFrame | None = None,
    max_depth: int = -1,
    max_edges: int = -1,
    with_dependents: bool = True,
) -> DataFrame:
    """The report with one row per processor and its lists as arrays.

    Arrays are built per group. Those of parents are as long as the tree is
    deep; those of neighbours need a limit, ``max_edges``, as one group may have
    any number: without one the row form has to be used.
    """
    if with_dependents and max_edges < 0:
        raise ValueError("neighbours without a limit have no nested form; use processor_report")
    placed, groups = _placed_processors(vertices, edges, proc_ids)
    lists = _group_lists(vertices, edges, groups, max_depth, max_edges, with_dependents)

    def nested(name: str) -> Column:
        entries = F.collect_list(F.when(F.col("list") == name, F.struct("ord", "pg")))
        return F.transform(F.array_sort(entries), lambda e: e["pg"])

    per_group = group_apart(
        lists,
        ["flow_id", "group_id"],
        nested("parents").alias("parent_process_groups"),
        *[
            (nested(d) if with_dependents else F.lit(None).cast(_PG_LIST)).alias(f"{d}_dependent_process_groups")
            for d in ("upstream", "downstream")
        ],
    )
    return placed.join(per_group, ["flow_id", "group_id"]).drop("group_id")


_PG_LIST = "array<struct<is_root:boolean,id:bigint,pg_name:string,pg_id:string>>"


def _values() -> list[Column]:
    return [F.col("proc_id"), F.col("proc_name"), F.map_values("properties")]


def _any_value_contains(text: str, joined: Column) -> Column:
    if "\0" in text:
        values = _values()
        return F.exists(F.flatten(F.array(F.array(*values[:2]), values[2])), lambda v: contains_ignore_case(v, F.lit(text)))
    return contains_ignore_case(joined, F.lit(text))


#: Letters of the pieces by which a table of texts is looked up.
GRAM = 3


def search_properties(vertices: DataFrame, text: str | Sequence[str] | DataFrame) -> DataFrame:
    """Processors with any property value, id or name containing the text, ignoring case.

    Empty text matches all. Several texts are one pass; column ``matched`` tells
    which of them a processor contains. A handful may be given as a list; any
    number as column ``text`` of a DataFrame.
    """
    procs = filter_label(vertices, PROCESSOR)
    # One joined text instead of a lambda per value keeps the test in generated
    # code; the separator cannot occur in the searched text.
    joined = F.concat_ws("\0", *_values())
    if isinstance(text, str):
        return procs.filter(_any_value_contains(text, joined))
    if isinstance(text, DataFrame):
        return _search_table(procs.withColumn("_joined", F.lower(joined)), text)
    procs = procs.withColumn("_joined", joined)
    hits = F.array_compact(F.array(*[F.when(_any_value_contains(t, F.col("_joined")), F.lit(t)) for t in text]))
    return procs.withColumn("matched", F.explode(hits)).drop("_joined")


def _grams(text: str, size: Column | int) -> Column:
    """The different pieces of ``size`` letters of a text."""
    places = F.sequence(F.lit(1), F.greatest(F.length(text) - size + 1, F.lit(1)))
    return F.array_distinct(F.transform(places, lambda at: F.substring(F.col(text), at, F.lit(size) if isinstance(size, int) else size)))


def _search_table(procs: DataFrame, texts: DataFrame) -> DataFrame:
    """Matches of a table of texts, found by the piece of each that the fewest processors have.

    The processors' pieces are counted, each text takes its rarest one, and the
    processors that have this piece are asked for the whole text. So the plan
    does not grow with the texts, and a text meets few processors but its own.
    Shorter texts than GRAM are looked up by all their letters. Null texts match
    nothing, repeated ones once.
    """
    wanted = texts.select(F.col("text").alias("matched")).filter("matched IS NOT NULL").distinct()
    wanted = cut_lineage(wanted.withColumn("_low", F.lower("matched")), "search-texts")
    size = F.least(F.length("_low"), F.lit(GRAM))
    pieces = wanted.filter("_low <> ''").select("matched", "_low", F.explode(_grams("_low", size)).alias("_gram"))
    # Pieces of all sizes that texts have; more than GRAM sizes there cannot be.
    sizes = sorted(r[0] for r in pieces.select(F.length("_gram")).distinct().collect())
    # The empty text is in all of them.
    has_empty = not wanted.filter("_low = ''").isEmpty()
    everything = procs.withColumn("matched", F.lit("")).filter(F.lit(has_empty))
    if not sizes:
        return everything.drop("_joined")
    own = F.explode(F.array_distinct(F.flatten(F.array(*[_grams("_joined", n) for n in sizes])))).alias("_gram")
    known = pieces.select("_gram").distinct()
    counts = procs.select(own).join(known, "_gram", "left_semi").groupBy("_gram").agg(F.count("*").alias("_n"))
    rated = pieces.join(counts, "_gram", "left")
    # A piece that no processor has ends the search for its text.
    rarest = rated.groupBy("matched", "_low").agg(
        F.min_by("_gram", F.struct(F.coalesce("_n", F.lit(0)), "_gram")).alias("_gram"), F.min(F.coalesce("_n", F.lit(0))).alias("_n")
    )
    rarest = cut_lineage(rarest.filter("_n > 0").select("matched", "_low", "_gram"), "search-pieces")
    met = procs.select("*", own).join(rarest, "_gram")
    values = F.flatten(F.array(F.array(*_values()[:2]), F.coalesce(_values()[2], F.array().cast("array<string>"))))
    within = F.exists(values, lambda v: F.contains(F.lower(v), F.col("_low")))
    found = F.contains("_joined", "_low") & F.when(F.contains("_low", F.lit("\0")), F.coalesce(within, F.lit(False))).otherwise(True)
    columns = [c for c in procs.columns if c != "_joined"]
    return met.filter(found).select(*columns, "matched").unionByName(everything.select(*columns, "matched"))


def dedupe_matches(matches: DataFrame) -> DataFrame:
    return matches.dropDuplicates(["flow_id", "proc_id"])


def drop_empty_processors(df: DataFrame) -> DataFrame:
    return df.filter(F.col("id") > 0)


def search_processors(
    vertices: DataFrame,
    edges: DataFrame,
    text: str | DataFrame,
    max_depth: int = -1,
    max_edges: int = -1,
    with_dependents: bool = True,
    nested: bool = False,
) -> DataFrame:
    """Report of every processor matching ``text``, or any of a table of texts; the nested form needs ``max_edges`` for neighbours."""
    matches = dedupe_matches(search_properties(vertices, text).select("flow_id", "proc_id"))
    report = nested_processor_report if nested else processor_report
    return drop_empty_processors(report(vertices, edges, matches, max_depth, max_edges, with_dependents))
