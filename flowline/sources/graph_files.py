"""Lineage graphs as GraphML and GraphSON files.

Every element says itself which flow it belongs to, so a file holds as many
flows as fit and a folder as many files as the graphs need: a GraphML file has
one graph element per flow in it, a flow with more elements than a file has one
in each of several. GraphSON puts a vertex with its edges into one line; a
vertex with very many edges has several. Each file and each line is valid by
itself, and the readers put together what belongs together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowline.operators.keys import group_apart
from flowline.session import cut_lineage
from flowline.sources.documents import BAD, json_lines, line_rejects, readable

# Names under which a vertex's own fields appear among its properties.
OWN_FIELDS = {"isRoot": "is_root", "pgId": "pg_id", "pgName": "pg_name", "procId": "proc_id", "procName": "proc_name"}

# The name under which an element carries its flow.
FLOW_KEY = "__flow_id"

#: Elements of a GraphML file, and edges of a GraphSON line, up to which they are not split.
ELEMENTS_PER_FILE = 100_000
EDGES_PER_LINE = 10_000

_GRAPHML_HEAD = (
    '<?xml version="1.0" encoding="UTF-8"?>'
    '<graphml xmlns="http://graphml.graphdrawing.org/xmlns" xmlns:xsi="http://www.w3.org/2001/XMLSchema-instance" '
    'xsi:schemaLocation="http://graphml.graphdrawing.org/xmlns http://graphml.graphdrawing.org/xmlns/1.1/graphml.xsd">'
)


def _as_vertices(df: DataFrame) -> DataFrame:
    """(flow_id, id, label, all) with one map of all properties -> vertices."""
    own = F.array(*[F.lit(k) for k in (*OWN_FIELDS, FLOW_KEY)])
    fields = {name: F.col("all")[key] for key, name in OWN_FIELDS.items()}
    return df.select(
        "flow_id",
        "id",
        "label",
        fields["is_root"].cast("boolean").alias("is_root"),
        *[c.alias(n) for n, c in fields.items() if n != "is_root"],
        F.when(
            F.col("label") == "processor", F.map_filter("all", lambda k, _: ~F.array_contains(own, k))
        ).alias("properties"),
    )


def _own() -> dict[str, Column]:
    """A vertex's own fields as text, by the name they have in files."""
    return {key: F.col(name).cast("string") for key, name in OWN_FIELDS.items()}


def _extra() -> Column:
    """Entries of the open properties; own names and nulls are left out."""
    own = F.array(*[F.lit(k) for k in (*OWN_FIELDS, FLOW_KEY)])
    kept = F.map_filter("properties", lambda k, v: v.isNotNull() & ~F.array_contains(own, k))
    return F.coalesce(F.map_entries(kept), F.array().cast("array<struct<key:string,value:string>>"))


def _flow(own: Column, flow_id: str | None) -> Column:
    """The flow an element names, or else that of the whole read."""
    return F.coalesce(own, F.lit(flow_id)).alias("flow_id")


# -- GraphML --------------------------------------------------------------------


_DATA = "data array<struct<_VALUE:string,_key:string>>"


def _graphml(spark: SparkSession, path: str, tag: str, ddl: str) -> DataFrame:
    """The elements of a name, ids as text, with their file and the text of what cannot be read."""
    reader = spark.read.format("xml").option("rowTag", tag).option("ignoreSurroundingSpaces", "false")
    found = reader.option("columnNameOfCorruptRecord", BAD).schema(f"{ddl}, {BAD} string").load(path)
    return found.withColumn("path", F.col("_metadata.file_path"))


def _named(elements: DataFrame, names: DataFrame) -> DataFrame:
    """Elements with ``entries``, their data by name, and ``twice``, a name that several of them have."""

    def name(key: Column) -> Column:
        return F.coalesce(F.col("names")[key], key)

    entry = lambda d: F.struct(name(d["_key"]).alias("key"), F.coalesce(d["_VALUE"], F.lit("")).alias("value"))
    # Data without a key is nobody's.
    data = F.filter(F.coalesce("data", F.array().cast("array<struct<_VALUE:string,_key:string>>")), lambda d: d["_key"].isNotNull())
    keys = F.transform("entries", lambda e: e["key"])
    again = F.filter(keys, lambda k, i: F.array_position(keys, k) <= i)
    return elements.join(names, "path", "left").withColumn("entries", F.transform(data, entry)).withColumn("twice", F.get(again, F.lit(0)))


def _nodes(spark: SparkSession, path: str, names: DataFrame) -> DataFrame:
    return _named(_graphml(spark, path, "node", f"_id string, {_DATA}"), names)


def _links(spark: SparkSession, path: str, names: DataFrame) -> DataFrame:
    return _named(_graphml(spark, path, "edge", f"_id string, _source string, _target string, {_DATA}"), names)


def _number(c: str) -> Column:
    return F.expr(f"try_cast({c} AS bigint)")


def _all_numbers(*columns: str) -> Column:
    return F.coalesce(*[F.when(_number(c).isNull(), False) for c in columns], F.lit(True))


def _key_names(spark: SparkSession, path: str) -> DataFrame:
    """(path, names): per file the attribute names of keys whose id is another; a file has few keys.

    Stored, as nodes and edges both ask it: one search of the files for both, and its size tells Spark to broadcast it.
    """
    keys = _graphml(spark, path, "key", "_id string, `_attr.name` string")
    named = keys.select("path", F.col("_id").alias("key"), F.col("`_attr.name`").alias("name"))
    named = named.filter("key is not null and name is not null and key <> name").groupBy("path", "key").agg(F.min("name").alias("name"))
    return cut_lineage(named.groupBy("path").agg(F.map_from_entries(F.collect_list(F.struct("key", "name"))).alias("names")), "key-names")


def read_graphml(spark: SparkSession, path: str, flow_id: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Vertices and edges; values keep their blanks and line breaks.

    ``flow_id`` names the flow of elements that name none themselves. The keys
    of a file give the names of its data. Elements that cannot be read, whose ids
    are not numbers, or with two data of one name, are left out;
    :func:`graphml_rejects` lists them.
    """

    def readable_elements(df: DataFrame, *ids: str) -> DataFrame:
        # The map is made only where no name stands twice, wherever Spark moves the filter to.
        data = F.when(F.col("twice").isNull(), F.map_from_entries("entries"))
        return df.filter(F.col(BAD).isNull() & _all_numbers(*ids) & F.col("twice").isNull()).withColumn("all", data)

    names = _key_names(spark, path)
    nodes = readable_elements(_nodes(spark, path, names), "_id")
    vertices = _as_vertices(
        nodes.select(
            _flow(F.col("all")[FLOW_KEY], flow_id), _number("_id").alias("id"), F.col("all")["labelV"].alias("label"),
            F.map_filter("all", lambda k, _: k != "labelV").alias("all"),
        )
    )
    edges = readable_elements(_links(spark, path, names), "_id", "_source", "_target").select(
        _flow(F.col("all")[FLOW_KEY], flow_id),
        _number("_id").alias("id"),
        _number("_source").alias("src"),
        _number("_target").alias("dst"),
        F.col("all")["labelE"].alias("label"),
    )
    return vertices, edges


def graphml_rejects(spark: SparkSession, path: str) -> DataFrame:
    """(path, reason, element): nodes and edges that were cut, whose ids are not numbers, or with two data of one name."""

    def bad(df: DataFrame, element: str, *ids: str) -> DataFrame:
        listed = F.concat_ws(", ", *ids)
        reason = (
            F.when(F.col(BAD).isNotNull(), F.lit("unreadable element"))
            .when(~_all_numbers(*ids), F.concat(F.lit("ids that are not numbers: "), listed))
            .when(F.col("twice").isNotNull(), F.concat(F.lit("two data of one name: "), "twice"))
        )
        return df.select("path", reason.alias("reason"), F.lit(element).alias("element")).filter("reason IS NOT NULL")

    names = _key_names(spark, path)
    return bad(_nodes(spark, path, names), "node", "_id").unionByName(bad(_links(spark, path, names), "edge", "_id", "_source", "_target"))


def _xml(c: Column) -> Column:
    for raw, escaped in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("\r", "&#13;")):
        c = F.replace(c, F.lit(raw), F.lit(escaped))
    return c


def _datum(key: Column, value: Column) -> Column:
    return F.concat(F.lit('<data key="'), _xml(key), F.lit('">'), _xml(value), F.lit("</data>"))


def _key_line(key: Column, target: str = "node", kind: str = "string") -> Column:
    quoted = _xml(key)
    return F.concat(
        F.lit('<key id="'), quoted, F.lit(f'" for="{target}" attr.name="'), quoted, F.lit(f'" attr.type="{kind}"/>')
    )


def graphml_lines(
    vertices: DataFrame, edges: DataFrame, elements_per_file: int = ELEMENTS_PER_FILE
) -> tuple[DataFrame, int]:
    """The lines of GraphML files as (file, line), a partition per file and its lines in order; and how many files.

    Flows share files. A flow with more than ``elements_per_file`` elements is
    dealt by a hash over several graph elements, so no file holds much more than
    that. Header, keys, graphs and their ends are rows among the elements, which
    the sort of a partition puts in their places.
    """
    counts = vertices.select("flow_id").unionByName(edges.select("flow_id")).groupBy("flow_id").agg(F.count("*").alias("n"))
    spread = F.ceil(F.col("n") / F.lit(elements_per_file)).cast("int")
    per_flow = cut_lineage(counts.select("flow_id", spread.alias("parts"), "n"), "flow-sizes")
    total = per_flow.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    n_files = max(1, -(-total // elements_per_file))
    # The parts of one flow go to different files.
    file = F.pmod(F.xxhash64("flow_id") + F.col("part"), F.lit(n_files)).cast("int").alias("file")

    node = F.concat_ws(
        "",
        F.format_string('<node id="%d">', "id"),
        _datum(F.lit("labelV"), F.col("label")),
        _datum(F.lit(FLOW_KEY), F.col("flow_id")),
        *[_datum(F.lit(key), value) for key, value in _own().items()],
        F.transform("extra", lambda e: _datum(e["key"], e["value"])),
        F.lit("</node>"),
    )
    edge = F.concat_ws(
        "",
        F.format_string('<edge id="%d" source="%d" target="%d">', "id", "src", "dst"),
        _datum(F.lit("labelE"), F.col("label")),
        _datum(F.lit(FLOW_KEY), F.col("flow_id")),
        F.lit("</edge>"),
    )

    def dealt(df: DataFrame, kind: int) -> DataFrame:
        part = F.pmod(F.xxhash64(F.lit(kind), "id"), F.col("parts")).cast("int").alias("part")
        same = df["flow_id"].eqNullSafe(per_flow["flow_id"])
        placed = df.join(per_flow.drop("n"), same).select(*[df[c] for c in df.columns], part)
        return placed.select("*", file, F.lit(2).alias("section"), F.lit(kind).alias("kind"))

    nodes = dealt(vertices.withColumn("extra", _extra()), 1)
    columns = ["file", "section", "flow_id", "part", "kind", "id", "line"]
    lines = nodes.select(*columns[:-1], node.alias("line")).unionByName(dealt(edges, 2).select(*columns[:-1], edge.alias("line")))

    graphs = per_flow.select("flow_id", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    opened = F.concat(F.lit('<graph id="'), _xml(F.coalesce("flow_id", F.lit("G"))), F.lit('" edgedefault="directed">'))
    for kind, line in ((0, opened), (3, F.lit("</graph>"))):
        own = graphs.select(file, F.lit(2).alias("section"), "flow_id", "part", F.lit(kind).alias("kind"), F.lit(0).alias("id"), line.alias("line"))
        lines = lines.unionByName(own)

    def around(df: DataFrame, section: int, line: Column) -> DataFrame:
        nothing = [F.lit(None).cast("string").alias("flow_id"), *[F.lit(0).alias(c) for c in ("part", "kind", "id")]]
        return df.select("file", F.lit(section).alias("section"), *nothing, line.alias("line"))

    used = nodes.select("file", F.explode("extra.key").alias("key")).distinct()
    fixed = [*[(k, "node", "boolean" if k == "isRoot" else "string") for k in OWN_FIELDS], ("labelV", "node", "string")]
    fixed += [("labelE", "edge", "string"), (FLOW_KEY, "all", "string")]
    head = F.concat(F.lit(_GRAPHML_HEAD), *[_key_line(F.lit(key), target, kind) for key, target, kind in fixed])
    files = vertices.sparkSession.range(n_files).select(F.col("id").cast("int").alias("file"))
    lines = lines.unionByName(around(files, 0, head))
    lines = lines.unionByName(around(used, 1, _key_line(F.col("key"))))
    lines = lines.unionByName(around(files, 3, F.lit("</graphml>")))
    ordered = lines.repartitionById(n_files, "file").sortWithinPartitions("section", "flow_id", "part", "kind", "id", "line")
    return ordered.select("file", "line"), n_files


def write_graphml(
    vertices: DataFrame, edges: DataFrame, path: str, elements_per_file: int = ELEMENTS_PER_FILE
) -> None:
    """GraphML files, as many as the graphs need."""
    graphml_lines(vertices, edges, elements_per_file)[0].select("line").write.mode("overwrite").text(path)


# -- GraphSON -------------------------------------------------------------------


_REF = "struct<`@value`:bigint>"
_GRAPHSON_LINE = (
    f"id {_REF}, label string, `{FLOW_KEY}` string, outE map<string,array<struct<id:{_REF},inV:{_REF}>>>, "
    "properties map<string,array<struct<value:string>>>"
)


def graphson_rejects(spark: SparkSession, path: str) -> DataFrame:
    """(path, reason, document) of the lines that cannot be read."""
    return line_rejects(spark, path, _GRAPHSON_LINE)


def read_graphson(spark: SparkSession, path: str, flow_id: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Vertices and edges; ``flow_id`` names the flow of lines that name none themselves.

    :func:`graphson_rejects` lists the lines that cannot be read.
    """
    lines = readable(json_lines(spark, path, _GRAPHSON_LINE))
    lines = lines.select("*", _flow(F.col(FLOW_KEY), flow_id), F.col("id")["@value"].alias("vid"))
    # Only a vertex's first line carries properties; every vertex has some.
    vertices = _as_vertices(
        lines.filter(F.size("properties") > 0).select(
            "flow_id",
            F.col("vid").alias("id"),
            "label",
            F.transform_values("properties", lambda _, v: v[0]["value"]).alias("all"),
        )
    )
    edges = (
        lines.select("flow_id", F.col("vid").alias("src"), F.explode("outE").alias("label", "links"))
        .select("flow_id", "src", "label", F.explode("links").alias("e"))
        .select("flow_id", F.col("e.id.@value").alias("id"), "src", F.col("e.inV.@value").alias("dst"), "label")
    )
    return vertices, edges


def _typed(c: Column) -> Column:
    return F.struct(F.lit("g:Int64").alias("@type"), c.alias("@value"))


def _json_text(c: Column) -> Column:
    """A string as quoted JSON text."""
    listed = F.to_json(F.array(c))
    return F.substring(listed, F.lit(2), F.length(listed) - 2)


def graphson_lines(vertices: DataFrame, edges: DataFrame, edges_per_line: int = EDGES_PER_LINE) -> DataFrame:
    """(flow_id, line): a vertex with its in and out edges on a line.

    A vertex with more than ``edges_per_line`` of them has several lines, over
    which a hash deals them; its properties stand on the first.
    """
    ends = edges.select(
        "flow_id",
        F.col("id").alias("edge_id"),
        "label",
        F.explode(
            F.array(
                F.struct(F.col("src").alias("v"), F.lit("outE").alias("side"), F.col("dst").alias("other")),
                F.struct(F.col("dst").alias("v"), F.lit("inE").alias("side"), F.col("src").alias("other")),
            )
        ).alias("s"),
    ).select("flow_id", F.col("s.v").alias("v"), "s.side", "label", "edge_id", "s.other")
    busy = group_apart(ends, ["flow_id", "v"], F.count("*").alias("n")).filter(F.col("n") > edges_per_line)
    ends = ends.join(busy, ["flow_id", "v"], "left")
    n_lines = F.coalesce(F.ceil(F.col("n") / F.lit(edges_per_line)), F.lit(1))
    chunk = F.pmod(F.xxhash64("edge_id"), n_lines)
    # Hash-partitioned by vertex line first, so that grouping per label and then
    # per line needs no further shuffle.
    links = (
        ends.select("flow_id", F.col("v").alias("id"), chunk.alias("chunk"), "side", "label", "edge_id", "other")
        .repartition("flow_id", "id", "chunk")
        .groupBy("flow_id", "id", "chunk", "side", "label")
        .agg(F.array_sort(F.collect_list(F.struct("edge_id", "other"))).alias("links"))
    )

    def by_label(side: str, end: str) -> Column:
        edge = lambda e: F.struct(_typed(e["edge_id"]).alias("id"), _typed(e["other"]).alias(end))
        entry = F.struct("label", F.transform("links", edge).alias("links"))
        return F.map_from_entries(F.collect_list(F.when(F.col("side") == side, entry))).alias(side)

    adjacency = links.groupBy("flow_id", "id", "chunk").agg(by_label("inE", "outV"), by_label("outE", "inV"))

    def property_json(key: Column, value: Column) -> Column:
        number = F.xxhash64("flow_id", "id", key)
        text = F.when(key == "isRoot", value).otherwise(_json_text(value))
        return F.concat(
            _json_text(key), F.lit(':[{"id":{"@type":"g:Int64","@value":'), number.cast("string"),
            F.lit('},"value":'), text, F.lit("}]"),
        )

    properties = F.concat_ws(
        ",",
        *[property_json(F.lit(key), value) for key, value in _own().items()],
        F.transform("extra", lambda e: property_json(e["key"], e["value"])),
    )
    heads = vertices.withColumn("extra", _extra()).select("flow_id", "id", "label", F.lit(0).cast("bigint").alias("chunk"), properties.alias("props"))
    joined = heads.join(adjacency, ["flow_id", "id", "chunk"], "left").unionByName(
        adjacency.filter("chunk > 0")
        .join(vertices.select("flow_id", "id", "label"), ["flow_id", "id"])
        .withColumn("props", F.lit(None).cast("string")),
    )
    shell = F.to_json(F.struct(_typed(F.col("id")).alias("id"), "label", F.col("flow_id").alias(FLOW_KEY), "inE", "outE"))
    body = F.substring(shell, F.lit(1), F.length(shell) - 1)
    line = F.concat(body, F.coalesce(F.concat(F.lit(',"properties":{'), "props", F.lit("}")), F.lit("")), F.lit("}"))
    return joined.select("flow_id", line.alias("line"))


def write_graphson(
    vertices: DataFrame, edges: DataFrame, path: str, edges_per_line: int = EDGES_PER_LINE, compression: str = "none"
) -> None:
    """GraphSON files; ``compression`` is one of Spark's codecs for text, which the reader tells by the files' names."""
    lines = graphson_lines(vertices, edges, edges_per_line).select("line")
    lines.write.mode("overwrite").option("compression", compression).text(path)
