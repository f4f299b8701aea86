"""Check queries of the lineage graph."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import binding as b
from checks.registry import check
from flowline.operators import graph as g
from flowline.operators import status as st
from flowline.plans.flow_graph import store_graph
from flowline.session import scratch_path

# Edges looked at per group in the limited forms.
LIMIT = 10
GROUPS = """
vgroups AS (
    SELECT CAST(0 AS BIGINT) AS id, TRUE AS is_root, 'root' AS pg_id, 'TPCH' AS pg_name, CAST(NULL AS BIGINT) AS parent
    UNION ALL SELECT 1 + r_regionkey, FALSE, 'region-' || r_regionkey, r_name, 0 FROM region
    UNION ALL SELECT 100 + n_nationkey, FALSE, 'nation-' || n_nationkey, n_name, 1 + n_regionkey FROM nation
    UNION ALL SELECT 1000000000000 + c_custkey, FALSE, 'customer-' || c_custkey, c_name, 100 + c_nationkey FROM customer),
vprocs AS (
    SELECT 10000000000000 + o_orderkey AS id, 'order-' || o_orderkey AS proc_id, 'Order#' || o_orderkey AS proc_name,
        1000000000000 + o_custkey AS parent, o_orderstatus AS prop_status, o_orderpriority AS prop_priority,
        CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS prop_total, CAST(NULL AS VARCHAR) AS prop_balance
    FROM orders
    UNION ALL
    SELECT 100000000000000 + s_suppkey, 'supplier-' || s_suppkey, s_name, 100 + s_nationkey, NULL, NULL, NULL,
        CAST(CAST(s_acctbal AS DECIMAL(18,2)) AS VARCHAR)
    FROM supplier)"""
EDGES = """
dep AS (
    SELECT DISTINCT 1000000000000000 + CAST(c_nationkey AS BIGINT) * 100 + s_nationkey AS id,
        CAST(100 + c_nationkey AS BIGINT) AS src, CAST(100 + s_nationkey AS BIGINT) AS dst
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
        JOIN supplier ON l_suppkey = s_suppkey
    WHERE c_nationkey <> s_nationkey),
vedges AS (
    SELECT id, parent AS src, id AS dst, 'parent' AS label FROM vgroups WHERE parent IS NOT NULL
    UNION ALL SELECT id, parent, id, 'parent' FROM vprocs
    UNION ALL SELECT id, src, dst, 'dependent' FROM dep)"""
ANCESTORS = """
anc AS (
    SELECT id AS group_id, CAST(0 AS BIGINT) AS ord, id AS anc, is_root, parent FROM vgroups
    UNION ALL
    SELECT a.group_id, a.ord + 1, p.id, p.is_root, p.parent FROM anc a JOIN vgroups p ON p.id = a.parent
    WHERE NOT a.is_root)"""


def incident(kept: str) -> str:
    """Neighbours and processor reports; ``kept`` says which incident edges count."""
    return f"""
incident AS (
    SELECT src AS vertex, dst AS other, 'downstream' AS direction, id FROM dep
    UNION ALL SELECT dst, src, 'upstream', id FROM dep),
kept AS (
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY vertex ORDER BY id, direction) AS rn FROM incident) WHERE {kept}),
lists AS (
    SELECT group_id, 'parents' AS list, ord, anc AS other FROM anc
    UNION ALL SELECT vertex, direction, id, other FROM kept WHERE vertex <> other),
report AS (
    SELECT p.id, p.proc_id, p.proc_name, o.pg_id AS immediate_parent_pg_id, l.list, l.ord,
        x.is_root AS pg_is_root, x.id AS pg_vertex, x.pg_name, x.pg_id
    FROM vprocs p JOIN vgroups o ON o.id = p.parent JOIN lists l ON l.group_id = p.parent JOIN vgroups x ON x.id = l.other)"""


WITH = "WITH RECURSIVE "
FULL = ",".join([WITH + GROUPS, EDGES, ANCESTORS, incident("TRUE")]) + "\n"
LIMITED = ",".join([WITH + GROUPS, EDGES, ANCESTORS, incident(f"rn <= {LIMIT}")]) + "\n"


def graph(spark, sf_dir):
    parts = b.star_components(spark, sf_dir)
    return g.build_vertices(parts), g.build_edges(parts)


def stored_graph(spark, sf_dir):
    """The graph as stored tables, built and written anew by every query that asks it."""
    return store_graph(*graph(spark, sf_dir), scratch_path(spark, "graph"))


def report_rows(df):
    return df.select(
        "id", "proc_id", "proc_name", "immediate_parent_pg_id", "list", "ord",
        F.col("pg.is_root").alias("pg_is_root"), F.col("pg.id").alias("pg_vertex"),
        F.col("pg.pg_name").alias("pg_name"), F.col("pg.pg_id").alias("pg_id"),
    )


@check(
    "graph_vertices",
    WITH + GROUPS + """
    SELECT id, 'processGroup' AS label, CAST(is_root AS VARCHAR) AS is_root, pg_id, pg_name, NULL AS proc_id, NULL AS proc_name,
        NULL AS prop_status, NULL AS prop_priority, NULL AS prop_total, NULL AS prop_balance FROM vgroups
    UNION ALL
    SELECT id, 'processor', NULL, NULL, NULL, proc_id, proc_name, prop_status, prop_priority, prop_total, prop_balance FROM vprocs""",
)
def graph_vertices(spark, sf_dir):
    vertices, _ = graph(spark, sf_dir)
    return vertices.select(
        "id", "label", F.col("is_root").cast("string").alias("is_root"), "pg_id", "pg_name", "proc_id", "proc_name",
        *[F.col("properties")[p].alias(f"prop_{p}") for p in ("status", "priority", "total", "balance")],
    )


@check("graph_edges", f"{WITH}{GROUPS},{EDGES} SELECT id, src, dst, label FROM vedges")
def graph_edges(spark, sf_dir):
    return graph(spark, sf_dir)[1].drop("flow_id")


@check(
    "graph_label_counts",
    f"""{WITH}{GROUPS},{EDGES}
    SELECT 'vertex' AS element, 'processGroup' AS label, count(*) AS n FROM vgroups
    UNION ALL SELECT 'vertex', 'processor', count(*) FROM vprocs
    UNION ALL SELECT 'edge', label, count(*) FROM vedges GROUP BY label""",
)
def graph_label_counts(spark, sf_dir):
    return g.label_counts(*graph(spark, sf_dir))


@check("graph_store", f"{WITH}{GROUPS},{EDGES} SELECT label, count(*) AS n, CAST(sum(id % 1000) AS BIGINT) AS id_sum FROM vedges GROUP BY label")
def graph_store(spark, sf_dir):
    """Stores the graph anew and reads its edges back."""
    _, edges = store_graph(*graph(spark, sf_dir), scratch_path(spark, "graph"))
    return edges.groupBy("label").agg(F.count("*").alias("n"), F.sum(F.col("id") % 1000).alias("id_sum"))


@check("graph_list_groups", f"{WITH}{GROUPS} SELECT is_root, id, pg_name, pg_id FROM vgroups ORDER BY id LIMIT 100")
def graph_list_groups(spark, sf_dir):
    return g.list_groups(graph(spark, sf_dir)[0], 100).drop("flow_id")


@check("graph_list_processors", f"{WITH}{GROUPS} SELECT id, proc_id, proc_name FROM vprocs ORDER BY id LIMIT 100")
def graph_list_processors(spark, sf_dir):
    return g.list_processors(graph(spark, sf_dir)[0], 100).drop("flow_id")


@check(
    "graph_groups_by_id",
    f"""{WITH}{GROUPS},
    copies AS (
        SELECT id, is_root, pg_id, pg_name FROM vgroups
        UNION ALL SELECT 2000000000000 + o_orderkey, FALSE, 'customer-' || o_custkey, 'copy ' || o_orderkey FROM orders),
    lasts AS (SELECT * FROM copies QUALIFY row_number() OVER (PARTITION BY pg_id ORDER BY id DESC) = 1),
    wanted AS (SELECT DISTINCT 'customer-' || c_custkey AS requested FROM customer
               UNION SELECT 'region-' || s_suppkey FROM supplier)
    SELECT requested, CAST(is_root AS VARCHAR) AS is_root, CAST(id AS VARCHAR) AS id, pg_name, pg_id FROM wanted LEFT JOIN lasts ON pg_id = requested""",
)
def graph_groups_by_id(spark, sf_dir):
    """Every customer group has a copy per order, so any number of groups carry one id."""
    vertices = graph(spark, sf_dir)[0]
    copies = b.table(spark, sf_dir, "orders").select(
        F.lit(b.FLOW).alias("flow_id"), (F.lit(2 * 10**12) + F.col("o_orderkey")).alias("id"), F.lit(g.GROUP).alias("label"),
        F.lit(False).alias("is_root"), b.named("customer", "o_custkey").alias("pg_id"),
        F.concat(F.lit("copy "), F.col("o_orderkey").cast("string")).alias("pg_name"),
    )
    ids = b.table(spark, sf_dir, "customer").select(b.named("customer", "c_custkey").alias("pg_id")).unionByName(
        b.table(spark, sf_dir, "supplier").select(b.named("region", "s_suppkey").alias("pg_id"))
    )
    found = g.groups_by_id(vertices.unionByName(copies, allowMissingColumns=True), ids.withColumn("flow_id", F.lit(b.FLOW)))
    return found.select(
        F.col("pg_id").alias("requested"), F.col("pg.is_root").cast("string").alias("is_root"),
        F.col("pg.id").cast("string").alias("id"), "pg.pg_name", "pg.pg_id",
    )


@check(
    "graph_endpoints",
    f"""{WITH}{GROUPS},{EDGES},
    ends AS (SELECT id, pg_id AS ref, pg_name AS name FROM vgroups UNION ALL SELECT id, proc_id, proc_name FROM vprocs)
    SELECT e.id, e.label, o.ref AS out_ref, o.name AS out_name, i.ref AS in_ref, i.name AS in_name
    FROM vedges e JOIN ends o ON o.id = e.src JOIN ends i ON i.id = e.dst""",
)
def graph_endpoints(spark, sf_dir):
    vertices, edges = graph(spark, sf_dir)
    pick = lambda side, what: F.coalesce(f"{side}_vertex.pg_{what}", f"{side}_vertex.proc_{what}")
    return g.attach_endpoints(edges, vertices).select(
        "id", "label", pick("out", "id").alias("out_ref"), pick("out", "name").alias("out_name"),
        pick("in", "id").alias("in_ref"), pick("in", "name").alias("in_name"),
    )


@check(
    "graph_first_edge",
    f"""{WITH}{GROUPS},{EDGES},
    ends AS (SELECT src AS vertex, id FROM vedges WHERE label = 'parent' UNION ALL SELECT dst, id FROM vedges WHERE label = 'parent')
    SELECT vertex, min(id) AS id FROM ends GROUP BY vertex""",
)
def graph_first_edge(spark, sf_dir):
    return g.first_edge_per_vertex(graph(spark, sf_dir)[1], g.PARENT).select("vertex", "id")


@check(
    "graph_parent",
    f"""{WITH}{GROUPS}
    SELECT c.id, p.id AS parent_vertex, p.pg_id AS parent_pg_id, p.is_root AS parent_is_root
    FROM (SELECT id, parent FROM vgroups UNION ALL SELECT id, parent FROM vprocs) c JOIN vgroups p ON p.id = c.parent""",
)
def graph_parent(spark, sf_dir):
    return g.immediate_parent(*graph(spark, sf_dir)).select(
        "id", F.col("parent.id").alias("parent_vertex"), F.col("parent.pg_id").alias("parent_pg_id"),
        F.col("parent.is_root").alias("parent_is_root"),
    )


@check(
    "graph_ancestors",
    f"""{WITH}{GROUPS},{ANCESTORS}
    SELECT a.group_id, a.ord AS depth, x.id AS vertex, x.pg_id, x.pg_name, x.is_root FROM anc a JOIN vgroups x ON x.id = a.anc""",
)
def graph_ancestors(spark, sf_dir):
    found = g.group_ancestors(*graph(spark, sf_dir))
    return found.select(
        "group_id", F.col("depth").cast("bigint").alias("depth"), F.col("pg.id").alias("vertex"),
        F.col("pg.pg_id").alias("pg_id"), F.col("pg.pg_name").alias("pg_name"), F.col("pg.is_root").alias("is_root"),
    )


def neighbours(df):
    return df.select("group_id", "edge_id", F.col("pg.id").alias("vertex"), F.col("pg.pg_id").alias("pg_id"))


def neighbour_sql(direction, source=FULL):
    return source + f"""SELECT k.vertex AS group_id, k.id AS edge_id, x.id AS vertex, x.pg_id
    FROM kept k JOIN vgroups x ON x.id = k.other WHERE k.direction = '{direction}' AND k.vertex <> k.other"""


@check("graph_upstream", neighbour_sql("upstream"))
def graph_upstream(spark, sf_dir):
    return neighbours(g.upstream(*stored_graph(spark, sf_dir)))


@check("graph_downstream", neighbour_sql("downstream"))
def graph_downstream(spark, sf_dir):
    return neighbours(g.downstream(*stored_graph(spark, sf_dir)))


@check("graph_downstream_limited", neighbour_sql("downstream", LIMITED))
def graph_downstream_limited(spark, sf_dir):
    return neighbours(g.downstream(*stored_graph(spark, sf_dir), limit=LIMIT))


@check("graph_processor_report", FULL + "SELECT * FROM report")
def graph_processor_report(spark, sf_dir):
    return report_rows(g.processor_report(*stored_graph(spark, sf_dir)))


@check(
    "graph_processor_nested",
    LIMITED + """SELECT id, proc_id, proc_name, immediate_parent_pg_id,
        string_agg(pg_id, '>' ORDER BY ord) FILTER (WHERE list = 'parents') AS parents,
        coalesce(string_agg(pg_id, '>' ORDER BY ord) FILTER (WHERE list = 'upstream'), '') AS upstream,
        coalesce(string_agg(pg_id, '>' ORDER BY ord) FILTER (WHERE list = 'downstream'), '') AS downstream
    FROM report GROUP BY ALL""",
)
def graph_processor_nested(spark, sf_dir):
    path = lambda c: F.concat_ws(">", F.col(c)["pg_id"])
    return g.nested_processor_report(*stored_graph(spark, sf_dir), max_edges=LIMIT).select(
        "id", "proc_id", "proc_name", "immediate_parent_pg_id",
        path("parent_process_groups").alias("parents"),
        path("upstream_dependent_process_groups").alias("upstream"),
        path("downstream_dependent_process_groups").alias("downstream"),
    )


MATCHES = "lower(concat_ws(chr(1), proc_id, proc_name, prop_status, prop_priority, prop_total, prop_balance))"


@check("graph_search", FULL + f"SELECT * FROM report WHERE id IN (SELECT id FROM vprocs WHERE contains({MATCHES}, 'urgent'))")
def graph_search(spark, sf_dir):
    return report_rows(g.search_processors(*stored_graph(spark, sf_dir), text="URGENT"))


@check(
    "graph_search_many",
    WITH + GROUPS + f"""SELECT p.id, p.proc_id, t.text AS matched FROM vprocs p
    JOIN (VALUES ('Low'), ('supplier#'), ('99.9')) t(text) ON contains({MATCHES}, lower(t.text))""",
)
def graph_search_many(spark, sf_dir):
    hits = g.search_properties(graph(spark, sf_dir)[0], ["Low", "supplier#", "99.9"])
    return hits.select("id", "proc_id", "matched")


@check(
    "graph_search_table",
    WITH + GROUPS + f"""SELECT p.id, p.proc_id, t.text AS matched FROM vprocs p
    JOIN (SELECT DISTINCT p_type || ' ' || substr(p_brand, 1, 5) AS text FROM part UNION SELECT c_mktsegment FROM customer
        UNION SELECT substr(o_orderpriority, 1, 3) FROM orders UNION SELECT 'order#' || (s_suppkey * 7) FROM supplier) t
    ON contains({MATCHES}, lower(t.text))""",
)
def graph_search_table(spark, sf_dir):
    """Texts from four tables, some of which occur often, some once and some nowhere."""
    text = lambda name, column: b.table(spark, sf_dir, name).select(column.alias("text"))
    texts = text("part", F.concat_ws(" ", "p_type", F.substring("p_brand", 1, 5)))
    texts = texts.union(text("customer", F.col("c_mktsegment"))).union(text("orders", F.substring("o_orderpriority", 1, 3)))
    texts = texts.union(text("supplier", F.concat(F.lit("order#"), F.col("s_suppkey") * 7)))
    return g.search_properties(graph(spark, sf_dir)[0], texts).select("id", "proc_id", "matched")


@check(
    "graph_search_documents",
    """SELECT doc_id AS id, 'doc-' || doc_id AS proc_id FROM documents
    WHERE doc_id > 0 AND contains(lower(concat_ws(chr(1), 'doc-' || doc_id, source, text, lang)), 'then')""",
)
def graph_search_documents(spark, sf_dir):
    """Whole document texts as processor properties."""
    documents = b.table(spark, sf_dir, "documents").select(
        F.col("lang").alias("flow_id"), F.col("doc_id").alias("id"), F.lit(g.PROCESSOR).alias("label"),
        b.named("doc", "doc_id").alias("proc_id"), F.col("source").alias("proc_name"),
        F.create_map(F.lit("text"), "text", F.lit("lang"), "lang").alias("properties"),
    )
    hits = g.drop_empty_processors(g.dedupe_matches(g.search_properties(documents, "THEN")))
    return hits.select("id", "proc_id")


@check(
    "status_active_processors",
    FULL + f""", activity AS (
        SELECT 'customer-' || c_custkey AS entity, count(o_orderkey) AS total,
            count(o_orderkey) FILTER (WHERE o_orderstatus = 'F') AS running
        FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1)
    SELECT r.* FROM report r JOIN activity a ON a.entity = r.immediate_parent_pg_id
    WHERE r.id IN (SELECT id FROM vprocs WHERE contains({MATCHES}, 'urgent'))
        AND total > 0 AND running * CAST(100 AS DOUBLE) / total > 10""",
)
def status_active_processors(spark, sf_dir):
    status = b.group_status(spark, sf_dir)
    found = st.active_search(*stored_graph(spark, sf_dir), status, "urgent")
    return report_rows(found)
