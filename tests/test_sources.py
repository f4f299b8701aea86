import gzip
import json
import xml.etree.ElementTree as ET

import pytest
from pyspark.sql import functions as F

from flowline.operators.graph import build_edges, build_vertices
from flowline.plans.flow_graph import build_flow_graph
from flowline.sources import documents as docs
from flowline.sources import flow_xml as fx
from flowline.sources import graph_files as gf

FLOW = """<?xml version="1.0"?>
<flowController><maxThreadCount>1</maxThreadCount>
<rootGroup encoding-version="1.3"><id>R</id><name>Root</name>
  <processor><id>p0</id><name>at the root</name></processor>
  <inputPort><id>ip</id><name>in</name><scheduledState>RUNNING</scheduledState><maxConcurrentTasks>1</maxConcurrentTasks></inputPort>
  <outputPort><id>op</id><name>out</name><scheduledState>STOPPED</scheduledState><maxConcurrentTasks>1</maxConcurrentTasks></outputPort>
  <processGroup><id>g1</id><name>One &amp; only</name>
    <processor><id>p1</id><name>first</name><class>x.Y</class><penalizationPeriod>soon</penalizationPeriod>
      <property><name>text</name><value>  two
lines  </value></property><property><name>unset</name></property></processor>
    <inputPort><id>ip1</id><name>inner in</name></inputPort>
    <processGroup><id>g2</id><name>Two</name>
      <processor><id>p2</id><name>second</name></processor>
      <processGroup><id>g3</id><name>Three</name></processGroup>
    </processGroup>
    <connection><id>same</id><name/><sourceGroupId>g1</sourceGroupId><destinationGroupId>G1</destinationGroupId></connection>
    <connection><id>cross</id><name/><sourceGroupId>g1</sourceGroupId><destinationGroupId>g2</destinationGroupId>
      <relationship>ok</relationship><relationship>failed</relationship></connection>
  </processGroup>
  <connection><id>top</id><name/><sourceGroupId>R</sourceGroupId><destinationGroupId>g1</destinationGroupId></connection>
</rootGroup></flowController>"""


@pytest.fixture(scope="module")
def archive(tmp_path_factory):
    """Flow files: a good one (gzip), one in a namespace (plain), and broken ones."""
    path = tmp_path_factory.mktemp("flows")
    packed = gzip.compress(FLOW.encode())
    (path / "good.xml.gz").write_bytes(packed)
    (path / "plain.xml").write_text(FLOW.replace("<flowController>", '<flowController xmlns="urn:x">'))
    (path / "zero.xml.gz").write_bytes(b"")
    (path / "empty.xml.gz").write_bytes(gzip.compress(b""))
    (path / "cut.xml.gz").write_bytes(packed[:200])
    (path / "rootless.xml").write_text("<flowController/>")
    (path / "nameless.xml").write_text("<flowController><rootGroup><id>x</id></rootGroup></flowController>")
    (path / "broken.xml").write_text(FLOW[:500])
    return str(path)


@pytest.fixture(scope="module")
def parsed(spark, archive):
    name = F.element_at(F.split("path", "/"), -1)
    return fx.read_flow_configs(spark, archive, name).persist()


def test_rejects_give_a_reason(parsed):
    """A file of no bytes at all is not even scanned; it yields nothing."""
    reasons = {r.path.rsplit("/", 1)[-1]: r.reason for r in fx.rejects(parsed).collect()}
    assert reasons == {
        "empty.xml.gz": "empty file",
        "cut.xml.gz": "unreadable: EOFError",
        "rootless.xml": "no rootGroup",
        "nameless.xml": "rootGroup without name",
        "broken.xml": "unreadable: ParseError",
    }


@pytest.fixture(scope="module")
def parts(parsed):
    return fx.components(parsed).filter("flow_id = 'good.xml.gz'")


def test_namespaces_make_no_difference(parsed, rows):
    columns = ["seq", "kind", "id", "name", "parent_group_id"]
    both = [rows(fx.components(parsed).filter(F.col("flow_id") == f), *columns) for f in ("good.xml.gz", "plain.xml")]
    assert both[0] == both[1] and len(both[0]) == 13


def test_groups(parts, rows):
    assert rows(fx.flatten_groups(parts), "id", "name", "parent_group_id", "kind") == [
        ("R", "Root", None, "rootGroup"),
        ("g1", "One & only", "R", "processGroup"),
        ("g2", "Two", "g1", "processGroup"),
        ("g3", "Three", "g2", "processGroup"),
    ]
    assert rows(parts.filter("kind = 'rootGroup'"), "encoding_version") == [("1.3",)]


def test_processors(parts, rows):
    assert rows(fx.processors(parts), "id", "parent_group_id") == [("p1", "g1"), ("p2", "g2")]
    assert rows(fx.processors(parts, include_root_processors=True), "id") == [("p0",), ("p1",), ("p2",)]
    first = parts.filter("id = 'p1'").first()
    assert first.properties == {"text": "  two\nlines  ", "unset": None}
    assert (first["class"], first.penalization_period, first.yield_period) == ("x.Y", "soon", None)


def test_connections(parts, rows):
    assert rows(fx.cross_group_connections(parts), "id", "relationships") == [("cross", ["ok", "failed"]), ("top", None)]


def test_root_ports(parts, rows):
    assert rows(fx.root_ports(parts), "id", "type") == [("ip", "inputPort"), ("op", "outputPort")]


def test_ids_follow_document_order(parts):
    vertices = [(r.pg_id or r.proc_id) for r in build_vertices(parts).orderBy("id").collect()]
    assert vertices == ["R", "g1", "g2", "g3", "p1", "p2"]
    edges = build_edges(parts).orderBy("id").collect()
    assert [e.label for e in edges] == ["parent"] * 5 + ["dependent"] * 2


VERTICES = """flow_id string, id bigint, label string, is_root boolean, pg_id string, pg_name string, proc_id string,
    proc_name string, properties map<string,string>"""
EDGES = "flow_id string, id bigint, src bigint, dst bigint, label string"


def graph_rows(rows, vertices, edges):
    flat = vertices.withColumn("properties", F.to_json(F.map_from_entries(F.array_sort(F.map_entries("properties")))))
    return rows(flat, *sorted(flat.columns)), rows(edges, *sorted(edges.columns))


def with_values(vertices):
    """Properties without a value are not part of the exchange formats."""
    kept = F.map_filter("properties", lambda _, v: v.isNotNull())
    return vertices.withColumn("properties", F.when(F.col("label") == "processor", kept))


def test_archive_to_graph_and_back(spark, archive, rows, tmp_path):
    name = F.element_at(F.split("path", "/"), -1)
    vertices, edges = build_flow_graph(spark, f"{archive}/*.xml*", str(tmp_path), name, exchange_formats=True)
    assert (vertices.count(), edges.count()) == (12, 14)
    expected = graph_rows(rows, with_values(vertices), edges)
    assert graph_rows(rows, *gf.read_graphml(spark, f"{tmp_path}/graphml")) == expected
    assert graph_rows(rows, *gf.read_graphson(spark, f"{tmp_path}/graphson")) == expected


def test_large_units_are_split_and_put_together(spark, rows, tmp_path):
    """A hub with many edges, and documents and lines far smaller than the graph."""
    n = 60
    vertices = spark.range(n).selectExpr(
        "'f' flow_id", "id", "if(id < 2, 'processGroup', 'processor') label", "if(id < 2, id = 0, null) is_root",
        "if(id < 2, concat('g', id), null) pg_id", "if(id < 2, concat('say \"<', id, '>\" & go'), null) pg_name",
        "if(id < 2, null, concat('p', id)) proc_id", "if(id < 2, null, 'proc') proc_name",
        "if(id < 2, null, map('k \"1\"', concat('v', id), 'empty', '')) properties",
    )
    edges = spark.range(1, n).selectExpr("'f' flow_id", "id", "0L src", "id dst", "'parent' label").unionByName(
        spark.range(2).selectExpr("'f' flow_id", "id + 100 id", "id src", "1 - id dst", "'dependent' label")
    )
    lines = gf.graphson_lines(vertices, edges, edges_per_line=10)
    found = [json.loads(r.line) for r in lines.collect()]
    hub = [line for line in found if line["id"]["@value"] == 0]
    assert len(hub) > 3 and sum("properties" in h for h in hub) == 1 and len(found) == n - 1 + len(hub)
    assert sum(len(e) for h in hub for e in h["outE"].values()) == n
    gf.write_graphml(vertices, edges, f"{tmp_path}/ml", elements_per_file=25)
    gf.write_graphson(vertices, edges, f"{tmp_path}/json", edges_per_line=10)
    assert len(list((tmp_path / "ml").glob("part-*"))) == 5  # 121 elements
    expected = graph_rows(rows, vertices, edges)
    assert graph_rows(rows, *gf.read_graphml(spark, f"{tmp_path}/ml")) == expected
    assert graph_rows(rows, *gf.read_graphson(spark, f"{tmp_path}/json")) == expected


def test_many_flows_share_files_that_are_valid_by_themselves(spark, rows, tmp_path):
    """200 small flows, a large one and a middling one; clashing property names."""
    vertices = spark.range(2000).selectExpr(
        "case when id < 1000 then concat('flow <', id % 200, '>') when id < 1900 then 'large' else 'rest' end flow_id", "id", "'processor' label",
        "cast(null as boolean) is_root", "cast(null as string) pg_id", "cast(null as string) pg_name", "concat('p', id) proc_id",
        "'n' proc_name", "map('__flow_id', 'other', concat('k', id % 7), 'v') properties",
    )
    edges = vertices.selectExpr("flow_id", "id + 5000 id", "id src", "id dst", "'dependent' label")
    gf.write_graphml(vertices, edges, f"{tmp_path}/ml", elements_per_file=500)
    gf.write_graphson(vertices, edges, f"{tmp_path}/json")
    files = list((tmp_path / "ml").glob("part-*"))
    assert len(files) == 8 and not [d for d in (tmp_path / "ml").iterdir() if d.is_dir()]
    assert not [d for d in (tmp_path / "json").iterdir() if d.is_dir()]
    sizes, ns = [], "{http://graphml.graphdrawing.org/xmlns}"
    for file in files:
        root = ET.parse(file).getroot()
        sizes.append(len(list(root.iter(f"{ns}node"))) + len(list(root.iter(f"{ns}edge"))))
        used = {d.get("key") for d in root.iter(f"{ns}data")}
        assert used <= {k.get("id") for k in root.findall(f"{ns}key")}
        assert [e.tag.removeprefix(ns) for e in root] == sorted([e.tag.removeprefix(ns) for e in root], reverse=True)  # keys, graphs
        for graph in root.findall(f"{ns}graph"):
            own = {d.text for d in graph.iter(f"{ns}data") if d.get("key") == gf.FLOW_KEY}
            assert own <= {graph.get("id")}
            assert [int(n.get("id")) for n in graph.findall(f"{ns}node")] == sorted(int(n.get("id")) for n in graph.findall(f"{ns}node"))
    assert sum(sizes) == 4000 and max(sizes) < 1200
    kept = vertices.withColumn("properties", F.map_filter("properties", lambda k, _: k != gf.FLOW_KEY))
    expected = graph_rows(rows, kept, edges)
    assert graph_rows(rows, *gf.read_graphml(spark, f"{tmp_path}/ml")) == expected
    assert graph_rows(rows, *gf.read_graphson(spark, f"{tmp_path}/json")) == expected


def test_an_empty_graph_is_one_empty_file(spark, tmp_path):
    vertices, edges = (spark.createDataFrame([], schema) for schema in (VERTICES, EDGES))
    gf.write_graphml(vertices, edges, f"{tmp_path}/ml")
    assert [ET.parse(f).getroot().tag[-7:] for f in (tmp_path / "ml").glob("part-*")] == ["graphml"]
    assert all(df.isEmpty() for df in gf.read_graphml(spark, f"{tmp_path}/ml"))


def test_one_name_twice_is_a_reject(spark, rows, tmp_path):
    (tmp_path / "a.graphml").write_text(
        '<graphml><key id="d9" for="node" attr.name="procId"/><graph>'
        '<node id="1"><data key="labelV">processor</data><data key="a">1</data><data key="a">2</data></node>'
        '<node id="2"><data key="labelV">processor</data><data key="d9">p</data><data key="procId">q</data></node>'
        '<node id="3"><data key="labelV">processor</data><data key="procId">r</data><data>x</data></node>'
        '<edge id="4" source="1" target="1"><data key="labelE">x</data><data key="labelE">x</data></edge>'
        '<edge id="5" source="1" target="1"><data key="labelE">parent</data></edge></graph></graphml>'
    )
    vertices, edges = gf.read_graphml(spark, str(tmp_path), "f")
    assert rows(vertices, "id", "proc_id", "flow_id") == [(3, "r", "f")] and rows(edges, "id") == [(5,)]
    assert rows(vertices.filter("label = 'processor'"), "id") == [(3,)]
    assert rows(gf.graphml_rejects(spark, str(tmp_path)), "reason", "element") == [
        ("two data of one name: a", "node"), ("two data of one name: labelE", "edge"), ("two data of one name: procId", "node"),
    ]


def test_single_graph_files(spark, rows, tmp_path):
    ml, js = tmp_path / "g.graphml", tmp_path / "g.json"
    ml.write_text(
        '<?xml version="1.0"?><graphml><key id="a" for="node"/><graph id="G" edgedefault="directed">'
        '<node id="0"><data key="labelV">processGroup</data><data key="isRoot">true</data><data key="pgId">r</data>'
        '<data key="pgName">Root</data></node><node id="7"><data key="labelV">processor</data><data key="procId">p</data>'
        '<data key="procName">P</data><data key="a"> x\n&lt;y </data></node>'
        '<edge id="9" source="0" target="7"><data key="labelE">parent</data></edge></graph></graphml>'
    )
    ref = lambda n: {"@type": "g:Int64", "@value": n}
    prop = lambda v: [{"id": ref(1), "value": v}]
    js.write_text(
        "\n".join(
            json.dumps(line)
            for line in (
                {"id": ref(0), "label": "processGroup", "outE": {"parent": [{"id": ref(9), "inV": ref(7)}]},
                 "properties": {"isRoot": prop(True), "pgId": prop("r"), "pgName": prop("Root")}},
                {"id": ref(7), "label": "processor", "inE": {"parent": [{"id": ref(9), "outV": ref(0)}]},
                 "properties": {"procId": prop("p"), "procName": prop("P"), "a": prop(" x\n<y ")}},
            )
        )
    )
    from_ml = graph_rows(rows, *gf.read_graphml(spark, str(ml), "f"))
    assert from_ml == graph_rows(rows, *gf.read_graphson(spark, str(js), "f"))
    assert from_ml[1] == [(7, "f", 9, "parent", 0)]


def test_empty_graph_file(spark, tmp_path):
    path = tmp_path / "none.graphml"
    path.write_text('<graphml><key id="labelV" for="node"/><graph id="G" edgedefault="directed"></graph></graphml>')
    vertices, edges = gf.read_graphml(spark, str(path), "f")
    assert vertices.isEmpty() and edges.isEmpty()


def test_bad_graphml_elements_are_listed(spark, rows, tmp_path):
    (tmp_path / "a.graphml").write_text(
        '<graphml><graph><node id="1"><data key="labelV">processGroup</data></node><node id="n2"><data key="labelV">processor</data></node>'
        '<edge id="3" source="1" target="n2"><data key="labelE">parent</data></edge></graph></graphml>'
    )
    (tmp_path / "cut.graphml").write_text('<graphml><graph><node id="5"><data key="labelV">processor</data></node><node id="6"><data key="lab')
    vertices, edges = gf.read_graphml(spark, str(tmp_path), "f")
    assert rows(vertices, "id") == [(1,), (5,)] and edges.isEmpty()
    bad = gf.graphml_rejects(spark, str(tmp_path)).select(F.element_at(F.split("path", "/"), -1).alias("file"), "reason", "element")
    assert rows(bad) == [
        ("a.graphml", "ids that are not numbers: 3, 1, n2", "edge"), ("a.graphml", "ids that are not numbers: n2", "node"),
        ("cut.graphml", "unreadable element", "node"),
    ]


def test_graphml_keys_name_the_data(spark, rows, tmp_path):
    path = tmp_path / "keys.graphml"
    path.write_text(
        '<graphml><key id="d0" for="node" attr.name="labelV"/><key id="d1" for="node" attr.name="procId"/><key id="d2" for="edge" attr.name="labelE"/>'
        '<key id="d3" for="node" attr.name="queue size"/><graph><node id="1"><data key="d0">processor</data><data key="d1">p1</data>'
        '<data key="d3">7</data><data key="own">x</data></node><edge id="3" source="1" target="1"><data key="d2">dependent</data></edge></graph></graphml>'
    )
    vertices, edges = gf.read_graphml(spark, str(path), "f")
    found = vertices.first()
    assert (found.label, found.proc_id, found.properties) == ("processor", "p1", {"queue size": "7", "own": "x"})
    assert rows(edges, "id", "label") == [(3, "dependent")]


def test_bad_lines_and_documents_are_listed(spark, rows, tmp_path):
    line = {"id": {"@value": 1}, "label": "processor", "properties": {"procId": [{"value": "p"}]}}
    status = {"flow_id": "f", "processGroupFlow": {"id": "r", "flow": {"connections": [{"id": "c"}]}}}
    listing = {"source": "a", "registries": [{"registry": {"id": "1", "name": "x"}}]}
    good = "<template><name>A</name><snippet><processors><name>P</name></processors></snippet></template>"
    for name, text in (("g", line), ("s", status), ("r", listing)):
        (tmp_path / name).mkdir()
        (tmp_path / name / "f.json").write_text(json.dumps(text) + "\n" + json.dumps(text)[:-9] + "\n")
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "good.xml").write_text(good)
    (tmp_path / "t" / "cut.xml").write_text(good[:-30])
    at = lambda name: str(tmp_path / name)
    assert gf.read_graphson(spark, at("g"), "f")[0].count() == 1
    assert docs.read_status_snapshots(spark, at("s")).count() == 1
    assert docs.read_registry_listing(spark, at("r")).count() == 1
    assert rows(docs.read_templates(spark, at("t"))) == [("A", "processor", "P")]
    assert rows(gf.graphson_rejects(spark, at("g")), "document") == [(json.dumps(line)[:-9],)]
    assert rows(docs.status_rejects(spark, at("s")), "document") == [(json.dumps(status)[:-9],)]
    assert rows(docs.registry_rejects(spark, at("r")), "document") == [(json.dumps(listing)[:-9],)]
    assert gf.graphson_rejects(spark, at("g")).count() == docs.status_rejects(spark, at("s")).count() == 1
    assert [(r.path[-7:], r.document) for r in docs.template_rejects(spark, at("t")).collect()] == [("cut.xml", good[:-30])]


def test_unknown_encodings_are_rejects(spark, rows, tmp_path):
    flow = "<?xml version='1.0' encoding='{}'?><flowController><rootGroup><id>r</id><name>R</name></rootGroup></flowController>"
    for name in ("utf-8", "no-such-code", "utf-32"):
        (tmp_path / f"{name}.xml").write_text(flow.format(name))
    parsed = fx.read_flow_configs(spark, str(tmp_path))
    assert rows(fx.components(parsed), "id") == [("r",)]
    bad = fx.rejects(parsed).select(F.element_at(F.split("path", "/"), -1).alias("file"), F.substring("reason", 1, 10).alias("why"))
    assert rows(bad) == [("no-such-code.xml", "unreadable"), ("utf-32.xml", "unreadable")]


def test_templates(spark, rows, tmp_path):
    (tmp_path / "t.xml").write_text(
        """<?xml version="1.0"?>
<template><description>d</description><name>Hello</name><snippet>
  <controllerServices><id>s</id><name>service</name></controllerServices>
  <processGroups><id>g</id><name>Top Group</name><contents>
     <processors><name>inner</name></processors><connections><name>c</name></connections></contents></processGroups>
  <inputPorts><name>in</name></inputPorts><inputPorts><name>in</name></inputPorts><processors><name>P</name></processors>
</snippet></template>"""
    )
    assert rows(docs.read_templates(spark, str(tmp_path))) == [
        ("Hello", "inputPort", "in"), ("Hello", "processGroup", "Top Group"), ("Hello", "processor", "P"),
    ]


def test_status_documents(spark, rows, tmp_path):
    queue = lambda q: {"aggregateSnapshot": {"queuedCount": q}}
    document = {
        "flow_id": "f",
        "ts": "2024-01-01T00:00:00Z",
        "processGroupFlow": {
            "id": "root",
            "flow": {
                "processGroups": [
                    {"id": "g", "revision": {"version": 3}, "component": {"name": "G", "parentGroupId": "root"},
                     "status": queue("1,234"), "runningCount": 2, "stoppedCount": 1, "disabledCount": 0, "invalidCount": 0,
                     "activeRemotePortCount": 1, "inactiveRemotePortCount": 0}
                ],
                "connections": [{"id": "c", "status": queue("12")}],
                "remoteProcessGroups": [{"id": "r", "component": {"transmitting": True}}],
                "controllerServices": [{"id": "s", "component": {"state": "ENABLED"}}],
            },
        },
    }
    (tmp_path / "s.json").write_text(json.dumps(document) + "\n" + json.dumps({"flow_id": "g", "processGroupFlow": {"id": "x"}}))
    found = docs.read_status_snapshots(spark, str(tmp_path))
    assert rows(found, "kind", "entity_id", "parent_id", "state", "queued_count", "version", "running") == [
        ("connection", "c", "root", None, "12", None, None),
        ("group", "g", "root", None, "1,234", 3, 2),
        ("remote", "r", "root", "true", None, None, None),
        ("service", "s", "root", "ENABLED", None, None, None),
    ]


def test_registry_listing(spark, rows, tmp_path):
    listing = {"source": "a", "registries": [{"registry": {"id": "1", "name": "Prod"}}, {"registry": {"id": "2", "name": "dev"}}]}
    (tmp_path / "r.json").write_text(json.dumps(listing))
    assert rows(docs.read_registry_listing(spark, str(tmp_path))) == [("a", 0, "1", "Prod"), ("a", 1, "2", "dev")]
