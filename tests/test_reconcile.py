import pytest

from flowline.operators import reconcile as r

LIVE = "flow_id string, kind string, id string, name string, pos int"


@pytest.fixture
def live(spark):
    return spark.createDataFrame(
        [
            ("f", "rootGroup", "root", "Flow", 0),
            ("f", "processGroup", "g1", "Orders", 1),
            ("f", "processGroup", "g2", "orders", 2),
            ("f", "processor", "p1", "Orders", 3),
            ("f", "inputPort", "i1", "in", 4),
            ("f", "outputPort", "o1", "out", 5),
            ("f", "connection", "c1", "Hello Web  Service", 6),
        ],
        LIVE,
    )


@pytest.fixture
def template(spark):
    return spark.createDataFrame(
        [("t", "processGroup", "Orders"), ("t", "processGroup", "Orders"), ("t", "inputPort", "in"), ("t", "processor", "Orders"),
         ("t", "processor", "in")],
        "template string, kind string, name string",
    )


def test_names(template):
    assert r.template_names(template).count() == 4


def test_covered_is_case_sensitive_and_by_kind(live, template, rows):
    assert rows(r.covered_by_template(live, template), "id") == [("g1",), ("i1",), ("p1",)]


def test_templates_side_by_side(spark, live, template, rows):
    second = spark.createDataFrame([("u", "processGroup", "Orders"), ("u", "outputPort", "out")], template.schema)
    both = template.union(second)
    found = r.covered_by_template(live, both)
    assert rows(found, "template", "id") == [("t", "g1"), ("t", "i1"), ("t", "p1"), ("u", "g1"), ("u", "o1")]
    for name, alone in (("t", template), ("u", second)):
        of_both = r.action_plan(live, both).filter(f"template = '{name}'").drop("template").collect()
        assert of_both == r.action_plan(live, alone).drop("template").collect()


def test_find_by_name(spark, live, rows):
    names = spark.createDataFrame(
        [("f", "processGroup", "ORDERS"), ("f", "processGroup", "nope"), ("f", "processor", "x"), ("f", "label", "x")],
        "flow_id string, kind string, name string",
    )
    assert rows(r.find_by_name(live, names), "wanted", "id", "matched") == [
        ("ORDERS", "g1", True), ("nope", None, False), ("x", None, False), ("x", None, False),
    ]
    found = r.find_by_name(live, names, fallback=True)
    assert rows(found, "kind", "wanted", "id", "matched") == [
        ("label", "x", None, False), ("processGroup", "ORDERS", "g1", True),
        ("processGroup", "nope", "g1", False), ("processor", "x", "p1", False),
    ]


def test_pick_version(spark, rows):
    versions = spark.createDataFrame(
        [("r", "b", "f", 3, 0), ("r", "b", "f", 1, 1), ("r", "b", "f", 1, 2), ("r", "b", "h", 9, 4), ("r", "b", "h", 8, 5)],
        "registry string, bucket string, flow string, version int, pos int",
    )
    assert rows(r.pick_version(versions, 1), "flow", "version", "pos") == [("f", 1, 1), ("h", 9, 4)]


def test_space_match(spark, live, rows):
    assert rows(r.match_name_ignoring_space(live, "hello\twebSERVICE "), "id") == [("c1",)]
    wanted = spark.createDataFrame([("HelloWebService",), ("Or ders",)], "name string")
    assert rows(r.match_name_ignoring_space(live, wanted), "id") == [("c1",), ("g1",), ("g2",), ("p1",)]


def test_template_exists(spark, rows):
    live = spark.createDataFrame([("2", "hello"), ("1", "HELLO"), ("3", "x")], "id string, name string")
    new = spark.createDataFrame([("Hello",), ("none",)], "name string")
    assert rows(r.template_exists(live, new)) == [("Hello", "1"), ("none", None)]


VARS = "flow_id string, pg_id string, name string, value string"


def both(spark, registry, params):
    return tuple(spark.createDataFrame([("f", "g", *row) for row in side], VARS) for side in (registry, params))


def test_upsert(spark, rows):
    sides = both(
        spark,
        [("a", "1"), ("B", "2"), ("c", "3"), ("d", "4")],
        [("a", "new"), ("b", "other case"), ("c", None), ("E", "5"), ("e", "6"), ("n", None)],
    )
    assert rows(r.upsert_variables(*sides), "name", "value") == [
        ("B", "2"), ("E", "5"), ("a", "new"), ("c", "3"), ("d", "4"), ("n", None),
    ]


def test_update_only(spark, rows):
    sides = both(spark, [("a", "1"), ("B", "2"), ("c", "3"), ("d", "4")], [("a", "new"), ("b", "x"), ("c", None), ("d", " \t"), ("e", "5")])
    assert rows(r.update_variables(*sides), "name", "value") == [("B", "2"), ("a", "new"), ("c", "3"), ("d", "4")]


def test_variables_of_other_groups_stay(spark, rows):
    registry = spark.createDataFrame([("f", "g", "a", "1"), ("f", "h", "a", "1")], VARS)
    params = spark.createDataFrame([("f", "g", "a", "2")], VARS)
    for op in (r.upsert_variables, r.update_variables):
        assert rows(op(registry, params), "pg_id", "value") == [("g", "2"), ("h", "1")]


def test_undeploy_plan_is_ordered(live, template):
    plan = [(p.action, p.target, p.id) for p in r.action_plan(live, template).collect()]
    assert plan == [
        ("disable", "controllerService", "g1"),
        ("stop", "processor", "g1"),
        ("disable", "remoteProcessGroup", "g1"),
        ("stop", "inputPort", "i1"),
        ("stop", "processor", "p1"),
        ("drain", "connection", "root"),
        ("delete", "inputPort", "i1"),
        ("delete", "processor", "p1"),
        ("delete", "controllerService", "g1"),
        ("delete", "processGroup", "g1"),
    ]


def test_deploy_plan(live, template):
    plan = [(p.action, p.target, p.id) for p in r.action_plan(live, template, "deploy").collect()]
    assert plan == [
        ("start", "inputPort", "i1"),
        ("start", "processor", "p1"),
        ("enable", "controllerService", "g1"),
        ("start", "processor", "g1"),
        ("enable", "remoteProcessGroup", "g1"),
    ]
    with pytest.raises(ValueError):
        r.action_plan(live, template, "restart")
