"""What reading and writing graph files moves."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from flowline.sources import graph_files as gf


@pytest.fixture(scope="module")
def graph(spark):
    ids = spark.range(2000)
    none = F.lit(None).cast("string")
    vertices = ids.select(
        F.lit("f").alias("flow_id"), "id", F.lit("processor").alias("label"), F.lit(None).cast("boolean").alias("is_root"),
        none.alias("pg_id"), none.alias("pg_name"), F.concat(F.lit("p"), "id").alias("proc_id"), F.lit("n").alias("proc_name"),
        F.create_map(F.lit("k"), F.col("id").cast("string")).alias("properties"),
    )
    edges = ids.filter("id > 0").select(F.lit("f").alias("flow_id"), "id", F.lit(0).cast("bigint").alias("src"), F.col("id").alias("dst"), F.lit("parent").alias("label"))
    return vertices, edges


def test_elements_of_graphml_are_not_shuffled_to_their_keys(spark, rows, graph, tmp_path):
    gf.write_graphml(*graph, str(tmp_path / "g"), elements_per_file=500)
    key = "spark.sql.autoBroadcastJoinThreshold"
    chosen = spark.conf.get(key)
    spark.conf.set(key, "100000b")  # less than the files have
    try:
        found = gf.read_graphml(spark, str(tmp_path / "g"))
        plans = [read._jdf.queryExecution().executedPlan().toString() for read in found]
    finally:
        spark.conf.set(key, chosen)
    for plan, read, written in zip(plans, found, graph):
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        assert rows(read, "flow_id", "id", "label") == rows(written, "flow_id", "id", "label")


def test_compressed_graphson_is_the_same_in_fewer_bytes(spark, rows, graph, tmp_path):
    size = {}
    for codec in ("none", "gzip"):
        path = tmp_path / codec
        gf.write_graphson(*graph, str(path), edges_per_line=300, compression=codec)
        size[codec] = sum(p.stat().st_size for p in Path(path).glob("part-*"))
        vertices, edges = gf.read_graphson(spark, str(path))
        assert rows(vertices.select("flow_id", "id", "proc_id", F.col("properties")["k"])) == rows(graph[0].select("flow_id", "id", "proc_id", F.col("properties")["k"]))
        assert rows(edges, "flow_id", "id", "src", "dst", "label") == rows(graph[1], "flow_id", "id", "src", "dst", "label")
    assert size["gzip"] * 4 < size["none"]
