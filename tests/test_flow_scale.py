"""Short flow documents read as trees, and the tasks that make and read them."""

import gzip
import random

import pyarrow as pa
import pytest

from checks import binding as b
from flowline.sources import flow_xml as fx
from tests.test_flow_parser import document


def parsed(documents, batch_rows, **limits):
    """All rows in the order of their documents and numbers."""
    batch = pa.RecordBatch.from_pydict({"path": [p for p, _ in documents], "content": [c for _, c in documents]})
    rows = [row for out in fx._parse_batches(batch_rows, **limits)([batch]) for row in out.to_pylist()]
    return sorted(rows, key=lambda r: (r["path"], r["seq"] or 0))


@pytest.mark.parametrize("batch_rows", [3, 10_000])
def test_short_documents_as_trees_equal_the_same_read_piece_by_piece(batch_rows):
    draw = random.Random(7)
    documents = [(str(i), document(draw)) for i in range(300)]
    documents = [(p, gzip.compress(c) if draw.random() < 0.5 else c) for p, c in documents]
    one = b"<a><rootGroup><id>&i;</id><name>n</name></rootGroup></a>"
    documents += [
        ("entity", b"<!DOCTYPE a [<!ENTITY i 'x'>]>" + one), ("unread", b"<!DOCTYPE a [<!ENTITY % p SYSTEM 'p'> %p;]>" + one),
        ("latin", "<?xml version='1.0' encoding='iso-8859-1'?><rootGroup><id>é</id><name>ü</name></rootGroup>".encode("latin-1")),
        ("wide", "<?xml version='1.0' encoding='utf-16'?><rootGroup><id>é</id><name>ü</name></rootGroup>".encode("utf-16")),
        ("unknown", b"<?xml version='1.0' encoding='none-such'?><rootGroup><id>e</id><name>u</name></rootGroup>"),
        ("nameless and cut", b"<a><rootGroup><id>e</id></rootGroup>"), ("rubbish", b"\x1f\x8bno"), ("null", None),
        ("padded", gzip.compress(b"<rootGroup><id>e</id><name>u</name></rootGroup>") + b"\0\0"),
    ]
    pieces = parsed(documents, batch_rows, whole_bytes=0)
    assert parsed(documents, batch_rows) == pieces
    assert parsed(documents, batch_rows, whole_bytes=600) == pieces


def test_parsing_tasks_do_not_grow_with_the_table(spark, tmp_path, monkeypatch):
    orders = spark.range(1000).selectExpr("id AS o_orderkey", "id AS o_custkey", "'F' AS o_orderstatus", "1D AS o_totalprice", "'2-HIGH' AS o_orderpriority")
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    monkeypatch.setattr(b, "ORDERS_PER_TASK", 30, raising=False)
    documents = b.flow_documents(spark, str(tmp_path))
    assert documents.rdd.getNumPartitions() == 34 and documents.count() == 1000


def test_many_tasks_write_the_flow_files_and_one_those_of_a_flow(spark, tmp_path, monkeypatch):
    suppliers = spark.range(1000).selectExpr("id % 500 AS s_suppkey", "'n' AS s_name", "1 AS s_nationkey", "1D AS s_acctbal")
    suppliers.coalesce(1).write.parquet(f"{tmp_path}/supplier.parquet")
    monkeypatch.setattr(b, "SUPPLIERS_PER_TASK", 50, raising=False)
    files = b.flow_files(spark, str(tmp_path))
    assert files.rdd.getNumPartitions() == 20
    per_task = [set(rows) for rows in files.rdd.map(lambda r: r["flow"]).glom().collect()]
    assert sum(map(len, per_task)) == 500 and len(set().union(*per_task)) == 500
