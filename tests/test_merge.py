from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from flowline.operators import merge as m
from flowline.operators.catalog import TableSpec
from flowline.plans import ingestion
from flowline.sources import tables

SPEC = TableSpec("item", (("id", "bigint"), ("code", "string"), ("v", "string"), ("grp", "int")), ("id", "code"), "GRP", 4)
T0, T1, T2 = (datetime(2024, 1, d) for d in (1, 2, 3))


def at(t):
    return F.lit(t)


def stage(spark, values):
    return spark.createDataFrame(values, SPEC.ddl())


def delta(spark, values, t=T1):
    return m.stage_to_delta(stage(spark, values), SPEC, at(t))


def table(spark, values):
    return spark.createDataFrame(values, SPEC.ddl(audit=True))


def actions(df):
    return {(r.id, r.code): r.action for r in df.collect()}


def test_full_duplicates_collapse(spark):
    got = delta(spark, [(1, "a", "x", 1), (1, "a", "x", 1), (1, "a", "y", 1)])
    assert got.count() == 2 and got.columns == [*SPEC.column_names, "checksum", "watermark"]


def test_merge_inserts_updates_and_keeps(spark, rows):
    target = delta(spark, [(1, "a", "old", 1), (2, "a", "same", 1), (3, "a", "gone", 1)], T0)
    got = m.merge_current(target, delta(spark, [(1, "a", "new", 9), (2, "a", "same", 1), (4, "a", "add", 4)]), SPEC, at(T2))
    assert rows(got, "id", "v", "grp", "watermark") == [
        (1, "new", 1, T2),  # the cluster column keeps its value
        (2, "same", 1, T0),
        (3, "gone", 1, T0),
        (4, "add", 4, T2),
    ]


def test_changed_cluster_column_alone_changes_only_the_checksum(spark):
    target = delta(spark, [(1, "a", "x", 1)], T0)
    incoming = delta(spark, [(1, "a", "x", 2)])
    got = m.merge_current(target, incoming, SPEC, at(T2)).first()
    assert got.grp == 1 and got.checksum == incoming.first().checksum


@pytest.mark.parametrize("key", [(None, None), (0, ""), (None, ""), (0, None)])
def test_null_key_equals_default(spark, key):
    target = table(spark, [(None, None, "x", 1, "old", T0)])
    got = m.merge_actions(target, delta(spark, [(*key, "y", 1)]), SPEC).collect()
    assert [r.action for r in got] == ["update"]


def test_null_target_checksum_means_no_update(spark):
    target = table(spark, [(1, "a", "x", 1, None, T0)])
    assert actions(m.merge_actions(target, delta(spark, [(1, "a", "y", 1)]), SPEC)) == {(1, "a"): "same"}


def test_duplicate_keys(spark):
    double = delta(spark, [(1, "a", "x", 1), (1, "a", "y", 1)])
    empty = table(spark, [])
    with pytest.raises(Exception, match="duplicate delta key for item: 1, a"):
        m.merge_current(empty, double, SPEC).collect()
    copies = delta(spark, [(1, "a", "x", 1)]).union(delta(spark, [(1, "a", "x", 1)], T2))
    assert m.merge_current(empty, copies, SPEC).count() == 1
    newer = delta(spark, [(1, "a", "z", 1)], T2)
    got = m.merge_current(empty, double.union(newer), SPEC, on_duplicate="latest").collect()
    assert [r.v for r in got] == ["z"]
    with pytest.raises(ValueError):
        m.merge_current(empty, double, SPEC, on_duplicate="first")


def test_report(spark, rows):
    target = delta(spark, [(1, "a", "old", 1), (3, "a", "gone", 1)], T0)
    got = m.merge_report(target, delta(spark, [(1, "a", "new", 1), (4, "a", "x", 1), (5, "a", "x", 1)]), SPEC)
    assert rows(got, "action", "n") == [("insert", 2), ("keep", 1), ("update", 1)]


def test_empty_delta_and_empty_target(spark):
    full = delta(spark, [(1, "a", "x", 1)])
    nothing = table(spark, [])
    assert [r.action for r in m.merge_actions(full, nothing, SPEC).collect()] == ["keep"]
    assert [r.action for r in m.merge_actions(nothing, full, SPEC).collect()] == ["insert"]


cell = st.tuples(st.one_of(st.none(), st.integers(0, 5)), st.sampled_from(["a", "b"]), st.sampled_from(["x", "y", None]), st.integers(0, 2))


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(before=st.lists(cell, max_size=6), incoming=st.lists(cell, max_size=6))
def test_merge_is_idempotent_and_complete(spark, before, incoming):
    first = {(r[0] or 0, r[1]): r for r in before}
    second = {(r[0] or 0, r[1]): r for r in incoming}
    target = delta(spark, list(first.values()), T0)
    change = delta(spark, list(second.values()))
    merged = spark.createDataFrame(m.merge_current(target, change, SPEC, at(T1)).collect(), target.schema)
    assert {((r.id or 0), r.code) for r in merged.collect()} == set(first) | set(second)
    again = {r.action for r in m.merge_actions(merged, change, SPEC).collect()}
    assert again <= {"same", "keep"}


def test_incremental_read(spark, rows):
    df = spark.createDataFrame([(1, 5), (2, 6), (3, 6), (4, 7), (None, 9), (1, None)], "a int, b int")
    assert rows(m.read_source_incremental(df, ["a", "b"], {"a": 3, "b": 7}, ["a"])) == [(None, 9), (1, None), (3, 6), (4, 7)]
    assert rows(m.read_source_incremental(df, ["a"], {"a": 3})) == [(None, 9), (3, 6), (4, 7)]
    assert m.read_source_incremental(df, ["a", "b"], {}).count() == 6
    assert rows(m.read_source_incremental(df, ["a", "b"], {"a": 9})) == [(None, 9), (1, 5), (2, 6), (3, 6), (4, 7)]
    assert m.high_water_marks(df, ["a", "b"]).first().asDict() == {"a": 4, "b": 9}


def test_no_change_is_lost_between_two_columns(spark, rows):
    """Newer by one column only, at the other's mark, and of unknown time."""
    df = spark.createDataFrame([(11, 3), (10, 50), (None, 99), (9, 4)], "ts int, k int")
    assert rows(m.read_source_incremental(df, ["ts", "k"], {"ts": 10, "k": 5})) == [(None, 99), (10, 50), (11, 3)]


def test_pipeline_runs_compacts_and_survives_a_failed_run(spark, rows, tmp_path):
    base = str(tmp_path)

    def run(values, marks, t):
        request = ingestion.IngestionRequest(SPEC, lambda s: stage(s, values), ["id"], marks)
        return ingestion.run_ingestion(spark, [request], base, at(t))["item"]

    done = run([(1, "a", "x", 1), (2, "a", "x", 1)], {}, T0)
    assert done == {"written": [0], "high_water": {"id": 2}}
    done = run([(1, "a", "ignored", 1), (2, "a", "x", 1), (3, "a", "x", 1)], done["high_water"], T1)
    assert done == {"written": [0], "high_water": {"id": 3}}
    current = tables.current_table(spark, base, SPEC)
    expected = [(1, "x", T0), (2, "x", T0), (3, "x", T1)]
    assert rows(current.read(), "id", "v", "watermark") == expected
    assert tables.read_delta(spark, base, SPEC).count() == 0
    assert tables.read_stage(spark, base, SPEC).count() == 0

    with pytest.raises(ingestion.IngestionFailed, match="duplicate delta key"):
        run([(9, "a", "x", 1), (9, "a", "y", 1)], {}, T2)
    assert rows(current.read(), "id", "v", "watermark") == expected

    tables.truncate_delta(spark, base, SPEC)
    tables.insert_delta(delta(spark, [(1, "a", "z", 1)]), base, SPEC)
    assert rows(ingestion.merge_preview(spark, base, SPEC), "action", "n") == [("keep", 2), ("update", 1)]


@pytest.fixture
def database(spark, tmp_path):
    spark.sql(f"CREATE DATABASE flowline_prepare LOCATION '{tmp_path}/db'")
    yield "flowline_prepare"
    spark.sql("DROP DATABASE flowline_prepare CASCADE")


def test_prepared_tables_are_bucketed_orc(spark, tmp_path, database):
    statements = ingestion.prepare_tables(spark, [SPEC], database, str(tmp_path))
    assert statements.count() == 6
    described = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {database}.item").collect()}
    assert described["Num Buckets"] == "4" and described["Provider"].lower() == "orc"
    assert described["Bucket Columns"] == "[`grp`]"
    assert spark.table(f"{database}.stg_item").columns == SPEC.column_names


def test_pipeline_on_prepared_tables(spark, rows, tmp_path, database):
    base = str(tmp_path)
    ingestion.prepare_tables(spark, [SPEC], database, base)

    def run(values, t):
        request = ingestion.IngestionRequest(SPEC, lambda s: stage(s, values))
        ingestion.run_ingestion(spark, [request], base, at(t), database=database)

    run([(1, "a", "x", 1), (2, "a", "x", 1)], T0)
    run([(2, "a", "y", 7), (3, "a", "x", 1)], T1)
    expected = [(1, "x", 1, T0), (2, "y", 1, T1), (3, "x", 1, T1)]
    assert rows(spark.table(f"{database}.item"), "id", "v", "grp", "watermark") == expected
    assert spark.table(f"{database}.item_delta").isEmpty()
    assert ingestion.compact(spark, base, SPEC, database=database, least_files=1) in ([], [0])
    assert rows(spark.table(f"{database}.item"), "id", "v", "grp", "watermark") == expected
    described = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {database}.item").collect()}
    assert described["Num Buckets"] == "4"
    assert {t.name for t in spark.catalog.listTables(database)} == {"item", "item_delta", "stg_item"}


def test_rendered_statements(spark, rows, tmp_path, database):
    """The insert runs in Spark; the MERGE, in DuckDB, does what merge_current does."""
    duckdb = pytest.importorskip("duckdb")
    statements = {s.statement: s.sql for s in ingestion.prepare_tables(spark, [SPEC], database, str(tmp_path)).collect()}
    incoming = [(1, "a", "new", 9), (2, "a", "same", 1), (None, "b", "x", 2), (4, None, None, 4)]
    tables.stage(stage(spark, incoming * 2), str(tmp_path), SPEC)
    spark.sql(statements["delta_insert_sql"])
    inserted = spark.table(f"{database}.item_delta")
    plain = [*SPEC.column_names, "checksum"]
    assert rows(inserted, *plain) == rows(delta(spark, incoming), *plain)

    before = delta(spark, [(1, "a", "old", 1), (2, "a", "same", 1), (0, "b", "y", 1), (9, "a", "gone", 1)])
    want = rows(m.merge_current(before, inserted, SPEC), *plain)
    spark.sql(statements["delta_truncate_sql"])
    duck = duckdb.connect()
    duck.execute(f"CREATE SCHEMA {database}")
    for name, df in (("item", before), ("item_delta", delta(spark, incoming))):
        duck.execute(f"CREATE TABLE {database}.{name} ({SPEC.ddl(audit=True).replace('`', '')})")
        duck.executemany(f"INSERT INTO {database}.{name} VALUES (?, ?, ?, ?, ?, ?)", [list(r) for r in df.collect()])
    duck.execute(statements["txn_merge_sql"].replace("current_timestamp()", "TIMESTAMP '2024-01-03'"))
    got = duck.execute(f"SELECT {', '.join(plain)} FROM {database}.item").fetchall()
    assert sorted(got, key=str) == sorted(want, key=str)


def stored_files(current):
    return {r.file_path: r.part for r in current.files().collect()}


def table_of(spark, base, values, parts):
    current = tables.current_table(spark, base, SPEC)
    current.overwrite(delta(spark, values, T0), parts)
    return current


def merge(spark, base, values, t, **options):
    return ingestion.merge_delta(tables.PathStore(spark, base, SPEC), delta(spark, values, t), at(t), **options)


def test_a_merge_writes_only_parts_in_which_a_row_changes(spark, rows, tmp_path):
    base = str(tmp_path)
    current = table_of(spark, base, [(k, "a", "x", 1) for k in range(200)], 16)
    before = stored_files(current)
    assert set(before.values()) == set(range(16)) and current.parts() == 16
    incoming = [(k, "a", "x", 1) for k in range(150)] + [(7, "a", "y", 1)]
    incoming.remove((7, "a", "x", 1))
    written = merge(spark, base, incoming, T1)
    assert written == [r.part for r in current.rows().filter("id = 7").collect()] and len(written) == 1
    after = stored_files(current)
    assert {f: p for f, p in before.items() if p not in written} == {f: p for f, p in after.items() if p not in written}
    assert current.read().count() == 200 and rows(current.read().filter("v = 'y'"), "id", "watermark") == [(7, T1)]


def test_an_idempotent_run_writes_nothing(spark, tmp_path):
    base = str(tmp_path)
    incoming = [(k, "a", "x", 1) for k in range(100)] + [(None, None, "z", 1)]
    assert merge(spark, base, incoming, T0)
    current = tables.current_table(spark, base, SPEC)
    before = stored_files(current)
    assert merge(spark, base, incoming, T1) == [] and merge(spark, base, [], T1) == []
    assert stored_files(current) == before and current.read().filter(F.col("watermark") == at(T0)).count() == 101


def test_parts_are_sized_by_bytes(spark, rows, tmp_path):
    base = str(tmp_path)
    values = [(k, "a", f"{k * 7919} words", 1) for k in range(3000)]
    written = merge(spark, base, values, T0, part_bytes=2000)
    current = tables.current_table(spark, base, SPEC)
    parts = current.parts()
    assert parts > 4 and written == list(range(parts))
    assert rows(current.read(), "id", "v") == [(k, v) for k, _, v, _ in values]
    # A table that has grown is dealt anew, once.
    assert ingestion.compact(spark, base, SPEC, part_bytes=500, least_files=10**6, share=2) != []
    dealt = current.parts()
    assert dealt >= 2 * parts and rows(current.read(), "id", "v") == [(k, v) for k, _, v, _ in values]
    assert ingestion.compact(spark, base, SPEC, part_bytes=10**9, least_files=10**6, share=2) == []
    assert merge(spark, base, [(5, "a", "new", 1)], T1) and current.parts() == dealt
    assert current.read().count() == 3000


@pytest.mark.parametrize("limits", [{"least_files": 4, "share": 2}, {"least_files": 10**6, "share": 0.5}])
def test_compaction_leaves_parts_with_large_files_alone(spark, rows, tmp_path, limits):
    base = str(tmp_path)
    one_bucket = TableSpec("item", SPEC.columns, SPEC.keys, "GRP", 1)
    current = tables.current_table(spark, base, one_bucket)
    values = [(k, "a", f"{k * 104729} {k * 7919}", 1) for k in range(4000)]
    current.overwrite(delta(spark, values, T0).coalesce(1), 2)
    assert ingestion.compact(spark, base, one_bucket, **limits) == []
    # Part 0 comes to lie in many files, part 1 stays one large file.
    some = current.rows([0]).repartition(6)
    current.replace(some, 2)
    before = stored_files(current)
    assert sum(part == 0 for part in before.values()) >= 4
    assert ingestion.compact(spark, base, one_bucket, **limits) == [0]
    after = stored_files(current)
    assert [f for f, p in before.items() if p == 1] == [f for f, p in after.items() if p == 1]
    assert list(after.values()).count(0) == 1 and current.read().count() == 4000
    assert ingestion.compact(spark, base, one_bucket, **limits) == []


class Stopped(Exception):
    pass


@pytest.mark.parametrize("kind", ["folder", "database"])
@pytest.mark.parametrize("moment", ["before", "between", "after"])
def test_an_exchange_that_stops_is_finished_by_the_next_run(spark, rows, tmp_path, database, monkeypatch, kind, moment):
    base, name = str(tmp_path), database if kind == "database" else None
    ingestion.prepare_tables(spark, [SPEC], database, base)

    def run(values, t):
        request = ingestion.IngestionRequest(SPEC, lambda s: stage(s, values))
        return ingestion.run_ingestion(spark, [request], base, at(t), database=name)["item"]["written"]

    run([(k, "a", "x", 1) for k in range(100)], T0)
    real = tables.CurrentTable._exchange

    def stopping(self):
        if moment == "between":  # Spark has taken the old partition away and not yet put the new one in its place
            for part in self._deal()[1]:
                self._hadoop().delete(self._hadoop_path(f"{self.path}/parts=1/part={part}"), True)
        if moment == "after":
            delete = self._hadoop
            real(self) if delete is None else None
            schema = f"{SPEC.ddl(audit=True)}, merge_key string, parts int, part int"
            spark.read.schema(schema).orc(self.following).select(*self.stored).write.insertInto(self.name, overwrite=True)
        raise Stopped()

    monkeypatch.setattr(tables.CurrentTable, "_exchange", stopping)
    with pytest.raises(ingestion.IngestionFailed):
        run([(0, "a", "y", 1), (100, "a", "x", 1)], T1)
    monkeypatch.setattr(tables.CurrentTable, "_exchange", real)
    store = tables.open_store(spark, base, SPEC, name)
    assert rows(store.read(), "id", "v") == [(0, "y"), *[(k, "x") for k in range(1, 101)]]
    assert run([(0, "a", "y", 1), (100, "a", "x", 1)], T2) == []
    assert store.read().count() == 101 and store.read().filter(F.col("watermark") == at(T1)).count() == 2


def test_rows_that_were_not_written_in_full_do_not_count(spark, rows, tmp_path):
    base = str(tmp_path)
    current = table_of(spark, base, [(1, "a", "x", 1)], 1)
    lost = current.rows().withColumn("v", F.lit("lost")).withColumn("parts", F.lit(1))
    lost.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").partitionBy("parts", "part").orc(current.following)
    assert merge(spark, base, [(2, "a", "x", 1)], T1) == [0]
    assert rows(tables.current_table(spark, base, SPEC).read(), "id", "v") == [(1, "x"), (2, "x")]


def test_a_new_definition_finds_the_stored_rows(spark, rows, tmp_path):
    current = table_of(spark, str(tmp_path), [(1, "a", "x", 1), (2, "a", "x", 1)], 3)
    spark.sql(f"DROP TABLE {current.name}")
    again = tables.current_table(spark, str(tmp_path), SPEC)
    assert rows(again.read(), "id", "v") == [(1, "x"), (2, "x")] and again.parts() == 3
    again.overwrite(delta(spark, [(2, "a", "y", 1)]))
    assert rows(again.read(), "id", "v") == [(2, "y")]


def test_tables_run_side_by_side_and_fail_apart(spark, rows, tmp_path):
    import threading

    base = str(tmp_path)
    meeting = threading.Barrier(2, timeout=60)
    specs = {n: TableSpec(n, SPEC.columns, SPEC.keys, "GRP", 2) for n in ("one", "two", "bad")}

    def source(name):
        def read(s):
            if name == "bad":
                raise Stopped("no source")
            meeting.wait()  # passes only while both tables run
            return stage(s, [(1, "a", name, 1)])

        return read

    requests = [ingestion.IngestionRequest(specs[n], source(n), ["id"]) for n in ("one", "bad", "two")]
    with pytest.raises(ingestion.IngestionFailed, match="bad: no source") as failed:
        ingestion.run_ingestion(spark, requests, base, at(T0))
    assert set(failed.value.errors) == {"bad"} and failed.value.done["two"] == {"written": [0], "high_water": {"id": 1}}
    for name in ("one", "two"):
        assert rows(tables.current_table(spark, base, specs[name]).read(), "id", "v") == [(1, name)]


def test_merge_keys_tell_keys_apart(spark):
    spec = TableSpec("t", (("a", "string"), ("b", "string"), ("c", "int")), ("a", "b", "c"))
    values = [("1:x", "", 0), ("", "1:x", 0), (None, "x", None), ("", "x", 0), ("x", "", 0), ("1", "1x", 1), ("11", "x", 1)]
    df = spark.createDataFrame(values, "a string, b string, c int").select(m.merge_key(spec).alias("k"))
    assert df.distinct().count() == len(values) - 1
    single = TableSpec("t", (("a", "int"),), ("a",))
    found = spark.createDataFrame([(None,), (0,)], "a int").select(m.merge_key(single).alias("k"))
    assert {r.k for r in found.collect()} == {0} and m.merge_key_type(single) == "int"


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(before=st.lists(cell, max_size=6), incoming=st.lists(cell, max_size=6))
def test_stored_merge_equals_the_merge_of_frames(spark, rows, tmp_path_factory, before, incoming):
    base = str(tmp_path_factory.mktemp("merged"))
    first = {(r[0] or 0, r[1]): r for r in before}
    second = {(r[0] or 0, r[1]): r for r in incoming}
    current = table_of(spark, base, list(first.values()), 3)
    want = m.merge_current(delta(spark, list(first.values()), T0), delta(spark, list(second.values())), SPEC, at(T1))
    columns = [*SPEC.column_names, "checksum", "watermark"]
    expected = rows(want, *columns)
    merge(spark, base, list(second.values()), T1)
    assert rows(current.read(), *columns) == expected


def test_scratch_of_a_run_is_deleted(spark, tmp_path):
    import glob

    from flowline.session import scratch_root

    request = ingestion.IngestionRequest(SPEC, lambda s: stage(s, [(1, "a", "x", 1)]))
    ingestion.run_ingestion(spark, [request], str(tmp_path))
    assert glob.glob(f"{scratch_root(spark)}/{spark.sparkContext.applicationId}/ingest-item-*") == []
