from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from flowline.operators import merge as m
from flowline.operators.catalog import TableSpec
from flowline.operators.status import latest_per_entity, reached_state
from flowline.sources import tables
from flowline.streaming import streams

T = datetime(2024, 1, 1)
SPEC = TableSpec("item", (("id", "bigint"), ("v", "string")), ("id",))


def at(seconds):
    return T + timedelta(seconds=seconds)


def test_ingest_over_several_runs(spark, rows, tmp_path):
    base, stamp = str(tmp_path), F.lit(T)

    def run(values):
        stg = spark.createDataFrame(values, SPEC.ddl())
        stg.repartition(2).write.mode("append").orc(tables.stage_path(base, SPEC))
        streams.stream_ingest(spark, base, SPEC, f"{base}/cp", stamp, max_files=1).awaitTermination()
        return tables.current_table(spark, base, SPEC)

    assert rows(run([(1, "a"), (2, "b")]).read(), "id", "v") == [(1, "a"), (2, "b")]
    current = run([(2, "c"), (3, "d")])
    assert rows(current.read(), "id", "v") == [(1, "a"), (2, "c"), (3, "d")]
    delta = m.stage_to_delta(spark.createDataFrame([(2, "c"), (3, "d")], SPEC.ddl()), SPEC, stamp)
    assert {r.action for r in m.merge_actions(current.read(), delta, SPEC).collect()} == {"same", "keep"}


EVENTS = "flow_id string, entity_id string, state string, version bigint, ts timestamp"


def feed(spark, tmp_path, name, schema):
    """A file stream and a function that adds one file of rows to it."""
    path = str(tmp_path / name)
    spark.createDataFrame([], schema).write.parquet(path)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)

    def add(values):
        spark.createDataFrame(values, schema).coalesce(1).write.mode("append").parquet(path)

    return stream, add


def test_latest_state_equals_batch_after_restarts(spark, rows, tmp_path):
    stream, add = feed(spark, tmp_path, "in", EVENTS)
    batches = [
        [("f", "a", "x", 1, at(1)), ("f", "b", "x", 5, at(1))],
        [("f", "a", "y", 2, at(2)), ("f", "b", "old", 4, at(9)), (None, None, "x", 1, at(1))],
        [("f", "c", "z", 1, at(3)), ("f", "c", "z", 1, at(3)), ("f", "a", "y", 2, at(1))],
    ]
    checkpoint, columns = str(tmp_path / "cp"), ["flow_id", "entity_id", "state", "version", "ts"]
    seen = []
    for n, batch in enumerate(batches):
        add(batch)
        changed = lambda df, _: seen.append({r.entity_id for r in df.collect()})
        streams.stream_latest_state(stream, checkpoint, changed=changed).awaitTermination()
        so_far = spark.createDataFrame([r for b in batches[: n + 1] for r in b], EVENTS)
        assert rows(streams.read_latest_state(spark, checkpoint), *columns) == rows(latest_per_entity(so_far), *columns)
    assert streams.read_latest_state(spark, checkpoint).columns == latest_per_entity(so_far).columns
    # A batch handles its own entities only.
    assert [s for s in seen if s] == [{"a", "b"}, {"a", "b", None}, {"c", "a"}]


def test_latest_state_without_a_receiver_and_on_disk(spark, rows, tmp_path):
    stream, add = feed(spark, tmp_path, "in", EVENTS)
    add([("f", "a", "x", 1, at(1))])
    before = spark.conf.get(streams._STORE)
    streams.stream_latest_state(stream, str(tmp_path / "cp")).awaitTermination()
    assert spark.conf.get(streams._STORE) == before
    assert rows(streams.read_latest_state(spark, str(tmp_path / "cp")), "entity_id", "state") == [("a", "x")]
    assert "RocksDB" in next((tmp_path / "cp" / "offsets").glob("0")).read_text()


COMMANDS = "flow_id string, entity_id string, target_state string, ts timestamp"
STATUSES = "flow_id string, entity_id string, state string, ts timestamp"


@pytest.fixture
def run_reached(spark, tmp_path):
    commands, add_command = feed(spark, tmp_path, "commands", COMMANDS)
    statuses, add_status = feed(spark, tmp_path, "statuses", STATUSES)
    asked = []

    def run(new_commands=(), new_statuses=(), within=10, delay=5):
        """What has become of every command: (entity, second) -> (outcome, second reached)."""
        if new_commands:
            asked.extend(("f", e, s, at(t)) for e, s, t in new_commands)
            add_command(asked[-len(new_commands) :])
        if new_statuses:
            add_status([("f", e, s, at(t)) for e, s, t in new_statuses])
        out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
        streams.stream_reached_state(commands, statuses, within, delay, out, checkpoint).awaitTermination()
        answers = streams.read_reached_state(spark, out)
        keys = [(r.entity_id, r.target_state, r.ts) for r in answers.collect()]
        assert len(keys) == len(set(keys))  # one answer per command
        told = streams.command_outcomes(
            spark.createDataFrame(asked, COMMANDS).distinct(), answers, streams.read_open_commands(spark, checkpoint)
        )
        return {
            (r.entity_id, (r.ts - T).seconds): (r.outcome, r.reached_ts and (r.reached_ts - T).seconds)
            for r in told.collect()
        }

    return run


def test_reached_across_batches(run_reached):
    first = run_reached([("a", "UP", 0), ("b", "UP", 0)], [("b", "down", 1)])
    assert first == {("a", 0): ("open", None), ("b", 0): ("open", None)}
    # a is answered: the watermark, 12 - 5, has reached the status. b waits until it has passed 0 + 10.
    second = run_reached([("c", "UP", 12), ("c", "UP", 12)], [("a", "up", 7), ("x", "up", 12)])
    assert second[("a", 0)] == ("reached", 7) and second[("b", 0)] == second[("c", 12)] == ("open", None)
    third = run_reached([("d", "UP", 30)], [("c", "UP", 13), ("y", "up", 30)])
    assert third[("b", 0)] == ("missed", None) and third[("c", 12)] == ("reached", 13) and third[("d", 30)] == ("open", None)


def test_late_status_improves_an_answer_and_too_late_ones_are_dropped(run_reached):
    first = run_reached([("a", "UP", 0), ("z", "UP", 8)], [("a", "UP", 9)])
    assert first[("a", 0)] == ("open", None)  # an earlier status may come until the watermark is there
    assert run_reached([], [("a", "UP", 5)])[("a", 0)] == ("open", None)
    second = run_reached([("q", "UP", 40)], [("q", "UP", 41)])
    assert second[("a", 0)] == ("reached", 5) and second[("z", 8)] == ("missed", None)
    # The watermark is now 35: a status and a command from before it do not count.
    late = run_reached([("late", "UP", 20)], [("a", "UP", 1), ("late", "UP", 21)])
    assert late[("a", 0)] == ("reached", 5) and late[("late", 20)] == ("late", None)
    assert run_reached([("q", "UP", 60)], [("q", "UP", 60)])[("q", 40)] == ("reached", 41)


def test_late_command_finds_an_earlier_batch_status(run_reached):
    run_reached([("w", "UP", 10)], [("a", "UP", 9), ("w", "UP", 10)])
    assert run_reached([("a", "UP", 8)])[("a", 8)] == ("open", None)
    assert run_reached([("w", "UP", 90)], [("w", "UP", 90)])[("a", 8)] == ("reached", 9)


def test_targets_in_several_spellings_and_unknown_entities(run_reached):
    run_reached([("a", "UP", 1), ("a", "down", 1), (None, "up", 1)], [("a", "Up", 2), (None, "UP", 3), ("a", None, 3)])
    got = run_reached([("w", "UP", 90)], [("w", "UP", 90)])
    assert got[(None, 1)] == ("reached", 3)


def test_state_goes_when_nothing_is_left_to_ask(spark, tmp_path, run_reached):
    run_reached([("a", "UP", t) for t in range(0, 50, 5)], [("a", "UP", t) for t in range(50)])
    run_reached([("w", "x", 500)], [("w", "y", 500)])
    state = spark.read.format("statestore").load(str(tmp_path / "cp"))
    assert {r.entity_id for r in state.select("key.entity_id").collect()} <= {"w"}


def test_stream_equals_batch_up_to_the_watermark(spark, run_reached):
    commands = [(e, "UP", t) for e in "abc" for t in range(0, 200, 17)]
    statuses = [(e, s, t) for e, s, k in (("a", "up", 23), ("b", "UP", 41), ("c", "DOWN", 5)) for t in range(3, 200, k)]
    got = {}
    for i in range(0, 200, 40):
        got = run_reached([c for c in commands if i <= c[2] < i + 40], [s for s in statuses if i <= s[2] < i + 40])
    sides = (
        spark.createDataFrame([("f", e, s, at(t)) for e, s, t in commands], COMMANDS),
        spark.createDataFrame([("f", e, s, at(t)) for e, s, t in statuses], STATUSES),
    )
    watermark = min(max(c[2] for c in commands), max(s[2] for s in statuses)) - 5
    want = {}
    for r in reached_state(*sides, 10).collect():
        second, reached = (r.ts - T).seconds, r.reached_ts and (r.reached_ts - T).seconds
        known = (reached if r.reached else second + 10) <= watermark
        want[(r.entity_id, second)] = (("reached" if r.reached else "missed"), reached) if known else ("open", None)
    assert got == want


def test_a_batch_repeated_after_a_kill_changes_nothing(spark, rows, tmp_path, monkeypatch):
    base, checkpoint = str(tmp_path), str(tmp_path / "cp")
    spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], SPEC.ddl()).coalesce(1).write.orc(tables.stage_path(base, SPEC))
    real = streams.merge_delta

    def killed(*args):
        real(*args)
        raise RuntimeError("killed after the merge, before the batch counts")

    monkeypatch.setattr(streams, "merge_delta", killed)
    with pytest.raises(Exception, match="killed"):
        streams.stream_ingest(spark, base, SPEC, checkpoint, F.lit(T), max_files=1).awaitTermination()
    files = {r.file_path for r in tables.current_table(spark, base, SPEC).files().collect()}
    written = []
    monkeypatch.setattr(streams, "merge_delta", lambda *args: written.append(real(*args)))
    streams.stream_ingest(spark, base, SPEC, checkpoint, F.lit(at(9)), max_files=1).awaitTermination()
    current = tables.current_table(spark, base, SPEC)
    assert written == [[]] and {r.file_path for r in current.files().collect()} == files
    assert rows(current.read(), "id", "v", "watermark") == [(None, "c", T), (1, "a", T), (2, "b", T)]


def test_first_in_window_equals_the_plain_search(spark):
    within, length = 10_000_000, 10_000_000 * streams.SLOT_WINDOWS
    # Times at, before and behind the borders of slots and windows, for one busy entity, one without an id and one without a state.
    base = 1_704_067_200_000_000 // length * length
    times = sorted({base + k * length + d for k in range(3) for d in (-within, -1, 0, 1, within - 1, within, within + 1)})
    events = [("f", e, s, s, t, c) for e, s in (("a", "up"), (None, "up"), ("a", None)) for t in times for c in (True, False)]
    events = [row for i, row in enumerate(events) if i % 7]
    columns = ["flow_id", "entity_id", "state_key", "target_state", "ts", "is_command"]
    made = spark.createDataFrame(events, "flow_id string, entity_id string, state_key string, target_state string, ts bigint, is_command boolean")
    found = streams.first_in_window(made.withColumn("ts", F.timestamp_micros("ts")), within)
    assert found.columns == [*columns, "first_ts"]
    got = {(r.entity_id, r.state_key, r.is_command, r.at): r.first for r in found.select("*", F.unix_micros("ts").alias("at"), F.unix_micros("first_ts").alias("first")).collect()}
    want = {}
    for _, e, s, _, t, c in events:
        seen = [u for _, f, k, _, u, d in events if not d and (f, k) == (e, s) and t <= u <= t + within]
        want[e, s, c, t] = min(seen, default=None) if c and s is not None else None
    assert got == want and found.count() == len(events)


def test_reached_runs_no_python_per_entity_and_repeats_a_batch(spark, rows, tmp_path, capsys):
    commands, add_command = feed(spark, tmp_path, "commands", COMMANDS)
    statuses, add_status = feed(spark, tmp_path, "statuses", STATUSES)
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")

    def run():
        query = streams.stream_reached_state(commands, statuses, 10, 5, out, checkpoint)
        query.awaitTermination()
        query.explain()
        told = rows(streams.read_reached_state(spark, out)), rows(streams.read_open_commands(spark, checkpoint))
        return told, capsys.readouterr().out

    add_command([("f", "a", "UP", at(0)), ("f", "b", "up", at(30))])
    add_status([("f", "a", "up", at(4)), ("f", "c", "up", at(40))])
    told, plan = run()
    assert told == ([("f", "a", "UP", at(0), at(4), True)], [("f", "b", "up", at(30))])
    assert "Deduplicate" in plan and "Pandas" not in plan and "Python" not in plan
    # Killed before the first batch counted: it is repeated, and gives no answer twice.
    for name in [p for p in (tmp_path / "cp" / "commits").iterdir()]:
        name.unlink()
    assert run()[0] == told
