"""Continuous forms of the ingestion, latest-state and reached-state jobs."""

from __future__ import annotations

import contextlib
from collections.abc import Callable, Iterator
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from flowline.operators.catalog import TableSpec
from flowline.operators.merge import stage_to_delta
from flowline.operators.status import latest_per_entity
from flowline.plans.ingestion import merge_delta
from flowline.session import cut_lineage, scratch_path, scratch_scope
from flowline.sources.tables import PathStore, stage_path


def _trigger(every: str | None) -> dict:
    """All that is there now, or a repeating trigger."""
    return {"availableNow": True} if every is None else {"processingTime": every}


# -- ingestion ------------------------------------------------------------------


def stream_ingest(
    spark: SparkSession,
    base: str,
    spec: TableSpec,
    checkpoint: str,
    as_of: Column | None = None,
    on_duplicate: str = "error",
    every: str | None = None,
    max_files: int = 1000,
) -> StreamingQuery:
    """Merges whatever arrives in the staging directory into the current table.

    A batch writes the parts in which it changes a row. Merging is idempotent, so
    a batch repeated after a failure finds nothing left to change and writes
    nothing; parts whose exchange did not end are put in place when the stream
    starts again.
    """
    store = PathStore(spark, base, spec)

    def merge(batch: DataFrame, _: int) -> None:
        delta = stage_to_delta(batch, spec, as_of)
        with scratch_scope(spark, f"stream-{spec.name}"):
            merge_delta(store, cut_lineage(delta, "batch"), as_of, on_duplicate)

    staged = spark.readStream.schema(spec.ddl()).option("maxFilesPerTrigger", max_files).orc(stage_path(base, spec))
    writer = staged.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return writer.trigger(**_trigger(every)).start()


# -- keyed state ----------------------------------------------------------------

_STORE = "spark.sql.streaming.stateStore.providerClass"
_PACKAGE = "org.apache.spark.sql.execution.streaming.state."


@contextlib.contextmanager
def _state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB, not in memory, unless the session names a store of its own."""
    chosen = spark.conf.get(_STORE)
    if chosen.endswith(".HDFSBackedStateStoreProvider"):
        spark.conf.set(_STORE, f"{_PACKAGE}RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(_STORE, chosen)


# -- latest state ---------------------------------------------------------------


def stream_latest_state(
    statuses: DataFrame,
    checkpoint: str,
    every: str | None = None,
    changed: Callable[[DataFrame, int], None] | None = None,
) -> StreamingQuery:
    """Keeps the newest row per entity in the engine's keyed state, below ``checkpoint``.

    A batch reads and writes the state of its own entities only.
    ``changed(rows, batch_id)`` gets the entities of each batch with their newest
    rows; a batch that is repeated after a failure is given to it again.
    """
    writer = latest_per_entity(statuses).writeStream.outputMode("update").option("checkpointLocation", checkpoint)
    writer = writer.format("noop") if changed is None else writer.foreachBatch(changed)
    with _state_on_disk(statuses.sparkSession):
        return writer.trigger(**_trigger(every)).start()


def read_latest_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The newest row per entity as of the stream's last finished batch, from its state."""
    state = spark.read.format("statestore").load(checkpoint)
    return state.select("key.*", "value.valueWithExtremumOrdering.*")


# -- reached state --------------------------------------------------------------

COMMAND = ["flow_id", "entity_id", "target_state", "ts"]
_KEY = ["flow_id", "entity_id", "state_key"]
_EVENT = "flow_id string, entity_id string, state_key string, target_state string, ts timestamp, is_command boolean"
_ANSWER = "flow_id string, entity_id string, target_state string, ts timestamp, reached_ts timestamp, reached boolean"

#: Length of a time slot of an entity, in windows. A shorter one spreads a busy entity over more of them; a status
#: that lies less than a window behind the start of its slot goes to the slot before as well.
SLOT_WINDOWS = 16


def _folder_system(spark: SparkSession, folder: str):
    """A folder's path and its file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    """The batches that have an entry in ``folder``, ascending."""
    path, system = _folder_system(spark, folder)
    names = [entry.getPath().getName() for entry in system.listStatus(path)] if system.exists(path) else []
    return sorted(int(name) for name in names if name.isdigit())


def _waiting_path(checkpoint: str) -> str:
    return f"{checkpoint}/waiting"


def first_in_window(events: DataFrame, within: int) -> DataFrame:
    """``events``, each once, with ``first_ts``: of a command its first status in the ``within`` microseconds from its time on.

    Keys may be null, except for the state. No pairs are formed: per entity,
    state and time slot the newest event comes first, and the last status seen
    is the earliest one that is not before a command.
    """
    at, length = F.unix_micros("ts"), within * SLOT_WINDOWS
    slot = F.floor(at / F.lit(length))
    early = ~F.col("is_command") & (at - slot * length <= within)
    dealt = events.withColumn("own_slot", slot).withColumn("slot", F.explode(F.when(early, F.array(slot, slot - 1)).otherwise(F.array(slot))))
    later = Window.partitionBy(*_KEY, "slot").orderBy(F.col("ts").desc(), "is_command").rowsBetween(Window.unboundedPreceding, 0)
    following = F.last(F.when(~F.col("is_command"), F.col("ts")), ignorenulls=True).over(later)
    in_time = F.col("is_command") & F.col("state_key").isNotNull() & (F.unix_micros("following") - at <= within)
    found = dealt.withColumn("following", following).filter("slot = own_slot")
    return found.select(*events.columns, F.when(in_time, F.col("following")).alias("first_ts"))


def stream_reached_state(
    commands: DataFrame,
    statuses: DataFrame,
    within_seconds: float,
    delay_seconds: float,
    out: str,
    checkpoint: str,
    every: str | None = None,
) -> StreamingQuery:
    """Answers every command once, as soon as no status to come can change the answer.

    The engine's keyed state lets each event pass once and drops rows behind the
    watermark, ``delay_seconds`` behind the slower stream, and rows without a
    time; :func:`command_outcomes` tells which commands that concerns. A batch
    joins what waits from the batches before: the commands without an answer and
    the statuses the watermark has not passed, which later commands may ask for.
    It answers the commands of which the watermark has passed the first status
    in their window, or the window itself, and writes what waits now. Both are
    stored by the number of the batch, so a batch repeated after a failure
    writes the same again.
    """
    spark, within, delay = commands.sparkSession, max(1, round(within_seconds * 1_000_000)), int(delay_seconds * 1000)
    asked = commands.withWatermark("ts", f"{delay} milliseconds").select(
        "flow_id", "entity_id", F.lower("target_state").alias("state_key"), "target_state", "ts", F.lit(True).alias("is_command")
    )
    reported = statuses.withWatermark("ts", f"{delay} milliseconds").select(
        "flow_id", "entity_id", F.lower("state").alias("state_key"), F.lit(None).cast("string").alias("target_state"), "ts",
        F.lit(False).alias("is_command"),
    )
    events = asked.unionByName(reported).filter("ts IS NOT NULL").dropDuplicates()

    def answer(batch: DataFrame, number: int) -> None:
        with scratch_scope(spark, "stream-reached"):
            path = scratch_path(spark, "batch")
            batch.write.parquet(path)
            arrived = spark.read.schema(_EVENT).parquet(path)
            if arrived.isEmpty():
                return
            folder = _waiting_path(checkpoint)
            before = [n for n in _numbers(spark, folder) if n < number]
            rows = arrived.withColumn("newest", F.lit(False))
            if before:
                rows = rows.unionByName(spark.read.schema(rows.schema).parquet(f"{folder}/{before[-1]}"))
            # The newest time of either stream is kept as a row of its own.
            newest = rows.groupBy("is_command").agg(F.max("ts").alias("ts"))
            passed = newest.agg(F.min(F.unix_millis("ts")).alias("ts"), F.count(F.lit(1)).alias("streams")).first()
            watermark = max(0, passed.ts - delay) * 1000 if passed.streams == 2 else 0
            window_end = F.unix_micros("ts") + F.when(F.col("is_command"), within).otherwise(0)
            known = F.coalesce(F.unix_micros("first_ts"), window_end) <= watermark
            told = first_in_window(rows.filter("NOT newest").drop("newest"), within)
            told = cut_lineage(told.withColumn("known", known), "told")
            answers = told.filter("is_command AND known").select(
                "flow_id", "entity_id", "target_state", "ts", F.col("first_ts").alias("reached_ts"),
                F.col("first_ts").isNotNull().alias("reached"),
            )
            answers.write.mode("overwrite").parquet(f"{out}/batch={number}")
            marks = newest.select(
                *[F.lit(None).cast("string").alias(c) for c in ("flow_id", "entity_id", "state_key", "target_state")], "ts",
                "is_command", F.lit(True).alias("newest"),
            )
            left = told.filter("NOT known").select(*arrived.columns, F.lit(False).alias("newest"))
            left.unionByName(marks).write.mode("overwrite").parquet(f"{folder}/{number}")
            for old in before[:-1]:
                old_path, system = _folder_system(spark, f"{folder}/{old}")
                system.delete(old_path, True)

    spark.createDataFrame([], _ANSWER).write.mode("append").parquet(out)
    writer = events.writeStream.foreachBatch(answer).option("checkpointLocation", checkpoint)
    with _state_on_disk(spark):
        return writer.outputMode("append").trigger(**_trigger(every)).start()


def read_reached_state(spark: SparkSession, out: str) -> DataFrame:
    """One row per answered command: the first status in its window, and whether there was one."""
    return spark.read.schema(f"{_ANSWER}, batch bigint").parquet(out).drop("batch")


def read_open_commands(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The commands that wait for their answer as of the stream's last finished batch."""
    finished = max(_numbers(spark, f"{checkpoint}/commits"), default=-1)
    stored = [n for n in _numbers(spark, _waiting_path(checkpoint)) if n <= finished]
    if not stored:
        return spark.createDataFrame([], _EVENT).select(*COMMAND)
    waiting = spark.read.schema(f"{_EVENT}, newest boolean").parquet(f"{_waiting_path(checkpoint)}/{stored[-1]}")
    return waiting.filter("is_command AND NOT newest").select(*COMMAND)


def command_outcomes(commands: DataFrame, answers: DataFrame, waiting: DataFrame) -> DataFrame:
    """Every command with what became of it: reached, missed, open, or late.

    ``answers`` and ``waiting`` are what :func:`read_reached_state` and
    :func:`read_open_commands` give. A command the stream has read and that is in
    neither came behind the watermark and was dropped: it is late.
    """
    answered = answers.withColumn("outcome", F.when(F.col("reached"), "reached").otherwise("missed")).drop("reached")
    still_open = waiting.select(*COMMAND, F.lit(None).cast("timestamp").alias("reached_ts"), F.lit("open").alias("outcome"))
    known = answered.unionByName(still_open)
    keyed = known.select(*[F.col(c).alias(f"a_{c}") for c in COMMAND], "reached_ts", "outcome")
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"a_{c}")) for c in COMMAND])
    outcome = F.coalesce("outcome", F.lit("late")).alias("outcome")
    return commands.join(keyed, same, "left").select(*commands.columns, "reached_ts", outcome)
