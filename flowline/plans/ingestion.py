"""Ingestion jobs: prepare the tables of an object, run its pipeline, compact the result."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowline.operators.catalog import TableSpec
from flowline.operators.merge import (
    changes_of,
    high_water_marks,
    incoming_rows,
    inserted_rows,
    merge_report,
    part_of,
    read_source_incremental,
    stage_to_delta,
    updated_rows,
)
from flowline.session import cut_lineage, scratch_scope
from flowline.sources import tables


@dataclass(frozen=True)
class IngestionRequest:
    """One table to ingest: where its extract comes from and how far it was read."""

    spec: TableSpec
    source: Callable[[SparkSession], DataFrame]
    max_cols: Sequence[str] = ()
    high_water: Mapping[str, object] = field(default_factory=dict)
    on_duplicate: str = "error"


def prepare_tables(spark: SparkSession, specs: Sequence[TableSpec], database: str, base: str) -> DataFrame:
    """Creates staging, delta and current tables; returns all rendered statements."""
    rows = []
    for spec in specs:
        rows += [(spec.name, name, sql) for name, sql in tables.create_tables(spark, spec, database, base).items()]
    return spark.createDataFrame(rows, "table_name string, statement string, sql string")


class IngestionFailed(Exception):
    """Some tables failed: ``errors`` by table; ``done`` is the result of the others."""

    def __init__(self, done: dict[str, dict], errors: dict[str, BaseException]):
        super().__init__("; ".join(f"{name}: {error}" for name, error in errors.items()))
        self.done, self.errors = done, errors


def run_ingestion(
    spark: SparkSession,
    requests: Sequence[IngestionRequest],
    base: str,
    as_of: Column | None = None,
    database: str | None = None,
    side_by_side: int = 4,
) -> dict[str, dict]:
    """Runs the pipeline for every requested table, up to ``side_by_side`` of them at a time.

    Replace what is staged by what is new, insert the delta, merge, truncate
    the delta, clear the stage. Tables are folders below ``base`` or the
    prepared tables of ``database``; a merge rewrites the parts of them in which
    a row changes. Each table runs in a scheduler pool of its name, which
    matters where the cluster schedules fairly. Returns per table the parts
    written and the next high-water marks; if tables fail, the others are
    finished first and :class:`IngestionFailed` tells of both.
    """

    def one(request: IngestionRequest) -> dict:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", request.spec.name)
        return _ingest(spark, request, base, as_of, database)

    if len({request.spec.name for request in requests}) < len(requests):
        side_by_side = 1  # runs of one table follow each other
    done: dict[str, dict] = {}
    errors: dict[str, BaseException] = {}
    with ThreadPoolExecutor(max(1, side_by_side)) as pool:
        runs = [(r.spec.name, pool.submit(inheritable_thread_target(spark)(one), r)) for r in requests]
        for name, run in runs:
            error = run.exception()
            if error is None:
                done[name] = run.result()
            else:
                errors[name] = error
    if errors:
        raise IngestionFailed(done, errors) from next(iter(errors.values()))
    return done


def _ingest(
    spark: SparkSession, request: IngestionRequest, base: str, as_of: Column | None, database: str | None
) -> dict:
    spec = request.spec
    store = tables.open_store(spark, base, spec, database)
    extract = read_source_incremental(request.source(spark), request.max_cols, request.high_water)
    tables.stage(extract, base, spec)
    staged = tables.read_stage(spark, base, spec)
    store.insert_delta(stage_to_delta(staged, spec, as_of))
    marks = dict(request.high_water)
    if request.max_cols:
        newest = high_water_marks(staged, request.max_cols).first().asDict()
        marks.update({c: v for c, v in newest.items() if v is not None})
    with scratch_scope(spark, f"ingest-{spec.name}"):
        written = merge_delta(store, store.read_delta(), as_of, request.on_duplicate)
    store.truncate_delta()
    tables.clear_stage(spark, base, spec)
    return {"written": written, "high_water": marks}


def _stored_bytes(df: DataFrame) -> int:
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def _distinct_parts(df: DataFrame, parts: int) -> list[int]:
    return sorted(r.part for r in df.select(part_of("merge_key", parts).alias("part")).distinct().collect())


def merge_delta(
    store: tables.PathStore | tables.CatalogStore,
    delta: DataFrame,
    as_of: Column | None = None,
    on_duplicate: str = "error",
    part_bytes: int = tables.PART_BYTES,
) -> list[int]:
    """Merges ``delta`` into the store's current table; returns the parts written, none if nothing changes.

    The parts in which the delta's keys lie are asked for keys and checksums
    only. What is inserted or updated is written down; the parts that hold some
    of it are read whole and replaced. The first merge deals the table into
    parts of about ``part_bytes``, :func:`compact` deals a grown one anew.
    """
    spec, current = store.spec, store.current
    incoming = incoming_rows(delta, spec, on_duplicate)
    parts = current.parts()
    if parts is None:
        changes = incoming.withColumn("action", F.lit("insert"))
        parts = tables.parts_for(_stored_bytes(incoming), part_bytes)
    else:
        met = current.rows(_distinct_parts(incoming, parts))
        changes = cut_lineage(changes_of(met, incoming), f"changes-{spec.name}")
    written = _distinct_parts(changes, parts)
    if written:
        # A bucket's inserts are brought together; rows that are there already stay where they are.
        new = inserted_rows(changes, spec, as_of).hint("rebalance", spec.buckets, "merge_key")
        new = new.withColumn("part", part_of("merge_key", parts))
        current.replace(updated_rows(current.rows(written), changes, spec, as_of).unionByName(new), parts)
    return written


def merge_preview(
    spark: SparkSession, base: str, spec: TableSpec, on_duplicate: str = "error", database: str | None = None
) -> DataFrame:
    """What merging the waiting delta would insert, update and keep."""
    store = tables.open_store(spark, base, spec, database)
    return merge_report(store.read(), store.read_delta(), spec, on_duplicate)


def compact(
    spark: SparkSession,
    base: str,
    spec: TableSpec,
    database: str | None = None,
    least_files: int = 8,
    share: float = 0.5,
    part_bytes: int = tables.PART_BYTES,
) -> list[int]:
    """Rewrites the parts that lie in too many files; returns these.

    In each bucket of a part the largest file counts as its body and the others
    as what has been added. A part is rewritten when that is ``least_files``
    files or more, or ``share`` of its bytes; large files with little beside
    them stay untouched. A table whose parts have grown to twice ``part_bytes``
    is dealt anew into parts of that size, all of it.
    """
    current = tables.open_store(spark, base, spec, database).current
    parts = current.parts()
    if parts is None:
        return []
    per_bucket = current.files().groupBy("part", "bucket").agg(
        F.count("*").alias("files"), F.sum("file_size").alias("bytes"), F.max("file_size").alias("body")
    )
    # One row per part, of which there are as many as their size asks for.
    sizes = per_bucket.groupBy("part").agg(
        F.sum(F.col("files") - 1).alias("added"), F.sum("bytes").alias("bytes"), F.sum(F.col("bytes") - F.col("body")).alias("more")
    ).collect()
    wanted = tables.parts_for(sum(r.bytes for r in sizes), part_bytes)
    if wanted >= 2 * parts:
        dealt = current.rows().withColumn("part", part_of("merge_key", wanted))
        current.replace(dealt.hint("rebalance", spec.buckets, current.bucket_column), wanted)
        return list(range(wanted))
    chosen = sorted(r.part for r in sizes if r.added and (r.added >= least_files or r.more >= share * r.bytes))
    if chosen:
        current.replace(current.rows(chosen).hint("rebalance", spec.buckets, current.bucket_column), parts)
    return chosen
