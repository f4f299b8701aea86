"""Staging extract -> delta -> keyed merge into the current-state table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowline.functions import audit_time, key_value, row_checksum
from flowline.functions.scalars import ZERO_DEFAULT_TYPES
from flowline.operators.catalog import TableSpec
from flowline.operators.keys import distinct_apart, group_apart
from flowline.session import cut_lineage


def read_source_incremental(
    df: DataFrame,
    max_cols: Sequence[str],
    high_water: Mapping[str, object],
    order_cols: Sequence[str] = (),
) -> DataFrame:
    """Source rows that may be new since the stored maxima, ordered by key.

    A row counts if any max-value column is at or past its stored maximum, or
    null: rows that share the maximum may have come later, and of a null nobody
    knows. The merge is idempotent, so meeting a row again changes nothing. A
    column without a stored maximum has only been null so far and counts where
    it is not; before the first maximum everything is read. All of it is plain
    comparisons, so it is pushed to parquet, ORC or JDBC scans.
    """
    seen = {c: high_water.get(c) for c in max_cols}
    if any(v is not None for v in seen.values()):
        new = [
            F.col(c).isNotNull() if v is None else (F.col(c) >= F.lit(v)) | F.col(c).isNull() for c, v in seen.items()
        ]
        df = df.filter(reduce(or_, new))
    return df.orderBy(*order_cols) if order_cols else df


def high_water_marks(df: DataFrame, max_cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(*[F.max(c).alias(c) for c in max_cols])


def stage_to_delta(stg: DataFrame, spec: TableSpec, as_of: Column | None = None, sep: str = "") -> DataFrame:
    """Distinct staged rows with checksum and watermark.

    The distinct runs before the two audit columns are added: they depend on
    the row alone, and the shuffle stays narrower.
    """
    rows = stg.select(*spec.column_names).distinct()
    return rows.select(
        "*", row_checksum(spec.column_names, sep).alias("checksum"), audit_time(as_of).alias("watermark")
    )


def merge_key(spec: TableSpec, row: str = "") -> Column:
    """The null-safe key as one column: rows merge where it is equal.

    A single key keeps its own type, several become a text in which each is led
    by its length, so that no two keys look alike. ``row`` names a struct that
    holds the columns.
    """
    keys = [key_value(F.col(row + key), spec.type_of(key)) for key in spec.keys]
    if len(keys) == 1:
        return keys[0]
    texts = [key.cast("string") for key in keys]
    return F.concat(*[part for text in texts for part in (F.length(text).cast("string"), F.lit(":"), text)])


def merge_key_type(spec: TableSpec) -> str:
    kind = spec.type_of(spec.keys[0]).strip().lower()
    return kind if len(spec.keys) == 1 and kind in ZERO_DEFAULT_TYPES else "string"


def part_of(key: Column | str, parts: int) -> Column:
    """The part of a table of ``parts`` parts in which a merge key lies."""
    return F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")


def _key_names(spec: TableSpec) -> list[str]:
    return [f"_key{i}" for i in range(len(spec.keys))]


def _with_keys(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Adds null-free copies of the key columns, so the joins stay plain equi joins."""
    return df.withColumns(
        {alias: key_value(key, spec.type_of(key)) for alias, key in zip(_key_names(spec), spec.keys)}
    )


def _delta_by_key(delta: DataFrame, spec: TableSpec, on_duplicate: str) -> DataFrame:
    """One delta row per key as struct ``d``, written out.

    Different rows for one key either fail the job ("error") or the one with
    the newest watermark wins ("latest", checksum as tie break). Copies of one
    row, as a repeated insert leaves them, are no conflict. The merge reads the
    result three times; from the written form it knows the exact size, on which
    Spark decides whether to broadcast it.
    """
    if on_duplicate not in ("error", "latest"):
        raise ValueError(f"on_duplicate must be 'error' or 'latest', not {on_duplicate!r}")
    keys = _key_names(spec)
    row = F.struct(*[F.col(c) for c in [*spec.column_names, "checksum"]])
    grouped = _with_keys(delta, spec).groupBy(*keys).agg(
        F.max_by(row, F.struct("watermark", "checksum")).alias("d"),
        (F.min("checksum") != F.max("checksum")).alias("differ"),
    )
    if on_duplicate == "error":
        shown = F.concat_ws(", ", *[F.col(k).cast("string") for k in keys])
        failure = F.raise_error(F.concat(F.lit(f"duplicate delta key for {spec.name}: "), shown))
        checked = F.when(F.col("differ"), failure.cast("string")).otherwise(F.col("d.checksum"))
        grouped = grouped.withColumn("d", F.col("d").withField("checksum", checked))
    return cut_lineage(grouped.select(*keys, "d"), f"delta-{spec.name}")


def _classified(target: DataFrame, delta: DataFrame, spec: TableSpec, on_duplicate: str):
    """Target rows with their delta row and action, and the delta rows to insert.

    Deliberately not one full outer join: that can neither broadcast the delta
    nor split a hot key. The left join broadcasts a delta that is small enough
    by Spark's own size check, so the target is not shuffled at all, and is
    split on the target side by adaptive skew handling otherwise. Unmatched
    delta rows need only the target's key columns, reduced to the keys that
    occur in the delta.
    """
    keys = _key_names(spec)
    incoming = _delta_by_key(delta, spec, on_duplicate)
    current = _with_keys(target, spec)
    changed = F.col("checksum") != F.col("d.checksum")  # null on either side: no update
    existing = current.join(incoming, keys, "left").withColumn(
        "action",
        F.when(F.col("d").isNull(), "keep").when(changed, "update").otherwise("same"),
    )
    known = distinct_apart(current.select(*keys).join(incoming.select(*keys), keys, "left_semi"), *keys)
    inserted = incoming.join(known, keys, "left_anti").withColumn("action", F.lit("insert"))
    return existing, inserted


def merge_current(
    target: DataFrame,
    delta: DataFrame,
    spec: TableSpec,
    as_of: Column | None = None,
    on_duplicate: str = "error",
    with_action: bool = False,
) -> DataFrame:
    """The next state of ``target`` after merging ``delta`` by null-safe keys.

    Matched rows whose checksum differs take the delta's values and the current
    time, but never a new value of the cluster column; unmatched delta rows are
    inserted; everything else is kept as it is.
    """
    existing, inserted = _classified(target, delta, spec, on_duplicate)
    updated = F.col("action") == "update"
    now = audit_time(as_of)

    def pick(name: str) -> Column:
        if spec.clustered_by and name.lower() == spec.clustered_by.lower():
            return F.col(name)
        return F.when(updated, F.col(f"d.{name}")).otherwise(F.col(name)).alias(name)

    extra = ["action"] if with_action else []
    columns = [*spec.column_names, "checksum"]
    after = existing.select(
        *[pick(c) for c in columns],
        F.when(updated, now).otherwise(F.col("watermark")).alias("watermark"),
        *extra,
    )
    new = inserted.select(*[F.col(f"d.{c}").alias(c) for c in columns], now.alias("watermark"), *extra)
    return after.unionByName(new)


def merge_actions(
    target: DataFrame, delta: DataFrame, spec: TableSpec, on_duplicate: str = "error"
) -> DataFrame:
    """Key columns and what the merge does with them: insert, update, same or keep."""
    existing, inserted = _classified(target, delta, spec, on_duplicate)
    return existing.select(*spec.keys, "action").unionByName(
        inserted.select(*[F.col(f"d.{k}").alias(k) for k in spec.keys], "action")
    )


def merge_report(
    target: DataFrame, delta: DataFrame, spec: TableSpec, on_duplicate: str = "error"
) -> DataFrame:
    return merge_actions(target, delta, spec, on_duplicate).groupBy("action").agg(F.count("*").alias("n"))


# -- merging into a stored table ------------------------------------------------


def incoming_rows(delta: DataFrame, spec: TableSpec, on_duplicate: str = "error") -> DataFrame:
    """One delta row per merge key, written out: merge_key and the row as struct ``d``."""
    return _delta_by_key(delta, spec, on_duplicate).select(merge_key(spec, "d.").alias("merge_key"), "d")


def changes_of(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """The incoming rows that change anything: merge_key, d and action, insert or update.

    Of ``stored`` only merge_key and checksum are read, and it is not shuffled
    while the incoming keys are small enough for a broadcast or its buckets are
    by merge_key. Rows that are known already are left out, so that meeting them
    again costs no write.
    """
    sums = incoming.select("merge_key", F.col("d.checksum").alias("_new"))
    met = stored.select("merge_key", "checksum").join(sums, "merge_key")
    # A null checksum on either side is no change.
    known = group_apart(met, ["merge_key"], F.max(F.col("checksum") != F.col("_new")).alias("_changed"), F.lit(1).alias("_known"))
    action = F.when(F.col("_known").isNull(), "insert").when(F.col("_changed"), "update")
    return incoming.join(known, "merge_key", "left").select("merge_key", "d", action.alias("action")).filter("action IS NOT NULL")


def updated_rows(stored: DataFrame, changes: DataFrame, spec: TableSpec, as_of: Column | None = None) -> DataFrame:
    """``stored`` with the updates among ``changes`` applied, by :func:`merge_current`'s rules; the other columns stay."""
    updates = changes.filter("action = 'update'").select("merge_key", "d")
    changed = F.coalesce(F.col("checksum") != F.col("d.checksum"), F.lit(False))
    fixed = (spec.clustered_by or "").lower()
    new = {c: F.col(f"d.{c}") for c in [*spec.column_names, "checksum"] if c.lower() != fixed}
    new["watermark"] = audit_time(as_of)
    picked = [F.when(changed, new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in stored.columns]
    return stored.join(updates, "merge_key", "left").select(*picked)


def inserted_rows(changes: DataFrame, spec: TableSpec, as_of: Column | None = None) -> DataFrame:
    """The inserts among ``changes`` as rows of the table, with their merge_key."""
    columns = [F.col(f"d.{c}").alias(c) for c in [*spec.column_names, "checksum"]]
    return changes.filter("action = 'insert'").select(*columns, audit_time(as_of).alias("watermark"), "merge_key")
