"""Staging, delta and current tables of the ingestion jobs."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowline.functions.scalars import ZERO_DEFAULT_TYPES
from flowline.operators.catalog import AUDIT_COLUMNS, TableSpec
from flowline.operators.merge import merge_key, merge_key_type, part_of


def stage_path(base: str, spec: TableSpec) -> str:
    return f"{base.rstrip('/')}/stg_{spec.name}"


def stage(df: DataFrame, base: str, spec: TableSpec) -> str:
    """Overwrites the staging directory with an extract."""
    path = stage_path(base, spec)
    df.select(*spec.column_names).write.mode("overwrite").orc(path)
    return path


def read_stage(spark: SparkSession, base: str, spec: TableSpec) -> DataFrame:
    return spark.read.schema(spec.ddl()).orc(stage_path(base, spec))


def clear_stage(spark: SparkSession, base: str, spec: TableSpec) -> None:
    spark.createDataFrame([], spec.ddl()).write.mode("overwrite").orc(stage_path(base, spec))


def delta_path(base: str, spec: TableSpec) -> str:
    return f"{base.rstrip('/')}/{spec.name}_delta"


def insert_delta(delta: DataFrame, base: str, spec: TableSpec) -> None:
    delta.write.mode("append").orc(delta_path(base, spec))


def read_delta(spark: SparkSession, base: str, spec: TableSpec) -> DataFrame:
    return spark.read.schema(spec.ddl(audit=True)).orc(delta_path(base, spec))


def truncate_delta(spark: SparkSession, base: str, spec: TableSpec) -> None:
    spark.createDataFrame([], spec.ddl(audit=True)).write.mode("overwrite").orc(delta_path(base, spec))


#: Stored bytes of a part of a current table. A merge rewrites the parts that hold a change.
PART_BYTES = 1 << 30

#: The database for tables that are known by their folder only.
FOLDER_TABLES = "flowline"


def parts_for(stored_bytes: int, part_bytes: int = PART_BYTES) -> int:
    return max(1, -(-stored_bytes // part_bytes))


class CurrentTable:
    """The current state of an object: a catalog table partitioned by a hash of the merge key.

    A merge replaces the partitions in which a row changes, by Spark's dynamic
    partition overwrite; the others are not touched. The partition column
    ``parts`` says into how many parts the table is dealt, ``part`` which one it
    is. Rows that replace others are first written beside the table: a run that
    dies while Spark exchanges the partitions is finished by the next one that
    opens the table.

    A table known by its folder also stores its merge key and is bucketed and
    sorted by it, so that a join on it shuffles the other side only.
    """

    def __init__(self, spark: SparkSession, spec: TableSpec, name: str, by_key: bool):
        self.spark, self.spec, self.name, self.by_key = spark, spec, name, by_key
        self.columns = [*spec.column_names, *(name for name, _ in AUDIT_COLUMNS)]
        self.stored = [*self.columns, *(["merge_key"] if by_key else []), "parts", "part"]
        self.bucket_column = "merge_key" if by_key else spec.bucket_column
        self.path = next(r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect() if r.col_name == "Location")
        self.following = f"{self.path.rstrip('/')}__next"
        self._hadoop().mkdirs(self._hadoop_path(self.path))
        self._learn_partitions()
        if self._hadoop().exists(self._hadoop_path(f"{self.following}/_SUCCESS")):
            self._exchange()

    def _hadoop_path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _hadoop(self):
        return self._hadoop_path(self.path).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _deal(self) -> dict[int, list[int]]:
        """The parts there are, by the number of parts they are dealt into: one such number, save while it changes."""
        found: dict[int, list[int]] = {}
        for row in self.spark.sql(f"SHOW PARTITIONS {self.name}").collect():
            values = dict(item.split("=") for item in row.partition.split("/"))
            found.setdefault(int(values["parts"]), []).append(int(values["part"]))
        return found

    def parts(self) -> int | None:
        """Into how many parts the table is dealt; None before the first rows."""
        return next(iter(self._deal()), None)

    def rows(self, parts: Sequence[int] | None = None) -> DataFrame:
        """The rows, or those of some parts, with their merge_key and part."""
        rows = self.spark.table(self.name)
        if parts is not None:
            rows = rows.filter(F.col("part").isin(list(parts)))
        key = "merge_key" if self.by_key else merge_key(self.spec).alias("merge_key")
        return rows.select(*self.columns, key, "part")

    def read(self, parts: Sequence[int] | None = None) -> DataFrame:
        return self.rows(parts).select(*self.columns)

    def replace(self, rows: DataFrame, parts: int) -> None:
        """Replaces the parts in which ``rows`` lie; ``rows`` are those of :meth:`rows`, dealt into ``parts`` parts.

        A number of parts other than the table's replaces the whole table.
        """
        dealt = rows.withColumn("parts", F.lit(parts)).select(*self.columns, "merge_key", "parts", "part")
        dealt.write.mode("overwrite").partitionBy("parts", "part").orc(self.following)
        self._exchange()

    def _exchange(self) -> None:
        schema = f"{self.spec.ddl(audit=True)}, merge_key {merge_key_type(self.spec)}, parts int, part int"
        rows = self.spark.read.schema(schema).orc(self.following).select(*self.stored)
        if not self.by_key:
            rows = rows.hint("rebalance", self.spec.buckets, self.bucket_column)
        rows.write.insertInto(self.name, overwrite=True)
        statuses = self._hadoop().listStatus(self._hadoop_path(self.following))
        new = {f.getPath().getName() for f in statuses if f.getPath().getName().startswith("parts=")}
        self._drop([f"parts={old}" for old in self._deal() if new and f"parts={old}" not in new])
        self._hadoop().delete(self._hadoop_path(self.following), True)

    def _drop(self, folders: Sequence[str]) -> None:
        for folder in folders:
            self._hadoop().delete(self._hadoop_path(f"{self.path}/{folder}"), True)
        if folders:
            self._learn_partitions()

    def _learn_partitions(self) -> None:
        self.spark.sql(f"MSCK REPAIR TABLE {self.name} SYNC PARTITIONS")

    def overwrite(self, df: DataFrame, parts: int | None = None) -> None:
        """Makes ``df`` the table's content: its columns with audit columns, dealt into ``parts`` parts."""
        parts = parts or self.parts() or 1
        rows = df.select(*self.columns, merge_key(self.spec).alias("merge_key"))
        gone = self._deal().get(parts, [])
        self.replace(rows.withColumn("part", part_of("merge_key", parts)), parts)
        if gone:
            kept = {r.part for r in df.select(part_of(merge_key(self.spec), parts).alias("part")).distinct().collect()}
            self._drop([f"parts={parts}/part={part}" for part in set(gone) - kept])

    def files(self) -> DataFrame:
        """The files of the table: part, bucket, file_path, file_size."""
        found = self.spark.table(self.name).select("part", "_metadata.file_path", "_metadata.file_size").distinct()
        return found.withColumn("bucket", F.regexp_extract("file_path", r"_(\d+)\.[^/]*$", 1).cast("int"))


def _current_ddl(spec: TableSpec, name: str, bucket_column: str, more: str = "") -> str:
    sort = f" SORTED BY ({bucket_column})" if more else ""
    return (
        f"CREATE TABLE IF NOT EXISTS {name} ({spec.ddl(audit=True)}{more}, parts INT, part INT) USING ORC "
        f"OPTIONS (partitionOverwriteMode 'dynamic') PARTITIONED BY (parts, part) "
        f"CLUSTERED BY (`{bucket_column}`){sort} INTO {spec.buckets} BUCKETS"
    )


def current_table(spark: SparkSession, base: str, spec: TableSpec) -> CurrentTable:
    """The current table of an object in a folder below ``base``, whose definition this session's catalog learns."""
    path = f"{base.rstrip('/')}/{spec.name}"
    if ":/" not in path:
        path = f"file://{os.path.abspath(path)}" if spark.sparkContext.master.startswith("local") else path
    name = f"{FOLDER_TABLES}.t_{hashlib.md5(path.encode()).hexdigest()}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {FOLDER_TABLES}")
    ddl = _current_ddl(spec, name, "merge_key", f", merge_key {merge_key_type(spec)}")
    spark.sql(f"{ddl} LOCATION '{path}'")
    return CurrentTable(spark, spec, name, by_key=True)


class PathStore:
    """Delta and current table of one object as folders below ``base``."""

    def __init__(self, spark: SparkSession, base: str, spec: TableSpec):
        self.spark, self.base, self.spec = spark, base, spec
        self.current = current_table(spark, base, spec)

    def insert_delta(self, delta: DataFrame) -> None:
        insert_delta(delta, self.base, self.spec)

    def read(self) -> DataFrame:
        return self.current.read()

    def read_delta(self) -> DataFrame:
        return read_delta(self.spark, self.base, self.spec)

    def truncate_delta(self) -> None:
        truncate_delta(self.spark, self.base, self.spec)


class CatalogStore:
    """Delta and current table of one object as the bucketed tables of ``create_tables``."""

    def __init__(self, spark: SparkSession, database: str, spec: TableSpec):
        self.spark, self.spec, self.name = spark, spec, f"{database}.{spec.name}"
        self.current = CurrentTable(spark, spec, self.name, by_key=False)

    def read(self) -> DataFrame:
        return self.current.read()

    def insert_delta(self, delta: DataFrame) -> None:
        delta.write.insertInto(f"{self.name}_delta")

    def read_delta(self) -> DataFrame:
        return self.spark.table(f"{self.name}_delta")

    def truncate_delta(self) -> None:
        self.spark.sql(f"TRUNCATE TABLE {self.name}_delta")


def open_store(spark: SparkSession, base: str, spec: TableSpec, database: str | None = None) -> PathStore | CatalogStore:
    return PathStore(spark, base, spec) if database is None else CatalogStore(spark, database, spec)


# -- statements -----------------------------------------------------------------


def table_statements(spec: TableSpec, database: str, base: str) -> dict[str, str]:
    """CREATE statements of the three tables; delta and current are bucketed."""
    bucketed = f"USING ORC CLUSTERED BY (`{spec.bucket_column}`) INTO {spec.buckets} BUCKETS"
    return {
        "external_table_sql": (
            f"CREATE TABLE IF NOT EXISTS {database}.stg_{spec.name} ({spec.ddl()}) "
            f"USING ORC LOCATION '{stage_path(base, spec)}'"
        ),
        "delta_table_sql": f"CREATE TABLE IF NOT EXISTS {database}.{spec.name}_delta ({spec.ddl(audit=True)}) {bucketed}",
        "txn_table_sql": _current_ddl(spec, f"{database}.{spec.name}", spec.bucket_column),
    }


def pipeline_statements(spec: TableSpec, database: str) -> dict[str, str]:
    """The pipeline's steps as SQL, for engines and table formats that can MERGE."""
    columns = spec.column_names
    current, delta = f"{database}.{spec.name}", f"{database}.{spec.name}_delta"
    texts = ", ".join(f"coalesce(cast({c} AS string), '')" for c in columns)

    def key(side: str, name: str) -> str:
        zero = spec.type_of(name).lower() in ZERO_DEFAULT_TYPES
        return f"coalesce({side}.{name}, 0)" if zero else f"coalesce(cast({side}.{name} AS string), '')"

    matches = " AND ".join(f"{key('t', k)} = {key('d', k)}" for k in spec.keys)
    cluster = (spec.clustered_by or "").lower()
    changes = ", ".join(f"{c} = d.{c}" for c in [*(c for c in columns if c.lower() != cluster), "checksum"])
    values = ", ".join(f"d.{c}" for c in [*columns, "checksum"])
    return {
        "delta_insert_sql": (
            f"INSERT INTO {delta} SELECT DISTINCT {', '.join(columns)}, md5(concat({texts})), current_timestamp() "
            f"FROM {database}.stg_{spec.name}"
        ),
        "txn_merge_sql": (
            f"MERGE INTO {current} AS t USING {delta} AS d ON {matches} "
            f"WHEN MATCHED AND t.checksum <> d.checksum THEN UPDATE SET {changes}, watermark = current_timestamp() "
            f"WHEN NOT MATCHED THEN INSERT ({', '.join(columns)}, checksum, watermark) VALUES ({values}, current_timestamp())"
        ),
        "delta_truncate_sql": f"TRUNCATE TABLE {delta}",
    }


def create_tables(spark: SparkSession, spec: TableSpec, database: str, base: str) -> dict[str, str]:
    """Creates the three tables; returns these statements and those of the pipeline."""
    statements = table_statements(spec, database, base)
    for statement in statements.values():
        spark.sql(statement)
    return {**statements, **pipeline_statements(spec, database)}
