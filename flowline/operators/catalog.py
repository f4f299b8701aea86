"""Column catalog: which columns, keys and types a table has.

A catalog *object* is one table; its detail rows are the table's columns, so the
per-object lists built here are bounded by the width of a table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowline.functions import counter_name, qualified_source_name, staging_name, table_name

# The two audit columns of delta and current tables, the marker
# that makes a column a max-value column, and the list delimiter.
AUDIT_COLUMNS = (("checksum", "string"), ("watermark", "timestamp"))
MAX_VALUE_MARKER = "ts"
DELIMITER = " , "

OBJECT_KEYS = ("namespace", "package_id", "db_object_name")


@dataclass(frozen=True)
class TableSpec:
    """What the ingestion operators need to know about one table."""

    name: str
    columns: tuple[tuple[str, str], ...]
    keys: tuple[str, ...]
    clustered_by: str | None = None
    buckets: int = 32

    def __post_init__(self) -> None:
        if not self.keys:
            raise ValueError(f"table {self.name} has no key columns")
        unknown = set(self.keys) - set(self.column_names)
        if unknown:
            raise ValueError(f"table {self.name}: keys {sorted(unknown)} are not columns")

    @property
    def column_names(self) -> list[str]:
        return [name for name, _ in self.columns]

    @property
    def bucket_column(self) -> str:
        """The cluster column; the first key where there is none."""
        return self.clustered_by or self.keys[0]

    def type_of(self, column: str) -> str:
        return dict(self.columns)[column]

    def ddl(self, audit: bool = False) -> str:
        columns = self.columns + (AUDIT_COLUMNS if audit else ())
        return ", ".join(f"`{name}` {kind}" for name, kind in columns)


def object_columns(headers: DataFrame, details: DataFrame, requests: DataFrame) -> DataFrame:
    """Detail rows of every requested object."""
    wanted = requests.select(*OBJECT_KEYS).distinct()
    objects = headers.join(wanted, list(OBJECT_KEYS)).select(F.col("id").alias("haoid"), *OBJECT_KEYS)
    return details.join(objects, "haoid")


def key_columns(catalog: DataFrame) -> DataFrame:
    return catalog.filter("is_key").select("haoid", "column_name", "infer_data_type", "col_order", "id")


def _listed(catalog: DataFrame, when: Column, text: Column, alias: str) -> DataFrame:
    """One delimited list per object, in catalog order; '' when nothing qualifies."""
    entry = F.when(when, F.struct("col_order", "id", text.alias("text")))
    ordered = F.array_sort(F.collect_list(entry))
    return catalog.groupBy("haoid").agg(F.concat_ws(DELIMITER, ordered["text"]).alias(alias))


def _quoted(name: Column) -> Column:
    return F.concat(F.lit('"'), name, F.lit('"'))


def max_value_columns(catalog: DataFrame) -> DataFrame:
    """Columns that carry a change time, told by their name.

    The rule is a plain substring, so ``Units`` counts as well.
    """
    is_ts = F.contains(F.lower("column_name"), F.lit(MAX_VALUE_MARKER))
    return _listed(catalog, is_ts, _quoted(F.col("column_name")), "max_value_columns")


def order_by_columns(catalog: DataFrame) -> DataFrame:
    return _listed(catalog, F.col("is_key"), _quoted(F.col("column_name")), "order_by_columns")


def schema_for(catalog: DataFrame, audit: bool = False) -> DataFrame:
    """``name type`` list per object, with the audit columns at the end if asked."""
    column = F.concat_ws(" ", F.lower("column_name"), F.lower("infer_data_type"))
    listed = _listed(catalog, F.lit(True), column, "schema")
    if audit:
        tail = DELIMITER.join(f"{name} {kind}" for name, kind in AUDIT_COLUMNS)
        listed = listed.withColumn("schema", F.concat_ws(DELIMITER, "schema", F.lit(tail)))
    return listed


def object_names(headers: DataFrame) -> DataFrame:
    """Source, table, staging and counter name of every object."""
    return headers.select(
        "id",
        qualified_source_name("namespace", "package_id", "db_object_name").alias("source_name"),
        table_name("db_object_name").alias("table_name"),
        staging_name("db_object_name").alias("staging_name"),
        counter_name("db_object_name").alias("counter_name"),
    )


def table_specs(headers: DataFrame, details: DataFrame, requests: Sequence[dict]) -> list[TableSpec]:
    """Specs of the requested tables, for use on the driver.

    A request names namespace, package_id and db_object_name and may carry
    buckets and clustered_by. What is fetched are the column lists of the
    requested tables only.
    """
    by_object = {tuple(r[k] for k in OBJECT_KEYS): r for r in requests}
    wanted = headers.sparkSession.createDataFrame(list(by_object), ", ".join(f"{k} string" for k in OBJECT_KEYS))
    found: dict[tuple, list] = {key: [] for key in by_object}
    for row in object_columns(headers, details, wanted).orderBy("col_order", "id").collect():
        found[tuple(row[k] for k in OBJECT_KEYS)].append(row)
    specs = []
    for key, request in by_object.items():
        if not found[key]:
            raise ValueError(f"no catalog entry for {key}")
        cluster = request.get("clustered_by")
        specs.append(
            TableSpec(
                name=request["db_object_name"].lower(),
                columns=tuple((r.column_name.lower(), r.infer_data_type.lower()) for r in found[key]),
                keys=tuple(r.column_name.lower() for r in found[key] if r.is_key),
                clustered_by=cluster.lower() if cluster else None,
                buckets=int(request.get("buckets") or 32),
            )
        )
    return specs
