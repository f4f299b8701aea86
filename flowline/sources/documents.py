"""Catalog tables, templates, status snapshots and registry listings."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

HEADER_SCHEMA = (
    "id bigint, namespace string, package_id string, db_object_name string, db_object_type string, "
    "db_object_type_suffix string, version int, activated_at timestamp, activated_by string, is_active boolean, "
    "created_at timestamp, updated_at timestamp"
)
DETAIL_SCHEMA = (
    "id bigint, haoid bigint, column_name string, is_key boolean, col_order int, "
    "attribute_hierarchy_active boolean, display_attribute boolean, default_description string, "
    "source_object_name string, source_column_name string, source_data_type string, infer_data_type string, "
    "is_required_for_flow boolean, created_at timestamp, updated_at timestamp"
)


def read_catalog(
    spark: SparkSession, headers: str | Mapping[str, str], details: str | Mapping[str, str]
) -> tuple[DataFrame, DataFrame]:
    """The two metadata tables, each from a parquet path or from JDBC options."""

    def read(source: str | Mapping[str, str], schema: str) -> DataFrame:
        if isinstance(source, str):
            return spark.read.schema(schema).parquet(source)
        return spark.read.format("jdbc").options(**source).load()

    return read(headers, HEADER_SCHEMA), read(details, DETAIL_SCHEMA)


# Name under which Spark's readers hand on what they cannot read.
BAD = "_corrupt_record"


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines with all columns of ``schema`` and the text of lines that do not fit it."""
    return spark.read.schema(f"{schema}, {BAD} string").option("columnNameOfCorruptRecord", BAD).json(path)


def readable(df: DataFrame) -> DataFrame:
    return df.filter(F.col(BAD).isNull()).drop(BAD)


def line_rejects(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """(path, reason, document) of the JSON lines that do not fit ``schema``.

    Read as text and parsed as a column: a scan of JSON files refuses to give
    nothing but the lines it cannot read.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("document"))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD}
    parsed = F.from_json("document", f"{schema}, {BAD} string", options)
    bad = lines.filter(F.trim("document") != "").withColumn("t", parsed).filter(F.col("t")[BAD].isNotNull())
    return bad.select("path", F.lit("unreadable line").alias("reason"), "document")


# Element of a template snippet -> component kind.
SNIPPET_KINDS = {
    "processGroups": "processGroup",
    "inputPorts": "inputPort",
    "outputPorts": "outputPort",
    "processors": "processor",
    "connections": "connection",
    "remoteProcessGroups": "remoteProcessGroup",
}


def _parsed_templates(documents: DataFrame) -> DataFrame:
    members = ", ".join(f"{tag}: array<struct<name:string>>" for tag in SNIPPET_KINDS)
    schema = f"name string, snippet struct<{members}>, {BAD} string"
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD}
    return documents.withColumn("t", F.from_xml("document", schema, options))


def template_rows(documents: DataFrame) -> DataFrame:
    """Template documents (column ``document``) -> (template, kind, name).

    Distinct names of the top-level members of each snippet; what lies inside a
    group does not count, nor does a document that cannot be read.
    """
    rows = _parsed_templates(documents).filter(F.col("t")[BAD].isNull())

    def members_of(tag: str, kind: str) -> Column:
        found = F.coalesce(F.col(f"t.snippet.{tag}"), F.array().cast("array<struct<name:string>>"))
        return F.transform(found, lambda m: F.struct(F.lit(kind).alias("kind"), m["name"].alias("name")))

    listed = F.flatten(F.array(*[members_of(tag, kind) for tag, kind in SNIPPET_KINDS.items()]))
    return rows.select(F.col("t.name").alias("template"), F.explode(listed).alias("m")).select("template", "m.*").distinct()


def _template_files(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True)
    return files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("document"))


def read_templates(spark: SparkSession, path: str) -> DataFrame:
    """Template files, one document each."""
    return template_rows(_template_files(spark, path))


def template_rejects(spark: SparkSession, path: str) -> DataFrame:
    """(path, reason, document) of the template files that cannot be read."""
    bad = _parsed_templates(_template_files(spark, path)).filter(F.col("t")[BAD].isNotNull())
    return bad.select("path", F.lit("unreadable document").alias("reason"), "document")


_COUNTS = "runningCount:int, stoppedCount:int, disabledCount:int, invalidCount:int, activeRemotePortCount:int, inactiveRemotePortCount:int"
_QUEUE = "status:struct<aggregateSnapshot:struct<queuedCount:string,runStatus:string>>"
_REVISION = "revision:struct<version:bigint>"
_COMPONENT = "component:struct<name:string,parentGroupId:string,state:string,transmitting:string>"
_ENTITY = f"struct<id:string, {_REVISION}, {_COMPONENT}, {_QUEUE}, {_COUNTS}>"

STATUS_SCHEMA = (
    "ts timestamp, processGroupFlow struct<id:string, parentGroupId:string, flow:struct<"
    f"processGroups:array<{_ENTITY}>, connections:array<{_ENTITY}>, processors:array<{_ENTITY}>, "
    f"remoteProcessGroups:array<{_ENTITY}>, controllerServices:array<{_ENTITY}>>>"
)

# List of a status document -> entity kind.
STATUS_KINDS = {
    "processGroups": "group",
    "connections": "connection",
    "processors": "processor",
    "remoteProcessGroups": "remote",
    "controllerServices": "service",
}


def status_rows(documents: DataFrame) -> DataFrame:
    """Status documents (flow_id, ts, processGroupFlow) -> one row per entity.

    Remote groups report their transmission flag as state.
    """

    def entities(field: str, kind: str) -> Column:
        found = F.coalesce(F.col(f"processGroupFlow.flow.{field}"), F.array().cast(f"array<{_ENTITY}>"))
        return F.transform(found, lambda e: F.struct(F.lit(kind).alias("kind"), e.alias("e")))

    tagged = F.flatten(F.array(*[entities(field, kind) for field, kind in STATUS_KINDS.items()]))
    rows = documents.select("flow_id", "ts", F.col("processGroupFlow.id").alias("doc_group"), F.explode(tagged).alias("r"))
    state = F.coalesce("r.e.component.state", "r.e.status.aggregateSnapshot.runStatus", "r.e.component.transmitting")
    return rows.select(
        "flow_id",
        F.col("r.e.id").alias("entity_id"),
        F.coalesce("r.e.component.parentGroupId", "doc_group").alias("parent_id"),
        F.col("r.kind").alias("kind"),
        F.col("r.e.component.name").alias("name"),
        state.alias("state"),
        F.col("r.e.revision.version").alias("version"),
        "ts",
        F.col("r.e.runningCount").alias("running"),
        F.col("r.e.stoppedCount").alias("stopped"),
        F.col("r.e.disabledCount").alias("disabled"),
        F.col("r.e.invalidCount").alias("invalid"),
        F.col("r.e.status.aggregateSnapshot.queuedCount").alias("queued_count"),
        F.col("r.e.activeRemotePortCount").alias("active_remote"),
        F.col("r.e.inactiveRemotePortCount").alias("inactive_remote"),
    )


_STATUS_LINE = f"flow_id string, {STATUS_SCHEMA}"


def read_status_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """Archived status documents as JSON lines; ``flow_id`` is a field of the document."""
    return status_rows(readable(json_lines(spark, path, _STATUS_LINE)))


def status_rejects(spark: SparkSession, path: str) -> DataFrame:
    """(path, reason, document) of the status lines that cannot be read."""
    return line_rejects(spark, path, _STATUS_LINE)


_REGISTRY_LINE = "source string, registries array<struct<registry:struct<id:string,name:string>>>"


def read_registry_listing(spark: SparkSession, path: str) -> DataFrame:
    """(source, pos, registry_id, registry_name) of ``registries[].registry``.

    ``pos`` is the place in the list: lookups take the first match.
    """
    listing = readable(json_lines(spark, path, _REGISTRY_LINE))
    return listing.select("source", F.posexplode("registries").alias("pos", "r")).select(
        "source",
        "pos",
        F.col("r.registry.id").alias("registry_id"),
        F.col("r.registry.name").alias("registry_name"),
    )


def registry_rejects(spark: SparkSession, path: str) -> DataFrame:
    """(path, reason, document) of the registry lines that cannot be read."""
    return line_rejects(spark, path, _REGISTRY_LINE)
