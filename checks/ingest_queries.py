"""Check queries of the ingestion operators."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import binding as b
from checks.registry import check
from flowline.operators import catalog as cat
from flowline.operators import merge as m
from flowline.plans import ingestion
from flowline.session import cut_lineage, scratch_path
from flowline.sources import tables
from flowline.sources.documents import read_catalog
from flowline.streaming.streams import stream_ingest


def shown(df: DataFrame, spec: cat.TableSpec) -> DataFrame:
    """Decimals as doubles, so that both engines print them alike."""
    return df.withColumns({c: F.col(c).cast("double") for c, t in spec.columns if t.startswith("decimal")})


def delta_of(spark: SparkSession, sf_dir: str, spec: cat.TableSpec) -> DataFrame:
    return m.stage_to_delta(b.staged(spark, sf_dir, spec), spec, b.as_of())


CUSTOMER_DELTA = """
    SELECT DISTINCT c_custkey, c_name, c_nationkey, CAST(c_acctbal AS DECIMAL(18,2)) AS c_acctbal, c_mktsegment,
        md5(concat(coalesce(CAST(c_custkey AS VARCHAR), ''), coalesce(c_name, ''),
            coalesce(CAST(c_nationkey AS VARCHAR), ''),
            coalesce(CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR), ''), coalesce(c_mktsegment, ''))) AS checksum,
        TIMESTAMP '2024-02-01 00:00:00' AS watermark
    FROM customer"""

ORDERS_DELTA = """
    SELECT DISTINCT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice,
        o_orderdate, o_orderpriority,
        md5(concat(coalesce(CAST(o_orderkey AS VARCHAR), ''), coalesce(CAST(o_custkey AS VARCHAR), ''),
            coalesce(o_orderstatus, ''), coalesce(CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR), ''),
            coalesce(CAST(o_orderdate AS VARCHAR), ''), coalesce(o_orderpriority, ''))) AS checksum,
        TIMESTAMP '2024-02-01 00:00:00' AS watermark
    FROM orders"""

CUSTOMER_MERGE = f"""
WITH delta AS ({CUSTOMER_DELTA}),
target AS (
    SELECT c_custkey, c_name, (c_nationkey + 1) % 25 AS c_nationkey, c_acctbal, c_mktsegment,
        CASE WHEN c_custkey % 7 = 0 THEN 'old' ELSE checksum END AS checksum,
        TIMESTAMP '2024-01-01 00:00:00' AS watermark
    FROM delta WHERE c_custkey % 10 <> 0),
both_sides AS (
    SELECT t.c_custkey AS tk, d.c_custkey AS dk,
        CASE WHEN t.c_custkey IS NULL THEN 'insert' WHEN d.c_custkey IS NULL THEN 'keep'
             WHEN t.checksum <> d.checksum THEN 'update' ELSE 'same' END AS action,
        t.* RENAME (c_custkey AS t1, c_name AS t2, c_nationkey AS t3, c_acctbal AS t4, c_mktsegment AS t5,
                    checksum AS t6, watermark AS t7),
        d.* RENAME (c_custkey AS d1, c_name AS d2, c_nationkey AS d3, c_acctbal AS d4, c_mktsegment AS d5,
                    checksum AS d6, watermark AS d7)
    FROM target t FULL OUTER JOIN delta d ON coalesce(t.c_custkey, 0) = coalesce(d.c_custkey, 0))
"""

CUSTOMER_STATE = (
    CUSTOMER_MERGE
    + """
SELECT CASE WHEN action IN ('insert', 'update') THEN d1 ELSE t1 END AS c_custkey,
    CASE WHEN action IN ('insert', 'update') THEN d2 ELSE t2 END AS c_name,
    CASE WHEN action = 'insert' THEN d3 ELSE t3 END AS c_nationkey,
    CAST(CASE WHEN action IN ('insert', 'update') THEN d4 ELSE t4 END AS DOUBLE) AS c_acctbal,
    CASE WHEN action IN ('insert', 'update') THEN d5 ELSE t5 END AS c_mktsegment,
    CASE WHEN action IN ('insert', 'update') THEN d6 ELSE t6 END AS checksum,
    CASE WHEN action IN ('insert', 'update') THEN d7 ELSE t7 END AS watermark
FROM both_sides"""
)

ORDERS_STATE = f"""
WITH delta AS ({ORDERS_DELTA}),
target AS (
    SELECT * REPLACE (o_custkey + 1 AS o_custkey,
        CASE WHEN o_orderkey % 7 = 0 THEN 'old' ELSE checksum END AS checksum,
        TIMESTAMP '2024-01-01 00:00:00' AS watermark)
    FROM delta WHERE o_orderkey % 10 <> 0)
SELECT d.o_orderkey, CASE WHEN t.o_orderkey IS NULL THEN d.o_custkey ELSE t.o_custkey END AS o_custkey,
    d.o_orderstatus, CAST(d.o_totalprice AS DOUBLE) AS o_totalprice, d.o_orderdate, d.o_orderpriority, d.checksum,
    CASE WHEN t.o_orderkey IS NULL OR t.checksum <> d.checksum THEN d.watermark ELSE t.watermark END AS watermark
FROM delta d LEFT JOIN target t ON coalesce(t.o_orderkey, 0) = coalesce(d.o_orderkey, 0)"""


@check("ingest_checksum", f"SELECT * REPLACE (CAST(c_acctbal AS DOUBLE) AS c_acctbal) FROM ({CUSTOMER_DELTA})")
def ingest_checksum(spark, sf_dir):
    return shown(delta_of(spark, sf_dir, b.CUSTOMER_SPEC), b.CUSTOMER_SPEC)


def customer_sides(spark, sf_dir):
    delta = delta_of(spark, sf_dir, b.CUSTOMER_SPEC)
    return b.earlier_state(delta, b.CUSTOMER_SPEC, 1, 25), delta


@check("ingest_merge", CUSTOMER_STATE)
def ingest_merge(spark, sf_dir):
    target, delta = customer_sides(spark, sf_dir)
    return shown(m.merge_current(target, delta, b.CUSTOMER_SPEC, b.as_of()), b.CUSTOMER_SPEC)


@check("ingest_merge_report", CUSTOMER_MERGE + "SELECT action, count(*) AS n FROM both_sides GROUP BY action")
def ingest_merge_report(spark, sf_dir):
    return m.merge_report(*customer_sides(spark, sf_dir), b.CUSTOMER_SPEC)


def orders_sides(spark, sf_dir):
    delta = delta_of(spark, sf_dir, b.ORDERS_SPEC)
    return b.earlier_state(delta, b.ORDERS_SPEC, 1), delta


@check("ingest_merge_orders", ORDERS_STATE)
def ingest_merge_orders(spark, sf_dir):
    target, delta = orders_sides(spark, sf_dir)
    return shown(m.merge_current(target, delta, b.ORDERS_SPEC, b.as_of()), b.ORDERS_SPEC)


@check("ingest_high_water", "SELECT max(o_orderdate) AS o_orderdate, max(o_orderkey) AS o_orderkey FROM orders")
def ingest_high_water(spark, sf_dir):
    return m.high_water_marks(b.table(spark, sf_dir, "orders"), ["o_orderdate", "o_orderkey"])


@check(
    "ingest_incremental",
    """WITH source AS (
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority,
            CASE WHEN o_orderpriority = '5-LOW' AND o_orderkey % 20 = 0 THEN NULL ELSE o_orderdate END AS o_orderdate FROM orders),
    seen AS (SELECT max(o_orderdate) AS ts, max(o_orderkey) AS k FROM source WHERE o_orderdate < TIMESTAMP '1998-06-01 00:00:00')
    SELECT source.* FROM source, seen WHERE o_orderdate >= ts OR o_orderkey >= k OR o_orderdate IS NULL OR o_orderkey IS NULL""",
)
def ingest_incremental(spark, sf_dir):
    """Past the marks of a load that ended in 1998: newer, at the mark, newer by key only, and without a time."""
    unknown = (F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderkey") % 20 == 0)
    source = b.table(spark, sf_dir, "orders").withColumn("o_orderdate", F.when(~unknown, F.col("o_orderdate")))
    marks = m.high_water_marks(source.filter("o_orderdate < TIMESTAMP_NTZ '1998-06-01 00:00:00'"), ["o_orderdate", "o_orderkey"])
    seen = marks.first().asDict()
    return m.read_source_incremental(source, ["o_orderdate", "o_orderkey"], seen, ["o_orderkey"])


# -- catalog --------------------------------------------------------------------

CATALOG_SQL = """
WITH headers AS (
    SELECT p_partkey // 20 AS id, upper(replace(p_brand, '#', '_')) AS namespace, lower(p_type) AS package_id,
        'Object' || (p_partkey // 20) AS db_object_name
    FROM part WHERE p_partkey % 20 = 0),
requested AS (SELECT * FROM headers WHERE id IN (SELECT s_suppkey FROM supplier)),
details AS (
    SELECT p_partkey AS id, p_partkey // 20 AS haoid,
        replace(upper(p_name[1]) || p_name[2:], ' ', '_')
            || CASE WHEN p_size % 9 = 0 THEN '_ChangeTS' ELSE '' END AS column_name,
        p_size <= 10 AS is_key, CAST(100 - p_size AS INTEGER) AS col_order,
        CASE p_type WHEN 'STANDARD' THEN 'STRING' WHEN 'ECONOMY' THEN 'int' WHEN 'MEDIUM' THEN 'BIGINT'
            WHEN 'PROMO' THEN 'decimal(18,2)' WHEN 'LARGE' THEN 'double' ELSE 'timestamp' END AS infer_data_type
    FROM part),
catalog AS (
    SELECT d.*, r.namespace, r.package_id, r.db_object_name FROM details d JOIN requested r ON d.haoid = r.id)
"""


def requested_catalog(spark, sf_dir):
    headers, details = b.catalog_headers(spark, sf_dir), b.catalog_details(spark, sf_dir)
    return cat.object_columns(headers, details, b.catalog_requests(spark, sf_dir))


@check(
    "ingest_object_columns",
    CATALOG_SQL + "SELECT haoid, id, db_object_name, namespace, package_id, column_name, is_key, col_order, infer_data_type FROM catalog",
)
def ingest_object_columns(spark, sf_dir):
    return requested_catalog(spark, sf_dir).select(
        "haoid", "id", "db_object_name", "namespace", "package_id", "column_name", "is_key", "col_order", "infer_data_type"
    )


@check("ingest_key_cols", CATALOG_SQL + "SELECT haoid, column_name, infer_data_type, col_order, id FROM catalog WHERE is_key")
def ingest_key_cols(spark, sf_dir):
    return cat.key_columns(requested_catalog(spark, sf_dir))


@check(
    "ingest_max_cols",
    CATALOG_SQL
    + """SELECT haoid,
        coalesce(string_agg('"' || column_name || '"', ' , ' ORDER BY col_order, id)
            FILTER (WHERE contains(lower(column_name), 'ts')), '') AS max_value_columns,
        coalesce(string_agg('"' || column_name || '"', ' , ' ORDER BY col_order, id) FILTER (WHERE is_key), '') AS order_by_columns
    FROM catalog GROUP BY haoid""",
)
def ingest_max_cols(spark, sf_dir):
    columns = requested_catalog(spark, sf_dir)
    return cat.max_value_columns(columns).join(cat.order_by_columns(columns), "haoid")


@check(
    "ingest_schema",
    CATALOG_SQL
    + """SELECT haoid,
        string_agg(lower(column_name) || ' ' || lower(infer_data_type), ' , ' ORDER BY col_order, id) AS schema,
        string_agg(lower(column_name) || ' ' || lower(infer_data_type), ' , ' ORDER BY col_order, id)
            || ' , checksum string , watermark timestamp' AS audit_schema
    FROM catalog GROUP BY haoid""",
)
def ingest_schema(spark, sf_dir):
    columns = requested_catalog(spark, sf_dir)
    audit = cat.schema_for(columns, audit=True).withColumnRenamed("schema", "audit_schema")
    return cat.schema_for(columns).join(audit, "haoid")


@check(
    "ingest_names",
    CATALOG_SQL
    + """SELECT id, '"' || namespace || '"."' || package_id || '/' || db_object_name || '"' AS source_name,
        lower(db_object_name) AS table_name, 'stg_' || lower(db_object_name) AS staging_name,
        'sig_ctr_' || lower(db_object_name) AS counter_name FROM headers""",
)
def ingest_names(spark, sf_dir):
    return cat.object_names(b.catalog_headers(spark, sf_dir))


@check(
    "src_catalog",
    CATALOG_SQL + "SELECT h.id AS object_id, h.db_object_name, d.column_name, d.infer_data_type FROM headers h JOIN details d ON d.haoid = h.id",
)
def src_catalog(spark, sf_dir):
    path = scratch_path(spark, "catalog")
    b.catalog_headers(spark, sf_dir).write.parquet(f"{path}/headers")
    b.catalog_details(spark, sf_dir).write.parquet(f"{path}/details")
    headers, details = read_catalog(spark, f"{path}/headers", f"{path}/details")
    return headers.select(F.col("id").alias("object_id"), "db_object_name").join(
        details.select(F.col("haoid").alias("object_id"), "column_name", "infer_data_type"), "object_id"
    )


# -- jobs -----------------------------------------------------------------------


@check("src_stage", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def src_stage(spark, sf_dir):
    base, spec = scratch_path(spark, "stage"), b.CUSTOMER_SPEC
    tables.clear_stage(spark, base, spec)
    tables.stage(b.staged(spark, sf_dir, spec), base, spec)
    return shown(tables.read_stage(spark, base, spec), spec)


@check("ingest_tables", f"SELECT * REPLACE (CAST(c_acctbal AS DOUBLE) AS c_acctbal) FROM ({CUSTOMER_DELTA})")
def ingest_tables(spark, sf_dir):
    """Creates the three tables, inserts the delta into its bucketed table and reads that."""
    base, spec = scratch_path(spark, "tables"), b.CUSTOMER_SPEC
    database = f"flowline_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{base}/db'")
    ingestion.prepare_tables(spark, [spec], database, base)
    tables.stage(b.staged(spark, sf_dir, spec), base, spec)
    staged = spark.table(f"{database}.stg_{spec.name}")
    m.stage_to_delta(staged, spec, b.as_of().cast("timestamp")).write.insertInto(f"{database}.{spec.name}_delta")
    delta = spark.table(f"{database}.{spec.name}_delta")
    return shown(delta.withColumn("watermark", F.col("watermark").cast("timestamp_ntz")), spec)


TWO_RUNS = f"""
WITH delta AS ({ORDERS_DELTA}),
first_run AS (SELECT max(o_orderdate) AS seen FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01 00:00:00')
SELECT * EXCLUDE (seen) REPLACE (CAST(o_totalprice AS DOUBLE) AS o_totalprice,
    CASE WHEN o_orderdate > seen THEN TIMESTAMP '2024-02-02 00:00:00' ELSE TIMESTAMP '2024-02-01 00:00:00' END AS watermark)
FROM delta, first_run"""


def two_runs(spark, sf_dir, base, database=None):
    """A first load up to 1998 and an incremental one from its high-water mark."""
    spec = b.ORDERS_SPEC
    early = lambda s: b.staged(s, sf_dir, spec).filter("o_orderdate < TIMESTAMP_NTZ '1998-01-01 00:00:00'")
    request = ingestion.IngestionRequest(spec, early, max_cols=["o_orderdate"])
    first = ingestion.run_ingestion(spark, [request], base, b.as_of().cast("timestamp"), database)
    later = ingestion.IngestionRequest(
        spec, lambda s: b.staged(s, sf_dir, spec), ["o_orderdate"], first[spec.name]["high_water"]
    )
    next_day = F.expr("TIMESTAMP_NTZ '2024-02-02 00:00:00'").cast("timestamp")
    return ingestion.run_ingestion(spark, [later], base, next_day, database)


def shown_orders(current):
    return shown(current.withColumn("watermark", F.col("watermark").cast("timestamp_ntz")), b.ORDERS_SPEC)


def current_orders(spark, base):
    return shown_orders(tables.current_table(spark, base, b.ORDERS_SPEC).read())


@check("ingest_run", TWO_RUNS)
def ingest_run(spark, sf_dir):
    base = scratch_path(spark, "ingest-run")
    two_runs(spark, sf_dir, base)
    return current_orders(spark, base)


@check("ingest_run_catalog", TWO_RUNS)
def ingest_run_catalog(spark, sf_dir):
    """The two runs of ``ingest_run`` on prepared tables of a database."""
    base, database = scratch_path(spark, "ingest-catalog"), "flowline_" + uuid.uuid4().hex
    spark.sql(f"CREATE DATABASE {database} LOCATION '{base}/db'")
    try:
        ingestion.prepare_tables(spark, [b.ORDERS_SPEC], database, base)
        two_runs(spark, sf_dir, base, database)
        return cut_lineage(shown_orders(tables.CatalogStore(spark, database, b.ORDERS_SPEC).read()), "catalog-rows")
    finally:
        spark.sql(f"DROP DATABASE {database} CASCADE")


@check("ingest_compact", f"SELECT * REPLACE (CAST(o_totalprice AS DOUBLE) AS o_totalprice) FROM ({ORDERS_DELTA})")
def ingest_compact(spark, sf_dir):
    """A state written in many small files, rewritten compactly."""
    base, spec = scratch_path(spark, "compact"), b.ORDERS_SPEC
    delta = delta_of(spark, sf_dir, spec).withColumn("watermark", F.col("watermark").cast("timestamp"))
    current = tables.current_table(spark, base, spec)
    current.overwrite(delta.repartition(8))
    if not ingestion.compact(spark, base, spec):
        raise AssertionError("nothing was compacted")
    return current_orders(spark, base)


@check("stream_ingest", CUSTOMER_STATE)
def stream_ingest_query(spark, sf_dir):
    """The merge of ``ingest_merge`` with the extract arriving in several files."""
    base, spec = scratch_path(spark, "stream-ingest"), b.CUSTOMER_SPEC
    as_of = b.as_of().cast("timestamp")
    delta = m.stage_to_delta(b.staged(spark, sf_dir, spec), spec, as_of)
    before = b.earlier_state(delta, spec, 1, 25).withColumn("watermark", F.col("watermark").cast("timestamp"))
    tables.current_table(spark, base, spec).overwrite(before)
    tables.stage(b.staged(spark, sf_dir, spec).repartition(4), base, spec)
    query = stream_ingest(spark, base, spec, f"{base}/checkpoint", as_of, max_files=2)
    query.awaitTermination()
    current = tables.current_table(spark, base, spec).read()
    return shown(current.withColumn("watermark", F.col("watermark").cast("timestamp_ntz")), spec)
