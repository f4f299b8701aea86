import pytest

from flowline.operators import catalog as cat

HEADERS = [(1, "NS", "pkg", "Orders"), (2, "NS", "pkg", "Parts")]
DETAILS = [
    (12, 1, "amount", False, 3, "DECIMAL(18,2)"),
    (11, 1, "LASTCHANGETS", False, 2, "timestamp"),
    (10, 1, "OrderId", True, 1, "BIGINT"),
    (13, 1, "Units", True, 2, "String"),
    (20, 2, "PartId", False, 1, "int"),
]


@pytest.fixture
def tables(spark):
    headers = spark.createDataFrame(HEADERS, "id bigint, namespace string, package_id string, db_object_name string")
    details = spark.createDataFrame(
        DETAILS, "id bigint, haoid bigint, column_name string, is_key boolean, col_order int, infer_data_type string"
    )
    return headers, details


@pytest.fixture
def catalog(tables):
    headers, details = tables
    requests = headers.drop("id").union(headers.drop("id"))
    return cat.object_columns(headers, details, requests)


def lists(df):
    return {r[0]: r[1] for r in df.collect()}


def test_object_columns_do_not_repeat(catalog):
    assert catalog.count() == len(DETAILS)


def test_key_columns(catalog, rows):
    assert rows(cat.key_columns(catalog), "haoid", "column_name") == [(1, "OrderId"), (1, "Units")]


def test_max_value_columns_match_any_ts(catalog):
    assert lists(cat.max_value_columns(catalog)) == {1: '"LASTCHANGETS" , "Units"', 2: ""}


def test_order_by_columns(catalog):
    assert lists(cat.order_by_columns(catalog)) == {1: '"OrderId" , "Units"', 2: ""}


def test_schema_is_ordered_and_lower_case(catalog):
    plain = lists(cat.schema_for(catalog))
    assert plain[1] == "orderid bigint , lastchangets timestamp , units string , amount decimal(18,2)"
    assert lists(cat.schema_for(catalog, audit=True))[2] == "partid int , checksum string , watermark timestamp"


def test_table_specs(tables):
    request = {"namespace": "NS", "package_id": "pkg", "db_object_name": "Orders", "buckets": "4", "clustered_by": "UNITS"}
    (spec,) = cat.table_specs(*tables, [request])
    assert spec.name == "orders" and spec.keys == ("orderid", "units")
    assert spec.clustered_by == "units" and spec.buckets == 4
    assert spec.ddl(audit=True).endswith("`checksum` string, `watermark` timestamp")


def test_table_without_keys_is_refused(tables):
    with pytest.raises(ValueError, match="no key columns"):
        cat.table_specs(*tables, [{"namespace": "NS", "package_id": "pkg", "db_object_name": "Parts"}])


def test_unknown_table_is_refused(tables):
    with pytest.raises(ValueError, match="no catalog entry"):
        cat.table_specs(*tables, [{"namespace": "NS", "package_id": "pkg", "db_object_name": "Nope"}])
