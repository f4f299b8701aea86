import hashlib

from pyspark.sql import functions as F

from flowline import functions as fn


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_checksum_has_no_separator_by_default(spark):
    df = spark.createDataFrame([("ab", "c"), ("a", "bc")], "a string, b string")
    sums = [r[0] for r in df.select(fn.row_checksum(["a", "b"])).collect()]
    assert sums[0] == sums[1] == hashlib.md5(b"abc").hexdigest()
    told_apart = {r[0] for r in df.select(fn.row_checksum(["a", "b"], sep="|")).collect()}
    assert len(told_apart) == 2


def test_checksum_treats_null_as_empty(spark):
    df = spark.createDataFrame([(None, 5)], "a string, b int")
    assert df.select(fn.row_checksum(["a", "b"])).first()[0] == hashlib.md5(b"5").hexdigest()


def test_key_value_defaults(spark):
    df = spark.createDataFrame([(None, None, None)], "i int, s string, d date")
    got = df.select(fn.key_value("i", "INT"), fn.key_value("s", "string"), fn.key_value("d", "date")).first()
    assert tuple(got) == (0, "", "")


def test_text_helpers(spark):
    assert one(spark, fn.contains_ignore_case(F.lit("A WARNing"), F.lit("warn")))
    assert one(spark, fn.contains_ignore_case(F.lit("x"), F.lit("")))
    assert one(spark, fn.equals_ignore_case(F.lit("Ab"), F.lit("aB")))
    assert one(spark, fn.strip_whitespace(F.lit(" a\tb\n c "))) == "abc"


def test_counts_and_percentage(spark):
    assert [one(spark, fn.grouped_count(F.lit(x))) for x in ("0", "12", "1,234,567")] == [0, 12, 1234567]
    assert one(spark, fn.percentage(F.lit(1), F.lit(10))) == 10.0
    assert one(spark, fn.percentage(F.lit(1), F.lit(0))) is None


def test_names(spark):
    assert one(spark, fn.qualified_source_name(F.lit("NS"), F.lit("a.b"), F.lit("Obj"))) == '"NS"."a.b/Obj"'
    assert one(spark, fn.staging_name(F.lit("Obj"))) == "stg_obj"
    assert one(spark, fn.counter_name(F.lit("Obj"))) == "sig_ctr_obj"
    assert one(spark, fn.table_name(F.lit("Obj"))) == "obj"


def test_empty_revision(spark):
    df = spark.createDataFrame([(None,), (("c", 3),)], "revision struct<client_id:string,version:bigint>")
    got = [tuple(r[0]) for r in df.select(fn.revision_or_empty("revision")).collect()]
    assert got == [(None, None), ("c", 3)]
