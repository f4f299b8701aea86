"""What the operators share: reading columns safely and walking Arrow batches."""

from __future__ import annotations

import io
import os
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowline.session import scratch_path

_shipped: set[str] = set()


def _ship_package(spark: SparkSession) -> None:
    """Gives the executors this package, once per application, as ``--py-files`` would, from the shared folder."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as target:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    target.write(path, os.path.relpath(path, os.path.dirname(package)))
    archive = f"{scratch_path(spark, 'package')}/flowline.zip"
    place = spark._jvm.org.apache.hadoop.fs.Path(archive)
    out = place.getFileSystem(spark._jsc.hadoopConfiguration()).create(place, True)
    out.write(bytearray(packed.getvalue()))
    out.close()
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


#: Bytes of an Arrow batch between Spark and Python. Spark's own limit of 64 MB, taken by several stages one after
#: the other, is memory that an executor keeps beside its heap.
BATCH_BYTES = "4m"
_BATCH_BYTES_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


def map_arrow(
    df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType
) -> DataFrame:
    """``df.mapInArrow`` with a function that imports this package.

    Sets the session's limit for Arrow batches to BATCH_BYTES, unless the
    session was started with one of its own.
    """
    spark = df.sparkSession
    _ship_package(spark)
    if _BATCH_BYTES_KEY not in dict(spark.sparkContext.getConf().getAll()):
        spark.conf.set(_BATCH_BYTES_KEY, BATCH_BYTES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from function(batches)
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def numbered(df: DataFrame) -> DataFrame:
    """``df`` with its columns named by position, so that no two names clash."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def pick(df: DataFrame, **wanted: str) -> DataFrame:
    """``new_name=column`` of ``df`` only, whatever other columns there are.

    A column is found by its exact name, the first one if there are several;
    other columns may differ from it in upper and lower case only.
    """
    places = {new: df.columns.index(old) for new, old in wanted.items()}
    return numbered(df).select(*[F.col(f"c{at}").alias(new) for new, at in places.items()])


def documents_of(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id bigint, text string) with null texts as empty ones."""
    found = pick(df, doc_id=id_col, text=text_col)
    return found.select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text"))


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Arrow batches in small pieces, so that only a few texts are Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def one_thread() -> None:
    """Spark gives a task one core; native libraries must not start threads of their own."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    os.environ["RAYON_NUM_THREADS"] = "1"


def keep_rows(df: DataFrame, text_col: str, make_keep: Callable[[], Callable[[list[str]], list[bool]]]) -> DataFrame:
    """The rows of ``df``, all columns as they are, whose texts a function of many texts keeps.

    ``make_keep`` is called once per task. Null texts count as empty ones.
    """
    rows = numbered(df)
    place = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = make_keep()
        for part in slices(batches):
            texts = [t or "" for t in part.column(place).to_pylist()]
            yield part.filter(pa.array(keep(texts), pa.bool_()))

    return map_arrow(rows, run, rows.schema).toDF(*df.columns)


def bounded_sample(df: DataFrame, rows: int, total: int, *key: str) -> DataFrame:
    """At most ``rows`` of the ``total`` rows of ``df``, spread over it by a hash of the ``key`` columns.

    The hash alone keeps about twice as many rows, so that what tasks rank and
    hand on is bounded too, however many tasks there are.
    """
    spread = F.xxhash64(F.lit(rows), *key)
    parts = 1 << 30
    df = df.filter(F.pmod(spread, F.lit(parts)) < F.lit(min(parts, 2 * rows * parts // max(1, total))))
    return df.orderBy(spread, *key).limit(rows)
