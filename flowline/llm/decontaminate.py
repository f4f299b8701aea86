"""Benchmark passages in documents, found by spaced seeds.

A seed hashes the words at the positions a mask selects and ignores the others,
so it still matches where an ignored word was replaced. MASKS are chosen so that
among any WINDOW consecutive words of which at least EQUAL are unchanged, one of
them falls on unchanged words only (tests enumerate this). Test and training
seeds are joined, and the aligned words around each hit are compared.

DataFrame functions only. Positions of a document are generated, hashed and
looked up within one stage; nothing but hits is ever shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowline.llm.tables import numbered, pick
from flowline.session import cut_lineage

MASKS = ((0, 1, 2, 4, 5), (0, 1, 3, 6, 7))
SPAN = max(m[-1] for m in MASKS) + 1
#: Words of the shortest seed; it starts at more places than the others.
SHORTEST = min(m[-1] for m in MASKS) + 1
#: A passage is found where EQUAL of at most WINDOW aligned words are equal.
WINDOW = 12
EQUAL = 10
#: Seeds that are broadcast at a time, each with at most SPAN + 2 * WINDOW words; more take several passes.
BLOCK_SEEDS = 100_000

# Letters, their marks and digits make words.
_BETWEEN = r"[^\p{L}\p{M}\p{N}]+"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), _BETWEEN), "")


def _whole_masks(sizes: Sequence[int]) -> dict[int, Sequence[int]]:
    """By number, masks that select all words of items too short for a spaced seed."""
    return {len(MASKS) + size: range(size) for size in sizes}


def _seed_hashes(words: Column, at: Column, sizes: Sequence[int] = ()) -> Column:
    """A seed per mask; null for the masks that do not fit any more at the end of the words."""
    masks = {**dict(enumerate(MASKS)), **_whole_masks(sizes)}
    hashed = [F.xxhash64(F.lit(number), *[F.get(words, at + k) for k in mask]) for number, mask in masks.items()]
    return F.array(*[F.when(F.get(words, at + mask[-1]).isNotNull(), seed) for mask, seed in zip(masks.values(), hashed)])


def _starts(words: Column, shortest: int = SHORTEST) -> Column:
    """Every place where the shortest seed fits; the size is asked here so that words are split once."""
    places = F.sequence(F.lit(0), F.size(words) - shortest)
    return F.explode(F.when(F.size(words) >= shortest, places).otherwise(F.array().cast("array<int>")))


def benchmark_seeds(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(seed, context, before, needed, item_id) of every position of every item.

    context holds the words up to WINDOW around the seed, ``before`` of them in
    front of it, and ``needed`` says how many of them must be equal: EQUAL, of
    items shorter than WINDOW all but one, of items of fewer than EQUAL words
    all. Items too short for a spaced seed have one seed of all their words.
    Equal contexts of several items are one row with the smallest id. Empty and
    null items have nothing to look for.
    """
    items = pick(benchmark, item_id=id_col, text=text_col).select("item_id", words_of(F.col("text")).alias("words"))
    items = items.filter(F.size("words") > 0).groupBy("words").agg(F.min("item_id").alias("item_id"))
    at, words, size = F.col("at"), F.col("words"), F.size("words")
    first = F.greatest(at - WINDOW, F.lit(0))
    needed = F.when(size >= WINDOW, EQUAL).when(size >= EQUAL, size - 1).otherwise(size)
    placed = items.select("*", _starts(words).alias("at")).select(
        F.explode(_seed_hashes(words, at)).alias("seed"),
        F.slice(words, first + 1, F.lit(SPAN + 2 * WINDOW)).alias("context"),
        (at - first).alias("before"),
        needed.alias("needed"),
        "item_id",
    )
    whole = F
    for number, mask in _whole_masks(range(1, SHORTEST)).items():
        whole = whole.when(size == len(mask), F.xxhash64(F.lit(number), *[F.get(words, F.lit(k)) for k in mask]))
    short = items.filter(size < SHORTEST).select(
        whole.alias("seed"), words.alias("context"), F.lit(0).alias("before"), size.alias("needed"), "item_id"
    )
    placed = placed.filter(F.col("seed").isNotNull()).unionByName(short)
    return placed.groupBy("seed", "context", "before", "needed").agg(F.min("item_id").alias("item_id"))


def _equal_places() -> Column:
    """Places in the context whose word equals the document's word beside it."""
    same = lambda k: F.get("beside", k) == F.get("context", k)
    return F.filter(F.sequence(F.lit(0), F.size("context") - 1), lambda k: F.coalesce(same(k), F.lit(False)))


def _close_enough() -> Column:
    """``needed`` equal places within WINDOW."""
    last = lambda j: F.get("equal", j + F.col("needed") - 1)
    firsts = F.sequence(F.lit(0), F.size("equal") - F.col("needed"))
    near = F.exists(firsts, lambda j: last(j) - F.get("equal", j) < WINDOW)
    return F.when(F.size("equal") >= F.col("needed"), near).otherwise(False)


def _beside() -> Column:
    """The document's words beside the context; null where the document has not begun yet or has ended."""
    start = F.col("at") - F.col("before")
    missing = F.greatest(-start, F.lit(0))
    there = F.slice("words", F.greatest(start, F.lit(0)) + 1, F.greatest(F.size("context") - missing, F.lit(0)))
    return F.concat(F.array_repeat(F.lit(None).cast("string"), missing), there)


def find_passages(
    documents: DataFrame, seeds: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_seeds: int = BLOCK_SEEDS
) -> DataFrame:
    """(doc_id, text_hash, item_id, n_equal) of the documents with a passage of the benchmark.

    item_id is the smallest id of an item that was found, n_equal the most equal
    words seen around one hit. One row per different (doc_id, text). ``seeds``
    is what :func:`benchmark_seeds` gives; it is broadcast in blocks of about
    ``block_seeds`` rows, in as many passes over the documents as it has blocks.
    """
    seeds = cut_lineage(seeds, "seeds")
    blocks = max(1, -(-seeds.count() // block_seeds))
    # Places of documents are hashed whole for the lengths that such items have, of which there are few, if any.
    sizes = sorted(r.needed for r in seeds.filter(F.col("needed") < SHORTEST).select("needed").distinct().collect())
    texts = pick(documents, doc_id=id_col, text=text_col).select(
        "doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), words_of(F.col("text")).alias("words")
    )
    own = texts.select("*", _starts(F.col("words"), min([SHORTEST, *sizes])).alias("at"))
    own = own.select("*", F.explode(_seed_hashes(F.col("words"), F.col("at"), sizes)).alias("seed"))
    own = own.filter(F.col("seed").isNotNull())

    def hits(block: int) -> DataFrame:
        mine = seeds if blocks == 1 else seeds.filter(F.pmod(F.xxhash64("seed"), F.lit(blocks)) == block)
        met = own.join(F.broadcast(mine), "seed")
        # An array of one, taken apart again, keeps the comparison out of the join: it is made for hits only, and
        # the join stays compiled together with the scan, so that no row of a position holds a copy of the words.
        met = met.select("doc_id", "text_hash", "item_id", "needed", "context", F.explode(F.array(_beside())).alias("beside"))
        return met.withColumn("equal", _equal_places()).filter(_close_enough())

    found = reduce(DataFrame.union, [hits(b).select("doc_id", "text_hash", "item_id", F.size("equal").alias("n")) for b in range(blocks)])
    return found.groupBy("doc_id", "text_hash").agg(F.min("item_id").alias("item_id"), F.max("n").alias("n_equal"))


def _same(left: DataFrame, right: DataFrame) -> Column:
    return left["doc_id"].eqNullSafe(right["doc_id"]) & (left["text_hash"] == right["text_hash"])


def contamination(
    documents: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, contaminated, item_id and n_equal for every row of ``documents``.

    Clean rows, null and empty texts among them, have a null item_id and 0 equal
    words. Repeated rows are all there; an empty benchmark finds nothing.
    """
    found = cut_lineage(find_passages(documents, benchmark_seeds(benchmark), id_col, text_col), "passages")
    rows = pick(documents, doc_id=id_col, text=text_col)
    rows = rows.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"))
    return rows.join(found, _same(rows, found), "left").select(
        rows["doc_id"],
        F.col("item_id").isNotNull().alias("contaminated"),
        "item_id",
        F.coalesce(F.col("n_equal").cast("bigint"), F.lit(0)).alias("n_equal"),
    )


def without_passages(
    documents: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``documents``, all columns as they are, in which no passage is found."""
    found = cut_lineage(find_passages(documents, benchmark_seeds(benchmark), id_col, text_col), "passages")
    rows = numbered(documents)
    columns = rows.columns
    own_id, own_text = (F.col(columns[documents.columns.index(c)]) for c in (id_col, text_col))
    rows = rows.withColumns({"doc_id": own_id, "text_hash": F.xxhash64(F.coalesce(own_text, F.lit("")))})
    return rows.join(found, _same(rows, found), "left_anti").select(*columns).toDF(*documents.columns)
