"""SimHash near-duplicates by multi-index hashing.

A fingerprint of 64 bits is cut into segments. Fingerprints that differ in few
bits differ in very few bits of some segment, so every fingerprint looks up, per
segment, all values in a small Hamming ball around its own value in a table of
the others, and the complete distance of what it finds is verified.

A table bucket with very many fingerprints is not searched pair by pair. Two
fingerprints at distance d have common points at half that distance from both,
so each member of such a bucket is hung on all points near it, and the few that
share a point are linked; the work grows with the members, not with their pairs.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowline.llm.components import connected_components
from flowline.llm.tables import documents_of, map_arrow, numbered, slices
from flowline.operators.keys import group_apart
from flowline.session import cut_lineage

BITS = 64
SHINGLE_WORDS = 4
MAX_DISTANCE = 4
SEED = 42
SEGMENTS = 3
#: Fingerprints of a bucket that are still compared pair by pair.
BUCKET_PAIRS = 1024

PRINTED = T.StructType([T.StructField(c, T.LongType()) for c in ("doc_id", "text_hash", "fp")])


def fingerprint(text: str, words: int = SHINGLE_WORDS, piece: int = 16_384) -> int:
    """The fingerprint as an unsigned number.

    Words are runs of bytes other than ASCII white space, A-Z in lower case. A
    text with fewer words than a shingle is one shingle, one without words is 0.
    """
    import xxhash

    own = text.encode().lower().split()
    if not own:
        return 0
    ends = np.cumsum([len(w) + 1 for w in own]) - 1
    n = max(1, len(own) - words + 1)
    joined = b" ".join(own)
    starts = np.concatenate([[0], ends[: n - 1] + 1]).astype(np.int64)
    stops = ends[-n:]
    digest, counts = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    for at in range(0, n, piece):
        spans = zip(starts[at : at + piece].tolist(), stops[at : at + piece].tolist())
        hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64)
        counts += np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, np.int64)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, text_hash and fp (the 64 bits as bigint) per row; null texts count as empty ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            found = np.array([fingerprint(t, words) for t in part.column("text").to_pylist()], np.uint64)
            columns = [part.column("doc_id"), part.column("text_hash"), pa.array(found.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, PRINTED.names)

    documents = documents_of(df, id_col, text_col).select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    return map_arrow(documents, run, PRINTED)


@dataclass(frozen=True)
class Segment:
    """Bits ``shift`` to ``shift + width - 1``, searched up to ``radius`` differing bits."""

    number: int
    shift: int
    width: int
    radius: int

    def key(self, fp: Column) -> Column:
        """The segment's value, with its number above it so that all segments share a table."""
        value = F.shiftrightunsigned(fp, self.shift).bitwiseAND(F.lit((1 << self.width) - 1))
        return value.bitwiseOR(F.lit(self.number << BITS - 8))

    def bits(self) -> range:
        return range(self.shift, self.shift + self.width)


def segments_of(n: int, distance: int) -> list[Segment]:
    """``n`` segments with the smallest radii that miss no pair within ``distance``.

    Were every segment beyond its radius, the distances would add up to more
    than ``distance``: with r = distance // n, the first distance % n + 1
    segments are searched up to r and the others up to r - 1.
    """
    if not 2 <= n <= BITS // 2 or distance < 0 or distance % 2:
        raise ValueError("from 2 to 32 segments, and an even distance: points midway are used")
    cuts = [BITS * k // n for k in range(n + 1)]
    r, extra = divmod(distance, n)
    whole = [Segment(k, cuts[k], cuts[k + 1] - cuts[k], r if k <= extra else r - 1) for k in range(n)]
    return [s for s in whole if s.radius >= 0]


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def ball(bits: range | list[int], radius: int) -> list[int]:
    """All masks of up to ``radius`` of the ``bits``, as bigint values, the empty one first."""
    return [
        _signed(sum(1 << b for b in chosen)) for k in range(radius + 1) for chosen in itertools.combinations(bits, k)
    ]


def _masks(values: list[int]) -> Column:
    return F.array(*[F.lit(v).cast("bigint") for v in values])


def _distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def _probes(prints: DataFrame, segments: list[Segment]) -> DataFrame:
    """(key, fp, seen): every bucket a fingerprint looks into; ``seen`` is fp moved into that bucket."""
    looks = []
    for s in segments:
        masks = prints.select("fp", F.explode(_masks(ball(s.bits(), s.radius))).alias("mask"))
        moved = F.col("fp").bitwiseXOR(F.col("mask"))
        looks.append(masks.select(s.key(moved).alias("key"), "fp", moved.alias("seen")))
    out = looks[0]
    for more in looks[1:]:
        out = out.union(more)
    return out


def _table(prints: DataFrame, segments: list[Segment]) -> DataFrame:
    return prints.select("fp", F.explode(F.array(*[s.key(F.col("fp")) for s in segments])).alias("key"))


def _links_at_points(probes: DataFrame, segments: list[Segment], distance: int) -> DataFrame:
    """Links through buckets too large for pairs.

    In a bucket all that is left to differ are the bits outside its segment.
    Members hang on the points within half of ``distance`` there, visitors that
    spent f bits to get in on those within f less. All at one point lie within
    ``distance`` of each other, and any member and other fingerprint that the
    bucket should join share a point. A point sees no more fingerprints than its
    own ball holds, so the lists below are bounded by widths and radii alone.
    """
    home = distance // 2
    hung = None
    for s in segments:
        rest = [b for b in range(BITS) if b not in s.bits()]
        own = probes.filter(F.shiftrightunsigned("key", BITS - 8) == s.number)
        own = own.withColumn("spent", _distance(F.col("fp"), F.col("seen")))
        for spent in range(s.radius + 1):
            reach = home - spent
            points = own.filter(F.col("spent") == spent)
            points = points.select("key", "fp", F.explode(_masks(ball(rest, reach))).alias("mask"), "seen")
            points = points.select("key", F.col("seen").bitwiseXOR(F.col("mask")).alias("point"), "fp")
            hung = points if hung is None else hung.union(points)
    met = hung.groupBy("key", "point").agg(F.collect_set("fp").alias("fps")).filter(F.size("fps") > 1)
    met = met.select(F.explode("fps").alias("a"), F.array_min("fps").alias("b"))
    return met.filter("a != b")


def near_links(
    prints: DataFrame, distance: int = MAX_DISTANCE, segments: int = SEGMENTS, bucket_pairs: int = BUCKET_PAIRS
) -> DataFrame:
    """Pairs (a, b) of different fingerprints that join all those within ``distance`` bits.

    ``prints`` has distinct values in ``fp``. Outside buckets of more than
    ``bucket_pairs`` fingerprints every pair within ``distance`` is there;
    inside them, enough pairs within ``distance`` to connect the same ones.
    """
    cut = segments_of(segments, distance)
    shelf = _table(prints, cut)
    large = shelf.groupBy("key").count().filter(F.col("count") > bucket_pairs).select("key")
    large = cut_lineage(large, "large-buckets")
    probes = _probes(prints, cut)
    some_large = not large.isEmpty()
    small = shelf.join(large, "key", "left_anti") if some_large else shelf
    found = probes.alias("p").join(
        small.alias("t"),
        (F.col("p.key") == F.col("t.key"))
        & (F.col("p.fp") < F.col("t.fp"))
        & (_distance(F.col("p.fp"), F.col("t.fp")) <= distance),
    )
    links = found.select(F.col("p.fp").alias("a"), F.col("t.fp").alias("b"))
    if some_large:
        links = links.union(_links_at_points(probes.join(large, "key", "left_semi"), cut, distance))
    return links


def near_duplicates(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = SHINGLE_WORDS,
    distance: int = MAX_DISTANCE,
    segments: int = SEGMENTS,
    bucket_pairs: int = BUCKET_PAIRS,
) -> DataFrame:
    """doc_id, text_hash, fp, root and component_id per row of ``df``.

    root names the component: the smallest of its fingerprints.

    component_id is the smallest doc_id among all rows that can be reached over
    fingerprints within ``distance`` bits; null only where no such row has an
    id. Null and empty texts have fingerprint 0 and are linked like any other.
    Equal fingerprints meet in one row before anything is searched, so copies
    cost nothing more.
    """
    prints = cut_lineage(fingerprints(df, id_col, text_col, words), "prints")
    different = cut_lineage(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "different-prints")
    nodes = connected_components(near_links(different.select("fp"), distance, segments, bucket_pairs))
    placed = different.join(nodes.select(F.col("node").alias("fp"), "root"), "fp", "left")
    placed = placed.select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    # A component may hold much of the table, so its rows stay splittable at the join.
    named = group_apart(placed, ["root"], F.min("first_id").alias("component_id"))
    classes = cut_lineage(placed.join(named, "root").select("fp", "root", "component_id"), "print-classes")
    return prints.join(classes, "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


def one_per_group(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """Rows of ``df`` without near-duplicates: of each component the row with the smallest id stays.

    Of several rows with that id the one whose text has the smallest hash stays,
    of repeated rows one. All columns are kept as they are.
    """
    found = cut_lineage(near_duplicates(df, id_col, text_col, **how), "near-duplicates")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("first")
    kept = found.groupBy("root").agg(first).select("first.doc_id", "first.text_hash")
    rows = numbered(df)
    columns = rows.columns
    own_id, own_text = (F.col(columns[df.columns.index(c)]) for c in (id_col, text_col))
    rows = rows.withColumns({"doc_id": own_id.cast("bigint"), "text_hash": F.xxhash64(F.coalesce(own_text, F.lit("")))})
    # Repeated rows meet before the shuffle.
    rows = rows.dropDuplicates(["doc_id", "text_hash"])
    same = rows["doc_id"].eqNullSafe(kept["doc_id"]) & (rows["text_hash"] == kept["text_hash"])
    return rows.join(kept, same, "left_semi").select(*columns).toDF(*df.columns)
