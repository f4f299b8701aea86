"""Document fingerprints that can be subtracted: invertible Bloom lookup sketches of paragraphs.

A text is cut into paragraphs, long ones at places that their bytes choose, and
each piece becomes a digest. A sketch adds every digest to one cell in each of
three tables; a cell holds a count, a sum of digests and a sum of check values.
Subtracting the sketches of two versions leaves their differing digests, and
cells with one digest left give it away: it is taken out of its other cells,
which uncovers the next. If that comes to a halt, the versions differ in more
than the cells can tell, and larger sketches are tried.

A sketch of few cells, written as text, is the fingerprint.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowline.llm.tables import documents_of, map_arrow, slices

TABLES = 3
#: Cells per table of a fingerprint, and the factor of the next try.
CELLS = 8
GROWTH = 4
#: Bytes after which a piece is cut where its bytes have not said so.
LONGEST_PIECE = 256
_SEED = 17

COMPARED = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("n_chars", T.LongType())]
    + [T.StructField(c, T.StringType()) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")]
    + [T.StructField(c, T.DoubleType()) for c in ("near_edited", "near_next")]
    + [T.StructField(c, T.LongType()) for c in ("n_removed", "n_added")]
)
CHANGES = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("near", T.DoubleType())]
    + [T.StructField(c, T.ArrayType(T.LongType())) for c in ("removed", "added")]
)


def _mix(keys: np.ndarray, salt: int) -> np.ndarray:
    """A well spread 64-bit value for each key."""
    z = keys + np.uint64((0x9E3779B97F4A7C15 * (salt + 1)) % 2**64)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def cuts(raw: bytes) -> list[int]:
    """Ends of the pieces: line breaks, spaces behind some pairs of bytes, and every LONGEST_PIECE bytes between them."""
    data = np.frombuffer(raw, np.uint8)
    breaks = data == 10
    spaces = data == 32
    pair = np.zeros(len(data), np.uint16)
    pair[2:] = data[1:-1].astype(np.uint16) * 31 + data[:-2]
    ends = np.flatnonzero(breaks | (spaces & ((pair * np.uint16(40503) >> np.uint16(13)) == 0))) + 1
    ends = np.unique(np.append(ends, len(data)))
    gaps = np.diff(ends, prepend=0)
    if gaps.max() > LONGEST_PIECE:
        firsts = ends - gaps
        more = [np.arange(a + LONGEST_PIECE, b, LONGEST_PIECE) for a, b in zip(firsts, ends) if b - a > LONGEST_PIECE]
        ends = np.unique(np.concatenate([ends, *more]))
    return ends.tolist()


def digests(text: str) -> np.ndarray:
    """One 64-bit value per piece; those of equal pieces differ by how often the piece occurred before."""
    import xxhash

    raw = text.encode()
    if not raw:
        return np.zeros(0, np.uint64)
    ends = cuts(raw)
    digest = xxhash.xxh64_intdigest
    found = np.array([digest(raw[a:b], _SEED) for a, b in zip([0, *ends], ends)], np.uint64)
    order = np.argsort(found, kind="stable")
    ranked = found[order]
    new = np.append(True, ranked[1:] != ranked[:-1])
    places = np.arange(len(ranked))
    nth = places - np.maximum.accumulate(np.where(new, places, 0))
    found[order] = np.where(nth > 0, _mix(ranked + _mix(nth.astype(np.uint64), 7), 8), ranked)
    return found


class Sketches:
    """Sketches of several digest sets, all with the same number of cells."""

    def __init__(self, sets: Sequence[np.ndarray], cells: int) -> None:
        self.cells = cells
        size = len(sets) * TABLES * cells
        self.count, self.total, self.check = np.zeros(size, np.int64), np.zeros(size, np.uint64), np.zeros(size, np.uint64)
        keys = np.concatenate([np.zeros(0, np.uint64), *sets])
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        self._add(keys, owner, np.ones(len(keys), np.int64))

    def _add(self, keys: np.ndarray, owner: np.ndarray, times: np.ndarray) -> None:
        wrapped = times.astype(np.uint64)
        checks = _mix(keys, 0) * wrapped
        for t in range(TABLES):
            place = (owner * TABLES + t) * self.cells + (_mix(keys, t + 1) % np.uint64(self.cells)).astype(np.int64)
            np.add.at(self.count, place, times)
            np.add.at(self.total, place, keys * wrapped)
            np.add.at(self.check, place, checks)

    def subtract(self, other: Sketches) -> None:
        self.count -= other.count
        self.total -= other.total
        self.check -= other.check

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(owner, digest, +1 or -1) of everything that can be taken out; what cannot stays in the cells."""
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while True:
            lone = np.flatnonzero(np.abs(self.count) == 1)
            sign = self.count[lone]
            keys = self.total[lone] * sign.astype(np.uint64)
            pure = _mix(keys, 0) * sign.astype(np.uint64) == self.check[lone]
            if not pure.any():
                break
            lone, sign, keys = lone[pure], sign[pure], keys[pure]
            owner = lone // (TABLES * self.cells)
            order = np.lexsort((keys, owner))
            owner, keys, sign = owner[order], keys[order], sign[order]
            first = np.append(True, (owner[1:] != owner[:-1]) | (keys[1:] != keys[:-1]))
            owner, keys, sign = owner[first], keys[first], sign[first]
            self._add(keys, owner, -sign)
            out.append((owner, keys, sign))
        if not out:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
        return tuple(np.concatenate(parts) for parts in zip(*out))

    def emptied(self) -> np.ndarray:
        """Of each sketch, whether nothing is left in it."""
        left = (self.count != 0) | (self.total != 0) | (self.check != 0)
        return ~left.reshape(-1, TABLES * self.cells).any(axis=1)

    def written(self, at: int) -> str:
        """One sketch as text: counts, sums and check values of its cells."""
        own = slice(at * TABLES * self.cells, (at + 1) * TABLES * self.cells)
        parts = (self.count[own].astype("<u4"), self.total[own].astype("<u8"), self.check[own].astype("<u4"))
        return base64.b64encode(b"".join(p.tobytes() for p in parts)).decode()


def differences(old: Sequence[np.ndarray], new: Sequence[np.ndarray], cells: int = CELLS) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per pair the digests only in the old set and only in the new one, by subtracted sketches.

    Pairs whose sketches do not come out empty are tried again with GROWTH
    times the cells, so the work for a pair follows the size of its difference.
    """
    out: list = [None] * len(old)
    pending = np.arange(len(old))
    while len(pending):
        left = Sketches([old[i] for i in pending], cells)
        left.subtract(Sketches([new[i] for i in pending], cells))
        owner, keys, sign = left.peel()
        done = left.emptied()
        order = np.argsort(owner, kind="stable")
        owner, keys, sign = owner[order], keys[order], sign[order]
        edges = np.searchsorted(owner, np.arange(len(pending) + 1))
        for k in np.flatnonzero(done):
            own, side = keys[edges[k] : edges[k + 1]], sign[edges[k] : edges[k + 1]]
            out[pending[k]] = (own[side > 0], own[side < 0])
        pending = pending[~done]
        cells *= GROWTH
    return out


def likeness(old: np.ndarray, new: np.ndarray, removed: int, added: int) -> float:
    """Twice the shared pieces by all pieces; 1 for two texts without any."""
    pieces = len(old) + len(new)
    return 1.0 - (removed + added) / pieces if pieces else 1.0


def compare(df: DataFrame, id_col: str = "doc_id", old_col: str = "old", new_col: str = "new") -> DataFrame:
    """doc_id, near, and the digests removed and added between two columns of texts; null texts count as empty ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 64):
            old, new = ([digests(t or "") for t in part.column(c).to_pylist()] for c in (1, 2))
            changed = differences(old, new)
            near = [likeness(a, b, len(r), len(d)) for a, b, (r, d) in zip(old, new, changed)]
            lists = [pa.array([c[k].view(np.int64) for c in changed], pa.list_(pa.int64())) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(near, pa.float64()), *lists], CHANGES.names)

    places = [df.columns.index(c) for c in (id_col, old_col, new_col)]
    rows = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    rows = rows.select(*[F.col(f"c{at}").cast(kind).alias(f"v{k}") for k, (at, kind) in enumerate(zip(places, ("bigint", "string", "string")))])
    return map_arrow(rows, run, CHANGES)


def edited(text: str, following: str) -> str:
    """``text`` with its second half replaced by as much of the beginning of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _rows_with_next(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[list[tuple[int | None, str, str]]]:
    """(doc_id, text, next text) of the rows that are not only there to be looked at."""
    held = None
    for part in slices(batches, rows):
        out = []
        columns = (part.column(c).to_pylist() for c in ("doc_id", "text", "ahead"))
        for doc_id, text, ahead in zip(*columns):
            if held is not None:
                out.append((*held, text))
            held = None if ahead else (doc_id, text)
        yield out


def _compare_versions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in _rows_with_next(batches, 64):
        if not rows:
            continue
        versions = [edited(text, following) for _, text, following in rows]
        own = [digests(text) for _, text, _ in rows]
        # The text behind a row is mostly the next row's.
        after = [
            own[k + 1] if k + 1 < len(rows) and rows[k + 1][1] is following else digests(following)
            for k, (_, _, following) in enumerate(rows)
        ]
        other = [digests(text) for text in versions]
        prints, other_prints = Sketches(own, CELLS), Sketches(other, CELLS)
        changed, apart = differences(own, other), differences(own, after)
        columns = {
            "doc_id": [r[0] for r in rows],
            "n_chars": [len(r[1]) for r in rows],
            "edited_sha256": [hashlib.sha256(v.encode()).hexdigest() for v in versions],
            "fingerprint": [prints.written(k) for k in range(len(rows))],
            "edited_fingerprint": [other_prints.written(k) for k in range(len(rows))],
            "near_edited": [likeness(a, b, len(r), len(d)) for a, b, (r, d) in zip(own, other, changed)],
            "near_next": [likeness(a, b, len(r), len(d)) for a, b, (r, d) in zip(own, after, apart)],
            "n_removed": [len(r) for r, _ in changed],
            "n_added": [len(d) for _, d in changed],
        }
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(columns.values(), _COMPARED_TYPES)], COMPARED.names)


_COMPARED_TYPES = [pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2, *[pa.int64()] * 2]
_FIRST = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("tie", T.LongType())])


def _first_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first row of a partition."""
    for batch in batches:
        if batch.num_rows:
            yield batch.slice(0, 1)
            return


def _rank(doc_id: int | None, tie: int) -> tuple[bool, int, int]:
    """Sorts as the documents do: by descending id, null last, then by the hash of the text."""
    return doc_id is None, -(doc_id or 0), tie


def compare_with_edits(df: DataFrame, parts: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text and of its version edited with the next document's text.

    Next is the next row by descending id; null ids come last, rows of one id are
    ordered by their texts, and after the last row comes the first. Null texts
    count as empty ones; a single row is its own next.

    The rows are cut into about ``parts`` ranges. A first pass over ids finds
    where the ranges begin, which is all that reaches the driver; the row that
    begins a range is also sent to the end of the range before it.
    """
    rows = documents_of(df, id_col, text_col).withColumn("tie", F.xxhash64("text"))
    order = [F.col("doc_id").desc_nulls_last(), F.col("tie")]
    ordered = rows.select("doc_id", "tie").repartitionByRange(parts, *order).sortWithinPartitions(*order)
    firsts = map_arrow(ordered, _first_rows, _FIRST).collect()
    begins = sorted({_rank(r.doc_id, r.tie): (r.doc_id, r.tie) for r in firsts}.items())
    ranks = [rank for rank, _ in begins]
    schema = T.StructType([T.StructField("part", T.IntegerType()), *rows.schema.fields])

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = zip(batch.column("doc_id").to_pylist(), batch.column("tie").to_pylist())
            part = [bisect.bisect_right(ranks, _rank(doc_id, tie)) - 1 for doc_id, tie in keys]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), *batch.columns], schema.names)

    spark = df.sparkSession
    before = [(i, tie, (k - 1) % len(begins)) for k, (_, (i, tie)) in enumerate(begins)]
    before = spark.createDataFrame(before, "begin_id bigint, begin_tie bigint, part int")
    begun = F.col("doc_id").eqNullSafe(F.col("begin_id")) & (F.col("tie") == F.col("begin_tie"))
    # As many rows as there are ranges, so they may be broadcast.
    ahead = rows.join(F.broadcast(before), begun).select("part", *rows.columns).dropDuplicates(["part"])
    inside = map_arrow(rows, dealt, schema).withColumn("ahead", F.lit(False))
    whole = inside.unionByName(ahead.withColumn("ahead", F.lit(True))).repartitionById(max(1, len(begins)), "part")
    whole = whole.sortWithinPartitions("part", "ahead", *order, "text")
    return map_arrow(whole.select("doc_id", "text", "ahead"), _compare_versions, COMPARED)
