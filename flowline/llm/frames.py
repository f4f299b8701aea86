"""Token-id files: one zstandard frame per document and a seek table behind them.

A file is a sequence of independent frames, each holding a document's ids as
little-endian unsigned 32-bit integers, and then one skippable frame with the
seek table. Any zstandard decoder reads the file as all ids in a row; a reader
that looks at the table first decompresses only the documents it was asked for.

    frame ... frame | skippable: entry ... entry, footer

An entry is ENTRY (place of the frame, its bytes, ids before it in the file, its
ids, crc32 of its ids, document id, 1 if it has one, crc32 of the frame), the footer is the number
of entries and MAGIC. Files are numbered in the order of their documents;
``_manifest`` has a row for each.
"""

from __future__ import annotations

import itertools
import struct
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowline.llm.tables import documents_of, map_arrow, slices
from flowline.llm.units import UNIT, Memory, UnitEncoder

SKIPPABLE = struct.Struct("<II")
SKIPPABLE_MAGIC = 0x184D2A50  # fixed value of the zstandard format
ENTRY = np.dtype(
    [("place", "<u8"), ("size", "<u4"), ("before", "<u8"), ("n_ids", "<u8"), ("crc32", "<u4"), ("doc_id", "<i8"), ("has_id", "u1"),
     ("stored_crc32", "<u4")]
)
FOOTER = struct.Struct("<Q8s")
MAGIC = b"IDFRAME2"
ID_TYPE = np.dtype("<u4")

MANIFEST = T.StructType(
    [T.StructField("file", T.StringType()), T.StructField("n_docs", T.LongType()), T.StructField("n_ids", T.LongType())]
)
READ = T.StructType(
    [T.StructField(c, T.LongType()) for c in ("doc_id", "start", "n_tokens")] + [T.StructField("ids", T.BinaryType())]
)

#: Words that a writing task remembers, twice as many at most between two pieces of text.
WORDS_HELD = 400_000
#: Documents that a reading task takes from the seek table at a time.
DOCS_PER_READ = 4096
#: Bytes that a reader takes at once where frames follow each other.
READ_BYTES = 1 << 20


def open_folder(uri: str):
    """File system and path of a folder that driver and executors share."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


class FrameWriter:
    """Writes the frames of one file one after another; ``close`` adds the seek table."""

    def __init__(self, sink, level: int = 3) -> None:
        import zstandard

        self.sink, self.compress = sink, zstandard.ZstdCompressor(level=level).compress
        self.place = self.n_ids = 0
        self.entries: list[tuple] = []

    def add(self, doc_id: int | None, raw: bytes) -> None:
        frame = self.compress(raw)
        n = len(raw) // ID_TYPE.itemsize
        known = doc_id or 0, doc_id is not None
        self.entries.append((self.place, len(frame), self.n_ids, n, zlib.crc32(raw), *known, zlib.crc32(frame)))
        self.sink.write(frame)
        self.place += len(frame)
        self.n_ids += n

    def close(self) -> None:
        table = np.array(self.entries, ENTRY).tobytes() + FOOTER.pack(len(self.entries), MAGIC)
        if len(table) >= 2**32:
            raise ValueError("too many documents for one file; write more files")
        self.sink.write(SKIPPABLE.pack(SKIPPABLE_MAGIC, len(table)) + table)


class FrameReader:
    """Reads a file's seek table, and then the frames asked for."""

    def __init__(self, source) -> None:
        self.source = source
        size = source.size()
        if size < FOOTER.size:
            raise ValueError("not a token-id file")
        n, magic = FOOTER.unpack(source.read_at(FOOTER.size, size - FOOTER.size))
        length = n * ENTRY.itemsize
        if magic != MAGIC or length > size - FOOTER.size:
            raise ValueError("not a token-id file, or one that was cut")
        self.end = size - FOOTER.size - length
        self.entries = np.frombuffer(source.read_at(length, self.end), ENTRY)

    def frames(self, chosen: np.ndarray) -> Iterator[tuple[int | None, int, int, bytes]]:
        """(doc_id, ids before it in the file, number of ids, their bytes) of the entries numbered in ``chosen``.

        Frames that lie side by side are read together, up to READ_BYTES. A wrong
        checksum is an error.
        """
        import zstandard

        decompress = zstandard.ZstdDecompressor().decompress
        own = self.entries[chosen]
        columns = [own[name].tolist() for name in ENTRY.names]
        begin, held = 0, b""
        for place, size, before, n_ids, crc32, doc_id, has_id, stored_crc32 in zip(*columns):
            if not begin <= place <= place + size <= begin + len(held):
                begin, held = place, self.source.read_at(max(size, min(READ_BYTES, self.end - place)), place)
            frame = held[place - begin : place - begin + size]
            if zlib.crc32(frame) != stored_crc32:
                raise ValueError(f"damaged frame at {place}")
            raw = decompress(frame, max_output_size=n_ids * ID_TYPE.itemsize)
            if len(raw) != n_ids * ID_TYPE.itemsize or zlib.crc32(raw) != crc32:
                raise ValueError(f"damaged frame at {place}")
            yield doc_id if has_id else None, before, n_ids, raw


class IdBytes:
    """Texts to the bytes of their ids, with a tokenizer that drops white space between words.

    What stands between white space is remembered, in small letters where the
    tokenizer folds them; a word with marks around it is put together from the
    units of :class:`UnitEncoder` once.
    """

    def __init__(self, definition: str, end_id: int | None) -> None:
        self.units = UnitEncoder(definition)
        self.words = Memory(self._encode, WORDS_HELD)
        self.end = b"" if end_id is None else np.array([end_id], ID_TYPE).tobytes()

    def _encode(self, word: str) -> bytes:
        found = [word] if word.isalpha() else UNIT.findall(word)
        return self.units.encode_unit(word) if len(found) == 1 else b"".join(map(self.words.__getitem__, found))

    def _text(self, text: str) -> bytes:
        # Python counts these as white space, Unicode does not.
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return self.units.encode(text)
        return b"".join(map(self.words.__getitem__, self.units.folded(text).split()))

    def encode(self, texts: list[str]) -> list[bytes]:
        self.units.tidy()
        self.words.tidy()
        return [self._text(text) + self.end for text in texts]


_ENCODERS: dict[tuple[str, int | None], IdBytes] = {}


def _encoder_of(definition: str, end_id: int | None) -> IdBytes:
    if (definition, end_id) not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[definition, end_id] = IdBytes(definition, end_id)
    return _ENCODERS[definition, end_id]


def write_token_files(
    df: DataFrame,
    folder: str,
    definition: str,
    end_id: int | None,
    n_files: int,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Encodes all texts and writes them to ``folder`` in ascending order of the id.

    ``definition`` is the JSON text of a tokenizer that normalises and splits
    each word between ASCII white space by itself. Null texts count as empty
    ones and give a frame with the end id alone; null ids come first; rows with
    one id are ordered by text, repeated rows all stay. An empty table gives an
    empty manifest. A lost task writes its file anew under the same name.
    """
    shared = df.sparkSession.sparkContext.broadcast(definition)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder_of(shared.value, end_id)
        task = TaskContext.get()
        files, root = open_folder(folder)
        name = f"part-{task.partitionId():05d}.ids"
        unfinished = f"{root}/.{name}.{task.taskAttemptId()}"
        writer = sink = None
        for part in slices(batches):
            if writer is None and part.num_rows:
                sink = files.open_output_stream(unfinished)
                writer = FrameWriter(sink)
            for doc_id, raw in zip(part.column("doc_id").to_pylist(), encoder.encode(part.column("text").to_pylist())):
                writer.add(doc_id, raw)
        if writer is not None:
            writer.close()
            sink.close()
            files.move(unfinished, f"{root}/{name}")
            row = {"file": [name], "n_docs": [len(writer.entries)], "n_ids": [writer.n_ids]}
            yield pa.RecordBatch.from_pydict(row)

    files, root = open_folder(folder)
    files.create_dir(root, recursive=True)
    ordered = documents_of(df, id_col, text_col).withColumn("tie", F.xxhash64("text"))
    ordered = ordered.repartitionByRange(n_files, "doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text")
    map_arrow(ordered.select("doc_id", "text"), write, MANIFEST).write.parquet(f"{folder}/_manifest")


def _numbers(entries: np.ndarray, wanted: np.ndarray | None) -> np.ndarray:
    if wanted is None:
        return np.arange(len(entries))
    return np.flatnonzero(np.isin(entries["doc_id"], wanted) & (entries["has_id"] == 1))


def read_token_files(spark: SparkSession, folder: str, doc_ids: Sequence[int] | None = None) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens and ids (bytes) per document.

    With ``doc_ids`` only those documents are decompressed. Every frame is
    checked against its crc32.
    """
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/_manifest")
    # One row per file, so the running total over all of them is short.
    before = F.sum("n_ids").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))
    parts = manifest.withColumn("before", F.coalesce(before, F.lit(0)))
    pieces = F.sequence(F.lit(0), F.col("n_docs") - 1, F.lit(DOCS_PER_READ))
    parts = parts.select("file", "before", F.explode(pieces).alias("first"))
    # A number given here keeps adaptive execution from joining rows that stand for much work.
    parts = parts.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "file", "first")
    wanted = None if doc_ids is None else np.array(sorted(set(doc_ids)), np.int64)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = open_folder(folder)
        for batch in batches:
            for piece in batch.to_pylist():
                with files.open_input_file(f"{root}/{piece['file']}") as source:
                    reader = FrameReader(source)
                    last = piece["first"] + DOCS_PER_READ
                    chosen = _numbers(reader.entries[piece["first"] : last], wanted) + piece["first"]
                    yield from _read_batches(reader.frames(chosen), piece["before"])

    return map_arrow(parts, read, READ)


def _read_batches(frames: Iterator[tuple], before: int, rows: int = 512) -> Iterator[pa.RecordBatch]:
    while found := list(itertools.islice(frames, rows)):
        doc_ids, starts, counts, raw = zip(*found)
        columns = [
            pa.array(doc_ids, pa.int64()),
            pa.array([before + start for start in starts], pa.int64()),
            pa.array(counts, pa.int64()),
            pa.array(raw, pa.binary()),
        ]
        yield pa.RecordBatch.from_arrays(columns, READ.names)
