"""Token counts, with huge texts counted in overlapping chunks.

A text longer than a chunk is encoded chunk by chunk with offsets. Neighbouring
chunks share an overlap; the count switches from one to the next at a position
where both have a token boundary and which no context can move: between a
character that is no white space and one that is. The pre-tokenizer never
matches across such a place. An overlap without one is widened until it has one
or the text ends.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from flowline.llm.tables import documents_of, map_arrow, slices
from flowline.llm.units import WHITE_SPACE, UnitEncoder

#: Characters of a chunk, and of the overlap that is tried first.
CHUNK_CHARS = 16_384
OVERLAP_CHARS = 256

COUNTED = T.StructType([T.StructField(c, T.LongType()) for c in ("doc_id", "n_bytes", "n_tokens")])

# A place that no context can move lies before each match.
_STABLE = re.compile(f"(?<=[^{WHITE_SPACE}])(?=[{WHITE_SPACE}])")

Offsets = tuple[np.ndarray, np.ndarray]


def count_in_chunks(
    text: str, encode: Callable[[str], Offsets], chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS
) -> int:
    """The number of tokens of ``text``; ``encode`` gives starts and ends of a chunk's tokens."""

    def encoded(start: int, end: int) -> Offsets:
        starts, ends = encode(text[start:end])
        return starts + start, ends + start

    total, begin, end = 0, 0, min(len(text), chunk)
    starts, ends = encoded(0, end)
    while end < len(text):
        shared = overlap
        while True:
            after = max(begin, end - shared)
            new_end = min(len(text), max(end, after + chunk))
            new_starts, new_ends = encoded(after, new_end)
            # The first character of the new chunk has lost what stood before it, so it is no candidate.
            stable = np.array([m.start() for m in _STABLE.finditer(text, after + 1, end)], np.int64)
            common = stable[np.isin(stable, ends) & np.isin(stable, starts) & np.isin(stable, new_starts)]
            if common.size:
                break
            if after == begin:  # nothing to hold on to in the whole chunk: take more of the text into it
                end = min(len(text), 2 * end - begin)
                starts, ends = encoded(begin, end)
                if end == len(text):
                    break
                shared = overlap
            shared *= 2
        if end == len(text) and not common.size:
            break
        begin = int(common[-1])
        total += int((ends <= begin).sum())
        kept = new_starts >= begin
        starts, ends, end = new_starts[kept], new_ends[kept], new_end
    return total + len(starts)


class Counter:
    """Counts with one tokenizer, kept per Python worker."""

    def __init__(self, definition: str) -> None:
        self.units = UnitEncoder(definition)
        self.tokenizer = self.units.tokenizer

    def offsets(self, chunk: str) -> Offsets:
        found = np.array(self.tokenizer.encode(chunk, add_special_tokens=False).offsets, np.int64).reshape(-1, 2)
        return found[:, 0], found[:, 1]

    def count(self, texts: list[str], chunk: int, overlap: int) -> list[int]:
        self.units.tidy()
        return [
            len(self.units.encode(text)) // 4
            if len(text) <= chunk
            else count_in_chunks(text, self.offsets, chunk, overlap)
            for text in texts
        ]


@functools.lru_cache(maxsize=2)
def counter_of(definition: str) -> Counter:
    return Counter(definition)


def count_tokens(
    df: DataFrame,
    definition: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk_chars: int = CHUNK_CHARS,
    overlap_chars: int = OVERLAP_CHARS,
) -> DataFrame:
    """doc_id, n_bytes (UTF-8) and n_tokens of each row; null and empty texts have none of either.

    ``definition`` is the JSON text of a tokenizer whose pre-tokenizer ends a
    match before white space. Special strings inside a text count as the library
    counts them; none are added. Repeated rows and null ids give a row each.
    """
    shared = df.sparkSession.sparkContext.broadcast(definition)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_of(shared.value)
        for part in slices(batches):
            texts = part.column("text").to_pylist()
            columns = [
                part.column("doc_id"),
                pa.array([len(text.encode()) for text in texts], pa.int64()),
                pa.array(counter.count(texts, chunk_chars, overlap_chars), pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, COUNTED.names)

    return map_arrow(documents_of(df, id_col, text_col), run, COUNTED)
