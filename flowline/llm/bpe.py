"""Byte-level BPE: texts to token ids and back.

The rank file becomes a tokenizer of the tokenizers library over an alphabet
that writes each byte as one printable character. Ids are decoded by the
reverse of that byte table, so any sequence of ids has its bytes, also where a
token ends inside a character; ``spans`` widen such a token to whole characters.
"""

from __future__ import annotations

import base64
import functools

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from flowline.llm.tables import documents_of, map_arrow, pick, slices
from flowline.llm.units import UnitEncoder, byte_characters

ENCODED = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType()))])
SPANNED = T.StructType(
    ENCODED.fields + [T.StructField(c, T.ArrayType(T.IntegerType())) for c in ("char_start", "char_end")]
)
DECODED = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("decoded", T.BinaryType())])
ROUND_TRIP = T.StructType(
    ENCODED.fields + [T.StructField("decoded", T.BinaryType()), T.StructField("n_split", T.LongType())]
)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in file if line.strip())}


def tokenizer_definition(ranks: dict[bytes, int], pattern: str) -> str:
    """The tokenizer that merges, in each match of ``pattern``, the pair with the lowest rank.

    A rank file names no pairs: any two tokens that together are a token merge
    with its rank, so all of them are listed, in order of that rank.
    """
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    table = byte_characters()
    names = {token: "".join(table[b] for b in token) for token in ranks}
    merges = [
        (names[token[:cut]], names[token[cut:]])
        for token in sorted(ranks, key=ranks.get)
        for cut in range(1, len(token))
        if token[:cut] in ranks and token[cut:] in ranks
    ]
    vocabulary = {names[token]: rank for token, rank in ranks.items()}
    tokenizer = Tokenizer(models.BPE(vocab=vocabulary, merges=merges, ignore_merges=True))
    tokenizer.pre_tokenizer = pre_tokenizers.Sequence(
        [
            pre_tokenizers.Split(Regex(pattern), "isolated"),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
        ]
    )
    return tokenizer.to_str()


class Codec:
    """Encoder and decoder of one tokenizer, kept per Python worker."""

    def __init__(self, definition: str) -> None:
        self.units = UnitEncoder(definition)
        back = {c: b for b, c in enumerate(byte_characters())}
        vocabulary = self.units.tokenizer.get_vocab(with_added_tokens=False)
        tokens = [b""] * (max(vocabulary.values()) + 1)
        for name, number in vocabulary.items():
            tokens[number] = bytes(back[c] for c in name)
        self.tokens = tokens
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)
        self.lengths = np.array(list(map(len, tokens)), np.int64)
        self.places = np.cumsum(self.lengths) - self.lengths

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        self.units.tidy()
        return [np.frombuffer(self.units.encode(text), "<u4").astype(np.int32) for text in texts]

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the tokens in a row: a gather from the table of all tokens' bytes."""
        if len(ids) and not 0 <= ids.min() <= ids.max() < len(self.tokens):
            raise ValueError("an id that is not in the vocabulary")
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ids) else 0
        return self.flat[np.arange(total) + np.repeat(self.places[ids] - ends + lengths, lengths)].tobytes()

    def spans(self, raw: bytes, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and past-the-last character of each token."""
        if not len(ids):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        character = np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80) - 1
        ends = np.cumsum(self.lengths[ids])
        return character[ends - self.lengths[ids]], character[ends - 1] + 1

    def n_split(self, ids: np.ndarray) -> int:
        """How many tokens start inside a character."""
        return int(((self.flat[self.places[ids]] & 0xC0) == 0x80).sum())


@functools.lru_cache(maxsize=2)
def codec_of(definition: str) -> Codec:
    return Codec(definition)


def _ids_array(ids: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids).astype(np.int32)))


def _shared(df: DataFrame, definition: str):
    return df.sparkSession.sparkContext.broadcast(definition)


def encode(
    df: DataFrame, definition: str, id_col: str = "doc_id", text_col: str = "text", spans: bool = False
) -> DataFrame:
    """Token ids per row: doc_id, ids, and with ``spans`` the characters char_start to char_end of each token.

    Null and empty texts have no ids; a row is read by itself, so repeated rows
    and null ids give a row each.
    """
    shared = _shared(df, definition)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(shared.value)
        for part in slices(batches):
            texts = part.column("text").to_pylist()
            ids = codec.encode(texts)
            columns = [part.column("doc_id"), _ids_array(ids)]
            if spans:
                found = [codec.spans(text.encode(), own) for text, own in zip(texts, ids)]
                columns += [_ids_array([f[k] for f in found]) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, (SPANNED if spans else ENCODED).names)

    return map_arrow(documents_of(df, id_col, text_col), run, SPANNED if spans else ENCODED)


def decode(df: DataFrame, definition: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """The bytes of each row's ids: doc_id, decoded. A null list gives no bytes; an unknown id is an error."""
    shared = _shared(df, definition)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(shared.value)
        for part in slices(batches):
            decoded = [codec.decode(np.array(ids or [], np.int64)) for ids in part.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(decoded, pa.binary())], DECODED.names)

    return map_arrow(pick(df, doc_id=id_col, ids=ids_col), run, DECODED)


def round_trip(df: DataFrame, definition: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """:func:`encode` and :func:`decode` in one pass: doc_id, ids, decoded, n_split.

    n_split counts the tokens that start inside a character.
    """
    shared = _shared(df, definition)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(shared.value)
        for part in slices(batches):
            ids = codec.encode(part.column("text").to_pylist())
            decoded = [codec.decode(own) for own in ids]
            columns = [
                part.column("doc_id"),
                _ids_array(ids),
                pa.array(decoded, pa.binary()),
                pa.array([codec.n_split(own) for own in ids], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ROUND_TRIP.names)

    return map_arrow(documents_of(df, id_col, text_col), run, ROUND_TRIP)
