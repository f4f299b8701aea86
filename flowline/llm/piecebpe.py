"""SentencePiece BPE: texts to token ids and back, merged in vectorised rounds.

All different words of a batch of texts lie in one flat array of symbols. A
round finds each word's smallest pair rank, merges that pair wherever it stands
in the word, from the left and without overlap, and closes the gaps; words
without a mergeable pair leave the array. Ranks follow the scores of the merged
pieces, ties go to the left, as in the library.

Merging all places of a word at once equals merging them one after the other
only if the new piece makes no pair that comes before the next place. Pieces
that can (a longer piece of the same or a better score begins or ends with
them, as with runs of spaces) are merged one place a round. Words longer than
LONG_WORD symbols would need too many rounds; they get the same merges from a
priority queue.
"""

from __future__ import annotations

import functools
import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from flowline.llm.tables import documents_of, map_arrow, pick, slices

#: Symbols of a word from which on a priority queue takes the place of rounds.
LONG_WORD = 400
#: Words remembered per Python worker.
REMEMBERED = 300_000

# The mark that stands for a space, and the kinds of pieces in a model file.
SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6

_CODEPOINTS = 0x110000
_NEVER = np.iinfo(np.int32).max

ENCODED = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType()))])
DECODED = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("decoded", T.StringType())])
ROUND_TRIP = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids", T.BinaryType()),
        T.StructField("decoded", T.StringType()),
    ]
)


@dataclass(frozen=True)
class PieceModel:
    """What encoding and decoding need of a model file."""

    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    kinds: tuple[int, ...]
    dummy_prefix: bool
    begin_id: int
    end_id: int
    unknown_id: int
    unknown_surface: str


def read_model(path: str) -> PieceModel:
    """Reads a BPE model with byte fallback whose normaliser leaves characters alone; others are an error."""
    from sentencepiece import sentencepiece_model_pb2

    found = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as file:
        found.ParseFromString(file.read())
    trained, normaliser = found.trainer_spec, found.normalizer_spec
    kinds = tuple(piece.type for piece in found.pieces)
    supported = (
        trained.model_type == trained.BPE
        and trained.byte_fallback
        and not trained.treat_whitespace_as_suffix
        and not normaliser.precompiled_charsmap
        and not normaliser.remove_extra_whitespaces
        and normaliser.escape_whitespaces
        and set(kinds) <= {NORMAL, UNKNOWN, CONTROL, BYTE}
    )
    if not supported:
        raise ValueError("only BPE models with byte fallback, identity normalisation and plain pieces are supported")
    return PieceModel(
        tuple(piece.piece for piece in found.pieces),
        tuple(piece.score for piece in found.pieces),
        kinds,
        normaliser.add_dummy_prefix,
        trained.bos_id,
        trained.eos_id,
        trained.unk_id,
        trained.unk_surface,
    )


class PieceCodec:
    """Encoder and decoder of one model, kept per Python worker.

    Symbols are numbered: first the normal pieces, then characters that occur in
    pieces only, then, from ``self.others`` on, all code points.
    """

    def __init__(self, model: PieceModel) -> None:
        self.model = model
        normal = [i for i, kind in enumerate(model.kinds) if kind == NORMAL]
        names = [model.pieces[i] for i in normal]
        number = {name: at for at, name in enumerate(names)}
        for character in sorted({c for name in names for c in name} - number.keys()):
            number[character] = len(number)
        self.symbols = list(number)
        self.others = len(number)
        # Rank of a piece: place of its score, the best first; equal scores are equal ranks.
        scores = np.array([model.scores[i] for i in normal])
        ranks = np.unique(-scores, return_inverse=True)[1].astype(np.int32)
        self.rank_of = dict(zip(names, ranks.tolist()))

        pairs = [
            (number[name[:cut]], number[name[cut:]], at)
            for at, name in enumerate(names)
            for cut in range(1, len(name))
            if name[:cut] in number and name[cut:] in number
        ]
        table = np.array(pairs, np.int64).reshape(-1, 3)
        self.base = self.others + _CODEPOINTS
        keys = table[:, 0] * self.base + table[:, 1]
        order = np.argsort(keys)
        # A last key that no pair has keeps every search inside the table.
        self.keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.made = np.append(table[order, 2], 0).astype(np.int32)
        self.pair_ranks = np.append(ranks[table[order, 2]], _NEVER).astype(np.int32)
        # Ranks of pieces that are a part of a piece which comes no later.
        self.single = np.zeros(len(scores) + 1, bool)
        for side in (0, 1):
            part = table[:, side]
            known = part < len(names)
            early = ranks[table[known, 2]] <= ranks[part[known]]
            self.single[ranks[part[known][early]]] = True

        self.of_character = np.arange(self.others, self.base, dtype=np.int32)
        for name, at in number.items():
            if len(name) == 1:
                self.of_character[ord(name)] = at
        bytes_at = {int(model.pieces[i][1:-1], 16): i for i, kind in enumerate(model.kinds) if kind == BYTE}
        self.byte_ids = [bytes_at[b] for b in range(256)]
        self.ids = np.array(normal + [-1] * (self.others - len(normal)), np.int64)

        inner = any(SPACE in name.lstrip(SPACE) for name in names)
        # No piece goes on with the mark behind another character, so no merge crosses such a place.
        self.words = re.compile("(?s).+" if inner else f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        self.memory: dict[str, bytes] = {}
        self._prepare_decoding()

    # -- encoding ---------------------------------------------------------

    def _lookup(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks and merged symbols of pairs; _NEVER where there is no such piece."""
        wanted = left.astype(np.int64) * self.base + right
        at = np.searchsorted(self.keys, wanted)
        return np.where(self.keys[at] == wanted, self.pair_ranks[at], _NEVER), self.made[at]

    def merge_rounds(self, words: list[str]) -> list[np.ndarray]:
        """The final symbols of each word."""
        lengths = np.array(list(map(len, words)), np.int64)
        flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")
        symbols = self.of_character[flat]
        done: list[np.ndarray] = [symbols[:0]] * len(words)
        which = np.flatnonzero(lengths)
        sizes = lengths[which]
        ranks, made = np.full(len(symbols), _NEVER, np.int32), np.zeros(len(symbols), np.int32)
        ranks[:-1], made[:-1] = self._lookup(symbols[:-1], symbols[1:])
        ranks[np.cumsum(sizes) - 1] = _NEVER

        while len(which):
            starts = np.cumsum(sizes) - sizes
            least = np.minimum.reduceat(ranks, starts)
            over = least == _NEVER
            if over.any():
                for at in np.flatnonzero(over):
                    done[which[at]] = symbols[starts[at] : starts[at] + sizes[at]]
                stay = np.repeat(~over, sizes)
                symbols, ranks, made = symbols[stay], ranks[stay], made[stay]
                which, sizes, least = which[~over], sizes[~over], least[~over]
                if not len(which):
                    break
                starts = np.cumsum(sizes) - sizes
            places = np.flatnonzero(ranks == np.repeat(least, sizes))
            word = np.searchsorted(starts, places, "right") - 1
            # Overlapping places are a chain; every second of it is merged, from the left.
            fresh = np.ones(len(places), bool)
            fresh[1:] = np.diff(places) > 1
            head = np.maximum.accumulate(np.where(fresh, np.arange(len(places)), 0))
            keep = (np.arange(len(places)) - head) % 2 == 0
            alone = np.ones(len(places), bool)
            alone[1:] = np.diff(word) > 0
            keep &= alone | ~self.single[least[word]]
            places, word = places[keep], word[keep]

            symbols[places] = made[places]
            ranks[places] = ranks[places + 1]  # the word's end stays its end
            gone = np.zeros(len(symbols), bool)
            gone[places + 1] = True
            now = places - np.arange(len(places))
            symbols, ranks, made = symbols[~gone], ranks[~gone], made[~gone]
            sizes = sizes - np.bincount(word, minlength=len(sizes))
            ends = np.zeros(len(symbols), bool)
            ends[np.cumsum(sizes) - 1] = True
            before = now - 1
            touched = np.concatenate([now, before[before >= 0]])
            touched = touched[~ends[touched]]
            ranks[touched], made[touched] = self._lookup(symbols[touched], symbols[touched + 1])
        return done

    def merge_queue(self, word: str) -> list[str]:
        """The same merges one by one, for a long word."""
        parts: list[str | None] = list(word)
        after = list(range(1, len(parts) + 1))
        before = list(range(-1, len(parts) - 1))
        waiting: list[tuple[int, int, str, str]] = []

        def offer(left: int) -> None:
            right = after[left]
            if right < len(parts):
                rank = self.rank_of.get(parts[left] + parts[right])
                if rank is not None:
                    heapq.heappush(waiting, (rank, left, parts[left], parts[right]))

        for left in range(len(parts) - 1):
            offer(left)
        while waiting:
            _, left, first, second = heapq.heappop(waiting)
            right = after[left]
            if parts[left] != first or right >= len(parts) or parts[right] != second:
                continue
            parts[left], parts[right] = first + second, None
            after[left] = after[right]
            if after[left] < len(parts):
                before[after[left]] = left
            if before[left] >= 0:
                offer(before[left])
            offer(left)
        return [part for part in parts if part is not None]

    def _bytes_of(self, character: str) -> list[int]:
        return [self.byte_ids[b] for b in character.encode("utf-8", "surrogatepass")]

    def _ids_of_symbols(self, symbols: np.ndarray) -> bytes:
        known = symbols < self.others
        ids = np.where(known, self.ids[np.where(known, symbols, 0)], -1)
        if (ids >= 0).all():
            return ids.astype("<u4").tobytes()
        found: list[int] = []
        for symbol, number in zip(symbols.tolist(), ids.tolist()):
            if number >= 0:
                found.append(number)
            else:
                found += self._bytes_of(self.symbols[symbol] if symbol < self.others else chr(symbol - self.others))
        return np.array(found, "<u4").tobytes()

    def _remember(self, words: list[str]) -> None:
        short = [word for word in words if len(word) <= LONG_WORD]
        if short:
            merged = self.merge_rounds(short)
            lengths = np.array(list(map(len, merged)), np.int64)
            flat = np.concatenate(merged)
            plain = flat < self.others
            plain[plain] = self.ids[flat[plain]] >= 0
            ids = np.where(plain, self.ids[np.where(plain, flat, 0)], 0).astype("<u4").tobytes()
            ends = 4 * np.cumsum(lengths)
            odd = np.zeros(len(short), bool)
            odd[np.repeat(np.arange(len(short)), lengths)[~plain]] = True
            for word, symbols, start, end, has_bytes in zip(
                short, merged, (ends - 4 * lengths).tolist(), ends.tolist(), odd.tolist()
            ):
                self.memory[word] = self._ids_of_symbols(symbols) if has_bytes else ids[start:end]
        for word in words:
            if len(word) > LONG_WORD:
                found: list[int] = []
                numbers = self.number
                for part in self.merge_queue(word):
                    at = numbers.get(part)
                    found += self._bytes_of(part) if at is None else [at]
                self.memory[word] = np.array(found, "<u4").tobytes()

    @functools.cached_property
    def number(self) -> dict[str, int]:
        return {name: i for i, (name, kind) in enumerate(zip(self.model.pieces, self.model.kinds)) if kind == NORMAL}

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text with the begin and end ids."""
        front = SPACE if self.model.dummy_prefix else ""
        cut = [self.words.findall(front + text.replace(" ", SPACE)) if text else [] for text in texts]
        if len(self.memory) > REMEMBERED:
            self.memory.clear()
        new = set().union(*cut).difference(self.memory)
        if new:
            self._remember(list(new))
        memory = self.memory
        begin, end = np.uint32(self.model.begin_id).tobytes(), np.uint32(self.model.end_id).tobytes()
        found = [np.frombuffer(b"".join([begin, *map(memory.__getitem__, words), end]), "<u4") for words in cut]
        for word in new:
            if len(word) > LONG_WORD:  # hardly met again, and large
                del memory[word]
        return found

    # -- decoding ---------------------------------------------------------

    def _prepare_decoding(self) -> None:
        model = self.model
        surfaces = []
        for name, kind in zip(model.pieces, model.kinds):
            if kind == NORMAL:
                surfaces.append(name.replace(SPACE, " ").encode())
            elif kind == BYTE:
                surfaces.append(bytes([int(name[1:-1], 16)]))
            else:
                surfaces.append(model.unknown_surface.encode() if kind == UNKNOWN else b"")
        self.surfaces = surfaces
        self.kinds = np.array(model.kinds)
        self.flat = np.frombuffer(b"".join(surfaces), np.uint8)
        self.lengths = np.array(list(map(len, surfaces)), np.int64)
        self.places = np.cumsum(self.lengths) - self.lengths

    def decode(self, ids: np.ndarray) -> str:
        """The text of the pieces in a row: control pieces have none, bytes that are no character give U+FFFD each."""
        ids = np.asarray(ids, np.int64)
        if len(ids) and not 0 <= ids.min() <= ids.max() < len(self.surfaces):
            raise ValueError("an id that is not in the vocabulary")
        kinds = self.kinds[ids]
        visible = np.flatnonzero(kinds != CONTROL)
        if not len(visible):
            return ""
        first, last = int(visible[0]), int(visible[-1])
        opening = self.model.pieces[ids[first]] if kinds[first] == NORMAL else ""
        skip = int(self.model.dummy_prefix and opening.startswith(SPACE))
        ids, kinds = ids[first : last + 1], kinds[first : last + 1]
        has_bytes = (kinds == BYTE).any()
        if not has_bytes or len(visible) == len(ids):
            lengths = self.lengths[ids]
            ends = np.cumsum(lengths)
            at = np.arange(int(ends[-1])) + np.repeat(self.places[ids] - ends + lengths, lengths)
            raw = self.flat[at[skip:]].tobytes()
            try:
                return raw.decode()
            except UnicodeDecodeError:
                pass
        return self._decode_runs(ids.tolist(), kinds.tolist())[skip:]

    def _decode_runs(self, ids: list[int], kinds: list[int]) -> str:
        """Piece by piece, for ids whose byte pieces do not make whole characters."""
        parts: list[str] = []
        run = bytearray()

        def close() -> None:
            at = 0
            while at < len(run):
                for size in (1, 2, 3, 4):
                    try:
                        parts.append(run[at : at + size].decode())
                    except UnicodeDecodeError:
                        continue
                    at += size
                    break
                else:
                    parts.append("�")
                    at += 1
            run.clear()

        for number, kind in zip(ids, kinds):
            if kind == BYTE:
                run += self.surfaces[number]
            else:
                close()
                parts.append(self.surfaces[number].decode())
        close()
        return "".join(parts)


@functools.lru_cache(maxsize=2)
def codec_of(model: PieceModel) -> PieceCodec:
    return PieceCodec(model)


def encode(df: DataFrame, model: PieceModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token ids per row with begin and end ids: doc_id, ids.

    Null and empty texts have the two ids only; a row is read by itself, so
    repeated rows and null ids give a row each, and an empty table none.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(shared.value)
        for part in slices(batches):
            ids = codec.encode(part.column("text").to_pylist())
            ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
            flat = pa.array(np.concatenate(ids).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.ListArray.from_arrays(pa.array(ends), flat)], ENCODED.names
            )

    return map_arrow(documents_of(df, id_col, text_col), run, ENCODED)


def decode(df: DataFrame, model: PieceModel, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """The text of each row's ids: doc_id, decoded. A null list gives an empty text; an unknown id is an error."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(shared.value)
        for part in slices(batches):
            texts = [codec.decode(np.array(ids or [], np.int64)) for ids in part.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(texts, pa.string())], DECODED.names)

    return map_arrow(pick(df, doc_id=id_col, ids=ids_col), run, DECODED)


def round_trip(df: DataFrame, model: PieceModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """:func:`encode` and :func:`decode` in one pass: doc_id, n_tokens, ids (unsigned 32-bit, little-endian), decoded."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(shared.value)
        for part in slices(batches):
            ids = codec.encode(part.column("text").to_pylist())
            columns = [
                part.column("doc_id"),
                pa.array(list(map(len, ids)), pa.int64()),
                pa.array([own.tobytes() for own in ids], pa.binary()),
                pa.array(list(map(codec.decode, ids)), pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ROUND_TRIP.names)

    return map_arrow(documents_of(df, id_col, text_col), run, ROUND_TRIP)
