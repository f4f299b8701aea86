"""Language-model scores by masked pseudo-likelihood.

Every token of a text is predicted from the tokens on both sides of it, as if it
alone were hidden; the sum of the logarithms of these probabilities scores the
text. The probability of a token is that of its class, from a network that sees
a window around it, times that of the token within its class.

The OWN most frequent words are classes of their own; the others share classes
by their endings. Of the words of a class the network knows the more frequent
ones, in number a power of the vocabulary: it sees them as themselves and tells
them apart from both sides. All further words of a class have the probability
of their own count in the corpus. These counts stay a Spark table, joined to the
tokens; only those of frequent words are broadcast. Words that were never
counted share the mass that the different words of the class make likely, spread
over all strings of bytes.

Training is data-parallel: each task trains a copy of the network on its
documents, and the copies are averaged, weighted by what they have seen.
"""

from __future__ import annotations

import functools
import itertools
import math
import pickle
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowline.llm.tables import documents_of, map_arrow, slices
from flowline.session import cut_lineage

#: Classes: 0 stands outside of texts, the next OWN are frequent words, the others are endings.
CLASSES = 128
OWN = 95
#: Other words that the network knows: as many as there are different words, to this power.
KNOWN_POWER = 0.4
#: Counts of so many words at most, the most frequent ones, are broadcast; counts are told apart up to COUNT_STEPS.
FREQUENT = 500_000
COUNT_STEPS = 100_000
#: Tokens on either side that the network sees, and its hidden units.
SIDE = 2
HIDDEN = 24
#: Times the copies are averaged; in each of the rounds every ROUNDS-th token of every document is predicted, in all
#: rounds together every token once.
ROUNDS = 3
RATE = 0.3
#: Windows of a training step, tokens scored at a time, and windows of which the classes are held at a time.
STEP_WINDOWS = 2048
SCORE_TOKENS = 8192
BLOCK_WINDOWS = 1024

NAMES = ("near", "hidden", "out", "bias", "inner", "inner_bias")
ENCODED = T.StructType(
    [T.StructField("row", T.LongType()), T.StructField("doc_id", T.LongType()), T.StructField("ids", T.BinaryType())]
    + [T.StructField("within", T.DoubleType()), T.StructField("rare", T.ArrayType(T.StringType()))]
)
COUNTED = T.StructType([T.StructField("word", T.StringType()), T.StructField("n", T.LongType())])
#: Different words that a task counts before it hands them on.
COUNTED_WORDS = 200_000
WEIGHTS = T.StructType([T.StructField("place", T.IntegerType()), T.StructField("value", T.DoubleType())])
SCORED = T.StructType(
    [T.StructField(c, T.LongType()) for c in ("row", "doc_id", "n_tokens")] + [T.StructField("known", T.DoubleType())]
)


@dataclass(frozen=True)
class Vocabulary:
    """What tasks know of the words.

    ``own`` and ``known`` are the words of the network, the latter in the order of their classes, where those of the
    n-th class of endings begin at ``first[n]``. ``frequent`` has counts of further words. Per class, ``within`` has
    the log probabilities that a word outside of these was counted, and that it was not; ``totals`` and ``kinds``
    have the tokens and the different words that were.
    """

    own: tuple[bytes, ...]
    known: tuple[bytes, ...]
    first: np.ndarray
    frequent: dict[bytes, int]
    totals: np.ndarray
    kinds: np.ndarray

    @property
    def within(self) -> np.ndarray:
        # Classes of one word have no others.
        whole = np.maximum(self.totals + self.kinds + 1, 1)
        seen = np.where(np.arange(CLASSES) <= OWN, 1 - 1e-6, np.maximum(self.totals, 1e-6) / whole)
        return np.log(np.stack([seen, 1 - seen], 1)).ravel()

    def places(self) -> dict[bytes, int]:
        """word -> its id << 40 | its count, which is 1 for words of the network; other words are to be looked up."""
        found = {word: class_of(word) << 40 | n for word, n in self.frequent.items()}
        found |= {word: k + 1 << 40 | 1 for k, word in enumerate(self.own)}
        return found | {word: CLASSES + k << 40 | 1 for k, word in enumerate(self.known)}

    def base(self) -> np.ndarray:
        """By id, what is added to the logarithm of a word's count; 0 for words of the network."""
        out = np.zeros(CLASSES + len(self.known))
        out[OWN + 1 : CLASSES] = -np.log(self.totals + self.kinds + 1)[OWN + 1 :]
        return out


def class_of(word: bytes) -> int:
    """The class of a word's ending."""
    return _class_of_ending(word[-2:])


def _class_column(word: Column) -> Column:
    """The same in Spark."""
    return OWN + 1 + F.crc32(F.substring(F.encode(word, "utf-8"), -2, 2)) % (CLASSES - OWN - 1)


@functools.lru_cache(maxsize=2)
def _vocabulary_of(pickled: bytes) -> tuple[np.ndarray, dict[bytes, int]]:
    vocabulary = pickle.loads(pickled)
    return vocabulary.base(), vocabulary.places()


@functools.lru_cache(maxsize=1 << 16)
def _class_of_ending(ending: bytes) -> int:
    return OWN + 1 + zlib.crc32(ending) % (CLASSES - OWN - 1)


def count_words(df: DataFrame) -> DataFrame:
    """(word, n) over all texts; words are runs of characters other than ASCII white space.

    A task hands on its words with their counts, in several pieces where it
    meets many different ones.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def counted() -> pa.RecordBatch:
            words = pa.array(list(counts), pa.binary()).cast(pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array(list(counts.values()), pa.int64())], COUNTED.names)

        for part in slices(batches):
            for text in part.column("text").to_pylist():
                counts.update(text.encode().split())
            if len(counts) > COUNTED_WORDS:
                yield counted()
                counts.clear()
        if counts:
            yield counted()

    return map_arrow(df.select("text"), run, COUNTED).groupBy("word").agg(F.sum("n").alias("n"))


def learn_vocabulary(df: DataFrame) -> Vocabulary:
    """From the words of all texts."""
    return vocabulary_of_counts(cut_lineage(count_words(df), "word-counts"))


def _least_frequent(counted: DataFrame, total: int) -> int:
    """The smallest count that no more than FREQUENT words reach, from the number of words of each count."""
    kinds = counted.groupBy(F.least("n", F.lit(COUNT_STEPS)).alias("n")).agg(F.count(F.lit(1)).alias("kinds"))
    # No more words than FREQUENT can make up one of FREQUENT tokens each, should more of them reach the last step.
    least, reached = max(COUNT_STEPS, -(-total // FREQUENT)), 0
    for r in sorted(kinds.collect(), key=lambda r: -r.n):
        reached += r.kinds
        if reached > FREQUENT:
            break
        least = r.n
    return least


def vocabulary_of_counts(counted: DataFrame) -> Vocabulary:
    """From :func:`count_words`, written. The driver gets the network's words, at most FREQUENT counts, and sums by class."""
    size = counted.agg(F.count(F.lit(1)).alias("kinds"), F.sum("n").alias("n")).first()
    top = counted.orderBy(F.desc("n"), "word").limit(OWN + int(size.kinds**KNOWN_POWER)).collect()
    own = tuple(r.word.encode() for r in top[:OWN])
    known = sorted((class_of(r.word.encode()), r.word.encode()) for r in top[OWN:])
    first = np.searchsorted([k for k, _ in known], np.arange(OWN + 1, CLASSES + 1))

    # In the order of their counts, so that what tasks look up most lies side by side in their memory.
    counts = counted.filter(F.col("n") >= _least_frequent(counted, size.n or 0)).orderBy(F.desc("n"), "word")
    frequent = {r.word.encode(): r.n for r in counts.collect()}
    totals, kinds = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
    sums = counted.groupBy(_class_column(F.col("word")).alias("class")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("kinds"))
    for r in sums.collect():
        totals[r["class"]], kinds[r["class"]] = r.n, r.kinds
    for r in top:
        word = r.word.encode()
        frequent.pop(word, None)
        totals[class_of(word)] -= r.n
        kinds[class_of(word)] -= 1
    return Vocabulary(own, tuple(w for _, w in known), first, frequent, totals, kinds)


def _code(ids: int) -> type:
    return np.uint8 if ids <= 1 << 8 else np.uint16 if ids <= 1 << 16 else np.uint32


def encode(df: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row number, doc_id, the tokens' ids, the summed log probability of the tokens within their classes, and rare words.

    The sum lacks the logarithms of the counts of the words in ``rare``; :func:`rare_sums` looks them up. The row
    numbers hold once the table is written.
    """
    shared = df.sparkSession.sparkContext.broadcast(pickle.dumps(vocabulary))
    code = _code(CLASSES + len(vocabulary.known))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, places = _vocabulary_of(shared.value)
        place_of = places.get
        for part in slices(batches):
            ids, within, rare = [], [], []
            for text in part.column("text").to_pylist():
                words = text.encode().split()
                at = np.fromiter(map(place_of, words, itertools.repeat(-1)), np.int64, len(words))
                unknown = np.flatnonzero(at < 0)
                others = [words[k] for k in unknown.tolist()]
                at[unknown] = [class_of(word) << 40 | 1 for word in others]
                own, n = at >> 40, at & (1 << 40) - 1
                ids.append(own.astype(code).tobytes())
                within.append(float(base[own].sum() + np.log(n).sum()))
                rare.append([word.decode() for word in others])
            columns = [part.column("row"), part.column("doc_id"), pa.array(ids, pa.binary()), pa.array(within, pa.float64())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(rare, pa.list_(pa.string()))], ENCODED.names)

    rows = documents_of(df, id_col, text_col).withColumn("row", F.monotonically_increasing_id())
    return map_arrow(rows, run, ENCODED)


def rare_sums(encoded: DataFrame, counted: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(row, rare): the summed logarithms of the counts of each row's rare words.

    A word that was never counted has the class's mass for such words, times (1 / 257) ** (bytes + 1): a string of
    256 possible bytes each and an end.
    """
    words = encoded.select("row", F.explode("rare").alias("word"))
    mass = F.array(*[F.lit(float(np.log(k + 1))) for k in vocabulary.kinds])
    unseen = F.get(mass, _class_column(F.col("word")).cast("int")) - (F.octet_length("word") + 1) * float(np.log(257))
    return words.join(counted, "word", "left").groupBy("row").agg(F.sum(F.coalesce(F.log("n"), unseen)).alias("rare"))


def initial(seed: int = 0, first: np.ndarray | None = None) -> dict[str, np.ndarray]:
    """``near`` has a row per place of the window and id, ``hidden`` the units' biases, ``out`` and ``bias`` the classes.

    ``inner`` and ``inner_bias`` have, for each class of endings, a row for all unknown words and one for each known
    word; ``first`` says where the latter begin. ``group`` has the class of each id.
    """
    chance = np.random.default_rng(seed)
    first = np.zeros(CLASSES - OWN, np.int64) if first is None else first
    known = int(first[-1])
    groups = np.repeat(np.arange(OWN + 1, CLASSES), np.diff(first))
    return {
        "first": first,
        "group": np.concatenate([np.arange(CLASSES), groups]),
        "inner": np.zeros((known + CLASSES - OWN - 1, HIDDEN), np.float32),
        "inner_bias": np.zeros(known + CLASSES - OWN - 1, np.float32),
        "near": chance.normal(0, 0.3, (2 * SIDE * (CLASSES + known), HIDDEN)).astype(np.float32),
        "hidden": np.zeros(HIDDEN, np.float32),
        "out": chance.normal(0, HIDDEN**-0.5, (HIDDEN, CLASSES)).astype(np.float32),
        "bias": np.zeros(CLASSES, np.float32),
    }


def _flat(p: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([p[name].ravel() for name in NAMES])


def _shaped(flat: np.ndarray, p: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """The values of :func:`_flat` in the shapes of ``p``."""
    out, at = dict(p), 0
    for name in NAMES:
        out[name] = flat[at : at + p[name].size].reshape(p[name].shape).astype(np.float32)
        at += p[name].size
    return out


def _joined(documents: list[bytes], ids: int = CLASSES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All ids in a row with SIDE zeros around each document, the places of the tokens, and their documents."""
    code = np.dtype(_code(ids))
    gap = bytes(SIDE * code.itemsize)
    row = np.frombuffer(gap + gap.join(documents) + gap, code)
    lengths = np.array([len(d) // code.itemsize for d in documents])
    owner = np.repeat(np.arange(len(documents)), lengths)
    return row, np.arange(len(owner)) + SIDE * (owner + 1), owner


class _Space:
    """Arrays by name that are used again and again, so that no step asks for its memory anew.

    What one call took under a name is lost with the next. A worker runs one task at a time.
    """

    def __init__(self) -> None:
        self.held: dict[str, np.ndarray] = {}

    def __call__(self, name: str, dtype: np.dtype, *shape: int) -> np.ndarray:
        size = math.prod(shape)
        held = self.held.get(name)
        if held is None or held.dtype != dtype or held.size < size:
            held = self.held[name] = np.empty(size, dtype)
        return held[:size].reshape(shape)


_space = _Space()


def _windows(row: np.ndarray, places: np.ndarray, ids: int = CLASSES) -> np.ndarray:
    """Rows of ``near`` for the tokens on both sides of each place."""
    offsets = np.array([d for d in range(-SIDE, SIDE + 1) if d])
    return row.take(places[:, None] + offsets) + np.arange(len(offsets)) * ids


def _hidden(p: dict[str, np.ndarray], windows: np.ndarray) -> np.ndarray:
    """Hidden units, and a last column of ones that stands for the biases of what comes after."""
    n, near = len(windows), p["near"]
    units, beside = _space("units", near.dtype, n, HIDDEN), _space("beside", near.dtype, n, HIDDEN)
    places = np.ascontiguousarray(windows.T)
    np.take(near[: len(p["group"])] + p["hidden"], places[0], 0, units, "clip")
    for own in places[1:]:
        units += np.take(near, own, 0, beside, "clip")
    h = np.empty((n, HIDDEN + 1), near.dtype)
    np.tanh(units, out=h[:, :HIDDEN])
    h[:, HIDDEN] = 1
    return h


def _bounded(weights: np.ndarray) -> bool:
    """Whether no value can be too great for its exponential: hidden units lie between -1 and 1."""
    return bool(np.abs(weights).sum(0).max() < 60)


def _values(h: np.ndarray, weights: np.ndarray, bounded: bool) -> np.ndarray:
    """The classes' values, less the row's greatest unless they are bounded."""
    z = np.matmul(h, weights, out=_space("values", h.dtype, len(h), CLASSES))
    if not bounded:
        z -= z.max(1, keepdims=True)
    return z


def _weights(p: dict[str, np.ndarray]) -> np.ndarray:
    return np.vstack([p["out"], p["bias"]])


def _by_group(group: np.ndarray) -> np.ndarray:
    """The order that :func:`_within` wants."""
    return np.argsort(group.astype(np.uint8), kind="stable")


@dataclass(frozen=True)
class _Within:
    """Targets in classes of endings with known words, in the order of the classes.

    ``parts`` has for each class its rows of ``inner``, the places of its targets, and where their values begin and end
    in ``values``, which has a row of the class's width for each target. ``values`` are less the row's greatest unless
    they are bounded, ``total`` has the sums of their exponentials, ``widths`` the rows' widths, ``chosen`` the places of
    the words themselves.
    """

    parts: list[tuple[slice, slice, int, int]]
    values: np.ndarray
    exponentials: np.ndarray
    total: np.ndarray
    widths: np.ndarray
    chosen: np.ndarray


def _within(p: dict[str, np.ndarray], h: np.ndarray, target: np.ndarray, group: np.ndarray) -> _Within | None:
    """Of targets in the order of their groups; None where there is no such class.

    All values lie in one array, so only products are taken class by class.
    """
    first = p["first"].astype(np.int64)
    bounds = np.searchsorted(group, np.arange(OWN + 1, CLASSES + 1))
    counts, widths = np.diff(bounds), np.diff(first) + 1
    counts[widths == 1] = 0
    classes = np.flatnonzero(counts)
    if not len(classes):
        return None
    ends = np.cumsum(counts * widths)
    values, weights = _space("within", h.dtype, int(ends[-1])), np.column_stack([p["inner"], p["inner_bias"]]).T
    parts = []
    columns = [classes, *(of_class[classes] for of_class in (bounds, counts, widths, ends, first))]
    for k, begin, count, width, end, row in np.stack(columns, 1).tolist():
        rows, at, start = slice(row + k, row + k + width), slice(begin, begin + count), end - count * width
        np.matmul(h[at], weights[:, rows], out=values[start:end].reshape(count, width))
        parts.append((rows, at, start, end))
    each = np.repeat(widths, counts)
    heads = np.cumsum(each) - each
    if not _bounded(weights):
        values -= np.repeat(np.maximum.reduceat(values, heads), each)
    e = np.exp(values, out=_space("within exponentials", h.dtype, len(values)))
    # A known word is as many places behind the column of unknown words as it is in its class, a class's own id none.
    places = np.concatenate([target[at] for _, at, _, _ in parts]).astype(np.int64)
    word = np.maximum(places - CLASSES - np.repeat(first[:-1], counts) + 1, 0)
    return _Within(parts, values, e, np.add.reduceat(e, heads), each, heads + word)


def _inner(p: dict[str, np.ndarray], h: np.ndarray, target: np.ndarray, group: np.ndarray) -> Iterator[tuple]:
    """For each class of endings with known words: its rows of ``inner``, the places of its targets with their hidden
    units, and the log probabilities of their words within the class, the first column being all unknown words.

    Targets are in the order of their groups.
    """
    found = _within(p, h, target, group)
    if found is None:
        return
    found.values[:] -= np.repeat(np.log(found.total), found.widths)
    done = 0
    for rows, at, start, end in found.parts:
        count = at.stop - at.start
        within = found.values[start:end].reshape(count, -1)
        word = found.chosen[done : done + count] - start - np.arange(count) * within.shape[1]
        yield rows, at, h[at, :HIDDEN], word, within
        done += count


def _sums_by_row(windows: np.ndarray, dh: np.ndarray, rows: int) -> np.ndarray:
    """Sums of ``dh`` by row of ``near``: its rows in the order of the windows' ids, added up run by run."""
    flat = windows.ravel().astype(np.uint16) if rows <= 1 << 16 else windows.ravel()
    order = np.argsort(flat, kind="stable")
    ordered = flat[order]
    heads = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    repeated = _space("repeated", dh.dtype, len(flat), dh.shape[1])
    np.take(dh, order // windows.shape[1], 0, repeated, "clip")
    out = np.zeros((rows, dh.shape[1]), dh.dtype)
    # Complex numbers add two columns at a time; HIDDEN is even.
    pairs = np.result_type(dh.dtype, np.complex64)
    out[ordered[heads]] = np.add.reduceat(repeated.view(pairs), heads).view(dh.dtype)
    return out


def gradients(p: dict[str, np.ndarray], windows: np.ndarray, target: np.ndarray) -> dict[str, np.ndarray]:
    """Of the mean negative log probability of the targets."""
    n = len(target)
    order = _by_group(p["group"][target])
    windows, target = windows.take(order, 0), target[order]
    group = p["group"][target].astype(np.int64)
    h = _hidden(p, windows)
    dh = _space("dh", h.dtype, n, HIDDEN)
    weights = _weights(p)
    bounded, ones, back = _bounded(weights), np.ones(CLASSES, h.dtype), np.ascontiguousarray(p["out"].T)
    d_weights = np.zeros_like(weights)
    for at in range(0, n, BLOCK_WINDOWS):  # what is as wide as the classes stays in the processor's memory
        block = slice(at, at + BLOCK_WINDOWS)
        e = _values(h[block], weights, bounded)
        np.exp(e, out=e)
        total = e @ ones
        e[np.arange(len(e)), group[block]] -= total
        # Each row stands for its own share of 1 / n.
        share = (1 / (n * total))[:, None]
        np.matmul(e, back, out=dh[block])
        dh[block] *= share
        d_weights += (h[block] * share).T @ e
    inner = np.zeros((len(p["inner"]), HIDDEN + 1), h.dtype)
    found = _within(p, h, target, group)
    if found is not None:
        d = found.exponentials
        d[found.chosen] -= found.total
        d *= np.repeat(1 / (n * found.total), found.widths)
        for rows, at, start, end in found.parts:
            own = d[start:end].reshape(at.stop - at.start, -1)
            dh[at] += own @ p["inner"][rows]
            np.matmul(own.T, h[at], out=inner[rows])
    slope = _space("units", h.dtype, n, HIDDEN)
    np.square(h[:, :HIDDEN], out=slope)
    np.subtract(1, slope, out=slope)
    dh *= slope
    near = _sums_by_row(windows, dh, len(p["near"]))
    return {
        "near": near, "hidden": dh.sum(0), "out": d_weights[:HIDDEN], "bias": d_weights[HIDDEN],
        "inner": inner[:, :HIDDEN], "inner_bias": inner[:, HIDDEN],
    }


def _turn(owner: np.ndarray, rounds: int) -> np.ndarray:
    """The round that predicts each token: its place in its own document, modulo ``rounds``."""
    number = np.arange(len(owner))
    begins = np.ones(len(owner), bool)
    begins[1:] = owner[1:] != owner[:-1]
    return (number - np.maximum.accumulate(np.where(begins, number, 0))) % rounds


class Trainer:
    """A copy of the network that learns from one task's documents."""

    def __init__(self, p: dict[str, np.ndarray]) -> None:
        self.p = {k: v.copy() for k, v in p.items()}
        self.seen = 0
        self.memory = {k: np.full_like(p[k], 1e-4) for k in NAMES}

    def learn(self, documents: list[bytes], number: int, rounds: int) -> None:
        """Predicts the tokens that round ``number`` of ``rounds`` takes from each document."""
        ids = len(self.p["group"])
        row, places, owner = _joined(documents, ids)
        places = places[_turn(owner, rounds) == number]
        for at in range(0, len(places), STEP_WINDOWS):
            own = places[at : at + STEP_WINDOWS]
            for name, gradient in gradients(self.p, _windows(row, own, ids), row[own]).items():
                step = np.square(gradient, out=_space("step", gradient.dtype, *gradient.shape))
                self.memory[name] += step
                np.sqrt(self.memory[name], out=step)
                self.p[name] -= np.divide(RATE * gradient, step, out=step)
            self.seen += len(own)


def train(encoded: DataFrame, first: np.ndarray, rounds: int = ROUNDS) -> dict[str, np.ndarray]:
    """``rounds`` rounds over all documents, in which every token is predicted once. The copies are summed by Spark, so the driver gets one network a round."""
    p = initial(first=first)
    context = encoded.sparkSession.sparkContext
    for number in range(rounds):
        shared = context.broadcast(p)

        def run(batches: Iterator[pa.RecordBatch], number: int = number, shared=shared) -> Iterator[pa.RecordBatch]:
            trainer = Trainer(shared.value)
            for part in slices(batches, 64):
                trainer.learn(part.column("ids").to_pylist(), number, rounds)
            if trainer.seen:
                # The last value is the weight itself.
                values = np.append(_flat(trainer.p).astype(np.float64), 1.0) * trainer.seen
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values), dtype=np.int32)), pa.array(values)], WEIGHTS.names)

        copies = map_arrow(encoded.select("ids"), run, WEIGHTS)
        rows = copies.groupBy("place").agg(F.sum("value").alias("value")).collect()
        if not rows:
            break
        total = np.zeros(len(rows))
        for r in rows:
            total[r.place] = r.value
        p = _shaped(total[:-1] / total[-1], p)
    return p


def document_scores(p: dict[str, np.ndarray], documents: list[bytes]) -> np.ndarray:
    """Per document the summed log probability of its tokens' classes and known words, each seen from both sides."""
    ids = len(p["group"])
    row, places, owner = _joined(documents, ids)
    out, weights = np.zeros(len(documents)), _weights(p)
    bounded, ones = _bounded(weights), np.ones(CLASSES, weights.dtype)
    for at in range(0, len(places), SCORE_TOKENS):
        own = places[at : at + SCORE_TOKENS]
        order = _by_group(p["group"][row[own]])
        own = own[order]
        target = row[own]
        group = p["group"][target].astype(np.int64)
        h = _hidden(p, _windows(row, own, ids))
        found = np.empty(len(own))
        for k in range(0, len(own), BLOCK_WINDOWS):
            block = slice(k, k + BLOCK_WINDOWS)
            z = _values(h[block], weights, bounded)
            value = z[np.arange(len(z)), group[block]]
            found[block] = value - np.log(np.exp(z, out=z) @ ones)
        for _, of, _, word, within in _inner(p, h, target, group):
            found[of] += within[np.arange(len(word)), word]
        out += np.bincount(owner[at : at + SCORE_TOKENS][order], found, len(documents))
    return out


def score(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, log_likelihood and its mean per token, by a model of the same texts.

    Null and empty texts have no tokens and score 0, in sum and mean. Repeated
    rows and null ids give a row each; without a single token nothing is learned.
    """
    texts = documents_of(df, id_col, text_col)
    counted = cut_lineage(count_words(texts), "word-counts")
    vocabulary = vocabulary_of_counts(counted)
    encoded = cut_lineage(encode(texts, vocabulary), "token-ids")
    shared = df.sparkSession.sparkContext.broadcast(train(encoded, vocabulary.first))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 64):
            documents = part.column("ids").to_pylist()
            total = document_scores(shared.value, documents) + np.array(part.column("within").to_pylist())
            size = np.dtype(_code(len(shared.value["group"]))).itemsize
            columns = [part.column("row"), part.column("doc_id"), pa.array([len(d) // size for d in documents]), pa.array(total)]
            yield pa.RecordBatch.from_arrays(columns, SCORED.names)

    scored = map_arrow(encoded.drop("rare"), run, SCORED)
    likelihood = F.col("known") + F.coalesce("rare", F.lit(0.0))
    return scored.join(rare_sums(encoded, counted, vocabulary), "row", "left").select(
        "doc_id",
        "n_tokens",
        likelihood.alias("log_likelihood"),
        (likelihood / F.greatest("n_tokens", F.lit(1))).alias("mean_log_likelihood"),
    )
