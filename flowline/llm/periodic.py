"""Runs of words that repeat periodically, found in a grammar of the words.

The words of a batch of texts are compressed by Re-Pair. A run lies whole in the
derivation of some nonterminal, across the cut between its two parts, or across
a cut of the tree over what the compression leaves. So each nonterminal is
searched once, at its first derivation, for periods that go on across its cut;
what is found holds at every place where it is derived. Intervals of one period
that share a period's length are pieces of one run and are merged.

Stretches are compared by hashes. Equal stretches have equal hashes, so no run
can be missed; every run found is compared word by word, and if one does not
hold the batch is searched again with other hashes.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from flowline.llm.repair import Grammar, Nodes
from flowline.llm.tables import documents_of, map_arrow, slices

#: A run has at least this many words, and this many times its smallest period.
LEAST_WORDS, LEAST_TIMES = 6, 4
#: Words searched together; a longer text is searched alone.
BATCH_WORDS = 100_000
#: Pairs of a cut and a period looked at together.
BLOCK = 1 << 20

# Words end at ASCII white space only.
WORD = re.compile("[^ \t-\r]+")

_PRIME = np.uint64((1 << 31) - 1)

RUN = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])
FOUND = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_words", T.LongType()),
        T.StructField("runs", T.ArrayType(RUN)),
        T.StructField("collapsed", T.StringType()),
    ]
)

Rewrite = Callable[[int | None, list[str]], list[str]]


def _spans(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each count n, n rows: the count's place, and 1 to n."""
    owner = np.repeat(np.arange(len(counts)), counts)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts) + 1


def _blocks(counts: np.ndarray) -> Iterator[slice]:
    """Slices of the counts that add up to about BLOCK each."""
    ends = np.cumsum(counts)
    at = 0
    while at < len(counts):
        before = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + BLOCK, "right")))
        yield slice(at, stop)
        at = stop


class _Hashes:
    """Polynomial hashes of stretches of ``words``, modulo a prime."""

    def __init__(self, words: np.ndarray, seed: int) -> None:
        draw = np.random.default_rng(seed)
        base = int(draw.integers(1 << 20, int(_PRIME)))
        power = np.ones(1, np.uint64)
        while len(power) <= len(words):
            step = np.uint64(pow(base, len(power), int(_PRIME)))
            power = np.concatenate([power, power * step % _PRIME])
        self.power = power[: len(words) + 1]
        _, number = np.unique(words, return_inverse=True)
        values = draw.integers(1, int(_PRIME), len(words) + 1).astype(np.uint64)[number]
        self.sums = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(values * self.power[:-1] % _PRIME, out=self.sums[1:])

    def equal(self, at: np.ndarray, shift: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether [at, at + size) and the same stretch ``shift`` further on hash alike."""
        here = (self.sums[at + size] - self.sums[at]) % _PRIME
        there = (self.sums[at + shift + size] - self.sums[at + shift]) % _PRIME
        return here * self.power[shift] % _PRIME == there


def _runs_across(words: np.ndarray, hashes: _Hashes, nodes: Nodes) -> tuple[np.ndarray, ...]:
    """What repeats across the cuts of ``nodes``: (node, start, end, period), periods being the smallest ones.

    A run of four periods or more has two of them on one side of the cut, so a
    period on that side equals the one after it, and the words on both sides of
    the cut recur a period further on (or back). That is asked of every period
    that fits; the few that pass are lengthened in both directions.
    """
    found: list[tuple[np.ndarray, ...]] = []
    whole = nodes.end - nodes.start
    for right in (True, False):
        room = (nodes.end - nodes.cut if right else nodes.cut - nodes.start) // 2
        limit = np.where(whole >= LEAST_WORDS, np.minimum(room, whole // LEAST_TIMES), 0)
        some = np.flatnonzero(limit > 0)
        for block in _blocks(limit[some]):
            which = some[block]
            owner, period = _spans(limit[which])
            cut = nodes.cut[which][owner]
            step = period if right else -period
            passed = words[cut] == words[cut + step]
            owner, period, cut, step = owner[passed], period[passed], cut[passed], step[passed]
            passed = words[cut - 1] == words[cut - 1 + step]
            owner, period, cut = owner[passed], period[passed], cut[passed]
            passed = hashes.equal(cut if right else cut - 2 * period, period, period)
            owner, period, cut = which[owner[passed]], period[passed], cut[passed]
            if not len(owner):
                continue
            start, end = nodes.start[owner], nodes.end[owner]
            # [low, high): places whose word recurs a period further on.
            low, high = (cut, cut + period) if right else (cut - 2 * period, cut - period)
            low = low - _longest(hashes, low, period, low - start, -1)
            high = high + _longest(hashes, high, period, end - period - high, 1)
            end = high + period
            passed = end - low >= np.maximum(LEAST_WORDS, LEAST_TIMES * period)
            # A half that reaches its periods by itself need not reach across the cut.
            passed &= (low < cut) & (end > cut)
            found.append((owner[passed], low[passed], end[passed], period[passed]))
    if not found:
        return (np.zeros(0, np.int64),) * 4
    owner, start, end, period = (np.concatenate(parts) for parts in zip(*found))
    # A multiple of a period finds the same interval: the smallest period stays.
    order = np.lexsort((period, end, start, owner))
    owner, start, end, period = owner[order], start[order], end[order], period[order]
    first = np.ones(len(owner), bool)
    first[1:] = (np.diff(owner) != 0) | (np.diff(start) != 0) | (np.diff(end) != 0)
    return owner[first], start[first], end[first], period[first]


def _longest(hashes: _Hashes, at: np.ndarray, period: np.ndarray, room: np.ndarray, way: int) -> np.ndarray:
    """How far from ``at`` on (forwards, or backwards) words recur a period further on, at most ``room``."""
    low, high = np.zeros_like(room), room.copy()
    while (low < high).any():
        middle = (low + high + 1) // 2
        same = hashes.equal(at if way > 0 else at - middle, period, middle)
        low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
    return low


def _merge(start: np.ndarray, end: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, ...]:
    """Maximal intervals, by period and start: pieces of one run share a period's length, different runs do not."""
    order = np.lexsort((-end, start, period))
    start, end, period = start[order], end[order], period[order]
    if not len(start):
        return start, end, period
    # The farthest end so far among those of the same period, by raising each period's ends above those before it.
    lift = (np.cumsum(np.concatenate([[0], np.diff(period) != 0]))) * (int(end.max()) + 1)
    farthest = np.maximum.accumulate(end + lift) - lift
    new = np.ones(len(start), bool)
    new[1:] = (np.diff(period) != 0) | (start[1:] + period[1:] > farthest[:-1])
    heads = np.flatnonzero(new)
    return start[heads], np.maximum.reduceat(end, heads), period[heads]


def _hold(words: np.ndarray, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> bool:
    """Whether every run repeats word by word and no neighbouring word goes on with it."""
    for block in _blocks(end - start - period):
        owner, nth = _spans((end - start - period)[block])
        at = start[block][owner] + nth - 1
        if not (words[at] == words[at + period[block][owner]]).all():
            return False
    before, after = start > 0, end < len(words)
    return not (
        (words[start[before] - 1] == words[start[before] - 1 + period[before]]).any()
        or (words[end[after]] == words[end[after] - period[after]]).any()
    )


def runs_of(words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """start, end and smallest period of every run, by start and then period.

    ``words`` are numbers of 0 or more; texts are parted by negative numbers, each of which stands there once.
    """
    grammar = Grammar(words)
    for seed in range(64):
        hashes = _Hashes(words, seed)
        pieces: list[tuple[np.ndarray, ...]] = []
        own: list[tuple[np.ndarray, ...]] = []
        before = 0
        for nodes in grammar.rounds:
            owner, start, end, period = _runs_across(words, hashes, nodes)
            own.append((owner + before, start - nodes.start[owner], end - nodes.start[owner], period))
            before += len(nodes.start)
        owner, start, end, period = (
            (np.concatenate(parts) for parts in zip(*own)) if own else (np.zeros(0, np.int64),) * 4
        )
        if len(owner):
            marked = np.zeros(before, bool)
            marked[owner] = True
            symbol, place = grammar.derivations(marked)
            counts = np.bincount(owner, minlength=before)
            offset = np.cumsum(counts) - counts
            derivation, nth = _spans(counts[symbol])
            at = offset[symbol[derivation]] + nth - 1
            pieces.append((start[at] + place[derivation], end[at] + place[derivation], period[at]))
        for nodes in grammar.levels():
            pieces.append(_runs_across(words, hashes, nodes)[1:])
        start, end, period = (
            (np.concatenate(parts) for parts in zip(*pieces)) if pieces else (np.zeros(0, np.int64),) * 3
        )
        start, end, period = _merge(start, end, period)
        if _hold(words, start, end, period):
            order = np.lexsort((period, start))
            return start[order], end[order], period[order]
    raise ArithmeticError("the words' hashes collide for every choice tried")


def _search(texts: list[list[str]]) -> tuple[list[list[dict]], list[str]]:
    """Runs and collapsed text of each list of words."""
    numbers: dict[str, int] = {}
    sizes = np.array(list(map(len, texts)), np.int64)
    flat = np.full(int(sizes.sum()) + len(texts), -1, np.int64)
    starts = np.cumsum(sizes + 1) - sizes - 1
    for own, at in zip(texts, starts.tolist()):
        for word in set(own).difference(numbers):
            numbers[word] = len(numbers)
        flat[at : at + len(own)] = list(map(numbers.__getitem__, own))
    breaks = starts + sizes
    flat[breaks] = -1 - np.arange(len(texts))
    start, end, period = runs_of(flat)
    change = np.zeros(len(flat) + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, end, -1)
    dropped = np.cumsum(change[:-1]) > 0
    text = np.searchsorted(starts, start, "right") - 1
    runs: list[list[dict]] = [[] for _ in texts]
    for which, a, b, p in zip(text.tolist(), (start - starts[text]).tolist(), (end - start).tolist(), period.tolist()):
        runs[which].append({"start": a, "length": b, "period": p})
    collapsed = [
        " ".join(np.array(own, object)[~dropped[at : at + len(own)]]) if runs[which] else " ".join(own)
        for which, (own, at) in enumerate(zip(texts, starts.tolist()))
    ]
    return runs, collapsed


def find_runs(
    df: DataFrame, rewrite: Rewrite | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_words, runs and collapsed of each row.

    Words are what stands between ASCII white space. A run is a stretch of words
    with smallest period q, of at least 6 words and 4 * q words, that no
    neighbouring word goes on with; runs lists start, length and period by start
    and period. collapsed joins by a space the words that no run contains after
    its first q words. ``rewrite`` may give other words for a row's id and words
    before they are searched. Null and empty texts, and those of white space,
    have no words and no runs; a row is read by itself, so repeated rows and
    null ids give a row each, and an empty table none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            ids = part.column("doc_id").to_pylist()
            texts = [WORD.findall(text) for text in part.column("text").to_pylist()]
            if rewrite is not None:
                texts = [rewrite(number, words) for number, words in zip(ids, texts)]
            at = 0
            while at < len(texts):
                stop, total = at + 1, len(texts[at])
                while stop < len(texts) and total + len(texts[stop]) <= BATCH_WORDS:
                    total += len(texts[stop])
                    stop += 1
                runs, collapsed = _search(texts[at:stop])
                columns = [
                    part.column("doc_id").slice(at, stop - at),
                    pa.array(list(map(len, texts[at:stop])), pa.int64()),
                    pa.array(runs, pa.list_(pa.struct([(c, pa.int64()) for c in RUN.names]))),
                    pa.array(collapsed, pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(columns, FOUND.names)
                at = stop

    return map_arrow(documents_of(df, id_col, text_col), run, FOUND)


def planted_period(number: int | None, words: list[str]) -> list[str]:
    """A rewrite that makes about a tenth of the texts, chosen by a hash of their id, periodic from some word on.

    With h the crc32 of the decimal id: if h is a multiple of 10, the words from
    place a on repeat the p words that start there, where g = h // 10,
    a = g % n and p = 1 + (n - a) // (3 + g % 8). Rows without an id or words
    stay as they are.
    """
    n = len(words)
    h = zlib.crc32(str(number).encode())
    if number is None or not n or h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    period = words[a : a + p]
    return words[:a] + (period * ((n - a) // p + 1))[: n - a]
