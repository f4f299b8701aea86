"""Toxicity by a learned lexicon, found also where it is misspelled.

Training documents give the terms that mark abuse: whole words, and stems that
begin many words. The terms form a trie. A word of a text is matched by running
its Levenshtein automaton along the trie, in which one edit is allowed for
longer terms. Each hit is seen in a window around it: one between quotation
marks, or next to words that usually stand around harmless mentions, counts
separately. A logistic regression on the training documents weighs exact,
misspelled and mentioned hits; where no training document shows what mentions
are worth, they are worth nothing.
"""

from __future__ import annotations

import bisect
import functools
import itertools
import json
import math
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowline.llm.logistic import fit_logistic, sigmoid
from flowline.llm.tables import bounded_sample, documents_of, keep_rows, map_arrow, pick, slices
from flowline.llm.units import Memory
from flowline.session import cut_lineage

#: Labelled rows used for training at most, of either label.
TRAIN_TOXIC = 4_000
TRAIN_CLEAN = 8_000
#: Score from which a document counts as toxic.
THRESHOLD = 0.7
#: Lengths of the stems that are tried as terms.
STEMS = (4, 5, 6, 7)
#: A term stands in at least so many toxic training documents, whatever their number.
LEAST_DOCS = 4
#: Log odds from which a term marks abuse.
LEAST_ODDS = 2.5
#: Of all terms tried about so many may come to mark abuse by chance.
BY_CHANCE = 0.1
#: Terms of a lexicon and words around its hits, of which the ones with most evidence are kept.
MOST_TERMS = 20_000
#: Letters from which a word, or a stem, may be misspelled.
FUZZY_WORD = 5
FUZZY_STEM = 6
#: Words on either side of a hit that are its context.
WINDOW = 4

# Whole words carry this mark at their end.
END = "$"
WORD = re.compile(r"[^\W\d_]+")
_QUOTES = re.compile("[\"“”„«»]")

SAMPLE = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())]
    + [T.StructField("toxic", T.IntegerType()), T.StructField("signature", T.LongType())]
)
TERM_COUNTS = T.StructType([T.StructField("term", T.StringType()), T.StructField("n", T.LongType())])
FEATURES = T.StructType([T.StructField("x", T.ArrayType(T.DoubleType())), T.StructField("toxic", T.IntegerType())])
CONTEXTS = T.StructType(
    [T.StructField("term", T.StringType()), T.StructField("toxic", T.IntegerType()), T.StructField("n", T.LongType())]
)
SCORED = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("score", T.DoubleType())])


class Trie:
    """Terms by letters; ``find`` runs a word's Levenshtein automaton along it."""

    def __init__(self, terms: Iterable[str]) -> None:
        self.root: dict = {}
        self.heads: set[str] = set()
        self.middles: set[str] = set()
        for term in terms:
            node, letters = self.root, term.removesuffix(END)
            for letter in letters:
                node = node.setdefault(letter, {})
            node[END if term.endswith(END) else "stem"] = letters
            self.heads.add(letters[:2])
            if len(letters) >= FUZZY_WORD:
                self.middles.add(letters[2:5])

    def _hopeless(self, word: str) -> bool:
        """One edit leaves the first two letters, or the three behind them moved by one at most."""
        return (
            word[:2] not in self.heads
            and word[2:5] not in self.middles
            and word[1:4] not in self.middles
            and word[3:6] not in self.middles
        )

    def find(self, word: str) -> tuple[str, int] | None:
        """The term in ``word`` and the edits it takes, an exact one first, then the longest."""
        if self._hopeless(word):
            return None
        masks: dict[str, int] = defaultdict(int)
        for at, letter in enumerate(word):
            masks[letter] |= 2 << at
        everything, end = (2 << len(word)) - 1, 1 << len(word)
        best = None
        # A state is a bit per place reached in the word, for no edit and for one.
        stack = [(self.root, 1, 3 & everything)]
        while stack:
            node, exact, near = stack.pop()
            for letter, below in node.items():
                if letter == END:
                    edits = 0 if exact & end else 1 if near & end and len(below) >= FUZZY_WORD else None
                elif letter == "stem":
                    edits = 0 if exact else 1 if near and len(below) >= FUZZY_STEM else None
                else:
                    mask = masks.get(letter, 0)
                    next_exact = (exact << 1) & mask
                    next_near = ((near << 1) & mask) | exact | (exact << 1) | (next_exact << 1) | next_exact
                    next_near &= everything
                    if next_exact or next_near:
                        stack.append((below, next_exact, next_near))
                    continue
                if edits is not None:
                    rank = (-edits, len(below), letter == END)
                    if best is None or rank > best[0]:
                        best = (rank, below + (END if letter == END else ""), edits)
        return best and best[1:]


@dataclass(frozen=True)
class Model:
    """Terms with their log odds, context words with theirs, and the weights of the features."""

    terms: dict[str, float]
    contexts: dict[str, float] = field(default_factory=dict)
    weights: tuple[float, ...] = (0.0, 0.0, 0.0, -4.0)

    def to_json(self) -> str:
        return json.dumps([self.terms, self.contexts, self.weights])


class Scorer:
    """Scores texts with one model, kept per Python worker."""

    def __init__(self, model: Model) -> None:
        self.model, self.trie = model, Trie(model.terms)
        self.memory = Memory(lambda word: self.trie.find(word) or 0)

    def hits(self, text: str, words: list[str]) -> list[tuple[int, str, int]]:
        found = self.memory
        return [(at, *found[w]) for at, w in enumerate(words) if found[w]]

    def _mentioned(self, text: str, lowered: str, words: list[str], hits: list) -> list[bool]:
        """Of each hit, whether its window makes it a mention."""
        starts = [m.start() for m in WORD.finditer(lowered)]
        # Lower case may lengthen a text; quotation marks are looked up in the lowered one.
        marks = [m.start() for m in _QUOTES.finditer(lowered)]
        lines = [m.start() for m in re.finditer("\n", lowered)] if marks else []
        out = []
        for at, _, _ in hits:
            quoted = False
            if marks:
                here = starts[at]
                line = bisect.bisect_left(lines, here)
                begin = lines[line - 1] if line else -1
                after = bisect.bisect_right(lines, here)
                end = lines[after] if after < len(lines) else len(lowered)
                in_front = bisect.bisect_left(marks, here) - bisect.bisect_right(marks, begin)
                behind = bisect.bisect_right(marks, here)
                quoted = in_front % 2 == 1 and behind < len(marks) and marks[behind] < end
            around = itertools.chain(words[max(0, at - WINDOW) : at], words[at + 1 : at + 1 + WINDOW])
            out.append(quoted or sum(self.model.contexts.get(w, 0.0) for w in around) < 0)
        return out

    def features(self, texts: list[str]) -> np.ndarray:
        """Per text, strength of its exact, misspelled and mentioned hits."""
        lowered = [t.lower() for t in texts]
        words = [WORD.findall(t) for t in lowered]
        self.memory.tidy()
        x = np.zeros((len(texts), 3))
        for row, (text, low, own) in enumerate(zip(texts, lowered, words)):
            hits = self.hits(text, own)
            if hits:
                for (_, term, edits), mention in zip(hits, self._mentioned(text, low, own, hits)):
                    x[row, 2 if mention else edits] += self.model.terms[term]
        return np.log1p(x)

    def scores(self, texts: list[str]) -> np.ndarray:
        w = np.array(self.model.weights)
        return sigmoid(self.features(texts) @ w[:-1] + w[-1])


@functools.lru_cache(maxsize=2)
def _scorer_of(model: str) -> Scorer:
    terms, contexts, weights = json.loads(model)
    return Scorer(Model(terms, contexts, tuple(weights)))


def terms_of(words: Iterable[str]) -> set[str]:
    """All that could be a term in these words: the words and their stems."""
    found = set()
    for word in words:
        found.add(word + END)
        found.update(word[:n] for n in STEMS if len(word) > n)
    return found


def odds_of(n: Column, clean: Column, n_toxic: int, n_clean: int) -> Column:
    """Log odds of a term in toxic documents against clean ones."""
    return F.log((n + 0.5) / (n_toxic + 1)) - F.log((clean + 0.5) / (n_clean + 1))


def evidence_of(n: Column, clean: Column, n_toxic: int, n_clean: int) -> Column:
    """How much more likely the counts of a term are, in logarithms, by its own rate on either side than by one for both."""
    share = n_toxic / max(1, n_toxic + n_clean)

    def part(count: Column, expected: Column) -> Column:
        return F.when(count > 0, count * F.log(count / expected)).otherwise(0.0)

    return part(n, (n + clean) * share) + part(clean, (n + clean) * (1 - share))


def lexicon(marking: dict[str, tuple[float, float]]) -> dict[str, float]:
    """The terms that mark abuse, with their log odds, of terms with odds and evidence.

    Of terms that begin one another, the one with most evidence stands for all,
    the longest of those that have the same.
    """
    chosen: dict[str, float] = {}
    taken: set[str] = set()
    for term in sorted(marking, key=lambda t: (-marking[t][1], -len(t), t)):
        letters = term.removesuffix(END)
        heads = {letters[:n] for n in range(1, len(letters) + 1)}
        if heads & chosen.keys() or letters in taken or letters + END in chosen:
            continue
        chosen[term] = marking[term][0]
        taken |= heads
    return chosen


def signature(words: list[str], shingle: int = 5) -> int:
    """The least hash of a text's shingles: alike for copies and mostly for near copies, and for no others."""
    shingles = (" ".join(words[at : at + shingle]) for at in range(max(1, len(words) - shingle + 1)))
    return min(zlib.crc32(s.encode()) for s in shingles)


def _sample(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Labelled training documents, one of each signature: at most TRAIN_TOXIC + TRAIN_CLEAN rows."""
    known = pick(labels, doc_id="doc_id", toxic="toxic").filter("doc_id is not null and toxic is not null")
    known = known.filter(F.crc32(F.col("doc_id").cast("string")) % 3 != 1)
    known = known.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    n = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect() if r.toxic in (0, 1)}
    sides = ((1, TRAIN_TOXIC), (0, TRAIN_CLEAN))
    chosen = reduce(DataFrame.union, [bounded_sample(known.filter(F.col("toxic") == t), most, n.get(t, 0), "doc_id") for t, most in sides])
    # The limits above bound what is broadcast.
    rows = documents.join(F.broadcast(cut_lineage(chosen, "toxic-training-ids")), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            marks = [signature(WORD.findall(t.lower())) for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(marks, pa.int64())], SAMPLE.names)

    marked = map_arrow(rows.select("doc_id", "text", "toxic"), run, SAMPLE)
    return cut_lineage(marked.dropDuplicates(["signature", "toxic"]), "toxic-training")


def _count_terms(sample: DataFrame, toxic: int) -> DataFrame:
    """(term, n): training documents of a label with each term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for part in slices(batches):
            for text in part.column("text").to_pylist():
                counts.update(terms_of(set(WORD.findall(text.lower()))))
        yield pa.RecordBatch.from_arrays([pa.array(list(counts)), pa.array(list(counts.values()), pa.int64())], TERM_COUNTS.names)

    rows = map_arrow(sample.filter(F.col("toxic") == toxic).select("text"), run, TERM_COUNTS)
    return rows.groupBy("term").agg(F.sum("n").alias("n"))


def _context_odds(sample: DataFrame, terms: dict[str, float], labels: dict[int, int]) -> dict[str, float]:
    """Log odds of the words around hits, in toxic documents against clean ones.

    Empty unless clean training documents have hits too.
    """
    model = Model(terms).to_json()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer, counts = _scorer_of(model), Counter()
        for part in slices(batches):
            for text, toxic in zip(part.column("text").to_pylist(), part.column("toxic").to_pylist()):
                words = WORD.findall(text.lower())
                scorer.memory.tidy()
                around = set()
                for at, _, edits in scorer.hits(text, words):
                    if edits == 0:
                        around.update(words[max(0, at - WINDOW) : at], words[at + 1 : at + 1 + WINDOW])
                counts.update((w, toxic) for w in around)
        keys = list(counts)
        columns = [[w for w, _ in keys], [t for _, t in keys], [counts[k] for k in keys]]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _CONTEXT_ARROW)], CONTEXTS.names)

    rows = map_arrow(sample.select("text", "toxic"), run, CONTEXTS).groupBy("term", "toxic").agg(F.sum("n").alias("n"))
    sides = rows.groupBy("term").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("t"),
        F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("c"),
    )
    top = sides.filter("c >= 3").orderBy(F.desc("c"), "term").limit(MOST_TERMS).collect()
    scale = max(1, labels.get(0, 0)) / max(1, labels.get(1, 0))
    return {r.term: math.log((r.t * scale + 0.5) / (r.c + 0.5)) for r in top}


_CONTEXT_ARROW = pa.schema([("term", pa.string()), ("toxic", pa.int32()), ("n", pa.int64())])


def fit(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Learns from at most TRAIN_TOXIC + TRAIN_CLEAN labelled documents outside the held-out third.

    Rows of ``labels`` with a null are left out, of several labels of a document
    the largest counts. Without toxic training documents the lexicon is empty
    and every text scores the same.
    """
    sample = _sample(documents_of(documents, id_col, text_col), labels)
    sizes = {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    # Both counts meet before any term is judged.
    clean = _count_terms(sample, 0).withColumnRenamed("n", "clean")
    counted = _count_terms(sample, 1).filter(F.col("n") >= LEAST_DOCS).join(clean, "term", "left").fillna(0, ["clean"])
    judged = counted.select(
        "term",
        odds_of(F.col("n"), F.col("clean"), n_toxic, n_clean).alias("odds"),
        evidence_of(F.col("n"), F.col("clean"), n_toxic, n_clean).alias("evidence"),
    )
    judged = cut_lineage(judged, "toxic-terms")
    least = math.log(max(1, judged.count()) / BY_CHANCE)
    marking = judged.filter((F.col("odds") >= LEAST_ODDS) & (F.col("evidence") >= least))
    top = marking.orderBy(F.desc("evidence"), F.desc(F.length("term")), "term").limit(MOST_TERMS).collect()
    terms = lexicon({r.term: (r.odds, r.evidence) for r in top})
    if not terms:
        return Model({})
    contexts = _context_odds(sample, terms, sizes)
    model = Model(terms, contexts)
    text = model.to_json()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer_of(text)
        for part in slices(batches):
            x = scorer.features(part.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(list(x), pa.list_(pa.float64())), part.column("toxic")], FEATURES.names)

    rows = map_arrow(sample.select("text", "toxic"), run, FEATURES).collect()  # bounded by the size of the sample
    x, y = np.array([r.x for r in rows]), np.array([r.toxic for r in rows], float)
    weights = fit_logistic(x, y, np.ones(len(y)), l2=0.1)
    return Model(terms, contexts, tuple(weights.tolist()))


def score(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score (0 to 1) per row; null texts count as empty ones, which have no hits."""
    text = model.to_json()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer_of(text)
        for part in slices(batches):
            scores = scorer.scores(part.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(scores)], SCORED.names)

    return map_arrow(documents_of(df, id_col, text_col), run, SCORED)


def without_toxic(df: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``df``, all columns as they are, that score below ``threshold``."""
    text = model.to_json()

    def make_keep():
        scorer = _scorer_of(text)
        return lambda texts: (scorer.scores(texts) < threshold).tolist()

    return keep_rows(df, text_col, make_keep)
