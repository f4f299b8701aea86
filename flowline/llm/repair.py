"""Grammar compression of whole numbers: pairs that repeat become nonterminals, round by round.

As in Re-Pair the most frequent pairs are replaced first. A round replaces all
pairs at least half as frequent as the most frequent one at once, so there are
few rounds, and a passage that repeats becomes a tree of little depth, not a
chain. What is left, in which hardly a pair repeats, is joined pair by pair into
one tree per text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Nodes:
    """Derivations in two: the texts' places [start, cut) and [cut, end)."""

    start: np.ndarray
    cut: np.ndarray
    end: np.ndarray


class Grammar:
    """The grammar of some numbers, in which breaks (negative numbers, each once) part the texts.

    ``words`` are 0 or more, or breaks. ``rounds`` holds the nonterminals of each
    round, at the place where each derives its numbers first.
    """

    def __init__(self, words: np.ndarray) -> None:
        self.terminals = int(words.max(initial=-1)) + 1
        self.symbols = np.where(words < 0, -1, words).astype(np.int64)
        self.places = np.arange(len(words), dtype=np.int64)
        self.sizes = np.ones(self.terminals, np.int64)
        self.left: list[np.ndarray] = []
        self.right: list[np.ndarray] = []
        self.rounds: list[Nodes] = []
        self._replace_pairs()

    def _replace_pairs(self) -> None:
        least = None
        while True:
            symbols, total = self.symbols, len(self.sizes)
            keys = symbols[:-1] * total + symbols[1:]
            at = np.flatnonzero((symbols[:-1] >= 0) & (symbols[1:] >= 0))
            if not len(at):
                return
            order = np.argsort(keys[at])
            ordered = keys[at][order]
            heads = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
            counts = np.diff(np.append(heads, len(ordered)))
            most = int(counts.max())
            if most < 2:
                return
            least = max(2, most // 2) if least is None else max(2, min(least, most // 2))
            often = np.repeat(counts >= least, counts)
            chosen = np.sort(at[order[often]])
            # Places in a row overlap: every second one, from the left.
            fresh = np.ones(len(chosen), bool)
            fresh[1:] = np.diff(chosen) > 1
            number = np.arange(len(chosen))
            chosen = chosen[(number - np.maximum.accumulate(np.where(fresh, number, 0))) % 2 == 0]
            pairs, first, which, times = np.unique(
                keys[chosen], return_index=True, return_inverse=True, return_counts=True
            )
            again = times > 1
            if not again.any():
                if least == 2:
                    return
                least //= 2
                continue
            new = np.cumsum(again) - 1 + total
            keep = again[which]
            self._define(pairs[again] // total, pairs[again] % total, self.places[chosen[first[again]]])
            chosen, made = chosen[keep], new[which[keep]]
            self.symbols = symbols.copy()
            self.symbols[chosen] = made
            stay = np.ones(len(symbols), bool)
            stay[chosen + 1] = False
            self.symbols, self.places = self.symbols[stay], self.places[stay]

    def _define(self, left: np.ndarray, right: np.ndarray, start: np.ndarray) -> None:
        self.left.append(left)
        self.right.append(right)
        cut = start + self.sizes[left]
        self.rounds.append(Nodes(start, cut, cut + self.sizes[right]))
        self.sizes = np.concatenate([self.sizes, self.sizes[left] + self.sizes[right]])

    def levels(self):
        """The trees over what is left, from the bottom up: the Nodes of each level."""
        real = self.symbols >= 0
        text = np.cumsum(~real)[real]
        start = self.places[real]
        end = start + self.sizes[self.symbols[real]]
        while True:
            number = np.arange(len(text))
            head = np.ones(len(text), bool)
            head[1:] = text[1:] != text[:-1]
            nth = number - np.maximum.accumulate(np.where(head, number, 0))
            firsts = np.flatnonzero((nth[:-1] % 2 == 0) & (nth[1:] % 2 == 1)) if len(text) else number
            if not len(firsts):
                return
            yield Nodes(start[firsts], start[firsts + 1], end[firsts + 1])
            end = end.copy()
            end[firsts] = end[firsts + 1]
            stay = nth % 2 == 0
            text, start, end = text[stay], start[stay], end[stay]

    def derivations(self, marked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Every place where a marked nonterminal derives its numbers: (nonterminal, place).

        ``marked`` has an entry per nonterminal, in the order of the rounds.
        """
        left = np.concatenate([np.zeros(0, np.int64), *self.left])
        right = np.concatenate([np.zeros(0, np.int64), *self.right])
        # A nonterminal has something to show if it or a part of it is marked; parts come from earlier rounds.
        shows = np.concatenate([np.zeros(self.terminals, bool), marked])
        at = self.terminals
        for own_left, own_right in zip(self.left, self.right):
            shows[at : at + len(own_left)] |= shows[own_left] | shows[own_right]
            at += len(own_left)
        here = np.flatnonzero(self.symbols >= self.terminals)
        symbols, places = self.symbols[here], self.places[here]
        found: list[tuple[np.ndarray, np.ndarray]] = []
        while True:
            wanted = shows[symbols]
            symbols, places = symbols[wanted] - self.terminals, places[wanted]
            if not len(symbols):
                break
            own = marked[symbols]
            found.append((symbols[own], places[own]))
            first, second = left[symbols], right[symbols]
            symbols, places = (
                np.concatenate([first, second]),
                np.concatenate([places, places + self.sizes[first]]),
            )
            real = symbols >= self.terminals
            symbols, places = symbols[real], places[real]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
