"""Encoding of texts by the tokenizers library with a memory of units seen before.

A unit is a run of white space with the run of other characters behind it, cut
once more between a plain letter or digit and a common punctuation mark. The
pre-tokenizers used here always end a match at both places, so the tokens of a
text are those of its units in a row, and a unit that occurs a million times is
encoded once per Python worker.
"""

from __future__ import annotations

import functools
import itertools
import re
import string
from array import array
from collections.abc import Callable

from flowline.llm.tables import one_thread

# The characters with Unicode's White_Space property.
WHITE_SPACE = "\t-\r \x85\xa0  -     　"

UNIT = re.compile(
    f"[{WHITE_SPACE}]*+(?:[0-9A-Za-zÀ-ÖØ-öø-ÿ]++(?=[.,;:!?$#%&*])|[^{WHITE_SPACE}]++)|[{WHITE_SPACE}]++"
)
# An array type of four bytes per item.
_ID_CODE = next(code for code in "IL" if array(code).itemsize == 4)
_PLAIN = re.compile("( ?)([A-Za-zÀ-ÖØ-öø-ÿ]+)")
_LOWER = string.ascii_lowercase + "".join(chr(c) for c in range(0xDF, 0x100) if c != 0xF7)
_UPPER = string.ascii_uppercase + "".join(chr(c) for c in range(0xC0, 0xDF) if c != 0xD7)


@functools.lru_cache(maxsize=1)
def byte_characters() -> tuple[str, ...]:
    """The character for each byte: itself if it is printable, else one from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = itertools.count(0x100)
    return tuple(chr(b) if b in plain else chr(next(others)) for b in range(256))


def written(text: str) -> str:
    """The UTF-8 bytes of ``text`` in these characters."""
    return "".join(map(byte_characters().__getitem__, text.encode()))


class Memory(dict):
    """key -> ``make(key)``, remembered for the last two rounds of ``limit`` keys.

    The keys of one piece of text are all held until :meth:`tidy` is called
    between pieces.
    """

    def __init__(self, make: Callable, limit: int = 200_000) -> None:
        super().__init__()
        self.make, self.limit, self.before = make, limit, {}

    def __missing__(self, key):
        value = self.before.get(key)
        if value is None:
            value = self.make(key)
        self[key] = value
        return value

    def tidy(self) -> None:
        if len(self) > self.limit:
            self.before = dict(self)
            self.clear()


@functools.lru_cache(maxsize=4)
def tokenizer_of(definition: str):
    """The tokenizer with this JSON text, built once per Python worker."""
    one_thread()
    from tokenizers import Tokenizer

    return Tokenizer.from_str(definition)


def _is_latin(text: str) -> bool:
    """Whether no character lies beyond U+00FF."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def read_definition(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        return file.read()


class UnitEncoder:
    """Ids of texts as unsigned 32-bit integers, as the machine writes them.

    Where the normaliser and the pre-tokenizer leave a word of plain letters
    whole, which is asked of them once for all such letters, the library's model
    gets such words directly.
    """

    def __init__(self, definition: str) -> None:
        self.tokenizer = tokenizer_of(definition)
        self.model = self.tokenizer.model
        self.units = Memory(self.encode_unit)
        spaced = self._piece(" " + _LOWER) or ""
        self.folds = self._piece(_UPPER) == written(_UPPER.lower())
        self.plain = self._piece(_LOWER) == written(_LOWER) and spaced.endswith(written(_LOWER))
        self.plain = self.plain and (self.folds or self._piece(_UPPER) == written(_UPPER))
        self.added = [token.content.lower() for token in self.tokenizer.get_added_tokens_decoder().values()]
        # What stands for a space in front of a word.
        self.space = spaced.removesuffix(written(_LOWER))

    def folded(self, text: str) -> str:
        """The text in small letters where that gives the same ids, else as it is.

        Where the tokenizer folds its letters and each has one small letter, and
        no added token comes about by it.
        """
        if not self.folds or not (text.isascii() or _is_latin(text)):
            return text
        small = text.lower()
        return text if any(token in small for token in self.added) else small

    def _piece(self, text: str) -> str | None:
        if self.tokenizer.normalizer is not None:
            text = self.tokenizer.normalizer.normalize_str(text)
        pieces = self.tokenizer.pre_tokenizer.pre_tokenize_str(text)
        return pieces[0][0] if len(pieces) == 1 else None

    def encode_unit(self, unit: str) -> bytes:
        """The ids of one unit, not remembered."""
        found = _PLAIN.fullmatch(unit) if self.plain else None
        if found:
            word = found[2].lower() if self.folds else found[2]
            word = word if word.isascii() else written(word)
            ids = [token.id for token in self.model.tokenize(self.space + word if found[1] else word)]
        else:
            ids = self.tokenizer.encode(unit, add_special_tokens=False).ids
        return array(_ID_CODE, ids).tobytes()

    def tidy(self) -> None:
        self.units.tidy()

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.units.__getitem__, UNIT.findall(text)))
