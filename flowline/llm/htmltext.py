"""The main text of web pages, by a recurrent labeller of blocks.

A page is read into its leaf blocks: runs of text between the boundaries of
block elements, each with the path of open elements above it. A block becomes a
vector of its hashed path, its hashed words and a few measures, and a
bidirectional LSTM reads the vectors of the whole page, so that every block is
judged by what stands before and behind it.

The labeller learns from a bounded sample of the pages, labelled where their
elements say what they are, and from pages made up from the texts of that sample
in layouts whose blocks are known.
"""

from __future__ import annotations

import functools
import html
import pickle
import random
import re
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowline.llm import lstm
from flowline.llm.tables import bounded_sample, map_arrow, pick, slices
from flowline.llm.units import Memory

#: Pages of the table that are learned from, whole, and their characters in all; and made-up pages.
TRAIN_PAGES = 300
TRAIN_HTML_CHARS = 8_000_000
MADE_PAGES = 900
#: Blocks after which a training page goes on as another sequence.
TRAIN_BLOCKS = 2_000
#: Size of the hashed path and word vectors, of the LSTM's state, and passes over the training pages.
PATH_BUCKETS = 96
WORD_BUCKETS = 24
HIDDEN = 16
ROUNDS = 22
#: Blocks that are labelled at a time, padding included.
BATCH_BLOCKS = 8192
#: Paths remembered per Python worker, and elements inside each other up to which they are.
PATHS = 100_000
PATH_DEPTH = 100

# Elements of HTML that begin a block of their own.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu nav ol optgroup option p pre search "
    "section select summary table tbody td tfoot th thead title tr ul".split()
)
# Elements without content, and those whose content is not text of the page.
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset("script style noscript template textarea iframe svg math object title".split())
# A start tag of the left ends an open element of the right.
ENDS = {
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr", "td", "th"]),
    "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"]), "option": frozenset(["option"]),
}

# A tag whose quoted values hold no '>' is matched whole, any other one up to its name. No part goes past a '>' in vain.
_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"""|<(/?)([a-zA-Z][^\s/>]*+)([^>"']*+(?:"[^">]*+"[^>"']*+|'[^'>]*+'[^>"']*+)*+)>"""
    r"|<(/?)([a-zA-Z][^\s/>]*+)",
    re.DOTALL,
)
_DECLARED = re.compile("<[!?]")
_QUOTE_OR_END = re.compile("[\"'>]")
_NAMES = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.IGNORECASE)
_NAME = re.compile(r"[a-z]+")

PAGE_TEXT = T.StructType(
    [T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType())]
    + [T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("n_blocks", T.LongType())]
)


class Node:
    """An open element, or the page itself, with what its path comes to.

    ``everywhere`` and ``far`` count the hashed words of the path, so that a
    block deep down costs no more than one at the top.
    """

    __slots__ = ("parent", "element", "depth", "inside", "hard", "said", "below", "everywhere", "far", "vector")

    def __init__(self, parent: Node | None, element: tuple[str, ...]) -> None:
        self.parent, self.element, self.below = parent, element, None
        self.depth = parent.depth + 1 if parent else 0
        self.everywhere = self.far = self.vector = None
        self._label()

    def _label(self) -> None:
        """``said``: 1 or 0 where an element of the path says what the block is, the innermost that does; else -1.

        Class words say nothing about an article itself, and a header inside an
        article is its headline. An article in a sidebar or menu is none, nor is
        one in a part of an article that is not main text, like its comments.
        """
        parent = self.parent
        if parent is None:
            self.said, self.inside, self.hard = -1, False, False
            return
        tag, *words = self.element
        self.inside, self.hard, self.said = parent.inside, parent.hard, parent.said
        if tag in MAIN_TAGS:
            if not (parent.hard or (parent.inside and parent.said == 0)):
                self.said = 1
            self.inside = True
            return
        says = _OTHER_WORDS.intersection(words)
        if parent.inside:
            says = says - {"header"}
        if says or (tag in OTHER_TAGS and not (tag == "header" and parent.inside)):
            self.said = 0
            self.hard = self.hard or tag in HARD_TAGS

    def path(self) -> tuple[tuple[str, ...], ...]:
        found, node = [], self
        while node.parent is not None:
            found.append(node.element)
            node = node.parent
        return tuple(reversed(found))

    def _counted(self) -> None:
        """Fills the counts of this node and of those above it that have none yet."""
        chain, node = [], self
        while node is not None and node.everywhere is None:
            chain.append(node)
            node = node.parent
        for node in reversed(chain):
            if node.parent is None:
                node.everywhere = node.far = np.zeros(PATH_BUCKETS, np.uint8)
            else:
                node.everywhere = np.minimum(node.parent.everywhere + _bucket_counts(node.element, ""), 2)
                node.far = np.minimum(node.parent.far + _bucket_counts(node.element, "<True"), 2)

    def path_vector(self) -> np.ndarray:
        """Counts of the path's words, up to two, those of the two innermost elements and of the others once more by themselves."""
        if self.vector is None:
            self._counted()
            total, node = self.everywhere.copy(), self
            for _ in range(2):
                if node.parent is not None:
                    total += _bucket_counts(node.element, "<False")
                    node = node.parent
            self.vector = np.minimum(total + node.far, 2)
        return self.vector


class _Paths:
    """Nodes met again get back what they have come to; very deep ones are not kept."""

    def __init__(self) -> None:
        self.forget()

    def forget(self) -> None:
        self.root, self.size = Node(None, ()), 0

    def begin(self) -> Node:
        if self.size > PATHS:
            self.forget()
        return self.root

    def below(self, node: Node, element: tuple[str, ...]) -> Node:
        if node.depth >= PATH_DEPTH:
            return Node(node, element)
        if node.below is None:
            node.below = {}
        found = node.below.get(element)
        if found is None:
            found = node.below[element] = Node(node, element)
            self.size += 1
        return found

    def of(self, path: Sequence[tuple[str, ...]]) -> Node:
        node = self.root
        for element in path:
            node = self.below(node, element)
        return node


@dataclass
class Block:
    """A leaf: the innermost element around it, its text, and how many characters of it stand in links."""

    node: Node
    text: str
    linked: int

    @property
    def path(self) -> tuple[tuple[str, ...], ...]:
        return self.node.path()


@functools.lru_cache(maxsize=50_000)
def _bucket_counts(element: tuple[str, ...], where: str) -> np.ndarray:
    counts = np.zeros(PATH_BUCKETS, np.uint8)
    for word in element:
        at = zlib.crc32(f"{word}{where}".encode()) % PATH_BUCKETS
        counts[at] = min(2, counts[at] + 1)
    return counts


@functools.lru_cache(maxsize=100_000)
def _element(tag: str, attributes: str) -> tuple[str, ...]:
    """The tag and the words of its class, id and role."""
    words = [w for _, a, b, c in _NAMES.findall(attributes) for w in _NAME.findall((a or b or c).lower())]
    return tag, *words


def _tag_end(page: str, at: int, unclosed: set[int]) -> int:
    """Where the tag whose name ends at ``at`` has its '>', or -1.

    That is the first one outside of quoted values; if a quote is never closed,
    the first one at all. ``unclosed`` keeps the quotes that led to no end, so
    that each is followed once a page and the whole page is read in linear time.
    """
    tried, place = [], at
    while found := _QUOTE_OR_END.search(page, place):
        here = found.start()
        if found[0] == ">":
            return here
        if here in unclosed:
            break
        tried.append(here)
        place = page.find(found[0], here + 1) + 1
        if not place:
            break
    unclosed.update(tried)
    return page.find(">", at)


class _Open:
    """The open elements of a page, with the places of each tag and of the block elements among them."""

    def __init__(self) -> None:
        self.nodes: list[Node] = [_paths.begin()]
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        # Block elements that no start tag looks past.
        self.walls: list[int] = []

    def push(self, tag: str, element: tuple[str, ...]) -> None:
        at = len(self.nodes)
        self.nodes.append(_paths.below(self.nodes[-1], element))
        self.places.setdefault(tag, []).append(at)
        if tag in BLOCK_TAGS:
            self.blocks.append(at)
            if tag not in ("tbody", "thead"):
                self.walls.append(at)

    def cut(self, at: int) -> None:
        """Ends the element at a place and all inside it."""
        for node in self.nodes[at:]:
            self.places[node.element[0]].pop()
        del self.nodes[at:]
        for list_of in (self.blocks, self.walls):
            while list_of and list_of[-1] >= at:
                list_of.pop()

    def last(self, tag: str) -> int:
        own = self.places.get(tag)
        return own[-1] if own else 0

    def end(self, tag: str) -> None:
        at = self.last(tag)
        # An inline end tag ends no block.
        if at and (tag in BLOCK_TAGS or not self.blocks or self.blocks[-1] < at):
            self.cut(at)

    def begin(self, tag: str, element: tuple[str, ...]) -> None:
        ended = ENDS.get(tag, frozenset()) | ({"p"} if tag in BLOCK_TAGS else frozenset())
        at = max(map(self.last, ended), default=0)
        if at and at >= (self.walls[-1] if self.walls else 0):
            self.cut(at)
        self.push(tag, element)


def blocks_of(page: str) -> list[Block]:
    """The leaf blocks of a page in order; forgives missing and wrong end tags. Linear in the page, however deep it is."""
    out: list[Block] = []
    elements = _Open()
    parts: list[str] = []
    linked = at = 0
    unclosed: set[int] = set()

    def finish() -> None:
        nonlocal linked
        if parts:
            text = "".join(parts)
            text = " ".join((html.unescape(text) if "&" in text else text).split())
            if text:
                out.append(Block(elements.nodes[-1], text, min(linked, len(text))))
            parts.clear()
        linked = 0

    def take(text: str) -> None:
        nonlocal linked
        if text:
            parts.append(text)
            if elements.last("a"):
                linked += len(text)

    while True:
        found = _MARKUP.search(page, at)
        if found is None:
            break
        attributes, end = found[3], found.end()
        if found[5]:
            close = _tag_end(page, end, unclosed)
            if close < 0:  # no tag ends any more; an open comment or declaration still takes the rest
                rest = _DECLARED.search(page, found.start())
                take(page[at : rest.start() if rest else len(page)])
                at = len(page)
                break
            attributes, end = page[end:close], close + 1
        take(page[at : found.start()])
        at = end
        tag = found[2] or found[5]
        if tag is None:
            continue
        tag, closing = tag.lower(), bool(found[1] or found[4])
        if tag in BLOCK_TAGS:
            finish()
        elif tag == "br":
            parts.append(" ")
        if closing:
            elements.end(tag)
        elif tag in RAW_TAGS:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>?", re.IGNORECASE).search(page, at)
            at = end.end() if end else len(page)
        elif tag not in VOID_TAGS:
            elements.begin(tag, _element(tag, attributes))
    take(page[at:])
    finish()
    return out


_word_buckets = Memory(lambda word: zlib.crc32(word.encode()) % WORD_BUCKETS)


def vectors(blocks: Sequence[Block]) -> np.ndarray:
    """One row per block: path, words and measures."""
    out = np.zeros((len(blocks), PATH_BUCKETS + WORD_BUCKETS + 7), np.float32)
    for row, (at, block) in zip(out, enumerate(blocks)):
        row[:PATH_BUCKETS] = block.node.path_vector()
        words = block.text.lower().split()
        counts = np.bincount(list(map(_word_buckets.__getitem__, words)), minlength=WORD_BUCKETS)
        row[PATH_BUCKETS : PATH_BUCKETS + WORD_BUCKETS] = counts / max(1.0, float(counts @ counts) ** 0.5)
        n = len(block.text)
        ends = block.text.count(".") + block.text.count(",")
        row[-7:] = (
            np.log1p(n) / 8, block.linked / n, min(1.0, 5 * ends / max(1, len(words))), np.log1p(len(words)) / 6,
            at / len(blocks), min(3.0, block.node.depth / 10), block.text[-1] in ".!?",
        )
    return out


# What elements, and words of class, id and role, say about all below them.
MAIN_TAGS = frozenset(["article", "main"])
OTHER_TAGS = frozenset("nav footer aside form header button select menu dialog head label".split())


# Elements whose articles are no article of the page.
HARD_TAGS = frozenset("aside nav footer menu dialog head".split())


# Layouts of the made-up pages: elements of parts that are not main text, by what they are.
_PARTS = {
    "menu": ["nav", "div.menu", "ul.navbar", "div#navigation", "div.breadcrumbs", "nav.topnav", "div.links", "ul.nav"],
    "header": ["header", "div.header", "div#masthead", "div.banner", "div.topbar", "header.site", "div.logo"],
    "footer": ["footer", "div.footer", "div#footer", "div.copyright", "section.bottom", "div.legal"],
    "sidebar": ["aside", "div.sidebar", "div#sidebar", "div.related", "section.recommended", "div.widget", "aside.rail", "div.trending"],
    "notice": ["div.cookie", "div.notice", "div#consent", "div.gdpr", "div.alert", "p.disclaimer", "div.popup", "div.modal"],
    "advert": ["div.ad", "div.ads", "div.advert", "div.sponsored", "div.promo", "div.advertisement", "aside.promotion"],
    "form": ["form", "div.newsletter", "div.subscribe", "form.search", "div.signup", "div.login"],
    "comments": ["section.comments", "div#comments", "ol.commentlist", "div.comment", "div.replies", "div.discussion", "div#disqus"],
    "share": ["div.share", "ul.social", "div.tags", "div.byline", "div.meta"],
}
_MAIN = ["article", "main", "div.content", "div.post", "section#main", "div.article", "div.entry", "div.story", "div.text", "div", "div#content"]
_OTHER_WORDS = frozenset(w for own in _PARTS.values() for e in own for w in re.split(r"[.#]", e)[1:])


#: Shared by the pages that a Python worker reads.
_paths = _Paths()


def _made_element(element: str) -> tuple[str, ...]:
    return tuple(re.split(r"[.#]", element))


def _nameless(chance: random.Random, tag: str = "div") -> tuple[str, ...]:
    """An element whose class words mean nothing."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    return tag, *("".join(chance.choices(letters, k=chance.randrange(1, 8))) for _ in range(chance.randrange(3)))


def made_page(chance: random.Random, long: Sequence[str], short: Sequence[str]) -> tuple[list[Block], list[int]]:
    """Blocks of a page in a random layout, and which of them are main text."""
    base: tuple[tuple[str, ...], ...] = (("html",), ("body",))
    while chance.random() < 0.35:
        base += (chance.choice([("div", "page"), ("div", "wrapper"), ("div",), ("div", "container"), _nameless(chance)]),)
    blocks: list[Block] = []
    labels: list[int] = []

    def add(path: tuple[tuple[str, ...], ...], text: str, label: int, linked: bool = False) -> None:
        if text:
            blocks.append(Block(_paths.of(path), text, len(text) if linked else 0))
            labels.append(label)

    def part(path: tuple[tuple[str, ...], ...], kind: str) -> None:
        bare = kind in ("menu", "footer") and chance.random() < 0.2
        path += (_nameless(chance) if bare else _made_element(chance.choice(_PARTS[kind])),)
        for _ in range(chance.randrange(1, 7)):
            text = chance.choice(short)
            if bare or (kind in ("menu", "share", "sidebar") and chance.random() < 0.7):
                add((*path, ("ul",), ("li",)), " ".join(text.split()[:3]), 0, True)
            elif kind == "comments" or chance.random() < 0.2:
                add((*path, ("p",)), chance.choice(long) if chance.random() < 0.4 else text, 0)
            else:
                add(path if chance.random() < 0.5 else (*path, chance.choice([("p",), ("div",), ("span",), ("label",)])), text, 0)

    def main(path: tuple[tuple[str, ...], ...], named: bool) -> None:
        # In some articles much, or all, stands in links; elsewhere linked text is no sign of an article.
        links = chance.choice([0.0, 0.0, 0.0, 0.3, 1.0]) if named else 0.0
        if chance.random() < 0.8:
            heading = (("header",),) if named and chance.random() < 0.3 else ()
            add((*path, *heading, chance.choice([("h1",), ("h1",), ("h2",)])), chance.choice(short), 1)
        for _ in range(chance.choice([1, 2, 3, 5, 8, 13, 30])):
            kind, text = chance.random(), chance.choice(long)
            if kind < 0.62:
                around = ("p",) if chance.random() < 0.8 else chance.choice([("div",), _nameless(chance)])
                add((*path, around), text, 1, chance.random() < links)
            elif kind < 0.72:
                add((*path, chance.choice([("h2",), ("h3",), ("blockquote",), ("pre",), ("figure",)])), chance.choice(short), 1)
            elif kind < 0.77:
                add((*path, ("figure",), ("figcaption",)), chance.choice(short), 1)
            elif kind < 0.83:
                for _ in range(chance.randrange(1, 5)):
                    add((*path, ("ul",), ("li",)), chance.choice(short if chance.random() < 0.7 else long), 1, chance.random() < links)
            elif kind < 0.88:
                row = chance.choice([(("table",), ("tr",)), (("table",), ("tbody",), ("tr",))])
                for _ in range(chance.randrange(2, 9)):
                    words = chance.choice(short).split()[: chance.randrange(1, 6)]
                    add((*path, *row, chance.choice([("td",), ("td",), ("th",)])), " ".join(words), 1)
            elif kind < 0.91:
                add((*path, ("p",)), chance.choice(short), 1, chance.random() < links)
            else:
                part(path, chance.choice(["advert", "sidebar", "form", "share", "notice"]))

    for kind in ("notice", "header", "menu", "advert"):
        if chance.random() < 0.5:
            part(base, kind)
    if chance.random() < 0.95:
        drawn = chance.random()
        if drawn < 0.08:
            own, named = base, False
        elif drawn < 0.3:
            own, named = (*base, _nameless(chance)), False
        else:
            element = _made_element(chance.choice(_MAIN))
            named = element != ("div",)
            if element[0] in MAIN_TAGS and chance.random() < 0.4:  # whatever an article is called, it is one
                element += tuple(chance.choices([*sorted(_OTHER_WORDS), *_nameless(chance)], k=chance.randrange(1, 4)))
            own = (*base, element)
        main(own, named)
        if chance.random() < 0.3:
            part(own, "comments")
    for kind in ("advert", "comments", "sidebar", "form", "menu", "footer"):
        if chance.random() < 0.5:
            part(base, kind)
    return blocks, labels


def learn(pages: Sequence[str], seed: int = 5) -> dict[str, np.ndarray]:
    """The labeller's parameters, from some pages and from made-up ones with their texts."""
    chance = random.Random(seed)
    sequences, labels = [], []
    texts: list[str] = []
    for page in pages:
        blocks = blocks_of(page)
        texts += [b.text for b in blocks]
        for at in range(0, len(blocks), TRAIN_BLOCKS):
            part = blocks[at : at + TRAIN_BLOCKS]
            sequences.append(vectors(part))
            labels.append(np.array([b.node.said for b in part]))
    long = [t for t in texts if len(t) > 80] or ["Some words that make a sentence, and then another one with a few more words."]
    short = [t for t in texts if len(t) <= 80] or ["A few words", "Another line here."]
    for _ in range(MADE_PAGES):
        blocks, own = made_page(chance, long, short)
        if blocks:
            sequences.append(vectors(blocks))
            labels.append(np.array(own))
    return lstm.train(sequences, labels, HIDDEN, ROUNDS)


def fit(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> bytes:
    """Learns from TRAIN_PAGES whole pages, chosen by a hash, of TRAIN_HTML_CHARS characters together.

    Pages are taken in the order of their hashes while they fit. Without pages it
    learns from made-up ones alone.
    """
    found = pick(pages, page_id=id_col, html=html_col).filter("html IS NOT NULL")
    sizes = found.select("page_id", F.xxhash64("html").alias("hash"), F.length("html").alias("n"))
    chosen, room = set(), TRAIN_HTML_CHARS
    for r in bounded_sample(sizes, TRAIN_PAGES, found.count(), "page_id", "hash").collect():
        if r.n <= room:
            chosen.add(r.hash)
            room -= r.n
    # At most TRAIN_PAGES hashes; of equal pages one is enough.
    sample = found.withColumn("hash", F.xxhash64("html")).filter(F.col("hash").isin(chosen)).dropDuplicates(["hash"])
    return pickle.dumps(learn([r.html for r in sample.orderBy("hash").select("html").collect()]))


@functools.lru_cache(maxsize=2)
def _parameters_of(model: bytes) -> dict[str, np.ndarray]:
    return pickle.loads(model)


def main_blocks(pages: Sequence[str], parameters: dict[str, np.ndarray]) -> list[list[str]]:
    """The texts of each page's blocks that are main text."""
    _word_buckets.tidy()
    blocks = [blocks_of(page) for page in pages]
    out: list[list[str]] = [[] for _ in pages]
    filled = [k for k, own in enumerate(blocks) if own]
    for batch in lstm.batches_by_length([len(blocks[k]) for k in filled], BATCH_BLOCKS):
        x, mask = lstm.padded([vectors(blocks[filled[k]]) for k in batch])
        main = lstm.logits(parameters, x, mask) > 0
        for column, k in enumerate(batch):
            own = blocks[filled[k]]
            out[filled[k]] = [b.text for b, yes in zip(own, main[: len(own), column]) if yes]
    return out


def extract(pages: DataFrame, model: bytes, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars and n_blocks per row of ``pages``.

    text joins the main blocks by one space; it is empty for null and empty html
    and for pages without main text. Repeated rows and null ids give a row each.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parameters = _parameters_of(shared.value)
        for part in slices(batches, 128):
            found = main_blocks([page or "" for page in part.column("html").to_pylist()], parameters)
            texts = [" ".join(own) for own in found]
            columns = [
                part.column("page_id"),
                part.column("url"),
                pa.array(texts, pa.string()),
                pa.array(list(map(len, texts)), pa.int64()),
                pa.array(list(map(len, found)), pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, PAGE_TEXT.names)

    rows = pick(pages, page_id=id_col, url=url_col, html=html_col).withColumn("page_id", F.col("page_id").cast("bigint"))
    return map_arrow(rows, run, PAGE_TEXT)
