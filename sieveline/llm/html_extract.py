"""Main text of web pages by a recurrent block labeller.

A page is parsed into leaf blocks: runs of text and inline markup between block-level tags.  A block is read as its tag path
(names, classes and ids of the elements around it), its hashed words and a few numbers; a bidirectional LSTM in numpy runs over the
blocks of the page, so each is labelled from what stands before and after it, and the blocks labelled main text are joined.

There are no labelled pages, so the labeller learns from markup that says what it is: blocks inside ``article`` or ``main`` and
outside of navigation, footers, adverts and the like are main text.  Training pages are varied - containers renamed or stripped of their
names, notices, sidebars, comments, forms and adverts put around and into articles, names hidden at random - so that it also has to
rely on the rest of the path, the words and the context.

Bounds, for tables of any size: training reads ``SAMPLE`` pages and ``CROP`` blocks of each (their words as counts of buckets, whole),
and the model is about 60,000 numbers.  Extraction is one pass without a shuffle; pages are labelled in groups of similar length
with a bounded number of blocks.  A path names the ``DEPTH`` outermost and innermost elements and ``PIECES`` marks of each, so that
parsing takes time in proportion to the page however deep it nests.
"""

from __future__ import annotations

import html as entities
import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.llm.common import free_name, read

#: Pages that the labeller is trained on, and blocks of each (half from its start, half from its end), at most.
SAMPLE, CROP = 300, 96
PATH_BUCKETS, WORD_BUCKETS, PATH_WIDTH, WORD_WIDTH, NUMBERS, HIDDEN = 1024, 512, 24, 8, 7, 24
EPOCHS, BATCH, STEP = 10, 24, 0.01
#: Pages, and blocks with their padding, that are labelled at once; tokens whose vectors are summed at once.
GROUP, GROUP_BLOCKS, TOKENS_AT_ONCE = 64, 1 << 14, 1 << 18
#: Elements that a path names from either end, and parts of names and attributes that it tells of each.
DEPTH, PIECES = 32, 24

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
MATH = (
    "math mi mo mn ms mtext mrow mfrac msqrt mroot mstyle merror mpadded mphantom mfenced menclose msub msup msubsup munder mover munderover"
    " mmultiscripts mprescripts mtable mtr mtd mlabeledtr maction semantics none mspace"
).split()
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup"
    " time tt u var wbr br area map picture source ruby rb rt rp nobr center".split()
    + MATH
)
#: Elements whose content is no text of the page.
DROPPED = frozenset("script style noscript template svg annotation annotation-xml iframe object canvas audio video head title textarea select button datalist".split())
#: Start tags that may stand in a head; any other one, or text, ends it.
HEAD = frozenset("base basefont bgsound link meta title style script noscript template head html".split())
RAW = frozenset("script style textarea title iframe noscript template".split())
#: Start tags that end an open element of the same row without an end tag.
SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPE = frozenset("ul ol dl table tbody thead tfoot article section div body main aside nav header footer form td th".split())

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>", re.S)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
_PIECE = re.compile(r"[a-z]+|\d+")

# Names by which pages mark what is not main text, and what is: for weak labels and for varied training pages.
BOILERPLATE = (
    "nav menu navbar navigation header masthead topbar footer aside sidebar widget ad ads advert advertisement sponsored promo banner cookie"
    " cookies consent notice alert popup modal newsletter subscribe signup login form search comment comments reply replies discussion"
    " disqus share social related recommended trending breadcrumb breadcrumbs pagination pager tags copyright legal disclaimer toolbar"
).split()
FORMS = (
    ("ul", "li"), ("ol", "li"), ("blockquote",), ("blockquote", "p"), ("h2",), ("h3",), ("table", "tr", "td"), ("pre",), ("div",),
    ("figure", "figcaption"), ("section", "p"), ("dl", "dd"),
)
MAIN = "article main content post story entry body text".split()

class Words(NamedTuple):
    """What the labeller reads of a block's text: its words as bucket ids and how often each stands there, and two facts."""

    ids: list[int]
    times: list[int]
    n: int
    ends: bool
    chars: int


Block = tuple["str | Words", tuple[str, ...], float]


def words_of(text: str) -> Words:
    split = text.split()
    found = Counter(zlib.crc32(w.encode("utf-8", "surrogatepass")) % WORD_BUCKETS for w in split) or {0: 1}
    return Words(list(found), list(found.values()), len(split), text[-1:] in ".!?:;", len(text))


def tokens_of(name: str, attributes: str) -> tuple[str, ...]:
    found = [name]
    for key, value in _ATTRIBUTE.findall(attributes or ""):
        mark = {"class": ".", "id": "#", "role": "@"}[key.lower()]
        found += [mark + piece for piece in _PIECE.findall(value.lower())]
    return tuple(found[: PIECES + 1])


class Stack:
    """Open elements with their path tokens; where the last one of a name stands is known without a search."""

    def __init__(self):
        self.names: list[str] = []
        self.tokens: list[tuple[str, ...]] = []
        self.places: dict[str, list[int]] = {}

    def __len__(self) -> int:
        return len(self.names)

    def push(self, name: str, tokens: tuple[str, ...]) -> None:
        self.places.setdefault(name, []).append(len(self.names))
        self.names.append(name)
        self.tokens.append(tokens)

    def cut(self, size: int) -> None:
        while len(self.names) > size:
            self.places[self.names.pop()].pop()
            self.tokens.pop()

    def last(self, names: Iterable[str]) -> int:
        return max((places[-1] for n in names if (places := self.places.get(n))), default=-1)

    def path(self, size: int | None = None) -> tuple[str, ...]:
        """Tokens of the elements up to ``size``, without those in the middle of a very deep nest."""
        size = len(self.names) if size is None else min(size, len(self.names))
        own = self.tokens[:size] if size <= 2 * DEPTH else self.tokens[:DEPTH] + self.tokens[size - DEPTH : size]
        return tuple(t for tokens in own for t in tokens)


def whole_of(pieces: list[str]) -> str:
    return " ".join(entities.unescape("".join(pieces)).split())


def leaf_blocks(page: str | None) -> list[tuple[str, tuple[str, ...], float]]:
    """(text, path tokens, share of characters in links) of every block with text, in page order."""
    page = page or ""
    blocks: list[tuple[str, tuple[str, ...], float]] = []
    stack = Stack()
    text: list[str] = []
    linked = 0
    #: Open dropped elements: name, depth, blocks before, text before and its links.
    drops: list[tuple[str, int, int, list[str], int, bool]] = []
    dropped: Counter = Counter()
    in_link = False
    skip_to = ""

    def flush() -> None:
        nonlocal linked, in_link
        if text:  # text in a dropped element counts as a block until its end tag takes it out
            whole = whole_of(text)
            if whole:
                blocks.append((whole, stack.path(), min(1.0, linked / len(whole))))
        text.clear()
        linked, in_link = 0, False

    def taken_out(k: int) -> None:
        """The dropped element ``k`` ends: what was read since its start is no text."""
        nonlocal text, linked, in_link
        dropped.subtract(d[0] for d in drops[k:])
        _, depth, before, text, linked, in_link = drops[k]
        stack.cut(depth)
        del blocks[before:], drops[k:]

    def left_open(depth: int) -> None:
        """Dropped elements deeper than ``depth`` never ended: what was read since their start is text."""
        nonlocal text, linked, in_link
        parts, late = [text], []  # texts from the last to the first, blocks to be put in before others, likewise

        def settle() -> None:
            nonlocal text
            if len(parts) > 1:
                text = [piece for part in reversed(parts) for piece in part]
            if late:
                merged, done = [], 0
                for before, block in reversed(late):
                    merged += blocks[done:before]
                    merged.append(block)
                    done = before
                blocks[:] = merged + blocks[done:]

        while drops and drops[-1][1] > depth:
            if drops[-1][0] == "head":
                settle()
                taken_out(len(drops) - 1)
                parts, late = [text], []
                continue
            name, at_depth, before, earlier, links, _ = drops.pop()
            dropped[name] -= 1
            if not late and len(blocks) == before:
                parts.append(earlier)
                linked += links
            elif earlier:
                whole = whole_of(earlier)
                if whole:
                    late.append((before, (whole, stack.path(at_depth), min(1.0, links / len(whole)))))
        settle()

    def pop_to(names: tuple[str, ...], scope: frozenset) -> None:
        at = stack.last(names)
        if at >= 0 and stack.last(scope.difference(names)) < at:
            left_open(at)
            flush()
            stack.cut(at)

    at, last_end = 0, page.rfind(">")
    while at < len(page):
        if skip_to:  # raw text ends at its own end tag only
            end = re.compile(rf"</{skip_to}\b[^>]*>", re.I).search(page, at) if at <= last_end else None
            at, skip_to = (end.end() if end else len(page)), ""
            continue
        tag = _TAG.search(page, at) if at <= last_end or "<!--" in page[at:] else None
        piece = page[at : tag.start() if tag else len(page)]
        if drops and drops[-1][0] == "head" and piece.strip():
            taken_out(len(drops) - 1)
        if piece:
            text.append(piece)
            if in_link:
                linked += len(piece.strip())
        if not tag:
            break
        at = tag.end()
        closing, name, attributes = (tag[1], tag[2], tag[3]) if tag[2] else (tag[4], tag[5], tag[6])
        if not name:
            continue
        name = name.lower()
        if drops and drops[-1][0] == "head" and not closing and name not in HEAD:
            taken_out(len(drops) - 1)
        if name in DROPPED:
            if name in RAW:
                skip_to = "" if closing else name
            elif not attributes.rstrip().endswith("/"):
                if not closing:
                    drops.append((name, len(stack), len(blocks), text, linked, in_link))
                    dropped[name] += 1
                    text, linked = [], 0
                elif dropped[name]:
                    taken_out(next(k for k in range(len(drops) - 1, -1, -1) if drops[k][0] == name))
            continue
        if name == "body" or name == "article" or name == "main":
            left_open(-1)  # what was never closed
        if name in INLINE:
            if name == "a":
                in_link = not closing
            elif name == "br" or name in MATH:
                text.append(" ")
            continue
        if name in VOID:
            flush()
            continue
        if closing:
            pop_to((name,), frozenset() if name in SCOPE else frozenset(("article", "main", "body")) if name == "p" else frozenset(("body",)))
            flush()
            continue
        flush()
        if name in SAME:
            pop_to(SAME[name], SCOPE - set(SAME[name]))
        elif stack.names and stack.names[-1] == "p" and (name == "p" or not drops or len(stack) > drops[-1][1]):
            left_open(len(stack) - 1)
            flush()
            stack.cut(len(stack) - 1)
        stack.push(name, tokens_of(name, attributes))
    left_open(-1)
    flush()
    return blocks


def names_in(path: tuple[str, ...]) -> set[str]:
    return {t.lstrip(".#@") for t in path}


def weak_labels(blocks: list[Block]) -> list[int]:
    """1 for main text as markup tells it.

    Where no container says so, long blocks outside of what is marked as none are main text, and so are short ones (headings, single
    lines) that stand with them: right before one under the same parent, or between two.
    """
    inside = [bool({"article", "main"} & set(path)) for _, path, _ in blocks]
    outside = [bool(names_in(path) & set(BOILERPLATE)) for _, path, _ in blocks]
    if any(inside):
        return [int(i and not o) for i, o in zip(inside, outside)]
    sizes = [text.chars if isinstance(text, Words) else len(text) for text, _, _ in blocks]
    long = [not o and n >= 40 for o, n in zip(outside, sizes)]

    def stands_with(k: int) -> bool:
        after = next((j for j in range(k + 1, min(k + 3, len(blocks))) if long[j]), None)
        if outside[k] or after is None:
            return False
        return any(long[max(0, k - 2) : k]) or blocks[after][1][:-1] == blocks[k][1][:-1]

    return [int(x or stands_with(k)) for k, x in enumerate(long)]


def varied(blocks: list[Block], labels: list[int], spare: list[list[str]], draw: np.random.Generator) -> tuple[list[Block], list[int]]:
    """A page like the given one with other containers: article renamed, names hidden, boilerplate put before, after and into it."""
    rename = draw.random() < 0.6
    outer = [("main",), ("div", "." + MAIN[draw.integers(len(MAIN))]), ("div", "#" + MAIN[draw.integers(len(MAIN))]), ("section",), ("div",)][draw.integers(5)]
    out: list[Block] = []
    marks: list[int] = []

    def junk(base: tuple[str, ...], times: int) -> None:
        name = BOILERPLATE[draw.integers(len(BOILERPLATE))]
        tag = name if name in ("nav", "header", "footer", "aside", "form") and draw.random() < 0.6 else ("div", "section", "aside", "ul")[draw.integers(4)]
        inner = (("p",), ("li",), ("div",), ("span",), ("h3",), ("div", "p"))[draw.integers(6)]
        marked = (tag,) if tag == name else (tag, (".", "#")[draw.integers(2)] + name)
        for _ in range(times):
            words = spare[draw.integers(len(spare))] if spare else ["more"]
            start = draw.integers(max(1, len(words) - 3))
            count = draw.integers(1, 6) if draw.random() < 0.5 else draw.integers(6, 60)
            out.append((" ".join(words[start : start + count]) or "more", (*base, *marked, *inner), float(draw.random() < 0.3)))
            marks.append(0)

    top = ("html", "body")
    for _ in range(draw.integers(0, 3)):
        junk(top, draw.integers(1, 6))
    form, left = (), 0
    for (text, path, links), label in zip(blocks, labels):
        if left == 0 and draw.random() < 0.12:
            form, left = FORMS[draw.integers(len(FORMS)) if draw.random() < 0.6 else draw.integers(2)], draw.integers(1, 7)
        if rename and label:
            path = tuple(x for t in path for x in (outer if t in ("article", "main") else (t,)))
        if label and left:
            left -= 1
            if path[-1:] == ("p",):
                path = (*path[:-1], *form)
        if draw.random() < 0.1:
            path = tuple(t for t in path if t[0] not in ".#@")
        out.append((text, path, links))
        marks.append(label)
        if label and draw.random() < 0.05:
            junk(path[:-1], draw.integers(1, 3))
    for _ in range(draw.integers(0, 3)):
        junk(top, draw.integers(1, 8))
    return out, marks


def encoded(blocks: list[Block]) -> tuple[list[tuple], list[tuple], np.ndarray]:
    """Path buckets and word buckets with their times, and numbers of each block."""
    paths, words, numbers = [], [], np.zeros((len(blocks), NUMBERS), np.float32)
    known: dict[tuple[str, ...], np.ndarray] = {}  # blocks side by side share their path
    for k, (text, path, links) in enumerate(blocks):
        if path not in known:
            known[path] = np.array([zlib.crc32(t.encode()) % PATH_BUCKETS for t in path] or [0])
        paths.append((known[path], None))
        if isinstance(text, Words):
            n, ends = text.n, text.ends
            words.append((np.array(text.ids), np.array(text.times)))
        else:
            split = text.split()
            n, ends = len(split), text[-1:] in ".!?:;"
            words.append((np.array([zlib.crc32(w.encode("utf-8", "surrogatepass")) % WORD_BUCKETS for w in split] or [0]), None))
        last = path[-1] if path else ""
        numbers[k] = (
            min(2.0, np.log1p(n) / 4), links, ends, last == "p", last == "li", last[:1] == "h" and last[1:].isdigit(),
            k / max(1, len(blocks) - 1),
        )
    return paths, words, numbers


def flat(rows: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket ids of all rows on end, the share of its row that each has, and the rows' sizes."""
    sizes = np.array([len(ids) for ids, _ in rows], np.int64)
    ids = np.concatenate([ids for ids, _ in rows])
    times = np.concatenate([np.ones(len(ids), np.float32) if times is None else times for ids, times in rows])
    sums = np.add.reduceat(times, np.concatenate([[0], np.cumsum(sizes)[:-1]]))
    return ids, (times / np.repeat(sums, sizes)).astype(np.float32), sizes


def shares(rows: list[tuple], width: int) -> np.ndarray:
    """Shares of each row's buckets as a dense matrix; for training, whose rows are bounded."""
    ids, share, sizes = flat(rows)
    places = np.repeat(np.arange(len(rows)), sizes) * width + ids
    return np.bincount(places, share, len(rows) * width).reshape(len(rows), width).astype(np.float32)


def mean_vectors(rows: list[tuple], vectors: np.ndarray) -> np.ndarray:
    """Mean of each row's bucket vectors, summed in bounded parts."""
    out, start = np.zeros((len(rows), vectors.shape[1]), np.float32), 0
    while start < len(rows):
        stop, n = start, 0
        while stop < len(rows) and (stop == start or n + len(rows[stop][0]) <= TOKENS_AT_ONCE):
            n += len(rows[stop][0])
            stop += 1
        ids, share, sizes = flat(rows[start:stop])
        out[start:stop] = np.add.reduceat(vectors[ids] * share[:, None], np.concatenate([[0], np.cumsum(sizes)[:-1]]))
        start = stop
    return out


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class Labeller:
    """A bidirectional LSTM over a page's blocks with a logistic output."""

    def __init__(self, seed: int = 7):
        draw = np.random.default_rng(seed)
        width = PATH_WIDTH + WORD_WIDTH + NUMBERS
        normal = lambda *shape, scale: (draw.standard_normal(shape) * scale).astype(np.float32)
        self.w = {"path": normal(PATH_BUCKETS, PATH_WIDTH, scale=0.3), "word": normal(WORD_BUCKETS, WORD_WIDTH, scale=0.3)}
        for side in "fb":
            self.w["x" + side] = normal(width, 4 * HIDDEN, scale=width**-0.5)
            self.w["h" + side] = normal(HIDDEN, 4 * HIDDEN, scale=HIDDEN**-0.5)
            bias = np.zeros(4 * HIDDEN, np.float32)
            bias[HIDDEN : 2 * HIDDEN] = 1
            self.w["c" + side] = bias
        self.w["out"], self.w["bias"] = normal(2 * HIDDEN, scale=0.3), np.zeros(1, np.float32)
        self.m = {k: np.zeros_like(v) for k, v in self.w.items()}
        self.v = {k: np.zeros_like(v) for k, v in self.w.items()}
        self.t = 0

    def run(self, x: np.ndarray, mask: np.ndarray, side: str, keep: bool) -> tuple[np.ndarray, list]:
        """Hidden states of (pages, blocks, width) inputs; padding leaves the state as it is."""
        n, length, _ = x.shape
        h = c = np.zeros((n, HIDDEN), np.float32)
        inputs, states, tape = x @ self.w["x" + side] + self.w["c" + side], np.zeros((n, length, HIDDEN), np.float32), []
        for t in range(length) if side == "f" else range(length - 1, -1, -1):
            z = inputs[:, t] + h @ self.w["h" + side]
            i, f, o = (sigmoid(z[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
            g = np.tanh(z[:, 3 * HIDDEN :])
            here = mask[:, t, None]
            c_new = f * c + i * g
            squashed = np.tanh(c_new)
            if keep:
                tape.append((t, h, c, i, f, o, g, squashed, here))
            h, c = np.where(here, o * squashed, h), np.where(here, c_new, c)
            states[:, t] = h
        return states, tape

    def back(self, x: np.ndarray, tape: list, grad: np.ndarray, side: str, grads: dict) -> np.ndarray:
        dh_next = dc_next = np.zeros((x.shape[0], HIDDEN), np.float32)
        dz_all = np.zeros((*x.shape[:2], 4 * HIDDEN), np.float32)
        weights = np.zeros_like(self.w["h" + side])
        for t, h, c, i, f, o, g, squashed, here in reversed(tape):
            dh, dc = dh_next + grad[:, t], dc_next
            inner = np.where(here, dh, 0)
            dcell = np.where(here, dc, 0) + inner * o * (1 - squashed**2)
            dz = np.concatenate([dcell * g * i * (1 - i), dcell * c * f * (1 - f), inner * squashed * o * (1 - o), dcell * i * (1 - g**2)], axis=1)
            dz_all[:, t] = dz
            weights += h.T @ dz
            dh_next = np.where(here, dz @ self.w["h" + side].T, dh)
            dc_next = np.where(here, dcell * f, dc)
        flat = dz_all.reshape(-1, 4 * HIDDEN)
        grads["h" + side], grads["c" + side] = weights, flat.sum(axis=0)
        grads["x" + side] = x.reshape(-1, x.shape[2]).T @ flat
        return (flat @ self.w["x" + side].T).reshape(x.shape)

    def batch(self, pages: list[tuple], parts: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Inputs and mask of padded pages, from the path and word vectors of their blocks."""
        length = max(len(p[0]) for p in pages)
        mask = np.arange(length)[None, :] < np.array([len(p[0]) for p in pages])[:, None]
        x = np.zeros((*mask.shape, PATH_WIDTH + WORD_WIDTH + NUMBERS), np.float32)
        x[mask] = np.concatenate([*parts, np.concatenate([p[2] for p in pages])], axis=1)
        return x, mask

    def chances(self, pages: list[tuple]) -> list[np.ndarray]:
        """Chance of being main text, per block of each page."""
        vectors = [mean_vectors([r for p in pages for r in p[at]], self.w[name]) for at, name in enumerate(("path", "word"))]
        x, mask = self.batch(pages, tuple(vectors))
        states = np.concatenate([self.run(x, mask, side, False)[0] for side in "fb"], axis=2)
        chance = sigmoid(states @ self.w["out"] + self.w["bias"])
        return [chance[k, : len(p[0])] for k, p in enumerate(pages)]

    def step(self, pages: list[tuple], labels: list[list[int]]) -> None:
        path, word = (shares([r for p in pages for r in p[at]], width) for at, width in enumerate((PATH_BUCKETS, WORD_BUCKETS)))
        x, mask = self.batch(pages, (path @ self.w["path"], word @ self.w["word"]))
        (fore, tape_f), (aft, tape_b) = (self.run(x, mask, side, True) for side in "fb")
        states = np.concatenate([fore, aft], axis=2)
        target = np.zeros(mask.shape, np.float32)
        target[mask] = np.concatenate(labels)
        delta = np.where(mask, sigmoid(states @ self.w["out"] + self.w["bias"]) - target, 0) / mask.sum()
        grads = {"out": np.einsum("nth,nt->h", states, delta), "bias": delta.sum(keepdims=True).reshape(1)}
        spread = delta[:, :, None] * self.w["out"]
        dx = self.back(x, tape_f, spread[:, :, :HIDDEN], "f", grads) + self.back(x, tape_b, spread[:, :, HIDDEN:], "b", grads)
        grads["path"], grads["word"] = path.T @ dx[mask][:, :PATH_WIDTH], word.T @ dx[mask][:, PATH_WIDTH : PATH_WIDTH + WORD_WIDTH]
        self.t += 1
        for k, g in grads.items():
            self.m[k] = 0.9 * self.m[k] + 0.1 * g
            self.v[k] = 0.999 * self.v[k] + 0.001 * g * g
            self.w[k] -= STEP * (self.m[k] / (1 - 0.9**self.t)) / (np.sqrt(self.v[k] / (1 - 0.999**self.t)) + 1e-8)


def train(pages: list[list[Block]], spare: list[list[str]] | None = None, seed: int = 7) -> Labeller:
    """A labeller trained on varied forms of the pages, anew in every epoch; ``spare`` are words to make boilerplate of."""
    draw, model = np.random.default_rng(seed), Labeller(seed)
    pages = [p for p in pages if p]
    marked = [weak_labels(p) for p in pages]
    spare = [text.split() for p in pages for text, _, _ in p if isinstance(text, str)] if spare is None else spare
    for epoch in range(EPOCHS):
        made = []
        for page, labels in zip(pages, marked):
            blocks, marks = varied(page, labels, spare, draw) if epoch % 4 else (page, labels)
            made.append((encoded(blocks), marks))
        order = sorted(range(len(made)), key=lambda k: (len(made[k][1]), k))
        starts = list(range(0, len(order), BATCH))
        for start in draw.permutation(starts):
            part = [made[k] for k in order[start : start + BATCH]]
            model.step([p for p, _ in part], [m for _, m in part])
    return model


def fit(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", sample: int = SAMPLE) -> Labeller:
    """A labeller for ``pages``, trained on those ``sample`` pages whose ids have the smallest digests.

    Of each block the driver gets its words as counts of buckets, over the whole block, its path, and up to 60 of its words as
    material for the boilerplate of training pages.
    """
    ids = pages.select(F.col(f"`{id_col}`").alias("id")).where("id IS NOT NULL").distinct()
    ids = F.broadcast(ids.orderBy(F.md5(F.col("id").cast("string").cast("binary")), "id").limit(sample))
    chosen = pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{html_col}`").alias("html")).join(ids, "id")
    chosen = chosen.groupBy("id").agg(F.min_by("html", F.xxhash64("html")).alias("html"))
    block = "ids:array<int>,times:array<int>,n:int,ends:boolean,chars:int,path:array<string>,links:double,spare:array<string>"

    def cropped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pages = [leaf_blocks(h.as_py()) for h in batch.column(1)]
            pages = [p if len(p) <= CROP else p[: CROP // 2] + p[-CROP // 2 :] for p in pages]
            read = [[{**words_of(t)._asdict(), "path": list(path), "links": links, "spare": t.split()[:60]} for t, path, links in p] for p in pages]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(read, kind)], ["id", "blocks"])

    text, whole, real = pa.list_(pa.string()), pa.list_(pa.int32()), pa.float64()
    kind = pa.list_(pa.struct([
        ("ids", whole), ("times", whole), ("n", pa.int32()), ("ends", pa.bool_()), ("chars", pa.int32()), ("path", text), ("links", real), ("spare", text),
    ]))
    rows = chosen.mapInArrow(cropped, f"id {pages.schema[id_col].dataType.simpleString()}, blocks array<struct<{block}>>").toArrow().sort_by("id")
    found = [r["blocks"] for r in rows.to_pylist()]
    made = [[(Words(b["ids"], b["times"], b["n"], b["ends"], b["chars"]), tuple(b["path"]), b["links"]) for b in p] for p in found]
    return train(made, [b["spare"] for p in found for b in p])


def main_texts(pages: list[str | None], model: Labeller) -> list[str]:
    """The main text of each page, labelled in groups of similar length."""
    blocks = [leaf_blocks(p) for p in pages]
    texts = [""] * len(pages)
    order = sorted((k for k in range(len(pages)) if blocks[k]), key=lambda k: len(blocks[k]))
    while order:
        n = 1
        while n < min(GROUP, len(order)) and (n + 1) * len(blocks[order[n]]) <= GROUP_BLOCKS:
            n += 1
        group, order = order[:n], order[n:]
        for k, chance in zip(group, model.chances([encoded(blocks[k]) for k in group])):
            texts[k] = "\n\n".join(b[0] for b, c in zip(blocks[k], chance) if c >= 0.5)
    return texts


def extract(pages: DataFrame, model: Labeller, html_col: str = "html", out: tuple[str, str] = ("text", "n_chars")) -> DataFrame:
    """``pages`` without their html but with the main text and its code points; columns named as ``out`` are replaced.

    Defined cases: a null, empty or blank page, or one without text, gives an empty text; markup that never closes ends with the
    page; a very long page is parsed and labelled whole, in time that grows with its length; repeated rows give equal texts; an empty
    table gives no rows; other columns pass through unread, whatever their names.
    """
    kept = [c for c in pages.columns if c not in out and c != html_col]
    wide = pages.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{html_col}`").alias(free_name(kept, "html")))
    shared = pages.sparkSession.sparkContext.broadcast(model.w)

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Labeller()
        own.w = shared.value
        for batch in batches:
            texts: list[str] = []
            for start in range(0, batch.num_rows, 8 * GROUP):
                texts += main_texts(batch.column(len(kept)).slice(start, 8 * GROUP).to_pylist(), own)
            sizes = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string()), sizes], [*kept, *out])

    schema = pages.select(*[F.col(f"`{c}`") for c in kept], F.lit("").alias(out[0]), F.lit(0).cast("bigint").alias(out[1])).schema
    return wide.mapInArrow(extracted, schema)


def op2_block_labeller(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = read(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract(pages, fit(pages))
