"""Swap-search packing: round trips, exact small packings, and what single exchanges do."""

import itertools
import random
import zlib
from array import array
from collections import defaultdict

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from sieveline.llm import bin_search
from tests.llm import small

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def fewest(sizes, window):
    """Least number of bins by trying every place."""
    best = len(sizes)

    def place(at, room):
        nonlocal best
        if len(room) >= best:
            return
        if at == len(sizes):
            best = len(room)
            return
        for i in {r: i for i, r in enumerate(room) if r >= sizes[at]}.values():
            place(at + 1, [r - sizes[at] * (j == i) for j, r in enumerate(room)])
        place(at + 1, [*room, window - sizes[at]])

    place(0, [])
    return best


def test_small_sets_are_packed_as_few_as_can_be():
    draw = random.Random(3)
    over = 0
    for _ in range(60):
        sizes = [draw.randint(1, 20) for _ in range(draw.randint(1, 9))]
        bins = bin_search.packed_bins(sizes, 20)
        assert sorted(itertools.chain(*bins)) == sorted(sizes) and all(sum(b) <= 20 for b in bins)
        least = fewest(sizes, 20)
        assert bin_search.least_bins(sizes, 20) <= least <= len(bins)
        over += len(bins) - least
    assert over <= 1


@pytest.mark.parametrize(
    "bins, enough",
    [
        ([[6], [3], [1]], 1),  # moves
        ([[6, 3], [5, 2], [4]], 2),  # one for one: 6 with 4
        ([[7, 2], [6, 3], [1, 1]], 2),  # two for one
        ([[5, 5], [4, 3, 2], [6], [3, 2]], 3),
    ],
)
def test_exchanges_empty_a_bin(bins, enough):
    pieces = sorted(itertools.chain(*bins))
    search = bin_search.Search([list(b) for b in bins], 10)
    search.run(enough)
    assert sorted(itertools.chain(*search.bins)) == pieces
    assert sum(map(bool, search.bins)) == enough and max(map(sum, search.bins)) <= 10


def test_every_exchange_raises_squared_fills():
    draw = random.Random(9)
    bins = [[draw.randint(1, 30) for _ in range(3)] for _ in range(60)]
    search, squares = bin_search.Search(bins, 100), []
    offer = search._offer

    def watched(into):
        squares.append(sum(f * f for f in search.fill))
        assert search.fill == [sum(b) for b in search.bins]
        return offer(into)

    search._offer = watched
    search.run(0)
    assert all(a <= b for a, b in zip(squares, squares[1:])) and squares[-1] > squares[0]
    assert sum(map(bool, search.bins)) <= bin_search.least_bins(list(itertools.chain(*search.bins)), 100) + 1


def test_search_beats_plain_best_fit():
    draw = random.Random(1)
    sizes = []
    for _ in range(300):  # triples that fill a window exactly
        a, b = draw.randint(250, 400), draw.randint(250, 400)
        sizes += [a, b, 1024 - a - b]
    plain = len(bin_search.best_fit(sorted(sizes, reverse=True), 1024))
    assert 300 <= len(bin_search.packed_bins(sizes, 1024)) < plain


def test_ids_are_the_model_s():
    model = Tokenizer.from_file(TOKENIZER)
    encode = bin_search.byte_encoder(TOKENIZER)
    draw = random.Random(7)
    pool = "ab Z\n\t .,'s1²é̈  漢🙂\x00\x1c\x85İſำ"
    texts = ["".join(draw.choice(pool) for _ in range(draw.randint(0, 60))) for _ in range(3000)]
    texts += [t or "" for t in small.texts()] + ["a" * 50_000, " " * 50_000, "<|endoftext|>x <|endoftext|>"]
    texts += ["".join(f"{chr(c)} a{chr(c)}\n" for c in range(start, start + 0x400) if not 0xD800 <= c < 0xE000) for start in range(0, 0x20000, 0x400)]
    for text in texts:
        assert list(encode(text)) == model.encode(text, add_special_tokens=False).ids, repr(text[:80])


def test_round_trip(spark):
    docs = small.documents(spark)
    model = Tokenizer.from_file(TOKENIZER)
    out = bin_search.pack(docs, TOKENIZER, with_ids=True).collect()
    want = sorted(zlib.crc32(array("I", [*model.encode(r.text or "", add_special_tokens=False).ids, 2])) for r in docs.collect())
    by_doc = defaultdict(list)
    for r in out:
        by_doc[r.doc_id].append(r)
        assert r.length == len(r.ids) <= 1024 and r.ids_crc32 == zlib.crc32(array("I", r.ids))
    # Repeated and null ids hold several documents: a document's pieces end where its end id stands.
    whole = []
    for rows in by_doc.values():
        last = [r for r in rows if r.ids[-1] == 2]
        for r in last:
            if r.piece == 0:
                whole.append(zlib.crc32(array("I", r.ids)))
            else:
                pieces = sorted((p for p in rows if p.start <= r.start), key=lambda p: p.piece)
                assert [p.piece for p in pieces] == list(range(r.piece + 1)) and all(p.length == 1024 for p in pieces[1:])
                assert [p.start for p in pieces] == [sum(q.length for q in pieces[:k]) for k in range(len(pieces))]
                whole.append(zlib.crc32(array("I", [i for p in pieces for i in p.ids])))
    assert sorted(whole) == want
    windows = defaultdict(list)
    for r in out:
        windows[r.sequence_id].append((r.offset, r.length))
    for pieces in windows.values():
        pieces.sort()
        assert [o for o, _ in pieces] == [sum(n for _, n in pieces[:k]) for k in range(len(pieces))]
        assert sum(n for _, n in pieces) <= 1024
    assert len(windows) <= bin_search.least_bins([r.length for r in out], 1024) + 1
    slim = bin_search.pack(docs, TOKENIZER).collect()
    assert sorted(map(repr, slim)) == sorted(repr(r)[: repr(r).index(", ids=")] + ")" for r in out)


def test_no_rows(spark):
    assert bin_search.pack(small.nothing(spark), TOKENIZER).collect() == []
