"""Packing documents into as few windows as a local search finds.

A document is its token ids and an end id.  What exceeds a window is cut so that all pieces but the first fill one; pieces are dealt
evenly over groups of some ``GROUP`` short ones and packed there.  A group starts from best fit, then exchanges pieces between
underfull windows: one moves, one goes for one, two for one.  Each exchange raises the sum of squared fills, so full windows
get fuller until others are empty, and the search ends by itself: at a proven lower bound or where no exchange is left.

Only slim rows are shuffled, never texts.  A group that is run again after a lost executor sorts its pieces before packing them.
"""

from __future__ import annotations

import json
import zlib
from array import array
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Callable, Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.llm.common import read

WINDOW = 1024
END_ID = 2
GROUP = 1 << 13
#: How byte-level models cut a text before merging, as their public description has it (fixed value).
CUT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
NAMES = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


def byte_encoder(path: str) -> Callable[[str], array]:
    """Ids of a text by the byte-level model in ``path``.

    The model's vocabulary is its order of merges, so a quicker reader of such ranks gives the same ids (tested against the model).
    Texts with a special token's string are read by the model itself, which tells those apart.
    """
    import tiktoken
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        found = json.load(f)
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in prints} | {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in prints)}
    special = [t["content"] for t in found["added_tokens"]]
    ranks = {bytes(letters[c] for c in word): n for word, n in found["model"]["vocab"].items() if word not in special}
    quick = tiktoken.Encoding("ranks", pat_str=CUT, mergeable_ranks=ranks, special_tokens={})
    slow: list = []

    def encode(text: str) -> array:
        if any(s in text for s in special):
            if not slow:
                slow.append(Tokenizer.from_file(path))
            return array("I", slow[0].encode(text, add_special_tokens=False).ids)
        return array("I", quick.encode_ordinary(text))

    return encode


def least_bins(sizes: list[int], window: int) -> int:
    """A lower bound of the windows that ``sizes`` need.

    For each k, sizes above ``window - k`` share with none of at least k; those above half a window share with no other such, and
    sizes of k to half a window can only use the room these leave, or windows of their own.
    """
    count = np.bincount(np.asarray(sizes, np.int64), minlength=window + 1)
    total = count * np.arange(window + 1)
    upto, mass = np.concatenate([[0], np.cumsum(count)]), np.concatenate([[0], np.cumsum(total)])
    half, best = window // 2, 0
    for k in range(half + 1):
        large = upto[-1] - upto[window - k + 1]
        middle, used = upto[window - k + 1] - upto[half + 1], mass[window - k + 1] - mass[half + 1]
        rest = mass[half + 1] - mass[k] - (middle * window - used)
        best = max(best, int(large + middle + max(0, -(-rest // window))))
    return best


def best_fit(sizes: list[int], window: int) -> list[list[int]]:
    """Sizes, taken from the front, each in the window with the least room that holds it."""
    bins: list[list[int]] = []
    room: list[tuple[int, int]] = []
    for size in sizes:
        at = bisect_left(room, (size, -1))
        if at == len(room):
            left, into = window, len(bins)
            bins.append([])
        else:
            left, into = room.pop(at)
        bins[into].append(size)
        if left > size:
            insort(room, (left - size, into))
    return bins


class Search:
    """Underfull bins, and for each amount that one or two pieces make, the emptiest bin that could give it away."""

    def __init__(self, bins: list[list[int]], window: int):
        self.window, self.bins = window, bins
        self.fill = [sum(b) for b in bins]
        self.filled = sum(f > 0 for f in self.fill)
        self.version = [0] * len(bins)
        # By number of pieces: heaps of (fill, bin, version, pieces) by amount, and a bit for each amount that has any.
        self.givers: dict[int, list[list[tuple]]] = {n: [[] for _ in range(window + 1)] for n in (1, 2)}
        self.amounts = {1: 0, 2: 0}
        for at in range(len(bins)):
            self._list(at)

    def _gifts(self, at: int) -> list[tuple[int, ...]]:
        """Every different piece and pair of pieces of a bin."""
        pieces = self.bins[at]
        kinds = sorted(set(pieces))
        pairs = [(a, b) for i, a in enumerate(kinds) for b in kinds[i:] if a < b or pieces.count(a) > 1]
        return [(a,) for a in kinds] + pairs

    def _list(self, at: int) -> None:
        """Offers a changed bin's pieces; what it offered before is void by its version."""
        self.version[at] += 1
        if 0 < self.fill[at] < self.window:
            for pieces in self._gifts(at):
                heappush(self.givers[len(pieces)][sum(pieces)], (self.fill[at], at, self.version[at], pieces))
                self.amounts[len(pieces)] |= 1 << sum(pieces)

    def _emptiest(self, n: int, amount: int, but: int) -> tuple | None:
        """The valid offer of ``n`` pieces and that amount from the emptiest bin other than ``but``."""
        heap, own, found = self.givers[n][amount], [], None
        while heap and found is None:
            fill, at, version, _ = heap[0]
            if version != self.version[at]:
                heappop(heap)
            elif at == but:
                own.append(heappop(heap))
            else:
                found = heap[0]
        for offer in own:
            heappush(heap, offer)
        if not heap:
            self.amounts[n] &= ~(1 << amount)
        return found

    def _offer(self, into: int) -> tuple[int, int, tuple[int, ...], tuple[int, ...]] | None:
        """The exchange that raises squared fills most for a bin: (raise, other bin, pieces given, pieces taken)."""
        fill, gap, best = self.fill[into], self.window - self.fill[into], None
        for given in [(), *self._gifts(into)]:
            back = sum(given)
            for n in (1, 2) if len(given) == 1 else (1,):
                wanted = self.amounts[n] & ((1 << (back + gap + 1)) - 1) >> (back + 1) << (back + 1)
                while wanted:
                    amount = wanted.bit_length() - 1
                    gain = amount - back
                    if best is not None and gain * (fill + gain) <= best[0]:
                        break  # no smaller gain can do better, even from an empty bin
                    found = self._emptiest(n, amount, into)
                    if found is not None:
                        rise = gain * (fill - found[0] + gain)
                        if rise > 0 and (best is None or rise > best[0]):
                            best = rise, found[1], given, found[3]
                    wanted &= ~(1 << amount)
        return best

    def run(self, enough: int) -> None:
        """Exchanges until ``enough`` bins hold all pieces, or none raises the squared fills."""
        changed = True
        while changed and self.filled > enough:
            changed = False
            for into in sorted(range(len(self.bins)), key=lambda b: (-self.fill[b], b)):
                while 0 < self.fill[into] < self.window and (found := self._offer(into)) is not None:
                    _, other, given, taken = found
                    for pieces, source, target in ((given, into, other), (taken, other, into)):
                        for p in pieces:
                            self.bins[source].remove(p)
                            self.bins[target].append(p)
                    gain = sum(taken) - sum(given)
                    self.fill[into] += gain
                    self.fill[other] -= gain
                    self._list(into)
                    self._list(other)
                    changed = True
                    if not self.fill[other]:
                        self.filled -= 1
                        if self.filled <= enough:
                            return


def packed_bins(sizes: list[int], window: int) -> list[list[int]]:
    """Sizes (1 to ``window``) in few bins."""
    bins = best_fit(sorted(sizes, reverse=True), window)
    search = Search(bins, window)
    search.run(least_bins(sizes, window))
    return [b for b in bins if b]


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row per piece: its document, number, place and length there, digest of its ids, window and offset in the window.

    ``with_ids`` adds the piece's ids as an array.  Defined cases: a null or empty text is the end id alone; a null id stays null;
    every row is packed as a document of its own, repeated ones too; equal lengths go by id (null first), piece and digest, so
    only equal rows can change places; a long text is cut, never dropped; an empty table gives no rows; other columns are not read.
    """
    slim = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    groups = max(1, -(-slim.count() // GROUP))
    kind = slim.schema["doc_id"].dataType.simpleString()
    cut_names, numbers = NAMES[:5], [pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    ids_name, ids_schema = (["ids"], ", ids array<bigint>") if with_ids else ([], "")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = byte_encoder(tokenizer_path)
        for batch in batches:
            rows: list[list] = [[] for _ in range(4)]
            ids_of, owners = [], []
            for at, text in enumerate(batch.column(1)):
                ids = encode(text.as_py() or "")
                ids.append(end_id)
                edges = [0, *range(len(ids) % window or window, len(ids) + 1, window)] if len(ids) > window else [0, len(ids)]
                for piece, (a, b) in enumerate(zip(edges, edges[1:])):
                    for column, value in zip(rows, (piece, a, b - a, zlib.crc32(ids[a:b]))):
                        column.append(value)
                    owners.append(at)
                    if with_ids:
                        ids_of.append(list(ids[a:b]))
            arrays = [batch.column(0).take(pa.array(owners, pa.int64())), *[pa.array(c, k) for c, k in zip(rows, numbers)]]
            yield pa.RecordBatch.from_arrays(arrays + [pa.array(ids_of, pa.list_(pa.int64()))] * with_ids, cut_names + ids_name)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 40
        held, used = [], 0

        def with_places(rows: pa.RecordBatch, sequences: list[int], offsets: list[int]) -> pa.RecordBatch:
            places = [pa.array([base + s for s in sequences], pa.int64()), pa.array(offsets, pa.int64())]
            return pa.RecordBatch.from_arrays([*rows.columns[:5], *places, *rows.columns[5:]], NAMES + ids_name)

        for batch in batches:
            lengths = batch.column(3).to_numpy()
            full = np.flatnonzero(lengths == window)
            if len(full):
                yield with_places(batch.take(pa.array(full)), list(range(used, used + len(full))), [0] * len(full))
                used += len(full)
            held.append(batch.take(pa.array(np.flatnonzero(lengths < window))))
        rows = pa.Table.from_batches(held) if held else None
        if rows is None or not rows.num_rows:
            return
        rows = rows.combine_chunks().to_batches()[0]
        ids, pieces, lengths, digests = (rows.column(c).to_pylist() for c in (0, 1, 3, 4))
        order = sorted(range(len(ids)), key=lambda i: (lengths[i], ids[i] is not None, ids[i] if ids[i] is not None else 0, pieces[i], digests[i]))
        waiting: dict[int, list[int]] = defaultdict(list)
        for i in reversed(order):
            waiting[lengths[i]].append(i)
        sequences, offsets = [0] * len(ids), [0] * len(ids)
        for sizes in packed_bins(lengths, window):
            offset = 0
            for size in sizes:
                i = waiting[size].pop()
                sequences[i], offsets[i] = used, offset
                offset += size
            used += 1
        yield with_places(rows, sequences, offsets)

    schema = f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint"
    pieces = slim.mapInArrow(cut, schema + ids_schema).repartition(groups)
    return pieces.mapInArrow(placed, schema + ", sequence_id bigint, offset bigint" + ids_schema)


def op12_swap_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in windows of 1024 tokens."""
    import public_tokenizers

    return pack(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
