"""Packing documents into windows by best-fit decreasing.

A document is its token ids and an end id.  What exceeds a window is cut into full windows first; the remaining tails are taken
from long to short, and a segment tree over remaining capacities finds the open window with the least room that still fits.

Packing is local: every task packs the rows of its own input partition, in groups of at most ``group`` tails, so nothing is
shuffled, no task holds more than a group's tails (whether their ids are asked for or not, so that the windows are the same), and a task that is run again after a lost executor gives the same
windows.  A group leaves at most a few windows part empty.  Window ids carry the partition in their upper bits.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Callable, Iterator
from unicodedata import is_normalized

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.llm.common import read

WINDOW = 2048
END_ID = 1
#: Tails that are packed together: with their ids, some 130 MB on average and 270 MB at most.
GROUP = 1 << 15
#: Words whose ids a task remembers, in each of two generations; forgetting changes no ids.
REMEMBERED = 1 << 18


class OpenWindows:
    """Open windows by remaining capacity: a segment tree tells which capacities have any."""

    def __init__(self, window: int):
        self.size = 1 << window.bit_length()
        self.some = bytearray(2 * self.size)
        self.stacks: list[list[int]] = [[] for _ in range(window + 1)]

    def _set(self, capacity: int, value: int) -> None:
        node = self.size + capacity
        self.some[node] = value
        node >>= 1
        while node:
            now = self.some[2 * node] | self.some[2 * node + 1]
            if self.some[node] == now:
                return
            self.some[node] = now
            node >>= 1

    def put(self, capacity: int, window: int) -> None:
        if capacity:
            self.stacks[capacity].append(window)
            if len(self.stacks[capacity]) == 1:
                self._set(capacity, 1)

    def tightest(self, length: int) -> tuple[int, int] | None:
        """Takes out (capacity, window) of the least capacity that holds ``length``."""
        if length >= len(self.stacks):
            return None
        node = self.size + length
        while not self.some[node]:
            while node & 1:  # a right child: go up
                node >>= 1
            if not node:
                return None
            node += 1
        while node < self.size:
            node = 2 * node if self.some[2 * node] else 2 * node + 1
        capacity = node - self.size
        found = self.stacks[capacity].pop()
        if not self.stacks[capacity]:
            self._set(capacity, 0)
        return capacity, found


def best_fit_decreasing(lengths: array, ties: list, window: int) -> tuple[list[int], list[int], int]:
    """Window and offset of each length (1 to ``window``), and the number of windows; equal lengths go by ``ties``."""
    opened, windows, offsets, n = OpenWindows(window), [0] * len(lengths), [0] * len(lengths), 0
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], ties[i])):
        found = opened.tightest(lengths[i])
        if found is None:
            capacity, at, n = window, n, n + 1
        else:
            capacity, at = found
        windows[i], offsets[i] = at, window - capacity
        opened.put(capacity - lengths[i], at)
    return windows, offsets, n


def byte_letters() -> dict[int, int]:
    """The letter that byte-level vocabularies write for each byte: itself where it prints, else the next from 256 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in prints]
    return {b: 256 + n for n, b in enumerate(others)}


_LETTERS = byte_letters()


def spelled(word: bytes) -> str | None:
    """A word of Latin letters (up to U+024F, composed) as the byte-level model reads it, lower case; None for any other word."""
    if word.isalpha():
        return word.lower().decode()
    try:
        text = word.decode()
    except UnicodeDecodeError:
        return None
    if not text or max(text) >= "\u0250" or not text.isalpha() or not is_normalized("NFC", text):
        return None
    text = "".join(map(str.lower, text))
    return text.encode().decode("latin-1").translate(_LETTERS) if text.isalpha() else None


class WordIds(dict):
    """Ids of words, as little-endian unsigned 32-bit numbers; a word that is not there is read by the tokenizer."""

    def __init__(self, tokenizer, older: dict | None = None):
        self.tokenizer, self.spell, self.older = tokenizer, tokenizer.model.tokenize, older or {}

    def __missing__(self, word: bytes) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            if word[-1:] in b".," and spelled(word[:-1]) is not None:  # letters and a mark are read apart
                ids = self[word[:-1]] + self[word[-1:]]
            else:
                letters = spelled(word)
                if letters is None:
                    found = self.tokenizer.encode(word.decode("utf-8", "replace"), add_special_tokens=False).ids
                else:
                    found = [t.id for t in self.spell(letters)]
                ids = array("I", found).tobytes()
        self[word] = ids
        return ids


def word_encoder(path: str) -> Callable[[str], bytes]:
    """Ids of a text as little-endian unsigned 32-bit numbers, by a tokenizer that drops white space and reads word by word.

    Words between ASCII white space are looked up one by one, which gives the ids of the whole text; a round trip test holds it.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on each core already
    from tokenizers import Tokenizer

    known = WordIds(Tokenizer.from_file(path))

    def encode(text: str) -> bytes:
        nonlocal known
        if len(known) > REMEMBERED:
            known.older = {}
            known = WordIds(known.tokenizer, known)
        raw = text.encode("utf-8", "surrogatepass")
        if b"<|" in raw:  # special tokens are told by case, words are not
            words = raw.split()
        elif b"\xcc" in raw or b"\xcd" in raw:
            # Marks that join the letter before them (U+0300 to U+037F): a capital can join where its small letter would, or not.
            words = [w.lower() if w.isascii() else w for w in raw.split()]
        else:
            words = raw.lower().split()
        return b"".join(map(known.__getitem__, words))

    return encode


NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row per piece: its document, place and length there, digest of its ids, window and offset in the window.

    ``with_ids`` adds the piece's ids as an array.  Defined cases: a null or empty text is the end id alone; a null id stays
    null; every row is packed as a document of its own, repeated ones too; equal lengths go by id (null first), then by place in
    the partition; an empty table gives no rows; other columns are not read, so their names cannot clash.
    """
    slim = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    names = NAMES + ["ids"] * with_ids

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = word_encoder(tokenizer_path), array("I", [end_id]).tobytes()
        next_window = TaskContext.get().partitionId() << 33
        rows: list[list] = [[] for _ in names]
        tails: list[list] = [[] for _ in names]
        id_type: pa.DataType = pa.int64()

        def add(to: list[list], doc, start: int, ids: bytes, total: int, sequence: int) -> None:
            # Ids are held for ``with_ids`` only: the names end before them otherwise.
            for column, value in zip(to, (doc, start, len(ids) // 4, zlib.crc32(ids), total, sequence, 0, ids)):
                column.append(value)

        def flush(of: list[list]) -> pa.RecordBatch:
            kinds = [id_type, *[pa.int64()] * 6]
            arrays = [pa.array(c, k) for c, k in zip(of, kinds)]
            if with_ids:
                arrays.append(pa.array([list(array("I", b)) for b in of[7]], pa.list_(pa.int64())))
            for column in of:
                column.clear()
            return pa.RecordBatch.from_arrays(arrays, names)

        def pack_tails() -> pa.RecordBatch:
            nonlocal next_window
            ties = [(doc is not None, doc, i) if doc is not None else (False, 0, i) for i, doc in enumerate(tails[0])]
            windows, tails[6][:], n = best_fit_decreasing(array("I", tails[2]), ties, window)
            tails[5][:] = [next_window + w for w in windows]
            next_window += n
            return flush(tails)

        for batch in batches:
            id_type = batch.schema.field(0).type
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encode(text.as_py() or "") + end
                total = len(ids) // 4
                cut = total - total % window
                for start in range(0, cut, window):
                    add(rows, doc, start, ids[4 * start : 4 * (start + window)], total, next_window)
                    next_window += 1
                if cut < total:
                    add(tails, doc, cut, ids[4 * cut :], total, 0)
                if len(tails[0]) >= GROUP:
                    yield pack_tails()
            if rows[0]:
                yield flush(rows)
        if tails[0]:
            yield pack_tails()

    kind = slim.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, " + ", ".join(f"`{n}` bigint" for n in NAMES[1:]) + (", ids array<bigint>" if with_ids else "")
    return slim.mapInArrow(packed, schema)


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in windows of 2048 tokens."""
    import public_tokenizers

    return pack(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
