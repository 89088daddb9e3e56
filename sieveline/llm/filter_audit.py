"""How filters overlap: what every order of them keeps, removes and costs, by part of a table.

Each text is judged by five filters: four read the text alone, the fifth asks for an equal text under a smaller id.

A counting Bloom sketch over hashes of all texts goes first: tasks count slots, counts are added slot by slot, and a text with a slot
that nobody else counted is certainly unique.  Only the other texts are shuffled, whole, for the smallest id of each.  The failure
bits then meet in counts by (part, mask), at most 32 a part, from which all 120 orders are worked out without reading a row again.

The merged sketch is broadcast.  It grows with the rows up to ``MAX_SLOTS`` bits (64 MB); beyond some 10^8 rows it fills up, unique
texts pass as possible repeats more often, and the cost nears that of grouping all texts.  The result stays the same.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.llm.common import read, stored
from sieveline.operators.lookup import attach_by_frequency

FILTERS = "ABCDE"
BITS = {letter: 1 << at for at, letter in enumerate(FILTERS)}
SLOTS_A_ROW = 16
MAX_SLOTS = 1 << 29
SEGMENT = 1 << 16
PROBES = 3

_CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_MARKS = re.compile(r"[#$%&*|]")
MEASURES = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def text_mask(text: str) -> int:
    """Bits of the filters A to D that a text fails."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    capitals = len(raw) - len(raw.translate(None, _CAPITALS))
    mask = BITS["A"] if len(words) < 50 else 0
    mask |= BITS["B"] if 100 * len(set(words)) < 65 * len(words) else 0
    mask |= BITS["C"] if 100 * capitals > 5 * len(text) else 0
    return mask | (BITS["D"] if _MARKS.search(text) else 0)


def slots_of(hashes: np.ndarray, slots: int) -> np.ndarray:
    """(texts, ``PROBES``) places in the sketch, each from a hash that is mixed anew."""
    places = []
    for probe in range(1, PROBES + 1):
        x = hashes.astype(np.uint64) + np.uint64(probe * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        places.append((x ^ (x >> np.uint64(31))) % np.uint64(slots))
    return np.stack(places, axis=1).astype(np.int64)


def repeat_sketch(hashes: DataFrame, slots: int) -> DataFrame:
    """(segment, ``bits``): which slots of the merged counting sketch hold two texts or more; ``hashes`` has one long column."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            places, counts = np.unique(slots_of(batch.column(0).to_numpy(), slots), return_counts=True)
            segments, starts = np.unique(places // SEGMENT, return_index=True)
            ends = [*starts[1:], len(places)]
            low, few = (places % SEGMENT).astype("<u2"), np.minimum(counts, 2).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(segments),
                    pa.array([low[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()),
                    pa.array([few[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()),
                ],
                ["segment", "places", "counts"],
            )

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, sums = None, np.zeros(SEGMENT, np.uint8)

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([np.packbits(sums > 1).tobytes()])], ["segment", "bits"])

        for batch in batches:
            for segment, places, counts in zip(*(column.to_pylist() for column in batch.columns)):
                if segment != at:
                    if at is not None and (sums > 1).any():
                        yield row()
                    at = segment
                    sums[:] = 0
                where = np.frombuffer(places, "<u2")
                sums[where] = np.minimum(sums[where] + np.frombuffer(counts, np.uint8), 2)
        if at is not None and (sums > 1).any():
            yield row()

    partial = hashes.mapInArrow(counted, "segment bigint, places binary, counts binary")
    return partial.repartition("segment").sortWithinPartitions("segment").mapInArrow(merged, "segment bigint, bits binary")


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """(doc_id, part, mask, digest, text) of every row, stored; mask has the bits of A to D.

    ``text`` and its SHA-256 ``digest`` are there only where an equal text may stand in another row.
    """
    spark = docs.sparkSession
    whole = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    slim = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part"),
        whole.alias("text"), F.xxhash64(whole).alias("hash"),
    )
    slots = min(MAX_SLOTS, max(SEGMENT, SLOTS_A_ROW * slim.count()))
    bits = np.zeros(-(-slots // SEGMENT) * SEGMENT // 8, np.uint8)
    for segment, packed in repeat_sketch(slim.select("hash"), slots).toLocalIterator():  # MAX_SLOTS bits at most
        bits[segment * SEGMENT // 8 : (segment + 1) * SEGMENT // 8] = np.frombuffer(packed, np.uint8)
    sketch = spark.sparkContext.broadcast(bits.tobytes())

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repeats = np.frombuffer(sketch.value, np.uint8)
        for batch in batches:
            places = slots_of(batch.column(3).to_numpy(), slots)
            maybe = (repeats[places >> 3] >> (7 - (places & 7)) & 1).all(axis=1)
            masks, digests, texts = [], [], []
            for text, again in zip(batch.column(2).to_pylist(), maybe):
                masks.append(text_mask(text))
                digests.append(hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest() if again else None)
                texts.append(text if again else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(masks, pa.int32()), pa.array(digests, pa.string()), pa.array(texts, pa.string())],
                ["doc_id", "part", "mask", "digest", "text"],
            )

    kind = slim.schema["doc_id"].dataType.simpleString()
    return stored(slim.mapInArrow(judge, f"doc_id {kind}, part string, mask int, digest string, text string"), "judged")


def mask_counts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """(part, mask, n, good, toxic): rows of each set of failed filters, and those of them labelled good or toxic.

    Defined cases: a null text counts as empty, a null part as the empty string; an id that has several labels is good or toxic if one
    of them says so, other values than 1 count as 0; a row without an id has no label, never fails E and makes no other row fail it;
    equal texts under one id fail E only for a smaller id, so repeated rows do not fail each other; an empty table gives no rows;
    columns beside id, text and part are not read.
    """
    rows = judged(docs, id_col, text_col, part_col)
    alone, maybe = rows.where(F.col("digest").isNull()), rows.where(F.col("digest").isNotNull())
    least = maybe.groupBy("text").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)
    least = stored(least.select(F.sha2(F.col("text").cast("binary"), 256).alias("digest"), "first_id", "copies"), "least")
    met = attach_by_frequency(maybe.select("doc_id", "part", "mask", "digest"), least, "digest", "copies")
    repeated = F.when(F.col("doc_id") > F.col("first_id"), F.lit(BITS["E"])).otherwise(F.lit(0))
    flagged = alone.select("doc_id", "part", "mask").unionByName(met.select("doc_id", "part", F.col("mask").bitwiseOR(repeated).alias("mask")))
    # Counting per id first leaves a few rows of an id that many rows share, or of the missing one.
    counted = flagged.groupBy("doc_id", "part", "mask").agg(F.count(F.lit(1)).alias("rows"))
    known = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        *[F.max(F.when(F.col(c) == 1, 1).otherwise(0)).cast("bigint").alias(c) for c in ("quality", "toxic")]
    )
    told = counted.join(known, "doc_id", "left")
    share = lambda c: F.sum(F.col("rows") * F.coalesce(F.col(c), F.lit(0)))
    return told.groupBy("part", "mask").agg(F.sum("rows").alias("n"), share("quality").alias("good"), share("toxic").alias("toxic"))


def order_table(counts: np.ndarray) -> list[tuple]:
    """Rows (order, step, filter, measures) of one part from (mask, [n, good, toxic]) sums, for every order of the filters."""
    masks = np.arange(len(counts))
    n, rows, shares = counts[:, 0], [], dict.fromkeys(FILTERS, 0)
    for order in permutations(FILTERS):
        before = 0
        for step, letter in enumerate(order, 1):
            bit = BITS[letter]
            fails = masks & bit > 0
            here = fails & (masks & before == 0)
            removed, good, toxic = (int(x) for x in counts[here].sum(axis=0))
            before |= bit
            kept = int(n[masks & before == 0].sum())
            shares[letter] += removed
            rows.append(("".join(order), step, letter, kept, removed, int(n[fails].sum()) - removed, int(n[bit]), good, toxic))
    return [(*row, shares[row[2]]) for row in rows]


def interactions(counts: DataFrame) -> DataFrame:
    """What each filter does at each step of each order, by part, from :func:`mask_counts`."""
    gathered = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))  # 32 at most

    def expanded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, masks in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sums = np.zeros((1 << len(FILTERS), 3), np.int64)
                for m in masks:
                    sums[m["mask"]] += (m["n"], m["good"], m["toxic"])
                columns = list(zip(*order_table(sums)))
                kinds = [pa.string(), pa.int32(), pa.string(), *[pa.int64()] * len(MEASURES)]
                arrays = [pa.array([part] * len(columns[0])), *[pa.array(c, k) for c, k in zip(columns, kinds)]]
                yield pa.RecordBatch.from_arrays(arrays, ["part", "filter_order", "step", "filter", *MEASURES])

    return gathered.mapInArrow(expanded, "part string, filter_order string, step int, filter string, " + ", ".join(f"{m} bigint" for m in MEASURES))


def op11_bloom_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders of the five filters over every source of the documents."""
    return interactions(mask_counts(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")))


OP11_SQL = r"""
WITH d AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
           min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first_id
    FROM documents
), l AS (
    SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS quality, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
    FROM labels GROUP BY doc_id
), m AS (
    SELECT part, coalesce(quality, 0) AS quality, coalesce(toxic, 0) AS toxic,
           CASE WHEN len(words) < 50 THEN 1 ELSE 0 END
         + CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 2 ELSE 0 END
         + CASE WHEN 100 * len(regexp_extract_all(text, '[A-Z]')) > 5 * length(text) THEN 4 ELSE 0 END
         + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
         + CASE WHEN d.doc_id > first_id THEN 16 ELSE 0 END AS mask
    FROM d LEFT JOIN l ON d.doc_id = l.doc_id
), c AS (
    SELECT part, mask, count(*) AS n, sum(quality) AS good, sum(toxic) AS toxic FROM m GROUP BY part, mask
), f(letter, bit) AS (
    VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)
), o AS (
    SELECT a.letter || b.letter || x.letter || y.letter || z.letter AS filter_order,
           [a.bit, b.bit, x.bit, y.bit, z.bit] AS bits
    FROM f a, f b, f x, f y, f z
    WHERE a.bit + b.bit + x.bit + y.bit + z.bit = 31 AND (a.bit | b.bit | x.bit | y.bit | z.bit) = 31
), s AS (
    SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS before
    FROM o, range(1, 6) t(step)
), r AS (
    SELECT part, filter_order, step, bit,
           sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END) AS kept,
           sum(CASE WHEN mask & before = 0 AND mask & bit > 0 THEN n ELSE 0 END) AS removed,
           sum(CASE WHEN mask & before > 0 AND mask & bit > 0 THEN n ELSE 0 END) AS redundant,
           sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
           sum(CASE WHEN mask & before = 0 AND mask & bit > 0 THEN good ELSE 0 END) AS good_lost,
           sum(CASE WHEN mask & before = 0 AND mask & bit > 0 THEN toxic ELSE 0 END) AS toxic_lost
    FROM c, s GROUP BY part, filter_order, step, bit
)
SELECT part, filter_order, step::INT AS step, substr(filter_order, step::INT, 1) AS filter, kept::BIGINT AS kept, removed::BIGINT AS removed,
       redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
       toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM r
"""
