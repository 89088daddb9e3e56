"""Near-dedup by SimHash: tiles of fingerprints compared exactly, and components over the links.

Two fingerprints at a Hamming distance of 3 differ by at most 3 in the sum of the differences of their population counts, part by
part.  So a tile holds fingerprints with the same population counts of their four 16-bit quarters (17^4 classes at most), and a pair
of tiles whose counts differ by more than the radius is never formed.  The pairs that are left are compared whole by numpy exclusive-or
and bit counts, which makes the comparison exact.

How it scales: equal fingerprints are one before anything is compared, so a group of copies costs as one text.  Large classes are cut
into tiles of about ``tile`` fingerprints by a hash of them.  Each tile meets 65 classes at most (half the ball of radius 3
around its counts), as arrays of 8 bytes a fingerprint: 0.5 KB moved for each distinct text, whatever their number.  Compared are
some 3 in 100 of all pairs, which still grows with the square: about 4,000 CPU seconds for 12 million distinct fingerprints.  For
billions, ``parts=8`` compares some 6 in 10,000 at 417 classes a tile.  A pair of tiles passes on a spanning forest of its links,
never the links; components come from large-star and small-star rounds on those edges, each written to the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import product
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.llm.common import read, stored

SEED = 42
SHINGLE = 3
RADIUS = 3
PARTS = 4
TILE = 1024
BLOCK = 1 << 16


def fingerprint(text: str | None) -> int:
    """SimHash of a whole text over the XXH64 of its word shingles, as a signed 64-bit number."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= SHINGLE:
        values = np.array([xxh64_intdigest(joined, SEED)], np.uint64)
        return int(values.view(np.int64)[0])
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: -SHINGLE + 1].tolist()
    ends = ends[SHINGLE - 1 :].tolist()
    counts = np.zeros(64, np.int64)
    for at in range(0, len(starts), BLOCK):
        pairs = zip(starts[at : at + BLOCK], ends[at : at + BLOCK])
        values = np.array([xxh64_intdigest(joined[a:b], SEED) for a, b in pairs], "<u8")
        counts += np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(starts), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp) of every row."""
    slim = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = pa.array([fingerprint(t.as_py()) for t in batch.column(1)], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), values], ["doc_id", "fp"])

    return slim.mapInArrow(hashed, f"doc_id {slim.schema['doc_id'].dataType.simpleString()}, fp bigint")


def part_counts(fp: Column, parts: int) -> list[Column]:
    bits = 64 // parts
    mask = (1 << bits) - 1
    return [F.bit_count(F.shiftrightunsigned(fp, bits * k).bitwiseAND(F.lit(mask if parts > 1 else -1).cast("long"))) for k in range(parts)]


def half_ball(parts: int, radius: int) -> list[tuple[int, ...]]:
    """Differences of counts within the radius; of a difference and its opposite only one, and zero."""
    ball = [()]
    for _ in range(parts):
        ball = [(*d, x) for d, x in product(ball, range(-radius, radius + 1)) if sum(map(abs, d)) + abs(x) <= radius]
    return [d for d in ball if d >= (0,) * parts]


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, smallest node of its component) that connect what the links u-v connect."""
    nodes, inverse = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = inverse[: len(u)], inverse[len(u) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    keep = label != np.arange(len(nodes))
    return nodes[keep], nodes[label[keep]]


def tile_links(a: np.ndarray, b: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    near = np.bitwise_count(a.view(np.uint64)[:, None] ^ b.view(np.uint64)[None, :]) <= radius  # signed numbers lose their sign
    i, j = np.nonzero(near)
    return a[i], b[j]


def link_edges(fps: DataFrame, radius: int = RADIUS, parts: int = PARTS, tile: int = TILE) -> DataFrame:
    """Edges (u, v), u > v, that connect what links of at most ``radius`` bits connect.  ``fps``: distinct ``fp``."""
    cells = 64 // parts + 1
    counts = part_counts(F.col("fp"), parts)
    code = sum((c.cast("long") * cells**k for k, c in enumerate(counts)), F.lit(0).cast("long"))
    classed = fps.select("fp", code.alias("class"))
    sizes = stored(classed.groupBy("class").agg(F.count(F.lit(1)).alias("n")), "class-sizes")  # at most cells ** parts rows
    small = F.broadcast(sizes) if cells**parts <= 100_000 else sizes
    chunk = F.pmod(F.xxhash64("fp"), F.ceil(F.col("n") / tile))
    tiles = classed.join(small, "class").withColumn("chunk", chunk).groupBy("class", "chunk")
    tiles = stored(tiles.agg(F.sort_array(F.collect_list("fp")).alias("fps")), "tiles")

    place = [F.expr(f"(class div {cells**k}) % {cells}") for k in range(parts)]
    moves = [
        F.when(
            reduce(and_, [(p + d).between(0, cells - 1) for p, d in zip(place, by)]),
            sum(((p + d) * cells**k for k, (p, d) in enumerate(zip(place, by))), F.lit(0).cast("long")),
        )
        for by in half_ball(parts, radius)
    ]
    meets = sizes.select("class", F.explode(F.array_compact(F.array(*moves))).alias("other"))
    meets = stored(meets.join(sizes.select(F.col("class").alias("other")), "other", "left_semi"), "class-pairs")
    left = tiles.select("class", F.col("chunk").alias("a_chunk"), F.col("fps").alias("a")).join(meets, "class")
    right = tiles.select(F.col("class").alias("other"), F.col("chunk").alias("b_chunk"), F.col("fps").alias("b"))
    pairs = left.join(right, "other").where((F.col("class") != F.col("other")) | (F.col("a_chunk") <= F.col("b_chunk")))

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = []
            for column in (batch.column(0), batch.column(1)):
                sides.append((column.offsets.to_numpy(), column.values.to_numpy()))
            (at, a), (bt, b) = sides
            u, v = [], []
            for k in range(batch.num_rows):
                x, y = tile_links(a[at[k] : at[k + 1]], b[bt[k] : bt[k + 1]], radius)
                apart = x != y
                if apart.any():
                    x, y = forest(x[apart], y[apart])
                    u.append(x)
                    v.append(y)
            if u:
                x, y = forest(np.concatenate(u), np.concatenate(v))
                yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], ["u", "v"])

    return pairs.select("a", "b").mapInArrow(compared, "u bigint, v bigint")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u > v) but the roots; a root is the smallest node of its component.

    Large-star and small-star rounds until the edges no longer change.  A node's smallest neighbour is an aggregate that is
    joined back, so a node with very many neighbours is a skewed join, which Spark splits, and never a group in one task.
    """

    def starred(of: DataFrame) -> DataFrame:
        least = of.groupBy("u").agg(F.min("v").alias("m"))
        return of.join(least, "u").select("u", "v", F.least("u", "m").alias("m"))

    def proper(of: DataFrame) -> DataFrame:
        return of.where("u <> v").distinct()

    def digest(of: DataFrame) -> tuple:
        return tuple(of.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    edges = stored(proper(edges), "edges")
    before, now = None, digest(edges)
    while now != before and now[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = starred(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(proper(large), "edges")
        small = starred(large)
        small = small.select("v", "m").unionByName(small.select(F.col("u").alias("v"), "m"))
        edges = stored(proper(small.select(F.col("v").alias("u"), F.col("m").alias("v"))), "edges")
        before, now = now, digest(edges)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def rooted(fps: DataFrame, radius: int = RADIUS, parts: int = PARTS, tile: int = TILE) -> DataFrame:
    """``fps`` (distinct ``fp``, other columns) with the ``root`` of each fingerprint's component."""
    if not 0 <= radius < 64 or 64 % parts:
        raise ValueError("radius lies between 0 and 63, parts divides 64")
    fps = stored(fps, "distinct-fingerprints")
    linked = components(link_edges(fps, radius, parts, tile))
    labelled = fps.join(linked.withColumnRenamed("node", "fp"), "fp", "left")
    return stored(labelled.select(*fps.columns, F.coalesce("root", "fp").alias("root")), "labels")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS, parts: int = PARTS, tile: int = TILE) -> DataFrame:
    """(doc_id, fp, component_id) of every row: the smallest id that links of at most ``radius`` bits reach.

    Defined cases: a null or empty text has fingerprint zero, which links like any other; a null id stays null and is smallest of
    a component only where it has no other (``component_id`` is null then); repeated rows give repeated rows; an empty table
    gives none; other columns are not read, so their names cannot clash.
    """
    rows = stored(fingerprints(docs, id_col, text_col), "fingerprints")
    labelled = rooted(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), radius, parts, tile)
    ids = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    return rows.join(labelled.select("fp", "root").join(ids, "root").select("fp", "component_id"), "fp").select(
        "doc_id", "fp", "component_id"
    )


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how: int) -> DataFrame:
    """``docs`` with one document of each component: the row with the smallest id, of several such the shortest text (ties by its hash).

    Components are of texts, not of ids: an id with texts in several components may stay in each of them.  A row without an id
    cannot be held against named ones and is no copy of them; of the rows of a component that have no id one stays too.  Of rows that
    agree in id and text the one with the smallest hash of all its columns stays.  All columns stay, whatever their names.
    """
    doc_id, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    key = F.struct(doc_id.alias("doc_id"), F.length(text).alias("size"), F.xxhash64(text).alias("hash"))
    rows = stored(fingerprints(docs.select(key.alias("key"), text.alias("text")), "key", "text").withColumnRenamed("doc_id", "key"), "fingerprints")
    named = F.col("key.doc_id").isNotNull()
    least = [F.min(F.when(named, F.col("key"))).alias("named"), F.min(F.when(~named, F.col("key"))).alias("nameless")]
    labelled = rooted(rows.groupBy("fp").agg(*least), **how)
    keepers = labelled.groupBy("root").agg(F.min("named").alias("named"), F.min("nameless").alias("nameless"))
    keepers = keepers.select(F.explode(F.array_compact(F.array("named", "nameless"))).alias("k"))
    keepers = keepers.select(F.col("k.doc_id").alias("id"), F.col("k.size").alias("size"), F.col("k.hash").alias("hash"))
    # The row travels as one column, so that its names meet none of the others.
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    keyed = docs.select(whole.alias("row"), doc_id.alias("id"), F.length(text).alias("size"), F.xxhash64(text).alias("hash"))
    same = F.col("d.hash") == F.col("k.hash")
    for name in ("id", "size"):
        same = same & F.col(f"d.{name}").eqNullSafe(F.col(f"k.{name}"))
    found = keyed.alias("d").join(keepers.alias("k"), same, "left_semi")
    one = found.groupBy("id", "size", "hash").agg(F.min_by("row", F.xxhash64("row")).alias("row"))
    return one.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def op4_tiled_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
