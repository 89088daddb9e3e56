"""Exact top-k inner products by dual-tree search over cover trees.

Vectors are dealt by a hash into data blocks of about ``block`` rows and queries into query blocks; a task gets one pair of blocks,
builds a cover tree over each and walks both together.  For a pair of nodes with centres q, p and covering radii r, s no inner
product exceeds <q, p> + |q| s + |p| r + r s; the pair is pruned when that is below the worst kth score of the node's queries.
All children of a node are bounded at once, and the points that are left are scored from the most promising on, in matrix products.

One data block goes first.  Its kth scores, which the kth scores over all rows do not fall below, go with the queries to the
other blocks, so these prune from the start.  Blocks then meet in a rank per query, of which Spark keeps k rows a block before the shuffle.

How it scales: a task holds one block of data and one of queries, both of bounded size, whatever the table's.  With n vectors and
n / 100 queries, queries move n / block times and data n / (100 * queries) times.  The work is the pairs of blocks less what the
trees prune; in 64 dimensions without clusters all distances are alike, a tree is one level of single points, and what is
left to prune is known only from the products themselves.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sieveline.llm.common import read, stored

SCALE = 1024
K = 10
DATA_BLOCK = 4096
QUERY_BLOCK = 4096
LEAF = 16
#: Points that are scored before the bounds of the rest are looked at again.
CHUNK = 512
#: Inner products up to here are exact in double precision.
EXACT = float(1 << 53)
NO_ID = np.iinfo(np.int64).max


class Node:
    """A cover-tree node: its rows, its centre (the first of them) and how far the others are from it.

    ``inner`` are its children that have children, ``pool`` holds those that are leaves, as one node for groups of queries.
    """

    __slots__ = ("rows", "centre", "norm", "radius", "children", "centres", "norms", "radii", "leaves", "sizes", "inner", "pool", "pooled")

    def __init__(self, points: np.ndarray, rows: np.ndarray, radius: float, children: list[Node], pooled: bool = False):
        self.rows, self.radius, self.children, self.pooled = rows, radius, children, pooled
        self.centre = points[rows[0]]
        self.norm = float(np.linalg.norm(self.centre))
        if children:
            self.centres = points[[c.rows[0] for c in children]]
            self.norms = np.array([c.norm for c in children])
            self.radii = np.array([c.radius for c in children])
            self.leaves = np.array([not c.children for c in children])
            self.sizes = np.array([len(c.rows) for c in children])
            self.inner = [c for c in children if c.children]
            leaves = [] if pooled else [c for c in children if not c.children]
            self.pool = Node(points, rows, radius, leaves, pooled=True) if leaves else None

    def nodes(self) -> int:
        return 1 + sum(c.nodes() for c in self.children)


def cover_tree(points: np.ndarray, leaf: int = LEAF) -> Node:
    """A cover tree, top down: centres of a node's children are farther apart than half its scale, and cover it at that distance.

    A node stays a leaf only with ``leaf`` rows or fewer, or where all its rows are one point.
    """

    def build(rows: np.ndarray, away: np.ndarray) -> Node:
        radius = float(away.max())
        if len(rows) <= leaf or radius == 0:
            return Node(points, rows, radius, [])
        cover = 2.0 ** (np.ceil(np.log2(radius)) - 1)
        parts, left, far = [], rows, away
        while len(left):
            near = far <= cover
            parts.append((left[near], far[near]))
            left = left[~near]
            if len(left):
                far = np.linalg.norm(points[left] - points[left[0]], axis=1)
        return Node(points, rows, radius, [build(r, a) for r, a in parts])

    every = np.arange(len(points))
    return build(every, np.linalg.norm(points - points[0], axis=1))


def dual_tree_top_k(
    queries: np.ndarray, query_ids: np.ndarray, data: np.ndarray, data_ids: np.ndarray, k: int,
    copies: np.ndarray | None = None, least: np.ndarray | None = None, seen: Counter | None = None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(query place, data id, copies, score) of each query's ``k`` best data rows; ties go to the smaller id.

    ``copies`` tells how many rows a data row stands for; of the row that equals a query in id and vector one copy is the
    query itself and does not count.  ``least`` bounds the kth scores from below where it is known.  Vectors are whole numbers
    in double precision; beyond 2^53 products are taken over 64-bit integers.  ``seen`` counts node pairs and products.
    """
    seen = Counter() if seen is None else seen
    order = np.argsort(data_ids, kind="stable")
    data, data_ids = data[order], data_ids[order]
    copies = np.ones(len(data), np.int64) if copies is None else copies[order]
    longest = [np.linalg.norm(x, axis=1).max() for x in (queries, data)]
    exact = longest[0] * longest[1] < EXACT
    wide = None if exact else (queries.astype(np.int64), data.astype(np.int64))
    slack = 1 + 1e-9 * longest[0] * longest[1]
    kth = np.full(len(queries), -np.inf) if least is None else least.astype(np.float64)
    own = np.full(len(queries), -1)
    for at, query_id in enumerate(query_ids):
        low, high = np.searchsorted(data_ids, query_id, "left"), np.searchsorted(data_ids, query_id, "right")
        same = np.flatnonzero((data[low:high] == queries[at]).all(axis=1))
        own[at] = low + same[0] if len(same) else -1
    alone = (own >= 0) & (copies[own] == 1)
    none = np.zeros(0, np.int64)
    best: list[tuple[np.ndarray, np.ndarray]] = [(none, none)] * len(queries)

    def bound(q: Node, p: Node) -> float:
        return float(q.centre @ p.centre) + q.norm * p.radius + p.norm * q.radius + q.radius * p.radius + slack

    def score(q: Node, rows: np.ndarray) -> None:
        rows = np.sort(rows)  # in order of id
        seen["products"] += len(q.rows) * len(rows)
        scores = queries[q.rows] @ data[rows].T if exact else wide[0][q.rows] @ wide[1][rows].T
        keep = scores >= kth[q.rows, None]
        keep &= ~(alone[q.rows, None] & (own[q.rows, None] == rows[None, :]))
        for i in np.flatnonzero(keep.any(axis=1)):
            at, found = q.rows[i], np.flatnonzero(keep[i])
            values = np.concatenate([best[at][0], scores[i, found].astype(np.int64)])
            places = np.concatenate([best[at][1], rows[found]])
            first = np.lexsort((places, -values))[:k]
            best[at] = values[first], places[first]
            if len(first) == k:
                kth[at] = max(kth[at], values[first[-1]])

    stack = [(cover_tree(queries), cover_tree(data))]
    while stack:
        q, p = stack.pop()
        seen["pairs"] += 1
        if bound(q, p) < kth[q.rows].min():
            seen["pruned"] += 1
        elif not q.children and not p.children:
            score(q, p.rows)
        elif q.children and (q.radius >= p.radius or p.pooled or not p.children):
            stack += [(c, p) for c in q.children]
        elif q.children:  # the most promising child is taken next
            parts = [*p.inner, *([p.pool] if p.pool else [])]
            stack += [(q, c) for c in sorted(parts, key=lambda c: bound(q, c))]
        else:
            bounds = p.centres @ q.centre + q.norm * p.radii + p.norms * q.radius + q.radius * p.radii + slack
            order = np.argsort(-bounds, kind="stable")
            # The leaves among the children are scored together, the most promising first.
            leaves, at = order[p.leaves[order]], 0
            ends = np.cumsum(p.sizes[leaves])
            seen["pairs"] += len(leaves)
            while at < len(leaves) and bounds[leaves[at]] >= (worst := kth[q.rows].min()):
                done = ends[at - 1] if at else 0
                upto = max(at + 1, int(np.searchsorted(ends, done + CHUNK, "right")))
                some = leaves[at:upto]
                some = some[bounds[some] >= worst]
                score(q, np.concatenate([p.children[c].rows for c in some]))
                at += len(some)
            seen["pruned"] += len(leaves) - at
            stack += [(q, p.children[c]) for c in order[::-1] if not p.leaves[c]]
    sizes = [len(v) for v, _ in best]
    places, scores = (np.concatenate([b[c] for b in best]) if best else none for c in (1, 0))
    asked = np.repeat(np.arange(len(queries)), sizes)
    return asked, data_ids[places], copies[places] - (places == own[asked]), scores


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding",
    data_block: int = DATA_BLOCK, query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query row's ``k`` largest integer inner products over all rows but itself.

    Components become floor(1024 * x).  Defined cases: vectors that are null, empty or hold a null or non-finite component take
    no part; rows that repeat an id are rows of their own, as candidates and as queries, and a query leaves out one row that
    equals it in id and vector; rows without an id take part, behind all ids in a tie; only vectors of equal length meet; ties go to
    the smaller id; a query without any other row, or an empty table, gives no rows; other columns are not read.
    """
    whole = F.transform(F.col("__v"), lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double")).cast("bigint"))

    def usable(df: DataFrame, what: str) -> DataFrame:
        """Distinct (id, vector) with the number of their rows and a key."""
        slim = df.select(F.coalesce(F.col(f"`{id_col}`").cast("bigint"), F.lit(int(NO_ID))).alias("id"), F.col(f"`{vector_col}`").alias("__v"))
        finite = F.forall("__v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
        slim = slim.where((F.size("__v") > 0) & finite).select("id", whole.alias("v"))
        rows = slim.groupBy("id", "v").agg(F.count(F.lit(1)).alias("copies"))
        return stored(rows.withColumn("key", F.monotonically_increasing_id()), what)

    data, asked = usable(vectors, "vectors"), usable(queries, "queries")
    blocks = [max(1, -(-df.count() // size)) for df, size in ((data, data_block), (asked, query_block))]
    place = [F.pmod(F.xxhash64("key"), F.lit(n)).cast("int") for n in blocks]
    data = data.select("id", "v", "copies", F.size("v").alias("d"), place[0].alias("p"))
    asked = asked.select("id", "v", "copies", "key", F.size("v").alias("d"), place[1].alias("q"))
    kind = "key bigint, query_id bigint, times bigint, vec_id bigint, copies bigint, score bigint"
    result = pa.schema([(n, pa.int64()) for n in ("key", "query_id", "times", "vec_id", "copies", "score")])

    def matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        table = table.combine_chunks()
        flat = np.concatenate([c.flatten().to_numpy() for c in table["v"].chunks])
        return table["id"].to_numpy(), flat.reshape(table.num_rows, -1).astype(np.float64), table["copies"].to_numpy()

    def searched(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return result.empty_table()
        (query_ids, q, times), (data_ids, p, copies) = matrix(left), matrix(right)
        at, ids, n, scores = dual_tree_top_k(q, query_ids, p, data_ids, k, copies, left["least"].to_numpy())
        columns = [left["key"].to_numpy()[at], query_ids[at], times[at], ids, n, scores]
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=result)

    keys = ["d", "p", "q"]

    def met(asked: DataFrame, data: DataFrame, first: int, last: int) -> DataFrame:
        """What queries find in the data blocks from ``first`` to ``last``."""
        some = F.explode(F.sequence(F.lit(first), F.lit(last))).alias("p")
        sides = asked.select("*", some), data.where(F.col("p").between(first, last)).select("*", F.explode(F.sequence(F.lit(0), F.lit(blocks[1] - 1))).alias("q"))
        return sides[0].groupBy(*keys).cogroup(sides[1].groupBy(*keys)).applyInArrow(searched, kind)

    found = met(asked.withColumn("least", F.lit(float("-inf"))), data, 0, 0)
    if blocks[0] > 1:
        found = stored(found, "first-block")
        known = found.groupBy("key").agg(F.min("score").alias("low"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= k)
        seeded = asked.join(known.select("key", F.col("low").cast("double").alias("least")), "key", "left").fillna(float("-inf"), ["least"])
        found = found.unionByName(met(seeded, data, 1, blocks[0] - 1))
    each = found.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.least("copies", F.lit(k).cast("long")))))
    best = Window.partitionBy("key").orderBy(F.desc("score"), "vec_id")
    ranked = each.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    asked_again = F.explode(F.sequence(F.lit(1).cast("long"), F.col("times")))
    named = lambda c: F.when(F.col(c) != int(NO_ID), F.col(c)).alias(c)
    return ranked.select(named("query_id"), "rank", named("vec_id"), "score", asked_again.alias("time")).drop("time")


def op5_dual_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten best rows for every hundredth vector, against all."""
    vectors = read(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.where(F.col("vec_id") % 100 == 0))


OP5_SQL = """
WITH v AS (
    SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
    FROM embeddings
    WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
    SELECT q.r, q.vec_id AS query_id, p.vec_id, list_sum(list_transform(list_zip(q.v, p.v), lambda z: z[1] * z[2]))::BIGINT AS score
    FROM v q JOIN v p ON q.r <> p.r AND len(q.v) = len(p.v) WHERE q.vec_id % 100 = 0
)
SELECT query_id, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST)::INTEGER AS rank, vec_id, score
FROM pairs QUALIFY rank <= 10
"""
