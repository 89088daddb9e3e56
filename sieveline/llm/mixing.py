"""Mixing sources to target weights by temperature, in DataFrame functions only.

Each source's share of all tokens is raised to an exponent between 0 (all sources alike) and 1 (as they are).  The exponent is
the smallest one at which the mix is no more even than the target entropy and repeats no source beyond the repetition limit;
both fall as the exponent grows, so it is found by bisection.  Normalised weights split the token budget.  A source then
gives whole permutations of its documents, block by block, and of its last block the documents that start within what is left.
Where every document is to be drawn, the budget is the smallest at which the weights draw the most frequent source once.

How it scales: the bisection reads a table of one row per source, 31 midpoints (five halvings) in one aggregate, so twenty
halvings are four small jobs.  Where a document starts in the last permutation is a prefix sum over three levels of its
permutation key: 256 first digits per source, 256 second digits per first one, and the rows of one (source, digit, digit).  A
source with 10^10 documents has some 150,000 rows at the third level; no window holds a whole source.  Rows move once, dealt by
source and digits, so that a source with a third of all rows is spread over 65,536 keys.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sieveline.llm.common import read, stored, word_count

HALVINGS = 5
PASSES = 4
DIGIT_BITS = 8
KEY_BITS = 60


def permutation_key(identity: Column, block: Column, seed: int) -> Column:
    """First 60 bits of a digest of seed, block and what tells rows apart: ascending order is the block's permutation."""
    text = F.concat_ws("|", F.lit(str(seed)), block, identity)
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, KEY_BITS // 4), 16, 10).cast("long")


def smallest_exponent(shares: DataFrame, target_entropy: float | None, most_repeats: float | None, repeats_at: Callable[[float, float], float]) -> float:
    """Bisects [0, 1] for the smallest exponent that meets the targets; 1 if none below does.  ``shares``: one ``share`` per source.

    ``repeats_at`` tells from an exponent and its sum of powers how often the rarest source is drawn.
    """

    def meets(exponent: float, powers: float, logs: float) -> bool:
        entropy = math.log(powers) - exponent * logs / powers
        repeats = repeats_at(exponent, powers)
        return (target_entropy is None or entropy <= target_entropy + 1e-12) and (
            most_repeats is None or repeats <= most_repeats + 1e-12
        )

    low, high, cells = 0.0, 1.0, 2**HALVINGS
    for at in range(PASSES):
        grid = [low + (high - low) * k / cells for k in range(cells)]
        power = [F.pow(F.col("share"), F.lit(a)) for a in grid]
        sums = shares.agg(*[F.sum(p) for p in power], *[F.sum(p * F.log("share")) for p in power]).first()
        met = [meets(a, sums[k], sums[cells + k]) for k, a in enumerate(grid)]
        if at == 0 and met[0]:
            return 0.0
        below, above = 0, cells
        while above - below > 1:
            middle = (below + above) // 2
            below, above = (below, middle) if met[middle] else (middle, above)
        low, high = low + (high - low) * below / cells, low + (high - low) * above / cells
    return high


def source_weights(
    totals: DataFrame, target_entropy: float | None, entropy_gain: float | None, most_repeats: float | None, budget_share: float,
    fill: bool = False, every: bool = False,
) -> DataFrame:
    """Weight and token budget of every source of ``totals`` (source, tokens > 0).

    ``target_entropy`` is in nats; ``entropy_gain`` instead puts it that far between the entropy as it is and the largest.  With
    ``fill`` the budget rises from ``budget_share`` to the largest, of all tokens at most, at which the chosen weights draw no source
    more than ``most_repeats`` times.  With ``every`` the budget, whatever its share, draws the source of most tokens exactly once
    and so every other at least once.
    """
    whole = totals.agg(F.sum("tokens"), F.min("tokens"), F.max("tokens"), F.count(F.lit(1))).first()
    tokens, least, most, sources = whole[0] or 0, whole[1] or 0, whole[2] or 0, whole[3]
    shares = totals.withColumn("share", F.col("tokens") / F.lit(float(tokens or 1)))

    def repeats_at(exponent: float, powers: float) -> float:
        if every:
            return (least / most) ** (exponent - 1)
        return budget_share * (least / tokens) ** (exponent - 1) / powers

    exponent = 1.0
    if sources > 1:
        if entropy_gain is not None:
            now = -shares.agg(F.sum(F.col("share") * F.log("share"))).first()[0]
            target_entropy = now + entropy_gain * (math.log(sources) - now)
        if target_entropy is not None or most_repeats is not None:
            exponent = smallest_exponent(shares, target_entropy, most_repeats, repeats_at)
    power = F.pow(F.col("share"), F.lit(exponent))
    normal, room = shares.agg(F.sum(power), F.min(F.col("tokens") / power)).first()
    normal = normal or 1.0
    weight = power / F.lit(normal)
    whole_budget = budget_share * tokens
    if fill and most_repeats is not None and room is not None:
        whole_budget = max(whole_budget, min(float(tokens), most_repeats * room * normal))
    budget = F.round(weight * F.lit(whole_budget)).cast("long")
    if every:
        times = F.pow(F.col("tokens") / F.lit(float(most or 1)), F.lit(exponent - 1))
        budget = F.greatest(F.col("tokens"), F.round(F.col("tokens") * times).cast("long"))
    return shares.select("source", "tokens", weight.alias("weight"), budget.alias("budget"))


def mix(
    docs: DataFrame,
    tokens: Column,
    id_col: str = "doc_id",
    source_col: str = "source",
    target_entropy: float | None = None,
    entropy_gain: float | None = None,
    most_repeats: float | None = None,
    budget_share: float = 1.0,
    seed: int = 7,
    out: tuple[str, str, str, str] = ("mix_tokens", "mix_block", "mix_order", "mix_budget"),
    fill: bool = False,
    every: bool = False,
    identity: Column | None = None,
) -> DataFrame:
    """Rows of ``docs`` drawn to the target weights, once for each block that draws them.

    All columns of ``docs`` stay, whatever their names (a column named as one of ``out`` is replaced); ``out`` names the token count,
    the block (from 0), the place in the block's order and the source's budget.  ``fill`` and ``every``: as in ``source_weights``.
    Rows are permuted by id and ``identity``, a text that tells rows of one id apart.  Defined cases: a null source is a source
    of its own; null ids permute by ``identity``, without it as one id; rows without tokens are never drawn, with ``every`` once; repeated
    rows are drawn as rows of their own, ties in the order by a hash of the whole row; where ``most_repeats`` cannot be met (it is under
    ``budget_share``) shares stay as they are; an empty table gives no rows, nor does one without any token unless ``every`` is set.
    """
    kept = [c for c in docs.columns if c not in out]
    n = F.coalesce(tokens, F.lit(0)).cast("long")
    told = F.concat_ws("|", F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("null")), *([] if identity is None else [identity]))
    source = F.coalesce(F.concat(F.lit("="), F.col(f"`{source_col}`").cast("string")), F.lit(""))
    # The row travels as one column, so that its names meet none of the others.
    whole = F.struct(*[F.col(f"`{c}`") for c in kept])
    keyed = docs.select(whole.alias("row"), n.alias("tokens"), source.alias("source"), told.alias("told"))
    keyed = keyed.withColumn("key", permutation_key(F.col("told"), F.lit("last"), seed))
    digit = [F.shiftright("key", KEY_BITS - DIGIT_BITS * (k + 1)).bitwiseAND(2**DIGIT_BITS - 1).cast("int") for k in (0, 1)]
    keyed = keyed.withColumns({"d1": digit[0], "d2": digit[1]})
    cell = ["source", "d1", "d2"]
    sums = stored(keyed.groupBy(*cell).agg(F.sum("tokens").alias("sum")), "digit-sums")
    totals = sums.groupBy("source").agg(F.sum("sum").alias("tokens")).where("tokens > 0")
    totals = stored(totals, "source-totals")
    weights = source_weights(totals, target_entropy, entropy_gain, most_repeats, budget_share, fill, every)

    def before(total: str, over: list[str], order: str) -> Column:
        frame = Window.partitionBy(*over).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(total).over(frame), F.lit(0))

    first = sums.groupBy("source", "d1").agg(F.sum("sum").alias("sum1"))
    first = first.withColumn("before1", before("sum1", ["source"], "d1")).drop("sum1")
    first = first.join(weights.withColumnsRenamed({"tokens": "total"}), "source")
    second = sums.withColumn("before2", before("sum", ["source", "d1"], "d2"))
    offsets = second.join(first, ["source", "d1"]).select(*cell, "total", "budget", (F.col("before1") + F.col("before2")).alias("before"))

    within = Window.partitionBy(*cell).orderBy("key", F.xxhash64("row")).rowsBetween(Window.unboundedPreceding, -1)
    placed = keyed.join(offsets, cell, "left" if every else "inner").withColumn(
        "before", F.col("before") + F.coalesce(F.sum("tokens").over(within), F.lit(0))
    )
    blocks = F.coalesce(F.expr("budget div total"), F.lit(0).cast("long"))
    last = F.col("before") < F.expr("budget % total")
    drawn = F.when(F.col("tokens") > 0, blocks + F.when(last, 1).otherwise(0)).otherwise(F.lit(int(every)).cast("long"))
    rows = placed.withColumns({"blocks": blocks, "drawn": drawn}).where(F.col("drawn") > 0)
    rows = rows.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("drawn") - 1)))
    order = F.when(F.col("block") == F.col("blocks"), F.col("key")).otherwise(permutation_key(F.col("told"), F.col("block").cast("string"), seed))
    new = [F.col("tokens"), F.col("block"), order, F.coalesce("budget", F.lit(0).cast("long"))]
    return rows.select(*[F.col(f"row.`{c}`").alias(c) for c in kept], *[c.alias(n) for c, n in zip(new, out)])


def op1_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every draw of the whole ``documents`` table: half way to even sources, no document more than twice."""
    docs = read(spark, sf_dir, "documents")
    slim = stored(docs.select("doc_id", "source", word_count(F.col("text")).alias("n_tokens")), "token-counts")  # texts are read once
    drawn = mix(slim, F.col("n_tokens"), entropy_gain=0.5, most_repeats=2.0, budget_share=1.0, identity=F.col("n_tokens").cast("string"))
    return drawn.select(
        "doc_id", "source", "n_tokens", F.col("mix_block").alias("block"), F.col("mix_order").alias("order_key"),
        F.col("mix_budget").alias("source_budget"),
    )


OP1_SQL = r"""
WITH RECURSIVE docs AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS n_tokens FROM documents
), totals AS (
    SELECT source, sum(n_tokens)::BIGINT AS tokens FROM docs GROUP BY source HAVING sum(n_tokens) > 0
), shares AS (
    SELECT list(tokens / (SELECT sum(tokens) FROM totals)::DOUBLE ORDER BY source) AS p FROM totals
), target AS (
    SELECT p, -list_sum(list_transform(p, lambda x: x * ln(x))) AS now, list_min(p) AS least FROM shares
), halved(i, low, high) AS (
    SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE
    UNION ALL
    SELECT i + 1, CASE WHEN good THEN low ELSE middle END, CASE WHEN good THEN middle ELSE high END
    FROM (
        SELECT i, low, high, (low + high) / 2 AS middle,
               ln(z) - (low + high) / 2 * s / z <= now + 0.5 * (ln(len(p)) - now) + 1e-12
               AND pow(least, (low + high) / 2 - 1) / z <= 2.0 + 1e-12 AS good
        FROM (
            SELECT i, low, high, p, now, least,
                   list_sum(list_transform(p, lambda x: pow(x, (low + high) / 2))) AS z,
                   list_sum(list_transform(p, lambda x: pow(x, (low + high) / 2) * ln(x))) AS s
            FROM halved, target WHERE i < 20
        )
    )
), chosen AS (
    SELECT CASE WHEN len(p) = 1 THEN 1.0
                WHEN -ln(1.0 / len(p)) <= now + 0.5 * (ln(len(p)) - now) + 1e-12 AND pow(least, -1) / len(p) <= 2.0 + 1e-12 THEN 0.0
                ELSE (SELECT high FROM halved WHERE i = 20) END AS a, p
    FROM target
), budgets AS (
    SELECT source, tokens,
           round(pow(tokens / (SELECT sum(tokens) FROM totals)::DOUBLE, a) / list_sum(list_transform(p, lambda x: pow(x, a)))
                 * (SELECT sum(tokens) FROM totals))::BIGINT AS budget
    FROM totals, chosen
), placed AS (
    SELECT d.doc_id, d.source, d.n_tokens, b.budget, b.budget // b.tokens AS blocks, b.budget % b.tokens AS rest, k.key,
           coalesce(sum(d.n_tokens) OVER (PARTITION BY d.source ORDER BY k.key, d.n_tokens
                                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM docs d
    JOIN budgets b ON d.source IS NOT DISTINCT FROM b.source,
    LATERAL (SELECT ('0x' || md5('7|last|' || coalesce(d.doc_id::VARCHAR, 'null') || '|' || d.n_tokens)[1:15])::BIGINT AS key) k
)
SELECT doc_id, source, n_tokens, block::BIGINT AS block,
       CASE WHEN block = blocks THEN key ELSE ('0x' || md5('7|' || block || '|' || coalesce(doc_id::VARCHAR, 'null') || '|' || n_tokens)[1:15])::BIGINT END AS order_key,
       budget AS source_budget
FROM (SELECT *, unnest(range(blocks + CASE WHEN before < rest THEN 1 ELSE 0 END)) AS block FROM placed WHERE n_tokens > 0)
"""
