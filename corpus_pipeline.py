"""A training corpus from raw documents: quality, line dedup, near-dedup, source mixing, packing.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept, and is written as Parquet in the shared folder and
reread before the next one.  All stages but the last return the columns of ``docs``, whatever these are named beside ``doc_id``,
``text`` and ``source``.  Rows that repeat an id are documents of their own in every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.llm import line_dedup, mixing, packing, quality_knn, simhash
from sieveline.llm.common import free_name, read, stored, word_count

TOKENIZER = "word_bpe_49k.json"
#: The mix goes half way to even sources, so far as no document is drawn more than twice; every document is drawn at least once.
MIX = {"entropy_gain": 0.5, "most_repeats": 2.0, "every": True}


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject.

    Null and empty texts are scored like any other, a missing id is no label; of an empty table nothing is left.
    """
    model = quality_knn.fit(docs, read(spark, sf_dir, "labels"))
    score = free_name(docs.columns, "quality_score")
    scored = quality_knn.with_scores(docs, model, out=score)
    return scored.where(F.col(score) >= quality_knn.THRESHOLD).select(*[F.col(f"`{c}`") for c in docs.columns])


def line_deduped(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, frequent lines left in one of them; ``n_chars``, where there is one, follows the text.

    A null text becomes empty; rows without an id count as one document that comes before all others.
    """
    out = tuple(free_name(docs.columns, name) for name in ("lines_before", "lines_dropped"))
    cut = line_dedup.drop_frequent_lines(docs, out=out)
    if "n_chars" in docs.columns:
        size = F.when(F.col(out[1]) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars").cast("long"))
        cut = cut.withColumn("n_chars", size.cast(docs.schema["n_chars"].dataType))
    return cut.select(*[F.col(f"`{c}`") for c in docs.columns])


def near_deduped(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, by the operator's own shingle length and bit distance.

    Empty texts are copies of each other.  Of rows without an id one of each group stays, beside a named copy.
    """
    return simhash.keep_one_of_each(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, those of rarer sources up to twice, so that sources come nearer to even weights.

    A null source is a source of its own; documents without a word weigh nothing and are drawn once.
    """
    out = tuple(free_name(docs.columns, name) for name in ("mix_tokens", "mix_block", "mix_order", "mix_budget"))
    text = F.coalesce(F.xxhash64("text").cast("string"), F.lit(""))
    drawn = mixing.mix(docs, word_count(F.col("text")), out=out, identity=text, **MIX)
    return drawn.select(*[F.col(f"`{c}`") for c in docs.columns])


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in windows; an empty text is its end id alone, a null id stays null."""
    import public_tokenizers  # only here: the other queries need no tokenizer

    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality", quality),
    ("line_dedup", line_deduped),
    ("near_dedup", near_deduped),
    ("mixing", mixed),
    ("packing", packed),
]

#: SQL cannot express the classifier, the fingerprints or the tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
