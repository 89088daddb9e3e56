"""Quality rules as a bitmask ledger.

``ledger`` evaluates every rule once and keeps a failure bit for each beside what it measured.  A policy is a named, versioned
set of bits; ``apply_policy`` and ``ablations`` work on bits alone, so a changed policy never reads a text again.  Ablations
count rows by their bits first, which leaves at most 2^rules rows for any size of the ledger.

The ledger is one pass without a shuffle: a text is measured inside its Arrow batch, and nothing is kept between texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.llm.common import read

SYMBOLS = b"#*$%&|<>"
WINDOW = 5

#: Rule, and when it fails, in integers over the measurements; the rule's bit is its place here.
RULES = {
    "too_few_words": "n_words < 10",
    "repeated_windows": "100 * n_repeat_words > 20 * n_words",
    "symbols_per_word": "100 * n_symbols > 30 * n_words",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 20 * n_words",
    "repeated_lines": "100 * n_dup_lines > 60 * n_lines",
    "capitals": "100 * n_capitals > 60 * word_chars",
    "exclamations": "100 * n_exclamations > 50 * n_words",
}
BITS = {rule: 1 << at for at, rule in enumerate(RULES)}
BASE = BITS["too_few_words"] | BITS["repeated_windows"]

#: Policies by version: the bits that reject a document.  A version is never changed, a new one is added.
POLICIES = {
    "base": BASE,
    "2024-1": BASE | BITS["symbols_per_word"] | BITS["long_words"],
    "2024-2": (1 << len(RULES)) - 1,
}

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_exclamations"]


def repeated_window_words(words: list[bytes]) -> int:
    """Words that lie in a five-word window found twice or more; windows are compared as exact word sequences."""
    if len(words) <= WINDOW:
        return 0
    ids: dict[bytes, int] = {}
    a = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    pairs = np.unique(a[:-1] * len(ids) + a[1:], return_inverse=True)[1]
    fours = np.unique(pairs[:-2] * (pairs.max() + 1) + pairs[2:], return_inverse=True)[1]
    _, inverse, counts = np.unique(fours[:-1] * len(ids) + a[4:], return_inverse=True, return_counts=True)
    twice = counts[inverse] > 1
    if not twice.any():
        return 0
    edges = np.zeros(len(words) + 1, np.int64)
    edges[: len(twice)] += twice
    edges[WINDOW : WINDOW + len(twice)] -= twice
    return int((np.cumsum(edges) > 0).sum())


def measure(text: str | None) -> tuple[int, ...]:
    """``MEASURES`` of a whole text; ``n_lines`` counts lines with a word, ``n_capitals`` the letters A-Z."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    joined = b"".join(words)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return (
        len(words),
        len(text or "") - (len(raw) - len(joined)),
        len(raw) - len(raw.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_window_words(words),
        len(lines),
        len(joined) - len(joined.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")),
        sum(w.endswith(b"!!") for w in words),
    )


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, measurements, ``failed_bits``) of every row.

    Defined cases: a null or empty text has no words and fails ``too_few_words``; a null id stays null; repeated rows give
    repeated rows; an empty table gives none; other columns are not read, so their names cannot clash.
    """
    slim = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [measure(t.as_py()) for t in batch.column(1)]
            columns = list(zip(*rows)) or [()] * len(MEASURES)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, pa.int64()) for c in columns]], ["doc_id", *MEASURES])

    kind = slim.schema["doc_id"].dataType.simpleString()
    rows = slim.mapInArrow(measured, f"doc_id {kind}, " + ", ".join(f"{m} bigint" for m in MEASURES))
    bits = [F.when(F.expr(fails), F.lit(BITS[rule])).otherwise(F.lit(0)) for rule, fails in RULES.items()]
    failed = bits[0]
    for bit in bits[1:]:
        failed = failed.bitwiseOR(bit)
    return rows.withColumn("failed_bits", failed.cast("bigint"))


def apply_policy(ledger_rows: DataFrame, policy: int, out: str = "kept") -> DataFrame:
    return ledger_rows.withColumn(out, F.col("failed_bits").bitwiseAND(policy) == 0)


def ablations(ledger_rows: DataFrame, policy: int) -> DataFrame:
    """For each rule of a policy: rows it fails, rows that it alone rejects, and rows kept without it."""
    rules = [(rule, bit) for rule, bit in BITS.items() if policy & bit]
    counted = ledger_rows.groupBy("failed_bits").agg(F.count(F.lit(1)).alias("n"))
    each = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(b).cast("bigint").alias("bit")) for r, b in rules]))
    failed = F.col("failed_bits").bitwiseAND(policy)
    pairs = counted.select("n", failed.alias("failed"), each.alias("r")).select("n", "failed", "r.rule", "r.bit")
    has = F.col("failed").bitwiseAND(F.col("bit")) != 0
    others = F.col("failed").bitwiseAND(F.bitwise_not("bit"))
    number = lambda when: F.coalesce(F.sum(F.when(when, F.col("n"))), F.lit(0)).alias
    return pairs.groupBy("rule").agg(
        number(has)("n_failed"), number(has & (others == 0))("n_only_this"), number(others == 0)("n_kept_without")
    )


def op3_bitmask_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger of every document under the newest policy."""
    rows = apply_policy(ledger(read(spark, sf_dir, "documents")), POLICIES["2024-2"])
    return rows.withColumn("base_failed", F.col("failed_bits").bitwiseAND(BASE) != 0).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "failed_bits",
        "n_lines", "n_capitals", "n_exclamations",
    )


OP3_SQL = r"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM documents
), windows AS (
    SELECT r, i, words[i:i + 4] AS w FROM (SELECT r, words, unnest(range(1, len(words) - 3)) AS i FROM d)
), twice AS (
    SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, w) AS n FROM windows) WHERE n > 1
), covered AS (
    SELECT r, count(DISTINCT i + k) AS n_repeat_words FROM twice, range(5) t(k) GROUP BY r
), m AS (
    SELECT doc_id, len(words) AS n_words,
           length(text) - len(regexp_extract_all(text, '[\x20\x09-\x0D]')) AS word_chars,
           len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
           len(lines) - len(list_distinct(lines)) AS n_dup_lines,
           coalesce(n_repeat_words, 0) AS n_repeat_words,
           len(lines) AS n_lines,
           len(regexp_extract_all(text, '[A-Z]')) AS n_capitals,
           len(list_filter(words, lambda x: ends_with(x, '!!'))) AS n_exclamations
    FROM d LEFT JOIN covered USING (r)
), f AS (
    SELECT *, CASE WHEN n_words < 10 THEN 1 ELSE 0 END
            + CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END
            + CASE WHEN 100 * n_symbols > 30 * n_words THEN 4 ELSE 0 END
            + CASE WHEN word_chars < 2 * n_words THEN 8 ELSE 0 END
            + CASE WHEN word_chars > 20 * n_words THEN 16 ELSE 0 END
            + CASE WHEN 100 * n_dup_lines > 60 * n_lines THEN 32 ELSE 0 END
            + CASE WHEN 100 * n_capitals > 60 * word_chars THEN 64 ELSE 0 END
            + CASE WHEN 100 * n_exclamations > 50 * n_words THEN 128 ELSE 0 END AS bits
    FROM m
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, bits = 0 AS kept, bits::BIGINT AS failed_bits,
       n_lines::BIGINT AS n_lines, n_capitals::BIGINT AS n_capitals, n_exclamations::BIGINT AS n_exclamations
FROM f
"""
