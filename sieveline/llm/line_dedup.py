"""Line dedup over levelled sorted runs of line hashes.

A run holds, in order of hash, the lines of the batches it covers: hash, number of documents, largest document id.  It is a table
hashed into buckets and sorted inside them, all runs alike, so that runs are merged bucket by bucket without a shuffle.  Batches come
in descending ranges of document id, so the keeper of a line is known from the first batch that has it.  A new batch is
merge-anti-joined with the runs: lines that a run has found frequent already are settled and leave the batch, the rest become its
own run.  When a level holds ``fan`` runs they are merged into one run of the next level; in the end all are.

How it scales: text is hashed once into (hash, document, batch) rows, which the batches, the merges and the drop list share.
Distinct documents are counted by (hash, document) before the counts of a hash meet as sums, so a line that a third of all documents
share never stands in one task.  The drop list joins on the hash, where Spark splits skewed partitions, and is then dealt by
document id and hash of the text, so that rows without an id, or of one id, do not share a list; a list holds hashes of its own text's
lines only.  Whole texts move once, to meet their drop list.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.llm.common import free_name, read, shared_folder, stored
from sieveline.sources.artifacts import write_bucketed

BLANKS = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NO_ID = -(2**63)
#: Line hashes a bucket of a run is meant for, and the least number of buckets.
BUCKET_ROWS = 4_000_000
LEAST_BUCKETS = 16


def line_hashes(text: Column, min_chars: int) -> Column:
    """Digests of a text's distinct keys of at least ``min_chars`` code points."""
    keys = F.transform(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)))
    long = F.array_distinct(F.filter(keys, lambda x: F.length(x) >= min_chars))
    return F.array_distinct(F.transform(long, lambda x: F.unhex(F.md5(F.translate(x, UPPER, LOWER).cast("binary")))))


def key_hash(line: str, min_chars: int) -> bytes | None:
    key = line.strip(BLANKS)
    if len(key) < min_chars:
        return None
    return hashlib.md5(key.encode("utf-8", "surrogatepass").lower(), usedforsecurity=False).digest()


class LineRuns:
    """The levelled index.  ``add`` takes (hash, doc) rows of a batch whose documents all come before those of earlier batches."""

    def __init__(self, min_docs: int, fan: int, buckets: int = LEAST_BUCKETS):
        if fan < 2:
            raise ValueError("fan is 2 at least")
        self.min_docs, self.fan, self.buckets = min_docs, fan, buckets
        self.levels: list[list[DataFrame]] = []

    def add(self, lines: DataFrame) -> None:
        run = lines.groupBy("hash").agg(F.count_distinct("doc").alias("n_docs"), F.max("doc").alias("keeper"))
        for level in self.levels:
            for older in level:
                settled = older.where(F.col("n_docs") >= self.min_docs).select("hash")
                run = run.join(settled.hint("merge"), "hash", "left_anti")
        self._put(self._sorted(run, dealt=False), 0)

    def _sorted(self, run: DataFrame, dealt: bool) -> DataFrame:
        path = f"{shared_folder(run.sparkSession)}/llm-line-run-{uuid.uuid4().hex}"
        return write_bucketed(run, path, ["hash"], self.buckets, dealt)

    def _merged(self, runs: list[DataFrame]) -> DataFrame:
        """Runs as one, two at a time by a full outer merge join; equal buckets meet, nothing is shuffled."""

        def both(a: DataFrame, b: DataFrame) -> DataFrame:
            joined = a.alias("a").join(b.hint("merge").alias("b"), F.col("a.hash") == F.col("b.hash"), "full")
            n = F.coalesce("a.n_docs", F.lit(0)) + F.coalesce("b.n_docs", F.lit(0))
            keeper = F.greatest("a.keeper", "b.keeper")  # of the one there is, where the other is missing
            return joined.select(F.coalesce("a.hash", "b.hash").alias("hash"), n.alias("n_docs"), keeper.alias("keeper"))

        return reduce(lambda a, b: self._sorted(both(a, b), dealt=True), runs)

    def _put(self, run: DataFrame, at: int) -> None:
        if at == len(self.levels):
            self.levels.append([])
        self.levels[at].append(run)
        if len(self.levels[at]) == self.fan:
            merged, self.levels[at] = self._merged(self.levels[at]), []
            self._put(merged, at + 1)

    def frequent(self) -> DataFrame:
        """(hash, keeper) of lines in ``min_docs`` documents or more, over all runs."""
        runs = [run for level in self.levels for run in level]
        return stored(self._merged(runs).where(F.col("n_docs") >= self.min_docs).select("hash", "keeper"), "frequent-lines")


def drop_frequent_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = 40,
    min_docs: int = 5,
    batches: int = 4,
    fan: int = 2,
    out: tuple[str, str] = ("dedup_n_lines", "dedup_n_dropped"),
) -> DataFrame:
    """``docs`` with frequent lines left only in the largest document id that holds them.

    All columns stay, whatever their names, the text without the dropped lines; ``out`` names the number of lines before and of lines
    dropped (columns of that name are replaced).  Defined cases: a null text counts as empty, one empty line, and comes back empty; a
    null id comes before every other id; rows that repeat an id are one document when documents are counted, and are all kept; a line
    that repeats within its document is dropped or kept each time; a very long text is split and hashed as a whole, and held by one
    task; an empty table gives no rows.
    """
    id_type, text = docs.schema[id_col].dataType.simpleString(), F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    if id_type not in ("bigint", "int", "smallint", "tinyint"):
        raise TypeError("line dedup orders documents by an integer id")
    kept = [c for c in docs.columns if c not in out]
    doc = F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NO_ID))
    cuts = docs.agg(F.percentile_approx(doc, [1 - k / batches for k in range(1, batches)], 1000)).first()[0] if batches > 1 else []
    batch = F.lit(0)
    for cut in cuts or []:
        batch = batch + F.when(doc <= F.lit(cut), 1).otherwise(0)
    row = F.xxhash64(text)
    lines = docs.select(batch.alias("batch"), doc.alias("doc"), row.alias("row"), F.explode(line_hashes(text, min_chars)).alias("hash"))
    lines = stored(lines.select("doc", "row", "hash", "batch"), "line-hashes", "batch")

    runs = LineRuns(min_docs, fan, max(LEAST_BUCKETS, -(-lines.count() // BUCKET_ROWS)))
    for k in range(batches):
        runs.add(lines.where(F.col("batch") == k).select("hash", "doc"))
    drops = lines.join(runs.frequent(), "hash").where(F.col("doc") != F.col("keeper"))
    drops = drops.groupBy("doc", "row").agg(F.collect_set("hash").alias("drops"))

    doc_name, row_name = free_name(kept, "doc"), free_name(kept, "row")
    drops = drops.select(F.col("doc").alias(doc_name), F.col("row").alias(row_name), F.col("drops").alias(free_name(kept, "drops")))
    wide = docs.select(*[F.col(f"`{c}`") for c in kept], doc.alias(doc_name), row.alias(row_name))
    wide = wide.join(drops, [doc_name, row_name], "left").drop(doc_name, row_name)
    place, names = kept.index(text_col), [*kept, *out]

    def cut_lines(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in found:
            texts, counts, dropped = [], [], []
            for text, drop in zip(rows.column(place), rows.column(len(kept))):
                text = text.as_py() or ""
                n = text.count("\n") + 1
                gone = set(drop.as_py() or ())
                if gone:
                    stay = [x for x in text.split("\n") if key_hash(x, min_chars) not in gone]
                    text = "\n".join(stay)
                    dropped.append(n - len(stay))
                else:
                    dropped.append(0)
                texts.append(text)
                counts.append(n)
            columns = [rows.column(i) for i in range(len(kept))]
            columns[place] = pa.array(texts, rows.schema.field(place).type)
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.int64()), pa.array(dropped, pa.int64())], names)

    schema = docs.select(*[F.col(f"`{c}`") for c in kept], *[F.lit(0).cast("long").alias(n) for n in out]).schema
    return wide.mapInArrow(cut_lines, schema)


def op9_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line dedup of all documents, with a digest of what each keeps."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return drop_frequent_lines(docs).select(
        "doc_id", F.col("dedup_n_lines").alias("n_lines"), F.col("dedup_n_dropped").alias("n_dropped"),
        F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"),
    )


OP9_SQL = r"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents
), lines AS (
    SELECT r, doc_id, i, l[i] AS line,
           translate(trim(l[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM (SELECT *, unnest(range(1, len(l) + 1)) AS i FROM d)
), frequent AS (
    SELECT key, max(coalesce(doc_id, -9223372036854775808)) AS keeper
    FROM lines WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT coalesce(doc_id, -9223372036854775808)) >= 5
), marked AS (
    SELECT r, doc_id, i, line, keeper IS NOT NULL AND coalesce(doc_id, -9223372036854775808) <> keeper AS gone
    FROM lines LEFT JOIN frequent USING (key)
)
SELECT any_value(doc_id) AS doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY r
"""
