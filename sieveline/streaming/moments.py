"""Request bursts as a stream: running moments per network instead of a window over all its buckets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

MOMENTS = ("n", "mean", "m2")


def closed_buckets(requests: DataFrame, width: str = "15 minutes", lateness: str = "10 minutes") -> DataFrame:
    """Requests per network and time bucket, once the watermark has passed the bucket."""
    buckets = requests.withWatermark("ts", lateness).groupBy(F.window("ts", width).alias("w"), "asn")
    return buckets.agg(F.count(F.lit(1)).alias("reqs")).select("asn", F.col("w.start").alias("bucket_ts"), "reqs")


def with_moments(closed: DataFrame, state: DataFrame | None) -> DataFrame:
    """Closed buckets with their network's moments (``n``, ``mean``, ``m2``) up to and with each, and the z-score there.

    ``state`` has the moments of each network before these buckets.  Moments of two sets of buckets merge without
    seeing the buckets again; ``m2`` is the sum of squared deviations.  The score is NULL where a network has not varied.
    """
    upto = Window.partitionBy("asn").orderBy("bucket_ts").rowsBetween(Window.unboundedPreceding, 0)
    now = closed.select(
        "asn", "bucket_ts", "reqs", F.count("reqs").over(upto).alias("__n"), F.avg("reqs").over(upto).alias("__mean"),
        (F.var_pop("reqs").over(upto) * F.count("reqs").over(upto)).alias("__m2"),
    )
    if state is None:
        none = (F.lit(0).cast("bigint"), F.lit(0.0), F.lit(0.0))
        met = now.withColumns({f"__{c}0": v for c, v in zip(MOMENTS, none)})
    else:
        before = state.select("asn", *[F.col(c).alias(f"__{c}0") for c in MOMENTS])
        met = now.join(before, "asn", "left").fillna(0, [f"__{c}0" for c in MOMENTS])
    n, step = F.col("__n0") + F.col("__n"), F.col("__mean") - F.col("__mean0")
    merged = met.select(
        "asn", "bucket_ts", "reqs", n.alias("n"), (F.col("__mean0") + step * F.col("__n") / n).alias("mean"),
        (F.col("__m20") + F.col("__m2") + step * step * F.col("__n0") * F.col("__n") / n).alias("m2"),
    )
    deviation = F.sqrt(F.col("m2") / F.col("n"))
    return merged.withColumn("zscore", F.when(deviation > 0, (F.col("reqs") - F.col("mean")) / deviation))


def moments_after(scored: DataFrame, state: DataFrame | None) -> DataFrame:
    """The state after :func:`with_moments`: the last moments of networks with new buckets, those before of all others."""
    last = scored.groupBy("asn").agg(F.max_by(F.struct(*MOMENTS), "bucket_ts").alias("m")).select("asn", "m.*")
    return last if state is None else last.unionByName(state.join(last, "asn", "left_anti"))


def start_burst_scores(
    requests: DataFrame, out: str, checkpoint: str, width: str = "15 minutes", lateness: str = "10 minutes", **trigger: object
) -> StreamingQuery:
    """Starts a query that writes each closed bucket with its score to ``out``, in a folder per batch.

    A score is what the batch form gives for the requests before the bucket's end.  The state, three numbers a network, stands
    beside the checkpoint in two versions; a batch reads the one of the batch before and writes its own, so a batch that was
    stopped, by a lost driver too, is run again to the same result.
    """

    def state_at(batch: int) -> str:
        return f"{checkpoint}/moments-{batch % 2}"

    def score(closed: DataFrame, batch: int) -> None:
        session = closed.sparkSession
        before = session.read.parquet(state_at(batch - 1)) if batch else None
        path = f"{out}/batch={batch}"
        with_moments(closed, before).write.mode("overwrite").parquet(path)
        moments_after(session.read.parquet(path), before).write.mode("overwrite").parquet(state_at(batch))

    writer = closed_buckets(requests, width, lateness).writeStream.outputMode("append").foreachBatch(score)
    return writer.option("checkpointLocation", f"{checkpoint}/query").trigger(**trigger).start()


def burst_scores(spark: SparkSession, out: str) -> DataFrame:
    """Scored buckets that a query of :func:`start_burst_scores` has written so far."""
    rows = spark.read.parquet(out).where(F.col("zscore").isNotNull())
    return rows.select("asn", "bucket_ts", "reqs", F.round("zscore", 2).alias("zscore"))
