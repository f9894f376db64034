"""Timed index building and retrieval, with the statistics of the candidates."""

from __future__ import annotations

import resource
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import RetrievalConfig
from ..functions import text
from ..sources import tsv
from . import retrieval, store


def statistics(truth: DataFrame, candidates: DataFrame, corpus_size: int) -> DataFrame:
    """Sizes of the lists (with the averaging median), the share of pairs saved, and recall, which is 1 where there is nothing to recall.

    truth(s1, ids), candidates(s1, ids); queries without truth count for the sizes only.
    """
    rows = candidates.select("s1", F.array_distinct("ids").alias("c")).join(truth.select("s1", F.array_distinct("ids").alias("t")), "s1", "left")
    t, hit = F.coalesce(F.size("t"), F.lit(0)), F.coalesce(F.size(F.array_intersect("t", "c")), F.lit(0))
    return statistics_by_number(rows.select(F.size("c").alias("n"), F.greatest(t, F.lit(0)).alias("t"), F.greatest(hit, F.lit(0)).alias("h")), corpus_size)


def statistics_by_number(rows: DataFrame, corpus_size: int) -> DataFrame:
    """statistics() of queries with n candidates, t links and h of them among the candidates."""
    or_one = lambda part, whole: F.when(whole == 0, 1.0).otherwise(part / whole)
    product = F.count("*") * corpus_size
    return rows.agg(
        F.count("*").alias("s1_count"), F.sum("n").cast("long").alias("pairs"), F.avg("n").alias("mean_n"), F.percentile("n", 0.5).alias("median_n"), F.min("n").cast("long").alias("min_n"),
        F.max("n").cast("long").alias("max_n"), F.when(product > 0, 1 - F.sum("n") / product).otherwise(0.0).alias("reduction_ratio"), or_one(F.sum("h"), F.sum("t")).alias("edge_recall"),
        or_one(F.count_if((F.col("t") > 0) & (F.col("t") == F.col("h"))), F.count_if(F.col("t") > 0)).alias("complete_coverage"),
    )


def run(spark: SparkSession, source1: str, source2: str, source3: str, folder: str, truth: str | None = None, config: RetrievalConfig = RetrievalConfig()) -> dict:
    """Builds an index of the files and retrieves for all of source1; times in seconds, the driver's peak memory in MB."""
    start = time.time()
    records = tsv.read_source(spark, source2, "S2-").unionByName(tsv.read_source(spark, source3, "S3-"))
    index = store.open_index(spark, store.write(records, folder, {"source2": source2, "source3": source3}, config))
    built = time.time()
    queries = text.normalize(tsv.read_source(spark, source1, "S1-"))
    lists = retrieval.groups(queries, retrieval.candidates(queries, index, config))
    links = tsv.read_truth(spark, truth).toDF("s1", "ids") if truth else spark.createDataFrame([], "s1 string, ids array<string>")
    values = statistics(links, lists, index.size()).first().asDict()
    done = time.time()
    return {"index_s": built - start, "retrieval_s": done - built, "driver_peak_mb": resource.getrusage(resource.RUSAGE_SELF).ru_maxrss / 1024, **values}


def report(results: dict) -> str:
    return "\n".join(f"{k:>18}: {v:,.4f}" if isinstance(v, float) else f"{k:>18}: {v:,}" for k, v in results.items())
