"""Restartable retrieval: S1 files as a stream against a fixed index.

Ranking needs whole groups, which a stream does not have, so each micro-batch
is retrieved as a batch of its own.  The checkpoint remembers the files that are
done; a batch that is repeated after a failure overwrites its own folder, so
results are there once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..config import RetrievalConfig
from ..functions import ids, text
from ..operators import retrieval


def stream_sources(spark: SparkSession, folder: str, prefix: str = "1", files_per_batch: int = 1) -> DataFrame:
    """S1 files of a folder as they appear."""
    reader = spark.readStream.schema(schemas.SOURCE).options(sep="\t", header=True, quote='"', escape='"', maxFilesPerTrigger=files_per_batch)
    raw = reader.csv(folder)
    return raw.withColumns({c: F.coalesce(c, F.lit("")) for c in raw.columns}).withColumn("entity_id", ids.require_id(F.col("entity_id"), prefix))


def start(sources: DataFrame, index: retrieval.Index, out: str, checkpoint: str, config: RetrievalConfig = RetrievalConfig()) -> StreamingQuery:
    """Writes candidate pairs of every micro-batch to out/batch=<id>; stops when all files there are done."""

    def one(batch: DataFrame, number: int) -> None:
        queries = text.normalize(batch.withColumn("row_ord", F.monotonically_increasing_id()))
        pairs = retrieval.candidates(queries, index, config)
        listed = retrieval.groups(queries, pairs)
        listed.write.mode("overwrite").parquet(f"{out}/batch={number}")

    return sources.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
