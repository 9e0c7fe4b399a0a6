"""Daily drops as a stream: each new file of adverts goes through the same run as a batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vacantia.plans import pipeline
from vacantia.sources.feeds import ADVERT, numbered


def stream_adverts(spark: SparkSession, landing: str, files: int = 100) -> DataFrame:
    """Adverts, one JSON object a line, of files that land in a folder; ``files`` of them a micro-batch."""
    return spark.readStream.schema(ADVERT).option("maxFilesPerTrigger", files).json(landing)


def start(spark: SparkSession, landing: str, folder: str, today: str, checkpoint: str, files: int = 100) -> StreamingQuery:
    """Run every micro-batch through the daily run, as a part of the day; stops when all that has landed is done."""

    def each(batch: DataFrame, number: int) -> None:
        if not batch.isEmpty():
            ads = numbered(batch.withColumn("date_added", F.lit("")), "job_url", "title", "company", "description_snippet")
            failed, _ = pipeline.failures(pipeline.materialised(ads), today, folder, part=str(number))
            if failed:  # the batch is not committed, and is run again as the same part
                raise RuntimeError(f"batch {number}: {', '.join(failed)} failed")

    return stream_adverts(spark, landing, files).writeStream.option("checkpointLocation", checkpoint).foreachBatch(each).trigger(availableNow=True).start()
