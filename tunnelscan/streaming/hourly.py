"""Hourly scoring as a Structured Streaming query.

The reference scores one ``datestr=…/hour=…`` partition per batch run.  Here a
file-source stream watches the table root.  A micro-batch only says which hours
have new files; each of these hours is then read as a whole, scored by the same
batch job, and its output folder ``<output>/datestr=…/hour=…`` replaced when the new
one is finished, so that readers never see a part of an hour.  So a
group is always judged on all files of its hour, however many batches brought
them and whenever they came, and a replayed batch gives the same files.
Progress is kept in a checkpoint under the shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tunnelscan.config import ScoringConfig
from tunnelscan.plans.scoring import Labeler, score
from tunnelscan.schemas import PARTITION_COLUMNS
from tunnelscan.session import shared_path
from tunnelscan.sources.readers import read_dns_log
from tunnelscan.sources.sinks import write_messages


def start_hourly_scoring(spark: SparkSession, table_root: str, output_path: str, labeler: Labeler,
                         cfg: ScoringConfig | None = None, available_now: bool = True,
                         interval: str = "10 minutes", max_files_per_trigger: int | None = None,
                         checkpoint: str | None = None, query_name: str = "hourly_dns_scoring",
                         **score_options) -> StreamingQuery:
    """Start the query; ``score_options`` go to ``score``."""
    hours = T.StructType([T.StructField("key", T.StringType())]
                         + [T.StructField(c, T.StringType()) for c in PARTITION_COLUMNS])
    reader = spark.readStream.schema(hours)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(table_root).select(*PARTITION_COLUMNS)

    def score_hours(batch: DataFrame, epoch_id: int) -> None:
        # A handful of hours: the partitions that got files in this batch.
        for datestr, hour in batch.distinct().collect():
            messages = read_dns_log(spark, table_root, datestr=datestr, hour=hour)
            result = score(messages, labeler, cfg, **score_options)
            write_messages(result.output, f"{output_path}/datestr={datestr}/hour={hour}", mode="overwrite")

    writer = (stream.writeStream.queryName(query_name).foreachBatch(score_hours)
              .option("checkpointLocation", checkpoint or shared_path(spark, "streams", query_name)))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()
