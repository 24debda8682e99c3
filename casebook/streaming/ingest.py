"""Land raw journal files as they arrive: parse, normalise nulls, hash, flag, write a site-partitioned
Parquet stage. Exactly-once through the stream checkpoint; ``availableNow`` processes the backlog
and stops (a scheduled batch), a processing-time trigger keeps it running."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from casebook.operators.flags import disease_flags
from casebook.schema import RAW_SCHEMA, SITE
from casebook.session import checkpoint_dir
from casebook.sources.fixtures import add_entry_id
from casebook.sources.journal import normalise_nulls


def journal_stream(spark: SparkSession, path: str, encoding: str = "ISO-8859-1",
                   max_files_per_trigger: int = 100) -> DataFrame:
    """New raw site files under ``path`` as a stream of flagged journal entries."""
    raw = (spark.readStream.schema(RAW_SCHEMA).option("sep", ";").option("header", True)
           .option("encoding", encoding).option("escape", '"').option("multiLine", True)
           .option("maxFilesPerTrigger", max_files_per_trigger).csv(path))
    return disease_flags(add_entry_id(normalise_nulls(raw)))


def land(df: DataFrame, out_path: str, checkpoint: str | None = None, once: bool = True) -> StreamingQuery:
    """Append the stream to a Parquet stage partitioned by site. The checkpoint defaults to a folder
    under the shared ``spark.checkpoint.dir``."""
    ckpt = checkpoint or os.path.join(checkpoint_dir(df.sparkSession), "land-" + os.path.basename(out_path.rstrip("/")))
    w = (df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", ckpt)
         .partitionBy(SITE))
    w = w.trigger(availableNow=True) if once else w.trigger(processingTime="1 minute")
    return w.start(out_path)
