"""Landing folder -> bronze table, incrementally.

The batch path (:func:`tessera.plans.crimes.bronze`) re-reads the whole landing file on
every run. This is the same ingest as a file-source stream: each run picks up only the
files that arrived since the last one (the checkpoint records which files were committed),
stamps them and appends them to the bronze parquet folder. Run with the ``availableNow``
trigger it behaves as an incremental batch job that stops when the backlog is done; a
failed run restarts from the checkpoint without duplicating rows. The checkpoint belongs to
the target, not to the application: a later application goes on where the last one stopped.
"""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tessera.sources.files import _files, headers, normalize_name


def ingest_landing(spark: SparkSession, landing_dir: str, target_path: str, source: str, *,
                   columns: list[str] | None = None, checkpoint: str | None = None,
                   pattern: str = "*.csv", wait: bool = True,
                   max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Append new CSV files of ``landing_dir`` to the parquet folder ``target_path``.

    Columns are all strings named by :func:`normalize_name` (from ``columns`` or the header
    of the landed files); ``_ingested_at`` is the micro-batch time and ``_source`` the given
    label. ``checkpoint`` defaults to ``<target_path>.checkpoint``, next to the target. The names
    are ``columns``, or the header of the first landed file. Every file is compared with them as
    it is read, so also one that lands during the run: another header fails its batch, of
    which nothing is added. Headers of files that were ingested before are not read again.
    """
    names = columns
    if names is None:
        listed = _files(spark, f"{landing_dir.rstrip('/')}/{pattern}")
        names = next((h for f in listed for h in headers(spark, landing_dir, files=[f]).values()), [])
    # an empty header cell has no name that could be compared
    compared = not any(n.startswith("_c") and n[2:].isdigit() for n in names)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    reader = (spark.readStream.schema(schema).option("header", True).option("multiLine", True).option("enforceSchema", not compared)
              .option("escape", '"').option("pathGlobFilter", pattern))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.csv(landing_dir)
    out = raw.toDF(*[normalize_name(n) for n in names]).withColumns(
        {"_ingested_at": F.current_timestamp(), "_source": F.lit(source)})
    ckpt = checkpoint or target_path.rstrip("/") + ".checkpoint"
    q = (out.writeStream.format("parquet").option("checkpointLocation", ckpt)
         .outputMode("append").trigger(availableNow=True).start(target_path))
    if wait:
        try:
            q.awaitTermination()
        except StreamingQueryException as failed:
            # tell which file has another header, if that is the reason
            for file, have in headers(spark, f"{landing_dir.rstrip('/')}/{pattern}").items():
                if have != names:
                    raise ValueError(f"{file} has the columns {have}, not {names}") from failed
            raise
    return q
