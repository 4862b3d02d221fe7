"""A manifest folder as a stream: resumed from its checkpoint, merged into a table so that a replay adds nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quarryweave.operators.catalog import uuid5, version_key
from quarryweave.sources.manifests import jsonl_records


def ingest_manifest_stream(spark: SparkSession, folder: str, table_path: str, checkpoint: str, root: str) -> StreamingQuery:
    """Append each new version of each record once; a batch run again overwrites its own part of the table."""
    records = jsonl_records(spark.readStream.text(folder))
    named = records.filter("problem is null").select(uuid5(F.concat_ws(":", F.lit("manifest"), F.lit(root), "relative_path")).alias("source_id"), F.lit(root).alias("root_id"), version_key(F.lit(root), F.col("relative_path"), F.col("byte_size"), F.col("sha256")).alias("version_key"), *[c for c in records.columns if c != "problem"])

    def merge(batch: DataFrame, number: int) -> None:
        fresh = batch.dropDuplicates(["version_key"])
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table_path)
        if path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            # of the table only the keys of other batches are read
            known = spark.read.parquet(table_path).filter(F.col("batch") != number).select("version_key")
            fresh = fresh.join(known, "version_key", "left_anti")
        fresh.write.mode("overwrite").parquet(f"{table_path}/batch={number}")

    return named.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
