"""Incremental cleaning: files that arrive are cleaned once each, batch by batch, and the rows a
results table has already are left out. The batch operators do the work; nothing stateful is added."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusloom.operators import cleaning, merging


def clean_arrivals(spark: SparkSession, source: str, schema, results: str, progress: str, key: str = "data_id", options: cleaning.CleaningOptions = cleaning.CleaningOptions()):
    """Start a query over Parquet files in ``source``; returns it. One run takes what is there."""

    def one(batch: DataFrame, number: int) -> None:
        rows = batch.dropDuplicates([key])
        path = spark._jvm.org.apache.hadoop.fs.Path(results)
        if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
            rows = merging.pending(rows, spark.read.parquet(results), key)
        cleaning.clean_corpus(rows, options).write.mode("append").parquet(results)

    return spark.readStream.schema(schema).parquet(source).writeStream.foreachBatch(one).option("checkpointLocation", progress).trigger(availableNow=True).start()
