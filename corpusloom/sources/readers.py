"""Readers: CSV in three conventions of missing cells, JSON lines, reports, and row numbers."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom import lexicon as L
from corpusloom.operators.cleaning import require_columns
from corpusloom.operators.merging import keep_one

_CSV = {"header": True, "multiLine": True, "quote": '"', "escape": '"', "maxCharsPerColumn": -1, "inferSchema": False}


def read_csv(spark: SparkSession, path, encoding: str = "UTF-8", required=()) -> DataFrame:
    """All columns as text; empty cells stay empty texts. A byte order mark is skipped."""
    df = spark.read.options(**_CSV, encoding=encoding).csv(path)
    require_columns(df, required)
    return df.na.fill("")


def read_csv_na(spark: SparkSession, path, encoding: str = "UTF-8", required=()) -> DataFrame:
    """As above, but cells that a default reader takes for missing are null."""
    df = spark.read.options(**_CSV, encoding=encoding).csv(path)
    require_columns(df, required)
    return nulls_for_na(df)


def nulls_for_na(df: DataFrame) -> DataFrame:
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.when(~F.col(c).isin(*L.NA_STRINGS), F.col(c)) for c in texts})


def read_csv_any(spark: SparkSession, path) -> DataFrame:
    """UTF-8, or Latin-1 where any line's bytes are not UTF-8. One scan of bytes decides, up to the
    first such line."""
    odd = spark.read.text(path).where(~F.is_valid_utf8("value"))
    return read_csv_na(spark, path, "UTF-8" if odd.isEmpty() else "ISO-8859-1")


def read_jsonl(spark: SparkSession, path, schema, key: str | None = None, order: str | None = None) -> DataFrame:
    """Lines that are no JSON objects are dropped; with a key, the last line of each wins."""
    df = spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)
    if key is None:
        return df
    if order is None:
        df, order = df.withColumn("__line", F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id())), "__line"
    return keep_one(df.where(F.col(key).isNotNull()), key, order).drop("__line")


def read_report(spark: SparkSession, path: str) -> DataFrame | None:
    """A JSON report, or None where there is none."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        return None
    return spark.read.option("multiLine", True).json(path)


def spread(df: DataFrame) -> DataFrame:
    """A small input in fewer partitions than there are cores, dealt to all of them; others as they
    are. Moving a few megabytes of text costs less than long expressions on one core."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def with_row_index(df: DataFrame, order: list[str]) -> DataFrame:
    """``row_index`` from 1, by a global order, without a task that holds all rows: rows are numbered
    within ranges, and each range begins where the ones before end."""
    ranged = df.repartitionByRange(*[F.col(c) for c in order]).sortWithinPartitions(*order).withColumn("__part", F.spark_partition_id())
    ranged = ranged.withColumn("__at", F.row_number().over(Window.partitionBy("__part").orderBy(*order)))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    offsets = ranged.groupBy("__part").count().select("__part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__offset"))
    return ranged.join(F.broadcast(offsets), "__part").withColumn("row_index", F.col("__offset") + F.col("__at")).drop("__part", "__at", "__offset")


def read_env(path: str) -> dict[str, str]:
    """KEY=VALUE lines of the driver's file, if it is there; what the environment has wins."""
    found: dict[str, str] = {}
    if Path(path).is_file():
        for line in Path(path).read_text(encoding="utf-8").splitlines():
            key, equals, value = line.strip().partition("=")
            if equals and key and not key.startswith("#"):
                found[key.strip()] = value.strip().strip("\"'")
    return {k: os.environ.get(k, v) for k, v in found.items()}


def discover(folder: str, preferred: list[str], pattern: str = "*.csv") -> list[str]:
    """Existing input files, preferred ones first, each once. For folders of the driver."""
    found = [*(Path(folder) / p for p in preferred), *sorted(Path(folder).glob(pattern))]
    return list(dict.fromkeys(str(p) for p in found if p.is_file()))


def availability(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    return spark.createDataFrame([(n, Path(p).exists(), p) for n, p in paths.items()], "artifact string, exists boolean, path string")


def demo_corpus(spark: SparkSession) -> DataFrame:
    """Three rows: markup and addresses, marks and punctuation, nothing but artifacts."""
    rows = [
        (1, "هدا @-@ مثال <unk> قصير", "hada @-@ mital 3la 2025 https://a.example", "This is @-@ a short <unk> row. See https://a.example", "هٰذا @-@ نَصٌّ <unk> قَصيرٌ"),
        (2, "الْكَلِمَةُ الثّانِيَةُ", "kanmchi ldar b7al 3ada!", "Another ROW, with marks!", "إِنَّ هٰذِهِ كَلِمَةٌ"),
        (3, "<unk>", "@-@", "<unk>", "@-@"),
    ]
    return spark.createDataFrame(rows, "row_index int, darija_arabic string, darija_arabizi string, english string, modern_standard_arabic string")
