"""The pipeline over ``documents``: five stages, each a function of (spark, docs, sf_dir).

Each stage is written as Parquet and reread as the next one's ``docs``. All but the last return the
columns of documents. Rows are told apart by their whole content where ids may repeat; a row without
an id can be rejected by its text (stages 1 and 4), but is in no group of copies. In all stages an
empty table gives no rows, very long texts are read whole, and other columns are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.decontamination import decontaminate
from corpusloom.llm.quality import row_key, score_quality
from corpusloom.llm.sentencepiece_codec import encode_decode
from corpusloom.llm.shared import materialize
from corpusloom.llm.simhash_dedup import near_duplicates, text_key
from corpusloom.llm.substring_dedup import substring_dedup
from corpusloom.llm.token_counts import tokenizer_path


def quality(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the quality classifier rejects: those that score under 0.5. Null and
    blank texts are scored like others; repeated rows go or stay together; without labels all stay."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    kept = score_quality(docs, labels, F.col("source"), F.col("lang")).where("keep").select(F.col("row.key").alias("__key")).distinct()
    return docs.withColumn("__key", row_key(docs)).join(kept, "__key", "left_semi").drop("__key")


def near_copies(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document, that of the smallest id, of each group of near copies. Of rows that share an
    id, each goes by its own text (ties: the smaller hash), and of repeated rows one stays. Null and
    blank texts are copies of each other; all rows without an id stay."""
    groups = near_duplicates(docs.select("doc_id", "text")).where("doc_id is not null")
    kept = groups.where((F.col("component_id") == F.col("doc_id")) & (F.col("text_key") == F.col("least_key")))
    kept = materialize(kept.select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__text")).distinct(), "kept")
    first = F.row_number().over(Window.partitionBy("__id", "__text").orderBy(row_key(docs)))
    known = docs.join(kept, (docs["doc_id"] == kept["__id"]) & (text_key("text") == kept["__text"]))
    known = known.withColumn("__first", first).where("__first = 1").select(*docs.columns)
    return known.unionByName(docs.where("doc_id is null"))


def repeated_passages(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take passages of 35 words that occur elsewhere out of the texts. Every occurrence goes, so that
    of repeated rows of 35 words or more nothing is left. Texts that lose nothing stay as they are,
    null and blank ones too; no row goes."""
    done = substring_dedup(docs, with_text=True)
    columns = {c: F.col(f"row.`{c}`") for c in docs.columns if c != "text"} | {"text": F.col("kept_text")}
    if "n_chars" in columns:
        columns["n_chars"] = F.when(F.col("n_removed") > 0, F.length("kept_text").cast("long")).otherwise(columns["n_chars"])
    return done.select(*[columns[c].alias(c) for c in docs.columns])


def benchmark_leaks(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a passage of the benchmark. Null and blank texts hold none, nor does
    anything if there are no items; repeated rows go or stay together."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate(docs, items, slop=None).where("contaminated").select("doc_id", "text_key").distinct()
    found = materialize(found, "leaks").withColumnsRenamed({"doc_id": "__id", "text_key": "__text"})
    leaks = docs["doc_id"].eqNullSafe(found["__id"]) & (F.xxhash64(docs["text"]) == found["__text"])
    return docs.join(found, leaks, "left_anti")


def tokens(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece ids of what is left, and what they decode to, as digests. Null and empty texts have
    the begin and end ids alone; repeated rows are each returned."""
    coded = encode_decode(docs, tokenizer_path("piece_bpe_32k.model"))
    return coded.select("row.doc_id", "row.lang", "row.source", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES = [("quality", quality), ("near_copies", near_copies), ("repeated_passages", repeated_passages), ("benchmark_leaks", benchmark_leaks), ("tokens", tokens)]

#: SQL can express neither the classifier nor the fingerprints' components.
ORACLE_SQL = None


def run(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, f"stage-{name}")
    return docs
