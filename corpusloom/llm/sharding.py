"""Sharding by vector bin packing: bytes, tokens and rows balanced together.

Groups are equal texts, and a group stays in one shard. Only a group that no shard can hold, as it
has more than a shard's share of all bytes, tokens or rows, is split: into as many parts as
there are shards, by a hash of the id (of null ids, the place in the input). What is placed are *items* of one vector each: every group over
``1/SLICES`` of a shard's share in any dimension is an item, or each of its parts; the tail, groups
below that, is combined, whole groups, into ``BUCKETS`` hash buckets, and each bucket is an item. So
the number of items is bounded whatever the input, and they are packed on the driver: largest first
(ties in the order of their names), each to the shard where the dot product of its vector with the
residual capacity is highest (ties to the first). Laws: ``bytes`` (sizes near equal; bytes weigh
most in the product); ``rows`` and ``key`` are not offered by this operator.

Slots are numbered within hash parts of each shard, plus the rows of the parts before, so no task
holds a shard. Defined cases: a null text has no bytes, its size is 1 and its checksum that of no
bytes (0), and it is in one group with empty texts; an empty table has no rows; repeated rows get
slots of their own; very long texts are items like others; columns besides id and text are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.shared import materialize

BUCKETS, SLICES = 4096, 1024
WEIGHTS = (4.0, 1.0, 1.0)
PART_ROWS = 20_000


def pack(vectors: np.ndarray, bins: int, weights=WEIGHTS) -> np.ndarray:
    """The bin of each vector. Dimensions are taken relative to their totals."""
    totals = vectors.sum(axis=0)
    shares = vectors / np.where(totals > 0, totals, 1)
    weighed = shares * np.asarray(weights)
    residual = np.full((bins, vectors.shape[1]), 1.0 / bins)
    place = np.zeros(len(vectors), np.int64)
    for i in np.lexsort((np.arange(len(vectors)), -weighed.sum(axis=1))):
        best = int(np.argmax(residual @ weighed[i]))
        place[i] = best
        residual[best] -= shares[i]
    return place


def words(text: Column) -> Column:
    """About the number of tokens: single spaces, plus one."""
    return F.when(F.octet_length(text) > 0, F.char_length(text) - F.char_length(F.replace(text, F.lit(" "), F.lit(""))) + 1).otherwise(0)


def shard_documents(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text", tokens: Column | None = None) -> DataFrame:
    """Return id, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot``, ``grown_shard``."""
    spark, text = docs.sparkSession, F.col(f"`{text_col}`").cast("string")
    known = F.coalesce(text, F.lit(""))
    # rows without an id are told apart by their place in the input, written down once
    salt = F.xxhash64(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.monotonically_increasing_id()))
    rows = materialize(docs.select(F.col(f"`{id_col}`").alias("id"), (F.octet_length(known).cast("long") + 1).alias("size"), F.coalesce(tokens if tokens is not None else words(text), F.lit(0)).cast("long").alias("tokens"), F.crc32(known.cast("binary")).alias("text_crc32"), F.md5(known.cast("binary")).alias("group"), salt.alias("salt")), "sizes")
    groups = rows.groupBy("group").agg(F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows"))
    total = rows.agg(F.sum("size"), F.sum("tokens"), F.count("*")).first()
    share = F.greatest(*[F.col(c) * float(shards) / float(t or 1) for c, t in zip(("size", "tokens", "rows"), total, strict=True)])
    # at most 3 * shards * SLICES groups are this large
    large = groups.where(share > 1 / SLICES).select("group", F.when(share > 1, shards).otherwise(1).alias("parts"))
    large = spark.createDataFrame([tuple(r) for r in large.collect()], "group string, parts int")
    part = F.concat_ws("/", "group", F.pmod("salt", "parts").cast("string"))
    bucket = F.pmod(F.xxhash64("group"), F.lit(BUCKETS)).cast("string")
    placed = rows.join(F.broadcast(large), "group", "left").withColumn("item", F.when(F.col("parts").isNotNull(), part).otherwise(bucket))
    items = placed.groupBy("item").agg(F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows")).orderBy("item").collect()
    bins = pack(np.array([r[1:] for r in items], float).reshape(-1, 3), shards)
    chosen = spark.createDataFrame([(r[0], int(b)) for r, b in zip(items, bins, strict=True)], "item string, shard int")
    parts = max(16, -(-(total[2] or 0) // (shards * PART_ROWS)))
    dealt = placed.join(F.broadcast(chosen), "item").withColumn("part", F.pmod(F.xxhash64("salt", "text_crc32", "size"), F.lit(parts)).cast("int"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = dealt.groupBy("shard", "part").count().withColumn("offset", F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count")
    within = F.row_number().over(Window.partitionBy("shard", "part").orderBy("id", "text_crc32", "size"))
    numbered = dealt.withColumn("number", within).join(offsets, ["shard", "part"])
    return numbered.select(F.col("id").alias(id_col), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("offset") + F.col("number") - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def op9_sharding(spark, sf_dir: str) -> DataFrame:
    """All ``documents`` in 16 shards of near equal bytes."""
    return shard_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
