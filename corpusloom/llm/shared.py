"""What the training-data operators have in common: the shared folder, written tables, sizes, Arrow slices."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MIB = 1 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which driver and executors share. A folder of our own
    is made only where that is unset, as in local tests."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    context = spark.sparkContext
    known = context._jsc.sc().getCheckpointDir()
    if known.isDefined():
        return known.get().rstrip("/")
    if not context.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and the executors share")
    base = f"file://{tempfile.mkdtemp(prefix='corpusloom-')}"
    context.setCheckpointDir(base)
    return base


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage ends there, and a lost
    executor costs a read, not a recomputation. (checkpoint() would run the plan twice.)"""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded_batches(spark: SparkSession, rows: int = 1024) -> None:
    """Fewer rows in each Arrow batch than the default of 10,000, as texts can be long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def text_bytes(docs: DataFrame, text_col: str = "text") -> int:
    """UTF-8 bytes of all texts: one number, from a scan of that column alone."""
    return docs.agg(F.sum(F.octet_length(F.col(text_col)).cast("long"))).first()[0] or 0


def pieces_for(total: int, piece_bytes: int, least: int) -> int:
    """How many pieces hold ``total`` bytes at about ``piece_bytes`` each."""
    return max(least, -(-total // piece_bytes))


def slices(table: pa.Table | pa.RecordBatch, sizes, limit: int = MIB) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes, and of one row at least."""
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if held and held + size > limit:
            yield start, i
            start, held = i, 0
        held += size
    if start < table.num_rows:
        yield start, table.num_rows


def shed(known: dict, most: int) -> None:
    """Keep what a dictionary has remembered within a bound: of more than ``most`` entries the newer
    half goes. Words that are frequent come early, so they stay."""
    if len(known) > most:
        for k in list(islice(known, most // 2, None)):
            del known[k]


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, id_col: str, text_col: str, size: int, most_bytes: int, allowed: Column | None = None) -> tuple[list[list[bytes | None]], list[int]]:
    """Texts of at most ``size`` rows labelled 0 and as many labelled 1, in the order of a hash of
    the id, without those over ``most_bytes`` (of an id that repeats, the least text); and how many
    labels of each kind there are. Only ids are sorted; they are then broadcast, 2 * size at most, so
    no other text moves. ``allowed`` is a
    condition on the column ``id``."""
    ids = labels.where(F.col(label).isin(0, 1) & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(label).cast("int").alias("y"))
    ids = ids if allowed is None else ids.where(allowed)
    counts = {r[0]: r[1] for r in ids.groupBy("y").count().collect()}
    chosen = [tuple(r) for y in (0, 1) for r in ids.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(size).collect()]
    wanted = F.broadcast(docs.sparkSession.createDataFrame(chosen, "id long, y int"))
    text = F.col(f"`{text_col}`").cast("string")
    rows = docs.where(F.coalesce(F.octet_length(text), F.lit(0)) <= most_bytes).select(F.col(f"`{id_col}`").cast("long").alias("id"), text.alias("text")).join(wanted, "id").groupBy("id", "y").agg(F.min("text").alias("text")).select("y", "text").collect()
    texts: list[list[bytes | None]] = [[], []]
    for y, t in rows:
        texts[y].append(None if t is None else t.encode())
    return [sorted(t, key=lambda x: x or b"") for t in texts], [counts.get(0, 0), counts.get(1, 0)]
