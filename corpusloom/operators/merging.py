"""Merges by key: last-wins tables, overrides by position, upserts, resumption."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom import lexicon as L
from corpusloom.functions import text as X


def keep_one(df: DataFrame, key: str, order: str, last: bool = True) -> DataFrame:
    """One row for each key: the last by ``order``, or the first. An aggregate, so that the rows of a
    hot key, or of no key, are reduced before they move."""
    pick = F.max_by if last else F.min_by
    whole = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    return df.groupBy(F.col(f"`{key}`").alias("__key")).agg(pick(whole, F.struct(order)).alias("__row")).select("__row.*")


def row_identity() -> Column:
    return F.coalesce(F.nullif(X.collapse(F.col("data_id")), F.lit("")), F.col("row_index").cast("string"))


def canonical_from_labels(df: DataFrame) -> DataFrame:
    """Rows of a labelling tool in canonical columns: a correction, even a blank one of spaces, wins
    over the original; trimmed afterwards; the status is VALIDATED."""
    names = {"modern_standard_arabic": "corrected_msa"}
    out = {}
    for c in L.CANONICAL:
        source = F.col(c) if c in df.columns else F.lit("")
        corrected = names.get(c, f"corrected_{c}")
        if c in L.TARGETS and corrected in df.columns:
            source = F.coalesce(F.nullif(X.as_text(F.col(corrected)), F.lit("")), source)
        out[c] = F.lit("VALIDATED") if c == "status" else X.sub(X.as_text(source), f"^{X.W}+|{X.W}+$", "")
    return df.select(*[v.alias(k) for k, v in out.items()])


def merge_halves(base: DataFrame, first: DataFrame, last: DataFrame, key: str, half: int, columns, first_fallback: bool = True) -> DataFrame:
    """Rows of ``base`` in order of ``row_index``; the first ``half`` take ``columns`` from ``first``
    and the others from ``last`` where these have the key (their last row for it), else their own.
    Without ``first_fallback``, rows of the first half that ``first`` lacks go. ``merge_source``
    says which it was."""
    overrides = []
    for name, df in (("first", first), ("last", last)):
        one = keep_one(df.select(key, "row_index", *columns), key, "row_index").select(F.col(key).alias(key), F.struct(*columns).alias(name))
        overrides.append(one)
    joined = base.join(overrides[0], key, "left").join(overrides[1], key, "left")
    early = F.col("row_index") <= half
    chosen = F.when(early, F.col("first")).otherwise(F.col("last"))
    out = joined.withColumn("chosen", chosen).withColumn("merge_source", F.when(F.col("chosen").isNull(), "fallback").when(early, "first").otherwise("last"))
    out = out.withColumns({c: F.when(F.col("chosen").isNotNull(), F.col(f"chosen.{c}")).otherwise(F.col(c)) for c in columns})
    if not first_fallback:
        out = out.where(~(early & (F.col("merge_source") == "fallback")))
    return out.select(*base.columns, "merge_source")


def match_counts(base: DataFrame, first: DataFrame, last: DataFrame, key: str, half: int) -> DataFrame:
    """How many distinct keys of each half are in the file meant for it."""
    out = []
    for name, condition, df in (("first", F.col("row_index") <= half, first), ("last", F.col("row_index") > half, last)):
        expected = base.where(condition).select(key).where(F.col(key).isNotNull()).distinct()
        found = expected.join(df.select(key), key, "left_semi")
        counts = expected.select(F.lit(1).alias("e"), F.lit(0).alias("m")).unionAll(found.select(F.lit(0), F.lit(1)))
        out.append(counts.agg(F.lit(name).alias("half"), F.coalesce(F.sum("e"), F.lit(0)).alias("expected"), F.coalesce(F.sum("m"), F.lit(0)).alias("matched")))
    return out[0].unionByName(out[1])


def upsert(base: DataFrame, changes: DataFrame, key: str, columns, order: str | None = None) -> DataFrame:
    """``base`` with ``columns`` of ``changes`` where it has the key; ``updated`` says so. Of changes
    that share a key the last by ``order`` counts, else the greatest by its values."""
    values = F.struct(*columns)
    new = changes.groupBy(key).agg(F.max_by(values, F.struct(order) if order else values).alias("__new"))
    joined = base.join(new, key, "left")
    return joined.withColumns({c: F.when(F.col("__new").isNotNull(), F.col(f"__new.{c}")).otherwise(F.col(c)) for c in columns} | {"updated": F.col("__new").isNotNull()}).drop("__new")


def pending(rows: DataFrame, checkpoint: DataFrame, key: str) -> DataFrame:
    """What a checkpoint does not have yet."""
    return rows.join(checkpoint.select(key).distinct(), key, "left_anti")


def content_key(dataset: str, columns=L.TARGETS) -> Column:
    """A checkpoint key that no other dataset or text shares, unlike a row number."""
    return F.sha2(F.concat_ws("\x1f", F.lit(dataset), row_identity(), *[X.as_text(F.col(c)) for c in columns]), 256)


def skip_reasons(df: DataFrame, checkpoint: DataFrame, key: str, start: int = 1, end: int | None = None, status: str | None = None, most: int | None = None) -> DataFrame:
    """``skip_reason``: the first of before_start, after_end, checkpoint, status, max_rows; null for
    rows to be worked on. The cap counts rows that nothing else skips, in order."""
    seen = checkpoint.select(F.col(key)).distinct().withColumn("__seen", F.lit(True))
    out = df.join(seen, key, "left")
    reason = F.when(F.col("row_index") < start, "before_start")
    if end is not None:
        reason = reason.when(F.col("row_index") > end, "after_end")
    reason = reason.when(F.col("__seen"), "checkpoint")
    if status is not None:
        reason = reason.when(F.upper(X.as_text(F.col("status"))) != status.upper(), "status")
    out = out.withColumn("skip_reason", reason).drop("__seen")
    if most is not None:
        # a top-k, not a rank over all rows in one task
        allowed = out.where("skip_reason is null").orderBy("row_index").limit(most).select(F.col("row_index").alias("__row"), F.lit(True).alias("__in"))
        out = out.join(allowed, F.col("row_index") == F.col("__row"), "left").withColumn("skip_reason", F.when(F.col("skip_reason").isNotNull(), F.col("skip_reason")).when(F.col("__in").isNull(), "max_rows")).drop("__row", "__in")
    return out


def range_reasons(df: DataFrame, checkpoint: DataFrame, key: str, start: int = 1, end: int | None = None, most: int | None = None) -> DataFrame:
    """The order-preserving variant: outside_selected_range, checkpoint, max_rows."""
    out = skip_reasons(df, checkpoint, key, start, end, None, most)
    return out.withColumn("skip_reason", F.when(F.col("skip_reason").isin("before_start", "after_end"), "outside_selected_range").otherwise(F.col("skip_reason")))


def head(df: DataFrame, n: int) -> DataFrame:
    return df.where(F.col("row_index") <= n)
