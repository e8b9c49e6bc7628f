"""Profiles of a dataset, and comparisons of two: each a small aggregate of one or two scans."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom import lexicon as L
from corpusloom.functions import text as X
from corpusloom.operators.merging import keep_one


def histogram(df: DataFrame, value: str, bins: int, by: str | None = None) -> DataFrame:
    """Counts of equal bins from the least to the greatest value, the last one closed."""
    keys = [by] if by else []
    bounds = df.groupBy(*keys).agg(F.min(value).cast("double").alias("low"), F.max(value).cast("double").alias("high"))
    known = df.where(F.col(value).isNotNull())
    if by:
        bounds = bounds.withColumnRenamed(by, "__by")
        both = known.join(bounds, F.col(by).eqNullSafe(F.col("__by")))
    else:
        both = known.crossJoin(bounds)  # one row
    place = F.floor((F.col(value) - F.col("low")) / ((F.col("high") - F.col("low")) / bins))
    at = F.when(F.col("high") > F.col("low"), F.least(place, F.lit(bins - 1))).otherwise(0).cast("int")
    return both.withColumn("bin", at).groupBy(*keys, "bin").agg(F.count("*").alias("count"))


def boxplot(df: DataFrame, value: str, by: str) -> DataFrame:
    """Quartiles, and the extreme values within 1.5 interquartile ranges of them."""
    q = df.groupBy(by).agg(F.percentile(value, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("q"))
    q = q.select(by, F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"))
    inside = F.col(value).between(F.col("q1") - 1.5 * (F.col("q3") - F.col("q1")), F.col("q3") + 1.5 * (F.col("q3") - F.col("q1")))
    ends = df.join(q.withColumnRenamed(by, "__by"), F.col(by).eqNullSafe(F.col("__by"))).where(inside).groupBy(F.col(by).alias("__of")).agg(F.min(value).alias("whisker_low"), F.max(value).alias("whisker_high"))
    return q.join(ends, F.col(by).eqNullSafe(F.col("__of"))).drop("__of")


def length_stats(df: DataFrame, value: str, by: str, decimals: int = 2) -> DataFrame:
    stats = {"mean": F.avg(value), "median": F.median(value), "p95": F.percentile(value, F.lit(0.95)), "max": F.max(value)}
    return df.groupBy(by).agg(*[F.round(v, decimals).cast("double").alias(k) for k, v in stats.items()])


def spread_stats(df: DataFrame, value: str, by: str, decimals: int = 4, exact: bool = True) -> DataFrame:
    """An exact median holds a group's distinct values in one task; without ``exact`` it is a sketch's."""
    median = F.median(value) if exact else F.approx_percentile(value, 0.5, 10_000)
    stats = {"mean": F.avg(value), "median": median, "std": F.stddev_samp(value), "min": F.min(value), "max": F.max(value)}
    return df.groupBy(by).agg(F.count(value).alias("count"), *[F.round(v, decimals).cast("double").alias(k) for k, v in stats.items()])


def word_count_stats(df: DataFrame, value: str, by: str) -> DataFrame:
    return df.groupBy(by).agg(F.round(F.avg(value), 2).alias("mean"), F.median(value).cast("int").alias("median"), F.min(value).alias("min"), F.max(value).alias("max"), F.round(F.stddev_samp(value), 2).alias("std"))


def value_counts(df: DataFrame, column: str, null_name: str = "<NA>") -> DataFrame:
    return df.groupBy(F.coalesce(F.col(column).cast("string"), F.lit(null_name)).alias("value")).agg(F.count("*").alias("count"))


def shares(counts: DataFrame) -> DataFrame:
    """Counts with their percentage of the whole, as text of one decimal."""
    total = F.sum("count").over(Window.partitionBy())  # a row for each value
    return counts.withColumn("percentage", F.format_string("%.1f%%", 100 * F.col("count") / total))


def conditional_counts(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    return df.agg(F.count("*").alias("rows"), *[F.count_if(c).alias(n) for n, c in conditions.items()])


def dataset_summary(df: DataFrame, id_col: str) -> DataFrame:
    """Rows, columns, rows that repeat a whole row, distinct ids (nulls apart), rows that repeat an id."""
    distinct_rows = df.groupBy(*df.columns).agg(F.count("*").alias("n")).agg(F.sum("n").alias("rows"), F.sum(F.col("n") - 1).alias("duplicated_rows"))
    ids = df.groupBy(id_col).agg(F.count("*").alias("n")).agg(F.count(id_col).alias("unique_ids"), F.sum(F.col("n") - 1).alias("duplicated_ids"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return distinct_rows.crossJoin(ids).select(zero("rows"), F.lit(len(df.columns)).alias("columns"), zero("duplicated_rows"), zero("unique_ids"), zero("duplicated_ids"))  # one row each


def unpivot(df: DataFrame, columns, name: str, value: str, also=()) -> DataFrame:
    return df.select(*also, F.explode(F.array(*[F.struct(F.lit(c).alias(name), F.col(c).alias(value)) for c in columns])).alias("u")).select(*also, f"u.{name}", f"u.{value}")


def missing(df: DataFrame) -> DataFrame:
    counts = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])
    return unpivot(counts, df.columns, "column", "missing")


def missing_delta(left: DataFrame, right: DataFrame, n: int = 20) -> DataFrame:
    """Of columns in either, missing cells and the change; the n greatest changes."""
    both = missing(left).withColumnRenamed("missing", "source").join(missing(right).withColumnRenamed("missing", "cleaned"), "column", "full").na.fill(0, ["source", "cleaned"])
    return both.withColumn("delta", F.col("cleaned") - F.col("source")).orderBy(F.desc(F.abs("delta")), "column").limit(n)


def id_overlap(left: DataFrame, right: DataFrame, id_col: str) -> DataFrame:
    """Distinct ids of each, in both, and in one alone: one aggregate over the union."""
    sides = left.select(F.col(id_col), F.lit(1).alias("l"), F.lit(0).alias("r")).unionAll(right.select(F.col(id_col), F.lit(0), F.lit(1)))
    ids = sides.where(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.max("l").alias("l"), F.max("r").alias("r"))
    names = {"left_unique": "l = 1", "right_unique": "r = 1", "both": "l = 1 and r = 1", "left_only": "r = 0", "right_only": "l = 0"}
    return ids.agg(*[F.count_if(F.expr(e)).alias(n) for n, e in names.items()])


def compare(left: DataFrame, right: DataFrame, key: str, order: str) -> DataFrame:
    """Inner join of the first rows of each key; null keys match each other."""
    a, b = keep_one(left, key, order, last=False), keep_one(right, key, order, last=False)
    a = a.select(*[F.col(c).alias(f"source_{c}") for c in a.columns])
    b = b.select(*[F.col(c).alias(f"cleaned_{c}") for c in b.columns])
    return a.join(b, F.col(f"source_{key}").eqNullSafe(F.col(f"cleaned_{key}")))


def compare_by_position(left: DataFrame, right: DataFrame) -> DataFrame:
    """The fallback without keys: rows of equal ``row_index``, as many as the shorter has."""
    a = left.select(*[F.col(c).alias(f"source_{c}") for c in left.columns])
    b = right.select(*[F.col(c).alias(f"cleaned_{c}") for c in right.columns])
    return a.join(b, F.col("source_row_index") == F.col("cleaned_row_index"))


def change_rates(compared: DataFrame, columns) -> DataFrame:
    """Of each column, cells that differ after white space is collapsed, and their share."""
    return changed_shares(compared.select(*[(X.collapse(F.col(f"source_{c}")) != X.collapse(F.col(f"cleaned_{c}"))).alias(c) for c in columns]))


def changed_shares(flags: DataFrame) -> DataFrame:
    """Of each boolean column, how many rows it holds for, and their share."""
    cells = unpivot(flags.select(*[F.col(c).cast("int").alias(c) for c in flags.columns]), flags.columns, "column", "changed")
    return cells.groupBy("column").agg(F.sum("changed").alias("changed_rows"), F.count("*").alias("compared_rows"), F.round(100.0 * F.sum("changed") / F.count("*"), 2).alias("change_rate"))


def outer_counts(left: DataFrame, right: DataFrame) -> DataFrame:
    """Two tables of value and count, side by side, absent values as 0."""
    return left.withColumnRenamed("count", "source").join(right.withColumnRenamed("count", "cleaned"), "value", "full").na.fill(0, ["source", "cleaned"])


def metric_pivot(datasets: dict[str, DataFrame], metrics: dict[str, Column]) -> DataFrame:
    """A row for each metric, a column for each dataset."""
    parts = [df.agg(*[m.cast("double").alias(n) for n, m in metrics.items()]).withColumn("dataset", F.lit(name)) for name, df in datasets.items()]
    long = unpivot(reduce(DataFrame.unionByName, parts), list(metrics), "metric", "value", ["dataset"])
    return long.groupBy("metric").pivot("dataset", list(datasets)).agg(F.first("value"))


def multi_summary(datasets: dict[str, DataFrame], column: str) -> DataFrame:
    """Of each dataset, rows and a map of value counts."""
    parts = [value_counts(df, column).withColumn("dataset", F.lit(name)) for name, df in datasets.items()]
    entries = F.map_from_entries(F.array_sort(F.collect_list(F.struct("value", "count"))))
    return reduce(DataFrame.unionByName, parts).groupBy("dataset").agg(F.sum("count").alias("rows"), F.to_json(entries).alias("counts"))


def retention(counts: DataFrame) -> DataFrame:
    return counts.withColumn("retention_pct", F.round(100.0 * F.col("output_rows") / F.col("input_rows"), 4))


def group_totals(df: DataFrame, by: str, corrected: Column) -> DataFrame:
    """Total and corrected rows by group. Errors stay 0 by group, as published; they are in totals."""
    return df.groupBy(F.coalesce(F.col(by), F.lit("UNKNOWN")).alias("value")).agg(F.count("*").alias("total"), F.count_if(corrected).alias("corrected"), F.lit(0).cast("long").alias("errors"))


def shard_totals(df: DataFrame, shard: str, by: str) -> DataFrame:
    """Rows by shard and group, with the sums over groups and over shards."""
    return df.rollup(shard, by).agg(F.count("*").alias("rows"), F.grouping_id().cast("int").alias("level"))


def anomalies(df: DataFrame) -> DataFrame:
    """Digits for letters in the Arabizi field, and blank fields, before any correction."""
    blank = {f"blank_{c}": X.is_blank(F.col(c)) for c in L.TARGETS}
    return conditional_counts(df, {"arabizi_digits": X.has_arabizi_digit(F.col("darija_arabizi")), **blank})


def anomalies_after(df: DataFrame, before: dict[str, str]) -> DataFrame:
    """Digits for letters in the Arabic Darija field and blank fields, before and after a correction;
    before: the column that holds each field's old value."""
    fields = ("darija_arabic", "darija_arabizi", "modern_standard_arabic")
    blanks = lambda name: sum((X.is_blank(F.col(name(c))).cast("long") for c in fields), F.lit(0))
    return df.agg(
        F.count_if(X.has_arabizi_digit(F.col(before["darija_arabic"]))).alias("arabizi_before"),
        F.count_if(X.has_arabizi_digit(F.col("darija_arabic"))).alias("arabizi_after"),
        F.coalesce(F.sum(blanks(lambda c: before[c])), F.lit(0)).cast("long").alias("empty_before"),
        F.coalesce(F.sum(blanks(lambda c: c)), F.lit(0)).cast("long").alias("empty_after"),
    )


def correction_kinds(df: DataFrame, status: str, changed: str = "changed_fields") -> DataFrame:
    """Rows by corrected field, and complete and partial corrections by the status they came with.
    Published counts spell the second status with a space; both spellings count here."""
    touched, state = F.col(changed) != "", F.upper(X.as_text(F.col(status)))
    kinds = {c: F.array_contains(F.split(changed, ";"), c) for c in L.TARGETS}
    kinds |= {"complete_corrections": touched & (state == "GENERATED"), "partial_corrections": touched & state.isin("PARTIALLY VALIDATED", "PARTIALLY_VALIDATED")}
    return unpivot(df.agg(*[F.count_if(v).alias(k) for k, v in kinds.items()]), list(kinds), "kind", "rows")


def report_values(reports: DataFrame, column: str, keys) -> DataFrame:
    """Named values of JSON reports, one row for each report."""
    return reports.select("*", *[F.get_json_object(column, f"$.{k}").cast("double").alias(k) for k in keys]).drop(column)
