"""Writers: CSV in a fixed order, JSON reports, checkpoints, label-tool rows, Markdown reports."""

from __future__ import annotations

from pathlib import PurePath

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom import lexicon as L
from corpusloom.functions import text as X
from corpusloom.operators import profile

LABEL_COLUMNS = ("annotation_id", "annotator", "classe", "corrected_darija_arabic", "corrected_darija_arabizi", "corrected_english", "corrected_msa", "created_at", "darija_arabic", "darija_arabizi", "data_id", "decision", "english", "english_word_count", "id", "lead_time", "modern_standard_arabic", "status", "updated_at")


def write_csv(df: DataFrame, path: str, columns=None, order: str | None = None, single: bool = False, encoding: str = "UTF-8") -> None:
    """``columns`` first, others after them unless ``columns`` is all; in ``order`` if one is named.
    One file only on request: it needs one task."""
    out = df.orderBy(order) if order else df
    out = out.select(*columns) if columns else out
    if single:
        out = out.coalesce(1)
    out.write.mode("overwrite").options(header=True, encoding=encoding, quote='"', escape='"', emptyValue="", nullValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)


def columns_with_extras(original: list[str], extras: list[str]) -> list[str]:
    return [*original, *[c for c in extras if c not in original]]


def write_report(report: DataFrame, path: str) -> None:
    """A one-row aggregate as a JSON object with indents."""
    report.select(F.to_json(F.struct("*"), {"pretty": "true", "ignoreNullFields": "false"}).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def append_checkpoint(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def snapshot(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def snapshot_when_due(df: DataFrame, path: str, done: int, every: int = 50) -> bool:
    """A snapshot after each ``every`` batches; whether it was made."""
    if done % every:
        return False
    snapshot(df, path)
    return True


def preview(df: DataFrame, rows: int = 3, width: int = 80) -> str:
    """The first rows as text, a line for each cell, for a console or a dry run."""
    lines = []
    for k, row in enumerate(df.limit(rows).collect(), 1):
        lines += [f"row {k}", *[f"  {c}: {str(v)[:width]}" for c, v in row.asDict().items()]]
    return "\n".join(lines)


def differences(before: DataFrame, after: DataFrame, key: str, columns, rows: int = 10) -> str:
    """The first rows whose cells differ, as lines of - and +."""
    new = after.select(F.col(key).alias("__key"), *[F.col(c).alias(f"__{c}") for c in columns])
    changed = F.lit(False)
    for c in columns:
        changed = changed | ~F.col(c).eqNullSafe(F.col(f"__{c}"))
    lines = []
    for row in before.join(new, F.col(key) == F.col("__key")).where(changed).orderBy(key).limit(rows).collect():
        lines.append(f"@ {row[key]}")
        for c in columns:
            if row[c] != row[f"__{c}"]:
                lines += [f"- {c}: {row[c]}", f"+ {c}: {row[f'__{c}']}"]
    return "\n".join(lines)


def label_rows(df: DataFrame, time_text: str = "") -> DataFrame:
    """Rows for a labelling tool: corrections are the fields themselves, to be edited."""
    has = set(df.columns)
    given = {"corrected_darija_arabic": "darija_arabic", "corrected_darija_arabizi": "darija_arabizi", "corrected_english": "english", "corrected_msa": "modern_standard_arabic"}
    out = []
    for c in LABEL_COLUMNS:
        if c in ("created_at", "updated_at"):
            value = F.lit(time_text)
        elif c == "english_word_count" and c not in has:
            value = X.word_count(F.col("english"))
        else:
            value = F.col(given.get(c, c)) if given.get(c, c) in has else F.lit("")
        out.append(X.as_text(value).alias(c))
    return df.select(*out)


#: What is put after the stem of an input's name, by kind of run.
SUFFIXES = {
    "auto": ("corrected.auto.csv", "report.json", "ckpt.jsonl"),
    "all4": ("all4.corrected.csv", "all4.report.json", "all4.corrected.csv.ckpt.jsonl"),
    "cleaned": ("cleaned.csv", "cleaning_report.json"),
}


def derived_paths(source: str, kind: str = "auto") -> dict[str, str]:
    stem = str(PurePath(source).with_suffix(""))
    return {k: f"{stem}.{k}" for k in SUFFIXES[kind]}


def _table(title: str, header: list[str], rows: list) -> list[str]:
    return [f"## {title}", "", "| " + " | ".join(header) + " |", "|" + " --- |" * len(header), *["| " + " | ".join(map(str, r)) + " |" for r in rows], ""]


def shard_report(df: DataFrame, shard: str, changed: str = "changed_fields", examples: int = 10, errors: int = 20, width: int = 30) -> str:
    """Markdown of one shard: totals, by status and class, corrected fields, anomalies, a few examples
    and errors. A line for every group; rows come one partition at a time."""
    total, touched, failed = df.agg(F.count("*"), F.count_if(F.col(changed) != ""), F.count_if(F.col("status") == "ERROR")).first()
    lines = [f"# Shard {shard}", "", f"- rows: {total}", f"- corrected: {touched}", f"- errors: {failed}", ""]
    for by in ("status", "classe"):
        rows = df.groupBy(F.coalesce(F.col(by), F.lit("UNKNOWN")).alias(by)).agg(F.count("*"), F.count_if(F.col(changed) != "")).orderBy(by).toLocalIterator()
        lines += _table(f"By {by}", [by, "rows", "corrected"], rows)
    kinds = df.select(F.explode(F.split(changed, ";")).alias("field")).where("field <> ''").groupBy("field").count().orderBy("field").collect()
    lines += _table("Corrected fields", ["field", "rows"], kinds)
    counts = profile.anomalies(df).drop("rows").first()
    lines += _table("Anomalies", ["anomaly", "rows"], counts.asDict().items())
    shown = df.where(F.col(changed) != "").orderBy("row_index").limit(examples).select("data_id", changed, *[F.substring(c, 1, width).alias(c) for c in L.TARGETS]).collect()
    lines += _table("Examples", ["data_id", "fields", *L.TARGETS], shown)
    bad = df.where("status = 'ERROR'").orderBy("row_index").limit(errors).select("data_id", "qc_notes").collect()
    lines += _table("Errors", ["data_id", "note"], bad)
    return "\n".join(lines)


def global_report(df: DataFrame, shard: str = "shard", changed: str = "changed_fields") -> str:
    """Markdown over all shards: a line for every shard, status and class, with totals."""
    sums = (F.count("*").alias("rows"), F.count_if(F.col(changed) != "").alias("corrected"), F.count_if(F.col("status") == "ERROR").alias("errors"))
    lines = ["# All shards", ""]
    for title, by in (("Shards", shard), ("By status", "status"), ("By classe", "classe")):
        named = df.withColumn("__by", F.coalesce(F.col(by).cast("string"), F.lit("UNKNOWN")))
        rows = named.rollup("__by").agg(*sums).orderBy(F.col("__by").asc_nulls_last()).toLocalIterator()
        lines += _table(title, [by, "rows", "corrected", "errors"], [(r[0] if r[0] is not None else "all", *r[1:]) for r in rows])
    return "\n".join(lines)
