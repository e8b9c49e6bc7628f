"""Structured model corrections: requests, answers, adoption. The call itself is an effect behind a
``Provider``; without one, answers come from a table joined by key, so a run can be repeated."""

from __future__ import annotations

import random
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom import lexicon as L
from corpusloom.functions import text as X


@dataclass(frozen=True)
class CallSettings:
    """What each call to a model says besides the prompt."""

    model: str = "gpt-4o-mini"
    temperature: float = 0.0
    timeout_seconds: float = 30.0
    json_object: bool = True


@dataclass(frozen=True)
class Limits:
    """Rates of the service, over all tasks together, and how calls that fail are tried again."""

    requests_a_minute: float = 500.0
    tokens_a_minute: float = 200_000.0
    retries: int = 3
    base_seconds: float = 1.0
    #: Kinds of failure that another try may mend; others are the row's error at once.
    passing: tuple[type[BaseException], ...] = (TimeoutError, ConnectionError, OSError, RuntimeError, ValueError)


#: A batch of prompts (system, user) and the settings to answers. Raises to have the batch tried again.
Provider = Callable[[list[tuple[str, str]], CallSettings], list[str]]

_FIELDS = ", ".join(L.TARGETS)
SYSTEM = f"You correct one row of a parallel corpus. Answer with one JSON object: for each of {_FIELDS} an object with corrected and issues, and global_notes."
STRICT_SYSTEM = f"You correct machine translations. Mend {_FIELDS} with as few edits as the meaning needs; leave names, dates and numbers. Answer with one JSON object: for each field an object with corrected and issues, and global_notes."
CONSISTENCY_SYSTEM = f"You judge whether the four fields {_FIELDS} say the same. Answer with one JSON object: consistent, corrected (the four fields), issues, notes."
BATCH_SYSTEM = "You correct rows of a parallel corpus after their English. Answer with one JSON array, an object for each row: data_id, darija_arabic, darija_arabizi, modern_standard_arabic, status. Rows GENERATED need all three, rows PARTIALLY VALIDATED the last one."


def _fields(clean: Callable[[Column], Column] = X.as_text) -> Column:
    return F.struct(*[clean(F.col(c)).alias(c) for c in L.TARGETS])


def requests(df: DataFrame, key: str, system: str = SYSTEM) -> DataFrame:
    """The prompt of each row: the fields as a JSON object."""
    return df.select(key, F.lit(system).alias("system"), F.to_json(_fields()).alias("prompt"))


def strict_requests(df: DataFrame, key: str) -> DataFrame:
    """The order-preserving variant: artifacts are taken out, the fields stand under ``input``."""
    return df.select(key, F.lit(STRICT_SYSTEM).alias("system"), F.to_json(F.struct(_fields(X.drop_artifacts).alias("input"))).alias("prompt"))


def consistency_requests(df: DataFrame, key: str) -> DataFrame:
    """The semantic check: the fields, and the shape of the answer."""
    shape = F.struct(F.lit("bool").alias("consistent"), F.struct(*[F.lit("str").alias(c) for c in L.TARGETS]).alias("corrected"), F.array(F.lit("list[str]")).alias("issues"), F.lit("str").alias("notes"))
    return df.select(key, F.lit(CONSISTENCY_SYSTEM).alias("system"), F.to_json(F.struct(_fields().alias("input"), shape.alias("output_schema"))).alias("prompt"))


def batches(df: DataFrame, key: str, size: int = 10) -> DataFrame:
    """Rows by tens, each batch one request with a JSON array."""
    fields = F.struct(F.col(key).alias("data_id"), *L.TARGETS)
    rows = df.groupBy(F.floor((F.col("row_index") - 1) / size).alias("batch")).agg(F.array_sort(F.collect_list(F.struct("row_index", fields.alias("fields")))).alias("rows"))
    return rows.select("batch", F.lit(BATCH_SYSTEM).alias("system"), F.to_json(F.transform("rows", lambda r: r["fields"])).alias("prompt"), F.size("rows").alias("rows"))


class TokenBucket:
    """A task's share of the rates: requests and tokens fill up with time; a call waits for both."""

    def __init__(self, requests: float, tokens: float, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.rates = (requests / 60, tokens / 60)
        self.most = (max(1.0, requests), tokens)
        self.level, self.clock, self.sleep = list(self.most), clock, sleep
        self.last = clock()

    def take(self, tokens: float) -> None:
        need = (1.0, min(tokens, self.most[1]))
        while True:
            now = self.clock()
            self.level = [min(m, x + r * (now - self.last)) for m, x, r in zip(self.most, self.level, self.rates, strict=True)]
            self.last = now
            short = max((n - x) / r for n, x, r in zip(need, self.level, self.rates, strict=True))
            if short <= 1e-9:
                self.level = [x - n for x, n in zip(self.level, need, strict=True)]
                return
            self.sleep(short)


def call(provider: Provider, prompts: list[tuple[str, str]], settings: CallSettings, limits: Limits, bucket: TokenBucket) -> tuple[list[str | None], str | None]:
    """The answers, or none and the kind of the last failure. A try waits base * 2^n seconds and a
    jitter after the one before; tokens are estimated as a quarter of the characters."""
    error = None
    for attempt in range(limits.retries + 1):
        bucket.take(sum(len(s) + len(p) for s, p in prompts) / 4)
        try:
            return list(provider(prompts, settings)), None
        except limits.passing as problem:
            error = type(problem).__name__
            if attempt < limits.retries:
                bucket.sleep(limits.base_seconds * 2**attempt + random.random() * limits.base_seconds / 4)
        except Exception as problem:  # noqa: BLE001  any other failure of the service is the row's error
            return [None] * len(prompts), type(problem).__name__
    return [None] * len(prompts), error


def ask(df: DataFrame, provider: Provider, key: str, settings: CallSettings = CallSettings(), limits: Limits = Limits(), rows_a_call: int = 8, tasks: int | None = None) -> DataFrame:
    """Answers of a provider: key, response, error. Each of the ``tasks`` that run at once (by default
    as many as the cluster has cores) has its share of the rates."""
    together = tasks or df.sparkSession.sparkContext.defaultParallelism
    kind = df.schema[key].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bucket = TokenBucket(limits.requests_a_minute / together, limits.tokens_a_minute / together)
        for frame in frames:
            for start in range(0, len(frame), rows_a_call):
                part = frame.iloc[start : start + rows_a_call]
                answers, error = call(provider, list(zip(part["system"], part["prompt"], strict=True)), settings, limits, bucket)
                yield pd.DataFrame({key: part[key].values, "response": answers, "error": error})

    return df.mapInPandas(run, f"{key} {kind}, response string, error string")


def without_fences(c: Column) -> Column:
    """Lines that open or close a code block go."""
    return X.sub(X.sub(X.as_text(c), r"(?m)^\s*```.*$", ""), f"^{X.W}+|{X.W}+$", "")


def array_part(c: Column) -> Column:
    """From the first opening bracket to the last closing one."""
    return F.regexp_extract(X.as_text(c), r"(?s)\[.*\]", 0)


def parse_answer(df: DataFrame, response: str = "response") -> DataFrame:
    """``answer_<field>`` (null if absent), ``issues`` of each field (a single one becomes a list),
    ``global_notes`` and ``parsed``."""
    text = without_fences(F.col(response))
    fields = {}
    for c in L.TARGETS:
        issues = F.get_json_object(text, f"$.{c}.issues")
        listed = F.from_json(issues, "array<string>")
        fields[f"answer_{c}"] = X.sub(F.get_json_object(text, f"$.{c}.corrected"), f"^{X.W}+|{X.W}+$", "")
        fields[f"issues_{c}"] = F.when(issues.startswith("["), listed).when(issues.isNotNull(), F.array(issues)).otherwise(F.array().cast("array<string>"))
    parsed = F.get_json_object(text, "$").isNotNull() & text.startswith("{")
    return df.withColumns(fields | {"global_notes": F.coalesce(F.get_json_object(text, "$.global_notes"), F.lit("")), "parsed": F.coalesce(parsed, F.lit(False))})


def adopt(df: DataFrame, clean: Callable[[Column], Column] = X.hyphenate_artifacts, blank_counts: bool = False) -> DataFrame:
    """Take each field's answer, cleaned, unless it is absent or (without ``blank_counts``) blank;
    ``changed_fields`` names what differs from before, joined by semicolons."""
    changed, columns = [], {}
    for c in L.TARGETS:
        before = X.sub(X.as_text(F.col(c)), f"^{X.W}+|{X.W}+$", "")
        candidate = clean(F.col(f"answer_{c}"))
        usable = F.col(f"answer_{c}").isNotNull() & (F.lit(True) if blank_counts else candidate != "")
        after = F.when(usable, candidate).otherwise(before)
        columns[c] = after
        changed.append(F.when(after != before, F.lit(c)))
    return df.withColumns(columns | {"changed_fields": F.array_join(F.array_compact(F.array(*changed)), ";")})


def outcome(df: DataFrame) -> DataFrame:
    """``status`` VALIDATED or ERROR, and ``qc_notes``: the error's kind, or the issues found."""
    notes = F.concat_ws("; ", *[F.when(F.size(f"issues_{c}") > 0, F.concat(F.lit(f"{c}: "), F.array_join(f"issues_{c}", ", "))) for c in L.TARGETS], F.nullif("global_notes", F.lit("")))
    failed = F.col("error").isNotNull() | ~F.col("parsed")
    return df.withColumns({"status": F.when(failed, "ERROR").otherwise("VALIDATED"), "qc_notes": F.when(failed, F.concat(F.lit("ERROR:"), F.coalesce("error", F.lit("ParseError")))).otherwise(notes)})


def restore_immutable(df: DataFrame, original: DataFrame, key: str, columns=("id", "classe", "english", "english_word_count")) -> DataFrame:
    """What a correction must never change comes from the original row, whatever the answer says."""
    kept = original.select(F.col(key).alias("__key"), *[F.col(c).alias(f"__{c}") for c in columns])
    joined = df.join(kept, F.col(key) == F.col("__key"), "left")
    known = F.col("__key").isNotNull()
    return joined.select(*[F.when(known, F.col(f"__{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in df.columns])


def zip_batches(rows: DataFrame, answers: DataFrame, size: int = 10, by_key: str | None = None) -> DataFrame:
    """Rows with the element of their batch's answer array: by position, where a short array leaves
    the last rows out, or by ``by_key``."""
    kind = "array<struct<" + ",".join(f"{c}:string" for c in ("data_id", *L.TARGETS, "status")) + ">>"
    items = answers.select("batch", F.posexplode(F.from_json(array_part(F.col("response")), kind)).alias("pos", "answer"))
    placed = rows.withColumns({"batch": F.floor((F.col("row_index") - 1) / size), "pos": F.pmod(F.col("row_index") - 1, F.lit(size))})
    on = ["batch", "pos"] if by_key is None else [placed["batch"] == items["batch"], placed[by_key] == items["answer.data_id"]]
    joined = placed.join(items if by_key is None else items.withColumnRenamed("batch", "b").drop("pos"), on if by_key is None else [F.col("batch") == F.col("b"), F.col(by_key) == F.col("answer.data_id")])
    return joined.drop("batch", "pos", "b")
