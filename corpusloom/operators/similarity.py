"""Agreement of language pairs from embedding vectors, and the flags that follow from it."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom import lexicon as L


def embedding_input(c: Column) -> Column:
    return F.when(c == "", "[empty]").otherwise(c)


def embed(df: DataFrame, provider: Callable[[list[str]], list[list[float]]], key: str, columns=L.TARGETS, texts_a_call: int = 64) -> DataFrame:
    """``key`` and a vector for each field, ``vector_<field>``, by a provider of embeddings; a row's
    blank field is asked for as ``[empty]``. Rows are sent in batches, each text of a batch once."""
    kind = df.schema[key].dataType.simpleString()
    given = df.select(key, *[embedding_input(F.coalesce(F.col(c), F.lit(""))).alias(c) for c in columns])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = list(dict.fromkeys(t for c in columns for t in frame[c]))
            known: dict[str, list[float]] = {}
            for start in range(0, len(texts), texts_a_call):
                part = texts[start : start + texts_a_call]
                known.update(zip(part, provider(part), strict=True))
            yield pd.DataFrame({key: frame[key].values} | {f"vector_{c}": [known[t] for t in frame[c]] for c in columns})

    return given.mapInPandas(run, f"{key} {kind}, " + ", ".join(f"vector_{c} array<double>" for c in columns))


def failure_rows(df: DataFrame, error: str = "error") -> DataFrame:
    """Rows whose check failed (``error`` says how): scores of 0, suspicious, low, and a note; others
    as they are. Columns that are missing are made."""
    failed, has = F.col(error).isNotNull(), set(df.columns)
    old = lambda c, kind: F.col(c) if c in has else F.lit(None).cast(kind)
    scores = {c: F.when(failed, F.lit(0.0)).otherwise(old(c, "double")) for c in ("similarity_score", *[f"similarity_{n}" for n, _, _ in L.PAIRS])}
    said = F.concat(F.lit("Runtime error during semantic check: "), F.col(error))
    notes = F.when(failed, merge_notes(old("qc_notes", "string"), said)).otherwise(old("qc_notes", "string"))
    return df.withColumns(scores | {"consistency_flag": F.when(failed, "SUSPICIOUS").otherwise(old("consistency_flag", "string")), "low_similarity": F.when(failed, F.lit(True)).otherwise(old("low_similarity", "boolean")), "qc_notes": notes})


def token_totals(df: DataFrame, model: str = "gpt-4o-mini", score: str | None = None) -> DataFrame:
    """One row: tokens, tokens a row, US dollars and, if there is one, the mean score, failures as 0."""
    prompt, completion = (F.coalesce(F.sum(c), F.lit(0)).cast("long") for c in ("prompt_tokens", "completion_tokens"))
    totals = df.agg(F.count("*").alias("rows"), prompt.alias("prompt_tokens"), completion.alias("completion_tokens"), *([F.round(F.avg(F.coalesce(score, F.lit(0.0))), 4).alias("mean_score")] if score else []))
    each = {f"{c}_a_row": F.when(F.col("rows") > 0, F.round(F.col(c) / F.col("rows"), 2)).otherwise(0.0) for c in ("prompt_tokens", "completion_tokens")}
    return totals.withColumns(each | {"cost": cost(F.col("prompt_tokens"), F.col("completion_tokens"), F.lit(model))})


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """0 if either vector has no length."""
    norms = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norms > 0, dot(a, b) / norms).otherwise(0.0)


def pair_scores(df: DataFrame, vectors: dict[str, str], decimals: int = 6) -> DataFrame:
    """``similarity_*`` of the three language pairs and their mean; vectors: column of each field."""
    raw = {f"similarity_{name}": cosine(F.col(vectors[a]), F.col(vectors[b])) for name, a, b in L.PAIRS}
    out = df.withColumns(raw).withColumn("similarity_score", sum(F.col(c) for c in raw) / len(raw))
    # adding 0 turns a negative zero into the usual one
    return out.withColumns({c: F.round(F.col(c), decimals) + 0.0 for c in ("similarity_score", *raw)})


def classify(score: Column, threshold: float = 0.80, model_threshold: float | None = None, low: float = 0.5) -> dict[str, Column]:
    """suspicious, whether the model is asked, low similarity. All comparisons are strict."""
    model_threshold = threshold if model_threshold is None else model_threshold
    if model_threshold > threshold:
        raise ValueError("the model's threshold must not be above the threshold")
    return {"suspicious": score < threshold, "ask_model": (score < threshold) & (score < model_threshold), "low_similarity": score < low}


def consistency_flag(suspicious: Column, asked: Column, changed: Column, consistent: Column) -> Column:
    """The final flag: asked is whether the model gave an answer."""
    answered = F.when(changed, "CORRECTED").when(consistent, "CONSISTENT").otherwise("SUSPICIOUS")
    return F.when(~suspicious, "CONSISTENT").when(~asked, "SUSPICIOUS").otherwise(answered)


def note(score: Column, threshold: float) -> Column:
    return F.when(score < threshold, F.format_string(f"similarity %.3f below {threshold:.2f}", score)).otherwise("")


def merge_notes(a: Column, b: Column) -> Column:
    return F.concat_ws(" | ", F.nullif(F.trim(F.coalesce(a, F.lit(""))), F.lit("")), F.nullif(F.trim(F.coalesce(b, F.lit(""))), F.lit("")))


def cost(prompt: Column, completion: Column, model: Column, default: str = "gpt-4o-mini") -> Column:
    """US dollars at list prices, in decimals, rounded half up to a millionth; an unknown model costs
    as the default one."""
    def price(k: int) -> Column:
        out = F.lit(L.PRICES[default][k])
        for name, prices in L.PRICES.items():
            out = F.when(model == name, F.lit(prices[k])).otherwise(out)
        return out.cast("decimal(4,2)")

    millionths = prompt.cast("decimal(18,0)") * price(0) + completion.cast("decimal(18,0)") * price(1)
    return (F.round(millionths, 0) / 1_000_000).cast("decimal(18,6)").cast("double")
