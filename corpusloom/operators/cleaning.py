"""Cleaning of a parallel corpus: one projection, one drop reason a row, counters from one pass."""

from __future__ import annotations

import functools
import warnings
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom import lexicon as L
from corpusloom.functions import arabic as A
from corpusloom.functions import batches as B
from corpusloom.functions import rows as R
from corpusloom.functions import text as X


@dataclass(frozen=True)
class CleaningOptions:
    english_normalization: str = "none"  # none, stem or lemma; a lemma needs a dictionary that is not here: a warning
    expand_contractions: bool = False
    split_arabic_clitics: bool = False
    split_darija_negation: bool = False
    light_arabic_stemming: bool = False
    transliterate_arabizi: bool = False
    arabizi_drop_vowels: bool = False
    arabizi_most_repeats: int = 2
    emoji_replacement: str = " "
    html_entities: bool = True
    keep_metadata: bool = False
    keep_leakage: bool = False
    drop_statuses: tuple[str, ...] = ("ERROR",)
    english_stopwords: tuple[str, ...] = L.ENGLISH_STOPWORDS
    msa_stopwords: tuple[str, ...] = L.ARABIC_STOPWORDS
    darija_stopwords: tuple[str, ...] = L.DARIJA_STOPWORDS
    arabizi_stopwords: tuple[str, ...] = L.ARABIZI_STOPWORDS

    def __post_init__(self):
        if self.english_normalization not in ("none", "stem", "lemma"):
            raise ValueError(f"unknown normalization: {self.english_normalization}")
        if self.english_normalization == "lemma":
            warnings.warn("no dictionary of lemmas is at hand; English words stay as they are", stacklevel=2)


def listed(words: str) -> tuple[str, ...]:
    """Stop words from a list with commas, trimmed and in lower case."""
    return tuple(w for w in (part.strip().lower() for part in words.split(",")) if w)


def require_columns(df: DataFrame, columns=L.TARGETS) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def cleaned_columns(o: CleaningOptions) -> dict[str, Column]:
    base = {c: X.universal_cleanup(F.col(c), o.emoji_replacement, o.html_entities) for c in L.TARGETS}
    return {
        "english": X.clean_english(base["english"], o.english_stopwords, o.expand_contractions, o.english_normalization == "stem"),
        "modern_standard_arabic": A.clean_msa(base["modern_standard_arabic"], o.msa_stopwords, o.split_arabic_clitics, o.light_arabic_stemming),
        "darija_arabic": A.clean_darija(base["darija_arabic"], o.darija_stopwords, o.split_arabic_clitics, o.split_darija_negation, o.light_arabic_stemming),
        "darija_arabizi": A.clean_arabizi(base["darija_arabizi"], o.arabizi_stopwords, o.darija_stopwords, o.arabizi_most_repeats, not o.arabizi_drop_vowels, o.transliterate_arabizi, o.light_arabic_stemming),
    }


def in_rows(o: CleaningOptions) -> bool:
    """Whether ``rows`` has all that the options ask for; other options take the expressions."""
    more = (o.expand_contractions, o.split_arabic_clitics, o.split_darija_negation, o.light_arabic_stemming, o.transliterate_arabizi)
    return not any(more) and o.english_normalization != "stem" and o.emoji_replacement == " "


@functools.lru_cache(maxsize=8)
def _cleaners(o: CleaningOptions) -> dict:
    return {
        "darija_arabic": R.darija(A.normalized_words(o.darija_stopwords, fold=True)),
        "darija_arabizi": R.arabizi(o.arabizi_stopwords, o.arabizi_most_repeats, not o.arabizi_drop_vowels),
        "english": R.english(o.english_stopwords),
        "modern_standard_arabic": R.msa(A.normalized_words(o.msa_stopwords, fold=False)),
    }


def _cleaned_row(o: CleaningOptions, texts, bad_status: bool, full: bool) -> dict:
    """Of one row, what clean_corpus returns; without ``full`` the reason alone."""
    clean = {c: f(R.loosened(t or "", o.html_entities)) for (c, f), t in zip(_cleaners(o).items(), texts, strict=True)}
    reason = None
    if not o.keep_metadata and any(map(R.reads_like_metadata, clean.values())):
        reason = "metadata"
    elif not o.keep_leakage and R.has_darija_marker(clean["modern_standard_arabic"]):
        reason = "leakage"
    elif bad_status:
        reason = "status"
    elif not all(clean.values()):
        reason = "empty"
    if not full:
        return {"drop_reason": reason}
    placed = {c: R.replace_placeholders(t, c) for c, t in clean.items()}
    single = {c: R.drop_repeats(t) for c, (t, _) in placed.items()}
    if reason is None:
        clean = {c: t for c, (t, _) in single.items()}
    counts = {"placeholders_removed": sum(n for _, n in placed.values()), "repeats_removed": sum(n for _, n in single.values())}
    return clean | counts | {"drop_reason": reason, "english_word_count": len(clean["english"].split())}


@functools.lru_cache(maxsize=8)
def _lookups(o: CleaningOptions) -> dict | None:
    """The stop words for ``batches``, unless a list is too long for it."""
    lists = {
        "darija_arabic": B.coded(A.normalized_words(o.darija_stopwords, fold=True), True),
        "darija_arabizi": B.coded(o.arabizi_stopwords, False),
        "english": B.coded(o.english_stopwords, False),
        "modern_standard_arabic": B.coded(A.normalized_words(o.msa_stopwords, fold=False), True),
    }
    return {c: B.Lookup(words) for c, words in lists.items()} if all(map(B.short, lists.values())) else None


_REASONS = np.array([None, "metadata", "leakage", "status", "empty"], object)


def _cleaned_batch(o: CleaningOptions, types: dict[str, str], texts, bad_status: pa.Array) -> list[pa.Array]:
    """Of some rows at once, what _cleaned_row returns of each."""
    clean = B.columns(dict(zip(L.TARGETS, texts, strict=True)), _lookups(o), o.html_entities, o.arabizi_most_repeats, not o.arabizi_drop_vowels)
    reason = np.zeros(len(bad_status), np.int8)
    for c in clean.values():  # the first reason is written last
        reason[np.diff(c.ends) == 1] = 4
    reason[bad_status.fill_null(False).to_numpy(zero_copy_only=False)] = 3
    if not o.keep_leakage:
        reason[clean["modern_standard_arabic"].marked] = 2
    if not o.keep_metadata:
        for c in clean.values():
            reason[c.metadata()] = 1
    out = {"drop_reason": pa.array(_REASONS[reason], pa.string())}
    if len(types) > 1:
        stays = reason == 0
        placeholders, repeats, words = (np.zeros(len(reason), np.int32), np.zeros(len(reason), np.int32), clean["english"].word_counts.astype(np.int32))
        for c, column in clean.items():
            new = column.less(placeholders, repeats)
            if c == "english":
                words -= np.where(stays, np.bincount(column.repeat_rows, minlength=len(words)), 0).astype(np.int32)
                for r in new:
                    words[r] = len((new[r] if stays[r] else column.text(r)).split())
            if c in types:
                out[c] = column.final(new, stays)
        out |= {"placeholders_removed": pa.array(placeholders), "repeats_removed": pa.array(repeats), "english_word_count": pa.array(words)}
    return [out[c] for c in types]


def _changed_row(o: CleaningOptions, texts, _bad_status: bool) -> dict:
    """Of one row, whether each text is another one after it was cleaned. No cleaned text has a full stop
    or a comma, so that a text with one need not be cleaned to tell."""
    changed = lambda t, f: "." in t or "," in t or R.collapse(t) != f(R.loosened(t, o.html_entities))
    return {c: changed(t or "", f) for (c, f), t in zip(_cleaners(o).items(), texts, strict=True)}


_TYPES = {c: "string" for c in (*L.TARGETS, "drop_reason")} | {c: "int" for c in ("placeholders_removed", "repeats_removed", "english_word_count")}


def _by_rows(of, types: dict[str, str], status: Column, batch=None) -> Column:
    """A struct of ``of`` each row's four texts and its status; ``batch``, if given, has the arrays of
    many rows at once."""
    schema = pa.struct([(c, {"string": pa.string(), "int": pa.int32(), "boolean": pa.bool_()}[t]) for c, t in types.items()])

    def run(*arrays: pa.Array) -> pa.Array:
        done = []
        for at in range(0, len(arrays[0]), 256):  # few rows at a time are Python's
            *texts, bad = [a.slice(at, 256) for a in arrays]
            if batch:
                done.append(pa.StructArray.from_arrays(batch(texts, bad), fields=list(schema)))
                continue
            part = zip(*[a.to_pylist() for a in (*texts, bad)], strict=True)
            done.append(pa.array([{c: row[c] for c in types} for row in (of(texts, bad) for *texts, bad in part)], schema))
        return pa.concat_arrays(done) if done else pa.array([], schema)

    run.__annotations__ = {"arrays": pa.Array, "return": pa.Array}
    udf = F.arrow_udf(run, ", ".join(f"{c} {t}" for c, t in types.items()))
    return udf(*[F.col(c).cast("string") for c in L.TARGETS], status)


def changed_cells(df: DataFrame, o: CleaningOptions = CleaningOptions()) -> DataFrame:
    """Of each text column, whether cleaning changes the cell by more than white space."""
    if in_rows(o):
        flags = _by_rows(functools.partial(_changed_row, o), {c: "boolean" for c in L.TARGETS}, F.lit(False))
        return df.select(flags.alias("changed")).select("changed.*")
    cleaned = cleaned_columns(o)
    return df.select(*[(X.collapse(F.col(c)) != X.collapse(cleaned[c])).alias(c) for c in L.TARGETS])


def _bad_status(df: DataFrame, o: CleaningOptions) -> Column:
    return F.upper(F.trim(X.as_text(F.col("status")))).isin(*o.drop_statuses) if "status" in df.columns and o.drop_statuses else F.lit(False)


def _cleaning(df: DataFrame, o: CleaningOptions, types: dict[str, str]) -> Column:
    batch = functools.partial(_cleaned_batch, o, types) if _lookups(o) else None
    return _by_rows(functools.partial(_cleaned_row, o, full=len(types) > 1), types, _bad_status(df, o), batch)


def drop_reasons(df: DataFrame, columns, o: CleaningOptions = CleaningOptions()) -> DataFrame:
    """``columns`` of each row, and why cleaning drops it."""
    if in_rows(o):
        row = _cleaning(df, o, {"drop_reason": "string"})
        return df.select(*columns, row.alias("__row")).select(*columns, "__row.drop_reason")
    df = df.withColumns(cleaned_columns(o))
    return df.select(*columns, drop_reason(df, o).alias("drop_reason"))


def require_text(df: DataFrame, columns=L.TARGETS) -> DataFrame:
    """The rows without a blank cell in ``columns``, which must be there."""
    require_columns(df, columns)
    blank = F.lit(False)
    for c in columns:
        blank = blank | X.is_blank(F.col(c))
    return df.where(~blank)


def drop_reason(df: DataFrame, o: CleaningOptions, lower: str = "") -> Column:
    """The first filter that a cleaned row fails; null for a row that stays. Cleaned texts have single
    spaces; columns that begin with ``lower``, if named, are the texts in lower case."""
    never = F.lit(False)
    metadata = never if o.keep_metadata else F.expr("false")
    if not o.keep_metadata:
        for c in L.TARGETS:
            metadata = metadata | X.reads_like_metadata(F.col(f"{lower}{c}") if lower else F.lower(c))
    leakage = never if o.keep_leakage else X.has_darija_marker(F.col("modern_standard_arabic"))
    status = _bad_status(df, o)
    empty = F.expr(" OR ".join(f"{c} = ''" for c in L.TARGETS))
    return F.when(metadata, "metadata").when(leakage, "leakage").when(status, "status").when(empty, "empty")


def clean_corpus(df: DataFrame, options: CleaningOptions = CleaningOptions(), texts=L.TARGETS) -> DataFrame:
    """Every row with cleaned columns, ``drop_reason``, ``placeholders_removed``, ``repeats_removed``
    and, where there is an ``english_word_count``, its new value and whether it changed. Take rows by
    ``kept`` or ``chosen``: a filter on a computed column would compute it twice. Of the four text
    columns, those in ``texts`` are returned."""
    require_columns(df)
    if in_rows(options):
        return _clean_in_rows(df, options, texts)
    # a projection for each step, so that no step's text is computed more than once
    out = df.withColumns(cleaned_columns(options))
    out = out.withColumns({f"__low_{c}": F.lower(c) for c in L.TARGETS})
    terms = {c: X.replace_placeholders(F.col(c), L.PLACEHOLDERS[c]) for c in L.TARGETS}
    removed = {"placeholders_removed": sum((n for _, n in terms.values()), F.lit(0))}
    out = out.withColumns({"drop_reason": drop_reason(out, options, "__low_")} | removed | {f"__text_{c}": t for c, (t, _) in terms.items()})
    stays = F.col("drop_reason").isNull()
    single = {c: X.drop_repeats(F.col(f"__text_{c}")) for c in L.TARGETS}
    repeats = sum((n for _, n in single.values()), F.lit(0))
    out = out.withColumns({c: F.when(stays, t).otherwise(F.col(c)) for c, (t, _) in single.items()} | {"repeats_removed": repeats})
    out = out.drop(*[f"__{k}_{c}" for k in ("text", "low") for c in L.TARGETS])
    if "english_word_count" in df.columns:
        before = F.coalesce(F.expr("try_cast(english_word_count as int)"), F.lit(-1))
        out = out.withColumn("word_count_changed", before != X.word_count(F.col("english"))).withColumn("english_word_count", X.word_count(F.col("english")))
    return out.drop("qc_changed_fields", "qc_notes", *(c for c in L.TARGETS if c not in texts))


def _clean_in_rows(df: DataFrame, o: CleaningOptions, texts) -> DataFrame:
    types = {c: t for c, t in _TYPES.items() if c in texts or c not in L.TARGETS}
    row = _cleaning(df, o, types)
    gone = {"qc_changed_fields", "qc_notes", "drop_reason", "placeholders_removed", "repeats_removed", "word_count_changed", *(c for c in L.TARGETS if c not in texts)}
    new, counted = {c: F.col(f"__row.{c}") for c in types}, "english_word_count" in df.columns
    out = [new.get(c, F.col(f"`{c}`")).alias(c) for c in df.columns if c not in gone]
    out += [new[c].alias(c) for c in ("drop_reason", "placeholders_removed", "repeats_removed")]
    if counted:
        before = F.coalesce(F.expr("try_cast(english_word_count as int)"), F.lit(-1))
        out.append((before != new["english_word_count"]).alias("word_count_changed"))
    return df.withColumn("__row", row).select(*out)


def chosen(cleaned: DataFrame, keep: Column, columns) -> DataFrame:
    """The rows where ``keep`` holds. A plain filter would be pushed below the projections, and with
    it a second copy of all cleaning; through an array of at most one row it stays where it is."""
    row = F.when(keep, F.array(F.struct(*columns)))
    return cleaned.select(F.explode_outer(row).alias("row")).where("row is not null").select("row.*")


def kept(cleaned: DataFrame) -> DataFrame:
    columns = [c for c in cleaned.columns if c not in ("drop_reason", "placeholders_removed", "repeats_removed", "word_count_changed")]
    return chosen(cleaned, F.col("drop_reason").isNull(), columns)


def stage_counts(cleaned: DataFrame) -> DataFrame:
    """One row: input, dropped for each reason, output, and what was taken out of the output."""
    reason, stays = F.col("drop_reason"), F.col("drop_reason").isNull()
    changed = F.count_if(stays & F.col("word_count_changed")) if "word_count_changed" in cleaned.columns else F.lit(0)
    return cleaned.agg(
        F.count("*").alias("input_rows"),
        *[F.count_if(reason == r).alias(f"dropped_{r}") for r in ("metadata", "leakage", "status", "empty")],
        F.count_if(stays).alias("output_rows"),
        F.coalesce(F.sum(F.when(stays, F.col("placeholders_removed"))), F.lit(0)).cast("long").alias("placeholder_removals"),
        F.coalesce(F.sum(F.when(stays, F.col("repeats_removed"))), F.lit(0)).cast("long").alias("duplicate_token_removals"),
        changed.alias("word_count_recomputed_rows"),
    )


def top_words(df: DataFrame, column: str, order: str, n: int = 100) -> DataFrame:
    """The n most frequent words, ties to the one seen first. Map-side sums, then a top-k."""
    # the outer form: of the other one a filter on the size of the array is inferred and pushed down
    words = df.select(F.col(order).alias("row"), F.posexplode_outer(X.tokens(F.col(column))).alias("pos", "word")).where("word is not null")
    counted = words.groupBy("word").agg(F.count("*").alias("count"), F.min(F.struct("row", "pos")).alias("first"))
    return counted.orderBy(F.desc("count"), "first").limit(n).select("word", "count")


def top_words_before_empty(cleaned: DataFrame, column: str, order: str, n: int = 100) -> DataFrame:
    """As the cleaner counts them: after the other filters, before rows with empty columns go."""
    stays = F.coalesce(F.col("drop_reason") == "empty", F.lit(True))
    return top_words(cleaned.select(order, F.when(stays, F.col(column)).alias(column)), column, order, n)
