"""Row flags and their roll-up. Inferred from published reports, which name the flags and their
thresholds; how the flags were computed is not public, so these are definitions of our own."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom import lexicon as L
from corpusloom.functions import arabic as A
from corpusloom.functions import text as X


@dataclass(frozen=True)
class ProfileOptions:
    """Options that reports of the later cleaner name; what each does is inferred from its name."""

    final_taa: str = "keep"  # haa: a final ta marbuta becomes ha
    normalize_hamza: bool = False
    g_standard: str = "ڭ"
    v_standard: str = "ف"
    laugh_token: str | None = "<LAUGH>"
    least_words: int = 1
    most_words: int = 180
    missing: str = "flag"  # or remove


def standardize(c: Column, o: ProfileOptions = ProfileOptions()) -> Column:
    """Arabic-script spelling by the options: letters for g and v, final taa, hamza, laughter."""
    c = F.translate(X.as_text(c), "گڨݣڤپ", o.g_standard * 3 + o.v_standard + "ب")
    if o.normalize_hamza:
        c = F.translate(c, "أإآؤئ", "اااوي")
    if o.final_taa == "haa":
        c = X.sub(c, f"ة({X.W}|$)", "ه$1")
    if o.laugh_token:
        c = X.sub(c, f"(^|{X.W})(?:[هخ]{{3,}}|(?i:(?:ha){{2,}}h?|(?:kh){{2,}}|lo+l))({X.W}|$)", f"$1{o.laugh_token}$2")
    return c


def has_latin(c: Column) -> Column:
    return X.as_text(c).rlike("[A-Za-z]")


def has_arabic(c: Column) -> Column:
    return X.as_text(c).rlike(r"[\x{600}-\x{6FF}]")


def length_discrepancy(columns, most_chars: float = 8.0, most_words: float = 6.0, least: int = 3) -> Column:
    """Of fields with enough characters, the longest is too many times the shortest."""
    chars = F.filter(F.array(*[X.char_length(F.col(c)) for c in columns]), lambda n: n >= least)
    counts = F.filter(F.array(*[F.when(X.char_length(F.col(c)) >= least, X.word_count(F.col(c))) for c in columns]), lambda n: n > 0)
    ratio = lambda a: F.array_max(a) / F.array_min(a)
    return F.coalesce(ratio(chars) > most_chars, F.lit(False)) | F.coalesce(ratio(counts) > most_words, F.lit(False))


def word_bounds(columns, least: int = 1, most: int = 1000) -> Column:
    out = F.lit(False)
    for c in columns:
        out = out | ~X.word_count(F.col(c)).between(least, most)
    return out


def incoherence(most: float = 0.8) -> Column:
    """The Arabizi field, transliterated, is too far from the Arabic one (edit distance by length)."""
    a = A.normalize(X.transliterate(F.lower(X.as_text(F.col("darija_arabizi")))), True, True)
    b = A.normalize(F.col("darija_arabic"), True, True)
    longest = F.greatest(F.char_length(a), F.char_length(b))
    return F.when(longest > 0, F.levenshtein(a, b) / longest > most).otherwise(False)


def flag_rows(df: DataFrame, least: int = 1, most: int = 1000, coherence: bool = True, missing: str = "remove") -> DataFrame:
    """``issues`` (several are possible) and ``row_status``: REMOVED, FLAGGED or CLEAN. Rows out of the
    bounds of words are removed or, if ``missing`` is flag, flagged."""
    flags = {
        "darija_arabic_contains_latin": has_latin(F.col("darija_arabic")),
        "msa_contains_latin": has_latin(F.col("modern_standard_arabic")),
        "arabizi_contains_arabic": has_arabic(F.col("darija_arabizi")),
        "length_discrepancy": length_discrepancy(L.TARGETS),
    }
    if coherence:
        flags["darija_arabizi_incoherence"] = incoherence()
    issues = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in flags.items()]))
    out = df.withColumns({"issues": issues, "out_of_bounds": word_bounds(L.TARGETS, least, most)})
    return out.withColumn("row_status", F.when(F.col("out_of_bounds"), "FLAGGED" if missing == "flag" else "REMOVED").when(F.size("issues") > 0, "FLAGGED").otherwise("CLEAN"))
