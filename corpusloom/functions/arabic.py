"""Arabic script: normalisation, stop words, variants, clitics, light stems; Column to Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom import lexicon as L
from corpusloom.functions import text as X


def normalize(c: Column, fold_ta: bool = False, fold_yeh: bool = False) -> Column:
    """Marks and tatweel out, alef forms one, other characters than the basic letters to spaces."""
    c = X.sub(X.sub(X.as_text(c), L.ARABIC_MARKS, ""), L.ALEF_FORMS, "ا")
    if fold_ta or fold_yeh:
        c = F.translate(c, "ة" * fold_ta + "ي" * fold_yeh, "ه" * fold_ta + "ى" * fold_yeh)
    return X.collapse(X.sub(c, L.NOT_ARABIC, " "))


def normalized_words(words, fold: bool) -> tuple[str, ...]:
    """A word list under the same normalisation, on the driver: the letters of the lists need no
    more than the folds and the alef forms."""
    table = str.maketrans({"آ": "ا", "أ": "ا", "إ": "ا", "ٱ": "ا"} | ({"ة": "ه", "ي": "ى"} if fold else {}))
    return tuple(sorted({w.translate(table) for w in words}))


def replace_variants(words: Column, variants=None) -> Column:
    table = F.create_map(*[F.lit(x) for kv in (variants or L.DARIJA_VARIANTS).items() for x in kv])
    return F.transform(words, lambda t: F.coalesce(F.element_at(table, t), t))


def _first(candidates: Column, fits) -> Column:
    """The first candidate that fits, or an empty text."""
    return F.coalesce(F.get(F.filter(candidates, fits), F.lit(0)), F.lit(""))


def _literals(words) -> Column:
    return F.array(*[F.lit(w) for w in words])


def split_clitics(words: Column, negation: bool = False) -> Column:
    """Each word in one to three parts: at most one proclitic, the rest, at most one enclitic; or
    the two halves of a negation around its core."""

    def proclitic(t: Column) -> Column:
        short_ok = F.instr(F.lit(L.AFTER_SHORT_PROCLITIC), F.substring(t, 2, 1)) > 0
        return _first(_literals(L.PROCLITICS), lambda p: t.startswith(p) & (F.char_length(t) - F.char_length(p) >= 3) & ((F.char_length(p) > 1) | short_ok))

    def cut(x: Column) -> Column:
        usual = F.array(x["before"], F.substr(x["rest"], F.lit(1), F.char_length(x["rest"]) - F.char_length(x["after"])), x["after"])
        if not negation:
            return usual
        t = x["t"]
        denied = t.startswith("ما") & t.endswith("ش") & (F.char_length(t) >= 5)
        return F.when(denied, F.array(F.lit("ما"), F.substr(t, F.lit(3), F.char_length(t) - 3), F.lit("ش"))).otherwise(usual)

    parts = _halves(words, proclitic, lambda r: _first(_literals(L.ENCLITICS), lambda s: (F.char_length(r) - F.char_length(s) >= 2) & r.endswith(s)))
    return F.filter(F.flatten(F.transform(parts, cut)), lambda t: t != "")


def _halves(words: Column, front, back) -> Column:
    """Structs of each word t, what goes ``before``, the ``rest``, and what goes ``after``. One step
    at a time: what a lambda refers to is computed again for each element of the array inside it."""
    a = F.transform(words, lambda t: F.struct(t.alias("t"), front(t).alias("before")))
    b = F.transform(a, lambda x: F.struct(x["t"].alias("t"), x["before"].alias("before"), F.substr(x["t"], F.char_length(x["before"]) + 1).alias("rest")))
    return F.transform(b, lambda x: F.struct(x["t"].alias("t"), x["before"].alias("before"), x["rest"].alias("rest"), back(x["rest"]).alias("after")))


def light_stem(words: Column) -> Column:
    parts = _halves(
        words,
        lambda t: _first(_literals(L.STEM_PREFIXES), lambda p: t.startswith(p) & (F.char_length(t) - F.char_length(p) >= 3)),
        lambda r: _first(_literals(L.STEM_SUFFIXES), lambda s: r.endswith(s) & (F.char_length(r) - F.char_length(s) >= 3)),
    )
    return F.transform(parts, lambda x: F.substr(x["rest"], F.lit(1), F.char_length(x["rest"]) - F.char_length(x["after"])))


def clean_msa(c: Column, stopwords=L.ARABIC_STOPWORDS, clitics: bool = False, stems: bool = False) -> Column:
    words = X.tokens(normalize(c))
    if clitics:
        words = split_clitics(words)
    words = X.drop_words(words, normalized_words(stopwords, fold=False))
    return X.join(light_stem(words) if stems else words)


def clean_darija(c: Column, stopwords=L.DARIJA_STOPWORDS, clitics: bool = False, negation: bool = False, stems: bool = False) -> Column:
    words = replace_variants(X.tokens(normalize(c, True, True)))
    if clitics:
        words = split_clitics(words, negation)
    words = X.drop_words(words, normalized_words(stopwords, fold=True))
    return X.join(light_stem(words) if stems else words)


def clean_arabizi(c: Column, stopwords=L.ARABIZI_STOPWORDS, arabic_stopwords=L.DARIJA_STOPWORDS, most_repeats: int = 2, vowels: bool = True, to_arabic: bool = False, stems: bool = False) -> Column:
    c = X.limit_repeats(F.lower(X.as_text(c)), most_repeats)
    if not vowels:
        c = X.drop_vowels(c)
    if to_arabic:
        words = X.drop_words(X.tokens(normalize(X.transliterate(c), True, True)), normalized_words(arabic_stopwords, fold=True))
        return X.join(light_stem(words) if stems else words)
    return X.join(X.drop_words(X.tokens(X.latin_only(X.strip_isolated_digits(X.strip_punctuation(c)))), stopwords))
