"""Text functions, Column to Column. A null is an empty text to all of them.

White space is the explicit class ``lexicon.WHITE``: Java's own differs from what is wanted. All but
``unescape_html`` and ``porter_stem`` stay in the JVM.
"""

from __future__ import annotations

import html
import re
from html.entities import html5

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom import lexicon as L

W, S = f"[{L.WHITE}]", f"[^{L.WHITE}]"


def as_text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def sub(c: Column, pattern: str, replacement: str) -> Column:
    return F.regexp_replace(c, F.lit(pattern), F.lit(replacement))


def collapse(c: Column) -> Column:
    return F.trim(sub(as_text(c), f"{W}+", " "))


def tokens(c: Column) -> Column:
    """The words between white space, in order, repeats kept."""
    return F.array_remove(F.split(as_text(c), f"{W}+"), "")


def join(words: Column) -> Column:
    return F.array_join(words, " ")


def word_count(c: Column) -> Column:
    return F.size(tokens(c))


def char_length(c: Column) -> Column:
    return F.char_length(as_text(c))


def is_blank(c: Column) -> Column:
    return collapse(c) == ""


def drop_artifacts(c: Column) -> Column:
    """``<unk>`` and ``@-@``, with the space around them, become one space."""
    return collapse(sub(as_text(c), f"{W}*(?:<unk>|@-@){W}*", " "))


def hyphenate_artifacts(c: Column) -> Column:
    """The other convention: ``@-@`` is a hyphen, unknown marks go, no space stands before punctuation."""
    c = F.replace(F.replace(as_text(c), F.lit("@-@"), F.lit("-")), F.lit("@=@"), F.lit("-"))
    c = sub(sub(c, rf"(?i)<{W}*unk{W}*>", ""), rf"(?i)\[{W}*unk{W}*\]", "")
    c = sub(sub(c, f"{W}{{2,}}", " "), f"{W}+([,.;:!?])", "$1")
    return sub(c, f"^{W}+|{W}+$", "")


@F.pandas_udf(T.StringType())
def _unescape(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: html.unescape(t) if t and "&" in t else t)


_CLOSED = re.compile("&(?:#[0-9]+|#[xX][0-9a-fA-F]+|[0-9A-Za-z]+);")


@F.pandas_udf(T.StringType())
def _unescape_closed(texts: pd.Series) -> pd.Series:
    known = lambda m: html.unescape(m[0]) if m[0][1] == "#" or m[0][1:] in html5 else m[0]
    return texts.map(lambda t: _CLOSED.sub(known, t) if t and "&" in t else t)


def unescape_html(c: Column, closed: bool = False) -> Column:
    """As browsers read it, ``&amp`` too; with ``closed``, only references that end in a semicolon, so
    that what a page's cut has left of one stays."""
    return _unescape_closed(as_text(c)) if closed else _unescape(as_text(c))


def strip_tags(c: Column) -> Column:
    return sub(as_text(c), "<[^>]+>", " ")


#: In this order: links, inline code, quote and heading marks, strong and emphasis.
MARKDOWN = (
    (r"\[([^\]]+)\]\(([^\)]+)\)", 1),
    (r"`{1,3}[^`]+`{1,3}", 0),
    (rf"(?:^|{W})[>#]+", 0),
    (r"\*\*([^*]+)\*\*", 1),
    (r"__([^_]+)__", 1),
    (r"\*([^*]+)\*", 1),
    (r"_([^_]+)_", 1),
)


def strip_markdown(c: Column) -> Column:
    c = as_text(c)
    for pattern, kept in MARKDOWN:
        c = sub(c, pattern, "$1" if kept else " ")
    return F.replace(c, F.lit("~"), F.lit(" "))


URL = rf"(?i)https?://{S}+|www\.{S}+"


def strip_urls(c: Column) -> Column:
    return sub(as_text(c), URL, " ")


def strip_mentions(c: Column) -> Column:
    return sub(as_text(c), r"(?<![\p{L}\p{N}_])@[A-Za-z0-9_]+", " ")


def replace_emojis(c: Column, replacement: str = " ") -> Column:
    return sub(as_text(c), L.EMOJI, replacement)


def universal_cleanup(c: Column, emoji: str = " ", entities: bool = True) -> Column:
    """Entities, artifacts, tags, markdown, URLs, mentions, emojis, white space; in this order."""
    c = drop_artifacts(unescape_html(c) if entities else as_text(c))
    return collapse(replace_emojis(strip_mentions(strip_urls(strip_markdown(strip_tags(c)))), emoji))


def strip_punctuation(c: Column) -> Column:
    """Punctuation and symbols; two code points are younger than Java's tables."""
    return sub(as_text(c), r"[\p{P}\p{S}\x{61D}\x{20C0}]", " ")


def latin_only(c: Column) -> Column:
    return sub(as_text(c), f"[^a-z0-9{L.WHITE}]", " ")


def strip_isolated_digits(c: Column) -> Column:
    """Digits not next to a Latin letter: of ``25la``, the 2 goes."""
    return sub(as_text(c), "(?<![a-zA-Z])[0-9]+(?![a-zA-Z])", " ")


def limit_repeats(c: Column, most: int = 2) -> Column:
    most = max(1, most)
    return sub(as_text(c), rf"([^\n])\1{{{most},}}", "$1" * most)


def drop_vowels(c: Column) -> Column:
    return F.translate(as_text(c), "aeiou", "")


def transliterate(c: Column) -> Column:
    c = as_text(c)
    for latin, arabic in L.ARABIZI_DIGRAPHS.items():
        c = F.replace(c, F.lit(latin), F.lit(arabic))
    return collapse(F.translate(c, L.ARABIZI_LATIN, L.ARABIZI_ARABIC))


def expand_contractions(c: Column, effective: bool = False) -> Column:
    """Published results leave contractions alone, whatever their option says; so does this, unless
    ``effective``."""
    c = as_text(c)
    if effective:
        for short, full in L.CONTRACTIONS.items():
            c = sub(c, rf"(?i)\b{short}\b", full)
    return c


def drop_words(words: Column, stopwords) -> Column:
    """Repeats of what stays are kept."""
    if not stopwords:
        return words
    listed = F.array(*[F.lit(w) for w in sorted(stopwords)])
    return F.filter(words, lambda t: ~F.array_contains(listed, t))


def clean_english(c: Column, stopwords=L.ENGLISH_STOPWORDS, effective_contractions: bool = False, stem: bool = False) -> Column:
    c = expand_contractions(F.lower(as_text(c)), effective_contractions)
    words = join(drop_words(tokens(latin_only(strip_punctuation(c))), stopwords))
    return porter_stem(words) if stem else words


def strip_placeholders(c: Column, terms) -> tuple[Column, Column]:
    """The text without placeholder terms, and how many there were. Neighbours share a space, so the
    second of two stays."""
    c = collapse(c)
    return replace_placeholders(c, terms)


def replace_placeholders(c: Column, terms) -> tuple[Column, Column]:
    """As strip_placeholders, of a text whose white space is collapsed."""
    plain = c
    found, count = c.rlike("(?iu)" + "|".join(sorted(terms))), F.lit(0)
    for term in sorted(terms):
        pattern = rf"(?iu)(^|{W}){re.escape(term).replace(chr(92) + ' ', ' ')}({W}|$)"
        count = count + F.regexp_count(c, F.lit(pattern))
        c = sub(c, pattern, " ")
    # one look decides whether the text has any of them; few have
    return F.when(found, collapse(c)).otherwise(plain), F.when(found, count).otherwise(0)


def without_repeats(words: Column) -> Column:
    """Words but those that repeat the one before, of three characters or more and not all digits."""
    # pairs of a word and the one before: a lambda must not compute the words again for each word
    pairs = F.zip_with(words, F.concat(F.array(F.lit("")), words), lambda t, before: F.struct(t.alias("t"), before.alias("before")))
    kept = F.filter(pairs, lambda p: p["t"].isNotNull() & ((p["t"] != p["before"]) | (F.char_length(p["t"]) < 3) | p["t"].rlike("^[0-9]+$")))
    return F.transform(kept, lambda p: p["t"])


def collapse_repeats(c: Column) -> tuple[Column, Column]:
    """The text without repeats, and how many words went."""
    return drop_repeats(join(tokens(c)))


def drop_repeats(c: Column) -> tuple[Column, Column]:
    """As collapse_repeats, of a text whose white space is collapsed. One look finds the texts that
    have a repeat; only those are cut into words."""
    found, words = c.rlike(r"(?<![^ ])([^ ]{3,}) \1(?![^ ])"), F.split(c, " ")
    kept = without_repeats(words)
    return F.when(found, join(kept)).otherwise(c), F.when(found, F.size(words) - F.size(kept)).otherwise(0)


def for_similarity(c: Column, entities: bool = True) -> Column:
    """The normalisation before embedding: quotes folded, control characters, markup, addresses and
    unknown marks out, no space before punctuation."""
    c = F.translate(unescape_html(c) if entities else as_text(c), L.QUOTES, L.PLAIN_QUOTES)
    c = sub(c, r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]", " ")
    c = strip_urls(strip_tags(F.translate(c, "\n\t\r", "   ")))
    word = r"[\p{L}\p{N}_]"
    c = sub(c, rf"(?<!{word})[\p{{L}}\p{{N}}_.+-]+@[\p{{L}}\p{{N}}_-]+(?:\.[\p{{L}}\p{{N}}_-]+)+(?!{word})", " ")
    c = collapse(sub(c, r"(?i)(?:\[unk\]|<unk>|@-@|@=@)", " "))
    return sub(c, rf"{W}+([,.;:!?\x{{60C}}\x{{61B}}\x{{61F}}])", "$1")


def has_arabizi_digit(c: Column) -> Column:
    return F.coalesce(c.cast("string").rlike("[2379]"), F.lit(False))


def _any_of(c: Column, words) -> Column:
    return c.rlike("|".join(words))


def looks_like_metadata(c: Column) -> Column:
    return reads_like_metadata(F.lower(collapse(c)))


def reads_like_metadata(c: Column) -> Column:
    """As looks_like_metadata, of a lower-case text whose white space is collapsed."""
    # whatever matches has one of these; the rest is computed for few rows
    likely = _any_of(c, (*L.TARGETS, *L.METADATA_LANGUAGES))
    names = sum((c.contains(n).cast("int") for n in L.TARGETS), F.lit(0))
    listed = c.isin(",".join(L.TARGETS), ";".join(L.TARGETS))
    remarks = (F.size(F.split(c, " ")) >= 6) & _any_of(c, L.METADATA_ACTIONS) & _any_of(c, L.METADATA_LANGUAGES)
    return likely & (listed | (names >= 3) | remarks)


def has_darija_marker(c: Column) -> Column:
    return F.arrays_overlap(tokens(c), F.array(*[F.lit(w) for w in L.DARIJA_MARKERS]))


@F.pandas_udf(T.StringType())
def _porter(texts: pd.Series) -> pd.Series:
    from corpusloom.functions.porter import stem

    known: dict[str, str] = {}

    def one(word: str) -> str:
        if word not in known:
            known[word] = stem(word)
        return known[word]

    return texts.map(lambda t: " ".join(map(one, t.split(" "))) if t else t)


def porter_stem(c: Column) -> Column:
    """Each space-separated word's stem, by Porter's algorithm."""
    return _porter(c)
