"""The text functions again, as SQL text for the oracle: other regular expressions (no look-around),
list functions instead of array functions."""

from __future__ import annotations

from corpusloom import lexicon as L
from corpusloom.functions import text as X

W, S = X.W, X.S


def quote(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def rx(c: str, pattern: str, replacement: str) -> str:
    return f"regexp_replace({c}, {quote(pattern)}, {quote(replacement)}, 'g')"


def collapse(c: str) -> str:
    return f"trim({rx(f'coalesce({c}, {quote(str())})', f'{W}+', ' ')})"


def tokens(c: str) -> str:
    return f"list_filter(regexp_split_to_array(coalesce({c}, ''), {quote(f'{W}+')}), lambda t: t <> '')"


def join(words: str) -> str:
    return f"array_to_string({words}, ' ')"


def listed(words) -> str:
    return "[" + ", ".join(quote(w) for w in words) + "]"


def strip(c: str) -> str:
    return rx(c, f"^{W}+|{W}+$", "")


def drop_artifacts(c: str) -> str:
    return collapse(rx(c, f"{W}*(?:<unk>|@-@){W}*", " "))


def hyphenate(c: str) -> str:
    c = f"replace(replace(coalesce({c}, ''), '@-@', '-'), '@=@', '-')"
    c = rx(rx(c, f"(?i)<{W}*unk{W}*>", ""), rf"(?i)\[{W}*unk{W}*\]", "")
    return strip(rx(rx(c, f"{W}{{2,}}", " "), f"{W}+([,.;:!?])", r"\1"))


def tags(c: str) -> str:
    return rx(c, "<[^>]+>", " ")


def markdown(c: str) -> str:
    for pattern, kept in X.MARKDOWN:
        c = rx(c, pattern, r"\1" if kept else " ")
    return f"replace({c}, '~', ' ')"


def urls(c: str) -> str:
    return rx(c, X.URL, " ")


def mentions(c: str) -> str:
    return rx(c, r"(^|[^\p{L}\p{N}_])@[A-Za-z0-9_]+", r"\1 ")


def emojis(c: str) -> str:
    return rx(c, L.EMOJI, " ")


def universal(c: str) -> str:
    return collapse(emojis(mentions(urls(markdown(tags(drop_artifacts(f"coalesce({c}, '')")))))))


def punctuation(c: str) -> str:
    return rx(c, r"[\p{P}\p{S}\x{61D}\x{20C0}]", " ")


def latin(c: str) -> str:
    return rx(c, f"[^a-z0-9{L.WHITE}]", " ")


def without(words: str, stopwords) -> str:
    return f"list_filter({words}, lambda t: NOT list_contains({listed(sorted(stopwords))}, t))"


def english(c: str) -> str:
    return join(without(tokens(latin(punctuation(f"lower({c})"))), L.ENGLISH_STOPWORDS))


def arabic(c: str, fold: bool) -> str:
    c = rx(rx(c, L.ARABIC_MARKS, ""), L.ALEF_FORMS, "ا")
    return collapse(rx(f"translate({c}, 'ةي', 'هى')" if fold else c, L.NOT_ARABIC, " "))


def transliterate(c: str) -> str:
    for a, b in L.ARABIZI_DIGRAPHS.items():
        c = f"replace({c}, '{a}', '{b}')"
    return collapse(f"translate({c}, '{L.ARABIZI_LATIN}', '{L.ARABIZI_ARABIC}')")


def msa(c: str) -> str:
    plain = {w.translate(str.maketrans("أإآٱ", "اااا")) for w in L.ARABIC_STOPWORDS}
    return join(without(tokens(arabic(c, False)), plain))


def darija(c: str) -> str:
    plain = {w.translate(str.maketrans("أإآٱةي", "ااااهى")) for w in L.DARIJA_STOPWORDS}
    cases = " ".join(f"WHEN {quote(a)} THEN {quote(b)}" for a, b in L.DARIJA_VARIANTS.items())
    return join(without(f"list_transform({tokens(arabic(c, True))}, lambda t: CASE t {cases} ELSE t END)", plain))


def placeholders(c: str, terms) -> tuple[str, str]:
    c, n = collapse(c), "0"
    for term in sorted(terms):
        pattern = f"(?i)(^|{W}){term}({W}|$)"
        n = f"{n} + len(regexp_extract_all({c}, {quote(pattern)}))"
        c = rx(c, pattern, " ")
    return collapse(c), n


def repeats(words: str) -> tuple[str, str]:
    """words: the name of a column of words."""
    kept = f"list_filter({words}, lambda t, i: i = 1 OR t <> {words}[i - 1] OR length(t) < 3 OR regexp_full_match(t, '[0-9]+'))"
    return join(kept), f"len({words}) - len({kept})"


def metadata(c: str) -> str:
    c = f"lower({collapse(c)})"
    names = " + ".join(f"contains({c}, '{n}')::INT" for n in L.TARGETS)
    remarks = f"len({tokens(c)}) >= 6 AND regexp_matches({c}, '{'|'.join(L.METADATA_ACTIONS)}') AND regexp_matches({c}, '{'|'.join(L.METADATA_LANGUAGES)}')"
    return f"({c} <> '' AND ({c} IN ('{','.join(L.TARGETS)}', '{';'.join(L.TARGETS)}') OR {names} >= 3 OR ({remarks})))"


def marker(c: str) -> str:
    return f"list_has_any({tokens(c)}, {listed(L.DARIJA_MARKERS)})"


def let(expr: str, name: str, body: str) -> str:
    """``body`` with ``name`` for the value of ``expr``, which is computed once."""
    return f"list_transform([{expr}], lambda {name}: {body})[1]"


def characters(c: str) -> str:
    return f"regexp_extract_all({c}, '(?s).')"


def limit_repeats(c: str) -> str:
    kept = "list_filter(cs, lambda x, i: x = chr(10) OR i < 3 OR x <> cs[i - 1] OR x <> cs[i - 2])"
    return let(characters(f"coalesce({c}, '')"), "cs", f"array_to_string({kept}, '')")


def isolated_digits(c: str) -> str:
    """Runs of digits lose what is not next to a letter: all but the first digit after a letter, and
    all but the last before one."""
    a, b = "(i > 1 AND regexp_matches(rs[i - 1], '^[a-zA-Z]'))::INT", "(i < len(rs) AND regexp_matches(rs[i + 1], '^[a-zA-Z]'))::INT"
    one = f"CASE WHEN regexp_matches(r, '^[0-9]') AND length(r) > {a} + {b} THEN left(r, {a}) || ' ' || right(r, {b}) ELSE r END"
    return let(f"regexp_extract_all(coalesce({c}, ''), '[0-9]+|[a-zA-Z]+|[^0-9a-zA-Z]+')", "rs", f"array_to_string(list_transform(rs, lambda r, i: {one}), '')")


def expand(c: str) -> str:
    for short, full in L.CONTRACTIONS.items():
        c = rx(c, rf"(?i)\b{short}\b", full)
    return c


def arabizi(c: str) -> str:
    words = tokens(latin(isolated_digits(punctuation(limit_repeats(f"lower({c})")))))
    return join(without(words, L.ARABIZI_STOPWORDS))


def _first_of(words, fits) -> str:
    """CASE: the first of ``words`` that fits, or an empty text."""
    return "CASE " + " ".join(f"WHEN {fits(w)} THEN {quote(w)}" for w in words) + " ELSE '' END"


def stem(t: str, words: str) -> str:
    """Light stems of a list; t: the name of an element."""
    front = _first_of(L.STEM_PREFIXES, lambda p: f"starts_with({t}, {quote(p)}) AND length({t}) - {len(p)} >= 3")
    back = _first_of(L.STEM_SUFFIXES, lambda s: f"ends_with(rest, {quote(s)}) AND length(rest) - {len(s)} >= 3")
    rest = f"{t}[length({front}) + 1:]"
    return f"list_transform({words}, lambda {t}: {let(rest, 'rest', f'left(rest, length(rest) - length({back}))')})"


def clitics(words: str, negation: bool) -> str:
    front = _first_of(L.PROCLITICS, lambda p: f"starts_with(t, {quote(p)}) AND length(t) - {len(p)} >= 3" + ("" if len(p) > 1 else f" AND contains({quote(L.AFTER_SHORT_PROCLITIC)}, t[2:2])"))
    back = _first_of(L.ENCLITICS, lambda s: f"ends_with(rest, {quote(s)}) AND length(rest) - {len(s)} >= 2")
    usual = let(front, "p", let("t[length(p) + 1:]", "rest", let(back, "e", "[p, left(rest, length(rest) - length(e)), e]")))
    denied = f"CASE WHEN starts_with(t, 'ما') AND ends_with(t, 'ش') AND length(t) >= 5 THEN ['ما', t[3:length(t) - 1], 'ش'] ELSE {usual} END"
    return f"list_filter(flatten(list_transform({words}, lambda t: {denied if negation else usual})), lambda t: t <> '')"


def arabizi_arabic(c: str) -> str:
    plain = {w.translate(str.maketrans("أإآٱةي", "ااااهى")) for w in L.DARIJA_STOPWORDS}
    return join(stem("t", without(tokens(arabic(transliterate(limit_repeats(f"lower({c})")), True)), plain)))


def msa_clitics_stems(c: str) -> str:
    plain = {w.translate(str.maketrans("أإآٱ", "اااا")) for w in L.ARABIC_STOPWORDS}
    return join(stem("t", without(clitics(tokens(arabic(c, False)), False), plain)))


def darija_negation(c: str) -> str:
    plain = {w.translate(str.maketrans("أإآٱةي", "ااااهى")) for w in L.DARIJA_STOPWORDS}
    cases = " ".join(f"WHEN {quote(a)} THEN {quote(b)}" for a, b in L.DARIJA_VARIANTS.items())
    return join(without(clitics(f"list_transform({tokens(arabic(c, True))}, lambda t: CASE t {cases} ELSE t END)", True), plain))


def for_similarity(c: str) -> str:
    c = rx(f"translate(coalesce({c}, ''), {quote(L.QUOTES)}, {quote(L.PLAIN_QUOTES)})", r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]", " ")
    c = urls(tags(f"translate({c}, chr(10) || chr(9) || chr(13), '   ')"))
    # a match from the left is not preceded or followed by a word character anyway
    c = rx(c, r"[\p{L}\p{N}_.+-]+@[\p{L}\p{N}_-]+(?:\.[\p{L}\p{N}_-]+)+", " ")
    c = collapse(rx(c, r"(?i)(?:\[unk\]|<unk>|@-@|@=@)", " "))
    return rx(c, f"{W}+([,.;:!?\\x{{60C}}\\x{{61B}}\\x{{61F}}])", r"\1")


def ascii_letters(c: str) -> str:
    """The letters that normalised Arabic has, one ASCII character each: edit distances count bytes."""
    letters = "".join(map(chr, [*range(0x621, 0x63B), *range(0x641, 0x64B)]))
    return f"translate({c}, '{letters}', '0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ')"
