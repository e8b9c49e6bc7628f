"""Porter's suffix stripping (An algorithm for suffix stripping, 1980), for lower-case words, with the
extensions in wide use: irregular words, ``ies`` and ``ied`` of short words, ``y`` after consonants
only, ``bli``, ``fulli`` and ``logi``, ``alli`` looked at again. ``stem(word, extended=False)`` is as published."""

from __future__ import annotations

import re

#: Suffix and replacement of steps 2 and 3, suffixes of step 4 (fixed values).
STEP_2 = {"ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize", "abli": "able", "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous", "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al", "iveness": "ive", "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble"}
EXTENDED_2 = {k: v for k, v in STEP_2.items() if k != "abli"} | {"bli": "ble", "fulli": "ful"}
IRREGULAR = {"sky": "sky", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "news": "news", "inning": "inning", "innings": "inning", "outing": "outing", "outings": "outing", "canning": "canning", "cannings": "canning", "howe": "howe", "proceed": "proceed", "exceed": "exceed", "succeed": "succeed"}
STEP_3 = {"icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": ""}
STEP_4 = ("al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize")


def shape(word: str) -> str:
    """c for each consonant, v for each vowel."""
    out = ""
    for i, letter in enumerate(word):
        out += "v" if letter in "aeiou" or letter == "y" and i and out[-1] == "c" else "c"
    return out


def measure(word: str) -> int:
    return len(re.findall("v+c+", shape(word)))


def has_vowel(word: str) -> bool:
    return "v" in shape(word)


def doubled(word: str) -> bool:
    return len(word) > 1 and word[-1] == word[-2] and shape(word)[-1] == "c"


def short_end(word: str, extended: bool = False) -> bool:
    return shape(word).endswith("cvc") and word[-1] not in "wxy" or extended and shape(word) == "vc"


def _longest(word: str, suffixes) -> str | None:
    return max((s for s in suffixes if word.endswith(s)), key=len, default=None)


def _tidy(word: str, extended: bool) -> str:
    if word.endswith(("at", "bl", "iz")):
        return word + "e"
    if doubled(word) and word[-1] not in "lsz":
        return word[:-1]
    return word + "e" if measure(word) == 1 and short_end(word, extended) else word


def _plural(word: str, extended: bool) -> str:
    if extended and word.endswith("ies") and len(word) == 4:
        return word[:-1]
    if word.endswith(("sses", "ies")):
        return word[:-2]
    return word if word.endswith("ss") or not word.endswith("s") else word[:-1]


def _past(word: str, extended: bool) -> str:
    if extended and word.endswith("ied"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("eed"):
        return word[:-1] if measure(word[:-3]) > 0 else word
    for end in ("ed", "ing"):
        if word.endswith(end):
            return _tidy(word[: -len(end)], extended) if has_vowel(word[: -len(end)]) else word
    return word


def _double_suffix(word: str, extended: bool) -> str:
    if extended and word.endswith("alli") and measure(word[:-4]) > 0:
        return _double_suffix(word[:-2], extended)
    if extended and word.endswith("logi"):
        return word[:-1] if measure(word[:-3]) > 0 else word
    table = EXTENDED_2 if extended else STEP_2
    end = _longest(word, table)
    return word[: -len(end)] + table[end] if end and measure(word[: -len(end)]) > 0 else word


def stem(word: str, extended: bool = True) -> str:
    if extended and word in IRREGULAR:
        return IRREGULAR[word]
    if len(word) < 3:
        return word
    word = _past(_plural(word, extended), extended)
    before = word[:-1]
    if word.endswith("y") and (len(before) > 1 and shape(before)[-1] == "c" if extended else has_vowel(before)):
        word = before + "i"
    word = _double_suffix(word, extended)
    end = _longest(word, STEP_3)
    if end and measure(word[: -len(end)]) > 0:
        word = word[: -len(end)] + STEP_3[end]
    end = _longest(word, STEP_4)
    if end and measure(word[: -len(end)]) > 1 and (end != "ion" or word[-4] in "st"):
        word = word[: -len(end)]
    if word.endswith("e") and (measure(word[:-1]) > 1 or measure(word[:-1]) == 1 and not short_end(word[:-1], extended)):
        word = word[:-1]
    if word.endswith("ll") and measure(word[:-1]) > 1:
        word = word[:-1]
    return word
