"""Cleaning of many rows at once: the results of cleaning row by row, for odd texts too."""

import random

import pyarrow as pa
import pytest

from corpusloom import lexicon as L
from corpusloom.functions import batches as B
from corpusloom.operators import cleaning

PARTS = [
    *" \n\t　.,:/<>[]()`*_#&@~;-'0127aAzZwéßΣ😀☀ـ١ڭّۖKİſ",
    *["&amp;", "<unk>", "@-@", "](", "http://", "HTTPS://", "www.", "wWw.", "<b>", "**", "__", "aaa", "1111", "the ", " the the ", " of"],
    *["english ", "msa ", "darija ", "corrected ", "kalima ghair mafhuma ", "ism qadim ", "pneumonoultra ", "pneumonoultrA pneumonoultrB ", " 2025 2025 "],
    *["del ", "دىل", " ديل ", "بزززاف", " بززاف ", " ديال ", "بزاف ", "في ", "كلمة غير مفهومة ", "اسم جديد ", " مدرسة مدرسة ", "إلى", "والمستشفيات والمستشفيات "],
]


def _texts(n: int) -> list:
    some = random.Random(7)
    return [some.choice([None, "", "".join(some.choices(PARTS, k=some.choice([1, 3, 12, 60])))]) if i % 4 == 0 else "".join(some.choices(PARTS, k=some.choice([2, 9, 40]))) for i in range(n)]


OPTIONS = [
    cleaning.CleaningOptions(),
    cleaning.CleaningOptions(keep_metadata=True, keep_leakage=True, html_entities=False, arabizi_drop_vowels=True, arabizi_most_repeats=1, english_stopwords=(), msa_stopwords=("", "x", "ال كتاب")),
    cleaning.CleaningOptions(arabizi_most_repeats=4, arabizi_stopwords=("ok", "é", "hhhhell")),
]


@pytest.mark.parametrize("options", OPTIONS)
@pytest.mark.parametrize("few", [1, 7, 500])
def test_batches_and_rows_agree(options, few):
    texts = [_texts(4000)[k::4] for k in range(4)]
    bad = [[True, None, False][i % 3] for i in range(1000)]
    types = cleaning._TYPES
    want = [{c: row[c] for c in types} for row in (cleaning._cleaned_row(options, t, b, True) for *t, b in zip(*texts, bad, strict=True))]
    found = []
    for at in range(0, 1000, few):
        arrays = cleaning._cleaned_batch(options, types, [pa.array(t, pa.string()).slice(at, few) for t in texts], pa.array(bad).slice(at, few))
        found += pa.StructArray.from_arrays(arrays, names=list(types)).to_pylist()
    assert found == want


def test_long_lists_of_stop_words_go_by_rows():
    assert cleaning._lookups(cleaning.CleaningOptions()) is not None
    assert cleaning._lookups(cleaning.CleaningOptions(english_stopwords=("extraordinary",))) is None


def test_texts_of_a_batch_are_not_cut_into_words_one_by_one(monkeypatch):
    """Most texts have no markup and no placeholder, however many words of them are repeated."""
    calls = []
    monkeypatch.setattr(B.R, "loosened", lambda *a: calls.append(a))
    monkeypatch.setattr(B.R, "drop_repeats", lambda *a: calls.append(a))
    texts = [pa.array(["plain words words: of 3, (a) text # > text text ~ كتاب كتاب"] * 50)] * 4
    arrays = cleaning._cleaned_batch(cleaning.CleaningOptions(), {c: t for c, t in cleaning._TYPES.items() if c in (*L.TARGETS, "drop_reason", "repeats_removed")}, texts, pa.array([False] * 50))
    assert not calls and arrays[2][0].as_py() == "plain words 3 text" and arrays[0][0].as_py() == "كتاب"
