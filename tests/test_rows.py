"""Cleaning in Python rows: the results of the expressions, without Java's regular expressions."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__
from corpusloom import lexicon as L
from corpusloom.functions import rows as R
from corpusloom.functions import text as X
from corpusloom.operators import cleaning, profile

ODD = [
    None,
    "",
    " \t\x1c\u3000",
    "a<unk>b @-@-@ c <b>d</b> <> < <i e &amp; f &lt;i&gt; &eacute; &amp",
    "[t](u v) [x] (y) `c` ```d``` # e >f g>h **i** *j* __k__ _l_ m~n ** o_p",
    "HTTP://a.b/c~d www.x.y WwW.z http://q😀r s",
    "@bob a@b.c (@al) é@x ٣@y _@z @@w @a-@b",
    "the the no no 111 111 end end end Ends ends don't Kelvin\u212a ſtop İx ΣΑΣ",
    "25la b7al 2025 hhhhello 111123 a1111b ....a 7777777 iiism qadim f1f men",
    "إِنَّ ڭ پ ١ كـتاب ٱلله مدرسة في بزااف بززاف دىل ديال الناس",
    "كلمة غير مفهومة كلمة غير مفهومة اسم قديم x اسم جديد اسم جديد اسم جديد",
    "kalima ghair mafhuma kalima ghair mafhuma ism qadim ism jadid ok ok",
    "we corrected the english mt artifact in this row",
    "darija_arabic,darija_arabizi,english,modern_standard_arabic",
    "\u0610\u06d6ب\u0653ت\u0670ث \U0001f600☀ج\ufdfaد",
]


def _corpus(spark):
    n = len(ODD)
    rows = [(i, *(ODD[(i + k * (i // n)) % n] for k in range(4)), ["4", None, "x"][i % 3], [None, " error", "GENERATED"][i % 11 % 3]) for i in range(n * n)]
    return spark.createDataFrame(rows, "row_index int, " + ", ".join(f"{c} string" for c in L.TARGETS) + ", english_word_count string, status string")


@pytest.mark.parametrize("options", [cleaning.CleaningOptions(), cleaning.CleaningOptions(keep_metadata=True, keep_leakage=True, html_entities=False, arabizi_drop_vowels=True, arabizi_most_repeats=1, english_stopwords=())])
def test_rows_and_expressions_agree(spark, monkeypatch, options):
    df = _corpus(spark)
    both = []
    for fast in (True, False):
        monkeypatch.setattr(cleaning, "in_rows", lambda _, fast=fast: fast)
        found = cleaning.clean_corpus(df, options), cleaning.drop_reasons(df, ["row_index"], options), cleaning.changed_cells(df, options), cleaning.clean_corpus(df, options, texts=("english",))
        both.append([(f.columns, [t for _, t in f.dtypes], sorted(f.collect(), key=repr)) for f in found])
    assert both[0] == both[1]


def test_white_space_is_that_of_the_lexicon():
    white = R.re.compile("[" + R.re.sub(r"\\x\{([0-9A-Fa-f]+)\}", lambda m: f"\\u{int(m[1], 16):04x}", L.WHITE) + "]")
    assert all(bool(white.match(chr(c))) == chr(c).isspace() for c in range(0x110000))


@pytest.mark.parametrize("name", ["change_rate", "clean_corpus", "clean_stage_counts", "drop_reasons", "top_words_darija"])
def test_texts_are_cleaned_without_regular_expressions_of_java(spark, name):
    df = __spark_entry__.queries()[name](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_replace" not in plan and "RLIKE" not in plan and "translate(lower" in plan


def test_closed_references_alone(spark):
    row = spark.createDataFrame([("a &amp; b &amp c &#233; &ampx; &nope; &quot",)], "t string").select(X.unescape_html(F.col("t"), closed=True)).first()
    assert row[0] == "a & b &amp c é &ampx; &nope; &quot"


def test_shares_of_changed_cells(spark):
    flags = spark.createDataFrame([(True, False), (False, False), (True, False)], "a boolean, b boolean")
    assert {tuple(r) for r in profile.changed_shares(flags).collect()} == {("a", 2, 3, 66.67), ("b", 0, 3, 0.0)}
