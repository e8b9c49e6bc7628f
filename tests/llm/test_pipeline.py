"""The stages of the pipeline on nulls, blanks, repeated ids and rows, long texts; on an empty table;
and the whole of it against what each stage should do."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
R = random.Random(11)
WORDS = [f"{a}{b}{c}" for a in "bdfgk" for b in ("ar", "en", "il", "or") for c in ("ta", "mo", "lu", "si", "ne")]


def prose(n: int, own: str) -> str:
    return " ".join(R.choice(WORDS) + (own if k % 7 == 0 else "") for k in range(n)) + "."


ITEM = prose(20, "item")
PASSAGE = prose(50, "shared")
LONG = prose(20_000, "long")
ONE, TWO = prose(200, "one"), prose(200, "two")
JUNK = "!!! ### 000 %%% |||| *** " * 30
ROWS = [
    (1, ONE, "en", "a"),
    (2, f"{ONE} more", "en", "a"),
    (3, TWO, "en", "b"),
    (3, ONE, "en", "b"),
    (4, LONG, "en", "a"),
    (5, f"{prose(60, 'five')} {PASSAGE}", "en", "a"),
    (6, f"{prose(60, 'six')} {PASSAGE} end", "fr", None),
    (7, f"{prose(60, 'seven')} {ITEM} end", "en", "a"),
    (8, None, "en", "a"),
    (9, "", "en", "a"),
    (10, " \n", "en", "a"),
    (11, TWO, "en", "b"),
    (11, TWO, "en", "b"),
    (None, TWO, "en", "b"),
    (None, None, None, None),
    (None, f"x {ITEM}", "en", "a"),
    *[(100 + i, JUNK + str(i), "en", "junk") for i in range(30)],
    *[(200 + i, prose(40, f"n{i}"), "en", "a") for i in range(60)],
]
TABLE = [(*r, len(r[1]) if r[1] is not None else None) for r in ROWS]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = f"file://{tmp_path_factory.mktemp('tables')}"
    spark.createDataFrame(TABLE, SCHEMA).write.parquet(f"{path}/documents.parquet")
    labels = [(100 + i, 0, 0) for i in range(20)] + [(200 + i, 1, 0) for i in range(40)] + [(1, 1, 0), (1, 1, 0), (None, 0, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, ITEM), (2, None), (None, "x")], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


@pytest.fixture(scope="module")
def docs(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet").withColumns({c: F.lit("c") for c in ("row", "key", "node", "words", "label")})


def rows(df) -> Counter:
    return Counter((r["doc_id"], r["text"]) for r in df.collect())


ALL = Counter(r[:2] for r in ROWS)


def test_quality(spark, docs, folder):
    got = P.quality(spark, docs, folder)
    assert got.columns == docs.columns
    kept = rows(got)
    assert not any(i is not None and 100 <= i < 130 for i, _ in kept)
    prose_rows = Counter({k: n for k, n in ALL.items() if k[1] and len(k[1]) > 2 and not (k[0] and 100 <= k[0] < 130)})
    assert kept & prose_rows == prose_rows


def test_near_copies(spark, docs, folder):
    got = P.near_copies(spark, docs, folder)
    assert got.columns == docs.columns
    kept = rows(got)
    # 1 stands for its copies; 3 keeps its other text, which 11 repeats; one of the blank texts stays
    assert kept[1, ONE] == 1 and kept[3, TWO] == 1 and kept[3, ONE] == 0 and (2, f"{ONE} more") not in kept and not any(i == 11 for i, _ in kept)
    assert [i for i, t in kept if i is not None and not (t or "").strip()] == [8]
    assert sum(n for (i, _), n in kept.items() if i is None) == 3
    assert all(kept[200 + i, ROWS[46 + i][1]] == 1 for i in range(60)) and kept[4, LONG] == 1


def test_repeated_passages(spark, docs, folder):
    got = P.repeated_passages(spark, docs, folder)
    assert got.columns == docs.columns and got.count() == len(ROWS)
    left = {(r["doc_id"], r["n_chars"]): r["text"] for r in got.collect()}
    texts = Counter(t for (i, _), t in left.items() if i in (5, 6))
    assert not any(PASSAGE in t for t in texts) and all("five" in t or "six" in t for t in texts)
    assert left[4, len(LONG)] == LONG and left[8, None] is None and left[9, 0] == "" and left[10, 2] == " \n"
    assert [t for (i, _), t in left.items() if i == 11] == [""]


def test_benchmark_leaks(spark, docs, folder):
    got = P.benchmark_leaks(spark, docs, folder)
    assert got.columns == docs.columns
    gone = ALL - rows(got)
    assert {k[0] for k in gone} == {7, None} and sum(gone.values()) == 2


def test_tokens(spark, docs, folder):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=P.tokenizer_path("piece_bpe_32k.model"))
    digest = lambda t: hashlib.sha256(np.array(sp.encode(t or "", add_bos=True, add_eos=True), "<u4").tobytes()).hexdigest()
    got = Counter((r["doc_id"], r["ids_sha256"], r["decoded_sha256"]) for r in P.tokens(spark, docs, folder).collect())
    assert got == Counter((i, digest(t), hashlib.sha256((t or "").encode()).hexdigest()) for i, t, *_ in ROWS)


def test_empty_table(spark, docs, folder):
    none = docs.where("false")
    for name, stage in P.STAGES:
        assert stage(spark, none, folder).count() == 0, name


def test_run(spark, folder):
    got = P.run(spark, folder).collect()
    ids = [r["doc_id"] for r in got if r["doc_id"] is not None]
    assert len(ids) == len(set(ids)) and {1, 3, 4, 5, 6, *range(200, 260)} <= set(ids)
    assert not {2, 7, 11, *range(100, 130)} & set(ids)
