"""Operators on a table with nulls, empty and long texts, ties, repeated rows, columns whose names
clash with inner ones; on empty tables; against brute force."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import components, decontamination, knn_join, quality, sharding, simhash_dedup, substring_dedup, token_counts, token_tables, toxicity
from corpusloom.llm.sentencepiece_codec import encode_decode

LONG = " ".join(f"w{i % 900} W{i * 7 % 1300}" for i in range(30_000))
PASSAGE = " ".join(f"p{i}" for i in range(50))
ROWS = [
    (1, None),
    (2, ""),
    (3, " \n\t"),
    (4, "Alpha beta gamma"),
    (5, "alpha BETA gamma"),
    (6, LONG),
    (7, f"start {PASSAGE} end"),
    (8, f"other\n{PASSAGE}\nlines"),
    (9, "a " * 80),
    (9, "a " * 80),
    (10, f"{PASSAGE.upper()} é ü 你好"),
    (None, "no id here"),
    (None, None),
]
SCHEMA = "doc_id long, text string"
CLASHES = ("row", "node", "n_words", "chunk", "id", "key", "shard", "kind", "lang", "source")


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    return df.withColumns({c: F.lit("x") for c in CLASHES}).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def sha(data) -> str:
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def test_substring_dedup(docs, none):
    split = [(t or "").encode().split() for _, t in ROWS]
    seen = Counter(tuple(w[i : i + 35]) for w in split for i in range(len(w) - 34))
    expected = []
    for (d, _), w in zip(ROWS, split, strict=True):
        gone = [any(seen[tuple(w[s : s + 35])] > 1 for s in range(max(0, i - 34), min(i, len(w) - 35) + 1)) for i in range(len(w))] if len(w) < 1000 else None
        if gone is None:
            gone = [False] * len(w)
            for i in range(len(w) - 34):
                if seen[tuple(w[i : i + 35])] > 1:
                    gone[i : i + 35] = [True] * 35
        expected.append((d, len(w), sum(gone), sha(b" ".join(x for x, g in zip(w, gone, strict=True) if not g))))
    for hot in (512, 0):
        got = substring_dedup.substring_dedup(docs, least_chunks=3, hot_segments=hot).select("row.doc_id", "n_words", "n_removed", "kept_sha256").collect()
        assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, expected))
    assert substring_dedup.substring_dedup(none, least_chunks=2).count() == 0


def test_token_counts_and_codec(docs, none):
    import sentencepiece
    from tokenizers import Tokenizer

    path, model = token_counts.tokenizer_path("byte_bpe_50k.json"), token_counts.tokenizer_path("piece_bpe_32k.model")
    tok, sp = Tokenizer.from_file(path), sentencepiece.SentencePieceProcessor(model_file=model)
    got = token_counts.token_counts(docs, path).select("row.doc_id", "n_bytes", "n_tokens").collect()
    assert Counter(map(tuple, got)) == Counter((d, len((t or "").encode()), len(tok.encode(t or "", add_special_tokens=False).ids)) for d, t in ROWS)
    got = encode_decode(docs, model, whole=True).select("row.doc_id", "ids", "decoded").collect()
    assert Counter((r[0], tuple(r[1]), r[2]) for r in got) == Counter((d, tuple(sp.encode(t or "", add_bos=True, add_eos=True)), t or "") for d, t in ROWS)
    assert token_counts.token_counts(none, path).count() == 0 == encode_decode(none, model).count()


def test_knn_join(spark):
    r = np.random.default_rng(3)
    rows = [(i, (r.normal(size=6) / 3).tolist()) for i in range(150)] + [(i, [0.5] * 6) for i in range(150, 260)]
    rows += [(300, None), (301, [0.1, None]), (302, [float("nan")] * 6), (303, [float("inf")] * 6), (None, [0.1] * 6), (304, []), (305, [0.9] * 9), (306, [2.0])]
    data = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("cell", F.lit(1))
    fine = {i: np.floor(64 * np.array([*v, *[0.0] * (9 - len(v))])) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all()}
    expected = []
    for q in sorted(i for i in fine if i % 20 == 0):
        scores = sorted((-int(fine[q] @ fine[x]), x) for x in fine if x != q)[:7]
        expected += [(q, k, x, -s) for k, (s, x) in enumerate(scores, 1)]
    for lane_rows in (30, 10_000):
        got = knn_join.knn_join(data, F.col("vec_id") % 20 == 0, k=7, pivots=8, block_rows=40, query_rows=5, lane_rows=lane_rows)
        assert sorted(map(tuple, got.collect())) == expected
    assert 304 in fine and knn_join.knn_join(data.where("false"), F.col("vec_id") % 20 == 0).count() == 0


def test_knn_join_moves_a_query_once_to_a_lane(spark, monkeypatch):
    r = np.random.default_rng(4)
    rows, moved = [(i, (r.normal(size=8) / 3).tolist()) for i in range(2000)], []

    def counted(df, tag, write=knn_join.materialize):
        written = write(df, tag)
        moved.extend([written.count()] if tag == "routes" else [])
        return written

    monkeypatch.setattr(knn_join, "materialize", counted)
    got = knn_join.knn_join(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0, k=3, pivots=200)
    x = np.floor(64 * np.array([v for _, v in rows])).astype(int)
    expected = [(q, k, v, int(x[q] @ x[v])) for q in range(0, 2000, 20) for k, v in enumerate(sorted((v for v in range(2000) if v != q), key=lambda v: (-int(x[q] @ x[v]), v))[:3], 1)]
    assert sorted(map(tuple, got.collect())) == expected
    assert len(moved) == 2 and max(moved) <= 100 * 6  # one row for each query and cell would be up to 19,600


def test_knn_join_of_great_and_unlike_vectors(spark):
    r = np.random.default_rng(5)
    rows = [(i, (r.normal(size=3) * 10.0 ** r.integers(0, 9)).tolist()) for i in range(120)] + [(i, [3e9] * (3 + i % 3)) for i in range(120, 170)] + [(170, r.normal(size=5000).tolist()), (171, [])]
    x = {i: [int(np.floor(64 * c)) for c in v] for i, v in rows}
    expected = []
    for q in range(0, 172, 10):
        scores = sorted((-min(max(sum(a * b for a, b in zip(x[q], x[v], strict=False)), -(2**63)), 2**63 - 1), v) for v in x if v != q)[:4]
        expected += [(q, k, v, -s) for k, (s, v) in enumerate(scores, 1)]
    got = knn_join.knn_join(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 10 == 0, k=4, pivots=6, block_rows=30, lane_rows=50)
    assert sorted(map(tuple, got.collect())) == expected


def test_simhash_dedup(docs, none):
    got = {(r["doc_id"], r["fingerprint"], r["component_id"]) for r in simhash_dedup.simhash_dedup(docs, 3).collect()}
    prints = [(d, simhash_dedup.fingerprint(t.encode() if t else None, 3)) for d, t in ROWS]
    group = {p: {p} for _, p in prints}
    for a in list(group):
        for b in list(group):
            if (a ^ b).bit_count() <= 2 and group[a] is not group[b]:
                group[a] |= group[b]
                for x in group[a]:
                    group[x] = group[a]
    least = lambda p: min((d for d, x in prints if d is not None and x in group[p]), default=None)
    assert got == {(d, f"{p:016x}", least(p)) for d, p in prints}
    assert simhash_dedup.simhash_dedup(none, 3).count() == 0


def test_near_duplicates(spark):
    words = [f"t{i * 37 % 1000}" for i in range(300)]
    near = [*words[:100], "changed", *words[101:]]
    far = [f"u{i * 31 % 1000}" for i in range(300)]
    df = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(near)), (3, " ".join(far)), (4, " ".join(words)), (5, None)], SCHEMA)
    assert {r[0]: r[1] for r in simhash_dedup.near_duplicates(df).collect()} == {1: 1, 2: 1, 3: 3, 4: 1, 5: 5}


def edited(kind: str, share: float, n: int, r, own: str) -> tuple[str, str]:
    """A text of ``n`` words and a copy whose shingles have a Jaccard similarity of about ``share``."""
    words = [f"{own}{r.integers(50_000)}" for _ in range(n)]
    if kind == "appended":
        return " ".join(words), " ".join([*words, *(f"{own}x{r.integers(50_000)}" for _ in range(int((n - 4) * (1 / share - 1))))])
    if kind == "cut":
        return " ".join(words), " ".join(words[: int((n - 4) * share) + 5])
    lost, other = (n - 4) * (1 - share) / (1 + share), list(words)
    for at in r.permutation(np.arange(4, n - 4, 5))[: max(1, int(lost / 5))]:
        other[at] = f"{own}y{at}"
    return " ".join(words), " ".join(other)


def jaccard(a: str, b: str) -> float:
    x, y = ({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in (a.split(), b.split()))
    return len(x & y) / len(x | y)


@pytest.fixture(scope="module")
def pairs_by_kind(spark):
    r = np.random.default_rng(8)
    pairs = [(k, *edited(k, r.uniform(0.7, 0.9), int(r.integers(60, 600)), r, f"{k}{i}w")) for k in ("appended", "cut", "edited") for i in range(300)]
    rows = [(2 * i + j, p[1 + j]) for i, p in enumerate(pairs) for j in range(2)]
    got = {r[0]: r[1] for r in simhash_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    return [(k, jaccard(a, b), got[2 * i] == got[2 * i + 1]) for i, (k, a, b) in enumerate(pairs)]


def test_near_duplicates_are_candidates_whatever_the_edit_is(pairs_by_kind):
    for kind in ("appended", "cut", "edited"):
        clear = [linked for k, j, linked in pairs_by_kind if k == kind and 0.86 <= j]
        assert len(clear) > 20 and sum(clear) / len(clear) > 0.75


def test_near_duplicates_are_linked_from_the_similarity_on(pairs_by_kind):
    assert [(k, j) for k, j, linked in pairs_by_kind if linked != (j >= 0.8)] == []
    assert {j >= 0.8 for k, j, _ in pairs_by_kind} == {False, True}


def test_near_duplicates_by_the_trie_join(spark, monkeypatch):
    """What the fingerprints bring together is linked where no band of minima meets, if the exact
    similarity confirms it; fingerprints that are equal or close by chance link nothing."""
    words = [f"t{i * 37 % 5000}" for i in range(2000)]
    rows = [(1, " ".join(words)), (2, " ".join([*words, "one", "more"])), (3, " ".join(f"u{w}" for w in words)), (4, " ".join(f"v{w}" for w in words))]
    prints = [simhash_dedup.majority(simhash_dedup.shingles(t.encode(), 5, simhash_dedup.WordHash())) for _, t in rows]
    assert (prints[0] ^ prints[1]).bit_count() <= 3 < (prints[0] ^ prints[2]).bit_count()
    monkeypatch.setattr(simhash_dedup, "_banding", apart_in_bands)
    got = {r[0]: r[1] for r in simhash_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA).coalesce(1)).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4}
    got = {r[0]: r[1] for r in simhash_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA).coalesce(1), budget=40).collect()}
    assert got[3] == 3 and got[4] == 4


def apart_in_bands(shingle, banding=simhash_dedup._banding):
    """As it is, but that no two texts have a key of a band in common."""
    import pyarrow as pa

    def run(batches):
        for batch in banding(shingle)(batches):
            ids = batch.column("id").to_pylist()
            keys = pa.array([[100 * i + k for k in range(simhash_dedup.BANDS)] for i in ids], pa.list_(pa.int64()))
            yield batch.set_column(batch.schema.get_field_index("keys"), "keys", keys)

    return run


def test_near_copies_of_repeated_ids(spark):
    import corpus_pipeline

    text = {k: " ".join(f"{k}{i * 37 % 1000}" for i in range(300)) for k in "abc"}
    near = f"{text['a']} more"
    rows = [(1, text["a"]), (2, near), (2, text["b"]), (3, text["c"]), (3, text["b"]), (3, text["c"]), (4, text["c"]), (5, near.upper()), (None, text["c"]), (None, text["c"])]
    got = corpus_pipeline.near_copies(spark, spark.createDataFrame(rows, SCHEMA), "").collect()
    assert Counter(map(tuple, got)) == Counter([(1, text["a"]), (2, text["b"]), (3, text["c"]), (None, text["c"]), (None, text["c"])])
    same = [(7, text["a"]), (7, near)]
    assert corpus_pipeline.near_copies(spark, spark.createDataFrame(same, SCHEMA), "").count() == 1


def test_components_of_a_long_path(spark):
    nodes = spark.range(200).select(F.col("id").alias("node"), (500 - F.col("id")).alias("rank"))
    edges = spark.range(149).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    got = components.connected_components(nodes, edges).collect()
    assert {tuple(r) for r in got} == {(i, 351) for i in range(150)}


def test_split_block_links(spark):
    r = np.random.default_rng(5)
    values = np.unique(np.array([int(c) ^ sum(1 << int(b) for b in r.choice(64, r.integers(0, 5), replace=False)) for c in r.integers(0, 2**63, 6, dtype=np.uint64) for _ in range(20)], np.uint64))
    df = spark.createDataFrame([(int(v.view(np.int64)), 0, int(v.view(np.int64)), None) for v in values], "node long, family int, print long, sign binary")
    forests = [sorted(map(tuple, components.connected_components(df.select("node", F.col("node").alias("rank")), simhash_dedup.links(df, len(values), 2, hot)).collect())) for hot in (50_000, 1)]
    assert forests[0] == forests[1] and len(forests[0]) > 20


def test_toxicity_on_held_out_rows(spark):
    import random

    r = random.Random(4)
    usual = [f"{a}{b}{c}" for a in ("ba", "ko", "li", "ne") for b in ("ra", "to", "mi", "su") for c in ("n", "st", "la", "ve")]
    rows, labels = [], []
    for i in range(900):
        words, y = r.choices(usual, k=60), i % 6 == 0
        if y:
            for _ in range(4):
                words[r.randrange(60)] = r.choice(["horridly,", "VILENESS", "wretchedly"])
        rows.append((i, " ".join(words)))
        labels.append((i, int(y)))
    docs = spark.createDataFrame([*rows, (1000, None), (1001, ""), (None, "vileness")], SCHEMA)
    got = toxicity.toxicity(docs, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    held = [(x["predicted"], dict(labels)[x["doc_id"]]) for x in got if x["held_out"] and x["doc_id"] in dict(labels)]
    assert len(got) == 903 and sum(a == b for a, b in held) / len(held) > 0.95
    assert all(x["held_out"] == (x["doc_id"] is not None and zlib.crc32(str(x["doc_id"]).encode()) % 5 == 0) for x in got)
    empty = docs.where("false")
    assert toxicity.toxicity(empty, spark.createDataFrame([], "doc_id long, toxic int")).count() == 0


def test_quality_on_junk(spark):
    import random

    r = random.Random(4)
    rows = [(i, " ".join(r.choices(["stone", "water", "light", "garden", "from", "walked"], k=50)) + "." if i % 3 else "!!! ### 000 %%% " * 20, "h1" if i < 590 else None, "p") for i in range(600)]
    docs = spark.createDataFrame([*rows, (None, None, None, None)], "doc_id long, text string, source string, lang string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0), i) for i in range(0, 600, 2)], "doc_id long, quality int, row int")
    got = quality.score_quality(docs, labels, F.col("source"), F.col("lang")).select("row.id", "keep", "score").collect()
    assert len(got) == 601 and all(x["keep"] == (x["id"] % 3 > 0) for x in got if x["id"] is not None)
    assert quality.score_quality(docs.where("false"), labels.where("false"), F.col("source"), F.col("lang")).count() == 0


def test_quality_posteriors_by_brute_force(spark):
    import random

    r = random.Random(5)
    prose, junk = "stone water light garden from walked the and".split(), "!!! ### 000 %%% 123 ||| ***".split()
    rows = []
    for i in range(400):
        host = r.choice(["good", "bad", "mixed", None])
        path = r.choice("pqr") if host != "mixed" else f"x{i}"
        bad = r.random() < {"good": 0.05, "bad": 0.8}.get(host, 0.4)
        rows.append((i, " ".join(r.choices([*prose, *junk] if r.random() < 0.3 else junk if bad else prose, k=40)), host, path))
    docs = spark.createDataFrame([*rows, rows[0], (None, None, None, None), (401, "", "good", None)], "doc_id long, text string, source string, lang string").withColumn("path", F.lit("clash"))
    labels = spark.createDataFrame([(i, int(sum(c.isalpha() for c in t) > 60)) for i, t, *_ in rows[::2]], "doc_id long, quality int")
    got = [(x["row"]["host"], x["row"]["path"], x["p"], x["host_mean"], x["path_mean"], x["score"], x["keep"]) for x in quality.score_quality(docs, labels, F.col("source"), F.col("lang")).collect()]
    assert len(got) == 403
    n, mean = len(got), sum(g[2] for g in got) / len(got)
    by_host, by_path = defaultdict(list), defaultdict(list)
    for h, q, p, *_ in got:
        by_host[h].append(p)
        by_path[h, q].append(p)
    average = lambda x: sum(x) / len(x)
    noise = sum((p - average(x)) ** 2 for x in by_path.values() for p in x) / (n - len(by_path))

    def weight(groups, parent, count):
        spread = sum(len(x) * (average(x) - parent(g)) ** 2 for g, x in groups.items())
        between = (spread - (count - 1) * noise) / (n - sum(len(x) ** 2 for x in groups.values()) / n)
        return min(max(noise / between, 1.0), 1e4) if between > 0 else 1e4

    a = weight(by_host, lambda h: mean, len(by_host))
    b = weight(by_path, lambda g: average(by_host[g[0]]), len(by_path) - len(by_host) + 1)
    odds = lambda p: np.log(min(max(p, 1e-6), 1 - 1e-6) / (1 - min(max(p, 1e-6), 1 - 1e-6)))
    for h, q, p, host_mean, path_mean, score, keep in got:
        above = (sum(by_host[h]) - p + a * mean) / (len(by_host[h]) - 1 + a)
        here = (sum(by_path[h, q]) - p + b * above) / (len(by_path[h, q]) - 1 + b)
        expected = 1 / (1 + np.exp(-(odds(p) - odds(mean) + odds(here))))
        assert np.allclose((host_mean, path_mean, score), (above, here, expected), atol=1e-9) and keep == (score >= 0.5)
    assert a < 1e4


def test_decontamination(spark, docs, none):
    items = spark.createDataFrame([(1, PASSAGE), (2, "BETA, gamma!"), (3, None), (4, "***"), (5, "never seen"), (6, " ".join(f"w{i % 900} w{i * 7 % 1300}" for i in range(100, 112)))], "item_id long, text string").withColumn("words", F.lit(1))
    got = decontamination.decontaminate(docs, items).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()
    low = lambda t: re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").encode().lower())
    windows = defaultdict(set)
    for i, t in [(r[0], r[1]) for r in items.collect()]:
        w = low(t)
        for k in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[k : k + 10])].add(i)
    expected = []
    for d, t in ROWS:
        w, hit, found = low(t), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if at := windows.get(tuple(w[k : k + n])):
                    found |= at
                    hit |= set(range(k, k + n))
        expected.append((d, len(w), len(hit), len(found), sha(",".join(sorted(map(str, found)))), bool(hit)))
    assert Counter(map(tuple, got)) == Counter(expected)
    assert sum(x[5] for x in expected) >= 5
    assert decontamination.decontaminate(none, items).count() == 0
    assert decontamination.decontaminate(docs, items.where("false")).where("contaminated").count() == 0


def test_decontamination_by_blocks(docs, spark, monkeypatch):
    items = spark.createDataFrame([(1, PASSAGE), (2, "BETA, gamma!")], "item_id long, text string")
    whole = decontamination.decontaminate(docs, items).drop("spans").collect()
    monkeypatch.setattr(decontamination, "BROADCAST_BYTES", 500)
    assert Counter(map(tuple, decontamination.decontaminate(docs, items).drop("spans").collect())) == Counter(map(tuple, whole))


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "gamma x x alpha x beta"), (2, "gamma " + "x " * 40 + "alpha beta")], SCHEMA)
    items = spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string")
    got = {r["doc_id"]: (r["contaminated"], r["n_near_items"]) for r in decontamination.decontaminate(docs, items).collect()}
    assert got == {1: (False, 1), 2: (False, 0)}


def test_sharding(docs, none, spark):
    got = sharding.shard_documents(docs).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in ROWS)
    for same in ("the same", None):
        many = spark.range(3000).select(F.when(F.lit(same is not None), F.col("id")).alias("doc_id"), F.when(F.col("id") % 3 == 0, same).otherwise(F.concat(F.lit("text "), F.col("id").cast("string"))).alias("text"))
        got = sharding.shard_documents(many).collect()
        sizes, slots, shards = Counter(), defaultdict(list), defaultdict(set)
        for r in got:
            sizes[r["shard"]] += r["size"]
            slots[r["shard"]].append(r["slot"])
            shards[r["text_crc32"]].add(r["shard"])
        assert len(sizes) == 16 and max(sizes.values()) < 1.05 * min(sizes.values())
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
        hot = zlib.crc32((same or "").encode())
        # a third of all rows are more than a shard's share, so in parts; all others are whole
        assert len(shards.pop(hot)) > 5 and set(map(len, shards.values())) == {1}
    assert sharding.shard_documents(none).count() == 0


def test_sharding_replayed_by_brute_force(spark):
    r = np.random.default_rng(6)
    texts = [" ".join("w" * int(r.integers(1, 9)) for _ in range(int(r.lognormal(3, 0.7)) + 1)) for _ in range(150)]
    texts = [t for t in texts for _ in range(int(r.integers(1, 6)))] + ["", None, "tie a", "tie b", "tie c"]
    df = spark.createDataFrame(list(enumerate(texts)), SCHEMA).withColumn("group", F.lit("clash")).repartition(3)
    vectors: dict[str, list[int]] = {}
    for t in texts:
        v = vectors.setdefault(t or "", [0, 0, 0])
        v[0], v[1], v[2] = v[0] + len((t or "").encode()) + 1, v[1] + (len(t.split(" ")) if t else 0), v[2] + 1
    totals = [sum(v[k] for v in vectors.values()) for k in range(3)]
    share = {t: [x / y for x, y in zip(v, totals, strict=True)] for t, v in vectors.items()}
    assert all(max(s) * 16 <= 1 for s in share.values())  # every group fits a shard
    weight = lambda s: 4 * s[0] + s[1] + s[2]
    left, place = [[1 / 16] * 3 for _ in range(16)], {}
    for t in sorted(share, key=lambda t: (-round(weight(share[t]), 14), hashlib.md5(t.encode()).hexdigest())):
        s = share[t]
        product = [4 * s[0] * b[0] + s[1] * b[1] + s[2] * b[2] for b in left]
        place[t] = best = max(range(16), key=lambda b: (round(product[b], 16), -b))
        left[best] = [x - y for x, y in zip(left[best], s, strict=True)]
    got = sharding.shard_documents(df).collect()
    assert len(got) == len(texts)
    assert [(r["doc_id"], r["shard"]) for r in got if r["shard"] != place[texts[r["doc_id"]] or ""]] == []


def test_token_tables(docs, none):
    from tokenizers import Tokenizer

    path = token_counts.tokenizer_path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    got = token_tables.read_tables(token_tables.write_tables(docs, path, file_bytes=100_000)).orderBy("start").collect()
    ids = lambda t: np.array([*tok.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == Counter((d, len(ids(t)), zlib.crc32(ids(t).tobytes())) for d, t in ROWS)
    start = 0
    for r in got:
        assert r["start"] == start
        start += r["n_tokens"]
    known = [r["doc_id"] for r in got if r["doc_id"] is not None]
    assert known == sorted(known)
    assert token_tables.read_tables(token_tables.write_tables(none, path)).count() == 0
