"""The kernels without Spark, against libraries or brute force."""

import json
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusloom.llm import knn_join, quality, sharding, simhash_dedup, substring_dedup, toxicity
from corpusloom.llm.sentencepiece_codec import Codec
from corpusloom.llm.shared import shed
from corpusloom.llm.token_counts import Counter as TokenCounter
from corpusloom.llm.token_counts import tokenizer_path
from corpusloom.llm.token_tables import Encoder, Table, TableWriter, key_of

PIECES = ["a", "b", "the", " ", "  ", "\n", "\t", "é", "'s", "'ll", "12", "<|endoftext|>", ".", "!!", "\x1c", "\x85", "　", "你好", "🙂", "▁", "́", "_", "x" * 30, "\r\n", "aaaa", "\x00", "abab", "inin", " " * 17, "<0x0A>", "</s>"]


@pytest.fixture(scope="module")
def texts():
    r = random.Random(7)
    some = ["".join(r.choice(PIECES) for _ in range(r.randint(0, 30))) for _ in range(3000)]
    long = ["".join(r.choice("abcdefgh") for _ in range(5000)), "".join(chr(r.randrange(0x4E00, 0x4F00)) for _ in range(5000))]
    return [*some, *long, "a" * 3000, " " * 3000 + "x", "x" * 3000 + " y", "", None, " ", "\n"]


def test_token_counts_equal_the_library(texts):
    from tokenizers import Tokenizer

    path = tokenizer_path("byte_bpe_50k.json")
    ids = [e.ids for e in Tokenizer.from_file(path).encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert TokenCounter(path).count(texts).tolist() == list(map(len, ids))
    assert [np.frombuffer(x, "<u2").tolist() for x in Encoder(path).encode(texts, 2)] == [i + [2] for i in ids]


def test_codec_equals_the_library(texts):
    codec = Codec(tokenizer_path("piece_bpe_32k.model"))
    for text, (raw, said) in zip(texts, codec.run(texts), strict=True):
        ids = codec.model.library.encode(text or "", add_bos=True, add_eos=True)
        assert np.frombuffer(raw, "<u4").tolist() == ids and said == codec.model.library.decode(ids), text


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), min_size=4, max_size=12), min_size=1, max_size=12), st.data())
def test_repeated_windows(segments, data):
    bodies = list(dict.fromkeys(" ".join(s).encode() for s in segments))
    weights = np.array([data.draw(st.integers(1, 2)) for _ in bodies])
    split = [b.split() for b in bodies]
    seen = Counter(tuple(s[i : i + 4]) for s, w in zip(split, weights, strict=True) for i in range(len(s) - 3) for _ in range(w))
    expected = [[seen[tuple(s[i : i + 4])] > 1 for i in range(len(s) - 3)] for s in split]
    assert [f.tolist() for f in substring_dedup.repeated_windows(bodies, weights, 4)] == expected


def test_trie_links_are_all_pairs_within_the_budget():
    r = np.random.default_rng(1)
    centres = r.integers(0, 2**63, 10, dtype=np.uint64)
    values = [int(c) ^ sum(1 << int(b) for b in r.choice(64, r.integers(0, 4), replace=False)) for c in centres for _ in range(30)]
    values = np.sort(np.array(values, np.uint64))  # some equal
    got = {(int(a), int(b)) for i, j in simhash_dedup.trie_links(values, np.array([0]), np.array([0]), 2) for a, b in zip(i, j, strict=True)}
    assert got == {(a, b) for a in range(len(values)) for b in range(a + 1, len(values)) if int(values[a] ^ values[b]).bit_count() <= 2}


def test_fingerprint_of_few_words():
    import xxhash

    assert simhash_dedup.fingerprint(None, 3) == 0 == simhash_dedup.fingerprint(b" \n", 3)
    assert simhash_dedup.fingerprint(b"A\tb", 3) == xxhash.xxh64_intdigest(b"a b", 42)


@pytest.mark.parametrize("n", [3, 4, 50, 40_000])
def test_fingerprint_by_brute_force(n):
    import xxhash

    r = random.Random(n)
    words = [r.choice(["Alpha", "beta", "GAMMA", "\u00c9t\u00e9", "x"]) + str(r.randrange(50)) for _ in range(n)]
    text = "\n".join(words).encode()
    low = [w.lower() if w.isascii() else w for w in words]
    hashes = [xxhash.xxh64_intdigest(" ".join(low[k : k + 3]).encode(), 42) for k in range(n - 2)]
    expected = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    assert simhash_dedup.fingerprint(text, 3) == expected


def test_table_lookup(tmp_path):
    class Out(bytearray):
        def write(self, data):
            self.extend(data)

    out, ids = Out(), [None, *range(-5, 60_000, 3), 60_001, 60_001]
    writer = TableWriter(out, 2)
    for i in ids:
        writer.add(key_of(i), np.array([7, (i or 0) % 50_000], "<u2").tobytes())
    writer.close()
    table = Table.of(bytes(out))
    assert table.entries == len(ids) == len(list(table)) and len(table.blocks) > 1
    assert [x.tolist() for x in table.get(10)] == [[7, 10]] and table.get(11) == [] and len(table.get(60_001)) == 2 and len(table.get(None)) == 1
    (tmp_path / "t.sst").write_bytes(out)
    ranged, read = Table.opened(f"file://{tmp_path}/t.sst"), []
    inner = ranged.read
    ranged.read = lambda start, n: read.append(n) or inner(start, n)
    assert [x.tolist() for x in ranged.get(10)] == [[7, 10]] and len(read) == 2 and sum(read) < len(out)


def test_other_tokenizers_are_refused(tmp_path):
    spec = {"model": {"vocab": {}, "merges": []}, "pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": True}}
    (tmp_path / "t.json").write_text(json.dumps(spec))
    with pytest.raises(ValueError):
        TokenCounter(str(tmp_path / "t.json"))


def test_packing_balances_all_dimensions():
    r = np.random.default_rng(2)
    vectors = r.lognormal(0, 1, (4000, 3))
    loads = np.array([vectors[sharding.pack(vectors, 16) == b].sum(axis=0) for b in range(16)])
    assert (loads.max(axis=0) / loads.mean(axis=0)).max() < 1.02


def test_products_are_exact_beyond_floats():
    a = np.array([[2**61, -3], [5, 7]])
    assert knn_join.products(a, np.array([[3, 1]])).tolist() == [[3 * 2**61 - 3], [22]]
    assert knn_join.products(a, np.array([[2**61, 1]]))[0, 0] == 2**63 - 1


def test_best_takes_smaller_ids_in_ties():
    q, v, s = knn_join.best(np.array([5]), np.array([9, 5, 3, 4]), np.array([[1, 9, 1, 1]]), 2)
    assert v.tolist() == [3, 4] and s.tolist() == [1, 1] and q.tolist() == [5, 5]


def test_isotonic_and_shed():
    assert toxicity.isotonic(np.array([1.0, 3.0, 2.0]), np.ones(3)) == [1.0, 2.5, 2.5]
    known = dict.fromkeys(range(11))
    shed(known, 10)
    assert list(known) == [0, 1, 2, 3, 4]


def test_models_without_labels():
    assert toxicity.ToxicityModel([[], []], [0, 0]).share(0.0, 0) == 0
    assert quality.QualityModel(np.zeros((0, 266)), np.zeros(0), np.zeros(0), 1.0).probability(np.zeros((2, 266))).min() > 0.99
