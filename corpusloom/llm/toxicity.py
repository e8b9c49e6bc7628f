"""Toxicity by compression distance: windows that compress better with a dictionary of toxic text.

Two zstandard dictionaries are trained (COVER), one on windows of texts labelled toxic, one on windows
of ordinary texts, in ``ROUNDS`` rounds. Most of a toxic text is ordinary, and a dictionary of all of
it holds what both classes share. So in each round the toxic one is trained on those windows of toxic
texts that the pair of dictionaries before tells from ordinary ones: where the length with the
ordinary dictionary less that with the toxic one, the *gain*, reaches the least threshold that toxic
texts reach ``PURITY`` times as often (in the first round: windows that the ordinary dictionary codes
worst). The ordinary one is trained on windows of ordinary texts that gained by mistake. Both stand
before the same base, trained on ordinary text, so that lengths differ only by what is their own.
``MEMBERS`` such pairs are trained, each on its share of the texts, and their evidence is averaged.

A text is scored by windows of ``2 * BESIDE + 1`` words. A window is centred at each word that gains
by itself, which is what most windows do not have and what words are remembered by. The gains of the window and of its
centre, with the centre's size, are counted over windows of labelled texts by class; combinations
that toxic texts have at least ``LIFT`` times as often are hits: the calibrated thresholds. A text's
evidence is the sum of its hits' log likelihood ratios, less a toll for each word; its score is the
share of toxic rows among labelled texts with as much evidence (isotonic).

Labelled rows are a sample of at most ``SAMPLE`` of each class, in the order of a hash, of texts up
to ``SAMPLE_BYTES``; the classes' whole counts weigh them. All documents are scored, whole, very long
ones too. Defined cases: null and blank texts have no evidence and get the score of that; without
labels of both classes every score is the share of toxic labels (0 without any); null ids are scored,
and not held out; repeated rows are scored each; equal texts get equal scores; an empty table gives
no rows; columns besides id and text are ignored.
"""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.shared import bounded_batches, labelled_sample, shed, slices

SAMPLE, SAMPLE_BYTES = 2000, 32 * 1024
#: Bytes of a dictionary's own part and of the base, of COVER's segments; bytes that windows end in.
OWN, BASE, SEGMENT, CARRIER = 12 * 1024, 24 * 1024, 32, 64
ROUNDS, MEMBERS, PURITY, LIFT = 4, 2, 3.0, 4.0
#: Words of a window that dictionaries are trained on, and at each side of a centre.
TRAINING_WORDS, BESIDE = 2, 1
#: A word gains if it is shorter by this many bytes; one byte can be rounding.
LEAST_GAIN = 2
#: Bins of evidence, of width 1.
LOW, HIGH = -12, 12
REMEMBERED = 300_000
EDGES = b"\"'`.,;:!?()[]{}<>*%&$#|-_~/\\"


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().split()


def bare(words: list[bytes]) -> list[bytes]:
    return [w.strip(EDGES) for w in words]


def compressor(content: bytes) -> zstandard.ZstdCompressor:
    dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    parameters = zstandard.ZstdCompressionParameters(window_log=17, hash_log=15, chain_log=15, search_log=4, min_match=4, target_length=16, strategy=zstandard.STRATEGY_GREEDY, write_content_size=False)
    return zstandard.ZstdCompressor(dict_data=dictionary, compression_params=parameters)


def trained(samples: list[bytes], size: int, segment: int = SEGMENT) -> bytes:
    """The content of a trained dictionary, filled up to ``size``; of few samples, their last bytes."""
    try:
        content = zstandard.train_dictionary(size + 2048, samples, k=segment, d=6, steps=1).as_bytes()
    except zstandard.ZstdError:
        content = b"".join(samples)
    return content[-size:].rjust(size)


def windows(words: list[bytes], n: int) -> list[bytes]:
    return [b" " + b" ".join(words[k : k + n]) + b" " for k in range(0, len(words), n)]


class Lengths:
    """Gains with one pair of dictionaries. A window is compressed before a carrier that both hold,
    so that short windows, too, are coded by matches."""

    def __init__(self, ordinary: bytes, toxic: bytes, base: bytes):
        self.contents = (ordinary, toxic, base)
        self.ordinary, self.toxic, self.carrier = compressor(ordinary + base), compressor(toxic + base), base[-CARRIER:]

    def gain(self, window: bytes) -> int:
        window += self.carrier
        return len(self.ordinary.compress(window)) - len(self.toxic.compress(window))

    def lengths(self, some: list[bytes], toxic: bool) -> np.ndarray:
        compress, end = (self.toxic if toxic else self.ordinary).compress, self.carrier
        return np.fromiter((len(compress(w + end)) for w in some), np.int64, len(some))


def train_pair(texts: list[list[list[bytes]]], seed: int) -> Lengths:
    """texts: words of ordinary and of toxic texts."""
    order = random.Random(seed)
    long = [w for words in texts[0] for w in windows(words, 8)]
    order.shuffle(long)
    base, own = trained(long[::2], BASE, 40), trained(long[1::2], OWN, 40)
    ordinary, toxic = ([w for words in texts[y] for w in windows(words, TRAINING_WORDS)] for y in (0, 1))
    pair, mistaken = Lengths(own, own, base), []
    # lengths of the windows of both classes with the one and with the other dictionary
    plain = [pair.lengths(w, False) for w in (ordinary, toxic)]
    other = plain
    for turn in range(ROUNDS):
        if turn:
            by_chance, found = plain[0] - other[0], plain[1] - other[1]
            fits = [t for t in range(1, 20) if (found >= t).mean() > PURITY * (by_chance >= t).mean()]
            if not fits:
                break
            chosen = [toxic[i] for i in np.flatnonzero(found >= fits[0])]
        else:
            badly = plain[1] / np.fromiter(map(len, toxic), np.int64, len(toxic))
            chosen = [toxic[i] for i in np.argsort(-badly, kind="stable")[: max(1, len(toxic) // 6)]]
        order.shuffle(chosen)
        pair = Lengths(pair.contents[0], trained(chosen, OWN), base)
        other = [pair.lengths(w, True) for w in (ordinary, toxic)]
        mistaken = ([ordinary[i] for i in np.flatnonzero(plain[0] - other[0] >= 1)] + mistaken)[:40_000]
        if mistaken:
            order.shuffle(mistaken)
            pair = Lengths(trained(mistaken, OWN), pair.contents[1], base)
            plain = [pair.lengths(w, False) for w in (ordinary, toxic)]
    return pair


class Gains(dict):
    """For a word that gains by itself with any pair, the bare word and the gains; else None.
    Remembered up to a bound."""

    def __init__(self, contents: list[tuple[bytes, bytes, bytes]]):
        self.pairs = [Lengths(*c) for c in contents]

    def __missing__(self, word: bytes):
        core = word.strip(EDGES)
        own = tuple(p.gain(b" " + core + b" ") for p in self.pairs)
        self[word] = value = (core, own) if max(own) >= LEAST_GAIN else None
        return value

    def found(self, words: list[bytes]) -> list[tuple[int, int, int, int]]:
        """Of each window around a word that gains, for each pair: which pair, the window's gain, the
        word's and the word's size."""
        out = []
        for i, value in enumerate(map(self.__getitem__, words)):
            if value is not None:
                core, own = value
                window = b" " + b" ".join(bare(words[max(0, i - BESIDE) : i + BESIDE + 1])) + b" "
                out += [(k, p.gain(window), g, min(len(core), 16)) for k, (p, g) in enumerate(zip(self.pairs, own, strict=True)) if g >= LEAST_GAIN]
        return out


class ToxicityModel:
    def __init__(self, texts: list[list[bytes]], counts: list[int]):
        """texts, counts: of rows labelled 0 and 1; the sample and how many there are in all."""
        self.shares = [sum(counts) and counts[1] / sum(counts)] * (HIGH - LOW + 1)
        self.contents: list[tuple[bytes, bytes, bytes]] = []
        self.hits: dict[tuple[int, int, int, int], float] = {}
        self.toll = 0.0
        words = [[words_of(t) for t in texts[y]] for y in (0, 1)]
        if any(words[0]) and any(words[1]):
            plain = [[bare(w) for w in words[y]] for y in (0, 1)]
            self.contents = [train_pair([p[k::MEMBERS] or p for p in plain], k).contents for k in range(MEMBERS)]
            self._calibrate(words, counts)

    def share(self, evidence: float, words: int) -> float:
        """The score of a text with so much evidence from hits among so many words."""
        return self.shares[max(LOW, min(HIGH, math.floor(evidence - self.toll * words))) - LOW]

    def evidence(self, gains: Gains, words: list[bytes]) -> float:
        return sum(self.hits.get(f, 0.0) for f in gains.found(words))

    def _calibrate(self, texts: list[list[list[bytes]]], counts: list[int]) -> None:
        gains = Gains(self.contents)
        found = [[gains.found(words) for words in texts[y]] for y in (0, 1)]
        seen = [Counter(f for own in found[y] for f in own) for y in (0, 1)]
        totals = [max(1, sum(map(len, texts[y]))) for y in (0, 1)]
        for f, n in seen[1].items():
            lift = n * totals[0] / ((seen[0][f] + 0.5) * totals[1])
            if n >= 3 and lift >= LIFT:
                self.hits[f] = math.log(lift) / MEMBERS
        # as counts of rare events: each hit's log likelihood ratio, less what a word costs
        self.toll = sum(seen[1][f] / totals[1] - seen[0][f] / totals[0] for f in self.hits) / MEMBERS
        by_bin = np.zeros((2, HIGH - LOW + 1))
        for y in (0, 1):
            for own, words in zip(found[y], texts[y], strict=True):
                at = math.floor(sum(self.hits.get(f, 0.0) for f in own) - self.toll * len(words))
                by_bin[y, max(LOW, min(HIGH, at)) - LOW] += counts[y] / len(texts[y])
        self.shares = isotonic((by_bin[1] + 0.5 * self.shares[0]) / (by_bin.sum(axis=0) + 0.5), by_bin.sum(axis=0) + 0.5)


def isotonic(values: np.ndarray, weights: np.ndarray) -> list[float]:
    """The closest values that never fall: neighbours out of order are pooled."""
    pools: list[list[float]] = []
    for v, w in zip(values.tolist(), weights.tolist(), strict=True):
        pools.append([v, w, 1])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            v, w, n = pools.pop()
            pools[-1] = [(pools[-1][0] * pools[-1][1] + v * w) / (pools[-1][1] + w), pools[-1][1] + w, pools[-1][2] + n]
    return [v for v, _, n in pools for _ in range(int(n))]


def _scoring(model: ToxicityModel):
    def run(batches):
        gains = Gains(model.contents) if model.hits else None
        for batch in batches:
            text = batch.column("text").cast(pa.large_binary())
            sizes = pc.fill_null(pc.binary_length(text), 0).to_numpy()
            scores = []
            for a, b in slices(batch, sizes):
                if gains is not None:
                    shed(gains, REMEMBERED)
                for t in text.slice(a, b - a).to_pylist():
                    words = words_of(t)
                    scores.append(model.share(model.evidence(gains, words) if gains is not None else 0.0, len(words)))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("held_out"), pa.array(scores, pa.float64())], ["id", "held_out", "score"])

    return run


def fifth(doc_id) -> F.Column:
    """Rows that the model never learns from: crc32 of the id as text, a multiple of 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ``held_out``, ``score``, ``predicted`` of every row."""
    bounded_batches(docs.sparkSession)
    model = ToxicityModel(*labelled_sample(docs, labels, label, id_col, text_col, SAMPLE, SAMPLE_BYTES, ~fifth(F.col("id"))))
    given = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"), fifth(F.col(f"`{id_col}`")).alias("held_out"))
    kind = given.schema["id"].dataType.simpleString()
    scored = given.mapInArrow(_scoring(model), f"id {kind}, held_out boolean, score double")
    return scored.select(F.col("id").alias(id_col), "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op5_toxicity(spark, sf_dir: str) -> DataFrame:
    """Toxicity scores of all ``documents``."""
    return toxicity(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
