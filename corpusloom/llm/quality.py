"""Quality by hierarchical empirical Bayes: what a document's text says, and what its site says.

A document classifier (logistic regression over binned features of the text and hashed shares of its
byte trigrams, learned here from a bounded sample of labels) gives each document a probability. Sites form a hierarchy, global, host,
path: grouped sums of all documents' probabilities give each host a posterior mean shrunk toward
the global mean, and each path one shrunk toward its host's; the strength of the shrinking comes
from how far hosts differ from the global mean, and paths from their host's, beyond what the spread
within paths shows by chance (method of moments), so sparse sites stay near their parent. The final log odds are the document's log likelihood ratio plus the log odds of its path's
posterior, from which the document's own part is taken out.

Documents of no pages have no URL; their ``source`` is the host and their language the path.
Defined cases: null and blank texts have features of their own (all zero); null hosts and paths are
sites like others; without labels of both classes the document's probability is the share of good
labels (1 without any), so nothing is rejected for want of labels; empty tables give no rows; repeated
rows are scored each, with the same evidence; very long texts are read whole (labelled ones over
``SAMPLE_BYTES`` are not learnt from); a score of exactly 0.5 keeps; other columns are ignored.
"""

from __future__ import annotations

import operator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.shared import bounded_batches, labelled_sample, materialize, slices

SAMPLE, SAMPLE_BYTES, BINS, RIDGE = 3000, 64 * 1024, 8, 1.0
#: Trigrams fall into so many buckets, and are held back more than the surface features.
GRAMS, GRAM_RIDGE = 256, 200.0
SURFACE = 10
#: How many documents' worth a parent's mean has, at least and at most.
LEAST_STRENGTH, MOST_STRENGTH = 1.0, 1e4
PUNCTUATION, DIGITS = bytes(c for c in range(33, 127) if not chr(c).isalnum()), b"0123456789"
CAPITALS, BARS, STARS = bytes(range(65, 91)), b"|", b"*%&$#@^~!"


def features(text: bytes | None) -> tuple[float, ...]:
    """Shares of kinds of characters, of distinct and of repeated words and lines, and lengths."""
    text = text or b""
    words = text.split()
    if not words:
        return (0.0,) * 10
    size, n = len(text), len(words)
    kinds = [(size - len(text.translate(None, k))) / size for k in (PUNCTUATION, DIGITS, CAPITALS, BARS, STARS)]
    lines = text.split(b"\n")
    repeated = sum(map(operator.eq, words, words[1:])) / n
    return (*kinds, len(set(words)) / n**0.85, repeated, size / n, len(set(lines)) / len(lines), float(np.log1p(n)))


def grams(text: bytes | None) -> np.ndarray:
    """Square roots of the shares of hashed byte trigrams."""
    x = np.frombuffer(text or b"", np.uint8)
    counts = np.zeros(GRAMS, np.int64)
    for k in range(0, max(0, len(x) - 2), 1 << 20):
        part = x[k : k + (1 << 20) + 2].astype(np.uint32)
        mixed = (part[:-2] * np.uint32(0x9E3779B1)) ^ (part[1:-1] * np.uint32(0x85EBCA77)) ^ (part[2:] * np.uint32(0xC2B2AE3D))
        counts += np.bincount((mixed >> np.uint32(24)) & np.uint32(GRAMS - 1), minlength=GRAMS)
    return np.sqrt(counts / max(1, len(x) - 2))


def described(texts: list[bytes | None]) -> np.ndarray:
    """A row for each text: surface features, then shares of trigrams."""
    if not texts:
        return np.zeros((0, SURFACE + GRAMS))
    return np.array([np.concatenate((features(t), grams(t))) for t in texts])


class QualityModel:
    def __init__(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray, share: float):
        self.prior = min(max(share, 1e-6), 1 - 1e-6)
        self.cuts: list[np.ndarray] = []
        self.weights: np.ndarray | None = None
        if len(set(y.tolist())) < 2:
            return
        self.cuts = [np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1])) for column in x.T[:SURFACE]]
        self.mean, self.scale = x[:, SURFACE:].mean(axis=0), x[:, SURFACE:].std(axis=0) + 1e-3
        z = self._columns(x)
        w = np.zeros(z.shape[1])
        w[0] = np.log(self.prior / (1 - self.prior))
        ridge = np.full(len(w), RIDGE)
        ridge[0], ridge[len(w) - GRAMS :] = 1e-6, GRAM_RIDGE
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            step = np.linalg.solve((z * (weight * p * (1 - p))[:, None]).T @ z + np.diag(ridge), z.T @ (weight * (y - p)) - ridge * w)
            w += step
            if np.abs(step).max() < 1e-6:
                break
        self.weights = w

    def _columns(self, x: np.ndarray) -> np.ndarray:
        """The constant, one column for each bin of each surface feature, and the trigrams' shares."""
        columns = [np.ones((len(x), 1))]
        for column, cuts in zip(x.T[:SURFACE], self.cuts, strict=True):
            columns.append(np.eye(len(cuts) + 1)[np.searchsorted(cuts, column, side="right")])
        return np.hstack([*columns, (x[:, SURFACE:] - self.mean) / self.scale])

    def probability(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), self.prior)
        return 1 / (1 + np.exp(-np.clip(self._columns(x) @ self.weights, -30, 30)))


def _scoring(model: QualityModel):
    def run(batches):
        for batch in batches:
            text = batch.column("text").cast(pa.large_binary())
            sizes = pc.fill_null(pc.binary_length(text), 0).to_numpy()
            x = described([t for a, b in slices(batch, sizes) for t in text.slice(a, b - a).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.probability(x), pa.float64())], ["row", "p"])

    return run


def fit(docs: DataFrame, labels: DataFrame, label: str, id_col: str, text_col: str) -> QualityModel:
    texts, counts = labelled_sample(docs, labels, label, id_col, text_col, SAMPLE, SAMPLE_BYTES)
    n, total = sum(map(len, texts)), max(1, sum(counts))
    x = described([t for own in texts for t in own])
    y = np.repeat([0.0, 1.0], [len(own) for own in texts])
    weight = np.concatenate([np.full(len(own), c / max(1, len(own)) * n / total) for own, c in zip(texts, counts, strict=True)])
    return QualityModel(x, y, weight, counts[1] / total if sum(counts) else 1.0)


def log_odds(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(p / (1 - p))


def strength(spread: float, noise: float, rows: int, squares: float, groups: int) -> float:
    """How many documents' worth the parent's mean has: the spread within groups over that between
    them. spread: sum over groups of rows times the squared distance of the group's mean from its
    parent's; squares: sum of the squared numbers of rows. Groups that show no more than chance, or
    are fewer than two, get the most."""
    if groups < 2 or rows <= 1 or rows - squares / rows <= 0:
        return MOST_STRENGTH
    between = (spread - (groups - 1) * noise) / (rows - squares / rows)
    return float(min(max(noise / between, LEAST_STRENGTH), MOST_STRENGTH)) if between > 0 else MOST_STRENGTH


def score_quality(docs: DataFrame, labels: DataFrame, host: Column, path: Column, label: str = "quality", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``row`` (id and ``key``, a hash of the row), ``p``, ``host_mean``, ``path_mean``, ``score``, ``keep``."""
    bounded_batches(docs.sparkSession)
    model = fit(docs, labels, label, id_col, text_col)
    given = docs.select(F.struct(F.col(f"`{id_col}`").alias("id"), row_key(docs).alias("key"), host.cast("string").alias("host"), path.cast("string").alias("path")).alias("row"), F.col(f"`{text_col}`").cast("string").alias("text"))
    scored = given.mapInArrow(_scoring(model), T.StructType([given.schema["row"], T.StructField("p", T.DoubleType())]))
    scored = materialize(scored.select("row", "p", "row.host", "row.path"), "quality")
    paths = materialize(scored.groupBy("host", "path").agg(F.sum("p").alias("s"), F.sum(F.col("p") * F.col("p")).alias("ss"), F.count("*").alias("n")), "paths")
    hosts = paths.groupBy("host").agg(F.sum("s").alias("hs"), F.sum("n").alias("hn")).withColumnRenamed("host", "h")
    sites = materialize(paths.join(hosts, F.col("host").eqNullSafe(F.col("h"))).select("host", "path", "s", "ss", "n", "hs", "hn"), "sites")
    squared = lambda a, b: F.sum(F.col(a) * F.col(a) / F.col(b))
    s, ss, n, within, squares, k, about_host = sites.agg(F.sum("s"), F.sum("ss"), F.sum("n"), squared("s", "n"), F.sum(F.col("n") * F.col("n")), F.count("*"), F.sum(F.col("n") * F.pow(F.col("s") / F.col("n") - F.col("hs") / F.col("hn"), 2))).first()
    host_sums, host_squares, host_count = hosts.agg(squared("hs", "hn"), F.sum(F.col("hn") * F.col("hn")), F.count("*")).first()
    n = n or 0
    mean = (s or 0.0) / (n or 1)
    noise = max(((ss or 0.0) - (within or 0.0)) / max(1, n - k), 1e-9)
    host_weight = strength((host_sums or 0.0) - n * mean * mean, noise, n, host_squares or 0, host_count)
    path_weight = strength(about_host or 0.0, noise, n, squares or 0, k - host_count + 1)
    at = scored.join(sites.withColumnsRenamed({"host": "h", "path": "q"}), F.col("host").eqNullSafe(F.col("h")) & F.col("path").eqNullSafe(F.col("q")))
    host_mean = (F.col("hs") - F.col("p") + host_weight * mean) / (F.col("hn") - 1 + host_weight)
    at = at.withColumn("host_mean", host_mean).withColumn("path_mean", (F.col("s") - F.col("p") + path_weight * F.col("host_mean")) / (F.col("n") - 1 + path_weight))
    final = log_odds(F.col("p")) - log_odds(F.lit(mean)) + log_odds(F.col("path_mean"))
    return at.withColumn("score", 1 / (1 + F.exp(-final))).select("row", "p", "host_mean", "path_mean", "score", (F.col("score") >= 0.5).alias("keep"))


def row_key(docs: DataFrame) -> Column:
    return F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])


def op6_quality(spark, sf_dir: str) -> DataFrame:
    """Quality of all ``documents``: the text's evidence with that of its source and language."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = score_quality(docs, labels, F.col("source"), F.col("lang"))
    return scored.select(F.col("row.id").alias("doc_id"), F.round("p", 6).alias("p"), F.round("host_mean", 6).alias("host_mean"), F.round("path_mean", 6).alias("path_mean"), F.round("score", 6).alias("score"), "keep")
