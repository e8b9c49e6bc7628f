"""Token counts of byte-level BPE, by rank-synchronous array merging.

Pre-tokens repeat, so their counts are remembered up to a bound; the unknown pre-tokens of a batch
of texts are held together as ragged arrays of byte symbols, merged rank by rank in all sequences
at once, and their surviving symbols counted. Strings of special tokens inside a
text count as one token, as the tokenizers library does by default.

Defined cases: a null text counts as an empty one (0 tokens); a null id stays null; repeated rows
and columns with any name are kept as they are; very long texts are counted whole; an empty table
gives no rows. A file with another pre-tokenizer, or with a normalizer, is refused.
"""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.merging import PairTable, merge_rounds
from corpusloom.llm.shared import bounded_batches, slices

#: White space as Unicode has it, without the separators U+001C to U+001F that Python adds.
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: The public split pattern of this family of tokenizers (fixed value).
SPLIT = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{WHITE}\p{{L}}\p{{N}}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")
#: The same split for texts of Latin letters, by the faster standard module; alternatives begin with
#: different characters, so their order is free.
LETTERS = "A-Za-z\\xaa\\xb5\\xba\\xc0-\\xd6\\xd8-\\xf6\\xf8-\\u02af"
_SIMPLE = re.compile(rf"[\t-\r -~{LETTERS}]*")
_SIMPLE_SPLIT = re.compile(rf" ?[{LETTERS}]+| ?[0-9]+|'(?:[stmd]|re|ve|ll)| ?[^\t-\r {LETTERS}0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+")
REMEMBERED = 400_000


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_level(path: str) -> dict:
    """A tokenizer file, if it is cut and merged as this module does."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    cut, model = spec.get("pre_tokenizer") or {}, spec["model"]
    plain = cut.get("type") == "ByteLevel" and not cut.get("add_prefix_space") and cut.get("use_regex", True)
    odd = [k for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges") if model.get(k)]
    added = [t["content"] for t in spec.get("added_tokens") or [] if any(t.get(k) for k in ("normalized", "lstrip", "rstrip", "single_word"))]
    if not plain or spec.get("normalizer") or odd or added:
        raise ValueError(f"not a plain byte-level BPE: {path} {cut.get('type')} {odd} {added}")
    return spec


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: itself if it prints in Latin-1, else the
    next one from U+0100."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in prints else chr(next(spare)) for b in range(256)]


class ByteMerges:
    """The merges of a tokenizer file, over byte symbols."""

    def __init__(self, path: str):
        spec = byte_level(path)
        vocab = spec["model"]["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        # where one begins with another, the longer one is meant
        self.specials = sorted((t["content"] for t in spec.get("added_tokens") or [] if t["content"]), key=len, reverse=True)
        self.of_byte = np.array([vocab[c] for c in byte_characters()], np.int64)
        left, right, merged = (np.array(x, np.int64) for x in zip(*((vocab[a], vocab[b], vocab[a + b]) for a, b in merges), strict=True))
        self.pairs = PairTable(left, right, np.arange(len(merges)), merged)

    def count(self, pretokens: list[str]) -> np.ndarray:
        raw = [p.encode() for p in pretokens]
        lengths = np.fromiter(map(len, raw), np.int64, len(raw))
        _, counts = merge_rounds(self.of_byte[np.frombuffer(b"".join(raw), np.uint8)], lengths, self.pairs)
        return counts


def pretokens(text: str) -> list[str]:
    return (_SIMPLE_SPLIT if _SIMPLE.fullmatch(text) else SPLIT).findall(text)


class Remembered(dict):
    """Counts by pre-token. An unknown one counts 0 for now and is noted with the text it is in."""

    text, unknown = 0, ()

    def __missing__(self, pretoken: str) -> int:
        self.unknown.append((self.text, pretoken))
        return 0


class Counter:
    def __init__(self, path: str):
        self.merges, self.known = ByteMerges(path), Remembered()
        self.cut = re.compile("|".join(map(re.escape, self.merges.specials))) if self.merges.specials else None

    def count(self, texts: list[str | None]) -> np.ndarray:
        totals, known = np.zeros(len(texts), np.int64), self.known
        if len(known) > REMEMBERED:
            known.clear()
        known.unknown = noted = []
        for i, text in enumerate(texts):
            known.text = i
            parts = [text or ""]
            if text and self.cut and self.cut.search(text):
                parts = self.cut.split(text)
                totals[i] = len(parts) - 1
            for part in parts:
                totals[i] += sum(map(known.__getitem__, pretokens(part)))
        fresh = list(dict.fromkeys(p for _, p in noted))
        known.update(zip(fresh, self.merges.count(fresh).tolist(), strict=True))
        np.add.at(totals, [i for i, _ in noted], [known[p] for _, p in noted])
        return totals


def _counting(path: str):
    def run(batches):
        counter = Counter(path)
        for batch in batches:
            text = batch.column("text")
            sizes = pc.fill_null(pc.binary_length(text), 0).to_numpy()
            counts = [counter.count(text.slice(a, b - a).to_pylist()) for a, b in slices(batch, sizes)]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(sizes, pa.int64()), pa.array(np.concatenate(counts) if counts else [], pa.int64())], ["row", "n_bytes", "n_tokens"])

    return run


def token_counts(docs: DataFrame, tokenizer: str, text_col: str = "text") -> DataFrame:
    """``row`` (a struct of the columns of ``docs`` but the text), ``n_bytes``, ``n_tokens``."""
    bounded_batches(docs.sparkSession)
    carried = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    given = docs.select(F.struct(*carried, F.lit(0).alias("__row")).alias("row"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return given.mapInArrow(_counting(tokenizer), T.StructType([given.schema["row"], T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())]))


def op2_token_counts(spark, sf_dir: str, limit: int = 1024) -> DataFrame:
    """Bytes and tokens of each whole text of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    counted = token_counts(docs, tokenizer_path("byte_bpe_50k.json"))
    return counted.select(F.col("row.doc_id").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
