"""Substring dedup: remove words of passages that occur more than once.

Method: compressed FM-indexes, one for each shard, searched backwards over wavelet matrices for
matching statistics, which give the windows of ``window`` words that occur more than once.

A plain split into shards would have to stream every document past every shard. So shards are cut
by content. In each window the smallest hash among its 16-word seeds is the window's *anchor*; a
run of windows that share an anchor is a *segment* of at most 54 words. Equal windows have equal
anchors, so whatever can repeat meets in one shard, and an anchor seen once in the whole corpus
rules its segment out before any text moves. Steps:

1. documents are dealt to chunks by a hash of their content (one exchange, reused three times);
   each chunk reports its anchors, with the number of their segments and of distinct ones;
2. anchors are counted over all chunks; those seen once are dropped;
3. chunks send the distinct segments of the repeated anchors to the shard of the anchor. Those of
   an anchor with many distinct segments (a common line in different surroundings) go window by
   window to the shard of the window's own hash, which splits the group without loss;
4. each shard indexes its distinct segments and searches them;
5. chunks mark the words that repeated windows cover.

Each group is bounded: a chunk and a shard by their bytes, the rows of one anchor by the number
of chunks. (Rows that are alike in all columns are in one chunk.) Defined cases: null and blank texts
have no words and keep nothing; very long texts are read whole; a text with fewer words than the
window keeps all; repeated rows count as separate documents; an empty table gives
an empty result; columns that ``docs`` has besides are carried in a struct, so any name is fine.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.shared import MIB, bounded_batches, pieces_for, slices, text_bytes

SEED_WORDS = 16
#: Over this many distinct segments, an anchor's windows are dealt by their own hash.
HOT_SEGMENTS = 512
CHUNK_BYTES = 8 * MIB
HASH_SEED = 0x5EED
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word, HASH_SEED)
        return value


class Segments:
    """The segments of a few documents: first word, windows, anchor; and all words in a row."""

    def __init__(self, texts: list[bytes | None], hashes: WordHashes, window: int):
        split = [t.split() if t else [] for t in texts]
        self.words = [w for words in split for w in words]
        self.lengths = np.fromiter(map(len, split), np.int64, len(split))
        self.offsets = np.concatenate(([0], np.cumsum(self.lengths)))
        self.window = window
        n = len(self.words)
        seed = min(SEED_WORDS, window)
        if n < window:
            self.first = self.count = np.zeros(0, np.int64)
            self.anchor = np.zeros(0, np.uint64)
            return
        x = self.hashes = np.fromiter(map(hashes.__getitem__, self.words), np.uint64, n)
        width = 1
        while width < seed:
            step = min(width, seed - width)
            x = x[:-step] * _ODD + x[step:]
            x ^= x >> np.uint64(29)
            x *= _MIX
            x ^= x >> np.uint64(32)
            width += step
        at, width = np.arange(len(x)), 1
        span = window - seed + 1
        while width < span:
            step = min(width, span - width)
            later = x[step:] < x[:-step]
            x = np.where(later, x[step:], x[:-step])
            at = np.where(later, at[step:], at[:-step])
            width += step
        doc = np.repeat(np.arange(len(split)), self.lengths)
        starts = np.flatnonzero(doc[: n - window + 1] == doc[window - 1 :])
        chosen = at[starts]
        edge = np.ones(len(starts), bool)
        edge[1:] = (starts[1:] != starts[:-1] + 1) | (chosen[1:] != chosen[:-1])
        edges = np.flatnonzero(edge)
        self.first = starts[edges]
        self.count = np.diff(np.append(edges, len(starts)))
        self.anchor = x[self.first]

    def content(self) -> np.ndarray:
        """A hash of each segment's words, only used to estimate how many are distinct."""
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(self.hashes * (self.hashes >> np.uint64(7)))))
        ends = self.first + self.count + self.window - 1
        return (sums[ends] - sums[self.first]) * _ODD + self.hashes[self.first] + self.hashes[ends - 1]

    def body(self, first: int, count: int) -> bytes:
        return b" ".join(self.words[first : first + count + self.window - 1])


def read_segments(table: pa.Table, hashes: WordHashes, window: int) -> Iterator[tuple[int, int, Segments]]:
    column = table.column("text").cast(pa.large_binary())
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy()
    for start, end in slices(table, sizes):
        yield start, end, Segments(column.slice(start, end - start).to_pylist(), hashes, window)


def digest(body: bytes) -> bytes:
    return xxhash.xxh3_128_digest(body, HASH_SEED)


# ---------------------------------------------------------------------------------- the index


class WaveletMatrix:
    """Ranks in a sequence of small integers: one packed bit vector for each bit, with counts at
    each 64 bits."""

    def __init__(self, sequence: np.ndarray, symbols: int):
        self.levels = []
        for bit in range(max(1, int(symbols - 1).bit_length()) - 1, -1, -1):
            ones = (sequence >> bit) & 1
            packed = np.packbits(ones.astype(np.uint8), bitorder="little")
            packed = np.concatenate((packed, np.zeros(16 - len(packed) % 8, np.uint8))).view(np.uint64)
            before = np.concatenate((np.zeros(1, np.int64), np.cumsum(np.bitwise_count(packed), dtype=np.int64)))
            keep = ones == 0
            self.levels.append((bit, packed, before, int(keep.sum())))
            sequence = np.concatenate((sequence[keep], sequence[~keep]))
        self.base = self._descend(np.arange(symbols), np.zeros(symbols, np.int64))

    def _descend(self, symbol: np.ndarray, position: np.ndarray) -> np.ndarray:
        for bit, packed, before, zeros in self.levels:
            block = position >> 6
            below = (np.uint64(1) << (position & 63).astype(np.uint64)) - np.uint64(1)
            ones = before[block] + np.bitwise_count(packed[block] & below)
            position = np.where((symbol >> bit) & 1, zeros + ones, position - ones)
        return position

    def rank(self, symbol: np.ndarray, position: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each position."""
        return self._descend(symbol, position) - self.base[symbol]


class FMIndex:
    """Backward search over a text of integers. Suffixes are sorted by their first 64 symbols and
    then by place, which is all that patterns of up to 64 symbols need."""

    DEPTH = 64

    def __init__(self, text: np.ndarray):
        rank, width, n = text.astype(np.int64), 1, len(text)
        while width < self.DEPTH:
            after = np.zeros(n, np.int64)
            after[:-width] = rank[width:] + 1
            key = rank * (int(rank.max(initial=0)) + 2) + after
            order = np.argsort(key)
            ordered = key[order]
            rank = np.empty(n, np.int64)
            rank[order] = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1])))
            width *= 2
            if rank[order[-1]] == n - 1:
                break
        suffixes = np.argsort(rank, kind="stable")
        symbols = int(text.max(initial=0)) + 1
        self.size = n
        self.before = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=symbols))))[:-1]
        self.wavelet = WaveletMatrix(text[suffixes - 1], symbols)

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The suffix range of ``symbol`` + pattern, from that of the pattern."""
        both = self.wavelet.rank(np.concatenate((symbol, symbol)), np.concatenate((low, high)))
        start = self.before[symbol]
        return start + both[: len(symbol)], start + both[len(symbol) :]


def repeated_windows(bodies: list[bytes], weights: np.ndarray, window: int) -> list[np.ndarray]:
    """For each distinct segment, which of its windows occur more than once in all segments.

    A segment that itself occurs more than once needs no search. For others, matching statistics:
    from an end, extend to the left while the match occurs elsewhere; where it stops, no window
    holds both the end and the word before the match, so the next end is one to the left, or as
    far as the windows before the match reach.
    """
    ids: dict[bytes, int] = {}
    split = [b.split(b" ") for b in bodies]
    lengths = np.fromiter(map(len, split), np.int64, len(split))
    text = np.zeros(int(lengths.sum()) + len(split), np.int64)
    starts = np.concatenate(([0], np.cumsum(lengths + 1)))[:-1]
    for start, words in zip(starts.tolist(), split, strict=True):
        text[start : start + len(words)] = [ids.setdefault(w, len(ids) + 1) for w in words]
    found = [np.ones(n - window + 1, bool) if w > 1 else np.zeros(n - window + 1, bool) for n, w in zip(lengths.tolist(), weights.tolist(), strict=True)]
    active = np.flatnonzero(weights <= 1)
    if not len(active) or len(bodies) < 2 and lengths[0] < window + 1:
        return found
    index = FMIndex(text)
    start = starts[active]
    end = start + lengths[active]
    at, low, high = end.copy(), np.zeros(len(active), np.int64), np.full(len(active), index.size)
    while len(active):
        new_low, new_high = index.extend(text[at - 1], low, high)
        going = new_high - new_low >= 2
        at = at - going
        low, high = np.where(going, new_low, low), np.where(going, new_high, high)
        stopped = ~going | (at == start)
        if not stopped.any():
            continue
        for k in np.flatnonzero(stopped & (end - at >= window)).tolist():
            s = int(start[k])
            found[active[k]][at[k] - s : end[k] - window - s + 1] = True
        done = stopped & (at == start)
        end = np.where(stopped, np.minimum(end - 1, at + window - 1), end)
        at = np.where(stopped, end, at)
        low, high = np.where(stopped, 0, low), np.where(stopped, index.size, high)
        stay = ~done & (end - start >= window)
        if not stay.all():
            active, start, end, at, low, high = (x[stay] for x in (active, start, end, at, low, high))
    return found


# ---------------------------------------------------------------------------------- the steps


def _report_anchors(window: int):
    def report(table: pa.Table) -> pa.Table:
        hashes, anchors, contents = WordHashes(), [], []
        for _, _, seg in read_segments(table, hashes, window):
            if len(seg.anchor):
                anchors.append(seg.anchor)
                contents.append(seg.content())
        anchor = np.concatenate(anchors) if anchors else np.zeros(0, np.uint64)
        content = np.concatenate(contents) if contents else np.zeros(0, np.uint64)
        order = np.lexsort((content, anchor))
        anchor, content = anchor[order], content[order]
        new = np.ones(len(anchor), bool)
        new[1:] = anchor[1:] != anchor[:-1]
        other = new.copy()
        other[1:] |= content[1:] != content[:-1]
        edges = np.flatnonzero(new)
        total = np.diff(np.append(edges, len(anchor)))
        distinct = np.add.reduceat(other.astype(np.int64), edges) if len(edges) else total
        chunk = table.column("chunk")[0].as_py()
        return pa.table({"anchor": anchor[edges].view(np.int64), "chunk": np.full(len(edges), chunk, np.int32), "seen": np.minimum(total, 2).astype(np.int32), "kinds": distinct.astype(np.int32)})

    return report


def _send_segments(window: int, shards: int):
    def send(docs: pa.Table, repeated: pa.Table) -> pa.Table:
        cold, hot = (np.sort(repeated.filter(pc.equal(repeated.column("hot"), pa.scalar(h))).column("anchor").to_numpy().view(np.uint64)) for h in (False, True))
        sent: dict[bytes, list] = {}
        if docs.num_rows and repeated.num_rows:
            hashes = WordHashes()
            for _, _, seg in read_segments(docs, hashes, window):
                for apart, wanted in ((False, cold), (True, hot)):
                    for k in np.flatnonzero(member(seg.anchor, wanted)).tolist():
                        first, count, anchor = int(seg.first[k]), int(seg.count[k]), int(seg.anchor[k])
                        for body in [seg.body(first + j, 1) for j in range(count)] if apart else [seg.body(first, count)]:
                            if (old := sent.get(body)) is not None:
                                old[0] += 1
                            else:
                                sent[body] = [1, anchor, apart]
        chunk = (docs if docs.num_rows else repeated).column("chunk")[0].as_py()
        keys = [digest(b) for b in sent]
        anchor = np.fromiter((x[1] for x in sent.values()), np.uint64, len(sent))
        apart = [x[2] for x in sent.values()]
        shard = [(int.from_bytes(k[:8], "little") if h else int(a)) % shards for k, a, h in zip(keys, anchor.tolist(), apart, strict=True)]
        return pa.table({"shard": pa.array(shard, pa.int32()), "chunk": pa.array([chunk] * len(sent), pa.int32()), "anchor": anchor.view(np.int64), "hot": pa.array(apart, pa.bool_()), "key": pa.array(keys, pa.binary()), "body": pa.array(list(sent), pa.binary()), "copies": pa.array([min(x[0], 2) for x in sent.values()], pa.int32())})

    return send


def member(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


def _search_shard(window: int):
    def search(table: pa.Table) -> pa.Table:
        keys, place = table.column("key").to_pylist(), {}
        at = np.fromiter((place.setdefault(k, len(place)) for k in keys), np.int64, len(keys))
        _, firsts = np.unique(at, return_index=True)
        bodies = table.column("body").take(pa.array(firsts)).to_pylist()
        weights = np.bincount(at, table.column("copies").to_numpy(), len(place)).astype(np.int64)
        bits = np.fromiter((int((w << np.arange(len(w))).sum()) for w in repeated_windows(bodies, weights, window)), np.int64, len(place))[at]
        keep = np.flatnonzero(bits)
        out = table.select(["chunk", "anchor", "hot", "key"]).take(pa.array(keep))
        return out.append_column("bits", pa.array(bits[keep], pa.int64()))

    return search


def _mark_words(window: int, with_text: bool):
    def mark(docs: pa.Table, replies: pa.Table) -> pa.Table:
        anchors = {h: np.unique(replies.filter(pc.equal(replies.column("hot"), pa.scalar(h))).column("anchor").to_numpy().view(np.uint64)) for h in (False, True)}
        bits = dict(zip(replies.column("key").to_pylist(), replies.column("bits").to_pylist(), strict=True))
        hashes, n_words, n_removed, digests, kept_texts = WordHashes(), [], [], [], []
        for begin, until, seg in read_segments(docs, hashes, window):
            if with_text:
                kept_texts += docs.column("text").slice(begin, until - begin).to_pylist()
            place = len(n_words)
            edges = np.zeros(len(seg.words) + 1, np.int64)
            begins = []
            for hot, wanted in anchors.items():
                for k in np.flatnonzero(member(seg.anchor, wanted)).tolist():
                    first, count = int(seg.first[k]), int(seg.count[k])
                    if hot:
                        begins += [first + j for j in range(count) if digest(seg.body(first + j, 1)) in bits]
                    elif b := bits.get(digest(seg.body(first, count)), 0):
                        begins += [first + j for j in range(count) if b >> j & 1]
            np.add.at(edges, begins, 1)
            np.add.at(edges, np.array(begins, np.int64) + window, -1)
            gone = np.cumsum(edges) > 0
            for start, end in zip(seg.offsets[:-1].tolist(), seg.offsets[1:].tolist(), strict=True):
                words, removed = seg.words[start:end], gone[start:end]
                if lost := int(removed.sum()):
                    words = [w for w, r in zip(words, removed.tolist(), strict=True) if not r]
                kept = b" ".join(words)
                n_words.append(end - start)
                n_removed.append(lost)
                digests.append(hashlib.sha256(kept).hexdigest())
                if with_text and lost:
                    kept_texts[place] = kept.decode()
                place += 1
        out = {"row": docs.column("row"), "n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()), "kept_sha256": pa.array(digests, pa.string())}
        return pa.table(out | ({"kept_text": pa.array(kept_texts, pa.string())} if with_text else {}))

    return mark


def substring_dedup(docs: DataFrame, text_col: str = "text", window: int = 35, with_text: bool = False, chunk_bytes: int = CHUNK_BYTES, least_chunks: int = 64, hot_segments: int = HOT_SEGMENTS) -> DataFrame:
    """Return ``row`` (a struct of the columns of ``docs`` but the text), ``n_words``, ``n_removed``,
    ``kept_sha256`` and, if asked for, ``kept_text`` (the very text where nothing is removed). ``window`` is 2 to 64 words."""
    if not 2 <= window <= FMIndex.DEPTH:
        raise ValueError(f"window must be 2 to {FMIndex.DEPTH} words")
    bounded_batches(docs.sparkSession)
    chunks = pieces_for(text_bytes(docs, text_col), chunk_bytes, least_chunks)
    shards = 2 * chunks
    carried = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    text = F.col(f"`{text_col}`").cast("string")
    dealt = docs.select(F.struct(*carried, F.lit(0).alias("__row")).alias("row"), text.alias("text"), F.pmod(F.xxhash64(*carried, text), F.lit(chunks)).cast("int").alias("chunk"))
    anchors = dealt.groupBy("chunk").applyInArrow(_report_anchors(window), "anchor long, chunk int, seen int, kinds int")
    same = Window.partitionBy("anchor")
    repeated = anchors.withColumns({"seen": F.sum("seen").over(same), "kinds": F.sum("kinds").over(same)}).where("seen > 1").select("chunk", "anchor", (F.col("kinds") > hot_segments).alias("hot"))
    sent = dealt.groupBy("chunk").cogroup(repeated.groupBy("chunk")).applyInArrow(_send_segments(window, shards), "shard int, chunk int, anchor long, hot boolean, key binary, body binary, copies int")
    replies = sent.groupBy("shard").applyInArrow(_search_shard(window), "chunk int, anchor long, hot boolean, key binary, bits long")
    fields = [T.StructField("row", dealt.schema["row"].dataType), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept_sha256", T.StringType())]
    fields += [T.StructField("kept_text", T.StringType())] if with_text else []
    return dealt.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(_mark_words(window, with_text), T.StructType(fields))


def op1_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """Words of 35-word passages that also start elsewhere, removed from all of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return substring_dedup(docs).select(F.col("row.doc_id").alias("doc_id"), "n_words", "n_removed", "kept_sha256")


OP1_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT doc_id, s, array_to_string(w[s:s + 34], ' ') AS t
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS s FROM d WHERE len(w) >= 35)
),
dup AS (SELECT t FROM win GROUP BY t HAVING count(*) > 1),
hit AS (SELECT DISTINCT doc_id, s + k AS p FROM win JOIN dup USING (t), range(0, 35) r(k)),
words AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS p FROM d),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS k, count(*) AS n FROM words ANTI JOIN hit USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, len(w)::BIGINT - coalesce(n, 0) AS n_removed, sha256(coalesce(k, '')) AS kept_sha256
FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id
"""
