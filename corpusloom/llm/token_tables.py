"""Token ids in sorted-string tables: sorted keys in prefix-compressed blocks, a sparse index of
blocks, a Bloom filter and a footer, so that a lookup is a binary search and one block.

Documents are dealt by ranges of their id and sorted; each range writes one file to the shared
folder under a name of its own attempt, and its row in the manifest says which file counts, so a
task that runs twice does no harm. A file::

    block*   zstd(entry*), entry = varints of shared, rest and value lengths, rest of the key, value
    index    zstd(for each block: varint length of its last key, the key, offset and length)
    bloom    bits, ``PROBES`` for each key
    footer   offsets of index and bloom, entries, id width, magic

A key is the id as 8 bytes big-endian, sign bit flipped; a null id is the empty key and sorts first.
A value holds the ids, of 2 or 4 bytes by the vocabulary's size. Equal ids are separate entries,
in the order of a hash of their texts, and ranges are cut by id and that hash, so many rows of one id,
or of none, are in several files. A lookup reads the footer, the index, the filter and the blocks of
its key by their ranges. Defined cases: a null text is an empty one, and holds the end id alone; an
empty table writes no entry; very long texts are one entry; columns besides id and text are ignored.
"""

from __future__ import annotations

import functools
import os
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.shared import MIB, bounded_batches, materialize, pieces_for, shared_dir, shed, slices, text_bytes
from corpusloom.llm.token_counts import byte_characters, byte_level, pretokens, tokenizer_path

MAGIC, FOOTER = b"CLSSTAB1", struct.Struct("<QQQQQI8s")
BLOCK_BYTES, BITS_A_KEY, PROBES = 64 * 1024, 10, 7
FILE_BYTES = 16 * MIB
REMEMBERED = 600_000


def varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def read_varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 127) << shift
        if byte < 128:
            return value, at
        shift += 7


def key_of(doc_id: int | None) -> bytes:
    return b"" if doc_id is None else struct.pack(">Q", (doc_id + (1 << 63)) & (1 << 64) - 1)


def id_of(key: bytes) -> int | None:
    return struct.unpack(">Q", key)[0] - (1 << 63) if key else None


def probes(key: bytes, bits: int) -> list[int]:
    h = xxhash.xxh3_128_intdigest(key)
    a, b = h & (1 << 64) - 1, h >> 64 | 1
    return [(a + i * b) % bits for i in range(PROBES)]


class TableWriter:
    """Entries must come in key order."""

    def __init__(self, out, width: int):
        self.out, self.width, self.at = out, width, 0
        self.pack = zstandard.ZstdCompressor(level=1)
        self.block, self.last, self.index, self.keys = bytearray(), b"", [], []

    def add(self, key: bytes, value: bytes) -> None:
        shared = 0
        if self.block:
            shared = len(os.path.commonprefix((self.last, key)))
        self.block += varint(shared) + varint(len(key) - shared) + varint(len(value)) + key[shared:] + value
        self.last = key
        self.keys.append(key)
        if len(self.block) >= BLOCK_BYTES:
            self._flush()

    def _write(self, data: bytes) -> int:
        start, self.at = self.at, self.at + len(data)
        self.out.write(data)
        return start

    def _flush(self) -> None:
        if self.block:
            data = self.pack.compress(bytes(self.block))
            self.index.append((self.last, self._write(data), len(data)))
            self.block = bytearray()

    def close(self) -> None:
        self._flush()
        index = self._write(self.pack.compress(b"".join(varint(len(k)) + k + varint(o) + varint(n) for k, o, n in self.index)))
        bits = max(64, len(self.keys) * BITS_A_KEY)
        bloom = np.zeros(bits, np.uint8)
        bloom[[p for k in dict.fromkeys(self.keys) for p in probes(k, bits)]] = 1
        start = self._write(np.packbits(bloom, bitorder="little").tobytes())
        self._write(FOOTER.pack(index, start - index, start, bits, len(self.keys), self.width, MAGIC))


class Table:
    """A table of which only what is needed is read. read: the bytes at an offset, of a length."""

    def __init__(self, read: Callable[[int, int], bytes], size: int):
        self.read, self.unpack = read, zstandard.ZstdDecompressor()
        index, length, self.bloom, self.bits, self.entries, self.width, magic = FOOTER.unpack(read(size - FOOTER.size, FOOTER.size))
        if magic != MAGIC:
            raise ValueError("not a token table")
        raw, at = self.unpack.decompress(read(index, length)), 0
        self.last: list[bytes] = []
        self.blocks: list[tuple[int, int]] = []
        while at < len(raw):
            n, at = read_varint(raw, at)
            self.last.append(raw[at : at + n])
            offset, at = read_varint(raw, at + n)
            n, at = read_varint(raw, at)
            self.blocks.append((offset, n))

    @classmethod
    def of(cls, data: bytes) -> Table:
        return cls(lambda start, n: data[start : start + n], len(data))

    @classmethod
    def opened(cls, path: str) -> Table:
        system, inside = open_path(path)
        file = system.open_input_file(inside)
        return cls(lambda start, n: file.read_at(n, start), file.size())

    @functools.cached_property
    def filter(self) -> bytes:
        return self.read(self.bloom, -(-self.bits // 8))

    def block(self, k: int) -> Iterator[tuple[bytes, bytes]]:
        offset, length = self.blocks[k]
        raw, at, key = self.unpack.decompress(self.read(offset, length)), 0, b""
        while at < len(raw):
            shared, at = read_varint(raw, at)
            rest, at = read_varint(raw, at)
            size, at = read_varint(raw, at)
            key = key[:shared] + raw[at : at + rest]
            at += rest
            yield key, raw[at : at + size]
            at += size

    def __iter__(self) -> Iterator[tuple[bytes, bytes]]:
        for k in range(len(self.blocks)):
            yield from self.block(k)

    def ids(self, value: bytes) -> np.ndarray:
        return np.frombuffer(value, f"<u{self.width}")

    def get(self, doc_id: int | None) -> list[np.ndarray]:
        """The ids of every entry with this document id."""
        key = key_of(doc_id)
        if not all(self.filter[p >> 3] >> (p & 7) & 1 for p in probes(key, self.bits)):
            return []
        low, high = 0, len(self.last)
        while low < high:
            middle = (low + high) // 2
            low, high = (middle + 1, high) if self.last[middle] < key else (low, middle)
        found = []
        while low < len(self.blocks):
            found += [self.ids(v) for k, v in self.block(low) if k == key]
            if self.last[low] > key:
                break
            low += 1
        return found


class Encoder(dict):
    """Ids of pre-tokens, by the tokenizers library's model, remembered up to a bound."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        self.width = 2 if self.library.get_vocab_size() <= 1 << 16 else 4
        self.kind = {array(c).itemsize: c for c in "HI"}[self.width]
        self.written = dict(enumerate(byte_characters()))
        byte_level(path)
        known = sorted(self.library.get_added_tokens_decoder().items(), key=lambda x: -len(x[1].content))
        self.special = {t.content: array(self.kind, [i]).tobytes() for i, t in known}
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None

    def __missing__(self, pretoken: str) -> bytes:
        tokens = self.model.tokenize(pretoken.encode().decode("latin-1").translate(self.written))
        self[pretoken] = ids = array(self.kind, [t.id for t in tokens]).tobytes()
        return ids

    def encode(self, texts: list[str | None], end: int) -> list[bytes]:
        shed(self, REMEMBERED)
        get, last, out = self.__getitem__, array(self.kind, [end]).tobytes(), []
        for text in texts:
            parts = [text or ""]
            if text and self.cut and self.cut.search(text):
                parts = self.cut.split(text)
            ids = [self.special[p] if i % 2 else b"".join(map(get, pretokens(p))) for i, p in enumerate(parts)]
            out.append(b"".join((*ids, last)))
        return out


def open_path(path: str):
    """The file system and the path in it. pyarrow knows file:, hdfs: and the usual object stores."""
    if "://" not in path:
        path = "file://" + path.removeprefix("file:")
    return pyarrow.fs.FileSystem.from_uri(path)


def _writing(folder: str, tokenizer: str, end: int):
    def run(batches):
        context = TaskContext.get()
        shard = context.partitionId()
        path = f"{folder}/{shard:07d}-{context.taskAttemptId()}-{uuid.uuid4().hex}.sst"
        system, inside = open_path(path)
        encoder, table, out, tokens, docs = None, None, None, 0, 0
        for batch in batches:
            if out is None:
                encoder, out = Encoder(tokenizer), system.open_output_stream(inside)
                table = TableWriter(out, encoder.width)
            sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy()
            for a, b in slices(batch, sizes):
                ids = batch.column("id").slice(a, b - a).to_pylist()
                for doc_id, value in zip(ids, encoder.encode(batch.column("text").slice(a, b - a).to_pylist(), end), strict=True):
                    table.add(key_of(doc_id), value)
                    tokens += len(value) // encoder.width
                    docs += 1
        if out is not None:
            table.close()
            out.close()
            yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32()), "path": [path], "docs": [docs], "tokens": [tokens]})

    return run


def _reading(batches):
    for batch in batches:
        for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist(), strict=True):
            system, inside = open_path(path)
            with system.open_input_stream(inside) as f:
                table = Table.of(f.read())
            rows: list[tuple] = []
            for key, value in table:
                ids = table.ids(value).astype("<u4")
                rows.append((id_of(key), start, len(ids), zlib.crc32(ids.tobytes())))
                start += len(ids)
            for a in range(0, len(rows), 10_000):
                columns = list(zip(*rows[a : a + 10_000], strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc_id", "start", "n_tokens", "ids_crc32"])


def write_tables(docs: DataFrame, tokenizer: str, end: int = 2, id_col: str = "doc_id", text_col: str = "text", file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write the tables and return the manifest: shard, path, docs, tokens, start (ids before it)."""
    spark = docs.sparkSession
    bounded_batches(spark)
    text = F.col(f"`{text_col}`").cast("string")
    n = pieces_for(text_bytes(docs, text_col), file_bytes, 8)
    folder = f"{shared_dir(spark)}/tables-{uuid.uuid4().hex}"
    system, inside = open_path(folder)
    system.create_dir(inside, recursive=True)
    ordered = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), text.alias("text")).repartitionByRange(n, "id", F.xxhash64("text")).sortWithinPartitions("id", F.xxhash64("text"))
    manifest = materialize(ordered.mapInArrow(_writing(folder, tokenizer, end), "shard int, path string, docs long, tokens long"), "manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row for each file
    return manifest.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0)))


def read_tables(manifest: DataFrame) -> DataFrame:
    """What the files hold: doc_id, start, n_tokens, ids_crc32."""
    n = max(8, int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return manifest.select("shard", "path", "start").repartition(n, "shard").mapInArrow(_reading, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op10_token_tables(spark, sf_dir: str) -> DataFrame:
    """Token ids of each whole text of ``documents``, written as tables and read back."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return read_tables(write_tables(docs, tokenizer_path("byte_bpe_50k.json")))
