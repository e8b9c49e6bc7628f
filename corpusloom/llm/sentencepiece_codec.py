"""SentencePiece encoding and decoding of a BPE model with byte fallback, by vectorised merge rounds.

No piece of such a model has a space inside, only in front, so a text is cut before each run of
spaces; and between Latin letters and other characters, and around line feeds, if (as is checked)
no piece has the two together. The units repeat: their ids are remembered up to a bound. Unknown units of a batch become flat arrays of character symbols; each round takes the
segmented minimum of pair ranks, merges its places from the left at once, and compacts, until no
pair remains, however long a unit is. A rank belongs to the merged piece here, so a merge can make a
pair of a better rank than its own; further merges of that round then wait (see merging.py).

Defined cases: null and empty texts give the begin and end ids alone and decode to an empty text;
characters outside the vocabulary become byte pieces; U+2581 decodes to a space, as in the library;
very long texts are encoded whole; repeated rows are each returned; an empty table gives no rows;
columns besides the text are carried in a struct, so any name is fine.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.merging import PairTable, merge_rounds
from corpusloom.llm.shared import bounded_batches, slices
from corpusloom.llm.token_counts import LETTERS, tokenizer_path

SPACE = "▁"
REMEMBERED = 300_000


class PieceModel:
    def __init__(self, path: str):
        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size = sp.get_piece_size()
        special = {i for i in range(size) if sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i)}
        self.pieces = [sp.id_to_piece(i) for i in range(size)]
        self.byte_id = {int(self.pieces[i][3:5], 16): i for i in range(size) if sp.is_byte(i)}
        self.bytes_of = {i: b for b, i in self.byte_id.items()}
        self.begin, self.end = sp.bos_id(), sp.eos_id()
        normal = {p: i for i, p in enumerate(self.pieces) if i not in special}
        if any(SPACE in p.lstrip(SPACE) for p in normal) or len(self.byte_id) != 256:
            raise ValueError("the model needs byte fallback, and spaces only in front of pieces")
        scores = -np.array([sp.get_score(i) for i in range(size)], np.float64)
        rank = np.unique(scores, return_inverse=True)[1]
        # characters that are in pieces but are none themselves get numbers of their own
        self.symbol = dict(normal)
        for p in normal:
            for c in p:
                self.symbol.setdefault(c, size + len(self.symbol))
        found = [(self.symbol[p[:k]], self.symbol[p[k:]], rank[i], i) for p, i in normal.items() for k in range(1, len(p)) if p[:k] in self.symbol and p[k:] in self.symbol]
        self.pairs = PairTable(*(np.array(x, np.int64) for x in zip(*found, strict=True)))
        self.size = size
        self.of_point = np.full(0x110000, -1, np.int32)
        for c, i in self.symbol.items():
            if len(c) == 1:
                self.of_point[ord(c)] = i
        self.spelled = {i: c for c, i in self.symbol.items() if i >= size}
        # no merge crosses a cut between characters that stand together in no piece
        mixed = re.compile(rf"[{LETTERS}][^{LETTERS}]|[^{LETTERS}{SPACE}][{LETTERS}]|.\n|\n.", re.S)
        fine = not any(mixed.search(p) for p in normal)
        self.cut = re.compile(rf"{SPACE}*[{LETTERS}]+|\n|{SPACE}*[^{SPACE}{LETTERS}\n]+|{SPACE}+" if fine else rf"{SPACE}*[^{SPACE}]+|{SPACE}+")

    def units(self, text: str) -> list[str]:
        """The text as the model sees it: a space in front, spaces marked."""
        return self.cut.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def encode_units(self, units: list[str]) -> list[bytes]:
        """The ids of each unit, as little-endian unsigned 32-bit integers."""
        out = [b""] * len(units)
        points = np.frombuffer("".join(units).encode("utf-32-le"), np.uint32)
        flat = self.of_point[points].astype(np.int64)
        # a character in no piece is in no pair; its negative number says where it stands
        unknown = np.flatnonzero(flat < 0)
        flat[unknown] = -1 - unknown
        left, counts = merge_rounds(flat, np.fromiter(map(len, units), np.int64, len(units)), self.pairs, checked=True)
        raw, ends = left.astype("<u4").tobytes(), np.cumsum(counts)
        for i, (a, b) in enumerate(zip((4 * (ends - counts)).tolist(), (4 * ends).tolist(), strict=True)):
            out[i] = raw[a:b]
        odd = np.unique(np.searchsorted(ends, np.flatnonzero((left < 0) | (left >= self.size)), side="right"))
        for k in odd.tolist():
            ids = []
            for v in left[ends[k] - counts[k] : ends[k]].tolist():
                if 0 <= v < self.size:
                    ids.append(v)
                else:
                    ids += [self.byte_id[b] for b in (chr(points[-1 - v]) if v < 0 else self.spelled[v]).encode()]
            out[k] = np.array(ids, "<u4").tobytes()
        return out

    def decode_unit(self, ids) -> str:
        """The text of a unit's ids; byte pieces are UTF-8."""
        said = "".join([self.pieces[i] for i in ids])
        if "<0x" in said:
            parts: list[bytes] = [bytes([b]) if (b := self.bytes_of.get(i)) is not None else self.pieces[i].encode() for i in ids]
            said = b"".join(parts).decode("utf-8", "replace")
        return said.replace(SPACE, " ")


class Codec:
    """Encodes and decodes texts, with the units seen remembered as (ids as bytes, text)."""

    def __init__(self, path: str):
        self.model = PieceModel(path)
        self.ids: dict[str, bytes] = {}
        self.texts: dict[str, str] = {}
        self.begin, self.end = (np.array([i], "<u4").tobytes() for i in (self.model.begin, self.model.end))

    def run(self, texts: list[str | None]) -> list[tuple[bytes, str]]:
        """For each text its ids, as little-endian unsigned 32-bit integers, and what they decode to."""
        if len(self.ids) > REMEMBERED:
            self.ids, self.texts = {}, {}
        cut = [self.model.units(t or "") for t in texts]
        fresh = list(set().union(*cut).difference(self.ids))
        for unit, ids in zip(fresh, self.model.encode_units(fresh), strict=True):
            self.ids[unit] = ids
            self.texts[unit] = self.model.decode_unit(memoryview(ids).cast("I"))
        get, say = self.ids.__getitem__, self.texts.__getitem__
        # the space that was put in front goes again
        return [(b"".join((self.begin, *map(get, us), self.end)), "".join(map(say, us))[1:]) for us in cut]


def _running(path: str, whole: bool):
    def run(batches):
        codec = Codec(path)
        for batch in batches:
            text = batch.column("text")
            sizes = pc.fill_null(pc.binary_length(text), 0).to_numpy()
            counts, hashes, back, decoded, ids = [], [], [], [], []
            for a, b in slices(batch, sizes):
                for raw, said in codec.run(text.slice(a, b - a).to_pylist()):
                    counts.append(len(raw) // 4)
                    hashes.append(hashlib.sha256(raw).hexdigest())
                    back.append(hashlib.sha256(said.encode()).hexdigest())
                    if whole:
                        decoded.append(said)
                        ids.append(np.frombuffer(raw, "<u4").astype(np.int32))
            columns = [batch.column("row"), pa.array(counts, pa.int64()), pa.array(hashes, pa.string()), pa.array(back, pa.string())]
            names = ["row", "n_tokens", "ids_sha256", "decoded_sha256"]
            if whole:
                columns += [pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.string())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def encode_decode(docs: DataFrame, model: str, text_col: str = "text", whole: bool = False) -> DataFrame:
    """``row`` (a struct of the columns of ``docs`` but the text), ``n_tokens``, ``ids_sha256``,
    ``decoded_sha256`` and, if ``whole``, ``ids`` and ``decoded`` themselves."""
    bounded_batches(docs.sparkSession)
    carried = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    given = docs.select(F.struct(*carried, F.lit(0).alias("__row")).alias("row"), F.col(f"`{text_col}`").cast("string").alias("text"))
    fields = [given.schema["row"], T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    if whole:
        fields += [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())]
    return given.mapInArrow(_running(model, whole), T.StructType(fields))


def op7_sentencepiece_codec(spark, sf_dir: str) -> DataFrame:
    """Each whole text of ``documents`` encoded with begin and end ids, and decoded again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return encode_decode(docs, tokenizer_path("piece_bpe_32k.model")).select(F.col("row.doc_id").alias("doc_id"), "n_tokens", "ids_sha256", "decoded_sha256")
