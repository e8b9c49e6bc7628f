"""The default cleaning of many rows at once, with the results of ``rows``: numpy over the letters of a
column's texts, one after the other, where a byte is a letter. Rows in which markup or an address may
stand are loosened one by one first; placeholder terms and repeats are taken out one by one after it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from corpusloom import lexicon as L
from corpusloom.functions import rows as R

END = 10  # before the first text, and after each; no other white space but spaces is left by then
_LOWER = bytes(R._LATIN[c] for c in bytes(range(256)).lower())
#: What a text has in which anything is to be loosened.
_ODD = (b"<", b"@", b"`", b"*", b"_", b"&", b"](", b"://")
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(8)] + [(1 << 64) - 1], np.uint64)
_LONGEST = 7  # bytes of a word that is looked up


class Lookup:
    """Which words are in a short list: a hash table of their bytes, in which no two share a place."""

    def __init__(self, words):
        keys = np.array(sorted({int.from_bytes(w, "little") for w in words if w}), np.uint64)
        self.shift, odd = np.uint64(64 - 14), np.random.default_rng(0)
        while True:
            self.by = np.uint64(int(odd.integers(1 << 63)) * 2 + 1)
            places = keys * self.by >> self.shift
            if len(set(places.tolist())) == len(keys):
                break
        self.table = np.zeros(1 << 14, np.uint64)
        self.table[places] = keys

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        return self.table.take((keys * self.by >> self.shift).view(np.int64)) == keys


def coded(words, arabic: bool) -> list[bytes]:
    """Those that can be words of a cleaned text, as its bytes."""
    found = [w.encode("iso8859_6" if arabic else "ascii", "ignore") for w in words]
    return [b for w, b in zip(words, found, strict=True) if b and len(b) == len(w)]


def short(words) -> bool:
    """Whether a list is one for ``Lookup``."""
    return len(words) <= 128 and all(len(w) <= _LONGEST for w in words)


class Words:
    """Of the words of a column: where they begin, their lengths, their first eight bytes."""

    def __init__(self, a: np.ndarray):
        inside = a > 32
        edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        self.starts, self.lengths = edges[::2], edges[1::2] - edges[::2]
        self.eights = np.ndarray(len(a), "<u8", a.tobytes() + bytes(8), strides=(1,))
        self.keys = self.eights[self.starts] & _FIRST.take(self.lengths, mode="clip")

    def chosen(self, which: np.ndarray) -> None:
        self.starts, self.lengths, self.keys = self.starts[which], self.lengths[which], self.keys[which]

    def repeats(self) -> np.ndarray:
        """Which words are the one before again, have three bytes or more and are not all digits; of
        words in one row."""
        at = np.flatnonzero((self.keys[1:] == self.keys[:-1]) & (self.lengths[1:] == self.lengths[:-1]) & (self.lengths[1:] >= 3)) + 1
        k = 8
        while (long := self.lengths[at] > k).any():
            rest = _FIRST.take(self.lengths[at] - k, mode="clip")
            here, before = (self.eights[np.where(long, self.starts[i] + k, 0)] & rest for i in (at, at - 1))
            at = at[~long | (here == before)]
            k += 8
        digit = self.keys[at] & np.uint64(255) <= 57
        if digit.any():
            ends = self.starts[at] + self.lengths[at]
            blob = self.eights.base
            at = at[[not d or not blob[s:e].isdigit() for d, s, e in zip(digit.tolist(), self.starts[at].tolist(), ends.tolist(), strict=True)]]
        return at


def _all(blob: bytes, term: bytes) -> list[int]:
    found, at = [], blob.find(term)
    while at >= 0:
        found.append(at)
        at = blob.find(term, at + 1)
    return found


def _rows(ends: np.ndarray, positions) -> list[int]:
    return np.unique(np.searchsorted(ends, np.asarray(positions, np.int64)) - 1).tolist()


def _ends(blob: bytes) -> np.ndarray:
    return np.array(_all(blob, b"\n"), np.int64)


def _having(blob: bytes, ends: np.ndarray, term: bytes) -> list[int]:
    """The rows that have a term; after one the search goes on with the next row."""
    if term[:1] not in blob:
        return []
    found, at = [], blob.find(term)
    while at >= 0:
        found.append(r := int(np.searchsorted(ends, at)) - 1)
        at = blob.find(term, ends[r + 1])
    return found


def _replaced(blob: bytes, cuts) -> bytes:
    """With other bytes from some places to others."""
    parts, done = [], 0
    for start, stop, new in cuts:
        parts += (blob[done:start], new)
        done = stop
    return b"".join([*parts, blob[done:]])


def _loosened(texts: pa.Array, entities: bool, latin: bool) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The texts with a byte around each, where these bytes are, and the number of characters of each."""
    texts = pc.fill_null(texts, "")
    chars = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    bytes_each = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    blob = b"\n".join([b"", *texts.cast(pa.binary()).to_pylist(), b""])
    ends = np.concatenate(([0], np.cumsum(bytes_each + 1)))
    odd = {r for term in _ODD if entities or term != b"&" for r in _having(blob, ends, term)}
    odd.update(_having(blob.lower(), ends, b"www."))
    if latin:  # the only others with a lower case in ASCII
        odd.update(_having(blob, ends, "\u212a".encode()), _having(blob, ends, "\u0130".encode()))
    new = {}
    for r in sorted(odd):
        t = R.loosened(blob[ends[r] + 1 : ends[r + 1]].decode(), entities)
        if latin:
            t = t.lower()
        new[r], chars[r] = t.encode(), len(t)
        bytes_each[r] = len(new[r])
    if new:
        blob, ends = _replaced(blob, [(ends[r] + 1, ends[r + 1], t) for r, t in new.items()]), np.concatenate(([0], np.cumsum(bytes_each + 1)))
    return blob, ends, chars


def latin_letters(texts: pa.Array, entities: bool) -> np.ndarray:
    blob, ends, _ = _loosened(texts, entities, True)
    a = np.frombuffer(bytearray(blob.translate(_LOWER)), np.uint8)
    a[ends] = END
    return a


def arabic_letters(texts: pa.Array, entities: bool, fold: bool) -> np.ndarray:
    blob, _, chars = _loosened(texts, entities, False)
    if np.frombuffer(blob, np.uint8).max() < 0xF0:
        codes = np.frombuffer(blob.decode().encode("utf-16-le"), "<u2")
    else:
        codes = np.minimum(np.frombuffer(blob.decode().encode("utf-32-le"), "<u4"), 0xFFFF)
    a = R._TABLES[fold].take(codes)
    a[np.concatenate(([0], np.cumsum(chars + 1)))] = END
    return a if a.all() else a[a != 0]  # without marks


def arabizi_letters(texts: pa.Array, entities: bool, most_repeats: int, vowels: bool) -> np.ndarray:
    a, most = latin_letters(texts, entities), max(1, most_repeats)
    same, more = a[1:] == a[:-1], a[most:] > 32
    for k in range(most):
        more &= same[k : len(more) + k]
    if more.any():
        a = np.concatenate((a[:most], a[most:][~more]))
    if not vowels:
        a = np.frombuffer(bytearray(a.tobytes().translate(None, b"aeiou")), np.uint8)
    alone, letter = (a >= 48) & (a <= 57), a >= 97
    alone[1:] &= ~letter[:-1]
    alone[:-1] &= ~letter[1:]
    a[alone] = 32
    return a


_VARIANTS = {int.from_bytes(b, "little"): L.DARIJA_VARIANTS[w].encode("iso8859_6") for w in L.DARIJA_VARIANTS for b in coded([w], True) if w != L.DARIJA_VARIANTS[w]}
_IS_VARIANT = Lookup(k.to_bytes(8, "little") for k in _VARIANTS)


def with_variants(a: np.ndarray, words: Words) -> tuple[np.ndarray, Words]:
    found = np.flatnonzero(_IS_VARIANT(words.keys))
    if not len(found):
        return a, words
    starts = words.starts[found]
    cuts = zip(starts.tolist(), (starts + words.lengths[found]).tolist(), [_VARIANTS[k] for k in words.keys[found].tolist()], strict=True)
    a = np.frombuffer(bytearray(_replaced(a.tobytes(), cuts)), np.uint8)
    return a, Words(a)


_MARKER = Lookup(coded(L.DARIJA_MARKERS, True))
_LIKELY = [t for t in (*L.TARGETS, *L.METADATA_LANGUAGES) if not any(u != t and u in t for u in L.METADATA_LANGUAGES)]
_LIKELY = [t for t in coded(_LIKELY, False) if not set(t) - set(R._LATIN)]
_TERMS = {c: coded([t for t, _ in places], c in ("darija_arabic", "modern_standard_arabic")) for c, places in R._PLACES.items()}


class Column:
    """The cleaned texts of one column: ``blob`` has them in single bytes, an END around each."""

    def __init__(self, name: str, a: np.ndarray, gone: Lookup):
        self.name, self.arabic = name, name in ("darija_arabic", "modern_standard_arabic")
        words = Words(a)
        if name == "darija_arabic":
            a, words = with_variants(a, words)
        drop = gone(words.keys)
        edges = np.zeros(len(a), np.int8)
        edges[words.starts[drop]], edges[words.starts[drop] + words.lengths[drop]] = 1, -1
        inside = (a > 32) & ~np.cumsum(edges, dtype=np.int8).view(bool)
        words.chosen(~drop)
        before = _ends(a.tobytes())
        firsts = np.searchsorted(words.starts, before)
        self.word_counts = np.diff(firsts)
        keep = inside.copy()
        keep[:-1] |= inside[1:]  # the byte before a word
        keep[words.starts[firsts[:-1][self.word_counts > 0]] - 1] = False
        keep[before] = True
        self.blob = (a * keep).tobytes().translate(None, b"\0")
        sizes = np.concatenate(([0], np.cumsum(words.lengths + 1)))
        self.ends = np.concatenate(([0], np.cumsum(np.diff(sizes[firsts]) + (self.word_counts == 0))))
        again = words.repeats()
        rows = np.searchsorted(before, words.starts[again]) - 1
        again, self.repeat_rows = (x[again > firsts[rows]] for x in (again, rows))
        self.repeats = self.ends[self.repeat_rows] + sizes[again] - sizes[firsts[self.repeat_rows]]
        self.repeat_ends = self.repeats + words.lengths[again] + 1
        self.marked = _rows(before, words.starts[_MARKER(words.keys)]) if name == "modern_standard_arabic" else []

    def text(self, r: int) -> str:
        return self.blob[self.ends[r] + 1 : self.ends[r + 1]].decode("iso8859_6")

    def having(self, terms) -> list[int]:
        return sorted({r for term in terms for r in _having(self.blob, self.ends, term)})

    def metadata(self) -> list[int]:
        return [] if self.arabic else [r for r in self.having(_LIKELY) if R.reads_like_metadata(self.text(r))]

    def less(self, placeholders: np.ndarray, repeats: np.ndarray) -> dict[int, str]:
        """Adds to the counts how many each row has. Returned are the rows that may have placeholders,
        without them and without repeats; of the others repeats are known."""
        new = {}
        for r in self.having(_TERMS[self.name]):
            placed, n = R.replace_placeholders(self.text(r), self.name)
            new[r], m = R.drop_repeats(placed)
            placeholders[r] += n
            repeats[r] += m - np.count_nonzero(self.repeat_rows == r)
        repeats += np.bincount(self.repeat_rows, minlength=len(repeats)).astype(repeats.dtype)
        return new

    def final(self, new: dict[int, str], stays: np.ndarray) -> pa.Array:
        """The texts; of rows that stay, those in ``new``, or without repeats."""
        whole = stays.copy()
        whole[list(new)] = False
        cut = whole[self.repeat_rows]
        cuts = [(s, e, b"") for s, e in zip(self.repeats[cut].tolist(), self.repeat_ends[cut].tolist(), strict=True)]
        rows = [(int(self.ends[r]) + 1, int(self.ends[r + 1]), t.encode("iso8859_6")) for r, t in new.items() if stays[r]]
        blob = _replaced(self.blob, sorted(cuts + rows) if rows else cuts)
        if self.arabic:
            blob = blob.decode("iso8859_6").encode()
        ends = _ends(blob)
        offsets = (ends - np.arange(len(ends))).astype(np.int32)
        return pa.StringArray.from_buffers(len(ends) - 1, pa.py_buffer(offsets), pa.py_buffer(blob.translate(None, b"\n")))


def columns(texts: dict[str, pa.Array], gone: dict[str, Lookup], entities: bool, most_repeats: int, vowels: bool) -> dict[str, Column]:
    letters = {
        "darija_arabic": lambda t: arabic_letters(t, entities, True),
        "darija_arabizi": lambda t: arabizi_letters(t, entities, most_repeats, vowels),
        "english": lambda t: latin_letters(t, entities),
        "modern_standard_arabic": lambda t: arabic_letters(t, entities, False),
    }
    return {c: Column(c, letters[c](t), gone[c]) for c, t in texts.items()}
