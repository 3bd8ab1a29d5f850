"""Words of Arrow text batches as places in their bytes, their fingerprints, and counts of them.

Texts are never turned into Python strings: words are found, cut and hashed by numpy over the
bytes of a batch. Fingerprints only rule things out; what stays is compared by its bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTES_AT_ONCE = 1 << 17
_MOST_BITS = 1 << 28
_BITMAP = 1 << 15  # bits in one of Spark's bitmaps
_POWERS = {"n": 0}


def mixed(x: np.ndarray) -> np.ndarray:
    """Bits spread over the whole word."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if _POWERS["n"] < n:
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps)
        _POWERS["n"] = n
    return _POWERS["up"][:n], _POWERS["down"][:n]


def batch_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes behind a string column without nulls, and where its texts begin and the last one ends."""
    wide = pa.types.is_large_string(column.type)
    _, places, data = column.buffers()
    places = np.frombuffer(places, np.int64 if wide else np.int32) if places else np.zeros(1, np.int64)
    places = places[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8), places


def string_array(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The strings between places of some bytes."""
    size = end - start
    places = np.zeros(len(size) + 1, np.int64)
    np.cumsum(size, out=places[1:])
    taken = np.ascontiguousarray(data[_spread(start, size, places)])
    return pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(places), pa.py_buffer(taken)).cast(pa.string())


def _spread(start: np.ndarray, size: np.ndarray, places: np.ndarray) -> np.ndarray:
    """All byte places of the strings, one string after the other."""
    return np.repeat(start - places[:-1], size) + np.arange(places[-1])


def substring_hashes(data: np.ndarray):
    """A function (starts, ends) that hashes substrings by a prefix polynomial, equal for equal ones."""
    up, down = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
    return lambda start, end: mixed((sums[end] - sums[start]) * down[start])


class Alphabet:
    """What each byte is: part of a word, a gap between words, or a break that no phrase crosses."""

    def __init__(self, gaps: bytes, breaks: bytes = b""):
        self.inside, self.breaks = np.ones(256, bool), np.zeros(256, bool)
        self.inside[list(gaps + breaks)] = False
        self.breaks[list(breaks)] = True
        lower = np.arange(256, dtype=np.uint8)
        lower[65:91] += 32
        #: A-Z lower-cased, a space for all that is outside words
        self.lowered = np.where(self.inside, lower, 32).astype(np.uint8)


class Words:
    """The words of some texts: A-Z lower-cased, in ``data`` with one space behind each word that has a gap behind it."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, alphabet: Alphabet):
        inside = alphabet.inside[data]
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        filled = bounds[:-1] < bounds[1:]  # words end with their text
        opening, closing = bounds[:-1][filled], bounds[1:][filled] - 1
        first[opening], last[closing] = inside[opening], inside[closing]
        start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
        #: number of each word's text
        self.text = np.repeat(np.arange(len(bounds) - 1), np.diff(np.searchsorted(start, bounds)))
        #: equal for words of one text without a break between them
        self.piece = self.text
        if alphabet.breaks.any():
            self.piece = self.text + np.searchsorted(np.flatnonzero(alphabet.breaks[data]), start)
        keep = inside.copy()
        keep[1:] |= inside[:-1]
        self.data = alphabet.lowered[data[keep]]
        spaced = np.zeros(len(start), bool)
        spaced[:] = end < len(data)
        spaced[spaced] = ~inside[end[spaced]]
        size = end - start
        self.end = np.cumsum(size + spaced) - spaced
        self.start = self.end - size
        #: hashes of substrings of ``data``
        self.hashes = substring_hashes(self.data)

    def identities(self) -> np.ndarray:
        """For each word the number of a word of the same bytes, one for all of them.

        The words of one hash are compared with one of them, byte by byte; a word that has a
        hash in common with another one stands for itself.
        """
        other = one_of_equal(self.hashes(self.start, self.end))
        return np.where(same_bytes(self.data, self.start, self.end, other), other, np.arange(len(other)))

    def marks(self) -> np.ndarray:
        """A second hash of each word that has nothing in common with ``hashes``: a sum of one number per byte and place."""
        place = np.arange(len(self.data)) - np.repeat(self.start, np.diff(np.append(self.start, len(self.data))))
        sums = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum(mixed(self.data + (place.astype(np.uint64) << np.uint64(8)) + np.uint64(1)), out=sums[1:])
        return mixed(sums[self.end] - sums[self.start])


def one_of_equal(keys: np.ndarray) -> np.ndarray:
    """For each key the place of an equal one, the same for all of them."""
    order = np.argsort(keys)
    ordered = keys[order]
    fresh = np.ones(len(keys), bool)
    fresh[1:] = ordered[1:] != ordered[:-1]
    out = np.empty(len(keys), np.int64)
    out[order] = order[fresh][np.cumsum(fresh) - 1]
    return out


def same_bytes(data: np.ndarray, start: np.ndarray, end: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Whether each string equals the one whose number stands in ``other``."""
    size = end - start
    same = size == size[other]
    at = np.flatnonzero(same & (other != np.arange(len(other))))
    places = np.zeros(len(at) + 1, np.int64)
    np.cumsum(size[at], out=places[1:])
    differ = data[_spread(start[at], size[at], places)] != data[_spread(start[other[at]], size[at], places)]
    if differ.any():
        same[at[np.searchsorted(places, np.flatnonzero(differ), side="right") - 1]] = False
    return same


def slices(batches, size: int = _BYTES_AT_ONCE) -> Iterator[pa.RecordBatch]:
    """The rows of the batches, about ``size`` bytes of column ``text`` at a time, but whole texts."""
    for batch in batches:
        _, bounds = batch_bytes(batch.column("text"))
        first = 0
        while first < batch.num_rows:
            last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + size, side="right")) - 1)
            yield batch.slice(first, last - first)
            first = last


def chunks(batches, alphabet: Alphabet, size: int = _BYTES_AT_ONCE) -> Iterator[tuple[pa.RecordBatch, Words]]:
    """Whole texts of about ``size`` bytes at a time: their rows and their words; the text is column ``text``."""
    for rows in slices(batches, size):
        data, bounds = batch_bytes(rows.column("text"))
        yield rows, Words(data[bounds[0] : bounds[-1]], bounds - bounds[0], alphabet)


def _sums(into: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    out = np.zeros(size, np.int64)
    np.add.at(out, into, counts)
    return out


class Tally:
    """Counts of strings, gathered under 64-bit keys.

    Strings are merged only if they have the same key, the same group and the same bytes, so
    that a collision of keys leaves several rows of right counts. ``most`` rows are merged at
    a time, and given away if half of them stay.
    """

    def __init__(self, counts: int, most: int = 1 << 19):
        self.counts, self.most = counts, most
        self._parts, self._rows = [], 0

    def add(self, key, group, counts, data, start, end) -> Iterator[pa.RecordBatch]:
        """Takes strings in; gives the rows gathered so far once they are many."""
        size = end - start
        places = np.zeros(len(size) + 1, np.int64)
        np.cumsum(size, out=places[1:])
        self._parts.append((key, group.astype(np.int32), counts.astype(np.int64), size.astype(np.int32), data[_spread(start, size, places)]))
        self._rows += len(key)
        if self._rows >= self.most:
            self._merge()
            if self._rows >= self.most // 2:
                yield self.take()

    def _merge(self) -> None:
        if not self._parts:
            return
        key, group, size, data = (np.concatenate([p[i] for p in self._parts]) for i in (0, 1, 3, 4))
        counts = np.concatenate([p[2] for p in self._parts], axis=1)
        self._parts = []
        end = np.cumsum(size, dtype=np.int64)
        other = one_of_equal(key)
        same = same_bytes(data, end - size, end, other) & (group == group[other])
        fresh = np.flatnonzero(~same | (other == np.arange(len(key))))
        place = np.zeros(len(key), np.int64)
        place[fresh] = np.arange(len(fresh))
        into = np.where(same, place[other], place)
        summed = np.stack([_sums(into, c, len(fresh)) for c in counts])
        places = np.zeros(len(fresh) + 1, np.int64)
        np.cumsum(size[fresh], out=places[1:])
        kept = data[_spread((end - size)[fresh], size[fresh], places)]
        self._parts, self._rows = [(key[fresh], group[fresh], summed, size[fresh], kept)], len(fresh)

    def take(self) -> pa.RecordBatch:
        """All rows gathered: group, string and counts."""
        self._merge()
        names = ["group", "string", *[f"n{i}" for i in range(self.counts)]]
        if not self._parts:
            return pa.RecordBatch.from_arrays([pa.array([], pa.int32()), pa.array([], pa.string()), *[pa.array([], pa.int64())] * self.counts], names)
        _, group, counts, size, data = self._parts[0]
        self._parts, self._rows = [], 0
        end = np.cumsum(size, dtype=np.int64)
        return pa.RecordBatch.from_arrays([pa.array(group), string_array(data, end - size, end), *[pa.array(c) for c in counts]], names)


class Fingerprints:
    """Counts of fingerprints, many at a time."""

    def __init__(self, most: int = 1 << 21):
        self.most, self._parts, self._rows = most, [], 0

    def add(self, found: np.ndarray) -> Iterator[pa.RecordBatch]:
        self._parts.append(found)
        self._rows += len(found)
        if self._rows >= self.most:
            yield self.take()

    def take(self) -> pa.RecordBatch:
        found = np.concatenate(self._parts) if self._parts else np.zeros(0, np.uint64)
        self._parts, self._rows = [], 0
        found, n = np.unique(found, return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n.astype(np.int64))], ["fp", "n"])


class Filter:
    """A bounded set of fingerprints: it never misses one, and knows a few that were not put in."""

    def __init__(self, bits: np.ndarray):
        self.bits, self.mask = bits, np.uint64(len(bits) * 8 - 1)

    def __contains__(self, fp: int) -> bool:
        return bool(self.has(np.array([fp], np.uint64))[0])

    def has(self, found: np.ndarray) -> np.ndarray:
        at, other = found & self.mask, (found >> np.uint64(32)) & self.mask
        bit = lambda p: (self.bits[p >> np.uint64(3)] >> (p & np.uint64(7)).astype(np.uint8)) & 1
        return (bit(at) & bit(other)).astype(bool)


def filter_of(found: DataFrame, rows: int) -> Filter:
    """A filter of the column ``fp``, of 16 bits per row but at most 32 MB, whatever the input.

    Each part of it is an aggregate, and only the finished parts come to the driver. Beyond
    the bound the filter rules out less, which costs work and changes no result.
    """
    size = max(_BITMAP, min(_MOST_BITS, 1 << (16 * max(1, rows) - 1).bit_length()))
    places = F.array(F.col("fp"), F.shiftrightunsigned("fp", 32))
    places = F.transform(places, lambda p: p.bitwiseAND(F.lit(size - 1).cast("bigint")))
    parts = found.select(F.explode(places).alias("p")).groupBy(F.expr(f"p div {_BITMAP}").alias("part"))
    parts = parts.agg(F.bitmap_construct_agg(F.col("p") % _BITMAP).alias("bits")).collect()
    bits = np.zeros(size // 8, np.uint8)
    for row in parts:
        at = row["part"] * _BITMAP // 8
        bits[at : at + _BITMAP // 8] = np.frombuffer(bytes(row["bits"]), np.uint8)
    return Filter(bits)


def seeds(names: pa.Array, seed: int = 0) -> np.ndarray:
    """A hash of each name, to tell apart what is counted per name."""
    from xxhash import xxh64_intdigest

    coded = names.dictionary_encode()
    each = np.array([xxh64_intdigest(n, seed) for n in coded.dictionary.to_pylist()] or [0], np.uint64)
    return each[coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)] if len(names) else np.zeros(0, np.uint64)
