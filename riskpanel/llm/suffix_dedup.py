"""Suffix-array dedup: remove every byte covered by a long string that occurs twice.

Sorting every suffix would move many times the corpus, so only suffixes that can matter
are sorted. Each window of ``WINDOW`` bytes names an anchor, the place of its smallest
hash of ``GRAM`` bytes; equal windows have equal anchors at equal distance. Anchors whose
gram occurs once in the corpus rule out all windows that name them. Around the others lies
a context that holds every window naming them. Equal contexts are counted by hash and
stand for one; where one gram has several contexts, a distributed merge sort decides:

* each task sorts the suffixes that start at its anchors, front-codes them (length of the
  prefix shared with the one before, then the rest) and sends each key range its piece;
* a range merges its runs with a loser tree that keeps, for every run, how much of its
  head is known to agree with the last winner, and compares only what lies behind;
* the merged order and its common prefixes give, for every distance from window start to
  anchor, the suffixes that agree to the window's end; those that also agree on the bytes
  before the anchor are repeats.

More contexts of one gram than a range can hold are not gathered: the hashes of their windows
are counted by aggregation instead, which gives the same answer. Hashes have 64 bits.

Anchors and texts that can have no part in a step are left out of its shuffle by a filter of
bounded size, as long as it can tell that many keys apart; beyond that by joins.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskpanel.llm.byte_words import filter_of, slices
from riskpanel.llm.common import ship
from riskpanel.session import materialise, temporary_tables

WINDOW = 200
GRAM = 32
REACH = WINDOW - GRAM  # the anchor lies at most this far behind a window's start
_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_NO_ID = -(1 << 63)
_ROWS_AT_ONCE = 256
_FILTERED_ROWS = 1 << 24  # keys that a filter of bounded size tells apart well
_POWERS = {"n": 0}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse."""
    if _POWERS["n"] < n:
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps)
        _POWERS["n"] = n
    return _POWERS["up"][:n], _POWERS["down"][:n]


def _mixed(x: np.ndarray) -> np.ndarray:
    """Bits spread over the whole word."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _window_hashes(data: np.ndarray):
    """A function (starts, lengths) that gives hashes of substrings, equal for equal ones."""
    up, down = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
    return lambda start, length: _mixed((sums[start + length] - sums[start]) * down[start])


def _sliding_minimum(x: np.ndarray, width: int) -> np.ndarray:
    blocks = -(-len(x) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(x)] = x
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(x) - width + 1
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def anchors(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """(text number, place, gram hash, context hash) of every anchor."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    if len(data) < WINDOW:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.uint64, np.uint64))
    ends = np.cumsum(sizes)
    of = _window_hashes(data)
    grams = of(np.arange(len(data) - GRAM + 1), GRAM)
    place = np.arange(len(grams), dtype=np.uint64)
    ranked = (grams & np.uint64(0xFFFFFFFF00000000)) | place  # of equal hashes the first
    named = (_sliding_minimum(ranked, REACH + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    text = np.searchsorted(ends, np.arange(len(named)), side="right")
    inside = np.arange(len(named)) + WINDOW <= ends[text]
    at, text = named[inside], text[inside]
    fresh = np.ones(len(at), bool)
    fresh[1:] = (at[1:] != at[:-1]) | (text[1:] != text[:-1])
    at, text = at[fresh], text[fresh]
    begin = ends[text] - sizes[text]
    left, right = np.minimum(REACH, at - begin), np.minimum(WINDOW, ends[text] - at)
    context = _mixed(of(at - left, left + right) + left.astype(np.uint64))
    return text, at - begin, grams[at], context


def _keyed(docs: DataFrame) -> DataFrame:
    """(own, k, text): k stands for a row's doc_id and text, by which rows are told apart."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    own = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_NO_ID))
    return docs.select(own.alias("own"), F.xxhash64(own, text).alias("k"), text.alias("text"))


def _known(found: DataFrame, column: str) -> tuple[DataFrame, Broadcast | None]:
    """The table, and a bounded filter of its column; None if it is too large for the filter to be of use."""
    rows = found.count()
    if rows > _FILTERED_ROWS:
        return found, None
    return found, found.sparkSession.sparkContext.broadcast(filter_of(found.select(F.col(column).alias("fp")), rows))


def _anchor_rows(keyed: DataFrame, grams: Broadcast | None = None) -> DataFrame:
    """The anchors (gram, context, k, at), with a filter only those with one of its grams and a few more."""

    def run(batches):
        for batch in slices(batches):
            texts = [t.encode("utf-8") for t in batch.column("text").to_pylist()]
            k = batch.column("k").to_numpy()
            text, at, gram, context = anchors(texts)
            if grams is not None:
                kept = grams.value.has(gram)
                text, at, gram, context = text[kept], at[kept], gram[kept], context[kept]
            yield pa.RecordBatch.from_arrays(
                [pa.array(gram.view(np.int64)), pa.array(context.view(np.int64)), pa.array(k[text]), pa.array(at)],
                ["gram", "context", "k", "at"],
            )

    return keyed.mapInArrow(run, "gram long, context long, k long, at long")


def _packed_texts(keyed: DataFrame, only: Broadcast | None) -> DataFrame:
    """The texts compressed, for a smaller shuffle; with a filter only those it knows."""

    def run(batches):
        import zstandard

        pack = zstandard.ZstdCompressor(level=6).compress
        for batch in slices(batches):
            if only is not None:
                batch = batch.filter(pa.array(only.value.has(batch.column("k").to_numpy().view(np.uint64))))
            packed = [pack(t.encode("utf-8")) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("own"), batch.column("k"), pa.array(packed, pa.binary())], ["own", "k", "packed"])

    return keyed.mapInArrow(run, "own long, k long, packed binary")


def _contexts(packed: DataFrame, wanted: DataFrame) -> DataFrame:
    """The bytes before and behind each wanted anchor (gram, context, k, at, crowded)."""
    each = wanted.groupBy("k").agg(F.collect_list(F.struct("at", "gram", "context", "crowded")).alias("anchors"))
    once = packed.groupBy("k").agg(F.first("packed").alias("packed"))  # repeated rows are one text
    rows = once.join(each, "k").select("packed", "anchors")

    def run(batches):
        import zstandard

        for batch in (b.slice(i, _ROWS_AT_ONCE) for b in batches for i in range(0, b.num_rows, _ROWS_AT_ONCE)):
            out = []
            for blob, found in zip(batch.column("packed").to_pylist(), batch.column("anchors").to_pylist(), strict=True):
                text = zstandard.ZstdDecompressor().decompress(blob)
                for x in found:
                    a = x["at"]
                    out.append((x["gram"], x["context"], text[max(0, a - REACH) : a], text[a : a + WINDOW], x["crowded"]))
            columns = list(zip(*out, strict=True)) or [[]] * 5
            types = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["gram", "context", "before", "behind", "crowded"])

    return rows.mapInArrow(run, "gram long, context long, before binary, behind binary, crowded boolean")


def _matrix(strings: list[bytes], width: int) -> np.ndarray:
    return np.frombuffer(b"".join(s.ljust(width, b"\0") for s in strings), np.uint8).reshape(-1, width)


def front_coded(sorted_rows: np.ndarray) -> tuple[np.ndarray, bytes]:
    """Length of the prefix shared with the row before, and the rest of each row."""
    shared = np.zeros(len(sorted_rows), np.uint8)
    if len(sorted_rows) > 1:
        differ = sorted_rows[1:] != sorted_rows[:-1]
        shared[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), sorted_rows.shape[1])
    rest = np.arange(sorted_rows.shape[1])[None, :] >= shared[:, None]
    return shared, sorted_rows[rest].tobytes()


class _Run:
    """A sorted run, decoded as the merge goes through it."""

    def __init__(self, shared: np.ndarray, rest: bytes, width: int):
        self.shared, self.rest, self.width = shared.tolist(), rest, width
        self.i, self.used, self.head = -1, 0, b""

    def step(self) -> int:
        """Moves to the next string; its prefix shared with the one before, -1 at the end."""
        self.i += 1
        if self.i == len(self.shared):
            return -1
        keep = self.shared[self.i]
        more = self.width - keep
        self.head = self.head[:keep] + self.rest[self.used : self.used + more]
        self.used += more
        return keep


def _agreement(a: bytes, b: bytes, start: int) -> int:
    """Length of the common prefix of two strings that agree up to ``start``."""
    if a[start:] == b[start:]:
        return len(a)
    step = 8
    while a[start : start + step] == b[start : start + step]:
        start += step
        step *= 2
    while a[start] == b[start]:
        start += 1
    return start


def merge(runs: list[_Run]) -> tuple[list[int], list[int]]:
    """Which run each string of the merged order comes from, and its prefix shared with the one before.

    A loser tree: an inner place holds the run that lost there and how far its head agrees
    with the string that beat it. A winner's successor goes up its path; the one that
    agrees further with the last winner is the smaller, and only heads that agree equally
    far are compared, from there on.
    """
    size = 1 << max(0, (len(runs) - 1).bit_length())
    known = [r.step() for r in runs] + [-1] * (size - len(runs))
    width = runs[0].width if runs else 0

    def play(a: int, b: int) -> tuple[int, int]:
        """Winner and loser of two runs; the loser's agreement becomes that with the winner."""
        ka, kb = known[a], known[b]
        if ka < 0 or kb < 0:
            return (b, a) if ka < 0 else (a, b)
        if ka != kb:
            return (a, b) if ka > kb else (b, a)
        x, y = runs[a].head, runs[b].head
        n = _agreement(x, y, ka)
        if n == width or x[n] < y[n]:
            known[b] = n
            return a, b
        known[a] = n
        return b, a

    losers = [0] * size
    winners = [0] * (2 * size)
    winners[size:] = range(size)
    for place in range(size - 1, 0, -1):
        winners[place], losers[place] = play(winners[2 * place], winners[2 * place + 1])
    order, shared = [], []
    best = winners[1] if size > 1 else 0
    while runs and known[best] >= 0:
        order.append(best)
        shared.append(known[best])
        known[best] = runs[best].step()
        place = (best + size) >> 1
        while place:
            best, losers[place] = play(best, losers[place])
            place >>= 1
    return order, shared


def _sorted_runs(contexts: DataFrame, splitters: list[bytes]) -> DataFrame:
    """Each task's suffixes sorted, front-coded, and cut at the splitters."""
    cuts = np.array(splitters, f"S{GRAM}") if splitters else np.zeros(0, f"S{GRAM}")

    def run(batches):
        import zstandard

        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            behind = _matrix(batch.column("behind").to_pylist(), WINDOW)
            if not len(behind):
                continue
            strings = np.ascontiguousarray(behind).view(f"S{WINDOW}").ravel()
            order = np.argsort(strings, kind="stable")
            ahead, after = batch.column("before").to_pylist(), batch.column("behind").to_pylist()
            before = [ahead[i] for i in order]
            sizes = np.array([[len(s) for s in before], [len(after[i]) for i in order]], np.uint8)
            left = _matrix([s[::-1] for s in before], REACH)  # nearest byte first
            names = np.stack([batch.column(c).to_numpy()[order] for c in ("gram", "context")])
            part = np.searchsorted(cuts, np.ascontiguousarray(behind[order][:, :GRAM]).view(f"S{GRAM}").ravel(), side="right")
            bounds = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
            out = []
            for lo, hi in zip(bounds, bounds[1:], strict=False):
                shared, rest = front_coded(behind[order[lo:hi]])
                out.append((int(part[lo]), hi - lo, shared.tobytes(), pack(rest), pack(left[lo:hi].tobytes()), sizes[:, lo:hi].tobytes(), names[:, lo:hi].tobytes()))
            types = [pa.int32(), pa.int64(), *[pa.binary()] * 5]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)],
                ["part", "n", "shared", "rest", "left", "sizes", "names"],
            )

    return contexts.mapInArrow(run, "part int, n long, shared binary, rest binary, left binary, sizes binary, names binary")


def _repeats(table: pa.Table) -> pa.Table:
    """Merges one key range; the distances (gram, context, low, high) at which windows repeat."""
    import zstandard

    unpack = zstandard.ZstdDecompressor().decompress
    rows = table.to_pylist()
    runs = [_Run(np.frombuffer(r["shared"], np.uint8), unpack(r["rest"]), WINDOW) for r in rows]
    order, shared = merge(runs)
    first = np.concatenate([[0], np.cumsum([r["n"] for r in rows])[:-1]]).astype(np.int64)
    which = np.array(order, np.int64)
    taken = np.empty(len(which), np.int64)
    by_run = np.argsort(which, kind="stable")
    counts = np.bincount(which, minlength=len(rows))
    taken[by_run] = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)
    pick = first[which] + taken
    left = np.concatenate([np.frombuffer(unpack(r["left"]), np.uint8).reshape(-1, REACH) for r in rows])[pick]
    sizes = np.concatenate([np.frombuffer(r["sizes"], np.uint8).reshape(2, -1) for r in rows], axis=1)[:, pick]
    names = np.concatenate([np.frombuffer(r["names"], np.int64).reshape(2, -1) for r in rows], axis=1)[:, pick]
    common = np.array(shared, np.int64)
    again = np.zeros((REACH + 1, len(pick)), bool)
    hashed = np.zeros(len(pick), np.uint64)
    for distance in range(REACH + 1):
        if distance:
            hashed = hashed * np.uint64(_BASE) + left[:, distance - 1] + np.uint64(1)
        group = np.cumsum(common < WINDOW - distance)  # agree from the anchor to the window's end
        valid = np.flatnonzero((sizes[0] >= distance) & (sizes[1] >= WINDOW - distance))
        key = _mixed(_mixed(hashed[valid]) + group[valid].astype(np.uint64) * np.uint64(_INVERSE))
        sorting = np.argsort(key)
        same = key[sorting][1:] == key[sorting][:-1]
        hit = np.zeros(len(valid), bool)
        hit[1:] |= same
        hit[:-1] |= same
        again[distance, valid[sorting[hit]]] = True
    edges = np.diff(np.pad(again.astype(np.int8), ((1, 1), (0, 0))), axis=0).T  # per suffix
    item, low = np.nonzero(edges == 1)
    _, high = np.nonzero(edges == -1)
    return pa.table({"gram": names[0][item], "context": names[1][item], "low": low, "high": high - 1})


def _crowded_windows(contexts: DataFrame) -> DataFrame:
    """Hash of every window of each context, with its distance."""

    def run(batches):
        for batch in batches:
            for gram, context, before, behind in zip(*(batch.column(c).to_pylist() for c in ("gram", "context", "before", "behind")), strict=True):
                data = np.frombuffer(before + behind, np.uint8)
                starts = np.arange(max(0, len(data) - WINDOW + 1))
                starts = starts[starts <= len(before)]
                n = len(starts)
                hashes = _window_hashes(data)(starts, WINDOW).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, gram)), pa.array(np.full(n, context)), pa.array(len(before) - starts), pa.array(hashes)],
                    ["gram", "context", "distance", "window"],
                )

    return contexts.mapInArrow(run, "gram long, context long, distance long, window long")


def repeated_starts(docs: DataFrame, crowd: int = 40_000, suffixes_per_range: int = 20_000, sample_rows: int = 20_000) -> DataFrame:
    """(k, low, high): the starts of repeated windows, as ranges of places in a text.

    ``crowd`` contexts of one gram are merged in one range at most, two ranges' worth; those
    of grams with more are counted window by window. Splitters come from at most about ``sample_rows``
    suffixes, chosen by hash.
    """
    spark = docs.sparkSession
    ship(spark)
    keyed = _keyed(docs)
    with temporary_tables(spark) as stays:
        with temporary_tables(spark) as keep:
            often = _anchor_rows(keyed).groupBy("gram").agg(F.count("*").alias("n")).filter(F.col("n") > 1).select("gram")
            often, known = _known(materialise(often, "repeated-grams"), "gram")
            rows = _anchor_rows(keyed, known)
            if known is None:
                rows = rows.join(often, "gram", "left_semi")
            rows = keep(rows, "anchors")
        place = F.struct("k", "at")
        classes = rows.groupBy("gram", "context").agg(F.count("*").alias("n"), F.min(place).alias("place"))
        classes = materialise(classes, "contexts")
        with temporary_tables(spark) as keep:
            crowds = classes.groupBy("gram").agg(F.count("*").alias("contexts")).filter(F.col("contexts") > 1)
            wanted = classes.join(crowds, "gram").select("gram", "context", "place.*", (F.col("contexts") > crowd).alias("crowded"))
            wanted = materialise(wanted, "wanted-anchors")
            _, texts = _known(materialise(wanted.select("k").distinct(), "wanted-texts"), "k")
            contexts = keep(_contexts(_packed_texts(keyed, texts), wanted), "context-bytes")
        calm = contexts.filter(~F.col("crowded"))
        total = calm.count()
        every = max(1, math.ceil(total / sample_rows))
        sample = calm.filter(F.pmod(F.xxhash64("gram", "context"), F.lit(every)) == 0).select(F.substring("behind", 1, GRAM).alias("s")).collect()
        ranges = max(1, math.ceil(total / suffixes_per_range))
        strings = sorted(bytes(r["s"]) for r in sample)
        splitters = sorted({strings[i * len(strings) // ranges] for i in range(1, ranges)}) if strings else []
        merged = _sorted_runs(calm, splitters).groupBy("part").applyInArrow(_repeats, "gram long, context long, low long, high long")
        windows = _crowded_windows(contexts.filter("crowded"))
        window = ["gram", "distance", "window"]  # so that one place seen from two anchors is not two
        several = windows.groupBy(*window).agg(F.count("*").alias("n")).filter(F.col("n") > 1).select(*window)
        crowded = windows.join(materialise(several, "repeated-windows"), window, "left_semi").select("gram", "context", F.col("distance").alias("low"), F.col("distance").alias("high"))
        # a context that occurs twice repeats every window inside it; the finer verdicts are for the others
        single = classes.filter(F.col("n") == 1).select("gram", "context")
        partly = merged.unionByName(crowded).join(single, ["gram", "context"], "left_semi")
        whole = classes.filter(F.col("n") > 1).select("gram", "context", F.lit(0).cast("bigint").alias("low"), F.lit(REACH).cast("bigint").alias("high"))
        verdicts = materialise(partly.unionByName(whole), "repeats")
        found = rows.join(verdicts, ["gram", "context"]).select(
            "k", F.greatest(F.col("at") - F.col("high"), F.lit(0)).alias("low"), (F.col("at") - F.col("low")).alias("high")
        )
        return stays(found, "repeated-starts")


def covered(size: int, starts: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of bytes covered by windows with these ranges of starts."""
    out: list[tuple[int, int]] = []
    for low, high in sorted(starts):
        low, high = max(0, low), min(high, size - WINDOW)
        if high < low:
            continue
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], high + WINDOW))
        else:
            out.append((low, high + WINDOW))
    return out


def remove_repeats(docs: DataFrame, with_bytes: bool = True) -> DataFrame:
    """Every row's doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if wanted, the kept bytes.

    Texts are read as UTF-8; a cut may fall inside a character, hence bytes. A null text is
    empty, and a text shorter than a window keeps all its bytes. Repeated rows repeat each
    other, so their long texts are removed from all of them. Rows without doc_id take part
    like others, and an empty table gives an empty result.
    """
    spark = docs.sparkSession
    ship(spark)
    keyed = _keyed(docs)
    spans = repeated_starts(docs).groupBy("k").agg(F.collect_set(F.struct("low", "high")).alias("starts"))
    spans, known = _known(materialise(spans, "removed-spans"), "k")
    schema = "own long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if with_bytes else "")
    names = ["own", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"][: None if with_bytes else -1]

    def cut(own: pa.Array, texts: Iterable[bytes], starts: Iterable[list | None]) -> pa.RecordBatch:
        out = []
        for data, found in zip(texts, starts, strict=True):
            gone = covered(len(data), [(x["low"], x["high"]) for x in found or []])
            edges = [0, *(e for span in gone for e in span), len(data)]
            kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
            out.append((len(data), len(data) - len(kept), len(gone), hashlib.sha256(kept).hexdigest(), kept))
        types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        columns = [pa.array(c, t) for c, t in zip(list(zip(*out, strict=True)) or [[]] * 5, types, strict=True)]
        return pa.RecordBatch.from_arrays([own, *columns][: len(names)], names)

    def whole(batches):
        for batch in slices(batches):  # texts without a repeat need no shuffle
            batch = batch.filter(pa.array(~known.value.has(batch.column("k").to_numpy().view(np.uint64))))
            texts = [t.encode("utf-8") for t in batch.column("text").to_pylist()]
            yield cut(batch.column("own"), texts, [None] * len(texts))

    def partly(batches):
        import zstandard

        for batch in batches:
            for part in (batch.slice(i, _ROWS_AT_ONCE) for i in range(0, batch.num_rows, _ROWS_AT_ONCE)):
                texts = map(zstandard.ZstdDecompressor().decompress, part.column("packed").to_pylist())
                yield cut(part.column("own"), texts, part.column("starts").to_pylist())

    rows = _packed_texts(keyed, known).join(spans, "k", "left").select("own", "packed", "starts")
    done = rows.mapInArrow(partly, schema)
    if known is not None:
        done = done.unionByName(keyed.mapInArrow(whole, schema))
    own = F.when(F.col("own") != F.lit(_NO_ID), F.col("own")).alias("doc_id")
    return done.select(own, *[c for c in done.columns if c != "own"])
