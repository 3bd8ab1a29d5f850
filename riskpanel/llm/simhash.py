"""SimHash near-duplicates: a generalised pigeonhole search over groups of bits.

Two 64-bit fingerprints within distance 2 that are cut into m groups of bits, with
thresholds that sum to 2 - m + 1, are within its threshold in at least one group. Bits
that go together are put into the same group, which leaves the groups the more
independent. The thresholds, and m itself, come from a dynamic program over the
estimated numbers of probes and candidates. Probes meet the fingerprints of equal group
values, and each candidate pair is verified on all 64 bits.

A group value that very many fingerprints share is not paired out: each of its
fingerprints names itself and its 64 one-bit neighbours, and those that name a common
value are within distance 2 of each other and are linked to the smallest of them. Two
fingerprints within distance 2 always name a common value, so no link is lost.
"""

from __future__ import annotations

from functools import reduce
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskpanel.llm.common import ship
from riskpanel.llm.components import components
from riskpanel.session import materialise

BITS = 64
MAX_DISTANCE = 2
_SEED = 42
_HASHES_AT_ONCE = 1 << 16
_PRINTS_AT_ONCE = 1 << 17  # fingerprints of a task that makes several rows of each


def word_starts(data: bytes, shingle: int) -> tuple[bytes, list[int], list[int]]:
    """Words joined by one space, and where each run of ``shingle`` words starts and ends.

    ``bytes.split`` parts at space and 0x09 to 0x0D, ``bytes.lower`` changes A-Z only.
    Fewer words than ``shingle`` are one run; no words are none.
    """
    words = data.lower().split()
    if not words:
        return b"", [], []
    ends = (np.cumsum([len(w) + 1 for w in words]) - 1).tolist()
    starts = [0, *(e + 1 for e in ends[:-1])]
    if len(words) <= shingle:
        return b" ".join(words), [0], [ends[-1]]
    return b" ".join(words), starts[: len(words) - shingle + 1], ends[shingle - 1 :]


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half of the hashes."""
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), _HASHES_AT_ONCE):
        part = hashes[i : i + _HASHES_AT_ONCE].astype("<u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint(data: bytes, shingle: int) -> int:
    """The SimHash of a text's word runs; 0 without words."""
    from xxhash import xxh64_intdigest

    joined, starts, ends = word_starts(data, shingle)
    if not starts:
        return 0
    return majority(np.fromiter((xxh64_intdigest(joined[s:e], _SEED) for s, e in zip(starts, ends, strict=True)), np.uint64, len(starts)))


def fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, fp) of every row; fp is the fingerprint as a signed 64-bit integer."""

    ship(docs.sparkSession)

    def run(batches):
        for batch in batches:
            found = [fingerprint((t or "").encode("utf-8"), shingle) for t in batch.column("text").to_pylist()]
            signed = pa.array(np.array(found, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), signed], ["doc_id", "fp"])

    return docs.selectExpr("cast(doc_id as bigint) doc_id", "cast(text as string) text").mapInArrow(run, "doc_id long, fp long")


def _correlations(distinct: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and how strongly each two bits go together, over all of them."""

    def run(batches):
        total, n = np.zeros((BITS, BITS), np.int64), 0
        for batch in batches:
            values = batch.column("fp").to_numpy().view(np.uint8).reshape(-1, 8)
            for i in range(0, len(values), _HASHES_AT_ONCE):
                bits = np.unpackbits(values[i : i + _HASHES_AT_ONCE], axis=1, bitorder="little").astype(np.float32)
                total += (bits.T @ bits).astype(np.int64)
            n += len(values)
        pair = np.arange(BITS * BITS + 1)
        yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(np.append(total.ravel(), n))], ["pair", "n"])

    rows = distinct.select("fp").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect()
    both = np.zeros(BITS * BITS + 1)
    for row in rows:  # 4097, whatever the input
        both[row["pair"]] = row["n"]
    n, both = max(1.0, both[-1]), both[:-1].reshape(BITS, BITS)
    share = np.diag(both) / n
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-12))
    return int(n), np.abs(both / n - np.outer(share, share)) / np.outer(spread, spread)


def _bit_groups(correlation: np.ndarray, m: int) -> list[list[int]]:
    """The bits in ``m`` groups of near-equal size, each grown from its most correlated bits."""
    left, groups = set(range(BITS)), []
    for i in range(m):
        size = len(left) // (m - i)
        group = [max(left, key=lambda b: (sum(correlation[b, x] for x in left), -b))]
        left.remove(group[0])
        while len(group) < size:
            nearest = max(left, key=lambda b: (sum(correlation[b, x] for x in group), -b))
            group.append(nearest)
            left.remove(nearest)
        groups.append(sorted(group))
    return groups


def _mask(bits: list[int]) -> int:
    value = sum(1 << b for b in bits)
    return value - (1 << BITS) if value >= 1 << (BITS - 1) else value


def _allocate(costs: list[list[float]], total: int) -> tuple[float, list[int]]:
    """Thresholds from -1 that sum to ``total`` at the least cost; costs[i][t + 1] is group i's."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for group in costs:
        following: dict[int, tuple[float, list[int]]] = {}
        for spent, (cost, chosen) in best.items():
            for t in range(-1, MAX_DISTANCE + 1):
                option = (cost + group[t + 1], [*chosen, t])
                if spent + t not in following or option < following[spent + t]:
                    following[spent + t] = option
        best = following
    return best[total]


def plan_groups(distinct: DataFrame) -> list[tuple[list[int], int]]:
    """The bit groups and thresholds that are expected to cost least over all fingerprints."""
    n, correlation = _correlations(distinct)
    cuts = {m: _bit_groups(correlation, m) for m in (1, 2, 3)}
    # a group of all bits has no equal values
    named = [(m, i, bits) for m, groups in cuts.items() if m > 1 for i, bits in enumerate(groups)]
    values = F.array(*[F.struct(F.lit(k).alias("k"), _project(bits).alias("v")) for k, (m, i, bits) in enumerate(named)])
    sizes = distinct.select(F.inline(values)).groupBy("k", "v").agg(F.count("*").alias("c"))
    pairs = sizes.groupBy("k").agg(F.sum(F.col("c").cast("double") * (F.col("c") - 1) / 2).alias("pairs")).collect()
    equal = {named[r["k"]][:2]: r["pairs"] for r in pairs}  # five rows
    options = []
    for m, groups in cuts.items():
        costs = []
        for i, bits in enumerate(groups):
            near = [sum(comb(len(bits), e) for e in range(t + 1)) for t in range(MAX_DISTANCE + 1)]
            chance = n * (n - 1) / 2 / 2.0 ** len(bits)
            costs.append([0.0, *[n * v + v * max(chance, equal.get((m, i), 0.0)) for v in near]])
        cost, thresholds = _allocate(costs, MAX_DISTANCE - m + 1)
        options.append((cost, [(bits, t) for bits, t in zip(groups, thresholds, strict=True) if t >= 0]))
    return min(options, key=lambda o: o[0])[1]


def _project(bits: list[int]) -> Column:
    return F.col("fp").bitwiseAND(F.lit(_mask(bits)))


def _flips(bits: list[int], threshold: int) -> list[int]:
    """Masks of at most ``threshold`` of the bits."""
    found = [[]]
    masks = [0]
    for _ in range(threshold):
        found = [[*f, b] for f in found for b in bits if not f or b > f[-1]]
        masks += [_mask(f) for f in found]
    return masks


def _dealt(distinct: DataFrame) -> DataFrame:
    """The fingerprints in partitions of some ``_PRINTS_AT_ONCE`` each, whatever the size of the files.

    Every one becomes several rows with hardly an equal one among them, all of which a task
    holds when it counts them.
    """
    return distinct.select("fp").repartition(-(-distinct.count() // _PRINTS_AT_ONCE) or 1, "fp")


def links(distinct: DataFrame, hot_rows: int = 256) -> DataFrame:
    """Links (a, b) between distinct fingerprints that join exactly those within distance 2.

    Every pair within distance 2 is linked or shares a linked smallest neighbour; no link
    joins fingerprints further apart. Group values held by more than ``hot_rows``
    fingerprints are linked through common neighbours instead of pairs.
    """
    distinct = _dealt(distinct)
    plan = plan_groups(distinct)
    exact_keys = [F.struct(F.lit(i).alias("part"), _project(bits).alias("key")) for i, (bits, _) in enumerate(plan)]

    def probe_keys(i: int, key: Column, bits: list[int], threshold: int) -> Column:
        flips = F.array(*[F.lit(x).cast("bigint") for x in _flips(bits, threshold)])
        return F.transform(flips, lambda x: F.struct(F.lit(i).alias("part"), key.bitwiseXOR(x).alias("key")))

    exact = distinct.select("fp", F.inline(F.array(*exact_keys)))
    probes = distinct.select(F.col("fp").alias("other"), F.inline(F.concat(*[probe_keys(i, _project(bits), bits, t) for i, (bits, t) in enumerate(plan)])))
    sizes = exact.groupBy("part", "key").agg(F.count("*").alias("c")).filter(F.col("c") > hot_rows)
    hot = materialise(sizes.select("part", "key"), "hot-bit-groups")
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= MAX_DISTANCE
    has_hot = not hot.isEmpty()
    cool = exact.join(hot, ["part", "key"], "left_anti") if has_hot else exact
    pairs = probes.join(cool, ["part", "key"]).filter((F.col("other") < F.col("fp")) & near).select(F.col("other").alias("a"), F.col("fp").alias("b"))
    if not has_hot:
        return pairs.distinct()
    # who probes a crowded value has a value within the threshold of it: few values probe, not all fingerprints
    near_hot = [hot.filter(F.col("part") == i).select(F.inline(probe_keys(i, F.col("key"), bits, t))) for i, (bits, t) in enumerate(plan)]
    reached = exact.join(reduce(DataFrame.unionByName, near_hot).distinct(), ["part", "key"], "left_semi").select("fp").distinct()
    named = F.array(*[F.lit(x).cast("bigint") for x in _flips(list(range(BITS)), 1)])
    meet = reached.select("fp", F.explode(F.transform(named, lambda x: F.col("fp").bitwiseXOR(x))).alias("value"))
    # a value is named by at most 65 fingerprints
    stars = meet.select(F.min("fp").over(Window.partitionBy("value")).alias("a"), F.col("fp").alias("b")).filter(F.col("a") != F.col("b"))
    return pairs.unionByName(stars).distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """Per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id.

    component_id is the smallest doc_id reachable over fingerprints within distance 2. A
    null or wordless text has fingerprint zero and is linked like any other. Rows are
    counted as they come, so repeated rows are returned repeatedly; a row without doc_id
    gets its component's smallest id, null if no row of it has one. Other columns are not
    read, and an empty table gives an empty result. Equal fingerprints are one row from
    the first aggregate on, so a group of copies of any size costs no more than one text.
    """
    prints = materialise(fingerprints(docs, shingle), "fingerprints")
    classes = materialise(classes_of(prints.groupBy("fp").agg(F.min("doc_id").alias("first"))), "fingerprint-classes")
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return prints.join(classes, "fp").select("doc_id", hexed.alias("fingerprint"), "component_id")


def classes_of(distinct: DataFrame) -> DataFrame:
    """(fp, component_id) from distinct fingerprints and the smallest id of each (fp, first)."""
    distinct = materialise(distinct, "distinct-fingerprints")
    roots = materialise(components(links(distinct)), "fingerprint-roots")
    rooted = materialise(
        distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root")),
        "rooted",
    )
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return rooted.join(smallest, "root").select("fp", "component_id")
