"""Benchmark decontamination by spaced seeds.

A seed hashes some words of a short window and ignores the others, by a fixed mask, so a
replaced word only spoils the windows in which the mask looks at it. Seeds of benchmark
items are joined with the seeds of every position of every document. A hit fixes how item
and document lie against each other; the words around it are then compared one by one,
and an overlap counts if enough words of a stretch agree.
"""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskpanel.llm.common import packed, text_of
from riskpanel.session import materialise

#: Offsets of the words that a seed looks at. Of a stretch of 8 to 20 words in which a fifth of
#: the words is replaced, in whatever places, at least one window of these masks is whole.
MASKS = ((0, 1, 3, 4, 6), (0, 2, 3, 6, 7), (0, 1, 5, 7))
_SPAN = 1 + max(max(m) for m in MASKS)
_SEEDS_AT_ONCE = 1_000_000


def words_of(text: Column) -> Column:
    """Lower-case words of letters and digits; no words for an empty text."""
    plain = F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))
    return F.filter(F.split(plain, " ", -1), lambda w: w != "")


def short_masks(n: int, similarity: float) -> list[tuple[int, tuple[int, ...]]]:
    """(place, mask) for an item of ``n`` words, fewer than the masks span: one for each choice of words that may differ."""
    equal = math.ceil(n * similarity - 1e-9)
    chosen = combinations(range(n), equal)
    return [(c[0], tuple(o - c[0] for o in c)) for c in chosen]


def _seed(words: Column, at: Column, mask: tuple[int, ...]) -> Column:
    """The hash of the words a mask looks at from a position on; null where it doesn't fit."""
    looked = [F.get(words, at + F.lit(o)) for o in mask]
    return F.when(at + F.lit(mask[-1]) < F.size(words), F.xxhash64(F.lit("-".join(map(str, mask))), *looked))


def _item_seeds(items: DataFrame, similarity: float) -> tuple[DataFrame, list[tuple[int, ...]]]:
    """(item_id, item_at, seed) of all items, and all masks in use."""
    size = F.size("item")
    lengths = sorted(r["n"] for r in items.filter(size < _SPAN).select(size.alias("n")).distinct().collect())  # below the span
    long = items.filter(size >= _SPAN).select("item_id", "item", F.posexplode("item").alias("item_at", "word"))
    seeds = long.select("item_id", "item_at", F.explode(F.array(*[_seed(F.col("item"), F.col("item_at"), m) for m in MASKS])).alias("seed"))
    masks = list(MASKS)
    for n in lengths:
        own = short_masks(n, similarity)
        masks += [m for _, m in own if m not in masks]
        at = F.array(*[F.struct(F.lit(a).alias("item_at"), _seed(F.col("item"), F.lit(a), m).alias("seed")) for a, m in own])
        seeds = seeds.unionByName(items.filter(size == n).select("item_id", F.inline(at)))
    return seeds.filter(F.col("seed").isNotNull()).distinct(), masks


def overlaps(
    docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8, stretch: int = 20
) -> DataFrame:
    """Pairs (doc_id, item_id) with an overlap, where it begins in the document, and its agreeing words.

    A document overlaps an item if, at some alignment, at least ``similarity`` of the words
    of a stretch agree one by one; a stretch is ``stretch`` words, or the whole item if that
    is shorter. This holds for items and documents of any length: items shorter than the
    masks have seeds of their own, one for each choice of words that may differ. Null, empty
    and wordless texts overlap nothing, nor do rows without an id. Of repeated rows or items
    one pair is returned; rows that share a doc_id are all looked at. Of several places that
    with the most agreeing words counts, the first of equal ones. Other columns are not read; empty tables give an empty result.

    The documents are read once per block of at most a million seeds of the benchmark; a
    block is what is broadcast, so its size is bounded however large the benchmark is.
    """
    items = benchmark.filter(F.col("item_id").isNotNull()).select(F.col("item_id").cast("bigint").alias("item_id"), words_of(text_of()).alias("item"))
    items = materialise(items.filter(F.size("item") > 0).distinct(), "items")
    seeds, masks = _item_seeds(items, similarity)
    seeds = materialise(seeds, "item-seeds")
    blocks = max(1, math.ceil(seeds.count() / _SEEDS_AT_ONCE * 1.25))
    texts = docs.filter(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text_of()).alias("version"), words_of(text_of()).alias("words")
    )
    spread = texts.select("doc_id", "version", "words", F.posexplode("words").alias("at", "word")).drop("word")
    every = F.array(*[_seed(F.col("words"), F.col("at"), m) for m in masks])
    spread = spread.select("doc_id", "version", "words", "at", F.explode(every).alias("seed")).filter(F.col("seed").isNotNull())
    # what the document shows beside one place of the item, and a stretch more on either side
    shift, place = F.col("at") - F.col("item_at"), F.floor(F.col("item_at") / stretch).cast("int")
    first = F.greatest(shift + place * stretch - stretch, F.lit(0))
    around = F.slice("words", first + 1, F.lit(3 * stretch + _SPAN))
    found = None
    for block in range(blocks):
        part = seeds.filter(F.pmod(F.xxhash64("seed"), F.lit(blocks)) == block) if blocks > 1 else seeds
        # one alignment and place in the item is compared once, whatever its number of hits
        hits = spread.join(F.broadcast(part), "seed").select(
            "doc_id",
            "version",
            "item_id",
            shift.alias("shift"),
            place.alias("place"),
            F.struct(first.alias("first"), around.alias("around")).alias("seen"),
        )
        kept = materialise(hits.groupBy("doc_id", "version", "item_id", "shift", "place").agg(F.min("seen").alias("seen")), "hits")
        found = kept if found is None else found.unionByName(kept)
    return _verified(found, items, similarity, stretch)


def _verified(hits: DataFrame, items: DataFrame, similarity: float, stretch: int) -> DataFrame:
    """The hits with a stretch of enough agreeing words."""
    rows = hits.join(items, "item_id").select("doc_id", "item_id", "shift", "seen.*", "item")
    offset = F.col("first") - F.col("shift")  # of the first seen word in the item; may be negative

    def agrees(word: Column, i: Column) -> Column:
        at = offset + i
        same = F.get("item", F.when(at >= 0, at)) == word
        return F.coalesce(same, F.lit(False)).cast("int")

    rows = rows.withColumn("same", F.transform("around", agrees))
    width = F.least(F.lit(stretch), F.size("item"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("same") - width, F.lit(0)))
    total = lambda a: F.aggregate(a, F.lit(0), lambda x, y: x + y)
    counts = F.transform(starts, lambda s: total(F.slice("same", s + 1, width)))
    rows = rows.withColumn("counts", counts).withColumn("matched", F.array_max("counts"))
    enough = F.col("matched") >= F.ceil(width * F.lit(similarity) - F.lit(1e-9))
    begins = F.col("first") + F.array_position("counts", F.col("matched")).cast("int") - 1
    rows = rows.filter(enough).withColumn("begins", begins)
    best = F.max_by(F.struct("begins", "matched"), F.struct("matched", -F.col("begins"))).alias("best")
    return rows.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", F.col("best.begins").alias("begins"), F.col("best.matched").alias("matched")
    )


def clean(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8, stretch: int = 20) -> DataFrame:
    """The rows of ``docs`` that overlap no benchmark item; rows without doc_id stay."""
    bad = materialise(overlaps(docs, benchmark, similarity, stretch).select(F.col("doc_id").alias("bad")).distinct(), "contaminated")
    rows = docs.select(packed(docs).alias("row"), F.col("doc_id").cast("bigint").alias("own"))
    return rows.join(bad, F.col("own") == F.col("bad"), "left_anti").select("row.*")
