"""Language identification by rank-order profiles.

A profile is the list of a text's most frequent character n-grams, most frequent first. A
document's profile is compared with that of each language by the out-of-place distance: how
many places each n-gram of the document is away from its place in the language's list, an
n-gram that is not in it being as many places away as the list is long. The nearest language
is the prediction. N-grams have one to three letters or begin or end with a word's edge; they
are 64-bit integers made of their characters, so they are counted by sorting numbers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskpanel.llm.common import packed, ship
from riskpanel.session import materialise

_SHIFT = np.uint64(21)  # bits of a character
_EDGE = 32
_CHARACTERS_AT_ONCE = 1 << 17
UNKNOWN = "und"


@lru_cache(1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def n_grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All n-grams of the texts, sorted within each text, and where each text's begin and the last one's end."""
    lowered = [t.lower() for t in texts]
    codes = np.frombuffer("".join(f"\n{t}" for t in lowered).encode("utf-32-le", "surrogatepass"), "<u4")
    codes = np.append(codes, np.uint32(10))
    letter = _letters()[codes]
    first_of = np.cumsum([0] + [len(t) + 1 for t in lowered])  # a line break stands before each text
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # the first edge behind a word
    keep[:-1] |= letter[1:]  # and the last one before the next
    place = np.flatnonzero(keep)
    letter, code = letter[place], np.where(letter[place], codes[place], _EDGE).astype(np.uint64)
    text = np.searchsorted(first_of, place, side="right") - 1
    grams, of = [code[letter]], [text[letter]]
    if len(code) > 1:
        two = letter[:-1] | letter[1:]
        grams.append(((code[:-1] << _SHIFT) | code[1:])[two])
        of.append(np.where(letter[:-1], text[:-1], text[1:])[two])
    if len(code) > 2:
        three = letter[1:-1]  # an edge in the middle belongs to two words
        grams.append(((code[:-2] << (_SHIFT + _SHIFT)) | (code[1:-1] << _SHIFT) | code[2:])[three])
        of.append(text[1:-1][three])
    cuts = [np.searchsorted(o, np.arange(len(texts) + 1)) for o in of]
    bounds = np.sum(cuts, axis=0)
    out = np.empty(bounds[-1], np.uint64)
    for i in range(len(texts)):
        part = out[bounds[i] : bounds[i + 1]]
        np.concatenate([g[c[i] : c[i + 1]] for g, c in zip(grams, cuts, strict=True)], out=part)
        part.sort()
    return out, bounds


def _runs(found: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct n-grams of each text, how often they occur, and where each text's begin."""
    fresh = np.ones(len(found), bool)
    fresh[1:] = found[1:] != found[:-1]
    fresh[bounds[:-1][bounds[:-1] < len(found)]] = True
    at = np.flatnonzero(fresh)
    return found[at], np.diff(np.append(at, len(found))), np.searchsorted(at, bounds)


@dataclass
class Profiles:
    """The languages' profiles: the n-grams in any of them, and each one's place in each, -1 if absent."""

    languages: list[str]
    grams: np.ndarray
    places: np.ndarray
    length: int

    def nearest(self, grams: np.ndarray, counts: np.ndarray) -> tuple[str, float]:
        """The nearest language of a text and 1 less its distance, as a share of the largest possible one."""
        if not len(grams) or not self.languages:
            return UNKNOWN, 0.0
        best = np.argsort(-counts, kind="stable")[: self.length]  # ties go to the smaller n-gram
        at = np.minimum(np.searchsorted(self.grams, grams[best]), len(self.grams) - 1)
        known = self.grams[at] == grams[best]
        places = self.places[at[known]]
        apart = np.where(places < 0, self.length, np.abs(places - np.flatnonzero(known)[:, None])).sum(axis=0)
        apart += self.length * int((~known).sum())
        nearest = int(apart.argmin())
        return self.languages[nearest], 1 - float(apart[nearest]) / (self.length * len(best))


def _pieces(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Whole texts of about a bounded number of characters: (first, last) numbers."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= _CHARACTERS_AT_ONCE:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def train(
    docs: DataFrame, learn_from: Column, length: int = 300, sample_rows: int = 2000, most_languages: int = 1000
) -> Profiles:
    """Profiles of the languages of ``docs`` (text, lang) from rows with text and lang that meet ``learn_from``.

    About ``sample_rows`` rows of each language are read whole, chosen by a hash of the row;
    the ``most_languages`` most frequent languages are learned. Counts of n-grams are an
    aggregate; only the ``length`` most frequent ones of each language come to the driver.
    """
    ship(docs.sparkSession)
    rows = docs.filter(F.col("text").isNotNull() & F.col("lang").isNotNull() & F.coalesce(learn_from, F.lit(False)))
    rows = rows.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"), F.xxhash64(packed(docs)).alias("h"))
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "lang").limit(most_languages)
    every = F.greatest(F.lit(1), F.ceil(F.col("n") / sample_rows)).cast("bigint").alias("every")
    chosen = rows.join(F.broadcast(sizes.select("lang", every)), "lang").filter(F.pmod("h", "every") == 0)

    def run(batches):
        for batch in batches:
            texts, lang = batch.column("text").to_pylist(), np.array(batch.column("lang").to_pylist(), object)
            for first, last in _pieces(texts):
                grams, counts, bounds = _runs(*n_grams(texts[first:last]))
                each = np.repeat(lang[first:last], np.diff(bounds))
                yield pa.RecordBatch.from_arrays([pa.array(each, pa.string()), pa.array(grams.view(np.int64)), pa.array(counts.astype(np.int64))], ["lang", "gram", "n"])

    counted = chosen.select("lang", "text").mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram")
    ranked = counted.withColumn("place", F.row_number().over(order) - 1).filter(F.col("place") < length)
    found = materialise(ranked.select("lang", "gram", "place"), "language-profiles").collect()
    languages = sorted({r["lang"] for r in found}, key=str.encode)
    grams = sorted({r["gram"] for r in found})
    number, of = {g: i for i, g in enumerate(grams)}, {x: i for i, x in enumerate(languages)}
    places = np.full((len(grams), len(languages)), -1, np.int64)
    for r in found:
        places[number[r["gram"]], of[r["lang"]]] = r["place"]
    return Profiles(languages, np.array(grams, np.uint64), places, length)


def identify(docs: DataFrame, profiles: Profiles, text: str = "text") -> DataFrame:
    """Every row of ``docs``, without its text, as a struct ``row`` with ``lang_pred`` and ``score``.

    ``score`` lies in 0 to 1 and is higher the nearer the language; equally near languages
    go to the smaller name. A null text and one without letters are ``und`` with score 0,
    as is every row if no language was learned. Whole texts are read. Repeated rows are
    judged alike, and an empty table gives an empty result.
    """
    spark = docs.sparkSession
    ship(spark)
    model = spark.sparkContext.broadcast(profiles)
    kept = [c for c in docs.columns if c != text]
    rows = docs.select(packed(docs.select(*[F.col(f"`{c}`") for c in kept])).alias("row"), F.col(f"`{text}`").cast("string").alias("text"))
    schema = f"row {rows.schema['row'].dataType.simpleString()}, lang_pred string, score double"

    def run(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            found = []
            for first, last in _pieces(texts):
                grams, counts, bounds = _runs(*n_grams(texts[first:last]))
                found += [model.value.nearest(grams[a:b], counts[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            columns = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
            yield pa.RecordBatch.from_arrays([batch.column("row"), *columns], ["row", "lang_pred", "score"])

    return rows.mapInArrow(run, schema)
