"""Phrase collocation mining by Rabin-Karp fingerprints.

A prefix polynomial over the bytes of a batch gives the fingerprint of every run of words in
a few numpy steps; a second hash of another kind, made of the words' bytes and places, is its
check. Runs are counted by both, 128 bits, through a shuffle, in rounds of growing length; a
longer run is counted only if its parts that were counted before are frequent. Fingerprints
that collide thus keep their counts apart.

With each count comes the owner of the run, one of the tasks that hold it, and only the owner
spells it out: a frequent phrase is one row, however many tasks hold it. Should tasks read
other rows the second time, so that an owner lacks its phrase, every task spells those out.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskpanel.llm.byte_words import Alphabet, Filter, Words, chunks, filter_of, mixed, seeds, string_array
from riskpanel.llm.common import ship, text_of
from riskpanel.session import materialise

_WORDS = Alphabet(gaps=b" \t", breaks=b".,;:!?\n\x0b\x0c\r")
_STEP = 0xD6E8FEB86659FD93
_OWNERS = 255  # among so many neighbouring tasks the ownership is spread by fingerprint
_SPREAD = 0x5BD1E995
_SEEN = 1 << 21


def _runs(words: Words, seed: np.ndarray, size: int, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First words of the runs of ``size`` words within a piece, of those in question, and their fingerprints."""
    n = max(0, len(words.start) - size + 1)
    at = np.flatnonzero(among[:n] & (words.piece[size - 1 :] == words.piece[:n]) if n else np.zeros(0, bool))
    hashed = words.hashes(words.start[at], words.end[at + size - 1])
    return at, mixed((hashed ^ seed[words.text[at]]) + np.uint64(size * _STEP % (1 << 64)))


def _candidates(words: Words, langs: pa.Array, sizes: tuple[int, ...], known: list[tuple[int, Filter]], bits: int):
    """(size, first words, fingerprints, checks) of the runs whose frequent parts do not rule them out."""
    seed, other, marks = seeds(langs), seeds(langs, 1), words.marks()
    short = np.uint64((1 << bits) - 1)
    every = np.ones(len(words.start), bool)
    among = {0: every}
    for part, frequent in known:
        at, found = _runs(words, seed, part, every)
        among[part] = np.zeros(len(words.start), bool)
        among[part][at[frequent.has(found & short)]] = True
    for size in sizes:
        part = max(p for p in among if p < size)
        inside = among[part].copy()
        for i in range(1, size - part + 1 if part else 1):
            inside[:-i] &= among[part][i:]
            inside[-i:] = False
        at, found = _runs(words, seed, size, inside)
        check = other[words.text[at]] + np.uint64(size)
        for i in range(size):
            check = check * np.uint64(_STEP) + marks[at + i]
        yield size, at, found & short, mixed(check)


class _Counts:
    """Counts of fingerprints with their checks, many at a time."""

    def __init__(self, most: int = 1 << 21):
        self.most, self._parts, self._rows = most, [], 0

    def add(self, found: np.ndarray, check: np.ndarray):
        self._parts.append((found, check))
        self._rows += len(found)
        if self._rows >= self.most:
            yield self.take()

    def take(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Fingerprints, checks and counts of all gathered; a pair may come in several rows."""
        parts = self._parts or [(np.zeros(0, np.uint64), np.zeros(0, np.uint64))]
        found, check = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
        self._parts, self._rows = [], 0
        order = np.argsort(found)
        found, check = found[order], check[order]
        fresh = np.ones(len(found), bool)
        fresh[1:] = (found[1:] != found[:-1]) | (check[1:] != check[:-1])
        first = np.flatnonzero(fresh)
        return found[first], check[first], np.diff(np.append(first, len(found)))


def _owner(found: np.ndarray, task: int) -> np.ndarray:
    """The task as each fingerprint ranks it: the smallest of those that hold a run owns it."""
    return (found & np.uint64(_OWNERS)) ^ np.uint64(task)


def _owned(found: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """One number for a fingerprint and its owner."""
    owner = owner + np.uint64(1)
    return found ^ (owner * np.uint64(_SPREAD)) ^ (owner << np.uint64(32))


def _counted(texts: DataFrame, sizes: tuple[int, ...], known, bits: int) -> DataFrame:
    """(fp, mark, owner, n): how often each run occurs, by task."""

    def run(batches):
        out, task = _Counts(), TaskContext.get().partitionId()

        def rows_of(counted) -> pa.RecordBatch:
            found, check, n = counted
            columns = [found.view(np.int64), check.view(np.int64), _owner(found, task).view(np.int64), n.astype(np.int64)]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["fp", "mark", "owner", "n"])

        for rows, words in chunks(batches, _WORDS):
            for _, _, found, check in _candidates(words, rows.column("lang"), sizes, known.value, bits):
                yield from map(rows_of, out.add(found, check))
        yield rows_of(out.take())

    return texts.mapInArrow(run, "fp long, mark long, owner long, n long")


class _Seen:
    """What a task has spelled out; beyond ``_SEEN`` keys it begins anew, and a phrase may come again."""

    def __init__(self):
        self._old, self._new, self._rows = np.zeros(0, np.uint64), [], 0

    def fresh(self, keys: np.ndarray) -> np.ndarray:
        """The place of one of each key not seen before; a few may have been."""
        keys, at = np.unique(keys, return_index=True)
        place = np.searchsorted(self._old, keys)
        old = np.append(self._old, np.uint64(0))[place] == keys if len(self._old) else np.zeros(len(keys), bool)
        old &= place < len(self._old)
        self._new.append(keys[~old])
        self._rows += len(self._new[-1])
        if self._rows >= max(256, len(self._old) // 8):
            self._old = np.unique(np.concatenate([self._old, *self._new]))
            self._new, self._rows = [], 0
            if len(self._old) > _SEEN:
                self._old = np.zeros(0, np.uint64)
        return at[~old]


def _spelled(texts: DataFrame, sizes: tuple[int, ...], known, frequent, owned, bits: int) -> DataFrame:
    """(fp, mark, lang, words, phrase, n) of the frequent phrases that a task owns, of all if ``owned`` is None.

    No words and no fingerprint: ``n`` words of the language in the task. A few phrases that
    are not frequent or not owned may be among them.
    """

    def run(batches):
        task, seen, totals = TaskContext.get().partitionId(), _Seen(), {}
        names = ["fp", "mark", "lang", "words", "phrase", "n"]
        for rows, words in chunks(batches, _WORDS):
            lang = rows.column("lang").dictionary_encode()
            of = lang.indices.to_numpy(zero_copy_only=False)[words.text] if len(words.text) else np.zeros(0, np.int64)
            for name, n in zip(lang.dictionary.to_pylist(), np.bincount(of, minlength=len(lang.dictionary)).tolist(), strict=True):
                totals[name] = totals.get(name, 0) + n
            for size, at, found, check in _candidates(words, rows.column("lang"), sizes, known.value, bits):
                kept = np.flatnonzero(frequent.value.has(found))
                if owned is not None:
                    kept = kept[owned.value.has(_owned(found[kept], _owner(found[kept], task)))]
                kept = kept[seen.fresh(found[kept] ^ check[kept])]
                at, found, check = at[kept], found[kept], check[kept]
                text = string_array(words.data, words.start[at], words.end[at + size - 1])
                columns = [pa.array(found.view(np.int64)), pa.array(check.view(np.int64)), lang.dictionary.take(pa.array(of[at]))]
                columns += [pa.array(np.full(len(at), size, np.int32)), text, pa.nulls(len(at), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names)
        none, k = pa.nulls(len(totals), pa.int64()), len(totals)
        columns = [none, none, pa.array(list(totals), pa.string()), pa.array([0] * k, pa.int32()), pa.array([""] * k, pa.string())]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(list(totals.values()), pa.int64())], names)

    return texts.mapInArrow(run, "fp long, mark long, lang string, words int, phrase string, n long")


def _filter(spark, found: DataFrame):
    return spark.sparkContext.broadcast(filter_of(found, found.count()))


def frequent_phrases(docs: DataFrame, longest: int, least: int, bits: int = 64) -> DataFrame:
    """(lang, words, phrase, n) of the runs of up to ``longest`` words that occur at least ``least`` times in their language.

    A row of no words holds the number of all words of a language. Of a fingerprint ``bits``
    are used, from which the result does not depend.
    """
    spark = docs.sparkSession
    ship(spark)
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und"))
    texts = docs.select(lang.alias("lang"), text_of().alias("text"))
    known, found = [], []
    for first in range(1, longest + 1, 2):
        sizes = tuple(range(first, min(first + 1, longest) + 1))
        counted = _counted(texts, sizes, spark.sparkContext.broadcast(known), bits)
        counted = counted.groupBy("fp", "mark").agg(F.sum("n").alias("n"), F.min("owner").alias("owner"))
        found.append(materialise(counted.filter(F.col("n") >= least), "frequent-runs"))
        if sizes[-1] < longest:
            known = [*known, (sizes[-1], filter_of(found[-1], found[-1].count()))]
    often = reduce(DataFrame.unionByName, found)
    sizes, known = tuple(range(1, longest + 1)), spark.sparkContext.broadcast(known)
    owner = F.col("owner") + 1
    owned = F.col("fp").bitwiseXOR(owner * _SPREAD).bitwiseXOR(F.shiftleft(owner, 32))  # as _owned
    owned = _filter(spark, often.select(owned.alias("fp")))
    spelled = materialise(_spelled(texts, sizes, known, _filter(spark, often), owned, bits), "spelled-phrases")
    totals = spelled.filter("words = 0").groupBy("lang", "words", "phrase").agg(F.sum("n").alias("n"))
    phrases = spelled.filter("words > 0").drop("n")
    missing = often.join(phrases, ["fp", "mark"], "left_anti")
    if not missing.isEmpty():
        missing = materialise(missing, "missing-phrases")
        phrases = phrases.unionByName(_spelled(texts, sizes, known, _filter(spark, missing), None, bits).filter("words > 0").drop("n"))
    phrases = phrases.join(often.select("fp", "mark", "n"), ["fp", "mark"])
    phrases = phrases.groupBy("lang", "words", "phrase").agg(F.max("n").alias("n"))
    return materialise(phrases.unionByName(totals), "frequent-phrases")


def _exact(c: str | Column) -> Column:
    """A count whose products may pass 64 bits."""
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(20,0)")


def collocations(
    docs: DataFrame, longest: int = 4, least: int = 30, scale: int = 2_000_000, inside_percent: int = 80, top: int = 2000
) -> DataFrame:
    """Each language's ``top`` phrases: lang, rank (from 1), phrase, a, l, r, n, score.

    ``docs`` has text and lang. A-Z are lower-cased; texts are parted at ``.,;:!?`` and line
    breaks into pieces and these at spaces and tabs into words. A candidate has 2 to
    ``longest`` words and occurs ``a`` times, at least ``least``, within pieces of its
    language. Cut in two it scores floor(scale * a / (l + r)), l and r being how often
    its parts occur; the lowest-scoring cut counts, the earliest of equal ones. Candidates
    that stand in a longer one which occurs at least ``inside_percent`` percent as often go.
    Ties go to the higher a, then to the smaller phrase by bytes; n counts all words.

    A null text is empty, and a null lang is ``und``. Repeated rows count repeatedly, other
    columns are not read, and an empty table gives an empty result. A phrase, however
    frequent, is counted in one row per task and 2**21 runs, and spelled out by one task.
    """
    phrases = frequent_phrases(docs, longest, least)
    totals = phrases.filter("words = 0").select("lang", F.col("n").alias("total"))
    known = phrases.filter("words > 0")
    candidates = known.filter("words > 1").select("lang", "words", "phrase", F.col("n").alias("a"))
    split = candidates.withColumn("word", F.split("phrase", " ", -1))
    cuts = split.select("lang", "phrase", "a", "word", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("cut"))
    head = F.array_join(F.slice("word", F.lit(1), F.col("cut")), " ").alias("head")
    rest = F.array_join(F.slice("word", F.col("cut") + 1, F.size("word")), " ").alias("rest")
    cuts = cuts.select("lang", "phrase", "a", "cut", head, rest)
    left = known.select("lang", F.col("phrase").alias("head"), F.col("n").alias("l"))
    right = known.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
    cuts = cuts.join(left, ["lang", "head"]).join(right, ["lang", "rest"])
    cuts = cuts.withColumn("a_exact", _exact("a")).withColumn("parts", _exact("l") + _exact("r"))
    score = F.expr(f"cast((cast({scale} as decimal(10,0)) * a_exact) div parts as bigint)")
    cuts = cuts.withColumn("score", score)
    lowest = F.min_by(F.struct("l", "r", "score"), F.struct("score", "cut")).alias("lowest")
    scored = cuts.groupBy("lang", "phrase").agg(F.first("a").alias("a"), lowest)
    inner = split.filter("words > 2").select(
        "lang", F.col("a").alias("longer"), "word", F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("size")
    )
    inner = inner.select("lang", "longer", "word", "size", F.explode(F.sequence(F.lit(1), F.size("word") - F.col("size") + 1)).alias("at"))
    inner = inner.select("lang", F.array_join(F.slice("word", F.col("at"), F.col("size")), " ").alias("phrase"), "longer")
    inner = inner.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = scored.join(inner, ["lang", "phrase"], "left")
    covered = _exact("longer") * 100 >= _exact("a") * inside_percent
    kept = kept.filter(F.col("longer").isNull() | ~covered).join(totals, "lang")
    order = Window.partitionBy("lang").orderBy(F.col("lowest.score").desc(), F.col("a").desc(), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order).cast("bigint")).filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "lowest.l", "lowest.r", F.col("total").alias("n"), "lowest.score")
