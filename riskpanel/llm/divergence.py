"""Source divergence audit: term frequencies of the sources of a language, by iceberg prefixes.

Only terms in enough documents of their language are compared. They are found level by level:
the documents that hold a term with a certain prefix are counted, prefixes in too few
documents are discarded with all terms that begin with them, and the remaining ones are made
twice as long, until only whole terms remain. A level counts fingerprints of prefixes, which can
only keep too much; the terms that are left are counted by their bytes.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskpanel.llm.byte_words import Alphabet, Filter, Fingerprints, Tally, Words, chunks, filter_of, mixed, seeds
from riskpanel.llm.common import ship, text_of
from riskpanel.session import materialise

_WORDS = Alphabet(gaps=bytes(b for b in range(128) if not chr(b).isalpha()))
_LEVEL_STEP = 0xA24BAED4963EE407
_CELLS_AT_ONCE = 1 << 21


def _prefixes(words: Words, seed: np.ndarray, length: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of the prefixes of some words, odd if a prefix is the whole word, and whether it is."""
    start, end = words.start[at], words.end[at]
    whole = end - start <= length
    found = words.hashes(start, np.minimum(end, start + length)) ^ seed[words.text[at]]
    found = mixed(found + np.uint64(length * _LEVEL_STEP % (1 << 64)))
    return (found & ~np.uint64(1)) | whole, whole


def _open_words(words: Words, seed: np.ndarray, levels: list[tuple[int, Filter]]) -> tuple[np.ndarray, np.ndarray]:
    """Words longer than all levels whose prefixes are all kept, and kept whole words."""
    at, done = np.arange(len(words.start)), []
    for length, kept in levels:
        found, whole = _prefixes(words, seed, length, at)
        stays = kept.has(found)
        done.append(at[stays & whole])
        at = at[stays & ~whole]
    return at, np.concatenate(done) if done else np.zeros(0, np.int64)


def _level(texts: DataFrame, length: int, levels) -> DataFrame:
    """(fp, n): documents per prefix of a length, by task."""

    def run(batches):
        out = Fingerprints()
        for rows, words in chunks(batches, _WORDS):
            seed = seeds(rows.column("lang"))
            at, _ = _open_words(words, seed, levels.value)
            found, _ = _prefixes(words, seed, length, at)
            text = words.text[at]
            bounds = np.searchsorted(text, np.arange(rows.num_rows + 1))
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                found[a:b].sort()
            once = np.ones(len(found), bool)  # a document counts once
            once[1:] = (found[1:] != found[:-1]) | (text[1:] != text[:-1])
            yield from out.add(found[once])
        yield out.take()

    return texts.mapInArrow(run, "fp long, n long")


def _cells(texts: DataFrame, levels) -> DataFrame:
    """(lang, source, term, n, docs) of the terms that are left, by task."""

    def run(batches):
        names: dict[tuple[str, str], int] = {}
        tally = Tally(2)

        def rows_of(found: pa.RecordBatch) -> pa.RecordBatch:
            keys, group = list(names), found.column("group")
            lang, source = (pa.array([k[i] for k in keys], pa.string()).take(group) for i in (0, 1))
            columns = [lang, source, found.column("string"), found.column("n0"), found.column("n1")]
            return pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "docs"])

        for rows, words in chunks(batches, _WORDS):
            pairs = zip(rows.column("lang").to_pylist(), rows.column("source").to_pylist(), strict=True)
            group = np.array([names.setdefault(p, len(names)) for p in pairs], np.int64)
            seed = seeds(rows.column("lang"))
            _, at = _open_words(words, seed, levels.value)
            # one row per document and term, then one per group and term
            total = max(1, len(words.start))
            each, n = np.unique(words.text[at] * total + words.identities()[at], return_counts=True)
            at, of = each % total, group[each // total]
            key = mixed(words.hashes(words.start[at], words.end[at]) + of.astype(np.uint64))
            yield from map(rows_of, tally.add(key, of, np.stack([n, np.ones_like(n)]), words.data, words.start[at], words.end[at]))
        yield rows_of(tally.take())

    return texts.mapInArrow(run, "lang string, source string, term string, n long, docs long")


def kept_terms(docs: DataFrame, min_docs: int = 30, first_length: int = 6) -> tuple[DataFrame, DataFrame]:
    """(lang, source, term, n) of the terms in at least ``min_docs`` documents of their language, and all (lang, source)."""
    spark = docs.sparkSession
    ship(spark)
    read = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    texts = docs.select(read("lang"), read("source"), text_of().alias("text"))
    groups = materialise(texts.select("lang", "source").distinct(), "groups")
    levels: list[tuple[int, Filter]] = []
    length = first_length
    while True:
        counted = _level(texts.select("lang", "text"), length, spark.sparkContext.broadcast(levels))
        counted = counted.groupBy("fp").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_docs).select("fp")
        counted = materialise(counted, "kept-prefixes")
        rows, whole = counted.agg(F.count("*"), F.coalesce(F.sum(F.col("fp").bitwiseAND(F.lit(1).cast("bigint"))), F.lit(0))).first()
        levels.append((length, filter_of(counted, rows)))
        if rows == whole:  # no longer term is left
            break
        length *= 2
    cells = _cells(texts, spark.sparkContext.broadcast(levels))
    cells = cells.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    cells = materialise(cells, "term-counts")
    enough = cells.groupBy("lang", "term").agg(F.sum("docs").alias("in_docs"), F.sum("n").alias("total"))
    enough = materialise(enough.filter(F.col("in_docs") >= min_docs).select("lang", "term", "total"), "kept-terms")
    return materialise(cells.join(enough, ["lang", "term"]).drop("docs"), "kept-term-counts"), groups


def _with_share(rows: DataFrame, count: str, total: str, terms: str, name: str) -> DataFrame:
    """Adds 1 + floor(10^9 * (count + 5) / (total + 5 * terms)), exact beyond 64 bits; null without terms."""
    exact = lambda c: F.col(c).cast("decimal(20,0)")
    rows = rows.withColumn("_above", (exact(count) + 5) * F.lit(1_000_000_000).cast("decimal(10,0)"))
    rows = rows.withColumn("_below", exact(total) + exact(terms) * 5)
    return rows.withColumn(name, F.when(F.col("_below") > 0, F.expr("_above div _below") + 1)).drop("_above", "_below")


def _differences(cells: pa.Table, groups: pa.Table) -> pa.Table:
    """Sums of the differences between each two sources over the terms at hand."""
    source, none = groups.column("source").to_pylist(), groups.column("none").fill_null(0).to_numpy()
    order = np.argsort(np.array(source, object), kind="stable") if source else np.zeros(0, int)
    source, none = [source[i] for i in order], none[order]
    number = {s: i for i, s in enumerate(source)}
    term = cells.column("term").combine_chunks().dictionary_encode()
    shares = np.tile(none.astype(np.int64), (len(term.dictionary), 1))
    if cells.num_rows:
        of = np.array([number[s] for s in cells.column("source").to_pylist()])
        shares[term.indices.to_numpy(), of] = cells.column("p").to_numpy()
    sums = [np.abs(shares - shares[:, i : i + 1]).sum(axis=0) for i in range(len(source))]
    one, other = np.nonzero(~np.eye(len(source), dtype=bool))
    lang = groups.column("lang").to_pylist()[:1] * len(one)
    value = np.stack(sums)[one, other] if len(one) else np.zeros(0, np.int64)
    columns = [pa.array(lang, pa.string()), pa.array([source[i] for i in one], pa.string()), pa.array([source[i] for i in other], pa.string())]
    return pa.Table.from_arrays([*columns, pa.array(value, pa.int64())], ["lang", "source", "item", "value"])


def audit(docs: DataFrame, min_docs: int = 30, top_terms: int = 50) -> DataFrame:
    """How the sources of a language differ: lang, source, part, item, value, rank (from 1).

    ``docs`` has text, lang and source, null read as ''. Terms are runs of ASCII letters and
    of characters beyond ASCII, A-Z lower-cased. A language's kept terms are those in at least
    ``min_docs`` of its rows; each source, and the language itself, gives each kept term
    p = 1 + floor(10^9 (count + 5) / (N + 5 V)). Part ``pair``: ``value`` is the sum of
    |p - q| over all kept terms to the ``item``, each other source of the language. Part
    ``term``: the source's ``top_terms`` kept terms with p above the language's, by the
    difference. Ranks go by value, ties to the smaller item by UTF-8 bytes.

    A source without terms takes part in the pairs; without kept terms all values are 0. A
    repeated row is a document of its own, other columns are not read, and an empty
    table gives an empty result. Documents are reduced to counts per source and term within
    their task, so a source with a third of all rows is no larger than others after it; pairs
    are summed over slices of the terms, whose number grows with the counts.
    """
    cells, groups = kept_terms(docs, min_docs)
    by_lang = cells.select("lang", "term", "total").distinct().groupBy("lang")
    by_lang = by_lang.agg(F.count("*").alias("terms"), F.sum("total").alias("lang_total"))
    by_source = cells.groupBy("lang", "source").agg(F.sum("n").alias("source_total"))
    facts = groups.join(by_lang, "lang", "left").join(by_source, ["lang", "source"], "left")
    facts = facts.na.fill(0, ["terms", "lang_total", "source_total"])
    facts = facts.withColumn("zero", F.lit(0))
    facts = materialise(_with_share(facts, "zero", "source_total", "terms", "none"), "source-facts")
    shares = cells.join(facts.select("lang", "source", "terms", "lang_total", "source_total"), ["lang", "source"])
    shares = _with_share(shares, "n", "source_total", "terms", "p")
    shares = _with_share(shares, "total", "lang_total", "terms", "q")
    shares = materialise(shares.select("lang", "source", "term", "p", "q"), "term-shares")

    size = facts.groupBy("lang").agg((F.max("terms") * F.count("*")).alias("n")).agg(F.max("n")).first()[0] or 0
    slices = max(1, math.ceil(size / _CELLS_AT_ONCE))
    part = F.pmod(F.xxhash64("term"), F.lit(slices)).cast("int").alias("part")
    every = facts.select("lang", "source", "none", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("part"))
    sliced = shares.select("lang", "source", "term", "p", part)
    pairs = sliced.groupBy("lang", "part").cogroup(every.groupBy("lang", "part"))
    pairs = pairs.applyInArrow(_differences, "lang string, source string, item string, value long")
    pairs = pairs.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))

    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    rank = F.row_number().over(order).alias("rank")
    terms = shares.filter("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    terms = terms.select("*", rank).filter(F.col("rank") <= top_terms)
    out = [pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", rank)]
    out.append(terms.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank"))
    return out[0].unionByName(out[1])
