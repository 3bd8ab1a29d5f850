"""Token counts without token ids.

No piece of the vocabulary holds a space mark behind another character, so pieces never
cross from a character to a following run of spaces. A text is thus a sequence of
pre-tokens, each a run of spaces and what follows up to the next one, and its token
count is the sum of theirs. Each distinct pre-token of the corpus is tokenised once; the
counts are joined to the documents' pre-tokens and summed.

The counts of the most frequent pre-tokens, up to a bound on rows and bytes, are broadcast and
summed where the documents are. A filter of bounded size tells which of the others occur only
once in the corpus: such a one is tokenised in its place. The rest, each in some documents,
goes once as (row, pre-token, frequency) through a join with the counts. Rows have numbers of
their own, so that neither their ids nor their texts' hashes are sent along.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskpanel.llm.byte_words import Tally, batch_bytes, filter_of, mixed, one_of_equal, same_bytes, slices, string_array, substring_hashes
from riskpanel.llm.common import ship, text_of
from riskpanel.session import materialise, temporary_tables

_MARK = "▁"  # stands for a space inside the vocabulary
_ROW_BITS = 33  # a row's number within its task


def _tokens(processor, pieces: list[str]) -> np.ndarray:
    """Number of tokens of each pre-token."""
    # the library puts one space mark before a text itself
    ids = processor.encode([p[1:] for p in pieces], num_threads=1)
    return np.array([len(x) if p != " " else 1 for x, p in zip(ids, pieces, strict=True)], np.int64)


def _with_counts(rows: DataFrame, model) -> DataFrame:
    """``rows`` with ``n``, the number of tokens of their ``piece``."""
    names = rows.columns

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        processor = sentencepiece.SentencePieceProcessor(model_proto=model.value)
        for batch in batches:
            each = pa.array(_tokens(processor, batch.column("piece").to_pylist()), pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), each], [*names, "n"])

    schema = ", ".join(f"{name} {kind}" for name, kind in rows.dtypes)
    return rows.mapInArrow(count, f"{schema}, n long")


def _keys(pieces: DataFrame) -> DataFrame:
    """(fp): the hashes of pre-tokens, as ``_Pieces`` makes them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_hashed(batch.column("text")).view(np.int64))], ["fp"])

    return pieces.select(F.col("piece").alias("text")).mapInArrow(run, "fp long")


def _hashed(pieces: pa.Array) -> np.ndarray:
    data, bounds = batch_bytes(pieces)
    return substring_hashes(data[bounds[0] : bounds[-1]])(bounds[:-1] - bounds[0], bounds[1:] - bounds[0])


def _head_table(head: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of the most frequent pre-tokens and their numbers of tokens.

    Two of them with one hash would not be told apart: both are left to the join.
    """
    keys = _hashed(head.column("piece").combine_chunks()) if head.num_rows else np.zeros(0, np.uint64)
    keys, first, times = np.unique(keys, return_index=True, return_counts=True)
    return keys[times == 1], head.column("n").to_numpy()[first][times == 1]


def _head(pre_tokens: DataFrame, max_rows: int, max_bytes: int) -> int:
    """Smallest power of two so that pre-tokens at least as frequent fit the bounds."""
    levels = (
        pre_tokens.groupBy(F.floor(F.log2("freq")).cast("int").alias("level"))
        .agg(F.count("*").alias("rows"), F.sum(F.octet_length("piece") + 16).alias("bytes"))
        .orderBy(F.col("level").desc())
        .collect()  # at most 63 rows
    )
    rows = size = 0
    cut = 1 << 62
    for level in levels:
        rows, size = rows + level["rows"], size + level["bytes"]
        if rows > max_rows or size > max_bytes:
            return cut
        cut = 1 << level["level"]
    return cut


class _Pieces:
    """The pre-tokens of some texts, each of which begins with a space, as places in their bytes."""

    def __init__(self, rows: pa.RecordBatch):
        data, bounds = batch_bytes(rows.column("text"))
        self.data, bounds = data[bounds[0] : bounds[-1]], bounds - bounds[0]
        begins = self.data == 32
        begins[1:] &= self.data[:-1] != 32
        begins[bounds[:-1]] = True
        self.start = np.flatnonzero(begins)
        self.end = np.append(self.start[1:], len(self.data))
        self.text = np.repeat(np.arange(len(bounds) - 1), np.diff(np.searchsorted(self.start, bounds)))
        self.key = substring_hashes(self.data)(self.start, self.end)

    def strings(self, at: np.ndarray) -> pa.Array:
        return string_array(self.data, self.start[at], self.end[at])


def _pre_tokens(texts: DataFrame) -> DataFrame:
    """(piece, freq) by task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally(1)
        rows_of = lambda b: pa.RecordBatch.from_arrays([b.column("string"), b.column("n0")], ["piece", "freq"])
        for rows in slices(batches):
            p = _Pieces(rows)
            ones = np.ones((1, len(p.start)), np.int64)
            yield from map(rows_of, tally.add(p.key, np.zeros(len(p.start), np.int32), ones, p.data, p.start, p.end))
        yield rows_of(tally.take())

    return texts.select("text").mapInArrow(run, "piece string, freq long")


def _by_document(texts: DataFrame, model, head, repeated) -> DataFrame:
    """(row, doc_id, n_bytes, total, piece, freq): what is known of a row at once, and its pre-tokens still to be counted.

    Rows are numbered as they come, so the table has to be written before it is read twice. A
    row without a piece holds the tokens of the head and of the pre-tokens that occur nowhere
    else; the others hold no doc_id, n_bytes and total.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        processor = sentencepiece.SentencePieceProcessor(model_proto=model.value)
        keys, counts = head.value
        next_row = TaskContext.get().partitionId() << _ROW_BITS
        for rows in slices(batches):
            p = _Pieces(rows)
            at = np.minimum(np.searchsorted(keys, p.key), max(0, len(keys) - 1))
            known = keys[at] == p.key if len(keys) else np.zeros(len(p.key), bool)
            total = np.zeros(rows.num_rows, np.int64)
            np.add.at(total, p.text[known], counts[at[known]])
            single = np.flatnonzero(~known & ~repeated.value.has(p.key))
            np.add.at(total, p.text[single], _tokens(processor, p.strings(single).to_pylist()))
            rest = np.flatnonzero(~known & repeated.value.has(p.key))
            # once per document, the occurrences counted by their bytes
            other = one_of_equal(mixed(p.key[rest] + p.text[rest].astype(np.uint64)))
            same = same_bytes(p.data, p.start[rest], p.end[rest], other) & (p.text[rest] == p.text[rest][other])
            freq = np.bincount(np.where(same, other, np.arange(len(rest))), minlength=len(rest))
            shown = np.flatnonzero(freq)
            of = p.text[rest[shown]]
            number = pa.array(next_row + np.concatenate([np.arange(rows.num_rows), of]))
            next_row += rows.num_rows
            none = pa.nulls(len(of), pa.int64())
            columns = [pa.concat_arrays([c, none]) for c in (rows.column("doc_id"), rows.column("n_bytes"), pa.array(total))]
            pieces = pa.concat_arrays([pa.nulls(rows.num_rows, pa.string()), p.strings(rest[shown])])
            amounts = pa.concat_arrays([pa.nulls(rows.num_rows, pa.int64()), pa.array(freq[shown])])
            yield pa.RecordBatch.from_arrays([number, *columns, pieces, amounts], ["row", "doc_id", "n_bytes", "total", "piece", "freq"])

    return texts.mapInArrow(run, "row long, doc_id long, n_bytes long, total long, piece string, freq long")


def count_tokens(
    docs: DataFrame, model_path: str, limit: int = 4096, head_rows: int = 300_000, head_bytes: int = 16 << 20
) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_tokens and whether n_tokens exceeds ``limit``.

    Counts are those of the sentencepiece model on the whole text. A null text counts as
    empty: no bytes, no tokens. Each row is counted by itself, repeated rows too. Other
    columns are not read. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    ship(spark)
    text = text_of()
    texts = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.octet_length(text).cast("bigint").alias("n_bytes"),
        F.concat(F.lit(" "), F.translate(text, _MARK, " ")).alias("text"),
    )
    with open(model_path, "rb") as f:  # a fixed file of under a megabyte
        model = spark.sparkContext.broadcast(f.read())
    with temporary_tables(spark) as keep:
        counted = _pre_tokens(texts.filter(F.col("n_bytes") > 0)).groupBy("piece").agg(F.sum("freq").alias("freq"))
        common = materialise(counted.filter(F.col("freq") > 1), "pre-tokens")
        cut = _head(common, head_rows, head_bytes)
        known = keep(_with_counts(common, model), "counted-pre-tokens")
    head = _head_table(known.filter(F.col("freq") >= cut).select("piece", "n").toArrow())
    tail = known.filter(F.col("freq") < cut)
    keyed = _keys(tail)
    repeated = spark.sparkContext.broadcast(filter_of(keyed, tail.count()))
    found = _by_document(texts, model, spark.sparkContext.broadcast(head), repeated)
    found = materialise(found, "document-pre-tokens")
    joined = found.filter(F.col("piece").isNotNull()).select("row", "piece", "freq").join(tail.select("piece", "n"), "piece", "left")
    # the filter knows a few pre-tokens that occur only once: they keep their frequency until they are tokenised
    stray = F.when(F.col("n").isNull(), F.col("piece")).alias("stray")
    joined = joined.select("row", stray, (F.coalesce("n", F.lit(1)) * F.col("freq")).alias("total"))
    sums = materialise(joined.groupBy("row", "stray").agg(F.sum("total").alias("total")), "pre-token-sums")
    strays = sums.filter(F.col("stray").isNotNull()).select("row", F.col("stray").alias("piece"), F.col("total").alias("freq"))
    amounts = sums.filter(F.col("stray").isNull()).select("row", "total")
    amounts = amounts.unionByName(_with_counts(strays, model).select("row", (F.col("n") * F.col("freq")).alias("total")))
    of_row = ["doc_id", "n_bytes"]
    every = found.filter(F.col("piece").isNull()).select("row", *of_row, "total").unionByName(amounts, allowMissingColumns=True)
    summed = every.groupBy("row").agg(*[F.max(c).alias(c) for c in of_row], F.sum("total").alias("total"))
    tokens = F.when(F.col("n_bytes") == 0, 0).otherwise(F.col("total")).cast("bigint")
    counted = summed.select(*of_row, tokens.alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
