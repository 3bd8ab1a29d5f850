"""Sharding by rendezvous hashing, with gapless slots inside each shard.

Every shard gives a record a score from a hash of the record's key and the shard's
number; the highest score wins. A shard that is added can only win rows for itself, so
no row moves between the old ones. With score ``-weight / ln(u)`` a shard's share is in
proportion to its weight. The law kept is ``key``: the key and the shards decide, and
rows with equal texts but different keys may part. MD5 is used as the hash since every
engine has it, so other systems can find a record's shard.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskpanel.session import materialise

_BITS = 52  # a double holds as many exactly
_SLOT_BLOCK = 1 << 16


def key_text(*columns: str) -> Column:
    """One string per record key; a null differs from every value."""
    parts = [F.coalesce(F.concat(F.lit("="), F.col(f"`{c}`").cast("string")), F.lit("")) for c in columns]
    return F.concat_ws("\u001f", *parts)


def hash_bits(text: Column) -> Column:
    """The first 52 bits of a string's MD5."""
    return F.conv(F.substring(F.md5(text), 1, _BITS // 4), 16, 10).cast("bigint")


def shard_of(key: Column, weights: list[float]) -> Column:
    """Number of the winning shard; ties go to the smaller number."""
    def score(i: int, weight: float) -> Column:
        u = (hash_bits(F.concat(key, F.lit(f"/{i}"))).cast("double") + 0.5) / F.lit(float(1 << _BITS))
        return F.struct((F.lit(-float(weight)) / F.ln(u)).alias("score"), F.lit(-i).alias("minus"))

    scores = [score(i, w) for i, w in enumerate(weights) if w > 0]
    if not scores:
        raise ValueError("no shard has a positive weight")
    return (-F.array_max(F.array(*scores)).getField("minus")).cast("int")


def assign(df: DataFrame, key: list[str], weights: list[float]) -> DataFrame:
    """``df`` with its ``shard``; row by row, without a shuffle."""
    return df.withColumn("shard", shard_of(key_text(*key), weights))


def with_slots(rows: DataFrame, shard: str, key: list[str], rows_per_bucket: int = 1000) -> DataFrame:
    """``rows`` with ``slot``, counting from 0 without gaps inside each shard.

    Slots follow a hash of the key, then all columns. A shard is cut into ranges of that
    hash, so no task orders a whole shard; only the sizes of the ranges are summed along
    a shard. Equal rows are counted first and get consecutive slots, so a key that holds
    a third of all rows is one row until the last step. All columns must be orderable.
    """
    names = rows.columns
    inner = rows.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row")).withColumn(
        "h", hash_bits(F.concat(key_text(*[f"row`.`{c}" for c in key]), F.lit("/slot")))
    )
    inner = materialise(inner.withColumn("shard", F.col(f"row.`{shard}`")), "shard-rows")
    total = inner.count()
    bits = max(0, math.ceil(math.log2(max(1, total / rows_per_bucket))))
    counted = inner.groupBy("shard", "h", "row").agg(F.count("*").alias("copies"))
    bucketed = materialise(counted.withColumn("bucket", F.shiftright("h", _BITS - bits)), "shard-counts")
    sizes = bucketed.groupBy("shard", "bucket").agg(F.sum("copies").alias("size"), F.max("copies").alias("most"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("shard", "bucket", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("shard", "bucket").orderBy("h", "row").rowsBetween(Window.unboundedPreceding, -1)
    placed = bucketed.withColumn("ahead", F.coalesce(F.sum("copies").over(inside), F.lit(0))).join(
        offsets, ["shard", "bucket"]
    )
    blocks = placed.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("copies") - 1, F.lit(_SLOT_BLOCK))))
    if (bucketed.agg(F.max("copies")).first()[0] or 0) > _SLOT_BLOCK:
        blocks = blocks.repartition("shard", "h", "block")  # spread the copies of one row
    each = F.sequence(F.lit(0).cast("bigint"), F.least(F.lit(_SLOT_BLOCK), F.col("copies") - F.col("block")) - 1)
    return blocks.withColumn("i", F.explode(each)).select(
        "row.*", (F.col("offset") + F.col("ahead") + F.col("block") + F.col("i")).alias("slot")
    )


def shard_documents(docs: DataFrame, shards: int) -> DataFrame:
    """Shard, slot and sizes of every document, and its shard if there were one more.

    A null text has no bytes: size 1 and the CRC-32 of nothing, 0. A null ``doc_id`` is a
    key of its own. Repeated rows share a shard and take different slots; an empty table
    gives an empty result.
    """
    key = key_text("doc_id")
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.coalesce(F.crc32("text"), F.lit(0)).cast("bigint").alias("text_crc32"),
        F.lit("key").alias("law"),
        shard_of(key, [1.0] * shards).alias("shard"),
        shard_of(key, [1.0] * (shards + 1)).alias("grown_shard"),
    )
    return with_slots(rows, "shard", ["doc_id"]).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )
