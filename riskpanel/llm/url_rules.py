"""URL filters: a sort-merge range join of reversed-host keys with nested rules.

A rule is a host and a path, such as ``example.org/es/``. It fits a URL whose host is
the rule's host or one of its subdomains and whose path starts with the rule's path.
A URL therefore has one key per trailing part of its host: the labels in reverse order,
a separator and the path. In byte order the keys that a rule fits form one interval,
and the intervals of rules are nested or apart.

Keys and interval ends are sorted together. The innermost open rule at any point is the
top of the sweep's stack; the entry below a rule is its parent, the longest other rule
whose key is a prefix. So the end of a rule re-opens its parent, and the rule at a key
is whatever the last end before it left open. Range partitions are swept side by side,
each starting from the last end before its first key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskpanel.llm.common import ascii_lower, packed
from riskpanel.session import materialise

_SEPARATOR = "\u0000"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; empty without ``://``."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _key(host: Column, path: Column, depth: Column) -> Column:
    """Sort key of the last ``depth`` labels of a host and a path."""
    labels = F.split(host, r"\.", -1)
    tail = F.reverse(F.slice(labels, F.size(labels) - depth + 1, depth))
    return F.encode(F.concat(F.concat_ws(".", tail), F.lit(_SEPARATOR), path), "UTF-8")


def _boundaries(rules: DataFrame) -> DataFrame:
    """Starts and ends of the rules' intervals with the rule that is open behind each."""
    host = ascii_lower(F.regexp_extract("rule", r"(?s)^([^/]*)", 1))
    path = F.regexp_extract("rule", r"(?s)^[^/]*(.*)", 1)
    keyed = rules.select(
        _key(host, path, F.size(F.split(host, r"\.", -1))).alias("key"),
        F.struct(
            F.char_length("rule").alias("width"), F.char_length(host).alias("host_width"), "rule", "verdict"
        ).alias("open"),
    )
    # of equal rules the blocking one counts ("block" sorts after "allow")
    keyed = keyed.groupBy("key").agg(F.max("open").alias("open"))
    prefixes = keyed.select(
        "key", F.explode(F.sequence(F.lit(1), F.greatest(F.octet_length("key") - 1, F.lit(1)))).alias("n")
    ).select("key", F.substring(F.col("key"), F.lit(1), F.col("n")).alias("prefix"))
    shorter = keyed.select(F.col("key").alias("prefix"), F.col("open").alias("parent"))
    parents = (
        prefixes.filter(F.col("key") != F.col("prefix"))
        .join(shorter, "prefix")
        .groupBy("key")
        .agg(F.max_by("parent", F.octet_length("prefix")).alias("parent"))
    )
    ends = keyed.join(parents, "key", "left").select(
        F.concat("key", F.unhex(F.lit("FF"))).alias("key"), F.col("parent").alias("open")
    )
    return keyed.unionByName(ends)


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", url: str = "url") -> DataFrame:
    """Every row of ``pages`` with ``host``, ``path``, the longest fitting ``rule`` and the ``verdict``.

    ``rules`` has columns ``rule`` (host and path) and ``verdict`` (``allow`` or ``block``).
    The longest rule wins, of equally long ones that with the longer host; a rule given
    twice blocks if either row blocks. Without a rule ``rule`` is null and the verdict is
    ``default``. A null or empty URL, or one without ``://``, has an empty host and path.
    Repeated rows are judged alike and all returned; an empty table gives an empty result.
    The caller's columns come in one struct column ``page``, so no name can clash.

    URLs are reduced to distinct (host, path) before the sweep, so a URL that holds a third
    of all rows is one key; the join back leaves skew to adaptive execution.
    """
    rules = rules.filter(F.col("rule").isNotNull()).select("rule", "verdict")
    located = pages.select(
        packed(pages).alias("page"), host_of(F.col(f"`{url}`")).alias("host"), path_of(F.col(f"`{url}`")).alias("path")
    )
    bounds = materialise(_boundaries(rules), "url-bounds")
    # host depths at which rules exist: no other key can be in an interval
    depths = rules.select(
        F.array_sort(F.collect_set(F.size(F.split(F.regexp_extract("rule", r"(?s)^([^/]*)", 1), r"\.", -1)))).alias("d")
    ).first()["d"]
    keys = materialise(
        located.groupBy("host", "path")
        .count()
        .withColumn("depth", F.explode(F.array(*[F.lit(d) for d in depths]).cast("array<int>")))
        .filter(F.col("depth") <= F.size(F.split("host", r"\.", -1)))
        .select("host", "path", _key(F.col("host"), F.col("path"), F.col("depth")).alias("key")),
        "url-keys",
    )
    swept = _sweep(keys.select("key").distinct(), bounds)
    verdicts = materialise(
        keys.join(swept, "key").groupBy("host", "path").agg(F.max("open").alias("open")), "url-verdicts"
    )
    return located.join(verdicts, ["host", "path"], "left").select(
        "page",
        "host",
        "path",
        F.col("open.rule").alias("rule"),
        F.coalesce("open.verdict", F.lit(default)).alias("verdict"),
    )


def _sweep(keys: DataFrame, bounds: DataFrame) -> DataFrame:
    """The rule open at each key; keys outside every rule are left out."""
    rows = keys.select("key", F.lit(None).cast("boolean").alias("is_bound"), F.lit(None).cast(bounds.schema["open"].dataType).alias("open"))
    rows = rows.unionByName(bounds.select("key", F.lit(True).alias("is_bound"), "open"))
    ranged = materialise(rows.repartitionByRange("key").withColumn("part", F.spark_partition_id()), "url-sweep")
    mark = F.when(F.col("is_bound"), F.struct(F.col("key"), F.col("open")))
    # one row per partition: the last interval end of all earlier ones
    carried = (
        ranged.groupBy("part")
        .agg(F.max_by(mark, F.when(F.col("is_bound"), F.col("key"))).alias("last"))
        .withColumn("carry", F.last("last", True).over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)))
        .select("part", "carry")
    )
    # at one key the interval's start comes first
    order = Window.partitionBy("part").orderBy("key", F.col("is_bound").desc_nulls_last())
    return (
        ranged.withColumn("seen", F.last(mark, True).over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .filter(F.col("is_bound").isNull())
        .join(carried, "part", "left")
        .select("key", F.coalesce("seen", "carry").getField("open").alias("open"))
        .filter(F.col("open").isNotNull())
    )
