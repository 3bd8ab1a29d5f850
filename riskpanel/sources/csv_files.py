"""Monthly incident CSVs with drifting separators, encodings and headers.

The text is scanned once: its lines are written with their file, block and number, and all
else reads that table. One aggregate over it finds each file's header line, whether its bytes
are valid UTF-8 and, for each separator, whether a quoted field goes over a line's end. In
files where none does, every line is a record. In the others, each line either leaves a
reader that is inside or outside of quotes where it is, or not; running that through a block
and then through the blocks of a file tells which lines begin a record, and only the lines
of longer records are joined. So a file of any size is read by many tasks, and files are
never opened on the driver.
"""

from __future__ import annotations

import csv
import re
from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import fold, normalise
from ..operators import profile
from ..operators.cleaning import Scope
from ..session import materialise

# Separators in the order they are tried, the number of columns
# that makes one fit, and the header names known for each canonical column.
SEPARATORS = (";", ",", "|", "\t")
MIN_COLUMNS = 5
PROFILE_MIN_COLUMNS = 4
#: Lines of one record; more are taken for a quote that is never closed.
MAX_RECORD_LINES = 10_000
ALIASES = {
    "fecha": ["FECHA", "FECHA INCIDENTE", "FECHA_INCIDENTE"],
    "provincia": ["PROVINCIA", "NOMBRE PROVINCIA", "DPA PROVINCIA"],
    "canton": ["CANTON", "NOMBRE CANTON", "DPA CANTON", "CIUDAD"],
    "cod_parroquia": ["COD PARROQUIA", "COD_PARROQUIA", "CODIGO PARROQUIA", "DPA PARROQUIA", "COD PARR"],
    "parroquia": ["PARROQUIA", "NOMBRE PARROQUIA"],
    "servicio": ["SERVICIO", "TIPO", "CATEGORIA", "TIPO INCIDENTE", "TIPO DE INCIDENTE", "TIPO EMERGENCIA"],
    "subtipo": ["SUBTIPO", "SUB TIPO", "DETALLE", "SUBTIPO INCIDENTE"],
}
# Texts the usual CSV readers take for a missing value.
MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

CANONICAL = tuple(ALIASES)
_CORRUPT = "_corrupt_record"


@dataclass(frozen=True)
class Dialect:
    separator: str
    encoding: str
    header: tuple[str, ...]
    multi_line: bool = False


@dataclass(frozen=True)
class Listing:
    """Files by dialect, the files no separator fits, and the lines of all of them."""

    readable: dict[Dialect, list[str]]
    unreadable: list[str]
    lines: DataFrame  # value, path, archivo, block_start, line
    headers: dict[str, int]  # number of each file's header line


def _lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    reader = spark.read.option("pathGlobFilter", "*.csv").option("recursiveFileLookup", "true")
    # a block is read in order within one partition, so its lines are numbered in order
    lines = reader.text(list(paths)).select(
        "value",
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_name").alias("archivo"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("line"),
    )
    return materialise(lines, "csv-lines")


def _patterns(separator: str) -> tuple[str, str]:
    """Lines that end inside quotes, for a reader that begins outside of them, and for one that begins inside."""
    sep = re.escape(separator)
    quoted, plain = r'"(?:[^"]++|"")*+"', rf"(?!\")[^{sep}]*+"
    # whole fields, what stands behind a closing quote being part of its field, then one left open
    rest = rf'(?:(?:{quoted}[^{sep}]*+|{plain}){sep})*+"(?:[^"]++|"")*+$'
    return f"^{rest}", rf'^(?:[^"]++|"")*+(?:$|"[^{sep}]*+{sep}{rest})'


def _header_fields(line: str, min_columns: int) -> tuple[str, tuple[str, ...]] | None:
    """The first separator that splits the header into enough fields."""
    for separator in SEPARATORS:
        fields = next(csv.reader([line], delimiter=separator))
        if len(fields) >= min_columns:
            return separator, tuple(fields)
    return None


def list_files(spark: SparkSession, paths: str | Sequence[str], min_columns: int = MIN_COLUMNS) -> Listing:
    """Every ``*.csv`` below the paths with its dialect (one result row per file)."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    lines = _lines(spark, paths)
    first = (F.col("block_start") == 0) & (F.length(F.trim("value")) > 0)
    has_quote = F.contains("value", F.lit('"'))
    # Fixed-width aggregates keep the pass over all lines a hash aggregate; the header
    # texts are then fetched by line number. One row per file is broadcast.
    files = materialise(
        lines.groupBy("path").agg(
            F.min(F.when(first, F.col("line"))).alias("line"),
            F.bool_and(F.is_valid_utf8("value")).alias("utf8"),
            *[
                F.bool_or(F.when(has_quote, F.rlike("value", F.lit(_patterns(s)[0]))).otherwise(False)).alias(f"open_{i}")
                for i, s in enumerate(SEPARATORS)
            ],
        ),
        "files",
    )
    headers = lines.join(F.broadcast(files.select("path", "line")), ["path", "line"]).select("path", "line", "value")
    as_latin = F.decode(F.col("value").cast("binary"), "ISO-8859-1")
    rows = files.join(headers, ["path", "line"], "left").withColumn("header", F.when(F.col("utf8"), F.col("value")).otherwise(as_latin))
    readable: dict[Dialect, list[str]] = defaultdict(list)
    unreadable, header_lines = [], {}
    found = rows.drop("value").orderBy("path").collect()
    if not found:
        raise FileNotFoundError(f"no CSV files below {paths}")
    for row in found:
        fitted = _header_fields((row["header"] or "").removeprefix("\ufeff"), min_columns)
        if fitted is None:
            unreadable.append(row["path"])
            continue
        encoding = "UTF-8" if row["utf8"] else "ISO-8859-1"
        several = row[f"open_{SEPARATORS.index(fitted[0])}"]
        readable[Dialect(fitted[0], encoding, fitted[1], several)].append(row["path"])
        header_lines[row["path"]] = row["line"]
    return Listing(dict(readable), unreadable, lines, header_lines)


def _states(lines: DataFrame, separator: str) -> DataFrame:
    """Lines with ``inside``, whether they begin within quotes, and ``opens``, whether they end there.

    A line keeps, swaps or sets the reader's state. The state before a line is what was set last,
    swapped as often as lines have swapped it since; it is first followed within each block
    from its beginning, then from block to block of a file.
    """
    outside, inside = (
        F.when(F.contains("value", F.lit('"')), F.rlike("value", F.lit(p))).otherwise(F.lit(bool(i))).cast("int")
        for i, p in enumerate(_patterns(separator))
    )
    rows = lines.withColumns({"from_out": outside, "from_in": inside})
    swap = (F.col("from_out") == 1) & (F.col("from_in") == 0)
    order = Window.partitionBy("path", "block_start").orderBy("line")
    upto, before = (order.rowsBetween(Window.unboundedPreceding, end) for end in (0, -1))
    swaps = lambda w: F.coalesce(F.sum(swap.cast("int")).over(w), F.lit(0)) % 2
    rows = rows.withColumn("swapped", swaps(upto))
    rows = rows.withColumn("fixed", F.when(F.col("from_out") == F.col("from_in"), F.col("from_out").bitwiseXOR(F.col("swapped"))))
    rows = rows.withColumns({"last_fixed": F.last("fixed", True).over(before), "swapped_before": swaps(before)})
    # what a whole block does, and the state in which each block begins
    blocks = rows.groupBy("path", "block_start").agg(
        F.max_by("swapped", "line").alias("swapped"), F.max_by(F.coalesce("fixed", "last_fixed"), "line").alias("fixed")
    )
    by_file = Window.partitionBy("path").orderBy("block_start")  # one row per block
    done, earlier = (by_file.rowsBetween(Window.unboundedPreceding, end) for end in (0, -1))
    blocks = blocks.withColumn("total", F.sum("swapped").over(done) % 2)
    # the state set by a block, with the swaps before it taken out
    blocks = blocks.withColumn("fixed", F.col("fixed").bitwiseXOR(((F.col("total") + F.col("swapped")) % 2).cast("int")))
    swapped_so_far = F.coalesce(F.sum("swapped").over(earlier), F.lit(0)) % 2
    start = F.coalesce(F.last("fixed", True).over(earlier), F.lit(0)).bitwiseXOR(swapped_so_far.cast("int"))
    blocks = blocks.select("path", "block_start", start.alias("start"))
    rows = rows.join(blocks, ["path", "block_start"])
    state = F.coalesce("last_fixed", "start").bitwiseXOR(F.col("swapped_before").cast("int"))
    rows = rows.withColumn("inside", state == 1)
    opens = F.when(F.col("inside"), F.col("from_in")).otherwise(F.col("from_out")) == 1
    return rows.select(*lines.columns, "inside", opens.alias("opens"))


def _records(lines: DataFrame, separator: str, max_lines: int) -> DataFrame:
    """Lines joined to records where a quoted field goes over several of them.

    A quote that is never closed would join the rest of its file: a record of more than
    ``max_lines`` lines is taken for that, and its lines stand for themselves.
    """
    states = materialise(_states(lines, separator), "csv-states")
    single = states.filter(~F.col("inside") & ~F.col("opens")).select(*lines.columns)
    several = states.filter(F.col("inside") | F.col("opens"))
    begins = F.when(~F.col("inside"), F.col("line"))
    in_block = Window.partitionBy("path", "block_start").orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    several = several.withColumn("record", F.last(begins, True).over(in_block))
    blocks = several.groupBy("path", "block_start").agg(F.max_by("record", "line").alias("last_record"))
    earlier = Window.partitionBy("path").orderBy("block_start").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("path", "block_start", F.last("last_record", True).over(earlier).alias("carried"))
    several = several.join(blocks, ["path", "block_start"]).withColumn("record", F.coalesce("record", "carried", "line"))
    sizes = several.groupBy("record").agg(F.count("*").alias("size"))
    several = several.join(sizes, "record")
    whole = several.filter(F.col("size") <= max_lines)
    parts = F.sort_array(F.collect_list(F.struct("block_start", "line", "value")))  # at most max_lines
    joined = whole.groupBy("path", "archivo", "record").agg(parts.alias("parts"))
    joined = joined.select(
        F.array_join(F.transform("parts", lambda p: p["value"]), "\n").alias("value"),
        "path",
        "archivo",
        F.col("parts")[0]["block_start"].alias("block_start"),
        F.col("record").alias("line"),
    )
    loose = several.filter(F.col("size") > max_lines).select(*lines.columns)
    return single.unionByName(joined).unionByName(loose)


def read_dialect(spark: SparkSession, listing: Listing, dialect: Dialect) -> DataFrame:
    """The files of one dialect as text columns ``c0, c1, ...`` plus ``archivo``.

    Lines with too many fields are dropped, short ones are padded with NULL.
    """
    return _dialect_rows(spark, listing, dialect).select(*[f"c{i}" for i in range(len(dialect.header))], "archivo")


def _dialect_rows(spark: SparkSession, listing: Listing, dialect: Dialect) -> DataFrame:
    """(c0, c1, ..., path, archivo)"""
    width = len(dialect.header)
    own = [(p, listing.headers[p]) for p in listing.readable[dialect]]
    files = spark.createDataFrame(own, "path string, header_line bigint")  # one row per file
    lines = listing.lines.join(F.broadcast(files), "path").filter(F.col("line") != F.col("header_line")).drop("header_line")
    if dialect.multi_line:
        lines = _records(lines, dialect.separator, MAX_RECORD_LINES)
    text = F.col("value") if dialect.encoding == "UTF-8" else F.decode(F.col("value").cast("binary"), dialect.encoding)
    fields = ", ".join(f"c{i} string" for i in range(width))
    options = {
        "sep": dialect.separator,
        "quote": '"',
        "escape": '"',
        "mode": "PERMISSIVE",
        "maxCharsPerColumn": "-1",
        "columnNameOfCorruptRecord": _CORRUPT,
    }
    parsed = F.from_csv(text, f"{fields}, {_CORRUPT} string", options)
    # a generator is evaluated once per line; as a plain column it would be parsed again for every use
    rows = lines.filter(F.length(F.trim("value")) > 0).select(F.inline(F.array(parsed)), "path", "archivo")
    unquoted = F.regexp_replace(_CORRUPT, r'"([^"]|"")*"', "")
    found = F.length(unquoted) - F.length(F.replace(unquoted, F.lit(dialect.separator), F.lit(""))) + 1
    return rows.filter(~F.coalesce(found > width, F.lit(False))).drop(_CORRUPT)


def resolve_columns(header: Sequence[str]) -> dict[str, int]:
    """Position of each canonical column in a header.

    An exact alias wins, in alias order; otherwise the first header that contains
    any alias is taken, even where another column already claimed it.
    """
    position = {fold(name): i for i, name in enumerate(header)}
    resolved = {}
    for canonical, aliases in ALIASES.items():
        exact = (position[a] for a in aliases if a in position)
        partial = (i for name, i in position.items() if any(a in name for a in aliases))
        found = next(exact, next(partial, None))
        if found is not None:
            resolved[canonical] = found
    return resolved


def _present(column: Column) -> Column:
    return F.when(~column.isin(*MISSING), column)


def _missing(dialect: Dialect, scope: Scope) -> list[str]:
    return sorted(scope.required_columns - set(resolve_columns(dialect.header)))


def read_incidents(spark: SparkSession, paths: str | Sequence[str], scope: Scope) -> DataFrame:
    """All usable files as one table of the seven canonical text columns and ``archivo``.

    Files without a required column are left out, see ``skipped_files``; absent optional
    columns are NULL.
    """
    listing = list_files(spark, paths)
    parts = []
    for dialect, files in listing.readable.items():
        if _missing(dialect, scope):
            continue
        resolved = resolve_columns(dialect.header)
        columns = [
            (_present(F.col(f"c{resolved[c]}")) if c in resolved else F.lit(None).cast("string")).alias(c)
            for c in CANONICAL
        ]
        parts.append(read_dialect(spark, listing, dialect).select(*columns, "archivo"))
    if not parts:
        raise ValueError("no file holds the required columns: profile the files and extend the aliases")
    return reduce(DataFrame.unionByName, parts)


def _file_name(path: str) -> str:
    return unquote(path.rsplit("/", 1)[1])


def skipped_files(spark: SparkSession, paths: str | Sequence[str], scope: Scope) -> DataFrame:
    """(archivo, reason, rows) of the files that ``read_incidents`` leaves out.

    ``rows`` counts the rows of a file that lacks required columns, as a reader sees them,
    and is NULL for a file that no separator fits. Without such files the result is empty.
    """
    listing = list_files(spark, paths)
    columns = "archivo string, reason string, rows bigint"
    unreadable = [(_file_name(p), f"no separator gives {MIN_COLUMNS} columns", None) for p in listing.unreadable]
    out = spark.createDataFrame(unreadable, columns)
    for dialect, files in listing.readable.items():
        missing = _missing(dialect, scope)
        if not missing:
            continue
        names = spark.createDataFrame([(_file_name(p),) for p in files], "archivo string")
        counts = read_dialect(spark, listing, dialect).groupBy("archivo").agg(F.count("*").alias("rows"))
        counted = names.join(counts, "archivo", "left").select(
            "archivo", F.lit("missing columns: " + ", ".join(missing)).alias("reason"), F.coalesce("rows", F.lit(0)).cast("bigint").alias("rows")
        )
        out = out.unionByName(counted)
    return out


def read_sample(spark: SparkSession, path: str, rows: int | None = None) -> tuple[DataFrame, Dialect] | None:
    """A file under its own header names, for profiling; only its first ``rows`` where given."""
    listing = list_files(spark, path, PROFILE_MIN_COLUMNS)
    if not listing.readable:
        return None
    if len(listing.readable) > 1:
        raise ValueError(f"{path} holds files of several dialects: profile them one by one")
    dialect = next(iter(listing.readable))
    table = read_dialect(spark, listing, dialect)
    table = table if rows is None else table.limit(rows)
    named = [_present(F.col(f"c{i}")).alias(name) for i, name in enumerate(dialect.header)]
    return table.select(*named), dialect


def folder_values(spark: SparkSession, paths: str | Sequence[str], source: Column | None = None) -> tuple[DataFrame, Listing]:
    """Every cell of every readable file, of however many dialects: (source, separator, encoding, column, value).

    ``source`` names where a row comes from, by its ``path`` and ``archivo``; the latter if not given.
    """
    listing = list_files(spark, paths, PROFILE_MIN_COLUMNS)
    if not listing.readable:
        raise ValueError(f"no file below {paths} can be read")
    name = F.col("archivo") if source is None else source
    parts = []
    for dialect, files in listing.readable.items():
        cells = [
            F.struct(F.lit(h).alias("column"), _present(F.col(f"c{i}")).alias("value")) for i, h in enumerate(dialect.header)
        ]
        rows = _dialect_rows(spark, listing, dialect).select(name.alias("source"), F.explode(F.array(*cells)).alias("cell"))
        parts.append(rows.select("source", F.lit(dialect.separator).alias("separator"), F.lit(dialect.encoding).alias("encoding"), "cell.*"))
    return reduce(DataFrame.unionByName, parts), listing


def profile_folder(spark: SparkSession, paths: str | Sequence[str], source: Column | None = None, sample_size: int = 3, top: int = 12) -> DataFrame:
    """What every column of every file holds, in one job over all dialects.

    (source, separator, encoding, column, rows, null_pct, distinct_values, sample, min, max,
    zero_pct, top): ``min``, ``max`` and ``zero_pct`` only for columns whose name looks like a
    coordinate, ``top`` (value, rows) only for those that look like a category or an area.
    """
    values, _ = folder_values(spark, paths, source)
    keys = ["source", "separator", "encoding", "column"]
    counts = materialise(profile.value_counts(values, keys), "value-counts")
    upper = normalise(F.col("column"))
    like = lambda words: reduce(lambda a, b: a | b, [F.contains(upper, F.lit(w)) for w in words])
    columns = profile.column_profile(counts, keys, sample_size)
    ranged = like(profile.COORDINATE_WORDS)
    columns = columns.withColumns({c: F.when(ranged, F.col(c)) for c in ("min", "max", "zero_pct")})
    named = counts.filter(like((*profile.CATEGORY_WORDS, *profile.AREA_WORDS)))
    most = profile.frequent_values(named, keys, top)
    most = most.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("nth", "value", "rows"))).alias("top"))  # at most top values
    listed = F.transform("top", lambda t: F.struct(t["value"].alias("value"), t["rows"].alias("rows")))
    return columns.join(most, keys, "left").withColumn("top", listed)
