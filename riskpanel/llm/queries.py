"""Registered corpus queries, one per operator, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskpanel.llm import (
    byte_bpe,
    decontaminate,
    divergence,
    language_id,
    line_dedup,
    phrases,
    sharding,
    simhash,
    suffix_dedup,
    token_counts,
    topk,
    toxicity,
    url_rules,
)
from riskpanel.llm.common import local_rows, table

# The rules, sizes and limits that the queries are defined with.
URL_RULES = [
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
]
SHARDS = 8
TOKEN_LIMIT = 4096
TOP_K = 10
QUERY_EVERY = 100
VECTOR_SCALE = 1024.0
SIMHASH_WORDS = 3
TOXIC_FROM = 0.7
BOILERPLATE_SITES = 10
TERM_DOCS = 30
TOP_TERMS = 50
PHRASE_WORDS = 4
PHRASE_LEAST = 30
PHRASE_SCALE = 2_000_000
PHRASE_INSIDE = 80
TOP_PHRASES = 2000


def op1_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, F.col("id") % QUERY_EVERY == 0, TOP_K, VECTOR_SCALE)


OP1_SQL = f"""WITH valid AS (SELECT vec_id, row_number() OVER () AS row_no, list_transform(embedding, lambda x: floor({VECTOR_SCALE} * x::DOUBLE)) AS v
        FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)),
    scored AS (SELECT q.row_no, q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
        FROM valid q JOIN valid c ON q.vec_id % {QUERY_EVERY} = 0 AND q.row_no <> c.row_no),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY row_no ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {TOP_K}"""


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"), SHARDS)


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = table(spark, sf_dir, "documents")
    return byte_bpe.encode(docs, ranks, public_tokenizers.PATTERN, digests_only=True)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), model, TOKEN_LIMIT)


def op8_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = local_rows(
        spark,
        {"rule": [r for r, _ in URL_RULES], "verdict": [v for _, v in URL_RULES]},
        {"rule": "string", "verdict": "string"},
    )
    judged = url_rules.judge(table(spark, sf_dir, "pages").select("page_id", "url"), rules)
    return judged.select("page.page_id", "host", "path", "rule", "verdict")


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), with_bytes=False)


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.remove_boilerplate(table(spark, sf_dir, "documents"), BOILERPLATE_SITES)
    return cleaned.select("row.doc_id", "n_lines", "n_removed", F.col("kept").alias("text"))


OP6_SQL = f"""WITH lines AS (SELECT DISTINCT coalesce(text, '') AS text, coalesce('=' || source, '') AS site,
        unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents),
    common AS (SELECT line FROM lines WHERE trim(line, ' ') <> '' GROUP BY line
        HAVING count(DISTINCT site) >= {BOILERPLATE_SITES} AND count(DISTINCT text) > 1),
    split AS (SELECT doc_id, row_no, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos
        FROM (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS row_no FROM documents))
    SELECT doc_id, count(*) AS n_lines, count(common.line) AS n_removed,
        coalesce(string_agg(split.line, chr(10) ORDER BY pos) FILTER (common.line IS NULL), '') AS text
    FROM split LEFT JOIN common ON split.line = common.line GROUP BY doc_id, row_no"""


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    chain = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, chain, TOXIC_FROM)
    held_out = F.coalesce(F.crc32(F.col("row.doc_id").cast("string")) % 3 == 1, F.lit(False))
    return scored.select("row.doc_id", held_out.alias("held_out"), "score", "predicted", "spans")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), SIMHASH_WORDS)


_RULE_ROWS = ", ".join(f"('{r.split('/', 1)[0]}', '/{r.split('/', 1)[1]}', '{v}')" for r, v in URL_RULES)
OP8_SQL = f"""WITH rules(rhost, rpath, verdict) AS (VALUES {_RULE_ROWS}),
    cut AS (SELECT page_id, url, row_number() OVER () AS row_no,
            CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
    parts AS (SELECT page_id, row_no, translate(regexp_extract(rest, '^[^/?#]*'),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
            regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
    fits AS (SELECT row_no, rhost || rpath AS rule, verdict, row_number() OVER (PARTITION BY row_no
            ORDER BY length(rhost || rpath) DESC, length(rhost) DESC, verdict DESC) AS nth
        FROM parts JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
    SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
    FROM parts LEFT JOIN (SELECT * FROM fits WHERE nth = 1) f USING (row_no)"""

_LOWERED = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"), TERM_DOCS, TOP_TERMS)


OP11_SQL = rf"""WITH docs AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text,
        row_number() OVER () AS row_no FROM documents),
    sources AS (SELECT DISTINCT lang, source FROM docs),
    words AS (SELECT lang, source, row_no,
        unnest(regexp_extract_all({_LOWERED.format("text")}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
    kept AS (SELECT lang, term, count(*) AS total FROM words GROUP BY 1, 2 HAVING count(DISTINCT row_no) >= {TERM_DOCS}),
    sizes AS (SELECT lang, count(*) AS v, sum(total) AS n FROM kept GROUP BY 1),
    counts AS (SELECT lang, source, term, count(*) AS c FROM words SEMI JOIN kept USING (lang, term) GROUP BY 1, 2, 3),
    totals AS (SELECT lang, source, sum(c) AS n FROM counts GROUP BY 1, 2),
    shares AS (SELECT lang, source, term, coalesce(c, 0) AS c,
            1 + 1000000000::HUGEINT * (coalesce(c, 0) + 5) // (coalesce(t.n, 0) + 5 * s.v) AS p,
            1 + 1000000000::HUGEINT * (total + 5) // (s.n + 5 * s.v) AS q
        FROM sources JOIN kept USING (lang) JOIN sizes s USING (lang)
        LEFT JOIN totals t USING (lang, source) LEFT JOIN counts USING (lang, source, term)),
    apart AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
        FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
    pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
        FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN apart d ON d.lang = a.lang AND d.source = a.source AND d.item = b.source),
    terms AS (SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM shares WHERE c > 0 AND p > q),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
        FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
    SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked
    WHERE part = 'pair' OR rank <= {TOP_TERMS}"""


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    profiles = language_id.train(docs.select("doc_id", "text", "lang"), ~held_out)
    found = language_id.identify(docs.select("doc_id", held_out.alias("held_out"), "text"), profiles)
    return found.select("row.doc_id", "row.held_out", "lang_pred", "score")


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return phrases.collocations(docs, PHRASE_WORDS, PHRASE_LEAST, PHRASE_SCALE, PHRASE_INSIDE, TOP_PHRASES)


_RUNS = " UNION ALL ".join(
    f"SELECT lang, {n} AS words, unnest(list_transform(range(1, len(w) - {n} + 2), lambda i: array_to_string(w[i:i + {n - 1}], ' '))) AS phrase FROM pieces"
    for n in range(1, PHRASE_WORDS + 1)
)
_CUTS = " UNION ALL ".join(
    f"SELECT lang, phrase, a, {k} AS cut, array_to_string(w[:{k}], ' ') AS head, array_to_string(w[{k + 1}:], ' ') AS rest FROM candidates WHERE words > {k}"
    for k in range(1, PHRASE_WORDS)
)
_INNER = " UNION ALL ".join(
    f"SELECT lang, a AS longer, array_to_string(w[{i}:{i + n - 1}], ' ') AS phrase FROM candidates WHERE words >= {max(n + 1, i + n - 1)}"
    for n in range(2, PHRASE_WORDS)
    for i in range(1, PHRASE_WORDS - n + 2)
)
OP13_SQL = rf"""WITH pieces AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda x: x <> '') AS w
        FROM (SELECT coalesce(lang, 'und') AS lang,
            unnest(regexp_split_to_array({_LOWERED.format("coalesce(text, '')")}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
    runs AS ({_RUNS}),
    totals AS (SELECT lang, count(*) AS n FROM runs WHERE words = 1 GROUP BY 1),
    often AS (SELECT lang, words, phrase, count(*) AS a FROM runs GROUP BY 1, 2, 3 HAVING count(*) >= {PHRASE_LEAST}),
    candidates AS (SELECT *, string_split(phrase, ' ') AS w FROM often WHERE words > 1),
    cuts AS ({_CUTS}),
    scored AS (SELECT c.lang, c.phrase, c.a, x.a AS l, y.a AS r, {PHRASE_SCALE}::HUGEINT * c.a // (x.a + y.a) AS score,
            row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY {PHRASE_SCALE}::HUGEINT * c.a // (x.a + y.a), cut) AS nth
        FROM cuts c JOIN often x ON x.lang = c.lang AND x.phrase = head JOIN often y ON y.lang = c.lang AND y.phrase = rest),
    inner_phrases AS (SELECT lang, phrase, max(longer) AS longer FROM ({_INNER}) GROUP BY 1, 2),
    kept AS (SELECT s.* FROM scored s LEFT JOIN inner_phrases i USING (lang, phrase)
        WHERE nth = 1 AND (longer IS NULL OR 100::HUGEINT * longer < {PHRASE_INSIDE}::HUGEINT * s.a)),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
    SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN totals USING (lang) WHERE rank <= {TOP_PHRASES}"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_top_k": op1_top_k,
    "op2_sharding": op2_sharding,
    "op3_decontaminate": op3_decontaminate,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_line_dedup": op6_line_dedup,
    "op7_token_counts": op7_token_counts,
    "op8_url_rules": op8_url_rules,
    "op9_toxicity": op9_toxicity,
    "op10_simhash": op10_simhash,
    "op11_source_divergence": op11_source_divergence,
    "op12_language_id": op12_language_id,
    "op13_phrases": op13_phrases,
}

ORACLES: dict[str, str] = {"op1_top_k": OP1_SQL, "op6_line_dedup": OP6_SQL, "op8_url_rules": OP8_SQL, "op11_source_divergence": OP11_SQL, "op13_phrases": OP13_SQL}
