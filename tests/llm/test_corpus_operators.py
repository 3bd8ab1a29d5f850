"""The corpus operators against brute force, and on nulls, empties, repeats and clashing columns."""

import base64
import hashlib
import re
import struct
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
import xxhash
from compare import compare, duck
from pyspark.sql import functions as F

from riskpanel.llm import (
    byte_bpe,
    decontaminate,
    line_dedup,
    near_dedup,
    queries,
    sharding,
    simhash,
    suffix_dedup,
    token_counts,
    topk,
    toxicity,
    url_rules,
)

SF = "/root/testdata/sf0.001"
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
MODEL = public_tokenizers.path("piece_bpe_32k.model")
ODD = "doc_id long, text string, row string, source string, h int, score string"


@pytest.fixture(scope="module")
def texts():
    return dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall())


@pytest.fixture()
def odd(spark):
    """Null ids, null and empty texts, a very long text, repeated rows and column names used inside."""
    long = "wort " * 30_000
    rows = [(1, None), (2, ""), (3, long), (3, long), (None, "a b c"), (4, " \n\n "), (5, "x<s>▁y\u0085é  z ")]
    return spark.createDataFrame([(i, t, "r", None, 1, "s") for i, t in rows], ODD)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql(spark, name):
    assert compare(spark, duck(SF), queries.QUERIES[name], queries.ORACLES[name], SF) == []


def test_top_k_ties_and_invalid_vectors(spark):
    nan = float("nan")
    rows = [(i, [0.5, 0.5]) for i in range(0, 120)] + [(200, None), (201, [nan, 1.0]), (202, [None, 1.0]), (None, [1.0, 1.0]), (300, [9.0])]
    df = spark.createDataFrame(rows + rows[:5], "vec_id long, embedding array<float>")
    df = df.select("*", F.lit(1).alias("row"), F.lit(2).alias("id"), F.lit("x").alias("score"), F.lit(3).alias("b"))
    got = topk.top_k(df, F.col("id") % 100 == 0, 3, chunk_rows=16, bins=4).collect()
    best = {q: sorted((r["rank"], r.vec_id) for r in got if r.query_id == q) for q in {r.query_id for r in got}}
    # a repeated row meets its other self, and each of the two has its own three
    twice = [(1, 300), (1, 300), (2, 0), (2, 0), (3, 1), (3, 1)]
    assert best == {0: twice, 100: [(1, 300), (2, 0), (3, 0)], 300: [(1, 0), (2, 0), (3, 1)]}
    assert topk.top_k(df.limit(0), F.col("id") % 100 == 0, 3).count() == 0


def test_top_k_of_unlike_vectors_under_one_id(spark):
    df = spark.createDataFrame([(0, [1.0]), (5, [2.0]), (5, [3.0])], "vec_id long, embedding array<double>")
    got = topk.top_k(df, F.col("id") == 0, 10, scale=1.0).collect()
    assert sorted((r["rank"], r.vec_id, r.score) for r in got) == [(1, 5, 3), (2, 5, 2)]


def test_top_k_refuses_scores_beyond_64_bits(spark):
    df = spark.createDataFrame([(0, [2.0**31]), (1, [2.0**31])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="beyond"):
        topk.top_k(df, F.col("id") == 0, 1, scale=1.0).collect()


def test_sharding(spark, odd, texts):
    rows = sharding.shard_documents(odd, 4).collect()
    assert len(rows) == 7 and {r.size for r in rows if r.doc_id in (1, 2)} == {1}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = sharding.shard_documents(docs, 8).collect()
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 8)
        assert (r.size, r.text_crc32) == (len(texts[r.doc_id].encode()) + 1, zlib.crc32(texts[r.doc_id].encode()))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    weighted = sharding.assign(spark.range(20_000), ["id"], [1.0, 3.0]).groupBy("shard").count().collect()
    assert abs({r.shard: r["count"] for r in weighted}[1] / 20_000 - 0.75) < 0.02


def test_slots_of_one_repeated_row(spark):
    same = spark.range(70_000).select(F.lit(7).alias("doc_id"), F.lit("t").alias("text"))
    slots = sharding.shard_documents(same, 3).agg(F.count_distinct("slot"), F.max("slot")).first()
    assert tuple(slots) == (70_000, 69_999)


def test_overlaps_tolerate_replaced_words(spark, odd):
    item = [f"w{i}" for i in range(25)]
    worn = [w if i % 6 else "other" for i, w in enumerate(item)]
    docs = [(1, "x y " + " ".join(item) + " z"), (2, "a " + " ".join(worn).upper()), (3, " ".join(item[:9])), (4, "short item"), (5, "a short item")]
    bench = spark.createDataFrame([(10, " ".join(item)), (11, "Short, item!"), (12, None), (None, "x"), (10, " ".join(item))], "item_id long, text string")
    df = spark.createDataFrame(docs, "doc_id long, text string").unionByName(odd.select("doc_id", "text").filter("doc_id is null or doc_id < 3 and text is null"))
    got = {(r.doc_id, r.item_id) for r in decontaminate.overlaps(df, bench).collect()}
    assert got == {(1, 10), (2, 10), (4, 11), (5, 11)}
    assert decontaminate.clean(odd, bench).count() == 7 and decontaminate.clean(odd, bench).columns == odd.columns
    assert decontaminate.overlaps(df, bench.limit(0)).count() == 0


def brute_overlaps(docs, items, similarity=0.8, stretch=20):
    """(doc, item, begin, agreeing words) of the best window, over all alignments."""
    out = set()
    for d, words in docs.items():
        for i, item in items.items():
            width, best = min(stretch, len(item)), None
            for shift in range(-len(item), len(words)):
                same = [0 <= j - shift < len(item) and w == item[j - shift] for j, w in enumerate(words)]
                for start in range(max(0, len(words) - width) + 1):
                    n = sum(same[start : start + width])
                    if n * 10 >= width * 10 * similarity - 1e-6 and (best is None or (-n, start) < best):
                        best = (-n, start)
            if best:
                out.add((d, i, best[1], -best[0]))
    return out


@pytest.mark.parametrize("n", [*range(1, 20)])
def test_overlaps_find_every_pattern_of_replaced_words(spark, n):
    """Every choice of floor(0.2 n) replaced words, inside a longer document and at its edges."""
    item = [f"w{i}" for i in range(n)]
    docs = {}
    for which in combinations(range(n), int(0.2 * n + 1e-9)):
        worn = [w if i not in which else "other" for i, w in enumerate(item)]
        for before, after in ((["x"] * 3, ["y"] * 5), ([], [])) if n < 15 else ((["x"] * 3, ["y"] * 5),):
            docs[len(docs)] = [*before, *worn, *after]
    rows = spark.createDataFrame([(i, " ".join(w)) for i, w in docs.items()], "doc_id long, text string")
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    assert {r.doc_id for r in decontaminate.overlaps(rows, bench).collect()} == set(docs)


def test_overlaps_by_hand(spark):
    """Items of 1 to 25 words, whole, cut and worn, in documents of a few words that repeat."""
    generator = np.random.default_rng(8)
    common = [f"c{i}" for i in range(6)]
    items = {n: [f"i{n}x{j}" if generator.random() < 0.7 else str(generator.choice(common)) for j in range(n)] for n in range(1, 26)}
    docs = {}
    for n, item in items.items():
        for k in range(8):
            low = int(generator.integers(0, 1 + n // 4)) if k % 2 else 0
            words = [w if generator.random() < 0.88 else "other" for w in item[low:]]
            docs[100 * n + k] = [*generator.choice(common, k % 4), *words, *generator.choice(common, (k * 3) % 7), *(item if k == 7 else [])]
    rows = spark.createDataFrame([(i, " ".join(map(str, w)), "r", 1) for i, w in docs.items()], "doc_id long, text string, item string, at int")
    bench = spark.createDataFrame([(i, " ".join(w), 1) for i, w in items.items()], "item_id long, text string, seed int")
    want = brute_overlaps(docs, items)
    assert len(want) > 100
    assert {tuple(r) for r in decontaminate.overlaps(rows, bench).collect()} == want


def test_overlaps_look_at_all_rows_of_one_id(spark):
    item = [f"w{i}" for i in range(20)]
    rows = [(1, "a b c"), (1, " ".join(item)), (2, " ".join(item[:9] + ["z"] + item[9:]))]
    bench = spark.createDataFrame([(10, " ".join(item))], "item_id long, text string")
    got = decontaminate.overlaps(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()
    assert {tuple(r) for r in got} == {(1, 10, 0, 20)}


def test_byte_bpe_equals_merges(spark, odd, texts):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    whole = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    coder = byte_bpe.ByteBpe(byte_bpe.load_ranks(RANKS), public_tokenizers.PATTERN)
    generator = np.random.default_rng(1)
    made = ["".join(map(chr, generator.choice(list(b"aabbe ") + [233, 8364, 128512], 200))) for _ in range(40)]
    for text in [*texts.values(), *made, "a" * 5000, "", " \n\t "]:
        packed = coder.encode_packed(text)
        assert list(struct.unpack(f"<{len(packed) // 4}I", packed)) == whole.encode_ordinary(text)
        assert coder.decode_packed(packed).decode() == text
    rows = byte_bpe.encode(odd, RANKS, public_tokenizers.PATTERN).collect()
    assert [r.decoded for r in rows] == [r.text or "" for r in odd.collect()]


def brute_repeats(rows):
    counts = Counter(b[i : i + 200] for _, b in rows for i in range(len(b) - 199))
    out = []
    for doc, b in rows:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - 199):
            if counts[b[i : i + 200]] > 1:
                gone[i : i + 200] = True
        kept = bytes(x for x, y in zip(b, gone, strict=True) if not y)
        out.append((doc, len(b), int(gone.sum()), int((np.diff(np.pad(gone, 1).astype(int)) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def test_suffix_dedup(spark, texts):
    passage = next(t for t in texts.values() if len(t) > 900)[:450]
    rows = [*list(texts.items())[:60], (900, None), (901, ""), (902, "é" * 300), (903, "q" + passage + "r"), (904, "s" + passage), (904, "s" + passage)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_repeats([(i, (t or "").encode()) for i, t in rows])
    got = suffix_dedup.remove_repeats(df, with_bytes=False).collect()
    assert sorted((tuple(r) for r in got), key=repr) == want
    spans = defaultdict(set)
    keys = {r.k: r.own for r in suffix_dedup._keyed(df).collect()}
    for r in suffix_dedup.repeated_starts(df, crowd=1, suffixes_per_range=20).collect():
        spans[keys[r.k]].add((r.low, r.high))
    sizes = {w[0]: w[1:3] for w in want}
    assert all(sum(b - a for a, b in suffix_dedup.covered(n, list(spans[i]))) == removed for i, (n, removed) in sizes.items())


def test_suffix_dedup_without_filters(spark, texts, monkeypatch):
    """Beyond the filters' bound the joins alone decide, with the same rows."""
    rows = [(i, texts[i % 40]) for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(suffix_dedup, "_FILTERED_ROWS", 0)
    got = suffix_dedup.remove_repeats(df, with_bytes=False).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute_repeats([(i, t.encode()) for i, t in rows])


def test_suffix_dedup_of_odd_rows(spark, odd):
    """Null ids, a very long text twice, clashing names, and no rows."""
    want = brute_repeats([(r.doc_id, (r.text or "").encode()) for r in odd.collect() if r.doc_id != 3])
    named = odd.select("*", F.lit(1).alias("own"), F.lit("x").alias("k"), F.lit(2).alias("starts"))
    got = suffix_dedup.remove_repeats(named).collect()
    assert sorted((tuple(r)[:5] for r in got if r.doc_id != 3), key=repr) == want
    assert {(r.n_bytes, r.n_removed, r.n_spans) for r in got if r.doc_id == 3} == {(150_000, 150_000, 1)}
    assert suffix_dedup.remove_repeats(odd.limit(0)).count() == 0


def test_merge_of_front_coded_runs():
    generator = np.random.default_rng(2)
    runs, strings = [], []
    for _ in range(5):
        rows = np.sort(np.ascontiguousarray(generator.integers(97, 99, (40, 12), np.uint8)).view("S12").ravel())
        strings += rows.tolist()
        shared, rest = suffix_dedup.front_coded(rows.view(np.uint8).reshape(-1, 12))
        runs.append((rows, suffix_dedup._Run(shared, rest, 12)))
    order, shared = suffix_dedup.merge([r for _, r in runs])
    heads = [iter(rows.tolist()) for rows, _ in runs]
    merged = [next(heads[i]) for i in order]
    assert merged == sorted(strings)
    agree = lambda a, b: next((i for i, (x, y) in enumerate(zip(a, b, strict=True)) if x != y), 12)
    assert shared == [0, *(agree(a, b) for a, b in zip(merged, merged[1:], strict=False))]


def test_line_dedup_keeps_order_and_rows(spark, odd):
    rows = [(i, f"own {i}\nshared\n\nend {i}", f"s{i % 4}") for i in range(8)] + [(8, "shared", "s9"), (9, "twice\ntwice", "s1")]
    got = line_dedup.remove_boilerplate(spark.createDataFrame(rows, "doc_id long, text string, source string"), 4).collect()
    kept = {r.row.doc_id: (r.kept, r.n_removed) for r in got}
    assert kept[3] == ("own 3\n\nend 3", 1) and kept[8] == ("", 1) and kept[9] == ("twice\ntwice", 0)
    assert line_dedup.remove_boilerplate(odd, 2).count() == 7


def test_line_dedup_counts_all_sites_of_copied_texts(spark):
    rows = [(10 * i + j, f"own {i}\nshared\nend {i}", f"s{j}") for i in range(2) for j in range(4)] + [(90, "else\nlone", "s0")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = {r.row.doc_id: (r.kept, r.n_removed) for r in line_dedup.remove_boilerplate(docs, 4).collect()}
    assert kept == {i: ("else\nlone", 0) if i == 90 else (f"own {i // 10}\nend {i // 10}", 1) for i, _, _ in rows}


def test_line_dedup_query_counts_copies_over_sites(spark, tmp_path):
    """The registered query and its SQL on texts that are copied over many sites."""
    rows = [(20 * i + j, f"own {i}\nshared line\nend {i}", f"s{j}") for i in range(3) for j in range(12)]
    rows += [(200 + j, "lone text\nof many sites", f"s{j}") for j in range(15)] + [(300, None, None), (301, "", "s0"), (None, "shared line", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert compare(spark, con, queries.op6_line_dedup, queries.OP6_SQL, str(tmp_path)) == []
    removed = {r.doc_id: r.n_removed for r in queries.op6_line_dedup(spark, str(tmp_path)).collect()}
    assert sum(removed.values()) == 37 and removed[None] == 1 and removed[200] == 0


def test_token_counts(spark, odd, texts):
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").unionByName(odd.select("doc_id", "text"))
    want = sorted((len(t.encode()), len(model.encode(t))) for t in [*texts.values(), *(r.text or "" for r in odd.collect())])
    for head in (1, 300_000):
        assert sorted((r.n_bytes, r.n_tokens) for r in token_counts.count_tokens(docs, MODEL, head_rows=head).collect()) == want


def test_token_counts_join_pre_tokens_once(spark):
    """Repeated rows, equal ids and rows without id are rows of their own, and no join is left after the one by pre-token."""
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rows = [(i // 3, " ".join(f"wörd{(i * j) % 41} once{i}x{j}" for j in range(60))) for i in range(40)]
    rows += [(7, "wörd1 wörd1  wörd2")] * 3 + [(7, None), (None, "wörd1 wörd3"), (None, None), (8, ""), (8, " ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted((i if i is not None else -1, len((t or "").encode()), len(model.encode(t or ""))) for i, t in rows)
    for head in (1, 20, 300_000):
        got = token_counts.count_tokens(docs, MODEL, limit=100, head_rows=head)
        assert sorted((r.doc_id if r.doc_id is not None else -1, r.n_bytes, r.n_tokens) for r in got.collect()) == want
        assert all(r.over_limit == (r.n_tokens > 100) for r in got.collect())
        assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_url_parts_and_empty_rules(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://A.Example.ORG/es/x?y#z", "x://example.org?q", "x://org/", "x://borg/", "x://m.com/fr/a\nb", "x://com/de/"]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id long, url string, host string")
    rules = spark.createDataFrame(queries.URL_RULES, "rule string, verdict string")
    got = {r.page.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_rules.judge(pages, rules).collect()}
    assert got[0] == got[2] == ("", "", None, "allow") and got[4] == ("a.example.org", "/es/x", "example.org/es/", "block")
    assert got[5] == ("example.org", "", None, "allow") and got[6][2] == "org/" and got[7][2] is None
    assert got[8][1:3] == ("/fr/a\nb", "com/fr/") and got[9][3] == "block"


def test_chain_marginals_equal_enumeration():
    generator = np.random.default_rng(3)
    unary, moves, start = generator.normal(size=9), generator.normal(size=(2, 2)), generator.normal(size=2)
    lengths = np.array([4, 0, 5])
    p, _ = toxicity.marginals(unary, lengths, moves, start)
    at = 0
    for n in (4, 5):
        weight = np.zeros((n, 2))
        for code in range(1 << n):
            y = [code >> i & 1 for i in range(n)]
            w = np.exp(start[y[0]] + sum(unary[at + i] * y[i] for i in range(n)) + sum(moves[y[i], y[i + 1]] for i in range(n - 1)))
            for i in range(n):
                weight[i, y[i]] += w
        assert np.allclose(p[at : at + n], weight[:, 1] / weight.sum(axis=1))
        at += n


def test_toxicity_held_out(spark, odd):
    rows = duckdb.sql("SELECT doc_id, text, toxic FROM '/root/testdata/sf0.1/documents.parquet' JOIN '/root/testdata/sf0.1/labels.parquet' USING (doc_id)").fetchall()
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 3 == 1]
    known = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 3 != 1 and len(r[1]) < 3000]
    chain = toxicity.fit([r[1] for r in known], [r[2] for r in known], rounds=15)
    scores, spans = toxicity.tag(chain, toxicity._Unaries(chain), [r[1] for r in held])
    found, truth = scores >= 0.7, np.array([r[2] for r in held]) == 1
    assert found[truth].mean() > 0.85 and found[~truth].mean() < 0.01
    words = Counter(r[1].lower()[a:b] for r, s in zip(held, spans, strict=True) for a, b in s)
    assert words["idiot"] > 5
    got = toxicity.score(odd, chain).collect()
    assert len(got) == 7 and all(0 <= r.score <= 1 for r in got)
    empty = toxicity.train(odd, spark.createDataFrame([(1, None)], "doc_id long, toxic int"))
    assert toxicity.score(odd, empty).count() == 7


def brute_print(text, n=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    runs = [" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_components(spark, odd, texts):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").unionByName(odd.select("doc_id", "text").filter("doc_id < 3").withColumn("doc_id", F.col("doc_id") + 5000))
    prints = {i: brute_print(t) for i, t in [*texts.items(), (5001, ""), (5002, "")]}
    root = {i: i for i in prints}
    changed = True
    while changed:
        changed = False
        for a in prints:
            for b in prints:
                if (prints[a] ^ prints[b]).bit_count() <= 2 and root[a] != root[b]:
                    root[a] = root[b] = min(root[a], root[b])
                    changed = True
    got = simhash.near_duplicates(docs).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {i: (f"{prints[i]:016x}", root[i]) for i in prints}


def test_crowded_bit_groups_lose_no_link(spark):
    generator = np.random.default_rng(4)
    values = [int(x) ^ (1 << int(b)) for x in generator.integers(0, 1 << 62, 30) for b in generator.integers(0, 62, 6)]
    df = spark.createDataFrame([(v,) for v in set(values)], "fp long")
    linked = [{tuple(sorted(r)) for r in simhash.links(df, hot).collect()} for hot in (1, 10_000)]
    full = {(a, b) for a in set(values) for b in set(values) if a < b and (a ^ b).bit_count() <= 2}
    assert linked[1] == full and linked[0] <= full

    def parts(edges):
        root = {v: v for v in values}
        for _ in values:
            moved = False
            for a, b in edges:
                if root[a] != root[b]:
                    root[a] = root[b] = min(root[a], root[b])
                    moved = True
            if not moved:
                return root

    assert parts(linked[0]) == parts(full)


def test_crowded_bit_groups_are_probed_once(spark):
    """Whether a value is crowded or not, every fingerprint is turned into its probes once only."""
    generator = np.random.default_rng(5)
    df = spark.createDataFrame([(int(x),) for x in {int(y) for y in generator.integers(0, 1 << 12, 400)}], "fp long")
    probed = [simhash.links(df, hot)._jdf.queryExecution().optimizedPlan().toString().count("inline(concat(transform") for hot in (1, 10_000)]
    assert probed == [1, 1]


def test_a_task_holds_few_of_the_fingerprints_that_become_several_rows(spark, monkeypatch):
    rng = np.random.default_rng(21)
    values = np.unique(np.concatenate([(x := rng.integers(0, 1 << 63, 900)), x[:100] ^ (1 << 40), x[:50] ^ 5])).tolist()
    df = spark.createDataFrame([(v,) for v in values], "fp long").coalesce(1)
    near = {(a, b) for a in values for b in values if a < b and (a ^ b).bit_count() <= 2}
    counted = []
    grouped = type(df).groupBy
    monkeypatch.setattr(simhash, "_PRINTS_AT_ONCE", 100, raising=False)
    monkeypatch.setattr(type(df), "groupBy", lambda self, *c: (counted.append(self), grouped(self, *c))[1])
    found = {tuple(sorted(r)) for r in simhash.links(df, 10_000).collect()}
    monkeypatch.undo()
    assert found == near and len(near) >= 150
    sizes = [x.rdd.glom().map(len).collect() for x in counted if x.columns in (["s"], ["k", "v"], ["fp", "part", "key"])]
    assert len(sizes) == 2 and all(max(x) < len(values) * 5 / 4 for x in sizes)


def test_no_stage_has_two_python_steps_for_texts(spark):
    """Texts are chosen and compressed in one step, and compared behind a shuffle, however few they are."""
    import zstandard

    texts = spark.createDataFrame([(i, 10 * i, f"a b c d e f {i % 2} g") for i in range(40)], "fp long, h long, text string")
    ids = texts.filter("fp in (3, 5, 6)").select("fp")
    packed = near_dedup._compressed(texts, ids, 3)
    got = {r.h: zstandard.ZstdDecompressor().decompress(r.packed).decode() for r in packed.collect()}
    assert {30, 50, 60} <= set(got) and len(got) < 10 and all(got[10 * i] == f"a b c d e f {i % 2} g" for i in (3, 5, 6))
    assert packed._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    close = near_dedup._close(spark.createDataFrame([(30, 50), (50, 60)], "h long, own_h long"), packed, 5, 0.8)
    assert [tuple(r) for r in close.collect()] == [(30, 50)]
    plan = close._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_runs_of_one_text_are_no_members(spark):
    """Runs that stand in no other row are left out, before anything is joined."""
    rows = [(i, [5, 1000 + i, -7 - i, 6 + i % 2]) for i in range(50)] + [(90, []), (91, [77]), (91, [77])]
    got = {(r.h, r["class"], r.pos) for r in near_dedup._rare_members(spark.createDataFrame(rows, "h long, rare array<long>")).collect()}
    want = {(h, x, i) for h, rare in rows for i, x in enumerate(rare) if x in (5, 6, 7, 77)}
    assert want <= got and len(got) < len(want) + 20


def test_only_texts_of_pairs_are_compared(spark):
    rows = [(i, bytes([i % 256]) * 3) for i in range(-300, 300)]
    texts = spark.createDataFrame(rows, "h long, packed binary").withColumn("h", F.xxhash64("h"))
    pairs = texts.limit(20).select("h", F.lit(5).cast("long").alias("own_h"))
    ids = pairs.select(F.explode(F.array("h", "own_h")).alias("fp"))
    left = near_dedup._known(ids, 40, ["h", "packed"])(texts.withColumn("fp", F.col("h"))).collect()
    assert {r.h for r in pairs.collect()} <= {r.h for r in left} and len(left) < 40


def test_near_dedup_keeps_one(spark, texts):
    base = next(t for t in texts.values() if 200 < len(t.split()) < 400).split()
    copies = [(i, " ".join(w if j % 100 != i else "changed" for j, w in enumerate(base))) for i in range(20, 40)]
    rows = [(10, " ".join(base)), (50, " ".join(base)), (60, None), (61, ""), (70, "quite another text"), (None, "x"), *copies]
    df = spark.createDataFrame([(i, t, "r") for i, t in rows], "doc_id long, text string, row string")
    assert sorted(r.doc_id or 0 for r in near_dedup.keep_one(df).collect()) == [0, 10, 60, 70]


def brute_groups(rows, similarity=0.8):
    runs = {i: near_dedup.word_runs(t.encode(), 5) for i, t in rows}
    root = {i: i for i in runs}
    for a in runs:
        for b in runs:
            if a < b and root[a] != root[b] and near_dedup.similarity_of(runs[a], runs[b]) >= similarity:
                low, high = sorted((root[a], root[b]))
                root = {i: low if r == high else r for i, r in root.items()}
    return root


def test_near_dedup_of_copies_without_their_original(spark):
    generator = np.random.default_rng(6)
    base = [f"w{x}" for x in generator.integers(0, 10**6, 400)]
    rows = []
    for i in range(120):
        words = list(base)
        for j in generator.choice(400, 5, replace=False):
            words[j] = f"new{generator.integers(0, 10**6)}"
        rows.append((i, " ".join(words)))
    want = brute_groups(rows)
    assert len(set(want.values())) < 20
    got = near_dedup.duplicate_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {i: r for i, r in want.items() if list(want.values()).count(r) > 1} == {r.doc_id: r.group_id for r in got}


def test_near_dedup_of_short_texts(spark):
    generator = np.random.default_rng(7)
    rows = []
    for i in range(240):
        words = [f"w{x}" for x in generator.integers(0, 10**6, (14, 20, 30, 45, 60, 100)[i % 6])]
        worn = ["other", *words[1:]] if i % 4 < 2 else [*words[:-1], "other"]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(worn))]
    want = brute_groups(rows)
    assert all(want[i] == i - i % 2 for i, _ in rows)
    got = near_dedup.duplicate_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert want == {r.doc_id: r.group_id for r in got}


def test_pipeline_keeps_clean_documents(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = corpus_pipeline.run(spark, SF)
    assert 0.6 * docs.count() < out.count() < docs.count()
    assert out.filter("ids_sha256 is null").isEmpty()
