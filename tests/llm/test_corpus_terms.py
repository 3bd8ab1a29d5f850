"""Source divergence, language identification and phrase mining against brute force and on odd inputs."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from riskpanel import session
from riskpanel.llm import byte_words, divergence, language_id, phrases, queries

SF = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, lang string, source string, n long, phrase string, term string, rank int, row string, fp long"
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def table(spark, rows):
    return spark.createDataFrame([(i, t, x, s, 1, "p", "t", 2, "r", 3) for i, t, x, s in rows], COLUMNS)


@pytest.fixture()
def odd_rows():
    """Null columns, empty and very long texts, repeated rows, ties, astral and combining characters."""
    rng = random.Random(7)
    words = ["Alpha", "beta", "été", "ÉTÉ", "x", "naïve", "𝔘nd", "o", "langeswortlangeswortlangeswort", "langeswortlangeswortlangeswart"]
    rows = [(i, " ".join(rng.choice(words) + rng.choice(["", "", ".", ",", "\t"]) for _ in range(30)), rng.choice(["a", "b", None]), rng.choice(["s", "t", None])) for i in range(60)]
    rows += [(100, None, "a", "s"), (101, "", "b", None), (None, "alpha beta alpha", None, "u"), (102, " \n\t.; ", "c", "s")]
    rows += [(103, "alpha beta " * 4000, "a", "s")] + [(104, "beta\tbeta  x\rx", "b", "t")] * 3
    return rows


def phrases_by_hand(rows, longest, least, scale=2_000_000, inside=80, top=2000):
    found, total = Counter(), Counter()
    for _, text, lang, _ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            w = [x for x in re.split(r"[ \t]+", piece) if x]
            total[lang] += len(w)
            found.update((lang, tuple(w[i : i + n])) for n in range(1, longest + 1) for i in range(len(w) - n + 1))
    candidates = {k: a for k, a in found.items() if a >= least and len(k[1]) > 1}
    longer, out = Counter(), defaultdict(list)
    for (lang, p), a in candidates.items():
        for part in {p[i : i + n] for n in range(2, len(p)) for i in range(len(p) - n + 1)}:
            longer[lang, part] = max(longer[lang, part], a)
    for (lang, p), a in candidates.items():
        if 100 * longer[lang, p] < inside * a:
            cuts = [(found[lang, p[:k]], found[lang, p[k:]]) for k in range(1, len(p))]
            score, _, (x, y) = min((scale * a // (x + y), k, (x, y)) for k, (x, y) in enumerate(cuts))
            out[lang].append((-score, -a, " ".join(p).encode(), x, y))
    return {
        (lang, rank, p.decode(), -a, x, y, total[lang], -s)
        for lang, each in out.items()
        for rank, (s, a, p, x, y) in enumerate(sorted(each)[:top], 1)
    }


@pytest.mark.parametrize(("longest", "least", "top"), [(4, 3, 2000), (5, 2, 7), (2, 30, 2000)])
def test_phrases_by_hand(spark, odd_rows, longest, least, top):
    got = phrases.collocations(table(spark, odd_rows), longest, least, top=top).collect()
    assert {tuple(r) for r in got} == phrases_by_hand(odd_rows, longest, least, top=top)
    assert len(got) == len({tuple(r) for r in got})


def test_phrases_do_not_cross_texts_or_breaks(spark):
    rows = [(i, "one two", "a", "s") for i in range(4)] + [(9, "two. one two\nthree", "a", "s")]
    got = {r.phrase: (r.a, r.l, r.r, r.n) for r in phrases.collocations(table(spark, rows), 3, 1).collect()}
    assert got == {"one two": (5, 5, 6, 12)}


def test_phrases_of_an_empty_table(spark, odd_rows):
    assert phrases.collocations(table(spark, odd_rows).limit(0)).count() == 0
    assert phrases.collocations(table(spark, [(1, None, None, None)])).count() == 0


def test_scores_beyond_64_bits(spark, monkeypatch):
    """Counts whose products pass 64 bits are still scored exactly."""
    n = 4 * 10**13
    rows = [("a", 0, "", 3 * n), ("a", 1, "x", n + 1), ("a", 1, "y", n + 2), ("a", 2, "x y", n), ("a", 3, "x y x", n // 5 * 4 - 1)]
    known = spark.createDataFrame(rows, "lang string, words int, phrase string, n long")
    known = known.unionByName(spark.createDataFrame([("a", 2, "y x", n)], known.schema))
    monkeypatch.setattr(phrases, "frequent_phrases", lambda *_: known)
    got = {r.phrase: r.score for r in phrases.collocations(known).collect()}
    assert got["x y"] == 2_000_000 * n // (2 * n + 3) and set(got) == {"x y", "y x", "x y x"}


def test_colliding_fingerprints_change_nothing(spark, odd_rows, monkeypatch):
    """All counts come from the text: with hashes of three bits the phrases are the same."""
    texts = [r[1] or "" for r in odd_rows[:60]]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    real = byte_words.mixed
    monkeypatch.setattr(byte_words, "mixed", lambda x: real(x) & np.uint64(7))
    (_, words), *_ = byte_words.chunks([batch], phrases._WORDS)
    spelled = [bytes(words.data[s:e]) for s, e in zip(words.start, words.end, strict=True)]
    number = words.identities()
    assert len(set(number.tolist())) >= len(set(spelled))
    assert all(spelled[i] == spelled[j] for i in range(len(spelled)) for j in np.flatnonzero(number == number[i]))
    tally = byte_words.Tally(1, most=50)
    key = words.hashes(words.start, words.end)
    rows = []
    for i in range(0, len(key), 37):
        part = slice(i, i + 37)
        ones = np.ones((1, len(key[part])), np.int64)
        rows += list(tally.add(key[part], np.zeros(len(key[part]), np.int64), ones, words.data, words.start[part], words.end[part]))
    counted = Counter()
    for b in [*rows, tally.take()]:
        for word, n in zip(b.column("string").to_pylist(), b.column("n0").to_pylist(), strict=True):
            counted[word.encode()] += n
    assert counted == Counter(spelled)


@pytest.mark.parametrize("bits", [3, 64])
def test_phrases_are_spelled_once_whatever_collides(spark, odd_rows, bits, monkeypatch):
    """Every frequent phrase is one row of one task, and fingerprints of three bits give the same phrases."""
    written = {}

    def materialise(df, label="table"):
        written[label] = session.materialise(df, label)
        return written[label]

    monkeypatch.setattr(phrases, "materialise", materialise)
    docs = table(spark, odd_rows * 8).repartition(8)
    got = {tuple(r) for r in phrases.frequent_phrases(docs, 4, 3, bits=bits).collect()}
    counts, total = Counter(), Counter()
    for _, text, lang, _ in odd_rows:
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            w = [x for x in re.split(r"[ \t]+", piece) if x]
            total[lang or "und"] += 8 * len(w)
            for size in range(1, 5):
                for i in range(len(w) - size + 1):
                    counts[lang or "und", size, " ".join(w[i : i + size])] += 8
    assert got == {(*k, n) for k, n in counts.items()} | {(x, 0, "", n) for x, n in total.items()}
    rows = written["spelled-phrases"].filter("words > 0").count()
    if bits == 64:
        assert len(counts) <= rows < 2 * len(counts) and "missing-phrases" not in written


def test_phrases_of_rows_dealt_anew(spark, odd_rows, monkeypatch):
    """An owner that reads other rows the second time lacks its phrases: the tasks that hold them spell them out."""
    written = []
    monkeypatch.setattr(phrases, "materialise", lambda df, label="table": (written.append(label), session.materialise(df, label))[1])
    anywhere = F.udf(lambda: random.SystemRandom().random(), "double").asNondeterministic()
    moved = table(spark, odd_rows).withColumn("r", anywhere()).repartition(8, "r")
    assert {tuple(r) for r in phrases.collocations(moved, 4, 3).collect()} == phrases_by_hand(odd_rows, 4, 3)
    assert "missing-phrases" in written


def audit_by_hand(rows, least, top):
    docs, count, groups = Counter(), Counter(), set()
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = [t.translate(LOWER) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        docs.update((lang, t) for t in set(terms))
        for t in terms:
            count[lang, source, t] += 1
            count[lang, None, t] += 1
    out = set()
    for lang in {x for x, _ in groups}:
        kept = [t for (x, t), n in docs.items() if x == lang and n >= least]
        sources = [s for x, s in groups if x == lang]
        share = {}
        for s in [None, *sources]:
            total = sum(count[lang, s, t] for t in kept) + 5 * len(kept)
            share[s] = {t: 1 + 10**9 * (count[lang, s, t] + 5) // total for t in kept}
        for s in sources:
            pairs = sorted((-sum(abs(share[s][t] - share[o][t]) for t in kept), o.encode()) for o in sources if o != s)
            over = sorted((share[None][t] - share[s][t], t.encode()) for t in kept if count[lang, s, t] and share[s][t] > share[None][t])
            out |= {(lang, s, "pair", o.decode(), -v, i) for i, (v, o) in enumerate(pairs, 1)}
            out |= {(lang, s, "term", t.decode(), -v, i) for i, (v, t) in enumerate(over[:top], 1)}
    return out


@pytest.mark.parametrize(("least", "top", "cells"), [(2, 50, 1 << 21), (1, 3, 4), (1000, 50, 1 << 21)])
def test_audit_by_hand(spark, odd_rows, monkeypatch, least, top, cells):
    monkeypatch.setattr(divergence, "_CELLS_AT_ONCE", cells)
    got = divergence.audit(table(spark, odd_rows), least, top).collect()
    assert {tuple(r) for r in got} == audit_by_hand(odd_rows, least, top)
    assert len(got) == len({tuple(r) for r in got})


def test_audit_of_an_empty_table(spark, odd_rows):
    assert divergence.audit(table(spark, odd_rows).limit(0)).count() == 0


def test_prefix_levels_discard_only_rare_terms(spark):
    """A prefix that many terms share survives although each term is rare; the terms themselves go."""
    rows = [(i, f"prefixed{'abcdefghij'[i]} common longtermthatismuchlongerthanthirtytwobytesinall", "a", "s") for i in range(10)]
    terms, groups = divergence.kept_terms(table(spark, rows), 10, first_length=2)
    assert {(r.term, r.n) for r in terms.collect()} == {("common", 10), ("longtermthatismuchlongerthanthirtytwobytesinall", 10)}
    assert [tuple(r) for r in groups.collect()] == [("a", "s")]


def test_filter_never_misses(spark):
    found = np.random.default_rng(3).integers(-(1 << 63), 1 << 63, 5000)
    rows = spark.createDataFrame([(int(x),) for x in found], "fp long")
    kept = byte_words.filter_of(rows, 5000)
    assert kept.has(found.view(np.uint64)).all()
    others = np.random.default_rng(4).integers(0, 1 << 63, 20_000).astype(np.uint64)
    assert kept.has(others).mean() < 0.05
    assert not byte_words.filter_of(rows.limit(0), 0).has(others).any()


def n_grams_by_hand(text):
    out = Counter()
    for word in "".join(c if c.isalpha() else " " for c in text.lower()).split():
        edged = f" {word} "
        out.update(word)
        out.update(edged[i : i + 2] for i in range(len(edged) - 1))
        out.update(edged[i : i + 3] for i in range(len(edged) - 2))
    return out


def test_n_grams_by_hand():
    texts = ["", "Éa b1c", "  ", "x", "\n\nLa été—là 𝔘nd", "İx", "end"]
    grams, counts, bounds = language_id._runs(*language_id.n_grams(texts))
    for i, text in enumerate(texts):
        got = {}
        for g, n in zip(grams[bounds[i] : bounds[i + 1]].tolist(), counts[bounds[i] : bounds[i + 1]].tolist(), strict=True):
            got["".join(chr(c) for c in (g >> 42, g >> 21 & 0x1FFFFF, g & 0x1FFFFF) if c)] = n
        assert got == n_grams_by_hand(text)


def nearest_by_hand(profiles, text, length):
    own = [g for g, _ in sorted(n_grams_by_hand(text).items(), key=lambda x: (-x[1], key_of(x[0])))][:length]
    if not own:
        return "und", 0.0
    apart = {lang: sum(abs(i - p.index(g)) if g in p else length for i, g in enumerate(own)) for lang, p in profiles.items()}
    best = min(sorted(apart), key=lambda x: apart[x])
    return best, 1 - apart[best] / (length * len(own))


def key_of(gram):
    return sum(ord(c) << 21 * i for i, c in enumerate(reversed(gram)))


def test_language_query_by_hand(spark):
    """The registered query, its columns and its split against profiles made with plain Python."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").collect()
    held = {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in docs}
    counts = defaultdict(Counter)
    for r in docs:
        if not held[r.doc_id]:
            counts[r.lang].update(n_grams_by_hand(r.text))
    profiles = {lang: [g for g, _ in sorted(c.items(), key=lambda x: (-x[1], key_of(x[0])))[:300]] for lang, c in counts.items()}
    got = {r.doc_id: r for r in queries.op12_language_id(spark, SF).collect()}
    assert len(got) == len(docs)
    for r in docs:
        lang, score = nearest_by_hand(profiles, r.text, 300)
        assert (got[r.doc_id].held_out, got[r.doc_id].lang_pred) == (held[r.doc_id], lang)
        assert got[r.doc_id].score == pytest.approx(score)
    judged = [r for r in docs if held[r.doc_id]]
    assert sum(got[r.doc_id].lang_pred == r.lang for r in judged) >= 0.97 * len(judged)


def test_language_of_odd_texts(spark, odd_rows):
    docs = table(spark, odd_rows)
    profiles = language_id.train(docs, F.lit(True), sample_rows=10)
    assert profiles.languages == ["a", "b"]  # c has no letters, and no name is no language
    got = language_id.identify(docs, profiles).select("row.doc_id", "row.phrase", "row.rank", "lang_pred", "score").collect()
    assert len(got) == len(odd_rows)
    assert all(0 <= r.score <= 1 and r.phrase == "p" for r in got)
    assert {r.doc_id for r in got if r.lang_pred == "und"} == {100, 101, 102}
    assert len({(r.lang_pred, r.score) for r in got if r.doc_id == 104}) == 1


def test_no_language_learned(spark, odd_rows):
    docs = table(spark, odd_rows)
    profiles = language_id.train(docs, F.lit(None).cast("boolean"))
    got = language_id.identify(docs, profiles).collect()
    assert len(got) == len(odd_rows) and {(r.lang_pred, r.score) for r in got} == {("und", 0.0)}
    assert language_id.identify(docs.limit(0), profiles).count() == 0
    assert language_id.train(docs.limit(0), F.lit(True)).languages == []


def test_equal_profiles_go_to_the_smaller_name(spark):
    rows = [(1, "same words", "b", "s"), (2, "same words", "a", "s")]
    profiles = language_id.train(table(spark, rows), F.lit(True))
    assert {r.lang_pred for r in language_id.identify(table(spark, rows), profiles).collect()} == {"a"}
