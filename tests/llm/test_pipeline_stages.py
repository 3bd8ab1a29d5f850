"""Each pipeline stage on odd rows, and the toxic spans of texts whose lower case is longer."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from riskpanel.llm import toxicity

SF = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, row string, score double, kept string, h int, bad long, item string"
KEPT = corpus_pipeline.STAGES[:-1]


@pytest.fixture(scope="module")
def odd(spark):
    rng = np.random.default_rng(9)
    passage = " ".join(f"w{x}" for x in rng.integers(0, 10**6, 120))
    rows = [(1, None), (2, ""), (3, "wort " * 30_000), (4, passage), (4, passage), (5, passage + " end"), (None, passage), (6, " \n\n "), (None, None)]
    rows += [(100 + i, f"shared line of all\nown {i} {' '.join(map(str, rng.integers(0, 10**6, 30)))}") for i in range(14)]
    made = [(i, t, None if i is None else "en", None if i == 6 else f"s{i}", len(t or ""), "r", 0.5, "k", 1, 2, "i") for i, t in rows]
    return spark.createDataFrame(made, COLUMNS).cache()


@pytest.mark.parametrize(("name", "stage"), KEPT)
def test_stages_keep_the_columns_and_survive_no_rows(spark, odd, name, stage):
    out = stage(spark, odd, SF)
    assert out.columns == odd.columns and dict(out.dtypes) == dict(odd.dtypes)
    empty = stage(spark, odd.limit(0), SF)
    assert empty.columns == odd.columns and empty.count() == 0


def test_toxicity_keeps_clean_rows(spark, odd):
    assert corpus_pipeline.drop_toxic(spark, odd, SF).count() == odd.count()


def test_boilerplate_goes_from_every_text(spark, odd):
    out = {r.doc_id: r for r in corpus_pipeline.drop_boilerplate_lines(spark, odd, SF).filter("doc_id is not null").collect()}
    assert all(out[100 + i].text.startswith(f"own {i} ") and out[100 + i].n_chars == len(out[100 + i].text) for i in range(14))
    assert out[1].text is None and out[2].text == "" and out[6].text == " \n\n "
    assert corpus_pipeline.drop_boilerplate_lines(spark, odd, SF).count() == odd.count()


def test_one_of_each_group_stays(spark, odd):
    kept = [r.doc_id for r in corpus_pipeline.keep_one_of_each_group(spark, odd, SF).collect()]
    # 2 is empty like 1, and 5 is nearly 4, whose two rows both stay, as do rows without doc_id
    assert sorted(map(str, kept)) == sorted(map(str, [1, 3, 4, 4, 6, None, None, *range(100, 114)]))


def test_only_overlapping_rows_go(spark, odd):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").filter(F.length("text") > 200).first().text
    named = odd.withColumn("text", F.when(F.col("doc_id") == 100, F.concat(F.lit("before "), F.lit(item))).otherwise(F.col("text")))
    out = corpus_pipeline.drop_contaminated(spark, named, SF)
    assert out.count() == odd.count() - 1 and out.filter("doc_id = 100").isEmpty()


def test_tokens_of_every_row(spark, odd):
    out = corpus_pipeline.tokenize(spark, odd, SF)
    assert out.count() == odd.count() and {r.n_tokens for r in out.filter("doc_id in (1, 2)").collect()} == {0}
    assert corpus_pipeline.tokenize(spark, odd.limit(0), SF).count() == 0


def test_spans_point_into_the_text_as_it_stands():
    text = "İİİ fine words İ nasty idiot end"
    words = text.lower()
    found = [m.group() for m in toxicity._WORDS.finditer(words)]
    p = np.array([0.9 if w in ("nasty", "idiot") else 0.1 for w in found])
    assert [text[a:b] for a, b in toxicity._spans(text, p)] == ["nasty idiot"]
    assert toxicity._spans("bad ok bad", np.array([0.9, 0.1, 0.9])) == [(0, 3), (7, 10)]
