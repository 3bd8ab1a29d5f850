import json

from pyspark.sql import functions as F

from riskpanel.sources import artefacts


def test_json_has_null_instead_of_nan(spark, tmp_path):
    df = spark.createDataFrame([("a", float("nan")), ("b", 0.5)], "model string, brier double")
    artefacts.save_json(df, str(tmp_path / "m"))
    lines = [json.loads(x) for p in (tmp_path / "m").glob("*.json") for x in p.read_text().splitlines()]
    assert {r["model"]: r["brier"] for r in lines} == {"a": None, "b": 0.5}
    back = artefacts.read_artefact(spark, str(tmp_path / "m"))
    assert back.filter(F.col("brier").isNull()).count() == 1


def test_parquet_and_csv_artefacts(spark, tmp_path):
    df = spark.createDataFrame([("x", 1)], "unidad string, n int")
    artefacts.save_matrix(df, str(tmp_path / "p"))
    artefacts.export_csv(df, str(tmp_path / "c"))
    for folder in ("p", "c"):
        assert [tuple(r) for r in artefacts.read_artefact(spark, str(tmp_path / folder)).collect()] == [("x", 1)]


def test_comparison_files(spark, tmp_path):
    val = spark.createDataFrame([(0, "forest", 0.8), (1, "logistic", 0.8)], "family_order int, model string, f1_macro_val double")
    test = spark.createDataFrame([("forest", 0.7, float("nan"))], "model string, f1_macro double, brier double")
    artefacts.save_comparison(val, test, str(tmp_path))
    payload = spark.read.json(str(tmp_path / "comparacion_modelos")).first()
    assert payload["modelo_mejor_validacion"] == "forest" and len(payload["validacion"]) == 2
    assert payload["test"][0]["f1_macro"] == 0.7
    assert not (tmp_path / "model").exists()
