"""Messy CSV folders: dialects, aliases, bad lines, scope and audit."""

import random

import pytest
from pyspark.sql import DataFrameReader
from pyspark.sql import functions as F

from riskpanel.functions.text import fold, normalise
from riskpanel.operators import cleaning, panel, profile
from riskpanel.operators.cleaning import Scope
from riskpanel.sources import csv_files

HEADER = "Fecha;provincia;Canton;Cod_Parroquia;Parroquia;Servicio;Subtipo"
ROW = "5/1/2026;GUAYAS;GUAYAQUIL;90150;CABECERA;Tránsito y Movilidad;Choque"


def _write(folder, name, text, encoding="utf-8"):
    (folder / name).write_bytes(text.encode(encoding))
    return str(folder / name)


def _events(spark, folder, scope=Scope()):
    return cleaning.clean_events(csv_files.read_incidents(spark, str(folder), scope), scope)


def test_all_dialects_and_encodings(spark, tmp_path):
    for i, sep in enumerate(csv_files.SEPARATORS):
        _write(tmp_path, f"u{i}.csv", "\n".join([HEADER, ROW]).replace(";", sep) + "\n")
    _write(tmp_path, "latin.csv", f"{HEADER}\n{ROW}\n", "latin-1")
    _write(tmp_path, "bom.csv", f"{HEADER}\n{ROW}\n", "utf-8-sig")
    _write(tmp_path, "notes.txt", f"{HEADER}\n{ROW}\n")
    listing = csv_files.list_files(spark, str(tmp_path))
    assert {(d.separator, d.encoding) for d in listing.readable} == {
        (";", "UTF-8"), (",", "UTF-8"), ("|", "UTF-8"), ("\t", "UTF-8"), (";", "ISO-8859-1"),
    }
    rows = _events(spark, tmp_path).collect()
    assert len(rows) == 6 and {r["servicio"] for r in rows} == {"Tránsito y Movilidad"}
    assert {r["archivo"] for r in rows} == {"u0.csv", "u1.csv", "u2.csv", "u3.csv", "latin.csv", "bom.csv"}
    assert {r["unit_id"] for r in rows} == {"90150"}


def test_rows_can_be_counted_without_reading_a_column(spark, tmp_path):
    _write(tmp_path, "a.csv", f"{HEADER}\n{ROW}\n{ROW};too;long\n{ROW}\n")
    rows = csv_files.read_incidents(spark, str(tmp_path), Scope())
    assert rows.count() == 2
    assert [tuple(r) for r in rows.groupBy("archivo").count().collect()] == [("a.csv", 2)]


def test_unreadable_and_empty_files_are_left_out(spark, tmp_path):
    _write(tmp_path, "a.csv", f"{HEADER}\n{ROW}\n")
    _write(tmp_path, "b.csv", "one;two\n1;2\n")
    _write(tmp_path, "c.csv", "Fecha;Canton;Parroquia;Subtipo;Otro\n1/1/2026;X;Y;Z;W\n")
    listing = csv_files.list_files(spark, str(tmp_path))
    assert [p.rsplit("/", 1)[1] for p in listing.unreadable] == ["b.csv"]
    assert _events(spark, tmp_path).count() == 1


def test_no_usable_file_is_an_error(spark, tmp_path):
    _write(tmp_path, "c.csv", "Fecha;Canton;Parroquia;Subtipo;Otro\n1/1/2026;X;Y;Z;W\n")
    with pytest.raises(ValueError, match="required columns"):
        csv_files.read_incidents(spark, str(tmp_path), Scope())
    (tmp_path / "none").mkdir()
    with pytest.raises(FileNotFoundError):
        csv_files.list_files(spark, str(tmp_path / "none"))


def test_long_lines_are_dropped_and_short_ones_padded(spark, tmp_path):
    quoted = ROW.replace("CABECERA", '"CABE;CERA"')
    text = "\n".join([HEADER, ROW, ROW + ";extra", ROW.rsplit(";", 1)[0], quoted, quoted + ";extra", ""])
    _write(tmp_path, "a.csv", text)
    rows = _events(spark, tmp_path).collect()
    assert sorted((r["parroquia"], r["subtipo"]) for r in rows if r["subtipo"]) == [("CABE;CERA", "Choque"), ("CABECERA", "Choque")]
    assert len(rows) == 3


def test_aliases_exact_then_containing():
    found = csv_files.resolve_columns(["FECHA INCIDENTE", "DPA CANTÓN", "COD PARR", "TIPO", "Otro"])
    assert found == {"fecha": 0, "canton": 1, "cod_parroquia": 2, "servicio": 3}
    # without its own header a category is taken from the subtype, and a name from the code
    loose = csv_files.resolve_columns(["Fecha", "Canton", "Cod_Parroquia", "Subtipo", "provincia"])
    assert loose["servicio"] == 3 and loose["subtipo"] == 3 and loose["parroquia"] == 2


def test_scope_and_audit(spark, tmp_path):
    lines = [
        ROW,
        ROW.replace("90150", "90152.0"),
        ROW.replace("GUAYAQUIL", "DURAN"),
        ROW.replace("Tránsito y Movilidad", "Seguridad Ciudadana"),
        ROW.replace("5/1/2026", "31/02/2026"),
        ROW.replace("90150", ""),
        ROW.replace("Tránsito", " TRANSITO ").replace("GUAYAQUIL", "guayaquil "),
    ]
    _write(tmp_path, "a.csv", "\n".join([HEADER, *lines]) + "\n")
    raw = csv_files.read_incidents(spark, str(tmp_path), Scope())
    audit = cleaning.funnel(raw, Scope()).first().asDict()
    assert audit == {
        "raw": 7, "after_category": 6, "after_area": 5, "after_date": 4, "valid": 3, "valid_files": 1,
        "dropped_category": 1, "dropped_area": 1, "dropped_date": 1, "dropped_unit": 1,
    }
    events = cleaning.clean_events(raw, Scope())
    assert {r["unit_id"] for r in events.collect()} == {"90150", "90152"}
    assert {r["event_date"].isoformat() for r in events.collect()} == {"2026-01-05"}
    by_province = Scope(area_level="provincia", area="Guayas")
    assert cleaning.clean_events(csv_files.read_incidents(spark, str(tmp_path), by_province), by_province).count() == 4
    anywhere = Scope(area_level=None, area=None, unit_level="canton")
    units = cleaning.clean_events(csv_files.read_incidents(spark, str(tmp_path), anywhere), anywhere)
    # canton spellings stay separate units
    assert {r["unit_id"] for r in units.collect()} == {"GUAYAQUIL", "DURAN", "guayaquil"}


def test_fast_paths_agree_with_normalising(spark):
    texts = ["Tránsito", "transito x", "TRÂNSITO", "tran sito", "  Guayaquil", "GUAYAQUIL", "guayaquíl", "", None, "ﬁ"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    t = F.col("t")
    for category in ("TRANSITO", "tran sitos"):
        want = F.contains(normalise(t), F.lit(category.upper()[:7]))
        assert df.filter(cleaning.in_category(t, category) != want).count() == 0
    for area in ("Guayaquíl", "TRAN  SITO", "fi", ""):
        assert df.filter(cleaning.in_area(t, area) != (normalise(t) == fold(area))).count() == 0


def test_empty_scope_is_an_error(spark, tmp_path):
    _write(tmp_path, "a.csv", f"{HEADER}\n{ROW}\n")
    scope = Scope(area="CUENCA")
    with pytest.raises(ValueError, match="no rows"):
        cleaning.require_rows(_events(spark, tmp_path, scope))
    with pytest.raises(ValueError):
        Scope(unit_level="provincia")


def test_files_to_panel(spark, tmp_path):
    rows = [ROW.replace("5/1/2026", f"{d}/1/2026") for d in (5, 5, 11, 12)] + [ROW.replace("5/1/2026", "18/01/2026")]
    _write(tmp_path, "m1.csv", "\n".join([HEADER, *rows[:3]]) + "\n")
    _write(tmp_path, "m2.csv", "\n".join([HEADER, *rows[3:]]) + "\n")
    daily = panel.daily_counts(_events(spark, tmp_path), "unit_id", "event_date")
    cells = {(r["dow"], r["week_idx"]): r["n"] for r in panel.dense_panel(daily).filter("n > 0").collect()}
    assert cells == {(0, 0): 2, (6, 0): 1, (0, 1): 1, (6, 1): 1}


def test_profile_of_a_file(spark, tmp_path):
    path = _write(tmp_path, "p.csv", "FECHA;LATITUD;TIPO;CIUDAD\n1/1/2026;-2.5;Tránsito;x\n2/1/2026;0;NA;x\n")
    rows, dialect = csv_files.read_sample(spark, path)
    assert dialect.separator == ";" and rows.columns == ["FECHA", "LATITUD", "TIPO", "CIUDAD"]
    shares = {r["column"]: r["null_pct"] for r in profile.null_shares(rows).collect()}
    assert shares == {"FECHA": 0.0, "LATITUD": 0.0, "TIPO": 50.0, "CIUDAD": 0.0}
    assert profile.columns_like(rows.columns, profile.CATEGORY_WORDS) == ["TIPO"]
    top = [(r["value"], r["rows"], r["flagged"]) for r in profile.top_values(rows, "TIPO", "TRANS").collect()]
    assert top == [("NAN", 1, False), ("TRANSITO", 1, True)]
    numbers = profile.numeric_profile(rows, profile.columns_like(rows.columns, profile.COORDINATE_WORDS)).collect()
    assert [tuple(r) for r in numbers] == [("LATITUD", -2.5, 0.0, 0.0, 50.0)]
    assert profile.samples(rows, "FECHA", 4).count() == 2
    assert csv_files.read_sample(spark, _write(tmp_path, "q.csv", "a;b\n1;2\n")) is None


def test_quoted_line_breaks_are_part_of_a_field(spark, tmp_path):
    broken = ROW.replace("CABECERA", '"CABE\nCERA"')
    _write(tmp_path, "a.csv", "\n".join([HEADER, ROW, broken, broken + ";extra", ROW, ""]))
    _write(tmp_path, "b.csv", "\n".join([HEADER, ROW, ""]))
    rows = _events(spark, tmp_path).collect()
    assert sorted(r["parroquia"] for r in rows) == ["CABE\nCERA", "CABECERA", "CABECERA", "CABECERA"]
    assert {d.multi_line for d in csv_files.list_files(spark, str(tmp_path)).readable} == {False, True}


def test_skipped_files_are_listed_and_counted(spark, tmp_path):
    _write(tmp_path, "a.csv", f"{HEADER}\n{ROW}\n")
    _write(tmp_path, "b.csv", "nothing to part here\n")
    _write(tmp_path, "c.csv", "Fecha;x;y;z;w\n1;2;3;4;5\n1;2;3;4;5\n")
    skipped = csv_files.skipped_files(spark, str(tmp_path), Scope())
    found = {r["archivo"]: (r["reason"], r["rows"]) for r in skipped.collect()}
    assert found == {
        "b.csv": ("no separator gives 5 columns", None),
        "c.csv": ("missing columns: canton, cod_parroquia, servicio", 2),
    }
    raw = csv_files.read_incidents(spark, str(tmp_path), Scope())
    audit = cleaning.funnel(raw, Scope(), skipped).first()
    assert (audit["raw"], audit["dropped_category"], audit["valid"]) == (3, 2, 1)


def test_a_profile_reads_the_whole_file(spark, tmp_path):
    path = _write(tmp_path, "long.csv", "a;b;c;d\n" + "1;2;3;4\n" * 6000)
    assert csv_files.read_sample(spark, path)[0].count() == 6000
    assert csv_files.read_sample(spark, path, 10)[0].count() == 10


@pytest.fixture()
def small_blocks(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("seed", range(3))
def test_records_over_blocks_equal_a_whole_reader(spark, tmp_path, small_blocks, seed):
    """Quoted line breaks, doubled quotes, separators and blank lines in fields, over many blocks of two files."""
    rng = random.Random(seed)
    pieces = ["x", "é", ";", '""', "\n", "\n\n", "a b", "", "long " * 9, '"";""', "1"]
    want = []
    for name in ("a.csv", "b.csv"):
        lines = ["c1;c2;c3;c4"]
        for _ in range(120):
            fields = []
            for _ in range(4):
                if rng.random() < 0.3:
                    fields.append('"' + "".join(rng.choice(pieces) for _ in range(rng.randint(1, 5))) + '"')
                else:
                    fields.append(rng.choice(["plain", "in\"side", "5", "", "tail\""]))
            lines.append(";".join(fields))
        _write(tmp_path, name, "\n".join(lines) + "\n")
        with open(tmp_path / name, newline="", encoding="utf-8") as f:
            text = f.read()
        want += [r for r in _parsed(text)[1:] if any(r)]
    listing = csv_files.list_files(spark, str(tmp_path), 4)
    (dialect,) = listing.readable
    assert dialect.multi_line and listing.lines.select("block_start").distinct().count() > 10
    got = [tuple(r[c] or "" for c in ("c0", "c1", "c2", "c3")) for r in csv_files.read_dialect(spark, listing, dialect).collect()]
    assert sorted(r for r in got if any(r)) == sorted(want)


def _parsed(text):
    """Rows of a CSV text by the plain rules: a quote opens a field only at its beginning."""
    rows, row, field, i, state = [], [], "", 0, "start"
    while i < len(text):
        c = text[i]
        if state == "quoted":
            if text[i : i + 2] == '""':
                field, i = field + '"', i + 1
            elif c == '"':
                state = "plain"
            else:
                field += c
        elif c == ";":
            row, field, state = [*row, field], "", "start"
        elif c == "\n":
            rows, row, field, state = [*rows, (*row, field)], [], "", "start"
        elif c == '"' and state == "start":
            state = "quoted"
        else:
            field, state = field + c, "plain"
        i += 1
    return rows


def test_the_text_is_scanned_once(spark, tmp_path, monkeypatch):
    broken = ROW.replace("CABECERA", '"CABE\nCERA"')
    _write(tmp_path, "a.csv", "\n".join([HEADER, ROW, broken, ""]))
    _write(tmp_path, "b.csv", f"{HEADER}\n{ROW}\n".replace(";", ","))
    _write(tmp_path, "c.csv", f"{HEADER}\n{ROW}\n", "latin-1")
    scans = []
    for kind in ("text", "csv"):
        real = getattr(DataFrameReader, kind)
        monkeypatch.setattr(DataFrameReader, kind, lambda self, *a, _k=kind, _r=real, **o: scans.append(_k) or _r(self, *a, **o))
    rows = csv_files.read_incidents(spark, str(tmp_path), Scope())
    assert scans == ["text"] and rows.count() == 4
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "FileScan text" not in plan and "FileScan csv" not in plan


def test_a_quote_that_is_never_closed_joins_no_file(spark, tmp_path, monkeypatch, small_blocks):
    monkeypatch.setattr(csv_files, "MAX_RECORD_LINES", 5)
    stray = ROW.replace("CABECERA", '"CABECERA')
    _write(tmp_path, "a.csv", "\n".join([HEADER, ROW, stray, *[ROW] * 40, ""]))
    rows = csv_files.read_incidents(spark, str(tmp_path), Scope())
    assert rows.filter("parroquia = 'CABECERA'").count() == 41
