"""Loads that repeat: partitions that the new data no longer fills, and files whose columns come in another order."""

import pytest

from jobtide.errors import ConsistencyError, LayoutError
from jobtide.sources import files, tables
from jobtide.sources.files import first_lines, list_files
from jobtide.sources.flow_text import header_contract, read_flow, read_flow_files, read_flow_text


def test_reload_empties_parts_of_its_months_only(spark, rows, tmp_path):
    path = str(tmp_path / "silver")
    old = rows("m string, status string, n int", ("202607", "valid", 1), ("202607", "rejected", 2), ("202608", "rejected", 3), ("202609", "a+b c", 4))
    tables.replace_partitions(old, path, ["m", "status"])
    new = rows("m string, status string, n int", ("202607", "valid", 5), ("202609", "a+b c", 6))
    tables.replace_partitions(new, path, ["m", "status"], rows("m string", "202607", "202609"))
    found = {tuple(r) for r in spark.read.parquet(path).selectExpr("cast(m as string)", "status", "n").collect()}
    assert found == {("202607", "valid", 5), ("202608", "rejected", 3), ("202609", "a+b c", 6)}


def test_row_count_sees_rows_of_a_month_that_became_empty(spark, rows, tmp_path):
    path = str(tmp_path / "serving")
    tables.write_table(rows("m string, n int", ("a", 1), ("b", 2)), path, ["m"])
    new = rows("m string, n int", ("a", 1))
    tables.require_row_counts(spark, path, new, "m")
    with pytest.raises(ConsistencyError):
        tables.require_row_counts(spark, path, new, "m", rows("m string", "a", "b"))


def test_columns_in_another_order_are_matched_by_name(spark, tmp_path):
    (tmp_path / "a.txt").write_text("competência Mov;UF\n202607;23\n", encoding="utf-8")
    (tmp_path / "b.txt").write_text("UF;competência Mov\n35;202607\n", encoding="utf-8")
    found = read_flow_text(spark, str(tmp_path / "*.txt"))
    assert {(r["competência Mov"], r["UF"]) for r in found.collect()} == {("202607", "23"), ("202607", "35")}


def _flow_file(path, names, *rows):
    path.write_text("\n".join([";".join(names), *map(";".join, rows)]) + "\n", encoding="utf-8")
    return str(path)


FLOW_NAMES = ["competência Mov", "UF", "município", "saldo movimentação", "cbo2002ocupação", "tipo movimentação", "salário"]
FLOW_ROW = ["202607", "23", "230440", "1", "212405", "10", "1,00"]


def test_one_file_without_a_required_column_stops_the_load(spark, tmp_path):
    """Each file is held against the contract; the other files' columns do not stand in for a missing one."""
    _flow_file(tmp_path / "a.txt", FLOW_NAMES, FLOW_ROW)
    _flow_file(tmp_path / "b.txt", [n for n in FLOW_NAMES if "cbo" not in n], [v for v in FLOW_ROW if v != "212405"])
    _flow_file(tmp_path / "c.txt", [*FLOW_NAMES, "sala rio"], [*FLOW_ROW, "9"])
    (tmp_path / "d.txt").write_text("")
    for load in (lambda: read_flow(spark, str(tmp_path), "202607"), lambda: read_flow_files(spark, [(str(tmp_path / "*.txt"), "202607", "MOV")])):
        with pytest.raises(LayoutError, match="3 of 4 flow files.*b.txt lacks required columns: cbo2002ocupacao; .*c.txt has headers .* same name: salario; .*d.txt lacks"):
            load()
    found = {r.path[-5:]: r for r in header_contract(first_lines(spark, list_files(spark, str(tmp_path)))).collect()}
    assert (found["a.txt"].valid, found["b.txt"].missing, found["c.txt"].doubled, found["d.txt"].headers) == (True, ["cbo2002ocupacao"], ["salario"], [])


def test_spellings_of_one_name_are_one_column(spark, tmp_path):
    a = _flow_file(tmp_path / "a[1] +%20b.txt", [" Uf " if n == "UF" else n for n in FLOW_NAMES], FLOW_ROW)
    b = _flow_file(tmp_path / "b.txt", [*reversed(FLOW_NAMES), "Nova Coluna"], [*reversed(FLOW_ROW), "x"])
    c = _flow_file(tmp_path / "c.txt", ["﻿competenciamov", '"U""F"', *(n.upper() for n in FLOW_NAMES[2:])], FLOW_ROW)
    rows = read_flow_files(spark, [(a.replace("[", "\\["), "202607", "MOV"), (b, "202608", "FOR"), (c, "202609", "EXC")])
    assert {(r.ingest_competence, r.file_kind, r.uf_codigo, r.cbo_codigo, r.novacoluna) for r in rows.collect()} == {
        ("202607", "MOV", "23", "212405", None), ("202608", "FOR", "23", "212405", "x"), ("202609", "EXC", "23", "212405", None)}
    assert read_flow(spark, str(tmp_path), "202607").count() == 3
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("] csv") == 2, "one scan per layout, not per file"
    with pytest.raises(LayoutError, match="two months or kinds"):
        read_flow_files(spark, [(b, "202608", "FOR"), (b, "202609", "FOR")])
    with pytest.raises(LayoutError, match="no file at"):
        read_flow_files(spark, [(str(tmp_path / "none.txt"), "202608", "MOV")])


def test_heads_of_packed_and_endless_lines(spark, tmp_path):
    import gzip

    (tmp_path / "a.txt.gz").write_bytes(gzip.compress((";".join(FLOW_NAMES) + "\r\n" + ";".join(FLOW_ROW) + "\r\n").encode()))
    assert read_flow(spark, str(tmp_path), "202607").first().salario_mensal == "1,00"
    (tmp_path / "b.txt").write_bytes(b"x" * (files.HEADER_BYTES + 1))
    with pytest.raises(LayoutError, match="longer than"):
        read_flow(spark, str(tmp_path), "202607")


def test_rows_learn_their_month_without_a_shuffle(spark, tmp_path):
    """Also from files with signs in their names that addresses write otherwise."""
    names = ["Competência Mov", "UF", "Município", "Saldo Movimentação", "CBO 2002 Ocupação", "Tipo Movimentação", "Salário"]
    loads = []
    for i, name in enumerate(["a b+c%20.txt", "é=1.txt"]):
        loads.append((_flow_file(tmp_path / name, names, ["202607", "23", "230440", "1", "212405", "10", str(i)]), f"20260{i + 1}", ["MOV", "EXC"][i]))
    found = read_flow_files(spark, loads)
    assert {(r.ingest_competence, r.file_kind, r.salario_mensal) for r in found.collect()} == {("202601", "MOV", "0"), ("202602", "EXC", "1")}
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan and "url_decode" not in plan.lower()
