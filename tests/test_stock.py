from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from jobtide.errors import ConsistencyError, LayoutError
from jobtide.fixed_values import STOCK_REQUIRED_ALIASES
from jobtide.operators import contracts, quality, stock
from jobtide.operators.gates import annual_reconciliation, regional_reconciliation, regional_summary
from jobtide.plans.annual import build_stock_gold, build_stock_silver, reconcile
from jobtide.sources.layout import inspect_layouts, layout_summary, read_file_heads, require_valid_layouts
from jobtide.sources.stock_text import read_stock_text
from jobtide.sources.tables import union_parts

RAW = "cbo_raw string, municipio_raw string, active_raw string, abandoned_raw string, source_file string"
FAMILIES = ["2124", "3171"]
HEADER = (
    "CBO 2002 Ocupação - Código,Município - Código,Ind Vínculo Ativo 31/12 - Código,Ind Vínculo Abandonado - Código,Idade\n"
)
BODY = "212405,230440,1,0,30\n317110,355030,0,0,31\n411010,330455,1,0,32\n212405,230440,1,1,33\n212405,230440,1,0,34\n"


def test_five_rows(rows):
    raw = rows(RAW, *[(*line.split(",")[:4], "a") for line in BODY.splitlines()])
    silver = stock.stock_silver(raw, families=FAMILIES)
    report = stock.with_stock_identities(stock.stock_counters(silver)).collect()[0]
    assert (report.rows_read, report.rows_active_source, report.rows_abandoned_source) == (5, 4, 1)
    assert (report.rows_stock_eligible_source, report.rows_unknown_abandoned_source) == (3, 0)
    assert (report.rows_inactive_source, report.rows_active, report.rows_inactive, report.rows_tech) == (1, 3, 1, 2)
    assert report.rows_rejected == 0 and report.source_partition_complete and report.stock_partition_complete
    scope = stock.route_stock(silver, 2025).scope
    assert {r.cbo_familia for r in scope.collect()} == {"2124"}
    assert scope.schema.simpleString() == (
        "struct<year:smallint,cbo_codigo:string,cbo_familia:string,municipio_codigo:string,uf:string,"
        "active_3112:boolean,source_file:string>"
    )


def test_reject_reasons(rows):
    raw = rows(RAW, ("xx", "990000", "9", "9", "a"), ("212405", "23", "1", "0", "a"), (None, None, None, None, "a"))
    got = [r.reason for r in stock.route_stock(stock.stock_silver(raw, families=FAMILIES), 2025).rejected.collect()]
    assert got == [
        "invalid_active_status,invalid_abandoned_status,invalid_cbo,invalid_uf",
        "invalid_municipality",
        "invalid_active_status,invalid_abandoned_status,invalid_cbo,invalid_municipality",
    ]


def test_valid_is_active_inactive_and_abandoned(rows):
    raw = rows(RAW, ("12345", "9999999", " 1 ", "0", "a"), ("212405", "230440", "0", "1", "a"), ("212405", "230440", "1", "1", "a"))
    report = stock.stock_counters(stock.stock_silver(raw, families=["0123"])).collect()[0]
    assert report.rows_valid == 3 and report.rows_active == report.rows_inactive == 1
    assert report.rows_residual_municipality == 1 and report.rows_tech == 1


def test_part_merge(rows):
    raw = rows(RAW, ("212405", "230440", "1", "0", "a"), ("xx", "230440", "1", "0", "b"), ("212405", "230440", "P", "0", "b"))
    parts = stock.with_stock_identities(stock.stock_counters(stock.stock_silver(raw, families=FAMILIES), ["source_file"]))
    total = stock.merge_stock_counters(parts).collect()[0]
    assert (total.rows_read, total.rows_rejected, total.parts_merged, total.rows_unknown_status_source) == (3, 2, 2, 1)
    assert total.source_partition_complete and total.stock_partition_complete
    broken = parts.withColumn("source_partition_complete", F.col("source_file") != "b")
    assert not stock.merge_stock_counters(broken).collect()[0].source_partition_complete
    with pytest.raises(LayoutError):
        union_parts([raw, raw.drop("source_file")])
    assert union_parts([raw, raw]).count() == 6


def test_published_tables(rows):
    schema = "year int, cbo_codigo string, cbo_familia string, municipio_codigo string, uf string, active_3112 boolean"
    data = rows(schema, (2025, "212405", "2124", "230440", "CE", True), (2025, "212405", "2124", "230440", "CE", True),
                (2025, "317110", "3171", "355030", "SP", True), (2025, "212405", "2124", "999999", "NI", True))
    by_uf = {r.uf: r for r in stock.stock_by(data, ["uf"]).collect()}
    assert (by_uf["CE"].active_stock, by_uf["CE"].share_of_tech_stock) == (2, 0.5)
    names = {r.cbo_familia_nome for r in stock.with_family_name(stock.stock_by(data, ["cbo_familia"])).collect()}
    assert "Analistas de tecnologia da informação" in names
    with pytest.raises(Exception, match="without a name"):
        stock.with_family_name(stock.stock_by(data, ["cbo_familia"]), {"2124": "x"}).collect()
    over = stock.stock_overview(data, F.lit(1000)).collect()[0]
    assert (over.active_stock_tech, over.uf_count, over.market_rows, over.share_tech_of_national_active) == (4, 3, 3, 0.004)

    dim = rows("prefix string, municipio_codigo_ibge string, municipio_nome string, uf string",
               ("230440", "2304400", "Fortaleza", "CE"), ("355030", "3550308", "São Paulo", "SP"))
    places = stock.stock_by_municipality(data, dim)
    assert places.count() == 3
    stock.require_clean_municipalities(places, 4)
    with pytest.raises(ConsistencyError, match="5"):
        stock.require_clean_municipalities(places, 5)
    with pytest.raises(ConsistencyError, match="unknown"):
        stock.require_clean_municipalities(stock.stock_by_municipality(data, dim.where("uf = 'CE'")), 4)
    with pytest.raises(ConsistencyError, match="state"):
        stock.require_clean_municipalities(stock.stock_by_municipality(data, dim.withColumn("uf", F.lit("RJ"))), 4)

    ok = rows("year int, reconciled boolean, gold_ready boolean, expected_active bigint", (2025, True, True, 1000))
    assert stock.require_publishable_stock(data, ok, 2025) == 1000
    for broken in (ok.withColumn("reconciled", F.lit(False)), ok.withColumn("expected_active", F.lit(3)), ok.withColumn("year", F.lit(2024))):
        with pytest.raises(ConsistencyError):
            stock.require_publishable_stock(data, broken, 2025)
    for wrong in (data.withColumn("active_3112", F.lit(False)), data.withColumn("year", F.lit(2024)), data.withColumn("cbo_familia", F.lit("9999"))):
        with pytest.raises(ConsistencyError):
            stock.require_publishable_stock(wrong, ok, 2025)


def test_exact_annual_reconciliation(rows):
    counters = rows(
        "year int, rows_stock_eligible_source bigint, rows_active_source bigint, rows_abandoned_source bigint, source_partition_complete boolean,"
        " stock_partition_complete boolean, rows_unknown_status_source bigint, rows_unknown_abandoned_source bigint,"
        " rows_year_mismatch_source bigint, rows_tech bigint",
        (2025, 59970945, 60691770, 720825, True, True, 0, 0, 0, 786296),
    )
    official = rows("year int, active_links bigint", (2025, 59970945))
    row = annual_reconciliation(counters, official).collect()[0]
    assert row.reconciled and row.gold_ready and row.difference == 0 and row.abandoned_active_source == 720825
    off = annual_reconciliation(counters, official.withColumn("active_links", F.col("active_links") + 1)).collect()[0]
    assert not off.reconciled and off.difference == -1
    none = annual_reconciliation(counters, official.where("year = 2000")).collect()[0]
    assert not none.reconciled


def test_regional_reconciliation(rows):
    schema = "archive string, rows_stock_eligible_source bigint, rows_active_source bigint, rows_abandoned_source bigint,"
    schema += " rows_unknown_abandoned_source bigint, rows_unknown_status_source bigint, rows_rejected bigint"
    parts = rows(schema, ("n.7z", 10, 12, 2, 0, 0, 0), ("s.7z", 5, 5, 0, 0, 0, 1), ("extra.7z", 1, 1, 0, 0, 0, 0))
    expected = rows("archive string, expected_stock bigint", ("n.7z", 10), ("s.7z", 5), ("gone.7z", 3))
    got = {r.archive: r.matched for r in regional_reconciliation(parts, expected).collect()}
    assert got == {"n.7z": True, "s.7z": False, "extra.7z": False, "gone.7z": False}
    only = regional_reconciliation(parts.where("archive = 'n.7z'"), expected.where("archive = 'n.7z'"))
    assert regional_summary(only, 10).collect()[0].regional_reconciled
    assert not regional_summary(only, 11).collect()[0].regional_reconciled


def test_layouts_and_text_scan(spark, tmp_path):
    """Three files, two layouts: comma in UTF-8 and semicolon in Latin-1 with other names and column order."""
    folder = tmp_path / "raw"
    folder.mkdir()
    (folder / "NORTE.COMT").write_bytes(("﻿" + HEADER + BODY).encode("utf-8"))
    (folder / "SUL.COMT").write_bytes((HEADER + BODY).encode("utf-8"))
    other = "Idade;Município;Vínculo Ativo 31/12;CBO Ocupação 2002;Vínculo Abandonado\n30;4314902;1;2124-05;0\n"
    (folder / "SP.txt").write_bytes(other.encode("latin-1"))
    (folder / "notes.pdf").write_bytes(b"x")
    layouts = inspect_layouts(spark, str(folder))
    found = {r.file: r for r in layouts.collect()}
    assert set(found) == {"NORTE.COMT", "SUL.COMT", "SP.txt"}
    assert (found["SP.txt"].encoding, found["SP.txt"].delimiter, found["SP.txt"].column_count) == ("latin-1", ";", 5)
    assert found["NORTE.COMT"].encoding == "utf-8-sig"
    assert found["NORTE.COMT"].header_signature_sha256 == found["SUL.COMT"].header_signature_sha256
    summary = layout_summary(layouts).collect()[0]
    assert (summary.files_inspected, summary.unique_layouts, summary.files_with_problem) == (3, 2, 0)
    assert {r.file: r.valid for r in contracts.layout_readiness(contracts.match_aliases(layouts, STOCK_REQUIRED_ALIASES)).collect()} == dict.fromkeys(found, True)

    raw = read_stock_text(spark, layouts)
    assert raw.count() == 11
    one = raw.where("source_file = 'SP.txt'").collect()[0]
    assert (one.cbo_raw, one.municipio_raw, one.active_raw, one.abandoned_raw) == ("2124-05", "4314902", "1", "0")

    root = str(tmp_path / "out")
    build_stock_silver(spark, str(folder), root, 2025, families=FAMILIES)
    official = spark.createDataFrame([(2025, 7)], "year int, active_links bigint")
    assert reconcile(spark, root, 2025, official).collect()[0].reconciled
    build_stock_gold(spark, root, 2025)
    assert spark.read.parquet(f"{root}/overview").collect()[0].active_stock_tech == 5
    assert {r.uf: r.active_stock for r in spark.read.parquet(f"{root}/by_uf").collect()} == {"CE": 4, "RS": 1}


def test_values_are_checked_before_rows(spark, tmp_path):
    """One unknown status in the last file stops the load; what was found is stored, also values beyond a summary's list."""
    folder, root = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    (folder / "a.csv").write_text(HEADER + BODY, encoding="utf-8")
    many = "".join(f"212405,230440,odd {i},0,30\n" for i in range(70))
    (folder / "b.csv").write_text(HEADER + BODY + many + "212405,230440,1,,30\n", encoding="utf-8")
    with pytest.raises(LayoutError, match=r"active_raw: 70 unknown values .*; abandoned_raw: 0 unknown values \(\), 1 blanks"):
        build_stock_silver(spark, str(folder), root, 2025, families=FAMILIES)
    counts = spark.read.parquet(f"{root}/value_counts")
    assert counts.where("source_file = 'b.csv' and concept = 'active_raw' and value like 'odd%'").count() == 70
    profile = {(r.source_file, r.concept): r for r in spark.read.parquet(f"{root}/profile").collect()}
    assert profile[None, "active_raw"].distinct_in_sample == 72 and profile["a.csv", "active_raw"].digits_only == 5
    assert not (tmp_path / "out" / "rows").exists()


def test_bad_layouts(spark, tmp_path):
    (tmp_path / "short.csv").write_text("a;b;c\n1;2;3\n")
    (tmp_path / "twice.csv").write_text("a;A ;c;d;e\n")
    (tmp_path / "blank.csv").write_text("a;;c;d;e\n")
    (tmp_path / "none.csv").write_text("abc\n")
    (tmp_path / "empty.csv").write_text("\n \n")
    (tmp_path / "quoted.csv").write_text('\n"a;1";"b";c;d|x;e\n')
    got = {r.file: (r.problem, r.columns) for r in inspect_layouts(spark, str(tmp_path)).collect()}
    assert got["short.csv"][0] == "too few columns" and got["twice.csv"][0] == "duplicate column name"
    assert got["blank.csv"][0] == "empty column name" and got["none.csv"][0] == "no delimiter in header"
    assert got["empty.csv"][0] == "file is empty"
    assert got["quoted.csv"] == (None, ["a;1", "b", "c", "d|x", "e"])
    with pytest.raises(LayoutError):
        require_valid_layouts(inspect_layouts(spark, str(tmp_path)))


def test_alias_states(rows):
    headers = rows("file string, column string", ("f", "cbo"), ("f", "municipio"), ("f", "municipio_codigo"), ("f", "x"))
    got = {r.concept: (r.status, r.matches) for r in contracts.match_headers(
        headers, {"o": ["cbo", "cbo_ocupacao"], "m": ["municipio", "municipio_codigo"], "a": ["ativo"]}).collect()}
    assert got == {"o": ("matched", ["cbo"]), "m": ("ambiguous", ["municipio", "municipio_codigo"]), "a": ("missing", [])}
    with pytest.raises(LayoutError, match="ambiguous|missing"):
        contracts.concept_columns(contracts.match_headers(headers, {"m": ["municipio", "municipio_codigo"]}))


def test_value_contract(rows):
    counts = rows("value string, n bigint", (" 1", 5), ("0", 3), ("", 0))
    good = contracts.binary_value_contract(counts, ["1"], ["0"]).collect()[0]
    assert good.valid and good.positive_observed == ["1"] and good.negative_observed == ["0"]
    for extra in (("2", 1), ("", 4)):
        assert not contracts.binary_value_contract(counts.union(rows("value string, n bigint", extra)), ["1"], ["0"]).collect()[0].valid
    assert contracts.binary_value_contract(counts.union(rows("value string, n bigint", ("2", 1))), ["1"], ["0"], reject_unknown=False).collect()[0].valid
    assert not contracts.binary_value_contract(rows("value string, n bigint", ("1", 1)), ["1"], ["0"]).collect()[0].valid
    assert contracts.year_contract(rows("value string", "2025", "2025"), 2025).collect()[0].valid
    assert not contracts.year_contract(rows("value string", "2025", "2024"), 2025).collect()[0].valid


def test_municipality_check(rows):
    codes = rows("municipio_codigo string, uf string", ("230440", "CE"), ("230440", "SP"), ("355030", "SP"), ("999999", "NI"), ("12a", "CE"))
    dim = rows("code7 string", "2304400", "3550308", "3550309", "bad")
    row = contracts.municipality_dimension_check(codes, dim).collect()[0]
    assert (row.silver_rows, row.unique_codes, row.residual_rows, row.matched_codes, row.unmatched_codes) == (5, 4, 1, 2, 1)
    assert (row.invalid_length_codes, row.invalid_numeric_codes, row.uf_mismatch_rows, row.ambiguous_prefixes) == (1, 1, 1, 1)
    assert not row.municipality_ready
    good = contracts.municipality_dimension_check(codes.where("uf = 'NI' or municipio_codigo = '355030'"), dim.where("code7 = '3550308'"))
    assert good.collect()[0].municipality_ready


def test_snapshots(rows):
    people = rows("code string, population bigint", ("2304400", 10), ("3550308", 20))
    assert contracts.population_snapshot_check(people, 2).collect()[0].valid
    assert not contracts.population_snapshot_check(people, 3).collect()[0].valid
    assert not contracts.population_snapshot_check(people.union(rows("code string, population bigint", ("2304401", 5))), 3).collect()[0].valid
    index = rows("month string, value decimal(18,6)", ("202607", Decimal("7657.73"))).union(
        rows("month string, value decimal(18,6)", ("202608", Decimal("7633.23")), ("202609", Decimal("7695.82"))))
    row = contracts.index_snapshot_check(index, "202609", "202607", 0.82).collect()[0]
    assert row.valid and row.rate == 0.82
    assert not contracts.index_snapshot_check(index, "202609", "202607", 0.81).collect()[0].valid
    assert not contracts.index_snapshot_check(index, "202610", "202607").collect()[0].valid


def test_profiles(rows):
    data = rows("f string, v string", *[("a", x) for x in ["1", "1", " 22 ", "", None, "b"]], ("c", "1"))
    counts = quality.value_counts(data, ["v"])
    row = quality.profile_summary(counts, ["concept"]).collect()[0]
    assert (row.non_blank, row.blank, row.distinct_in_sample, row.digits_only) == (5, 2, 3, 4)
    assert {(r.length, r.n) for r in quality.profile_lengths(counts, ["concept"]).collect()} == {(1, 4), (2, 1)}
    assert [(r.value, r.n) for r in quality.profile_top_values(counts, ["concept"], 2).orderBy("rank").collect()] == [("1", 3), ("22", 1)]
    assert quality.profile_observed_values(counts, ["concept"]).collect()[0].observed_values == ["1", "22", "b"]
    assert quality.profile_observed_values(counts, ["concept"], 2).collect()[0].observed_values is None
    assert quality.first_rows_per_file(data.withColumn("i", F.monotonically_increasing_id()), "f", ["i"], 2).count() == 3


def test_first_rows_of_text_files(spark, tmp_path):
    for name, n in (("x.csv", 5), ("y.csv", 2)):
        (tmp_path / name).write_text("v\n" + "\n".join(str(i) for i in range(n)) + "\n")
    placed = quality.with_file_position(spark.read.csv(str(tmp_path), header=True))
    first = quality.first_rows_per_file(placed, "file", ["block_start", "row_id"], 3)
    assert sorted((r.file, r.v) for r in first.collect()) == [
        ("x.csv", "0"), ("x.csv", "1"), ("x.csv", "2"), ("y.csv", "0"), ("y.csv", "1")]


def test_stock_rules(rows):
    data = rows("active_raw string, abandoned_raw string, rem_mean double, rem_dec double",
                ("1", "0", 10.0, 0.0), ("1", "1", 5.0, 5.0), ("1", None, None, 1.0), ("0", "0", 9.0, 9.0))
    got = {r.candidate: (r.stock, r.exact_match) for r in quality.stock_rule_candidates(data, 1).collect()}
    assert got["active_total"] == (3, False) and got["active_abandoned_zero"] == (1, True)
    assert got["active_abandoned_not_one"] == (2, False) and got["active_rem_dec_positive"] == (2, False)
    assert got["active_abandoned_zero_rem_dec_positive"] == (0, False)
    assert {(r.abandoned, r.rows) for r in quality.abandoned_values_of_active(data).collect()} == {("0", 1), ("1", 1), ("", 1)}


def test_encoding_follows_the_whole_file(spark, tmp_path):
    """Bytes far behind the header decide; a character across any block edge does not; a mark is dropped; blank files have no header."""
    header, filler = "a;b;c;d;é", "x;" * 200_000
    (tmp_path / "late latin.csv").write_bytes(f"{header}\n{filler}\nç".encode("latin-1"))
    (tmp_path / "edge.txt").write_bytes(f"\n \r\n{header}\n".encode() + b"y" * (262_143 - len(header.encode()) - 5) + "ç\n".encode() * 9)
    (tmp_path / "mark.COMT").write_bytes(f"{header}\n1".encode("utf-8-sig"))
    (tmp_path / "blank.csv").write_bytes(b" \n\n")
    (tmp_path / "other.md").write_bytes(b"no\xff")
    got = {r.path.rsplit("/", 1)[1]: (r.encoding, r.header_line) for r in read_file_heads(spark, str(tmp_path)).collect()}
    assert got == {
        "late latin.csv": ("latin-1", header), "edge.txt": ("utf-8-sig", header), "mark.COMT": ("utf-8-sig", header),
        "blank.csv": ("utf-8-sig", None)}
