import json

import pytest
from pyspark.sql import functions as F

from jobtide.errors import ConsistencyError, LayoutError, NotApprovedError
from jobtide.operators import analytics, cells, history, joins, serving
from jobtide.sources import csv_export, dimensions, documents, manifests, tables

TABLE = "competence string, uf string, admissions int"


def test_snapshot_and_changes(rows):
    before = rows(TABLE, ("202606", "CE", 1), ("202606", "SP", 2), ("202607", "CE", 3), ("202605", "CE", 9))
    after = rows(TABLE, ("202606", "SP", 2), ("202606", "CE", 1), ("202607", "CE", 4))
    published = rows("competence string", "202605", "202606", "202607")
    base = history.history_snapshot({"by-uf": before}, published)
    changes = {r.competence: r.after_sha256 for r in history.artifact_changes(base, history.table_snapshot(after, "by-uf")).collect()}
    assert set(changes) == {"202605", "202607"} and changes["202605"] is None
    with pytest.raises(ConsistencyError):
        history.require_complete_snapshot(base, rows("competence string", "202601"), 1)
    history.require_complete_snapshot(base, published, 1)


def evaluate(rows, adjusted, base_months, ingest="202608", changed=("202607",)):
    baseline = rows("competence string, file string, sha256 string", *[(m, "t", "a") for m in ("202606", "202607")])
    current = rows("competence string, file string, sha256 string", *[(m, "t", "b" if m in changed else "a") for m in ("202606", "202607")])
    adjustments = rows("effective_competence string", *adjusted)
    return history.evaluate_revisions(ingest, baseline, current, adjustments, rows("competence string", *base_months)), baseline, current


def test_history_evaluation(rows):
    good, baseline, current = evaluate(rows, ["202607", "bad"], ["202607"])
    row = good.collect()[0]
    assert row.passed and row.changed_published_competencies == ["202607"] and row.adjustment_effective_competencies == ["202607"]
    history.require_passed_revision(good)
    package = history.revision_package(good, history.artifact_changes(baseline, current))
    assert [(r.competence, r.before_sha256, r.after_sha256) for r in package.collect()] == [("202607", "a", "b")]

    row = evaluate(rows, ["202606"], ["202606"])[0].collect()[0]
    assert not row.passed and row.unexpected_changed_competencies == ["202607"]
    row = evaluate(rows, ["202607", "202609"], ["202607"])[0].collect()[0]
    assert not row.passed and row.future_adjustment_competencies == ["202609"]
    blocked = evaluate(rows, ["202607"], ["202601"])[0]
    assert blocked.collect()[0].missing_rebuild_baselines == ["202607"]
    with pytest.raises(NotApprovedError):
        history.require_passed_revision(blocked)
    own = evaluate(rows, ["202601"], ["202601"], ingest="202607")[0].collect()[0]
    assert own.passed, "the ingested month may change when it was published before"
    assert history.revision_package(blocked, history.artifact_changes(baseline, current)).isEmpty()


def test_apply_revision(spark, rows, tmp_path):
    path = str(tmp_path / "by_uf")
    schema = "uf string, admissions int, competence string"
    before = rows(schema, ("CE", 1, "202606"), ("CE", 3, "202607"))
    after = rows(schema, ("CE", 1, "202606"), ("CE", 4, "202607"))
    tables.replace_partitions(before, path, ["competence"])
    base = history.table_snapshot(before, "t")
    changes = history.artifact_changes(base, history.table_snapshot(after, "t"))
    verdict = rows("ingest_competence string, passed boolean, missing_rebuild_baselines array<string>", ("202608", True, []))
    package = history.revision_package(verdict, changes)
    with pytest.raises(NotApprovedError, match="published data changed"):
        history.apply_revision(verdict, package, {"t": after}, {"t": after}, {"t": path})
    with pytest.raises(NotApprovedError, match="package changed"):
        history.apply_revision(verdict, package, {"t": before}, {"t": before}, {"t": path})
    history.apply_revision(verdict, package, {"t": after}, {"t": before}, {"t": path})
    stored = spark.read.schema(schema).parquet(path)
    assert {(r.competence, r.admissions) for r in stored.collect()} == {("202606", 1), ("202607", 4)}


def test_rebuild_only_touched(spark, rows, tmp_path):
    path = str(tmp_path / "gold")
    old = rows("n bigint, competence string", (99, "202606"), (99, "202607"))
    tables.replace_partitions(old, path, ["competence"])
    silver = rows("effective_competence string", "202606", "202607", "202607")
    months = history.months_to_rebuild(rows("effective_competence string", "202607", "202601"), rows("competence string", "202606", "202607"))
    assert {(r.competence, r.has_base) for r in months.collect()} == {("202607", True), ("202601", False)}
    build = lambda df: df.groupBy(F.col("effective_competence").alias("competence")).agg(F.count(F.lit(1)).alias("n")).select("n", "competence")
    history.rebuild_months(silver, months, build, path)
    got = spark.read.schema("n bigint, competence string").parquet(path)
    assert {(r.competence, r.n) for r in got.collect()} == {("202606", 99), ("202607", 2)}


OVERVIEW = "competence string, admissions int, dismissals int, balance int, records_tech int, salary_mean_admissions double"


def serving_set(rows):
    over = rows(OVERVIEW, ("202607", 3, 1, 2, 4, 1234.567), ("202606", 1, 1, 0, 2, None))
    quality = rows("competence string, valid_rate double", ("202607", 0.9987654))
    hashes = rows("competence string, sha256 string", ("202607", "a" * 64), ("202606", "b" * 64))
    uf = rows("competence string, uf string, admissions int, dismissals int, balance int", ("202607", "ce", 2, 1, 1), ("202607", "SP", 1, 0, 1), ("202606", "CE", 1, 1, 0))
    occ = rows("competence string, cbo_familia string, cbo_codigo string, admissions int, dismissals int, balance int", ("202607", "2124", "212405", 3, 1, 2))
    mun = rows("competence string, municipio_codigo_caged string, admissions int, dismissals int, balance int", ("202607", "230440", 3, 1, 2))
    return serving.ServingTables(
        serving.serving_release(over, quality, hashes), serving.serving_states(uf),
        serving.serving_occupations(occ), serving.serving_municipalities(mun))


def test_serving_load_and_read(spark, rows, tmp_path):
    data, root = serving_set(rows), str(tmp_path)
    approved = rows("competence string, publishable boolean", ("202607", True), ("202606", True))
    with pytest.raises(NotApprovedError):
        serving.load_serving(spark, data, root, approved.where("competence = '202607'"))
    for _ in range(2):
        serving.load_serving(spark, data, root, approved)
    release, states = (spark.read.parquet(f"{root}/{t}") for t in ("dataset_release", "market_uf"))
    assert release.count() == 2 and states.count() == 3
    latest = serving.latest_release(release).collect()[0]
    assert (str(latest.competence), str(latest.salary_mean_admissions), str(latest.valid_rate)) == ("2026-07-01", "1234.57", "0.998765")
    ranked = analytics.top(serving.rows_of_latest(states, release), "admissions", "uf", 5).collect()
    assert [(r.uf, r.admissions) for r in ranked] == [("CE", 2), ("SP", 1)]
    with pytest.raises(ConsistencyError):
        tables.require_row_counts(spark, f"{root}/market_uf", data.uf.union(data.uf), "competence")


def test_serving_refuses_bad_rows(rows):
    base = "competence string, uf string, admissions int, dismissals int, balance int"
    for bad in (("202607", "CE", -1, 0, -1), ("202607", "CE", 2, 1, 2), ("202607", "CEX", 2, 1, 1), ("202613", "CE", 2, 1, 1)):
        with pytest.raises(Exception, match="negative|balance|state|month"):
            serving.serving_states(rows(base, bad)).collect()
    with pytest.raises(Exception, match="source hash"):
        serving.serving_release(rows(OVERVIEW, ("202607", 3, 1, 2, 4, 1.0)), rows("competence string, valid_rate double", ("202607", 1.0)),
                                rows("competence string, sha256 string", ("202607", "xyz"))).collect()


ITEMS = "competence string, municipio_codigo_caged string, municipio_codigo_ibge string, admissions int, dismissals int, balance int"


def test_enrichment(rows):
    items = rows(ITEMS, ("202607", "230440", "2304400", 100, 80, 20), ("202607", "999999", None, 1, 1, 0))
    people = rows("municipio_codigo_ibge string, population int", ("2304400", 2_500_000))
    enriched = serving.enrich_population(items, people, 2026)
    serving.require_enriched(items, enriched, people, minimum_entries=1)
    report = serving.enrichment_report(items, enriched, 2026, "x").collect()[0]
    assert (report.identified_municipalities, report.residual_municipalities, report.matched_population) == (1, 1, 1)
    assert report.coverage_complete and report.admissions_before == report.admissions_after == 101
    again = serving.enrich_population(enriched, people, 2026)
    assert sorted(map(str, again.collect())) == sorted(map(str, enriched.collect())), "enriching twice changes nothing"
    with pytest.raises(ConsistencyError, match="entries"):
        serving.require_enriched(items, enriched, people)
    with pytest.raises(ConsistencyError, match="no population"):
        serving.require_enriched(items, serving.enrich_population(items, people.where("false"), 2026), people, 1)
    with pytest.raises(ConsistencyError, match="totals"):
        serving.require_enriched(items, enriched.withColumn("balance", F.lit(0)), people, 1)


def test_enrichment_gate(rows):
    gates = rows("competence string, publishable boolean", ("1", True), ("2", False), ("3", False))
    checks = rows("competence string, id string, passed boolean, blocking boolean", ("1", "x", False, True),
                  ("2", "manual_methodology_approval", False, True), ("2", "note", False, False), ("3", "valid_rate", False, True))
    reasons = lambda allow: {r.competence: r.reason for r in serving.enrichment_blockers(gates, checks, allow).collect()}
    assert reasons(True) == {"1": None, "2": None, "3": "failed checks: valid_rate"}
    assert reasons(False) == {"1": None, "2": "not published", "3": "not published"}


def test_family_trend(rows):
    occ = rows("competence string, cbo_familia string, admissions int, dismissals int, balance int",
               ("202601", "2124", 10, 7, 3), ("202601", "2124", 5, 6, -1), ("202601", "3171", 4, 3, 1), ("202602", "2124", 8, 9, -1))
    months = analytics.family_months(occ, ["2124", "3171"])
    assert months.count() == 4 and months.where("competence = '202602' and cbo_familia = '3171'").collect()[0].admissions == 0
    got = {r.cbo_familia: r for r in analytics.family_trend(months).collect()}
    assert (got["2124"].admissions, got["2124"].dismissals, got["2124"].balance) == (23, 22, 1)
    assert got["2124"].share_of_tech_admissions == pytest.approx(23 / 27)
    assert [m.competence for m in got["3171"].monthly] == ["202601", "202602"]
    analytics.require_clean_occupations(occ, ["2124", "3171"])
    for bad in (("1", "9999", 1, 0, 1), ("1", "2124", -1, 0, -1), ("1", "2124", 1, 0, 2)):
        with pytest.raises(ConsistencyError):
            analytics.require_clean_occupations(occ.union(rows(occ.schema.simpleString()[7:-1].replace(":", " "), bad)), ["2124", "3171"])


def test_stock_flow(rows):
    stock = rows("cbo_familia string, active_stock int", ("2124", 100), ("3172", 50))
    flow = rows("cbo_familia string, admissions int, dismissals int, balance int", ("2124", 20, 16, 4), ("3172", 10, 8, 2))
    analytics.require_comparable(stock, flow)
    row = {r.cbo_familia: r for r in analytics.stock_flow_context(stock, flow).collect()}["2124"]
    assert (row.admissions_per_100_prior_stock, row.dismissals_per_100_prior_stock, row.balance_per_100_prior_stock) == (20.0, 16.0, 4.0)
    assert row.composition_gap_pp == pytest.approx(0.0)
    assert analytics.stock_flow_totals(analytics.stock_flow_context(stock, flow)).collect()[0].admissions_per_100_prior_stock == 20.0
    with pytest.raises(ConsistencyError):
        analytics.require_comparable(stock, flow.where("cbo_familia = '2124'"))
    with pytest.raises(ConsistencyError):
        analytics.require_comparable(stock.withColumn("active_stock", F.lit(0)), flow)
    assert {(r.cbo_familia, r.side) for r in joins.one_sided_keys(stock, flow.where("admissions = 20"), "cbo_familia").collect()} == {("3172", "left")}


def test_cube_rank_and_stock_join(rows):
    cube = rows("uf string, cbo_familia string, cbo_codigo string, saldo int", ("CE", "D", "212405", 7), ("CE", "D", "212405", -1), ("CE", "A", "212410", -2),
                ("SP", "D", "212405", 10), ("SP", "A", "212410", 4), ("RJ", "S", "317110", -2))
    stock = rows("uf string, cbo_codigo string, active_stock int", ("CE", "212405", 150), ("CE", "212410", 60), ("SP", "212405", 200), ("SP", "212410", 80), ("RJ", "317110", 20))
    assert {(r.uf, r.cbo_codigo): (r.saldo, r.active_stock) for r in analytics.stock_flow_by_code(cube, stock).collect()}[("CE", "212405")] == (6, 150)
    sums = cube.groupBy("uf", "cbo_familia").agg(F.sum("saldo").alias("saldo"))
    ranks = {(r.uf, r.cbo_familia): r["rank"] for r in analytics.rank_within(sums, "uf", "saldo", "cbo_familia").collect()}
    assert ranks == {("CE", "D"): 1, ("CE", "A"): 2, ("SP", "D"): 1, ("SP", "A"): 2, ("RJ", "S"): 1}


def test_rankings_quarters_and_territory(rows):
    table = rows("municipio_codigo_caged string, admissions int, admissions_per_100k double", ("A", 10, 1.0), ("B", 5, 2.0), ("C", 90, None), ("D", 10, 1.0))
    rank = lambda metric: [r[0] for r in analytics.rank_municipalities(table, metric, 3).collect()]
    assert rank("admissions_per_100k") == ["B", "A", "D"] and rank("admissions") == ["C", "A", "D"]
    assert analytics.rates_available(table).collect()[0][0] and not analytics.rates_available(table.where("admissions = 90")).collect()[0][0]
    with pytest.raises(ValueError):
        rank("balance")
    trend = rows("competence string, admissions int, dismissals int, balance int", ("202601", 5, 3, 2), ("202602", 5, 4, 1), ("202603", 2, 1, 1), ("202604", 1, 0, 1))
    quarters = {r.key: r for r in analytics.temporal_summary(trend).collect()}
    assert quarters["2026Q1"].complete and quarters["2026Q1"].average_monthly_balance == 1.33 and quarters["2026Q1"].label == "1º trimestre de 2026"
    assert not quarters["2026Q2"].complete and analytics.cumulative_totals(trend).collect()[0].admissions == 13
    states = rows("uf string, admissions int, dismissals int, balance int", ("CE", 10, 5, 5), ("BA", 10, 8, 2), ("SP", 80, 70, 10), ("NI", 0, 0, 0))
    got = {r.key: r for r in analytics.territorial_comparison(states).collect()}
    assert (got["BR"].admissions, got["NE"].admissions, got["CE"].share_national_admissions, got["CE"].state_share_of_region) == (100, 20, 0.1, 0.5)


def test_registry_and_codes(rows):
    gates = rows("competence string, publishable boolean, automatic_checks_passed boolean, manual_approval_valid boolean, source_sha256 string",
                 ("202607", True, True, True, "a"), ("202608", False, True, None, "b"), ("bad", True, True, True, "c"))
    registry = analytics.release_registry(gates)
    assert [(r.competence, r.manual_approval_valid) for r in registry.collect()] == [("202607", True), ("202608", False)]
    assert tuple(analytics.registry_summary(registry).collect()[0]) == (2, 1, "202607")
    assert [r[0] for r in analytics.published_months(gates).collect()] == ["202607"]
    years = rows("year int, publishable boolean", (2025, True), (1984, True), (2024, False))
    assert [r[0] for r in analytics.published_years(years).collect()] == [2025]
    occ = rows("competence string, cbo_codigo string", ("202607", "212405"), ("202608", "999999"))
    assert [r[0] for r in analytics.published_codes(occ, analytics.published_months(gates)).collect()] == ["212405"]
    with pytest.raises(Exception, match="invalid published code"):
        analytics.published_codes(occ.withColumn("cbo_codigo", F.lit("12")), analytics.published_months(gates)).collect()


def test_cells(rows):
    grid = rows("sheet string, row int, col int, kind string, value string", ("s", 1, 1, "text", " Código "), ("s", 2, 1, "text", "2124-05"),
                ("s", 3, 1, "int", "317110"), ("s", 2, 2, "float", "212405.0"), ("s", 3, 2, "int", "111111"), ("t", 1, 1, "bool", "212405"))
    expected = rows("code string", "212405", "317110", "999999")
    columns = {(r.sheet, r.col): r for r in cells.join_columns(grid, expected).collect()}
    assert set(columns) == {("s", 1), ("s", 2)}
    assert (columns[("s", 1)].matched_codes, columns[("s", 1)].header) == (["212405", "317110"], "Código")
    assert {r.code: r.matched for r in cells.code_coverage(grid, expected).collect()} == {"212405": True, "317110": True, "999999": False}
    assert [r.code for r in cells.missing_codes(grid, expected).collect()] == ["999999"]
    with pytest.raises(ConsistencyError):
        cells.require_join_column(cells.join_columns(grid, expected.where("code = '999999'")))


def test_documents(spark, rows, tmp_path):
    items = rows("competence string, source string, uf string, n int", ("202607", "s", "SP", 1), ("202607", "s", "CE", None))
    docs = documents.to_documents(items, ["competence", "source"], ["uf"])
    assert json.loads(docs.collect()[0].value) == {"competence": "202607", "source": "s", "items": [{"uf": "CE", "n": None}, {"uf": "SP", "n": 1}]}
    documents.write_documents(docs, str(tmp_path / "d"), ["competence"])
    read = documents.document_items(documents.read_documents(spark, str(tmp_path / "d")).drop("competence").withColumn("competence", F.lit("202607")))
    assert {(r.uf, r.n) for r in read.collect()} == {("CE", None), ("SP", 1)}
    (tmp_path / "m.json").write_text(json.dumps({"reference_year": 2026, "municipalities": {"2304400": 5}}))
    row = documents.read_key_values(spark, str(tmp_path / "m.json"), "municipalities", "bigint", "reference_year int").collect()[0]
    assert (row.reference_year, row.key, row.value) == (2026, "2304400", 5)
    reports = rows("kind string, competence string", ("MOV", "202607"), ("FOR", "202608"), ("MOV", "202606"))
    assert documents.latest_document(reports, "competence", "kind").collect()[0].competence == "202607"


def test_dimensions(rows):
    state = {"UF": {"sigla": "CE"}}
    payload = [
        {"id": 2304400, "nome": " Fortaleza ", "microrregiao": {"mesorregiao": state}},
        {"id": 3550308, "nome": "São Paulo", "microrregiao": None, "regiao-imediata": {"regiao-intermediaria": {"UF": {"sigla": "SP"}}}},
        {"id": 1, "nome": "x", "microrregiao": {"mesorregiao": state}}, {"id": 2304401, "nome": "", "microrregiao": {"mesorregiao": state}},
    ]
    parsed = dimensions.parse_municipalities(rows("value string", json.dumps(payload)))
    assert {(r.prefix, r.municipio_nome, r.uf) for r in parsed.collect()} == {("230440", "Fortaleza", "CE"), ("355030", "São Paulo", "SP")}
    assert dimensions.municipality_dimension(parsed.union(parsed), minimum=2).count() == 2
    with pytest.raises(ConsistencyError, match="incomplete"):
        dimensions.municipality_dimension(parsed)
    with pytest.raises(ConsistencyError, match="conflicting"):
        dimensions.municipality_dimension(parsed.union(parsed.withColumn("municipio_nome", F.lit("x"))), 1)

    series = lambda code, value: {"localidade": {"id": code}, "serie": {"2026": value}}
    people = [{"resultados": [{"series": [series("2304400", "2.500 000"), series("3550308", "..."), series("12", "5"), series("1100015", "0")]}]}]
    got = dimensions.parse_population(rows("value string", json.dumps(people)), 2026).collect()
    assert [(r.municipio_codigo_ibge, r.population) for r in got] == [("2304400", 2_500_000)]

    answer = [{"D1C": "1", "D3C": "202607", "V": "7657,73"}, {"D3C": "202613", "V": "1"}, {"D3C": "202608", "V": "..."}]
    new = dimensions.parse_price_index(rows("value string", json.dumps(answer)))
    assert [(r.month, float(r.value)) for r in new.collect()] == [("202607", 7657.73)]
    old = new.withColumn("value", F.lit(1).cast("decimal(18,6)")).union(new.withColumn("month", F.lit("202606")))
    merged = {r.month: float(r.value) for r in dimensions.upsert_price_index(old, new).collect()}
    assert merged == {"202607": 7657.73, "202606": 7657.73}
    with pytest.raises(Exception, match="positive"):
        dimensions.upsert_price_index(old, new.withColumn("value", F.lit(0).cast("decimal(18,6)"))).collect()
    dimensions.require_base_month(new, "202607")
    with pytest.raises(ConsistencyError):
        dimensions.require_base_month(new, "202601")


def test_manifests(spark, rows, tmp_path):
    (tmp_path / "CAGEDMOV202607.txt").write_bytes(b"abc")
    facts = manifests.file_facts(spark, str(tmp_path))
    row = manifests.build_manifests(facts, F.lit("s"), F.lit("202607"), F.lit("t")).collect()[0]
    assert (row.original_name, row.size_bytes) == ("CAGEDMOV202607.txt", 3)
    assert row.sha256 == "ba7816bf8f01cfea414140de5dae2223b00361a396177a9cb410ff61f20015ad"
    for name, at in (("a", "2026-01-01"), ("b", "2026-02-01")):
        (tmp_path / f"{name}.manifest.json").write_text(json.dumps({"source": "novo_mov", "competence": "202607", "original_name": name, "sha256": name, "ingested_at_utc": at}))
    stored = manifests.read_manifests(spark, str(tmp_path))
    assert manifests.latest_mov_manifests(stored).collect()[0].original_name == "b"
    assert tuple(manifests.manifest_coverage(stored).collect()[0]) == (2, ["202607"])
    new = rows("original_name string, sha256 string", ("a", "a"), ("b", "other"), ("c", "c"))
    decisions = manifests.ingest_decisions(new, stored)
    assert {r.original_name: r.action for r in decisions.collect()} == {"a": "skip", "b": "conflict", "c": "ingest"}
    with pytest.raises(ConsistencyError):
        manifests.require_no_conflict(decisions)
    kept = manifests.artifact_provenance(rows("original_name string", "by-uf-202607.json", "by-uf-202608.json"), rows("competence string", "202607"))
    assert [r.original_name for r in kept.collect()] == ["by-uf-202607.json"]


def test_part_manifests(rows):
    schema = "year int, files array<struct<competence:string,comptence:string,path:string,sha256:string,transport:string>>"
    sha = "a" * 64
    clean = rows(schema, (2025, [("2025", None, "x", sha, "ftp")]), (2025, [(None, "2025", "y", sha, None)]), (2025, [(None, None, "z", sha, "ftp")]))
    merged = manifests.merge_part_manifests(clean, 2025)
    manifests.require_clean_entries(merged)
    assert {r.competence for r in merged.collect()} == {"2025"}
    assert tuple(manifests.merged_transport(merged).collect()[0]) == ("mixed", ["ftp", "unknown"])
    bad = rows(schema, (2024, [("2025", None, "x", sha, None)]), (2025, []), (2025, [("2024", None, "y", sha, None)]),
               (2025, [("2025", None, "z", "short", None)]), (2025, [("2025", None, "w", sha, None)]), (2025, [("2025", None, "w", sha, None)]))
    problems = sorted(r.problem for r in manifests.merge_part_manifests(bad, 2025).collect())
    assert problems == ["incomplete provenance", "not exactly one file", "other month", "other year", "repeated file", "repeated file"]
    with pytest.raises(ConsistencyError):
        manifests.require_clean_entries(manifests.merge_part_manifests(bad, 2025))
    pieces = rows("kind string, year int", *[(k, 2025) for k in ("quality", "silver", "reject", "manifest") for _ in range(7)])
    assert manifests.part_set_problems(pieces, 2025).collect()[0].complete
    assert not manifests.part_set_problems(pieces.union(rows("kind string, year int", ("silver", 2025))), 2025).collect()[0].complete
    assert not manifests.part_set_problems(rows("kind string, year int", *[(k, 2025) for k in ("quality", "silver", "reject", "manifest")]), 2025).collect()[0].complete


def test_csv_export(spark, rows, tmp_path):
    one, two = rows("uf string, n int", ("=x", -1)), rows("uf string, m int", ("CE", 2))
    table = csv_export.union_of_items([one, two])
    assert table.columns == ["uf", "n", "m"]
    csv_export.write_csv(table.coalesce(1), str(tmp_path / "out"))
    body = next((tmp_path / "out").glob("*.csv")).read_bytes()
    assert body.startswith(b"\xef\xbb\xbfuf,n,m\n") and b"'=x,-1," in body


def test_materialize_uses_the_shared_folder(spark, rows):
    root = spark.conf.get("spark.checkpoint.dir", None)
    df = tables.materialize(rows("a int, b string", (1, "x"), (2, "y")), "test", ["b"])
    assert sorted((r.a, r.b) for r in df.collect()) == [(1, "x"), (2, "y")]
    if root:
        assert root.rstrip("/") in df.inputFiles()[0]


def test_schema_guard(rows):
    with pytest.raises(LayoutError):
        tables.union_parts([rows("a int", 1), rows("a bigint", 1)])


def test_file_digests_of_any_bytes(spark, tmp_path):
    import gzip
    import hashlib
    import random

    dice = random.Random(6)
    contents = {
        "empty": b"", "line": b"a\n", "open": b"a", "breaks": b"\n\n", "crlf": b"a\r\nb\r", "mark": b"\xef\xbb\xbfa\nb", "mark only": b"\xef\xbb\xbf", "mark line": b"\xef\xbb\xbf\n", "twice": b"\xef\xbb\xbf\xef\xbb\xbf",
        "bytes[1]+%20": dice.randbytes(300_000), "long line": b"x" * 3_000_000 + b"\ny", "many lines": b"abc\n" * 200_000, "a.gz": gzip.compress(b"packed\n"), "d/e.7z": dice.randbytes(50_000) + b"\n",
    }
    for name, data in contents.items():
        (tmp_path / "f" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "f" / name).write_bytes(data)
    (tmp_path / "f" / "_SUCCESS").write_bytes(b"")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 1000)
    try:
        found = {r.path.split("/f/")[1]: (r.original_name, r.size_bytes, r.sha256) for r in manifests.file_digests(spark, str(tmp_path / "f")).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert found == {n: (n.split("/")[-1], len(d), hashlib.sha256(d).hexdigest()) for n, d in contents.items()}
