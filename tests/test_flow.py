import random

import pytest
from pyspark.sql import functions as F

from jobtide.errors import ConsistencyError, LayoutError
from jobtide.functions.movement import with_adjustment_deltas
from jobtide.functions.salary import SalaryRule, with_salary_eligibility
from jobtide.operators import flow_gold, quality
from jobtide.operators.flow_silver import flow_silver, route_flow
from jobtide.plans.monthly import MonthlyFile, MonthlySettings, build_gold, build_reports, build_silver, read_silver
from jobtide.sources.flow_text import read_flow

HEADER = (
    "competência Mov;UF;Município;saldo movimentação;CBO 2002 Ocupação;tipo movimentação;salário;Ind Trab Intermitente\n"
)
NINE_ROWS = HEADER + (
    "202607;23;230440;1;212405;10;4500,00;0\n"
    "202607;23;230440;-1;212405;31;4200,00;0\n"
    "202607;35;355030;1;317110;10;6000,00;0\n"
    "202607;35;355030;1;513440;10;1900,00;0\n"
    "202607;99;999999;1;212405;10;3500,00;0\n"
    "202607;23;230440;1;212405;10;400,00;0\n"
    "202607;23;230440;1;212405;10;8000,00;1\n"
    "202607;77;777777;1;212405;10;8000,00;0\n"
    "202607;23;230440;1;XX;10;8000,00;0\n"
)
FAMILIES = ["2124", "3171"]
GOLD = (
    "uf string, municipio_codigo_caged string, cbo_familia string, cbo_codigo string, "
    "indicador_trabalho_intermitente string, saldo_movimentacao int, salario_mensal double"
)


def write(tmp_path, name, text, encoding="utf-8"):
    path = tmp_path / name
    path.write_bytes(text.encode(encoding))
    return str(path)


def test_nine_rows_end_to_end(spark, tmp_path):
    silver = flow_silver(read_flow(spark, write(tmp_path, "m.txt", NINE_ROWS), "202607"))
    report = quality.flow_quality(silver, FAMILIES).collect()[0]
    assert (report.rows_read, report.rows_valid, report.rows_rejected, report.rows_tech) == (9, 7, 2, 6)
    assert (report.invalid_uf, report.invalid_cbo, report.invalid_saldo, report.invalid_salary) == (1, 1, 0, 0)
    assert report.non_identified_uf_rows == 1 and report.valid_rate == round(7 / 9, 8)
    audit = quality.national_audit(silver).collect()[0]
    assert (audit.rows, audit.admissions, audit.dismissals, audit.balance) == (9, 8, 1, 7)
    assert (audit.non_identified_admissions, audit.non_identified_balance) == (1, 1)

    scope = route_flow(silver, FAMILIES).scope
    first = scope.where("uf = 'CE' and saldo_movimentacao = 1 and salario_mensal = 4500")
    late, back = (with_adjustment_deltas(first, kind) for kind in ("FOR", "EXC"))
    rows = flow_gold.contributing_rows(scope, [late, back], "202607")
    gold = flow_gold.overview(with_salary_eligibility(rows, SalaryRule(), "202607"), []).collect()[0]
    assert (gold.admissions, gold.dismissals, gold.balance) == (5, 1, 4)
    assert gold.salary_eligible_admissions == 3 and gold.salary_excluded_admissions == 2
    assert gold.records_tech == 8


def test_adjustments_net_per_salary(rows):
    ce = ("CE", "230440", "2124", "212405", "0")
    base = rows(GOLD, (*ce, 1, 3000.0), (*ce, 1, 5000.0), (*ce, -1, 4500.0))
    late = with_adjustment_deltas(rows(GOLD, (*ce, 1, 7000.0)), "FOR").withColumn("effective_competence", F.lit("202607"))
    back = with_adjustment_deltas(rows(GOLD, (*ce, 1, 3000.0)), "EXC").withColumn("effective_competence", F.lit("202607"))
    other = back.withColumn("effective_competence", F.lit("202606"))
    data = flow_gold.contributing_rows(base, [late, back, other, base], "202607")
    row = flow_gold.group_table(with_salary_eligibility(data, SalaryRule(), "202607"), ["uf"]).collect()[0]
    assert (row.admissions, row.dismissals, row.balance) == (2, 1, 1)
    assert (row.salary_mean_admissions, row.salary_median_admissions) == (6000.0, 6000.0)
    kinds = {r.adjustment_kind: r for r in flow_gold.adjustment_breakdown(data).collect()}
    assert {k: r.rows for k, r in kinds.items()} == {"MOV": 3, "FOR": 1, "EXC": 1}
    assert kinds["EXC"].admissions_delta == -1


def test_salary_rule_in_overview(rows):
    ce = ("CE", "230440", "2124", "212405")
    data = rows(GOLD, *[(*ce, mark, sign, pay) for mark, sign, pay in [
        ("0", 1, 1000.0), ("0", 1, 5000.0), ("0", 1, 400.0), ("1", 1, 8000.0), ("0", -1, 9000.0)]])
    data = with_salary_eligibility(flow_gold.contributing_rows(data, [], "202607"), SalaryRule(), "202607")
    row = flow_gold.overview(data, []).collect()[0]
    assert (row.salary_eligible_admissions, row.salary_excluded_admissions) == (2, 2)
    assert (row.salary_mean_admissions, row.salary_median_admissions) == (3000.0, 3000.0)


def brute_median(values):
    flat = sorted(v for v, w in values.items() for _ in range(max(w, 0)))
    n = len(flat)
    return None if not n else (flat[(n - 1) // 2] + flat[n // 2]) / 2


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_weighted_median_against_brute_force(rows, seed):
    rng = random.Random(seed)
    data = [(rng.choice("ab"), float(rng.randint(1, 9)), rng.randint(-2, 4)) for _ in range(200)]
    expected = {}
    for key in "ab":
        net = {}
        for k, v, w in data:
            if k == key:
                net[v] = net.get(v, 0) + w
        expected[key] = brute_median(net)
    got = flow_gold.weighted_median(rows("k string, v double, w int", *data), ["k"], "v", "w").collect()
    assert {r.k: r.weighted_median for r in got} == expected


def test_median_examples(rows):
    median = lambda *v: flow_gold.weighted_median(rows("v double, w int", *v), [], "v", "w").collect()[0].weighted_median
    assert median((5000.0, 1), (7000.0, 1)) == 6000.0
    assert median((1.0, 3), (9.0, 2), (11.0, 1)) == 5.0


def test_group_without_eligible_rows_and_null_key(rows):
    data = rows(GOLD, (None, "1", "2124", "212405", "0", -1, 10.0), ("CE", "1", "2124", "212405", None, 1, 5000.0))
    data = with_salary_eligibility(flow_gold.contributing_rows(data, [], "202607"), SalaryRule(), "202607")
    got = {r.uf: r for r in flow_gold.group_table(data, ["uf"]).collect()}
    assert got[None].dismissals == 1 and got[None].salary_mean_admissions is None
    assert got["CE"].salary_eligible_admissions == 0 and got["CE"].salary_median_admissions is None


def test_all_grains_equal_single_tables(rows):
    rng = random.Random(5)
    data = rows(GOLD, *[
        (rng.choice(["CE", "SP", None]), rng.choice("12"), "2124", rng.choice(["212405", "212410"]), rng.choice("01"),
         rng.choice([1, -1]), float(rng.randint(400, 420))) for _ in range(300)])
    data = with_salary_eligibility(flow_gold.contributing_rows(data, [], "202607"), SalaryRule({2026: 1360.0}), "202607")
    tables = flow_gold.group_tables(data, common=["effective_competence"])
    for name, keys in flow_gold.GRAINS.items():
        single = flow_gold.group_table(data, ["effective_competence", *keys])
        joint = flow_gold.grain_of(tables, name, ["effective_competence"]).select(*single.columns)
        assert sorted(map(str, joint.collect())) == sorted(map(str, single.collect())), name


def test_guards(rows):
    bad = rows("admissions int, dismissals int, balance int", (-1, 0, -1))
    with pytest.raises(ConsistencyError):
        flow_gold.require_no_negative_groups(bad)
    with pytest.raises(ConsistencyError):
        flow_gold.require_balanced(rows("admissions int, dismissals int, balance int", (2, 1, 0)))
    flow_gold.require_balanced(rows("admissions int, dismissals int, balance int", (2, 1, 1)))


def test_null_flags(spark, tmp_path):
    text = HEADER + "202607;N/A;230440;1;212405;10;1,00;0\n202607;23;230440;x;212405;10;1,00;0\n202607;NA;1;1;XX;10;1,00;0\n"
    rows = read_flow(spark, write(tmp_path, "n.txt", text), "202607")
    kept = route_flow(flow_silver(rows))
    assert (kept.valid.count(), kept.rejected.count()) == (0, 3)
    as_read = route_flow(flow_silver(rows, null_flags="reference"))
    # Two rows with an unknown flag are in neither table; the third has a definite error as well.
    assert (as_read.valid.count(), as_read.rejected.count()) == (0, 1)


def test_text_scan_rules(spark, tmp_path):
    lossy = (HEADER + "202607;23;230440;1;212405;10;1,00;0\n").encode("utf-8").replace(b"230440", b"230440\xff")
    path = tmp_path / "lossy.txt"
    path.write_bytes(lossy)
    assert flow_silver(read_flow(spark, str(path), "202607")).select("municipio_codigo_caged").collect()[0][0] == "230440"
    ragged = write(tmp_path, "ragged.txt", HEADER + "202607;23;230440\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        read_flow(spark, ragged, "202607").select("uf_codigo").collect()
    with pytest.raises(LayoutError, match="salario"):
        read_flow(spark, write(tmp_path, "short.txt", "competência Mov;UF\n1;2\n"), "202607")
    extra = write(tmp_path, "extra.txt", HEADER.replace("\n", ";Nova Coluna\n") + "202607;23;230440;1;212405;10;1,00;0;x\n")
    assert "novacoluna" in read_flow(spark, extra, "202607").columns


def test_monthly_pipeline(spark, tmp_path):
    """Three files of two ingest months: the late row and the retraction change July, August's base is unaffected."""
    late = NINE_ROWS.splitlines()
    header = late[0] + ";Competência Dec\n"
    files = [
        MonthlyFile(write(tmp_path, "mov7.txt", NINE_ROWS), "202607"),
        MonthlyFile(write(tmp_path, "mov8.txt", NINE_ROWS.replace("202607", "202608")), "202608"),
        MonthlyFile(write(tmp_path, "for8.txt", header + "202607;23;230440;1;212405;10;4500,00;0;202608\n"), "202608", "FOR"),
        MonthlyFile(write(tmp_path, "exc8.txt", header + "202607;23;230440;1;212405;10;4500,00;0;202608\n"), "202608", "EXC"),
        MonthlyFile(write(tmp_path, "for8b.txt", header + "202601;23;230440;1;212405;10;4500,00;0;202608\n"), "202608", "FOR"),
    ]
    root, settings = str(tmp_path / "out"), MonthlySettings(families={"2124": "a", "3171": "b"})
    build_silver(spark, files, root, settings)
    build_reports(spark, root, settings)
    assert read_silver(spark, root).count() == 21
    gold = build_gold(spark, root, settings)
    totals = {r.competence: r for r in flow_gold.grain_of(gold, "overview", ["competence"]).collect()}
    assert set(totals) == {"202607", "202608"}, "an adjustment to a month without base rows waits"
    assert (totals["202607"].admissions, totals["202607"].dismissals, totals["202607"].records) == (5, 1, 8)
    assert (totals["202608"].admissions, totals["202608"].records) == (5, 6)
    quality_rows = spark.read.parquet(f"{root}/adjustment_quality").collect()
    assert {(r.file_kind, tuple(r.effective_competencies)) for r in quality_rows} == {
        ("FOR", ("202601", "202607")), ("EXC", ("202607",))}


def test_municipality_and_population(rows):
    table = rows("municipio_codigo_caged string, admissions int, dismissals int, balance int",
                 ("230440", 100, 80, 20), ("999999", 5, 1, 4), ("111111", 1, 0, 1))
    dim = rows("prefix string, municipio_codigo_ibge string, municipio_nome string, uf string", ("230440", "2304400", "Fortaleza", "CE"))
    people = rows("municipio_codigo_ibge string, population int", ("2304400", 2_500_000))
    named = flow_gold.with_municipality(table, dim)
    got = {r.municipio_codigo_caged: r for r in flow_gold.with_population_rates(named, people, 2026).collect()}
    city = got["230440"]
    assert (city.admissions_per_100k, city.dismissals_per_100k, city.balance_per_100k) == (4.0, 3.2, 0.8)
    assert (got["999999"].municipio_nome, got["999999"].uf, got["999999"].admissions_per_100k) == ("Não identificado", "NI", None)
    assert got["111111"].municipio_nome is None and got["111111"].population_estimate is None


def test_base_file_without_scope_rows(spark, tmp_path):
    """A month whose base file has no row in scope still takes its late rows; an earlier year without base waits."""
    other = HEADER + "202607;23;230440;1;513440;10;1900,00;0\n"
    header = HEADER.replace("\n", ";Competência Dec\n")
    late = header + "202607;23;230440;1;212405;10;4500,00;0;202608\n201912;23;230440;1;212405;10;4500,00;0;202608\n"
    files = [
        MonthlyFile(write(tmp_path, "mov7.txt", other), "202607"),
        MonthlyFile(write(tmp_path, "for8.txt", late), "202608", "FOR"),
    ]
    root, settings = str(tmp_path / "out"), MonthlySettings(families={"2124": "a"})
    build_silver(spark, files, root, settings)
    rows = flow_gold.grain_of(build_gold(spark, root, settings), "overview", ["competence"]).collect()
    assert [(r.competence, r.admissions, r.salary_median_admissions) for r in rows] == [("202607", 1, 4500.0)]
