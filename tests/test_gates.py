from datetime import date

import pytest
from pyspark.sql import functions as F

from jobtide.errors import ConsistencyError, NotApprovedError
from jobtide.operators import checks, deployment, gates, official

SHA = "a" * 64


@pytest.fixture
def month(rows):
    """Complete, consistent inputs of one month; tests break one thing at a time."""
    m = "202607"
    return {
        "quality": rows("competence string, rows_read int, rows_valid int, rows_rejected int, valid_rate double", (m, 100, 99, 1, 0.99)),
        "overview": rows("competence string, admissions int, dismissals int, balance int", (m, 10, 4, 6)),
        "market": rows("competence string", m),
        "audit": rows(
            "competence string, admissions int, dismissals int, balance int, non_identified_admissions int,"
            " non_identified_dismissals int, non_identified_balance int", (m, 50, 40, 10, 3, 2, 1)),
        "items": rows(
            "competence string, municipio_codigo_caged string, municipio_codigo_ibge string, municipio_nome string, uf string,"
            " admissions int, dismissals int, balance int, population_estimate int, population_reference_year int,"
            " admissions_per_100k double, dismissals_per_100k double, balance_per_100k double",
            (m, "230440", "2304400", "Fortaleza", "CE", 9, 3, 6, 2_500_000, 2026, 0.36, 0.12, 0.24),
            (m, "999999", None, "Não identificado", "NI", 1, 1, 0, None, 2026, None, None, None)),
        "manifests": rows("competence string, sha256 string", (m, SHA)),
        "official": rows(
            "competence string, admissoes int, desligamentos int, saldo int, ni_admissoes int, ni_desligamentos int, ni_saldo int,"
            " reference_sha256 string", (m, 50, 40, 10, 3, 2, 1, "r")),
        "approvals": rows("competence string, approved boolean, source_sha256 string, reference_sha256 string", (m, True, SHA, "r")),
        "population_header": rows(
            "competence string, source string, reference_year int, reference_date string, source_url string, published_at string,"
            " cache_sha256 string, enrichment_status string, artifact_sha256 string",
            (m, "IBGE", 2026, "2026-07-01", "https://x", "2026-08-28", SHA, "complete", "art")),
        "enrichment": rows(
            "competence string, coverage_complete boolean, population_year int, population_cache_sha256 string,"
            " municipality_artifact_sha256 string, matched_population bigint, missing_population bigint",
            (m, True, 2026, SHA, "art", 1, 0)),
    }


def judge(rows, inputs):
    inputs = dict(inputs)
    facts = gates.municipality_facts(inputs.pop("items"))
    result = gates.monthly_gate(rows("competence string", "202607"), municipality=facts, **inputs)
    failed = {r.id for r in result.where("not passed").collect()}
    return failed, checks.gate_summary(result, ["competence"]).collect()[0]


def test_clean_month_is_publishable(rows, month):
    failed, summary = judge(rows, month)
    assert failed == set() and summary.publishable and summary.checks_total == 19


@pytest.mark.parametrize(
    ("table", "column", "value", "expected"),
    [
        ("quality", "valid_rate", 0.98, "valid_rate"),
        ("quality", "rows_valid", 101, "quality_counts"),
        ("overview", "balance", 7, "overview_arithmetic"),
        ("audit", "admissions", 51, "national_reference_reconciliation"),
        ("audit", "non_identified_balance", 0, "non_identified_reconciliation"),
        ("manifests", "sha256", None, "mov_provenance"),
        ("approvals", "source_sha256", "other", "manual_methodology_approval"),
        ("approvals", "reference_sha256", "other", "manual_methodology_approval"),
        ("items", "uf", "XXX", "municipality_dimension_quality"),
        ("items", "admissions_per_100k", 0.37, "municipality_population_coverage"),
        ("items", "population_reference_year", 2025, "municipality_population_coverage"),
        ("population_header", "reference_date", "2026-01-01", "municipality_population_metadata"),
        ("enrichment", "municipality_artifact_sha256", "old", "municipality_population_report"),
    ],
)
def test_one_defect_blocks(rows, month, table, column, value, expected):
    df = month[table]
    month[table] = df.withColumn(column, F.lit(value).cast(df.schema[column].dataType))
    failed, summary = judge(rows, month)
    assert expected in failed and not summary.publishable


def test_missing_artifacts(rows, month):
    month["official"] = month["official"].where("false")
    month["quality"] = month["quality"].where("false")
    failed, summary = judge(rows, month)
    assert {"official_reference_available", "quality_report", "manual_methodology_approval"} <= failed
    assert "quality_counts" not in failed and not summary.automatic_checks_passed


def test_approval_is_bound_and_latest_wins(rows):
    hashes = rows("competence string, source_sha256 string, reference_sha256 string", ("202607", SHA, "r"), ("202608", None, "r"))
    record = gates.approval_record("competence", "202607", "R", "ok", hashes).collect()[0]
    assert record.approved and record.source_sha256 == SHA
    assert gates.approval_record("competence", "202608", "R", "ok", hashes).isEmpty()
    both = rows("competence string, reviewer string, approved_at_utc string", ("202607", "a", "2026-01-01"), ("202607", "b", "2026-02-01"))
    assert gates.current_approvals(both, "competence").collect()[0].reviewer == "b"


def test_gate_document_roundtrip(rows, month):
    facts = gates.municipality_facts(month["items"])
    inputs = {k: v for k, v in month.items() if k != "items"}
    result = gates.monthly_gate(rows("competence string", "202607"), municipality=facts, **inputs)
    document = checks.gate_documents(result, ["competence"])
    assert checks.gate_is_clean(document, ["competence"]).collect()[0].clean
    checks.require_passed(result)
    with pytest.raises(ConsistencyError):
        checks.require_passed(result.withColumn("passed", F.lit(False)))


GATE = "kind string, file_key string, key string, publishable boolean, automatic_checks_passed boolean, manual_approval_valid boolean,"
GATE += " checks array<struct<id:string,passed:boolean,blocking:boolean>>"


def test_deployment(rows):
    good = [("x", True, True), ("note", False, False)]
    stored = rows(
        GATE,
        ("monthly", "202607", "202607", True, True, True, good),
        ("monthly", "202608", "202607", True, True, True, good),
        ("monthly", "202606", "202606", True, True, True, [("x", True, True), ("x", True, True)]),
        ("monthly", "202605", "202605", True, True, True, []),
        ("annual", "2025", "2025", True, True, True, [("x", True, None)]),
    )
    paths = lambda *names: rows("path string", *names)
    ok = paths("data/gold/by-uf-202607.json", "docs/by-uf-209901.json", "data/gold/trend.json")
    decision = deployment.deployment_decision(deployment.deployment_reasons(ok, stored)).collect()[0]
    assert decision.eligible and decision.monthly == ["202607"] and decision.annual == []
    bad = paths(*[f"data/gold/overview-{m}.json" for m in ("202605", "202606", "202608", "202609")], "data/gold/rais-by-uf-2025.json")
    reasons = {r.key: r.reason for r in deployment.deployment_reasons(bad, stored).collect()}
    assert reasons == {
        "202605": "release is not publishable yet", "202606": "release is not publishable yet", "202608": "gate is for another release",
        "202609": "gate is missing", "2025": "release is not publishable yet",
    }
    assert deployment.deployment_decision(deployment.deployment_reasons(paths("README.md"), stored)).collect()[0].eligible


def test_annual_gate(rows):
    facts = rows(
        "year int, source_hashes array<string>, reconciled boolean, gold_ready boolean, difference int, expected_active int,"
        " regional_reconciled boolean, regional_difference int, regional_groups int, municipality_ready boolean, unmatched_codes int,"
        " uf_mismatch_rows int, active_stock_tech int, active_stock_national_reference int, publication_ready boolean, uf_total int,"
        " family_total int, municipality_total int, market_total int, release_sha256 string, approval_approved boolean, approval_release_sha256 string",
        (2025, [SHA] * 7, True, True, 0, 100, True, 0, 7, True, 0, 0, 10, 100, False, 10, 10, 10, 10, "f", True, "f"),
    )
    fails = lambda df: {r.id for r in gates.annual_gate(df).where("not passed").collect()}
    assert fails(facts) == set() and gates.annual_gate(facts).count() == 21
    assert checks.gate_summary(gates.annual_gate(facts), ["year"]).collect()[0].publishable
    change = lambda name, value: facts.withColumn(name, F.lit(value).cast(facts.schema[name].dataType))
    assert fails(change("regional_groups", 6)) == {"exact_regional_reconciliation"}
    assert fails(facts.withColumn("source_hashes", F.slice("source_hashes", 1, 6))) == {"source_provenance"}
    assert fails(change("uf_total", 9)) == {"uf_total"}
    assert fails(change("publication_ready", True)) == {"pre_gate_publication_block"}
    assert fails(change("active_stock_national_reference", 99)) == {"overview_stock_integrity"}
    assert fails(change("approval_release_sha256", "g")) == {"manual_methodology_approval"}
    assert fails(change("municipality_total", None)) == {"artifact_by_municipality"}
    assert fails(change("release_sha256", None)) == {"release_fingerprint", "manual_methodology_approval"}


def level_rows(rows, north=(5, 3, 2)):
    return rows(
        "competence string, level string, name string, admissions int, dismissals int, balance int",
        ("m", "national", "BR", 11, 7, 4), ("m", "region", "N", *north), ("m", "region", "S", 5, 3, 2),
        ("m", "state", "A", 2, 1, 1), ("m", "state", "B", 3, 2, 1), ("m", "state", "C", 5, 3, 2), ("m", "non_identified", "NI", 1, 1, 0),
    )


def test_official_reference(rows):
    states = {"N": ["A", "B"], "S": ["C"]}
    salary = rows(
        "competence string, minimum_wage_brl double, minimum_multiple double, maximum_multiple double, minimum_salary_brl double,"
        " maximum_salary_brl double, exclude_intermittent boolean", ("m", 1621.0, 0.3, 150.0, 486.3, 243150.0, True))
    fails = lambda t, s=salary: {r.id for r in official.official_reference_checks(t, s, ["competence"], states).where("not passed").collect()}
    assert fails(level_rows(rows)) == set()
    assert fails(level_rows(rows, (6, 4, 2))) == {"regions_equal_sum_of_ufs"}
    assert fails(level_rows(rows, (5, 3, 1))) == {"regions_equal_sum_of_ufs", "region_arithmetic"}
    assert fails(level_rows(rows), salary.withColumn("minimum_salary_brl", F.lit(480.0))) == {"salary_methodology"}
    assert fails(level_rows(rows).where("name <> 'NI'")) == {"national_equals_ufs_plus_unidentified"}


@pytest.fixture
def registered(rows):
    def make(*months):
        return rows(
            "competence string, reference_kind string, source string, source_url string, published_at string, admissoes int,"
            " desligamentos int, saldo int, reference_sha256 string",
            *[(m, "published_monthly_mov", "s", "u", at, 10, 4, 6, f"sha-{m}") for m, at in months])
    return make


def decide(rows, published, official_rows, **kw):
    months = rows("competence string", *published) if published else rows("competence string", "x").where("false")
    return official.next_month_decision(months, official_rows, date(2026, 9, 1), **kw).collect()[0]


def test_next_month(rows, registered):
    refs = registered(("202606", "2026-07-28"), ("202607", "2026-08-28"), ("202608", "2026-09-28"))
    row = decide(rows, ["202606"], refs)
    assert (row.ready, row.reason, row.candidate, row.next_expected, row.reference_published_at) == (True, "ready", "202607", "202607", "2026-08-28")
    row = decide(rows, ["202606", "202607"], refs)
    assert (row.ready, row.reason, row.candidate, row.reference_published_at) == (False, "reference_not_effective_yet", None, "2026-09-28")
    assert decide(rows, ["202608"], refs).reason == "official_reference_not_registered"
    assert decide(rows, ["202604"], refs).reason == "reference_gap"
    assert decide(rows, ["202606"], refs, max_month="202606").reason == "coverage_policy_locked"
    first = decide(rows, [], refs)
    assert (first.reason, first.candidate, first.next_expected, first.latest_published) == ("ready", "202606", "202606", None)
    assert decide(rows, [], registered(("202608", "2026-09-28"))).reason == "official_reference_not_registered"
    locked = decide(rows, [], refs, max_month="202605")
    assert (locked.reason, locked.next_expected, locked.candidate) == ("coverage_policy_locked", "202606", None)
    assert decide(rows, ["202512"], registered(("202601", "2026-02-28"))).candidate == "202601"


def test_revised_reference_comes_first(rows, registered):
    refs = registered(("202605", "2026-06-28"), ("202606", "2026-07-28"), ("202607", "2026-08-28"))
    approvals = rows("competence string, reference_sha256 string", ("202605", "old"), ("202606", "sha-202606"))
    row = decide(rows, ["202605", "202606"], refs, approvals=approvals)
    assert (row.reason, row.candidate, row.next_expected) == ("published_reference_revision", "202605", "202607")


def test_requested_month(rows, registered):
    refs = registered(("202606", "2026-07-28"), ("202607", "2026-08-28"))
    published, today = rows("competence string", "202606"), date(2026, 9, 1)
    decision = official.next_month_decision(published, refs, today)
    assert official.require_auditable("202607", decision, published, refs, today).collect()[0].candidate == "202607"
    again = official.require_auditable("202606", decision, published, refs, today, allow_published=True).collect()[0]
    assert (again.reason, again.next_expected) == ("published_reaudit", "202607")
    for month, allowed in (("202606", False), ("202608", True)):
        with pytest.raises(NotApprovedError):
            official.require_auditable(month, decision, published, refs, today, allow_published=allowed)


def test_reference_problems(rows, registered):
    sound = registered(("202607", "2026-08-28"))
    problem = lambda **kw: official.reference_problems(sound.withColumns({k: F.lit(v) for k, v in kw.items()})).collect()[0].problem
    assert problem() is None
    assert problem(competence="2026") == "invalid month" and problem(reference_kind="x") == "not a monthly publication"
    assert problem(source_url=" ") == "no source_url" and problem(admissoes=0) == "invalid totals"
    assert problem(saldo=7) == "inconsistent balance" and problem(published_at="soon") == "invalid published_at"


def test_month_gaps(rows):
    got = official.month_gaps(rows("competence string", "202511", "202512", "202602", "202602", "202604")).collect()
    assert sorted((r.competence, r.next_expected) for r in got) == [("202512", "202601"), ("202602", "202603")]
