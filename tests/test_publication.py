"""From files to a published release: late files, blocked months, loads that fail, and rebuilds that read only what they need."""

import pytest
from pyspark.sql import functions as F

from jobtide.errors import ConsistencyError, LayoutError, NotApprovedError
from jobtide.plans import monthly
from jobtide.plans.monthly import MonthlyFile, MonthlySettings
from jobtide.sources import releases

NAMES = "competência Mov;UF;município;saldo movimentação;cbo2002ocupação;tipo movimentação;salário;indtrabintermitente;Competência Dec\n"
SETTINGS = MonthlySettings(families={"2124": "a", "3171": "b"})


def flow_file(tmp_path, name, month, *rows):
    path = tmp_path / name
    path.write_text(NAMES + "".join(f"{m};{uf};230440;{sign};{cbo};10;4500,00;0;{month}\n" for m, uf, sign, cbo in rows), encoding="utf-8")
    kind = name[:3].upper()
    return MonthlyFile(str(path), month, kind)


def hires(gold):
    return {r.competence: r.admissions for r in gold.where("grain = 'overview'").collect()}


def test_from_files_to_release(spark, tmp_path, rows):
    root, shop = str(tmp_path / "out"), str(tmp_path / "release")
    first = [flow_file(tmp_path, f"mov{m}.txt", f"20260{m}", *[(f"20260{m}", "23", 1, "212405")] * m, (f"20260{m}", "35", -1, "317110"), (f"20260{m}", "23", "x", "212405")) for m in (5, 6, 7)]
    touched = monthly.build_silver(spark, first, root, SETTINGS)
    assert touched == ["202605", "202606", "202607"]
    monthly.build_reports(spark, root, SETTINGS)
    assert hires(monthly.update_gold(spark, root, SETTINGS, touched)) == {"202605": 5, "202606": 6, "202607": 7}
    gates = rows("competence string, publishable boolean", ("202605", True), ("202606", True), ("202607", False))
    files = rows("competence string, sha256 string", *[(f"20260{m}", str(m) * 64) for m in (5, 6, 7, 8)])
    with pytest.raises(NotApprovedError, match="202607"):
        monthly.publish_months(spark, root, shop, gates, files, touched)
    assert releases.current_parts(spark, shop) == []
    assert monthly.publish_months(spark, root, shop, gates, files, ["202605", "202606"]) == 1

    # A late file of August touches June, and January, which has no base.
    late = flow_file(tmp_path, "for8.txt", "202608", ("202606", "35", 1, "317110"), ("202601", "35", 1, "317110"))
    gone = flow_file(tmp_path, "exc8.txt", "202608", ("202605", "23", 1, "212405"))
    touched = monthly.build_silver(spark, [late, gone], root, SETTINGS)
    assert touched == ["202601", "202605", "202606", "202608"]
    monthly.build_reports(spark, root, SETTINGS)
    june = monthly.silver_of_months(spark, root, ["202606"])
    assert {(r.ingest_competence, r.file_kind) for r in june.select("ingest_competence", "file_kind").distinct().collect()} == {("202606", "MOV"), ("202608", "FOR")}
    scan = next(x for x in june._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan parquet" in x)
    assert "202608" in scan.split("PartitionFilters: ")[1].split("PushedFilters")[0], "other partitions are not listed"
    assert hires(monthly.update_gold(spark, root, SETTINGS, touched)) == {"202605": 4, "202606": 7}
    assert hires(monthly.read_gold(spark, root)) == {"202605": 4, "202606": 7, "202607": 7}
    kept = monthly.read_gold(spark, root)
    updated = sorted(map(str, kept.select(sorted(kept.columns)).collect()))
    whole = monthly.build_gold(spark, root, SETTINGS)
    assert updated == sorted(map(str, whole.select(sorted(whole.columns)).collect())), "as if all months had been computed anew"
    assert monthly.publish_months(spark, root, shop, gates, files, ["202605", "202606"]) == 2
    served = releases.read_release(spark, shop, "market_uf")
    assert {(str(r.competence), r.uf, r.admissions) for r in served.collect()} == {("2026-05-01", "CE", 4), ("2026-05-01", "SP", 0), ("2026-06-01", "CE", 6), ("2026-06-01", "SP", 1)}
    assert {r.admissions for r in releases.read_release(spark, shop, "dataset_release", number=1).collect()} == {5, 6}

    # The late file comes again without June: June goes back, though no row of the new file names it.
    touched = monthly.build_silver(spark, [flow_file(tmp_path, "for8.txt", "202608", ("202601", "35", 1, "317110"))], root, SETTINGS)
    assert "202606" in touched
    assert hires(monthly.update_gold(spark, root, SETTINGS, touched))["202606"] == 6


def parts(rows, *values):
    return rows("competence string, uf string, n int", *values)


def test_a_load_that_fails_midway_changes_nothing(spark, rows, tmp_path):
    root = str(tmp_path / "shop")
    both = lambda n: {"a": parts(rows, ("202607", "CE", n), ("202608", "SP", n)), "b": parts(rows, ("202607", "x", n))}
    assert releases.publish(spark, root, both(1), ["202607", "202608"]) == 1
    stop = parts(rows, ("202607", "x", 2)).withColumn("n", F.raise_error(F.lit("bad row")).cast("int"))
    with pytest.raises(Exception, match="bad row"):
        releases.publish(spark, root, {"a": both(2)["a"], "b": stop}, ["202607", "202608"])
    with pytest.raises(ConsistencyError, match="does not cover"):
        releases.publish(spark, root, both(2), ["202607"])
    read = lambda t, **k: {tuple(r) for r in releases.read_release(spark, root, t, **k).collect()}
    assert read("a") == {("202607", "CE", 1), ("202608", "SP", 1)} and read("b") == {("202607", "x", 1)}
    assert len(list((tmp_path / "shop" / "versions").iterdir())) == 1, "a failed load leaves no folders"

    # One month is replaced in both tables; a table without rows for it is empty there, other months stay.
    assert releases.publish(spark, root, {"a": parts(rows, ("202607", "CE", 3)), "b": both(1)["b"].limit(0)}, ["202607"]) == 2
    assert read("a") == {("202607", "CE", 3), ("202608", "SP", 1)} and read("b") == set()
    assert read("a", months=["202607"]) == {("202607", "CE", 3)} and read("a", months=["209901"]) == set()
    assert read("b", number=1) == {("202607", "x", 1)}
    assert {(p.table, p.month, p.rows) for p in releases.current_parts(spark, root)} == {("a", "202607", 1), ("a", "202608", 1), ("b", "202607", 0), ("b", "202608", 0)}
    with pytest.raises(LayoutError, match="no table c"):
        releases.read_release(spark, root, "c")

    releases.publish(spark, root, both(4), ["202607", "202608"])
    releases.remove_unused(spark, root, keep=1)
    assert read("a") == {("202607", "CE", 4), ("202608", "SP", 4)} and len(list((tmp_path / "shop" / "versions").iterdir())) == 1


def test_two_loads_at_once(spark, rows, tmp_path, monkeypatch):
    """The second of two loads that started from the same release is refused."""
    root = str(tmp_path / "shop")
    releases.publish(spark, root, {"a": parts(rows, ("202607", "CE", 1))}, ["202607"])
    monkeypatch.setattr(releases, "_newest", lambda *_: 0)
    with pytest.raises(ConsistencyError, match="another load"):
        releases.publish(spark, root, {"a": parts(rows, ("202607", "CE", 2))}, ["202607"])
    monkeypatch.undo()
    assert releases.read_release(spark, root, "a").first().n == 1
    assert [p.name for p in (tmp_path / "shop" / "manifests").iterdir() if not p.name.startswith(".")] == ["00000001.json"]


def test_guarded_loads_count_the_movements_once(spark, tmp_path, monkeypatch):
    """No frame of the four loads, nor their gates, goes back to the tables."""
    from datetime import datetime

    from jobtide.operators import serving
    from jobtide.plans.release_queries import guarded_release_load

    at = datetime(1998, 3, 4)
    tables = {
        "region": ("r_regionkey int, r_name string", [(0, "ASIA")]),
        "nation": ("n_nationkey int, n_name string, n_regionkey int", [(0, "N", 0)]),
        "supplier": ("s_suppkey long, s_nationkey int, s_acctbal double", [(1, 0, 1.0), (7, 0, 1.0)]),
        "part": ("p_partkey long, p_brand string, p_type string", [(1, "Brand#1", "SMALL")]),
        "orders": ("o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp", [(1, 1, "O", 5.0, at), (2, 1, "F", 6.0, datetime(1998, 4, 4))]),
        "lineitem": ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp",
                     [(1, 1, s, n, 9.0, 1e4, 0.01, "N", "O", at) for s in (1, 7) for n in (1, 2, 7)] + [(2, 1, 1, 1, 9.0, 1e4, 0.01, "R", "O", datetime(1998, 4, 4))]),
    }
    for name, (schema, values) in tables.items():
        spark.createDataFrame(values, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    seen, load = [], serving.load_release

    def watched(session, frames, root, gates):
        seen.extend(f for frame in (frames.release, frames.uf, frames.occupation, frames.municipality, gates) for f in frame.inputFiles())
        return load(session, frames, root, gates)

    monkeypatch.setattr(serving, "load_release", watched)
    found = {tuple(r) for r in guarded_release_load(spark, str(tmp_path)).collect()}
    assert found == {("dataset_release", "19980301", "-", 6, 0, 6), ("market_uf", "19980301", "AS", 6, 0, 6), ("market_occupation", "19980301", "0001", 6, 0, 6), ("market_municipality", "19980301", "1", 3, 0, 3), ("market_municipality", "19980301", "2", 3, 0, 3)}
    assert seen and not [f for f in seen if str(tmp_path / "lineitem.parquet") in f or str(tmp_path / "orders.parquet") in f]
