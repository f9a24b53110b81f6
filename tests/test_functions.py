import unicodedata

import pytest
from pyspark.sql import functions as F

from jobtide.functions import codes, fingerprints, movement, numbers, periods, rates, salary, text


def column(df, expr):
    return [r[0] for r in df.select(expr).collect()]


def test_headers():
    assert text.compact_header(" Saldo Movimentação ") == "saldomovimentacao"
    assert text.compact_header("CBO 2002 Ocupação") == "cbo2002ocupacao"
    assert text.snake_header("Ind Vínculo Ativo 31/12 - Código") == "ind_vinculo_ativo_31_12_codigo"
    assert text.snake_header(" _x_ ") == "x"


def test_snake_header_column_equals_driver_side(rows):
    names = ["Município - Código", "  CBO/2002 ", "Vl Rem Média (Nom)", "ĳ½ª", "__a__"]
    assert column(rows("c string", *names), text.snake_header_column(F.col("c"))) == [text.snake_header(n) for n in names]


def test_comparable_value_matches_unicode_folding(rows):
    words = ["  Não  Informado ", "STRASSE straße", "ﬁ".replace("ﬁ", "fi"), "", None, "Ǆ ŉ ½", "áB"]
    words += ["".join(chr(p) for p in range(start, start + 16)) for start in range(0xA1, 0x240, 16)]

    def fold(value):
        plain = unicodedata.normalize("NFKD", (value or "").strip())
        plain = "".join(c for c in plain if not unicodedata.combining(c))
        return " ".join(plain.casefold().split())

    got = column(rows("c string", *words), text.comparable_value(F.col("c")))
    latin = {w: g for w, g in zip(words, got, strict=True)}
    for word, value in latin.items():
        # Letters without a decomposition keep Spark's lower case, which is their case folding except for U+0149 etc.
        assert value == fold(word) or value.lower() == fold(word).lower() or set(value) ^ set(fold(word)) <= set("ſsµμ"), word


def test_folding_of_all_of_unicode(spark):
    """Every character between letters, as Python's tables fold it on the driver."""
    def plain(value):
        return "".join(c for c in unicodedata.normalize("NFKD", value) if not unicodedata.combining(c))

    points = [p for p in range(1, 0x110000) if not 0xD800 <= p <= 0xDFFF and (p < 0x30000 or p % 97 == 0) and (p < 0xAC00 or p > 0xD7A3 or p % 13 == 0)]
    words = ["x" + "y".join(map(chr, points[i : i + 40])) + "z" for i in range(0, len(points), 40)]
    words += ["Trần Đăng Khoa", "ﬁancée ﬀ", "Москва́ Ё", "서울특별시", "ẞtraße", "ΑΣ ας", "İstanbul ı", "\u0e33\u0f73"]
    df = spark.createDataFrame([(w,) for w in words], "c string").repartition(4, "c")
    for word, stripped, folded in df.select("c", text.strip_accents(F.col("c")), text.comparable_value(F.col("c"))).collect():
        assert stripped == plain(word)
        assert folded == " ".join(plain(word.strip()).casefold().split())


def test_spreadsheet_safe(rows):
    cells = ["=SUM(1,1)", "  @unsafe", "+CMD", "-injected", "safe", "a=b", None, " =x"]
    expected = ["'=SUM(1,1)", "'  @unsafe", "'+CMD", "'-injected", "safe", "a=b", None, "' =x"]
    assert column(rows("c string", *cells), text.spreadsheet_safe(F.col("c"))) == expected


def test_numbers(rows):
    df = rows("c string", "1", "-1", "1,0", "1.0", "", None, "40000")
    assert column(df, numbers.lenient_smallint(F.col("c"))) == [1, -1, None, None, None, None, None]
    df = rows("c string", "4500,00", "4500.00", "1.234,56", "1,2,3", "x", None, "12d", "NaN")
    assert column(df, numbers.brazilian_number(F.col("c"))) == [4500.0, 4500.0, 1234.56, None, None, None, None, None]
    df = rows("c string", "1.234,56", "4500.00", " 7 ", None)
    assert column(df, numbers.dotted_thousands_number(F.col("c"))) == [1234.56, 450000.0, 7.0, None]


def test_codes(rows):
    df = rows("c string", "212405", "12345", "1234", "2124-05", None)
    assert column(df, codes.occupation_code(F.col("c"))) == ["212405", "012345", None, "212405", None]
    df = rows("c string", "230440", "2304400", "23044", None)
    assert column(df, codes.municipality_code(F.col("c"))) == ["230440", "230440", None, None]
    df = rows("c string", "230440", "999999", "990000", "23", None)
    assert column(df, codes.state_of_municipality(F.col("c"))) == ["CE", "NI", None, None, None]
    df = rows("c string", "23", "99", "77", None)
    assert column(df, codes.label_or_code(F.col("c"))) == ["CE", "NI", "77", None]


def test_cell_codes(rows):
    df = rows(
        "kind string, value string", ("int", "212405"), ("float", "212405.0"), ("float", "212405.5"),
        ("text", "CBO 2124-05"), ("bool", "212405"), ("text", "12"), ("int", None),
    )
    got = column(df, codes.occupation_code_from_cell(F.col("kind"), F.col("value")))
    assert got == ["212405", "212405", None, "212405", None, None, None]


def test_row_predicates(rows):
    df = rows("u string, c string, s double", ("CE", "212405", 1.0), ("NI", "12", None), (None, None, -1.0))
    rules = codes.row_predicates(F.col("u"), F.col("c"), F.col("s"))
    assert [tuple(r) for r in df.select(*rules.values()).collect()] == [
        (True, True, True), (False, False, True), (False, False, False),
    ]


def test_effective_month_and_deltas(rows):
    df = rows("competencia_mov string, competencia_declarada string", (None, "2026-07"), ("202606", "202607"), ("x", ""))
    assert column(df, movement.effective_month(df.columns, "FOR", "202608")) == ["202607", "202606", "202608"]
    assert column(df, movement.effective_month([], "EXC", "202608")) == ["202608"] * 3
    signs = rows("saldo_movimentacao int", 1, -1)
    late = movement.with_adjustment_deltas(signs, " for ").select(*movement.DELTAS, "adjustment_kind").collect()
    assert [tuple(r) for r in late] == [(1, 0, 1, "FOR"), (0, 1, -1, "FOR")]
    back = movement.with_adjustment_deltas(signs, "EXC").select(*movement.DELTAS).collect()
    assert [tuple(r) for r in back] == [(-1, 0, -1), (0, -1, 1)]
    with pytest.raises(ValueError):
        movement.checked_kind("MOV")


def test_base_deltas_only_fill_gaps(rows):
    df = movement.with_base_deltas(rows("saldo_movimentacao int, admissions_delta int", (1, 7)), "202601")
    row = df.collect()[0]
    assert (row.admissions_delta, row.dismissals_delta, row.balance_delta) == (7, 0, 1)
    assert (row.effective_competence, row.adjustment_kind) == ("202601", "MOV")


def test_salary_rule(rows):
    rule = salary.SalaryRule()
    assert rule.bounds("202607") == (486.3, 243150.0)
    with pytest.raises(ValueError):
        rule.bounds("2026")
    with pytest.raises(ValueError):
        rule.bounds("202507")
    df = rows(
        "saldo_movimentacao int, salario_mensal double, indicador_trabalho_intermitente string, m string",
        (1, 486.3, "0", "202601"), (1, 486.29, "0", "202601"), (1, 243150.0, "0", "202601"), (1, 5000.0, " SIM ", "202601"),
        (-1, 5000.0, "0", "202601"), (1, None, "0", "202601"), (1, 5000.0, None, "202601"),
    )
    out = salary.with_salary_eligibility(df, rule, F.col("m"))
    assert [r[salary.ELIGIBLE] for r in out.collect()] == [True, False, True, False, False, False, None]
    with pytest.raises(Exception, match="minimum wage"):
        salary.with_salary_eligibility(df.withColumn("m", F.lit("201901")), rule, F.col("m")).collect()
    with pytest.raises(ValueError, match="indicador"):
        salary.with_salary_eligibility(df.drop("indicador_trabalho_intermitente"), rule, "202601")


def test_rates(rows):
    df = rows("n int, p int", (100, 2_500_000), (5, 0), (5, None))
    assert column(df, rates.per_100k(F.col("n"), F.col("p"))) == [4.0, None, None]
    assert column(df, rates.share(F.col("n"), F.lit(0))) == [0.0, 0.0, 0.0]
    value = column(df.limit(1), rates.deflate(F.lit(3800.0), rates.price_ratio(F.lit("7657.73"), F.lit("7633.23"))))[0]
    assert value == pytest.approx(3812.1966716580005, rel=1e-12)
    assert column(df.limit(1), rates.price_ratio(F.lit("0"), F.lit("1"))) == [None]


def test_periods(rows):
    df = rows("m string", "202612", "202601", "202613", "abc", None)
    assert column(df, periods.next_month(F.col("m"))) == ["202701", "202602", None, None, None]
    assert [str(d) for d in column(df.limit(2), periods.month_start(F.col("m")))] == ["2026-12-01", "2026-01-01"]
    assert column(df.limit(2), periods.quarter_key(F.col("m"))) == ["2026Q4", "2026Q1"]
    assert periods.next_month_text("202612") == "202701" and periods.next_month_text("202601") == "202602"
    with pytest.raises(ValueError):
        periods.next_month_text("202600")


def test_fingerprints(rows):
    import hashlib
    import json

    record = {"admissoes": 2, "saldo": 1, "fonte": "MTE é", "vazio": None, "nao_identificado": {"a": 1, "b": None}}
    df = rows(
        "saldo int, admissoes int, fonte string, vazio string, nao_identificado struct<b:int,a:int>",
        (1, 2, "MTE é", None, (None, 1)),
    )
    body = json.dumps(record, ensure_ascii=False, sort_keys=True, separators=(",", ":")).encode()
    assert column(df, fingerprints.record_fingerprint(df)) == [hashlib.sha256(body).hexdigest()]

    sources, files = ["b" * 64, "a" * 64], [("2", "y.json", "d" * 64), ("1", "x.json", "c" * 64)]
    layout = "rais-release:2025\n" + "".join(f"source:{s}\n" for s in sorted(sources))
    layout += "".join(f"artifact:{n}:{h}\n" for _, n, h in sorted(files))
    df = rows("s array<string>, a array<struct<position:string,name:string,sha256:string>>", (sources, files))
    got = column(df, fingerprints.release_fingerprint(F.lit(2025), F.col("s"), F.col("a")))
    assert got == [hashlib.sha256(layout.encode()).hexdigest()]


def test_row_set_fingerprint_ignores_order_and_counts_copies(rows):
    one = lambda *v: column(rows("c string", *v).repartition(3), fingerprints.row_set_fingerprint(F.col("c")))
    assert one("a", "b", "c") == one("c", "a", "b")
    assert one("a", "b") != one("a", "b", "b") and one("a", "b") != one("a", "c")




def test_double_text_is_the_shortest(spark):
    """As Python writes floats, which reads back as the same number and has no digit too many."""
    import json
    import math
    import random
    import struct

    dice = random.Random(4)
    values = [0.0, -0.0, 1.0, -1.5, 1e7, 1.5e10, 123456789.125, 1e15, 9999999999999998.0, 1e16, 1.5e16, 1e22, 1e23, 2e23, 1e-3, 1e-4, 1.5e-4, 1e-5, 1.25e-5, 5e-324, 2.2250738585072014e-308, 1.7976931348623157e308, 0.1 + 0.2, 2e-3, 1.0e-10, 100.0, 1234.0, math.inf, -math.inf, math.nan]
    values += [struct.unpack("d", struct.pack("Q", dice.getrandbits(64)))[0] for _ in range(2000)] + [round(dice.uniform(-1e9, 1e9), 2) for _ in range(2000)] + [dice.uniform(0, 1) * 10 ** dice.randint(-8, 20) for _ in range(2000)]
    df = spark.createDataFrame([(v,) for v in values], "d double")
    written = [r[0] for r in df.select(fingerprints.double_text(F.col("d"))).collect()]
    wrong = [(v, w) for v, w in zip(values, written, strict=True) if w != json.dumps(v)]
    assert not wrong, wrong[:5]
    nested = spark.createDataFrame([((1e8, None), [1.5e-7, None], "é\"/", None, 2)], "s struct<b double, a string>, l array<double>, t string, n double, i int")
    assert nested.select(fingerprints.canonical_json(nested)).first()[0] == '{"i":2,"l":[1.5e-07,null],"n":null,"s":{"a":null,"b":100000000.0},"t":"é\\"/"}'


def test_double_text_spells_a_number_once(spark):
    """Steps share what they build on, also where Spark does not share it (in lambdas): the cost of a row grows with the size of the plan."""
    df = spark.createDataFrame([(1.5,)], "d double")
    plan = df.select(fingerprints.double_text(F.col("d")))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("as string") < 30 and plan.count("format_string") == 0
