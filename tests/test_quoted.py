"""Quoted line breaks in files read in parts, against Python's csv reader."""

import csv
import io
import random

import pytest

from jobtide.sources import quoted
from jobtide.sources.layout import inspect_layouts
from jobtide.sources.stock_text import read_stock_text


@pytest.fixture
def small_parts(spark):
    """Files are cut every so many bytes, so that records, quotes and whole runs of lines lie across parts."""
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = [spark.conf.get(k) for k in keys]

    def cut(size):
        spark.conf.set(keys[0], size)
        spark.conf.set(keys[1], 1)

    yield cut
    for k, v in zip(keys, old, strict=True):
        spark.conf.set(k, v)


def records(spark, path, delimiter):
    lines = quoted.text_lines(spark, [str(path)])
    found = quoted.read_records(lines, quoted.part_states(lines, delimiter), delimiter)
    return sorted(tuple(next(csv.reader(io.StringIO(r.value), delimiter=delimiter))) for r in found.collect())


def field(dice, delimiter):
    text = "".join(dice.choice(["a", "é", "1", " ", '"', "\n", "\n\n", delimiter, '""', "xyz"]) for _ in range(dice.randint(0, 6)))
    shape = dice.random()
    if shape < 0.45:
        return '"' + text.replace('"', '""') + '"' + dice.choice(["", "", "z", 'q"q'])
    plain = text.replace("\n", "").replace(delimiter, "").lstrip('"')
    return plain + dice.choice(["", 'x"', '5" wide']) if plain else "v"


@pytest.mark.parametrize(("delimiter", "size"), [(";", 37), ("|", 64), ("\t", 200), (",", 1 << 20)])
def test_records_equal_a_plain_reader(spark, tmp_path, small_parts, delimiter, size):
    dice = random.Random(size)
    body = "\n".join(delimiter.join(field(dice, delimiter) for _ in range(dice.randint(2, 4))) for _ in range(150))
    text = f"head{delimiter}b\n\n{body}\n"
    (tmp_path / "a.csv").write_text(text, encoding="utf-8")
    expected = sorted(tuple(r) for r in list(csv.reader(io.StringIO(text, newline=""), delimiter=delimiter))[1:] if r)
    small_parts(size)
    lines = quoted.text_lines(spark, [str(tmp_path / "a.csv")])
    states = quoted.part_states(lines, delimiter)
    assert size > 1000 or states.where("start").count() > 2
    assert records(spark, tmp_path / "a.csv", delimiter) == expected
    assert len(expected) <= 150 < text.count("\n"), "some fields have run on over several records' lines"


def test_a_field_over_many_parts(spark, tmp_path, small_parts):
    long = "\n".join(f"line {i} without quotes" for i in range(60))
    text = f'h;b\n1;"{long}"\n2;x\n"3";"y ""z"" {long};\n";4\n5;"open to the end\nof the file\n'
    (tmp_path / "a.csv").write_text(text)
    expected = sorted(tuple(r) for r in list(csv.reader(io.StringIO(text, newline=""), delimiter=";"))[1:])
    for size in (50, 333, 1 << 20):
        small_parts(size)
        found = [tuple(x.removesuffix("\n") for x in r) for r in records(spark, tmp_path / "a.csv", ";")]
        assert found == [tuple(x.removesuffix("\n") for x in r) for r in expected]


def test_a_quote_that_never_closes_stops_the_read(spark, tmp_path):
    (tmp_path / "a.csv").write_text('h;b\n1;"x\n' + "2;y\n" * (quoted.RECORD_BYTES // 4 + 10))
    with pytest.raises(Exception, match="quoted field does not end"):
        records(spark, tmp_path / "a.csv", ";")


HEADER = "CBO 2002 Ocupação;Obs;Município;Vínculo Ativo 31/12;Vínculo Abandonado"


def test_annual_files_with_breaks(spark, tmp_path, small_parts):
    """Two layouts and encodings; the columns behind the broken field are whole; clean files keep their plain scan."""
    rows = "".join(f'2124-{i:02};"não\r\né ""{i}"";\n";4314902;{i % 2};0\r\n' for i in range(40))
    (tmp_path / "SP 1+%20.txt").write_bytes((HEADER + "\r\n" + rows).encode("latin-1"))
    (tmp_path / "SUL.csv").write_bytes((HEADER + "\n" + rows.replace("\r", "")).encode("utf-8"))
    (tmp_path / "RIO.csv").write_text("Obs," + HEADER.replace("Obs;", "").replace(";", ",") + '\n"a, ""b""",212405,330455,1,0\n', encoding="utf-8")
    for size in (90, 1 << 20):
        small_parts(size)
        found = read_stock_text(spark, inspect_layouts(spark, str(tmp_path))).collect()
        expected = [(f"2124-{i:02}", "4314902", str(i % 2), "0", f) for i in range(40) for f in ("SP 1+%20.txt", "SUL.csv")] + [("212405", "330455", "1", "0", "RIO.csv")]
        assert sorted(tuple(r) for r in found) == sorted(expected)


def test_lines_are_not_shuffled_or_sorted(spark, tmp_path, small_parts):
    """Parts are summed up in place, lines joined where they are read; only pieces of records over the end of a part are brought together."""
    (tmp_path / "a.csv").write_text("h;b\n" + "".join(f'{i};"x\ny"\n' for i in range(400)))
    small_parts(300)
    lines = quoted.text_lines(spark, [str(tmp_path / "a.csv")])
    states = quoted.part_states(lines, ";")
    found = quoted.read_records(lines, states, ";")
    assert found.count() == 400
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and plan.count("Aggregate") == 1 and plan.count("MapInArrow") == 2
