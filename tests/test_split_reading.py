"""Quoted files in many pieces against the same files in one task each."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from roadlens.sources import delimited, quoted


@pytest.fixture
def tiny_pieces(spark):
    """Pieces of some hundred bytes, each a partition of its own or several together."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}

    def pieces_of(size: int, opening: int) -> None:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", str(opening))

    yield pieces_of
    for k, v in old.items():
        spark.conf.set(k, v)


def field(draw: random.Random) -> str:
    kind = draw.random()
    if kind < 0.5:
        return draw.choice(("a", "bc", "", "12", " x "))
    text = "".join(draw.choice(("x", "yz", ",", '""', "\n", "\r\n", " ", "long words in a row ")) for _ in range(draw.randint(0, 12)))
    return f'"{text}"'


def written(path, draw: random.Random, rows: int, ending: str, header: str = "a,b,c") -> None:
    lines = [header] + [",".join(field(draw) for _ in range(3)) for _ in range(rows)]
    path.write_bytes((ending.join(lines) + draw.choice(("", ending))).encode())


def parsed(spark, path: str) -> list[tuple]:
    record, rows = F.from_csv("value", "a string, b string, c string", delimited.RECORD), []
    for found in quoted.read_quoted(spark, path):  # by header, with and without a \r
        assert not found.irregular
        rows += [str(tuple(r)) for r in found.records.select(record.alias("r")).select("r.*").collect()]
    return sorted(rows)


def in_one_task(spark, path: str) -> list[tuple]:
    rows = spark.read.options(header=True, multiLine=True, **delimited.QUOTING).schema("a string, b string, c string").csv(path)
    return sorted(str(tuple(r)) for r in rows.collect())


@pytest.mark.parametrize("seed", range(8))
def test_records_equal_those_of_one_task(spark, tmp_path, tiny_pieces, seed):
    draw = random.Random(seed)
    for i in range(1 + seed % 3):
        written(tmp_path / f"f{i}.csv", draw, draw.choice((0, 5, 60, 200)), draw.choice(("\n", "\r\n")))
    expected = in_one_task(spark, str(tmp_path))
    for size, opening in ((64, 1), (300, 1000), (1 << 20, 1 << 22)):
        tiny_pieces(size, opening)
        assert parsed(spark, str(tmp_path)) == expected


def test_one_file_is_read_by_many_tasks(spark, tmp_path, tiny_pieces):
    written(tmp_path / "f.csv", random.Random(3), 400, "\n")
    tiny_pieces(500, 1)
    (found,) = quoted.read_quoted(spark, str(tmp_path))
    assert found.records.rdd.getNumPartitions() > 20
    plan = found.records._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan


def test_a_field_longer_than_pieces(spark, tmp_path, tiny_pieces):
    (tmp_path / "f.csv").write_text('a,b,c\n1,"' + "line, of \"\"text\"\"\n" * 300 + '",2\n3,4,5\n"open')
    tiny_pieces(200, 1)
    expected = in_one_task(spark, str(tmp_path))
    assert parsed(spark, str(tmp_path)) == expected and len(expected) == 3


def test_more_pieces_than_are_broadcast(spark, tmp_path, tiny_pieces, monkeypatch):
    written(tmp_path / "f.csv", random.Random(5), 150, "\n")
    expected = in_one_task(spark, str(tmp_path))
    monkeypatch.setattr(quoted, "MOST_PIECES", 3)
    tiny_pieces(100, 1)
    assert parsed(spark, str(tmp_path)) == expected


@pytest.mark.parametrize("line", ['5" pipe,1,2', 'size 12",1,2', '"a"b,1,2', '1,"x" ,2', 'a,b"c"",d'])
def test_files_with_quotes_in_other_places_are_told_apart(spark, tmp_path, tiny_pieces, line):
    (tmp_path / "bad.csv").write_text("a,b,c\n" + "1,2,3\n" * 30 + line + "\n" + '7,"8\n8",9\n' * 30)
    (tmp_path / "good.csv").write_text("a,b,c\n" + '1,"2\n2",3\n' * 30)
    tiny_pieces(100, 1)
    (found,) = quoted.read_quoted(spark, str(tmp_path))
    assert [f.rsplit("/", 1)[1] for f in found.irregular] == ["bad.csv"]
    assert found.records.count() == 30


def test_headers_and_empty_files(spark, tmp_path, tiny_pieces):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    (tmp_path / "b b.csv").write_text("y,x\r\n1,2\r\n")
    (tmp_path / "c.csv").write_text("\n\nx,y\n\n3,4\n")
    (tmp_path / "d.csv").write_text("")
    tiny_pieces(4, 1)
    found = {q.header.strip(): sorted(r["value"] for r in q.records.collect()) for q in quoted.read_quoted(spark, str(tmp_path))}
    assert found == {"x,y": ["1,2", "3,4"], "y,x": ["1,2"]}
    headers = delimited.headers_of(spark, str(tmp_path))
    assert {h.strip(): sorted(f.rsplit("/", 1)[1] for f in fs) for h, fs in headers.items()} == {"x,y": ["a.csv", "c.csv"], "y,x": ["b b.csv"]}
    assert quoted.read_quoted(spark, str(tmp_path / "d.csv")) == []
