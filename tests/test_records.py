"""Quoted line breaks read by many tasks, against the reader that takes a file in one task."""

import random
from pathlib import Path

import pytest

from star_marts import schemas
from star_marts.sources import land, read_by_header, read_positional
from star_marts.sources.landing import _csv_options, first_records
from star_marts.sources.records import csv_records

THREE = schemas.strings(["a", "b", "c"])


@pytest.fixture
def small_blocks(spark):
    """Blocks of a few lines, so that records and fields cross them."""
    settings = {"spark.sql.files.maxPartitionBytes": "64", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def in_one_task(spark, path, header=True):
    rows = spark.read.options(**_csv_options(True, False), header=header, columnNameOfCorruptRecord="_bad").schema(
        schemas.strings(["a", "b", "c", "_bad"])
    ).csv(path)
    return rows


def both(spark, path, header=True):
    want = in_one_task(spark, path, header).collect()
    landing = land(spark, path, THREE, multiline=True, header=header)
    good = sorted((tuple(r) for r in landing.text.collect()), key=str)
    assert good == sorted((tuple(r)[:3] for r in want if r["_bad"] is None), key=str)
    assert landing.malformed.count() == sum(r["_bad"] is not None for r in want)
    assert landing.counts["loaded"] == len(good)
    return good


def random_csv(seed):
    """Fields with quotes, breaks and separators, quotes where none belong, ragged and empty lines."""
    draw = random.Random(seed)
    pieces = ["x", "yy", ",", "\n", '""', " ", "long text " * 4, "ä", "\n\n"]
    lines = []
    for _ in range(60):
        fields = []
        for _ in range(draw.choice([3, 3, 3, 3, 2, 4])):
            kind = draw.random()
            if kind < 0.5:
                fields.append('"' + "".join(draw.choices(pieces, k=draw.randint(0, 6))) + '"')
            elif kind < 0.6:
                fields.append(draw.choice(['st"ray', 'a"b"c', "it''s"]))
            else:
                fields.append(draw.choice(["", "plain", "1", "x y"]))
        lines.append(",".join(fields))
        if draw.random() < 0.05:
            lines.append("")
    return "h1,h2,h3\n" + "\n".join(lines) + "\n"


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_the_reader_of_one_task(spark, tmp_path, small_blocks, seed):
    path = tmp_path / "in"
    path.mkdir()
    for i in range(2):
        (path / f"{i}.csv").write_text(random_csv(10 * seed + i))
    assert len(both(spark, str(path))) > 30
    assert spark.read.text(str(path)).rdd.getNumPartitions() > 20


def test_a_field_over_many_blocks(spark, tmp_path, small_blocks):
    path = tmp_path / "in.csv"
    long = "\n".join(f"line {i}, with a separator" for i in range(80))
    path.write_text(f'h,i,j\n1,"{long}",2\n"{long}",3,"{long}"\n4,5,6\n7,8,"open at the end')
    good = both(spark, str(path))
    assert ("1", long, "2") in good and (long, "3", long) in good and ("4", "5", "6") in good


def test_windows_line_ends_no_header_and_empty_files(spark, tmp_path, small_blocks):
    one = tmp_path / "one.csv"
    one.write_bytes(b'a,"b\r\nb",c\r\n1,2,3\r\n\r\n')
    assert both(spark, str(one), header=False) == [("1", "2", "3"), ("a", "b\nb", "c")]
    none = tmp_path / "none.csv"
    none.write_text("")
    assert csv_records(spark, str(none)).count() == 0
    assert land(spark, str(none), THREE, multiline=True).text.count() == 0


def test_blanks_before_a_quote(spark, tmp_path, small_blocks):
    path = tmp_path / "in.csv"
    path.write_text('h,i,j\n1,  "two\nlines" ,3\n4,5,6\n')
    got = read_positional(spark, str(path), THREE, multiline=True, trim=True).good
    assert sorted(tuple(r) for r in got.collect()) == [("1", "two\nlines", "3"), ("4", "5", "6")]


def test_by_header_with_line_breaks(spark, tmp_path, small_blocks):
    path = tmp_path / "in.csv"
    path.write_text('City,"Station\nName",ZIP\nTroy,"North\nside",12180\nRome,South,\n')
    got = read_by_header(spark, str(path), schemas.RAW_STATION_FEED, multiline=True)
    assert sorted(tuple(r) for r in got.select("CITY", "STATIONNAME").collect()) == [("Rome", "South"), ("Troy", "North\nside")]


def read_bytes(spark, run):
    """Bytes that the stages of an action read."""
    store = spark.sparkContext._jsc.sc().statusStore()
    before = {s.stageId() for s in _stages(store)}
    run()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    return sum(s.inputBytes() for s in _stages(store) if s.stageId() not in before)


def _stages(store):
    found = store.stageList(None, False, False, getattr(store, "stageList$default$4")(), None)
    return [found.apply(i) for i in range(found.size())]


def test_headers_are_read_by_seeking(spark, tmp_path):
    sizes = {}
    for name, lines in (("short", 10), ("long", 400_000)):
        path = tmp_path / f"{name}.csv"
        path.write_text("id,city\n" + "1,Troy and some more text\n" * lines)
        sizes[name] = read_bytes(spark, lambda path=path: first_records(spark, [str(path)]))
    assert (tmp_path / "long.csv").stat().st_size > 9_000_000
    assert sizes["long"] <= 1 << 17
    found = first_records(spark, [str(tmp_path)])
    assert [(Path(f).name, h) for f, h in found] == [("long.csv", "id,city"), ("short.csv", "id,city")]


def test_first_records_over_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text('"x\ny\n\nz",b\n1,2\n')
    (tmp_path / "b.csv").write_text("")
    (tmp_path / "c.csv").write_text('"never closed\n1\n')
    found = [h for _, h in first_records(spark, [str(tmp_path)], multiline=True)]
    assert found == ['"x\ny\n\nz",b', '"never closed\n1']
