"""CSV files cut into blocks, against Python's own reader."""

import csv
import gzip
import io

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pyspark.sql import types as T

from reelsim.sources.csv_blocks import parsed, read_blocks, records, stored_lines

CELL = st.text(alphabet='a,"\n\r é', max_size=12)
ROWS = st.lists(st.tuples(CELL, CELL), max_size=12)


TWO = T.StructType([T.StructField("x", T.StringType()), T.StructField("y", T.StringType())])


def _read(spark, path, size=1 << 20):
    """Rows in source order, and how many blocks; only the CSV files are
    read in blocks of ``size`` bytes, not the table of their lines."""
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    try:
        lines = stored_lines(spark, str(path))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    rows = parsed(records(lines), TWO).orderBy("_file", "_block", "_pos").collect()
    return [tuple(x or "" for x in r[:2]) for r in rows], lines.select("block").distinct().count()


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=ROWS, size=st.sampled_from([7, 40]), end=st.sampled_from(["\n", "\r\n"]))
def test_blocks_of_any_size_give_the_rows_written(spark, tmp_path_factory, rows, size, end):
    path = tmp_path_factory.mktemp("csv") / "rows.csv"
    text = io.StringIO(newline="")
    csv.writer(text, lineterminator=end, quoting=csv.QUOTE_ALL).writerows([("x", "y"), *rows])
    path.write_bytes(text.getvalue().encode())
    assert _read(spark, path, size)[0] == [tuple(r) for r in rows]


@pytest.mark.parametrize("size", [5, 23])
def test_quotes_in_text_blank_lines_and_headers_of_several_lines(spark, tmp_path, size):
    text = '﻿\n\n"a\nb",c\n5" pipe,"say ""hi"", then\n\n\nmore"\n\nshort\none,two,three\n"",x"y"z\n"open, to\nthe end'
    (tmp_path / "odd.csv").write_bytes(text.encode())
    got = read_blocks(spark, str(tmp_path / "odd.csv"))
    assert got.columns[:2] == ["a\nb", "c"]
    want = [('5" pipe', 'say "hi", then\n\n\nmore'), ("short", ""), ("one", "two"), ("", 'x"y"z')]
    rows, _ = _read(spark, tmp_path / "odd.csv", size)
    assert rows[:4] == want and len(rows) == 5


def test_many_tasks_read_one_file(spark, tmp_path):
    path = tmp_path / "long.csv"
    with path.open("w", newline="") as f:
        w = csv.writer(f)
        w.writerow(["title", "description"])
        w.writerows((f"t{i}", f'line one of {i}\nline "two", and more') for i in range(3000))
    rows, blocks = _read(spark, path, 8192)
    assert blocks > 10
    assert rows == [(f"t{i}", f'line one of {i}\nline "two", and more') for i in range(3000)]


def test_empty_files_headers_alone_and_compressed_files(spark, tmp_path):
    for name, data in (("a.csv", b""), ("b.csv", b"x,y\n"), ("c.csv", b"x,y\n1,2\n")):
        (tmp_path / name).write_bytes(data)
    (tmp_path / "d.csv.gz").write_bytes(gzip.compress(b'x,y\n"3\n4",5\n'))
    assert sorted(_read(spark, tmp_path)[0]) == [("1", "2"), ("3\n4", "5")]


def test_stored_tables_are_deleted_on_release(spark, tmp_path, monkeypatch):
    import os

    from reelsim import session
    monkeypatch.setattr(session, "_stored", [])            # not those of other tests
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    lines = stored_lines(spark, str(tmp_path / "a.csv"))
    other = session.store_table(spark.range(3))
    session.drop_table(other)
    assert os.path.exists(lines._stored_path) and not os.path.exists(other._stored_path)
    assert session.release_tables(spark) == 1
    assert not os.path.exists(lines._stored_path)
