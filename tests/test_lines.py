import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from ledgerspark.sources import lines, tables

SMALL = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "10"}


@pytest.fixture
def small_blocks(spark):
    """Files are cut into blocks of some hundred bytes."""
    old = {k: spark.conf.get(k) for k in SMALL}
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def made(seed, n=300, blocks=True):
    rng = random.Random(seed)
    parts = ["a", "b", ",", '"', "\n", "\r\n", " ", "é", 'x"y', '""', "\n\n", '",\n"']
    return [[str(i), "".join(rng.choices(parts, k=rng.randrange(12))),
             "".join(rng.choices(parts, k=rng.randrange(1500 if i % 60 == 7 else 4)))] for i in range(n)]


def text_of(rows, end="\n", before=""):
    out = io.StringIO(newline="")
    out.write(before)
    w = csv.writer(out, lineterminator=end)
    w.writerow(["id", "a", "b"])
    w.writerows(rows)
    return out.getvalue()


def put(folder, name, text, encoding="utf-8"):
    with open(folder / name, "w", newline="", encoding=encoding) as f:
        f.write(text)
    return str(folder / name)


def blocks_of(spark, path):
    return lines._lines(spark, path).select("file", "start").distinct().count()


@pytest.mark.parametrize("seed, end, encoding", [(1, "\n", "utf-8"), (2, "\r\n", "utf-8"), (3, "\n", "latin-1"), (4, "\r\n", "utf-8-sig")])
def test_one_file_over_many_blocks(spark, tmp_path, small_blocks, seed, end, encoding):
    rows = made(seed)
    path = put(tmp_path, "t.csv", text_of(rows, end), encoding)
    assert blocks_of(spark, path) >= 4
    states = lines._block_states(lines._block_maps(lines._lines(spark, path), ",", encoding, True))
    assert states.where("inside").count() >= 2  # quotes are open where some blocks begin
    got = tables.read_text_table(spark, path, encoding=encoding, multi_line=True)
    assert got.columns == ["id", "a", "b"]
    assert sorted(map(tuple, got.collect())) == sorted((i, a or None, b or None) for i, a, b in rows)


def test_agrees_with_one_task_per_file(spark, tmp_path, small_blocks):
    """The same records as Spark's own reader of whole files finds."""
    path = put(tmp_path, "t.csv", text_of(made(9)) + '900,5" disk,"x"y,\n901,"a" ,b\n902,"q\nr"s,t\n')
    got = lines.records(spark, path).where("number > 0").select(
        F.from_csv("text", "f0 string, f1 string, f2 string", {"quote": '"', "escape": '"', "multiLine": "true"}).alias("r")).select("r.*")
    want = spark.read.schema("f0 string, f1 string, f2 string").csv(path, header=True, multiLine=True, quote='"', escape='"')
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_heading_line(spark, tmp_path, small_blocks):
    rows = made(5, 60)
    path = put(tmp_path, "t.csv", text_of(rows, before='note\n\n"two\nlines",x\n'))
    got = tables.read_text_table(spark, path, header=2, multi_line=True)
    assert sorted(map(tuple, got.collect())) == sorted((i, a or None, b or None) for i, a, b in rows)
    plain = put(tmp_path, "p.csv", "first\n \nsecond\nid;v\n1;2\n\n3;NA\n")
    got = tables.read_csv(spark, plain, [{"name": "v", "dtype": "int"}], delimiter=";", header=2)
    assert got.columns == ["id", "v"] and sorted(map(tuple, got.collect())) == [("1", 2), ("3", None)]
    with pytest.raises(ValueError, match="no line 9"):
        tables.read_csv(spark, plain, header=9)
    with pytest.raises(ValueError, match="counted from 0"):
        tables.read_csv(spark, plain, header=-1)


def test_file_set(spark, tmp_path, small_blocks):
    folder = tmp_path / "set"
    folder.mkdir()
    rows = made(6, 200)
    for i in range(3):
        put(folder, f"part-{i}.csv", text_of(rows[i::3], before="note\n"))
    put(folder, "part-3.csv", "")
    got = tables.read_text_table(spark, str(folder), header=1, multi_line=True)
    assert sorted(map(tuple, got.collect())) == sorted((i, a or None, b or None) for i, a, b in rows)


def test_open_quote_is_a_bad_record(spark, tmp_path, small_blocks):
    text = "a,b\n1,2\n3,4,5\n" + "6,x\n" * 300 + '7,"never\n' + "8,9\n" * 300
    path = put(tmp_path, "t.csv", text)
    with pytest.raises(Exception, match="does not fit"):
        tables.read_text_table(spark, path, multi_line=True).count()
    good = tables.read_text_table(spark, path, multi_line=True, on_bad="skip")
    assert good.count() == 301
    bad = sorted(r.record[:8] for r in tables.rejected_rows(spark, path, multi_line=True).collect())
    assert bad == ["3,4,5", '7,"never']


@pytest.mark.parametrize("line, inside, after", [
    ("a,b", False, False), ("a,b", True, True), ('"a', False, True), ('a"', False, False), ('a"', True, False),
    ('"a""', False, True), ('"a"""', False, False), ('""', False, False), ('""', True, True), ('x","y', True, True),
    ('x"z,"y', True, True), ('x"z"y', True, False), ('a, "b', False, False), ('"a"b"c', False, False), ("", True, True)])
def test_states_of_a_line(line, inside, after):
    assert lines.inside_after(line, inside, ",") == after
