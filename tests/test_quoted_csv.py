"""Records with line breaks inside quotes, from splits that cut them anywhere."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from growthledger.sources.csvfiles import read_raw_csv
from growthledger.sources.quotedcsv import read_records

COLUMNS = ["a", "b", "c"]


def lines_of(records, ending="\n"):
    def cell(text):
        return '"' + text.replace('"', '""') + '"' if set(text) & set(',"\r\n') else text

    return "".join(",".join(map(cell, r)) + ending for r in [COLUMNS, *records])


def write(path, text):
    path.write_bytes(text.encode())
    return str(path)


def small_splits(spark, size):
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    spark.conf.set("spark.sql.files.minPartitionNum", "1")


@pytest.fixture
def splits(spark):
    yield lambda size: small_splits(spark, size)
    for name in ("maxPartitionBytes", "openCostInBytes", "minPartitionNum"):
        spark.conf.unset(f"spark.sql.files.{name}")


def some_records(n, seed):
    draw = random.Random(seed)
    parts = ["x", "é", ",", '"', "\n", "\r\n", " ", '""', "longer text ", "\n\n", '",\n"']
    return [(f"{k}", *["".join(draw.choices(parts, k=draw.randint(1, 9))) + "." for _ in range(2)]) for k in range(n)]


def read(spark, path):
    return sorted(map(tuple, read_raw_csv(spark, path, COLUMNS, multiline=True).collect()), key=lambda r: int(r[0]))


@pytest.mark.parametrize("ending", ["\n", "\r\n"])
@pytest.mark.parametrize("size", [17, 333, 10_000_000])
def test_one_file_in_many_splits(spark, tmp_path, splits, size, ending):
    expected = some_records(40, size)
    path = write(tmp_path / "a.csv", lines_of(expected, ending))
    splits(size)
    assert read(spark, path) == expected


def test_many_tasks_read_one_file_as_the_parser_reads_it_whole(spark, tmp_path, splits):
    records = some_records(20_000, 1)
    path = write(tmp_path / "a.csv", lines_of(records))
    whole = spark.read.options(header=True, multiLine=True, escape='"').csv(path)
    splits(20_000)
    ours = read_raw_csv(spark, path, COLUMNS, multiline=True)
    assert ours.rdd.getNumPartitions() > 30 and whole.rdd.getNumPartitions() == 1
    assert ours.exceptAll(whole).isEmpty() and whole.exceptAll(ours).isEmpty()
    assert ours.count() == len(records)


def test_one_field_over_many_splits(spark, tmp_path, splits):
    long = "\n".join(f'line "{k}", of one field' for k in range(400))
    expected = [("1", "x", "y"), ("2", long, "y"), ("3", "x", long), ("4", "x", "y")]
    path = write(tmp_path / "a.csv", lines_of(expected))
    splits(700)
    assert read(spark, path) == expected


def test_several_files_each_with_its_header(spark, tmp_path, splits):
    records = some_records(30, 5)
    for k in range(3):
        write(tmp_path / f"{k}.csv", lines_of(records[k * 10 : k * 10 + 10]))
    splits(64)
    assert read(spark, str(tmp_path)) == records
    assert read_records(spark, str(tmp_path)).where("first").count() == 3


def test_no_piece_no_shuffle(spark, tmp_path):
    path = write(tmp_path / "a.csv", lines_of(some_records(50, 2)))
    plan = read_raw_csv(spark, path, COLUMNS, multiline=True)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_text_that_never_closes_its_quote(spark, tmp_path, splits):
    path = write(tmp_path / "a.csv", 'a,b,c\n1,x,y\n2,"x,y\n3,x,y\n')
    splits(6)
    with pytest.raises(ValueError, match="ends inside quotes"):
        read_raw_csv(spark, path, COLUMNS, multiline=True)


def test_nothing_but_a_header_and_empty_lines(spark, tmp_path, splits):
    splits(3)
    assert read(spark, write(tmp_path / "a.csv", "a,b,c\n")) == []
    assert read(spark, write(tmp_path / "b.csv", "a,b,c\n\n\r\n1,,y\n\n")) == [("1", None, "y")]


def test_a_count_checks_the_records_too(spark, tmp_path):
    path = write(tmp_path / "a.csv", "a,b,c\n1,x,y,z\n")
    with pytest.raises(Exception, match="more than 3 fields"):
        read_raw_csv(spark, path, COLUMNS, multiline=True).count()


@settings(max_examples=8, deadline=None)
@given(
    st.lists(st.tuples(*[st.text('ab,"\n ', max_size=8).map(lambda t: t + ".")] * 2), min_size=1, max_size=8),
    st.integers(2, 60),
)
def test_any_text_any_split(spark, tmp_path_factory, cells, size):
    expected = [(str(k), *c) for k, c in enumerate(cells)]
    path = write(tmp_path_factory.mktemp("csv") / "a.csv", lines_of(expected))
    small_splits(spark, size)
    try:
        assert read(spark, path) == expected
    finally:
        for name in ("maxPartitionBytes", "openCostInBytes", "minPartitionNum"):
            spark.conf.unset(f"spark.sql.files.{name}")
