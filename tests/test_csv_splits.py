"""CSV with line breaks in quoted cells, read by many tasks per file."""

import random

import pytest

from breachlens.sources.csv_files import land_cells, read_incident_csv, read_split_csv
from breachlens.sources.csv_splits import state_after

CELLS = ["", "a", "b c", '"x"', '"two\nlines"', '"a,b"', '"q ""q"" q"', '"\n"', '"",""', "12", '" "', '"\r\n"', '"é\nü\n\nö"', "x\"y", "NA", '"""\n"""', '"tail"junk']


def plain_state(line, inside):
    """A reader that goes from character to character."""
    at, start = 0, not inside
    while at < len(line):
        c = line[at]
        if inside:
            if c == '"' and line[at + 1 : at + 2] == '"':
                at += 1
            elif c == '"':
                inside = False
            start = False
        elif c == '"' and start:
            inside, start = True, False
        else:
            start = c == ","
        at += 1
    return inside


@pytest.mark.parametrize("seed", range(5))
def test_state_after_a_line(seed):
    rng = random.Random(seed)
    for _ in range(4000):
        line = "".join(rng.choice('"",a ') for _ in range(rng.randrange(12)))
        for inside in (False, True):
            assert state_after(line, inside) == plain_state(line, inside), (line, inside)


def test_state_after_a_long_line():
    assert state_after('1,"' + 'x ""y"", ' * 200_000, False)
    assert not state_after('1,"' + 'x ""y"", ' * 200_000 + '",2', False)


@pytest.fixture
def tiny_splits(spark):
    def use(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")

    yield use
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def random_file(rng, rows, end):
    lines = ["a,b,c"]
    for _ in range(rows):
        if rng.random() < 0.05:
            lines.append("")
        lines.append(",".join(rng.choice(CELLS) for _ in range(rng.choice([3, 3, 3, 2]))))
    return end.join(lines) + rng.choice(["", end] if end == "\n" else [end])


@pytest.mark.parametrize("seed, size, end", [(1, 25, "\n"), (2, 40, "\r\n"), (4, 1 << 20, "\r\n")])
def test_equals_the_whole_file_read(spark, tmp_path, tiny_splits, seed, size, end):
    rng = random.Random(seed)
    folder = tmp_path / "files"
    folder.mkdir()
    for name in ("one.csv", "two.csv"):
        (folder / name).write_bytes(random_file(rng, 8, end).encode())
    order = ["_source_file", "_source_block", "_source_row"]
    columns = ["a", "b", "c", "_source_file", "_too_long"]
    wanted = [tuple(r) for r in read_incident_csv(spark, str(folder), True).orderBy(*order).select(*columns).collect()]
    tiny_splits(size)
    found = read_split_csv(spark, str(folder), str(tmp_path / "work"))
    assert [tuple(r) for r in found.orderBy(*order).select(*columns).collect()] == wanted
    if size < 100:
        assert spark.read.text(str(folder)).rdd.getNumPartitions() > 4


@pytest.mark.parametrize("at", range(0, 60, 22))
def test_a_break_at_every_split_edge(spark, tmp_path, tiny_splits, at):
    path = tmp_path / "file.csv"
    path.write_text('a,b\n1,"' + "x" * (at % 30) + "\n" + "y\n" * (at // 2) + '"\n"p\n",q\n2,"z"\n')
    tiny_splits(16)
    found = read_split_csv(spark, str(path), str(tmp_path / "work")).orderBy("_source_block", "_source_row").collect()
    assert [(r.a, r.b) for r in found] == [("1", "x" * (at % 30) + "\n" + "y\n" * (at // 2)), ("p\n", "q"), ("2", "z")]


def test_open_cells_other_headers_and_too_many_cells_are_refused(spark, tmp_path):
    folder = tmp_path / "files"
    folder.mkdir()
    (folder / "a.csv").write_text('a,b\n1,"x\ny"\n')
    (folder / "b.csv").write_text('a,b\n1,"x\ny\n2,z\n')
    with pytest.raises(RuntimeError, match="b.csv is not closed"):
        land_cells(spark, str(folder), str(tmp_path / "l1"))
    (folder / "b.csv").write_text('b,a\n1,"x\ny"\n')
    with pytest.raises(RuntimeError, match="different headers"):
        land_cells(spark, str(folder), str(tmp_path / "l2"))
    (folder / "b.csv").write_text('a,b\n1,"x\ny",2\n')
    with pytest.raises(RuntimeError, match="1 row.* more fields"):
        land_cells(spark, str(folder), str(tmp_path / "l3"))
    (folder / "b.csv").write_text('a,b\n1,"x\ny"\n')
    landed, rows = land_cells(spark, str(folder), str(tmp_path / "l4"))
    assert rows == 2 and {r.b for r in landed.collect()} == {"x\ny"}
