"""Order statistics of a table that grows, against numpy."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from breachlens.operators import order_statistics
from breachlens.schema import NUMBER_COLUMNS
from breachlens.sources import ValueIndex

from test_sources import _rows_read


def random_parts(seed, parts):
    rng = random.Random(seed)
    draw = [lambda: rng.lognormvariate(5, 3), lambda: float(rng.randint(-3, 3)), lambda: -0.0, lambda: None, lambda: float("nan"),
            lambda: 1e300 * rng.random(), lambda: 7.0]
    return [[(rng.choice(draw)(), rng.choice(draw[:3])()) for _ in range(rng.randint(0, 80))] for _ in range(parts)]


@pytest.mark.parametrize("seed", [1, 2])
def test_merged_parts_equal_numpy(spark, tmp_path, seed):
    index = ValueIndex(spark, str(tmp_path / "index"), ["a", "b"])
    assert not index.exists()
    parts = random_parts(seed, 3)
    for part in parts:
        index.add(spark.createDataFrame(part, "a double, b double"))
    values = {c: np.sort([r[i] + 0.0 for p in parts for r in p if r[i] is not None and r[i] == r[i]]) for i, c in enumerate("ab")}
    assert index.counts() == {c: len(v) for c, v in values.items()} and index.rows() == sum(map(len, parts))
    shares = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    for some in (index, index.compact(str(tmp_path / "compact"))):
        found = some.quantiles(["a", "b"], shares)
        for c, v in values.items():
            for share in shares:
                assert found[c, share] == pytest.approx(float(np.quantile(v, share)), rel=1e-12)
        ranks = {c: {0, len(v) // 3, len(v) - 1} for c, v in values.items()}
        for (c, rank), s in some.order_statistics(ranks).items():
            v = values[c]
            assert (s.value, s.below, s.equal) == (v[rank], (v < v[rank]).sum(), (v == v[rank]).sum())


def test_an_append_reads_new_rows_and_open_buckets_only(spark, tmp_path):
    index = ValueIndex(spark, str(tmp_path / "index"), ["a"])
    index.add(spark.range(200_000).select((F.col("id") * 1.25 + 3).alias("a")))
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "index").rglob("*.parquet")}
    index.add(spark.createDataFrame([(5.0,), (6.0,), (-1.0,)], "a double"))
    assert all(p.stat().st_mtime_ns == t for p, t in before.items())
    wanted = {"a": {100_000}}
    held = index.order_statistics(wanted)["a", 100_000]
    rows = index.inside({"a": {(held.value - 1, held.value + 1, 0)}})
    assert rows.count() in (1, 2) and 0 < _rows_read(rows) < 60_000
    table = spark.range(200_000).select((F.col("id") * 1.25 + 3).alias("a")).union(spark.createDataFrame([(5.0,), (6.0,), (-1.0,)], "a double"))
    assert order_statistics(table, wanted)["a", 100_000] == held


def test_the_table_keeps_its_index(spark, make, tmp_path):
    from breachlens.sources import IncidentTable

    table = IncidentTable(spark, str(tmp_path / "t"), "t_with_index")
    table.replace(make())
    assert table.number_index().counts()["severity_score"] == 3
    table.insert(make(n=5).where("incident_id > 'INC-003'"))
    index = table.number_index()
    assert index.rows() == table.row_count() == 4
    wanted = {c: np.quantile([r[c] for r in spark.table(table.name).collect()], 0.5) for c in NUMBER_COLUMNS}
    assert {c: q for (c, _), q in index.quantiles(NUMBER_COLUMNS, [0.5]).items()} == pytest.approx(wanted)
    # rows that came in past the index: it is made anew
    table._as_stored(make(n=6).where("incident_id > 'INC-004'"), spark.table(table.name).schema.fields).write.insertInto(table.name)
    assert table.number_index().rows() == table.row_count()
    table.replace(make())
    assert table.number_index().rows() == 3
    table.vacuum(0)
    assert len(list((tmp_path / "t").glob("index-of-*"))) == 1
    spark.sql(f"DROP TABLE {table.name}")
