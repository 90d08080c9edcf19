"""What must not grow faster than the rows: partitions are sized by them, and rows that are in their buckets stay there."""

import time
from pathlib import Path
from types import SimpleNamespace

import pyarrow as pa
import pytest
from conftest import cleaned_of
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

import __spark_entry__ as registered
from breachlens import batch, fixture
from breachlens.batch import land_raw, run_batch
from breachlens.fixture import DIRTY_SQL, RAW_SQL, orders_first
from breachlens.functions import parse_number
from breachlens.operators import keep_first, sizing
from breachlens.plans import cleaning
from breachlens.plans.cleaning import clean_incidents, write_typed
from breachlens.plans.features import engineer_features
from breachlens.sources import csv_splits, incident_table, value_index, write_csv
from breachlens.sources.csv_files import land_cells
from breachlens.sources.incident_table import IncidentTable
from breachlens.sources.value_index import ValueIndex


@pytest.fixture
def table(spark, tmp_path):
    made = IncidentTable(spark, str(tmp_path / "table"), f"scaling_{tmp_path.name.replace('-', '_')}")
    yield made
    spark.sql(f"DROP TABLE IF EXISTS {made.name}")


def _rows_per_file(spark, folder):
    return [r["n"] for r in spark.read.parquet(folder).groupBy(F.input_file_name()).agg(F.count(F.lit(1)).alias("n")).collect()]


def test_a_table_gets_files_by_its_rows(spark, make, table, monkeypatch):
    """Also one that was defined empty, and an append."""
    monkeypatch.setattr(sizing, "WIDE_ROWS_PER_PARTITION", 20)
    table.create()
    buckets = table.bucket_count()
    version = table.replace(make(n=1000))["version"]
    assert table.bucket_count() == buckets and max(_rows_per_file(spark, version)) < 1000 / buckets / 2
    table.insert(make(n=3000).where("incident_id > 'INC-1000' and length(incident_id) > 7"))
    table.verify()
    fresh = IncidentTable(spark, f"{table.root}-fresh", f"{table.name}_fresh")
    fresh.replace(make(n=1000))
    assert fresh.bucket_count() == 100
    spark.sql(f"DROP TABLE {fresh.name}")


def test_clean_rows_reach_the_table_without_a_shuffle(spark, make, table):
    cleaned = cleaned_of(make(n=300))
    table.buckets = cleaned.buckets
    engineered = engineer_features(cleaned)
    table.store(engineered, expected_rows=300)
    with sizing.in_buckets(spark):
        for rows in (engineered, spark.table(table.name)):
            dealt = table._dealt(rows, cleaned.buckets, 300)
            dealt.collect()
            plan = dealt._jdf.queryExecution().executedPlan().toString()
            assert "hashpartitioning" not in plan.split("== Initial Plan")[0]
    assert {r["incident_id"] for r in spark.table(table.name).collect()} == {f"INC-{i:03d}" for i in range(300)}


def test_unreadable_values_are_found_before_rows_are_moved(spark, make, text_schema, tmp_path):
    rows = make([{"records_affected": "12abc"}], schema=text_schema).withColumn("place", F.monotonically_increasing_id())
    with pytest.raises(ValueError, match="records_affected: 1 invalid"):
        write_typed(rows, ["place"], str(tmp_path / "typed"))
    assert not Path(tmp_path / "typed").exists()
    # one on a row that is not kept does no harm
    second = rows.withColumns({"place": F.col("place") + 100, "incident_id": F.lit("INC-002")}).where("records_affected = '12abc'")
    good = rows.where("incident_id <> 'INC-001'")
    typed, measured = write_typed(good.union(second), ["place"], str(tmp_path / "kept"))
    assert measured["rows"] == 2 and {r["records_affected"] for r in typed.collect()} == {0.0, 200.0}


def test_an_index_is_shuffled_by_its_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(value_index, "NARROW_ROWS_PER_PARTITION", 100)
    widths = []
    write = value_index.shuffle_sized_for
    monkeypatch.setattr(value_index, "shuffle_sized_for", lambda s, rows, per: widths.append(-(-rows // per)) or write(s, rows, per))
    index = ValueIndex(spark, str(tmp_path / "index"), ["a"])
    index.add(spark.range(5000).select(F.col("id").cast("double").alias("a")))
    assert widths == [50] and index.order_statistics({"a": {2500}})["a", 2500].value == 2500.0


def test_line_items_are_joined_with_whole_orders():
    for sql in (RAW_SQL, DIRTY_SQL):
        text = orders_first(sql)
        assert text.index("{customer}") < text.index("ON l_orderkey = o_orderkey") and text.count("{orders}") == 1


def _shuffles(df):
    return df._jdf.queryExecution().executedPlan().toString().count("hashpartitioning")


def test_rows_landed_in_buckets_are_not_shuffled_for_their_first_ones(spark, make, tmp_path):
    """F3, F7, F9, F10."""
    rows = make(n=300).withColumn("place", F.monotonically_increasing_id())
    raw, n = land_raw(rows.union(rows.withColumn("place", F.col("place") + 1000)), ["place"], str(tmp_path / "raw"), 8)
    assert n == 600 and _shuffles(keep_first(raw, "incident_id", ["place"])) == 0
    cleaned = clean_incidents(raw, ["place"], n, str(tmp_path / "layers"), buckets=8)
    assert cleaned.buckets == 8 and cleaned.report["duplicates_removed"] == 300


def test_inserted_rows_of_a_table_in_as_many_buckets_stay_there(spark, make, table, monkeypatch):
    """the staged rows lie in the table's buckets, so neither the id check nor the append moves them."""
    other = IncidentTable(spark, f"{table.root}-other", f"{table.name}_other", 8)
    table.buckets = 8
    rows = make(n=2000)
    other.replace(rows)
    table.replace(spark.table(other.name).where("incident_date < '2025-05-01'"))
    staged, write = [], incident_table.write_buckets
    monkeypatch.setattr(incident_table, "write_buckets", lambda *a: staged.append(write(*a)) or staged[-1])
    later = spark.table(other.name).where("incident_date > '2025-05-01'")
    assert table.insert(later) == 666 and table.row_count() == 2000
    with sizing.in_buckets(spark):
        assert _shuffles(table._dealt(staged[0], 8, 666)) == 0
    # rows from elsewhere are staged as they come
    assert table.insert(make(n=2003).where("incident_id in ('INC-2000', 'INC-2001', 'INC-2002')")) == 3 and len(staged) == 1
    spark.sql(f"DROP TABLE {other.name}")


def test_twice_the_rows_stay_in_their_buckets(spark, make, table, monkeypatch):
    """buckets are made for twice the rows, so the table is not shuffled before they are full."""
    monkeypatch.setattr(sizing, "WIDE_ROWS_PER_PARTITION", 100)
    table.replace(make(n=1000))
    assert table.bucket_count() == 20
    twice = spark.table(table.name).select("*", F.explode(F.array(F.lit(1), F.lit(2))).alias("copy")).drop("copy")
    with sizing.in_buckets(spark):
        assert _shuffles(table._dealt(twice, 20, 2000)) == 0 and _shuffles(table._dealt(twice, 20, 2001)) == 1


def test_values_that_break_a_rule_are_looked_up_once(spark, make, text_schema, monkeypatch):
    """their number and their examples come from one pass over the first rows."""
    rows = make([{"incident_date": "2025/13/45"}], schema=text_schema)
    kept, write = [], cleaning.write_layer
    monkeypatch.setattr(cleaning, "write_layer", lambda df, path: kept.append(write(df, path)) or kept[-1])
    with pytest.raises(ValueError, match="1 invalid incident_date .*2025/13/45"):
        cleaning.check_readable(rows, ["incident_id"])
    assert [df.count() for df in kept] == [1]


def test_joins_are_sized_by_the_line_items(spark, monkeypatch):
    """a fixed number of parts would grow with the rows, and spill."""
    small = "/root/testdata/sf0.001"
    monkeypatch.setattr(fixture, "WIDE_ROWS_PER_PARTITION", 100)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with fixture.joins_sized(spark, small) as lines:
        assert int(spark.conf.get("spark.sql.shuffle.partitions")) == -(-lines // 100) > int(before)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_a_query_runs_the_stages_it_reads(spark):
    """F1, F3, F5, F7, F8, F10: raw rows and statistics do not wait for the published table."""
    built = registered.Layers(spark, "/root/testdata/sf0.001")
    built.raw
    assert "cleaned" not in vars(built) and "published" not in vars(built)
    built.cleaned
    assert "published" not in vars(built)
    assert built.table.row_count() == built.cleaned.report["final_rows"]


def test_number_text_is_cast_once(spark):
    """each mention of the cast was evaluated; -0.0 and texts that are no numbers read as before."""
    texts = spark.createDataFrame([("-0.0",), ("1e400",), ("nan",), ("1d",), (" 7 ",), (None,)], "t string")
    read = parse_number(F.col("t"), texts.schema["t"].dataType)
    assert [str(r[0]) for r in texts.select(read).collect()] == ["0.0", "inf", "None", "None", "7.0", "None"]
    assert texts.select(read).columns[0].count("TRY_CAST") == 1


def _refused(*_args, **_kwargs):
    raise AssertionError("this step is not needed for a file that can be read")


def test_the_cells_of_a_clean_file_are_landed_once(spark, make, tmp_path, monkeypatch):
    clean = cleaned_of(make(n=30)).df
    write_csv(clean, str(tmp_path / "clean"))
    for step in ("land_cells", "unreadable_columns", "check_readable"):
        monkeypatch.setattr(cleaning, step, _refused)
    read = cleaning.read_clean_csv(spark, str(tmp_path / "clean"))
    assert read.dtypes == clean.dtypes and sorted(read.collect()) == sorted(clean.collect())


def test_an_engineered_file_is_landed_and_checked_once(spark, make, tmp_path, monkeypatch):
    engineered = engineer_features(cleaned_of(make(n=30)))
    rows = sorted(engineered.withColumns({c: F.col(c).cast("int") for c, t in engineered.dtypes if t == "boolean"}).collect())
    write_csv(engineered, str(tmp_path / "engineered"))
    for step in ("land_cells", "check_complete", "measure"):
        monkeypatch.setattr(incident_table, step, _refused)
    assert sorted(incident_table.load_engineered(spark, str(tmp_path / "engineered"), csv=True).collect()) == rows


def test_a_run_from_csv_reads_each_value_once(spark, make, tmp_path, monkeypatch):
    rows = make([{"zero_day_used": " YES "}, {"records_affected": None}, {"incident_date": "2025-1-5"}], schema="""incident_id string,
        incident_date string, sector string, region string, attack_type string, threat_actor string, records_affected string,
        downtime_hours string, ransom_demand_usd string, detection_time_hours string, severity_score string,
        response_team_size string, regulatory_fine_usd string, resolved_within_7_days string, data_exfiltration string,
        zero_day_used string""".replace("\n", " "))
    write_csv(rows, str(tmp_path / "good"))
    write_csv(rows.withColumn("records_affected", F.lit("12abc")), str(tmp_path / "bad"))
    name = f"run_{tmp_path.name.replace('-', '_')}"
    with pytest.raises(ValueError, match="records_affected: 3 invalid numeric values"):
        run_batch(spark, str(tmp_path / "bad"), str(tmp_path / "t1"), table_name=name)
    monkeypatch.setattr(batch, "land_cells", _refused)
    result = run_batch(spark, str(tmp_path / "good"), str(tmp_path / "t2"), table_name=name)
    found = {r["incident_id"]: r for r in spark.table(name).collect()}
    assert result.summary["database_records"] == 3 and found["INC-001"]["zero_day_used"] == 1
    assert found["INC-002"]["records_affected"] == 500 and str(found["INC-003"]["incident_date"]) == "2025-01-05"
    spark.sql(f"DROP TABLE {name}")


def test_csv_input_keeps_each_bucket_in_one_sorted_file(spark, make, tmp_path, monkeypatch):
    twice = make(n=60).withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(3))))
    rows = twice.select("*", (F.hash("incident_id", "copy") % 1000).alias("src_partkey"), F.lit(1).alias("src_suppkey"), F.lit(1.0).alias("src_price"))
    raw, n = land_raw(rows.drop("copy").withColumn("sector", F.col("src_partkey").cast("string")), fixture.ORDER_COLUMNS, str(tmp_path / "raw"), 8)
    monkeypatch.setattr(registered, "layers", lambda *_: SimpleNamespace(raw=raw, landed=(raw, n)))
    path = registered.ordered_csv(spark, str(tmp_path))
    read = spark.read.csv(path, header=True, inferSchema=False).select(
        "incident_id", F.col("sector").cast("int").alias("place"), F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("row")
    )
    per_id = read.groupBy("incident_id").agg(
        F.countDistinct("file").alias("files"), F.min_by("place", "row").alias("first"), F.min("place").alias("least"), F.count("*").alias("n")
    ).collect()
    assert len(per_id) == 60 and all(r["files"] == 1 and r["first"] == r["least"] and r["n"] == 3 for r in per_id)


def test_lines_without_quotes_are_not_read_one_by_one(monkeypatch):
    lines = ["a,b", "1,x", "", *[f"{i},plain" for i in range(2000)], '7,"open', "middle", 'end"', *[f"{i},after" for i in range(2000)], '8,"cut']
    n = len(lines)
    data = [lines, ["f"] * n, [0] * n, list(range(n)), [None] * n]
    types = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
    given = pa.RecordBatch.from_arrays([pa.array(d, t) for d, t in zip(data, types)], ["value", "file", "block", "row", "begins"])
    seen, state_after = [], csv_splits.state_after
    monkeypatch.setattr(csv_splits, "state_after", lambda line, inside: seen.append(line) or state_after(line, inside))
    out = [r for b in csv_splits._records(iter([given.slice(0, 900), given.slice(900)])) for r in b.to_pylist()]
    assert len(seen) < 20
    whole = {r["row"]: r["record"] for r in out if r["part"] == csv_splits.WHOLE}
    expected = {i: line for i, line in enumerate(lines) if line and i not in (0, 2003, 2004, 2005, n - 1)} | {2003: '7,"open\nmiddle\nend"'}
    assert whole == expected
    assert [(r["row"], r["part"], r["record"]) for r in out if r["part"] != csv_splits.WHOLE] == [
        (0, csv_splits.HEADER, "a,b"), (n - 1, csv_splits.FIRST, '8,"cut')
    ]


def _shuffled_rows_left(spark, before=()):
    """Shuffle files beyond those of a few sums."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    found = [files.apply(i) for i in range(files.size())]
    return {f.getName() for f in found if f.getName().startswith("shuffle_") and f.length() > 4096} - set(before)


def _in_all_turns(make):
    rows = make(n=300).withColumn("place", F.monotonically_increasing_id())
    return rows.union(rows.withColumn("place", F.col("place") + 1000))


def test_shuffle_files_do_not_outlive_their_statement(spark, make, tmp_path, monkeypatch):
    """They stayed until the driver collected garbage, beside the layers that were written later."""
    before = _shuffled_rows_left(spark)
    rows = _in_all_turns(lambda n: make(n=3000))
    rows.repartition(3, "incident_id").write.parquet(str(tmp_path / "plain"))
    assert _shuffled_rows_left(spark, before)
    before = _shuffled_rows_left(spark)
    insert, removed = DataFrameWriter.insertInto, []  # else files go when the driver happens to collect its garbage
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    monkeypatch.setattr(DataFrameWriter, "insertInto", lambda w, name: removed.append(spark.conf.get(setting)) or insert(w, name))
    land_raw(rows, ["place"], str(tmp_path / "raw"), 8)
    until = time.time() + 10
    while _shuffled_rows_left(spark, before) and time.time() < until:
        time.sleep(0.1)
    assert not _shuffled_rows_left(spark, before) and removed == ["true"] and spark.conf.get(setting) == "false"


def test_many_buckets_are_filled_turn_by_turn(spark, make, tmp_path, monkeypatch):
    """The shuffle of all rows lay on the disks at once, with those of the joins behind them."""
    monkeypatch.setattr(sizing, "BUCKETS_IN_A_TURN", 3, raising=False)
    inserted, insert = [], DataFrameWriter.insertInto
    monkeypatch.setattr(DataFrameWriter, "insertInto", lambda w, name: inserted.append(w._df.count()) or insert(w, name))
    drawn = _in_all_turns(make).withColumn("drawn", F.rand()).repartition(3, "region")  # other values in a second run
    raw, n = land_raw(drawn, ["place"], str(tmp_path / "raw"), 8)
    assert n == 600 and len(inserted) == 3 and sum(inserted) == 600 and max(inserted) < 400
    assert _shuffles(keep_first(raw, "incident_id", ["place"])) == 0
    assert sorted(raw.select("incident_id", "place").collect()) == sorted(drawn.select("incident_id", "place").collect())
    assert {p.name for p in tmp_path.iterdir()} == {"raw"}
    # one file for each bucket that has rows
    assert len(list((tmp_path / "raw").glob("*.parquet"))) <= 8
    again, _ = land_raw(raw, ["place"], str(tmp_path / "again"), 8)  # these rows stay where they are
    assert len(inserted) == 4 and sorted(again.collect()) == sorted(raw.collect())


def test_layers_and_tables_are_packed(spark, make, table, tmp_path):
    raw, n = land_raw(_in_all_turns(make), ["place"], str(tmp_path / "raw"), 8)
    version = table.replace(make(n=30))["version"]
    for folder in (tmp_path / "raw", Path(version)):
        assert [p for p in folder.rglob("*.parquet")] and all(p.name.endswith(".zstd.parquet") for p in folder.rglob("part-*.parquet"))


@pytest.mark.parametrize("given", ["rows", "file"])
def test_a_run_removes_its_landed_rows(spark, make, tmp_path, monkeypatch, given):
    """They lay beside the clean layer and the table to the end, a second copy of the source."""
    name, work = f"landed_{given}_{tmp_path.name.replace('-', '_')}", tmp_path / "work-1"
    monkeypatch.setattr(batch, "new_folder", lambda *_: str(work))
    source, order = _in_all_turns(make), ["place"]
    if given == "file":
        write_csv(make(n=300), str(tmp_path / "csv"))
        source, order = str(tmp_path / "csv"), None
    landed, clean = [], batch.clean_incidents
    monkeypatch.setattr(batch, "clean_incidents", lambda *a, **b: landed.append(list(work.rglob("*.parquet"))) or clean(*a, **b))
    result = run_batch(spark, source, str(tmp_path / "target"), table_name=name, order_by=order)
    assert landed[0] and not any(p.exists() for p in landed[0])
    assert result.summary["database_records"] == spark.table(name).count() == result.cleaned.df.count() == result.cleaned.typed.count() == 300
    spark.sql(f"DROP TABLE {name}")


def test_packed_csv_is_read_like_plain(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sizing, "WIDE_ROWS_PER_PARTITION", 40)
    rows = spark.range(100).select(
        F.col("id").cast("string").alias("a"), F.when(F.col("id") % 7 == 0, F.lit('x\n"y"\n, z')).otherwise(" p q ").alias("b"),
        F.when(F.col("id") % 3 > 0, F.lit("\u00e9,7")).alias("c"),
    ).coalesce(1)
    found = {}
    for packed in (False, True):
        write_csv(rows, str(tmp_path / f"{packed}"), packed=packed)
        landed, n = land_cells(spark, str(tmp_path / f"{packed}"), str(tmp_path / f"landed-{packed}"))
        found[packed] = sorted(map(str, landed.select("a", "b", "c").collect()))
        assert n == 100
    assert found[True] == found[False] == sorted(map(str, rows.collect()))
    files = list((tmp_path / "True").glob("part-*"))
    assert len(files) == 3 and all(p.name.endswith(".csv.gz") for p in files)


def _exported(monkeypatch, tmp_path, reader):
    """The files that a query's reader is given."""
    seen, read = [], getattr(registered, reader)
    monkeypatch.setattr(registered, "new_folder", lambda *_: str(tmp_path / "csv"))
    monkeypatch.setattr(registered, reader, lambda s, p, **b: seen.extend(x.name for x in Path(p).glob("part-*")) or read(s, p, **b))
    return seen


def test_an_exported_clean_layer_is_packed_and_dropped_once_landed(spark, make, tmp_path, monkeypatch):
    cleaned = cleaned_of(make(n=300))
    monkeypatch.setattr(registered, "layers", lambda *_: SimpleNamespace(cleaned=cleaned))
    seen = _exported(monkeypatch, tmp_path, "read_clean_csv")
    rows = registered.clean_csv(spark, "")
    assert seen and all(x.endswith(".csv.gz") for x in seen) and not (tmp_path / "csv").exists()
    assert sorted(rows.collect()) == sorted(registered._shown(cleaned.df).collect()) and rows.count() == 300


def test_an_exported_table_is_packed_and_dropped_once_landed(spark, make, tmp_path, monkeypatch):
    engineered = engineer_features(cleaned_of(make(n=300)))
    table = engineered.withColumns({c: F.col(c).cast("int") for c, t in engineered.dtypes if t == "boolean"})
    monkeypatch.setattr(registered, "incidents", lambda *_: table)
    seen = _exported(monkeypatch, tmp_path, "load_engineered")
    rows = registered.engineered_csv(spark, "")
    assert seen and all(x.endswith(".csv.gz") for x in seen) and not (tmp_path / "csv").exists()
    assert sorted(rows.collect()) == sorted(registered._shown(table).collect()) and rows.count() == 300
