import csv
import uuid

import pytest
from conftest import ROWS, SCHEMA, cleaned_of
from pyspark.sql import functions as F

import breachlens.sources.workspace as workspace
from breachlens.batch import land_csv, land_raw, run_batch, save_summary
from breachlens.operators.checks import check_header
from breachlens.operators.sizing import shuffle_sized_for
from breachlens.plans.analytics import QUESTIONS
from breachlens.plans.cleaning import read_clean_csv
from breachlens.plans.features import engineer_features
from breachlens.schema import FLAG_COLUMNS, INCIDENT_COLUMNS, MISSING_CELLS
from breachlens.sources import IncidentTable, read_header, read_incident_csv, write_csv
from breachlens.sources.csv_files import text_faults
from breachlens.sources.incident_table import load_engineered

NAMES = [f.strip().split(" ")[0] for f in SCHEMA.split(",")]


@pytest.fixture
def write_file(tmp_path):
    def write(lines, name="raw.csv", encoding="utf-8"):
        path = tmp_path / name
        path.write_text("\n".join(lines) + "\n", encoding=encoding)
        return str(path)

    return write


def lines_of(rows=ROWS, names=NAMES):
    return [",".join(names), *[",".join(str(v) for v in row) for row in rows]]


@pytest.fixture
def table(spark, tmp_path, request):
    name = "t_" + "".join(c for c in request.node.name if c.isalnum())
    return IncidentTable(spark, str(tmp_path / "table"), name)


# --- CSV ------------------------------------------------------------------------
def test_missing_file(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="Dataset not found"):
        land_csv(spark, str(tmp_path / "missing.csv"), str(tmp_path / "landed"))


def test_header_is_read_as_it_stands(spark, write_file):
    assert read_header(spark, write_file(["a, ,a", "1,2,3"])) == ["a", " ", "a"]
    assert read_header(spark, write_file(['"a,b",c'], "q.csv")) == ["a,b", "c"]
    assert read_header(spark, write_file(["a,b"], "bom.csv", "utf-8-sig")) == ["a", "b"]


@pytest.mark.parametrize(
    "names, message",
    [
        ([*NAMES, " "], "blank"),
        ([*NAMES, "sector"], r"repeated: \['sector'\]"),
        ([n for n in NAMES if n != "region"], "Missing Columns"),
    ],
)
def test_bad_headers(spark, write_file, tmp_path, names, message):
    with pytest.raises(ValueError, match=message):
        land_csv(spark, write_file([",".join(names), "x"]), str(tmp_path / "landed"))


def test_header_check_accepts_extras():
    check_header([*INCIDENT_COLUMNS, "more"])


def test_file_without_rows(spark, write_file, tmp_path):
    with pytest.raises(ValueError, match="no rows"):
        land_csv(spark, write_file([",".join(NAMES)]), str(tmp_path / "landed"))


def test_missing_id(spark, write_file, tmp_path):
    with pytest.raises(ValueError, match="no incident_id"):
        land_csv(spark, write_file([*lines_of(), "NA," + ",".join(map(str, ROWS[0][1:]))]), str(tmp_path / "l"))


@pytest.mark.parametrize("multi_line", [True, False])
def test_cells_of_all_kinds(spark, write_file, multi_line):
    names = ["a", "b", "c"]
    lines = ["a,b,c", "1,2,3", '4,"x ""q"", y",6', "7,8", "", "   ", "NA, NA ,", "é,null,<NA>"]
    got = read_incident_csv(spark, write_file(lines), multi_line).select(*names, "_too_long")
    assert [tuple(r) for r in got.collect()] == [
        ("1", "2", "3", False), ("4", 'x "q", y', "6", False), ("7", "8", None, False),
        (None, " NA ", None, False), ("é", None, None, False),
    ]


@pytest.mark.parametrize("multi_line", [True, False])
def test_windows_files(spark, tmp_path, multi_line):
    """A byte-order mark and CR LF line ends."""
    path = tmp_path / "windows.csv"
    path.write_bytes("\ufeffa,b\r\n1, x \r\nNA,é\r\n".encode())
    got = read_incident_csv(spark, str(path), multi_line).select("a", "b", "_too_long").collect()
    assert [tuple(r) for r in got] == [("1", " x ", False), (None, "é", False)]


def test_line_break_in_quotes(spark, write_file):
    path = write_file(["a,b", '1,"x', 'y"', "2,z"])
    assert text_faults(spark, path) == (0, True)
    got = read_incident_csv(spark, path, True).select("a", "b").collect()
    assert [tuple(r) for r in got] == [("1", "x\ny"), ("2", "z")]


@pytest.mark.parametrize("extra", [",1", ",", ',"a,b"'])
def test_row_with_too_many_fields(spark, write_file, tmp_path, extra):
    bad = lines_of()
    bad[2] += extra
    with pytest.raises(RuntimeError, match=r"Unable to load dataset: 1 row"):
        land_csv(spark, write_file(bad), str(tmp_path / "landed"))


def test_files_with_another_header_fail(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    (folder / "a.csv").write_text("\n".join(lines_of()) + "\n")
    swapped = [NAMES[1], NAMES[0], *NAMES[2:]]
    (folder / "b.csv").write_text("\n".join(lines_of(ROWS[:1], swapped)) + "\n")
    with pytest.raises(RuntimeError, match="Unable to load dataset"):
        land_csv(spark, str(folder), str(tmp_path / "landed"))


def test_every_missing_spelling_is_read_as_null(spark, tmp_path):
    path = tmp_path / "na.csv"
    with path.open("w", newline="") as file:
        out = csv.writer(file)
        out.writerow(["a", "b"])
        out.writerows(["row", token] for token in MISSING_CELLS)
    got = read_incident_csv(spark, str(path), False).select("a", "b").collect()
    assert [tuple(r) for r in got] == [("row", None)] * len(MISSING_CELLS)


def test_csv_sink_keeps_cells(spark, tmp_path):
    rows = [("a\nb", ' q"x", ', "é"), ("  lead", "trail  ", "back\\slash"), ("x", None, "7,5")]
    write_csv(spark.createDataFrame(rows, "a string, b string, c string"), str(tmp_path / "out"))
    got = read_incident_csv(spark, str(tmp_path / "out"), True).select("a", "b", "c").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, rows))


def test_first_duplicate_in_file_order_wins(spark, tmp_path):
    """Order by file name, then by row: the larger, later file is scanned first."""
    folder = tmp_path / "many"
    folder.mkdir()
    first = [list(ROWS[0])]
    first[0][2] = "Transport"
    later = [list(r) for r in ROWS] + [["X-%d" % i, *ROWS[1][1:]] for i in range(500)]
    (folder / "a.csv").write_text("\n".join(lines_of(first)) + "\n")
    (folder / "b.csv").write_text("\n".join(lines_of(later)) + "\n")
    result = run_batch(spark, str(folder), str(tmp_path / "target"), table_name="t_file_order")
    row = spark.table("t_file_order").where("incident_id = 'INC-001'").first()
    assert row["sector"] == "Transport" and result.summary["clean_records"] == 503


def test_shared_folder_setting(spark, monkeypatch):
    assert workspace.new_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))

    class Context:
        master, applicationId = "spark://far", "app"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda name, default="/shared/warehouse/": default)

    # never a folder of one machine: the warehouse is shared as well
    assert workspace.new_folder(Session, "x").startswith("/shared/warehouse/_work/")
    assert workspace.new_folder(Session, "x") != workspace.new_folder(Session, "x")


# --- whole run ------------------------------------------------------------------
def test_run_from_csv(spark, write_file, tmp_path):
    rows = [*ROWS, ROWS[0]]
    target = tmp_path / "target"
    result = run_batch(spark, write_file(lines_of(rows)), str(target), table_name="t_run", export_csv=True)
    assert result.summary == {
        "status": "SUCCESS", "raw_records": 4, "clean_records": 3, "engineered_records": 3,
        "database_records": 3, "original_features": 16, "engineered_features": 43, "new_features_created": 27,
    }
    assert result.table.row_count() == 3
    assert spark.read.csv(str(target / "reports/summary_report"), header=True).first()["status"] == "SUCCESS"
    assert spark.read.json(str(target / "reports/cleaning_report")).first()["duplicates_removed"] == 1
    engineered = spark.read.csv(str(target / "exports/engineered_incidents"), header=True)
    assert engineered.count() == 3 and len(engineered.columns) == 43
    assert spark.read.csv(str(target / "exports/clean_incidents"), header=True).columns == INCIDENT_COLUMNS
    # a second run replaces the rows and keeps the old version on disk
    run_batch(spark, write_file(lines_of(ROWS[:2]), "less.csv"), str(target), table_name="t_run")
    assert spark.table("t_run").count() == 2
    assert len(list((target / "t_run").glob("version-*/_SUCCESS"))) == 2


def test_entry_from_the_shell(spark, write_file, tmp_path, monkeypatch, capsys):
    from breachlens.__main__ import main

    arguments = [write_file(lines_of()), str(tmp_path / "out"), "--table", "t_shell", "--no-multi-line"]
    monkeypatch.setattr("sys.argv", ["breachlens", *arguments])
    main()
    assert "clean_records: 3" in capsys.readouterr().out
    assert spark.table("t_shell").count() == 3


def test_failed_run_keeps_the_table(spark, write_file, tmp_path):
    target = str(tmp_path / "target")
    run_batch(spark, write_file(lines_of()), target, table_name="t_kept")
    late = [list(ROWS[0])]
    late[0][1] = "2099-01-01"
    with pytest.raises(ValueError, match="future"):
        run_batch(spark, write_file(lines_of(late), "late.csv"), target, table_name="t_kept")
    assert spark.table("t_kept").count() == 3


def test_load_checks_of_a_dataframe(spark, make, tmp_path):
    def land(df, order=("incident_date",)):
        return land_raw(df, list(order), f"{tmp_path}/{uuid.uuid4().hex}")

    landed, rows = land(make())
    assert rows == landed.count() == 3
    for bad, message in [
        (make().limit(0), "no rows"), (make([{"incident_id": None}]), "no incident_id"), (make().drop("region"), "Missing Columns"),
    ]:
        with pytest.raises(ValueError, match=message):
            land(bad)
    with pytest.raises(ValueError, match="order_by"):
        land(make(), [])


def test_a_dataframe_source_is_evaluated_once(spark, make, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = make()
    source = rows.mapInArrow(count, rows.schema)
    run_batch(spark, source, str(tmp_path / "t"), table_name="t_once", order_by=["incident_date"])
    assert seen.value == 3


# --- what a file must not get away with ---------------------------------------------
def test_text_that_is_not_utf8_raises(spark, tmp_path):
    path = tmp_path / "latin.csv"
    path.write_bytes("\n".join(lines_of()).replace("Retail", "Caf\u00e9").encode("latin-1"))
    with pytest.raises(RuntimeError, match="1 line.* not valid UTF-8"):
        land_csv(spark, str(path), str(tmp_path / "landed"))


def test_leading_blank_lines_are_skipped(spark, write_file, tmp_path):
    for multi_line, blank in ((False, ["", "  "]), (True, ["", ""])):
        _, rows = land_csv(spark, write_file([*blank, *lines_of()]), str(tmp_path / f"l{multi_line}"), multi_line)
        assert rows == 3


def test_long_quoted_cell_in_a_short_row(spark, write_file, tmp_path):
    """A row with fewer cells than the header, one of them a megabyte with quotes in it."""
    names = [*NAMES, "note", "more"]
    lines = [",".join(names), ",".join(map(str, ROWS[0])) + ',"' + 'x, ""y"" ' * 125_000 + '"']
    landed, rows = land_csv(spark, write_file(lines), str(tmp_path / "landed"))
    row = landed.first()
    assert rows == 1 and len(row["note"]) == 7 * 125_000 and row["more"] is None


def test_files_are_split_unless_a_quoted_cell_spans_lines(spark, write_file, tmp_path):
    plain = write_file([*lines_of(), ",".join(map(str, ROWS[0])).replace("Energy", '"a ""quoted"" one"')])
    assert text_faults(spark, plain) == (0, False)
    broken = lines_of([[*ROWS[0][:2], '"two\nlines"', *ROWS[0][3:]]])
    landed, rows = land_csv(spark, write_file(broken, "broken.csv"), str(tmp_path / "landed"))
    assert rows == 1 and landed.first()["sector"] == "two\nlines"


@pytest.mark.parametrize("read", [read_clean_csv, lambda s, p: load_engineered(s, p, csv=True)])
def test_exported_files_are_read_strictly(spark, make, write_file, tmp_path, read):
    engineered = engineer_features(cleaned_of(make()))
    write_csv(engineered.coalesce(1), str(tmp_path / "out"))
    lines = next((tmp_path / "out").glob("part-*.csv")).read_text().splitlines()
    assert read(spark, write_file(lines, "ok.csv")).count() == 3
    with pytest.raises(RuntimeError, match="more fields"):
        read(spark, write_file([lines[0], lines[1] + ",1", *lines[2:]], "long.csv"))
    place = lines[0].split(",").index("downtime_hours")
    cells = lines[1].split(",")
    cells[place] = "12abc"
    with pytest.raises(ValueError, match="invalid numeric|cannot be read in .*downtime_hours"):
        read(spark, write_file([lines[0], ",".join(cells), *lines[2:]], "bad.csv"))


def test_bad_summary_is_rejected(spark, tmp_path):
    with pytest.raises(ValueError, match="summary"):
        save_summary(spark, {"status": "FAILED", "raw_records": 1}, str(tmp_path / "s"))


# --- table ----------------------------------------------------------------------
def test_table_round_trip(spark, make, table):
    engineered = engineer_features(cleaned_of(make()))
    table.create(engineered)
    table.replace(engineered)
    table.verify()
    table.verify_schema(engineered)
    assert table.row_count() == 3
    assert [r["incident_id"] for r in table.preview(2).collect()] == ["INC-001", "INC-002"]
    assert table.fetch(f"SELECT count(*) AS total FROM {table.name}").first()["total"] == 3
    types = {r["name"]: r["type"] for r in table.schema().collect()}
    assert types["zero_day_used"] == "int" and types["incident_date"] == "date"
    assert [r["name"] for r in table.schema().where("is_key").collect()] == ["incident_id"]
    with pytest.raises(ValueError):
        table.preview(0)


def test_table_with_role_types_is_extended(spark, make, table):
    table.create()
    assert spark.table(table.name).columns == INCIDENT_COLUMNS
    table.insert(make())
    engineered = engineer_features(cleaned_of(make(n=5).where("incident_id > 'INC-003'")))
    with pytest.raises(ValueError, match="lacks the columns"):
        table.insert(engineered)
    table.create(engineered)
    table.insert(engineered)
    rows = spark.table(table.name)
    assert rows.count() == 4 and rows.where("risk_score IS NULL").count() == 3
    assert rows.where("zero_day_used NOT IN (0, 1)").count() == 0


def test_append_rules(spark, make, table):
    with pytest.raises(ValueError, match="no rows"):
        table.insert(make().limit(0))
    with pytest.raises(ValueError, match="if_exists"):
        table.insert(make(), "replace")
    table.insert(make().where("incident_id = 'INC-001'"))
    with pytest.raises(ValueError, match="already"):
        table.insert(make(), "fail")
    with pytest.raises(ValueError, match="unique"):
        table.insert(make())
    with pytest.raises(ValueError, match="unique"):
        table.insert(make(n=6).withColumn("incident_id", F.lit("same")))
    assert table.insert(make().where("incident_id <> 'INC-001'").select(*reversed(INCIDENT_COLUMNS))) == 2
    assert spark.table(table.name).where("incident_id = 'INC-003'").first()["severity_score"] == 9


def test_replace_is_all_or_nothing(spark, make, table):
    table.replace(make())
    for bad in (make().limit(0), make().union(make()), make([{"incident_id": None}])):
        with pytest.raises(ValueError):
            table.replace(bad)
        assert table.row_count() == 3
    with pytest.raises(ValueError, match="gaps"):
        table.store(make([{"sector": None}]))
    with pytest.raises(ValueError, match="3 rows instead of 4"):
        table.store(make(), expected_rows=4)
    broken = make().withColumn("severity_score", F.when(F.col("incident_id") > "", F.raise_error(F.lit("lost"))))
    with pytest.raises(Exception, match="lost"):
        table.replace(broken)
    assert table.row_count() == 3


def test_replace_from_own_rows(spark, make, table):
    table.replace(make())
    table.rewrite(lambda rows: rows.where("sector = 'Energy'").withColumn("region", F.lit("East")))
    assert {r["region"] for r in spark.table(table.name).collect()} == {"East"} and table.row_count() == 2


def test_verify_reports(spark, make, table, tmp_path):
    with pytest.raises(ValueError, match="no table"):
        table.verify()
    table.replace(make())
    table.attach(table.replace(make().limit(2))["version"])
    assert table.row_count() == 2


def test_statements_and_parameters(spark, make, table, tmp_path):
    table.replace(make())
    table.execute(f"ALTER TABLE {table.name} ADD COLUMNS (note STRING)")
    table.execute(f"INSERT INTO {table.name} (incident_id, severity_score) VALUES (?, ?)", ["INC-009", 3.0])
    assert table.row_count() == 4
    by_name = table.fetch(f"SELECT incident_id FROM {table.name} WHERE severity_score = :s", {"s": 9})
    assert by_name.first()["incident_id"] == "INC-003"
    table.export(f"SELECT sector, count(*) AS n FROM {table.name} WHERE note IS NULL GROUP BY sector",
                 str(tmp_path / "out"))
    got = spark.read.csv(str(tmp_path / "out"), header=True).collect()
    assert {(r["sector"], r["n"]) for r in got} == {("Energy", "2"), ("Retail", "1"), (None, "1")}


def test_sql_text_gives_the_same_answers(spark, make, table):
    """Statements as an SQL user writes them, with REAL casts, chained CTEs and rank windows."""
    table.store(engineer_features(cleaned_of(make())))
    rows = spark.table(table.name)
    texts = {
        "q16_resolution_rate": "SELECT ROUND(100 * AVG(CAST(resolved_within_7_days AS REAL)), 2) AS r FROM {t}",
        "q22_leading_actors": "WITH c AS (SELECT region, threat_actor, COUNT(*) AS n FROM {t} GROUP BY 1, 2), "
        "r AS (SELECT *, RANK() OVER (PARTITION BY region ORDER BY n DESC) AS p FROM c) "
        "SELECT region, threat_actor, n FROM r WHERE p = 1 ORDER BY 1, 2",
        "q27_impact_by_attack": "SELECT attack_type, COUNT(*), ROUND(SUM(total_financial_impact), 2) AS "
        "total_financial_impact, ROUND(AVG(total_financial_impact), 2) FROM {t} GROUP BY attack_type "
        "ORDER BY total_financial_impact DESC, attack_type",
    }
    for name, text in texts.items():
        got = [tuple(r) for r in table.fetch(text.replace("{t}", table.name)).collect()]
        assert got == [tuple(r) for r in QUESTIONS[name](rows).collect()], name


def test_table_under_a_quoted_path(spark, make, tmp_path):
    table = IncidentTable(spark, str(tmp_path / "it's a table"), "t_quoted_path")
    table.replace(make())
    assert table.row_count() == 3


def test_load_engineered(spark, make, tmp_path):
    with pytest.raises(FileNotFoundError):
        load_engineered(spark, str(tmp_path / "none"))
    engineered = engineer_features(cleaned_of(make()))
    engineered.write.parquet(str(tmp_path / "ok"))
    loaded = load_engineered(spark, str(tmp_path / "ok"))
    assert {r["zero_day_used"] for r in loaded.collect()} == {0, 1}
    cases = {
        "no rows": engineered.limit(0),
        "repeats": engineered.union(engineered),
        "lacks columns": engineered.drop("sector"),
        "gaps": engineered.withColumn("risk_score", F.lit(None).cast("double")),
        "invalid numeric": engineered.withColumn("downtime_hours", F.lit(float("inf"))),
        "flags other": engineered.withColumn("zero_day_used", F.lit(2)),
    }
    for i, (message, df) in enumerate(cases.items()):
        df.write.parquet(str(tmp_path / f"bad{i}"))
        with pytest.raises(ValueError, match=message):
            load_engineered(spark, str(tmp_path / f"bad{i}"))


def test_exported_csv_is_read_back(spark, make, tmp_path):
    cleaned = cleaned_of(make([{"sector": 'a "quoted", one'}]))
    write_csv(cleaned.df, str(tmp_path / "clean"))
    assert sorted(read_clean_csv(spark, str(tmp_path / "clean")).collect()) == sorted(cleaned.df.collect())
    engineered = engineer_features(cleaned)
    write_csv(engineered, str(tmp_path / "engineered"))
    loaded = load_engineered(spark, str(tmp_path / "engineered"), csv=True)
    want = engineered.withColumns({c: F.col(c).cast("int") for c in FLAG_COLUMNS})
    assert loaded.dtypes == want.dtypes
    assert sorted(loaded.collect()) == sorted(want.collect())
    write_csv(engineered.withColumn("zero_day_used", F.lit("maybe")), str(tmp_path / "bad"))
    with pytest.raises(ValueError, match="flags other than 0 and 1 in zero_day_used"):
        load_engineered(spark, str(tmp_path / "bad"), csv=True)
    with pytest.raises(FileNotFoundError, match="Dataset not found"):
        load_engineered(spark, str(tmp_path / "none"), csv=True)


def test_shuffle_size_grows_with_rows_and_is_restored(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with shuffle_sized_for(spark, 100, 10):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "10"
    with shuffle_sized_for(spark, 5, 10):
        assert spark.conf.get("spark.sql.shuffle.partitions") == before
    with pytest.raises(RuntimeError), shuffle_sized_for(spark, 1000, 1):
        raise RuntimeError
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_all_questions_run(spark, make, table):
    assert len(QUESTIONS) == 29
    table.store(engineer_features(cleaned_of(make())))
    rows = {name: [tuple(r) for r in ask(spark.table(table.name)).collect()] for name, ask in QUESTIONS.items()}
    assert rows["q01_total_incidents"] == [(3,)]
    assert rows["q02_average_severity"] == [(7.0,)]
    assert rows["q03_most_severe"][0] == ("INC-003", 9.0, "Malware", "Energy")
    assert rows["q04_by_sector"] == [("Energy", 2), ("Retail", 1)]
    assert rows["q08_monthly_trend"] == [(2025, 3, 1), (2025, 4, 1), (2025, 11, 1)]
    assert rows["q12_zero_day_split"] == [(1, 1), (0, 2)]
    assert rows["q16_resolution_rate"] == [(66.67,)]
    assert rows["q18_high_severity"] == [("INC-003", 9.0, "Energy"), ("INC-001", 8.0, "Energy")]
    assert rows["q20_costliest_sectors"] == [("Energy", 26200.0), ("Retail", 0.0)]
    assert rows["q22_leading_actors"] == [("East", "Group X", 1), ("South", "Group X", 1), ("South", "Group Y", 1)]
    assert rows["q25_dashboard"] == [(3, 7.0, 34.0, 26200.0, 24.33, 66.67, 5.0)]
    assert rows["q26_high_risk_count"] == [(2,)]
    assert rows["q27_impact_by_attack"][0] == ("Malware", 2, 26200.0, 13100.0)
    assert rows["q29_table_sanity"] == [(3, 3, 0, 0, 0)]


# --- rules on statements and versions -------------------------------------------------
def test_insert_statements_obey_the_table(spark, make, table):
    table.replace(make())
    for statement in (f"INSERT INTO {table.name} SELECT * FROM {table.name}",
                      f"insert into table `{table.name}` (incident_id) values ('INC-001')",
                      f"INSERT INTO {table.name} (incident_id) VALUES ('x'), ('x')",
                      f"INSERT INTO {table.name} (incident_id) VALUES (NULL)"):
        with pytest.raises(ValueError, match="unique"):
            table.execute(statement)
        assert table.row_count() == 3
    with pytest.raises(ValueError, match="values for"):
        table.execute(f"INSERT INTO {table.name} VALUES ('INC-009')")
    table.execute(f"INSERT OVERWRITE {table.name} SELECT * FROM {table.name} WHERE incident_id = 'INC-002'")
    assert table.row_count() == 1


def test_insert_evaluates_its_rows_once(spark, make, table):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = make()
    assert table.insert(rows.mapInArrow(count, rows.schema)) == 3
    assert seen.value == 3


def test_failed_replace_adds_no_column(spark, make, table):
    table.replace(make())
    before = spark.table(table.name).columns
    with pytest.raises(ValueError):
        table.store(make([{"sector": None}]).withColumn("note", F.lit("x")))
    assert spark.table(table.name).columns == before
    table.replace(make().withColumn("note", F.lit("x")))
    assert spark.table(table.name).columns == [*before, "note"]


def test_vacuum_keeps_the_present_version(spark, make, table, tmp_path):
    versions = [table.replace(make())["version"].rsplit("/", 1)[-1] for _ in range(4)]
    assert set(table.vacuum(keep=1)) < set(versions[:3])
    assert len(table.vacuum(keep=0)) == 1
    assert {p.name for p in (tmp_path / "table").glob("version-*")} == {versions[-1]}
    assert table.row_count() == 3
    with pytest.raises(ValueError):
        table.vacuum(-1)


# --- buckets ------------------------------------------------------------------------
def _exchanges_over_the_table(df, table):
    """Exchanges of the executed plan that have a scan of the table below them."""
    df.collect()
    lines = df._jdf.queryExecution().executedPlan().toString().split("\n")
    open_at, found = [], 0
    for line in lines:
        depth = len(line) - len(line.lstrip(" :+-*()0123456789"))
        while open_at and open_at[-1] >= depth:
            open_at.pop()
        if line.strip(" :+-*()0123456789").startswith("Exchange"):
            open_at.append(depth)
        if "FileScan" in line and table.split(".")[-1] in line:
            found += bool(open_at)
        if "== Initial Plan" in line:
            break
    return found


@pytest.fixture
def large(make):
    def build(n, first=0):
        rows = make(n=3).where("incident_id = 'INC-001'").drop("incident_id")
        ids = rows.sparkSession.range(first, first + n).select(F.format_string("ID-%09d", "id").alias("incident_id"))
        return ids.crossJoin(F.broadcast(rows))

    return build


def test_ids_are_checked_without_a_shuffle_of_the_table(spark, large, table, monkeypatch):
    from breachlens.operators import checks
    from breachlens.sources import incident_table

    table.replace(large(3000))
    assert table.bucket_count() == incident_table.LEAST_BUCKETS
    rows = spark.table(table.name)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        own = large(2000, 2990).select("incident_id").repartition(table.bucket_count(), "incident_id")
        own = own.groupBy("incident_id").agg(F.count(F.lit(1)).alias("rows"))
        joined = table._in_both(own, rows.select("incident_id"))
        assert joined.count() == 10 and _exchanges_over_the_table(joined, table.name) == 0
        per_key = rows.groupBy("incident_id").agg(F.count(F.lit(1)).alias("rows"))
        assert _exchanges_over_the_table(per_key, table.name) == 0
        monkeypatch.setattr(incident_table, "POINT_ROWS", 5)
        with pytest.raises(ValueError, match="unique"):
            table.insert(large(2000, 2990))
        assert table.insert(large(2000, 3000)) == 2000
        assert checks.duplicate_count(spark.table(table.name), 5000) == 0
        table.verify()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _rows_read(df):
    """Rows that the scans of a collected query gave."""
    df.collect()
    todo, read = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
            continue
        if name.endswith("QueryStageExec"):
            todo.append(node.plan())
        if name == "FileSourceScanExec":
            read += node.metrics().apply("numOutputRows").value()
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return read


def test_a_look_up_by_id_reads_one_bucket(spark, large, table):
    table.replace(large(40_000))
    found = table.fetch(f"SELECT * FROM {table.name} WHERE incident_id = ?", ["ID-000012345"])
    assert [r["incident_id"] for r in found.collect()] == ["ID-000012345"]
    assert 0 < _rows_read(found) < 40_000 / 4
    few = spark.table(table.name).select("incident_id").where(F.col("incident_id").isin(["ID-000000001", "nowhere"]))
    assert _rows_read(few) < 40_000 / 3


def test_versions_keep_their_buckets(spark, make, table):
    table.buckets = 3
    version = table.replace(make())["version"]
    assert table.bucket_count() == 3 and version.endswith("-b3")
    again = IncidentTable(spark, table.root, f"{table.name}_again")
    again.attach(version)
    assert again.bucket_count() == 3 and again.row_count() == 3
    again.insert(make(n=5).where("incident_id > 'INC-003'"))
    assert spark.table(again.name).where("incident_id = 'INC-003'").count() == 1
    other = IncidentTable(spark, table.root, f"{table.name}_other", buckets=5)
    other.replace(make())
    other.attach(version)
    assert other.bucket_count() == 3 and other.row_count() == 4
    spark.sql(f"DROP TABLE {again.name}")
    spark.sql(f"DROP TABLE {other.name}")


def test_all_forms_of_insert_obey_the_table(spark, make, table):
    """Spark's parser classifies them; what may hide an insert is refused."""
    table.replace(make())
    t = table.name
    same = f"SELECT * FROM {t}"
    for statement in (f"/* by hand */ INSERT INTO {t} {same}", f"INSERT INTO {t} BY NAME {same}", f"INSERT INTO {t} ({same})",
                      f"-- note\nINSERT INTO TABLE spark_catalog.default.{t} TABLE {t}", f"INSERT INTO {t} {same} UNION ALL {same};",
                      f"INSERT INTO {t} WITH x AS ({same}) SELECT * FROM x", f"INSERT INTO {t.upper()} {same}"):
        with pytest.raises(ValueError, match="present and unique"):
            table.execute(statement)
    for statement in (f"WITH x AS ({same}) INSERT INTO {t} SELECT * FROM x", f"FROM {t} INSERT INTO {t} SELECT * INSERT INTO {t} SELECT *",
                      f"BEGIN INSERT INTO {t} {same}; END", f"EXECUTE IMMEDIATE 'INSERT INTO {t} {same}'",
                      f"INSERT INTO IDENTIFIER('{t}') {same}", f"INSERT INTO {t} REPLACE WHERE true {same}"):
        with pytest.raises(ValueError, match="not run"):
            table.execute(statement)
    with pytest.raises(ValueError, match="without PARTITION"):
        table.execute(f"INSERT INTO {t} PARTITION (sector = 'x') {same}")
    assert table.row_count() == 3
    table.execute(f"INSERT INTO {t} BY NAME SELECT severity_score, concat(incident_id, :tail) AS incident_id FROM {t}", {"tail": "-b"})
    table.execute(f"INSERT INTO {t} (severity_score, incident_id) (SELECT 2D, 'new')")
    assert table.row_count() == 7 and spark.table(t).where("incident_id = 'INC-001-b'").first()["severity_score"] == 8
    spark.sql(f"CREATE TABLE {t}_b (incident_id STRING) USING parquet")
    table.execute(f"INSERT INTO {t}_b SELECT incident_id FROM {t}")
    table.execute(f"INSERT INTO {t}_b SELECT incident_id FROM {t}")
    assert spark.table(f"{t}_b").count() == 14 and table.row_count() == 7
    spark.sql(f"DROP TABLE {t}_b")


def test_checks_count_while_the_rows_are_written(spark, make, tmp_path):
    """Also through a shuffle, whose tasks may run again."""
    from breachlens.operators.checks import count_if, measure_written

    rows = make(n=5).repartition(3, "incident_id")
    checks = {"low": count_if(F.col("severity_score") < 5), "last": F.max("incident_id")}
    found = measure_written(rows, checks, lambda df: df.write.parquet(str(tmp_path / "w")))
    written = spark.read.parquet(str(tmp_path / "w"))
    assert found["rows"] == written.count() and found["last"] == written.agg(F.max("incident_id")).first()[0]
    assert found["low"] == written.where("severity_score < 5").count()
    none = measure_written(rows.where("false"), checks, lambda df: df.write.parquet(str(tmp_path / "e")))
    assert none == {"rows": 0, "low": 0, "last": None}
