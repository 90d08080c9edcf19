from pathlib import Path

import pytest

from breachlens.llm.common import ship_package

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def docs(spark):
    """Documents made from (doc_id, text) pairs; also ships the package to the workers."""
    ship_package(spark)

    def build(*pairs, parts=2):
        rows = [(i, t, None, "s", None if t is None else len(t)) for i, t in pairs]
        return spark.createDataFrame(rows, DOCUMENTS).repartition(parts)

    return build


@pytest.fixture
def folder_of(tmp_path):
    """A folder with the given DataFrames as tables."""

    def build(**tables):
        for name, df in tables.items():
            df.write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return build


@pytest.fixture
def against_sql():
    """Compares a query with its SQL in DuckDB over the same folder."""

    def compare(spark, name, folder):
        import duckdb

        from breachlens.llm.queries import oracle_sql, queries

        found = queries()[name](spark, folder)
        con = duckdb.connect()
        for table in sorted(p.name.removesuffix(".parquet") for p in Path(folder).glob("*.parquet")):
            con.sql(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet/*.parquet')")
        wanted = con.sql(oracle_sql()[name])
        names = sorted(found.columns)
        assert names == sorted(wanted.columns)
        order = lambda rows: sorted(map(repr, rows))
        assert order(map(tuple, found.select(*names).collect())) == order(wanted.select(*names).fetchall())

    return compare
