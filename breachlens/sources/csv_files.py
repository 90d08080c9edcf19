"""CSV source and sink."""

from __future__ import annotations

import csv
from collections.abc import Callable
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from breachlens.functions.text import missing_cell_to_null
from breachlens.operators import sizing
from breachlens.operators.checks import any_of, measure_written
from breachlens.operators.sizing import compiled
from breachlens.sources.csv_splits import cells_of, split_records
from breachlens.sources.layers import PACKED, quoted

#: How every CSV is parsed.
_OPTIONS = {"encoding": "UTF-8", "sep": ",", "quote": '"', "escape": '"', "maxCharsPerColumn": "-1"}

SOURCE_ORDER = ["_source_file", "_source_block", "_source_row"]
_BROKEN = "_broken_record"
# a doubled quote is two quoted runs side by side, so the pattern needs no group and no backtracking
_QUOTED = r'"[^"]*+"'


def read_header(spark: SparkSession, path: str) -> list[str]:
    """Column names as they stand in the first line, blanks and repeats included.

    Spark's own header handling renames blank and repeated names, which would hide them from
    the schema checks. Blank lines before it are skipped (in files read whole, empty ones only).
    """
    try:
        first = spark.read.text(path).where("value RLIKE '[^\\\\s\\ufeff]'").first()
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error.getCondition()):
            raise FileNotFoundError(f"Dataset not found:\n{path}") from error
        raise
    if first is None:
        raise RuntimeError("Unable to load dataset: no columns to read from the file")
    return next(csv.reader([first.value.lstrip("\ufeff")]), [])


def text_faults(spark: SparkSession, path: str) -> tuple[int, bool]:
    """(lines that are not UTF-8, whether a quoted cell may run over a line's end), in one scan.

    A cell with a line break leaves its first line with an odd number of quotes.
    """
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    valid = F.is_valid_utf8("value")
    found = spark.read.text(path).agg(
        F.count_if(~valid).alias("bad"), F.max(F.when(valid, quotes % 2 == 1).otherwise(False)).alias("odd")
    ).first()
    return found["bad"], bool(found["odd"])


def land_cells(spark: SparkSession, path: str, folder: str, multi_line: bool | None = None) -> tuple[DataFrame, int]:
    """All cells as text in a Parquet layer, with the ``SOURCE_ORDER`` columns, and the number of rows.

    This is the one way CSV enters: text that is not UTF-8 and rows with more fields than the header
    raise. With ``multi_line=None`` files are split in any case: by lines, or by records if a quoted cell may
    hold a line break (see ``csv_splits``). True reads each file whole in one task, False by lines.
    """
    landed, found = _land(spark, path, folder, multi_line, {})
    return landed, found["rows"]


def land_values(
    spark: SparkSession, path: str, folder: str, reads: dict[str, Column], multi_line: bool | None = None,
    measures: Callable[[DataFrame], dict[str, Column]] = lambda df: {},
) -> tuple[DataFrame | None, dict[str, Any]]:
    """``land_cells`` with each column in ``reads`` as its expression reads it, so that the text is neither kept nor
    read again; with the ``measures`` of the layer and its ``rows``, taken while it is written.

    No layer (None) if a cell that is there gives NULL: ``land_cells`` has the text that tells which.
    """
    landed, found = _land(spark, path, folder, multi_line, reads, measures)
    return (None if found["_unread"] else landed), found


def _land(
    spark: SparkSession, path: str, folder: str, multi_line: bool | None, reads: dict[str, Column],
    measures: Callable[[DataFrame], dict[str, Column]] = lambda df: {},
) -> tuple[DataFrame, dict[str, Any]]:
    bad, odd = text_faults(spark, path)
    if bad:
        raise RuntimeError(f"Unable to load dataset: {bad} line(s) are not valid UTF-8")
    try:
        by_record = multi_line is None and odd
        cells = read_split_csv(spark, path, f"{folder}-parts") if by_record else read_incident_csv(spark, path, bool(multi_line))
        # two steps, so that each value is read once
        values = cells.select(
            *[reads.get(c, F.col(quoted(c))).alias(c) for c in cells.columns],
            *[F.col(quoted(c)).isNotNull().alias(f"_given_{i}") for i, c in enumerate(reads)],
        )
        unread = any_of(F.col(f"_given_{i}") & F.col(quoted(c)).isNull() for i, c in enumerate(reads))
        marked = values.select(*[quoted(c) for c in cells.columns], unread.alias("_unread"))
        layer = marked.drop("_too_long", "_unread")
        checks = {"_long": F.count_if("_too_long"), "_unread": F.count_if("_unread"), **measures(layer)}
        with compiled(spark):
            found = measure_written(
                marked, checks, lambda df: df.drop("_too_long", "_unread").write.option("compression", PACKED).parquet(folder)
            )
    except (PySparkException, Py4JJavaError) as error:
        raise RuntimeError(f"Unable to load dataset: {error}") from error
    if found["_long"]:
        raise RuntimeError(f"Unable to load dataset: {found['_long']} row(s) have more fields than the header")
    return spark.read.schema(layer.schema).parquet(folder), found


def read_incident_csv(spark: SparkSession, path: str, multi_line: bool) -> DataFrame:
    """All cells as text, missing-value spellings as NULL, plus the position in the files.

    The three ``SOURCE_ORDER`` columns keep the file order, which a later shuffle would lose.
    Rows shorter than the header are filled with NULL; ``_too_long`` marks the longer ones. A
    folder may hold many files, all with the same header; another header in one of them fails.
    ``multi_line`` reads line breaks inside quotes and makes each file one task: turn it off for
    few huge files known to have none.
    """
    names = read_header(spark, path)
    schema = T.StructType([T.StructField(name, T.StringType()) for name in [*names, _BROKEN]])
    cells = (
        spark.read.schema(schema)
        .options(
            header=True, multiLine=multi_line, mode="PERMISSIVE", columnNameOfCorruptRecord=_BROKEN,
            columnPruning=False, enforceSchema=False, **_OPTIONS,
        )
        .csv(path)
    )
    return _positioned(
        cells.select(
            *[F.col(f"`{name}`").alias(name) for name in names], _BROKEN, F.col("_metadata.file_path").alias("_source_file"),
            F.col("_metadata.file_block_start").alias("_source_block"), F.monotonically_increasing_id().alias("_source_row"),
        ),
        names,
    )


def read_split_csv(spark: SparkSession, path: str, folder: str) -> DataFrame:
    """The same as ``read_incident_csv`` with ``multi_line``, by any number of tasks per file."""
    names = read_header(spark, path)
    records = split_records(spark, path, names, folder)
    cells = cells_of(F.col("record"), len(names), _OPTIONS)
    cells = records.select(cells.alias("c"), "file", "block", "row").select(
        *[F.col(f"c.c{i}").alias(name) for i, name in enumerate(names)], F.col("c.broken").alias(_BROKEN),
        F.col("file").alias("_source_file"), F.col("block").alias("_source_block"), F.col("row").alias("_source_row"),
    )
    return _positioned(cells, names)


def _positioned(cells: DataFrame, names: list[str]) -> DataFrame:
    """Cells with missing-value spellings as NULL, without blank lines, too long rows marked."""
    blank_line = F.coalesce(F.trim(_BROKEN) == "", F.lit(False))
    commas = F.size(F.split(F.regexp_replace(_BROKEN, _QUOTED, ""), ",", -1))
    return cells.where(~blank_line).select(
        *[missing_cell_to_null(F.col(f"`{name}`")).alias(name) for name in names], *SOURCE_ORDER,
        F.coalesce(commas > len(names), F.lit(False)).alias("_too_long"),
    )


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", packed: bool = False) -> None:
    """CSV with a header line in every part file. Cells keep their spaces; NULL is an empty cell.

    ``packed`` writes gzip files, quickly rather than as small as can be. Readers take them for CSV by their names; none
    is read by several tasks, so each has a bounded number of rows.
    """
    writer = df.write.mode(mode).options(
        header=True,
        encoding="UTF-8",
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )
    if packed:
        writer = writer.options(
            compression="gzip", maxRecordsPerFile=sizing.WIDE_ROWS_PER_PARTITION, **{"zlib.compress.level": "BEST_SPEED"}
        )
    writer.csv(path)
