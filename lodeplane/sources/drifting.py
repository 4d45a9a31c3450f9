"""Delimited files whose header isn't where it was: each file has its own first row, first column and column names.

Files are read as lines. The first rows of a file are searched for a cell that is one of the anchor labels; where it stands gives the header's row and how
many columns the file is shifted by. The headers, one a file, are then sent to all rows of their file: a plan for each file, worked out and
carried out by tasks; no file is opened on the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodeplane.functions.text import composed
from lodeplane.session import stored

#: Rows and columns of a file in which its header can begin.
FIRST_ROWS, FIRST_COLUMNS = 20, 3


def label(c: Column) -> Column:
    """A label as it is compared: composed, blanks of any kind as one, trimmed; null if nothing is left."""
    return F.nullif(F.trim(F.regexp_replace(composed(c), r"[\s\u00a0]+", " ")), F.lit(""))


def lines_of(spark: SparkSession, path: str, separator: str = ";") -> DataFrame:
    """Rows (file, row, cells): the lines of delimited files, numbered from 0 in each file, with their cells.

    A file is one row of text and is cut into its lines in a task, so that lines keep their order: for files of a table a person made. Quoted cells may hold
    the separator, but no line end.
    """
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    lines = files.select("file", F.posexplode(F.split("value", r"\r\n|\n|\r")).alias("row", "line"))
    quoted = '("(?:[^"]|"")*"|[^' + separator + "]*)(?:" + separator + "|$)"
    cells = F.transform(F.regexp_extract_all("line", F.lit(quoted), 1), lambda c: F.when(c.startswith('"'), F.replace(F.substring(c, F.lit(2), F.length(c) - 2), F.lit('""'), F.lit('"'))).otherwise(c))
    # at its end the pattern also matches the empty text behind the last cell
    return lines.select("file", "row", F.when(F.col("line").endswith(separator) | (F.col("line") == ""), cells).otherwise(F.slice(cells, F.lit(1), F.greatest(F.size(cells) - 1, F.lit(1)))).alias("cells"))


def headers(lines: DataFrame, anchors: Sequence[str]) -> DataFrame:
    """Rows (file, at, shift, labels) for every file: its header's row, first column and labels from there on; nulls for a file without an anchor."""
    near = lines.filter(F.col("row") < FIRST_ROWS).select("file", "row", F.posexplode(F.slice("cells", F.lit(1), F.lit(FIRST_COLUMNS))).alias("shift", "cell"), "cells")
    found = near.filter(label(F.col("cell")).isin(*anchors)).groupBy("file").agg(F.min(F.struct("row", "shift", "cells")).alias("h"))
    files = lines.select("file").distinct()
    one = files.join(found, "file", "left").select("file", F.col("h.row").alias("at"), F.col("h.shift").alias("shift"), F.posexplode_outer("h.cells").alias("i", "cell"))
    named = one.select("file", "at", "shift", "i", label(F.col("cell")).alias("label"))
    own = F.struct((F.col("i") - F.col("shift")).alias("i"), "label")
    return named.groupBy("file", "at", "shift").agg(F.array_sort(F.collect_list(F.when(F.col("i") >= F.col("shift"), own))).alias("labels"))


def read_drifting(spark: SparkSession, path: str, anchors: Sequence[str], columns: Mapping[str, T.DataType], names: Mapping[str, str], code: str, separator: str = ";") -> tuple[DataFrame, DataFrame]:
    """The files' rows as one table, and a report with a row a file.

    columns: the table's columns with their types, the first of them the one that anchors head; names: from each label that is known to its column; code: a pattern
    that the first column's values match whole, by which notes, repeated headers and blank lines go. Numbers may have decimal commas; what can't be cast is null. A
    column that a file lacks is null in its rows. Of several labels for one column the first counts.

    Report: file, status (`read`, or `no anchor`: the file gives no rows), shift, n_rows, and the labels that aren't known.
    """
    known = F.create_map(*[F.lit(x) for k, v in names.items() for x in (k, v)])
    lines = stored(lines_of(spark, path, separator), "lines")
    plans = headers(lines, anchors)
    place = F.transform(F.filter("labels", lambda x: x.label.isNotNull()), lambda x: F.struct(known[x.label].alias("column"), x.i.alias("i"), x.label.alias("label")))
    plans = stored(plans.select("file", "at", "shift", place.alias("places")), "plans")
    body = lines.join(F.broadcast(plans) if plans.limit(10_001).count() <= 10_000 else plans, "file").filter(F.col("row") > F.col("at"))
    first, *others = columns
    at = lambda i: F.nullif(F.trim(F.get("cells", F.col("shift") + i)), F.lit(""))
    rows = body.withColumn("_code", at(F.lit(0))).filter(F.col("_code").rlike(f"^(?:{code})$"))

    def value(name: str) -> Column:
        i = F.get(F.filter("places", lambda x: x.column == name), F.lit(0)).i
        text = at(i)
        kind = columns[name]
        if isinstance(kind, T.StringType):
            return text
        number = F.replace(text, F.lit(","), F.lit(".")).try_cast("double")
        return F.when(~F.isnan(number), number.cast(kind)) if isinstance(kind, T.NumericType) else text.try_cast(kind)

    read = rows.select(F.regexp_extract("file", "([^/]*)$", 1).alias("file"), F.col("_code").cast(columns[first]).alias(first), *[value(c).alias(c) for c in others])
    counts = read.groupBy("file").agg(F.count("*").alias("n_rows"))
    unknown = F.array_sort(F.transform(F.filter("places", lambda x: x.column.isNull()), lambda x: x.label))
    report = plans.select(F.regexp_extract("file", "([^/]*)$", 1).alias("file"), F.when(F.col("at").isNull(), "no anchor").otherwise("read").alias("status"), "shift", F.coalesce(unknown, F.array().cast("array<string>")).alias("unknown"))
    return read, report.join(counts, "file", "left").withColumn("n_rows", F.coalesce("n_rows", F.lit(0)))
