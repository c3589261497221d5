"""Readers and writers of post batches, wordbags and query lists."""

from __future__ import annotations

from typing import Iterable
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from surgewatch.functions.text import PY_SPACE_CLASS
from surgewatch.functions.timefmt import iso_to_timestamp
from surgewatch.schema import POST_COLUMNS, WORDBAG

CSV_OPTIONS = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"'}
# The CSV writer trims values by default; post text keeps its spaces.
CSV_WRITE_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "emptyValue": "",
                     "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}

# Multi-line CSV files aren't split when read: bound what one of them holds.
MAX_ROWS_PER_FILE = 100_000

# Batch folders are named raw-data/{yyyyMMdd'T'HHmmss'Z'}/
# (a Hive-style ``<name>=`` prefix on the folder is accepted too)
BATCH_FOLDER_RE = r"/(?:[^/=]+=)?(\d{8}T\d{6}Z)/"
BATCH_FOLDER_FORMAT = "yyyyMMdd'T'HHmmssX"


# Older collectors' names of the post columns (fixed values).
HEADER_NAMES = {"keyword": "query"}


def list_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``file``: the data files under ``path`` (names only; contents aren't read)."""
    return spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"))


def csv_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``file, start, pos, value``: the lines of text files, read by byte ranges (``start``: where the
    range begins) in any number of tasks; ``pos`` orders the lines of a range."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("pos"), "value")


def csv_headers(lines: DataFrame) -> DataFrame:
    """``file, names, crlf``: the column names in the first line of each file that has one, and its line end."""
    line = F.regexp_replace(F.min_by("value", "pos"), '^\ufeff|"|\r$', "")
    names = F.transform(F.split(line, ","), lambda c: F.regexp_replace(c, r"^\s+|\s+$", ""))
    return lines.where("start = 0").groupBy("file").agg(names.alias("names"), F.min_by("value", "pos").endswith("\r").alias("crlf"))


def _range_records(pieces: bool):
    """Records of byte ranges whose lines come in order: those whole in their range, or the ``pieces`` of
    the others, a range's first lines (``n`` 0) and its last record's."""
    def run(batches):
        at, kept = None, []  # the range at hand, the lines of its record at hand
        n, inside = 0, False

        def flush(last: bool):
            if kept and pieces == (n == 0 or (last and inside)):
                out.append((*at, n, "\n".join(kept)))
            kept.clear()
        for frame in batches:
            out = []
            for file, start, value, within in zip(frame["file"], frame["start"], frame["value"], frame["inside"]):
                if (file, start) != at:
                    flush(True)
                    at, n, inside = (file, start), 0, bool(within)
                if not inside:
                    flush(False)
                    n += 1
                kept.append(value)
                inside ^= bool(value.count('"') % 2)
            yield pd.DataFrame(out, columns=["file", "start", "n", "record"])
        out = []
        flush(True)
        yield pd.DataFrame(out, columns=["file", "start", "n", "record"])
    return run


def csv_records(lines: DataFrame) -> DataFrame:
    """``file, start, n, record``: the records of multi-line CSV files from their ``csv_lines``.

    A line begins a record if the quotes before it in its file are even.  Quotes are summed
    by byte range and then, one row per range, over a file's ranges, so a range may begin
    anywhere, also inside a quoted text; its first lines then go to the record that an
    earlier range began.  A range's lines are put together where they are read: only the
    pieces of records that lie in two ranges or more are shuffled, so ``lines`` must come as
    ``csv_lines`` gives them.  Blank lines between records are dropped.
    """
    odd = (F.length("value") - F.length(F.translate("value", '"', ""))) % 2
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)  # a file's ranges
    ranges = lines.groupBy("file", "start").agg((F.sum(odd) % 2).alias("odd"))
    ranges = ranges.select("file", "start", (F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2 == 1).alias("inside"))
    own = lines.join(F.broadcast(ranges), ["file", "start"]).select("file", "start", "value", "inside")
    schema = "file string, start long, n long, record string"
    whole = own.mapInPandas(_range_records(False), schema)
    pieces = own.mapInPandas(_range_records(True), schema)
    upto = Window.partitionBy("file").orderBy("start", "n").rowsBetween(Window.unboundedPreceding, 0)  # two rows a range at most
    pieces = pieces.withColumn("home", F.last(F.when(F.col("n") > 0, F.struct("start", "n")), ignorenulls=True).over(upto))
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("start", "n", "record"))), lambda x: x["record"]), "\n")
    joined = pieces.groupBy("file", "home").agg(text.alias("record")).select("file", "home.start", "home.n", "record")
    return whole.unionByName(joined).withColumn("record", F.regexp_replace("record", "\r$", "")).where("record <> ''")


def files_by_header(spark: SparkSession, path: str | list[str]) -> dict[tuple[str, ...], list[str]]:
    """The CSV files under ``path`` by their header's column names.

    Executors read the files' lines; the driver gets one short row per file, as it does
    when Spark lists them.
    """
    found: dict[tuple[str, ...], list[str]] = {}
    for r in sorted(csv_headers(csv_lines(spark, path)).collect(), key=lambda r: r["file"]):
        found.setdefault(tuple(r["names"]), []).append(unquote(r["file"]))
    return found


def post_time(c) -> F.Column:
    """ISO text or epoch seconds to a timestamp; bad to null."""
    s = F.trim(F.col(c) if isinstance(c, str) else c)
    epoch = F.timestamp_seconds(s.try_cast("double"))
    return F.when(s.rlike(r"^\d{9,11}(\.\d+)?$"), epoch).otherwise(iso_to_timestamp(s))


def _by_header(spark: SparkSession, path: str | list[str]) -> list[tuple[tuple[str, ...], DataFrame]]:
    """One frame per distinct header, all columns text; the UTF-8 BOM is consumed by the reader."""
    return [(names, spark.read.schema(", ".join(f"`{n}` string" for n in names))
             .options(**CSV_OPTIONS).csv(files)) for names, files in files_by_header(spark, path).items()]


def _split_by_header(spark: SparkSession, path: str | list[str]) -> list[tuple[tuple[str, ...], DataFrame]]:
    """As ``_by_header``, of files read by byte ranges; ``_file`` names each row's file."""
    lines = csv_lines(spark, path)
    headers = csv_headers(lines)
    rows = csv_records(lines).where("start > 0 or n > 1").join(F.broadcast(headers), "file")
    out = []
    for r in sorted(headers.select("names").distinct().collect()):  # the shapes of the files
        names = tuple(r["names"])
        schema = ", ".join(f"`{n}` string" for n in names)
        record = F.when(F.col("crlf"), F.replace(F.col("record"), F.lit("\r\n"), F.lit("\n"))).otherwise(F.col("record"))
        parsed = F.from_csv(record, schema, {**CSV_OPTIONS, "header": "false"}).alias("r")
        own = rows.where(F.col("names") == F.array(*map(F.lit, names))).select("file", parsed)
        out.append((names, own.select(*[F.col("r")[n].alias(n) for n in names], F.col("file").alias("_file"))))
    return out


def read_posts(spark: SparkSession, path: str | list[str], typed: bool = True,
               batch_time: str | None = None, split: bool = False) -> DataFrame:
    """A post batch: folder(s) of CSV files with header and quoted multi-line text.

    Columns go by header name, so files of older shapes (``keyword`` first, no
    ``query``) mix with current ones: one read per distinct header, missing columns
    null.  With ``typed`` the two time columns become UTC timestamps (epoch seconds
    or ISO text; unparseable -> null).  ``batch_time`` names an extra column with the
    time of each row's batch folder.  Spark's multiLine reader takes one task per file;
    with ``split`` files are read by byte ranges instead (``csv_records``), with the same
    rows, for files larger than a task should read; the lines of one file end alike, all in
    CR LF (LF inside texts, as Spark's reader has it) or all in LF.
    """
    frames = []
    for names, df in _split_by_header(spark, path) if split else _by_header(spark, path):
        have = {HEADER_NAMES.get(n, n): n for n in names if HEADER_NAMES.get(n) not in names}
        cols = [F.col(f"`{have[c]}`").alias(c) if c in have else F.lit(None).cast("string").alias(c)
                for c in POST_COLUMNS]
        if batch_time:
            df = df.withColumn(batch_time, batch_time_of("_file")) if split else with_batch_time(df, batch_time)
            cols.append(F.col(batch_time))
        frames.append(df.select(*cols))
    if not frames:
        extra = f", {batch_time} timestamp" if batch_time else ""
        frames = [spark.createDataFrame([], ", ".join(f"{c} string" for c in POST_COLUMNS) + extra)]
    df = frames[0]
    for f in frames[1:]:
        df = df.unionByName(f)
    if typed:
        df = df.withColumns({"uploaded_time": post_time("uploaded_time"),
                             "collected_time": post_time("collected_time")})
    return df


def batch_time_of(file: str) -> F.Column:
    """Batch timestamp parsed from the ``.../{yyyyMMddTHHmmssZ}/`` folder of a file's path."""
    return F.try_to_timestamp(F.regexp_extract(F.col(file), BATCH_FOLDER_RE, 1), F.lit(BATCH_FOLDER_FORMAT))


def with_batch_time(df: DataFrame, out: str = "batch_time") -> DataFrame:
    """Batch timestamp of each row's file."""
    return df.withColumn(out, batch_time_of("_metadata.file_path"))


def batch_folder(batch_col: str = "collected_time") -> F.Column:
    """The batch folder's name of a row: ``yyyyMMddTHHmmssZ``, empty without a time."""
    return F.coalesce(F.date_format(F.col(batch_col).cast("timestamp"), "yyyyMMdd'T'HHmmss'Z'"), F.lit(""))


def write_batches(df: DataFrame, root: str, batch_col: str = "collected_time",
                  mode: str = "overwrite", compression: str | None = None) -> None:
    """Land posts as CSV batch folders ``root/batch=<yyyyMMddTHHmmssZ>/`` in one write (no time: Hive's default folder).

    Tasks whose rows come in the order of ``batch_folder`` write them as they come; others sort theirs."""
    cols = [F.col(c).cast("string") for c in POST_COLUMNS]
    write_csv(df.select(*cols, batch_folder(batch_col).alias("batch")), root, mode, compression, 0, by="batch")


def read_wordbag(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(WORDBAG).option("header", "true").csv(path)


def read_query_list(spark: SparkSession, path: str) -> DataFrame:
    """Search queries, one per line: BOM-safe, stripped, blank and ``#`` lines skipped,
    repeats dropped keeping first-seen order (``pos``; a folder is read file by file)."""
    lines = spark.read.text(path, wholetext=True).select(
        "value", F.col("_metadata.file_path").alias("file"))
    ex = lines.select("file", F.posexplode(F.split(F.regexp_replace("value", "^\ufeff", ""),
                                                   r"\r\n|\n|\r")).alias("pos", "raw"))
    q = ex.select("file", "pos",
                  F.regexp_replace("raw", rf"^{PY_SPACE_CLASS}+|{PY_SPACE_CLASS}+$", "").alias("query"))
    q = q.where((F.col("query") != "") & ~F.col("query").startswith("#"))
    first = q.groupBy("query").agg(F.min(F.struct("file", "pos")).alias("_first"))
    return first.select("query", F.col("_first.file").alias("file"),
                        F.col("_first.pos").alias("pos")).orderBy("file", "pos").drop("file")


def query_list_frame(spark: SparkSession, queries: Iterable[str]) -> DataFrame:
    rows = [(i, q) for i, q in enumerate(queries)]
    return spark.createDataFrame(rows, "pos int, query string").select("query", "pos")


def merge_posts(spark: SparkSession, paths: list[str], out: str | None = None) -> DataFrame:
    """Union of post batches by column name, as text; files are grouped by header, so the
    plan grows with the shapes, not with the folders.  Missing columns are null."""
    frames = [df for _, df in _by_header(spark, paths)]
    merged = frames[0]
    for f in frames[1:]:
        merged = merged.unionByName(f, allowMissingColumns=True)
    if out:
        merged.write.mode("overwrite").options(**CSV_WRITE_OPTIONS).csv(out)
    return merged


def write_posts(df: DataFrame, path: str, mode: str = "overwrite", compression: str | None = None,
                max_rows: int | None = None, by: str | None = None) -> None:
    """Write a post batch as CSV with the fixed header (also when empty).

    ``compression``: as Spark's CSV writer has it (``gzip``); readers go by the files' names.
    A multi-line file is read by one task anyway; leave files to be read by byte ranges plain.
    ``max_rows``: rows of a file (default ``MAX_ROWS_PER_FILE``; 0: a file for each of ``df``'s partitions).
    ``by``: a further column, a folder for each of its values.
    """
    cols = [F.col(c).cast("string") for c in POST_COLUMNS]
    write_csv(df.select(*cols, *([by] if by else [])), path, mode, compression, max_rows, by)


def land_files(spark: SparkSession, made: str, folder: str) -> int:
    """Move the data files of folder ``made``, written whole, into ``folder``, under names that tell where they
    are from; their number (no such folder: 0)."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(path(folder))
    own = [f.getPath() for f in fs.listStatus(path(made)) if not f.getPath().getName().startswith(("_", "."))] if fs.exists(path(made)) else []
    for f in own:
        if not fs.rename(f, path(folder, f"{f.getParent().getName().replace('=', '-')}-{f.getName()}")):
            raise OSError(f"{f} was not moved to {folder}")
    return len(own)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", compression: str | None = None,
              max_rows: int | None = None, by: str | None = None) -> None:
    """Text columns as CSV files of at most ``max_rows`` rows, in a folder for each value of ``by``."""
    (df.write.partitionBy(*([by] if by else [])).mode(mode).option("maxRecordsPerFile", MAX_ROWS_PER_FILE if max_rows is None else max_rows)
     .options(**CSV_WRITE_OPTIONS, **({"compression": compression} if compression else {})).csv(path))


def write_partitioned_by_query(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Layout ``keyword=<safe query>/``: ``/`` -> ``_``, space -> ``-``."""
    (df.withColumn("keyword", F.translate(F.col("query"), "/ ", "_-"))
     .write.mode(mode).partitionBy("keyword").parquet(path))
