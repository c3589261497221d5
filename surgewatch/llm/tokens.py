"""Token ids of texts, and token counts of documents in flat token files.

A flat token file is a run of little-endian ids with an end-of-document id after
each document and no index.  Files of any length are read by byte ranges, as blocks of
any size; a document may begin, end or go on in any of them.  ``count_documents`` finds the separators of
a block with one vectorised comparison, and a prefix scan over the blocks'
summaries (tokens so far, separators so far, end of the last separator) turns
positions in a block into documents of a file.
"""

from __future__ import annotations

import base64
import functools
import re
from collections.abc import Iterator
from urllib.parse import quote

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from surgewatch.llm.common import cut

#: Texts of other characters, or with runs longer than this, go to the slower library.
_PLAIN = re.compile("[^\x00-ɏ]")
_LONG_RUN = re.compile(r"(?<!\S)\S{400}|(?<!\s)\s{400}")
_SPECIAL = "<|"


@functools.lru_cache(maxsize=4)
def _libraries(json_path: str, ranks_path: str | None, specials: bool):
    import os
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer
    slow = Tokenizer.from_file(json_path)
    slow.encode_special_tokens = not specials
    if ranks_path is None:
        return slow, None
    import tiktoken
    from public_tokenizers import PATTERN
    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return slow, tiktoken.Encoding("bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def encode(text: str, json_path: str, ranks_path: str | None = None, specials: bool = True) -> np.ndarray:
    """Ids of ``text`` by the tokenizer file, without added special tokens.

    ``ranks_path`` names the same vocabulary for a faster library, used where both
    agree: Latin texts without very long runs or special tokens.  ``specials``:
    the strings of special tokens in a text become their ids.
    """
    slow, fast = _libraries(json_path, ranks_path, specials)
    if fast is not None and not _PLAIN.search(text) and _SPECIAL not in text \
            and (len(text) < 4000 or not _LONG_RUN.search(text)):
        return fast.encode_to_numpy(text)
    return np.array(slow.encode(text, add_special_tokens=False).ids, np.uint32)


BLOCKS = "file long, block long, data binary"
_KINDS = {2: "<u2", 4: "<u4"}


def _stored(ids: np.ndarray, width: int) -> np.ndarray:
    """Ids as ``width`` bytes each; one that doesn't fit is an error."""
    if len(ids) and int(ids.max()) >= 1 << 8 * width:
        raise ValueError(f"id {int(ids.max())} does not fit in {width} bytes")
    return ids.astype(_KINDS[width])


def _located(path: str) -> tuple[fs.FileSystem, str]:
    """The file system and the path there of a path as Spark writes it."""
    scheme, colon, rest = path.partition(":")
    if scheme == "file" or not colon:
        return fs.LocalFileSystem(), "/" + (rest if colon else path).lstrip("/")
    return fs.FileSystem.from_uri(quote(path, safe=":/@"))


def flat_files(docs: DataFrame, json_path: str, ranks_path: str | None = None, eod: int = 50256,
               block_tokens: int = 1 << 19, text_col: str = "text") -> DataFrame:
    """Tokenized documents as blocks of flat files of two-byte ids: one file per partition.

    Rows ``(file, block, data)`` follow each other in a file; a null text gives a
    document of no tokens.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        file, block, held, size = TaskContext.get().partitionId(), 0, [], 0
        row = lambda x: pa.RecordBatch.from_arrays(
            [pa.array([file], pa.int64()), pa.array([block], pa.int64()), pa.array([x.tobytes()], pa.binary())],
            ["file", "block", "data"])
        for b in batches:
            for t in b.column(0).to_pylist():
                ids = encode(t or "", json_path, ranks_path, specials=False)
                held += [_stored(ids, 2), np.array([eod], "<u2")]
                size += len(ids) + 1
                if size >= block_tokens:
                    flat, whole = np.concatenate(held), size // block_tokens * block_tokens
                    for lo in range(0, whole, block_tokens):
                        yield row(flat[lo:lo + block_tokens])
                        block += 1
                    held, size = [flat[whole:]], size - whole
        if size:
            yield row(np.concatenate(held))
    return docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, BLOCKS)


def write_flat_files(docs: DataFrame, path: str, json_path: str, ranks_path: str | None = None, eod: int = 50256,
                     width: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokenized documents as flat files ``<path>/tokens/*.bin``, one per partition of ``docs``.

    ``path`` is a new folder that all executors share.  Returns, stored beside the files, ``(part, name,
    doc, id)``: which document is the ``doc``-th of file ``name``.  The files themselves hold ids only,
    ``width`` bytes each.  A file is named by the attempt that wrote it, so what a failed or doubled
    attempt leaves is no file of the result.  Null texts are documents of no tokens, null and repeated
    ids stay; an empty table writes no file.
    """
    folder = f"{path}/tokens"
    system, place = _located(folder)
    system.create_dir(place, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, out, doc, end = TaskContext.get().partitionId(), None, 0, np.array([eod], _KINDS[width]).tobytes()
        name = f"part-{part:06d}-{TaskContext.get().taskAttemptId()}.bin"
        try:
            for b in batches:
                if out is None:
                    system, place = _located(f"{folder}/{name}")
                    out = system.open_output_stream(place)
                for t in b.column(1).to_pylist():
                    out.write(_stored(encode(t or "", json_path, ranks_path, specials=False), width).tobytes() + end)
                n = b.num_rows
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * n, pa.int64()), pa.array([name] * n, pa.string()),
                     pa.array(range(doc, doc + n), pa.int64()), b.column(0)], ["part", "name", "doc", "id"])
                doc += n
        finally:
            if out is not None:
                out.close()
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    own.mapInArrow(run, f"part long, name string, doc long, id {own.schema['id'].dataType.simpleString()}") \
        .write.parquet(f"{path}/documents")
    return docs.sparkSession.read.parquet(f"{path}/documents")


def list_flat_files(spark: SparkSession, path: str) -> DataFrame:
    """``(file, path, name, length)`` of the files under ``path``; ``file`` is a hash of the path.  Contents aren't read."""
    return spark.read.format("binaryFile").load(path).select(
        F.xxhash64("path").alias("file"), "path", F.substring_index("path", "/", -1).alias("name"), "length")


def read_blocks(files: DataFrame, block_bytes: int = 1 << 20) -> DataFrame:
    """The ``files`` (as listed), of any length, as blocks: each task reads byte ranges, one at a time.

    ``block_bytes`` is a multiple of an id's bytes.  Files of no bytes have no blocks.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for file, path, block, length in zip(*(c.to_pylist() for c in b.columns)):
                system, place = _located(path)
                with system.open_input_file(place) as f:
                    data = f.read_at(min(block_bytes, length - block * block_bytes), block * block_bytes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([file], pa.int64()), pa.array([block], pa.int64()), pa.array([data], pa.binary())],
                    ["file", "block", "data"])
    last = F.expr(f"(length - 1) div {block_bytes}")
    ranges = files.filter("length > 0").select("file", "path", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("block"), "length")
    return ranges.repartition("file", "block").mapInArrow(run, BLOCKS)  # paths and numbers travel, not data


def read_flat_files(spark: SparkSession, path: str, block_bytes: int = 1 << 20) -> DataFrame:
    """Flat token files under ``path``, of any length, as blocks read by byte ranges; no files: an error, as in Spark's readers."""
    return read_blocks(list_flat_files(spark, path), block_bytes)


def _ends(eod: int, width: int):
    kind = _KINDS[width]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = [np.frombuffer(d or b"", kind, len(d or b"") // width) for d in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([len(x) for x in ids], pa.int64()),
                 pa.array([np.flatnonzero(x == eod) for x in ids], pa.list_(pa.int64()))],
                ["file", "block", "n", "ends"])
    return run


def _scan(blocks: DataFrame, span: int) -> DataFrame:
    """Before each block of its file: tokens, separators, and the end of the last separator.

    Two levels: within spans of blocks, then over the spans, so that no task holds
    more than ``span`` blocks of a file and one row for each of its spans.
    """
    before = lambda *by: Window.partitionBy(*by).orderBy("at").rowsBetween(
        Window.unboundedPreceding, -1)
    own = blocks.select("file", "block", "n", F.size("ends").cast("long").alias("e"),
                        F.try_element_at("ends", F.lit(-1)).alias("last"),
                        F.floor(F.col("block") / span).alias("span")) if "ends" in blocks.columns else blocks
    inside = own.withColumn("at", F.col("block"))
    w = before("file", "span")
    inside = (inside.withColumn("n0", F.coalesce(F.sum("n").over(w), F.lit(0)))
              .withColumn("e0", F.coalesce(F.sum("e").over(w), F.lit(0)))
              .withColumn("end", F.col("n0") + F.col("last") + 1)
              .withColumn("end0", F.max("end").over(w)))
    spans = (inside.groupBy("file", "span").agg(F.sum("n").alias("sn"), F.sum("e").alias("se"),
                                                F.max("end").alias("send")).withColumn("at", F.col("span")))
    w = before("file")
    spans = (spans.withColumn("sn0", F.coalesce(F.sum("sn").over(w), F.lit(0)))
             .withColumn("se0", F.coalesce(F.sum("se").over(w), F.lit(0)))
             .withColumn("send", F.col("sn0") + F.col("send"))
             .withColumn("send0", F.coalesce(F.max("send").over(w), F.lit(0))))
    return inside.join(spans.select("file", "span", "sn0", "se0", "send0"), ["file", "span"]).select(
        "file", "block", (F.col("sn0") + F.col("n0")).alias("tokens"),
        (F.col("se0") + F.col("e0")).alias("docs"),
        F.greatest(F.col("send0"), F.coalesce(F.col("sn0") + F.col("end0"), F.lit(0))).alias("open"))


def count_documents(blocks: DataFrame, eod: int = 50256, width: int = 2, span: int = 4096) -> DataFrame:
    """``blocks(file, block, data)`` of flat files -> one row per document.

    ``file``, ``doc`` (number in the file, from 0), ``start`` (its first token's
    position in the file), ``n_tokens`` (without the separator), ``closed`` (false
    for tokens after a file's last separator).  Blocks may come in any order and
    have any size of whole ids; null or empty data has no tokens, and a part of an id at its end is none; equal documents and repeated
    separators (documents of no tokens) each keep their row.  Rows of one file
    must have distinct block numbers, whose order is the order of the data.
    Empty table: no rows.
    """
    seen = cut(blocks.select("file", "block", "data").mapInArrow(
        _ends(eod, width), "file long, block long, n long, ends array<long>"))
    at = seen.join(_scan(seen, span), ["file", "block"])
    closed = (at.select("file", "tokens", "docs", "open", "ends", F.posexplode("ends").alias("i", "end"))
              .select("file", (F.col("docs") + F.col("i")).alias("doc"),
                      F.when(F.col("i") == 0, F.col("open"))
                      .otherwise(F.col("tokens") + F.expr("try_element_at(ends, i)") + 1).alias("start"),
                      (F.col("tokens") + F.col("end")).alias("stop"))
              .select("file", "doc", "start", (F.col("stop") - F.col("start")).alias("n_tokens"),
                      F.lit(True).alias("closed")))
    total = at.groupBy("file").agg(
        F.max(F.col("tokens") + F.col("n")).alias("n"), F.max(F.col("docs") + F.size("ends")).alias("doc"),
        F.max(F.greatest("open", F.coalesce(F.col("tokens") + F.try_element_at("ends", F.lit(-1)) + 1, F.lit(0)))).alias("start"))
    rest = total.filter("n > start").select("file", F.col("doc").cast("long"), "start",
                                            (F.col("n") - F.col("start")).alias("n_tokens"),
                                            F.lit(False).alias("closed"))
    return closed.union(rest)


def count_written(index: DataFrame, path: str, eod: int = 50256, width: int = 2, block_bytes: int = 1 << 20) -> DataFrame:
    """``(id, file, doc, start, n_tokens)`` of the documents that ``write_flat_files`` stored under ``path``,
    counted in the files that ``index`` names."""
    files = list_flat_files(index.sparkSession, f"{path}/tokens").join(index.select("part", "name").distinct(), "name")
    files = cut(files.select("file", "path", "part", "length"))
    counts = count_documents(read_blocks(files, block_bytes), eod, width)
    counts = counts.join(files.select("file", "part"), "file").drop("file")
    return index.join(counts, ["part", "doc"]).select("id", F.col("part").alias("file"), "doc", "start", "n_tokens")


def token_counts(docs: DataFrame, path: str, json_path: str, ranks_path: str | None = None, eod: int = 50256,
                 width: int = 2, block_bytes: int = 1 << 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents written as flat files under ``path``, read back and counted there.

    Per document its id (``id_col``), ``file`` (the number of its file), ``doc``, ``start`` and ``n_tokens``
    (as ``count_documents``).  Null texts have no tokens; null and repeated ids keep their rows.  Empty
    table: no rows.  Other columns are not read.
    """
    index = write_flat_files(docs, path, json_path, ranks_path, eod, width, id_col, text_col)
    return count_written(index, path, eod, width, block_bytes).withColumnRenamed("id", id_col)


__all__ = ["encode", "flat_files", "write_flat_files", "list_flat_files", "read_blocks", "read_flat_files", "count_documents",
           "count_written", "token_counts"]
