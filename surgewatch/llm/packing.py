"""Packing documents into sequences: first-fit decreasing with a tournament tree of bin capacities.

Documents are cut at the sequence length; the pieces are dealt at random into
groups of about ``group_pieces``, and each group is packed on its own.  Only
lengths and checksums are shuffled unless the ids are asked for.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from surgewatch.llm.common import cut, fresh
from surgewatch.llm.tokens import encode

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def pieces(docs: DataFrame, json_path: str, ranks_path: str | None = None, size: int = 1024, end_id: int = 0,
           keep_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document's ids, ``end_id`` last, cut into pieces of ``size`` ids and a rest.

    A null text counts as empty: one piece that holds ``end_id`` alone.
    """
    names = [x.split()[0] for x in PIECES.split(", ")] + ["ids"] * keep_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, own = [], []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids = np.append(encode(text or "", json_path, ranks_path), end_id).astype("<u4")
                n = len(ids)
                for lo in range(0, n, size):
                    part = ids[lo:lo + size]
                    rows.append((doc, lo, len(part), zlib.crc32(part), n))
                    if keep_ids:
                        own.append(part.astype(np.int32))
            cols = [pa.array(c, pa.int64()) for c in zip(*rows)] if rows else [pa.array([], pa.int64())] * 5
            yield pa.RecordBatch.from_arrays(cols + [pa.array(own, pa.list_(pa.int32()))] * keep_ids, names)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")) \
        .mapInArrow(run, PIECES + ", ids array<int>" * keep_ids)


def first_fit_decreasing(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each length.  Lengths must come in descending order.

    The tree's leaves are the free places of the bins and each inner node holds the
    larger of its children, so going down to the left wherever that child has room
    finds the first bin that fits.
    """
    n = len(lengths)
    leaves = 1 << max(0, n - 1).bit_length()
    tree = [size] * (2 * leaves)
    where, offset = np.empty(n, np.int64), np.empty(n, np.int64)
    for k, need in enumerate(lengths.tolist()):
        at = 1
        while at < leaves:
            at *= 2
            if tree[at] < need:
                at += 1
        where[k], offset[k] = at - leaves, size - tree[at]
        tree[at] -= need
        at >>= 1
        while at:
            best = max(tree[2 * at], tree[2 * at + 1])
            if tree[at] == best:
                break
            tree[at] = best
            at >>= 1
    return where, offset


def pack(cut_pieces: DataFrame, size: int = 1024, group_pieces: int = 8192, seed: int = 42) -> DataFrame:
    """Pieces (``length`` at most ``size``) with ``sequence_id`` and ``offset`` in that sequence.

    The groups follow from a hash of the row's place, so equal, repeated or null
    ids spread like any others; ties in length go by the other columns.  Other
    columns are kept.  Empty table: no rows.
    """
    place, group = fresh(cut_pieces, "_place", "_group")
    rows = cut(cut_pieces.withColumn(place, F.monotonically_increasing_id()))
    groups = max(1, -(-rows.count() // group_pieces))
    rows = rows.withColumn(group, F.pmod(F.xxhash64(F.lit(seed), place), F.lit(groups)))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", place], ascending=[False, True], kind="stable", ignore_index=True)
        where, offset = first_fit_decreasing(pdf["length"].to_numpy(), size)
        return pdf.drop(columns=[place, group]).assign(
            sequence_id=(int(pdf[group].iloc[0]) << 32) + where, offset=offset)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut_pieces.schema) + ", sequence_id long, offset long"
    return rows.groupBy(group).applyInPandas(run, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """Packed pieces with ``ids`` -> ``(sequence_id, ids array<int>, doc_ids array<long>)``, unpadded."""
    own = F.sort_array(F.collect_list(F.struct("offset", "ids", "doc_id")))
    return packed.groupBy("sequence_id").agg(own.alias("own")).select(
        "sequence_id", F.flatten(F.col("own.ids")).alias("ids"), F.col("own.doc_id").alias("doc_ids"))


__all__ = ["pieces", "first_fit_decreasing", "pack", "sequences"]
