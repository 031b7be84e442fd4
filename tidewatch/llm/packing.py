"""Best-two-fit packing of token sequences.

Sizes are whole numbers up to the sequence length, so the packing is planned on the histogram of
sizes, which is the same small table however many pieces there are. A bin is filled greedily;
then its smallest piece gives way to two unpacked pieces that fill its gap more tightly. The
pattern found is used as often as the histogram allows before the next is sought. Each piece then
finds its place from its size and its rank among pieces of that size.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import scratch, ship
from .tokens import encoder, with_end

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, pid int, nth long"


def cut(sizes: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pieces of texts of so many tokens: (text, piece, start). Only texts over ``most`` are cut; their first piece takes the remainder."""
    n = np.maximum(1, -(-sizes // most))
    doc = np.repeat(np.arange(len(sizes)), n)
    piece = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    first = sizes - (n - 1) * most
    return doc, piece, np.where(piece == 0, 0, first[doc] + (piece - 1) * most)


def plan(counts: dict[int, int], most: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Best-two-fit on a histogram: [(the sizes of a bin with how many of each, how many such bins)]."""
    left = np.zeros(most + 1, np.int64)
    for size, n in counts.items():
        left[size] = n
    bins = []
    while left.any():
        free, gap, used = left.copy(), most, []
        while gap and (fits := np.flatnonzero(free[: gap + 1])).size:
            size = int(fits[-1])
            k = min(int(free[size]), gap // size)
            used += [size] * k
            free[size] -= k
            gap -= k * size
        while gap:
            # Two unpacked pieces for the smallest one: the pair that leaves the least gap, the larger piece as large as can be.
            small = used[-1]
            there = np.flatnonzero(free[: gap + small + 1])
            partner = np.searchsorted(there, gap + small - there, "right") - 1
            ok = partner >= 0
            a, b = there[ok], there[partner[ok]]
            twice = (a == b) & (free[a] < 2)
            b = np.where(twice, np.where(partner[ok] > 0, there[np.maximum(partner[ok] - 1, 0)], 0), b)
            a, b = a[b > 0], b[b > 0]
            if not len(a) or (fill := int((a + b).max())) <= small:
                break
            best = int(a[a + b == fill].max())
            used[-1:] = [best, fill - best]
            free[best] -= 1
            free[fill - best] -= 1
            gap += small - fill
            free[small] += 1
            used.sort(reverse=True)
        need = np.bincount(used, minlength=most + 1)
        sizes = np.flatnonzero(need)
        times = int((left[sizes] // need[sizes]).min())
        left -= need * times
        bins.append(([(int(s), int(need[s])) for s in sizes[::-1]], times))
    return bins


def places(bins: list[tuple[list[tuple[int, int]], int]]) -> dict[int, np.ndarray]:
    """By size: rows of (first rank, first bin, how many in a bin, offset in the bin), by rank."""
    out: dict[int, list] = {}
    taken: dict[int, int] = {}
    at = 0
    for pattern, times in bins:
        offset = 0
        for size, k in pattern:
            out.setdefault(size, []).append((taken.get(size, 0), at, k, offset))
            taken[size] = taken.get(size, 0) + k * times
            offset += size * k
        at += times
    return {s: np.array(rows, np.int64) for s, rows in out.items()}


def pieces(docs: DataFrame, tokenizer: str, most: int) -> DataFrame:
    """Tokenize whole texts and cut the long ones; pid and nth number pieces of a size within their task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, pid, seen = encoder(tokenizer), TaskContext.get().partitionId(), np.zeros(most + 1, np.int64)
        for batch in batches:
            for row, ids, offsets in enc.batches(batch.column(1)):
                ids, offsets = with_end(ids, offsets)
                doc, piece, start = cut(np.diff(offsets), most)
                begin = offsets[doc] + start
                end = np.append(begin[1:], offsets[-1])
                size, raw = end - begin, memoryview(ids).cast("B")
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(begin.tolist(), end.tolist(), strict=True)]
                order = np.argsort(size, kind="stable")
                held = size[order]
                new = np.append(True, held[1:] != held[:-1])
                nth = np.empty_like(size)
                nth[order] = np.arange(len(size)) - np.flatnonzero(new)[np.cumsum(new) - 1]
                nth += seen[size]
                seen += np.bincount(size, minlength=most + 1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row).take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(size), pa.array(crc, pa.int64()), pa.array(np.full(len(doc), pid, np.int32)), pa.array(nth)],
                    ["doc_id", "piece", "start", "length", "ids_crc32", "pid", "nth"],
                )

    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECES)


def pack(docs: DataFrame, tokenizer: str, max_tokens: int = 1024) -> DataFrame:
    """Pack every text into sequences of at most ``max_tokens``; a row for each piece.

    A null or empty text is its end token alone. Repeated rows are packed each; a null doc_id is
    kept as null. Columns besides doc_id and text play no part. No rows give no rows.
    """
    spark = docs.sparkSession
    cutted = scratch(pieces(docs, tokenizer, max_tokens), "pieces")
    by_task = cutted.groupBy("length", "pid").agg(F.count("*").alias("n"))
    # The histogram has at most max_tokens rows, so it can go to the driver.
    counts = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    found = spark.sparkContext.broadcast(places(plan(counts, max_tokens)))
    # Ranks go on from task to task: a running sum over one row for each task and size.
    ranked = by_task.selectExpr("length", "pid", "sum(n) over (partition by length order by pid) - n as base")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.column("length").to_numpy()
            rank = batch.column("nth").to_numpy() + batch.column("base").to_numpy()
            seq, offset = np.empty_like(rank), np.empty_like(rank)
            order = np.argsort(size, kind="stable")
            edges = np.flatnonzero(np.diff(size[order])) + 1
            for rows in np.split(order, edges) if len(order) else ():
                s = int(size[rows[0]])
                table = found.value[s]
                k = table[np.searchsorted(table[:, 0], rank[rows], "right") - 1]
                beyond = rank[rows] - k[:, 0]
                seq[rows] = k[:, 1] + beyond // k[:, 2]
                offset[rows] = k[:, 3] + beyond % k[:, 2] * s
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(seq), pa.array(offset)], [*batch.schema.names[:5], "sequence_id", "offset"])

    return (
        cutted.join(ranked, ["length", "pid"])
        .select("doc_id", "piece", "start", "length", "ids_crc32", "nth", "base")
        .mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
    )
