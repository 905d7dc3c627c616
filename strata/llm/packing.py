"""Operator 5: variable-capacity best-fit packing.

Documents (longer ones cut into pieces of the largest permitted length) are put
into sequences of several permitted lengths. Pieces go in descending length into
the open bin with the least room that still holds them. Where none does, a new
bin is opened with the permitted size that is expected to cost least for each
packed word: its filling is foreseen by laying the largest remaining pieces that
fit, until none does. At the end each bin is downsized to the smallest permitted
length that holds its contents.

Pieces are packed in lots of ``LOT`` rows. Lots are cut from partitions ordered
by a hash, so each is a fair sample of the lengths; a task holds one lot,
whatever the number of rows or copies. Only doc_id and length are shuffled.

Defined results: every row gives its pieces (doc_id, piece, start, length,
bin_id, bin_capacity, bin_offset); texts without words (null, empty) give one
piece of length 0 with null bin columns; rows with a repeated or null doc_id are
packed row by row. Further columns of the input do not matter.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Callable, Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import n_words

CAPACITIES = (512, 1024, 2048, 4096)
LOT = 20_000
SCHEMA = ("doc_id long, piece int, start long, length int, bin_id long, bin_capacity int, bin_offset int")


def cost(capacity: int) -> float:
    """Relative cost of training on one sequence: linear work plus attention,
    which grows with the square of the length."""
    return capacity * (1 + capacity / 16384)


def _least_cost(length: int, waiting: list[int], ahead: list[int], first: int, capacities,
                price: Callable[[int], float]) -> int:
    """The capacity to open for a piece; ``waiting`` from ``first`` on are the
    negated lengths of the pieces still to come, in descending length, ``ahead[i]``
    the total length of the pieces before ``i``. Pieces that follow each other are
    laid in one step; what a step leaves is less than its last piece."""
    best, chosen = float("inf"), capacities[-1]
    for capacity in capacities:
        if capacity < length:
            continue
        room, at = capacity - length, first
        while room:
            at = bisect_left(waiting, -room, at)
            if at >= len(waiting):
                break
            stop = bisect_right(ahead, ahead[at] + room, at) - 1
            room -= ahead[stop] - ahead[at]
            at = stop
        each = price(capacity) / (capacity - room)
        if each < best - 1e-12:
            best, chosen = each, capacity
    return chosen


def pack(lengths: np.ndarray, capacities=CAPACITIES, price: Callable[[int], float] = cost):
    """Bin number, offset in the bin and final capacity of the bin for each of
    ``lengths`` (1 to the largest capacity)."""
    capacities = sorted(capacities)
    order = np.argsort(-lengths, kind="stable")
    ordered = lengths[order].tolist()
    waiting, ahead = [-x for x in ordered], list(accumulate(ordered, initial=0))
    number, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    used: list[int] = []
    room: list[tuple[int, int]] = []
    for i, length in enumerate(ordered):
        k = bisect_left(room, (length, -1))
        if k < len(room):
            free, bin_ = room.pop(k)
        else:
            free, bin_ = _least_cost(length, waiting, ahead, i + 1, capacities, price), len(used)
            used.append(0)
        number[order[i]], offset[order[i]] = bin_, used[bin_]
        used[bin_] += length
        if free > length:
            insort(room, (free - length, bin_))
    fitted = np.array(capacities)[np.searchsorted(capacities, np.array(used, dtype=np.int64))] if used else np.zeros(0, int)
    return number, offset, fitted[number] if len(lengths) else np.zeros(0, int)


def _pack_lot(lot: pd.DataFrame, first_bin: int, capacities) -> tuple[pd.DataFrame, int]:
    most = max(capacities)
    length = lot["length"].to_numpy(np.int64)
    n = np.maximum(1, -(-length // most))
    row = np.repeat(np.arange(len(lot)), n)
    piece = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    part = np.minimum(length[row] - piece * most, most)
    out = pd.DataFrame({"doc_id": lot["doc_id"].array[row], "piece": piece, "start": piece * most, "length": part})
    packed = part > 0
    number, offset, capacity = pack(part[packed], capacities)
    for name, values in (("bin_id", number + first_bin), ("bin_capacity", capacity), ("bin_offset", offset)):
        column = pd.array([pd.NA] * len(out), dtype="Int64")
        column[packed] = values
        out[name] = column
    return out, first_bin + int(number.max(initial=-1)) + 1


def _pack_partition(capacities, lot_rows: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        next_bin, held, n = TaskContext.get().partitionId() << 40, [], 0
        for pdf in batches:
            pdf["doc_id"] = pdf["doc_id"].astype("Int64").mask(pdf["no_id"])
            while len(pdf):
                take = pdf.iloc[:lot_rows - n]
                pdf = pdf.iloc[len(take):]
                held.append(take)
                n += len(take)
                if n == lot_rows:
                    out, next_bin = _pack_lot(pd.concat(held, ignore_index=True), next_bin, capacities)
                    held, n = [], 0
                    yield out
        if n:
            yield _pack_lot(pd.concat(held, ignore_index=True), next_bin, capacities)[0]

    return run


def pack_documents(docs: DataFrame, length: Column | None = None, capacities=CAPACITIES, lot_rows: int = LOT) -> DataFrame:
    """One row per piece of every row of ``docs``; ``length`` defaults to the
    number of words."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (n_words() if length is None else length)
                       .cast("long").alias("length"), F.monotonically_increasing_id().alias("at"))
    # A null doc_id travels as a flag: pandas would turn a batch's ids into doubles.
    dealt = (rows.withColumn("order", F.xxhash64("doc_id", "length", "at")).repartition("order")
             .sortWithinPartitions("order", "doc_id")
             .select(F.coalesce("doc_id", F.lit(0).cast("long")).alias("doc_id"), "length",
                     F.col("doc_id").isNull().alias("no_id")))
    return dealt.mapInPandas(_pack_partition(tuple(capacities), lot_rows), SCHEMA)
