"""Operator 8: packing token pieces into sequences by minimum bin slack.

Which pieces of equal length go where does not matter, so bins are planned on the counts of
the lengths (4,096 numbers whatever the corpus): the fullest feasible combination of lengths
is found by a bitset subset-sum and taken as often as the counts allow. Pieces get their
place by their rank among pieces of equal length.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from fieldcast.llm.bpe import BLOCK_CHARS, coder, drop_coders
from fieldcast.llm.common import give_back, write_shared

CAPACITY = 4096
END_ID = 1
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part long, nth long"


def token_pieces(
    docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, trim: bool = False,
) -> DataFrame:
    """One row per piece: the ids of each text and ``end_id``, cut after every ``capacity`` ids.

    ``part`` and ``nth`` number pieces of equal length within their task; write the table
    before relying on them. With ``trim`` texts are encoded in smaller blocks, for less memory.
    """
    block = BLOCK_CHARS // 4 if trim else BLOCK_CHARS

    def run(batches):
        code, part, seen = coder(path), TaskContext.get().partitionId(), {}
        end = int(end_id).to_bytes(4, "little")
        for batch in batches:
            docs_, rows = batch.column(0), []
            for k, ids in enumerate(code.stream(batch.column(1), block)):
                ids += end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    raw = ids[at:at + 4 * capacity]
                    n = len(raw) // 4
                    nth = seen.get(n, 0)
                    seen[n] = nth + 1
                    rows.append((k, piece, at // 4, n, zlib.crc32(raw), part, nth))
            cols = list(zip(*rows)) or [[]] * 7
            yield pa.RecordBatch.from_arrays(
                [docs_.take(pa.array(cols[0], pa.int64())), pa.array(cols[1], pa.int32()),
                 *[pa.array(c, pa.int64()) for c in cols[2:]]],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"])
        drop_coders()
        give_back(trim)

    return docs.select("doc_id", "text").mapInArrow(run, PIECES)


def fullest(left: dict[int, int], room: int) -> dict[int, int]:
    """The lengths, as often as ``left`` has them, whose sum comes closest to ``room``.

    Subset sums as the bits of one integer; the copies of a length go in as powers of two.
    """
    reach, steps, goal = 1, [], 1 << room
    cut = (goal << 1) - 1
    for length in sorted((x for x in left if x <= room), reverse=True):
        most, times = min(left[length], room // length), 1
        while most > 0 and not reach & goal:
            times = min(times, most)
            steps.append((reach, length, times))
            reach |= reach << (length * times) & cut
            most, times = most - times, 2 * times
        if reach & goal:
            break
    total, chosen = reach.bit_length() - 1, {}
    for before, length, times in reversed(steps):
        if not before >> total & 1:
            chosen[length] = chosen.get(length, 0) + times
            total -= length * times
    return chosen


def minimum_slack(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, dict[int, int]]]:
    """(number of bins, {length: pieces in each}): every bin starts with the longest piece left
    and takes the fullest combination beside it."""
    left, plan = dict(counts), []
    while left:
        top = max(left)
        left[top] -= 1
        beside = fullest({k: n for k, n in left.items() if n}, capacity - top)
        left[top] += 1
        beside[top] = beside.get(top, 0) + 1
        bins = min(left[k] // n for k, n in beside.items())
        for k, n in beside.items():
            left[k] -= n * bins
            if not left[k]:
                del left[k]
        plan.append((bins, beside))
    return plan


def pack(
    docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, trim: bool = False,
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: one row per piece.

    Null texts count as empty (one piece: the end id); repeated rows are packed as often as
    they occur; an empty table gives no row. To the driver go the counts of the lengths, at
    most ``capacity`` rows; back go the runs of the plan, a few per length. ``trim`` gives the memory
    of finished tasks back to the system, for sessions with other work to come.
    """
    pieces = write_shared(token_pieces(docs, path, capacity, end_id, trim), "pieces")
    by_task = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    tasks = write_shared(by_task, "lengths")
    counts = {r[0]: r[1] for r in tasks.groupBy("length").agg(F.sum("n")).collect()}
    runs, sequence, used = [], 0, dict.fromkeys(counts, 0)
    for bins, inside in minimum_slack(counts, capacity):
        at = 0
        for length in sorted(inside, reverse=True):
            n = inside[length]
            runs.append((length, used[length], sequence, n, at))
            used[length] += n * bins
            at += n * length
        sequence += bins
    table = np.array(sorted(runs), np.int64).reshape(-1, 5)
    span = max(counts.values(), default=0) + 1
    keys = table[:, 0] * span + table[:, 1]  # at most 4097 * the rows of the corpus: 63 bits

    def place(batches):
        for batch in batches:
            length, nth = (batch.column(k).to_numpy(zero_copy_only=False) for k in ("length", "rank"))
            run = table[np.searchsorted(keys, length * span + nth, side="right") - 1]
            into = nth - run[:, 1]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(run[:, 2] + into // run[:, 3]),
                 pa.array(run[:, 4] + into % run[:, 3] * length)],
                names=[*batch.schema.names[:5], "sequence_id", "offset"])

    before = tasks.select("length", "part", (F.sum("n").over(
        Window.partitionBy("length").orderBy("part")) - F.col("n")).alias("before"))
    ranked = pieces.join(before, ["length", "part"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("nth") + F.col("before")).alias("rank"))
    return ranked.mapInArrow(
        place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
