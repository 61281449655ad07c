"""Operator 7: SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints x and y at distance 2 or less, cut into m partitions of bits, differ in some
partition i by at most T[i] bits whenever the thresholds T sum to 2 - m + 1 (a threshold of
-1 leaves its partition out). Correlated bits share a partition; the thresholds are chosen
per fingerprint by dynamic programming over estimated candidate counts, so that crowded
values are not probed. Probes meet an index of all fingerprints and are verified by the
exact distance.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from fieldcast.llm.common import give_back, texts_of, write_shared
from fieldcast.llm.components import components

SHINGLE = 3       # words of a shingle
DISTANCE = 2      # differing bits at most of a link
PARTITIONS = 3    # thresholds then sum to zero
FEW = 8           # values with up to so many fingerprints count as equally cheap
CROWD = 64        # values with more fingerprints are joined through shared neighbours
HASH_ROWS = 1 << 16
SLICE_BYTES = 1 << 21  # of texts held as Python strings at a time


def fingerprint(text: str | None) -> int:
    """The 64-bit SimHash as a signed integer; 0 without a word."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    h = xxhash.xxh64_intdigest
    if len(words) < SHINGLE:
        shingles = [h(b" ".join(words), 42)]
    else:
        runs = zip(*(words[k:] for k in range(SHINGLE)))
        shingles = [h(b" ".join(run), 42) for run in runs]
    hashes, ones = np.array(shingles, np.uint64).view(np.uint8).reshape(-1, 8), np.zeros(64, np.int64)
    for a in range(0, len(hashes), HASH_ROWS):
        ones += np.unpackbits(hashes[a:a + HASH_ROWS], axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprint_column(text: Column) -> Column:
    @F.arrow_udf("long")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            yield pa.array(
                [fingerprint(t) for _, texts in texts_of(column, SLICE_BYTES) for t in texts], pa.int64())
        give_back()

    return run(text)


def bit_groups(fps: DataFrame, m: int = PARTITIONS) -> list[list[int]]:
    """The 64 bits in ``m`` groups of equal width, correlated bits together.

    ``fps`` has one column ``fp`` of distinct fingerprints; all of them are counted. What
    reaches the driver is one 64 x 64 table of counts.
    """

    def count(batches):
        total, n = np.zeros((64, 64)), 0
        for batch in batches:
            codes = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint8).reshape(-1, 8)
            bits = np.unpackbits(codes, axis=1, bitorder="little").astype(np.float32)
            total += bits.T @ bits
            n += len(bits)
        counts = np.append(total.ravel(), n).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(counts.size)), pa.array(counts)], names=["at", "n"])

    rows = fps.select("fp").mapInArrow(count, "at long, n long").groupBy("at").agg(F.sum("n")).collect()
    counts = np.zeros(64 * 64 + 1)
    for at, n in rows:
        counts[at] = n
    n, both = max(counts[-1], 1.0), counts[:-1].reshape(64, 64)
    mean = both.diagonal() / n
    spread = np.sqrt(np.maximum(mean * (1 - mean), 1e-12))
    tie = np.abs((both / n - np.outer(mean, mean)) / np.outer(spread, spread))
    np.fill_diagonal(tie, 0)
    left, groups = set(range(64)), []
    for k in range(m):
        width = -(-len(left) // (m - k))
        rest = sorted(left)
        seed = rest[int(np.argmax(tie[np.ix_(rest, rest)].max(1)))]
        group = [seed]
        left.remove(seed)
        while len(group) < width:
            rest = sorted(left)
            best = rest[int(np.argmax(tie[np.ix_(rest, group)].sum(1)))]
            group.append(best)
            left.remove(best)
        groups.append(sorted(group))
    return groups


def masks(group: list[int], most: int) -> list[np.ndarray]:
    """All flips of 0, 1, ... ``most`` bits of a group, as arrays of signed masks."""
    return [
        np.array([sum(1 << b for b in c) for c in combinations(group, t)], np.uint64).view(np.int64)
        for t in range(most + 1)
    ]


def allocate(cost: np.ndarray, budget: int) -> np.ndarray:
    """Per row the thresholds, -1 upwards, with the least total cost that sum to ``budget``.

    ``cost[row, partition, threshold + 1]``; dynamic programming over the partitions.
    """
    n, m, kinds = cost.shape
    span = m * (kinds - 1) + 1                     # sums of thresholds, from -m
    best = np.full((n, span), np.inf)
    best[:, 0] = 0.0
    choice = np.zeros((m, n, span), np.int64)
    for i in range(m):
        new = np.full((n, span), np.inf)
        for k in range(kinds):
            value = best[:, :span - k] + cost[:, i, k, None]
            better = value < new[:, k:]
            new[:, k:][better] = value[better]
            choice[i][:, k:][better] = k
        best = new
    out, at, rows = np.zeros((n, m), np.int64), np.full(n, budget + m), np.arange(n)
    for i in reversed(range(m)):
        out[:, i] = choice[i, rows, at]
        at = at - out[:, i]
    return out - 1


def links(fps: DataFrame, distance: int = DISTANCE, m: int = PARTITIONS) -> DataFrame:
    """Pairs (u, v) that connect all fingerprints at most ``distance`` (2) bits apart.

    ``fps``: distinct fingerprints ``fp``, as a written table. Within one index value of up
    to ``CROWD`` fingerprints all candidates are verified, so a probe meets ``CROWD`` rows at
    most. Fingerprints of fuller values are linked through the fingerprints one bit away:
    two that share such a neighbour differ in two bits at most, and any two that differ in at
    most two share one. That is exact too, and linear in the size of the value.
    """
    if distance != 2:
        raise ValueError("shared neighbours decide distance 2 only")
    groups = bit_groups(fps, m)
    kept = [int(np.array([sum(1 << b for b in g)], np.uint64).view(np.int64)[0]) for g in groups]
    index = fps.select(
        "fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(k)) for k in kept])).alias("part", "value"))
    counts = write_shared(
        index.groupBy("part", "value").agg(F.count("*").alias("n")).where(F.col("n") > FEW), "values")
    mean = {r[0]: float(r[1]) for r in counts.groupBy("part").agg(
        F.sum(F.col("n") * F.col("n"))).collect()}
    total = max(fps.count(), 1)
    usual = [FEW + mean.get(i, 0.0) / total for i in range(m)]   # fingerprints where one lies
    flips = [masks(g, distance) for g in groups]

    def probes(batches):
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False)
            cost = np.zeros((len(fp), m, distance + 2))
            for i in range(m):
                crowd = np.maximum(batch.column(1 + i).to_numpy(zero_copy_only=False), FEW)
                cost[:, i, 1] = crowd + 1
                for t in range(1, distance + 1):
                    cost[:, i, t + 1] = cost[:, i, t] + len(flips[i][t]) * (1 + usual[i])
            chosen = allocate(cost, distance - m + 1)
            for i in range(m):
                for t in range(distance + 1):
                    who = fp[chosen[:, i] >= t]
                    for flip in flips[i][t]:
                        yield pa.RecordBatch.from_arrays([
                            pa.array(who), pa.array(np.full(len(who), i, np.int32)),
                            pa.array((who & kept[i]) ^ flip)], names=["fp", "part", "value"])

    crowded = index.join(counts, ["part", "value"]).groupBy("fp").agg(
        *[F.max(F.when(F.col("part") == i, F.col("n"))).alias(f"n{i}") for i in range(m)])
    sought = fps.select("fp").join(crowded, "fp", "left").select(
        "fp", *[F.coalesce(f"n{i}", F.lit(0)).alias(f"n{i}") for i in range(m)])
    probed = write_shared(sought.mapInArrow(probes, "fp long, part int, value long"), "probes")

    full = counts.where(F.col("n") > CROWD).select("part", "value")
    pairs = (
        probed.join(full, ["part", "value"], "left_anti").alias("p")
        .join(index.alias("i"), ["part", "value"])
        .where((F.col("p.fp") != F.col("i.fp"))
               & (F.bit_count(F.col("p.fp").bitwiseXOR(F.col("i.fp"))) <= distance))
        .select(F.col("p.fp").alias("u"), F.col("i.fp").alias("v"))
    )
    dense = probed.unionByName(index).join(full, ["part", "value"], "left_semi").select("fp").distinct()
    near = [0, *flips_of_word()]
    shared = (
        dense.select("fp", F.explode(F.transform(
            F.array(*[F.lit(x) for x in near]), lambda x: x.bitwiseXOR(F.col("fp")))).alias("z"))
        .groupBy("z").agg(F.collect_list("fp").alias("at")).where(F.size("at") > 1)  # 65 at most
        .select(F.array_min("at").alias("u"), F.explode("at").alias("v"))
    )
    return pairs.unionByName(shared).where("u <> v")


def flips_of_word() -> list[int]:
    return np.array([1 << b for b in range(64)], np.uint64).view(np.int64).tolist()


def groups_of(prints: DataFrame) -> DataFrame:
    """(fp, component_id, root) per distinct fingerprint of ``prints`` (columns doc_id, fp).

    ``component_id`` is the smallest doc_id of the component (null if it has none), ``root``
    its smallest fingerprint.
    """
    fps = write_shared(prints.groupBy("fp").agg(F.min("doc_id").alias("doc_id")), "fingerprints")
    roots = components(links(fps))
    labelled = fps.join(roots.withColumnRenamed("u", "fp"), "fp", "left").select(
        "fp", "doc_id", F.coalesce("root", "fp").alias("root"))
    least = labelled.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return labelled.drop("doc_id").join(least, "root").select("fp", "component_id", "root")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id: one row per row of ``docs``.

    Null or blank texts have fingerprint zero and link like any other; repeated rows stay
    repeated; a component without any doc_id has a null component_id. Other columns play no
    part.
    """
    prints = write_shared(docs.select("doc_id", fingerprint_column(F.col("text")).alias("fp")), "prints")
    found = groups_of(prints)
    return prints.join(found, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_per_group(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component the row with the smallest
    doc_id stays (nulls last; of equal rows one). Columns are those of ``docs``, whatever their names.

    Rows that agree in doc_id and fingerprint count as one document.
    """
    prints = write_shared(docs.select("doc_id", fingerprint_column(F.col("text")).alias("fp")), "prints")
    best = prints.join(groups_of(prints), "fp").groupBy("root").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("nameless"), F.col("doc_id").alias("id"), F.col("fp"))).alias("b"))
    keys = best.select(F.col("b.id").alias("id"), F.col("b.fp").alias("fp"))
    rows = docs.select(
        F.struct("*").alias("row"), "doc_id", fingerprint_column(F.col("text")).alias("print"), F.xxhash64("text").alias("hash"))
    kept = rows.join(keys, rows["doc_id"].eqNullSafe(keys["id"]) & (rows["print"] == keys["fp"]))
    same = kept.withColumn("nth", F.expr("row_number() over (partition by id, fp order by hash)"))
    return same.where("nth = 1").select("row.*")
