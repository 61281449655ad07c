"""Operator 2: exact top-k inner products over a pivot-distance index.

Vectors are keyed by their nearest pivot and their distance to it and stored in blocks of
consecutive distances (annuli). The inner product is (|q|^2 + |x|^2 - |q - x|^2) / 2, and the
triangle inequality bounds |q - x| from below by the gap between the query's distance to a
pivot and the block's range of distances. Queries meet the blocks with the best bounds first;
their fifth score so far then decides which other blocks can still matter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from fieldcast.llm.common import write_shared

PIVOTS = 48
SAMPLE = 4096       # vectors the pivots are fitted on, the smallest by a hash of the id
BLOCK = 1024        # vectors of a block at most
QUERIES = 256       # queries of a group at most
FIRST = 2           # blocks a group meets before others are ruled out
LARGEST = 1 << 26   # least size of a component, as an integer, that is refused

BLOCK_SCHEMA = (
    "block long, dim int, pivot int, low double, high double, norm double, n int, ids binary, vectors binary")


def integers(embedding: Column, scale: int) -> Column:
    return F.transform(embedding, lambda x: F.floor(x.cast("double") * scale).cast("long"))


def usable(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """vec_id, v (integers): rows with an id and only finite components. A component beyond
    ``LARGEST`` raises an error, as its products could leave the 64-bit range."""
    x, finite = F.col(vector_col), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    ok = vectors.select(F.col(id_col).cast("long").alias("vec_id"), x.alias("e")).where(
        F.col("vec_id").isNotNull() & F.col("e").isNotNull() & F.forall("e", finite))
    large = F.exists("e", lambda x: F.abs(x.cast("double")) * scale >= LARGEST)
    return ok.select("vec_id", F.when(large, F.raise_error(F.lit("component too large for exact scores")))
                     .otherwise(integers(F.col("e"), scale)).alias("v"))


def matrix(column: pa.Array) -> np.ndarray:
    """A list column of equal lengths as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def fit_pivots(vectors: DataFrame, pivots: int, sample: int, rounds: int = 8) -> dict[int, np.ndarray]:
    """Pivots per vector length by k-means on a bounded sample; other lengths get the origin."""
    rows = vectors.select("v").orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(sample).toArrow()["v"].to_pylist()
    out = {}
    for dim in sorted({len(r) for r in rows} - {0}):
        data = np.array([r for r in rows if len(r) == dim], np.float64)
        centres = np.unique(data, axis=0)
        centres = centres[np.linspace(0, len(centres) - 1, min(pivots, len(centres))).astype(int)]
        for _ in range(rounds):
            near = nearest(data, centres)[0]
            for k in range(len(centres)):
                if (near == k).any():
                    centres[k] = data[near == k].mean(0)
        out[dim] = centres
    return out


SLACK = 1e-9        # of the squared norms: what rounding may cost a bound, many times over


def distances(data: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """From differences: squares of long vectors close to each other would cancel out."""
    out = np.empty((len(data), len(centres)))
    for k, centre in enumerate(centres):
        out[:, k] = np.sqrt(((data - centre) ** 2).sum(1))
    return out


def upper_bound(near, far, low, high, size, norm):
    """The best inner product of a query of norm ``size``, at a distance of ``near`` to ``far`` from a
    pivot, with a vector of norm ``norm`` at most, ``low`` to ``high`` from the pivot. Works on columns
    and on arrays of doubles alike."""
    greatest, least = (F.greatest, F.least) if isinstance(near, Column) else (_greatest, np.minimum)
    zero = F.lit(0.0) if isinstance(near, Column) else 0.0
    gap = greatest(zero, near - high, low - far)
    squares = size * size + norm * norm
    return least((squares - gap * gap) / 2, size * norm) + squares * SLACK + 1e-3


def _greatest(*values):
    return np.maximum(np.maximum(values[0], values[1]), values[2])


def nearest(data: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    gap = distances(data, centres)
    at = gap.argmin(1)
    return at, gap[np.arange(len(data)), at]


def keyed(vectors: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """dim, pivot, distance, vec_id, v."""

    def run(batches):
        for batch in batches:
            sizes = np.array([len(x) for x in batch.column(1)])
            for dim in np.unique(sizes).tolist():
                rows = batch.filter(pa.array(sizes == dim))
                data = matrix(rows.column(1)).astype(np.float64)
                at, gap = nearest(data, pivots.get(dim, np.zeros((1, dim))))
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(rows), dim, np.int32)), pa.array(at.astype(np.int32)),
                    pa.array(gap), *rows.columns], names=["dim", "pivot", "distance", "vec_id", "v"])

    return vectors.mapInArrow(run, "dim int, pivot int, distance double, vec_id long, v array<long>")


def blocks(keys: DataFrame, most: int, by_pivot: bool) -> DataFrame:
    """Consecutive vectors, ordered by pivot and distance, packed ``most`` to a row.

    Ranges end within a pivot, and within one distance at an id, so that a pivot or a vector
    that holds much of the table is spread over many tasks.
    """
    order = ["dim", "pivot", "distance", "vec_id"]

    def pack(batches):
        part, made, held = TaskContext.get().partitionId(), 0, None

        def emit(group):
            nonlocal made
            v = matrix(group.column("v").combine_chunks())
            gap = group.column("distance").to_numpy()
            made += 1
            return pa.RecordBatch.from_pylist([{
                "block": (part << 32) + made, "dim": group.column("dim")[0].as_py(),
                "pivot": group.column("pivot")[0].as_py(), "low": float(gap.min()), "high": float(gap.max()),
                "norm": float(np.sqrt((v.astype(np.float64) ** 2).sum(1).max())), "n": len(v),
                "ids": group.column("vec_id").to_numpy().astype("<i8").tobytes(),
                "vectors": v.astype("<i4").tobytes()}], schema=schema)

        schema = pa.schema([("block", pa.int64()), ("dim", pa.int32()), ("pivot", pa.int32()), ("low", pa.float64()),
                            ("high", pa.float64()), ("norm", pa.float64()), ("n", pa.int32()),
                            ("ids", pa.binary()), ("vectors", pa.binary())])
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            cuts, done = cuts_of(held), 0
            for a, b in zip(cuts, cuts[1:]):
                if b < held.num_rows:
                    yield emit(held.slice(a, b - a))
                    done = b
            held = held.slice(done)
        if held is not None and held.num_rows:
            yield emit(held)

    def cuts_of(table):
        kind = table.column("dim").to_numpy().astype(np.int64) << 32
        if by_pivot:
            kind = kind + table.column("pivot").to_numpy()
        starts = np.append(np.flatnonzero(np.append(True, kind[1:] != kind[:-1])), len(kind))
        cuts = [0]
        for a, b in zip(starts, starts[1:]):
            cuts += [*range(int(a) + most, int(b), most), int(b)]
        return cuts

    return keys.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(pack, BLOCK_SCHEMA)


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256,
          id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best inner products of each query.

    ``is_query`` is a condition on the id column. Components become floor(scale * x). Every
    usable row but those with the query's own id is a candidate; only vectors of equal length
    have an inner product. Ties go to the smaller vec_id. Repeated rows are candidates as often
    as they occur; a query id that occurs on several rows asks with its smallest vector. Rows
    that are null, or hold null or non-finite components, take no part; neither do other columns.
    """
    usable_rows = usable(vectors, id_col, vector_col, scale)
    pivots = fit_pivots(usable_rows, PIVOTS, SAMPLE)
    index = write_shared(blocks(keyed(usable_rows, pivots), BLOCK, True), "blocks")
    asked = usable(vectors.where(is_query), id_col, vector_col, scale).groupBy("vec_id").agg(F.min("v").alias("v"))
    groups = write_shared(blocks(keyed(asked, pivots), QUERIES, False).withColumnRenamed("block", "group"), "queries")

    tiles = write_shared(bounds(groups, index, pivots), "tiles")
    order = Window.partitionBy("group").orderBy(F.desc("bound"), "block")
    ranked = tiles.withColumn("nth", F.row_number().over(order))
    begun = write_shared(scored(ranked.where(F.col("nth") <= FIRST), groups, index, None, k), "first")
    # The k-th score of each query so far, in the order of its group.
    enough = begun.groupBy("group", "query_id").agg(F.sort_array(F.collect_list("score"), asc=False).alias("s"))
    floor = enough.select("group", "query_id", F.get("s", F.lit(k - 1)).alias("floor")).groupBy("group").agg(
        F.min(F.coalesce("floor", F.lit(-(1 << 62)))).alias("floor"), F.count("*").alias("n"),
        F.collect_list(F.struct("query_id", "floor")).alias("floors"))  # QUERIES at most
    rest = (
        ranked.where(F.col("nth") > FIRST)
        .join(groups.select("group", F.col("n").alias("size")), "group")
        .join(floor, "group", "left")
        .where(F.col("floor").isNull() | (F.col("n") < F.col("size")) | (F.col("bound") >= F.col("floor")))
        .select("group", "block", "floors")
    )
    found = begun.unionByName(scored(rest, groups, index, "floors", k))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def bounds(groups: DataFrame, index: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """group, block, bound: the best inner product that any query of a group can reach in a block.

    A group and a block meet on the block's pivot, through the range of the group's distances
    to that pivot: one small row per pair of a query group and a block.
    """

    def ranges(batches):
        for batch in batches:
            for row in batch.to_pylist():
                data = np.frombuffer(row["vectors"], "<i4").reshape(row["n"], row["dim"]).astype(np.float64)
                gap = distances(data, pivots.get(row["dim"], np.zeros((1, row["dim"]))))
                count = gap.shape[1]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(count, row["group"])), pa.array(np.full(count, row["dim"], np.int32)),
                    pa.array(np.arange(count, dtype=np.int32)), pa.array(gap.min(0)), pa.array(gap.max(0)),
                    pa.array(np.full(count, row["norm"]))],
                    names=["group", "dim", "pivot", "near", "far", "size"])

    spans = groups.select("group", "dim", "n", "norm", "vectors").mapInArrow(
        ranges, "group long, dim int, pivot int, near double, far double, size double")
    meta = index.select("block", "dim", "pivot", "low", "high", "norm")
    bound = upper_bound(*[F.col(c) for c in ("near", "far", "low", "high", "size", "norm")])
    return spans.join(meta, ["dim", "pivot"]).select("group", "block", bound.alias("bound"))


def scored(tiles: DataFrame, groups: DataFrame, index: DataFrame, floors: str | None, k: int) -> DataFrame:
    """The ``k`` best pairs of each query within each tile (a query group and a block), without
    those below the query's floor."""
    sides = tiles.join(groups.select("group", "dim", F.col("ids").alias("q_ids"), F.col("vectors").alias("q")), "group")
    sides = sides.join(index.select("block", "ids", "vectors"), "block").select(
        "group", "dim", "q_ids", "q", "ids", "vectors",
        (F.col(floors) if floors else F.lit(None).cast("array<struct<query_id: bigint, floor: bigint>>")).alias("floors"))

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                yield tile(row, k)

    return sides.mapInArrow(run, "group long, query_id long, vec_id long, score long")


def tile(row: dict, k: int) -> pa.RecordBatch:
    q_ids, ids = np.frombuffer(row["q_ids"], "<i8"), np.frombuffer(row["ids"], "<i8")
    q = np.frombuffer(row["q"], "<i4").reshape(len(q_ids), row["dim"])
    x = np.frombuffer(row["vectors"], "<i4").reshape(len(ids), row["dim"])
    reach = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * max(row["dim"], 1)
    if reach < 2 ** 52:  # whole numbers that doubles hold exactly
        score = (q.astype(np.float64) @ x.T.astype(np.float64)).astype(np.int64)
    elif reach < 2 ** 62:
        score = q.astype(np.int64) @ x.T.astype(np.int64)
    else:
        raise OverflowError("inner products leave the 64-bit range")
    least = np.full(len(q_ids), -(1 << 62))
    for f in row["floors"] or ():
        if f["floor"] is not None:
            least[np.flatnonzero(q_ids == f["query_id"])] = f["floor"]
    own = q_ids[:, None] == ids
    if len(ids) > 4 * k:
        cut = np.partition(np.where(own, np.iinfo(np.int64).min, score), len(ids) - k, axis=1)[:, len(ids) - k]
        least = np.maximum(least, cut)
    at, to = np.nonzero((score >= least[:, None]) & ~own)
    order = np.lexsort((ids[to], -score[at, to], at))
    at, to = at[order], to[order]
    first = np.searchsorted(at, at)
    keep = np.arange(len(at)) - first < k  # ties beyond k have larger ids
    at, to = at[keep], to[keep]
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(at), row["group"])), pa.array(q_ids[at]), pa.array(ids[to]), pa.array(score[at, to])],
        names=["group", "query_id", "vec_id", "score"])
