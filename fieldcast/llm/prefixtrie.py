"""Operator 12: a trie of conversation prefixes, rolled up by centroid decomposition.

Conversations that begin with the same turns share nodes. The trie is a forest of edges from
node to parent. Sums over subtrees are gathered by centroid decomposition: a component of n
nodes is cut at its centroid, the lowest node that still has more than half of them below it.
The totals of the pieces below the centroid are added up, and that sum goes to every node from
the centroid to the top of the component. The pieces, at most half as large, are cut in the
same way, so a node takes part in a logarithmic number of cuts, however deep the trie is.

The nodes from the centroid to the top are just those with more than half of the component
below them, so a cut needs no walk: sizes are counted once (by pointer doubling) and corrected
by each cut. Components of more than ``BLOCK`` nodes are cut by Spark joins, all of them at the
same time; smaller ones are dealt out whole and cut side by side in numpy, by the same rule.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fieldcast.llm.common import write_shared

BLOCK = 256        # nodes of a component that one task cuts by itself
BUFFER = 20_000    # nodes that a task cuts side by side
MOST_SHARED = 8    # first turns that a conversation may borrow
ID_BITS = 12       # conversations per link of a digest: 2 ** ID_BITS ids at most


# --- sums over subtrees ------------------------------------------------------------------------

def cut_components(parent: np.ndarray, size: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Subtree sums of a forest. ``parent`` holds places (a top its own), ``size`` the number of
    nodes below and at each node, ``values`` one row per value."""
    n = len(parent)
    places = np.arange(n)
    size, found = size.copy(), np.zeros_like(values)
    top = parent.copy()
    while not np.array_equal(top, top[top]):
        top = top[top]
    live = np.ones(n, bool)
    while live.any():
        whole = size[top]
        path = live & (2 * size > whole)
        # On a path sizes fall from the top down, so the smallest one is at the centroid.
        least = np.full(n, np.iinfo(np.int64).max)
        np.minimum.at(least, top[path], size[path])
        centroid = places[path & (size == least[top])]
        cut = np.zeros(n, bool)
        cut[centroid] = True
        below = live & cut[parent] & (parent != places) & (top == top[parent])
        up = np.where(below | (top == places) | ~live, places, parent)
        old, lost = top, np.zeros(n, np.int64)
        lost[top[centroid]] = size[centroid]
        top = up
        while not np.array_equal(top, top[top]):
            top = top[top]
        total = np.zeros_like(values)
        rest = live & ~cut
        for row, value, out in zip(total, values, found):
            np.add.at(row, top[rest], value[rest])            # totals of the pieces
            at = np.zeros(n, values.dtype)
            at[old[centroid]] = value[centroid]
            np.add.at(at, old[places[below]], row[places[below]])  # of those below the centroid
            out[path] += at[old[path]]
        size = np.where(path & ~cut, size - lost[old], size)
        live = rest
    return found


def _blocks(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Whole components of sorted batches, at least ``BUFFER`` nodes at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
        if sum(b.num_rows for b in held) < BUFFER:
            continue
        rows = pa.Table.from_batches(held)
        tops = rows["top"].to_numpy()
        whole = int(np.searchsorted(tops == tops[-1], True)) if tops[0] != tops[-1] else 0
        if whole:
            yield from _summed(rows.slice(0, whole), names)
        held = rows.slice(whole).combine_chunks().to_batches()
    if held:
        yield from _summed(pa.Table.from_batches(held), names)


def _summed(rows: pa.Table, names: list[str]) -> Iterator[pa.RecordBatch]:
    node, above = rows["node"].to_numpy(), rows["parent"].to_numpy(zero_copy_only=False)
    order = np.argsort(node)
    is_top = node == rows["top"].to_numpy()
    above = np.where(is_top, node, above).astype(np.int64)
    parent = order[np.searchsorted(node[order], above)]
    values = np.array([rows[c].to_numpy() for c in names], dtype=np.int64).reshape(len(names), len(node))
    sums = cut_components(parent, rows["size"].to_numpy(), values)
    found = [pa.array(sums[i] + rows[f"sum_{c}"].to_numpy()) for i, c in enumerate(names)]
    yield pa.RecordBatch.from_arrays([pa.array(node), *found], names=["node", *[f"sum_{c}" for c in names]])


def _sized(forest: DataFrame, names: list[str]) -> DataFrame:
    """Add ``size`` (nodes at and below a node) and ``top``, by doubling the reach of a pointer.

    After k rounds ``size`` counts the nodes within 2**k steps below, and ``top`` is the ancestor
    2**k steps above (``whole``) or the last one.
    """
    state = write_shared(forest.select(
        "node", "parent", *names, F.lit(1).cast("long").alias("size"),
        F.coalesce("parent", "node").alias("top"), F.col("parent").isNotNull().alias("whole")), "trie")
    while not state.where("whole").isEmpty():
        arrived = state.where("whole").groupBy("top").agg(F.sum("size").alias("_more")).withColumnRenamed("top", "node")
        above = state.select(F.col("node").alias("top"), F.col("top").alias("_top"), F.col("whole").alias("_whole"))
        state = write_shared(state.join(arrived, "node", "left").join(above, "top").select(
            "node", "parent", *names, (F.col("size") + F.coalesce("_more", F.lit(0))).alias("size"),
            F.col("_top").alias("top"), (F.col("whole") & F.col("_whole")).alias("whole")), "trie")
    return state.drop("whole")


def _cut_once(live: DataFrame, big: DataFrame, names: list[str]) -> tuple[DataFrame, DataFrame]:
    """Cut the components in ``big`` (top, whole) at their centroids: (nodes left, centroids with
    their sums)."""
    sums = [f"sum_{c}" for c in names]
    inside = live.join(big, "top")
    path = 2 * F.col("size") > F.col("whole")
    centroid = inside.where(path).groupBy("top").agg(
        F.min_by("node", "size").alias("_centroid"), F.min("size").alias("_lost"))
    marked = write_shared(inside.join(centroid, "top").withColumn("path", path), "trie-cut")
    pointed = write_shared(marked.where("node <> _centroid").select(
        "node", F.when((F.col("node") == F.col("top")) | (F.col("parent") == F.col("_centroid")), F.col("node"))
        .otherwise(F.col("parent")).alias("up")), "trie-pieces")
    while True:
        above = pointed.select(F.col("node").alias("up"), F.col("up").alias("_up"))
        further = write_shared(pointed.join(above, "up").select("node", F.col("_up").alias("up"), (
            F.col("_up") != F.col("up")).alias("moved")), "trie-pieces")
        pointed = further.drop("moved")
        if further.where("moved").isEmpty():
            break
    placed = marked.join(pointed, "node", "left")  # the centroid has no piece
    below = placed.groupBy(F.coalesce("up", "node").alias("node")).agg(*[F.sum(c).alias(f"_{c}") for c in names]).join(
        marked.select("node", "parent", "top", "_centroid"), "node"
    ).where("node = _centroid OR parent = _centroid").groupBy("top").agg(*[F.sum(f"_{c}").alias(f"_{c}") for c in names])
    done = write_shared(placed.join(below, "top").select(
        "node", "parent", *names, F.col("up").alias("top"),
        F.when(F.col("path"), F.col("size") - F.col("_lost")).otherwise(F.col("size")).alias("size"),
        *[F.when(F.col("path"), F.col(s) + F.col(f"_{c}")).otherwise(F.col(s)).alias(s) for s, c in zip(sums, names)],
    ), "trie-cut")
    return done.where("top IS NOT NULL"), done.where("top IS NULL").select("node", *sums)


def rollup(forest: DataFrame, names: list[str], block: int = BLOCK) -> DataFrame:
    """(node, sum_<name>...) with the sum of each long column of ``names`` over the subtree of
    each node, itself included.

    ``forest`` has one row per node: ``node`` (long, unique), ``parent`` (long, null or the node
    itself at a top) and the columns to sum, where null counts as 0. Other columns are ignored.
    """
    names = list(names)
    rows = forest.select("node", F.nullif("parent", "node").alias("parent"), *[
        F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in names])
    live = _sized(rows, names).withColumns({f"sum_{c}": F.lit(0).cast("long") for c in names})
    finished, ready = [], []
    while True:
        big = live.where((F.col("node") == F.col("top")) & (F.col("size") > block)).select(
            "top", F.col("size").alias("whole"))
        if big.isEmpty():
            ready.append(live)
            break
        big = write_shared(big, "trie-big")
        ready.append(live.join(big, "top", "left_anti"))  # small enough, and not looked at again here
        live, centroids = _cut_once(live, big, names)
        finished.append(centroids)
    types = "node long, " + ", ".join(f"sum_{c} long" for c in names)
    columns = ["node", "parent", "top", "size", *names, *[f"sum_{c}" for c in names]]
    small = reduce(DataFrame.unionByName, [part.select(columns) for part in ready])
    local = small.repartition("top").sortWithinPartitions("top").mapInArrow(partial(_blocks, names=names), types)
    for part in finished:
        local = local.unionByName(part)
    return local


# --- the trie ----------------------------------------------------------------------------------

ROOT = b""
MEMBERS = "conv_id long, depth long, key binary, parent_key binary, n_bytes long, is_end boolean"
_MEMBER_TYPE = pa.schema([("conv_id", pa.int64()), ("depth", pa.int64()), ("key", pa.binary()),
                          ("parent_key", pa.binary()), ("n_bytes", pa.int64()), ("is_end", pa.bool_())])


def next_key(key: bytes, role: str, text: str) -> tuple[bytes, int]:
    """The key of a prefix with one turn more, a digest of all its turns, and the text's bytes."""
    role, text = role.encode("utf-8", "surrogatepass"), text.encode("utf-8", "surrogatepass")
    return hashlib.sha256(key + b"%d:" % len(role) + role + text).digest(), len(text)


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Prefixes of the rebuilt conversations. Rows are sorted by base, conversation and turn, the
    base's own rows first; of the turns of a base only the first eight are held."""
    rows: list[tuple] = []
    conv = base = longest = None
    head: list[tuple[str, str]] = []

    def step(role: str, text: str) -> None:
        nonlocal longest
        rows.append((*longest, False))
        key, size = next_key(longest[2], role, text)
        longest = (conv, longest[1] + 1, key, longest[2], size)

    for batch in batches:
        for b, c, h, role, text in zip(*[column.to_pylist() for column in batch.columns]):
            if c != conv:
                if longest:
                    rows.append((*longest, True))
                if b != base:
                    base, head = b, []
                conv, seen, longest = c, 0, (c, 0, ROOT, None, 0)
                if c != b:
                    for turn in head[:h]:
                        step(*turn)
            seen += 1
            if c == b:  # with its own first turns in front a base stays as it is
                if len(head) < MOST_SHARED:
                    head.append((role, text))
                step(role, text)
            elif seen > h:
                step(role, text)
        if len(rows) >= 5000:
            yield _record(rows, _MEMBER_TYPE)
            rows = []
    if longest:
        rows.append((*longest, True))
    yield _record(rows, _MEMBER_TYPE)


def _record(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * len(schema), schema)], schema=schema)


def prefixes(conversations: DataFrame, every: int = 5) -> DataFrame:
    """A row for each conversation and each number of first turns of its rebuilt form.

    Conversation c borrows its first turns from c - c % ``every``; how many (0 to 8) follows from
    a checksum of its id.
    """
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    dealt = turns.select(
        (F.col("conv_id") - F.col("conv_id") % every).alias("base"), "conv_id",
        (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (MOST_SHARED + 1)).alias("shared"), "turn", "role", "text")
    return dealt.repartition("base").sortWithinPartitions(
        "base", F.col("conv_id") != F.col("base"), "conv_id", F.col("turn").asc_nulls_first(), "role", "text",
    ).select("base", "conv_id", "shared", "role", "text").mapInArrow(_members, MEMBERS)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest per key over its links in order; only the state of the digest is held."""
    schema = pa.schema([("key", pa.binary()), ("ends_sha256", pa.string())])
    here, digest, out = None, None, []
    for batch in batches:
        for key, ids in zip(batch["key"].to_pylist(), batch["ids"].to_pylist()):
            if key != here:
                if digest:
                    out.append((here, digest.hexdigest()))
                here, digest = key, hashlib.sha256(ids.encode())
            else:
                digest.update(f",{ids}".encode())
        yield _record(out, schema)
        out = []
    if digest:
        yield _record([(here, digest.hexdigest())], schema)


def ends(members: DataFrame) -> DataFrame:
    """key and the digest of the ids of all conversations that end there. Ids are first joined in
    links of neighbouring ids, so a node where very many end still means few rows and no list."""
    links = members.where("is_end").groupBy("key", F.shiftright("conv_id", ID_BITS).alias("link")).agg(
        F.array_join(F.sort_array(F.collect_list("conv_id")), ",").alias("ids"))
    return links.repartition("key").sortWithinPartitions("key", "link").select("key", "ids").mapInArrow(
        _digests, "key binary, ends_sha256 string")


def prefix_trie(conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per node of the trie of rebuilt conversations: conv_id (the smallest member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Columns conv_id, turn, role and text are read. Null roles and texts are empty; null turns come
    first, turns with one number by role, then text; rows without a conv_id are left out. An empty
    table has no nodes, not even a root.
    """
    members = write_shared(prefixes(conversations), "trie-members")
    grouped = members.groupBy("depth", "key").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"),
        F.min("parent_key").alias("parent_key"), F.max("n_bytes").alias("n_bytes"))
    # Written, so that the numbers stay whatever task is repeated later.
    nodes = write_shared(grouped.withColumn("node", F.monotonically_increasing_id()), "trie-nodes")
    above = nodes.select(
        F.col("key").alias("parent_key"), F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    edges = nodes.join(above, "parent_key", "left")
    children = edges.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    trie = write_shared(edges.join(children, "node", "left").select(
        "node", "parent", "key", "conv_id", "depth", "parent_conv_id", "n_convs",
        F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        F.col("n_children").isNull().cast("long").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved")), "trie")
    sums = rollup(trie, ["leaves", "saved"], block)
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return trie.join(sums, "node").join(ends(members), "key", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("sum_leaves").alias("n_leaves"),
        F.col("sum_saved").alias("saved_tokens"), F.coalesce("ends_sha256", nothing).alias("ends_sha256"))
