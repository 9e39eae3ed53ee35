"""Near-duplicate vectors by NN-descent: a neighbour graph refined through neighbours of neighbours."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import connected_components, forget, map_arrow, stored

THRESHOLD = 0.9
#: Neighbours per list to begin with, and the most that a saturated list may grow to before exact blocks take over.
LIST, LONGEST_LIST = 10, 64
#: Random-hyperplane orders that the first graph comes from, and the vectors compared with each other in each.
ORDERS, LEAF = 6, 128
ROUNDS = 10
#: Vectors that the audit compares with all others, and the share of their links that the graph must hold.
AUDIT, RECALL = 512, 0.995
BLOCK = 512
SEED = 7


def near_vectors(df: DataFrame, *, threshold: float = THRESHOLD, rounds: int = ROUNDS, audit: int = AUDIT, recall: float = RECALL) -> DataFrame:
    """Links between vectors whose cosine (double precision) is at least ``threshold``; one row per input row.

    Columns: ``vec_id``, ``n_links`` (other vectors linked directly), ``component_id`` (smallest ``vec_id`` reachable), ``kept``.
    Needs ``vec_id`` and ``embedding``. Vectors that are NULL, empty, zero or hold NULL or non-finite components, and rows with a NULL
    ``vec_id``, link with nothing: 0 links, their own component, kept. Equal vectors are one node of the graph with a
    multiplicity and link with each other. Vectors of different lengths never link. Repeated rows count as vectors of their own
    and are all kept if one is. An empty table gives an empty result.
    """
    rows = df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    usable = F.col("vec_id").isNotNull() & F.coalesce(finite & F.exists("v", lambda x: x != 0), F.lit(False))
    rows = rows.withColumn("usable", usable)
    # Adding 0 makes -0 and 0 the same array.
    nodes = rows.where("usable").groupBy(F.transform("v", lambda x: x + 0.0).alias("v"))
    nodes = nodes.agg(F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
    nodes = stored(nodes.withColumn("node", F.monotonically_increasing_id()).withColumn("dims", F.size("v")), "vectors-distinct")
    single = df.schema["embedding"].dataType.simpleString() == "array<float>"
    found = None
    for dims in sorted(r["dims"] for r in nodes.select("dims").distinct().collect()):
        counts = _graph(nodes.where(F.col("dims") == dims), dims, threshold, rounds, audit, recall, single)
        found = counts if found is None else found.unionByName(counts)
    alone = rows.where(~F.col("usable")).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    if found is None:
        return alone.withColumn("kept", F.lit(True))
    named = stored(
        nodes.join(found, "node", "left").select(
            F.col("v").alias("w"),
            (F.coalesce("near", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links"),
            F.coalesce("component_id", "first_id").alias("component_id"),
        ),
        "vectors-named",
    )
    linked = rows.where("usable").withColumn("w", F.transform("v", lambda x: x + 0.0)).join(named, "w")
    linked = linked.select("vec_id", "n_links", "component_id").unionByName(alone)
    return linked.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _graph(nodes: DataFrame, dims: int, threshold: float, rounds: int, audit: int, recall: float, single: bool) -> DataFrame:
    """(``node``, ``near``: linked vectors with multiplicity, ``component_id``) of the nodes that have links."""
    total = nodes.count()
    size = LIST
    nodes = nodes.select("node", "v", "copies", "first_id")
    graph = stored(_lists(_first_candidates(nodes, dims, total, size, single).withColumn("age", F.lit(0)), size, threshold), "vectors-graph")
    links_before, quiet, passed = -1, 0, False
    for turn in range(1, rounds + 1):
        if turn > 2 and quiet:
            missing, share = _audited(nodes, graph, dims, audit, threshold, turn)
            if share >= recall and missing.isEmpty():
                passed = True
                break
            # The audit missed links: they enter the graph, every list grows and all of them join again.
            size = min(2 * size, LONGEST_LIST)
            graph = _lists(graph.unionByName(missing.withColumn("age", F.lit(turn))), size, threshold)
            graph = stored(graph.withColumn("age", F.lit(turn)), "vectors-graph")
            quiet = 0
        candidates = _neighbours_of_neighbours(nodes, graph, dims, size, turn, threshold, single)
        merged = graph.unionByName(candidates.withColumn("age", F.lit(turn)))
        refined = stored(_lists(merged, size, threshold), "vectors-graph")
        links = refined.where(F.col("sim") >= threshold).count()
        forget(graph)
        graph, quiet, links_before = refined, links == links_before, links
    links = graph.where(F.col("sim") >= threshold).select(F.col("node").alias("a"), F.col("other").alias("b"))
    links = stored(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "vectors-links")
    roots = stored(connected_components(links, "vectors"), "vectors-roots")
    near = links.join(nodes.select(F.col("node").alias("b"), "copies"), "b").groupBy(F.col("a").alias("node")).agg(
        F.sum("copies").alias("near"), F.count(F.lit(1)).alias("listed")
    )
    near = stored(near, "vectors-near")
    # Lists that links fill to the last place may end too early: their nodes meet all vectors, and so does every node
    # if no audit passed.
    full = near.where(F.col("listed") >= LONGEST_LIST).select("node") if passed else nodes.select("node")
    met, roots = _compared_with_all(full, nodes, roots, dims, threshold)
    first = roots.join(nodes.select("node", "first_id"), "node").groupBy("root").agg(F.min("first_id").alias("component_id"))
    # The components that they lie in are counted exactly, block by block, and so are components of one block, where
    # counting costs no more than reading.
    dense = roots.join(full, "node").select("root") if passed else roots.select("root").limit(0)
    small = roots.groupBy("root").count().where((F.col("count") > 2) & (F.col("count") <= BLOCK)).select("root")
    dense = stored(roots.join(dense.unionByName(small).distinct(), "root"), "vectors-dense")
    exact = _counted_in_blocks(dense, nodes, dims, threshold)
    counts = roots.join(near, "node", "left").join(met, "node", "left").join(exact, "node", "left")
    counts = counts.select("node", "root", F.coalesce("met", "exact", "near").alias("near"))
    return counts.join(first, "root").select("node", "near", "component_id")


def _compared_with_all(some: DataFrame, nodes: DataFrame, roots: DataFrame, dims: int, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Exact counts of ``some`` nodes over all vectors (``node``, ``met``), and ``roots`` merged along all of their links.

    Links stay in the tasks: what leaves them is a count per node and block, and each pair of components that they tie once.
    """
    rows = nodes.select("node", "v", "copies").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    blocks = [max(1, -(-df.count() // (8 * BLOCK))) for df in (some, nodes)]
    place = [F.pmod(F.xxhash64(F.lit(i), "node"), F.lit(n)) for i, n in enumerate(blocks)]
    facing = [F.explode(F.sequence(F.lit(0), F.lit(n - 1))) for n in blocks]
    left = rows.join(some, "node").withColumn("own", place[0]).withColumn("other", facing[1]).withColumn("left", F.lit(True))
    right = rows.withColumn("other", place[1]).withColumn("own", facing[0]).withColumn("left", F.lit(False))
    both = left.unionByName(right).withColumn("pair", F.col("own") * F.lit(blocks[1]) + F.col("other"))
    both = both.select("pair", "left", "node", "root", "copies", "v").repartition("pair").sortWithinPartitions("pair", "node")

    def compared(batches):
        for run in _runs(batches, "pair", ["left", "node", "root", "copies", "v"]):
            side = run["left"].to_numpy(zero_copy_only=False)
            node, root, copies = (run[c].to_numpy() for c in ("node", "root", "copies"))
            vectors, right = unit_rows(_matrix(run["v"], dims)), np.flatnonzero(~side)
            for at in range(0, int(side.sum()), 256):
                mine = np.flatnonzero(side)[at : at + 256]
                near = (vectors[mine] @ vectors[right].T >= threshold) & (node[mine][:, None] != node[right])
                a, b = np.nonzero(near & (root[mine][:, None] != root[right]))
                ties = np.unique(np.stack([root[mine][a], root[right][b]], axis=1), axis=0)
                yield _met(np.zeros(len(mine), dtype=np.int64), node[mine], near @ copies[right])
                yield _met(np.ones(len(ties), dtype=np.int64), ties[:, 0], ties[:, 1])

    found = stored(both.transform(map_arrow, compared, "kind long, x long, y long"), "vectors-met")
    met = found.where("kind = 0").groupBy(F.col("x").alias("node")).agg(F.sum("y").alias("met")).where("met > 0")
    ties = found.where("kind = 1").select(F.col("x").alias("a"), F.col("y").alias("b"))
    if ties.isEmpty():
        return met, roots
    merged = stored(connected_components(ties, "vectors-ties").withColumnRenamed("root", "whole"), "vectors-merged")
    lone = merged.select("node").join(roots.select("node"), "node", "left_anti").select("node", F.col("node").alias("root"))
    every = roots.unionByName(lone).join(merged.withColumnRenamed("node", "root"), "root", "left")
    return met, stored(every.select("node", F.coalesce("whole", "root").alias("root")), "vectors-roots")


def _met(kind: np.ndarray, x: np.ndarray, y: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in (kind, x, y)], names=["kind", "x", "y"])


def _lists(edges: DataFrame, size: int, threshold: float) -> DataFrame:
    """Each node's list: its nearest ``size``, and beyond them as many links as the longest list holds."""
    edges = edges.groupBy("node", "other").agg(F.max("sim").alias("sim"), F.min("age").alias("age"))
    order = Window.partitionBy("node").orderBy(F.desc("sim"), "other")
    edges = edges.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= LONGEST_LIST)
    return edges.where((F.col("rank") <= size) | (F.col("sim") >= threshold)).select("node", "other", "sim", "age")


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    flat = column.flatten() if isinstance(column, (pa.ListArray, pa.LargeListArray)) else column.combine_chunks().flatten()
    return flat.to_numpy(zero_copy_only=False).reshape(-1, dims)


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled first, so that huge and tiny components neither overflow nor vanish."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _edges(a, b, sim) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(sim, pa.float64())], names=["node", "other", "sim"])


def _narrow(single: bool):
    """Vectors of a float table travel as floats, which loses nothing; others stay doubles."""
    return F.transform("v", lambda x: x.cast("float")).alias("v") if single else F.col("v")


EDGES = "node long, other long, sim double"


def _runs(batches, key: str, columns: list[str], most: int | None = None) -> Iterator[dict[str, pa.Array]]:
    """Consecutive rows with the same key of a sorted partition, as Arrow arrays; cut into runs of ``most`` rows."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        table = pa.Table.from_batches(held).combine_chunks()
        keys = table.column(key).to_numpy()
        edges = np.flatnonzero(np.diff(keys)) + 1
        bounds = [0, *edges.tolist()]
        for begin, end in zip(bounds, bounds[1:], strict=False):
            yield from _cut(table, begin, end, columns, most)
        rest = table.slice(bounds[-1])
        if most and rest.num_rows > most:
            yield from _cut(rest, 0, rest.num_rows // most * most, columns, most)
            rest = rest.slice(rest.num_rows // most * most)
        held = rest.to_batches()
    if held:
        table = pa.Table.from_batches(held).combine_chunks()
        yield from _cut(table, 0, table.num_rows, columns, most)


def _cut(table: pa.Table, begin: int, end: int, columns: list[str], most: int | None):
    step = most or max(1, end - begin)
    for at in range(begin, end, step):
        part = table.slice(at, min(step, end - at))
        yield {c: part.column(c).combine_chunks() for c in columns}


def _first_candidates(nodes: DataFrame, dims: int, total: int, size: int, single: bool) -> DataFrame:
    """Nearest vectors within small cells of random hyperplanes, several times over."""
    bits = max(1, min(60, int(np.ceil(np.log2(max(2, total / LEAF))))))
    planes = np.random.default_rng(SEED).standard_normal((ORDERS * bits, dims))
    weights = (1 << np.arange(bits, dtype=np.int64))

    def coded(batches):
        for batch in batches:
            signs = (_matrix(batch.column("v"), dims) @ planes.T > 0).reshape(batch.num_rows, ORDERS, bits)
            codes = signs.astype(np.int64) @ weights
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array(codes.tolist(), pa.list_(pa.int64())), batch.column("v")], names=["node", "codes", "v"]
            )

    cells = nodes.select("node", "v").transform(map_arrow, coded, "node long, codes array<long>, v array<double>")
    cells = cells.select("node", F.posexplode("codes").alias("turn", "code"), _narrow(single))
    # A cell that holds many vectors is dealt out at random in parts of a few leaves: parts, not the cell, are compared.
    cells = cells.withColumn("cell", F.xxhash64("turn", "code")).withColumn("part", F.xxhash64("node", "turn"))
    counts = stored(cells.groupBy("cell").count().where(F.col("count") > 4 * LEAF).select("cell", F.col("count").alias("many")), "vectors-cells")
    cells = cells.join(counts, "cell", "left")
    share = F.pmod("part", F.ceil(F.col("many") / (2 * LEAF)))
    cells = cells.select(F.xxhash64("cell", F.coalesce(share, F.lit(0))).alias("cell"), "node", "v")
    cells = cells.repartition("cell").sortWithinPartitions("cell", "node")

    def nearest(batches):
        for run in _runs(batches, "cell", ["node", "v"], most=4 * LEAF):
            ids, vectors = run["node"].to_numpy(), unit_rows(_matrix(run["v"], dims).astype(np.float64))
            if len(ids) < 2:
                continue
            sims = vectors @ vectors.T
            np.fill_diagonal(sims, -2)
            k = min(size, len(ids) - 1)
            best = np.argpartition(-sims, k - 1, axis=1)[:, :k]
            a = np.repeat(np.arange(len(ids)), k)
            yield _edges(ids[a], ids[best.reshape(-1)], sims[a, best.reshape(-1)])

    return cells.transform(map_arrow, nearest, EDGES)


def _neighbours_of_neighbours(nodes: DataFrame, graph: DataFrame, dims: int, size: int, turn: int, threshold: float, single: bool) -> DataFrame:
    """Pairs that meet in some node's list, at least one of them new there, and that improve a list or are links."""
    # Lists run both ways; of the nodes that point to a popular one the nearest few take part, the others meet it elsewhere.
    back = graph.select(F.col("other").alias("node"), F.col("node").alias("other"), "sim", "age")
    order = Window.partitionBy("node").orderBy(F.desc("sim"), "other")
    back = back.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size).drop("rank")
    ahead = graph.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= 2 * size).drop("rank")
    members = ahead.unionByName(back).groupBy("node", "other").agg(F.max("age").alias("age"))
    lowest = graph.groupBy("node").agg(F.min("sim").alias("least"), F.count(F.lit(1)).alias("n"))
    lowest = lowest.select(F.col("node").alias("other"), F.when(F.col("n") >= size, F.col("least")).otherwise(-2.0).alias("least"))
    vectors = nodes.select(F.col("node").alias("other"), _narrow(single))
    members = members.join(lowest, "other", "left").join(vectors, "other")
    members = members.select("node", "other", (F.col("age") >= turn - 1).alias("fresh"), F.coalesce("least", F.lit(-2.0)).alias("least"), "v")
    members = members.repartition("node").sortWithinPartitions("node", "other")

    def joined(batches):
        for run in _runs(batches, "node", ["other", "fresh", "least", "v"]):
            ids = run["other"].to_numpy()
            fresh = run["fresh"].to_numpy(zero_copy_only=False)
            if len(ids) < 2 or not fresh.any():
                continue
            vectors, least = unit_rows(_matrix(run["v"], dims).astype(np.float64)), run["least"].to_numpy()
            sims = vectors @ vectors.T
            np.fill_diagonal(sims, -3)
            a, b = np.nonzero(((sims > least[:, None]) | (sims >= threshold)) & (fresh[:, None] | fresh[None, :]))
            if len(a):
                yield _edges(ids[a], ids[b], sims[a, b])

    # What several nodes propose is one candidate.
    return members.transform(map_arrow, joined, EDGES).groupBy("node", "other").agg(F.max("sim").alias("sim"))


def _audited(nodes: DataFrame, graph: DataFrame, dims: int, audit: int, threshold: float, turn: int) -> tuple[DataFrame, float]:
    """Links of a bounded random set of vectors that the graph lacks, and the share of their links that it holds."""
    chosen = nodes.orderBy(F.xxhash64(F.lit(SEED), F.lit(turn), "node")).limit(audit).select("node", "v").collect()
    ids = np.array([r["node"] for r in chosen], dtype=np.int64)
    queries = unit_rows(np.array([r["v"] for r in chosen], dtype=np.float64).reshape(-1, dims))

    def compared(batches):
        for batch in batches:
            own = batch.column("node").to_numpy()
            sims = unit_rows(_matrix(batch.column("v"), dims)) @ queries.T
            a, b = np.nonzero(sims >= threshold)
            other = own[a] != ids[b]
            yield _edges(ids[b][other], own[a][other], sims[a, b][other])

    links = stored(nodes.select("node", "v").transform(map_arrow, compared, EDGES), "vectors-audit")
    reversed_ = graph.select(F.col("other").alias("node"), F.col("node").alias("other"))
    known = graph.select("node", "other").unionByName(reversed_)
    # Nodes with full lists are compared with all vectors later on: what their lists lack is no fault of the graph.
    full = graph.where(F.col("sim") >= threshold).groupBy("node").count().where(F.col("count") >= LONGEST_LIST).select("node")
    open_links = links.join(full, "node", "left_anti")
    missing = stored(open_links.join(known, ["node", "other"], "left_anti"), "vectors-missing")
    every, lacks = open_links.count(), missing.count()
    return missing, 1.0 if every == 0 else 1 - lacks / every


def _counted_in_blocks(members: DataFrame, nodes: DataFrame, dims: int, threshold: float) -> DataFrame:
    """Exact number of linked vectors of each node within its component: all pairs of blocks, counts only."""
    sizes = members.groupBy("root").count().select("root", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks"))
    rows = members.join(nodes.select("node", "v", "copies"), "node").join(sizes, "root")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("facing", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select(
        F.xxhash64("root", F.least("block", "facing"), F.greatest("block", "facing")).alias("pair"),
        (F.col("block") <= F.col("facing")).alias("left"), "root", "block", "facing", "node", "copies", "v",
    )
    rows = rows.repartition("pair").sortWithinPartitions("pair", "node")

    def counted(batches):
        columns = ["root", "block", "facing", "node", "copies", "v"]
        for run in _runs(batches, "pair", columns):
            root, block, facing, node, copies = (run[c].to_numpy() for c in columns[:5])
            vectors = unit_rows(_matrix(run["v"], dims))
            key = np.stack([root, np.minimum(block, facing), np.maximum(block, facing)], axis=1)
            for one in np.unique(key, axis=0):  # a single one, but for equal hashes
                mine = np.flatnonzero((key == one).all(axis=1))
                left, right = mine[block[mine] == one[1]], mine[block[mine] == one[2]]
                near = vectors[left] @ vectors[right].T >= threshold
                if one[1] == one[2]:
                    np.fill_diagonal(near, False)
                    yield _counts(node[left], near @ copies[right])
                else:
                    yield _counts(node[left], near @ copies[right])
                    yield _counts(node[right], near.T @ copies[left])

    parts = rows.transform(map_arrow, counted, "node long, exact long")
    return parts.groupBy("node").agg(F.sum("exact").alias("exact"))


def _counts(node: np.ndarray, exact: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(exact.astype(np.int64))], names=["node", "exact"])
