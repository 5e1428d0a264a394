"""Nearest neighbours by largest inner product: a hierarchical k-means tree searched best bin first.

1. Equal vectors are one class. No more than its `k + 1` smallest ids can ever be among the nearest k of a query.
2. A vector gets one more entry that fills its length up to the longest one; then the largest inner product is the smallest
   distance. The tree of centres is fitted on a bounded sample (`sample_rows` for the top, as many again for each leaf that is
   still too large, in Spark tasks) and holds at most `max_nodes` nodes, so what is broadcast has a bound.
3. Every class is sent down to its leaf. Leaves that follow each other make shards of about `shard_rows` classes; a leaf that
   is larger is cut into pieces, each in a shard of its own.
4. A query takes the tree's nodes from a priority queue, nearest first, until it has met `visits` leaves. `visits` is widened
   on `probes` calibration queries, whose nearest rows are found by brute force over all rows, until the target recall is
   reached; at the latest when all leaves are visited, and the search is exact.
5. Blocks of queries meet the shards with their leaves. A query is sent once to each shard it visits, with the leaves it wants
   there. Scores are formed again on the original vectors, entry by entry, so that they do not depend on the blocks.

What meets in one task is one shard (or piece) and one block of queries, both bounded by parameters.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import opened, share
from tidewatch.llm.vectors import is_finite, longest, matrix, padded
from tidewatch.session import pinned

OUT_SCHEMA = "query_id long, rank int, vec_id long, score double"
FOUND_SCHEMA = "query long, query_id long, vec_id long, score double, leaf int"


@dataclass
class Tree:
    """Nodes in arrays; the children of a node lie together. Node 0 is the root, `leaf` is -1 for an inner node."""
    centres: np.ndarray
    first: np.ndarray
    children: np.ndarray
    leaf: np.ndarray

    @property
    def leaves(self) -> int:
        return int(self.leaf.max()) + 1

    def closeness(self, points: np.ndarray, node: int) -> np.ndarray:
        """For points and each child of a node: larger is nearer (the squared distance without the point's own part)."""
        centres = self.centres[self.first[node]:self.first[node] + self.children[node]].astype(np.float64)
        return points @ centres.T - 0.5 * (centres * centres).sum(axis=1)

    def placed(self, points: np.ndarray) -> np.ndarray:
        """The leaf of each point: always on to the nearest child."""
        out, open_nodes = np.zeros(len(points), dtype=np.int32), [(0, np.arange(len(points)))]
        while open_nodes:
            node, rows = open_nodes.pop()
            if self.leaf[node] >= 0:
                out[rows] = self.leaf[node]
                continue
            nearest = self.closeness(points[rows], node).argmax(axis=1)
            for child in np.unique(nearest):
                open_nodes.append((self.first[node] + int(child), rows[nearest == child]))
        return out

    def best_bins(self, point: np.ndarray, visits: int) -> list[int]:
        """The first `visits` leaves that a priority queue of nodes gives, nearest first."""
        queue, met = [(0.0, 0)], []
        while queue and len(met) < visits:
            _, node = heapq.heappop(queue)
            if self.leaf[node] >= 0:
                met.append(int(self.leaf[node]))
                continue
            first = int(self.first[node])
            for child, near in enumerate(self.closeness(point, node).tolist()):
                heapq.heappush(queue, (-near, first + child))
        return met


def _centres(points: np.ndarray, branches: int, rng, rounds: int = 8) -> np.ndarray:
    """Lloyd's rounds from distinct rows of the sample; a centre that loses all its points stays where it is."""
    centres = points[rng.choice(len(points), branches, replace=False)].copy()
    for _ in range(rounds):
        nearest = (points @ centres.T - 0.5 * (centres * centres).sum(axis=1)).argmax(axis=1)
        sizes = np.bincount(nearest, minlength=branches)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, points)
        centres[sizes > 0] = sums[sizes > 0] / sizes[sizes > 0, None]
    return centres


def grown(points: np.ndarray, weight: float, leaf_rows: int, branches: int, nodes: int, seed: int) -> Tree:
    """A tree over a sample, each row of which stands for `weight` rows: split until leaves stand for `leaf_rows`.

    The largest part is split first, and at most `nodes` nodes are made. Parts of equal points are not split.
    """
    rng = np.random.default_rng(seed)
    centres, first, children, parts = [points.mean(axis=0)], [0], [0], {0: points}
    order = [(-len(points), 0)]
    while order and len(centres) + branches <= nodes:
        size, node = heapq.heappop(order)
        part, ways = parts[node], min(branches, len(parts[node]) // 4)
        if -size * weight <= leaf_rows or ways < 2:
            continue
        found = _centres(part, ways, rng)
        nearest = (part @ found.T - 0.5 * (found * found).sum(axis=1)).argmax(axis=1)
        used = np.unique(nearest)
        if len(used) < 2:
            continue
        first[node], children[node] = len(centres), len(used)
        del parts[node]
        for way in used:
            at, inside = len(centres), part[nearest == way]
            centres.append(found[way])
            first.append(0)
            children.append(0)
            parts[at] = inside
            heapq.heappush(order, (-len(inside), at))
    return Tree(np.array(centres, dtype=np.float32), np.array(first), np.array(children), np.zeros(0, dtype=int))


def _numbered(tree: Tree) -> Tree:
    """Leaves numbered from left to right, so that near leaves have near numbers."""
    leaf, stack, n = np.full(len(tree.first), -1), [0], 0
    while stack:
        node = stack.pop()
        if tree.children[node]:
            stack.extend(range(tree.first[node] + tree.children[node] - 1, tree.first[node] - 1, -1))
        else:
            leaf[node], n = n, n + 1
    return Tree(tree.centres, tree.first, tree.children, leaf)


def _grafted(tree: Tree, below: dict[int, Tree]) -> Tree:
    """The tree with subtrees in the place of some leaves."""
    centres, first, children = [tree.centres], [tree.first.copy()], [tree.children.copy()]
    size = len(tree.first)
    for node in np.flatnonzero(tree.leaf >= 0):
        sub = below.get(int(tree.leaf[node]))
        if sub is None or not sub.children[0]:
            continue
        # the root of the subtree is the leaf itself, so its other nodes move up by one
        first[0][node], children[0][node] = size + sub.first[0] - 1, sub.children[0]
        centres.append(sub.centres[1:])
        first.append(np.where(sub.children[1:] > 0, sub.first[1:] + size - 1, 0))
        children.append(sub.children[1:])
        size += len(sub.first) - 1
    return _numbered(Tree(np.concatenate(centres), np.concatenate(first), np.concatenate(children), tree.leaf))


def _lengthened(points: np.ndarray, longest_square: float) -> np.ndarray:
    """Points with the entry that makes all of them equally long."""
    rest = np.sqrt(np.maximum(longest_square - (points * points).sum(axis=1), 0.0))
    return np.column_stack([points, rest])


def _asked(points: np.ndarray, longest_square: float) -> np.ndarray:
    """Queries as points: in the same direction, as long as the longest vector, with nothing in the added entry."""
    norms = np.sqrt((points * points).sum(axis=1))
    scale = np.divide(np.sqrt(longest_square), norms, out=np.ones_like(norms), where=(norms > 0) & np.isfinite(norms))
    return np.column_stack([points * scale[:, None], np.zeros(len(points))])


def _floats(column: pa.Array, dim: int) -> np.ndarray:
    return matrix(column, dim).astype(np.float64)


def _place(shared, dim: int):
    def place(batches):
        tree, square = opened(shared)
        for batch in batches:
            leaves = tree.placed(_lengthened(_floats(batch.column(2), dim), square))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaves, pa.int32())], ["rep", "ids", "v", "leaf"])
    return place


def _visit(shared, dim: int, visits: int):
    def visit(batches):
        tree, square = opened(shared)
        for batch in batches:
            points = _asked(_floats(batch.column(2), dim), square)
            leaves = [tree.best_bins(point, visits) for point in points]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaves, pa.list_(pa.int32()))],
                                             ["query", "query_id", "v", "leaves"])
    return visit


def _refine(shared, dim: int, weights, leaf_rows: int, branches: int, nodes: int):
    def refine(table):
        square, leaf = opened(shared), table.column("leaf")[0].as_py()
        points = _lengthened(_floats(table.column("v").combine_chunks(), dim), square)
        tree = grown(points, weights[leaf] / len(points), leaf_rows, branches, nodes, seed=leaf)
        return pa.table({"leaf": pa.array([leaf], pa.int32()), "centres": pa.array([tree.centres.tobytes()], pa.binary()),
                         "first": pa.array([tree.first.tolist()], pa.list_(pa.int64())),
                         "children": pa.array([tree.children.tolist()], pa.list_(pa.int64()))})
    return refine


def _best(queries: np.ndarray, points: np.ndarray, reps: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, point, score) of the k best points of each query, ties to the smaller representative.

    One product proposes; all that come within its rounding of the k-th are scored again entry by entry.
    """
    proposed = queries @ points.T
    least = np.full(len(queries), -np.inf)
    if len(points) > k:
        slack = 1e-12 * np.sqrt((queries * queries).sum(axis=1)) * np.sqrt((points * points).sum(axis=1).max())
        least = np.partition(proposed, len(points) - k, axis=1)[:, len(points) - k] - slack
    q, p = np.nonzero(~(proposed < least[:, None]))  # a product that is not a number is looked at
    score = (queries[q] * points[p]).sum(axis=1)
    order = np.lexsort((reps[p], -score, q))
    q, p, score = q[order], p[order], score[order]
    place = np.arange(len(q)) - np.searchsorted(q, q)
    return q[place < k], p[place < k], score[place < k]


def _expanded(q, p, score, ids: pa.Array, leaves: np.ndarray, query: np.ndarray, query_id: np.ndarray, k: int) -> pa.RecordBatch:
    """The ids of the classes found, without the query's own, at most k for each query."""
    lengths = pc.list_value_length(ids).to_numpy(zero_copy_only=False)
    starts, flat = np.concatenate([[0], np.cumsum(lengths)]), pc.list_flatten(ids).to_numpy(zero_copy_only=False)
    times = lengths[p]
    at = np.repeat(np.arange(len(p)), times)
    found = flat[starts[p][at] + np.arange(len(at)) - np.repeat(np.cumsum(times) - times, times)]
    other = found != query_id[q[at]]
    at, found = at[other], found[other]
    order = np.lexsort((found, -score[at], q[at]))
    at, found = at[order], found[order]
    place = np.arange(len(at)) - np.searchsorted(q[at], q[at])
    at, found = at[place < k], found[place < k]
    return pa.RecordBatch.from_pydict({
        "query": pa.array(query[q[at]], pa.int64()), "query_id": pa.array(query_id[q[at]], pa.int64()),
        "vec_id": pa.array(found, pa.int64()), "score": pa.array(score[at], pa.float64()),
        "leaf": pa.array(leaves[p[at]], pa.int32())})


def _brute(shared, dim: int, k: int):
    """The nearest rows among those of a task, for a bounded number of queries."""
    def brute(batches):
        query, query_id, points = opened(shared)
        for batch in batches:
            reps, v = batch.column(0).to_numpy(), _floats(batch.column(2), dim)
            leaves = batch.column(3).to_numpy()
            for low in range(0, len(v), 4096):
                part = slice(low, low + 4096)
                q, p, score = _best(points, v[part], reps[part], k + 1)
                yield _expanded(q, p, score, batch.column(1).slice(low, 4096), leaves[part], query, query_id, k)
    return brute


def _search(dim: int, k: int):
    """One shard against one block of queries, leaf by leaf."""
    def search(queries: pa.Table, rows: pa.Table) -> pa.Table:
        out = []
        if queries.num_rows and rows.num_rows:
            query, query_id = queries.column("query").to_numpy(), queries.column("query_id").to_numpy()
            asked = _floats(queries.column("v").combine_chunks(), dim)
            wanted = queries.column("leaves").combine_chunks()
            by = np.repeat(np.arange(len(query)), pc.list_value_length(wanted).to_numpy(zero_copy_only=False))
            leaf_of = pc.list_flatten(wanted).to_numpy(zero_copy_only=False)
            order = np.argsort(leaf_of, kind="stable")
            by, leaf_of = by[order], leaf_of[order]
            rows = rows.sort_by("leaf")
            leaves, reps = rows.column("leaf").to_numpy(), rows.column("rep").to_numpy()
            points, ids = _floats(rows.column("v").combine_chunks(), dim), rows.column("ids").combine_chunks()
            found = []
            for leaf in np.unique(leaves):
                low, high = np.searchsorted(leaves, [leaf, leaf + 1])
                mine = by[slice(*np.searchsorted(leaf_of, [leaf, leaf + 1]))]
                for start in range(0, len(mine), 1024):
                    some = mine[start:start + 1024]
                    q, p, score = _best(asked[some], points[low:high], reps[low:high], k + 1)
                    found.append((some[q], p + low, score))
            if found:
                q, p, score = (np.concatenate(parts) for parts in zip(*found, strict=True))
                order = np.lexsort((reps[p], -score, q))
                q, p, score = q[order], p[order], score[order]
                keep = np.arange(len(q)) - np.searchsorted(q, q) <= k
                out.append(_expanded(q[keep], p[keep], score[keep], ids, leaves, query, query_id, k))
        return pa.Table.from_batches(out, pa.schema([("query", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()),
                                                     ("score", pa.float64()), ("leaf", pa.int32())]))
    return search


@dataclass
class Calibration:
    """Leaves to visit, the recall this gave on the calibration queries, and the leaves there are."""
    visits: int
    recall: float
    leaves: int


class Index:
    """Classes of equal vectors in the leaves of a tree."""

    def __init__(self, rows: DataFrame, dim: int, k: int, leaf_rows: int, branches: int, sample_rows: int, max_nodes: int):
        spark = rows.sparkSession
        self.dim, self.k = dim, k
        same = Window.partitionBy("hash", "v")
        ranked = rows.withColumn("place", F.dense_rank().over(same.orderBy("vec_id"))).where(F.col("place") <= k + 1)
        classes = pinned(ranked.groupBy("hash", "v").agg(F.sort_array(F.collect_set("vec_id")).alias("ids"))
                         .select(F.element_at("ids", 1).alias("rep"), "ids", "v", "hash"))
        squares = F.aggregate("v", F.lit(0.0), lambda total, c: total + c.cast("double") * c.cast("double"))
        stats = classes.agg(F.count("*").alias("n"), F.max(squares).alias("square")).first()
        self.n, self.square = stats.n, stats.square
        drawn = self._drawn(classes, sample_rows, self.n)
        top = _lengthened(_floats(drawn, dim), self.square)
        self.tree = _numbered(grown(top, self.n / len(top), leaf_rows, branches, max_nodes, seed=1))
        placed, sizes = self._placed(classes)
        while True:  # leaves that the sample could not split are split by a sample of their own
            large = {leaf: n for leaf, n in sizes.items() if n > 4 * leaf_rows and self.n > sample_rows}
            room = (max_nodes - len(self.tree.first)) // max(1, len(large))
            if not large or room < branches:
                break
            part = spark.createDataFrame([(leaf, min(1.0, sample_rows / n)) for leaf, n in large.items()], "leaf int, part double")
            sample = (placed.join(F.broadcast(part), "leaf").where(F.pmod("hash", F.lit(1 << 30)) < F.col("part") * (1 << 30))
                      .select("leaf", "v"))
            found = sample.groupBy("leaf").applyInArrow(
                _refine(share(spark, self.square), dim, large, leaf_rows, branches, room),
                "leaf int, centres binary, first array<long>, children array<long>").collect()  # at most max_nodes nodes
            below = {r.leaf: Tree(np.frombuffer(r.centres, np.float32).reshape(-1, dim + 1), np.array(r["first"]),
                                  np.array(r.children), np.zeros(0, dtype=int)) for r in found}
            before, self.tree = self.tree.leaves, _grafted(self.tree, below)
            if self.tree.leaves == before:
                break
            placed, sizes = self._placed(classes)
        self.rows, self.sizes = placed.drop("hash"), sizes

    def _drawn(self, classes: DataFrame, size: int, n: int) -> pa.Array:
        """About `size` vectors, at most twice as many, chosen by hash."""
        part = classes.where(F.pmod("hash", F.lit(1 << 30)) < int((1 << 30) * min(1.0, size / n))).select("v")
        return part.limit(2 * size).toArrow().column(0).combine_chunks()

    def _placed(self, classes: DataFrame) -> tuple[DataFrame, dict[int, int]]:
        """All classes with their leaf, and the size of each leaf (one row for each leaf, at most max_nodes)."""
        shared = share(classes.sparkSession, (self.tree, self.square))
        kind = dict(classes.dtypes)["v"]
        placed = pinned(classes.select("rep", "ids", "v").mapInArrow(
            _place(shared, self.dim), f"rep long, ids array<long>, v {kind}, leaf int").withColumn("hash", F.xxhash64("v")))
        return placed, {r.leaf: r["count"] for r in placed.groupBy("leaf").count().collect()}

    def calibrated(self, queries: DataFrame, probes: int, target: float) -> Calibration:
        """The fewest leaves whose visits find the target share of what brute force over all rows finds."""
        some = queries.orderBy(F.xxhash64("query"), "query").limit(probes).toArrow()
        query, query_id = (some.column(c).to_numpy() for c in ("query", "query_id"))
        points = _floats(some.column("v").combine_chunks(), self.dim)
        shared = share(queries.sparkSession, (query, query_id, points))
        truth = _nearest(self.rows.mapInArrow(_brute(shared, self.dim, self.k), FOUND_SCHEMA), self.k).collect()  # probes * k
        asked, leaves = _asked(points, self.square), self.tree.leaves
        visits = min(32, leaves)
        while True:  # twice as many leaves until they are enough, then the fewest of them
            met = {(row, leaf): place for row, point in zip(query.tolist(), asked, strict=True)
                   for place, leaf in enumerate(self.tree.best_bins(point, visits))}
            places = np.sort([met.get((t.query, t.leaf), leaves) for t in truth])
            wanted = max(1, int(np.ceil(target * len(places))))
            if visits == leaves or not len(places) or places[wanted - 1] < visits:
                break
            visits = min(leaves, 2 * visits)
        if not len(places):
            return Calibration(1, 1.0, leaves)
        visits = min(visits, int(places[wanted - 1]) + 1)
        return Calibration(visits, float((places < visits).mean()), leaves)

    def search(self, queries: DataFrame, visits: int, shard_rows: int, query_rows: int) -> DataFrame:
        """(query, query_id, rank, vec_id, score) of the nearest rows in the first `visits` leaves of each query."""
        spark = queries.sparkSession
        shared = share(spark, (self.tree, self.square))
        kind = dict(queries.dtypes)["v"]
        visiting = pinned(queries.mapInArrow(_visit(shared, self.dim, visits),
                                             f"query long, query_id long, v {kind}, leaves array<int>"))
        # leaves in a row fill a shard; a larger leaf has shards of its own, one for each piece
        plan, shard, filled = [], 0, 0
        for leaf in sorted(self.sizes):
            n = self.sizes[leaf]
            if filled and filled + n > shard_rows:
                shard, filled = shard + 1, 0
            pieces = max(1, -(-n // shard_rows))
            plan.append((leaf, shard, pieces))
            filled += n
            if pieces > 1:
                shard, filled = shard + 1, 0
        shards = pinned(spark.createDataFrame(plan, "leaf int, shard int, pieces int"))  # one row a leaf, at most max_nodes
        asked = visiting.select("query", "query_id", "v", F.explode("leaves").alias("leaf")).join(F.broadcast(shards), "leaf")
        # vectors are joined again below, so that only query, shard and leaves are grouped
        wanted = pinned(asked.groupBy("query", "shard", "pieces").agg(F.collect_list("leaf").alias("leaves")))
        blocks = pinned(wanted.groupBy("shard").agg(F.ceil(F.count("*") / query_rows).alias("blocks")))
        wanted = (wanted.join(F.broadcast(blocks), "shard").withColumn("block", F.pmod(F.xxhash64("query"), F.col("blocks")))
                  .join(visiting.select("query", "query_id", "v"), "query")
                  .withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))))
        dealt = (self.rows.join(F.broadcast(shards), "leaf").join(F.broadcast(blocks), "shard")
                 .withColumn("piece", F.pmod(F.xxhash64("rep"), F.col("pieces")).cast("int"))
                 .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))))
        keys = ["shard", "piece", "block"]
        wanted = wanted.select(*keys, "query", "query_id", "v", "leaves")
        dealt = dealt.select(*keys, "rep", "ids", "v", "leaf")
        found = wanted.groupBy(*keys).cogroup(dealt.groupBy(*keys)).applyInArrow(_search(self.dim, self.k), FOUND_SCHEMA)
        return _nearest(found, self.k)


def _nearest(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query", "query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def nearest(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", every: int = 20, k: int = 20,
            target: float = 0.95, probes: int = 256, leaf_rows: int = 256, branches: int = 8, sample_rows: int = 16_384,
            max_nodes: int = 131_072, shard_rows: int = 16_384, query_rows: int = 2_048) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows of each row whose id is divisible by `every`.

    Rows whose vector is null, empty, all zeros or holds null, NaN or infinite entries take no part, nor do rows without
    vec_id. Shorter vectors end in zeros. Rows that repeat both id and vector count once; further vectors of one id are
    queries and candidates of their own, and never candidates of that id. With fewer candidates than k, all are returned;
    a single row gives none, like an empty table. Ties go to the smaller vec_id.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("v")).where(
        F.col("vec_id").isNotNull() & is_finite("v") & F.coalesce(F.exists("v", lambda c: c != 0), F.lit(False)))
    if dict(rows.dtypes)["v"] != "array<float>":
        rows = rows.withColumn("v", F.col("v").cast("array<double>"))
    dim = longest(rows, "v")
    if not dim:
        return spark.createDataFrame([], OUT_SCHEMA)
    rows = rows.withColumn("v", padded("v", dim).cast(dict(rows.dtypes)["v"])).withColumn("hash", F.xxhash64("v"))
    index = Index(rows, dim, k, leaf_rows, branches, sample_rows, max_nodes)
    queries = rows.where(F.col("vec_id") % every == 0).select("vec_id", "v").distinct()
    queries = queries.select(F.monotonically_increasing_id().alias("query"), F.col("vec_id").alias("query_id"), "v")
    # the traversal takes long for its few bytes, so it is dealt to all tasks
    queries = pinned(queries.repartition(int(spark.conf.get("spark.sql.shuffle.partitions"))))
    calibration = index.calibrated(queries, probes, target)
    return index.search(queries, calibration.visits, shard_rows, query_rows).select("query_id", "rank", "vec_id", "score")
