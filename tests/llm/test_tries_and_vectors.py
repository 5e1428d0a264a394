"""Prefix tries, vector search and whitening against brute force, and on the awkward cases."""

import hashlib
import math
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.llm import kmeans_tree, queries, whitening
from tidewatch.llm.kmeans_tree import nearest
from tidewatch.llm.oracles import ORACLES
from tidewatch.llm.prefix_trie import TernaryTree, prefix_trie
from tidewatch.llm.whitening import whitened
from tools.compare import compare, duck

SF = "/root/testdata/sf0.001"
TURNS = "conv_id long, turn long, role string, text string"
VECTORS = "vec_id long, embedding array<float>"
CLASHING = ("conv", "place", "code", "key", "root", "v", "hash", "x", "rep", "leaf", "shard", "level", "part")


def cluttered(df):
    return df.select("*", *[F.lit("x").alias(c) for c in CLASHING])


# --- tries ----------------------------------------------------------------------------------

def trie_by_hand(rows, span=100, heads=6):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            order = (turn is not None, turn or 0, hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest())
            turns[conv].append((order, (role, text)))
    turns = {c: [t for _, t in sorted(found)] for c, found in turns.items()}
    sequences = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % heads
        sequences[c] = tuple(turns.get(c - int(math.fmod(c, span)), [])[:h] + turns[c][h:])
    members, children, leaves, saved = defaultdict(list), defaultdict(int), defaultdict(int), defaultdict(int)
    for c, sequence in sequences.items():
        for depth in range(len(sequence) + 1):
            members[sequence[:depth]].append(c)
    for path in members:
        if path:
            children[path[:-1]] += 1
    for path, found in members.items():
        for depth in range(len(path) + 1):
            leaves[path[:depth]] += not children[path]
            saved[path[:depth]] += (len(found) - 1) * len(path[-1][1]) if path else 0
    return {(min(found), len(path)): (
        min(members[path[:-1]]) if path else None, len(found), children[path], leaves[path], saved[path],
        hashlib.sha256(",".join(str(c) for c in sorted(found) if len(sequences[c]) == len(path)).encode()).hexdigest())
        for path, found in members.items()}


def trie_of(df, **options):
    rows = prefix_trie(df, **options).collect()
    found = {(r.conv_id, r.depth): tuple(r)[2:] for r in rows}
    assert len(found) == len(rows)
    return found


ODD_TURNS = ([(0, 1, "a", "x")] * 3 + [(100, i, "u", f"t{i % 7}") for i in range(40)]
             + [(101 + j, i, "u", f"t{i % 7}") for j in range(4) for i in range(37 + j)]
             + [(-5, None, None, None), (-5, 1, None, "q"), (-100, 0, "u", "é😀"), (7, 0, "u", ""), (None, 1, "u", "lost"),
                (205, 0, "u", "a"), (1205, 3, "z", "b"), (300, 0, "u", "y" * 200_000), (301, 0, None, "y" * 200_000)])


@pytest.mark.parametrize("options", [{}, {"block_turns": 16, "shard_turns": 30}])
def test_trie_of_awkward_turns(spark, options):
    """Repeated turns, nulls, negative ids, missing bases, turnless conversations, blocks and many shards."""
    df = spark.createDataFrame(ODD_TURNS, TURNS).repartition(3)
    assert trie_of(cluttered(df), **options) == trie_by_hand(ODD_TURNS)


def test_trie_of_all_conversations(spark):
    df = spark.read.parquet(f"{SF}/conversations.parquet")
    want = trie_by_hand([(r.conv_id, r.turn, r.role, r.text) for r in df.collect()])
    assert trie_of(df, shard_turns=20) == want


def test_trie_with_a_hot_conversation_and_copies(spark):
    """One conversation in many tasks, and one sequence that a third of all conversations have."""
    rows = [(50, i, "u", f"t{i}") for i in range(240)] + [(1000 + i, 0, "u", "same") for i in range(300)]
    df = spark.createDataFrame(rows, TURNS).repartition(8)
    assert trie_of(df, block_turns=100, shard_turns=60) == trie_by_hand(rows)


def test_trie_of_nothing(spark):
    empty = spark.createDataFrame([], TURNS)
    assert prefix_trie(empty).count() == 0
    assert prefix_trie(spark.createDataFrame([(None, 1, "u", "a")], TURNS)).count() == 0
    assert trie_of(spark.createDataFrame([(3, 1, "u", "a")], TURNS)) == trie_by_hand([(3, 1, "u", "a")])


def test_trie_equals_its_sql(spark):
    result = compare(spark, duck(SF), "op11_prefix_trie", queries.op11_prefix_trie, ORACLES["op11_prefix_trie"], SF)
    assert result == "ok"


def test_medians_first_keep_the_tree_balanced():
    tree = TernaryTree()
    tree.insert_sorted([[7, k] for k in range(1023)], [[0, 1]] * 1023)

    def height(node):
        return 0 if node < 0 else 1 + max(height(tree.low[node]), height(tree.high[node]))
    assert height(tree.equal[0]) == 10
    order, parent, level = tree.walk()
    assert len(order) == 1024 and all(parent[v] == 0 and level[v] == 2 for v in order[1:])


# --- neighbours -----------------------------------------------------------------------------

def vectors_of(df):
    rows = {(r.vec_id, tuple(r.embedding)) for r in df.collect()
            if r.vec_id is not None and r.embedding is not None and all(c is not None and math.isfinite(c) for c in r.embedding)
            and any(r.embedding)}
    dim = max((len(v) for _, v in rows), default=0)
    return [(i, np.array([*v, *[0.0] * (dim - len(v))])) for i, v in sorted(rows)]


def nearest_by_hand(df, k=20, every=20):
    rows = vectors_of(df)
    out = {}
    for i, q in rows:
        if i % every == 0:
            scored = sorted((-float((q * v).sum()), j) for j, v in rows if j != i)
            out[i] = [(j, -s) for s, j in scored[:k]]
    return out


def found_by(rows):
    out = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.query_id, r["rank"])):
        assert r["rank"] == len(out[r.query_id]) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return dict(out)


def recall(got, want):
    return np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / len(want[q]) for q in want])


def test_neighbours_of_all_embeddings(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    got, want = found_by(nearest(cluttered(df)).collect()), nearest_by_hand(df)
    assert set(got) == set(want) and all(len(v) == 20 for v in got.values()) and recall(got, want) >= 0.9
    exact = {(q, j): s for q in want for j, s in want[q]}
    assert all(exact.get((q, j), s) == s for q in got for j, s in got[q])


@pytest.mark.parametrize("options", [{"leaf_rows": 10, "sample_rows": 60, "shard_rows": 40, "query_rows": 3, "branches": 4},
                                     {"leaf_rows": 10, "max_nodes": 10, "shard_rows": 15}])
def test_trees_refined_in_tasks_and_leaves_in_pieces(spark, options):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    got, want = found_by(nearest(df, **options).collect()), nearest_by_hand(df)
    assert set(got) == set(want) and recall(got, want) >= 0.9


@pytest.mark.parametrize("kind", ["array<float>", "array<double>"])
def test_exact_where_all_leaves_are_visited(spark, kind):
    """Copies, ties, unlike lengths and norms, and vectors that take no part."""
    rng = np.random.default_rng(3)
    rows = [(i, [float(c) for c in rng.integers(-2, 3, 4)]) for i in range(150)]
    rows += [(200 + i, [1.0, 1.0, 0.0, 0.0]) for i in range(60)] + [(i, [9.0, 9.0]) for i in (300, 320, 340)]
    rows += [(400, None), (401, []), (402, [0.0, -0.0]), (403, [1.0, None]), (404, [math.nan, 1.0]), (405, [math.inf, 1.0]),
             (None, [5.0, 5.0]), (7, [0.5] * 4), (20, [1.0, 0.0, 0.0, 0.0]), (340, [9.0, 9.0])]
    df = spark.createDataFrame(rows, f"vec_id long, embedding {kind}").repartition(4)
    got = nearest(df, target=1.0, probes=1000, leaf_rows=20, shard_rows=64, query_rows=4)
    per_vector = defaultdict(list)  # an id with two vectors is two queries, which have the same ranks
    for r in got.collect():
        per_vector[r.query_id].append((r["rank"], r.vec_id, r.score))
    rows = vectors_of(df)
    want = defaultdict(list)
    for i, q in rows:
        if i % 20 == 0:
            scored = sorted((-float((q * v).sum()), j) for j, v in rows if j != i)
            want[i] += [(k + 1, j, -s) for k, (s, j) in enumerate(scored[:20])]
    assert {q: sorted(v) for q, v in per_vector.items()} == {q: sorted(v) for q, v in want.items()}


def test_neighbours_of_few(spark):
    assert nearest(spark.createDataFrame([], VECTORS)).count() == 0
    assert nearest(spark.createDataFrame([(0, [1.0, 2.0])], VECTORS)).count() == 0
    assert nearest(spark.createDataFrame([(0, None), (20, [0.0])], VECTORS)).count() == 0
    few = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0]), (2, [3.0])], VECTORS)
    assert [tuple(r) for r in nearest(few).orderBy("rank").collect()] == [(0, 1, 2, 3.0), (0, 2, 1, 1.0)]


def test_best_bins_come_nearest_first():
    rng = np.random.default_rng(1)
    points = rng.standard_normal((2000, 6))
    tree = kmeans_tree._numbered(kmeans_tree.grown(points, 1.0, 50, 5, 10_000, 1))
    leaves = tree.placed(points)
    assert sorted(np.unique(leaves)) == list(range(tree.leaves)) and np.bincount(leaves).max() <= 60
    for point in points[:50]:
        bins = tree.best_bins(point, tree.leaves)
        assert sorted(bins) == list(range(tree.leaves)) and tree.best_bins(point, 3) == bins[:3]
    assert np.mean([tree.best_bins(p, 1)[0] == leaf for p, leaf in zip(points, leaves, strict=True)]) > 0.6


# --- whitening ------------------------------------------------------------------------------

def whitened_by_hand(df, components=4):
    rows = [(r.vec_id, r.embedding) for r in df.collect()
            if r.embedding is not None and all(c is not None and math.isfinite(c) for c in r.embedding)]
    dim = max((len(v) for _, v in rows), default=0)
    x = np.array([[math.floor(256 * c) for c in v] + [0] * (dim - len(v)) for _, v in rows], dtype=object)
    fit = np.array(sorted({tuple(r) for r in x}), dtype=object)
    n, sums = len(fit), fit.sum(axis=0)
    centred = ((n * fit - sums) / n).astype(float)
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    k = min(components, int((values > 1e-9 * values[0]).sum()))
    y = ((n * x - sums) / n).astype(float) @ axes[:, :k] / np.sqrt(values[:k])
    deviation = ((n * x - sums) ** 2).sum(axis=1)
    return [(i, n, int(d), row, values[:k] / values.sum()) for (i, _), d, row in zip(rows, deviation, y, strict=True)]


def check_whitened(df, **options):
    rows = whitened(df, **options).collect()
    want = whitened_by_hand(df)
    key = [i if i is not None else -1 for i, *_ in want]
    assert len(rows) == sum(len(w[3]) for w in want)
    signs = {}
    by_row = defaultdict(list)
    for r in rows:
        by_row[r.vec_id if r.vec_id is not None else -1].append(r)
    for k, (i, n, deviation, y, explained) in zip(key, want, strict=True):
        for r in by_row[k]:
            assert r.n == n and 1 <= r.component <= len(y)
            assert abs(r.explained / explained[r.component - 1] - 1) < 1e-9 and r.identity_error < 1e-6
        if len(by_row[k]) == len(y):
            for r in by_row[k]:
                value = y[r.component - 1]
                assert r.deviation == deviation
                if abs(value) > 1e-6:
                    sign = signs.setdefault(r.component, np.sign(r.whitened * value))
                    assert abs(r.whitened * sign - value) < 1e-8


def test_whitening_of_all_embeddings(spark):
    check_whitened(cluttered(spark.read.parquet(f"{SF}/embeddings.parquet")))


def test_whitening_of_awkward_vectors(spark):
    rng = np.random.default_rng(8)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(rng.standard_normal((80, 7)) * [9, 6, 4, 3, 1, 1, 1])]
    rows += [(5, rows[5][1]), (1000, [1.0, 2.0]), (1001, []), (1002, None), (1003, [1.0, None]), (1004, [math.nan]),
             (1005, [-math.inf]), (None, [3.0])] + [(2000 + i, [2.0, 1.0, -0.0]) for i in range(50)]
    check_whitened(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3))


def test_whitening_with_fewer_components(spark):
    """A line has one component, a point none; equal eigenvalues are all found."""
    line = spark.createDataFrame([(i, [i / 4, i / 2, 1.0]) for i in range(9)], VECTORS)
    assert {r.component for r in whitened(line).collect()} == {1}
    check_whitened(line)
    for rows in ([], [(1, None)], [(1, [])], [(1, [1.0]), (2, [1.0])]):
        assert whitened(spark.createDataFrame(rows, VECTORS)).count() == 0
    cross = spark.createDataFrame([(2 * k + s, [float((2 * s - 1) * (j == k)) for j in range(5)]) for k in range(5) for s in (0, 1)], VECTORS)
    got = whitened(cross).collect()
    assert {r.component for r in got} == {1, 2, 3, 4} and all(abs(r.explained - 0.2) < 1e-12 and r.identity_error < 1e-9 for r in got)


def test_whitening_of_huge_entries(spark):
    """Squares beyond 64 bits stay exact and give no deviation; entries beyond 64 bits are at its edge."""
    huge = spark.createDataFrame([(0, [1e12, 1.0]), (1, [-1e12, 2.0]), (2, [0.0, 3.0]), (3, [1e300, 0.0])], "vec_id long, embedding array<double>")
    rows = whitened(huge).collect()
    assert rows and all(r.deviation is None for r in rows if r.component == 1) and all(math.isfinite(r.whitened) for r in rows)


def test_left_vectors_are_orthogonal():
    """The left vectors that tasks make from their blocks alone are those of the whole matrix."""
    rng = np.random.default_rng(4)
    x = rng.standard_normal((300, 5))
    right = np.linalg.qr(rng.standard_normal((5, 5)))[0]
    q, r = np.linalg.qr(x @ right)
    parts = np.concatenate([whitening._left_vectors(x[k:k + 70], right, r) for k in range(0, 300, 70)])
    assert np.abs(parts - q).max() < 1e-12
