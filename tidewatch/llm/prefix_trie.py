"""Conversation prefix trie: ternary search trees over dictionary-encoded turns, one for each range of sequences.

1. Turns are put in order by ranges of (conversation, turn), so that a conversation may lie in many tasks; its positions are
   those of its parts, moved by the sizes of earlier parts.
2. A dictionary gives each distinct (role, text) a code; texts count as equal when their SHA-256 are, and only digests are
   shuffled. Codes that very many turns have are looked up in a broadcast (`_looked_up`), the others by a join.
3. Conversations are rebuilt as sequences of codes, cut into blocks of `block_turns`. Equal sequences become one with a count.
4. Sequences are dealt to shards by sampled splitters, in the order of their codes. A shard inserts its sequences into a ternary
   search tree, medians first, so that the tree is balanced. One iterative traversal gives the nodes, and in reverse order it
   accumulates members, leaves and savings.
5. Nodes in several shards have a splitter's prefix as their path, so the splitters name them. Their parts are added up
   and accumulated once more among themselves, no more of them than the splitters have turns (`splitter_bytes`).
6. A block begins at a node of the block before it. Blocks are worked on from the last to the first, and what lies below
   goes in at that node. Only conversations of more than `block_turns` turns need a second block.

The ids that end at a node are sorted by ranges, joined into chunks in many tasks and hashed chunk by chunk.
"""

from __future__ import annotations

import hashlib
from array import array
from bisect import bisect_right
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import opened, share
from tidewatch.session import pinned

OUT_SCHEMA = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
              "ends_sha256 string")
# `splitter` names a node in several shards, `above` its parent or that of another node where that is in several shards
NODE_SCHEMA = ("root long, level long, conv_id long, parent long, n_convs long, n_children long, n_leaves long, "
               "saved long, chars long, ends string, below long, splitter int, above int")
_NODE = pa.schema([(c, pa.string() if kind == "string" else pa.int32() if kind == "int" else pa.int64())
                   for c, kind in (part.split() for part in NODE_SCHEMA.split(", "))])
_SIGN, _HEAVY, _CHUNK_IDS = 1 << 63, 4096, 65_536
_NO_ENDS = hashlib.sha256(b"").hexdigest()


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _places(batches):
    """Positions in the conversation, from 1, among the rows of this task; rows come in order."""
    last, before = None, 0
    for batch in batches:
        conv = batch.column(0).to_numpy()
        if not len(conv):
            continue
        at = np.arange(len(conv))
        new = np.concatenate([[True], conv[1:] != conv[:-1]])
        place = at - np.maximum.accumulate(np.where(new, at, 0)) + 1
        if last == conv[0]:
            place[:np.argmax(new[1:]) + 1 if new[1:].any() else len(conv)] += before
        last, before = conv[-1], int(place[-1])
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place, pa.int64())],
                                         ["conv", "digest", "chars", "part", "place"])


def _looked_up(rows: DataFrame, table: DataFrame, keys: list[str], total: int) -> DataFrame:
    """An inner join with a written table of distinct keys and `times`, how often a key occurs among `total` rows.

    Keys that more than one in 4,096 rows have are at most 4,096, and are broadcast; so a frequent key is no hot one.
    """
    heavy, light = (table.where(f"times * {_HEAVY} {sign} {total}").drop("times") for sign in (">", "<="))
    rare = rows.join(F.broadcast(heavy.select(*keys)), keys, "left_anti")
    return rows.join(F.broadcast(heavy), keys).unionByName(rare.join(light, keys))


def encoded_turns(turns: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, place, code, chars): the turns in their order, with the code of their role and text."""
    who, what = F.coalesce(F.col(role).cast("string"), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    digest = F.unhex(F.sha2(F.concat(F.char_length(who).cast("string"), F.lit(":"), who, what), 256))
    rows = turns.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv"), F.col(turn).alias("turn"), digest.alias("digest"),
        F.char_length(what).alias("chars"), F.monotonically_increasing_id().alias("row"))
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("digest"), F.col("row")]
    placed = pinned(rows.repartitionByRange(_partitions(rows), *order).sortWithinPartitions(*order)
                    .select("conv", "digest", "chars", F.spark_partition_id().alias("part"))
                    .mapInArrow(_places, "conv long, digest binary, chars int, part int, place long"))
    # only the first conversation of a task can have begun in an earlier one
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = placed.groupBy("conv", "part").agg(F.max("place").alias("n"))
    moved = pinned(runs.withColumn("before", F.sum("n").over(earlier)).where("before > 0").drop("n"))
    placed = placed.join(F.broadcast(moved), ["conv", "part"], "left").withColumn(
        "place", F.col("place") + F.coalesce("before", F.lit(0)))
    dictionary = pinned(placed.groupBy("digest").agg(F.count("*").alias("times"))
                        .withColumn("code", F.monotonically_increasing_id()))
    coded = _looked_up(placed, dictionary, ["digest"], placed.count())
    return pinned(coded.select("conv", "place", "code", "chars"))


def rebuilt(coded: DataFrame, span: int, heads: int, block_turns: int) -> DataFrame:
    """(conv, block, codes, chars, last): each conversation with the head of its base, in blocks.

    The base of c is c - c % span, the head its first crc32(c) % heads turns. The conversation's own first turns, as many, go.
    """
    bases = coded.where(f"conv % {span} = 0 and place < {heads}").groupBy(F.col("conv").alias("base")).agg(
        F.sort_array(F.collect_list(F.struct("place", "code", "chars"))).alias("head"))
    convs = coded.groupBy("conv").agg(F.max("place").alias("own")).select(
        "conv", "own", (F.col("conv") - F.col("conv") % span).alias("base"),
        (F.crc32(F.col("conv").cast("string").cast("binary")) % heads).cast("int").alias("h"))
    convs = pinned(convs.join(bases, "base", "left").select(
        "conv", "own", "h", F.coalesce(F.expr("slice(head, 1, h)"), F.array().cast(
            "array<struct<place:bigint,code:bigint,chars:int>>")).alias("head")))
    length = F.size("head") + F.greatest(F.col("own") - F.col("h"), F.lit(0))
    inside = (F.col("place") - 1).alias("at")
    head = convs.select("conv", length.alias("length"), F.explode("head").alias("t")).select(
        "conv", "length", "t.place", "t.code", "t.chars").select("conv", "length", inside, "code", "chars")
    # pieces of a long conversation meet a copy of its facts each
    pieces = convs.select("conv", "h", F.size("head").alias("n"), length.alias("length"), F.explode(
        F.sequence(F.lit(0).cast("long"), F.expr(f"(own - 1) div {block_turns}"))).alias("piece"))
    tail = (coded.withColumn("piece", F.expr(f"(place - 1) div {block_turns}")).join(pieces, ["conv", "piece"])
            .where("place > h").select("conv", "length", (F.col("place") - F.col("h") + F.col("n") - 1).alias("at"), "code", "chars"))
    turns = F.sort_array(F.collect_list(F.struct("at", "code", "chars")))
    blocks = (head.unionByName(tail).withColumn("block", F.expr(f"at div {block_turns}")).groupBy("conv", "block")
              .agg(turns.alias("turns"), F.max("length").alias("length"))
              .select("conv", "block", F.col("turns.code").alias("codes"), F.col("turns.chars").alias("chars"),
                      (F.col("block") == F.expr(f"(length - 1) div {block_turns}")).alias("last")))
    empty = convs.where(length == 0).select(
        "conv", F.lit(0).cast("long").alias("block"), F.array().cast("array<long>").alias("codes"),
        F.array().cast("array<int>").alias("chars"), F.lit(True).alias("last"))
    return pinned(blocks.unionByName(empty).withColumn("key", F.unhex(F.sha2(F.concat_ws(",", F.col("codes").cast("array<string>")), 256))))


def _chunks(batches):
    """Ids that end at one node, in order, joined by commas: at most a fixed number in a row."""
    key, ids = None, []

    def full():
        return pa.RecordBatch.from_pydict({
            "root": [key[0]], "key": pa.array([key[1]], pa.binary()), "first": [ids[0]], "ids": [",".join(map(str, ids))]})
    for batch in batches:
        for root, name, conv in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if ids and (key != (root, name) or len(ids) == _CHUNK_IDS):
                yield full()
                ids = []
            key = (root, name)
            ids.append(conv)
    if ids:
        yield full()


def _hashes(batches):
    """SHA-256 of the chunks of each node; they come in order, and one chunk is looked at at a time."""
    key, digest = None, None

    def done():
        return pa.RecordBatch.from_pydict({"root": [key[0]], "key": pa.array([key[1]], pa.binary()), "ends": [digest.hexdigest()]})
    for batch in batches:
        for k in range(batch.num_rows):
            root, name = batch.column(0)[k].as_py(), batch.column(1)[k].as_py()
            if key != (root, name):
                if key is not None:
                    yield done()
                key, digest = (root, name), hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(batch.column(3)[k].as_buffer())
    if key is not None:
        yield done()


def _ends(segments: DataFrame) -> DataFrame:
    """(root, key, ends): the hash of the ids of the conversations that end with a sequence."""
    n = _partitions(segments)
    ids = segments.where("last").select("root", "key", "conv")
    chunks = ids.repartitionByRange(n, "root", "key", "conv").sortWithinPartitions("root", "key", "conv").mapInArrow(
        _chunks, "root long, key binary, first long, ids string")
    return pinned(chunks.repartition(n, "root", "key").sortWithinPartitions("root", "key", "first").mapInArrow(
        _hashes, "root long, key binary, ends string"))


def _path(root: int, codes: np.ndarray) -> bytes:
    """A sequence as bytes in the order of its numbers."""
    return (np.concatenate([[root], codes]).astype(np.int64).view(np.uint64) ^ np.uint64(_SIGN)).astype(">u8").tobytes()


def _common(a: bytes, b: bytes) -> int:
    """How many numbers two paths begin with in common."""
    x, y = (np.frombuffer(p[:min(len(a), len(b))], ">u8") for p in (a, b))
    differ = np.flatnonzero(x != y)
    return int(differ[0]) if len(differ) else len(x)


def _names(splitters: list[bytes]) -> list[np.ndarray]:
    """For each splitter and level: the first splitter with the same prefix, which names the node."""
    names = []
    for k, path in enumerate(splitters):
        mine = np.full(len(path) // 8 + 1, k, dtype=np.int32)
        if k:
            common = _common(splitters[k - 1], path)
            mine[:common + 1] = names[-1][:common + 1]
        names.append(mine)
    return names


class TernaryTree:
    """A ternary search tree of number sequences: smaller, equal and larger links in arrays."""

    def __init__(self):
        self.symbol, self.chars = array("Q"), array("q")
        self.low, self.equal, self.high, self.end = (array("q") for _ in range(4))

    def _node(self, symbol: int, chars: int) -> int:
        self.symbol.append(symbol)
        self.chars.append(chars)
        for links in (self.low, self.equal, self.high, self.end):
            links.append(-1)
        return len(self.symbol) - 1

    def insert(self, path: list[int], chars: list[int], which: int) -> None:
        level, node = 0, 0 if self.symbol else self._node(path[0], chars[0])
        while True:
            if path[level] < self.symbol[node]:
                links = self.low
            elif path[level] > self.symbol[node]:
                links = self.high
            else:
                level, links = level + 1, self.equal
                if level == len(path):
                    self.end[node] = which
                    return
            if links[node] < 0:
                links[node] = self._node(path[level], chars[level])
            node = links[node]

    def insert_sorted(self, paths: list[list[int]], chars: list[list[int]]) -> None:
        """Medians first, then the medians of the halves, and so on."""
        spans = [(0, len(paths))]
        for low, high in spans:
            if low < high:
                middle = (low + high) // 2
                self.insert(paths[middle], chars[middle], middle)
                spans += [(low, middle), (middle + 1, high)]

    def walk(self) -> tuple[list[int], dict[int, int], dict[int, int]]:
        """(nodes, parent of each, level of each), parents before their children; levels count from 1."""
        order, parent, level = [], {}, {}
        stack = [(0, -1, 1)] if self.symbol else []
        while stack:
            node, above, depth = stack.pop()
            order.append(node)
            parent[node], level[node] = above, depth
            for link, of, at in ((self.low[node], above, depth), (self.high[node], above, depth), (self.equal[node], node, depth + 1)):
                if link >= 0:
                    stack.append((link, of, at))
        return order, parent, level


def _dealt(shared):
    """Sequences as paths, with the shard whose splitters they lie between."""
    def dealt(batches):
        splitters = opened(shared)
        for batch in batches:
            roots, codes = batch.column(0).to_pylist(), batch.column(1)
            paths = [_path(root, codes[k].values.to_numpy()) for k, root in enumerate(roots)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([bisect_right(splitters, p) for p in paths], pa.int32()), pa.array(paths, pa.binary()), *batch.columns[2:]],
                ["shard", "path", "chars", "rep", "times", "ends", "below_children", "below_leaves", "below_saved"])
    return dealt


DEALT_SCHEMA = ("shard int, path binary, chars array<int>, rep long, times long, ends string, below_children long, "
                "below_leaves long, below_saved long")


def _shard_nodes(shared):
    """The nodes of one shard. Nodes on the paths of its two splitters may go on elsewhere and stay in parts."""

    def shard_nodes(table: pa.Table) -> pa.Table:
        splitters, names = opened(shared)
        table = table.sort_by("path")
        shard = table.column("shard")[0].as_py()
        paths = [np.frombuffer(p, ">u8").astype(np.uint64).tolist() for p in table.column("path").to_pylist()]
        given = {c: table.column(c).to_pylist() for c in table.column_names if c not in ("path", "shard")}
        tree = TernaryTree()
        tree.insert_sorted(paths, [[0, *chars] for chars in given["chars"]])
        order, parent, level = tree.walk()
        edges = [(k, np.frombuffer(splitters[k], ">u8").tolist()) for k in (shard - 1, shard) if 0 <= k < len(splitters)]
        name = {}
        for node in order:  # a node is on a splitter's path if its parent is and its own number agrees
            for k, path in edges:
                at, above = level[node], parent[node]
                if at <= len(path) and tree.symbol[node] == path[at - 1] and (at == 1 or (k in name.get(above, ()))):
                    name.setdefault(node, {})[k] = int(names[k][at])
        size = len(tree.symbol)
        members, children, leaves, saved, below = ([0] * size for _ in range(5))
        smallest, ends = [None] * size, [None] * size
        for node in reversed(order):
            which, above = tree.end[node], parent[node]
            if which >= 0:
                members[node] += given["times"][which]
                rep = given["rep"][which]
                smallest[node] = rep if smallest[node] is None else min(rep, smallest[node])
                ends[node], below[node] = given["ends"][which], given["below_children"][which]
                leaves[node] += given["below_leaves"][which]
                saved[node] += given["below_saved"][which]
            whole = node not in name
            if whole:
                leaves[node] += not children[node] + below[node]
                saved[node] += (members[node] - 1) * tree.chars[node]
            if above >= 0:
                members[above] += members[node]
                smallest[above] = smallest[node] if smallest[above] is None else min(smallest[node], smallest[above])
                if whole:
                    children[above] += 1
                    leaves[above] += leaves[node]
                    saved[above] += saved[node]
        roots = {node: tree.symbol[node] - _SIGN for node in order if level[node] == 1}
        for node in order:
            if parent[node] >= 0:
                roots[node] = roots[parent[node]]

        def of(node: int) -> int | None:
            return next(iter(name[node].values())) if node in name else None

        def parent_id(node: int) -> int | None:
            above = parent[node]
            return None if above < 0 or above in name and level[node] > 2 else roots[node] if level[node] == 2 else smallest[above]
        columns = zip(*((roots[v], level[v], smallest[v], parent_id(v), members[v], children[v], leaves[v], saved[v],
                         tree.chars[v], ends[v], below[v], of(v), of(parent[v])) for v in order), strict=True)
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _NODE, strict=True)], schema=_NODE)
    return shard_nodes


def _merged(shared):
    """The nodes in several shards below one root, after their parts were added up: accumulated from the deepest up."""
    def merged(table: pa.Table) -> pa.Table:
        names = opened(shared)
        rows = {(r["splitter"], r["level"]): r for r in table.to_pylist()}
        for (splitter, level), row in sorted(rows.items(), key=lambda item: -item[0][1]):
            row["n_leaves"] += not row["n_children"] + row["below"]
            row["saved"] += (row["n_convs"] - 1) * row["chars"]
            above = rows.get((int(names[splitter][level - 1]), level - 1))
            if above:
                above["n_children"] += 1
                above["n_leaves"] += row["n_leaves"]
                above["saved"] += row["saved"]
                row["parent"] = row["root"] if level == 2 else above["conv_id"]
        return pa.Table.from_pylist(list(rows.values()), schema=_NODE)
    return merged


def _splitters(sequences: DataFrame, shard_turns: int, splitter_bytes: int) -> list[bytes]:
    """Sequences that cut all of them into shards of about `shard_turns` turns; together no longer than `splitter_bytes`."""
    stats = sequences.agg(F.count("*").alias("n"), F.sum(F.size("codes") + 1).alias("turns"), F.max(F.size("codes") + 1).alias("most")).first()
    shards = -(-(stats.turns or 0) // shard_turns)
    wanted = min(20 * shards, splitter_bytes // (16 * (stats.most or 1)))
    if shards < 2 or wanted < 2:
        return []
    drawn = sequences.where(F.pmod(F.xxhash64("key"), F.lit(1 << 30)) < int((1 << 30) * min(1.0, wanted / stats.n)))
    rows = drawn.select("root", "codes").limit(2 * wanted).toArrow().to_pylist()
    paths = sorted(_path(r["root"], np.array(r["codes"], dtype=np.int64)) for r in rows)
    sizes = np.cumsum([len(p) for p in paths])
    cuts = np.searchsorted(sizes, np.arange(1, shards) * (sizes[-1] / shards if len(sizes) else 0))
    return sorted({paths[k] for k in cuts if k < len(paths)})


def _nodes(sequences: DataFrame, shard_turns: int, splitter_bytes: int) -> DataFrame:
    """All nodes of the sequences of one block, with what lies below them in this and later blocks."""
    spark, splitters = sequences.sparkSession, _splitters(sequences, shard_turns, splitter_bytes)
    names = _names(splitters)
    dealt = sequences.select("root", "codes", "chars", "rep", "times", "ends", "below_children", "below_leaves", "below_saved").mapInArrow(
        _dealt(share(spark, splitters)), DEALT_SCHEMA)
    nodes = pinned(dealt.groupBy("shard").applyInArrow(_shard_nodes(share(spark, (splitters, names))), NODE_SCHEMA))
    if not splitters:
        return nodes
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved", "below")]
    parts = nodes.where("splitter is not null").groupBy("root", "splitter", "level").agg(
        F.min("conv_id").alias("conv_id"), *sums, F.max("chars").alias("chars"), F.max("ends").alias("ends"),
        F.lit(None).cast("long").alias("parent"), F.lit(None).cast("int").alias("above"))
    columns = [f.name for f in nodes.schema]
    across = pinned(parts.select(*columns).groupBy("root").applyInArrow(_merged(share(spark, names)), NODE_SCHEMA))
    # at most as many rows as the splitters have turns
    above = F.broadcast(across.select(F.col("splitter").alias("above"), (F.col("level") + 1).alias("level"),
                                      F.col("conv_id").alias("known")))
    inside = nodes.where("splitter is null").join(above, ["above", "level"], "left").withColumn(
        "parent", F.coalesce("parent", "known")).select(*columns)
    return pinned(inside.unionByName(across.select(*columns)))


def prefix_trie(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                span: int = 100, heads: int = 6, block_turns: int = 4096, shard_turns: int = 32_768,
                splitter_bytes: int = 4 << 20) -> DataFrame:
    """One row for each distinct beginning of a rebuilt conversation, the empty one included.

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256). conv_id and depth together
    name a node. A null role or text is the empty one, a null turn comes first; turns with the same number are ordered by
    the SHA-256 of their role and text, so repeated rows are turns of their own. Rows without conv_id belong to no conversation.
    A table without conversations has no nodes.
    """
    spark = turns.sparkSession
    segments = rebuilt(encoded_turns(turns, conv_id, turn, role, text), span, heads, block_turns)
    facts = segments.agg(F.min("conv").alias("first"), F.max("block").alias("block"), F.count("*").alias("n")).first()
    if not facts.n:
        return spark.createDataFrame([], OUT_SCHEMA)
    current, levels = segments.where("block = 0").withColumn("root", F.lit(facts.first)), []
    for block in range(facts.block + 1):
        sequences = pinned(current.groupBy("root", "key").agg(
            F.min("conv").alias("rep"), F.count("*").alias("times"), F.first("codes").alias("codes"), F.first("chars").alias("chars"))
            .join(_ends(current), ["root", "key"], "left"))
        levels.append(sequences)
        if block < facts.block:  # conversations that go on begin their next block at the node they have reached
            roots = sequences.select("root", "key", "times", F.col("rep").alias("next"))
            reached = _looked_up(current.where("not last").select("conv", "root", "key"), roots, ["root", "key"], facts.n)
            current = pinned(segments.where(F.col("block") == block + 1).join(
                reached.select("conv", F.col("next").alias("root")), "conv"))
    out, totals = None, None
    for block, sequences in reversed(list(enumerate(levels))):
        if totals is not None:
            sequences = sequences.join(totals, "rep", "left")
        zero = F.lit(0).cast("long")
        sequences = sequences.select("*", *([] if totals is not None else [zero.alias(c) for c in _BELOW])).fillna(0, list(_BELOW))
        nodes = _nodes(sequences, shard_turns, splitter_bytes)
        found = nodes.where("level > 1") if block else nodes
        found = found.select(
            "conv_id", (F.col("level") - 1 + block * block_turns).alias("depth"), F.col("parent").alias("parent_conv_id"), "n_convs",
            (F.col("n_children") + F.col("below")).alias("n_children"), "n_leaves", F.col("saved").alias("saved_tokens"),
            F.coalesce("ends", F.lit(_NO_ENDS)).alias("ends_sha256"))
        out = found if out is None else out.unionByName(found)
        totals = nodes.where("level = 1").select(F.col("root").alias("rep"), F.col("n_children").alias("below_children"),
                                                 F.col("n_leaves").alias("below_leaves"), F.col("saved").alias("below_saved"))
    return out


_BELOW = ("below_children", "below_leaves", "below_saved")
