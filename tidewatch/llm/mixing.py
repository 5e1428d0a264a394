"""Mixing sources to target weights by Pfair scheduling.

A source with share a of Q is due a blocks in every Q slots. Its i-th block (from 0) is released at floor(i Q / a) and due
before ceil((i + 1) Q / a); in each slot the released block with the earliest deadline goes next. The order repeats after
Q slots, where every source is exactly on target, so one period decides all of them: a block's slot follows from its number
alone. When a source runs out the shares of the others make a new, shorter period from that slot on; so every document
is in the mix exactly once, and in each such phase a source is never a whole block away from its target.

What grows with the data stays in Spark: documents are numbered inside their source by a hash order, in pieces of bounded
size, so that a source with a third of all documents is many groups. The driver sees one count a source.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from tidewatch.session import pinned


@dataclass(frozen=True)
class Options:
    """block_docs: documents in a block; piece_docs: documents numbered in one group; seed: of the order inside a source;
    max_period, max_sources: limits of the sum of shares and of the number of sources; max_slots: of the slots of all
    phases' periods together, which are broadcast. Beyond a limit the mix is an error, not cut."""

    block_docs: int = 64
    piece_docs: int = 20_000
    seed: int = 42
    max_period: int = 100_000
    max_sources: int = 1_000
    max_slots: int = 2_000_000


def period(shares: dict[str, int]) -> list[str]:
    """The source of each of the sum(shares) slots of a period, by earliest deadline among released blocks."""
    q = sum(shares.values())
    waiting = [(0, -(-q // a), s, 0) for s, a in sorted(shares.items()) if a]  # release, deadline, source, block
    heapq.heapify(waiting)
    ready: list[tuple[int, str, int]] = []
    order = []
    for slot in range(q):
        while waiting and waiting[0][0] <= slot:
            _, due, source, block = heapq.heappop(waiting)
            heapq.heappush(ready, (due, source, block))
        due, source, block = heapq.heappop(ready)
        order.append(source)
        a, following = shares[source], block + 1
        if following < a:
            heapq.heappush(waiting, (following * q // a, -(-(following + 1) * q // a), source, following))
    return order


def phases(blocks: dict[str, int], shares: dict[str, int]) -> list[tuple[int, int, dict[str, int], dict[str, list[int]]]]:
    """(first slot, period, first block of each source, its slots in the period) for each phase.

    A phase ends with the slot in which a source uses its last block. Its work depends on shares and sources only.
    """
    left = {s: n for s, n in blocks.items() if n}
    used, at, out = dict.fromkeys(left, 0), 0, []
    while left:
        own = {s: shares[s] for s in left}
        order = period(own)
        slots: dict[str, list[int]] = {s: [] for s in own}
        for k, s in enumerate(order):
            slots[s].append(k)
        out.append((at, len(order), dict(used), slots))
        whole = min((n - 1) // own[s] for s, n in left.items())  # periods that leave every source a block
        rest = {s: n - whole * own[s] for s, n in left.items()}
        end = min(slots[s][n - 1] for s, n in rest.items() if n <= own[s]) + 1
        for s in list(left):
            taken = whole * own[s] + sum(k < end for k in slots[s])
            used[s] += taken
            left[s] -= taken
            if not left[s]:
                del left[s]
        at += whole * len(order) + end
    return out


def numbered(docs: DataFrame, options: Options) -> tuple[DataFrame, dict[str, int]]:
    """Documents with their place in their source, in hash order, and the number of documents of each source."""
    order = docs.withColumn("_hash", F.xxhash64(F.lit(options.seed), "doc_id", "n_chars"))
    total = order.count()
    pieces = max(1, -(-total // options.piece_docs))
    placed = order.withColumn("_piece", F.floor(F.pmod(F.shiftrightunsigned("_hash", 1) / float(1 << 63), F.lit(1.0)) * pieces))
    sizes = pinned(placed.groupBy("source", "_piece").agg(F.count("*").alias("n")))
    # pieces of a source in order: one row for each piece, not for each document
    before = Window.partitionBy("source").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("source", "_piece", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("source", "_piece").orderBy(F.shiftrightunsigned("_hash", 1), "doc_id", "n_chars")
    place = placed.withColumn("_rank", F.row_number().over(inside) - 1)
    counts = {r.source: r.n for r in sizes.groupBy("source").agg(F.sum("n").alias("n")).limit(options.max_sources + 1).collect()}
    return (place.join(offsets, ["source", "_piece"]).withColumn("place", F.col("_offset") + F.col("_rank"))
            .drop("_hash", "_piece", "_rank", "_offset"), counts)


def mixed(docs: DataFrame, shares: dict[str, int] | None = None, default_share: int = 1, doc_id: str = "doc_id",
          source: str = "source", size: str = "n_chars", options: Options = Options()) -> DataFrame:
    """(doc_id, source, n_chars, phase, slot, block, place_in_block, share, period) for every row: the order of the mix is
    slot, then place_in_block.

    shares: whole-number target of each source; sources without one have default_share, and so has the source of rows
    where it is null, named by an empty string. Every row is in the mix once, repeated rows too. The last block of
    a source may be short. An empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"),
                       F.col(size).cast("long").alias("n_chars"))
    placed, counts = numbered(rows, options)
    if len(counts) > options.max_sources:
        raise ValueError(f"more than {options.max_sources} sources")
    wanted = {s: (shares or {}).get(s, default_share) for s in counts}
    if any(a < 1 for a in wanted.values()) or sum(wanted.values()) > options.max_period:
        raise ValueError(f"shares must be positive and sum to {options.max_period} at most")
    plan = phases({s: -(-n // options.block_docs) for s, n in counts.items()}, wanted)
    starts, slots = [], []
    for number, (at, length, used, places) in enumerate(plan):
        for s, own in places.items():
            starts.append(Row(source=s, phase=number, first_block=used[s], first_slot=at, period=length, share=len(own)))
            slots += [Row(source=s, phase=number, turn=k, slot_in_period=p) for k, p in enumerate(own)]
    if len(slots) > options.max_slots:
        raise ValueError(f"the phases have more than {options.max_slots} slots; use shares with a smaller sum")
    start_table = spark.createDataFrame(
        starts, "source string, phase int, first_block long, first_slot long, period long, share long")
    slot_table = spark.createDataFrame(slots, "source string, phase int, turn long, slot_in_period long")
    ends = start_table.withColumn("end_block", F.coalesce(F.lead("first_block").over(
        Window.partitionBy("source").orderBy("phase")), F.lit((1 << 62))))
    # both tables have at most sources x phases rows, and that times shares
    blocks = placed.withColumn("block", F.floor(F.col("place") / options.block_docs)).join(F.broadcast(ends), "source").where(
        "block >= first_block and block < end_block")
    local = F.col("block") - F.col("first_block")
    return (blocks.withColumns({"turn": local % F.col("share"), "round": F.floor(local / F.col("share"))})
            .join(F.broadcast(slot_table), ["source", "phase", "turn"])
            .select("doc_id", "source", "n_chars", "phase",
                    (F.col("first_slot") + F.col("round") * F.col("period") + F.col("slot_in_period")).alias("slot"), "block",
                    (F.col("place") % options.block_docs).cast("int").alias("place_in_block"), "share", "period"))


def tempered_shares(docs: DataFrame, exponent: float = 0.5, total: int = 1000, source: str = "source") -> dict[str, int]:
    """Whole-number shares in proportion to each source's number of rows to a power below one, at least 1 each."""
    counts = docs.groupBy(F.coalesce(F.col(source).cast("string"), F.lit("")).alias("s")).agg(
        F.count("*").alias("n")).limit(Options.max_sources + 1).collect()
    weights = {r.s: r.n ** exponent for r in counts}
    whole = sum(weights.values())
    return {s: max(1, round(total * w / whole)) for s, w in weights.items()}
