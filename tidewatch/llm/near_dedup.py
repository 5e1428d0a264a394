"""MinHash near-deduplication: one-permutation hashing, banded buckets, star-shaped candidate edges, exact links.

1. Each text becomes the sorted set of its shingle hashes. One permutation is cut into bins whose minima are the
   signature; empty bins borrow from bins chosen by a hash (optimal densification). Texts with equal sets are one class
   from here on, represented by the smallest doc_id.
2. Bands of the signature give buckets. A bucket contributes one edge from each member to its centre, so there are never more
   candidate edges than classes times bands, however large a bucket is.
3. Candidates are confirmed on the full sets; connected components follow from the confirmed links.
4. A star can miss a link between two members that are both unlike the centre. So buckets that still hold several components
   are cut by the value of a second band, another one in each round, and each part gets a centre of its own. Parts hold more
   and more similar members, down to pairs. Every round is bounded like the first one. Rounds only save work for the next
   step, so they end when one joins few members.
5. Members of buckets that then still hold several components are finished exactly: two sets can only be linked if they
   share one of their rarest shingles, at a place in both that leaves enough others. Such pairs of two components are
   confirmed in three growing parts, without those that earlier parts have joined. Thus a link is only missed if it shares no
   band (see `rows_for`). The pairs can grow with the square of a family whose members are all just below the threshold.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import bit_filter, bounded_batches, dropping, give_back_memory, opened, passing, share, slices
from tidewatch.llm.components import components, merged_components
from tidewatch.session import pinned

SKETCH_SCHEMA = "doc_id long, n long, key binary, bands array<long>"
SET_SCHEMA = "doc_id long, n long, shingles binary"
_ODD = [np.uint64(pow(0x9E3779B97F4A7C15, k + 1, 1 << 64)) for k in range(64)]
PREFIX_SCHEMA = "rep long, n long, token long, place long"
_PROBES = 24
# the order of shingles by frequency only saves work: it is learned from about so many sets, for so many common shingles
_SAMPLE_SETS, _COMMON = 50_000, 1 << 18


def _mixed(x: np.ndarray) -> np.ndarray:
    """A fixed permutation of 64-bit integers that spreads all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hash of a word, remembered for short words up to a fixed number, so for about 20 MB at most."""

    def __missing__(self, word: bytes) -> int:
        value = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        if len(word) <= 32:
            if len(self) >= 1 << 17:
                self.clear()
            self[word] = value
        return value


def shingle_set(text: bytes | None, width: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of `width` consecutive words, or of all words of a shorter text; empty without words."""
    words = (text or b"").lower().split()  # bytes: A-Z only, and ASCII white space only
    if not words:
        return np.array([], dtype=np.uint64)
    ids = np.array([hashes[w] for w in words], dtype=np.uint64)
    size = min(width, len(ids))
    rolled = sum(ids[k:len(ids) - size + 1 + k] * _ODD[k] for k in range(size))
    return np.unique(_mixed(rolled + np.uint64(size)))


class Signer:
    """One-permutation signatures with optimal densification, cut into bands."""

    def __init__(self, bands: int, rows: int):
        self.bands, self.rows, self.bins = bands, rows, bands * rows
        at = np.arange(self.bins, dtype=np.uint64)
        self.probes = [(_mixed(at * np.uint64(_PROBES * 4099) + np.uint64(t + 1)) % np.uint64(self.bins)).astype(np.int64)
                       for t in range(_PROBES)]
        # each bin's own order of all bins, for sets that fill few of them
        self.orders = np.argsort(_mixed(at[:, None] * np.uint64(1 << 20) + at[None, :] + np.uint64(1 << 50)), axis=1)

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        """The smallest hash of each bin; an empty bin takes that of the first filled bin on its own probe sequence."""
        bins = ((shingles >> np.uint64(32)) * np.uint64(self.bins)) >> np.uint64(32)
        first = np.flatnonzero(np.diff(bins.astype(np.int64), prepend=-1))
        values, filled = np.zeros(self.bins, dtype=np.uint64), np.zeros(self.bins, dtype=bool)
        values[bins[first].astype(np.int64)] = shingles[first]
        filled[bins[first].astype(np.int64)] = True
        empty, out = np.flatnonzero(~filled), values.copy()
        for probe in self.probes:
            if not len(empty):
                return out
            source = probe[empty]
            found = filled[source]
            out[empty[found]] = values[source[found]]
            empty = empty[~found]
        if len(empty):  # a text of few shingles: the order of all bins, so that sets of unlike sizes borrow alike
            orders = self.orders[empty]
            out[empty] = values[orders[np.arange(len(empty)), filled[orders].argmax(axis=1)]]
        return out

    def band_hashes(self, signatures: np.ndarray) -> np.ndarray:
        """One hash for each band of each signature (rows of a matrix)."""
        cut = signatures.reshape(len(signatures), self.bands, self.rows)
        return _mixed(sum(_mixed(cut[:, :, k]) * _ODD[k] for k in range(self.rows)))


def _sketch(width: int, bands: int, rows: int):
    def sketch(batches):
        hashes, signer = WordHashes(), Signer(bands, rows)
        for batch in slices(batches):
            texts = batch.column(1).cast(pa.binary())
            sets = [shingle_set(t.as_py(), width, hashes) for t in texts]
            full = [k for k, s in enumerate(sets) if len(s)]
            signatures = np.array([signer.signature(sets[k]) for k in full], dtype=np.uint64).reshape(len(full), signer.bins)
            of_band = [[]] * len(sets)
            for k, values in zip(full, signer.band_hashes(signatures).astype(np.int64), strict=True):
                of_band[k] = values
            keys = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0), "n": pa.array([len(s) for s in sets], pa.int64()),
                "key": pa.array(keys, pa.binary()), "bands": pa.array(of_band, pa.list_(pa.int64()))})
    return sketch


def _sets(width: int):
    def sets(batches):
        hashes = WordHashes()
        for batch in slices(batches):
            found = [shingle_set(t.as_py(), width, hashes) for t in batch.column(1).cast(pa.binary())]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0), "n": pa.array([len(s) for s in found], pa.int64()),
                "shingles": pa.array([s.tobytes() for s in found], pa.binary())})
    return sets


def _linked(percent: int):
    def linked(batches):
        for batch in batches:
            ok = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):  # one pair at a time, from Arrow's own memory
                a, b = (np.frombuffer(side.as_buffer(), np.uint64) for side in (x, y))
                common = len(np.intersect1d(a, b, assume_unique=True))
                ok.append(100 * common >= percent * (len(a) + len(b) - common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(ok, pa.bool_()))
        give_back_memory()
    return linked


def _tokens(batches):
    for batch in slices(batches):
        content = b"".join(batch.column(0).to_pylist())
        yield pa.RecordBatch.from_pydict({"token": pa.array(np.frombuffer(content, np.int64))})


def _prefixes(shared, percent: int):
    """The rarest shingles of each set, by one order for all sets: two linked sets always share one of these."""

    def prefixes(batches):
        common, counts = opened(shared)
        for batch in slices(batches):
            reps, sizes, tokens, places = [], [], [], []
            for rep, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = np.frombuffer(content, np.uint64)
                at = np.searchsorted(common, found)
                order = np.lexsort((found, np.where(common[at] == found, counts[at], 0)))
                length = len(found) - -(-percent * len(found) // 100) + 1
                reps.append(np.full(length, rep))
                sizes.append(np.full(length, len(found)))
                tokens.append(found[order[:length]].astype(np.int64))
                places.append(np.arange(length))
            columns = zip(("rep", "n", "token", "place"), (reps, sizes, tokens, places), strict=True)
            yield pa.RecordBatch.from_pydict({c: pa.array(np.concatenate([np.array([], np.int64), *v])) for c, v in columns})
    return prefixes


def rows_for(percent: int, bands: int, miss: float = 1e-6) -> int:
    """The longest bands with which a pair just at the threshold shares none with a chance of at most `miss`."""
    rows = 1
    while rows < 16 and (1 - (percent / 100) ** (rows + 1)) ** bands <= miss:
        rows += 1
    return rows


class NearDuplicates:
    """The steps of one run; tables used more than once are written."""

    def __init__(self, docs: DataFrame, width: int, percent: int, bands: int, rows: int, filter_bits: int):
        self.docs, self.width, self.percent, self.filter_bits = docs, width, percent, filter_bits
        self.bands, self.rows = bands, rows
        self.sketches = pinned(docs.mapInArrow(_sketch(width, bands, rows), SKETCH_SCHEMA))
        # a set decides its bands, so any row of a class has them
        self.classes = pinned(self.sketches.where("n > 0").groupBy("key").agg(
            F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("bands").alias("bands")))

    def _members(self) -> DataFrame:
        return self.classes.where("rep is not null").select("rep", F.posexplode("bands").alias("band", "value"))

    def _sized(self, pairs: DataFrame) -> DataFrame:
        """Pairs whose sizes allow a link."""
        a, b = (self.classes.select(F.col("rep").alias(x), F.col("n").alias(f"n_{x}")) for x in "ab")
        return pairs.join(a, "a").join(b, "b").where(
            f"100 * least(n_a, n_b) >= {self.percent} * greatest(n_a, n_b)").select("a", "b")

    def _sets_of(self, ids: DataFrame) -> DataFrame:
        """Shingle sets of a written table of ids. Only texts of these are read into sets and shuffled."""
        wanted = pinned(bit_filter(ids, "doc_id", self.filter_bits))
        texts = passing(self.docs, F.col("doc_id"), wanted, self.filter_bits)
        return pinned(texts.join(ids, "doc_id", "left_semi").select("doc_id", "body").mapInArrow(_sets(self.width), SET_SCHEMA))

    def _confirmed(self, candidates: DataFrame, sets: DataFrame) -> DataFrame:
        """The candidates that are links on their full sets."""
        a, b = (sets.select(F.col("doc_id").alias(x), F.col("shingles").alias(f"set_{x}")) for x in "ab")
        both = candidates.join(a, "a").join(b, "b").select("a", "b", "set_a", "set_b")
        return pinned(both.mapInArrow(_linked(self.percent), "a long, b long"))

    def components(self) -> DataFrame:
        """(node, component) of every class that is linked with another one."""
        sizes = self._members().groupBy("band", "value").agg(F.min("rep").alias("centre"), F.count("*").alias("n")).where("n > 1")
        full = pinned(self._members().join(sizes, ["band", "value"]))
        known = pinned(_pairs(full.select(F.col("rep").alias("x"), F.col("centre").alias("y"))))
        candidates = pinned(self._sized(known))
        ids = pinned(candidates.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct())
        found = pinned(components(self._confirmed(candidates, self._sets_of(ids))))
        # a bucket of two members is a star
        return self._refined(full.where("n > 2").select("band", "value", "rep"), known, found)

    def _refined(self, buckets: DataFrame, known: DataFrame, found: DataFrame) -> DataFrame:
        """Rounds of stars in parts of the buckets that hold more than one component."""
        rest = self._open(buckets, found)
        reps = pinned(rest.select(F.col("rep").alias("doc_id")).distinct())
        n_open = reps.count()
        if not n_open:
            return found
        bands = pinned(self.classes.join(reps.withColumnRenamed("doc_id", "rep"), "rep", "left_semi").select("rep", "bands"))
        sets = self._sets_of(reps)
        for shift in range(1, self.bands):
            mask = F.pmod(F.xxhash64("band", F.lit(shift)), F.lit((1 << 62) - 1))
            second = F.element_at("bands", ((F.col("band") + shift) % self.bands + 1).cast("int"))
            part = _labelled(rest, found).join(bands, "rep").select("band", "value", second.alias("second"), "rep", "of", mask.alias("mask"))
            order = F.col("rep").bitwiseXOR(F.col("mask"))
            stars = part.groupBy("band", "value", "second").agg(
                F.min_by("rep", order).alias("centre"), F.min_by("of", order).alias("centre_of"), F.min("of").alias("low"),
                F.max("of").alias("high")).where("low < high")
            met = part.join(stars, ["band", "value", "second"]).where("of <> centre_of")
            new = pinned(_pairs(met.select(F.col("rep").alias("x"), F.col("centre").alias("y"))).join(known, ["a", "b"], "left_anti"))
            known = known.unionByName(new)
            more = self._confirmed(self._sized(new), sets)
            joined = more.count()
            if joined:
                found = merged_components(found, more)
            if 100 * joined < n_open:
                break
        return self._finished(self._open(rest, found), sets, known, found)

    def _open(self, buckets: DataFrame, found: DataFrame) -> DataFrame:
        """The buckets that hold several components."""
        parts = _labelled(buckets, found).groupBy("band", "value").agg(
            F.min("of").alias("low"), F.max("of").alias("high")).where("low < high")
        return pinned(buckets.join(parts.select("band", "value"), ["band", "value"]))

    def _finished(self, rest: DataFrame, sets: DataFrame, known: DataFrame, found: DataFrame) -> DataFrame:
        """All links between components among the members of `rest`, by a prefix-filter join."""
        reps = pinned(rest.select("rep").distinct())
        n_open = reps.count()
        if not n_open:
            return found
        held = pinned(bit_filter(reps, "rep", self.filter_bits))
        held = passing(sets, F.col("doc_id"), held, self.filter_bits).select("doc_id", "shingles")
        drawn = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int((1 << 30) * min(1.0, _SAMPLE_SETS / n_open))
        common = (held.where(drawn).select("shingles").mapInArrow(_tokens, "token long").groupBy("token").count()
                  .where("count > 1").orderBy(F.desc("count")).limit(_COMMON).toArrow())
        tokens, counts = (common.column(c).to_numpy() for c in ("token", "count"))
        order = np.argsort(tokens.astype(np.uint64))
        last = np.array([(1 << 64) - 1], np.uint64)
        shared = share(rest.sparkSession, (np.append(tokens.astype(np.uint64)[order], last), np.append(counts[order], 0)))
        entries = pinned(held.mapInArrow(_prefixes(shared, self.percent), PREFIX_SCHEMA).join(_labelled(reps, found), "rep"))
        # a pair of two components has a member outside the largest one, so only these meet all others
        mains = (entries.groupBy("token", "of").agg(F.count("*").alias("m")).groupBy("token")
                 .agg(F.max_by("of", "m").alias("main"), F.count("*").alias("parts")).where("parts > 1"))
        entries = pinned(entries.join(mains.select("token", "main"), "token"))
        x, y = (entries.where(where).select("token", *(F.col(c).alias(f"{c}_{k}") for c in ("rep", "n", "place", "of")))
                for k, where in (("x", "of <> main"), ("y", "true")))
        met = x.join(y, "token").where(
            f"of_x <> of_y and 100 * least(n_x, n_y) >= {self.percent} * greatest(n_x, n_y) and "
            f"{100 + self.percent} * least(n_x - place_x, n_y - place_y) >= {self.percent} * (n_x + n_y)")
        new = pinned(_pairs(met.select(F.col("rep_x").alias("x"), F.col("rep_y").alias("y"))).join(known, ["a", "b"], "left_anti"))
        slot = F.pmod(F.xxhash64("a", "b"), F.lit(64))
        for low, high in ((0, 1), (1, 8), (8, 64)):
            part = new.where((slot >= low) & (slot < high))
            for side in "ab":
                part = _labelled(part.withColumnRenamed(side, "rep"), found).withColumnsRenamed({"rep": side, "of": f"of_{side}"})
            more = self._confirmed(part.where("of_a <> of_b").select("a", "b"), sets)
            if not more.isEmpty():
                found = merged_components(found, more)
        return found


def _labelled(members: DataFrame, found: DataFrame) -> DataFrame:
    """Members with `of`: their component, or they themselves."""
    return members.join(found.withColumnsRenamed({"node": "rep", "component": "of"}), "rep", "left").withColumn(
        "of", F.coalesce("of", "rep"))


def _pairs(edges: DataFrame) -> DataFrame:
    return edges.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", width: int = 5, percent: int = 80,
                    bands: int = 32, rows: int | None = None, filter_bits: int = 1 << 26) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row.

    Documents are linked when 100 * common shingles >= percent * all shingles of both. Null, empty and wordless texts have
    no shingles and stand alone. component_id is the smallest doc_id reachable over links; kept says that it is the
    row's own. Rows that repeat a doc_id must have one text. A row without doc_id keeps a null component_id unless it
    shares its set with a row that has one. An empty table gives no rows.
    """
    bounded_batches(docs.sparkSession)
    rows_in = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("body"))
    run = NearDuplicates(rows_in, width, percent, bands, rows or rows_for(percent, bands), filter_bits)
    found = run.components()
    labels = run.classes.join(found, F.col("rep") == F.col("node"), "left").select(
        "key", F.coalesce("component", "rep").alias("component"))
    return (run.sketches.select("doc_id", "n", "key").join(labels, "key", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def without_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest doc_id, with all its columns."""
    dropped = near_duplicates(docs, doc_id=doc_id, **options).where("not kept").select(F.col("doc_id").alias(doc_id))
    return dropping(docs, pinned(dropped.distinct()), doc_id)
