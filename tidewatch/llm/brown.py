"""Brown class-based n-grams: exchange clustering of words into classes, and class-bigram log-probabilities.

1. One pass over the texts encodes them. A chunk is a bounded run of texts of one task: its distinct words, how often
   each occurs in training texts, and the texts as integers into that list.
2. The head, some frequent words (a parameter), is clustered first: bigrams of head words, text ends and everything else
   are counted over all training texts, and in each round tasks move their share of the head to the classes that most
   increase the likelihood of the class bigrams. A round that lowers it is taken back and fewer words move at once; rounds
   end when what a turn of all words gains falls below a tolerance.
3. Then every other word seen more than once is put in by the same criterion. Chunks give, for their own words, the counts
   and how often a word of each class stands before and after it (word lists are folded before the shuffle); what belongs to a
   word is summed, sorted, batch by batch, and the word goes to its best class. Words seen once stay in a class of their own, which
   is also that of unknown words. No task ever holds the vocabulary.
4. Chunks get back the counts and classes of their own words and count class bigrams of all training texts.
5. score = sum of log10 P(class | class before) * P(word | class). Emissions add one to every count; words unknown to
   training share one place among the words seen once, so the probabilities of all words and the unknown one sum to one.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from tidewatch.llm.common import opened, remainder, share
from tidewatch.session import pinned

CHUNK_SCHEMA = ("chunk long, docs binary, absent binary, lengths binary, held binary, ids binary, counts binary, "
                "words binary, trained long")
SCORE_SCHEMA = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
                "score double")
# classes of their own: the end of a text, and words seen once (in the clustering of the head, all that are not in it)
END, RARE = 0, 1
FIXED = 2


@dataclass(frozen=True)
class Options:
    """head_words: words that are clustered before all others, so the size of the table of word pairs; classes: for words seen
    more than once (at most 100); tolerance: rounds end when, in a turn of all words, they add less than this part to the
    information that a class has about the next; rounds: a bound on them; head_share: a chunk proposes words for the head that are at least this part of its tokens;
    chunk_tokens: texts of a task are cut into chunks of about so many tokens; smoothing: weight of the class's own frequency
    in its transitions."""

    head_words: int = 2048
    classes: int = 48
    tolerance: float = 0.02
    rounds: int = 24
    head_share: float = 1e-5
    chunk_tokens: int = 2_000_000
    smoothing: float = 20.0


def _pack(content: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(content)


def _unpack(packed: bytes, kind: type) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), kind)


def _encode(limit: int):
    """Chunks of the task's texts: (doc ids, lengths, held-out flags, word numbers, word list, training counts)."""

    def chunk(number: int, docs: list, words: dict[bytes, int]) -> pa.RecordBatch:
        ids = np.concatenate([d[2] for d in docs]) if docs else np.array([], np.int32)
        lengths = np.array([len(d[2]) for d in docs], np.int64)
        held = np.array([d[1] for d in docs], bool)
        counts = np.bincount(ids[~np.repeat(held, lengths)], minlength=len(words)).astype(np.int32)
        fields = {"docs": np.array([d[0] or 0 for d in docs], np.int64), "absent": np.array([d[0] is None for d in docs], bool),
                  "lengths": lengths, "held": held, "ids": ids, "counts": counts}
        return pa.RecordBatch.from_pydict({
            "chunk": pa.array([(TaskContext.get().partitionId() << 24) + number]),
            **{k: pa.array([_pack(v.tobytes())], pa.binary()) for k, v in fields.items()},
            "words": pa.array([_pack(b"\n".join(words))], pa.binary()), "trained": pa.array([int((~held).sum())])})

    def encode(batches):
        docs, words, size, made = [], {}, 0, 0
        for batch in batches:
            texts = batch.column(2).cast(pa.binary())
            for doc_id, held, text in zip(batch.column(0), batch.column(1), texts, strict=True):
                tokens = (text.as_py() or b"").lower().split()
                ids = np.array([words.setdefault(w, len(words)) for w in tokens], dtype=np.int32)
                docs.append((doc_id.as_py(), held.as_py(), ids))
                size += len(ids) + 1
                if size >= limit:
                    yield chunk(made, docs, words)
                    docs, words, size, made = [], {}, 0, made + 1
                    pa.default_memory_pool().release_unused()
        if docs:
            yield chunk(made, docs, words)
    return encode


def _listed(row: dict) -> list[bytes]:
    words = zstandard.ZstdDecompressor().decompress(row["words"])
    return words.split(b"\n") if words else []


def _word_rows(batches):
    """(chunk, number, word, training count) for every word of every chunk."""
    for batch in batches:
        for row in _single(batch):
            listed, counted, chunk = _listed(row), _unpack(row["counts"], np.int32), row["chunk"]
            for at in range(0, len(listed), 100_000):
                part = listed[at:at + 100_000]
                yield pa.RecordBatch.from_pydict({
                    "chunk": pa.array([chunk] * len(part)), "number": pa.array(np.arange(at, at + len(part), dtype=np.int32)),
                    "word": pa.array(part, pa.binary()), "n": pa.array(counted[at:at + len(part)].astype(np.int64))})


def _frequent(part_of_tokens: float):
    """(word, training count) of the words that are at least so large a part of a chunk's training tokens."""

    def frequent(batches):
        for batch in batches:
            for row in _single(batch):
                listed, counted = _listed(row), _unpack(row["counts"], np.int32)
                at = np.flatnonzero((counted > 0) & (counted >= part_of_tokens * counted.sum()))
                yield pa.RecordBatch.from_pydict({"word": pa.array([listed[k] for k in at], pa.binary()),
                                                  "n": pa.array(counted[at].astype(np.int64))})
    return frequent


def _packed(table: pa.Table) -> pa.Table:
    """What the chunk cannot know of its own words: numbers, corpus counts and classes."""
    kinds = {"number": np.int32, "count": np.int64, "class": np.int32}
    return pa.table({"chunk": table.column("chunk")[:1], **{
        f"word_{c}": pa.array([_pack(table.column(c).to_numpy().astype(kind).tobytes())], pa.binary()) for c, kind in kinds.items()}})


def _single(batch: pa.RecordBatch):
    """The rows one after another: a row is a whole chunk."""
    for k in range(batch.num_rows):
        yield batch.slice(k, 1).to_pylist()[0]
        pa.default_memory_pool().release_unused()


class Texts:
    """Some texts of a chunk: word numbers with -1 at the end of each text."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray):
        self.lengths, self.starts = lengths, np.cumsum(lengths + 1) - lengths - 1
        self.tokens = np.full(len(ids) + len(lengths), -1, dtype=np.int64)
        inside = np.ones(len(self.tokens), dtype=bool)
        inside[self.starts + lengths] = False
        self.tokens[inside] = ids


def _pieces(row: dict, most: int = 200_000):
    """(slice of the chunk's documents, their texts), of about `most` tokens at once."""
    lengths, ids = _unpack(row["lengths"], np.int64), _unpack(row["ids"], np.int32)
    ends = np.cumsum(lengths)
    first = 0
    while first < len(lengths):
        begin = ends[first] - lengths[first]
        last = max(first + 1, int(np.searchsorted(ends, begin + most, "right")))
        yield slice(first, last), Texts(ids[begin:ends[last - 1]], lengths[first:last])
        first = last


def _known(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """Corpus count and class of each word of the chunk; the last class, which -1 picks, is that of the end."""
    counts = _unpack(row["counts"], np.int32).astype(np.int64)
    classes = np.append(np.full(len(counts), RARE, np.int64), END)
    if row["word_number"]:
        number = _unpack(row["word_number"], np.int32)
        counts[number], classes[number] = _unpack(row["word_count"], np.int64), _unpack(row["word_class"], np.int32)
    return counts, classes


def _pair_counts(size: int, of_words):
    """Bigrams of the task's training texts; an end comes before the first word. One row a pair and task.

    of_words(row): a number below `size` for each word of the chunk and, last, for the end.
    """

    def count(batches):
        pairs, n = np.array([], np.int64), np.array([], np.int64)
        for batch in batches:
            for row in _single(batch):
                symbol, held = of_words(row), _unpack(row["held"], bool)
                for docs, texts in _pieces(row):
                    symbols = symbol[texts.tokens]
                    before = np.concatenate([symbol[-1:], symbols[:-1]])
                    used = np.repeat(~held[docs], texts.lengths + 1)
                    found, k = np.unique(before[used] * size + symbols[used], return_counts=True)
                    pairs, where = np.unique(np.concatenate([pairs, found]), return_inverse=True)
                    n = np.bincount(where, weights=np.concatenate([n, k]), minlength=len(pairs)).astype(np.int64)
        yield pa.RecordBatch.from_pydict({"x": pa.array(pairs // size), "y": pa.array(pairs % size), "n": pa.array(n)})
    return count


def _head_symbols(shared, rest: int):
    """Symbols: 0 for the end, 1 and more for the head, `rest` for all other words."""

    def of_words(row: dict) -> np.ndarray:
        head = opened(shared)
        return np.array([*(head.get(w, rest) for w in _listed(row)), END], np.int64)
    return of_words


def packed_contexts(owners: np.ndarray, codes: np.ndarray, n_owners: int, n_codes: int) -> tuple[np.ndarray, np.ndarray]:
    """(end of each owner's bytes, bytes): pairs of a code and how often the owner has it; above 255 it is said in parts."""
    wide = n_owners * n_codes > np.iinfo(np.int32).max
    keys = owners.astype(np.int64 if wide else np.int32)
    keys *= n_codes
    keys += codes.astype(keys.dtype)
    keys.sort()
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    n, keys = np.diff(first, append=len(keys)), keys[first]
    parts = (n + 254) // 255
    said = np.full(int(parts.sum()), 255, np.uint8)
    said[np.cumsum(parts) - 1] = n - 255 * (parts - 1)
    out = np.empty((len(said), 2), np.uint8)
    out[:, 0], out[:, 1] = np.repeat(keys % n_codes, parts), said
    ends = np.cumsum(np.bincount(keys // n_codes, weights=parts, minlength=n_owners).astype(np.int64)) * 2
    return ends, out.reshape(-1)


def _contexts(shared, n_classes: int):
    """(word, training count, context) for the words of every chunk that training texts have.

    A context is `packed_contexts` of the classes after the word, n_classes plus those before it, and 2 * n_classes where it
    follows itself. Head words need none.
    """
    own, n_codes = 2 * n_classes, 2 * n_classes + 1

    def contexts(batches):
        head_classes = opened(shared)
        for batch in batches:
            for row in _single(batch):
                listed, counted = _listed(row), _unpack(row["counts"], np.int32)
                of = np.array([*(head_classes.get(w, RARE) for w in listed), END], np.int64)
                texts = Texts(_unpack(row["ids"], np.int32), _unpack(row["lengths"], np.int64))
                used = np.repeat(~_unpack(row["held"], bool), texts.lengths + 1)
                y = texts.tokens[used].astype(np.int32)
                x = np.concatenate([np.full(min(1, len(y)), -1, np.int32), y[:-1]])
                del texts, used
                same = (x == y) & (y >= 0)
                ahead, behind = (of[x] == RARE) & (x >= 0) & ~same, (of[y] == RARE) & (y >= 0)
                owners = np.concatenate([x[ahead], y[behind]])
                codes = np.concatenate([of[y[ahead]], np.where(same, own, n_classes + of[x])[behind]]).astype(np.uint8)
                del x, y, same, ahead, behind
                ends, packed = packed_contexts(owners, codes, len(listed), n_codes)
                del owners, codes
                for at in range(0, len(listed), 50_000):
                    part = slice(at, at + 50_000)
                    low = int(ends[at - 1]) if at else 0
                    offsets = np.concatenate([[0], ends[part] - low]).astype(np.int32)
                    held = pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [
                        None, pa.py_buffer(offsets), pa.py_buffer(packed[low:low + int(offsets[-1])].tobytes())])
                    found = pa.RecordBatch.from_pydict({"word": pa.array(listed[part], pa.binary()),
                                                        "n": pa.array(counted[part].astype(np.int64)), "context": held})
                    yield found.filter(pa.array(counted[part] > 0))
    return contexts


def _phi(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def best_class(totals: np.ndarray, before: np.ndarray, after: np.ndarray, own: int, twice: int, free: np.ndarray) -> int:
    """The class among `free` in which a word gives the class bigrams their highest likelihood.

    totals: class bigram counts with the word in class `own`; before[c], after[c]: how often a word of class c comes before
    and after it, other than itself; twice: how often it follows itself. `totals` loses the word.
    """
    totals[:, own] -= before
    totals[own, :] -= after
    totals[own, own] -= twice
    left, right = totals.sum(axis=1) + before, totals.sum(axis=0) + after  # what neighbours keep in any case
    gain = (_phi(totals + after) - _phi(totals)).sum(axis=1) + (_phi(totals.T + before) - _phi(totals.T)).sum(axis=1)
    # the cell of a class with itself takes both shares and the word's own repetitions
    cell = np.diag(totals)
    gain += _phi(cell + after + before + twice) - _phi(cell + after) - _phi(cell + before) + _phi(cell)
    gain -= _phi(left + after.sum() + twice) - _phi(left) + _phi(right + before.sum() + twice) - _phi(right)
    return int(free[np.argmax(gain[free])])


def best_classes(totals: np.ndarray, before: np.ndarray, after: np.ndarray, twice: np.ndarray) -> np.ndarray:
    """`best_class` of many words that are in RARE, each on its own against the same totals.

    before[w, c], after[w, c], twice[w] as there; only cells that a word changes are looked at.
    """
    free = np.arange(FIXED, len(totals))
    left, right, cell = totals.sum(axis=1)[free], totals.sum(axis=0)[free], np.diag(totals)[free]
    gain = np.zeros((len(twice), len(free)))
    for counts, others, rows in ((after, before, totals), (before, after, totals.T)):
        kept = counts.copy()
        kept[:, RARE] = 0
        w, c = np.nonzero(kept)
        if len(w):
            now = rows[free][:, c].T
            found, starts = np.unique(w, return_index=True)
            gain[found] += np.add.reduceat(_phi(now + kept[w, c][:, None]) - _phi(now), starts, axis=0)
        rare = rows[free, RARE] - others[:, free]  # RARE has lost the word
        gain += _phi(rare + counts[:, [RARE]]) - _phi(rare)
    a, b, t = after[:, free], before[:, free], twice[:, None]
    gain += _phi(cell + a + b + t) - _phi(cell + a) - _phi(cell + b) + _phi(cell)
    gain -= _phi(left + after.sum(axis=1)[:, None] + t) - _phi(left) + _phi(right + before.sum(axis=1)[:, None] + t) - _phi(right)
    return free[np.argmax(gain, axis=1)]


def _assigned(shared, n_classes: int, most: int = 500):
    """(word, count, class) from rows sorted by word; only the last word of a batch is carried on."""
    n_codes = 2 * n_classes + 1

    def placed(words: list, counts: np.ndarray, contexts: np.ndarray, head: dict, totals: np.ndarray) -> pa.RecordBatch:
        of = np.full(len(words), RARE, np.int32)
        moving = np.flatnonzero(counts > 1)
        for low in range(0, len(moving), most):
            at = moving[low:low + most]
            of[at] = best_classes(totals, contexts[at, n_classes:-1], contexts[at, :n_classes], contexts[at, -1])
        of = np.array([head.get(w, c) for w, c in zip(words, of.tolist(), strict=True)], np.int32)
        return pa.RecordBatch.from_pydict({"word": pa.array(words, pa.binary()), "count": pa.array(counts), "class": pa.array(of)})

    def assign(batches):
        head, totals = opened(shared)
        last = ([], np.array([], np.int64), np.zeros((0, n_codes)))
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                batch = whole.slice(at, 4096)
                rows = batch.column(0).to_pylist()
                new = np.array([a != b for a, b in zip(rows, [None, *rows[:-1]], strict=True)], bool)
                group, words = np.cumsum(new) - 1, [rows[k] for k in np.flatnonzero(new)]
                counts = np.bincount(group, batch.column(1).to_numpy(), len(words)).astype(np.int64)
                sizes = np.array([len(c) for c in batch.column(2).to_pylist()], np.int64) // 2
                said = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint8).reshape(-1, 2)
                contexts = np.bincount(np.repeat(group, sizes) * n_codes + said[:, 0], said[:, 1],
                                       len(words) * n_codes).reshape(len(words), n_codes)
                if last[0] and last[0][0] == words[0]:
                    counts[0] += last[1][0]
                    contexts[0] += last[2][0]
                elif last[0]:
                    yield placed(*last, head, totals)
                if len(words) > 1:
                    yield placed(words[:-1], counts[:-1], contexts[:-1], head, totals)
                last = words[-1:], counts[-1:], contexts[-1:]
        if last[0]:
            yield placed(*last, head, totals)
    return assign


def _exchange(shared):
    """Move the words of a group one after another, each against the counts its predecessors left."""

    def move(table: pa.Table) -> pa.Table:
        classes, totals = opened(shared)
        totals, n_classes = totals.astype(np.float64), len(totals)
        free = np.arange(FIXED, n_classes)
        word, of, side, n, own = (table.column(c).to_numpy() for c in ("word", "of", "side", "n", "own"))
        order = np.argsort(word, kind="stable")
        words, starts = np.unique(word[order], return_index=True)
        out = []
        for k, w in enumerate(words):
            rows = order[starts[k]:starts[k + 1] if k + 1 < len(words) else None]
            twice = int(own[rows][side[rows] == 0].sum())
            context = [np.bincount(of[rows][side[rows] == s], weights=(n - own)[rows][side[rows] == s], minlength=n_classes)
                       for s in (0, 1)]
            best = best_class(totals, context[0], context[1], int(classes[w]), twice, free)
            totals[:, best] += context[0]
            totals[best, :] += context[1]
            totals[best, best] += twice
            out.append(best)
        return pa.table({"word": pa.array(words), "class": pa.array(out, pa.int64())})
    return move


class ClassModel:
    """Classes of symbols and log10 probabilities of class transitions; small arrays whose size options fix."""

    def __init__(self, classes: np.ndarray, totals: np.ndarray, tokens: np.ndarray, types: np.ndarray, rare: int,
                 smoothing: float, base: int):
        self.classes, self.rare, self.base = classes, rare, base
        share = (tokens + 1.0) / (tokens + 1.0).sum()
        self.transition = np.log10((totals + smoothing * share) / (totals.sum(axis=1, keepdims=True) + smoothing))
        places = tokens + types
        places[rare] += 1  # the unknown word
        self.emission = -np.log10(np.maximum(places, 1.0))


def _score(shared):
    def score(batches):
        model, train_tokens, end_count = opened(shared)
        for batch in batches:
            for row in _single(batch):
                count, of = _known(row)
                count = np.append(count, end_count)
                known = count > 0
                seen = np.log10(count + 1.0)
                base, own = seen - np.log10(model.base), seen + model.emission[of]
                ids, absent, held = _unpack(row["docs"], np.int64), _unpack(row["absent"], bool), _unpack(row["held"], bool)
                for docs, texts in _pieces(row):
                    classes = of[texts.tokens]
                    before = np.concatenate([[END], classes[:-1]])
                    steps = own[texts.tokens] + model.transition[before, classes]
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": pa.array(ids[docs], mask=absent[docs]), "held_out": pa.array(held[docs]),
                        "n_tokens": pa.array(texts.lengths + 1),
                        "n_known": pa.array(np.add.reduceat(known[texts.tokens].astype(np.int64), texts.starts)),
                        "train_tokens": pa.array(np.full(len(texts.lengths), train_tokens)),
                        "base_score": pa.array(np.add.reduceat(base[texts.tokens], texts.starts)),
                        "score": pa.array(np.add.reduceat(steps, texts.starts))})
    return score


@dataclass(frozen=True)
class Trained:
    """The encoded texts with counts and classes of their own words, (word, count, class) of all training words, class bigram
    counts, and how many texts were learned from."""

    encoded: DataFrame
    vocabulary: DataFrame
    totals: np.ndarray
    end_count: int


def trained(docs: DataFrame, held_out: Column, text: str, doc_id: str, options: Options) -> Trained:
    """Cluster the words of the rows that are not held out."""
    if options.classes > 100:
        raise ValueError("at most 100 classes: a context names a class in a byte")
    spark, n_classes = docs.sparkSession, FIXED + options.classes
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held"),
                       F.col(text).alias("body"))
    chunks = pinned(rows.mapInArrow(_encode(options.chunk_tokens), CHUNK_SCHEMA))
    end_count = int(chunks.agg(F.coalesce(F.sum("trained"), F.lit(0))).first()[0])

    proposed = chunks.select("words", "counts").mapInArrow(_frequent(options.head_share), "word binary, n long")
    head = {bytes(r.word): k + 1 for k, r in enumerate(
        proposed.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(options.head_words).collect())}
    rest = len(head) + 1
    pairs = pinned(chunks.select("words", "held", "lengths", "ids").mapInArrow(
        _pair_counts(rest + 1, _head_symbols(share(spark, head), rest)), "x long, y long, n long")
        .groupBy("x", "y").agg(F.sum("n").alias("n")))
    classes, totals = _clustered(pairs, rest, options)
    head_classes = {w: int(classes[k]) for w, k in head.items()}

    parts = chunks.select("words", "counts", "held", "lengths", "ids").mapInArrow(
        _contexts(share(spark, head_classes), n_classes), "word binary, n long, context binary")
    vocabulary = pinned(parts.repartition("word").sortWithinPartitions("word").mapInArrow(
        _assigned(share(spark, (head_classes, totals)), n_classes), "word binary, count long, class int"))
    # what a chunk cannot tell by itself: without a word for it, its own count is the corpus count and the class is RARE
    told = (chunks.select("chunk", "words", "counts").mapInArrow(_word_rows, "chunk long, number int, word binary, n long")
            .join(vocabulary, "word").where(f"count != n or class != {RARE}").select("chunk", "number", "count", "class")
            .groupBy("chunk").applyInArrow(_packed, "chunk long, word_number binary, word_count binary, word_class binary"))
    encoded = pinned(chunks.drop("words", "trained").join(told, "chunk", "left"))
    found = encoded.drop("docs", "absent").mapInArrow(
        _pair_counts(n_classes, lambda row: _known(row)[1]), "x long, y long, n long").groupBy("x", "y").agg(F.sum("n").alias("n"))
    return Trained(encoded, vocabulary, _matrix(found, n_classes), end_count)


def log_probabilities(docs: DataFrame, held_out: Column, text: str = "text", doc_id: str = "doc_id",
                      options: Options = Options()) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row; learns where not held_out.

    A null or empty text is a single end. If no row is there to learn from, every token is unknown and both scores are 0
    for each token in base_score (N = V = 0) and finite in score. A null doc_id stays null. Repeated rows
    count and are scored one by one; an empty table gives no rows; other columns are ignored.
    """
    model = trained(docs, held_out, text, doc_id, options)
    n_classes = FIXED + options.classes
    tokens, types = np.zeros(n_classes), np.zeros(n_classes)
    for r in model.vocabulary.groupBy("class").agg(F.sum("count").alias("n"), F.count("*").alias("types")).collect():
        tokens[r["class"]], types[r["class"]] = r.n, r.types
    tokens[END], types[END] = model.end_count, int(model.end_count > 0)
    train_tokens = int(tokens.sum())
    scorer = ClassModel(np.arange(n_classes), model.totals, tokens, types, RARE, options.smoothing,
                        train_tokens + int(types.sum()) + 1)
    return model.encoded.mapInArrow(_score(share(docs.sparkSession, (scorer, train_tokens, model.end_count))), SCORE_SCHEMA)


def _matrix(pairs: DataFrame, size: int) -> np.ndarray:
    """Counts of class pairs: at most one row for each pair comes to the driver."""
    out = np.zeros((size, size))
    for r in pairs.collect():
        out[r.x, r.y] = r.n
    return out


def information(totals: np.ndarray) -> float:
    """What a class says about the next, in nats over all bigrams: the likelihood but for what no class changes."""
    return float(_phi(totals).sum() - _phi(totals.sum(axis=1)).sum() - _phi(totals.sum(axis=0)).sum() + _phi(totals.sum()))


def _clustered(pairs: DataFrame, rest: int, options: Options) -> tuple[np.ndarray, np.ndarray]:
    """The class of every symbol and the class bigram counts: head words by exchange clustering, the rest in RARE."""
    spark, n_classes = pairs.sparkSession, FIXED + options.classes
    classes = np.array([END, *(FIXED + np.arange(rest - 1) % options.classes), RARE])
    # by word, so that each task folds its words' neighbours into classes before they are shuffled again
    sides = pinned(pairs.select(F.col("x").alias("word"), F.col("y").alias("other"), F.lit(1).alias("side"), "n").unionByName(
        pairs.select(F.col("y").alias("word"), F.col("x").alias("other"), F.lit(0).alias("side"), "n")).repartition("word"))

    def state(classes: np.ndarray) -> tuple[DataFrame, np.ndarray]:
        """(word, side, of, n, own): neighbours by class; and the class bigram counts."""
        table = F.broadcast(spark.createDataFrame([Row(other=s, of=int(c)) for s, c in enumerate(classes)], "other long, of long"))
        context = pinned(sides.join(table, "other").groupBy("word", "side", "of").agg(
            F.sum("n").alias("n"), F.sum(F.when(F.col("word") == F.col("other"), F.col("n")).otherwise(0)).alias("own")))
        own = table.withColumnsRenamed({"other": "word", "of": "x"})
        return context, _matrix(context.where("side = 1").join(own, "word").groupBy("x", F.col("of").alias("y"))
                                .agg(F.sum("n").alias("n")), n_classes)

    context, totals = state(classes)
    blocks, resting, reached = max(1, rest // 128), 2, [information(totals)]
    for round_ in range(options.rounds if rest > 1 else 0):
        # words that move at the same time do not see each other: some of them rest
        turn = F.pmod(F.xxhash64("word"), F.lit(resting)) == round_ % resting
        moved = (context.where(turn & F.col("word").between(1, rest - 1))
                 .withColumn("block", F.pmod(F.xxhash64("word", F.lit(round_)), F.lit(blocks)))
                 .groupBy("block").applyInArrow(_exchange(share(spark, (classes, totals))), "word long, class long"))
        tried = classes.copy()
        for r in moved.collect():
            tried[r.word] = r["class"]
        after = state(tried)
        if information(after[1]) < reached[-1]:
            resting, reached = resting * 2, reached[-1:]
            continue
        classes, (context, totals) = tried, after
        reached.append(information(totals))
        if len(reached) > resting and reached[-1] - reached[-1 - resting] <= options.tolerance * reached[-1]:
            break
    return classes, totals


def scored(docs: DataFrame, fold: int = 7, out: int = 2, text: str = "text", doc_id: str = "doc_id",
           options: Options = Options()) -> DataFrame:
    """`log_probabilities` with one fold of the ids held out."""
    return log_probabilities(docs, remainder(doc_id, fold) == out, text, doc_id, options)
