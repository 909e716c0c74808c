"""Brown class n-grams: exchange clustering in Spark, then smoothed scores of whole texts.

Tokens are words with A-Z in lower case, and one end after each text. All training words are counted
in Spark, in buckets whose number follows the bytes of the texts. Words with at least N / 2^18 of the N
training tokens are *head* items; by the pigeonhole principle there are never more than 2^18 of them, at
any size of the corpus, so their table may be broadcast. *Tail* words have fewer, but at least ``LEAST``
training tokens, and a class of their own as well; their counts and classes are only ever shuffled, by
bucket. Words below ``LEAST``, and unseen ones, belong to one of 4,096 *shapes* (kinds of characters and
a hash of the ending), which are items too.

Exchange clustering: the most frequent head items begin with a class each, the others in one class, and
tail words in that of their shape. A round counts, over all training tokens, the classes to the left and
right of every head item, and moves each to the class that gives these neighbours the highest likelihood
under the current class bigrams. All items move at once; counts are taken anew, and if the likelihood of
the training tokens fell, the round is taken back and rounds end. Then every tail word moves likewise,
once, by its neighbours in all training texts, and the class bigrams are counted a last time.

Probability of a word after a word of class d: P(c | d) P(item | c), where tail words are items of their
class, and for a word that stands below a shape, times P(word | shape). P(c | d) is interpolated with P(c); item counts are smoothed by half a
count; a shape gives a new word the weight of its number of seen words (Witten and Bell). As in the
base model all unseen words of a kind are one type. The sum over types is 1.

Defined results: a null text is empty, it has the end as its one token; a null id is hashed as the
empty string; very long texts are scored whole, one text being the least a task takes; repeated rows count and score each on their own; without training texts every
probability is that of the smoothing alone; an empty table gives an empty result. Only the named
columns are read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera_spark.llm import common

CLASSES = 64
ROUNDS = 3
ITEM_BITS = 18
SHAPES = 4096
END = SHAPES  # shapes are items 0 .. SHAPES - 1, then the end, then the frequent words
FIRST_WORD = SHAPES + 1
LEAST = 8  # training tokens from which a word has a class of its own
BLOCK_TOKENS = 1 << 20
BUCKET_BYTES = 16 << 20
MOST_BUCKETS = 1 << 17
COUNTER_WORDS = 400_000
INTERPOLATION = float(CLASSES)
HALF = 0.5
PUNCTUATION = bytes(b for b in range(33, 127) if not chr(b).isalnum())
TAIL = re.compile(rb"[" + re.escape(PUNCTUATION) + rb"]*\Z")


def shape(word: bytes) -> int:
    """Kinds of characters (digit, punctuation, beyond ASCII) and a hash of the ending."""
    bare = word.rstrip(PUNCTUATION)
    kinds = 4 * (not word.isascii()) + 2 * (len(word) != len(word.translate(None, PUNCTUATION))) + any(48 <= b < 58 for b in word)
    ending = bare[-3:] + word[len(bare) : len(bare) + 2]
    return kinds * (SHAPES // 8) + zlib.crc32(ending) % (SHAPES // 8)


def _bucket(word: bytes, buckets: int) -> int:
    return zlib.crc32(word) % buckets


def _batch(rows: list[tuple], kinds: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


WORDS = "bucket int, words binary, counts binary, total long, texts long"


def count_words(buckets: int):
    """Words of the training texts with their numbers, packed by bucket."""

    def flush(counter: Counter, texts: int) -> pa.RecordBatch:
        by_bucket: dict[int, list[bytes]] = {}
        for word in counter:
            by_bucket.setdefault(_bucket(word, buckets), []).append(word)
        rows = [(b, b" ".join(w), np.array([counter[x] for x in w], np.uint32).tobytes(), sum(counter[x] for x in w), 0) for b, w in by_bucket.items()]
        rows.append((0, b"", b"", 0, texts))
        return _batch(rows, [pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64()], _names(WORDS))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter: Counter = Counter()
        texts = 0
        for batch in batches:
            for text, held in zip(common.byte_column(batch, "text"), batch.column("held_out").to_pylist(), strict=True):
                if not held:
                    counter.update(common.lower_words(text))
                    texts += 1
                    if len(counter) > COUNTER_WORDS:
                        yield flush(counter, texts)
                        counter, texts = Counter(), 0
        yield flush(counter, texts)
        del counter
        common.trim()

    return count


VOCABULARY = "kind string, bucket int, word binary, shape int, count long, types long, words binary, counts binary"


def merge_words(head: int, least: int):
    """Of one bucket: head words, the other words packed, and the shapes' sums over the other words
    ("shape") and over those below ``least`` alone ("deep")."""
    kinds = [pa.string(), pa.int32(), pa.binary(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]

    def merge(table: pa.Table) -> pa.Table:
        total: Counter = Counter()
        for words, counts in zip(table.column("words").to_pylist(), table.column("counts").to_pylist(), strict=True):
            for word, n in zip(words.split(b" ") if words else (), np.frombuffer(counts, np.uint32).tolist(), strict=True):
                total[word] += n
        bucket = table.column("bucket")[0].as_py()
        rows = [("word", bucket, w, None, n, None, None, None) for w, n in total.items() if n >= head]
        rare = sorted(w for w, n in total.items() if n < head)
        sums: dict[tuple[str, int], list[int]] = {}
        for w in rare:
            for kind in ("shape", "deep") if total[w] < least else ("shape",):
                s = sums.setdefault((kind, shape(w)), [0, 0])
                s[0] += total[w]
                s[1] += 1
        rows += [(kind, bucket, None, k, n, types, None, None) for (kind, k), (n, types) in sums.items()]
        rows.append(("rare", bucket, None, None, sum(total[w] for w in rare), len(rare), b" ".join(rare), np.array([total[w] for w in rare], np.uint32).tobytes()))
        return pa.Table.from_batches([_batch(rows, kinds, _names(VOCABULARY))])

    return merge


ENCODED = "block long, doc_ids array<long>, held array<boolean>, lengths binary, items binary, rare binary, words binary"
ENCODED_KINDS = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), *[pa.binary()] * 4]


def encode_texts(words):
    """Blocks of texts as item numbers, and the block's distinct words below the head."""

    def flush(block: int, ids: list, held: list, lengths: list, items: list, rare: list, local: dict) -> pa.RecordBatch:
        whole = np.concatenate(items).astype(np.int32) if items else np.empty(0, np.int32)
        row = (block, ids, held, np.array(lengths, np.int32).tobytes(), whole.tobytes(), np.array(rare, np.uint32).tobytes(), b" ".join(local))
        return _batch([row], ENCODED_KINDS, _names(ENCODED))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = words.value.get
        context = TaskContext.get()
        block = (context.partitionId() if context else 0) << 24
        ids, held, lengths, items, rare, local, size = [], [], [], [], [], {}, 0
        for batch in batches:
            columns = (batch.column("doc_id").to_pylist(), batch.column("held_out").to_pylist(), common.byte_column(batch, "text"))
            for doc_id, out, text in zip(*columns, strict=True):
                found = common.lower_words(text)
                at = np.fromiter((get(w, -1) for w in found), np.int64, len(found))
                for k in np.flatnonzero(at < 0).tolist():
                    word = found[k]
                    known = local.get(word)
                    if known is None:
                        known = local[word] = (len(local), shape(word))
                    rare.append(known[0])
                    at[k] = known[1]
                ids.append(doc_id)
                held.append(out)
                lengths.append(len(found) + 1)
                items.append(np.append(at, END))
                size += len(found) + 1
                if size > BLOCK_TOKENS:
                    yield flush(block, ids, held, lengths, items, rare, local)
                    block += 1
                    ids, held, lengths, items, rare, local, size = [], [], [], [], [], {}, 0
        if ids:
            yield flush(block, ids, held, lengths, items, rare, local)
        del items, rare, local
        common.trim()

    return encode


def _training(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(previous item, item) of the training tokens of each block; before the first is an end."""
    for held, lengths, items in zip(*(batch.column(c).to_pylist() for c in ("held", "lengths", "items")), strict=True):
        lengths, items = np.frombuffer(lengths, np.int32), np.frombuffer(items, np.int32).astype(np.int64)
        before = np.concatenate([[END], items[:-1]])  # the item before a text is the end of another
        use = np.repeat(~np.array(held, bool), lengths)
        yield before[use], items[use]


ASKED = "bucket int, block long, words binary, rids binary, codes binary, seen binary"


def ask(buckets: int, classes):
    """A block's questions for its words below the head, by bucket, with the classes around them in the
    block's training texts: a code is place of the word in the question x 2C + class, plus C for classes
    after it."""
    kinds = [pa.int32(), pa.int64(), *[pa.binary()] * 4]

    def questions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        class_of = classes.value.astype(np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                if not row["words"]:
                    continue
                words = row["words"].split(b" ")
                items = np.frombuffer(row["items"], np.int32).astype(np.int64)
                used = np.repeat(~np.array(row["held"], bool), np.frombuffer(row["lengths"], np.int32))
                at = np.flatnonzero(items < SHAPES)
                rid = np.frombuffer(row["rare"], np.uint32).astype(np.int64)
                at, rid = at[used[at]], rid[used[at]]
                around = class_of[np.concatenate([[END], items])]  # an end is the last token of every text
                codes = np.concatenate([rid * (2 * CLASSES) + around[at], rid * (2 * CLASSES) + CLASSES + around[at + 2]])
                codes, seen = np.unique(codes, return_counts=True)
                bucket = np.fromiter((_bucket(w, buckets) for w in words), np.int64, len(words))
                order = np.argsort(bucket, kind="stable")
                place = np.empty(len(words), np.int64)
                groups = np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1)
                for g in groups:
                    place[g] = np.arange(len(g))
                owner = codes // (2 * CLASSES)
                codes = place[owner] * (2 * CLASSES) + codes % (2 * CLASSES)
                owner = bucket[owner]
                by = np.argsort(owner, kind="stable")
                first = np.searchsorted(owner[by], [bucket[g[0]] for g in groups])
                last = np.searchsorted(owner[by], [bucket[g[0]] for g in groups], "right")
                rows = [
                    (int(bucket[g[0]]), row["block"], b" ".join(words[i] for i in g), g.astype(np.uint32).tobytes(), codes[by[i:j]].astype(np.uint32).tobytes(), seen[by[i:j]].astype(np.uint32).tobytes())
                    for g, i, j in zip(groups, first, last, strict=True)
                ]
                yield _batch(rows, kinds, _names(ASKED))
        common.trim()

    return questions


ANSWERED = "kind string, block long, rids binary, counts binary, classes binary, c int, n long, members long"


def answer(classes, bigrams: np.ndarray, least: int):
    """In one bucket: tail words find their class; counts and classes (-1: below a shape) of the words
    that blocks ask for; and tokens and words of the tail by class."""
    kinds = [pa.string(), pa.int64(), *[pa.binary()] * 3, pa.int32(), *[pa.int64()] * 2]

    def reply(table: pa.Table) -> pa.Table:
        known: dict[bytes, int] = {}
        for words, counts in zip(table.column("words").to_pylist(), table.column("counts").to_pylist(), strict=True):
            if counts is not None and words:
                known.update(zip(words.split(b" "), np.frombuffer(counts, np.uint32).tolist(), strict=True))
        tail = {w: k for k, w in enumerate(w for w, n in known.items() if n >= least)}
        grid = np.zeros((len(tail) + 1) * 2 * CLASSES, np.int64)  # the last line takes all other words
        asked = []
        for row in table.filter(table.column("block").is_valid()).select(["block", "words", "rids", "codes", "seen"]).to_pylist():
            words = row["words"].split(b" ")
            place = np.fromiter((tail.get(w, len(tail)) for w in words), np.int64, len(words))
            codes = np.frombuffer(row["codes"], np.uint32).astype(np.int64)
            np.add.at(grid, place[codes // (2 * CLASSES)] * (2 * CLASSES) + codes % (2 * CLASSES), np.frombuffer(row["seen"], np.uint32))
            asked.append((row["block"], row["rids"], np.fromiter((known.get(w, 0) for w in words), np.uint32, len(words)), place))
        grid = grid.reshape(-1, 2 * CLASSES)[:-1]
        own = classes.value[np.fromiter((shape(w) for w in tail), np.int64, len(tail))]
        best = best_classes(bigrams, grid[:, :CLASSES], grid[:, CLASSES:], own).astype(np.int8)
        told = np.append(best, np.int8(-1))
        rows = [("answer", block, rids, counts.tobytes(), told[place].tobytes(), None, None, None) for block, rids, counts, place in asked]
        n = np.bincount(best, np.fromiter((known[w] for w in tail), np.int64, len(tail)), CLASSES)
        members = np.bincount(best, minlength=CLASSES)
        rows += [("class", None, None, None, None, c, int(n[c]), int(members[c])) for c in np.flatnonzero(members).tolist()]
        return pa.Table.from_batches([_batch(rows, kinds, _names(ANSWERED))])

    return reply


NEIGHBOURS = "bucket int, codes binary, counts binary"
STATS = "kind string, bucket int, items binary, left binary, right binary, d int, c int, n long"


def count_neighbours(buckets: int, classes):
    """For each item the classes before and after it, summed over the task, packed by bucket.
    A code is item x 2C + class, plus C for classes after it."""

    def flush(parts: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        codes, where = np.unique(np.concatenate(parts), return_inverse=True)
        return codes, np.bincount(where, np.concatenate(counts), len(codes)).astype(np.int64)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        class_of = classes.value.astype(np.int64)
        codes, counts = np.empty(0, np.int64), np.empty(0, np.int64)
        for batch in batches:
            for before, item in _training(batch):
                left, a = np.unique(item * (2 * CLASSES) + class_of[before], return_counts=True)
                right, b = np.unique(before * (2 * CLASSES) + CLASSES + class_of[item], return_counts=True)
                codes, counts = flush([codes, left, right], [counts, a, b])
        bucket = codes // (2 * CLASSES) % buckets
        order = np.argsort(bucket, kind="stable")
        rows = [
            (int(bucket[p[0]]), codes[p].astype(np.int32).tobytes(), counts[p].astype(np.uint32).tobytes())
            for p in (np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1) if len(order) else [])
        ]
        yield _batch(rows, [pa.int32(), pa.binary(), pa.binary()], _names(NEIGHBOURS))

    return count


def sum_neighbours(classes):
    """One bucket's items with dense counts of left and right classes, and their share of the class
    bigrams."""
    kinds = [pa.string(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.int32(), pa.int32(), pa.int64()]

    def total(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        codes = np.frombuffer(b"".join(table.column("codes").to_pylist()), np.int32).astype(np.int64)
        counts = np.frombuffer(b"".join(table.column("counts").to_pylist()), np.uint32).astype(np.int64)
        items, at = np.unique(codes // (2 * CLASSES), return_inverse=True)
        grid = np.bincount(at * (2 * CLASSES) + codes % (2 * CLASSES), counts, len(items) * 2 * CLASSES).astype(np.int64).reshape(-1, 2 * CLASSES)
        bigrams = np.zeros((CLASSES, CLASSES), np.int64)
        np.add.at(bigrams.T, classes.value[items], grid[:, :CLASSES])
        rows = [("items", bucket, items.tobytes(), np.ascontiguousarray(grid[:, :CLASSES]).tobytes(), np.ascontiguousarray(grid[:, CLASSES:]).tobytes(), None, None, None)]
        rows += [("bigram", bucket, None, None, None, d, c, int(bigrams[d, c])) for d, c in zip(*(x.tolist() for x in np.nonzero(bigrams)), strict=True)]
        return pa.Table.from_batches([_batch(rows, kinds, _names(STATS))])

    return total


def best_classes(bigrams: np.ndarray, left: np.ndarray, right: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Class of the highest likelihood of each item's neighbours; of equals its own, then the lowest."""
    size = bigrams.sum(axis=0) + bigrams.sum(axis=1)
    into = np.log((bigrams + 0.01) / (bigrams.sum(axis=0) + 0.01 * CLASSES))
    out = np.log((bigrams + 0.01) / (bigrams.sum(axis=1, keepdims=True) + 0.01 * CLASSES))
    gain = left @ into + right @ out.T
    gain[:, size == 0] = -np.inf
    best = np.argmax(gain, axis=1)
    stay = gain[np.arange(len(own)), own] >= gain[np.arange(len(own)), best]
    return np.where(stay, own, best)


@dataclass
class Model:
    """All numbers the scoring needs, as base-10 logarithms where they are probabilities."""

    n: int
    v: int
    class_of: np.ndarray
    transition: np.ndarray
    emission: np.ndarray
    item_counts: np.ndarray
    shape_counts: np.ndarray
    shape_types: np.ndarray
    weights: np.ndarray


def make_model(n: int, v: int, class_of: np.ndarray, bigrams: np.ndarray, item_counts: np.ndarray, shape_counts: np.ndarray, shape_types: np.ndarray, tail: np.ndarray | None = None) -> Model:
    """``tail``: tokens and words of the tail by class."""
    tail = np.zeros((2, CLASSES), np.int64) if tail is None else tail
    sizes = np.bincount(class_of, item_counts, CLASSES) + tail[0]
    members = np.bincount(class_of, minlength=CLASSES) + tail[1]
    alone = (sizes + 1) * (members > 0)
    alone = alone / alone.sum()
    transition = (bigrams + INTERPOLATION * alone) / (bigrams.sum(axis=1, keepdims=True) + INTERPOLATION)
    weights = sizes + HALF * members
    with np.errstate(divide="ignore"):
        emission = np.log10((item_counts + HALF) / weights[class_of])
        return Model(n, v, class_of, np.log10(transition), emission, item_counts, shape_counts, shape_types, np.log10(weights))


PLACED = "kind string, doc_ids array<long>, held array<boolean>, lengths binary, known binary, base binary, emitted binary, classes binary, d int, c int, n long"
PLACED_KINDS = [pa.string(), pa.list_(pa.int64()), pa.list_(pa.bool_()), *[pa.binary()] * 5, *[pa.int32()] * 2, pa.int64()]


def place_block(model):
    """A block's texts as classes, with all sums that need no transitions, and its class bigrams."""

    def place(table: pa.Table) -> pa.Table:
        m: Model = model.value
        is_block = table.column("items").is_valid()
        row = table.filter(is_block).to_pylist()[0]
        lengths = np.frombuffer(row["lengths"], np.int32)
        items = np.frombuffer(row["items"], np.int32).astype(np.int64)
        rare = np.frombuffer(row["rare"], np.uint32)
        answers = np.zeros(int(rare.max(initial=0)) + 1, np.int64)
        own = np.full(len(answers), -1, np.int64)
        for part in table.filter(pc.invert(is_block)).select(["rids", "counts", "classes"]).to_pylist():
            rids = np.frombuffer(part["rids"], np.uint32)
            answers[rids] = np.frombuffer(part["counts"], np.uint32)
            own[rids] = np.frombuffer(part["classes"], np.int8)
        below = np.flatnonzero(items < SHAPES)
        count = m.item_counts[items]
        count[below] = answers[rare]
        base = np.log10((count + 0.1) / (m.n + 0.1 * (m.v + 1)))
        classes, value = m.class_of[items], m.emission[items]
        is_tail = own[rare] >= 0
        tail, deep, seen = below[is_tail], below[~is_tail], answers[rare][~is_tail]
        classes[tail] = own[rare][is_tail]
        value[tail] = np.log10(count[tail] + HALF) - m.weights[classes[tail]]
        kind = items[deep]
        new = np.maximum(m.shape_types[kind], 1)
        value[deep] += np.log10(np.where(seen > 0, seen, new) / (m.shape_counts[kind] + new))
        begin = np.cumsum(lengths) - lengths
        known, base, value = (np.add.reduceat(x, begin).tobytes() for x in ((count > 0).astype(np.int64), base, value))
        rows = [("block", row["doc_ids"], row["held"], row["lengths"], known, base, value, classes.astype(np.int8).tobytes(), None, None, None)]
        used = np.repeat(~np.array(row["held"], bool), lengths)
        before = np.concatenate([[m.class_of[END]], classes[:-1]])
        pairs = np.bincount(before[used] * CLASSES + classes[used], minlength=CLASSES * CLASSES)
        rows += [("bigram", *(None,) * 7, k // CLASSES, k % CLASSES, int(pairs[k])) for k in np.flatnonzero(pairs).tolist()]
        return pa.Table.from_batches([_batch(rows, PLACED_KINDS, _names(PLACED))])

    return place


SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def score_blocks(model):
    """Scores of texts: what was summed, and the transitions between their classes."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = model.value
        for batch in batches:
            for row in batch.to_pylist():
                lengths = np.frombuffer(row["lengths"], np.int32)
                classes = np.frombuffer(row["classes"], np.int8).astype(np.int64)
                steps = m.transition[np.concatenate([[m.class_of[END]], classes[:-1]]), classes]
                total = np.frombuffer(row["emitted"]) + np.add.reduceat(steps, np.cumsum(lengths) - lengths)
                columns = [
                    pa.array(row["doc_ids"], pa.int64()), pa.array(row["held"], pa.bool_()), pa.array(lengths.astype(np.int64)),
                    pa.array(np.frombuffer(row["known"], np.int64)), pa.array(np.frombuffer(row["base"])), pa.array(total),
                ]
                yield pa.RecordBatch.from_arrays(columns, _names(SCORED))

    return score


def likelihood(bigrams: np.ndarray) -> float:
    """Log-likelihood of the training tokens under a partition, but for what depends on words alone."""

    def entropy(x: np.ndarray) -> float:
        x = x[x > 0]
        return float((x * np.log(x)).sum())

    return entropy(bigrams.ravel()) - entropy(bigrams.sum(axis=0)) - entropy(bigrams.sum(axis=1))


def class_bigrams(stats: DataFrame) -> np.ndarray:
    """The C x C class bigrams, summed in Spark."""
    out = np.zeros((CLASSES, CLASSES))
    for r in stats.filter("kind = 'bigram'").groupBy("d", "c").agg(F.sum("n").alias("n")).collect():
        out[r["d"], r["c"]] = r["n"]
    return out


def exchange(blocks: DataFrame, item_counts: np.ndarray, buckets: int, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Classes of all items after the given rounds, and the class bigrams of the training tokens."""
    spark = blocks.sparkSession
    classes = np.full(len(item_counts), CLASSES - 1, np.int64)
    order = np.lexsort((np.arange(len(item_counts)), -item_counts))
    classes[order[: CLASSES - 1]] = np.arange(min(CLASSES - 1, len(order)))
    best = None
    for turn in range(rounds + 1):
        told = spark.sparkContext.broadcast(classes)
        near = blocks.mapInArrow(count_neighbours(buckets, told), NEIGHBOURS).groupBy("bucket").applyInArrow(sum_neighbours(told), STATS)
        stats = common.stored(near, "neighbours")
        bigrams = class_bigrams(stats)
        reached = likelihood(bigrams)
        if best is not None and reached < best[0]:
            common.discard(stats)
            break
        best = (reached, classes, bigrams)
        if turn == rounds:
            common.discard(stats)
            break

        def move(batches: Iterator[pa.RecordBatch], told=told, bigrams=bigrams) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                items, best = [], []
                for i, x, y in zip(*(batch.column(c).to_pylist() for c in ("items", "left", "right")), strict=True):
                    i = np.frombuffer(i, np.int64)
                    x, y = (np.frombuffer(b, np.int64).reshape(-1, CLASSES) for b in (x, y))
                    items.append(i)
                    best.append(best_classes(bigrams, x, y, told.value[i]))
                whole = [np.concatenate(p) if p else np.empty(0, np.int64) for p in (items, best)]
                yield pa.RecordBatch.from_arrays([pa.array(p) for p in whole], ["item", "class"])

        # Bounded: one row per item, of which there are at most 2^18 + 4,097.
        moved = stats.filter("kind = 'items'").select("items", "left", "right").mapInArrow(move, "item long, class long").toArrow()
        classes = classes.copy()
        classes[moved.column("item").to_numpy()] = moved.column("class").to_numpy()
        common.discard(stats)
    return best[1], best[2]


def score_texts(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, one row per input row."""
    spark = docs.sparkSession
    common.prepared(spark)
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        (F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 10 == 0).alias("held_out"),
        F.col(text).alias("text"),
    )
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = min(MOST_BUCKETS, max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES)))
    counted = common.stored(rows.select("held_out", "text").mapInArrow(count_words(buckets), WORDS), "word-counts")
    sums = counted.agg(F.sum("total").alias("words"), F.sum("texts").alias("texts")).first()
    texts = sums["texts"] or 0
    n = (sums["words"] or 0) + texts
    head = max(1, -(-n >> ITEM_BITS))
    merged = counted.filter(F.length("words") > 0).select("bucket", "words", "counts").groupBy("bucket").applyInArrow(merge_words(head, LEAST), VOCABULARY)
    vocabulary = common.stored(merged, "vocabulary")
    common.release(spark)
    frequent = vocabulary.filter("kind = 'word'").select("word", "count").toArrow()  # at most 2^18 rows
    pairs = sorted(zip(frequent.column("word").to_pylist(), frequent.column("count").to_pylist(), strict=True))
    item_counts = np.zeros(FIRST_WORD + len(pairs), np.int64)
    sums = {kind: np.zeros((2, SHAPES), np.int64) for kind in ("shape", "deep")}
    for r in vocabulary.filter("kind IN ('shape', 'deep')").groupBy("kind", "shape").agg(F.sum("count").alias("count"), F.sum("types").alias("types")).collect():
        sums[r["kind"]][:, r["shape"]] = r["count"], r["types"]
    item_counts[:SHAPES] = sums["shape"][0]
    item_counts[END] = texts
    item_counts[FIRST_WORD:] = [c for _, c in pairs]
    v = len(pairs) + int(sums["shape"][1].sum()) + (texts > 0)
    words = spark.sparkContext.broadcast({w: FIRST_WORD + k for k, (w, _) in enumerate(pairs)})

    blocks = common.stored(rows.mapInArrow(encode_texts(words), ENCODED), "encoded")
    common.discard(counted)
    classes, bigrams = exchange(blocks.select("held", "lengths", "items"), item_counts, buckets, rounds)

    none = F.lit(None)
    told = spark.sparkContext.broadcast(classes)
    asked = blocks.select("block", "held", "lengths", "items", "rare", "words").mapInArrow(ask(buckets, told), ASKED).withColumn("counts", none.cast("binary"))
    rare = vocabulary.filter("kind = 'rare'").select("bucket", none.cast("long").alias("block"), "words", *(none.cast("binary").alias(c) for c in ("rids", "codes", "seen")), "counts")
    answers = common.stored(asked.unionByName(rare).groupBy("bucket").applyInArrow(answer(told, bigrams, LEAST), ANSWERED), "answers")
    tail = np.zeros((2, CLASSES), np.int64)
    for r in answers.filter("kind = 'class'").groupBy("c").agg(F.sum("n").alias("n"), F.sum("members").alias("members")).collect():
        tail[:, r["c"]] = r["n"], r["members"]
    item_counts[:SHAPES] = sums["deep"][0]
    common.discard(vocabulary)

    def model(bigrams: np.ndarray):
        return spark.sparkContext.broadcast(make_model(n, v, classes, bigrams, item_counts, *sums["deep"], tail))

    left = blocks.select("block", "doc_ids", "held", "lengths", "items", "rare", *(none.cast("binary").alias(c) for c in ("rids", "counts", "classes")))
    right = answers.filter("kind = 'answer'").select(
        "block", none.cast("array<long>").alias("doc_ids"), none.cast("array<boolean>").alias("held"), *(none.cast("binary").alias(c) for c in ("lengths", "items", "rare")), "rids", "counts", "classes"
    )
    placed = common.stored(left.unionByName(right).groupBy("block").applyInArrow(place_block(model(bigrams)), PLACED), "placed")
    common.discard(blocks, answers)
    scored = placed.filter("kind = 'block'").select("doc_ids", "held", "lengths", "known", "base", "emitted", "classes").mapInArrow(score_blocks(model(class_bigrams(placed))), SCORED)
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")
