"""Benchmark decontamination by CGK embedding and bit-sampling LSH.

An item of n words is leaked by a document if some run of the document's words is within
``K = n // 5`` word edits of it (words compared with A-Z in lower case).

Windows of an item's length are embedded by a random walk (Chakraborty, Goldenberg, Koucký 2016): in
each of 3n steps the word under a pointer is written down, and a random bit of (step, word) says
whether the pointer moves on, so that sequences which differ by few edits are soon written in step
again. Edit distance becomes Hamming distance; sampled positions of the written sequence are the
keys of an LSH. The number of walks is chosen so that pairs at distance K, simulated on the items
themselves, are found with the target recall. What shares a key is verified by exact edit distance.

Windows are laid only where they can matter: K edits leave a run of ``(n - K) / (K + 1)`` words of the
item whole, so a window that has no such run of any item (up to 4 words) cannot be within K. This
skips windows, never a match.

Items are collected in blocks of bounded size, each one broadcast and compared with all documents.

Defined results: null or wordless texts and items match nothing; items of fewer than five words
match exactly only; a null id is returned as it is; repeated rows are each reported; equal items
are each reported; empty tables give an empty result. Only the named columns are read.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera_spark.llm import common

TARGET_RECALL = 0.97
MOST_WALKS = 64
ITEM_BLOCK_BYTES = 16 << 20
PAD = -1


def allowed_edits(n: int) -> int:
    return n // 5


def whole_run(n: int) -> int:
    """Length of a run that K edits must leave whole, at most 4."""
    k = allowed_edits(n)
    return min(4, max(1, -(-(n - k) // (k + 1))))


@dataclass
class Items:
    """A block of items as arrays: what every task needs."""

    ids: list
    words: list[np.ndarray]
    vocabulary: dict[bytes, int]
    walks: int = 0
    samples: int = 0
    seed: int = 11
    runs: dict[int, tuple] = field(default_factory=dict)
    keys: dict[int, list[dict[int, list[int]]]] = field(default_factory=dict)

    @property
    def longest(self) -> int:
        return max((len(w) for w in self.words), default=0)


def read_items(rows) -> Items:
    vocabulary: dict[bytes, int] = {}
    ids, words = [], []
    for item_id, text in rows:
        found = common.lower_words(text.encode() if text else None)
        if found:
            ids.append(item_id)
            words.append(np.array([vocabulary.setdefault(w, len(vocabulary) + 1) for w in found], np.int64))
    return Items(ids, words, vocabulary)


def _bits(items: Items, walk: int, step: int, symbols: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        salt = np.uint64(((items.seed * 1_000_003 + walk) * 1_000_003 + step) & ((1 << 64) - 1))
        return (common.mixed(symbols.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + salt) >> np.uint64(63)).astype(np.int64)


def embedded_keys(items: Items, walk: int, symbols: np.ndarray, start: np.ndarray, stop: np.ndarray, n: np.ndarray) -> np.ndarray:
    """LSH key of each window: ``n`` words from ``start``, padded beyond ``stop``."""
    draw = np.random.default_rng((items.seed, walk)).random(items.samples)
    wanted = np.floor(draw[:, None] * 3 * n).astype(np.int64)
    at = np.zeros(len(start), np.int64)
    key = n.astype(np.uint64)
    with np.errstate(over="ignore"):
        for step in range(int(wanted.max(initial=-1)) + 1):
            place = start + at
            inside = (at < n) & (place < stop)
            symbol = np.where(inside, symbols[np.where(inside, place, 0)], PAD)
            for k in range(items.samples):
                hit = wanted[k] == step
                if hit.any():
                    key[hit] = common.mixed(key[hit] * np.uint64(31) + symbol[hit].astype(np.uint64) + np.uint64(k + 2))
            at += _bits(items, walk, step, symbol)
    return key


def _edited(words: np.ndarray, edits: int, rng) -> np.ndarray:
    out = words.tolist()
    for _ in range(edits):
        kind, at = rng.integers(3), int(rng.integers(max(len(out), 1)))
        if kind == 0 and out:
            out[at] = 0
        elif kind == 1 and len(out) > 1:
            del out[at]
        else:
            out.insert(at, 0)
    return np.array(out, np.int64)


def calibrate(items: Items, target: float = TARGET_RECALL) -> None:
    """Number of sampled positions and of walks: the most selective choice that finds simulated
    pairs at the full distance with the target recall."""
    rng = np.random.default_rng(items.seed)
    chosen = rng.permutation(len(items.words))[:48]
    pairs = [(items.words[k], _edited(items.words[k], allowed_edits(len(items.words[k])), rng)) for k in chosen]
    left = np.concatenate([np.concatenate([a, b]) for a, b in pairs])
    n = np.array([len(a) for a, _ in pairs])
    begin = np.cumsum([0, *(len(a) + len(b) for a, b in pairs)])[:-1]
    second = np.array([len(b) for _, b in pairs])
    for samples in (4, 3, 2, 1):
        items.samples = samples
        same = np.zeros((MOST_WALKS, len(pairs)), bool)
        for walk in range(MOST_WALKS):
            a = embedded_keys(items, walk, left, begin, begin + n, n)
            b = embedded_keys(items, walk, left, begin + n, begin + n + second, n)
            same[walk] = a == b
        found = np.logical_or.accumulate(same, axis=0).mean(axis=1)
        enough = np.flatnonzero(found >= target)
        if len(enough) and enough[0] < MOST_WALKS // 2 or samples == 1:
            # Half as many walks again, since the pairs that set the number are few.
            first = int(enough[0]) + 1 if len(enough) else MOST_WALKS
            items.walks = min(MOST_WALKS, first + math.ceil(first / 2))
            return


def build_index(items: Items) -> Items:
    """Runs of words to item and offset, and LSH tables by walk."""
    if not items.words:
        return items
    calibrate(items)
    found: dict[int, dict[int, list[tuple[int, int]]]] = defaultdict(lambda: defaultdict(list))
    for k, words in enumerate(items.words):
        q = whole_run(len(words))
        for offset, code in enumerate(run_codes(words, q).tolist()):
            found[q][code].append((k, offset))
    for q, table in found.items():
        codes = np.array(sorted(table), np.uint64)
        lists = [table[c] for c in codes.tolist()]
        begin = np.cumsum([0, *map(len, lists)])
        flat = np.array([x for each in lists for x in each], np.int64)
        items.runs[q] = (codes, begin, flat[:, 0], flat[:, 1])
    whole = np.concatenate(items.words)
    n = np.array([len(w) for w in items.words])
    begin = np.cumsum(n) - n
    for walk in range(items.walks):
        table: dict[int, list[int]] = defaultdict(list)
        for k, key in enumerate(embedded_keys(items, walk, whole, begin, begin + n, n).tolist()):
            table[key].append(k)
        items.keys[walk] = [dict(table), np.array(sorted(table), np.uint64)]
    return items


def run_codes(symbols: np.ndarray, q: int) -> np.ndarray:
    n = len(symbols) - q + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        code = symbols[:n].astype(np.uint64)
        for k in range(1, q):
            code = common.mixed(code * np.uint64(0x9E3779B97F4A7C15) + symbols[k : k + n].astype(np.uint64))
    return code


def best_match(item: np.ndarray, region: np.ndarray) -> tuple[int, int, int]:
    """(edits, start, stop): the run of the region nearest to the item; of equals the first to end,
    from its latest start."""
    m = len(region)
    steps = np.arange(m + 1)
    cost = np.zeros(m + 1, np.int64)
    origin = steps.copy()
    big = 1 << 20
    for word in item:
        # One number per cell: edits first, then the later start.
        packed = cost * big - origin
        replace = packed[:-1] + (region != word) * big
        best = np.minimum(np.concatenate([[packed[0] + big], replace]), np.concatenate([[packed[0] + big], packed[1:] + big]))
        best = np.minimum.accumulate(best - steps * big) + steps * big
        cost = -(-best // big)
        origin = cost * big - best
    stop = int(np.argmin(cost))
    return int(cost[stop]), int(origin[stop]), stop


def find_leaks(items: Items, documents: list[list[bytes]]) -> list[tuple[int, int, int, int, int]]:
    """(document, item, start, stop, edits) for all word lists; places are word numbers."""
    get = items.vocabulary.get
    lengths = np.array([len(w) for w in documents], np.int64)
    begin = np.cumsum(lengths + 1) - lengths - 1
    symbols = np.zeros(int((lengths + 1).sum()), np.int64)
    for words, b in zip(documents, begin.tolist(), strict=True):
        symbols[b : b + len(words)] = [get(w, 0) for w in words]
    n_of = np.array([len(w) for w in items.words], np.int64)
    starts, sizes, owner = [], [], []
    for q, (codes, first, item, offset) in items.runs.items():
        known = symbols > 0
        full = known[: len(known) - q + 1].copy()
        for k in range(1, q):
            full &= known[k : len(known) - q + 1 + k]
        at = np.flatnonzero(full)
        if not len(at):
            continue
        code = run_codes(symbols, q)[at]
        where = np.searchsorted(codes, code)
        hit = codes[np.minimum(where, len(codes) - 1)] == code
        at, where = at[hit], where[hit]
        many = first[where + 1] - first[where]
        flat = np.repeat(first[where] - (np.cumsum(many) - many), many) + np.arange(many.sum())
        begins = np.repeat(at, many) - offset[flat]
        size = n_of[item[flat]]
        doc = np.searchsorted(begin, np.repeat(at, many), side="right") - 1
        wide = allowed_edits(size.max(initial=0))
        for shift in range(-wide, wide + 1):
            fits = np.abs(shift) <= size // 5
            starts.append(np.maximum(begins + shift, begin[doc])[fits])
            sizes.append(size[fits])
            owner.append(doc[fits])
    if not starts:
        return []
    windows = np.unique(np.stack([np.concatenate(owner), np.concatenate(sizes), np.concatenate(starts)]), axis=1)
    doc, n, start = windows
    stop = (begin + lengths)[doc]
    candidates: dict[tuple[int, int], list[int]] = defaultdict(list)
    for walk in range(items.walks):
        table, sorted_keys = items.keys[walk]
        keys = embedded_keys(items, walk, symbols, start, stop, n)
        for k in np.flatnonzero(np.isin(keys, sorted_keys)).tolist():
            for item in table[int(keys[k])]:
                candidates[(int(doc[k]), item)].append(int(start[k]))
    out = []
    for (d, item), found in candidates.items():
        size = len(items.words[item])
        allowed = allowed_edits(size)
        low, high = int(begin[d]), int(begin[d] + lengths[d])
        end = -1
        regions: list[list[int]] = []
        for s in sorted(set(found)):
            if regions and s - allowed <= regions[-1][1]:
                regions[-1][1] = s + size + allowed
            else:
                regions.append([s - allowed, s + size + allowed])
        for a, b in regions:
            a, b = max(a, low, end), min(b, high)
            while b - a >= size - allowed:  # a region may hold the item more than once
                edits, x, y = best_match(items.words[item], symbols[a:b])
                if edits > allowed:
                    break
                out.append((d, item, a + x - low, a + y - low, edits))
                # What lies before the match is searched by the same rule.
                out += _before(items.words[item], symbols, a, a + x, allowed, d, item, low)
                a = end = max(a + y, a + 1)
    return out


def _before(words, symbols, a, b, allowed, d, item, low) -> list[tuple[int, int, int, int, int]]:
    out = []
    while b - a >= len(words) - allowed:
        edits, x, y = best_match(words, symbols[a:b])
        if edits > allowed:
            break
        out.append((d, item, a + x - low, a + y - low, edits))
        b = a + x
    return out


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """row_id, doc_id, item_id, start_word, stop_word (exclusive), edits for every leaked item.
    ``row_id`` tells apart rows that repeat a doc_id; it holds within one run."""
    spark = docs.sparkSession
    common.prepared(spark)
    rows = docs.select(
        F.monotonically_increasing_id().alias("row_id"), F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")
    )
    items = benchmark.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).alias("text"))
    volume = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(volume / ITEM_BLOCK_BYTES))
    numbered = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    found = None
    for block in range(blocks):
        part = numbered.filter(F.col("block") == block).select("item_id", "text").collect()
        part.sort(key=lambda r: (r["item_id"] is not None, r["item_id"] or 0, r["text"] or ""))
        index = spark.sparkContext.broadcast(build_index(read_items((r["item_id"], r["text"]) for r in part)))

        def search(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            known = index.value
            for batch in batches:
                documents = [common.lower_words(t) for t in common.byte_column(batch, "text")]
                hits = find_leaks(known, documents) if known.words and documents else []
                row = pa.array([h[0] for h in hits], pa.int64())
                columns = [
                    batch.column("row_id").take(row),
                    batch.column("doc_id").take(row),
                    pa.array([known.ids[h[1]] for h in hits], pa.int64()),
                    *(pa.array([h[k] for h in hits], pa.int32()) for k in (2, 3, 4)),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["row_id", "doc_id", "item_id", "start_word", "stop_word", "edits"])

        each = rows.mapInArrow(search, "row_id long, doc_id long, item_id long, start_word int, stop_word int, edits int")
        found = each if found is None else found.unionByName(each)
    return found


def decontaminated(docs: DataFrame, benchmark: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The input's rows, all columns as they are, without those that leak an item. Rows whose id is
    null are judged by their own texts too: a row is dropped by its number, not by its id."""
    numbered = common.stored(docs.select(F.monotonically_increasing_id().alias("own_row"), F.struct("*").alias("row")), "numbered")
    slim = numbered.select("own_row", F.col(f"row.{text}").alias("text"))
    hits = common.stored(leaks(slim, benchmark, doc_id="own_row").select(F.col("doc_id").alias("own_row")).distinct(), "leaked")
    return numbered.join(common.small_or_plain(hits), "own_row", "left_anti").select("row.*")
