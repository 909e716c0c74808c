"""Substring deduplication by compact windows.

A text is the sequence of its 5-word shingles. Under one hash function the Cartesian tree of the
shingles' hashes gives compact windows (l, c, r): every run from l..c to c..r has its smallest hash
at c. Windows too narrow for a passage are never made. Cut down to runs of exactly ``PASSAGE`` words,
the windows of one function divide the places where such a run can begin; an interval join of the
divisions of two functions gives pieces whose runs all share both minima, the piece's signature.
Two passages of Jaccard similarity J share a signature with chance J² per pair of functions; equal
passages always do.

Texts that share a signature are linked to one of them, first inside a block of texts, then, by its
representative, across blocks, so a passage that a third of all texts hold is never gathered in one
task. Each linked pair is then verified on the shingles around the shared places: a passage is kept if
both sides have ``PASSAGE`` words or more and their shingle sets reach the similarity.

A place whose comparison failed is open: its text and the representative share the minima, but no
passage around them. Open places are compared with all texts of their signature, first inside a chunk of
these, then, if none was found there, with the other chunks. In a chunk an open place that is found similar
to another is linked to it and needs no comparisons of its own, so the representatives only save work.

Equal texts are one node: they repeat as a whole if they have ``PASSAGE`` words.

Defined results: a null text has no words; a null id is returned as it is; repeated rows repeat each
other; texts of fewer words than a passage have none; of ties the smaller key represents; an empty
table gives an empty result. Only the named columns are read. Two different texts with the same 64-bit
hash would be taken for one.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera_spark.llm import common

SHINGLE = 5
PASSAGE = 50
RUN = PASSAGE - SHINGLE + 1
SIMILARITY_PERCENT = 75
#: Pairs of hash functions: a passage at the similarity is found with 1 - (1 - 0.75²)³ = 0.916 per run.
BANDS = ((1, 2), (3, 4), (5, 6))
BLOCK_SHINGLES = 1 << 19
#: Texts of a signature with open places are compared in chunks of so many.
CHUNK_MEMBERS = 1 << 13
#: A shingle that no more texts of a chunk hold is rare there; any number gives the same passages.
RARE_TEXTS = 8
#: So many stretches are compared without asking which may be similar.
FEW = 6
#: So many stretches are all tried, without an index of their rare shingles.
INDEXED = 64
#: Shingles that are tried at once.
PART_SHINGLES = 1 << 17
NEVER = -(1 << 60)
#: Places of the table that tells which keys and signatures are open.
SLOTS = 1 << 21
PLACE_BITS = 20
#: Steps of all positions at once before a stack takes over.
STEPS = 64


def compact_windows(hashes: np.ndarray, begin: np.ndarray, stop: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(l, c, r) of all compact windows of ``least`` or more places, for many sequences at once:
    [begin, stop) in one array of fewer than 2^20 places; of equal hashes the first is smaller.

    The centres of such windows are the smallest places of the runs of ``least`` places, and the next
    smaller place on either side of a centre is a centre too. So the Cartesian trees are built of the
    centres alone, in one pass with a stack: repeated words make trees as deep as they are long."""
    mask = np.uint64((1 << PLACE_BITS) - 1)
    ranked = (hashes & ~mask) | np.arange(len(hashes), dtype=np.uint64)
    keep = stop - begin >= least
    begin, stop = begin[keep].astype(np.int64), stop[keep].astype(np.int64)
    if not len(begin):
        none = np.empty(0, np.int64)
        return none, none, none
    lowest, width = ranked, 1
    while width < least:
        step = min(width, least - width)
        lowest = np.minimum(lowest[:-step], lowest[step:])
        width += step
    edges = np.zeros(len(hashes) + 1, np.int8)
    np.add.at(edges, begin, 1)
    np.add.at(edges, stop - least + 1, -1)
    lowest = lowest[np.cumsum(edges[: len(lowest)], dtype=np.int8).view(bool)]
    lowest = lowest[np.concatenate([[True], lowest[1:] != lowest[:-1]])]
    places = (lowest & mask).astype(np.int64)
    first = np.searchsorted(places, begin)
    sequence = np.repeat(np.arange(len(begin)), np.diff(np.append(first, len(places))))

    # A sequence begins with a place that is smaller than all of its own, just before it.
    values = np.insert(lowest, first, 0)
    before, after = np.insert(places, first, begin - 1), np.insert(places, first, len(hashes))
    smaller, next_smaller = nearest_smaller(values)
    centres = np.arange(len(places)) + sequence + 1
    return before[smaller[centres]] + 1, places, np.minimum(np.append(after, len(hashes))[next_smaller[centres]], stop[sequence]) - 1


def nearest_smaller(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the last smaller value before each and of the first one after it (the length, if
    there is none). The first value and what equals it are smallest. All positions step at once to
    what their candidate points to; those that take many steps are left to one pass with a stack."""
    open_end = np.append(values, values[:1])
    sides = []
    for way in (-1, 1):
        to = np.arange(len(values)) + way
        to[0] = max(to[0], 0)
        active = np.flatnonzero(open_end[to] > values)
        for _ in range(STEPS):
            if not len(active):
                break
            to[active] = to[to[active]]
            active = active[open_end[to[active]] > values[active]]
        if len(active):
            return _nearest_by_stack(values.tolist())
        sides.append(to)
    return sides[0], sides[1]


def _nearest_by_stack(values: list[int]) -> tuple[np.ndarray, np.ndarray]:
    smaller, next_smaller, path = [0] * len(values), [len(values)] * len(values), []
    for k, value in enumerate(values):
        while path and values[path[-1]] > value:
            next_smaller[path.pop()] = k
        smaller[k] = path[-1] if path else 0
        path.append(k)
    return np.array(smaller), np.array(next_smaller)


def run_starts(windows: tuple[np.ndarray, np.ndarray, np.ndarray], run: int) -> tuple[np.ndarray, np.ndarray]:
    """First place of a run of this length and its centre, for each window, by place: the windows
    divide the places where runs begin."""
    l, c, _ = windows
    first = np.maximum(l, c - run + 1)
    order = np.argsort(first, kind="stable")
    return first[order], c[order]


def signature_rows(shingles: np.ndarray, begin: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(signature, place of the first of its two minima, distance to the second) for all bands."""
    sigs, places, spans = [], [], []
    for number, functions in enumerate(BANDS):
        parts, drawn = [], []
        for f in functions:
            with np.errstate(over="ignore"):
                h = common.mixed(shingles + np.uint64(f) * np.uint64(0xD1B54A32D192ED03))
            first, centre = run_starts(compact_windows(h, begin, stop, RUN), RUN)
            parts.append((first, centre))
            drawn.append(h)
        # Interval join: at each begin of a piece of either division, the piece of the other.
        (a, ca), (b, cb), (ha, hb) = *parts, drawn
        place = np.union1d(a, b)
        if not len(place):
            continue
        x = ca[np.searchsorted(a, place, side="right") - 1]
        y = cb[np.searchsorted(b, place, side="right") - 1]
        with np.errstate(over="ignore"):
            sigs.append(common.mixed(ha[x] * np.uint64(3) + common.mixed(hb[y] + np.uint64(number))))
        places.append(np.minimum(x, y))
        spans.append(np.abs(x - y))
    if not sigs:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(sigs), np.concatenate(places), np.concatenate(spans)


def star(sig: np.ndarray, key: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by signature, and in it the representative first; whether a row is the first of its
    signature; and the position of each row's representative."""
    with np.errstate(over="ignore"):
        turn = common.mixed(key.view(np.uint64) ^ (sig & np.uint64(1)))
    order = np.lexsort((place, key, turn, sig))
    s = sig[order]
    first = np.concatenate([[True], s[1:] != s[:-1]]) if len(s) else np.zeros(0, bool)
    chief = np.maximum.accumulate(np.where(first, np.arange(len(s)), 0)) if len(s) else np.zeros(0, np.int64)
    return order, first, chief


ROWS = "bucket int, sig binary, keys binary, at binary, spans binary, key long, other long, places binary"
PAIRS = "key long, other long, places binary"
KINDS = [pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.binary()]
#: The bucket of the texts of a block that are not its representatives.
OTHERS = -1


def _with_passage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids, keys and numbers of words of the texts that are long enough for a passage."""
    for batch in batches:
        words = np.array([len(text.split()) if text else 0 for text in common.byte_column(batch, "text")], np.int64)
        counted = pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("key"), pa.array(words)], ["doc_id", "key", "words"])
        yield counted.filter(pa.array(words >= PASSAGE))


def packed_pairs(key: np.ndarray, place: np.ndarray, span: np.ndarray, other: np.ndarray, other_place: np.ndarray) -> list[tuple[int, int, bytes]]:
    """One row per pair of texts, with all places that they share and the distances of their minima."""
    order = np.lexsort((other_place, place, other, key))
    key, other = key[order], other[order]
    places = np.stack([place[order], other_place[order], span[order]], axis=1).astype(np.int32)
    if not len(key):
        return []
    first = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (other[1:] != other[:-1])]))
    data, width = places.tobytes(), places.itemsize * 3
    edge = (np.append(first, len(key)) * width).tolist()
    return [(k, o, data[a:b]) for k, o, a, b in zip(key[first].tolist(), other[first].tolist(), edge[:-1], edge[1:], strict=True)]


def make_windows(buckets: int):
    """Packed signatures of the representatives of a block, by bucket, and the pairs inside it."""
    names = [c.split()[0] for c in ROWS.split(", ")]

    def flush(texts: list[tuple[int, np.ndarray]]) -> pa.RecordBatch:
        lengths = np.array([len(s) for _, s in texts], np.int64)
        stop = np.cumsum(lengths)
        begin = stop - lengths
        sig, place, span = signature_rows(np.concatenate([s for _, s in texts]), begin, stop)
        owner = np.searchsorted(stop, place, side="right")
        key = np.array([k for k, _ in texts], np.int64)[owner]
        place = place - begin[owner]
        order, first, chief = star(sig, key, place)
        sig, key, place, span = sig[order], key[order], place[order], span[order]
        pair = ~first & (key != key[chief])
        rows = [(None,) * 5 + p for p in packed_pairs(key[pair], place[pair], span[pair], key[chief][pair], place[chief][pair])]
        if pair.any():
            rows.append((OTHERS, sig[pair].tobytes(), key[pair].tobytes(), place[pair].astype(np.uint32).tobytes(), None, None, None, None))
        sig, key, place, span = sig[first], key[first], place[first], span[first]
        bucket = (sig % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1) if len(order) else []:
            rows.append((int(bucket[part[0]]), sig[part].tobytes(), key[part].tobytes(), place[part].astype(np.uint32).tobytes(), span[part].astype(np.uint8).tobytes(), None, None, None))
        columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, KINDS, strict=True)], names)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = [], 0
        seen: set[int] = set()
        for batch in batches:
            fresh = []
            for key, text in zip(batch.column("key").to_pylist(), common.byte_column(batch, "text"), strict=True):
                if key in seen:
                    continue
                if len(seen) > 500_000:
                    seen.clear()
                seen.add(key)
                fresh.append((key, text))
            for (key, _), shingles in zip(fresh, common.text_shingles([text for _, text in fresh], SHINGLE), strict=True):
                # A text of more places than a block is cut into parts that overlap by a run.
                for at in range(0, max(len(shingles) - RUN + 1, 0), BLOCK_SHINGLES):
                    part = shingles[at : at + BLOCK_SHINGLES + RUN - 1]
                    if at:
                        yield moved(flush([(key, part)]), at)
                        continue
                    if held + len(part) > BLOCK_SHINGLES and block:
                        yield flush(block)
                        block, held = [], 0
                    block.append((key, part.copy()))
                    held += len(part)
        if block:
            yield flush(block)
        del seen, block
        common.trim()

    def moved(batch: pa.RecordBatch, by: int) -> pa.RecordBatch:
        """A later part of a long text: its places count from the text's begin. One text makes no pairs."""
        at = [None if a is None else (np.frombuffer(a, np.uint32) + np.uint32(by)).tobytes() for a in batch.column("at").to_pylist()]
        return batch.set_column(3, "at", pa.array(at, pa.binary()))

    return windows


def pair_up(table: pa.Table) -> pa.Table:
    """Pairs of a bucket: each block's representative with the one of all blocks."""
    sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint64)
    key = np.frombuffer(b"".join(table.column("keys").to_pylist()), np.int64)
    place = np.frombuffer(b"".join(table.column("at").to_pylist()), np.uint32).astype(np.int32)
    span = np.frombuffer(b"".join(table.column("spans").to_pylist()), np.uint8)
    order = np.argsort(sig, kind="stable")
    s = sig[order]
    same = s[1:] == s[:-1]
    twice = order[np.concatenate([[False], same]) | np.concatenate([same, [False]])] if len(s) else order
    sig, key, place, span = sig[twice], key[twice], place[twice], span[twice]
    order, first, chief = star(sig, key, place)
    key, place, span = key[order], place[order], span[order]
    pair = ~first & (key != key[chief])
    rows = packed_pairs(key[pair], place[pair], span[pair], key[chief][pair], place[chief][pair])
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 3
    return pa.table({n: pa.array(c, k) for n, c, k in zip(("key", "other", "places"), columns, KINDS[5:], strict=True)})


def clusters(places: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int, list]]:
    """Regions (lo, hi, other lo, other hi) of shingle places to verify, and the places: shared places
    that lie near each other on both sides, with a run's length around them."""
    out: list[list] = []
    for x, y, span in places:
        near = out and x - out[-1][1] <= 2 * RUN and out[-1][2] - 2 * RUN <= y <= out[-1][3] + 2 * RUN
        if near:
            out[-1] = [out[-1][0], x, min(out[-1][2], y), max(out[-1][3], y), [*out[-1][4], (x, y, span)]]
        else:
            out.append([x, x, y, y, [(x, y, span)]])
    return [(max(a - RUN, 0), b + 2 * RUN, max(c - RUN, 0), d + 2 * RUN, at) for a, b, c, d, at in out]


class Side:
    """The shingles of a region, and what comparisons ask of them: worked out once."""

    def __init__(self, values: np.ndarray):
        self.values = values

    @cached_property
    def order(self) -> np.ndarray:
        return np.argsort(self.values, kind="stable")

    @cached_property
    def ranked(self) -> np.ndarray:
        return self.values[self.order]

    @cached_property
    def before(self) -> np.ndarray | None:
        """For each place the last earlier one of the same value, or -1; nothing if all values differ."""
        same = self.ranked[1:] == self.ranked[:-1]
        if not same.any():
            return None
        out = np.full(len(self.values), -1)
        out[self.order[1:][same]] = self.order[:-1][same]
        return out

    @cached_property
    def once(self) -> np.ndarray:
        """Whether the shingle of a place stands nowhere else."""
        out = np.ones(len(self.values), bool)
        if self.before is not None:
            again = np.flatnonzero(self.before >= 0)
            out[again] = out[self.before[again]] = False
        return out

    def ranks(self, x: Side) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For the shingles of the other side: the rank here, the first place here, whether it is here."""
        ranks = self.ranked.searchsorted(x.values)
        if not len(self.values):
            return ranks, ranks, np.zeros(len(ranks), bool)
        near = np.minimum(ranks, len(self.values) - 1)
        return ranks, self.order[near], self.ranked[near] == x.values


def _side(x: np.ndarray | Side) -> Side:
    return x if isinstance(x, Side) else Side(x)


def common_passages(x: np.ndarray | Side, y: np.ndarray | Side, run: int = RUN) -> list[tuple[int, int, int, int, float]]:
    """(begin, stop, other begin, other stop, similarity) of passages that two regions share. A part
    is trimmed to its first and last shared shingle on both sides; if its similarity is too low, it
    is divided at its longest stretch of shingles that are not shared."""
    x, y = _side(x), _side(y)
    ranks, hit, shared = y.ranks(x)
    whole_part = shared.nonzero()[0]
    if len(whole_part) < run * SIMILARITY_PERCENT // 100 or whole_part[-1] - whole_part[0] < run - 1:
        return []
    there = hit[whole_part]
    if there.max() - there.min() < run - 1:
        return []
    out, parts = [], [whole_part]
    before, before_there = x.before, y.before
    plain = before_there is None
    first = np.where(shared, hit, -1)
    if not plain:  # all places of y, by shingle and place
        width = len(y.values) + 1
        listed = y.ranked.searchsorted(y.ranked) * width + y.order
    while parts:
        at = parts.pop()
        if len(at) < run * SIMILARITY_PERCENT // 100:
            continue
        there = hit[at]
        far = np.sort(there)
        low, high = int(far[len(there) // 50]), int(far[-1 - len(there) // 50])
        if far[0] < low - run or far[-1] > high + run:
            # A shingle that also stands elsewhere may point far away; the bulk tells the place.
            close = (there >= low - run) & (there <= high + run)
            at, there = at[close], there[close]
            far = np.sort(there)
        a, b, c, d = int(at[0]), int(at[-1]) + 1, int(far[0]), int(far[-1]) + 1
        if min(b - a, d - c) < run:
            continue
        held = first[a:b]
        if plain:
            held = (held >= c) & (held < d)
        else:
            asked = np.searchsorted(listed, ranks[a:b] * width + c)
            held = (held >= 0) & (listed[np.minimum(asked, len(listed) - 1)] < ranks[a:b] * width + d) & (asked < len(listed))
        if before is not None:
            fresh = before[a:b] < a
            left, both = int(np.count_nonzero(fresh)), int(np.count_nonzero(held & fresh))
        else:
            left, both = b - a, int(np.count_nonzero(held))
        whole = left - both + (d - c if plain else int(np.count_nonzero(before_there[c:d] < c)))
        if 100 * both >= SIMILARITY_PERCENT * whole:
            out.append((a, b, c, d, both / whole))
            continue
        gaps = np.maximum(at[1:] - at[:-1], np.abs(there[1:] - there[:-1]))
        cut = int(np.argmax(gaps)) + 1
        if gaps[cut - 1] <= 1:
            cut = len(at) // 2
        parts += [at[:cut], at[cut:]]
    return sorted(out)


def passages_around(x: np.ndarray | Side, y: np.ndarray | Side, at: np.ndarray, there: np.ndarray) -> list[tuple[int, int, int, int, float]]:
    """The common passages that hold one of the places on each side. What a side repeats can hide a
    passage, so if none is found then, the sides change places."""
    x, y = _side(x), _side(y)
    for turned in (False, True):
        if turned and x.before is None and y.before is None:
            break
        found = common_passages(y, x) if turned else common_passages(x, y)
        found = [(c, d, a, b, similarity) for a, b, c, d, similarity in found] if turned else found
        found = [p for p in found if ((at >= p[0]) & (at < p[1])).any() and ((there >= p[2]) & (there < p[3])).any()]
        if found:
            return found
    return []


REGION = "struct<lo:int,hi:int,other_lo:int,other_hi:int>"


def _cluster(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["key", "other", "lo", "hi", "other_lo", "other_hi", "places"]
    kinds = [pa.int64()] * 2 + [pa.int32()] * 4 + [pa.binary()]
    for batch in batches:
        rows = []
        for key, other, places in zip(batch.column("key").to_pylist(), batch.column("other").to_pylist(), batch.column("places").to_pylist(), strict=True):
            shared = sorted({*struct.iter_unpack("=3i", b"".join(places))})
            rows += [(key, other, *c, np.array(at, np.int32).tobytes()) for *c, at in clusters(shared)]
        columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingles of the asked regions of each text, 48 bits each."""
    for batch in batches:
        regions = batch.column("regions")
        bounds = regions.flatten()
        ends = np.cumsum(regions.value_lengths().to_numpy()).tolist()
        lo, hi = (x.to_numpy() for x in bounds.flatten())
        los, his, parts, at = lo.tolist(), hi.tolist(), [], 0
        for end, shingles in zip(ends, common.text_shingles(common.byte_column(batch, "text"), SHINGLE), strict=True):
            narrow = np.ascontiguousarray(shingles).view(np.uint8).reshape(-1, 8)[:, :6].tobytes()
            parts += [narrow[6 * los[k] : 6 * his[k]] for k in range(at, end)]
            at = end
        key = np.repeat(batch.column("key").to_numpy(), np.diff([0, *ends]))
        yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(lo), pa.array(hi), pa.array(parts, pa.binary())], ["key", "lo", "hi", "shingles"])
    common.trim()


def _wide(data: bytes) -> np.ndarray:
    return np.ndarray(len(data) // 6, "<u8", buffer=data + bytes(2), strides=(6,)) & np.uint64((1 << 48) - 1)


FOUND = "key long, start_word int, stop_word int, other long, other_start int, other_stop int, similarity double"
#: Passages, or, without the other columns, an open place of a text.
CHECKED = f"{FOUND}, sig long, place int"
CHECKED_KINDS = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.int64(), pa.int32()]


def _checked(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(CHECKED_KINDS)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, CHECKED_KINDS, strict=True)], [c.split()[0] for c in CHECKED.split(", ")])


def _passage(key: int, lo: int, other: int, other_lo: int, found: tuple[int, int, int, int, float]) -> tuple:
    a, b, c, d, similarity = found
    return (key, lo + a, lo + b + SHINGLE - 1, other, other_lo + c, other_lo + d + SHINGLE - 1, similarity, None, None)


def _best_around(x: Side, held: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The most that a window of ``RUN`` shingles or more around each place gains, as in ``Candidates``."""
    total = np.concatenate([[0], np.cumsum(np.where(x.once, np.where(held, 1, -6), 0))])
    room = np.full(RUN, -NEVER), np.full(2 * RUN, NEVER)
    begins = np.concatenate([room[0], total])[at[:, None] + np.arange(RUN + 1)]
    ends = np.concatenate([total, room[1]])[at[:, None] + np.arange(1, 2 * RUN + 1)]
    least = np.minimum.accumulate(begins, axis=1)[:, np.minimum(np.arange(1, 2 * RUN + 1), RUN)]
    again = 0 if x.before is None else np.count_nonzero(held & ~x.once & (x.before < 0))
    return (ends - least).max(axis=1) + again


def _room(x: Side, held: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether the held shingles from a run before to two runs after each place are enough for a passage,
    and whether those that first stand there lie far enough apart: ``common_passages`` needs the one on
    its first side and the other on its second."""
    lo = np.maximum(at - RUN, 0)
    places = lo[:, None] + np.arange(3 * RUN)
    inside = places < np.minimum(at + 2 * RUN, len(held))[:, None]
    places = np.minimum(places, len(held) - 1)
    every = held[places] & inside
    fresh = every if x.before is None else every & (x.before[places] < lo[:, None])
    far = [np.where(h.any(axis=1), h.shape[1] - h[:, ::-1].argmax(axis=1) - h.argmax(axis=1), 0) >= RUN for h in (every, fresh)]
    return far[0] & (every.sum(axis=1) >= RUN * SIMILARITY_PERCENT // 100), far[1]


def _near_passages(x: Side, y: Side, at: np.ndarray, there: np.ndarray) -> Iterator[tuple[int, int, int, int, float]]:
    """Passages of the shingles up to a run before and two runs after pairs of places, each way round:
    what the rest of a wide region repeats may hide them."""
    held, held_there = y.ranks(x)[2], x.ranks(y)[2]
    maybe = np.flatnonzero(_best_around(x, held, at) + _best_around(y, held_there, there) >= 0)
    if not len(maybe):
        return
    enough, far = _room(x, held, at[maybe])
    enough_there, far_there = _room(y, held_there, there[maybe])
    maybe = maybe[(enough & far_there) | (far & enough_there)]
    found: list[tuple[int, int, int, int, float]] = []
    for p, q in zip(at[maybe].tolist(), there[maybe].tolist(), strict=True):
        if any(a <= p < b and c <= q < d for a, b, c, d, _ in found):
            continue
        lo, to = max(p - RUN, 0), max(q - RUN, 0)
        pairs = passages_around(x.values[lo : p + 2 * RUN], y.values[to : q + 2 * RUN], np.array([p - lo]), np.array([q - to]))
        found += [(lo + a, lo + b, to + c, to + d, similarity) for a, b, c, d, similarity in pairs]
    yield from found


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Passages of the regions, and the places of both sides that are in none of them."""
    for batch in batches:
        rows, open_ = [], set()
        columns = (batch.column(c).to_pylist() for c in ("key", "other", "lo", "other_lo", "x", "y", "places"))
        for key, other, lo, other_lo, x, y, places in zip(*columns, strict=True):
            x, y = Side(_wide(x)), Side(_wide(y))
            passages = common_passages(x, y)
            rows += [_passage(key, lo, other, other_lo, p) for p in passages]
            at, there, span = np.frombuffer(places, np.int32).reshape(-1, 3).T
            held = np.zeros(len(at), bool)
            for a, b, c, d, _ in passages:
                held |= (at >= lo + a) & (at + span < lo + b) & (there >= other_lo + c) & (there < other_lo + d)
            if not held.all():
                left = np.flatnonzero(~held)
                for p in _near_passages(x, y, at[left] - lo, there[left] - other_lo):
                    rows.append(_passage(key, lo, other, other_lo, p))
                    a, b, c, d, _ = p
                    held |= (at >= lo + a) & (at < lo + b) & (there >= other_lo + c) & (there < other_lo + d)
            open_.update((key, p) for p in at[~held].tolist())
            open_.update((other, p) for p in there[~held].tolist())
        yield _checked(rows + [(k, *(None,) * 7, p) for k, p in open_])


MEMBERS = "sig long, key long, place int"


def make_members(column: str, told):
    """Single rows of the packed signatures whose key or signature is told."""

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = told.value
        for batch in batches:
            for sig, keys, at in zip(*(batch.column(c).to_pylist() for c in ("sig", "keys", "at")), strict=True):
                data = {"sig": np.frombuffer(sig, np.int64), "key": np.frombuffer(keys, np.int64), "place": np.frombuffer(at, np.uint32).astype(np.int32)}
                keep = bits[data[column] % SLOTS]
                if keep.any():
                    yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in data.values()], list(data))

    return members


#: What names a chunk, and the chunk that visits it.
CHUNK = ("sig", "chunk", "home")
STRETCHES = "sig long, key long, lo int, hi int, spots array<struct<place:int,open:boolean>>"


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The places of a text and signature as stretches of places a run or less apart: a repeated word
    or line has the same two minima at place after place. A place that is there twice is open if one is."""
    for batch in batches:
        spots = batch.column("spots")
        place, open_ = (x.to_numpy(zero_copy_only=False) for x in spots.flatten().flatten())
        row = np.repeat(np.arange(len(batch)), spots.value_lengths().to_numpy())
        order = np.lexsort((~open_, place, row))
        row, place, open_ = row[order], place[order], open_[order]
        fresh = np.concatenate([[True], (row[1:] != row[:-1]) | (place[1:] != place[:-1])]) if len(row) else np.zeros(0, bool)
        row, place, open_ = row[fresh], place[fresh].astype(np.int32), open_[fresh]
        cut = (row[1:] != row[:-1]) | (place[1:] - place[:-1] > RUN)
        edge = np.concatenate([[0], np.flatnonzero(cut) + 1, [len(row)]]) if len(row) else np.zeros(1, np.int64)
        first, last = edge[:-1], edge[1:] - 1
        lists = pa.ListArray.from_arrays(pa.array(edge, pa.int32()), pa.StructArray.from_arrays([pa.array(place), pa.array(open_)], ["place", "open"]))
        bounds = [np.maximum(place[first] - RUN, 0), place[last] + np.int32(2 * RUN)]
        owners = [pa.array(batch.column(c).to_numpy()[row[first]]) for c in ("sig", "key")]
        yield pa.RecordBatch.from_arrays([*owners, *(pa.array(b.astype(np.int32)) for b in bounds), lists], ["sig", "key", "lo", "hi", "spots"])


def told_slots(table: DataFrame, column: str):
    """A table of SLOTS marks, in which those of the column's values are set."""
    bits = np.zeros(SLOTS, bool)
    bits[table.select(F.pmod(F.col(column), F.lit(SLOTS)).alias("slot")).distinct().toArrow().column("slot").to_numpy()] = True
    return table.sparkSession.sparkContext.broadcast(bits)


def _stretches(key: np.ndarray, place: np.ndarray, lo: np.ndarray, parts: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """First member and shingles of each stretch of places of one text, a run or less apart, of members
    in order of (key, place): a repeated word or line has the same two minima at place after place."""
    first = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (place[1:] - place[:-1] > RUN)]))
    whole = []
    for a, b in zip(first.tolist(), [*first[1:].tolist(), len(key)], strict=True):
        pieces, end = [parts[a]], lo[a] + len(parts[a])
        for k in range(a + 1, b):
            pieces.append(parts[k][max(end - lo[k], 0) :])
            end = max(end, lo[k] + len(parts[k]))
        whole.append(np.concatenate(pieces))
    return first, whole


class Candidates:
    """For each stretch, the others that may be similar to it.

    Each distinct shingle of either passage that the other lacks must be paid for by three that both
    hold. On one side, a window of ``RUN`` shingles or more around one of the stretch's places gains one
    for each shingle that the other stretch holds and loses six for each that it lacks; shingles that the
    stretch repeats count as held once, wherever they are, and are never counted as lacking. If the best
    windows of two stretches lose together, no passages of theirs are similar: only such pairs are skipped.

    ``common_passages`` takes a shared shingle to stand where the other side has it first. If on neither
    side the first places of the shared shingles lie a run apart, it finds nothing either.

    Among many stretches not all are tried: two similar ones share a shingle that few texts hold, which an
    index of these finds, or the shingles that many texts hold would alone be enough for both."""

    def __init__(self, key: np.ndarray, at: np.ndarray, begin: np.ndarray, stop: np.ndarray, whole: list[np.ndarray]):
        """``key`` is of each stretch, ``at`` of each place, which ``begin`` and ``stop`` deal to the stretches."""
        self.sizes = np.array([len(x) for x in whole])
        names, code = np.unique(np.concatenate(whole), return_inverse=True)
        self.code, self.count = code, len(names)
        self.edge = np.concatenate([[0], np.cumsum(self.sizes)])
        stretch = np.repeat(np.arange(len(begin)), self.sizes)
        cells, met, where, times = np.unique(stretch * np.int64(self.count) + code, return_index=True, return_inverse=True, return_counts=True)
        self.once = times[where] == 1
        self.first = np.zeros(len(code), bool)
        self.first[met] = True
        self.again = np.zeros(len(code), bool)
        self.again[met[times > 1]] = True
        # The last begin of a window that ends here, counted from the stretch's: at a place or before.
        spot = np.full(len(code), -1)
        own = self.edge[np.repeat(np.arange(len(begin)), stop - begin)] + at
        spot[own] = own
        number = np.arange(len(code))
        self.latest = np.maximum(np.minimum(np.maximum.accumulate(spot), number + 1 - RUN) - self.edge[stretch], -1)
        self.texts = np.unique(key, return_inverse=True)[1]
        self.mark = np.zeros(self.count, bool)
        self.column = np.full(self.count, -1)
        self.listed = None
        member, held = cells // self.count, cells % self.count
        if len(begin) <= INDEXED:
            # How many distinct shingles each pair holds: without repeats a passage needs one at each place.
            shared_ = np.bincount(held, minlength=self.count) > 1
            row = np.zeros((len(begin), int(np.count_nonzero(shared_))), np.float32)
            row[member[shared_[held]], (np.cumsum(shared_) - 1)[held[shared_[held]]]] = 1
            both = row @ row.T
            repeats = np.logical_or.reduceat(~self.once, self.edge[:-1])
            self.tried = (both >= RUN * SIMILARITY_PERCENT // 100) | ((repeats[:, None] | repeats) & (both > 1))
        else:
            holders = np.bincount(np.unique(self.texts[member] * np.int64(self.count) + held) % self.count, minlength=self.count)
            common_ = holders > RARE_TEXTS
            rare = ~common_[held]
            by_code = np.argsort(held[rare], kind="stable")
            self.listed = member[rare][by_code]
            self.at_code = np.searchsorted(held[rare][by_code], np.arange(self.count + 1))
            self.rare = ~common_
            known = [(common_[code[at]], at, self.sizes[j]) for j, at in self.parts(np.arange(len(begin)))]
            self.alone = np.concatenate([self.best(*x) for x in known])
            self.wide = np.concatenate([self.apart(held & self.first[at], at, sizes) for held, at, sizes in known])

    def parts(self, stretches: np.ndarray, beside: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The stretches in parts of bounded size, with the positions of their shingles."""
        weight = np.cumsum(self.sizes[stretches] + beside) // PART_SHINGLES
        for part in np.split(stretches, np.flatnonzero(np.diff(weight)) + 1) if len(stretches) else []:
            sizes = self.sizes[part]
            yield part, np.repeat(self.edge[part] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())

    def best(self, held: np.ndarray, at: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """What the best window of each stretch gains, whose shingles stand at these positions."""
        start = np.cumsum(sizes) - sizes
        once = self.once[at]
        total = np.concatenate([[0], np.cumsum(np.where(once, np.where(held, 1, -6), 0))])
        lift = np.repeat(np.arange(len(sizes)) * (12 * len(at) + 1), sizes)
        least = np.maximum.accumulate(lift - total[:-1])
        latest = self.latest[at]
        gain = total[1:] + least[np.maximum(latest, 0) + np.repeat(start, sizes)] - lift
        gain[latest < 0] = NEVER
        return np.maximum.reduceat(gain, start) + np.add.reduceat(held & self.again[at], start)

    @staticmethod
    def apart(held: np.ndarray, at: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Whether the outermost held shingles of each stretch, which stand at these positions, lie a run apart."""
        start = np.cumsum(sizes) - sizes
        return np.maximum.reduceat(np.where(held, at, NEVER), start) - np.minimum.reduceat(np.where(held, at, -NEVER), start) >= RUN - 1

    def of(self, k: int, wanted: Callable[[np.ndarray], np.ndarray]) -> Iterator[int]:
        """``wanted`` tells, as late as possible, which of some stretches still matter."""
        at = np.arange(self.edge[k], self.edge[k + 1])
        codes = self.code[at]
        if self.listed is None:
            near = np.flatnonzero(self.tried[k])
        else:
            met = [np.flatnonzero((self.alone + self.alone[k] >= 0) & (self.wide | self.wide[k]))]
            near = np.unique(np.concatenate(met + [self.listed[self.at_code[c] : self.at_code[c + 1]] for c in np.unique(codes[self.rare[codes]]).tolist()]))
        near = near[self.texts[near] != self.texts[k]]
        for part, there in self.parts(near, len(at)):
            keep = wanted(part)
            there, part = there[np.repeat(keep, self.sizes[part])], part[keep]
            if not len(part):
                continue
            sizes = self.sizes[part]
            self.mark[codes] = True
            shared = self.mark[self.code[there]]
            self.mark[codes] = False
            keep = self.apart(shared, there, sizes)
            if not keep.all():
                inside = np.repeat(keep, sizes)
                there, shared, part, sizes = there[inside], shared[inside], part[keep], sizes[keep]
                if not len(part):
                    continue
            theirs = self.best(shared, there, sizes)
            far = self.apart(shared & self.first[there], there, sizes)
            # Which of this stretch's shingles each of the others holds.
            names, column = np.unique(codes, return_inverse=True)
            self.column[names] = np.arange(len(names))
            held = np.zeros((len(part), len(names) + 1), bool)
            held[np.repeat(np.arange(len(part)), sizes), self.column[self.code[there]]] = True
            self.column[names] = -1
            here = held[:, column]
            places = np.tile(at, len(part)), np.full(len(part), len(at))
            mine = self.best(here.ravel(), *places)
            far = (far & self.apart(here.ravel(), *places)) | self.apart((here & self.first[at]).ravel(), *places)
            yield from part[(theirs + mine >= 0) & far].tolist()


def compare_chunk(table: pa.Table) -> pa.Table:
    """Compare the open places of a chunk with all of its places. Returned are passages, and the
    places that are still open. Places of one text that lie close are compared as one stretch."""
    key, place, lo = (table.column(c).to_numpy() for c in ("key", "place", "lo"))
    order = np.lexsort((place, key))
    shingles = table.column("shingles").to_pylist()
    key, place, lo, parts = key[order], place[order], lo[order], [_wide(shingles[k]) for k in order.tolist()]
    open_ = table.column("open").to_numpy(zero_copy_only=False)[order]
    begin, whole = _stretches(key, place, lo, parts)
    return _compared(table.column("sig")[0].as_py(), key[begin], lo[begin], whole, place, open_, np.append(begin, len(key)))


def make_compare(apart: bool):
    """Compare the stretches of each chunk, of rows in order of their chunks; if ``apart``, those that
    ask only with those that do not."""

    def compare_stretches(batches: list[pa.RecordBatch]) -> pa.Table:
        table = pa.Table.from_batches(batches).combine_chunks()
        spots = table.column("spots").combine_chunks()
        place, open_ = (x.to_numpy(zero_copy_only=False) for x in spots.flatten().flatten())
        sizes = spots.value_lengths().to_numpy()
        edge = np.concatenate([[0], np.cumsum(sizes)])
        key, lo = table.column("key").to_numpy(), table.column("lo").to_numpy()
        order = np.lexsort((lo, key))
        shingles = table.column("shingles").to_pylist()
        sizes = sizes[order]
        turn = np.repeat(edge[order] - (np.cumsum(sizes) - sizes), sizes) + np.arange(edge[-1])
        whole = [_wide(shingles[k]) for k in order.tolist()]
        edge = np.concatenate([[0], np.cumsum(sizes)])
        return _compared(table.column("sig")[0].as_py(), key[order], lo[order], whole, place[turn], open_[turn], edge, apart)

    def compare_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last = [], None
        for batch in batches:
            names = np.stack([batch.column(c).to_numpy() for c in CHUNK if c in batch.schema.names], axis=1)
            edge = [0, *(np.flatnonzero((names[1:] != names[:-1]).any(axis=1)) + 1).tolist(), len(batch)]
            for begin, end in zip(edge[:-1], edge[1:], strict=True):
                if begin < end:
                    if held and names[begin].tolist() != last:
                        yield from compare_stretches(held).to_batches()
                        held = []
                    held.append(batch.slice(begin, end - begin))
                    last = names[begin].tolist()
        if held:
            yield from compare_stretches(held).to_batches()
        del held
        common.trim()

    return compare_chunks


def by_chunk(rows: DataFrame, apart: bool) -> DataFrame:
    """As grouped by chunk; a task takes all of its chunks in one go, as most of them are small."""
    names = [c for c in CHUNK if c in rows.columns]
    return rows.repartition(*names).sortWithinPartitions(*names).mapInArrow(make_compare(apart), CHECKED)


def _compared(sig: int, key: np.ndarray, lo: np.ndarray, whole: list[np.ndarray], place: np.ndarray, open_: np.ndarray, edge: np.ndarray, apart: bool = False) -> pa.Table:
    """``edge`` deals the places to the stretches, in order. Which stretches are compared, ``Candidates``
    tells, or, where there are few, all are."""
    begin, stop = edge[:-1], edge[1:]
    index = Candidates(key, place - np.repeat(lo, stop - begin), begin, stop, whole) if len(begin) > FEW else None
    open_ = open_.copy()
    asking = np.logical_or.reduceat(open_, begin)
    host = ~asking if apart else None
    sides: list[Side | None] = [None] * len(begin)
    rows = []
    for k in np.flatnonzero(asking).tolist():
        mine = slice(begin[k], stop[k])
        if not open_[mine].any():
            continue

        def wanted(part: np.ndarray, mine: slice = mine) -> np.ndarray:
            live = asking[part] | open_[mine].any()
            return live if host is None else live & host[part]

        for j in index.of(k, wanted) if index else np.flatnonzero(key != key[k]).tolist():
            theirs = slice(begin[j], stop[j])
            if not open_[mine].any() and not open_[theirs].any():
                continue
            if host is not None and not host[j]:
                continue
            at, to = lo[j], lo[k]
            for x in (j, k):
                sides[x] = sides[x] or Side(whole[x])
            # Only passages around the minima, as for pairs with representatives.
            for p in passages_around(sides[j], sides[k], place[theirs] - at, place[mine] - to):
                rows.append(_passage(int(key[j]), int(at), int(key[k]), int(to), p))
                open_[theirs] &= (place[theirs] - at < p[0]) | (place[theirs] - at >= p[1])
                open_[mine] &= (place[mine] - to < p[2]) | (place[mine] - to >= p[3])
                asking[j], asking[k] = open_[theirs].any(), open_[mine].any()
    left = np.repeat(key, stop - begin)[open_]
    blank = [pa.nulls(len(left), kind) for kind in CHECKED_KINDS[1:7]]
    still = [pa.array(left), *blank, pa.array(np.full(len(left), sig)), pa.array(place[open_].astype(np.int32))]
    return pa.Table.from_batches([_checked(rows), pa.RecordBatch.from_arrays(still, [c.split()[0] for c in CHECKED.split(", ")])])


def kept(df: DataFrame, name: str) -> DataFrame:
    """A stored table, without the shuffle files of the steps before."""
    table = common.stored(df, name)
    common.release(df.sparkSession)
    return table


def compare_open(failed: DataFrame, windows: DataFrame, cut_out) -> list[DataFrame]:
    """Passages of the open places (key, place) with any text of their signatures."""
    packed = windows.filter(F.col("sig").isNotNull()).select("sig", "keys", "at")
    failed = kept(failed.distinct(), "open-places")
    if failed.isEmpty():
        common.discard(windows, failed)
        return []
    known = packed.mapInArrow(make_members("key", told_slots(failed, "key")), MEMBERS)
    asked = kept(known.join(common.small_or_plain(failed), ["key", "place"], "left_semi").select("sig", "key", "place").distinct(), "open")
    sigs = kept(asked.select("sig").distinct(), "open-signatures")
    members = packed.mapInArrow(make_members("sig", told_slots(sigs, "sig")), MEMBERS).join(common.small_or_plain(sigs), "sig", "left_semi")
    both = members.withColumn("open", F.lit(False)).unionByName(asked.withColumn("open", F.lit(True)))
    spots = both.groupBy("sig", "key").agg(F.collect_list(F.struct("place", "open")).alias("spots"))
    members = kept(spots.mapInArrow(_gathered, STRETCHES), "open-members")
    common.discard(windows, failed, asked, sigs)
    # Of two places one represented the other, so that pair has been compared.
    chunks = F.ceil(F.sum(F.col("hi") - F.col("lo")) / F.lit(CHUNK_MEMBERS * 3 * RUN)).cast("int")
    sized = members.groupBy("sig").agg(chunks.alias("chunks"), F.sum(F.size("spots")).alias("n"), F.min("key").alias("low"), F.max("key").alias("high"))
    sized = kept(sized.filter("n > 2 and low < high").select("sig", "chunks"), "open-sizes")
    stretches = members.join(common.small_or_plain(sized), "sig")
    regions = cut_out(stretches.groupBy("key").agg(F.collect_set(F.struct("lo", "hi")).alias("regions")), "open")
    chunk = F.pmod(F.xxhash64("key", "sig"), F.col("chunks")).cast("int")
    columns = ["sig", "chunk", "key", "lo", "spots", "shingles"]
    spots = kept(stretches.join(regions, ["key", "lo", "hi"]).withColumn("chunk", chunk).select(*columns, "chunks"), "open-spots")
    common.discard(regions, members)
    own = kept(by_chunk(spots.select(columns), False), "open-chunks")

    # What has found nothing in its own chunk meets the other chunks.
    left = own.filter(F.col("place").isNotNull()).groupBy("sig", "key").agg(F.collect_set("place").alias("left"))
    opened = F.transform("spots", lambda p: F.struct(p["place"].alias("place"), F.array_contains("left", p["place"]).alias("open")))
    still = spots.filter("chunks > 1").join(left, ["sig", "key"]).withColumn("spots", opened).drop("left").filter(F.exists("spots", lambda p: p["open"]))
    still = kept(still, "still-open")
    if still.isEmpty():
        common.discard(spots, still)
        return [own]
    visits = still.withColumn("home", F.col("chunk")).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).filter("chunk != home")
    closed = F.transform("spots", lambda p: F.struct(p["place"].alias("place"), F.lit(False).alias("open")))
    hosts = spots.withColumn("spots", closed).join(still.select("sig", F.col("chunk").alias("home")).distinct(), "sig").filter("chunk != home")
    whole = visits.select(*columns, "home").unionByName(hosts.select(*columns, "home"))
    others = kept(by_chunk(whole, True), "other-chunks")
    common.discard(spots, still)
    return [own, others]


def repeated_passages(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", buckets: int | None = None) -> DataFrame:
    """doc_id, start_word, stop_word (exclusive), other_doc_id, other_start, other_stop, similarity:
    one row per passage of a document and a document that holds it too. Of equal texts the smallest
    id stands for all on the other side (for itself, the largest)."""
    spark = docs.sparkSession
    common.prepared(spark)
    buckets = min(1 << 15, buckets or 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("key"), F.col(text).alias("text")
    )
    narrow = kept(rows.mapInArrow(_with_passage, "doc_id long, key long, words long"), "repeat-ids")
    windows = kept(rows.select("key", "text").mapInArrow(make_windows(buckets), ROWS), "windows")
    cells = windows.filter(F.col("bucket") != OTHERS).select("bucket", "sig", "keys", "at", "spans")
    pairs = cells.groupBy("bucket").applyInArrow(pair_up, PAIRS).unionByName(windows.filter(F.col("bucket").isNull()).select("key", "other", "places"))
    grouped = pairs.groupBy("key", "other").agg(F.collect_list("places").alias("places"))
    asked = kept(grouped.mapInArrow(_cluster, "key long, other long, lo int, hi int, other_lo int, other_hi int, places binary"), "regions")

    both = asked.select("key", "lo", "hi").unionByName(asked.select(F.col("other").alias("key"), F.col("other_lo").alias("lo"), F.col("other_hi").alias("hi")))
    holders = narrow.groupBy("key").agg(F.min("doc_id").alias("holder"), F.max("doc_id").alias("last"), F.count("*").alias("copies"), F.max("words").alias("words"))
    holders = kept(holders, "holders")

    def cut_out(wanted: DataFrame, name: str) -> DataFrame:
        """Shingles of the wanted regions, from one row of each wanted text: that of the smallest id."""
        wanted = kept(wanted, f"{name}-wanted")
        one = kept(wanted.select("key").join(holders, "key").select(F.col("key").alias("one_key"), "holder"), f"{name}-ids")
        texts = rows.join(common.small_or_plain(one), (F.col("key") == F.col("one_key")) & F.col("doc_id").eqNullSafe(F.col("holder")), "left_semi").select("key", "text")
        once = texts.join(wanted, "key").dropDuplicates(["key"])  # a row may be there twice
        cut = kept(once.mapInArrow(_cut, "key long, lo int, hi int, shingles binary"), f"{name}-cut")
        common.discard(wanted, one)
        return cut

    cut = cut_out(both.groupBy("key").agg(F.collect_set(F.struct("lo", "hi")).alias("regions")), "repeat")
    at_key = cut.withColumnRenamed("shingles", "x")
    at_other = cut.select(F.col("key").alias("other"), F.col("lo").alias("other_lo"), F.col("hi").alias("other_hi"), F.col("shingles").alias("y"))
    found = asked.join(at_key, ["key", "lo", "hi"]).join(at_other, ["other", "other_lo", "other_hi"]).select("key", "other", "lo", "other_lo", "x", "y", "places")
    checked = kept(found.mapInArrow(_verify, CHECKED), "checked")
    common.discard(cut, asked)
    more = compare_open(checked.filter(F.col("place").isNotNull()).select("key", "place"), windows, cut_out)
    found = checked
    for table in more:
        found = found.unionByName(table)
    found = kept(found.filter(F.col("place").isNull()).drop("sig", "place").distinct(), "passages")

    # The other side's passage is a passage of its own document: one row, with one of the texts.
    first = F.min(F.struct("key", "start_word", "stop_word", "similarity")).alias("m")
    turned = found.groupBy("other", "other_start", "other_stop").agg(first).select(
        F.col("other").alias("key"), F.col("other_start").alias("start_word"), F.col("other_stop").alias("stop_word"),
        F.col("m.key").alias("other"), F.col("m.start_word").alias("other_start"), F.col("m.stop_word").alias("other_stop"), F.col("m.similarity").alias("similarity"),
    )
    named = holders.select(F.col("key").alias("other"), F.col("holder").alias("other_doc_id"))
    passages = found.unionByName(turned).distinct().join(named, "other").drop("other")
    columns = ["doc_id", "start_word", "stop_word", "other_doc_id", "other_start", "other_stop", "similarity"]
    across = narrow.select("doc_id", "key").join(passages, "key").select(columns)
    copies = narrow.select("doc_id", "key").join(holders.filter("copies > 1"), "key")
    other = F.when(F.col("doc_id").eqNullSafe(F.col("holder")), F.col("last")).otherwise(F.col("holder"))
    end = F.col("words").cast("int")
    zero = F.lit(0)
    whole = copies.select(
        "doc_id", zero.alias("start_word"), end.alias("stop_word"), other.alias("other_doc_id"), zero.alias("other_start"), end.alias("other_stop"), F.lit(1.0).alias("similarity")
    )
    return across.unionByName(whole)
