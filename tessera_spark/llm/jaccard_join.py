"""N-gram Jaccard join by universe partition and the pigeonhole principle.

A document's set holds the hashes of its distinct 5-word shingles (of its whole word sequence if
that is shorter). Two sets of sizes r and s with similarity 3/4 or more differ in at most
``(r + s) / 7`` elements.

Large sets (24 and more): sizes fall into bands that double. A band cuts the universe of hashes into
segments; a set's elements of one segment form one signature. A differing element spoils at most one
segment, so of the non-empty segments all but H are equal in both sets, and in any common order the
first H + 1 signatures of the two sets meet. The order is by cost: segments by the frequency of their
rarest element in the whole table, so that a passage or line that many documents share is allocated
last; of equals those of many elements first. A set just below a band is indexed in that band as well.
The frequencies are counted in a pass of their own; they steer the cost only, the links are the same
under any order.

A set with no more than H non-empty segments is not covered by this count. Such sets are compared,
in blocks, with all sets.

Small sets: every element is a segment. Their elements are counted over all small sets, and the
H + 1 rarest are allocated.

Candidates that share a signature pass a bitmap first (each element flips one bit; the bits that
differ between two maps never outnumber the differing elements), then they are compared exactly on
whole sets. Equal sets are one node.
Every member of a signature is compared with one member first, then, in further rounds, with members
drawn anew among those of other components, so a group of near copies grows together by a number of
comparisons in proportion to its members. In the end all pairs of members that are still in different
components are compared, in chunks from which only plausible pairs leave, so no link between components
is lost. Crowded signatures of nearly the same members are compared as one crowd.

Why exact segments and no one-deletion neighbourhoods for large sets: an exact signature costs one
row and covers one difference, a neighbourhood of a segment of g elements costs g + 1 rows and
covers two, so exact signatures are always the cheaper allocation as long as there are segments
enough, and with more segments than elements there are. The uncovered sets, where they would be needed, are few and compared directly.

Defined results: null and wordless texts have an empty set, are linked with nothing and are their
own component; a null id is no candidate for the smallest id of a component, and a component of
null ids only has a null id; repeated rows and equal texts share a component; an empty table gives
an empty result. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera_spark.llm import common
from tessera_spark.llm.components import components

SMALL = 24
SEGMENTS_A_SIZE = 1.5
#: An element with more rows than this is frequent.
FREQUENT = 8
#: So many of the most frequent elements are told to all tasks (12 bytes each). More would only
#: lower the cost, never change the result.
MOST_FREQUENT = 1 << 20
#: A signature with more open members than this is compared by chunks of CHUNK_MEMBERS.
FEW = 16
CHUNK_MEMBERS = 4096
#: Rounds of comparing members with drawn ones before the rest is compared in full: as long as a
#: round leaves at most this share of the open pairs.
MOST_TURNS = 8
STILL_GAINING = 0.7
BLOCK_BYTES = 5 << 20
SETS = "key long, doc_id long, n_shingles long, set_id binary, bits binary, shingles binary"
PAIR = "a long, b long"
#: Shingle hashes keep 48 bits: two sets of a thousand confuse a pair of elements once in 10^8 cases.
HASH_MASK = np.uint64((1 << 48) - 1)


def packed(members: np.ndarray) -> bytes:
    return np.ascontiguousarray(members.view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def unpacked(data: bytes) -> np.ndarray:
    wide = np.zeros((len(data) // 6, 8), np.uint8)
    wide[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return wide.view(np.uint64).ravel()


def bitmap(members: np.ndarray) -> bytes:
    """One bit per hash place, flipped by each element: about twice as many places as elements."""
    places = max(64, 2 << (len(members) - 1).bit_length())
    flips = np.bincount((members % np.uint64(places)).astype(np.int64), minlength=places) & 1
    return np.packbits(flips.astype(np.uint8)).tobytes()


def least_differences(x: bytes, y: bytes) -> int:
    """A lower bound of the number of differing elements, from two bitmaps."""
    a, b = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    while len(a) > len(b):
        a = a[: len(a) // 2] ^ a[len(a) // 2 :]
    while len(b) > len(a):
        b = b[: len(b) // 2] ^ b[len(b) // 2 :]
    return int(np.bitwise_count(a ^ b).sum())


def shingle_set(text: bytes | None, hashes: common.WordHashes) -> np.ndarray:
    """Sorted distinct shingle hashes of a text."""
    words = common.lower_words(text)
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < 5:
        return common.mixed(common.shingles(hashes.of(words), len(words)) + np.uint64(len(words))) & HASH_MASK
    return np.unique(common.shingles(hashes.of(words)) & HASH_MASK)


def make_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The set of each document. A set that this task has just seen is not repeated."""
    import xxhash

    hashes = common.WordHashes()
    context = TaskContext.get()
    key = (context.partitionId() if context else 0) << 40
    seen: set[bytes] = set()
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), common.byte_column(batch, "text"), strict=True):
            members = shingle_set(text, hashes)
            data = packed(members)
            name = xxhash.xxh3_128_digest(data) if data else None
            fresh = name is not None and name not in seen
            rows.append((key, doc_id, len(members), name, bitmap(members) if fresh else None, data if fresh else None))
            key += 1
            if name is not None:
                if len(seen) > 50_000:
                    seen.clear()
                seen.add(name)
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [c.split()[0] for c in SETS.split(", ")])
    del hashes, seen
    common.trim()


def band_of(size: int) -> int:
    return (size // SMALL).bit_length() - 1


def indexes(size: int) -> list[int]:
    """Bands in which a set of this size is indexed."""
    own = band_of(size) if size >= SMALL else -1
    bands = [own] if own >= 0 else []
    if 4 * size >= 3 * (SMALL << (own + 1)):
        bands.append(own + 1)
    return bands


def most_differences(size: int, band: int) -> int:
    """H: for partners of which the larger of the two lies in the band."""
    return (size + min((SMALL << (band + 1)) - 1, 4 * size // 3)) // 7


def signatures(members: np.ndarray, band: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Signatures of all non-empty segments of a set in a band, their numbers of elements, and where
    each begins in the order of the elements by segment, which is returned too."""
    m = int(SEGMENTS_A_SIZE * (SMALL << (band + 1)))
    segment = (common.mixed(members + np.uint64(band + 1)) % np.uint64(m)).astype(np.int64)
    order = np.argsort(segment, kind="stable")
    segment = segment[order]
    start = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1]]))
    with np.errstate(over="ignore"):
        total = np.add.reduceat(common.mixed(members[order]), start)
        count = np.diff(np.append(start, len(segment)))
        name = common.mixed(total + segment[start].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(band) + (count.astype(np.uint64) << np.uint64(48)))
    return name, count, start, order


def allocated(members: np.ndarray, band: int, times: np.ndarray) -> tuple[np.ndarray, bool]:
    """The first H + 1 signatures in the common order, and whether they cover all partners."""
    name, count, start, order = signatures(members, band)
    rarest = np.minimum.reduceat(times[order], start)
    wanted = most_differences(len(members), band) + 1
    return name[np.lexsort((name, -count, rarest))[:wanted]], len(name) >= wanted


def frequencies(members: np.ndarray, frequent: tuple[np.ndarray, np.ndarray], buckets: int) -> np.ndarray:
    """Rows of each element if it is frequent, else 0."""
    code, times = frequent
    if not len(code):
        return np.zeros(len(members), np.int64)
    own = short_code(members, buckets)
    at = np.minimum(np.searchsorted(code, own), len(code) - 1)
    return np.where(code[at] == own, times[at], 0)


def by_bucket(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, positions) of every bucket that occurs."""
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order])) + 1
    for part in np.split(order, cuts) if len(order) else []:
        yield int(bucket[part[0]]), part


COUNTED = "bucket int, steps binary, wide binary, often binary, times binary"
CELLS = "bucket int, base long, low binary, high binary, at binary, uncovered array<long>"


def set_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[int, np.ndarray]]]:
    """(key, members) in blocks of bounded size."""
    block, held = [], 0
    for batch in batches:
        for key, data in zip(batch.column("key").to_pylist(), batch.column("shingles").to_pylist(), strict=True):
            block.append((key, unpacked(data)))
            held += len(data)
        if held > BLOCK_BYTES:
            yield block
            block, held = [], 0
    if block:
        yield block
    common.trim()


def short_code(element: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of an element over 32 bits of the rest: enough to tell frequent ones."""
    return (element % np.uint64(buckets)) << np.uint64(32) | (element // np.uint64(buckets)) & np.uint64(0xFFFFFFFF)


def count_elements(buckets: int):
    """Elements of each block by bucket, as their short codes in order: steps of 24 bits where they
    fit, and those that the block holds more than once with their number."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in set_blocks(batches):
            code, times = np.unique(short_code(np.concatenate([m for _, m in block]), buckets), return_counts=True)
            bucket, rest = (code >> np.uint64(32)).astype(np.int64), (code & np.uint64(0xFFFFFFFF)).astype(np.uint32)
            rows = []
            for number, part in by_bucket(bucket):
                one = rest[part[times[part] == 1]]
                more = part[times[part] > 1]
                step = np.diff(one, prepend=np.uint32(0))
                fits = not len(step) or int(step.max()) < 1 << 24
                rows.append((number, _three_bytes(step) if fits else b"", b"" if fits else one.tobytes(), rest[more].tobytes(), times[more].astype(np.uint32).tobytes()))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
            kinds = [pa.int32(), *[pa.binary()] * 4]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [c.split()[0] for c in COUNTED.split(", ")])

    return count


def _three_bytes(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values.astype(np.uint32).view(np.uint8).reshape(-1, 4)[:, :3]).tobytes()


def _from_three_bytes(data: bytes) -> np.ndarray:
    wide = np.zeros((len(data) // 3, 4), np.uint8)
    wide[:, :3] = np.frombuffer(data, np.uint8).reshape(-1, 3)
    return wide.view(np.uint32).ravel()


def often_met(table: pa.Table) -> pa.Table:
    """Frequent elements of one bucket, by their short codes."""
    lists = {c: table.column(c).to_pylist() for c in ("steps", "wide", "often", "times")}
    once = [np.cumsum(_from_three_bytes(s), dtype=np.uint32) for s in lists["steps"]]
    once += [np.frombuffer(w, np.uint32) for w in lists["wide"]]
    often = np.frombuffer(b"".join(lists["often"]), np.uint32)
    times = np.frombuffer(b"".join(lists["times"]), np.uint32).astype(np.int64)
    single, number = np.unique(np.concatenate(once), return_counts=True)
    # Only what one block holds twice or two blocks hold can be frequent.
    several = number > 1
    code, where = np.unique(np.concatenate([single[several], often]), return_inverse=True)
    total = np.bincount(where, np.concatenate([number[several], times]), len(code)).astype(np.int64)
    at = np.searchsorted(single, code)
    alone = (at < len(single)) & (single[np.minimum(at, len(single) - 1)] == code) if len(single) else np.zeros(len(code), bool)
    total += alone & ~np.isin(code, single[several])
    hot = total > FREQUENT
    return pa.table({"code": pa.array((table.column("bucket")[0].as_py() << 32) | code[hot].astype(np.int64)), "times": pa.array(total[hot])})


def index_cells(buckets: int, frequent):
    """The H + 1 allocated signatures of each set, packed by bucket."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = frequent.value
        for block in set_blocks(batches):
            found, owners, uncovered = [], [], []
            for key, members in block:
                times = frequencies(members, known, buckets)
                for band in indexes(len(members)):
                    name, covered = allocated(members, band, times)
                    found.append(name)
                    owners.append(key)
                    if not covered:
                        uncovered.append(key)
            sig = np.concatenate(found) if found else np.empty(0, np.uint64)
            key = np.repeat(np.array(owners, np.int64), [len(f) for f in found])
            base = int(key.min(initial=1 << 62))
            # Keys of a block can come from several tasks and then lie far apart.
            delta = (key - base).astype(np.uint32 if int(key.max(initial=0)) - base < 1 << 32 else np.uint64)
            rest = sig // np.uint64(buckets)
            rows = [
                (bucket, base, rest[part].astype(np.uint32).tobytes(), (rest[part] >> np.uint64(32)).astype(np.uint16).tobytes(), delta[part].tobytes(), None)
                for bucket, part in by_bucket((sig % np.uint64(buckets)).astype(np.int64))
            ]
            if uncovered:
                rows.append((0, 0, b"", b"", b"", uncovered))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
            kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [c.split()[0] for c in CELLS.split(", ")])

    return index


def meet(table: pa.Table) -> pa.Table:
    """Rows of one bucket whose signature occurs at least twice, with the smallest key that has it;
    uncovered sets without a signature."""
    bucket = table.column("bucket")[0].as_py()
    sigs, keys = [], []
    for base, low, high, at in zip(*(table.column(c).to_pylist() for c in ("base", "low", "high", "at")), strict=True):
        s = np.frombuffer(low, np.uint32).astype(np.uint64) | np.frombuffer(high, np.uint16).astype(np.uint64) << np.uint64(32)
        width = np.uint32 if len(at) == len(low) else np.uint64
        sigs.append(s)
        keys.append(np.frombuffer(at, width).astype(np.int64) + base)
    sig, key = np.concatenate(sigs), np.concatenate(keys)
    order = np.lexsort((key, sig))
    sig, key = sig[order], key[order]
    same = sig[1:] == sig[:-1]
    twice = np.concatenate([[False], same]) | np.concatenate([same, [False]]) if len(sig) else np.zeros(0, bool)
    sig, key = sig[twice], key[twice]
    first = np.concatenate([[True], sig[1:] != sig[:-1]]) if len(sig) else np.zeros(0, bool)
    chief = key[np.maximum.accumulate(np.where(first, np.arange(len(sig)), 0))] if len(sig) else key
    sig = (np.uint64(bucket) << np.uint64(48) | sig).astype(np.int64)
    uncovered = [k for keys in table.column("uncovered").to_pylist() if keys for k in keys]
    return pa.table(
        {
            "sig": pa.concat_arrays([pa.array(sig), pa.nulls(len(uncovered), pa.int64())]),
            "key": pa.concat_arrays([pa.array(key), pa.array(uncovered, pa.int64())]),
            "chief": pa.concat_arrays([pa.array(chief), pa.nulls(len(uncovered), pa.int64())]),
        }
    )


def small_signatures(sets: DataFrame) -> DataFrame:
    """sig, key, chief for sets below SMALL: the H + 1 elements that fewest small sets hold."""

    def elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sig, key, wanted = [], [], []
            for k, data in zip(batch.column("key").to_pylist(), batch.column("shingles").to_pylist(), strict=True):
                members = unpacked(data)
                size = len(members)
                sig.extend(members.tolist())
                key.extend([k] * size)
                wanted.extend([(size + min(SMALL - 1, 4 * size // 3)) // 7 + 1] * size)
            yield pa.RecordBatch.from_arrays([pa.array(sig, pa.int64()), pa.array(key, pa.int64()), pa.array(wanted, pa.int32())], ["sig", "key", "wanted"])

    small = sets.filter((F.col("n_shingles") < SMALL) & F.col("shingles").isNotNull()).select("key", "shingles")
    each = common.stored(small.mapInArrow(elements, "sig long, key long, wanted int"), "small-elements")
    often = each.groupBy("sig").count().filter("count > 1")
    counted = each.join(often, "sig", "left").withColumn("count", F.coalesce("count", F.lit(1)))
    rank = F.row_number().over(Window.partitionBy("key").orderBy("count", "sig"))
    chosen = common.stored(counted.withColumn("rank", rank).filter("rank <= wanted and count > 1").select("sig", "key"), "small-chosen")
    chiefs = chosen.groupBy("sig").agg(F.min("key").alias("chief"), F.count("*").alias("n")).filter("n > 1").drop("n")
    return chosen.join(chiefs, "sig").select(F.xxhash64(F.lit("small"), "sig").alias("sig"), "key", "chief")


def plausible(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """Pairs (a, b) of keys of sets that sizes and bitmaps allow."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("xa", "xb", "na", "nb"))
            keep = [least_differences(x, y) <= (na + nb) // 7 for x, y, na, nb in zip(*columns, strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    of_a = sketches.select(F.col("key").alias("a"), F.col("n_shingles").alias("na"), F.col("bits").alias("xa"))
    of_b = sketches.select(F.col("key").alias("b"), F.col("n_shingles").alias("nb"), F.col("bits").alias("xb"))
    both = pairs.join(of_a, "a").join(of_b, "b").filter(4 * F.least("na", "nb") >= 3 * F.greatest("na", "nb"))
    return both.select("a", "b", "na", "nb", "xa", "xb").mapInArrow(compare, PAIR)


def linked(pairs: DataFrame, sets: DataFrame, sketches: DataFrame, name: str) -> DataFrame:
    """Pairs (a, b) of keys whose sets reach the similarity, compared exactly."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("sa").to_pylist(), batch.column("sb").to_pylist(), strict=True):
                x, y = unpacked(x), unpacked(y)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= 75 * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = common.stored(plausible(pairs, sketches), f"{name}-pairs")
    asked = common.stored(left.select(F.explode(F.array("a", "b")).alias("key")).distinct(), f"{name}-keys")
    contents = common.stored(sets.select("key", "shingles").join(common.small_or_plain(asked), "key", "left_semi"), f"{name}-sets")
    of_a = contents.select(F.col("key").alias("a"), F.col("shingles").alias("sa"))
    of_b = contents.select(F.col("key").alias("b"), F.col("shingles").alias("sb"))
    found = left.join(of_a, "a").join(of_b, "b").select("a", "b", "sa", "sb").mapInArrow(compare, PAIR)
    links = common.stored(found, f"{name}-links")
    common.discard(left, asked, contents)
    return links


def uncovered_pairs(spark: SparkSession, sets: DataFrame, uncovered: DataFrame) -> DataFrame | None:
    """Links of uncovered sets, found by comparing blocks of them with every set."""
    if uncovered.isEmpty():
        return None
    asked = common.stored(sets.join(uncovered, "key", "left_semi").select("key", "shingles"), "uncovered")
    blocks = asked.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(-(-asked.count() // 1000))))
    whole = sets.filter(F.col("shingles").isNotNull()).select("key", "shingles")
    found = None
    for block in sorted(r[0] for r in blocks.select("block").distinct().collect()):
        part = [(r["key"], unpacked(bytes(r["shingles"]))) for r in blocks.filter(F.col("block") == block).collect()]
        query = spark.sparkContext.broadcast(part)

        def compare(batches: Iterator[pa.RecordBatch], query=query) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                a, b = [], []
                for key, data in zip(batch.column("key").to_pylist(), batch.column("shingles").to_pylist(), strict=True):
                    y = unpacked(data)
                    for own, x in query.value:
                        if 4 * min(len(x), len(y)) >= 3 * max(len(x), len(y)) and own != key:
                            both = len(np.intersect1d(x, y, assume_unique=True))
                            if 100 * both >= 75 * (len(x) + len(y) - both):
                                a.append(own)
                                b.append(key)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        links = common.stored(whole.mapInArrow(compare, PAIR), "uncovered-links")
        found = links if found is None else found.unionByName(links)
    return found


def _folded(bits: np.ndarray) -> np.ndarray:
    half = bits.shape[1] // 2
    return bits[:, :half] ^ bits[:, half:]


def compare_block(table: pa.Table) -> pa.Table:
    """Plausible pairs of members of different components, of one signature and pair of chunks."""
    first, second = table.column("first")[0].as_py(), table.column("second")[0].as_py()
    key, root, n, chunk = (table.column(c).to_numpy() for c in ("key", "root", "n_shingles", "chunk"))
    bits = table.column("bits").to_pylist()
    width = np.array([len(b) for b in bits])
    out_a, out_b = [], []
    for w in np.unique(width).tolist():
        for v in (w, 2 * w):  # sets of similar size have maps of the same or of twice the width
            left, right = np.flatnonzero((width == w) & (chunk == first)), np.flatnonzero((width == v) & (chunk == second))
            pairs = [(left, right)]
            if v != w and first != second:
                pairs.append((np.flatnonzero((width == w) & (chunk == second)), np.flatnonzero((width == v) & (chunk == first))))
            for x, y in pairs:
                if not len(x) or not len(y):
                    continue
                map_x = np.frombuffer(b"".join(bits[k] for k in x), np.uint8).reshape(len(x), -1).view(np.uint64)
                map_y = np.frombuffer(b"".join(bits[k] for k in y), np.uint8).reshape(len(y), -1)
                map_y = (map_y if v == w else _folded(map_y)).view(np.uint64)
                for k, own in enumerate(map_x):
                    at = x[k]
                    differ = np.bitwise_count(map_y ^ own).sum(axis=1, dtype=np.int64)
                    low, high = np.minimum(n[y], n[at]), np.maximum(n[y], n[at])
                    good = (root[y] != root[at]) & (differ <= (n[y] + n[at]) // 7) & (4 * low >= 3 * high)
                    if first == second and v == w:
                        good &= key[y] > key[at]
                    for other in key[y[good]].tolist():
                        out_a.append(min(other, int(key[at])))
                        out_b.append(max(other, int(key[at])))
    return pa.table({"a": pa.array(out_a, pa.int64()), "b": pa.array(out_b, pa.int64())})


def crowds(many: DataFrame) -> DataFrame:
    """sig, key, root of crowded signatures, those of nearly the same members as one: a signature
    is named by the member that comes first in a hashed order. A passage that many documents share
    fills many signatures with the same members, whose pairs are then met once and not in each."""
    leader = F.min(F.struct(F.xxhash64("key").alias("draw"), F.col("key").alias("leader")))
    leaders = many.groupBy("sig").agg(leader.alias("first")).select("sig", "first.leader")
    return many.join(leaders, "sig").select(F.col("leader").alias("sig"), "key", "root").distinct()


def open_pairs(open_members: DataFrame, sketches: DataFrame) -> DataFrame:
    """Pairs (a, b), a < b, that share a signature and lie in different components. Signatures of
    few members are joined; crowds are dealt out by pairs of chunks, and only what the bitmaps
    allow leaves a task."""
    sizes = common.stored(open_members.groupBy("sig").agg(F.count("*").alias("n")), "open-sizes")
    few = open_members.join(sizes.filter(F.col("n") <= FEW), "sig", "left_semi")
    other = few.select("sig", F.col("key").alias("b"), F.col("root").alias("rb"))
    joined = few.withColumnRenamed("key", "a").join(other, "sig").filter((F.col("a") < F.col("b")) & (F.col("root") != F.col("rb"))).select("a", "b")
    many = common.stored(crowds(open_members.join(sizes.filter(F.col("n") > FEW), "sig", "left_semi")), "open-crowds")
    chunks = F.ceil(F.col("n") / CHUNK_MEMBERS).cast("int")
    many = many.join(many.groupBy("sig").agg(F.count("*").alias("n")), "sig").withColumn("chunks", chunks)
    many = many.withColumn("chunk", F.pmod(F.xxhash64("key"), F.col("chunks")).cast("int"))
    # A chunk meets itself and every other one once.
    many = many.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    many = many.withColumn("first", F.least("chunk", "with")).withColumn("second", F.greatest("chunk", "with"))
    many = many.select("sig", "first", "second", "key", "root", "chunk").join(sketches.select("key", "n_shingles", "bits"), "key")
    blocks = many.groupBy("sig", "first", "second").applyInArrow(compare_block, PAIR)
    return joined.unionByName(blocks).distinct()


def _open_members(members: DataFrame, roots: DataFrame) -> DataFrame:
    """sig, key, root of signatures whose members lie in several components."""
    told = common.small_or_plain(roots.withColumnRenamed("node", "key"))
    placed = members.join(told, "key", "left").withColumn("root", F.coalesce("root", "key"))
    several = placed.groupBy("sig").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high").select("sig")
    several = common.small_or_plain(common.stored(several, "several"))
    return placed.join(several, "sig", "left_semi").select("sig", "key", "root")


def _open_pairs(open_members: DataFrame) -> DataFrame:
    """Rows, and pairs of members of one signature in different components, without making them."""
    by_root = open_members.groupBy("sig", "root").agg(F.count("*").alias("n"))
    by_sig = by_root.groupBy("sig").agg(F.sum("n").cast("double").alias("n"), F.sum(F.col("n").cast("double") * F.col("n")).alias("squares"))
    return by_sig.agg(F.sum("n").alias("rows"), F.sum((F.col("n") * F.col("n") - F.col("squares")) / 2).alias("pairs"))


def jaccard_join(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", buckets: int | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id, one row per input row."""
    spark = docs.sparkSession
    common.prepared(spark)
    buckets = min(1 << 15, buckets or 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    sets = common.stored(rows.mapInArrow(make_sets, SETS), "sets")
    large = sets.filter(F.col("shingles").isNotNull() & (F.col("n_shingles") >= 3 * SMALL // 4)).select("key", "shingles")
    counted = large.mapInArrow(count_elements(buckets), COUNTED).groupBy("bucket").applyInArrow(often_met, "code long, times long")
    counted = common.stored(counted, "frequent")
    common.release(spark)
    told = counted.orderBy(F.desc("times"), "code").limit(MOST_FREQUENT).select("code", "times").toArrow()
    code = told.column("code").to_numpy().astype(np.uint64)
    order = np.argsort(code)
    frequent = spark.sparkContext.broadcast((code[order], told.column("times").to_numpy()[order].astype(np.int32)))
    met = large.mapInArrow(index_cells(buckets, frequent), CELLS).groupBy("bucket").applyInArrow(meet, "sig long, key long, chief long")
    met = common.stored(met.unionByName(small_signatures(sets)), "met")
    common.release(spark)

    # Equal sets that different tasks have seen are one node: the smallest key among them.
    names = sets.filter(F.col("shingles").isNotNull()).select("key", "set_id")
    nodes = names.groupBy("set_id").agg(F.min("key").alias("node"), F.count("*").alias("n")).filter("n > 1").drop("n")
    again = common.stored(names.join(nodes, "set_id").filter("key <> node").select("key", "node"), "again")
    again = common.small_or_plain(again)

    def as_nodes(table: DataFrame, column: str) -> DataFrame:
        known = again.select(F.col("key").alias(column), F.col("node").alias("own_node"))
        joined = table.join(known, column, "left").withColumn(column, F.coalesce("own_node", column))
        return joined.select(table.columns)

    chiefs = met.filter(F.col("sig").isNotNull() & (F.col("key") != F.col("chief"))).select("key", "chief").distinct()
    pairs = as_nodes(as_nodes(chiefs, "key"), "chief").select(F.least("key", "chief").alias("a"), F.greatest("key", "chief").alias("b"))
    pairs = common.stored(pairs.filter("a <> b").distinct(), "star-candidates")
    candidates = common.stored(met.filter(F.col("sig").isNotNull()).select("key").distinct(), "candidates")
    sketches = sets.select("key", "n_shingles", "bits").join(common.small_or_plain(candidates), "key", "left_semi")
    sketches = common.stored(sketches, "sketches")
    links = linked(pairs, sets, sketches, "star")
    more = uncovered_pairs(spark, sets, met.filter(F.col("sig").isNull()).select("key").distinct())
    if more is not None:
        links = common.stored(links.unionByName(as_nodes(as_nodes(more, "a"), "b").select("a", "b")), "more-links")
    common.release(spark)

    roots = components(links)
    members = common.stored(as_nodes(met.filter(F.col("sig").isNotNull()).select("sig", "key"), "key").distinct(), "members")
    tested, before = pairs, float("inf")
    # Members of one signature in different components so far. Components only grow together, so
    # what is open later is among what is open now.
    open_members = common.stored(_open_members(members, roots), "open-members")
    for turn in range(MOST_TURNS):
        sums = _open_pairs(open_members).first()
        left = sums["pairs"] or 0.0
        if left <= 2 * (sums["rows"] or 0) or left > STILL_GAINING * before:
            break
        before = left
        # Every signature draws another member; those not yet in its component are compared with it.
        chief = F.min(F.struct(F.xxhash64("key", "sig", F.lit(turn)).alias("draw"), F.col("key").alias("chief"), F.col("root").alias("chief_root")))
        chiefs = open_members.groupBy("sig").agg(chief.alias("c")).select("sig", "c.chief", "c.chief_root")
        drawn = open_members.join(chiefs, "sig").filter("root <> chief_root")
        drawn = drawn.select(F.least("key", "chief").alias("a"), F.greatest("key", "chief").alias("b")).distinct()
        fresh = common.stored(drawn.join(tested, ["a", "b"], "left_anti"), "drawn")
        found = linked(fresh, sets, sketches, f"turn-{turn}")
        tested = tested.unionByName(fresh)
        if found.isEmpty():
            break
        links = links.unionByName(found)
        roots = components(links)
        still = common.stored(_open_members(open_members.select("sig", "key"), roots), "open-members")
        common.discard(open_members)
        open_members = still
    across = open_pairs(open_members, sketches).join(tested, ["a", "b"], "left_anti")
    late = linked(across, sets, sketches, "late")
    if not late.isEmpty():
        roots = components(links.unionByName(late))

    every = common.stored(sets.select("doc_id", "n_shingles", "set_id", "key", F.col("shingles").isNotNull().alias("first")), "set-of-document")
    common.discard(sets, met, members, sketches, open_members)
    lone = every.filter(F.col("set_id").isNull()).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    by_set = every.filter(F.col("set_id").isNotNull()).groupBy("set_id").agg(F.min("doc_id").alias("low"), F.min(F.when(F.col("first"), F.col("key"))).alias("node"))
    by_set = common.stored(by_set.join(roots, "node", "left"), "set-roots")
    by_root = by_set.filter(F.col("root").isNotNull()).groupBy("root").agg(F.min("low").alias("least"))
    named = common.stored(by_set.join(by_root, "root", "left").select("set_id", F.coalesce("least", "low").alias("component_id")), "set-names")
    return lone.unionByName(every.join(named, "set_id").select("doc_id", "n_shingles", "component_id"))


def one_of_each_group(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The input's rows and columns, of each component only the row with the smallest id (null ids
    last; of rows that repeat it, one). Documents without words are kept, each on its own."""
    common.prepared(docs.sparkSession)
    numbered = common.stored(docs.select(F.monotonically_increasing_id().alias("own_row"), F.struct("*").alias("row")), "numbered")
    ids = numbered.select("own_row", F.col(f"row.{doc_id}").alias("own_id"))
    slim = numbered.select("own_row", F.col(f"row.{text}").alias("text"))
    groups = common.stored(jaccard_join(slim, doc_id="own_row").select(F.col("doc_id").alias("own_row"), "component_id"), "groups")
    sized = groups.groupBy("component_id").agg(F.count("*").alias("rows")).filter("rows > 1")
    several = groups.join(sized.select("component_id"), "component_id", "left_semi").join(ids, "own_row")
    first = several.groupBy("component_id").agg(F.min(F.struct(F.col("own_id").isNull().alias("none"), "own_id", "own_row")).alias("first"))
    dropped = several.join(first, "component_id").filter(F.col("own_row") != F.col("first.own_row")).select("own_row")
    dropped = common.stored(dropped, "copies")
    return numbered.join(common.small_or_plain(dropped), "own_row", "left_anti").select("row.*")
