"""Sharding, mixing, joins, decontamination, repeats, pages and the pipeline against plain versions."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tessera_spark.llm import common, components, decontaminate, jaccard_join, mixing, pages, quality, sharding, substring_dedup
from tests.llm.conftest import SCHEMA, full, prose


def words(text):
    return (text or "").encode().lower().split()


# Sharding


def plain_shards(rows, shards=16):
    keyed = sorted(
        (zlib.crc32((t or "").encode()), d is not None, d or 0, len((t or "").encode()) + 1) for d, t in rows
    )
    total = sum(k[3] for k in keyed)
    start, slots, out = 0, Counter(), []
    for crc, known, doc, size in keyed:
        shard = (2 * start + size) * shards // (2 * total)
        out.append((doc if known else None, size, crc, shard, slots[shard]))
        slots[shard] += 1
        start += size
    return out


def test_shards(edge_docs, edge_rows, no_docs):
    found = sharding.digest(sharding.shard(edge_docs)).collect()
    plain = plain_shards([r[:2] for r in edge_rows])
    assert Counter((r.doc_id, r.size, r.text_crc32, r.shard, r.slot) for r in found) == Counter(plain)
    assert {(r.law, r.grown_shard) for r in found} == {("bytes", None)}
    assert sharding.shard(no_docs).count() == 0
    carried = sharding.shard(edge_docs, carry=True)
    assert carried.select("row.*").columns == edge_docs.columns and carried.count() == len(edge_rows)


def test_overfull_ranges_are_cut_and_hot_texts_split(spark):
    hot = "same text " * 30
    rows = [(k, hot if k % 3 == 0 else prose(k, 20)) for k in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = sharding.shard(docs).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32, r.shard, r.slot) for r in found) == Counter(plain_shards(rows))
    sizes = Counter()
    for r in found:
        sizes[r.shard] += r.size
    assert max(sizes.values()) - min(sizes.values()) <= 2 * max(r.size for r in found)
    assert len({r.shard for r in found if r.text_crc32 == zlib.crc32(hot.encode())}) > 3
    sized = docs.select("doc_id", (F.octet_length("text") + 1).cast("long").alias("size"), F.crc32(F.col("text").cast("binary")).alias("text_crc32"))
    splitters, sums = sharding.range_splitters(sized, ranges=8)
    share = 2 * sum(s["bytes"] for s in sums) / 8
    assert all(s["bytes"] <= share or s["low"] == s["high"] for s in sums) and sorted(splitters) == splitters


# Mixing


def plain_targets(sizes, share=1.5, weights=(5, 2, 1)):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % 3] for k, s in enumerate(order)}
    target, capped = {}, set()
    while True:
        left = share * sum(sizes.values()) - sum(2 * sizes[s] for s in capped)
        free = [s for s in order if s not in capped]
        target = {s: 2.0 * sizes[s] for s in capped} | {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        over = {s for s in free if target[s] > 2 * sizes[s]}
        if not over:
            return target
        capped |= over


def test_mix(edge_docs, edge_rows, no_docs):
    found = mixing.mix(edge_docs).collect()
    sizes = Counter()
    for r in edge_rows:
        sizes[r[3]] += len(words(r[1]))
    targets = plain_targets(sizes)
    taken, most = Counter(), Counter()
    for r in found:
        assert r.source_size == sizes[r.source] and abs(r.target - targets[r.source]) < 1e-6 * max(1, r.target)
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
        most[r.source] = max(most[r.source], r.size)
    assert all(abs(taken[s] - targets[s]) <= 2 * most[s] for s in sizes)
    assert Counter(map(tuple, found)) == Counter(map(tuple, mixing.mix(edge_docs).collect()))
    assert mixing.mix(no_docs).count() == 0
    carried = mixing.mix(edge_docs, carry=True)
    assert carried.select("row.*").columns == edge_docs.columns
    assert sorted(r.taken for r in carried.collect()) == sorted(r.taken for r in found)


def test_targets_reach_the_share(spark):
    rng = random.Random(2)
    sizes = {f"s{k:02d}": rng.choice([1, 10, 500, 10_000]) * rng.randint(1, 9) for k in range(40)} | {None: 77, "zero": 0}
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    found = {r.source: r.target for r in mixing.source_targets(frame).collect()}
    plain = plain_targets(sizes)
    assert all(abs(found[s] - plain[s]) < 1e-6 * max(1, plain[s]) for s in sizes)
    assert abs(sum(found.values()) - 1.5 * sum(sizes.values())) < 1e-3


def test_heavier_documents_are_taken_more_often(spark):
    rows = [(k, "a b c d", "s" if k % 2 else "t", 4.0 if k % 4 < 2 else 1.0) for k in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, weight double")
    found = mixing.mix(docs, weight="weight", share_percent=40, most_copies=1)
    mean = {r.heavy: r.m for r in found.groupBy((F.col("doc_id") % 4 < 2).alias("heavy")).agg(F.avg("copies").alias("m")).collect()}
    assert mean[True] > 2.5 * mean[False]
    by_source = found.groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("g")).collect()
    assert all(abs(r.t - r.g) <= 4 for r in by_source)


# N-gram Jaccard join


def plain_groups(rows):
    sets = []
    for _, t in rows:
        w = words(t)
        sets.append(frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    group = list(range(len(rows)))

    def root(k):
        while group[k] != k:
            k = group[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                    group[root(a)] = root(b)
    least = {}
    for k, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root(k)] = min(doc, least.get(root(k), doc))
    return Counter((d, len(sets[k]), least.get(root(k)) if sets[k] else d) for k, (d, _) in enumerate(rows))


def near_copies(seed, n):
    """Texts of all sizes with edits, and shared lines and passages between strangers."""
    rng = random.Random(seed)
    out, passage, line = [], prose(900, 60), "all rights reserved by the owners of this page"
    for k in range(n):
        base = prose(1000 + k // 3, rng.choice([1, 4, 5, 6, 8, 12, 20, 26, 40, 90, 300])).split()
        for _ in range(rng.choice([0, 0, 1, 2, 5])):
            base[rng.randrange(len(base))] = rng.choice(["x", "y", "zz"])
        if rng.random() < 0.3:
            base += passage.split()
        if rng.random() < 0.3:
            base += line.split()
        out.append((k, " ".join(base)))
    return out


def test_jaccard_join(spark, edge_docs, edge_rows, no_docs):
    found = jaccard_join.jaccard_join(edge_docs).collect()
    assert Counter(map(tuple, found)) == plain_groups([r[:2] for r in edge_rows])
    assert jaccard_join.jaccard_join(no_docs).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_join_on_near_copies(spark, seed):
    rows = near_copies(seed, 300)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert Counter(map(tuple, jaccard_join.jaccard_join(docs).collect())) == plain_groups(rows)


def test_large_groups_of_unlinked_near_copies(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "FEW", 2)
    monkeypatch.setattr(jaccard_join, "CHUNK_MEMBERS", 7)
    rng = random.Random(9)
    base = prose(77, 120).split()
    rows = []
    for k in range(120):
        own = list(base) + prose(k, rng.choice([0, 20, 40])).split()
        for _ in range(rng.choice([1, 3, 6, 9])):
            own[rng.randrange(120)] = f"edit{rng.randrange(9)}"
        rows.append((k, " ".join(own)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert Counter(map(tuple, jaccard_join.jaccard_join(docs).collect())) == plain_groups(rows)


def test_uncovered_sets_are_compared(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "SEGMENTS_A_SIZE", 0.05)  # too few segments for any set
    base = prose(7, 60).split()
    rows = [(k, " ".join([*base[:k], "new", *base[k:]])) for k in range(0, 60, 10)] + [(99, prose(8, 60))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sets = common.stored(docs.mapInArrow(jaccard_join.make_sets, jaccard_join.SETS), "t")
    links = jaccard_join.uncovered_pairs(spark, sets, sets.select("key"))
    doc = {r.key: r.doc_id for r in sets.collect()}
    roots = {doc[r.node]: doc[r.root] for r in components.components(links).collect()}
    assert roots == {k: 0 for k in range(0, 60, 10)}


def test_bitmaps_never_exceed_the_difference():
    rng = np.random.default_rng(0)
    for _ in range(200):
        whole = np.unique(rng.integers(0, 1 << 48, 400).astype(np.uint64))
        a, b = whole[rng.random(len(whole)) < 0.7], whole[rng.random(len(whole)) < rng.choice([0.2, 0.9])]
        bound = jaccard_join.least_differences(jaccard_join.bitmap(a), jaccard_join.bitmap(b))
        assert bound <= len(np.setxor1d(a, b))
        assert (jaccard_join.unpacked(jaccard_join.packed(a)) == a).all()


def test_components(spark):
    rng = random.Random(3)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(k, k + 1) for k in range(300, 340)] + [(500, 500)]
    group = {}
    for a, b in links:
        group.setdefault(a, {a})
        group.setdefault(b, {b})
        if group[a] is not group[b]:
            whole = group[a] | group[b]
            for x in whole:
                group[x] = whole
    found = components.components(spark.createDataFrame(links, "a long, b long")).collect()
    by_root = defaultdict(set)
    for r in found:
        by_root[r.root].add(r.node)
    assert sorted(map(sorted, by_root.values())) == sorted({tuple(sorted(g)): sorted(g) for g in group.values()}.values())


# Decontamination


def plain_leaks(items, texts):
    out = set()
    for d, t in texts:
        w = words(t)
        for i, b in items:
            item = words(b)
            if not item:
                continue
            cost = [0] * (len(w) + 1)
            for k, x in enumerate(item):
                row = [k + 1]
                for j, y in enumerate(w):
                    row.append(min(cost[j] + (x != y), cost[j + 1] + 1, row[j] + 1))
                cost = row
            if min(cost) <= len(item) // 5:
                out.add((d, i))
    return out


def test_leaks(spark, edge_docs, no_docs):
    rng = random.Random(5)
    items = [(k, prose(300 + k, rng.choice([3, 12, 20, 40, 60]))) for k in range(20)] + [(50, None), (51, " "), (None, prose(400, 20)), (7, prose(401, 25))]
    texts = []
    for k in range(120):
        text = prose(2000 + k, 150).split()
        item = words(items[k % 20][1])
        item = [x.decode() for x in item]
        for _ in range(rng.choice([0, 0, len(item) // 5, len(item) // 5 + 3])):
            at = rng.randrange(len(item) + 1)
            item[at : at + rng.choice([0, 1])] = rng.choice([[], ["new"], ["odd"]])
        at = rng.randrange(len(text))
        texts.append((k, " ".join(text[:at] + item + text[at:])))
    texts += [(200, None), (201, ""), (None, items[3][1].upper()), (202, prose(401, 25))]
    docs = spark.createDataFrame([full(*t) for t in texts], SCHEMA)
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, row_id int")
    found = {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, bench).collect()}
    expected = plain_leaks(items, texts)
    assert found <= expected
    assert len(found) >= 0.97 * len(expected)
    clean = decontaminate.decontaminated(docs, bench)
    assert clean.columns == docs.columns
    assert Counter(r.doc_id for r in clean.collect()) == Counter(d for d, _ in texts if not any((d, i) in found for i, _ in items))
    assert decontaminate.leaks(no_docs, bench).count() == 0
    assert decontaminate.leaks(docs, bench.limit(0)).count() == 0
    assert decontaminate.leaks(edge_docs, bench).count() == 0


def test_nearest_run_is_exact():
    rng = np.random.default_rng(4)
    for _ in range(60):
        item, region = rng.integers(1, 5, rng.integers(1, 8)), rng.integers(1, 5, rng.integers(1, 20))
        edits, a, b = decontaminate.best_match(item, region)
        cost = np.arange(len(region) + 1) * 0
        for k, x in enumerate(item):
            row = [k + 1]
            for j, y in enumerate(region):
                row.append(min(cost[j] + (x != y), cost[j + 1] + 1, row[j] + 1))
            cost = np.array(row)
        assert edits == cost.min()
        part, whole = region[a:b], [list(range(b - a + 1))]
        for k, x in enumerate(item):
            row = [k + 1]
            for j, y in enumerate(part):
                row.append(min(whole[-1][j] + (x != y), whole[-1][j + 1] + 1, row[j] + 1))
            whole.append(row)
        assert whole[-1][-1] == edits


# Repeated passages


def test_windows_are_the_nodes_of_the_tree():
    rng = np.random.default_rng(7)
    values = rng.integers(0, 1 << 63, 300).astype(np.uint64)
    values[50] = values[60]
    begin, stop = np.array([0, 100, 110]), np.array([100, 110, 300])
    mask = np.uint64((1 << substring_dedup.PLACE_BITS) - 1)
    found = sorted(zip(*(x.tolist() for x in substring_dedup.compact_windows(values, begin, stop, 8))))
    expected = []
    for a, b in zip(begin.tolist(), stop.tolist()):
        for c in range(a, b):
            key = lambda k: (int(values[k] & ~mask), k)
            low = c
            while low > a and key(low - 1) > key(c):
                low -= 1
            high = c
            while high < b - 1 and key(high + 1) > key(c):
                high += 1
            if high - low + 1 >= 8:
                expected.append((low, c, high))
    assert found == sorted(expected)


def test_repeated_passages(spark, edge_docs, no_docs):
    passage, short = prose(70, 56).split(), prose(71, 30).split()
    rows = []
    for k in range(40):
        own = prose(3000 + k, 90).split()
        if k < 12:
            own[20:20] = passage
        elif k < 20:
            own[40:40] = short
        rows.append(full(k, " ".join(own)))
    near = prose(72, 200).split()
    rows.append(full(50, " ".join(near)))
    near[20] = near[90] = near[150] = "changed"
    rows += [full(51, " ".join(near)), full(52, prose(73, 70)), full(53, prose(73, 70)), full(54, None), full(None, prose(74, 60))]
    found = substring_dedup.repeated_passages(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert {r.doc_id for r in found} == {*range(12), 50, 51, 52, 53}
    text = {r[0]: words(r[1]) for r in rows}
    for r in found:
        a, b = text[r.doc_id][r.start_word : r.stop_word], text[r.other_doc_id][r.other_start : r.other_stop]
        a, b = ({tuple(x[k : k + 5]) for k in range(len(x) - 4)} for x in (a, b))
        assert len(a & b) >= 0.75 * len(a | b) and r.stop_word - r.start_word >= 50 and r.doc_id != r.other_doc_id
    assert all(any(r.doc_id == k and r.start_word <= 22 and r.stop_word >= 74 for r in found) for k in range(12))
    # Among the edge rows: 3 and its near copy 24, 0 and 25, and the rows that repeat 5.
    edge = substring_dedup.repeated_passages(edge_docs).collect()
    assert {r.doc_id for r in edge} == {0, 3, 5, 24, 25}
    assert substring_dedup.repeated_passages(no_docs).count() == 0


def test_exact_copies_under_a_common_phrase(spark, monkeypatch):
    """Every pair shares 50 words of its own around a phrase of 200 other texts, one of which stands for
    the phrase's signatures."""
    monkeypatch.setattr(substring_dedup, "CHUNK_MEMBERS", 64, raising=False)
    phrase = prose(90, 30)
    rows = [full(k, f"{prose(9000 + k, 40)} {phrase} {prose(9500 + k, 40)}") for k in range(200)]
    for k in range(60):
        passage = f"{prose(10000 + k, 10)} {phrase} {prose(10100 + k, 10)}"
        rows += [full(1000 + 2 * k + side, f"{prose(11000 + 2 * k + side, 30)} {passage} {prose(12000 + 2 * k + side, 30)}") for side in (0, 1)]
    found = substring_dedup.repeated_passages(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert {(r.doc_id, r.other_doc_id) for r in found if r.start_word <= 30 and r.stop_word >= 80} == {(k, k ^ 1) for k in range(1000, 1120)}


def test_recall_of_short_near_copies(spark):
    """Pairs of 50 to 60 words that differ in one or two words of the middle, against their similarity."""
    rows, pairs = [], 0
    for k in range(400):
        text = prose(20000 + k, 50 + k % 11).split()
        other = list(text)
        for at in range(1 + k % 2):
            other[len(text) // 2 + at] = f"changed{at}"
        a, b = ({tuple(x[i : i + 5]) for i in range(len(x) - 4)} for x in (text, other))
        if len(a & b) >= 0.75 * len(a | b):
            rows += [full(2 * pairs, " ".join(text)), full(2 * pairs + 1, " ".join(other))]
            pairs += 1
    found = substring_dedup.repeated_passages(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    recall = len({(r.doc_id, r.other_doc_id) for r in found if r.other_doc_id == r.doc_id ^ 1}) / (2 * pairs)
    assert pairs > 350 and recall >= 0.9


def test_long_texts_are_cut_with_overlap(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "BLOCK_SHINGLES", 64)
    text = prose(80, 400)
    rows = [(1, text.encode()), (2, (prose(81, 30) + " " + text).encode())]
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"key": [r[0] for r in rows], "text": [r[1] for r in rows]})
    seen = defaultdict(set)
    for out in substring_dedup.make_windows(4)(iter([batch])):
        for sig, at, key in zip(out.column("sig").to_pylist(), out.column("at").to_pylist(), out.column("keys").to_pylist()):
            if sig:
                for s, a, k in zip(np.frombuffer(sig, np.uint64), np.frombuffer(at, np.uint32), np.frombuffer(key, np.int64)):
                    seen[int(k)].add((int(s), int(a)))
    assert {(s, a + 30) for s, a in seen[1]} & seen[2] and max(a for _, a in seen[1]) > 300


# Pages


def page(body, head=""):
    return f"<html><head><title>T</title>{head}</head><body>{body}</body></html>"


def test_pages(spark):
    good = "<article><h1>Head &amp; line</h1><p>First  part<p>Second\n <b>bold</b><br>third</article>"
    furniture = "<nav><a href=/x>Home page of the site</a></nav><div class='ad big1'>Buy this now, it is cheap</div>"
    after = "<div class='comments'><p>I disagree</p></div><form><p>Send</p></form><footer>About</footer><script>var a='<p>no</p>'</script>"
    text = "Head & line\nFirst part\nSecond bold\nthird"
    rows = [
        (1, "http://a.org/1", page(furniture + good + after)),
        (2, "http://A.org/2?x", page(furniture + good + after)),
        (3, None, page(furniture + "<div id=m><p>Only text that is here</p></div>" + after)),
        (4, "not a url", ""),
        (5, "http://a.org/3", None),
        (6, "http://a.org/4", "no markup at all, 1 < 2"),
        (None, "http://b.org", page("<article><p>" + "<b>" * 300 + "deep" + "</article>")),
        (1, "http://a.org/1", page(furniture + good + after)),
    ]
    frame = spark.createDataFrame([(*r, "h", 1) for r in rows], "page_id long, url string, html string, host string, text int")
    found = Counter((r.page_id, r.url, r.text, r.n_chars) for r in pages.extract_pages(frame).collect())
    expected = [text, text, "Only text that is here", "", "", "no markup at all, 1 < 2", "deep", text]
    assert found == Counter((r[0], r[1], t, len(t)) for r, t in zip(rows, expected))
    assert pages.extract_pages(frame.limit(0)).count() == 0


def test_the_host_decides_where_a_page_is_unclear(spark):
    usual = "<div class='w7'><div class='story'><p>{}</p></div><div class='x'><a href=/>more and more</a></div></div>"
    odd = "<div class='w9'><div class='story'><p>Short.</p></div><div class='x'><p>A long stray remark that is not the story at all, really not.</p></div></div>"
    rows = [(k, f"http://h.org/{k}", page(usual.format(prose(k, 40)))) for k in range(5)] + [(9, "http://h.org/9", page(odd))]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.page_id: r.text for r in pages.extract_pages(frame).collect()}
    assert found[9] == "Short." and found[2] == prose(2, 40)


# Pipeline


def test_pipeline_equals_its_stages_by_hand(spark, tmp_path):
    texts = [prose(k, 120) for k in range(40)]
    texts += [texts[0], texts[1] + " tail", "Ha " * 90, prose(60, 100) + " " + prose(61, 30), None, ""]
    rows = [(k, t, "en", f"src{k % 4}", len(t or "")) for k, t in enumerate(texts)]
    folder = str(tmp_path)
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(k, 1, 0) for k in range(20)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(0, prose(61, 30))], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    result = corpus_pipeline.run(spark, folder)
    found = result.collect()
    assert result.columns == ["doc_id", "text", "lang", "source", "n_chars", "shard", "slot"]
    failed = {k for k, t in enumerate(texts) if quality.base_failed(len(words(t)), quality.statistics((t or "").encode())[0][4])}
    kept = [k for k in range(len(texts)) if k not in failed | {40, 41, 43}]
    assert {r.doc_id for r in found} <= set(kept)
    sizes = Counter()
    for k in kept:
        sizes[f"src{k % 4}"] += len(words(texts[k]))
    target, taken = plain_targets(sizes), Counter()
    for r in found:
        taken[r.source] += len(words(r.text))
    assert all(abs(taken[s] - target[s]) <= 121 for s in sizes)
    assert max(Counter(r.doc_id for r in found).values()) <= 2
    plain = Counter((d, s, k) for d, _, _, s, k in plain_shards([(r.doc_id, r.text) for r in found]))
    assert Counter((r.doc_id, r.shard, r.slot) for r in found) == plain
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None


def test_stages_take_clashing_columns_and_no_rows(spark, edge_docs, no_docs, tmp_path):
    folder = str(tmp_path)
    spark.createDataFrame([(k, 1) for k in range(5)], "doc_id long, quality int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(0, "nothing that occurs in any of the texts here")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    slim = edge_docs.drop("shard")  # the last stage adds this name
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, slim, folder)
        assert out.columns[: len(slim.columns)] == slim.columns and out.count() > 0
        assert stage(spark, no_docs.drop("shard"), folder).count() == 0
