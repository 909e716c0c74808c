"""Conversation repair, fingerprints and hard negatives against plain versions."""

import hashlib
import itertools
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tessera_spark.llm import conversations, fingerprints, hard_negatives
from tests.llm.conftest import full, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TURNS = "conv_id long, turn long, role string, text string, row string, said string, gone boolean, place int"


# ---- conversations


def plain_audit(rows):
    """All edit sequences of a short conversation: rows are (role, text, fault)."""
    best = None

    def walk(k, initials, cost, edits, lines):
        nonlocal best
        if best is not None and cost > best[0]:
            return
        if k == len(rows):
            for more in range(3):
                tail = "".join("ua"[(initials.endswith("u") + j) % 2] for j in range(more))
                whole = initials + tail
                if re.fullmatch("(s?(ua)+)?", whole):
                    texts = lines + [{"u": "user:", "a": "assistant:"}[c] for c in tail]
                    found = (cost + 5 * more, edits + "I" * more, texts)
                    if best is None or found[:2] < best[:2]:
                        best = found
            return
        role, text, fault = rows[k]
        for more in range(3):
            tail = "".join("ua"[(initials.endswith("u") + j) % 2] for j in range(more))
            i, c, e = initials + tail, cost + 5 * more, edits + "I" * more
            ls = lines + [{"u": "user:", "a": "assistant:"}[x] for x in tail]
            walk(k + 1, i, c + 2, e + "D", ls)
            if fault in ("blank", "duplicate"):
                continue
            extra = 5 * (fault == "truncated")
            after = "a" if i.endswith("u") else "u"
            if role[:1] == after or (role[:1] == "s" and not i):
                walk(k + 1, i + role[0], c + extra, e + "K", [*ls, f"{role}:{text}"])
            new = {"u": "user", "a": "assistant"}[after]
            walk(k + 1, i + after, c + extra + 1, e + "R", [*ls, f"{new}:{text}"])

    walk(0, "", 0, "", [])
    return best


def plain_conversation(rows):
    """(turn, role, text) rows with nulls, in any order."""
    rows = sorted(((t, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, judged = set(), []
    for _, role, text in rows:
        found = WORD.findall(text)
        fault = "blank" if not found else "duplicate" if (role, text) in seen else "truncated" if found[-1][-1] not in ".!?" else ""
        seen.add((role, text))
        judged.append((role, text, fault))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    count = Counter(f for _, _, f in judged)
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(judged))
    cost, audit, lines = plain_audit(judged)
    return gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def random_conversations(seed, many):
    rng = random.Random(seed)
    out = {}
    for k in range(many):
        turns = [rng.choice([None, *range(6)]) if rng.random() < 0.2 else j for j in range(rng.randint(1, 6))]
        out[k] = [(t, rng.choice(["user", "assistant", "system", "User", "", None]), rng.choice(["Yes.", "No?", "and", "", " \n", None, "Well!  ", "x. y"])) for t in turns]
    return out


@pytest.fixture(scope="module")
def talks(spark):
    plain = random_conversations(4, 300) | {None: [(0, "user", "a."), (1, "assistant", "b."), (1, "assistant", "b.")]}
    rows = [(c, *r, "r", "s", False, 1) for c, rs in plain.items() for r in rs]
    rows += [(900, 0, "user", "gone.", "r", "s", True, 1), (5, 3, "user", "gone too.", "r", "s", True, 1)]
    return plain, spark.createDataFrame(rows, TURNS).repartition(4)


def test_audits_equal_all_edit_sequences(talks):
    plain, frame = talks
    found = {r.conv_id: tuple(r)[1:] for r in conversations.audit(frame, absent="gone").collect()}
    empty = hashlib.sha256(b"").hexdigest()
    assert found.pop(900) == (0, 0, 0, 0, 0, 0, "", empty)
    assert found == {c: plain_conversation(rows) for c, rows in plain.items()}


def test_repaired_rows_give_the_audit(talks):
    plain, frame = talks
    audits = {r.conv_id: r for r in conversations.audit(frame, absent="gone").collect()}
    edits = {}
    for r in conversations.repair(frame, absent="gone").orderBy("conv_id", "place").collect():
        edits.setdefault(r.conv_id, []).append(r)
    for c in plain:
        rows = edits.get(c, [])
        assert "".join(r.edit for r in rows) == audits[c].audit
        assert [r.place for r in rows] == list(range(len(rows)))
        lines = "\n".join(f"{r.role}:{r.text}" for r in rows if r.edit != "D")
        assert hashlib.sha256(lines.encode()).hexdigest() == audits[c].repaired_sha256


def test_open_edits_stay_few_however_long_the_conversation():
    rng = random.Random(8)
    settled = []
    decoder = conversations.Decoder(lambda *edit: settled.append(edit[0]))
    most = 0
    for k in range(20_000):
        role = ("user", "assistant")[k % 2] if rng.random() > 0.1 else rng.choice(["user", "assistant", "system"])
        decoder.add(role, "text.", k, rng.random() < 0.05, rng.random() < 0.05)
        most = max(most, decoder.open_edits)
    decoder.finish()
    assert most < 200
    assert len(settled) >= 20_000 and decoder.open_edits == 0


def test_damage_follows_the_checksum(spark):
    import zlib

    rows = [(c, t, "assistant", "One. Two!") for c in range(40) for t in (0, 1, None)] + [(None, None, None, None)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    expected = Counter()
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        text, role = text if text is not None else " ", role if role is not None else " "
        shown = ("user" if kind == 4 else role, "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text, kind == 0)
        expected[(c, t, *shown)] += 2 if kind == 3 else 1
    found = Counter(tuple(r) for r in conversations.damaged(frame).drop("copy").collect())
    assert found == expected


def test_no_conversations(spark):
    none = spark.createDataFrame([], TURNS)
    assert conversations.audit(none).count() == 0 and conversations.repair(none).count() == 0


# ---- fingerprints


def plain_sketch(text, bound="4000"):
    words = WORD.findall(text)
    runs = [" ".join(words[k : k + 5]) for k in range(max(len(words) - 4, 1))] if words else []
    return sorted({h for r in runs if (h := hashlib.md5(r.encode()).hexdigest()[:16]) < bound})


def plain_likeness(a, b):
    one, other = set(plain_sketch(a)), set(plain_sketch(b))
    return len(one & other) / len(one | other) if one | other else float(a == b)


def plain_fingerprints(rows):
    """Of rows with different ids: descending, a null id last."""
    rows = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    texts = [t or "" for _, t in rows]
    for k, (doc_id, _) in enumerate(rows):
        text, other = texts[k], texts[(k + 1) % len(rows)]
        cut = len(text) // 3
        edited = text[: len(text) - cut] + other[:cut]
        marks = [hashlib.md5(t.encode()).hexdigest() + ":" + ",".join(plain_sketch(t)) for t in (text, edited)]
        yield doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), *marks, plain_likeness(text, edited), plain_likeness(text, other)


@pytest.fixture
def small_buckets(monkeypatch):
    monkeypatch.setattr(fingerprints, "BUCKET_ROWS", 7)
    monkeypatch.setattr(fingerprints, "RANGES", 5)


def test_fingerprints_equal_plain_ones(spark, edge_rows, small_buckets):
    rng = random.Random(2)
    by_id = {r[0]: r for r in edge_rows}
    ids = [rng.getrandbits(63) - (1 << 62) for _ in range(60)] + [-(1 << 63), (1 << 63) - 1, 100, 101, 102]
    rows = [*by_id.values(), *(full(i, prose(i % 1000, rng.randint(0, 40)) + " é😀 x" * (i % 3)) for i in ids)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, own string, edited string, next string, range int, tie string, part string")
    found = Counter(tuple(r) for r in fingerprints.fingerprint_documents(frame.repartition(5)).collect())
    assert found == Counter(plain_fingerprints([(r[0], r[1]) for r in rows]))


def test_repeated_ids_lie_in_one_circle(spark, small_buckets):
    rows = [(7, prose(k, 30)) for k in range(50)] + [(None, prose(k, 30)) for k in range(50, 80)] + [(8, prose(1, 20))] * 9
    found = fingerprints.neighbours(spark.createDataFrame(rows, "doc_id long, text string")).filter("not copied").collect()
    assert Counter((r.doc_id, r.text) for r in found) == Counter(rows)
    # Everybody is somebody's neighbour exactly once, and the steps close one circle over the ids.
    assert Counter(r.next_text for r in found) == Counter(t for _, t in rows)
    follow = {r.text: r.next_text for r in found if r.doc_id != 8}
    here, seen = rows[0][1], 0
    while here in follow and seen < 200:
        here, seen = follow.pop(here), seen + 1
    assert seen >= 50


def test_one_document_and_none(spark, no_docs):
    one = spark.createDataFrame([(3, "a b c d e f")], "doc_id long, text string")
    row = fingerprints.fingerprint_documents(one).first()
    assert tuple(row) == next(plain_fingerprints([(3, "a b c d e f")]))
    assert fingerprints.fingerprint_documents(no_docs).count() == 0


def test_containment_of_a_part_in_a_long_text_and_merging(spark):
    long_text, part = prose(1, 6000), " ".join(prose(1, 6000).split(" ")[1000:1400])
    frame = spark.createDataFrame([(long_text, part, prose(2, 400), "g")], "a string, b string, c string, g string")
    sketches = frame.select(*[fingerprints.sketch(F.col(c)).alias(c) for c in "abc"], "g")
    row = sketches.select(fingerprints.containment(F.col("b"), F.col("a")), fingerprints.containment(F.col("c"), F.col("a")), fingerprints.merged(F.col("a"), F.col("c"))).first()
    assert row[0] == 1.0 and row[1] < 0.05
    assert row[2] == sorted({*plain_sketch(long_text), *plain_sketch(prose(2, 400))})
    groups = sketches.select("g", F.explode(F.array("a", "c")).alias("sketch"))
    assert sorted(r.hash for r in fingerprints.merged_sketches(groups, "g").collect()) == row[2]


# ---- hard negatives


def plain_negatives(rows, is_anchor):
    sound = [(i, lab, [int((256 * x) // 1) for x in v]) for i, lab, v in rows if lab is not None and v is not None and all(x is not None and abs(x) < float("inf") for x in v)]
    out = []
    for n, (vec_id, label, vector) in enumerate(sound):
        if vec_id is None or not is_anchor(vec_id):
            continue
        scored = sorted(((-sum(a * b for a, b in zip(vector, w)), i is None, i or 0, lab == label, i) for m, (i, lab, w) in enumerate(sound) if m != n), key=lambda s: s[:3])
        for s, _, _, _, positive in [x for x in scored if x[3]][:5]:
            inside = [x for x in scored if not x[3] and 30 * -s <= 100 * -x[0] <= 90 * -s][:10]
            out += [(vec_id, positive, k + 1, x[4], -s, -x[0]) for k, x in enumerate(inside)]
    return Counter(out)


VECTORS = "vec_id long, label int, embedding array<float>, anchor string, score string, copies int, kind string"


def vectors(seed, many, values):
    rng = random.Random(seed)
    return [(k, rng.randrange(3), [rng.choice(values) for _ in range(4)]) for k in range(many)]


@pytest.mark.parametrize("values", [[-1.0, 0.0, 0.25, 0.5, 1.0], [0.5], [-3000.0, 90_000.0, 0.001]])
def test_negatives_equal_a_full_ranking(spark, values):
    rows = vectors(3, 150, values)
    rows += [(10, 1, rows[10][2]), rows[10], rows[20], (None, 1, rows[3][2]), (30, None, [1.0] * 4), (40, 1, None), (50, 1, [1.0, None, 1.0, 1.0])]
    rows += [(60, 1, [float("nan")] * 4), (70, 2, [float("inf"), 1.0, 1.0, 1.0]), (80, 2, []), (90, 1, [1.0, 0.5])]
    frame = spark.createDataFrame([(*r, "a", "s", 3, "k") for r in rows], VECTORS).repartition(6)
    found = hard_negatives.mine(frame, anchor=F.col("vec_id") % 10 == 0, block_rows=6)
    assert Counter(tuple(r) for r in found.collect()) == plain_negatives(rows, lambda i: i % 10 == 0)


def test_no_vectors_or_anchors(spark):
    none = spark.createDataFrame([], VECTORS)
    assert hard_negatives.mine(none, anchor=F.col("vec_id") % 10 == 0).count() == 0
    some = spark.createDataFrame([(1, 1, [1.0]), (2, 1, [1.0])], "vec_id long, label int, embedding array<float>")
    assert hard_negatives.mine(some, anchor=F.col("vec_id") % 10 == 0).count() == 0
