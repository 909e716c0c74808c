"""Repeated passages: hashes of many words at once, places gathered to stretches, and what is not compared."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

from tessera_spark.llm import common, substring_dedup
from tests.llm.test_crowded_places import chunk, crowd, repeated, still_open


def test_words_are_hashed_together_as_one_by_one():
    texts = [None, b"", b" \n", b"One  two\tTHREE\x0bfour\rfive six", b" ".join(b"x" * k for k in range(1, 70)), "Ä b c\x85 d e f g".encode()]
    hashes = common.WordHashes()
    want = [common.shingles(hashes.of(common.lower_words(t))) for t in texts]
    for together in (1, 1 << 20):
        got = list(common.text_shingles(texts, 5, together))
        assert len(got) == len(want) and all(np.array_equal(x, y) for x, y in zip(got, want, strict=True))


@pytest.mark.parametrize("steps", [0, 64])
def test_nearest_smaller_values(monkeypatch, steps):
    monkeypatch.setattr(substring_dedup, "STEPS", steps)
    draw = np.random.default_rng(3)
    for values in (draw.permutation(50), np.arange(90), np.arange(90)[::-1], np.repeat(draw.permutation(9), 1)):
        values = np.concatenate([[0], values.astype(np.uint64) + np.uint64(1), [0]]).astype(np.uint64)
        before, after = substring_dedup.nearest_smaller(values)
        for k in range(1, len(values) - 1):
            assert before[k] == max(j for j in range(k) if values[j] < values[k])
            assert after[k] == min(j for j in range(k + 1, len(values)) if values[j] < values[k])


def stretches(table: pa.Table, texts) -> list[pa.RecordBatch]:
    """Rows of a chunk as the stretches of its texts."""
    rows: dict[int, list] = {}
    for r in table.to_pylist():
        rows.setdefault(r["key"], []).append({"place": r["place"], "open": r["open"]})
    kind = pa.schema([("sig", pa.int64()), ("key", pa.int64()), ("spots", pa.list_(pa.struct([("place", pa.int32()), ("open", pa.bool_())])))])
    batch = pa.RecordBatch.from_pylist([{"sig": 7, "key": k, "spots": [*v, *v]} for k, v in rows.items()], kind)
    made = pa.Table.from_batches(substring_dedup._gathered([batch]))
    of = {k: s for k, s, _ in texts}
    cut = [np.ascontiguousarray(of[r["key"]][r["lo"] : r["hi"]]).view(np.uint8).reshape(-1, 8)[:, :6].tobytes() for r in made.to_pylist()]
    made = made.append_column("shingles", pa.array(cut, pa.binary())).append_column("chunk", pa.array([0] * len(cut), pa.int32()))
    return made.combine_chunks().to_batches(5)


@pytest.mark.parametrize("texts", [crowd(1, 60, 20), crowd(2, 80, 36), crowd(3, 40, 42), repeated(4, 30), crowd(5, 3, 20)], ids=["phrase", "long phrase", "shared passage", "repeated words", "few"])
def test_stretches_give_what_their_places_give(texts):
    table = chunk(texts)
    want = substring_dedup.compare_chunk(table)
    got = pa.Table.from_batches(substring_dedup.make_compare(False)(iter(stretches(table, texts))))
    assert sorted(map(str, got.to_pylist())) == sorted(map(str, want.to_pylist())) and still_open(got) == still_open(want)


def test_places_of_one_text_are_one_row():
    texts = repeated(4, 30)
    assert sum(map(len, stretches(chunk(texts), texts))) == 30 < chunk(texts).num_rows


def test_texts_that_share_one_repeated_word_are_not_compared(monkeypatch):
    calls, plain = [], substring_dedup.common_passages
    monkeypatch.setattr(substring_dedup, "common_passages", lambda *x: calls.append(1) or plain(*x))
    for texts in (20, 100):
        rows = [(k, np.concatenate([np.full(50, 100 + k), np.full(60, 5), np.full(50, 900 + k)]).astype(np.uint64), [50, 53, 60]) for k in range(texts)]
        found = substring_dedup.compare_chunk(chunk(rows))
        assert len(still_open(found)) == 3 * texts
    assert not calls
