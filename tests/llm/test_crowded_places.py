"""Open places of a crowded signature against comparing all of them with each other."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

from tessera_spark.llm import substring_dedup

RUN = substring_dedup.RUN


def chunk(texts: list[tuple[int, np.ndarray, list[int]]]) -> pa.Table:
    """A chunk of (key, shingles of the text, places)."""
    rows = [(k, p, max(p - RUN, 0), s[max(p - RUN, 0) : p + 2 * RUN]) for k, s, places in texts for p in places]
    cut = [np.ascontiguousarray(s).view(np.uint8).reshape(-1, 8)[:, :6].tobytes() for *_, s in rows]
    return pa.table(
        {
            "sig": pa.array([7] * len(rows), pa.int64()),
            "key": pa.array([r[0] for r in rows], pa.int64()),
            "place": pa.array([r[1] for r in rows], pa.int32()),
            "lo": pa.array([r[2] for r in rows], pa.int32()),
            "open": pa.array([True] * len(rows)),
            "shingles": pa.array(cut, pa.binary()),
        }
    )


def crowd(seed: int, texts: int, phrase: int) -> list[tuple[int, np.ndarray, list[int]]]:
    """Texts around a phrase, every ninth of which shares its surroundings with another one."""
    draw = np.random.default_rng(seed)
    middle = draw.integers(1 << 40, size=phrase, dtype=np.uint64)
    out = []
    for k in range(texts):
        own = draw.integers(1 << 40, size=160, dtype=np.uint64)
        if k % 9 == 1:
            own[50:110] = out[-1][1][50:110]
        own[60 : 60 + phrase] = middle
        out.append((k, own, [62]))
    return out


def repeated(seed: int, texts: int) -> list[tuple[int, np.ndarray, list[int]]]:
    """Texts of stretches of repeated words: one shingle of all texts at place after place."""
    draw = np.random.default_rng(seed)
    out = []
    for k in range(texts):
        length = int(draw.integers(30, 60))
        stretch = np.full(length, 5, np.uint64)
        own = np.concatenate([np.full(60, 100 + k, np.uint64), stretch, np.full(60, 200 + k // 2, np.uint64)])
        out.append((k, own, list(range(60, 60 + length, 3))))
    return out


def still_open(found: pa.Table) -> set[tuple[int, int]]:
    return {(r["key"], r["place"]) for r in found.to_pylist() if r["place"] is not None}


@pytest.mark.parametrize(
    "texts",
    [crowd(1, 60, 20), crowd(2, 60, 36), crowd(3, 40, 42), repeated(4, 30), crowd(5, 3, 20), [(1, np.arange(60, dtype=np.uint64), [3])]],
    ids=["phrase", "long phrase", "shared passage", "repeated words", "few", "alone"],
)
def test_the_same_places_stay_open_as_by_all_pairs(monkeypatch, texts):
    found = still_open(substring_dedup.compare_chunk(chunk(texts)))
    monkeypatch.setattr(substring_dedup, "FEW", 1 << 30)
    assert found == still_open(substring_dedup.compare_chunk(chunk(texts)))


@pytest.mark.parametrize(("phrase", "most"), [(20, 1200), (36, 1200)])
def test_comparisons_grow_with_the_members(monkeypatch, phrase, most):
    calls = []
    plain = substring_dedup.common_passages
    monkeypatch.setattr(substring_dedup, "common_passages", lambda *x: calls.append(1) or plain(*x))
    found = substring_dedup.compare_chunk(chunk(crowd(6, 3000, phrase)))
    assert len(calls) <= most and found.num_rows - found.column("place").null_count <= 3000 - 2 * 333
