"""Repeated passages: tables of finished steps are deleted, and only pairs that may be similar are compared."""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa

from tessera_spark.llm import common, substring_dedup
from tests.llm.conftest import SCHEMA, full, prose


def test_tables_of_finished_steps_are_deleted(spark, monkeypatch):
    seen, plain = [], common.stored

    def stored(df, name):
        table = plain(df, name)
        seen.append((name, table.scratch_path.removeprefix("file:")))
        assert os.path.exists(seen[-1][1])
        return table

    monkeypatch.setattr(common, "stored", stored)
    phrase = prose(1, 48)
    rows = [full(k, f"{prose(100 + k, 40)} {phrase} {prose(200 + k, 40)}") for k in range(20)]
    rows += [full(30 + k, f"{prose(300 + k, 40)} {prose(2, 60)}") for k in range(2)]
    found = substring_dedup.repeated_passages(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.doc_id for r in found} == {30, 31}
    names = {name for name, path in seen if not os.path.exists(path)}
    assert {"windows", "regions", "repeat-cut", "open-members", "open-cut", "open-spots"} <= names


def test_texts_that_differ_too_often_are_not_compared(monkeypatch):
    """Every seventh shingle of a crowd's texts is their own: pairs share 73 of 100."""
    draw = np.random.default_rng(5)
    base = draw.integers(1 << 40, size=138, dtype=np.uint64)
    parts = []
    for k in range(30):
        own = base.copy()
        at = np.setdiff1d(np.arange(k % 7, 138, 7), [substring_dedup.RUN])
        own[at] = draw.integers(1 << 40, size=len(at), dtype=np.uint64)
        parts.append(own.view(np.uint8).reshape(-1, 8)[:, :6].tobytes())
    table = pa.table(
        {
            "sig": pa.array([7] * 30, pa.int64()),
            "key": pa.array(range(30), pa.int64()),
            "place": pa.array([substring_dedup.RUN] * 30, pa.int32()),
            "lo": pa.array([0] * 30, pa.int32()),
            "open": pa.array([True] * 30),
            "shingles": pa.array(parts, pa.binary()),
        }
    )
    calls, plain = [], substring_dedup.common_passages
    monkeypatch.setattr(substring_dedup, "common_passages", lambda *x: calls.append(1) or plain(*x))
    found = substring_dedup.compare_chunk(table)
    similar = found.column("place").null_count
    assert len(calls) <= similar + 30
