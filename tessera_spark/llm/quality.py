"""Quality rules: boosted trees over document statistics.

Statistics come from the whole text. A model is fitted on at most ``TRAINING_ROWS`` labelled
documents, chosen by hash (the bound is a parameter); every document is then scored by the
flattened trees where it lies, so no row moves.

Defined results: a null text has no words; a document without words or with a failed base rule is
not kept; a null label is no label; an id with several labels is used with each of them; without
labels, or with labels of one class only, the base rules alone decide. Repeated rows are judged
alike, each on its own. An empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera_spark.llm import common, trees

TRAINING_ROWS = 20_000
SYMBOLS = b"#*$%&|<>"
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
UPPER = bytes(range(65, 91))
DIGITS = bytes(range(48, 58))

#: Features in order, and how the score may move as each grows.
FEATURES = {
    "log_words": 0,
    "word_chars": 0,
    "symbols_a_word": -1,
    "dup_line_share": -1,
    "repeat_share": -1,
    "same_next_share": -1,
    "distinct_share": 0,
    "upper_share": 0,
    "digit_share": 0,
    "exclaim_a_word": -1,
}
COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def repeated_positions(words: list[bytes]) -> int:
    """Words that lie in a 3-word window found twice or more."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    times = Counter(windows)
    hit = np.zeros(len(words), bool)
    at = np.flatnonzero(np.fromiter((times[w] > 1 for w in windows), bool, len(windows)))
    for k in range(3):
        hit[at + k] = True
    return int(hit.sum())


def statistics(text: bytes | None) -> tuple[tuple[int, ...], list[float]]:
    """The five counts of the contract, and the features."""
    text = text or b""
    words = text.split()
    n = len(words)
    solid = text.translate(None, SPACES)
    continuing = len(solid) - len(solid.translate(None, bytes(range(0x80, 0xC0))))
    chars = len(solid) - continuing
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    seen: set[bytes] = set()
    lines = repeats = 0
    for line in text.split(b"\n"):
        if line.strip():
            lines += 1
            if line in seen:
                repeats += 1
            else:
                seen.add(line)
    repeated = repeated_positions(words)
    same = sum(map(bytes.__eq__, words, words[1:]))
    m, c = max(n, 1), max(len(solid), 1)
    features = [
        float(np.log1p(n)),
        chars / m,
        symbols / m,
        repeats / max(lines, 1),
        repeated / m,
        same / m,
        len(set(words)) / m,
        (len(solid) - len(solid.translate(None, UPPER))) / c,
        (len(solid) - len(solid.translate(None, DIGITS))) / c,
        text.count(b"!") / m,
    ]
    return (n, chars, symbols, repeats, repeated), features


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < 50 or 100 * n_repeat_words > 50 * n_words


def fit_quality(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "quality", rows: int = TRAINING_ROWS) -> trees.NodeArrays:
    """Trees fitted on at most ``rows`` labelled documents, those of the lowest id hash."""
    chosen = (
        labels.select(F.col(doc_id).alias("label_id"), F.col(label).cast("double").alias("y"))
        .filter(F.col("label_id").isNotNull() & F.col("y").isNotNull())
        .orderBy(F.xxhash64("label_id"), "label_id", "y")
        .limit(rows)
    )
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    joined = texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id")).select("doc_id", "y", "text")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            each = [statistics(t)[1] for t in common.byte_column(batch, "text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), batch.column("y"), pa.array(each, pa.list_(pa.float64()))],
                ["doc_id", "y", "x"],
            )

    # Repeated rows of an id cannot exceed the bound either: the lowest hashes are taken again.
    found = joined.mapInArrow(features, "doc_id long, y double, x array<double>")
    taken = found.orderBy(F.xxhash64("doc_id"), "doc_id", "y", "x").limit(rows).toArrow()
    x = np.array(taken.column("x").to_pylist(), dtype=float).reshape(-1, len(FEATURES))
    y = (taken.column("y").to_numpy() > 0.5).astype(float)
    return trees.fit(x, y, list(FEATURES.values()))


def judge(docs: DataFrame, model: trees.NodeArrays, *, doc_id: str = "doc_id", text: str = "text", least: float = 0.5, carry: bool = False) -> DataFrame:
    """doc_id, the five counts, base_failed, quality (probability) and kept, one row per input
    row; with ``carry`` all input columns besides, below the struct ``row``."""
    common.prepared(docs.sparkSession)
    network = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), *([F.struct("*").alias("row")] if carry else []))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trained = network.value
        for batch in batches:
            both = [statistics(t) for t in common.byte_column(batch, "text")]
            counts = np.array([c for c, _ in both], np.int64).reshape(-1, 5)
            x = np.array([f for _, f in both], float).reshape(-1, len(FEATURES))
            quality = trained.probability(x)
            failed = (counts[:, 0] < 50) | (100 * counts[:, 4] > 50 * counts[:, 0])
            kept = ~failed & (quality >= least)
            out = [batch.column("doc_id"), *(pa.array(counts[:, k]) for k in range(5)), pa.array(failed), pa.array(quality), pa.array(kept)]
            names = ["doc_id", *(c.split()[0] for c in COUNTS.split(", ")), "base_failed", "quality", "kept"]
            if carry:
                out.append(batch.column("row"))
                names.append("row")
            yield pa.RecordBatch.from_arrays(out, names)

    schema = StructType.fromDDL(f"doc_id long, {COUNTS}, base_failed boolean, quality double, kept boolean")
    if carry:
        schema.add("row", docs.schema)
    return rows.mapInArrow(score, schema)


def quality_rules(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", carry: bool = False) -> DataFrame:
    common.prepared(docs.sparkSession)
    return judge(docs, fit_quality(docs, labels, doc_id=doc_id, text=text), doc_id=doc_id, text=text, carry=carry)
