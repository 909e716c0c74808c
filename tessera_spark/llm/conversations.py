"""Repair of conversations by a Viterbi search with coalescing survivors.

The rows of a conversation, in order of their turn, are kept, given another role, deleted, or joined
by inserted ones, so that the initials of the roles read ``(s?(ua)+)?`` at the least cost. Four
states tell what the repaired rows so far end with: nothing, a system row, a user row, an assistant
row. Each state has one survivor, the cheapest edits that lead to it.

Survivors are leaves of a tree of back pointers whose nodes count their references. A survivor that
loses releases its branch; one that can never win any more is dropped, because another reaches all it
can reach at less cost. As soon as all survivors share an ancestor, the edits up to it are settled:
they are emitted and their rows let go. So a conversation is read as a stream, and what stays in memory
is what is still open, however many rows it has. Among equal costs the least text of edits wins. No
survivor's edits begin with another's, since all end with the edit of the same row; so the order of
their whole unresolved suffixes is kept as a rank, and a comparison of whole suffixes is one of
(rank, edits since).

Rows are shuffled once by conversation and sorted. A row whose role and text occurred before is found
beforehand by an aggregation, combined before its shuffle, so no conversation's rows are remembered.

Defined results: a null role or text is one space; null turns come first; rows of one turn are
ordered by role and text; the rows of a null conversation are one conversation; rows that repeat
everything are duplicates; a very long text is held while its row is open; an empty table gives an empty
result. Only the named columns are read, whatever else there is.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera_spark.llm import common

NOTHING, SYSTEM, USER, ASSISTANT = range(4)
FINAL = (NOTHING, ASSISTANT)
#: Role written by an inserted or re-roled row, and the state after it, by the state before it.
WRITES = {NOTHING: ("user", USER), SYSTEM: ("user", USER), USER: ("assistant", ASSISTANT), ASSISTANT: ("user", USER)}
#: State after a kept row, by the state before it and the initial of its role.
KEEPS = {(NOTHING, "s"): SYSTEM, (NOTHING, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: ``NEARBY[a][b]``: what comes after state b is to be had after state a for at most this much more:
#: by inserting rows, or by deleting a system row that only fits at the start.
NEARBY = (
    (0, 0, INSERT, 0),
    (2 * INSERT, 0, INSERT, 2 * INSERT),
    (INSERT + DELETE, INSERT, 0, INSERT),
    (DELETE, 0, INSERT, 0),
)
LEGAL = {"su", "ua", "au"}
NOT_BLANK = re.compile(r"[^\x20\x09-\x0D]")
_BLANKS = " \t\n\v\f\r"

REPAIRED = "conv_id long, place long, edit string, role string, text string, turn long"
AUDITED = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


class Node:
    """One edit; ``references`` counts the edits after it and the survivor that ends in it."""

    __slots__ = ("parent", "edit", "row", "references", "children")

    def __init__(self, parent: Node | None, edit: str, row: tuple | None):
        self.parent, self.edit, self.row = parent, edit, row
        self.references, self.children = 0, []
        if parent is not None:
            parent.references += 1
            parent.children.append(self)


class Decoder:
    """The search over one conversation. ``emit(edit, role, text, turn)`` gets settled edits in order.

    ``open_edits`` is the number of nodes of the tree, the only thing that grows.
    """

    def __init__(self, emit: Callable[[str, str | None, str | None, int | None], None]):
        self._emit = emit
        self._root = Node(None, "", None)
        self._root.references = 1
        self._survivors = {NOTHING: (0, 0, self._root)}  # state: (cost, rank, last edit)
        self.open_edits = 0

    def add(self, role: str, text: str, turn: int | None, must_go: bool, truncated: bool) -> None:
        row, initial = (role, text, turn), role[:1]
        best: dict[int, tuple] = {}
        for state, (cost, key, path) in self._after_inserts().items():
            _better(best, state, cost + DELETE, key, path, "D", row)
            if must_go:
                continue
            cost += TRUNCATED * truncated
            if (state, initial) in KEEPS:
                _better(best, KEEPS[state, initial], cost, key, path, "K", row)
            new_role, after = WRITES[state]
            _better(best, after, cost + REROLE, key, path, "R", (new_role, text, turn))
        least = {s: min(best[t][0] + NEARBY[t][s] for t in best) for s in best}
        self._grow({s: b for s, b in best.items() if b[0] <= least[s]})
        self._settle()

    def finish(self) -> int:
        """Settle the rest and return the cost."""
        ends = {s: b for s, b in self._after_inserts().items() if s in FINAL}
        best = min(ends.values(), key=lambda b: (b[0], b[1]))
        self._grow({NOTHING: best})
        self._settle()
        return best[0]

    def _after_inserts(self) -> dict[int, tuple]:
        """Survivors with any rows inserted before the next one: (cost, (rank, edits), path)."""
        best = {s: (cost, (rank, ""), (node, ())) for s, (cost, rank, node) in self._survivors.items()}
        waiting = list(best)
        while waiting:
            state = waiting.pop()
            role, after = WRITES[state]
            cost, key, path = best[state]
            if _better(best, after, cost + INSERT, key, path, "I", (role, "", None)):
                waiting.append(after)
        return best

    def _grow(self, winners: dict[int, tuple]) -> None:
        """Hang the winners' edits into the tree and let go of survivors that lost."""
        lost = [node for _, _, node in self._survivors.values()]
        survivors = {}
        for rank, (state, (cost, _, (node, edits))) in enumerate(sorted(winners.items(), key=lambda w: w[1][1])):
            for edit, row in edits:
                # Winners may share inserted rows; a node has one child per edit.
                node = next((c for c in node.children if c.edit == edit), None) or self._hang(node, edit, row)
            node.references += 1
            survivors[state] = (cost, rank, node)
        self._survivors = survivors
        for node in lost:
            self._release(node)

    def _hang(self, parent: Node, edit: str, row: tuple) -> Node:
        self.open_edits += 1
        return Node(parent, edit, row)

    def _release(self, node: Node) -> None:
        node.references -= 1
        while node.references == 0 and node.parent is not None:
            parent = node.parent
            parent.children.remove(node)
            parent.references -= 1
            self.open_edits -= 1
            node = parent

    def _settle(self) -> None:
        """Emit what all survivors share: while the root has one reference and that is an edit."""
        while self._root.references == 1 and self._root.children:
            node = self._root.children.pop()
            node.parent = None
            self.open_edits -= 1
            self._root = node
            if node.edit == "D":
                self._emit("D", None, None, node.row[2])
            else:
                self._emit(node.edit, *node.row)


def _better(best: dict[int, tuple], state: int, cost: int, key: tuple, path: tuple, edit: str, row: tuple) -> bool:
    key = (key[0], key[1] + edit)
    if state in best and best[state][:2] <= (cost, key):
        return False
    best[state] = (cost, key, (path[0], (*path[1], (edit, row))))
    return True


class Conversation:
    """Faults, gaps and edits of one conversation, row by row."""

    def __init__(self, emit: Callable):
        self.blank = self.duplicate = self.truncated = self.illegal = self.distinct = 0
        self.low = self.high = None
        self._before = self._initial = None
        self.emit, self._decoder = emit, Decoder(emit)

    def add(self, role: str, text: str, turn: int | None, repeated: bool) -> None:
        repeated = repeated or self._before == (turn, role, text)
        if turn is not None:
            self.distinct += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn
        if self._before is not None:
            self.illegal += self._initial + role[:1] not in LEGAL
        self._before, self._initial = (turn, role, text), role[:1]
        blank = not NOT_BLANK.search(text)
        duplicate = not blank and repeated
        truncated = not blank and not duplicate and text.rstrip(_BLANKS)[-1] not in ".!?"
        self.blank, self.duplicate, self.truncated = self.blank + blank, self.duplicate + duplicate, self.truncated + truncated
        self._decoder.add(role, text, turn, blank or duplicate, truncated)

    def finish(self) -> tuple[int, ...]:
        """gaps, blank, duplicate, truncated, illegal, cost."""
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.distinct
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, self._decoder.finish()


class Digest:
    """Initials of the edits, and the SHA-256 of the repaired ``role:text`` lines as they come."""

    def __init__(self):
        self._edits, self._hash, self._between = bytearray(), hashlib.sha256(), ""

    def __call__(self, edit: str, role: str | None, text: str | None, turn: int | None) -> None:
        self._edits.extend(edit.encode())
        if edit != "D":
            self._hash.update(f"{self._between}{role}:{text}".encode())
            self._between = "\n"

    def ended(self) -> tuple[str, str]:
        return self._edits.decode(), self._hash.hexdigest()


def _conversations(batches: Iterator[pa.RecordBatch], start: Callable, end: Callable, pause: Callable):
    """Feeds sorted rows to one Conversation after the other; ``pause`` is asked after each batch."""
    current: list | None = None
    for batch in batches:
        for conv_id, turn, role, text, gone, repeated in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if current is None or current[0] != conv_id:
                if current is not None:
                    end(*current)
                current = [conv_id, start(conv_id)]
            if not gone:
                current[1].add(role, text, turn, repeated)
        yield from pause()
    if current is not None:
        end(*current)
    yield from pause()


def _record(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string()}
    fields = [f.split(" ") for f in schema.split(", ")]
    columns = zip(*rows, strict=True) if rows else [()] * len(fields)
    return pa.record_batch([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)], [n for n, _ in fields])


def _flush(rows: list[tuple], schema: str) -> Callable[[], Iterator[pa.RecordBatch]]:
    def pause() -> Iterator[pa.RecordBatch]:
        if rows:
            yield _record(rows, schema)
            rows.clear()

    return pause


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows: list[tuple] = []

    def start(conv_id):
        place = iter(range(1 << 62))
        return Conversation(lambda edit, role, text, turn: rows.append((conv_id, next(place), edit, role, text, turn)))

    yield from _conversations(batches, start, lambda _, c: c.finish(), _flush(rows, REPAIRED))


def _audited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows: list[tuple] = []

    def end(conv_id, conversation):
        costs = conversation.finish()
        rows.append((conv_id, *costs, *conversation.emit.ended()))

    yield from _conversations(batches, lambda _: Conversation(Digest()), end, _flush(rows, AUDITED))


def _sorted_rows(rows: DataFrame, conv_id: str, turn: str, role: str, text: str, absent: str | None) -> DataFrame:
    """conv_id, turn, role, text, gone, repeated: dealt by conversation and in order."""
    gone = F.lit(False) if absent is None else F.coalesce(F.col(absent), F.lit(False))
    held = rows.select(
        F.col(conv_id).cast("long").alias("conv_id"),
        F.col(turn).cast("long").alias("turn"),
        F.when(gone, "").otherwise(F.coalesce(F.col(role), F.lit(" "))).alias("role"),
        F.when(gone, "").otherwise(F.coalesce(F.col(text), F.lit(" "))).alias("text"),
        gone.alias("gone"),
    )
    said = F.md5(F.concat_ws(":", F.char_length("role").cast("string"), "role", "text").cast("binary"))
    when = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    narrow = held.filter(~F.col("gone")).select("conv_id", said.alias("said"), when.alias("at"))
    seen = narrow.groupBy("conv_id", "said").agg(F.min("at").alias("first"), F.count("*").alias("times")).filter("times > 1")
    seen = common.stored(seen.select(F.col("conv_id").alias("conv"), F.col("said").alias("key"), "first"), "conversations-seen")
    marked = held.withColumn("said", said).join(
        common.small_or_plain(seen), F.col("conv_id").eqNullSafe(F.col("conv")) & (F.col("said") == F.col("key")), "left"
    )
    repeated = F.coalesce(when > F.col("first"), F.lit(False)).alias("repeated")
    dealt = marked.select("conv_id", "turn", "role", "text", "gone", repeated).repartition("conv_id")
    return dealt.sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")


def repair(
    rows: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", absent: str | None = None
) -> DataFrame:
    """conv_id, place, edit (K, R, D or I), role, text, turn: the edits of every conversation in order;
    deleted rows have no role and text, inserted ones no turn. Rows with ``absent`` are not there."""
    common.prepared(rows.sparkSession)
    return _sorted_rows(rows, conv_id, turn, role, text, absent).mapInArrow(_repaired, REPAIRED)


def audit(
    rows: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", absent: str | None = None
) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256: one row per
    conversation, also for one of which every row is ``absent``. The same search as ``repair``."""
    common.prepared(rows.sparkSession)
    return _sorted_rows(rows, conv_id, turn, role, text, absent).mapInArrow(_audited, AUDITED)


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with known damage by the CRC-32 of ``conv_id:turn``; ``gone`` marks lost rows."""
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = F.crc32(name.cast("binary")) % 20
    text = F.coalesce(F.col("text"), F.lit(" "))
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    copies = F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    role = F.when(kind == 4, "user").otherwise(F.coalesce(F.col("role"), F.lit(" ")))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (kind == 0).alias("gone"), copies.alias("copy"))
