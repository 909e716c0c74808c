"""Token counts by compiled finite-state transducers.

Two deterministic transducers are compiled from the tokenizer's own file:

* the *piece* transducer reads classes of characters and marks where a piece of the splitting
  pattern begins. It has a handful of states. A text is cut into chunks of fixed length; for each
  chunk the map from every entry state to its exit state is computed, all chunks at once; a
  parallel prefix scan composes these maps, which gives each chunk its true entry state.
* the *merge* transducer reads the bytes of a piece. Its transitions carry the number of tokens
  that the reading adds. A state holds what later merges can still depend on: for every place where
  a token may yet begin, its node in the vocabulary trie, the token before it and the tokens between.
  States are made when first reached and kept in a bounded table.

Why the merge transducer is right: a token sequence is what the merges produce exactly if each
neighbouring pair is what the merges make of those two tokens alone, so of all tokens that end at
a byte exactly one fits the only possible token before it.

Defined results: a null text is empty and has no tokens; an id may be null or repeat, each row is
counted on its own; an empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera_spark.llm import common

CHUNK = 256
BLOCK = 1 << 21
TABLE_BOUND = 300_000

# Classes of characters of the piece transducer. The contractions of the splitting pattern are
# fixed values of the tokenizer: 's 't 're 've 'm 'll 'd.
SPACE, LETTER, NUMBER, OTHER, QUOTE, S_T_M_D, R, V, L, E = range(10)
# States: what the piece that holds the last character is.
NONE, WORD, SIGNS, AFTER_QUOTE, Q_R, Q_V, Q_L = range(7)
N_STATES, N_CLASSES = 7, 10
LETTERS = (LETTER, S_T_M_D, R, V, L, E)


def piece_tables() -> tuple[np.ndarray, np.ndarray]:
    """next[state, class] and mark[state, class]: 1 if a piece begins at this character, 2 if it
    ends with this character for certain, 4 if the piece began one character before, 8 two before.

    A quote begins a piece of signs; if the next characters make a contraction, the piece is that
    instead, and a letter after it begins a new piece. A quote inside signs belongs to them.
    """
    step = np.zeros((N_STATES, N_CLASSES), np.int64)
    mark = np.zeros((N_STATES, N_CLASSES), np.int64)
    for state in range(N_STATES):
        for c in range(N_CLASSES):
            if c == SPACE:
                step[state, c] = NONE
            elif c == NUMBER:
                step[state, c], mark[state, c] = NONE, 1
            elif c in LETTERS:
                step[state, c], mark[state, c] = WORD, 0 if state == WORD else 1
            else:
                inside = state in (SIGNS, AFTER_QUOTE)
                step[state, c] = SIGNS if inside or c == OTHER else AFTER_QUOTE
                mark[state, c] = 0 if inside else 1
    # After an opening quote: one-letter contractions end here, two-letter ones may follow.
    step[AFTER_QUOTE, S_T_M_D], mark[AFTER_QUOTE, S_T_M_D] = NONE, 0
    for c, state in ((R, Q_R), (V, Q_V), (L, Q_L)):
        step[AFTER_QUOTE, c], mark[AFTER_QUOTE, c] = state, 1
    # The second letter: 're 've 'll take back the piece that the first letter had begun.
    for state, c in ((Q_R, E), (Q_V, E), (Q_L, L)):
        step[state, c], mark[state, c] = NONE, 4
    for state, done in ((Q_R, E), (Q_V, E), (Q_L, L)):
        for c in LETTERS:
            if c != done:
                step[state, c], mark[state, c] = WORD, 0
    return step, mark


@lru_cache(1)
def character_classes() -> np.ndarray:
    """Class of every code point, by its Unicode category."""
    table = np.full(0x110000, OTHER, np.uint8)
    for code in range(0x110000):
        category = unicodedata.category(chr(code))
        if category[0] == "L":
            table[code] = LETTER
        elif category[0] == "N":
            table[code] = NUMBER
        elif category[0] == "Z":
            table[code] = SPACE
    for code in (*range(0x09, 0x0E), 0x85):
        table[code] = SPACE
    for letter, kind in (("'", QUOTE), ("s", S_T_M_D), ("t", S_T_M_D), ("m", S_T_M_D), ("d", S_T_M_D), ("r", R), ("v", V), ("l", L), ("e", E)):
        table[ord(letter)] = kind
    return table


def entry_states(classes: np.ndarray, step: np.ndarray) -> np.ndarray:
    """State before each character. Chunk maps for all entry states, composed by a prefix scan."""
    n = len(classes)
    chunks = -(-n // CHUNK)
    padded = np.zeros(chunks * CHUNK, np.uint8)
    padded[:n] = classes
    grid = padded.reshape(chunks, CHUNK).T
    flat = step.ravel()
    maps = np.broadcast_to(np.arange(N_STATES), (chunks, N_STATES)).copy()
    for column in grid:
        maps = flat[maps * N_CLASSES + column[:, None]]
    reach = 1  # after each round, maps[i] covers twice as many chunks up to i
    while reach < chunks:
        maps[reach:] = np.take_along_axis(maps[reach:], maps[:-reach], axis=1)
        reach *= 2
    state = np.concatenate([[NONE], maps[:-1, NONE]])
    before = np.empty((CHUNK, chunks), np.uint8)
    for k, column in enumerate(grid):
        before[k] = state
        state = flat[state * N_CLASSES + column]
    return before.T.ravel()[:n]


def piece_bounds(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the pieces of a normalised text, in code points."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    classes = character_classes()[codes]
    step, mark = piece_tables()
    before = entry_states(classes, step)
    marks = mark[before, classes]
    begins = (marks & 1).astype(bool)
    begins[np.flatnonzero(marks & 4) - 1] = False
    starts = np.flatnonzero(begins)
    # A piece ends where the next begins or at white space, and after a digit or contraction.
    spaces = classes == SPACE
    stop = np.flatnonzero(begins | spaces)
    following = np.searchsorted(stop, starts, side="right")
    return starts, np.append(stop, len(codes))[following]


class MergeTransducer:
    """Counts tokens of a piece; see the module's text."""

    def __init__(self, vocabulary: dict[str, int], merges: list, suffix: str, alphabet: list[str]):
        self.rank = {tuple(m) if isinstance(m, list) else tuple(m.split(" ")): k for k, m in enumerate(merges)}
        self.suffix, self.alphabet = suffix, alphabet
        # Only what merges can reach is a token of a split text.
        made = {a + b for a, b in self.rank} | set(alphabet) | {c + suffix for c in alphabet}
        byte_of = {c: b for b, c in enumerate(alphabet)}
        self.inner: list[dict[int, int]] = [{}]
        self.token: list[str | None] = [None]
        self.last: list[str | None] = [None]
        for word in made & vocabulary.keys():
            ending = word.endswith(suffix) and word != suffix
            node = 0
            for c in word[: len(word) - len(suffix)] if ending else word:
                b = byte_of[c]
                if b not in self.inner[node]:
                    self.inner[node][b] = len(self.inner)
                    self.inner.append({})
                    self.token.append(None)
                    self.last.append(None)
                node = self.inner[node][b]
            (self.last if ending else self.token)[node] = word
        self.fits: dict[tuple[str, str], bool] = {}
        self.reset()

    def reset(self) -> None:
        # A state: (places, last token); a place: (trie node, token before it, tokens since).
        self.states: list[tuple] = [(((0, None, 0),), None)]
        self.number: dict[tuple, int] = {self.states[0]: 0}
        self.steps: dict[int, tuple[int, int]] = {}
        self.ends: dict[int, int] = {}

    def symbols(self, token: str) -> list[str]:
        if token.endswith(self.suffix) and token != self.suffix:
            body = token[: -len(self.suffix)]
            return [*body[:-1], body[-1] + self.suffix]
        return list(token)

    def merged(self, symbols: list[str]) -> list[str]:
        """What the merges make of symbols: the lowest rank first, the leftmost of equals."""
        parts = list(symbols)
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda k: self.rank.get((parts[k], parts[k + 1]), 1 << 60))
            if (parts[best], parts[best + 1]) not in self.rank:
                break
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        return parts

    def pair_fits(self, left: str | None, right: str) -> bool:
        if left is None:
            key = ("", right)
            known = self.fits.get(key)
            if known is None:
                known = self.fits[key] = self.merged(self.symbols(right)) == [right]
            return known
        key = (left, right)
        known = self.fits.get(key)
        if known is None:
            if len(self.fits) > TABLE_BOUND:
                self.fits.clear()
            known = self.fits[key] = self.merged(self.symbols(left) + self.symbols(right)) == [left, right]
        return known

    def step(self, state: int, byte: int) -> tuple[int, int]:
        """(next state, tokens added) for a byte that is not the piece's last."""
        places, _ = self.states[state]
        moved = [(self.inner[node][byte], before, since) for node, before, since in places if byte in self.inner[node]]
        for node, before, since in moved:
            token = self.token[node]
            if token is not None and self.pair_fits(before, token):
                break
        else:
            raise ValueError("the vocabulary has no token for a byte")
        added = since + 1
        # What is behind is counted from the new end; a token may begin here.
        after = tuple(sorted(((n, b, s - added) for n, b, s in moved if self.inner[n]), key=repr)) + ((0, token, 0),)
        key = (after, token)
        number = self.number.get(key)
        if number is None:
            number = self.number[key] = len(self.states)
            self.states.append(key)
        return number, added

    def end(self, state: int, byte: int) -> int:
        """Tokens added by the last byte of a piece."""
        for node, before, since in self.states[state][0]:
            after = self.inner[node].get(byte)
            if after is not None and (token := self.last[after]) is not None and self.pair_fits(before, token):
                return since + 1
        raise ValueError("the vocabulary has no last token for a byte")

    def count(self, piece: bytes) -> int:
        if len(self.states) > TABLE_BOUND:
            self.reset()
        state = total = 0
        steps = self.steps
        for byte in piece[:-1]:
            found = steps.get(state << 8 | byte)
            if found is None:
                found = steps[state << 8 | byte] = self.step(state, byte)
            state, added = found
            total += added
        key = state << 8 | piece[-1]
        if key not in self.ends:
            self.ends[key] = self.end(state, piece[-1])
        return total + self.ends[key]


def byte_alphabet() -> list[str]:
    """The character that stands for each byte: printable ones for themselves, the others are
    numbered from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, extra = [], 0
    for b in range(256):
        if b in plain:
            out.append(chr(b))
        else:
            out.append(chr(256 + extra))
            extra += 1
    return out


class CompiledTokenizer:
    """Counts for one tokenizer file of kind "BPE with word ends"."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.merges = MergeTransducer(model["vocab"], model["merges"], model["end_of_word_suffix"], byte_alphabet())
        self.known: dict[str, int] = {}

    def normalised(self, text: str) -> str:
        """NFC, then the lower case of each character by itself (a final sigma is no exception)."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return text.lower()

    def piece_counts(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Start and number of tokens of each piece of a normalised text."""
        starts, ends = piece_bounds(text)
        known, count = self.known, self.merges.count
        out = []
        for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
            piece = text[a:b]
            n = known.get(piece)
            if n is None:
                if len(known) > TABLE_BOUND:
                    known.clear()
                n = count(piece.encode("utf-8", "surrogatepass"))
                if b - a <= 64:
                    known[piece] = n
            out.append(n)
        return starts, np.array(out, np.int64)

    def parts(self, text: str) -> tuple[list[str], int]:
        """A special string inside a text is one token and cuts it, as the library does: the parts
        between, and the number of special tokens."""
        parts, found = [text], 0
        for special in self.special:
            if special in text:
                cut = [p.split(special) for p in parts]
                found += sum(len(c) - 1 for c in cut)
                parts = [p for c in cut for p in c]
        return parts, found

    def counts(self, texts: list[str | None]) -> np.ndarray:
        """Tokens of each text. Texts are read as one, with a line break between any two, until
        they fill a block; a line break takes the piece transducer to its first state."""
        total = np.zeros(len(texts), np.int64)
        lines: list[str] = []
        owners: list[int] = []
        size = 0

        def flush() -> None:
            if lines:
                begin = np.cumsum([0, *(len(x) + 1 for x in lines)])
                starts, n = self.piece_counts("\n".join(lines))
                line = np.searchsorted(begin, starts, side="right") - 1
                np.add.at(total, np.array(owners, np.int64)[line], n)
                lines.clear()
                owners.clear()

        for k, text in enumerate(texts):
            parts, total[k] = self.parts(text or "")
            for part in parts:
                if part:
                    lines.append(self.normalised(part))
                    owners.append(k)
                    size += len(lines[-1])
            if size > BLOCK:
                flush()
                size = 0
        flush()
        return total

    def count(self, text: str | None) -> int:
        return int(self.counts([text])[0])


@lru_cache(2)
def compiled(path: str) -> CompiledTokenizer:
    return CompiledTokenizer(path)


def tokenizer_path(name: str) -> str:
    """Place of a public vocabulary file; the package is installed on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def count_tokens(docs: DataFrame, *, file: str = "word_bpe_49k.json", doc_id: str = "doc_id", text: str = "text", limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (more tokens than ``limit``), one row per input row."""
    common.prepared(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = compiled(tokenizer_path(file))
        for batch in batches:
            n = tokenizer.counts(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), pa.array(n), pa.array(n > limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
        F.col(text).alias("text"),
    )
    return rows.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
