"""Token counts by a tokenizer compiled to a finite-state transducer.

A sentencepiece BPE vocabulary becomes a deterministic transducer over characters. The encoding of a text
is the one sequence of tokens in which every neighbouring pair is *compatible*: merging the text of the
pair by the model's scores gives that pair again. So the last token after each character is the
vocabulary's token that ends there and is compatible with the last token before it. All that can still
matter of the text read so far is, for every start from which a longer token could still be read, the
place in the vocabulary's trie, the last token before that start, and the tokens counted since. These
triples are the state. A transition carries how the token count changes by reading its character.

States and transitions are compiled when a text first needs them. A batch of texts is laid end to end and
cut into chunks of equal length. All chunks are read in step, each from the start state; then the maps of
the chunks are composed: a chunk whose true entry state (the exit of the chunk before it) differs is read
again from there, only until both runs meet, after which its map is the same for both entries. Rounds of
this go on until no exit changes.

Results for special inputs: null or empty texts have no tokens; characters outside the vocabulary count
one token per UTF-8 byte (byte fallback); texts of any length are read whole; an empty table gives an
empty result; repeated rows give repeated rows; columns other than the id and the text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.common import batched, byte_texts

#: Characters per chunk, and bytes of text that one pass reads.
CHUNK = 512
PASS_BYTES = 2 << 20
#: Cells of the transition table beyond which a worker starts a new one; memory only. Offsets have 24 bits.
MOST_CELLS = 15_500_000
#: Token pairs whose compatibility a worker remembers; memory only.
MOST_PAIRS = 500_000
_SPACE = "▁"
_END = 0  # class of the mark between texts


class Vocabulary:
    """Trie, scores and pair compatibility of a sentencepiece BPE model."""

    def __init__(self, path: str) -> None:
        self.model = model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.scores: dict[str, float] = {}
        fallback = 0
        for i in range(model.get_piece_size()):
            if model.is_byte(i):
                fallback += 1
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.scores[model.id_to_piece(i)] = model.get_score(i)
        if fallback != 256:
            raise ValueError("the model has no byte fallback")
        self.characters = {c for piece in self.scores for c in piece}
        if not all(c in self.scores for c in self.characters):
            raise ValueError("a character of the vocabulary is no piece")
        self.pieces = list(self.scores)
        self.neighbours = {piece[i : i + 2] for piece in self.pieces for i in range(len(piece) - 1)}
        self.children: list[dict[str, int]] = [{}]
        self.token: list[int] = [-1]
        self.first: list[str] = [""]
        for number, piece in enumerate(self.pieces):
            node = 0
            for c in piece:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.token.append(-1)
                    self.first.append(piece[0])
                node = self.children[node][c]
            self.token[node] = number
        self.pairs: dict[tuple[int, int], bool] = {}

    def merge(self, text: str) -> list[str]:
        """The model's encoding of a short text, kept apart from the word mark that every text begins with."""
        return self.model.encode("\0" + text, out_type=str)[2:]

    def compatible(self, left: int, right: int) -> bool:
        """Whether the two tokens stay as they are side by side; left -1: nothing can merge across."""
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) > MOST_PAIRS:
                self.pairs.clear()
            a, b = self.pieces[left] if left >= 0 else "", self.pieces[right]
            known = self.pairs[left, right] = self.merge(a + b) == ([a, b] if a else [b])
        return known


class Transducer:
    """The transitions compiled so far, as one table over (state, character class).

    A cell holds the offset of the next state's row in its upper 24 bits, and the change of the count,
    shifted by 128, in the lower 8.
    """

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.reset()

    def reset(self, kind: type = np.uint32) -> None:
        """Forget all states. Cells of 64 bits are for a single text that needs more states than 32 allow."""
        self.kind, self.missing = kind, int(np.iinfo(kind).max)
        self.states: dict[tuple, int] = {}
        self.keys: list[tuple] = []
        self.classes = np.full(0x110000, -1, dtype=np.int32)
        self.class_chars: list[str] = [""]
        self.width = 32
        self.cells = np.full(1024 * self.width, self.missing, dtype=kind)
        self._state(((0, -1, 0),))  # row 0: the start

    def _state(self, key: tuple) -> int:
        number = self.states.get(key)
        if number is None:
            number = self.states[key] = len(self.keys)
            self.keys.append(key)
            if (number + 1) * self.width > len(self.cells):
                grown = np.full(len(self.cells) * 3 // 2, self.missing, dtype=self.kind)
                grown[: len(self.cells)] = self.cells
                self.cells = grown
        return number

    def prepare(self, codes: np.ndarray) -> None:
        """Give every character that occurs a class; start anew when the table is too large."""
        if len(self.keys) * self.width > MOST_CELLS:
            self.reset()
        new = np.unique(codes[self.classes[codes] < 0]).tolist()
        for code in new:
            self.classes[code] = len(self.class_chars)
            self.class_chars.append(chr(code))
        if len(self.class_chars) > self.width:
            # Offsets depend on the width; transitions are compiled again when needed.
            characters = self.class_chars
            self.reset(self.kind)
            for number, c in enumerate(characters[1:], 1):
                self.classes[ord(c)] = number
            self.class_chars = characters
            self.width = 8 * -(-len(characters) // 8)
            self.cells = np.full(1024 * self.width, self.missing, dtype=self.kind)

    def compile(self, state: int, kind: int) -> None:
        """Add the transition of a state on a character class."""
        v = self.vocabulary
        following, change = 0, 0
        if kind != _END:
            c = self.class_chars[kind]
            if c in v.characters:
                following, change = self._read(state, c)
            else:  # byte fallback; nothing merges with it
                change = len(c.encode("utf-8", "replace"))
        cell = (following * self.width) << 8 | (change + 128)
        if cell >= self.missing:
            raise OverflowError("too many states")
        self.cells[state * self.width + kind] = cell

    def _read(self, state: int, c: str) -> tuple[int, int]:
        v = self.vocabulary
        token = change = None
        moved = []
        for node, last, since in self.keys[state]:
            child = v.children[node].get(c)
            if child is None:
                continue
            moved.append((child, last, since))
            found = v.token[child]
            if token is None and found >= 0 and v.compatible(last, found):
                token, change = found, 1 - since
        triples = []
        for child, last, since in moved:
            if v.children[child]:
                apart = last >= 0 and v.pieces[last][-1] + v.first[child] not in v.neighbours
                triples.append((child, -1 if apart else last, since + change))
        triples.append((0, token, 0))
        return self._state(tuple(triples)), change

    def step(self, rows: np.ndarray, kinds: np.ndarray) -> np.ndarray:
        """The cells that chunks in the given states (as row offsets) meet on their next characters."""
        at = rows + kinds
        found = self.cells.take(at)
        if found.max() == self.missing:
            for cell in np.unique(at[found == self.missing]).tolist():
                self.compile(cell // self.width, cell % self.width)
            found = self.cells.take(at)
        return found

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of each text."""
        try:
            return self._count(texts)
        except OverflowError:  # more states than a 32-bit cell can name
            if len(texts) > 1:
                self.reset()
                half = len(texts) // 2
                return self.count(texts[:half]) + self.count(texts[half:])
            self.reset(np.uint64)
            counts = self._count(texts)
            self.reset()
            return counts

    def _count(self, texts: list[str]) -> list[int]:
        marked = "".join(["\0" + _SPACE + t if t else "\0" for t in texts])
        codes = np.frombuffer(marked.encode("utf-32-le", "replace"), dtype="<u4")
        lengths = np.array([len(t) + 2 if t else 1 for t in texts])
        starts = np.cumsum(lengths) - lengths
        codes = np.where(codes == 0x20, ord(_SPACE), codes)
        self.prepare(codes)
        kinds = self.classes[codes]
        kinds[starts] = _END
        lanes = -(-len(kinds) // CHUNK)
        padded = np.full(lanes * CHUNK, _END, dtype=np.int64)
        padded[: len(kinds)] = kinds
        cells = self._run(np.ascontiguousarray(padded.reshape(lanes, CHUNK).T))
        changes = (cells & self.kind(255)).astype(np.int16).T.reshape(-1)[: len(kinds)] - 128
        return np.add.reduceat(changes, starts, dtype=np.int64).tolist()

    def _run(self, columns: np.ndarray) -> np.ndarray:
        """The cell met at every character, for chunks that follow each other."""
        steps, lanes = columns.shape
        cells = np.empty((steps, lanes), dtype=self.kind)
        entry = np.zeros(lanes, dtype=np.int64)
        rows = entry
        for j in range(steps):
            cells[j] = found = self.step(rows, columns[j])
            rows = (found >> self.kind(8)).astype(np.int64)
        while True:
            wanted = np.concatenate([[0], (cells[-1, :-1] >> self.kind(8)).astype(np.int64)])
            open_lanes = np.flatnonzero(wanted != entry)
            if not len(open_lanes):
                return cells
            entry = wanted
            rows = wanted[open_lanes]
            for j in range(steps):
                found = self.step(rows, columns[j, open_lanes])
                apart = found >> self.kind(8) != cells[j, open_lanes] >> self.kind(8)
                cells[j, open_lanes] = found
                open_lanes, rows = open_lanes[apart], (found[apart] >> self.kind(8)).astype(np.int64)
                if not len(open_lanes):
                    break


_LOADED: dict[str, Transducer] = {}


def load(path: str) -> Transducer:
    """One transducer per worker process."""
    if path not in _LOADED:
        _LOADED[path] = Transducer(Vocabulary(path))
    return _LOADED[path]


def count_tokens(docs: DataFrame, path: str, limit: int, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id, n_bytes, n_tokens and over_limit of every text."""
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        transducer = load(path)
        for batch in batched(batches, PASS_BYTES):
            raw = byte_texts(batch.column(1))
            counts = transducer.count([x.decode("utf-8", "replace") for x in raw])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(x) for x in raw], pa.int64()), pa.array(counts, pa.int64())],
                ["id", "n_bytes", "n_tokens"],
            )

    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    out = rows.mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long")
    return out.withColumnRenamed("id", id_column).withColumn("over_limit", F.col("n_tokens") > limit)
