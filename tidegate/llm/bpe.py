"""Byte-level BPE encoding and decoding through a sentencepiece model written from the rank file.

The ranks become a sentencepiece BPE model without training: one piece per token, its bytes mapped to
characters one to one, scored by its negative rank, under identity normalisation. sentencepiece merges
the pair of highest score first, leftmost on ties, which is the order of the ranks. The text is cut into
pre-tokens by the tokenizer's pattern, each pre-token is encoded by itself, and ids are decoded by the
inverse of the byte mapping.

Results for special inputs: null or empty texts have no tokens; texts of any length are encoded whole;
repeated rows give repeated rows; an empty table gives an empty result; columns other than the id and the
text are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import re
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.common import batched, byte_texts

#: Bytes of pre-tokens and their ids that a worker remembers, about, and the longest ones that it does; memory only,
#: results do not depend on it.
REMEMBERED, REMEMBERED_LENGTH = 100 << 20, 200
#: Bytes that a remembered pre-token takes besides its own.
_ENTRY = 200
PASS_BYTES = 4 << 20
#: Pre-tokens, and characters of them, per call of sentencepiece; a longer pre-token is a call by itself.
PER_CALL, CALL_LENGTH = 500, 50_000
#: Longer texts are cut into pre-tokens by parts, of so many at once.
LONG_TEXT, PART = 4 << 20, 200_000
#: Below this code point the two regular expression engines can be made to agree.
_PLAIN_END = 0x250
_APART = "\x00"
# Bytes that stand for themselves in a piece; every other byte b is the character 256 + b.
_PLAIN = range(0x21, 0x7F)
_TO_CHAR = {b: (b if b in _PLAIN else 256 + b) for b in range(256)}
_TO_BYTE = {c: b for b, c in _TO_CHAR.items()}


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file (base64 token and rank per line), in order of rank."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    tokens = [b""] * len(pairs)
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


def _varint(number: int) -> bytes:
    out = bytearray()
    while number > 0x7F:
        out.append(number & 0x7F | 0x80)
        number >>= 7
    out.append(number)
    return bytes(out)


def _field(number: int, value: bytes | int) -> bytes:
    """A protobuf field: bytes are length-delimited, integers are varints."""
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def serialise_model(tokens: list[bytes]) -> bytes:
    """The sentencepiece model file of a byte-level BPE vocabulary; piece ids are the ranks."""
    normal, unknown, bpe = 1, 2, 2
    out = bytearray()
    for rank, token in enumerate(tokens):
        piece = token.decode("latin-1").translate(_TO_CHAR).encode()
        score = b"\x15" + np.float32(-rank).tobytes()  # field 2, 32 bits
        out += _field(1, _field(1, piece) + score + _field(3, normal))
    out += _field(1, _field(1, b"<unk>") + b"\x15" + np.float32(0).tobytes() + _field(3, unknown))
    out += _field(2, _field(3, bpe))
    # Identity normalisation: no prefix, white space neither removed nor escaped.
    out += _field(3, _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0))
    return bytes(out)


def _ranges(member: Callable[[str], bool]) -> str:
    """The characters below _PLAIN_END that belong to a class, as ranges of a regular expression."""
    codes = [i for i in range(_PLAIN_END) if member(chr(i))]
    runs = [list(run) for _, run in itertools.groupby(codes, key=lambda i, n=itertools.count(): i - next(n))]
    return "".join(f"\\u{run[0]:04x}-\\u{run[-1]:04x}" for run in runs)


def plain_pattern(pattern: str) -> str:
    """The pattern with \\p{L}, \\p{N}, \\s and \\S spelled out, right for texts of Latin characters only.

    Python's own engine, which is several times faster, has no such classes.
    """
    classes = {
        r"\p{L}": _ranges(lambda c: unicodedata.category(c)[0] == "L"),
        r"\p{N}": _ranges(lambda c: unicodedata.category(c)[0] == "N"),
        r"\s": _ranges(lambda c: regex.match(r"\s", c) is not None),
    }
    out = []
    for part in re.findall(r"\[\^?(?:\\.|[^\]])*\]|\\p\{\w+\}|\\.|.", pattern, re.S):
        if part[0] == "[":
            for name, ranges in classes.items():
                part = part.replace(name, ranges)
        elif part in classes:
            part = f"[{classes[part]}]"
        elif part == r"\S":
            part = f"[^{classes[chr(92) + 's']}]"
        out.append(part)
    return "".join(out)


class ByteBpe:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, path: str, pattern: str) -> None:
        self.tokens = read_ranks(path)
        self.ranks = {token: rank for rank, token in enumerate(self.tokens)}
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=serialise_model(self.tokens))
        self.apart = self.pieces.unk_id()
        self.any, self.plain = regex.compile(pattern), re.compile(plain_pattern(pattern))
        self.beyond = re.compile(f"[^\\x00-\\u{_PLAIN_END - 1:04x}]").search
        self.inverse = [
            self.pieces.id_to_piece(i).translate(_TO_BYTE).encode("latin-1") for i in range(len(self.tokens))
        ]
        self.known: dict[str, bytes] = {}
        self.held = 0

    def pre_tokens(self, text: str) -> list[str]:
        return (self.any if self.beyond(text) else self.plain).findall(text)

    def parts(self, text: str) -> Iterator[list[str]]:
        """The pre-tokens of a text, not too many at once."""
        if len(text) <= LONG_TEXT:
            yield self.pre_tokens(text)
            return
        found = (self.any if self.beyond(text) else self.plain).finditer(text)
        while part := [m.group() for m in itertools.islice(found, PART)]:
            yield part

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        return b"".join(map(self._encode, self.parts(text)))

    def _encode(self, found: list[str]) -> bytes:
        new = set(found).difference(self.known)
        if new and self.held > REMEMBERED:
            self.known, self.held = {}, 0
            new = set(found)
        long = self._learn(list(new)) if new else None
        known = self.known
        if long:
            return b"".join([long[t] if t in long else known[t] for t in found])
        return b"".join(map(known.__getitem__, found))

    def _learn(self, pre_tokens: list[str]) -> dict[str, bytes]:
        """Encode pre-tokens, many in one call: a character outside the vocabulary keeps them apart.

        Long ones are returned, the others remembered.
        """
        merged, mapped, long = [], [], {}

        def keep(token: str, ids: bytes) -> None:
            if len(token) > REMEMBERED_LENGTH:
                long[token] = ids
            else:
                self.known[token] = ids
                self.held += _ENTRY + len(token) + len(ids)

        def call() -> None:
            ids = np.array(self.pieces.encode(_APART.join(mapped)), dtype="<u4")
            ends = np.flatnonzero(ids == self.apart).tolist()
            coded, at = ids.tobytes(), 0
            for token, end in zip(merged, [*ends, len(ids)], strict=True):
                keep(token, coded[4 * at : 4 * end])
                at = end + 1
            merged.clear()
            mapped.clear()

        size = 0
        for token in pre_tokens:
            raw = token.encode()
            rank = self.ranks.get(raw)
            if rank is not None:  # a pre-token that is itself in the vocabulary is that token
                keep(token, rank.to_bytes(4, "little"))
                continue
            if merged and (len(merged) == PER_CALL or size + len(raw) > CALL_LENGTH):
                call()
                size = 0
            merged.append(token)
            mapped.append(raw.decode("latin-1").translate(_TO_CHAR))
            size += len(raw)
        if merged:
            call()
        return long

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.inverse.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


_LOADED: dict[tuple[str, str], ByteBpe] = {}


def load(path: str, pattern: str) -> ByteBpe:
    """One encoder per worker process."""
    if (path, pattern) not in _LOADED:
        _LOADED[path, pattern] = ByteBpe(path, pattern)
    return _LOADED[path, pattern]


def encode_texts(docs: DataFrame, path: str, pattern: str, id_column: str = "doc_id", text_column: str = "text", keep_ids: bool = True) -> DataFrame:
    """Every text as token ids: id, n_tokens, ids_sha256, decoded_sha256 and, on request, token_ids."""
    kind = docs.schema[id_column].dataType.simpleString()
    ids = ", token_ids array<int>" if keep_ids else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path, pattern)
        for batch in batched(batches, PASS_BYTES):
            counts, hashes, decoded, lists = [], [], [], []
            for raw in byte_texts(batch.column(1)):
                coded = bpe.encode(raw.decode("utf-8", "replace")) if raw else b""
                counts.append(len(coded) // 4)
                hashes.append(hashlib.sha256(coded).hexdigest())
                decoded.append(hashlib.sha256(bpe.decode(coded)).hexdigest())
                if keep_ids:
                    lists.append(coded)
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(hashes), pa.array(decoded)]
            names = ["id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if keep_ids:
                ends = np.concatenate([[0], np.cumsum(np.array(counts, dtype=np.int64))]).astype(np.int32)
                values = np.frombuffer(b"".join(lists), dtype="<u4").astype(np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(values)))
                names.append("token_ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    out = rows.mapInArrow(run, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string{ids}")
    return out.withColumnRenamed("id", id_column)


def decode_ids(ids: DataFrame, path: str, pattern: str, id_column: str = "doc_id", ids_column: str = "token_ids") -> DataFrame:
    """Token ids back to text: id and text; a null list gives a null text."""
    kind = ids.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path, pattern)
        for batch in batched(batches, PASS_BYTES):
            texts = [
                None if x is None else bpe.decode(np.array(x, dtype="<u4").tobytes()).decode("utf-8", "replace")
                for x in batch.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["id", "text"])

    rows = ids.select(F.col(id_column).alias("id"), F.col(ids_column).alias("ids"))
    return rows.mapInArrow(run, f"id {kind}, text string").withColumnRenamed("id", id_column)

