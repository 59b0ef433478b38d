"""Secret scan of texts and of everything encoded inside them.

Each text is a layer. A worklist takes one layer at a time, matches the secret patterns, and adds the
layers that it contains: the text with its URL escapes resolved, the text with its Unicode escapes
resolved (\\uXXXX, \\UXXXXXXXX, \\u{...}, \\xXX, %uXXXX, &#...;), and the content of every base64 run, on one line
or wrapped over several. What stands before a run without a gap (``path/``, ``KEY_``, ``x+``) shifts its groups of
four, so a run, wrapped or not, is read at all four alignments, behind every ``/ _ - +`` of its first ``PREFIX`` characters,
in each of its parts between these, and from wherever compressed data begins: gzip, bz2 and zlib data anywhere,
raw deflated data behind any ``/ _ - +`` or line break. Compressed content (gzip, zlib, bz2, raw deflate) is inflated to its end,
through all members of a gzip file, and scanned both as it is and inflated. Content need not be text: the patterns are matched
on whatever stretches of it are readable, and on UTF-16 and UTF-32 with their zero bytes taken out. Content
of more than ``WINDOW`` characters is scanned in windows that overlap, so that memory stays bounded whatever
it inflates to; what may be longer than a window (base64 runs, escapes to be resolved) is then read as a stream of the whole
content, opened again for each layer in it. It ends when no layer is left. A layer whose content and place were seen before is not taken again,
so content that contains itself ends too. Every layer maps its characters to spans of the root text, by
stretches that were copied or replaced as a whole; a secret found in a layer is reported as the root span from its first to its last character.

Spans are (kind, start, end) in code points, end exclusive. The spans of the patterns on the root text
itself are the base spans; deeper layers only add to them.

Results for special inputs: null and empty texts have no spans; texts are scanned whole at any length;
repeated rows give repeated rows; an empty table gives an empty result; equal spans found in several layers
are listed once; other columns are ignored by ``find_secrets`` and kept as they are by ``redact``.
"""

from __future__ import annotations

import base64
import binascii
import bz2
import codecs
import hashlib
import io
import itertools
import re
import urllib.parse
import zlib
from array import array
from bisect import bisect_right
from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.common import batched

#: Kinds in the order in which spans at one start are listed.
KINDS = ("assign", "access", "hex")
#: Characters of a decoded layer that are held at once, and those that are in two windows.
WINDOW = 8 << 20
OVERLAP = 64 << 10
#: Bytes that are inflated or decoded at once.
CHUNK = 1 << 20
PASS_BYTES = 4 << 20
#: Blanks that are kept of a longer stretch of them, in content of more than a window; no pattern counts them.
MOST_BLANKS = 1024
#: Characters of a run from which it is judged whether compressed data begins.
HEAD = 1368
#: Shortest base64 run that is decoded.
LEAST_RUN = 16
#: Characters before the encoded ones of a run in which each ``/ _ - +`` is tried as their edge.
PREFIX = 200
#: Shortest content that can hold a secret: no pattern matches less.
LEAST_CONTENT = 16

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")
_PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_ESCAPE = re.compile(
    r"(?:\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}|\\u\{[0-9A-Fa-f]{1,8}\}|%u[0-9A-Fa-f]{4}"
    r"|\\x[0-9A-Fa-f]{2}|&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};)+"
)
_ONE_ESCAPE = re.compile(
    r"(?:\\|%)u([0-9A-Fa-f]{4})|\\x([0-9A-Fa-f]{2})|&#([0-9]+);|&#[xX]([0-9A-Fa-f]+);|\\U([0-9A-Fa-f]{8})|\\u\{([0-9A-Fa-f]+)\}"
)
_GAP = re.compile(r"[/_+-]")
_PARTS = re.compile(r"[^/_+-]+")
#: How gzip and bz2 data begin in base64.
_PACKED_TEXT = re.compile(r"H4sI|Qlpo[MNO]")
#: How zlib data begins in base64; its first two bytes are a multiple of 31, too.
_ZLIB_TEXT = re.compile(r"(?=[CGKOSWae][A-P][A-Za-z0-9+/_-]{10})")
_RUN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{%d,}={0,2}" % LEAST_RUN)
# Wrapped runs: what follows the first line fills its lines; the last one may end at a quote, bracket or tag.
_LINE = r"""[ \t]*\r?\n[ \t]*(?!--)[A-Za-z0-9+/_-]+(?==*[ \t]*(?:[\r\n"'`<)\]}]|\Z))"""
_WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{%d,}(?:%s)+={0,2}" % (LEAST_RUN, _LINE))
_WIDE = re.compile(r"(?:[\t\n\r\x20-\x7e]\x00{1,3}){7,}[\x20-\x7e]?")
_RUN_CHARACTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-="
_BREAKS = " \t\r\n"
_MANY_BLANKS = re.compile(" {%d,}" % (MOST_BLANKS + 1))
_INNER_SPACE = re.compile(r"[^\s][ \t]+(?=[^\s])")
_RUN_END = re.compile(r"[^A-Za-z0-9+/_=\s-]|[^\s][ \t]+(?=[^\s])")
# What may be the beginning of an escape that goes on in the next part of a stream.
_PERCENT_BEGUN = re.compile(r"%[0-9A-Fa-f]?\Z")
_ESCAPE_BEGUN = re.compile(
    r"(?:\\(?:u(?:[0-9A-Fa-f]{0,3}|\{[0-9A-Fa-f]{0,8})|U[0-9A-Fa-f]{0,7}|x[0-9A-Fa-f]?)?|%(?:u[0-9A-Fa-f]{0,3})?"
    r"|&(?:#(?:[0-9]{0,7}|[xX][0-9A-Fa-f]{0,6}))?)\Z"
)
_WIDE_UNIT = re.compile(r"[\t\n\r\x20-\x7e]\x00{1,3}")
_WIDE_BEGUN = re.compile(r"(?:[\t\n\r\x20-\x7e]\x00{1,3}){0,16}(?:[\t\n\r\x20-\x7e]\x00{0,2})?\Z")

Span = tuple[str, int, int]
#: Data or texts of any size, opened as often as they are read.
Data = Callable[[], Iterator[bytes]]
Texts = Callable[[], Iterator[str]]


class Part(str):
    """A window of longer content; the escapes of that content are resolved in its stream."""


def match(text: str) -> list[Span]:
    """The base patterns: leftmost non-overlapping matches of each kind, short ones dropped."""
    found = []
    if "=" in text or ":" in text:
        found += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in _ACCESS.finditer(text)]
    found += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return found


class Layer:
    """A text with the root spans of its characters, by stretches.

    ``begins`` has where each stretch begins, ``firsts`` its first root character; ``lasts`` has the root end of
    a stretch that stands for its root span as a whole, and -1 where each character is one of the root.
    """

    def __init__(self, text: str, begins: Sequence[int], firsts: Sequence[int], lasts: Sequence[int]) -> None:
        self.text, self.begins, self.firsts, self.lasts = text, begins, firsts, lasts

    def span(self, start: int, end: int) -> tuple[int, int]:
        """The root span of characters start to end (exclusive)."""
        i, j = bisect_right(self.begins, start) - 1, bisect_right(self.begins, end - 1) - 1
        first = self.firsts[i] + (start - self.begins[i] if self.lasts[i] < 0 else 0)
        return first, self.firsts[j] + end - self.begins[j] if self.lasts[j] < 0 else self.lasts[j]

    def replaced(self, pieces: Iterable[tuple[int, int, str]]) -> Layer:
        """The layer with some of its stretches replaced; new characters map to the whole stretch."""
        text, size, at = io.StringIO(), 0, 0
        begins, firsts, lasts = array("q"), array("q"), array("q")
        for start, end, new in itertools.chain(pieces, [(len(self.text), len(self.text), "")]):
            i = bisect_right(self.begins, at) - 1
            while at < start:
                stop = min(start, self.begins[i + 1] if i + 1 < len(self.begins) else start)
                begins.append(size)
                firsts.append(self.firsts[i] + (at - self.begins[i] if self.lasts[i] < 0 else 0))
                lasts.append(self.lasts[i])
                text.write(self.text[at:stop])
                size, at, i = size + stop - at, stop, i + 1
            if new:
                first, last = self.span(start, end)
                begins.append(size)
                firsts.append(first)
                lasts.append(last)
                text.write(new)
                size += len(new)
            at = end
        return Layer(text.getvalue(), begins, firsts, lasts)


def _unescape(found: re.Match) -> str:
    units = []
    for m in _ONE_ESCAPE.finditer(found.group()):
        code = int(m[1] or m[2] or m[4] or m[5] or m[6], 16) if m[3] is None else int(m[3])
        units.append(chr(code) if code < 0x110000 else m.group())
    # 😀 is one character written as two units
    return "".join(units).encode("utf-16-le", "surrogatepass").decode("utf-16-le", "replace")


class _Bunzip:
    """bz2 with the interface of zlib's decompression objects."""

    def __init__(self) -> None:
        self._inner = bz2.BZ2Decompressor()
        self.unconsumed_tail = b""

    def decompress(self, data: bytes, most: int) -> bytes:
        return self._inner.decompress(data, most) if data or not self._inner.needs_input else b""

    @property
    def eof(self) -> bool:
        return self._inner.eof

    @property
    def unused_data(self) -> bytes:
        return self._inner.unused_data


def _packed(data: bytes) -> bool:
    """Whether data begins like gzip, bz2 or zlib of any window."""
    if data[:2] == b"\x1f\x8b" or data[:3] == b"BZh":
        return True
    return len(data) > 1 and data[0] & 15 == 8 and data[0] < 0x80 and (data[0] << 8 | data[1]) % 31 == 0


def _inflater(data: bytes):
    if data[:1] == b"B":
        return _Bunzip()
    return zlib.decompressobj(31 if data[:1] == b"\x1f" else 15)


def _inflates(data: bytes, bits: int, least: int) -> bool:
    """Whether data inflates without an error, as far as it is there, to a least number of bytes."""
    try:
        return len(zlib.decompressobj(bits).decompress(data, CHUNK)) >= least
    except zlib.error:
        return False


def _until_error(inflater, data: bytes, step: int) -> Iterator[bytes]:
    """What zlib data inflates to, up to its first error, if any; returns whether there was none.

    A call that meets an error gives nothing, so what it would have given is asked for in smaller steps.
    """
    while not inflater.eof:
        before = inflater.copy()
        try:
            part = inflater.decompress(data, step)
        except zlib.error:
            if step > 1:
                yield from _until_error(before, data, max(1, step // 1024))
            return False
        if not part:
            break
        yield part
        data = inflater.unconsumed_tail
    return True


def _raw_inflated(chunks: Iterable[bytes]) -> Iterator[bytes]:
    """What raw deflated data inflates to, up to its end or first error."""
    inflater = zlib.decompressobj(-15)
    for data in chunks:
        if not (yield from _until_error(inflater, data, CHUNK)) or inflater.eof:
            return


def _inflated(chunks: Iterable[bytes]) -> Iterator[bytes]:
    """What all members of compressed data inflate to, in parts; what is no member stays as it is."""
    inflater, raw, rest = None, False, b""
    for chunk in chunks:
        rest += chunk
        while rest and not raw:
            if inflater is None:
                if len(rest) < 3:
                    break
                if not _packed(rest):
                    raw = True
                    break
                inflater = _inflater(rest)
            before = None if isinstance(inflater, _Bunzip) else inflater.copy()
            try:
                part = inflater.decompress(rest, CHUNK)
                if part:
                    yield part
                rest = inflater.unused_data if inflater.eof else inflater.unconsumed_tail
                while not inflater.eof and not rest and part:
                    before = before and inflater.copy()
                    part = inflater.decompress(b"", CHUNK)
                    if part:
                        yield part
                if inflater.eof:
                    rest, inflater = inflater.unused_data, None
            except (zlib.error, OSError):
                raw = True
                if before:
                    yield from _until_error(before, rest, max(1, CHUNK // 1024))
        if raw and rest:
            yield rest
            rest = b""
    if rest:
        yield rest


def _head(data: Data, most: int) -> bytes:
    parts, size = [], 0
    for part in data():
        parts.append(part)
        size += len(part)
        if size >= most:
            break
    return b"".join(parts)[:most]


def _unpacked(data: Data, seen: frozenset[bytes] = frozenset()) -> Iterator[Data]:
    """Data as it is and what it inflates to, through any number of layers; what inflates to itself is read once."""
    yield data
    head = _head(data, CHUNK)
    packed, raw = _packed(head), _inflates(head, -15, LEAST_CONTENT)
    if packed or raw:
        digest = hashlib.sha256(_head(data, WINDOW) if len(head) == CHUNK else head).digest()
        if digest not in seen:
            seen |= {digest}
            for inflated in [_inflated] * packed + [_raw_inflated] * raw:
                yield from _unpacked(partial(_applied, inflated, data), seen)


def _applied(step: Callable, opened: Callable[[], Iterator]) -> Iterator:
    return step(opened())


def _decoded(runs: Iterable[str]) -> Iterator[bytes]:
    """The bytes of a base64 run that comes in parts."""
    rest = ""
    for run in runs:
        run = rest + "".join(run.replace("-", "+").replace("_", "/").replace("=", "").split())
        end = len(run) // 4 * 4
        rest = run[end:]
        if end:
            yield base64.b64decode(run[:end])
    if len(rest) > 1:
        yield base64.b64decode(rest + "=" * (4 - len(rest)))


def _texts(chunks: Iterable[bytes]) -> Iterator[str]:
    """The text of data; what is not UTF-8 becomes U+FFFD, which no pattern holds, and blanks beyond ``MOST_BLANKS`` go."""
    decoder = codecs.getincrementaldecoder("utf-8")("replace")
    blanks, rest = " " * MOST_BLANKS, ""
    for chunk in itertools.chain(chunks, [b""]):
        text = rest + decoder.decode(chunk, not chunk)
        if blanks in text:
            text = _MANY_BLANKS.sub(blanks, text)
        kept = len(text.rstrip(" ")) if chunk else len(text)
        rest = text[kept:]
        if kept:
            yield text[:kept]


def _last_run(text: str) -> int:
    """Where the last lines of a text that may be of one run begin; its end if there are none."""
    run = len(text.rstrip(_RUN_CHARACTERS + _BREAKS))
    for m in _INNER_SPACE.finditer(text, run):
        run = m.end()
    return run


def _cut(texts: Iterable[str]) -> Iterator[str]:
    """A text as it is, or in windows if it is longer than one."""
    held: list[str] = []
    size, cut = 0, False
    for new in texts:
        held.append(new)
        size += len(new)
        if size <= WINDOW:
            continue
        text = "".join(held)
        # A run may go on behind the window, and is kept for the next one, or its last line is.
        run = _last_run(text)
        if len(text) - run > WINDOW // 2:
            line = text.rfind("\n") + 1
            run = line if len(text) - line <= WINDOW // 2 else len(text)
        yield Part(text)
        text, cut = text[max(0, run - OVERLAP) :], True
        held, size = [text], len(text)
    if size or not cut:
        yield Part("".join(held)) if cut else "".join(held)


def _windows(chunks: Iterable[bytes]) -> Iterator[str]:
    """The text of data, in windows of bounded size."""
    return _cut(_texts(chunks))


def _held_back(texts: Iterable[str], begun: re.Pattern, resolved: Callable[[str], str], most: int) -> Iterator[str]:
    """A stream with its escapes resolved; what may be the beginning of one waits for the next part."""
    rest = ""
    for text in texts:
        text = rest + text
        from_ = max(0, len(text) - most)
        found = begun.search(text, from_)
        end = found.start() if found else len(text)
        if begun is _WIDE_BEGUN and len(units := [m.start() for m in _WIDE_UNIT.finditer(text, end)]) >= 16:
            end = units[-8]  # enough to be known as wide
        rest = text[end:]
        if end:
            yield resolved(text[:end])
    if rest:
        yield resolved(rest)


def _unquoted(texts: Iterable[str]) -> Iterator[str]:
    def resolved(text: str) -> str:
        return _PERCENT.sub(lambda m: urllib.parse.unquote(m.group(), errors="replace"), text)

    return _held_back(texts, _PERCENT_BEGUN, resolved, 2)


def _unescaped(texts: Iterable[str]) -> Iterator[str]:
    return _held_back(texts, _ESCAPE_BEGUN, lambda text: _ESCAPE.sub(_unescape, text), 12)


def _narrowed(texts: Iterable[str]) -> Iterator[str]:
    return _held_back(texts, _WIDE_BEGUN, lambda text: _WIDE.sub(lambda m: m.group().replace("\0", ""), text), 70)


def _long_runs(texts: Iterable[str]) -> Iterator[tuple[int, int]]:
    """The first and last characters (exclusive) of runs, wrapped or not, that no window need hold whole."""
    begin, at, rest = 0, 0, ""  # where the last run begins, and where the rest does
    for whole in itertools.chain(texts, [None]):
        step = max(1, WINDOW // 4)
        for piece in [""] if whole is None else (whole[i : i + step] for i in range(0, len(whole), step)):
            text = rest + piece
            end = _RUN_END.search(text)
            if end or whole is None:
                stop = at + (end.start() + (text[end.start()] in _RUN_CHARACTERS) if end else len(text))
                if stop - begin > WINDOW // 2:
                    yield begin, stop
                if end:
                    begin = at + _last_run(text)
            kept = max(0, len(text.rstrip(" \t")) - 1)
            at, rest = at + kept, text[kept:]


def _stretch(texts: Iterable[str], start: int, end: int) -> Iterator[str]:
    at = 0
    for text in texts:
        if at + len(text) > start:
            yield text[max(0, start - at) : end - at]
        at += len(text)
        if at >= end:
            return


def _compact(texts: Iterable[str], start: int = 0) -> Iterator[str]:
    """The encoded characters of a run behind the first ones, without line breaks and padding."""
    for text in texts:
        text = "".join(text.replace("=", "").split())
        if start < len(text):
            yield text[start:]
        start = max(0, start - len(text))


def _decoded_from(run: Texts, start: int) -> Iterator[bytes]:
    return _decoded(_compact(run(), start))


def _long_starts(run: Texts) -> Iterator[int]:
    """The encoded characters of a run of any length from which it is decoded."""
    yield from range(4)
    at, rest, edges = 0, "", []
    for text in itertools.chain(run(), [""]):
        lines = text.replace("=", "\n").splitlines()
        size = len(rest)
        for line in lines:
            edges.append(at + size)
            size += len("".join(line.split()))
        whole = rest + "".join(_compact([text]))
        # What begins in the last characters is judged with those that follow.
        stop = len(whole) - HEAD if text else len(whole)
        if stop > 0:
            behind = [e - at for e in edges if e - at < stop]
            yield from (at + start for start in _packed_starts(whole, behind, 0) if start <= stop)
            edges = [e for e in edges if e - at >= stop]
            at, rest = at + stop, whole[stop:]
        else:
            rest = whole


def _content(run: str) -> Iterator[str]:
    """The texts of a base64 run: as it is and after any number of compressed layers, and of what is encoded across windows."""
    if len(run) <= CHUNK:
        whole = list(_decoded([run]))
        return _contents(lambda: iter(whole))
    return _contents(lambda: _decoded(run[i : i + CHUNK] for i in range(0, len(run), CHUNK)))


def _contents(data: Data, seen: frozenset[bytes] = frozenset()) -> Iterator[str]:
    for inner in _unpacked(data):
        yield from _streamed(partial(_applied, _texts, inner), seen)


def _streamed(texts: Texts, seen: frozenset[bytes]) -> Iterator[str]:
    """A text, or its windows and what lies in it across windows; a text that was seen on the way to it is not taken again."""
    steps, digest, long = set(), hashlib.sha256(), False
    for window in _cut(texts()):
        yield window
        if isinstance(window, Part):
            digest.update(window.encode("utf-8", "replace"))
            steps |= {step for step, there in _ESCAPES.items() if there(window)}
            long = True
    if not long or digest.digest() in seen:
        return
    seen |= {digest.digest()}
    for step in (_unquoted, _unescaped, _narrowed):
        if step in steps:
            yield from _streamed(partial(_applied, step, texts), seen)
    for first, last in _long_runs(texts()):

        def run(first: int = first, last: int = last) -> Iterator[str]:
            return _stretch(texts(), first, last)

        for start in dict.fromkeys(_long_starts(run)):
            yield from _contents(partial(_decoded_from, run, start), seen)


def _packed_starts(run: str, edges: Iterable[int] = (), behind: int = PREFIX) -> Iterator[int]:
    """Where compressed data begins: with its header anywhere, raw deflated data at edges and behind each ``/ _ - +``."""

    plain = run.replace("-", "+").replace("_", "/").replace("=", "")

    def head(at: int, size: int) -> bytes:
        piece = plain[at : at + size]
        piece = piece[:-1] if len(piece) % 4 == 1 else piece
        return binascii.a2b_base64(piece + "=" * (-len(piece) % 4))

    def inflates(at: int, bits: int, least: int) -> bool:
        return _inflates(head(at, 64), bits, 0) and _inflates(head(at, HEAD), bits, least)

    yield from (m.start() for m in _PACKED_TEXT.finditer(run))
    yield from (at for m in _ZLIB_TEXT.finditer(run) if _packed(head(at := m.start(), 4)) and inflates(at, 15, 0))
    gaps = (m.end() for m in _GAP.finditer(run, behind))
    yield from (at for at in itertools.chain(edges, gaps) if inflates(at, -15, LEAST_CONTENT))


def _starts(run: str) -> list[tuple[int, int]]:
    """The stretches of a run that may be the encoded ones: alignments, parts, and where packed data may begin."""
    found = [(i, len(run)) for i in range(4)]
    found += [(m.end(), len(run)) for m in _GAP.finditer(run, 0, PREFIX) if len(run) - m.end() >= LEAST_RUN]
    found += [m.span() for m in _PARTS.finditer(run) if len(m.group()) >= LEAST_RUN]
    found += [(start, len(run)) for start in _packed_starts(run)]
    return list(dict.fromkeys(found))


def _run_layers(layer: Layer) -> Iterator[Layer]:
    text = layer.text
    # Longer runs in a window are read in the stream, whole.
    most = WINDOW // 2 if isinstance(text, Part) else len(text)
    for m in _RUN.finditer(text):
        run = m.group()
        for start, end in _starts(run) if len(run) <= most else ():
            first, last = layer.span(m.start() + start, m.start() + end)
            for content in _content(run[start:end]):
                if len(content) >= LEAST_CONTENT:
                    yield Layer(content, [0], [first], [last])
    if "\n" in text:
        for m in _WRAPPED.finditer(text):
            first, last = layer.span(*m.span())
            lines = m.group().split()
            run = "".join(lines)
            edges = list(itertools.accumulate(map(len, lines[:-1])))
            for start in dict.fromkeys([*range(4), *_packed_starts(run, edges, 0)]) if len(run) <= most else ():
                for content in _content(run[start:]):
                    yield Layer(content, [0], [first], [last])


def _may_escape(text: str) -> bool:
    return "\\" in text or "&#" in text or "%u" in text


def _percent_in(text: str) -> bool:
    return "%" in text and _PERCENT.search(text) is not None


def _escape_in(text: str) -> bool:
    return _may_escape(text) and _ESCAPE.search(text) is not None


def _wide_in(text: str) -> bool:
    return "\0" in text and _WIDE.search(text) is not None


_ESCAPES = {_unquoted: _percent_in, _unescaped: _escape_in, _narrowed: _wide_in}


def inner_layers(layer: Layer) -> Iterator[Layer]:
    """The layers directly inside one."""
    text = layer.text
    if not isinstance(text, Part):
        if _percent_in(text):
            yield layer.replaced(
                (*m.span(), urllib.parse.unquote(m.group(), errors="replace")) for m in _PERCENT.finditer(text)
            )
        if _escape_in(text):
            yield layer.replaced((*m.span(), _unescape(m)) for m in _ESCAPE.finditer(text))
        if _wide_in(text):
            yield layer.replaced((*m.span(), m.group().replace("\0", "")) for m in _WIDE.finditer(text))
    yield from _run_layers(layer)


def scan(text: str) -> tuple[list[Span], list[Span]]:
    """Base spans and all spans of a text, each in order of start, then kind."""

    def ordered(spans: set[Span]) -> list[Span]:
        return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))

    base = set(match(text))
    spans = set(base)
    worklist = [inner_layers(Layer(text, [0], [0], [-1]))]
    seen = set()
    while worklist:
        layer = next(worklist[-1], None)  # one window at a time
        if layer is None:
            worklist.pop()
            continue
        place = layer.span(0, len(layer.text)) if layer.text else (0, 0)
        key = (hashlib.sha256(layer.text.encode("utf-8", "replace")).digest(), place, type(layer.text))
        if key in seen:
            continue
        seen.add(key)
        spans |= {(kind, *layer.span(start, end)) for kind, start, end in match(layer.text)}
        worklist.append(inner_layers(layer))
    return ordered(base), ordered(spans)


def spell(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def find_secrets(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id, n_assign, n_access, n_hex, base_sha256, spans and n_inner (spans that only inner layers show)."""
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batched(batches, PASS_BYTES):
            rows = [scan(text or "") for text in batch.column(1).to_pylist()]
            columns = [pa.array([sum(s[0] == k for s in base) for base, _ in rows], pa.int64()) for k in KINDS]
            hashes = [hashlib.sha256(spell(base).encode()).hexdigest() for base, _ in rows]
            columns += [pa.array(hashes, pa.string()), pa.array([spell(spans) for _, spans in rows], pa.string())]
            columns.append(pa.array([len(spans) - len(base) for base, spans in rows], pa.int64()))
            names = ["id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_inner"]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names)

    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    out = rows.mapInArrow(
        run,
        f"id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_inner long",
    )
    return out.withColumnRenamed("id", id_column)


def redacted(text: str, mark: str = "[SECRET]") -> str:
    """The text with every span, and spans that overlap, replaced by one mark."""
    out, at = [], 0
    merged: list[list[int]] = []
    for _, start, end in scan(text)[1]:
        if merged and start < merged[-1][1]:
            merged[-1][1] = max(end, merged[-1][1])
        else:
            merged.append([start, end])
    for start, end in merged:
        out += [text[at:start], mark]
        at = end
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, text_column: str = "text", length_column: str | None = "n_chars", mark: str = "[SECRET]") -> DataFrame:
    """All rows and columns, with secrets replaced in the text and the length column, if there, brought up to date."""
    names = docs.columns
    text_at = names.index(text_column)
    length_at = names.index(length_column) if length_column in names else -1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batched(batches, PASS_BYTES):
            texts = batch.column(text_at).to_pylist()
            new = [t if t is None else redacted(t, mark) for t in texts]
            changed = [a != b for a, b in zip(texts, new, strict=True)]
            if any(changed):
                columns = batch.columns
                columns[text_at] = pa.array(new, columns[text_at].type)
                if length_at >= 0:
                    old = columns[length_at]
                    lengths = [len(b) if c else n for b, c, n in zip(new, changed, old.to_pylist(), strict=True)]
                    columns[length_at] = pa.array(lengths, old.type)
                batch = pa.RecordBatch.from_arrays(columns, schema=batch.schema)
            yield batch

    return docs.mapInArrow(run, docs.schema)
