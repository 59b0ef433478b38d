"""Secrets wherever compressed data begins in a run, and across the windows of content longer than one."""

import base64
import bz2
import gzip
import random
import re
import zlib

import pytest

from tidegate.llm import secrets

KEY = b"password=hunter2hunter2xyz"
NOISE = random.Random(5)


def _raw(data, level=9):
    deflater = zlib.compressobj(level, zlib.DEFLATED, -15)
    return deflater.compress(data) + deflater.flush()


def _b64(data):
    return base64.b64encode(data).decode()


def _kinds(text):
    return {kind for kind, _, _ in secrets.scan(text)[1]}


@pytest.mark.parametrize("level", range(1, 10))
@pytest.mark.parametrize("glued", ["KEYS", "abcdefgh", "/" * 3 + "abcde"])
def test_headers_behind_glued_letters(level, glued):
    content = b"lorem ipsum dolor sit amet " * 3 + KEY
    for packed in (bz2.compress(content, level), zlib.compress(content, level), gzip.compress(content, level)):
        assert "assign" in _kinds(f"see {glued}{_b64(packed)} there")


@pytest.mark.parametrize("gap", ["/", "_", "-", "+"])
@pytest.mark.parametrize("pack", [_raw, zlib.compress, bz2.compress])
def test_packed_data_behind_a_long_path(gap, pack):
    path = re.sub("[^a-z]", "x", "".join(NOISE.choices("abcdefghijklmnopqrstuvwxyz", k=301)))
    assert "assign" in _kinds(f"see {path}{gap}{_b64(pack(b'lorem ipsum ' * 9 + KEY))} there")


@pytest.mark.parametrize(
    "data",
    [
        gzip.compress(_raw(b"some words " * 5 + KEY)),  # no header inside
        _raw(_raw(b"some words " * 5 + KEY)),
        zlib.compress(_raw(gzip.compress(b"some words " * 5 + KEY))),
        b"hCsecret=abcdefghijklmnop",  # text that begins like zlib data
        gzip.compress(b"hCsecret=abcdefghijklmnop"),
        _raw(b"word " * 13_105 + KEY + b" end", 0),  # stored in two blocks that part the secret
        gzip.compress(b"some words " * 5 + KEY)[:-8] + b"\1" * 8,  # wrong checksum
        zlib.compress(b"some words " * 5 + KEY)[:-4] + b"\1" * 4,
    ],
)
def test_layers_without_header_or_with_a_false_one(data):
    run = _b64(data)
    assert ("assign", 2, 2 + len(run)) in secrets.scan(f"x {run} y")[1]


@pytest.mark.parametrize("before", ["path/", "KEY_", "x", "xy", "xyz", "wxyz", "/some/path/to/a/file\n"])
@pytest.mark.parametrize("pack", [bytes, gzip.compress, zlib.compress])
def test_wrapped_runs_behind_prefixes(before, pack):
    run = base64.encodebytes(pack(NOISE.randbytes(150) + KEY + b", " + NOISE.randbytes(40))).decode()
    assert "assign" in _kinds(f"see\n{before}{run}\nthere")


@pytest.fixture()
def small_windows(monkeypatch):
    for name, size in {"WINDOW": 4000, "OVERLAP": 300, "CHUNK": 500, "MOST_BLANKS": 20, "HEAD": 400}.items():
        monkeypatch.setattr(secrets, name, size, raising=False)
    monkeypatch.setattr(secrets, "_MANY_BLANKS", re.compile(" {21,}"), raising=False)


def _found(content):
    run = _b64(gzip.compress(content))
    return ("assign", 0, len(run)) in secrets.scan(run)[1]


@pytest.mark.parametrize("before", ["", "a", "ab", "abc", "abcd", "path/", "a_b-cd/efgh"])
@pytest.mark.parametrize("pack", [bytes, gzip.compress, zlib.compress, bz2.compress, _raw])
@pytest.mark.parametrize("wrapped", [False, True])
def test_long_runs_in_long_content(small_windows, before, pack, wrapped):
    if pack is _raw and before and before[-1] not in "/_-+":
        before += "/"
    secret = pack(NOISE.randbytes(1500) + KEY + b" " + NOISE.randbytes(1500))
    run = base64.encodebytes(secret) if wrapped else base64.b64encode(secret)
    for size in (0, 5000):
        assert _found(b"word, word; " * (size // 12) + b"\n" + before.encode() + run + b"\n" + b"word, " * 900)


@pytest.mark.parametrize("place", [0, 1, 702])
def test_a_run_among_lines_of_one_word(small_windows, place):
    for pack in (bytes, gzip.compress, zlib.compress, _raw):
        lines = ["".join(NOISE.choices("abcdefghij", k=NOISE.randint(3, 9))) for _ in range(900)]
        lines[place] = _b64(pack(b"lorem ipsum " + KEY))
        assert _found("\n".join(lines).encode())


@pytest.mark.parametrize("inner", [KEY, base64.b64encode(gzip.compress(NOISE.randbytes(1500) + KEY))])
@pytest.mark.parametrize(
    "escape",
    [
        lambda data: "".join(f"%{b:02x}" for b in data),
        lambda data: "".join(f"\\u{b:04x}" for b in data),
        lambda data: "".join(f"&#{b};" for b in data),
        lambda data: "".join(f"\\x{b:02X}" for b in data),
        lambda data: data.decode() and "".join(f"{chr(b)}\0" for b in data),
        lambda data: "".join(f"{chr(b)}\0\0\0" for b in data),
    ],
)
def test_escapes_across_windows(small_windows, escape, inner):
    escaped = escape(inner).encode()
    for size in (131, 3999):
        assert _found(b"word, " * (size // 6) + b"x" * (size % 6) + b" " + escaped + b" " + b"word, " * 900)
    twice = "".join(f"%{b:02x}" for b in escaped).encode()
    assert _found(b"word, " * 500 + twice + b" word" * 900)


def test_many_blanks_across_windows(small_windows):
    for blanks in (10, 300, 5000, 9001):
        blank = b" " * blanks
        assert _found(b"word, " * 600 + b"password" + blank + b":" + blank + b"'hunter2hunter2xyz'" + b" word," * 900)


def test_long_content_without_end(small_windows):
    invalid = b"\\U7fffffff " * 2000  # no such character: stays as it is in every layer
    assert _found(invalid + KEY + b" " + invalid)
    assert not _found(b"A" * 30_000 + b" " + b"%25" * 5000)
