"""Token counts and byte-level BPE against the public tokenizer libraries."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken

from tidegate.llm import bpe, counts, queries

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def texts():
    pick = random.Random(7)
    letters = "the of and ab \n\té漢字ｆ😀▁  ''..<s>0123 \x1c\x85 ½²_"
    words = "hello world the quick <unk> ▁▁ \x00 café 漢字 naïve don't 1234567    <|endoftext|>".split(" ")
    made = ["".join(pick.choice(letters) for _ in range(pick.randint(1, 90))) for _ in range(1500)]
    made += [" ".join(pick.choice(words) for _ in range(60)) for _ in range(200)]
    return [*made, "", " ", "  ", "\n", "x" * 3000, "ab" * 4000, " " * 2500, "日本語" * 700]


def reference_encoding(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_counts_equal_sentencepiece(texts):
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    assert counts.Transducer(counts.Vocabulary(PIECES)).count(texts) == [len(x) for x in model.encode(texts)]


def test_counts_survive_small_tables(texts, monkeypatch):
    monkeypatch.setattr(counts, "MOST_CELLS", 50_000)
    monkeypatch.setattr(counts, "CHUNK", 16)
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    transducer = counts.Transducer(counts.Vocabulary(PIECES))
    got = [n for i in range(0, len(texts), 50) for n in transducer.count(texts[i : i + 50])]
    assert got == [len(x) for x in model.encode(texts)]


def test_wide_cells(texts):
    transducer = counts.Transducer(counts.Vocabulary(PIECES))
    transducer.reset(np.uint64)
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    assert transducer.count(texts[:300]) == [len(x) for x in model.encode(texts[:300])]


def test_bpe_equals_tiktoken_and_round_trips(texts):
    coder = bpe.ByteBpe(RANKS, public_tokenizers.PATTERN)
    other = reference_encoding(coder.ranks)
    for text in texts:
        coded = coder.encode(text)
        assert np.frombuffer(coded, "<u4").tolist() == other.encode_ordinary(text)
        assert coder.decode(coded) == text.encode()


def test_every_token_is_its_own_encoding():
    coder = bpe.ByteBpe(RANKS, public_tokenizers.PATTERN)
    mapped = [t.decode("latin-1").translate(bpe._TO_CHAR) for t in coder.tokens]
    assert coder.pieces.encode(mapped) == [[i] for i in range(len(mapped))]


def test_bpe_forgets_and_learns_again(texts, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 20)
    coder = bpe.ByteBpe(RANKS, public_tokenizers.PATTERN)
    assert all(coder.decode(coder.encode(t)) == t.encode() for t in texts[:300])


def test_queries(spark, sf_dir):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    other = reference_encoding({t: i for i, t in enumerate(bpe.read_ranks(RANKS))})
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rows = queries.byte_bpe(spark, sf_dir).collect()
    assert {r["doc_id"] for r in rows} == set(docs) and len(rows) == len(docs)
    for r in rows:
        ids = np.array(other.encode_ordinary(docs[r["doc_id"]]), dtype="<u4")
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(ids.tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(docs[r["doc_id"]].encode()).hexdigest()
    for r in queries.token_counts(spark, sf_dir).collect():
        n = len(model.encode(docs[r["doc_id"]]))
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(docs[r["doc_id"]].encode()), n, n > 4096)


def test_odd_rows(spark):
    rows = [(1, None, "x"), (1, None, "x"), (None, "a b", None), (2, "", "y")]
    odd = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = bpe.encode_texts(odd, RANKS, public_tokenizers.PATTERN)
    assert sorted(r["n_tokens"] for r in got.collect()) == [0, 0, 0, 2]
    back = bpe.decode_ids(got, RANKS, public_tokenizers.PATTERN).collect()
    assert sorted(r["text"] for r in back) == ["", "", "", "a b"]
    assert sorted(r["n_tokens"] for r in counts.count_tokens(odd, PIECES, 1).collect()) == [0, 0, 0, 2]
    none = odd.limit(0)
    assert bpe.encode_texts(none, RANKS, public_tokenizers.PATTERN).count() == 0
    assert counts.count_tokens(none, PIECES, 1).count() == 0


def test_long_pre_tokens_and_texts_keep_memory_bounded(monkeypatch):
    """Long pre-tokens are not remembered, calls are bounded by length, and long texts are cut in parts."""
    coder = bpe.ByteBpe(RANKS, public_tokenizers.PATTERN)
    other = reference_encoding(coder.ranks)
    pick = random.Random(2)
    runs = ["".join(pick.choices("abcdefgh", k=pick.choice([150, 201, 5000]))) for _ in range(40)]
    text = " ".join(runs + runs[:10])
    assert np.frombuffer(coder.encode(text), "<u4").tolist() == other.encode_ordinary(text)
    assert all(len(token) <= bpe.REMEMBERED_LENGTH for token in coder.known)
    assert coder.held < 100_000
    monkeypatch.setattr(bpe, "LONG_TEXT", 1000)
    monkeypatch.setattr(bpe, "PART", 70)
    monkeypatch.setattr(bpe, "REMEMBERED", 3000)
    for long in (text, "naïve words, 漢字 and 12345 more\n" * 300):
        coded = coder.encode(long)
        assert np.frombuffer(coded, "<u4").tolist() == other.encode_ordinary(long)
        assert coder.decode(coded) == long.encode()
