"""Operator 11 against the tokenizer library, plain merges and exact round trips."""

import base64
import random

import numpy as np
import pytest
import tiktoken
from pyspark.sql import functions as F

import public_tokenizers as P
from textgraph.llm import bpe, queries

PATHS = ["byte_bpe_multi_50k.tiktoken", "byte_bpe_50k.tiktoken"]


def library(ranks):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module", params=PATHS)
def ranks(request):
    return bpe.read_ranks(P.path(request.param))


def odd_texts():
    r = random.Random(3)
    own = ["", " ", "a", "\n\n \t x", "'s're it's", "  two  blanks ", "é" * 50, "a" * 999, "ab" * 700, " " * 513, "0123456789" * 30, "日本語のテキスト。", "😀😃" * 9, "  x", "=" * 300 + "-" * 301]
    own += ["".join(chr(r.choice((r.randint(32, 126), r.randint(160, 900), r.randint(0x4E00, 0x4F00)))) for _ in range(r.randint(1, 400))) for _ in range(150)]
    own += ["".join(r.choice("abcdeé \n.'s1") for _ in range(r.randint(1, 300))) for _ in range(300)]
    return own + ["".join(r.choice("aab") for _ in range(r.randint(1, 200))) for _ in range(200)]


def test_matches_equal_the_library(ranks):
    own, other = bpe.Matches(bpe.Vocabulary(ranks)), library(ranks)
    for text in odd_texts():
        got = np.frombuffer(b"".join(own[m] for m in bpe.regex.findall(P.PATTERN, text)), "<u4").tolist()
        assert got == other.encode_ordinary(text), text


def merged(data, ranks):
    """The merges, one by one."""
    parts = [bytes([b]) for b in data]
    while True:
        found = [ranks.get(a + b, 1 << 60) for a, b in zip(parts, parts[1:])]
        if not found or min(found) == 1 << 60:
            return [ranks[p] for p in parts]
        at = found.index(min(found))
        parts[at : at + 2] = [parts[at] + parts[at + 1]]


@pytest.mark.parametrize("seed", range(6))
def test_any_vocabulary_equals_the_merges(seed):
    """Random merges, and tokens that no merges reach; many texts need steps back."""
    r = random.Random(seed)
    ranks = {bytes([b]): b for b in range(256)}
    tokens = [b"a", b"b", b"c"]
    while len(tokens) < 70:
        left, right = r.choice(tokens), r.choice(tokens)
        if len(new := left + right) <= 9 and merged(new, ranks) == [ranks[left], ranks[right]]:
            ranks[new] = len(ranks)
            tokens.append(new)
    never = {"".join(r.choice("abc") for _ in range(6)).encode() for _ in range(40)}
    ranks |= {t: len(ranks) + k for k, t in enumerate(sorted(t for t in never if len(merged(t, ranks)) > 2))}
    own = bpe.Vocabulary(ranks)
    for _ in range(1500):
        data = "".join(r.choice("abcd" if r.random() < 0.1 else "abc") for _ in range(r.randint(1, 40))).encode()
        assert own.encode(data) == ([ranks[data]] if data in ranks else merged(data, ranks)), data


def test_linear_time():
    """A match of a million characters that the pattern doesn't cut."""
    import time

    own = bpe.Vocabulary(bpe.read_ranks(P.path(PATHS[0])))
    r = random.Random(1)
    seconds = []
    for n in (100_000, 400_000):
        data = "".join(r.choice("etaoinshr") for _ in range(n)).encode()
        began = time.process_time()
        ids = own.encode(data)
        seconds.append(time.process_time() - began)
        assert b"".join(own.token[i] for i in ids) == data
    assert seconds[1] < 8 * seconds[0]


def test_missing_bytes_are_refused():
    with pytest.raises(ValueError, match="missing"):
        bpe.Vocabulary({b"a": 0})
    ranks = {bytes([b]): b for b in range(256)} | {b"abc": 256, b"ab": 257}
    with pytest.raises(ValueError, match="before"):
        bpe.Vocabulary(ranks).encode(b"xabc")


@pytest.mark.parametrize("size", [1, 37, 1 << 18])
def test_slices_change_nothing(size):
    for text in odd_texts():
        parts = list(bpe.slices(text, size))
        assert "".join(parts) == text
        assert [m for p in parts for m in bpe.regex.findall(P.PATTERN, p)] == bpe.regex.findall(P.PATTERN, text)


def test_documents(spark, docs, no_docs, monkeypatch):
    monkeypatch.setattr(bpe, "MATCHES", 50)  # memos emptied all the time
    monkeypatch.setattr(bpe, "PAIRS", 50)
    monkeypatch.setattr(bpe, "SLICE", 100)
    path = P.path(PATHS[0])
    other = library(bpe.read_ranks(path))
    encoded = bpe.encode(docs, path, P.PATTERN)
    found = bpe.decode(encoded, path).collect()
    assert len(found) == docs.count()
    for r in found:
        text = r.row.text or ""
        assert np.frombuffer(r.ids, "<u4").tolist() == other.encode_ordinary(text)
        assert bytes(r.bytes).decode() == text
    assert sorted(map(str, (r.row for r in found))) == sorted(map(str, docs.collect()))
    assert bpe.decode(bpe.encode(no_docs, path, P.PATTERN), path).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    with open(P.path(PATHS[0]), "rb") as f:
        other = library({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)})
    import hashlib

    wanted = {}
    for r in queries.table(spark, sf, "documents").collect():
        ids = other.encode_ordinary(r.text or "")
        wanted[r.doc_id] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest())
    found = queries.op11_bpe(spark, sf)
    assert dict(found.dtypes)["n_tokens"] == "bigint"
    assert {r.doc_id: tuple(r)[1:] for r in found.collect()} == wanted
    assert found.where(F.col("n_tokens").isNull()).count() == 0
