"""Ids equal the tokenizer library's; decoding is an exact round trip."""

import hashlib
import random

import numpy as np
import pytest

from riskline.llm import bpe
from riskline.llm.catalog import tokenizer
from tests.llm.helpers import edge_docs, edge_texts, empty_docs


@pytest.fixture(scope="module")
def codec():
    path, pattern = tokenizer()
    return bpe.BytePairCodec(bpe.read_ranks(path), pattern)


@pytest.fixture(scope="module")
def library(codec):
    import tiktoken

    return tiktoken.Encoding("own", pat_str=tokenizer()[1], mergeable_ranks=codec.v.ranks, special_tokens={})


def test_encode_like_the_library(codec, library):
    rng = random.Random(2)
    parts = ["a", "b", " ", "  ", "\n", "\t", "é", "ß", "'s", "'", "1", "23", "-", "=", " ", "　", "\x1c",
             "\x85", "漢", "🙂", "the", "ing", "́", "½", "ʼ", "<|endoftext|>"]
    texts = [t or "" for t in edge_texts()] + ["".join(rng.choice(parts) for _ in range(rng.randrange(15)))
                                               for _ in range(4000)]
    for t in texts:
        ids = codec.encode(t)
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(t), t
        assert codec.decode(ids) == t.encode()


def test_append_and_replace(codec):
    rng = random.Random(3)
    table, data = bpe.PrefixTable(codec.v, b"the quick"), b"the quick"
    for _ in range(60):
        new = bytes(rng.choice(b"etaoin shr") for _ in range(rng.randrange(6)))
        if rng.random() < 0.5:
            table.append(new)
            data += new
        else:
            a = rng.randrange(len(data) + 1)
            b = rng.randrange(a, len(data) + 1)
            table.replace(a, b, new)
            data = data[:a] + new + data[b:]
        assert bytes(table.data) == data and table.ids() == bpe.PrefixTable(codec.v, data).ids()


def test_replace_stops_where_the_table_agrees_again(codec):
    """One byte in 4000: a few tokens' lengths are computed, and the table is that of the new text."""
    rng = random.Random(6)
    data = b" ".join(rng.choice([b"the", b"quick", b"water", b"history", b"x"]) for _ in range(900))[:4000]
    table = bpe.PrefixTable(codec.v, data)
    for at, new in ((10, b"z"), (2000, b""), (3000, b"more words "), (0, b"q")):
        n = table.replace(at, at + 1, new)
        data = data[:at] + new + data[at + 1:]
        assert table.last == bpe.PrefixTable(codec.v, data).last
        assert n <= len(new) + 2 * codec.v.longest + 40 < 1000, (n, codec.v.longest)
    assert table.replace(len(data), len(data), b"!") == 1


def test_full_caches_change_nothing(codec, library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_CHUNKS", 3)
    monkeypatch.setattr(bpe, "CACHED_PREFIXES", 10)
    monkeypatch.setattr(bpe, "CACHED_PAIRS", 5)
    small = bpe.BytePairCodec(codec.v.ranks, tokenizer()[1])
    for t in edge_texts()[8:16]:
        assert np.frombuffer(small.encode(t), "<u4").tolist() == library.encode_ordinary(t)


def test_documents(spark, library):
    docs = edge_docs(spark)
    got = bpe.encode_documents(docs, *tokenizer(), keep=("doc_id", "w"), ids_out=True).collect()
    assert len(got) == docs.count()
    texts = edge_texts()
    for r in got:
        t = texts[r.doc_id] or ""
        ids = library.encode_ordinary(t)
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()
    assert bpe.encode_documents(empty_docs(spark), *tokenizer()).count() == 0
