"""Byte-level BPE by prefix dynamic programming.

For a prefix of a piece of text exactly one token can end its encoding. The table of these
unique last tokens is filled from left to right: a token t that ends at byte i is the last
one if the pair of the token that ends at i - len(t) and t is stable, i.e. BPE leaves their
joined bytes as those two tokens. Reading the table from its end gives the encoding. Appending
only adds entries, and an edit keeps all entries before it, so both re-encode exactly without
starting over (``PrefixTable.append`` and ``replace``).

``BytePairCodec`` cuts text by the tokenizer's pattern and keeps the ids of recent chunks (a
bounded cache); ``encode_documents`` runs it inside Spark tasks. The vocabulary comes from a
file given by path; the driver reads it and broadcasts it (its size is the vocabulary's).

Defined results: null and empty texts have no tokens; every row is encoded by itself, so
repeated rows give equal rows; an empty table gives an empty result; only doc_id and text are
read (and the columns asked for).
"""

from __future__ import annotations

import base64
import hashlib
import struct
from functools import partial
from typing import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskline.llm.common import small_batches, text_or_empty

CACHED_CHUNKS = 500_000
CACHED_PREFIXES = 1_000_000
CACHED_PAIRS = 500_000
LONGEST_CACHED = 64

# Fixed: Unicode White_Space, which the pattern's \s stands for in the tokenizer's library.
_WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Vocabulary:
    """Tokens of a byte-level BPE by id, how they were merged, and which pairs are stable."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token = {i: t for t, i in ranks.items()}
        self.longest = max(map(len, ranks), default=1)
        self._halves: dict[int, tuple[int, int] | None] = {}
        self._stable: dict[int, bool] = {}
        self._last: dict[bytes, int] = {}

    def merge(self, data: bytes, until: int = 1) -> list[bytes]:
        """Plain BPE of a few bytes: join the pair of lowest rank, the leftmost first."""
        parts = [data[i:i + 1] for i in range(len(data))]
        while len(parts) > until:
            rank, i = min((self.ranks.get(parts[i] + parts[i + 1], 1 << 40), i)
                          for i in range(len(parts) - 1))
            if rank == 1 << 40:
                break
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def halves(self, t: int) -> tuple[int, int] | None:
        """The two tokens whose merge made ``t``; None for a single byte."""
        if t not in self._halves:
            data = self.token[t]
            self._halves[t] = None if len(data) == 1 else tuple(
                self.ranks[x] for x in self.merge(data, 2))[:2]
        return self._halves[t]

    def whole(self, t: int) -> bool:
        """Is token ``t`` the encoding of its own bytes?"""
        h = self.halves(t)
        return h is None or self.token[h[0]] + self.token[h[1]] == self.token[t]

    def stable(self, a: int, b: int) -> bool:
        """Does BPE leave the joined bytes of ``a`` and ``b`` as these two tokens?

        Undo the merges of both sides from the last one. Whatever stands at the border at
        some moment must not have merged across it before its own side's next merge.
        """
        key = a << 32 | b
        got = self._stable.get(key)
        if got is None:
            if len(self._stable) >= CACHED_PAIRS:
                self._stable.clear()
            got = self._stable[key] = self._holds(a, b)
        return got

    def _holds(self, x: int, y: int) -> bool:
        token, ranks = self.token, self.ranks
        next_x = next_y = 1 << 40
        while True:
            r = ranks.get(token[x] + token[y])
            if r is not None and r < next_x and r <= next_y:
                return False
            hx, hy = self.halves(x), self.halves(y)
            if hx and (not hy or x > y):
                next_x, x = x, hx[1]
            elif hy:
                next_y, y = y, hy[0]
            else:
                return True

    def last_token(self, text: bytes, i: int, before) -> int:
        """The unique last token of text[:i]; ``before(j)`` is that of text[:j]."""
        get, stable = self.ranks.get, self.stable
        for size in range(min(i, self.longest), 0, -1):
            t = get(text[i - size:i])
            if t is not None:
                if size == i:
                    if self.whole(t):
                        return t
                elif (p := before(i - size)) >= 0 and stable(p, t):
                    return t
        return -1

    def short_ids(self, data: bytes) -> list[int]:
        """Ids of a short piece; the last tokens of all prefixes met so far are shared."""
        last, stable, get, n = self._last, self._stable, self.ranks.get, len(data)
        i = n
        while i and data[:i] not in last:
            i -= 1
        for i in range(i + 1, n + 1):       # last_token(), written out for speed
            found = -1
            for size in range(min(i, self.longest), 0, -1):
                t = get(data[i - size:i])
                if t is None:
                    continue
                if size == i:
                    if self.whole(t):
                        found = t
                        break
                    continue
                p = last[data[:i - size]]
                if p >= 0:
                    ok = stable.get(p << 32 | t)
                    if ok or ok is None and self.stable(p, t):
                        found = t
                        break
            last[data[:i]] = found
        out, i = [], len(data)
        while i:
            t = last[data[:i]]
            out.append(t)
            i -= len(self.token[t])
        if len(last) >= CACHED_PREFIXES:
            last.clear()
        return out[::-1]


class PrefixTable:
    """Unique last token of every prefix of a byte string."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.v, self.data, self.last = vocabulary, bytearray(), [-1]
        self.append(data)

    def append(self, data: bytes) -> None:
        last = self.last
        self.data += data
        text = bytes(self.data)
        for i in range(len(last), len(text) + 1):
            last.append(self.v.last_token(text, i, last.__getitem__))

    def replace(self, start: int, end: int, data: bytes) -> int:
        """Put ``data`` in place of bytes start..end; the number of entries computed anew.

        Entries up to ``start`` stay. An entry depends on the bytes and entries of the longest
        token's length before it, so once that many entries behind the edit equal the old ones,
        all further ones do and are taken over.
        """
        old, delta = self.last, len(data) - (end - start)
        self.data[start:end] = data
        text = bytes(self.data)
        self.last = last = old[:start + 1]
        same = 0
        for i in range(start + 1, len(text) + 1):
            last.append(self.v.last_token(text, i, last.__getitem__))
            before = i - delta
            same = same + 1 if before > end and old[before] == last[i] else 0
            if same >= self.v.longest:
                last += old[before + 1:]
                return i - start
        return len(text) - start

    def ids(self) -> list[int]:
        out, i = [], len(self.data)
        while i:
            out.append(self.last[i])
            i -= len(self.v.token[self.last[i]])
        return out[::-1]


class _Split(Exception):
    """A blank beside other white space: chunks cannot be cut at every blank."""


class _Chunks(dict):
    """Chunk -> its ids as little-endian 32-bit integers."""

    def __init__(self, codec: "BytePairCodec", lead: str, edges: bool):
        super().__init__()
        self.codec, self.lead, self.edges = codec, lead, edges

    def __missing__(self, chunk: str) -> bytes:
        if self.edges and (not chunk or self.codec.white(chunk[0]) or self.codec.white(chunk[-1])):
            raise _Split
        ids = self.codec.encode_chunk(self.lead + chunk)
        if len(chunk) <= LONGEST_CACHED:
            if len(self) >= CACHED_CHUNKS:
                self.clear()
            self[chunk] = ids
        return ids


class BytePairCodec:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.v = Vocabulary(ranks)
        self.pattern = regex.compile(pattern.replace(r"[^\s", f"[^{_WHITE}").replace(
            r"\s", f"[{_WHITE}]").replace(r"\S", f"[^{_WHITE}]"))
        self.letters_match = all(self.pattern.findall(x) == [x] for x in ("a", " a", "aé", " üßx漢"))
        self.white = regex.compile(f"[{_WHITE}]").match
        self.cut = regex.compile(f"(?<=[^{_WHITE}]) (?=[^{_WHITE}])")
        self.first, self.later = _Chunks(self, "", True), _Chunks(self, " ", True)
        self.odd_first, self.odd_later = _Chunks(self, "", False), _Chunks(self, " ", False)

    def encode_chunk(self, chunk: str) -> bytes:
        ids: list[int] = []
        word = chunk[1:] if chunk[:1] == " " else chunk
        # letters only, with or without a blank before them, are one match of the pattern
        for piece in (chunk,) if self.letters_match and word.isalpha() else self.pattern.findall(chunk):
            data = piece.encode()
            whole = self.v.ranks.get(data)
            if whole is not None:
                ids.append(whole)
            elif len(data) <= LONGEST_CACHED:
                ids += self.v.short_ids(data)
            else:
                ids += PrefixTable(self.v, data).ids()
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        """Ids of the whole text as little-endian 32-bit integers.

        No match of the pattern spans a blank between two other characters that are not
        white space, and the blank belongs to what follows, so text is cut there.
        """
        if not text:
            return b""
        try:
            head, *tail = text.split(" ")
            return self.first[head] + b"".join(map(self.later.__getitem__, tail))
        except _Split:
            head, *tail = self.cut.split(text)
            return self.odd_first[head] + b"".join(map(self.odd_later.__getitem__, tail))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.v.token.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_CODECS: dict[tuple, BytePairCodec] = {}


def _codec(shared, pattern: str) -> BytePairCodec:
    """One codec per worker process, vocabulary and pattern."""
    key = (shared.value["digest"], pattern)
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = BytePairCodec(shared.value["ranks"], pattern)
    return _CODECS[key]


def _rows(batches: Iterator[pa.RecordBatch], shared, pattern: str, ids_out: bool) -> Iterator[pa.RecordBatch]:
    codec = _codec(shared, pattern)
    for b in batches:
        names = [n for n in b.schema.names if n != "text"]
        keep = [b[n] for n in names]
        n, ids_sha, text_sha, every = [], [], [], []
        for text in b["text"]:
            ids = codec.encode(text.as_py() or "")
            n.append(len(ids) // 4)
            ids_sha.append(hashlib.sha256(ids).hexdigest())
            text_sha.append(hashlib.sha256(codec.decode(ids)).hexdigest())
            if ids_out:
                every.append(np.frombuffer(ids, "<u4").astype(np.int32))
        out = [*keep, pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()),
               pa.array(text_sha, pa.string())]
        names += ["n_tokens", "ids_sha256", "decoded_sha256"]
        if ids_out:
            out.append(pa.array(every, pa.list_(pa.int32())))
            names.append("ids")
        yield pa.RecordBatch.from_arrays(out, names=names)


def encode_documents(docs: DataFrame, vocabulary: str, pattern: str, keep: tuple[str, ...] = ("doc_id",),
                     ids_out: bool = False) -> DataFrame:
    """Columns ``keep`` of each row with n_tokens, ids_sha256, decoded_sha256 (the digest of
    the decoded ids) and, if asked for, the ids."""
    spark = docs.sparkSession
    small_batches(spark, 200)
    ranks = read_ranks(vocabulary)
    digest = hashlib.sha256(repr(sorted(ranks.items())).encode()).hexdigest()
    shared = spark.sparkContext.broadcast({"digest": digest, "ranks": ranks})
    d = docs.select(*keep, text_or_empty().alias("text"))
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in d.schema.fields[:-1])
    return d.mapInArrow(partial(_rows, shared=shared, pattern=pattern, ids_out=ids_out),
                        fields + "n_tokens long, ids_sha256 string, decoded_sha256 string"
                        + (", ids array<int>" if ids_out else ""))
