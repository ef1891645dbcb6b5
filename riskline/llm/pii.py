"""Personal data by weak supervision.

Candidate spans come from base patterns (fixed by the contract) and from looser ones (phones
without +, digits that only look like cards or addresses, spelled-out e-mail addresses,
secrets behind a name). Labelers of three sorts vote on each candidate: regular expressions
(shape, checksum, ranges), gazetteers (domains, issuers, ranges) and context (words before
the span). Votes are yes, no or none. Spark counts the vote patterns of all candidates of all
texts; from these counts (a few hundred rows at most) expectation-maximisation estimates, for
each kind, how reliable every labeler is and how likely each pattern is a true span. A
logistic classifier is then trained on these soft labels with the votes and surface features,
and decides on the candidates; base spans always stay.

Defined results: null and empty texts have no spans; every row is scanned by itself, so
repeated rows give equal rows; an empty table gives an empty result; of the input only doc_id
and text are read (and the columns asked for). Digits are ASCII digits; places count code
points, the end is exclusive.
"""

from __future__ import annotations

import hashlib
import re
from functools import partial
from typing import Iterator, NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskline.llm.common import small_batches, text_or_empty

KINDS = ("email", "ip", "card", "phone", "secret")
BASE_KINDS = 4
SECRET = 4
LABELERS = 5
FEATURES = 12
THRESHOLD = 0.5
EM_ROUNDS = 50
#: patterns of (kind, votes, feature): bounds what reaches the driver
PATTERNS = len(KINDS) * 3 ** LABELERS * FEATURES

# Fixed by the contract.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGITS = re.compile(r"[0-9][0-9.\x20()-]*")     # holds every ip, card and phone after its +
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")

# Looser candidates.
_SPELLED = re.compile(r"[A-Za-z0-9._%+-]{1,64}[ ]?(?:[(\[{]at[)\]}]| at )[ ]?[A-Za-z0-9-]{1,63}"
                      r"(?:[ ]?(?:[(\[{]dot[)\]}]| dot )[ ]?[A-Za-z0-9-]{1,63})+")
_GROUPED = re.compile(r"(?:\([0-9]{2,4}\)[ ]?|[0-9]{2,4}[ .-])[0-9]{3,4}(?:[ .-]?[0-9]{2,4}){1,3}(?![0-9])")
_ASSIGNED = re.compile(r"[=:][ ]?[\"']?([A-Za-z0-9_+/-]{8,}+(?:\.[A-Za-z0-9_+/-]++)*+)")

# Gazetteers and context words: small, stated lists.
DOMAINS = frozenset("com org net edu gov info io de fr es it uk eu us".split())
ISSUERS = re.compile(r"4|5[1-5]|2[2-7]|3[47]|6(?:011|5)")
CONTEXT = (
    ("mail", "contact", "write", "@"),
    ("ip", "address", "host", "server", "addr"),
    ("card", "visa", "credit", "payment", "mastercard"),
    ("phone", "tel", "call", "mobile", "fax", "cell"),
    ("token", "password", "secret", "key", "passwd"),
)
_NAME = re.compile(r"([A-Za-z_]{2,32})[ ]?$")
YES, NO, NONE = 1, 0, 2
#: the checksum and range labeler is an expert: of true spans it denies this share, by
#: definition and not by estimate (else numbers that only look like cards form a class)
EXPERT, EXPERT_DENIES = 1, 0.01


class Span(NamedTuple):
    kind: int
    start: int
    end: int
    base: bool
    code: int           # kind, votes and surface feature in one number


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def small(part: str) -> bool:
    """Is the number at most 255? (leading zeros are allowed)"""
    p = part.lstrip("0")
    return len(p) < 4 and int(p or "0") <= 255


def _only_digits(s: str) -> str:
    return "".join(c for c in s if c.isdigit())


def _code(text: str, kind: int, start: int, end: int, base: bool, checked: int) -> int:
    """Votes of the five labelers and the surface feature of a candidate."""
    s = text[start:end]
    before = text[max(0, start - 32):start].lower()
    digits = _only_digits(s)
    if kind == 0:
        shape = YES if base else NONE
        known = YES if s.rpartition(".")[2].lower() in DOMAINS or not base else NO
        grouped = YES if 5 < len(s) < 80 else NO
    elif kind == 1:
        parts = s.split(".")
        shape = YES if all(len(p) < 4 for p in parts) else NO
        known = NO if parts[0].lstrip("0") in ("", "255") else YES
        grouped = NO if any(len(p) > 1 and p[0] == "0" for p in parts) else YES
    elif kind == 2:
        shape = YES if len(digits) in (15, 16) else NONE
        known = YES if ISSUERS.match(digits) else NO
        grouped = YES if re.fullmatch(r"(?:[0-9]{4}[ -]){3}[0-9]{4}|[0-9]{15,16}", s) else NO
    elif kind == 3:
        shape = YES if s.startswith("+") else NONE
        known = YES if s.startswith("+") or s.startswith("(") else NONE
        grouped = YES if len(re.findall(r"[0-9]+", s)) in (3, 4, 5) else NO
    else:
        shape = YES if re.search(r"[0-9]", s) and re.search(r"[A-Za-z]", s) else NO
        known = YES if re.fullmatch(r"[0-9a-fA-F]+", s) else NONE
        grouped = YES if len(s) >= 12 else NO
    context = YES if any(w in before for w in CONTEXT[kind]) else NONE
    votes = 0
    for v in (shape, checked, known, context, grouped):
        votes = votes * 3 + v
    inside = (start > 0 and text[start - 1].isalnum()) or (end < len(text) and text[end].isalnum())
    feature = (2 if base else 0) + inside + 4 * min(2, (end - start) // 12)
    return (kind * 3 ** LABELERS + votes) * FEATURES + feature


def spans(text: str) -> list[Span]:
    """Base spans and candidates, by kind and start."""
    out: list[Span] = []

    def add(kind: int, start: int, end: int, base: bool, checked: int) -> None:
        out.append(Span(kind, start, end, base, _code(text, kind, start, end, base, checked)))

    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            add(0, start, m.end(), True, YES)
            done = m.end()
        at = text.find("@", max(at + 1, done))
    if "dot" in text:
        for m in _SPELLED.finditer(text):
            add(0, m.start(), m.end(), False, NONE)
    for run in _DIGITS.finditer(text):
        lo, hi = run.span()
        if hi - lo < 3:
            continue
        own: list[tuple[int, int]] = []
        for m in _IP.finditer(text, lo, hi):
            ok = all(map(small, m.group().split(".")))
            add(1, *m.span(), ok, YES if ok else NO)
            own.append(m.span())
        for m in _CARD.finditer(text, lo, hi):
            digits = _only_digits(m.group())
            if 13 <= len(digits) <= 19:
                ok = luhn(digits)
                add(2, *m.span(), ok, YES if ok else NO)
                own.append(m.span())
        if lo and text[lo - 1] == "+":
            end = hi
            while not "0" <= text[end - 1] <= "9":
                end -= 1
            if end - lo >= 3 and 9 <= len(_only_digits(text[lo:end])) <= 15:
                add(3, lo - 1, end, True, YES)
                own.append((lo - 1, end))
        # without +: the run, with a bracket that may open it
        start = lo - 1 if lo and text[lo - 1] == "(" else lo
        for m in _GROUPED.finditer(text, start, hi):
            s, e = m.span()
            if 9 <= len(_only_digits(m.group())) <= 15 and not any(s < y and x < e for x, y in own):
                add(3, s, e, False, YES if 10 <= len(_only_digits(m.group())) <= 12 else NO)
    for m in _ASSIGNED.finditer(text):
        name = _NAME.search(text, max(0, m.start() - 33), m.start())
        if name and any(w in name.group(1).lower() for w in CONTEXT[4]):
            add(4, *m.span(1), False, YES)
    out.sort(key=lambda s: (s.kind, s.start, s.end))
    return out


def decide(found: list[Span], chosen: np.ndarray) -> list[Span]:
    """Base spans and the accepted candidates that touch no span taken before them; a secret may
    hold such spans (digits that look like a card), else the rest of its value would stay."""
    taken = [s for s in found if s.base]
    places = sorted((s.start, s.end) for s in taken)
    for s in found:
        if not s.base and chosen[s.code]:
            if not any(a < s.end and s.start < b and not (s.kind == SECRET and s.start <= a and b <= s.end)
                       for a, b in places):
                taken.append(s)
                places.append((s.start, s.end))
    return sorted(taken, key=lambda s: (s.kind, s.start, s.end))


def _patterns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of vote patterns: at most PATTERNS rows a task."""
    count = np.zeros(PATTERNS, np.int64)
    for b in batches:
        for t in b["text"]:
            for s in spans(t.as_py() or ""):
                count[s.code] += 1
    at = np.flatnonzero(count)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(count[at])], names=["code", "n"])


def _votes(code: np.ndarray) -> np.ndarray:
    v = code // FEATURES % 3 ** LABELERS
    return np.stack([v // 3 ** (LABELERS - 1 - j) % 3 for j in range(LABELERS)], axis=1)


def reliabilities(votes: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """EM over vote patterns of one kind with their counts.

    Returns each pattern's probability of a true span and P(vote | class) of every labeler,
    shape (labelers, 2 classes, 3 votes). Starts from the majority of the votes.
    """
    yes, no = (votes == YES).sum(axis=1), (votes == NO).sum(axis=1)
    p = (yes + 0.5) / (yes + no + 1.0)
    table = np.zeros((votes.shape[1], 2, 3))
    for _ in range(EM_ROUNDS):
        weight = np.stack([n * (1 - p), n * p])
        prior = (weight.sum(axis=1) + 1) / (n.sum() + 2)
        for j in range(votes.shape[1]):
            for v in range(3):
                table[j, :, v] = (weight[:, votes[:, j] == v].sum(axis=1) + 0.5) / (weight.sum(axis=1) + 1.5)
        true = table[EXPERT, 1]
        true[NO] = 0.0
        true *= (1 - EXPERT_DENIES) / true.sum()
        true[NO] = EXPERT_DENIES
        score = np.log(prior)[:, None] + sum(np.log(table[j][:, votes[:, j]]) for j in range(votes.shape[1]))
        p = 1 / (1 + np.exp(np.clip(score[0] - score[1], -50, 50)))
    return p, table


def _design(code: np.ndarray) -> np.ndarray:
    """One-hot votes by labeler and kind, and surface feature by kind."""
    kind = code // FEATURES // 3 ** LABELERS
    votes = _votes(code)
    x = np.zeros((len(code), len(KINDS) * (3 * LABELERS + FEATURES)))
    at = np.arange(len(code))
    for j in range(LABELERS):
        x[at, kind * 3 * LABELERS + 3 * j + votes[:, j]] = 1
    x[at, len(KINDS) * 3 * LABELERS + kind * FEATURES + code % FEATURES] = 1
    return x


def classifier(code: np.ndarray, n: np.ndarray, p: np.ndarray, rounds: int = 300) -> np.ndarray:
    """Weights of the logistic classifier on soft labels ``p`` (base spans count as true)."""
    x = _design(code)
    w = np.zeros(x.shape[1])
    weight = n / n.sum()
    step = np.zeros_like(w)
    for _ in range(rounds):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
        step = 0.9 * step + x.T @ (weight * (p - q)) - 1e-4 * w
        w += step
    return w


def train(docs: DataFrame) -> np.ndarray:
    """Which of the PATTERNS codes the classifier accepts."""
    small_batches(docs.sparkSession)
    counts = docs.select(text_or_empty().alias("text")).mapInArrow(_patterns, "code long, n long") \
        .groupBy("code").agg(F.sum("n").alias("n")).orderBy("code")
    rows = counts.collect()     # at most PATTERNS rows
    if not rows:
        return np.zeros(PATTERNS, bool)
    code, n = (np.array([r[c] for r in rows], np.int64) for c in ("code", "n"))
    kind, votes = code // FEATURES // 3 ** LABELERS, _votes(code)
    p = np.zeros(len(code))
    for k in np.unique(kind):
        own = kind == k
        p[own] = reliabilities(votes[own], n[own])[0]
    p[code % FEATURES // 2 % 2 == 1] = 1.0
    w = classifier(code, n, p)
    every = np.arange(PATTERNS)
    return 1 / (1 + np.exp(-np.clip(_design(every) @ w, -50, 50))) >= THRESHOLD


def _text(found: list[Span]) -> str:
    return ",".join(f"{KINDS[s.kind]}:{s.start}:{s.end}" for s in found)


def _rows(batches: Iterator[pa.RecordBatch], chosen: np.ndarray) -> Iterator[pa.RecordBatch]:
    for b in batches:
        n: list[list[int]] = [[] for _ in range(BASE_KINDS)]
        sha, every = [], []
        for t in b["text"]:
            found = spans(t.as_py() or "")
            base = [s for s in found if s.base]
            for k in range(BASE_KINDS):
                n[k].append(sum(s.kind == k for s in base))
            sha.append(hashlib.sha256(_text(base).encode()).hexdigest())
            every.append(_text(decide(found, chosen)))
        yield pa.RecordBatch.from_arrays(
            [b["doc_id"], *[pa.array(x, pa.int64()) for x in n], pa.array(sha, pa.string()),
             pa.array(every, pa.string())],
            names=["doc_id", *[f"n_{k}" for k in KINDS[:BASE_KINDS]], "base_sha256", "spans"])


def personal_data(docs: DataFrame) -> DataFrame:
    """Counts and digest of the base spans and all spans of each row of ``docs``."""
    chosen = train(docs)
    d = docs.select("doc_id", text_or_empty().alias("text"))
    kind = d.schema["doc_id"].dataType.simpleString()
    return d.mapInArrow(partial(_rows, chosen=chosen),
                        f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, "
                        "base_sha256 string, spans string")


def _masked(batches: Iterator[pa.RecordBatch], chosen: np.ndarray) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = []
        for t in b["text"]:
            text = t.as_py()
            found = decide(spans(text), chosen) if text else []
            if found:
                parts, at = [], 0
                for s in sorted(found, key=lambda s: (s.start, -s.end)):
                    if s.start >= at:
                        parts += [text[at:s.start], f"[{KINDS[s.kind].upper()}]"]
                    at = max(at, s.end)
                text = "".join(parts) + text[at:]
            out.append(text)
        names = b.schema.names
        yield pa.RecordBatch.from_arrays(
            [pa.array(out, pa.string()) if n == "text" else b[n] for n in names], names=names)


def mask(docs: DataFrame) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets."""
    chosen = train(docs)
    d = docs.withColumn("text", F.col("text").cast("string"))
    out = d.mapInArrow(partial(_masked, chosen=chosen), d.schema)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(
            F.length("text")).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
