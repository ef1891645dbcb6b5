"""Fixtures and brute-force helpers of the subpackage's tests."""

from __future__ import annotations

import random
from collections import Counter

from tests.oracle_harness import _norm

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars int, h long, w string, first string, block int"


def words(text: str | None, lower: bool = False) -> list[bytes]:
    data = (text or "").encode()
    return (data.translate(LOWER) if lower else data).split()


def prose(rng: random.Random, n: int) -> str:
    return " ".join(f"w{rng.randrange(400)}" for _ in range(n))


def edge_texts() -> list[str | None]:
    """Nulls, empty and very long texts, ties, near copies, chains, shared passages."""
    rng = random.Random(11)
    base = prose(rng, 150).split()
    chain = [base]
    for _ in range(6):                      # each a small step from the one before
        step = list(chain[-1])
        for at in rng.sample(range(len(step)), 2):
            step[at] = f"x{rng.randrange(10**6)}"
        chain.append(step)
    passage = prose(rng, 60)
    out: list[str | None] = [None, "", "   \n\t ", "one", "One", "a b c d", "a b c d e", "A B C D E"]
    out += [" ".join(c) for c in chain] + [" ".join(base), "\n".join(base)]
    out += [prose(rng, 80) + "\n" + passage + " " + prose(rng, 20) for _ in range(6)]
    out += ["same line here\n" * 40, "word " * 200, prose(rng, 20_000), "z" * 50_000, "é" * 100 + " ü"]
    out += [f"Mail joe.{i}@example.com or +1 (555) 010-999{i}, host 10.0.0.{i}, card 4111 1111 1111 1111."
            for i in range(3)]
    out += ["Released under the MIT License. CC-BY-NC cc by nc", "apache license version 2", "under the mit"]
    return out


def edge_docs(spark):
    """Edge rows with repeated rows and extra columns whose names the operators use inside."""
    texts = edge_texts()
    rows = [(i, t, "en", "a" if i % 3 else None, len(t or ""), i, "w", "f", 1) for i, t in enumerate(texts)]
    rows += [rows[8], rows[20]]
    return spark.createDataFrame(rows, SCHEMA)


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def compare(spark, con, entry, sf: str) -> None:
    """A query's rows equal its SQL's, columns by name."""
    got = entry.fn(spark, sf)
    rel = con.sql(entry.oracle)
    names = sorted(got.columns)
    assert names == sorted(rel.columns)
    spark_rows = Counter(tuple(_norm(r[c]) for c in names) for r in got.collect())
    at = [rel.columns.index(c) for c in names]
    assert spark_rows == Counter(tuple(_norm(r[i]) for i in at) for r in rel.fetchall())
