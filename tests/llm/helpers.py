"""Rows with every edge case, and the plain rules the operators are held against."""

from __future__ import annotations

import random
import re

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
# Names operators use for their own columns; as extra columns they must not disturb.
CLASHES = "size, key, copy, words, position, node, root, digest, row, piece, place, kept, score, taken, bit".split(", ")

BASE = " ".join(f"w{i % 37}x{i}" for i in range(160))


def near(text: str, changes: int) -> str:
    words = text.split()
    for i in range(changes):
        words[7 * i + 3] = f"changed{i}"
    return " ".join(words)


def documents(spark, extra: bool = True):
    """Null and empty texts, ids and sources, repeated rows, ties, copies, a very long text."""
    rng = random.Random(4)
    vocabulary = [f"word{i}" for i in range(400)]
    prose = [" ".join(rng.choices(vocabulary, k=rng.randint(60, 300))) for _ in range(40)]
    long = " ".join(rng.choices(vocabulary, k=60_000))
    texts = [
        None, "", " \n\t ", "one", "two words", "a b c d", "a b c d", "A B C D", "a b c d e", BASE, BASE, BASE.upper(),
        near(BASE, 2), near(BASE, 3), BASE.replace(" ", "  \n", 5), long, "x" * 30_000, "é" * 500 + " ß", "\x0b\x0c\r",
        "mail a.b@c.example.org, +1 (555) 123-4567, 10.0.0.1, 4111 1111 1111 1111",
        "Licensed under CC BY 4.0. All rights reserved.", "<|endoftext|> a b c", *prose, prose[0], prose[1],
    ]
    rows = [
        (i if i != 21 else None, text, ("en", "fr", None)[i % 3], (None, "s1", "s2", "", "é")[i % 5], len(text or ""))
        for i, text in enumerate(texts)
    ]
    rows += [rows[9], rows[9], rows[0], rows[21], (12, BASE, "en", "s1", 1)]
    frame = spark.createDataFrame(rows, DOCUMENTS)
    if extra:
        for name in CLASHES:
            frame = frame.selectExpr("*", f"'clash' AS {name}")
    return frame


def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)


def lower_ascii(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain(frame, *columns):
    """Rows as sorted tuples, nulls first."""
    rows = [tuple(row[name] for name in columns) for row in frame.collect()]
    return sorted(rows, key=lambda row: tuple((v is not None, v) for v in row))
