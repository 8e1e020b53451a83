"""Small document tables with everything a table may hold, and plain Python to compare with."""

from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACE_WORD = re.compile("[^\x20\x09-\x0d]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def words(text):
    return WORD.findall((text or "").translate(FOLD))


def prose(seed, n, letters="abcdefg"):
    rng = random.Random(seed)
    return [("".join(rng.choice(letters) for _ in range(rng.randint(1, 7)))) for _ in range(n)]


def row(i, text, lang="en", source="s"):
    return (i, text, lang, source, len(text) if text is not None else None)


def odd_rows():
    """Null ids and texts, empty and blank texts, one very long text, ties and repeated rows."""
    long = " ".join(prose(1, 30_000))
    return [
        row(1, "The cat sat on the mat.\nThe cat sat."),
        row(1, "The cat sat on the mat.\nThe cat sat."),
        row(2, None),
        row(2, None, None),
        row(None, "Ünïcode 😀 words, 日本語 too\r\nand more"),
        row(None, None, None, None),
        row(3, ""),
        row(4, " \t\n\x0b\x0c\r "),
        row(5, "!!! ??? 123"),
        row(6, long),
        row(7, long + " end"),
        row(8, "a"),
        row(9, "a a a a a a a a a a a a a a a a a a a a"),
        row(-3, "The cat sat on the mat.\nThe cat sat."),
    ]


#: columns that clash with names the operators use themselves
EXTRA = "key string, node string, n_words int, score double, shard int, kept boolean, row int, Spans string, N_Hit int, Lang_Pred int, ids string, Decoded int, n_tokens string"


def with_extra(rows):
    return [(*r, "k", "n", 1, 0.5, 2, None, 3, "x", 4, 5, "i", 6, None) for r in rows]
