"""Rows that every operator must take, and plain versions of what it computes."""

from __future__ import annotations

import random
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")

EDGES = [
    (1, None),
    (2, ""),
    (3, " \n\t\x0b \r"),
    (4, "word"),
    (5, "word"),
    (5, "word"),
    (None, "word"),
    (None, None),
    (6, "one two three four five six seven eight nine ten eleven"),
    (7, "One TWO three four five six seven eight nine ten ELEVEN"),
    (8, "same line here\n" * 40),
    (9, "a b c d e " * 3000),
    (10, "x" * 30_000),
    (11, "Größe 日本語 İstanbul 😀 é à ñ next\x85 line"),
    (12, "<|endoftext|> mail me@example.com, +1 (555) 123-4567; 4111 1111 1111 1111 10.0.0.1"),
    (13, "It's we'll  don't   #*$%&|<> ### $$$"),
    (14, "\0 null byte \0"),
]
#: Names that operators use inside, to clash with.
CLASHES = ["kept", "digest", "uid", "token", "doc", "hash", "n", "text_sha256", "words", "lines", "n_words", "spans", "terms", "id"]


def frame(spark, rows, clash: bool = False):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    if clash:
        from pyspark.sql import functions as F

        df = df.select("*", F.lit("en").alias("lang"), *[F.lit("?").alias(c) for c in CLASHES])
    return df


def sorted_rows(df, *names):
    return sorted((tuple(r) for r in df.select(*(names or df.columns)).collect()), key=repr)


def shingles(text) -> frozenset:
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4))


def components(rows) -> list[tuple]:
    """(doc_id, shingles, component id) per row, by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= 80 * (len(a) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    least: dict[int, int] = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return [
        (doc_id, len(sets[i]), least.get(root(i)) if sets[i] else doc_id) for i, (doc_id, _) in enumerate(rows)
    ]


def near_copies(seed: int, n_bases: int = 6, copies: int = 25) -> list[tuple[int, str]]:
    """Families of texts with more and more words changed, chains of edits, and shared passages."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6)))
    passage = [word() for _ in range(60)]
    texts = []
    for b in range(n_bases):
        base = [word() for _ in range(rng.choice([6, 30, 120, 300]))]
        if b % 2:
            base[3:3] = passage
        chain = list(base)
        for c in range(copies):
            changed = list(base if c % 2 else chain)
            for _ in range(rng.randint(0, max(1, len(base) // 40))):
                changed[rng.randrange(len(changed))] = word()
            if not c % 2:
                chain = changed
            texts.append(" ".join(changed))
    rng.shuffle(texts)
    return list(enumerate(texts, 100))


def measures(text) -> tuple[int, ...]:
    """n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words."""
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
    covered = {k + i for k in range(len(words) - 4) for i in range(5) if windows[tuple(words[k : k + 5])] > 1}
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, len(lines), len(lines) - len(set(lines)), len(covered)
