"""Small tables and brute-force counterparts for the tests of tallyhouse.llm."""

from __future__ import annotations

import random
from collections import Counter
from itertools import combinations

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, words: int, vocabulary: int = 400) -> str:
    rng = random.Random(seed)
    known = ["".join(rng.choice("aeinorstl") for _ in range(rng.randint(2, 9)))
             for _ in range(vocabulary)]
    out = []
    for i in range(words):
        out.append(rng.choice(known) + rng.choice(["", "", "", ",", "."]))
        out.append("\n" if i % 11 == 10 else " ")
    return "".join(out).strip()


def edited(text: str, seed: int, changes: int) -> str:
    rng = random.Random(seed)
    words = text.split(" ")
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
    return " ".join(words)


def odd_texts() -> list[str | None]:
    """Nulls, blanks, one word, very long, other scripts, shared passages and copies."""
    passage = prose(900, 60)
    base = prose(901, 150)
    return [
        None,
        "",
        " \n\t ",
        "one",
        "a b c d",
        "*** !!!",
        "12 34",
        "日本語 のテキスト こんにちは",
        base,
        base,
        *[edited(base, i, 2) for i in range(5)],
        f"{prose(902, 50)} {passage} {prose(903, 40)}",
        f"{passage}\n{prose(904, 90)}",
        f"{prose(905, 10)} {passage} {passage}",
        prose(906, 30_000),
        "same same " * 200,
    ]


def rows(texts) -> list[tuple]:
    langs = ["en", None, "fr"]
    return [(i, t, langs[i % 3], "s", None if t is None else len(t)) for i, t in enumerate(texts)]


def odd_documents(spark, **extra):
    """``odd_texts`` with a repeated row, rows of equal id, and null ids."""
    table = rows(odd_texts())
    table += [table[8], (3, "another text of the same id", "en", "s", 27), (None, "no id", "en", None, 5)]
    table += [(None, None, None, None, None)]
    df = spark.createDataFrame(table, DOCUMENTS).repartition(3)
    from pyspark.sql import functions as F

    for name, value in extra.items():
        df = df.withColumn(name, F.lit(value))
    return df


def shingle_set(text: str | None) -> frozenset:
    words = (text or "").split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def jaccard_classes(docs: list[tuple[int, str | None]], threshold: float = 0.8):
    """{place: (first place of the class, links)} over all pairs that share a shingle."""
    sets = [shingle_set(t) for _, t in docs]
    common: Counter = Counter()
    where: dict = {}
    for i, s in enumerate(sets):
        for x in s:
            where.setdefault(x, []).append(i)
    for places in where.values():
        common.update(combinations(places, 2))
    top = list(range(len(docs)))

    def find(i: int) -> int:
        while top[i] != i:
            i = top[i]
        return i

    links: Counter = Counter()
    for (a, b), n in common.items():
        if n >= threshold * (len(sets[a]) + len(sets[b]) - n) - 1e-9:
            links[a] += 1
            links[b] += 1
            x, y = sorted((find(a), find(b)))
            top[y] = x
    return {i: (find(i), links[i]) for i in range(len(docs))}


def without_repeats(texts: list[str | None], window: int = 35) -> list[tuple[int, int, str]]:
    """(n_words, n_removed, kept text) of each text."""
    words = [(t or "").encode().split() for t in texts]
    seen = Counter(
        tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1)
    )
    out = []
    for w in words:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        kept = [x for x, g in zip(w, gone, strict=True) if not g]
        out.append((len(w), len(w) - len(kept), b" ".join(kept).decode()))
    return out
