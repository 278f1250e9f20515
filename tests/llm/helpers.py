"""Small corpora with the awkward cases, and plain versions of what the operators compute."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

# Names that the operators use inside; as extra columns they must not get in the way.
CLASHING = ("grp", "rest", "fp", "row", "mark", "text_key", "id_key", "chunk", "carried", "ranges", "size", "kept")


def prose(rng: random.Random, words: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}x{rng.randrange(7)}" for _ in range(words))


def corpus(seed: int = 5) -> list[tuple]:
    """Copies, near copies, shared passages, nulls, empty and long texts, repeated rows and ids."""
    rng = random.Random(seed)
    passage = prose(rng, 60)
    copied = prose(rng, 80)
    texts = [
        None,
        "",
        " \t\n",
        None,
        "a",
        "Ä ö\nü " * 3,
        "word",
        "!?",
        "x" * 900,
        "ab" * 700,
        copied,
        copied.replace(" ", "\n", 3).replace(" ", "  ", 2),
        copied,
        copied + " tail",
        passage,
        f"{prose(rng, 50)} {passage} {prose(rng, 50)}",
        f"{prose(rng, 90)} {passage}",
        f"{passage} é{passage}",
        prose(rng, 6_000, 5_000),
        "<|endoftext|> " + prose(rng, 30) + "\n\n" + prose(rng, 30),
    ] + [prose(rng, rng.randrange(1, 300), 3_000) for _ in range(30)]
    rows = [(i * 3, t, rng.choice(["en", "de"]), "hot" if i % 3 else "cold", len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[10], rows[10], (None, copied, None, None, None), (None, "alone here", None, None, None), (0, "same id, other text", None, None, 3)]
    return rows


def frame(spark, rows, clashing: bool = False, schema: str = SCHEMA):
    df = spark.createDataFrame(rows, schema).repartition(3)
    if clashing:
        for name in CLASHING:
            df = df.selectExpr("*", f"'extra' AS `{name}`")
    return df


def result(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)
