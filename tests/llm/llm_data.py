"""Small tables with all the odd cases the operators define."""

from __future__ import annotations

import random

WORDS = "the of and to in that is was for on with as by at from this have are not".split()
DOCS = (
    "doc_id long, text string, lang string, source string, n_chars int,"
    # Names the operators use inside; they have to stay out of the way.
    " fp long, fingerprint string, component_id long, words int, ids string, length int,"
    " score double, kept boolean, spans string, piece int, bucket int, __row int"
)
EXTRA = (7, "f", 8, 9, "ids", 10, 0.5, True, "s", 11, 12, 13)


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(
        rng.choice(WORDS) if rng.random() < 0.5 else "".join(rng.choices("aeioulnrst", k=6))
        for _ in range(n)
    )


def texts() -> list[tuple[int | None, str | None, str | None]]:
    """(doc_id, text, lang), rows repeated and keys missing among them."""
    long = prose(1, 30_000)
    rows: list[tuple[int | None, str | None, str | None]] = [
        (1, None, "en"),
        (2, "", "en"),
        (3, " \t\n\x0b\x0c\r ", None),
        (4, prose(4, 200), "en"),
        (5, prose(4, 200), "en"),
        (6, prose(4, 200) + " tail", "en"),
        (7, "x" * 70_000, "en"),
        (8, long, "en"),
        (9, "Größe naïve Ünïcode ß 𝔘𝔫𝔦 <|endoftext|> 　wide " * 20, "de"),
        (10, "short", "de"),
        (None, prose(11, 50), "en"),
        (12, prose(12, 60), None),
        (12, prose(12, 60), None),
        (13, "12345 67890 !!! ### ...", "de"),
        (14, prose(14, 2047), "fr"),
    ]
    return rows


def documents(spark, rows=None):
    rows = texts() if rows is None else rows
    return spark.createDataFrame(
        [(i, t, lang, "s", None if t is None else len(t), *EXTRA) for i, t, lang in rows], DOCS
    )
