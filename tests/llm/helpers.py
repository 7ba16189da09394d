"""Small tables for the operator tests."""

from __future__ import annotations

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, *extra):
    """Documents with ids from 0; a tuple gives (doc_id, text) or (doc_id, text, source)."""
    rows = []
    for i, item in enumerate(texts):
        doc_id, text, *source = item if isinstance(item, tuple) else (i, item)
        source = source[0] if source else "src0"
        rows.append((doc_id, text, "en", source, None if text is None else len(text)))
    df = spark.createDataFrame(rows, DOCS)
    return df.selectExpr("*", *extra)


def words(seed: int, n: int) -> str:
    """`n` invented words, the same for the same seed."""
    import random

    draw = random.Random(seed)
    return " ".join("".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=draw.randint(2, 9))) for _ in range(n))


ODD_TEXTS = [None, "", " \t\n ", "one", "one\ntwo\n\n", "\x00 é ü 漢字 😀", "a" * 3000, "x y " * 4000]
