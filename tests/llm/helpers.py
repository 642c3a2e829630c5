"""Small tables with the cases every operator must bear, and plain versions to compare with."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sample_texts(seed: int = 5, many: int = 60) -> list[str | None]:
    """Random prose with near copies, exact copies, empty and null texts and one long text."""
    rng = random.Random(seed)
    vocabulary = [a + b for a in ("ba", "ko", "ri", "Tu", "né", "so") for b in ("lan", "mi", "po", "zer", "ta")]

    def line(n: int) -> str:
        return " ".join(rng.choice(vocabulary) for _ in range(n)) + "."

    texts: list[str | None] = ["\n".join(line(rng.randint(3, 14)) for _ in range(rng.randint(1, 6))) for _ in range(many)]
    for i in range(0, many // 3, 2):
        words = texts[i].split(" ")
        for _ in range(max(1, len(words) // 25)):
            words[rng.randrange(len(words))] = "changed"
        texts.append(" ".join(words))
    texts += [texts[0], texts[0], None, None, "", "", "\n \n", "word", " \n".join(line(12) for _ in range(300)), "x" * 5000]
    return texts


def table(spark, texts):
    rows = [(i * 7, t, "en" if i % 2 else None, "s", None) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def jaccard(a: set, b: set) -> float:
    return len(a & b) / len(a | b) if a | b else 0.0
