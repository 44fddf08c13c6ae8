"""Small documents with everything that may go wrong in them."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, ids int, counts string, row string"


def prose(seed: int, n: int, lang: str = "en") -> str:
    r = random.Random(seed)
    parts = {"en": ["th", "er", "on", "an", "re", "ing"], "fr": ["eau", "oi", "é", "que", "ai", "le"]}[lang]
    return " ".join("".join(r.choice(parts) for _ in range(r.randint(1, 4))) for _ in range(n)).capitalize() + "."


def rows():
    base = prose(1, 120)
    near = base.split()
    near[50] = "changed"
    passage = prose(77, 60)
    texts = [
        base, base, " ".join(near), None, "", "  \n\t ", "one two", "one two", "...", "日本語のテキスト" * 30,
        passage + "\n" + prose(5, 80), prose(6, 70) + "\n" + passage + "\n" + prose(7, 60),
        "a" * 5000, "word " * 3000, "x<|endoftext|>y ▁ \x00 é😀", prose(8, 9000), prose(9, 100, "fr"),
        prose(10, 100, "fr"), "$$$ ### " * 100, prose(11, 200),
    ]
    made = [(i, t, ["en", "fr", None][i % 3], "hot" if i % 3 else None, len(t or ""), 1, "c", "r")
            for i, t in enumerate(texts)]
    return [*made, made[0], (None, base, None, None, None, None, None, None)]


def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA)
