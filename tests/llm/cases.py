"""Small inputs for the operators: odd rows, copies, clashing columns."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long, id long, row string, key string, bucket int, digest string"
WORDS = [f"w{i}" for i in range(400)] + ["the", "of", "and", "naïve", "日本語", "Über", "x" * 300]


def prose(seed: int, n: int) -> str:
    rnd = random.Random(seed)
    return "".join(w + rnd.choice([" ", " ", " ", "  ", "\n", ".\n", "\t", ", "]) for w in rnd.choices(WORDS, k=n))


def changed(text: str, seed: int, n: int) -> str:
    rnd, words = random.Random(seed), text.split(" ")
    for _ in range(n):
        words[rnd.randrange(len(words))] = f"new{rnd.randrange(10**6)}"
    return " ".join(words)


def texts() -> list[str | None]:
    base, passage = prose(1, 300), prose(2, 60)
    out: list[str | None] = [None, "", "   \n\t", "one", "one", "one two three four", "a b c d e", "A B c d E", base, base, base.upper()]
    out += [changed(base, s, n) for s, n in ((1, 1), (2, 3), (3, 8), (4, 20), (5, 60))]
    near = prose(9, 120)
    out += [changed(near, s, 2) for s in range(12)]  # a chain of near copies
    out += [prose(20 + i, 80) + " " + passage + " " + prose(40 + i, 50) for i in range(5)]
    out += ["same line here\n" * 40, "again " * 500, prose(70, 9000), "y" * 50_000, "# * $ % " * 30, "\x1c\x85\u2003odd\u00a0space  <|endoftext|> it's we'll"]
    return out


def documents(spark, rows=None):
    rows = list(enumerate(texts())) if rows is None else rows
    made = [(i, t, ["en", "de", None][k % 3], None if k % 7 == 0 else f"src{k % 4}", None if t is None else len(t), 1, "r", "k", 2, "d")
            for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(made, DOCS)


def with_odd_ids(rows):
    """The rows, one of them twice, and two under a NULL id."""
    return [*rows, rows[8], (None, "one"), (None, prose(3, 90))]
