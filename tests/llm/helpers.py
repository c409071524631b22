"""Small corpora with the awkward rows that every operator must take."""

from __future__ import annotations

import random

WORDS = [a + b for a in "ka lo mi ne su ta ve zo".split() for b in "ra lin mo tes ush vak".split()]
#: Column names that operators use inside.
CLASHES = "row n key label node doc text_ ids bucket host mentions row_key place".split()
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(
    f"`{c}` string" for c in CLASHES
)


def sentence(draw: random.Random, n: int) -> str:
    return " ".join(draw.choice(WORDS) + draw.choice(["", "", "", ",", "."]) for _ in range(n))


def corpus(seed: int = 3) -> list[tuple]:
    """(doc_id, text, source): plain, empty, null, long, copied, nearly copied and repeated rows."""
    draw = random.Random(seed)
    rows = [(k, sentence(draw, draw.randint(12, 90)), f"s{k % 4}") for k in range(40)]
    base = sentence(draw, 120)
    near = base.split()
    for k in range(40, 52):
        words = list(near)
        for _ in range(k - 40):
            words[draw.randrange(len(words))] = draw.choice(WORDS)
        rows.append((k, " ".join(words), "hot"))
    rows += [(k, base.upper() if k % 2 else base, "hot") for k in range(52, 60)]
    shared = sentence(draw, 30)
    rows += [(k, f"{sentence(draw, 9)}\n{shared}\n{sentence(draw, 9)}", "s1") for k in range(60, 66)]
    rows += [
        (70, None, "s0"), (71, "", None), (72, " \t\n ", "s0"), (73, "x", "s1"), (74, "x", "s1"),
        (75, "Ünï çødé … 日本 İ <|endoftext|> end", "s2"), (76, "=" * 400, "s2"),
        (77, sentence(draw, 4000), "s3"), (78, "a b c " * 300, "s3"), (None, base, "s0"),
        (None, None, None),
    ]
    return rows + rows[5:8] + rows[-2:]


def frame(spark, rows: list[tuple]):
    full = [(d, t, "en", s, len(t or ""), *["clash"] * len(CLASHES)) for d, t, s in rows]
    return spark.createDataFrame(full, SCHEMA)


def plain(rows) -> list[tuple]:
    return sorted((tuple(r) for r in rows), key=repr)
