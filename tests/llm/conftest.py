import random

import pytest

LETTERS = "the of and to in that for with was on are be this er on an re he st en".split()


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice(LETTERS) for _ in range(r.randint(1, 3))) for _ in range(n))


#: Texts of every awkward kind: null, empty, spaces, no letter, short, long, copies, near copies, repeated rows.
BASE = prose(1, 80)
HARD = [
    (0, None), (1, ""), (2, " \n\t "), (3, "12 34 !?"), (4, "One two"), (5, BASE), (6, BASE), (7, BASE + " and one more"),
    (8, prose(2, 30_000)), (9, "Élève Ω σς 漢字 <|endoftext|> \x1c x"), (10, prose(3, 25)), (10, prose(3, 25)), (None, "no id " + prose(4, 30)),
    (11, "A B C D E F"), (12, "a b c d e f"),
]


@pytest.fixture
def hard(spark):
    """Documents of every awkward kind, with further columns whose names the operators use themselves."""
    rows = [(d, t, "x", 7, "k", -1.0) for d, t in HARD]
    return spark.createDataFrame(rows, "doc_id long, text string, row string, part int, key string, score double")


@pytest.fixture
def nothing(hard):
    return hard.where("false")
