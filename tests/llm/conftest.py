"""Rows that every operator must cope with."""

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rk long, key string, fp long, count long, slot long"

SYLLABLES = "th er on an re he in ed nd ha at en es of or nt ea ti to it".split()


def prose(seed: int, words: int, vocabulary: int = 400) -> str:
    """Invented prose with line ends; small vocabularies make words and sequences meet."""
    rng = random.Random(seed)
    known = ["".join(random.Random(f"{seed % 3}-{i}").choices(SYLLABLES, k=1 + i % 3)) for i in range(vocabulary)]
    return "".join(rng.choice(known) + ("\n" if rng.random() < 0.07 else " ") for _ in range(words)).strip()


def awkward_rows() -> list[tuple]:
    base = prose(1, 300)
    words = base.split(" ")
    near = " ".join([*words[:100], "changed", *words[101:]])
    shared = prose(7, 60, 2000)
    texts = [
        (1, base),
        (2, base),  # a copy
        (3, near),  # a near copy
        (4, None),
        (5, ""),
        (6, " \t\n\r\x0b\x0c "),
        (7, "one"),
        (8, "The THE the The the the The the the the " * 30),
        (9, prose(2, 30) + "\n" + shared + "\n" + prose(3, 40)),
        (10, shared + " " + prose(4, 25)),
        (11, "no break space café 日本語 ΣΑΣ <|endoftext|> it's 123 \x1c\x1d end"),
        (12, prose(5, 6000)),  # long
        (13, shared),
        (13, prose(6, 50)),  # one identifier, two texts
        (14, prose(8, 45)),
        (14, prose(8, 45)),  # a repeated row
        (None, shared + " " + shared),
        (None, prose(9, 30)),
        (-5, prose(2, 30)),
        (16, "a\n\n\na\nb\n a \nb"),
    ]
    return [(i, t, "en" if n % 3 else None, f"s{n % 4}" if n % 5 else None, n, n, "x", n, n, n) for n, (i, t) in enumerate(texts)]


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA).repartition(3)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
