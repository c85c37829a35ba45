import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words_of(rng, n):
    syllables = ["an", "be", "ci", "do", "en", "fo", "gu", "hé", "ir", "jo"]
    return ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(n)]


def corpus(seed=1, n=120):
    """Prose with exact and near copies, a passage that many share, repeats, and the odd cases."""
    rng = random.Random(seed)
    passage = " ".join(words_of(rng, 70))
    rows = []
    for k in range(n):
        text = " ".join(words_of(rng, rng.choice([3, 30, 120, 400])))
        if k % 9 == 1:
            text = rows[rng.randrange(len(rows))][1]
        elif k % 9 == 2:
            parts = rows[rng.randrange(len(rows))][1].split(" ")
            parts[rng.randrange(len(parts))] = "zz"
            text = " ".join(parts)
        elif k % 9 == 3:
            text = f"{text}\n{passage} {text[:30]}"
        elif k % 9 == 4:
            text = "Ab Ab " * 150
        rows.append((k * 3, text))
    rows += [(1001, None), (1002, ""), (1003, " \n\t "), (1004, "one two"), (1005, "ONE two"), (1006, "été ñandú 漢字 \x00 <|endoftext|> İx ok's")]
    rows.append((1007, " ".join(words_of(rng, 40_000))))  # a very long text
    return rows


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    """Documents with extra columns named like what the operators use inside."""
    full = [(i, t, "en", "src", None if t is None else len(t)) for i, t in rows]
    frame = spark.createDataFrame(full, SCHEMA).repartition(3, "doc_id")
    return frame.selectExpr("*", "1 as unit", "2 as row", "'x' as member", "3 as start", "0 as label", "4 as rest", "5 as size", "true as training", "6 as hash")


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def twice(spark, rows):
    """Rows that repeat, share a doc_id with another text, or have no doc_id."""
    few = rows[:12]
    return spark.createDataFrame([(i, t) for i, t in [*few, *few[:3], (few[4][0], "another text under this id " * 12), (None, "no id " * 50), (None, None)]], "doc_id long, text string").repartition(2)
