import random

import pytest

WORDS = "the of tree river stone and night walks in a slow green field with old grey birds near water".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "", ",", "."]) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Rows with nulls in every column, empty, blank, long, repeated and near-copied texts, and repeated ids."""
    rng = random.Random(7)
    base = [prose(rng, rng.randint(1, 120)) for _ in range(30)]
    texts = base + [base[0], base[1] + " end", base[2], "", "  \n\t ", "x", prose(rng, 9000), "Ünïcode ß — 漢字 🙂 " * 30]
    texts += ["\n".join(base[3:6]), base[4] + "\n\n" + base[5]]
    rows = [(i, t, "en", f"src{i % 3}", len(t)) for i, t in enumerate(texts)]
    rows += [rows[5], rows[5], (6, "other text of id six", "en", "src0", 20)]
    rows += [(None, base[7], "en", "src1", 1), (None, None, None, None, None), (900, None, None, None, None)]
    rows += [(901, base[8], None, None, None)]
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
