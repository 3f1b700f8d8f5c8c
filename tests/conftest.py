import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from scrivel.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session("8")


@pytest.fixture(scope="session")
def evaluate(spark):
    """Value of a column expression over one text."""

    def run(step, text):
        frame = spark.createDataFrame([(text,)], "text string")
        return frame.select(step(frame["text"]).alias("out")).first()["out"]

    return run


@pytest.fixture(scope="session")
def evaluate_all(spark):
    """Values of a column expression over many texts, in order."""

    def run(step, texts):
        rows = list(enumerate(texts))
        frame = spark.createDataFrame(rows, "i int, text string")
        out = frame.select("i", step(frame["text"]).alias("out")).collect()
        return [r["out"] for r in sorted(out, key=lambda r: r["i"])]

    return run
