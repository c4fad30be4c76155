import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))
ROOT = str(Path(__file__).resolve().parents[2])
os.environ["PYTHONPATH"] = f"{ROOT}:{Path(__file__).resolve().parent}:{os.environ.get('PYTHONPATH', '')}"

LONG = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi " * 3


def odd_rows():
    """Nulls, empty and blank texts, ties, repeated rows, near copies, shared passages, a long text, letters of any kind."""
    words = [f"w{n}" for n in range(60)]
    near = [" ".join(words[:k] + [f"x{k}"] + words[k + 1:]) for k in range(0, 60, 12)]
    passage = "A shared passage of text, long enough to be found twice: é, ñ, ü and 漢字 are in it. "
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "one two"), (5, "one two"), (6, "ONE  Two"), (7, " ".join(words))]
    rows += [(10 + k, t) for k, t in enumerate(near)]
    rows += [(20, LONG), (21, LONG + "tail"), (22, "head " + LONG), (23, LONG), (24, " " + passage + "own words here"),
             (25, "something else. " + passage), (26, "x" * 120), (27, "x" * 80 + "y"), (28, (LONG + passage) * 40),
             (29, "a\u0085b\x1cc <|startoftext|> it's, İ. 12.5"), (30, "漢字" * 40), (31, "字" + "漢字" * 30), (7, " ".join(words))]
    return rows


@pytest.fixture(scope="session")
def rows():
    return odd_rows()


@pytest.fixture(scope="session")
def docs(spark, rows):
    """The rows with columns whose names operators use inside."""
    extra = [(i, t, "a", 1, "b") for i, t in rows]
    return spark.createDataFrame(extra, "doc_id long, text string, key string, n int, node string").repartition(4)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], "doc_id long, text string, source string, url string, page_id long, html string")
