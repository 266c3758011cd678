import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

from cases import made, prose  # noqa: E402


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls, empty and blank texts, very long ones, copies, near copies, rows that repeat, ties of ids."""
    base = prose(1)
    words = base.split(" ")
    near = " ".join(["changed", *words[1:]])
    long = prose(2, words=30_000, vocabulary=5000)
    return [
        (0, base),
        (1, base),
        (2, near),
        (3, None),
        (4, ""),
        (5, " \n\t \n"),
        (6, long),
        (7, prose(3) + "\n" + "\n".join(base.split("\n")[3:9]) + "\n" + prose(4)),
        (8, "one"),
        (9, "one"),
        (9, "one"),
        (10, "same id, first text\nand more of it\nand more"),
        (10, "same id, second text\nand more of it\nand more"),
        (None, "no id at all " * 30),
        (None, None),
        (None, base),
        (11, "from " * 500),
        (12, "Ünï çödé   text\x1c with\x0bodd\fspaces \U0001f600 " * 20),
        (13, prose(2, words=30_000, vocabulary=5000)[5000:40_000]),
        (14, "x"),
        (15, "A B c\n\n\nA B c\n" * 4),
    ]


@pytest.fixture(scope="session")
def edge(spark, edge_rows):
    return made(spark, edge_rows)


@pytest.fixture(scope="session")
def empty(spark):
    return made(spark, [])
