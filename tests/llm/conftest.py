import random

import pytest

SF = "/root/testdata/sf0.001"

#: Columns whose names the operators use inside.
EXTRA = "row string, digest string, n int, keys string, print string, node int, size int, gone string, score string, spans string, matches string"


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, columns with clashing names."""
    rnd = random.Random(5)
    long = " ".join("".join(rnd.choice("aeiounrst") for _ in range(rnd.randint(2, 9))) for _ in range(60_000))
    base = "The quick brown fox jumps over the lazy dog near the old river bank while seven geese fly past the mill at dawn"
    rows = [
        (1, "same text here", "en"),
        (2, "same text here", "en"),
        (2, "same text here", "en"),
        (3, None, "en"),
        (4, "", None),
        (None, "same text here", None),
        (None, None, None),
        (5, long, "en"),
        (6, long + " tail", "fr"),
        (7, base, "en"),
        (8, base + " today", "en"),
        (9, "a b", "de"),
        (10, "A  B\n", "de"),
        (11, "12 34 !!", None),
        (12, " \t\n", "en"),
        (13, "Straße über é 漢字 <|endoftext|> it's  x▁y\u0085z", "de"),
    ]
    extra = ("x", "y", 1, "z", "p", 2, 3, "g", "s", "t", "m")
    return spark.createDataFrame([(*r, *extra) for r in rows], f"doc_id bigint, text string, lang string, {EXTRA}")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], f"doc_id bigint, text string, lang string, {EXTRA}")


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
