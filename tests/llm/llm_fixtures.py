import random

import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# names that operators use inside
CLASHES = ["id", "node", "n", "kept", "score", "label", "cell", "bucket", "tokens", "host", "size", "word", "component_id", "key", "page"]


def prose(seed, words=120, vocabulary=5000):
    draw = random.Random(seed)
    return " ".join(f"w{draw.randrange(vocabulary)}x" for _ in range(words))


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls everywhere, empty, blank and very long texts, repeated rows, ties, clashing columns."""
    long_text = prose(1, 60_000)
    rows = [
        (1, prose(10), "en", "src0", 1), (2, prose(10), "en", "src0", 1), (2, prose(10), "en", "src0", 1),
        (3, None, None, None, None), (4, "", "", "", 0), (5, " \n\t ", "en", "src1", 4), (6, long_text, "en", "src2", 1),
        (7, long_text + " more", "de", "src2", 1), (None, prose(10), "en", "src0", 1), (None, None, None, None, None),
        (8, "Short.", "fr", "src3", 6), (9, "éà 漢字   😀", "zz", "src4", 5), (10, prose(11), None, "src0", None),
    ]
    frame = spark.createDataFrame(rows, SCHEMA)
    return frame.select("*", *(F.lit(str(k)).alias(name) for k, name in enumerate(CLASHES)))


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.limit(0)


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(k, k % 2, (k + 1) % 2) for k in range(1, 11)] + [(2, 1, 1), (None, 1, 1), (3, None, None), (99, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
