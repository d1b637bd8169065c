import random

import pytest

WORDS = [f"w{k}" for k in range(400)]


@pytest.fixture
def frame(spark):
    """Rows to a DataFrame in several partitions, with columns whose names clash."""

    def make(rows, schema):
        df = spark.createDataFrame(rows, schema).repartition(3)
        return df.selectExpr("*", *[f"'clash' as {c}" for c in CLASHING if c not in df.columns])

    return make


#: Names that operators use inside or return.
CLASHING = ["key", "id", "size", "n", "range", "shard", "row", "spans", "items", "digest", "bands", "host", "p", "block"]


@pytest.fixture
def prose():
    """A text of random words, the same for the same seed."""

    def make(seed, n):
        draw = random.Random(seed)
        return " ".join(draw.choice(WORDS) for _ in range(n))

    return make
