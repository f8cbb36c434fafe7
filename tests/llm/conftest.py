import random

import pytest


@pytest.fixture
def docs(spark):
    """Builds documents with a clashing and an odd extra column."""

    def build(rows):
        full = [(i, t, "n", 1.5, None) for i, t in rows]
        return spark.createDataFrame(full, "doc_id long, text string, n_lines string, score double, component_id string")

    return build


@pytest.fixture
def rng():
    return random.Random(11)


def vocabulary(rng, size=300):
    return ["".join(rng.choice("abcdeéßñ") for _ in range(rng.randint(1, 7))) for _ in range(size)]
