import math
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import quality, text


@pytest.fixture
def labels(spark):
    return lambda rows: spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def texts(rng, n):
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(400)]
    return [(i, " ".join(rng.choice(words) + ("!!" if i % 3 == 0 else "") for _ in range(rng.randint(1, 80)))) for i in range(n)]


def test_held_out_accuracy(docs, labels, rng):
    rows = texts(rng, 900)
    frame = docs(rows)
    model = quality.train(frame, labels([(i, int(i % 3 != 0), 0) for i, _ in rows] + [(1, None, 0), (2, 7, 0), (None, 1, 0), (99999, 1, 0)]))
    scored = quality.score_texts(frame, model).withColumn("held", quality.held_out()).collect()
    held = [r for r in scored if r["held"]]
    assert {r["doc_id"] for r in held} == {i for i, _ in rows if zlib.crc32(str(i).encode()) % 4 == 2}
    assert sum((r["_score"] >= quality.THRESHOLD) == (r["doc_id"] % 3 != 0) for r in held) >= 0.98 * len(held)


def test_held_out_labels_do_not_matter(docs, labels, rng):
    rows = texts(rng, 200)
    told = lambda flip: labels([(i, int(i % 3 != 0) ^ (flip and zlib.crc32(str(i).encode()) % 4 == 2), 0) for i, _ in rows])
    assert (quality.train(docs(rows), told(False)).weights == quality.train(docs(rows), told(True)).weights).all()


def test_one_class_empty_texts_and_empty_tables(docs, labels):
    frame = docs([(1, None), (2, ""), (None, "x " * 50000), (4, "x"), (4, "x")])
    model = quality.train(frame, labels([(1, 1, 0)]))
    assert not model.trained
    assert [r["_score"] for r in quality.score_texts(frame.withColumn("_score", F.lit(9)), model).collect()] == [0.5] * 5
    assert quality.score_texts(docs([]), model).collect() == []


def scalar_model(rows, epochs, alpha, beta, l1, l2):
    """Follow-the-regularised-leader, one weight after the other, on dictionaries."""
    z, n = {}, {}

    def weight(k):
        zk, nk = z.get(k, 0.0), n.get(k, 0.0)
        return 0.0 if abs(zk) <= l1 else ((1 if zk > 0 else -1) * l1 - zk) / ((beta + math.sqrt(nk)) / alpha + l2)

    for _ in range(epochs):
        for label, x in rows:
            w = [weight(k) for k, _ in x]
            p = 1 / (1 + math.exp(-sum(a * v for a, (_, v) in zip(w, x))))
            for (k, v), wk in zip(x, w):
                g = (p - label) * v
                sigma = (math.sqrt(n.get(k, 0.0) + g * g) - math.sqrt(n.get(k, 0.0))) / alpha
                z[k] = z.get(k, 0.0) + g - sigma * wk
                n[k] = n.get(k, 0.0) + g * g
    return weight


def test_weights_equal_a_scalar_model(rng):
    rows = []
    for _ in range(60):
        buckets = sorted(rng.sample(range(2, 40), rng.randint(0, 12)))
        rows.append((rng.randint(0, 1), buckets, [rng.randint(1, 4) for _ in buckets]))
    epoch = lambda: ((y, np.array(b, np.int32), np.array(t, np.int32)) for y, b, t in rows)
    model = quality.fit(epoch)
    plain = [(y, [(k, c / math.sqrt(max(1, sum(t)))) for k, c in zip(b, t)] + [(0, 1.0)]) for y, b, t in rows]
    weight = scalar_model(plain, quality.EPOCHS, quality.ALPHA, quality.BETA, quality.L1, quality.L2)
    assert np.allclose(model.weights[:40], [weight(k) for k in range(40)], atol=1e-6) and not model.weights[40:].any()


def test_scores_are_sparse_dot_products(rng):
    weights = np.random.default_rng(1).normal(size=1 << quality.BITS).astype(np.float32)
    column = pa.array(["", None, "one two two, three", "x " * 3000])
    data, bounds = text.utf8(column)
    got = quality.scores(quality.Model(weights, True), column)
    for k in range(len(column)):
        buckets, _ = quality.features(*text.words(data, bounds[k : k + 2], text.MARKS))
        total = sum(float(weights[b]) for b in buckets.tolist()) / math.sqrt(max(1, len(buckets))) + float(weights[0])
        assert abs(got[k] - 1 / (1 + math.exp(-max(-35, min(35, total))))) < 1e-5


def test_a_text_column_travels_once(docs):
    scored = quality.score_texts(docs([(1, "x")]), quality.Model(np.zeros(1 << quality.BITS, np.float32), True))
    assert "_text" not in scored._jdf.queryExecution().analyzed().toString()
