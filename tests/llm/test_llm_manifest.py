import hashlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm import manifest

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, pos string, g int, n string, row int, path string"
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(nodes):
    """Levels of runs above the nodes, and the root."""
    levels = []
    while len(nodes) > 1:
        runs = [nodes[i : i + 8] for i in range(0, len(nodes), 8)]
        levels.append(runs)
        nodes = [sha("".join(r)) for r in runs]
    return levels, nodes[0] if nodes else None


def steps(levels, at):
    for runs in levels:
        yield runs[at // 8], at % 8
        at //= 8


def model(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[2]].append((r[0] is not None, r[0] or 0, leaf_of(r[:5]), r))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda x: x[:3])
        trees[g] = climb([x[2] for x in groups[g]])
    above, root = climb([trees[g][1] for g in names])
    out = Counter()
    for place, g in enumerate(names):
        for at, (_, _, leaf, r) in enumerate(groups[g]):
            path = [*steps(trees[g][0], at), *steps(above, place)]
            proof = sha("".join(h for run, own in path for i, h in enumerate(run) if i != own))
            node = leaf_of((*r[:4], None if r[4] is None else r[4].translate(LOWER)))
            for run, own in path:
                node = sha("".join(run[:own] + [node] + run[own + 1 :]))
            out[(r[0], leaf, trees[g][1], root, proof, node)] += 1
    return out


@pytest.fixture
def build(spark):
    def run(rows):
        frame = spark.createDataFrame([(*r, "x", 1, "y", 2, "z") for r in rows], SCHEMA)
        lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
        claim = manifest.leaf_digest([F.col(c) for c in manifest.FIELDS[:-1]] + [lowered])
        built = manifest.merkle_manifest(frame, claim=claim)
        found = built.select(
            "doc_id", "leaf", "subroot", "root", manifest.proof_digest(F.col("path")).alias("proof"), manifest.fold(F.col("claim"), F.col("path")).alias("folded")
        )
        return Counter(tuple(r) for r in found.collect()), built

    return run


def test_manifest_equals_model(build, rng):
    ids = sorted({rng.randrange(-(1 << 62), 1 << 62) >> rng.randrange(62) for _ in range(300)} | set(range(150)))
    rng.shuffle(ids)
    langs = [None, "", "a", "B", "é", *[f"l{i}" for i in range(9)], "solo"]
    rows = [(i, rng.choice([None, "s", "ü"]), langs[min(k, 13) if k < 14 else rng.randrange(5)], k, rng.choice([None, "", "Ab" * k, "x"])) for k, i in enumerate(ids)]
    rows.append((7, "s", "solo", 1, "Only ONE"))
    found, _ = build(rows)
    assert found == model(rows)


def test_repeated_and_null_ids(build, rng):
    rows = [(rng.choice([None, 5, 64, 65, -3, 9]), None, rng.choice(["en", None]), None, rng.choice(["A", "b", None, "long " * 5000])) for _ in range(200)]
    rows += [(5, None, "en", None, "copy")] * 70 + [(i, "s", "en", 1, "t") for i in range(60, 70)]
    found, built = build(rows)
    assert found == model(rows)
    places = defaultdict(list)
    for r in built.select("subroot", "position").collect():
        places[r["subroot"]].append(r["position"])
    assert all(sorted(p) == list(range(len(p))) for p in places.values())


@pytest.mark.parametrize("rows", [[], [(1, "s", "en", 3, "One")], [(None,) * 5] * 2, [(i, "s", None, 3, "T") for i in range(8)], [(i, "s", "x", 3, "T") for i in range(9)]])
def test_small_tables(build, rows):
    assert build(rows)[0] == model(rows)


def test_claims_are_optional(spark):
    frame = spark.createDataFrame([(1, "s", "en", 2, "Hi"), (2, "s", "de", 2, "Ho")], "doc_id int, source string, lang string, n_chars long, text string")
    built = manifest.merkle_manifest(frame)
    assert built.where("claim IS NOT NULL").isEmpty() and built.schema["doc_id"].dataType.simpleString() == "int"
    assert built.where(manifest.fold(F.col("leaf"), F.col("path")) != F.col("root")).isEmpty()
