import hashlib
import math
import random
import shutil

import numpy as np
import pytest

from breachlens.llm import vector_codes
from breachlens.llm.queries import queries

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute_force(rows, entries=256, rounds=4, parts=4):
    """All parts against all entries in every round, in plain integers."""
    kept = [(i, [math.floor(1024 * float(c)) for c in v], label) for i, v, label in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    kept.sort(key=lambda r: r[0])
    width = len(kept[0][1]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v, _ in kept]
    books = [[list(x[p]) for x in cut[:entries]] for p in range(parts)]

    def assign():
        return [[min((sum((a - b) ** 2 for a, b in zip(x[p], e)), i) for i, e in enumerate(books[p])) for p in range(parts)] for x in cut]

    for _ in range(rounds):
        found = assign()
        for p in range(parts):
            for i in range(len(books[p])):
                mine = [x[p] for x, f in zip(cut, found) if f[p][1] == i]
                if mine:
                    books[p][i] = [sum(c) // len(mine) for c in zip(*mine)]
    found = assign()
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    errors = [sum(d for d, _ in f) for f in found]
    of_label = {}
    for (_, _, label), e in zip(kept, errors):
        of_label[label] = of_label.get(label, 0) + e
    return [(i, "".join(f"{e:02x}" for _, e in f), err, of_label[label], digest) for (i, _, label), f, err in zip(kept, found, errors)]


def random_rows(n, seed, width=8, spread=0.02):
    """Few distinct values, so that distances tie and vectors repeat."""
    rng = random.Random(seed)
    values = [rng.randint(-20, 20) * spread for _ in range(6)]
    return [(3 * i, [rng.choice(values) for _ in range(width)], rng.choice([None, 1, 2])) for i in range(n)]


def run(spark, folder_of, rows, schema=SCHEMA):
    folder = folder_of(embeddings=spark.createDataFrame(rows, schema).repartition(3))
    return [tuple(r) for r in queries()["op13_vector_codes"](spark, folder).collect()], folder


@pytest.mark.parametrize("entries, seed", [(5, 1), (16, 2), (200, 3)])
def test_equals_brute_force(spark, docs, folder_of, monkeypatch, entries, seed):
    monkeypatch.setattr(vector_codes, "ENTRIES", entries)
    monkeypatch.setattr(vector_codes, "BATCH", 7)
    rows = random_rows(90, seed)
    rows += [(1, None, 1), (4, [], 1), (7, [None] * 8, 1), (10, [float("nan")] + [0.0] * 7, 2), (13, [float("inf")] * 8, None)]
    random.Random(seed).shuffle(rows)
    found, _ = run(spark, folder_of, rows)
    wanted = brute_force([r for r in rows if r[1] != []], entries)
    assert sorted(r for r in found if r[0] != 4) == sorted(wanted)
    assert [r[:3] for r in found if r[0] == 4] == [(4, None, None)]


def test_equals_sql(spark, docs, folder_of, against_sql):
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 0.1) for _ in range(8)], rng.choice([None, 1, 2])) for i in range(600)] + [(600, None, 1)]
    _, folder = run(spark, folder_of, rows)
    against_sql(spark, "op13_vector_codes", folder)


@pytest.mark.parametrize("seed", range(20))
def test_reassign_equals_a_full_scan(seed):
    rng = np.random.default_rng(seed)
    x = rng.integers(-3, 4, (300, 3))
    before = rng.integers(-3, 4, (12, 3))
    codes, dist = vector_codes.nearest(x, before)
    after = before.copy()
    moved = rng.random(12) < rng.choice([0.0, 0.2, 0.7, 1.0])
    after[moved] = rng.integers(-3, 4, (int(moved.sum()), 3))
    got = vector_codes.reassign(x, codes, dist, after, (before != after).any(1))
    for a, b in zip(got, vector_codes.nearest(x, after)):
        assert a.tolist() == b.tolist()


def test_large_components_stay_exact():
    x = np.array([[vector_codes.LIMIT - 1, -vector_codes.LIMIT + 1]] * 2, np.int64)
    e = np.array([[-vector_codes.LIMIT + 1, vector_codes.LIMIT - 1], [vector_codes.LIMIT - 2, 0]], np.int64)
    want = [[sum((a - b) ** 2 for a, b in zip(r, s)) for s in e.tolist()] for r in x.tolist()]
    assert vector_codes.distances(x, e).tolist() == want


def test_other_lengths_repeated_and_missing_ids_and_extra_columns(spark, docs, folder_of):
    schema = "vec_id bigint, embedding array<float>, label int, v int, codes string, _label int, part int, error string"
    extra = (1, "c", 2, 3, "e")
    vectors = [(2, [0.0, 0.5, 1.0, 1.5], 1), (2, [0.0, 0.5, 1.0, 1.5], 1), (None, [1.0] * 4, None), (5, [1.0] * 8, 1), (6, [1e30] * 4, None)]
    found, _ = run(spark, folder_of, [(*v, *extra) for v in vectors], schema)
    digest = hashlib.sha256(b"0,0,1024,512,512,1024,1024,1024,1024,1536,1536,1024").hexdigest()
    wanted = [(2, "00000000", 0, 0, digest)] * 2 + [(None, "02020002", 0, 0, digest), (5, None, None, 0, digest), (6, None, None, 0, digest)]
    assert sorted(found, key=repr) == sorted(wanted, key=repr)


def test_empty_table(spark, docs, folder_of):
    found, folder = run(spark, folder_of, [])
    assert found == []
    shutil.rmtree(folder)
    found, _ = run(spark, folder_of, [(1, None, None)])
    assert found == []
