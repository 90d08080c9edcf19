import itertools
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from breachlens.llm import simhash
from breachlens.llm.components import component_roots
from breachlens.llm.queries import queries


def slow_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(links, nodes):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def near_pairs(fps):
    return [(a, b) for a, b in itertools.combinations(sorted(set(fps)), 2) if (a ^ b).bit_count() <= 4]


def clusters(rng, n):
    """Fingerprints in dense groups, chains and alone."""
    fps = set()
    for _ in range(n):
        at = rng.getrandbits(64)
        for _ in range(rng.choice([0, 1, 3, 40])):
            fps.add(at)
            fp = at
            for bit in rng.sample(range(64), rng.randrange(7)):
                fp ^= 1 << bit
            fps.add(fp)
            if rng.random() < 0.2:
                at = fp
    return fps | {0, (1 << 64) - 1, 1, 31}


@pytest.mark.parametrize("small", [1, 4, 32])
def test_grid_links_join_what_all_pairs_join(spark, monkeypatch, small):
    fps = clusters(random.Random(small), 60)
    signed = [(int(np.uint64(f).astype(np.int64)),) for f in fps]
    monkeypatch.setattr(simhash, "SMALL_CELL", small)
    found = simhash.links(spark.createDataFrame(signed, "fp bigint")).collect()
    found = [(r.a % (1 << 64), r.b % (1 << 64)) for r in found]
    assert slow_components(found, fps) == slow_components(near_pairs(fps), fps)


def test_cells_bound_the_bit_distance(spark):
    rng = random.Random(4)
    pairs = []
    for _ in range(300):
        a = b = rng.getrandbits(64)
        for bit in rng.sample(range(64), 4):
            b ^= 1 << bit
        pairs.append(tuple(int(np.uint64(x).astype(np.int64)) for x in (a, b)))
    df = spark.createDataFrame(pairs, "a bigint, b bigint")
    met = df.where(F.arrays_overlap(simhash._cells(F.col("a")), simhash._cells(F.col("b"))))
    assert met.count() == len(pairs)


@pytest.mark.parametrize("size", [0, 1, 5, 400])
def test_large_cells_equal_small_ones(size):
    fps = np.array(sorted(clusters(random.Random(size), size // 10 + 1))[:size], np.uint64)
    a, b = simhash._large_cell(fps)
    assert slow_components(zip(a.tolist(), b.tolist()), fps.tolist()) == slow_components(near_pairs(fps.tolist()), fps.tolist())
    assert len(a) <= max(0, size - 1)


def test_component_roots(spark):
    rng = random.Random(9)
    edges = [(i, i + 1) for i in range(60)] + [(100, x) for x in range(101, 160)] + [(5, 5)]
    edges += [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(70)]
    found = {r.node: r.root for r in component_roots(spark, spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    nodes = {n for e in edges for n in e}
    assert {n: found.get(n, n) for n in nodes} == slow_components(edges, nodes)
    assert component_roots(spark, spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def random_documents(seed):
    rng = random.Random(seed)
    cases = [(1000, None), (1001, ""), (1002, " \n"), (1003, "one two"), (1004, "One\tTWO"), (1005, "w " * 30000), (1005, "w " * 30000)]
    for i in range(40):
        words = [rng.choice("abcdefgh") * rng.randrange(1, 4) for _ in range(rng.choice([3, 30, 400]))]
        for k in range(rng.randrange(4)):
            copy = list(words)
            if k:
                copy[rng.randrange(len(copy))] = "changed"
            cases.append((i * 10 + k, " ".join(copy)))
    rng.shuffle(cases)
    return cases


def test_query_equals_brute_force(spark, docs, folder_of):
    cases = random_documents(2)
    found = queries()["op8_simhash"](spark, folder_of(documents=docs(*cases)))
    fp = [(i, slow_fingerprint(t)) for i, t in cases]
    of = slow_components(near_pairs(f for _, f in fp), {f for _, f in fp})
    least = {}
    for i, f in fp:
        least[of[f]] = min(i, least.get(of[f], i))
    assert len(least) < len({f for _, f in fp}) < len({i for i, _ in fp})
    expected = sorted((i, f"{f:016x}", least[of[f]]) for i, f in fp)
    assert sorted(map(tuple, found.collect())) == expected


def test_rows_of_one_id_are_documents_of_their_own(spark, docs, folder_of):
    far, other = "one two three four five six", "seven eight nine ten eleven twelve"
    folder = folder_of(documents=docs((1, far), (7, far), (7, other), (9, other)))
    found = sorted((r.doc_id, r.component_id) for r in queries()["op8_simhash"](spark, folder).collect())
    assert found == [(1, 1), (7, 1), (7, 7), (9, 7)]


def test_one_row_of_each_component_stays(spark, docs):
    cases = [
        (5, "a b c d e f"), (3, "A B C D E F"), (None, "a b c d e f"), (7, "something else"), (7, "something else"), (7, "A b c D e f"),
        (None, "x"), (None, "x"), (None, "X"), (9, None), (None, ""), (None, "alone here"),
    ]
    table = docs(*cases).selectExpr("*", "1 AS row_key", "2 AS fp", "3 AS root", "4 AS first")
    for keep in (simhash.keep_one_row_of_each, lambda spark, rows: corpus_pipeline.near_dedup(spark, rows, "")):
        kept = keep(spark, table)
        assert kept.columns == table.columns
        found = sorted(str((r.doc_id, (r.text or "").lower())) for r in kept.collect())
        assert found == sorted(map(str, [(3, "a b c d e f"), (7, "something else"), (None, "x"), (9, ""), (None, "alone here")]))
    assert simhash.keep_one_row_of_each(spark, table.where("false")).count() == 0
