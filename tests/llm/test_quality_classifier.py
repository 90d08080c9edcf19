import random
import re
import zlib

import numpy as np
import pytest

from breachlens.llm import quality_classifier as qc
from breachlens.llm.queries import queries


def plain_words(text):
    return re.findall(rb"[0-9a-z\x80-\xff]+|[^0-9a-z\x80-\xff\s\0]+", (text or b"").lower())


def random_text(rng, n, junk=False):
    words = ["the", "Of", "and", "über", "x1", "tion", "ing", "er"]
    out = " ".join(rng.choice(words) + rng.choice(["", "", ",", ".\n"]) for _ in range(n))
    return re.sub(" ", "$$$ ", out) if junk else out


def test_words(monkeypatch):
    monkeypatch.setattr(qc, "BLOCK_BYTES", 40)
    rng = random.Random(1)
    texts = [random_text(rng, rng.randint(0, 30), rng.random() < 0.3).encode() for _ in range(60)] + [None, b"", b"A a  B", b"x" * 100]
    known = {}
    found = []
    for hashes, per_text in qc.words(texts):
        found += np.split(hashes, np.cumsum(per_text)[:-1])
    assert len(found) == len(texts)
    for text, hashes in zip(texts, found):
        words = plain_words(text)
        assert len(words) == len(hashes)
        for word, h in zip(words, hashes.tolist()):
            assert known.setdefault(word, h) == h
    assert len(set(known.values())) == len(known)


@pytest.mark.parametrize("at_once", [3, 1 << 16])
def test_contexts_and_pooling_equal_plain_loops(monkeypatch, at_once):
    monkeypatch.setattr(qc, "WORDS", at_once)
    monkeypatch.setattr(qc, "BUCKETS", 64)
    rng = random.Random(2)
    texts = [random_text(rng, n).encode() for n in (0, 1, 2, 9, 40)]
    table, wanted = np.zeros((64, qc.DIMENSIONS + 1), np.int64), np.zeros((64, qc.DIMENSIONS + 1), np.int64)
    for hashes, per_text in qc.words(texts):
        qc.add_contexts(table, hashes, per_text)
    per = [next(qc.words([t]))[0] for t in texts]
    for hashes in per:
        of, (places, signs) = qc.buckets(hashes), qc.index_vectors(hashes)
        for i in range(len(hashes)):
            wanted[of[i], qc.DIMENSIONS] += 1
            for j in range(max(0, i - qc.REACH), min(len(hashes), i + qc.REACH + 1)):
                for place, sign in zip(places[j], signs[j]) if i != j else ():
                    wanted[of[i], place] += sign
    assert (table == wanted).all()
    vectors = qc.word_vectors(table)
    for hashes, got in zip(per, qc.features(vectors, texts)):
        v = vectors[qc.buckets(hashes)].astype(float)
        mean = v.mean(0) if len(v) else np.zeros(qc.DIMENSIONS)
        n = max(1, len(v))
        extra = [np.sqrt((mean**2).sum()), (v**2).sum() / n, sum(float(a @ b) for a, b in zip(v, v[1:])) / n]
        assert np.allclose(got, [*mean, *extra])


def test_gradients():
    rng = np.random.default_rng(3)
    x, y = rng.standard_normal((20, 5)), rng.integers(0, 2, 20)
    layers = [rng.standard_normal((5, 4)), rng.standard_normal(4), rng.standard_normal(4), rng.standard_normal(1)]
    network = qc.Network(np.zeros(5), np.ones(5), layers)
    loss = lambda: qc.log_loss(network.logits(x), y, 1.0) + qc.WEIGHT_DECAY / 2 * float((layers[0] ** 2).sum())
    for w, g in zip(layers, network.step(x, y)):
        for at in np.ndindex(w.shape):
            w[at] += 1e-5
            high = loss()
            w[at] -= 2e-5
            low = loss()
            w[at] += 1e-5
            assert abs((high - low) / 2e-5 - g[at]) < 1e-6


def test_temperature_corrects_overconfidence():
    rng = np.random.default_rng(4)
    logits = rng.standard_normal(4000) * 2
    y = (rng.random(4000) < 1 / (1 + np.exp(-logits))).astype(int)
    assert 2.5 < qc.fitted_temperature(logits * 3, y) < 3.6
    assert qc.fitted_temperature(logits, np.ones(4000)) == 1


LABELS = "doc_id bigint, quality int, toxic int"


def run(spark, docs, folder_of, rows, labels, **extra):
    table = docs(*rows)
    for name, value in extra.items():
        table = table.selectExpr("*", f"{value} AS {name}")
    folder = folder_of(documents=table, labels=spark.createDataFrame(labels, LABELS))
    return [tuple(r) for r in queries()["op11_quality_classifier"](spark, folder).select("doc_id", "held_out", "score", "predicted").collect()]


def test_held_out_documents_are_told_apart_and_their_labels_unused(spark, docs, folder_of):
    rng = random.Random(5)
    rows = [(i, random_text(rng, rng.randint(20, 120), junk=i % 5 == 3)) for i in range(900)]
    good = {i: int(i % 5 != 3) for i in range(900)}
    held = {i for i in good if zlib.crc32(str(i).encode()) % 5 == 0}
    labels = [(i, good[i], 0) for i in good if i % 2 or i in held]
    first = run(spark, docs, folder_of, rows, labels)
    assert {r[0] for r in first if r[1]} == held
    assert all(0 <= s <= 1 and p == int(s >= 0.3) for _, _, s, p in first)
    assert np.mean([p == good[i] for i, h, _, p in first if h]) > 0.95
    # labels of held-out documents change nothing
    again = run(spark, docs, folder_of, rows, [(i, 1 - q if i in held else q, 0) for i, q, _ in labels])
    assert sorted(first) == sorted(again)


def test_nulls_repeats_and_clashing_columns(spark, docs, folder_of):
    rng = random.Random(6)
    rows = [(i, random_text(rng, 30, junk=i % 2 == 0)) for i in range(60)]
    rows += [(None, None), (None, "the"), (61, ""), (61, ""), (3, rows[3][1]), (62, "word " * 300_000)]
    labels = [(i, i % 2, 0) for i in range(60)] + [(3, 1, 0), (3, 0, 0), (None, 1, 0), (5, None, 0), (7, 9, 0)]
    found = run(spark, docs, folder_of, rows, labels, hash="1", label="'l'", quality="0", id="2")
    assert len(found) == len(rows)
    assert [h for i, h, _, _ in found if i is None] == [False, False]
    assert len({r for r in found if r[0] in (3, 61)}) == 2


def test_without_labels_and_without_documents(spark, docs, folder_of):
    found = run(spark, docs, folder_of, [(1, "a"), (2, None)], [])
    assert {r[2:] for r in found} == {(0.5, 1)}
    folder = folder_of(documents=docs((1, "x")).where("false"), labels=spark.createDataFrame([], LABELS))
    assert queries()["op11_quality_classifier"](spark, folder).count() == 0


def test_sample_is_bounded(spark, docs, monkeypatch):
    monkeypatch.setattr(qc, "SAMPLE", 10)
    from pyspark.sql import functions as F

    table = docs(*[(1, "same text") for _ in range(50)], *[(i, f"text {i}") for i in range(2, 60)])
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)], LABELS)
    found = qc._sample(spark, table, labels, F.lit(True), "doc_id", "text", "quality").collect()
    assert len(found) == 10 and len({r.hash for r in found}) == 10
