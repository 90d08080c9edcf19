import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from breachlens.llm import language
from breachlens.llm.queries import queries

FOLDER = "/root/testdata/sf0.01"
WORDS = {"aa": ["bala", "kana", "toma", "aram"], "bb": ["schnur", "twist", "prick", "strum"], "çç": ["éàè", "ùïô", "çéç"]}


def labelled_texts(n, seed=0):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        lang = rng.choice(list(WORDS))
        out.append((lang, " ".join(rng.choice(WORDS[lang]) for _ in range(rng.randrange(3, 120)))))
    return out


def small_network():
    network = language.ByteNetwork.random(["a", "b", "c"], 3)
    rng = np.random.default_rng(1)
    network.bias += rng.standard_normal(network.bias.shape).astype(np.float32) * 0.1
    return network


def test_responses_equal_a_plain_convolution():
    network = small_network()
    windows, sizes = language._layout([b"Hello, world", b""])
    assert sizes.tolist() == [12, 0]
    found = network.responses(windows, network.tables())
    for place in range(language.WINDOW):
        plain = []
        for bank in network.filters:
            seen = network.embedding[windows[:, place : place + len(bank)]]
            plain.append(np.einsum("bke,kef->bf", seen, bank))
        assert np.allclose(found[:, place], np.concatenate(plain, 1), atol=1e-4)


def test_gradients_equal_differences():
    network = small_network()
    for name in ("embedding", "bias", "dense", "dense_bias"):
        setattr(network, name, getattr(network, name).astype(np.float64))
    network.filters = [f.astype(np.float64) for f in network.filters]
    windows, _ = language._layout([b"some text", b"other text here", b"third"])
    labels = np.array([0, 2, 1])
    _, gradients = network.step(windows, labels)
    rng = random.Random(0)
    for weight, gradient in zip(network.weights(), gradients):
        for _ in range(10):
            at = tuple(rng.randrange(n) for n in weight.shape)
            if weight is network.embedding:
                at = (rng.choice(b"some text"), at[1])
            old = weight[at]
            weight[at] = old + 1e-6
            up, _ = network.step(windows, labels)
            weight[at] = old - 1e-6
            down, _ = network.step(windows, labels)
            weight[at] = old
            assert gradient[at] == pytest.approx((up - down) / 2e-6, abs=1e-5)


def test_learns_and_does_not_depend_on_the_batching(monkeypatch):
    train, test = labelled_texts(300), labelled_texts(100, 1)
    network = language.fit([t.encode() for _, t in train], [lang for lang, _ in train])
    texts = [t.encode() for _, t in test] + [("bala " * 20000).encode()]
    found = network.predict(texts)
    assert [lang for lang, _ in found] == [lang for lang, _ in test] + ["aa"]
    monkeypatch.setattr(language, "BLOCK_BYTES", 100)
    for (a, p), (b, q) in zip(found, network.predict(texts)):
        assert a == b and p == pytest.approx(q, abs=1e-4)


def test_query_on_the_test_table(spark):
    found = queries()["op2_language"](spark, FOLDER).collect()
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    assert len(found) == len(truth)
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
    held = [r for r in found if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.95 * len(held)


def test_texts_without_letters_and_missing_labels(spark, docs, folder_of):
    cases = [(1, None), (2, ""), (3, "12 34 !?"), (4, "²³"), (5, "бг"), (None, "x"), (6, "same"), (6, "same")]
    table = docs(*cases)
    query = queries()["op2_language"]
    assert {r.lang_pred for r in query(spark, folder_of(documents=table)).collect()} == {"und"}
    labelled = table.drop("lang").selectExpr("*", "'l1' AS lang", "1 AS score", "'x' AS found")
    found = query(spark, folder_of(documents=labelled)).collect()
    assert {r.doc_id: r.lang_pred for r in found} == {1: "und", 2: "und", 3: "und", 4: "und", 5: "l1", 6: "l1", None: "l1"}
    assert len(found) == 8 and {r.score for r in found} <= {0.0, 1.0}
    assert query(spark, folder_of(documents=table.where("false"))).count() == 0


def test_what_is_collected_is_bounded_without_ids(spark, docs, monkeypatch):
    seen = []
    monkeypatch.setattr(language, "fit", lambda windows, labels: seen.append(len(windows)))
    rng = random.Random(3)
    some = [" ".join(rng.choice(WORDS["aa"]) for _ in range(800)) for _ in range(400)]
    table = docs(*[(None, some[i % 400]) for i in range(4000)]).selectExpr("doc_id", "text", "'aa' AS lang")
    language.train(table, F.lit(True))
    assert 1000 < seen[0] <= language.SAMPLE_DOCS * language.SAMPLE_WINDOWS


def test_query_equals_a_plain_convolution_of_each_window(spark, docs, folder_of, monkeypatch):
    """Every window by itself, filters by loops over places; the learnt weights are those the query used."""
    kept = []
    fit = language.fit
    monkeypatch.setattr(language, "fit", lambda windows, labels: kept.append(fit(windows, labels)) or kept[-1])
    cases = labelled_texts(40, 7)
    rows = [(i, t) for i, (_, t) in enumerate(cases)] + [(900, "bala kana " * 200)]
    langs = spark.createDataFrame([(i, lang) for i, (lang, _) in enumerate(cases)], "doc_id bigint, lang string")
    table = docs(*rows).drop("lang").join(langs, "doc_id", "left")
    found = {r.doc_id: (r.lang_pred, r.score) for r in queries()["op2_language"](spark, folder_of(documents=table)).collect()}
    network = kept[0]
    for i, text in rows:
        data = text.encode()
        total = np.zeros(len(network.languages))
        for at in range(0, len(data), language.WINDOW):
            window = list(data[at : at + language.WINDOW].lower())
            size = len(window)
            window += [256] * (language.WINDOW + max(language.WIDTHS) - 1 - size)
            best = []
            for bank in network.filters:
                each = [sum(network.embedding[window[p + k]] @ bank[k] for k in range(len(bank))) for p in range(language.WINDOW)]
                best.append(np.max(each, axis=0))
            hidden = np.maximum(np.concatenate(best) + network.bias, 0)
            logits = hidden @ network.dense + network.dense_bias
            e = np.exp(logits - logits.max())
            total += e / e.sum() * size
        total /= len(data)
        assert found[i][0] == network.languages[int(total.argmax())]
        assert found[i][1] == pytest.approx(min(1, total.max()), abs=1e-4)
