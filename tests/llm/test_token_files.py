import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from breachlens.llm import simple8b, token_files
from breachlens.llm.queries import queries

from .test_bpe import random_texts

PATH = public_tokenizers.path("byte_bpe_50k.json")


def library():
    return Tokenizer.from_file(PATH)


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("block", [1, 61, 8192])
def test_round_trip(monkeypatch, seed, block):
    monkeypatch.setattr(simple8b, "BLOCK", block)
    rng = random.Random(seed)
    for n in (0, 1, 59, 60, 61, 1000):
        widths = [rng.choice([[0, 1], [1, 8, 16], [16], [59, 60, 61, 64], [0, 64]][seed % 5]) for _ in range(n)]
        values = np.array([rng.getrandbits(w) if w else 0 for w in widths], np.uint64)
        words, offsets = simple8b.encode(values)
        assert simple8b.decode(words, offsets, n).tolist() == values.tolist()


def test_words_are_filled_greedily():
    assert len(simple8b.encode_block(np.zeros(60, np.uint64))) == 1
    assert len(simple8b.encode_block(np.full(60, (1 << 15) - 1, np.uint64))) == 15
    assert len(simple8b.encode_block(np.full(60, 1 << 15, np.uint64))) == 20
    assert simple8b.encode_block(np.array([1 << 60], np.uint64)).tolist() == [15 << 60, 1 << 60]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_without_special_tokens_equal_the_library(monkeypatch, name):
    monkeypatch.setattr(token_files, "CACHE_ENTRIES", 500)
    texts = random_texts(1500, 11)
    path = public_tokenizers.path(name)
    direct = Tokenizer.from_file(path)
    direct.encode_special_tokens = True
    encoder = token_files.Encoder(open(path, encoding="utf-8").read(), special_tokens=False)
    assert encoder.by_piece == (name == "byte_bpe_50k.json")
    for i in range(0, len(texts), 100):
        part = texts[i : i + 100]
        ids, counts = encoder.encode([t.encode() for t in part])
        expected = [x.ids for x in direct.encode_batch(part, add_special_tokens=False)]
        assert counts.tolist() == [len(x) for x in expected]
        assert ids.tolist() == [i for x in expected for i in x]


def test_words_whose_tokens_run_on_are_asked_one_by_one():
    encoder = token_files.Encoder(open(PATH, encoding="utf-8").read())
    words = [" the", "re", " is", "n't"]  # joined, these are other pre-tokens
    ids, counts = encoder._ask_words(words)
    expected = [library().encode(w, add_special_tokens=False).ids for w in words]
    assert ids.tolist() == [i for x in expected for i in x] and counts.tolist() == [len(x) for x in expected]


@pytest.mark.parametrize("row_ids", [1, 50, 1 << 18])
def test_query_equals_the_library(spark, docs, folder_of, monkeypatch, row_ids):
    monkeypatch.setattr(token_files, "ROW_IDS", row_ids)
    cases = [(3 * i, t) for i, t in enumerate(random_texts(60, 3))] + [(7, None), (8, "same"), (8, "same"), (9, ""), (None, "no id"), (11, "a <|endoftext|> b<|endoftext|>")]
    found = queries()["op4_token_files"](spark, folder_of(documents=docs(*cases, parts=5)))
    assert found.columns[:4] == ["doc_id", "start", "n_tokens", "ids_crc32"]
    plain = Tokenizer.from_file(PATH)  # as it is loaded, nothing switched
    expected, start = [], 0
    for i, text in sorted(cases, key=lambda x: (x[0] is not None, x[0] or 0, x[1] or "")):
        ids = [*plain.encode(text or "", add_special_tokens=False).ids, 0]
        expected.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, expected))


def test_empty_table(spark, docs, folder_of):
    assert queries()["op4_token_files"](spark, folder_of(documents=docs((1, "x")).where("false"))).count() == 0


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_special_tokens_equal_the_library_as_loaded(name):
    path = public_tokenizers.path(name)
    direct = Tokenizer.from_file(path)
    encoder = token_files.Encoder(open(path, encoding="utf-8").read())
    assert encoder.by_piece == (name == "byte_bpe_50k.json")
    end = "<|endoftext|>"
    texts = [f"a {end} b", end, f"{end}{end}", f" {end} ", f"it's{end}'s  {end}\n", "none", "", f"<|endof{end}text|>", *random_texts(1500, 5)]
    assert sum(end in t for t in texts) > 100
    ids, counts = encoder.encode([t.encode() for t in texts])
    expected = [x.ids for x in direct.encode_batch(texts, add_special_tokens=False)]
    assert counts.tolist() == [len(x) for x in expected]
    assert ids.tolist() == [i for x in expected for i in x]


def test_files_hold_the_ids_of_special_tokens(spark, docs, tmp_path):
    table = docs((1, "a <|endoftext|> b"), (2, "plain"))
    token_files.write_token_files(table, f"{tmp_path}/files", PATH)
    found = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in token_files.read_token_files(spark, f"{tmp_path}/files").collect()}
    assert found[1] == [64, 220, 50256, 275, 0]


def test_rows_of_one_id_are_divided(spark, docs, tmp_path):
    """A hot id, a null one with one text: several files, places without gap, order kept."""
    rows = [(None, "the same text") for _ in range(400)] + [(5, f"text {i}") for i in range(400)] + [(i, "x") for i in range(10)]
    table = docs(*rows, parts=6).withColumnRenamed("n_chars", "hash").withColumnRenamed("lang", "place")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        token_files.write_token_files(table, f"{tmp_path}/files", PATH)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    read = token_files.read_token_files(spark, f"{tmp_path}/files").join(token_files.part_starts(spark, f"{tmp_path}/files"), "part")
    found = sorted((r.part_start + r.start, r.n_tokens, r.doc_id, r.part) for r in read.collect())
    assert len(found) == len(rows)
    assert all(a[0] + a[1] == b[0] for a, b in zip(found, found[1:]))
    ids = [r[2] for r in found]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    for hot in (None, 5):
        assert len({part for _, _, i, part in found if i == hot}) > 1
