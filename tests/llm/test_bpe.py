import hashlib
import random
from itertools import chain

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken

from breachlens.llm import bpe
from breachlens.llm.pretokens import cut_pretokens, distinct_pieces
from breachlens.llm.queries import queries

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
RANKS = bpe.read_ranks(PATH)
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
PARTS = [
    "a", "b", " ", " ", "\n", "'", "'s", "'re", "'ll", "s", "t", "1", "é", "\xa0", "\x1c", "\x85", "!", "?", "中", "🙂", "٣",
    "\r\n", "²", "ñ", "\t", "  ", " the", " hello", "'t", "́", " ", "<|endoftext|>", "\0",
]
LONG = ["", "x" * 5000, " " * 3000 + "a", "responsibilities internationalization " * 3, "ab " * 200_000]


def random_texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randrange(30))) for _ in range(n)] + LONG


def test_pretokens_equal_the_pattern():
    texts = random_texts(5000, 1)
    data, starts, lengths, per_text = cut_pretokens([t.encode() for t in texts])
    pieces = iter([data[a : a + n].decode() for a, n in zip(starts, lengths)])
    for text, n in zip(texts, per_text):
        assert [next(pieces) for _ in range(n)] == regex.findall(public_tokenizers.PATTERN.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"), text)


@pytest.mark.parametrize("block", [1, 1000, 1 << 20])
def test_ids_equal_the_library(monkeypatch, block):
    monkeypatch.setattr(bpe, "BLOCK_BYTES", block)
    coder = bpe.Coder(RANKS)
    texts = random_texts(1500, block)
    for text, ids in zip(texts, chain.from_iterable(bpe.encode_texts(coder, [t.encode() for t in texts]))):
        assert ids.tolist() == LIBRARY.encode_ordinary(text)
        assert coder.decode(ids) == text.encode()


def test_a_small_cache_changes_nothing(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 3)
    monkeypatch.setattr(bpe, "BLOCK_BYTES", 50)
    texts = random_texts(200, 7)
    coder = bpe.Coder(RANKS)
    found = chain.from_iterable(bpe.encode_texts(coder, [t.encode() for t in texts]))
    assert [x.tolist() for x in found] == [LIBRARY.encode_ordinary(t) for t in texts]


def test_equal_pieces_share_a_code(monkeypatch):
    rng = random.Random(2)
    pieces = [bytes(rng.choice(b"ab\0") for _ in range(rng.choice([1, 7, 8, 9, 16, 17, 31, 32, 33, 80]))) for _ in range(3000)]
    pieces += [b"x" * n for n in range(1, 90)] * 2
    lengths = np.array([len(p) for p in pieces])
    starts = np.cumsum(lengths) - lengths
    for broken in (False, True):
        if broken:  # a hash that is the same for all pieces must not change the codes' meaning
            monkeypatch.setattr("breachlens.llm.pretokens.mixed", lambda h: h * np.uint64(0))
        codes, places = distinct_pieces(b"".join(pieces) + bytes(64), starts, lengths)
        assert [pieces[i] for i in places[codes]] == pieces
        assert len(places) == len(set(pieces))


def test_columns_of_ids_and_bytes(spark, docs):
    from pyspark.sql import functions as F

    from breachlens.llm.common import utf8

    table = docs((1, "some text"), (2, None), (3, "it's 12 o'clock")).select(utf8("text").alias("t"), bpe.encode(utf8("text"), PATH).alias("ids"))
    rows = table.withColumn("back", bpe.decode(F.col("ids"), PATH)).collect()
    for r in rows:
        assert bytes(r.back) == bytes(r.t or b"")
        assert np.frombuffer(r.ids, "<u4").tolist() == LIBRARY.encode_ordinary((r.t or b"").decode())


def test_perfect_hash_is_minimal_and_rejects_others():
    keys = [e for e in RANKS if len(e) <= 32]
    table = bpe.PerfectHash(keys)
    assert sorted(i for level in table.levels for i in level if i >= 0) == list(range(len(keys)))
    lengths = np.array([len(k) for k in keys])
    starts = np.cumsum(lengths) - lengths
    assert table.find(b"".join(keys) + bytes(40), starts, lengths).tolist() == list(range(len(keys)))
    others = [k + b"\xfe" for k in keys if k + b"\xfe" not in RANKS]
    lengths = np.array([len(k) for k in others])
    assert (table.find(b"".join(others) + bytes(40), np.cumsum(lengths) - lengths, lengths) == -1).all()


def test_query_equals_the_library(spark, docs, folder_of):
    cases = [(i, t) for i, t in enumerate(random_texts(60, 3))] + [(900, None), (901, "same"), (901, "same"), (None, "no id")]
    found = queries()["op5_bpe"](spark, folder_of(documents=docs(*cases)))
    expected = []
    for i, text in cases:
        ids = np.array(LIBRARY.encode_ordinary(text or ""), "<u4").tobytes()
        expected.append((i, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, expected))
    assert queries()["op5_bpe"](spark, folder_of(documents=docs((1, "x")).where("false"))).count() == 0
