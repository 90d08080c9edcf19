import hashlib
import random

import numpy as np
import pytest

import corpus_pipeline
from breachlens.llm import quality
from breachlens.llm.common import lower_words

from .conftest import DOCUMENTS
from .test_bpe import LIBRARY
from .test_line_dedup import dropped
from .test_simhash import near_pairs, slow_components, slow_fingerprint

ITEMS = ["alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron", "short item", None]
PUBLIC = "This very line stands in many of the documents."


def documents(seed):
    rng = random.Random(seed)
    words = [f"{rng.choice('bcdfgklmn')}{rng.choice('aeiou')}{rng.choice(['r', 'st', 'nd', 'ch'])}{i}" for i in range(400)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    out = []
    for i in range(60):
        lines = [prose(rng.randrange(20, 60)) for _ in range(rng.randrange(2, 5))]
        if i % 3 == 0:
            lines.insert(1, PUBLIC)
        if i % 7 == 0:
            lines.append(ITEMS[0])
        if i % 11 == 0:
            lines = ["x y z " * 60]
        out.append((i, "\n".join(lines)))
        if i % 5 == 0:
            long = prose(500).split()
            out += [(1000 + 10 * i + k, " ".join([*long[:-1], f"end{k}"])) for k in range(3)]
        if i % 9 == 0:
            out.append((500 + i, "\n".join(lines).upper()))
    return [*out, (9000, None), (9001, ""), (9002, prose(30000))]


def slow_pipeline(cases):
    sizes = []
    mask = quality.mask_of("v1")
    rules = {r.name: r for r in quality.RULES}

    def passes(text):
        m = dict(zip(quality.MEASURE_NAMES, quality.measure((text or "").encode())))
        return not any(
            mask & 1 << r.bit and eval(r.fails.replace(" AND ", " and "), {}, m) for r in rules.values()  # noqa: S307
        )

    cases = [(i, t) for i, t in cases if passes(t)]
    sizes.append(len(cases))
    cases = [(i, t) for i, t, _ in dropped(cases)]
    sizes.append(len(cases))
    fp = {i: slow_fingerprint(t) for i, t in cases}
    of = slow_components(near_pairs(fp.values()), set(fp.values()))
    first = {}
    for i in sorted(fp):
        first.setdefault(of[fp[i]], i)
    cases = [(i, t) for i, t in cases if first[of[fp[i]]] == i]
    sizes.append(len(cases))
    windows = set()
    for item in ITEMS:
        words = lower_words((item or "").encode())
        windows |= {tuple(words[k : k + 13]) for k in range(max(1, len(words) - 12))} if words else set()

    def clean(text):
        words = lower_words((text or "").encode())
        hit = {k + j for w in windows for k in range(len(words)) if tuple(words[k : k + len(w)]) == w for j in range(len(w))}
        return not (hit and 20 * len(hit) >= len(words))

    cases = [(i, t) for i, t in cases if clean(t)]
    sizes.append(len(cases))
    ids = [(i, np.array(LIBRARY.encode_ordinary(t or ""), "<u4").tobytes()) for i, t in cases]
    return sizes, sorted((i, len(x) // 4, hashlib.sha256(x).hexdigest()) for i, x in ids)


@pytest.fixture
def folder(spark, docs, folder_of):
    items = spark.createDataFrame(list(enumerate(ITEMS)), "item_id bigint, text string")
    return folder_of(documents=docs(*documents(1)), benchmark=items)


def test_every_stage_works_on_what_the_one_before_kept(spark, folder):
    table = spark.read.parquet(f"{folder}/documents.parquet")
    expected, result = slow_pipeline([(r.doc_id, r.text) for r in table.collect()])
    assert table.count() > expected[0] >= expected[1] > expected[2] > expected[3] > 10
    found = corpus_pipeline.run(spark, folder)
    assert sorted(map(tuple, found.select("doc_id", "n_tokens", "ids_sha256").collect())) == result


def test_stages_leave_columns_and_stand_empty_tables(spark, docs, folder):
    assert len(corpus_pipeline.STAGES) == 5
    for table in (docs(*documents(2)[:12]), docs((1, None)), docs((1, "x")).where("false")):
        rows = table.select("*")
        assert rows.schema.simpleString() == spark.createDataFrame([], DOCUMENTS).schema.simpleString()
        for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
            kept = stage(spark, rows, folder)
            if number < 4:
                assert kept.dtypes == table.dtypes
            assert kept.count() <= table.count()
