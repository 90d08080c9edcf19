import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from breachlens.llm import decontamination
from breachlens.llm.common import cut_words, lower_words
from breachlens.llm.decontamination import build_index, drop_contaminated_rows, match_phrases

ITEM = "the quick brown fox jumps over the lazy dog and runs away from here today ok"
ITEMS = [(0, ITEM), (1, "Two words"), (2, None), (3, "..."), (4, ITEM), (10, "two two two")]
CASES = [
    (1, ITEM.upper()), (2, f"start {ITEM} end"), (3, "two, words! two-words two words"), (4, None), (5, ""),
    (6, ITEM.replace("lazy", "idle")), (7, "two two two two two"), (8, "x " * 20000 + ITEM), (8, "Two words"), (9, "two"),
    (None, ITEM), (11, "words two"), (12, "filler " * 400 + "two words"),
]


def items_table(spark):
    return spark.createDataFrame(ITEMS, "item_id bigint, text string")


@pytest.mark.parametrize("segment_bytes", [1, 300, 16 << 20])
def test_query_equals_sql(spark, docs, folder_of, against_sql, monkeypatch, segment_bytes):
    folder = folder_of(documents=docs(*CASES), benchmark=items_table(spark))
    monkeypatch.setattr(decontamination, "SEGMENT_BYTES", segment_bytes)
    against_sql(spark, "op1_decontamination", folder)


def test_many_terms_are_joined_without_a_broadcast(spark, docs, folder_of, against_sql, monkeypatch):
    monkeypatch.setattr(decontamination, "BROADCAST_BYTES", 0)
    against_sql(spark, "op1_decontamination", folder_of(documents=docs(*CASES), benchmark=items_table(spark)))


@pytest.mark.parametrize("empty", ["documents", "benchmark"])
def test_empty_tables_and_no_hits(spark, docs, folder_of, against_sql, empty):
    tables = {"documents": docs(*CASES), "benchmark": items_table(spark)}
    tables[empty] = tables[empty].where("false")
    against_sql(spark, "op1_decontamination", folder_of(**tables))


@pytest.mark.parametrize("slop", [0, 1, 3])
def test_phrases_and_proximity_equal_brute_force(spark, docs, tmp_path, slop):
    rng = random.Random(slop)
    texts = [(i, " ".join(rng.choice("abcde") for _ in range(rng.randrange(40)))) for i in range(30)]
    phrases = [(i, [rng.choice("abcde").encode() for _ in range(n)]) for i, n in enumerate([1, 2, 3, 4, 2])]
    phrases.append((9, [b"a", b"nowhere"]))
    index = build_index(docs(*texts), f"{tmp_path}/index")
    wanted = spark.createDataFrame(phrases, "phrase bigint, terms array<binary>")
    places = index.where("term IS NULL").select("segment", "doc_id", "start", (F.col("start") + F.col("n_words")).alias("stop"))
    hits = match_phrases(index, wanted, slop)
    close = (hits.position + slop >= places.start) & (hits.position < places.stop + decontamination.GAP // 2)
    found = hits.join(places, (hits.segment == places.segment) & close)
    found = {(r.phrase, r.doc_id, r.position - r.start) for r in found.collect()}
    exact, near = set(), set()
    for doc, text in texts:
        words = lower_words(text.encode())
        for number, terms in phrases:
            for start in range(-slop, len(words) + slop):
                around = [words[max(0, start + k - slop) : max(0, start + k + slop + 1)] for k in range(len(terms))]
                if all(term in part for term, part in zip(terms, around)):
                    near.add((number, doc, start))
                if start >= 0 and words[start : start + len(terms)] == terms:
                    exact.add((number, doc, start))
    assert exact <= found <= near
    assert slop or exact == found


def test_dropping_leaves_clean_documents_and_all_columns(spark, docs):
    table = docs(*CASES).selectExpr("*", "1 AS contaminated_text", "2 AS n_words", "3 AS digest")
    kept = drop_contaminated_rows(spark, table, items_table(spark))
    assert kept.columns == table.columns
    assert sorted(r.doc_id for r in kept.collect()) == [4, 5, 6, 8, 9, 11, 12]


@pytest.mark.parametrize("seed", range(3))
def test_cut_words(seed):
    rng = random.Random(seed)
    texts = [None, b"", b" "] + ["".join(rng.choice("aB1 .é-") for _ in range(rng.randrange(40))).encode() for _ in range(50)]
    rng.shuffle(texts)
    data, starts, lengths, per_text = cut_words(texts)
    found = iter([data[a : a + n] for a, n in zip(starts.tolist(), lengths.tolist())])
    assert [[next(found) for _ in range(n)] for n in per_text.tolist()] == [lower_words(t) for t in texts]


def test_rows_are_judged_alone_whatever_ids_they_share(spark, docs):
    cases = [(None, ITEM), (None, "clean"), (None, None), (8, "x " * 20000 + ITEM), (8, "Two words"), (9, ITEM), (9, "also clean")]
    table = docs(*cases).selectExpr("*", "1 AS segment", "2 AS doc_id_")
    wanted = sorted(map(repr, [(None, "clean"), (None, None), (8, "x " * 20000 + ITEM), (9, "also clean")]))
    kept = drop_contaminated_rows(spark, table, items_table(spark))
    assert kept.columns == table.columns
    assert sorted(repr((r.doc_id, r.text)) for r in kept.collect()) == wanted


def test_the_pipeline_keeps_clean_rows_without_id(spark, docs, folder_of):
    folder = folder_of(benchmark=items_table(spark))
    table = docs((None, ITEM), (None, "clean"), (8, "x " * 20000 + ITEM), (8, "Two words"))
    kept = corpus_pipeline.decontaminate(spark, table, folder).collect()
    assert sorted(str((r.doc_id, len(r.text))) for r in kept) == sorted([str((None, 5)), str((8, 40000 + len(ITEM)))])
