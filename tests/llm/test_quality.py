from collections import Counter

from breachlens.llm import quality
from breachlens.llm.quality import RULES, ablations, keep_quality, mask_of, quality_ledger

PROSE = " ".join(f"word{i % 97} and{i}" for i in range(60))
CASES = [
    (1, None), (2, ""), (3, " \n\t "), (4, PROSE), (4, PROSE), (5, "a b c a b c a b"), (6, "one two three " * 40),
    (7, "### $$$ " * 60), (8, "same line\nsame line\nother\nsame line\n"), (9, "ÀÉ çà b\x1cc\x85 d"),
    (10, "SHOUT " * 3 + PROSE.upper()), (11, "x " * 30000 + PROSE), (12, "|".join(PROSE.split())),
]


def slow_repeats(words):
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    return len({i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)})


def test_repeated_words_equal_brute_force():
    for text in [t for _, t in CASES if t] + ["a a a a", "a b a b a b c", "a b c d a b c d x a b"]:
        words = text.encode().split()
        assert quality.repeated_words(words) == slow_repeats(words)


def test_query_equals_sql(spark, docs, folder_of, against_sql):
    folder = folder_of(documents=docs(*CASES), benchmark=docs((1, "x")))
    against_sql(spark, "op7_quality", folder)


def test_empty_table(spark, docs):
    assert quality_ledger(docs((1, "x")).where("false")).count() == 0


def test_ablations_equal_reapplied_policies(docs):
    ledger = quality_ledger(docs(*CASES))
    bits = [r.failed for r in ledger.collect()]
    mask = mask_of("v1")
    for row in ablations(ledger, "v1").collect():
        bit = next(1 << r.bit for r in RULES if r.name == row.rule)
        assert row.rejected == sum(bool(b & mask & bit) for b in bits)
        assert row.rejected_alone == sum(b & mask == bit for b in bits)
        assert row.kept_without == sum(b & mask & ~bit == 0 for b in bits)


def test_keeping_leaves_all_columns_even_clashing_ones(docs):
    table = docs(*CASES).selectExpr("*", "doc_id AS measures", "text AS _measures", "1 AS n_words")
    kept = keep_quality(table)
    assert kept.columns == table.columns
    assert sorted(r.doc_id for r in kept.collect()) == [4, 4]
