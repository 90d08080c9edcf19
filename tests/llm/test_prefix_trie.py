import hashlib
import random
import zlib

import pytest

from breachlens.llm import prefix_trie
from breachlens.llm.queries import queries
from breachlens.llm.radix_tree import RadixTree

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def brute_force(rows):
    """Nodes from sets of prefixes; rows without ties in their turn numbers."""
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(v)] for c, v in convs.items()}
    whole = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 9
        whole[c] = tuple(turns.get(c - c % 5, [])[:h] + turns[c][h:])
    nodes = {t[:d] for t in whole.values() for d in range(len(t) + 1)}
    members = {v: sorted(c for c, t in whole.items() if t[: len(v)] == v) for v in nodes}
    childless = {v: not any(len(u) == len(v) + 1 and u[: len(v)] == v for u in nodes) for v in nodes}
    out = []
    for v in nodes:
        below = [u for u in nodes if u[: len(v)] == v]
        ends = ",".join(str(c) for c in members[v] if whole[c] == v)
        out.append((
            members[v][0], len(v), members[v[:-1]][0] if v else None, len(members[v]), sum(len(u) == len(v) + 1 for u in below),
            sum(childless[u] for u in below), sum((len(members[u]) - 1) * len(u[-1][1].encode()) for u in below if u),
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return out


def random_turns(n, seed, texts=3, longest=7):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(3 * n), n):
        shift = rng.choice([None, 0, 5])
        for i in range(rng.randint(1, longest)):
            turn = None if i == 0 and shift is None else i + (shift or 0)
            rows.append((c, turn, rng.choice(["user", None]), rng.choice(["é", "", None, "abc", "x" * 40][:texts])))
    rng.shuffle(rows)
    return rows


@pytest.fixture
def found(spark, docs, folder_of):
    def run(rows, parts=3, schema=SCHEMA):
        folder = folder_of(conversations=spark.createDataFrame(rows, schema).repartition(parts))
        result = queries()["op12_prefix_trie"](spark, folder)
        assert result.columns[:8] == prefix_trie.COLUMNS
        return sorted(map(repr, map(tuple, result.collect()))), folder

    return run


@pytest.mark.parametrize("n, seed, shard_bytes", [(1, 1, 1), (40, 2, 1), (120, 3, 3000), (150, 4, 1 << 25)])
def test_equals_brute_force(found, monkeypatch, n, seed, shard_bytes):
    monkeypatch.setattr(prefix_trie, "SHARD_BYTES", shard_bytes)
    rows = random_turns(n, seed, texts=2 + seed)
    assert found(rows)[0] == sorted(map(repr, brute_force(rows)))


def test_equals_sql_with_ties_and_turns_without_conversation(spark, found, against_sql, monkeypatch):
    monkeypatch.setattr(prefix_trie, "SHARD_BYTES", 5000)
    rows = random_turns(100, 9) + [(7, 1, "user", "a"), (7, 1, "user", "b"), (7, 1, "user", "b"), (-3, 0, "u", "n"), (None, 0, "u", "lost")]
    _, folder = found(rows)
    against_sql(spark, "op12_prefix_trie", folder)


@pytest.mark.parametrize("shard_bytes", [1, 4000, 1 << 25])
def test_one_conversation_many_times_and_a_long_one(found, monkeypatch, shard_bytes):
    monkeypatch.setattr(prefix_trie, "SHARD_BYTES", shard_bytes)
    rows = [(c, i, "user", f"turn {i}") for c in range(0, 300) for i in range(12)]
    rows += [(1000, i, "user", "first" if i == 0 else f"t{i}") for i in range(60)]
    rows += [(1001 + c, 0, "user", "turn 0") for c in range(20)]
    assert found(rows)[0] == sorted(map(repr, brute_force(rows)))


def test_extra_columns_and_empty_table(found):
    schema = SCHEMA + ", block int, own string, key int, sizes int, depth int"
    rows = [(*r, 1, "o", 2, 3, 4) for r in random_turns(10, 5)]
    assert found(rows, schema=schema)[0] == sorted(map(repr, brute_force([r[:4] for r in rows])))


def test_empty_table(found):
    assert found([])[0] == []


@pytest.mark.parametrize("seed, alphabet, width", [(1, 3, 6), (2, 256, 2), (3, 20, 3), (4, 60, 2)])
def test_radix_tree(seed, alphabet, width):
    rng = random.Random(seed)
    keys = {bytes(rng.randrange(alphabet) for _ in range(rng.randint(0, width))) for _ in range(3000)}
    tree = RadixTree()
    for key in rng.sample(sorted(keys), len(keys)):
        tree.insert(key, key)
    assert [n.value for n, _, _ in tree.preorder() if n.value is not None] == sorted(keys)
    for key in list(keys)[:100]:
        *_, last = tree.path_to(key)
        assert last.value == key
    for node, start, end in tree.preorder():
        n = len(node.ordered())
        assert n != 1 or node.value is not None or node is tree.root  # paths are compressed
        kind = type(node.children).__name__ + str(getattr(node.children, "capacity", ""))
        if n:
            assert kind == ("_Sorted4" if n <= 4 else "_Sorted16" if n <= 16 else "_Indexed" if n <= 48 else "_Direct")
        assert end - start == len(node.path) + 1
