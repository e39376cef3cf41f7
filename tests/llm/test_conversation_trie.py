import collections
import hashlib
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from pilecall.llm import conversation_trie as T
from pilecall.llm.common import table

from .edge import SF

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def brute(rows):
    """The contract by nested dictionaries of whole sequences."""
    convs = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}:{text}".encode()).digest()
            convs[c].append((turn is not None, turn or 0, role, digest, text))
    convs = {c: [(r, t) for _, _, r, _, t in sorted(x)] for c, x in convs.items()}
    built = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        built[c] = tuple(convs.get(base, [])[:h] + own[h:])
    members = collections.defaultdict(set)
    for c, x in built.items():
        for d in range(len(x) + 1):
            members[x[:d]].add(c)
    kids = collections.Counter(x[:-1] for x in members if x)
    leaves, saved = collections.Counter(), collections.Counter()
    for x, who in members.items():
        for d in range(len(x) + 1):
            leaves[x[:d]] += x not in kids
            saved[x[:d]] += (len(who) - 1) * len(x[-1][1]) if x else 0
    out = []
    for x, who in members.items():
        ends = ",".join(map(str, sorted(c for c in who if built[c] == x)))
        out.append((min(who), len(x), min(members[x[:-1]]) if x else None, len(who), kids[x], leaves[x], saved[x], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def test_trie_of_the_table(spark):
    t = table(spark, SF, "conversations")
    got = T.trie(t)
    assert got.columns == COLUMNS
    want = brute([(r.conv_id, r.turn, r.role, r.text) for r in t.collect()])
    assert rows_of(got) == want
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    assert sorted(con.sql(T.ORACLE).project(", ".join(COLUMNS)).fetchall(), key=repr) == want


def test_random_tries(spark):
    rng = random.Random(2)
    rows = []
    for c in rng.sample(range(-250, 900), 300):
        for k in range(rng.randrange(1, 9)):
            rows.append((c, rng.choice([k, k, None, 3]), rng.choice(["user", "assistant", None, ""]), rng.choice(["a", "bb", "", None, "\U0001f600x"])))
    rng.shuffle(rows)
    assert rows_of(T.trie(spark.createDataFrame(rows, SCHEMA).repartition(7))) == brute(rows)


def test_one_conversation_with_a_third_of_all_turns(spark):
    """It spans several ranges of the sort, equal turns included, and its chain needs few rounds."""
    long = [(300, None if k % 7 == 0 else k // 3, "user", f"t{k % 5}") for k in range(600)]
    rows = long + [(c, k, "user", f"t{k % 4}") for c in range(400, 700) for k in range(4)]
    got = T.trie(spark.createDataFrame(rows, SCHEMA).repartition(6))
    assert rows_of(got) == brute(rows)


def test_contraction_on_chains_stars_and_caterpillars(spark):
    rng = random.Random(4)
    shapes = {
        "chain": [max(-1, i - 1) for i in range(300)],
        "star": [-1] + [0] * 200,
        "caterpillar": [-1] + [i - 1 if i % 2 else max(0, i - 2) for i in range(1, 300)],
        "random": [-1] + [rng.randrange(i) for i in range(1, 300)],
        "two roots": [-1, -1, 0, 1, 3, 4],
    }
    rows, want = [], {}  # one forest of them all
    for parent in shapes.values():
        at, weight = len(rows), [rng.randrange(100) for _ in parent]
        total = list(weight)
        for i in reversed(range(len(parent))):
            if parent[i] >= 0:
                total[parent[i]] += total[i]
        rows += [(at + i, at + p if p >= 0 else None, w) for i, (p, w) in enumerate(zip(parent, weight))]
        want |= {at + i: t for i, t in enumerate(total)}
    tree = spark.createDataFrame(rows, "id bigint, parent bigint, w bigint")
    assert {r.id: r.w for r in T.subtree_totals(tree, ["w"], F.col("id")).collect()} == want


def test_odd_rows(spark):
    rows = [(None, 1, "user", "x"), (5, None, None, None), (5, None, None, None), (7, 1, "", "y"), (105, 0, "user", "x" * 100_000)]
    t = spark.createDataFrame(rows, SCHEMA).withColumn("depth", F.lit(1)).withColumn("hash", F.lit("x")).withColumn("idx", F.lit(None).cast("int"))
    assert rows_of(T.trie(t)) == brute(rows)
    assert T.trie(spark.createDataFrame([], SCHEMA)).collect() == []
    assert T.trie(spark.createDataFrame(rows[:1], SCHEMA)).collect() == []


@pytest.mark.parametrize("ids", [1, 3, 10_000])
def test_member_lists_in_pieces(spark, ids):
    ends = [(1, b"a", c) for c in range(100)] + [(1, b"b", 7), (2, b"a", 5), (2, b"a", -5)]
    got = T.member_hashes(spark.createDataFrame(ends, "depth bigint, hash binary, conv_id bigint").repartition(3), T.TrieParams(ids=ids)).collect()
    want = {(1, b"a"): ",".join(map(str, range(100))), (1, b"b"): "7", (2, b"a"): "-5,5"}
    assert {(r.depth, bytes(r.hash)): r.ends_sha256 for r in got} == {k: hashlib.sha256(v.encode()).hexdigest() for k, v in want.items()}
