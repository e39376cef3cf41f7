"""Conversation prefix trie with subtree totals by parallel tree contraction.

Rows of a conversation are put in order by ``turn`` (null first; equal turns by role, then
by digest of role and text). The table is sorted by ranges of (conversation, turn, ...),
so that a conversation with very many turns has many tasks; a task numbers its turns and
hashes every prefix with a polynomial modulo 2**127 - 1 over 127-bit digests of the turns.
Number and hash of what lies before a range follow from two rows a task, so a prefix has
the same hash wherever it was computed. The hash also joins two pieces: a rebuilt
conversation's prefixes come from the hashes of its two parts without reading texts again.
A node is a distinct (depth, hash); it is named by its smallest member and its depth.

Subtree totals are computed on the node table in rounds (``subtree_totals``): *rake* takes
every leaf away, adds its total to its parent and writes it down; *compress* takes out
unary nodes of which none is the parent of another, hooking the only child onto the
grandparent with the node's own sums on the new edge. Chosen are nodes by one bit of their
depth, which halves a chain, and in every second round by a hashed coin. When only the root
was left, the rounds are undone in reverse order: a node that was taken out has its own
sums plus its child's total, which is known by then. The number of rounds grows with the
logarithm of the tree's size, whatever its depth; counts of a node's children are map-side
combined, so a node with very many children is no hot spot.

Edge cases: null role or text is empty; rows with a null ``conv_id`` belong to no
conversation and are dropped; repeated rows are turns of their own; an empty table has no
root and gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import drop_written, written

PRIME = 2**127 - 1
BASE = int.from_bytes(hashlib.sha256(b"conversation prefix").digest()[:15], "big")
ROOT = bytes(16)
EMPTY = hashlib.sha256(b"").hexdigest()


@dataclass(frozen=True)
class TrieParams:
    family: int = 100  # a conversation is rebuilt on the first one of its hundred
    heads: int = 6  # it takes crc32(id) mod this many turns from there
    ids: int = 512  # identifiers in one piece of a member list


def as_int(b: bytes) -> int:
    return int.from_bytes(b, "big")


def as_bytes(v: int) -> bytes:
    return v.to_bytes(16, "big")


# --- prefixes ---------------------------------------------------------------


def prefixes(conversations: DataFrame) -> DataFrame:
    """conv_id, idx (from 0), before, hash (of the prefixes without and with the turn), chars: one row per turn."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        role.alias("role"),
        # the role's length goes first, so that role and text cannot be cut elsewhere
        F.unhex(F.sha2(F.concat_ws(":", F.char_length(role).cast("string"), role, text), 256)).alias("digest"),
        F.char_length(text).cast("bigint").alias("chars"),
    )
    by = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest"), F.col("chance")]
    turns = written(turns, "turns").withColumn("chance", F.monotonically_increasing_id())  # equal turns may lie in several ranges
    ranges = turns.repartitionByRange(*by).sortWithinPartitions(*by).select("conv_id", "digest", "chars")

    def scan(batches):
        part, conv, n, h, first, hashes = TaskContext.get().partitionId(), None, 0, 0, None, None
        for batch in batches:
            out = []
            for c, digest in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if c != conv:
                    if hashes is not None and first is None:
                        first = (conv, n, h)
                    conv, n, h = c, 0, 0
                before, h = h, (h * BASE + (as_int(digest[:16]) >> 1)) % PRIME
                hashes = h
                out.append((n, as_bytes(before), as_bytes(h)))
                n += 1
            k = len(out)
            if k:
                idx, before, after = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(idx, pa.int64()), pa.array(before, pa.binary()), pa.array(after, pa.binary()), batch.column(2), pa.array([part] * k, pa.int32()), pa.array([False] * k)], NAMES
                )
        if hashes is not None:  # sums of the first and of the last conversation of the range
            ends = [(conv, n, h)] if first is None else [first, (conv, n, h)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([e[0] for e in ends], pa.int64()), pa.array([e[1] for e in ends], pa.int64()), pa.array([b""] * len(ends), pa.binary()), pa.array([as_bytes(e[2]) for e in ends], pa.binary()), pa.array([0] * len(ends), pa.int64()), pa.array([part] * len(ends), pa.int32()), pa.array([True] * len(ends))], NAMES
            )

    rows = written(ranges.mapInArrow(scan, "conv_id bigint, idx bigint, before binary, hash binary, chars bigint, part int, ends boolean"), "prefixes")
    # two rows a task of the range sort at most
    ends: dict[int, list] = {}
    for r in rows.where("ends").collect():
        ends.setdefault(r.part, []).append((r.conv_id, r.idx, as_int(bytes(r.hash))))
    carry, open_ = {}, (None, 0, 0)
    for part in sorted(ends):
        pieces = sorted(ends[part])
        conv, n, h = pieces[0]
        if conv == open_[0]:
            carry[part] = open_
            h = (open_[2] * pow(BASE, n, PRIME) + h) % PRIME
            n += open_[1]
        open_ = pieces[-1] if len(pieces) > 1 else (conv, n, h)
    rows = rows.where("not ends")
    spans = rows.where(F.col("part").isin(list(carry))) if carry else rows.limit(0)
    whole = rows.where(~F.col("part").isin(list(carry))) if carry else rows

    def carried(batches):
        for batch in batches:
            out = []
            for c, i, before, after, part in zip(*(batch.column(k).to_pylist() for k in (0, 1, 2, 3, 5))):
                conv, n, h = carry[part]
                if c == conv:
                    power = pow(BASE, i, PRIME)
                    before, after, i = as_bytes((h * power + as_int(before)) % PRIME), as_bytes((h * power * BASE + as_int(after)) % PRIME), i + n
                out.append((i, before, after))
            idx, before, after = zip(*out) if out else ([], [], [])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(idx, pa.int64()), pa.array(before, pa.binary()), pa.array(after, pa.binary()), *batch.columns[4:]], NAMES)

    return spans.mapInArrow(carried, rows.schema).union(whole).select("conv_id", "idx", "before", "hash", "chars")


NAMES = ["conv_id", "idx", "before", "hash", "chars", "part", "ends"]


def rebuilt(turns: DataFrame, p: TrieParams) -> tuple[DataFrame, DataFrame]:
    """(prefixes of the rebuilt conversations, one row per conversation).

    The first has conv_id, depth, parent, hash, chars and ``ends`` (whether the conversation
    ends there) per turn; the second conv_id and ``turnless``.
    """
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % p.heads
    heads = turns.where(F.col("idx") < p.heads - 1)
    own = turns.groupBy("conv_id").agg((F.max("idx") + 1).alias("n"), F.max(F.when(F.col("idx") == h - 1, F.col("hash"))).alias("cut"))
    # at most heads - 1 rows each
    bases = heads.where(F.col("conv_id") % p.family == 0).groupBy(F.col("conv_id").alias("base"))
    bases = bases.agg(F.array_sort(F.collect_list(F.struct("idx", "before", "hash", "chars"))).alias("turns"))
    convs = own.withColumn("h", h).withColumn("base", F.col("conv_id") - F.col("conv_id") % p.family)
    convs = convs.join(bases, "base", "left").withColumn("turns", F.coalesce(F.slice("turns", F.lit(1), F.col("h")), F.array().cast("array<struct<idx:bigint,before:binary,hash:binary,chars:bigint>>")))
    convs = written(convs.withColumn("taken", F.size("turns").cast("bigint")).drop("base"), "conversations")
    head = convs.select("conv_id", "h", "n", "taken", F.explode("turns").alias("t"))
    ends = (F.col("t.idx") == F.col("taken") - 1) & (F.col("n") <= F.col("h"))
    head = head.select("conv_id", (F.col("t.idx") + 1).alias("depth"), F.col("t.before").alias("parent"), "t.hash", "t.chars", ends.alias("ends"))
    join = convs.select("conv_id", "h", "n", "taken", "cut", F.when(F.col("taken") > 0, F.element_at("turns", -1).getField("hash")).alias("joint"))
    tail = turns.join(join, "conv_id").where("idx >= h").select("conv_id", "idx", "before", "hash", "chars", "h", "n", "taken", "cut", "joint")

    def joined(batches):
        for batch in batches:
            out = []
            for i, before, after, hh, cut, joint in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3, 5, 8, 9))):
                shift = as_int(joint or ROOT) - as_int((cut if hh else None) or ROOT)
                if shift:
                    power = shift * pow(BASE, i - hh, PRIME)
                    before, after = as_bytes((as_int(before) + power) % PRIME), as_bytes((as_int(after) + power * BASE) % PRIME)
                out.append((before, after))
            before, after = zip(*out) if out else ([], [])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(before, pa.binary()), pa.array(after, pa.binary()), *batch.columns[4:8]], ["conv_id", "idx", "parent", "hash", "chars", "h", "n", "taken"])

    tail = tail.mapInArrow(joined, "conv_id bigint, idx bigint, parent binary, hash binary, chars bigint, h bigint, n bigint, taken bigint")
    tail = tail.select("conv_id", F.expr("taken + idx - h + 1").alias("depth"), "parent", "hash", "chars", (F.col("idx") == F.col("n") - 1).alias("ends"))
    return head.union(tail), convs.select("conv_id", ((F.col("taken") == 0) & (F.col("n") <= F.col("h"))).alias("turnless"))


# --- nodes ------------------------------------------------------------------


def nodes_of(members: DataFrame, convs: DataFrame) -> DataFrame:
    """conv_id, depth, hash, parent_conv_id, n_convs, chars: the distinct prefixes, named by their smallest member."""
    nodes = members.groupBy("depth", "hash").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.min("parent").alias("parent"), F.min("chars").alias("chars"))
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    root = root.select(F.lit(0).cast("bigint").alias("depth"), F.lit(ROOT).alias("hash"), "conv_id", "n_convs", F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("bigint").alias("chars"))
    nodes = written(nodes.union(root), "nodes")
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("hash").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return nodes.join(above, ["depth", "parent"], "left").drop("parent")


def member_hashes(ends: DataFrame, p: TrieParams) -> DataFrame:
    """depth, hash, ends_sha256 for nodes with conversations that end there.

    A list of identifiers may be very long and SHA-256 takes it in order: ranges of
    (node, conv_id) write it down in pieces of ``ids`` identifiers, and one stream over a
    node's few pieces hashes it without holding it.
    """
    by = ["depth", "hash", "conv_id"]

    def pieces(batches):
        key, ids = None, []

        def piece():
            return pa.RecordBatch.from_pydict({"depth": [key[0]], "hash": [key[1]], "least": [ids[0]], "ids": [",".join(map(str, ids))]}, schema)

        schema = pa.schema([("depth", pa.int64()), ("hash", pa.binary()), ("least", pa.int64()), ("ids", pa.string())])
        for batch in batches:
            done = []
            for d, h, c in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if (d, h) != key or len(ids) == p.ids:
                    if ids:
                        done.append(piece())
                    key, ids = (d, h), []
                ids.append(c)
            if done:
                yield pa.Table.from_batches(done).combine_chunks().to_batches()[0]
        if ids:
            yield piece()

    def hashed(batches):
        key, sha = None, None
        schema = pa.schema([("depth", pa.int64()), ("hash", pa.binary()), ("ends_sha256", pa.string())])
        for batch in batches:
            done = []
            for d, h, ids in zip(*(batch.column(k).to_pylist() for k in (0, 1, 3))):
                if (d, h) != key:
                    if sha:
                        done.append((*key, sha.hexdigest()))
                    key, sha = (d, h), hashlib.sha256(ids.encode())
                else:
                    sha.update(f",{ids}".encode())
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*done) if done else ([], [], []), schema)], schema=schema)
        if sha:
            yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((*key, sha.hexdigest()), schema)], schema=schema)

    cut = ends.repartitionByRange(*by).sortWithinPartitions(*by).select(by).mapInArrow(pieces, "depth bigint, hash binary, least bigint, ids string")
    cut = cut.repartition("depth", "hash").sortWithinPartitions("depth", "hash", "least")
    return cut.mapInArrow(hashed, "depth bigint, hash binary, ends_sha256 string")


# --- tree contraction -------------------------------------------------------


def subtree_totals(tree: DataFrame, sums: list[str], level: Column) -> DataFrame:
    """``tree`` (id, parent, sums) -> (id, sums): sums over each node's subtree, itself included.

    ``parent`` is null for roots. ``level`` is any whole number of a node that neighbours
    in a chain should not share; it only decides how fast chains get short.
    """
    edge = {s: f"edge {s}" for s in sums}  # what a node's parent gets on top of the node's total
    kids = tree.where("parent is not null").groupBy(F.col("parent").alias("id")).agg(F.count("*").alias("kids"))
    zero = F.lit(0).cast("bigint")
    live = tree.join(kids, "id", "left").select("id", "parent", level.cast("bigint").alias("level"), F.coalesce("kids", zero).alias("kids"), *sums, *(zero.alias(e) for e in edge.values()))
    live, rounds = written(live, "tree"), []
    while True:
        rounds.append(live)
        leaves = live.where("kids = 0")
        up = leaves.groupBy(F.col("parent").alias("id")).agg(F.count("*").alias("gone"), *(F.sum(F.col(s) + F.col(edge[s])).alias(f"up {s}") for s in sums))
        inner = live.where("kids > 0").join(up, "id", "left")
        raked = inner.select("id", "parent", "level", (F.col("kids") - F.coalesce("gone", zero)).alias("kids"), *((F.col(s) + F.coalesce(f"up {s}", zero)).alias(s) for s in sums), *edge.values())
        raked = written(raked, "raked")
        if raked.isEmpty():
            drop_written(raked)
            break
        turn = len(rounds) - 1
        coin = F.shiftright("level", turn // 2 % 60) % 2 != 0 if turn % 2 == 0 else F.xxhash64(F.lit(turn), "id") % 2 == 0
        tossed = raked.withColumn("chosen", F.col("parent").isNotNull() & (F.col("kids") == 1) & coin)
        over = tossed.select(F.col("id").alias("parent"), F.col("chosen").alias("over"))
        seen = tossed.join(over, "parent", "left").withColumn("out", F.col("chosen") & ~F.coalesce("over", F.lit(False)))
        out = seen.where("out").select(F.col("id").alias("parent"), F.struct(F.col("id"), F.col("parent").alias("above"), *sums, *edge.values()).alias("via"))
        # a node above one that is taken out gets that one's child instead, so numbers of children stay
        live = seen.where("not out").join(out, "parent", "left").select(
            "id",
            F.coalesce("via.above", "parent").alias("parent"),
            "level",
            "kids",
            *sums,
            *(F.expr(f"`{e}` + coalesce(via.`{s}` + via.`{e}`, 0)").alias(e) for s, e in edge.items()),
            F.when(F.col("via").isNotNull(), F.struct(F.col("via.id"), *(F.expr(f"via.`{s}` + `{e}`").alias(s) for s, e in edge.items()))).alias("via"),
        )
        live = written(live, "tree")
        drop_written(raked)
    # what was alive at the start of a round: its leaves, what it took out, and what was alive after it
    known = written(rounds[-1].select("id", *sums), "known")
    for before, after in zip(rounds[-2::-1], rounds[:0:-1]):
        back = after.where("via is not null").select("id", "via").join(known, "id").select("via.id", *((F.col(f"via.{s}") + F.col(s)).alias(s) for s in sums))
        new = written(known.union(back).union(before.where("kids = 0").select("id", *sums)), "known")
        drop_written(known, after)
        known = new
    drop_written(rounds[0])
    return known


def trie(conversations: DataFrame, p: TrieParams = TrieParams()) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 per node."""
    turns = written(prefixes(conversations), "turns")
    members, convs = rebuilt(turns, p)
    members = written(members, "members")
    nodes = written(nodes_of(members, convs), "named")
    none = [F.lit(0).cast("bigint").alias("depth"), F.lit(ROOT).alias("hash")]
    ends = members.where("ends").select("depth", "hash", "conv_id").union(convs.where("turnless").select(*none, "conv_id"))
    lists = member_hashes(ends, p)
    up = F.when(F.col("depth") > 0, F.struct(F.col("parent_conv_id").alias("c"), (F.col("depth") - 1).alias("d")))
    own = F.struct(F.col("conv_id").alias("c"), F.col("depth").alias("d"))
    kids = nodes.where("depth > 0").groupBy(up.alias("id")).agg(F.count("*").alias("n_children"))
    tree = nodes.select(own.alias("id"), up.alias("parent"), "hash", "n_convs", ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens"))
    tree = written(tree.join(kids, "id", "left").withColumn("n_leaves", F.col("n_children").isNull().cast("bigint")), "tree")
    totals = subtree_totals(tree, ["n_leaves", "saved_tokens"], F.col("id.d"))
    rows = tree.drop("n_leaves", "saved_tokens").join(totals, "id").withColumn("depth", F.col("id.d"))
    return rows.join(lists, ["depth", "hash"], "left").select(
        F.col("id.c").alias("conv_id"),
        "depth",
        F.col("parent.c").alias("parent_conv_id"),
        "n_convs",
        F.coalesce("n_children", F.lit(0).cast("bigint")).alias("n_children"),
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"),
    )


ORACLE = """
WITH turns AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS idx
  FROM conversations WHERE conv_id IS NOT NULL
),
crc AS (  -- CRC-32 of the decimal identifier, bit by bit
  SELECT c, xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda x: ord(x)::BIGINT)),
    lambda a, b: list_reduce(list_prepend(xor(a, b), list_transform(range(8), lambda x: x::BIGINT)),
                             lambda v, i: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)
  ), 4294967295) % 6 AS h
  FROM (SELECT DISTINCT c FROM turns)
),
convs AS (SELECT c, count(*) AS n, any_value(h) AS h, c - c % 100 AS base FROM turns JOIN crc USING (c) GROUP BY c),
built AS (
  SELECT k.c, t.idx + 1 AS d, t.role, t.text FROM convs k JOIN turns t ON t.c = k.base AND t.idx < k.h
  UNION ALL
  SELECT k.c, coalesce(least(k.h, b.n), 0) + t.idx - k.h + 1, t.role, t.text
  FROM convs k JOIN turns t ON t.c = k.c AND t.idx >= k.h LEFT JOIN convs b ON b.c = k.base
),
members AS (
  SELECT c, d, list({'role': role, 'text': text}) OVER (PARTITION BY c ORDER BY d ROWS UNBOUNDED PRECEDING) AS seq, length(text) AS chars FROM built
  UNION ALL
  SELECT c, 0, [], 0 FROM convs
),
nodes AS (SELECT d, seq, min(c) AS c, count(*) AS n_convs, max(chars) AS chars FROM members GROUP BY d, seq),
named AS (SELECT m.c AS member, m.d, n.c FROM members m JOIN nodes n ON m.d = n.d AND m.seq = n.seq),
above AS (SELECT n.c, n.d, a.c AS top, a.d AS top_d FROM nodes n JOIN named a ON a.member = n.c AND a.d <= n.d),
kids AS (SELECT top AS c, top_d AS d, count(*) AS n_children FROM above WHERE top_d = d - 1 GROUP BY top, top_d),
ends AS (
  SELECT x.c, x.d, sha256(string_agg(x.member::VARCHAR, ',' ORDER BY x.member)) AS ends_sha256
  FROM named x JOIN (SELECT member, max(d) AS d FROM named GROUP BY member) l ON l.member = x.member AND l.d = x.d GROUP BY x.c, x.d
),
totals AS (
  SELECT a.top AS c, a.top_d AS d, count(*) FILTER (WHERE k.c IS NULL) AS n_leaves, sum((n.n_convs - 1) * n.chars) AS saved_tokens
  FROM above a JOIN nodes n ON n.c = a.c AND n.d = a.d LEFT JOIN kids k ON k.c = a.c AND k.d = a.d GROUP BY a.top, a.top_d
)
SELECT n.c AS conv_id, n.d AS depth, p.top AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children,
       t.n_leaves, t.saved_tokens::BIGINT AS saved_tokens, coalesce(e.ends_sha256, sha256('')) AS ends_sha256
FROM nodes n
JOIN totals t ON t.c = n.c AND t.d = n.d
LEFT JOIN above p ON p.c = n.c AND p.d = n.d AND p.top_d = n.d - 1
LEFT JOIN kids k ON k.c = n.c AND k.d = n.d
LEFT JOIN ends e ON e.c = n.c AND e.d = n.d
"""
