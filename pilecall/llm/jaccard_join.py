"""Exact word-shingle Jaccard join with token-combination prefixes, and its components.

Two texts link when their sets of 5-word shingles have a Jaccard similarity of 0.75 or
more. The join finds every link that joins two different groups, in these steps:

1. *Zones.* Shingles are ordered by hash. A set of ``n`` shingles has at most
   ``n // 4`` shingles outside a linked set, so the first ``n // 4 + extra(n)`` of them
   (its zone) share at least ``need(n)`` shingles with the partner's zone.
2. *Frequencies.* Exact document frequencies of all zone shingles; those found in one
   zone only can't match.
3. *Signatures.* Inside the zone the shingles are ordered by frequency, rare ones
   first. Rare shingles are indexed alone. Frequent ones are dealt by hash into small
   classes and indexed as two-shingle combinations; since a class of ``c`` shingles
   then withstands ``c - 1`` misses, the prefix is extended until all its classes
   together withstand every allowed miss. A zone too small for that indexes each
   shingle alone as well.
4. *Pairs.* Every member of a signature is compared with the closest of its signatures'
   hubs (a hub is the member whose zone is the most shared). The members of all
   signatures whose hubs ended in one component are a family and are compared with its
   centre. Members that still are in other components than the centre are then compared
   with the family's other members; what each shares with the centre, and how much of
   the rest some other set holds, bounds what two of them can share, so most pairs end
   there, as do pairs of unfit sizes or with too many unshared zone shingles. Every
   compared pair is verified on the full sets.

Documents with equal sets are one node from the start.

Edge cases: null, empty and blank texts have an empty set and link with nothing; a text
with fewer than five words has one shingle; repeated rows are copies of each other; a
null ``doc_id`` takes part and is ignored by the smallest identifier of its component
(null when the component has no other); extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_written, release, slices, written
from .graph import components

_MULT = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class JoinParams:
    words: int = 5  # words in a shingle
    frequent: int = 64  # zones that hold a shingle, from which on it is indexed in combinations
    class_size: int = 10  # frequent shingles of a prefix in one class, about


def mixed(x: np.ndarray) -> np.ndarray:
    """Final mixing of 64-bit hashes (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """Hash of each word, kept while the table is small."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 400_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case."""
    return (text or "").encode("utf-8", "replace").lower().split()


def shingle_set(text: str | None, memo: WordHashes, k: int = 5) -> np.ndarray:
    """Sorted distinct shingle hashes; fewer than ``k`` words make one shingle."""
    words = words_of(text)
    n = len(words)
    if not n:
        return np.empty(0, np.int64)
    h = np.fromiter(map(memo.__getitem__, words), np.uint64, n)
    with np.errstate(over="ignore"):
        width = min(n, k)
        acc = np.full(n - width + 1, width, np.uint64)
        for i in range(width):
            acc = mixed(acc * _MULT + h[i : n - width + 1 + i])
    return np.unique(acc.view(np.int64))


def extra(n):
    """Shingles that a zone holds beyond the allowed misses."""
    return 2 + n // 20


def zone_size(n: int) -> int:
    return min(n, n // 4 + extra(n))


def need(n: int) -> int:
    """Zone shingles that a set of ``n`` shares with the zone of any linked set (sizes from 3n/4 on)."""
    least = -(-3 * n // 4)
    return min(extra(least), least - least // 4) if n else 0


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with _key1, _key2: a 128-bit key of each row's identifier and text, the same at every reading."""
    row = (F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return docs.withColumns({"_key1": F.xxhash64(*row), "_key2": F.xxhash64(F.lit("row"), *row)})


def zones(docs: DataFrame, p: JoinParams = JoinParams()) -> DataFrame:
    """node, doc_id, _key1, _key2 (key of the row), n (set size), digest (of the set), zone (first shingle hashes): one row per document, written."""
    k = p.words

    def run(batches):
        memo = WordHashes()
        for batch in slices(batches):
            sets = [shingle_set(t, memo, k) for t in batch.column("text").to_pylist()]
            parts = [s[: zone_size(len(s))] for s in sets]
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int32)
            zone = pa.ListArray.from_arrays(offsets, np.concatenate(parts) if parts else np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("doc_id", "_key1", "_key2")),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                    zone,
                ],
                names=["doc_id", "_key1", "_key2", "n", "digest", "zone"],
            )

    schema = "doc_id bigint, _key1 bigint, _key2 bigint, n bigint, digest binary, zone array<bigint>"
    rows = keyed(docs).select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), "_key1", "_key2")
    found = rows.mapInArrow(run, schema)
    return written(found.select(F.monotonically_increasing_id().alias("node"), "*"), "zones")


def signatures_of(shingles: np.ndarray, df: np.ndarray, n: int, p: JoinParams) -> set[int]:
    """Signatures of one zone: ``shingles`` found in ``df`` > 1 zones, of a set of ``n``."""
    size, required = zone_size(n), need(n)
    if len(shingles) < required:
        return set()  # no linked set can share enough of this zone
    order = np.lexsort((shingles, df))
    shingles, df = shingles[order], df[order]
    unmatched = size - len(shingles)  # in this zone only: rare, first in order, never indexed
    target = size - required + 1
    rare = df < p.frequent
    out: set[int] = set()
    bucket = int(np.log(n) / np.log(4 / 3) + 1e-9) if n > 0 else 0
    for scheme in (bucket, bucket + 1):  # a linked set is in the same size bucket or the next one
        classes = max(1, int((4 / 3) ** scheme / (4 * p.class_size)))
        with np.errstate(over="ignore"):
            dealt = mixed(shingles.view(np.uint64) ^ np.uint64(scheme + 1)) % np.uint64(classes)
        held: dict[int, list[int]] = {}
        reached = unmatched
        for s, single, c in zip(shingles.tolist(), rare.tolist(), dealt.tolist()):
            if reached >= target:
                break
            if single:
                out.add(s)
                reached += 1
            else:
                reached += c in held  # the first of a class withstands nothing
                held.setdefault(c, []).append(s)
        for group in held.values():
            for i, x in enumerate(group):
                out.update(xxhash.xxh3_64_intdigest(b"%d %d %d" % (scheme, min(x, y), max(x, y))) - (1 << 63) for y in group[:i])
        if reached < target:
            out.update(shingles.tolist())
    return out


def signatures(zoned: DataFrame, p: JoinParams = JoinParams()) -> DataFrame:
    """sig, node, n, last (largest zone hash), lone (zone shingles of no other zone), shared: one row per signature."""
    tokens = zoned.select("node", F.explode("zone").alias("h"))
    freq = written(tokens.groupBy("h").agg(F.count("*").alias("df")).where("df > 1"), "frequencies")
    release(zoned.sparkSession)
    matched = tokens.join(freq, "h").groupBy("node").agg(F.collect_list(F.struct("h", "df")).alias("tokens"))
    # the zone's last hash and the set's size travel apart from the token rows
    heads = zoned.select("node", "n", F.element_at("zone", -1).alias("last"))

    def run(batches):
        for batch in slices(batches):
            nodes, sizes, lasts = (batch.column(c).to_pylist() for c in ("node", "n", "last"))
            col = batch.column("tokens")
            offsets = np.asarray(col.offsets)
            flat = col.values
            h, df = np.asarray(flat.field(0)), np.asarray(flat.field(1))
            out = {"sig": [], "node": [], "n": [], "last": [], "lone": [], "shared": []}
            for i, n in enumerate(sizes):
                part = slice(offsets[i], offsets[i + 1])
                sigs = sorted(signatures_of(h[part], df[part], n, p))
                lone = zone_size(n) - (part.stop - part.start)
                weight = float(np.log2(df[part]).sum()) / zone_size(n)
                row = (nodes[i], n, lasts[i], lone, weight)
                out["sig"] += sigs
                for name, value in zip(("node", "n", "last", "lone", "shared"), row):
                    out[name] += [value] * len(sigs)
            kinds = [pa.int64()] * 5 + [pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), kinds)], names=list(out))

    schema = "sig bigint, node bigint, n bigint, last bigint, lone bigint, shared double"
    found = written(matched.join(heads, "node").mapInArrow(run, schema), "signatures")
    drop_written(freq)
    release(zoned.sparkSession)
    sizes = found.groupBy("sig").agg(F.count("*").alias("members")).where("members > 1").select("sig")
    shared = written(found.join(sizes, "sig"), "shared-signatures")
    drop_written(found)
    return shared


def fits(x: str, y: str):
    """Whether the pair can link: sizes, and the lone zone shingles of the side whose zone ends first."""
    def c(side, name):
        return F.col(f"{side}.{name}")

    least = F.ceil(3 * (c(x, "n") + c(y, "n")) / 7)  # of shared shingles, at a similarity of 3/4
    ends = F.when(c(x, "last") <= c(y, "last"), c(x, "lone") + least <= c(x, "n")).otherwise(c(y, "lone") + least <= c(y, "n"))
    sizes = 4 * F.least(c(x, "n"), c(y, "n")) >= 3 * F.greatest(c(x, "n"), c(y, "n"))
    return sizes & ends


def compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` (a, b) with the number of shingles that their full sets share, and whether that links them."""
    left = sets.select(F.col("node").alias("b"), F.col("items").alias("y"))
    right = sets.select(F.col("node").alias("a"), F.col("items").alias("x"))
    both = pairs.join(left, "b").join(right, "a").withColumn("inter", F.size(F.array_intersect("x", "y")).cast("bigint"))
    linked = 100 * F.col("inter") >= 75 * (F.size("x") + F.size("y") - F.col("inter"))
    return both.select("a", "b", "inter", linked.alias("linked"))


def own_texts(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """node, text, digest: the texts of ``nodes``, each met by its own row (and its repetitions) only."""
    texts = keyed(docs).select("_key1", "_key2", F.col("text").cast("string").alias("text"))
    return texts.join(nodes, ["_key1", "_key2"]).select("node", "text", "digest")


def full_sets(docs: DataFrame, nodes: DataFrame, wanted: DataFrame, p: JoinParams) -> DataFrame:
    """node, items (all shingle hashes) of the nodes in ``wanted``, written."""
    ids = nodes.join(wanted, "node", "left_semi")
    k = p.words

    def run(batches):
        memo, seen = WordHashes(), set()  # a repeated row meets its node again, in the same task
        for batch in slices(batches):
            found, sets = batch.column("node").to_pylist(), batch.column("text").to_pylist()
            sets = [None if n in seen else shingle_set(t, memo, k) for n, t in zip(found, sets)]
            digests = batch.column("digest").to_pylist()
            keep = []
            for i, s in enumerate(sets):
                if s is not None and found[i] not in seen and xxhash.xxh3_128_digest(s.tobytes()) == digests[i]:
                    keep.append(i)
                    seen.add(found[i])
            offsets = np.concatenate([[0], np.cumsum([len(sets[i]) for i in keep])]).astype(np.int32)
            items = pa.ListArray.from_arrays(offsets, np.concatenate([np.empty(0, np.int64), *(sets[i] for i in keep)]))
            yield pa.RecordBatch.from_arrays([batch.column("node").take(pa.array(keep, pa.int64())), items], names=["node", "items"])

    return written(own_texts(docs, ids).mapInArrow(run, "node bigint, items array<bigint>"), "sets")


def relabelled(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (node, label) after joining the components that ``links`` connect."""
    a = labels.select(F.col("node").alias("a"), F.col("label").alias("la"))
    b = labels.select(F.col("node").alias("b"), F.col("label").alias("lb"))
    joined = components(links.join(a, "a").join(b, "b").select(F.col("la").alias("a"), F.col("lb").alias("b")))
    joined = joined.select(F.col("node").alias("label"), F.col("label").alias("to"))
    return written(labels.join(joined, "label", "left").select("node", F.coalesce("to", "label").alias("label")), "joined")


def linked_nodes(docs: DataFrame, nodes: DataFrame, sigs: DataFrame, p: JoinParams) -> DataFrame:
    """node, label: the components among the nodes that share a signature."""
    spark = docs.sparkSession
    facts = written(sigs.groupBy("node").agg(*(F.first(c).alias(c) for c in ("n", "last", "lone", "shared"))), "facts")
    members = facts.select("node")
    hub = F.max_by(F.struct("node", "n", "last", "lone"), F.struct("shared", -F.col("node")))
    hubs = written(sigs.groupBy("sig").agg(hub.alias("hub")).select("sig", "hub.*"), "hubs")
    star = sigs.alias("y").join(hubs.alias("x"), "sig").where((F.col("x.node") != F.col("y.node")) & fits("x", "y"))
    star = star.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).groupBy("a", "b").agg(F.count("*").alias("common"))
    closest = star.groupBy("b").agg(F.max_by("a", F.struct("common", -F.col("a"))).alias("a")).select("a", "b")
    closest = written(closest, "closest")
    release(spark)
    sets = full_sets(docs, nodes, members, p)
    release(spark)

    def join_by(labels: DataFrame, pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
        checked = written(compared(pairs, sets), "checked")
        after = relabelled(labels, checked.where("linked").select("a", "b"))
        drop_written(labels)
        release(spark)
        return after, checked

    labels, first = join_by(written(members.withColumn("label", F.col("node")), "joined"), closest)
    # A family: the members of all signatures whose hubs are in one component by now, around the component's
    # most shared hub. Two members of a signature are in one family at least.
    hub_labels = hubs.select("sig", "node").join(labels, "node").select("sig", F.col("label").alias("family"))
    family = written(sigs.select("sig", "node").join(hub_labels, "sig").groupBy("family", "node").agg(F.lit(1).alias("one")), "family")
    drop_written(sigs)
    centre = hubs.select("node").distinct().join(labels, "node").join(facts.select("node", "shared"), "node")
    centre = centre.groupBy(F.col("label").alias("family")).agg(F.max_by("node", F.struct("shared", -F.col("node"))).alias("a"))
    family = written(family.join(centre, "family").where(F.col("a") != F.col("node")).select("a", "node"), "families")
    drop_written(hubs, closest)
    labels, second = join_by(labels, family.select("a", F.col("node").alias("b")))
    # Members that are not in their centre's component against the other members. What two sets share is in the
    # centre and in both, or not in the centre and in another set.
    inside = second.select("a", F.col("b").alias("node"), "inter").dropDuplicates(["a", "node"])
    around = inside.join(labels, "node").join(labels.select(F.col("node").alias("a"), F.col("label").alias("main")), "a")
    several = around.where("label <> main").select("a").distinct()
    around = written(around.join(several, "a", "left_semi").join(facts.drop("shared"), "node"), "around")
    # shingles that no other of these sets holds are shared with none of them
    still = around.select("node").union(around.select("a")).distinct()
    items = sets.join(still, "node", "left_semi").select("node", F.explode("items").alias("item"))
    alone = items.groupBy("item").agg(F.count("*").alias("k"), F.min("node").alias("node")).where("k = 1")
    alone = written(alone.groupBy("node").agg(F.count("*").alias("alone")), "alone")
    rest = around.join(alone, "node", "left").withColumn("outside", F.col("n") - F.coalesce("alone", F.lit(0)) - F.col("inter"))
    rest = written(rest.select("a", "node", "label", "main", "n", "last", "lone", "inter", "outside"), "rest")
    x, y = rest.where("label <> main").alias("x"), rest.alias("y")
    most = F.least("x.inter", "y.inter") + F.least("x.outside", "y.outside")
    once = (F.col("y.label") == F.col("y.main")) | (F.col("x.node") < F.col("y.node"))
    across = x.join(
        y,
        (F.col("x.a") == F.col("y.a")) & (F.col("x.label") != F.col("y.label")) & once
        & fits("x", "y") & (7 * most >= 3 * (F.col("x.n") + F.col("y.n"))),
    )
    across = across.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()
    labels, last = join_by(labels, across)
    drop_written(facts, family, around, rest, alone, sets, first, second, last)
    return labels


def grouped(docs: DataFrame, p: JoinParams = JoinParams()) -> tuple[DataFrame, DataFrame]:
    """Rows (node, doc_id, key, n, digest: one per document), and for each digest of a set that isn't empty its
    component's smallest identifier and first row (by identifier, nulls last, then node)."""
    every = zones(docs, p)
    first = every.where("n > 0").groupBy("digest").agg(F.min("node").alias("node"))
    zoned = written(every.join(first.select("node"), "node", "left_semi"), "distinct-zones")
    rows = written(every.select("node", "doc_id", "_key1", "_key2", "n", "digest"), "rows")
    drop_written(every)
    release(docs.sparkSession)
    sigs = signatures(zoned, p)
    nodes = written(zoned.select("node", "_key1", "_key2", "digest"), "nodes")
    drop_written(zoned)
    labels = linked_nodes(docs, nodes, sigs, p)
    # a set's label; the first row of each label, map-side combined
    labelled = nodes.join(labels, "node", "left").select("digest", F.coalesce("label", "node").alias("label"))
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "node", "_key1", "_key2")
    lowest = rows.where("n > 0").groupBy("digest").agg(F.min(place).alias("lowest")).join(labelled, "digest")
    ids = lowest.groupBy("label").agg(F.min("lowest").alias("first"))
    named = lowest.join(ids, "label").select("digest", F.col("first.doc_id").alias("component_id"), "first")
    named = written(named, "named")
    drop_written(nodes, labels)
    release(docs.sparkSession)
    return rows, named


def near_duplicates(docs: DataFrame, p: JoinParams = JoinParams()) -> DataFrame:
    """doc_id, n_shingles, component_id: one row per document."""
    rows, named = grouped(docs, p)
    out = rows.join(named.select("digest", "component_id"), "digest", "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def keep_one(docs: DataFrame, p: JoinParams = JoinParams()) -> DataFrame:
    """One row of each component, its first by identifier (nulls last); columns unchanged, repeated rows once.

    Rows without words are near nothing and all stay, but for repetitions of one identifier and text.
    """
    rows, named = grouped(docs, p)
    key = ["_key1", "_key2"]
    wordless = rows.where("n = 0")
    once = named.select("first._key1", "first._key2").union(wordless.where("doc_id is not null").select(key)).distinct()
    kept = keyed(docs).join(once, key, "left_semi").dropDuplicates(key).select(docs.columns)
    loose = wordless.where("doc_id is null").select(key).distinct()
    return kept.union(keyed(docs.where(F.col("doc_id").isNull())).join(loose, key, "left_semi").select(docs.columns))
