"""Removal of repeated 100-byte strings by suffix arrays, built by linear grouping.

Every byte covered by a ``length``-byte string that starts earlier in the corpus goes.
Windows of ``length`` bytes are assigned to anchors (the window's byte 32-gram of
smallest hash, the first one on a tie), so equal windows have equal anchors at equal
offsets. Only windows of repeated anchors can be repeated:

1. *Segments.* The consecutive windows of one anchor are one segment. Of equal segments
   all but the first go whole (a map-side combined minimum, joined back).
2. *Bands.* First segments whose anchor has other segments as well are cut into bands of
   ``band`` windows. All windows of a band hold the same core of bytes; equal bands are
   treated as in 1.
3. *Suffix arrays.* Different bands with the same core may share some windows. Their
   texts, the core as one symbol, are concatenated with separators, and the suffix array
   is built by linear grouping: groups of suffixes with equal Lyndon prefixes are
   processed in descending order, each splits off the previous-smaller positions of its
   members by how many point there, and the groups' orders are emitted by following the
   same pointers; nothing is renamed or solved recursively. Suffixes that agree on a
   window's symbols are neighbours in it; all but the first in the corpus are removed.
   Cores with more than ``group_limit`` different bands, which no task should hold, are
   resolved window by window in Spark instead.

The runs removed from a document are merged when the document is read again.

Edge cases: null texts are empty; texts shorter than ``length`` bytes have no window;
rows that repeat a ``doc_id`` are the same document and don't remove each other; rows
without ``doc_id`` have no place in the order and are kept whole; extra columns are
ignored.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_written, release, slices, written
from .jaccard_join import mixed


@dataclass(frozen=True)
class SuffixParams:
    length: int = 100  # bytes
    gram: int = 32  # bytes of an anchor
    band: int = 10  # windows
    group_limit: int = 2000  # different bands of one core in one suffix array


CHUNK = 1 << 20  # bytes hashed at once
POSITION = np.uint64(CHUNK - 1)
BASE = 0x9E3779B97F4A7C15
TABLE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE)) | np.uint64(1)


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Anchors:
    """Segments of a text: the windows of each anchor."""

    def __init__(self, p: SuffixParams):
        self.p = p
        self.up, self.down = powers(BASE, CHUNK + 1), powers(pow(BASE, -1, 1 << 64), CHUNK + 1)

    def _chunk(self, raw: np.ndarray, windows: int) -> tuple[np.ndarray, ...]:
        length, k = self.p.length, self.p.gram
        n, width = len(raw), length - k + 1
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(TABLE[raw] * self.up[:n], out=total[1:])
        grams = mixed((total[k:] - total[:-k]) * self.down[: n - k + 1])
        least = (grams & ~POSITION) | np.arange(len(grams), dtype=np.uint64)  # the first one on a tie
        size = 1
        while size * 2 <= width:
            least = np.minimum(least[:-size], least[size:])
            size *= 2
        if size < width:
            least = np.minimum(least[: size - width], least[width - size :])
        at = (least[:windows] & POSITION).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        end = np.append(first[1:], windows) - 1 + length
        at = at[first]
        shape = (at - first).astype(np.uint64) * np.uint64(1000003) + (end - first).astype(np.uint64)
        segment = mixed(mixed((total[end] - total[first]) * self.down[first]) + shape)
        return grams[at].view(np.int64), segment.view(np.int64), first, end - first, at - first

    def segments(self, raw: np.ndarray) -> list[np.ndarray]:
        """Anchor hash, segment hash, start, bytes and place of the anchor of every segment."""
        length, step = self.p.length, CHUNK - self.p.length
        parts = []
        for at in range(0, max(0, len(raw) - length + 1), step):
            part = raw[at : at + CHUNK]
            anchor, segment, first, size, place = self._chunk(part, min(len(part) - length + 1, step))
            parts.append((anchor, segment, first + at, size, place))
        return [np.concatenate(x) for x in zip(*parts)] if parts else [np.empty(0, np.int64)] * 5


def suffix_array(text: list[int]) -> list[int]:
    """Suffix array by linear grouping."""
    n = len(text)
    unset = n + 1
    first = sorted(set(text))
    number = {c: g for g, c in enumerate(first)}
    group = [number[c] for c in text]
    members: list[set[int]] = [set() for _ in first]
    for i, g in enumerate(group):
        members[g].add(i)
    lower, higher = list(range(-1, len(first) - 1)), [*range(1, len(first)), -1]
    smaller = [unset] * n  # nearest earlier position of a lower group; -1: none
    top = len(first) - 1
    g = top
    while g >= 0:
        pointed: dict[int, int] = {}
        for i in sorted(members[g]):
            j = i - 1
            while j >= 0 and smaller[j] != unset:
                j = smaller[j]
            smaller[i] = j
            if j >= 0:
                pointed[j] = pointed.get(j, 0) + 1
        if pointed:
            split: dict[tuple[int, int], list[int]] = {}
            for j, times in pointed.items():
                split.setdefault((-times, group[j]), []).append(j)
            for (_, old), moved in sorted(split.items()) if len(split) > 1 else split.items():
                if len(moved) == len(members[old]):
                    continue  # the whole group stays where it is, as the new one
                new = len(members)
                members[old].difference_update(moved)
                members.append(set(moved))
                for j in moved:
                    group[j] = new
                above = higher[old]
                lower.append(old)
                higher.append(above)
                higher[old] = new
                if above >= 0:
                    lower[above] = new
        g = lower[g]
    # emission: each group's interval, filled in the order in which the pointers are met
    while higher[top] >= 0:
        top = higher[top]
    place, at, g = [0] * len(members), n + 1, top
    while g >= 0:
        at -= len(members[g])
        place[g] = at
        g = lower[g]
    out = [0] * (n + 1)
    out[0] = n
    for k in range(n + 1):
        j = out[k] - 1
        while j >= 0 and smaller[j] != unset:
            g = group[j]
            out[place[g]] = j
            place[g] += 1
            smaller[j], j = unset, smaller[j]
    return out[1:]


def shared_prefixes(text: list[int], order: list[int]) -> list[int]:
    """Length of the common prefix of each suffix with the one before it in ``order``."""
    rank = [0] * len(text)
    for k, i in enumerate(order):
        rank[i] = k
    out, h = [0] * len(text), 0
    for i, k in enumerate(rank):
        if k:
            j = order[k - 1]
            stop = len(text) - max(i, j)
            while h < stop and text[i + h] == text[j + h]:
                h += 1
            out[k] = h
            h = max(0, h - 1)
        else:
            h = 0
    return out


CORE = 256


def repeated_windows(bands: list[tuple[bytes, bytes]], size: int) -> list[list[tuple[int, int]]]:
    """Classes of equal windows among bands (left, right) of one core: lists of (band, bytes left of the core).

    ``size``: symbols of a window, the core counting as one.
    """
    text: list[int] = []
    owner: list[int] = []
    start = []
    for k, (left, right) in enumerate(bands):
        start.append(len(text))
        text += [*left, CORE, *right, CORE + 1 + k]
        owner += [k] * (len(left) + len(right) + 2)
    order = suffix_array(text)
    common = shared_prefixes(text, order)
    classes: list[list[tuple[int, int]]] = []
    run = False
    for k in range(1, len(order)):
        if common[k] < size:
            run = False
            continue
        i, j = order[k], order[k - 1]
        if not run:
            b = owner[j]
            classes.append([(b, len(bands[b][0]) - (j - start[b]))])
        b = owner[i]
        classes[-1].append((b, len(bands[b][0]) - (i - start[b])))
        run = True
    return classes


SEGMENT = "anchor bigint, segment bigint, doc bigint, start bigint, size bigint, place bigint"


def segments(texts: DataFrame, p: SuffixParams, columns: list[str]) -> DataFrame:
    """Segments of all documents (``columns`` of SEGMENT)."""
    kinds = dict(x.split() for x in SEGMENT.split(", "))

    def run(batches):
        anchors = Anchors(p)
        for batch in slices(batches):
            ids, values = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            for at in range(0, len(ids), 64):
                found = []
                for doc, text in zip(ids[at : at + 64], values[at : at + 64]):
                    anchor, segment, start, size, place = anchors.segments(np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8))
                    found.append((anchor, segment, np.full(len(anchor), doc, np.int64), start, size, place))
                parts = dict(zip(kinds, (np.concatenate(x) for x in zip(*found))))
                yield pa.RecordBatch.from_arrays([pa.array(parts[c]) for c in columns], names=columns)

    return texts.mapInArrow(run, ", ".join(f"{c} {kinds[c]}" for c in columns))


def bands(texts: DataFrame, wanted: DataFrame, p: SuffixParams) -> DataFrame:
    """core (16-byte digest), left, right, doc, at (start of the core): the bands of the segments in ``wanted``."""
    length, width = p.length, p.band
    listed = wanted.groupBy("doc").agg(F.collect_list(F.struct("start", "size", "place")).alias("list"))  # within one document
    rows = texts.join(listed, texts.doc_id == listed.doc).select("doc", "text", "list")

    def run(batches):
        for batch in slices(batches):
            for doc, text, found in zip(*(batch.column(c).to_pylist() for c in ("doc", "text", "list"))):
                data = (text or "").encode("utf-8", "replace")
                spots = set()
                for s in found:
                    anchor = s["start"] + s["place"]  # band b: the windows that start b*width .. b*width + width - 1 bytes before it
                    last = anchor - s["start"]
                    first = anchor - (s["start"] + s["size"] - length)
                    spots.update(anchor - b * width for b in range(first // width, last // width + 1))
                core, left, right, at = [], [], [], []
                for spot in sorted(spots):  # the core: bytes of every window that starts at spot - width + 1 .. spot
                    end = spot - width + 1 + length
                    if spot < 0 or end > len(data):
                        continue
                    core.append(xxhash.xxh3_128_digest(data[spot:end]))
                    left.append(data[max(0, spot - width + 1) : spot])
                    right.append(data[end : spot + length])
                    at.append(spot)
                if core:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(core, pa.binary()), pa.array(left, pa.binary()), pa.array(right, pa.binary()), pa.array([doc] * len(at), pa.int64()), pa.array(at, pa.int64())],
                        names=["core", "left", "right", "doc", "at"],
                    )

    return rows.mapInArrow(run, "core binary, left binary, right binary, doc bigint, at bigint")


def resolved(groups: DataFrame, p: SuffixParams) -> DataFrame:
    """doc, start, stop: repeated windows among the bands of each core, by suffix arrays. groups: core, list of bands."""
    length, width = p.length, p.band

    def run(batches):
        for batch in slices(batches):
            out: dict[str, list[int]] = {"doc": [], "start": [], "stop": []}
            for found in batch.column("list").to_pylist():
                found.sort(key=lambda b: (b["doc"], b["at"]))  # a class's first band is then its first in the corpus
                covered = defaultdict(list)
                for same in repeated_windows([(b["left"], b["right"]) for b in found], width):
                    keep = min(k for k, _ in same)
                    for k, before in same:
                        if k != keep:
                            covered[k].append(before)
                for k, befores in covered.items():
                    b = found[k]
                    for before in befores:
                        out["doc"].append(b["doc"])
                        out["start"].append(b["at"] - before)
                        out["stop"].append(b["at"] - before + length)
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in out.values()], names=list(out))

    return groups.mapInArrow(run, "doc bigint, start bigint, stop bigint")


def by_window(crowded: DataFrame, p: SuffixParams) -> DataFrame:
    """doc, start, stop: repeated windows among the bands of crowded cores, one window at a time."""
    width = p.band
    fits = F.expr(f"filter(sequence(0, {width - 1}), a -> a <= length(left) and {width - 1} - a <= length(right))")
    rows = crowded.select("*", F.explode(fits).alias("before"))
    window = [
        "core",
        "before",
        F.expr("substring(left, length(left) - before + 1, before)").alias("l"),
        F.expr(f"substring(right, 1, {width - 1} - before)").alias("r"),
    ]
    rows = rows.select(*window, "doc", "at")
    least = rows.groupBy("core", "before", "l", "r").agg(F.min(F.struct("doc", "at")).alias("m"))
    later = rows.join(least, ["core", "before", "l", "r"]).where(F.struct("doc", "at") != F.col("m"))
    start = F.col("at") - F.col("before")
    return later.select("doc", start.alias("start"), (start + p.length).alias("stop"))


def repeated(texts: DataFrame, p: SuffixParams) -> DataFrame:
    """doc, start, stop (bytes): strings whose bytes go, overlapping ones not merged; written."""
    spark = texts.sparkSession
    often = segments(texts, p, ["anchor"]).groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1")
    often = written(often.select("anchor"), "anchors")
    release(spark)
    found = written(segments(texts, p, [c.split()[0] for c in SEGMENT.split(", ")]).join(often, "anchor"), "segments")
    drop_written(often)
    release(spark)
    key = ["anchor", "segment"]
    firsts = written(found.groupBy(*key).agg(F.min(F.struct("doc", "start", "size", "place")).alias("m"), F.count("*").alias("n")), "first-segments")
    several = firsts.where("n > 1").select(*key, F.col("m.doc").alias("d"), F.col("m.start").alias("s"))
    later = found.join(several, key).where((F.col("doc") != F.col("d")) | (F.col("start") != F.col("s")))
    whole = written(later.select("doc", "start", (F.col("start") + F.col("size")).alias("stop")), "whole-segments")
    drop_written(found)
    release(spark)
    mixed_anchors = firsts.groupBy("anchor").agg(F.count("*").alias("k")).where("k > 1").select("anchor")
    wanted = firsts.join(mixed_anchors, "anchor").select("m.*")
    cut = written(bands(texts, wanted, p), "bands")
    drop_written(firsts)
    release(spark)
    key = ["core", "left", "right"]
    distinct = written(cut.groupBy(*key).agg(F.min(F.struct("doc", "at")).alias("m"), F.count("*").alias("n")), "first-bands")
    several = distinct.where("n > 1").select(*key, "m")
    later = cut.join(several, key).where(F.struct("doc", "at") != F.col("m"))
    # all windows of a band: from its first byte to its last, if it has a window at all
    enough = F.length("left") + F.length("right") >= p.band - 1
    start = F.col("at") - F.length("left")
    stop = F.col("at") + (p.length - p.band + 1) + F.length("right")
    equal = later.where(enough).select("doc", start.alias("start"), stop.alias("stop"))
    sizes = distinct.groupBy("core").agg(F.count("*").alias("k")).where("k > 1")
    open_bands = distinct.join(sizes, "core").select(*key, "m.doc", "m.at", "k")
    small = open_bands.where(F.col("k") <= p.group_limit)
    groups = small.groupBy("core").agg(F.collect_list(F.struct("left", "right", "doc", "at")).alias("list"))  # group_limit bands at most
    crowded = open_bands.where(F.col("k") > p.group_limit)
    out = whole.union(equal).union(resolved(groups.select("list"), p)).union(by_window(crowded, p))
    out = written(out, "repeated")
    drop_written(whole, cut, distinct)
    release(spark)
    return out


def without_repeats(docs: DataFrame, p: SuffixParams = SuffixParams()) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (the remaining bytes): one row per document."""
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    spans = repeated(texts.where("doc_id is not null and text is not null"), p)
    # within one document; strings that start together count once
    spans = spans.groupBy("doc", "start").agg(F.max("stop").alias("stop"))
    listed = spans.groupBy("doc").agg(F.collect_list(F.struct("start", "stop")).alias("list"))
    rows = texts.join(listed, texts.doc_id == listed.doc, "left").select("doc_id", "text", "list")

    def run(batches):
        for batch in slices(batches):
            kept, removed, runs, sizes = [], [], [], []
            for text, found in zip(batch.column("text").to_pylist(), batch.column("list").to_pylist()):
                data = (text or "").encode("utf-8", "replace")
                parts, at, count = [], 0, 0
                merged: list[list[int]] = []
                for s in sorted((x["start"], min(len(data), x["stop"])) for x in found or ()):
                    if merged and s[0] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], s[1])
                    else:
                        merged.append(list(s))
                for a, b in merged:
                    parts.append(data[at:a])
                    at, count = b, count + b - a
                kept.append(b"".join([*parts, data[at:]]))
                removed.append(count)
                runs.append(len(merged))
                sizes.append(len(data))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in (sizes, removed, runs)), pa.array(kept, pa.binary())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    return rows.mapInArrow(run, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")


def digest(docs: DataFrame, p: SuffixParams = SuffixParams()) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256: one row per document."""
    return without_repeats(docs, p).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
