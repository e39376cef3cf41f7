"""Secret scan: fixed patterns, and dictionary-primed zstandard novelty.

Besides the three base patterns, candidate strings near sensitive words are measured by
how many bytes they add: the compressor is primed with a dictionary of identifiers and
the text around the candidate, and the candidate's marginal size is the difference
between compressing the surroundings with and without it. Copies of the candidate are
taken out of its surroundings, and all occurrences of a reported string are reported. Strings that the surroundings
and the dictionary do not explain (``novelty`` bytes a character or more) are reported
as ``novel``, unless a base span overlaps them.

Edge cases: a null text is an empty one and has no span; repeated rows repeat their
results; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from dataclasses import dataclass
from itertools import accumulate

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

KINDS = ("assign", "access", "hex", "novel")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # the maximal runs of 24 and more
SENSITIVE = re.compile(r"pass(?:word|wd|phrase)|secret|token|api[ _-]?key|access[ _-]?key|private[ _-]?key|credential|bearer|authorization", re.I | re.A)
MARKS = ("pass", "secret", "token", "key", "credential", "bearer", "authorization")  # one is in every text that SENSITIVE or ASSIGN matches
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=.-]+")
GAP = re.compile(r"""[\s"'`\\,]*""")  # between the parts of one value

# Identifiers and phrases that code around secrets is made of.
IDENTIFIERS = (
    "access_key access_token account address admin api_key api_secret application args assert async authorization await "
    "backend base64 bearer boolean bucket bytes callback catch certificate class client client_id client_secret cluster "
    "config connection const container content context cookie create credential credentials database debug default "
    "delete deploy description development document domain email enabled encoding encrypted endpoint environment error "
    "example exception expires export false filename folder format from_env function github gitlab group handler hash "
    "header headers hostname http https identifier import index instance integer interface internal iterator json key "
    "language length library license localhost login logger manager message metadata method module name namespace null "
    "number object option options os.environ output package parameter params passphrase passwd password path pattern "
    "payload permission placeholder port postgres prefix private_key process production profile project property "
    "protocol provider proxy public_key query random readonly redirect refresh_token region register registry release "
    "remote replace request require resource response return role route scope script secret secret_key security select "
    "self server service session session_id settings signature source staging status storage string struct subnet "
    "system table target template tenant test thread timeout timestamp token trace true type undefined update upload "
    "url user user_id username utf-8 value values variable vendor version volume warning webhook workspace "
    "abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 xxxxxxxxxxxxxxxx changeme your_token_here"
)


@dataclass(frozen=True)
class SecretParams:
    near: int = 64  # code points between a sensitive word and a candidate, at most
    around: int = 400  # code points of surroundings on each side that prime the compressor
    least_chars: int = 12
    novelty: float = 0.7  # added bytes a character
    level: int = 3


def core_of(s: str, least: int) -> str:
    """The longest part of a candidate between ``=``, or all of it if that is short."""
    part = max(s.split("="), key=len)
    return part if len(part) >= least else s


def occurrences(text: str, s: str, lo: int, hi: int) -> list[int]:
    """Starts of all occurrences of ``s`` in ``text[lo:hi]``, overlapping ones too."""
    out, at = [], text.find(s, lo, hi)
    while at >= 0:
        out.append(at)
        at = text.find(s, at + 1, hi)
    return out


def without(text: str, s: str, lo: int, hi: int) -> str:
    """``text[lo:hi]`` without the characters of any occurrence of ``s``, those across its ends included."""
    parts, at = [], lo
    for spot in occurrences(text, s, max(0, lo - len(s) + 1), hi + len(s) - 1):
        parts.append(text[at : max(at, spot)])
        at = min(hi, max(at, spot + len(s)))
    return "".join(parts) + text[at:hi]


class Novelty:
    """Marginal compressed size of strings within their surroundings."""

    def __init__(self, p: SecretParams):
        self.p = p
        primer = zstandard.ZstdCompressionDict(IDENTIFIERS.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        primer.precompute_compress(level=p.level)
        self.zstd = zstandard.ZstdCompressor(dict_data=primer, write_content_size=False, write_checksum=False)

    def __call__(self, text: str, start: int, end: int) -> float:
        """Added bytes for each character of ``text[start:end]``."""
        near = self.p.around
        core = core_of(text[start:end], self.p.least_chars)
        before = without(text, core, max(0, start - near), start).encode("utf-8", "replace")
        after = without(text, core, end, min(len(text), end + near)).encode("utf-8", "replace")
        with_it = len(self.zstd.compress(before + after + text[start:end].encode("utf-8", "replace")))
        return (with_it - len(self.zstd.compress(before + after))) / (end - start)


def looks_random(s: str) -> bool:
    """Letters and digits, or both cases: what a name or a word seldom mixes."""
    kinds = (re.search("[a-z]", s), re.search("[A-Z]", s[1:]), re.search("[0-9]", s))
    return sum(k is not None for k in kinds) >= 2


def pieces_of(text: str, words: list[tuple[int, int]], near: int) -> list[tuple[int, int, bool]]:
    """(start, end, within reach of a word) of the candidates of ``text``, in order.

    A candidate that starts within reach after a word is taken whole; another one that holds a
    word is cut there.
    """
    starts, ends = [s for s, _ in words], [e for _, e in words]
    out = []
    for m in CANDIDATE.finditer(text):
        s, e = m.span()
        k = bisect_right(ends, s)  # the words before it
        reached = k > 0 and s <= ends[k - 1] + near
        if reached or k == len(words) or starts[k] >= e:
            after = bisect_left(starts, e)
            out.append((s, e, reached or after < len(words) and starts[after] - near <= e))
        else:
            out += [x for x in ((s, starts[k], True), (ends[k], e, True)) if x[0] < x[1]]
    return out


def near_words(text: str, taken: list[tuple[int, int]], novelty: Novelty) -> list[tuple[int, int, float]]:
    """(start, end, novelty) of the novel candidates near sensitive words, on both sides.

    The reach runs on, both ways, from each of them to the candidates that only white space,
    quotes and the like part from it, as between the lines of a key.
    """
    p = novelty.p
    words = [m.span() for m in SENSITIVE.finditer(text)]
    if not words:
        return []
    pieces = pieces_of(text, words, p.near)
    begins = [s for s, _ in taken]
    highest = list(accumulate((e for _, e in taken), max))
    values: dict[int, float] = {}
    seen: set[int] = set()

    def measure(i: int) -> bool:
        if i not in seen:
            seen.add(i)
            s, e, _ = pieces[i]
            k = bisect_left(begins, e)
            if e - s >= p.least_chars and looks_random(text[s:e]) and not (k and highest[k - 1] > s):
                value = novelty(text, s, e)
                if value >= p.novelty:
                    values[i] = value
        return i in values

    def run_on(i: int, step: int) -> None:
        at = i
        while 0 <= (j := at + step) < len(pieces):
            left, right = min(at, j), max(at, j)
            if not GAP.fullmatch(text, pieces[left][1], pieces[right][0]):
                return
            # a joining sign or the letter of an escape is passed over
            if pieces[j][1] - pieces[j][0] > 2 and (j in seen or not measure(j)):
                return
            at = j

    for i, (_, _, reached) in enumerate(pieces):
        if reached and i not in seen and measure(i):
            run_on(i, 1)
            run_on(i, -1)
    return [(*pieces[i][:2], values[i]) for i in sorted(values)]


def spans_of(text: str | None, novelty: Novelty) -> list[tuple[int, int, str, int, float | None]]:
    """(start, end, kind, start of the value, novelty) by start, then kind as listed."""
    text = text or ""
    low = text.lower()
    marked = any(m in low for m in MARKS)
    out: list[tuple[int, int, str, int, float | None]] = []
    if marked:
        out += [(m.start(), m.end(), "assign", m.start(2), None) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access", m.start(), None) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    out += [(m.start(), m.end(), "hex", m.start(), None) for m in HEX.finditer(text)]
    if marked:
        p, found = novelty.p, {}
        for start, end, value in near_words(text, sorted((s, e) for s, e, *_ in out), novelty):
            out.append((start, end, "novel", start, value))
            found.setdefault(text[start:end], value)
        out += copies(text, found, out, p)
    return sorted(out, key=lambda x: (x[0], KINDS.index(x[2])))


def copies(text: str, found: dict[str, float], spans: list, p: SecretParams) -> list[tuple[int, int, str, int, float | None]]:
    """Spans of all other occurrences of the strings (or their random cores) in ``found``; none overlaps another span."""
    parts = {}
    for s, value in found.items():
        core = core_of(s, p.least_chars)
        parts.setdefault(core if looks_random(core) else s, value)
    places = {}
    for s, value in parts.items():
        for at in occurrences(text, s, 0, len(text)):
            if len(s) > places.get(at, (0,))[0]:
                places[at] = (len(s), value)
    taken, out = sorted((s, e) for s, e, *_ in spans), []
    k, last = 0, 0
    for at in sorted(places):
        size, value = places[at]
        while k < len(taken) and taken[k][0] < at + size:
            last = max(last, taken[k][1])
            k += 1
        if last <= at:
            out.append((at, at + size, "novel", at, value))
            last = at + size
    return out


SPAN = "array<struct<start:bigint,stop:bigint,kind:string,value:bigint,novelty:double>>"


def with_spans(docs: DataFrame, p: SecretParams = SecretParams(), name: str = "secrets") -> DataFrame:
    """``docs`` with a column of the secret spans of each text (code points, stop exclusive)."""
    docs = docs.drop(name)
    schema = docs.withColumn(name, F.expr(f"cast(null as {SPAN})")).schema
    fields = ("start", "stop", "kind", "value", "novelty")
    kind = pa.list_(pa.struct(list(zip(fields, (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.float64())))))

    def run(batches):
        novelty = Novelty(p)
        for batch in slices(batches):
            found = [[dict(zip(fields, s)) for s in spans_of(t, novelty)] for t in batch.column("text").to_pylist()]
            yield batch.append_column(name, pa.array(found, kind))

    return docs.mapInArrow(run, schema)


def scanned(docs: DataFrame, p: SecretParams = SecretParams()) -> DataFrame:
    """One row per document: base counts, digest of the base spans, all spans as text."""
    found = with_spans(docs.select("doc_id", F.col("text").cast("string").alias("text")), p)

    def named(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.stop.cast("string"))), ",")

    def count(kind):
        return F.size(F.filter("secrets", lambda s: s.kind == kind)).cast("bigint")

    return found.select(
        "doc_id",
        *(count(k).alias(f"n_{k}") for k in KINDS[:3]),
        F.sha2(named(F.filter("secrets", lambda s: s.kind != "novel")), 256).alias("base_sha256"),
        named(F.col("secrets")).alias("spans"),
    )


def redact(docs: DataFrame, p: SecretParams = SecretParams(), mark: str = "[secret]") -> DataFrame:
    """``docs`` with the value of every span in ``text`` replaced by ``mark`` and ``n_chars`` adjusted; all rows stay."""

    def run(batches):
        novelty = Novelty(p)
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            sizes = batch.column("n_chars").to_pylist() if "n_chars" in batch.schema.names else None
            for i, t in enumerate(texts):
                spans = spans_of(t, novelty)
                if not spans:
                    continue
                parts, at = [], 0
                for _, stop, _, value, _ in spans:
                    if value >= at:
                        parts += [t[at:value], mark]
                    at = max(at, stop)
                texts[i] = "".join(parts) + t[at:]
                if sizes is not None:
                    sizes[i] = len(texts[i])
            batch = batch.set_column(batch.schema.get_field_index("text"), "text", pa.array(texts, pa.string()))
            if sizes is not None:
                spot = batch.schema.get_field_index("n_chars")
                batch = batch.set_column(spot, "n_chars", pa.array(sizes, batch.schema.field(spot).type))
            yield batch

    return docs.mapInArrow(run, docs.schema)
