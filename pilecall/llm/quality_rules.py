"""Quality rules by weak supervision.

Every rule votes good (+1) or bad (-1) on a document or abstains (0). The accuracies of
the rules are not known: expectation-maximisation over the vote patterns of *all*
documents estimates them together with the share of good documents. A document's
posterior probability of being good, not the demand that all rules pass, decides.
Votes are counted by pattern before they leave Spark, so the estimation sees at most
``3 ** rules`` rows at any size of the input.

Edge cases: null, empty and blank texts have no words, fail the base rule and are not
kept; repeated rows repeat their results; a null ``doc_id`` stays null; extra columns are
ignored; without documents there is nothing to estimate.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import slices, written
from .jaccard_join import WordHashes, mixed

SYMBOLS = "#*$%&|<>"
MULT = np.uint64(0x9E3779B97F4A7C15)
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LETTER = np.zeros(256, bool)
LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def repeated_words(hashes: np.ndarray, k: int = 5) -> int:
    """Words within ``k``-word windows that occur twice or more."""
    n = len(hashes) - k + 1
    if n < 2:
        return 0
    acc = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(k):
            acc = mixed(acc * MULT + hashes[i : i + n])
    _, which, counts = np.unique(acc, return_inverse=True, return_counts=True)
    edges = np.zeros(len(hashes) + 1, np.int64)
    twice = np.flatnonzero(counts[which] > 1)
    np.add.at(edges, twice, 1)
    np.add.at(edges, twice + k, -1)
    return int((np.cumsum(edges) > 0).sum())


FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_ended", "n_lettered", "n_distinct")


def measured(text: str | None, memo: WordHashes) -> tuple[int, ...]:
    """The FEATURES of one text."""
    text = text or ""
    data = text.encode("utf-8", "replace")
    words = data.split()  # between ASCII white space
    hashes = np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
    lines = [x for x in text.split("\n") if x.strip(" \t\n\v\f\r")]
    raw = np.frombuffer(data, np.uint8)
    starts = ~SPACE[raw]
    starts[1:] &= SPACE[raw[:-1]]
    return (
        len(words),
        len(text) - sum(map(text.count, " \t\n\v\f\r")),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(hashes),
        len(lines),
        sum(x.rstrip(" \t\v\f\r").endswith((".", "!", "?", '"', ":")) for x in lines),
        int(LETTER[raw[starts]].sum()),
        len(np.unique(hashes)),
    )


def features(docs: DataFrame) -> DataFrame:
    """doc_id and the FEATURES of every document."""

    def run(batches):
        memo = WordHashes()
        for batch in slices(batches):
            rows = [measured(t, memo) for t in batch.column("text").to_pylist()]
            columns = zip(*rows) if rows else [[]] * len(FEATURES)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns)], names=["doc_id", *FEATURES])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, " + ", ".join(f"{c} bigint" for c in FEATURES))


def share(part: str, whole: str) -> Column:
    return F.coalesce(F.col(part) / F.nullif(F.col(whole), F.lit(0)), F.lit(0.0))


def two_sided(good: Column, bad: Column) -> Column:
    """A vote: +1 where ``good``, -1 where ``bad``, else 0."""
    return F.when(bad, -1).when(good, 1).otherwise(0)


def default_rules() -> dict[str, Column]:
    """The rules as vote columns over FEATURES. A rule whose passing says little abstains instead of voting good."""
    mean, chars = share("word_chars", "n_words"), share("n_symbols", "word_chars")
    symbols, dup, repeat = share("n_symbols", "n_words"), share("n_dup_lines", "n_lines"), share("n_repeat_words", "n_words")
    ended, lettered = share("n_ended", "n_lines"), share("n_lettered", "n_words")
    n, never = F.col("n_words"), F.lit(False)
    # distinct words against words on a log scale, which hardly depends on the text's length
    varied = F.when(n > 1, F.log(F.col("n_distinct")) / F.log(n))
    return {
        "length": two_sided(never, n < 10),
        "word_length": two_sided(never, (mean < 2) | (mean > 15)),
        "symbols": two_sided(symbols <= 0.02, symbols > 0.1),
        "symbol_chars": two_sided(chars <= 0.005, chars > 0.02),
        "duplicate_lines": two_sided(never, dup > 0.3),
        "repeats": two_sided(repeat <= 0.05, repeat > 0.2),
        "sentence_ends": two_sided(ended >= 0.5, ended < 0.2),
        "letters": two_sided(never, lettered < 0.8),
        "variety": two_sided(varied >= 0.85, varied < 0.6),
    }


@dataclass(frozen=True)
class QualityParams:
    rules: Callable[[], dict[str, Column]] = default_rules
    rounds: int = 60
    prior: float = 0.9  # starting share of good documents
    smoothing: float = 1.0  # documents of each class added to every vote's count
    threshold: float = 0.5  # posterior from which on a document is kept


@dataclass
class Accuracies:
    """What the estimation finds: how often each rule votes good and bad on good and on bad documents."""

    prior: float
    good_votes: np.ndarray  # (rules, 2): on bad and on good documents
    bad_votes: np.ndarray

    def weights(self) -> tuple[np.ndarray, np.ndarray]:
        """Log odds that each rule's good and bad vote add. No rule is read backwards."""
        good = np.log(self.good_votes[:, 1] / self.good_votes[:, 0])
        bad = np.log(self.bad_votes[:, 1] / self.bad_votes[:, 0])
        return good.clip(0, 8), bad.clip(-8, 0)

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        good, bad = self.weights()
        odds = math.log(self.prior / (1 - self.prior)) + (patterns > 0) @ good + (patterns < 0) @ bad
        return 1 / (1 + np.exp(-odds))


def estimate(patterns: np.ndarray, counts: np.ndarray, p: QualityParams) -> Accuracies:
    """Expectation-maximisation over vote patterns, started from the balance of votes."""
    n, total = patterns.shape[1], max(1.0, float(counts.sum()))
    good = p.prior ** (1.0 + 3.0 * np.maximum(0, (patterns < 0).sum(axis=1) * 2 - (patterns > 0).sum(axis=1) / 2))
    found = Accuracies(p.prior, np.full((n, 2), 0.5), np.full((n, 2), 0.5))
    for _ in range(p.rounds if len(counts) else 0):
        mass = np.stack([counts * (1 - good), counts * good])  # (classes, patterns)
        size = mass.sum(axis=1) + 3 * p.smoothing
        found = Accuracies(
            float(np.clip(mass[1].sum() / total, 0.01, 0.99)),
            ((mass @ (patterns > 0) + p.smoothing) / size[:, None]).T,
            ((mass @ (patterns < 0) + p.smoothing) / size[:, None]).T,
        )
        good = found.posterior(patterns)
    return found


def judged(docs: DataFrame, p: QualityParams = QualityParams()) -> DataFrame:
    """doc_id, the base measures, base_failed, the votes, quality (posterior) and kept: one row per document."""
    rules = p.rules()
    votes = [f"vote_{name}" for name in rules]
    base_failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    found = features(docs).withColumn("base_failed", base_failed)
    found = written(found.withColumns({v: r.cast("int") for v, r in zip(votes, rules.values())}), "quality")
    seen = found.groupBy(*votes).agg(F.count("*").alias("n")).collect()  # 3 ** rules rows at most
    patterns = np.array([[r[v] for v in votes] for r in seen], float).reshape(-1, len(votes))
    accuracies = estimate(patterns, np.array([r["n"] for r in seen], float), p)
    odds = F.lit(math.log(accuracies.prior / (1 - accuracies.prior)))
    for v, good, bad in zip(votes, *(w.tolist() for w in accuracies.weights())):
        odds = odds + F.when(F.col(v) > 0, good).when(F.col(v) < 0, bad).otherwise(0.0)
    found = found.withColumn("quality", 1 / (1 + F.exp(-odds)))
    return found.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= p.threshold))


def verdicts(docs: DataFrame, p: QualityParams = QualityParams()) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, quality."""
    return judged(docs, p).select("doc_id", *FEATURES[:5], "base_failed", "kept", "quality")
