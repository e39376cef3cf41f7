"""Toxicity by a bidirectional gated recurrent network with attention pooling, in numpy.

A word's input is the sum of its own hashed embedding and those of its characters'
n-grams (prefixes and inner trigrams). Windows of ``window`` words that overlap by half
go through a gated recurrent network in both directions, attention pools the states, and
a logistic unit scores the window. *Every* window of a whole text is scored; the text's
score is the calibrated largest window logit. The network is trained on a bounded,
documented sample of labelled rows: at first on all windows of a document under its
label, then only on the windows that decide (the largest ones of toxic documents, all of
the others), since a toxic document is mostly plain words.

Edge cases: null, empty and letterless texts have no window and score 0; a null
``doc_id`` is never held out and has no label; repeated rows repeat their results; extra
columns are ignored; without labels of both kinds every score is 0.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, slices

RUN = re.compile(r"[^\W\d_]{1,64}")


@dataclass(frozen=True)
class ToxicParams:
    window: int = 32  # words; windows start every half window
    buckets: int = 1 << 15  # of hashed words and character n-grams
    width: int = 16  # of an input
    hidden: int = 8  # states of each direction
    sample_docs: int = 900  # labelled toxic rows used for training, about
    clean_docs: int = 1400  # labelled clean rows used for training, about
    kept_out: int = 4  # every so manieth sampled document serves the calibration instead of the training
    dropout: float = 0.1  # share of a word's features left out in each training step
    epochs: int = 1  # on all windows
    refined: int = 2  # on the deciding windows
    batch: int = 256
    rate: float = 0.08
    seed: int = 7
    memo_words: int = 250_000  # distinct words whose inputs a Python worker keeps


def word_features(word: str, buckets: int) -> list[int]:
    """Buckets of the word, its prefixes and its inner trigrams."""
    grams = [b"w" + word.encode(), *(b"p" + word[:n].encode() for n in range(2, min(8, len(word) + 1)))]
    grams += [b"t" + word[i : i + 3].encode() for i in range(1, len(word) - 2)]
    return [zlib.crc32(g) % buckets for g in grams]


def windows_of(n: int, size: int) -> list[int]:
    """Starts of the windows over ``n`` words: every half window, the last one reaching the end."""
    half = size // 2
    return list(range(0, max(1, n - half), half)) if n else []


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


class Network:
    """Parameters, forward pass and gradients. Inputs: (time, batch, width), mask: (time, batch)."""

    def __init__(self, p: ToxicParams):
        rng = np.random.default_rng(p.seed)
        d, h = p.width, p.hidden

        def init(*shape):
            return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

        self.p = p
        self.w = {"embed": (0.3 * rng.standard_normal((p.buckets, d))).astype(np.float32)}
        for side in "fb":
            self.w[f"W{side}"], self.w[f"U{side}"] = init(d, 3 * h), init(h, 3 * h)
            self.w[f"c{side}"] = np.zeros(3 * h, np.float32)
        self.w |= {"A": init(2 * h, h), "a": np.zeros(h, np.float32), "v": init(h), "o": init(2 * h), "b": np.zeros(1, np.float32)}
        self.cal = (1.0, 0.0)

    def inputs(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Input vector of each word, its features and how many they are."""
        lists = [word_features(w, self.p.buckets) for w in words]
        sizes = np.array([len(x) for x in lists])
        flat = np.array([i for x in lists for i in x], np.int64)
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
        return np.add.reduceat(self.w["embed"][flat], starts, axis=0), flat, sizes

    def projected(self, x: np.ndarray) -> np.ndarray:
        """Both directions' input parts of the gates."""
        return np.concatenate([x @ self.w["Wf"] + self.w["cf"], x @ self.w["Wb"] + self.w["cb"]], axis=-1)

    def _run(self, gates: np.ndarray, u: np.ndarray, mask: np.ndarray, keep: list | None) -> np.ndarray:
        t, b, h = len(gates), gates.shape[1], self.p.hidden
        out = np.empty((t, b, h), np.float32)
        state = np.zeros((b, h), np.float32)
        for i in range(t):
            rec = state @ u
            zr = sigmoid(gates[i, :, : 2 * h] + rec[:, : 2 * h])
            z, r = zr[:, :h], zr[:, h:]
            n = np.tanh(gates[i, :, 2 * h :] + r * rec[:, 2 * h :])
            new = n + z * (state - n)
            m = mask[i][:, None]
            if keep is not None:
                keep.append((state, z, r, n, rec[:, 2 * h :]))
            state = np.where(m, new, state)
            out[i] = state
        return out

    def logits(self, gates: np.ndarray, mask: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Window logits from projected inputs (time, batch, 6 hidden)."""
        h3 = 3 * self.p.hidden
        kept = ([], []) if keep is not None else (None, None)
        fwd = self._run(gates[..., :h3], self.w["Uf"], mask, kept[0])
        bwd = self._run(gates[::-1, :, h3:], self.w["Ub"], mask[::-1], kept[1])[::-1]
        states = np.concatenate([fwd, bwd], axis=-1)
        e = np.tanh(states @ self.w["A"] + self.w["a"])
        s = np.where(mask, e @ self.w["v"], -1e9)
        s = np.exp(s - s.max(axis=0))
        att = s / s.sum(axis=0)
        pooled = np.einsum("tb,tbh->bh", att, states)
        if keep is not None:
            keep.update(runs=kept, states=states, e=e, att=att, pooled=pooled)
        return pooled @ self.w["o"] + self.w["b"]

    def _back(self, dout: np.ndarray, u: np.ndarray, mask: np.ndarray, runs: list) -> tuple[np.ndarray, np.ndarray]:
        """Gradients of the gates' input parts and of the recurrent weights."""
        t, b, h = dout.shape
        dgates, du, carry = np.empty((t, b, 3 * h), np.float32), np.zeros_like(u), np.zeros((b, h), np.float32)
        for i in range(t - 1, -1, -1):
            state, z, r, n, rec = runs[i]
            d = dout[i] + carry
            m = mask[i][:, None]
            dn = d * (1 - z) * (1 - n * n) * m
            dz = d * (state - n) * z * (1 - z) * m
            dr = dn * rec * r * (1 - r)
            dgates[i] = np.concatenate([dz, dr, dn], axis=1)
            drec = np.concatenate([dz, dr, dn * r], axis=1)
            du += state.T @ drec
            carry = np.where(m, d * z, d) + drec @ u.T
        return dgates, du

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray], np.ndarray]:
        """Mean log loss, gradients of all but the embeddings, and of the inputs."""
        w, h3, keep = self.w, 3 * self.p.hidden, {}
        logit = self.logits(self.projected(x), mask, keep)
        prob = sigmoid(logit)
        loss = float(np.mean(np.logaddexp(0, logit) - y * logit))
        d = (prob - y).astype(np.float32) / len(y)
        states, e, att, pooled = keep["states"], keep["e"], keep["att"], keep["pooled"]
        g = {"o": pooled.T @ d, "b": np.array([d.sum()], np.float32)}
        dpool = d[:, None] * w["o"]
        dstates = att[..., None] * dpool
        datt = np.einsum("bh,tbh->tb", dpool, states)
        ds = att * (datt - (att * datt).sum(axis=0))
        g["v"] = np.einsum("tb,tbh->h", ds, e)
        de = ds[..., None] * w["v"] * (1 - e * e)
        g["A"], g["a"] = np.einsum("tbi,tbj->ij", states, de), de.sum(axis=(0, 1))
        dstates = dstates + de @ w["A"].T
        h = self.p.hidden
        df, g["Uf"] = self._back(dstates[..., :h], w["Uf"], mask, keep["runs"][0])
        db, g["Ub"] = self._back(dstates[::-1, :, h:], w["Ub"], mask[::-1], keep["runs"][1])
        db = db[::-1]
        g["Wf"], g["cf"] = np.einsum("tbi,tbj->ij", x, df), df.sum(axis=(0, 1))
        g["Wb"], g["cb"] = np.einsum("tbi,tbj->ij", x, db), db.sum(axis=(0, 1))
        assert df.shape[-1] == h3
        return loss, g, df @ w["Wf"].T + db @ w["Wb"].T


def batch_of(rows: list[list[int]], size: int, empty: int) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers (time, batch) and mask of windows, padded at their ends."""
    length = min(size, max(map(len, rows), default=1))
    ids = np.full((length, len(rows)), empty, np.int64)
    for k, row in enumerate(rows):
        ids[: len(row), k] = row
    return ids, ids != empty


def train(samples: list[tuple[str, int]], p: ToxicParams, odds: float | None = None) -> Network:
    """Fit the network and the calibration to (text, label) rows; ``odds``: of toxic among all labelled rows."""
    net, rng = Network(p), np.random.default_rng(p.seed)
    number: dict[str, int] = {}
    docs = [[number.setdefault(w, len(number)) for w in RUN.findall(t.lower())] for t, _ in samples]
    labels = np.array([y for _, y in samples], np.float32)
    words = list(number)
    lists = [word_features(w, p.buckets) for w in words]
    windows = [(d, ids[s : s + p.window]) for d, ids in enumerate(docs) for s in windows_of(len(ids), p.window)]
    owner = np.array([d for d, _ in windows], np.int64)
    if len(owner) == 0 or len(set(labels.tolist())) < 2:
        net.cal = (0.0, -np.inf)
        return net
    fitted = np.arange(len(docs)) % p.kept_out != 0
    adagrad = {k: np.full(v.shape if k != "embed" else (len(v), 1), 1e-3, np.float32) for k, v in net.w.items()}

    # The first input starts as how much more often toxic documents hold a feature, in standard deviations.
    held, base = np.zeros((2, p.buckets)), labels[fitted].mean()
    for ids, y in zip((docs[d] for d in np.flatnonzero(fitted)), labels[fitted].astype(int)):
        held[y][list({i for w in set(ids) for i in lists[w]})] += 1
    total = held.sum(axis=0)
    excess = (held[1] - total * base) / np.sqrt(np.maximum(total, 1) * base * (1 - base))
    net.w["embed"][:, 0] = 0.5 * np.clip(excess - 1, 0, 6)

    def logits_of_all() -> np.ndarray:
        x = net.projected(net.inputs(words)[0])
        x = np.vstack([x, np.zeros((1, x.shape[1]), np.float32)])
        out = []
        for at in range(0, len(windows), 1024):
            ids, mask = batch_of([r for _, r in windows[at : at + 1024]], p.window, len(words))
            out.append(net.logits(x[ids], mask))
        return np.concatenate(out)

    for epoch in range(p.epochs + p.refined):
        chosen = np.flatnonzero(fitted[owner])
        if epoch >= p.epochs:  # of a toxic document only its largest window and those already found
            scores = logits_of_all()
            top = np.full(len(docs), -np.inf)
            np.maximum.at(top, owner, scores)
            chosen = np.flatnonzero(fitted[owner] & ((labels[owner] == 0) | (scores >= top[owner]) | (scores > 0)))
        rng.shuffle(chosen)
        for at in range(0, len(chosen), p.batch):
            part = chosen[at : at + p.batch]
            ids, mask = batch_of([windows[k][1] for k in part], p.window, len(words))
            used, back = np.unique(ids, return_inverse=True)
            real = used[used < len(words)]
            flat = np.array([i for w in real for i in lists[w]], np.int64)
            sizes = np.array([len(lists[w]) for w in real])
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
            left_in = (rng.random(len(flat)) >= p.dropout)[:, None].astype(np.float32) / np.float32(1 - p.dropout)
            x = np.add.reduceat(net.w["embed"][flat] * left_in, starts, axis=0)
            if len(real) < len(used):
                x = np.vstack([x, np.zeros((1, p.width), np.float32)])
            back = back.reshape(ids.shape)
            _, g, dx = net.gradients(x[back], mask, labels[owner[part]])
            for k, d in g.items():
                adagrad[k] += d * d
                net.w[k] -= p.rate * d / np.sqrt(adagrad[k])
            dword = np.zeros((len(used), p.width), np.float32)
            np.add.at(dword, back[mask], dx[mask])
            dfeat = np.repeat(dword[: len(real)], sizes, axis=0) * left_in
            rows, where = np.unique(flat, return_inverse=True)
            d = np.zeros((len(rows), p.width), np.float32)
            np.add.at(d, where, dfeat)
            adagrad["embed"][rows] += (d * d).mean(axis=1, keepdims=True)
            net.w["embed"][rows] -= p.rate * d / np.sqrt(adagrad["embed"][rows])
    top = np.full(len(docs), -np.inf)
    np.maximum.at(top, owner, logits_of_all())
    held = np.isfinite(top) & ~fitted
    if len(set(labels[held].tolist())) == 2:
        net.cal = calibration(top[held], labels[held], odds)
    return net


def calibration(x: np.ndarray, y: np.ndarray, odds: float | None = None) -> tuple[float, float]:
    """Slope (0.1 at least) and offset of a logistic fit of the labels to the largest logits, at the given class odds."""
    weight = np.where(y > 0, (odds or 1.0) * (y == 0).sum() / max(1, (y > 0).sum()) if odds else 1.0, 1.0)
    weight = weight / weight.sum()
    centre, scale = float(x.mean()), float(x.std()) or 1.0
    z, a, b = (x - centre) / scale, 1.0, 0.0
    for _ in range(3000):
        miss = weight * (sigmoid(a * z + b) - y)
        a = max(0.1 * scale, a - 0.5 * float((miss * z).sum() + 1e-4 * a))
        b -= 0.5 * float(miss.sum())
    return a / scale, b - a * centre / scale


def training_sample(docs: DataFrame, labels: DataFrame, p: ToxicParams) -> tuple[list[tuple[str, int]], float]:
    """A bounded sample of the usable labelled rows by a hash of the identifier, whole texts, and the odds of toxic among all of them."""
    usable = labels.where(F.col("toxic").isin(0, 1) & (crc_mod("doc_id", 5) != 0)).select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    usable = usable.dropDuplicates(["doc_id", "toxic"])
    sizes = {r["toxic"]: r["n"] for r in usable.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return [], 1.0
    limits = {0: p.clean_docs, 1: p.sample_docs}
    share = F.create_map(*(F.lit(x) for y, n in sizes.items() for x in (y, min(1.0, limits[y] / n))))
    spot = F.pmod(F.xxhash64("doc_id", F.lit("toxic sample")), F.lit(1 << 20)) / float(1 << 20)
    picked = usable.where(spot < share[F.col("toxic")])
    texts = docs.where(F.col("text").isNotNull()).select("doc_id", F.col("text").cast("string").alias("text"))
    rows = texts.join(F.broadcast(picked), "doc_id").select("doc_id", "text", "toxic")  # the limits bound what is broadcast
    rows = rows.limit(2 * sum(limits.values())).toLocalIterator()
    return [x[1:] for x in sorted((zlib.crc32(str(r["doc_id"]).encode()), r["text"], r["toxic"]) for r in rows)], sizes[1] / sizes[0]


class Scorer:
    """Document scores, keeping the projected inputs of words seen."""

    def __init__(self, net: Network):
        self.net, self.number, self.rows = net, {}, np.zeros((1, 6 * net.p.hidden), np.float32)  # row 0: no word

    def numbers(self, words: list[str]) -> np.ndarray:
        if len(self.number) > self.net.p.memo_words:
            self.number.clear()
            self.rows = self.rows[:1]
        new = list({w for w in words if w not in self.number})
        if new:
            self.number.update((w, len(self.rows) + k) for k, w in enumerate(new))
            self.rows = np.vstack([self.rows, *(self.net.projected(self.net.inputs(new[at : at + 5000])[0]) for at in range(0, len(new), 5000))])
        return np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))

    def scores(self, texts: list[str | None]) -> np.ndarray:
        p = self.net.p
        docs = [RUN.findall((t or "").lower()) for t in texts]
        sizes = np.array([len(d) for d in docs])
        top = np.full(len(texts), -np.inf)
        if sizes.sum():
            flat = np.concatenate([self.numbers([w for d in docs for w in d]), np.zeros(p.window, np.int64)])
            first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            spots = [windows_of(n, p.window) for n in sizes.tolist()]
            owner = np.repeat(np.arange(len(docs)), [len(s) for s in spots])
            start = np.array([s for x in spots for s in x], np.int64)
            room = sizes[owner] - start
            for at in range(0, len(start), 2048):
                part = slice(at, at + 2048)
                step = np.arange(min(p.window, int(room[part].max())))[:, None]
                mask = step < room[part]
                ids = np.where(mask, flat[np.minimum(first[owner[part]] + start[part] + step, len(flat) - 1)], 0)
                np.maximum.at(top, owner[part], self.net.logits(self.rows[ids], mask))
        a, b = self.net.cal
        return np.where(np.isfinite(top), sigmoid(a * np.where(np.isfinite(top), top, 0) + b), 0.0)


def toxicity(docs: DataFrame, labels: DataFrame, p: ToxicParams = ToxicParams()) -> DataFrame:
    """doc_id, held_out, score, predicted: one row per document."""
    samples, odds = training_sample(docs.select("doc_id", "text"), labels, p)
    net = train(samples, p, odds)
    shared = docs.sparkSession.sparkContext.broadcast(net)  # buckets x width numbers

    def run(batches):
        scorer = Scorer(shared.value)
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            parts = [scorer.scores(texts[at : at + 200]) for at in range(0, len(texts), 200)]
            scores = np.concatenate(parts).astype(float) if parts else np.empty(0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores)], names=["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = rows.mapInArrow(run, "doc_id bigint, score double")
    held = F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
