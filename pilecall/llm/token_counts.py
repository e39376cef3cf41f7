"""Token counts of document sections by offset-mapped attribution.

Every whole document is encoded once; its sections are its lines, each with its line
end. The tokens' character spans are interval-joined to the section spans by binary
search on the sections' starts (both sides are sorted). A token that crosses section
borders is allocated to the section that holds most of its characters, to the earlier
one on a tie; so the counts of a document's sections sum to its tokens.

Edge cases: a null or empty text has one empty section without tokens; text after the
last line end is a section only if it isn't empty; repeated rows repeat their results; a
null ``doc_id`` stays null; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import default_tokenizer, slices
from .tokens import Encoder


def line_starts(text: str) -> np.ndarray:
    """Where each line starts (code points); a line ends after its line feed."""
    sizes = [len(x) + 1 for x in text.split("\n")]
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    return starts[:-1] if len(starts) > 1 and starts[-1] == len(text) else starts


def allocate(starts: np.ndarray, ends: np.ndarray, borders: np.ndarray, size: int) -> np.ndarray:
    """Tokens of each section; ``borders`` are the sections' starts in a text of ``size`` code points."""
    first = np.searchsorted(borders, starts, "right") - 1
    last = np.maximum(first, np.searchsorted(borders, ends - 1, "right") - 1)
    for k in np.flatnonzero(first != last):
        edges = np.append(borders[first[k] : last[k] + 1], size).clip(starts[k], ends[k])
        edges[-1] = ends[k]
        first[k] += np.diff(edges).argmax()  # the first of equal shares
    return np.bincount(first, minlength=len(borders))


def section_tokens(docs: DataFrame, tokenizer: tuple[str, str] | None = None) -> DataFrame:
    """doc_id, section (from 0), start, stop (code points), n_tokens: one row per line of every document."""
    paths = tokenizer or default_tokenizer()

    def run(batches):
        encoder = Encoder(*paths)
        for batch in slices(batches):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for at in range(0, len(texts), 200):
                part = texts[at : at + 200]
                where, section, start, stop, n = [], [], [], [], []
                for k, text in enumerate(part, at):
                    a, b = encoder.token_spans(text)
                    borders = line_starts(text)
                    counts = allocate(a, b, borders, len(text))
                    where.append(np.full(len(borders), k))
                    section.append(np.arange(len(borders)))
                    start.append(borders)
                    stop.append(np.append(borders[1:], len(text)))
                    n.append(counts)
                where, section, start, stop, n = (np.concatenate(x).astype(np.int64) for x in (where, section, start, stop, n))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(where)), *(pa.array(x) for x in (section, start, stop, n))],
                    names=["doc_id", "section", "start", "stop", "n_tokens"],
                )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, section bigint, start bigint, stop bigint, n_tokens bigint")
