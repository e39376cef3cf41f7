"""CIGAR column expressions (D14 and the op table that every pileup stage explodes).

A CIGAR is searched by Spark and put together in columns, batch by batch; only its pieces go to the Python workers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPS_TYPE = "array<struct<idx:int,len:int,op:string,raw:string,rofs:int,qofs:int,pofs:int,nops:int>>"
_FIELDS = ["idx", "len", "op", "raw", "rofs", "qofs", "pofs", "nops"]

# Derived lengths: the letters that each one adds up (of the raw operators, '=' and 'X' read as M).
LENGTHS = {"ref_span": "MDN", "rlen1": "MI", "rlen2": "MIS", "indel_len": "ID", "md_len": "MD"}


ONE_RUN = "^[0-9]+[M=X]$"  # an alignment without gaps or clips

_LETTERS = "MIDNSHP"
_CODE = {c: k for k, c in enumerate(_LETTERS)} | {"=": 0, "X": 0}


def _of(letters: str, code: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The lengths ``n`` of the operators that ``letters`` names, 0 for the others."""
    return np.where(np.array([c in letters for c in _LETTERS])[code], n, 0)


def parsed(pieces: pa.Array, out: str = "ops") -> pa.StructArray:
    """The op table and the derived lengths of each CIGAR of a batch, from its pieces (``12M``, ``3I``, ...), worked out in columns."""
    size = pieces.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    coded = pieces.flatten().dictionary_encode()
    kinds, at = coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False)
    n = np.array([int(x[:-1]) for x in kinds], np.int64)[at]
    raw = np.array([_CODE[x[-1]] for x in kinds], np.int64)[at]
    ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    row = np.repeat(np.arange(len(size)), size)
    idx = np.arange(len(n)) - ends[row]
    op = np.where((raw == _CODE["I"]) & ((idx == 0) | (idx == size[row] - 1)), _CODE["S"], raw)

    def before(letters: str) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(_of(letters, op, n))])
        return total[:-1] - total[ends[row]]

    def ints(x: np.ndarray) -> pa.Array:
        return pa.array(x, pa.int64()).cast(pa.int32())  # refuses what an int doesn't hold

    names = pa.array(list(_LETTERS), pa.string())
    columns = [ints(idx), ints(n), names.take(pa.array(op)), names.take(pa.array(raw)), ints(before("MDN")), ints(before("MIS")), ints(before("MI")), ints(size[row])]
    ops = pa.ListArray.from_arrays(ints(ends), pa.StructArray.from_arrays(columns, _FIELDS))
    sums = []
    for letters in LENGTHS.values():
        total = np.concatenate([[0], np.cumsum(_of(letters, raw, n))])
        sums.append(ints(total[ends[1:]] - total[ends[:-1]]))
    return pa.StructArray.from_arrays([ops, *sums], [out, *LENGTHS])


def _parse(cigar: str, out: str) -> Column:
    """A CIGAR's op table and lengths: searched once, its pieces put together by tasks that take batches of them."""
    def parse(pieces: pa.Array) -> pa.Array:
        return parsed(pieces, out)

    pieces = F.expr(f"regexp_extract_all(coalesce({cigar}, ''), '\\\\d+[MIDNSHP=X]', 0)")
    return F.arrow_udf(parse, f"struct<{out}: {OPS_TYPE}, {', '.join(f'{c}: int' for c in LENGTHS)}>")(pieces)


def ops_column(cigar: str) -> Column:
    """The op table of a CIGAR as a plain column, for tables where it is read once or not at all."""
    return _parse(cigar, "ops")["ops"]


def with_cigar_columns(reads: DataFrame, cigar: str = "cigar", out: str = "ops") -> DataFrame:
    """Add the op table ``out`` and the derived lengths used by filters and pileup.

    The op table has one struct per operator, in order: edge ``I`` reads as ``S`` (``op``;
    ``raw`` keeps the letter), ``=`` and ``X`` as ``M``; ``H`` and ``P`` consume nothing. rofs:
    reference offset from the alignment start; qofs: offset in the read; pofs: offset over M
    and I only. Lengths: ref_span (M+D+N), rlen1 (M+I), rlen2 (M+I+S), indel_len (I+D), md_len (M+D).

    Each read's CIGAR is parsed once: the columns come out of a generator, which filters on
    them do not pass, so no filter or later projection holds a copy of the parse.
    """
    if out in reads.columns:
        return reads
    df = reads.select("*", F.inline(F.array(_parse(cigar, out))))
    return df.withColumn("end_pos", F.col("start_pos") + F.col("ref_span") - 1)


def with_ops(df: DataFrame, cigar: str = "cigar", out: str = "ops") -> DataFrame:
    """Add the op table only (see ``with_cigar_columns``)."""
    if out in df.columns:
        return df
    return df.select("*", F.inline(F.array(F.struct(_parse(cigar, out)[out].alias(out)))))
