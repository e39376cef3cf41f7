"""Derived genomic fixtures.

The driver tables hold no genomic data, so reads, reference blocks, contigs and
region tables are derived from ``lineitem`` and ``part`` by one CTE text that
Spark SQL and DuckDB both accept (the oracle queries start from the same text).
Every fixture grows with the driver tables.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from pilecall.session import shared_scratch

# The shared prelude text (see FIXTURES.md).
PRELUDE = """
WITH li AS (
  SELECT concat(cast(l_orderkey AS varchar(20)), '.', cast(l_linenumber AS varchar(20)), '.',
                cast(l_partkey AS varchar(20)), '.', cast(l_suppkey AS varchar(20))) AS read_name,
         concat('chr', cast(1 + l_orderkey % 5 AS varchar(20))) AS chr,
         1 + cast(floor(l_orderkey / 5) AS bigint) AS start_pos,
         CASE WHEN l_linenumber % 2 = 0 THEN 'normal' ELSE 'tumor' END AS sample,
         CASE WHEN l_returnflag = 'R' THEN 16 ELSE 0 END
           + CASE WHEN l_partkey % 23 = 0 THEN 1024 ELSE 0 END
           + CASE WHEN l_partkey % 29 = 0 THEN 256 ELSE 0 END
           + CASE WHEN l_partkey % 31 = 0 THEN 2048 ELSE 0 END AS flag,
         CASE WHEN l_partkey % 62 = 0 THEN 1 ELSE 0 END AS sup,
         cast(10 + l_partkey % 51 AS integer) AS mapq,
         cast(20 + cast(l_quantity AS bigint) % 20 AS integer) AS q,
         cast(l_suppkey % 4 AS integer) AS k
  FROM lineitem),
off AS (
  SELECT *, cast(floor((start_pos - 1) / 32) AS bigint) AS blk,
         cast((37 - start_pos % 37) % 37 AS integer) AS o_snv,
         cast((101 - start_pos % 101) % 101 AS integer) AS o_ins,
         cast((103 - start_pos % 103) % 103 AS integer) AS o_del,
         cast((211 - start_pos % 211) % 211 AS integer) AS o_clip
  FROM li),
rf AS (
  SELECT *, substr(concat(
     translate(md5(concat(chr, ':', cast(blk     AS varchar(20)))), '0123456789abcdef', 'ACGTACGTACGTACGT'),
     translate(md5(concat(chr, ':', cast(blk + 1 AS varchar(20)))), '0123456789abcdef', 'ACGTACGTACGTACGT'),
     translate(md5(concat(chr, ':', cast(blk + 2 AS varchar(20)))), '0123456789abcdef', 'ACGTACGTACGTACGT')),
     cast(start_pos - 32 * blk AS integer), 64) AS r
  FROM off),
reads AS (
  SELECT read_name, sample, chr, start_pos, flag, mapq,
    CASE WHEN k = 1 AND o_ins BETWEEN 10 AND 30 THEN concat(cast(o_ins AS varchar(20)), 'M2I', cast(38 - o_ins AS varchar(20)), 'M')
         WHEN k = 2 AND o_del BETWEEN 10 AND 30 THEN concat(cast(o_del AS varchar(20)), 'M3D', cast(40 - o_del AS varchar(20)), 'M')
         WHEN k = 3 AND o_clip BETWEEN 10 AND 25 THEN concat(cast(o_clip AS varchar(20)), 'M', cast(40 - o_clip AS varchar(20)), 'S')
         WHEN k = 0 AND start_pos % 50 = 0 THEN '15M20N25M'
         ELSE '40M' END AS cigar,
    CASE WHEN k = 1 AND o_ins BETWEEN 10 AND 30 THEN concat(substr(r, 1, o_ins), 'GA', substr(r, o_ins + 1, 38 - o_ins))
         WHEN k = 2 AND o_del BETWEEN 10 AND 30 THEN concat(substr(r, 1, o_del), substr(r, o_del + 4, 40 - o_del))
         WHEN k = 3 AND o_clip BETWEEN 10 AND 25 THEN concat(substr(r, 1, o_clip), substr(r, o_clip + 21, 40 - o_clip))
         WHEN k = 0 AND start_pos % 50 = 0 THEN concat(substr(r, 1, 15), substr(r, 36, 25))
         WHEN k = 0 AND (sample = 'tumor' OR (start_pos + o_snv) % 2 = 0)
              THEN concat(substr(r, 1, o_snv), translate(substr(r, o_snv + 1, n_snv), 'ACGT', 'CGTA'), substr(r, o_snv + n_snv + 1, 40 - n_snv - o_snv))
         ELSE substr(r, 1, 40) END AS seq,
    repeat(chr(33 + q), 40) AS qual,
    CASE WHEN k = 1 AND o_ins BETWEEN 10 AND 30 THEN 2 WHEN k = 2 AND o_del BETWEEN 10 AND 30 THEN 3
         WHEN k = 0 AND start_pos % 50 <> 0 AND (sample = 'tumor' OR (start_pos + o_snv) % 2 = 0) THEN n_snv ELSE 0 END AS nm,
    chr AS mate_chr, start_pos + 60 AS mate_start, 100 AS insert_size,
    CASE WHEN sup = 1 THEN concat(chr, ',', cast(start_pos AS varchar(20)), ',+,40M,60,0;') END AS sa_tag
  FROM (SELECT *, CASE WHEN (start_pos + o_snv) % 3 = 0 THEN 2 ELSE 1 END AS n_snv FROM rf) rf),
ref_blocks AS (
  SELECT chr, blk AS block, 32 * blk + 1 AS block_start,
         translate(md5(concat(chr, ':', cast(blk AS varchar(20)))), '0123456789abcdef', 'ACGTACGTACGTACGT') AS seq
  FROM (SELECT chr, blk FROM off UNION SELECT chr, blk + 1 FROM off UNION SELECT chr, blk + 2 FROM off) b),
contigs AS (SELECT chr, 32 * (max(block) + 1) AS length FROM ref_blocks GROUP BY chr),
regions AS (
  SELECT p_partkey AS region_id, concat('chr', cast(1 + p_partkey % 5 AS varchar(20))) AS chr,
         1 + 6 * p_partkey AS region_start, 1 + 6 * p_partkey + p_size AS region_end,
         p_name AS gene
  FROM part),
amplicons AS (
  SELECT p_partkey AS amplicon_id,
         concat('chr', cast(1 + p_partkey % 5 AS varchar(20))) AS chr,
         1 + 6 * p_partkey AS amp_start, 41 + 6 * p_partkey + p_size AS amp_end, p_name AS gene,
         11 + 6 * p_partkey AS istart, 31 + 6 * p_partkey + p_size AS iend
  FROM part),
segments AS (
  SELECT p_partkey AS segment_id,
         concat(CASE WHEN p_partkey % 3 = 0 THEN '' ELSE 'chr' END, cast(1 + p_partkey % 5 AS varchar(20))) AS chr,
         p_partkey + 5 AS cds_start, p_partkey + 60 AS cds_end,
         concat(cast(p_partkey AS varchar(20)), ',', cast(p_partkey + 30 AS varchar(20)), ',', cast(p_partkey + 90 AS varchar(20))) AS seg_starts,
         concat(cast(p_partkey + 20 AS varchar(20)), ',', cast(p_partkey + 30 + p_size AS varchar(20)), ',', cast(p_partkey + 120 AS varchar(20))) AS seg_ends,
         p_brand AS gene
  FROM part)
"""

# Alignments that reach the rules on clips and close indels: (CIGAR, what clipped bases are, mismatches at the match's
# edge next to the clip). 'ref': the clip continues the reference; 'alt': every clipped base differs from it; 'near':
# no clip, the second and fourth base of a long match behind an indel differ.
EDGE_SHAPES = (
    ("6S3I31M", "alt", 0), ("6S3D34M", "alt", 0), ("31M3I6S", "alt", 0), ("34M3D6S", "alt", 0),
    ("5S8M2I25M", "alt", 0), ("5S8M2D27M", "alt", 0), ("25M2I8M5S", "alt", 0), ("27M2D8M5S", "alt", 0),
    ("6M2I32M", "alt", 0), ("6M2D34M", "alt", 0), ("32M2I6M", "alt", 0), ("34M2D6M", "alt", 0),
    ("12M3D4M2I5M2D17M", "alt", 0), ("12M3D9M2I9M2D8M", "alt", 0), ("15M2D5M3I17M", "alt", 0), ("15M2D5M3D20M", "alt", 0),
    ("15M2D5M3D4I16M", "alt", 0), ("15M3I5M2D17M", "alt", 0), ("12M2I5M3I18M", "alt", 0), ("15M3I5M2D4I13M", "alt", 0),
    ("30M10S", "ref", 0), ("30M10S", "alt", 0), ("10S30M", "ref", 0), ("10S30M", "alt", 0), ("40M", "alt", 0),
    ("30M10S", "alt", 2), ("10S30M", "alt", 2), ("4S3I2M2D31M", "ref", 0), ("10M5N20M10S", "ref", 0), ("6M2D3M2D31M", "alt", 0),
    # close indels, and mismatches two and four bases behind them
    ("14M3I2M2I19M", "near", 0), ("14M3I2M4D21M", "near", 0), ("14M4D3M2I21M", "near", 0), ("14M4D1M3D25M", "near", 0),
    ("14M4D3I23M", "near", 0), ("15M2I23M", "near", 0), ("15M2D25M", "near", 0), ("14M2I2M3D2M2I20M", "near", 0),
    ("31M3I6S", "ref", 0), ("6S3D34M", "ref", 0), ("25M2I8M5S", "ref", 0), ("5S8M2D27M", "ref", 0),
)


def _edge_read(cigar: str, clip: str, off: int) -> str:
    """SQL for the bases of one shape, out of ``r`` (the reference from ten bases before the alignment on)."""
    ops = [(int(n), o) for n, o in re.findall(r"(\d+)([MIDNS])", cigar)]
    at, parts = 11, []
    for k, (n, o) in enumerate(ops):
        first = at - n if o == "S" and k == 0 else at
        text = f"substr(r, {first}, {n})"
        if o == "I":
            parts.append(f"'{('GATC' * n)[:n]}'")
        elif o == "S":
            parts.append(text if clip == "ref" else f"translate({text}, 'ACGT', 'CGTA')")
        elif o == "M" and clip == "near" and k and n > 9:
            parts += [f"substr(r, {first}, 1)", f"translate(substr(r, {first + 1}, 1), 'ACGT', 'CGTA')", f"substr(r, {first + 2}, 1)",
                      f"translate(substr(r, {first + 3}, 1), 'ACGT', 'CGTA')", f"substr(r, {first + 4}, {n - 4})"]
        elif o == "M" and off and k == 0:
            parts.append(f"substr(r, {first}, {n - off}), translate(substr(r, {first + n - off}, {off}), 'ACGT', 'CGTA')")
        elif o == "M" and off:
            parts.append(f"translate(substr(r, {first}, {off}), 'ACGT', 'CGTA'), substr(r, {first + off}, {n - off})")
        elif o == "M":
            parts.append(text)
        at += n if o in "MDN" else 0
    return f"concat({', '.join(parts)}, '')"


def _edge_prelude() -> str:
    bases = " ".join(f"WHEN {k} THEN {_edge_read(*x)}" for k, x in enumerate(EDGE_SHAPES))
    cigars = " ".join(f"WHEN {k} THEN '{x[0]}'" for k, x in enumerate(EDGE_SHAPES))
    return f"""
, edge_shapes AS (
  SELECT *, CASE shape {cigars} END AS cigar, CASE shape {bases} END AS bases,
         CASE WHEN sup = 1 THEN concat(chr, ',', cast(start_pos AS varchar(20)), ',+,40M,60,0;') END AS sa_tag
  FROM (SELECT *, cast((start_pos * 31 + q * 7 + mapq * 3 + k) % {len(EDGE_SHAPES)} AS integer) AS shape FROM rf) shaped),
edge_reads AS (
  SELECT read_name, sample, chr, start_pos + 10 AS start_pos, flag + CASE WHEN start_pos % 17 < 3 THEN 8 ELSE 0 END AS flag, mapq, cigar,
         CASE WHEN start_pos % 41 = 0 THEN '*' WHEN start_pos % 13 = 0 THEN concat(substr(bases, 1, 19), 'N', substr(bases, 21, 20)) ELSE bases END AS seq,
         concat(repeat(chr(33 + q), cast(start_pos % 37 AS integer)), chr(33 + cast(start_pos % 2 AS integer) * 20 + 5),
                repeat(chr(33 + q), 39 - cast(start_pos % 37 AS integer))) AS qual,
         CASE WHEN start_pos % 11 = 0 THEN 20 WHEN start_pos % 53 = 0 THEN NULL ELSE 7 END AS nm,
         CASE WHEN start_pos % 51 = 0 THEN NULL ELSE chr END AS mate_chr,
         CASE WHEN start_pos % 5 = 0 THEN start_pos % 9 ELSE start_pos + 60 END AS mate_start, 100 AS insert_size, sa_tag
  FROM edge_shapes)
"""


PRELUDE += _edge_prelude()

# Reads over two- and three-base changes at every 60th position: whole, cut by the read's end or start, clipped there,
# in two versions that share some bases, and of low quality (bases counted one by one) in every third stretch.
PRELUDE += """
, mnp_sites AS (
  SELECT *, CASE WHEN d < l0 THEN greatest(0 - d, 0) ELSE 60 - d END AS a, least(CASE WHEN d < l0 THEN l0 - d ELSE 60 - d + l1 END, 40) AS b
  FROM (SELECT *, cast(start_pos % 60 AS integer) AS d, cast(2 + floor(start_pos / 60) % 2 AS integer) AS l0,
               cast(2 + (floor(start_pos / 60) + 1) % 2 AS integer) AS l1 FROM rf) x),
mnp_bases AS (
  SELECT *, CASE WHEN k = 2 OR a >= 40 THEN substr(r, 1, 40)
                 ELSE concat(substr(r, 1, a), translate(substr(r, a + 1, b - a), 'ACGT', CASE WHEN k = 3 THEN 'TGCA' ELSE 'CGTA' END), substr(r, b + 1, 40 - b)) END AS seq,
         CASE WHEN k = 2 OR a >= 40 OR (mapq + q) % 3 > 0 THEN 0 WHEN a >= 28 THEN 3 WHEN b <= 12 THEN 5 ELSE 0 END AS clip
  FROM mnp_sites),
mnp_reads AS (
  SELECT read_name, sample, chr, start_pos + CASE WHEN clip = 5 THEN b ELSE 0 END AS start_pos, flag, mapq,
         CASE WHEN clip = 3 THEN concat(cast(a AS varchar(20)), 'M', cast(40 - a AS varchar(20)), 'S')
              WHEN clip = 5 THEN concat(cast(b AS varchar(20)), 'S', cast(40 - b AS varchar(20)), 'M') ELSE '40M' END AS cigar,
         seq, repeat(chr(33 + CASE WHEN floor(start_pos / 60) % 3 = 0 THEN q ELSE 30 + q % 10 END), 40) AS qual,
         CASE WHEN k = 2 OR a >= 40 OR clip > 0 THEN 0 ELSE b - a END AS nm,
         chr AS mate_chr, start_pos + 60 AS mate_start, 100 AS insert_size, cast(NULL AS varchar(20)) AS sa_tag
  FROM mnp_bases)
"""

# An amplicon panel over changes at every 20th position: in all reads, in another version or absent in every second
# stretch of 16 (neighbouring amplicons disagree), or as deletions; some amplicons are too long for their reads.
PRELUDE += """
, panel_starts AS (
  SELECT *, start_pos + shift AS s, substr(r, 1 + shift, 46) AS b, cast(floor((start_pos + shift) / 16) AS integer) AS w,
         cast((20 - (start_pos + shift) % 20) % 20 AS integer) AS a
  FROM (SELECT *, cast((16 - start_pos % 16) % 16 AS integer) AS shift FROM rf) x),
panel_sites AS (SELECT *, cast(floor((s + a) / 20) % 4 AS integer) AS y, CASE WHEN k = 3 AND chr IN ('chr1', 'chr2') THEN 1 ELSE 0 END AS other FROM panel_starts),
panel_alts AS (
  SELECT *, CASE WHEN k = 2 THEN 'ACGT' WHEN y = 0 THEN 'CGTA' WHEN y = 1 THEN CASE WHEN (w + other) % 2 = 0 THEN 'CGTA' ELSE 'GTAC' END
                 WHEN y = 2 AND w % 2 = 0 THEN 'CGTA' ELSE 'ACGT' END AS v1,
         CASE WHEN k = 2 THEN 'ACGT' WHEN y = 3 THEN 'CGTA' WHEN y = 0 THEN CASE WHEN (w + other) % 2 = 0 THEN 'CGTA' ELSE 'GTAC' END
              WHEN y = 1 AND w % 2 = 0 THEN 'CGTA' ELSE 'ACGT' END AS v2,
         CASE WHEN y = 3 AND a >= 8 AND k <> 2 THEN 1 ELSE 0 END AS gap
  FROM panel_sites),
panel_reads AS (
  SELECT read_name, sample, chr, s AS start_pos, flag, mapq,
         CASE WHEN gap = 1 THEN concat(cast(a AS varchar(20)), 'M6D', cast(40 - a AS varchar(20)), 'M') ELSE '40M' END AS cigar,
         CASE WHEN gap = 1 THEN concat(substr(b, 1, a), substr(b, a + 7, 40 - a))
              ELSE concat(substr(b, 1, a), translate(substr(b, a + 1, 1), 'ACGT', v1), substr(b, a + 2, 19),
                          translate(substr(b, a + 21, 1), 'ACGT', v2), substr(b, a + 22, 19 - a)) END AS seq,
         repeat(chr(33 + 30 + q % 10), 40) AS qual, CASE WHEN gap = 1 THEN 6 ELSE 2 END AS nm,
         cast(NULL AS varchar(20)) AS mate_chr, start_pos + 60 AS mate_start, 0 AS insert_size, cast(NULL AS varchar(20)) AS sa_tag
  FROM panel_alts),
panel AS (
  SELECT amplicon_id, chr, amp_start, amp_start + 39 + spare AS amp_end, gene, amp_start + 5 + spare % 3 AS istart, amp_start + 34 + spare - spare % 4 AS iend
  FROM (SELECT p_partkey AS amplicon_id, concat('chr', cast(1 + p_partkey % 5 AS varchar(20))) AS chr,
               16 * cast(1 + floor(p_partkey / 5) AS bigint) - p_size % 4 AS amp_start, 8 + p_size % 5 AS spare, p_name AS gene FROM part) y)
"""

# Reads that are clipped at long changes before every 64th position: new bases (30 or 14), 20 for 6, 12 for 20, 12 for 12,
# a repeat of 20, and one with 4 bases between the copies. Some right clips differ in one base.
PRELUDE += """
, gap_sites AS (
  SELECT *, cast((64 - start_pos % 64) % 64 AS integer) AS a, cast((floor((start_pos + 63) / 64) + cast(substr(chr, 4) AS integer)) % 7 AS integer) AS kind FROM rf),
gap_shapes AS (
  SELECT *, CASE kind WHEN 2 THEN 6 WHEN 3 THEN 20 WHEN 4 THEN 12 WHEN 5 THEN -20 WHEN 6 THEN -20 ELSE 0 END AS del,
         substr(translate(md5(concat(chr, ':new', cast(start_pos + a AS varchar(20)))), '0123456789abcdef', 'ACGTACGTACGTACGT'), 1,
                CASE kind WHEN 0 THEN 30 WHEN 1 THEN 14 WHEN 2 THEN 20 WHEN 5 THEN 0 WHEN 6 THEN 4 ELSE 12 END) AS fresh,
         CASE WHEN a > 28 OR a < CASE WHEN kind >= 5 THEN 20 ELSE 12 END THEN 0 WHEN k < 2 THEN 3 ELSE 5 END AS clip
  FROM gap_sites),
gap_bases AS (
  SELECT *, CASE WHEN clip = 5 AND chr = 'chr2' AND length(fresh) > 10 THEN concat(substr(fresh, 1, 7), translate(substr(fresh, 8, 1), 'ACGT', 'CGTA'), substr(fresh, 9, 30)) ELSE fresh END AS new
  FROM gap_shapes),
gap_ends AS (
  SELECT *, substr(concat(substr(r, 1, a), new, substr(r, a + del + 1, 64)), 1, 104) AS alt, a + length(new) AS edge,
         least(CASE WHEN kind >= 5 THEN 12 + (a + q) % 9 ELSE 12 + (a + q) % 17 END, a + length(new)) AS c
  FROM gap_bases),
gap_reads AS (
  SELECT read_name, sample, chr, CASE clip WHEN 5 THEN start_pos + a + del ELSE start_pos END AS start_pos, flag, mapq,
         CASE clip WHEN 3 THEN concat(cast(a AS varchar(20)), 'M', cast(40 - a AS varchar(20)), 'S')
                   WHEN 5 THEN concat(cast(c AS varchar(20)), 'S', cast(least(40 - c, 64 - a - del) AS varchar(20)), 'M') ELSE '40M' END AS cigar,
         CASE clip WHEN 3 THEN substr(alt, 1, 40) WHEN 5 THEN substr(alt, cast(edge - c + 1 AS integer), cast(c + least(40 - c, 64 - a - del) AS integer)) ELSE substr(r, 1, 40) END AS seq,
         repeat(chr(33 + 20 + q % 20), cast(CASE clip WHEN 5 THEN c + least(40 - c, 64 - a - del) ELSE 40 END AS integer)) AS qual, 0 AS nm,
         chr AS mate_chr, start_pos + 60 AS mate_start, 100 AS insert_size, cast(NULL AS varchar(20)) AS sa_tag
  FROM gap_ends)
"""

FIXTURE_TABLES = ("reads", "gap_reads", "edge_reads", "mnp_reads", "panel_reads", "panel", "ref_blocks", "contigs", "regions", "amplicons", "segments")
BLOCK = 32  # bases per reference block


_SPREAD_KEY = {"lineitem": "l_orderkey", "part": "p_partkey"}


def driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, spread by its key: its files hold one row group each."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.repartition(_SPREAD_KEY[name]) if name in _SPREAD_KEY else df


# The same text for Spark, which would put the expression of ``r`` into every use of it; it translates only the letters that ``r`` keeps.
SPARK_PRELUDE, _changed = re.subn(r"rf AS \(\s*SELECT \*, (substr\(.*?, 64\)) AS r\s+FROM off\)",
                                  r"rf AS (SELECT off.*, once.r FROM off LATERAL VIEW inline(array(struct(\1 AS r))) once)", PRELUDE, count=1, flags=re.DOTALL)
assert _changed == 1
_LETTERS = ", '0123456789abcdef', 'ACGTACGTACGTACGT')"
_head, _r, _tail = re.split(r"(substr\(concat\(.*?, 64\))(?= AS r\))", SPARK_PRELUDE, maxsplit=1, flags=re.DOTALL)
assert _r.count("translate(md5(") == _r.count(_LETTERS) == 3
SPARK_PRELUDE = _head + "translate(" + _r.replace("translate(md5(", "(md5(").replace(_LETTERS, ")") + _LETTERS + _tail

# An edge read's shape, CIGAR and bases likewise, which its other columns would repeat.
_shape = re.search(r"FROM \(SELECT \*, (cast\(\(start_pos \* 31.*? AS integer\)) AS shape FROM rf\) shaped", SPARK_PRELUDE, re.DOTALL)
_edge = re.search(r"edge_shapes AS \(\s*SELECT \*, (CASE shape .*?AS sa_tag)\s*FROM", SPARK_PRELUDE, re.DOTALL)
SPARK_PRELUDE = SPARK_PRELUDE.replace(_shape[0], f"FROM (SELECT rf.*, one.shape FROM rf LATERAL VIEW inline(array(struct({_shape[1]} AS shape))) one) shaped "
                                                 f"LATERAL VIEW inline(array(struct({_edge[1]}))) one")
SPARK_PRELUDE = SPARK_PRELUDE.replace(_edge[0], "edge_shapes AS (\n  SELECT shaped.*, one.* FROM")

_MEMO: dict = {}


def register_driver_tables(spark: SparkSession, sf_dir: str, names=("lineitem", "part")) -> None:
    for name in names:
        driver_table(spark, sf_dir, name).createOrReplaceTempView(name)


def fixture(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One derived table as a DataFrame.

    The derived tables stand in for the stored inputs of a real run (reads and
    reference as Parquet), so each is derived once per session, written to the
    shared folder and read from there, like any table in storage.
    """
    if table not in FIXTURE_TABLES:
        raise ValueError(table)
    key = (spark.sparkContext.applicationId, sf_dir, table)
    if key not in _MEMO:
        register_driver_tables(spark, sf_dir)
        path = shared_scratch(spark, f"fixture-{table}")
        spark.sql(SPARK_PRELUDE + f"\nSELECT * FROM {table}").write.parquet(path)
        _MEMO[key] = path
    return spark.read.parquet(_MEMO[key])


class _Tables(dict):
    """Derived tables by name, each made when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self._source = (spark, sf_dir)

    def __missing__(self, table: str) -> DataFrame:
        self[table] = fixture(*self._source, table)
        return self[table]


def fixtures(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return _Tables(spark, sf_dir)
