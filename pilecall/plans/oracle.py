"""DuckDB oracles for the query catalogue.

Written from the rules in SURVEY §2 with a deliberately different formulation
from the Spark plans: plain range predicates instead of bins, per-base
reference rows instead of windows, window functions over a row id instead of
array offsets. Each oracle is the shared fixture prelude plus CTEs below.
"""

from __future__ import annotations

from pilecall.fixtures import PRELUDE
from pilecall.plans import oracle_amplicon, oracle_complex, oracle_mnp, oracle_normalize, oracle_overlap

GOODQ = 25

# --- shared CTE text ----------------------------------------------------------

_READS = r"""
, rids AS (SELECT *, row_number() OVER (ORDER BY read_name, sample, start_pos, flag, cigar, seq, qual, mapq, nm) AS rid FROM reads)
, rl AS (
  SELECT *, start_pos + span - 1 AS end_pos, nm - idl AS tnm FROM (
    SELECT *,
      CAST(coalesce(list_sum(list_transform(regexp_extract_all(cigar, '(\d+)[MDN=X]', 1), lambda x: CAST(x AS INTEGER))), 0) AS INTEGER) AS span,
      CAST(coalesce(list_sum(list_transform(regexp_extract_all(cigar, '(\d+)[ID]', 1), lambda x: CAST(x AS INTEGER))), 0) AS INTEGER) AS idl,
      CAST(coalesce(list_sum(list_transform(regexp_extract_all(cigar, '(\d+)[MI=X]', 1), lambda x: CAST(x AS INTEGER))), 0) AS INTEGER) AS rlen1,
      CAST(coalesce(list_sum(list_transform(regexp_extract_all(cigar, '(\d+)[MIS=X]', 1), lambda x: CAST(x AS INTEGER))), 0) AS INTEGER) AS rlen2
    FROM rids) t)
, fr AS (SELECT * FROM rl WHERE seq <> '*' AND (flag & 256) = 0 AND nm IS NOT NULL AND tnm <= 8
  AND NOT ((flag & 8) = 0 AND mate_chr IS NOT DISTINCT FROM chr AND sa_tag IS NOT NULL AND (flag & 2048) <> 0))
, rg AS (SELECT g.*, c.length AS contig_len FROM regions g LEFT JOIN contigs c ON g.chr = c.chr)
"""

_OPS = r"""
, tok AS (
  SELECT rid, unnest(regexp_extract_all(cigar, '\d+[MIDNSHP=X]')) AS t,
         unnest(range(0, len(regexp_extract_all(cigar, '\d+[MIDNSHP=X]')))) AS idx,
         len(regexp_extract_all(cigar, '\d+[MIDNSHP=X]')) AS nops
  FROM fr)
, op1 AS (
  SELECT rid, CAST(idx AS INTEGER) AS idx, CAST(nops AS INTEGER) AS nops, CAST(regexp_extract(t, '(\d+)', 1) AS INTEGER) AS len,
         CASE WHEN right(t, 1) IN ('=', 'X') THEN 'M'
              WHEN right(t, 1) = 'I' AND (idx = 0 OR idx = nops - 1) THEN 'S' ELSE right(t, 1) END AS op
  FROM tok)
, ops AS (
  SELECT *,
    CAST(coalesce(sum(CASE WHEN op IN ('M', 'D', 'N') THEN len ELSE 0 END) OVER w, 0) AS INTEGER) AS rofs,
    CAST(coalesce(sum(CASE WHEN op IN ('M', 'I', 'S') THEN len ELSE 0 END) OVER w, 0) AS INTEGER) AS qofs,
    CAST(coalesce(sum(CASE WHEN op IN ('M', 'I') THEN len ELSE 0 END) OVER w, 0) AS INTEGER) AS pofs,
    lag(op) OVER (PARTITION BY rid ORDER BY idx) AS prev_op,
    first_value(op) OVER (PARTITION BY rid ORDER BY idx) AS first_op
  FROM op1
  WINDOW w AS (PARTITION BY rid ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
, refpos AS (
  SELECT chr, block_start + i AS pos, substr(seq, CAST(i AS INTEGER) + 1, 1) AS base
  FROM (SELECT chr, block_start, seq, unnest(range(0, length(seq))) AS i FROM ref_blocks) x)
"""


def _rr(sample_filter: str) -> str:
    return f"""
, rr AS (
  SELECT g.region_id, g.region_start, g.region_end, coalesce(g.contig_len, 4611686018427387904) AS contig_len, r.*
  FROM fr r JOIN rg g ON r.chr = g.chr AND r.start_pos < g.region_end AND r.end_pos > g.region_start
  WHERE {sample_filter})
, rops AS (
  SELECT rr.region_id, rr.chr, rr.region_start, rr.region_end, rr.contig_len, rr.rid, rr.start_pos, rr.seq, rr.qual,
         rr.flag, rr.mapq, rr.tnm, rr.rlen1, rr.rlen2, o.idx, o.len, o.op, o.rofs, o.qofs, o.pofs, o.nops,
         o.prev_op, o.first_op, rr.start_pos + o.rofs AS seg_start
  FROM rr JOIN ops o ON rr.rid = o.rid)
"""


def _tp(p: str) -> str:
    return f"(CASE WHEN {p} < rlen1 - ({p}) THEN {p} + 1 ELSE rlen1 - ({p}) END)"


def _q(idx0: str) -> str:
    return f"(ascii(substr(qual, CAST({idx0} AS INTEGER) + 1, 1)) - 33)"


def _ev(pos, allele, sgn, tp, q, std, cov, hilo, is_ins="false", nmoff="0") -> str:
    return (f"region_id, chr, region_start, region_end, contig_len, CAST({pos} AS BIGINT) AS pos, {allele} AS allele, "
            f"{is_ins} AS is_ins, {sgn} AS sgn, flag, mapq, tnm, CAST({tp} AS BIGINT) AS tp, CAST({q} AS DOUBLE) AS q, "
            f"{std} AS std, {cov} AS cov, {hilo} AS hilo, {nmoff} AS nmoff")


_IN_REGION = "BETWEEN region_start AND region_end"

_PILEUP = f"""
, mb AS (
  SELECT x.*, x.seg_start + i AS pos, x.qofs + i AS n, x.pofs + i AS p,
         substr(x.seq, CAST(x.qofs + i AS INTEGER) + 1, 1) AS base
  FROM (SELECT *, CAST(unnest(range(0, len)) AS INTEGER) AS i FROM rops WHERE op = 'M') x)
, mbr AS (
  SELECT mb.*, coalesce(mb.base <> 'N' AND rp.base IS NOT NULL AND rp.base <> 'N' AND mb.base <> rp.base, false) AS mm
  FROM mb LEFT JOIN refpos rp ON rp.chr = mb.chr AND rp.pos = mb.pos)
, mmr AS (SELECT *, i - row_number() OVER (PARTITION BY region_id, rid, idx ORDER BY i) AS grp FROM mbr WHERE mm)
, runs AS (
  SELECT region_id, rid, idx, grp, min(i) AS a, max(i) AS b,
         min(CASE WHEN {_q('qofs + i')} >= {GOODQ} AND seg_start + i >= region_start - 1 THEN i END) AS f,
         any_value(seg_start) AS seg_start, any_value(region_start) AS region_start, any_value(region_end) AS region_end
  FROM mmr GROUP BY region_id, rid, idx, grp)
, mnp AS (
  SELECT region_id, rid, idx, f, least(b, region_end - seg_start) - f + 1 AS l
  FROM runs WHERE f IS NOT NULL AND least(b, region_end - seg_start) > f)
, mrole AS (
  SELECT mbr.*, m.f, m.l,
         CASE WHEN m.f IS NULL OR mbr.i < m.f OR mbr.i >= m.f + m.l THEN 'single' WHEN mbr.i = m.f THEN 'head' ELSE 'inner' END AS role,
         CAST((SELECT coalesce(sum(o.l - 1), 0) FROM mnp o
               WHERE o.region_id = mbr.region_id AND o.rid = mbr.rid AND o.idx = mbr.idx AND o.f <= mbr.i) AS INTEGER) AS nmoff
  FROM mbr LEFT JOIN mnp m ON m.region_id = mbr.region_id AND m.rid = mbr.rid AND m.idx = mbr.idx
                           AND mbr.i BETWEEN m.f AND m.f + m.l - 1)
, s5 AS (
  SELECT x.*, CAST(t AS INTEGER) AS t,
         coalesce(start_pos - 1 - t > 0 AND start_pos - 1 - t <= contig_len
                  AND substr(seq, CAST(len - t AS INTEGER), 1) = rp.base
                  AND ascii(substr(qual, CAST(len - t AS INTEGER), 1)) - 33 > 10, false) AS ok
  FROM (SELECT *, unnest(range(0, len)) AS t FROM rops WHERE op = 'S' AND idx = 0) x
  LEFT JOIN refpos rp ON rp.chr = x.chr AND rp.pos = x.start_pos - 1 - x.t)
, s5n AS (SELECT region_id, rid, coalesce(min(CASE WHEN NOT ok THEN t END), any_value(len)) AS rescued FROM s5 GROUP BY region_id, rid)
, s3 AS (
  SELECT x.*, CAST(t AS INTEGER) AS t,
         coalesce(substr(seq, CAST(qofs + t AS INTEGER) + 1, 1) = rp.base
                  AND ascii(substr(qual, CAST(qofs + t AS INTEGER) + 1, 1)) - 33 > 10, false) AS ok
  FROM (SELECT *, unnest(range(0, len)) AS t FROM rops WHERE op = 'S' AND idx = nops - 1 AND idx > 0) x
  LEFT JOIN refpos rp ON rp.chr = x.chr AND rp.pos = x.seg_start + x.t)
, s3n AS (SELECT region_id, rid, coalesce(min(CASE WHEN NOT ok THEN t END), any_value(len)) AS rescued FROM s3 GROUP BY region_id, rid)
, ins AS (
  SELECT rops.*, seg_start - 1 AS anchor, '+' || substr(seq, qofs + 1, len) AS key,
         (SELECT avg(ascii(substr(qual, CAST(qofs + k AS INTEGER) + 1, 1)) - 33) FROM range(0, len) u(k)) AS iq,
         rp.base AS rbase
  FROM rops LEFT JOIN refpos rp ON rp.chr = rops.chr AND rp.pos = rops.seg_start - 1
  WHERE op = 'I' AND seg_start - 1 {_IN_REGION} AND NOT contains('+' || substr(seq, qofs + 1, len), 'N'))
, ev AS (
  SELECT {_ev('pos', 'base', 1, _tp('p'), _q('n'), 'true', 1, 'true', nmoff='nmoff')} FROM mrole
   WHERE role = 'single' AND base <> 'N' AND pos {_IN_REGION}
  UNION ALL
  SELECT {_ev('pos', "base || '&' || substr(seq, CAST(n AS INTEGER) + 2, CAST(l AS INTEGER) - 1)", 1, _tp('p + l - 1'),
               f"(SELECT avg(ascii(substr(qual, CAST(n + k AS INTEGER) + 1, 1)) - 33) FROM range(0, l) u(k))", 'true', 1, 'true', nmoff='nmoff')}
    FROM mrole WHERE role = 'head' AND base <> 'N' AND pos {_IN_REGION}
  UNION ALL
  SELECT {_ev('pos', "''", 0, 0, 0, 'false', 1, 'false')} FROM mrole WHERE role = 'inner' AND base <> 'N' AND pos {_IN_REGION} AND seg_start + f {_IN_REGION}
  UNION ALL
  SELECT {_ev('anchor', 'key', 1, _tp('pofs'), 'iq', 'true', 1, 'true', 'true')} FROM ins
  UNION ALL
  SELECT {_ev('anchor', 'substr(seq, qofs, 1)', -1, _tp('pofs'), _q('qofs - 1'), 'false', 0, 'true')} FROM ins
   WHERE prev_op = 'M' AND substr(seq, qofs, 1) = rbase
  UNION ALL
  SELECT {_ev('anchor', 'rbase', 1, _tp('pofs'), 'iq', 'false', 1, 'false')} FROM ins
   WHERE idx = 1 AND first_op IN ('S', 'H') AND rbase IS NOT NULL
  UNION ALL
  SELECT {_ev('seg_start', "'-' || CAST(len AS VARCHAR)", 1, _tp('pofs'),
              "ascii(CASE WHEN qofs >= length(qual) THEN substr(qual, qofs, 1) WHEN qofs < 1 THEN substr(qual, qofs + 1, 1) "
              "ELSE greatest(substr(qual, qofs, 1), substr(qual, qofs + 1, 1)) END) - 33", 'true', 1, 'true')}
    FROM rops WHERE op = 'D' AND seg_start {_IN_REGION}
  UNION ALL
  SELECT {_ev('seg_start + k', "''", 0, 0, 0, 'false', 1, 'false')}
    FROM (SELECT *, unnest(range(1, len)) AS k FROM rops WHERE op = 'D' AND seg_start {_IN_REGION}) d
   WHERE seg_start + k {_IN_REGION}
  UNION ALL
  SELECT {_ev('start_pos - 1 - t', 'substr(seq, CAST(len - t AS INTEGER), 1)', 1, 'len - t', _q('len - 1 - t'), 'false', 1, 'true')}
    FROM s5 JOIN s5n USING (region_id, rid) WHERE t < rescued AND start_pos - 1 - t {_IN_REGION}
  UNION ALL
  SELECT {_ev('seg_start + t', 'substr(seq, CAST(qofs + t AS INTEGER) + 1, 1)', 1, 'rlen2 - (pofs + t)', _q('qofs + t'), 'false', 1, 'true')}
    FROM s3 JOIN s3n USING (region_id, rid) WHERE t < rescued AND seg_start + t {_IN_REGION})
, al AS (
  SELECT region_id, chr, region_start, region_end, contig_len, pos, allele, is_ins,
    CAST(sum(sgn) AS BIGINT) AS cnt,
    CAST(sum(CASE WHEN (flag & 16) = 0 THEN sgn ELSE 0 END) AS BIGINT) AS fwd,
    CAST(sum(CASE WHEN (flag & 16) <> 0 THEN sgn ELSE 0 END) AS BIGINT) AS rev,
    CAST(sum(sgn * tp) AS BIGINT) AS tp_sum,
    CAST(sum(sgn * q) AS DOUBLE) AS q_sum,
    CAST(sum(sgn * mapq) AS BIGINT) AS mq_sum,
    CAST(sum(sgn * (tnm - nmoff)) AS BIGINT) AS nm_sum,
    CAST(sum(CASE WHEN hilo AND q >= {GOODQ} THEN sgn ELSE 0 END) AS BIGINT) AS hicnt,
    CAST(sum(CASE WHEN hilo AND q < {GOODQ} THEN sgn ELSE 0 END) AS BIGINT) AS locnt,
    min(CASE WHEN std THEN tp END) <> max(CASE WHEN std THEN tp END) AS pstd,
    min(CASE WHEN std THEN q END) <> max(CASE WHEN std THEN q END) AS qstd,
    CAST(sum(cov) AS BIGINT) AS cov_add
  FROM ev GROUP BY region_id, chr, region_start, region_end, contig_len, pos, allele, is_ins)
"""


def _r(x: str, dp: int) -> str:
    s = 10 ** dp
    return f"(floor(({x}) * {s}.0 + 0.5) / {s}.0)"


_BIAS = ("CASE WHEN fwd + rev <= 12 THEN (CASE WHEN fwd * rev > 0 THEN 2 ELSE 0 END) "
         "WHEN fwd / (fwd + rev) >= 0.05 AND rev / (fwd + rev) >= 0.05 AND fwd >= 2 AND rev >= 2 THEN 2 ELSE 1 END")

_STATS = f"""
, st0 AS (
  SELECT al.*, CAST(sum(cov_add) OVER wp AS BIGINT) AS tcov, CAST(sum(hicnt) OVER wp AS BIGINT) AS hicov,
         count(CASE WHEN allele <> '' AND NOT is_ins THEN 1 END) OVER wp + max(CASE WHEN is_ins THEN 1 ELSE 0 END) OVER wp AS nkeys,
         max(CASE WHEN allele <> '' AND NOT is_ins THEN 1 ELSE 0 END) OVER wp AS has_base
  FROM al WHERE pos {_IN_REGION}
  WINDOW wp AS (PARTITION BY region_id, pos))
, st1 AS (
  SELECT st0.*, coalesce(rp.base, '') AS ref_base
  FROM st0 LEFT JOIN refpos rp ON rp.chr = st0.chr AND rp.pos = st0.pos
  WHERE allele <> '' AND tcov > 0 AND has_base = 1)
, st AS (
  SELECT *, (NOT is_ins AND allele = ref_base) AS is_ref, (nkeys = 1 AND NOT is_ins AND allele = ref_base) AS only_ref,
    {_BIAS} AS bias_flag,
    {_r('q_sum / cnt', 1)} AS qual,
    mq_sum / cnt AS mapq_raw,
    cnt / tcov AS freq_raw,
    {_r('tp_sum / cnt', 1)} AS pmean,
    hicnt / (CASE WHEN locnt <> 0 THEN CAST(locnt AS DOUBLE) ELSE 0.5 END) AS qratio_raw,
    CASE WHEN hicov > 0 THEN hicnt / hicov ELSE 0.0 END AS hifreq_raw,
    nm_sum / cnt AS nm_raw,
    coalesce(pstd, false) AS pstd2, coalesce(qstd, false) AS qstd2
  FROM st1 WHERE is_ins OR cnt <> 0)
, rk0 AS (
  SELECT *,
    max(CASE WHEN NOT is_ref THEN freq_raw END) OVER wp AS maxfreq,
    max(CASE WHEN is_ref THEN 1 ELSE 0 END) OVER wp AS has_ref,
    max(CASE WHEN is_ref THEN freq_raw END) OVER wp AS ref_freq,
    max(CASE WHEN is_ref THEN fwd END) OVER wp AS ref_fwd,
    max(CASE WHEN is_ref THEN rev END) OVER wp AS ref_rev,
    max(CASE WHEN is_ref THEN bias_flag END) OVER wp AS ref_bias,
    max(CASE WHEN is_ref THEN hicnt END) OVER wp AS ref_hicnt,
    max(CASE WHEN is_ref THEN mapq_raw END) OVER wp AS ref_mapq,
    max(CASE WHEN is_ref THEN allele END) OVER wp AS ref_key
  FROM st WINDOW wp AS (PARTITION BY region_id, pos))
, rk1 AS (
  SELECT *, row_number() OVER (PARTITION BY region_id, pos ORDER BY qual * cnt DESC, is_ins ASC, allele ASC) AS rank
  FROM rk0 WHERE NOT only_ref AND coalesce(maxfreq, 0.0) > 0.05 AND NOT is_ref)
, rk AS (SELECT *, max(CASE WHEN rank = 1 THEN allele END) OVER (PARTITION BY region_id, pos) AS top FROM rk1)
"""


def _jr(a: str, b: str) -> str:
    """joinRef over the loaded flank (region +- 700, clamped to the contig)."""
    return (f"(SELECT coalesce(string_agg(base, '' ORDER BY pos), '') FROM refpos r WHERE r.chr = cv.chr "
            f"AND r.pos BETWEEN greatest({a}, greatest(1, cv.region_start - 700)) AND least({b}, least(cv.region_end + 700, cv.contig_len)))")


def _msi(t1: str, t2: str, left: str | None, out: str) -> str:
    s1 = f"({left} || {t1})" if left else t1
    cs = (f"list_transform(range(1, least(8, length({t1})) + 1), lambda k: "
          f"len(list_filter(range(1, greatest(1, length({s1}) // k) + 1), lambda c: c * k <= length({s1}) "
          f"AND right({s1}, CAST(c * k AS INTEGER)) = repeat(right({t1}, CAST(k AS INTEGER)), CAST(c AS INTEGER)))) "
          f"+ len(list_filter(range(1, greatest(1, length({t2}) // k) + 1), lambda c: c * k <= length({t2}) "
          f"AND left({t2}, CAST(c * k AS INTEGER)) = repeat(right({t1}, CAST(k AS INTEGER)), CAST(c AS INTEGER)))))")
    shift = (f"CASE WHEN length({t2}) = 0 THEN 0 ELSE coalesce(list_position(list_transform(range(1, length({t2}) + 1), "
             f"lambda i: substr({t1} || {t2}, CAST(i AS INTEGER), 1) = substr({t2}, CAST(i AS INTEGER), 1)), false) - 1, length({t2})) END")
    return (f"CASE WHEN length({t1}) = 0 THEN 0.0 ELSE CAST(list_max({cs}) AS DOUBLE) END AS {out}_msi, "
            f"CASE WHEN length({t1}) = 0 OR list_max({cs}) = 0 THEN 0 ELSE list_position({cs}, list_max({cs})) END AS {out}_unit, "
            f"{shift} AS {out}_shift3")


_CALLS = f"""
, cv AS (
  SELECT rk.*, CASE WHEN allele LIKE '-%' THEN CAST(regexp_extract(allele, '^-(\\d+)', 1) AS INTEGER) ELSE 0 END AS dellen
  FROM rk)
, cf AS (
  SELECT cv.*,
    {_jr('cv.pos', 'cv.pos')} AS ref_p,
    substr(allele, 2) AS ins_seq,
    {_jr('greatest(cv.pos - 50, 1)', 'cv.pos')} AS ins_left,
    {_jr('cv.pos + 1', 'least(cv.pos + 70, cv.contig_len)')} AS ins_right,
    {_jr('greatest(cv.pos - 70, 1)', 'cv.pos - 1')} AS del_left,
    {_jr('cv.pos', 'least(cv.pos + cv.dellen + 70, cv.contig_len)')} AS del_tseq,
    {_jr('greatest(cv.pos - 30, 1)', 'cv.pos + 1')} AS snv_t1,
    {_jr('cv.pos + 2', 'least(cv.pos + 70, cv.contig_len)')} AS snv_t2,
    {_jr('cv.pos - 1', 'cv.pos - 1')} AS ref_prev,
    {_jr('cv.pos', 'cv.pos + cv.dellen - 1')} AS ref_del
  FROM cv)
, cf2 AS (SELECT *, substr(del_tseq, 1, dellen) AS del_t1, substr(del_tseq, dellen + 1) AS del_t2 FROM cf)
, cm AS (
  SELECT *,
    {_msi('ins_seq', 'ins_right', 'ins_left', 'mi1')},
    {_msi('ins_left', 'ins_right', None, 'mi2')},
    {_msi('del_t1', 'del_t2', 'del_left', 'md1')},
    {_msi('del_left', 'del_t2', 'del_left', 'md2')},
    {_msi('snv_t1', 'snv_t2', None, 'ms')},
    allele LIKE '+%' AND NOT contains(allele, '&') AND NOT contains(allele, '#') AS plain_ins,
    allele LIKE '-%' AS is_del, allele LIKE '+%' AS is_ins2,
    allele LIKE '-%' AND NOT contains(allele, '&') AND NOT contains(allele, '#') AND NOT contains(allele, '^') AS simple_del
  FROM cf2)
, cb AS (
  SELECT *,
    CASE WHEN plain_ins THEN (CASE WHEN mi1_msi < mi2_msi THEN mi2_msi ELSE mi1_msi END)
         WHEN is_del THEN (CASE WHEN md1_msi < md2_msi THEN md2_msi ELSE md1_msi END)
         WHEN is_ins2 THEN 0.0 ELSE ms_msi END AS b_msi,
    CASE WHEN plain_ins THEN (CASE WHEN mi1_msi < mi2_msi THEN mi2_unit ELSE mi1_unit END)
         WHEN is_del THEN (CASE WHEN md1_msi < md2_msi THEN md2_unit ELSE md1_unit END)
         WHEN is_ins2 THEN 0 ELSE ms_unit END AS b_unit,
    CASE WHEN plain_ins THEN (CASE WHEN mi1_msi < mi2_msi THEN mi2_shift3 ELSE mi1_shift3 END)
         WHEN is_del THEN (CASE WHEN md1_msi < md2_msi THEN md2_shift3 ELSE md1_shift3 END)
         WHEN is_ins2 THEN 0 ELSE ms_shift3 END AS b_shift3
  FROM cm)
, ca AS (
  SELECT *,
    CASE WHEN plain_ins AND b_msi <= b_shift3 / length(ins_seq) THEN b_shift3 / length(ins_seq)
         WHEN is_del AND b_msi <= b_shift3 / dellen THEN b_shift3 / dellen ELSE b_msi END AS msi,
    b_shift3 AS shift3, b_unit AS msint,
    CASE WHEN is_ins2 THEN pos WHEN simple_del THEN pos - 1 ELSE pos END AS sp0,
    CASE WHEN is_ins2 THEN pos WHEN is_del THEN pos + dellen - 1 ELSE pos END AS ep0,
    CASE WHEN is_ins2 THEN ref_p WHEN simple_del THEN ref_prev || ref_del WHEN is_del THEN ref_del ELSE ref_p END AS ref0,
    CASE WHEN is_ins2 THEN ref_p || ins_seq WHEN simple_del THEN ref_prev WHEN is_del THEN regexp_replace(allele, '^-\\d+', '')
         ELSE allele END AS alt0,
    regexp_extract(allele, '&([ATGC]+)', 1) AS extra
  FROM cb)
, cx AS (
  SELECT *, CASE WHEN extra <> '' THEN {_jr('ca.ep0 + 1', 'ca.ep0 + length(ca.extra)').replace('cv.', 'ca.')} ELSE '' END AS tch
  FROM ca)
, cy AS (
  SELECT *,
    CASE WHEN extra <> '' AND is_ins2 THEN substr(ref0 || tch, 2) ELSE ref0 || tch END AS ref_allele,
    CASE WHEN extra <> '' AND is_ins2 THEN substr(regexp_replace(alt0, '&', ''), 2) WHEN extra <> '' THEN regexp_replace(alt0, '&', '') ELSE alt0 END AS alt_allele,
    CASE WHEN extra <> '' AND is_ins2 THEN sp0 + 1 ELSE sp0 END AS sp,
    ep0 + length(extra) AS ep1
  FROM cx)
"""


def _plus(x: str) -> str:
    return f"(CASE WHEN {x} LIKE '+%' THEN '+' || CAST(length({x}) - 1 AS VARCHAR) ELSE {x} END)"


_CALLS2 = f"""
, cg AS (
  SELECT *,
    replace(replace(replace(
      {_plus("(CASE WHEN has_ref = 1 AND ref_freq >= 0.05 THEN ref_key ELSE top END)")} || tch || '/' || {_plus('allele')},
      '&', ''), '#', ''), '^', 'i') AS genotype
  FROM cy)
, ce AS (
  SELECT *, CASE WHEN regexp_extract(genotype, '\\+(\\d+)', 1) <> '' THEN sp + CAST(regexp_extract(genotype, '\\+(\\d+)', 1) AS BIGINT) ELSE ep1 END AS ep
  FROM cg)
, cfin AS (
  SELECT *,
    {_jr('greatest(ce.sp - 20, 1)', 'ce.sp - 1').replace('cv.', 'ce.')} AS leftseq,
    {_jr('ce.ep + 1', 'least(ce.ep + 20, ce.contig_len)').replace('cv.', 'ce.')} AS rightseq,
    CASE WHEN length(ref_allele) = 1 AND length(alt_allele) = 1 THEN 'SNV'
         WHEN length(ref_allele) = 0 OR length(alt_allele) = 0 THEN 'Complex'
         WHEN substr(ref_allele, 1, 1) <> substr(alt_allele, 1, 1) THEN 'Complex'
         WHEN length(ref_allele) = 1 AND length(alt_allele) > 1 AND starts_with(alt_allele, ref_allele) THEN 'Insertion'
         WHEN length(ref_allele) > 1 AND length(alt_allele) = 1 AND starts_with(ref_allele, alt_allele) THEN 'Deletion'
         ELSE 'Complex' END AS vartype,
    CAST(coalesce(CAST(ref_bias AS VARCHAR), '0') || ';' || CAST(bias_flag AS VARCHAR) AS VARCHAR) AS bias
  FROM ce)
"""


def _splices(src: str) -> str:
    return f"""
, spl AS (
  SELECT region_id, CAST(seg_start - 1 AS VARCHAR) || '-' || CAST(seg_start + len - 1 AS VARCHAR) AS junction, CAST(count(*) AS BIGINT) AS cnt
  FROM {src} WHERE op = 'N' GROUP BY ALL)
"""


_GOOD = f"""
, gv AS (
  SELECT cfin.*, (s.junction IS NOT NULL) AS is_splice
  FROM cfin LEFT JOIN (SELECT DISTINCT region_id, junction FROM spl) s
    ON s.region_id = cfin.region_id AND s.junction = CAST(cfin.sp AS VARCHAR) || '-' || CAST(cfin.ep AS VARCHAR))
, gd AS (
  SELECT *,
    CASE WHEN length(ref_allele) = 0 THEN 'no_ref'
      WHEN freq_raw < 0.05 OR hicnt < 2 OR pmean < 5 OR qual < {GOODQ} THEN 'low_support'
      WHEN has_ref = 1 AND ref_hicnt > 2 AND freq_raw < 0.25 AND (
          ((mapq_raw + length(ref_allele) + length(alt_allele)) - 2 < 5 AND ref_mapq > 20)
          OR (1 + mapq_raw + length(ref_allele) + length(alt_allele)) / (ref_mapq + 1) < 0.25) THEN 'mapq_contest'
      WHEN vartype = 'Deletion' AND is_splice THEN 'splice'
      WHEN qratio_raw < 1.5 THEN 'qratio'
      WHEN freq_raw > 0.35 THEN NULL
      WHEN mapq_raw < 0 THEN 'mapq'
      WHEN msi >= 13 AND freq_raw <= 0.275 AND msint = 1 THEN 'msi'
      WHEN msi >= 8 AND freq_raw <= 0.2 AND msint > 1 THEN 'msi'
      WHEN bias = '2;1' AND freq_raw < 0.25 AND (vartype = 'SNV' OR (length(ref_allele) <= 3 AND length(alt_allele) <= 3)) THEN 'strand_bias'
    END AS reason
  FROM gv)
"""


def _trim(src: str) -> str:
    """F13 on ``src`` -> CTE ``tr``."""
    return f"""
, tr0 AS (
  SELECT *, CASE WHEN vartype = 'Complex' THEN coalesce(list_position(list_transform(range(0, greatest(least(length(ref_allele), length(alt_allele)) - 1, 1)),
      lambda n: length(ref_allele) - n > 1 AND length(alt_allele) - n > 1 AND substr(ref_allele, CAST(n AS INTEGER) + 1, 1) = substr(alt_allele, CAST(n AS INTEGER) + 1, 1)), false) - 1,
      greatest(least(length(ref_allele), length(alt_allele)) - 1, 0)) ELSE 0 END AS tn
  FROM {src})
, tr1 AS (
  SELECT * REPLACE (
    sp + tn AS sp,
    CASE WHEN tn > 0 THEN substr(leftseq || substr(ref_allele, 1, tn), tn + 1) ELSE leftseq END AS leftseq,
    CASE WHEN tn > 0 THEN substr(ref_allele, tn + 1) ELSE ref_allele END AS ref_allele,
    CASE WHEN tn > 0 THEN substr(alt_allele, tn + 1) ELSE alt_allele END AS alt_allele)
  FROM tr0)
, tr2 AS (
  SELECT *, CASE WHEN vartype = 'Complex' THEN coalesce(list_position(list_transform(range(1, greatest(least(length(ref_allele), length(alt_allele)), 2)),
      lambda k: length(ref_allele) - k > 0 AND length(alt_allele) - k > 0 AND substr(ref_allele, CAST(-k AS INTEGER), 1) = substr(alt_allele, CAST(-k AS INTEGER), 1)), false),
      greatest(least(length(ref_allele), length(alt_allele)), 1)) ELSE 1 END AS tm
  FROM tr1)
, tr AS (
  SELECT * REPLACE (
    ep - (tm - 1) AS ep,
    CASE WHEN tm > 1 THEN substr(ref_allele, length(ref_allele) - tm + 2) || substr(rightseq, 1, greatest(length(rightseq) - tm + 1, 0)) ELSE rightseq END AS rightseq,
    CASE WHEN tm > 1 THEN substr(ref_allele, 1, length(ref_allele) - tm + 1) ELSE ref_allele END AS ref_allele,
    CASE WHEN tm > 1 THEN substr(alt_allele, 1, length(alt_allele) - tm + 1) ELSE alt_allele END AS alt_allele)
  FROM tr2)
"""


_CLIPS = r"""
, cw AS (
  SELECT x.*, CAST(t2 AS INTEGER) AS t2 FROM (
    SELECT s.region_id, s.rid, 5 AS side, s.seq, s.qual, s.region_start, s.region_end, s.flag,
           s.start_pos - n.rescued AS pos, s.len - n.rescued AS m, s.len - n.rescued - 1 AS base0, -1 AS dir1,
           unnest(range(0, s.len - n.rescued)) AS t2
    FROM (SELECT DISTINCT region_id, rid, seq, qual, region_start, region_end, flag, start_pos, len FROM s5) s JOIN s5n n USING (region_id, rid)
    WHERE s.len - n.rescued > 0
    UNION ALL
    SELECT s.region_id, s.rid, 3 AS side, s.seq, s.qual, s.region_start, s.region_end, s.flag,
           s.seg_start + n.rescued AS pos, s.len - n.rescued AS m, s.qofs + n.rescued AS base0, 1 AS dir1,
           unnest(range(0, s.len - n.rescued)) AS t2
    FROM (SELECT DISTINCT region_id, rid, seq, qual, region_start, region_end, flag, seg_start, qofs, len FROM s3) s JOIN s3n n USING (region_id, rid)
    WHERE s.len - n.rescued > 0) x)
, cw2 AS (
  SELECT *, substr(seq, CAST(base0 + dir1 * t2 AS INTEGER) + 1, 1) AS base,
         ascii(substr(qual, CAST(base0 + dir1 * t2 AS INTEGER) + 1, 1)) - 33 AS tq
  FROM cw)
, cw3 AS (SELECT *, sum(CASE WHEN tq <= 12 THEN 1 ELSE 0 END) OVER (PARTITION BY region_id, rid, side ORDER BY t2) AS runlow FROM cw2)
, cst AS (
  SELECT region_id, rid, side, any_value(m) AS m, any_value(pos) AS pos, any_value(region_start) AS region_start,
         any_value(region_end) AS region_end, min(CASE WHEN base = 'N' OR runlow > 1 THEN t2 END) AS stop_t
  FROM cw3 GROUP BY region_id, rid, side)
, cst2 AS (
  SELECT c.*, coalesce(stop_t, m) AS qn,
    (SELECT count(*) FROM cw3 w WHERE w.region_id = c.region_id AND w.rid = c.rid AND w.side = c.side AND w.t2 < coalesce(c.stop_t, c.m) AND w.tq <= 12)
    + CASE WHEN stop_t IS NOT NULL AND (SELECT any_value(base) FROM cw3 w WHERE w.region_id = c.region_id AND w.rid = c.rid AND w.side = c.side AND w.t2 = c.stop_t) <> 'N' THEN 1 ELSE 0 END AS lowcnt
  FROM cst c)
, ckeep AS (SELECT * FROM cst2 WHERE qn >= 1 AND qn > lowcnt AND pos BETWEEN region_start - 200 AND region_end + 200)
, ctab AS (
  SELECT w.region_id, w.side, CAST(w.pos AS BIGINT) AS pos, w.t2 AS cidx, w.base, CAST(count(*) AS BIGINT) AS cnt, CAST(sum(w.tq) AS BIGINT) AS q_sum
  FROM cw3 w JOIN ckeep k ON k.region_id = w.region_id AND k.rid = w.rid AND k.side = w.side AND w.t2 < k.qn
  GROUP BY w.region_id, w.side, w.pos, w.t2, w.base)
"""

_CONSENSUS = r"""
, cc0 AS (
  SELECT *, sum(cnt) OVER (PARTITION BY region_id, side, pos, cidx) AS tt,
         row_number() OVER (PARTITION BY region_id, side, pos, cidx ORDER BY q_sum DESC, base ASC) AS r
  FROM ctab)
, cc1 AS (
  SELECT *, sum(CASE WHEN (tt - cnt > 2 OR cnt <= tt - cnt) AND cnt / tt < 0.8 THEN 1 ELSE 0 END)
              OVER (PARTITION BY region_id, side, pos ORDER BY cidx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS weak_run,
         max(cidx) OVER (PARTITION BY region_id, side, pos) AS last_idx
  FROM cc0 WHERE r = 1)
, cc2 AS (
  SELECT region_id, side, pos, string_agg(base, '' ORDER BY cidx) AS seq, sum(tt) AS total, sum(cnt) AS "match", max(last_idx) AS li
  FROM cc1 WHERE weak_run <= 1 GROUP BY region_id, side, pos)
, cons AS (
  SELECT region_id, side, pos, CAST(total AS BIGINT) AS total, CAST("match" AS BIGINT) AS "match",
    CASE WHEN total <> 0 AND "match" / total > 0.9 AND length(seq) / 1.5 > li - length(seq)
          AND (CASE WHEN li = 0 THEN true ELSE length(seq) / li > 0.8 END OR li - length(seq) < 10 OR length(seq) > 25)
         THEN seq ELSE '' END AS consensus
  FROM cc2)
"""


def _with(*ctes: str) -> str:
    return PRELUDE + "".join(ctes)


_TUMOR = "r.sample = 'tumor'"


def _pileup_ctes(sample_filter: str = "true") -> tuple[str, ...]:
    return (_READS, _OPS, _rr(sample_filter), _PILEUP)


def _cand_ctes(sample_filter: str = "true") -> tuple[str, ...]:
    return (*_pileup_ctes(sample_filter), _STATS, _CALLS, _CALLS2)


_ACC = "region_id, pos, allele, cnt, fwd, rev, tp_sum, q_sum, mq_sum, nm_sum, hicnt, locnt, pstd, qstd"

_FINAL = f"""
SELECT region_id, sample, gene, chr, CAST(sp AS BIGINT) AS start, CAST(ep AS BIGINT) AS "end", ref_allele, alt_allele,
  CAST(tcov AS BIGINT) AS tcov, CAST(cnt AS BIGINT) AS cov, CAST(coalesce(ref_fwd, 0) AS BIGINT) AS rfc,
  CAST(coalesce(ref_rev, 0) AS BIGINT) AS rrc, CAST(fwd AS BIGINT) AS fwd, CAST(rev AS BIGINT) AS rev, genotype,
  {_r('freq_raw', 4)} AS freq, bias, pmean, CAST(pstd2 AS INTEGER) AS pstd, qual, CAST(qstd2 AS INTEGER) AS qstd,
  {_r('mapq_raw', 1)} AS mapq, {_r('qratio_raw', 3)} AS qratio, {_r('hifreq_raw', 4)} AS hifreq, 0.0 AS extrafreq,
  CAST(shift3 AS INTEGER) AS shift3, {_r('msi', 3)} AS msi, CAST(msint AS INTEGER) AS msint, {_r('nm_raw', 1)} AS nm,
  CAST(hicnt AS BIGINT) AS hicnt, CAST(hicov AS BIGINT) AS hicov,
  CASE WHEN leftseq = '' THEN '0' ELSE leftseq END AS leftseq, CASE WHEN rightseq = '' THEN '0' ELSE rightseq END AS rightseq,
  chr || ':' || CAST(region_start AS VARCHAR) || '-' || CAST(region_end AS VARCHAR) AS region, vartype
FROM (SELECT tr.*, 'tumor' AS sample, g.gene FROM tr JOIN regions g ON g.region_id = tr.region_id)
"""


def _pileup_mode_sql() -> str:
    """all alleles (no F4/F5/G1), the reference row, or a zero row per region position."""
    stats = _STATS.replace("WHERE NOT only_ref AND coalesce(maxfreq, 0.0) > 0.05 AND NOT is_ref", "WHERE NOT is_ref")
    calls2 = _CALLS2.replace("ref_freq >= 0.05", "ref_freq >= -1")
    assert stats != _STATS and calls2 != _CALLS2
    region = "chr || ':' || CAST(region_start AS VARCHAR) || '-' || CAST(region_end AS VARCHAR)"
    body = _with(*_pileup_ctes(_TUMOR), stats, _CALLS, calls2, "\n, gk AS (SELECT * FROM cfin WHERE NOT contains(ref_allele, 'N'))", _trim("gk"))
    final_var = _FINAL.replace("SELECT region_id, sample, gene,", "SELECT region_id, CAST(pos AS BIGINT) AS pos, sample, gene,")
    return body + f"""
, vrows AS ({final_var})
, rrows AS (
  SELECT r.region_id, CAST(r.pos AS BIGINT) AS pos, 'tumor' AS sample, g.gene, r.chr, CAST(r.pos AS BIGINT) AS start, CAST(r.pos AS BIGINT) AS "end",
    r.ref_base AS ref_allele, r.ref_base AS alt_allele, r.tcov, CAST(0 AS BIGINT) AS cov, r.fwd AS rfc, r.rev AS rrc,
    CAST(0 AS BIGINT) AS fwd, CAST(0 AS BIGINT) AS rev, r.ref_base || '/' || r.ref_base AS genotype, 0.0 AS freq,
    CAST(r.bias_flag AS VARCHAR) || ';0' AS bias, r.pmean, CAST(r.pstd2 AS INTEGER) AS pstd, r.qual, CAST(r.qstd2 AS INTEGER) AS qstd,
    {_r('r.mapq_raw', 1)} AS mapq, {_r('r.qratio_raw', 3)} AS qratio, {_r('r.hifreq_raw', 4)} AS hifreq, 0.0 AS extrafreq,
    0 AS shift3, 0.0 AS msi, 0 AS msint, {_r('r.nm_raw', 1)} AS nm, r.hicnt, r.hicov, '0' AS leftseq, '0' AS rightseq,
    r.chr || ':' || CAST(r.region_start AS VARCHAR) || '-' || CAST(r.region_end AS VARCHAR) AS region, '' AS vartype
  FROM rk0 r JOIN regions g ON g.region_id = r.region_id WHERE r.is_ref AND r.maxfreq IS NULL)
, erows AS (
  SELECT x.region_id, CAST(x.pos AS BIGINT) AS pos, 'tumor' AS sample, x.gene, x.chr, CAST(x.pos AS BIGINT) AS start, CAST(x.pos AS BIGINT) AS "end",
    '' AS ref_allele, '' AS alt_allele, CAST(0 AS BIGINT) AS tcov, CAST(0 AS BIGINT) AS cov, CAST(0 AS BIGINT) AS rfc, CAST(0 AS BIGINT) AS rrc,
    CAST(0 AS BIGINT) AS fwd, CAST(0 AS BIGINT) AS rev, '' AS genotype, 0.0 AS freq, '0;0' AS bias, 0.0 AS pmean, 0 AS pstd, 0.0 AS qual,
    0 AS qstd, 0.0 AS mapq, 0.0 AS qratio, 0.0 AS hifreq, 0.0 AS extrafreq, 0 AS shift3, 0.0 AS msi, 0 AS msint, 0.0 AS nm,
    CAST(0 AS BIGINT) AS hicnt, CAST(0 AS BIGINT) AS hicov, '0' AS leftseq, '0' AS rightseq,
    x.chr || ':' || CAST(x.region_start AS VARCHAR) || '-' || CAST(x.region_end AS VARCHAR) AS region, '' AS vartype
  FROM (SELECT region_id, chr, region_start, region_end, gene, unnest(generate_series(region_start, region_end)) AS pos FROM regions) x
  WHERE NOT EXISTS (SELECT 1 FROM st s WHERE s.region_id = x.region_id AND s.pos = x.pos))
SELECT * FROM vrows UNION ALL SELECT * FROM rrows UNION ALL SELECT * FROM erows"""


_CHAIN_NAMES = ("rr rops mb mbr mmr runs mnp mrole s5 s5n s3 s3n ins ev al st0 st1 st rk0 rk1 rk cv cf cf2 cm cb "
                "ca cx cy cg ce cfin spl gv gd tr0 tr1 tr2 tr").split()


def _sample_chain(sample: str, sfx: str) -> str:
    """The candidate chain for one sample with every CTE name suffixed (paired mode keeps quiet positions)."""
    import re

    stats = _STATS.replace("WHERE NOT only_ref AND coalesce(maxfreq, 0.0) > 0.05 AND NOT is_ref", "WHERE NOT is_ref")
    good = _GOOD.replace("FROM spl)", "FROM spl_u)")
    text = "".join((_rr(f"r.sample = '{sample}'"), _PILEUP, stats, _CALLS, _CALLS2, _splices("rops")))
    tail = good + _trim("gd")
    pat = re.compile(r"\b(" + "|".join(_CHAIN_NAMES) + r")\b")
    return pat.sub(lambda m: m.group(1) + sfx, text), pat.sub(lambda m: m.group(1) + sfx, tail)


def _paired_sql() -> str:
    t_body, t_tail = _sample_chain("tumor", "_t")
    n_body, n_tail = _sample_chain("normal", "_n")
    out_cols = lambda src, status: (
        f"region_id, pos, {src}_allele AS allele, {status} AS status, {src}_vartype AS vartype, CAST({src}_sp AS BIGINT) AS start, "
        f"CAST({src}_ep AS BIGINT) AS \"end\", {src}_ref_allele AS ref_allele, {src}_alt_allele AS alt_allele, "
        "CAST(coalesce(t_cnt, 0) AS BIGINT) AS tumor_cov, CAST(coalesce(t_tcov, 0) AS BIGINT) AS tumor_tcov, "
        f"{_r('coalesce(t_freq_raw, 0.0)', 4)} AS tumor_freq, CAST(coalesce(n_cnt, 0) AS BIGINT) AS normal_cov, "
        f"CAST(coalesce(n_tcov, 0) AS BIGINT) AS normal_tcov, {_r('coalesce(n_freq_raw, 0.0)', 4)} AS normal_freq")
    cols = ["allele", "rank", "vartype", "sp", "ep", "ref_allele", "alt_allele", "cnt", "tcov", "freq_raw"]
    tsel = ", ".join(f"{c} AS t_{c}" for c in cols)
    nsel = ", ".join(f"{c} AS n_{c}" for c in cols)
    return _with(_READS, _OPS, t_body, n_body, "\n, spl_u AS (SELECT * FROM spl_t UNION ALL SELECT * FROM spl_n)", t_tail, n_tail) + f"""
, t AS (SELECT region_id, pos, {tsel}, reason IS NULL AS t_good,
          min(CASE WHEN reason IS NOT NULL THEN rank END) OVER (PARTITION BY region_id, pos) AS t_first_bad FROM tr_t)
, n AS (SELECT region_id, pos, {nsel}, reason IS NULL AS n_good,
          (((qual < 4.5 OR (qual < 12 AND NOT qstd2)) AND cnt <= 3) OR (qual < 25 AND freq_raw < 0.1 AND cnt <= 1)) AS n_noise FROM tr_n)
, p1 AS (SELECT DISTINCT region_id, pos FROM st_t)
, p2 AS (SELECT DISTINCT region_id, pos FROM st_n)
, cov AS (
  SELECT coalesce(p1.region_id, p2.region_id) AS region_id, coalesce(p1.pos, p2.pos) AS pos,
         p1.pos IS NOT NULL AS c1, p2.pos IS NOT NULL AS c2
  FROM p1 FULL OUTER JOIN p2 ON p1.region_id = p2.region_id AND p1.pos = p2.pos)
, nv AS (SELECT region_id, pos, count(*) AS nv1, max(CASE WHEN t_rank = 1 THEN t_good END) AS g1 FROM t GROUP BY region_id, pos)
, cv2 AS (SELECT cov.*, coalesce(nv.nv1, 0) AS nv1, nv.g1 FROM cov LEFT JOIN nv USING (region_id, pos))
, ntop AS (SELECT * FROM n WHERE n_rank = 1 AND n_good)
, ttop AS (SELECT * FROM t WHERE t_rank = 1 AND t_good)
, ra AS (SELECT {out_cols('n', "'Deletion'")} FROM (SELECT cv2.region_id, cv2.pos, ntop.* EXCLUDE (region_id, pos),
           NULL::BIGINT AS t_cnt, NULL::BIGINT AS t_tcov, NULL::DOUBLE AS t_freq_raw FROM cv2 JOIN ntop USING (region_id, pos) WHERE NOT c1) x)
, rb AS (SELECT {out_cols('t', "'SampleSpecific'")} FROM (SELECT cv2.region_id, cv2.pos, ttop.* EXCLUDE (region_id, pos),
           NULL::BIGINT AS n_cnt, NULL::BIGINT AS n_tcov, NULL::DOUBLE AS n_freq_raw FROM cv2 JOIN ttop USING (region_id, pos) WHERE NOT c2) x)
, g1r AS (SELECT t.* FROM cv2 JOIN t USING (region_id, pos) WHERE c1 AND c2 AND (t_first_bad IS NULL OR t_rank < t_first_bad))
, m AS (SELECT g1r.*, n.* EXCLUDE (region_id, pos) FROM g1r LEFT JOIN n ON n.region_id = g1r.region_id AND n.pos = g1r.pos AND n.n_allele = g1r.t_allele)
, rc1 AS (SELECT {out_cols('t', """CASE WHEN n_allele IS NULL THEN 'StrongSomatic'
      WHEN n_noise AND t_vartype = 'SNV' THEN 'StrongSomatic'
      WHEN n_good AND t_freq_raw > 0.95 AND n_freq_raw < 0.8 AND n_freq_raw > 0.2 THEN 'LikelyLOH'
      WHEN n_good THEN 'Germline'
      WHEN n_freq_raw < 0.05 OR n_cnt <= 1 THEN 'LikelySomatic' ELSE 'AFDiff' END""")} FROM m)
, lead AS (SELECT cv2.region_id, cv2.pos, cv2.nv1, ntop.* EXCLUDE (region_id, pos) FROM cv2 JOIN ntop USING (region_id, pos)
           WHERE c1 AND c2 AND (nv1 = 0 OR NOT coalesce(g1, true)))
, lb AS (SELECT lead.*, t.* EXCLUDE (region_id, pos) FROM lead LEFT JOIN t ON t.region_id = lead.region_id AND t.pos = lead.pos AND t.t_allele = lead.n_allele)
, rc2 AS (SELECT {out_cols('t', "CASE WHEN t_freq_raw < 0.05 THEN 'LikelyLOH' ELSE 'Germline' END")} FROM lb WHERE t_allele IS NOT NULL AND nv1 > 0)
, rc3 AS (SELECT {out_cols('n', "'StrongLOH'")} FROM lb WHERE NOT (t_allele IS NOT NULL AND nv1 > 0))
SELECT * FROM ra UNION ALL SELECT * FROM rb UNION ALL SELECT * FROM rc1 UNION ALL SELECT * FROM rc2 UNION ALL SELECT * FROM rc3"""


def oracle_sql() -> dict[str, str]:
    cand = _cand_ctes()
    q: dict[str, str] = {}
    q["region_parse"] = PRELUDE + r"""
, t AS (SELECT chr || ':' || format('{:,}', region_start) || '-' || CAST(region_end AS VARCHAR) || ':' || gene AS text FROM regions)
, p AS (SELECT text, string_split(text, ':') AS parts FROM t)
, q AS (SELECT text, parts[1] AS chr,
          CAST(replace(string_split(parts[2], '-')[1], ',', '') AS BIGINT) - 5 AS s,
          CAST(replace(CASE WHEN len(string_split(parts[2], '-')) < 2 THEN string_split(parts[2], '-')[1] ELSE string_split(parts[2], '-')[2] END, ',', '') AS BIGINT) + 5 AS e,
          CASE WHEN len(parts) < 3 THEN parts[1] ELSE parts[3] END AS gene FROM p)
SELECT text, chr, least(s, e) AS region_start, e AS region_end, gene FROM q"""
    q["segment_explode"] = PRELUDE + r"""
, x AS (SELECT segment_id, chr, cds_start, cds_end, gene, CAST(unnest(range(0, len(string_split(seg_starts, ',')))) AS INTEGER) AS seg_idx,
               string_split(seg_starts, ',') AS ss, string_split(seg_ends, ',') AS ee FROM segments)
, y AS (SELECT *, CAST(ss[seg_idx + 1] AS BIGINT) AS s, CAST(ee[seg_idx + 1] AS BIGINT) AS e FROM x WHERE seg_idx < len(ss))
SELECT segment_id, seg_idx, chr, greatest(s, cds_start) AS region_start, least(e, cds_end) AS region_end, gene
FROM y WHERE e >= cds_start AND s <= cds_end"""
    q["amplicon_groups"] = PRELUDE + r"""
, a AS (SELECT amplicon_id, chr, istart, iend,
          CASE WHEN lag(iend) OVER w IS NULL OR istart > lag(iend) OVER w THEN 1 ELSE 0 END AS nw
        FROM amplicons WINDOW w AS (PARTITION BY chr ORDER BY istart, amplicon_id))
SELECT amplicon_id, chr, istart, iend,
  chr || ':' || CAST(sum(nw) OVER (PARTITION BY chr ORDER BY istart, amplicon_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS VARCHAR) AS amp_group
FROM a"""
    q["chr_normalize"] = PRELUDE + r"""
SELECT segment_id, CASE WHEN chr IN (SELECT chr FROM contigs) THEN chr WHEN starts_with(chr, 'chr') THEN substr(chr, 4) ELSE 'chr' || chr END AS chr
FROM segments"""
    q["strip_chr"] = PRELUDE + "\nSELECT region_id, regexp_replace(chr, '^chr', '') AS chr FROM regions"
    q["region_flank"] = PRELUDE + r"""
SELECT region_id, greatest(1, region_start - 700) AS flank_start,
  least(region_end + 700, coalesce((SELECT length FROM contigs c WHERE c.chr = g.chr), region_end + 700)) AS flank_end
FROM regions g"""
    q["region_read_overlap"] = _with(_READS) + r"""
SELECT g.region_id, r.read_name, r.sample, r.start_pos, r.end_pos, r.cigar
FROM rl r JOIN regions g ON r.chr = g.chr AND r.start_pos < g.region_end AND r.end_pos > g.region_start"""
    q["region_ref_window"] = PRELUDE + r"""
, refpos AS (
  SELECT chr, block_start + i AS pos, substr(seq, CAST(i AS INTEGER) + 1, 1) AS base
  FROM (SELECT chr, block_start, seq, unnest(range(0, length(seq))) AS i FROM ref_blocks) x)
SELECT g.region_id, g.chr, CAST(r.pos AS BIGINT) AS pos, r.base
FROM regions g JOIN refpos r ON r.chr = g.chr AND r.pos BETWEEN g.region_start - 700 AND g.region_end + 700"""
    q["region_nonempty"] = _with(_READS) + r"""
SELECT g.region_id, g.chr, g.region_start, g.region_end,
  CASE WHEN coalesce(g.gene, '') = '' THEN (SELECT min(read_name) FROM rl r WHERE r.chr = g.chr AND r.start_pos < g.region_end AND r.end_pos > g.region_start) ELSE g.gene END AS gene
FROM regions g
WHERE EXISTS (SELECT 1 FROM ref_blocks b WHERE b.chr = g.chr AND b.block_start + length(b.seq) - 1 >= greatest(g.region_start - 700, 1) AND b.block_start <= g.region_end + 700)
  AND EXISTS (SELECT 1 FROM rl r WHERE r.chr = g.chr AND r.start_pos < g.region_end AND r.end_pos > g.region_start)"""
    q["read_filter_flags"] = PRELUDE + "\nSELECT read_name, sample, start_pos, flag, mapq FROM reads WHERE seq <> '*' AND mapq >= 20 AND (flag & 1280) = 0"
    q["read_filter_mismatch"] = _with(_READS) + "\nSELECT read_name, sample, start_pos, cigar, nm, tnm FROM rl WHERE nm IS NOT NULL AND tnm <= 1"
    q["read_dedup"] = PRELUDE + r"""
, m AS (SELECT *, mate_start % 12 AS ms FROM reads)
, k AS (SELECT *, CASE WHEN ms < 10 THEN CAST(start_pos AS VARCHAR) || '-' || (CASE WHEN mate_chr IS NULL THEN '*' WHEN mate_chr = chr THEN '=' ELSE mate_chr END) || '-' || CAST(ms AS VARCHAR)
                      WHEN (flag & 8) <> 0 THEN CAST(start_pos AS VARCHAR) || '-' || cigar END AS dk FROM m)
SELECT read_name, sample, start_pos, cigar, ms AS mate_start FROM (
  SELECT *, row_number() OVER (PARTITION BY sample, chr, dk ORDER BY read_name, flag, cigar, seq) AS rn FROM k WHERE dk IS NOT NULL) t WHERE rn = 1
UNION ALL
SELECT read_name, sample, start_pos, cigar, ms AS mate_start FROM k WHERE dk IS NULL"""
    q["read_downsample_hash"] = PRELUDE + r"""
SELECT read_name, sample, start_pos FROM reads
WHERE CAST(('0x' || substr(md5(read_name || '|' || sample || '|' || CAST(start_pos AS VARCHAR)), 1, 8)) AS BIGINT) % 1000000 >= 300000"""
    q["amplicon_read_filter"] = _with(_READS) + r"""
, j AS (
  SELECT a.amplicon_id AS region_id, a.amp_start AS rs, a.amp_end AS re, r.*,
         r.start_pos AS s0, r.start_pos + CAST(coalesce(list_sum(list_transform(regexp_extract_all(r.cigar, '(\d+)[MD]', 1), lambda x: CAST(x AS INTEGER))), 0) AS INTEGER) - 1 AS e0
  FROM rl r JOIN amplicons a ON r.chr = a.chr AND r.start_pos < a.amp_end AND r.end_pos > a.amp_start)
, k AS (
  SELECT *, CASE WHEN mate_chr = chr AND insert_size < 0 THEN mate_start ELSE s0 END AS ps,
            CASE WHEN mate_chr = chr AND insert_size > 0 THEN s0 + insert_size - 1
                 WHEN mate_chr = chr AND insert_size < 0 THEN mate_start - insert_size - 1 ELSE e0 END AS pe
  FROM j)
SELECT region_id, read_name, sample, start_pos FROM k
WHERE CASE WHEN regexp_matches(cigar, '^\d+S') OR regexp_matches(cigar, '\d+S$')
           THEN coalesce(abs(greatest(s0, rs) - least(e0, re)) / (e0 - s0) > 0.95, false)
           ELSE coalesce(NOT (abs(ps - rs) > 10 OR abs(pe - re) > 10 OR abs((greatest(ps, rs) - least(pe, re)) / (pe - ps)) <= 0.95), false) END"""
    edge = _READS.replace("FROM reads)", "FROM edge_reads)")
    # trimming: forward reads keep read positions up to 25, reverse ones the last 25
    kept = "CASE WHEN (flag & 16) = 0 THEN n <= 25 ELSE rlen2 - n <= 25 END"
    trimmed = _PILEUP.replace("base <> 'N' AND pos", f"base <> 'N' AND {kept} AND pos")
    edge_pileup = (edge, _OPS, _rr("true"), trimmed)
    q["edge_pileup"] = _with(*edge_pileup) + f"\nSELECT {_ACC.replace('pstd, qstd', 'coalesce(pstd, false) AS pstd, coalesce(qstd, false) AS qstd')}, is_ins FROM al WHERE allele <> ''"
    q["edge_coverage"] = _with(*edge_pileup) + f"\nSELECT region_id, pos, CAST(sum(cov_add) AS BIGINT) AS cov FROM al WHERE pos {_IN_REGION} GROUP BY region_id, pos HAVING sum(cov_add) > 0"
    clips = _with(edge, _OPS, _rr("true"), _PILEUP, _CLIPS, _CONSENSUS)
    q["edge_clip_consensus"] = clips + "\nSELECT region_id, side, pos, consensus, total, \"match\" FROM cons"
    q["edge_clip_pairs"] = clips + r"""
, longest AS (SELECT region_id, max(rlen2) AS rlen FROM rr GROUP BY region_id)
SELECT a.region_id, a.pos AS p5, b.pos AS p3, a.consensus AS seq5, b.consensus AS seq3
FROM (SELECT * FROM cons WHERE side = 5 AND consensus <> '') a JOIN (SELECT * FROM cons WHERE side = 3 AND consensus <> '') b USING (region_id)
JOIN longest USING (region_id) WHERE b.pos BETWEEN a.pos - rlen / 1.5 AND a.pos + rlen - 10"""
    q["region_genes"] = _with(_READS, _rr("true").split(", rops AS")[0]) + r"""
SELECT g.region_id, CASE WHEN g.region_id % 7 <> 0 THEN g.gene ELSE coalesce((SELECT min(read_name) FROM rr WHERE rr.region_id = g.region_id), '') END AS gene FROM regions g"""
    q["edge_read_filters"] = _with(edge).split(", fr AS")[0] + r"""
, ok AS (SELECT *, CASE WHEN mate_start < 10 THEN concat_ws('-', start_pos, CASE WHEN mate_chr IS NULL THEN '*' WHEN mate_chr = chr THEN '=' ELSE mate_chr END, mate_start)
                        WHEN (flag & 8) <> 0 THEN concat_ws('-', start_pos, cigar) END AS dup
         FROM rl WHERE seq <> '*' AND mapq >= 20 AND (flag & 1280) = 0)
, one AS (SELECT *, row_number() OVER (PARTITION BY sample, chr, dup ORDER BY read_name, flag, cigar, seq) AS nr FROM ok)
SELECT read_name, sample, seq, start_pos, cigar, flag, tnm, rlen1 FROM one
WHERE (dup IS NULL OR nr = 1) AND nm IS NOT NULL AND tnm <= 8 AND rlen1 >= 31
  AND NOT (((flag & 8) = 0 AND coalesce(mate_chr = chr, false)) AND sa_tag IS NOT NULL AND (flag & 2048) <> 0)"""
    q["complex_indels"] = _with(edge, _OPS, _rr("true")).replace("WITH li AS", "WITH RECURSIVE li AS", 1) + oracle_complex.ctes(GOODQ, _IN_REGION, _tp)
    q["cigar_normalize"] = oracle_normalize.sql()
    q["cigar_lengths"] = _with(_READS) + "\nSELECT read_name, sample, start_pos, cigar, span AS ref_span, end_pos, rlen1, rlen2, idl AS indel_len FROM rl"
    q["read_length_max"] = _with(_READS, _OPS, _rr("true")) + "\nSELECT region_id, max(rlen2) AS max_rlen FROM rr GROUP BY region_id"
    recursive = ("WITH li AS", "WITH RECURSIVE li AS", 1)
    ends = _READS.replace("FROM reads)", "FROM mnp_reads)")
    adjusted = (ends, _OPS, _rr("true"), _PILEUP, _CLIPS, _CONSENSUS, oracle_mnp.ctes(GOODQ))
    acc = _ACC.replace("pstd, qstd", "coalesce(pstd, false) AS pstd, coalesce(qstd, false) AS qstd")
    q["mnp_adjust"] = _with(*adjusted).replace(*recursive) + f"\nSELECT {acc}, is_ins, extracnt, cov_add FROM adj WHERE allele <> ''"
    gaps = (_READS.replace("FROM reads)", "FROM gap_reads)"), _OPS, _rr("true"), _PILEUP, _CLIPS, _CONSENSUS, oracle_overlap.ctes(GOODQ))
    q["clip_overlap"] = _with(*gaps).replace(*recursive) + oracle_overlap.FOUND
    q["clip_overlap_counts"] = _with(*gaps).replace(*recursive) + oracle_overlap.counts()
    stats = _STATS.replace("FROM al WHERE", "FROM adj al WHERE").replace(
        "cnt / tcov AS freq_raw", "cnt / (CASE WHEN cnt > tcov AND cnt - tcov < extracnt THEN cnt ELSE tcov END) AS freq_raw")
    final = _FINAL.replace("0.0 AS extrafreq", f"{_r('extracnt / (CASE WHEN cnt > tcov AND cnt - tcov < extracnt THEN cnt ELSE tcov END)', 4)} AS extrafreq")
    q["call_adjusted"] = _with(*adjusted, stats, _CALLS, _CALLS2, _splices("rops"), _GOOD).replace(*recursive) + r"""
, gk AS (SELECT * FROM gd WHERE reason IS NULL AND NOT contains(ref_allele, 'N'))""" + _trim("gk") + final
    A = oracle_amplicon
    panel = _READS.replace("FROM reads)", "FROM panel_reads)").replace("FROM regions g", f"FROM {A.PANEL} g")
    quiet = _STATS.replace("WHERE NOT only_ref AND coalesce(maxfreq, 0.0) > 0.05 AND NOT is_ref", "WHERE NOT is_ref")
    rows = _FINAL.replace("SELECT region_id, sample,", "SELECT amp_group, CAST(pos AS BIGINT) AS pos, good_amplicons, judged_amplicons, no_coverage, disagree, sample,")
    rows = rows.replace("'tumor' AS sample", "'panel' AS sample").replace("JOIN regions g ON g.region_id = tr.region_id", f"JOIN {A.GENES} g ON g.amp_group = tr.amp_group")
    rows = rows.replace("chr || ':' || CAST(region_start AS VARCHAR) || '-' || CAST(region_end AS VARCHAR) AS region", "good_span AS region")
    q["call_amplicon"] = _with(panel, _OPS, _rr(A.MEMBER), _PILEUP, quiet, _CALLS, _CALLS2, _splices("rops"), _GOOD, A.SPOTS, _trim("gk")) + rows
    q["mnp_merge"] = _with(*_pileup_ctes()) + f"\nSELECT {_ACC} FROM al WHERE contains(allele, '&')"
    q["base_pileup"] = _with(*_pileup_ctes()) + f"\nSELECT {_ACC} FROM al WHERE allele <> '' AND NOT is_ins AND NOT starts_with(allele, '-')"
    q["insertion_pileup"] = _with(*_pileup_ctes()) + f"\nSELECT {_ACC} FROM al WHERE is_ins"
    q["deletion_pileup"] = _with(*_pileup_ctes()) + f"\nSELECT {_ACC} FROM al WHERE starts_with(allele, '-')"
    q["coverage"] = _with(*_pileup_ctes()) + f"\nSELECT region_id, pos, CAST(sum(cov_add) AS BIGINT) AS cov FROM al WHERE pos {_IN_REGION} GROUP BY region_id, pos"
    q["splice_counts"] = _with(_READS, _OPS, _rr("true"), _splices("rops")) + "\nSELECT region_id, junction, cnt FROM spl"
    q["allele_stats"] = _with(*_pileup_ctes(), _STATS) + f"""
SELECT region_id, pos, allele, is_ref, tcov, hicov, bias_flag AS bias, qual, pmean, {_r('freq_raw', 4)} AS freq,
  {_r('mapq_raw', 1)} AS mapq, {_r('qratio_raw', 3)} AS qratio, {_r('hifreq_raw', 4)} AS hifreq, {_r('nm_raw', 1)} AS nm FROM st"""
    q["strand_bias"] = _with(*_pileup_ctes()) + f"\nSELECT region_id, pos, allele, {_BIAS} AS bias FROM al WHERE allele <> ''"
    q["allele_rank"] = _with(*_pileup_ctes(), _STATS) + "\nSELECT region_id, pos, allele, CAST(rank AS INTEGER) AS rank FROM rk"
    q["genotype"] = _with(*cand) + "\nSELECT region_id, pos, allele, genotype FROM cfin"
    q["variant_type"] = _with(*cand) + "\nSELECT region_id, pos, allele, ref_allele, alt_allele, vartype FROM cfin"
    q["msi_score"] = _with(*cand) + f"\nSELECT region_id, pos, allele, {_r('msi', 3)} AS msi, CAST(shift3 AS INTEGER) AS shift3, CAST(msint AS INTEGER) AS msint FROM cfin"
    q["flank_seq"] = _with(*cand) + "\nSELECT region_id, pos, allele, CAST(sp AS BIGINT) AS sp, CAST(ep AS BIGINT) AS ep, leftseq, rightseq FROM cfin"
    q["complex_trim"] = _with(*cand, _trim("cfin")) + "\nSELECT region_id, pos, allele, CAST(sp AS BIGINT) AS sp, CAST(ep AS BIGINT) AS ep, ref_allele, alt_allele, leftseq, rightseq FROM tr"
    q["good_variants"] = _with(*cand, _splices("rops"), _GOOD) + "\nSELECT region_id, pos, allele, reason IS NULL AS good, coalesce(reason, '') AS reason FROM gd"
    q["low_complexity"] = _with(*cand) + r"""
SELECT region_id, pos, allele, CASE WHEN length(rightseq) = 0 THEN true ELSE greatest(
  length(rightseq) - length(replace(rightseq, 'A', '')), length(rightseq) - length(replace(rightseq, 'C', '')),
  length(rightseq) - length(replace(rightseq, 'G', '')), length(rightseq) - length(replace(rightseq, 'T', ''))) / length(rightseq) > 0.75 END AS low_complexity
FROM cfin"""
    q["noise_flag"] = _with(*cand) + r"""
SELECT region_id, pos, allele,
  (((qual < 4.5 OR (qual < 12 AND NOT qstd2)) AND cnt <= 3) OR (qual < 25 AND freq_raw < 0.1 AND cnt <= 1)) AS noise
FROM cfin"""
    q["splice_antijoin"] = _with(*cand, _splices("rops")) + r"""
SELECT region_id, pos, allele FROM cfin
WHERE NOT EXISTS (SELECT 1 FROM spl WHERE spl.region_id = cfin.region_id AND spl.junction = CAST(cfin.sp AS VARCHAR) || '-' || CAST(cfin.ep AS VARCHAR))"""
    q["call_single"] = _with(*_cand_ctes(_TUMOR), _splices("rops"), _GOOD) + r"""
, gk AS (SELECT * FROM gd WHERE reason IS NULL AND NOT contains(ref_allele, 'N'))""" + _trim("gk") + _FINAL
    q["scan_fasta"] = PRELUDE + r"""
SELECT e.chr, e.block, 32 * e.block + 1 AS block_start, coalesce(b.seq, repeat('N', 32)) AS seq
FROM (SELECT chr, CAST(unnest(range(0, CAST(length / 32 AS BIGINT))) AS BIGINT) AS block FROM contigs) e
LEFT JOIN ref_blocks b ON b.chr = e.chr AND b.block = e.block"""
    q["scan_regions"] = PRELUDE + "\nSELECT chr, region_start, region_end, gene FROM regions"
    q["scan_bed"] = PRELUDE + "\nSELECT chr, region_start, region_end, gene, false AS amplicon_mode FROM regions"
    q["scan_bed_amplicon"] = PRELUDE + r"""
SELECT chr, CASE WHEN amp_start < amp_end THEN amp_start + 1 ELSE amp_start END AS region_start, amp_end AS region_end, gene,
  CASE WHEN amp_start < amp_end THEN istart + 1 ELSE istart END AS istart, iend, true AS amplicon_mode FROM amplicons"""
    q["scan_sam"] = PRELUDE + r"""
SELECT read_name, flag, chr, start_pos, mapq, cigar, chr AS mate_chr, mate_start, insert_size, seq, qual, nm FROM reads"""
    q["scan_alignments"] = PRELUDE + "\nSELECT read_name, sample, flag, chr, start_pos, cigar, seq, nm FROM reads"
    q["region_lines"] = PRELUDE + r"""
, sl AS (SELECT concat_ws(chr(9), '1', 'n', s.chr, 'x', 'x', 'x', cds_start, cds_end, 'x', seg_starts, seg_ends, 'x', gene) AS line, s.*,
           unnest(string_split(seg_starts, ',')) AS a, unnest(string_split(seg_ends, ',')) AS b FROM segments s)
SELECT concat_ws(chr(9), chr, region_start, region_end, gene) AS line, chr,
  CASE WHEN region_start < region_end THEN region_start + 1 ELSE region_start END AS region_start, region_end, gene FROM regions
UNION ALL
SELECT line, chr, greatest(CAST(a AS BIGINT), cds_start), least(CAST(b AS BIGINT), cds_end), gene FROM sl
WHERE CAST(b AS BIGINT) >= cds_start AND CAST(a AS BIGINT) <= cds_end"""
    q["allele_debug"] = _with(*_pileup_ctes(), _STATS) + f"""
SELECT region_id, pos, string_agg(CASE WHEN is_ins THEN 'I' ELSE '' END || allele || ':' || CAST(fwd + rev AS VARCHAR) || ':F-' || CAST(fwd AS VARCHAR) || ':R-' || CAST(rev AS VARCHAR)
    || ':' || printf('%.3f', {_r('freq_raw', 3)}) || ':' || CAST(bias_flag AS VARCHAR) || ':' || CAST(pmean AS VARCHAR) || ':' || CAST(pstd2 AS VARCHAR)
    || ':' || CAST(qual AS VARCHAR) || ':' || CAST(qstd2 AS VARCHAR) || ':' || printf('%.3f', {_r('hifreq_raw', 3)}) || ':' || CAST({_r('mapq_raw', 1)} AS VARCHAR)
    || ':' || CAST({_r('qratio_raw', 3)} AS VARCHAR), ' & ' ORDER BY is_ins, allele) AS debug
FROM st GROUP BY region_id, pos"""
    q["contig_lengths"] = PRELUDE + "\nSELECT chr, length FROM contigs"
    q["sample_name"] = PRELUDE + r"""
, p AS (SELECT DISTINCT CASE WHEN sample = 'tumor' THEN '/data/run1/' || chr || '_' || sample || '.sorted.dedup.bam'
                             ELSE '/data/run1/' || sample || '_' || chr || '.bam' END AS path FROM reads)
SELECT path, CASE WHEN regexp_extract(path, '([^/._]+).sorted[^/]*.bam', 1) <> '' THEN regexp_extract(path, '([^/._]+).sorted[^/]*.bam', 1)
                  WHEN regexp_extract(path, '([^/]+)[_.][^/]*bam', 1) <> '' THEN regexp_extract(path, '([^/]+)[_.][^/]*bam', 1) END AS sample_name
FROM p"""
    q["write_calls_roundtrip"] = q["call_single"]
    q["call_pileup"] = _pileup_mode_sql()
    q["call_paired"] = _paired_sql()
    q["position_amplicons"] = _with(*cand) + r"""
SELECT p.chr, p.pos, a.amplicon_id FROM (SELECT DISTINCT chr, pos FROM cfin) p
JOIN amplicons a ON a.chr = p.chr AND p.pos BETWEEN a.istart AND a.iend"""
    q["clip_pair_join"] = _with(*_pileup_ctes(), _CLIPS, _CONSENSUS) + r"""
, rl2 AS (SELECT region_id, max(rlen2) AS rlen FROM rr GROUP BY region_id)
SELECT a.region_id, a.pos AS p5, b.pos AS p3, a.consensus AS seq5, b.consensus AS seq3
FROM cons a JOIN cons b ON a.region_id = b.region_id AND a.side = 5 AND b.side = 3
JOIN rl2 ON rl2.region_id = a.region_id
WHERE a.consensus <> '' AND b.consensus <> '' AND a.pos - b.pos <= rl2.rlen / 1.5 AND b.pos - a.pos <= rl2.rlen - 10"""
    q["spanning_reads"] = _with(*cand) + r"""
, iv AS (SELECT CAST(region_id AS VARCHAR) || ':' || CAST(pos AS VARCHAR) || ':' || allele AS interval_id, chr, sp AS s, ep AS e
         FROM cfin WHERE regexp_full_match(allele, '-\d+'))
, tr AS (SELECT *, start_pos + CAST(coalesce(list_sum(list_transform(regexp_extract_all(cigar, '(\d+)[MD]', 1), lambda x: CAST(x AS INTEGER))), 0) AS INTEGER) AS re
         FROM rl)
, j AS (SELECT iv.interval_id, iv.s, iv.e, tr.start_pos AS rs, tr.re FROM iv JOIN tr
        ON tr.chr = iv.chr AND tr.start_pos <= iv.e AND tr.end_pos >= iv.s AND NOT contains(tr.cigar, CAST(iv.e - iv.s AS VARCHAR) || 'D'))
SELECT iv.interval_id, CAST(coalesce(sum(CASE WHEN re > e + 2 AND rs < s - 2 THEN 1 ELSE 0 END), 0) AS BIGINT) AS cnt,
  CAST(coalesce(sum(CASE WHEN rs < s - 2 AND re > s AND re < e THEN 1 ELSE 0 END), 0) AS BIGINT) AS midcnt,
  coalesce(sum(CASE WHEN re > e + 2 AND rs < s - 2 THEN 1 ELSE 0 END), 0) <= 0 AS no_passing
FROM iv LEFT JOIN (SELECT j.*, j.e AS e2 FROM j) jj ON jj.interval_id = iv.interval_id
GROUP BY iv.interval_id""".replace("re > e + 2 AND rs < s - 2", "jj.re > jj.e + 2 AND jj.rs < jj.s - 2").replace(
        "rs < s - 2 AND re > s AND re < e", "jj.rs < jj.s - 2 AND jj.re > jj.s AND jj.re < jj.e")
    q["breakpoint_search"] = _with(*_pileup_ctes(), _CLIPS, _CONSENSUS) + r"""
, bs0 AS (
  SELECT c.region_id, c.side, c.pos, c.consensus, g.chr, coalesce(ct.length, 0) AS clen,
         CASE WHEN c.side = 5 THEN -1 ELSE 1 END AS dir, c.pos + (CASE WHEN c.side = 5 THEN -1 ELSE 1 END) * 5 AS sp
  FROM cons c JOIN regions g ON g.region_id = c.region_id LEFT JOIN contigs ct ON ct.chr = g.chr
  WHERE length(c.consensus) >= 7 AND NOT regexp_matches(c.consensus, '^.(AAAAAAA|TTTTTTT)')
    AND NOT greatest(length(c.consensus) - length(replace(c.consensus, 'A', '')), length(c.consensus) - length(replace(c.consensus, 'C', '')),
                     length(c.consensus) - length(replace(c.consensus, 'G', '')), length(c.consensus) - length(replace(c.consensus, 'T', ''))) / length(c.consensus) > 0.75)
, bs1 AS (SELECT *, CAST(unnest(range(0, 120)) AS INTEGER) AS n FROM bs0)
, bs2 AS (SELECT *, sp + dir * n + dir * k AS rp FROM (SELECT *, CAST(unnest(range(0, length(consensus))) AS INTEGER) AS k FROM bs1) x)
, bs3 AS (SELECT bs2.*, substr(consensus, k + 1, 1) AS ch, coalesce(substr(consensus, k + 1, 1) = r.base, false) AS hit, (rp < 1 OR rp > clen) AS oob
          FROM bs2 LEFT JOIN refpos r ON r.chr = bs2.chr AND r.pos = bs2.rp)
, bs4 AS (SELECT *, sum(CASE WHEN hit THEN 0 ELSE 1 END) OVER (PARTITION BY region_id, side, pos, n ORDER BY k ROWS UNBOUNDED PRECEDING) AS cmm FROM bs3)
, bs5 AS (SELECT region_id, side, pos, n, min(CASE WHEN oob OR (NOT hit AND cmm > 3 - n // 100) THEN k END) AS brk FROM bs4 GROUP BY region_id, side, pos, n)
, bs6 AS (
  SELECT x.region_id, x.side, x.pos, x.n, any_value(x.consensus) AS consensus, any_value(x.sp) AS sp, any_value(x.dir) AS dir,
         coalesce(any_value(b.brk), length(any_value(x.consensus))) AS i,
         sum(CASE WHEN x.k < coalesce(b.brk, 1000000) AND NOT x.hit THEN 1 ELSE 0 END)
           + max(CASE WHEN x.k = b.brk AND NOT x.oob THEN 1 ELSE 0 END) AS mm,
         count(DISTINCT CASE WHEN x.hit AND x.k < coalesce(b.brk, 1000000) THEN x.ch END) AS md
  FROM bs4 x JOIN bs5 b ON b.region_id = x.region_id AND b.side = x.side AND b.pos = x.pos AND b.n = x.n
  GROUP BY x.region_id, x.side, x.pos, x.n)
, bs7 AS (
  SELECT *, (mm = 0 AND i = length(consensus)) AS exact, i - mm AS score,
         sp + dir * n + CASE WHEN dir < 0 THEN 1 ELSE 0 END AS bp
  FROM bs6 WHERE md >= 3 AND mm <= 3 - n // 100 AND i >= length(consensus) - 2 AND i >= 8 + n // 10 AND mm / i < 0.12)
, bs8 AS (SELECT *, row_number() OVER (PARTITION BY region_id, side, pos ORDER BY exact DESC, CASE WHEN exact THEN n ELSE -score END, n) AS r FROM bs7)
SELECT region_id, side, pos, consensus, CAST(bp AS BIGINT) AS bp,
       CAST(CASE WHEN side = 5 THEN pos - bp ELSE bp - pos END AS BIGINT) AS dellen, n AS "offset", CAST(score AS INTEGER) AS score
FROM bs8 WHERE r = 1"""
    q["softclip_collect"] = _with(*_pileup_ctes(), _CLIPS) + "\nSELECT * FROM ctab"
    q["softclip_consensus"] = _with(*_pileup_ctes(), _CLIPS, _CONSENSUS) + "\nSELECT region_id, side, pos, consensus, total, \"match\" FROM cons"
    return q
