"""DuckDB oracle of complex indels (E7, E8): self-joins of the op rows and per-base rows.

Written from SURVEY §2.5 and §2.14 in another form than the Spark folds: which ops an event
takes comes from a recursive walk over op numbers, the mismatch scan from running counts
over one row per base.
"""

from __future__ import annotations

VEXT = 3


def ctes(goodq: int, in_region: str, tp) -> str:
    """CTEs after ``rops``, ``op1``, ``tok`` and ``refpos``; the last one, ``cev``, has the event rows."""
    return rf"""
, raw AS (SELECT rid, CAST(idx AS INTEGER) AS idx, CASE WHEN right(t, 1) IN ('=', 'X') THEN 'M' ELSE right(t, 1) END AS raw FROM tok)
, chain AS (
  SELECT a.rid, a.idx, a.op, a.len, a.nops, r1.raw AS x1, b.len AS m1, r2.raw AS x2, c.len AS m2, r3.raw AS x3, d.len AS m3,
    CASE WHEN r1.raw = 'M' AND b.len <= {VEXT} AND r2.raw IN ('I', 'D') THEN 2 WHEN a.op = 'D' AND r1.raw = 'I' THEN 1 ELSE 0 END AS kind
  FROM op1 a LEFT JOIN op1 b ON b.rid = a.rid AND b.idx = a.idx + 1 LEFT JOIN raw r1 ON r1.rid = a.rid AND r1.idx = a.idx + 1
  LEFT JOIN op1 c ON c.rid = a.rid AND c.idx = a.idx + 2 LEFT JOIN raw r2 ON r2.rid = a.rid AND r2.idx = a.idx + 2
  LEFT JOIN op1 d ON d.rid = a.rid AND d.idx = a.idx + 3 LEFT JOIN raw r3 ON r3.rid = a.rid AND r3.idx = a.idx + 3)
, walk AS (
  SELECT rid, 0 AS idx, 0 AS nxt, false AS opens, nops FROM chain WHERE idx = 0
  UNION ALL
  SELECT w.rid, w.idx + 1, CASE WHEN w.idx >= w.nxt AND c.op IN ('I', 'D') THEN w.idx + 1 + c.kind ELSE w.nxt END,
         w.idx >= w.nxt AND c.op IN ('I', 'D'), w.nops
  FROM walk w JOIN chain c ON c.rid = w.rid AND c.idx = w.idx WHERE w.idx < w.nops)
, lead AS (
  SELECT o.*, c.kind, c.m1, c.m2, c.x2, row_number() OVER () AS eid,
    CASE c.kind WHEN 2 THEN CASE WHEN c.x3 = 'M' THEN c.m3 END WHEN 1 THEN CASE WHEN c.x2 = 'M' THEN c.m2 END
                ELSE CASE WHEN c.x1 = 'M' THEN c.m1 END END AS more,
    o.qofs + CASE WHEN o.op = 'I' THEN o.len ELSE 0 END AS mid,
    o.qofs + CASE WHEN o.op = 'I' THEN o.len ELSE 0 END
      + CASE WHEN c.kind = 2 THEN c.m1 + CASE WHEN c.x2 = 'I' THEN c.m2 ELSE 0 END WHEN c.kind = 1 THEN c.m1 ELSE 0 END AS tq,
    o.seg_start + CASE WHEN o.op = 'D' THEN o.len ELSE 0 END
      + CASE WHEN c.kind = 2 THEN c.m1 + CASE WHEN c.x2 = 'D' THEN c.m2 ELSE 0 END ELSE 0 END AS tr
  FROM rops o JOIN walk w ON w.rid = o.rid AND w.idx = o.idx + 1 AND w.opens JOIN chain c ON c.rid = o.rid AND c.idx = o.idx)
, bases AS (
  SELECT l.eid, l.op, t, substr(l.seq, CAST(l.tq + t AS INTEGER) + 1, 1) AS b, rp.base AS r,
         ascii(substr(l.qual, CAST(l.tq + t AS INTEGER) + 1, 1)) - 33 AS bq
  FROM (SELECT *, unnest(range(0, coalesce(more, 0))) AS t FROM lead) l LEFT JOIN refpos rp ON rp.chr = l.chr AND rp.pos = l.tr + t)
, cut AS (SELECT *, min(CASE WHEN b = 'N' OR bq < {goodq} OR (op = 'D' AND r = 'N') THEN t END) OVER (PARTITION BY eid) AS stop FROM bases)
, seen AS (
  SELECT *, r IS NOT NULL AND b <> r AS mis, sum(CASE WHEN r IS NOT NULL AND b = r THEN 1 ELSE 0 END) OVER (PARTITION BY eid ORDER BY t) AS same
  FROM cut WHERE stop IS NULL OR t < stop)
, gaps AS (SELECT eid, t, same - coalesce(lag(same) OVER (PARTITION BY eid ORDER BY t), 0) AS gap FROM seen WHERE mis)
, reach AS (SELECT *, max(CASE WHEN gap > {VEXT} THEN 1 ELSE 0 END) OVER (PARTITION BY eid ORDER BY t) AS broken FROM gaps)
, ext AS (SELECT eid, CAST(max(t) + 1 AS INTEGER) AS off, count(*) AS nm FROM reach WHERE broken = 0 GROUP BY eid)
, named AS (
  SELECT l.*, coalesce(e.off, 0) AS off, coalesce(e.nm, 0) AS ext_nm,
    CASE op WHEN 'I' THEN '+' || substr(seq, qofs + 1, len) ELSE '-' || CAST(len AS VARCHAR) END
      || CASE kind WHEN 2 THEN '#' || substr(seq, CAST(mid AS INTEGER) + 1, m1) || '^' || CASE x2 WHEN 'I' THEN substr(seq, CAST(mid AS INTEGER) + m1 + 1, m2) ELSE CAST(m2 AS VARCHAR) END
                   WHEN 1 THEN '^' || substr(seq, CAST(mid AS INTEGER) + 1, m1) ELSE '' END
      || CASE WHEN e.off > 0 THEN '&' || substr(seq, CAST(tq AS INTEGER) + 1, e.off) ELSE '' END AS key,
    CASE op WHEN 'I' THEN substr(qual, qofs + 1, len) ELSE '' END
      || CASE WHEN kind > 0 THEN substr(qual, CAST(mid AS INTEGER) + 1, m1) ELSE '' END
      || CASE WHEN kind = 2 AND x2 = 'I' THEN substr(qual, CAST(mid AS INTEGER) + m1 + 1, m2)
              WHEN kind = 2 AND op = 'I' THEN substr(qual, CAST(mid AS INTEGER) + m1 + 1, 1) ELSE '' END
      || CASE WHEN e.off > 0 THEN substr(qual, CAST(tq AS INTEGER) + 1, e.off) ELSE '' END
      || CASE WHEN op = 'I' THEN '' WHEN qofs + coalesce(e.off, 0) >= length(qual) THEN substr(qual, qofs, 1)
              WHEN qofs < 1 THEN substr(qual, qofs + coalesce(e.off, 0) + 1, 1)
              ELSE greatest(substr(qual, qofs, 1), substr(qual, qofs + coalesce(e.off, 0) + 1, 1)) END AS quals
  FROM lead l LEFT JOIN ext e ON e.eid = l.eid)
, scored AS (SELECT *, (SELECT avg(ascii(substr(quals, CAST(k AS INTEGER) + 1, 1)) - 33) FROM range(0, length(quals)) u(k)) AS iq FROM named)
, cev AS (
  SELECT region_id, seg_start - 1 AS pos, key AS allele, true AS is_ins, 1 AS sgn, flag, mapq, tnm, {tp('pofs')} AS tp, iq AS q, 0 AS nmoff, 0 AS cov
    FROM scored WHERE op = 'I' AND seg_start - 1 {in_region} AND NOT contains(key, 'N')
  UNION ALL
  SELECT region_id, seg_start, key, false, 1, flag, mapq, tnm, {tp('pofs')}, iq, ext_nm, 0 FROM scored WHERE op = 'D' AND seg_start {in_region}
  UNION ALL
  SELECT region_id, tr + unnest(range(0, off)), '', false, 0, flag, mapq, tnm, 0, NULL, 0, 1 FROM scored WHERE op = 'I')
SELECT region_id, pos, allele, is_ins, CAST(sum(sgn) AS BIGINT) AS cnt,
  CAST(sum(CASE WHEN (flag & 16) = 0 THEN sgn ELSE 0 END) AS BIGINT) AS fwd, CAST(sum(CASE WHEN (flag & 16) <> 0 THEN sgn ELSE 0 END) AS BIGINT) AS rev,
  CAST(sum(sgn * tp) AS BIGINT) AS tp_sum, CAST(coalesce(sum(q), 0) AS DOUBLE) AS q_sum, CAST(sum(sgn * (tnm - nmoff)) AS BIGINT) AS nm_sum,
  CAST(sum(sgn * mapq) AS BIGINT) AS mq_sum, CAST(sum(CASE WHEN sgn = 1 AND q >= {goodq} THEN 1 ELSE 0 END) AS BIGINT) AS hicnt,
  CAST(sum(CASE WHEN sgn = 1 AND q < {goodq} THEN 1 ELSE 0 END) AS BIGINT) AS locnt,
  coalesce(min(CASE WHEN sgn = 1 THEN tp END) <> max(CASE WHEN sgn = 1 THEN tp END), false) AS pstd,
  coalesce(min(CASE WHEN sgn = 1 THEN q END) <> max(CASE WHEN sgn = 1 THEN q END), false) AS qstd, CAST(sum(cov) AS BIGINT) AS cov_add
FROM cev GROUP BY region_id, pos, allele, is_ins"""
