"""DuckDB text for the MNP adjustment.

Another formulation than the Spark plan: transfers are made one after the other
for a whole region by a recursive query, clips are compared base by base with
one row per base.
"""

from __future__ import annotations


def ctes(goodq: int) -> str:
    """CTEs from ``al`` (pileup), ``rr``, ``cons``, ``ckeep``, ``cw3``, ``refpos`` to ``adj``: alleles after E17."""
    sums = ("cnt", "fwd", "rev", "tp_sum", "q_sum", "mq_sum", "nm_sum", "hicnt", "locnt")
    given = ", ".join(f"f.{c}" for c in sums)
    taken = ", ".join(f"-f.{c}" for c in sums)
    total = ", ".join(f"sum({c}) AS {c}" for c in sums)
    floors = ", ".join(f"CAST({'x.' + c if c == 'nm_sum' else f'CASE WHEN x.less THEN greatest(x.{c}, 0) ELSE x.{c} END'} AS {'DOUBLE' if c == 'q_sum' else 'BIGINT'}) AS {c}" for c in sums)
    return f"""
, mnpk AS (SELECT region_id, chr, pos, allele, cnt, replace(allele, '&', '') AS mnt FROM al WHERE NOT is_ins AND regexp_full_match(allele, '[ACGT]&[ACGT]+'))
, cut AS (SELECT *, unnest(range(1, length(mnt))) AS cutp FROM mnpk)
, want AS (
  SELECT c.*, 0 AS behind, f.pos AS fpos, f.allele AS fallele, f.cnt AS fcnt FROM cut c
  JOIN al f ON f.region_id = c.region_id AND f.pos = c.pos AND NOT f.is_ins AND f.allele = left(c.mnt, c.cutp) AND f.cnt > 0 AND f.tp_sum // f.cnt <= c.cutp
  UNION ALL
  SELECT c.*, 1 AS behind, f.pos, f.allele, f.cnt FROM cut c
  JOIN al f ON f.region_id = c.region_id AND f.pos = c.pos + c.cutp AND NOT f.is_ins AND f.allele = right(c.mnt, length(c.mnt) - c.cutp)
           AND f.cnt > 0 AND f.tp_sum // f.cnt <= length(c.mnt) - c.cutp)
, queue AS (SELECT *, row_number() OVER (PARTITION BY region_id ORDER BY pos, allele, cutp, behind) AS nr,
                   CAST(pos AS VARCHAR) || allele AS who, CAST(fpos AS VARCHAR) || fallele AS what FROM want)
, turn AS (
  SELECT region_id, CAST(0 AS BIGINT) AS nr, '' AS who, CAST(0 AS BIGINT) AS have, CAST([] AS VARCHAR[]) AS used, false AS yes FROM queue WHERE nr = 1
  UNION ALL
  SELECT region_id, nr, who, have + CASE WHEN yes THEN fcnt ELSE 0 END, CASE WHEN yes THEN list_append(used, what) ELSE used END, yes
  FROM (SELECT q.region_id, q.nr, q.who, q.what, q.fcnt, t.used, CASE WHEN t.who = q.who THEN t.have ELSE q.cnt END AS have,
               NOT list_contains(t.used, q.what) AND q.fcnt < CASE WHEN t.who = q.who THEN t.have ELSE q.cnt END AS yes
        FROM turn t JOIN queue q ON q.region_id = t.region_id AND q.nr = t.nr + 1) s)
, done AS (SELECT q.* FROM queue q JOIN turn t ON t.region_id = q.region_id AND t.nr = q.nr WHERE t.yes)
, csum AS (
  SELECT region_id, side, pos, count(*) AS cnt, count(CASE WHEN (flag & 16) = 0 THEN 1 END) AS fwd, count(CASE WHEN (flag & 16) <> 0 THEN 1 END) AS rev,
         sum(m) AS tp_sum, sum(q) AS q_sum, sum(mapq) AS mq_sum, sum(tnm) AS nm_sum, count(CASE WHEN q >= {goodq} THEN 1 END) AS hicnt,
         count(CASE WHEN q < {goodq} THEN 1 END) AS locnt
  FROM (SELECT k.region_id, k.side, k.pos, k.m, rr.flag, rr.mapq, rr.tnm,
               (SELECT avg(w.tq) FROM cw3 w WHERE w.region_id = k.region_id AND w.rid = k.rid AND w.side = k.side AND w.t2 < k.qn) AS q
        FROM ckeep k JOIN rr ON rr.region_id = k.region_id AND rr.rid = k.rid) y
  GROUP BY region_id, side, pos)
, fit AS (
  SELECT m.region_id, m.chr, m.pos, m.allele, c.side, c.pos AS cpos, length(c.consensus) - length(m.mnt) AS n,
         CASE WHEN c.side = 3 THEN substr(c.consensus, length(m.mnt) + 1) ELSE reverse(substr(c.consensus, length(m.mnt) + 1)) END AS rest,
         CASE WHEN c.side = 3 THEN m.pos + length(m.mnt) ELSE m.pos - (length(c.consensus) - length(m.mnt)) END AS r0
  FROM mnpk m JOIN cons c ON c.region_id = m.region_id
   AND ((c.side = 3 AND c.pos = m.pos AND left(c.consensus, length(m.mnt)) = m.mnt)
     OR (c.side = 5 AND c.pos = m.pos + length(m.mnt) AND left(c.consensus, length(m.mnt)) = reverse(m.mnt))))
, fitb AS (
  SELECT x.*, coalesce(substr(rest, CAST(i AS INTEGER) + 1, 1) <> rp.base, true) AS bad
  FROM (SELECT *, unnest(range(0, n)) AS i FROM fit) x LEFT JOIN refpos rp ON rp.chr = x.chr AND rp.pos = x.r0 + x.i)
, fitn AS (SELECT region_id, pos, allele, side, count(*) FILTER (WHERE bad) AS mm FROM fitb GROUP BY ALL)
, fit1 AS (
  SELECT f.region_id, f.pos, f.allele, f.side, f.cpos, row_number() OVER (PARTITION BY f.region_id, f.side, f.cpos ORDER BY f.pos, f.allele) AS nr
  FROM fit f LEFT JOIN fitn USING (region_id, pos, allele, side) WHERE f.n = 0 OR (mm <= 3 AND mm / f.n < 0.15))
, moved AS (
  SELECT d.region_id, d.pos, d.allele, {given}, f.cnt AS extracnt, d.behind * f.cnt AS cov_add, 1 AS way
    FROM done d JOIN al f ON f.region_id = d.region_id AND f.pos = d.fpos AND f.allele = d.fallele AND NOT f.is_ins
  UNION ALL
  SELECT f.region_id, f.pos, f.allele, {taken}, 0, 0, -1
    FROM done d JOIN al f ON f.region_id = d.region_id AND f.pos = d.fpos AND f.allele = d.fallele AND NOT f.is_ins
  UNION ALL
  SELECT t.region_id, t.pos, t.allele, {given}, f.cnt, f.cnt, 1 FROM fit1 t JOIN csum f ON f.region_id = t.region_id AND f.side = t.side AND f.pos = t.cpos WHERE t.nr = 1)
, adj0 AS (
  SELECT region_id, pos, allele, is_ins, {total}, sum(extracnt) AS extracnt, sum(cov_add) AS cov_add, bool_or(way < 0) AS less, bool_or(way > 0) AS more
  FROM (SELECT region_id, pos, allele, is_ins, {', '.join(sums)}, 0 AS extracnt, cov_add, 0 AS way FROM al
        UNION ALL SELECT region_id, pos, allele, false, {', '.join(sums)}, extracnt, cov_add, way FROM moved) u
  GROUP BY region_id, pos, allele, is_ins)
, adj AS (
  SELECT al.region_id, al.chr, al.region_start, al.region_end, al.contig_len, al.pos, CASE WHEN x.less THEN '' ELSE al.allele END AS allele, al.is_ins, {floors},
         CASE WHEN x.more THEN true ELSE al.pstd END AS pstd, CASE WHEN x.more THEN true ELSE al.qstd END AS qstd,
         CAST(x.extracnt AS BIGINT) AS extracnt, CAST(x.cov_add AS BIGINT) AS cov_add
  FROM al JOIN adj0 x ON x.region_id = al.region_id AND x.pos = al.pos AND x.allele = al.allele AND x.is_ins = al.is_ins)
"""
