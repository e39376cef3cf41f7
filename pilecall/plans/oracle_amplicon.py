"""DuckDB text for amplicon calls (I2): lists per position and amplicon, ranked by window functions."""

from __future__ import annotations

# D8 for reads without a mate on their contig and without clips
MEMBER = ("abs(r.start_pos - g.region_start) <= 10 AND abs(r.end_pos - g.region_end) <= 10 "
          "AND abs((greatest(r.start_pos, g.region_start) - least(r.end_pos, g.region_end)) / (r.end_pos - r.start_pos)) > 0.95")

PANEL = "(SELECT amplicon_id AS region_id, chr, amp_start AS region_start, amp_end AS region_end, gene FROM panel)"

# from gd (all alleles with the first rule they fail), st (statistics) and panel to spot: one row per position
SPOTS = """
, pg AS (
  SELECT *, chr || ':' || CAST(sum(head) OVER (PARTITION BY chr ORDER BY istart, amplicon_id ROWS UNBOUNDED PRECEDING) AS VARCHAR) AS amp_group
  FROM (SELECT *, CASE WHEN istart <= lag(iend) OVER (PARTITION BY chr ORDER BY istart, amplicon_id) THEN 0 ELSE 1 END AS head FROM panel) x)
, pl AS (SELECT *, unnest(generate_series(istart, iend)) AS pos, row_number() OVER (PARTITION BY amp_group ORDER BY istart, amplicon_id) AS nr FROM pg)
, look AS (
  SELECT pl.amp_group, pl.pos, pl.nr, pl.amplicon_id, pl.istart, pl.iend, pl.chr || ':' || CAST(pl.amp_start AS VARCHAR) || '-' || CAST(pl.amp_end AS VARCHAR) AS span,
         t.allele, t.freq_raw, t.tcov, t.sp, t.ep, t.ref_allele, t.alt_allele, t.vartype, (t.allele IS NOT NULL AND t.reason IS NULL) AS good,
         coalesce(t.tcov, s.tcov, 0) AS depth
  FROM pl LEFT JOIN gd t ON t.region_id = pl.amplicon_id AND t.pos = pl.pos AND t.rank = 1
  LEFT JOIN st s ON s.region_id = pl.amplicon_id AND s.pos = pl.pos AND s.is_ref)
, best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY amp_group, pos ORDER BY freq_raw DESC, nr) AS r FROM look WHERE good) y WHERE r = 1)
, lasttype AS (SELECT amp_group, pos, vartype FROM look WHERE allele IS NOT NULL QUALIFY row_number() OVER (PARTITION BY amp_group, pos ORDER BY nr DESC) = 1)
, again AS (
  SELECT b.amp_group, b.pos, l.span, row_number() OVER (PARTITION BY b.amp_group, b.pos ORDER BY v.freq_raw DESC, l.nr) AS r
  FROM best b JOIN look l ON l.amp_group = b.amp_group AND l.pos = b.pos
  JOIN gd v ON v.region_id = l.amplicon_id AND v.pos = l.pos AND v.allele = b.allele AND v.reason IS NULL)
, tally AS (
  SELECT b.amp_group, b.pos, count(*) AS n_all, count(*) FILTER (WHERE l.good) AS n_good, count(DISTINCT CASE WHEN l.good THEN l.allele END) > 1 AS differ,
         count(*) FILTER (WHERE l.depth < (SELECT max(m.tcov) FROM look m WHERE m.amp_group = b.amp_group AND m.pos = b.pos) // 50) AS no_coverage,
         (SELECT count(*) FROM again a WHERE a.amp_group = b.amp_group AND a.pos = b.pos) AS n_again,
         count(*) FILTER (WHERE NOT (l.good AND l.ref_allele = b.ref_allele AND l.alt_allele = b.alt_allele) AND b.sp >= l.istart AND b.ep <= l.iend) AS n_bad,
         count(*) FILTER (WHERE NOT (l.good AND l.ref_allele = b.ref_allele AND l.alt_allele = b.alt_allele) AND NOT (b.sp >= l.istart AND b.ep <= l.iend)
                          AND ((l.iend > b.sp AND l.iend < b.ep) OR (l.istart > b.sp AND l.istart < b.ep))) AS n_cut
  FROM best b JOIN look l ON l.amp_group = b.amp_group AND l.pos = b.pos GROUP BY b.amp_group, b.pos)
, tally2 AS (SELECT *, CASE WHEN differ THEN n_again ELSE n_good END AS n, differ AND n_again <> n_good AS undecided FROM tally)
, tally3 AS (SELECT *, CASE WHEN n <> n_all OR undecided THEN (CASE WHEN n - n_cut < 1 THEN 1 ELSE n - n_cut END) ELSE n END AS ok,
                    CASE WHEN n <> n_all OR undecided THEN n_bad ELSE 0 END AS bad FROM tally2)
, spot AS (
  SELECT t.amp_group, t.pos, b.amplicon_id AS region_id, b.allele, y.vartype,
         CASE WHEN t.differ THEN (SELECT a.span FROM again a WHERE a.amp_group = t.amp_group AND a.pos = t.pos AND a.r = 1) ELSE b.span END AS good_span,
         t.ok AS good_amplicons, t.ok + t.bad AS judged_amplicons, t.no_coverage, CAST(t.undecided AND NOT t.ok < t.n AS INTEGER) AS disagree
  FROM tally3 t JOIN best b USING (amp_group, pos) JOIN lasttype y USING (amp_group, pos))
, gk AS (SELECT g.* REPLACE (p.vartype AS vartype), p.amp_group, p.good_span, p.good_amplicons, p.judged_amplicons, p.no_coverage, p.disagree
         FROM gd g JOIN spot p ON p.region_id = g.region_id AND p.pos = g.pos AND p.allele = g.allele)
"""

GENES = "(SELECT amp_group, arg_max(gene, nr) AS gene FROM pl GROUP BY amp_group)"
