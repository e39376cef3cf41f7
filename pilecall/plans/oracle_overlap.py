"""DuckDB text for changes spelled by two clips.

Another formulation than the Spark plan: every start of every pair is compared base by
base, one row per step, and pairs are claimed one after the other by a recursive query.
"""

from __future__ import annotations

SUMS = ("cnt", "fwd", "rev", "tp_sum", "q_sum", "mq_sum", "nm_sum", "hicnt", "locnt")


def ctes(goodq: int) -> str:
    """CTEs from ``rr``, ``cons``, ``ckeep``, ``cw3``, ``refpos`` to ``taken``: the changes that come about."""
    return f"""
, csum AS (
  SELECT region_id, side, pos, count(*) AS cnt, count(CASE WHEN (flag & 16) = 0 THEN 1 END) AS fwd, count(CASE WHEN (flag & 16) <> 0 THEN 1 END) AS rev,
         sum(m) AS tp_sum, sum(q) AS q_sum, sum(mapq) AS mq_sum, sum(tnm) AS nm_sum, count(CASE WHEN q >= {goodq} THEN 1 END) AS hicnt,
         count(CASE WHEN q < {goodq} THEN 1 END) AS locnt
  FROM (SELECT k.region_id, k.side, k.pos, k.m, rr.flag, rr.mapq, rr.tnm,
               (SELECT avg(w.tq) FROM cw3 w WHERE w.region_id = k.region_id AND w.rid = k.rid AND w.side = k.side AND w.t2 < k.qn) AS q
        FROM ckeep k JOIN rr ON rr.region_id = k.region_id AND rr.rid = k.rid) y
  GROUP BY region_id, side, pos)
, longest AS (SELECT region_id, any_value(chr) AS chr, max(rlen2) AS rlen FROM rr GROUP BY region_id)
, duo AS (
  SELECT a.region_id, chr, a.pos AS p5, b.pos AS p3, a.consensus AS seq5, b.consensus AS seq3, length(a.consensus) AS n5, length(b.consensus) AS n3
  FROM cons a JOIN cons b ON b.region_id = a.region_id AND a.side = 5 AND b.side = 3 JOIN longest l ON l.region_id = a.region_id
  WHERE length(a.consensus) > 10 AND length(b.consensus) > 10 AND NOT a.pos - b.pos > rlen / 1.5 AND NOT b.pos - a.pos > rlen - 10)
, text AS (SELECT DISTINCT seq5, seq3, n5, n3 FROM duo)
, start5 AS (SELECT *, unnest(range(0, n5 - 8)) AS i FROM text)
, start53 AS (SELECT *, unnest(range(1, n3 - 8)) AS j FROM start5)
, steps AS (SELECT *, unnest(range(0, least(n3 - j, n5 - i) + 1)) AS n FROM start53)
, compared AS (
  SELECT seq5, seq3, n5, n3, i, j, count(*) AS steps, list_sort(list(n) FILTER (WHERE substr(seq3, CAST(n3 - j - n + 1 AS INTEGER), 1) <> substr(seq5, CAST(i + n + 1 AS INTEGER), 1))) AS off
  FROM steps GROUP BY ALL)
, ended AS (
  SELECT *, CASE WHEN len(off) > 3 THEN off[4] ELSE steps END AS n, least(coalesce(len(off), 0), 4) AS nm FROM compared)
, overlap AS (
  SELECT seq5, seq3, i AS bp5, j AS bp3, n - nm AS score FROM ended
  WHERE n - nm > 8 AND nm / n < 0.1 AND (n + j >= n3 OR i + n >= n5)
  QUALIFY row_number() OVER (PARTITION BY seq5, seq3 ORDER BY i, j) = 1)
, joined AS (
  SELECT d.*, bp5, bp3, score, left(d.seq3, CAST(n3 - (bp3 - 1) AS INTEGER)) || reverse(left(d.seq5, CAST(bp5 AS INTEGER))) AS ins
  FROM duo d JOIN overlap o ON o.seq5 = d.seq5 AND o.seq3 = d.seq3)
, spelled AS (
  SELECT row_number() OVER () AS id, *, length(ins) AS n FROM joined
  WHERE greatest(length(ins) - length(replace(ins, 'A', '')), length(ins) - length(replace(ins, 'C', '')),
                 length(ins) - length(replace(ins, 'G', '')), length(ins) - length(replace(ins, 'T', ''))) / length(ins) <= 0.75)
, outer3 AS (
  SELECT id, any_value(n3 - n) AS len, count(*) FILTER (WHERE base <> substr(seq3, CAST(n + t + 1 AS INTEGER), 1)) AS bad
  FROM (SELECT *, unnest(range(0, n3 - n)) AS t FROM spelled) s JOIN refpos r ON r.chr = s.chr AND r.pos = s.p5 + t GROUP BY id)
, outer5 AS (
  SELECT id, any_value(n5 - n) AS len, count(*) FILTER (WHERE base <> substr(seq5, CAST(n + t + 1 AS INTEGER), 1)) AS bad
  FROM (SELECT *, unnest(range(0, n5 - n)) AS t FROM spelled) s JOIN refpos r ON r.chr = s.chr AND r.pos = s.p3 - 1 - t GROUP BY id)
, again AS (
  SELECT id, string_agg(base, '' ORDER BY pos) AS bases FROM spelled s JOIN refpos r
    ON r.chr = s.chr AND r.pos BETWEEN s.p5 AND CASE WHEN s.n > s.p3 - s.p5 THEN s.p3 ELSE s.p5 + (s.p3 - s.p5 - s.n) // 2 END
  WHERE s.p5 <= s.p3 GROUP BY id)
, change AS (
  SELECT s.*, CASE WHEN s.p5 <= s.p3 THEN '+' || coalesce(g.bases, '') || ins
                   WHEN s.n > s.p5 - s.p3 THEN '+' || left(ins, CAST(s.n - (s.p5 - s.p3) AS INTEGER)) || '&' || right(ins, CAST(s.p5 - s.p3 AS INTEGER))
                   ELSE '-' || CAST(s.p5 - s.p3 AS VARCHAR) || '^' || ins END AS allele,
         s.p5 <= s.p3 OR s.n > s.p5 - s.p3 AS is_ins,
         CASE WHEN s.p5 <= s.p3 THEN s.p5 - 1 WHEN s.n > s.p5 - s.p3 THEN s.p3 - 1 ELSE s.p3 END AS pos
  FROM spelled s LEFT JOIN outer3 a ON a.id = s.id LEFT JOIN outer5 b ON b.id = s.id LEFT JOIN again g ON g.id = s.id
  WHERE coalesce(a.bad <= 2 AND a.bad / a.len < 0.15, true) AND coalesce(b.bad <= 2 AND b.bad / b.len < 0.15, true))
, queue AS (
  SELECT c.*, a.cnt AS cnt5, b.cnt AS cnt3, row_number() OVER (PARTITION BY c.region_id ORDER BY a.cnt DESC, c.p5, b.cnt DESC, c.p3) AS nr
  FROM change c JOIN csum a ON a.region_id = c.region_id AND a.side = 5 AND a.pos = c.p5 JOIN csum b ON b.region_id = c.region_id AND b.side = 3 AND b.pos = c.p3)
, turn AS (
  SELECT region_id, CAST(0 AS BIGINT) AS nr, CAST([] AS BIGINT[]) AS gone5, CAST([] AS BIGINT[]) AS gone3, false AS yes FROM queue WHERE nr = 1
  UNION ALL
  SELECT region_id, nr, CASE WHEN free THEN list_append(gone5, p5) ELSE gone5 END, CASE WHEN free THEN list_append(gone3, p3) ELSE gone3 END, free
  FROM (SELECT q.region_id, q.nr, CAST(q.p5 AS BIGINT) AS p5, CAST(q.p3 AS BIGINT) AS p3, t.gone5, t.gone3, NOT list_contains(t.gone5, q.p5) AND NOT list_contains(t.gone3, q.p3) AS free
        FROM turn t JOIN queue q ON q.region_id = t.region_id AND q.nr = t.nr + 1) s)
, taken AS (SELECT q.* FROM queue q JOIN turn t ON t.region_id = q.region_id AND t.nr = q.nr AND t.yes)"""


FOUND = """
SELECT region_id, CAST(p5 AS BIGINT) AS p5, CAST(p3 AS BIGINT) AS p3, CAST(bp5 AS INTEGER) AS bp5, CAST(bp3 AS INTEGER) AS bp3, CAST(score AS INTEGER) AS score,
       CAST(pos AS BIGINT) AS pos, allele, is_ins, cnt5, cnt3 FROM taken"""


def counts() -> str:
    """The pileup's alleles after the moves, from ``al`` and ``taken``."""
    given, lost = ", ".join(f"c.{x}" for x in SUMS), ", ".join(f"-c.{x}" for x in SUMS)
    total = ", ".join(f"sum({x}) AS {x}" for x in SUMS)
    out = ", ".join(f"CAST({x if x == 'nm_sum' else f'CASE WHEN less THEN greatest({x}, 0) ELSE {x} END'} AS {'DOUBLE' if x == 'q_sum' else 'BIGINT'}) AS {x}" for x in SUMS)
    return f"""
, shift AS (
  SELECT t.region_id, t.pos, t.allele, t.is_ins, {given}, c.cnt AS extracnt, CASE WHEN c.side = 5 THEN c.cnt ELSE 0 END AS cov_add, 1 AS way
    FROM taken t JOIN csum c ON c.region_id = t.region_id AND ((c.side = 5 AND c.pos = t.p5) OR (c.side = 3 AND c.pos = t.p3))
  UNION ALL
  SELECT t.region_id, t.pos, r.base, false, {lost}, 0, 0, -1
    FROM taken t JOIN csum c ON c.region_id = t.region_id AND c.side = 3 AND c.pos = t.p3 JOIN refpos r ON r.chr = t.chr AND r.pos = t.pos)
, mixed AS (
  SELECT region_id, pos, allele, is_ins, {total}, sum(extracnt) AS extracnt, sum(cov_add) AS cov_add,
         bool_or(way < 0) AS less, bool_or(way > 0) AS more, bool_or(way >= 0) AS there, bool_or(pstd) AS pstd, bool_or(qstd) AS qstd
  FROM (SELECT region_id, pos, allele, is_ins, {', '.join(SUMS)}, 0 AS extracnt, cov_add, 0 AS way, pstd, qstd FROM al
        UNION ALL SELECT *, NULL, NULL FROM shift) u GROUP BY region_id, pos, allele, is_ins)
SELECT region_id, CAST(pos AS BIGINT) AS pos, allele, {out}, coalesce(more OR pstd, false) AS pstd, coalesce(more OR qstd, false) AS qstd, is_ins,
       CAST(extracnt AS BIGINT) AS extracnt, CAST(cov_add AS BIGINT) AS cov_add
FROM mixed WHERE there AND allele <> ''"""
