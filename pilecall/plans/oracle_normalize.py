"""DuckDB oracle of CIGAR normalisation (D15): string patterns in a recursive query.

Written from SURVEY §2.4 in another form than the Spark expression: the state is the
CIGAR text, each step of a recursive CTE tries one clause as a pattern on it, and read
and reference are looked up in one padded text per read.
"""

from __future__ import annotations

from pilecall.fixtures import PRELUDE

_PAD = 200  # reference bases taken on both sides of the alignment start


def _g(pattern: str, k: int) -> str:
    return f"TRY_CAST(regexp_extract(cigar, '{pattern}', {k}) AS INTEGER)"


def _r(pos: str) -> str:
    return f"substr(w, CAST(({pos}) - w0 + 1 AS INTEGER), 1)"


def _q(i: str) -> str:
    return f"CASE WHEN ({i}) BETWEEN 0 AND length(seq) - 1 THEN substr(seq, CAST(({i}) + 1 AS INTEGER), 1) ELSE '~' END"


def _eq(pos: str, i: str) -> str:
    return f"({_r(pos)} = {_q(i)} AND {_r(pos)} <> '.')"


def _ne(pos: str, i: str) -> str:
    return f"({_r(pos)} <> {_q(i)} AND {_r(pos)} <> '.' AND {_q(i)} <> '~')"


def _run(n: str, cond: str) -> str:
    hits = f"list_filter(range(0, CAST(greatest(0, {n}) AS BIGINT)), lambda t: NOT coalesce({cond}, false))"
    return f"coalesce(list_min({hits}), greatest(0, {n}))"


def _sum(text: str, letters: str) -> str:
    return f"coalesce(list_sum(list_transform(regexp_extract_all({text}, '(\\d+)[{letters}]', 1), lambda x: CAST(x AS INTEGER))), 0)"


def _clauses() -> list[tuple[str, str, str, str]]:
    """(pattern, extra condition, replacement, shift of the start)"""
    out = []
    p = r"^(\d+)S(\d+)([ID])"
    kind = lambda pat, k, o: f"regexp_extract(cigar, '{pat}', {k}) = '{o}'"
    add = lambda pat, k, n, o="I": f"CASE WHEN {kind(pat, k, o)} THEN {_g(pat, n)} ELSE 0 END"
    out.append((p, "true", f"concat({_g(p, 1)} + {add(p, 3, 2)}, 'S')", f"CASE WHEN {kind(p, 3, 'D')} THEN 2 ELSE 0 END"))
    p = r"(\d+)([ID])(\d+)S$"
    out.append((p, "true", f"concat({_g(p, 3)} + {add(p, 2, 1)}, 'S')", "0"))
    p = r"^(\d+)S(\d+)M(\d+)([ID])"
    out.append((p, f"{_g(p, 2)} <= 10", f"concat({_g(p, 1)} + {_g(p, 2)} + {add(p, 4, 3)}, 'S')", f"{_g(p, 2)} + {add(p, 4, 3, 'D')}"))
    p = r"(\d+)([ID])(\d+)M(\d+)S$"
    out.append((p, f"{_g(p, 3)} <= 10", f"concat({_g(p, 4)} + {_g(p, 3)} + {add(p, 2, 1)}, 'S')", "0"))
    p = r"^(\d)M(\d+)([ID])(\d+)M"
    clip, start = f"({_g(p, 1)} + {add(p, 3, 2)})", f"(pos + {_g(p, 1)} + {add(p, 3, 2, 'D')})"
    off = _run(_g(p, 4), _ne(f"{start} + t", f"{clip} + t"))
    out.append((p, f"{_g(p, 1)} <= 8", f"concat({clip} + {off}, 'S', {_g(p, 4)} - {off}, 'M')", f"{start} + {off} - pos"))
    p = r"(\d+)([ID])(\d)M$"
    out.append((p, f"{_g(p, 3)} <= 8", f"concat({_g(p, 3)} + {add(p, 2, 1)}, 'S')", "0"))
    p = r"(\d+)M(\d+)D(\d)M(\d+)I(\d)M(\d+)D"
    pre = rf"regexp_extract(cigar, '^(.*?){p}', 1)"
    mid = f"({_g(p, 3)} + {_g(p, 5)})"
    rd, rf = f"({_g(p, 1)} + {_sum(pre, 'MIS')})", f"(pos + {_g(p, 1)} + {_sum(pre, 'MD')})"
    same = _run(f"least(length(seq), {_g(p, 2)} + {mid} + {_g(p, 6)}, {mid} + {_g(p, 4)})", _eq(f"{rf} + t", f"{rd} + t"))
    out.append((p, f"{mid} <= 10", f"concat({_g(p, 1)} + {same}, 'M', {_g(p, 2)} + {mid} + {_g(p, 6)} - {same}, 'D', {mid} + {_g(p, 4)} - {same}, 'I')", "0"))
    for lead in "DI":
        # an insertion after a second insertion is no part of the pattern
        p = rf"(\d+){lead}(\d)M(?:(\d+)D(?:(\d+)I)?|(\d+)I)"
        d2, i3, i2 = (f"coalesce({_g(p, k)}, 0)" for k in (3, 4, 5))
        first_d, first_i = (_g(p, 1), "0") if lead == "D" else ("0", _g(p, 1))
        out.append((p, "true", f"concat({first_d} + {_g(p, 2)} + {d2}, 'D', {first_i} + {_g(p, 2)} + {i2} + {i3}, 'I')", "0"))
    return out


def _replace(pattern: str, new: str) -> str:
    return f"regexp_replace(cigar, '{pattern}', {new})"


def sql() -> str:
    clauses = _clauses()
    hit = " ".join(f"WHEN {k} THEN regexp_matches(cigar, '{p}') AND coalesce({c}, false)" for k, (p, c, _, _) in enumerate(clauses))
    new = " ".join(f"WHEN {k} THEN {_replace(p, n)}" for k, (p, _, n, _) in enumerate(clauses))
    shift = " ".join(f"WHEN {k} THEN {s}" for k, (_, _, _, s) in enumerate(clauses))
    tail, head = r"(\d+)M(\d+)S$", r"^(\d+)S(\d+)M"
    pre = rf"regexp_extract(cigar, '^(.*?){tail}', 1)"
    good = lambda i: f"ascii(substr(qual, CAST({i} + 1 AS INTEGER), 1)) - 33 > 10"
    nt = lambda first, sign: f"len(list_distinct(list_transform(range(0, CAST(rn AS BIGINT)), lambda t: {_r(f'{first} {sign} t')})))"
    return PRELUDE.replace("WITH li AS", "WITH RECURSIVE li AS", 1) + rf"""
, er AS (SELECT *, row_number() OVER () AS rid, {_sum('cigar', 'ID')} AS idl, start_pos - {_PAD} AS w0 FROM edge_reads)
, win AS (
  SELECT rid, string_agg(coalesce(b.seq, repeat('.', 32)), '' ORDER BY k.block) AS text, min(k.block) * 32 + 1 AS t0
  FROM (SELECT rid, chr, CAST(unnest(range(CAST(floor((w0 - 1) / 32) AS BIGINT), CAST(floor((start_pos + {_PAD}) / 32) AS BIGINT) + 1)) AS BIGINT) AS block FROM er) k
  LEFT JOIN ref_blocks b ON b.chr = k.chr AND b.block = k.block GROUP BY rid)
, base AS (SELECT er.rid, read_name, sample, seq, qual, cigar, start_pos, idl, t0 AS w0, text AS w FROM er JOIN win ON er.rid = win.rid)
, nz AS (
  SELECT rid, cigar, start_pos AS pos, 0 AS step, CASE WHEN idl > 0 THEN 0 ELSE 9 END AS quiet FROM base
  UNION ALL
  SELECT rid, CASE WHEN hit THEN new ELSE cigar END, CASE WHEN hit THEN pos + shift ELSE pos END, step + 1, CASE WHEN hit THEN 0 ELSE quiet + 1 END
  FROM (SELECT z.rid, z.cigar, z.pos, z.step, z.quiet, CASE step % 9 {hit} END AS hit, CASE step % 9 {new} END AS new, CASE step % 9 {shift} END AS shift
        FROM (SELECT n.*, b.seq, b.w, b.w0 FROM nz n JOIN base b ON b.rid = n.rid WHERE n.quiet < 9) z) y)
, settled AS (SELECT b.rid, read_name, sample, seq, qual, w, w0, z.cigar, z.pos FROM base b JOIN nz z ON z.rid = b.rid WHERE z.quiet = 9)
, c0 AS (
  SELECT *, regexp_matches(cigar, '{tail}') AS has, {_g(tail, 1)} AS mch, {_g(tail, 2)} AS soft,
         pos + {_g(tail, 1)} + {_sum(pre, 'MD')} AS refoff, {_g(tail, 1)} + {_sum(pre, 'MIS')} AS rdoff FROM settled)
, c1 AS (SELECT *, {_run('soft - 1', _eq('refoff + t + 1', 'rdoff + t + 1') + ' AND ' + good('(rdoff + t + 1)'))} AS rn FROM c0)
, c2 AS (SELECT *, CASE WHEN (rn > 3 AND {nt('refoff + 2', '+')} > 1) OR {_eq('refoff', 'rdoff')} THEN rn + 1 ELSE 0 END AS gain FROM c1)
, c3 AS (SELECT *, CASE WHEN rn = 0 THEN {_run('mch + gain', _ne('refoff - t - 1', 'rdoff - t - 1'))} ELSE 0 END AS back FROM c2)
, c4 AS (SELECT *, CASE WHEN back > 0 AND back < mch + gain AND soft > gain THEN gain - back ELSE gain END AS g FROM c3)
, t1 AS (
  SELECT rid, read_name, sample, seq, qual, w, w0, pos,
         CASE WHEN coalesce(has, false) THEN regexp_replace(cigar, '{tail}', concat(mch + g, 'M', CASE WHEN soft - g > 0 THEN concat(soft - g, 'S') ELSE '' END)) ELSE cigar END AS cigar FROM c4)
, h0 AS (SELECT *, regexp_matches(cigar, '{head}') AS has, {_g(head, 2)} AS mch, {_g(head, 1)} AS soft FROM t1)
, h1 AS (SELECT *, {_run('soft - 1', _eq('pos - t - 2', 'soft - t - 2') + ' AND ' + good('(soft - t - 2)'))} AS rn FROM h0)
, h2 AS (SELECT *, (rn > 3 AND {nt('pos - 3', '-')} > 1) OR {_eq('pos - 1', 'soft - 1')} AS joins, {_run('mch', _ne('pos + t', 'soft + t'))} AS off FROM h1)
, h3 AS (SELECT *, CASE WHEN joins THEN rn + 1 WHEN rn = 0 AND off > 0 AND off < mch THEN -off ELSE 0 END AS g FROM h2)
SELECT read_name, sample, seq, CASE WHEN coalesce(has, false) THEN pos - g ELSE pos END AS start_pos,
       CASE WHEN coalesce(has, false) THEN regexp_replace(cigar, '{head}', concat(CASE WHEN soft - g > 0 THEN concat(soft - g, 'S') ELSE '' END, mch + g, 'M')) ELSE cigar END AS cigar
FROM h3"""
