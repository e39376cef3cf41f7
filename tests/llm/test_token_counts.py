import random

from pilecall.llm import token_counts as T
from pilecall.llm.common import table

from .edge import SF, docs_of, empty_docs, odd_docs
from .test_packing import PIECES, plain


def brute_force(text, offsets):
    """Each token, character by character, to the line that holds most of it, the earlier one on a tie."""
    line, lines = 0, []
    for c in text:
        lines.append(line)
        line += c == "\n"
    counts = [0] * (max(lines, default=0) + 1)
    for a, b in offsets:
        held = [lines[i] for i in range(a, max(a + 1, b))]
        counts[max(sorted(set(held)), key=held.count)] += 1
    return counts


def check(spark, docs):
    rows = docs.collect()
    got = {}
    for r in T.section_tokens(docs).collect():
        got.setdefault(r.doc_id, []).append((r.section, r.start, r.stop, r.n_tokens))
    for r, e in zip(rows, plain([r.text or "" for r in rows])):
        parts = sorted(got[r.doc_id])
        text = r.text or ""
        assert [n for *_, n in parts] == brute_force(text, e.offsets), text
        assert [s for s, *_ in parts] == list(range(len(parts)))
        assert "".join(text[a:b] for _, a, b, _ in parts) == text
        assert sum(n for *_, n in parts) == len(e.ids)


def test_made_texts(spark):
    rng = random.Random(9)
    check(spark, docs_of(spark, {i: "".join(rng.choices(PIECES, k=rng.randrange(0, 14))) for i in range(600)}))


def test_table(spark):
    check(spark, table(spark, SF, "documents"))


def test_odd_rows(spark):
    rows = T.section_tokens(odd_docs(spark)).collect()
    assert {(r.section, r.start, r.stop, r.n_tokens) for r in rows if r.doc_id in (1, 2)} == {(0, 0, 0, 0)}
    assert len([r for r in rows if r.doc_id == 5]) == 2
    assert T.section_tokens(empty_docs(spark)).count() == 0
