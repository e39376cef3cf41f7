import corpus_pipeline as C
from pilecall.llm import decontam, jaccard_join, langid, packing, secret_scan
from pilecall.llm.common import table

from .edge import SF, docs_of, empty_docs, odd_docs


def test_stages_are_the_operators_in_order(spark):
    assert [name for name, _ in C.STAGES] == ["language ID", "n-gram Jaccard join", "benchmark decontamination", "secret scan", "best-fit packing"]
    docs = table(spark, SF, "documents")
    for _, stage in C.STAGES[:4]:
        assert stage(spark, docs, SF).columns == docs.columns


def test_whole_run(spark):
    """Every decision takes effect, and nothing else changes the documents."""
    docs = table(spark, SF, "documents")
    items = table(spark, SF, "benchmark")
    known = {r.doc_id for r in langid.language_of(docs).where("lang_pred <> 'und' and score >= 0.5").collect()}
    left = docs.where(docs.doc_id.isin(sorted(known)))
    first = {r.doc_id for r in jaccard_join.near_duplicates(left).collect() if r.component_id == r.doc_id}
    leaked = {r.doc_id for r in decontam.leaked_items(docs, items).collect()}
    keep = first - leaked
    want = secret_scan.redact(docs.where(docs.doc_id.isin(sorted(keep))))
    pieces = {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packing.pieces(want).collect()}
    rows = C.run(spark, SF).collect()
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows} == pieces
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        assert sum(n for _, n in parts) <= 1024
        assert [o for o, _ in sorted(parts)] == [sum(n for o2, n in parts if o2 < o) for o, _ in sorted(parts)]


def test_planted_cases(spark):
    clean = "the reader of this plain text finds nothing wrong with it and so it stays for all of the training to come"
    copy = clean.replace("plain", "simple", 1)
    rows = {1: clean + " " + " ".join(f"more{i}" for i in range(60)), 2: copy + " " + " ".join(f"more{i}" for i in range(60)), 3: None, 4: "123 !!!", 5: 'the key is here: token = "0123456789abcdef0123456789" and so on for the reader of it'}
    docs = docs_of(spark, rows)
    for _, stage in C.STAGES[:4]:
        docs = stage(spark, docs, SF)
    got = {r.doc_id: r.text for r in docs.collect()}
    assert set(got) == {1, 5} and got[1] == rows[1] and "0123456789" not in got[5]


def test_odd_rows(spark):
    for docs in (odd_docs(spark), empty_docs(spark)):
        for _, stage in C.STAGES:
            docs = stage(spark, docs, SF)
        assert "sequence_id" in docs.columns
        docs.count()
