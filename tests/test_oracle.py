"""Spark query vs DuckDB oracle on sf0.001 for a representative subset (full set: tests/oracle_check.py)."""

import pytest

from tests.oracle_check import duck, rows_of

SF = "/root/testdata/sf0.001"
NAMES = ["region_read_overlap", "segment_explode", "amplicon_groups", "read_dedup", "cigar_lengths", "cigar_normalize", "complex_indels",
         "base_pileup", "mnp_merge", "clip_overlap", "insertion_pileup", "deletion_pileup", "coverage", "allele_stats",
         "softclip_collect", "call_single", "scan_sam", "scan_fasta"]


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    import __spark_entry__ as E

    sp = E.queries()[name](spark, SF).toPandas()
    dk = con.execute(E.oracle_sql()[name]).df()
    c1, r1 = rows_of(sp)
    c2, r2 = rows_of(dk)
    assert c1 == c2
    assert r1 == r2


def test_entry_smoke(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() > 0
    assert "alt_allele" in df.columns


def test_every_query_has_oracle_or_is_declared():
    import __spark_entry__ as E

    from pilecall.plans import catalog, oracle

    assert set(catalog.queries()) == set(oracle.oracle_sql())
    assert set(E.queries()) >= set(catalog.queries())
