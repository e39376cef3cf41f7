import random

from pilecall.llm.graph import components


def test_components_against_union_find(spark):
    rng = random.Random(2)
    chain = [(i, i + 1) for i in range(0, 120)]
    star = [(1000, 1001 + i) for i in range(60)]
    rest = [(rng.randrange(2000, 2300), rng.randrange(2000, 2300)) for _ in range(160)]
    links = chain + star + rest + star[:5] + [(b, a) for a, b in chain[:9]]
    parent = {x: x for e in links for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[root(a)] = root(b)
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert set(got) == set(parent)
    pairs = {(root(x), got[x]) for x in parent}
    assert len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
