import random

from aerofeat.llm.components import components


def test_equals_union_find(spark):
    rnd = random.Random(6)
    edges = [(i, i + 1) for i in range(100, 400)] + [(1000 + i, 999) for i in range(50)] \
        + [(rnd.randrange(2000, 2300), rnd.randrange(2000, 2300)) for _ in range(200)] + [(5, 5)]
    up = {}

    def top(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x
    for a, b in edges:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: top(x) for x in up}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
