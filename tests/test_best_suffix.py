"""The candidate with the longest common ending: against all pairs, and where all paths end alike."""

import random
import time

from corvox.operators import turns


def test_best_suffix_against_all_pairs(spark):
    draw = random.Random(5)
    some = lambda n: {"/".join(draw.choice(["a", "b", "", "ab"]) for _ in range(draw.randrange(1, 5))) for _ in range(n)}
    paths, found = some(80), some(40)

    def shared(p, c):
        k, a, b = 0, p.split("/")[::-1], c.split("/")[::-1]
        while k < min(len(a), len(b)) and a[k] == b[k]:
            k += 1
        return k

    want = {}
    for p in paths:
        best = min(((-shared(p, c), c) for c in found if shared(p, c)), default=None)
        if best:
            want[p] = best[1]
    rows = spark.createDataFrame([(p,) for p in [*paths, *paths, None]], "p string")
    got = turns.best_suffix(rows, "p", spark.createDataFrame([(c,) for c in [*found, None]], "c string"), "c").collect()
    assert sorted(map(tuple, got)) == sorted(want.items())


def test_best_suffix_of_a_common_last_part(spark):
    """400 million pairs share their last part; trying them all takes minutes."""
    began = time.time()
    rows = spark.range(20_000).selectExpr("concat('https://h', id % 7, '/d', id, '/') as p")
    kept = spark.range(20_000).selectExpr("concat('store/d', id, '/') as c")
    out = turns.best_suffix(rows, "p", kept, "c")
    assert out.where("split(p, '/')[3] = split(c, '/')[1]").count() == out.count() == 20_000
    assert time.time() - began < 60
