import random
from difflib import SequenceMatcher

import pytest

from corvox.operators import similarity as S


def words(seed, n, longest=14):
    draw = random.Random(seed)
    out = set()
    while len(out) < n:
        w = "".join(draw.choice("abcdeé") for _ in range(draw.randrange(1, longest)))
        out.add(w)
        k = draw.randrange(len(w))
        out.add(w[:k] + draw.choice("abcX") + w[k + draw.randrange(2) :])
    return sorted(out)


@pytest.mark.parametrize("least", [0.75, 0.9])
def test_no_similar_pair_is_lost(spark, least):
    a, b = words(1, 300), words(2, 250)
    frames = [spark.createDataFrame([(w,) for w in [*x, "", None, x[0]]], "w string") for x in (a, b)]
    got = {(r["a"], r["b"]): r["ratio"] for r in S.similar_words(*frames, least).collect()}
    ratio = lambda x, y: SequenceMatcher(None, x, y, autojunk=False).ratio()
    want = {(x, y): ratio(x, y) for x in a for y in b if ratio(x, y) >= least}
    assert got == want and len(want) > 10


def test_closest_spelling(spark):
    f = lambda *w: spark.createDataFrame([(x,) for x in w], "w string")
    out = {r["w"]: r["spelling"] for r in S.closest(f("Union", "UNION", "chirak", "zebra", "unnion"), f("Union", "UNION", "Chirac", "chirack", "union")).collect()}
    assert out == {"Union": "Union", "UNION": "UNION", "chirak": "chirack", "unnion": "union"}
    scores = {r["w"]: r["score"] for r in S.confusable(f("Chirac", "moon"), f("chirack")).collect()}
    assert scores["moon"] is None and round(scores["Chirac"], 4) == round(12 / 13, 4)


def test_least_is_bounded(spark):
    with pytest.raises(ValueError):
        S.similar_words(spark.createDataFrame([], "w string"), spark.createDataFrame([], "w string"), 0.5)
