import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from corvox.llm import chat_format, components as comp, embed_dedup, mixing, permutation_index, rendezvous, toxicity

from .helpers import AWKWARD, DOCS, components, groups


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(AWKWARD, DOCS).repartition(3)


def test_components(spark):
    draw = random.Random(1)
    edges = [(i, i + 1) for i in range(60) if i % 7] + [(draw.randrange(100, 160), draw.randrange(100, 160)) for _ in range(40)] + [(500, 500 + i) for i in range(50)]
    draw.shuffle(edges)
    found = comp.connected_components(spark.createDataFrame([*edges, (None, 3)], "a long, b long")).collect()
    assert {r["id"]: r["component"] for r in found} == components({n for e in edges for n in e}, edges)
    assert comp.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_shards(docs):
    rows = rendezvous.document_shards(docs, 5).collect()
    assert len(rows) == len(AWKWARD)
    for own in groups(rows, "shard").values():
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
    for r in rows:
        assert r["grown_shard"] in (r["shard"], 5)
    sizes = {(i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, *_ in AWKWARD}
    assert {(r["doc_id"], r["size"], r["text_crc32"]) for r in rows} == sizes
    assert rendezvous.document_shards(docs.limit(0)).count() == 0


def test_weighted_shards_and_moves(spark):
    keys = spark.range(20_000)
    count = lambda w: {r[0]: r[1] for r in keys.groupBy(rendezvous.shard_of(F.col("id"), len(w), w)).count().collect()}
    own = count([1, 2, 0, 1])
    assert 2 not in own and abs(own[1] / 20_000 - 0.5) < 0.02
    moved = keys.where(rendezvous.shard_of(F.col("id"), 9) != rendezvous.shard_of(F.col("id"), 10))
    assert abs(moved.count() / 20_000 - 0.1) < 0.01
    same = keys.where(rendezvous.shard_of(F.col("id"), 70) != rendezvous.shard_of(F.col("id"), 70, [1.0] * 70))
    assert same.count() == 0
    with pytest.raises(ValueError):
        rendezvous.shard_of(F.col("id"), 2, [0, 0])


def filled(sizes):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    full, left = {}, 1.5 * sum(sizes.values())
    while True:
        rest = sum(w for s, w in weight.items() if s not in full)
        over = [s for s in names if s not in full and left * weight[s] / rest > 2 * sizes[s]]
        if not over:
            return {s: full.get(s, left * weight[s] / rest if rest else 0) for s in names}
        for s in over:
            full[s] = 2 * sizes[s]
            left -= full[s]


def test_mixing(spark, docs):
    draw = random.Random(3)
    rows = [(i, "w " * draw.randint(0, 40), draw.choice(["a", "b", "b", "b", "é", "Z", None])) for i in range(600)]
    rows += [(700, "same words here", "a")] * 5
    table = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", F.lit("clash"))
    out = mixing.mixed(table).collect()
    sizes = {s: sum(len(t.split()) for _, t, x in rows if x == s) for s in {x for _, _, x in rows}}
    want = filled(sizes)
    for s, own in groups(out, "source").items():
        assert own[0]["source_size"] == sizes[s]
        assert own[0]["target"] == pytest.approx(want[s])
        assert abs(sum(r["taken"] for r in own) - want[s]) <= 40
    assert all(r["taken"] <= 2 * r["size"] and len(r["positions"]) == r["copies"] and all(0 <= p <= 1 for p in r["positions"]) for r in out)
    again = mixing.mixed(table.repartition(7)).collect()
    assert sorted((r["doc_id"], r["taken"]) for r in out) == sorted((r["doc_id"], r["taken"]) for r in again)
    order = mixing.in_training_order(table)
    assert order.columns == table.columns and order.count() == sum(r["copies"] for r in out)
    assert mixing.mixed(docs).count() == len(AWKWARD) and mixing.mixed(docs.limit(0)).count() == 0


def test_positions_follow_the_schedule(spark):
    shares = spark.range(101).select((F.col("id") / 100).alias("s"))
    for tilt in (-0.5, 0.0, 0.5):
        for r in shares.select("s", mixing.position(F.col("s"), F.lit(tilt)).alias("t")).collect():
            assert r["t"] + tilt * (r["t"] - r["t"] ** 2) == pytest.approx(r["s"], abs=1e-9)


def rendered(turns):
    return "".join(f"<|{r}|>\n{t}<|end|>\n" for r, t in turns)


def test_chat_pairs(spark):
    turns = [
        (1, 0, "user", "hi"), (1, 1, "assistant", "good"), (1, 2, "user", "more"), (1, 3, "assistant", "yes"),
        (2, 0, "user", "hi"), (2, 1, "assistant", "good"), (2, 2, "user", "more"), (2, 3, "assistant", "no"),
        (3, 0, "user", "alone"), (4, 0, None, None), (4, 1, "assistant", "x"), (5, 0, "user", "hi"), (None, 0, "user", "lost"),
    ]
    table = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    convs = chat_format.conversations(table)
    out = chat_format.formatted(chat_format.paired(convs, 6)).collect()
    by_id = {}
    for c, _, role, text in turns:
        by_id.setdefault(c, []).append((role or "", text or ""))
    seen = []
    for r in out:
        a, b = by_id.get(r["chosen_id"], []), by_id[r["rejected_id"]] if r["rejected_id"] is not None else []
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        if r["chosen_id"] is None and r["rejected_id"] is None:
            continue
        assert (r["prefix_turns"], r["prompt"]) == (n, rendered(a[:n]))
        for side, own in (("chosen", a[n:]), ("rejected", b[n:])):
            assert r[f"{side}_completion"] == rendered(own)
            said = [r[f"{side}_completion"][s["start"] : s["end"]] for s in r[f"{side}_spans"]]
            assert said == [t + "<|end|>\n" for role, t in own if role == "assistant"]
        seen += [r["chosen_id"], r["rejected_id"]]
    assert sorted(i for i in seen if i is not None) == [1, 2, 3, 4, 5]
    assert sum(r["rejected_id"] is not None for r in out) == 1
    assert chat_format.formatted(chat_format.paired(chat_format.conversations(table.limit(0)), 0)).count() == 0


def vectors(draw, n, dim):
    out = []
    for _ in range(n):
        c = draw.standard_normal(dim)
        out += [(c + draw.standard_normal(dim) * s).tolist() for s in draw.choice([0.05, 0.3, 0.5, 0.6], draw.integers(1, 12))]
    out += [out[0], out[0], [2 * v for v in out[0]]]
    return out


ODD = [None, [], [0.0] * 24, [float("nan")] + [1.0] * 23, [float("inf")] + [1.0] * 23, [None] + [1.0] * 23]


@pytest.mark.parametrize("block", [512, 8])
def test_embedding_links(spark, block):
    x = vectors(np.random.default_rng(block), 40, 24)
    rows = list(enumerate(x)) + [(1000 + i, v) for i, v in enumerate(ODD)]
    out = {r["item"]: r for r in embed_dedup.linked(spark.createDataFrame(rows, "item long, v array<double>"), "item", "v", 0.9, block).collect()}
    u = np.array(x) / np.linalg.norm(x, axis=1)[:, None]
    near = [(i, j) for i in range(len(x)) for j in range(i) if u[i] @ u[j] >= 0.9]
    want = components(out, near)
    assert len(out) == len(rows)
    for i, r in out.items():
        assert r["n_links"] == sum(i in p for p in near)
        assert r["component_id"] == want[i] and r["kept"] == (want[i] == i)
    only = embed_dedup.linked(spark.createDataFrame(rows[-3:], "item long, v array<double>"), "item", "v")
    assert [r["n_links"] for r in only.collect()] == [0, 0, 0]
    assert embed_dedup.linked(spark.createDataFrame([], "item long, v array<float>"), "item", "v").count() == 0


def test_search_recall(spark):
    draw = np.random.default_rng(2)
    x = draw.standard_normal((6000, 24)) * draw.uniform(0.5, 2, (6000, 1))
    rows = list(enumerate(x.tolist())) + [(10_000 + 20 * i, v) for i, v in enumerate(ODD)]
    table = spark.createDataFrame(rows, "item long, v array<double>").withColumn("rank", F.lit(0))
    out = groups(permutation_index.search(table, F.col("item") % 100 == 0, "item", "v", 10).collect(), "query_id")
    assert sorted(out) == list(range(0, 6000, 100))
    hits = 0
    for i, own in out.items():
        score = x @ x[i]
        score[i] = -np.inf
        own.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == list(range(1, 11)) and i not in {r["item"] for r in own}
        assert np.allclose([r["score"] for r in own], score[[r["item"] for r in own]], rtol=1e-12)
        assert [r["score"] for r in own] == sorted((r["score"] for r in own), reverse=True)
        hits += len({r["item"] for r in own} & set(np.argsort(-score)[:10].tolist()))
    assert hits >= 0.9 * 10 * len(out)


def test_search_small(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None)], "item long, v array<float>")
    out = permutation_index.search(few, F.col("item") == 0, "item", "v", 20).orderBy("rank").collect()
    assert [(r["rank"], r["item"], r["score"]) for r in out] == [(1, 1, 1.0), (2, 2, 1.0)]
    assert permutation_index.search(few.limit(0), F.col("item") == 0, "item", "v", 20).count() == 0


def test_search_takes_the_smallest_of_equal_vectors(spark):
    draw = np.random.default_rng(6)
    x = draw.standard_normal((300, 8)).tolist() + [[3.0] * 8] * 200
    rows = list(enumerate(x))
    table = spark.createDataFrame(rows[::-1], "item long, v array<double>").repartition(5)
    out = groups(permutation_index.search(table, F.col("item") >= 450, "item", "v", 5).collect(), "query_id")
    assert sorted(out) == list(range(450, 500))
    for i, own in out.items():
        assert [(r["rank"], r["item"]) for r in sorted(own, key=lambda r: r["rank"])] == [(k + 1, 300 + k) for k in range(5)]


def test_search_is_routed_where_vectors_cluster(spark):
    draw = np.random.default_rng(7)
    centres = draw.standard_normal((40, 16)) * 4
    x = centres[draw.integers(0, 40, 4000)] + draw.standard_normal((4000, 16)) * 0.3
    pivots = permutation_index.Pivots(x[:1500], float(np.linalg.norm(x, axis=1).max()), 40, 10)
    assert pivots.routes < 20
    table = spark.createDataFrame(list(enumerate(x.tolist())), "item long, v array<double>")
    out = groups(permutation_index.search(table, F.col("item") % 50 == 0, "item", "v", 10).collect(), "query_id")
    hits = 0
    for i, own in out.items():
        score = x @ x[i]
        score[i] = -np.inf
        hits += len({r["item"] for r in own} & set(np.argsort(-score)[:10].tolist()))
    assert hits >= 0.9 * 10 * len(out)


def all_segments(scores):
    """Maximal segments by their definition: the best one, then the same on both sides of it."""
    best = max(((sum(scores[i : j + 1]), -(j - i), i, j) for i in range(len(scores)) for j in range(i, len(scores))), default=(0,))
    if best[0] <= 0:
        return []
    _, _, i, j = best
    return all_segments(scores[:i]) + [(i, j)] + [(a + j + 1, b + j + 1) for a, b in all_segments(scores[j + 1 :])]


def test_maximal_segments_by_definition():
    draw = random.Random(9)
    for _ in range(300):
        scores = [draw.choice([-0.5, -0.5, -0.5, 1.37, 0.21, 3.11, -2.3]) + draw.random() / 1000 * 0 for _ in range(draw.randint(1, 25))]
        found = toxicity.maximal_segments([(i, s) for i, s in enumerate(scores) if s != -0.5], -0.5, len(scores))
        total = sum(s for s, _, _ in found)
        want = all_segments(scores)
        assert total == pytest.approx(sum(sum(scores[i : j + 1]) for i, j in want))


def toxic_corpus():
    draw = random.Random(4)
    words = ["".join(draw.choice("abcdefgh") for _ in range(draw.randint(2, 6))) for _ in range(300)]
    rows, labels = [], []
    for i in range(1500):
        own = [draw.choice(words) for _ in range(draw.randint(5, 80))]
        toxic = draw.random() < 0.15
        if toxic:
            for _ in range(draw.randint(2, 4)):
                own.insert(draw.randrange(len(own)), draw.choice(["vilezz", "nastyqq", "grimxx" + draw.choice("abcd")]))
        rows.append((i, " ".join(own)))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_toxicity_on_held_out_rows(spark, docs):
    rows, labels = toxic_corpus()
    table, marked = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([*labels, (None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(table, marked)
    out = toxicity.scored(table.withColumn("score", F.lit(1)), model).withColumn("held_out", toxicity.held_out(F.col("doc_id"))).collect()
    truth = {i: t for i, _, t in labels}
    own = [r for r in out if r["held_out"]]
    assert {r["doc_id"] for r in own} == {i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0}
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in own) >= 0.95 * len(own)
    for r in own:
        assert r["predicted"] == int(r["score"] >= 0.5)
        said = {w for p in r["passages"] for w in r["text"].split()[p["first"] : p["last"] + 1]}
        assert not r["predicted"] or said & {"vilezz", "nastyqq"} or any(w.startswith("grimxx") for w in said)
    odd = toxicity.scored(docs, model).collect()
    assert len(odd) == len(AWKWARD) and all(r["predicted"] == 0 for r in odd)
    nothing = toxicity.fit(table, marked.limit(0))
    assert {r["predicted"] for r in toxicity.scored(table, nothing).collect()} == {0}
    assert toxicity.scored(docs.limit(0), nothing).count() == 0
