"""The prefix trie and the resampling against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from corvox.llm import common, prefix_trie, resampling

from .helpers import AWKWARD, DOCS

TURNS = "conv_id long, turn long, role string, text string"


def nodes_of(rows):
    """Every node of the trie, as rows of `trie`, by walking all conversations."""
    convs = defaultdict(list)
    for r in rows:
        if r[0] is not None:
            convs[r[0]].append((r[1] is not None, r[1] or 0, r[2] or "", (r[3] or "")[:64], hashlib.sha256(f"{len(r[2] or '')}:{r[2] or ''}:{r[3] or ''}".encode()).hexdigest(), r[3] or ""))
    convs = {c: [(t[2], t[5]) for t in sorted(own)] for c, own in convs.items()}
    members = defaultdict(list)
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        whole = convs.get(c - c % 100, [])[:h] + own[h:]
        for d in range(len(whole) + 1):
            members[tuple(whole[:d])].append((c, d == len(whole)))
    children = Counter(k[:-1] for k in members if k)
    leaves, saved = Counter(), Counter()
    for k, m in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += not children[k]
            saved[k[:d]] += (len(m) - 1) * len(k[-1][1]) if k else 0
    sha = lambda m: hashlib.sha256(",".join(str(c) for c, ends in sorted(m) if ends).encode()).hexdigest()
    return Counter((min(m)[0], len(k), min(members[k[:-1]])[0] if k else None, len(m), children[k], leaves[k], saved[k], sha(m)) for k, m in members.items())


def test_trie(spark):
    draw = random.Random(5)
    rows = [(None, 1, "user", "no conversation"), (7, None, None, None), (7, None, "user", "b"), (7, 3, "user", "same"), (7, 3, "user", "same"), (7, 3, "user", "é" * 100), (-5, 1, "user", "hi")]
    rows += [(c, t, "user" if t % 2 == 0 else "assistant", draw.choice(["hi", "yes", "no", "ok" * 40])) for c in range(100, 160) for t in range(draw.randrange(1, 9))]
    rows += [(200, t, "user", "hello") for t in range(3)] + [(c, t, "user", "hello") for c in range(201, 330) for t in range(3)]
    rows += [(5000 + c, t, "user", "long") for c in range(2) for t in range(1300 + c)]  # many stretches of turns, no first of the family but 5000
    rows += [(10**12 + c, 0, "x", "far") for c in range(20)]  # families without their first conversation
    draw.shuffle(rows)
    turns = spark.createDataFrame(rows, TURNS).withColumn("node", F.lit("clash")).repartition(5)
    out = prefix_trie.trie(turns)
    assert out.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert Counter(tuple(r) for r in out.collect()) == nodes_of(rows)
    assert prefix_trie.trie(turns.limit(0)).count() == 0


def test_turnless_conversations_end_at_the_root(spark):
    rows = [(c, 1, "user", "only") for c in range(1, 40)]  # no conversation 0: those with h above 0 lose their turn
    out = prefix_trie.trie(spark.createDataFrame(rows, TURNS)).collect()
    assert Counter(tuple(r) for r in out) == nodes_of(rows)


def test_placed(spark):
    draw = random.Random(2)
    values = [draw.randrange(50) if k % 7 else None for k in range(3000)]
    out = common.placed(spark.createDataFrame([(v,) for v in values], "v long"), [F.col("v").desc_nulls_last()], "place").collect()
    assert sorted(r["place"] for r in out) == list(range(3000))
    assert [r["v"] for r in sorted(out, key=lambda r: r["place"])] == sorted(values, key=lambda v: (v is None, -(v or 0)))


def test_crcs_compose():
    draw = random.Random(9)
    pairs = [(draw.randbytes(draw.randrange(90)), draw.randbytes(draw.choice([0, 1, 5, 48, 49, 50, 300, 70_000]))) for _ in range(200)]
    crc = np.array([zlib.crc32(a) for a, _ in pairs], np.uint32)
    size = np.array([len(b) for _, b in pairs])
    got = resampling.shifted(crc, size) ^ np.array([zlib.crc32(b) for _, b in pairs], np.uint32)
    assert got.tolist() == [zlib.crc32(a + b) for a, b in pairs]


def features(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return len(words), [zlib.crc32(" ".join(words[i : i + n]).encode()) % 10_000 for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def test_features_of_arrow_slices():
    texts = ["Ab c", None, "", "d", "é" * 60 + " x1" + "y" * 200, "a-b_c d9", "z"]
    array = pa.array(texts).fill_null("").slice(0)
    for a, n in ((0, 7), (2, 5), (3, 1), (1, 2), (6, 1), (0, 0)):
        bucket, owner, words = resampling.features_of(array.slice(a, n))
        want = [features(t) for t in texts[a : a + n]]
        assert words.tolist() == [w for w, _ in want]
        assert [sorted(bucket[owner == k].tolist()) for k in range(n)] == [sorted(f) for _, f in want]


def test_resampled(spark):
    draw = random.Random(4)
    vocabulary = ["alpha", "Beta", "gamma", "delta9", "é", "w" * 70, "x"]
    rows = [*AWKWARD, *((100 + k, " ".join(draw.choices(vocabulary, k=draw.randrange(0, 60))), "en", "s", 1) for k in range(300))]
    target = [("alpha beta gamma",), ("delta9 alpha",), (None,)]
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    out = resampling.resampled(docs, spark.createDataFrame(target, "text string")).collect()
    own, other = Counter(b for r in rows for b in features(r[1])[1]), Counter(b for (t,) in target for b in features(t)[1])
    gain = lambda b: math.floor(1000 * math.log((other[b] + 1) * (own.total() + 10_000) / ((own[b] + 1) * (other.total() + 10_000))))
    want, able = [], []
    for item, text, *_ in rows:
        n, found = features(text)
        weight = sum(map(gain, found))
        h = int(hashlib.sha256(f"42:{'' if item is None else item}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        want.append((item, len(found), weight, score))
        if n >= 20:
            able.append((-score, item is None, item))
    assert Counter(tuple(r)[:4] for r in out) == Counter(want)
    drawn = sorted((r for r in out if r["rank"]), key=lambda r: r["rank"])
    most = 5 * len(able) // 100
    assert [r["rank"] for r in drawn] == list(range(1, most + 1))
    assert [(-r["score"], r["doc_id"] is None, r["doc_id"]) for r in drawn] == sorted(able, key=lambda x: (x[0], x[1], x[2] or 0))[:most]


def test_resampled_without_rows_or_target(spark):
    docs, none = spark.createDataFrame(AWKWARD, DOCS), spark.createDataFrame([], "text string")
    assert resampling.resampled(docs.limit(0), docs).count() == 0
    assert resampling.resampled(docs, none).count() == len(AWKWARD)


def test_drawn_documents_keep_their_columns(spark):
    rows = [(k, f"word{k} " * 30, "en", "s", 1) for k in range(100)]
    docs = spark.createDataFrame(rows, DOCS).withColumnRenamed("lang", "rank")
    out = resampling.drawn_documents(docs, docs.limit(1))
    assert out.columns == docs.columns and out.count() == 5
