import hashlib
import math
import re

import duckdb
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from corvox.llm import chat_format, embed_dedup, mixing, permutation_index, queries, rendezvous, toxicity

from .helpers import components
from .test_rows import filled

DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_query_runs_over_its_table(spark, name):
    out = entry.queries()[name](spark, DIR)
    rows = out.collect()
    assert rows
    if name in queries.ORACLES:
        con = duckdb.connect()
        for t in ("documents", "embeddings", "labels", "conversations", "benchmark"):
            con.execute(f"create view {t} as select * from '{DIR}/{t}.parquet'")
        found = con.execute(queries.ORACLES[name])
        names = [c[0] for c in found.description]
        assert sorted(names) == sorted(out.columns)
        told = lambda v: f"{v:.5f}" if isinstance(v, float) else str(v)
        want = sorted([told(r[names.index(c)]) for c in sorted(names)] for r in found.fetchall())
        assert sorted([told(r[c]) for c in sorted(names)] for r in rows) == want


def test_pipeline_stages(spark):
    """Each stage against a plain version, on the documents that the one before it kept."""
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    labels = spark.read.parquet(f"{DIR}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    for stage in stages.values():
        assert stage(spark, docs.limit(0), DIR).count() == 0
    scorer = toxicity.Scorer(toxicity.fit(docs, labels))
    rows = docs.collect()
    want = [r for r in rows if scorer.score(*scorer.evidence(r["text"])[1:]) < 0.5]
    kept = stages["toxicity"](spark, docs, DIR)
    assert kept.columns == docs.columns and sorted(kept.collect(), key=str) == sorted(want, key=str)

    docs = spark.createDataFrame(want, docs.schema)
    sets = {r["doc_id"]: shingles(r["text"]) for r in want}
    links = [(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    leading = set(components(sets, links).values())
    kept = stages["simhash_dedup"](spark, docs, DIR)
    want = [r for r in want if r["doc_id"] in leading]
    assert kept.columns == docs.columns and sorted(kept.collect(), key=str) == sorted(want, key=str)

    docs = spark.createDataFrame(want, docs.schema)
    out = stages["mixing"](spark, docs, DIR)
    taken = mixed_by_hand(want)
    assert out.columns == docs.columns and [r["doc_id"] for r in out.collect()] == taken

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    told = stages["bpe"](spark, docs, DIR).collect()
    assert len(told) == len(want)
    texts = {r["doc_id"]: r["text"] for r in want}
    for r in told:
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def shingles(text):
    own = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(own[i : i + 5]) for i in range(max(1, len(own) - 4))}


def mixed_by_hand(rows):
    """The doc_ids that the mix takes, in training order: sources walked in the order of a hash, round and round."""
    size = {r["doc_id"]: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for r in rows}
    own = {}
    for r in rows:
        own.setdefault(r["source"], []).append(r["doc_id"])
    targets = filled({s: sum(size[i] for i in ids) for s, ids in own.items()})
    out = []
    for k, s in enumerate(sorted(own, key=lambda s: (s is None, (s or "").encode()))):
        tilt, whole, at = (-0.5, 0.5, 0.0)[k % 3], sum(size[i] for i in own[s]), 0
        for lap in range(2):
            for i in sorted(own[s], key=lambda i: hashlib.md5(f"mix:{i}".encode()).hexdigest()):
                middle = at % (whole or 1) + lap * whole + size[i] / 2
                at += size[i]
                if middle < targets[s]:
                    share = middle / targets[s]
                    low, high = 0.0, 1.0
                    for _ in range(60):  # the time by which the source has given that share
                        t = (low + high) / 2
                        low, high = (t, high) if t + tilt * (t - t * t) < share else (low, t)
                    out.append((low, i))
    return [i for _, i in sorted(out)]


def test_pipeline_runs(spark):
    assert corpus_pipeline.run(spark, DIR).count() > 0


CLASHES = ["score", "predicted", "passages", "size", "tilt", "target", "taken", "copies", "positions", "source_size", "shard", "slot", "item", "hash", "cell",
           "__hash", "__item", "__row", "__bucket", "__coarse", "__source", "__position", "fingerprint", "component_id", "c0", "n_tokens"]


def test_stages_and_operators_keep_columns_with_clashing_names(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet").limit(60)
    wide = docs.select("*", *(F.lit(f"mine {c}").alias(c) for c in CLASHES))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, wide, DIR)
        assert out.columns == wide.columns, name
        rows, plain = out.collect(), stage(spark, docs, DIR).collect()
        assert sorted(r["doc_id"] for r in rows) == sorted(r["doc_id"] for r in plain), name
        assert all(r[c] == f"mine {c}" for r in rows for c in CLASHES), name
    replaced = {"mixed": [*mixing.MIXED], "sharded": ["shard", "slot"]}
    for name, out in (("mixed", mixing.mixed(wide)), ("sharded", rendezvous.sharded(wide, "doc_id", 5))):
        rows = out.collect()
        assert len(rows) == 60 and all(r[c] == f"mine {c}" for r in rows for c in CLASHES if c not in replaced[name])
        assert all(r[c] != f"mine {c}" for r in rows for c in replaced[name])
    vectors = spark.read.parquet(f"{DIR}/embeddings.parquet").select("*", *(F.lit(f"mine {c}").alias(c) for c in CLASHES + ["block", "kind", "vector", "n_links"]))
    assert embed_dedup.linked(vectors, "vec_id", "embedding").count() == vectors.count()
    assert permutation_index.search(vectors, F.col("vec_id") == 20, "vec_id", "embedding", 3).count() == 3
    convs = chat_format.conversations(spark.read.parquet(f"{DIR}/conversations.parquet")).withColumns({c: F.lit("mine") for c in ("opening", "__hash", "pair")})
    assert chat_format.paired(convs, 100).agg(F.count("chosen_id") + F.count("rejected_id")).first()[0] == convs.count()


def plain_shard(item, shards):
    """The draws of rendezvous hashing by their definition, in Python: Spark's xxhash64 of the id's text, then of the shard."""
    best = None
    for k in range(shards):
        h = xxhash.xxh64_intdigest(str(item).encode(), 42)
        h = xxhash.xxh64_intdigest(k.to_bytes(4, "little"), h)
        draw = 1.0 / -math.log(((h >> 11) + 0.5) / float(1 << 53))
        best = max(best or (draw, k), (draw, k))
    return best[1]


def test_shards_by_their_definition(spark):
    rows = entry.queries()["op5_sharding"](spark, DIR).collect()
    assert len(rows) >= 100
    for r in rows:
        assert (r["shard"], r["grown_shard"]) == (plain_shard(r["doc_id"], 24), plain_shard(r["doc_id"], 25))
