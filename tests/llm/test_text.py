import hashlib
import random
import zlib

import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from corvox.llm import bpe, simhash, token_counts, token_store
from corvox.llm.common import new_folder

from .helpers import AWKWARD, DOCS, components

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(AWKWARD, DOCS).repartition(3)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_bpe_equals_the_library(docs, library):
    clash = docs.withColumnRenamed("n_chars", "n_tokens").withColumnRenamed("lang", "ids_sha256")
    rows = bpe.round_trip(clash, PATH).collect()
    assert len(rows) == len(AWKWARD)
    for r in rows:
        ids = ids_of(library, r["text"])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_bpe_on_random_letters(library):
    draw = random.Random(5)
    known = bpe.Known(bpe.opened(PATH))
    texts = ["".join(draw.choice("aabcdeé'’s t!1 \ńΣß") for _ in range(draw.randint(0, 60))) for _ in range(400)]
    flat, offsets = known.ids(pa.array(texts))
    for k, t in enumerate(texts):
        assert flat[offsets[k] : offsets[k + 1]].tolist() == ids_of(library, t), t


def test_bpe_forgets_and_learns_again(library, monkeypatch):
    monkeypatch.setattr(bpe.WordBpe, "most_pieces", 1)
    known = bpe.Known(bpe.opened(PATH))
    for t in ("some words here", "other words there", "some words here"):
        assert known.ids(pa.array([t]))[0].tolist() == ids_of(library, t)


def test_decoded_and_empty_table(spark, docs, library):
    back = bpe.decoded(bpe.encoded(docs.select("doc_id", "text"), PATH), PATH).collect()
    for r in back:
        assert r["decoded"] == library.decode(ids_of(library, r["text"]), skip_special_tokens=False)
    assert bpe.round_trip(docs.limit(0), PATH).count() == 0
    assert bpe.decoded(spark.createDataFrame([(None,)], "ids array<int>"), PATH).first()["decoded"] is None


def test_token_store_round_trip(spark, docs, library):
    path = new_folder(spark, "tokens")
    token_store.write_tokens(docs, path, PATH, parts=3)
    stored = token_store.read_tokens(spark, path)
    rows = sorted(token_store.with_starts(token_store.with_checksums(stored)).collect(), key=lambda r: r["start"])
    want = sorted(((i, ids_of(library, t) + [1]) for i, t, *_ in AWKWARD), key=lambda x: (x[0] is not None, x[0] or 0))
    assert [r["item"] for r in rows] == [i for i, _ in want]
    at = 0
    for r in rows:
        assert r["start"] == at
        at += r["n_tokens"]
    sums = {(i, len(t), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in t))) for i, t in want}
    assert {(r["item"], r["n_tokens"], r["ids_crc32"]) for r in rows} == sums
    assert token_store.read_tokens(spark, path, F.col("item") == 8).count() == 1


def test_token_store_empty(spark, docs):
    path = new_folder(spark, "tokens")
    token_store.write_tokens(docs.limit(0), path, PATH)
    assert token_store.with_starts(token_store.with_checksums(token_store.read_tokens(spark, path))).count() == 0


def plain_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints(docs):
    for r in simhash.fingerprints(docs.withColumnRenamed("n_chars", "fingerprint")).collect():
        assert r["fingerprint"] % (1 << 64) == plain_print(r["text"])


def linked(prints):
    return [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 4]


@pytest.mark.parametrize("block", [512, 8])
def test_groups_against_all_pairs(spark, block):
    draw = random.Random(block)
    prints = {}
    for _ in range(12):
        centre = draw.getrandbits(64)
        for _ in range(25):
            near = centre
            for b in draw.sample(range(64), draw.choice([0, 1, 2, 3, 4, 5, 7])):
                near ^= 1 << b
            prints[len(prints)] = near
    rows = [(i, p - (1 << 64) if p >> 63 else p) for i, p in prints.items()]
    out = simhash.groups(spark.createDataFrame(rows, "doc_id long, fingerprint long"), "doc_id", block=block).collect()
    assert {r["doc_id"]: r["component_id"] for r in out} == components(prints, linked(prints))


def test_deduplicated(spark, docs):
    out = simhash.deduplicated(docs)
    assert out.columns == docs.columns
    ids = sorted((r["doc_id"] for r in out.collect() if r["doc_id"] is not None))
    assert ids == [1, 3, 6, 7, 8, 9, 10, 10]  # 2 copies 1, 4 and 5 are as empty as 3, 11 copies 6
    assert out.where("doc_id is null").count() == 1
    assert simhash.deduplicated(docs.limit(0)).count() == 0


def plain_count(model, word):
    best = [(0, 0)] + [None] * len(word)
    for end in range(1, len(word) + 1):
        options = [(best[end - 1][0] + model.unknown, best[end - 1][1] + 1)]
        options += [(best[s][0] + model.costs[word[s:end]], best[s][1] + 1) for s in range(end) if word[s:end] in model.costs]
        best[end] = min(options)
    return best[-1][1]


def test_token_counts_against_plain_programming(docs):
    path = public_tokenizers.path("piece_bpe_32k.model")
    model = token_counts.opened(path)
    rows = token_counts.counted(docs.where("doc_id <> 8 and doc_id <> 9 or doc_id is null").withColumnRenamed("lang", "n_words"), path).collect()
    for r in rows:
        words = (r["text"] or "").split()
        assert (r["n_words"], r["n_tokens"]) == (len(words), sum(plain_count(model, "▁" + w) for w in words))
    long = token_counts.counted(docs.where("doc_id in (8, 9)"), path).collect()
    assert {r["doc_id"]: r["n_words"] for r in long} == {8: 30_000, 9: 1}
    assert token_counts.counted(docs.limit(0), path).count() == 0


def test_token_store_files(spark, docs):
    import glob

    import pyarrow.parquet as pq

    path = new_folder(spark, "tokens")
    token_store.write_tokens(docs, path, PATH, parts=1)
    file = pq.ParquetFile(glob.glob(path.removeprefix("file://") + "/part-*.parquet")[0])
    ids = next(c for c in map(file.metadata.row_group(0).column, range(3)) if c.path_in_schema.startswith("ids"))
    assert "DELTA_BINARY_PACKED" in ids.encodings and ids.has_offset_index
