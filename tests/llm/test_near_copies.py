import random

import numpy as np
import pytest

from corvox.llm import embed_dedup, near_copies, simhash

from .helpers import components


def shingles(text, words=5):
    own = text.lower().split()
    return {tuple(own[i : i + words]) for i in range(max(1, len(own) - words + 1))}


def similarity(a, b):
    return len(a & b) / len(a | b)


def leaders(texts):
    sets = {i: shingles(t) for i, t in texts.items()}
    links = [(a, b) for a in texts for b in texts if a < b and similarity(sets[a], sets[b]) >= 0.8]
    return set(components(texts, links).values()), links


def planted(draw, words=100):
    """Texts of which many have one to six words changed, so that their similarities lie on both sides of 0.8."""
    vocabulary = ["".join(draw.choice("abcdefghij") for _ in range(draw.randint(2, 7))) for _ in range(2000)]
    texts = {}
    for _ in range(120):
        own = [draw.choice(vocabulary) for _ in range(draw.randint(words // 2, 2 * words))]
        texts[len(texts)] = " ".join(own)
        for _ in range(draw.randint(0, 4)):
            near = list(own)
            for at in draw.sample(range(len(near)), draw.randint(1, 6)):
                near[at] = draw.choice(vocabulary)
            texts[len(texts)] = " ".join(near).upper() if draw.random() < 0.2 else "  ".join(near)
    return texts


@pytest.mark.parametrize("block", [512, 2])
def test_near_copies_against_all_pairs(spark, block):
    draw = random.Random(block)
    texts = planted(draw)
    order = list(texts)
    draw.shuffle(order)
    want, links = leaders(texts)
    assert len(links) > 50
    table = spark.createDataFrame([(i, texts[i]) for i in order], "doc_id long, text string").repartition(3)
    assert {r["doc_id"] for r in simhash.deduplicated(table, block=block).collect()} == want


def test_a_line_repeated_often_joins_no_different_texts(spark):
    draw = random.Random(6)
    word = lambda: "".join(draw.choice("abcdefghij") for _ in range(6))
    line = [word() for _ in range(12)]
    texts = {i: " ".join([word() for _ in range(300)] + line * 200) for i in range(6)}
    prints = [simhash.fingerprint(t) for t in texts.values()]
    assert any((a ^ b).bit_count() <= 4 for a in prints for b in prints[prints.index(a) + 1 :])
    assert max(similarity(shingles(texts[a]), shingles(texts[b])) for a in texts for b in range(a)) < 0.1  # far from copies
    table = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert simhash.deduplicated(table).count() == len(texts)


def test_a_crowded_ball_of_near_copies(spark):
    """A group of near copies far larger than a block, with outliers at all distances: links and groups as by all pairs."""
    draw = np.random.default_rng(4)
    centre = draw.standard_normal(16)
    x = [centre + draw.standard_normal(16) * s for s in draw.choice([0.02, 0.1, 0.2, 0.3, 0.45], 900)] + list(draw.standard_normal((100, 16)))
    x += [x[0], x[0], x[7]]
    x = np.array(x)
    table = spark.createDataFrame(list(enumerate(x.tolist())), "item long, v array<double>")
    out = {r["item"]: r for r in embed_dedup.linked(table, "item", "v", 0.9, 64).collect()}
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    want = components(out, [tuple(p) for p in np.argwhere(near)])
    assert near.sum() > 200_000
    assert [out[i]["n_links"] for i in range(len(x))] == near.sum(axis=1).tolist()
    assert {i: r["component_id"] for i, r in out.items()} == want


def test_crowded_fingerprints(spark):
    draw = random.Random(3)
    centre = draw.getrandbits(64)
    prints = {centre}
    while len(prints) < 1500:
        near = centre
        for b in draw.sample(range(64), draw.choice([1, 2, 2, 3, 4, 6, 9, 14])):
            near ^= 1 << b
        prints.add(near)
    rows = [(i, p - (1 << 64) if p >> 63 else p) for i, p in enumerate(sorted(prints))]
    out = simhash.groups(spark.createDataFrame(rows, "doc_id long, fingerprint long"), "doc_id", block=32).collect()
    own = np.array(sorted(prints), np.uint64)
    near = np.bitwise_count(own[:, None] ^ own[None]) <= 4
    assert {r["doc_id"]: r["component_id"] for r in out} == components(range(len(own)), [tuple(p) for p in np.argwhere(near)])


def plain_votes(hashes, words):
    """The bits of a wide print, one shingle and one bit at a time."""
    sums = [0] * (32 * words)
    mask = (1 << 64) - 1
    for h in hashes:
        for w in range(words):
            x = (h + (w + 1) * 0x9E3779B97F4A7C15) & mask
            x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & mask
            x = (x ^ x >> 27) * 0x94D049BB133111EB & mask
            x ^= x >> 31
            for k in range(4):
                for byte in range(8):
                    sums[k * 8 * words + w * 8 + byte] += 2 * (x >> 8 * byte + 2 * k & 3) - 3
    return [int(n > 0) for n in sums]


@pytest.mark.parametrize("size", [1, 4, 63, 64, 65, 700])
def test_wide_prints(size):
    draw = random.Random(size)
    hashes = [draw.getrandbits(64) for _ in range(size)]
    bits = np.unpackbits(np.frombuffer(near_copies.wide_print(np.array(hashes, np.uint64), 5), np.uint8))
    assert bits.tolist() == plain_votes(hashes, 5)


@pytest.mark.parametrize("rows", [1, 5_000_000])
def test_signatures_leave_out_each_block(rows):
    law = near_copies.law_of(rows)
    draw = np.random.default_rng(law.block)
    bits = draw.integers(0, 2, 32 * law.words, np.uint8)
    spoilt = [bits.copy() for _ in range(law.segments * 3)]
    for n, other in enumerate(spoilt):
        other[n * law.block + n % law.block] ^= 1
    keys = near_copies.signatures(np.packbits([bits, *spoilt], axis=1), law)
    assert len(set(keys[0].tolist())) == law.segments * 3
    for n, other in enumerate(keys[1:]):  # a spoilt block leaves its segment one of three keys, and the other segments all
        assert np.flatnonzero(other != keys[0]).tolist() == [k for k in range(law.segments * 3) if k // 3 == n // 3 and k != n]


def test_few_pairs_at_the_limit_share_no_signature():
    law = near_copies.law_of(1)
    draw = np.random.default_rng(8)
    missed = pairs = 0
    for both, one, other in ((4, 0, 1), (8, 1, 1), (12, 1, 2), (40, 5, 5), (160, 0, 40)):
        for _ in range(600):
            s = draw.integers(0, 1 << 63, both + one + other, np.uint64)
            prints = [near_copies.wide_print(x, law.words) for x in (s[: both + one], np.concatenate([s[:both], s[both + one :]]))]
            a, b = np.array([np.frombuffer(x, np.uint8) for x in prints])
            keys = near_copies.signatures(np.array([a, b]), law)
            near = np.bitwise_count(a[:32] ^ b[:32]).sum() <= law.most(256, near_copies.POSTED_DEVIATIONS)
            missed += not (near and (keys[0] == keys[1]).any())
            pairs += 1
    assert missed <= 8, f"{missed} of {pairs}"


@pytest.mark.parametrize("block", [512, 4])
def test_candidates_come_from_simhash_prints(spark, block):
    """Prints alone, without any text: those that differ in few bits are candidates, random ones aren't."""
    law = near_copies.law_of(1)
    draw = np.random.default_rng(block)
    prints, family = [], []
    for f in range(40):
        centre = draw.integers(0, 2, 32 * law.words, np.uint8)
        for k in range(1 + f % 5 * 3):
            flips = (draw.random(len(centre)) < 0.05).astype(np.uint8) if k else 0  # two of a family differ in about a tenth
            prints.append(np.packbits(centre ^ flips).tobytes())
            family.append(f)
    low = [int.from_bytes(p[:8], "little", signed=True) for p in prints]
    table = spark.createDataFrame(list(zip(low, map(bytearray, prints))), "low long, print binary").repartition(3)
    found = {r["low"]: r["near"] for r in near_copies.candidates(table, law, block).collect()}
    assert set(found) == {x for x, f in zip(low, family) if f % 5}
    for x, f in zip(low, family):
        for y, g in zip(low, family):
            if x in found and y in found:
                assert (found[x] == found[y]) == (f == g)
