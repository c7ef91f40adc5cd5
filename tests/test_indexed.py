import os

import pytest

from corvox.operators import trees
from corvox.sources import indexed as I


def written(path, content):
    with open(path, "wb") as f:
        f.write(content)
    return str(path)


def test_lines_by_number(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(I, "BLOCK", 16)
    lines = ["a", "", "é" * 30, "b\r", "", "c" * 50, "last"]
    plain = written(tmp_path / "plain.jsonl", "\n".join(lines).encode())
    empty = written(tmp_path / "empty.jsonl", b"")
    rows = {r["path"]: r["rows"] for r in I.write_indexes(spark, [plain, empty]).collect()}
    assert rows == {plain: 5, empty: 0} and os.path.getsize(plain + ".idx") == 8 * 6
    want = {k: x.removesuffix("\r") for k, x in enumerate(x for x in lines if x)}
    read = lambda cond="true": {r["row"]: r["line"] for r in I.indexed_lines(spark, plain, 2).where(cond).collect()}
    assert read() == want
    assert read("row = 3") == {3: want[3]} and read("row in (0, 4, 9)") == {0: "a", 4: "last"}
    assert read("row > 1 and row <= 3 and line <> 'b'") == {3: want[3]} | {k: v for k, v in want.items() if k == 2 and v != "b"}
    assert read("row >= 9") == {} and I.indexed_lines(spark, empty).count() == 0


def test_torn_tails_and_ordered_parts(spark, tmp_path):
    files = [written(tmp_path / f"p{k}.txt", c) for k, c in enumerate([b"z\na\ntorn", b"m\n", b"torn", b""])]
    assert [r["cut"] for r in sorted(I.trimmed_tails(spark, files).collect())] == [4, 0, 4, 0]
    assert [open(f, "rb").read() for f in files] == [b"z\na\n", b"m\n", b"", b""]
    assert all(r["cut"] == 0 for r in I.trimmed_tails(spark, files).collect())
    out = f"{tmp_path}/all"
    I.concatenated(spark, [files[1], files[0], files[2]], out)
    parts = sorted(f for f in os.listdir(out) if f.startswith("part-"))
    assert b"".join(open(f"{out}/{f}", "rb").read() for f in parts) == b"m\nz\na\n"
    with pytest.raises(FileExistsError):
        I.concatenated(spark, files, out)
    assert [f for f in os.listdir(tmp_path) if f.startswith("all.")] == []


NODES = "node string, parent string, ordinal long, kind string, weight double, size double"


def test_tree_shares_and_circles(spark):
    rows = [("a", None, 0, "group", 0.5, None), ("b", None, 1, "leaf", None, 4.0), ("c", "a", 0, "leaf", 2.0, 1.0), ("d", "a", 1, "group", 6.0, None), ("e", "d", 0, "leaf", None, 0.0), ("f", "d", 1, "leaf", None, 9.0)]
    got = {r["node"]: round(r["share"], 6) for r in trees.leaf_shares(spark.createDataFrame(rows, NODES)).collect()}
    assert got == {"b": 0.5, "c": 0.125, "e": 0.0, "f": 0.375}
    with pytest.raises(ValueError):
        trees.leaf_shares(spark.createDataFrame([("a", "b", 0, "group", None, None), ("b", "a", 0, "group", None, None)], NODES)).count()


def test_states_must_fit_the_tree(spark):
    nodes = spark.createDataFrame([("x", None, 0, "leaf", None, 10.0), ("y", None, 1, "leaf", None, 10.0)], NODES)
    state = "node string, parent string, ordinal long, kind string, position long, epoch int, shard_id int, num_shards int"
    leaf = lambda n, k: (n, "m", k, "leaf", 3, 2, 1, 4)
    told = trees.states_of_leaves(nodes, spark.createDataFrame([("m", None, 0, "mux", None, None, None, None), leaf("p", 0), leaf("q", 1)], state))
    assert [r["seen"] for r in told.collect()] == [9, 9]
    with pytest.raises(Exception, match="the trees differ"):
        trees.states_of_leaves(nodes, spark.createDataFrame([("m", None, 0, "mux", None, None, None, None), leaf("p", 0)], state)).collect()
