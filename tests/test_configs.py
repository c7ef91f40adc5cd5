import pytest

from corvox.operators import cleaning as C
from corvox.operators import mixture
from corvox.sources import configs

pytest.importorskip("yaml")


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_includes_blocks_and_tables(spark, tmp_path):
    put(tmp_path / "inc/blocks.yaml", "blocks:\n  finish: [normalize_spacing, empty]\n  all: [finish, normalize_spacing]\nseed: 1\n")
    main = put(tmp_path / "main.yaml", """
include: [inc/blocks.yaml]
seed: 2
tag_tables:
  laughs:
    - {pattern: '<l>', tags: [laughter], ignore_case: true}
    - {pattern: '<x>', tags: []}
datasets:
  a: {input: 'a*.jsonl', outputs: [base, events], filters: [{map_tags: {tables: [laughs]}}, all]}
  b: {filters: [events]}
""")  # fmt: skip
    assert configs.with_includes(main)["seed"] == 2
    plans = configs.cleaning_plans(main, ["a"])
    assert list(plans) == ["a"] and plans["a"]["outputs"] == ["base", "events"] and plans["a"]["nocasepunc"] is False
    assert [s.label for s in plans["a"]["steps"]] == ["map_tags", "normalize_spacing", "empty", "normalize_spacing#2"]
    rows = spark.createDataFrame([("ha <L> b<x>c",)], "text string")
    assert C.cleaned(rows, plans["a"]["steps"]).first()["text"] == "ha [laughter] b c"


@pytest.mark.parametrize(
    "text",
    ["datasets: {a: {filter: []}}", "datasets: {a: {outputs: [odd]}}", "datasets: {a: {filters: [odd]}}", "blocks: {events: []}\ndatasets: {a: {}}", "include: [main.yaml]", "blocks: {x: [x]}\ndatasets: {a: {filters: [x]}}"],
)
def test_wrong_configurations(tmp_path, text):
    with pytest.raises(ValueError):
        configs.cleaning_plans(put(tmp_path / "main.yaml", text))
    with pytest.raises(ValueError):
        configs.cleaning_plans(put(tmp_path / "other.yaml", "datasets: {}"), ["a"])


def test_mixture_tree(tmp_path):
    tree = configs.mixture_tree(put(tmp_path / "m.yaml", "input_cfg:\n- type: group\n  weight: 2\n  tags: {task: asr}\n  input_cfg:\n  - {type: multimodal_conversation, manifest_filepath: a, tags: {lang: fr}}\n"))
    assert [(n["kind"], n["task"], n["lang"], n["manifest"]) for n in mixture.flattened_tree(tree)] == [("group", "asr", None, None), ("leaf", "asr", "fr", "a")]
    assert configs.mixture_tree(put(tmp_path / "l.yaml", "- {type: multimodal_conversation, manifest_filepath: b}\n"))[0]["manifest_filepath"] == "b"
    with pytest.raises(ValueError):
        configs.mixture_tree(put(tmp_path / "w.yaml", "- tags: {task: }\n"))
