"""YAML files: cleaning configurations with includes, mixture trees."""

from __future__ import annotations

import os
from typing import Any

from ..operators import cleaning as C

try:  # not every installation has it
    import yaml
except ImportError:
    yaml = None

#: What a dataset of a cleaning configuration may say.
DATASET = frozenset({"input", "output", "outputs", "nocasepunc", "filters"})


def loaded(path: str) -> Any:  # noqa: ANN401
    """The content of a YAML file."""
    if yaml is None:
        raise RuntimeError("reading YAML files needs the package yaml")
    with open(path, encoding="utf-8") as f:
        return yaml.safe_load(f)


def with_includes(path: str, open_: tuple[str, ...] = ()) -> dict:
    """A configuration over the files that it includes, by paths relative to it: later files win, the file itself last."""
    path = os.path.abspath(path)
    if path in open_:
        raise ValueError(f"{path} includes itself")
    own = loaded(path) or {}
    below: dict = {}
    for name in own.pop("include", None) or []:
        below |= with_includes(os.path.join(os.path.dirname(path), name), (*open_, path))
    return below | own


def cleaning_plans(path: str, datasets: list[str] | None = None) -> dict[str, dict]:
    """{dataset: input, output, outputs, nocasepunc, steps} of a cleaning configuration; steps are resolved and labelled.

    Unknown keys, outputs, filters, blocks and datasets are errors, and so are blocks named like a filter.
    """
    config = with_includes(path)
    blocks, tables = config.get("blocks") or {}, config.get("tag_tables") or {}
    taken = sorted(set(blocks) & ({*C.COLUMN_FILTERS, *C.TEXT_FILTERS}))
    if taken:
        raise ValueError(f"blocks named like a filter: {taken}")
    known = config.get("datasets") or {}
    missing = sorted(set(datasets or ()) - set(known))
    if missing:
        raise ValueError(f"unknown datasets: {missing}")

    def tagged(step: C.Step) -> C.Step:
        """A map_tags step that names tables gets their rules."""
        if step.name != "map_tags" or "tables" not in step.options:
            return step
        rules = [(("(?i)" if r.get("ignore_case") else "") + r["pattern"], " ".join(f"[{t}]" for t in r.get("tags") or [])) for name in step.options["tables"] for r in tables[name]]
        return C.Step(step.name, {"rules": rules}, step.label)

    plans = {}
    for name, own in known.items():
        if datasets is not None and name not in datasets:
            continue
        unknown = sorted(set(own) - DATASET) or sorted(set(own.get("outputs") or ()) - set(C.OUTPUTS))
        if unknown:
            raise ValueError(f"{name}: unknown {unknown}")
        plans[name] = {
            "input": own.get("input"), "output": own.get("output"), "outputs": own.get("outputs") or ["base"], "nocasepunc": own.get("nocasepunc", False),
            "steps": [tagged(s) for s in C.resolved(own.get("filters") or [], blocks)],
        }
    return plans


def mixture_tree(path: str) -> list[dict]:
    """The nodes of a mixture file: a list, or the list below input_cfg. A tag without a value is an error."""
    content = loaded(path) or []
    nodes = content if isinstance(content, list) else content.get("input_cfg") or []

    def checked(node: dict) -> None:
        empty = sorted(k for k, v in (node.get("tags") or {}).items() if v is None)
        if empty:
            raise ValueError(f"tags without a value: {empty}; a blank must follow the colon")
        for child in node.get("input_cfg") or []:
            checked(child)

    for n in nodes:
        checked(n)
    return nodes
