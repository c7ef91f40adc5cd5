"""Texts that begin with a blank, long runs of marks and tags, and endless entities."""

import pytest

from corvox.operators import cleaning as C
from corvox.operators.filters import TEXT_FILTERS
from corvox.plans.cleaning_queries import BLOCKS, PIPELINE


@pytest.mark.parametrize(("text", "want"), [(" The house", " The house"), ("\n Of it", "\n Of it"), (" [noise] The house", " [noise] The house"), (" so The house", " so the house"), (" so [noise] The house ", " so [noise] the house ")])
def test_capitals_behind_a_blank(text, want):
    assert TEXT_FILTERS["fix_spurious_caps"](function_words=["the", "of"])(text) == want


def test_endless_entities():
    run = TEXT_FILTERS["strip_html"]()
    assert run("a &#" + "1" * 5000 + "; b") == "a � b" and run("&#" + "0" * 5000 + "65;") == "A" and run("&amp;#65;") == "A"


@pytest.mark.parametrize("output", ["base", "events_disfluencies"])
def test_long_runs(spark, output):
    texts = {"commas": "x " + ", " * 20_000 + "y", "first": ", ." * 20_000 + " y", "tags": "x " + "*** " * 4000, "blank": "<b> The house"}
    rows = spark.createDataFrame(list(texts.items()), "k string, text string")
    got = {r["k"]: r["text"] for r in C.cleaned(rows, C.for_output(C.resolved(PIPELINE, BLOCKS), output)).collect()}
    tags = "" if output == "base" else " [laughter]" * 4000
    assert got == {"commas": "x, y.", "first": "Y.", "tags": "x." + tags, "blank": "The house."}
