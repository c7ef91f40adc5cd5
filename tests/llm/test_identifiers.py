"""Personal data: plain identifiers against plain regular expressions, disguised ones by hand."""

import random
import re

import pytest

from corvox.llm import personal_data as P

from .helpers import AWKWARD, DOCS

PLAIN = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def passes(kind, text):
    digits = [int(c) for c in text if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in text.split("."))
    if kind == "card":
        doubled = sum(d if k % 2 == 0 else sum(divmod(2 * d, 10)) for k, d in enumerate(reversed(digits)))
        return 13 <= len(digits) <= 19 and doubled % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def by_hand(text):
    return [(k, *m.span()) for k, p in PLAIN.items() for m in p.finditer(text) if passes(k, m[0])]


def test_plain_identifiers_are_those_of_the_patterns():
    draw = random.Random(3)
    parts = ["a", "b.c", "@", "@x.y", ".", "..", "1", "255", "256.1", "10.0.0.1", "4111 1111 1111 1111", "4242-4242-4242-4242", "+1 (017) 555-7713", "+", " ", "-", "%", "_", "é", "(", ")", "0", "999"]
    for _ in range(4000):
        text = "".join(draw.choice(parts) for _ in range(draw.randrange(14)))
        assert P.spans_of(text)[0] == by_hand(text), text


@pytest.mark.parametrize(
    "text, kind, found",
    [
        ("write john [at] example [dot] com now", "email", "john [at] example [dot] com"),
        ("write john at example dot com please", "email", "john at example dot com"),
        ("john.doe at example.com ok", "email", "john.doe at example.com"),
        ("john (at) site(dot)co(dot)uk", "email", "john (at) site(dot)co(dot)uk"),
        ("jane_doe@mail[.]example[.]net", "email", "jane_doe@mail[.]example[.]net"),
        ("ａlice＠example．org!", "email", "ａlice＠example．org"),
        ("jоhn@exаmple.com", "email", "jоhn@exаmple.com"),
        ("a​b@ex​ample.com", "email", "a​b@ex​ample.com"),
        ("call plus four four two zero seven nine four six zero nine five eight", "phone", "plus four four two zero seven nine four six zero nine five eight"),
        ("+four four 20 7946 oh nine five eight.", "phone", "+four four 20 7946 oh nine five eight"),
        ("tel ＋1 (017) 555-7713", "phone", "＋1 (017) 555-7713"),
        ("card 4１11 1111 1111 1111", "card", "4１11 1111 1111 1111"),
        ("4l11 1111 1111 1111", "card", "4l11 1111 1111 1111"),
        ("four two four two 4242 4242 4242", "card", "four two four two 4242 4242 4242"),
        ("at 192[.]168[.]0[.]1", "ip", "192[.]168[.]0[.]1"),
        ("one nine two dot one six eight dot zero dot one", "ip", "one nine two dot one six eight dot zero dot one"),
        ("192.168.0.1２", "ip", "192.168.0.1２"),
        ("from l92.168.O.1 on", "ip", "l92.168.O.1"),
        ("41l1-1111-1111-111I", "card", "41l1-1111-1111-111I"),
        ("ask john(a)example.com", "email", "john(a)example.com"),
        ("ask john&#64;example&#46;com", "email", "john&#64;example&#46;com"),
        ("mail john dot doe at example dot com", "email", "john dot doe at example dot com"),
        ("host 10 point 0 point 0 point 7", "ip", "10 point 0 point 0 point 7"),
    ],
)
def test_disguises(text, kind, found):
    plain, every = P.spans_of(text)
    assert plain == by_hand(text)
    added = [s for s in every if s not in plain]
    assert [(k, text[a:b]) for k, a, b in added] == [(kind, found)]


@pytest.mark.parametrize(
    "text",
    ["look at example.com", "arrived at the dot com era", "12 @ 3.50 each", "I have one, two, three", "+44 20 7946 0958 one day", "4111 1111 1111 1111 one", "x@y.co dot uk", "Ünïcödé ΟΔΟΣ почта сообщение", "on the dot of nine", "you (at) 10.30", "see (a) example.com", "100% of 10l", "l1 and O2", "версия 1.2.3", "", "one two " * 50],
)
def test_clean_texts_stay(text):
    plain, every = P.spans_of(text)
    assert plain == every == by_hand(text)


def test_long_texts_take_linear_time():
    for text in ("x" * 400_000, "1" * 400_000, "1." * 200_000, "a@" * 100_000, "+1" + " " * 200_000, "one " * 50_000, "о" * 200_000):
        P.spans_of(text)


def test_aligned_offsets_compose():
    a = P.Aligned("abcdef").rewritten([(1, 3, "X")])  # aXdef
    b = a.rewritten([(0, 2, "YY"), (3, 4, "")])  # YYdf
    assert b.text == "YYdf"
    assert [b.start(k) for k in range(4)] == [0, 0, 3, 5] and [b.end(k) for k in range(1, 5)] == [3, 3, 4, 6]


def test_identifiers_over_awkward_rows(spark):
    docs = spark.createDataFrame(AWKWARD, DOCS).withColumnRenamed("source", "spans")
    out = P.identifiers(docs)
    assert out.columns == ["doc_id", "text", "lang", "n_chars", "base_spans", "spans"]
    rows = out.collect()
    assert len(rows) == len(AWKWARD)
    for r in rows:
        assert [tuple(s) for s in r["base_spans"]] == by_hand(r["text"] or "")
    assert P.identifiers(docs.limit(0)).count() == 0
