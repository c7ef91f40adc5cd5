"""Small inputs and plain versions that the tests compare with."""

from collections import defaultdict

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
AWKWARD = [
    (1, "The quick brown fox jumps over the lazy dog tonight", "en", "a", 1),
    (2, "The quick brown fox jumps over the lazy dog tonight", "en", "a", 1),
    (3, None, "en", "a", None),
    (4, "", None, None, 0),
    (5, " \t\n ", "en", "b", 3),
    (6, "one", "en", "b", 3),
    (7, "Ünïcödé ΟΔΟΣ İx <|endoftext|> it's 'LL 12 ½ 日本語 ​ é", "xx", None, 1),
    (8, "word " * 30_000, "en", "c", 150_000),
    (9, "x" * 20_000, "en", "c", 20_000),
    (10, "\x1c a\x85b aaaaaaa!!!??? don't", "en", "c", 1),
    (10, "a different text under a repeated id", "en", "c", 1),
    (11, "one", "en", "c", 1),
    (11, "one", "en", "c", 1),
    (None, "no id here", "en", "d", 1),
]


def components(nodes, links):
    """The smallest node that each node reaches."""
    up = {n: n for n in nodes}

    def find(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def groups(rows, key):
    out = defaultdict(list)
    for r in rows:
        out[r[key]].append(r)
    return out
