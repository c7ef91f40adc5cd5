"""Hashes of word shingles."""

from __future__ import annotations

import numpy as np
import xxhash

SEED = 42


def words_of(text: str | None) -> list[bytes]:
    """The runs of characters other than the blank and tab to carriage return, A-Z in lower case; a null text has none."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingle_hashes(tokens: list[bytes], words: int) -> np.ndarray:
    """The hashes of `words` neighbouring words joined by a blank, repeats counted; fewer words are one shingle."""
    if not tokens:
        return np.empty(0, "<u8")
    flat = b" ".join(tokens)
    if len(tokens) <= words:
        return np.array([xxhash.xxh64_intdigest(flat, SEED)], "<u8")
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    cuts = zip(starts[: len(tokens) - words + 1].tolist(), ends[words - 1 :].tolist())
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(flat[i:j], SEED) for i, j in cuts), "<u8", len(tokens) - words + 1)
