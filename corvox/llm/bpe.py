"""Byte-level BPE with word ends: batched merge rounds on one flat array of symbols."""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from .common import more_fields

_open: dict[str, "WordBpe"] = {}
_known: dict[tuple, "Known"] = {}


class WordBpe:
    """A tokenizer file of the kind "BPE with word ends; lower case, white space dropped", as numpy arrays.

    encode_words merges the symbols of many words in rounds. In each round, all neighbouring pairs of all words are
    looked up by binary search in the sorted keys of the merges; each word's lowest rank is found, and every
    occurrence of that pair in the word is merged, from the left, those that overlap skipped. Words without a pair
    leave the array, so a round costs what is still unfinished.
    """

    #: A worker forgets the text pieces it knows when it knows this many, and takes texts of so many bytes together:
    #: bounded memory.
    most_pieces, batch_bytes = 500_000, 2_000_000

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.end = spec["model"].get("end_of_word_suffix") or ""
        self.size = max(vocab.values()) + 1
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in merges], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        if self.size**2 < 1 << 32:
            self.keys = self.keys.astype(np.uint32)
        self.made = np.array([vocab[a + b] for a, b in merges], np.int64)
        letters = _byte_letters()
        self.inner = np.array([vocab[c] for c in letters], np.int64)
        self.last = np.array([vocab[c + self.end] for c in letters], np.int64)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = [""] * (max([self.size - 1, *self.special.values()]) + 1)
        for token, i in [*vocab.items(), *self.special.items()]:
            self.tokens[i] = token
        longest_first = sorted(self.special, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if self.special else None
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words = regex.compile(pattern).findall
        self._lines = regex.compile(pattern + r"|\n").findall

    def split(self, text: str | None) -> list[str]:
        """The pre-tokens of a text: special tokens as they stand, else words in lower case after NFC."""
        if not text:
            return []
        if self.cut is None or "<|" not in text:
            return self.words(_normal(text))
        out: list[str] = []
        for i, part in enumerate(self.cut.split(text)):
            out += [part] if i % 2 else self.words(_normal(part))
        return out

    def words_in_lines(self, lines: str) -> list[str]:
        """The pre-tokens of many lines without special tokens, with the line ends between them."""
        return self._lines(_normal(lines))

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets): the ids of words[k], no special tokens, are ids[offsets[k]:offsets[k + 1]]."""
        raw = [w.encode() for w in words]
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        bytes_ = np.frombuffer(b"".join(raw), np.uint8)
        symbols = self.inner[bytes_]
        ends = np.cumsum(size)
        full = size > 0
        symbols[ends[full] - 1] = self.last[bytes_[ends[full] - 1]]
        word = np.repeat(np.arange(len(words)), size)
        done_s, done_w = self._merged(symbols, word)
        order = np.argsort(done_w, kind="stable")
        offsets = np.searchsorted(done_w[order], np.arange(len(words) + 1))
        return done_s[order].astype(np.int32), offsets

    def _rank(self, left: np.ndarray, right: np.ndarray, joined: np.ndarray) -> np.ndarray:
        """The ranks of pairs; a number above all ranks where there is no merge or the two stand in different words."""
        pair = (left * self.size + right).astype(self.keys.dtype)
        at = np.minimum(np.searchsorted(self.keys, pair), len(self.keys) - 1)
        return np.where((self.keys[at] == pair) & joined, self.ranks[at], len(self.keys)).astype(np.int32)

    def _merged(self, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        none = len(self.keys)
        out_s, out_w = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        rank = np.full(len(symbols), none, np.int32)
        if len(symbols):
            rank[:-1] = self._rank(symbols[:-1], symbols[1:], word[1:] == word[:-1])
        while len(symbols):
            new = np.ones(len(word), bool)
            new[1:] = word[1:] != word[:-1]
            start = np.flatnonzero(new)
            low = np.repeat(np.minimum.reduceat(rank, start), np.diff(np.append(start, len(word))))
            idle = low == none
            if idle.any():
                out_s.append(symbols[idle])
                out_w.append(word[idle])
                busy = ~idle
                symbols, word, rank, low = symbols[busy], word[busy], rank[busy], low[busy]
                if not len(symbols):
                    break
            hit = rank == low
            after = hit[1:] & hit[:-1]
            if after.any():  # runs of overlapping hits: every second one counts
                index = np.arange(len(hit))
                first = hit.copy()
                first[1:] &= ~after
                hit &= (index - np.maximum.accumulate(np.where(first, index, 0))) % 2 == 0
            where = np.flatnonzero(hit)
            symbols[where] = self.made[rank[where]]
            keep = np.ones(len(symbols), bool)
            keep[where + 1] = False
            symbols, word, rank = symbols[keep], word[keep], rank[keep]
            where -= np.arange(len(where))  # where the merged symbols stand now
            stale = np.concatenate([where, where[where > 0] - 1])  # only pairs beside a merge have a new rank
            right = np.minimum(stale + 1, len(symbols) - 1)
            rank[stale] = self._rank(symbols[stale], symbols[right], (word[stale] == word[right]) & (right > stale))
        return np.concatenate(out_s), np.concatenate(out_w)

    def decode(self, ids: Iterable[int]) -> str:
        """The tokens of the ids, joined by blanks, special ones included: the file names no decoder."""
        return " ".join([self.tokens[i] for i in ids])


def _byte_letters() -> list[str]:
    """The letter that stands for each byte: printable ones for themselves, the others from U+0100 on, in order."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


def _normal(text: str) -> str:
    """NFC, then lower case letter by letter: a final capital sigma is no exception."""
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


def opened(path: str) -> WordBpe:
    """The tokenizer of a file, read once by each worker."""
    if path not in _open:
        _open[path] = WordBpe(path)
    return _open[path]


class Known:
    """What a worker knows of the text pieces between white space that it has met: their ids, in flat arrays.

    White space ends every pre-token and no composition crosses it, so a piece's ids don't depend on its neighbours.
    Pieces stay in Arrow arrays; only those that are new become strings here. When a worker knows more than
    `most_pieces`, it forgets all but those of the texts at hand.
    """

    def __init__(self, bpe: WordBpe) -> None:
        self.bpe = bpe
        self.digits = np.array([str(i) for i in range(len(bpe.tokens))], object)
        self.shown = np.array(bpe.tokens, object)
        self.pieces = pa.array([], pa.string())
        self.offsets = np.zeros(1, np.int32)  # the ids of pieces[k] are flat[offsets[k]:offsets[k + 1]]
        self.flat = np.zeros(0, np.int32)

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets): the ids of texts[k] are ids[offsets[k]:offsets[k + 1]]; a null text has none."""
        pieces = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        if self.bpe.cut and pc.any(pc.match_substring(texts, "<|")).as_py():  # special tokens may touch anything
            pieces = pa.array([self.bpe.split(t) if t and "<|" in t else own for t, own in zip(texts.to_pylist(), pieces.to_pylist())], pa.list_(pa.string()))
        flat = pieces.flatten()
        coded = pc.if_else(pc.string_is_ascii(flat), pc.ascii_lower(flat), flat).dictionary_encode()
        place = pc.fill_null(pc.index_in(coded.dictionary, value_set=self.pieces), -1).to_numpy().copy()
        missing = np.flatnonzero(place < 0)
        if len(missing):
            if len(self.pieces) + len(missing) > self.bpe.most_pieces:
                met = np.flatnonzero(place >= 0)
                self._keep(place[met])
                place[met] = np.arange(len(met))
            place[missing] = len(self.pieces) + np.arange(len(missing))
            new = coded.dictionary.take(pa.array(missing))
            self._learn(new.to_pylist())
            self.pieces = pa.concat_arrays([self.pieces, new])
        found = self._lists().take(pa.array(place[coded.indices.to_numpy()]))
        pa.default_memory_pool().release_unused()  # workers of other operators share the executor's memory
        return found.values.to_numpy(), found.offsets.to_numpy()[pieces.offsets.to_numpy() - pieces.offsets[0].as_py()]

    def _lists(self) -> pa.ListArray:
        return pa.ListArray.from_arrays(pa.array(self.offsets), pa.array(self.flat))

    def _keep(self, at: np.ndarray) -> None:
        """Forgets all pieces but those at these places."""
        places = pa.array(at)
        left = self._lists().take(places)
        self.pieces, self.offsets, self.flat = self.pieces.take(places), left.offsets.to_numpy(), left.values.to_numpy()

    def _learn(self, new: list[str]) -> None:
        special = self.bpe.special
        lines = self.bpe.words_in_lines("\n".join(["" if x in special else x for x in new]))
        words = dict.fromkeys(lines)
        words.pop("\n", None)
        words = dict(zip(words, range(len(words))))
        order = np.fromiter(map(words.get, lines, repeat(-1)), np.int64, len(lines))
        line = np.cumsum(order < 0)[order >= 0]  # the number of the piece that each word stands in
        index = order[order >= 0]
        ids, offsets = self.bpe.encode_words(list(words))
        size = np.diff(offsets)[index]
        ends = np.concatenate([[0], np.cumsum(size)])
        flat = ids[np.repeat(offsets[:-1][index] - ends[:-1], size) + np.arange(ends[-1])]
        count = np.bincount(line, size, len(new)).astype(np.int64)
        marks = [k for k, x in enumerate(new) if x in special]
        if marks:
            flat = np.insert(flat, np.cumsum(count)[marks], [special[new[k]] for k in marks])
            count[marks] = 1
        self.offsets = np.concatenate([self.offsets, self.offsets[-1] + np.cumsum(count)]).astype(np.int32)
        self.flat = np.concatenate([self.flat, flat]).astype(np.int32)


def known_of(path: str, opener=opened) -> Known:
    """What this worker knows of a tokenizer's pieces; it lasts from task to task."""
    key = (path, opener.__module__)
    if key not in _known:
        _known[key] = Known(opener(path))
    return _known[key]


def batches_of(texts: pa.Array, size: int) -> Iterator[range]:
    """Ranges of texts of about so many bytes."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    first = 0
    while first < len(ends):
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + size)) + 1)
        yield range(first, min(last, len(ends)))
        first = last


def round_trip(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """docs with n_tokens, ids_sha256 and decoded_sha256 of each whole text; columns so named are replaced.

    ids_sha256 is over the decimal ids joined by one blank, decoded_sha256 over the decoded text in UTF-8. A null text
    counts as empty: no tokens, and the digest of nothing. Each row is computed on its own, in batches; nothing is
    shuffled.
    """
    own = ["n_tokens", "ids_sha256", "decoded_sha256"]
    kept = docs.drop(*own)
    schema = more_fields(kept, "n_tokens long, ids_sha256 string, decoded_sha256 string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = known_of(path)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text))
            n, ids, decoded = [], [], []
            for part in batches_of(texts, known.bpe.batch_bytes):
                flat, offsets = known.ids(texts.slice(part.start, len(part)))
                n += np.diff(offsets).tolist()
                for strings, out in ((known.digits, ids), (known.shown, decoded)):
                    told = strings[flat].tolist()
                    cuts = offsets.tolist()
                    out += [hashlib.sha256(" ".join(told[i:j]).encode()).hexdigest() for i, j in zip(cuts, cuts[1:])]
            more = [pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*batch.schema.names, *own])

    return kept.mapInArrow(run, schema)


def encoded(docs: DataFrame, path: str, text: str = "text", out: str = "ids", end: int | None = None, opener=opened) -> DataFrame:
    """docs with `out`, the ids of each whole text as array<int>, with the id `end` after them if one is given.

    A null or empty text has no ids of its own. opener(path) gives the tokenizer.
    """
    kept = docs.drop(out)
    schema = more_fields(kept, f"`{out}` array<int>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = known_of(path, opener)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text))
            for part in batches_of(texts, known.bpe.batch_bytes):
                flat, offsets = known.ids(texts.slice(part.start, len(part)))
                if end is not None:
                    flat = np.insert(flat, offsets[1:], end)
                    offsets = offsets + np.arange(len(offsets))
                piece = batch.slice(part.start, len(part))
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32()))
                yield pa.RecordBatch.from_arrays([*piece.columns, lists], [*batch.schema.names, out])

    return kept.mapInArrow(run, schema)


def decoded(rows: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """rows with `out`, the decoded text of `ids`; null ids decode to null."""
    kept = rows.drop(out)
    schema = more_fields(kept, f"`{out}` string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = opened(path)
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index(ids)).to_pylist()
            texts = pa.array([None if x is None else bpe.decode(x) for x in lists], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], [*batch.schema.names, out])

    return kept.mapInArrow(run, schema)
