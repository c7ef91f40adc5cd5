"""Token counts under a unigram model: forward scores along a trie of the distinct pre-tokens."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from .bpe import batches_of
from .common import more_fields

#: What stands before each word, a worker's bound on the words it remembers, and the bytes of texts taken together.
MARK, MOST_WORDS, BATCH_BYTES = "▁", 400_000, 4_000_000


class Unigram:
    """Pieces with integer costs. The best cut of a word has the least cost, and of equal costs the fewest pieces.

    A character that no piece covers is one token of its own, dearer than any piece.
    """

    def __init__(self, costs: dict[str, int]) -> None:
        self.costs = costs
        self.longest = max(map(len, costs), default=1)
        self.unknown = max(costs.values(), default=0) + 10_000_000

    def counts(self, words: list[str]) -> list[int]:
        """The number of pieces of each of the sorted words.

        The words are walked as the depth-first walk of their trie: the path to the present node holds the forward
        state (cost, pieces) of each prefix; a word keeps the states of the prefix it shares with the one before and
        adds a state for each further character. So a shared prefix is computed once, and the state at a word's end is
        its count.
        """
        get, longest, unknown = self.costs.get, self.longest, self.unknown
        path: list[tuple[int, int]] = [(0, 0)]
        before, out = "", []
        for word in words:
            shared = 0
            most = min(len(before), len(word))
            if before[:most] == word[:most]:
                shared = most
            else:
                while before[shared] == word[shared]:
                    shared += 1
            del path[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                cost, n = path[end - 1]
                best = (cost + unknown, n + 1)
                for start in range(max(0, end - longest), end):
                    c = get(word[start:end])
                    if c is not None:
                        cost, n = path[start]
                        if (cost + c, n + 1) < best:
                            best = (cost + c, n + 1)
                path.append(best)
            out.append(path[-1][1])
            before = word
        return out


@lru_cache(maxsize=4)
def opened(path: str) -> Unigram:
    """The pieces of a sentencepiece file in the order of their ids, with costs by Zipf's law: micro-nats of the rank.

    The file is a BPE model, which holds ranks and no probabilities; so the scores are these, not those of a tokenizer
    in use, and words are cut at white space without the file's normalisation. A file of a unigram model would bring
    its own scores: Unigram(costs) takes any.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = [i for i in range(model.get_piece_size()) if not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i) or model.is_unused(i))]
    return Unigram({model.id_to_piece(i): round(1e6 * math.log(rank + 2)) for rank, i in enumerate(plain)})


def counted(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """docs with n_words and n_tokens of each whole text; columns so named are replaced.

    Words stand between white space and are cut with MARK before them. The new distinct words of many texts are sorted
    and counted together; a worker remembers up to MOST_WORDS of them. Nothing is shuffled. A null or empty text has 0
    of both.
    """
    own = ["n_words", "n_tokens"]
    kept = docs.drop(*own)
    schema = more_fields(kept, "n_words long, n_tokens long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = opened(path)
        known: dict[str, int] = {}
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text))
            words_n, tokens_n = [], []
            for part in batches_of(texts, BATCH_BYTES):
                if len(known) > MOST_WORDS:
                    known.clear()
                words = [(t or "").split() for t in texts.slice(part.start, len(part)).to_pylist()]
                new = sorted({w for ws in words for w in ws if w not in known})
                known.update(zip(new, model.counts([MARK + w for w in new])))
                words_n += map(len, words)
                tokens_n += [sum([known[w] for w in ws]) for ws in words]
            more = [pa.array(words_n, pa.int64()), pa.array(tokens_n, pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*batch.schema.names, *own])

    return kept.mapInArrow(run, schema)
