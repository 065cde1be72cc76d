"""Token counts of a unigram tokeniser without its tokens: Aho-Corasick finds the pieces, a Viterbi pass counts them.

The tokeniser: text is cut into words, each word gets the mark U+2581 in front, and is split into the pieces with the
highest sum of scores. Ties follow the public library: of equal scores the path whose last piece starts earliest wins,
sums are 64-bit floats added from the left. A character that is no piece costs the least score of the vocabulary minus 10
and becomes one token for each byte of its run where the vocabulary has byte pieces, otherwise one token a run.

Nulls and odd input: a null or empty text has no tokens and score 0; repeated rows each give a row; texts and words of
any length are scanned whole, in time linear in their matches.
"""

from __future__ import annotations

import math

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame

from .text import WordTable, flatten, map_texts, name, sums, worker_held

VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")
MARK = "▁"
UNKNOWN_PENALTY = 10.0
MOST_WORDS = 200_000  # a word's result is two numbers, and finding it is slow: more are kept than elsewhere
CONTROLS = 3  # <unk>, <s>, </s>


def zipf_vocabulary(path: str = VOCABULARY) -> list[tuple[str, float]]:
    """The pieces of a public vocabulary, scored by rank as Zipf's law has it: log(1 / (rank * H)). That file is ordered by
    rank but has no probabilities. Control and byte pieces get the least score."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [model.IdToPiece(i) for i in range(model.vocab_size())]
    odd = [i < CONTROLS or model.IsByte(i) for i in range(len(names))]
    n = len(names) - sum(odd)
    total = sum(1 / rank for rank in range(1, n + 1))
    ranks = iter(range(1, n + 1))
    return [(piece, -math.log((n if no else next(ranks)) * total)) for piece, no in zip(names, odd)]


class CountingViterbi:
    """Piece counts and scores of words, for one vocabulary of (piece, score); the first entry is the unknown piece."""

    def __init__(self, vocabulary: list[tuple[str, float]]):
        import ahocorasick

        pieces = dict(reversed(vocabulary))
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces.items():
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.single = {p for p in pieces if len(p) == 1}
        self.unknown = min(score for _, score in vocabulary) - UNKNOWN_PENALTY
        self.bytes = all(f"<0x{b:02X}>" in pieces for b in range(256))

    def count(self, word: str) -> tuple[int, float]:
        """Pieces and score of the best path, carried along position by position; nothing is traced back."""
        score, tokens, loose = [0.0] * (len(word) + 1), [0] * (len(word) + 1), [False] * (len(word) + 1)
        matches = iter(self.automaton.iter(word))
        match = next(matches, None)
        for end, char in enumerate(word, 1):
            best, origin, unknown = -math.inf, end - 1, False
            while match is not None and match[0] == end - 1:  # longest first: the earliest start wins a tie
                length, value = match[1]
                if (value := score[end - length] + value) > best:
                    best, origin = value, end - length
                match = next(matches, None)
            if char not in self.single and (value := score[end - 1] + self.unknown) > best:
                best, origin, unknown = value, end - 1, True
            more = 1 if not unknown else len(char.encode()) if self.bytes else not loose[end - 1]
            score[end], tokens[end], loose[end] = best, tokens[origin] + more, unknown
        return tokens[-1], score[-1]


def zipf_counts(path: str) -> WordTable:
    viterbi = CountingViterbi(zipf_vocabulary(path))

    def learn(words: list[str]):
        found = [viterbi.count(MARK + w) for w in words]
        return np.ones(len(words), np.int64), np.array([t for t, _ in found], np.int64), np.array([s for _, s in found])

    return WordTable(learn, (np.int64, np.float64), MOST_WORDS)


def token_counts(docs: DataFrame, id_column: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, n_words, n_tokens, score (log probability of the best pieces): one narrow pass."""

    def make():
        counts = worker_held(("unigram", vocabulary), lambda: zipf_counts(vocabulary))

        def count(piece: pa.RecordBatch, texts: list[bytes]):
            words, bounds = flatten(texts)
            rows = counts.rows(words)
            tokens, scores = (v[rows] for v in counts.values)
            totals = [math.fsum(scores[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
            return [piece.column("doc_id"), bounds[1:] - bounds[:-1], sums(tokens, bounds), totals]

        return count

    schema = f"doc_id {dict(docs.dtypes)[id_column]}, n_words long, n_tokens long, score double"
    return map_texts(docs, {"doc_id": name(id_column)}, name(text), make, schema)
