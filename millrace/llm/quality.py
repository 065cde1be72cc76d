"""Quality rules: word statistics and tokeniser fertility against bands for each language.

Words are tokenised one by one with a public vocabulary (a worker keeps the results of frequent words), so a text of
any length costs memory for its words only. Measures: characters per token, share of byte-fallback tokens, entropy of
the tokens in bits. A document outside its language's bands is rejected, with the reason.

Nulls and odd input: a null or empty text has no words, measures 0 and fails the base rule; an unknown or null language
has the default bands. Repeated rows are judged alike, every row once.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import WordTable, flatten, map_texts, name, ragged, sums, with_row, worker_held

VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")

# (least, most) characters per token; most byte-fallback share; least token entropy in bits, asked of texts with
# ENTROPY_TOKENS tokens or more. Set apart for each language, beyond what clean prose of it shows at any length: rejects
# should be junk and not style. Languages in other scripts have far fewer characters a token.
BANDS = {
    "en": (1.75, 8.0, 0.10, 5.0),
    "fr": (1.65, 8.0, 0.10, 5.0),
    "de": (1.80, 8.0, 0.10, 5.0),
    "es": (1.60, 8.0, 0.10, 5.0),
    "*": (0.5, 8.0, 0.60, 4.0),
}
ENTROPY_TOKENS = 100
SYMBOLS = b"#*$%&|<>"
MIN_WORDS, MOST_REPEATED = 50, 50

MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_tokens long, n_byte_tokens long, token_entropy double"
)


def fertility(path: str) -> tuple[WordTable, np.ndarray]:
    """Token ids of words and which ids are bytes."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)

    def learn(words: list[str]):
        ids = model.encode(words, num_threads=1)
        return np.fromiter(map(len, ids), np.int64, len(ids)), np.fromiter(chain.from_iterable(ids), np.int32)

    return WordTable(learn, (np.int32,)), np.array([model.IsByte(i) for i in range(model.vocab_size())], np.int64)


def repeated_words(rows: np.ndarray) -> int:
    """Words that stand in a 3-word window found twice or more."""
    if len(rows) < 4:
        return 0
    _, small = np.unique(rows, return_inverse=True)
    n = int(small.max()) + 1
    if n < 1 << 21:
        key = (small[:-2] * n + small[1:-1]) * n + small[2:]
    else:
        _, pair = np.unique(small[:-2] * n + small[1:-1], return_inverse=True)
        key = pair * n + small[2:]
    _, inverse, times = np.unique(key, return_inverse=True, return_counts=True)
    again = np.flatnonzero(times[inverse] > 1)
    covered = np.zeros(len(rows), bool)
    for k in range(3):
        covered[again + k] = True
    return int(covered.sum())


def repeated_lines(text: bytes) -> int:
    seen: set[bytes] = set()
    n = 0
    for line in text.split(b"\n"):
        if line.strip():
            n += line in seen
            seen.add(line)
    return n


def entropy(tokens: np.ndarray) -> float:
    if not len(tokens):
        return 0.0
    _, n = np.unique(tokens, return_counts=True)
    p = n / len(tokens)
    return float(-(p * np.log2(p)).sum()) + 0.0


def _measure(path: str):
    def make():
        table, byte = worker_held(("quality", path), lambda: fertility(path))

        def measure(piece: pa.RecordBatch, texts: list[bytes]):
            words, bounds = flatten(texts)
            rows = table.rows(words)
            length = table.lengths[rows]
            tokens = table.values[0][ragged(table.starts[rows], length)]
            ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(length)])[bounds]
            spans = list(zip(bounds[:-1], bounds[1:]))
            blank = [sum(map(t.count, (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r"))) for t in texts]
            return [
                *(piece.column(c) for c in piece.schema.names if c != "text"),
                bounds[1:] - bounds[:-1],
                [len(t.decode()) - b for t, b in zip(texts, blank)],
                [len(t) - len(t.translate(None, SYMBOLS)) for t in texts],
                list(map(repeated_lines, texts)),
                [repeated_words(rows[a:b]) for a, b in spans],
                ends[1:] - ends[:-1],
                sums(byte[tokens], ends),
                [entropy(tokens[a:b]) for a, b in zip(ends[:-1], ends[1:])],
            ]

        return measure

    return make


def judged(measured: DataFrame, bands: dict[str, tuple] = BANDS) -> DataFrame:
    """Adds base_failed, reason (null: none) and kept to the measures and ``lang``."""
    table = F.create_map(*(x for k, v in bands.items() for x in (F.lit(k), F.array(*(F.lit(float(b)) for b in v)))))
    band = F.coalesce(F.element_at(table, F.col("lang")), F.element_at(table, F.lit("*")))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    fertile = F.col("word_chars") / F.greatest(F.col("n_tokens"), F.lit(1))
    share = F.col("n_byte_tokens") / F.greatest(F.col("n_tokens"), F.lit(1))
    rows = measured.withColumns({"chars_per_token": fertile, "byte_share": share, "base_failed": failed, "band": band})
    dull = (F.col("n_tokens") >= ENTROPY_TOKENS) & (F.col("token_entropy") < F.col("band")[3])
    reason = (
        F.when(F.col("base_failed"), "base")
        .when(F.col("chars_per_token") < F.col("band")[0], "few characters a token")
        .when(F.col("chars_per_token") > F.col("band")[1], "many characters a token")
        .when(F.col("byte_share") > F.col("band")[2], "byte fallback")
        .when(dull, "low entropy")
    )
    return rows.withColumn("reason", reason).withColumn("kept", F.col("reason").isNull()).drop("band")


def quality(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", lang: str = "lang",
    bands: dict[str, tuple] = BANDS, vocabulary: str = VOCABULARY,
) -> DataFrame:
    """One row a document: doc_id, lang, the measures, base_failed, reason, kept. One narrow pass."""
    kinds = dict(docs.dtypes)
    columns = {"doc_id": name(id_column), "lang": name(lang).cast("string")}
    schema = f"doc_id {kinds[id_column]}, lang string, {MEASURES}"
    return judged(map_texts(docs, columns, name(text), _measure(vocabulary), schema), bands)


def keep_good(docs: DataFrame, text: str = "text", lang: str = "lang", **how) -> DataFrame:
    """The documents that pass, with the columns of ``docs``; whole rows go through the same narrow pass."""
    rows = docs.select(F.struct(*map(name, docs.columns)).alias("row"), name(text).alias("text"), name(lang).alias("lang"))
    columns = {"row": F.col("row"), "lang": F.col("lang").cast("string")}
    schema = with_row(rows, f"lang string, {MEASURES}")
    measured = map_texts(rows, columns, F.col("text"), _measure(how.pop("vocabulary", VOCABULARY)), schema)
    return judged(measured, **how).where("kept").select("row.*")
