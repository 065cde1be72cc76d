"""BPE encoding and decoding in numpy: merge rounds over the symbols of many words in one flat array.

Reads a tokeniser file of the public library: special tokens are cut out of the raw text, the rest is put into NFC, its
white space made single spaces, lower-cased character by character, split by the file's pattern (by the library where its
Unicode tables differ), and each word becomes byte symbols, the last with the word-end suffix. A round looks up every neighbouring pair by binary search in the sorted
pair keys and merges, in each word, the pair of lowest rank wherever it stands, from the left. That is what one merge at a
time gives, as no pair with a merged symbol ranks before the merge that makes it (checked when a file is loaded).

Nulls and odd input: a null or empty text has no tokens; its decoded text is empty. Texts are encoded whole, words of any
length too. Repeated rows each give a row.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .text import CACHE_WORDS, map_texts, name, ragged, worker_held

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
_PIECE = 1 << 19  # bytes of text whose words are encoded together (a matter of memory, not of results)
# White space of the library's patterns; Python's own \s has four more control characters.
SPACE = "\\t\\n\\v\\f\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


def byte_symbols() -> list[str]:
    """The printable character of each byte, by the public byte-level rule: printable Latin-1 stands for itself, the rest
    follows from U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    other = [b for b in range(256) if b not in own]
    table = dict(zip(own, map(chr, own))) | {b: chr(256 + i) for i, b in enumerate(other)}
    return [table[b] for b in range(256)]


class Bpe:
    """One tokeniser file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        vocab, self.suffix = model["vocab"], model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = regex.compile("|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True)) or "(?!)")
        from tokenizers import Tokenizer

        # The library normalises and splits only: it gets the file without the vocabulary, which would take it 30 MB a worker.
        bare = spec | {"added_tokens": [], "post_processor": None, "model": model | {"vocab": {}, "merges": []}}
        self.library, self.differing = Tokenizer.from_str(json.dumps(bare)), {}
        splits = [p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"]
        self.word = regex.compile(splits[0].replace(r"\s", SPACE))
        self.space = regex.compile(f"[{SPACE}]+")
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.text = np.full(size, None, object)
        for token, i in [*vocab.items(), *self.special.items()]:
            self.text[i] = token
        symbols = byte_symbols()
        self.plain = np.array([vocab.get(s, -1) for s in symbols], np.int64)
        self.last = np.array([vocab.get(s + self.suffix, -1) for s in symbols], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self._check(left, right, made)
        keys = left << 32 | right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.made = keys[order], order, made

    @staticmethod
    def _check(left: np.ndarray, right: np.ndarray, made: np.ndarray) -> None:
        first = np.full(max(left.max(initial=0), right.max(initial=0), made.max(initial=0)) + 1, -1, np.int64)
        rank = np.arange(len(made))
        np.maximum.at(first, made, rank)  # the last merge that makes a symbol
        if (first[left] >= rank).any() or (first[right] >= rank).any():
            raise ValueError("a merge stands before the merge that makes its symbol")

    def differs(self, char: str) -> bool:
        """Whether this Python's Unicode tables class or lower a character otherwise than the library's (new letters);
        the library itself normalises and splits texts with such characters."""
        known = self.differing.get(char)
        if known is None:
            text = f"a{char}b"
            there = self.library.normalizer.normalize_str(text)
            here = unicodedata.normalize("NFC", text).replace("Σ", "σ")
            here = self.space.sub(" ", here).lower()
            words = [there[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(there)]
            known = self.differing[char] = there != here or words != self.word.findall(here)
        return known

    def words(self, text: str) -> list[str]:
        """Normalised words of a text without special tokens."""
        if not text.isascii():
            if any(self.differs(c) for c in set(text)):
                text = self.library.normalizer.normalize_str(text)
                return [text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)]
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # sigma: no look at its place in the word
        return self.word.findall(self.space.sub(" ", text).lower())

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words end to end, and the number of ids of each."""
        raw = [w.encode() for w in words]
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        data = np.frombuffer(b"".join(raw), np.uint8)
        ids = self.plain[data]
        ends = np.cumsum(size) - 1
        ids[ends] = self.last[data[ends]]
        word = np.repeat(np.arange(len(raw)), size)
        done_ids, done_word = [], []
        none = np.iinfo(np.int64).max
        while len(ids) > 1:
            key = ids[:-1] << 32 | ids[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            rank = np.where((self.keys[at] == key) & (word[:-1] == word[1:]), self.ranks[at], none)
            rank = np.append(rank, none)
            starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            counts = np.diff(np.append(starts, len(word)))
            low = np.repeat(np.minimum.reduceat(rank, starts), counts)
            open_ = low != none
            if not open_.all():  # words without a pair are done: later rounds work on the others alone
                done_ids.append(ids[~open_])
                done_word.append(word[~open_])
                ids, word, rank, low = ids[open_], word[open_], rank[open_], low[open_]
                if not len(ids):
                    break
            hit = rank == low
            # of overlapping hits (a a a) every second one counts, from the left
            run = hit & np.append(False, hit[:-1])
            if run.any():
                place = np.arange(len(hit))
                begin = np.maximum.accumulate(np.where(hit & ~run, place, 0))
                hit &= (place - begin) % 2 == 0
            ids[hit] = self.made[rank[hit]]
            keep = np.append(True, ~hit[:-1])
            ids, word = ids[keep], word[keep]
        ids, word = np.concatenate([*done_ids, ids]), np.concatenate([*done_word, word])
        order = np.argsort(word, kind="stable")
        ids, word = ids[order], word[order]
        known = ids >= 0  # the library drops symbols that are not in its vocabulary
        return ids[known], np.bincount(word[known], minlength=len(raw))


class WordCache(dict):
    """Word -> (number of ids, ids as text, tokens as text); new words of many texts are encoded together."""

    def __init__(self, model: Bpe):
        self.model = model

    def learn(self, words: set[str]) -> None:
        if len(self) > CACHE_WORDS:  # those met again stay
            kept = [(w, self[w]) for w in words if w in self]
            self.clear()
            self.update(kept)
        new = [w for w in words if w not in self]
        if new:
            ids, counts = self.model.encode_words(new)
            decimal, tokens = list(map(str, ids.tolist())), self.model.text[ids].tolist()
            end = 0
            for word, n in zip(new, counts.tolist()):
                self[word] = (n, " ".join(decimal[end : end + n]), " ".join(tokens[end : end + n]))
                end += n


def tokeniser(path: str) -> WordCache:
    return worker_held(("bpe", path), lambda: WordCache(Bpe(path)))


def _split(model: Bpe, text: bytes) -> list[tuple[bool, str]]:
    """Words (False) and special tokens (True) in order."""
    raw = text.decode()
    out, end = [], 0
    for match in model.cut.finditer(raw):
        out += [(False, w) for w in model.words(raw[end : match.start()])] + [(True, match[0])]
        end = match.end()
    return out + [(False, w) for w in model.words(raw[end:])] if out else [(False, w) for w in model.words(raw)]


def decode(ids: list[int], path: str = VOCABULARY) -> str:
    """Tokens joined by single spaces, as the library does for a file without a decoder; special tokens stay."""
    return " ".join(tokeniser(path).model.text[ids])


def encode(docs: DataFrame, id_column: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id and ids (array of int): one narrow pass."""

    def make():
        model = tokeniser(vocabulary).model

        def one_piece(piece: pa.RecordBatch, texts: list[bytes]):
            parts = [_split(model, t) for t in texts]
            index: dict[str, int] = {}
            flat = [w for p in parts for special, w in p if not special]
            for w in flat:
                index.setdefault(w, len(index))
            ids, counts = model.encode_words(list(index))
            starts = np.cumsum(counts) - counts
            out = []
            for p in parts:
                if any(special for special, _ in p):
                    runs = [[model.special[w]] if s else ids[starts[i := index[w]] : starts[i] + counts[i]] for s, w in p]
                    out.append(np.concatenate(runs).tolist())
                else:
                    rows = np.array([index[w] for _, w in p], np.int64)
                    out.append(ids[ragged(starts[rows], counts[rows])].tolist() if len(rows) else [])
            return [piece.column("doc_id"), out]

        return one_piece

    schema = f"doc_id {dict(docs.dtypes)[id_column]}, ids array<int>"
    return map_texts(docs, {"doc_id": name(id_column)}, name(text), make, schema, _PIECE)


def digests(docs: DataFrame, id_column: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encodes and decodes without handing out the ids."""

    def make():
        known = tokeniser(vocabulary)
        model = known.model
        special = {t: (1, str(i), t) for t, i in model.special.items()}

        def one_piece(piece: pa.RecordBatch, texts: list[bytes]):
            raw = [t.decode() for t in texts]
            odd = [model.cut.search(t) is not None for t in raw]
            parts = [[] if o else model.words(t) for t, o in zip(raw, odd)]
            mixed = [_split(model, t) if o else [] for t, o in zip(texts, odd)]
            known.learn({w for p in parts for w in p} | {w for p in mixed for s, w in p if not s})
            n, ids, tokens = [], [], []
            for words, both in zip(parts, mixed):
                found = [special[w] if s else known[w] for s, w in both] if both else [known[w] for w in words]
                found = [f for f in found if f[0]]
                n.append(sum(f[0] for f in found))
                ids.append(hashlib.sha256(" ".join([f[1] for f in found]).encode()).hexdigest())
                tokens.append(hashlib.sha256(" ".join([f[2] for f in found]).encode()).hexdigest())
            return [piece.column("doc_id"), n, ids, tokens]

        return one_piece

    schema = f"doc_id {dict(docs.dtypes)[id_column]}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_texts(docs, {"doc_id": name(id_column)}, name(text), make, schema, _PIECE)
