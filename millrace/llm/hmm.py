"""Hidden Markov language model: Baum-Welch counts summed across partitions, exact likelihoods by scaled forward passes.

Words are lower-cased in A-Z; every text ends with one end token. The model emits every word of the training texts (the end
token among them) or the class of all unseen words, so the probabilities of all words, seen or not, sum to one at most.
Counts and emissions of all words are learnt. Only those of the ``head`` most frequent words go to every task; the rest,
the tail, is dealt to blocks by hash. The model is the same for any ``head``.

A task encodes its texts once to word numbers, some MB of text (a chunk) at a time, written to the shared folder; each round of
training and the scoring read these. A chunk has one message with each block that holds words of its own: it sends the block what
it expects of them, and gets back what all chunks together do. Messages are packed arrays in an order both sides know, so the
rows that are shuffled grow with chunks and blocks, not with words. Texts of like length run through the recursion side by
side, whole, whatever their length.

Nulls and odd input: a null or empty text is the end token alone; a null doc_id counts as empty text in ``held_out``;
repeated rows count and are scored one by one; without training texts every word is unknown and the model uniform.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import drop_staged, stage
from .text import give_back, map_texts, name, pieces, sums

STATES, ROUNDS, HEAD = 8, 4, 131_072  # the head says what is broadcast, not what is learnt
END = b"\n"  # no word holds a line feed
_GROUP = 300_000  # tokens that run through the recursion together (one longer text may be more)
_GATHERED = 50_000  # moves that are added up together
_CHUNK = 8 << 20  # bytes of text that are encoded together (one longer text may be more)
_BLOCK = 200_000  # tail tokens of the training texts whose words make a block
_RANGE = 1024  # head words whose sums are added up together
_UNSEEN, _TOTALS = -1, -1  # a chunk's word that no training text has; the message of moves, starts and all emissions

# Shuffled and stored numbers of a word's states: logarithms to base 2 of 21 bits, three in a long, right to some 0.001 %.
_BITS, _PER, _STEP = 21, 3, float(1 << 15)
_MASK = (1 << _BITS) - 1
_SUMS, _SHARES = -32, -63  # the least power of two that is kept, of expected counts and of probabilities; less is 0


@dataclass
class Hmm:
    """start (K), move (K, K), emit (words, K): probabilities; of the words, the head and last the class of unseen words."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray


class Lockstep:
    """Texts side by side, longest first; tokens are laid out by position, so that each step is one slice."""

    def __init__(self, ids: np.ndarray, bounds: np.ndarray):
        length = np.diff(bounds)
        self.order = np.argsort(-length, kind="stable")
        size = length[self.order]
        at = np.arange(size[0]) if len(size) else np.zeros(0, np.int64)
        active = np.searchsorted(-size, -at, "left")  # texts longer than the position
        self.offset = np.concatenate([np.zeros(1, np.int64), np.cumsum(active)])
        step = np.repeat(at, active)
        self.rank = np.arange(len(step)) - self.offset[step]
        self.words = ids[bounds[:-1][self.order][self.rank] + step]
        later = np.flatnonzero(step)
        self.after, self.before = later, self.offset[step[later] - 1] + self.rank[later]
        self.texts = len(size)

    def forward(self, model: Hmm, keep: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scaled forward values, the emissions they used, and the scale of each token (its conditional probability)."""
        emit = model.emit[self.words]
        alpha = np.empty_like(emit) if keep else emit
        scale = np.empty(len(emit), emit.dtype)
        ones = np.ones(emit.shape[1], emit.dtype)
        now = None
        for a, b in zip(self.offset[:-1].tolist(), self.offset[1:].tolist()):
            now = (model.start if now is None else now[: b - a] @ model.move) * emit[a:b]
            total = now @ ones
            now /= total[:, None]
            scale[a:b] = total
            if keep:
                alpha[a:b] = now
        return alpha, emit, scale

    def log10(self, model: Hmm) -> np.ndarray:
        """Log probability of each text, in the order given."""
        scale = self.forward(model, keep=False)[2]
        out = np.empty(self.texts)
        out[self.order] = np.bincount(self.rank, np.log10(scale), self.texts)
        return out

    def expected(self, model: Hmm) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Expected starts, moves and emissions."""
        alpha, emit, scale = self.forward(model)
        beta = np.ones_like(alpha)
        emit /= scale[:, None]
        back = model.move.T
        bounds = self.offset.tolist()
        for t in range(len(bounds) - 3, -1, -1):
            a, b, c = bounds[t], bounds[t + 1], bounds[t + 2]
            beta[a : a + c - b] = (emit[b:c] * beta[b:c]) @ back
        emit *= beta
        move = np.zeros_like(model.move)
        for a in range(0, len(self.after), _GATHERED):
            move += alpha[self.before[a : a + _GATHERED]].T @ emit[self.after[a : a + _GATHERED]]
        move *= model.move
        alpha *= beta
        del emit, beta
        start = alpha[: bounds[1]].sum(0) if len(bounds) > 1 else np.zeros(len(model.start))
        words = len(model.emit)
        emitted = np.empty((words, alpha.shape[1]))
        for k in range(alpha.shape[1]):
            emitted[:, k] = np.bincount(self.words, alpha[:, k], words)
        return start, move, emitted


def _longs(states: int) -> list[str]:
    return [f"p{j}" for j in range(-(-states // _PER))]


def packed(table: np.ndarray, least: int) -> list[np.ndarray]:
    """A row of states as longs; values are rounded down."""
    with np.errstate(divide="ignore"):
        q = np.floor((np.log2(table) - least) * _STEP) + 1
    q = np.clip(q, 0, _MASK).astype(np.int64)
    return [sum(q[:, k] << _BITS * (k % _PER) for k in range(j, min(j + _PER, q.shape[1]))) for j in range(0, q.shape[1], _PER)]


def unpacked(longs: list[np.ndarray], states: int, least: int, add: float = 0.0) -> np.ndarray:
    """``add`` steps more: half a step where rounding down would add up."""
    q = np.stack([longs[k // _PER] >> _BITS * (k % _PER) & _MASK for k in range(states)], 1)
    return np.where(q > 0, np.exp2((q - 1 + add) / _STEP + least), 0.0)


def _packed(values: list[Column], least: int) -> list[Column]:
    """The same in Spark."""
    q = [
        F.least(F.greatest(F.coalesce(F.floor((F.log2(v) - least) * _STEP) + 1, F.lit(0)), F.lit(0)), F.lit(_MASK)).cast("long")
        for v in values
    ]
    groups = [q[j : j + _PER] for j in range(0, len(q), _PER)]
    return [sum((F.shiftleft(v, _BITS * k) for k, v in enumerate(g[1:], 1)), g[0]).alias(f"p{j}") for j, g in enumerate(groups)]


def _unpacked(states: int, least: int, add: float = 0.0) -> list[Column]:
    q = [F.shiftrightunsigned(F.col(f"p{k // _PER}"), _BITS * (k % _PER)).bitwiseAND(F.lit(_MASK).cast("long")) for k in range(states)]
    return [F.when(v > 0, F.exp((v - 1 + add) * float(np.log(2) / _STEP) + float(np.log(2) * least))).otherwise(0.0) for v in q]


def shrunk(ids: np.ndarray) -> bytes:
    """Word numbers of a text: how many, then their lowest bytes, the next ones and so on, compressed."""
    planes = np.ascontiguousarray(ids.astype("<i4").view(np.uint8).reshape(-1, 4).T)
    return len(ids).to_bytes(4, "little") + pa.compress(planes.tobytes(), "zstd", asbytes=True)


def numbers(ids: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of all rows end to end, and the bounds of each row."""
    texts, bounds = [np.zeros(0, np.int32)], np.zeros(len(ids) + 1, np.int64)
    for i, text in enumerate(ids):
        raw = memoryview(text.as_buffer())
        n = int.from_bytes(raw[:4], "little")
        planes = np.frombuffer(pa.decompress(raw[4:], 4 * n, "zstd", asbytes=True), np.uint8).reshape(4, n)
        texts.append(np.ascontiguousarray(planes.T).view("<i4").ravel())
        bounds[i + 1] = bounds[i] + n
    return np.concatenate(texts), bounds


def _groups(flat: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[np.ndarray, Lockstep]]:
    """Rows of like length, about _GROUP tokens together."""
    length = np.diff(bounds)
    order = np.argsort(length, kind="stable")
    total = np.cumsum(length[order])
    start = 0
    while start < len(order):
        before = total[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(total, before + _GROUP, "right")))
        rows = order[start:end]
        own = np.concatenate([flat[bounds[r] : bounds[r + 1]] for r in rows])
        yield rows, Lockstep(own, np.concatenate([np.zeros(1, np.int64), np.cumsum(length[rows])]))
        start = end


def tokens(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Words of all texts end to end, lower-cased in A-Z, as numbers in a list of these words, and the words of each text."""
    found = pc.ascii_split_whitespace(pc.ascii_lower(texts.view(pa.string())))  # byte by byte, whatever the bytes are
    words = found.flatten()
    full = np.asarray(pc.binary_length(words)) > 0  # white space at an end gives an empty word
    bounds = np.concatenate([np.zeros(1, np.int64), np.cumsum(np.asarray(pc.list_value_length(found)), dtype=np.int64)])
    coded = words.filter(pa.array(full)).dictionary_encode()
    return np.asarray(coded.indices), coded.dictionary.view(pa.binary()), sums(full.astype(np.int64), bounds)


def word_counts(docs: DataFrame, text: Column) -> DataFrame:
    """(word, c) over all texts, one end token each; counted in each task, some texts at a time, before the shuffle."""

    def count(batches):
        for batch in batches:
            for piece in pieces(batch, "text", _CHUNK):
                flat, words, _ = tokens(piece.column("text"))
                n = np.append(np.bincount(flat, minlength=len(words)), piece.num_rows)
                words = pa.concat_arrays([words, pa.array([END], pa.binary())])
                yield pa.RecordBatch.from_arrays([words, pa.array(n, pa.int64())], ["word", "n"])
        give_back()

    texts = docs.select(F.coalesce(text, F.lit("")).cast("binary").alias("text"))
    return texts.mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("c"))


def _encode(head, blocks: int, columns: list[str]):
    """A chunk of texts -> at most two rows, of those to learn from and of the others: word numbers, beyond the head and the
    unseen class those of the chunk's own words, and these words by block. ``head`` is a broadcast."""

    def make():
        number = {w: i for i, w in enumerate(head.value)}
        first = len(number) + 1  # behind the unseen class

        def chunk(texts: pa.Array) -> list:
            codes, words, size = tokens(texts)
            words = words.to_pylist()
            of = np.fromiter((number.get(w, -1) for w in words), np.int32, len(words))
            rare = np.flatnonzero(of < 0)
            of[rare] = first + np.arange(len(rare))
            own = [words[i] for i in rare.tolist()]
            del words
            flat = np.full(len(codes) + len(size), number[END], np.int32)
            flat[np.arange(len(codes)) + np.repeat(np.arange(len(size)), size)] = of[codes]
            sent = [b""] * blocks
            if blocks and own:
                block = np.fromiter(map(crc32, own), np.int64, len(own)) % blocks
                order = np.argsort(block, kind="stable")
                place = np.empty(first + len(own), np.int32)
                place[:first] = np.arange(first)
                place[first + order] = first + np.arange(len(own))
                flat = place[flat]
                cuts = np.searchsorted(block[order], np.arange(blocks + 1)).tolist()
                order = order.tolist()
                sent = [
                    pa.compress(END.join([own[i] for i in order[a:b]]), "zstd", asbytes=True) + (b - a).to_bytes(4, "little")
                    + sum(len(own[i]) + 1 for i in order[a:b]).to_bytes(8, "little") if b > a else b""
                    for a, b in zip(cuts, cuts[1:])
                ]
            return [shrunk(flat), shrunk(size + 1), sent]

        def encode(piece: pa.RecordBatch, _: list[bytes]):
            learn = np.array([x is True for x in piece.column("learn").to_pylist()])
            made = []
            for which in (True, False):
                rows = np.flatnonzero(learn == which)
                if len(rows):
                    key = 2 * piece.column("rid")[int(rows[0])].as_py() + bool(which)
                    made.append((key, which, *(piece.column(c).take(pa.array(rows)) for c in columns), *chunk(piece.column("text").take(pa.array(rows)))))
            lists = [_lists([m[2 + k] for m in made]) for k in range(len(columns))]
            rest = [[m[k] for m in made] for k in (0, 1, *range(2 + len(columns), 5 + len(columns)))]
            return [rest[0], rest[1], *lists, *rest[2:]]

        return encode

    return make


def _lists(columns: list[pa.Array]) -> pa.ListArray:
    """One row for each array."""
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, columns)]), pa.int32()), pa.concat_arrays(columns))


def _words(sent: bytes) -> list[bytes]:
    """Words of a message of ``_encode``."""
    size = int.from_bytes(sent[-8:], "little") - 1
    return pa.decompress(sent[:-12], size, "zstd", asbytes=True).split(END)


def shortened(table: np.ndarray) -> bytes:
    """Numbers from 0 on as 32-bit floats without their last byte, right to some 0.0015 %: all lowest bytes, the next ones, the
    highest ones."""
    bits = np.ascontiguousarray(table, "<f4").view(np.uint32).ravel() + np.uint32(0x80)
    return np.ascontiguousarray(bits.view(np.uint8).reshape(-1, 4)[:, 1:].T).tobytes()


def lengthened(rows: list[bytes], states: int) -> np.ndarray:
    """What ``shortened`` made of some tables, end to end."""
    bits = np.zeros((sum(map(len, rows)) // 3, 4), np.uint8)
    a = 0
    for row in rows:
        n = len(row) // 3
        bits[a : a + n, 1:] = np.frombuffer(row, np.uint8).reshape(3, n).T
        a += n
    return bits.view("<f4").reshape(-1, states)


_MESSAGE = "q long, chunk long, at binary, sums binary"


def _messages(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[]] * 4
    types = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], ["q", "chunk", "at", "sums"])


def _first(states: int, everyone: bool):
    """The words of a block and the messages of the chunks -> for each of these where its words are in the block, their counts
    and, to learn from or for ``everyone``, first emissions; and the sum of the block's emissions (chunk -1)."""
    names = ["chunk", "q", "at", "c", "sums"]

    def first(sent: pa.Table, words: pa.Table) -> pa.Table:
        place = {w: i for i, w in enumerate(words.column("word").to_pylist())}
        count = words.column("c").to_numpy()
        emit = unpacked([words.column(p).to_numpy() for p in _longs(states)], states, _SHARES, 0.5)
        q = (sent if len(sent) else words).column("q")[0].as_py()
        made = [(-1, q, None, None, emit.sum(0).tobytes())]
        emit = emit.astype(np.float32)
        for chunk, learn, message in zip(*(sent.column(c).to_pylist() for c in ("chunk", "learn", "words"))):
            own = _words(message)
            at = np.fromiter((place.get(w, _UNSEEN) for w in own), np.int32, len(own))
            known = at[at != _UNSEEN]
            c = np.zeros(len(at), np.int64)
            c[at != _UNSEEN] = count[known]
            made.append((chunk, q, shrunk(at), shrunk(c), shortened(emit[known]) if learn or everyone else None))
        del place, emit
        give_back()
        types = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
        return pa.table([pa.array(list(x), t) for x, t in zip(zip(*made), types)], names)

    return first


@dataclass
class Sent:
    """What goes to every task: the model of the head and the class of unseen words; the weight of each state over all words,
    and whether messages hold expected counts (before the first round: emissions that are not shares yet)."""

    model: Hmm
    weight: np.ndarray
    learnt: bool
    every: int

    def emissions(self, values: np.ndarray, c: np.ndarray) -> np.ndarray:
        """Every state keeps a little of the corpus' word shares, so that nothing is impossible."""
        if not self.learnt:
            return values / self.weight
        share = (c + 1) / self.every
        return (values + (0.001 * self.weight + 1e-9) * share[:, None]) / (1.001 * self.weight + 1e-9)


def _chunks(batches: Iterable[pa.RecordBatch], sent: Sent, columns: list[str]) -> Iterator[tuple]:
    """Of each chunk the values of ``columns``, its word numbers, the bounds of its texts, the model with the rows of its own
    words, where these are in their blocks, the bounds of the blocks and the counts of the words. The row of a chunk comes
    first (q -1), its messages follow in their order."""
    head, states = len(sent.model.emit), len(sent.model.start)

    def whole(row: pa.RecordBatch, sums: list[bytes]) -> tuple:
        flat = numbers(row.column("ids"))[0]
        bounds = np.concatenate([np.zeros(1, np.int64), np.cumsum(numbers(row.column("sizes"))[0], dtype=np.int64)])
        at, blocks = numbers(row.column("at")[0].values)
        c = numbers(row.column("c")[0].values)[0].astype(np.int64)
        own = sent.model
        if len(at):
            seen = at != _UNSEEN
            emit = np.empty((head + len(at), states), own.emit.dtype)
            emit[:head], emit[head:] = own.emit, own.emit[-1]
            emit[head:][seen] = sent.emissions(lengthened(sums, states), c[seen])
            own = Hmm(own.start, own.move, emit)
        else:  # all words of the training texts are in the head
            flat = np.minimum(flat, np.int32(head - 1))
        return [row.column(x)[0] for x in columns], flat, bounds, own, at, blocks, c

    row, sums = None, []
    for batch in batches:
        for i, q in enumerate(batch.column("q").to_pylist()):
            if q >= 0:
                sums.append(batch.column("sums")[i].as_py())
                continue
            if row is not None:
                yield whole(row, sums)
            row, sums = batch.slice(i, 1), []
    if row is not None:
        yield whole(row, sums)


def _expect(sent, states: int, tails: bool):
    """Messages to the blocks: the expected counts of each chunk's own words, and of a task's head words, by ranges of these
    (q below -1). With a tail, whose counts are sent in 24 bits, the recursion has 32."""

    def expect(batches):
        value: Sent = sent.value
        model = Hmm(*(x.astype(np.float32 if tails else np.float64) for x in (value.model.start, value.model.move, value.model.emit)))
        value = Sent(model, value.weight, value.learnt, value.every)
        head = len(model.emit)
        totals, emitted = np.zeros((states + 2, states)), np.zeros((head, states))
        for (chunk,), flat, bounds, own, at, blocks, _ in _chunks(batches, value, ["chunk"]):
            tail = np.zeros((len(own.emit) - head, states))
            for _, group in _groups(flat, bounds):
                start, move, more = group.expected(own)
                totals += np.concatenate([move, start[None], more.sum(0)[None]])
                emitted += more[:head]
                tail += more[head:]
            rows = []
            for q, (a, b) in enumerate(zip(blocks.tolist(), blocks[1:].tolist())):
                seen = at[a:b] != _UNSEEN
                if seen.any():
                    rows.append((q, chunk.as_py(), shrunk(at[a:b][seen]), shortened(tail[a:b][seen])))
            del flat, own, tail, group, more
            yield _messages(rows)
        if totals.any():
            rows = [(_TOTALS, -1, None, totals.tobytes())]
            for k, a in enumerate(range(0, head, _RANGE)):
                at = np.flatnonzero(emitted[a : a + _RANGE].sum(1))
                if len(at):
                    rows.append((_TOTALS - 1 - k, -1, shrunk(at), emitted[a + at].astype("<f4").tobytes()))
            yield _messages(rows)
        give_back()

    return expect


def _add(states: int):
    """The messages to a block -> the answers: to each chunk the sums of its own words, in its order; one row for a range of
    the head or the totals."""

    def add(sent: pa.Table) -> pa.Table:
        q = sent.column("q")[0].as_py()
        sums = sent.column("sums").to_pylist()
        if q == _TOTALS:
            return pa.Table.from_batches([_messages([(q, -1, None, sum(np.frombuffer(x) for x in sums).tobytes())])])
        ats = [numbers(pa.array([x], pa.binary()))[0] for x in sent.column("at").to_pylist()]
        if q < _TOTALS:
            table = np.zeros((_RANGE, states))
            for at, x in zip(ats, sums):
                table[at] += np.frombuffer(x, "<f4").reshape(-1, states)
            return pa.Table.from_batches([_messages([(q, -1, None, table.tobytes())])])
        ats = [x[x != _UNSEEN] for x in ats]
        at = np.concatenate([x for x, y in zip(ats, sums) if y is not None] or [np.zeros(0, np.int32)])
        values = lengthened([x for x in sums if x is not None], states)
        size = max((int(x.max()) + 1 for x in ats if len(x)), default=0)
        table = np.stack([np.bincount(at, values[:, k], size) for k in range(states)], 1)
        made = [(q, c, None, shortened(table[x])) for c, x in zip(sent.column("chunk").to_pylist(), ats)]
        del values, table
        give_back()
        return pa.Table.from_batches([_messages(made)])

    return add


def _noise(states: int, seed: int = 1) -> list[Column]:
    """A normal number for each state, drawn by the word: two uniform ones by hash, then Box and Muller."""
    draw = lambda k, what: (F.pmod(F.xxhash64(F.lit(seed), F.lit(what), F.lit(k), "word"), F.lit(2**40)) + 0.5) / float(2**40)
    return [F.sqrt(-2 * F.log(draw(k, "a"))) * F.cos(2 * np.pi * draw(k, "b")) for k in range(states)]


def _met(texts: DataFrame, down: DataFrame | None) -> DataFrame:
    """Chunks, each followed by the messages that its blocks have for it, in the order of these."""
    rows = texts.withColumns({"q": F.lit(-1).cast("long"), "sums": F.lit(None).cast("binary")})
    if down is None:
        return rows
    sent = down.where("chunk >= 0 AND sums IS NOT NULL").select("chunk", "q", "sums")
    return rows.unionByName(sent, allowMissingColumns=True).repartition("chunk").sortWithinPartitions("chunk", "q")


def train(
    texts: DataFrame, down: DataFrame | None, top: np.ndarray, noise: np.ndarray, every: int, rounds: int = ROUNDS
) -> tuple[Sent, DataFrame | None]:
    """Baum-Welch over the chunks to learn from: what tasks need to know, and the messages of the last round, which go to all
    chunks. ``top`` and ``noise`` are for the head and the class of unseen words. The driver sees the summed head: at most
    len(top) + states + 2 rows of numbers, packed."""
    states = noise.shape[1]
    share = (top + 1) / every
    emit = share[:, None] * np.exp(noise)
    weight = emit.sum(0)
    if down is not None:
        weight = weight + sum(np.frombuffer(r.sums) for r in down.where("chunk < 0").collect())
    move = np.full((states, states), 0.1 / max(1, states - 1))
    np.fill_diagonal(move, 0.9 if states > 1 else 1.0)
    now = Sent(Hmm(np.full(states, 1 / states), move, emit / weight), weight, False, every)

    context = texts.sparkSession.sparkContext
    columns = ["chunk", "ids", "sizes", "at", "c"]
    blocks = down is not None
    others = texts.where("NOT learn").select("chunk", F.posexplode("at").alias("q", "at"))
    others = others.select(F.col("q").cast("long").alias("q"), "chunk", "at", F.lit(None).cast("binary").alias("sums"))
    for k in range(rounds):
        sent = context.broadcast(now)
        parts = _met(texts.where("learn").select(*columns), down).mapInArrow(_expect(sent, states, blocks), _MESSAGE)
        if blocks and k == rounds - 1:
            parts = parts.unionByName(others)
        summed = stage(parts.groupBy("q").applyInArrow(_add(states), _MESSAGE), "summed")
        if down is not None:
            drop_staged(down)
        down = summed if blocks else None
        rows = {r.q: r for r in summed.where("q < 0").collect()}
        if not blocks:
            drop_staged(summed)
        sent.destroy()
        if _TOTALS not in rows:  # nothing to learn from
            continue
        totals = np.frombuffer(rows.pop(_TOTALS).sums).reshape(states + 2, states)
        emit = np.zeros((len(top), states))
        for q, r in rows.items():
            a = (_TOTALS - 1 - q) * _RANGE
            emit[a : a + _RANGE] = np.frombuffer(r.sums).reshape(-1, states)[: len(emit) - a]
        start, move = totals[states], totals[:states]
        now = Sent(
            Hmm((start + 1) / (start + 1).sum(), (move + 1) / (move + 1).sum(1, keepdims=True), emit),
            totals[states + 1], True, every,
        )
        now.model.emit = now.emissions(emit, top)
    return now, down


def _score(sent, head_logs, columns: list[str]):
    def score(batches):
        logs, known = head_logs.value
        for row, flat, bounds, own, at, _, c in _chunks(batches, sent.value, columns):
            log = np.zeros(len(bounds) - 1)
            for rows, group in _groups(flat, bounds):
                log[rows] = group.log10(own)
            total = lambda head, tail: sums(np.concatenate([head, tail])[flat], bounds)
            made = [
                np.diff(bounds), total(known, (at != _UNSEEN).astype(np.int64)),
                total(logs, np.log10((c + 1) / sent.value.every)), log,
            ]
            yield pa.RecordBatch.from_arrays(
                [*(x.values for x in row), *map(pa.array, made)],
                [*columns, "n_tokens", "n_known", "base_score", "score"],
            )
        give_back()

    return score


def held_out(doc_id: Column, parts: int = 7, part: int = 2) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts == part


def score(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", aside: Column | None = None,
    states: int = STATES, rounds: int = ROUNDS, head: int = HEAD,
) -> DataFrame:
    """One row a document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10 of its probability).

    Learns from the rows where ``aside`` (as ``held_out``) is false.
    """
    spark = docs.sparkSession
    aside = held_out(name(id_column)) if aside is None else aside
    counts = stage(word_counts(docs.where(~aside), name(text)), "counts")
    tokens, kinds = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    first = F.col("word") != F.lit(END), F.desc("c"), F.col("word")
    top = counts.orderBy(*first).limit(head).select("word", "c", F.array(*_noise(states)).alias("z")).collect()  # a fixed number
    noise = np.array([*(r["z"] for r in top), *([[0.0] * states] * (1 if top else 2))])
    top = [(bytes(r["word"]), r["c"]) for r in top] or [(END, 0)]
    in_head = np.array([c for _, c in top], np.int64)
    every = tokens + kinds + 1

    blocks = -(-(tokens - int(in_head.sum())) // _BLOCK) if kinds > len(top) else 0
    sent = spark.sparkContext.broadcast([w for w, _ in top])
    of_id, kept = dict(docs.dtypes)[id_column], ["doc_id", "held_out"]
    columns = {"rid": F.monotonically_increasing_id(), "learn": ~aside, "doc_id": name(id_column), "held_out": aside}
    schema = (
        f"chunk long, learn boolean, doc_id array<{of_id}>, held_out array<boolean>, ids binary, sizes binary, "
        "words array<binary>"
    )
    texts = stage(map_texts(docs, columns, name(text), _encode(sent, blocks, kept), schema, _CHUNK), "encoded")
    sent.destroy()
    down, no = None, F.array().cast("array<binary>")
    if blocks:
        heads = spark.createDataFrame(top, "word binary, c long").select("word")
        shaken = [(F.col("c") + 1) / float(every) * F.exp(z) for z in _noise(states)]
        words = counts.join(F.broadcast(heads), "word", "left_anti").select(
            (F.crc32("word") % blocks).alias("q"), "word", "c", *_packed(shaken, _SHARES)
        )
        asked = texts.select("chunk", "learn", F.posexplode("words").alias("q", "words")).where(F.length("words") > 0)
        asked = asked.withColumn("q", F.col("q").cast("long"))
        links = asked.groupBy("q").cogroup(words.groupBy("q")).applyInArrow(
            _first(states, rounds == 0), "chunk long, q long, at binary, c binary, sums binary"
        )
        links = stage(links, "links")
        lists = links.where("chunk >= 0").groupBy("chunk").agg(
            F.map_from_entries(F.collect_list(F.struct("q", F.struct("at", "c")))).alias("m")
        )
        # a block that a chunk has no words of is an empty list of numbers
        empty = F.lit(shrunk(np.zeros(0, np.int32)))
        every_block = F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))
        of_block = lambda c: F.transform(every_block, lambda q: F.coalesce(F.col("m")[q][c], empty))
        encoded = texts
        texts = encoded.drop("words").join(lists, "chunk", "left")
        texts = texts.withColumns({c: F.coalesce(F.when(F.col("m").isNotNull(), of_block(c)), no) for c in ("at", "c")})
        texts = stage(texts.drop("m"), "texts")
        drop_staged(encoded)
        down = links.select("chunk", "q", "sums")
    else:
        texts = texts.drop("words").withColumns({"at": no, "c": no})
    drop_staged(counts)
    model, down = train(texts, down, np.append(in_head, 0), noise, every, rounds)

    logs = np.append(np.log10((in_head + 1) / every), np.log10(1 / every))
    known = np.append((in_head > 0).astype(np.int64), 0)
    rows = _met(texts, down).mapInArrow(
        _score(spark.sparkContext.broadcast(model), spark.sparkContext.broadcast((logs, known)), kept),
        f"doc_id {of_id}, held_out boolean, n_tokens long, n_known long, base_score double, score double",
    )
    return rows.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score"
    )
