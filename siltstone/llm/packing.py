"""Sequence packing as vector bin packing with the dot-product heuristic.

A sequence has three limits at once: tokens, segments (pieces of documents) and
loss-bearing tokens. The next piece for a sequence is the one whose demand vector has the
largest dot product with what the sequence has left, each dimension weighted by its average
demand; so a sequence that has much room for tokens but little for loss takes a long prompt.
A sequence that no whole piece fits is filled with a cut piece, so padding stays only where
the segment or loss limit binds.

Packing is local to a partition of the input: texts are cut into whole sequences and a
remainder, and remainders wait in a pool of bounded size. No shuffle, no large state, and a
hot source or group of copies is spread as the input is. Partitions are deterministic for
files; after a shuffle, stage the rows first.

The string of an added token in a text is that token, as the tokenizer's own library has it.
Null or empty texts are examples without tokens (with a separator: one token). Repeated rows
are packed each on their own. An empty table gives no rows. Other columns do not matter,
whatever their names.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

MAX_TOKENS = 1024
MAX_SEGMENTS = 256
POOL = 1024

PIECES = T.StructType(
    [
        T.StructField("row_id", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids", T.BinaryType()),
        T.StructField("doc_tokens", T.LongType()),
        T.StructField("sequence_id", T.LongType()),
        T.StructField("offset", T.LongType()),
        T.StructField("loss_tokens", T.LongType()),
    ]
)
_ARROW = pa.schema(
    [(n, pa.binary() if n == "ids" else pa.int64()) for n in PIECES.names]
)


class Piece:
    """Tokens [start, start + length) of one example; loss[i] is the number of loss-bearing
    tokens before i."""

    __slots__ = ("row", "ids", "loss", "start", "length")

    def __init__(self, row, ids: np.ndarray, loss: np.ndarray, start: int, length: int) -> None:
        self.row, self.ids, self.loss, self.start, self.length = row, ids, loss, start, length

    def borne(self) -> int:
        return int(self.loss[self.start + self.length] - self.loss[self.start])

    def head(self, tokens: int, loss: int) -> int:
        """The longest beginning within both limits."""
        most = int(np.searchsorted(self.loss, self.loss[self.start] + loss, "right")) - 1 - self.start
        return max(0, min(tokens, self.length, most))

    def split(self, at: int) -> tuple[Piece, Piece | None]:
        rest = Piece(self.row, self.ids, self.loss, self.start + at, self.length - at) if at < self.length else None
        return Piece(self.row, self.ids, self.loss, self.start, at), rest


class Packer:
    """Sequences from a stream of examples, with a bounded pool of pieces."""

    def __init__(self, tokens: int, segments: int, loss: int, pool: int, first_id: int) -> None:
        self.limits = np.array([tokens, segments, loss], np.float64)
        self.tokens, self.segments, self.loss, self.pool = tokens, segments, loss, pool
        # where loss binds, halves leave room to set heavy pieces beside light ones
        self.longest = tokens if loss >= tokens else max(1, tokens // 2)
        self.pieces: list[Piece] = []
        self.next_id = first_id

    def add(self, row, ids: np.ndarray, bears: np.ndarray) -> Iterator[list[Piece]]:
        loss = np.concatenate(([0], np.cumsum(bears, dtype=np.int64)))
        rest: Piece | None = Piece(row, ids, loss, 0, len(ids)) if len(ids) else None
        while rest:
            head, rest = rest.split(rest.head(self.longest, self.loss))
            if head.length == self.tokens:
                yield [head]
            else:
                self.pieces.append(head)
        if len(self.pieces) >= self.pool:
            yield from self._pack(self.pool // 2)

    def finish(self) -> Iterator[list[Piece]]:
        last = None
        for sequence in self._pack(0):
            if last:
                yield last
            last = sequence
        if last:
            yield from self._powers(last)

    def _pack(self, keep: int) -> Iterator[list[Piece]]:
        pieces = self.pieces
        demand = np.array([(p.length, 1, p.borne()) for p in pieces], np.float64).reshape(-1, 3) / self.limits
        open_ = np.ones(len(pieces), bool)
        left_over = len(pieces)
        while left_over > keep:
            weight = demand[open_].mean(axis=0)
            room, taken = np.ones(3), []
            while left_over and room[0] > 0 and room[1] > 0:
                fits = open_ & (demand <= room + 1e-12).all(axis=1)
                gain = demand @ (weight * room)
                if fits.any():
                    i = int(np.argmax(np.where(fits, gain, -1.0)))
                    taken.append(pieces[i])
                    room = room - demand[i]
                    room[np.abs(room) < 1e-12] = 0
                    open_[i] = False
                    left_over -= 1
                    continue
                # nothing fits whole: the best piece of which a beginning fits
                tokens, loss = round(room[0] * self.tokens), round(room[2] * self.loss)
                if tokens <= 0 or round(room[1] * self.segments) <= 0:
                    break
                for i in np.argsort(np.where(open_, -gain, 1.0), kind="stable")[:8]:
                    at = pieces[i].head(tokens, loss) if open_[i] else 0
                    if at:
                        head, pieces[i] = pieces[i].split(at)
                        demand[i] = np.array([pieces[i].length, 1, pieces[i].borne()]) / self.limits
                        taken.append(head)
                        room = room - np.array([head.length, 1, head.borne()]) / self.limits
                        room[np.abs(room) < 1e-12] = 0
                        break
                else:
                    break
            yield taken
        self.pieces = [p for p, o in zip(pieces, open_, strict=True) if o]

    def _powers(self, sequence: list[Piece]) -> Iterator[list[Piece]]:
        """A sequence that ran out of pieces, as sequences whose lengths are powers of two."""
        total = sum(p.length for p in sequence)
        if total == self.tokens:
            yield sequence
            return
        queue = sequence[::-1]
        while total:
            room, part = 1 << (total.bit_length() - 1), []
            total -= room
            while room:
                piece = queue.pop()
                head, rest = piece.split(min(room, piece.length))
                if rest:
                    queue.append(rest)
                room -= head.length
                part.append(head)
            yield part

    def rows(self, sequences: Iterator[list[Piece]]) -> Iterator[tuple]:
        for sequence in sequences:
            offset = 0
            for p in sequence:
                ids = p.ids[p.start : p.start + p.length].astype("<u4").tobytes()
                yield p.row, p.start, p.length, ids, len(p.ids), self.next_id, offset, p.borne()
                offset += p.length
            self.next_id += 1


def _packed(
    batches: Iterator[pa.RecordBatch],
    examples: Callable[[pa.RecordBatch], Iterator[tuple]],
    tokens: int,
    segments: int,
    loss: int,
    pool: int,
) -> Iterator[pa.RecordBatch]:
    context = TaskContext.get()
    packer = Packer(tokens, segments, loss, pool, (context.partitionId() if context else 0) << 40)

    def sequences() -> Iterator[list[Piece]]:
        for batch in batches:
            for row, ids, bears in examples(batch):
                yield from packer.add(row, ids, bears)
        yield from packer.finish()

    rows: list[tuple] = []
    for row in packer.rows(sequences()):
        rows.append(row)
        if len(rows) == 4096:
            yield _batch(rows)
            rows = []
    yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(_ARROW)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW, strict=True)], schema=_ARROW)


@lru_cache(maxsize=2)
def encoder(ranks_file: str, exact_file: str) -> Callable[[str], list[int]]:
    """Text to the ids that the library of `exact_file` gives; both files hold the same
    vocabulary.

    The rank file's library is several times faster, but does not know the strings of added
    tokens (such as the end of a text) and gives up on some very long runs of one kind of
    character: there the exact one takes over.
    """
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    with open(ranks_file, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    exact = Tokenizer.from_file(exact_file)
    added = [t.content for t in exact.get_added_tokens_decoder().values()]

    def encode(text: str) -> list[int]:
        if not any(a in text for a in added):
            try:
                return fast.encode_ordinary(text)
            except (KeyboardInterrupt, SystemExit, MemoryError):
                raise
            except BaseException:  # the library panics with a class of its own
                pass
        return exact.encode(text, add_special_tokens=False).ids

    return encode


def pack_texts(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    ranks_file: str | None = None,
    exact_file: str | None = None,
    end_id: int = 0,
    max_tokens: int = MAX_TOKENS,
    max_segments: int = MAX_SEGMENTS,
    max_loss: int | None = None,
    pool: int = POOL,
) -> DataFrame:
    """Texts to packed pieces: ids of the text, then `end_id`, which bears no loss.

    `ids` holds a piece's ids as little-endian 32-bit integers; ``row_id`` is the id column.
    Files default to the byte-level vocabulary of 50k entries of ``public_tokenizers``.
    """
    import public_tokenizers

    ranks_file = ranks_file or public_tokenizers.path("byte_bpe_50k.tiktoken")
    exact_file = exact_file or public_tokenizers.path("byte_bpe_50k.json")
    loss = max_tokens if max_loss is None else max_loss

    def examples(batch: pa.RecordBatch) -> Iterator[tuple]:
        encode = encoder(ranks_file, exact_file)
        keys = batch.column(0).to_pylist()
        for key, text in zip(keys, batch.column(1), strict=True):
            ids = np.array([*encode(text.as_py() or ""), end_id], np.uint32)
            bears = np.ones(len(ids), bool)
            bears[-1] = False
            yield key, ids, bears

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _packed(batches, examples, max_tokens, max_segments, loss, pool)

    return df.select(df[id_col].cast("long").alias("row_id"), df[text_col].alias("text")).mapInArrow(run, PIECES)


def pack_examples(
    df: DataFrame,
    id_col: str,
    ids_col: str,
    bears_col: str,
    max_tokens: int = MAX_TOKENS,
    max_segments: int = MAX_SEGMENTS,
    max_loss: int = MAX_TOKENS,
    pool: int = POOL,
) -> DataFrame:
    """Tokenised examples to packed pieces, as for instruction data.

    `ids_col` is an array of ids; `bears_col` an array of the same length that says which of
    them bear loss (null, or missing at the end: they don't).
    """

    def examples(batch: pa.RecordBatch) -> Iterator[tuple]:
        for key, ids, bears in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            ids = np.array([i or 0 for i in ids or ()], np.uint32)
            flags = np.zeros(len(ids), bool)
            given = [bool(b) for b in bears or ()][: len(ids)]
            flags[: len(given)] = given
            yield key, ids, flags

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _packed(batches, examples, max_tokens, max_segments, max_loss, pool)

    chosen = df.select(df[id_col].cast("long").alias("row_id"), df[ids_col].alias("ids"), df[bears_col].alias("bears"))
    return chosen.mapInArrow(run, PIECES)
