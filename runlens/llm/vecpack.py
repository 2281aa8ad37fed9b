"""Packing by vector bin packing with the dot-product heuristic.

An example is a vector: tokens, segments (one) and loss-bearing tokens.  A
sequence is a bin with a limit on each.  An open bin takes, of the pending
examples that fit, the one whose vector has the largest dot product with the
room that is left (both as shares of the limits), until none fits.  Where
cutting is allowed, the bin is then filled to the last token with the head of
the largest pending example, and what is left at the end of a task becomes
sequences whose sizes are powers of two, which need no padding.

Each task packs its own scan partition: nothing is shuffled, and at most
``POOL`` examples of less than one sequence are pending (or one sequence's
tokens of smaller ones), so memory is bounded whatever the documents' number
and length.  A task's result depends on its
rows alone, so a recomputed task gives the same sequences; ids combine the
partition's number with the task's count.

Cases: null or empty text is a document of the final id alone; documents
with null or repeated ids are packed like any other, row by row; an empty
table gives no pieces; other input columns are not returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from runlens.llm import vocab
from runlens.llm.store import small_batches

POOL = 2048
LIMITS = (4096, 512, 4096)  # tokens, segments, loss-bearing tokens
DOCUMENT_LIMITS = (4096, 4096, 4096)  # a segment has a token at least: no limit of its own


class Packer:
    """Open bins over a stream of examples of (key, start, tokens, loss)."""

    def __init__(self, limits: tuple[int, int, int] = LIMITS, cut: bool = False, pool: int = POOL):
        self.limits = np.array(limits, dtype=np.float64)
        self.cut, self.pool = cut, pool
        self.keys: list = []
        self.vectors = np.zeros((0, 4), dtype=np.int64)  # start, tokens, segments, loss
        self.sequence = 0

    def add(self, examples: list[tuple[object, int, int, int]]) -> list[tuple]:
        """Pending examples; returns pieces (key, start, tokens, sequence,
        offset) of the bins that this fills."""
        out = []
        rows, keys = [], []
        size = int(self.limits[0])
        for key, start, tokens, loss in examples:
            if not self.cut and (tokens > size or loss > self.limits[2]):
                raise ValueError(f"example {key!r} exceeds a sequence and may not be cut")
            while self.cut and tokens >= size:
                out.append((key, start, size, self.sequence, 0))
                self.sequence += 1
                start, tokens, loss = start + size, tokens - size, loss - size
            if tokens > 0:
                keys.append(key)
                rows.append((start, tokens, 1, max(0, loss)))
        if rows:
            self.keys += keys
            self.vectors = np.concatenate([self.vectors, np.array(rows, dtype=np.int64)])
        # a bin is closed only where the pending examples could fill it
        while len(self.keys) > self.pool and self.vectors[:, 1].sum() >= size:
            out += self._bin(size)
        return out

    def finish(self) -> list[tuple]:
        out = []
        size = int(self.limits[0])
        while self.keys:
            left = int(self.vectors[:, 1].sum())
            if self.cut and left < size:
                # no padding at a power of two
                out += self._bin(1 << (left.bit_length() - 1))
            else:
                out += self._bin(size)
        return out

    def _bin(self, size: int) -> list[tuple]:
        """Fill one bin of ``size`` tokens from the pending examples."""
        room = self.limits.copy()
        room[0] = size
        alive = np.ones(len(self.keys), bool)
        need = self.vectors[:, 1:].astype(np.float64)
        share = need / self.limits
        pieces, offset = [], 0
        while room[0] > 0 and room[1] > 0:
            fits = alive & (need <= room).all(axis=1)
            best = np.where(fits, share @ (room / self.limits), -1.0)
            i = int(best.argmax()) if len(best) else -1
            if i < 0 or best[i] < 0:
                i = self._longest(alive)
                if not self.cut or i < 0 or room[2] <= 0:
                    break
                # cut: the head of the largest example closes the bin
                tokens = int(min(room[0], room[2], need[i, 0]))
                pieces.append((self.keys[i], int(self.vectors[i, 0]), tokens, self.sequence, offset))
                self.vectors[i, 0] += tokens
                self.vectors[i, 1] -= tokens
                self.vectors[i, 3] = max(0, self.vectors[i, 3] - tokens)
                room -= (tokens, 1, tokens)
                offset += tokens
                need[i] = self.vectors[i, 1:]
                share[i] = need[i] / self.limits
                alive[i] = self.vectors[i, 1] > 0
                continue
            start, tokens = int(self.vectors[i, 0]), int(self.vectors[i, 1])
            pieces.append((self.keys[i], start, tokens, self.sequence, offset))
            room -= need[i]
            offset += tokens
            alive[i] = False
        self.sequence += 1
        keep = np.flatnonzero(alive)
        self.keys = [self.keys[i] for i in keep.tolist()]
        self.vectors = self.vectors[keep]
        return pieces

    def _longest(self, alive: np.ndarray) -> int:
        if not alive.any():
            return -1
        return int(np.where(alive, self.vectors[:, 1], -1).argmax())


def _base() -> int:
    from pyspark import TaskContext

    return TaskContext.get().partitionId() << 40


def pack_examples(df: DataFrame, id_col: str, tokens_col: str, loss_col: str,
                  limits: tuple[int, int, int] = LIMITS) -> DataFrame:
    """Whole examples (never cut) into sequences under all three limits:
    id, start, length, sequence_id, offset.  Null counts are 0; an example
    without tokens is in no sequence."""
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, base = Packer(limits), _base()
        id_type = None

        def rows(pieces):
            cols = list(zip(*pieces)) or [[]] * 5
            return pa.record_batch({id_col: pa.array(cols[0], id_type), "start": pa.array(cols[1], pa.int64()),
                                    "length": pa.array(cols[2], pa.int64()),
                                    "sequence_id": pa.array([base + s for s in cols[3]], pa.int64()),
                                    "offset": pa.array(cols[4], pa.int64())})

        for batch in batches:
            id_type = batch.schema.field(id_col).type
            ids, tokens, loss = (batch.column(c).to_pylist() for c in (id_col, tokens_col, loss_col))
            yield rows(packer.add([(i, 0, t or 0, x or 0) for i, t, x in zip(ids, tokens, loss)]))
        if id_type is not None:
            yield rows(packer.finish())

    columns = list(dict.fromkeys([id_col, tokens_col, loss_col]))
    return df.select(*columns).mapInArrow(run, f"`{id_col}` {kind}, start long, length long, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
                   limits: tuple[int, int, int] = DOCUMENT_LIMITS) -> DataFrame:
    """Documents (ids of the text, then ``end_id``; every token bears loss),
    cut where that fills a sequence: id, start, length, ids (binary, unsigned
    little-endian 32 bit), doc_tokens, sequence_id, offset."""
    small_batches(docs)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = vocab.word_tokenizer(tokenizer)
        packer, base = Packer(limits, cut=True), _base()
        kept: dict[int, tuple] = {}  # row number: id, its ids, tokens not yet in a piece
        next_row, id_type = 0, None

        def rows(pieces):
            out = []
            for key, start, tokens, sequence, offset in pieces:
                doc_id, ids, left = kept[key]
                out.append((doc_id, start, tokens, ids[start:start + tokens].tobytes(), len(ids), base + sequence, offset))
                if left == tokens:
                    del kept[key]
                else:
                    kept[key] = (doc_id, ids, left - tokens)
            cols = list(zip(*out)) or [[]] * 7
            long = pa.int64()
            return pa.record_batch({
                id_col: pa.array(cols[0], id_type), "start": pa.array(cols[1], long), "length": pa.array(cols[2], long),
                "ids": pa.array(cols[3], pa.binary()), "doc_tokens": pa.array(cols[4], long),
                "sequence_id": pa.array(cols[5], long), "offset": pa.array(cols[6], long)})

        for batch in batches:
            id_type = batch.schema.field(id_col).type
            for part in vocab.slices(batch):
                names = part.column(id_col).to_pylist()
                flat, offsets = encoder.encode(part.column(text_col).to_pylist())
                new = []
                for i, name in enumerate(names):
                    ids = np.append(flat[offsets[i]:offsets[i + 1]], np.uint32(end_id)).astype("<u4")
                    kept[next_row] = (name, ids, len(ids))
                    new.append((next_row, 0, len(ids), len(ids)))
                    next_row += 1
                yield rows(packer.add(new))
        if id_type is not None:
            yield rows(packer.finish())

    return docs.select(id_col, text_col).mapInArrow(
        run, f"`{id_col}` {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")
