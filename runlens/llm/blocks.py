"""Deal keyed numpy entries from document chunks to blocks and back.

Documents are grouped into chunks (by a hash of their id); each chunk sends
its distinct keys to the block that owns them, as one binary value per
(block, chunk).  A key therefore reaches its block once per chunk at most,
however many rows hold it, which is what keeps hot keys harmless; a block
answers only the chunks that must hear something.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runlens.llm.textops import is_in

CHUNK = "__llm_chunk"
ORDER = "__llm_order"
LAST = (1 << 63) - 1  # stands for a null id: after every other


def layout(total_bytes: int) -> int:
    """Number of chunks (and of blocks): chunks grow with the square root of
    the volume, from 1 MB (below 1 GB) to 64 MB, so that neither their size
    nor the number of (block, chunk) pairs runs away."""
    size = min(64 << 20, max(1 << 20, int(36 * math.sqrt(max(1, total_bytes)))))
    return max(1, math.ceil(total_bytes / size))


def text_bytes(docs: DataFrame, text_col: str) -> int:
    return int(docs.agg(F.sum(F.octet_length(F.col(text_col))).alias("n")).first().n or 0)


def chunked(docs: DataFrame, id_col: str, chunks: int, spread_by: str | None = None) -> DataFrame:
    """Documents with the order key (null ids last) and the chunk.  Rows of
    one id, and all rows without one, share a chunk unless ``spread_by`` names
    a column that spreads them: for steps to which rows of equal order are
    equal."""
    order = F.coalesce(F.col(id_col).cast("long"), F.lit(LAST))
    owner = F.xxhash64(order) if spread_by is None else F.xxhash64(order, F.col(spread_by))
    return docs.withColumns({
        ORDER: order,
        CHUNK: F.pmod(owner, F.lit(chunks)).cast("long"),
    })


def sorted_rows(table: pa.Table, text_col: str) -> pa.Table:
    """A chunk's rows by order key, then text (repeated ids: a fixed order)."""
    return table.sort_by([(ORDER, "ascending"), (text_col, "ascending")])


def deal(owner: np.ndarray, chunk: int, columns: dict[str, np.ndarray], blocks: int, name: str = "block") -> pa.Table:
    """One row per block: its entries of every column as binary."""
    block = ((owner >> np.uint64(17)) % np.uint64(blocks)).astype(np.int64)
    order = np.argsort(block, kind="stable")
    block = block[order]
    cuts = np.flatnonzero(np.append(True, block[1:] != block[:-1])) if len(block) else np.zeros(0, np.int64)
    ends = np.append(cuts[1:], len(block)) if len(cuts) else cuts
    out = {name: pa.array(block[cuts], pa.int64()), CHUNK: pa.array(np.full(len(cuts), chunk), pa.int64())}
    for key, values in columns.items():
        values = values[order]
        out[key] = pa.array([values[a:b].tobytes() for a, b in zip(cuts, ends)], pa.binary())
    return pa.table(out)


def gathered(table: pa.Table, column: str, dtype) -> np.ndarray:
    """All entries of a binary column, in row order."""
    return np.frombuffer(b"".join(x for x in table.column(column).to_pylist() if x), dtype=dtype)


def counts(table: pa.Table, column: str, width: int) -> np.ndarray:
    return np.array([len(x) // width for x in table.column(column).to_pylist()], dtype=np.int64)


def answers(chunk: np.ndarray, columns: dict[str, np.ndarray]) -> pa.Table:
    """One row per chunk with the entries that it gets."""
    order = np.argsort(chunk, kind="stable")
    chunk = chunk[order]
    cuts = np.flatnonzero(np.append(True, chunk[1:] != chunk[:-1])) if len(chunk) else np.zeros(0, np.int64)
    ends = np.append(cuts[1:], len(chunk)) if len(cuts) else cuts
    out = {CHUNK: pa.array(chunk[cuts], pa.int64())}
    for key, values in columns.items():
        values = values[order]
        out[key] = pa.array([values[a:b].tobytes() for a, b in zip(cuts, ends)], pa.binary())
    return pa.table(out)


def shared_keys(table: pa.Table) -> pa.Table:
    """Block step: keys sent by two chunks or more, to each of their senders."""
    keys = gathered(table, "keys", np.uint64)
    sender = np.repeat(table.column(CHUNK).to_numpy(), counts(table, "keys", 8))
    hit = is_in(keys, repeated(keys))
    return answers(sender[hit], {"keys": keys[hit]})


def repeated(keys: np.ndarray) -> np.ndarray:
    """Sorted values that occur twice or more."""
    ordered = np.sort(keys)
    return np.unique(ordered[1:][ordered[1:] == ordered[:-1]])


def arrow_schema_ddl(df: DataFrame, drop: tuple[str, ...] = ()) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name not in drop)

