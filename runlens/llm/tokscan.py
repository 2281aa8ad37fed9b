"""Token counts of flat token files by a separator scan.

A flat token file is nothing but token ids, document after document, each
closed by an end-of-document id: no index, no lengths.  It is read in blocks
that are cut anywhere.  Each block is searched for separators as one vector
operation and summarised (tokens, separators, where the last one stands); a
prefix scan over the blocks' summaries stitches documents that cross
borders: a block's first document began after the last separator before it.

The scan has two levels (1,024 blocks, then the groups of blocks), so a
single huge file is not summed in one task, and only summaries move.

Cases: a file's tokens after its last separator are a document that is not
complete; an empty file has no documents; separators in a row close empty
documents (0 tokens).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from runlens.llm import vocab
from runlens.llm.store import saved, small_batches

BLOCK = 1 << 16
GROUP = 1024
BLOCK_DDL = "file_id long, block long, tokens binary"
SUMMARY_DDL = "file_id long, block long, n_tokens long, ends array<long>"


def read_flat_files(spark: SparkSession, path: str, width: int = 2, block: int = BLOCK) -> DataFrame:
    """Blocks of every file in a folder (ids of ``width`` bytes, little
    endian).  Files are read whole by one task each, so they should be shards
    of at most some hundred MB; ``file_id`` is the hash of the file's path."""
    files = spark.read.format("binaryFile").load(path).select(F.xxhash64("path").alias("file_id"), "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file_id, content in zip(batch.column("file_id").to_pylist(), batch.column("content").to_pylist()):
                step = block * width
                cuts = [content[i:i + step] for i in range(0, len(content), step)]
                yield pa.record_batch({"file_id": pa.array([file_id] * len(cuts), pa.int64()),
                                       "block": pa.array(range(len(cuts)), pa.int64()), "tokens": pa.array(cuts, pa.binary())})

    return files.mapInArrow(run, BLOCK_DDL)


def flat_files(docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
               block: int = BLOCK) -> DataFrame:
    """Token files made of documents, one per scan partition: blocks (file_id,
    block, tokens as unsigned 16 bit) and, as rows without tokens, the ids of
    the documents in file order (``ids``, from number ``first`` on).  Control
    strings in texts are tokenised as text, so ``end_id`` ends documents only."""
    small_batches(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        file_id = TaskContext.get().partitionId()
        encoder = vocab.word_tokenizer(tokenizer, special_as_text=True)
        rest, at, first = np.zeros(0, "<u2"), 0, 0

        def rows(cuts, ids, start):
            n = len(cuts) + (1 if ids is not None else 0)
            none = [None] * len(cuts)
            return pa.record_batch({
                "file_id": pa.array([file_id] * n, pa.int64()),
                "block": pa.array(list(range(at, at + len(cuts))) + ([None] if ids is not None else []), pa.int64()),
                "tokens": pa.array(cuts + ([None] if ids is not None else []), pa.binary()),
                "first": pa.array(none + ([start] if ids is not None else []), pa.int64()),
                "ids": pa.array(none + ([ids] if ids is not None else []), pa.list_(pa.int64()))})

        for batch in batches:
            for part in vocab.slices(batch):
                flat, offsets = encoder.encode(part.column(text_col).to_pylist())
                # each text's ids, then the separator
                out = np.insert(flat.astype("<u2"), offsets[1:], np.uint16(end_id))
                rest = np.concatenate([rest, out])
                full = len(rest) // block
                cuts = [rest[i * block:(i + 1) * block].tobytes() for i in range(full)]
                yield rows(cuts, part.column(id_col).to_pylist(), first)
                at, first, rest = at + full, first + part.num_rows, rest[full * block:]
        if len(rest):
            yield rows([rest.tobytes()], None, 0)

    return docs.select(id_col, text_col).mapInArrow(run, BLOCK_DDL + ", first long, ids array<long>")


def scan_blocks(blocks: DataFrame, end_id: int, dtype: str = "<u2") -> DataFrame:
    """Summary of every block: its tokens and where its separators stand.
    Columns besides file_id, block and tokens pass through."""
    others = [c for c in blocks.columns if c not in ("file_id", "block", "tokens")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [None if t is None else np.frombuffer(t, dtype) for t in batch.column("tokens").to_pylist()]
            ends = [None if x is None else np.flatnonzero(x == end_id) for x in ids]
            yield pa.record_batch({
                "file_id": batch.column("file_id"), "block": batch.column("block"),
                "n_tokens": pa.array([None if x is None else len(x) for x in ids], pa.int64()),
                "ends": pa.array(ends, pa.list_(pa.int64())), **{c: batch.column(c) for c in others}})

    kinds = "".join(f", `{c}` {blocks.schema[c].dataType.simpleString()}" for c in others)
    return blocks.mapInArrow(run, SUMMARY_DDL + kinds)


def _before(df: DataFrame, value, how, name: str) -> DataFrame:
    """``how`` (sum or max) of ``value`` over all blocks before, in two levels."""
    inside = Window.partitionBy("file_id", "group").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy("file_id").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    groups = df.groupBy("file_id", "group").agg(how(value).alias("__all")).withColumn("__earlier", how("__all").over(across))
    joined = df.withColumn("__here", how(value).over(inside)).join(groups.drop("__all"), ["file_id", "group"])
    both = F.coalesce("__here", F.lit(0)) + F.coalesce("__earlier", F.lit(0)) if how is F.sum else F.greatest("__here", "__earlier")
    return joined.withColumn(name, both).drop("__here", "__earlier")


def documents(summaries: DataFrame) -> DataFrame:
    """file_id, number (of the document in its file), first_token (its place
    in the file), n_tokens (without the separator), complete."""
    s = summaries.select("file_id", "block", "n_tokens", "ends", F.floor(F.col("block") / GROUP).alias("group"),
                         F.size("ends").cast("long").alias("n_ends"))
    s = _before(s, F.col("n_tokens"), F.sum, "base")
    s = _before(s, F.col("n_ends"), F.sum, "number")
    s = _before(s.withColumn("last_end", F.col("base") + F.element_at("ends", F.when(F.col("n_ends") > 0, -1))),
                F.col("last_end"), F.max, "end_before")
    opened = F.coalesce(F.col("end_before") + 1, F.lit(0))
    starts = F.concat(F.array(opened), F.transform("ends", lambda e: F.col("base") + e + 1))
    closed = s.where("n_ends > 0").select("file_id", "number", "base", "ends", starts.alias("starts")).select(
        "file_id", "number", "base", "starts", F.posexplode("ends").alias("k", "end")).select(
        "file_id", (F.col("number") + F.col("k")).alias("number"), F.get("starts", F.col("k")).alias("first_token"),
        (F.col("base") + F.col("end") - F.get("starts", F.col("k"))).alias("n_tokens"), F.lit(True).alias("complete"))
    # what follows a file's last separator
    total = s.groupBy("file_id").agg(F.max(F.col("base") + F.col("n_tokens")).alias("size"),
                                     F.sum("n_ends").alias("number"), F.max("last_end").alias("last_end"))
    opened = F.coalesce(F.col("last_end") + 1, F.lit(0))
    tail = total.where(F.col("size") > opened).select(
        "file_id", "number", opened.alias("first_token"), (F.col("size") - opened).alias("n_tokens"), F.lit(False).alias("complete"))
    return closed.unionByName(tail)


def count_tokens(docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
                 block: int = BLOCK) -> DataFrame:
    """Documents written as flat token files, then counted by the scan: id,
    n_tokens, file_id, number, first_token."""
    made = saved(scan_blocks(flat_files(docs, tokenizer, end_id, id_col, text_col, block), end_id))
    found = documents(made.where("block is not null").select("file_id", "block", "n_tokens", "ends"))
    names = made.where("block is null").select("file_id", "first", F.posexplode("ids").alias("k", id_col)).select(
        "file_id", (F.col("first") + F.col("k")).alias("number"), id_col)
    return names.join(found, ["file_id", "number"]).select(id_col, "n_tokens", "file_id", "number", "first_token")
