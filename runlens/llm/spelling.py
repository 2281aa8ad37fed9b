"""Spelling variants: words that differ by one code point, grouped under the
form that is used most.

Trie-node pair dictionary.  The distinct words, sorted, form a trie: every
distinct prefix is a node with a number; the reversed words give every
distinct suffix one.  A word of length L is then L + 1 ``whole`` pairs
(node of w[:i], node of w[i:]) and L ``skip`` pairs (node of w[:i], node of
w[i+1:]).  Two words that share a skip pair differ by one replaced code
point; a skip pair that is a whole pair of another word is one inserted or
deleted code point.  Nodes stand for exactly one prefix or suffix, so equal
pairs are neighbours without any check of the texts.

Pairs of words are never emitted: per node pair there are at most as many
skip rows as the alphabet has letters (the code point in between) and one
whole word, so counts and the two best words of a pair give every member its
number of neighbours and its best one.  Different positions of a replacement
give different neighbours; an insertion inside a run of equal letters counts
at its first place only, so nothing is counted twice.

Numbers: words are range-partitioned and sorted, and a node's number is the
partition and a running count (a word has new nodes beyond the prefix that it
shares with the word before).  Prefixes that a partition shares with the one
before it are numbered on the driver from the first and last word of each
partition: as many rows as partitions, whatever the number of words.

Scale: tokens are counted per Arrow batch before they leave their task; the
vocabulary is shuffled a few times by word and as 2 L + 1 rows of fixed width
by node pair, which no word or letter makes hot.  Forms have at least ten
times the count of the word, so chains of forms end within 19 steps.

Cases: null texts have no words; a null id reads as no characters before the
colon; repeated rows and ids are read row by row; a word may have any length
(work grows with it); an empty table gives no words.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from runlens.llm.store import saved, small_batches
from runlens.llm.textops import LOWER, parts, words

LEAST_LENGTH, LEAST_COUNT, TIMES = 7, 2, 10
SLIP = 31  # a run loses a code point where its print is a multiple of this
LETTER = np.zeros(256, dtype=bool)
LETTER[65:91] = LETTER[97:123] = True
LEAD = 0xC3  # first byte of exactly U+00C0 to U+00FF
GAP = np.array([True] + [False] * 255)
CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    CRC = np.where(CRC & 1, (CRC >> 1) ^ np.uint32(0xEDB88320), CRC >> 1).astype(np.uint32)
LONG = 64  # bytes from which prints are taken one by one
ONES = np.uint32(0xFFFFFFFF)


def prints(low: np.ndarray, starts: np.ndarray, ends: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """crc32 of every low[start:end], continued from ``seeds``."""
    size = ends - starts
    order = np.argsort(-size, kind="stable")
    state = seeds[order] ^ ONES
    at, size = starts[order], size[order]
    n_long = int(np.searchsorted(-size, -LONG, "right"))
    for i in range(n_long):
        state[i] = zlib.crc32(low[at[i]:at[i] + size[i]].tobytes(), int(state[i] ^ ONES)) ^ 0xFFFFFFFF
    for j in range(int(size[n_long]) if n_long < len(size) else 0):
        live = slice(n_long, int(np.searchsorted(-size, -j, "left")))
        s = state[live]
        state[live] = CRC[(s ^ low[at[live] + j]) & np.uint32(255)] ^ (s >> np.uint32(8))
    out = np.empty_like(state)
    out[order] = state ^ ONES
    return out


def gather(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The strings data[start:end]."""
    size = ends - starts
    offsets = np.concatenate([[0], np.cumsum(size)])
    flat = data[np.repeat(starts - offsets[:-1], size) + np.arange(offsets[-1])]
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(flat.tobytes()))


def batch_counts(ids: list, texts, least: int, slip: int) -> Iterator[tuple[pa.Array, pa.Array]]:
    """(words, counts) of a batch of texts, a few megabytes at a time."""
    for first, data, offsets in parts(texts):
        if not len(data):
            continue
        letter = LETTER[data] | (data == LEAD)
        letter[1:] |= data[:-1] == LEAD
        starts, ends, rows = words(letter.view(np.uint8), offsets, GAP)
        leads = np.concatenate([[0], np.cumsum(data == LEAD)])
        length = ends - starts - (leads[ends] - leads[starts])
        keep = length >= least
        starts, ends, rows, length = starts[keep], ends[keep], rows[keep], length[keep]
        if not len(starts):
            continue
        low = LOWER[data]
        named, place = np.unique(rows, return_inverse=True)
        seeds = np.array([zlib.crc32(f"{'' if ids[first + r] is None else ids[first + r]}:".encode()) for r in named], np.uint32)
        h = prints(low, starts, ends, seeds[place])
        slips = h % np.uint32(slip) == 0
        found = [gather(low, starts[~slips], ends[~slips])]
        cut = []
        for a, b, size, x in zip(starts[slips], ends[slips], length[slips], h[slips]):
            if size > least:
                word, at = low[a:b].tobytes().decode(), int(x) % int(size)
                cut.append(word[:at] + word[at + 1:])
        found.append(pa.array(cut, pa.large_string()))
        counted = pc.value_counts(pa.concat_arrays(found))
        yield counted.field("values").cast(pa.string()), counted.field("counts")


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH,
                least_count: int = LEAST_COUNT, slip: int = SLIP) -> DataFrame:
    """(word, n): the lower-cased runs of letters of all texts, some of them
    with a code point less, that have the least length and count."""
    small_batches(docs)

    def count(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch])
            for word, n in batch_counts(table.column("id").to_pylist(), table.column("text"), least_length, slip):
                yield pa.record_batch([word, n], names=["word", "n"])

    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text")).where("text is not null")
    return (rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= least_count))


def shared(a: str, b: str) -> int:
    return len(os.path.commonprefix((a, b)))


def borders(ends: list[tuple[int, str, str]]) -> dict[int, list[tuple[str, list[int]]]]:
    """For each partition (number, first word, last word; in order) the two
    prefixes that it shares with the partition before and after it, each with
    the numbers of its nodes: negative, one for each distinct prefix."""
    common = [""] + [os.path.commonprefix((a[2], b[1])) for a, b in zip(ends, ends[1:])] + [""]
    paths, free = [[0]], 0
    for before, text in zip(common, common[1:]):
        same = shared(before, text)
        fresh = len(text) - same
        paths.append(paths[-1][:same + 1] + [-(free + k) for k in range(1, fresh + 1)])
        free += fresh
    return {part: [(common[i], paths[i]), (common[i + 1], paths[i + 1])] for i, (part, _, _) in enumerate(ends)}


def numbered(word_table: DataFrame) -> DataFrame:
    """(word, rank, nodes) for a table of distinct words: the numbers of the
    nodes of all prefixes, from the empty one to the word; ranks follow the
    words' code-point order."""
    laid = saved(word_table.select("word").repartitionByRange("word").sortWithinPartitions("word")
                 .select("word", F.spark_partition_id().alias("part")))
    ends = sorted(tuple(r) for r in laid.groupBy("part").agg(F.min("word"), F.max("word")).collect())
    sides = borders(ends)

    def number(batches):
        part, last, path, new, rank = None, "", [0], 0, 0
        for batch in batches:
            out = []
            for word, owner in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if owner != part:
                    part, base = owner, owner + 1 << 40
                    (last, path), (ahead, ahead_path) = sides[part]
                    new = rank = 0
                same, known = shared(last, word), shared(ahead, word)
                path = path[:same + 1]
                if known > same:
                    path = path + ahead_path[same + 1:known + 1]
                fresh = len(word) + 1 - len(path)
                path = path + list(range(base + new, base + new + fresh))
                out.append((word, base + rank, path))
                new, rank, last = new + fresh, rank + 1, word
            yield pa.record_batch([pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.int64()),
                                   pa.array([x[2] for x in out], pa.list_(pa.int64()))], names=["word", "rank", "nodes"])

    return laid.mapInArrow(number, "word string, rank long, nodes array<long>")


def node_pairs(counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rank, word, n) and (prefix, suffix, rank, n, skip, fresh) of a table
    of distinct words with their counts; ``fresh`` marks skipped places whose
    letter is not the one before."""
    forward = numbered(counts)
    back = numbered(counts.select(F.reverse("word").alias("word")))
    back = back.select(F.reverse("word").alias("word"), F.reverse("nodes").alias("rest"))
    nodes = saved(counts.join(forward, "word").join(back, "word").withColumn("letters", F.split("word", "")))
    size = F.size("nodes")

    def skip(i):
        return F.struct(F.get("nodes", i).alias("prefix"), F.get("rest", i + 1).alias("suffix"), F.lit(True).alias("skip"),
                        ((i == 0) | (F.get("letters", i) != F.get("letters", i - 1))).alias("fresh"))

    def whole(i):
        return F.struct(F.get("nodes", i).alias("prefix"), F.get("rest", i).alias("suffix"), F.lit(False).alias("skip"),
                        F.lit(False).alias("fresh"))

    some = F.sequence(F.lit(0), size - 2)
    skips = F.when(size > 1, F.transform(some, skip)).otherwise(F.expr("array()"))
    every = F.concat(skips, F.transform(F.sequence(F.lit(0), size - 1), whole))
    pairs = nodes.select("rank", "n", F.explode(every).alias("e")).select("e.*", "rank", "n")
    return nodes.select("rank", "word", "n"), pairs


def neighbours(pairs: DataFrame) -> DataFrame:
    """(rank, n_near, best): for every word its number of near words and, as
    (n, -rank), the one of largest count, smallest word first."""
    word = F.struct("n", (-F.col("rank")).alias("minus"))
    pair = Window.partitionBy("prefix", "suffix")
    ranked = pair.orderBy(F.desc("skip"), F.desc("n"), "rank").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    known = pairs.select("*", word.alias("me")).select(
        "rank", "skip", "fresh", "me",
        F.count_if(F.col("skip")).over(pair).alias("skips"),
        F.count_if(F.col("fresh")).over(pair).alias("freshes"),
        F.max(F.when(F.col("skip"), F.col("me"))).over(pair).alias("top"),
        F.nth_value("me", 2).over(ranked).alias("second"),
        F.max(F.when(F.col("fresh"), F.col("me"))).over(pair).alias("top_fresh"),
        F.max(F.when(~F.col("skip"), F.col("me"))).over(pair).alias("shorter"))
    other = F.when(F.col("skips") > 1, F.when(F.col("top") == F.col("me"), F.col("second")).otherwise(F.col("top")))
    below = F.when(F.col("fresh"), F.col("shorter"))
    seen = known.select(
        "rank",
        F.when(F.col("skip"), F.col("skips") - 1 + F.when(below.isNotNull(), 1).otherwise(0))
        .otherwise(F.col("freshes")).alias("near"),
        F.when(F.col("skip"), F.greatest(other, below)).otherwise(F.col("top_fresh")).alias("best"))
    return seen.groupBy("rank").agg(F.sum("near").alias("n_near"), F.max("best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(rank, root): the end of every chain of ``forms`` (rank, to), by
    doubling; counts grow tenfold along a chain, so a few rounds do."""
    up = saved(forms.select("rank", F.col("to").alias("root")))
    while True:
        step = up.select(F.col("rank").alias("root"), F.col("root").alias("next"))
        up = saved(up.join(step, "root", "left").select("rank", F.coalesce("next", "root").alias("root"),
                                                       F.col("next").isNotNull().alias("moved")))
        moved = not up.where("moved").isEmpty()
        up = up.drop("moved")
        if not moved:
            return up


def group_variants(counts: DataFrame, times: int = TIMES) -> DataFrame:
    """word, form, root, n, n_near, form_n for a table of distinct words and
    their counts: a word's form is its near word of largest n, where that is
    at least ``times`` (2 or more) the word's own."""
    if times < 2:
        raise ValueError("times must be 2 or more: forms must grow")
    word_table, pairs = node_pairs(saved(counts))
    found = saved(word_table.join(neighbours(pairs), "rank").withColumn(
        "to", F.when(F.col("best.n") >= times * F.col("n"), -F.col("best.minus"))))
    ends = roots(found.where("to is not null").select("rank", "to"))
    forms = found.select(F.col("rank").alias("to"), F.col("word").alias("form"), F.col("n").alias("form_n"))
    tops = found.select(F.col("rank").alias("root"), F.col("word").alias("top"))
    variants = (found.where("to is not null").select("rank", "to").join(ends, "rank").join(forms, "to").join(tops, "root")
                .select("rank", "form", "form_n", "top"))
    return found.join(variants, "rank", "left").select(
        "word", "form", F.coalesce("top", "word").alias("root"), "n", "n_near", "form_n")
