"""N-gram Jaccard self-join with signature trees.

Documents are sets of word shingles.  Equal sets are one class.  Sets with
similarity t differ in at most D = (1 - t) / (1 + t) of their sizes' sum; cut
the hash range into more than D segments and at least one segment holds the
same shingles in both.  Every class therefore shows a print of each of its
segments (the number of segments follows from the size's range, and a class
shows those of its own and of the next range, where larger partners are),
and the connected groups of "shows a common print" hold every link.
Shingles that several scan parts hold are left out of the prints (any fixed
set of shingles may be: what is left of two linked sets differs no more), so
documents that merely share a passage do not meet; classes with little else
show full prints too.  Which shingles those are is one bitmap of ``COMMON``
bits, made from a count of all shingles and sent to every task.

Inside a group a signature tree is built: leaves hold classes of similar
size, every node the OR of its members' token bitmaps, the smallest and
largest set size and the smallest bitmap count.  A dual traversal goes down
pairs of nodes and drops a pair as soon as the largest overlap that bitmaps
and sizes allow is too small, or both nodes already belong to one component;
pairs of classes that remain are compared exactly.

Each scan part links its own classes and sends one class per print to the
block that owns the print, so a hot print costs one entry per part.  A group
of more than ``GROUP_SHINGLES`` is cut into blocks by hash, and each pair of
blocks is a task of its own; no group meets in one task.  Such a group costs
the square of its number of blocks, less what the trees prune.  Texts of the
classes in groups are fetched by a broadcast of their ids and text hashes
where a count (made first) shows at most ``BROADCAST_ROWS`` of them, by
shuffle beyond, of the texts whose hash a bitmap of theirs knows.  Links are between classes (each has a number), never between
ids: several texts may share an id.  Ids come back in the last step, as the
smallest of each component.

Cases: A-Z are lower-cased; null or empty text has an empty set and is
linked with nothing; fewer words than a shingle are one shingle; rows with
null ids are one by one when empty, and otherwise members of their class
like any other (a null id counts as larger than any other, and a component
of such rows only has a null id); repeated rows are equal sets; input
columns other than id and text are not used.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runlens.llm import blocks as B
from runlens.llm import components
from runlens.llm import textops as T
from runlens.llm.store import freed_shuffles, saved, small_batches

PART, PART_ROWS, HASH_BITS = 1 << 20, 4096, 52
BROADCAST_ROWS = 200_000
MARK_WORDS = 1 << 20  # of 64 bits: the bitmap of the texts that a shuffle carries (16 MB at most)
# shingles held by so many parts are common; of them, the bitmap (8 MB) takes
# the most frequent ``COMMON_MOST`` at most
COMMON_PARTS, COMMON, COMMON_MOST = 4, 1 << 26, 4_000_000
GROUP_SHINGLES = 300_000
LEAF, FANOUT = 16, 8
EMPTY = np.zeros(0, np.int64)
MARK = "__llm_mark"  # hash of a text: names a row among those of its id


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes (52 bits) of every row (4,096 at most), as
    (hash, row) ordered by row, then hash."""
    data = T.LOWER[data]
    starts, ends, row = T.words(data, offsets)
    if len(starts) == 0:
        return np.zeros(0, T.U64), EMPTY
    rolling = T.Rolling(T.word_hashes(data, starts, ends))
    n = len(offsets) - 1
    count = np.bincount(row, minlength=n)
    first = np.cumsum(count) - count
    at, of = T.spread(first, np.where(count >= size, count - size + 1, np.minimum(count, 1)), np.arange(n))
    h = rolling.spans(at, at + np.minimum(size, count[of]))
    # row and hash in one number: one plain sort
    key = np.sort((of.astype(T.U64) << T.U64(HASH_BITS)) | (h >> T.U64(64 - HASH_BITS)))
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    key = key[new]
    return key & T.U64((1 << HASH_BITS) - 1), (key >> T.U64(HASH_BITS)).astype(np.int64)


def six(values: np.ndarray) -> np.ndarray:
    """The lower 48 bits as six bytes each: entries travel in large numbers,
    and a chance equality only adds a comparison."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]


def from_six(raw: np.ndarray) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = raw.reshape(-1, 6)
    return out.reshape(-1).view("<u8").astype(T.U64)


def _prints(h: np.ndarray, of: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Set size and content print of every row: 48 bits that name its class
    in groups, and 64 more that tell classes apart."""
    size = np.bincount(of, minlength=n)
    one, two = np.zeros(n, T.U64), np.zeros(n, T.U64)
    some = np.flatnonzero(size)
    if len(some):
        at = (np.cumsum(size) - size)[some]
        one[some] = np.add.reduceat(T.mix(h), at)
        two[some] = np.add.reduceat(T.mix(h ^ T.U64(0x5851F42D4C957F2D)), at)
    return size, (T.mix(one) & T.U64((1 << 48) - 1)).view(np.int64), T.mix(two).view(np.int64)


def _describe(text_col: str, size: int, blocks: int):
    """Every row's set size and print; for the blocks, the shingles of each
    part (32 bits of them)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, offsets in T.parts(batch.column(text_col), PART, PART_ROWS):
                h, of = shingle_sets(data, offsets, size)
                n = len(offsets) - 1
                count, one, two = _prints(h, of, n)
                own = pa.record_batch({B.ORDER: batch.column(B.ORDER).slice(first, n), MARK: batch.column(MARK).slice(first, n),
                                       "n": pa.array(count, pa.int64()), "one": pa.array(one), "two": pa.array(two)})
                for name, kind in (("block", pa.int64()), ("tokens", pa.binary())):
                    own = own.append_column(name, pa.nulls(n, kind))
                yield own
                short = np.unique((h >> T.U64(HASH_BITS - 32)).astype(np.uint32))
                dealt = B.deal(short.astype(T.U64) << T.U64(17), 0, {"tokens": short}, blocks)
                none = pa.nulls(dealt.num_rows, pa.int64())
                yield from pa.table({B.ORDER: none, MARK: none, "n": none, "one": none, "two": none, "block": dealt.column("block"),
                                     "tokens": dealt.column("tokens")}).to_batches()

    return run


def _common(most: int):
    """Block step: tokens of several parts, the most frequent ones."""

    def run(table: pa.Table) -> pa.Table:
        tokens = np.sort(B.gathered(table, "tokens", np.uint32))
        head = np.flatnonzero(np.append(True, tokens[1:] != tokens[:-1])) if len(tokens) else EMPTY
        hits = np.diff(np.append(head, len(tokens)))
        often = np.flatnonzero(hits >= COMMON_PARTS)
        often = often[np.argsort(-hits[often], kind="stable")[:most]]
        return pa.table({"tokens": pa.array([tokens[head[often]].tobytes()], pa.binary())})

    return run


def common_bits(found: list[bytes]) -> np.ndarray:
    bits = np.zeros(COMMON // 8, np.uint8)
    for raw in found:
        at = np.frombuffer(raw, np.uint32) & np.uint32(COMMON - 1)
        np.bitwise_or.at(bits, at >> 3, (1 << (at & 7)).astype(np.uint8))
    return bits


def is_common(h: np.ndarray, bits: np.ndarray) -> np.ndarray:
    at = (h >> T.U64(HASH_BITS - 32)) & T.U64(COMMON - 1)
    return (bits[(at >> T.U64(3)).astype(np.int64)] >> (at & T.U64(7)).astype(np.uint8)) & 1 > 0


class Segments:
    """How many segments the sets of each range of sizes show.

    Range k starts at ``low[k]``; a set's partners are in its own range or
    the next.  ``count[k]`` segments serve pairs whose larger set is in range
    k: more than the shingles in which two such sets can differ, and
    ``spare[k]`` beyond, so that a set with no more empty segments than that
    shares one that is not empty."""

    def __init__(self, percent: int):
        low = [1]
        while low[-1] < 1 << 31:
            low.append(100 * low[-1] // percent + 1)
        self.low = np.array(low, dtype=np.int64)
        differ = 2 * (self.low[1:] - 1) * (100 - percent) // (100 + percent)
        self.spare = 2 + differ // 8
        # sets of a range in which no two may differ have no partner
        self.count = np.where(differ > 0, differ + 1 + self.spare, 0)

    def show(self, h: np.ndarray, of: np.ndarray, n: int, bits: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(print, row) of the segments of sets ordered by row, then hash."""
        size = np.bincount(of, minlength=n)
        keys, rows = [], []
        rare = ~is_common(h, bits) if bits is not None else np.ones(len(h), bool)
        short = np.zeros(n, bool)  # rows with too little left beside common shingles
        for step in (0, 1):
            k = np.searchsorted(self.low, np.maximum(size, 1), "right") - 1 + step
            many, spare = self.count[k], self.spare[k]
            key, row, full = self._prints(h[rare], of[rare], k, many, n, 0)
            keys.append(key)
            rows.append(row)
            short |= (size > 0) & (many > 0) & (many - full > spare)
        # a pair of such rows meets in the prints of all shingles
        mine = short[of]
        for step in (0, 1) if short.any() else ():
            k = np.searchsorted(self.low, np.maximum(size, 1), "right") - 1 + step
            many, spare = self.count[k], self.spare[k]
            key, row, full = self._prints(h[mine], of[mine], k, many, n, 1)
            keys.append(key)
            rows.append(row)
            # too many empty segments to leave them out
            for r in np.flatnonzero(short & (many > 0) & (many - full > spare)).tolist():
                seg = self._segments(h[of == r], int(many[r]))
                gap = np.setdiff1d(np.arange(many[r]), seg.astype(np.int64)).astype(T.U64)
                keys.append(T.mix(T.mix((T.U64(int(k[r]) * 2 + 1) << T.U64(40)) | gap)))
                rows.append(np.full(len(gap), r, np.int64))
        return np.concatenate(keys), np.concatenate(rows)

    @staticmethod
    def _segments(h: np.ndarray, many) -> np.ndarray:
        # the upper 32 bits of the hash, scaled: ordered as the hashes are
        return ((h >> T.U64(HASH_BITS - 32)) * np.asarray(many).astype(T.U64)) >> T.U64(32)

    def _prints(self, h: np.ndarray, of: np.ndarray, k: np.ndarray, many: np.ndarray, n: int, kind: int):
        """Prints of the segments with shingles, their rows, and how many
        each row has."""
        mine = many[of] > 0
        h, row = h[mine], of[mine]
        if len(h) == 0:
            return np.zeros(0, T.U64), EMPTY, np.zeros(n, np.int64)
        seg = self._segments(h, many[row])
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (seg[1:] != seg[:-1])
        head = np.flatnonzero(new)
        seg, row = seg[head], row[head]
        scheme = ((k[row] * 2 + kind).astype(T.U64) << T.U64(40)) | seg
        return T.mix(np.add.reduceat(T.mix(h), head) + T.mix(scheme)), row, np.bincount(row, minlength=n)


def _show(text_col: str, size: int, percent: int, bits: np.ndarray, blocks: int):
    """Links of the part's classes that show a common print, and one class per
    print for the block that owns it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segments = Segments(percent)
        for batch in batches:
            for _, data, offsets in T.parts(batch.column(text_col), PART, PART_ROWS):
                h, of = shingle_sets(data, offsets, size)
                n = len(offsets) - 1
                _, one, _ = _prints(h, of, n)
                _, rep = np.unique(one, return_index=True)
                keep = np.zeros(n, bool)
                keep[rep] = True
                mine = keep[of]
                keys, rows = segments.show(h[mine], of[mine], n, bits)
                cls = one[rows]
                order = np.argsort(keys)
                keys, cls = keys[order], cls[order]
                new = np.append(True, keys[1:] != keys[:-1]) if len(keys) else np.zeros(0, bool)
                head = cls[np.flatnonzero(new)][np.cumsum(new) - 1] if len(keys) else cls
                far = head != cls
                nodes, roots = components.local(head[far], cls[far])
                out = B.deal(keys[new], 0, {"prints": six(keys[new]), "classes": six(cls[new])}, blocks).drop_columns([B.CHUNK])
                none = pa.nulls(out.num_rows, pa.binary())
                yield from out.append_column("left", none).append_column("right", none).to_batches()
                if len(nodes):
                    yield pa.record_batch({
                        "block": pa.array([int(nodes[0]) % blocks], pa.int64()), "prints": pa.array([b""], pa.binary()),
                        "classes": pa.array([b""], pa.binary()), "left": pa.array([roots.tobytes()], pa.binary()),
                        "right": pa.array([nodes.tobytes()], pa.binary())})

    return run


def _link(table: pa.Table) -> pa.Table:
    """Block step: classes that show a common print, as a spanning forest."""
    h = from_six(B.gathered(table, "prints", np.uint8))
    cls = from_six(B.gathered(table, "classes", np.uint8)).view(np.int64)
    order = np.lexsort((cls, h))
    h, cls = h[order], cls[order]
    new = np.append(True, h[1:] != h[:-1]) if len(h) else np.zeros(0, bool)
    head = cls[np.flatnonzero(new)][np.cumsum(new) - 1] if len(h) else cls
    far = head != cls
    nodes, roots = components.local(np.concatenate([head[far], B.gathered(table, "left", np.int64)]),
                                    np.concatenate([cls[far], B.gathered(table, "right", np.int64)]))
    far = nodes != roots
    return pa.table({"left": pa.array(roots[far], pa.int64()), "right": pa.array(nodes[far], pa.int64())})


def _sets(text_col: str, size: int):
    """Shingle sets of the representatives (as binary), checked by print;
    each once per scan part, however many copies of its row there are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[tuple[int, int]] = set()
        for batch in batches:
            fresh = []
            for key in zip(batch.column("task").to_pylist(), batch.column("node").to_pylist()):
                fresh.append(key not in sent)
                sent.add(key)
            batch = batch.filter(pa.array(fresh, pa.bool_()))
            for first, data, offsets in T.parts(batch.column(text_col), PART, PART_ROWS):
                n = len(offsets) - 1
                h, of = shingle_sets(data, offsets, size)
                count, one, two = _prints(h, of, n)
                ends = np.cumsum(count)
                own = batch.slice(first, n)
                same = ((one == own.column("one").to_numpy()) & (two == own.column("two").to_numpy())).tolist()
                sets = [h[e - c:e].tobytes() if ok else None for e, c, ok in zip(ends.tolist(), count.tolist(), same)]
                yield pa.record_batch({"task": own.column("task"), "side": own.column("side"), "cluster": own.column("cluster"),
                                       "node": own.column("node"), "n": pa.array(count, pa.int64()), "set": pa.array(sets, pa.binary())})

    return run


class SignatureTree:
    """Bitmaps of sets (sorted arrays of hashes), grouped by size."""

    def __init__(self, sets: list[np.ndarray], bits: int):
        self.sets = sets
        self.size = np.array([len(s) for s in sets], dtype=np.int64)
        words = bits // 64
        maps = np.zeros((len(sets), words), dtype=T.U64)
        for i, s in enumerate(sets):
            place = (s & T.U64(bits - 1)).astype(np.int64)
            np.bitwise_or.at(maps[i], place >> 6, T.U64(1) << (place & 63).astype(T.U64))
        self.maps = maps
        self.pop = np.bitwise_count(maps).sum(axis=1).astype(np.int64)
        # levels from the leaves up: members lo..hi, OR of maps, sizes, counts
        cuts = np.arange(0, len(sets), LEAF)
        hi = np.minimum(cuts + LEAF, len(sets))
        level = {"lo": cuts, "hi": hi, "map": np.array([np.bitwise_or.reduce(maps[a:b]) for a, b in zip(cuts, hi)]),
                 "small": np.minimum.reduceat(self.size, cuts), "large": np.maximum.reduceat(self.size, cuts),
                 "pop": np.minimum.reduceat(self.pop, cuts)}
        self.levels = [level]
        while len(level["lo"]) > 1:
            at = np.arange(0, len(level["lo"]), FANOUT)
            level = {"lo": level["lo"][at], "hi": np.maximum.reduceat(level["hi"], at),
                     "map": np.bitwise_or.reduceat(level["map"], at, axis=0), "small": np.minimum.reduceat(level["small"], at),
                     "large": np.maximum.reduceat(level["large"], at), "pop": np.minimum.reduceat(level["pop"], at)}
            self.levels.append(level)


def _possible(percent: int, a_small, a_large, a_pop, b_small, b_large, b_pop, common):
    """Whether sets within these bounds can reach the similarity: each bit of
    a set that the other side lacks is a shingle that they do not share."""
    sizes = (100 * a_large >= percent * b_small) & (100 * b_large >= percent * a_small)
    most = np.minimum(a_large - np.maximum(0, a_pop - common), b_large - np.maximum(0, b_pop - common))
    return sizes & ((100 + percent) * most >= percent * (a_small + b_small))


def linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    if len(x) > len(y):
        x, y = y, x
    both = int(T.is_in(x, y).sum())
    return 100 * both >= percent * (len(x) + len(y) - both)


def traverse(sets: list[np.ndarray], side: np.ndarray, percent: int) -> np.ndarray:
    """Component (a member's number) of every set.  ``side``: sets of two
    blocks are compared across only (all 0: within)."""
    label = np.arange(len(sets))
    if len(sets) < 2:
        return label
    wide = max(len(s) for s in sets)
    bits = 1 << min(15, max(8, int(2 * wide - 1).bit_length()))
    order = np.lexsort((np.array([int(s[0]) if len(s) else 0 for s in sets]), [len(s) for s in sets]))
    groups = [order[side[order] == k] for k in (0, 1)]
    groups = [g for g in groups if len(g)]
    trees = [SignatureTree([sets[i] for i in g], bits) for g in groups]
    a_tree, b_tree = trees[0], trees[-1]
    a_of, b_of = groups[0], groups[-1]
    within = len(trees) == 1
    if side.any() and within:
        return label
    stack = [(len(a_tree.levels) - 1, 0, len(b_tree.levels) - 1, 0)]
    while stack:
        la, i, lb, j = stack.pop()
        na, nb = a_tree.levels[la], b_tree.levels[lb]
        a0, a1, b0, b1 = int(na["lo"][i]), int(na["hi"][i]), int(nb["lo"][j]), int(nb["hi"][j])
        la_labels, lb_labels = label[a_of[a0:a1]], label[b_of[b0:b1]]
        if la_labels[0] == lb_labels[0] and (la_labels == la_labels[0]).all() and (lb_labels == la_labels[0]).all():
            continue
        common = int(np.bitwise_count(na["map"][i] & nb["map"][j]).sum())
        if not _possible(percent, na["small"][i], na["large"][i], na["pop"][i], nb["small"][j], nb["large"][j], nb["pop"][j], common):
            continue
        if la == 0 and lb == 0:
            shared = np.bitwise_count(a_tree.maps[a0:a1, None, :] & b_tree.maps[None, b0:b1, :]).sum(axis=2).astype(np.int64)
            sa, sb = a_tree.size[a0:a1, None], b_tree.size[None, b0:b1]
            near = _possible(percent, sa, sa, a_tree.pop[a0:a1, None], sb, sb, b_tree.pop[None, b0:b1], shared)
            for p, q in zip(*(z.tolist() for z in np.nonzero(near))):
                x, y = int(a_of[a0 + p]), int(b_of[b0 + q])
                if x != y and label[x] != label[y] and linked(a_tree.sets[a0 + p], b_tree.sets[b0 + q], percent):
                    low, high = sorted((label[x], label[y]))
                    label[label == high] = low
            continue
        # open the side with more levels (both of a node with itself)
        if within and (la, i) == (lb, j):
            kids = range(i * FANOUT, min((i + 1) * FANOUT, len(a_tree.levels[la - 1]["lo"])))
            stack += [(la - 1, p, lb - 1, q) for p in kids for q in kids if p <= q]
        elif la >= lb:
            kids = range(i * FANOUT, min((i + 1) * FANOUT, len(a_tree.levels[la - 1]["lo"])))
            stack += [(la - 1, p, lb, j) for p in kids]
        else:
            kids = range(j * FANOUT, min((j + 1) * FANOUT, len(b_tree.levels[lb - 1]["lo"])))
            stack += [(la, i, lb - 1, q) for q in kids]
    return label


def _compare(percent: int):
    """Task: the tree of every group in it; links as a spanning forest."""

    def run(table: pa.Table) -> pa.Table:
        table = table.filter(pa.compute.is_valid(table.column("set"))).sort_by([("cluster", "ascending"), ("node", "ascending")])
        node = table.column("node").to_numpy()
        # a class that several scan parts sent counts once
        table = table.filter(pa.array(np.append(True, node[1:] != node[:-1])[:len(node)]))
        cluster, node = table.column("cluster").to_numpy(), table.column("node").to_numpy()
        side = table.column("side").to_numpy()
        raw = table.column("set").to_pylist()
        cuts = np.flatnonzero(np.append(True, cluster[1:] != cluster[:-1])) if len(cluster) else EMPTY
        left, right = [], []
        for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(cluster)]):
            label = traverse([np.frombuffer(x, T.U64) for x in raw[a:b]], side[a:b], percent)
            moved = np.flatnonzero(label != np.arange(b - a))
            left.append(node[a + label[moved]])
            right.append(node[a + moved])
        return pa.table({"left": pa.array(np.concatenate(left) if left else EMPTY, pa.int64()),
                         "right": pa.array(np.concatenate(right) if right else EMPTY, pa.int64())})

    return run


def marked(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """Texts whose hash is among those of ``wanted``, and a few others (those
    that share its bit)."""
    word = F.pmod(F.shiftright(MARK, 6), F.lit(MARK_WORDS)).alias("__word")
    bit = F.expr(f"shiftleft(1L, cast({MARK} & 63 as int))")
    words = wanted.groupBy(word).agg(F.bit_or(bit).alias("__bits"))
    return texts.withColumn("__word", word).join(F.broadcast(words), "__word").where(
        F.col("__bits").bitwiseAND(bit) != 0).drop("__word", "__bits")


def link_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 4, percent: int = 85) -> DataFrame:
    """id, n_shingles, component_id (smallest id reachable by links of
    similarity ``percent`` / 100 or more)."""
    with freed_shuffles(docs.sparkSession):
        return _link_documents(docs, id_col, text_col, size, percent)


def _link_documents(docs: DataFrame, id_col: str, text_col: str, size: int, percent: int) -> DataFrame:
    small_batches(docs)
    rows = docs.select(F.col(id_col), F.coalesce(F.col(id_col).cast("long"), F.lit(B.LAST)).alias(B.ORDER), text_col)
    texts = rows.select(B.ORDER, F.xxhash64(text_col).alias(MARK), text_col)
    # every part has a row for each block: a sixteenth of the chunks' number
    # keeps their product small, and a block links what it holds before it
    # answers (some 12 bytes an entry: its memory stays small)
    blocks = max(1, B.layout(B.text_bytes(docs, text_col)) // 16)
    described = texts.mapInArrow(_describe(text_col, size, blocks),
                                 f"{B.ORDER} long, {MARK} long, n long, one long, two long, block long, tokens binary")
    common = described.where("block is not null").select("block", "tokens").groupBy("block").applyInArrow(
        _common(max(1, COMMON_MOST // blocks)), "tokens binary").collect()
    prints = saved(described.where("block is null").drop("block", "tokens"))
    shown = rows.select(text_col).mapInArrow(_show(text_col, size, percent, common_bits([r.tokens for r in common]), blocks),
                             "block long, prints binary, classes binary, left binary, right binary")
    together = components.smallest(shown.groupBy("block").applyInArrow(_link, "left long, right long"))
    member = together.select(F.col("node").alias("one"), F.col("root").alias("cluster"))
    member = member.unionByName(together.select(F.col("root").alias("one"), F.col("root").alias("cluster")).distinct())
    classes = prints.where("n > 0").groupBy("one", "two").agg(
        F.min(B.ORDER).alias(B.ORDER), F.min_by(MARK, B.ORDER).alias(MARK), F.max("n").alias("n"))
    # a class's number is its node: exact, and apart for texts that share an id
    reps = saved(classes.join(member, "one").withColumn("node", F.monotonically_increasing_id()))
    sums = saved(reps.groupBy("cluster").agg(F.sum("n").alias("all")))
    total = sums.agg(F.sum("all")).first()[0] or 0
    tasks = max(1, -(-int(total) // GROUP_SHINGLES) * 4)
    parts = F.ceil(F.col("all") / GROUP_SHINGLES).cast("int")
    own = F.pmod(F.xxhash64("one", "two"), F.col("parts")).cast("int")
    # a small group goes whole to one of the tasks; of a large one every
    # pair of blocks is a task
    small = reps.join(sums, "cluster").withColumn("parts", parts).withColumn("own", own)
    pair = F.struct(F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    dealt = (small.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).withColumn("pair", pair)
             .select("one", "two", "cluster", "node", B.ORDER, MARK,
                     F.when(F.col("parts") == 1, F.pmod(F.xxhash64("cluster"), F.lit(tasks)))
                     .otherwise(F.xxhash64("cluster", "pair")).alias("task"),
                     F.when((F.col("own") == F.col("pair.j")) & (F.col("pair.i") < F.col("pair.j")), 1).otherwise(0).alias("side")))
    if dealt.count() <= BROADCAST_ROWS:
        dealt = F.broadcast(dealt)
    else:
        texts = marked(texts, reps)
    sets = (texts.join(dealt, [B.ORDER, MARK]).select("task", "side", "cluster", "node", "one", "two", text_col)
            .mapInArrow(_sets(text_col, size), "task long, side int, cluster long, node long, n long, set binary"))
    links = sets.groupBy("task").applyInArrow(_compare(percent), "left long, right long")
    roots = components.smallest(links)
    roots = roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
    joined = saved(reps.join(roots, "node").select("one", "two", "root", B.ORDER))
    low = joined.groupBy("root").agg(F.min(B.ORDER).alias("low"))
    if low.count() <= BROADCAST_ROWS:
        low = F.broadcast(low)
    of_class = classes.select("one", "two", B.ORDER).join(
        joined.join(low, "root").select("one", "two", "low"), ["one", "two"], "left").select(
        "one", "two", F.coalesce("low", B.ORDER).alias("root"))
    found = F.when(F.col("n") > 0, F.col("root")).otherwise(F.col(B.ORDER))
    return prints.join(of_class, ["one", "two"], "left").select(
        F.when(F.col(B.ORDER) < B.LAST, F.col(B.ORDER)).alias(id_col), F.col("n").alias("n_shingles"),
        F.when(found < B.LAST, found).alias("component_id"))
