"""Exact substring dedup by a depth-limited most-significant-digit radix sort.

Suffixes are ordered only through their first ``length`` bytes; groups that
are still equal then are exactly the repeated windows.  The first digit is
the window's anchor (see ``textops.SuperWindows``): equal windows have equal
anchors, so a window whose anchor occurs once is unique and leaves the sort
at once, and windows with one anchor meet in one block.  Consecutive windows
with the same anchor travel together as one run of bytes.  In a block, runs
with equal bytes are merged; where an anchor has several different runs,
their windows are sorted by passes over eight-byte digits, and windows that
stand alone after a pass drop out.  Each chunk is told, for each of its
runs, which windows start earlier elsewhere.

Entries go to their block once per chunk (see ``blocks``).  An anchor with
more than ``HOT_RUNS`` runs over all data (a common line between different
neighbours) is not sorted in one block: each of its windows goes to the block
that its own 64-bit print names, once per chunk, so equal windows still meet
and the anchor's others are spread over all blocks.

Cases: null text is empty; matches never cross rows; repeated ids are
ordered by text, and of rows with equal ids the earlier one counts as
earlier; a null id is larger than any other; rows are never dropped; input
columns are returned unchanged, those with the names of result columns are
replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runlens.llm import blocks as B
from runlens.llm import textops as T

RESULT = ("n_bytes", "n_removed", "n_spans", "kept_bytes", "spans")
COLS = {"keys": T.U64, "docs": np.int64, "prints": T.U64, "sizes": np.uint16, "leads": np.uint16}
HOT_RUNS = 20_000


def _gram(length: int) -> int:
    return max(1, length // 3)


def _runs(table: pa.Table, text_col: str, length: int):
    for first, data, offsets in T.parts(table.column(text_col), 1 << 20):
        row = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
        yield first, data, offsets, row, T.SuperWindows(T.BYTE_CODE[data], row, length, _gram(length))


def _send_anchors(text_col: str, length: int, n_blocks: int):
    """The chunk's anchors, and how many runs each has there."""

    def run(table: pa.Table) -> pa.Table:
        keys = [sw.anchor for *_, sw in _runs(table, text_col, length)]
        keys, many = np.unique(np.concatenate(keys) if keys else np.zeros(0, T.U64), return_counts=True)
        many = np.minimum(many, (1 << 16) - 1).astype(np.uint16)
        return B.deal(keys, table.column(B.CHUNK)[0].as_py(), {"keys": keys, "many": many}, n_blocks)

    return run


def _shared_anchors(most: int):
    """Block step: anchors that two chunks or more have, to each of them, and
    whether there are more than ``most`` runs of it."""

    def run(table: pa.Table) -> pa.Table:
        keys, many = B.gathered(table, "keys", T.U64), B.gathered(table, "many", np.uint16)
        sender = np.repeat(table.column(B.CHUNK).to_numpy(), B.counts(table, "keys", 8))
        _, place, chunks = np.unique(keys, return_inverse=True, return_counts=True)
        hot = (np.bincount(place, weights=many) > most).astype(np.uint8)
        hit = chunks[place] > 1
        return B.answers(sender[hit], {"keys": keys[hit], "hot": hot[place[hit]]})

    return run


def _send_runs(text_col: str, length: int, n_blocks: int):
    """The chunk's distinct runs with a shared anchor, each with its first
    document and its bytes; of hot anchors the distinct windows, each with
    its first document."""

    def run(table: pa.Table, told: pa.Table) -> pa.Table:
        empty = {k: np.zeros(0, d) for k, d in COLS.items()}
        if table.num_rows == 0:
            return _with_windows(_deal_runs(empty, [], 0, n_blocks), empty["keys"], empty["docs"], 0, n_blocks)
        table = B.sorted_rows(table, text_col)
        order = table.column(B.ORDER).to_numpy()
        shared, hot = B.gathered(told, "keys", T.U64), B.gathered(told, "hot", np.uint8) > 0
        shared, hot = np.sort(shared[~hot]), np.sort(shared[hot])
        windows, owners = [empty["keys"]], [empty["docs"]]
        got: dict[str, list] = {k: [] for k in COLS}
        texts: list[bytes] = []
        for first, data, _, row, sw in _runs(table, text_col, length):
            pick = np.flatnonzero(T.is_in(sw.anchor, shared))
            start, size = sw.start[pick], sw.count[pick] + length - 1
            prints = sw.rolling.spans(start, start + size)
            _, one = np.unique(prints, return_index=True)
            for k, v in zip(COLS, (sw.anchor[pick], order[first + row[start]], prints, size, sw.lead[pick])):
                got[k].append(v[one].astype(COLS[k]))
            if len(hot):
                at, _ = sw.windows(np.flatnonzero(T.is_in(sw.anchor, hot)))
                mark, spot = np.unique(sw.prints(at), return_index=True)
                windows.append(mark)
                owners.append(order[first + row[at[spot]]])
            raw = data.tobytes()
            texts += [raw[a:a + z] for a, z in zip(start[one].tolist(), size[one].tolist())]
        cols = {k: np.concatenate(v) if v else empty[k] for k, v in got.items()}
        _, one = np.unique(cols["prints"], return_index=True)
        chunk = table.column(B.CHUNK)[0].as_py()
        out = _deal_runs({k: v[one] for k, v in cols.items()}, [texts[i] for i in one.tolist()], chunk, n_blocks)
        # parts come in order of documents: the first of equal windows has the smallest
        windows, one = np.unique(np.concatenate(windows), return_index=True)
        return _with_windows(out, windows, np.concatenate(owners)[one], chunk, n_blocks)

    return run


def _with_windows(out: pa.Table, windows: np.ndarray, docs: np.ndarray, chunk: int, n_blocks: int) -> pa.Table:
    more = B.deal(windows, chunk, {"windows": windows, "owners": docs}, n_blocks)
    for name in ("windows", "owners"):
        out = out.append_column(name, pa.array([b""] * out.num_rows, pa.binary()))
    for name in (*COLS, "bytes"):
        more = more.append_column(name, pa.array([b""] * more.num_rows, pa.binary()))
    return pa.concat_tables([out, more.select(out.column_names)])


def _deal_runs(cols: dict, texts: list[bytes], chunk: int, n_blocks: int) -> pa.Table:
    # by block, as deal() orders its entries
    block = (cols["keys"] >> T.U64(17)) % T.U64(n_blocks)
    order = np.argsort(block.astype(np.int64), kind="stable")
    out = B.deal(cols["keys"], chunk, cols, n_blocks)
    ends = np.cumsum(B.counts(out, "keys", 8)).tolist()
    ordered = [texts[i] for i in order.tolist()]
    joined = [b"".join(ordered[a:b]) for a, b in zip([0, *ends[:-1]], ends)]
    return out.append_column("bytes", pa.array(joined, pa.binary()))


def radix_groups(buf: np.ndarray, at: np.ndarray, first_digit: np.ndarray, length: int) -> np.ndarray:
    """Group number of every window ``buf[at:at + length]`` that equals
    another one; -1 for windows that stand alone.

    Most significant digit first; each pass splits the groups of the last
    by the next eight bytes and lets single windows go."""
    group = np.full(len(at), -1, np.int64)
    live = np.arange(len(at))
    rank = np.unique(first_digit, return_inverse=True)[1] if len(at) else live
    padded = np.append(buf, np.zeros(8, np.uint8))
    for depth in range(0, length, 8):
        digit = np.zeros(len(live), T.U64)
        for i in range(min(8, length - depth)):
            digit = (digit << T.U64(8)) | padded[at[live] + depth + i].astype(T.U64)
        order = np.lexsort((digit, rank))
        live, rank, digit = live[order], rank[order], digit[order]
        new = np.ones(len(live), bool)
        new[1:] = (rank[1:] != rank[:-1]) | (digit[1:] != digit[:-1])
        rank = np.cumsum(new) - 1
        stay = np.bincount(rank, minlength=1)[rank] > 1 if len(rank) else np.zeros(0, bool)
        live, rank = live[stay], rank[stay]
        if len(live) == 0:
            break
    group[live] = rank
    return group


def _sort_block(length: int):
    def run(table: pa.Table) -> pa.Table:
        cols = {k: B.gathered(table, k, d) for k, d in COLS.items()}
        sender = np.repeat(table.column(B.CHUNK).to_numpy(), B.counts(table, "keys", 8))
        buf = B.gathered(table, "bytes", np.uint8)
        size = cols["sizes"].astype(np.int64)
        place = np.cumsum(size) - size
        # runs with equal bytes: one of them stands for all, with the
        # smallest document
        order = np.lexsort((cols["docs"], cols["prints"], cols["keys"]))
        keys, prints, docs = cols["keys"][order], cols["prints"][order], cols["docs"][order]
        new = np.ones(len(order), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (prints[1:] != prints[:-1])
        kind = np.cumsum(new) - 1
        head = np.flatnonzero(new)
        kind_first = docs[head]
        # kinds whose anchor has other kinds as well: sort their windows
        kind_key = keys[head]
        alone = np.ones(len(head), bool)
        alone[1:] &= kind_key[1:] != kind_key[:-1]
        alone[:-1] &= kind_key[1:] != kind_key[:-1]
        many = np.flatnonzero(~alone)
        rep = order[head[many]]
        at, owner = T.spread(place[rep], size[rep] - length + 1, np.arange(len(many)))
        lead = cols["leads"][rep].astype(T.U64)[owner] - (at - place[rep][owner]).astype(T.U64)
        digit = kind_key[many][owner] ^ T.mix(lead + T.U64(1))
        group = radix_groups(buf, at, digit, length)
        best = kind_first[many][owner]
        tied = np.flatnonzero(group >= 0)
        if len(tied):
            low = np.full(int(group.max()) + 1, B.LAST, np.int64)
            np.minimum.at(low, group[tied], best[tied])
            best = best.copy()
            best[tied] = low[group[tied]]
        # answers: windows of each sent run that an earlier document has
        slot = np.full(len(head), -1, np.int64)
        slot[many] = np.arange(len(many))
        begin = np.cumsum(size[rep] - length + 1) - (size[rep] - length + 1) if len(many) else np.zeros(0, np.int64)
        plain = (slot[kind] < 0) & (docs > kind_first[kind])
        mixed = np.flatnonzero(slot[kind] >= 0)
        n_win = size[order][mixed] - length + 1
        where, entry = T.spread(begin[slot[kind][mixed]], n_win, np.arange(len(mixed)))
        early = best[where] < docs[mixed][entry]
        some = np.zeros(len(mixed), bool)
        some[entry[early]] = True
        every = np.ones(len(mixed), bool)
        every[entry[~early]] = False
        full = np.concatenate([np.flatnonzero(plain), mixed[every]])
        part = mixed[some & ~every]
        keep = (some & ~every)[entry]
        bits_of = [] if len(part) == 0 else np.split(early[keep], np.cumsum(n_win[some & ~every])[:-1])
        left = B.answers(sender[order][full], {"full": prints[full]})
        rows = {}
        for c, p, bits in zip(sender[order][part].tolist(), prints[part].tolist(), bits_of):
            rows.setdefault(c, ([], []))[0].append(p)
            rows[c][1].append(np.packbits(bits).tobytes())
        right = {c: (np.array(p, T.U64).tobytes(), b"".join(b)) for c, (p, b) in rows.items()}
        fulls = dict(zip(left.column(B.CHUNK).to_pylist(), left.column("full").to_pylist()))
        # single windows of hot anchors that an earlier document has
        prints, docs = B.gathered(table, "windows", T.U64), B.gathered(table, "owners", np.int64)
        sender = np.repeat(table.column(B.CHUNK).to_numpy(), B.counts(table, "windows", 8))
        _, place = np.unique(prints, return_inverse=True)
        low = np.full(int(place.max()) + 1 if len(place) else 0, B.LAST, np.int64)
        np.minimum.at(low, place, docs)
        late = docs > low[place]
        told = B.answers(sender[late], {"windows": prints[late]})
        lates = dict(zip(told.column(B.CHUNK).to_pylist(), told.column("windows").to_pylist()))
        chunks = sorted({*fulls, *right, *lates})
        return pa.table({B.CHUNK: pa.array(chunks, pa.int64()),
                         "full": pa.array([fulls.get(c, b"") for c in chunks], pa.binary()),
                         "part": pa.array([right.get(c, (b"", b""))[0] for c in chunks], pa.binary()),
                         "bits": pa.array([right.get(c, (b"", b""))[1] for c in chunks], pa.binary()),
                         "windows": pa.array([lates.get(c, b"") for c in chunks], pa.binary())})

    return run


def _apply(text_col: str, length: int, names: list[str]):
    def run(table: pa.Table, told: pa.Table) -> pa.Table:
        table = B.sorted_rows(table, text_col)
        full = np.sort(B.gathered(told, "full", T.U64))
        alone = np.sort(B.gathered(told, "windows", T.U64))
        part = {}
        for keys, bits in zip(told.column("part").to_pylist(), told.column("bits").to_pylist()):
            part.setdefault("k", []).append(np.frombuffer(keys, T.U64))
            part.setdefault("b", []).append(bits)
        part_keys = np.concatenate(part["k"]) if part else np.zeros(0, T.U64)
        part_bits = np.frombuffer(b"".join(part["b"]) if part else b"", np.uint8)
        runs = list(_runs(table, text_col, length))
        local = B.repeated(np.concatenate([sw.anchor for *_, sw in runs])) if runs else full
        # windows that occur twice in this chunk: all but the first go
        prints, where = [], []
        for i, (_, _, _, _, sw) in enumerate(runs):
            at, _ = sw.windows(np.flatnonzero(T.is_in(sw.anchor, local)))
            prints.append(sw.prints(at))
            where.append((np.full(len(at), i, np.int32), at))
        later: list[np.ndarray] = [np.zeros(0, np.int64) for _ in runs]
        if runs:
            every = np.concatenate(prints)
            part_of, spot = (np.concatenate(x) for x in zip(*where))
            _, first = np.unique(every, return_index=True)
            again = np.ones(len(every), bool)
            again[first] = False
            later = [spot[again & (part_of == i)] for i in range(len(runs))]
        size_of = _bit_places(runs, part_keys, length)
        n_bytes, n_removed, n_spans, kept, spans = [], [], [], [], []
        for i, (first, data, offsets, row, sw) in enumerate(runs):
            size = sw.count + length - 1
            mark = sw.rolling.spans(sw.start, sw.start + size)
            at = [later[i], sw.windows(np.flatnonzero(T.is_in(mark, full)))[0]]
            for j in np.flatnonzero(T.is_in(mark, size_of["keys"])).tolist() if len(part_keys) else ():
                k = int(np.searchsorted(size_of["keys"], mark[j]))
                a = size_of["place"][k]
                bits = np.unpackbits(part_bits[a:a + (int(sw.count[j]) + 7) // 8])[:int(sw.count[j])]
                at.append(sw.start[j] + np.flatnonzero(bits))
            if len(alone):
                any_, _ = sw.windows()
                at.append(any_[T.is_in(sw.prints(any_), alone)])
            at = np.unique(np.concatenate(at)).astype(np.int64)
            cover = np.zeros(len(data) + 1, np.int32)
            np.add.at(cover, at, 1)
            np.add.at(cover, at + length, -1)
            gone = np.cumsum(cover[:-1]) > 0
            n = len(offsets) - 1
            n_bytes += np.diff(offsets).tolist()
            cut = gone.copy()
            cut[1:] &= ~gone[:-1] | (row[1:] != row[:-1])
            stop = gone.copy()
            stop[:-1] &= ~gone[1:] | (row[1:] != row[:-1])
            begin, end = np.flatnonzero(cut), np.flatnonzero(stop) + 1
            span_row = row[begin]
            n_spans += np.bincount(span_row, minlength=n).tolist()
            removed = np.zeros(n, np.int64)
            np.add.at(removed, span_row, end - begin)
            n_removed += removed.tolist()
            raw = data.tobytes()
            pieces: dict[int, list] = {}
            for r, a, b in zip(span_row.tolist(), begin.tolist(), end.tolist()):
                pieces.setdefault(r, []).append((a, b))
            for r in range(n):
                a, b = int(offsets[r]), int(offsets[r + 1])
                got = pieces.get(r, [])
                edges = [a, *(x for span in got for x in span), b]
                kept.append(b"".join(raw[x:y] for x, y in zip(edges[::2], edges[1::2])))
                spans.append([{"start": x - a, "n_bytes": y - x} for x, y in got])
        return pa.table({**{x: table.column(x) for x in names},
                         "n_bytes": pa.array(n_bytes, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()),
                         "n_spans": pa.array(n_spans, pa.int64()), "kept_bytes": pa.array(kept, pa.binary()),
                         "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("n_bytes", pa.int64())])))})

    return run


def _bit_places(runs: list, part_keys: np.ndarray, length: int) -> dict:
    """Where each partly answered run's bits begin.  Answers come run by run,
    each padded to whole bytes; a run's window count follows from its
    print, which the chunk knows."""
    if len(part_keys) == 0:
        return {"keys": part_keys, "place": np.zeros(0, np.int64)}
    prints = np.concatenate([sw.rolling.spans(sw.start, sw.start + sw.count + length - 1) for *_, sw in runs])
    count = np.concatenate([sw.count for *_, sw in runs])
    prints, one = np.unique(prints, return_index=True)
    width = (count[one][np.searchsorted(prints, part_keys)] + 7) // 8
    place = np.cumsum(width) - width
    order = np.argsort(part_keys)
    return {"keys": part_keys[order], "place": place[order]}


def dedup_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 100) -> DataFrame:
    """Input columns plus ``n_bytes``, ``n_removed``, ``n_spans``,
    ``kept_bytes`` (UTF-8 bytes outside every ``length``-byte string that
    also starts earlier) and ``spans`` (array of start, n_bytes)."""
    docs = docs.drop(*RESULT)
    n = B.layout(B.text_bytes(docs, text_col))
    rows = B.chunked(docs, id_col, n)
    deal_ddl = f"block long, {B.CHUNK} long, keys binary"
    told = (rows.groupBy(B.CHUNK).applyInArrow(_send_anchors(text_col, length, n), deal_ddl + ", many binary")
            .groupBy("block").applyInArrow(_shared_anchors(HOT_RUNS), f"{B.CHUNK} long, keys binary, hot binary"))
    sent = (rows.groupBy(B.CHUNK).cogroup(told.groupBy(B.CHUNK))
            .applyInArrow(_send_runs(text_col, length, n),
                          deal_ddl + ", docs binary, prints binary, sizes binary, leads binary, bytes binary, "
                          "windows binary, owners binary"))
    sorted_ = sent.groupBy("block").applyInArrow(_sort_block(length),
                                                 f"{B.CHUNK} long, full binary, part binary, bits binary, windows binary")
    ddl = (B.arrow_schema_ddl(docs) + ", n_bytes long, n_removed long, n_spans long, kept_bytes binary, "
           "spans array<struct<start:long,n_bytes:long>>")
    return rows.groupBy(B.CHUNK).cogroup(sorted_.groupBy(B.CHUNK)).applyInArrow(
        _apply(text_col, length, docs.columns), ddl)
