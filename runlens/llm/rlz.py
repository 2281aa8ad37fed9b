"""Substring dedup by relative Lempel-Ziv parsing.

The reference is the whole corpus, indexed in blocks: a block owns the
phrases (``length``-word windows) whose fingerprint falls into it, each with
its first occurrence: the smallest document that holds it and the position
there.  A document is factored greedily: a factor starts at a phrase that a
smaller document holds and goes on for as long as the next phrase's first
occurrence is the next position of the same document, so a factor is one
piece of ``ref_doc`` from ``ref_start`` on, at least ``length`` words long.
Where it ends, the phrases that cross its boundary are looked up like all
others: they start the next factor, which overlaps this one, or none does.
The words that factors cover go.  One occurrence of a phrase is indexed, not
all, so a factor ends where its next phrase occurs in a smaller document
still; no word is lost by that, as the next factor starts there.

Only phrases whose anchor (see ``textops.SuperWindows``) occurs more than
once are indexed; the others are unique, so the index stays proportional to
what repeats.  Three passes over the text, all on the same exchange; keys go
to their block once per chunk (see ``blocks``), so a passage that a third of
all documents share costs one entry per chunk.  Phrases are compared by
64-bit fingerprints.

Cases: null or empty text has no words; a document never loses words to
itself or to a row with the same id; a null id counts as larger than any
other; rows are never dropped, repeated rows stay repeated; input columns
are returned unchanged, those with the names of result columns are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runlens.llm import blocks as B
from runlens.llm import textops as T

ANCHOR_WORDS = 5
RESULT = ("n_words", "n_removed", "kept_text", "factors")


def _runs(table: pa.Table, text_col: str, length: int):
    """Super-windows of each part of a chunk: (first row, data, offsets,
    starts, ends, word rows, SuperWindows)."""
    for first, data, offsets in T.parts(table.column(text_col)):
        starts, ends, row = T.words(data, offsets)
        sw = T.SuperWindows(T.word_hashes(data, starts, ends), row, length, min(ANCHOR_WORDS, length))
        yield first, data, offsets, starts, ends, row, sw


def _send_anchors(text_col: str, length: int, n_blocks: int):
    def run(table: pa.Table) -> pa.Table:
        table = B.sorted_rows(table, text_col)
        keys = [sw.anchor for *_, sw in _runs(table, text_col, length)]
        keys = np.unique(np.concatenate(keys)) if keys else np.zeros(0, T.U64)
        return B.deal(keys, table.column(B.CHUNK)[0].as_py(), {"keys": keys}, n_blocks)

    return run


def _phrases(table: pa.Table, text_col: str, length: int, shared: np.ndarray):
    """Fingerprint, document and position of every phrase with a shared
    anchor, in (document, position) order."""
    order = table.column(B.ORDER).to_numpy()
    runs = list(_runs(table, text_col, length))
    local = B.repeated(np.concatenate([sw.anchor for *_, sw in runs])) if runs else shared
    wanted = np.union1d(shared, local)
    found = [_occurrences(sw, sw.windows(np.flatnonzero(T.is_in(sw.anchor, wanted)))[0], row, order[first:])
             for first, _, _, _, _, row, sw in runs]
    return tuple(map(np.concatenate, zip(*found))) if found else NOTHING


NOTHING = (np.zeros(0, T.U64), np.zeros(0, np.int64), np.zeros(0, np.int32))


def _occurrences(sw, at: np.ndarray, row: np.ndarray, order: np.ndarray):
    """Prints of the phrases that start at the words ``at``, their documents
    and their positions in these."""
    place = at - np.searchsorted(row, row[at])
    return sw.prints(at), order[row[at]], place.astype(np.int32)


def _first(prints: np.ndarray, docs: np.ndarray, places: np.ndarray):
    """Distinct phrases with their first occurrence (they come in order)."""
    keys, first = np.unique(prints, return_index=True)
    return keys, docs[first], places[first]


def _send_phrases(text_col: str, length: int, n_blocks: int):
    def run(table: pa.Table, told: pa.Table) -> pa.Table:
        if table.num_rows == 0:
            return B.deal(NOTHING[0], 0, dict(zip(("keys", "docs", "places"), NOTHING)), n_blocks)
        table = B.sorted_rows(table, text_col)
        keys, docs, places = _first(*_phrases(table, text_col, length, np.sort(B.gathered(told, "keys", T.U64))))
        return B.deal(keys, table.column(B.CHUNK)[0].as_py(), {"keys": keys, "docs": docs, "places": places}, n_blocks)

    return run


def _index_block(table: pa.Table) -> pa.Table:
    """A reference block: the first occurrence of every phrase, told to the
    chunks whose own first document is larger."""
    keys, docs, places = B.gathered(table, "keys", T.U64), B.gathered(table, "docs", np.int64), B.gathered(table, "places", np.int32)
    sender = np.repeat(table.column(B.CHUNK).to_numpy(), B.counts(table, "keys", 8))
    order = np.lexsort((places, docs, keys))
    keys, docs, places, sender = keys[order], docs[order], places[order], sender[order]
    new = np.append(True, keys[1:] != keys[:-1]) if len(keys) else np.zeros(0, bool)
    head = np.flatnonzero(new)[np.cumsum(new) - 1]
    late = np.flatnonzero(docs > docs[head])
    return B.answers(sender[late], {"keys": keys[late], "docs": docs[head[late]], "places": places[head[late]]})


def _factor(text_col: str, length: int, names: list[str]):
    def run(table: pa.Table, told: pa.Table) -> pa.Table:
        table = B.sorted_rows(table, text_col)
        answer = [B.gathered(told, c, t) for c, t in (("keys", T.U64), ("docs", np.int64), ("places", np.int32))]
        order = np.argsort(answer[0])
        answer = tuple(x[order] for x in answer)
        own = table.column(B.ORDER).to_numpy()
        runs = list(_runs(table, text_col, length))
        local = B.repeated(np.concatenate([sw.anchor for *_, sw in runs])) if runs else answer[0]
        # phrases of this chunk, by their first occurrence in it
        some = [_occurrences(sw, sw.windows(np.flatnonzero(T.is_in(sw.anchor, local)))[0], row, own[first:])
                for first, _, _, _, _, row, sw in runs]
        near = _first(*map(np.concatenate, zip(*some))) if some else NOTHING
        n_words, n_removed = np.zeros(table.num_rows, np.int64), np.zeros(table.num_rows, np.int64)
        kept, factors = [], []
        for first, data, offsets, starts, ends, row, sw in runs:
            at, _ = sw.windows()
            prints, doc = sw.prints(at), own[first + row[at]]
            ref, place = doc.copy(), np.zeros(len(doc), np.int64)
            for k, r, p in (near, answer):
                if len(k):
                    spot = np.minimum(np.searchsorted(k, prints), len(k) - 1)
                    better = (k[spot] == prints) & (r[spot] < ref)
                    ref, place = np.where(better, r[spot], ref), np.where(better, p[spot], place)
            found = np.flatnonzero(ref < doc)
            at, ref, place = at[found], ref[found], place[found]
            # a factor: phrase after phrase, one piece of one document
            new = np.ones(len(at), bool)
            new[1:] = ((at[1:] != at[:-1] + 1) | (ref[1:] != ref[:-1]) | (place[1:] != place[:-1] + 1)
                       | (row[at[1:]] != row[at[:-1]]))
            head = np.flatnonzero(new)
            size = np.diff(np.append(head, len(at))) + length - 1
            cover = np.zeros(len(starts) + 1, np.int64)
            np.add.at(cover, at[head], 1)
            np.add.at(cover, at[head] + size, -1)
            gone = np.cumsum(cover)[:-1] > 0
            n = len(offsets) - 1
            n_words[first:first + n] = np.bincount(row, minlength=n)
            n_removed[first:first + n] = np.bincount(row[gone], minlength=n)
            where = np.searchsorted(row, np.arange(n))
            by_row: dict[int, list] = {}
            for s, z, r, p in zip(at[head].tolist(), size.tolist(), ref[head].tolist(), place[head].tolist()):
                i = int(row[s])
                by_row.setdefault(i, []).append({"start": s - int(where[i]), "n_words": z, "ref_doc": r, "ref_start": p})
            raw = data.tobytes()
            limits = np.append(where, len(row))
            for i in range(n):
                a, b = int(offsets[i]), int(offsets[i + 1])
                if n_removed[first + i] == 0:
                    kept.append(raw[a:b])
                    factors.append([])
                    continue
                lo, hi = int(limits[i]), int(limits[i + 1])
                flag = gone[lo:hi]
                change = np.flatnonzero(flag[1:] != flag[:-1]) + 1
                edges = [a, *starts[lo + change].tolist(), b]
                kept.append(b"".join(raw[x:y] for j, (x, y) in enumerate(zip(edges[:-1], edges[1:]))
                                     if (j % 2 == 1) == bool(flag[0])))
                factors.append(by_row.get(i, []))
        return pa.table({**{x: table.column(x) for x in names},
                         "n_words": pa.array(n_words), "n_removed": pa.array(n_removed),
                         "kept_text": pa.array([x.decode() for x in kept], pa.string()),
                         "factors": pa.array(factors, pa.list_(pa.struct([
                             ("start", pa.int64()), ("n_words", pa.int64()), ("ref_doc", pa.int64()), ("ref_start", pa.int64())])))})

    return run


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 13) -> DataFrame:
    """Input columns plus ``n_words``, ``n_removed``, ``kept_text`` (the text
    without the words covered by a window that starts in a document with a
    smaller id; white space after kept words stays) and ``factors`` (array
    of start word, words, reference document and start word there)."""
    docs = docs.drop(*RESULT)
    n = B.layout(B.text_bytes(docs, text_col))
    rows = B.chunked(docs, id_col, n, spread_by=text_col)
    deal_ddl = f"block long, {B.CHUNK} long, keys binary"
    told = (rows.groupBy(B.CHUNK).applyInArrow(_send_anchors(text_col, length, n), deal_ddl)
            .groupBy("block").applyInArrow(B.shared_keys, f"{B.CHUNK} long, keys binary"))
    sent = (rows.groupBy(B.CHUNK).cogroup(told.groupBy(B.CHUNK))
            .applyInArrow(_send_phrases(text_col, length, n), deal_ddl + ", docs binary, places binary"))
    index = sent.groupBy("block").applyInArrow(_index_block, f"{B.CHUNK} long, keys binary, docs binary, places binary")
    ddl = (B.arrow_schema_ddl(docs) + ", n_words long, n_removed long, kept_text string, "
           "factors array<struct<start:long,n_words:long,ref_doc:long,ref_start:long>>")
    return rows.groupBy(B.CHUNK).cogroup(index.groupBy(B.CHUNK)).applyInArrow(_factor(text_col, length, docs.columns), ddl)
