"""Substring dedup (words and bytes) and the similarity join against plain versions."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from runlens.llm import components, radix, rlz, sigtree
from runlens.llm import textops as T
from tests.llm.conftest import LAST, order_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("chunks", [None, 7])
def test_rlz_matches_brute_force(docs, corpus, chunks, monkeypatch):
    if chunks:
        monkeypatch.setattr(rlz.B, "layout", lambda total: chunks)
    first = {}
    for doc_id, text, *_ in corpus:
        w = WORD.findall(text or "")
        for i in range(len(w) - 12):
            key = tuple(w[i:i + 13])
            first[key] = min(first.get(key, LAST), order_of(doc_id))
    want = Counter()
    for doc_id, text, lang, source, n in corpus:
        w = WORD.findall(text or "")
        gone = set()
        for i in range(len(w) - 12):
            if first[tuple(w[i:i + 13])] < order_of(doc_id):
                gone.update(range(i, i + 13))
        want[(doc_id, text, lang, source, n, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone))] += 1
    got = Counter()
    texts = {}
    for doc_id, text, *_ in corpus:
        texts.setdefault(order_of(doc_id), []).append(WORD.findall(text or ""))
    for r in rlz.dedup_substrings(docs).collect():
        # a factor is one piece of its reference, and could not go on where
            # the next phrase occurs once there
        own = WORD.findall(r.text or "")
        for f in r.factors:
            piece = own[f.start:f.start + f.n_words]
            assert any(w[f.ref_start:f.ref_start + f.n_words] == piece for w in texts[f.ref_doc])
            nxt = tuple(own[f.start + f.n_words - 12:f.start + f.n_words + 1])
            there = sum(tuple(w[i:i + 13]) == nxt for w in texts[f.ref_doc] for i in range(len(w) - 12))
            if len(nxt) == 13 and first[nxt] == f.ref_doc and there == 1:
                assert any(w[f.ref_start:f.ref_start + f.n_words + 1] != own[f.start:f.start + f.n_words + 1] for w in texts[f.ref_doc])
        kept = " ".join(WORD.findall(r.kept_text))
        got[(r.doc_id, r.text, r.lang, r.source, r.n_chars, r.n_words, r.n_removed, kept)] += 1
        cover = {i for f in r.factors for i in range(f.start, f.start + f.n_words)}
        assert len(cover) == r.n_removed and all(f.n_words >= 13 and f.ref_doc < order_of(r.doc_id) for f in r.factors)
        if r.n_removed == 0:
            assert r.kept_text == (r.text or "")
    assert got == want


def test_rows_without_id_use_many_chunks(spark):
    df = spark.createDataFrame([(None, f"text {i}") for i in range(1000)], "doc_id long, text string")
    rows = rlz.B.chunked(df, "doc_id", 50, spread_by="text")
    assert rows.select(rlz.B.CHUNK).distinct().count() > 40


def test_radix_matches_brute_force(docs, corpus):
    n = 100
    rows = sorted(corpus, key=lambda r: (order_of(r[0]), r[1] or ""))
    seen, want = set(), Counter()
    for doc_id, text, *_ in rows:
        b = (text or "").encode()
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - n + 1):
            if b[i:i + n] in seen:
                gone[i:i + n] = True
            seen.add(b[i:i + n])
        spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()) if len(b) else 0
        want[(doc_id, len(b), int(gone.sum()), spans, bytes(x for x, g in zip(b, gone) if not g))] += 1
    got = Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept_bytes)) for r in radix.dedup_bytes(docs).collect())
    # copies under one id: which of equal rows counts as first is fixed, not named
    assert got == want


@pytest.mark.parametrize("most", [20_000, 3, 0])
def test_radix_over_many_chunks(docs, corpus, most, monkeypatch):
    monkeypatch.setattr(radix.B, "layout", lambda total: 7)
    monkeypatch.setattr(radix, "HOT_RUNS", most)
    test_radix_matches_brute_force(docs, corpus)


def test_radix_spreads_the_runs_of_a_common_line(monkeypatch):
    # a common line between different neighbours: one anchor, a run a document
    rng, line = np.random.default_rng(2), "a line that all of the documents have, of some length " * 2
    texts = ["".join(map(chr, rng.integers(97, 123, 120))) + line + "".join(map(chr, rng.integers(97, 123, 120))) for _ in range(60)]
    tables = [radix.pa.table({radix.B.CHUNK: [c] * 10, radix.B.ORDER: list(range(c * 10, c * 10 + 10)), "text": texts[c * 10:c * 10 + 10]})
              for c in range(6)]
    anchors = radix.pa.concat_tables([radix._send_anchors("text", 100, 1)(t) for t in tables])
    told = radix._shared_anchors(20)(anchors)
    sent = radix.pa.concat_tables([radix._send_runs("text", 100, 8)(t, told.filter(radix.pa.compute.equal(told.column(radix.B.CHUNK), c)))
                                   for c, t in enumerate(tables)])
    assert max(Counter(radix.B.gathered(sent, "keys", np.uint64).tolist()).values(), default=0) <= 20
    windows = [len(radix.B.gathered(sent.filter(radix.pa.compute.equal(sent.column("block"), b)), "windows", np.uint64)) for b in range(8)]
    assert min(windows) > 0 and max(windows) < sum(windows) / 3


def test_radix_groups_are_the_equal_windows():
    rng = np.random.default_rng(3)
    buf = rng.integers(0, 2, 400).astype(np.uint8)
    at = np.arange(380)
    group = radix.radix_groups(buf, at, np.zeros(380, np.int64), 13)
    by = {}
    for i in at.tolist():
        by.setdefault(buf[i:i + 13].tobytes(), []).append(i)
    for spots in by.values():
        found = set(group[spots].tolist())
        assert len(found) == 1 and (found == {-1}) == (len(spots) == 1)
    assert len(set(group[group >= 0].tolist())) == sum(len(s) > 1 for s in by.values())


def shingles(text, size):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1)))


@pytest.mark.parametrize("size,percent", [(4, 85), (5, 80), (1, 60)])
def test_join_matches_brute_force(docs, corpus, size, percent, monkeypatch):
    if size == 1:  # many groups cut into blocks
        monkeypatch.setattr(sigtree, "GROUP_SHINGLES", 200)
    sets = [shingles(r[1], size) for r in corpus]
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    low = {}
    for i, r in enumerate(corpus):
        k = find(i)
        low[k] = min(low.get(k, LAST), order_of(r[0]))
    # a row without shingles is its own component
    want = Counter((r[0], len(sets[i]), (low[find(i)] if sets[i] else order_of(r[0]))) for i, r in enumerate(corpus))
    got = Counter((r.doc_id, r.n_shingles, order_of(r.component_id))
                  for r in sigtree.link_documents(docs, size=size, percent=percent).collect())
    assert got == want


@pytest.mark.parametrize("most", [200_000, 0])
def test_texts_under_one_id_are_linked_apart(spark, most, monkeypatch):
    monkeypatch.setattr(sigtree, "BROADCAST_ROWS", most)
    words = [[f"{c}{i}" for i in range(60)] for c in "abcdef"]

    def near(w, k=1):
        return " ".join([*w[:-k], *["other"] * k])

    a, b, c, d, e, f = (" ".join(w) for w in words)
    rows = [(5, a), (None, near(words[0])), (None, b), (None, near(words[1])), (7, c), (9, near(words[2])), (9, d), (11, near(words[3])),
            (None, e), (None, e), (3, f), (3, f), (12, e + " more")]
    want = [(3, 3), (3, 3), (5, 5), (7, 7), (9, 7), (9, 9), (11, 9), (12, 12), (LAST, 5), (LAST, 12), (LAST, 12), (LAST, LAST), (LAST, LAST)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sigtree.link_documents(docs).collect()
    assert sorted((order_of(r.doc_id), order_of(r.component_id)) for r in got) == want


def test_one_id_does_not_drop_unlinked_texts(spark):
    a, b = (" ".join(f"{c}{i}" for i in range(60)) for c in "ab")
    rows = [(5, a, "en", "s", 1), (None, a + " more", "en", "s", 1), (None, b, "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r.text for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()}
    assert b in kept and a in kept


def test_tree_finds_every_component():
    rng = np.random.default_rng(5)
    base = [np.unique(rng.integers(0, 1 << 40, 60).astype(np.uint64)) for _ in range(8)]
    sets = []
    for _ in range(300):
        b = base[rng.integers(8)]
        keep = rng.random(len(b)) > 0.08
        sets.append(np.unique(np.append(b[keep], rng.integers(0, 1 << 40, 3).astype(np.uint64))))
    label = sigtree.traverse(sets, np.zeros(300, int), 80)
    left, right = zip(*[(i, j) for i in range(300) for j in range(i) if sigtree.linked(sets[i], sets[j], 80)])
    nodes, roots = components.local(np.array(left), np.array(right))
    want = np.arange(300)
    want[nodes] = roots
    assert {(want == x).tobytes() for x in want} == {(label == x).tobytes() for x in label}


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 101), (7, 7), (200, 100)]
    got = {r.node: r.root for r in components.smallest(spark.createDataFrame(edges, "left long, right long")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 101: 100, 102: 100, 200: 100}
    assert components.smallest(spark.createDataFrame([], "left long, right long")).count() == 0


def test_empty_tables_and_clashing_columns(spark, docs, empty):
    assert rlz.dedup_substrings(empty).count() == 0
    assert radix.dedup_bytes(empty).count() == 0
    assert sigtree.link_documents(empty).count() == 0
    names = ["n_words", "n_removed", "kept_text", "factors", "block", "keys", "docs", "spans", "one", "cluster", "task", "n"]
    odd = docs.select("*", *[F.lit("x").alias(c) for c in names])
    assert {"block", "keys", "docs"} <= set(rlz.dedup_substrings(odd).columns)
    assert rlz.dedup_substrings(odd).where("block = 'x' and n_words >= 0").count() == docs.count()
    assert radix.dedup_bytes(odd).where("one = 'x' and n_bytes >= 0").count() == docs.count()
    assert sigtree.link_documents(odd).columns == ["doc_id", "n_shingles", "component_id"]


def test_only_nulls(spark):
    nulls = spark.createDataFrame([(None, None), (None, None), (1, None)], "doc_id long, text string")
    assert [r.n_words for r in rlz.dedup_substrings(nulls).collect()] == [0, 0, 0]
    assert [r.n_bytes for r in radix.dedup_bytes(nulls).collect()] == [0, 0, 0]
    assert sorted((order_of(r.doc_id), r.n_shingles) for r in sigtree.link_documents(nulls).collect()) == [(1, 0), (LAST, 0), (LAST, 0)]


def test_super_windows_share_anchors():
    rng = np.random.default_rng(1)
    symbols = T.mix(rng.integers(0, 3, 600).astype(np.uint64))
    row = np.repeat(np.arange(6), 100)
    sw = T.SuperWindows(symbols, row, 13, 5)
    at, run = sw.windows()
    assert len(at) == 6 * 88 and hashlib.sha256(at.tobytes()).digest()
    anchor = {}
    for s, r in zip(at.tolist(), run.tolist()):
        anchor.setdefault(symbols[s:s + 13].tobytes(), set()).add(int(sw.anchor[r]))
    assert all(len(a) == 1 for a in anchor.values())


def test_links_leave_no_shuffle_on_disk(spark, monkeypatch):
    """The shuffles of finished steps go at once, and where texts are
    shuffled only those in groups are."""
    import time

    from pyspark.sql import functions as F

    files = lambda: {f.getName() for f in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(
        spark._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()) if f.getName().startswith("shuffle_")}
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(words[i:i + 60]) for i in range(0, 300, 60)]
    data = [(i, t) for i, t in enumerate(texts * 2)] + [(100 + i, " ".join(f"u{i}x{j}" for j in range(40))) for i in range(60)]
    data += [(200 + i, t.replace(" ", f" extra{i} ", 1)) for i, t in enumerate(texts)] + [(300, None), (None, texts[0])]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    sort = lambda df: sorted((tuple(r) for r in df.collect()), key=str)
    want = sort(sigtree.link_documents(docs, size=3, percent=80))
    monkeypatch.setattr(sigtree, "BROADCAST_ROWS", 0)
    setting = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    before = files()
    out = sigtree.link_documents(docs, size=3, percent=80)
    for _ in range(100):
        left = files() - before
        if not left:
            break
        time.sleep(0.1)
    assert not left
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == setting
    assert sort(out) == want and {r[2] for r in want if r[0] in (0, 5, 200)} == {0}
    marks = docs.where("text is not null").select(F.xxhash64("text").alias(sigtree.MARK), "text")
    sent = sigtree.marked(marks, marks.where("text like 'w0 %' or text like 'w60 %'"))
    assert {r.text for r in sent.collect()} >= {texts[0], texts[1]} and sent.count() < 15
