"""Operators 11 to 13 against plain versions."""

import collections
import itertools
import math
import random
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from runlens.llm import audit, permindex, spelling
from tests.conftest import SF_SMALL
from tests.llm.conftest import order_of

WORD = re.compile("[^\x20\x09-\x0D]+")
LABELS = "doc_id long, quality int, toxic int"


# -- 11 -----------------------------------------------------------------------

def failures(rows):
    first = {}
    for doc_id, text, *_ in rows:
        first[text or ""] = min(first.get(text or "", order_of(None)), order_of(doc_id))
    out = []
    for doc_id, text, _, source, *_ in rows:
        t = text or ""
        w = WORD.findall(t)
        fails = [len(w) < 50, 100 * len(set(w)) < 65 * len(w), 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
                 re.search("[#$%&*|]", t) is not None, first[t] < order_of(doc_id)]
        out.append((doc_id, source or "", {"ABCDE"[i] for i, f in enumerate(fails) if f}))
    return out


def plain_audit(rows, labels):
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, t in labels if i is not None and t == 1}
    by_part, out = collections.defaultdict(list), {}
    for doc_id, part, fails in failures(rows):
        by_part[part].append((doc_id, fails))
    for part, docs in by_part.items():
        total = collections.Counter()
        for order in itertools.permutations("ABCDE"):
            left, seen = docs, set()
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                total[f] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(f in x and bool(x & seen) for _, x in docs), sum(x == {f} for _, x in docs),
                    sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone), f]
                seen.add(f)
        for key in out:
            if key[0] == part:
                out[key][-1] = total[out[key][-1]]
    return {k: tuple(v) for k, v in out.items()}


def test_audit_counts(spark, docs, corpus):
    rng = random.Random(3)
    extra = [(700 + i, " ".join(rng.choice(["Upper", "CASE", "low#", "x", "y"]) for _ in range(rng.choice([20, 60]))), "en",
              rng.choice(["s0", None, ""]), 1) for i in range(40)]
    extra += [(None, extra[0][1], "en", None, 1), (None, "only without id", "en", "s9", 1), (None, "only without id", "en", "s9", 1)]
    labels = [(i, i % 2, int(i % 5 == 0)) for i in range(0, 740, 3)] + [(3, 0, 1), (6, None, None), (None, 1, 1), (10**9, 1, 1)]
    frame = docs.unionByName(spark.createDataFrame(extra, docs.schema)).withColumns({"part": F.lit(1), "n": F.lit("x"), "mask": F.lit(7)})
    said = spark.createDataFrame(labels, LABELS).withColumn("__id", F.lit(0))
    got = {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in audit.audit(audit.failure_counts(frame, said)).collect()}
    assert got == plain_audit(corpus + extra, labels)


def test_audit_of_nothing(spark, empty):
    assert audit.audit(audit.failure_counts(empty, spark.createDataFrame([], LABELS))).count() == 0


def test_shapley_weights_are_those_of_all_orders():
    for n in (1, 2, 3, 5, 6):
        weights = audit.shapley_weights(n)
        for i in range(n):
            for s in range(1, 1 << n):
                k = s.bit_count()
                inside = math.factorial(k - 1) * math.factorial(n - k)
                outside = -math.factorial(k) * math.factorial(n - k - 1) if k < n else 0
                assert weights[i][s] == (inside if s >> i & 1 else outside)


def test_other_numbers_of_filters(spark):
    cells = spark.createDataFrame([("p", 1, 5, 2, 1), ("p", 3, 4, 1, 0), ("p", 0, 2, 2, 0)], "part string, mask int, n long, good long, toxic long")
    rows = {(r.filter_order, r.step): r for r in audit.audit(cells, "XY").collect()}
    assert len(rows) == 4 and rows["XY", 1].removed == 9 and rows["XY", 2].removed == 0 and rows["XY", 2].redundant == 4
    assert rows["YX", 1].removed == 4 and rows["YX", 2].good_lost == 2 and rows["YX", 2].kept == 2
    assert (rows["XY", 1].shapley, rows["XY", 2].shapley) == (9 + 5, 4 + 0) and rows["XY", 1].unique_fails == 5


# -- 12 -----------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int"


def plain_search(rows, wanted, k):
    ok = [(i, v) for i, (_, v) in enumerate(rows) if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    size = collections.Counter(len(v) for _, v in ok)
    ok = [(i, v) for i, v in ok if len(v) == max(size, key=lambda s: (size[s], s))]
    at = [i for i, _ in ok]
    x = np.array([v for _, v in ok], np.float32).astype(np.float64)
    out = collections.Counter()
    for n, i in enumerate(at):
        if rows[i][0] is None or not wanted(rows[i][0]):
            continue
        score = (x * x[n]).sum(1)
        order = sorted((m for m in range(len(at)) if m != n), key=lambda m: (-round(score[m], 9), order_of(rows[at[m]][0])))
        for rank, m in enumerate(order[:k], 1):
            out[rows[i][0], rank, rows[at[m]][0], round(score[m], 6)] += 1
    return out


def found(df):
    return collections.Counter((r.query_id, r["rank"], r.id, round(r.score, 6)) for r in df.collect())


def test_search_is_exact_where_all_rows_are_reranked(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in np.float32(rng.normal(size=6) * rng.uniform(0.1, 4))]) for i in range(150)]
    rows += [(200 + i, rows[7][1]) for i in range(30)] + [(7, rows[7][1]), (8, [1.0] * 6), (None, rows[3][1]), (None, [2.0] * 6)]
    rows += [(300, None), (320, []), (340, [0.0] * 6), (360, [1.0, None] * 3), (380, [float("nan")] * 6), (400, [float("inf")] * 6), (420, [1.0, 2.0])]
    frame = spark.createDataFrame([(*r, 0) for r in rows], VECTORS).repartition(3).withColumns({"row": F.lit(1), "block": F.lit(2)})
    index = permindex.build(frame, pivots=20, near=8, block=40)
    assert index.n_blocks > 3 and index.blocks.count() == index.n_blocks
    got = found(permindex.search(index, F.col("id") % 4 == 0, k=9, group=13))
    assert got == plain_search(rows, lambda i: i % 4 == 0, 9)


def test_few_and_no_vectors(spark):
    frame = spark.createDataFrame([(0, [1.0, 0.0], 0), (1, [0.5, 0.5], 0), (20, [0.0, 1.0], 0), (40, [0.0, 0.0], 0)], VECTORS)
    got = permindex.search(permindex.build(frame), F.col("id") % 20 == 0)
    assert sorted((r.query_id, r["rank"], r.id) for r in got.collect()) == [(0, 1, 1), (0, 2, 20), (20, 1, 1), (20, 2, 0)]
    assert permindex.build(frame.where("vec_id = 40")) is None


def test_footrule_order_finds_nine_of_ten(spark):
    """Isotropic vectors in 64 dimensions, a fifth of them reranked."""
    rng = np.random.default_rng(5)
    x = np.float32(rng.normal(size=(3000, 64)))
    frame = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], VECTORS)
    got = found(permindex.search(permindex.build(frame, block=1500), F.col("id") % 50 == 0, floor=0))
    y = x.astype(np.float64)
    hits = 0
    for q in range(0, 3000, 50):
        score = y @ y[q]
        score[q] = -np.inf
        best = set(np.argsort(-score)[:20].tolist())
        hits += len(best & {i for query, _, i, _ in got if query == q})
    assert hits >= 0.9 * 60 * 20


def test_pivots_of_a_common_vector():
    rng = np.random.default_rng(6)
    common = np.full(8, 8 ** -0.5)
    sample = np.array([common if i % 2 else v / np.linalg.norm(v) for i, v in enumerate(rng.normal(size=(100, 8)))])
    chosen = permindex.choose(sample, 30)
    assert len(chosen) == 30 and (chosen @ common > 0.999).sum() == 1


# -- 13 -----------------------------------------------------------------------

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_words(rows, least=7, slip=31):
    count = collections.Counter()
    for doc_id, text, *_ in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = w.translate(LOW)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{w}".encode())
            if h % slip == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            if len(w) >= least:
                count[w] += 1
    return {w: n for w, n in count.items() if n >= 2}


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_variants(count, times=10):
    near = {w: [v for v in count if is_near(w, v)] for w in count}
    form = {}
    for w in count:
        best = min(near[w], key=lambda v: (-count[v], v), default=None)
        form[w] = best if best is not None and count[best] >= times * count[w] else None
    out = []
    for w in count:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, count[w], len(near[w]), count[form[w]] if form[w] is not None else None))
    return sorted(out)


def variants(df):
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect())


def test_words_and_variants_of_documents(spark, docs, corpus):
    rng = random.Random(9)
    base = ["Straßenbahn", "ünderstand", "aaaaaaaab", "letterßßß", "wordsinrow", "×÷multiply"]
    extra = []
    for i in range(300):
        out = []
        for _ in range(30):
            w = rng.choice(base)
            if rng.random() < 0.2:
                p, kind = rng.randrange(len(w)), rng.randrange(3)
                w = w[:p] + ("" if kind == 0 else rng.choice("abcßé") + ("" if kind == 1 else w[p])) + w[p + 1:]
            out.append(w)
        extra.append((1000 + i, ",".join(out), None, None, None))
    extra += [(None, "x" * 300 + " " + "x" * 300 + "é " + "x" * 299, None, None, None)] * 2
    frame = docs.unionByName(spark.createDataFrame(extra, docs.schema)).withColumns({"word": F.lit(1), "n": F.lit(2)})
    count = plain_words(corpus + extra)
    words = spelling.word_counts(frame)
    assert {r.word: r.n for r in words.collect()} == count
    got = variants(spelling.group_variants(words))
    assert got == plain_variants(count)
    assert any(r[1] is not None and r[2] != r[1] for r in got) or any(r[1] is not None for r in got)


def test_variants_of_any_words(spark):
    rng = random.Random(1)
    count = {}
    for length in (1, 2, 3, 4, 5):
        for _ in range(60):
            count["".join(rng.choice("abé") for _ in range(length))] = rng.choice([1, 2, 10, 20, 150, 3000])
    frame = spark.createDataFrame(list(count.items()), "word string, n long").repartition(7)
    assert variants(spelling.group_variants(frame)) == plain_variants(count)
    assert variants(spelling.group_variants(frame, times=2)) == plain_variants(count, 2)
    # chains of forms
    assert any(form is not None and root != form for _, form, root, *_ in plain_variants(count, 2))


def test_node_numbers_stand_for_prefixes(spark):
    rng = random.Random(2)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randint(1, 9))) for _ in range(400)} | {"a" * 50, "a" * 51})
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # many partitions
    try:
        rows = spelling.numbered(spark.createDataFrame([(w,) for w in words], "word string")).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    number = {}
    for r in rows:
        assert len(r.nodes) == len(r.word) + 1
        for i, node in enumerate(r.nodes):
            assert number.setdefault(r.word[:i], node) == node
    assert len(set(number.values())) == len(number)
    assert [r.word for r in sorted(rows, key=lambda r: r["rank"])] == words


def test_variants_of_nothing(spark, empty):
    assert spelling.group_variants(spelling.word_counts(empty)).count() == 0


def test_queries_on_the_small_table(spark):
    from runlens.llm.queries import QUERIES

    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = variants(QUERIES["op13_spelling_variants"](spark, SF_SMALL))
    count = plain_words(rows)
    assert {r[0]: r[3] for r in got} == count
    near = collections.defaultdict(set)
    for w in count:
        for i in range(len(w)):
            near[w[:i], w[i + 1:]].add(w)
    for w, _, _, _, n_near, _ in got:
        same = set().union(*(near[w[:i], w[i + 1:]] for i in range(len(w)))) - {w}
        shorter = {w[:i] + w[i + 1:] for i in range(len(w))} & set(count)
        longer = set().union(*(near.get((w[:i], w[i:]), set()) for i in range(len(w) + 1)))
        assert n_near == len(same | shorter | longer)
    vectors = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select("vec_id", "embedding").collect()]
    near = collections.Counter((r.query_id, r["rank"], r.vec_id, round(r.score, 6)) for r in QUERIES["op12_nearest_vectors"](spark, SF_SMALL).collect())
    assert near == plain_search(vectors, lambda i: i % 20 == 0, 20)
