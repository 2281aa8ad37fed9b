"""Registered queries against DuckDB, and the pipeline against plain versions."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_mod
import corpus_pipeline
from runlens.llm.queries import ORACLE, QUERIES
from runlens.llm.store import saved
from runlens.plans.compare import compare, duckdb_conn
from tests.conftest import SF_SMALL
from tests.llm.conftest import order_of
from tests.llm.test_dedup import WORD, shingles
from tests.llm.test_text import PATH, TERM, lower


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query(spark, key):
    df = QUERIES[key](spark, SF_SMALL)
    if key in ORACLE:
        r = compare(df, duckdb_conn(SF_SMALL), ORACLE[key])
        assert r["ok"], r
    elif not key.startswith("op12_"):  # compared with brute force in their own tests
        assert df.count() >= spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()


def test_all_are_registered():
    names = entry_mod.queries()
    assert "pipeline" in names
    assert all(any(k.startswith(f"op{n}_") for k in names) for n in range(1, 14))


def near(rows):
    sets = [shingles(r[1], 5) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                root[find(i)] = find(j)
    low = {}
    for i, r in enumerate(rows):
        low[find(i)] = min(low.get(find(i), order_of(None)), order_of(r[0]))
    stay = {r[0] for i, r in enumerate(rows) if not sets[i] or low[find(i)] == order_of(r[0])}
    return [r for r in rows if r[0] in stay]


def cut(rows):
    first = {}
    for doc_id, text, *_ in rows:
        w = WORD.findall(text or "")
        for i in range(len(w) - 12):
            first[tuple(w[i:i + 13])] = min(first.get(tuple(w[i:i + 13]), order_of(None)), order_of(doc_id))
    out = []
    for r in rows:
        w = WORD.findall(r[1] or "")
        gone = {j for i in range(len(w) - 12) if first[tuple(w[i:i + 13])] < order_of(r[0]) for j in range(i, i + 13)}
        if not w or len(gone) < len(w):
            out.append((r[0], [x for i, x in enumerate(w) if i not in gone], not gone, r))
    return out


def as_set(df):
    return sorted(map(str, df.collect()))


def test_pipeline_stages(spark, docs, corpus, tmp_path):
    stage = dict(corpus_pipeline.STAGES)
    items = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    leak = items.first().text
    rows = corpus + [(9_000, "before it " + leak + " and after", "en", "s0", 1)]
    frame = spark.createDataFrame(rows, docs.schema)
    seen = {}

    def passed(name, df):
        stage[name](spark, df, SF_SMALL).write.parquet(str(tmp_path / name))
        seen[name] = spark.read.parquet(str(tmp_path / name))
        return seen[name]

    kept = passed("language", frame)
    rows = [r for r in rows if any(c.isalpha() for c in r[1] or "")]
    assert as_set(kept) == as_set(spark.createDataFrame(rows, docs.schema))
    kept = passed("near_duplicates", kept)
    rows = near(rows)
    assert as_set(kept) == as_set(spark.createDataFrame(rows, docs.schema))
    kept = passed("substrings", kept)
    want = cut(rows)
    got = [(r.doc_id, WORD.findall(r.text or ""), r.lang, r.source) for r in kept.collect()]
    assert sorted(map(str, got)) == sorted(str((i, w, r[2], r[3])) for i, w, _, r in want)
    assert {r.text for r in kept.collect()} >= {r[1] for _, _, same, r in want if same}
    kept = passed("decontamination", kept)
    windows = {tuple(w[i:i + 10]) for r in items.collect() for w in [TERM.findall(lower(r.text))] for i in range(max(1, len(w) - 9))}

    def clean(text):
        w = TERM.findall(lower(text))
        return not any(tuple(w[i:i + n]) in windows for n in {len(p) for p in windows} for i in range(len(w) - n + 1))

    before = seen["substrings"].collect()
    assert as_set(kept) == sorted(str(r) for r in before if clean(r.text))
    assert 9_000 not in {r.doc_id for r in kept.collect()} and kept.count() < len(before)
    assert kept.columns == docs.columns
    packed = passed("packing", kept).collect()
    from runlens.llm import vocab

    ids = sum(len(vocab.word_tokenizer(PATH).tokenizer.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in kept.collect())
    assert sum(p.length for p in packed) == ids


def test_pipeline_keeps_columns_of_any_name(spark, docs):
    names = ["lang_pred", "score", "n_words", "n_removed", "kept_text", "factors", "n_hit", "contaminated", "item_ids"]
    frame = docs.select("*", *[F.concat(F.lit(f"{n} of "), F.col("n_chars")).alias(n) for n in names])
    plain = frame
    for name, stage in corpus_pipeline.STAGES[:4]:
        frame, plain = stage(spark, frame, SF_SMALL), stage(spark, plain.drop(*names), SF_SMALL)
        assert set(frame.columns) == set(docs.columns) | set(names)
        frame, plain = saved(frame), saved(plain)
        rest = [c for c in docs.columns if c != "n_chars"]
        assert as_set(frame.select(*rest)) == as_set(plain.select(*rest))
    for r in frame.where("doc_id is not null and n_chars is not null").collect():
        assert r.n_words is None or r.n_words.startswith("n_words of ")


def test_pipeline_of_nothing(spark, empty, tmp_path):
    df = empty
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, df, SF_SMALL).write.parquet(str(tmp_path / name))
        df = spark.read.parquet(str(tmp_path / name))
    assert df.count() == 0


def test_pipeline_query(spark):
    out = entry_mod.queries()["pipeline"](spark, SF_SMALL)
    assert out.count() > 0 and "sequence_id" in out.columns


def test_names_are_contracts():
    assert all(re.fullmatch(r"op\d+_\w+", k) for k in QUERIES)
