"""Chat formatting, language ID, benchmark index, token scan, packing, rules, sharding."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from runlens.llm import chat, langid, maglev, posindex, riskrules, tokscan, vecpack, vocab
from runlens.llm.queries import held_out
from runlens.llm.store import saved

# chat -------------------------------------------------------------------------

NASTY = st.text(alphabet="<|>\\\nim_endstar a{}%é", max_size=40)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "a\nb\\|<|"]), NASTY), max_size=5))
def test_formatting_reads_back(turns):
    render = chat.compile_template(chat.CHATML)
    text, marks = render([{"role": r, "text": t} for r, t in turns])
    assert chat.read_back(text) == turns
    assert [chat.unescaped(text[a:b]) for a, b in marks] == [t for r, t in turns if r == "assistant"]


def test_template_language():
    run = chat.compile_template("{# note #}{% for m in messages %}{% if not loop.first %}, {% endif %}{{ m['role'] | upper + ':' }}"
                                "{% if m.text == none or m.text == '' %}-{% elif m.text == 'x' and true %}X{% else %}{{ m.text }}{% endif %}"
                                "{% endfor %}{%- if add %}  <end>{% endif %}")
    assert run([{"role": "a", "text": "x"}, {"role": "b", "text": None}, {"role": "c", "text": "y"}], add=True)[0] == "A:X, B:-, C:y  <end>"


def test_constants_fold():
    tree = chat.fold(chat.parse("{% if 'a' + 'b' == 'ab' %}yes{{ 1 }}{% else %}{{ x }}{% endif %}{{ 'z' | upper }}"))
    assert tree.body == [chat.Emit(chat.Const("yes1Z"))]


@pytest.mark.parametrize("bad", ["{% for x %}", "{% if a %}", "{{ a | nope }}", "{% endif %}", "{{ a.__class__ }}", "{{ import('os') }}", "{{ 'a }}"])
def test_bad_templates_are_refused(bad):
    with pytest.raises(chat.TemplateError):
        chat.compile_template(bad)


def test_conversations_with_nulls(spark):
    rows = [(1, 1, "assistant", None), (1, 0, "user", "hi"), (1, None, None, "first"), (2, 0, "assistant", "ok <|im_end|>"),
            (None, 0, "user", "n"), (2, 0, "assistant", "ok <|im_end|>")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("messages", F.lit(1))
    got = {r.conv_id: r for r in chat.digests(chat.format_conversations(df)).collect()}
    said = "\nfirst\nuser\nhi\nassistant\n\n"
    assert got[1].turns_sha256 == hashlib.sha256(said.encode()).hexdigest() and got[1].loss_chars == 0
    assert got[2].n_turns == 2 and got[2].loss_chars == 26 and got[None].n_turns == 1
    assert chat.digests(chat.format_conversations(df.limit(0))).count() == 0


# language ID ------------------------------------------------------------------

def test_language_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(docs.where(~held_out()))
    out = langid.predict(docs.where(held_out()), model)
    right = out.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right > 0.98
    assert out.where("score < 0 or score > 1").count() == 0


def test_a_rare_language_is_learned(spark, monkeypatch):
    monkeypatch.setattr(langid, "LEAST_UNITS", 10, raising=False)
    often, rare = ["".join(p) for p in zip("abcdefgh" * 5, "ijklmnop" * 4 + "qrstuvwx", "abcde" * 8)], ["zyzy", "yzyy", "zzyz"]
    rows = [(i, " ".join(often[(i + k) % 40] for k in range(12)), "en") for i in range(2000)]
    rows += [(10_000 + i, " ".join(rare), "xx") for i in range(4)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), sample=100, units=30)
    assert model.languages == ["en", "xx"] and set(rare) <= set(model.words)
    assert all(model.words[w][1] > model.words[w][0] for w in rare)


def test_a_small_share_is_not_nothing(spark, monkeypatch):
    monkeypatch.setattr(langid, "LEAST_SAMPLE", 1, raising=False)
    docs = spark.range(50_000_000).select(F.col("id").alias("doc_id"), F.lit("some words").alias("text"), F.lit("en").alias("lang"))
    # less than one in a million
    assert langid.fit(docs, sample=40).languages == ["en"]


def test_language_backs_off_to_shorter_grams():
    model = langid.Model(["a", "b"], {"known": (1.0, -1.0)}, {"^xy$": (3.0, -3.0), "x": (0.0, 2.0), "yz": (5.0, 0.0)})
    assert model.word_score("known") == (1.0, -1.0)
    assert model.word_score("xy") == (3.0, -3.0)  # a 4-gram
    assert model.word_score("ayz") == (5.0, 0.0)  # no longer one: a 2-gram
    assert model.word_score("qx") == (0.0, 2.0)
    assert model.word_score("qq") == (0.0, 0.0)


def test_language_cases(spark, docs, empty):
    model = langid.fit(docs)
    out = langid.predict(docs.withColumn("score", F.lit("x")), model)
    for r in out.collect():
        has = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not has) and 0 <= r.score <= 1 and (has or r.score == 0)
    assert out.count() == docs.count()
    assert langid.predict(empty, model).count() == 0
    none = langid.fit(empty)
    assert {r.lang_pred for r in langid.predict(docs, none).collect()} == {"und"}


# benchmark index --------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


@pytest.fixture(scope="module")
def items(spark, corpus):
    by = {r[0]: r[1] for r in corpus}
    w = TERM.findall(lower(by[14]))
    rows = [(1, " ".join(w[3:25]).upper()), (2, "Two WORDS"), (10, " ".join(w[10:22])), (4, None), (5, "--"), (None, " ".join(w[5:16])),
            (2, "Two WORDS"), (7, "a b c a b c a b c a b c"), (8, "never seen words " * 5), (9, "free words")]
    return spark.createDataFrame(rows, "item_id long, text string"), rows


def test_decontamination_matches_brute_force(docs, corpus, items):
    frame, rows = items
    windows = set()
    for item, text in rows:
        w = TERM.findall(lower(text))
        for i in range(max(1, len(w) - 9) if w else 0):
            windows.add((item, tuple(w[i:i + 10])))
    want = Counter()
    for doc_id, text, *_ in corpus:
        w = TERM.findall(lower(text))
        hit, ids = set(), set()
        for item, p in windows:
            for i in range(len(w) - len(p) + 1):
                if tuple(w[i:i + len(p)]) == p:
                    hit.update(range(i, i + len(p)))
                    ids.add(item)
        ids = tuple(sorted(str(i) for i in ids if i is not None))
        want[(doc_id, text, len(w), len(hit), len(ids), ids, bool(hit))] += 1
    for some in (docs, docs.withColumns({"n_hit": F.lit("x"), "words": F.lit("y"), "at": F.lit(1)})):
        got = Counter((r.doc_id, r.text, r.n_words, r.n_hit, r.n_items, tuple(r.item_ids), r.contaminated)
                      for r in posindex.decontaminate(some, frame).collect())
        assert got == want
    assert sum(k[-1] for k in want) >= 3


def test_decontamination_by_shuffle(docs, items, monkeypatch):
    want = sorted(map(str, posindex.decontaminate(docs, items[0]).collect()))
    monkeypatch.setattr(posindex, "BROADCAST_ROWS", 0)
    assert sorted(map(str, posindex.decontaminate(docs, items[0]).collect())) == want


def test_decontamination_of_nothing(docs, empty, items):
    frame, _ = items
    assert posindex.decontaminate(empty, frame).count() == 0
    assert posindex.decontaminate(docs, frame.limit(0)).where("contaminated").count() == 0


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "zeta one two three four alpha"), (2, "alpha " + "pad " * 40 + "zeta"), (3, "alpha zeta")], "doc_id long, text string")
    items = spark.createDataFrame([(5, "alpha zeta")], "item_id long, text string")
    got = {r.doc_id for r in posindex.proximity_matches(docs, items, within=6).collect()}
    assert got == {1, 3}


# tokens -----------------------------------------------------------------------

PATH = vocab.public_path("word_bpe_49k.json")


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.characters(max_codepoint=0x250), st.sampled_from("ΣΑ日 ́ 'st<|endoftext|>")), max_size=30), max_size=4))
def test_ids_are_the_tokenizers(texts):
    for special in (False, True):
        own = vocab.word_tokenizer(PATH, special)
        texts = texts + ["it's a <|endoftext|> b", "ÀÉ 12½ß"]
        ids, at = own.encode(texts)
        for i, t in enumerate(texts):
            assert ids[at[i]:at[i + 1]].tolist() == own.tokenizer.encode(t, add_special_tokens=False).ids


def test_token_counts_match(docs, corpus, empty):
    own = vocab.WordTokenizer(PATH, True)
    want = Counter((r[0], len(own.tokenizer.encode(r[1] or "", add_special_tokens=False).ids)) for r in corpus)
    for block in (16, 1 << 16):
        out = tokscan.count_tokens(docs, PATH, 49_407, block=block)
        assert Counter((r.doc_id, r.n_tokens) for r in out.collect()) == want
    assert tokscan.count_tokens(empty, PATH, 49_407).count() == 0


def test_scan_of_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tokscan, "GROUP", 4)  # many groups of blocks
    rng = np.random.default_rng(2)
    want = Counter()
    for k in range(3):
        ids = rng.integers(0, 12, 900).astype("<u2") if k < 2 else np.zeros(0, "<u2")
        ids[200:600] += 1  # a document over many blocks
        ids.tofile(tmp_path / f"{k}.bin")
        ends = np.flatnonzero(ids == 0)
        begin = np.append(0, ends + 1)
        for i, e in enumerate(ends):
            want[(i, int(begin[i]), int(e - begin[i]), True)] += 1
        if len(ids) > begin[-1]:
            want[(len(ends), int(begin[-1]), int(len(ids) - begin[-1]), False)] += 1
    blocks = tokscan.read_flat_files(spark, str(tmp_path), block=16)
    out = tokscan.documents(tokscan.scan_blocks(blocks, 0).select("file_id", "block", "n_tokens", "ends"))
    assert Counter((r.number, r.first_token, r.n_tokens, r.complete) for r in out.collect()) == want


# packing ----------------------------------------------------------------------

def check_sequences(pieces, limits):
    by = {}
    for p in pieces:
        by.setdefault(p.sequence_id, []).append(p)
    for group in by.values():
        group.sort(key=lambda p: p.offset)
        at = 0
        for p in group:
            assert p.offset == at and p.length > 0
            at += p.length
        assert at <= limits[0] and len(group) <= limits[1]
    return by


def test_packed_documents(docs, corpus, empty):
    limits = (256, 8, 256)
    pieces = vecpack.pack_documents(docs, PATH, 2, limits=limits).collect()
    by = check_sequences(pieces, limits)
    own = vocab.WordTokenizer(PATH)
    want = Counter()
    for r in corpus:
        ids = own.tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [2]
        want.update((r[0], i, x) for i, x in enumerate(ids))
    got = Counter()
    for p in pieces:
        ids = np.frombuffer(p.ids, "<u4")
        assert len(ids) == p.length and p.start + p.length <= p.doc_tokens
        got.update((p.doc_id, p.start + i, int(x)) for i, x in enumerate(ids))
    assert got == want
    lengths = [sum(p.length for p in g) for g in by.values()]
    padding = sum(0 if n & (n - 1) == 0 else limits[0] - n for n in lengths)
    assert padding < 0.05 * sum(lengths)
    assert vecpack.pack_documents(empty, PATH, 2).count() == 0


@pytest.mark.parametrize("text", ["one", "", "a b c"])
def test_tiny_documents_fill_sequences(spark, text):
    df = spark.range(9000).select(F.col("id").alias("doc_id"), F.lit(text).alias("text")).coalesce(1)
    pieces = vecpack.pack_documents(df, PATH, 2).select("doc_id", "sequence_id", "length").collect()
    sizes = Counter()
    for p in pieces:
        sizes[p.sequence_id] += p.length
    padding = sum(0 if n & (n - 1) == 0 else 4096 - n for n in sizes.values())
    assert padding < 0.05 * sum(sizes.values()) and len({p.doc_id for p in pieces}) == 9000 and max(sizes.values()) <= 4096


def test_the_packer_takes_the_largest_dot_product():
    """Every piece that is not cut, against a plain search of all pending
    examples that fit."""
    rng = np.random.default_rng(12)
    limits = (100, 6, 60)
    examples = [(i, 0, int(t), int(t * rng.random())) for i, t in enumerate(rng.integers(1, 60, 80))]
    packer = vecpack.Packer(limits)
    pieces = packer.add(examples) + packer.finish()
    size = {e[0]: (e[2], 1, e[3]) for e in examples}
    pending = set(size)
    for sequence in sorted({p[3] for p in pieces}):
        room = np.array(limits, float)
        for key, *_ in sorted((p for p in pieces if p[3] == sequence), key=lambda p: p[4]):
            fits = {k: sum(a / l * r / l for a, r, l in zip(size[k], room, limits)) for k in pending if (np.array(size[k]) <= room).all()}
            assert fits[key] >= max(fits.values()) - 1e-12
            pending.remove(key)
            room -= size[key]
        assert not any((np.array(size[k]) <= room).all() for k in pending)
    assert not pending


def test_packed_examples_keep_all_limits(spark):
    rng = np.random.default_rng(4)
    rows = [(i, int(t), int(t * rng.random())) for i, t in enumerate(rng.integers(1, 900, 500))] + [(500, 0, 0), (501, None, None)]
    df = spark.createDataFrame(rows, "id long, tokens long, loss long").repartition(2)
    limits = (1024, 4, 500)
    small = df.where("coalesce(loss, 0) <= 500")
    pieces = vecpack.pack_examples(small, "id", "tokens", "loss", limits).collect()
    by = check_sequences(pieces, limits)
    loss = {r[0]: r[2] for r in rows}
    assert all(sum(loss[p.id] for p in g) <= 500 for g in by.values())
    assert Counter(p.id for p in pieces) == Counter(r.id for r in small.where("tokens > 0").collect())


# quality rules ----------------------------------------------------------------

def test_counts_match_brute_force(docs, corpus):
    word = re.compile(r"[^\x20\x09-\x0D]+")
    want = Counter()
    for doc_id, text, *_ in corpus:
        text = text or ""
        w = word.findall(text)
        n = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
        cover = {j for i in range(len(w) - 7) if n[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
        lines = [x for x in text.split("\n") if word.search(x)]
        want[(doc_id, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(cover))] += 1
    out = riskrules.judge(docs, docs.selectExpr("doc_id", "cast(doc_id % 2 as int) as quality").limit(0))
    rows = out.collect()
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows) == want
    for r in rows:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert r.kept == (not r.base_failed)  # no labels, no learned rule


def test_binomial_tail_is_exact(spark):
    cases = [(n, k, p) for n in (1, 10, 300, 20_000) for p in (0.002, 0.05, 0.3) for k in range(0, 40, 3) if k < n * p]
    for p in {c[2] for c in cases}:
        rows = [(n, k) for n, k, q in cases if q == p]
        df = spark.createDataFrame(rows, "n long, k long")
        for r in df.select("n", "k", riskrules.binomial_tail(F.col("n"), F.col("k"), p).alias("t")).collect():
            want = math.fsum(math.exp(math.lgamma(r.n + 1) - math.lgamma(j + 1) - math.lgamma(r.n - j + 1)
                                      + j * math.log(p) + (r.n - j) * math.log1p(-p)) for j in range(r.k + 1))
            assert r.t == pytest.approx(want, rel=1e-6)


def test_learned_cutoffs_spare_good_documents(spark):
    rows = []
    for i in range(6000):
        bad = i % 4 == 0
        words = " ".join(["word%d" % (i * 31 + j) for j in range(30)])
        rows.append((i, words + (" # $ % &" * 3 if bad else " #" if i % 7 == 0 else ""), "en" if i % 2 else None, int(not bad)))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, quality int")
    out = {r.doc_id: r.kept for r in riskrules.judge(df.drop("quality"), df.select("doc_id", "quality"), alpha=0.05).collect()}
    good = [out[r[0]] for r in rows if r[3]]
    bad = [out[r[0]] for r in rows if not r[3]]
    assert sum(good) >= 0.95 * len(good) and sum(bad) < 0.05 * len(bad)


def plain_cutoffs(rows, alpha, delta):
    """rows: (stratum, good, train, {rule: cell}); (stratum, rule) -> cell."""
    def tail(n, k, p):
        return math.fsum(math.exp(math.lgamma(n + 1) - math.lgamma(j + 1) - math.lgamma(n - j + 1)
                                  + j * math.log(p) + (n - j) * math.log1p(-p)) for j in range(k + 1))

    out, strata = {}, {r[0] for r in rows}
    tested = {r[0] for r in rows if not r[2]}
    for stratum in strata:
        train = [r for r in rows if r[0] == stratum and r[2]]
        held = [r for r in rows if r[0] == stratum and not r[2]]
        n_good, n_bad = (sum(r[1] == g for r in held) for g in (True, False))
        path = {}
        for rule in riskrules.GRID:
            lowest = float("inf")
            for cell in sorted({r[3][rule] for r in train}):
                good, bad = ((sum(r[1] == g and r[3][rule] >= cell for r in train) + 1) / (sum(r[1] == g for r in train) + 1)
                             for g in (True, False))
                lowest = min(lowest, good / bad)
                if cell > 0 and lowest < 1:
                    level = max(0, math.ceil((math.log10(lowest) / riskrules.DECADES + 1) * riskrules.LEVELS - 1e-9))
                    path.setdefault(rule, []).append((cell, level))
        best = None
        for level in range(riskrules.LEVELS + 1):
            limit = {rule: min((c for c, x in steps if x <= level), default=None) for rule, steps in path.items()}
            gone = [any(c is not None and r[3][rule] >= c for rule, c in limit.items()) for r in held]
            k = sum(g and r[1] for g, r in zip(gone, held))
            if not (k < n_good * alpha and tail(n_good, k, alpha) <= delta / len(tested)):
                break
            gain = sum(g and not r[1] for g, r in zip(gone, held)) / max(1, n_bad) - k / max(1, n_good)
            if gain > 0 and (best is None or gain > best[0]):
                best = (gain, limit)
        for rule, cell in (best[1] if best else {}).items():
            if cell is not None:
                out[stratum, rule] = (cell - 1) * riskrules.GRID[rule][0]
    return out


def labelled_rows(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").select("doc_id", F.col("lang").alias("stratum"), "text")
    said = spark.read.parquet(f"/root/testdata/{sf}/labels.parquet").where("quality is not null").groupBy("doc_id").agg(
        (F.max("quality") == 1).alias("good"))
    stats = saved(riskrules.counts(docs).drop("text"))
    return stats.where(~riskrules.base_failed()).join(said, "doc_id").withColumn("train", riskrules.trains("doc_id"))


@pytest.mark.parametrize("sf, alpha", [("sf0.01", 0.2), ("sf0.1", riskrules.ALPHA)])
def test_cutoffs_against_a_plain_search(spark, sf, alpha):
    frame = labelled_rows(spark, sf).cache()
    names = list(riskrules.GRID)
    rows = [(r.stratum, r.good, r.train, {n: r[n] for n in names}) for r in frame.select(
        "stratum", "good", "train", *[c.alias(n) for n, c in riskrules.cells().items()]).collect()]
    got = {(r.stratum, r.rule): r.cutoff for r in riskrules.cutoffs(frame, alpha).collect()}
    assert got and got == plain_cutoffs(rows, alpha, riskrules.DELTA)


def test_numerals_are_no_letters():
    assert langid.letters("½ ① ² Ⅷ 12_3") == [] and langid.letters("a½b Ⅷx É") == ["a", "b", "x", "é"]


def test_rules_on_nothing(docs, empty):
    labels = empty.selectExpr("doc_id", "cast(null as int) as quality")
    assert riskrules.judge(empty, labels).count() == 0
    assert riskrules.judge(docs, labels).count() == docs.count()


# sharding ---------------------------------------------------------------------

def test_lookup_table():
    shards = [f"s{i}" for i in range(7)]
    table = maglev.fill(shards, 1009)
    share = Counter(table)
    assert set(share) == set(range(7)) and max(share.values()) - min(share.values()) <= 1
    fewer = maglev.fill(shards[:-1], 1009)
    moved = sum(a != b for a, b in zip(table, fewer) if a != 6)
    assert moved < 0.25 * 1009
    assert maglev.fill(["only"], 13) == [0] * 13
    for bad in ([], ["a", "a"]):
        with pytest.raises(ValueError):
            maglev.fill(bad, 13)
    with pytest.raises(ValueError):
        maglev.fill(shards, 1000)


def test_placement(docs, empty):
    shards = [f"s{i}" for i in range(5)]
    table = maglev.fill(shards, 1009)
    for r in maglev.place(docs.withColumn("slot", F.lit("x")), "doc_id", shards, 1009).collect():
        key = "" if r.doc_id is None else str(r.doc_id)
        assert r.slot == int(hashlib.md5(key.encode()).hexdigest()[:15], 16) % 1009 and r.shard == shards[table[r.slot]]
    assert maglev.place(empty, "doc_id", shards).count() == 0


def test_crc_of_pieces(spark):
    ids = np.array([1, 70_000], "<u4").tobytes()
    assert spark.sql("select 1").select(F.crc32(F.lit(ids))).first()[0] == zlib.crc32(ids)
