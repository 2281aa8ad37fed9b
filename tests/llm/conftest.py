import random

import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(rng, words, n):
    return " ".join(rng.choice(words) for _ in range(n))


@pytest.fixture(scope="session")
def corpus():
    """(doc_id, text, lang, source, n_chars): copies, near copies, shared
    passages, repeated lines, odd white space, nulls, empty and long texts,
    repeated rows and repeated ids."""
    rng = random.Random(7)
    en = ["".join(rng.choice("aeinorst") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    de = ["".join(rng.choice("äöüßchkz") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    passage = sentence(rng, en, 60)
    texts = []
    for i in range(60):
        words, lang = (en, "en") if i % 3 else (de, "de")
        text = sentence(rng, words, rng.randint(30, 200))
        if i % 7 == 0:
            text += "\n" + passage + "\n" + sentence(rng, words, 9)
        if i % 11 == 0:
            text += "\n" + "\n".join(["the same line again and again it comes"] * 4)
        texts.append((text, lang))
    for i in range(0, 20, 2):  # exact copies and copies with a word or two changed
        text, lang = texts[i]
        texts.append((text, lang))
        parts = text.split(" ")
        parts[len(parts) // 2] = "changedword"
        texts.append((" ".join(parts), lang))
    texts += [(None, "en"), ("", "en"), (" \t\n ", None), ("one", "en"), ("Two words", None), ("a b c", "en"), ("A B  C", "en"),
              ("x" * 350, None), ("ab" * 200, None), ("12 34 56 !!", "en"), ("tab\tand\x0bfeed\x0c é\x1f" * 30, "en"),
              (sentence(rng, en, 20_000), "en"), ("日本語 の 文章 です 。" * 20, None)]
    rows = [(i, t, lang, f"s{i % 3}", None if t is None else len(t)) for i, (t, lang) in enumerate(texts)]
    rows += [rows[3], rows[3], (5, "another text with the id of a row before it and some words to spare in it", "en", "s0", 70),
             (None, texts[0][0], "de", None, None), (None, None, None, None, None), (None, "free words without any id", None, "s1", 3)]
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="session")
def docs(spark, corpus):
    return spark.createDataFrame(corpus, COLUMNS).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], COLUMNS)


LAST = (1 << 63) - 1


def order_of(doc_id):
    return LAST if doc_id is None else doc_id
