"""Benchmark decontamination with a distributed positional inverted index.

DataFrame functions only.  The documents' tokens are numbered, and postings
(term, document, position) are stored for the index terms: of every benchmark
window its two rarest words by corpus count.  A phrase is found by
intersecting lists: the rarest word's positions, shifted by the word's offset
in the window, name starts, and the second word's list must have the start
shifted by its own offset, an equi-join on (document, term, position).  What
is left is compared as a whole with the words around the first posting, which
that one carries.  Proximity matches join the same two lists of a document by
position ranges, in any order of the words.

Scale: the documents are tokenised twice (corpus counts, then postings) and
never shuffled as text; only postings of index terms move, and only those
that start a window carry words.  The benchmark's
terms and anchors are broadcast when a count of their rows (made first)
stays under ``BROADCAST_ROWS``; beyond it Spark joins them by shuffle.
Matches carry the document id, and a document's matches are first reduced to
distinct starts.

Cases: null text has no words; an item of fewer words than a window is one
window; an item without words is ignored, one with a null id marks words but
is not listed; repeated items and repeated document rows are each judged
alone (a row is known by its id and its text); extra columns pass through,
those with the names of result columns are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runlens.llm.store import saved

SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WINDOW = 10
BROADCAST_ROWS = 200_000
RESULT = ("n_words", "n_hit", "n_items", "item_ids", "contaminated")


def lowered(c: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(c, UPPER, LOWER)


def tokens(text: Column) -> Column:
    """Words in order; an empty string stands before a leading separator and
    after a trailing one (positions are consistent, words are not cut)."""
    return F.split(F.coalesce(text, F.lit("")), SEPARATORS, -1)


def token_count(words: Column) -> Column:
    last = F.element_at(words, -1)
    return (F.size(words) - (F.element_at(words, 1) == "").cast("int")
            - ((F.size(words) > 1) & (last == "")).cast("int")).cast("long")


def benchmark_windows(items: DataFrame, id_col: str, text_col: str, window: int = WINDOW) -> DataFrame:
    """item_key, item_id, start, words (array) of every window."""
    words = F.filter(F.split(lowered(F.coalesce(F.col(text_col), F.lit(""))), SEPARATORS, -1), lambda w: w != "")
    w = items.select(F.col(id_col).alias("item_id"), words.alias("words")).where(F.size("words") > 0)
    return (w.select("item_id", "words", F.explode(
                F.sequence(F.lit(0), F.greatest(F.size("words") - F.lit(window), F.lit(0)))).alias("start"))
            .select("item_id", F.slice("words", F.col("start") + 1, window).alias("words")))


def small(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast only below the documented bound."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def term_counts(tokenised: DataFrame, terms: DataFrame, n_terms: int) -> DataFrame:
    """Corpus count of each of the terms (all documents, all positions)."""
    folded = terms.select(F.lower("term").alias("folded")).distinct()
    return (tokenised.select(F.explode("__words").alias("raw")).withColumn("folded", F.lower("raw"))
            .join(small(folded, n_terms), "folded", "left_semi").groupBy("raw").count()
            .select(lowered(F.col("raw")).alias("term"), "count")
            .join(small(terms, n_terms), "term").groupBy("term").agg(F.sum("count").alias("df")))


def _rarest(windows: DataFrame, counted: DataFrame, n_terms: int) -> DataFrame:
    """Each distinct window with its items and the terms and offsets of its
    two rarest words; ``second`` is null for a window of one word."""
    w = windows.groupBy("words").agg(F.collect_set(F.col("item_id").cast("string")).alias("ids"))
    ranked = (w.select("words", "ids", F.posexplode("words").alias("offset", "term"))
              .join(small(counted, n_terms), "term", "left")
              .groupBy("words", "ids").agg(F.array_sort(F.collect_list(
                  F.struct(F.coalesce("df", F.lit(0)).alias("df"), "term", "offset"))).alias("r")))
    # a window with a word that the corpus lacks cannot occur
    return (ranked.where(F.col("r")[0]["df"] > 0)
            .select("words", "ids", F.col("r")[0]["term"].alias("term"), F.col("r")[0]["offset"].alias("offset"),
                    F.get("r", F.lit(1)).alias("second")))


def index_terms(anchors: DataFrame) -> DataFrame:
    """(term, carried): both words of every window; ``carried`` marks those
    that are the rarest of one."""
    first = anchors.select("term", F.lit(True).alias("carried"))
    second = anchors.where("second is not null").select(F.col("second.term").alias("term"), F.lit(False).alias("carried"))
    return first.unionByName(second).groupBy("term").agg(F.max("carried").alias("carried"))


def postings(tokenised: DataFrame, terms: DataFrame, n_terms: int, reach: int) -> DataFrame:
    """Postings of the terms: __row, pos, term, carried, and for carried ones
    the words within ``reach`` (``around``, lower case; ``before`` of them
    precede the term)."""
    folded = small(terms.select(F.lower("term").alias("folded")).distinct(), n_terms)
    if n_terms <= BROADCAST_ROWS:
        # joined inside the scan's stage: the array is never copied per word
        hit = (tokenised.select("__row", "__words", F.posexplode("__words").alias("pos", "raw"))
               .withColumn("folded", F.lower("raw")).join(folded, "folded", "left_semi"))
    else:
        # shuffle the words alone, then bring each document its positions
        at = (tokenised.select("__row", F.posexplode("__words").alias("pos", "raw"))
              .join(folded, F.lower("raw") == F.col("folded"), "left_semi")
              .groupBy("__row").agg(F.collect_set("pos").alias("places")))
        hit = (tokenised.join(at, "__row").select("__row", "__words", F.explode("places").alias("pos"))
               .withColumn("raw", F.col("__words")[F.col("pos")]))
    hit = hit.withColumn("term", lowered(F.col("raw"))).join(small(terms, n_terms), "term")
    first = F.greatest(F.col("pos") - reach, F.lit(0))
    around = F.split(lowered(F.array_join(F.slice("__words", first + 1, 2 * reach + 1), " ")), " ", -1)
    return hit.select("__row", "pos", "term", "carried", (F.col("pos") - first).alias("before"),
                      F.when(F.col("carried"), around).alias("around"))


def phrase_matches(post: DataFrame, anchors: DataFrame, n_anchors: int) -> DataFrame:
    """Exact occurrences: __row, at (position of the first word), words, ids."""
    start = F.col("before") - F.col("offset")  # of the window, in ``around``
    starts = post.where("carried").join(small(anchors, n_anchors), "term").where(start >= 0)
    other = post.select(F.col("__row").alias("__of"), F.col("pos").alias("__pos"), F.col("term").alias("__term"))
    both = starts.where("second is not null").join(
        other, F.col("__row").eqNullSafe(F.col("__of")) & (F.col("second.term") == F.col("__term"))
        & (F.col("pos") - F.col("offset") + F.col("second.offset") == F.col("__pos")), "left_semi")
    near = both.unionByName(starts.where("second is null"))
    exact = near.where(F.slice("around", F.greatest(start + 1, F.lit(1)), F.size("words")) == F.col("words"))
    return exact.select("__row", (F.col("pos") - F.col("offset")).alias("at"), "words", "ids")


def proximity_matches(docs: DataFrame, items: DataFrame, within: int = 30, id_col: str = "doc_id",
                      text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text",
                      window: int = WINDOW) -> DataFrame:
    """doc id, item_id, pos: the window's rarest word at ``pos`` has the second
    rarest within ``within`` words, in any order."""
    t, anchors, n_anchors = _prepared(docs, items, id_col, text_col, item_id_col, item_text_col, window)
    post = stored_postings(t, anchors, 0).select("__row", "pos", "term", "carried")
    first = (post.where("carried").join(small(anchors.where("second is not null").select(
                "ids", "term", F.col("second.term").alias("other")), n_anchors), "term")
             # positions meet in their own and the neighbouring stretches
             .withColumn("stretch", F.explode(F.array(*[F.floor(F.col("pos") / (within + 1)) + i for i in (-1, 0, 1)]))))
    other = post.select(F.col("__row").alias("__of"), F.col("pos").alias("__pos"), F.col("term").alias("__term"),
                        F.floor(F.col("pos") / (within + 1)).alias("__stretch"))
    near = first.join(other, F.col("__row").eqNullSafe(F.col("__of")) & (F.col("other") == F.col("__term"))
                      & (F.col("stretch") == F.col("__stretch")) & (F.col("pos") != F.col("__pos")) & (F.abs(F.col("pos") - F.col("__pos")) <= within), "left_semi")
    return near.select(F.col("__row.id").alias(id_col), F.explode("ids").alias("item_id"), "pos").distinct()


def stored_postings(tokenised: DataFrame, anchors: DataFrame, reach: int) -> DataFrame:
    """The index of the anchors' words, kept in the checkpoint folder: both
    lists of every intersection are read from it."""
    terms = saved(index_terms(anchors))
    return saved(postings(tokenised, terms, terms.count(), reach))


def _prepared(docs: DataFrame, items: DataFrame, id_col: str, text_col: str, item_id_col: str, item_text_col: str,
              window: int) -> tuple[DataFrame, DataFrame, int]:
    """Tokenised documents (__row, __words), anchors and their number."""
    t = docs.select(row_key(id_col, text_col).alias("__row"), tokens(F.col(text_col)).alias("__words"))
    windows = saved(benchmark_windows(items, item_id_col, item_text_col, window))
    vocabulary = windows.select(F.explode("words").alias("term")).distinct()
    n_terms = vocabulary.count()
    counted = term_counts(t, vocabulary, n_terms)
    anchors = saved(_rarest(windows, counted, n_terms))
    return t, anchors, anchors.count()


def row_key(id_col: str, text_col: str) -> Column:
    """Known by id and text: rows that share an id are judged alone."""
    return F.struct(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("h"))


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Input columns plus n_words, n_hit (words inside any occurrence of an
    item's window), n_items, item_ids (sorted as strings), contaminated."""
    docs = docs.drop(*RESULT)
    t, anchors, n_anchors = _prepared(docs, items, id_col, text_col, item_id_col, item_text_col, window)
    post = stored_postings(t, anchors, window - 1)
    # per document: the windows found there in order, each adding the words
    # that the ones before it left open
    per_doc = phrase_matches(post, anchors, n_anchors).groupBy("__row").agg(
        F.array_sort(F.collect_set(F.struct("at", (F.col("at") + F.size("words")).alias("to")))).alias("runs"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("ids")))).alias("item_ids"))
    covered = F.aggregate(
        "runs", F.struct(F.lit(0).cast("long").alias("n"), F.lit(-1).alias("end")),
        lambda acc, r: F.struct((acc["n"] + F.greatest(r["to"] - F.greatest(r["at"], acc["end"]), F.lit(0))).cast("long").alias("n"),
                                F.greatest(acc["end"], r["to"]).alias("end")), lambda acc: acc["n"])
    hits = per_doc.select("__row", covered.alias("__hit"), "item_ids")
    rows = docs.withColumns({"__row": row_key(id_col, text_col), "n_words": token_count(tokens(F.col(text_col)))})
    out = rows.join(hits.withColumnRenamed("__row", "__of"), F.col("__row").eqNullSafe(F.col("__of")), "left")
    n_hit = F.coalesce("__hit", F.lit(0)).cast("long")
    return out.select(*docs.columns, "n_words", n_hit.alias("n_hit"),
                      F.coalesce(F.size("item_ids"), F.lit(0)).cast("long").alias("n_items"),
                      F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
                      (n_hit > 0).alias("contaminated"))
