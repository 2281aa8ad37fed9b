"""Quality rules with risk-controlled thresholds.

DataFrame functions only.  Every document gets plain counts (words, word
characters, symbols, repeated lines, words in repeated windows); base rules
reject the hopeless.  For the others each rule compares a value with a
cutoff, chosen per stratum (the language by default) from labelled documents.

A quarter of them (by a hash of the id) orders the cutoffs: a rule's cutoff
costs the share of good documents beyond it divided by the share of bad ones,
and a level is a bound on the cost; at a level each rule has its lowest cutoff
within the bound, so levels are nested sets of cutoffs of all rules together.
The other three quarters test the levels from the most lenient to the
strictest: a level is valid if an exact binomial test shows, at confidence
1 - ``DELTA`` / strata, that all its cutoffs together reject at most
``ALPHA`` of the stratum's good documents.  The tests stop at the first
failure (fixed sequence), so no further correction is due inside a stratum,
and all choices together hold at 1 - ``DELTA``.  Of the valid levels the one
that separates bad from good best is taken, the most lenient among equals; a
stratum where none separates gets no cutoff.  With ``ALPHA`` 0.01 a stratum
of four needs 436 good documents to test.

Scale: one pass over the texts inside generated code, no shuffle of text;
the counts are saved once (a few numbers per document), joined with the
labels, and reduced to (stratum, rule, grid step) counts before any shuffle
by stratum.  The cutoffs (strata x rules) are broadcast below
``BROADCAST_STRATA`` strata.

Cases: null or empty text has no words and fails the base rules; a document
with several label rows is good if any says so; labels with a null id or
null quality are not used; a null stratum is one of its own; strata without
enough labels get no cutoff and keep what the base rules keep; repeated
document rows are judged alike.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from runlens.llm.store import saved

SPACES = " \t\n\x0b\x0c\r"
BREAK = "[ \\t-\\r]+"
SYMBOLS = "[#*$%&|<>]"
WINDOW = 8
MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30
ALPHA, DELTA = 0.01, 0.05
BROADCAST_STRATA = 10_000
LEVELS, DECADES = 64, 4
# rule: (grid step, grid steps); values are whole numbers, larger is worse
GRID = {
    "symbols": (5, 200),       # per 1,000 word characters
    "dup_lines": (10, 100),    # per 1,000 lines
    "repeats": (10, 100),      # per 1,000 words
    "long_words": (20, 200),   # word characters per 100 words
    "short_words": (20, 200),  # 4,000 minus that
}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeat_words(words: Column, n: Column) -> tuple[Column, Column, Column, Column]:
    """Steps (each over the column that the step before was saved as) to the
    number of words in windows that occur twice or more in the same array."""
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    windows = F.when(n >= WINDOW, F.transform(
        F.sequence(F.lit(0), n - F.lit(WINDOW)),
        lambda i: F.xxhash64(*[F.get("__hashes", i + k) for k in range(WINDOW)]))).otherwise(F.array().cast("array<bigint>"))
    ordered = F.when(F.size(F.array_distinct("__windows")) < F.size("__windows"), F.array_sort(
        F.transform("__windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    twice = F.array_sort(F.transform(F.filter(
        F.transform("__ordered", lambda s, j: F.struct(
            s["i"].alias("i"),
            (F.coalesce(s["h"] == F.get("__ordered", j - 1)["h"], F.lit(False))
             | F.coalesce(s["h"] == F.get("__ordered", j + 1)["h"], F.lit(False))).alias("again"))),
        lambda s: s["again"]), lambda s: s["i"]))
    return hashes, windows, ordered, twice


def counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Input columns plus the counts and ``n_lines`` (lines with a word)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    df = docs.withColumn("__text", text)
    df = df.withColumns({"__words": F.split(F.trim("__text", F.lit(SPACES)), BREAK),
                         "__lines": F.filter(F.split("__text", "\n"), lambda x: F.trim(x, F.lit(SPACES)) != "")})
    n = F.when(F.get("__words", F.lit(0)) == "", 0).otherwise(F.size("__words"))
    df = df.withColumn("__n", n)
    hashes, windows, ordered, twice = repeat_words(F.col("__words"), F.col("__n"))
    df = df.withColumn("__hashes", hashes).withColumn("__windows", windows).withColumn("__ordered", ordered)
    df = df.withColumn("__twice", twice)
    covered = F.aggregate(
        "__twice", F.struct(F.lit(0).alias("n"), F.lit(-1).alias("end")),
        lambda acc, i: F.struct((acc["n"] + i + WINDOW - F.greatest(i, acc["end"])).alias("n"), (i + WINDOW).alias("end")),
        lambda acc: acc["n"])
    return df.select(
        *docs.columns, F.col("__n").cast("long").alias("n_words"),
        F.char_length(F.array_join("__words", "")).cast("long").alias("word_chars"),
        (F.size(F.split("__text", SYMBOLS, -1)) - 1).cast("long").alias("n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("__lines").cast("long").alias("n_lines"))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def rule_values() -> dict[str, Column]:
    """Whole-number value of each rule; larger is worse."""
    def per(part: str, whole: str, scale: int) -> Column:
        return F.coalesce(F.expr(f"({part} * {scale}) div nullif({whole}, 0)"), F.lit(0))

    length = per("word_chars", "n_words", 100)
    return {"symbols": per("n_symbols", "word_chars", 1000), "dup_lines": per("n_dup_lines", "n_lines", 1000),
            "repeats": per("n_repeat_words", "n_words", 1000), "long_words": length, "short_words": F.lit(4000) - length}


def binomial_tail(n: Column, k: Column, p: float) -> Column:
    """P(X <= k) for X ~ Binomial(n, p), exact up to rounding, for k < n p:
    the last term by logarithms, the others by their ratios."""
    log_last = F.aggregate(F.sequence(F.lit(0), k), n * F.lit(math.log1p(-p)), lambda acc, j: F.when(
        j == 0, acc).otherwise(acc + F.log((n - j + 1) / F.greatest(j, F.lit(1)) * F.lit(p / (1 - p)))))
    rest = F.aggregate(F.reverse(F.sequence(F.lit(0), k)), F.struct(F.lit(1.0).alias("t"), F.lit(0.0).alias("s")),
                       lambda acc, j: F.struct((acc["t"] * j * F.lit((1 - p) / p) / (n - j + 1)).alias("t"),
                                               (acc["s"] + acc["t"]).alias("s")), lambda acc: acc["s"])
    return F.exp(log_last) * rest


def cells() -> dict[str, Column]:
    """The grid cell of each rule's value: cutoff c - 1 steps is exceeded by
    the values of cell c and above."""
    return {rule: F.floor((F.least(v, F.lit(step * size)) - 1 + step) / step).cast("long") for (rule, (step, size)), v in zip(GRID.items(), rule_values().values())}


def cost_level(cost: Column) -> Column:
    """The first of ``LEVELS`` + 1 levels, bounds from 10**-``DECADES`` to 1
    in equal ratios, that allows the cost."""
    return F.greatest(F.lit(0), F.ceil((F.log10(cost) / DECADES + 1) * LEVELS - 1e-9)).cast("int")


def rule_paths(train: DataFrame) -> DataFrame:
    """(stratum, rule, cell, level): the cutoffs that a rule has, from rows
    of stratum, good and the counts, with the first level that has them."""
    each = F.explode(F.array(*[F.struct(F.lit(rule).alias("rule"), c.alias("cell")) for rule, c in cells().items()]))
    counted = (train.select("stratum", "good", each.alias("r")).groupBy("stratum", "r.rule", "r.cell")
               .agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad")))
    # one row per observed cell (at most the grid's size) in each window
    whole = Window.partitionBy("stratum", "rule")
    above = whole.orderBy(F.desc("cell"))
    beyond = counted.select("stratum", "rule", "cell", *[
        ((F.sum(c).over(above) + 1) / (F.sum(c).over(whole) + 1)).alias(c) for c in ("good", "bad")])
    cost = F.min(F.col("good") / F.col("bad")).over(whole.orderBy("cell"))
    return (beyond.where("cell > 0").select("stratum", "rule", "cell", cost.alias("cost"))
            .where("cost < 1").select("stratum", "rule", "cell", cost_level(F.col("cost")).alias("level")))


def cutoffs(labelled: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """(stratum, rule, cutoff) from rows of stratum, good, train (whether the
    row orders the cutoffs or tests them) and the counts: a document whose
    value exceeds the cutoff is rejected."""
    paths = saved(rule_paths(labelled.where("train")))
    by_rule = paths.groupBy("stratum", "rule").agg(F.collect_list(F.struct("cell", "level")).alias("path"))
    by_stratum = by_rule.groupBy(F.col("stratum").alias("__stratum")).agg(
        F.map_from_entries(F.collect_list(F.struct("rule", "path"))).alias("__paths"))
    held = labelled.where("not train")

    def level(rule: str, cell: Column) -> Column:
        return F.array_min(F.transform(F.filter(F.col("__paths")[rule], lambda x: x["cell"] <= cell), lambda x: x["level"]))

    # the first level that rejects the document, none for LEVELS + 1
    first = F.coalesce(F.least(*[level(rule, c) for rule, c in cells().items()]), F.lit(LEVELS + 1))
    counted = (held.join(by_stratum, F.col("stratum").eqNullSafe(F.col("__stratum")), "left")
               .groupBy("stratum", first.alias("level"))
               .agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad")))
    counted = saved(counted)
    total = counted.groupBy("stratum").agg(F.sum("good").alias("n_good"), F.sum("bad").alias("n_bad"))
    tests = max(1, total.count())  # one sequence for each stratum
    each = total.select(F.col("stratum").alias("s"), "n_good", "n_bad", F.explode(F.sequence(F.lit(0), F.lit(LEVELS))).alias("c"))
    tried = (each.join(counted, F.col("s").eqNullSafe(F.col("stratum")) & (F.col("level") <= F.col("c")), "left")
             .groupBy("s", "n_good", "n_bad", "c")
             .agg(F.coalesce(F.sum("good"), F.lit(0)).alias("k"), F.coalesce(F.sum("bad"), F.lit(0)).alias("caught")))
    safe = F.when(F.col("k") < F.col("n_good") * alpha, binomial_tail(F.col("n_good"), F.col("k"), alpha)).otherwise(1.0)
    tried = tried.withColumn("valid", safe <= F.lit(delta / tests))
    gain = F.col("caught") / F.greatest("n_bad", F.lit(1)) - F.col("k") / F.greatest("n_good", F.lit(1))
    # fixed sequence: lenient (small c) to strict, up to the first failure
    ends = tried.groupBy("s").agg(F.min(F.when(~F.col("valid"), F.col("c"))).alias("stop"), F.collect_list(
        F.struct(gain.alias("gain"), (-F.col("c")).alias("lenient"))).alias("all"))
    best = F.array_max(F.filter("all", lambda x: (x["gain"] > 0) & F.coalesce(-x["lenient"] < F.col("stop"), F.lit(True))))
    chosen = ends.select("s", (-best["lenient"]).alias("chosen")).where("chosen is not null")
    lowest = (paths.join(chosen, F.col("stratum").eqNullSafe(F.col("s")) & (F.col("level") <= F.col("chosen")))
              .groupBy("stratum", "rule").agg(F.min("cell").alias("cell")))
    step = F.element_at(F.create_map(*[x for r, (n, _) in GRID.items() for x in (F.lit(r), F.lit(n))]), F.col("rule"))
    return lowest.select("stratum", "rule", ((F.col("cell") - 1) * step).cast("long").alias("cutoff"))


def trains(id_col: str) -> Column:
    """A quarter of the ids orders the cutoffs, the others test them."""
    return F.pmod(F.xxhash64(F.lit("train"), F.col(id_col)), F.lit(4)) == 0


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang",
          alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """The stratum, the counts, base_failed and kept of every row, by id."""
    stats = saved(counts(docs.select(id_col, F.col(stratum_col).cast("string").alias("stratum"), text_col), text_col)
                  .drop(text_col)).withColumn("base_failed", base_failed())
    said = labels.where(F.col("quality").isNotNull()).groupBy(F.col("doc_id").alias("__id")).agg(
        (F.max("quality") == 1).alias("good"))
    labelled = saved(stats.where("not base_failed").join(said, F.col(id_col) == F.col("__id")).withColumn("train", trains("__id")))
    limits = saved(cutoffs(labelled, alpha, delta).groupBy(F.col("stratum").alias("__stratum")).agg(
        F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("__limits")))
    if limits.count() <= BROADCAST_STRATA:
        limits = F.broadcast(limits)
    over = F.lit(False)
    for rule, value in rule_values().items():
        step, size = GRID[rule]
        over = over | F.coalesce(F.least(value, F.lit(step * size)) > F.col("__limits")[rule], F.lit(False))
    judged = stats.join(limits, F.col("stratum").eqNullSafe(F.col("__stratum")), "left")
    return judged.select(id_col, "stratum", *COUNTS, "base_failed", (~F.col("base_failed") & ~over).alias("kept"))
