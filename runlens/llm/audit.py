"""Filter interaction audit: what each filter removes alone, in every order,
and on average over all orders.

Every row has the set of filters that it fails as a bit mask.  Rows become
counts per (part, mask), and these a table of all 2**n coalitions: how many
rows of the part a set of filters removes together.  Everything else is
arithmetic on that table:

* a step of an order removes the difference of two coalitions;
* a filter's Shapley value is exact constrained least squares: the additive
  function that fits the coalition removals best under the Shapley kernel's
  weights, with the whole set met exactly (efficiency).  The normal equations
  with their constraint are the same in every part, so they are solved once,
  in rationals, for all right-hand sides (``shapley_weights``); times n! the
  solution is whole, and a part's values are sums of whole numbers.

Scale: one pass over the texts, which leaves a mask, a 32-byte digest and the
part of each row; copies meet as partial minima by digest, and are told apart
by a join on (digest, id), so a large group of copies is no hot key.  A part
is 32 counts per mask before anything is shuffled by part.

Cases: null texts are empty; null parts are the part ``''``; rows without an
id come after all others (a copy of them fails ``E`` if any row with an id
has the text, not among themselves) and have no labels; repeated rows and rows
under one id count each; a label is set if any label row of the id says so;
an empty table has no parts and no rows.
"""

from __future__ import annotations

import math
from fractions import Fraction
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runlens.llm.store import saved

SPACES = " \t\n\x0b\x0c\r"
BREAK = "[ \\t-\\r]+"
SYMBOL = "[#$%&*|]"
LEAST_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT = 50, 65, 5
NAMES = "ABCDE"
LAST = (1 << 63) - 1  # stands for a null id
COUNTED = ("n", "good", "toxic")


def text_failures(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds ``__mask`` (bits 0-3: filters A-D) and ``__text`` to the rows."""
    df = docs.withColumn("__text", F.coalesce(F.col(text_col), F.lit("")))
    df = df.withColumn("__words", F.split(F.trim("__text", F.lit(SPACES)), BREAK))
    n = F.when(F.get("__words", F.lit(0)) == "", 0).otherwise(F.size("__words"))
    df = df.withColumns({"__n": n, "__kinds": F.least(n, F.size(F.array_distinct("__words")))})
    fails = [F.col("__n") < LEAST_WORDS,
             100 * F.col("__kinds") < DISTINCT_PERCENT * F.col("__n"),
             100 * F.regexp_count("__text", F.lit("[A-Z]")) > CAPITAL_PERCENT * F.char_length("__text"),
             F.col("__text").rlike(SYMBOL)]
    return df.withColumn("__mask", sum_bits(fails)).drop("__words", "__n", "__kinds")


def sum_bits(fails: list[Column]) -> Column:
    out = F.lit(0)
    for bit, failed in enumerate(fails):
        out = out + F.when(failed, 1 << bit).otherwise(0)
    return out


def failure_counts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   part_col: str = "source") -> DataFrame:
    """(part, mask, n, good, toxic): rows by the set of filters they fail."""
    rows = text_failures(docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("__id"),
                                     F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                                     F.col(text_col).alias("__given")), "__given")
    rows = saved(rows.select("__id", "part", "__mask", F.unhex(F.sha2("__text", 256)).alias("__digest"))
                 .groupBy("__id", "part", "__mask", "__digest").agg(F.count("*").alias("n")))
    first = rows.groupBy("__digest").agg(F.min("__id").alias("__id")).withColumn("__first", F.lit(True))
    judged = rows.join(first, ["__digest", "__id"], "left")
    mask = F.col("__mask") + F.when(F.col("__first").isNull(), 1 << 4).otherwise(0)
    # rows without an id have no labels: a second key keeps them from meeting
    # in one task (on the label side it is 0, in a form that is no literal)
    said = (labels.where(F.col("doc_id").isNotNull() & (F.col("doc_id") != LAST))
            .groupBy(F.col("doc_id").cast("long").alias("__id"))
            .agg(F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("__good"),
                 F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("__toxic"))
            .withColumn("__spread", F.pmod("__id", F.lit(1).cast("long"))))
    spread = F.when(F.col("__id") == LAST, F.xxhash64("__digest")).otherwise(F.lit(0).cast("long"))
    told = judged.withColumns({"mask": mask, "__spread": spread}).join(said, ["__id", "__spread"], "left")
    return told.groupBy("part", "mask").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("__good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("__toxic"), F.col("n")).otherwise(0)).alias("toxic"))


def coalitions(cells: DataFrame, filters: int) -> DataFrame:
    """(part, n, good, toxic, removed): totals of the part, and the array of
    (n, good, toxic) that each of the 2**filters sets of filters removes."""
    hit = F.col("mask").bitwiseAND(F.col("s")) != 0
    wide = cells.select("part", *COUNTED, "mask", F.explode(F.sequence(F.lit(0), F.lit((1 << filters) - 1))).alias("s"))
    table = wide.groupBy("part", "s").agg(
        *[F.sum(c).alias(f"all_{c}") for c in COUNTED],
        *[F.sum(F.when(hit, F.col(c)).otherwise(0)).alias(c) for c in COUNTED])
    return table.groupBy("part").agg(
        *[F.max(f"all_{c}").alias(c) for c in COUNTED],
        F.array_sort(F.collect_list(F.struct("s", *COUNTED))).alias("removed"))


def solve(matrix: list[list[Fraction]], right: list[list[Fraction]]) -> list[list[Fraction]]:
    """The rows x with matrix x = right, by elimination in rationals."""
    rows = [list(a) + list(b) for a, b in zip(matrix, right)]
    n = len(rows)
    for i in range(n):
        pivot = next(r for r in range(i, n) if rows[r][i] != 0)
        rows[i], rows[pivot] = rows[pivot], rows[i]
        rows[i] = [v / rows[i][i] for v in rows[i]]
        for r in range(n):
            if r != i and rows[r][i] != 0:
                factor = rows[r][i]
                rows[r] = [v - factor * w for v, w in zip(rows[r], rows[i])]
    return [row[n:] for row in rows]


def shapley_weights(n: int) -> list[list[int]]:
    """For each of n filters the weight of every coalition's removal in n!
    times the filter's Shapley value.

    Minimise sum over the sets S, neither empty nor whole, of
    w(S) (v(S) - sum of phi over S)**2 with w(S) = (n - 1) / (C(n, s) s (n - s)),
    subject to: the phi sum to v(whole).  Normal equations with a multiplier
    for the constraint; the right-hand side has one column for each set."""
    size = 1 << n
    if n == 1:
        return [[0, 1]]
    kernel = [Fraction(0)] * size
    for s in range(1, size - 1):
        k = s.bit_count()
        kernel[s] = Fraction(n - 1, math.comb(n, k) * k * (n - k))
    inside = [[s >> i & 1 for s in range(size)] for i in range(n)]
    matrix = [[sum((kernel[s] for s in range(size) if inside[i][s] and inside[j][s]), Fraction(0)) for j in range(n)]
              + [Fraction(1)] for i in range(n)] + [[Fraction(1)] * n + [Fraction(0)]]
    right = [[kernel[s] * inside[i][s] for s in range(size)] for i in range(n)]
    right.append([Fraction(int(s == size - 1)) for s in range(size)])
    scaled = [[v * math.factorial(n) for v in row] for row in solve(matrix, right)[:n]]
    if any(v.denominator != 1 for row in scaled for v in row):
        raise ArithmeticError("weights times n! must be whole")
    return [[int(v) for v in row] for row in scaled]


def audit(cells: DataFrame, names: str = NAMES) -> DataFrame:
    """One row per part, order of all filters and step, from counts by
    (part, mask); ``names`` has one letter for each bit (at most 6: the
    orders are written into the plan)."""
    n = len(names)
    if not 1 <= n <= 6:
        raise ValueError("between 1 and 6 filters")
    whole = (1 << n) - 1
    steps = []
    for order in permutations(range(n)):
        done = 0
        for step, bit in enumerate(order, 1):
            steps.append((("".join(names[b] for b in order)), step, bit, done, done | 1 << bit))
            done |= 1 << bit
    # bounded by n!: every order's steps, with the coalitions before and after
    plan = F.from_json(F.lit("[" + ",".join(
        f'{{"o":"{o}","k":{k},"bit":{b},"was":{w},"now":{c}}}' for o, k, b, w, c in steps) + "]"),
        "array<struct<o:string,k:int,bit:int,was:int,now:int>>")

    def removed(s: Column, c: str = "n") -> Column:
        return F.get("removed", s)[c]

    shapley = F.array(*[sum((F.lit(w).cast("long") * removed(F.lit(s)) for s, w in enumerate(weights) if w),
                            F.lit(0).cast("long")) for weights in shapley_weights(n)])
    # one part is one small row here
    at = coalitions(cells, n).withColumn("shapley", shapley).select("*", F.explode(plan).alias("t"))
    own = F.expr("shiftleft(1, t.bit)")
    here = removed(F.col("t.now")) - removed(F.col("t.was"))
    alone, others = removed(own), F.lit(whole) - own
    return at.select(
        "part", F.col("t.o").alias("filter_order"), F.col("t.k").alias("step"),
        (F.col("n") - removed(F.col("t.now"))).alias("kept"), here.alias("removed"), (alone - here).alias("redundant"),
        (removed(F.lit(whole)) - removed(others)).alias("unique_fails"),
        (removed(F.col("t.now"), "good") - removed(F.col("t.was"), "good")).alias("good_lost"),
        (removed(F.col("t.now"), "toxic") - removed(F.col("t.was"), "toxic")).alias("toxic_lost"),
        F.get("shapley", F.col("t.bit")).alias("shapley"))
