"""Application classification and tags.

Names are split with ``split`` and read by position (``get``, 0-based, NULL
past the end), so every name is classified inside its own row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runlens.constants import (
    DEFAULT_CLASSIFICATION_SEPARATORS,
    ETL_NEW_PREFIX,
    ETL_OLD_CONFORMANCE,
    ETL_PROJECT,
    ETL_OLD_STANDARDIZATION,
    TOP_TAGS_MIN_COUNT,
)
from runlens.functions import info_date_str, parse_info_date, version_int


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _words(name: Column) -> Column:
    return F.split(name, " ")


def is_old_standardization(name: Column | str) -> Column:
    n = _c(name)
    prefix, n_words = ETL_OLD_STANDARDIZATION
    return n.startswith(prefix) & (F.size(_words(n)) == n_words)


def is_old_conformance(name: Column | str) -> Column:
    n = _c(name)
    prefix, n_words = ETL_OLD_CONFORMANCE
    return n.startswith(prefix) & (F.size(_words(n)) == n_words)


def is_etl_app(name: Column | str) -> Column:
    """P10: new-style prefix, or one of the two old styles with its word count."""
    n = _c(name)
    return n.startswith(ETL_NEW_PREFIX) | is_old_standardization(n) | is_old_conformance(n)


def etl_classification(name: Column | str, words: Column | None = None) -> Column:
    """struct(project, app, type, app_version, dataset,
    dataset_version, dataset_version_int, info_date, info_date_casted,
    info_version, info_version_int).

    New style reads words 0..6; old standardization words 1..5; old
    conformance drops its first word, then the same.  Names of no style, or a
    new-style name with fewer than 7 words, give NULL (error routing reports
    them).  Versions made of digits also appear as BIGINT.
    """
    n = _c(name)
    w = _words(n) if words is None else words
    prefix_std, n_std = ETL_OLD_STANDARDIZATION
    prefix_conf, n_conf = ETL_OLD_CONFORMANCE
    new = n.startswith(ETL_NEW_PREFIX)
    old_std = n.startswith(prefix_std) & (F.size(w) == n_std)
    old_conf = n.startswith(prefix_conf) & (F.size(w) == n_conf)
    # offset of the app_version word
    off = F.when(new, F.lit(2)).when(old_std, F.lit(1)).when(old_conf, F.lit(2))
    valid = (new & (F.size(w) >= 7)) | old_std | old_conf

    def word(i: int) -> Column:
        return F.get(w, off + i)

    etl_type = (
        F.when(new, F.lower(F.get(w, 1))).when(old_std, F.lit("standardization")).when(old_conf, F.lit("conformance"))
    )
    app = F.when(new, F.lower(F.get(w, 0))).otherwise(F.lit(ETL_PROJECT))
    info_date = word(3)
    return F.when(
        valid,
        F.struct(
            F.lit(ETL_PROJECT).alias("project"),
            app.alias("app"),
            etl_type.alias("type"),
            word(0).alias("app_version"),
            word(1).alias("dataset"),
            word(2).alias("dataset_version"),
            version_int(word(2)).alias("dataset_version_int"),
            info_date_str(info_date).alias("info_date"),
            parse_info_date(info_date).alias("info_date_casted"),
            word(4).alias("info_version"),
            version_int(word(4)).alias("info_version_int"),
        ),
    )


def etl_tag(classification: Column) -> Column:
    """type_appversion_dataset_datasetversion; a missing part prints as
    'None' (the way the source formats it)."""
    parts = [F.coalesce(classification[f], F.lit("None")) for f in ("type", "app_version", "dataset", "dataset_version")]
    return F.when(classification.isNotNull(), F.concat_ws("_", *parts))


def default_classification(name: Column | str) -> Column:
    """app = type = name, plus the words split on blanks and ; , . - % _
    (as an array; position i+1 is word i)."""
    n = _c(name)
    return F.struct(n.alias("app"), n.alias("type"), F.split(n, DEFAULT_CLASSIFICATION_SEPARATORS).alias("words"))


def enrich(df: DataFrame, name_col: str = "name") -> DataFrame:
    """Default enrichment, replaced by the ETL one for ETL apps: adds
    ``is_etl``, ``etl_valid`` (an ETL name that classifies),
    ``classification`` (ETL struct or NULL), ``default_classification`` and
    ``tag`` (ETL tag, else the name)."""
    n = F.col(name_col)
    # the word array is its own column, computed once per row: referenced
    # many times below, it keeps the optimizer from inlining the split (and
    # whatever derives the name) into every use
    staged = df.withColumn("__words", _words(n))
    w = F.col("__words")
    prefix_std, n_std = ETL_OLD_STANDARDIZATION
    prefix_conf, n_conf = ETL_OLD_CONFORMANCE
    is_etl = n.startswith(ETL_NEW_PREFIX) | (n.startswith(prefix_std) & (F.size(w) == n_std)) | (
        n.startswith(prefix_conf) & (F.size(w) == n_conf)
    )
    etl = etl_classification(n, w)
    valid = (n.startswith(ETL_NEW_PREFIX) & (F.size(w) >= 7)) | (n.startswith(prefix_std) & (F.size(w) == n_std)) | (
        n.startswith(prefix_conf) & (F.size(w) == n_conf)
    )
    return (
        staged.withColumn("is_etl", is_etl)
        # a small flag to filter on (instead of testing the whole struct)
        .withColumn("etl_valid", valid)
        .withColumn("classification", F.when(F.col("is_etl"), etl))
        .withColumn("default_classification", default_classification(n))
        .withColumn("tag", F.when(F.col("is_etl"), etl_tag(F.col("classification"))).otherwise(n))
        .drop("__words")
    )


def top_tags(df: DataFrame, tag_col: str = "tag", min_count: int = TOP_TAGS_MIN_COUNT,
             buckets: int | None = None) -> DataFrame:
    """Tags with at least ``min_count`` documents, most frequent first
    (ties by tag); all of them unless ``buckets`` asks for a top-k.  Counting is a partial +
    final aggregation; only the (small) tag counts reach the top-k step."""
    # documents without a tag are not counted (as in a terms aggregation):
    # count(tag) is 0 for the NULL group, which the count threshold removes
    counts = df.groupBy(tag_col).agg(F.count(tag_col).alias("doc_count"))
    keep = counts.where(F.col("doc_count") >= max(min_count, 1))
    ordered = keep.orderBy(F.desc("doc_count"), tag_col)
    return ordered if buckets is None else ordered.limit(buckets)


def by_tag(df: DataFrame, tag: str, tag_col: str = "tag", size: int | None = None, order: list[str] | None = None) -> DataFrame:
    """Documents of one tag in a total order; ``size`` asks for a top-k."""
    hit = df.where(F.col(tag_col) == F.lit(tag)).orderBy(*(order or df.columns))
    return hit if size is None else hit.limit(size)


def doc_uid(app_id: Column | str, attempt_id: Column | str) -> Column:
    """Aggregate document id '{app}-{attempt or 0}'."""
    return F.concat_ws("-", _c(app_id), F.coalesce(_c(attempt_id).cast("string"), F.lit("0")))


def by_id(df: DataFrame, uid: str, uid_col: str = "uid") -> DataFrame:
    """document(s) with the given id."""
    return df.where(F.col(uid_col) == F.lit(uid))
