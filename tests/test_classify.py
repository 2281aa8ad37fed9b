from pyspark.sql import functions as F

from runlens.operators import classify as C


def classify(spark, names):
    df = spark.createDataFrame([(n,) for n in names], "name string")
    return {r["name"]: r for r in C.enrich(df).collect()}


def test_etl_styles(spark):
    new = "Enceladus Standardization 2.1.0 ds 3 2020-01-15 1"
    old_std = "Standardisation 2.1.0 ds 3 15-01-2020 1"
    old_conf = "Dynamic Conformance 2.1.0 ds v3 15-01-2020 1"
    short = "Enceladus Conformance 2.1.0"
    not_etl = "Standardisation 2.1.0 ds 3"
    r = classify(spark, [new, old_std, old_conf, short, not_etl])
    c = r[new]["classification"]
    assert (c["type"], c["app_version"], c["dataset"], c["dataset_version_int"], c["info_version"]) == (
        "standardization", "2.1.0", "ds", 3, "1")
    assert c["info_date"] == "str:2020-01-15" and c["info_date_casted"].hour == 12
    assert r[new]["tag"] == "standardization_2.1.0_ds_3"
    c = r[old_std]["classification"]
    assert (c["app"], c["type"], c["app_version"], c["dataset"], c["dataset_version"]) == (
        "enceladus", "standardization", "2.1.0", "ds", "3")
    c = r[old_conf]["classification"]
    assert (c["type"], c["app_version"], c["dataset_version"], c["dataset_version_int"]) == ("conformance", "2.1.0", "v3", None)
    assert r[old_conf]["tag"] == "conformance_2.1.0_ds_v3"
    assert r[short]["is_etl"] and r[short]["classification"] is None and r[short]["tag"] is None
    assert not r[not_etl]["is_etl"] and r[not_etl]["tag"] == not_etl


def test_default_classification(spark):
    r = classify(spark, ["my-app_v1.2 run;x%y,z"])["my-app_v1.2 run;x%y,z"]
    d = r["default_classification"]
    assert d["app"] == d["type"] == "my-app_v1.2 run;x%y,z"
    assert d["words"] == ["my", "app", "v1", "2", "run", "x", "y", "z"]


def test_top_tags(spark):
    rows = [("a",)] * 12 + [("b",)] * 10 + [("c",)] * 9 + [(None,)] * 20
    df = spark.createDataFrame(rows, "tag string")
    out = [(r["tag"], r["doc_count"]) for r in C.top_tags(df).collect()]
    assert out == [("a", 12), ("b", 10)]


def test_doc_uid(spark):
    df = spark.createDataFrame([("app", None), ("app", "2")], "a string, b string")
    assert [r[0] for r in df.select(C.doc_uid("a", "b")).collect()] == ["app-0", "app-2"]
    assert C.by_id(df.withColumn("uid", C.doc_uid("a", "b")), "app-2").count() == 1


def test_is_etl_app(spark):
    df = spark.createDataFrame([("EnceladusX",), ("Dynamic Conformance a b c d e",), ("x",)], "name string")
    assert [r[0] for r in df.select(C.is_etl_app(F.col("name"))).collect()] == [True, True, False]


def test_wide_versions(spark):
    df = spark.createDataFrame([("Enceladus Standardization 2.1.0 ds 123456789012 2020-01-15 7",)], "name string")
    r = C.enrich(df).select("classification.*").first()
    assert r.dataset_version_int == 123456789012 and r.info_version_int == 7
