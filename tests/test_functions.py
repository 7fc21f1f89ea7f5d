from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tessera.functions.scalar import capitalize_words, parse_bool, parse_date, parse_timestamp, safe_cast, tidy_name
from tessera.functions.udfs import register_text_udfs, title_case, title_case_delim


def test_parse_bool_words(spark):
    words = ["true", "Yes", "on", "0", "t", "N", "maybe", None, " true", "OFF"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = [r.b for r in df.select(parse_bool("w").alias("b")).collect()]
    assert got == [True, True, True, False, True, False, None, None, None, False]


def test_parse_date_padded_unpadded_and_bad(spark):
    df = spark.createDataFrame([("1/2/2018",), ("01/02/2018",), ("12/31/2018",), ("x",)], "d string")
    got = [r.d for r in df.select(parse_date("d").alias("d")).collect()]
    assert got == [dt.date(2018, 1, 2), dt.date(2018, 1, 2), dt.date(2018, 12, 31), None]
    assert df.select(F.year(parse_date("d")).alias("y")).first().y == 2018


def test_parse_timestamp_bad_is_null(spark):
    df = spark.createDataFrame([("2020-01-02 03:04:05",), ("nope",)], "t string")
    got = [r.t for r in df.select(parse_timestamp("t").cast("timestamp_ntz").alias("t")).collect()]
    assert got == [dt.datetime(2020, 1, 2, 3, 4, 5), None]


def test_safe_cast_gives_null(spark):
    df = spark.createDataFrame([("10001",), ("1O001",), (None,)], "z string")
    assert [r.z for r in df.select(safe_cast("z", "int").alias("z")).collect()] == [10001, None, None]


def test_capitalize_words_native_and_udfs_agree(spark):
    register_text_udfs(spark)
    rows = [(1, "This is some sample data"), (2, "and even more."), (3, None), (4, "mIxEd  double")]
    df = spark.createDataFrame(rows, "id long, text string")
    out = df.select(
        "id",
        capitalize_words("text", " ").alias("native"),
        title_case("text").alias("udf"),
        title_case_delim("text", F.lit(" ")).alias("udf2"),
    ).orderBy("id")
    got = [(r.native, r.udf, r.udf2) for r in out.collect()]
    assert got[0] == ("This Is Some Sample Data",) * 3
    assert got[1] == ("And Even More.",) * 3
    assert got[2] == (None, None, None)
    assert got[3] == ("Mixed  Double",) * 3
    sql = spark.sql("SELECT title_case('hello wORLD') AS t").first().t
    assert sql == "Hello World"


def test_capitalize_words_other_delimiter(spark):
    df = spark.createDataFrame([("a|bC|d",)], "t string")
    assert df.select(capitalize_words("t", "|").alias("t")).first().t == "A|Bc|D"


def test_tidy_name(spark):
    df = spark.createDataFrame([(" sam",), ("Sam ",), ("kIM",)], "n string")
    assert [r.n for r in df.select(tidy_name("n").alias("n")).collect()] == ["Sam", "Sam", "Kim"]


def test_scale_conf():
    from tessera.session import scale_conf

    conf = scale_conf(100 * 1024**4, 8000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 409600
    assert scale_conf(10, 8)["spark.sql.shuffle.partitions"] == "24"


def test_text_functions_are_inlined(spark):
    from tessera.plans.inspect import plan_text

    register_text_udfs(spark)
    df = spark.range(3).select(F.col("id").cast("string").alias("t"))
    plan = plan_text(df.select(title_case("t"), title_case_delim("t", F.lit("|"))))
    assert "Python" not in plan and "title_case" not in plan.split("== Physical Plan ==")[-1].split("AS")[0]


def test_delimiter_is_literal_and_null_gives_null(spark):
    register_text_udfs(spark)
    df = spark.createDataFrame([("a.bC.d", "."), ("a|b", "|"), (None, "."), ("x", None)], "t string, d string")
    assert [r.o for r in df.select(title_case_delim("t", "d").alias("o")).collect()] == ["A.Bc.D", "A|B", None, None]


def test_registering_again_replaces(spark):
    from tessera.functions.udfs import register_function

    register_function(spark, "tessera_tmp", "x STRING", "concat(x, '1')")
    register_function(spark, "tessera_tmp", "x STRING", "concat(x, '2')")
    assert spark.sql("SELECT tessera_tmp('a') AS v").first().v == "a2"


def test_session_leaves_master_and_width_to_the_caller(monkeypatch):
    """Nothing is set that was not asked for."""
    from pyspark.sql import SparkSession

    from tessera import session

    set_conf = {}

    class Builder:
        def appName(self, _):
            return self

        def master(self, m):
            set_conf["master"] = m
            return self

        def config(self, k, v):
            set_conf[k] = v
            return self

        def getOrCreate(self):
            raise StopIteration

    monkeypatch.setattr(SparkSession, "builder", Builder())
    for asked, wanted in (({}, {}), ({"input_bytes": 1 << 40, "total_cores": 100}, {"spark.sql.shuffle.partitions": "4096"})):
        set_conf.clear()
        try:
            session.build_session(**asked)
        except StopIteration:
            pass
        assert "master" not in set_conf and set_conf.get("spark.sql.shuffle.partitions") == wanted.get("spark.sql.shuffle.partitions")


def test_no_local_folder_on_a_cluster(monkeypatch):
    import pytest

    from tessera import session

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(Session())
