"""Operator tests on tiny inline fixtures (cases from the source system's own tests)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from contentspark.functions import dates as D
from contentspark.functions.meta import build_meta, typed_value
from contentspark.operators import predicates as P
from contentspark.operators import sorting as S
from contentspark.sources.views import term_struct


def posts_with_meta(spark, values, key="test_key"):
    rows = [(i + 1, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "id long, v string")
    return df.select("id", F.lit("post").alias("post_type"), build_meta([(key, F.col("v"))]).alias("meta"))


def ids(df):
    return sorted(r[0] for r in df.select("id").collect())


def test_meta_between(spark):
    df = posts_with_meta(spark, [None, None, "100", "105", "110"])
    c = P.meta_query([{"key": "test_key", "value": [102, 106], "compare": "BETWEEN"}])
    assert ids(df.filter(c)) == [4]


def test_meta_not_between_keeps_end_points_and_drops_missing(spark):
    df = posts_with_meta(spark, [None, "100", "105", "110"])
    c = P.meta_query([{"key": "test_key", "value": [100, 110], "compare": "NOT BETWEEN"}])
    assert ids(df.filter(c)) == [2, 4]


def test_meta_like_is_token_phrase(spark):
    df = posts_with_meta(spark, [None, None, "ALICE in wonderland", "alice in melbourne", "AlicE in america"])
    c = P.meta_query([{"key": "test_key", "value": "alice", "compare": "LIKE"}])
    assert ids(df.filter(c)) == [3, 4, 5]
    c2 = P.meta_query([{"key": "test_key", "value": "in melbourne", "compare": "LIKE"}])
    assert ids(df.filter(c2)) == [4]
    c3 = P.meta_query([{"key": "test_key", "value": "alic", "compare": "LIKE"}])
    assert ids(df.filter(c3)) == []


def test_meta_not_equal_and_not_exists_match_missing(spark):
    df = posts_with_meta(spark, [None, "a", "b"])
    assert ids(df.filter(P.meta_query([{"key": "test_key", "value": "a", "compare": "!="}]))) == [1, 3]
    assert ids(df.filter(P.meta_query([{"key": "test_key", "compare": "NOT EXISTS"}]))) == [1]
    assert ids(df.filter(P.meta_query([{"key": "test_key"}]))) == [2, 3]


def test_typed_value_expansion(spark):
    vals = ["13", "13.43", "some text", "20.000000", "2015-01-01", "true", "3000-01-01 00:00:00", ""]
    df = spark.createDataFrame([(v,) for v in vals], "v string").select("v", typed_value(F.col("v")).alias("t"))
    got = {r["v"]: r["t"] for r in df.collect()}
    assert got["13"]["long"] == 13 and got["13"]["double"] == 13.0
    assert got["13.43"]["long"] == 13 and got["13.43"]["double"] == 13.43
    assert got["some text"]["long"] is None and got["some text"]["double"] is None
    assert got["some text"]["datetime"] == dt.datetime(1970, 1, 1, 0, 0, 1)
    assert got["20.000000"]["long"] == 20
    assert got["2015-01-01"]["date"] == dt.date(2015, 1, 1)
    assert got["true"]["boolean"] is True and got["13"]["boolean"] is False
    assert got["3000-01-01 00:00:00"]["datetime"] == dt.datetime(1970, 1, 1, 0, 0, 1)
    assert got[""]["datetime"] is None and got[""]["boolean"] is False


def test_date_parts(spark):
    df = spark.createDataFrame([(dt.datetime(2021, 4, 11, 23, 58, 12),)], "ts timestamp_ntz")
    r = df.select(D.date_terms(F.col("ts")).alias("d")).first()["d"].asDict()
    assert r == {"year": 2021, "month": 4, "week": 14, "dayofyear": 100, "day": 11, "dayofweek": 0,
                 "dayofweek_iso": 7, "hour": 23, "minute": 58, "second": 12, "m": 202104}


@pytest.fixture(scope="module")
def date_posts(spark):
    base = dt.datetime(2012, 1, 6, 23, 59)
    rows = [(i + 1, base - dt.timedelta(days=i, hours=i)) for i in range(11)]
    return spark.createDataFrame(rows, "id long, post_date timestamp_ntz")


@pytest.mark.parametrize("q,n", [
    ({"month": 12}, 5),
    ({"day": 5}, 1),
    ({"after": "2012-01-01", "before": "2012-01-02", "inclusive": True}, 2),
    ({"day": [1, 5], "compare": "BETWEEN"}, 5),
    ({"day": [1, 5], "compare": "NOT BETWEEN"}, 8),
    ({"day": [5, 5], "compare": "BETWEEN"}, 1),
    ({"relation": "OR", "a": {"day": 5}, "b": {"month": 12}}, 6),
])
def test_date_query_cases(date_posts, q, n):
    assert date_posts.filter(P.date_query(q)).count() == n


def test_paging_is_a_prefix_free_slice(spark):
    df = spark.createDataFrame([(1, dt.datetime(2020, 1, 1)), (2, dt.datetime(2020, 1, 2)),
                                (3, dt.datetime(2020, 1, 3))], "id long, post_date timestamp_ntz")
    cols = S.sort_columns(None, "desc")
    pages = [[r.id for r in S.paginate(df, cols, page=p, per_page=1).collect()] for p in (1, 2, 3, 4)]
    assert pages == [[3], [2], [1], []]
    assert S.with_total(df, S.paginate(df, cols, page=4, per_page=1)).count() == 0
    assert S.with_total(df, S.paginate(df, cols, page=1, per_page=1), size=1).first()["found"] == 3


def test_tax_slug_in(spark):
    def tags(names):
        return F.array(*[term_struct(F.lit(i + 1), F.lit(n), F.lit(n)) for i, n in enumerate(names)]) if names \
            else F.array().cast("array<struct<term_id:bigint,slug:string,name:string,parent:bigint,"
                                "term_taxonomy_id:bigint,term_order:int,facet:string>>")
    base = spark.range(1)
    df = (base.select(F.lit(1).cast("long").alias("id"), F.create_map(F.lit("post_tag"), tags(["one", "two"])).alias("terms"))
          .unionByName(base.select(F.lit(2).cast("long").alias("id"), F.create_map(F.lit("post_tag"), tags([])).alias("terms")))
          .unionByName(base.select(F.lit(3).cast("long").alias("id"), F.create_map(F.lit("post_tag"), tags(["one", "three"])).alias("terms"))))
    c = P.tax_query([{"taxonomy": "post_tag", "field": "slug", "terms": ["One"]}])
    assert ids(df.filter(c)) == [1, 3]
    c = P.tax_query([{"taxonomy": "post_tag", "field": "slug", "terms": ["one"], "operator": "NOT IN"}])
    assert ids(df.filter(c)) == [2]
    c = P.tax_query([{"taxonomy": "post_tag", "field": "slug", "terms": ["one", "two"], "operator": "AND"}])
    assert ids(df.filter(c)) == [1]
    assert ids(df.filter(P.tax_query([{"taxonomy": "post_tag", "field": "slug", "terms": []}]))) == []


def test_price_filter(spark):
    df = posts_with_meta(spark, ["100", "800", "10000"], key="_price")
    c = P.meta_query([{"key": "_price", "value": [1, 999], "compare": "BETWEEN", "type": "NUMERIC"}])
    assert ids(df.filter(c)) == [1, 2]


def test_author_precedence(spark):
    df = spark.createDataFrame([(i, i) for i in range(1, 7)], "id long, post_author long")
    assert ids(df.filter(P.author_filter(author=5, author__in=[1, 2]))) == [5]
    assert ids(df.filter(P.author_filter(author__in=[1, 2], author__not_in=[1]))) == [1, 2]
    assert ids(df.filter(P.author_filter(author__not_in=[1, 2]))) == [3, 4, 5, 6]


def test_empty_in_list_means_no_filter(spark):
    df = spark.range(3).withColumnRenamed("id", "id")
    assert P.in_filter("id", [0, "", None]) is None
    f = P.post_filter({"post__in": [0, ""], "default_type": False})
    assert df.filter(f).count() == 3
