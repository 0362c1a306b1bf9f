"""Plan regressions: filters reach the Parquet scan, unused union branches disappear."""

import contextlib
import io

import __spark_entry__ as E

SF = "/root/testdata/sf0.01"


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_status_filter_pushed_through_view(spark):
    p = plan(E.queries()["flt2_post_status"](spark, SF))
    assert "PushedFilters: [In(o_orderstatus, [F,O])]" in p
    # the other three branches of v_posts are pruned: only orders is scanned
    assert "orders.parquet" in p
    assert not any(t in p for t in ("part.parquet", "documents.parquet", "pages.parquet"))
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in p


def test_date_bounds_pushed(spark):
    p = plan(E.queries()["date2_before_after"](spark, SF))
    assert "GreaterThan(o_orderdate" in p and "LessThan(o_orderdate" in p


def test_no_cartesian_products_in_search(spark):
    for key in ("txt1_match_any", "txt3_phrase", "txt6_fuzzy", "cur1_pinned_positions", "agg14_counts_ignoring_selection"):
        p = plan(E.queries()[key](spark, SF))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, key
