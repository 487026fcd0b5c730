"""Run parameters: date forms per category and the category lookup's upper-casing."""

import datetime as dt

from tidemark.operators import deltas as dl
from tidemark.params import run_dates_frame


def test_run_dates_frame(spark):
    cutoffs = spark.createDataFrame([("SERV", dt.date(2021, 9, 4))], "subscription_category string, cutoff_date date")
    r = run_dates_frame(cutoffs, dt.date(2021, 10, 3)).first()
    assert (r.cutoff_scd_date, r.cutoff_scd_text, r.cutoff_text, r.today_text, r.yesterday_text) == (
        dt.date(2021, 9, 3), "20210903", "20210904", "20211003", "20211002")


def test_category_filter_upper_cases_the_parameter(spark):
    dim = spark.createDataFrame([("SERV", "IN", "ZCSB"), ("OTHER", "IN", "ZCSB")],
                                "subscription_category string, subscription_type string, sales_document_type string")
    assert [r.subscription_category for r in dl.category_filter(dim, "serv").collect()] == ["SERV"]
    assert [r.subscription_category for r in dl.distinct_categories(dim).orderBy("subscription_category").collect()] == [
        "OTHER", "SERV"]
