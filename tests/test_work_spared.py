"""Work the queries do not do twice: wide shuffles, staged copies, methods too long to compile."""

from __future__ import annotations

import contextlib
import io
import re

import pytest
from conftest import SMALL

from aerolag.operators.rows import observe_incomplete
from aerolag.plans.features import feature_frame, minutes_table, type_table
from aerolag.registry import queries as registered
from aerolag.sources.order_flights import order_flights
from aerolag.storage import stage


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def method_sizes(spark, df):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = io.StringIO()
        with contextlib.redirect_stdout(out):
            df.explain("codegen")
        return [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", out.getvalue())]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_line_items_meet_orders_and_customers_joined(spark):
    text = optimized(order_flights(spark, SMALL))
    joins = [line for line in text.splitlines() if "Join Inner" in line]
    depth = {name: line.index("Join") for line in joins for name in ("l_orderkey", "o_custkey") if f"({name}#" in line}
    # The customers are below the join of line items and orders, so that line items are not shuffled for them.
    assert depth["o_custkey"] > depth["l_orderkey"]


def test_few_columns_are_shuffled(spark):
    text = optimized(order_flights(spark, SMALL))
    above = text[: text.index("Join Inner")]
    for made in ("crsdeptime", "crsarrtime", "dayofmonth", "_dry_delay"):
        assert made in above and made not in text[text.index("Join Inner") :]


def test_methods_with_the_joins_are_small_enough_to_compile(spark):
    frame = feature_frame(order_flights(spark, SMALL))
    for df in (type_table(frame), observe_incomplete(minutes_table(frame))[0]):
        sizes = method_sizes(spark, df)
        assert sizes and max(sizes) < 8000


@pytest.mark.parametrize("name", ["table_refresh", "refresh_after_failure"])
def test_refreshed_rows_are_written_once(spark, monkeypatch, name):
    staged = []
    monkeypatch.setattr(registered, "stage", lambda df, name, path=None: staged.append(name) or stage(df, name, path))
    found = registered.queries()[name](spark, SMALL)
    assert staged == []
    assert found.exceptAll(registered.features_type(spark, SMALL)).isEmpty() and found.count() == 5950


def test_type_rows_are_made_once_for_rules_and_models(spark, monkeypatch):
    made = []
    monkeypatch.setattr(registered, "dropna_type", lambda *at: made.append(at) or spark.range(1))
    monkeypatch.setattr(registered, "_ruled_types", lambda complete: (_ for _ in ()).throw(KeyError(len(made))))
    with pytest.raises(KeyError, match="1"):
        registered.delay_type_eval(spark, SMALL)
