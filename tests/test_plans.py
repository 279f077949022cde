"""What plans must not do, whatever their results: shuffle whole texts without need, copy bound values."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from opinionlake.functions.lookup import let
from opinionlake.operators.conform import conform
from opinionlake.plans.governance import source_records
from opinionlake.registry.base import DEAL
from opinionlake.registry.views import records
from opinionlake.schemas import GOLD_BASE

SF = "/root/testdata/sf0.001"


def _shuffles_of_text(capsys, frame) -> int:
    frame.explain("formatted")
    return len(re.findall(r"\) Exchange\nInput \[\d+\]: \[[^\]]*\b_?(?:body_)?text#", capsys.readouterr().out))


@pytest.fixture
def no_broadcast(spark):
    before = {name: spark.conf.get(name, None) for name in ("spark.sql.autoBroadcastJoinThreshold", DEAL)}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.unset(DEAL)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_records_without_text_shuffle_no_text(spark, capsys, no_broadcast):
    narrow = records(spark, SF).select("bronze_source", "url", "title", "score", "body_text_missing")
    assert _shuffles_of_text(capsys, narrow) == 0


def test_both_joins_share_one_shuffle_of_the_texts(spark, capsys, no_broadcast):
    assert _shuffles_of_text(capsys, records(spark, SF).select("doc_id", "body_text", "score")) == 1


def test_source_kpis_shuffle_no_aggregate_once_per_key(spark, capsys):
    rows = spark.createDataFrame([("a", "f1", "u1", 1.0), ("a", "f2", "u1", 2.0), (None, "f1", None, 3.0), (None, "f1", None, 4.0)],
                                 "source string, bronze_source string, url string, score double")
    gold = conform(rows, GOLD_BASE)
    got = {(r.source, r.is_total): (r.total_records, r.duplicate_rate, r.actual_runs) for r in source_records(gold, outliers=()).collect()}
    assert got == {(None, True): (4, 50.0, 2), ("a", False): (2, 50.0, 2), (None, False): (2, 50.0, 1)}
    source_records(gold, outliers=()).explain("formatted")
    keyed = re.findall(r"Exchange\nInput \[(\d+)\]: \[[^\]]*\burl#", capsys.readouterr().out)
    # a row per key holds the key, its group and no other column
    assert keyed and max(map(int, keyed)) <= 3


def test_bound_value_is_taken_once_and_not_copied(spark):
    rows = spark.createDataFrame([(["a", "b"],), ([],), (None,)], "w array<string>")
    got = rows.select(let(F.col("w"), lambda w: F.struct(w.alias("w"), F.size(w).alias("n"))).alias("s"))
    assert [tuple(r.s) for r in got.collect()][:2] == [(["a", "b"], 2), ([], 0)]
    # a transform copies what its lambda returns, arrays with all their strings
    assert "transform(" not in got._jdf.queryExecution().optimizedPlan().toString()
