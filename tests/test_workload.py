"""A cross-section of the registered queries against their SQL; `python -m workload.check` runs all."""

import os

import pytest

import __spark_entry__ as entry
from workload.check import compare

FOLDER = "/root/testdata/sf0.001"
CHOSEN = [
    "s11_json_payloads", "v04_duplicate_rows", "c07_clean_chain", "f14_feature_chain", "t07_prepared_transfers", "a28_alert_features",
    "a28_large_alerts", "p02_stratified_split", "p03_medians_by_selection", "e07_top_k", "e10_points_on_test", "b08_best_by_f1_over_modes",
    "d04_column_verdicts", "x04_reasons", "k01_correlations", "q01_review_queue",
]

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the test tables")


@pytest.mark.parametrize("name", CHOSEN)
def test_query_agrees_with_sql(spark, name):
    ok, text = compare(spark, FOLDER, name, entry.queries()[name], entry.oracle_sql()[name])
    assert ok, text


def test_keys():
    assert set(entry.oracle_sql()) <= set(entry.queries())
