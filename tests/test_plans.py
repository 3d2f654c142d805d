"""Plans the queries must keep at any size."""

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
QUERIES = entry.queries()


def plan(spark, name):
    text = QUERIES[name](spark, SF)._jdf.queryExecution().toString()
    return text[text.index("== Physical Plan =="):]


# Those that only plan; the others fit models or write files first.
PLANNED = [
    "donor_profile", "updated_donors", "donor_totals", "donor_candidate_summary", "cross_year_refunds",
    "refunds_by_state", "attributed_transactions", "dedupe_donors", "link_contributions", "parse_names",
    "committee_year_facts", "party_by_state", "amount_histogram", "likelihood_training_frame",
    "point_in_time_features", "spread_sample_pairs", "stratified_split_counts", "roc_auc", "roc_curve",
    "feature_medians", "cluster_summary", "davies_bouldin",
]


@pytest.mark.parametrize("name", PLANNED)
def test_no_cross_join_and_no_row_udf(spark, name):
    text = plan(spark, name)
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert word not in text


def test_date_filter_and_columns_reach_the_scan(spark):
    text = plan(spark, "transactions_by_year")
    assert "l_discount" not in text and "o_totalprice" not in text


def test_refund_patterns_take_one_pass(spark):
    text = plan(spark, "cross_year_refunds")
    # The stand-in transactions are a join of two tables.
    assert text.count("FileScan parquet") == 2


def test_profile_has_no_distinct_expansion(spark):
    assert "Expand" not in plan(spark, "donor_profile")


def test_top_values_are_cut_before_the_shuffle(spark):
    text = plan(spark, "cluster_top_occupations")
    assert text.count("WindowGroupLimit") >= 2


def test_training_pairs_are_grouped_once(spark):
    # Pairs and their history come from one scan of the transactions; the donor table is stored.
    leaves = QUERIES["likelihood_training_frame"](spark, SF)._jdf.queryExecution().optimizedPlan().collectLeaves()
    assert sum("l_extendedprice" in leaves.apply(i).toString() for i in range(leaves.size())) == 1
