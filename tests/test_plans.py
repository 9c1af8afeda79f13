"""Plan-shape checks: column pruning, partial aggregation, join strategy."""

from revlens.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


def executed_plan(df) -> str:
    import re
    df.collect()
    return re.sub(r"#\d+L?", "", df._jdf.queryExecution().executedPlan().toString())


def test_counts_prune_columns_and_aggregate_partially(spark):
    plan = executed_plan(QUERIES["count_by_category_sentiment_orders"](spark, SF))
    assert "partial_count" in plan
    assert "o_totalprice" not in plan and "o_orderdate" not in plan and "c_name" not in plan
    assert "SortMergeJoin" not in plan


def test_word_counts_do_not_build_split_arrays(spark):
    plan = executed_plan(QUERIES["review_word_counts"](spark, SF))
    assert "split(" not in plan and "replace(" in plan


def test_naive_bayes_lookup_is_broadcast_and_explode_is_outer(spark):
    plan = executed_plan(QUERIES["nb_predictions"](spark, SF))
    assert "Generate explode(tokens), [id], true" in plan  # outer: no inferred filter
    assert "BroadcastHashJoin [token]" in plan
    assert "partial_sum" in plan


def test_no_window_over_data_in_split(spark):
    plan = executed_plan(QUERIES["stratified_split_orders"](spark, SF))
    assert "Window" not in plan and "SortMergeJoin" not in plan


def test_histogram_grid_join_is_bounded_broadcast(spark):
    plan = executed_plan(QUERIES["word_count_histogram"](spark, SF))
    assert "BroadcastHashJoin" in plan and "Range (0, 100" in plan


def test_counts_on_cleaned_reviews_read_and_move_only_what_they_need(spark):
    """Cleaning tests the text for null, so it is scanned; it is not moved
    to the aggregate, other columns aren't read, and nothing is written."""
    plan = executed_plan(QUERIES["count_by_category_sentiment"](spark, SF))
    scans = [line for line in plan.splitlines() if "ReadSchema" in line]
    assert scans and not any("source" in line.split("ReadSchema")[1] for line in scans)
    assert not any("review_body" in line for line in plan.splitlines() if "Aggregate" in line)
    assert "InsertInto" not in plan
