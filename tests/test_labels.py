"""Facts of labels are computed once a label."""

from __future__ import annotations

import pytest

from studygraph import plans


@pytest.mark.parametrize("name", ["day_extract", "window_extract", "dose_extract", "encounter_type", "split_timing", "note_validity"])
def test_labels_are_read_once(spark, name):
    """No pattern or rule stands above the join with the customers."""
    plan = plans.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    above, _, below = plan.partition("Join Cross") if "Join Cross" in plan else plan.partition("Join Inner")
    assert below and not any(w in above.lower() for w in ("regexp", "rlike", "contains", "lower(", "case when")), above
