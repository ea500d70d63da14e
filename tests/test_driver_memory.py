"""What is sent to the driver to be broadcast."""

from __future__ import annotations

import re

import pytest

from framewright.operators import audit


def broadcast(plan: str) -> list[str]:
    """What each broadcast gathers: the lines of a plan below it."""
    lines, found = plan.splitlines(), []
    depth = lambda line: re.search(r"[A-Za-z(*]", line).start()
    for k, line in enumerate(lines):
        if "BroadcastExchange" in line:
            below = [x for x in lines[k + 1 :]]
            end = next((i for i, x in enumerate(below) if depth(x) <= depth(line)), len(below))
            found.append("\n".join(below[:end]))
    return found


@pytest.mark.parametrize("made", [audit.nearest_selected, audit.audit_table])
def test_no_multiplied_rows_are_broadcast(spark, made):
    """Before, the squares of all selected positions, 9 for each of up to 17 levels, were one broadcast, and so were all frames."""
    rows = [(k % 3, k, float(k % 17), float(k % 23), k % 2 == 0, 0.5, 0, 0) for k in range(200)]
    frames = spark.createDataFrame(rows, "flight long, frame long, easting double, northing double, selected boolean, quality_score double, cell_x long, cell_y long")
    found = made(frames)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert int(spark.conf.get("spark.sql.autoBroadcastJoinThreshold")[:-1]) > 0
    for below in broadcast(plan):
        # only tables of a row a flight or a selected position, no frames and no squares
        assert not re.search(r"\bi#\d+|\bd#\d+|\bframe#\d+", below), below
    assert found.count() == 200
