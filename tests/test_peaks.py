"""Close peaks in clusters of any size: against the plain rule, in a fixed number of jobs."""

import random

import pytest

from seriesml.operators import peaks
from seriesml.operators.ordering import SeriesLayout


def by_hand(points, distance):
    kept = []
    for h, p in sorted(((h, p) for p, h in points), reverse=True):
        if all(abs(p - k) >= distance for k in kept):
            kept.append(p)
    return sorted(kept)


def candidates(spark, points):
    return spark.createDataFrame([("s", p, float(h)) for p, h in points], "series string, pos bigint, height double")


def settled(spark, points, distance, block, small=0):
    layout = SeriesLayout(("series",), ("pos",), 5_000_000)
    return sorted(r["pos"] for r in peaks.suppress_close(candidates(spark, points), layout, distance, small, block).collect())


@pytest.mark.parametrize("distance,block", [(2, 8), (3, 12), (5, 20), (5, 64), (9, 36), (17, 70)])
@pytest.mark.parametrize("heights", [3, 1000])
def test_blocks_agree_with_one_pass(spark, distance, block, heights):
    rng = random.Random(distance * block + heights)
    points, at = [], 0
    for _ in range(700):
        at += rng.choice([2, 2, 3, 4, rng.randint(2, 3 * distance)])
        points.append((at, rng.randrange(heights)))
    assert settled(spark, points, distance, block) == by_hand(points, distance)


@pytest.mark.parametrize("step", [1, -1, 0])
def test_one_long_chain(spark, step):
    """100,000 rows fall, rise or stay level: what is kept at one end decides all the way to the other."""
    points = [(2 * i, step * i) for i in range(50_000)]
    assert settled(spark, points, 5, 200) == by_hand_chain(points, step)


def by_hand_chain(points, step):
    ordered = points if step < 0 else points[::-1]
    kept, last = [], None
    for p, _ in ordered:
        if last is None or abs(p - last) >= 5:
            kept.append(p)
            last = p
    return sorted(kept)


def test_jobs_do_not_grow_with_the_chain(spark):
    def jobs(n):
        spark.sparkContext.setJobGroup(f"chain{n}", "")
        settled(spark, [(2 * i, -i) for i in range(n)], 5, 50)
        found = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"chain{n}"))
        spark.sparkContext.setJobGroup("", "")
        return found
    assert jobs(600) == jobs(6000)
