"""How user bitmaps are made: their rows are shuffled as numbers, once."""

from helpers import active_in, stream

from growthledger.plans.bitmaps import activity_bitmaps, distinct_users, user_numbers
from growthledger.plans.facts import fct_events


def test_no_bitmap_is_shuffled_or_sorted(spark):
    weeks = ["2025-01-05", "2025-01-12", "2025-02-02"]
    rows = [e for user in ("u_0001", "u_0002") for p in ("ios", "web") for e in active_in(user, *weeks, platform=p)]
    events = fct_events(stream(spark, *rows, *active_in("u_0003", weeks[0])))
    bitmaps = activity_bitmaps(events, user_numbers(events), ["platform", "event_type"], "2025-01-01")
    counted = distinct_users(bitmaps, ["period_type", "period_start_date"])
    plan = counted._jdf.queryExecution().executedPlan().toString()
    united, made = plan.index("bitmap_or_agg"), plan.rindex("bitmap_construct_agg")
    assert united < made and "Exchange" not in plan[united:made] and "Sort [" not in plan[united:made]
    assert bitmaps.columns == ["period_type", "period_start_date", "platform", "event_type", "bucket", "users"]
    assert {r.n_users for r in counted.where("period_type = 'monthly'").collect()} == {2, 3}
