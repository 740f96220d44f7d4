"""Random policies: the spine equals a brute-force day loop, and the month-level user-month table
equals the one folded from the day rows (leap years, year ends, one-day and empty policies)."""

from __future__ import annotations

import calendar
import datetime as dt
import random
from decimal import ROUND_HALF_UP, Decimal

import pytest

from premiumlake.operators.spine import daily_activity, user_months, user_months_from_policies
from premiumlake.sources.files import policies_from_rows

AS_OF = dt.date(2024, 3, 10)


def random_policies(seed: int, n: int):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        acq = dt.date(2022, 1, 1) + dt.timedelta(days=rnd.randint(0, 700))
        start = acq + dt.timedelta(days=rnd.randint(0, 40))
        kind = rnd.random()
        if kind < 0.15:
            churn = None  # open: runs to AS_OF (or gives no rows when it starts later)
        elif kind < 0.25:
            churn = start - dt.timedelta(days=rnd.randint(1, 5))  # ends before it starts
        elif kind < 0.35:
            churn = start  # a single day
        else:
            churn = start + dt.timedelta(days=rnd.randint(1, 500))
        premium = Decimal(rnd.randint(1, 99999)).scaleb(-2)
        rows.append((f"U{i % (n // 2)}", acq, start, churn, premium, rnd.choice(["legal", "household"])))
    return rows


def brute_spine(rows):
    out = []
    for user, acq, start, churn, premium, group in rows:
        end = churn if churn is not None else AS_OF
        d = start
        while d <= end:
            dim = calendar.monthrange(d.year, d.month)[1]
            daily = (premium / dim).quantize(Decimal("0.000001"), rounding=ROUND_HALF_UP)
            out.append((d, user, group, daily, (d - acq).days, d.strftime("%Y-%m")))
            d += dt.timedelta(days=1)
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_spine_matches_brute_force(spark, seed):
    rows = random_policies(seed, 60)
    df = daily_activity(policies_from_rows(spark, rows), AS_OF)
    got = sorted(
        (
            (r.activity_date, r.user_id, r.product_group, r.daily_premium, r.days_since_acquisition, r.activity_month)
            for r in df.collect()
        ),
        key=repr,
    )
    assert got == brute_spine(rows)


@pytest.mark.parametrize("seed", [3, 4])
def test_month_level_path_equals_day_level_path(spark, seed):
    pol = policies_from_rows(spark, random_policies(seed, 80))
    a = sorted((tuple(r) for r in user_months(daily_activity(pol, AS_OF)).collect()), key=repr)
    b = sorted((tuple(r) for r in user_months_from_policies(pol, AS_OF).collect()), key=repr)
    assert a == b
