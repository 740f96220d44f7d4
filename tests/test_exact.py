"""round_ratio equals exact half-away-from-zero rounding, including huge operands and values a
hair away from a rounding boundary (where rounding the quotient first would go wrong)."""

from __future__ import annotations

import random
from decimal import ROUND_HALF_UP, Decimal, localcontext

from pyspark.sql import functions as F

from premiumlake.functions.exact import round_ratio


def exact(num: Decimal, den: Decimal, scale: int, shift: int) -> Decimal | None:
    if den == 0:
        return None
    with localcontext() as ctx:
        ctx.prec = 200
        q = num / den * (Decimal(10) ** shift)
        return q.quantize(Decimal(1).scaleb(-scale), rounding=ROUND_HALF_UP)


def cases(seed: int, n: int):
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        kind = rnd.random()
        if kind < 0.4:
            num = Decimal(rnd.randint(-10**12, 10**12)).scaleb(-2)
            den = Decimal(rnd.randint(-10**12, 10**12)).scaleb(-2)
        elif kind < 0.7:  # large denominators: quotient boundaries far below the 6th place
            den = Decimal(rnd.randint(10**15, 10**18)).scaleb(-2)
            k = rnd.randint(0, 10**4)
            num = (den * (Decimal(2 * k + 1) / 200)).quantize(Decimal("0.01"))  # near k.5 hundredths
            num += Decimal(rnd.choice([-1, 0, 1])).scaleb(-2)
        else:  # exact ties
            den = Decimal(rnd.choice([2, 4, 8, 16, 40, 80])) * Decimal(rnd.randint(1, 10**6))
            num = Decimal(rnd.randint(-10**6, 10**6)) * den / 1000 + den / 2000
            num = num.quantize(Decimal("0.01"))
        out.append((num, den))
    return out


def test_round_ratio_is_exact(spark):
    rows = cases(7, 3000) + [(Decimal("1.00"), Decimal("0.00")), (Decimal("0.00"), Decimal("3.00"))]
    df = spark.createDataFrame(rows, "n decimal(28,2), d decimal(28,2)")
    for scale, shift in [(2, 0), (4, 2), (1, 2), (0, 0)]:
        got = [r.r for r in df.select(round_ratio(F.col("n"), F.col("d"), scale, shift).alias("r")).collect()]
        want = [exact(n, d, scale, shift) for n, d in rows]
        assert got == want, (scale, shift)


def test_round_ratio_handles_huge_quotients(spark):
    df = spark.createDataFrame([(Decimal("1000000000000000.00"), Decimal("0.01"))], "n decimal(28,2), d decimal(28,2)")
    got = df.select(round_ratio(F.col("n"), F.col("d"), 4, shift=2).alias("r")).collect()[0].r
    assert got == Decimal("10000000000000000000.0000")  # 1e19 %: beyond a long once scaled by 10^4
