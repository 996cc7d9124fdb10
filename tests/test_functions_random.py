"""Randomised checks of the Column helpers against plain-Python versions of the rules."""

from __future__ import annotations

import random
from decimal import ROUND_HALF_UP, Decimal, localcontext

from pyspark.sql import functions as F

from ledgerline import params as P
from ledgerline.functions.money import numeric_pct, quotient9, rate_pct, ratio2
from ledgerline.functions.text import initcap_words, ws_trim


def _money(rng: random.Random) -> Decimal:
    scale = rng.choice([1, 10, 100, 10_000, 1_000_000])
    return Decimal(rng.randint(-scale * 100, scale * 100)) / 100


def _q(x: Decimal, exp: str) -> Decimal:
    return x.quantize(Decimal(exp), rounding=ROUND_HALF_UP)   # half away from zero


def test_money_helpers_match_decimal_arithmetic(spark):
    rng = random.Random(7)
    pairs = [(_money(rng), _money(rng)) for _ in range(400)]
    pairs += [(Decimal("1.00"), Decimal("8.00")), (Decimal("0.01"), Decimal("200.00")),
              (Decimal("5500.90"), Decimal("9000.90")), (Decimal("-1.00"), Decimal("0.00")),
              (Decimal("1.00"), Decimal("3.00")), (Decimal("-2.00"), Decimal("3.00"))]
    df = spark.createDataFrame(pairs, "n decimal(18,2), d decimal(18,2)")
    got = df.select("n", "d", quotient9("n", "d").alias("q9"), ratio2("n", "d").alias("r2"),
                    numeric_pct("n", "d").alias("np"), rate_pct("n", "d").alias("rp")).collect()
    with localcontext() as ctx:
        ctx.prec = 60
        for r in got:
            if r.d == 0:
                assert (r.q9, r.r2, r.np, r.rp) == (None, None, None, None)
                continue
            q9 = _q(r.n / r.d, "1e-9")
            assert r.q9 == q9, (r.n, r.d)
            assert r.r2 == _q(q9, "0.01"), (r.n, r.d)
            assert r.np == _q(q9 * 100, "0.01"), (r.n, r.d)
            assert r.rp == _q(r.n * 100 / r.d, "0.01"), (r.n, r.d)


def _initcap_rule(s: str) -> str:
    out, start = [], True
    for ch in s:
        out.append(ch.upper() if start else ch.lower())
        start = ch.isspace() or ch in P.INITCAP_DELIMITERS
    return "".join(out)


def test_initcap_and_trim_match_the_rule(spark):
    rng = random.Random(11)
    alphabet = "abcXYZ éÉ" + "\t" + "-./(),'_" + "0123456789"
    words = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 14))) for _ in range(300)]
    df = spark.createDataFrame([(w,) for w in words], "s string")
    got = df.select("s", initcap_words(F.col("s")).alias("i"), ws_trim(F.col("s")).alias("t")).collect()
    for r in got:
        assert r.i == _initcap_rule(r.s), repr(r.s)
        assert r.t == r.s.strip(P.WHITESPACE), repr(r.s)
