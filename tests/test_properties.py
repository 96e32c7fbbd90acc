"""Property tests: Spark expressions against plain-Python statements of the rules."""

import random
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st

from vitalmart.functions.stats import cents_mean
from vitalmart.functions.text import band_bounds
from vitalmart.operators.keys import with_position


def py_bounds(text):
    import re
    parts = re.split(r"-|<=", text, maxsplit=1)
    lo = parts[0].replace(">", "").replace(",", "")
    hi = parts[1].replace(",", "") if len(parts) > 1 else None

    def num(s):
        s = s.strip()
        return int(s) if re.fullmatch(r"-?\d{1,17}", s) else None
    lower = 0 if lo.strip() == "" else num(lo)
    upper = 1000000 if hi is None else num(hi)
    return lower, upper


band_text = st.one_of(
    st.builds(lambda a: f"<= {a:,}", st.integers(0, 10**7)),
    st.builds(lambda a, b: f"{a:,}-{b:,}", st.integers(0, 10**7), st.integers(0, 10**7)),
    st.builds(lambda a: f"> {a:,}", st.integers(0, 10**7)),
    st.text(alphabet="0123456789,<=->x ", max_size=12),
)


@settings(max_examples=15, deadline=None)
@given(st.lists(band_text, min_size=1, max_size=200))
def test_band_bounds_match_python(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    lo, hi = band_bounds("v")
    got = [tuple(r) for r in df.select(lo, hi).collect()]
    assert got == [py_bounds(t) for t in texts]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10**9), st.integers(0, 5000)), min_size=1, max_size=300))
def test_cents_mean_is_exact_half_up(spark, pairs):
    rows = [(Decimal(c) / 100, n) for c, n in pairs]
    df = spark.createDataFrame(rows, "s decimal(22,2), n bigint")
    got = [r[0] for r in df.select(cents_mean("s", "n")).collect()]
    want = [None if n == 0 else (s / n).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)
            for s, n in rows]
    assert got == want


@settings(max_examples=6, deadline=None)
@given(st.integers(1, 2000), st.integers(1, 9), st.integers(0, 2**31))
def test_with_position_matches_enumerate(spark, n, parts, seed):
    # a hot leading key holds a third of the rows; the tie-breaker makes the order total
    rnd = random.Random(seed)
    rows = [(0 if i % 3 == 0 else rnd.randrange(50), i) for i in range(n)]
    df = spark.createDataFrame(rows, "k int, i int").repartition(parts)
    got = sorted((r.k, r.i, r.pos) for r in with_position(df, ["k", "i"], "pos").collect())
    want = sorted((k, i, p + 1) for p, (k, i) in enumerate(sorted(rows)))
    assert got == want
