"""Randomized properties of imputation and completeness against a plain
Python statement of the rule."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from loadcast.operators.clean import complete_rows, impute_area_mean

values = st.one_of(st.none(), st.just(float("nan")),
                   st.integers(-50, 50).map(float))
rows = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)), values, values),
                min_size=0, max_size=25)


def _expected(data):
    out = []
    for key, a, b in data:
        filled = []
        for i, v in ((1, a), (2, b)):
            if v is None and key is not None:
                vals = [r[i] for r in data if r[0] == key and r[i] is not None]
                if vals:
                    v = math.nan if any(math.isnan(x) for x in vals) else sum(vals) / len(vals)
            filled.append(v)
        out.append((key, *filled))
    return out


def _norm(rows_):
    return sorted((tuple("nan" if isinstance(x, float) and math.isnan(x) else x for x in r)
                   for r in rows_), key=repr)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows)
def test_impute_matches_the_rule(spark, data):
    df = spark.createDataFrame(data, "AREA_NO int, A double, B double")
    got = [tuple(r) for r in impute_area_mean(df, ["A", "B"]).collect()]
    want = _expected(data)
    assert len(got) == len(want)
    g, w = _norm(got), _norm(want)
    for x, y in zip(g, w):
        for p, q in zip(x, y):
            assert p == q or (isinstance(p, float) and isinstance(q, float)
                              and math.isclose(p, q, rel_tol=1e-12))
    # complete rows: no null, no NaN anywhere
    kept = complete_rows(df).collect()
    assert all(v is not None and not (isinstance(v, float) and math.isnan(v))
               for r in kept for v in r)
    assert len(kept) == sum(1 for r in data if all(
        v is not None and not (isinstance(v, float) and math.isnan(v)) for v in r))
