"""Property-based checks of the exact building blocks (few examples: each runs Spark jobs)."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from txrisk.operators.quantiles import exact_quantiles

values = st.lists(
    st.one_of(st.integers(-5, 5).map(float), st.floats(-1e6, 1e6, allow_nan=False, allow_infinity=False)),
    min_size=1, max_size=400,
)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(xs=values, p=st.sampled_from([0.0, 0.005, 0.25, 0.5, 0.9, 0.995, 1.0]))
def test_quantile_equals_numpy(spark, xs, p):
    df = spark.createDataFrame([(x,) for x in xs], "x double").repartition(3)
    got = exact_quantiles(df, ["x"], [p])[("x", p)]
    assert got == pytest.approx(float(np.percentile(np.array(xs), 100 * p)), rel=1e-12, abs=1e-9)
