import numpy as np
import pytest

from plumbline.functions.numeric import norm_cdf, norm_ppf, t_sf, t_table


def test_published_values(spark):
    row = spark.sql(f"SELECT {norm_ppf('p')} AS q, {norm_cdf('z')} AS c FROM (SELECT CAST(0.975 AS DOUBLE) AS p, CAST(-1.959963984540054 AS DOUBLE) AS z) x").first()
    assert row.q == pytest.approx(1.959963984540054, abs=1e-12)
    assert row.c == pytest.approx(0.025, abs=1e-12)
    t = t_table()
    assert t[0] == pytest.approx(12.7062047, abs=1e-6) and t[9] == pytest.approx(2.2281389, abs=1e-6) and t[99] == pytest.approx(1.9839715, abs=1e-6)
    assert float(t_sf(np.array(2.0), np.array(10.0))) == pytest.approx(0.0733880, abs=1e-6)


@pytest.mark.parametrize(
    ("values", "p"),
    [([148, 154, 158, 160, 161, 162, 166, 170, 182, 195, 236], 0.0067), ([65, 61, 63, 86, 70, 55, 74, 35, 72, 68, 45, 58], 0.92165)],
)
def test_shapiro_examples(spark, values, p):
    from plumbline.plans.norms import shapiro

    rows = spark.createDataFrame([("m", "Alpha", float(v)) for v in values], "metric string, band string, value double")
    assert shapiro(rows, ["metric", "band"]).first().normality_p == pytest.approx(p, abs=2e-4)
