"""Normal and Student-t functions as SQL expressions (the same text in Spark and in the oracle) and small numpy tables."""

from __future__ import annotations

import numpy as np

# Coefficients of the published rational approximations (normal CDF: Hart 1968 / West 2005; quantile: AS 241).
CDF_NUM = [3.52624965998911e-02, 0.700383064443688, 6.37396220353165, 33.912866078383, 112.079291497871, 221.213596169931, 220.206867912376]
CDF_DEN = [8.83883476483184e-02, 1.75566716318264, 16.064177579207, 86.7807322029461, 296.564248779674, 637.333633378831, 793.826512519948, 440.413735824752]
PPF_A = [2509.0809287301226727, 33430.575583588128105, 67265.770927008700853, 45921.953931549871457, 13731.693765509461125, 1971.5909503065514427, 133.14166789178437745, 3.3871328727963666080]
PPF_B = [5226.4952788528545610, 28729.085735721942674, 39307.895800092710610, 21213.794301586595867, 5394.1960214247511077, 687.18700749205790830, 42.313330701600911252, 1.0]
PPF_C = [7.74545014278341407640e-4, 2.27238449892691845833e-2, 2.41780725177450611770e-1, 1.27045825245236838258, 3.64784832476320460504, 5.76949722146069140550, 4.63033784615654529590, 1.42343711074968357734]
PPF_D = [1.05075007164441684324e-9, 5.47593808499534494600e-4, 1.51986665636164571966e-2, 1.48103976427480074590e-1, 6.89767334985100004550e-1, 1.67638483018380384940, 2.05319162663775882187, 1.0]
PPF_E = [2.01033439929228813265e-7, 2.71155556874348757815e-5, 1.24266094738807843860e-3, 2.65321895265761230930e-2, 2.96560571828504891230e-1, 1.78482653991729133580, 5.46378491116411436990, 6.65790464350110377720]
PPF_F = [2.04426310338993978564e-15, 1.42151175831644588870e-7, 1.84631831751005468180e-5, 7.86869131145613259100e-4, 1.48753612908506148525e-2, 1.36929880922735805310e-1, 5.99832206555887937690e-1, 1.0]


def num(x: float) -> str:
    return f"CAST({x!r} AS DOUBLE)"


def poly(coefficients: list[float], x: str) -> str:
    """Horner's form, the highest power first."""
    out = num(coefficients[0])
    for c in coefficients[1:]:
        out = f"({out} * {x} + {num(c)})"
    return out


def norm_cdf(z: str) -> str:
    a = f"abs({z})"
    e = f"exp(-({z}) * ({z}) / 2)"
    b = f"({a} + {num(0.65)})"
    for k in (4, 3, 2, 1):
        b = f"({a} + {k} / {b})"
    tail = f"CASE WHEN {a} > 37 THEN {num(0.0)} WHEN {a} < {num(7.07106781186547)} THEN {e} * {poly(CDF_NUM, a)} / {poly(CDF_DEN, a)} ELSE {e} / {b} / {num(2.506628274631)} END"
    return f"(CASE WHEN ({z}) > 0 THEN 1 - {tail} ELSE {tail} END)"


def norm_ppf(p: str) -> str:
    q = f"(({p}) - {num(0.5)})"
    near = f"({num(0.180625)} - {q} * {q})"
    r = f"sqrt(-ln(CASE WHEN {q} < 0 THEN ({p}) ELSE 1 - ({p}) END))"
    mid, far = f"({r} - {num(1.6)})", f"({r} - {num(5.0)})"
    tail = f"(CASE WHEN {r} <= 5 THEN {poly(PPF_C, mid)} / {poly(PPF_D, mid)} ELSE {poly(PPF_E, far)} / {poly(PPF_F, far)} END)"
    return f"(CASE WHEN ({p}) IS NULL OR ({p}) <= 0 OR ({p}) >= 1 THEN NULL WHEN abs({q}) <= {num(0.425)} THEN {q} * {poly(PPF_A, near)} / {poly(PPF_B, near)} WHEN {q} < 0 THEN -{tail} ELSE {tail} END)"


def two_tailed(z: str) -> str:
    """2 * norm_cdf(-|z|), which keeps the digits of small values."""
    return f"(2 * {norm_cdf(f'(-abs({z}))')})"


def incomplete_beta(a: np.ndarray, b: float, x: np.ndarray) -> np.ndarray:
    """Regularised, by Lentz's continued fraction; all arrays."""
    from math import lgamma

    a, x = np.broadcast_arrays(np.asarray(a, float), np.asarray(x, float))
    swap = x > (a + 1) / (a + b + 2)
    p, q, y = np.where(swap, b, a), np.where(swap, a, b), np.where(swap, 1 - x, x)
    log = np.vectorize(lgamma, otypes=[float])
    front = np.exp(log(p + q) - log(p) - log(q) + p * np.log(np.maximum(y, 1e-300)) + q * np.log1p(-np.minimum(y, 1 - 1e-16))) / p
    tiny = 1e-300
    c, d = np.ones_like(y), 1 / np.maximum(np.abs(1 - (p + q) * y / (p + 1)), tiny) * np.sign(1 - (p + q) * y / (p + 1) + tiny)
    f = d.copy()
    for m in range(1, 200):
        for top in (m * (q - m) * y / ((p + 2 * m - 1) * (p + 2 * m)), -(p + m) * (p + q + m) * y / ((p + 2 * m) * (p + 2 * m + 1))):
            d = 1 + top * d
            c = 1 + top / c
            d, c = 1 / np.where(np.abs(d) < tiny, tiny, d), np.where(np.abs(c) < tiny, tiny, c)
            f = f * d * c
    out = np.where(x <= 0, 0.0, np.where(x >= 1, 1.0, front * f))
    return np.where(swap & (x > 0) & (x < 1), 1 - out, out)


def t_sf(t: np.ndarray, df: np.ndarray) -> np.ndarray:
    """Two-tailed p of Student's t."""
    return incomplete_beta(np.asarray(df, float) / 2, 0.5, df / (df + np.asarray(t, float) ** 2))


T_ROWS = 2_000


def t_table(p: float = 0.975, rows: int = T_ROWS) -> np.ndarray:
    """Quantiles for df = 1..rows by bisection; a table of fixed size."""
    df = np.arange(1, rows + 1, dtype=float)
    lo, hi = np.zeros(rows), np.full(rows, 700.0)
    for _ in range(60):
        mid = (lo + hi) / 2
        low = t_sf(mid, df) > 2 * (1 - p)
        lo, hi = np.where(low, mid, lo), np.where(low, hi, mid)
    return (lo + hi) / 2


def t_beyond(df: str, z: float = 1.959963984540054) -> str:
    """The expansion of the 0.975 quantile for df beyond the table, good to 1e-12 there."""
    g1, g2, g3 = (z**3 + z) / 4, (5 * z**5 + 16 * z**3 + 3 * z) / 96, (3 * z**7 + 19 * z**5 + 17 * z**3 - 15 * z) / 384
    return f"({num(z)} + {num(g1)} / {df} + {num(g2)} / ({df} * {df}) + {num(g3)} / ({df} * {df} * {df}))"


# Royston's AS R94 polynomials, lowest power first.
SW_C1 = [0.0, 0.221157, -0.147981, -2.07119, 4.434685, -2.706056]
SW_C2 = [0.0, 0.042981, -0.293762, -1.752461, 5.682633, -3.582633]
SW_MEAN_SMALL, SW_SD_SMALL = [0.544, -0.39978, 0.025054, -0.0006714], [1.3822, -0.77857, 0.062767, -0.0020322]
SW_MEAN_LARGE, SW_SD_LARGE = [-1.5861, -0.31082, -0.083751, 0.0038915], [-0.4803, -0.082676, 0.0030302]


def low_first(coefficients: list[float], x: str) -> str:
    return poly(coefficients[::-1], x)


def shapiro_p(w: str, n: str) -> str:
    """p of the Shapiro-Wilk statistic w for n values (3 to 5000)."""
    w1 = f"(CASE WHEN {w} >= 1 THEN {num(1 - 1e-16)} ELSE {w} END)"
    three = f"greatest({num(0.0)}, {num(6 / np.pi)} * (asin(sqrt({w1})) - asin(sqrt({num(0.75)}))))"
    log = f"ln({n})"
    small = f"(-ln(({num(0.459)} * {n} - {num(2.273)}) - ln(1 - {w1})) - {low_first(SW_MEAN_SMALL, n)}) / exp({low_first(SW_SD_SMALL, n)})"
    large = f"(ln(1 - {w1}) - {low_first(SW_MEAN_LARGE, log)}) / exp({low_first(SW_SD_LARGE, log)})"
    gamma = f"({num(0.459)} * {n} - {num(2.273)})"
    return f"(CASE WHEN {n} < 3 OR {n} > 5000 OR {w} IS NULL THEN NULL WHEN {n} = 3 THEN {three} WHEN {n} <= 11 THEN (CASE WHEN ln(1 - {w1}) >= {gamma} THEN {num(0.0)} ELSE 1 - {norm_cdf('(' + small + ')')} END) ELSE 1 - {norm_cdf('(' + large + ')')} END)"
