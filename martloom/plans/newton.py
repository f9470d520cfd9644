"""SQL of one-predictor Poisson and negative-binomial models: Newton steps over value levels in recursive queries."""

from __future__ import annotations

STEPS = 40


def newton_sql(source: str, out: str) -> str:
    """CTEs that fit `y ~ x` with exposure `e` for every (product_line_id, predictor) of `source`.

    `out` has n_obs, t0, x_sd, coefficient, std_error (unscaled), p_value, dispersion (Pearson), deviance, aic and spread. Models
    need two levels of x and a positive total; others must be left out of `source`.
    """
    model = "product_line_id, predictor"
    return f"""
{out}_u AS (SELECT {model}, x, e, COUNT(*) AS n, SUM(y) AS sy, SUM(y * y) AS yy, SUM(CASE WHEN y > 0 THEN y * LN(y) ELSE 0 END) AS ly, SUM(LGAMMA(y + 1)) AS lf
  FROM {source} WHERE x IS NOT NULL AND y IS NOT NULL GROUP BY ALL),
{out}_c AS (SELECT {model}, SUM(n) AS n_obs, SUM(sy) AS t0, SUM(n * e) AS te, SUM(ly) AS ly, SUM(lf) AS lf, SUM(sy * LN(e)) AS le, SUM(n * x) / SUM(n) AS x_mean, MAX(x) - MIN(x) AS spread FROM {out}_u GROUP BY ALL),
{out}_s AS (SELECT {model}, SQRT(SUM(u.n * (x - x_mean) * (x - x_mean)) / SUM(u.n)) AS x_sd FROM {out}_u u JOIN {out}_c USING ({model}) GROUP BY ALL),
{out}_l AS (SELECT {model}, SUM(sy * (x - x_mean) / x_sd) AS t1, LIST({{'z': (x - x_mean) / x_sd, 'w': n * e, 'e': e, 'n': n, 's': sy, 'q': yy / e}}) AS lv FROM {out}_u JOIN {out}_c c USING ({model}) JOIN {out}_s USING ({model}) GROUP BY ALL),
{out}_i AS (SELECT {model}, 0 AS step, LN(t0 / te) AS a, CAST(0 AS DOUBLE) AS b FROM {out}_c
  UNION ALL SELECT {model}, step + 1, a + (s2 * (t0 - s0) - s1 * (t1 - s1)) / (s0 * s2 - s1 * s1), b + (s0 * (t1 - s1) - s1 * (t0 - s0)) / (s0 * s2 - s1 * s1)
  FROM (SELECT {model}, step, a, b, t0, t1, LIST_SUM(LIST_TRANSFORM(lv, lambda v: v.w * EXP(a + b * v.z))) AS s0, LIST_SUM(LIST_TRANSFORM(lv, lambda v: v.w * v.z * EXP(a + b * v.z))) AS s1,
        LIST_SUM(LIST_TRANSFORM(lv, lambda v: v.w * v.z * v.z * EXP(a + b * v.z))) AS s2 FROM {out}_i JOIN {out}_l USING ({model}) JOIN {out}_c USING ({model}) WHERE step < {STEPS})),
{out}_f AS (SELECT *, LIST_SUM(LIST_TRANSFORM(lv, lambda v: v.w * EXP(a + b * v.z))) AS s0, LIST_SUM(LIST_TRANSFORM(lv, lambda v: v.w * v.z * EXP(a + b * v.z))) AS s1, LIST_SUM(LIST_TRANSFORM(lv, lambda v: v.w * v.z * v.z * EXP(a + b * v.z))) AS s2
  FROM {out}_i JOIN {out}_l USING ({model}) JOIN {out}_c USING ({model}) JOIN {out}_s USING ({model}) WHERE step = {STEPS}),
{out}_g AS (SELECT *, b / x_sd AS coefficient, SQRT(s0 / (s0 * s2 - s1 * s1)) / x_sd AS std_error, a * t0 + b * t1 + le AS eta,
  (LIST_SUM(LIST_TRANSFORM(lv, lambda v: v.q * EXP(-a - b * v.z))) - 2 * t0 + s0) / (n_obs - 2) AS dispersion FROM {out}_f),
{out} AS (SELECT {model}, n_obs, t0, x_sd, spread, coefficient, std_error, {normal_tail_sql('coefficient / std_error')} AS p_value, dispersion, 2 * (ly - eta - t0 + s0) AS deviance, -2 * (eta - s0 - lf) + 4 AS aic FROM {out}_g)"""


def normal_tail_sql(z: str) -> str:
    """Two-sided normal tail to about fifteen digits after the point, by the all-positive series of the error function."""
    x = f"GREATEST(ABS({z}), 1e-150)"
    term = f"EXP(k * 2 * LN({x}) + k * LN(2) - LGAMMA(2 * k + 2) + LGAMMA(k + 1) - {x} * {x} / 2)"
    return f"CASE WHEN ABS({z}) >= 9 THEN 0.0 ELSE GREATEST(1 - {x} * SQRT(2 / PI()) * LIST_SUM(LIST_TRANSFORM(RANGE(0, 200), lambda k: {term})), 0.0) END"


def _shifted_sql(z: str, first: str, each: str) -> str:
    below = " ".join(each.format(v=f"({z} + {j})") for j in range(8))
    return f"({first.format(w=f'({z} + 8)')} {below})"


def digamma_sql(z: str) -> str:
    """Asymptotic series after a shift by eight; so the next one."""
    return _shifted_sql(z, "LN({w}) - 0.5 / {w} - 1 / (12 * {w} * {w}) + 1 / (120 * POW({w}, 4)) - 1 / (252 * POW({w}, 6))", "- 1 / {v}")


def trigamma_sql(z: str) -> str:
    return _shifted_sql(z, "1 / {w} + 0.5 / ({w} * {w}) + 1 / (6 * POW({w}, 3)) - 1 / (30 * POW({w}, 5)) + 1 / (42 * POW({w}, 7))", "+ 1 / ({v} * {v})")


def negbin_sql(source: str, first: str, out: str) -> str:
    """CTEs with theta, coefficient, std_error and p_value of `y ~ x` with variance mu + mu^2 / theta.

    `first` names the Poisson fits of `newton_sql` over the same `source`, all of which are refitted.
    """
    model = "product_line_id, predictor"
    total = lambda rows, value: f"LIST_SUM(LIST_TRANSFORM({rows}, lambda v: {value}))"
    means = "LIST_TRANSFORM(lv, lambda v: {'z': v.z, 'n': v.n, 's': v.s, 'm': v.e * EXP(a + b * v.z)})"
    info = [total("ml", f"v.n * v.m{z} * th / (th + v.m)") + f" AS i{i}" for i, z in enumerate(("", " * v.z", " * v.z * v.z"))]
    left = [total("ml", f"(v.s - v.n * v.m){z} * th / (th + v.m)") + f" AS g{i}" for i, z in enumerate(("", " * v.z"))]
    return f"""
{out}_h AS (SELECT {model}, LIST({{'y': y, 'n': n}}) AS hv FROM (SELECT {model}, y, COUNT(*) AS n FROM {source} WHERE x IS NOT NULL AND y IS NOT NULL GROUP BY ALL) GROUP BY ALL),
{out}_t AS (SELECT {model}, a, b, lv, n_obs, x_sd, {total('ml', 'v.n * v.m * v.m')} / (dispersed - {total('ml', 'v.n * v.m')}) AS th
  FROM (SELECT *, {means} AS ml, {total('lv', 'v.q * v.e - 2 * v.s * v.e * EXP(a + b * v.z) + v.n * POW(v.e * EXP(a + b * v.z), 2)')} AS dispersed FROM {first}_g)),
{out}_i AS (SELECT {model}, 0 AS step, a, b, LN(CASE WHEN th > 0 THEN th ELSE 1e3 END) AS lt FROM {out}_t
  UNION ALL SELECT {model}, step + 1, a + GREATEST(LEAST((i2 * g0 - i1 * g1) / (i0 * i2 - i1 * i1), 2.0), -2.0), b + GREATEST(LEAST((i0 * g1 - i1 * g0) / (i0 * i2 - i1 * i1), 2.0), -2.0),
    lt + GREATEST(LEAST(CASE WHEN th * th * bend + th * slope < 0 THEN -slope / (th * bend + slope) ELSE SIGN(slope) END, 2.0), -2.0)
  FROM (SELECT *, d1 - n_obs * {digamma_sql('th')} + n_obs * (lt + 1) - u1 AS slope, d2 - n_obs * {trigamma_sql('th')} + n_obs / th - u2 AS bend
    FROM (SELECT {model}, step, a, b, lt, th, n_obs, {', '.join(info + left)}, {total('ml', 'v.n * LN(v.m + th) + (v.s + v.n * th) / (v.m + th)')} AS u1, {total('ml', '2 * v.n / (v.m + th) - (v.s + v.n * th) / POW(v.m + th, 2)')} AS u2,
        {total('hv', 'v.n * ' + digamma_sql('(v.y + th)'))} AS d1, {total('hv', 'v.n * ' + trigamma_sql('(v.y + th)'))} AS d2
      FROM (SELECT {model}, step, i.a, i.b, lt, EXP(lt) AS th, n_obs, hv, {means.replace('a + b', 'i.a + i.b')} AS ml
        FROM {out}_i i JOIN (SELECT {model}, lv, n_obs FROM {out}_t) USING ({model}) JOIN {out}_h USING ({model}) WHERE step < {STEPS})))),
{out}_f AS (SELECT {model}, b, th, x_sd, {', '.join(info)} FROM (SELECT {model}, i.b, EXP(lt) AS th, x_sd, {means.replace('a + b', 'i.a + i.b')} AS ml FROM {out}_i i JOIN (SELECT {model}, lv, x_sd FROM {out}_t) USING ({model}) WHERE step = {STEPS})),
{out} AS (SELECT {model}, theta, coefficient, std_error, {normal_tail_sql('coefficient / std_error')} AS p_value
  FROM (SELECT {model}, th AS theta, b / x_sd AS coefficient, SQRT(i0 / (i0 * i2 - i1 * i1)) / x_sd AS std_error FROM {out}_f))"""
