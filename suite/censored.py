"""Regression on order statistics over whole tables, by location and characteristic."""

from __future__ import annotations

from pyspark.sql import functions as F

from seepline.operators import ros
from suite import sql
from suite.base import query

KEYS = ["locationid", "characteristic"]
K = "locationid, characteristic"


def _on(a: str, b: str) -> str:
    return f"{a}.locationid={b}.locationid AND {a}.characteristic={b}.characteristic"


# The checks count by comparing each threshold with all values of its group.
_STATS = f"""st AS (SELECT {K}, count(*) AS n, count(*) FILTER (WHERE censorship) AS nc, max(result) FILTER (WHERE NOT censorship) AS mu, min(result) AS mn, min(result) FILTER (WHERE censorship) AS mc FROM wq_censored GROUP BY ALL)"""
_LIMITS = f"""lim AS (SELECT DISTINCT {K}, result AS lo FROM wq_censored WHERE censorship UNION SELECT {K}, mn FROM st WHERE mn < mc),
 lims AS (SELECT *, row_number() OVER (PARTITION BY {K} ORDER BY lo) - 1 AS j, coalesce(lead(lo) OVER (PARTITION BY {K} ORDER BY lo), 'Infinity'::DOUBLE) AS hi FROM lim)"""
_COHN = f"""cnt AS (SELECT l.locationid, l.characteristic, l.j, l.lo, l.hi, count(*) FILTER (WHERE NOT x.censorship AND x.result >= l.lo AND x.result < l.hi) AS a,
 count(*) FILTER (WHERE (x.censorship AND x.result <= l.lo) OR (NOT x.censorship AND x.result < l.lo)) AS b,
 count(*) FILTER (WHERE x.censorship AND x.result = l.lo) AS ce FROM lims l JOIN wq_censored x ON {_on('l', 'x')} GROUP BY ALL),
 cohn AS (SELECT *, 1 - product(b/(a+b)) OVER (PARTITION BY {K} ORDER BY j DESC) AS pe FROM cnt),
 cohn2 AS (SELECT *, coalesce(lead(pe) OVER (PARTITION BY {K} ORDER BY j), 0) AS pe2 FROM cohn)"""
_SORTED = f"""kept AS (SELECT x.*, row_number() OVER (PARTITION BY x.locationid, x.characteristic ORDER BY x.censorship DESC, x.result) AS position FROM wq_censored x JOIN st ON {_on('x', 'st')} WHERE NOT x.censorship OR x.result <= st.mu)"""
_POS = f"""rk AS (SELECT k.*, c.j, c.pe, c.pe2, c.a, c.ce, row_number() OVER (PARTITION BY k.locationid, k.characteristic, c.j, k.censorship ORDER BY k.position) AS rnk
 FROM kept k JOIN cohn2 c ON {_on('k', 'c')} AND k.result >= c.lo AND k.result < c.hi),
 pp AS (SELECT *, CASE WHEN censorship THEN (1-pe)*rnk/(ce+1) ELSE (1-pe)+(pe-pe2)*rnk/(a+1) END AS pos FROM rk)"""
_ND = f"""nd AS (SELECT {K}, pos, row_number() OVER (PARTITION BY {K} ORDER BY pos) AS place FROM pp WHERE censorship),
 fin AS (SELECT p.locationid, p.characteristic, p.censorship, p.result, p.pos FROM pp p WHERE NOT p.censorship
  UNION ALL SELECT p.locationid, p.characteristic, p.censorship, p.result, nd.pos FROM pp p JOIN nd ON {_on('p', 'nd')} AND nd.place = p.position WHERE p.censorship)"""
_EST = f"""ok AS (SELECT * FROM st WHERE nc > 0 AND n - nc >= 2 AND nc/n <= 0.8),
 z AS (SELECT f.*, {sql.quantile('f.pos')} AS zz FROM fin f JOIN ok ON {_on('f', 'ok')}),
 fit AS (SELECT {K}, regr_slope(ln(result), zz) AS s, regr_intercept(ln(result), zz) AS i FROM z WHERE NOT censorship GROUP BY ALL),
 est AS (SELECT z.*, CASE WHEN z.censorship THEN exp(fit.s*z.zz + fit.i) END AS e FROM z JOIN fit ON {_on('z', 'fit')})"""
_ALL = f"WITH {_STATS}, {_LIMITS}, {_COHN}, {_SORTED}, {_POS}, {_ND}, {_EST}"


def _round(df, *names):
    return df.withColumns({n: F.round(n, 6) for n in names})


query("ros_valid", f"""WITH {_STATS} SELECT {K}, n - nc >= 2 AS enough_uncensored, nc/n <= 0.8 AS not_too_many_censored, (n - nc >= 2 AND nc/n <= 0.8) AS valid FROM st""")(
    lambda t: ros.ros_valid(t.censored, KEYS)
)
query("ros_sort", f"WITH {_STATS}, {_SORTED} SELECT {K}, result, censorship, position FROM kept")(lambda t: ros.ros_sort(t.censored, KEYS))
query("cohn_numbers", f"""WITH {_STATS}, {_LIMITS}, {_COHN} SELECT {K}, j AS det_limit_index, lo AS lower_dl, nullif(hi, 'Infinity'::DOUBLE) AS upper_dl, a AS nuncen_above, b AS nobs_below, ce AS ncen_equal, round(pe, 6) AS prob_exceedance FROM cohn
 UNION ALL SELECT {K}, max(j)+1, NULL, NULL, NULL, NULL, NULL, 0 FROM cohn GROUP BY {K}""")(
    lambda t: _round(ros.cohn_numbers(t.censored, KEYS), "prob_exceedance").withColumn("upper_dl", F.nullif("upper_dl", F.lit(float("inf"))))
)
query("det_limit_index", f"""WITH {_STATS}, {_LIMITS} SELECT x.locationid, x.characteristic, x.result, x.censorship, coalesce(max(l.j), 0) AS det_limit_index
 FROM (SELECT *, row_number() OVER () AS id FROM wq_censored) x LEFT JOIN lims l ON {_on('x', 'l')} AND l.lo <= x.result GROUP BY x.id, x.locationid, x.characteristic, x.result, x.censorship""")(
    lambda t: ros.det_limit_index(t.censored, KEYS)
)
query("ros_rank", f"WITH {_STATS}, {_LIMITS}, {_COHN}, {_SORTED}, {_POS} SELECT {K}, result, censorship, j AS det_limit_index, rnk AS rank FROM pp")(lambda t: ros.ros_rank(t.censored, KEYS))
query("ros_plot_pos", f"WITH {_STATS}, {_LIMITS}, {_COHN}, {_SORTED}, {_POS} SELECT {K}, result, censorship, j AS det_limit_index, rnk AS rank, round(pos, 6) AS plot_pos FROM pp")(
    lambda t: _round(ros.ros_plot_pos(t.censored, KEYS), "plot_pos")
)
query("ros_sort_nd", f"WITH {_STATS}, {_LIMITS}, {_COHN}, {_SORTED}, {_POS}, {_ND} SELECT {K}, result, censorship, round(pos, 6) AS plot_pos FROM fin")(
    lambda t: _round(ros.ros_sort_nd(t.censored, KEYS), "plot_pos")
)
query("norm_plot_pos", f"""SELECT {K}, result, round(CASE WHEN i=n THEN pow(0.5, 1.0/n) WHEN i=1 THEN 1-pow(0.5, 1.0/n) ELSE (i-0.3175)/(n+0.365) END, 6) AS plot_pos
 FROM (SELECT *, row_number() OVER (PARTITION BY {K} ORDER BY result) AS i, count(*) OVER (PARTITION BY {K}) AS n FROM wq_censored)""")(
    lambda t: _round(ros.norm_plot_pos(t.censored, KEYS), "plot_pos")
)
query("ros_estimate", f"{_ALL} SELECT {K}, result, censorship, round(pos, 6) AS plot_pos, round(zz, 6) AS zprelim, round(e, 6) AS estimated, round(CASE WHEN censorship THEN e ELSE result END, 6) AS final FROM est")(
    lambda t: _round(ros.ros_estimate(t.censored, KEYS), "plot_pos", "zprelim", "estimated", "final")
)
_IMPUTE = f"""{_ALL} SELECT {K}, result, censorship, round({{lift}}, 6) AS final FROM est
 UNION ALL SELECT x.locationid, x.characteristic, x.result, x.censorship, CASE WHEN x.censorship THEN x.result*0.5 ELSE x.result END FROM wq_censored x WHERE NOT EXISTS (SELECT 1 FROM ok WHERE {_on('x', 'ok')})"""
query("ros_impute", _IMPUTE.format(lift="CASE WHEN censorship THEN e ELSE result END"))(
    lambda t: _round(ros.ros_impute(t.censored, "result", "censorship", KEYS), "final")
)
query("ros_impute_floor", _IMPUTE.format(lift="greatest(CASE WHEN censorship THEN e ELSE result END, 8)"))(
    lambda t: _round(ros.ros_impute(t.censored, "result", "censorship", KEYS, floor=8.0), "final")
)
