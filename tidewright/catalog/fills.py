"""Polynomial and spline fills of several columns at once."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewright.catalog.base import HOUR, SG, query, sample_grid
from tidewright.operators.grid import interpolate_local
from tidewright.operators.spline import NOT_A_KNOT, interpolate_spline

#: Five columns with holes of their own. Square roots, so that no exact rounding ties blur the comparison.
COLUMNS = {
    "speed": "sqrt(value)",
    "heading": "sqrt(degrees)",
    "even_hours": "CASE WHEN hour(ts_hour) % 2 = 0 THEN sqrt(value + 1) END",
    "third_hours": "CASE WHEN hour(ts_hour) % 3 = 0 THEN sqrt(degrees + 1) END",
    "odd_days": "CASE WHEN day(ts_hour) % 2 = 1 THEN sqrt(value + degrees) END",
}


def _columns(spark, sf):
    return sample_grid(spark, sf, ("value", "degrees")).select(
        "source", "ts_hour", *[F.expr(e).alias(c) for c, e in COLUMNS.items()])


_LONG = f"""{SG}, l AS (
  SELECT source, ts_hour, epoch(ts_hour) / 3600.0 AS t, unnest({list(COLUMNS)}) AS col, unnest([{', '.join(COLUMNS.values())}]) AS v FROM g)"""
_WIDE = "SELECT source, ts_hour, " + ", ".join(f"max(CASE WHEN col = '{c}' THEN round(filled, 6) END) AS {c}" for c in COLUMNS)
_P = "(PARTITION BY source, col ORDER BY ts_hour ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
_N = "(PARTITION BY source, col ORDER BY ts_hour ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"


def _spline_sql(first: str, last: str, least: int, outer: str) -> str:
    """Thomas elimination along each series, point by point, and back substitution."""
    return f"""WITH RECURSIVE {_LONG},
k AS (SELECT source, col, ts_hour, t AS x, v AS y, row_number() OVER w AS i, count(*) OVER (PARTITION BY source, col) AS n,
        t - lag(t) OVER w AS h0, lead(t) OVER w - t AS h1, (v - lag(v) OVER w) / (t - lag(t) OVER w) AS s0, (lead(v) OVER w - v) / (lead(t) OVER w - t) AS s1
      FROM l WHERE v IS NOT NULL WINDOW w AS (PARTITION BY source, col ORDER BY ts_hour)),
e AS (SELECT *, CASE WHEN i = 2 THEN {first} WHEN i = n - 1 THEN {last} ELSE {{'a': h0, 'b': 2 * (h0 + h1), 'c': h1}} END AS q, 6 * (s1 - s0) AS r FROM k),
f(source, col, i, cp, dp) AS (
  SELECT source, col, i, CAST(0 AS DOUBLE), CAST(0 AS DOUBLE) FROM e WHERE i = 1 AND n >= {least}
  UNION ALL
  SELECT e.source, e.col, e.i, e.q.c / (e.q.b - e.q.a * f.cp), (e.r - e.q.a * f.dp) / (e.q.b - e.q.a * f.cp)
  FROM f JOIN e ON e.source = f.source AND e.col = f.col AND e.i = f.i + 1 WHERE e.i < e.n),
b(source, col, i, m) AS (
  SELECT source, col, i, CAST(0 AS DOUBLE) FROM e WHERE i = n AND n >= {least}
  UNION ALL
  SELECT f.source, f.col, f.i, f.dp - f.cp * b.m FROM b JOIN f ON f.source = b.source AND f.col = b.col AND f.i = b.i - 1 WHERE f.i > 1),
c AS (SELECT e.*, b.m FROM e LEFT JOIN b USING (source, col, i)),
m AS (SELECT source, col, ts_hour, x, y, h1, n, {outer} AS m FROM c WINDOW w AS (PARTITION BY source, col ORDER BY ts_hour)),
s AS (SELECT source, col, ts_hour, struct_pack(x := x, y := y, m := m, w := h1, z := lead(y) OVER w, o := lead(m) OVER w, n := n) AS seg
      FROM m WINDOW w AS (PARTITION BY source, col ORDER BY ts_hour)),
j AS (SELECT l.source, l.col, l.ts_hour, l.t, l.v, last_value(seg IGNORE NULLS) OVER {_P} AS p, first_value(seg IGNORE NULLS) OVER {_N} AS q
      FROM l LEFT JOIN s USING (source, col, ts_hour)),
u AS (SELECT *, (p.x + p.w - t) / p.w AS a, (t - p.x) / p.w AS b FROM j),
o AS (SELECT source, col, ts_hour, CASE WHEN v IS NOT NULL THEN v WHEN coalesce(p.n, q.n) < {least} THEN coalesce(p.y, q.y)
        WHEN p IS NOT NULL AND p.w IS NOT NULL THEN a * p.y + b * p.z + ((a * a * a - a) * p.m + (b * b * b - b) * p.o) * p.w * p.w / 6
        ELSE coalesce(p.y, q.y) END AS filled FROM u)
{_WIDE} FROM o GROUP BY ALL"""


_ROW = "{'a': h0, 'b': 2 * (h0 + h1), 'c': h1}"
_NATURAL_SQL = _spline_sql(_ROW, _ROW, 3, "coalesce(m, 0)")
# The curvature of the ends lies on the line through the next two points.
_NOT_A_KNOT_SQL = _spline_sql(
    "{'a': 0.0, 'b': 2 * (h0 + h1) + h0 + h0 * h0 / h1, 'c': h1 - h0 * h0 / h1}",
    "{'a': h0 - h1 * h1 / h0, 'b': 2 * (h0 + h1) + h1 + h1 * h1 / h0, 'c': 0.0}", 4,
    """CASE WHEN i = 1 THEN (1 + h1 / lead(h1) OVER w) * lead(m) OVER w - h1 / lead(h1) OVER w * lead(m, 2) OVER w
              WHEN i = n THEN (1 + h0 / lag(h0) OVER w) * lag(m) OVER w - h0 / lag(h0) OVER w * lag(m, 2) OVER w ELSE m END""")


@query("interp_spline_natural", _NATURAL_SQL)
def interp_spline_natural(spark, sf):
    return interpolate_spline(_columns(spark, sf), ["source"], "ts_hour", list(COLUMNS), HOUR, digits=6, rows_per_bucket=300)


@query("interp_spline_not_a_knot", _NOT_A_KNOT_SQL)
def interp_spline_not_a_knot(spark, sf):
    return interpolate_spline(_columns(spark, sf), ["source"], "ts_hour", list(COLUMNS), HOUR, NOT_A_KNOT, digits=6, rows_per_bucket=300)


@query("interp_cubic_columns", f"""WITH {_LONG},
kn AS (SELECT source, col, ts_hour, v, t AS x FROM l WHERE v IS NOT NULL),
ln AS (SELECT source, col, ts_hour, struct_pack(v := v, x := x, lv := lag(v) OVER w, lx := lag(x) OVER w, fv := lead(v) OVER w, fx := lead(x) OVER w) AS s
       FROM kn WINDOW w AS (PARTITION BY source, col ORDER BY ts_hour)),
j AS (SELECT l.*, last_value(s IGNORE NULLS) OVER {_P} AS p, first_value(s IGNORE NULLS) OVER {_N} AS n FROM l LEFT JOIN ln USING (source, col, ts_hour)),
q AS (SELECT source, col, ts_hour, t, v, p.v AS b, p.x AS xb, p.lv AS a, p.lx AS xa, n.v AS c, n.x AS xc, n.fv AS d, n.fx AS xd FROM j),
o AS (SELECT source, col, ts_hour, CASE WHEN v IS NOT NULL THEN v WHEN b IS NULL THEN c WHEN c IS NULL THEN b
        WHEN a IS NOT NULL AND d IS NOT NULL THEN
          a*(t-xb)*(t-xc)*(t-xd)/((xa-xb)*(xa-xc)*(xa-xd)) + b*(t-xa)*(t-xc)*(t-xd)/((xb-xa)*(xb-xc)*(xb-xd))
          + c*(t-xa)*(t-xb)*(t-xd)/((xc-xa)*(xc-xb)*(xc-xd)) + d*(t-xa)*(t-xb)*(t-xc)/((xd-xa)*(xd-xb)*(xd-xc))
        ELSE b * (t - xc) / (xb - xc) + c * (t - xb) / (xc - xb) END AS filled FROM q)
{_WIDE} FROM o GROUP BY ALL""")
def interp_cubic_columns(spark, sf):
    return interpolate_local(_columns(spark, sf), ["source"], "ts_hour", list(COLUMNS), HOUR, order=3, digits=6)
