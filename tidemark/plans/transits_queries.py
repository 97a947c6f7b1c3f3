"""Transit analytics on daily order counts per priority."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import supply_chain as sc
from tidemark.plans.bindings import SUBSTITUTES, TRANSITS, table, transits
from tidemark.plans.registry import query

# The synthetic traffic ends at different dates per column in no corridor, so the newest
# date of the panel is the newest of each.


@query("transit_panel", f"WITH {TRANSITS} SELECT * FROM tr WHERE date <= DATE '2000-01-01'")
def transit_panel(spark, sf):
    return sc.transit_panel(transits(spark, sf), "2000-01-01", vintages=False)


DEVIATION = f"""{TRANSITS}, u AS (UNPIVOT tr ON n_total, n_tanker, n_cargo, capacity INTO NAME metric VALUE v),
  mx AS (SELECT max(date) AS as_of FROM tr), b AS (SELECT portname, metric, as_of, count(*) FILTER (date <= as_of - 14) AS no, count(*) FILTER (date > as_of - 14) AS nn,
    avg(v) FILTER (date <= as_of - 14) AS bm, stddev_samp(v) FILTER (date <= as_of - 14) AS bs, avg(v) FILTER (date > as_of - 14) AS rm
    FROM u, mx WHERE date > as_of - 104 GROUP BY portname, metric, as_of),
  dev AS (SELECT as_of, portname, metric, round_even(rm, 2) AS recent_mean, round_even(bm, 2) AS baseline_mean, round_even(bs, 2) AS baseline_std,
    round_even(CASE WHEN bs > 0 THEN (rm - bm) / bs END, 2) AS zscore, round_even((rm - bm) / nullif(bm, 0) * 100, 1) AS pct_change, 14 AS recent_days, 90 AS baseline_days FROM b WHERE no >= 30 AND nn > 0)"""


@query("transit_deviation", f"WITH {DEVIATION} SELECT * FROM dev")
def transit_deviation(spark, sf):
    return sc.deviation(transits(spark, sf))


_ROUTES = ", ".join("('%s', %s)" % (k, "NULL" if v is None else f"'{v}'") for k, v in SUBSTITUTES.items())
REROUTE = f"""{DEVIATION}, routes(corridor, substitute) AS (VALUES {_ROUTES}), t AS (SELECT as_of, portname, recent_mean - baseline_mean AS c FROM dev WHERE metric = 'n_total'),
  j AS (SELECT t.as_of, corridor, substitute, t.c, s.c AS s, CASE WHEN t.c < 0 THEN round_even(-100 * s.c / t.c, 1) END AS absorbed_pct
    FROM routes JOIN t ON t.portname = corridor LEFT JOIN t s ON s.portname = substitute),
  rr AS (SELECT as_of, corridor, substitute, round_even(c, 2) AS corridor_change_per_day, round_even(s, 2) AS substitute_change_per_day, absorbed_pct,
    CASE WHEN substitute IS NULL THEN 'no_substitute_route' WHEN c >= 0 THEN 'corridor_not_falling' WHEN absorbed_pct >= 60 THEN 'rerouted'
    WHEN absorbed_pct >= 25 THEN 'partially_rerouted' ELSE 'traffic_destroyed' END AS interpretation FROM j)"""


@query("reroute_balance", f"WITH {REROUTE} SELECT * FROM rr")
def reroute_balance(spark, sf):
    return sc.reroute_balance(sc.deviation(transits(spark, sf)), SUBSTITUTES)


def shifted(spark, sf):
    """Traffic with a level shift: one corridor falls to a quarter and another to nothing in 1998. Every order counts; its weight shifts."""
    late = F.to_date("o_orderdate") >= "1998-05-01"
    weight = F.when(late & (F.col("o_orderpriority") == "3-MEDIUM"), 0.0).when(late & (F.col("o_orderpriority") == "2-HIGH"), 0.25).otherwise(1.0)
    return table(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("date"), F.col("o_orderpriority").alias("portname")).agg(F.sum(weight).alias("n_total"))


SHIFTED = """sh AS (SELECT CAST(o_orderdate AS DATE) AS date, o_orderpriority AS portname, sum(CASE WHEN o_orderdate >= DATE '1998-05-01' AND o_orderpriority = '3-MEDIUM' THEN 0
  WHEN o_orderdate >= DATE '1998-05-01' AND o_orderpriority = '2-HIGH' THEN 0.25 ELSE 1 END)::DOUBLE AS n_total FROM orders GROUP BY 1, 2)"""


def breaks_sql(source: str, width: int = 5) -> str:
    """Tables up to ``breaks`` (portname, break_date, metric, ...): the fit by elimination, the search by a recursive query. ``source`` has (portname, date, n_total)."""
    each = range(width)
    kept = "portname, n_ok, mean, span"
    terms = ["1.0::DOUBLE", *[f"sin({k} * 2 * pi() * dayofyear(date) / 365.25)" for k in (1, 2)], *[f"cos({k} * 2 * pi() * dayofyear(date) / 365.25)" for k in (1, 2)]]
    parts = [f"x AS (SELECT portname, date, n_total AS v, {', '.join(f'{t} AS x{i}' for i, t in enumerate(terms))} FROM {source})",
             f"g0 AS (SELECT portname, count(v) AS n_ok, avg(v) AS mean, date_diff('day', min(date), max(date)) AS span, "
             f"{', '.join(f'sum(x{i} * x{j}) AS a{i}_{j}' for i in each for j in range(i, width))}, {', '.join(f'sum(x{i} * v) AS b{i}' for i in each)} FROM x GROUP BY 1)"]
    for k in each:
        def lessen(target: str, i: int, other: str, k: int = k) -> str:
            return f"{target} - a{k}_{i} / a{k}_{k} * {other} AS {target}" if i > k else target
        parts.append(f"g{k + 1} AS (SELECT {kept}, {', '.join(lessen(f'a{i}_{j}', i, f'a{k}_{j}') for i in each for j in range(i, width))}, "
                     f"{', '.join(lessen(f'b{i}', i, f'b{k}') for i in each)} FROM g{k})")
    for k in reversed(each):
        rest = "".join(f" - a{k}_{j} * c{j}" for j in range(k + 1, width))
        parts.append(f"h{k} AS (SELECT *, (b{k}{rest}) / a{k}_{k} AS c{k} FROM {f'g{width}' if k == width - 1 else f'h{k + 1}'})")
    parts += [
        f"rs AS (SELECT x.portname, date, v, coalesce(v - CASE WHEN span / 365.25 >= 2 AND n_ok > {width} THEN {' + '.join(f'c{i} * x{i}' for i in each)} ELSE mean END, 0) AS r, "
        "row_number() OVER (PARTITION BY x.portname ORDER BY date) - 1 AS pos FROM x JOIN h0 ON h0.portname = x.portname)",
        "px AS MATERIALIZED (SELECT portname, pos, sum(r) OVER w - r AS s, sum(r * r) OVER w - r * r AS q FROM rs WINDOW w AS (PARTITION BY portname ORDER BY pos))",
        "en AS (SELECT portname, count(*) AS n, sum(r) AS s, sum(r * r) AS q FROM rs GROUP BY 1)",
        "seg AS (SELECT portname, 0::BIGINT AS lo, 0.0::DOUBLE AS ls, 0.0::DOUBLE AS lq, n AS hi, s AS hs, q AS hq FROM en UNION ALL SELECT portname, unnest([lo, b.pos]), unnest([ls, b.s]), unnest([lq, b.q]), "
        "unnest([b.pos, hi]), unnest([b.s, hs]), unnest([b.q, hq]) FROM (SELECT portname, lo, ls, lq, hi, hs, hq, arg_max({'pos': pos, 's': s, 'q': q}, (t, -pos)) AS b, max(t) AS t FROM ("
        f"SELECT seg.*, p.pos, p.s, p.q, {WELCH} AS t FROM seg JOIN px p ON p.portname = seg.portname AND p.pos >= lo + 45 AND p.pos <= hi - 45) GROUP BY ALL) WHERE t >= 8)",
        "sp AS (SELECT DISTINCT seg.portname, lo AS spot, ls AS s, lq AS q FROM seg WHERE lo > 0)",
        "nb AS (SELECT sp.portname, spot AS pos, s, q, coalesce(lag(spot) OVER w, 0) AS lo, coalesce(lag(s) OVER w, 0) AS ls, coalesce(lag(q) OVER w, 0) AS lq, "
        "coalesce(lead(spot) OVER w, n) AS hi, coalesce(lead(s) OVER w, es) AS hs, coalesce(lead(q) OVER w, eq) AS hq FROM sp JOIN (SELECT portname, n, s AS es, q AS eq FROM en) z "
        "ON z.portname = sp.portname WINDOW w AS (PARTITION BY sp.portname ORDER BY spot))",
        f"ts AS (SELECT portname, pos AS spot, lo, hi, {WELCH} AS t FROM nb p)",
        "mb AS (SELECT ts.portname, spot, t, avg(v) FILTER (pos < spot) AS m1, avg(v) FILTER (pos >= spot) AS m2, count(*) FILTER (pos < spot) AS d1, count(*) FILTER (pos >= spot) AS d2, "
        "min(date) FILTER (pos >= spot) AS break_date FROM ts JOIN rs ON rs.portname = ts.portname AND pos >= lo AND pos < hi GROUP BY 1, 2, 3)",
        "breaks AS (SELECT portname, break_date, 'n_total' AS metric, round_even(m1, 2) AS mean_before, round_even(m2, 2) AS mean_after, round_even(m2 - m1, 2) AS change_per_day, "
        "round_even(CASE WHEN m1 <> 0 THEN (m2 - m1) / m1 * 100 END, 1) AS pct_change, round_even(t, 1) AS t_stat, CAST(d1 AS INTEGER) AS days_before, CAST(d2 AS INTEGER) AS days_after FROM mb)"]
    return ", ".join(parts)


_SIDE = "(({s}) / ({n}))"
_VAR = "greatest((({q}) - ({s}) * ({s}) / ({n})) / (({n}) - 1), 1e-12) / ({n})"
_LEFT = {"n": "p.pos - lo", "s": "p.s - ls", "q": "p.q - lq"}
_RIGHT = {"n": "hi - p.pos", "s": "hs - p.s", "q": "hq - p.q"}
WELCH = f"abs({_SIDE.format(**_LEFT)} - {_SIDE.format(**_RIGHT)}) / sqrt({_VAR.format(**_LEFT)} + {_VAR.format(**_RIGHT)})"
BREAKS = f"{SHIFTED}, {breaks_sql('sh')}"


@query("regime_breaks", f"WITH RECURSIVE {BREAKS} SELECT * FROM breaks")
def regime_breaks(spark, sf):
    return sc.regime_breaks(shifted(spark, sf))


def recent(spark, sf):
    """The last twenty months of the shifted traffic, which is too short to fit a season."""
    return shifted(spark, sf).where("date >= '1997-10-01' AND date < '1999-06-01'")


@query("regime_breaks_short_series", f"WITH RECURSIVE {SHIFTED}, st AS (SELECT * FROM sh WHERE date >= DATE '1997-10-01' AND date < DATE '1999-06-01'), {breaks_sql('st')} SELECT * FROM breaks")
def regime_breaks_short_series(spark, sf):
    return sc.regime_breaks(recent(spark, sf))


def dated(spark):
    """Stored breaks, as an earlier run would have written them."""
    return spark.createDataFrame([("2-HIGH", "1998-05-01", 1.26), ("2-HIGH", "1999-12-01", 1.1), ("5-LOW", "1997-01-01", 1.3)],
                                 "portname string, break_date string, mean_before double").withColumn("break_date", F.to_date("break_date"))


REGIME = f"""{SHIFTED}, br(portname, break_date, mean_before) AS (VALUES ('2-HIGH', DATE '1998-05-01', 1.26::DOUBLE), ('2-HIGH', DATE '1999-12-01', 1.1::DOUBLE), ('5-LOW', DATE '1997-01-01', 1.3::DOUBLE)),
  bk AS (SELECT portname, max(break_date) AS l, min(break_date) AS f, arg_max(mean_before, break_date) AS prev FROM br GROUP BY 1),
  ek AS (SELECT sh.portname, max(date) AS latest, coalesce(any_value(l), min(date)) AS rs, any_value(f) AS f, any_value(prev) AS prev FROM sh LEFT JOIN bk USING (portname) GROUP BY 1),
  gk AS (SELECT portname, latest, rs, prev, count(*) FILTER (date >= rs) AS n, avg(n_total) FILTER (date >= rs) AS rm, stddev_samp(n_total) FILTER (date >= rs) AS sd,
    avg(n_total) FILTER (date > latest - 14) AS cm, avg(n_total) FILTER (f IS NULL OR date < f) AS bm FROM sh JOIN ek USING (portname) GROUP BY 1, 2, 3, 4),
  reg AS (SELECT latest AS as_of, portname, 'n_total' AS metric, rs AS regime_start, n AS days_in_regime, round_even(rm, 2) AS regime_mean, round_even(cm, 2) AS recent_mean,
    round_even((cm - rm) / nullif(sd, 0), 2) AS z_vs_regime, round_even(prev, 2) AS previous_regime_mean, round_even((rm - prev) / nullif(prev, 0) * 100, 1) AS regime_vs_previous_pct,
    round_even(bm, 2) AS baseline_mean, round_even((rm - bm) / nullif(bm, 0) * 100, 1) AS vs_baseline_pct FROM gk)"""


@query("current_regime_from_stored_breaks", f"WITH {REGIME} SELECT * FROM reg")
def current_regime_from_stored_breaks(spark, sf):
    return sc.current_regime(shifted(spark, sf), dated(spark))


@query("current_regime", f"""WITH RECURSIVE {BREAKS}, {REGIME.removeprefix(SHIFTED + ", ").replace("br(portname, break_date, mean_before) AS (VALUES ('2-HIGH', DATE '1998-05-01', 1.26::DOUBLE), ('2-HIGH', DATE '1999-12-01', 1.1::DOUBLE), ('5-LOW', DATE '1997-01-01', 1.3::DOUBLE))",
    "br AS (SELECT portname, break_date, mean_before FROM breaks)")} SELECT * FROM reg""")
def current_regime(spark, sf):
    p = shifted(spark, sf)
    return sc.current_regime(p, sc.regime_breaks(p))
