"""DuckDB SQL for the registered queries, written another way than the operators.

Recursions are recursive CTEs, segment costs come from two-dimensional prefix sums of the
kernel, cohorts are counted case by case and week by week, the latest milestone comes from
``row_number`` and three joins, and trimming slices sorted lists. Every query reads the
whole tables.
"""

from __future__ import annotations

from casepulse.plans.order_queries import (
    ALERTS,
    AS_OF,
    BREAKS,
    CURRENT_YEAR,
    EXCLUDE,
    HISTORY,
    PAST_YEAR,
    RUN_AT,
    SNAPSHOT,
    SNAPSHOTS,
    START_YEAR,
    TARGETS,
)

_AS_OF = f"DATE '{AS_OF}'"
_DAY = f"DATE '{SNAPSHOT}'"
_KEPT = f"indicator NOT LIKE '{EXCLUDE}'"


def r4(x: str) -> str:
    """Half away from zero to four decimals, never -0.0."""
    size = f"(floor(abs({x}) * 1e4 + 0.5e0) / 1e4)"
    return f"(CASE WHEN {x} < 0 AND {size} > 0 THEN -{size} ELSE {size} END)"


def display(x: str, digits: int) -> str:
    """Half up on the decimal digits of a double, as the reports round."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38, 20)), {digits}) AS DOUBLE)"


#: Subqueries a recursion or several others read, kept instead of computed anew each time.
_KEPT_ONCE = {"costs", "cuts", "shifts"}


def chain(*parts: tuple[str, str], select: str) -> str:
    """One statement from named subqueries."""
    named = ",\n".join(
        f"{name} AS {'MATERIALIZED ' if name in _KEPT_ONCE else ''}(\n{body}\n)" for name, body in parts
    )
    return f"WITH RECURSIVE {named}\n{select}"


# --------------------------------------------------------------------------- inputs

def _cases_sql(shipped: str, placed: str) -> tuple[str, str]:
    return (
        "cases",
        f"""
  SELECT case_id, indicator, start_date, stop_date, stop_date AS end_date, deadline,
         CASE WHEN stop_date <= deadline THEN 1 WHEN stop_date > deadline THEN 0 END AS on_time,
         CAST(date_diff('day', start_date, stop_date) AS DOUBLE) AS duration
  FROM (
    SELECT o.o_orderkey AS case_id, o.o_orderpriority AS indicator,
           CAST(o.o_orderdate AS DATE) AS start_date,
           MIN(CASE WHEN CAST(l.l_shipdate AS DATE) >= CAST(o.o_orderdate AS DATE) AND {shipped}
                    THEN CAST(l.l_shipdate AS DATE) END) AS stop_date,
           CAST(o.o_orderdate AS DATE) + CASE o.o_orderpriority
             WHEN '1-URGENT' THEN 21 WHEN '2-HIGH' THEN 84
             WHEN '3-MEDIUM' THEN 126 WHEN '4-NOT SPECIFIED' THEN 365 END AS deadline
    FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey
    WHERE {placed}
    GROUP BY ALL
  )""",
    )


CASES = _cases_sql("TRUE", "TRUE")
#: As the projection sees them on its day.
CASES_AS_OF = _cases_sql(f"CAST(l.l_shipdate AS DATE) <= {_AS_OF}", f"CAST(o.o_orderdate AS DATE) <= {_AS_OF}")
MILESTONES = (
    "milestones",
    """
  SELECT l_orderkey AS case_id, l_returnflag || l_linestatus AS milestone,
         CAST(l_shipdate AS DATE) AS milestone_ts
  FROM lineitem""",
)


# --------------------------------------------------------------------------- series


def series_sql(metric: str, granularity: str, excluded: bool) -> str:
    day = "COALESCE(stop_date, start_date)" if metric == "prod_diff" else "stop_date"
    part = "month" if granularity == "monthly" else "week"
    value, test = {
        "frist_pct": (
            "CAST(COUNT(*) FILTER (WHERE on_time = 1) AS DOUBLE) / COUNT(deadline)",
            "stop_date IS NOT NULL AND deadline IS NOT NULL",
        ),
        "tidsbruk": ("AVG(duration)", "stop_date IS NOT NULL AND duration IS NOT NULL"),
        "prod_diff": ("CAST(COUNT(start_date) - COUNT(stop_date) AS DOUBLE)", "TRUE"),
    }[metric]
    also = f" AND {_KEPT}" if excluded else ""
    return f"""
  SELECT indicator, '{metric}' AS metric, '{granularity}' AS granularity,
         CAST(year({day}) * 100 + {part}({day}) AS INTEGER) AS period, {value} AS value
  FROM cases WHERE {test} AND year({day}) >= {START_YEAR}{also}
  GROUP BY indicator, year({day}), {part}({day})"""


_DRIFT = [
    ("frist_pct", "monthly", False),
    ("tidsbruk", "monthly", False),
    ("prod_diff", "monthly", True),
    ("frist_pct", "weekly", True),
    ("prod_diff", "weekly", True),
]
_TREND = [(metric, "monthly", True) for metric in ("frist_pct", "tidsbruk", "prod_diff")]


def _series(specs) -> tuple[str, str]:
    return "series", "\n  UNION ALL".join(series_sql(*spec) for spec in specs)


ORACLE: dict[str, str] = {
    "case_facts": chain(
        CASES,
        select=f"""
SELECT case_id, indicator, strftime(start_date, '%Y%m') AS cohort_label,
       CAST(year(start_date) * 100 + month(start_date) AS INTEGER) AS cohort_period,
       start_date AS intake_date, end_date,
       CAST(date_diff('day', start_date, end_date) AS DOUBLE) AS days_to_resolution,
       CASE WHEN stop_date IS NULL THEN 1 ELSE 0 END AS is_open
FROM cases WHERE year(start_date) >= {START_YEAR}""",
    ),
    "case_profile": chain(
        CASES,
        select="""
SELECT COUNT(*) AS n_rows, COUNT(DISTINCT indicator) AS n_indicator,
       MIN(start_date) AS min_start_date, MAX(start_date) AS max_start_date
FROM cases""",
    ),
    "series_all": chain(CASES, _series(_DRIFT), select="SELECT * FROM series"),
    "series_profile": chain(
        CASES,
        _series(_DRIFT),
        select="""
SELECT metric, granularity, COUNT(*) AS n_rows, COUNT(DISTINCT indicator) AS n_indicator,
       COUNT(DISTINCT period) AS n_period, MIN(period) AS min_period, MAX(period) AS max_period
FROM series GROUP BY metric, granularity""",
    ),
}
for _spec in _DRIFT:
    ORACLE[f"series_{_spec[0]}_{_spec[1]}"] = chain(CASES, _series([_spec]), select="SELECT * FROM series")


# --------------------------------------------------------------------------- trend

_EWMA = (
    (
        "numbered",
        """
  SELECT *, row_number() OVER (PARTITION BY indicator, metric ORDER BY period) AS i,
         COUNT(*) OVER (PARTITION BY indicator, metric) AS n
  FROM series""",
    ),
    (
        "smooth",
        """
  SELECT indicator, metric, period, value, i, value AS slow, value AS fast,
         CAST(NULL AS DOUBLE) AS slope_slow, CAST(NULL AS DOUBLE) AS slope_fast
  FROM numbered WHERE i = 1 AND n >= 3
  UNION ALL
  SELECT x.indicator, x.metric, x.period, x.value, x.i,
         0.1e0 * x.value + (1e0 - 0.1e0) * p.slow,
         0.3e0 * x.value + (1e0 - 0.3e0) * p.fast,
         (0.1e0 * x.value + (1e0 - 0.1e0) * p.slow) - p.slow,
         (0.3e0 * x.value + (1e0 - 0.3e0) * p.fast) - p.fast
  FROM smooth p JOIN numbered x
    ON x.indicator = p.indicator AND x.metric = p.metric AND x.i = p.i + 1""",
    ),
    (
        "ewma",
        f"""
  SELECT indicator, metric, period, {r4('value')} AS value_raw,
         {r4('slow')} AS ewma_slow, {r4('fast')} AS ewma_fast,
         {r4('slope_slow')} AS ewma_slope_slow, {r4('slope_fast')} AS ewma_slope_fast,
         CASE WHEN slope_slow > lim THEN 'Stigende' WHEN slope_slow < -lim THEN 'Synkende'
              ELSE 'Stabil' END AS trend_direction
  FROM (SELECT *, CASE metric WHEN 'frist_pct' THEN 0.002e0 WHEN 'tidsbruk' THEN 0.5e0
                              ELSE 5e0 END AS lim FROM smooth)""",
    ),
)


def _ewma_sql(specs, select: str) -> str:
    return chain(CASES, _series(specs), *_EWMA, select=select)


ORACLE |= {
    "ewma_frist_pct": _ewma_sql(_TREND[:1], "SELECT * FROM ewma"),
    "ewma_duration_monthly": _ewma_sql(_TREND[1:2], "SELECT * FROM ewma"),
    "ewma_prod_diff": _ewma_sql(_TREND[2:], "SELECT * FROM ewma"),
    "ewma_all": _ewma_sql(_TREND, "SELECT * FROM ewma"),
    "ewma_month_axis": _ewma_sql(
        _TREND,
        """
SELECT indicator, metric, make_date(CAST(period // 100 AS BIGINT), CAST(period % 100 AS BIGINT), 1) AS month, ewma_slow
FROM ewma""",
    ),
    "ewma_measures": _ewma_sql(
        _TREND,
        """
SELECT indicator, period,
       MAX(ewma_slow) FILTER (WHERE metric = 'frist_pct') AS ewma_slow_frist_pct,
       MAX(ewma_fast) FILTER (WHERE metric = 'frist_pct') AS ewma_fast_frist_pct,
       MAX(ewma_slow) FILTER (WHERE metric = 'tidsbruk') AS ewma_tidsbruk,
       MAX(ewma_slow) FILTER (WHERE metric = 'prod_diff') AS ewma_prod_diff
FROM ewma GROUP BY indicator, period""",
    ),
    "trend_crosstab": _ewma_sql(
        _TREND,
        """
SELECT metric, period,
       COUNT(*) FILTER (WHERE trend_direction = 'Stigende') AS "Stigende",
       COUNT(*) FILTER (WHERE trend_direction = 'Synkende') AS "Synkende",
       COUNT(*) FILTER (WHERE trend_direction = 'Stabil') AS "Stabil"
FROM ewma WHERE period = (SELECT MAX(period) FROM ewma) GROUP BY metric, period""",
    ),
    "trend_active": _ewma_sql(
        _TREND,
        f"""
SELECT indicator, metric, {display('value_raw', 3)} AS value, {display('ewma_slow', 3)} AS ewma_slow,
       {display('ewma_fast', 3)} AS ewma_fast, trend_direction
FROM ewma
WHERE period = (SELECT MAX(period) FROM ewma) AND metric = 'frist_pct' AND trend_direction <> 'Stabil'""",
    ),
    "trend_latest": _ewma_sql(
        _TREND,
        """
SELECT indicator, metric, period AS latest_period, trend_direction,
       CASE trend_direction WHEN 'Stigende' THEN 1 WHEN 'Synkende' THEN -1 ELSE 0 END AS trend_code
FROM ewma QUALIFY row_number() OVER (PARTITION BY indicator, metric ORDER BY period DESC) = 1""",
    ),
}


# --------------------------------------------------------------------------- drift

_KEY = "indicator, metric, granularity"
_CUSUM = (
    (
        "scored",
        f"""
  SELECT *, (value - mu) / sigma AS z FROM (
    SELECT *, row_number() OVER (PARTITION BY {_KEY} ORDER BY period) AS i,
           COUNT(*) OVER (PARTITION BY {_KEY}) AS n,
           AVG(value) OVER (PARTITION BY {_KEY}) AS mu,
           stddev_pop(value) OVER (PARTITION BY {_KEY}) AS sigma
    FROM series)
  WHERE sigma > 1e-12 AND n >= CASE granularity WHEN 'monthly' THEN 24 ELSE 52 END""",
    ),
    (
        "walk",
        """
  SELECT indicator, metric, granularity, period, value, i, 0e0 AS up, 0e0 AS down
  FROM scored WHERE i = 1
  UNION ALL
  SELECT x.indicator, x.metric, x.granularity, x.period, x.value, x.i,
         greatest(0e0, p.up + x.z - 0.5e0), greatest(0e0, p.down - x.z - 0.5e0)
  FROM walk p JOIN scored x
    ON x.indicator = p.indicator AND x.metric = p.metric AND x.granularity = p.granularity
   AND x.i = p.i + 1""",
    ),
    (
        "cusum",
        f"""
  SELECT indicator, metric, granularity, period, value, {r4('up')} AS cusum_pos,
         {r4('down')} AS cusum_neg, (up > 5 OR down > 5) AS signal,
         CASE WHEN up > 5 THEN 'OPP' WHEN down > 5 THEN 'NED' END AS signal_direction
  FROM walk""",
    ),
)


def _cusum_sql(select: str) -> str:
    return chain(CASES, _series(_DRIFT), *_CUSUM, select=select)


ORACLE |= {
    "cusum_all": _cusum_sql("SELECT * FROM cusum"),
    "cusum_active": _cusum_sql(
        f"""
SELECT {_KEY}, MAX(period) AS last_signal_period, MAX(signal_direction) AS direction
FROM cusum WHERE signal GROUP BY {_KEY}"""
    ),
    "cusum_signal_count": _cusum_sql(
        "SELECT COUNT(*) AS n_rows, COUNT(*) FILTER (WHERE signal) AS n_signals FROM cusum"
    ),
    "cusum_latest_flag": _cusum_sql(
        f"""
SELECT {_KEY}, period AS latest_period, signal AS has_active_signal
FROM cusum QUALIFY row_number() OVER (PARTITION BY {_KEY} ORDER BY period DESC) = 1"""
    ),
    "cusum_active_count": _cusum_sql(
        """
SELECT c.metric, c.granularity, m.latest_period,
       COUNT(DISTINCT CASE WHEN c.signal THEN c.indicator END) AS active_signals
FROM cusum c JOIN (SELECT metric, granularity, MAX(period) AS latest_period
                   FROM cusum GROUP BY metric, granularity) m
  ON c.metric = m.metric AND c.granularity = m.granularity AND c.period = m.latest_period
GROUP BY ALL"""
    ),
}


# --------------------------------------------------------------------------- changepoints

_SHIFTS = (
    (
        "sides",
        f"""
  SELECT {_KEY}, periods[bp + 1] AS changepoint_period,
         list_avg(x[prev + 1:bp]) AS before, list_avg(x[bp + 1:]) AS after,
         CAST(bp - prev AS INTEGER) AS n_obs_before, CAST(len(x) - bp AS INTEGER) AS n_obs_after
  FROM (SELECT *, lag(bp, 1, 0) OVER (PARTITION BY {_KEY} ORDER BY bp) AS prev FROM cuts)""",
    ),
    (
        "shifts",
        f"""
  SELECT {_KEY}, changepoint_period, {r4('before')} AS mean_before, {r4('after')} AS mean_after,
         {r4('(after - before)')} AS shift_magnitude,
         CASE WHEN after - before > 0 THEN 'OPP' ELSE 'NED' END AS shift_direction,
         n_obs_before, n_obs_after
  FROM sides WHERE n_obs_before >= 3 AND n_obs_after >= 3""",
    ),
)
_VECTORS = (
    "vectors",
    f"""
  SELECT {_KEY}, list(value ORDER BY period) AS x, list(period ORDER BY period) AS periods
  FROM series GROUP BY {_KEY}""",
)
_PENALTIES = {"log_n_var": "ln(len(x)) * list_aggregate(x, 'var_pop')", "log_n": "ln(len(x))"}
_SEARCH = (
    ("points", "SELECT id, unnest(x) AS v, unnest(range(1, n + 1)) AS i FROM long_series"),
    (
        "pairs",
        "SELECT a.id, a.i, b.i AS j, (a.v - b.v) * (a.v - b.v) AS gap FROM points a JOIN points b ON a.id = b.id",
    ),
    (
        "scales",
        """
  SELECT id, CASE WHEN median(gap) > 0 THEN 1 / median(gap) ELSE 1e0 END AS gamma
  FROM pairs WHERE i < j GROUP BY id""",
    ),
    (
        "row_sums",
        """
  SELECT p.id, p.i, p.j, SUM(exp(-s.gamma * p.gap)) OVER (PARTITION BY p.id, p.i ORDER BY p.j) AS k
  FROM pairs p JOIN scales s ON s.id = p.id""",
    ),
    (
        "corners",
        """
  SELECT id, i AS s, j AS t, SUM(k) OVER (PARTITION BY id, j ORDER BY i) AS area FROM row_sums
  UNION ALL SELECT id, 0, i, 0e0 FROM points
  UNION ALL SELECT id, 0, 0, 0e0 FROM long_series""",
    ),
    (
        "costs",
        """
  SELECT c.id, c.t, list(c.s ORDER BY c.s) AS starts,
         list((c.t - c.s) - (e.area - 2 * c.area + b.area) / (c.t - c.s) + l.beta ORDER BY c.s) AS cost
  FROM corners c
  JOIN corners b ON b.id = c.id AND b.s = c.s AND b.t = c.s
  JOIN corners e ON e.id = c.id AND e.s = c.t AND e.t = c.t
  JOIN long_series l ON l.id = c.id
  WHERE c.t - c.s >= 6 AND (c.s = 0 OR c.s >= 6)
  GROUP BY c.id, c.t""",
    ),
    (
        "best",
        """
  SELECT id, CAST(5 AS BIGINT) AS t,
         [0e0, NULL, NULL, NULL, NULL, NULL] AS f, CAST([0, 0, 0, 0, 0, 0] AS BIGINT[]) AS origin
  FROM long_series
  UNION ALL
  SELECT id, t, list_append(f, list_min(total)),
         list_append(origin, CAST(starts[list_position(total, list_min(total))] AS BIGINT))
  FROM (
    SELECT b.id, c.t, b.f, b.origin, c.starts,
           list_transform(c.cost, lambda q, place: b.f[c.starts[place] + 1] + q) AS total
    FROM best b JOIN costs c ON c.id = b.id AND c.t = b.t + 1)""",
    ),
    (
        "trail",
        """
  SELECT b.id, b.origin, b.origin[l.n + 1] AS bp FROM best b JOIN long_series l ON l.id = b.id AND l.n = b.t
  UNION ALL
  SELECT id, origin, origin[bp + 1] FROM trail WHERE bp > 0""",
    ),
    (
        "cuts",
        f"SELECT {_KEY}, x, periods, bp FROM trail JOIN long_series USING (id) WHERE bp > 0",
    ),
)


def _search_sql(select: str, penalty: str = "log_n_var") -> str:
    long_series = f"""
  SELECT *, row_number() OVER () AS id, len(x) AS n, {_PENALTIES[penalty]} AS beta
  FROM vectors WHERE len(x) >= CASE granularity WHEN 'monthly' THEN 24 ELSE 52 END"""
    return chain(CASES, _series(_DRIFT), _VECTORS, ("long_series", long_series), *_SEARCH, *_SHIFTS, select=select)


ORACLE |= {
    "shift_stats": chain(
        CASES,
        _series(_DRIFT),
        _VECTORS,
        ("cuts", f"SELECT * FROM (SELECT *, unnest({list(BREAKS)}) AS bp FROM vectors) WHERE bp < len(x)"),
        *_SHIFTS,
        select="SELECT * FROM shifts",
    ),
    "changepoints": _search_sql(
        f"SELECT {_KEY}, CAST(bp AS INTEGER) AS bp, periods[bp + 1] AS period FROM cuts"
    ),
    "changepoint_shifts": _search_sql("SELECT * FROM shifts"),
    "changepoint_shifts_log_n": _search_sql("SELECT * FROM shifts", "log_n"),
    "largest_shifts": _search_sql(
        f"""
SELECT {_KEY}, changepoint_period, {display('mean_before', 3)} AS before,
       {display('mean_after', 3)} AS after, {display('shift_magnitude', 3)} AS change, shift_direction
FROM shifts"""
    ),
    "latest_changepoint": _search_sql(
        f"""
SELECT {_KEY}, changepoint_period AS latest_changepoint_period, shift_magnitude
FROM shifts QUALIFY row_number() OVER (PARTITION BY {_KEY} ORDER BY changepoint_period DESC) = 1"""
    ),
}


# --------------------------------------------------------------------------- cohorts

_COHORT = (
    (
        "cohorts",
        f"""
  SELECT *, CAST(date_trunc('month', start_date) AS DATE) AS cohort_start,
         COUNT(*) OVER (PARTITION BY indicator, date_trunc('month', start_date)) AS size
  FROM cases WHERE year(start_date) >= {START_YEAR}""",
    ),
    (
        "matrix",
        f"""
  SELECT indicator, CAST(year(cohort_start) * 100 + month(cohort_start) AS INTEGER) AS cohort_period,
         CAST(size AS INTEGER) AS cohort_size, CAST(w AS INTEGER) AS weeks_since_intake,
         CAST(still_open AS INTEGER) AS open_count,
         floor(still_open / CAST(size AS DOUBLE) * 1e4 + 0.5e0) / 1e4 AS pct_open,
         cohort_start >= DATE '2000-12-01' AS is_recent_cohort
  FROM (
    SELECT indicator, cohort_start, size, w,
           COUNT(*) FILTER (WHERE end_date IS NULL OR end_date > cohort_start + CAST(7 * w AS INTEGER)) AS still_open
    FROM cohorts, range(1, 27) weeks(w)
    WHERE size >= 10 AND cohort_start + CAST(7 * w AS INTEGER) <= {_AS_OF}
    GROUP BY indicator, cohort_start, size, w)""",
    ),
    (
        "history",
        """
  SELECT indicator, weeks_since_intake,
         CASE WHEN n < 5 THEN list_sum(points) / n / 1e4
              ELSE list_sum(points[lo + 1:hi]) / (hi - lo) / 1e4 END AS baseline
  FROM (
    SELECT indicator, weeks_since_intake, COUNT(*) AS n,
           list(CAST(floor(pct_open * 1e4 + 0.5e0) AS BIGINT) ORDER BY pct_open) AS points,
           greatest(0, CAST(floor(COUNT(*) * 0.1e0) AS BIGINT)) AS lo,
           greatest(1, CAST(floor(COUNT(*) * 0.9e0) AS BIGINT)) AS hi
    FROM matrix WHERE NOT is_recent_cohort GROUP BY indicator, weeks_since_intake)""",
    ),
    (
        "compared",
        f"""
  SELECT m.indicator, m.cohort_period, m.cohort_size, m.weeks_since_intake, m.open_count, m.pct_open,
         h.baseline AS pct_open_historical, {r4('(m.pct_open - h.baseline)')} AS delta_historical,
         m.is_recent_cohort
  FROM matrix m LEFT JOIN history h USING (indicator, weeks_since_intake)""",
    ),
)

ORACLE |= {
    "cohort_matrix": chain(CASES, *_COHORT[:2], select="SELECT * FROM matrix"),
    "cohort_baseline": chain(
        CASES,
        *_COHORT,
        select=f"SELECT * REPLACE ({r4('pct_open_historical')} AS pct_open_historical) FROM compared",
    ),
    "cohort_week12": chain(
        CASES,
        *_COHORT,
        select=f"""
SELECT indicator, cohort_period, cohort_size, {display('pct_open * 100', 1)} AS pct_open,
       {display('pct_open_historical * 100', 1)} AS pct_open_historical,
       {display('delta_historical * 100', 1)} AS delta_pct
FROM compared
WHERE weeks_since_intake = 12 AND is_recent_cohort AND pct_open_historical IS NOT NULL""",
    ),
}


# --------------------------------------------------------------------------- portfolio

_DAYS = (
    "days",
    f"SELECT unnest([{', '.join(f"DATE '{day}'" for day, _ in SNAPSHOTS)}]) AS snapshot_month",
)
_HISTORY = ("days", f"SELECT unnest([{', '.join(f"DATE '{day}'" for day in HISTORY)}]) AS snapshot_month")
_DAY_ONLY = ("days", f"SELECT {_DAY} AS snapshot_month")
_OPEN = (
    "open_cases",
    """
  SELECT snapshot_month, case_id, indicator FROM cases, days
  WHERE indicator IS NOT NULL AND start_date <= snapshot_month AND (end_date IS NULL OR end_date > snapshot_month)""",
)
_STATE = (
    (
        "known",
        "SELECT * FROM milestones, days WHERE milestone_ts IS NOT NULL AND milestone_ts <= snapshot_month",
    ),
    (
        "newest",
        """
  SELECT snapshot_month, case_id, milestone, milestone_ts FROM known
  QUALIFY row_number() OVER (
    PARTITION BY snapshot_month, case_id ORDER BY milestone_ts DESC, milestone DESC) = 1""",
    ),
    ("pauses", "SELECT snapshot_month, case_id, MAX(milestone_ts) AS ts FROM known WHERE milestone IN ('AF', 'AO') GROUP BY ALL"),
    ("resumes", "SELECT snapshot_month, case_id, MAX(milestone_ts) AS ts FROM known WHERE milestone IN ('RF', 'NF') GROUP BY ALL"),
    (
        "state",
        """
  SELECT snapshot_month, case_id, indicator, paused AS is_paused,
         COALESCE(NOT paused AND milestone IN ('NF', 'RF', 'RO'), FALSE) AS is_workable,
         COALESCE(milestone = 'AO', FALSE) AS is_mini_hearing
  FROM (
    SELECT o.snapshot_month, o.case_id, o.indicator, m.milestone,
           (p.ts IS NOT NULL AND (r.ts IS NULL OR p.ts > r.ts)) AS paused
    FROM open_cases o LEFT JOIN newest m USING (snapshot_month, case_id)
    LEFT JOIN pauses p USING (snapshot_month, case_id) LEFT JOIN resumes r USING (snapshot_month, case_id))""",
    ),
)
_EARLY = (
    "early",
    f"""
  SELECT snapshot_month, c.indicator, CAST(COUNT(DISTINCT m.case_id) AS INTEGER) AS tidligbehandling_count
  FROM milestones m JOIN cases c USING (case_id), days
  WHERE m.milestone = 'NO' AND year(m.milestone_ts) = year(snapshot_month)
    AND month(m.milestone_ts) = month(snapshot_month) AND c.{_KEPT}
  GROUP BY ALL""",
)
_SNAPSHOT = (
    "snapshot",
    """
  SELECT snapshot_month, s.indicator AS indikator, CAST(COUNT(*) AS INTEGER) AS open_total,
         CAST(COUNT(*) FILTER (WHERE is_workable) AS INTEGER) AS open_workable,
         CAST(COUNT(*) FILTER (WHERE is_paused) AS INTEGER) AS open_paused,
         CAST(COUNT(*) FILTER (WHERE is_mini_hearing) AS INTEGER) AS open_mini_hearing,
         COALESCE(MAX(e.tidligbehandling_count), 0) AS tidligbehandling_count
  FROM state s LEFT JOIN early e USING (snapshot_month, indicator) GROUP BY ALL""",
)


def _snapshot_sql(select: str, days: tuple[str, str] = _DAYS) -> str:
    return chain(CASES, MILESTONES, days, _OPEN, *_STATE, _EARLY, _SNAPSHOT, select=select)


_WITHOUT_DAY = "SELECT * EXCLUDE (snapshot_month) FROM"
_BATCHES = ", ".join(f"(DATE '{day}', '{run_at:%Y%m%dT%H%M%S}')" for day, run_at in SNAPSHOTS)
ORACLE |= {
    "open_at": chain(CASES, _DAY_ONLY, _OPEN, select=f"{_WITHOUT_DAY} open_cases"),
    "latest_milestone": chain(MILESTONES, _DAY_ONLY, *_STATE[:2], select=f"{_WITHOUT_DAY} newest"),
    "case_state": chain(CASES, MILESTONES, _DAY_ONLY, _OPEN, *_STATE, select=f"{_WITHOUT_DAY} state"),
    "early_processing": chain(CASES, MILESTONES, _DAY_ONLY, _EARLY, select=f"{_WITHOUT_DAY} early"),
    "portfolio_snapshot": _snapshot_sql("SELECT * FROM snapshot", _DAY_ONLY),
    "portfolio_history": _snapshot_sql("SELECT * FROM snapshot", _HISTORY),
    "portfolio_shares": _snapshot_sql(
        """
SELECT snapshot_month, CAST(SUM(open_workable) AS DOUBLE) / SUM(open_total) AS andel_arbeidbar,
       CAST(SUM(open_paused) AS DOUBLE) / SUM(open_total) AS andel_pauset
FROM snapshot GROUP BY snapshot_month"""
    ),
    "early_share": _snapshot_sql(
        """
SELECT snapshot_month, CAST(SUM(tidligbehandling_count) AS BIGINT) AS early, received,
       CAST(SUM(tidligbehandling_count) AS DOUBLE) / received AS andel_tidligbehandling
FROM snapshot JOIN (SELECT last_day(start_date) AS snapshot_month, COUNT(*) AS received FROM cases GROUP BY ALL)
  USING (snapshot_month)
GROUP BY snapshot_month, received"""
    ),
    "snapshot_audit": _snapshot_sql(
        f"""
SELECT snapshot_month, COUNT(*) AS rader
FROM snapshot JOIN (VALUES {_BATCHES}) b(snapshot_month, batch_id) USING (snapshot_month)
WHERE batch_id = '{RUN_AT:%Y%m%dT%H%M%S}' GROUP BY snapshot_month"""
    ),
}


# --------------------------------------------------------------------------- projection

_YTD = (
    "ytd_rates",
    f"""
  SELECT a.indicator, a.year, a.month, CAST(SUM(b.on_time) AS BIGINT) AS cum_on_time,
         CAST(SUM(b.total) AS BIGINT) AS cum_total,
         CAST(SUM(b.on_time) AS DOUBLE) / SUM(b.total) AS ytd
  FROM monthly a JOIN monthly b
    ON a.indicator = b.indicator AND a.year = b.year AND b.month <= a.month
  GROUP BY a.indicator, a.year, a.month""",
)
_MONTHLY = (
    "monthly",
    f"""
  SELECT indicator, CAST(year(stop_date) AS INTEGER) AS year, CAST(month(stop_date) AS INTEGER) AS month,
         COUNT(*) FILTER (WHERE on_time = 1) AS on_time, COUNT(*) AS total
  FROM cases
  WHERE stop_date IS NOT NULL AND deadline IS NOT NULL AND {_KEPT} AND year(stop_date) >= {START_YEAR}
  GROUP BY ALL""",
)
_PROFILE = (
    (
        "year_ends",
        "SELECT indicator, year, ytd AS year_end FROM ytd_rates, this WHERE month = 12 AND year < current_year",
    ),
    (
        "ratios",
        """
  SELECT y.indicator, y.month, list_sort(list(y.ytd / e.year_end)) AS r
  FROM ytd_rates y JOIN year_ends e ON y.indicator = e.indicator AND y.year = e.year
  WHERE e.year_end <> 0
    AND y.indicator IN (SELECT indicator FROM year_ends GROUP BY indicator HAVING COUNT(*) >= 3)
  GROUP BY y.indicator, y.month""",
    ),
    (
        "profile",
        """
  SELECT indicator, month, list_avg(kept) AS mean_ratio,
         list_aggregate(kept, 'stddev_pop') AS std_ratio, CAST(len(kept) AS INTEGER) AS n_years
  FROM (SELECT indicator, month, CASE WHEN len(r) > 2 THEN r[2:len(r) - 1] ELSE r END AS kept
        FROM ratios WHERE len(r) >= 3)""",
    ),
)


def _bounds(rate: str, mean: str, std: str) -> tuple[str, str, str]:
    estimate = f"({rate} / {mean})"
    spread = f"(1.28e0 * ({rate} * {std} / ({mean} * {mean})))"
    usable = f"{mean} IS NOT NULL AND {mean} <> 0"
    lower = f"CASE WHEN {std} > 0 THEN greatest(0e0, {estimate} - {spread}) ELSE {estimate} END"
    upper = f"CASE WHEN {std} > 0 THEN least(1e0, {estimate} + {spread}) ELSE {estimate} END"
    return tuple(
        f"CASE WHEN {usable} THEN {r4(f'({value})')} END" for value in (estimate, lower, upper)
    )


_YEAR_END = _bounds("l.ytd", "p.mean_ratio", "p.std_ratio")[0]
_AHEAD = _bounds("forecast", "mean_ratio", "std_ratio")
_PROJECTION = (
    (
        "latest",
        f"""
  SELECT l.indicator, l.month, l.ytd, p.mean_ratio, {_YEAR_END} AS estimate
  FROM (SELECT * FROM ytd_rates, this WHERE year = current_year
        QUALIFY row_number() OVER (PARTITION BY indicator ORDER BY month DESC) = 1) l
  LEFT JOIN profile p ON p.indicator = l.indicator AND p.month = l.month
  WHERE l.indicator IN (SELECT indicator FROM profile)""",
    ),
    (
        "ahead",
        """
  SELECT l.indicator, p.month, p.mean_ratio, p.std_ratio, l.estimate,
         l.ytd * (p.mean_ratio / l.mean_ratio) AS forecast
  FROM latest l JOIN profile p ON p.indicator = l.indicator AND p.month > l.month
  WHERE l.mean_ratio <> 0""",
    ),
    (
        "projection",
        f"""
  SELECT y.indicator AS indikator, CAST(current_year * 100 + y.month AS INTEGER) AS period,
         'actual' AS type, {r4('y.ytd')} AS verdi, CAST(NULL AS DOUBLE) AS ci_lower,
         CAST(NULL AS DOUBLE) AS ci_upper, l.estimate AS year_end_estimate
  FROM ytd_rates y JOIN latest l ON l.indicator = y.indicator, this WHERE y.year = current_year
  UNION ALL
  SELECT indicator, CAST(current_year * 100 + month AS INTEGER), 'forecast', {r4('forecast')},
         {_AHEAD[1]}, {_AHEAD[2]}, estimate
  FROM ahead, this""",
    ),
    (
        "year_end",
        """
  SELECT indikator, f.period, f.year_end_estimate AS prognose_aarslutt,
         f.ci_lower AS prognose_ci_lower, f.ci_upper AS prognose_ci_upper
  FROM (SELECT DISTINCT indikator FROM projection)
  LEFT JOIN (SELECT * FROM projection WHERE type = 'forecast'
             QUALIFY row_number() OVER (PARTITION BY indikator ORDER BY period DESC) = 1) f USING (indikator)""",
    ),
)


def _this(year: int) -> tuple[str, str]:
    return "this", f"SELECT {year} AS current_year"


def _projection_sql(select: str, year: int = CURRENT_YEAR) -> str:
    return chain(CASES_AS_OF, _this(year), _MONTHLY, _YTD, *_PROFILE, *_PROJECTION, select=select)


def _rag_sql(targets: str, year: int = CURRENT_YEAR) -> str:
    return _projection_sql(
        f"""
SELECT y.indikator, y.prognose_aarslutt, t.target,
       CASE WHEN y.prognose_aarslutt IS NULL OR t.target IS NULL THEN NULL
            WHEN y.prognose_aarslutt >= t.target THEN 3
            WHEN y.prognose_aarslutt >= t.target * 0.95e0 THEN 2 ELSE 1 END AS rag
FROM year_end y LEFT JOIN (VALUES {targets}) t(indikator, target) ON t.indikator = y.indikator""",
        year,
    )


_ALERTS = ", ".join(f"('{name}', {target}::DOUBLE)" for name, target, active in ALERTS if active)


ORACLE |= {
    "ytd_rate": chain(
        CASES, _MONTHLY, _YTD, select=f"SELECT * REPLACE ({r4('ytd')} AS ytd) FROM ytd_rates"
    ),
    "seasonal_profile": chain(
        CASES_AS_OF,
        _this(CURRENT_YEAR),
        _MONTHLY,
        _YTD,
        *_PROFILE,
        select=f"""
SELECT indicator, month, {r4('mean_ratio')} AS mean_ratio, {r4('std_ratio')} AS std_ratio, n_years
FROM profile""",
    ),
    "projection": _projection_sql("SELECT * FROM projection"),
    "projection_summary": _projection_sql(
        f"""
SELECT indikator, MAX(verdi) FILTER (WHERE type = 'actual') AS ytd_naa,
       MAX(year_end_estimate) AS prognose_aarslutt,
       MAX(ci_lower) FILTER (WHERE type = 'forecast' AND period = {CURRENT_YEAR * 100 + 12}) AS ci_lower,
       MAX(ci_upper) FILTER (WHERE type = 'forecast' AND period = {CURRENT_YEAR * 100 + 12}) AS ci_upper
FROM projection GROUP BY indikator"""
    ),
    "projection_measures": _projection_sql("SELECT * FROM year_end"),
    "projection_measures_december": _projection_sql("SELECT * FROM year_end", PAST_YEAR),
    "projection_rag": _rag_sql(_ALERTS),
    "projection_rag_december": _rag_sql(_ALERTS, PAST_YEAR),
    "projection_rag_config": _rag_sql(
        ", ".join(f"('{name}', {amber}::DOUBLE)" for name, _, _, amber in TARGETS)
    ),
}
