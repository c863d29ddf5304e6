"""DuckDB SQL equivalents of the query catalogue (the correctness oracle).

The SQL is written independently of the DataFrame code, from the stated
semantics, limits and texts included; only the input adapters (plain
projections of the driver tables) are shared, so both engines see the same
rows.  DuckDB differences handled here: ``quantile_disc`` for the p75, Spark's
decimal HALF_UP ``round`` (reproduced by rounding the shortest decimal text of
the double), explicit NULLS FIRST / LAST, and explicit zero guards where Spark
uses ``try_divide``.
"""
from __future__ import annotations

from perfwatch.sources import adapters as ad

# --- fixed values, stated here apart from the library's own --------------------
LCP_GOOD_MS, CLS_GOOD, INP_GOOD_MS, TTFB_GOOD_MS, POOR_STRETCH = 2500.0, 0.1, 200.0, 800.0, 1.6
# metric, stem, delta column, percent column, relative limit in percent or absolute limit, poor
RULES = (
    ("LCP", "lcp_ms", "lcp_delta_ms", "lcp_delta_percent", 20.0, 2500.0),
    ("CLS", "cls", "cls_delta", None, 0.05, 0.1),
    ("INP", "inp_ms", "inp_delta_ms", "inp_delta_percent", 20.0, 200.0),
    ("TTFB", "ttfb_ms", "ttfb_delta_ms", "ttfb_delta_percent", 25.0, 800.0),
)
ADVICE = {
    "LCP": ("One of the four parts of LCP grew: time to first byte, the delay before the LCP resource starts "
            "to load, its load time, or the delay until it is drawn.",
            "Break LCP down in a trace and treat the longest part: make the LCP resource discoverable in the "
            "HTML with fetchpriority=high and without lazy loading, serve it in a modern format, inline "
            "critical CSS."),
    "CLS": ("A layout shift window scored higher: something was inserted above visible content, or changed "
            "size, without a user action in the half second before.",
            "List the layout-shift entries with their source elements; set width and height or aspect-ratio, "
            "give late slots a min-height, animate with transform only."),
    "INP": ("The slowest interactions got slower in one of three phases: input delay, event handlers, or "
            "the next paint (large DOM, forced layout).",
            "Attribute INP to its element and phase; yield with scheduler.yield() inside handlers, cut "
            "third-party scripts at load, shrink the DOM that an interaction restyles."),
    "TTFB": ("Redirects, connection set-up or the time to produce the document grew before any byte arrived.",
             "Compare Server-Timing with the navigation phases; drop redirects, cache HTML at the edge or use "
             "stale-while-revalidate, stream the head early, keep connections with HTTP/3."),
}
# -------------------------------------------------------------------------------


def d(x: float) -> str:
    """A double literal with the exact value of the Python float."""
    return f"CAST('{float(x)!r}' AS DOUBLE)"


def rnd(expr: str, n: int) -> str:
    """Spark's round(double, n): HALF_UP on the shortest decimal text."""
    return f"CAST(round(CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38,15)), {n}) AS DOUBLE)"


def exact_mean(col: str, data_scale: int, out_scale: int, factor: int = 1) -> str:
    """HALF_UP rounding of the exact mean of values with ``data_scale``
    decimals, in integer arithmetic (DuckDB divides decimals in DOUBLE)."""
    units = f"CAST(sum(CAST({col} AS DECIMAL(18,{data_scale}))) * {10 ** data_scale} AS HUGEINT) * {factor}"
    den = f"(count({col}) * CAST({10 ** data_scale} AS HUGEINT) // {10 ** out_scale})"
    q = f"((2 * abs({units}) + {den}) // (2 * {den}))"
    return f"(CASE WHEN count({col}) = 0 THEN NULL ELSE CAST(sign({units}) * {q} AS DOUBLE) / {10 ** out_scale} END)"


def p75(col: str, n: int) -> str:
    return rnd(f"quantile_disc({col}, 0.75)", n)


def s(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sel(exprs) -> str:
    return ",\n  ".join(ad.select_list(exprs))


ROUTE_OF = {"/": ("home", "index", "homepage"), "/product": ("products", "pdp"), "/checkout": ("cart", "basket"),
            "/account": ("signin", "login", "profile")}


def route_sql(x: str) -> str:
    """The canonical route: what stands before any query or fragment, without
    the spaces around it, one slash on either side and its case, looked up
    among the aliases and given its leading slash back."""
    name = f"lower(regexp_replace(trim(split_part(split_part({x}, '#', 1), '?', 1), ' '), '^/?(.*?)/?$', '\\1'))"
    arms = " ".join(f"WHEN bare IN ({', '.join(s(n) for n in names)}) THEN {s(route)}" for route, names in ROUTE_OF.items())
    return f"(SELECT CASE {arms} ELSE '/' || bare END FROM (SELECT {name} AS bare))"


def device_sql(x: str) -> str:
    low = f"lower(trim({x}, ' '))"
    resolved = (f"coalesce(CASE {low} WHEN 'phone' THEN 'mobile' WHEN 'smartphone' THEN 'mobile' "
                f"WHEN 'handset' THEN 'mobile' WHEN 'pc' THEN 'desktop' WHEN 'laptop' THEN 'desktop' "
                f"WHEN 'ipad' THEN 'tablet' END, {low})")
    return f"(CASE WHEN {resolved} IN ('mobile', 'desktop', 'tablet') THEN {resolved} ELSE 'unknown' END)"


def score(v: str, good: float) -> str:
    return f"(least({d(1.0)}, greatest({d(0.0)}, {d(2.0)} - {v} / {d(good)})) * {d(100.0)})"


def risk_sql(lcp="p75_lcp_ms", cls="p75_cls", inp="p75_inp_ms") -> str:
    pairs = ((lcp, LCP_GOOD_MS), (cls, CLS_GOOD), (inp, INP_GOOD_MS))
    poor = " + ".join(f"CAST({c} > {d(g * POOR_STRETCH)} AS INT)" for c, g in pairs)
    ni = " + ".join(f"CAST({c} > {d(g)} AS INT)" for c, g in pairs)
    return (f"(CASE WHEN ({poor}) >= 2 THEN 'critical' WHEN ({poor}) = 1 THEN 'high' "
            f"WHEN ({ni}) >= 1 THEN 'medium' ELSE 'low' END)")


def good_rate(col: str, good: float) -> str:
    return rnd(f"avg(CASE WHEN {col} <= {d(good)} THEN 1.0 WHEN {col} > {d(good)} THEN 0.0 END)", 4)


def sev_rank(col="severity") -> str:
    return (f"(CASE WHEN {col} = 'critical' THEN 4 WHEN {col} = 'high' THEN 3 "
            f"WHEN {col} = 'medium' THEN 2 ELSE 1 END)")


def div0(a: str, b: str) -> str:
    return f"(CASE WHEN {b} = 0 THEN NULL ELSE {a} / {b} END)"


VALID = "('mobile', 'desktop', 'tablet')"
NONNEG_PAGE = ("lcp_ms", "cls", "inp_ms", "ttfb_ms", "fcp_ms", "page_weight_kb", "js_error_count")
NONNEG_LAB = ("lcp_ms", "cls", "inp_ms", "ttfb_ms", "fcp_ms", "speed_index_ms",
              "total_blocking_time_ms", "request_count")
NONNEG_FIELD = ("p75_lcp_ms", "p75_cls", "p75_inp_ms", "sample_count")


def nonneg(cols) -> str:
    return " AND ".join(f"({c} IS NULL OR {c} >= 0)" for c in cols)


# -- shared CTEs ---------------------------------------------------------------

CTE = {}
CTE["pl_raw"] = f"SELECT\n  {sel(ad.PAGE_LOAD_EXPRS)}\nFROM events"
CTE["pl_norm"] = (f"SELECT * REPLACE ({route_sql('route')} AS route, {device_sql('device_type')} AS device_type), "
                  f"CAST(\"timestamp\" AS DATE) AS event_date FROM pl_raw")
CTE["devices"] = f"SELECT\n  {sel(ad.NATION_DEVICE_EXPRS)}\nFROM nation"
CTE["pl_enriched"] = ("SELECT p.*, dv.device_class, dv.network_profile FROM pl_norm p "
                      "LEFT JOIN devices dv ON p.device_id = dv.device_id")
CTE["page_loads"] = (f"SELECT * FROM pl_enriched WHERE {nonneg(NONNEG_PAGE)} AND route IS NOT NULL "
                     f"AND device_type IN {VALID}")
CTE["lab_raw"] = f"SELECT\n  {sel(ad.LAB_REPORT_EXPRS)}\nFROM events"
CTE["lab"] = (f"SELECT * FROM (SELECT * REPLACE ({route_sql('route')} AS route, "
              f"{device_sql('device_type')} AS device_type), CAST(run_timestamp AS DATE) AS report_date "
              f"FROM lab_raw WHERE environment = 'production') "
              f"WHERE {nonneg(NONNEG_LAB)} AND route IS NOT NULL AND device_type IN {VALID}")
CTE["field_raw"] = f"SELECT\n  {sel(ad.FIELD_METRIC_EXPRS)}\nFROM events"
CTE["daily0"] = f"""SELECT event_date AS date, route, device_type, release_version,
  {rnd('avg(lcp_ms)', 1)} AS avg_lcp_ms, {p75('lcp_ms', 1)} AS p75_lcp_ms,
  {rnd('avg(cls)', 4)} AS avg_cls, {p75('cls', 4)} AS p75_cls,
  {rnd('avg(inp_ms)', 1)} AS avg_inp_ms, {p75('inp_ms', 1)} AS p75_inp_ms,
  {rnd('avg(ttfb_ms)', 1)} AS avg_ttfb_ms, count(*) AS sample_count,
  {good_rate('lcp_ms', LCP_GOOD_MS)} AS good_lcp_rate,
  {good_rate('cls', CLS_GOOD)} AS good_cls_rate,
  {good_rate('inp_ms', INP_GOOD_MS)} AS good_inp_rate
FROM page_loads GROUP BY event_date, route, device_type, release_version"""
_health = (f"({score('avg_lcp_ms', LCP_GOOD_MS)} * {d(0.35)} + {score('avg_cls', CLS_GOOD)} * {d(0.20)} "
           f"+ {score('avg_inp_ms', INP_GOOD_MS)} * {d(0.30)} + {score('avg_ttfb_ms', TTFB_GOOD_MS)} * {d(0.15)})"
           f" * least({d(1.0)}, CAST(sample_count AS DOUBLE) / {d(30.0)})")
CTE["daily"] = f"SELECT *, {rnd(_health, 1)} AS overall_health_score FROM daily0"
CTE["lab_scores"] = (f"SELECT report_date AS date, route, device_type, "
                     f"{rnd('avg(performance_score)', 1)} AS performance_score FROM lab "
                     f"GROUP BY report_date, route, device_type")
CTE["rankings"] = f"""SELECT date, route, device_type, p75_lcp_ms, p75_cls, p75_inp_ms, performance_score,
  CAST(dense_rank() OVER (PARTITION BY date, device_type ORDER BY performance_score DESC NULLS LAST) AS INT) AS rank_overall,
  CAST(dense_rank() OVER (PARTITION BY date, device_type ORDER BY p75_lcp_ms ASC NULLS FIRST) AS INT) AS rank_lcp,
  CAST(dense_rank() OVER (PARTITION BY date, device_type ORDER BY p75_cls ASC NULLS FIRST) AS INT) AS rank_cls,
  CAST(dense_rank() OVER (PARTITION BY date, device_type ORDER BY p75_inp_ms ASC NULLS FIRST) AS INT) AS rank_inp,
  {risk_sql()} AS risk_level
FROM daily LEFT JOIN lab_scores USING (date, route, device_type)"""
CTE["breakdown"] = f"""SELECT *, {risk_sql()} AS risk_level FROM (
  SELECT event_date AS date, route, device_type, device_class, connection_type,
    {p75('lcp_ms', 1)} AS p75_lcp_ms, {p75('cls', 4)} AS p75_cls, {p75('inp_ms', 1)} AS p75_inp_ms,
    count(*) AS sample_count
  FROM page_loads GROUP BY event_date, route, device_type, device_class, connection_type)"""
CTE["rel_agg"] = f"""SELECT route, device_type, release_version, min(event_date) AS release_start_date,
  {p75('lcp_ms', 1)} AS p75_lcp_ms, {p75('cls', 4)} AS p75_cls, {p75('inp_ms', 1)} AS p75_inp_ms,
  {p75('ttfb_ms', 1)} AS p75_ttfb_ms, count(*) AS sample_count
FROM page_loads GROUP BY route, device_type, release_version"""
CTE["rel_ranked"] = ("SELECT *, CAST(dense_rank() OVER (PARTITION BY route, device_type "
                     "ORDER BY release_start_date ASC NULLS FIRST) AS INT) AS release_rank FROM rel_agg")
_M = (("lcp", "lcp_ms", 1, True), ("cls", "cls", 4, False), ("inp", "inp_ms", 1, True),
      ("ttfb", "ttfb_ms", 1, True))
CTE["pairs0"] = ("SELECT b.route, b.device_type, b.release_rank, b.release_version AS before_release, "
                 + ", ".join(f"b.p75_{st} AS before_p75_{st}" for _, st, _, _ in _M)
                 + ", a.release_version AS after_release, a.release_start_date AS after_release_start_date, "
                 + ", ".join(f"a.p75_{st} AS after_p75_{st}" for _, st, _, _ in _M)
                 + " FROM rel_ranked b JOIN rel_ranked a ON a.route = b.route AND a.device_type = b.device_type "
                   "AND a.release_rank - 1 = b.release_rank")
_deltas = []
for k, st, n, ms in _M:
    name = f"{k}_delta_ms" if ms else f"{k}_delta"
    _deltas.append(f"{rnd(f'after_p75_{st} - before_p75_{st}', n)} AS {name}")
CTE["pairs1"] = "SELECT *, " + ", ".join(_deltas) + " FROM pairs0"
CTE["pairs"] = "SELECT *, " + ", ".join(
    f"{rnd(div0(f'{k}_delta_ms', f'before_p75_{st}') + ' * 100', 2)} AS {k}_delta_percent"
    for k, st, n, ms in _M if ms) + " FROM pairs1"

def _rules():
    """(label, before, after, delta, pct or None, flag, excess)"""
    out = []
    for metric, stem, delta, pct, limit, poor in RULES:
        before, after, worse = f"before_p75_{stem}", f"after_p75_{stem}", pct or delta
        flag = f"(({worse} > {d(limit)}) OR ({after} > {d(poor)} AND {before} <= {d(poor)}))"
        out.append((metric, before, after, delta, pct, flag, f"greatest({worse} / {d(limit)}, {after} / {d(poor)})"))
    return out


_regressed = " OR ".join(flag for *_, flag, _ in _rules())
_improved = f"lcp_delta_percent <= {d(-10.0)} OR inp_delta_percent <= {d(-10.0)} OR cls_delta <= {d(-0.02)}"
CTE["before_after"] = f"""SELECT route, device_type, before_release, after_release,
  before_p75_lcp_ms, after_p75_lcp_ms, lcp_delta_ms, lcp_delta_percent,
  before_p75_cls, after_p75_cls, cls_delta, before_p75_inp_ms, after_p75_inp_ms, inp_delta_ms,
  CASE WHEN {_regressed} THEN 'regressed' WHEN {_improved} THEN 'improved' ELSE 'stable' END AS improvement_status
FROM pairs"""


def _event_select(metric, before, after, delta, pct, flag, excess) -> str:
    dp = pct if pct else rnd(div0(delta, before) + " * 100", 2)
    sev = (f"CASE WHEN {excess} >= {d(2.0)} THEN 'critical' WHEN {excess} >= {d(1.5)} THEN 'high' "
           f"WHEN {excess} >= {d(1.2)} THEN 'medium' ELSE 'low' END")
    return (f"SELECT after_release_start_date AS detected_at, route, device_type, '{metric}' AS metric, "
            f"{before} AS baseline_value, {after} AS current_value, {delta} AS delta, {dp} AS delta_percent, "
            f"after_release AS release_version, {sev} AS severity, {s(ADVICE[metric][0])} AS probable_cause, "
            f"{s(ADVICE[metric][1])} AS recommended_action FROM pairs WHERE {flag}")


CTE["reg_events"] = "\nUNION ALL\n".join(_event_select(*r) for r in _rules())
CTE["latest_rankings"] = "SELECT * FROM rankings WHERE date = (SELECT max(date) FROM rankings)"
_WORST_ORDER = ("rank_overall DESC, device_type ASC, route ASC, p75_lcp_ms ASC NULLS FIRST, "
                "p75_cls ASC NULLS FIRST, p75_inp_ms ASC NULLS FIRST")
_SEV_ORDER = (f"{sev_rank()} DESC, delta_percent DESC NULLS LAST, route ASC, device_type ASC, "
              f"metric ASC, release_version ASC NULLS FIRST")
_SUMMARY = (f"{exact_mean('overall_health_score', 1, 1)} AS avg_health_score, "
            f"{exact_mean('p75_lcp_ms', 1, 0)} AS avg_p75_lcp_ms, "
            f"{exact_mean('p75_cls', 4, 3)} AS avg_p75_cls, {exact_mean('p75_inp_ms', 1, 0)} AS avg_p75_inp_ms")
CTE["route_summary"] = f"SELECT route, {_SUMMARY} FROM daily GROUP BY route"

# CTE dependencies (each query pulls the closure it needs)
DEPS = {
    "pl_raw": [], "pl_norm": ["pl_raw"], "devices": [], "pl_enriched": ["pl_norm", "devices"],
    "page_loads": ["pl_enriched"], "lab_raw": [], "lab": ["lab_raw"], "field_raw": [],
    "daily0": ["page_loads"], "daily": ["daily0"], "lab_scores": ["lab"],
    "rankings": ["daily", "lab_scores"], "breakdown": ["page_loads"], "rel_agg": ["page_loads"],
    "rel_ranked": ["rel_agg"], "pairs0": ["rel_ranked"], "pairs1": ["pairs0"], "pairs": ["pairs1"],
    "before_after": ["pairs"], "reg_events": ["pairs"], "latest_rankings": ["rankings"],
    "route_summary": ["daily"],
}


def with_ctes(body: str, *needs: str) -> str:
    order: list[str] = []

    def visit(n):
        for dep in DEPS[n]:
            visit(dep)
        if n not in order:
            order.append(n)

    for n in needs:
        visit(n)
    return "WITH " + ",\n".join(f"{n} AS (\n{CTE[n]}\n)" for n in order) + "\n" + body


# -- summary text (RP) ---------------------------------------------------------

def txt(x: str) -> str:
    return f"coalesce(CAST({x} AS VARCHAR), '-')"


def say(*parts) -> str:
    """Literal texts and (given as one-item lists) columns, one after the other."""
    return " || ".join(txt(p[0]) if isinstance(p, list) else s(p) for p in parts)


def listed(section: int, first: int, body: str, line: str, order: str) -> str:
    """One line per row of ``body`` from line ``first`` on, or one that says there is nothing."""
    return f"""SELECT {section} AS section, CAST({first - 1} + row_number() OVER (ORDER BY {order}) AS INTEGER) AS line_no,
  {line} AS line FROM ({body})
 UNION ALL SELECT {section}, {first}, '(nothing)' WHERE NOT EXISTS (SELECT * FROM ({body}))"""


def summary_sql() -> str:
    titles = ["PERFWATCH DIGEST, (run time)", "COVERAGE", "HEALTHIEST ROUTES", "LEAST HEALTHY ROUTES",
              "FASTER SINCE A RELEASE", "SLOWER SINCE A RELEASE", "DEVICE TYPES", "NEXT STEPS"]
    parts = [f"SELECT {i} AS section, 0 AS line_no, {s(t)} AS line" for i, t in enumerate(titles)]
    cover = say(["min(date)"], " to ", ["max(date)"], ": ", ["sum(sample_count)"], " page loads on ",
                ["count(DISTINCT route)"], " routes, mean health ", [exact_mean("overall_health_score", 1, 1)], " of 100")
    parts.append(f"SELECT 1, 1, {cover} FROM daily")
    latest = (f"SELECT date, device_type, {exact_mean('overall_health_score', 1, 1)} AS avg_score FROM daily "
              "WHERE date = (SELECT max(date) FROM daily) GROUP BY date, device_type")
    parts.append(listed(1, 2, latest, say(["date"], " ", ["device_type"], ": health ", ["avg_score"]),
                        "avg_score DESC NULLS LAST, device_type NULLS FIRST"))
    vitals = ("health ", ["avg_health_score"], ", p75 LCP ", ["avg_p75_lcp_ms"], " ms, CLS ", ["avg_p75_cls"], ", INP ",
              ["avg_p75_inp_ms"], " ms")
    for section, order in ((2, "avg_health_score DESC NULLS LAST, route NULLS FIRST"),
                           (3, "avg_health_score NULLS FIRST, route NULLS FIRST")):
        parts.append(listed(section, 1, f"SELECT * FROM route_summary ORDER BY {order} LIMIT 5",
                            say(["route"], ": ", *vitals), order))
    order = ("lcp_delta_percent NULLS FIRST, route NULLS FIRST, device_type NULLS FIRST, before_release NULLS FIRST, "
             "after_release NULLS FIRST")
    parts.append(listed(
        4, 1, f"SELECT * FROM before_after WHERE improvement_status = 'improved' ORDER BY {order} LIMIT 5",
        say(["route"], " on ", ["device_type"], ", ", ["before_release"], " to ", ["after_release"], ": p75 LCP ",
            ["lcp_delta_percent"], " % (", ["before_p75_lcp_ms"], " to ", ["after_p75_lcp_ms"], " ms), CLS ",
            ["before_p75_cls"], " to ", ["after_p75_cls"]), order))
    parts.append(listed(
        5, 1, f"SELECT * FROM reg_events ORDER BY {_SEV_ORDER} LIMIT 5",
        say(["severity"], ": ", ["metric"], " of ", ["route"], " on ", ["device_type"], " since ", ["release_version"],
            ", ", ["baseline_value"], " to ", ["current_value"], " (", ["delta_percent"], " %)"), _SEV_ORDER))
    devices = (f"SELECT device_type, {_SUMMARY}, {exact_mean('good_lcp_rate', 4, 1, 100)} AS good_lcp_pct "
               "FROM daily GROUP BY device_type")
    parts.append(listed(6, 1, devices, say(["device_type"], ": ", *vitals, ", good LCP ", ["good_lcp_pct"], " %"),
                        "avg_health_score DESC NULLS LAST, device_type NULLS FIRST"))
    parts.append(listed(7, 1, "SELECT DISTINCT metric, probable_cause, recommended_action FROM reg_events",
                        say(["metric"], ": ", ["probable_cause"], " ", ["recommended_action"]), "metric, probable_cause"))
    body = "SELECT CAST(section AS INTEGER) AS section, CAST(line_no AS INTEGER) AS line_no, line FROM (\n" + \
        "\nUNION ALL\n".join(f"SELECT * FROM ({p})" for p in parts) + "\n)"
    return with_ctes(body, "daily", "route_summary", "before_after", "reg_events")


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["route_normalization"] = with_ctes(
        f"SELECT event_id, route AS raw_route, {route_sql('route')} AS route FROM pl_raw", "pl_raw")
    q["device_normalization"] = with_ctes(
        f"SELECT event_id, device_type AS raw_device_type, {device_sql('device_type')} AS device_type "
        f"FROM pl_raw", "pl_raw")
    path = "regexp_replace(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*', '')"
    q["page_url_routes"] = f"SELECT page_id, url, {route_sql(path)} AS route FROM pages"
    keep_nonneg = nonneg(NONNEG_PAGE)
    q["quality_counts"] = with_ctes(
        "SELECT count(*) AS rows_in, "
        f"CAST(count_if(NOT coalesce({keep_nonneg}, false)) AS BIGINT) AS failed_negative, "
        "CAST(count_if(NOT coalesce(route IS NOT NULL, false)) AS BIGINT) AS failed_null_route, "
        f"CAST(count_if(NOT coalesce(device_type IN {VALID}, false)) AS BIGINT) AS failed_bad_device_type, "
        f"CAST(count_if(coalesce({keep_nonneg} AND route IS NOT NULL AND device_type IN {VALID}, false)) "
        "AS BIGINT) AS rows_out, "
        + ", ".join(f"count(CASE WHEN {c} < 0 THEN 1 END) AS negatives_{c}" for c in NONNEG_PAGE)
        + " FROM pl_norm", "pl_norm")
    q["quality_clean"] = with_ctes(
        "SELECT event_id, event_date, route, device_type, device_id, connection_type, release_version, "
        "lcp_ms, cls, inp_ms, ttfb_ms, device_class, network_profile FROM page_loads", "page_loads")
    q["field_metrics_clean"] = with_ctes(
        f"SELECT * FROM (SELECT CAST(date AS DATE) AS date, {route_sql('route')} AS route, "
        f"{device_sql('device_type')} AS device_type, connection_type, p75_lcp_ms, p75_cls, p75_inp_ms, "
        f"sample_count FROM field_raw) WHERE {nonneg(NONNEG_FIELD)} AND route IS NOT NULL "
        f"AND device_type IN {VALID} AND sample_count > 0", "field_raw")
    q["lab_clean"] = with_ctes(
        "SELECT report_id, report_date, route, device_type, release_version, lcp_ms, cls, inp_ms, ttfb_ms, "
        "performance_score FROM lab", "lab")
    rec = sel(ad.DEVICE_RECORD_EXPRS)
    rest = [n for _, n in ad.DEVICE_RECORD_EXPRS if n != "device_id"]
    q["device_dedupe"] = (
        f"SELECT device_id, " + ", ".join(f"s.{c} AS {c}" for c in rest)
        + f" FROM (SELECT device_id, min(struct_pack({', '.join(f'{c} := {c}' for c in rest)})) AS s "
        f"FROM (SELECT {rec} FROM events) GROUP BY device_id)")
    q["daily_vitals"] = with_ctes("SELECT * FROM daily", "daily")
    q["device_breakdown"] = with_ctes("SELECT * FROM breakdown", "breakdown")
    q["lab_daily_score"] = with_ctes("SELECT * FROM lab_scores", "lab_scores")
    q["route_rankings"] = with_ctes("SELECT * FROM rankings", "rankings")
    q["release_aggregates"] = with_ctes("SELECT * FROM rel_agg", "rel_agg")
    q["release_pairs"] = with_ctes("SELECT * FROM pairs", "pairs")
    q["before_after"] = with_ctes("SELECT * FROM before_after", "before_after")
    q["regression_events"] = with_ctes("SELECT * FROM reg_events", "reg_events")
    q["events_by_severity"] = with_ctes("SELECT severity, count(*) AS count FROM reg_events GROUP BY severity",
                                        "reg_events")
    q["overall_health"] = with_ctes(
        f"SELECT {exact_mean('overall_health_score', 1, 1)} AS avg_score, CAST(sum(sample_count) AS BIGINT) AS "
        "total_samples, count(DISTINCT route) AS routes, min(date) AS start_date, max(date) AS end_date "
        "FROM daily", "daily")
    q["health_by_device_latest"] = with_ctes(
        f"SELECT device_type, {exact_mean('overall_health_score', 1, 1)} AS avg_score FROM daily "
        "WHERE date = (SELECT max(date) FROM daily) GROUP BY device_type", "daily")
    q["health_trend"] = with_ctes(
        f"SELECT date, device_type, {exact_mean('overall_health_score', 1, 1)} AS avg_health_score FROM daily "
        "GROUP BY date, device_type", "daily")
    q["health_trend_pivot"] = with_ctes(
        "SELECT date, " + ", ".join(
            f"{exact_mean(f'(CASE WHEN device_type = {s(v)} THEN overall_health_score END)', 1, 1)} AS {v}"
            for v in ("mobile", "desktop", "tablet")) + " FROM daily GROUP BY date", "daily")
    q["route_summary"] = with_ctes("SELECT * FROM route_summary", "route_summary")
    q["best_routes"] = with_ctes(
        "SELECT * FROM route_summary ORDER BY avg_health_score DESC NULLS LAST, route ASC LIMIT 5",
        "route_summary")
    q["worst_routes"] = with_ctes(
        "SELECT * FROM route_summary ORDER BY avg_health_score ASC NULLS FIRST, route ASC LIMIT 5",
        "route_summary")
    q["device_summary"] = with_ctes(
        f"SELECT device_type, {_SUMMARY}, {exact_mean('good_lcp_rate', 4, 1, 100)} AS good_lcp_pct "
        "FROM daily GROUP BY device_type", "daily")
    q["top_improvements"] = with_ctes(
        "SELECT * FROM before_after WHERE improvement_status = 'improved' ORDER BY lcp_delta_percent ASC "
        "NULLS FIRST, route, device_type, before_release, after_release LIMIT 5", "before_after")
    q["top_regressions"] = with_ctes(f"SELECT * FROM reg_events ORDER BY {_SEV_ORDER} LIMIT 5", "reg_events")
    q["recommended_actions"] = with_ctes(
        "SELECT DISTINCT metric, probable_cause, recommended_action FROM reg_events", "reg_events")
    q["worst_now"] = with_ctes(
        "SELECT route, device_type, p75_lcp_ms, p75_cls, p75_inp_ms, performance_score, risk_level "
        f"FROM (SELECT * FROM latest_rankings ORDER BY {_WORST_ORDER} LIMIT 10)", "latest_rankings")
    q["active_regressions"] = with_ctes(
        "SELECT route, device_type, metric, release_version, severity, baseline_value, current_value, "
        f"delta_percent FROM (SELECT * FROM reg_events ORDER BY {_SEV_ORDER} LIMIT 20)", "reg_events")
    q["worst_route_breakdown"] = with_ctes(
        "SELECT * FROM breakdown WHERE route = (SELECT route FROM latest_rankings ORDER BY "
        f"{_WORST_ORDER} LIMIT 1) ORDER BY device_type ASC, device_class ASC NULLS FIRST, date ASC, "
        "connection_type ASC LIMIT 20", "breakdown", "latest_rankings")
    q["export_rankings"] = with_ctes("SELECT * FROM rankings", "rankings")
    q["export_regressions"] = with_ctes("SELECT * FROM reg_events", "reg_events")
    q["export_before_after"] = with_ctes("SELECT * FROM before_after", "before_after")
    q["export_breakdown"] = with_ctes("SELECT * FROM breakdown", "breakdown")
    li = [("l_extendedprice", "price", 50000.0, 2), ("l_quantity", "qty", 25.0, 1),
          ("l_discount", "disc", 0.05, 4)]
    q["order_vitals"] = (
        "SELECT l_returnflag, l_linestatus, CAST(year(l_shipdate) AS INT) AS ship_year, "
        + ", ".join(f"{rnd(f'avg({c})', n)} AS avg_{st}, {p75(c, n)} AS p75_{st}" for c, st, _, n in li)
        + ", count(*) AS sample_count, "
        + ", ".join(f"{good_rate(c, g)} AS good_{st}_rate" for c, st, g, _ in li)
        + " FROM lineitem GROUP BY l_returnflag, l_linestatus, year(l_shipdate)")
    q["summary_lines"] = summary_sql()
    q["metric_events"] = q["regression_events"]
    q["daily_from_partials"] = q["daily_vitals"]
    q["breakdown_from_partials"] = q["device_breakdown"]
    q["releases_from_partials"] = q["release_aggregates"]
    return q
