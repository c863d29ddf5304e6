"""Thresholds, metric specs, regression rules and alias tables.

Everything here is a plain frozen dataclass or tuple so it can be passed as a
function argument; nothing reads the environment.  The numeric defaults and
the alias tables are fixed values: they define the results and must stay as
listed.
"""
from __future__ import annotations

from dataclasses import dataclass

# --- fixed values -----------------------------------------------------------
# "Good" limits per metric (ms for time metrics, unitless for CLS).
LCP_GOOD_MS = 2500.0
CLS_GOOD = 0.1
INP_GOOD_MS = 200.0
TTFB_GOOD_MS = 800.0

# A metric counts as "poor" for risk classification above good x 1.6.
POOR_STRETCH = 1.6

# Health score weights and the sample count at which a score is fully trusted.
HEALTH_WEIGHTS = {"lcp": 0.35, "cls": 0.20, "inp": 0.30, "ttfb": 0.15}
MIN_CONFIDENT_SAMPLES = 30

# Device types kept by the quality gate.
VALID_DEVICE_TYPES = ("mobile", "desktop", "tablet")

# Route spellings mapped onto the canonical route, after cleaning.
ROUTE_ALIASES = (
    ("/home", "/"),
    ("/index", "/"),
    ("/homepage", "/"),
    ("/products", "/product"),
    ("/pdp", "/product"),
    ("/cart", "/checkout"),
    ("/basket", "/checkout"),
    ("/signin", "/account"),
    ("/login", "/account"),
    ("/profile", "/account"),
)

# Device type spellings mapped onto mobile / desktop / tablet, after lower+trim.
DEVICE_TYPE_ALIASES = (
    ("phone", "mobile"),
    ("smartphone", "mobile"),
    ("handset", "mobile"),
    ("pc", "desktop"),
    ("laptop", "desktop"),
    ("ipad", "tablet"),
)

# Severity cut-offs on the excess ratio (highest first); below the last: low.
SEVERITY_LEVELS = (("critical", 2.0), ("high", 1.5), ("medium", 1.2))
SEVERITY_RANK = (("critical", 4), ("high", 3), ("medium", 2), ("low", 1))

# Improvement legs of the before/after status.
IMPROVED_PCT = -10.0
IMPROVED_CLS_DELTA = -0.02

# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class MetricSpec:
    """One web-vital metric: raw column, output stem, good limit, rounding."""

    key: str        # short key: lcp, cls, inp, ttfb
    column: str     # raw event column
    stem: str       # stem used in output names (lcp_ms -> p75_lcp_ms)
    good: float     # "good" upper limit (inclusive)
    scale: int      # decimal places kept in rollups


LCP = MetricSpec("lcp", "lcp_ms", "lcp_ms", LCP_GOOD_MS, 1)
CLS = MetricSpec("cls", "cls", "cls", CLS_GOOD, 4)
INP = MetricSpec("inp", "inp_ms", "inp_ms", INP_GOOD_MS, 1)
TTFB = MetricSpec("ttfb", "ttfb_ms", "ttfb_ms", TTFB_GOOD_MS, 1)
METRICS = (LCP, CLS, INP, TTFB)


@dataclass(frozen=True)
class RegressionRule:
    """Regression rule for one metric.

    mode ``pct``: flagged when delta_percent > limit * 100;
    mode ``delta``: flagged when the absolute delta > limit.
    Either way also flagged when the metric newly crosses ``poor``.
    """

    metric: str     # label written to regression events (LCP, CLS, ...)
    spec: MetricSpec
    mode: str       # "pct" or "delta"
    limit: float
    poor: float


@dataclass(frozen=True)
class RegressionThresholds:
    lcp_regression_pct: float = 0.20
    lcp_poor_ms: float = 2500.0
    cls_regression_delta: float = 0.05
    cls_poor: float = 0.1
    inp_regression_pct: float = 0.20
    inp_poor_ms: float = 200.0
    ttfb_regression_pct: float = 0.25
    ttfb_poor_ms: float = 800.0

    def rules(self) -> tuple[RegressionRule, ...]:
        return (
            RegressionRule("LCP", LCP, "pct", self.lcp_regression_pct, self.lcp_poor_ms),
            RegressionRule("CLS", CLS, "delta", self.cls_regression_delta, self.cls_poor),
            RegressionRule("INP", INP, "pct", self.inp_regression_pct, self.inp_poor_ms),
            RegressionRule("TTFB", TTFB, "pct", self.ttfb_regression_pct, self.ttfb_poor_ms),
        )


DEFAULT_THRESHOLDS = RegressionThresholds()


@dataclass(frozen=True)
class Advice:
    cause: str
    action: str


# Probable cause and suggested action attached to each regression event, after
# the public guidance on these metrics at web.dev.
ADVICE = {
    "LCP": Advice(
        "One of the four parts of LCP grew: time to first byte, the delay before the LCP resource starts "
        "to load, its load time, or the delay until it is drawn.",
        "Break LCP down in a trace and treat the longest part: make the LCP resource discoverable in the "
        "HTML with fetchpriority=high and without lazy loading, serve it in a modern format, inline "
        "critical CSS.",
    ),
    "CLS": Advice(
        "A layout shift window scored higher: something was inserted above visible content, or changed "
        "size, without a user action in the half second before.",
        "List the layout-shift entries with their source elements; set width and height or aspect-ratio, "
        "give late slots a min-height, animate with transform only.",
    ),
    "INP": Advice(
        "The slowest interactions got slower in one of three phases: input delay, event handlers, or "
        "the next paint (large DOM, forced layout).",
        "Attribute INP to its element and phase; yield with scheduler.yield() inside handlers, cut "
        "third-party scripts at load, shrink the DOM that an interaction restyles.",
    ),
    "TTFB": Advice(
        "Redirects, connection set-up or the time to produce the document grew before any byte arrived.",
        "Compare Server-Timing with the navigation phases; drop redirects, cache HTML at the edge or use "
        "stale-while-revalidate, stream the head early, keep connections with HTTP/3.",
    ),
}


@dataclass(frozen=True)
class QualitySpec:
    """Per-table settings of the quality gate."""

    table: str
    required: tuple[str, ...]
    non_negative: tuple[str, ...] = ()
    check_route: bool = True
    check_device_type: bool = True
    check_sample_count: bool = False


LAB_QUALITY = QualitySpec(
    "lab_reports",
    ("report_id", "run_timestamp", "route", "device_type", "release_version",
     "lcp_ms", "cls", "inp_ms", "ttfb_ms"),
    ("lcp_ms", "cls", "inp_ms", "ttfb_ms", "fcp_ms", "speed_index_ms",
     "total_blocking_time_ms", "request_count"),
)
FIELD_QUALITY = QualitySpec(
    "field_metrics",
    ("date", "route", "device_type", "p75_lcp_ms", "p75_cls", "p75_inp_ms", "sample_count"),
    ("p75_lcp_ms", "p75_cls", "p75_inp_ms", "sample_count"),
    check_sample_count=True,
)
PAGE_LOAD_QUALITY = QualitySpec(
    "page_loads",
    ("event_id", "timestamp", "route", "device_type", "lcp_ms", "cls", "inp_ms",
     "ttfb_ms", "release_version"),
    ("lcp_ms", "cls", "inp_ms", "ttfb_ms", "fcp_ms", "page_weight_kb", "js_error_count"),
)
DEVICE_QUALITY = QualitySpec(
    "devices", ("device_id", "device_class"), (), check_route=False, check_device_type=False,
)
