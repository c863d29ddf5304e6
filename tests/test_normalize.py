from datetime import date, datetime

from pyspark.sql import functions as F

from perfwatch.functions import canonical_route, clean_route, url_path
from perfwatch.operators.normalize import (
    normalize_devices,
    normalize_field_metrics,
    normalize_lab,
    normalize_page_loads,
    standardize_device_type,
    standardize_route,
)


def _routes(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, route string")
    return [r.route for r in standardize_route(df).orderBy("i").collect()]


def test_route_aliases_case_query_and_trailing_slash(spark):
    cases = [("/index", "/"), ("/PDP?utm=mail", "/product"), ("/account/", "/account"),
             ("/Cart#items", "/checkout"), ("profile", "/account"), ("/Docs/Guide/", "/docs/guide"),
             ("  /signin  ", "/account")]
    assert _routes(spark, [c for c, _ in cases]) == [e for _, e in cases]


def test_route_root_and_edge_spellings(spark):
    cases = [("/", "/"), ("", "/"), ("?a=1", "/"), ("//", "/"), ("/a//", "/a/"),
             ("https://x.com/y?z", "/https://x.com/y"), ("\t/tab", "/\t/tab"), (None, None),
             ("/homepage/", "/")]
    assert _routes(spark, [c for c, _ in cases]) == [e for _, e in cases]


def test_device_type_aliases_and_unknown(spark):
    raw = ["Smartphone", " LAPTOP ", "iPad", "tablet", "handset", "tv", None, "Desktop"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(raw)], "i int, device_type string")
    got = [r.device_type for r in standardize_device_type(df).orderBy("i").collect()]
    assert got == ["mobile", "desktop", "tablet", "tablet", "mobile", "unknown", "unknown", "desktop"]


def test_url_path_then_route(spark):
    df = spark.createDataFrame([("https://m.shop.example.org/Basket/?x=1",), ("/plain/",), ("http://h",)], ["url"])
    got = [r.r for r in df.select(canonical_route(url_path("url")).alias("r")).collect()]
    assert got == ["/checkout", "/plain", "/"]


def test_clean_route_keeps_expression_linear(spark):
    # the cleaner must not duplicate its input sub-tree (plan size guard)
    assert str(clean_route(F.col("route"))).count("regexp_extract") == 1


def test_normalize_lab_production_only_and_types(spark):
    df = spark.createDataFrame(
        [("r1", "2026-03-02T23:30:00+00:00", "/Home", "phone", "production", "v9", 1700.0),
         ("r2", "2026-03-02T23:35:00+00:00", "/home", "phone", "staging", "v9", 1700.0),
         ("r3", "not a time", "/x", "pc", "production", "v9", 1.0),
         ("r4", "2026-03-03T01:00:00-05:00", "/x", "pc", "Production", "v9", 1.0),
         ("r5", "2026-03-03T01:00:00-05:00", "/x", "pc", None, "v9", 1.0)],
        "report_id string, run_timestamp string, route string, device_type string, environment string, "
        "release_version string, lcp_ms double")
    rows = {r.report_id: r for r in normalize_lab(df).collect()}
    assert set(rows) == {"r1", "r3"}
    assert rows["r1"].route == "/" and rows["r1"].device_type == "mobile"
    assert isinstance(rows["r1"].run_timestamp, datetime)
    assert rows["r1"].report_date == date(2026, 3, 2)
    assert rows["r3"].run_timestamp is None and rows["r3"].report_date is None


def test_normalize_page_loads_adds_event_date_in_utc(spark):
    df = spark.createDataFrame([("e1", "2026-03-03T01:00:00-05:00", "/a", "PC")],
                               "event_id string, timestamp string, route string, device_type string")
    row = normalize_page_loads(df).first()
    assert row.event_date == date(2026, 3, 3) and row.device_type == "desktop"


def test_normalize_field_metrics_parses_date(spark):
    df = spark.createDataFrame([("2026-03-04", "/Cart", "Phone"), ("garbage", "/", "pc")],
                               "date string, route string, device_type string")
    rows = normalize_field_metrics(df).orderBy("route").collect()
    assert rows[0].date is None and rows[1].date == date(2026, 3, 4) and rows[1].route == "/checkout"


def test_normalize_devices_one_row_per_id_deterministic(spark):
    rows = [("d1", "mid-range", "B", "4G"), ("d1", "low-end", "Z", "3G"), ("d1", "low-end", "A", "5G"),
            ("d2", "high-end", "Q", "wifi")]
    df = spark.createDataFrame(rows, "device_id string, device_class string, device_name string, "
                                     "network_profile string")
    for parts in (1, 3):
        got = {r.device_id: tuple(r) for r in normalize_devices(df.repartition(parts)).collect()}
        assert got == {"d1": ("d1", "low-end", "A", "5G"), "d2": ("d2", "high-end", "Q", "wifi")}


def _route_rule(s):
    """The cleaning rule stated step by step in plain Python."""
    if s is None:
        return None
    import re
    p = re.match(r"^([^?#]*)", s).group(1).strip(" ").lower()
    if not p.startswith("/"):
        p = "/" + p
    if len(p) > 1 and p.endswith("/"):
        p = p[:-1]
    return p


def test_clean_route_matches_stepwise_rule_on_random_text(spark):
    from hypothesis import given, settings
    from hypothesis import strategies as st

    alphabet = st.sampled_from(list("/ ?#aZ.-_\t\n") + ["é"])
    samples = []

    @settings(max_examples=400, database=None, derandomize=True)
    @given(st.text(alphabet, max_size=12))
    def collect(s):
        samples.append(s)

    collect()
    df = spark.createDataFrame([(i, s) for i, s in enumerate(samples)], "i int, r string")
    got = {row.i: row.c for row in df.select("i", clean_route("r").alias("c")).collect()}
    bad = [(s, got[i], _route_rule(s)) for i, s in enumerate(samples) if got[i] != _route_rule(s)]
    assert not bad, bad[:5]
