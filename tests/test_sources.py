from __future__ import annotations

import hashlib
import json

import duckdb
import pytest
from pyspark.sql import functions as F

from conftest import canonical_rows
from sparrowgrid.functions import canonical, urls
from sparrowgrid.plans.catalogue import ORACLE, QUERIES
from sparrowgrid.sources import channels, documents, exchange, geography, robots, technology

BASE = "https://dealer.example.com/"


def claims(html, media="text/html", base=BASE):
    return documents.claims(html.encode(), media, base)


@pytest.mark.parametrize(("given", "want"), [
    ("HTTPS://Example.COM", "https://example.com/"), ("http://example.com:80/a?b=2&a=1&a=3#/x", "http://example.com/a?b=2&a=1&a=3#/x"), ("https://bücher.example/ü", "https://xn--bcher-kva.example/%C3%BC"),
    ("https://example.com:8080/", None), ("https://user:pw@example.com/", None), ("https://example.com/?access_token=1", None), ("https://example.com/#/r?session=1", None), ("https://10.0.0.1/", None),
    ("ftp://example.com/", None), ("https://localhost/", None), ("https://printer.local/", None), ("https://example.com/%zz", None), ("https://8.8.8.8/", "https://8.8.8.8/"), ("//example.com/x", None), (None, None),
])
def test_normalize(spark, given, want):
    assert urls.try_normalize(given) == want


def test_urls_in_columns(spark):
    df = spark.createDataFrame([("https://A.example.com/b?x=1&y=a%20b&x=2#f",), ("https://a.example.com",), ("nothing",)], "u string")
    p = urls.parts(F.col("u"))
    rows = df.select(urls.normalize_url("u").alias("n"), *[p[k].alias(k) for k in p], urls.query_map(p["query"]).alias("m")).collect()
    assert rows[0].n == "https://a.example.com/b?x=1&y=a%20b&x=2#f" and rows[0].origin == "https://a.example.com" and rows[0].m == {"x": "2", "y": "a b"}
    assert rows[1].path == "/" and rows[1].n == "https://a.example.com/" and rows[2].n is None
    assert df.select(urls.build_query({"q": F.lit("a b"), "n": F.lit(1)}).alias("q")).first().q == "q=a+b&n=1"


@pytest.mark.parametrize(("url", "want"), [
    ("https://x.example.com/a/photo.JPG", "media_or_asset"), ("https://x.example.com/parts/car/1", "parts_surface"), ("https://x.example.com/car/123", "inventory_detail"),
    ("https://x.example.com/#/vehicle/7", "inventory_detail"), ("https://x.example.com/stock", None), ("https://x.example.com/departs/", None), ("https://x.example.com/pi%C3%A8ces/", "parts_surface"),
])
def test_exclusion_in_python_and_natively(spark, url, want):
    assert urls.exclusion(url) == want
    p = urls.parts(F.lit(url))
    assert spark.range(1).select(urls.exclusion_of(p["path"], p["fragment"]).alias("x")).first().x == want


def test_html_links_details_and_labels():
    rows = claims("""<h1>Our stock</h1><a href='/stock'> <b>All</b> cars </a><a href='/stock'>again</a><a href='/car/1'>one</a><a href='/car/2'>two</a>
        <a href='/logo.png'>x</a><a href='/parts'>Parts</a><a href='https://other.example.org/x?token=1'>no</a><script>var a = "<a href='/no'>";</script>""")
    by = {(r["locator"], r["relation"]): r for r in rows}
    assert by[(BASE + "stock", "inventory_surface")]["label"] == "All cars"
    assert by[(BASE, "inventory_surface")]["signals"]["listing_link_count"] == 2
    assert by[(BASE + "parts", "outbound_link")]["signals"]["discovery_fetch_allowed"] is False
    assert len(rows) == 3


def test_html_states_and_parts_pages():
    assert claims("<input type=password><a href='/stock'>stock</a>")[-1]["signals"]["access_state"] == "login_required"
    assert claims("<p>Please solve the CAPTCHA</p>")[0]["signals"]["access_state"] == "restricted"
    assert claims("<p>We are permanently closed</p>")[0]["signals"]["access_state"] == "closed_claim"
    page = claims("<h1>Spare parts</h1><a href='/stock'>stock</a><a href='/all'>complete vehicles</a>")
    assert [r["signals"]["link_context"] for r in page] == ["parts", "discovery"]


def test_json_ld_and_rows():
    node = {"@graph": [{"@type": "AutoDealer", "name": "A", "url": "/a", "address": {"streetAddress": "1 St", "addressCountry": "FR"}}, {"@type": "Car", "url": "/car/9"}, {"@type": "AutoRepair", "name": "R", "url": "/r"}]}
    rows = claims(f"<script type='application/ld+json'>{json.dumps(node)}</script>")
    assert [(r["kind"], r["locator"]) for r in rows] == [("professional_seller", BASE + "a"), ("point_of_sale", BASE + "a"), ("unknown", BASE + "r")]
    lines = '{"url": "https://x.example.com/", "timestamp": "2026", "status": 200, "country": "FR"}\n\n{"tags": {"shop": "car", "name": "N"}, "type": "node", "id": 5, "lat": 1, "lon": 2}'
    rows = claims(lines, "application/x-ndjson")
    assert rows[0]["signals"]["assertion_method"] == "common_crawl_index" and rows[0]["signals"]["claimed_country"] == "FR"
    assert {r["kind"] for r in rows[1:]} == {"professional_seller", "point_of_sale"} and rows[1]["locator"].endswith("openstreetmap.org/node/5")


def test_sitemap_and_refusals():
    xml = "<urlset xmlns='http://www.sitemaps.org/schemas/sitemap/0.9'><url><loc> https://x.example.com/a </loc></url><url><loc>https://x.example.com/b.png</loc></url></urlset>"
    assert [r["locator"] for r in claims(xml, "application/xml")] == ["https://x.example.com/a"]
    for body, media in (("<!DOCTYPE x [<!ENTITY a 'b'>]><urlset/>", "text/xml"), ('{"a": 1, "a": 2}', "application/json"), ("[NaN]", "application/json"), ("x", "image/png"), ("", "text/html"), ("plain words", "text/plain"), ("[" * 40 + "]" * 40, "application/json")):
        with pytest.raises(documents.Unreadable):
            claims(body, media)
    with pytest.raises(documents.OverBounds):
        claims("<p>" * 10_001)


def test_repeated_details_are_bounded():
    items = [{"url": f"/car/{k}"} for k in range(20)]
    row = claims(json.dumps(items), "application/json")[0]
    assert len(row["signals"]["detail_link_hints"]) == 8 and row["signals"]["detail_hints_truncated"] and row["signals"]["detail_links_encountered"] == 20


def test_children_meet_in_cycles():
    rows = claims("<a href='/a'>a</a><a href='/car/1'>d</a><a href='/parts'>p</a><a href='/'>self</a>")
    a, b = (documents.children(rows, "plan", "s", BASE, depth) for depth in (0, 4))
    assert [x["locator"] for x in a] == [BASE + "a"] and a[0]["task_key"] == b[0]["task_key"] and (a[0]["depth"], b[0]["depth"]) == (1, 5)


def test_parse_table(spark):
    rows = [(1, BASE, "text/html", bytearray(b"<a href='/stock'>stock</a>")), (2, BASE, "text/html", bytearray(b"<p>nothing</p>")), (3, BASE, "image/png", bytearray(b"x")), (4, BASE, "text/html", None)]
    out = documents.parse(spark.createDataFrame(rows, "page_id long, origin string, content_type string, body binary")).orderBy("page_id").collect()
    assert [(r.page_id, r.error, r.locator) for r in out] == [(1, None, BASE + "stock"), (2, None, None), (3, "content_type", None), (4, "empty_document", None)]


def test_technology():
    html = "<html><head><meta name=generator content='WordPress 6.5'><script src='/wp-content/plugins/car-list/x.js'></script></head><body><a href='/fahrzeugbestand'>x</a><iframe src='https://my.dealerwebs.com/embed'></iframe></body></html>"
    r = technology.classify(html.encode(), "text/html", BASE)
    assert {(d["category"], d["name"], d["confidence"]) for d in r["detections"]} == {("cms", "WordPress", "strong_signal"), ("plugin", "wordpress-plugin:car-list", "tentative"), ("inventory_provider", "DealerWebs", "tentative")}
    assert [s["rule"] for s in r["inventory_surfaces"]] == ["observed_inventory_path", "provider_embed_content_unverified"]
    shell = technology.classify(b"<div id=__next></div><script src='/_next/static/a.js'></script>", "text/html", BASE)
    assert shell["dynamic_rendering_required"] is True
    both = technology.classify(b"<meta name=generator content='Drupal 10'>", "text/html", BASE, {"X-Generator": "Joomla! 5"})
    assert both["conflicts"] and {d["confidence"] for d in both["detections"]} == {"tentative"}
    assert technology.classify(b"<p>", "text/plain", BASE)["status"] == "unknown"
    assert technology.classify(b"<a href='https://dealerwebs.com.evil.example/x'>x</a>", "text/html", BASE)["detections"] == []
    assert technology.classify(b"<p>" * 10_001, "text/html", BASE)["status"] == "partial"


def binding(adapter, **parameters):
    end = {"rdw_socrata": channels.RDW_ENDPOINT, "sirene_csv": "https://data.example.org/slice"}.get(adapter, "https://api.example.org/q")
    return {"adapter": adapter, "endpoint": end, "assessment_ref": "a", "countries": ["FR"], "vehicle_classes": ["car"], "parameters": parameters, "max_pages": 2}


def test_bindings_are_strict():
    b = binding("overpass_json", bbox=[1, 1, 2, 2])
    assert channels.validate_binding(b | {"countries": ["FR", "DE", "FR"]}) == b | {"countries": ["DE", "FR"], "parameters": {
        "bbox": [1, 1, 2, 2], "tags": [{"key": "shop", "value": v} for v in ("car", "car_repair", "caravan", "motorcycle")], "row_limit": 500, "timeout_seconds": 25}}
    assert channels.validate_binding(binding("rdw_socrata"))["parameters"] == {"page_size": 100}
    registry = {"activity_codes": ["45.11Z"], "nomenclature": "NAF2025", "snapshot_date": "2026-01-01"}
    wrong = [
        b | {"max_pages": 5000}, b | {"max_pages": True}, b | {"countries": []}, b | {"countries": ["fr"]}, b | {"vehicle_classes": ["boat"]}, b | {"endpoint": "http://api.example.org/q"}, b | {"endpoint": "https://api.example.org/q?x=1"}, b | {"more": 1},
        binding("searxng_json", format="html"), binding("searxng_json", anything="x"), binding("searxng_json", language="d e"), binding("overpass_json", timeout_seconds=61), binding("overpass_json", tags=[{"key": "shop", "value": "bakery"}]),
        binding("overpass_json", tags=[]), binding("overpass_json", bbox=[0, 0, 3, 1]), binding("overpass_json", bbox=[0, 0, float("nan"), 1]), binding("overpass_json", bbox="0,0,1,1"), binding("rdw_socrata", page_size=2001), binding("rdw_socrata") | {"endpoint": "https://data.example.org/rows.json"},
        binding("sirene_csv", **registry | {"nomenclature": "other"}), binding("sirene_csv", **registry | {"activity_codes": ["4511Z"]}), binding("sirene_csv", **registry | {"snapshot_date": "2026-02-30"}), binding("sirene_csv", activity_codes=["45.11Z"]), None,
    ]
    for x in wrong:
        with pytest.raises(channels.Refused):
            channels.validate_binding(x)
    assert "format=json" in channels.request_url(binding("searxng_json", language="de"), {"query": "cars"}) and "language=de" in channels.request_url(binding("searxng_json", language="de"), {"query": "cars"})


def test_search_channel():
    b = binding("searxng_json")
    body = {"results": [{"url": "https://A.example.com", "title": "T"}, {"url": "https://a.example.com/", "title": "U"}, {"url": "https://a.example.com/?token=1"}]}
    out = channels.response(b, json.dumps(body).encode(), "application/json", channels.request_url(b, {"query": "cars"}, "2"))
    assert [r["locator"] for r in out["rows"]] == ["https://a.example.com/"] and out["complete"] is None and out["continuation"] == "3"
    assert out["warnings"] == ["duplicate_source_locator", "page_budget_reached", "unsafe_or_invalid_locator"]
    empty = channels.response(b, b'{"results": []}', "application/json", b["endpoint"])
    assert empty["continuation"] is None and empty["warnings"] == ["empty_search_page_is_not_absence"]


def test_map_channel():
    b = binding("overpass_json", bbox=[1, 1, 2, 2], tags=[{"key": "shop", "value": "car"}], row_limit=2, timeout_seconds=20)
    body = {"osm3s": {"timestamp_osm_base": "2026-01-01T00:00:00Z"}, "elements": [{"type": "node", "id": 1, "lat": 1.5, "lon": 1.5, "tags": {"shop": "car", "website": "https://w.example.com"}}]}
    origin = channels.request_url(b, {})
    out = channels.response(b, json.dumps(body).encode(), "application/json", origin)
    assert out["complete"] is True and out["rows"][0]["kind"] == "professional_seller" and out["rows"][0]["locator"] == "https://w.example.com/"
    loose = channels.response(b, json.dumps(body).encode(), "application/json", b["endpoint"])
    assert loose["complete"] is None and loose["warnings"] == ["request_parameters_unverified"]
    body["elements"] *= 2
    with pytest.raises(channels.Refused):
        channels.response(b, json.dumps(body).encode(), "application/json", origin)


def test_keyset_channel():
    b = binding("rdw_socrata", page_size=2)
    rows = [{"volgnummer": "5", "naam_bedrijf": "A", "plaats": "P"}, {"volgnummer": "9", "naam_bedrijf": "B"}]
    out = channels.response(b, json.dumps(rows).encode(), "application/json", channels.request_url(b, {}, "4"))
    assert (out["continuation"], out["complete"]) == ("9", False) and out["rows"][0]["locator"].endswith("#rdw=5")
    last = channels.response(b, json.dumps(rows[:1]).encode(), "application/json", channels.request_url(b, {}, "4"))
    assert (last["continuation"], last["complete"]) == (None, True)
    with pytest.raises(channels.Refused):
        channels.response(b, json.dumps(rows).encode(), "application/json", channels.request_url(b, {}, "5"))


def test_registry_channel():
    b = binding("sirene_csv", activity_codes=["45.11Z"], nomenclature="NAFRev2", snapshot_date="2026-01-01")
    head = "siret,statutDiffusionEtablissement,etatAdministratifEtablissement,activitePrincipaleEtablissement,nomenclatureActivitePrincipaleEtablissement"
    text = head + "\n12345678901234,O,A,45.11Z,NAFRev2\n12345678901235,P,A,45.11Z,NAFRev2\n12345678901236,O,A,01.11Z,NAFRev2\n"
    out = channels.response(b, text.encode(), "text/csv", b["endpoint"])
    assert len(out["rows"]) == 1 and out["complete"] is True and out["warnings"] == ["local_slice_not_national_census", "outside_activity_scope_omitted", "restricted_diffusion_omitted"]


@pytest.mark.parametrize("name", ["keyset_responses", "map_responses", "registry_responses"])
def test_responses_beyond_one_request(spark, tmp_path, name):
    # By nation: more than a request holds, just as many, just fewer, several full requests; numbers that padding makes equal (3 and 1113), names with commas and quotes.
    nations = [0] * 2400 + [1] * 2001 + [2] * 2000 + [3] * 1999 + [4] * 4000 + [5] * 4000
    spark.createDataFrame([(n, f'Supplier "{n}", Ltd', nation, 0.0) for n, nation in enumerate(nations)], "s_suppkey long, s_name string, s_nationkey int, s_acctbal double").write.parquet(str(tmp_path / "supplier.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW supplier AS SELECT * FROM read_parquet('{tmp_path}/supplier.parquet/*.parquet')")
    ours, theirs = QUERIES[name](spark, str(tmp_path)).toPandas(), con.execute(ORACLE[name]).df()
    assert len(ours) == len(theirs) and canonical_rows(ours) == canonical_rows(theirs)


def test_refused_response_is_no_row(spark, tmp_path):
    # A name with a control character is refused by every channel.
    spark.createDataFrame([(3, "a", 0, 0.0), (6, "a\x01b", 0, 0.0)], "s_suppkey long, s_name string, s_nationkey int, s_acctbal double").write.parquet(str(tmp_path / "supplier.parquet"))
    for name in ["keyset_responses", "map_responses", "registry_responses"]:
        with pytest.raises(Exception, match="response 0 of 0: text"):
            QUERIES[name](spark, str(tmp_path)).toPandas()


def test_inflated_bodies_some_at_a_time():
    import pyarrow as pa

    from sparrowgrid.plans import records

    html = [f"<p>é{k}" * (20_000 if k % 3 else 1) for k in range(100)] + [""]
    given = pa.RecordBatch.from_arrays([pa.array(range(101), pa.int64()), pa.array(html)], ["page_id", "html"])
    out = [*records._inflated([given, given.slice(90)])]
    assert [x for b in out for x in b.column(1).to_pylist()] == html + html[90:] and [x for b in out for x in b.column(0).to_pylist()] == [*range(101), *range(90, 101)]
    assert all(x for b in out for x in b.column(2).to_pylist()) and max(b.column(1).nbytes for b in out) < records.INFLATED + 200_000


def test_robots():
    text = "User-agent: *\nDisallow: /a\nAllow: /a/b\nCrawl-delay: 3\n\nUser-agent: ourbot\nDisallow: /*.pdf$\nAllow: /x\nDisallow: /x"
    assert [robots.allowed(text, "other/1", "https://e.example.com" + p) for p in ("/a/c", "/a/b/c", "/z")] == [False, True, True]
    assert [robots.allowed(text, "OurBot/2", "https://e.example.com" + p) for p in ("/a/c", "/f.pdf", "/f.pdf?x", "/x")] == [True, False, True, True]
    assert robots.rules_for(text, "other")[1] == 3.0


def test_robots_rules():
    say = lambda text, path, agent="ourbot/1": robots.allowed(text, agent, "https://e.example.com" + path)
    # The most specific agent, its groups together; an agent line without a name says nothing.
    both = "User-agent: our\nDisallow: /\nUser-agent: ourbot\nAllow: /stock\nDisallow: /private\nUser-agent: *\nDisallow: /"
    assert say(both, "/x") and not say(both, "/private") and not say(both, "/x", "other")
    assert not say("User-agent:\nAllow: /\nUser-agent: *\nDisallow: /\n", "/x")
    # Octets: encoded stars, dollars and slashes are no syntax; unreserved ones are the same either way.
    rules = "User-agent: *\nDisallow: /a%2Ab\nDisallow: /c%2Fd\nDisallow: /%70rivate\nDisallow: /e$\nDisallow: /q?x=1\nDisallow: /caf%C3%A9"
    assert [say(rules, p) for p in ("/azzzb", "/a*b", "/c/d", "/c%2fd", "/private", "/e", "/e/f", "/q", "/q?x=12", "/caf\u00e9")] == [True, False, True, False, False, False, True, True, False, False]
    # The longest rule by what it holds besides wildcards.
    assert say("User-agent: *\nDisallow: /*****\nAllow: /ab", "/ab") and not say("User-agent: *\nDisallow: /a*c$", "/abcbc") and say("User-agent: *\nDisallow: /a*c$", "/abcd")
    assert not say("User-agent: *\nDisallow: " + "/a" + "*a" * 40 + "b", "/" + "a" * 60 + "b")
    assert say("User-agent: *\nDisallow: " + "/a" + "*a" * 400 + "b", "/" + "a" * 3000)
    for bad in (b"<!DOCTYPE html><p>", b"<html>", b"a\0b", b"\xff\xfe", b"garbage", b"User-agent: *\nCrawl-delay: 99", b"User-agent: *\nCrawl-delay: soon", b"\n" * 10_002, b"User-agent: *\n" + b"Disallow: /a\n" * 5001):
        with pytest.raises(robots.Refused):
            robots.allowed(bad, "x", "https://e.example.com/x")
    assert say("# only a comment", "/x") and say("", "/x")


def test_robots_table(spark):
    rows = [("https://e.example.com/a", b"User-agent: *\nDisallow: /a"), ("https://e.example.com/b", b"User-agent: *\nDisallow: /a"), ("https://e.example.com/c", b"<html>"), ("https://e.example.com/d", None), (None, None)]
    out = robots.decide(spark.createDataFrame(rows, "url string, robots binary"), "ourbot/1").collect()
    assert [(r.allowed, r.refused) for r in out] == [(False, None), (True, None), (False, "not a rules document"), (True, None), (False, None)]


def test_geography(spark):
    body = json.dumps([{"code": "01", "name": "Saint-É", "aliases": ["St É"]}, {"code": "02", "name": "Twin", "parent_code": "R1"}, {"code": "03", "name": "TWIN "}, {"code": "R1", "name": "Region", "level": "region"}]).encode()
    meta = {"country": "FR", "version": "1", "source_url": "https://x.example.com/", "observed_at": "2026-01-01T00:00:00Z", "body_sha256": hashlib.sha256(body).hexdigest()}
    catalogue = geography.load(body, meta)
    assert geography.revalidate(catalogue) == catalogue and [u["code"] for u in catalogue["units"]] == ["01", "02", "03", "R1"]
    units = spark.createDataFrame([{"code": u["code"], "name": u["name"], "region": None, "rural": None, "aliases": u["aliases"], "parent_code": u.get("parent_code"), "level": u["level"]} for u in catalogue["units"]], geography.UNITS_SCHEMA)
    index = geography.name_index(units, canonical.name_key)
    asked = spark.createDataFrame([("saint-É",), ("ST  É",), ("twin",), ("none",)], "q string")
    out = {r.q: (r.status, r.code, r.method, r.candidates) for r in geography.resolve(asked, index, canonical.name_key(F.col("q"))).collect()}
    assert out["saint-É"] == ("matched", "01", "exact_name", ["01"]) and out["ST  É"][2] == "exact_alias" and out["twin"] == ("ambiguous", None, "exact_names_and_aliases", ["02", "03"]) and out["none"][0] == "unknown"
    assert geography.localities(units).count() == 3
    for bad in ([{"code": "1", "name": "a"}, {"code": "1", "name": "b"}], [{"code": "1", "name": "a", "parent_code": "2"}], [{"code": "1", "name": "a", "parent_code": "1"}], [{"code": "", "name": "a"}]):
        raw = json.dumps(bad).encode()
        with pytest.raises(ValueError):
            geography.load(raw, meta | {"body_sha256": hashlib.sha256(raw).hexdigest()})
    csv = "Insee;Nom\n2A004;Ajaccio\n".encode()
    assert geography.load(csv, meta | {"body_sha256": hashlib.sha256(csv).hexdigest(), "delimiter": ";", "field_map": {"code": "Insee", "name": "Nom"}}, "csv")["units"][0]["code"] == "2A004"


def test_canonical(spark):
    assert canonical.canonical_json({"b": 1, "a": "é"}) == '{"a":"é","b":1}'
    df = spark.createDataFrame([('{"b": [1, null], "a": "é"}',), ('{"a": 1, "a": 2}',), ("[NaN]",), (None,)], "j string")
    assert [r.x for r in df.select(canonical.canonical("j").alias("x")).collect()] == ['{"a":"é","b":[1,null]}', None, None, None]
    key = spark.range(1).select(canonical.candidate_key(F.lit('https://x.example.com/"'), F.lit("source")).alias("k")).first().k
    assert key == canonical.digest(['https://x.example.com/"', "source"])
    at = spark.sql("SELECT timestamp'2026-01-02 03:04:05' a, timestamp'2026-01-02 03:04:05.120' b").select(canonical.utc_text(F.col("a")).alias("a"), canonical.utc_text(F.col("b")).alias("b")).first()
    assert (at.a, at.b) == ("2026-01-02T03:04:05Z", "2026-01-02T03:04:05.120000Z")
    n = spark.createDataFrame([("18446744073709551615",), ("18446744073709551616",), ("01",), ("0",)], "n string").select(canonical.uint64(F.col("n")).alias("n")).collect()
    assert [None if r.n is None else int(r.n) for r in n] == [2**64 - 1, None, None, 0]
    d = spark.createDataFrame([("2024-02-29",), ("2023-02-29",), ("2024-2-1",)], "d string").select(canonical.strict_date(F.col("d")).alias("d")).collect()
    assert [str(r.d) for r in d] == ["2024-02-29", "None", "None"]
    assert canonical.uuid7()[14] == "7" and canonical.uuid7() != canonical.uuid7()


def test_cursor_and_content():
    import gzip

    old, new = canonical.Cursors({"a": b"k"}, "a"), canonical.Cursors({"a": b"k", "b": b"l"}, "b")
    here = {"tenant": "a", "scope": "dealer:car", "snapshot": "s1"}
    token = old.issue(here, {"after": "item-é", "n": 3}, 900)
    assert old.open(token, here, 899.5) == new.open(token, here, 100) == {"after": "item-é", "n": 3}
    others = [here | {"tenant": "b"}, here | {"scope": "dealer:lcv"}, here | {"snapshot": "s2"}, {}]
    longer = token.replace(".900.", ".901.")
    for given, context, now in [(token, here, 900), (token, here, 901), (longer, here, 1), ("x" + token, here, 1), ("", here, 1), (None, here, 1), (token[:-1], here, 1), (new.issue(here, 1, 900) + "0", here, 1), *[(token, o, 1) for o in others]]:
        with pytest.raises(ValueError):
            new.open(given, context, now)
    with pytest.raises(ValueError):
        old.open(new.issue(here, 1, 900), here, 1)
    body = gzip.compress(b"x" * 1000)
    assert canonical.inflate(body, "gzip", 1000) == b"x" * 1000
    for bad, most in ((body, 999), (body[:-4], 1000), (b"no", 10)):
        with pytest.raises(ValueError):
            canonical.inflate(bad, "gzip", most)


def test_import_and_export(spark, tmp_path):
    row = {"locator": BASE, "kind": "source", "method": "m", "method_version": "1", "origin_locator": BASE, "evidence_group": "g", "observed_at": "2026-01-01T00:00:00Z", "expires_at": "2026-02-01T00:00:00Z", "policy_ref": "p", "countries": ["FR"], "classes": ["car", "car"], "source_type": "dealer_owned", "locality_code": "", "locality_country": "", "signals": "{}"}
    (tmp_path / "a.jsonl").write_text("\n".join(json.dumps(r) for r in (row, row | {"expires_at": "2025-01-01T00:00:00Z"}, row | {"countries": ["fr"]}, row | {"kind": "x"})))
    valid, wrong = exchange.read_observations(spark, str(tmp_path / "a.jsonl"))
    assert valid.first().classes == ["car"] and {r.fault for r in wrong.collect()} == {"expiry_must_follow_observation", "country_shape", "unknown_kind_or_source_type"}
    (tmp_path / "b.jsonl").write_text("{broken")
    with pytest.raises(Exception):  # noqa: B017
        exchange.read_observations(spark, str(tmp_path / "b.jsonl"))[0].count()
    records = spark.range(10_000).select("id", F.concat(F.lit("r"), F.col("id").cast("string")).alias("record"))
    digests = [hashlib.sha256(f"r{k}".encode()).hexdigest() for k in range(10_000)]
    foot = exchange.footer(records, "id", "record").first()
    runs = [hashlib.sha256("".join(digests[k : k + 4096]).encode()).hexdigest() for k in range(0, 10_000, 4096)]
    assert (foot.records, foot.sha256) == (10_000, hashlib.sha256("".join(runs).encode()).hexdigest())
    exchange.write_bulk(records, "id", 3, str(tmp_path / "bulk"))
    assert spark.read.json(str(tmp_path / "bulk")).count() == 10_000
