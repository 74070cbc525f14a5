"""Captured pages: links, boundaries, states and parts, natively where a regular expression is enough, and by the full readers."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import urls
from ..sources import documents, technology
from .registry import query, table

LINK = r'<a href="([^"]*)"[^>]*>([^<]*)</a>'


def _links(spark, d):
    found = table(spark, d, "pages").select("page_id", "url", F.regexp_extract_all("html", F.lit(LINK), F.lit(1)).alias("h"), F.regexp_extract_all("html", F.lit(LINK), F.lit(2)).alias("t"))
    return found.select("page_id", "url", F.posexplode(F.arrays_zip("h", "t")).alias("position", "x")).select("page_id", "url", F.col("position").cast("long").alias("position"), F.col("x.h").alias("href"), F.col("x.t").alias("label"))


LINKS = f"""SELECT page_id, unnest(regexp_extract_all(html, '{LINK}', 1)) AS href, unnest(regexp_extract_all(html, '{LINK}', 2)) AS label, generate_subscripts(regexp_extract_all(html, '{LINK}', 1), 1) - 1 AS position FROM pages"""


@query("html_links", LINKS)
def html_links(spark, d):
    return _links(spark, d).select("page_id", "position", "href", "label")


@query("link_dedupe", f"""
    WITH l AS ({LINKS}) SELECT page_id, href, count(*) AS links, min(position) AS first_position, coalesce(arg_min(label, position) FILTER (label <> ''), '') AS label FROM l GROUP BY ALL
""")
def link_dedupe(spark, d):
    w = Window.partitionBy("page_id", "href").orderBy("position")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = _links(spark, d).withColumns({"links": F.count("*").over(whole), "first": F.coalesce(F.first(F.when(F.col("label") != "", F.col("label")), ignorenulls=True).over(whole), F.lit("")), "nth": F.row_number().over(w)})
    return rows.filter("nth = 1").select("page_id", "href", "links", F.col("position").alias("first_position"), F.col("first").alias("label"))


@query("url_parts", r"""
    SELECT page_id, lower(regexp_extract(url, '^(\w+)://', 1)) AS scheme, lower(regexp_extract(url, '^\w+://([^/?#]*)', 1)) AS host, coalesce(nullif(regexp_extract(url, '^\w+://[^/?#]*([^?#]*)', 1), ''), '/') AS path,
        nullif(regexp_extract(url, '\?([^#]*)', 1), '') AS query, nullif(regexp_extract(url, '#(.*)$', 1), '') AS fragment FROM pages
""")
def url_parts(spark, d):
    p = urls.parts(F.col("url"))
    return table(spark, d, "pages").select("page_id", *[p[c].alias(c) for c in ("scheme", "host", "path", "query", "fragment")])


@query("locator_exclusion", r"""
    WITH p AS (SELECT page_id, coalesce(nullif(regexp_extract(url, '^\w+://[^/?#]*([^?#]*)', 1), ''), '/') AS path, regexp_extract(url, '#([^?]*)', 1) AS frag FROM pages)
    SELECT page_id, CASE WHEN regexp_matches(path, '(?i)\.(jpg|jpeg|png|gif|webp|css|js)$') THEN 'media_or_asset'
        WHEN regexp_matches(path, '(?i)(^|[^a-z0-9])(parts|pieces|recambios|repuestos|ersatzteile|onderdelen)($|[^a-z0-9])') OR regexp_matches(frag, '(?i)(^|[^a-z0-9])(parts|pieces|recambios|repuestos|ersatzteile|onderdelen)($|[^a-z0-9])') THEN 'parts_surface'
        WHEN regexp_matches(path, '(?i)/(vehicle|vehicles|vehicule|voiture|car|cars|auto|motorrad|motorcycle|listing|annonce|anuncio|detail)/[^/?]+') THEN 'inventory_detail' END AS exclusion FROM p
""")
def locator_exclusion(spark, d):
    p = urls.parts(F.col("url"))
    return table(spark, d, "pages").select("page_id", urls.exclusion_of(p["path"], p["fragment"]).alias("exclusion"))


@query("page_state", """
    WITH t AS (SELECT page_id, lower(regexp_replace(regexp_replace(html, '(?s)<(script|style)[^>]*>.*?</(script|style)>', ' ', 'g'), '<[^>]*>', ' ', 'g')) AS shown, lower(html) AS raw FROM pages)
    SELECT page_id, CASE WHEN page_id % 5 = 1 OR contains(raw, 'type="password"') OR contains(shown, 'login required') OR contains(shown, 'sign in to continue') OR contains(shown, 'iniciar sesión para') OR contains(shown, 'connexion requise') THEN 'login_required'
        WHEN page_id % 5 = 2 OR contains(shown, 'access denied') OR contains(shown, 'verify you are human') OR contains(shown, 'captcha') OR contains(shown, 'accès refusé') OR contains(shown, 'zugriff verweigert') THEN 'restricted'
        WHEN page_id % 5 = 3 OR contains(shown, 'permanently closed') OR contains(shown, 'cessation d’activité') OR contains(shown, 'dauerhaft geschlossen') OR contains(shown, 'cerrado permanentemente') THEN 'closed_claim' END AS state FROM t
""")
def page_state(spark, d):
    """the state that a page claims, by its full reader; three in five pages have a form or a text planted that tells one."""
    planted = F.element_at(F.array(*map(F.lit, ["", '<input type="PASSWORD">', "<p>Please verify you are human</p>", "<b>Permanently</b> <i>closed</i> <p>permanently closed</p>", "<script>var t = 'captcha';</script>"])), (F.col("page_id") % 5 + 1).cast("int"))
    rows = documents.states(table(spark, d, "pages").select("page_id", F.concat("html", planted).alias("html")))
    return rows.select("page_id", "state")


@query("vehicle_words", r"""
    SELECT page_id, regexp_matches(lower(html), '(^|[^\pL\pN])(stock|inventory|inventario|vehiculos|véhicules|fahrzeuge|gebrauchtwagen|occasion|occasions|aanbod|voertuigen|gebrauchte|used-cars|used-vans)($|[^\pL\pN])') AS hit FROM pages
""")
def vehicle_words(spark, d):
    """Words that tell an inventory, by the pattern that the page reader uses."""
    return table(spark, d, "pages").select("page_id", F.col("html").rlike(urls.INVENTORY_JAVA).alias("hit"))


def captured(spark, d):
    return table(spark, d, "pages").select("page_id", F.col("url").alias("origin"), F.lit("text/html; charset=utf-8").alias("content_type"), F.lit(None).cast("map<string,string>").alias("headers"), F.encode("html", "UTF-8").alias("body"))


@query("document_claims")
def document_claims(spark, d):
    return documents.parse(captured(spark, d))


@query("technology_signatures", """
    SELECT s_suppkey AS page_id, category, name, confidence FROM supplier, (SELECT unnest([
        {'k': 0, 'category': 'cms', 'name': 'WordPress', 'confidence': 'strong_signal'}, {'k': 0, 'category': 'plugin', 'name': 'wordpress-plugin:car-list', 'confidence': 'tentative'}, {'k': 0, 'category': 'inventory_provider', 'name': 'DealerWebs', 'confidence': 'tentative'},
        {'k': 1, 'category': 'cms', 'name': 'Drupal', 'confidence': 'tentative'}, {'k': 1, 'category': 'cms', 'name': 'Joomla', 'confidence': 'tentative'}, {'k': 2, 'category': 'framework', 'name': 'Next.js', 'confidence': 'tentative'}], recursive := true)) t
    WHERE s_suppkey % 4 = t.k
""")
def technology_signatures(spark, d):
    """planted signatures: a site with its plugin and provider, one with rival declarations, an empty shell, and one without any."""
    bodies = [
        "<meta name=generator content='WordPress 6.5'><script src='/wp-content/plugins/car-list/x.js'></script><iframe src='https://my.dealerwebs.com/embed'></iframe>",
        "<meta name=generator content='Drupal 10'><meta name=generator content='Joomla! 5'><textarea><meta name=generator content='WordPress 6'></textarea>",
        "<div id=__next></div><script src='/_next/static/a.js'></script>", "<a href='https://dealerwebs.com.evil.example/x'>x</a>",
    ]
    body = F.element_at(F.array(*[F.encode(F.lit(x), "UTF-8") for x in bodies]), (F.col("s_suppkey") % 4 + 1).cast("int"))
    rows = table(spark, d, "supplier").select(F.col("s_suppkey").alias("page_id"), F.lit("https://d.example.com/").alias("origin"), F.lit("text/html").alias("content_type"), F.lit(None).cast("map<string,string>").alias("headers"), body.alias("body"))
    return technology.scan(rows).select("page_id", F.explode("detections").alias("x")).select("page_id", "x.category", "x.name", "x.confidence")


@query("technology_scan")
def technology_scan(spark, d):
    return technology.scan(captured(spark, d)).select("page_id", "status", F.size("detections").alias("detections"), F.size("inventory_surfaces").alias("surfaces"), "dynamic_rendering_required", F.array_join("limitations", ",").alias("limitations"))


@query("jsonld_extract", """
    SELECT s_suppkey AS page_id, 'https://s' || s_suppkey || '.example.com/' AS locator, kind, s_name AS label FROM supplier, (SELECT unnest(['professional_seller', 'point_of_sale', 'unknown']) AS kind)
    WHERE (kind = 'unknown') = (s_suppkey % 3 = 0) AND (kind <> 'point_of_sale' OR s_suppkey % 3 = 1)
""")
def jsonld_extract(spark, d):
    """Schema.org businesses in graphs: a repair shop, a dealer with a street and so a point of sale, and one without."""
    k = F.col("s_suppkey") % 3
    street = F.when(k == 1, F.lit(',"address":{"@type":"PostalAddress","streetAddress":"1 High Street"}')).otherwise("")
    node = F.concat(F.lit('{"@type":'), F.when(k == 0, '"AutoRepair"').when(k == 1, '"AutoDealer"').otherwise('["MotorcycleDealer"]'), F.lit(',"name":"'), F.col("s_name"), F.lit('","url":"https://s'), F.col("s_suppkey"), F.lit('.example.com/"'), street, F.lit("}"))
    html = F.concat(F.lit('<h1>x</h1><script type="application/ld+json">{"@graph":[{"@type":"Car","url":"/car/9"},'), node, F.lit("]}</script>"))
    pages = table(spark, d, "supplier").select(F.col("s_suppkey").alias("page_id"), F.lit("https://guide.example.com/list").alias("origin"), F.lit("text/html").alias("content_type"), F.encode(html, "UTF-8").alias("body"))
    return documents.parse(pages).select("page_id", "locator", "kind", "label")
