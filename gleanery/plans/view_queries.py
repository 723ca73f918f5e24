"""Views over published records: listings, rollups, facets, search, feeds. Orders stand for occurrences."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import listings as L
from ..operators import signals, tables, views
from .registry import query


def _day():
    return F.to_date("o_orderdate")

AS_OF = "1998-06-10"
_NOW = f"DATE '{AS_OF}'"


def _upcoming(t, days: int = 7):
    return t.orders.where(L.in_window(_day(), F.lit(AS_OF).cast("date"), days))


@query(f"SELECT o_orderkey FROM orders WHERE o_orderdate::DATE >= {_NOW}")
def upcoming(t):
    return L.upcoming(t.orders.withColumn("day", _day()), "day", F.lit(AS_OF).cast("date")).select("o_orderkey")


@query(f"SELECT o_orderkey FROM orders WHERE o_orderdate::DATE BETWEEN {_NOW} AND {_NOW} + 7")
def within_days(t):
    return _upcoming(t).select("o_orderkey")


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus IN ('O', 'F') AND o_totalprice > 1000")
def publishable(t):
    return L.publishable(t.orders.withColumn("published", F.col("o_totalprice") > 1000), "published", "o_orderstatus", ["O", "F"]).select("o_orderkey")


@query(f"SELECT o_orderkey FROM orders WHERE o_orderdate::DATE BETWEEN {_NOW} AND {_NOW} + 30 ORDER BY o_orderdate, o_orderkey")
def order_start(t):
    return _upcoming(t, 30).orderBy("o_orderdate", "o_orderkey").select("o_orderkey")


@query(f"""SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS place FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS n FROM orders
  WHERE o_orderdate::DATE BETWEEN {_NOW} AND {_NOW} + 30 AND o_orderpriority <> '5-LOW') WHERE n = 1 ORDER BY o_totalprice DESC, o_orderkey LIMIT 12""")
def featured(t):
    pool = _upcoming(t, 30).where("o_orderpriority <> '5-LOW'")
    return views.featured(pool, "o_custkey", 12, F.desc("o_totalprice"), F.col("o_orderkey")).select("o_orderkey", F.col("place").cast("long").alias("place"))


@query("SELECT o_custkey, o_orderkey, rank, more FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank, greatest(count(*) OVER (PARTITION BY o_custkey) - 5, 0) AS more FROM orders) WHERE rank <= 5")
def topk_per_group(t):
    found = signals.top_k(t.orders, ["o_custkey"], 5, F.desc("o_totalprice"), "o_orderkey")
    return found.select("o_custkey", "o_orderkey", F.col("rank").cast("long").alias("rank"), F.col("more").cast("long").alias("more"))


@query(f"SELECT o_orderdate::DATE AS day, list(o_orderkey ORDER BY o_orderdate, o_orderkey) AS orders FROM orders WHERE o_orderdate::DATE BETWEEN {_NOW} AND {_NOW} + 30 GROUP BY 1")
def group_by_day(t):
    return views.group_by_day(_upcoming(t, 30).withColumn("day", _day()), "day", "o_orderdate", "o_orderkey", "orders")


@query(f"""WITH p AS (SELECT * FROM orders WHERE o_orderdate::DATE BETWEEN {_NOW} AND {_NOW} + 30)
SELECT 'priority' AS facet, o_orderpriority AS value, count(*) AS n FROM p GROUP BY 2 UNION ALL SELECT 'free', 'free', count(*) FROM p WHERE o_totalprice < 50000 UNION ALL SELECT 'status', o_orderstatus, count(*) FROM p GROUP BY 2""")
def facet_counts(t):
    rows = _upcoming(t, 30).select(F.array("o_orderpriority").alias("categories"), (F.col("o_totalprice") < 50000).alias("free"), F.col("o_orderstatus").alias("area"))
    found = views.facet_counts(rows, "categories", "free", "area")
    names = {"category": "priority", "free": "free", "area": "status"}
    return found.withColumn("facet", F.create_map(*(F.lit(x) for kv in names.items() for x in kv))[F.col("facet")])


@query("SELECT o_orderkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus = 'O' AND o_totalprice < 200000")
def facet_filter(t):
    rows = t.orders.withColumns({"categories": F.array("o_orderpriority"), "free": F.col("o_totalprice") < 200000})
    return views.facet_filter(rows, ["1-URGENT", "2-HIGH"], True, ["O"], "categories", "free", "o_orderstatus").select("o_orderkey")


@query(f"""WITH o AS (SELECT *, o_orderdate::DATE AS d, row_number() OVER (PARTITION BY o_custkey, o_orderdate::DATE < {_NOW} ORDER BY o_orderdate::DATE DESC, o_orderkey DESC) AS n FROM orders)
SELECT o_custkey, coalesce(list(o_orderkey ORDER BY d, o_orderkey) FILTER (d >= {_NOW}), []) AS upcoming, min(d) FILTER (d >= {_NOW}) AS next,
  max(d) AS last_end, coalesce(list(o_orderkey ORDER BY d DESC, o_orderkey DESC) FILTER (d < {_NOW} AND n <= 24), []) AS past,
  arg_min(o_orderpriority, (d < {_NOW}, abs(d - {_NOW}), o_orderkey)) FILTER (o_orderstatus <> 'P') AS description FROM o GROUP BY 1""")
def series_rollup(t):
    rows, today = t.orders.withColumn("day", _day()), F.lit(AS_OF).cast("date")
    told = rows.withColumn("text", F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).otherwise(""))
    found = views.series_rollup(rows, "o_custkey", "day", "o_orderkey", today, 24)
    return found.join(views.description_pick(told, "o_custkey", "text", "day", "o_orderkey", today), "o_custkey").select("o_custkey", "upcoming", "next", "last_end", "past", "description")


@query(f"""WITH o AS (SELECT c_nationkey, n_name, o_orderkey, o_orderdate::DATE AS d, row_number() OVER (PARTITION BY c_nationkey, o_orderdate::DATE < {_NOW} ORDER BY o_orderdate::DATE DESC, o_orderkey DESC) AS n
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON n_nationkey = c_nationkey),
r AS (SELECT c_nationkey, any_value(n_name) AS n_name, count(*) FILTER (d >= {_NOW}) AS upcoming, coalesce(list(o_orderkey ORDER BY d DESC, o_orderkey DESC) FILTER (d < {_NOW} AND n <= 30), []) AS past FROM o GROUP BY 1)
SELECT c_nationkey, upcoming, past, row_number() OVER (ORDER BY upcoming DESC, n_name) AS place FROM r WHERE upcoming > 0""")
def venue_rollup(t):
    """Each nation's orders to come, its latest 30, and its place in the index."""
    rows = L.attach(t.orders.withColumn("day", _day()).withColumnRenamed("o_custkey", "c_custkey"), t.customer, "c_custkey", "inner")
    found = views.place_rollup(rows, "c_nationkey", "day", "o_orderkey", F.lit(AS_OF).cast("date"), 30)
    named = L.attach(found.withColumnRenamed("c_nationkey", "n_nationkey"), t.nation, "n_nationkey")
    return views.place_index(named, "n_name").select(F.col("n_nationkey").alias("c_nationkey"), "upcoming", "past", "place")


@query(f"""SELECT n_nationkey, count(o_orderkey) AS n, count(o_orderkey) = 0 AS noindex FROM nation LEFT JOIN
  (SELECT c_mktsegment, o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderdate::DATE BETWEEN {_NOW} AND {_NOW} + 2)
  ON c_mktsegment = CASE n_nationkey % 4 WHEN 0 THEN 'BUILDING' WHEN 1 THEN 'MACHINERY' END OR (n_nationkey % 4 < 2 AND c_mktsegment = 'FURNITURE') GROUP BY 1""")
def city_page(t):
    """Pages of two cities each, and some of a city that has nothing."""
    key = F.col("n_nationkey") % 4
    values = F.when(key == 0, F.array(F.lit("Building"), F.lit("furniture"))).when(key == 1, F.array(F.lit("Machinery"), F.lit("Furniture"))).otherwise(F.array(F.lit("Nowhere")))
    defs = t.nation.select("n_nationkey", F.lit("city").alias("kind"), values.alias("values"))
    rows = _upcoming(t, 2).join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", F.col("c_mktsegment").alias("city"), F.array().cast("array<string>").alias("categories"), F.lit(False).alias("is_free"))
    return views.list_pages(defs, rows, "n_nationkey", "o_orderkey")


@query(f"""WITH o AS (SELECT * FROM orders WHERE o_orderdate::DATE = {_NOW})
SELECT p.o_orderpriority AS page, count(o.o_orderkey) AS n, count(o.o_orderkey) = 0 AS noindex FROM (SELECT DISTINCT o_orderpriority FROM orders) p LEFT JOIN o USING (o_orderpriority) GROUP BY 1
UNION ALL SELECT 'free', count(*), count(*) = 0 FROM o WHERE o_totalprice < 50000 UNION ALL SELECT 'late', count(*), count(*) = 0 FROM o WHERE o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW')""")
def category_page(t):
    """A page per priority, one of two priorities, and the free one."""
    own = t.orders.select(F.col("o_orderpriority").alias("page")).distinct().select("page", F.lit("category").alias("kind"), F.array("page").alias("values"))
    more = t.spark.createDataFrame([("free", "free", []), ("late", "category", ["4-NOT SPECIFIED", "5-LOW"])], "page string, kind string, values array<string>")
    rows = _upcoming(t, 0).select("o_orderkey", F.lit(None).cast("string").alias("city"), F.array("o_orderpriority").alias("categories"), (F.col("o_totalprice") < 50000).alias("is_free"))
    return views.list_pages(own.unionByName(more), rows, "page", "o_orderkey")


@query(f"""WITH s AS (SELECT o_custkey * 4 + o_orderkey % 4 AS series, any_value(o_custkey) AS cust, max(o_orderdate::DATE) AS last, list(DISTINCT o_orderdate::DATE ORDER BY o_orderdate::DATE) AS days FROM orders GROUP BY 1)
SELECT series, last, CASE WHEN c_acctbal > 0 THEN '/n/' || c_nationkey ELSE '/' END AS target FROM s JOIN customer ON cust = c_custkey
WHERE last < {_NOW} - 30 AND len(list_filter(list_zip(days[1:-2], days[2:]), lambda p: p[2] - p[1] > 1)) = 0""")
def expire_redirect(t):
    """Series of a customer and a key's remainder; those without a gap of more than a day are one-offs."""
    rows = t.orders.withColumns({"series": F.col("o_custkey") * 4 + F.col("o_orderkey") % 4, "day": _day()})
    rolled = views.series_rollup(rows, "series", "day", "o_orderkey", F.lit(AS_OF).cast("date"), 24)
    owner = rows.groupBy("series").agg(F.first("o_custkey").alias("c_custkey")).join(t.customer, "c_custkey")
    known = rolled.join(signals.cadence(rows, "series", "day"), "series").join(owner, "series")
    target = F.when(F.col("c_acctbal") > 0, F.concat(F.lit("/n/"), F.col("c_nationkey"))).otherwise("/")
    return views.redirects(known, F.lit(AS_OF).cast("date"), target).select("series", F.col("last_end").alias("last"), "target")


@query("""WITH i AS (SELECT p_partkey, p_name AS title, lower(p_name || ' ' || p_brand || ' ' || p_type) AS hay FROM part), q AS (SELECT n_nationkey AS q, lower(split_part(p_name, ' ', 1)) AS a, lower(split_part(p_type, ' ', 1)) AS b FROM nation JOIN part ON p_partkey = n_nationkey + 1),
s AS (SELECT q, p_partkey, (CASE WHEN starts_with(lower(title), a) THEN 3 WHEN contains(lower(title), a) THEN 2 ELSE 1 END) + (CASE WHEN starts_with(lower(title), b) THEN 3 WHEN contains(lower(title), b) THEN 2 ELSE 1 END) AS score FROM q, i WHERE contains(hay, a) AND contains(hay, b))
SELECT q, p_partkey, score FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, p_partkey) AS n FROM s) WHERE n <= 50""")
def search(t):
    """Two words from each of 25 parts as queries over all parts."""
    index = t.part.select(F.col("p_partkey").alias("id"), F.lower("p_name").alias("title"), F.lower(F.concat_ws(" ", "p_name", "p_brand", "p_type")).alias("hay"), F.lit(0.0).alias("bonus"))
    words = F.array(F.lower(F.get(F.split("p_name", " "), 0)), F.lower(F.get(F.split("p_type", " "), 0)))
    queries = t.nation.join(t.part, F.col("p_partkey") == F.col("n_nationkey") + 1).select(F.col("n_nationkey").alias("q"), words.alias("tokens"))
    return views.search(queries, index, 50).select("q", F.col("id").alias("p_partkey"), F.col("score").cast("int").alias("score"))


@query("""WITH d AS (SELECT l_orderkey AS id, l_suppkey AS source_id, bool_or(l_returnflag = 'R') AS origin FROM lineitem GROUP BY 1, 2),
b AS (SELECT id, arg_min({'n': s_name, 'u': CASE WHEN origin THEN 'https://o/' || source_id ELSE '/s/' || source_id END, 't': CASE WHEN s_acctbal > 5000 THEN 'A' WHEN s_acctbal > 0 THEN 'B' ELSE 'C' END, 'r': source_id % 2 = 0},
  (CASE WHEN origin OR s_acctbal > 5000 THEN 0 WHEN s_acctbal > 0 THEN 1 ELSE 2 END, source_id % 3 <> 0, source_id)) AS s FROM d JOIN supplier ON s_suppkey = source_id GROUP BY 1),
o AS (SELECT *, (o_orderdate::TIMESTAMP AT TIME ZONE 'UTC') AT TIME ZONE 'America/Chicago' AS wall, ((o_orderdate::TIMESTAMP + INTERVAL 3 HOUR) AT TIME ZONE 'UTC') AT TIME ZONE 'America/Chicago' AS ends FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus <> 'F' AND o_orderdate >= TIMESTAMP '1998-01-01')
SELECT region, '{"id":' || o_orderkey || ',"series_slug":"c' || o_custkey || '","title":"' || o_orderpriority || '","start":"' || strftime(wall, '%Y-%m-%dT%H:%M:%S') || CASE WHEN o_orderdate - wall = INTERVAL 5 HOUR THEN '-05:00' ELSE '-06:00' END
  || '","end":"' || strftime(ends, '%Y-%m-%dT%H:%M:%S') || CASE WHEN o_orderdate + INTERVAL 3 HOUR - ends = INTERVAL 5 HOUR THEN '-05:00' ELSE '-06:00' END
  || '","all_day":false,"category":"' || o_orderstatus || '","categories":["' || o_orderstatus || '"],"venue":' || CASE WHEN o_orderkey % 3 = 0 THEN '{"name":"Yard"}' ELSE '{"slug":"n' || c_nationkey || '","name":"' || c_name || '","city":"' || c_mktsegment || '"}' END
  || ',"price":"' || CASE WHEN o_orderkey % 2 = 0 THEN '$5' ELSE '' END || '",' || CASE WHEN o_orderkey % 5 = 0 THEN '"ticket_url":"/t",' ELSE '' END || '"info_url":"' || coalesce(s.u, '/e') || '",'
  || CASE WHEN s IS NULL THEN '' ELSE '"source":{"name":"' || s.n || '","tier":"' || s.t || '","redistributable":' || s.r || '},' END || CASE WHEN o_orderkey % 7 = 0 THEN '"image":{"url":"/i","credit":"me"},' ELSE '' END || '"curation_score":1,"independent_source_count":2}' AS record
FROM o LEFT JOIN b ON b.id = o_orderkey, (VALUES ('core'), ('outer')) r(region)
WHERE CASE region WHEN 'core' THEN c_mktsegment = 'BUILDING' ELSE o_orderpriority = '1-URGENT' END""")
def sink_region_feed(t):
    """The feeds of two regions, written as files of JSON lines by region and read back, compared as whole texts."""
    k = F.col("o_orderkey")
    place = F.when(k % 3 != 0, F.struct(F.concat(F.lit("n"), "c_nationkey").alias("slug"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("city")))
    text = lambda c, value: F.when(c, value).otherwise("")
    records = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        k.alias("id"), F.concat(F.lit("c"), "o_custkey").alias("series_slug"), F.col("o_orderpriority").alias("title"), F.col("o_orderdate").cast("timestamp").alias("start"), (F.col("o_orderdate").cast("timestamp") + F.expr("INTERVAL 3 HOURS")).alias("end"),
        F.lit("America/Chicago").alias("zone"), F.lit(False).alias("all_day"), F.array("o_orderstatus").alias("categories"), place.alias("place"), F.lit("Yard").alias("venue_name"), text(k % 2 == 0, "$5").alias("price"), text(k % 5 == 0, "/t").alias("ticket_url"), F.lit("/e").alias("info_url"),
        text(k % 7 == 0, "/i").alias("image_url"), F.lit("me").alias("image_credit"), F.lit(1).alias("curation_score"), F.lit(2).alias("independent_source_count"), F.lit("published").alias("publish_state"), F.when(F.col("o_orderstatus") == "F", "cancelled").otherwise("active").alias("status"), "c_mktsegment",
    )
    pulled = t.lineitem.groupBy(F.col("l_orderkey").alias("id"), F.col("l_suppkey").alias("source_id")).agg(F.max(F.when(F.col("l_returnflag") == "R", "A")).alias("origin_tier")).join(t.supplier, F.col("source_id") == F.col("s_suppkey"))
    sid = F.col("source_id")
    bridge = pulled.select(
        "id", "source_id", F.col("s_name").alias("name"), F.concat(F.lit("/s/"), sid).alias("url"), text(F.col("origin_tier") == "A", F.concat(F.lit("https://o/"), sid)).alias("origin_url"), F.when(F.col("s_acctbal") > 5000, "A").when(F.col("s_acctbal") > 0, "B").otherwise("C").alias("tier"),
        "origin_tier", (sid % 3 == 0).alias("curated"), (sid % 2 == 0).alias("redistributable"),
    )
    feed = views.region_feed(records, bridge, F.lit("1998-01-01 03:00:00").cast("timestamp"), {"core": F.col("c_mktsegment") == "BUILDING", "outer": F.col("title") == "1-URGENT"})
    path = f"{tables.shared_dir(t.spark)}/feed-{uuid.uuid4().hex}"
    feed.write.partitionBy("region").text(path)
    return t.spark.read.text(path).select("region", F.col("value").alias("record"))


@query(f"SELECT 'series' AS kind, o_custkey AS id, min(o_orderdate::DATE) AS next FROM orders WHERE o_orderdate::DATE >= {_NOW} GROUP BY 2 UNION ALL SELECT 'venue', c_nationkey, NULL FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderdate::DATE >= {_NOW}) GROUP BY 2")
def sink_search_index(t):
    live = t.orders.where(_day() >= F.lit(AS_OF).cast("date"))
    series = signals.first_of(live, ["o_custkey"], "o_orderdate", "o_orderkey").select(F.lit("series").alias("kind"), F.col("o_custkey").alias("id"), _day().alias("next"))
    places = t.customer.join(live, F.col("o_custkey") == F.col("c_custkey"), "left_semi").select(F.lit("venue").alias("kind"), F.col("c_nationkey").cast("long").alias("id"), F.lit(None).cast("date").alias("next")).distinct()
    return series.unionByName(places)


@query("""SELECT o_orderkey, '{"@context":"https://schema.org","@type":"Event","name":"' || o_orderpriority || '","startDate":"' || strftime(o_orderdate::DATE, '%Y-%m-%d') || '","endDate":"' || strftime(o_orderdate::DATE + 1, '%Y-%m-%d') || '","eventStatus":"https://schema.org/' || CASE WHEN o_orderstatus = 'F' THEN 'EventCancelled' ELSE 'EventScheduled' END
  || '","location":{"@type":"Place","name":"' || c_name || '","address":{"@type":"PostalAddress","addressLocality":"' || c_mktsegment || '"}}' || CASE WHEN o_orderkey % 4 = 0 THEN ',"offers":{"@type":"Offer","price":"12","url":"/e/' || o_orderkey || '"}' ELSE '' END || ',"url":"/e/' || o_orderkey || '"}' AS jsonld
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS n FROM orders) JOIN customer ON o_custkey = c_custkey WHERE n <= 10""")
def sink_event_jsonld(t):
    best = signals.top_k(t.orders, ["o_custkey"], 10, "o_orderdate", "o_orderkey").join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    price = F.when(F.col("o_orderkey") % 4 == 0, "12").otherwise("")
    body = views.event_jsonld(F.col("o_orderpriority"), day("o_orderdate"), day(F.date_add("o_orderdate", 1)), F.when(F.col("o_orderstatus") == "F", "cancelled").otherwise("active"), F.col("c_name"), F.lit(""), F.col("c_mktsegment"), price, F.concat(F.lit("/e/"), F.col("o_orderkey")))
    return best.select("o_orderkey", body.alias("jsonld"))


@query("""SELECT s_nationkey, '{"@context":"https://schema.org","@type":"ItemList","name":"Suppliers","url":"/n/' || s_nationkey || '/","itemListElement":[' || string_agg('{"@type":"ListItem","position":' || n || ',"item":{"@type":"Place","name":"' || s_name || '","address":{"@type":"PostalAddress","addressLocality":"' || s_nationkey || '"}}}', ',' ORDER BY n) || ']}' AS jsonld
FROM (SELECT *, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_name, s_suppkey) AS n FROM supplier) GROUP BY 1""")
def sink_itemlist_jsonld(t):
    """A positioned list of each nation's suppliers."""
    item = F.struct(F.lit("Place").alias("@type"), F.col("s_name").alias("name"), F.struct(F.lit("PostalAddress").alias("@type"), F.col("s_nationkey").cast("string").alias("addressLocality")).alias("address"))
    return views.item_list_jsonld(t.supplier, "s_nationkey", ["s_name", "s_suppkey"], "Suppliers", F.concat(F.lit("/n/"), F.col("s_nationkey"), F.lit("/")), item)


@query("SELECT '/series/' || o_custkey AS path, max(o_orderdate::DATE) AS lastmod FROM orders GROUP BY o_custkey UNION ALL SELECT '/venue/' || n_nationkey, NULL FROM nation")
def sink_url_list(t):
    series = t.orders.groupBy("o_custkey").agg(F.max(_day()).alias("lastmod"))
    return views.url_list((series, "/series/", "o_custkey", F.col("lastmod")), (t.nation, "/venue/", "n_nationkey", F.lit(None)))


@query("SELECT 'late' AS section, l_suppkey AS id, n, rank FROM (SELECT l_suppkey, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, l_suppkey) AS rank FROM lineitem GROUP BY 1) WHERE rank <= 20 UNION ALL SELECT 'big', o_orderkey, NULL, rank FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders) WHERE rank <= 5")
def rpt_sections(t):
    late = views.ranked_section("late", t.lineitem.groupBy("l_suppkey").agg(F.count("*").alias("n")).select(F.col("l_suppkey").alias("id"), "n"), 20, F.desc("n"), "id")
    big = views.ranked_section("big", t.orders.select(F.col("o_orderkey").alias("id"), F.lit(None).cast("long").alias("n"), "o_totalprice"), 5, F.desc("o_totalprice"), "id")
    return late.unionByName(big.select("section", "id", "n", "rank"))


@query("SELECT p_brand, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, p_brand) AS place FROM part WHERE p_size > 10 GROUP BY 1")
def unknown_venue_rollup(t):
    return views.ranked_counts(t.part.where("p_size > 10"), "p_brand")


@query("SELECT (count(*) // 5 * 5)::VARCHAR || CASE WHEN count(*) % 5 > 0 THEN '+' ELSE '' END AS label FROM supplier WHERE s_acctbal > 0")
def source_count_label(t):
    return views.round_label(t.supplier.where("s_acctbal > 0"))


@query(f"""WITH o AS (SELECT *, o_orderdate::DATE AS d FROM orders), u AS (SELECT * FROM o WHERE d >= {_NOW})
SELECT 'series' AS kind, count(DISTINCT o_custkey) AS n FROM o UNION ALL SELECT 'day', count(DISTINCT d) FROM u UNION ALL SELECT 'category', count(DISTINCT o_orderpriority) FROM u
UNION ALL SELECT 'venue', count(DISTINCT c_nationkey) FROM u JOIN customer ON o_custkey = c_custkey""")
def page_counts(t):
    rows = t.orders.withColumn("day", _day())
    live = L.upcoming(rows, "day", F.lit(AS_OF).cast("date"))
    places = L.attach(live.withColumnRenamed("o_custkey", "c_custkey"), t.customer, "c_custkey", "inner").select("c_nationkey")
    return views.page_counts(series=rows.select("o_custkey"), day=live.select("day"), category=live.select("o_orderpriority"), venue=places)


@query("SELECT o_orderkey, c_name, n_name FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON n_nationkey = c_nationkey AND n_nationkey < 20")
def occ_venue_left(t):
    occ = L.attach(t.orders.withColumnRenamed("o_custkey", "c_custkey"), t.customer, "c_custkey", "inner")
    return L.attach(occ.withColumnRenamed("c_nationkey", "n_nationkey"), t.nation.where("n_nationkey < 20"), "n_nationkey").select("o_orderkey", "c_name", "n_name")


@query("SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey")
def occ_series_join(t):
    return L.attach(t.orders.withColumnRenamed("o_custkey", "c_custkey"), t.customer, "c_custkey", "inner").select("o_orderkey", "c_name")


@query("SELECT l_partkey, s_name, count(*) AS n FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2")
def bridge_source_join(t):
    return views.count_by(L.attach(t.lineitem.withColumnRenamed("l_suppkey", "s_suppkey"), t.supplier, "s_suppkey", "inner"), "l_partkey", "s_name")


@query("SELECT o_orderkey, c_name, n_name FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON n_nationkey = c_nationkey WHERE o_orderstatus = 'P'")
def open_items(t):
    from ..operators import review

    queue = t.orders.select("o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")).alias("resolved_at"))
    records = L.attach(t.orders.withColumnRenamed("o_custkey", "c_custkey"), t.customer, "c_custkey", "inner").select("o_orderkey", "c_name", F.col("c_nationkey").alias("n_nationkey"))
    return review.open_items(queue, records, t.nation, "o_orderkey", "n_nationkey").select("o_orderkey", "c_name", "n_name")


@query("SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 'weekly' ELSE c_mktsegment END AS cadence, c_custkey % 4 = 0 AS noted FROM customer")
def notes_join(t):
    notes = t.customer.where("c_custkey % 4 = 0").select("c_custkey", F.lit("weekly").alias("note"))
    j = L.label_of(t.customer, notes, "c_custkey", "note")
    return j.select("c_custkey", L.first_filled(F.col("note"), default=F.col("c_mktsegment")).alias("cadence"), F.col("note").isNotNull().alias("noted"))


_AREA = "CASE WHEN n_regionkey IN (0, 1) THEN 'core' WHEN n_regionkey = 2 THEN 'outer' END"


@query(f"SELECT n_nationkey, {_AREA} AS ring FROM nation")
def ring_of(t):
    rings = t.region.where("r_regionkey < 3").select(F.col("r_regionkey").alias("n_regionkey"), F.when(F.col("r_regionkey") < 2, "core").otherwise("outer").alias("ring"))
    return L.label_of(t.nation, rings, "n_regionkey", "ring").select("n_nationkey", "ring")


@query("SELECT n_nationkey, r_name AS area FROM nation LEFT JOIN region ON r_regionkey = n_regionkey AND r_regionkey < 3")
def area_of(t):
    areas = t.region.where("r_regionkey < 3").select(F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("area"))
    return L.label_of(t.nation, areas, "n_regionkey", "area").select("n_nationkey", "area")


_DRAW = "(NOT contains(p_name, 'tin') AND (contains(p_type, 'BRASS') OR p_size % 4 = 0 AND (p_size < 30 OR p_size % 3 = 0 OR p_size % 8 = 0)))"


def _draw():
    sources = F.filter(F.array(F.when(F.col("p_size") % 4 == 0, F.lit("tickets")), F.when(F.col("p_size") % 8 == 0, F.lit("festivals"))), lambda x: x.isNotNull())
    return views.is_draw(F.col("p_name"), F.col("p_type"), sources, ["tickets", "festivals"], "tin", "BRASS", limited=["tickets"], venue_ok=(F.col("p_size") < 30) | (F.col("p_size") % 3 == 0))


@query(f"SELECT p_partkey, {_DRAW} AS draw FROM part")
def is_draw(t):
    return t.part.select("p_partkey", _draw().alias("draw"))


@query(f"SELECT p_partkey FROM part WHERE {_DRAW}")
def only_draws(t):
    return t.part.where(_draw()).select("p_partkey")


@query(f"SELECT p_partkey, CASE WHEN p_size < 10 THEN true WHEN p_size < 40 THEN {_DRAW} ELSE p_size % 2 = 0 END AS shown FROM part")
def shows_on_site(t):
    ring = F.when(F.col("p_size") < 10, "core").when(F.col("p_size") < 40, "outer")
    return t.part.select("p_partkey", views.shows_on_site(ring, _draw(), F.col("p_size") % 2 == 0).alias("shown"))


@query("SELECT p_partkey FROM part WHERE NOT regexp_matches(lower(p_name), '^(red|blue)|steel$')")
def skip_titles(t):
    return L.without_titles(t.part, "p_name", ["^(?:red|blue)|steel$"]).select("p_partkey")


@query("SELECT p_partkey FROM part WHERE NOT contains(p_name, 'green')")
def cancel_filter(t):
    return L.without_titles(t.part, "p_name", ["green"]).select("p_partkey")


@query("SELECT event_id FROM events WHERE extract(hour FROM ts::TIMESTAMP) BETWEEN 16 AND 17 AND isodow(ts::TIMESTAMP) <= 5")
def open_now(t):
    """Clicks inside a weekday window from 16:00 to 18:00."""
    windows = F.array(F.struct(F.array(*map(F.lit, range(5))).alias("d"), F.lit("16:00").alias("s"), F.lit("18:00").alias("e")))
    return t.events.where(views.open_now(windows, F.weekday("ts"), F.date_format("ts", "HH:mm"))).select("event_id")


@query("SELECT event_id FROM events WHERE isodow(ts::TIMESTAMP) <= 5")
def open_today(t):
    windows = F.array(F.struct(F.array(*map(F.lit, range(5))).alias("d"), F.lit("16:00").alias("s"), F.lit("18:00").alias("e")))
    return t.events.where(views.open_today(windows, F.weekday("ts"))).select("event_id")


@query("SELECT o_orderdate::DATE AS day, count(*) AS n FROM orders WHERE o_orderdate::DATE + 2 >= DATE '2001-07-01' GROUP BY 1")
def drop_ended(t):
    return views.count_by(L.not_ended(t.orders.withColumn("day", _day()), F.date_add(_day(), 2), F.lit("2001-07-01").cast("date")), "day")


@query("SELECT o_orderkey, (o_orderstatus = 'O' AND o_orderkey % 2 = 0) AS multi_day FROM orders")
def multi_day(t):
    ends = F.date_add(_day(), F.when(F.col("o_orderkey") % 2 == 0, 1).otherwise(0))
    return t.orders.select("o_orderkey", L.multi_day(_day(), ends, F.col("o_orderstatus") == "O").alias("multi_day"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority WHEN o_orderkey % 3 = 1 THEN o_orderstatus ELSE 'x' END AS link FROM orders")
def info_link(t):
    first = F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderpriority")).otherwise("")
    second = F.when(F.col("o_orderkey") % 3 == 1, F.col("o_orderstatus"))
    return t.orders.select("o_orderkey", L.first_filled(first, second, default=F.lit("x")).alias("link"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN [o_orderpriority] ELSE [o_orderstatus] END AS regions FROM orders")
def regions_fallback(t):
    own = F.when(F.col("o_orderkey") % 3 == 0, F.array("o_orderpriority")).otherwise(F.array().cast("array<string>"))
    return t.orders.select("o_orderkey", L.regions_or(own, F.array("o_orderstatus")).alias("regions"))