"""The test tables as directory data.

Each adapter is one SQL text that gives the same rows on Spark and on DuckDB; the shapes only Spark
needs (maps, arrays, pages) are made from those rows by expressions below.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placebook.functions.text import clean_phone, first_filled
from placebook.schema import conform
from placebook.sources.directories import parse_listings

# one order is one sighting of business o_custkey, from one of five sources
LISTINGS = """
WITH o AS (
  SELECT o_orderkey AS i, o_custkey AS k, o_orderdate AS d, p_name,
         CASE WHEN o_orderkey % 10 = 0 THEN 'OpenStreetMap (Oct 2026)'
              WHEN o_orderkey % 10 IN (1, 2) THEN 'Finelib (Oct 2026)'
              WHEN o_orderkey % 10 = 3 THEN 'Manual CSV (walk.csv)'
              WHEN o_orderkey % 10 = 4 THEN 'Google Places API (Oct 2026)'
              ELSE 'Google Maps (sweep, Oct 2026)' END AS source
  FROM (SELECT *, o_custkey % (SELECT count(*) FROM part) AS pk FROM orders) x JOIN part ON p_partkey = pk)
SELECT i AS ord, k AS true_id, source,
  concat(p_name, ' ', CAST(k % 97 AS string),
    CASE WHEN i % 3 = 0 THEN ' Ltd' WHEN i % 3 = 1 THEN ' Nigeria Enterprises' ELSE '' END) AS name,
  CASE WHEN source LIKE 'Google%' THEN concat('0x1:0x', CAST(k AS string)) ELSE '' END AS place_id,
  CASE WHEN k % 4 = 0 AND i % 2 = 0 THEN ''
       WHEN k % 50 = 1 THEN '0700 000 0000'
       WHEN i % 4 = 3 THEN concat('+234 803 ', lpad(CAST(k % 1000 AS string), 3, '0'), ' ', lpad(CAST((k * 37) % 10000 AS string), 4, '0'))
       WHEN i % 7 = 2 THEN concat('0803-', lpad(CAST(k % 1000 AS string), 3, '0'), '-', lpad(CAST((k * 37) % 1000 AS string), 3, '0'))
       ELSE concat('0803 ', lpad(CAST(k % 1000 AS string), 3, '0'), ' ', lpad(CAST((k * 37) % 10000 AS string), 4, '0')) END AS phone_raw,
  CASE WHEN source LIKE 'Finelib%' OR source LIKE 'Manual%' THEN NULL
       ELSE 6.56 + ((k * 13) % 900 - 450) / 10000.0e0 END AS lat,
  CASE WHEN source LIKE 'Finelib%' OR source LIKE 'Manual%' THEN NULL
       ELSE 3.37 + ((k * 29) % 900 - 450) / 10000.0e0 END AS lng,
  concat(CASE WHEN i % 2 = 0 THEN 'No ' ELSE '' END, CAST(k % 200 + 1 AS string), ' Fixture ',
         CASE WHEN i % 2 = 0 THEN 'Road, ' ELSE 'Rd, ' END,
         CASE k % 8 WHEN 0 THEN 'Anthony Village' WHEN 1 THEN 'Maryland' WHEN 2 THEN 'Ilupeju' WHEN 3 THEN 'Gbagada'
                    WHEN 4 THEN 'Obanikoro' WHEN 5 THEN 'Palmgrove' WHEN 6 THEN 'Ojota' ELSE 'Ikeja' END, ', Lagos') AS addr,
  CASE k % 12 WHEN 0 THEN 'Pharmacy' WHEN 1 THEN 'Supermarket' WHEN 2 THEN 'Restaurant' WHEN 3 THEN 'Bar/Lounge'
              WHEN 4 THEN 'Barber shop' WHEN 5 THEN 'Lawyer' WHEN 6 THEN 'Hotel' WHEN 7 THEN 'Fast Food'
              WHEN 8 THEN 'Provision store' WHEN 9 THEN 'Auto repair shop' WHEN 10 THEN 'Church' ELSE '' END AS label,
  CASE WHEN i % 3 = 0 THEN NULL ELSE CAST((k * 17) % 500 AS int) END AS reviews,
  CASE WHEN i % 3 = 0 THEN NULL ELSE 3.0e0 + (k % 21) / 10.0e0 END AS rating,
  CASE WHEN k % 5 = 0 AND i % 2 = 0 THEN concat('https://biz', CAST(k AS string), '.example') ELSE '' END AS website,
  CAST(CAST(d AS date) AS string) AS fetched
FROM o
"""

# the address of a place on the map; every third has an API id
MAP_URL = """concat('https://www.google.com/maps/place/x', CAST(true_id AS string), '/data=!4m7!3m6!1s0x1:0x',
  CAST(true_id AS string), '!8m2!3d6.', lpad(CAST(5600 + (true_id * 13) % 900 - 450 AS string), 4, '0'), '!4d3.',
  lpad(CAST(3700 + (true_id * 29) % 900 - 450 AS string), 4, '0'),
  CASE WHEN true_id % 3 = 0 THEN concat('!19sChIJ', CAST(true_id AS string), '_x-1?a=b') ELSE '?hl=en' END)"""

# saved pages with a block of contacts of each kind: links and plain text, numbers of two forms, two networks, a link cut short
PAGES_WITH_CONTACTS = """
SELECT page_id, url, concat(html, '<section id="reach"><h4>Reach branch ', CAST(page_id AS string), '</h4><p>Desk: desk', CAST(page_id AS string),
  '@shop.example, bills to <a class="m" href="MAILTO:bills+', CAST(page_id AS string), '@shop.example">accounts</a> (not no-reply@shop.example)</p><ul><li><a href="tel:0809',
  lpad(CAST(page_id * 13 AS string), 7, '0'), '">0809 ring us</a></li><li>Shop floor +234 701 ', lpad(CAST(page_id % 1000 AS string), 3, '0'), ' 4455</li>',
  CASE WHEN page_id % 2 = 0 THEN concat('<li><a href="https://api.whatsapp.com/send?phone=234906', lpad(CAST(page_id AS string), 7, '0'), '&amp;text=hello">chat</a></li>')
       ELSE concat('<li><a href="https://wa.me/+234906', lpad(CAST(page_id AS string), 7, '0'), '">chat</a></li>') END,
  '<li><a href="https://facebook.com/shop.', CAST(page_id AS string), '">fb</a> <a href="https://twitter.com/shop_', CAST(page_id % 100000 AS string), '">tw</a> <a href="https://www.tiktok.com/@">tt</a></li></ul>',
  CASE WHEN page_id % 4 = 1 THEN '<p>Wholesale &amp; catering, dispatch riders on call. Place an order by noon.</p>' WHEN page_id % 4 = 2 THEN '<p>Free delivery above 10 items</p>' ELSE '' END,
  '<style>.catering { color: red }</style></section>') AS html FROM pages
"""

# the pages of a website: six pages in a row make a site, each under one of the known paths
SITE_PAGES = f"""
SELECT concat('https://biz', CAST(CAST((page_id - page_id % 6) * 5 / 6 AS bigint) AS string), '.example') AS website,
       CASE page_id % 6 WHEN 0 THEN '/' WHEN 1 THEN '/order' WHEN 2 THEN '/contact' WHEN 3 THEN '/about'
                        WHEN 4 THEN '/delivery' ELSE '/contact-us' END AS path,
       page_id, html
FROM ({PAGES_WITH_CONTACTS}) p
"""

# open map elements, with tags as plain columns
ELEMENTS = f"""
SELECT ord, true_id, CASE WHEN ord % 5 = 0 THEN 'way' ELSE 'node' END AS type, ord + 900000000 AS id,
       6.56 + ((true_id * 13) % 900 - 450) / 10000.0e0 AS lat, 3.37 + ((true_id * 29) % 900 - 450) / 10000.0e0 AS lon,
       CASE WHEN ord % 13 = 0 OR ord % 7 = 0 THEN '' ELSE name END AS t_name,
       CASE WHEN ord % 13 <> 0 AND ord % 7 = 0 AND ord % 2 = 0 THEN name ELSE '' END AS t_name_en,
       CASE WHEN ord % 13 <> 0 AND ord % 7 = 0 THEN concat('Brand ', name) ELSE '' END AS t_brand,
       CASE WHEN true_id % 12 IN (1, 8) THEN 'general_store;deli' WHEN true_id % 12 = 9 THEN 'yes' ELSE '' END AS t_shop,
       CASE true_id % 12 WHEN 0 THEN 'pharmacy' WHEN 2 THEN 'restaurant' WHEN 7 THEN 'fast_food' WHEN 10 THEN 'place_of_worship' ELSE '' END AS t_amenity,
       CASE true_id % 12 WHEN 5 THEN 'lawyer' ELSE '' END AS t_office,
       CASE WHEN phone_raw = '' THEN '' ELSE concat(phone_raw, '; 0805 ', lpad(CAST(true_id % 1000 AS string), 3, '0'), ' 1234') END AS t_phone,
       CASE WHEN ord % 4 = 0 THEN '0807 111 2222' ELSE '' END AS t_mobile,
       CAST(true_id % 200 + 1 AS string) AS t_house, 'Fixture Road' AS t_street,
       CASE WHEN ord % 2 = 0 THEN 'Maryland' ELSE '' END AS t_suburb, 'Lagos' AS t_city,
       website AS t_website, CASE WHEN ord % 6 = 0 THEN 'Mo-Sa 08:00-18:00' ELSE '' END AS t_hours, fetched
FROM listings
"""

# cards of a map search, with the texts on a card as plain columns
CARDS = f"""
SELECT ord, true_id, name AS aria, {MAP_URL} AS href,
       CASE WHEN ord % 3 = 0 THEN '' WHEN ord % 3 = 1 THEN concat(CAST(3 + true_id % 2 AS string), '.', CAST(true_id % 10 AS string), ' stars')
            ELSE concat(CAST(3 + true_id % 2 AS string), '.', CAST(true_id % 10 AS string), ' stars ', CASE WHEN true_id > 99 THEN concat(CAST(true_id % 9 + 1 AS string), ',', lpad(CAST(true_id % 1000 AS string), 3, '0')) ELSE CAST(true_id AS string) END, ' Reviews') END AS stars,
       concat('(', CAST((true_id * 17) % 500 AS string), ')') AS count_text,
       CASE WHEN ord % 4 = 1 THEN 'No reviews' ELSE '' END AS none_text,
       CASE WHEN ord % 6 = 1 THEN '₦1–10,000' ELSE '·' END AS price_text,
       label, addr, CASE WHEN ord % 2 = 0 THEN 'Open 24 hours' ELSE '· Closes 9 PM' END AS status_text, phone_raw,
       CASE WHEN ord % 5 = 0 THEN 'https://www.google.com/x' ELSE website END AS website, fetched
FROM listings WHERE source LIKE 'Google%'
"""

# directory listings: 20 to a page, two sites in turn; two paid rows on every page
DIRECTORY_ROWS = """
SELECT ord, true_id, CASE WHEN ((ord - ord % 200) / 200) % 2 = 0 THEN 'finelib' ELSE 'businesslist' END AS site,
       CAST((ord - ord % 400) / 400 + 1 AS int) AS page_no, name, addr, phone_raw, label, fetched,
       CAST(100000 + true_id AS string) AS listing_id, ord % 100 = 1 AND ((ord - ord % 200) / 200) % 2 = 1 AS sponsored,
       CASE WHEN ord % 3 = 0 THEN '' ELSE concat('6.', CAST(5000 + true_id AS string)) END AS lat_text,
       concat('We run a ', CASE WHEN label = '' THEN 'laundry' ELSE lower(label) END, ' in town since ', CAST(1990 + true_id % 30 AS string)) AS tagline
FROM listings WHERE source LIKE 'Finelib%'
"""

# the log of searches
SEARCH_LOG = """
SELECT event_id, 'gmaps_browser' AS source, concat(event_type, ' ', CAST(user_id % 5 AS string)) AS term,
       CASE WHEN event_id % 10 = 0 THEN concat('topup Gbagada @6.5514,3.3865,', CAST(15 + user_id % 3 AS string), 'z')
            ELSE concat('sweep 6.', CAST(5400 + (user_id * 37) % 500 AS string), ',3.', CAST(3500 + (user_id * 13) % 400 AS string), ',', CAST(14 + event_id % 3 AS string), 'z') END AS area,
       CASE event_id % 7 WHEN 0 THEN 'running' WHEN 1 THEN 'error' ELSE 'done' END AS status,
       CASE WHEN event_id % 7 IN (0, 1) THEN NULL ELSE CAST(CASE WHEN event_id % 11 = 3 THEN 0 ELSE (event_id * 31) % 150 END AS int) END AS raw_count,
       CASE WHEN event_id % 7 = 1 THEN 'timeout' ELSE '' END AS error, ts AS happened_at
FROM events
"""


def read(spark: SparkSession, folder: str, *names: str) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{folder}/{n}.parquet") for n in names}


def _sql(spark: SparkSession, text: str, **tables: DataFrame) -> DataFrame:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return spark.sql(text)


def spread(df: DataFrame) -> DataFrame:
    """The test tables are one file each: give every core work on them, whatever the master."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if len(df.inputFiles()) < cores else df


def listings(spark: SparkSession, folder: str) -> DataFrame:
    tables = read(spark, folder, "orders", "part")
    return _sql(spark, LISTINGS, orders=spread(tables["orders"]), part=tables["part"])          # keys are dealt anew, not texts


def sightings(spark: SparkSession, folder: str) -> DataFrame:
    return to_sightings(listings(spark, folder))


def to_sightings(raw: DataFrame) -> DataFrame:
    """Listings as mapped records."""
    phone = F.col("phone")
    return conform(raw.withColumn("phone", clean_phone("phone_raw")).select(
        "ord", "name", "place_id", "addr", "lat", "lng", "label", "phone",
        F.when(phone != "", F.array(phone)).otherwise(F.array().cast("array<string>")).alias("phones_all"), "website", "reviews", "rating", "source",
        F.col("fetched").alias("added"),
        F.when(F.col("place_id") != "", F.expr(MAP_URL)).otherwise("").alias("maps")))


def pages(spark: SparkSession, folder: str) -> DataFrame:
    return spread(_sql(spark, PAGES_WITH_CONTACTS, **read(spark, folder, "pages")))


def site_pages(spark: SparkSession, folder: str) -> DataFrame:
    return spread(_sql(spark, SITE_PAGES, **read(spark, folder, "pages")))


def elements(spark: SparkSession, folder: str) -> DataFrame:
    flat = _sql(spark, ELEMENTS, listings=listings(spark, folder))
    keys = {"name": "t_name", "name:en": "t_name_en", "brand": "t_brand", "shop": "t_shop", "amenity": "t_amenity",
            "office": "t_office", "phone": "t_phone", "mobile": "t_mobile", "addr:housenumber": "t_house",
            "addr:street": "t_street", "addr:suburb": "t_suburb", "addr:city": "t_city", "website": "t_website",
            "opening_hours": "t_hours"}
    tags = F.create_map(*[x for key, col in keys.items() for x in (F.lit(key), F.col(col))])
    node = F.col("type") == "node"
    return flat.select(
        "ord", "type", "id", F.when(node, F.col("lat")).alias("lat"), F.when(node, F.col("lon")).alias("lon"),
        F.when(~node, F.struct(F.col("lat").alias("lat"), F.col("lon").alias("lon"))).alias("center"),
        F.map_filter(tags, lambda k, v: v != "").alias("tags"), F.col("fetched").alias("_fetched"))


def cards(spark: SparkSession, folder: str) -> DataFrame:
    flat = _sql(spark, CARDS, listings=listings(spark, folder))
    leaves = F.array("aria", F.lit("4.3"), "count_text", "none_text", "price_text", "label", F.lit("·"), "addr",
                     "status_text", F.lit(""), "phone_raw", F.lit("Website"), F.lit("Directions"))
    return flat.select("ord", "aria", "href", "stars", leaves.alias("leaves"), "website", F.lit("sweep").alias("_kind"),
                       F.col("fetched").alias("_fetched"))


def directory_pages(spark: SparkSession, folder: str) -> DataFrame:
    """HTML pages of both layouts made from the listings; a page holds about twenty."""
    rows = _sql(spark, DIRECTORY_ROWS, listings=listings(spark, folder))
    slug = F.lower(F.regexp_replace("label", "[^A-Za-z]+", "-"))
    box = F.concat(
        F.lit('<div class="box-682 bg-none"><div class="box-headings box-new-hed"><span>1</span><a href="/listing/x/'),
        "listing_id", F.lit('/">'), "name", F.lit('</a></div><div class="bx-inner"><div class="cmpny-lstng-1"><img src="/images/bldng.png" alt="">'),
        "addr", F.lit('</div><div class="tel-no-div"><div class="cmpny-lstng-1"><img src="/images/phone-2.png">'), "phone_raw",
        F.lit('</div></div><div class="listing-desc"><p>'), "tagline", F.lit("</p></div></div></div>"))
    company = F.concat(
        F.lit('<div class="company with_img" data-cmpid="'), "listing_id", F.lit('"><div class="company_header"><h3><a href="/company/'),
        "listing_id", F.lit('/x">'), "name", F.lit('</a></h3><div class="address">'), "addr", F.lit('</div><div class="tagline">'), "tagline",
        F.lit('</div></div><div class="cont"><div class="s"><i class="fa fa-phone"></i> <span>'), "phone_raw",
        F.lit('</span></div></div><div class="mapmarker" data-ltd="'), "lat_text", F.lit('" data-lng="3.37"></div>'),
        F.when(F.col("sponsored"), "<i>Sponsored</i>").otherwise(""), F.lit("</div>"))
    block = F.when(F.col("site") == "finelib", box).otherwise(company)
    url = F.when(F.col("site") == "finelib", F.concat(
        F.lit("https://www.finelib.com/cities/lagos/areas-and-suburbs/anthony-village/page-"), "page_no")).otherwise(
        F.concat(F.lit("https://www.businesslist.com.ng/location/lagos/"), "page_no"))
    links = F.concat(F.lit('<div class="category-list newlist"><ul><li><a href="/cities/lagos/areas-and-suburbs/anthony-village/page-'), "page_no",
                     F.lit('/health-services">Health</a></li><li><a href="/about">About</a></li></ul></div>'))
    whole = rows.select("site", "page_no", url.alias("url"), links.alias("links"), F.struct("ord", block.alias("html")).alias("b"))
    return (whole.groupBy("site", "page_no", "url", "links")
            .agg(F.array_join(F.transform(F.array_sort(F.collect_list("b")), lambda b: b["html"]), "\n").alias("body"))
            .select("site", "page_no", "url", F.concat(F.lit("<html><body>"), "links", "body", F.lit("</body></html>")).alias("html")))


def directory_listings(spark: SparkSession, folder: str) -> DataFrame:
    return parse_listings(directory_pages(spark, folder))


def details(spark: SparkSession, folder: str) -> DataFrame:
    """Detail pages of the places with a map address: key, items, about."""
    rows = listings(spark, folder).filter("source like 'Google%'").select("true_id").distinct()
    k = F.col("true_id")
    nothing = F.lit(None).cast("struct<label:string,href:string>")

    def item(label, href):
        return F.struct(label.alias("label"), href.alias("href"))

    items = F.map_filter(F.create_map(
        F.lit("address"), item(F.concat(F.lit("Address: "), (k % 200 + 1).cast("string"), F.lit(" Fixture Road, Anthony Village, Ikeja, Lagos ")), F.lit("")),
        F.lit("authority"), F.when(k % 7 == 0, item(F.lit("Website"), F.concat(F.lit("http://site"), k.cast("string"), F.lit(".example/")))).otherwise(nothing),
        F.concat(F.lit("phone:tel:+234806"), F.lpad((k % 500).cast("string"), 7, "0")), F.when(k % 3 != 1, item(F.lit("Phone"), F.lit(""))).otherwise(nothing),
        F.lit("action:4"), F.when(k % 4 == 2, item(F.lit(""), F.concat(F.lit("https://order.example/"), k.cast("string")))).otherwise(nothing)),
        lambda _, v: v.isNotNull())
    about = F.array_compact(F.array(
        F.when(k % 2 == 0, F.lit("Offers delivery")), F.when(k % 3 == 0, F.lit("Offers takeout")), F.lit("Serves dine-in"),
        F.when(k % 10 == 0, F.lit("No delivery")), F.when(k % 6 == 0, F.lit(" Catering ")), F.lit("Has wheelchair access"),
        F.when(k % 9 == 0, F.lit("No-contact delivery"))))
    return rows.select(F.concat(F.lit("0x1:0x"), k.cast("string")).alias("key"), items.alias("items"), about.alias("about"))


# answers of the API, two per place, the later one counts
_ANSWER = """
SELECT DISTINCT concat('ChIJ', CAST(true_id AS string), '_x-1') AS place_key, {v} AS fetched_at,
       CASE WHEN true_id % 2 = 0 THEN concat('+234 807 ', lpad(CAST(true_id % 300 AS string), 3, '0'), ' 4321') ELSE '' END AS intl,
       '0809 555 0000' AS national, CASE WHEN true_id % 5 = 1 THEN concat('https://api', CAST(true_id AS string), '.example') ELSE '' END AS web,
       CASE WHEN true_id % 4 = 0 THEN NULL ELSE CAST(true_id % 700 + {v} AS int) END AS n_ratings,
       4.0e0 + (true_id % 9) / 10.0e0 AS stars
FROM listings WHERE source LIKE 'Google%' AND true_id % 3 = 0
"""
API_ANSWERS = _ANSWER.format(v=1) + "UNION ALL" + _ANSWER.format(v=2)


def api_answers(spark: SparkSession, folder: str) -> DataFrame:
    rows = _sql(spark, API_ANSWERS, listings=listings(spark, folder))
    return rows.select(F.col("place_key").alias("key"), "fetched_at", F.struct(
        F.col("intl").alias("internationalPhoneNumber"), F.col("national").alias("nationalPhoneNumber"),
        F.col("web").alias("websiteUri"), F.col("n_ratings").alias("userRatingCount"), F.col("stars").alias("rating")).alias("data"))


def search_log(spark: SparkSession, folder: str) -> DataFrame:
    return _sql(spark, SEARCH_LOG, **read(spark, folder, "events"))


def odd_headers(spark: SparkSession, folder: str) -> DataFrame:
    """Listings the way a hand-made file heads its columns."""
    raw = listings(spark, folder)
    return raw.select(
        "ord", F.when(F.col("ord") % 17 == 0, F.lit("  ")).otherwise(F.col("name")).alias("Business_Name"),
        F.when(F.col("ord") % 34 == 0, F.lit("")).otherwise(F.col("name")).alias("Company"), F.concat("phone_raw", F.lit(" / 0802 555 1234")).alias(" Phone Number "),
        F.col("addr").alias("LOCATION"), F.col("label").alias("Type"), F.col("website").alias("URL"),
        F.when(F.col("ord") % 2 == 0, F.lit("")).otherwise(F.col("lat").cast("decimal(9,4)").cast("string")).alias("Latitude"),
        F.lit("n/a").alias("Long"), F.when(F.col("ord") % 9 == 0, "Do Not Contact").otherwise("").alias("Sales  Status"),
        F.lit("walk.csv").alias("_file"), F.col("fetched").alias("_fetched"))


def with_tagline(spark: SparkSession, folder: str) -> DataFrame:
    """Directory sightings that carry their category in the tagline only."""
    tagline = F.when(F.col("ord") % 2 == 0, F.concat(F.lit("We run a fitness and gym studio no "), F.col("ord").cast("string"))).otherwise("")
    return sightings(spark, folder).withColumn("notes", first_filled(tagline))
