"""What to search next: plans, what is pending, splits of saturated searches, top-ups, odd results.

A search is (source, term, area); a viewport search's area reads 'sweep 6.5613,3.3721,14z'. The log is
append-only: events (event_id, source, term, area, status, raw_count, error, happened_at).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from placebook.areas import Area
from placebook.session import materialise, materialise_counting

# fixed values: results a feed shows at most, closest zoom, screen of the reference window
FEED_CAP = 120
MAX_ZOOM = 17
SCREEN = (1366, 768)
TILE = 256
_VIEWPORT = r"(-?\d+\.\d+),(-?\d+\.\d+),(\d+)z"


# ------------------------------------------------------------------------ viewports

def viewport(area: Column | str) -> tuple[Column, Column, Column]:
    """(lat, lng, zoom) out of a search's area text; NULLs if it is no viewport."""
    text = F.col(area) if isinstance(area, str) else area

    def part(i: int, kind: str) -> Column:
        return F.nullif(F.regexp_extract(text, _VIEWPORT, i), F.lit("")).try_cast(kind)

    return part(1, "double"), part(2, "double"), part(3, "int")


def _degrees_per_pixel(zoom: Column) -> Column:
    return F.lit(360.0) / (F.lit(float(TILE)) * F.pow(F.lit(2.0), zoom))


def half_extent(lat: Column, zoom: Column) -> tuple[Column, Column]:
    """Half the window's height and width in degrees (Web Mercator)."""
    pixel = _degrees_per_pixel(zoom)
    return F.cos(F.radians(lat)) * pixel * (SCREEN[1] / 2), pixel * (SCREEN[0] / 2)


def bounds(lat: Column, lng: Column, zoom: Column) -> dict[str, Column]:
    high, wide = half_extent(lat, zoom)
    return {"south": lat - high, "west": lng - wide, "north": lat + high, "east": lng + wide}


def intersects(box: dict[str, Column], other: tuple[float, float, float, float]) -> Column:
    south, west, north, east = other
    return ~((box["north"] < south) | (F.lit(north) < box["south"]) | (box["east"] < west) | (F.lit(east) < box["west"]))


def quadrants(lat: Column, lng: Column, zoom: Column) -> Column:
    """The four quarters of a window, one zoom closer: array of struct(lat, lng, zoom)."""
    high, wide = half_extent(lat, zoom)
    return F.array(*[F.struct(F.round(lat + high / 2 * sy, 4).alias("lat"), F.round(lng + wide / 2 * sx, 4).alias("lng"),
                              (zoom + 1).alias("zoom")) for sy in (1, -1) for sx in (-1, 1)])


def area_text(prefix: Column, lat: Column, lng: Column, zoom: Column) -> Column:
    """'sweep lat,lng,zz', or 'topup name @lat,lng,zz'."""
    view = F.concat(F.format_string("%.4f", lat), F.lit(","), F.format_string("%.4f", lng), F.lit(","),
                    zoom.cast("string"), F.lit("z"))
    return F.when(prefix == "sweep", F.concat(F.lit("sweep "), view)).otherwise(F.concat(prefix, F.lit(" @"), view))


def prefix_of(area: Column) -> Column:
    return F.when(area.startswith("sweep"), F.substring_index(area, " ", 1)).otherwise(F.substring_index(area, " @", 1))


# ------------------------------------------------------------------------ the log

def current_searches(log: DataFrame) -> DataFrame:
    """The latest state per search. One still running when the log ends never finished: it is pending."""
    last = log.groupBy("source", "term", "area").agg(
        F.max_by(F.struct("status", "raw_count", "error"), F.struct("happened_at", "event_id")).alias("s"),
        F.max(F.when(F.col("status") == "running", F.col("happened_at"))).alias("started_at"),
        F.max(F.when(F.col("status") != "running", F.col("happened_at"))).alias("finished_at"))
    return last.select("source", "term", "area",
                       F.when(F.col("s.status") == "running", "pending").otherwise(F.col("s.status")).alias("status"),
                       "s.raw_count", "s.error", "started_at", "finished_at")


def pending(plan: DataFrame, searches: DataFrame) -> DataFrame:
    """Planned searches that are not done."""
    done = searches.filter("status = 'done'").select("source", "term", "area")
    return plan.join(done, ["source", "term", "area"], "left_anti")


def only(plan: DataFrame, area: str | None = None, term: str | None = None, source: str | None = None) -> DataFrame:
    """A part of the plan: areas that contain a text, one term, one source."""
    if area:
        plan = plan.filter(F.contains("area", F.lit(area)))
    if term:
        plan = plan.filter(F.col("term") == term)
    return plan.filter(F.col("source") == source) if source else plan


def force(log: DataFrame, terms: list[str], areas: list[str], at: Column) -> DataFrame:
    """Events that put all searches of these terms or areas back to pending, to append to the log."""
    hit = F.col("term").isin(terms) | F.col("area").isin(areas)
    return (log.filter(hit).select("source", "term", "area").distinct()
            .select("source", "term", "area", F.lit("pending").alias("status"), F.lit(None).cast("int").alias("raw_count"),
                    F.lit(None).cast("string").alias("error"), at.alias("happened_at")))


def kept_counts(searches: DataFrame, mapped: DataFrame) -> DataFrame:
    """Rows per search that landed inside the catchment; a done search without any has 0.

    `mapped`: source, term, area of the search a record came from, for records inside the catchment.
    """
    counts = mapped.groupBy("source", "term", "area").agg(F.count(F.lit(1)).alias("kept"))
    kept = F.when(F.col("kept").isNotNull(), F.col("kept")).when(F.col("status") == "done", F.lit(0))
    return searches.join(counts, ["source", "term", "area"], "left").withColumn("kept_count", kept).drop("kept")


def search_report(searches: DataFrame) -> DataFrame:
    return searches.orderBy("started_at", "source", "term", "area")


def best_counts(searches: DataFrame) -> DataFrame:
    """Most results seen per term."""
    return searches.filter("status = 'done' and raw_count > 0").groupBy("source", "term").agg(
        F.max("raw_count").alias("best"))


def suspect_results(log: DataFrame) -> DataFrame:
    """Results that look broken: none where the term worked before, or under 4 where it gave over 10.

    The comparison is with the best of all earlier searches of the term, in log order.
    """
    return running_best(log.filter("status = 'done'")).withColumn(
        "signal", F.when((F.col("raw_count") == 0) & (F.col("before") > 0), "empty")
        .when((F.col("before") > 10) & (F.col("raw_count") < 4), "suspect")).filter("signal is not null")


def running_best(done: DataFrame) -> DataFrame:
    """Add `before`: the most results of the term in earlier events. Events are ordered by event_id.

    The log is sorted into parts of about equal size, whatever gaps its ids have, and a term's parts are
    scanned side by side: each starts from the best of the parts before it, of which there is one number
    per term and part. So a term that holds most of the log is spread over all tasks.
    """
    # stored, since a part must stay the same rows for both passes
    placed = materialise(done.repartitionByRange("event_id").withColumn("_part", F.spark_partition_id()), "parts")
    tops = placed.groupBy("term", "_part").agg(F.max("raw_count").alias("_top"))
    earlier = Window.partitionBy("term").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    tops = tops.select("term", "_part", F.max("_top").over(earlier).alias("_carried"))
    inside = Window.partitionBy("term", "_part").orderBy("event_id").rowsBetween(Window.unboundedPreceding, -1)
    scanned = placed.withColumn("_best", F.max("raw_count").over(inside))
    return (scanned.join(tops, (scanned["term"].eqNullSafe(tops["term"])) & (scanned["_part"] == tops["_part"]))
            .select(*[scanned[c] for c in done.columns],
                    F.coalesce(F.greatest("_best", "_carried"), F.lit(0)).alias("before")))


# ------------------------------------------------------------------------ plans

def sweep_plan(terms: DataFrame, sweeps: list[tuple[float, float, int]], source: str = "gmaps_browser") -> DataFrame:
    """Every term in every viewport."""
    views = F.array(*[F.struct(F.lit(i).alias("sweep_ord"), F.lit(f"sweep {la:.4f},{lo:.4f},{z}z").alias("area"))
                      for i, (la, lo, z) in enumerate(sweeps)])
    return terms.withColumn("v", F.explode(views)).select(F.lit(source).alias("source"), "term", "v.area")


def area_sweeps(areas: list[Area], zoom: int = 14) -> list[tuple[float, float, int]]:
    """Without sweeps of its own, a plan looks at the areas' centres."""
    return [(a.centre[0], a.centre[1], zoom) for a in areas if a.centre]


def directory_plan(areas: DataFrame, pages: int) -> DataFrame:
    """One search per area for the area directory, one per page for the paged one."""
    by_area = areas.select(F.lit("directories").alias("source"), F.lit("finelib").alias("term"), "area")
    spark = areas.sparkSession
    paged = spark.range(1, pages + 1).select(F.lit("directories").alias("source"), F.lit("businesslist").alias("term"),
                                            F.concat(F.lit("lagos page "), F.col("id").cast("string")).alias("area"))
    return by_area.unionByName(paged)


def split_searches(searches: DataFrame, box: tuple[float, float, float, float] | None) -> DataFrame:
    """The four quarters of each search (source, term, area) that still can be split, inside the box."""
    lat, lng, zoom = viewport("area")
    views = (searches.select("source", "term", "area", lat.alias("lat"), lng.alias("lng"), zoom.alias("zoom"))
             .filter(F.col("zoom") < MAX_ZOOM))
    kids = views.select("source", "term", prefix_of(F.col("area")).alias("prefix"),
                        F.explode(quadrants(F.col("lat"), F.col("lng"), F.col("zoom"))).alias("q"))
    if box:
        q = F.col("q")
        kids = kids.filter(intersects(bounds(q["lat"], q["lng"], q["zoom"]), box))
    return kids.select("source", "term", area_text(F.col("prefix"), F.col("q.lat"), F.col("q.lng"), F.col("q.zoom")).alias("area")).distinct()


def saturation_plan(searches: DataFrame, box: tuple[float, float, float, float] | None) -> DataFrame:
    """Searches that hit the feed's cap, split; a quarter that hit it too is split again.

    The zoom rises with every round, so the rounds are bounded by the zooms, whatever the data.
    """
    full = searches.filter((F.col("status") == "done") & (F.col("raw_count") >= FEED_CAP)).select("source", "term", "area")
    frontier, plan = full, None
    for _ in range(MAX_ZOOM):
        kids, n_kids = materialise_counting(split_searches(frontier, box), "split", F.lit(True))
        if n_kids == 0:
            break
        plan = kids if plan is None else plan.unionByName(kids)
        frontier = kids.join(full, ["source", "term", "area"], "left_semi")
    return plan.distinct() if plan is not None else full.limit(0)


def top_up_plan(records: DataFrame, terms: DataFrame, areas: list[Area], floors: dict[str, int]) -> DataFrame:
    """Closer searches of every term for areas whose records stay under their floor."""
    wanted = F.array(*[F.struct(F.lit(a.name).alias("name"), F.lit(floors[a.name]).alias("floor"),
                                F.lit(f"topup {a.name} @{a.centre[0]:.4f},{a.centre[1]:.4f},15z").alias("search"))
                       for a in areas if a.name in floors and a.centre])
    counts = records.groupBy(F.col("area").alias("name")).agg(F.count(F.lit(1)).alias("n"))
    grid = terms.select("term", F.explode(wanted).alias("w")).select("term", "w.*")
    return (grid.join(counts, "name", "left").filter(F.coalesce("n", F.lit(0)) < F.col("floor"))
            .select(F.lit("gmaps_browser").alias("source"), "term", F.col("search").alias("area")))
