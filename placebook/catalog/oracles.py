"""The registered queries again, as SQL for DuckDB.

Written from the semantics and not from the Spark code: entity resolution with recursive and unrolled
rounds, survivorship with running-max windows, extraction with plain regular expressions.
"""

from __future__ import annotations

from placebook.areas import CENSUS_AREAS, CENSUS_CORE, KM_PER_DEG_LAT, KM_PER_DEG_LNG, PROSPECT_AREAS
from placebook.catalog import adapters as A
from placebook.functions import contacts as C
from placebook.functions import scoring as SC
from placebook.functions.provenance import SOURCE_KINDS
from placebook.functions.text import BARE_STREET, COMPANY_WORDS, LANDMARK, STREET_WORDS
from placebook.operators.enrich import FREE_CALLS
from placebook.operators.reports import in_display_order
from placebook.schema import (COMPONENTS, CORE_ZONE, MULTI_SOURCE, OUTSIDE, RING_ZONE, SURVIVING_NUMBERS,
                              SURVIVING_TEXT, UNASSIGNED, UNCLASSIFIED_GROUP, UNCLASSIFIED_SUB)
from placebook.taxonomy import LEGACY_FIRST, Taxonomy

T = Taxonomy.starter()


def q(value: object) -> str:
    """A SQL literal."""
    if value is None:
        return "NULL"
    return "'" + str(value).replace("'", "''") + "'" if isinstance(value, str) else str(value)


def values(rows: list[tuple], *names: str) -> str:
    body = ", ".join("(" + ", ".join(q(v) for v in row) + ")" for row in rows)
    return f"(SELECT * FROM (VALUES {body}) v({', '.join(names)}))"


def any_of(items: list[str]) -> str:
    return "(" + ", ".join(q(i) for i in items) + ")"


# ------------------------------------------------------------------------ expressions

def re2(pattern: str) -> str:
    """A pattern without the flags only Java knows."""
    return pattern.replace("(?iU)", "(?i)").replace("(?U)", "")


def phone(x: str) -> str:
    mobile = rf"regexp_extract({x}, '(?:\+?234|0)[\s\-]?([789]\d{{2}}[\s\-]?\d{{3}}[\s\-]?\d{{4}})', 1)"
    digits = rf"regexp_replace({x}, '\D', '', 'g')"
    return (f"CASE WHEN {mobile} <> '' THEN '+234' || regexp_replace({mobile}, '\\D', '', 'g') "
            f"WHEN regexp_matches({digits}, '^0[789].{{9,}}$') THEN '+234' || substr({digits}, 2, 10) "
            f"WHEN regexp_matches({digits}, '^234[789].{{9,}}$') THEN '+234' || substr({digits}, 4, 10) "
            f"WHEN regexp_matches({digits}, '^2341.{{7,8}}$') THEN '+' || {digits} "
            f"WHEN regexp_matches({digits}, '^01.{{7,8}}$') THEN '+234' || substr({digits}, 2) ELSE '' END")


def _norm(x: str, words: list[str]) -> str:
    pattern = r"\b(" + "|".join(words).replace("'", "''") + r")\b"
    return f"trim(regexp_replace(regexp_replace(lower({x}), '{pattern}', ' ', 'g'), '[^a-z0-9]+', ' ', 'g'))"


def nn(x: str) -> str:
    return _norm(x, COMPANY_WORDS)


def ak(x: str) -> str:
    return f"substr({_norm(x, STREET_WORDS)}, 1, 40)"


def street(x: str) -> str:
    return (rf"substr(regexp_replace(trim(split_part({x}, ',', 1)), "
            rf"'(?i)^(shop|suite|plot|block|flat|no\.?)\s*[\w/]*\s*,?\s*', ''), 1, 60)")


def kind(x: str) -> str:
    tests = " ".join("WHEN " + " OR ".join(f"contains(lower({x}), {q(w)})" for w in words) + f" THEN {q(k)}"
                     for k, words in SOURCE_KINDS)
    return f"CASE {tests} ELSE 'manual' END"


def trust(x: str) -> str:
    tests = " ".join(f"WHEN {q(k)} THEN {5 - i}" for i, (k, _) in enumerate(SOURCE_KINDS))
    return f"CASE ({kind(x)}) {tests} END"


def poi(name: str, label: str) -> str:
    return (f"CASE WHEN {label} <> '' THEN '' WHEN regexp_matches({name}, {q(re2(LANDMARK))}) THEN "
            f"'transport landmark, no category label' WHEN regexp_matches({name}, {q(re2(BARE_STREET))}) THEN "
            f"'bare street name, no category label' ELSE '' END")


def month(x: str) -> str:
    return f"strftime(CAST({x} AS date), '%b %Y')"


def dist(lat1: str, lng1: str, lat2: str, lng2: str) -> str:
    return (f"sqrt(pow(({lat1} - {lat2}) * {KM_PER_DEG_LAT}, 2) + "
            f"pow(({lng1} - {lng2}) * {KM_PER_DEG_LNG} * cos(radians({lat2})), 2))")


def names_area(addr: str, area) -> str:
    return f"regexp_matches({addr}, {q('(?i)' + chr(92) + 'b(' + '|'.join(area.names) + ')' + chr(92) + 'b')})"


def zone(x: str, core: list[str]) -> str:
    return (f"CASE WHEN {x} IN ({q(OUTSIDE)}, {q(UNASSIGNED)}) THEN {x} WHEN {x} IN {any_of(core)} "
            f"THEN {q(CORE_ZONE)} ELSE {q(RING_ZONE)} END")


# ------------------------------------------------------------------------ the pipeline, table by table

LISTINGS = f"listings AS ({A.LISTINGS})"

MAPPED = f"""{LISTINGS},
mapped AS (SELECT ord, true_id, name, place_id, addr, lat, lng, label, {phone('phone_raw')} AS phone, website,
  CAST(reviews AS int) AS reviews, rating, source, fetched AS added, {street('addr')} AS street, {nn('name')} AS nn, {ak('addr')} AS ak,
  CASE WHEN place_id <> '' THEN {A.MAP_URL} ELSE '' END AS maps FROM listings)"""


def placed(src: str, areas, core, out: str) -> str:
    """Area, distance and zone: the nearest disc, if it holds the point; else the address."""
    discs = values([(i, a.name, a.lat, a.lng, a.radius_km) for i, a in enumerate(areas)], "o", "a", "la", "lo", "r")
    by_name = " ".join(f"WHEN {names_area('addr', a)} THEN {q(a.name)}" for a in areas)
    return f"""{out}_near AS (SELECT ord, o, a, r, {dist('lat', 'lng', 'la', 'lo')} AS d FROM {src}, {discs} WHERE lat IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY ord ORDER BY d, o) = 1),
{out}_area AS (SELECT m.*, n.d AS distance_km, CASE WHEN n.ord IS NOT NULL THEN CASE WHEN d <= r THEN a ELSE {q(OUTSIDE)} END
  ELSE CASE {by_name} ELSE {q(UNASSIGNED)} END END AS area FROM {src} m LEFT JOIN {out}_near n USING (ord)),
{out} AS (SELECT *, {zone('area', core)} AS zone FROM {out}_area)"""


RULES = values([(i, g, s, k) for i, (g, s, k) in enumerate(T.rules)], "o", "g", "s", "k")
LEGACY = values([(i, c, k.strip()) for i, (c, k) in enumerate(T.legacy)], "o", "c", "k")


def classified(src: str, out: str, label: str = "label", name: str = "name") -> str:
    """Distinct texts meet the rules once; the first rule by order wins."""
    blob = rf"' ' || regexp_replace(replace(lower({label} || ' ' || {name}), '/', ' '), '\s+', ' ', 'g') || ' '"
    early = " ".join(f"WHEN contains(lower({label} || ' ' || {name}), {q(k)}) THEN {q(c)}" for k, c in LEGACY_FIRST)

    def legacy(x: str) -> str:
        return (f"(SELECT {x} AS t, arg_min(c, o) AS c FROM (SELECT DISTINCT {x} FROM {src}), {LEGACY} "
                f"WHERE contains(' ' || replace(replace(lower({x}), '/', ' '), '-', ' ') || ' ', k) GROUP BY 1)")
    return f"""{out}_blob AS (SELECT DISTINCT {blob} AS blob FROM {src}),
{out}_hit AS (SELECT blob, arg_min(g, o) AS g, arg_min(s, o) AS s FROM {out}_blob, {RULES} WHERE contains(blob, k) GROUP BY blob),
{out} AS (SELECT m.*, coalesce(h.g, {q(UNCLASSIFIED_GROUP)}) AS grp, coalesce(h.s, {q(UNCLASSIFIED_SUB)}) AS sub,
  CASE {early} ELSE coalesce(l1.c, l2.c, '') END AS legacy18
  FROM {src} m LEFT JOIN {out}_hit h ON h.blob = {blob}
  LEFT JOIN {legacy(label)} l1 ON l1.t = {label} LEFT JOIN {legacy(name)} l2 ON l2.t = {name})"""


READY = f"{MAPPED},\n{placed('mapped', CENSUS_AREAS, CENSUS_CORE, 'geo')},\n{classified('geo', 'ready')}"


def clusters(src: str, out: str, rounds: int = 4) -> str:
    """Greedy resolution by sets: src needs ord, place_id, phone, nn, ak."""
    parts = [f"""{out}_keys AS (SELECT ord, 0 AS lvl, place_id AS k FROM {src} WHERE nn <> '' AND place_id <> ''
  UNION ALL SELECT ord, 1, phone FROM {src} WHERE nn <> '' AND phone <> ''
  UNION ALL SELECT ord, 2, nn || '|' || ak FROM {src} WHERE nn <> '' UNION ALL SELECT ord, 3, nn FROM {src} WHERE nn <> ''),
{out}_first AS (SELECT ord, lvl, min(ord) OVER (PARTITION BY lvl, k) AS f FROM {out}_keys),
{out}_link AS (SELECT ord, min(f) FILTER (lvl = 0 AND f < ord) AS f0, min(f) FILTER (lvl = 1 AND f < ord) AS f1,
  min(f) FILTER (lvl = 2 AND f < ord) AS f2, min(f) FILTER (lvl = 3 AND f < ord) AS f3, bool_or(lvl = 0) AS has_id FROM {out}_first GROUP BY ord),
{out}_node AS (SELECT *, coalesce(f0, f1, CASE WHEN NOT has_id THEN coalesce(f2, f3) END) AS parent,
  f0 IS NULL AND f1 IS NULL AND has_id AND coalesce(f2, f3) IS NOT NULL AS fresh FROM {out}_link),
{out}_top AS (SELECT ord, ord AS top FROM {out}_node WHERE parent IS NULL
  UNION ALL SELECT n.ord, t.top FROM {out}_node n JOIN {out}_top t ON n.parent = t.ord),
{out}_born AS (SELECT top, min(ord) FILTER (has_id) AS first_id, bool_or(fresh AND ord = top) AS top_fresh FROM {out}_top JOIN {out}_node USING (ord) GROUP BY top),
{out}_door AS (SELECT t.ord, t.top, b.first_id FROM {out}_top t JOIN {out}_born b USING (top) WHERE NOT top_fresh),
{out}_try AS (SELECT n.ord, CASE WHEN coalesce(a.first_id > n.ord, a.top IS NOT NULL) THEN a.top END AS ra,
  CASE WHEN coalesce(b.first_id > n.ord, b.top IS NOT NULL) THEN b.top END AS rb
  FROM {out}_node n LEFT JOIN {out}_door a ON a.ord = n.f2 LEFT JOIN {out}_door b ON b.ord = n.f3 WHERE fresh),
{out}_s0 AS (SELECT ord, coalesce(ra, rb) AS home, CASE WHEN ra IS NOT NULL THEN 2 ELSE 3 END AS via,
  CASE WHEN ra IS NOT NULL AND rb <> ra THEN rb END AS spare FROM {out}_try WHERE coalesce(ra, rb) IS NOT NULL)"""]
    for i in range(rounds):
        parts.append(f"""{out}_w{i} AS (SELECT *, ord = min(ord) OVER (PARTITION BY home) AS won FROM {out}_s{i}),
{out}_s{i + 1} AS (SELECT ord, home, via, spare FROM {out}_w{i} WHERE won
  UNION ALL SELECT ord, spare, 3, NULL FROM {out}_w{i} WHERE NOT won AND spare IS NOT NULL)""")
    parts.append(f"""{out}_home AS (SELECT * FROM {out}_s{rounds} QUALIFY ord = min(ord) OVER (PARTITION BY home)),
{out} AS (SELECT t.ord, coalesce(h.home, t.top) AS cluster, CASE WHEN n.parent IS NULL THEN CASE WHEN h2.ord IS NOT NULL THEN h2.via END
  WHEN f0 IS NOT NULL THEN 0 WHEN f1 IS NOT NULL THEN 1 WHEN f2 IS NOT NULL THEN 2 ELSE 3 END AS via
  FROM {out}_top t JOIN {out}_node n USING (ord) LEFT JOIN {out}_home h ON h.ord = t.top LEFT JOIN {out}_home h2 ON h2.ord = t.ord)""")
    return ",\n".join(parts)


_FIELDS = [f for f in SURVIVING_TEXT if f not in ("whatsapp", "email", "instagram", "facebook", "twitter", "linkedin", "tiktok")]


def filled(f: str, prefix: str = "") -> str:
    return f"{prefix}{f} IS NOT NULL" if f in [*SURVIVING_NUMBERS, "lat", "lng"] else f"{prefix}{f} <> ''"


def survivors(src: str, cl: str, out: str, first_source: str = "source", head: str = "") -> str:
    """Survivorship by windows: a value counts if it is the first, or comes from a more trusted source than all before."""
    fields = [*_FIELDS, *SURVIVING_NUMBERS, "lat", "lng"]
    cand = ", ".join(f"{filled('lat' if f == 'lng' else f)} AND (coalesce(t > before, false) OR ord = min(CASE WHEN "
                     f"{filled('lat' if f == 'lng' else f)} THEN ord END) OVER (PARTITION BY cluster)) AS c_{f}" for f in fields)
    best = ", ".join((f"arg_max({f}, ord) FILTER (c_{f}) AS {f}" if f in [*SURVIVING_NUMBERS, 'lat', 'lng']
                      else f"coalesce(arg_max({f}, ord) FILTER (c_{f}), '') AS {f}") for f in fields)
    return f"""{out}_m AS (SELECT s.*, c.cluster, c.via, CASE WHEN s.ord = c.cluster THEN {trust(first_source)} ELSE {trust('source')} END AS t FROM {src} s JOIN {cl} c USING (ord)),
{out}_run AS (SELECT *, max(t) OVER (PARTITION BY cluster ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM {out}_m),
{out}_cand AS (SELECT *, {cand} FROM {out}_run),
{out}_src AS (SELECT cluster, string_agg(source, '; ' ORDER BY lead DESC, CASE WHEN lead = 1 THEN -first_at ELSE first_at END) AS sources_all, count(*) AS n_sources
  FROM (SELECT cluster, source, min(ord) AS first_at, max(CASE WHEN coalesce(t > before, true) THEN 1 ELSE 0 END) AS lead FROM {out}_run GROUP BY 1, 2) GROUP BY cluster),
{out}_tel AS (SELECT cluster, string_agg(phone, '; ' ORDER BY first_at) AS phones_all FROM
  (SELECT cluster, phone, min(ord) AS first_at FROM {out}_run WHERE phone <> '' GROUP BY 1, 2) GROUP BY cluster),
{out} AS (SELECT g.*, sources_all, coalesce(phones_all, '') AS phones_all, CASE WHEN n_sources > 1 THEN {q(MULTI_SOURCE)} ELSE head_source END AS source
  FROM (SELECT cluster AS ord, arg_min(name, ord) AS name, arg_min(area, ord) AS area, arg_min(zone, ord) AS zone,
    coalesce(arg_min(grp, ord) FILTER (sub <> {q(UNCLASSIFIED_SUB)}), {q(UNCLASSIFIED_GROUP)}) AS grp,
    coalesce(arg_min(sub, ord) FILTER (sub <> {q(UNCLASSIFIED_SUB)}), {q(UNCLASSIFIED_SUB)}) AS sub, arg_min(added, ord) AS added,
    arg_min(source, ord) AS head_source, bool_or({kind('source')} IN ('places_api', 'gmaps')) AS google, count(*) AS n_sightings, {head} {best}
    FROM {out}_cand GROUP BY cluster) g JOIN {out}_src s ON s.cluster = g.ord LEFT JOIN {out}_tel t ON t.cluster = g.ord)"""


def prioritised(src: str, core: list[str], out: str) -> str:
    is_core = f"area IN {any_of(core)}"
    return f"""{out}_kept AS (SELECT * FROM {src} WHERE {poi('name', 'label')} = ''),
{out} AS (SELECT *, CASE WHEN phone <> '' AND {is_core} AND (coalesce(reviews, 0) >= 10 OR website <> '') THEN 'A - High commercial relevance'
    WHEN phone <> '' AND ({is_core} OR coalesce(reviews, 0) >= 25) THEN 'B - Potential advertiser'
    WHEN phone <> '' THEN 'C - Ring area, contactable' ELSE 'D - Listing only (no contact yet)' END AS priority,
  CASE WHEN phone <> '' AND {is_core} AND (coalesce(reviews, 0) >= 10 OR website <> '') THEN 'Premium'
    WHEN phone <> '' AND ({is_core} OR coalesce(reviews, 0) >= 25) THEN 'Standard' ELSE 'Listing' END AS package,
  CASE WHEN phone <> '' THEN 'Yes' ELSE 'No' END AS contactable,
  CASE WHEN google THEN 'Google-verified' WHEN lat IS NOT NULL THEN 'Mapped location (OSM)' ELSE 'Directory listing only' END AS verification,
  CAST(phone <> '' AS int) + CAST(website <> '' AS int) AS contact_channels FROM {out}_kept)"""


CLUSTERED = f"{READY},\n{clusters('ready', 'cl')}"
GOLDEN = f"{CLUSTERED},\n{survivors('ready', 'cl', 'golden')}"
CENSUS = f"{GOLDEN},\n{prioritised('golden', CENSUS_CORE, 'biz')}"


def with_(ctes: str, select: str) -> str:
    return f"WITH RECURSIVE {ctes}\n{select}"


# ------------------------------------------------------------------------ reports

AREA_NAMES = CENSUS_CORE + [a.name for a in CENSUS_AREAS if a.name not in CENSUS_CORE]
AREA_DIM = values([(i, a, CORE_ZONE if a in CENSUS_CORE else RING_ZONE) for i, a in enumerate(AREA_NAMES)]
                  + [(len(AREA_NAMES), OUTSIDE, OUTSIDE), (len(AREA_NAMES) + 1, UNASSIGNED, UNASSIGNED)],
                  "area_ord", "area", "zone")
GROUP_DIM = values(list(enumerate(T.groups)), "group_ord", "grp")
INSIDE = f"zone IN ({q(CORE_ZONE)}, {q(RING_ZONE)})"
PRIO = {k: q(v) for k, v in (("a", "A - High commercial relevance"), ("b", "B - Potential advertiser"),
                             ("c", "C - Ring area, contactable"))}
CENSUS_KPIS = [
    ("total", "true"), ("core", f"zone = {q(CORE_ZONE)}"), ("ring", f"zone = {q(RING_ZONE)}"), ("outside", f"zone = {q(OUTSIDE)}"),
    ("unassigned", f"zone = {q(UNASSIGNED)}"), ("phone", "contactable = 'Yes'"), ("google_verified", "verification = 'Google-verified'"),
    ("prio_a", f"priority = {PRIO['a']}"), ("prio_b", f"priority = {PRIO['b']}"), ("prio_c", f"priority = {PRIO['c']}"),
    ("cross_verified", f"source = {q(MULTI_SOURCE)}")]


def kpi_rows(src: str, kpis: list[tuple[str, str]], name: str = "kpi") -> str:
    return " UNION ALL ".join(f"SELECT {i} AS pos, {q(k)} AS {name}, count(*) FILTER ({t}) AS value FROM {src}"
                              for i, (k, t) in enumerate(kpis))


def total_rows(src: str, ord_col: str, name: str, cols: list[str], last: int) -> str:
    sums = ", ".join(f"CAST(sum({c}) AS bigint) AS {c}" for c in cols)
    return f"""SELECT {ord_col}, {name}, {', '.join(cols)}, CASE WHEN sum(total) OVER () > 0 THEN round(total / (sum(total) OVER ()), 6) ELSE 0 END AS share FROM {src}
UNION ALL SELECT {last}, 'TOTAL', {sums}, CASE WHEN sum(total) > 0 THEN 1.0 ELSE 0 END FROM {src}"""


GROUP_CELLS = f"""cells AS (SELECT group_ord, d.grp, count(b.ord) FILTER (b.zone = {q(CORE_ZONE)}) AS core, count(b.ord) FILTER (b.zone = {q(RING_ZONE)}) AS ring,
  count(b.ord) FILTER (b.{INSIDE}) AS total, count(b.ord) FILTER (b.{INSIDE} AND contactable = 'Yes') AS phone,
  count(b.ord) FILTER (priority = {PRIO['a']}) AS prio_a FROM {GROUP_DIM} d LEFT JOIN biz b ON b.grp = d.grp GROUP BY 1, 2)"""

AREA_CELLS = f"""cells AS (SELECT area_ord, d.area, d.zone, count(b.ord) AS total, count(b.ord) FILTER (contactable = 'Yes') AS phone,
  count(b.ord) FILTER (verification = 'Google-verified') AS google_verified, count(b.ord) FILTER (priority = {PRIO['a']}) AS prio_a,
  count(b.ord) FILTER (priority = {PRIO['b']}) AS prio_b, count(b.ord) FILTER (priority NOT IN ({PRIO['a']}, {PRIO['b']})) AS prio_cd
  FROM {AREA_DIM} d LEFT JOIN biz b ON b.area = d.area GROUP BY 1, 2, 3)"""


def matrix_cells() -> str:
    cols = ", ".join(f"count(b.ord) FILTER (b.area = {q(a)}) AS {chr(34)}{a}{chr(34)}" for a in AREA_NAMES + [OUTSIDE, UNASSIGNED])
    return f"cells AS (SELECT group_ord, d.grp, {cols}, count(b.ord) AS total FROM {GROUP_DIM} d LEFT JOIN biz b ON b.grp = d.grp GROUP BY 1, 2)"


def matrix() -> str:
    cols = [f'"{a}"' for a in AREA_NAMES + [OUTSIDE, UNASSIGNED]] + ["total"]
    sums = ", ".join(f"CAST(sum({c}) AS bigint)" for c in cols)
    return with_(f"{CENSUS}, {matrix_cells()}",
                 f"SELECT group_ord, grp, {', '.join(cols)} FROM cells UNION ALL SELECT {len(T.groups)}, 'TOTAL', {sums} FROM cells")


# ------------------------------------------------------------------------ score

def scored(src: str, out: str) -> str:
    """The score of businesses with attributes derived from the place id (see queries.attributed)."""
    title = "trim(regexp_replace(lower(name), '[^a-z0-9]+', ' ', 'g'))"
    hints = " OR ".join(f"contains(title, {q(h)})" for h in SC.CHAIN_HINTS)
    cat = " ".join(f"WHEN regexp_matches(lower(label || '  ' || name), {q(w)}) THEN {q(c)}" for c, w, _ in SC.CATEGORIES)
    weight = " ".join(f"WHEN {q(c)} THEN {float(w)}" for c, _, w in SC.CATEGORIES)
    points = {
        "delivery_flag": "CASE WHEN ord % 3 = 0 AND ord % 6 <> 3 THEN 25.0 ELSE 0.0 END",
        "no_contact_delivery": "CASE WHEN ord % 9 = 0 THEN 5.0 ELSE 0.0 END",
        "takeout": "CASE WHEN ord % 4 = 1 THEN 5.0 ELSE 0.0 END",
        "delivery_hours": "0.0",
        "catering": "CASE WHEN ord % 10 = 0 OR ord % 7 = 2 THEN 15.0 ELSE 0.0 END",
        "order_volume": "CASE WHEN coalesce(reviews, 0) <> 0 THEN least(25.0, round(log10(reviews + 1) * 9, 1)) ELSE 0.0 END",
        "has_website": "CASE WHEN website <> '' THEN 8.0 ELSE 0.0 END",
        "online_ordering": "CASE WHEN ord % 8 = 3 OR ord % 7 = 2 THEN 7.0 ELSE 0.0 END",
        "chain": f"CASE WHEN {hints} OR (title <> '' AND count(*) OVER (PARTITION BY title) > 1) THEN 10.0 ELSE 0.0 END",
        "category_weight": f"CASE delivery_category {weight} ELSE 0.0 END",
        "rating_4": "CASE WHEN coalesce(rating, 0) >= 4.0 THEN 5.0 ELSE 0.0 END",
    }
    cols = ", ".join(f"CAST({points[c]} AS double) AS {c}" for c, _, _ in COMPONENTS)
    total = " + ".join(c for c, _, _ in COMPONENTS)
    bands = " ".join(f"WHEN score >= {f} THEN {q(n)}" for f, n in SC.BANDS)
    return f"""{out}_n AS (SELECT * REPLACE (CASE WHEN ord % 5 = 0 THEN regexp_replace(name, ' [0-9]+.*$', '') ELSE name END AS name) FROM {src}),
{out}_t AS (SELECT *, {title} AS title, CASE {cat} ELSE 'Other' END AS delivery_category FROM {out}_n),
{out}_p AS (SELECT *, {cols} FROM {out}_t),
{out}_s AS (SELECT *, least(100.0, round({total}, 1)) AS score FROM {out}_p),
{out} AS (SELECT *, CASE {bands} ELSE {q(SC.COLD)} END AS band, CASE WHEN ord % 2 = 0 THEN 'Full' ELSE 'Floor - not enriched' END AS score_basis FROM {out}_s)"""


SCORED = f"{CENSUS},\n{scored('biz', 'sc')},\nprospects AS (SELECT * FROM sc WHERE delivery_category <> 'Other')"
PROSPECT_KPIS = ([("total", "true")] + [(k, f"band = {q(b)}") for k, b in zip(("hot", "warm", "cool", "cold"), SC.BAND_NAMES)]
                 + [("delivery_flag", "delivery_flag > 0"), ("catering", "catering > 0"), ("chain", "chain > 0"), ("phone", "phone <> ''"),
                    ("whatsapp", "false"), ("website", "website <> ''"), ("email", "false"), ("instagram", "false"),
                    ("full_basis", "score_basis = 'Full'")])


# ------------------------------------------------------------------------ pages

def listed(expr: str) -> str:
    return f"array_to_string({expr}, '; ')"


def distinct(expr: str) -> str:
    """Distinct elements at their first places."""
    return f"list_filter({expr}, lambda x, i: list_position({expr}, x) = i)"


def page_tables(src: str) -> str:
    return f"""p0 AS (SELECT *, replace(html, '&amp;', '&') AS t FROM ({src})),
p1 AS (SELECT *, regexp_replace(t, '<[^>]+>', ' ', 'g') AS words,
  regexp_replace(regexp_replace(regexp_replace(t, '(?is)<script\\b.*?</script>', ' ', 'g'), '(?is)<style\\b.*?</style>', ' ', 'g'), '<[^>]+>', ' ', 'g') AS visible FROM p0),
p2 AS (SELECT *, list_filter(list_transform(list_concat(list_transform(regexp_extract_all(t, {q(C.MAILTO)}, 1), lambda m: url_decode(replace(m, '+', '%2B'))),
    regexp_extract_all(words, {q(C.EMAIL)})), lambda e: lower(trim(trim(e), '.'))),
    lambda e: regexp_full_match(e, {q(C.EMAIL)}) AND NOT regexp_matches(e, {q(C.BAD_EMAIL)})) AS e0,
  list_filter(list_transform(regexp_extract_all(t, {q(C.WHATSAPP)}, 1), lambda w: {phone('w')}), lambda w: w <> '') AS w0,
  list_filter(list_transform(list_concat(regexp_extract_all(t, {q(C.TEL_LINK)}, 1), regexp_extract_all(words, '(?:\\+?234|0)[\\s\\-]?[789]\\d{{2}}[\\s\\-]?\\d{{3}}[\\s\\-]?\\d{{4}}')),
    lambda w: {phone('w')}), lambda w: w <> '') AS n0,
  list_transform(regexp_extract_all(visible, {q(C.DELIVERY)}, 1), lambda w: CASE WHEN starts_with(lower(w), 'deliver') THEN 'delivery' ELSE lower(w) END) AS d0,
  regexp_matches(visible, {q(C.ORDER_ONLINE)}) AS order_online FROM p1),
p3 AS (SELECT *, {distinct('e0')} AS emails, {distinct('w0')} AS whatsapp, {distinct('n0')} AS phones, {distinct('d0')} AS delivery FROM p2)"""


# ------------------------------------------------------------------------ merge log

_LOGGED = ["phone", "website", "addr", "place_id"]


def log_tables() -> str:
    """Per sighting that joined a business: the values and the leading source just before it."""
    w = "OVER (PARTITION BY cluster ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    had = ", ".join(f"last_value(CASE WHEN c_{f} THEN {f} END IGNORE NULLS) {w} AS had_{f}" for f in [*_LOGGED, "lat", "lng"])
    return f"""log0 AS (SELECT *, {had}, last_value(CASE WHEN coalesce(t > before, true) THEN source END IGNORE NULLS) {w} AS lead_source,
  first_value(name) OVER (PARTITION BY cluster ORDER BY ord) AS head_name, first_value(source) OVER (PARTITION BY cluster ORDER BY ord) AS head_source,
  t > before AS wins FROM golden_cand),
log1 AS (SELECT *, bool_or(source <> head_source) {w} AS many FROM log0),
log AS (SELECT * FROM log1 WHERE ord <> cluster)"""


def conflict_rows() -> str:
    return " UNION ALL ".join(
        f"SELECT cluster, ord, {q(f)} AS field, CASE WHEN wins THEN {f} ELSE had_{f} END AS kept, "
        f"CASE WHEN wins THEN had_{f} ELSE {f} END AS dropped, CASE WHEN wins THEN lead_source ELSE source END AS dropped_source "
        f"FROM log WHERE {f} <> '' AND had_{f} IS NOT NULL AND had_{f} <> {f}" for f in _LOGGED)


LOG = f"{GOLDEN},\n{log_tables()}"

# two runs as one: numbered scored records first, areas over both registries (the one polygon by its centre)
_BOTH = CENSUS_AREAS + PROSPECT_AREAS
_FIELDS_OUT = ", ".join(f for f in [*_FIELDS, *SURVIVING_NUMBERS, "lat", "lng"])


class _Disc:
    def __init__(self, area):
        self.name, self.names = area.name, area.names
        (self.lat, self.lng), self.radius_km = area.centre, area.radius_km or 0.0


COMBINED = f"""{SCORED},
runs AS (SELECT ord AS old, 0 AS run, CAST(NULL AS double) AS score, name, grp, sub, added, source, sources_all, {_FIELDS_OUT} FROM biz
  UNION ALL SELECT ord, 1, score, name, grp, sub, added, source, sources_all, {_FIELDS_OUT} FROM prospects),
cmb AS (SELECT row_number() OVER (ORDER BY score IS NULL, run, old) AS ord, *, {nn('name')} AS nn, {ak('addr')} AS ak FROM runs),
{placed('cmb', [_Disc(a) for a in _BOTH], CENSUS_CORE, 'cgeo')},
{clusters('cgeo', 'ccl')},
{survivors('cgeo', 'ccl', 'cgold', "split_part(sources_all, '; ', 1)", "arg_min(score, ord) FILTER (ord = cluster) AS score, bool_or(contains(sources_all, 'Google')) AS any_google,")},
csrc AS (SELECT cluster, count(DISTINCT s) AS n FROM (SELECT cluster, unnest(string_split(sources_all, '; ')) AS s FROM cgold_m) GROUP BY 1),
{prioritised('cgold', CENSUS_CORE, 'cbiz')}"""


def served(wishes: str, out: str, rounds: int = 16) -> str:
    """First come, first served by rounds; wishes: ord, rank, choices (a list, best first)."""
    parts = [f"{out}_s0 AS (SELECT ord, rank, choices, 1 AS i FROM {wishes} WHERE len(choices) > 0)"]
    for r in range(rounds):
        parts.append(f"""{out}_w{r} AS (SELECT *, rank = min(rank) OVER (PARTITION BY choices[i]) AS won FROM {out}_s{r}),
{out}_s{r + 1} AS (SELECT ord, rank, choices, CASE WHEN won THEN i ELSE i + 1 END AS i FROM {out}_w{r} WHERE won OR i < len(choices))""")
    parts.append(f"{out} AS (SELECT ord, choices[i] AS phone FROM {out}_s{rounds} QUALIFY rank = min(rank) OVER (PARTITION BY choices[i]))")
    return ",\n".join(parts)


# half-empty census: two of three records have lost their phone (see queries.without_phones)
BLANKED = f"{CENSUS},\nbl AS (SELECT * REPLACE (CASE WHEN ord % 3 = 0 THEN phone ELSE '' END AS phone) FROM biz)"


# ------------------------------------------------------------------------ shapes

def seg_dist(a, b) -> str:
    import math

    squeeze = math.cos(math.radians((a[0] + b[0]) / 2))
    ax, ay = a[1] * KM_PER_DEG_LNG * squeeze, a[0] * KM_PER_DEG_LAT
    dx, dy = b[1] * KM_PER_DEG_LNG * squeeze - ax, b[0] * KM_PER_DEG_LAT - ay
    px, py = f"(lng * {KM_PER_DEG_LNG}e0 * {squeeze!r}e0)", f"(lat * {KM_PER_DEG_LAT}e0)"
    t = f"greatest(0.0, least(1.0, (({px} - {ax!r}e0) * {dx!r}e0 + ({py} - {ay!r}e0) * {dy!r}e0) / {dx * dx + dy * dy!r}e0))"
    return f"sqrt(pow({px} - ({t} * {dx!r}e0 + {ax!r}e0), 2) + pow({py} - ({t} * {dy!r}e0 + {ay!r}e0), 2))"


def in_poly(polygon) -> str:
    edges = [(p, polygon[i - 1]) for i, p in enumerate(polygon)]
    return "(" + " + ".join(
        f"CASE WHEN ({y1}e0 > lat) <> ({y2}e0 > lat) AND lng < {x2 - x1!r}e0 * (lat - {y1}e0) / {y2 - y1!r}e0 + {x1}e0 THEN 1 ELSE 0 END"
        for (y1, x1), (y2, x2) in edges) + ") % 2 = 1"


def poly_dist(area) -> str:
    return f"CASE WHEN {in_poly(area.polygon)} THEN 0.0 ELSE {dist('lat', 'lng', str(area.centre[0]), str(area.centre[1]))} END"


# ------------------------------------------------------------------------ the registered queries

def build() -> dict[str, str]:
    from placebook.catalog import queries as Q

    out: dict[str, str] = {}
    w = with_
    strip_area = "string_split(addr, ', ')[-2]"
    out["clean_phone"] = w(MAPPED, "SELECT ord, phone FROM mapped")
    out["norm_keys"] = w(MAPPED, "SELECT ord, nn, ak FROM mapped")
    out["street"] = w(MAPPED, "SELECT ord, street FROM mapped")
    out["source_trust"] = w(LISTINGS, f"SELECT ord, {kind('source')} AS kind, {trust('source')} AS trust FROM listings")
    odd = (f"CASE ord % 5 WHEN 0 THEN {strip_area} || ' Bus Stop' WHEN 1 THEN name || ' Crescent' "
           "WHEN 2 THEN 'Roundabout ' || name ELSE name END")
    out["poi_filter"] = w(f"{LISTINGS}, o AS (SELECT ord, {odd} AS n, label FROM listings)", f"SELECT ord, {poi('n', 'label')} AS reason FROM o")
    out["classify"] = w(READY, "SELECT ord, grp, sub FROM ready")
    out["legacy_category"] = w(READY, "SELECT ord, legacy18 FROM ready")
    # a row's tagline counts only if it is a directory's, unlabelled and unclassified
    out["classify_from_tagline"] = w(
        f"{READY}, x AS (SELECT ord, name, 'We run a fitness and gym studio no ' || ord AS tag FROM ready WHERE ord % 2 = 0 AND "
        f"label = '' AND sub = {q(UNCLASSIFIED_SUB)} AND {kind('source')} = 'directory'),\n{classified('x', 'again', 'tag')}",
        "SELECT ord, coalesce(a.grp, r.grp) AS grp, coalesce(a.sub, r.sub) AS sub FROM ready r LEFT JOIN again a USING (ord)")
    slug = "regexp_replace(regexp_replace(lower(x), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g')"
    out["area_slugs"] = w(
        f"{LISTINGS}, a AS (SELECT DISTINCT {strip_area} || ' / ' || label AS area FROM listings), "
        "b AS (SELECT area, list_concat(list_filter(list_transform(string_split(area, '/'), lambda x: trim(x)), lambda x: x <> ''), ['Lekki Ph 1']) AS l FROM a), "
        f"c AS (SELECT area, list_transform(l, lambda x: {slug}) AS l FROM b)",
        f"SELECT area, {listed(distinct('l'))} AS slugs FROM c")

    # geography
    out["assign_area"] = w(f"{MAPPED}, {placed('mapped', CENSUS_AREAS, CENSUS_CORE, 'geo')}",
                           "SELECT ord, area, zone, round(distance_km, 6) AS distance_km FROM geo")
    c, p, disc, _ = Q.MIXED
    out["assign_mixed_areas"] = w(
        f"{MAPPED}, d AS (SELECT *, {seg_dist(*c.corridor[:2])} AS d0, {poly_dist(p)} AS d1, {in_poly(p.polygon)} AS in1, "
        f"{dist('lat', 'lng', str(disc.lat), str(disc.lng))} AS d2 FROM mapped)",
        f"""SELECT ord, round(least(d0, d1, d2), 6) AS distance_km, CASE WHEN lat IS NULL THEN CASE WHEN {names_area('addr', c)} THEN {q(c.name)}
  WHEN {names_area('addr', p)} THEN {q(p.name)} WHEN {names_area('addr', disc)} THEN {q(disc.name)} WHEN {names_area('addr', Q.MIXED[3])} THEN 'Ikeja' ELSE {q(UNASSIGNED)} END
  WHEN d0 <= d1 AND d0 <= d2 AND d0 <= {c.corridor[2] / 2} THEN {q(c.name)} WHEN NOT (d0 <= d1 AND d0 <= d2) AND d1 <= d2 AND in1 THEN {q(p.name)}
  WHEN d2 < d0 AND d2 < d1 AND d2 <= {disc.radius_km} THEN {q(disc.name)} WHEN {names_area('addr', Q.MIXED[3])} THEN 'Ikeja' ELSE {q(OUTSIDE)} END AS area FROM d""")
    out["corridor_test"] = w(MAPPED, f"SELECT ord, round({seg_dist(*c.corridor[:2])}, 6) AS distance_km, {seg_dist(*c.corridor[:2])} <= 1.0 AS inside FROM mapped WHERE lat IS NOT NULL")
    out["polygon_test"] = w(MAPPED, f"SELECT ord, round({poly_dist(p)}, 6) AS distance_km, {in_poly(p.polygon)} AS inside FROM mapped WHERE lat IS NOT NULL")
    by_name = " ".join(f"WHEN {names_area('addr', a)} THEN {q(a.name)}" for a in CENSUS_AREAS)
    out["address_area"] = w(LISTINGS, f"SELECT ord, CASE {by_name} ELSE '' END AS area FROM listings")
    votes = " UNION ALL ".join(f"SELECT {q(a.name)} AS area, lat, lng FROM listings WHERE lat IS NOT NULL AND source LIKE 'Google%' AND {names_area('addr', a)}"
                               for a in CENSUS_AREAS)
    names = values([(a.name,) for a in CENSUS_AREAS], "area")
    cent = (f"{LISTINGS}, votes AS ({votes}), cent AS (SELECT d.area, count(v.lat) AS n, round(median(v.lat), 5) AS lat, round(median(v.lng), 5) AS lng, "
            f"CASE WHEN count(v.lat) > 0 THEN count(v.lat) < 15 END AS low_confidence FROM {names} d LEFT JOIN votes v USING (area) GROUP BY 1)")
    out["derive_centroids"] = w(cent, "SELECT * FROM cent")
    dlat, dlng = f"1.3 / {KM_PER_DEG_LAT}", f"1.3 / ({KM_PER_DEG_LNG} * cos(radians(lat)))"
    out["catchment_box"] = w(
        f"{cent}, box AS (SELECT min(lat - {dlat}) AS s, min(lng - {dlng}) AS w, max(lat + {dlat}) AS n, max(lng + {dlng}) AS e FROM cent WHERE n > 0)",
        f"SELECT round(s - 2.0 / {KM_PER_DEG_LAT}, 5) AS south, round(w - 2.0 / ({KM_PER_DEG_LNG} * cos(radians((s + n) / 2))), 5) AS west, "
        f"round(n + 2.0 / {KM_PER_DEG_LAT}, 5) AS north, round(e + 2.0 / ({KM_PER_DEG_LNG} * cos(radians((s + n) / 2))), 5) AS east FROM box")
    out["geo_stats"] = w(f"{MAPPED}, {placed('mapped', CENSUS_AREAS, CENSUS_CORE, 'geo')}", "SELECT area, count(*) AS n FROM geo GROUP BY 1")

    # sources
    fixed = "'+2348025551234'"
    csv = (f"SELECT ord, name, addr, street, label, CASE WHEN phone <> '' THEN phone ELSE {fixed} END AS phone, "
           f"CASE WHEN phone <> '' AND phone <> {fixed} THEN phone || '; ' || {fixed} ELSE {fixed} END AS phones_all, website, "
           "CASE WHEN ord % 2 = 1 THEN CAST(CAST(lat AS decimal(9,4)) AS string) END AS lat, true AS no_lng, "
           "CASE WHEN ord % 9 = 0 THEN 'Do Not Contact' ELSE 'Not Contacted' END AS sales_status, 'Manual CSV (walk.csv)' AS source, added "
           "FROM mapped WHERE ord % 34 <> 0")
    out["csv_records"] = w(MAPPED, csv)
    elements = f"{LISTINGS}, el AS ({A.ELEMENTS})"
    from placebook.operators.centroids import catchment_box

    s, west, n, e = catchment_box(CENSUS_AREAS, 0.0)
    box = f"lat BETWEEN {s} AND {n} AND lon BETWEEN {west} AND {e}"
    census_sel = "t_shop <> '' OR (type = 'node' AND (regexp_matches(t_amenity, 'restaurant|cafe|fast_food|pharmacy|bank|school|place_of_worship') OR t_office <> ''))"
    prospect_sel = "regexp_matches(t_amenity, '^(restaurant|cafe|fast_food|food_court|pharmacy)$') OR regexp_matches(t_shop, '^(supermarket|convenience|bakery|greengrocer|chemist|deli|general|beverages|butcher)$')"
    out["osm_selection"] = w(elements, f"SELECT ord, {census_sel} AS census, {prospect_sel} AS prospects FROM el WHERE {box} AND (({census_sel}) OR ({prospect_sel}))")
    el2 = (f"{elements}, e2 AS (SELECT *, trim(CASE WHEN t_name <> '' THEN t_name WHEN t_name_en <> '' THEN t_name_en ELSE t_brand END) AS name, "
           "list_filter([" + ", ".join(f"CASE WHEN {x} = '' THEN '' ELSE {phone(x)} END" for x in ("split_part(t_phone, ';', 1)", "split_part(t_phone, ';', 2)", "t_mobile"))
           + "], lambda x: x <> '') AS ph FROM el), "
           f"osm AS (SELECT ord, name, round(lat, 6) AS lat, round(lon, 6) AS lng, t_house || ' ' || t_street || CASE WHEN t_suburb <> '' THEN ', ' || t_suburb ELSE '' END || ', ' || t_city AS addr, "
           "t_street AS street, CASE WHEN t_shop = 'yes' THEN 'shop' WHEN t_shop <> '' THEN 'general store' WHEN t_amenity <> '' THEN replace(t_amenity, '_', ' ') ELSE t_office END AS label, "
           f"coalesce(ph[1], '') AS phone, {listed(distinct('ph'))} AS phones_all, t_website AS website, 'https://www.openstreetmap.org/' || type || '/' || id AS maps, "
           f"'OpenStreetMap (' || {month('fetched')} || ')' AS source, fetched AS added, CASE WHEN t_hours <> '' THEN 'Opening hours (OSM): ' || t_hours ELSE '' END AS notes FROM e2 WHERE name <> '')")
    out["osm_records"] = w(el2, "SELECT * FROM osm")
    cards = (f"{LISTINGS}, cd AS ({A.CARDS}), c2 AS (SELECT *, CASE WHEN label = '' THEN addr ELSE label END AS l2, CASE WHEN label = '' THEN '' ELSE addr END AS a2 FROM cd), "
             f"cards AS (SELECT ord, aria AS name, '0x1:0x' || true_id AS place_id, round(6 + (5600 + (true_id * 13) % 900 - 450) / 10000.0, 4) AS lat, "
             f"round(3 + (3700 + (true_id * 29) % 900 - 450) / 10000.0, 4) AS lng, a2 AS addr, {street('a2')} AS street, l2 AS label, {phone('phone_raw')} AS phone, "
             "CASE WHEN ord % 5 = 0 THEN '' ELSE website END AS website, CASE WHEN ord % 3 <> 0 THEN 3 + true_id % 2 + (true_id % 10) / 10.0 END AS rating, "
             "CAST(CASE WHEN ord % 3 <> 2 THEN (true_id * 17) % 500 WHEN true_id > 99 THEN (true_id % 9 + 1) * 1000 + true_id % 1000 ELSE true_id END AS int) AS reviews, "
             f"'Google Maps (sweep, ' || {month('fetched')} || ')' AS source, fetched AS added FROM c2)")
    out["card_records"] = w(cards, "SELECT * FROM cards")
    dirs = (f"{LISTINGS}, d0 AS ({A.DIRECTORY_ROWS}), dl AS (SELECT ord, site, page_no, name, listing_id, addr, trim(phone_raw) AS phone, "
            "CASE WHEN site = 'finelib' THEN '' ELSE lat_text END AS lat, CASE WHEN site = 'finelib' THEN '' ELSE '3.37' END AS lng, tagline AS \"desc\", "
            "site <> 'finelib' AND sponsored AS sponsored, CASE WHEN site = 'finelib' THEN 'page ' || page_no ELSE '' END AS category, "
            "page_no * 1000 + row_number() OVER (PARTITION BY site, page_no ORDER BY ord) - 1 AS seq FROM d0), "
            "ok AS (SELECT * FROM dl WHERE NOT sponsored OR page_no = 1)")
    out["directory_listings"] = w(dirs, 'SELECT site, page_no, name, listing_id, addr, phone, lat, lng, "desc", sponsored, category FROM dl')
    out["directory_records"] = w(
        f"{dirs}, last AS (SELECT * FROM ok QUALIFY seq = max(seq) OVER (PARTITION BY site, listing_id))",
        f"""SELECT name, addr, category AS label, {phone('phone')} AS phone, TRY_CAST(lat AS double) AS lat, TRY_CAST(lng AS double) AS lng, substr("desc", 1, 300) AS notes,
  CASE WHEN site = 'finelib' THEN 'Finelib (Oct 2026)' ELSE 'BusinessList.com.ng (Oct 2026)' END AS source, '2026-10-06' AS added,
  CASE WHEN site = 'finelib' THEN 'https://www.finelib.com/listing/x/' || listing_id || '/' ELSE 'https://www.businesslist.com.ng/company/' || listing_id || '/x' END AS maps FROM last""")
    fl = "'https://www.finelib.com/cities/lagos/areas-and-suburbs/anthony-village/page-' || page_no"
    out["directory_links"] = w(dirs, f"SELECT DISTINCT {fl} AS url, {fl} || '/health-services' AS link FROM dl WHERE site = 'finelib'")
    out["broken_pages"] = w(dirs, "SELECT DISTINCT 'https://www.businesslist.com.ng/location/lagos/' || page_no AS url FROM dl WHERE site = 'businesslist' AND page_no % 5 = 0")
    out["sponsored_rows"] = w(dirs, "SELECT site, page_no, count(*) AS n, count(*) FILTER (sponsored) AS n_sponsored FROM ok GROUP BY 1, 2")
    out["unique_in_crawl"] = w(dirs, "SELECT site, listing_id, arg_max(name, seq) AS name, arg_max(phone, seq) AS phone, min(seq) AS first_ord FROM dl GROUP BY 1, 2")
    out["latest_listing"] = w(
        f"{LISTINGS}, r AS (SELECT ord, CASE WHEN ord % 5 = 1 THEN '' ELSE CAST(true_id AS string) END AS listing_id, name, phone_raw FROM listings WHERE source LIKE 'Finelib%')",
        "SELECT * FROM r WHERE listing_id = '' UNION ALL (SELECT * FROM r WHERE listing_id <> '' QUALIFY ord = max(ord) OVER (PARTITION BY listing_id))")
    details = (f"{LISTINGS}, dt AS (SELECT DISTINCT true_id AS k, '0x1:0x' || true_id AS key FROM listings WHERE source LIKE 'Google%'), "
               "det AS (SELECT key, CASE WHEN k % 3 <> 1 THEN '+234806' || lpad(CAST(k % 500 AS string), 7, '0') ELSE '' END AS phone, "
               "CASE WHEN k % 7 = 0 THEN 'http://site' || k || '.example/' ELSE '' END AS website, (k % 200 + 1) || ' Fixture Road, Anthony Village, Ikeja, Lagos' AS addr, "
               "CASE WHEN k % 4 = 2 THEN 'https://order.example/' || k ELSE '' END AS order_url, CASE WHEN k % 10 = 0 THEN false WHEN k % 2 = 0 THEN true END AS delivery, "
               "CASE WHEN k % 9 = 0 THEN true END AS no_contact, CASE WHEN k % 3 = 0 THEN true END AS takeout, true AS dine_in, CASE WHEN k % 6 = 0 THEN true END AS catering FROM dt)")
    out["place_details_parsed"] = w(details, "SELECT * FROM det")
    answers = f"{LISTINGS}, aa AS ({A.API_ANSWERS}), api AS (SELECT place_key AS key, intl, web, n_ratings, stars, national FROM aa WHERE fetched_at = 2)"
    out["api_answers_latest"] = w(answers, "SELECT key, intl, web, n_ratings, stars FROM api")
    out["raw_round_trip"] = w(
        f"{LISTINGS}, r AS (SELECT CASE WHEN source LIKE 'Open%' THEN 0 WHEN source LIKE 'Google%' THEN 1 WHEN source LIKE 'Manual%' THEN 2 ELSE 3 END AS rank, ord AS raw_id, source, name FROM listings)",
        "SELECT row_number() OVER (ORDER BY rank, raw_id % 2, raw_id) AS ord, raw_id, source, name FROM r")
    out["source_union"] = w(
        f"{MAPPED}, el AS ({A.ELEMENTS}), {el2.split('el AS (', 1)[1].split('), e2 AS', 1)[1].join(['e2 AS', ''])}, "
        f"{cards.split(', cd AS', 1)[1].join(['cd AS', ''])}, csvr AS ({csv}), {dirs.split(', d0 AS', 1)[1].join(['d0 AS', ''])}, "
        "latest AS (SELECT * FROM ok QUALIFY seq = max(seq) OVER (PARTITION BY site, listing_id))",
        f"SELECT source, count(*) AS n, count(*) FILTER (phone <> '') AS with_phone FROM (SELECT source, phone FROM osm UNION ALL SELECT source, phone FROM cards UNION ALL SELECT source, phone FROM csvr "
        f"UNION ALL SELECT CASE WHEN site = 'finelib' THEN 'Finelib (Oct 2026)' ELSE 'BusinessList.com.ng (Oct 2026)' END, {phone('phone')} FROM latest) GROUP BY 1")

    out["unmappable_rows"] = w(LISTINGS, "SELECT source, raw, raw - gone AS mapped, gone AS unmappable FROM (SELECT 'osm' AS source, count(*) AS raw, count(*) FILTER (ord % 13 = 0) AS gone FROM listings "
                                         "UNION ALL SELECT 'gmaps_browser', count(*) FILTER (source LIKE 'Google%'), 0 FROM listings UNION ALL SELECT 'manual_csv', count(*), count(*) FILTER (ord % 34 = 0) FROM listings)")

    # entity resolution
    out["dedupe_clusters"] = w(CLUSTERED, "SELECT ord, cluster, via FROM cl")
    out["survivorship"] = w(GOLDEN, "SELECT ord, name, grp, sub, phone, website, addr, street, label, legacy18, place_id, maps, rating, reviews, "
                                    "round(lat, 6) AS lat, round(lng, 6) AS lng, area, zone, n_sightings FROM golden")
    out["provenance"] = w(GOLDEN, "SELECT ord, source, sources_all, phones_all FROM golden")
    out["merge_conflicts"] = w(LOG, conflict_rows())
    out["coordinate_conflicts"] = w(LOG, f"SELECT cluster, ord, lead_source AS dropped_source FROM log WHERE wins AND lat IS NOT NULL AND had_lat IS NOT NULL AND {dist('lat', 'lng', 'had_lat', 'had_lng')} > 0.2")
    out["merge_decisions"] = w(LOG, f"""SELECT ord, 'merged' AS action, ['pid', 'p', 'na', 'n'][via + 1] AS key,
  CASE via WHEN 0 THEN place_id WHEN 1 THEN phone WHEN 2 THEN nn || '|' || ak ELSE nn END AS key_value, cluster, head_name AS kept_name,
  CASE WHEN many THEN {q(MULTI_SOURCE)} ELSE head_source END AS kept_source, coalesce(had_addr, '') AS kept_addr, name AS merged_name,
  source AS merged_source, addr AS merged_addr FROM log
UNION ALL SELECT ord, 'dropped', NULL, NULL, NULL, NULL, NULL, NULL, name, source, NULL FROM ready WHERE nn = ''""")
    out["dedupe_stats"] = w(f"{LOG}, {prioritised('golden', CENSUS_CORE, 'biz')}, cf AS ({conflict_rows()})",
                            "SELECT 'in' AS what, count(*) AS n FROM cl UNION ALL SELECT 'merged', count(via) FROM cl UNION ALL SELECT 'kept', count(*) FROM biz UNION ALL SELECT 'conflicts', count(*) FROM cf")
    out["combine_runs"] = w(COMBINED, f"SELECT b.ord, name, place_id, phone, area, zone, priority, score, CASE WHEN n_sightings > 1 AND n > 1 THEN {q(MULTI_SOURCE)} ELSE head_source END AS source, "
                                      "n_sightings FROM cbiz b JOIN csrc c ON c.cluster = b.ord")

    # census
    out["priority"] = w(CENSUS, "SELECT ord, priority, package, contactable, verification, contact_channels FROM biz")
    out["census_by_group"] = w(f"{CENSUS}, {GROUP_CELLS}", total_rows("cells", "group_ord", "grp", ["core", "ring", "total", "phone", "prio_a"], len(T.groups)))
    out["census_kpis"] = w(CENSUS, kpi_rows("biz", CENSUS_KPIS))
    acols = ["total", "phone", "google_verified", "prio_a", "prio_b", "prio_cd"]
    out["area_summary"] = w(f"{CENSUS}, {AREA_CELLS}, rows_ AS ({total_rows('cells', 'area_ord', 'area', acols, len(AREA_NAMES) + 2)})",
                            "SELECT r.*, coalesce(c.zone, '') AS zone FROM rows_ r LEFT JOIN cells c ON c.area = r.area")
    out["group_area_matrix"] = matrix()
    tree = values([(g, s) for g, s in T.tree], "grp", "sub")
    out["tree_coverage"] = w(
        f"{CENSUS}, used AS (SELECT grp, sub, count(*) AS found, count(*) FILTER (zone = {q(CORE_ZONE)}) AS core, count(*) FILTER (zone = {q(RING_ZONE)}) AS ring FROM biz GROUP BY 1, 2), "
        f"every AS (SELECT grp, sub FROM {tree} UNION SELECT grp, sub FROM used)",
        f"""SELECT grp, sub, (grp, sub) IN (SELECT (grp, sub) FROM {tree}) AS in_tree, coalesce(found, 0) AS found, coalesce(core, 0) AS core, coalesce(ring, 0) AS ring,
  CASE WHEN coalesce(found, 0) = 0 THEN 'No matches yet' WHEN found < 5 THEN 'Thin' WHEN found < 20 THEN 'Covered' ELSE 'Well covered' END AS status FROM every LEFT JOIN used USING (grp, sub)""")
    out["subs_outside_tree"] = w(CENSUS, f"SELECT grp, sub FROM biz EXCEPT SELECT grp, sub FROM {tree}")
    out["research_matrix"] = w(
        f"{CENSUS}, grid AS (SELECT area_ord, area, zone, group_ord, grp, CASE WHEN zone = {q(CORE_ZONE)} THEN 30 ELSE 15 END AS target FROM {AREA_DIM} a, {GROUP_DIM} g WHERE a.zone IN ({q(CORE_ZONE)}, {q(RING_ZONE)})), "
        "f AS (SELECT area, grp, count(*) AS found FROM biz GROUP BY 1, 2)",
        "SELECT area_ord, group_ord, area, zone, grp, coalesce(found, 0) AS found, target, greatest(0, target - coalesce(found, 0)) AS gap, round(least(1.0, coalesce(found, 0) / target), 6) AS coverage, "
        "CASE WHEN coalesce(found, 0) >= target THEN 'Maintain - re-check quarterly' ELSE 'Canvass ' || area || ' for ' || grp END AS next_action FROM grid LEFT JOIN f USING (area, grp)")
    src = f"{CENSUS}, src AS (SELECT unnest(string_split(sources_all, '; ')) AS source FROM biz)"
    out["source_log"] = w(src, "SELECT source, count(*) AS records FROM src GROUP BY 1")
    out["source_mentions"] = w(src, f"SELECT {kind('source')} AS kind, count(*) AS mentions FROM src GROUP BY 1")
    out["channel_counts"] = w(CENSUS, kpi_rows("biz", [("website", "website <> ''"), ("email", "false"), ("whatsapp", "false"), ("instagram", "false"), ("facebook", "false")], "channel"))
    out["summary_counts"] = w(CENSUS, "SELECT 'area' AS \"by\", area AS value, count(*) AS n, count(*) FILTER (phone <> '') AS contactable FROM biz GROUP BY 2 "
                                      "UNION ALL SELECT 'group', grp, count(*), count(*) FILTER (phone <> '') FROM biz GROUP BY 2")
    out["top_unclassified"] = w(READY, f"SELECT CASE WHEN label = '' THEN '(no label)' ELSE label END AS label, count(*) AS n FROM ready WHERE sub = {q(UNCLASSIFIED_SUB)} GROUP BY 1 ORDER BY n DESC, label LIMIT 20")
    magazine = any_of([a.name for a in CENSUS_AREAS])
    out["census_list"] = w(CENSUS, f"""SELECT row_number() OVER (ORDER BY CASE WHEN zone = {q(CORE_ZONE)} THEN 0 ELSE 1 END, area, grp, sub, lower(name), ord) AS id, name, zone, area, grp, sub,
  nullif(phone, '') AS phone, CASE WHEN area IN {magazine} THEN 'Magazine catchment' END AS programme, sources_all AS sources, priority FROM biz""")

    # score
    comps = ", ".join(c for c, _, _ in COMPONENTS)
    out["delivery_score"] = w(SCORED, f"SELECT ord, delivery_category, {comps}, round(score, 1) AS score, band, score_basis FROM sc")
    out["chain_names"] = w(SCORED, "SELECT title, count(*) AS n_title FROM sc WHERE title <> '' GROUP BY 1 HAVING count(*) > 1")
    out["scope_filter"] = w(SCORED, "SELECT delivery_category <> 'Other' AS in_scope, count(*) AS n FROM sc GROUP BY 1")
    out["bands_and_basis"] = w(SCORED, "SELECT band AS value, count(*) AS n FROM prospects GROUP BY 1 UNION ALL SELECT score_basis, count(*) FROM prospects GROUP BY 1")
    out["prospect_kpis"] = w(SCORED, kpi_rows("prospects", PROSPECT_KPIS))
    out["component_counts"] = w(SCORED, " UNION ALL ".join(f"SELECT {i} AS pos, {q(label)} AS component, {most} AS max_points, count(*) FILTER ({c} > 0) AS prospects FROM prospects"
                                                           for i, (c, label, most) in enumerate(COMPONENTS)))
    cats = in_display_order()
    cells = ", ".join(f'count(p.ord) FILTER (delivery_category = {q(x)}) AS "{x}"' for x in cats)
    ring_dim = values([(i, a.name) for i, a in enumerate(CENSUS_AREAS)] + [(len(CENSUS_AREAS), OUTSIDE), (len(CENSUS_AREAS) + 1, UNASSIGNED)], "area_ord", "area")
    quoted = ", ".join(f'"{x}"' for x in cats)
    out["area_category"] = w(
        f"{SCORED}, cells AS (SELECT area_ord, d.area, {cells}, count(p.ord) AS total, count(p.ord) FILTER (band = {q(SC.BAND_NAMES[0])}) AS hot FROM {ring_dim} d LEFT JOIN prospects p ON p.area = d.area GROUP BY 1, 2)",
        f"SELECT area_ord, area, {quoted}, total, hot FROM cells UNION ALL SELECT {len(CENSUS_AREAS) + 2}, 'TOTAL', " + ", ".join(f'CAST(sum("{x}") AS bigint)' for x in [*cats, "total", "hot"]) + " FROM cells")
    out["prospect_list"] = w(SCORED, "SELECT row_number() OVER (ORDER BY score DESC, area, lower(name), ord) AS rank, name, area, score, band, takeout, nullif(phone, '') AS phone, nullif(phones_all, '') AS all_phones FROM prospects")

    # pages and enrichment
    page = page_tables(A.PAGES_WITH_CONTACTS)
    out["emails"] = w(page, f"SELECT page_id, {listed('emails')} AS emails FROM p3")
    out["whatsapp_numbers"] = w(page, f"SELECT page_id, {listed('whatsapp')} AS whatsapp FROM p3")
    out["page_phones"] = w(page, f"SELECT page_id, {listed('phones')} AS phones FROM p3")
    out["delivery_signals"] = w(page, f"SELECT page_id, {listed('delivery')} AS delivery, order_online FROM p3")
    out["social_profiles"] = w(page, f"SELECT page_id, {listed(distinct('ig'))} AS instagram, 'https://www.facebook.com/shop.' || page_id AS facebook, "
                                     f"'https://x.com/shop_' || (page_id % 100000) AS twitter, '' AS linkedin, '' AS tiktok FROM "
                                     f"(SELECT page_id, list_transform(regexp_extract_all(t, {q(C.INSTAGRAM)}, 1), lambda h: 'https://www.instagram.com/' || rtrim(h, '.')) AS ig FROM p3)")
    ranks = " ".join(f"WHEN {q(x)} THEN {i}" for i, x in enumerate(["/", "/contact", "/contact-us", "/about", "/order", "/delivery"]))
    sites = (f"{page_tables(A.SITE_PAGES)}, s1 AS (SELECT *, CASE path {ranks} END AS rank FROM p3 QUALIFY html = max(html) OVER (PARTITION BY website, path)), "
             "s3 AS (SELECT * FROM s1), "
             + "s4 AS (SELECT website, " + ", ".join(f"flatten(list({x} ORDER BY rank)) AS {x}" for x in ("emails", "phones", "whatsapp", "delivery"))
             + ", list_distinct([1]) AS one, bool_or(order_online OR path = '/order') AS order_online, "
             f"flatten(list(list_transform(regexp_extract_all(t, {q(C.INSTAGRAM)}, 1), lambda h: 'https://www.instagram.com/' || rtrim(h, '.')) ORDER BY rank)) AS ig FROM s3 GROUP BY 1), "
             "site AS (SELECT website, " + ", ".join(f"{distinct(x)} AS {x}" for x in ("emails", "phones", "whatsapp", "delivery")) + ", order_online, ig[1] AS instagram FROM s4)")
    out["site_contacts"] = w(sites, f"SELECT website, {listed('emails')} AS emails, {listed('phones')} AS phones, {listed('whatsapp')} AS whatsapp, {listed('delivery')} AS delivery, order_online FROM site")
    out["social_websites"] = w(LISTINGS, "SELECT ord, ord % 6 IN (0, 1, 2, 5) AS social FROM listings")
    site_sort = f"CASE zone WHEN {q(CORE_ZONE)} THEN 0 WHEN {q(RING_ZONE)} THEN 1 ELSE 2 END, -coalesce(reviews, 0), ord"
    out["site_candidates"] = w(CENSUS, f"SELECT ord, website, reviews FROM biz WHERE website <> '' ORDER BY {site_sort} LIMIT 100")
    out["phone_guard"] = w(
        f"{BLANKED}, wish AS (SELECT ord, ord AS rank, list_filter(list_transform([ord % 40, ord % 60, ord % 90], lambda k: '+234809' || lpad(CAST(k AS string), 7, '0')), "
        f"lambda x: NOT list_contains(used, x)) AS choices FROM bl, (SELECT list(DISTINCT phone) AS used FROM bl) WHERE phone = ''), {served('wish', 'got')}", "SELECT ord, phone FROM got")
    out["apply_site_contacts"] = w(
        f"{BLANKED}, {sites}, want AS (SELECT b.ord, row_number() OVER (ORDER BY {site_sort}) AS rank, b.phone AS own, s.* FROM bl b JOIN site s USING (website) WHERE b.website <> ''), "
        f"wish AS (SELECT ord, rank, list_filter(phones, lambda x: NOT list_contains(used, x)) AS choices FROM want, (SELECT list(DISTINCT phone) AS used FROM bl) WHERE own = ''), {served('wish', 'got')}, "
        "j AS (SELECT b.ord, array_to_string(list_slice(emails, 1, 3), '; ') AS email, coalesce(nullif(b.phone, ''), g.phone, '') AS phone, w.whatsapp[1] AS whatsapp, w.instagram, b.website, w.ord IS NOT NULL AS hit, "
        "CASE WHEN w.ord IS NULL THEN string_split(b.phones_all, '; ') ELSE list_concat([b.phone], string_split(b.phones_all, '; '), w.phones) END AS ph, "
        "CASE WHEN w.ord IS NULL THEN [] ELSE list_concat(w.delivery, CASE WHEN w.order_online THEN ['online ordering'] ELSE [] END) END AS sg, b.contact_channels AS ch "
        "FROM bl b LEFT JOIN want w USING (ord) LEFT JOIN got g USING (ord)), l AS (SELECT *, list_filter(ph, lambda x: x <> '') AS p2 FROM j)",
        f"SELECT ord, coalesce(email, '') AS email, phone, coalesce(whatsapp, '') AS whatsapp, coalesce(instagram, '') AS instagram, {listed(distinct('p2'))} AS phones_all, {listed('sg')} AS signals, "
        "CASE WHEN hit THEN CAST(phone <> '' AS int) + CAST(website <> '' AS int) + CAST(coalesce(email, '') <> '' AS int) + CAST(coalesce(instagram, '') <> '' AS int) + 1 ELSE ch END AS contact_channels FROM l")   # every page has a profile of the second network
    out["detail_candidates"] = w(
        f"{SCORED}, {details.split(', dt AS', 1)[1].join(['dt AS', ''])}, cand AS (SELECT ord, place_id AS key, reviews FROM prospects WHERE maps LIKE 'https://www.google.com/maps/place/%' "
        f"AND area NOT IN ({q(OUTSIDE)}, {q(UNASSIGNED)}) AND place_id NOT IN (SELECT key FROM det WHERE order_url <> ''))",
        "SELECT * FROM cand ORDER BY reviews DESC NULLS LAST, ord LIMIT 100")
    out["api_candidates"] = w(
        f"{CENSUS}, {answers.split(', aa AS', 1)[1].join(['aa AS', ''])}, best AS (SELECT ord, regexp_extract(maps, '!19s(ChIJ[\\w\\-]+)', 1) AS key, reviews FROM biz WHERE maps LIKE '%!19sChIJ%' AND area NOT IN ({q(OUTSIDE)}, {q(UNASSIGNED)}) "
        "ORDER BY CAST(phone <> '' AND website <> '' AS int), reviews DESC NULLS LAST, ord LIMIT 100)",
        "SELECT * FROM best WHERE key NOT IN (SELECT key FROM api WHERE stars >= 4.5)")
    out["apply_details"] = w(
        f"{CENSUS}, {details.split(', dt AS', 1)[1].join(['dt AS', ''])}, want AS (SELECT b.ord, d.* FROM biz b JOIN det d ON d.key = b.place_id), "
        "won AS (SELECT w.ord, w.phone FROM want w JOIN biz b USING (ord) WHERE b.phone = '' AND w.phone <> '' AND w.phone NOT IN (SELECT phone FROM biz) QUALIFY w.ord = min(w.ord) OVER (PARTITION BY w.phone)), "
        "j AS (SELECT b.ord, coalesce(nullif(b.phone, ''), n.phone, '') AS phone, b.phone AS old, b.phones_all, w.phone AS found, CASE WHEN b.website <> '' THEN b.website ELSE coalesce(w.website, '') END AS website, "
        "CASE WHEN length(w.addr) > length(b.addr) THEN w.addr ELSE b.addr END AS addr, w.key IS NOT NULL AS hit, coalesce(w.order_url, '') AS order_url FROM biz b LEFT JOIN want w USING (ord) LEFT JOIN won n USING (ord)), "
        "l AS (SELECT *, list_filter(list_concat(CASE WHEN coalesce(found, '') <> '' THEN [phone] ELSE [] END, string_split(phones_all, '; '), [coalesce(found, '')]), lambda x: x <> '') AS ph FROM j)",
        f"SELECT ord, phone, {listed(distinct('ph'))} AS phones_all, website, addr, CASE WHEN hit THEN 'Full' ELSE '' END AS score_basis, order_url FROM l")
    out["apply_api"] = w(
        f"{CENSUS}, {answers.split(', aa AS', 1)[1].join(['aa AS', ''])}, a2 AS (SELECT *, CASE WHEN intl <> '' THEN {phone('intl')} ELSE {phone('national')} END AS found FROM api), "
        "want AS (SELECT b.ord, a.* FROM biz b JOIN a2 a ON a.key = regexp_extract(b.maps, '!19s(ChIJ[\\w\\-]+)', 1)), "
        "won AS (SELECT w.ord, w.found FROM want w JOIN biz b USING (ord) WHERE b.phone = '' AND w.found <> '' AND w.found NOT IN (SELECT phone FROM biz) QUALIFY w.ord = min(w.ord) OVER (PARTITION BY w.found)), "
        "j AS (SELECT b.ord, coalesce(nullif(b.phone, ''), n.found, '') AS phone, b.phones_all, coalesce(w.found, '') AS found, CASE WHEN b.website <> '' THEN b.website ELSE coalesce(web, '') END AS website, "
        "coalesce(n_ratings, b.reviews) AS reviews, round(coalesce(b.rating, stars), 1) AS rating, len(string_split(sources_all, '; ')) + CASE WHEN w.key IS NOT NULL AND NOT contains(sources_all, 'Places API') THEN 1 ELSE 0 END AS n_sources "
        "FROM biz b LEFT JOIN want w USING (ord) LEFT JOIN won n USING (ord)), "
        "l AS (SELECT *, list_filter(list_concat(CASE WHEN found <> '' THEN [phone] ELSE [] END, string_split(phones_all, '; '), [found]), lambda x: x <> '') AS ph FROM j)",
        f"SELECT ord, phone, {listed(distinct('ph'))} AS phones_all, website, reviews, rating, n_sources FROM l")
    out["api_quota"] = ("WITH u AS (SELECT strftime(ts, '%Y-%m') AS month, CASE event_type WHEN 'click' THEN 'enterprise' WHEN 'view' THEN 'pro' ELSE 'essentials' END AS sku FROM events), "
                        "n AS (SELECT month, sku, count(*) AS used, CAST(floor(CASE sku " + " ".join(f"WHEN {q(k)} THEN {v}" for k, v in FREE_CALLS.items()) + " END * 80 / 100) AS bigint) AS ceiling FROM u GROUP BY 1, 2) "
                        "SELECT *, greatest(0, ceiling - used) AS remaining FROM n")

    # frontier
    log = f"lg AS ({A.SEARCH_LOG})"
    cur = (f"{log}, cur AS (SELECT source, term, area, CASE WHEN arg_max(status, (happened_at, event_id)) = 'running' THEN 'pending' ELSE arg_max(status, (happened_at, event_id)) END AS status, "
           "arg_max(coalesce(raw_count, -1), (happened_at, event_id)) AS rc, arg_max(error, (happened_at, event_id)) AS error, epoch_us(max(happened_at) FILTER (status = 'running')) AS started_us, "
           "epoch_us(max(happened_at) FILTER (status <> 'running')) AS finished_us FROM lg GROUP BY 1, 2, 3), cs AS (SELECT *, CASE WHEN rc >= 0 THEN rc END AS raw_count FROM cur)")
    out["search_states"] = w(cur, "SELECT term, area, status, raw_count, error, started_us, finished_us FROM cs")
    sweeps = values([(f"sweep {la:.4f},{lo:.4f},{z}z",) for la, lo, z in Q.SWEEPS], "area")
    plan = f"SELECT 'gmaps_browser' AS source, term, area FROM (SELECT DISTINCT term FROM lg), {sweeps}"
    out["search_plan"] = w(log, plan)
    out["directory_plan"] = w(READY, "SELECT DISTINCT 'directories' AS source, 'finelib' AS term, area FROM ready UNION ALL SELECT 'directories', 'businesslist', 'lagos page ' || i FROM range(1, 151) r(i)")
    out["pending_searches"] = w(f"{cur}, plan AS (SELECT DISTINCT source, term, area FROM lg UNION ALL {plan})",
                                "SELECT term, area FROM plan WHERE (source, term, area) NOT IN (SELECT (source, term, area) FROM cs WHERE status = 'done')")
    out["search_subset"] = w(cur, "SELECT term, area, status FROM cs WHERE contains(area, 'sweep 6.54') AND term = 'click 1'")
    out["forced_searches"] = w(log, "SELECT DISTINCT source, term, area, 'pending' AS status FROM lg WHERE term = 'click 1' OR area = 'topup Gbagada @6.5514,3.3865,15z'")
    lat, lng, zm = (f"CAST(regexp_extract(area, '(-?\\d+\\.\\d+),(-?\\d+\\.\\d+),(\\d+)z', {i}) AS {t})" for i, t in ((1, "double"), (2, "double"), (3, "int")))
    bs, bw, bn, be = Q.BOX
    px = "360.0 / (256.0 * pow(2, {z}))"

    def kids(src: str) -> str:
        return f"""(SELECT DISTINCT source, term, area FROM (SELECT source, term, CASE WHEN starts_with(area0, 'sweep') THEN 'sweep ' ELSE split_part(area0, ' @', 1) || ' @' END ||
  printf('%.4f,%.4f,%dz', la, lo, z + 1) AS area, la, lo, z + 1 AS z1 FROM (SELECT source, term, area AS area0, z, round(lat + 768 * {px.format(z='z')} * cos(radians(lat)) / 4 * sy, 4) AS la,
  round(lng + 1366 * {px.format(z='z')} / 4 * sx, 4) AS lo FROM (SELECT *, {lat} AS lat, {lng} AS lng, {zm} AS z FROM {src}), (VALUES (1), (-1)) a(sy), (VALUES (1), (-1)) b(sx) WHERE z < 17))
  WHERE NOT (la + 768 * {px.format(z='z1')} * cos(radians(la)) / 2 < {bs} OR {bn} < la - 768 * {px.format(z='z1')} * cos(radians(la)) / 2
   OR lo + 1366 * {px.format(z='z1')} / 2 < {bw} OR {be} < lo - 1366 * {px.format(z='z1')} / 2))"""
    full = f"{cur}, fullc AS (SELECT source, term, area FROM cs WHERE status = 'done' AND raw_count >= 120), k0 AS {kids('fullc')}"
    for i in range(1, 4):
        full += f", f{i} AS (SELECT * FROM k{i - 1} WHERE (source, term, area) IN (SELECT (source, term, area) FROM fullc)), k{i} AS {kids(f'f{i}')}"
    out["split_saturated"] = w(full, "SELECT DISTINCT term, area FROM (SELECT * FROM k0 UNION ALL SELECT * FROM k1 UNION ALL SELECT * FROM k2 UNION ALL SELECT * FROM k3)")
    floors = values([(a.name, Q.FLOORS[a.name], f"topup {a.name} @{a.lat:.4f},{a.lng:.4f},15z") for a in CENSUS_AREAS if a.name in Q.FLOORS], "name", "lim", "search")
    out["top_up_plan"] = w(f"{READY}, {log}, n AS (SELECT name, search FROM {floors} LEFT JOIN (SELECT area, count(*) AS n FROM ready GROUP BY 1) c ON c.area = name WHERE coalesce(n, 0) < lim)",
                           "SELECT 'gmaps_browser' AS source, term, search AS area FROM (SELECT DISTINCT term FROM lg), n")
    out["best_counts"] = w(cur, "SELECT term, max(raw_count) AS best FROM cs WHERE status = 'done' AND raw_count > 0 GROUP BY 1")
    out["suspect_results"] = w(
        f"{log}, b AS (SELECT event_id, term, raw_count, coalesce(max(raw_count) OVER (PARTITION BY term ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM lg WHERE status = 'done'), "
        "s AS (SELECT *, CASE WHEN raw_count = 0 AND before > 0 THEN 'empty' WHEN before > 10 AND raw_count < 4 THEN 'suspect' END AS signal FROM b)", "SELECT * FROM s WHERE signal IS NOT NULL")
    out["kept_counts"] = w(
        f"{READY}, {cur}, k AS (SELECT l.term, l.area, count(*) AS kept FROM lg l JOIN ready r ON r.ord = l.event_id WHERE r.area NOT IN ({q(OUTSIDE)}, {q(UNASSIGNED)}) GROUP BY 1, 2)",
        "SELECT term, area, status, CASE WHEN kept IS NOT NULL THEN kept WHEN status = 'done' THEN 0 END AS kept_count FROM cs LEFT JOIN k USING (term, area)")
    out["search_report"] = w(cur, "SELECT source, term, area, status, started_us, raw_count, error FROM cs")

    # reconciliation
    out["dq_reconcile_kpis"] = w(f"{CENSUS}, k AS ({kpi_rows('biz', CENSUS_KPIS)})", "SELECT kpi, value AS published, value AS recount, true AS ok FROM k")
    long = " UNION ALL ".join(f"SELECT grp, {q(x)} AS col, {x} AS value FROM cells" for x in ("core", "ring", "total", "phone", "prio_a"))
    out["dq_reconcile_groups"] = w(f"{CENSUS}, {GROUP_CELLS}, k AS ({long})", "SELECT grp, col, value AS published, value AS recount, true AS ok FROM k")
    out["dq_schema"] = w(CENSUS, "SELECT count(*) AS records, 0 AS null_text, count(*) FILTER (phone <> '' AND NOT regexp_matches(phone, '^\\+234[0-9]{10}$|^\\+2341[0-9]{7,8}$')) AS bad_phone, "
                                 f"count(*) FILTER (grp NOT IN {any_of(T.groups)}) AS unknown_group, count(*) FILTER (sub <> {q(UNCLASSIFIED_SUB)} AND (grp, sub) NOT IN (SELECT (grp, sub) FROM {tree})) AS unknown_sub, "
                                 f"count(*) FILTER (area NOT IN {any_of(AREA_NAMES + [OUTSIDE, UNASSIGNED])}) AS unknown_area FROM biz")
    out["dq_unclassified"] = w(CENSUS, f"SELECT count(*) AS records, count(*) FILTER (sub = {q(UNCLASSIFIED_SUB)}) AS unclassified, round(count(*) FILTER (sub = {q(UNCLASSIFIED_SUB)}) / count(*), 6) AS share, "
                                       f"count(*) FILTER (sub = {q(UNCLASSIFIED_SUB)}) / count(*) < 0.05 AS ok FROM biz")
    shared = ("SELECT phone, count(*) AS records, count(DISTINCT nullif(place_id, '')) AS distinct_ids, count(*) FILTER (place_id = '') AS without_id, "
              "count(*) FILTER (place_id = '') = 0 AND count(DISTINCT place_id) = count(*) AS ok FROM {} WHERE phone <> '' GROUP BY 1 HAVING count(*) > 1")
    out["dq_shared_phones"] = w(MAPPED, shared.format("mapped"))
    out["dq_shared_ids"] = w(MAPPED, "SELECT place_id, count(*) AS records FROM mapped WHERE place_id <> '' GROUP BY 1 HAVING count(*) > 1")
    out["dq_merged_are_distinct"] = w(CENSUS, f"SELECT 'phone' AS what, phone AS value FROM ({shared.format('biz')}) WHERE NOT ok UNION ALL SELECT 'place_id', place_id FROM biz WHERE place_id <> '' GROUP BY 2 HAVING count(*) > 1")
    out["dq_row_counts"] = w(CENSUS, "SELECT name, (SELECT count(*) FROM biz) AS n, true AS ok FROM (VALUES ('records'), ('area_summary'), ('group_area')) v(name)")
    out["dq_rules_in_tree"] = w(READY, f"SELECT grp, sub, count(*) AS n FROM ready WHERE (grp, sub) NOT IN (SELECT (grp, sub) FROM {tree}) GROUP BY 1, 2")

    # references: the characters are written out
    out["page_entities"] = ("SELECT page_id, url || '?a=1&b=' || page_id || ' Bread & Butter ' || chr(8358) || page_id || ' caf' || chr(233) || ' ' || chr(169) || page_id || ' ' || chr(172) || 'it; &nosuch; ' "
                            "|| chr(128512) || ' ' || chr(8211) || ' ' || chr(65533) || ' ' || chr(65533) || ' |' || chr(65533) || ' &; & &amp; <b> fjord' || chr(229) || ' ' || "
                            "CASE WHEN CAST('39' || page_id AS BIGINT) > 1114111 THEN chr(65533) WHEN CAST('39' || page_id AS BIGINT) BETWEEN 55296 AND 57343 THEN chr(65533) "
                            "WHEN CAST('39' || page_id AS BIGINT) BETWEEN 64976 AND 65007 OR CAST('39' || page_id AS BIGINT) % 65536 >= 65534 THEN '' ELSE chr(CAST('39' || page_id AS INT)) END AS text FROM pages")

    # streams
    out["stream_ingest"] = w(READY, "SELECT ord, phone, area, zone, grp, sub FROM ready")
    out["stream_latest"] = "SELECT user_id, event_type, max(event_id) AS event_id, round(arg_max(value, event_id), 4) AS value FROM events GROUP BY 1, 2"
    out["stream_states"] = w(log, "SELECT term, area, arg_max(status, (happened_at, event_id)) AS status FROM lg GROUP BY 1, 2")
    import sys

    from placebook.catalog import large_oracles, run_oracles
    me = sys.modules[__name__]
    return out | large_oracles.build(me) | run_oracles.build(me, out)
