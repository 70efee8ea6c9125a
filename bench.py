"""Time the job's stages on the listings of $BENCH_SF_DIR and print one JSON line.

Every stage starts from what the one before it stored, runs to its end, and is timed once, cold: no
result is shared between stages except by those stored tables. The headline value is geo + classify +
dedupe, the stages for which the reference has published rates.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from placebook.catalog import adapters as A  # noqa: E402
from placebook.catalog import queries as Q  # noqa: E402
from placebook.functions.contacts import extract_contacts  # noqa: E402
from placebook.functions.scoring import score_records  # noqa: E402
from placebook.operators.resolve import Resolution  # noqa: E402
from placebook.plans import profiles  # noqa: E402
from placebook.session import build_session, materialise  # noqa: E402


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cpus}]", "bench", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g", "spark.ui.enabled": "false",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="placebook-bench-")})
    spark.sparkContext.setLogLevel("OFF")
    seconds: dict[str, float] = {}
    profile = Q.PROFILE

    def timed(name: str, job):
        start = time.monotonic()
        out = job()
        seconds[name] = round(time.monotonic() - start, 3)
        print(f"{name}: {seconds[name]} s", file=sys.stderr)
        return out

    def run(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    raw = materialise(A.sightings(spark, folder), "raw")           # input in place, and the session warm
    n = raw.count()
    geo = timed("geo", lambda: materialise(profiles.place(raw, profile, Q.TODAY), "geo"))
    ready = timed("classify", lambda: materialise(profiles.classify(geo, profile), "ready"))

    def dedupe():
        resolution = Resolution(ready)
        kept, _ = profiles.finish_businesses(resolution.businesses(), profile)
        return resolution, materialise(kept, "businesses")

    resolution, kept = timed("dedupe", dedupe)
    timed("merge_log", lambda: (run(resolution.decisions()), run(resolution.conflicts())))
    scored = timed("score", lambda: materialise(score_records(kept), "scored"))

    def report():
        tables = profiles.census_reports(kept, profile, Q.TODAY)
        for table in tables.values():
            run(table)
        return tables

    tables = timed("report", report)
    timed("verify", lambda: [run(t) for t in profiles.verify(kept, profile, tables).values()])
    timed("contacts", lambda: run(extract_contacts(A.pages(spark, folder))))
    for name in ("osm_records", "card_records", "directory_records", "derive_centroids", "split_saturated", "suspect_results"):
        timed(name, lambda: run(Q.QUERIES[name](spark, folder)))
    headline = seconds["geo"] + seconds["classify"] + seconds["dedupe"]
    print(json.dumps({
        "metric": f"geo + classify + dedupe of {n} raw records", "value": round(headline, 3), "unit": "sec",
        "queries": seconds, "records_per_sec": round(n / headline), "kept": kept.count(),
        "scored": scored.filter(F.col("score") > 0).count(), "sf": os.path.basename(folder.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
