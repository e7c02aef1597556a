"""Times the headline queries: prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores. The
tables that several queries share are built in steps of their own, named build_*.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from gridscout.plans import queries as Q

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
BUILDS = {
    "build_profiles": Q._profiles,
    "build_wiki": Q._wiki,
    "build_titles": Q._titles,
    "build_enriched": Q._enriched,
    "build_document_index": Q._document_index,
    "build_page_index": Q._page_index,
    "build_profile_index": Q._profile_index,
}
HEADLINE = [
    "pages_strip_tags",
    "profile_override",
    "wiki_from_xml",
    "wiki_infobox",
    "articles_dedup",
    "redirect_resolve",
    "enriched_profile",
    "index_postings",
    "index_term_stats",
    "requests_parse",
    "search_text",
    "search_weighted",
    "search_must",
    "search_range",
    "search_batch",
    "search_profiles",
    "search_total_hits",
]


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name, build in BUILDS.items():
        start = time.perf_counter()
        build(spark, SF_DIR)
        seconds[name] = round(time.perf_counter() - start, 3)
    for name in HEADLINE:
        start = time.perf_counter()
        Q.QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
