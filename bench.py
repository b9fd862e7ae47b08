"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the folder of tables, BENCH_CPUS the local threads. Each query is run to
completion into a sink that discards its rows, so every column is computed.
"""

from __future__ import annotations

import json
import os
import time

HEADLINE = (
    "d1_orders_econ",
    "d2_customer_items",
    "d3_category",
    "d4_geo",
    "d5_category_wide",
    "d6_geo_wide",
    "d8_fact_reviews",
    "d10_analysis_frame",
    "w2_fx_ffill",
    "a11_monthly",
    "a13_top_categories",
    "a17_top_cities",
    "a19_state_category_pivot",
    "x22_elasticity",
    "a22_median_payment",
    "a26_duplicates",
    "i2_median_fill",
    "i7_geo_fill",
    "q8_run_checks",
    "d1_d4_full_run",
)


def main() -> None:
    from suite import queries
    from suite.entities import Entities
    from suite.marts_queries import d3, d4
    from tradewind.functions.lookups import display_category
    from tradewind.plans import reports
    from tradewind.session import local_session
    from tradewind.sources.tables import cached

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session("bench", cpus, partitions=cpus)
    known = queries()

    def timed(make) -> float:
        start = time.perf_counter()
        make().write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    def run(name: str) -> float:
        return timed(lambda: known[name](spark, folder))

    run("d3_category")  # starts the JVM's compilers and the scan of the file footers
    seconds = {name: run(name) for name in HEADLINE}
    # What a dashboard does: reports over marts that are stored already.
    entities = Entities(spark, folder)
    cat, geo = cached(d3(entities)), cached(d4(entities))
    stored = {
        "a11_monthly": lambda: reports.monthly(display_category(reports.load_category(cat))),
        "a13_top_categories": lambda: reports.top_categories(display_category(reports.load_category(cat)), 4),
        "a15_states": lambda: reports.state_sales(display_category(reports.load_geo(geo))),
        "a17_top_cities": lambda: reports.top_cities(display_category(reports.load_geo(geo))),
    }
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "reports_on_stored_marts": {name: timed(make) for name, make in stored.items()},
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
