"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores.  Each query runs
once to warm up and is timed on its second run, planning included.
The dimensions of the star are kept for the queries on it; building them is timed by itself.  Every result
is consumed in full by the noop sink, so no time goes into the driver.
"""

from __future__ import annotations

import json
import os
import time

from beaconry.plans import REGISTRY, analogs
from beaconry.session import get_session

HEADLINE = """
b01_annual_volume b02_monthly_volume b03_demand_by_weekday b04_demand_by_hour b06_volume_by_area
b07_common_initial_class b08_initial_final_volume b09_response_by_severity b11_variability b12_held_vs_not_held
b15_busy_slow_months b16_busy_slow_hours b17_reportable_anomalies b18_outcome_distribution b22_class_transitions
b24_severity_transitions b26_annual_change_rates b28_annual_outcome_share b36_executive_summary b40_segment_forecast
a10_daily_performance w06_control_limits f04_star_fact c14_elapsed_seconds j09_star_join q02_key_complete_unique
q33_audit_record
""".split()


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = get_session("bench", f"local[{cpus}]", shuffle_partitions=int(cpus))
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        REGISTRY[name].run(spark, folder).write.format("noop").mode("overwrite").save()
        t = time.perf_counter()
        REGISTRY[name].run(spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - t, 3)
    analogs.forget()
    t = time.perf_counter()
    analogs.star(spark, folder)
    built = round(time.perf_counter() - t, 3)
    spark.stop()
    print(json.dumps({"metric": "headline_total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "build_dimensions": built, "sf": os.path.basename(folder.rstrip("/"))}))


if __name__ == "__main__":
    main()
