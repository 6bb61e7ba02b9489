"""Benchmark: load the test tables into the folder warehouse, then time the headline questions.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_REPEAT (default 3).
Prints one JSON line.  ``load_ingest_first`` is the real loader (``run_ingest``) over the rendered daily files and
machine list; ``load_ingest_again`` is its second run over the same folder, which has nothing to do.  ``load_dashboard_cold``
is the first dashboard call of the session.  Each query is run once untimed (JVM and codegen warm-up), then BENCH_REPEAT
times; its time is the median of those runs (a new DataFrame each time, results collected to the
``value``.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from hourmeter.operators import intervals as IV  # noqa: E402
from hourmeter.operators import quality as QL  # noqa: E402
from hourmeter.operators import rankings as RK  # noqa: E402
from hourmeter.operators import views as V  # noqa: E402
from hourmeter.plans import contract as C  # noqa: E402
from hourmeter.plans import snapshot as SN  # noqa: E402
from hourmeter.plans.load import run_ingest  # noqa: E402
from hourmeter.plans.store import Store, materialize  # noqa: E402
from hourmeter.session import checkpoint_root, get_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = get_session(f"local[{cpus}]", shuffle_partitions=max(4, cpus * 2), app="hourmeter-bench")
    # the warehouse lives under the shared checkpoint folder (spark.checkpoint.dir), never a machine-local temp dir
    scratch = checkpoint_root(spark).rstrip("/") + "/bench-" + uuid.uuid4().hex
    timings: dict[str, float] = {}

    t0 = time.time()
    loaded = C.facade_loaded(spark, sf_dir)  # facade + clean of the rendered CSV lines + run log
    store = Store(spark, scratch + "/warehouse")
    materialize(store, loaded, load_id="bench")
    timings["load_clean_and_write"] = round(time.time() - t0, 3)

    facade = C.facade_tables(spark, sf_dir)
    C.write_named_text(spark, C.facade_raw_lines(spark, sf_dir, facade), scratch + "/incoming")
    C.write_named_text(spark, C.facade_machine_list_lines(spark, sf_dir, facade), scratch + "/ml")
    drop = Store(spark, scratch + "/ingested", C.BRANCH_PREFIX)
    for name in ("load_ingest_first", "load_ingest_again"):
        t0 = time.time()
        run_ingest(spark, drop, scratch + "/incoming", scratch + "/ml/" + C.MACHINE_LIST_FILE)
        timings[name] = round(time.time() - t0, 3)

    snapshot = store.tables()  # one committed view of the warehouse, as a reader would hold it

    def t():
        return snapshot

    questions = {
        "e7_machine_run_hours": lambda: RK.machine_run_hours(t()),
        "e7_forklifts_one_week": lambda: RK.machine_run_hours(t(), "2024-01-08", "2024-01-14", machine_type="forklift"),
        "e8_driver_activity": lambda: RK.driver_activity(t()),
        "e9_branch_summary": lambda: RK.branch_summary(t()),
        "e10_machine_events": lambda: RK.machine_events(t(), event_type="impact"),
        "e5_data_coverage": lambda: V.data_coverage(t()),
        "e11_data_quality": lambda: QL.data_quality(t()),
        "e12_data_quality_summary": lambda: QL.data_quality_summary(t()),
        "e1_machine_daily_hours": lambda: IV.machine_daily_hours(t()),
        "k2_reconcile_run_hours": lambda: QL.reconcile_run_hours(t()),
    }

    def dashboard():
        snap = SN.dashboard_snapshot(t())
        snap.to_json()
        snap.release()

    t0 = time.time()
    dashboard()
    timings["load_dashboard_cold"] = round(time.time() - t0, 3)
    questions["i1_dashboard_snapshot"] = dashboard

    for name, q in questions.items():
        runs = []
        for i in range(repeat + 1):
            s = time.time()
            out = q()
            if out is not None:
                out.collect()
            if i > 0:  # run 0 is the warm-up
                runs.append(time.time() - s)
        timings[name] = round(statistics.median(runs), 3)

    rows = store.tables().events.agg(F.count("*")).first()[0]
    total = round(sum(v for k, v in timings.items() if not k.startswith("load_")), 3)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(
        json.dumps(
            {
                "metric": "question_seconds_total",
                "value": total,
                "unit": "sec",
                "queries": timings,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                "events": rows,
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
