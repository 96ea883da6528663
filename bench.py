"""Benchmark: headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Three groups are timed:

* ``e2e_*``    -- a registered query planned from the raw parquet tables (fixture mapping +
                  silver + gold + report), fully evaluated through a ``noop`` sink;
* ``bronze_write`` / ``silver_write`` / ``gold_write`` -- the batch job's three layers written as
  parquet (full refresh), silver from the stored bronze and gold from the stored silver;
* ``rpt_*``    -- reports over the stored gold/silver tables, as the reference's reports
                  read its stored gold table.

Each timing is the best of ``$BENCH_REPEAT`` runs (default 2) after one warm-up at sf0.001.
``BENCH_EVENT_LOG=1`` also writes Spark's event log into the run's scratch folder.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sparesledger.operators import recon, reports, security  # noqa: E402
from sparesledger.plans.model import FIXTURE_AS_OF, Model  # noqa: E402
from sparesledger.plans.pipeline import read_layers, run_pipeline  # noqa: E402
from sparesledger.plans.registry import DRILL_PERIOD, QUERIES, comparable  # noqa: E402
from sparesledger.session import ensure_checkpoint_dir, local_session  # noqa: E402

E2E = ("stores_aging", "aging_by_bucket", "redistribution_list", "procurement_list", "recon_ap_to_gl",
       "gl_drill_through", "visibility_check_gci", "check_bridge_coverage", "check_journal_balance")


def _force(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def _best(fn, repeat: int) -> float:
    best = float("inf")
    for _ in range(repeat):
        t = time.perf_counter()
        fn()
        best = min(best, time.perf_counter() - t)
    return round(best, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    scratch = tempfile.mkdtemp(prefix="bench-", dir=os.environ.get("TMPDIR", "/tmp"))
    extra = {}
    if os.environ.get("BENCH_EVENT_LOG"):  # stage/task times for offline reading, kept in this run's scratch
        os.makedirs(os.path.join(scratch, "events"))
        extra = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": os.path.join(scratch, "events")}
    spark = local_session(cores=cpus, shuffle_partitions=max(8, 2 * int(cpus) if cpus.isdigit() else 16),
                          extra=extra)
    # written tables go to the shared folder the session names in spark.checkpoint.dir (a local
    # scratch folder only when it is unset), in a fresh subfolder per run
    shared = ensure_checkpoint_dir(spark, os.path.join(scratch, "checkpoints")).rstrip("/")

    warm = "/root/testdata/sf0.001"
    if os.path.isdir(warm):
        _force(QUERIES["stores_aging"](spark, warm))

    times: dict[str, float] = {}
    for name in E2E:
        times[f"e2e_{name}"] = _best(lambda n=name: _force(QUERIES[n](spark, sf_dir)), repeat)

    root = f"{shared}/bench-{uuid.uuid4().hex}"
    # the three layers timed apart: bronze derives the extracts from the test tables; silver is
    # built from the stored bronze and gold from the stored silver, as on a cluster
    times["bronze_write"] = _best(
        lambda: run_pipeline(spark, Model.from_fixtures(spark, sf_dir, as_of=FIXTURE_AS_OF), root,
                             layers=("bronze",)), 1)
    times["silver_write"] = _best(
        lambda: run_pipeline(spark, Model(read_layers(spark, root)[0], as_of=FIXTURE_AS_OF), root,
                             layers=("silver",)), 1)

    def gold_write():
        bronze, silver_t, _ = read_layers(spark, root)
        run_pipeline(spark, Model(bronze, as_of=FIXTURE_AS_OF, silver_tables=silver_t), root, layers=("gold",))

    times["gold_write"] = _best(gold_write, 1)

    stored = Model.from_warehouse(spark, root, as_of=FIXTURE_AS_OF)
    gold = stored.stores_aging
    rpts = {
        "aging_by_bucket": lambda: reports.aging_by_bucket(gold),
        "redistribution_list": lambda: reports.redistribution_list(gold, plants=stored.plant_codes),
        "procurement_list": lambda: reports.procurement_list(gold),
        "nonmoving_by_category": lambda: reports.nonmoving_by_category(gold),
        "visibility_check_gci": lambda: security.visibility_check(gold, "GCI"),
        "recon_report": lambda: recon.recon_report(stored.recon_ap_to_gl),
        "gl_drill_through": lambda: recon.gl_drill_through(
            stored.fact_ap_distribution, stored.bridge_sla_gl, stored.dim_account, DRILL_PERIOD),
    }
    for name, build in rpts.items():
        times[f"rpt_{name}"] = _best(lambda b=build: _force(comparable(b())), repeat)

    total = round(sum(times.values()), 3)
    print(json.dumps({
        "metric": "total_seconds_headline_queries",
        "value": total,
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir).replace("sf", ""),
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
