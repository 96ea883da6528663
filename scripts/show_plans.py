"""Write PLANS.md: physical plans of the production-path queries over stored layers.

Usage: python scripts/show_plans.py [sf_dir] [out.md]

The layers are written once to a fresh scratch folder; the plans shown are those a
cluster runs every refresh -- gold from stored silver, reports from stored gold -- with
the notes on what to look for in each.
"""

from __future__ import annotations

import os
import sys
import tempfile
import uuid

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sparesledger.operators import recon, reports, security  # noqa: E402
from sparesledger.plans.model import FIXTURE_AS_OF, Model  # noqa: E402
from sparesledger.plans.pipeline import run_pipeline  # noqa: E402
from sparesledger.session import ensure_checkpoint_dir, local_session  # noqa: E402

NOTES = {
    "gold: stores_aging from stored silver": (
        "One conditional aggregation over the transaction fact (partial on item, plant, vendor; "
        "final on item, plant). At this size every joined side is under Spark's broadcast "
        "threshold, so Spark broadcasts them; the next plan shows the same query past the "
        "threshold. No nested-loop join: the as-of date is a literal."),
    "gold: stores_aging from stored silver, sizes past the broadcast threshold": (
        "autoBroadcastJoinThreshold = -1 mimics cluster-size inputs: the narrow item master "
        "joins redundancy on item number first, then the item side, the on-hand aggregate, costs "
        "and the profile's final aggregate meet on one hash partitioning of (inventory_item_id, "
        "org_id) -- the aggregate outputs are joined without a second exchange and the wide rows "
        "never move again. No broadcast remains (the plant dimension was joined when silver was "
        "built)."),
    "gold: recon_ap_to_gl from stored silver, sizes past the broadcast threshold": (
        "The three sides are one union, summed by (period, side, plant) over one exchange."),
    "gold: recon_ap_to_gl from stored silver": (
        "AP with its plant, bridge x distribution (fact x fact, left to the optimizer) and GL "
        "filtered on source and natural account are one tagged union with partial sums below a "
        "single exchange; a second, tiny aggregation picks each period's columns."),
    "report: secured_view(GCI) over stored gold": (
        "The persona is a literal and gold is partitioned by plant: PartitionFilters "
        "(org_code = GCI) -- only that plant's files are listed and read."),
    "report: redistribution_list over stored gold": (
        "One pass: partial aggregation by item number with plants and statuses as bit masks, HAVING on "
        "the masks, top-50 as TakeOrderedAndProject (bounded by k per partition), masks decoded last."),
    "report: gl_drill_through(MAR-25) over stored silver": (
        "period_name and natural_account pushed into their scans before the joins; top-25."),
}


def main(argv: list[str]) -> None:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.1"
    out = argv[1] if len(argv) > 1 else os.path.join(os.path.dirname(os.path.dirname(__file__)), "PLANS.md")
    spark = local_session()
    shared = ensure_checkpoint_dir(spark, tempfile.mkdtemp(prefix="plans-")).rstrip("/")
    root = run_pipeline(spark, Model.from_fixtures(spark, sf_dir, as_of=FIXTURE_AS_OF),
                        f"{shared}/plans-{uuid.uuid4().hex}")
    silver_only = Model.from_warehouse(spark, root, read_gold=False, as_of=FIXTURE_AS_OF)
    stored = Model.from_warehouse(spark, root, as_of=FIXTURE_AS_OF)
    frames = {
        "gold: stores_aging from stored silver": silver_only.stores_aging,
        "gold: recon_ap_to_gl from stored silver": silver_only.recon_ap_to_gl,
        "report: secured_view(GCI) over stored gold": security.secured_view(stored.stores_aging, "GCI"),
        "report: redistribution_list over stored gold": reports.redistribution_list(stored.stores_aging, plants=stored.plant_codes),
        "report: gl_drill_through(MAR-25) over stored silver": recon.gl_drill_through(
            stored.fact_ap_distribution, stored.bridge_sla_gl, stored.dim_account, "MAR-25"),
    }
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    at_scale = Model.from_warehouse(spark, root, read_gold=False, as_of=FIXTURE_AS_OF)
    scale_frames = {
        "gold: stores_aging from stored silver, sizes past the broadcast threshold": at_scale.stores_aging,
        "gold: recon_ap_to_gl from stored silver, sizes past the broadcast threshold": at_scale.recon_ap_to_gl,
    }
    scale_plans = {t: df._jdf.queryExecution().executedPlan().toString() for t, df in scale_frames.items()}
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    parts = [
        "# PLANS — physical plans of the production path\n",
        f"Generated by `scripts/show_plans.py` at `{os.path.basename(sf_dir)}` on `local[*]` (static plans, "
        "before AQE re-planning; scratch paths shortened). Regenerate after changing an operator.\n",
    ]
    plans = {t: df._jdf.queryExecution().executedPlan().toString() for t, df in frames.items()}
    s_titles = list(scale_plans)
    order = list(frames)
    order = [order[0], s_titles[0], order[1], s_titles[1], *order[2:]]
    plans.update(scale_plans)
    for title in order:
        plan = plans[title]
        plan = plan.replace(f"file:{root}", "<root>").replace(root, "<root>")
        parts.append(f"## {title}\n\n{NOTES[title]}\n\n```\n{plan.rstrip()}\n```\n")
    with open(out, "w") as fh:
        fh.write("\n".join(parts))
    print(out)


if __name__ == "__main__":
    main(sys.argv[1:])
