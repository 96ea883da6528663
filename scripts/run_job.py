"""spark-submit driver for the batch job (ship the package with --py-files).

    spark-submit --py-files sparesledger.zip scripts/run_job.py --landing <folder> --as-of 2026-06-30 --reports
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sparesledger.plans.job import main  # noqa: E402

if __name__ == "__main__":
    main(sys.argv[1:])
