"""Print the formatted physical plan of registered queries.

    python tools/explain.py /root/testdata/sf0.01 g10_run_daily [...]

Look for PushedFilters / ReadSchema on the scans, BroadcastHashJoin on the
dimension joins and the number of Exchange nodes.
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from perron.queries import REGISTRY  # noqa: E402
from perron.session import get_spark  # noqa: E402

if __name__ == "__main__":
    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = get_spark()
    for n in names:
        print(f"===== {n}")
        REGISTRY[n](spark, sf_dir).explain("formatted")
