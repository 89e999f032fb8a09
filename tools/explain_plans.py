"""Print the physical plan of registered queries (default: the bench
headline queries) at $BENCH_SF_DIR, for plan review.

usage: python tools/explain_plans.py [mode] [name ...]     mode: simple|formatted|cost
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import HEADLINE  # noqa: E402
from strata.plans.registry import QUERIES  # noqa: E402
from strata.session import build_session  # noqa: E402


def main():
    args = sys.argv[1:]
    mode = args.pop(0) if args and args[0] in ("simple", "formatted", "cost", "extended") else "simple"
    names = args or [n for n in HEADLINE if n != "medallion_end_to_end"]
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = build_session(master="local[8]", shuffle_partitions=16)
    for n in names:
        print(f"==== {n}")
        QUERIES[n](spark, sf_dir).explain(mode)


if __name__ == "__main__":
    main()
