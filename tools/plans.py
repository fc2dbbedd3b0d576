"""Print the physical plan of registered queries.

Usage: python tools/plans.py [sf_dir] [name ...]   (default: all queries, sf0.01)

Queries that run iterative work eagerly (shortest paths) print the plan of
their final, already-materialised result.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tessera.plans.catalog import QUERIES  # noqa: E402
from tessera.session import build_session  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session("local[8]", shuffle_partitions=8)
    for name in names:
        print(f"===== {name}")
        QUERIES[name](spark, sf).explain("formatted")
    spark.stop()


if __name__ == "__main__":
    main()
