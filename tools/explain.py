"""Print the formatted physical plan of catalogue queries:
python tools/explain.py <name> [<name>...] [--sf DIR]"""

from __future__ import annotations

import argparse
import sys

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from lifetab.plans import catalog  # noqa: E402
from lifetab.session import get_spark  # noqa: E402


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("names", nargs="+")
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    args = ap.parse_args()
    spark = get_spark()
    for name in args.names:
        print(f"===== {name}")
        catalog.QUERIES[name](spark, args.sf).explain("formatted")
    spark.stop()


if __name__ == "__main__":
    main()
