"""Print the physical plan tree (``explain("formatted")``, tree part only) of
registered queries.

usage: python tools/plans.py [sf_dir] [key ...]
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from overspend.plans.catalog import QUERIES  # noqa: E402
from overspend.session import local_session  # noqa: E402

DEFAULT = ["all_flags", "duplicates", "volume_spikes", "executive_summary", "scored_ranked"]


def plan_tree(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    return text.split("\n\n\n")[0].strip()


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    keys = sys.argv[2:] or DEFAULT
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    for k in keys:
        print(f"### {k}\n\n```\n{plan_tree(QUERIES[k](spark, sf_dir))}\n```\n")
    spark.stop()


if __name__ == "__main__":
    main()
