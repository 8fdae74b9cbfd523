"""Write the formatted physical plans of the headline queries to docs/plans/.

    python tools/dump_plans.py [--sf-dir DIR]

The plans are taken after execution, so they show the final adaptive plan
(joins AQE chose at run time, coalesced shuffles, reused exchanges).
"""

from __future__ import annotations

import argparse
import contextlib
import io
import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from socialcart.registry import queries  # noqa: E402
from socialcart.session import build_session  # noqa: E402

NAMES = ["q1_campaign_conversion", "q2_recommendations", "q3_token_search", "q1_graph",
         "doc_token_search"]


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.1")
    a = ap.parse_args()
    spark = build_session("local[8]", 8)
    out_dir = os.path.join(ROOT, "docs", "plans")
    os.makedirs(out_dir, exist_ok=True)
    for n in NAMES:
        df = queries()[n](spark, a.sf_dir)
        df.collect()
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
        with open(os.path.join(out_dir, f"{n}.txt"), "w") as f:
            f.write(f"# {n} at {os.path.basename(a.sf_dir)} (final adaptive plan)\n\n")
            f.write(buf.getvalue())
    spark.stop()


if __name__ == "__main__":
    main()
