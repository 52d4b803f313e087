"""Print the final (adaptive) physical plan of headline queries as compact operator trees.

    python scripts/plans.py [sf_dir] [key ...]  > PLANS.txt

Each query is executed first (collect) so the adaptive plan shown is the one that ran.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from firmlens import catalog  # noqa: E402
from firmlens.session import local_session  # noqa: E402

DEFAULT = ["sector_growth_top5", "dashboard_mart", "top_revenue_units", "establishment_card",
           "mean_by_category", "revenue_by_commune", "mean_top_labels", "log_histogram", "active_by_region",
           "creations_by_commune_year", "latest_per_key", "clean_legal_units"]


def tree(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    text = buf.getvalue()
    head = text.split("\n\n")[0]
    head = head.split("+- == Initial Plan ==")[0]  # keep the plan that actually ran
    lines = [ln for ln in head.splitlines() if ln.strip() and not ln.startswith("==")]
    return "\n".join(re.sub(r" \(\d+\)$", "", ln) for ln in lines)


def main() -> None:
    args = sys.argv[1:]
    sf = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.1"
    keys = [a for a in args if not a.startswith("/")] or DEFAULT
    spark = local_session()
    for k in keys:
        df = catalog.QUERIES[k](spark, sf)
        df.collect()
        print(f"### {k}\n```\n{tree(df)}\n```\n")


if __name__ == "__main__":
    main()
