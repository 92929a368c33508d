"""Write the final (adaptive) physical plans of headline queries to a file.

Usage: python tools/dump_plans.py [sf_dir] [out.md]
Long expression lists are shortened so the operator shapes stay readable.
"""

from __future__ import annotations

import re
import sys

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from wardstat.plans.catalog import QUERIES  # noqa: E402
from wardstat.session import build_session  # noqa: E402

NAMES = ["pivot_wide", "feature_table", "stratified_split", "roc_auc", "recent_predictions",
         "risk_distribution", "normalise_scores", "daily_risk", "decoded_features", "feature_profile", "ingest_capped"]


NOTES = """What to look for:

* `pivot_wide`: the known-measure filter is applied on the line-item side
  before its shuffle; the only exchange over raw rows is preceded by a
  partial `HashAggregate` keyed by (facility_id, name, state, measure);
  the sort-based aggregation (string `min`) runs only on the reduced rows.
* `feature_table`: the state-vocabulary join is a `BroadcastHashJoin`
  chosen by AQE from the measured vocabulary size (the initial plan has a
  sort-merge join); the pivot exchange is reused by the vocabulary branch.
* `stratified_split`, `roc_auc`: ranks are windows per (label, bucket); the
  only `SinglePartition` exchanges carry per-bucket totals (bounded by the
  bucket count) or a final one-row aggregate after partial aggregation;
  the per-bucket totals read the window's exchange through `ReusedExchange`.
* `recent_predictions`: `TakeOrderedAndProject`, no full sort.
* `normalise_scores`: per-batch range aggregated then joined back on the
  batch key (broadcast here by AQE; skew split otherwise).
* `decoded_features`, `feature_profile`: the stored VARIANT is read as it is;
  features are unfolded by a `Generate`, and the only exchange follows a partial
  aggregation by key and kind.
* `ingest_capped`: a partition filter on `first` (cut off here; a plan test has it)
  leaves out folders beyond the cap.
"""


def shorten(line: str) -> str:
    line = re.sub(r"\[[^\[\]]{100,}\]", "[...]", line)
    line = re.sub(r"\([^()]{160,}\)", "(...)", line)
    line = re.sub(r"#\d+L?", "", line)
    line = re.sub(r", \[plan_id=\d+\]", "", line)
    return line[:200]


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    out = sys.argv[2] if len(sys.argv) > 2 else "PLANS.md"
    spark = build_session("local[8]", 16)
    parts = [f"# Final physical plans ({sf.rsplit('/', 1)[-1]}, local[8], AQE on)\n",
             "Generated by `tools/dump_plans.py` after running each query; expression lists shortened.\n",
             NOTES]
    for name in NAMES:
        df = QUERIES[name](spark, sf)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        plan = plan.split("+- == Initial Plan ==")[0]
        parts.append(f"\n## {name}\n\n```")
        parts.extend(shorten(x) for x in plan.splitlines())
        parts.append("```")
    with open(out, "w") as f:
        f.write("\n".join(parts) + "\n")


if __name__ == "__main__":
    main()
