"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from assetboard import plans  # noqa: E402
from assetboard.session import env_cores, local_session  # noqa: E402

HEADLINE = [
    "consensus_board", "consensus_targets", "resolve_three_key", "assemble_board", "divergence", "top200",
    "feature_table", "aging_curve", "season_to_date", "eb_blend", "blend_backtest", "league_totals", "trade_verdict",
    "member_weather", "impute", "missingness", "quantile_label", "threshold_sweep", "roc_auc", "feature_spearman",
    "stratified_split_sizes", "stream_daily", "fit_logistic", "fit_board_gbt",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cores = env_cores()
    spark = local_session(cores, **{"spark.sql.shuffle.partitions": str(cores)})
    spark.sparkContext.setLogLevel("ERROR")
    queries = plans.queries()
    names = sys.argv[1:] or HEADLINE
    # One small run first, so that the first query does not pay for starting the session.
    queries["top200"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    scale = re.search(r"sf([0-9.]+)$", folder)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": float(scale.group(1)) if scale else folder,
    }))


if __name__ == "__main__":
    main()
