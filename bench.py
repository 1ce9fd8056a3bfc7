"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the number of local cores. Every query is run to the
end with its rows discarded, once, after one small query has started the session. Queries over a gold table
read one that is written before them; the time of that is an entry of its own.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from stalewatch.session import build_session  # noqa: E402
from stalewatch.staging import stage  # noqa: E402
from stalewatch.suite.queries import OVER_GOLD, QUERIES  # noqa: E402

HEADLINE = (
    "contained_names",
    "gold_server_v3",
    "top10_remediation",
    "gold_server_v2",
    "gold_server_v1",
    "rank_server_job",
    "rank_server_view",
    "summary_sigla",
    "farol3",
    "remediation",
    "gold_sigla",
    "hub",
    "control",
    "typed_inference",
    "null_profile",
    "value_distribution",
    "numeric_summary",
    "histogram",
    "box_stats",
    "scatter_sample",
    "conv_context",
    "conv_questions",
    "sink_dynamic",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "stalewatch-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["table_shape"](spark, sf_dir).collect()

    seconds, golds = {}, {}
    for name in HEADLINE:
        start = time.perf_counter()
        if name in OVER_GOLD:
            build, over = OVER_GOLD[name]
            if build not in golds:
                golds[build] = stage(build(spark, sf_dir), "gold")
                seconds["write" + build.__name__] = round(time.perf_counter() - start, 3)
                start = time.perf_counter()
            result = over(spark, sf_dir, golds[build])
        else:
            result = QUERIES[name](spark, sf_dir)
        result.write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
