"""Time the headline queries and print one JSON line.

Reads ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on ``local[$BENCH_CPUS]``. Each query
runs ``$BENCH_RUNS`` times (default 3) after a warm-up, and the median counts. Results go
to Spark's no-op sink, so every row is computed and none is collected. Register files and
archives are written before the clock starts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from bizregistry import plans, sources  # noqa: E402
from bizregistry.bindings import landing  # noqa: E402
from bizregistry.bindings.queries import QUERIES  # noqa: E402
from bizregistry.bindings.roles import table  # noqa: E402
from bizregistry.session import configure  # noqa: E402
from bizregistry.sources.schemas import FAMILIES, schema_of  # noqa: E402

QUESTIONS = [
    "q1_industry_openings",
    "q2_commerce_openings",
    "q3_new_registrations",
    "q4_openings_by_state",
    "q5_top_mean_capital",
    "q6_mean_capital_by_nature",
    "extract_links",
]
TABLES = ["simples", "socio", "empresa", "estabelecimento"]


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bizregistry-bench")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def jobs(spark: SparkSession, sf_dir: str) -> dict[str, Callable[[], DataFrame]]:
    found: dict[str, Callable[[], DataFrame]] = {
        name: (lambda name=name: QUERIES[name](spark, sf_dir)) for name in QUESTIONS
    }
    for name in TABLES:
        root = landing.land_family(spark, sf_dir, name)
        found[f"table_{name}"] = lambda name=name, root=root: plans.BUILDERS[name](
            plans.read_family(spark, root, name)
        )
    folder = landing.scratch_folder(spark)
    landing.zip_pages(table(spark, sf_dir, "pages"), folder)
    found["read_archived_delimited"] = lambda: sources.read_archived_delimited(
        sources.list_archives(spark, folder),
        schema_of("page_id bigint, url string"),
        member="*.PAGES",
        on_bad="skip",
    )
    return found


def run(build: Callable[[], DataFrame]) -> float:
    start = time.perf_counter()
    build().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    assert set(TABLES) <= FAMILIES.keys()
    seconds = {}
    timed = jobs(spark, sf_dir)
    for build in timed.values():
        run(build)
    for name, build in timed.items():
        run(build)
        seconds[name] = round(statistics.median(run(build) for _ in range(runs)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
