"""Headline queries, one JSON line. Settings: BENCH_SF_DIR, BENCH_CPUS.

Page tables are rendered and written once, before any time is taken, so the
times are those of the operators on a stored table.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from docketry.plans import catalog  # noqa: E402
from docketry.session import build_session, scratch  # noqa: E402
from docketry.sources import rendered  # noqa: E402

LANDED = ["detail_pages", "list_pages", "link_pages", "mixed_pages", "captures"]

HEADLINE = [
    "land_raw_pages",
    "classify_pages",
    "page_signals",
    "page_cells",
    "extract_relator",
    "extract_envolvidos",
    "extract_movimentacoes",
    "extract_processos",
    "upsert_processos",
    "upsert_actions",
    "validate_processos",
    "best_detail_link",
    "frontier_stable",
    "next_pages_form",
    "server_health",
    "retry_plan",
    "field_coverage",
    "watchlist_check",
    "processos_by_judge",
    "ingest_pages",
    "reprocess_pages",
    "stream_pages",
    "stream_health",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog.queries()

    def run(name: str, folder: str) -> float:
        start = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    def landed(make):
        stored: dict[str, str] = {}

        def read(session, folder):
            if folder not in stored:
                stored[folder] = scratch(session, make.__name__)
                make(session, folder).write.parquet(stored[folder])
            return session.read.parquet(stored[folder])

        return read

    for name in LANDED:
        setattr(rendered, name, landed(getattr(rendered, name)))
        getattr(rendered, name)(spark, sf_dir)

    warm = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    run("extract_processos", warm if os.path.isdir(warm) else sf_dir)
    seconds = {name: run(name, sf_dir) for name in sys.argv[1:] or HEADLINE}
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
