"""Headline queries, timed. Prints one JSON line.

Folder and cores come from BENCH_SF_DIR and BENCH_CPUS. Article files are written
before the clock starts; every query then runs once, to the last row.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from namewire.operators.names import name_counts, names_by_date  # noqa: E402
from namewire.operators.rows import row_quality  # noqa: E402
from namewire.plans.daily import daily_top_names  # noqa: E402
from namewire.plans.registry import QUERIES  # noqa: E402
from namewire.operators.event_time import assign_event_time  # noqa: E402
from namewire.session import build_session  # noqa: E402
from namewire.sources.articles import read_articles, read_placed_lines  # noqa: E402
from namewire.schema import FIELDS  # noqa: E402
from namewire.sources.tables import article_lines, table  # noqa: E402

TABLE_QUERIES = [
    "hopping_counts", "trailing_hour_count", "latest_complete_window", "fold_changelog",
    "conflate_days", "topk_snapshot", "update_messages", "missing_segments",
    "latest_price", "cost_efficiency", "run_times", "run_cost", "cheapest_config",
    "linear_trend", "quadratic_trend", "interpolate_points", "bounded_topk",
    "stream_hopping_counts", "run_cost_at_start", "run_cost_over_prices",
]


# Characters in the other fields of a line: most of a line is not names.
FILLED = {"counts": 100, "themes": 600, "themes_v2": 1000, "locations": 500, "locations_v2": 700, "persons": 150, "persons_v2": 250,
          "organisations": 150, "organisations_v2": 250, "tone": 60, "gcam": 2500, "quotations": 300, "amounts": 150, "extras": 500}
NAMED = 400  # characters of the document that become names


def full_lines(spark, folder):
    """A line per event as real ones are: every field filled, names less than a tenth of the bytes."""
    clean = F.translate("text", "\n\t\r", "   ")
    texts = table(spark, folder, "documents").where("length(text) > 0").select("doc_id", clean.alias("text"))
    words = F.transform(F.split(F.left("text", F.lit(NAMED)), " "), lambda w, i: F.concat(w, F.lit(","), i + 1))
    stamp = F.date_format("ts", "yyyyMMddHHmmss")
    made = {"record_id": F.concat_ws("-", stamp, "event_id"), "publish_date": stamp, "source_collection": F.lit("1"),
            "all_names": F.array_join(words, ";")}
    fields = [made.get(f, F.rpad("text", FILLED[f], F.col("text")) if f in FILLED else F.lit("x")) for f in FIELDS]
    number = table(spark, folder, "documents").agg(F.max("doc_id") + 1).first()[0]
    events = table(spark, folder, "events").withColumn("doc_id", F.pmod("event_id", F.lit(number)))
    return events.join(texts, "doc_id").select("ts", F.concat_ws("\t", *fields).alias("value"))


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session("bench", f"local[{cores}]", conf={
        "spark.sql.shuffle.partitions": str(cores), "spark.driver.memory": "16g",
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    files = os.path.join(tempfile.mkdtemp(prefix="bench-"), "articles")
    full = os.path.join(os.path.dirname(files), "full")
    # segment files follow one another in time
    article_lines(spark, folder).repartitionByRange(4 * cores, "ts").select("value").write.text(files)

    full_lines(spark, folder).repartitionByRange(4 * cores, "ts").select("value").write.text(full)

    def from_files(**options):
        return daily_top_names(read_articles(spark, files), **options)

    runs = {
        "row_quality_from_files": lambda: row_quality(read_articles(spark, files)),
        "top_names_from_files": lambda: from_files(),
        "top_names_from_full_lines": lambda: daily_top_names(read_articles(spark, full)),
        "top_names_with_ties_from_files": lambda: from_files(ties=True),
        "name_counts_from_files": lambda: name_counts(names_by_date(read_articles(spark, files))),
        "event_time_from_files": lambda: assign_event_time(read_placed_lines(spark, files), consecutive=True),
        **{name: (lambda q=QUERIES[name]: q(spark, folder)) for name in TABLE_QUERIES},
    }
    seconds = {}
    for name, make in runs.items():
        began = time.perf_counter()
        make().write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - began, 3)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": float(os.path.basename(folder.rstrip("/")).removeprefix("sf")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
