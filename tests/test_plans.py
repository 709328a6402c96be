"""Plans that hold at scale: what is shuffled, pruned and kept in the JVM."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import article
from namewire.operators.names import name_counts, names_by_date
from namewire.operators.ranking import top_names
from namewire.operators.windows import hopping_counts, newest_counts
from namewire.plans.registry import QUERIES
from namewire.session import build_session, scratch_path, shared_root, sizing
from namewire.sources.articles import read_articles
from namewire.sources.tables import article_lines, mentions, table

PYTHON_QUERIES = {"bounded_topk"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return re.findall(r"Exchange (\w+)", plan(df))


def test_flagship(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x\n")
    ranked = top_names(name_counts(names_by_date(read_articles(spark, str(tmp_path)))))
    text = plan(ranked)
    assert "], row_number(), 10, Partial" in text and "], row_number(), 10, Final" in text
    assert exchanges(ranked) == ["hashpartitioning", "hashpartitioning"]
    assert "partial_count" in text


def test_ties_rank_where_they_are(spark, tmp_path):
    (tmp_path / "a.csv").write_text(article(names="Ann,1;Bob,2") + "\n")
    ranked = top_names(name_counts(names_by_date(read_articles(spark, str(tmp_path)))), ties=True)
    assert len(ranked.collect()) == 2
    text = plan(ranked)
    assert "BroadcastHashJoin" in text and "ReusedExchange" in text


def test_hopping_exchanges_small_rows(spark, small):
    counts = hopping_counts(mentions(spark, small))
    assert exchanges(counts) == ["hashpartitioning", "hashpartitioning"]
    last = plan(counts).index("REPARTITION_BY_COL")
    assert "sequence" in plan(counts)[:last] and "sequence" not in plan(counts)[last:]


def test_newest_window_reads_what_it_needs(spark, small):
    events = table(spark, small.replace("0.001", "0.01"), "events")
    newest = newest_counts(events.withColumnRenamed("event_type", "name"))
    newest.collect()
    text = plan(newest)
    assert "ReadSchema: struct<ts:timestamp,event_type:string>" in text
    assert set(re.findall(r"ReadSchema: (\S+)", text)) == {
        "struct<ts:timestamp,event_type:string>", "struct<ts:timestamp>"}
    assert re.search(r"PushedFilters: \[[^]]*GreaterThanOrEqual\(ts", text)


def test_price_conditions_reach_the_scan(spark, small):
    kept = QUERIES["price_history"](spark, small)
    kept.collect()
    assert re.search(r"PushedFilters: \[[^]]*GreaterThanOrEqual\(ts", plan(kept))


@pytest.mark.parametrize("name", ["name_count_maps", "top_names_per_day_with_ties"])
def test_counts_are_made_once(spark, small, name):
    result = QUERIES[name](spark, small)
    result.collect()
    assert "ReusedExchange" in plan(result)


def test_messages_are_exchanged_once(spark, small):
    """On (tick, part), never on the tick alone: the sizes are measured and broadcast."""
    result = QUERIES["update_messages"](spark, small)
    result.collect()
    assert re.search(r"hashpartitioning\(tick#\d+, part#", plan(result)) and "BroadcastHashJoin" in plan(result)


def test_newest_window_is_pruned(spark, small):
    result = QUERIES["latest_started_window"](spark, small)
    result.collect()
    assert re.search(r"PushedFilters: \[[^]]*GreaterThanOrEqual\(ts", plan(result))


@pytest.mark.parametrize("name", sorted(q for q in QUERIES if not q.startswith(("stream_", "top_names_from", "written"))))
def test_stays_in_the_jvm(spark, small, name):
    text = plan(QUERIES[name](spark, small))
    assert "CartesianProduct" not in text
    assert ("Python" in text or "MapInPandas" in text) == (name in PYTHON_QUERIES)


def test_hot_name_is_spread(spark):
    """A name with most of the rows does not end in one task."""
    hot = spark.range(200_000).select(
        F.timestamp_seconds(F.col("id") % 400_000 + 1_704_067_200).alias("ts"),
        F.when(F.col("id") % 10 < 9, "hot").otherwise(F.col("id").cast("string")).alias("name"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        counts = hopping_counts(hot.where("name = 'hot'"))
        sizes = [r[0] for r in counts.groupBy(F.spark_partition_id()).count().select("count").collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) >= 3 and max(sizes) < 0.6 * sum(sizes)


def test_sizing():
    small, large = sizing(1 << 30, 8), sizing(100 << 40, 4000)
    assert small == {"spark.sql.files.maxPartitionBytes": str(128 << 20), "spark.sql.shuffle.partitions": "8"}
    assert large["spark.sql.shuffle.partitions"] == "40960"
    assert 500 << 20 < int(large["spark.sql.files.maxPartitionBytes"]) <= 1 << 30


def test_shared_folder_is_the_sessions(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert shared_root(spark) == root and scratch_path(spark, "x").startswith(root)
    assert build_session() is not None


def test_written_lines_are_packed(spark, small, tmp_path, monkeypatch):
    from namewire.plans import registry

    monkeypatch.setattr(registry, "scratch_path", lambda _, label: str(tmp_path / label))
    registry.top_names_in_few_partitions(spark, small)
    parts = [f.name for f in (tmp_path / "articles").iterdir() if f.name.startswith("part-")]
    assert parts and all(name.endswith(".gz") for name in parts)


def test_lines_of_few_documents_are_dealt_by_their_bytes(spark, tmp_path):
    texts = [(k, f"name{k} " * 1000) for k in range(40)] + [(39, "again"), (None, "no id"), (40, None)]
    spark.createDataFrame(texts, "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    spark.range(3000).selectExpr("id as event_id", "timestamp_seconds(1704067200 + id) as ts").coalesce(1).write.parquet(
        str(tmp_path / "events.parquet"))
    lines = article_lines(spark, str(tmp_path))
    dealt = lines.groupBy(F.spark_partition_id()).count().collect()
    assert len(dealt) >= 4 and sum(r["count"] for r in dealt) == 3000 // 43 * 42 + 33
