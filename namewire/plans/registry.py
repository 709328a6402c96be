"""Every operator as a query over the given tables, with its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from namewire.functions import numbers, text, times
from namewire.operators import (
    bounded, changelog, event_time, interpolation, names, prices, ranking, rows, runs, trends, windows,
)
from namewire.plans import daily, oracle
from namewire.schema import FIRST_MARK, article_schema
from namewire.session import scratch_path, shared_root
from namewire.sinks import days, ranked, topics
from namewire.sources import articles, counts as count_source, prices as price_source, segments, tables
from namewire.streaming import feeding, live, mentions as live_mentions

Run = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Run] = {}
ORACLE: dict[str, str] = {}

SECOND = "yyyy-MM-dd HH:mm:ss"
MICRO = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def query(sql: str | None = None) -> Callable[[Run], Run]:
    def add(run: Run) -> Run:
        QUERIES[run.__name__] = run
        if sql:
            ORACLE[run.__name__] = sql
        return run

    return add


def _second(c) -> Column:
    return F.date_format(c, SECOND)


def _all_names(spark: SparkSession, d: str) -> DataFrame:
    return names.names_by_date(tables.article_lines(spark, d), weight="times")


def _all_counts(spark: SparkSession, d: str) -> DataFrame:
    return names.name_counts(_all_names(spark, d), weight="times")


# ---- names of articles -------------------------------------------------------------------

TOP = f"""with {oracle.COUNTS}
select publish_date, name, cnt from counts
qualify row_number() over (partition by publish_date order by cnt desc, name) <= 10"""


@query(TOP)
def top_names_per_day(spark, d):
    return daily.daily_top_names(tables.article_lines(spark, d))


@query(f"""with {oracle.COUNTS}
select publish_date, name, cnt from counts
qualify rank() over (partition by publish_date order by cnt desc) <= 10""")
def top_names_per_day_with_ties(spark, d):
    return daily.daily_top_names(tables.article_lines(spark, d), ties=True)


@query(f"""with {oracle.COUNTS}, top as (
  select publish_date, name, cnt, row_number() over (partition by publish_date order by cnt desc, name) as r
  from counts qualify r <= 10)
select publish_date, to_json(list({{'name': name, 'cnt': cnt}} order by r))::varchar as top
from top group by publish_date""")
def top_names_nested(spark, d):
    nested = ranking.nest_top_names(ranking.top_names(_all_counts(spark, d)))
    return nested.select("publish_date", F.to_json("top").alias("top"))


@query(f"with {oracle.COUNTS} select publish_date, name, cnt from counts")
def name_counts_per_day(spark, d):
    return _all_counts(spark, d)


@query(f"""with {oracle.COUNTS}
select publish_date, count(*) as names, cast(sum(cnt) as bigint) as mentions, max(cnt) as highest
from counts group by publish_date""")
def name_count_maps(spark, d):
    chunks = names.name_count_maps(_all_counts(spark, d), max_entries=2000)
    values = F.map_values("name_counts")
    return (
        chunks.select("publish_date", F.size("name_counts").alias("n"),
                      F.aggregate(values, F.lit(0).cast("bigint"), lambda a, v: a + v).alias("s"),
                      F.array_max(values).alias("m"))
        .groupBy("publish_date")
        .agg(F.sum("n").alias("names"), F.sum("s").alias("mentions"), F.max("m").alias("highest"))
    )


ROW_QUALITY = f"""with {oracle.LINES}
select case when len(string_split(value, chr(9))) <> 27 then 'wrong_field_count'
    when try_strptime(substr(string_split(value, chr(9))[2], 1, 8), '%Y%m%d') is null then 'unknown_date'
    when string_split(value, chr(9))[24] = '' then 'no_names' else 'kept' end as outcome,
  count(*) as rows
from lines group by outcome"""


@query(ROW_QUALITY)
def row_quality(spark, d):
    return rows.row_quality(tables.article_lines(spark, d))


@query(ROW_QUALITY)
def ranking_quality(spark, d):
    """Lines kept and rejected, counted by the very job that ranks their names."""
    seen = Observation("quality")
    ranked.write_ranked(daily.daily_top_names(tables.article_lines(spark, d), observed=seen), scratch_path(spark, "ranked"))
    return rows.quality_rows(spark, seen.get)


@query(TOP)
def incremental_top_names(spark, d):
    """Two thirds of the segments, then the rest with some of the first again, then that once more."""
    root = scratch_path(spark, "days")
    lines = tables.segment_lines(spark, d).select(F.col("file").alias("segment"), "value")
    draw = F.crc32(F.col("segment").cast("binary"))
    first, second = draw % 3 != 0, (draw % 3 == 0) | (draw % 5 == 0)
    for some in (first, second, second):
        days.add_segments(lines.where(some), root)
    return days.read_days(spark, root)


@query(f"""with {oracle.LINES}, {oracle.VALID}
select event_id, len(f) as fields, f[1] as record_id, length(f[24]) as names_length from valid""")
def valid_rows(spark, d):
    return rows.valid_rows(tables.article_lines(spark, d)).select(
        "event_id", F.size("fields").cast("bigint").alias("fields"),
        F.get("fields", F.lit(0)).alias("record_id"),
        F.length(F.get("fields", F.lit(23))).cast("bigint").alias("names_length"),
    )


ARTICLE_TABLE = f"""with {oracle.LINES}, {oracle.VALID}
select f[1] as record_id, strftime(strptime(f[2], '%Y%m%d%H%M%S'), '%Y-%m-%d') as publish_date,
  coalesce(cast(nullif(f[3], '') as bigint), -1) as source_collection, length(nullif(f[24], '')) as names_length
from valid"""


@query(ARTICLE_TABLE)
def article_table(spark, d):
    return _typed(articles.article_table(tables.article_lines(spark, d)))


def _typed(table: DataFrame) -> DataFrame:
    return table.select(
        "record_id", F.date_format("publish_date", "yyyy-MM-dd").alias("publish_date"),
        F.coalesce(F.col("source_collection").cast("bigint"), F.lit(-1).cast("bigint")).alias("source_collection"),
        F.length("all_names").cast("bigint").alias("names_length"),
    )


@query(ARTICLE_TABLE)
def described_table(spark, d):
    """The table's schema is read from a descriptor: name, type and mode of each field, a line each."""
    path = scratch_path(spark, "descriptor")
    kinds = {"int": "INTEGER"}
    described = [(f"{f.name}\t{kinds.get(f.dataType.simpleString(), f.dataType.simpleString().upper())}\tNULLABLE",) for f in article_schema()]
    spark.createDataFrame(described, "value string").coalesce(1).write.text(path)
    schema = articles.schema_from_descriptor(spark, path)
    return _typed(articles.article_table(tables.article_lines(spark, d), schema=schema))


@query(f"""with {oracle.LINES}, {oracle.VALID}
select strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S') as publish_minute, count(*) as articles
from valid group by all""")
def articles_per_minute(spark, d):
    minute = times.publish_time(F.get("fields", F.lit(1)), "minute")
    return (
        rows.valid_rows(tables.article_lines(spark, d))
        .groupBy(_second(minute).alias("publish_minute")).agg(F.count("*").alias("articles"))
    )


@query(f"""with {oracle.LINES}
select event_id, string_split(value, chr(9))[1] as key,
  cast(string_split(string_split(value, chr(9))[1], '-')[1] as bigint) as stamp,
  cast(string_split(string_split(value, chr(9))[1], '-')[2] as bigint) as serial
from lines""")
def record_ids(spark, d):
    keyed = tables.article_lines(spark, d).select("event_id", text.record_key("value").alias("key"))
    return keyed.withColumn("id", text.parse_record_id("key")).select("event_id", "key", "id.stamp", "id.serial")


@query(f"""with {oracle.COUNTS}, stop as (select distinct name from (
    select unnest(string_split(lower(p_name), ' ')) as name from part) union select 'the')
select publish_date, sum(cnt)::bigint as mentions, count(*) as names
from counts where name not in (select name from stop) group by publish_date""")
def stop_list_counts(spark, d):
    words = tables.table(spark, d, "part").select(F.explode(F.split(F.lower("p_name"), " ")).alias("name"))
    stop = words.union(words.select(F.lit("the"))).distinct()
    kept = names.drop_names(_all_counts(spark, d), stop)
    return kept.groupBy("publish_date").agg(F.sum("cnt").alias("mentions"), F.count("*").alias("names"))


@query("""select doc_id, length(replace(text, chr(65533), '')) as clean_length,
  md5(replace(text, chr(65533), '')) as digest from documents""")
def clean_texts(spark, d):
    """Every text with bytes around it that are not UTF-8."""
    bad = F.concat(F.unhex(F.lit("C3")), F.encode("text", "UTF-8"), F.unhex(F.lit("FFE282"))).cast("string")
    clean = text.clean_utf8(bad)
    return tables.table(spark, d, "documents").select(
        "doc_id", F.length(clean).cast("bigint").alias("clean_length"), F.md5(clean).alias("digest"))


@query("select event_type as name, cast(sum(cast(floor(value) as bigint)) as bigint) as cnt from events group by 1")
def weighted_counts(spark, d):
    increments = tables.table(spark, d, "events").select(
        F.col("event_type").alias("name"), F.floor("value").cast("bigint").alias("increment"))
    return names.name_counts(increments, by=["name"], weight="increment")


@query(TOP)
def top_names_from_files(spark, d):
    folder = scratch_path(spark, "articles")
    tables.article_lines(spark, d).select("value").write.text(folder, compression="gzip")
    return daily.daily_top_names(articles.read_articles(spark, folder))


@query(TOP)
def written_top_names(spark, d):
    folder = scratch_path(spark, "ranked")
    ranked.write_ranked(daily.daily_top_names(tables.article_lines(spark, d)), folder, partition_by=["publish_date"])
    back = spark.read.schema("name string, cnt bigint, publish_date string").json(folder)
    return back.select("publish_date", "name", "cnt")


@query(TOP)
def text_top_names(spark, d):
    """Written as text, one JSON object a line, over an older result in the same folder."""
    folder = scratch_path(spark, "ranked-text")
    shared_root(spark)
    top = daily.daily_top_names(tables.article_lines(spark, d)).checkpoint()  # written twice, ranked once
    ranked.write_ranked(top.limit(1), folder, form="text", mode="errorifexists")
    ranked.write_ranked(top, folder, form="text", mode="overwrite")
    row = F.from_json("value", "publish_date string, name string, cnt bigint")
    return spark.read.text(folder).select(row.alias("r")).select("r.*")


@query(TOP)
def top_names_in_few_partitions(spark, d):
    folder = scratch_path(spark, "articles")
    tables.article_lines(spark, d).select("value").coalesce(12).write.text(folder, compression="gzip")
    return daily.daily_top_names(articles.read_articles(spark, folder, partitions=3))


@query(f"""with {oracle.LINES}
select string_split(value, chr(9))[1] as key, md5(value) as digest, 0 as partition,
  strftime(ts, '%Y-%m-%d %H:%M:%S') as event_time from lines""")
def published_lines(spark, d):
    lines = tables.article_lines(spark, d).withColumnRenamed("ts", "event_time")
    return topics.line_records(lines, topic="articles", partition=0).select(
        "key", F.md5("value").alias("digest"), "partition", _second("event_time").alias("event_time"))


# ---- windows -----------------------------------------------------------------------------

HOPPING = """with hops as (
  select event_type as name, date_trunc('minute', ts) - to_minutes(cast(i as integer)) as window_start
  from events, range(0, 60) r(i))
select strftime(window_start, '%Y-%m-%d %H:%M:%S') as window_start,
  strftime(window_start + interval 1 hour, '%Y-%m-%d %H:%M:%S') as window_end, name, count(*) as cnt
from hops group by all"""


def _printed(counts: DataFrame) -> DataFrame:
    return counts.select(_second("window_start").alias("window_start"), _second("window_end").alias("window_end"),
                         "name", "cnt")


@query(HOPPING)
def hopping_counts(spark, d):
    return _printed(windows.hopping_counts(tables.mentions(spark, d)))


@query("""with e as (select date_trunc('minute', max(ts)) as w from events)
select strftime(w - interval 1 hour, '%Y-%m-%d %H:%M:%S') as window_start,
  strftime(w, '%Y-%m-%d %H:%M:%S') as window_end, cast(user_id as varchar) as name, count(*) as cnt
from events, e where ts >= w - interval 1 hour and ts < w group by all""")
def latest_complete_window(spark, d):
    events = tables.table(spark, d, "events").select("ts", F.col("user_id").cast("string").alias("name"))
    return _printed(windows.newest_counts(events))


@query("""with e as (select date_trunc('minute', max(ts)) as w from events)
select strftime(w, '%Y-%m-%d %H:%M:%S') as window_start,
  strftime(w + interval 1 hour, '%Y-%m-%d %H:%M:%S') as window_end, event_type as name, count(*) as cnt
from events, e where ts >= w and ts < w + interval 1 hour group by all""")
def latest_started_window(spark, d):
    return _printed(windows.newest_counts(tables.mentions(spark, d), complete=False))


@query("""select event_id, event_type as name, count(*) over (
  partition by event_type order by ts range between interval 1 hour preceding and current row) as trailing_cnt
from events""")
def trailing_hour_count(spark, d):
    return windows.trailing_hour_count(tables.mentions(spark, d)).select("event_id", "name", "trailing_cnt")


# ---- changelogs --------------------------------------------------------------------------

@query(f"with {oracle.STATE} select name, cnt from live")
def fold_changelog(spark, d):
    return changelog.fold_changelog(tables.changelog(spark, d))


@query(f"""with {oracle.CHANGELOG}
select strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') as tick, name, cnt from changelog
qualify row_number() over (partition by date_trunc('second', ts), name order by seq desc) = 1""")
def conflate_seconds(spark, d):
    return changelog.conflate(tables.changelog(spark, d)).withColumn("tick", _second("tick"))


@query(f"""with {oracle.CHANGELOG}
select strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') as tick, name, cnt from changelog
qualify row_number() over (partition by date_trunc('day', ts), name order by seq desc) = 1""")
def conflate_days(spark, d):
    return changelog.conflate(tables.changelog(spark, d), every=86_400).withColumn("tick", _second("tick"))


@query(f"""with {oracle.CHANGELOG}, mid as (select max(seq) // 2 as cut from changelog)
select 'snapshot' as part, -1 as seq, name, cnt from (
  select name, cnt from changelog, mid where seq <= cut
  qualify row_number() over (partition by name order by seq desc) = 1) where cnt <> 0
union all select 'delta', seq, name, cnt from changelog, mid where seq > cut""")
def snapshot_and_delta(spark, d):
    log = tables.changelog(spark, d)
    at = log.select(F.floor(F.max("seq") / 2)).scalar()
    snapshot, delta = changelog.snapshot_and_delta(log, at)
    tag = snapshot.select(F.lit("snapshot").alias("part"), F.lit(-1).cast("bigint").alias("seq"), "name", "cnt")
    return tag.unionByName(delta.select(F.lit("delta").alias("part"), "seq", "name", "cnt"))


@query(f"with {oracle.STATE} select name, cnt from live order by cnt desc, name limit 100")
def topk_snapshot(spark, d):
    return ranking.topk_snapshot(changelog.fold_changelog(tables.changelog(spark, d)))


@query(f"with {oracle.STATE} select name, cnt, (select max(cnt) from live) as axis_max from live")
def histogram_view(spark, d):
    state = changelog.fold_changelog(tables.changelog(spark, d))
    return ranking.histogram_view(state, sort_by="cnt", ascending=False)


@query(f"""with {oracle.STATE}, top as (select name, cnt from live order by cnt desc, name limit 100)
select to_json(list({{'name': name, 'count': cnt}} order by name))::varchar as message from top""")
def top_message(spark, d):
    state = changelog.fold_changelog(tables.changelog(spark, d))
    return changelog.bounded_message(ranking.topk_snapshot(state))


@query(f"""with {oracle.CHANGELOG}
select strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') as tick, name, cnt from changelog
qualify row_number() over (partition by date_trunc('day', ts), name order by seq desc) = 1""")
def update_messages(spark, d):
    ticks = changelog.conflate(tables.changelog(spark, d), every=86_400)
    messages = changelog.json_message(ticks, ["tick"], max_entries=50)
    sent = F.from_json("message", "array<struct<name string, count bigint>>")
    return messages.select(_second("tick").alias("tick"), F.inline(sent)).withColumnRenamed("count", "cnt")


@query("""select user_id as partition, arg_max(concat(strftime(ts, '%Y%m%d%H%M%S'), '-', event_id), event_id) as last_key
from events group by user_id""")
def last_key_per_partition(spark, d):
    return changelog.last_key(_keyed_events(spark, d), by=["partition"])


@query("""select concat(strftime(ts, '%Y%m%d%H%M%S'), '-', event_id) as last_key
from events order by event_id desc limit 1""")
def last_key(spark, d):
    return changelog.last_key(_keyed_events(spark, d))


def _keyed_events(spark: SparkSession, d: str) -> DataFrame:
    return tables.table(spark, d, "events").select(
        F.col("user_id").alias("partition"), F.col("event_id").alias("offset"),
        F.concat_ws("-", F.date_format("ts", "yyyyMMddHHmmss"), "event_id").alias("key"))


BOUNDED = f"""with recursive {oracle.CHANGELOG}, log as (
  select cast(name as bigint) % 16 as bucket, seq, name, cnt,
    row_number() over (partition by cast(name as bigint) % 16 order by seq, name) as rn from changelog),
replay as (
  select distinct bucket, 0::bigint as rn, []::struct(c bigint, n varchar)[] as held, false as taken,
    null::varchar as gone, null::bigint as seq, null::varchar as name, null::bigint as cnt from log
  union all
  select bucket, rn, case when not takes then held
      else list_filter(held, lambda x: x.n <> name and (leaves is null or x.n <> leaves)) || [{{'c': cnt, 'n': name}}] end,
    takes, leaves, seq, name, cnt
  from (select *, known or room or cnt > low.c as takes, case when not known and not room and cnt > low.c then low.n end as leaves
    from (select l.bucket, l.rn, l.seq, l.name, l.cnt, r.held, list_sort(r.held)[1] as low,
        len(r.held) < 5 as room, list_contains(list_transform(r.held, lambda x: x.n), l.name) as known
      from replay r join log l on l.bucket = r.bucket and l.rn = r.rn + 1)))
select bucket::int as bucket, seq, name, cnt, false as evicted from replay where taken
union all select bucket::int, seq, gone, 0, true from replay where gone is not null"""


@query(BOUNDED)
def bounded_topk(spark, d):
    """Five names a bucket, so that names are evicted."""
    return bounded.bounded_topk(
        tables.changelog(spark, d), capacity=5, buckets=16, bucket=F.col("name").cast("bigint") % 16
    ).select("bucket", "seq", "name", "cnt", "evicted")


@query(f"with {oracle.CHANGELOG} select name, cnt, seq from changelog")
def count_records(spark, d):
    log = tables.changelog(spark, d)
    sent = topics.count_records(log.withColumnRenamed("seq", "offset"), keep=["offset"])
    return count_source.decode_counts(sent).select("name", "cnt", F.col("offset").alias("seq"))


@query(f"with {oracle.CHANGELOG} select name, cnt from changelog")
def stream_count_records(spark, d):
    """Records in a folder that stands for a topic, decoded by a stream in several batches."""
    root = scratch_path(spark, "counts")
    topics.count_records(tables.changelog(spark, d)).repartition(6).write.parquet(f"{root}/topic")
    decoded = count_source.stream_counts(spark, f"{root}/topic", "parquet")
    topics.sink_changelog(decoded, f"{root}/checkpoint", f"{root}/out", trigger={"availableNow": True},
                          output_mode="append").awaitTermination()
    return live.stored_epochs(spark, f"{root}/out").select("name", "cnt")


# ---- segment files -----------------------------------------------------------------------

@query(f"""with {oracle.LINES}, placed as (
  select {oracle.SEGMENT} || '.gkg.csv' as file, event_id, value,
    row_number() over w - 1 as position, count(*) over (partition by {oracle.SEGMENT}) as n,
    first_value(value) over w as head
  from lines window w as (partition by {oracle.SEGMENT} order by event_id))
select file, event_id, position,
  strftime(strptime(substr(head, 1, 12), '%Y%m%d%H%M')
    + to_milliseconds(position * (900000 // n)), '%Y-%m-%d %H:%M:%S.%f') as event_time
from placed""")
def assign_event_time(spark, d):
    return event_time.assign_event_time(tables.segment_lines(spark, d)).select(
        "file", F.col("line_id").alias("event_id"), "position",
        F.date_format("event_time", MICRO).alias("event_time"))


def _whole_span(spark: SparkSession, d: str) -> DataFrame:
    """Clock at the newest event, with a window back to the first."""
    epoch = F.unix_seconds("ts")
    return tables.table(spark, d, "events").agg(
        F.max("ts").alias("now"), F.ceil((F.max(epoch) - F.min(epoch)) / 900).alias("n")
    ).withColumn("window", F.col("n") * 15)


EXPECTED = """expected as (
  select strftime(s, '%Y%m%d%H%M00') || '.gkg.csv' as file_name from (
    select unnest(generate_series(last + interval 15 minute - to_minutes(cast(15 * n as bigint)), last, interval 15 minute)) as s
    from (select time_bucket(interval 15 minute, max(ts)) - interval 15 minute as last,
            ceil((floor(epoch(max(ts))) - floor(epoch(min(ts)))) / 900) as n from events)))"""
ARRIVED = f"arrived as (select distinct {oracle.SEGMENT} || '.gkg.csv' as file_name from events)"


@query(f"with {EXPECTED} select file_name from expected")
def expected_segments(spark, d):
    return segments.expected_segments(_whole_span(spark, d), window_minutes=F.col("window")).select("file_name")


@query("""select strftime(unnest([last - interval 45 minute, last - interval 30 minute, last - interval 15 minute, last]),
  '%Y%m%d%H%M00') || '.gkg.csv' as file_name
from (select time_bucket(interval 15 minute, max(ts)) - interval 15 minute as last from events)""")
def last_hour_segments(spark, d):
    clock = tables.table(spark, d, "events").agg(F.max("ts").alias("now"))
    return segments.expected_segments(clock).select("file_name")


@query(f"""with {EXPECTED}, {ARRIVED}
select file_name from expected where file_name not in (select file_name from arrived)""")
def missing_segments(spark, d):
    expected = segments.expected_segments(_whole_span(spark, d), window_minutes=F.col("window"))
    return segments.missing_segments(expected, tables.arrived_segments(spark, d)).select("file_name")


@query(f"with {ARRIVED} select file_name from arrived where file_name > '{FIRST_MARK}'")
def new_segments(spark, d):
    return segments.new_segments(tables.arrived_segments(spark, d))


@query(f"""with {ARRIVED}
select '/v2/gkg/' || file_name as path, file_name from arrived""")
def manifest_entries(spark, d):
    line = F.concat_ws(" ", F.length("file_name"), F.md5("file_name"),
                       F.concat(F.lit("http://example.org/v2/gkg/"), "file_name"))
    lines = tables.arrived_segments(spark, d).select(line.alias("value"))
    return segments.manifest_entries(lines).select("path", "file_name")


@query(f"""with {ARRIVED}
select '/v2/gkg/' || file_name as path, file_name, '/data/' || file_name as local_path
from (select file_name from arrived order by file_name limit 100)""")
def first_manifest_files(spark, d):
    """The first hundred lines of a manifest of all files, in the manifest's order."""
    path = scratch_path(spark, "manifest")
    line = F.concat(F.length("file_name"), F.lit(" http://example.org/v2/gkg/"), "file_name")
    tables.arrived_segments(spark, d).orderBy("file_name").select(line.alias("value")).write.text(path)
    return segments.manifest_files(spark, path, 100, "/data")


@query("""select event_id,
  strftime(time_bucket(interval 15 minute, ts) + interval 15 minute, '%Y-%m-%d %H:%M:%S') as boundary from events""")
def next_boundary(spark, d):
    return tables.table(spark, d, "events").select("event_id", _second(times.next_boundary("ts")).alias("boundary"))


# ---- prices, runs and trends -------------------------------------------------------------

@query(f"""with {oracle.PRICES}, half as (select min(ts) + (max(ts) - min(ts)) / 2 as cut from events)
select instance_type, zone, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') as ts, price from prices, half
where product = 'Linux/UNIX' and instance_type in ('c0', 'm1', 'r2', 'c3') and ts >= cut""")
def price_history(spark, d):
    half = tables.table(spark, d, "events").select(
        F.timestamp_micros(F.floor((F.unix_micros(F.min("ts")) + F.unix_micros(F.max("ts"))) / 2))).scalar()
    kept = price_source.price_history(
        tables.prices(spark, d), ["c0", "m1", "r2", "c3"], "Linux/UNIX", since=half)
    return kept.select("instance_type", "zone", F.date_format("ts", MICRO).alias("ts"), "price")


@query(f"with {oracle.LATEST} select instance_type, zone, price from latest")
def latest_price(spark, d):
    return _latest(spark, d)


def _latest(spark: SparkSession, d: str) -> DataFrame:
    return prices.latest_price(tables.prices(spark, d), tie="event_id")


@query(f"with {oracle.CHEAPEST} select instance_type, zone, min_price from cheapest")
def cheapest_zone(spark, d):
    return prices.cheapest_zone(_latest(spark, d))


@query(f"""with {oracle.PRICES}
select instance_type, zone, substr(zone, length(zone) - 1, 1) as region,
  strftime(ts, '%Y-%m-%d %H:%M:%S.%f') as ts, price from prices""")
def price_series(spark, d):
    points = tables.prices(spark, d)
    first, second = (points.where(prices.region_digit("zone") == r) for r in ("1", "2"))
    return prices.price_series(first, second).withColumn("ts", F.date_format("ts", MICRO))


@query(f"""with {oracle.CHEAPEST}, {oracle.ATTRIBUTES}
select instance_type, case instance_type[1] when 'c' then 'compute optimized' when 'm' then 'general purpose'
    when 'r' then 'memory optimized' end as family, zone, min_price,
  round(try_cast(replace(regexp_extract(memory, '{text.NUMBER}', 1), ',', '') as double) / nullif(min_price, 0), 6) as memory_efficiency,
  round(try_cast(replace(regexp_extract(ecu, '{text.NUMBER}', 1), ',', '') as double) / nullif(min_price, 0), 6) as ecu_efficiency
from attributes join cheapest using (instance_type)""")
def cost_efficiency(spark, d):
    out = prices.cost_efficiency(tables.attributes(spark, d), prices.cheapest_zone(_latest(spark, d)))
    return out.withColumn("memory_efficiency", F.round("memory_efficiency", 6)).withColumn(
        "ecu_efficiency", F.round("ecu_efficiency", 6))


@query(f"""with {oracle.ATTRIBUTES}
select instance_type, try_cast(replace(regexp_extract(memory, '{text.NUMBER}', 1), ',', '') as double) as memory,
  try_cast(replace(regexp_extract(ecu, '{text.NUMBER}', 1), ',', '') as double) as ecu from attributes""")
def leading_numbers(spark, d):
    return tables.attributes(spark, d).select(
        "instance_type", text.leading_number("memory").alias("memory"), text.leading_number("ecu").alias("ecu"))


@query("""select event_id, round(0.05 * round_even(value / 0.05, 0), 3) as rounded from events""")
def rounded_values(spark, d):
    return tables.table(spark, d, "events").select("event_id", numbers.round_to("value", 0.05).alias("rounded"))


@query("select l_orderkey as run_id, sum(l_quantity) as run_seconds from lineitem group by 1")
def run_times(spark, d):
    return runs.run_times(tables.stages(spark, d))


def _costs(spark: SparkSession, d: str) -> DataFrame:
    cheapest = prices.cheapest_zone(_latest(spark, d)).select("instance_type", F.col("min_price").alias("price"))
    return runs.run_cost(tables.runs(spark, d), cheapest)


@query(f"with {oracle.COSTS} select run_id, instance_type, instances, data_size, cost from costs")
def run_cost(spark, d):
    return _costs(spark, d).select("run_id", "instance_type", "instances", "data_size", "cost")


@query(f"""with {oracle.CHEAPEST}, {oracle.RUNS}, {oracle.BY_REGION}
select run_id, instance_type, region, runtime_min / 60 * instances * price as cost
from (select *, (run_id % 2 + 1)::varchar as region from runs) join by_region using (instance_type, region)""")
def run_cost_by_region(spark, d):
    """Runs are priced at the cheapest zone of their own region."""
    cheapest = _latest(spark, d).groupBy("instance_type", prices.region_digit("zone").alias("region")).agg(
        F.min("price").alias("price"))
    done = tables.runs(spark, d).withColumn("region", (F.col("run_id") % 2 + 1).cast("string"))
    return runs.run_cost(done, cheapest, on=["instance_type", "region"]).select("run_id", "instance_type", "region", "cost")


@query(f"""with {oracle.PRICES}, {oracle.TIMED_RUNS}
select run_id, t.instance_type, t.zone, strftime(started, '%Y-%m-%d %H:%M:%S.%f') as started, p.price,
  runtime_min / 60 * instances * p.price as cost
from timed t asof left join prices p on t.instance_type = p.instance_type and t.zone = p.zone and t.started >= p.ts""")
def run_cost_at_start(spark, d):
    """Runs are priced at what their type cost in their zone when they began."""
    out = runs.cost_at_start(tables.timed_runs(spark, d), tables.prices(spark, d), tie="event_id")
    return out.select("run_id", "instance_type", "zone", F.date_format("started", MICRO).alias("started"), "price", "cost")


@query(f"""with {oracle.PRICES}, {oracle.TIMED_RUNS}, held as (
  select instance_type, zone, price, ts as low, lead(ts, 1, timestamp '9999-01-01') over (
    partition by instance_type, zone order by ts) as high from prices),
met as (select run_id, epoch_us(least(ended, high)) - epoch_us(greatest(started, low)) as micros, price
  from timed t join held h on t.instance_type = h.instance_type and t.zone = h.zone and low < ended and high > started)
select t.run_id, t.instance_type, t.zone, round(coalesce(sum(micros) / 3.6e9, 0) + 1e-9, 6) as covered_hours,
  round(coalesce(sum(micros / 3.6e9 * price), 0) * any_value(instances) + 1e-9, 6) as cost
from timed t left join met using (run_id) group by all""")
def run_cost_over_prices(spark, d):
    """Runs pay the price of the hour, as it changes while they run. Rounded off the exact halves, which sums miss by a bit."""
    out = runs.cost_over_prices(tables.timed_runs(spark, d), tables.prices(spark, d), tie="event_id")
    return out.select("run_id", "instance_type", "zone", F.round(F.col("covered_hours") + 1e-9, 6).alias("covered_hours"),
                      F.round(F.col("cost") + 1e-9, 6).alias("cost"))


@query(f"""with {oracle.COSTS}, means as (
  select data_size, instance_type, instances, avg(cost) as cost from costs group by all)
select data_size, instance_type, instances, round(cost, 6) as cost from means
qualify row_number() over (partition by data_size order by means.cost, instance_type, instances) = 1""")
def cheapest_config(spark, d):
    return runs.cheapest_config(_costs(spark, d)).withColumn("cost", F.round("cost", 6))


@query(f"""with {oracle.RUNS}
select instance_type, instances, round(avg(runtime_min) filter (data_size = '1-URGENT')
  / avg(runtime_min) filter (data_size = '5-LOW'), 6) as ratio from runs group by all""")
def scaling_ratio(spark, d):
    out = runs.scaling_ratio(tables.runs(spark, d), "1-URGENT", "5-LOW")
    return out.select("instance_type", "instances", F.round("ratio", 6).alias("ratio"))


@query("""select round(regr_intercept(value, event_id), 8) as c0, round(regr_slope(value, event_id), 8) as c1
from events""")
def linear_trend(spark, d):
    return trends.linear_trend(tables.points(spark, d)).select(
        F.round("c0", 8).alias("c0"), F.round("c1", 8).alias("c1"))


@query("""with t as (select regr_intercept(value, event_id) as c0, regr_slope(value, event_id) as c1 from events)
select x, round(c0 + c1 * x, 6) as predicted from t, (select unnest([1.0::double, 10000.0::double]) as x)""")
def trend_prediction(spark, d):
    fitted = trends.linear_trend(tables.points(spark, d))
    return trends.predict(fitted, [1, 10000]).withColumn("predicted", F.round("predicted", 6))


@query(f"""with {oracle.RUNS}, m as (select data_size, avg(instances) as mx from runs group by 1),
s as (select data_size, any_value(mx) as mx, count(*)::double as n, sum(u) as s1, sum(u*u) as s2, sum(u*u*u) as s3,
    sum(u*u*u*u) as s4, sum(y) as t0, sum(u*y) as t1, sum(u*u*y) as t2
  from (select r.data_size, mx, instances - mx as u, runtime_min as y from runs r join m using (data_size)) group by 1),
f as (select *, n*(s2*s4 - s3*s3) - s1*(s1*s4 - s2*s3) + s2*(s1*s3 - s2*s2) as det from s),
c as (select data_size, mx,
    (t0*(s2*s4 - s3*s3) - s1*(t1*s4 - s3*t2) + s2*(t1*s3 - s2*t2)) / det as a0,
    (n*(t1*s4 - s3*t2) - t0*(s1*s4 - s2*s3) + s2*(s1*t2 - t1*s2)) / det as a1,
    (n*(s2*t2 - t1*s3) - s1*(s1*t2 - t1*s2) + t0*(s1*s3 - s2*s2)) / det as a2 from f)
select data_size, round(a0 - a1*mx + a2*mx*mx, 6) as c0, round(a1 - 2*a2*mx, 6) as c1, round(a2, 6) as c2 from c""")
def quadratic_trend(spark, d):
    out = trends.quadratic_trend(tables.runs(spark, d), "instances", "runtime_min", ["data_size"])
    return out.select("data_size", *[F.round(c, 6).alias(c) for c in ("c0", "c1", "c2")])


INTERPOLATE = """seg as (select {by} x as x0, y as y0, lead(x) over w as x1, lead(y) over w as y1,
    min(x) over (partition by {part}) as lo, max(x) over (partition by {part}) as hi from knots
  window w as (partition by {part} order by x)),
grid as (select distinct {by} i, case when i = 1000 then hi else lo + i * ((hi - lo) / 1000.0) end as x
  from seg, range(0, 1001) r(i))
select {sel} g.i, round(g.x, 6) as x,
  round(case when x1 is null then y0 else y0 + (g.x - x0) * (y1 - y0) / (x1 - x0) end, 6) as y
from grid g asof join seg s on {on} g.x >= s.x0"""


@query(f"""with {oracle.RUNS}, knots as (
  select data_size, instances::double as x, avg(runtime_min) as y from runs group by all),
{INTERPOLATE.format(by='data_size,', part='data_size', sel='g.data_size,', on='g.data_size = s.data_size and')}""")
def interpolate_run_times(spark, d):
    knots = tables.runs(spark, d).groupBy("data_size", F.col("instances").alias("x")).agg(
        F.avg("runtime_min").alias("y"))
    out = interpolation.interpolate(knots, by=["data_size"])
    return out.select("data_size", "i", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


@query(f"""with knots as (select event_id::double as x, value as y from events),
{INTERPOLATE.format(by='', part='1', sel='', on='')}""")
def interpolate_points(spark, d):
    out = interpolation.interpolate(tables.points(spark, d), width=4096)
    return out.select("i", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


# ---- streams -----------------------------------------------------------------------------

def _drain(spark: SparkSession, updates: DataFrame, label: str) -> DataFrame:
    """Run a stream over what is there, and read back the micro-batches it wrote."""
    root = scratch_path(spark, label)
    with feeding.state_partitions(spark):
        run = topics.sink_changelog(updates, f"{root}/checkpoint", f"{root}/out", trigger={"availableNow": True})
    run.awaitTermination()
    return live.stored_epochs(spark, f"{root}/out")


def _event_stream(spark: SparkSession, d: str) -> DataFrame:
    path = f"{d}/events.parquet"
    reader = spark.readStream.schema(tables.table_schema(spark, path)).option("maxFilesPerTrigger", 4)
    return reader.parquet(path) if tables.is_folder(spark, path) else reader.option(
        "pathGlobFilter", "events.parquet").parquet(d)


@query(HOPPING)
def stream_hopping_counts(spark, d):
    events = _event_stream(spark, d).select("ts", F.col("event_type").alias("name"))
    log = _drain(spark, live_mentions.live_hopping_counts(events), "hopping")
    state = log.groupBy("window_start", "window_end", "name").agg(F.max_by("cnt", "epoch").alias("cnt"))
    return _printed(state)


@query(HOPPING)
def stream_minute_counts(spark, d):
    events = _event_stream(spark, d).select("ts", F.col("event_type").alias("name"))
    log = _drain(spark, live_mentions.live_minute_counts(events), "minutes")
    slots = log.groupBy("window_start", "name").agg(F.max_by("cnt", "epoch").alias("cnt"))
    return _printed(windows.hopping_counts(slots, "window_start", weight="cnt"))


@query(TOP)
def stream_daily_top_names(spark, d):
    folder = scratch_path(spark, "lines")
    tables.article_lines(spark, d).select("value").write.text(folder, compression="gzip")
    found = live_mentions.stream_mentions(articles.stream_articles(spark, folder), weight="times", slot=86_400)
    log = _drain(spark, live_mentions.live_hopping_counts(found, "1 day", "1 day", late="60 days", weight="times"), "days")
    counts = log.groupBy(F.date_format("window_start", "yyyyMMdd").alias("publish_date"), "name").agg(
        F.max_by("cnt", "epoch").alias("cnt"))
    return ranking.top_names(counts)
