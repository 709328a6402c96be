"""Article files with every known hazard, and the counts that come out of them."""

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import article, rows
from namewire.operators.names import drop_names, name_count_maps, name_counts, names_by_date
from namewire.operators.ranking import nest_top_names, top_names
from namewire.operators.rows import row_quality, valid_rows
from namewire.plans.daily import daily_top_names, write_daily_top_names
from namewire.sinks.ranked import write_ranked
from namewire.operators.event_time import assign_event_time
from namewire.sources.articles import article_table, read_articles, read_placed_lines, schema_from_descriptor
from namewire.sources.tables import article_lines

HAZARDS = [
    article("20240105230000", "Bob Ross,1;Ann,5;").encode(),
    article("20240105131500", "Ann,3;Type ParentCategory,4;,9").encode(),
    article("20240105001500", ",;Bob Ross,2").encode(),
    article("20240105120000", "Nobody,1", fields=26).encode(),
    article("20240105120000", "Nobody,1", fields=28).encode(),
    article("0", "Nobody,1").encode(),
    article("20240106120000", '"Quo, ted,1;Zoë,2').encode(),
    article("20240106120000", "").encode(),
    article("20240106120000", "Bad\udcff Byte,3").encode("utf-8", "surrogateescape"),
]


@pytest.fixture(scope="module")
def hazard_file(tmp_path_factory):
    folder = tmp_path_factory.mktemp("hazards")
    (folder / "20240105000000.gkg.csv").write_bytes(b"\n".join(HAZARDS) + b"\n")
    return str(folder)


def test_hazards(spark, hazard_file):
    found = names_by_date(read_articles(spark, hazard_file + "/*.csv"), clean=True)
    assert rows(found) == sorted([
        ("20240105", "Bob Ross"), ("20240105", "Ann"), ("20240105", "Ann"), ("20240105", "Bob Ross"),
        ("20240106", '"Quo'), ("20240106", "Zoë"), ("20240106", "Bad Byte")])


def test_row_quality(spark, hazard_file):
    lines = read_articles(spark, hazard_file)
    assert dict(rows(row_quality(lines))) == {
        "kept": 5, "wrong_field_count": 2, "unknown_date": 1, "no_names": 1}
    assert valid_rows(lines).count() == 7


def test_typed_table(spark, hazard_file):
    table = article_table(read_articles(spark, hazard_file))
    assert len(table.columns) == 27 and table.count() == 6
    first = table.where("all_names like 'Bob Ross,1%'").first()
    assert first.publish_date == dt.date(2024, 1, 5) and first.source_collection is None
    loose = article_table(read_articles(spark, hazard_file), drop_malformed=False)
    assert loose.count() == 9 and loose.where("publish_date is null").count() == 1


def test_schema_from_descriptor(spark, tmp_path):
    path = tmp_path / "headers.tsv"
    path.write_text("ID\tSTRING\tNULLABLE\t\nDAY\tDATE\tNULLABLE\t\nN\tINTEGER\tREQUIRED\t\n")
    assert schema_from_descriptor(spark, str(path)) == T.StructType([
        T.StructField("ID", T.StringType()), T.StructField("DAY", T.DateType()),
        T.StructField("N", T.IntegerType(), False)])


def test_ties(spark):
    names = ";".join(f"n{i:02d},1" for i in range(11)) + ";top,1;top,2"
    lines = spark.createDataFrame([(article(names=names),)], "value string")
    exact = rows(daily_top_names(lines).select("name"))
    assert exact == [(f"n{i:02d}",) for i in range(9)] + [("top",)]
    assert daily_top_names(lines, ties=True).count() == 12
    nested = nest_top_names(daily_top_names(lines)).first()
    assert [r.name for r in nested.top] == ["top"] + [f"n{i:02d}" for i in range(9)]


def test_ties_match_rank(spark, small):
    counts = name_counts(names_by_date(article_lines(spark, small)))
    pdf = counts.toPandas()
    rank = pdf.groupby("publish_date")["cnt"].rank(method="min", ascending=False)
    for k in (1, 3, 50):
        expected = sorted(map(tuple, pdf[rank <= k][["publish_date", "name", "cnt"]].values.tolist()))
        assert rows(top_names(counts, k, ties=True)) == expected


def test_counts_add_up(spark, small):
    mentions = names_by_date(article_lines(spark, small))
    counts = name_counts(mentions)
    assert counts.agg(F.sum("cnt")).first()[0] == mentions.count()
    maps = name_count_maps(counts, max_entries=500)
    again = maps.select("publish_date", F.explode("name_counts").alias("name", "cnt"))
    assert again.exceptAll(counts).count() == 0 and counts.exceptAll(again).count() == 0
    assert maps.agg(F.max(F.size("name_counts"))).first()[0] < 1000


def test_stop_list(spark):
    counts = spark.createDataFrame([("d", "a", 3), ("d", "b", 2)], "publish_date string, name string, cnt bigint")
    stop = spark.createDataFrame([("a",), ("a",)], "name string")
    assert rows(drop_names(counts, stop)) == [("d", "b", 2)]


def test_write_modes(spark, hazard_file, tmp_path):
    target = str(tmp_path / "out")
    write_daily_top_names(spark, hazard_file, target)
    write_daily_top_names(spark, hazard_file, target)
    back = spark.read.json(target)
    assert Counter(back.columns) == Counter(["publish_date", "name", "cnt"]) and back.count() == 5
    assert back.where("name = '\"Quo'").count() == 1
    with pytest.raises(Exception, match="already exists"):
        write_daily_top_names(spark, hazard_file, target, mode="errorifexists")
    text = str(tmp_path / "text")
    top = nest_top_names(daily_top_names(read_articles(spark, hazard_file)))
    write_ranked(top, text, "text", "errorifexists")
    assert spark.read.text(text).count() == 2
    parted = str(tmp_path / "parted")
    write_ranked(daily_top_names(read_articles(spark, hazard_file)), parted, "text", partition_by=["publish_date"])
    assert spark.read.text(parted).count() == 5


def test_reader_partitions(spark, hazard_file):
    assert read_articles(spark, hazard_file, partitions=1).rdd.getNumPartitions() == 1


def test_moved_splits_never_lose_lines(spark, tmp_path):
    """Files cut elsewhere by the second scan: the right rows or an error, never fewer rows."""
    lines = [article(f"2024010513{k % 60:02d}00", f"Ann,{k}", serial=k) for k in range(3000)]
    for part in range(3):
        (tmp_path / f"2024010513{part * 15:02d}00.gkg.csv").write_text("\n".join(lines[part * 1000:(part + 1) * 1000]) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
        placed = assign_event_time(read_placed_lines(spark, str(tmp_path)), consecutive=True)
        assert sorted(r.position for r in placed.collect()) == sorted(list(range(1000)) * 3)
        moved = assign_event_time(read_placed_lines(spark, str(tmp_path)), consecutive=True)
        spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
        try:
            got = sorted(r.position for r in moved.collect())
        except Exception as e:
            assert "splits" in str(e)
        else:
            assert got == sorted(list(range(1000)) * 3)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_combined_mentions_count_alike(spark):
    lists = ["Bob,1;Ann,2;Bob,3;", ";,9;Type ParentCategory,4;Type ParentCategory;Type ParentCategoryX,1", "", "Ann", "é,1;é;Ann,5,6;Bob"]
    made = [(article(f"2024010{1 + k % 2}130000", names, k), f"s{k % 3}") for k, names in enumerate(lists * 3)]
    lines = spark.createDataFrame([*made, (article(fields=26, names="Bob,1"), "s0"), (article("0", "Bob,1"), None)], "value string, segment string")
    keys = ["publish_date", "segment", "name"]
    each = name_counts(names_by_date(lines, keep=["segment"]), keys)
    combined = names_by_date(lines, keep=["segment"], weight="times")
    assert rows(name_counts(combined, keys, weight="times")) == rows(each)
    assert combined.count() < names_by_date(lines).count()


def test_combined_mentions_of_odd_lines(spark):
    lists = ["Bob,1;Ann,2;Bob,3;", ";,9;Type ParentCategory,4", "", "Ann", ",", ";", "é,1;é;Ann,5,6;Bob", "a;b;c;d"]
    made = [article(f"2024010{1 + k % 2}130000", names, k) for k, names in enumerate(lists * 2)]
    made += [article("20240101130000", "Eve,1", 1, fields=n) for n in (2, 23, 24, 25, 26, 28)] + [None, "", "\t" * 26, article("0", "Eve,1")]
    lines = spark.createDataFrame([(v,) for v in made], "value string").coalesce(1)
    bad = lines.select(F.concat(F.encode("value", "UTF-8"), F.unhex(F.lit("0920C328FF"))).cast("string").alias("value"))
    for some in (lines, bad, lines.limit(0), lines.where("value is null")):
        combined = names_by_date(some, weight="times")
        assert rows(name_counts(combined, weight="times")) == rows(name_counts(names_by_date(some)))
    last = spark.createDataFrame([("\t".join(["x", "20240101130000", *[""] * 21, "A,1;\u00e9", "", "", ""]),)], "value string")
    odd = last.select(F.concat(F.encode(F.lit("x\t20240101130000" + "\t" * 22 + "A"), "UTF-8"), F.unhex(F.lit("C328FFE282")), F.encode(
        F.lit(",1;B" + "\t" * 3), "UTF-8")).cast("string").alias("value"))
    assert rows(name_counts(names_by_date(odd, weight="times"), weight="times")) == rows(name_counts(names_by_date(odd)))
