"""Prefix trie of conversations, by truncation peeling.

A conversation is a sequence of turns; every prefix that occurs is a node. Nodes are found
from the deepest level up: conversations that end in the range of depths at hand are merged
with the nodes that survive from below it, all are grouped by what their prefixes hash to,
their last turns are stripped, and what is left goes on as nodes of the next range.
Ranges are (2^(k-1), 2^k]: a round strips the later half of what is left of its longest
members, so there are as many rounds as the longest conversation has binary digits, and
a prefix that many share is one row from the round after it was first met.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from namewire.llm.base import stored, table

ROOT = b""
RUN_BITS = 12  # ids are hashed in runs of 2^12
TIMES = 9
FAMILY = 5
STEPS = "conv_id long, depth int, key binary, parent binary, before long, bytes long, last boolean, band int"


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, position, digest, bytes) of every turn: its place from 1 on, a hash of role and text, the text's size.

    Turns are ordered by ``turn`` (null first), equal ones by role and then by digest. A null role
    or text counts as empty. Rows without a conv_id belong to no conversation and drop out.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"),
        F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))).alias("digest"),
        F.octet_length(text).cast("long").alias("bytes"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "digest")
    return turns.select("conv_id", F.row_number().over(order).alias("position"), "digest", "bytes")


def band_of(depth: str | Column) -> Column:
    """k where a depth lies in (2^(k-1), 2^k]; 0 for depths 0 and 1."""
    c = F.col(depth) if isinstance(depth, str) else depth
    return F.when(c <= 1, 0).otherwise(F.length(F.bin(c.cast("long") - 1))).cast("int")


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one conversation after the other, in order, to their prefixes; holds one row and one hash."""
    names = [part.split()[0] for part in STEPS.split(", ")]
    kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.bool_(), pa.int32()]
    held = None

    def row(last: bool) -> tuple:
        conv, depth, key, parent, before, size = held
        return conv, depth, key, parent, before, size, last, (depth - 1).bit_length() if depth > 1 else 0

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows) if rows else [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(list(c), kind) for c, kind in zip(columns, kinds)], names)

    for batch in batches:
        out = []
        for conv, digest, size in zip(*(batch.column(k).to_pylist() for k in (0, 2, 3))):
            if digest is None:  # a conversation begins
                if held is not None:
                    out.append(row(True))
                held = (conv, 0, ROOT, None, 0, 0)
                continue
            _, depth, key, _, before, above = held
            if depth:
                out.append(row(False))
            held = (conv, depth + 1, hashlib.md5(key + digest).digest(), key, before + above, size)
        yield batch_of(out)
    if held is not None:
        yield batch_of([row(True)])


def prefixes(turns: DataFrame, conv_ids: DataFrame) -> DataFrame:
    """Every prefix of every conversation, one row a turn, written by range of depths.

    ``turns`` are (conv_id, position, digest, bytes), ``conv_ids`` all conversations, also those
    without turns, which give one row of depth 0. ``key`` is a 128-bit hash of the prefix, ``parent`` that of
    the prefix without its last turn, ``before`` the bytes of the turns before the last. ``last``
    marks the whole conversation.
    """
    begin = conv_ids.select("conv_id", F.lit(0).alias("position"), F.lit(None).cast("binary").alias("digest"),
                            F.lit(0).cast("long").alias("bytes"))
    rows = turns.select("conv_id", "position", "digest", "bytes").unionByName(begin)
    return (rows.repartition("conv_id").sortWithinPartitions("conv_id", "position")
            .mapInArrow(_chained, STEPS))


def joined_hash(ids: DataFrame) -> DataFrame:
    """(key, ids_sha256) of (key, conv_id): SHA-256 of each key's ids, ascending, with commas between.

    Ids are first joined in runs of 4,096 neighbouring numbers, wherever those lie; the texts of
    the runs then pass by a running hash in order, so that no key's ids are ever held together.
    """
    runs = ids.groupBy("key", F.shiftright("conv_id", RUN_BITS).alias("run")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("text"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, sha = None, None
        for batch in batches:
            keys, digests = [], []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if key != at:
                    if sha is not None:
                        keys.append(at)
                        digests.append(sha.hexdigest())
                    at, sha = key, hashlib.sha256(text.encode())
                else:
                    sha.update(b"," + text.encode())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(digests, pa.string())], ["key", "ids_sha256"])
        if sha is not None:
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.binary()), pa.array([sha.hexdigest()], pa.string())],
                                             ["key", "ids_sha256"])

    return (runs.repartition("key").sortWithinPartitions("key", "run").select("key", "text")
            .mapInArrow(hashed, "key binary, ids_sha256 string"))


def peel(steps: DataFrame, members: DataFrame) -> DataFrame:
    """The nodes of one range of depths, with what their subtrees sum to.

    ``members`` are rows (rep, top, w, ends, leaves, saved, total): a node at depth ``top``, known by
    its smallest conversation ``rep``, with ``w`` conversations of which ``ends`` end there, and what has
    been summed below it; ``total`` is the bytes of its path. ``steps`` are the prefixes of the range.

    A path's nodes of which ``rep`` is the smallest member are a run at its lower end: the
    path *owns* those. Bytes of different nodes are summed by owner, so that every sum is one
    grouping over paths, not one a level.
    """
    def paths(some: DataFrame) -> DataFrame:
        return some.join(steps, (F.col("rep") == F.col("conv_id")) & (F.col("depth") <= F.col("top")))

    nodes = stored(
        paths(members).groupBy("depth", "key", "parent", "before", "bytes").agg(
            F.min("rep").alias("conv_id"), F.sum("w").alias("n_convs"),
            F.sum(F.when(F.col("depth") == F.col("top"), F.col("ends")).otherwise(0)).alias("n_ends")),
        "nodes")
    owners = nodes.groupBy(F.col("conv_id").alias("rep")).agg(
        F.min("depth").alias("own"), F.min("before").alias("own_before"),
        F.max(F.when(F.col("n_ends") == F.col("n_convs"), 1).otherwise(0)).alias("leaf"))
    owned = F.when(F.col("own").isNull(), 0).when(F.col("own") > F.col("depth"), F.col("total") - F.col("own_before")).otherwise(
        F.col("total"))
    sums = paths(members.join(owners, "rep", "left")).groupBy("depth", "key").agg(
        F.sum(F.col("leaves") + F.coalesce("leaf", F.lit(0))).alias("n_leaves"),
        F.sum(F.col("saved") + F.col("w") * F.col("total") - owned).alias("_saved"))
    return nodes.join(sums, ["depth", "key"]).select(
        "depth", "key", "parent", "before", "bytes", "conv_id", "n_convs", "n_ends", "n_leaves",
        (F.col("_saved") - (F.col("n_convs") - 1) * F.col("before")).alias("saved_tokens"))


def prefix_trie(turns: DataFrame, conv_ids: DataFrame) -> DataFrame:
    """One row per node of the trie over ``turns`` (see ``prefixes``), the root included.

    Columns: ``depth``, ``key`` and ``parent`` (hashes of the prefix; the root's are empty and null),
    ``conv_id`` (smallest member) and ``parent_conv_id``, ``n_convs`` (conversations that begin so),
    ``n_ends`` (those that are no longer), ``n_children``, ``n_leaves`` (childless nodes in the subtree),
    ``saved_tokens`` (over the subtree, (n_convs - 1) times the bytes of a node's last turn) and ``ends_sha256``
    over the ids of those that end here.

    Copies merge into one row before the first round. A conversation without turns is a member of the root alone; repeated rows are further
    turns; no conversations give no rows. A very long conversation costs its turns once, in one
    round each, and passes through one task as a stream.
    """
    written = prefixes(turns, conv_ids)
    spark = written.sparkSession
    steps = stored(written, "prefixes", by="band")
    ended = steps.where("last")
    ends = stored(
        ended.groupBy("depth", "key").agg(
            F.min("conv_id").alias("rep"), F.count("*").alias("w"), F.max(F.col("before") + F.col("bytes")).alias("total")),
        "ends")
    member = ["rep", "top", "w", "ends", "leaves", "saved", "total"]
    zero = F.lit(0).cast("long")
    deepest = ends.agg(F.max("depth")).first()[0]
    if deepest is None:
        deepest = 0
    alive, found = None, []
    for k in range((deepest - 1).bit_length() if deepest > 1 else 0, -1, -1):
        low = (1 << k >> 1) if k else 0
        members = ends.where((F.col("depth") > low) & (F.col("depth") <= 1 << k)).select(
            "rep", F.col("depth").alias("top"), "w", F.col("w").alias("ends"), zero.alias("leaves"), zero.alias("saved"), "total")
        if alive is not None:
            members = members.unionByName(alive)
        nodes = stored(peel(steps.where(F.col("band") == k).where("depth > 0"), members), "peeled")
        found.append(nodes)
        alive = nodes.where(F.col("depth") == low + 1).groupBy("parent", F.col("before").alias("total")).agg(
            F.min("conv_id").alias("rep"), F.sum("n_convs").alias("w"), F.sum("n_leaves").alias("leaves"),
            F.sum("saved_tokens").alias("saved")).select(
            "rep", F.lit(low).alias("top"), "w", zero.alias("ends"), "leaves", "saved", "total").select(*member)
    base = ends.where("depth = 0").select("rep", "w", F.col("w").alias("ends"), zero.alias("leaves"), zero.alias("saved"))
    root = base.unionByName(alive.select(*base.columns)).agg(
        F.min("rep").alias("conv_id"), F.sum("w").alias("n_convs"), F.sum("ends").alias("n_ends"),
        F.greatest(F.sum("leaves"), F.lit(1)).alias("n_leaves"), F.sum("saved").alias("saved_tokens")).where("n_convs > 0")
    root = root.select(
        F.lit(0).alias("depth"), F.lit(ROOT).cast("binary").alias("key"), F.lit(None).cast("binary").alias("parent"),
        "conv_id", "n_convs", "n_ends", "n_leaves", "saved_tokens")
    nodes = reduce(DataFrame.unionByName, [n.select(*root.columns) for n in found], root)
    children = nodes.where("parent is not null").groupBy(F.col("parent").alias("key")).agg(F.count("*").alias("n_children"))
    above = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    hashes = joined_hash(ended.select("key", "conv_id")).withColumnRenamed("ids_sha256", "ends_sha256")
    nothing = hashlib.sha256().hexdigest()
    return (
        nodes.join(children, "key", "left").join(hashes, "key", "left").join(above, "parent", "left")
        .withColumn("n_children", F.coalesce("n_children", zero))
        .withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(nothing)))
    )


def crossed(turns: DataFrame, family: int = FAMILY, times: int = TIMES) -> DataFrame:
    """Conversations rebuilt with the beginning of another: (conv_id, position, digest, bytes).

    With h = crc32 of the decimal id modulo ``times``, conversation c gets the first h turns of
    c - c % ``family`` (all if it has fewer, none if there is no such conversation), then its own after its first h.
    """
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % times
    base = F.col("conv_id") - F.pmod("conv_id", F.lit(family))
    heads = turns.where((F.col("position") < times) & (base == F.col("conv_id"))).select(
        F.col("conv_id").alias("base"), "position", "digest", "bytes")
    takers = turns.where("position = 1").select("conv_id", base.alias("base"), h.alias("h"))
    taken = takers.join(heads, "base").where(F.col("position") <= F.col("h")).select("conv_id", "position", "digest", "bytes")
    # own turns stand behind the taken ones; only their order counts
    own = turns.where(F.col("position") > h).select("conv_id", (F.col("position") + times).alias("position"), "digest", "bytes")
    return taken.unionByName(own)


def op12_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of all rebuilt conversations."""
    turns = stored(numbered_turns(table(spark, sf_dir, "conversations")), "turns")
    nodes = prefix_trie(crossed(turns), turns.where("position = 1").select("conv_id"))
    return nodes.select(
        "conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves",
        "saved_tokens", "ends_sha256")


CRC32 = """list_reduce(list_prepend(4294967295::bigint, list_transform(string_split({0}, ''), lambda ch: ascii(ch)::bigint)),
  lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda c, i: xor(c >> 1, 3988292384 * (c & 1))))"""


def crc32_sql(text: str) -> str:
    """SQL of the unsigned crc32 of an expression of ASCII text that is not empty."""
    return f"xor({CRC32.format(text)}, 4294967295)"


OP12_SQL = f"""with own as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text, row_number() over (partition by conv_id
    order by turn nulls first, coalesce(role, ''), md5(concat(length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, '')))) as position
  from conversations where conv_id is not null),
ids as (select distinct conv_id, conv_id - ((conv_id % {FAMILY}) + {FAMILY}) % {FAMILY} as base,
  {crc32_sql('conv_id::varchar')} % {TIMES} as h from own),
rebuilt as (
  select ids.conv_id, position, role, text from ids join own on own.conv_id = ids.base and position <= h
  union all select own.conv_id, position + {TIMES}, role, text from own join ids using (conv_id) where position > h),
whole as (select ids.conv_id, coalesce(turns, []) as turns from ids left join (
  select conv_id, list({{'r': role, 't': text}} order by position) as turns from rebuilt group by 1) using (conv_id)),
member as (select conv_id, d as depth, turns[1:d] as path, d = len(turns) as ended from whole, range(0, 10000) r(d) where d <= len(turns)),
node as (select depth, path, min(conv_id) as conv_id, count(*) as n_convs,
    sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (ended), '')) as ends_sha256,
    case when depth = 0 then 0 else (count(*) - 1) * strlen(path[depth].t) end as saved from member group by depth, path),
child as (select path[1:depth - 1] as path, count(*) as n from node where depth > 0 group by 1),
counted as (select node.*, coalesce(child.n, 0) as n_children from node left join child using (path)),
below as (select path[1:d] as path, sum((n_children = 0)::bigint) as n_leaves, sum(saved) as saved
  from counted, range(0, 10000) r(d) where d <= depth group by 1)
select n.conv_id, n.depth, p.conv_id as parent_conv_id, n.n_convs, n.n_children, b.n_leaves::bigint as n_leaves,
  b.saved::bigint as saved_tokens, n.ends_sha256
from counted n join below b on n.path = b.path left join node p on n.depth > 0 and p.path = n.path[1:n.depth - 1]"""
