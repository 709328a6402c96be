"""Mixing sources to target weights over a tree such as domain, language, source.

Every node asks for its weight's share of its parent's tokens. What a node cannot
supply, at ``max_epochs`` passes over its documents, goes to its siblings; only what a
whole subtree cannot supply goes to the siblings of its root. Every leaf then reads its
documents in a seeded order, a new one each epoch, up to its number of tokens.

All of it is DataFrame functions; numbers are exact integers. Only token counts per leaf
and per slice of a leaf's order are aggregated, so a leaf may hold any share of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from namewire.llm.base import stored, table

WORDS = r"[^\x20\x09-\x0D]+"
NONE = "(none)"  # the node of rows whose level is null
SLICE_DIGITS = 3  # leading hex digits of the order key: 4096 slices a leaf
BROADCAST_LEAVES = 100_000


def _weight(column: str, weights: dict[str, int]) -> Column:
    """Weights of a level's nodes; nodes that are not named weigh 1."""
    out = F.lit(1)
    for name, weight in weights.items():
        if weight < 1:
            raise ValueError("weights are positive integers")
        out = F.when(F.col(column) == name, weight).otherwise(out)
    return out.cast("long")


def _product(a: str, b: str) -> str:
    return f"(cast({a} as decimal(20,0)) * cast({b} as decimal(17,0)))"


def share_out(nodes: DataFrame, parent: list[str], node: str) -> DataFrame:
    """Divide ``budget`` of each parent over its ``node`` rows by ``weight``, none above ``cap``.

    Nodes in order of cap to weight: those whose cap is within their share of what is
    left get their cap, the others share the rest by weight, to the token.
    """
    order = Window.partitionBy(*parent).orderBy(F.col("cap") / F.col("weight"), node)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    placed = (nodes.withColumn("cap_before", F.coalesce(F.sum("cap").over(before), F.lit(0)))
              .withColumn("weight_left", F.sum("weight").over(after)))
    placed = placed.withColumn("full", F.expr(
        f"{_product('cap', 'weight_left')} <= {_product('budget - cap_before', 'weight')}"))
    whole = Window.partitionBy(*parent)
    placed = (placed.withColumn("rest", F.col("budget") - F.coalesce(
                  F.sum(F.when(F.col("full"), F.col("cap"))).over(whole), F.lit(0)))
              .withColumn("open", F.coalesce(F.sum(F.when(~F.col("full"), F.col("weight"))).over(whole), F.lit(0)))
              .withColumn("upto", F.coalesce(F.sum(F.when(~F.col("full"), F.col("weight"))).over(
                  order.rowsBetween(Window.unboundedPreceding, Window.currentRow)), F.lit(0))))
    share = F.expr(f"({_product('rest', 'upto')} div open) - ({_product('rest', 'upto - weight')} div open)")
    return placed.withColumn("given", F.when(F.col("full"), F.col("cap")).otherwise(share).cast("long"))


def budgets(leaves: DataFrame, levels: list[str], weights: list[dict[str, int]], budget: Column) -> DataFrame:
    """``given`` tokens of every leaf. ``leaves`` has the levels and ``tokens``, ``cap``; ``budget`` may use sums of them."""
    top = leaves.agg(F.least(budget, F.sum("cap")).cast("long").alias("budget"))
    given, above = top, []
    for depth, level in enumerate(levels):
        nodes = leaves.groupBy(*levels[: depth + 1]).agg(F.sum("cap").alias("cap"))
        nodes = nodes.withColumn("weight", _weight(level, weights[depth]))
        nodes = nodes.join(given, above) if above else nodes.join(F.broadcast(given))  # one row
        shared = share_out(nodes, above, level)
        above = levels[: depth + 1]
        given = shared.select(*above, F.col("given").alias("budget"))
    return given.withColumnRenamed("budget", "given")


def mix(
    documents: DataFrame, levels: dict[str, str], weights: list[dict[str, int]],
    budget: Column, max_epochs: int = 2, seed: int = 7, id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """Documents picked for a mix.

    ``levels`` names the tree from the top, with a SQL expression for each level; ``weights``
    has a dict of node weights for each. ``budget`` is a number of tokens, or an expression of
    ``sum(tokens)``. Tokens are words. Returns ``doc_id``, the levels, ``tokens``, ``epoch``
    from 0 and ``tokens_taken``: one row for each time a document is read, in its last
    epoch perhaps in part. A null level is a node of its own; a null or blank text has no
    tokens and is read with its leaf, but a leaf without tokens is never read; rows that repeat an id are read each for itself; an empty
    table gives no row.
    """
    names = list(levels)
    counted = stored(documents.select(
        F.col(id_column).cast("long").alias("doc_id"),
        *(F.coalesce(F.expr(level).cast("string"), F.lit(NONE)).alias(name) for name, level in levels.items()),
        F.coalesce(F.regexp_count(F.col(text_column), F.lit(WORDS)), F.lit(0)).cast("long").alias("tokens")), "counted")
    leaves = counted.groupBy(*names).agg(F.sum("tokens").alias("tokens"))
    leaves = leaves.withColumn("cap", F.col("tokens") * max_epochs)
    plan = stored(
        leaves.join(budgets(leaves, names, weights, budget), names)
        .select(*names, F.expr("coalesce(given div nullif(tokens, 0), 0)").alias("passes"),
                F.expr("coalesce(given % nullif(tokens, 0), 0)").alias("rest")), "plan")
    few = plan.count() <= BROADCAST_LEAVES

    def with_leaf(rows: DataFrame, leaf: DataFrame, how: str = "inner") -> DataFrame:
        return rows.join(F.broadcast(leaf) if few else leaf, names, how)

    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("passes").cast("string"), F.col("doc_id").cast("string")).cast("binary"))
    ordered = stored(with_leaf(counted, plan).withColumn("key", key)
                     .withColumn("slice", F.substring("key", 1, SLICE_DIGITS)), "ordered")
    by_slice = ordered.where("rest > 0").groupBy(*names, "rest", "slice").agg(F.sum("tokens").alias("sum"))
    running = by_slice.withColumn("before", F.sum("sum").over(Window.partitionBy(*names).orderBy("slice")) - F.col("sum"))
    # the slice in which a leaf's last epoch ends, and the tokens ahead of it
    cut = (running.where("before < rest").groupBy(*names)
           .agg(F.max(F.struct("slice", "before")).alias("cut")))
    placed = with_leaf(ordered, cut, "left")
    inside = placed.where("slice = cut.slice").withColumn(
        "before", F.col("cut.before") + F.sum("tokens").over(
            Window.partitionBy(*names).orderBy("key", "tokens").rowsBetween(Window.unboundedPreceding, 0)) - F.col("tokens"))
    parted = (placed.where("cut is null or slice <> cut.slice")
              .withColumn("before", F.when(F.col("slice") < F.col("cut.slice"), F.lit(0)).otherwise(F.col("rest")))
              .withColumn("whole", F.lit(True))
              .unionByName(inside.withColumn("whole", F.lit(False))))
    last = F.when(F.col("before") < F.col("rest"), 1).otherwise(0)
    read = parted.withColumn("reads", F.col("passes") + last).where("reads > 0").withColumn(
        "epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("reads") - 1)))
    part = F.when((F.col("epoch") == F.col("passes")) & ~F.col("whole"),
                  F.least(F.col("tokens"), F.col("rest") - F.col("before"))).otherwise(F.col("tokens"))
    return read.select("doc_id", *names, "tokens", F.col("epoch").cast("long").alias("epoch"), part.cast("long").alias("tokens_taken"))


DOMAIN = """case when source is null then '(none)' when source = 'src0' then 'web'
  when try_cast(substr(source, 4) as int) % 2 = 0 then 'books' else 'forums' end"""
TREE = {"domain": DOMAIN, "language": "lang", "origin": "source"}
WEIGHTS = [{"web": 3, "books": 4, "forums": 2}, {"en": 5, "de": 2, "fr": 2}, {"src1": 4, "src2": 3}]


def op3_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Six tenths of all tokens, each read at most twice."""
    return mix(table(spark, folder, "documents"), TREE, WEIGHTS, F.expr("sum(tokens) * 6 div 10"))


def _weights_sql(column: str, weights: dict[str, int]) -> str:
    cases = " ".join(f"when {column} = '{k}' then {v}" for k, v in weights.items())
    return f"case {cases} else 1 end"


def _level_sql(depth: int, names: list[str]) -> str:
    mine, parent = ", ".join(names[: depth + 1]), ", ".join(names[:depth])
    over = f"partition by {parent} " if parent else ""
    source = f"g{depth - 1} using ({parent})" if parent else "top on true"
    order = f"{over}order by cap / weight, {names[depth]}"
    return f"""n{depth} as (
  select {mine}, cap, budget, {_weights_sql(names[depth], WEIGHTS[depth])} as weight
  from (select {mine}, sum(cap)::hugeint as cap from leaves group by all) join {source}),
p{depth} as (
  select *, coalesce(sum(cap) over ({order} rows between unbounded preceding and 1 preceding), 0) as cap_before,
    sum(weight) over ({order} rows between current row and unbounded following) as weight_left from n{depth}),
f{depth} as (select *, cap * weight_left <= (budget - cap_before) * weight as fits from p{depth}),
s{depth} as (
  select *, budget - coalesce(sum(cap) filter (fits) over ({over}), 0) as rest,
    coalesce(sum(weight) filter (not fits) over ({over}), 0) as open,
    coalesce(sum(weight) filter (not fits) over ({order}), 0) as upto from f{depth}),
g{depth} as (
  select {mine}, case when fits then cap
    else rest * upto // open - rest * (upto - weight) // open end::hugeint as budget from s{depth})"""


_NAMES = list(TREE)
OP3_SQL = f"""with counted as (
  select doc_id, {DOMAIN} as domain, coalesce(lang, '(none)') as language, coalesce(source, '(none)') as origin,
    coalesce(len(regexp_extract_all(text, '{WORDS}')), 0)::bigint as tokens from documents),
leaves as (select domain, language, origin, sum(tokens)::hugeint as tokens, 2 * sum(tokens)::hugeint as cap
  from counted group by all),
top as (select least(sum(tokens) * 6 // 10, sum(cap))::hugeint as budget from leaves),
{", ".join(_level_sql(d, _NAMES) for d in range(3))},
plan as (
  select domain, language, origin, coalesce(budget // nullif(tokens, 0), 0)::bigint as passes,
    coalesce(budget % nullif(tokens, 0), 0)::bigint as rest from leaves join g2 using (domain, language, origin)),
keyed as (
  select *, sum(tokens) over (partition by domain, language, origin
      order by md5(concat_ws(':', '7', passes, doc_id)), tokens rows unbounded preceding) - tokens as before
  from counted join plan using (domain, language, origin))
select doc_id, domain, language, origin, tokens, epoch::bigint as epoch,
  case when epoch = passes then least(tokens, rest - before) else tokens end::bigint as tokens_taken
from (select *, unnest(range(passes + case when before < rest then 1 else 0 end)) as epoch from keyed)"""
