"""Repair of conversation structure by generalised LR parsing over the roles.

A table of LR states is made from the role grammar. Over a conversation's turns, all stacks
that some edits lead to are kept side by side: each turn may be kept, given another role
or deleted, and turns may be put in, each at its price. Stacks that have become equal
merge, and the one of least (cost, audit) stays; the audit is the text of the edits'
initials. So the work a turn is bounded by the grammar, and what is held is one row, the live
stacks and a reference a turn.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from namewire.llm.base import stored, table
from namewire.llm.trie import crc32_sql

# left side, right side; terminals are the initials of roles
GRAMMAR = [("C", ""), ("C", "P"), ("C", "sP"), ("P", "ua"), ("P", "Pua")]
ROLES = {"u": "user", "a": "assistant"}  # what a turn may be made, or put in as
COSTS = {"K": 0, "R": 3, "D": 4, "I": 3}
SLACK = 7
REMEMBERED = 10_000  # steps worked out, of a few hundred bytes each
TORN = 3  # added to a truncated turn that is not deleted
STOPS = ".!?"
SPACES = " \t\n\x0b\x0c\r"
EMPTY_HASH = hashlib.sha256().hexdigest()
PLAN = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
        "audit string, roles string")


class Stacks:
    """The LR table of a grammar, as steps from stack to stack.

    A stack is a tuple of states; a step shifts one terminal and makes all reductions that the
    next terminal allows. ``follow`` holds what may come after each left side.
    """

    def __init__(self, grammar=GRAMMAR):
        self.grammar = [(left, tuple(right)) for left, right in grammar]
        self.lefts = {left for left, _ in self.grammar}
        self.start = self.grammar[0][0]
        first = self.close({("", (self.start,), 0)})
        self.states, self.goto = [first], {}
        for number, items in enumerate(self.states):
            for symbol in {right[dot] for _, right, dot in items if dot < len(right)}:
                moved = self.close({(left, right, dot + 1) for left, right, dot in items
                                    if dot < len(right) and right[dot] == symbol})
                if moved not in self.states:
                    self.states.append(moved)
                self.goto[number, symbol] = self.states.index(moved)
        self.terminals = {symbol for _, right in self.grammar for symbol in right} - self.lefts
        self.follow = self.after()
        self.memo: dict = {}

    def close(self, items: set) -> frozenset:
        items, grown = set(items), True
        while grown:
            wanted = {right[dot] for _, right, dot in items if dot < len(right)} & self.lefts
            more = {(left, right, 0) for left, right in self.grammar if left in wanted}
            grown = not more <= items
            items |= more
        return frozenset(items)

    def after(self) -> dict[str, set]:
        empty = {left for left, right in self.grammar if not right}
        begin = {left: set() for left in self.lefts}
        follow = {left: set() for left in self.lefts}
        follow[self.start].add("$")
        for _ in range(len(self.grammar) ** 2 + 1):
            for left, right in self.grammar:
                for symbol in right:
                    begin[left] |= begin.get(symbol, {symbol})
                    if symbol not in empty:
                        break
                for k, symbol in enumerate(right):
                    if symbol in self.lefts:
                        rest = right[k + 1:]
                        for other in rest:
                            follow[symbol] |= begin.get(other, {other})
                            if other not in empty:
                                break
                        else:
                            follow[symbol] |= follow[left]
        return follow

    def reduced(self, stack: tuple, ahead: str) -> list[tuple]:
        """The stack and all that reductions before ``ahead`` make of it."""
        out, todo = [stack], [stack]
        while todo:
            top = todo.pop()
            for left, right, dot in self.states[top[-1]]:
                if left and dot == len(right) and ahead in self.follow[left]:
                    below = top[: len(top) - len(right)]
                    if (below[-1], left) in self.goto:
                        new = (*below, self.goto[below[-1], left])
                        if new not in out:
                            out.append(new)
                            todo.append(new)
        return out

    def shift(self, stack: tuple, terminal: str) -> list[tuple]:
        """The stacks after one more terminal."""
        key = stack, terminal
        if key not in self.memo:
            self.memo[key] = [(*s, self.goto[s[-1], terminal]) for s in self.reduced(stack, terminal)
                              if (s[-1], terminal) in self.goto]
        return self.memo[key]

    def accepts(self, stack: tuple) -> bool:
        return any(("", (self.start,), 1) in self.states[s[-1]] for s in self.reduced(stack, "$"))


class Repairer:
    """Cheapest edits of one conversation after another, read turn by turn.

    A stack that costs over ``slack`` more than the cheapest is let go. With the default grammar and
    costs the cheapest can always be brought to go on like any other for 7 at most (an insertion and
    a deletion), so none that could win is lost; another grammar needs its own bound. What is left
    are few different sets of stacks, whose steps are remembered.
    """

    def __init__(self, grammar=GRAMMAR, roles=ROLES, costs=COSTS, torn: int = TORN, slack: int = SLACK):
        self.table, self.roles, self.costs, self.torn, self.slack = Stacks(grammar), roles, costs, torn, slack
        self.start = (((0,),), (0,), (0,))  # stacks, cost of each over the least, its audit's place in ASCII order
        self.filled: dict = {}
        self.steps: dict = {}
        self.reset()

    def reset(self) -> None:
        self.live, self.cost, self.trail = self.start, 0, []

    def insertions(self, stack: tuple) -> list[tuple[str, tuple]]:
        """(roles put in, stack) for the stack itself and all that insertions make of it."""
        if stack not in self.filled:
            out, seen, todo = [("", stack)], {stack}, [("", stack)]
            for put, at in todo:
                for initial in sorted(self.roles, reverse=True):  # user first
                    for new in self.table.shift(at, initial):
                        if new not in seen:
                            seen.add(new)
                            out.append((put + initial, new))
                            todo.append((put + initial, new))
            self.filled[stack] = out
        return self.filled[stack]

    def step(self, live: tuple, initial: str, torn: bool, must_go: bool):
        """What one turn makes of the live stacks: the new ones, the cost to add, and how each came about."""
        best: dict = {}
        for place, (stack, cost, rank) in enumerate(zip(*live)):
            for put, at in self.insertions(stack):
                spent = cost + len(put) * self.costs["I"]
                edits = [("D", "-", at, self.costs["D"])]
                if not must_go:
                    extra = self.torn if torn else 0
                    edits += [("K", initial, new, self.costs["K"] + extra) for new in self.table.shift(at, initial)]
                    edits += [("R", other, new, self.costs["R"] + extra)
                              for other in self.roles for new in self.table.shift(at, other)]
                for edit, role, new, price in edits:
                    way = (spent + price, rank, "I" * len(put) + edit, put + role, place)
                    if new not in best or way < best[new]:
                        best[new] = way
        least = min(way[0] for way in best.values())
        kept = {stack: best[stack] for stack in sorted(best) if best[stack][0] <= least + self.slack}
        ranks = {way[1:3]: k for k, way in enumerate(sorted(kept.values(), key=lambda w: w[1:3]))}
        new = (tuple(kept), tuple(way[0] - least for way in kept.values()), tuple(ranks[way[1:3]] for way in kept.values()))
        return new, least, tuple((way[4], way[2], way[3]) for way in kept.values())

    def read(self, initial: str, torn: bool, must_go: bool) -> None:
        key = self.live, initial if initial in self.table.terminals else "?", torn, must_go
        if key not in self.steps:
            if len(self.steps) >= REMEMBERED:
                self.steps.clear()
            self.steps[key] = self.step(self.live, *key[1:])
        self.live, cost, how = self.steps[key]
        self.cost += cost
        self.trail.append(how)

    def finish(self) -> tuple[int, str, str]:
        """Cost, audit and the role after each edit ("-" if deleted) of the cheapest repair."""
        ways = [(cost + len(put) * self.costs["I"], rank, "I" * len(put), put, place)
                for place, (stack, cost, rank) in enumerate(zip(*self.live))
                for put, at in self.insertions(stack) if self.table.accepts(at)]
        cost, _, tail, put, place = min(ways)
        edits, roles = [tail], [put]
        for how in reversed(self.trail):
            place, edit, role = how[place]
            edits.append(edit)
            roles.append(role)
        out = self.cost + cost, "".join(reversed(edits)), "".join(reversed(roles))
        self.reset()
        return out


def checked(turns: DataFrame) -> DataFrame:
    """Turns with their ``position`` in the conversation and first ``fault``: blank, duplicate, truncated or null.

    Blank: nothing but space and \\x09-\\x0D. Duplicate: the same role and text stood earlier. Truncated: the last
    other character is none of ``.!?``. Turns are ordered by ``turn`` (null first), then role, then text; a null role
    or text is one space. ``copies`` (1 if there is no such column) says how often a turn stands there; with 0 it
    only names its conversation (``there`` is false). Rows without a conv_id belong to none and drop out.
    """
    copies = F.col("copies").cast("int") if "copies" in turns.columns else F.lit(1)
    rows = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"), (copies > 0).alias("there"),
        F.explode(F.sequence(F.lit(1), F.greatest(copies, F.lit(1)))).alias("copy")).drop("copy").repartition("conv_id")
    in_turn = F.col("turn").asc_nulls_first()
    same = Window.partitionBy("conv_id", "there", "role", F.md5(F.col("text").cast("binary"))).orderBy(in_turn)
    place = Window.partitionBy("conv_id").orderBy(F.col("there").desc(), in_turn, "role", "text", "again")
    last = F.right(F.rtrim("text", F.lit(SPACES)), F.lit(1))
    fault = (F.when(last == "", "blank").when(F.col("again") > 1, "duplicate").when(~last.isin(*STOPS), "truncated"))
    return rows.withColumn("again", F.row_number().over(same)).select(
        "conv_id", F.row_number().over(place).alias("position"), "there", "turn", "role", "text", fault.alias("fault"))


def plan_repairs(rows: DataFrame, grammar=GRAMMAR, roles=ROLES, costs=COSTS, torn: int = TORN) -> DataFrame:
    """One row per conversation of ``checked`` turns: faults, and the cheapest repair.

    ``audit`` has the initials of the edits in order (Keep, Rerole, Delete, Insert), ``roles`` the initial
    of the role after each ("-" if deleted). Blank and duplicate turns must go. Of equal cost the audit
    that comes first in ASCII wins. ``gaps`` counts turn numbers left out, ``illegal`` neighbours that
    no sequence of the grammar has.
    """
    names = [part.split()[0] for part in PLAN.split(", ")]
    kinds = [pa.string() if part.endswith("string") else pa.int64() for part in PLAN.split(", ")]
    legal = {"su", "ua", "au"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repairer = Repairer(grammar, roles, costs, torn)
        at = before = low = turn_before = None
        different, counts = 0, {}

        def row() -> tuple:
            cost, audit, made = repairer.finish()
            gaps = turn_before - low + 1 - different if low is not None else 0
            return (at, gaps, counts["blank"], counts["duplicate"], counts["truncated"], counts["illegal"], cost, audit, made)

        def batch_of(out: list[tuple]) -> pa.RecordBatch:
            columns = zip(*out) if out else [[]] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(list(c), kind) for c, kind in zip(columns, kinds)], names)

        for batch in batches:
            out = []
            for conv, there, turn, initial, fault in zip(*(c.to_pylist() for c in batch.columns)):
                if conv != at:
                    if at is not None:
                        out.append(row())
                    at, before, low, turn_before, different = conv, None, None, None, 0
                    counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
                if not there:
                    continue
                if fault:
                    counts[fault] += 1
                if before is not None and before + initial not in legal:
                    counts["illegal"] += 1
                before = initial
                if turn is not None and turn != turn_before:
                    low = turn if low is None else low
                    turn_before = turn
                    different += 1
                repairer.read(initial, fault == "truncated", fault in ("blank", "duplicate"))
            yield batch_of(out)
        if at is not None:
            yield batch_of([row()])

    small = rows.select("conv_id", "position", "there", "turn", F.left("role", F.lit(1)).alias("initial"), "fault")
    return (small.repartition("conv_id").sortWithinPartitions("conv_id", "position")
            .select("conv_id", "there", "turn", "initial", "fault").mapInArrow(run, PLAN))


def apply_repairs(rows: DataFrame, plans: DataFrame, roles=ROLES) -> DataFrame:
    """The repaired turns (conv_id, place, position, edit, role, text), in ``place`` order.

    ``position`` is the original turn's place in its conversation, null for one that was put in. Deleted turns are left out.
    """
    upto = Window.partitionBy("conv_id").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    edits = plans.select(
        "conv_id", F.posexplode(F.arrays_zip(F.split("audit", "").alias("edit"), F.split("roles", "").alias("initial"))).alias("place", "e"))
    edits = edits.select("conv_id", "place", "e.edit", "e.initial").where("edit <> ''").withColumn(
        "_position", F.sum(F.when(F.col("edit") == "I", 0).otherwise(1)).over(upto)).where("edit <> 'D'").withColumn(
        "position", F.when(F.col("edit") != "I", F.col("_position")).cast("int"))
    name = F.coalesce(*(F.when(F.col("initial") == k, v) for k, v in roles.items()))
    there = rows.where("there").select("conv_id", "position", "role", "text")
    return edits.join(there, ["conv_id", "position"], "left").select(
        "conv_id", "place", "position", "edit", F.when(F.col("edit") == "K", F.col("role")).otherwise(name).alias("role"),
        F.when(F.col("edit") == "I", "").otherwise(F.col("text")).alias("text"))


def text_hash(turns: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) over the lines ``role:text`` of each conversation, read as a stream."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, sha = None, None

        def batch_of(out: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.string())],
                                              ["conv_id", "repaired_sha256"])

        for batch in batches:
            out = []
            for conv, line in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                if conv != at:
                    if sha is not None:
                        out.append((at, sha.hexdigest()))
                    at, sha = conv, hashlib.sha256(line)
                else:
                    sha.update(b"\n" + line)
            yield batch_of(out)
        if sha is not None:
            yield batch_of([(at, sha.hexdigest())])

    return (turns.repartition("conv_id").sortWithinPartitions("conv_id", "place")
            .select("conv_id", F.concat("role", F.lit(":"), "text").alias("line")).mapInArrow(run, "conv_id long, repaired_sha256 string"))


def damaged(conversations: DataFrame) -> DataFrame:
    """Turns with faults put in, by crc32 of ``conv_id:turn`` modulo 20; nulls are one space.

    0 takes the turn out, 1 empties its text, 2 takes out full stops, exclamation and question marks, 3 doubles
    the turn, 4 makes its role user.
    """
    text, role = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("text", "role"))
    key = F.concat(F.col("conv_id").cast("string"), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = F.crc32(key.cast("binary")) % 20
    return conversations.where("conv_id is not null").select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, STOPS, "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"))


def repair(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Plans (one row a conversation) and repaired turns of conversations (conv_id, turn, role, text).

    See ``checked``, ``plan_repairs`` and ``apply_repairs``. A conversation none of whose turns is there has an empty
    plan; an empty table gives none. Very long conversations pass through a task as a stream. Further columns,
    whatever their names, are not read, but for ``copies``.
    """
    rows = stored(checked(turns), "turns")
    plans = stored(plan_repairs(rows), "plans")
    return plans, apply_repairs(rows, plans)


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and the cheapest repair of every conversation, after damage."""
    plans, turns = repair(damaged(table(spark, sf_dir, "conversations")))
    return plans.join(text_hash(turns), "conv_id", "left").withColumn(
        "repaired_sha256", F.coalesce("repaired_sha256", F.lit(EMPTY_HASH))).drop("roles")


_SPACES_SQL = "concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))"
OP13_SQL = f"""with recursive base as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    {crc32_sql("concat(conv_id, ':', coalesce(turn::varchar, ' '))")} % 20 as kind from conversations where conv_id is not null),
broken as (
  select conv_id, turn, case when kind = 4 then 'user' else role end as role,
    case kind when 1 then '' when 2 then translate(text, '.!?', '') else text end as text
  from (select *, unnest(range(0, case kind when 0 then 0 when 3 then 2 else 1 end)) from base)),
seen as (select *, row_number() over (partition by conv_id, role, text order by turn nulls first) as again from broken),
placed as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, text, again) as position,
    right(rtrim(text, {_SPACES_SQL}), 1) as last_char, left(role, 1) as initial from seen),
faulty as (
  select *, case when last_char = '' then 'blank' when again > 1 then 'duplicate'
      when last_char not in ('.', '!', '?') then 'truncated' else 'none' end as fault,
    lag(initial) over (partition by conv_id order by position) || initial as pair from placed),
put(src, tokens, mid, made) as (values (0, '', 0, []::varchar[]), (0, 'I', 2, ['user:']), (0, 'II', 3, ['user:', 'assistant:']),
  (1, '', 1, []), (1, 'I', 2, ['user:']), (1, 'II', 3, ['user:', 'assistant:']), (2, '', 2, []), (2, 'I', 3, ['assistant:']),
  (3, '', 3, []), (3, 'I', 2, ['user:'])),
edit(mid, initial, token, dst, price) as (values (0, null, 'D', 0, 4), (1, null, 'D', 1, 4), (2, null, 'D', 2, 4), (3, null, 'D', 3, 4),
  (0, 's', 'K', 1, 0), (0, 'u', 'K', 2, 0), (1, 'u', 'K', 2, 0), (3, 'u', 'K', 2, 0), (2, 'a', 'K', 3, 0),
  (0, null, 'R', 2, 3), (1, null, 'R', 2, 3), (3, null, 'R', 2, 3), (2, null, 'R', 3, 3)),
way(conv_id, position, state, best) as (
  select distinct conv_id, 0::bigint, 0, {{'c': 0, 'a': '', 'm': []::varchar[]}} from base
  union all
  select w.conv_id, w.position + 1, e.dst, min({{
    'c': w.best.c + 3 * length(p.tokens) + e.price + case when e.token <> 'D' and f.fault = 'truncated' then 3 else 0 end,
    'a': w.best.a || p.tokens || e.token,
    'm': w.best.m || p.made || case e.token when 'K' then [f.role || ':' || f.text]
      when 'R' then [case e.dst when 2 then 'user:' else 'assistant:' end || f.text] else []::varchar[] end}})
  from way w join faulty f on f.conv_id = w.conv_id and f.position = w.position + 1
    join put p on p.src = w.state join edit e on e.mid = p.mid
  where (e.initial is null or e.initial = f.initial) and (e.token = 'D' or f.fault not in ('blank', 'duplicate'))
  group by 1, 2, 3),
ended as (
  select w.conv_id, min({{'c': w.best.c + 3 * length(p.tokens), 'a': w.best.a || p.tokens, 'm': w.best.m || p.made}}) as best
  from way w join put p on p.src = w.state
  where p.mid in (0, 3) and w.position = coalesce((select max(position) from placed where placed.conv_id = w.conv_id), 0)
  group by 1),
counts as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (fault = 'blank') as blank,
    count(*) filter (fault = 'duplicate') as duplicate, count(*) filter (fault = 'truncated') as truncated,
    count(*) filter (pair is not null and pair not in ('su', 'ua', 'au')) as illegal from faulty group by 1)
select e.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
  coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, best.c::bigint as cost, best.a as audit,
  sha256(array_to_string(best.m, chr(10))) as repaired_sha256
from ended e left join counts using (conv_id)"""
