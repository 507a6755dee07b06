"""Chat formatting: quotation linking, in DataFrame operations only.

A line's quote level is the number of ``>`` marks it begins with.  Passages are runs of lines of
one level; their lines are normalised (marks off, white space collapsed, lower case, blank lines
out) and the passage is hashed whole.  The original of a quoted passage is the first message of the
conversation that has the same passage unquoted, if that is an earlier one.  Passages without an
original (trimmed, re-wrapped or mixed quotes) fall back to their lines, each linked to the first
message that has the line unquoted.  A message replies to the original of most of its level-1
lines (then of most quoted lines, then the latest).  Threads follow from the reply links by
pointer doubling; a conversation lists its threads by their first message and each thread by
turn, so every message stands after the one it answers.  Bodies lose quoted lines and, in any
language, the attribution: a line ending in a colon just before a passage that is linked.

Counts per (conversation, passage) and (conversation, line) are partially aggregated, every join
has one row per key on one side, and positions come from a global range sort, so one conversation
may hold a third of all messages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import discard, materialize, with_global_rank
from tidepool.llm.quality_rules import bound

MARKS = r"^(?:[ \t]*>)+"
QUOTED = r"(?:^|\n)[ \t]*>"
#: How an attribution line ends.
COLON = r"[:：][ \t\r]*$"


def _level(line: Column) -> Column:
    marks = F.regexp_extract(line, MARKS, 0)
    return F.length(marks) - F.length(F.replace(marks, F.lit(">"), F.lit("")))


def _normal(line: Column) -> Column:
    bare = F.regexp_replace(line, MARKS, "")
    return F.lower(F.trim(F.regexp_replace(bare, r"[ \t\r\x0B\f]+", " ")))


def _parse(text: Column) -> Column:
    """(raw, level, line): the lines of a text, their levels and their normal forms."""

    def rows(raw: Column) -> Column:
        return F.struct(
            raw.alias("raw"), F.transform(raw, _level).alias("level"), F.transform(raw, _normal).alias("line")
        )

    return bound(F.split(text, "\n"), rows)


def _passages(p: Column) -> Column:
    """(run, level, lines) of every passage of a parsed text: where it starts, and its lines."""

    def cut(starts: Column) -> Column:
        def one(start: Column, k: Column) -> Column:
            end = F.coalesce(F.get(starts, k + 1), F.size(p["level"]))
            own = F.slice(p["line"], start + 1, end - start)
            return F.struct(
                start.alias("run"), F.get(p["level"], start).alias("level"), F.filter(own, lambda x: x != "").alias("lines")
            )

        return F.filter(F.transform(starts, one), lambda r: F.size(r["lines"]) > 0)

    places = F.sequence(F.lit(0), F.size(p["level"]) - 1)
    is_start = lambda i: (i == 0) | (F.get(p["level"], i) != F.get(p["level"], i - 1))
    return bound(F.filter(places, is_start), cut)


def _body(p: Column, linked: Column) -> Column:
    """The text without quoted lines and attributions; ``linked``: where linked passages start."""
    kept = F.transform(
        p["raw"],
        lambda x, i: F.when(
            (F.get(p["level"], i) == 0) & ~(F.array_contains(linked, i + 1) & x.rlike(COLON)), x
        ),
    )
    joined = F.array_join(F.filter(kept, lambda x: x.isNotNull()), "\n")
    return F.regexp_replace(joined, r"^\s+|\s+$", "")


def _threads(links: DataFrame) -> DataFrame:
    """(conv_id, turn, root_turn, depth) of every message with a parent, by pointer doubling."""
    now = links.select("conv_id", "turn", F.col("parent_turn").alias("root_turn"), F.lit(1).alias("depth"))
    now = materialize(now, "op9-threads")
    while True:
        up = now.select(
            "conv_id",
            F.col("turn").alias("root_turn"),
            F.col("root_turn").alias("higher"),
            F.col("depth").alias("more"),
        )
        step = now.join(up, ["conv_id", "root_turn"], "left").select(
            "conv_id",
            "turn",
            F.coalesce("higher", "root_turn").alias("root_turn"),
            (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
            F.col("higher").isNotNull().alias("moved"),
        )
        before, step = now, materialize(step, "op9-threads")
        discard(before)
        now = step.drop("moved")
        now.scratch_path = step.scratch_path
        if step.where("moved").isEmpty():
            return now


def reply_order(messages: DataFrame) -> DataFrame:
    """Messages without quotes, in reply order.

    Takes (conv_id, turn, role, text, ...); returns conv_id, turn, role, n_quoted, n_linked,
    max_level, parent_turn, root_turn, depth, position, body for every row.  Defined results: a
    null text is empty; blank lines are neither quotes nor originals; rows that share conv_id
    and turn are one message for links and get a position each (ordered by role, then text); a
    null conv_id or turn links with nothing, and null conversations count positions together;
    an empty table gives an empty result; other columns are ignored.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = messages.select("conv_id", "turn", F.col("role").cast("string").alias("role"), text.alias("text"))
    quoting = rows.where(F.col("text").rlike(QUOTED)).select("conv_id").distinct()
    message = F.sha2("text", 256).alias("message")
    runs = (
        rows.where("conv_id is not null and turn is not null")
        .join(quoting, "conv_id", "left_semi")
        .select("conv_id", "turn", message, _parse(F.col("text")).alias("p"))
        .select("conv_id", "turn", "message", F.explode(_passages(F.col("p"))).alias("x"))
        .select(
            "conv_id",
            "turn",
            "message",
            "x.run",
            "x.level",
            F.sha2(F.array_join("x.lines", "\n"), 256).alias("passage"),
            F.transform("x.lines", lambda x: F.sha2(x, 256)).alias("lines"),
        )
    )
    runs = materialize(runs, "op9-passages")
    unquoted, quoted = runs.where("level = 0"), runs.where("level > 0")
    whole = unquoted.groupBy("conv_id", "passage").agg(F.min("turn").alias("parent_turn"))
    quoted = quoted.join(whole, ["conv_id", "passage"], "left")
    quoted = materialize(
        quoted.withColumn("parent_turn", F.when(F.col("parent_turn") < F.col("turn"), F.col("parent_turn"))),
        "op9-quoted",
    )
    place = ["conv_id", "turn", "message", "run", "level"]
    first = unquoted.select("conv_id", "turn", F.explode("lines").alias("line"))
    first = first.groupBy("conv_id", "line").agg(F.min("turn").alias("parent_turn"))
    single = quoted.where("parent_turn is null").select(*place, F.explode("lines").alias("line"))
    single = single.join(first, ["conv_id", "line"]).where("parent_turn < turn")
    found = quoted.where("parent_turn is not null").select(*place, "parent_turn", F.size("lines").alias("n"))
    found = materialize(found.unionByName(single.select(*place, "parent_turn", F.lit(1).alias("n"))), "op9-found")
    linked_runs = found.groupBy("conv_id", "turn", "message").agg(F.collect_set("run").alias("linked_runs"))
    votes = found.groupBy("conv_id", "turn", "parent_turn").agg(
        F.sum(F.when(F.col("level") == 1, F.col("n")).otherwise(0)).alias("direct"), F.sum("n").alias("votes")
    )
    links = votes.groupBy("conv_id", "turn").agg(
        F.max(F.struct("direct", "votes", "parent_turn")).alias("best"), F.sum("votes").alias("linked")
    )
    links = materialize(
        links.select("conv_id", "turn", F.col("best.parent_turn").alias("parent_turn"), "linked"), "op9-links"
    )
    threads = _threads(links)
    parsed = rows.select("*", message).join(linked_runs, ["conv_id", "turn", "message"], "left")
    parsed = parsed.withColumn("p", _parse(F.col("text")))
    filled = F.filter(F.arrays_zip("p.level", "p.line"), lambda x: x["line"] != "")
    levels = F.transform(filled, lambda x: x["level"])
    flat = parsed.select(
        "conv_id",
        "turn",
        "role",
        "text",
        F.size(F.filter(levels, lambda x: x > 0)).cast("long").alias("n_quoted"),
        F.coalesce(F.array_max(levels), F.lit(0)).cast("long").alias("max_level"),
        _body(F.col("p"), F.coalesce("linked_runs", F.array().cast("array<int>"))).alias("body"),
    )
    flat = flat.join(links, ["conv_id", "turn"], "left").join(threads, ["conv_id", "turn"], "left")
    flat = flat.withColumn("root_turn", F.coalesce("root_turn", "turn"))
    order = [F.col(c) for c in ("conv_id", "root_turn", "turn", "role", "text")]
    ranked = with_global_rank(flat, order, "op9-order")
    first = ranked.groupBy("conv_id").agg(F.min("rank").alias("first"))
    placed = ranked.withColumnRenamed("conv_id", "c").join(
        first, F.col("c").eqNullSafe(F.col("conv_id"))
    )
    return placed.select(
        F.col("c").alias("conv_id"),
        "turn",
        "role",
        "n_quoted",
        F.coalesce("linked", F.lit(0)).cast("long").alias("n_linked"),
        "max_level",
        "parent_turn",
        "root_turn",
        F.coalesce("depth", F.lit(0)).cast("long").alias("depth"),
        (F.col("rank") - F.col("first")).cast("long").alias("position"),
        "body",
    )


#: The same rows in DuckDB SQL over the view ``conversations``.
ORACLE_SQL = r"""
with recursive rows as (
  select conv_id, turn, role, coalesce(text, '') as text, row_number() over () as id
  from conversations
), split as (
  select id, conv_id, turn, unnest(string_split(text, chr(10))) as x,
         generate_subscripts(string_split(text, chr(10)), 1) as i from rows
), marked as (
  select *, regexp_extract(x, '^(?:[ \t]*>)+') as marks,
    lower(trim(regexp_replace(regexp_replace(x, '^(?:[ \t]*>)+', ''), '[ \t\r\x0B\f]+', ' ', 'g'), ' ')) as line
  from split
), leveled as (
  select *, length(marks) - length(replace(marks, '>', '')) as level from marked
), stepped as (
  select *, coalesce(level <> lag(level) over (partition by id order by i), true) as new,
    coalesce(lead(level) over (partition by id order by i), 0) as next_level from leveled
), placed as (
  select *, sum(cast(new as int)) over (partition by id order by i rows unbounded preceding) as run from stepped
), passages as (
  select id, conv_id, turn, run, level, string_agg(line, chr(10) order by i) as passage, count(*) as n
  from placed where line <> '' and conv_id is not null and turn is not null group by all
), whole as (
  select q.id, q.conv_id, q.turn, q.run, q.level, o.parent_turn, q.n
  from passages q join (
    select conv_id, passage, min(turn) as parent_turn from passages where level = 0 group by all
  ) o on q.conv_id = o.conv_id and q.passage = o.passage
  where q.level > 0 and o.parent_turn < q.turn
), single as (
  select q.id, q.conv_id, q.turn, q.run, q.level, o.parent_turn, 1 as n
  from placed q join (
    select conv_id, line, min(turn) as parent_turn from placed
    where level = 0 and line <> '' and conv_id is not null and turn is not null group by all
  ) o on q.conv_id = o.conv_id and q.line = o.line
  where q.level > 0 and q.line <> '' and o.parent_turn < q.turn
    and not exists (select 1 from whole w where w.id = q.id and w.run = q.run)
), found as (
  select * from whole union all select * from single
), linked as (
  select distinct id, run from found
), bodies as (
  select p.id,
    regexp_replace(coalesce(string_agg(x, chr(10) order by i) filter (
      level = 0 and not (next_level > 0 and l.id is not null and regexp_matches(x, '[:：][ \t\r]*$'))), ''),
      '^\s+|\s+$', '', 'g') as body,
    count(*) filter (level > 0 and line <> '') as n_quoted,
    coalesce(max(level) filter (line <> ''), 0) as max_level
  from placed p left join linked l on l.id = p.id and l.run = p.run + 1 group by p.id
), votes as (
  select conv_id, turn, parent_turn, coalesce(sum(n) filter (level = 1), 0) as direct, sum(n) as votes
  from found group by all
), ranked as (
  select *, row_number() over (partition by conv_id, turn order by direct desc, votes desc, parent_turn desc) as r,
    sum(votes) over (partition by conv_id, turn) as linked from votes
), links as (
  select conv_id, turn, parent_turn, linked from ranked where r = 1
), climb as (
  select conv_id, turn, parent_turn as root_turn, 1 as depth from links
  union all
  select c.conv_id, c.turn, l.parent_turn, c.depth + 1
  from climb c join links l on c.conv_id = l.conv_id and c.root_turn = l.turn
), threads as (
  select conv_id, turn, min(root_turn) as root_turn, max(depth) as depth from climb group by all
)
select r.conv_id, r.turn, r.role, cast(b.n_quoted as bigint) as n_quoted,
  cast(coalesce(l.linked, 0) as bigint) as n_linked, cast(b.max_level as bigint) as max_level,
  l.parent_turn, coalesce(t.root_turn, r.turn) as root_turn, cast(coalesce(t.depth, 0) as bigint) as depth,
  row_number() over (partition by r.conv_id order by coalesce(t.root_turn, r.turn) nulls first,
    r.turn nulls first, r.role nulls first, r.text) - 1 as position, b.body
from rows r join bodies b on r.id = b.id
left join links l on r.conv_id = l.conv_id and r.turn = l.turn
left join threads t on r.conv_id = t.conv_id and r.turn = t.turn
"""
