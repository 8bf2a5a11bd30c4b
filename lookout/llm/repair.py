"""Conversation structure repair by auction shortest paths.

A conversation's rows span a lattice: node (row, state) says that the rows before
``row`` are edited and what the result ends with; arcs are the edits Keep, Rerole,
Delete and Insert with integer costs. The cheapest repair is a shortest path from
(0, start) to the end, found by the auction algorithm: a path grows from the origin
while each node has a price with ``price[i] <= cost(i, j) + price[j]`` for all arcs.
If the price of the path's last node is below the best ``cost + price`` over its
arcs, the price rises to it and the path contracts by that node; else the path
extends along that arc. On arrival the prices are optimal dual values, so every arc
of every shortest path is tight (equality). Tight arcs that reach the end are
traced from the origin, always taking the least letter, which gives the least of
all cheapest edit strings.

Prices of a long path rise often, so the lattice is cut into blocks of ``BLOCK``
rows, last block first: the auction runs from each node of a block's first layer
to its last layer, whose prices are exact by then. Work is thus linear in the rows.

The damage, its faults' flags and the order of rows are Spark expressions. Rows are
dealt by conversation and sorted within tasks, and texts stream through: the first
pass keeps a few bytes and a digest of each row of its current conversation to find the
edits; the second reads a conversation's edit string, then its rows in order, and
hashes the repaired text as it goes. A digest of a whole conversation is made in one
task, whatever the conversation's length.

Defined results: nulls count as one space (roles, texts, and in the string that
chooses the damage); rows without ``conv_id`` are one conversation; rows are ordered by
(turn, role, text) after the damage, nulls first; a role without characters keeps
the state as it is; repeated rows are duplicates; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lookout.llm.common import materialize, prepare

BLOCK = 16
WHITE = r"[\x20\x09-\x0D]"
BLANK, TRUNCATED = 1, 2
KEEP, REROLE, DELETE, INSERT, OPEN_END = 0, 1, 2, 5, 5      # costs; OPEN_END: an undeleted truncated row
START, SYSTEM, USER, ASSISTANT = range(4)                  # what the repaired turns end with
STATES = 4
AFTER = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT,
         (ASSISTANT, "u"): USER}
NEXT = (USER, USER, ASSISTANT, USER)                       # the user or assistant turn that may follow
NAME = {USER: "user", ASSISTANT: "assistant"}


def damage(rows: DataFrame) -> DataFrame:
    """``conversations`` after the damage: ``conv_id``, ``turn``, ``role``, ``text``. A conversation
    that loses all rows keeps one with a null role."""
    space = F.lit(" ")
    r = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                    F.coalesce(F.col("role").cast("string"), space).alias("role"),
                    F.coalesce(F.col("text").cast("string"), space).alias("text"))
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), space))
    r = r.withColumn("kind", F.crc32(key.cast("binary")) % 20)
    kind = F.col("kind")
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(kind == 4, "user").otherwise(F.col("role"))
    left = r.where(kind != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"),
                                     F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1)))
                                               .otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy")
    gone = r.groupBy("conv_id").agg(F.count_if(kind != 0).alias("n")).where("n = 0")
    return left.unionByName(gone.select("conv_id", F.lit(None).cast("long").alias("turn"),
                                        F.lit(None).cast("string").alias("role"),
                                        F.lit(None).cast("string").alias("text")))


def row_faults(text: Column) -> Column:
    """BLANK, TRUNCATED or 0 for a row's text alone."""
    bare = F.regexp_replace(text, WHITE, "")
    return F.when(bare == "", BLANK).when(F.right(bare, F.lit(1)).rlike("[.!?]"), 0).otherwise(TRUNCATED)


def arcs(initial: str, must_go: bool, truncated: bool) -> list[list[tuple[str, int, int, int]]]:
    """For each state, the edits (letter, cost, rows taken, next state) at a row,
    letters in ascending order."""
    end = OPEN_END if truncated else 0
    out = []
    for state in range(STATES):
        mine = [("D", DELETE, 1, state), ("I", INSERT, 0, NEXT[state])]
        if not must_go:
            after = state if not initial else AFTER.get((state, initial))
            if after is not None:
                mine.append(("K", KEEP + end, 1, after))
            mine.append(("R", REROLE + end, 1, NEXT[state]))
        out.append(mine)
    return out


INSERTS = [[("I", INSERT, 0, NEXT[state])] for state in range(STATES)]
FAR = 1 << 60


def auction(block: list[list[list[tuple[str, int, int, int]]]], exits: list[int]) -> list[list[int]]:
    """Prices of all nodes of a block of rows whose last layer has the exact
    distances ``exits``; the first layer's are exact on return."""
    n = len(block)
    low = min(exits)
    price = [[low] * STATES for _ in range(n)] + [list(exits)]
    for origin in range(STATES):
        path = [(0, origin)]
        while path[-1][0] < n:
            row, state = path[-1]
            best, at = FAR, None
            for _, cost, taken, after in block[row][state]:
                value = cost + price[row + taken][after]
                if value < best:
                    best, at = value, (row + taken, after)
            if price[row][state] < best:
                price[row][state] = best
                if len(path) > 1:
                    path.pop()
            else:
                path.append(at)
    return price


def cheapest(codes: list[tuple[str, bool, bool]], block: int = BLOCK) -> tuple[int, str]:
    """Cost and least edit string over rows (initial, must go, truncated)."""
    known: dict = {}
    lattice = [known[c] if c in known else known.setdefault(c, arcs(*c)) for c in codes]
    # the last layer: only inserts are left, and an empty or complete result ends
    last = [0, 2 * INSERT, INSERT, 0]
    exits, parts = last, []
    for to in range(len(lattice), 0, -block):
        prices = auction(lattice[max(0, to - block):to], exits)
        exits = prices[0]
        parts.append(prices[:-1])
    price = [layer for part in reversed(parts) for layer in part] + [last]
    return price[0][START], trace(lattice + [INSERTS], price)


def trace(lattice: list, price: list[list[int]]) -> str:
    """The least letters along tight arcs from the first start node to the end."""
    n = len(price) - 1
    alive: list[list[bool]] = [[False] * STATES for _ in range(n + 1)]
    alive[n][START] = alive[n][ASSISTANT] = True
    for row in range(n, -1, -1):
        for _ in range(3):                         # inserts stay in a row's layer: two in a chain at most
            for state in range(STATES):
                alive[row][state] = alive[row][state] or any(
                    price[row][state] == cost + price[row + taken][after] and alive[row + taken][after]
                    for _, cost, taken, after in lattice[row][state])
    row, state, letters = 0, START, []
    while row < n or state in (SYSTEM, USER):
        for letter, cost, taken, after in lattice[row][state]:
            if price[row][state] == cost + price[row + taken][after] and alive[row + taken][after]:
                letters.append(letter)
                row, state = row + taken, after
                break
    return "".join(letters)


AUDIT = ("conv_id long, n_rows long, gaps long, blank long, duplicate long, truncated long, illegal long, "
         "cost long, audit string")
PAIRS = {"su", "ua", "au"}


def _arrow(spark: SparkSession, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(spark.createDataFrame([], ddl).schema)


def _ordered(rows: DataFrame, *columns: str) -> DataFrame:
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, "conv_id").sortWithinPartitions("conv_id", *columns)


class Audit:
    """The faults and codes of one conversation, row by row."""

    def __init__(self):
        self.codes: list[tuple[str, bool, bool]] = []
        self.seen: set[bytes] = set()
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first = self.last = self.before = None

    def add(self, turn: int | None, role: str, text: str, fault: int) -> None:
        initial = role[:1]
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last, self.turns = turn, self.turns + 1
        if self.before is not None and self.before + initial not in PAIRS:
            self.illegal += 1
        self.before = initial
        key = hashlib.blake2b(f"{len(role)}:{role}{text}".encode(), digest_size=16).digest()
        again = key in self.seen
        self.seen.add(key)
        blank, truncated = fault == BLANK, fault == TRUNCATED and not again
        self.blank += blank
        self.duplicate += again and not blank
        self.truncated += truncated
        # one-letter roles that mean nothing to the machine share a code
        self.codes.append((initial if initial in ("", "s", "u", "a") else "?", blank or again, truncated))

    def row(self, conv_id: int | None) -> tuple:
        cost, audit = cheapest(self.codes)
        gaps = self.last - self.first + 1 - self.turns if self.turns else 0
        return (conv_id, len(self.codes), gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit)


def audits(rows: DataFrame) -> DataFrame:
    """Per conversation of damaged rows: row count, gaps, faults, cost and edit string."""
    schema = _arrow(rows.sparkSession, AUDIT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, out = None, None, []
        for b in batches:
            for conv_id, turn, role, text, fault in zip(*(c.to_pylist() for c in b.columns)):
                if state is None or conv_id != now:
                    if state is not None:
                        out.append(state.row(now))
                    now, state = conv_id, Audit()
                if role is not None:
                    state.add(turn, role, text, fault)
            if len(out) >= 1000:
                yield _batch(out, schema)
                out = []
        if state is not None:
            out.append(state.row(now))
        yield _batch(out, schema)

    return _ordered(rows.withColumn("fault", row_faults(F.col("text"))), "turn", "role", "text").mapInArrow(run, AUDIT)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


class Repaired:
    """Repaired turns of one conversation, from its edit string and its rows in order."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, START

    def _inserts(self) -> Iterator[tuple[str, str]]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at, self.state = self.at + 1, NEXT[self.state]
            yield NAME[self.state], ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        yield from self._inserts()
        letter = self.audit[self.at]
        self.at += 1
        if letter == "K":
            self.state = AFTER[self.state, role[0]] if role else self.state
            yield role, text
        elif letter == "R":
            self.state = NEXT[self.state]
            yield NAME[self.state], text

    def end(self) -> Iterator[tuple[str, str]]:
        yield from self._inserts()


def repaired_turns(rows: DataFrame, found: DataFrame, ddl: str, each) -> DataFrame:
    """Runs ``each(conv_id, turns)`` over the repaired turns of every conversation, an
    iterator of (role, text) that streams; its tuples are the result's rows."""
    schema = _arrow(rows.sparkSession, ddl)
    none = F.lit(None).cast("string")
    both = rows.where("role is not null").select("conv_id", F.lit(1).alias("kind"), "turn", "role", "text", none.alias("audit")) \
        .unionByName(found.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"),
                                  none.alias("role"), none.alias("text"), "audit"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
        ahead = next(stream, None)
        out = []

        def turns(conv_id, audit):
            nonlocal ahead
            now = Repaired(audit)
            ahead = next(stream, None)
            while ahead is not None and ahead[1] == 1:
                yield from now.row(ahead[3], ahead[4])
                ahead = next(stream, None)
            yield from now.end()

        while ahead is not None:
            conv_id, _, _, _, _, audit = ahead
            rest = turns(conv_id, audit)
            out.extend(each(conv_id, rest))
            for _ in rest:                         # whatever was left unread
                pass
            if len(out) >= 1000:
                yield _batch(out, schema)
                out = []
        yield _batch(out, schema)

    return _ordered(both, "kind", "turn", "role", "text").mapInArrow(run, ddl)


def digest(conv_id: int | None, turns: Iterator[tuple[str, str]]) -> list[tuple]:
    """The conversation's id and the sha256 of its ``role:text``, newline-joined."""
    h, first = hashlib.sha256(), True
    for role, text in turns:
        h.update(f"{'' if first else chr(10)}{role}:{text}".encode())
        first = False
    return [(conv_id, h.hexdigest())]


def rows_out(conv_id: int | None, turns: Iterator[tuple[str, str]]) -> Iterator[tuple]:
    return ((conv_id, i, role, text) for i, (role, text) in enumerate(turns))


def repair(rows: DataFrame) -> DataFrame:
    """Repaired rows (``conv_id``, ``turn`` from 0, ``role``, ``text``) of rows taken as they are."""
    prepare(rows.sparkSession)
    kept = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                       F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
                       F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"))
    found = materialize(audits(kept), "audits")
    return repaired_turns(kept, found, "conv_id long, turn long, role string, text string", rows_out)


def repair_report(rows: DataFrame) -> DataFrame:
    """Per conversation of ``rows`` after the damage: faults, cost, edits and the repaired text's digest."""
    prepare(rows.sparkSession)
    damaged = damage(rows)
    found = materialize(audits(damaged), "audits")
    hashes = repaired_turns(damaged, found, "conv_id long, repaired_sha256 string", digest)
    return found.join(hashes, found.conv_id.eqNullSafe(hashes.conv_id)) \
        .select(found.conv_id, "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def oracle() -> str:
    """DuckDB SQL for :func:`repair_report` over the table ``conversations``: cheapest strings by
    dynamic programming over rows. ``q0`` to ``q3`` hold cost (12 digits) and edits by state."""
    def plus(s: str, cost: str, letter: str) -> str:
        return f"(lpad((left({s}, 12)::bigint + {cost})::varchar, 12, '0') || substr({s}, 13) || '{letter}')"

    insert = lambda *states: ", ".join(plus(s, str(INSERT), "I") for s in states)                # noqa: E731
    closed = f"""select key, i, q0, q1, q2, least(q3, {insert('q2')}) as q3
      from (select key, i, q0, q1, least(q2, {insert('q0', 'q1', 'q3')}) as q2, q3 from {{}})"""
    drop = [plus(f"q{s}", str(DELETE), "D") for s in range(STATES)]
    keep = lambda s, initial: f"case when not go and initial = '{initial}' then {plus(s, f'{KEEP} + ends', 'K')} end"
    pass_ = [f"case when not go and initial = '' then {plus(f'q{s}', f'{KEEP} + ends', 'K')} end" for s in range(STATES)]
    role = lambda s: f"case when not go then {plus(s, f'{REROLE} + ends', 'R')} end"              # noqa: E731
    step = ",\n       ".join([
        f"least({drop[0]}, {pass_[0]}) as q0",
        f"least({drop[1]}, {pass_[1]}, {keep('q0', 's')}) as q1",
        f"least({drop[2]}, {pass_[2]}, {', '.join(keep(s, 'u') + ', ' + role(s) for s in ('q0', 'q1', 'q3'))}) as q2",
        f"least({drop[3]}, {pass_[3]}, {keep('q2', 'a')}, {role('q2')}) as q3"])
    white = r"'[\x20\x09-\x0D]'"
    return f"""
with recursive
crc as materialized (select list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
         lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as t),
r as (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
             coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as name from conversations),
k as (select r.*, xor(4294967295, list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(name, ''), lambda c: ascii(c)::bigint)),
        lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1]))) % 20 as kind from r, crc),
d as (select conv_id, turn, case when kind = 4 then 'user' else role end as role,
             case kind when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
             unnest(case when kind = 3 then [0, 1] else [0] end) as copy from k where kind <> 0),
ids as materialized (select conv_id, row_number() over () as key from (select distinct conv_id from conversations)),
o as (select key, turn, role, text, left(role, 1) as initial, regexp_replace(text, {white}, '', 'g') as bare,
             row_number() over (partition by key order by turn nulls first, role, text, copy) as i
      from d join ids on d.conv_id is not distinct from ids.conv_id),
f as (select *, bare = '' as blank, row_number() over (partition by key, role, text order by i) > 1 as again,
             lag(initial) over (partition by key order by i) || initial as pair from o),
g as materialized (select *, again and not blank as duplicate, not blank and not again and right(bare, 1) not in ('.', '!', '?') as truncated,
             blank or again as go, case when not blank and not again and right(bare, 1) not in ('.', '!', '?') then {OPEN_END} else 0 end as ends from f),
dp as (
  select key, 0::bigint as i, lpad('0', 12, '0') as q0, null::varchar as q1, null::varchar as q2, null::varchar as q3 from ids
  union all
  select c.key, g.i, {step}
  from ({closed.format('dp')}) c join g on g.key = c.key and g.i = c.i + 1),
best as (select key, least(q0, q3) as b from ({closed.format('(select * from dp qualify i = max(i) over (partition by key))')})),
e as (select key, b[j + 12] as letter, j, sum((b[j + 12] <> 'I')::int) over (partition by key order by j) as i
      from (select key, b, unnest(range(1, length(b) - 11)) as j from best)),
w as (select e.key, j, letter, role, text, sum((letter in ('R', 'I') or letter = 'K' and initial in ('u', 'a'))::int)
             over (partition by e.key order by j) as place from e left join g on g.key = e.key and g.i = e.i),
s as (select key, string_agg(case letter when 'K' then role else case when place % 2 = 1 then 'user' else 'assistant' end end
             || ':' || case letter when 'I' then '' else text end, chr(10) order by j) as said from w where letter <> 'D' group by key),
n as (select key, count(blank) filter (where blank) as blank, count(*) filter (where duplicate) as duplicate,
             count(*) filter (where truncated) as truncated, count(*) filter (where pair not in ('su', 'ua', 'au')) as illegal,
             max(turn) - min(turn) + 1 - count(distinct turn) as gaps from g group by key)
select conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank, coalesce(duplicate, 0)::bigint as duplicate,
       coalesce(truncated, 0)::bigint as truncated, coalesce(illegal, 0)::bigint as illegal, left(b, 12)::bigint as cost,
       substr(b, 13) as audit, sha256(coalesce(said, '')) as repaired_sha256
from ids join best using (key) left join n using (key) left join s using (key)
"""
