"""Repair of conversations' structure by Knuth's generalisation of Dijkstra's algorithm.

A conversation is well formed if its roles are an optional system turn and then user and assistant in turn. Its repair
is the lightest derivation in a weighted hypergraph. Items are prefixes, (rows read, what stands last), and edits of
single rows; a hyperedge leads from a prefix and an edit of the next row to a longer prefix, or from a prefix and an
inserted turn to a prefix of the same rows. An item's weight is (cost, audit), where the audit lists the edits'
initials. Costs add up and audits are joined, prefix first: such a function is monotone and never less than the
prefix, hence superior, so that each item popped from the agenda has its final weight. (Two audits of equal cost over
equal rows are never prefixes of one another, as every edit beyond a row's own costs something.)

Conversations of up to ``LONG`` rows are repaired as Spark's sorted shuffle streams them by. Longer ones are
sorted by range over all tasks; blocks of their rows are repaired for each state that they may begin in, the
blocks' weights are composed in order, and only the hash of a repaired text, which nobody can compute in parts,
is streamed through one task, row by row.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitmart.llm.common import join_spread, materialize

KEEP, REROLE, DELETE, INSERT = "KRDI"
#: Costs of the edits; an unfinished turn that stays costs as much again as an insertion.
COST = {KEEP: 0, REROLE: 3, DELETE: 4, INSERT: 3}
UNFINISHED = 3
#: What may stand after what; an empty conversation, or one that ends with the assistant, is complete.
START, SYSTEM, USER, ASSISTANT = range(4)
AFTER = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
COMPLETE = (START, ASSISTANT)
LEGAL = {"su", "ua", "au"}
#: Rows of the longest conversation that a task holds at once, and of a block of a longer one. 2^33 is a multiple of blocks.
LONG, BLOCK = 4096, 1024
BLANKS = " \t\n\x0b\x0c\r"
Weight = tuple[int, str]


def edits(initial: str, fault: str) -> list[tuple[int, str, str | None]]:
    """(cost, initial of the edit, initial of the role that the row then has) of each edit that a row allows."""
    found: list[tuple[int, str, str | None]] = [(COST[DELETE], DELETE, None)]
    if fault not in ("blank", "duplicate"):
        more = UNFINISHED if fault == "truncated" else 0
        found += [(COST[KEEP] + more, KEEP, initial), *[(COST[REROLE] + more, REROLE, role) for role in "ua"]]
    return found


def derivations(rows: list[tuple[str, str]], entry: int = START, goals: tuple[int, ...] | None = COMPLETE) -> dict[int, Weight]:
    """The final weights of the items that have read all ``rows`` (initial of the role, fault), by state, from ``entry``
    on. With ``goals`` the agenda ends as soon as one of those is final, and only that one is returned."""
    axioms = [edits(*row) for row in rows]
    inserts = [(COST[INSERT], INSERT, role) for role in "ua"]
    agenda: list[tuple[int, str, int, int]] = [(0, "", 0, entry)]
    final: set[tuple[int, int]] = set()
    ended: dict[int, Weight] = {}
    while agenda:
        cost, audit, read, state = heapq.heappop(agenda)
        if (read, state) in final:
            continue
        final.add((read, state))
        if read == len(rows):
            if goals is None:
                ended[state] = cost, audit
            elif state in goals:
                return {state: (cost, audit)}
        for step, options in ((1, axioms[read] if read < len(rows) else ()), (0, inserts)):
            for price, letter, role in options:
                after = state if role is None else AFTER.get((state, role))
                if after is not None and (read + step, after) not in final:
                    heapq.heappush(agenda, (cost + price, audit + letter, read + step, after))
    return ended


class Rewriter:
    """Applies an audit to rows as they come, and gives each repaired turn (edit, role, text) to ``put``."""

    def __init__(self, put: Callable[[str, str, str], None]):
        self.state, self.put, self.audit, self.at = START, put, "", 0

    def _put(self, letter: str, role: str | None, text: str) -> None:
        role = role if role is not None else "assistant" if self.state == USER else "user"
        self.state = AFTER[self.state, role[:1]]
        self.put(letter, role, text)

    def inserted(self) -> None:
        while self.audit[self.at : self.at + 1] == INSERT:
            self._put(INSERT, None, "")
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self.inserted()
        letter = self.audit[self.at]
        self.at += 1
        if letter != DELETE:
            self._put(letter, role if letter == KEEP else None, text)

    def slice(self, audit: str) -> None:
        self.inserted()
        self.audit, self.at = audit, 0


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, gone): the rows, null roles and texts as one blank, damaged by crc32 of "conv_id:turn"
    (a null as one blank) mod 20: 0 marks the row as gone, 1 empties the text, 2 takes its ``.!?``, 3 repeats the row, 4
    makes the user say it."""
    def known(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    damage = F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn")).cast("binary")) % 20
    text = F.when(damage == 1, "").when(damage == 2, F.translate(known("text"), ".!?", "")).otherwise(known("text"))
    rows = conversations.select(
        "conv_id", "turn", F.when(damage == 4, "user").otherwise(known("role")).alias("role"), text.alias("text"), (damage == 0).alias("gone"),
        F.explode(F.when(damage == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    )
    return rows.drop("copy")


SUMMARY = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
TURNS = "place long, edit string, role string, text string"
ORDER = ("turn", "role", "text")


def _sha() -> tuple[Callable[[str, str, str], None], Callable[[], str]]:
    """(what takes the repaired turns, what then gives the hash of their lines)."""
    digest, any_ = hashlib.sha256(), False

    def put(_: str, role: str, text: str) -> None:
        nonlocal any_
        digest.update((("\n" if any_ else "") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
        any_ = True

    return put, digest.hexdigest


def _faults(rows: list[tuple]) -> list[str]:
    seen, found = set(), []
    for _, role, text, last in rows:
        known = (role, text) in seen
        seen.add((role, text))
        found.append("blank" if not last else "duplicate" if known else "" if last in ".!?" else "truncated")
    return found


def _gaps(turns: set[int]) -> int | None:
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    return gaps if gaps < 1 << 63 else None


def _short(whole: bool):
    """What a task does with its rows, sorted by conversation: a summary of each, or its repaired turns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", *[c.split()[0] for c in (SUMMARY if whole else TURNS).split(", ")]]
        out: list[list] = [[] for _ in names]
        begun, now, rows, kind = False, None, [], pa.null()

        def finish() -> None:
            fault = _faults(rows)
            ((cost, audit),) = derivations([(r[1][:1], f) for r, f in zip(rows, fault, strict=True)]).values()
            place = 0

            def put_turn(edit: str, role: str, text: str) -> None:
                nonlocal place
                for column, value in zip(out, (now, place, edit, role, text), strict=True):
                    column.append(value)
                place += 1

            put, digest = _sha() if whole else (put_turn, None)
            rewriter = Rewriter(put)
            rewriter.slice(audit)
            for _, role, text, _ in rows:
                rewriter.row(role, text)
            rewriter.inserted()
            if whole:
                illegal = sum(a[1][:1] + b[1][:1] not in LEGAL for a, b in zip(rows, rows[1:]))
                counts = [fault.count(f) for f in ("blank", "duplicate", "truncated")]
                for column, value in zip(out, (now, _gaps({r[0] for r in rows} - {None}), *counts, illegal, cost, audit, digest()), strict=True):
                    column.append(value)

        def flush() -> pa.RecordBatch:
            types = [kind, *[pa.int64() if c.endswith(" long") else pa.string() for c in (SUMMARY if whole else TURNS).split(", ")]]
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names)
            for c in out:
                c.clear()
            return batch

        for batch in batches:
            kind = batch.column("conv_id").type
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "last", "gone")]
            for conversation, turn, role, text, last, gone in zip(*columns, strict=True):
                if begun and conversation != now:
                    finish()
                    rows = []
                begun, now = True, conversation
                if not gone:
                    rows.append((turn, role, text, last))
            if len(out[0]) >= 10_000 or sum(map(len, out[-1])) > 8_000_000:
                yield flush()
        if begun:
            finish()
        if out[0]:
            yield flush()

    return run


def _block(group: pd.DataFrame) -> pd.DataFrame:
    """A block of a long conversation: its weights from each state to each, and its counts."""
    group = group.sort_values("number")
    fault = ["blank" if not last else "duplicate" if again else "" if last in ".!?" else "truncated" for last, again in zip(group["last"], group["again"], strict=True)]
    initials = group["initial"].tolist()
    rows = list(zip(initials, fault, strict=True))
    maps = [derivations(rows, entry, None) for entry in range(4)]
    costs = [m.get(s, (-1, ""))[0] for m in maps for s in range(4)]
    audits = [m.get(s, (-1, ""))[1] for m in maps for s in range(4)]
    illegal = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))
    values = [group["g"].iat[0], group["number"].iat[0], costs, audits, *[fault.count(f) for f in ("blank", "duplicate", "truncated")], illegal, initials[0], initials[-1]]
    return pd.DataFrame([values], columns=[c.split()[0] for c in BLOCKS.split(", ")])


BLOCKS = "g long, number long, costs array<long>, audits array<string>, blank long, duplicate long, truncated long, illegal long, first string, last string"
SLICES = "g long, number long, slice string, blank long, duplicate long, truncated long, illegal long, cost long"


def _compose(group: pd.DataFrame) -> pd.DataFrame:
    """Blocks in order: the lightest way through all of them, as each block's slice of the audit."""
    group = group.sort_values("number")
    ways: dict[int, tuple[int, str, tuple | None]] = {START: (0, "", None)}
    for costs, audits in zip(group["costs"], group["audits"], strict=True):
        further: dict[int, tuple[int, str, tuple | None]] = {}
        for entry, (cost, audit, slices) in ways.items():
            for state in range(4):
                price, more = int(costs[4 * entry + state]), audits[4 * entry + state]
                best = further.get(state)
                if price >= 0 and (best is None or cost + price < best[0] or (cost + price == best[0] and audit + more < best[1])):
                    further[state] = cost + price, audit + more, (slices, more)
        ways = further
    cost, _, slices = min((ways[s] for s in COMPLETE if s in ways), key=lambda w: w[:2])
    found = []
    while slices is not None:
        slices, one = slices
        found.append(one)
    out = group[["g", "number", "blank", "duplicate", "truncated", "illegal"]].assign(slice=found[::-1], cost=[cost] + [0] * (len(group) - 1))
    seams = [int(a + b not in LEGAL) for a, b in zip(group["last"], group["first"].iloc[1:])]
    out["illegal"] += [0, *seams]
    return out[[c.split()[0] for c in SLICES.split(", ")]]


def _long(whole: bool):
    """What a task does with long conversations, sorted by number, slices of audits at the first rows of blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, place, rewriter, digest = None, 0, None, None
        turns: list[tuple] = []

        def put_turn(edit: str, role: str, text: str) -> None:
            nonlocal place
            turns.append((now, place, edit, role, text))
            place += 1

        def flush() -> Iterator[pa.RecordBatch]:
            if whole:
                yield pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([digest()])], ["g", "repaired_sha256"])
            else:
                types = [pa.int64(), pa.int64(), *[pa.string()] * 3]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*turns) if turns else [[]] * 5, types, strict=True)], ["g", "place", "edit", "role", "text"])
                turns.clear()

        for batch in batches:
            for g, role, text, slice_ in zip(*[batch.column(c).to_pylist() for c in ("g", "role", "text", "slice")], strict=True):
                if g != now:
                    if rewriter:
                        rewriter.inserted()
                        yield from flush()
                    now, place = g, 0
                    put, digest = _sha() if whole else (put_turn, None)
                    rewriter = Rewriter(put)
                if slice_ is not None:
                    rewriter.slice(slice_)
                rewriter.row(role, text)
            if not whole and turns:
                yield from flush()
        if rewriter:
            rewriter.inserted()
            yield from flush()

    return run


def _repair(rows: DataFrame, whole: bool, long: int) -> DataFrame:
    kind, schema = rows.schema["conv_id"].dataType, SUMMARY if whole else TURNS
    last = F.substring(F.rtrim("text", F.lit(BLANKS)), -1, 1)
    rows = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text", last.alias("last"), "gone")
    sizes = rows.where("NOT gone").groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > long)
    large = materialize(sizes.select("conv_id", F.monotonically_increasing_id().alias("g")), "long")
    some = large.limit(1).count() > 0
    same = rows["conv_id"].eqNullSafe(large["conv_id"])
    short = rows.join(large, same, "left_anti") if some else rows
    sorted_ = short.repartition("conv_id").sortWithinPartitions("conv_id", *ORDER)
    out = sorted_.mapInArrow(_short(whole), f"conv_id {kind.simpleString()}, {schema}")
    if not some:
        return out
    mine = rows.where("NOT gone").join(large.withColumnRenamed("conv_id", "conv"), rows["conv_id"].eqNullSafe(F.col("conv"))).drop("conv", "gone", "conv_id")
    order = ["g", *ORDER, "salt"]  # rows equal in all else may lie in several tasks
    mine = mine.withColumn("salt", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = materialize(mine.withColumn("number", F.monotonically_increasing_id()).drop("salt"), "numbered")
    slim = numbered.select("g", "number", F.substring("role", 1, 1).alias("initial"), "last", F.md5(F.concat("role", F.lit("\0"), "text").cast("binary")).alias("k"))
    slim = materialize(slim, "slim")
    earliest = slim.groupBy("g", "k").agg(F.min("number").alias("earliest"))
    marked = join_spread(slim, earliest, ["g", "k"], "number").withColumn("again", F.col("number") > F.col("earliest"))
    marked = marked.select("g", "number", "initial", "last", "again", F.floor(F.col("number") / BLOCK).alias("block"))
    blocks = materialize(marked.groupBy("g", "block").applyInPandas(lambda group: _block(group), BLOCKS), "blocks")
    slices = materialize(blocks.groupBy("g").applyInPandas(lambda group: _compose(group), SLICES), "slices")
    dealt = numbered.join(slices.select("g", "number", "slice"), ["g", "number"], "left").select("g", "number", "role", "text", "slice")
    dealt = dealt.repartition("g").sortWithinPartitions("g", "number")
    walked = dealt.mapInArrow(_long(whole), "g long, repaired_sha256 string" if whole else f"g long, {TURNS}")
    if not whole:
        return out.unionByName(walked.join(large, "g").select("conv_id", *[c.split()[0] for c in TURNS.split(", ")]))
    spans = numbered.groupBy("g", "turn").count().groupBy("g").agg(F.max("turn").alias("high"), F.min("turn").alias("low"), F.count("turn").alias("n"))
    wide = [F.col(c).cast("decimal(38,0)") for c in ("high", "low", "n")]
    gaps = F.when(F.col("n") == 0, F.lit(0).cast("long")).otherwise((wide[0] - wide[1] + 1 - wide[2]).try_cast("long"))
    spans = spans.select("g", gaps.alias("gaps"))
    counted = slices.groupBy("g").agg(*[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")], F.sort_array(F.collect_list(F.struct("number", "slice"))).alias("s"))
    counted = counted.withColumn("audit", F.array_join(F.transform("s", lambda s: s["slice"]), "")).drop("s")
    joined = large.join(counted, "g").join(spans, "g").join(walked, "g")
    return out.unionByName(joined.select("conv_id", *[c.split()[0] for c in SUMMARY.split(", ")]))


def repair(turns: DataFrame, gone: str | None = None, long: int = LONG) -> DataFrame:
    """A row for each conversation of ``turns`` (conv_id, turn, role, text): gaps, blank, duplicate, truncated, illegal,
    cost, audit and the hash of the repaired lines ``role:text``. Of rows where the boolean column ``gone`` is true only
    the conversation counts.

    Rows go by turn, nulls first, those of one turn by role and text; repeated rows stay and count as duplicates.
    ``gaps`` are the numbers that no turn has between the first and the last, null beyond 64 bits. A row is blank, or a
    duplicate of an earlier row's role and text, or truncated (ends in none of ``.!?``), whichever is first. ``illegal``
    counts neighbours whose roles' initials aren't system-user, user-assistant or assistant-user. The repair is the
    cheapest; of equally cheap ones, that with the least audit. An empty role can't be kept. Null roles and texts count as one blank; null
    conversation ids are one conversation; one without rows has zeros, no audit and the hash of nothing. Other columns
    are not read; an empty table gives an empty result. An audit is one value, so that a conversation's must fit a row.
    """
    return _repair(_given(turns, gone), True, long)


def repaired_turns(turns: DataFrame, gone: str | None = None, long: int = LONG) -> DataFrame:
    """(conv_id, place, edit, role, text): the turns of the repaired conversations, in order by ``place``; see :func:`repair`."""
    return _repair(_given(turns, gone), False, long)


def _given(turns: DataFrame, gone: str | None) -> DataFrame:
    known = [F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")]
    lost = F.lit(False) if gone is None else F.coalesce(F.col(f"`{gone}`"), F.lit(False))
    return turns.select("conv_id", "turn", *known, lost.alias("gone"))


def _repaired_sql() -> str:
    """The same in SQL: a conversation's four prefixes (cost, audit, text) are carried from row to row by recursion."""
    def plus(state: str, price: str, letter: str, line: str | None = None) -> str:
        text = f"{state}.t" if line is None else f"{state}.t || CASE WHEN {state}.t = '' THEN '' ELSE chr(10) END || {line}"
        return f"CASE WHEN {state} IS NOT NULL THEN {{'c': {state}.c + {price}, 'a': {state}.a || '{letter}', 't': {text}}} END"

    def reading(state: int, role: str | None, sources: tuple[int, ...]) -> str:
        found = [plus(f"s{state}", str(COST[DELETE]), DELETE)]
        name = {"u": "'user'", "a": "'assistant'"}.get(role)
        for s in sources:
            found.append(f"CASE WHEN stays AND initial = '{role}' THEN {plus(f's{s}', 'unfinished', KEEP, 'line')} END")
            if name:
                found.append(f"CASE WHEN stays THEN {plus(f's{s}', f'{COST[REROLE]} + unfinished', REROLE, name + chr(124) * 2 + chr(39) + ':' + chr(39) + chr(124) * 2 + 'txt')} END")
        return f"list_min([{', '.join(found)}])"

    insert_user = ", ".join(plus(f"n{s}", str(COST[INSERT]), INSERT, "'user:'") for s in (START, SYSTEM, ASSISTANT))
    return rf"""
WITH RECURSIVE steps AS (SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)), lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc),
keyed AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS txt,
                 xor(list_reduce(list_concat([4294967295], list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda x: CAST(ord(x) AS BIGINT))),
                     lambda c, b: xor(crc[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % 20 AS damage FROM conversations, steps),
ids AS (SELECT conv_id, row_number() OVER () AS k FROM (SELECT DISTINCT conv_id FROM conversations)),
rows_ AS (SELECT k, turn, CASE WHEN damage = 4 THEN 'user' ELSE role END AS role,
                 CASE damage WHEN 1 THEN '' WHEN 2 THEN replace(replace(replace(txt, '.', ''), '!', ''), '?', '') ELSE txt END AS txt
          FROM keyed JOIN ids ON keyed.conv_id IS NOT DISTINCT FROM ids.conv_id, range(CASE damage WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)),
placed AS (SELECT *, row_number() OVER w AS i, left(role, 1) AS initial,
                  lag(left(role, 1)) OVER w || left(role, 1) AS two, right(rtrim(txt, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS ending
           FROM rows_ WINDOW w AS (PARTITION BY k ORDER BY turn NULLS FIRST, role, txt)),
faulty AS (SELECT *, role || ':' || txt AS line, CASE WHEN ending = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY k, role, txt ORDER BY i) > 1 THEN 'duplicate' WHEN ending NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM placed),
counted AS (SELECT k, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
                   count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (two NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n FROM faulty GROUP BY k),
way AS (
  SELECT k, CAST(0 AS BIGINT) AS i, {{'c': 0, 'a': '', 't': ''}} AS s0, CAST(NULL AS STRUCT(c INTEGER, a VARCHAR, t VARCHAR)) AS s1,
         {{'c': {COST[INSERT]}, 'a': 'I', 't': 'user:'}} AS s2, {{'c': {2 * COST[INSERT]}, 'a': 'II', 't': 'user:' || chr(10) || 'assistant:'}} AS s3 FROM ids
  UNION ALL
  SELECT k, i, n0, n1, m2, list_min([n3, {plus("m2", str(COST[INSERT]), INSERT, "'assistant:'")}]) FROM (
    SELECT *, list_min([n2, {insert_user}]) AS m2 FROM (
      SELECT k, i, {reading(START, None, ())} AS n0, {reading(SYSTEM, "s", (START,))} AS n1, {reading(USER, "u", (START, SYSTEM, ASSISTANT))} AS n2, {reading(ASSISTANT, "a", (USER,))} AS n3 FROM (
        SELECT w.k, f.i, s0, s1, s2, s3, initial, line, txt, fault NOT IN ('blank', 'duplicate') AS stays, CASE WHEN fault = 'truncated' THEN {UNFINISHED} ELSE 0 END AS unfinished
        FROM way w JOIN faulty f ON f.k = w.k AND f.i = w.i + 1)))),
done AS (SELECT ids.conv_id, c.*, list_min([w.s0, w.s3]) AS best FROM ids LEFT JOIN counted c USING (k) JOIN way w ON w.k = ids.k AND w.i = coalesce(c.n, 0))
SELECT conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       CAST(best.c AS BIGINT) AS cost, best.a AS audit, sha256(best.t) AS repaired_sha256 FROM done
"""


REPAIRED_SQL = _repaired_sql()
