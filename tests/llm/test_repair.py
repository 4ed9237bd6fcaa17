import hashlib
import itertools
import random
import zlib
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from visitmart.llm.queries import op12_repair, oracle_sql
from visitmart.llm.repair import COMPLETE, derivations, damaged, repair, repaired_turns

BLANKS = " \t\n\x0b\x0c\r"


def broken(rows):
    """The damage, row by row; (conversation, turn, role, text) of what is left, and all conversations."""
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out, {r[0] for r in rows}


def cheapest(rows, faults):
    """All edit sequences of up to one insertion at each place, by exhaustion over prefixes kept whole: no agenda."""
    def pattern(roles):
        rest = roles[1:] if roles[:1] == "s" else roles
        return rest == "ua" * (len(rest) // 2) and (rest or not roles)

    best = None
    places = [list(itertools.product(["", "u", "a"], _edits(r, f))) for r, f in zip(rows, faults)]
    for choice in itertools.product(*places, ["", "u", "a"]):
        roles = audit = ""
        cost, lines = 0, []
        for (inserted, (price, letter, role)), row in zip(choice[:-1], rows):
            if inserted:
                roles, audit, cost = roles + inserted, audit + "I", cost + 3
                lines.append(f"{'user' if inserted == 'u' else 'assistant'}:")
            audit, cost = audit + letter, cost + price
            if letter != "D":
                roles += role[:1] or "?"
                lines.append(f"{role}:{row[3]}")
        if choice[-1]:
            roles, audit, cost = roles + choice[-1], audit + "I", cost + 3
            lines.append(f"{'user' if choice[-1] == 'u' else 'assistant'}:")
        if pattern(roles) and (best is None or (cost, audit) < best[:2]):
            best = cost, audit, "\n".join(lines)
    return best


def _edits(row, fault):
    more = 3 if fault == "t" else 0
    return [(4, "D", None)] + ([] if fault in ("b", "d") else [(more, "K", row[2]), (3 + more, "R", "user"), (3 + more, "R", "assistant")])


def plain(rows, conversations, best=cheapest):
    out = {}
    for conv in conversations:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        faults = []
        for i, r in enumerate(own):
            kept = r[3].rstrip(BLANKS)
            again = any(x[2:] == r[2:] for x in own[:i])
            faults.append("b" if not kept else "d" if again else "" if kept[-1] in ".!?" else "t")
        turns = {r[1] for r in own} - {None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, audit, text = best(own, faults)
        out[conv] = (gaps, *[faults.count(f) for f in "bdt"], illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return out


def test_query_against_sql(spark, data):
    rows = Counter(map(tuple, op12_repair(spark, data).collect()))
    db = duckdb.connect()
    db.execute(f"create view conversations as from '{data}/conversations.parquet'")
    assert rows == Counter(db.execute(oracle_sql()["op12_repair"]).fetchall())


SCHEMA = "conv_id long, turn long, role string, text string, gone string, g int, number string, `odd.name` int, last string"


@pytest.fixture(scope="module")
def conversations(spark):
    """Short conversations of every kind: null ids, turns, roles and texts, ties, repeated rows, gaps, odd roles."""
    rng = random.Random(4)
    rows = []
    for conv in [None, 2**63 - 1, -(2**63), 2**53 + 1, *range(60)]:
        for _ in range(rng.randrange(1, 5)):
            role = rng.choice(["user", "assistant", "system", "user", "assistant", "tool", "", None, "ünknown"])
            text = rng.choice(["Yes.", "No!", "Why?", "and then", "", " \t\n", None, "Ünï.\n", "a . b", "Yes."])
            rows.append((conv, rng.choice([None, 0, 1, 2, 3, 7, -2]), role, text))
    rows += [(1000 + i, 0, "user", "Hi.") for i in range(40)]  # some lose their only row
    return rows, spark.createDataFrame([(*r, "x", 1, "n", 2, "l") for r in rows], SCHEMA)


@pytest.mark.parametrize("long", [4096, 2, 0])
def test_odd_rows_against_exhaustion(conversations, long):
    rows, df = conversations
    left, ids = broken(rows)
    want = plain(left, ids)
    got = repair(damaged(df), gone="gone", long=long).collect()
    assert len(got) == len(want) and {r["conv_id"]: tuple(r)[1:] for r in got} == want
    assert any(not r["audit"] for r in got) and {"K", "R", "D", "I"} <= set("".join(r["audit"] for r in got))


@pytest.mark.parametrize("long", [4096, 2])
def test_turns_are_those_of_the_hash(conversations, long):
    _, df = conversations
    turns = repaired_turns(damaged(df), gone="gone", long=long)
    lines = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("place", F.concat("role", F.lit(":"), "text").alias("line")))).alias("t"))
    lines = {r["conv_id"]: "\n".join(t["line"] for t in r["t"]) for r in lines.collect()}
    for r in repair(damaged(df), gone="gone").collect():
        assert r["repaired_sha256"] == hashlib.sha256(lines.get(r["conv_id"], "").encode()).hexdigest()


def _forward(rows, faults):
    """Dynamic programming from row to row, for conversations beyond exhaustion."""
    after = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    ways = {0: (0, "", "")}

    def insert(ways):
        for _ in range(2):
            for s, (c, a, t) in list(ways.items()):
                role = "assistant" if s == 2 else "user"
                new = (c + 3, a + "I", f"{t}\n{role}:")
                ways[after[s, role[0]]] = min(ways.get(after[s, role[0]], new), new)
        return ways

    for r, f in zip(rows, faults):
        ways, new = insert(ways), {}
        for s, (c, a, t) in ways.items():
            for price, letter, role in _edits(r, f):
                to = s if role is None else after.get((s, role[:1]))
                if to is not None:
                    way = (c + price, a + letter, t if role is None else f"{t}\n{role}:{r[3]}")
                    new[to] = min(new.get(to, way), way)
        ways = new
    c, a, t = min(w for s, w in insert(ways).items() if s in (0, 3))
    return c, a, t[1:]


def test_a_hot_conversation_in_blocks(spark):
    """Thousands of rows of the null conversation, with copies and ties, over several blocks and tasks."""
    rng = random.Random(9)
    rows = [(None, rng.choice([None, *range(1500)]), rng.choice(["user", "assistant", "system"]), rng.choice(["Yes.", f"t{rng.randrange(3000)}.", f"t{rng.randrange(3000)}", " "])) for _ in range(5000)]
    rows += [(3, 0, "user", "Hi."), (3, 1, "assistant", "Hi.")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(7)
    got = {r["conv_id"]: tuple(r)[1:] for r in repair(df).collect()}
    assert got == plain(rows, {None, 3}, _forward)


def test_agenda_pops_final_weights():
    rng = random.Random(1)
    for _ in range(300):
        rows = [(rng.choice("usax"), rng.choice(["", "", "blank", "truncated", "duplicate"])) for _ in range(rng.randrange(7))]
        everywhere = derivations(rows, goals=None)
        assert list(derivations(rows).values()) == [min(everywhere[s] for s in COMPLETE if s in everywhere)]


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert repair(damaged(none), gone="gone").count() == 0 and repaired_turns(none).count() == 0
