import hashlib
import itertools
import random
import re
import zlib

import duckdb
import pytest

from stocktake.llm import dialogue

FIELDS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string, copies string, kind string, place long"


def plain_repair(rows):
    """The cheapest and least audit by trying all strings of edits, shortest costs first; rows of (role, text, fault)."""
    best = None

    def walk(i, said, cost, audit):
        nonlocal best
        if best is not None and cost > best[0]:
            return
        initials = "".join(r[:1] or "-" for r, _ in said)  # an empty role fits nowhere
        if not re.fullmatch(r"(s?(ua)*u?)?", initials):
            return
        if i == len(rows) and re.fullmatch(r"(s?(ua)+)?", initials):
            best = min(best or (cost, audit, said), (cost, audit, said), key=lambda b: b[:2])
        if not audit.endswith("III"):
            for role in ("user", "assistant"):
                walk(i, [*said, (role, "")], cost + 2, audit + "I")
        if i < len(rows):
            role, text, fault = rows[i]
            walk(i + 1, said, cost + 3, audit + "D")
            if fault in ("", "truncated"):
                extra = fault == "truncated"
                walk(i + 1, [*said, (role, text)], cost + extra, audit + "K")
                for other in ("user", "assistant"):
                    walk(i + 1, [*said, (other, text)], cost + 2 + extra, audit + "R")

    walk(0, [], 0, "")
    return best


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        body = re.findall(r"[^\x20\x09-\x0D]", text)
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def plain_report(conv_id, rows):
    """rows of (turn, role, text), in order."""
    kinds = faults(rows)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    initials = [r[:1] for _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
    cost, audit, said = plain_repair([(r, t, k) for (_, r, t), k in zip(rows, kinds)])
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in said).encode()).hexdigest()
    return (conv_id, gaps, *[kinds.count(k) for k in ("blank", "duplicate", "truncated")], illegal, cost, audit, digest)


def in_order(rows):
    digest = lambda r: hashlib.sha256(f"{r[1]}\0{r[2]}".encode()).digest()
    return sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1], digest(r)))


def table_cost(kinds):
    """Cost by the full table of turns and states, for long conversations."""
    costs = [0, *[dialogue.NEVER] * 3]
    for kind in kinds:
        costs = [min(costs[s] + dialogue.STEPS[kind].get((s, e), (dialogue.NEVER,))[0] for s in range(4)) for e in range(4)]
    return min(c + e for c, e in zip(costs, dialogue.TO_END))


def table_audit(kinds):
    """The least audit by a full table from the end."""
    best = [(len(c) * 2, c) for c in dialogue.CLOSING]
    for kind in reversed(kinds):
        best = [
            min((c + best[e][0], a + best[e][1]) for (x, e), (c, a) in dialogue.STEPS[kind].items() if x == s)
            for s in range(4)
        ]
    return best[0]


@pytest.mark.parametrize("seed", range(4))
def test_solved_against_all_edits(seed):
    rng = random.Random(seed)
    roles = ["system", "user", "assistant", "tool", ""]
    for _ in range(60):
        rows = [(rng.choice(roles), f"t{i}", rng.choice(["", "", "", "truncated", "blank", "duplicate"])) for i in range(rng.randint(0, 5))]
        kinds = bytes(
            4 * ["", "truncated", "blank", "duplicate"].index(f) + ("sua".find(r[0]) if r and r[0] in "sua" else 3) for r, _, f in rows
        )
        cost, audit, end = dialogue.solved(kinds)
        audit += dialogue.CLOSING[end]
        want = plain_repair(rows)
        assert (cost, audit) == want[:2]
        assert [(r, t) for _, r, t in dialogue.applied(audit, dialogue.START, [r for r, _, _ in rows], [t for _, t, _ in rows])] == want[2]


def test_long_conversations_against_a_full_table():
    rng = random.Random(1)
    for n in (1, 2, 3, 50, 333, 1000):
        for kinds in (bytes(rng.choices(range(16), k=n)), bytes([1, 2] * n)[:n], bytes([1] * n), bytes([3, 5] * n)[:n]):
            cost, audit, end = dialogue.solved(kinds)
            assert (cost, audit + dialogue.CLOSING[end]) == table_audit(kinds)
            assert cost == table_cost(kinds)


def test_chunks_give_the_whole():
    rng = random.Random(2)
    for _ in range(200):
        kinds = bytes(rng.choices(range(16), k=rng.randint(1, 30)))
        cuts = sorted(rng.sample(range(len(kinds) + 1), min(3, len(kinds))))
        pieces = [kinds[a:b] for a, b in zip([0, *cuts], [*cuts, len(kinds)])]
        behind = [dialogue.TO_END]
        for p in reversed(pieces[1:]):
            c = dialogue.between(p)
            behind.insert(0, tuple(min(c[4 * s + e] + behind[0][e] for e in range(4)) for s in range(4)))
        state, audit, costs = dialogue.START, "", []
        for p, b in zip(pieces, behind):
            cost, part, state = dialogue.solved(p, state, b)
            costs.append(cost)
            audit += part
        assert (costs[0], audit + dialogue.CLOSING[state]) == table_audit(kinds)


TEXTS = ["Hi.", "Yes!", "Why?", "cut off", "", " \n", None, "Hi. ", "a.b", "é。"]


def conversations(seed, n=40):
    rng = random.Random(seed)
    out = []
    for conv_id in [None, *range(n)]:
        for k in range(rng.randint(1, 6)):
            turn = rng.choice([k, k, k, k + 1, None])
            out.append((conv_id, turn, rng.choice(["system", "user", "assistant", "user", "assistant", "tool", None, ""]), rng.choice(TEXTS)))
    return out


def reports(df):
    return sorted((tuple(r[c] for c in FIELDS) for r in df.collect()), key=lambda r: (r[0] is not None, r[0] or 0))


def expected(rows):
    convs = {}
    for conv_id, *row in rows:
        convs.setdefault(conv_id, []).append(row)
    return sorted((plain_report(i, in_order(r)) for i, r in convs.items()), key=lambda r: (r[0] is not None, r[0] or 0))


def frame_of(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 7) for r in rows], SCHEMA)


@pytest.mark.parametrize("chunk", [1024, 1, 3])
def test_reports(spark, monkeypatch, chunk):
    monkeypatch.setattr(dialogue, "CHUNK", chunk)
    rows = conversations(chunk)
    assert reports(dialogue.repair_report(frame_of(spark, rows))) == expected(rows)


def test_conversation_over_many_parts(spark, monkeypatch):
    monkeypatch.setattr(dialogue, "CHUNK", 8)
    rng = random.Random(5)
    rows = [(1, k, rng.choice(["user", "assistant", "system"]), rng.choice(["Hi.", "So", f"{k}.", f"{k}!"])) for k in range(300)]
    rows += [(1, 7, "user", "Again.")] * 40 + [(0, 0, "user", "Q?"), (0, 1, "assistant", "A."), (2, 0, "user", "Q?")]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        found = reports(dialogue.repair_report(frame_of(spark, rows)))
        turns = dialogue.repaired_turns(frame_of(spark, rows)).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "2")
    for conv_id, got in zip((0, 1, 2), found):
        mine = in_order([r[1:] for r in rows if r[0] == conv_id])
        kinds = [4 * ["", "truncated", "blank", "duplicate"].index(f) + "sua".find(r[0]) for f, (_, r, _) in zip(faults(mine), mine)]
        cost, audit = table_audit(bytes(kinds))
        said = [(r, t) for _, r, t in dialogue.applied(audit, dialogue.START, [r for _, r, _ in mine], [t for _, _, t in mine])]
        assert got[0] == conv_id and got[6:] == (cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in said).encode()).hexdigest())
        assert [(r["role"], r["text"]) for r in sorted(turns, key=lambda r: r["place"]) if r["conv_id"] == conv_id] == said


def test_hot_repeated_turn(spark):
    rows = [(3, 1, "user", "Same.")] * 500 + [(3, 2, "assistant", "Same.")] * 3
    cost, audit = 3 * 501, "K" + "D" * 499 + "K" + "D" * 2
    got = reports(dialogue.repair_report(frame_of(spark, rows)))
    assert [(r[3], r[6], r[7]) for r in got] == [(501, cost, audit)]


def test_empty(spark):
    assert dialogue.repair_report(frame_of(spark, [])).collect() == []
    assert dialogue.repaired_turns(frame_of(spark, [])).collect() == []


def plain_query(rows):
    convs = {}
    for conv_id, turn, role, text in rows:
        found = convs.setdefault(conv_id, [])
        way = zlib.crc32(f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if way == 0:
            continue
        text = "" if way == 1 else re.sub("[.!?]", "", text) if way == 2 else text
        found += [(turn, "user" if way == 4 else role, text)] * (2 if way == 3 else 1)
    return sorted((plain_report(i, in_order(r)) for i, r in convs.items()), key=lambda r: (r[0] is not None, r[0] or 0))


def test_query_and_sql(spark, tmp_path):
    rows = [r for k, r in enumerate(conversations(11, 120)) if r[1] is not None or k % 3]
    one_turn = {(c, t): (c, t, r, x) for c, t, r, x in rows}  # SQL orders turns of one number by text, the operator by digest
    frame_of(spark, list(one_turn.values())).write.parquet(f"{tmp_path}/conversations.parquet")
    found = dialogue.op13_dialogue(spark, str(tmp_path))
    got = reports(found)
    assert got == plain_query(one_turn.values())
    assert {0, 1, 2, 3, 4} <= {zlib.crc32(f"{c}:{t}".encode()) % 20 for c, t in one_turn}
    sql = duckdb.connect()
    sql.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    result = sql.execute(dialogue.OP13_SQL)
    assert [c[0] for c in result.description] == found.columns == FIELDS
    assert sorted(result.fetchall(), key=lambda r: (r[0] is not None, r[0] or 0)) == got
