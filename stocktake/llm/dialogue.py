"""Repair of conversations whose turns should read (system)? (user assistant)*, by Hirschberg's divide and conquer.

Every turn is kept (0), given the role that fits (2), or deleted (3; blank and repeated turns must be), and empty turns of the role that fits may be
inserted anywhere (2); a truncated turn that is not deleted adds 1. A conversation so far is in one of four states: nothing yet,
after a system, a user or an assistant turn. A state and an edit give the next state, so a string of edit initials, the audit, says what was
done. Sought is the cheapest, of equally cheap ones the ASCII-least.

Halves of a conversation meet in the middle: costs forward from the state before it and backward from the state behind it are four
numbers each; the states where their sum is least are the optimal crossings, and both halves are solved for these. Of several
crossings the one with the least audit is taken. An audit counts the insertions before a turn with that turn, so
all audits of the same turns end with a turn's edit and none is the beginning of another: comparing them compares whole repairs. Only vectors
and audits are held, no table of all turns and states.

Conversations lie sorted in parts by ranges of (conv_id, turn, digest), so a very long one spans many tasks. One that lies inside a part and has at most
CHUNK turns is solved where it lies. Others are cut into chunks: the costs of a chunk between any two states are 16 numbers;
a pass from the last chunk to the first turns them into costs to the end for each chunk, and a pass from the first to the last
solves each chunk with the state before it known. Both hold one chunk at a time. The digest of a repaired text is one chain over its bytes, so
that last pass takes a conversation in one task, however long; everything before is spread.

Defined results: null roles and texts count as one space; turns are in order of turn (null first), then role, then digest of role and text. Equal turns of one
number lie side by side; they are folded to one row with a count, so a hot turn does not fill a task. A turn is repeated if an earlier one has its
role and text. A role is known by its first character; a role of another kind can only be changed or deleted. Null ids are one
conversation. An empty table gives an empty one; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stocktake.llm.common import bounded_batches, staged, table

START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
#: Initials of the roles, in the order of a turn's kind; any other role is the last kind.
INITIALS = "sua"
SOUND, TRUNCATED, BLANK, DUPLICATE = range(4)
NEXT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
RIGHT_ORDER = {"su", "ua", "au"}
#: The role that fits behind each state, and the state it leads to.
FITTING = ("user", "user", "assistant", "user")
FITTED = (USER, USER, ASSISTANT, USER)
NEVER = math.inf
KEEP, REROLE, DELETE, INSERT, CUT = 0, 2, 3, 2, 1
#: Turns of a chunk, and characters of its texts unless one turn has more.
CHUNK, CHUNK_CHARS = 1024, 4 << 20


def _step(kind: int) -> dict[tuple[int, int], tuple[float, str]]:
    """For a turn of this kind, (state before, state after) -> (cost, audit), with the insertions before the turn."""
    fault, initial = divmod(kind, 4)
    best: dict[tuple[int, int], tuple[float, str]] = {}
    for before in STATES:
        state = before
        for inserted in range(3):  # a third insertion leads to a state that one reaches
            ways = [(state, DELETE, "D")]
            if fault < BLANK:
                extra = CUT if fault == TRUNCATED else 0
                ways.append((FITTED[state], REROLE + extra, "R"))
                after = NEXT.get((state, INITIALS[initial : initial + 1]))
                if after is not None:
                    ways.append((after, KEEP + extra, "K"))
            for after, cost, letter in ways:
                way = (cost + INSERT * inserted, "I" * inserted + letter)
                best[before, after] = min(best.get((before, after), (NEVER, "")), way)
            state = FITTED[state]
    return best


STEPS = [_step(kind) for kind in range(16)]
#: The same costs, from each state and to each state.
FROM = [tuple(tuple(step.get((a, b), (NEVER, ""))[0] for b in STATES) for a in STATES) for step in STEPS]
INTO = [tuple(zip(*costs)) for costs in FROM]
#: Insertions that end a conversation behind each state.
CLOSING = ("", "II", "I", "")
TO_END = tuple(float(INSERT * len(c)) for c in CLOSING)


def _only(state: int) -> tuple[float, ...]:
    return tuple(0.0 if s == state else NEVER for s in STATES)


def forward(kinds: bytes, costs: tuple[float, ...]) -> tuple[float, ...]:
    """Costs of reaching each state behind these turns from such costs before them."""
    a, b, c, d = costs
    for kind in kinds:
        a, b, c, d = [min(a + w, b + x, c + y, d + z) for w, x, y, z in INTO[kind]]
    return a, b, c, d


def backward(kinds: bytes, costs: tuple[float, ...]) -> tuple[float, ...]:
    """Costs to the end from each state before these turns with such costs behind them."""
    a, b, c, d = costs
    for kind in reversed(kinds):
        a, b, c, d = [min(a + w, b + x, c + y, d + z) for w, x, y, z in FROM[kind]]
    return a, b, c, d


def _audits(kinds: bytes, asked: set[tuple[int, int]]) -> dict[tuple[int, int], str]:
    """The least audit among the cheapest, for each asked pair of states before and behind the turns."""
    if len(kinds) == 1:
        return {pair: STEPS[kinds[0]][pair][1] for pair in asked}
    left, right = kinds[: len(kinds) // 2], kinds[len(kinds) // 2 :]
    ahead = {s: forward(left, _only(s)) for s in {s for s, _ in asked}}
    behind = {e: backward(right, _only(e)) for e in {e for _, e in asked}}
    crossings = {}
    for s, e in asked:
        sums = [x + y for x, y in zip(ahead[s], behind[e])]
        crossings[s, e] = [m for m in STATES if sums[m] == min(sums)]
    first = _audits(left, {(s, m) for (s, _), ms in crossings.items() for m in ms})
    second = _audits(right, {(m, e) for (_, e), ms in crossings.items() for m in ms})
    return {(s, e): min(first[s, m] + second[m, e] for m in ms) for (s, e), ms in crossings.items()}


def solved(kinds: bytes, state: int = START, to_end: tuple[float, ...] = TO_END) -> tuple[float, str, int]:
    """(cost to the end, audit of these turns, state behind them) from a state before them and the costs to the end behind them."""
    if not kinds:
        return to_end[state], "", state
    sums = [x + y for x, y in zip(forward(kinds, _only(state)), to_end)]
    ends = [e for e in STATES if sums[e] == min(sums)]
    audits = _audits(kinds, {(state, e) for e in ends})
    end = min(ends, key=lambda e: audits[state, e])
    return min(sums), audits[state, end], end


def between(kinds: bytes) -> list[float]:
    """The 16 costs of these turns from each state to each state, row by row."""
    return [c for s in STATES for c in forward(kinds, _only(s))]


class _Conversation:
    """What is known of the conversation that is being read: tallies of all its turns, and the turns not yet handed on."""

    def __init__(self, conv_id: int | None) -> None:
        self.conv_id = conv_id
        self.first = self.last = self.least = None
        self.turns = self.illegal = 0
        self.faults = [0, 0, 0, 0]
        self.clear()

    def clear(self) -> None:
        self.kinds, self.roles, self.texts, self.numbers, self.chars = bytearray(), [], [], [], 0

    def tally(self, turn: int | None, role: str, kind: int) -> None:
        initial = role[:1]
        if self.last is not None and self.last + initial not in RIGHT_ORDER:
            self.illegal += 1
        self.last = initial
        self.faults[kind >> 2] += 1
        if turn is not None and (self.least is None or turn != self.first):
            self.turns += 1
            self.least, self.first = turn if self.least is None else self.least, turn

    def hold(self, turn: int | None, role: str, text: str, kind: int) -> None:
        gone = kind >> 2 >= BLANK
        self.kinds.append(kind)
        self.numbers.append(turn)
        self.roles.append(role)
        self.texts.append("" if gone else text)
        self.chars += 0 if gone else len(text)

    def report(self, cost: float, audit: str, digest: str) -> dict:
        gaps = 0 if self.least is None else self.first - self.least + 1 - self.turns
        return {
            "conv_id": self.conv_id, "gaps": gaps, "blank": self.faults[BLANK], "duplicate": self.faults[DUPLICATE], "truncated": self.faults[TRUNCATED],
            "illegal": self.illegal, "cost": int(cost), "audit": audit, "repaired_sha256": digest,
        }


def applied(audit: str, state: int, roles: list[str], texts: list[str]) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of the turns that an audit leaves, from the state before them."""
    turns = iter(zip(roles, texts))
    for edit in audit:
        role, text = (FITTING[state], "") if edit == "I" else next(turns)
        if edit == "D":
            continue
        role = FITTING[state] if edit == "R" else role
        state = FITTED[state] if edit in "IR" else NEXT[state, role[:1]]
        yield edit, role, text


class _Text:
    """Digest of turns joined by line ends."""

    def __init__(self) -> None:
        self.sha, self.any = hashlib.sha256(), False

    def add(self, turns: Iterator[tuple[str, str, str]]) -> None:
        for _, role, text in turns:
            self.sha.update(f"{'\n' if self.any else ''}{role}:{text}".encode())
            self.any = True


_LONG, _TEXT = pa.int64(), pa.string()
_REPORT = {**dict.fromkeys(("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost"), _LONG), "audit": _TEXT, "repaired_sha256": _TEXT}
_CHUNK = {"part": _LONG, "no": _LONG, "kinds": pa.binary(), "numbers": pa.list_(_LONG), "roles": pa.list_(_TEXT), "texts": pa.list_(_TEXT)}
_TURN = {"conv_id": _LONG, "place": _LONG, "edit": _TEXT, "role": _TEXT, "text": _TEXT}
_NAMES = {_LONG: "long", _TEXT: "string", pa.binary(): "binary", pa.list_(_LONG): "array<long>", pa.list_(_TEXT): "array<string>", pa.list_(pa.float64()): "array<double>"}


def _schema(kinds: dict[str, pa.DataType]) -> str:
    return ", ".join(f"{c} {_NAMES[k]}" for c, k in kinds.items())


def _batches(rows: Iterator[dict], kinds: dict[str, pa.DataType], many: int = 2000) -> Iterator[pa.RecordBatch]:
    held, chars = [], 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in held], k) for c, k in kinds.items()], names=list(kinds))

    for row in rows:
        held.append(row)
        chars += sum(map(len, row["texts"])) if row.get("texts") else len(row.get("text") or "")
        if len(held) >= many or chars > CHUNK_CHARS:
            yield batch()
            held, chars = [], 0
    if held:
        yield batch()


def _sorted_turns(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, kind, copies: every different turn of a conversation once, in order within and over parts. A turn with copies 0
    only tells that the conversation exists."""
    digest = F.unhex(F.sha2(F.concat(F.col("role"), F.lit("\x00"), F.col("text")), 256))
    rows = turns.withColumn("digest", digest)
    number = F.struct(F.col("turn").isNotNull().alias("numbered"), F.col("turn").alias("number"))
    firsts = rows.where("copies > 0").groupBy("conv_id", "digest").agg(F.min(number).alias("first"))
    firsts = firsts.select(*[F.col(c).alias(f"first_{c}") for c in ("conv_id", "digest")], F.col("first.number").alias("first_turn"))
    # The turn number is part of the key, so one text all over a long conversation is not one key.
    one = rows.groupBy("conv_id", "turn", "digest").agg(F.first("role").alias("role"), F.first("text").alias("text"), F.sum("copies").alias("copies"))
    same = [one[a].eqNullSafe(firsts[b]) for a, b in (("conv_id", "first_conv_id"), ("turn", "first_turn"), ("digest", "first_digest"))]
    known = one.join(firsts, same[0] & same[1] & same[2], "left").withColumn("again", F.col("first_digest").isNull())
    # A text without white space at its end, of which the last character decides.
    last = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    fault = F.when(last == "", BLANK).when(F.col("again"), DUPLICATE).when(~last.isin(".", "!", "?"), TRUNCATED).otherwise(SOUND)
    initial = F.position(F.substring("role", 1, 1), F.lit(INITIALS)) - 1
    kind = fault * 4 + F.when((F.col("role") == "") | (initial < 0), 3).otherwise(initial)
    rows = known.select("conv_id", "turn", "role", "text", "digest", kind.cast("long").alias("kind"), F.col("copies").cast("long"))
    return rows.repartitionByRange("conv_id", "turn", "role", "digest").sortWithinPartitions("conv_id", "turn", "role", "digest").drop("digest")


def _turns_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv_id, turn, role, text, kind) of every turn, copies each by itself; kind None for a conversation's mere existence."""
    for batch in batches:
        for conv_id, turn, role, text, kind, copies in zip(*(c.to_pylist() for c in batch.columns)):
            if not copies:
                yield conv_id, turn, role, text, None
                continue
            yield conv_id, turn, role, text, kind
            again = kind if kind >> 2 == BLANK else DUPLICATE * 4 + kind % 4
            for _ in range(copies - 1):
                yield conv_id, turn, role, text, again


def _short_solved(finish: Callable[[_Conversation, Callable], Iterator[dict]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[dict]]:
    """Solve what lies whole in a part, hand on the chunks of everything else."""

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        part = TaskContext.get().partitionId()
        once = lru_cache(1 << 14)(solved)  # conversations of the same kinds of turns are solved once in a task
        now, whole, no = None, False, 0  # the first conversation may have begun in the part before

        def chunk() -> dict:
            row = {"conv_id": now.conv_id, "part": part, "no": no, "kinds": bytes(now.kinds), "numbers": now.numbers, "roles": now.roles, "texts": now.texts}
            now.clear()
            return row

        for conv_id, turn, role, text, kind in _turns_of(batches):
            if now is None or conv_id != now.conv_id:
                if now is not None:
                    if whole:
                        yield from finish(now, once)
                    else:
                        yield chunk()
                    whole, no = True, 0
                now = _Conversation(conv_id)
            if kind is None:
                continue
            if len(now.kinds) >= CHUNK or now.chars > CHUNK_CHARS:
                yield chunk()
                whole, no = False, no + 1
            if whole:
                now.tally(turn, role, kind)
            now.hold(turn, role, text, kind)
        if now is not None:  # the last one may go on in the next part
            yield chunk()

    return solve


def _to_end(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """From chunks in descending order with their 16 costs: each chunk with the costs to the end behind it."""
    conv_id, costs, first = None, TO_END, True
    for batch in batches:
        for row in batch.to_pylist():
            if first or row["conv_id"] != conv_id:
                conv_id, costs, first = row["conv_id"], TO_END, False
            yield {"conv_id": conv_id, "part": row["part"], "no": row["no"], "behind": list(costs)}
            c = row["between"]
            costs = tuple(min(c[4 * s + e] + costs[e] for e in STATES) for s in STATES)


def _chunked(chunks: DataFrame) -> DataFrame:
    """The chunks, each with the costs behind it, sorted in parts that hold whole conversations."""
    at = {"conv_id": _LONG, "part": _LONG, "no": _LONG}
    costed = {**at, "between": pa.list_(pa.float64())}
    ended = {**at, "behind": pa.list_(pa.float64())}

    def cost(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[dict]:
            for batch in batches:
                for row in batch.to_pylist():
                    yield {**row, "between": between(row["kinds"])}

        yield from _batches(rows(), costed)

    matrices = chunks.select(*at, "kinds").mapInArrow(cost, _schema(costed))
    last_first = matrices.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("part"), F.desc("no"))
    behind = last_first.mapInArrow(lambda batches: _batches(_to_end(batches), ended), _schema(ended))
    behind = behind.select(*[F.col(c).alias(f"of_{c}") for c in at], "behind")
    same = [chunks[c].eqNullSafe(behind[f"of_{c}"]) for c in at]
    joined = chunks.join(behind, same[0] & same[1] & same[2]).select(*chunks.columns, "behind")
    return joined.repartition("conv_id").sortWithinPartitions("conv_id", "part", "no")


def _chunk_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, dict]]:
    """Each chunk, with whether a conversation begins with it."""
    conv_id, first = None, True
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1).to_pylist()[0]
            yield first or row["conv_id"] != conv_id, row
            conv_id, first = row["conv_id"], False


def _reports_of_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    now = None

    def finished() -> dict:
        text.add(applied(CLOSING[state], state, [], []))
        return now.report(cost, "".join(audits) + CLOSING[state], text.sha.hexdigest())

    for begins, row in _chunk_rows(batches):
        if begins:
            if now is not None:
                yield finished()
            now, text, audits, state, cost = _Conversation(row["conv_id"]), _Text(), [], START, None
        for turn, role, kind in zip(row["numbers"], row["roles"], row["kinds"]):
            now.tally(turn, role, kind)
        total, audit, end = solved(row["kinds"], state, tuple(row["behind"]))
        cost = total if cost is None else cost
        text.add(applied(audit, state, row["roles"], row["texts"]))
        audits.append(audit)
        state = end
    if now is not None:
        yield finished()


def _report(now: _Conversation, solve: Callable) -> Iterator[dict]:
    cost, audit, end = solve(bytes(now.kinds))
    audit, text = audit + CLOSING[end], _Text()
    text.add(applied(audit, START, now.roles, now.texts))
    yield now.report(cost, audit, text.sha.hexdigest())


def _turns_of_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    conv_id, state, place, first = None, START, 0, True

    def closing() -> Iterator[dict]:
        for k, (edit, role, text) in enumerate(applied(CLOSING[state], state, [], [])):
            yield {"conv_id": conv_id, "place": place + k, "edit": edit, "role": role, "text": text}

    for begins, row in _chunk_rows(batches):
        if begins:
            yield from closing()
            conv_id, state, place = row["conv_id"], START, 0
        _, audit, end = solved(row["kinds"], state, tuple(row["behind"]))
        for edit, role, text in applied(audit, state, row["roles"], row["texts"]):
            yield {"conv_id": conv_id, "place": place, "edit": edit, "role": role, "text": text}
            place += 1
        state = end
    yield from closing()


def _left_turns(now: _Conversation, solve: Callable) -> Iterator[dict]:
    _, audit, end = solve(bytes(now.kinds))
    for place, (edit, role, text) in enumerate(applied(audit + CLOSING[end], START, now.roles, now.texts)):
        yield {"conv_id": now.conv_id, "place": place, "edit": edit, "role": role, "text": text}


def _solve(turns: DataFrame, out: dict[str, pa.DataType], short: Callable, long: Callable, name: str) -> DataFrame:
    bounded_batches(turns.sparkSession)
    both = {**out, **_CHUNK}
    solve = _short_solved(short)
    rows = _sorted_turns(turns).mapInArrow(lambda batches: _batches(solve(batches), both), _schema(both))
    rows = staged(rows, name)
    done = rows.where("kinds IS NULL").select(*out)
    chunks = _chunked(rows.where("kinds IS NOT NULL").select("conv_id", *_CHUNK))
    return done.unionByName(chunks.mapInArrow(lambda batches: _batches(long(batches), out), _schema(out)))


def _as_turns(conversations: DataFrame, copies: Column | int = 1) -> DataFrame:
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    return conversations.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), role.alias("role"), text.alias("text"),
        (F.lit(copies) if isinstance(copies, int) else copies).cast("long").alias("copies"),
    )


def repair_report(conversations: DataFrame, copies: Column | int = 1) -> DataFrame:
    """For each conversation: gaps in its turn numbers, turns by first fault (blank, repeated, truncated), neighbours out of order, the cost and audit of
    its repair, and the SHA-256 of the repaired `role:text`, joined by line ends. `copies` says how often a row counts, 0 for not at all."""
    return _solve(_as_turns(conversations, copies), _REPORT, _report, _reports_of_chunks, "dialogue-report")


def repaired_turns(conversations: DataFrame, copies: Column | int = 1) -> DataFrame:
    """The turns of every repaired conversation: conv_id, place (from 0), edit (K kept, R new role, I inserted), role, text."""
    return _solve(_as_turns(conversations, copies), _TURN, _left_turns, _turns_of_chunks, "dialogue-turns")


def damaged(conversations: DataFrame) -> tuple[DataFrame, Column]:
    """The rows with the damage that the query's contract plants, and how often each then counts."""
    conv_id, turn, role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text"))
    way = F.crc32(F.concat(conv_id, F.lit(":"), turn)) % 20
    rows = conversations.select(
        "conv_id", "turn", F.when(way == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(way == 1, F.lit("")).when(way == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"), way.alias("way"),
    )
    return rows, F.when(F.col("way") == 0, 0).when(F.col("way") == 3, 2).otherwise(1)


def op13_dialogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report on every conversation after its planted damage."""
    return repair_report(*damaged(table(spark, sf_dir, "conversations")))


_KEY = "coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')"
_STEP = "list_reduce(list_prepend(xor(c, x), CAST(range(8) AS BIGINT[])), lambda s, k: xor(s >> 1, 3988292384 * (s & 1)))"
_HASH = f"""xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(key) + 1),
    lambda i: CAST(ascii(substr(key, i, 1)) AS BIGINT))), lambda c, x: {_STEP}), 4294967295)"""

OP13_SQL = rf"""
WITH RECURSIVE keyed AS (SELECT *, {_KEY} AS key FROM conversations),
hashed AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_HASH} % 20 AS h FROM keyed),
rows AS (SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN h = 1 THEN '' WHEN h = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE WHEN h = 3 THEN 2 ELSE 1 END)) AS copy FROM hashed WHERE h <> 0),
convs AS (SELECT conv_id, row_number() OVER () AS id FROM (SELECT DISTINCT conv_id FROM conversations)),
numbered AS (SELECT id, turn, role, text, row_number() OVER (PARTITION BY id ORDER BY turn NULLS FIRST, role, text, copy) AS i
    FROM rows JOIN convs ON rows.conv_id IS NOT DISTINCT FROM convs.conv_id),
tested AS (SELECT *, row_number() OVER (PARTITION BY id, role, text ORDER BY i) AS r, substr(role, 1, 1) AS initial,
    regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z', 1) AS ending, lag(substr(role, 1, 1)) OVER (PARTITION BY id ORDER BY i) AS before
    FROM numbered),
kinds AS (SELECT *, CASE WHEN ending = '' THEN 'blank' WHEN r > 1 THEN 'duplicate' WHEN ending NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM tested),
tallies AS (SELECT id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank,
    count(*) FILTER (WHERE fault = 'duplicate') AS duplicate, count(*) FILTER (WHERE fault = 'truncated') AS truncated,
    count(*) FILTER (WHERE before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM kinds GROUP BY id),
inserts(s, k, t, said) AS (VALUES (0, 0, 0, ''), (0, 1, 2, 'user:;'), (0, 2, 3, 'user:;assistant:;'), (1, 0, 1, ''), (1, 1, 2, 'user:;'), (1, 2, 3, 'user:;assistant:;'),
    (2, 0, 2, ''), (2, 1, 3, 'assistant:;'), (2, 2, 2, 'assistant:;user:;'), (3, 0, 3, ''), (3, 1, 2, 'user:;'), (3, 2, 3, 'user:;assistant:;')),
legal(t, initial, e) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
fits(t, role, e) AS (VALUES (0, 'user', 2), (1, 'user', 2), (2, 'assistant', 3), (3, 'user', 2)),
edits AS (
  SELECT id, i, t, t AS e, 3 AS cost, 'D' AS letter, '' AS said FROM kinds, (SELECT unnest(range(4)) AS t)
  UNION ALL SELECT id, i, t, e, CASE WHEN fault = 'truncated' THEN 3 ELSE 2 END, 'R', fits.role || ':' || text || chr(0) FROM kinds, fits WHERE fault IN ('', 'truncated')
  UNION ALL SELECT id, i, t, e, CASE WHEN fault = 'truncated' THEN 1 ELSE 0 END, 'K', role || ':' || text || chr(0) FROM kinds JOIN legal USING (initial)
    WHERE fault IN ('', 'truncated')),
moves AS (SELECT id, i, s, e, 2 * k + cost AS cost, repeat('I', k) || letter AS audit, replace(inserts.said, ';', chr(0)) || edits.said AS said FROM edits JOIN inserts USING (t)),
best AS (
  SELECT id, n + 1 AS i, s, {{'cost': 2 * k, 'audit': repeat('I', k), 'said': replace(said, ';', chr(0))}} AS b
  FROM tallies, inserts WHERE (s, k) IN ((0, 0), (1, 2), (2, 1), (3, 0))
  UNION ALL
  SELECT m.id, m.i, m.s, min({{'cost': m.cost + x.b.cost, 'audit': m.audit || x.b.audit, 'said': m.said || x.b.said}})
  FROM best x JOIN moves m ON m.id = x.id AND m.i = x.i - 1 AND m.e = x.s GROUP BY m.id, m.i, m.s),
won AS (SELECT id, b FROM best WHERE i = 1 AND s = 0)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, CAST(coalesce(b.cost, 0) AS BIGINT) AS cost, coalesce(b.audit, '') AS audit,
  sha256(replace(CASE WHEN b.said = '' OR b IS NULL THEN '' ELSE substr(b.said, 1, length(b.said) - 1) END, chr(0), chr(10))) AS repaired_sha256
FROM convs LEFT JOIN tallies ON tallies.id = convs.id LEFT JOIN won ON won.id = convs.id
"""
