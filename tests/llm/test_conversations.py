"""Conversation repair against a search over all edit sequences."""

import hashlib
import heapq
import itertools
import random
import re
import zlib

import pytest

from corpusloom.llm import conversations as C

SCHEMA = "conv_id long, turn long, role string, text string"
LANGUAGE = re.compile(r"(s?(ua)+)?")


def by_search(rows):
    """Cheapest edits and the ASCII-least of them, growing whole audits one letter at a time.

    `rows` are (role, text, fault). Audits of equal cost leave the queue in ASCII order, and
    the language is asked of the finished initials only.
    """
    queue = [(0, "", 0, ())]
    best = None
    seen = set()
    while queue:
        cost, audit, at, out = heapq.heappop(queue)
        if best and (cost, audit) > best[:2]:
            break
        initials = "".join(x.split(":")[0][:1] or "-" for x in out)
        if at == len(rows) and LANGUAGE.fullmatch(initials):
            if best is None:
                best = (cost, audit, out)
            continue
        # An odd prefix is dropped as soon as no ending can mend it.
        if not re.fullmatch(r"s?(ua)*u?", initials) or (at, initials, audit) in seen:
            continue
        seen.add((at, initials, audit))
        if len(audit) < 3 * len(rows) + 2:
            for role in ("user", "assistant"):
                heapq.heappush(queue, (cost + 2, audit + "I", at, (*out, f"{role}:")))
        if at < len(rows):
            role, text, fault = rows[at]
            heapq.heappush(queue, (cost + 3, audit + "D", at + 1, out))
            if fault not in ("blank", "duplicate"):
                more = int(fault == "truncated")
                heapq.heappush(queue, (cost + more, audit + "K", at + 1, (*out, f"{role}:{text}")))
                for other in ("user", "assistant"):
                    heapq.heappush(queue, (cost + 2 + more, audit + "R", at + 1, (*out, f"{other}:{text}")))
    return best


def by_hand(rows):
    """The report of rows (conv, turn, role, text) by the rules, one conversation at a time."""
    found = {}
    for conv in dict.fromkeys(r[0] for r in rows):
        own = []
        for _, turn, role, text in (r for r in rows if r[0] == conv):
            role, text = (" " if x is None else x for x in (role, text))
            key = ":".join(" " if x is None else str(x) for x in (conv, turn))
            kind = zlib.crc32(key.encode()) % 20
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            own += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
        said = lambda r: hashlib.sha256("\x1f".join([" " if conv is None else str(conv), r[1], r[2]]).encode()).hexdigest()
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], said(r)))
        seen, faults = set(), []
        for _, role, text in own:
            solid = text.strip(" \t\n\x0b\x0c\r")
            fault = "blank" if not solid else "duplicate" if (role, text) in seen else "" if solid[-1] in ".!?" else "truncated"
            seen.add((role, text))
            faults.append((role, text, fault))
        turns = [t for t, _, _ in own if t is not None]
        initials = [r[:1] for _, r, _ in own]
        cost, audit, out = by_search(faults)
        found[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *(sum(f == k for _, _, f in faults) for k in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials)),
            cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest(),
        )
    return found


def reported(frame):
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    rows = frame.collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: tuple(r[n] for n in names) for r in rows}


def some_rows(seed, conversations):
    rng = random.Random(seed)
    texts = ["Yes.", "Really?", "No", "well ", "", " \t", "a.\n", "x!", None, "é."]
    roles = ["user", "assistant", "system", "tool", "", None, "User"]
    rows = []
    for conv in range(conversations):
        for turn in range(rng.randint(1, 6)):
            role = rng.choice(roles) if rng.random() < 0.4 else ("user", "assistant")[turn % 2]
            text = rng.choice(texts) if rng.random() < 0.5 else f"Text {turn}."
            turn = None if rng.random() < 0.1 else turn - (rng.random() < 0.2)
            rows.append((None if conv == 7 else conv, turn, role, text))
    return rows + rows[5:9]


@pytest.mark.parametrize("seed", range(3))
def test_solve_is_the_least_of_all_edit_sequences(seed):
    rng = random.Random(seed)
    for _ in range(120):
        rows = [
            (rng.choice(["user", "assistant", "system", "tool"]), str(k), rng.choice(["", "", "truncated", "blank", "duplicate"]))
            for k in range(rng.randint(0, 5))
        ]
        number = {"": C.WHOLE, "truncated": C.TRUNCATED, "blank": C.BLANK, "duplicate": C.DUPLICATE}
        codes = bytes(4 * C._INITIAL.get(role[0], 0) + number[fault] for role, _, fault in rows)
        cost, audit, out = by_search(rows)
        assert C.solve(codes, C.END, True)[C.BEGIN] == (cost, audit)
        again = []
        for letter, row, state in C.follow(codes, audit, C.BEGIN):
            if letter != C.DELETE:
                role = rows[row][0] if letter == C.KEEP else C._NAMES[state]
                again.append(f"{role}:{'' if row is None else rows[row][1]}")
        assert tuple(again) == out


def test_costs_of_blocks_add_up():
    rng = random.Random(5)
    for _ in range(50):
        codes = bytes(rng.randrange(16) for _ in range(rng.randint(2, 9)))
        at = rng.randint(1, len(codes) - 1)
        left, right = C.costs(codes[:at]), C.costs(codes[at:])
        joined = tuple(min(left[4 * s + m] + right[4 * m + t] for m in range(4)) for s in range(4) for t in range(4))
        assert tuple(min(c, C._NEVER) for c in joined) == C.costs(codes)


@pytest.mark.parametrize("block_rows", [1, 2, C.BLOCK_ROWS])
def test_repair_equals_the_search(spark, block_rows):
    rows = some_rows(11, 40)
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", state string, n int")
    assert reported(C.repair(C.damage(frame.repartition(3)), block_rows)) == by_hand(rows)


def test_order_of_rows_and_partitions_do_not_matter(spark):
    rows = some_rows(3, 25)
    shuffled = rows[:]
    random.Random(1).shuffle(shuffled)
    first = reported(C.damage_and_repair(spark.createDataFrame(rows, SCHEMA)))
    assert first == reported(C.repair(C.damage(spark.createDataFrame(shuffled, SCHEMA).repartition(7)), 3))


def test_one_long_conversation_is_cut(spark):
    # A message said 3,000 times in turns of its own, and 500 equal rows of one turn.
    rows = [(1, t, "user" if t % 2 else "assistant", "Same.") for t in range(3000)] + [(1, 9, "user", "Same.")] * 500
    frame = spark.createDataFrame(rows, SCHEMA)
    found = reported(C.repair(C.damage(frame), 64))[1]
    whole = reported(C.repair(C.damage(frame), 10_000))[1]
    assert found == whole and found[6].count("D") > 2500


def test_dropped_conversations_and_empty_tables(spark):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    frame = spark.createDataFrame([(gone, 0, "user", "Hi.")], SCHEMA)
    nothing = hashlib.sha256(b"").hexdigest()
    assert reported(C.damage_and_repair(frame)) == {gone: (0, 0, 0, 0, 0, 0, "", nothing)}
    assert C.damage_and_repair(spark.createDataFrame([], SCHEMA)).collect() == []


def test_long_texts(spark):
    rows = [(1, 0, "user", "a" * 3_000_000 + "."), (1, 1, "assistant", "b" * 2_000_000 + "."), (2, 0, "user", " " * 100_000)]
    assert reported(C.damage_and_repair(spark.createDataFrame(rows, SCHEMA))) == by_hand(rows)
