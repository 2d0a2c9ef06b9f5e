import hashlib
import heapq
import random
import re
import zlib

import pytest

from changeguard.llm import queries, turns as T

SCHEMA = "conv_id long, turn long, role string, text string, symbols string, same int, at string"
SPACE = "\x20\x09-\x0D"


def cheapest(rows):
    """(cost, audit, repaired lines) by a search over all edits in order of (cost, audit)."""
    seen, faults = set(), []
    for role, text in rows:
        if not re.search(f"[^{SPACE}]", text):
            faults.append("blank")
        elif (role, text) in seen:
            faults.append("duplicate")
        else:
            faults.append("" if re.findall(f"[^{SPACE}]", text)[-1] in ".!?" else "truncated")
        seen.add((role, text))
    heap, done, limit = [(0, "", 0, "", ())], set(), 4 * len(rows)
    while heap:
        cost, audit, at, roles, lines = heapq.heappop(heap)
        if at == len(rows) and re.fullmatch("(s?(ua)+)?", roles):
            return cost, audit, lines, faults
        state = (at, roles[-1:], len(roles) > 0)
        if state in done:
            continue
        done.add(state)

        def put(extra, edit, step, role=None, text=None, at=at, cost=cost, audit=audit, roles=roles, lines=lines):
            after = roles if role is None else roles + role[:1]
            if cost + extra <= limit and re.fullmatch("(s?(ua)*u?)?", after) and (role is None or role[:1] in tuple("sua")):
                heapq.heappush(heap, (cost + extra, audit + edit, at + step, after, lines if role is None else (*lines, f"{role}:{text}")))

        for role in ("user", "assistant"):
            put(3, "I", 0, role, "")
        if at < len(rows):
            role, text = rows[at]
            put(4, "D", 1)
            if faults[at] not in ("blank", "duplicate"):
                cut = 3 * (faults[at] == "truncated")
                put(cut, "K", 1, role, text)
                for other in ("user", "assistant"):
                    put(3 + cut, "R", 1, other, text)


def expected(rows):
    """What is told of one conversation, its rows (turn, role, text) in order."""
    cost, audit, lines, faults = cheapest([r[1:] for r in rows])
    known = [r[0] for r in rows if r[0] is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    count = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    return (gaps, *count, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def ordered(rows):
    same = lambda r: hashlib.md5(f"{len(r[1])}:{r[1]}{r[2]}".encode()).hexdigest()
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], same(r)))


def conversations(rng, count, longest):
    out = {}
    for conv in range(count):
        rows = []
        for turn in range(rng.randint(1, longest)):
            role = rng.choice(["system", "user", "user", "assistant", "assistant", "tool", "", "uncle"])
            text = rng.choice(["Yes.", "No!", "cut", " \t", "", "why? \n", f"word {turn}.", "é…"])
            rows.append((rng.choice([None, turn, turn, turn, turn + 1]), role, text))
        out[conv] = ordered(rows)
    return out


def told(table):
    return {r.conv_id: tuple(r)[1:] for r in table.collect()}


@pytest.mark.parametrize("segment", [1024, 3])
def test_equal_to_a_search_over_all_edits(rows, segment):
    rng = random.Random(segment)
    data = conversations(rng, 120, 9)
    flat = [(conv, *r, "x", 1, None) for conv, part in data.items() for r in part]
    rng.shuffle(flat)
    out = told(T.repair(rows(flat, SCHEMA), segment=segment))
    assert out == {conv: expected(part) for conv, part in data.items()}


def test_rules_do_not_change_matrices():
    rng = random.Random(2)
    rules = [(b"\x02\x04", b"\x09"), (b"\x09\x09", b"\x0a"), (b"\x00\x0a", b"\x0b"), (b"\x08\x08", b"\x0c")]
    table, plain = T.matrices(rules), T.matrices([])
    flat = lambda m: [[e and (e[0], e[1].text()) for e in row] for row in m]
    for _ in range(60):
        symbols = bytes(rng.choice([2, 4, 2, 4, 0, 8, 8, 5, 7]) for _ in range(rng.randint(1, 40)))
        assert len(T.compress(symbols, rules)) <= len(symbols)
        assert flat(T.solve(T.compress(symbols, rules), table)) == flat(T.solve(symbols, plain))


def test_ropes_compare_as_text():
    rng = random.Random(4)
    for _ in range(300):
        parts = [bytes(rng.choices(b"DIK", k=rng.randint(0, 5))) for _ in range(6)]
        other = parts[:4] + [bytes(rng.choices(b"DIK", k=3))] if rng.random() < 0.6 else [b"".join(parts)]
        ropes = []
        for pieces in (parts, other):
            rope = T.Rope.of(pieces[0])
            for p in pieces[1:]:
                rope = rope + T.Rope.of(p)
            ropes.append(rope)
        a, b = b"".join(parts), b"".join(other)
        assert [r.text() for r in ropes] == [a, b]
        assert (ropes[0].compare(ropes[1]) > 0) - (ropes[0].compare(ropes[1]) < 0) == (a > b) - (a < b)


def test_a_long_conversation_over_many_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        roles = ["user", "assistant"]
        data = [(1, t, roles[t % 2], f"said {t}." + "x" * (t == 9) * 300_000) for t in range(20_000) if t % 5000 != 77]
        out = T.repair(spark.createDataFrame(data, "conv_id long, turn long, role string, text string")).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    (row,) = out
    assert (row.gaps, row.blank, row.duplicate, row.illegal) == (4, 0, 0, 4)
    assert row.truncated == 1
    assert row.cost == 4 * 3 + 3 and row.audit.count("I") == 4 and len(row.audit) == 20_000


def test_query_on_odd_tables(spark, rows, tmp_path):
    rng = random.Random(9)
    data = [(conv, t, r, x, "k", 2, "m") for conv, part in conversations(rng, 60, 6).items() for t, r, x in part]
    data += [(None, 1, "user", None, None, None, None), (None, None, None, "a.", None, None, None)] + data[:5]
    rows(data, SCHEMA).write.parquet(str(tmp_path / "conversations.parquet"))
    out = told(queries.op12_turn_repair(spark, str(tmp_path)))
    left = {}
    for conv, turn, role, text, *_ in data:
        role, text = (" " if x is None else x for x in (role, text))
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        draw = zlib.crc32(key.encode()) % 20
        left.setdefault(conv, [])
        if draw:
            text = "" if draw == 1 else re.sub("[.!?]", "", text) if draw == 2 else text
            left[conv] += [(turn, "user" if draw == 4 else role, text)] * (2 if draw == 3 else 1)
    empty = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert out == {conv: expected(ordered(part)) if part else empty for conv, part in left.items()}


def test_empty_table_and_repaired_turns(rows):
    assert T.repair(rows([], SCHEMA)).collect() == []
    data = [(5, 1, "system", "Be kind.", "", 0, ""), (5, 2, "assistant", "Hello.", "", 0, ""), (5, 3, "tool", "So?", "", 0, "")]
    out = [tuple(r) for r in T.repaired_turns(rows(data, SCHEMA)).orderBy("place").collect()]
    cost, audit, lines, _ = cheapest([(r[2], r[3]) for r in data])
    assert [f"{r[3]}:{r[4]}" for r in out] == list(lines)
    assert "".join(r[2] for r in out) == audit.replace("D", "")
