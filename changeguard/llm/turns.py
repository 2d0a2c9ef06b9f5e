"""Repair of conversations: the cheapest edits that make turns alternate after an optional system turn.

A conversation is a sequence of symbols, one per row: the class of its role
and its fault.  Sequences are cut into segments, and every distinct segment is
solved once.  Re-Pair rules, learned from pair counts over all distinct
segments, shorten them; each rule has one min-plus transfer matrix over the
states of the accepted roles, built bottom-up from those of its two symbols.
An entry holds the least cost and a rope of the edits, ropes share their
parts.  Segments of a conversation are then chained by their costs alone, so a
conversation of any length is solved in parallel.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from changeguard.session import written

SPACE = " \t\n\x0b\x0c\r"
ENDS = ".!?"
KEEP, DELETE, REROLE, INSERT, CUT = 0, 4, 3, 3, 3  # costs; CUT is for a truncated row that stays

# States: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
FINAL = (START, ASSISTANT)
AFTER = {("s", START): SYSTEM, ("u", START): USER, ("u", SYSTEM): USER, ("u", ASSISTANT): USER, ("a", USER): ASSISTANT}
NEXT = {START: ("user", USER), SYSTEM: ("user", USER), ASSISTANT: ("user", USER), USER: ("assistant", ASSISTANT)}

# Symbols: twice the class of the role, one more if truncated; GONE has to be deleted.
CLASSES = "sua"
GONE = 8
SEGMENT = 1024
ROUNDS, ROUND_RULES = 4, 24  # of grammar learning; symbols stay below 256


class Rope:
    """Edits as a tree of shared parts, ordered as text."""

    __slots__ = ("size", "digest", "parts")
    BASE, FIELD = 1_000_003, (1 << 61) - 1

    def __init__(self, parts, size: int, digest: int):
        self.parts, self.size, self.digest = parts, size, digest

    @classmethod
    def of(cls, text: bytes) -> Rope:
        return cls(text, len(text), functools.reduce(lambda d, b: (d * cls.BASE + b) % cls.FIELD, text, 0))

    def __add__(self, other: Rope) -> Rope:
        if not self.size or not other.size:
            return other if other.size else self
        digest = (self.digest * pow(self.BASE, other.size, self.FIELD) + other.digest) % self.FIELD
        return Rope((self, other), self.size + other.size, digest)

    def text(self) -> bytes:
        out, stack = [], [self]
        while stack:
            top = stack.pop()
            if isinstance(top.parts, bytes):
                out.append(top.parts)
            else:
                stack += top.parts[::-1]
        return b"".join(out)

    def compare(self, other: Rope) -> int:
        """Below, at or above 0 as this text is less, equal or greater; equal parts are passed over whole."""
        one, two = [self], [other]
        while one and two:
            a, b = one.pop(), two.pop()
            if a is b or (a.size == b.size and a.digest == b.digest):
                continue
            if not isinstance(a.parts, bytes) and (a.size >= b.size or isinstance(b.parts, bytes)):
                one += a.parts[::-1]
                two.append(b)
            elif not isinstance(b.parts, bytes):
                two += b.parts[::-1]
                one.append(a)
            else:
                size = min(a.size, b.size)
                x, y = a.parts[:size], b.parts[:size]
                if x != y:
                    return -1 if x < y else 1
                one += [Rope.of(a.parts[size:])] if a.size > size else []
                two += [Rope.of(b.parts[size:])] if b.size > size else []
        return bool(one) - bool(two)


Entry = tuple[int, Rope] | None
Matrix = list[list[Entry]]


def _better(one: Entry, two: Entry) -> Entry:
    if one is None or two is None:
        return two if one is None else one
    if one[0] != two[0]:
        return one if one[0] < two[0] else two
    return one if one[1].compare(two[1]) <= 0 else two


def product(one: Matrix, two: Matrix) -> Matrix:
    """Min-plus: the cheapest way through ``one`` and then ``two``, ties to the least text."""
    out = [[None] * STATES for _ in range(STATES)]
    for i, j in itertools.product(range(STATES), repeat=2):
        through = [(a[0] + b[j][0], a[1], b[j][1]) for a, b in zip(one[i], two) if a is not None and b[j] is not None]
        if through:
            least = min(cost for cost, _, _ in through)
            out[i][j] = functools.reduce(_better, ((c, x + y) for c, x, y in through if c == least))
    return out


def _inserts() -> Matrix:
    """Turns put in from each state until the other is first reached."""
    out = [[None] * STATES for _ in range(STATES)]
    for i in range(STATES):
        at, count = i, 0
        while out[i][at] is None:
            out[i][at] = (INSERT * count, Rope.of(b"I" * count))
            at, count = NEXT[at][1], count + 1
    return out


INSERTS = _inserts()


def terminal(symbol: int) -> Matrix:
    """Turns put in before a row, then its own edit; the edits of a row always end with its own."""
    edit = [[None] * STATES for _ in range(STATES)]
    for i in range(STATES):
        ways = [(i, DELETE, b"D")]
        if symbol != GONE:
            cut = CUT * (symbol % 2)
            ways.append((NEXT[i][1], REROLE + cut, b"R"))
            kept = AFTER.get(((CLASSES + "-")[symbol // 2], i))
            if kept is not None:
                ways.append((kept, KEEP + cut, b"K"))
        for j, cost, text in ways:
            edit[i][j] = _better(edit[i][j], (cost, Rope.of(text)))
    return product(INSERTS, edit)


Rules = list[tuple[bytes, bytes]]


def compress(symbols: bytes, rules: Rules) -> bytes:
    """``symbols`` with every pair that has a rule replaced by the rule's symbol, in the rules' order."""
    for pair, symbol in rules:
        symbols = symbols.replace(pair, symbol)
    return symbols


def matrices(rules: Rules) -> list[Matrix]:
    """One transfer matrix per symbol, those of rules from their two parts."""
    out = [terminal(s) for s in range(GONE + 1)]
    for pair, _ in rules:
        out.append(product(out[pair[0]], out[pair[1]]))
    return out


def solve(symbols: bytes, table: list[Matrix]) -> Matrix:
    """The transfer matrix of a sequence of one symbol or more."""
    level = [table[s] for s in symbols]
    while len(level) > 1:
        level = [product(*level[i : i + 2]) if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
    return level[0]


def _pair_counts(batches: Iterator[pa.RecordBatch], rules: Rules) -> Iterator[pa.RecordBatch]:
    counts = Counter()
    for batch in batches:
        for symbols in batch.column(0).to_pylist():
            short = compress(symbols, rules)
            counts.update(p for p in zip(short, short[1:]) if p[0] != p[1])
            for s in set(short):
                counts[s, s] += short.count(bytes((s, s)))
    found = [(a, b, n) for (a, b), n in counts.items() if n]
    columns = list(zip(*found)) or [()] * 3
    yield pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, (pa.int32(), pa.int32(), pa.int64()))], names=["a", "b", "n"]
    )


def grammar(distinct: DataFrame, rounds: int = ROUNDS, round_rules: int = ROUND_RULES) -> Rules:
    """Re-Pair rules for the sequences of ``distinct`` (symbols), the most frequent pairs of each round.

    Pairs are counted over all sequences; a count has at most 256 x 256 rows
    at any size.  Rules shorten the work and change no result.
    """
    rules: Rules = []
    for _ in range(rounds):
        counts = distinct.mapInArrow(lambda batches, rules=tuple(rules): _pair_counts(batches, rules), "a int, b int, n long")
        best = counts.groupBy("a", "b").agg(F.sum("n").alias("n")).filter("n > 1").orderBy(F.desc("n"), "a", "b")
        found = best.limit(round_rules).collect()
        rules += [(bytes((r.a, r.b)), bytes((GONE + 1 + len(rules) + i,))) for i, r in enumerate(found)]
        if not found:
            break
    return rules


def _solved(batches: Iterator[pa.RecordBatch], rules: Rules) -> Iterator[pa.RecordBatch]:
    """Per sequence and (state before, state after): cost, the text's place among those from the same state, text."""
    table = matrices(rules)
    order = functools.cmp_to_key(lambda x, y: x[0].compare(y[0]))
    for batch in batches:
        costs, places, texts = [], [], []
        for symbols in batch.column(0).to_pylist():
            whole = solve(compress(symbols, rules), table)
            costs.append([None if e is None else e[0] for row in whole for e in row])
            place = [None] * STATES**2
            for i, row in enumerate(whole):
                ways = sorted(((e[1], j) for j, e in enumerate(row) if e is not None), key=order)
                for n, (_, j) in enumerate(ways):
                    place[STATES * i + j] = n
            places.append(place)
            texts.append([None if e is None else e[1].text().decode() for row in whole for e in row])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(costs, pa.list_(pa.int64())), pa.array(places, pa.list_(pa.int32())), pa.array(texts, pa.list_(pa.string()))],
            names=["symbols", "costs", "places", "texts"],
        )


def _narrow(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with the columns that order rows and name their faults; nulls as one space."""
    rows = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), *(F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")))
    same = F.md5(F.encode(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), "utf-8"))
    end = F.rtrim("text", F.lit(SPACE))
    initial = F.substring("role", 1, 1)
    kind = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    truncated = ~F.right(end, F.lit(1)).isin(*ENDS)
    symbol = F.when(end == "", GONE).otherwise(2 * kind + truncated.cast("int"))
    return rows.select("*", same.alias("same"), initial.alias("initial"), symbol.alias("symbol"))


def _at(turn: Column) -> Column:
    return F.struct(turn.isNotNull().alias("known"), turn.alias("turn"))


SEGMENT_COLUMNS = (
    "part int, no int, symbols binary, first string, last string, first_turn long, last_turn long, turns long, "
    "blank long, duplicate long, truncated long, illegal long"
)
LEGAL = {"su", "ua", "au"}


def _segments(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Rows in order to segments: the symbols of up to ``size`` rows of a conversation and what can be counted in them."""
    part, kind, no = TaskContext.get().partitionId(), None, itertools.count()
    kinds = [pa.int32(), pa.int32(), pa.binary(), pa.string(), pa.string(), *[pa.int64()] * 7]
    names = [c.split()[0] for c in SEGMENT_COLUMNS.split(", ")]
    done, open_, before = [], None, (None, None, None)

    def close() -> None:
        if open_ is not None:
            conv, symbols, *rest = open_
            done.append((conv, part, next(no), bytes(symbols), *rest))

    def batch_of() -> pa.RecordBatch:
        columns = list(zip(*done)) or [()] * (len(names) + 1)
        done.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, [kind, *kinds])], names=["conv_id", *names])

    for batch in batches:
        kind = batch.schema.field("conv_id").type
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "turn", "same", "initial", "symbol", "earlier")]
        for conv, turn, same, initial, symbol, earlier in zip(*columns):
            repeated = earlier or before == (conv, turn, same)
            before = (conv, turn, same)
            if open_ is None or open_[0] != conv or len(open_[1]) >= size:
                close()
                open_ = [conv, bytearray(), initial, initial, None, None, 0, 0, 0, 0, 0]
                illegal = 0
            else:
                illegal = open_[3] + initial not in LEGAL
            open_[1].append(GONE if repeated else symbol)
            open_[3] = initial
            if turn is not None:
                open_[4] = turn if open_[4] is None else open_[4]
                open_[6] += turn != open_[5]
                open_[5] = turn
            if symbol == GONE:
                open_[7] += 1
            elif repeated:
                open_[8] += 1
            else:
                open_[9] += symbol % 2
            open_[10] += illegal
        yield batch_of()
    close()
    if done:
        yield batch_of()


TAIL = [min((INSERTS[s][f] for f in FINAL if INSERTS[s][f] is not None), key=lambda e: e[0]) for s in range(STATES)]
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments of whole conversations, in order, to the way that each takes: its slot, and on the last one the totals.

    Costs to the end are found backwards; then, from the start, each segment
    takes the least text among the ways that stay cheapest.  Texts of one
    segment from one state are never beginnings of each other.
    """
    kind = None
    columns = ("conv_id", "symbols", "first", "last", "first_turn", "last_turn", "turns", "blank", "duplicate", "truncated", "illegal", "costs", "places")

    def chain(conv, rows: list[dict]) -> list[tuple]:
        rest = [[e[0] for e in TAIL]]
        for r in reversed(rows):
            costs = r["costs"]
            rest.append([
                min((costs[STATES * i + j] + rest[-1][j] for j in range(STATES) if costs[STATES * i + j] is not None), default=1 << 60)
                for i in range(STATES)
            ])
        rest.reverse()
        state, out, total = START, [], dict.fromkeys(COUNTS, 0)
        total["cost"] = rest[0][START]
        last, first_turn, last_turn, turns = None, None, None, 0
        for k, r in enumerate(rows):
            slots = [(STATES * state + j, j) for j in range(STATES) if r["costs"][STATES * state + j] is not None]
            slots = [(r["places"][s], s, j) for s, j in slots if r["costs"][s] + rest[k + 1][j] == rest[k][state]]
            _, slot, state = min(slots)
            out.append([conv, k, r["symbols"], slot, "", *[0] * len(COUNTS)])
            for c in ("blank", "duplicate", "truncated", "illegal"):
                total[c] += r[c]
            total["illegal"] += last is not None and last + r["first"] not in LEGAL
            last = r["last"]
            if r["turns"]:
                turns += r["turns"] - (r["first_turn"] == last_turn)
                first_turn = r["first_turn"] if first_turn is None else first_turn
                last_turn = r["last_turn"]
        if turns:
            total["gaps"] = last_turn - first_turn + 1 - turns
        out[-1][4:] = [TAIL[state][1].text().decode(), *(total[c] for c in COUNTS)]
        return out

    def batch_of(rows: list) -> pa.RecordBatch:
        found = list(zip(*rows)) or [()] * (5 + len(COUNTS))
        kinds = [kind, pa.int64(), pa.binary(), pa.int32(), pa.string(), *[pa.int64()] * len(COUNTS)]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(found, kinds)], names=["conv_id", "at", "symbols", "slot", "tail", *COUNTS])

    held, conv = [], None
    for batch in batches:
        kind, done = batch.schema.field("conv_id").type, []
        for row in batch.select(columns).to_pylist():
            if held and row["conv_id"] != conv:
                done += chain(conv, held)
                held = []
            conv = row["conv_id"]
            held.append(row)
        yield batch_of(done)
    if held:
        yield batch_of(chain(conv, held))


def audits(rows: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """One row per conversation of ``rows``: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit."""
    narrow = _narrow(rows).select("conv_id", "turn", "role", "same", "initial", "symbol")
    firsts = narrow.groupBy("conv_id", "same").agg(F.min(_at(F.col("turn"))).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    firsts = firsts.select(F.col("conv_id").alias("of"), F.col("same").alias("as"), "first")
    met = narrow["conv_id"].eqNullSafe(firsts["of"]) & (narrow["same"] == firsts["as"])
    earlier = F.coalesce(F.col("first") < _at(F.col("turn")), F.lit(False))
    order = ("conv_id", "turn", "role", "same")
    ordered = narrow.join(firsts, met, "left").select(*order, "initial", "symbol", earlier.alias("earlier"))
    ordered = ordered.repartitionByRange(*order).sortWithinPartitions(*order)
    conv = f"conv_id {rows.schema['conv_id'].dataType.simpleString()}"
    cut = written(ordered.mapInArrow(lambda batches: _segments(batches, segment), f"{conv}, {SEGMENT_COLUMNS}"), "segments")
    distinct = written(cut.select("symbols").distinct(), "distinct_segments")
    rules = grammar(distinct)
    solved = written(
        distinct.mapInArrow(lambda batches: _solved(batches, rules), "symbols binary, costs array<long>, places array<int>, texts array<string>"),
        "solved_segments",
    )
    known = cut.join(solved.drop("texts"), "symbols").repartition("conv_id").sortWithinPartitions("conv_id", "part", "no")
    counts = ", ".join(f"{c} long" for c in COUNTS)
    chained = known.mapInArrow(_chained, f"{conv}, at long, symbols binary, slot int, tail string, {counts}")
    pieces = chained.join(solved.select("symbols", "texts"), "symbols")
    piece = F.struct("at", F.concat(F.element_at("texts", F.col("slot") + 1), "tail").alias("text"))
    whole = pieces.groupBy("conv_id").agg(*(F.sum(c).alias(c) for c in COUNTS), F.array_sort(F.collect_list(piece)).alias("pieces"))
    return whole.select("conv_id", *COUNTS, F.array_join(F.transform("pieces", lambda p: p["text"]), "").alias("audit"))


class _Edits:
    """Follows an audit over the rows of a conversation."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, START

    def _put_in(self) -> Iterator[tuple[str, str, str]]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            role, self.state = NEXT[self.state]
            self.at += 1
            yield "I", role, ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        """The repaired rows (edit, role, text) up to this row and with it, if it stays."""
        yield from self._put_in()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.state = AFTER[role[:1], self.state]
            yield edit, role, text
        elif edit == "R":
            role, self.state = NEXT[self.state]
            yield edit, role, text

    def end(self) -> Iterator[tuple[str, str, str]]:
        return self._put_in()


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows in order, each conversation begun by the one with its audit: ("new", row) and ("turn", repaired row), batch ends as None."""
    edits = None
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("audit", "role", "text")]
        for i, (audit, role, text) in enumerate(zip(*columns)):
            if audit is not None:
                if edits is not None:
                    yield from (("turn", t) for t in edits.end())
                edits = _Edits(audit)
                yield "new", {c: batch.column(c)[i] for c in ("conv_id", *COUNTS, "audit")}
            else:
                yield from (("turn", t) for t in edits.row(role, text))
        yield None
    if edits is not None:
        yield from (("turn", t) for t in edits.end())


def _hashed(batches: Iterator[pa.RecordBatch], conv: pa.DataType) -> Iterator[pa.RecordBatch]:
    names, done, now, digest = ["conv_id", *COUNTS, "audit", "repaired_sha256"], [], None, None
    kinds = [conv, *[pa.int64()] * len(COUNTS), pa.string(), pa.string()]

    def batch_of() -> pa.RecordBatch:
        columns = list(zip(*done)) or [()] * len(names)
        done.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    for event in _walk(batches):
        if event is None:
            yield batch_of()
        elif event[0] == "new":
            if now is not None:
                done.append((*now, digest.hexdigest()))
            now, digest, glue = [event[1][c].as_py() for c in names[:-1]], hashlib.sha256(), b""
        else:
            _, role, text = event[1]
            digest.update(glue + f"{role}:{text}".encode())
            glue = b"\n"
    if now is not None:
        done.append((*now, digest.hexdigest()))
        yield batch_of()


def _listed(batches: Iterator[pa.RecordBatch], conv: pa.DataType) -> Iterator[pa.RecordBatch]:
    names, kinds, done, now, place = ["conv_id", "place", "edit", "role", "text"], [conv, pa.int64(), *[pa.string()] * 3], [], None, 0
    for event in itertools.chain(_walk(batches), [None]):
        if event is None:
            columns = list(zip(*done)) or [()] * len(names)
            done.clear()
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)
        elif event[0] == "new":
            now, place = event[1]["conv_id"].as_py(), 0
        else:
            done.append((now, place, *event[1]))
            place += 1


def _followed(rows: DataFrame, answers: DataFrame) -> DataFrame:
    """Texts behind their conversation's audit, one conversation in one task, streamed in order."""
    texts = _narrow(rows).select("conv_id", "turn", "role", "same", "text")
    heads = answers.select("*", F.lit(0).alias("kind"))
    both = heads.unionByName(texts.withColumn("kind", F.lit(1)), allowMissingColumns=True)
    return both.repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "role", "same")


def _conv_type(rows: DataFrame) -> pa.DataType:
    return to_arrow_type(rows.schema["conv_id"].dataType)


def repair(rows: DataFrame, conversations: DataFrame | None = None, segment: int = SEGMENT) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    ``rows`` has conv_id, turn, role and text; other columns are not read.
    Rows are taken by turn, nulls first, ties by role and then by the digest of
    role and text, so repeated rows stand beside each other and all but the
    first are duplicates.  A null role or text is one space; null conv_ids are
    one conversation.  Long texts are never cut.  ``conversations`` (conv_id)
    names conversations that may have no rows, they get zeros and an empty
    audit; without it those of ``rows`` are given.  An empty table gives none.
    """
    found = audits(rows, segment)
    if conversations is not None:
        ids = conversations.select(F.col("conv_id").alias("id")).distinct()
        found = ids.join(found, F.col("id").eqNullSafe(F.col("conv_id")), "left").select(
            F.col("id").alias("conv_id"), *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in COUNTS), F.coalesce("audit", F.lit("")).alias("audit")
        )
    kind = _conv_type(rows)
    conv = f"conv_id {rows.schema['conv_id'].dataType.simpleString()}"
    counts = ", ".join(f"{c} long" for c in COUNTS)
    return _followed(rows, found).mapInArrow(lambda batches: _hashed(batches, kind), f"{conv}, {counts}, audit string, repaired_sha256 string")


def repaired_turns(rows: DataFrame) -> DataFrame:
    """The repaired conversations of ``rows``: conv_id, place, edit (K, R or I), role, text."""
    kind = _conv_type(rows)
    conv = f"conv_id {rows.schema['conv_id'].dataType.simpleString()}"
    return _followed(rows, audits(rows)).mapInArrow(lambda batches: _listed(batches, kind), f"{conv}, place long, edit string, role string, text string")
