"""Operator 12, conversation structure repair: grammar-compressed DP.

1. A conversation's rows, in order of turn, become a string of symbols: role class and fault of each row.  Equal
   rows of one turn are counted before anything is shuffled on, and the first place of a text in its conversation
   is an aggregate, so repeated rows do not gather in a task.
2. The ordered rows are cut into pieces of at most ``PIECE`` symbols over range partitions, so a long conversation
   is many pieces in many tasks.
3. Re-Pair over all pieces: each round counts adjacent pairs of symbols in Spark and gives the most frequent ones,
   no symbol twice, a rule.  The grammar has at most ``MOST_RULES`` rules; what it leaves stays as symbols.
4. Every rule has one min-plus matrix over the states of ``(s?(ua)+)?``: least cost and, as a rope of its parts'
   ropes, the ASCII-least audit of that cost.  Matrices are built bottom-up and shared by all conversations.
5. A piece is the product of its symbols' matrices; a conversation is the product of its pieces, from the start
   state to an accepting one.  Its audit is then replayed over its rows, which stream through in order.

The repaired text of one conversation is hashed by one task, row by row: SHA-256 is sequential.  Nothing but the
audit grows with the conversation there.

Cases: a null in any column is one space (a null role has an initial of no class, a null text is blank); null turns
come first; rows of one turn are ordered by the SHA-256 of role and text; equal rows are rows of their own; a null
conv_id is a conversation; a conversation without rows after damage has zeros and the hash of the empty string;
other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain, zip_longest

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinis.llm.common import never_null
from affinis.session import stage

# Fixed values of the contract: damage kinds of 20, costs of edits, the roles' initials and the legal neighbours.
DAMAGE_KINDS = 20
DROP, EMPTY, UNPOINT, REPEAT, AS_USER = range(5)
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
LEGAL = ("su", "ua", "au")
SPACE = " \t\n\x0b\x0c\r"

PIECE = 4096
MOST_RULES = 64
#: Matrices of whole pieces that a worker remembers.
MEMO = 20_000

Rope = str | tuple
Matrix = list[list[tuple[int, Rope] | None]]


def damage(conversations: DataFrame) -> DataFrame:
    """(conv, conv_id, turn, role, text, copies): the contract's damage; dropped rows are gone."""
    place = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"),
                     F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"),
                                F.coalesce("text", F.lit(" ")).alias("text"), (F.crc32(place) % DAMAGE_KINDS).alias("kind"))
    kind = F.col("kind")
    return rows.where(kind != DROP).select(
        never_null(F.col("conv_id")).alias("conv"), "conv_id", "turn",
        F.when(kind == AS_USER, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(kind == EMPTY, F.lit("")).when(kind == UNPOINT, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(kind == REPEAT, F.lit(2)).otherwise(F.lit(1)).cast("long").alias("copies"))


def row_key() -> F.Column:
    """Hash of role and text, by which rows of one turn are ordered and repeats are known."""
    return F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256))


def marked(rows: DataFrame) -> DataFrame:
    """(conv, turn, key, copies, initial, blank, again, truncated): one row per distinct row of a turn.

    ``again``: the same role and text stands at an earlier turn.  Of several copies all but the first are repeats.
    """
    ended = F.rtrim(F.col("text"), F.lit(SPACE))
    flat = rows.select("conv", "turn", row_key().alias("key"), "copies", F.substring("role", 1, 1).alias("initial"),
                       (ended == "").alias("blank"), (~F.right(ended, F.lit(1)).isin(".", "!", "?")).alias("truncated"))
    each = flat.groupBy("conv", "turn", "key").agg(F.sum("copies").alias("copies"), *[F.first(c).alias(c) for c in ("initial", "blank", "truncated")])
    each = stage(each, "rows_of_a_turn")
    at = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    firsts = each.groupBy("conv", "key").agg(F.min(at).alias("first"))
    return each.join(firsts, ["conv", "key"]).select(
        "conv", "turn", "key", "copies", "initial", "blank", "truncated", (at != F.col("first")).alias("again"))


def counts(rows: DataFrame) -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated) from ``marked`` rows."""
    n, zero = F.col("copies"), F.lit(0)
    faults = rows.groupBy("conv").agg(
        F.sum(F.when(F.col("blank"), n).otherwise(zero)).alias("blank"),
        F.sum(F.when(F.col("blank"), zero).when(F.col("again"), n).otherwise(n - 1)).alias("duplicate"),
        F.sum(F.when(F.col("truncated") & ~F.col("blank") & ~F.col("again"), 1).otherwise(zero)).alias("truncated"))
    turns = rows.where("turn IS NOT NULL").select("conv", F.col("turn").cast("long").alias("turn")).distinct()
    gaps = turns.groupBy("conv").agg((F.max("turn") - F.min("turn") + 1 - F.count(F.lit(1))).alias("gaps"))
    return faults.join(gaps, "conv", "left").withColumn("gaps", F.coalesce("gaps", zero))


def _symbol(initial: str, truncated: bool) -> str:
    role = initial if initial in ("s", "u", "a") else "o"
    return role.upper() if truncated else role


def pieces(rows: DataFrame, size: int = PIECE) -> DataFrame:
    """(conv, known, turn, key, part, symbols, first, last, illegal): ordered pieces of the conversations.

    (known, turn, key, part) of a piece's first row orders it.  Symbols: s, u, a, o by role, upper case where the
    text is truncated, x where the row must go.  ``illegal`` counts the neighbours inside the piece.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows_of():
            for b in batches:
                yield from zip(*(c.to_pylist() for c in b.columns), strict=True)

        def full():
            now: list | None = None
            for conv, known, turn, key, copies, initial, blank, truncated, again in rows_of():
                left = "x" if blank or again else _symbol(initial, truncated)
                part = 0
                while copies:
                    if now is None or now[0] != conv or now[9] >= size:
                        if now:
                            yield now
                        now = [conv, known, turn, key, part, [], initial, initial, 0, 0]
                        part += 1
                    else:
                        now[8] += now[7] + initial not in LEGAL
                    take = min(copies, size - now[9])
                    now[5].append(left + "x" * (take - 1))
                    now[8] += (take - 1) * (initial * 2 not in LEGAL)
                    now[7], now[9], left, copies = initial, now[9] + take, "x", copies - take
            if now:
                yield now

        out: list[list] = []
        for piece in chain(full(), [None]):
            if piece:
                out.append([*piece[:5], "".join(piece[5]), *piece[6:9]])
            if out and (piece is None or len(out) >= 2000):
                yield pa.RecordBatch.from_pydict(dict(zip(schema.names, zip(*out, strict=True), strict=True)), schema)
                out = []

    schema = pa.schema([("conv", pa.string()), ("known", pa.bool_()), ("turn", pa.int64()), ("key", pa.binary()), ("part", pa.int64()),
                        ("symbols", pa.string()), ("first", pa.string()), ("last", pa.string()), ("illegal", pa.int64())])
    order = rows.select("conv", F.col("turn").isNotNull().alias("known"), F.col("turn").cast("long").alias("turn"), "key", "copies",
                        "initial", "blank", "truncated", "again")
    order = order.repartitionByRange("conv", "known", "turn", "key").sortWithinPartitions("conv", "known", "turn", "key")
    return order.mapInArrow(run, "conv string, known boolean, turn long, key binary, part long, symbols string, "
                                 "first string, last string, illegal long")


# ---- grammar ------------------------------------------------------------------------------------------------------
def rule_symbol(i: int) -> str:
    return chr(0x100 + i)


def parsed(symbols: str, rules: list[str]) -> str:
    """``symbols`` with every rule's pair replaced, in the order of the rules."""
    for i, pair in enumerate(rules):
        symbols = symbols.replace(pair, rule_symbol(i))
    return symbols


def learn_rules(cut: DataFrame, most: int = MOST_RULES) -> list[str]:
    """Re-Pair over all pieces: the pairs that rules replace, oldest first.

    What comes to the driver is one count per pair of symbols, at most (9 + most) squared of them.
    """
    distinct = stage(cut.groupBy("symbols").agg(F.count(F.lit(1)).alias("n")), "distinct_pieces")
    rules: list[str] = []

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for b in batches:
            for s, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                s = parsed(s, rules)
                for pair, k in Counter(map(str.__add__, s, s[1:])).items():
                    found[pair] += n * (s.count(pair) if pair[0] == pair[1] else k)
        yield pa.RecordBatch.from_pydict({"pair": pa.array(found.keys(), pa.string()), "n": pa.array(found.values(), pa.int64())})

    while len(rules) < most:
        frequent = (distinct.select("symbols", "n").mapInArrow(count, "pair string, n long").groupBy("pair")
                    .agg(F.sum("n").alias("n")).where("n > 1").orderBy(F.desc("n"), "pair").collect())
        used: set[str] = set()
        for r in frequent:
            if used.isdisjoint(r.pair) and len(rules) < most:
                used.update(r.pair)
                rules.append(r.pair)
        if not used:
            break
    return rules


# ---- min-plus matrices --------------------------------------------------------------------------------------------
def leaves(rope: Rope) -> Iterator[str]:
    stack = [rope]
    while stack:
        r = stack.pop()
        if isinstance(r, str):
            yield r
        else:
            stack += (r[1], r[0])


def flat(rope: Rope) -> str:
    return "".join(leaves(rope))


def _before(a: Rope, b: Rope) -> bool:
    """``a`` is ASCII-less than ``b``."""
    return next((x < y for x, y in zip_longest(chain.from_iterable(leaves(a)), chain.from_iterable(leaves(b)), fillvalue="") if x != y), False)


def _least(cells: Iterator[tuple[int, Rope]]) -> tuple[int, Rope] | None:
    best = None
    for c in cells:
        if best is None or c[0] < best[0] or c[0] == best[0] and _before(c[1], best[1]):
            best = c
    return best


def times(a: Matrix, b: Matrix) -> Matrix:
    """Min-plus product; equal costs go to the ASCII-least audit."""
    return [[_least((x[0] + y[0], (x[1], y[1]) if x[1] and y[1] else x[1] or y[1])
                    for x, y in ((row[k], b[k][j]) for k in range(4)) if x and y) for j in range(4)] for row in a]


# States: nothing yet, after s, after u, after a (which accepts, as does nothing).
def _matrix(cells: dict[tuple[int, int], tuple[int, str]]) -> Matrix:
    return [[cells.get((i, j)) for j in range(4)] for i in range(4)]


INSERTS = _matrix({(i, i): (0, "") for i in range(4)}
                  | {(i, j): (INSERT, "I") for i, j in ((0, 2), (1, 2), (2, 3), (3, 2))}
                  | {(i, 3): (2 * INSERT, "II") for i in (0, 1)})
TO_USER, TO_ASSISTANT = ((0, 2), (1, 2), (3, 2)), ((2, 3),)


def terminal(symbol: str) -> Matrix:
    """Inserts, then one row with this symbol kept, reroled or deleted."""
    cells = {(i, i): (DELETE, "D") for i in range(4)}
    if symbol != "x":
        extra = TRUNCATED if symbol.isupper() else 0
        cells |= {move: (REROLE + extra, "R") for move in TO_USER + TO_ASSISTANT}
        cells |= {move: (KEEP + extra, "K") for move in {"s": ((0, 1),), "u": TO_USER, "a": TO_ASSISTANT}.get(symbol.lower(), ())}
    return times(INSERTS, _matrix(cells))


class Matrices(dict):
    """Symbol -> matrix; a rule's is the product of its two symbols', made once."""

    def __init__(self, rules: list[str]):
        super().__init__((s, terminal(s)) for s in "suaoSUAOx")
        for i, (a, b) in enumerate(rules):
            self[rule_symbol(i)] = times(self[a], self[b])

    def product(self, symbols: str) -> Matrix:
        out = _matrix({(i, i): (0, "") for i in range(4)})
        for s in symbols:
            out = times(out, self[s])
        return out


def evaluated(cut: DataFrame, rules: list[str]) -> DataFrame:
    """``cut`` with its matrix: ``costs`` and ``audits`` of 16 cells (null: no way) instead of symbols."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, memo = Matrices(rules), {}
        for b in batches:
            costs, audits = [], []
            for s in b.column("symbols").to_pylist():
                cells = memo.get(s)
                if cells is None:
                    if len(memo) >= MEMO:
                        memo.clear()
                    cells = memo[s] = [c and (c[0], flat(c[1])) for row in of.product(parsed(s, rules)) for c in row]
                costs.append([c and c[0] for c in cells])
                audits.append([c and c[1] for c in cells])
            kept = [n for n in b.schema.names if n != "symbols"]
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in kept), pa.array(costs, pa.list_(pa.int64())), pa.array(audits, pa.list_(pa.string()))],
                                             names=[*kept, "costs", "audits"])

    return cut.mapInArrow(run, "conv string, known boolean, turn long, key binary, part long, first string, last string, "
                               "illegal long, costs array<long>, audits array<string>")


def audits(pieces_of: DataFrame) -> DataFrame:
    """(conv, illegal, cost, audit) from evaluated pieces, taken in order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(conv, illegal, line):
            cost, rope = _least(c for c in (times([line], INSERTS)[0][i] for i in (0, 3)) if c)
            return conv, illegal, cost, flat(rope)

        out, now, last, illegal, line = [], None, "", 0, []
        for b in batches:
            for conv, first, end, bad, costs, texts in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if conv != now:
                    if now is not None:
                        out.append(done(now, illegal, line))
                    now, illegal, line = conv, 0, [(0, ""), None, None, None]
                else:
                    illegal += last + first not in LEGAL
                cells = [c if c is None else (c, t) for c, t in zip(costs, texts, strict=True)]
                line = times([line], [cells[i:i + 4] for i in range(0, 16, 4)])[0]
                illegal, last = illegal + bad, end
            if len(out) >= 2000:
                yield batch(out)
                out = []
        if now is not None:
            out.append(done(now, illegal, line))
            yield batch(out)

    def batch(out):
        return pa.RecordBatch.from_pydict(dict(zip(("conv", "illegal", "cost", "audit"), zip(*out, strict=True), strict=True)), schema)

    schema = pa.schema([("conv", pa.string()), ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string())])
    ordered = pieces_of.repartition("conv").sortWithinPartitions("conv", "known", "turn", "key", "part")
    return ordered.select("conv", "first", "last", "illegal", "costs", "audits").mapInArrow(
        run, "conv string, illegal long, cost long, audit string")


# ---- replay -------------------------------------------------------------------------------------------------------
def _replayed(rows: Iterator[tuple]) -> Iterator[tuple]:
    """(head, role, text) of each row that stays or is inserted, and (head, None, None) after each conversation."""
    def ends():
        nonlocal state
        for op in ops:      # the rows are used up, so only inserts are left
            state = 3 if state == 2 else 2
            yield head, "assistant" if state == 3 else "user", ""
        yield head, None, None

    head, ops, state = None, iter(()), 0
    for is_row, *fields in rows:
        if not is_row:
            if head is not None:
                yield from ends()
            head, ops, state = fields[:-3], iter(fields[-4] or ""), 0
            continue
        role, text, copies = fields[-3:]
        for _ in range(copies):
            op = next(ops)
            while op == "I":
                state = 3 if state == 2 else 2
                yield head, "assistant" if state == 3 else "user", ""
                op = next(ops)
            if op == "R":
                state = 3 if state == 2 else 2
                yield head, "assistant" if state == 3 else "user", text
            elif op == "K":
                state = {"s": 1, "u": 2, "a": 3}[role[0]]
                yield head, role, text
    if head is not None:
        yield from ends()


def repair_plan(conversations: DataFrame, damaged: DataFrame, most_rules: int = MOST_RULES, piece: int = PIECE) -> DataFrame:
    """(conv, conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) of every original conversation."""
    rows = stage(marked(damaged), "marked_rows")
    cut = stage(pieces(rows, piece), "pieces")
    solved = audits(stage(evaluated(cut, learn_rules(cut, most_rules)), "piece_matrices"))
    every = conversations.select("conv_id").distinct().select(never_null(F.col("conv_id")).alias("conv"), "conv_id")
    known = every.join(counts(rows), "conv", "left").join(solved, "conv", "left")
    zero = F.lit(0).cast("long")
    return known.select("conv", "conv_id", *[F.coalesce(c, zero).cast("long").alias(c) for c in
                                             ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                        F.coalesce("audit", F.lit("")).alias("audit"))


def _in_order(plan: DataFrame, damaged: DataFrame) -> DataFrame:
    """Plan rows, each followed by its conversation's rows in order; one conversation is in one partition."""
    rows = damaged.select("conv", "turn", row_key().alias("key"), "role", "text", "copies", F.lit(True).alias("is_row"))
    both = plan.withColumn("is_row", F.lit(False)).unionByName(rows, allowMissingColumns=True)
    known = F.col("turn").isNotNull()
    both = both.repartition("conv").sortWithinPartitions("conv", "is_row", known, "turn", "key")
    return both.select("is_row", "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "role", "text", "copies")


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(c.to_pylist() for c in b.columns), strict=True)


def repaired_rows(conversations: DataFrame, damaged: DataFrame | None = None, **limits) -> DataFrame:
    """(conv_id, place, role, text): the repaired conversations."""
    damaged = damage(conversations) if damaged is None else damaged
    plan = repair_plan(conversations, damaged, **limits)
    id_type = conversations.schema["conv_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, place, id_arrow = [], 0, None
        batches = iter(batches)
        for b in batches:
            id_arrow = b.schema.field("conv_id").type
            batches = chain([b], batches)
            break
        for head, role, text in _replayed(_stream(batches)):
            if role is None:
                place = 0
                continue
            out.append((head[0], place, role, text))
            place += 1
            if len(out) >= 1000:
                yield made(out, id_arrow)
                out = []
        if out:
            yield made(out, id_arrow)

    def made(out, id_arrow):
        schema = pa.schema([("conv_id", id_arrow), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string())])
        return pa.RecordBatch.from_pydict(dict(zip(schema.names, zip(*out, strict=True), strict=True)), schema)

    return _in_order(plan, damaged).mapInArrow(run, f"conv_id {id_type.simpleString()}, place long, role string, text string")


def repair_report(conversations: DataFrame, damaged: DataFrame | None = None, **limits) -> DataFrame:
    """One row per original conversation: counts of faults, cost, audit and the hash of the repaired text."""
    damaged = damage(conversations) if damaged is None else damaged
    plan = repair_plan(conversations, damaged, **limits)
    id_type = conversations.schema["conv_id"].dataType
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, sha, empty = [], hashlib.sha256(), True
        for head, role, text in _replayed(_stream(batches)):
            if role is None:
                out.append((*head, sha.hexdigest()))
                sha, empty = hashlib.sha256(), True
                if len(out) >= 2000:
                    yield made(out)
                    out = []
                continue
            sha.update((("" if empty else "\n") + role + ":" + text).encode())
            empty = False
        if out:
            yield made(out)

    def made(out):
        return pa.RecordBatch.from_pydict(dict(zip(names, zip(*out, strict=True), strict=True)))

    return _in_order(plan, damaged).mapInArrow(
        run, f"conv_id {id_type.simpleString()}, gaps long, blank long, duplicate long, truncated long, illegal long, "
             "cost long, audit string, repaired_sha256 string")
