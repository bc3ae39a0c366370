import hashlib
import random
import re
import zlib
from itertools import product

from affinis.llm import conversations as C

SCHEMA = "conv_id long, turn long, role string, text string"
ROLES = ("system", "user", "assistant", "tool", None, "", "user", "assistant")
TEXTS = ("Yes.", "No!", "cut off", "", " \n", None, "Again?", "one more", "Fine. \t")


def rows_after_damage(rows):
    out = {}
    for conv, turn, role, text in rows:
        out.setdefault(conv, [])
        s = lambda v: " " if v is None else str(v)
        kind = zlib.crc32(f"{s(conv)}:{s(turn)}".encode()) % 20
        role, text = s(role), s(text)
        if kind == 0:
            continue
        row = (turn, "user" if kind == 4 else role, "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text)
        out[conv] += [row] * (2 if kind == 3 else 1)
    key = lambda r: (r[0] is not None, r[0] or 0, hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest())
    return {c: sorted(r, key=key) for c, r in out.items()}


def brute(rows):
    """All audits by breadth over (state, row) with whole strings: the least (cost, audit)."""
    white = "\x20\x09\x0a\x0b\x0c\x0d"
    out = []
    for conv, seq in rows_after_damage(rows).items():
        faults, seen, kinds = [0, 0, 0], set(), []
        for _, role, text in seq:
            body = text.strip(white)
            f = 0 if not body else 1 if (role, text) in seen else 2 if body[-1] not in ".!?" else 3
            seen.add((role, text))
            kinds.append(f)
            if f < 3:
                faults[f] += 1
        legal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(seq, seq[1:]))
        ways = {"0": (0, "", ())}

        def step(ways, moves):
            new = {}
            for s, w in ways.items():
                for t, cost, edit, line in moves(s):
                    x = (w[0] + cost, w[1] + edit, w[2] + line)
                    if t not in new or x[:2] < new[t][:2]:
                        new[t] = x
            return new

        go = {"0": {"s": "1", "u": "2"}, "1": {"u": "2"}, "2": {"a": "3"}, "3": {"u": "2"}}
        name = {"u": "user", "a": "assistant"}

        def inserted(ways):
            for _ in range(3):
                more = step(ways, lambda s: [(t, 5, "I", (f"{name[i]}:",)) for i, t in go[s].items() if i in "ua"])
                ways = {s: min((w[s] for w in (ways, more) if s in w), key=lambda x: x[:2]) for s in {*ways, *more}}
            return ways

        for (_, role, text), f in zip(seq, kinds, strict=True):
            def moves(s):
                yield s, 2, "D", ()
                if f >= 2:
                    late = 5 if f == 2 else 0
                    for i, t in go[s].items():
                        if role[:1] == i:
                            yield t, late, "K", (f"{role}:{text}",)
                        if i in "ua":
                            yield t, 1 + late, "R", (f"{name[i]}:{text}",)
            ways = step(inserted(ways), lambda s: list(moves(s)))
        ways = inserted(ways)
        cost, audit, lines = min((ways[s] for s in "03" if s in ways), key=lambda x: x[:2])
        turns = [t for t, _, _ in seq if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out.append((conv, gaps, *faults, legal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def some_rows(seed, convs, most):
    rng = random.Random(seed)
    rows = []
    for c in range(convs):
        turn = 0
        for _ in range(rng.randint(1, most)):
            turn += rng.choice((0, 1, 1, 1, 1, 3))
            role = ("user", "assistant")[turn % 2] if rng.random() < 0.6 else rng.choice(ROLES)
            text = f"Turn {turn}." if rng.random() < 0.5 else rng.choice(TEXTS)
            rows.append((None if c == 3 else c, None if rng.random() < 0.05 else turn, role, text))
    rng.shuffle(rows)
    return rows


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_report_equals_brute_force(spark):
    rows = some_rows(1, 60, 40)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert got(C.repair_report(df)) == brute(rows)


def test_small_pieces_and_grammars_give_the_same(spark):
    """A long conversation cut into many pieces, without a grammar and with a small one."""
    rows = some_rows(2, 3, 20) + [(9, t, ("user", "assistant")[t % 2], f"T{t % 50}." if t % 7 else "loose") for t in range(600)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    want = brute(rows)
    for most_rules, piece in ((0, 7), (5, 64), (64, 4096)):
        assert got(C.repair_report(df, most_rules=most_rules, piece=piece)) == want


def test_repaired_rows_hash_to_the_report(spark):
    rows = some_rows(3, 25, 15)
    df = spark.createDataFrame(rows, SCHEMA)
    lines = {}
    for r in sorted(C.repaired_rows(df).collect(), key=lambda r: r.place):
        lines.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    report = C.repair_report(df).collect()
    assert {r.conv_id: r.repaired_sha256 for r in report} == {
        r.conv_id: hashlib.sha256("\n".join(lines.get(r.conv_id, [])).encode()).hexdigest() for r in report}
    for c in lines.values():
        assert re.fullmatch("s?(ua)+", "".join(x[0] for x in c))


def test_odd_tables(spark):
    clash = {"conv": "x", "key": "y", "copies": "z", "place": "p", "known": "k", "n": "n", "audit": "a"}
    rows = [(None, None, None, None)] * 3 + [(1, 0, "user", "x" * 300_000 + ".")] + [(2, 5, "assistant", "Hi.")] * 40
    from pyspark.sql import functions as F
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(v) for c, v in clash.items()})
    assert got(C.repair_report(df)) == brute(rows)
    assert C.repair_report(df.limit(0)).collect() == []
    # every row dropped: zeros and the hash of nothing
    dropped = next(t for t in range(1000) if zlib.crc32(f"7:{t}".encode()) % 20 == 0)
    r = C.repair_report(spark.createDataFrame([(7, dropped, "user", "Hi.")], SCHEMA)).collect()
    assert [tuple(x) for x in r] == [(7, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_rule_matrices_equal_their_symbols():
    rules = ["ua", C.rule_symbol(0) * 2, "xu", C.rule_symbol(1) + "x"]
    with_rules, plain = C.Matrices(rules), C.Matrices([])
    for n in range(1, 5):
        for s in map("".join, product("suaxU", repeat=n)):
            a, b = with_rules.product(C.parsed(s, rules)), plain.product(s)
            assert [[c and (c[0], C.flat(c[1])) for c in row] for row in a] == [[c and (c[0], C.flat(c[1])) for c in row] for row in b]


def test_grammar_takes_frequent_pairs_first(spark):
    cut = spark.createDataFrame([("uauauaua",), ("suaua",), ("xx",)], "symbols string")
    rules = C.learn_rules(cut)
    assert rules[0] == "ua" and C.rule_symbol(0) * 2 in rules
    assert len(C.learn_rules(cut, 1)) == 1
