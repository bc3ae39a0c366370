import hashlib
import random
import re

from affinis.llm import pii as P
from tests.llm.odd import SCHEMA, odd_rows, words, no_docs, odd_docs  # noqa: F401

# the contract's patterns, as given
GIVEN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (2 if i % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def passes(kind, v):
    digits = re.sub("[^0-9]", "", v)
    return {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in v.split(".")),
            "card": lambda: 13 <= len(digits) <= 19 and luhn(digits), "phone": lambda: 9 <= len(digits) <= 15}[kind]()


def brute(text):
    return [(k, m.start(), m.end()) for k, p in GIVEN.items() for m in re.finditer(p, text or "") if passes(k, m[0])]


def check(rows):
    for text, r in rows:
        spans = brute(text)
        line = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest(), (text, line, r.spans)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in spans) for k in GIVEN]
        assert r.spans.startswith(line)


def test_base_spans_equal_the_given_patterns(spark):
    texts = ["a@b.c_d@e.f", "a@b.c..d@e.f", "x@y", "@a.b", "a@b.c@d.e", "\U0001F600 a@b.co é 1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1",
             "0255.00.1.1", "1234.5.6.7", "12345678901234567.1.2.3", "4111 1111 1111 1111", "4111-1111-1111-1111 4111111111111111",
             "4111  1111", "41111111111111112", "+1 (743) 555-3824", "+1", "++1 2", "+12345678", "+123456789", "+1 234 567 890 (((", "x+1.2.3.4.5.6.7.8.9y",
             "+4111111111111111 a@1.2.3.4", "", " "]
    rng = random.Random(3)
    texts += ["".join(rng.choice("ab1.@+- 0495()_\né") for _ in range(rng.randint(5, 80))) for _ in range(600)]
    texts += ["a" * 60_000, "1" * 60_000, "1 " * 60_000, "a." * 30_000 + "@" + "a." * 30_000, "1." * 40_000, "+1" + "(" * 50_000]
    df = spark.createDataFrame([(i, t, None, None, 0) for i, t in enumerate(texts)], SCHEMA)
    got = {r.doc_id: r for r in P.find_spans(df).collect()}
    # the linear patterns find the same; the given ones would take too long on the last texts
    check([(t, got[i]) for i, t in enumerate(texts[:-6])])
    assert got[len(texts) - 4].n_card == 0 and got[len(texts) - 6].n_email == 0


def leak_rows():
    """``zorblatt`` stands only near one address, in different passages; common words stand everywhere."""
    rng = random.Random(4)
    rows = [(i, words(rng, 60), "aa", "s", 0) for i in range(200)]
    rows += [(1000 + i, f"{words(rng, 30)} zorblatt writes from bob@corp.example to {words(rng, 30)}", "aa", "s", 0) for i in range(4)]
    rows += [(2000 + i, "quimble calls +1 555 123 4567 at noon", "aa", "s", 0) for i in range(5)]     # copies: one context
    return rows


def test_terms_that_reveal_an_entity_are_added_and_removed(spark):
    df = spark.createDataFrame(leak_rows(), SCHEMA)
    texts = {r[0]: r[1] for r in leak_rows()}
    found = {}
    for r in P.find_spans(df).collect():
        terms = [s.split(":")[1:] for s in r.spans.split(",") if s.startswith("term")]
        found[r.doc_id] = {texts[r.doc_id][int(a):int(b)] for a, b in terms}
    assert all("zorblatt" in found[1000 + i] for i in range(4))
    assert not any(found[i] for i in range(200)) and not any(found[2000 + i] for i in range(5))
    clean = {r.doc_id: r.text for r in P.sanitise(df).collect()}
    assert all(clean[i] == texts[i] for i in range(200))
    assert all("zorblatt" not in clean[1000 + i] and "bob@corp.example" not in clean[1000 + i] and "[EMAIL]" in clean[1000 + i]
               for i in range(4))
    assert clean[2000] == "quimble calls [PHONE] at noon"


def test_a_disclosing_term_goes_wherever_it_stands(spark, monkeypatch):
    """Far from the address in its own text, and in a text without personal data; also where the term is hot."""
    rng = random.Random(6)
    far = f"{words(rng, 30)} Zorblatt writes from bob@corp.example {words(rng, 60)} ZORBLATT {words(rng, 9)}"
    rows = leak_rows() + [(3000, far, "aa", "s", 0), (3001, f"{words(rng, 20)} zorblatt {words(rng, 20)}", "aa", "s", 0), (3002, None, "aa", "s", 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    for share in (P.HOT_SHARE, 1e-5, 0.5):
        monkeypatch.setattr(P, "HOT_SHARE", share)
        clean = {r.doc_id: r.text for r in P.sanitise(df).collect()}
        assert not any("zorblatt" in (t or "").lower() for t in clean.values())
        spans = {r.doc_id: r.spans for r in P.find_spans(df).collect()}
        for i in (3000, 3001):
            places = {f"term:{m.start()}:{m.end()}" for m in re.finditer("zorblatt", {r[0]: r[1] for r in rows}[i].lower())}
            assert places <= set(spans[i].split(","))
        assert clean[0] == rows[0][1] and clean[3002] is None


def test_disclosure_counts_equal_brute_force(spark):
    """Every flagged (entity, term) and its value, from the formula over plain Python counts."""
    import math
    from collections import Counter, defaultdict

    rows = leak_rows()
    n, near, contexts = Counter(), Counter(), defaultdict(set)
    for r in rows:
        n.update(w.lower() for w in re.findall(r"[^\W\d_]{4,}", r[1]))
        for k, a, b in brute(r[1]):
            before, after = r[1][max(0, a - 64):a], r[1][b:b + 64]
            e = f"{k}:{r[1][a:b].lower() if k == 'email' else re.sub('[^0-9]', '', r[1][a:b])}"
            ts = [m[0] for m in re.finditer(r"[^\W\d_]{4,}", before) if m.start() > 0 or a <= 64]
            ts += [m[0] for m in re.finditer(r"[^\W\d_]{4,}", after) if m.end() < len(after) or len(after) < 64]
            for t in ts:
                near[e, t.lower()] += 1
                contexts[e, t.lower()].add((before.lower(), after.lower()))
    total, of = sum(n.values()), Counter()
    for (e, _), c in near.items():
        of[e] += c
    want = {}
    for (e, t), c in near.items():
        d = 1 + math.log2(min(1, c / n[t])) / -math.log2(of[e] / total)
        if len(contexts[e, t]) >= 2 and d >= P.GENERALISE:
            want[e, t] = d
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, SCHEMA)
    got = {(r.entity, r.term): r.disclosure for r in P.disclosing(P.mentions(P.base_spans(df, F.lit(1))), df).collect()}
    assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-12 for k in got)


def test_term_filter_holds_every_term_and_few_others(spark):
    from pyspark.sql import functions as F
    terms = spark.range(5000).select(F.concat(F.lit("name"), F.col("id")).alias("term"))
    others = spark.range(5000, 55000).select(F.concat(F.lit("name"), F.col("id")).alias("term"))
    test = P.may_be_in(terms)
    assert terms.where(test(F.col("term"))).count() == 5000
    assert others.where(test(F.col("term"))).count() < 50
    small = P.may_be_in(terms, most_bits=1024)                     # too few bits: lets more through, loses none
    assert terms.where(small(F.col("term"))).count() == 5000
    none = P.may_be_in(terms.where("false"))
    assert others.where(none(F.col("term"))).count() == 0


def test_terms_of_texts_equal_the_plain_join(spark, monkeypatch):
    from pyspark.sql import functions as F
    rng = random.Random(5)
    texts = [" ".join(f"word{chr(97 + rng.randrange(26))}{chr(97 + rng.randrange(26))}" for _ in range(30)) + " Common" for _ in range(300)]
    docs = spark.createDataFrame([(t,) for t in texts + [None, ""]], "text string").repartition(3)
    words = P.term_counts(docs)
    revealing = spark.createDataFrame([("wordab", 0.9), ("wordzz", 0.95), ("common", 0.99), ("absent", 1.0)], "term string, disclosure double")
    want = {t: {w for w in t.lower().split() if w in ("wordab", "wordzz", "common")} for t in texts}
    keyed = {tuple(r.k): r.text for r in docs.select("text", P.text_key(F.coalesce("text", F.lit(""))).alias("k")).collect()}
    for bits in (P.MOST_FILTER_BITS, 64):
        monkeypatch.setattr(P, "MOST_FILTER_BITS", bits)
        got = {keyed[tuple(r.key)]: {x.term for x in r.terms} for r in P.text_terms(docs, words, revealing).collect()}
        assert got == {t: s for t, s in want.items() if s}


def test_odd_rows_and_overlaps(spark, odd_docs, no_docs):
    got = P.find_spans(odd_docs).collect()
    assert len(got) == len(odd_rows())
    clean = P.sanitise(odd_docs)
    assert clean.columns == odd_docs.columns and clean.count() == len(odd_rows())
    assert sum(r.text is None for r in clean.collect()) == sum(r[1] is None for r in odd_rows())
    df = spark.createDataFrame([(1, "+1 4111111111111 x 1.2.3.4@b.cd", None, None, 9)], SCHEMA)
    assert P.sanitise(df).first().text == "[PHONE] x [EMAIL]"
    assert P.find_spans(no_docs).collect() == [] and P.sanitise(no_docs).collect() == []


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame(leak_rows(), SCHEMA)
    for out in (P.find_spans(df), P.sanitise(df)):
        assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
