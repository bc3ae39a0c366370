"""Operator 5, PII: information-theoretic sanitisation.

Base spans: e-mail, IP address, card and phone number by pattern and check
digit or range.  They are the protected entities.  The corpus then tells how
strongly a term reveals an entity: for a term t near mentions of an entity e,

    disclosure = PMI(t; e) / IC(e) = 1 + log2 P(e | t) / IC(e),

with P(e | t) the share of t's occurrences in the whole corpus that stand
near e, and IC(e) = -log2 of e's share of all terms.  1 means that t tells e
completely.  A term near an entity in at least ``MIN_CONTEXTS`` different
contexts (copies of one passage are one context) is generalised from
``GENERALISE`` on and removed from ``REMOVE`` on, wherever it stands: near
that entity, further away and in texts that do not hold the entity.  A text
with neither personal data nor a disclosing term is never changed.

All columns are Spark expressions.  Positions come from the gaps between
matches (split) beside the matches themselves.  The patterns are written
with possessive repetition and anchored starts, so they find the same spans
in time linear in the text and need no stack per repetition.

Cases: a null text counts as empty and stays null; an empty table gives no
rows; rows with equal texts get equal spans; spans that overlap are replaced
together, under the label of the first (the longer, if two begin together); a null doc_id passes unchanged; extra
columns pass unchanged (sanitised rows), or are not read (span queries).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinis.llm.common import nested
from affinis.session import stage

KINDS = ("email", "ip", "card", "phone")

# The contract's patterns, in linear form.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"[0-9](?<![0-9][0-9])[0-9]*+\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TERM = r"\p{L}{4,}+"
LABELS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]"}
TERM_LABEL = "[TERM]"

CONTEXT_CHARS = 64
MIN_CONTEXTS = 2
GENERALISE = 0.9
REMOVE = 0.97
HOT_SHARE = 1e-4        # a term with more of all occurrences is salted; at most 1 / HOT_SHARE terms have so many
FILTER_BITS_PER_TERM = 32
MOST_FILTER_BITS = 1 << 26      # 8 MiB; with more terms the filter lets more rows into the (exact) join behind it


def _digits(v: Column) -> Column:
    return F.regexp_replace(v, "[^0-9]", "")


def _luhn(v: Column) -> Column:
    d = F.reverse(_digits(v))
    at = F.sequence(F.lit(1), F.length(d))
    twice = lambda n: F.when(n > 4, 2 * n - 9).otherwise(2 * n)
    digit = lambda i: F.substr(d, i, F.lit(1)).cast("int")
    total = F.aggregate(F.transform(at, lambda i: F.when(i % 2 == 0, twice(digit(i))).otherwise(digit(i))),
                        F.lit(0), lambda a, x: a + x)
    return F.length(d).between(13, 19) & (total % 10 == 0)


def valid(kind: str, v: Column) -> Column:
    if kind == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
        return v.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        return _luhn(v)
    if kind == "phone":
        return F.length(_digits(v)).between(9, 15)
    return F.lit(True)


def _placed(matches: Column, gaps: Column, ok, kind: str) -> Column:
    """Spans (kind, start, end, value) of the matches that pass ``ok``; one step per match."""
    empty = F.lit([]).cast("array<struct<kind:string,start:int,end:int,value:string>>")

    def step(acc, x):
        start = acc["pos"] + F.length(x["gaps"])
        end = start + F.length(x["matches"])
        span = F.struct(F.lit(kind).alias("kind"), start.cast("int").alias("start"), end.cast("int").alias("end"),
                        x["matches"].alias("value"))
        return F.struct(F.coalesce(end, F.lit(0)).cast("int").alias("pos"),
                        F.when(x["matches"].isNotNull() & ok(x["matches"]), F.concat(acc["out"], F.array(span)))
                        .otherwise(acc["out"]).alias("out"))

    zipped = F.arrays_zip(matches.alias("matches"), gaps.alias("gaps"))
    return F.when(F.size(matches) > 0, F.aggregate(
        zipped, F.struct(F.lit(0).alias("pos"), empty.alias("out")), step)["out"]).otherwise(empty)


def with_spans(df: DataFrame, text: str, patterns: dict[str, str], check, out: str) -> DataFrame:
    """``df`` with column ``out``: spans of all kinds in the order of ``patterns``, each kind by start."""
    # one step per select: a match list is used several times and must be computed once
    df = df.withColumns({f"_m_{k}": F.regexp_extract_all(F.col(text), F.lit(p), F.lit(0)) for k, p in patterns.items()})
    df = df.withColumns({f"_g_{k}": F.when(F.size(f"_m_{k}") > 0, F.split(F.col(text), p, -1))
                         .otherwise(F.array().cast("array<string>")) for k, p in patterns.items()})
    spans = [_placed(F.col(f"_m_{k}"), F.col(f"_g_{k}"), lambda v, k=k: check(k, v), k) for k in patterns]
    return (df.withColumn(out, F.concat(*spans))
            .drop(*[f"_m_{k}" for k in patterns], *[f"_g_{k}" for k in patterns]))


def text_key(text: Column) -> Column:
    """Equal texts have equal keys; three hashes make different texts with one key a practical impossibility."""
    return F.struct(F.xxhash64(text).alias("x"), F.crc32(text).alias("c"), F.length(text).alias("n"))


def base_spans(docs: DataFrame, carry: Column) -> DataFrame:
    """(rec, key, text, base): ``carry`` as rec, and the base spans of the text (null: empty)."""
    rows = docs.select(carry.alias("rec"), F.coalesce("text", F.lit("")).alias("text"))
    return with_spans(rows, "text", PATTERNS, valid, "base").withColumn("key", text_key(F.col("text")))


def mentions(found: DataFrame) -> DataFrame:
    """(key, entity, term, start, end, context): terms within ``CONTEXT_CHARS`` of a base span."""
    w = F.lit(CONTEXT_CHARS)

    def around(s):
        b0 = F.greatest(F.lit(0), s["start"] - w)
        return F.struct(s["kind"].alias("kind"), s["value"].alias("value"), b0.alias("b0"), s["end"].alias("a0"),
                        F.substr(F.col("text"), b0 + 1, s["start"] - b0).alias("before"),
                        F.substr(F.col("text"), s["end"] + 1, w).alias("after"))

    near = (found.where(F.size("base") > 0).select("key", F.explode(F.transform("base", around)).alias("s"))
            .select("key", "s.*"))
    value = F.when(F.col("kind") == "email", F.lower("value")).otherwise(
        F.when(F.col("kind") == "ip", F.col("value")).otherwise(_digits(F.col("value"))))
    near = near.select("key", F.concat_ws(":", "kind", value).alias("entity"), "b0", "a0", "before", "after",
                       F.xxhash64(F.lower("before"), F.lower("after")).alias("context"))
    everything = lambda k, v: F.lit(True)
    near = with_spans(near, "before", {"term": TERM}, everything, "tb")
    near = with_spans(near, "after", {"term": TERM}, everything, "ta")
    # a word that touches the far edge of its context may be cut there
    tb = F.filter("tb", lambda t: (t["start"] > 0) | (F.col("b0") == 0))
    ta = F.filter("ta", lambda t: (t["end"] < F.length("after")) | (F.length("after") < w))
    shift = lambda a, by: F.transform(a, lambda t: F.struct(
        F.lower(t["value"]).alias("term"), (t["start"] + by).alias("start"), (t["end"] + by).alias("end")))
    return near.select("key", "entity", "context",
                       F.explode(F.concat(shift(tb, F.col("b0")), shift(ta, F.col("a0")))).alias("t")).select(
        "key", "entity", "context", "t.*")


def term_counts(docs: DataFrame) -> DataFrame:
    """(term, n): occurrences of each term in all texts."""
    return (docs.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(TERM), F.lit(0))).alias("term"))
            .groupBy("term").agg(F.count(F.lit(1)).alias("n")))


def disclosing(near: DataFrame, docs: DataFrame, words: DataFrame | None = None) -> DataFrame:
    """(entity, term, disclosure) of the terms that reach ``GENERALISE``; counts cover all documents."""
    pairs = (near.groupBy("entity", "term", "context").agg(F.count(F.lit(1)).alias("c"))
             .groupBy("entity", "term").agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("contexts")))
    entities = pairs.groupBy("entity").agg(F.sum("c").alias("m"))
    words = stage(term_counts(docs), "pii_term_counts") if words is None else words
    total = words.agg(F.sum("n")).scalar()
    known = pairs.where(F.col("contexts") >= MIN_CONTEXTS).join(entities, "entity").join(words, "term")
    share = F.least(F.lit(1.0), F.col("c") / F.col("n"))
    ic = -F.log2(F.col("m") / total)
    return (known.withColumn("disclosure", 1 + F.try_divide(F.log2(share), ic))
            .where(F.col("disclosure") >= GENERALISE).select("entity", "term", "disclosure"))


def may_be_in(terms: DataFrame, most_bits: int | None = None):
    """A test (column -> condition) that holds for every ``term`` of ``terms`` and for few others: a Bloom filter.

    Its bits are one array, built by an aggregate and read as a scalar subquery.
    """
    n = max(1, terms.count())
    bits = max(64, min(most_bits or MOST_FILTER_BITS, 1 << math.ceil(math.log2(FILTER_BITS_PER_TERM * n))))
    probes = max(1, min(5, round(math.log(2) * bits / n)))

    def places(term: Column) -> list[Column]:
        h = F.xxhash64(term)
        low, high = h.bitwiseAND(F.lit(0x7FFFFFFF)), F.shiftrightunsigned(h, 33)
        return [F.pmod(low + i * high, F.lit(bits)) for i in range(probes)]

    word = lambda at: F.shiftright(at, 6)
    bit = lambda at: F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(F.lit(63)).cast("int"))
    at = F.col("at")
    set_bits = terms.select(F.explode(F.array(*places(F.col("term")))).alias("at")).select(word(at).alias("word"), bit(at).alias("bits"))
    no_bits = terms.sparkSession.range(bits // 64).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("bits"))
    words = set_bits.unionByName(no_bits).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("word", "bits"))), lambda w: w["bits"])
    table = stage(words.agg(ordered.alias("bits")), "term_filter").scalar()

    def test(term: Column) -> Column:
        out = F.lit(True)
        for p in places(term):
            out = out & (table[word(p).cast("int")].bitwiseAND(bit(p)) != 0)
        return out

    return test


def text_terms(docs: DataFrame, words: DataFrame, revealing: DataFrame) -> DataFrame:
    """(key, terms): the disclosing terms of every text that holds any, near an entity or not.

    Each text gives its distinct terms.  Those that a Bloom filter of ``revealing`` rules out leave before the shuffle,
    the others meet ``revealing`` by term.  Terms with more than ``HOT_SHARE`` of all occurrences are at most
    1 / ``HOT_SHARE``, so their list is broadcast: those that disclose nothing leave too, the others are cut into salts.
    """
    value = F.transform(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(TERM), F.lit(0)), lambda v: F.lower(v))
    pairs = (docs.select(text_key(F.coalesce("text", F.lit(""))).alias("key"), F.monotonically_increasing_id().alias("at"),
                         F.array_distinct(value).alias("terms"))
             .select("key", "at", F.explode("terms").alias("term")).where(may_be_in(revealing)(F.col("term"))))
    least = words.agg(F.sum("n") * F.lit(HOT_SHARE)).scalar()
    hot = F.broadcast(words.where(F.col("n") > least).join(revealing.select("term", F.lit(True).alias("reveals")), "term", "left")
                      .select("term", F.ceil(F.col("n") / least).alias("salts"), F.coalesce("reveals", F.lit(False)).alias("reveals")))
    left = (pairs.join(hot, "term", "left").where(F.col("reveals").isNull() | F.col("reveals"))
            .select("key", "term", F.pmod("at", F.coalesce("salts", F.lit(1))).alias("salt")))
    salted = (revealing.join(hot.select("term", "salts"), "term", "left")
              .select("term", "disclosure", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)).alias("salt")))
    hits = left.join(salted, ["term", "salt"]).groupBy("key", "term").agg(F.max("disclosure").alias("disclosure"))
    return hits.groupBy("key").agg(F.collect_list(F.struct("term", "disclosure")).alias("terms"))


def with_terms(docs: DataFrame, found: DataFrame, rows: DataFrame) -> DataFrame:
    """``rows`` (of ``base_spans``) with ``terms``: start, end and disclosure of the disclosing terms in each text."""
    near = stage(mentions(found), "pii_mentions")
    words = stage(term_counts(docs), "pii_term_counts")
    revealing = stage(disclosing(near, docs, words).groupBy("term").agg(F.max("disclosure").alias("disclosure")), "pii_revealing")
    terms = stage(text_terms(docs, words, revealing), "pii_terms").withColumnRenamed("key", "of")
    rows = rows.join(terms, F.col("key") == F.col("of"), "left").drop("of")
    rows = rows.withColumns({"_by": F.map_from_entries("terms"), "_text": F.when(F.col("terms").isNotNull(), F.col("text")).otherwise("")})
    rows = with_spans(rows, "_text", {"term": TERM}, lambda k, v: F.col("_by")[F.lower(v)].isNotNull(), "_t")
    return rows.withColumn("terms", F.transform("_t", lambda t: F.struct(
        t["start"].alias("start"), t["end"].alias("end"), F.col("_by")[F.lower(t["value"])].alias("disclosure")))).drop("_by", "_text", "_t")


def _joined(spans: Column, kind: Column | None = None) -> Column:
    name = (lambda s: s["kind"]) if kind is None else (lambda s: kind)
    return F.transform(spans, lambda s: F.concat_ws(":", name(s), s["start"].cast("string"), s["end"].cast("string")))


def find_spans(docs: DataFrame) -> DataFrame:
    """Contract columns: counts and digest of the base spans, and all spans with the method's terms."""
    found = base_spans(docs, F.col("doc_id"))
    rows = with_terms(docs, found, found)
    base = F.array_join(_joined(F.col("base")), ",")
    extra = _joined(F.col("terms"), F.lit("term"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return rows.select(F.col("rec").alias("doc_id"), *[count(k) for k in KINDS], F.sha2(base, 256).alias("base_sha256"),
                       F.array_join(F.concat(_joined(F.col("base")), extra), ",").alias("spans"))


def _replaced(text: Column, spans: Column) -> Column:
    """``text`` with each span (start, end, label), sorted by start, replaced by its label."""
    start = F.struct(F.lit(0).alias("pos"), F.array().cast("array<string>").alias("out"))

    def step(acc, s):
        gap = F.substr(text, acc["pos"] + 1, s["start"] - acc["pos"])
        return F.when(s["start"] >= acc["pos"], F.struct(s["end"].alias("pos"), F.concat(acc["out"], F.array(gap, s["label"])).alias("out"))
                      ).otherwise(F.struct(F.greatest(acc["pos"], s["end"]).alias("pos"), acc["out"].alias("out")))

    def finish(acc):
        return F.concat(F.array_join(acc["out"], ""), F.substr(text, acc["pos"] + 1, F.length(text)))

    return F.aggregate(spans, start, step, finish)


def sanitise(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data and disclosing terms replaced in ``text``; ``n_chars`` follows the new text."""
    rows = with_terms(docs, base_spans(docs, F.lit(None).cast("int")), base_spans(docs, nested(docs)))
    names = F.create_map(*[F.lit(x) for kv in LABELS.items() for x in kv])
    b = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), names[s["kind"]].alias("label")))
    t = F.transform("terms", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.when(
        s["disclosure"] >= REMOVE, F.lit("")).otherwise(F.lit(TERM_LABEL)).alias("label")))
    rows = rows.withColumn("spans", F.array_sort(F.concat(b, t), lambda x, y: F.when(
        x["start"] != y["start"], x["start"] - y["start"]).otherwise(y["end"] - x["end"])))
    rows = rows.withColumn("clean", F.when(F.col("rec.text").isNotNull(), F.when(
        F.size("spans") > 0, _replaced(F.col("text"), F.col("spans"))).otherwise(F.col("text"))))
    changed = F.size("spans") > 0
    col = {"text": F.col("clean"), "n_chars": F.when(changed, F.length("clean")).otherwise(F.col("rec.n_chars"))
           if "n_chars" in docs.columns else None}
    return rows.select(*[(col[c].cast(docs.schema[c].dataType) if c in col else F.col("rec")[c]).alias(c) for c in docs.columns])
