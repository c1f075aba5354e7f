"""Personal data by rules and by weak supervision; DataFrame functions only.

Base spans are the fixed rules of e-mail addresses, IPv4 addresses, card numbers and phone numbers, leftmost and without
overlap for each kind. The patterns below say the same with possessive repetition and start only where a run begins or the
last match ended, so no text takes quadratic time or deep recursion.

Further candidates are numbers written without a plus sign and addresses with a spelled-out "at". Labelers vote on each for,
against or not at all: shapes (regular expressions), lists of endings and prefixes (gazetteers) and words around the
candidate (context). Expectation-maximisation over the counts of vote patterns estimates every labeler's reliability without
labels; its posteriors train a logistic classifier of spans on plain features. Candidates it accepts that touch no
base span are added. Only counts by pattern reach the driver, a fixed number of them.

Null and empty texts have no spans, offsets are code points with the end exclusive. Repeated rows are counted each; an empty table and a table without candidates
learn nothing and add nothing. Other columns are left alone.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..session import cut
from .common import whole

KINDS = ["email", "ip", "card", "phone"]
# The base patterns, written so that they match the same spans in linear time.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
NEEDS = {"email": "@", "ip": ".", "phone": "+"}  # texts without it have no match
BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
CANDIDATES = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?(?:\(at\)|\[at\]| at ) ?[A-Za-z0-9-]++(?: ?(?:\(dot\)|\[dot\]| dot |\.) ?[A-Za-z]{2,12}+)++",
    "phone": r"(?<![A-Za-z0-9+.(-])\(?[0-9][ ().0-9-]{5,}[0-9](?![A-Za-z0-9])",
}
AROUND, AFTER = 24, 2  # characters before and after a candidate that count
BACK = 4  # matches before, which with their gaps fill AROUND
CONTEXT = {
    "email": ("(?i)mail|contact|write|kontakt|correo|courriel|schreib|escrib", "(?i)version|chapter|meet|arriv"),
    "phone": ("(?i)phone|tel|call|fax|mobil|hotline|kontakt|contact|whatsapp|ruf", r"(?i)order|invoice|isbn|version|date|page|card|number of|ssn|\$|€"),
}
ROUNDS = 50


def pieces(text: Column, pattern: str, code: int) -> Column:
    """Array of (code, m, gap, tail, head) for every match: its text, the length of what lies between it and the match before,
    the end of that, and the start of what follows. Positions are sums of lengths, taken when the array has become rows."""
    found, between = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    both = F.arrays_zip(found.alias("m"), F.slice(between, 1, F.size(found)).alias("g"), F.slice(between, 2, F.size(found)).alias("h"))
    return F.transform(both, lambda x: F.struct(
        F.lit(code).alias("code"), x["m"].alias("m"), F.length(x["g"]).alias("gap"), F.right(x["g"], F.lit(AROUND)).alias("tail"),
        F.left(x["h"], F.lit(AFTER)).alias("head")))


def digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the check digit."""
    single = F.transform(F.filter(F.split(F.reverse(number), ""), lambda c: c != ""), lambda c: F.ascii(c) - 48)
    doubled = F.transform(single, lambda d, i: F.when(i % 2 == 0, d).otherwise(d * 2 - F.when(d > 4, 9).otherwise(0)))
    return F.aggregate(doubled, F.lit(0), lambda s, d: s + d) % 10 == 0


def valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        return m.rlike(rf"^{BYTE}(?:\.{BYTE}){{3}}$")
    if kind == "card":
        return F.length(digits(m)).between(13, 19) & luhn(F.substring(digits(m), 1, 19))
    if kind == "phone":
        return F.length(digits(m)).between(9, 15)
    return F.lit(True)


def vote(for_it: Column, against: Column) -> Column:
    return F.when(for_it, 1).when(against, -1).otherwise(0)


def judged(kind: str) -> tuple[Column, Column]:
    """Votes and features of a candidate with its text m and its surroundings before and after."""
    m, before, after = F.col("m"), F.col("before"), F.col("after")
    d = F.length(digits(m))
    near, far = before.rlike(CONTEXT[kind][0]), before.rlike(CONTEXT[kind][1])
    if kind == "phone":
        votes = [
            vote(m.rlike(r"^(?:\([0-9]{2,5}\) ?|[0-9]{2,5}[ .-])[0-9]{3,4}[ .-][0-9]{3,4}$"), m.rlike(r"^[0-9]+$|^[0-9]{4}-[0-9]{2}-[0-9]{2}$")),
            vote(m.rlike(r"^\(?0[1-9]|^\(?(?:212|213|255|310|415|555|646|800|888)[) .-]"), m.rlike(r"^\(?(?:19|20)[0-9]{2}\b")),
            vote(d.between(9, 11), (d < 7) | (d > 15)),
            vote(near, far),
            vote(F.lit(False), after.rlike(r"^ ?[%$€]|^[A-Za-z]")),
        ]
        features = [m.contains("("), m.rlike("[-.]"), m.contains(" "), d == 10, d > 11, d < 9, near, far]
    else:
        votes = [
            vote(m.rlike(r"\((?:at|dot)\)|\[(?:at|dot)\]"), F.lit(False)),
            vote(m.rlike(r"(?i)(?:\.|dot\)?\]? ?)(?:com|org|net|edu|gov|info|io|eu|de|fr|es|uk)$"), F.lit(True)),
            vote(m.rlike(r"^[A-Za-z0-9%+-]*[._0-9]"), F.lit(False)),
            vote(near, far),
            vote(F.lit(False), after.rlike(r"^[A-Za-z]")),
        ]
        features = [m.contains("("), m.contains("["), m.rlike(r"\.[A-Za-z]+$"), m.rlike("[0-9]"), F.length(m) > 40, m.contains(" at "), near, far]
    return F.concat(*[(v + 1).cast("string") for v in votes]), F.concat(*[f.cast("int").cast("string") for f in features])


def reliabilities(patterns: list[tuple[str, int]]) -> dict[str, float]:
    """P(personal | votes) of each vote pattern by expectation-maximisation; labelers are independent given the truth."""
    if not patterns:
        return {}
    size = len(patterns[0][0])
    post = {v: min(0.95, max(0.05, 0.5 + 0.2 * sum(int(c) - 1 for c in v))) for v, _ in patterns}  # majority first
    for _ in range(ROUNDS):
        total = [sum(n * (post[v] if y else 1 - post[v]) for v, n in patterns) for y in (0, 1)]
        prior = (total[1] + 1) / (sum(total) + 2)
        table = [[[(sum(n * (post[v] if y else 1 - post[v]) for v, n in patterns if v[j] == c) + 1) / (total[y] + 3) for c in "012"]
                  for j in range(size)] for y in (0, 1)]
        for v, _ in patterns:
            odds = math.log(prior / (1 - prior)) + sum(math.log(table[1][j][int(c)] / table[0][j][int(c)]) for j, c in enumerate(v))
            post[v] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
    return post


def span_classifier(rows: list[tuple[str, float, int]], rounds: int = 300) -> list[float]:
    """Weights (bias last) of a logistic classifier from (features, probability, count)."""
    if not rows:
        return []
    size, n = len(rows[0][0]), sum(r[2] for r in rows)
    w = [0.0] * (size + 1)
    for _ in range(rounds):
        grad = [1e-3 * x for x in w]
        for f, p, count in rows:
            on = [j for j in range(size) if f[j] == "1"] + [size]
            off = (1 / (1 + math.exp(-max(-30.0, min(30.0, sum(w[j] for j in on))))) - p) * count / n
            for j in on:
                grad[j] += off
        w = [x - 2.0 * g for x, g in zip(w, grad)]
    return w


def joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(names, x["k"] + 1), x["s"].cast("string"), x["e"].cast("string"))), ",")


def spans_of(rows: DataFrame) -> DataFrame:
    """(key, base, loose) of rows (key, t): base spans (k, s, e), and judged candidates that touch none of them.

    Matches leave their text as rows, so texts are read once and never shuffled, and a text with very many matches takes time in
    proportion: positions are running sums, and a candidate touches a base span if the farthest end of those that begin
    before its own end lies beyond its start.
    """
    t, none = F.col("t"), F.array().cast("array<struct<code:int,m:string,gap:int,tail:string,head:string>>")
    loose = {kind: len(KINDS) + i for i, kind in enumerate(CANDIDATES)}
    found = [F.when(F.contains(t, F.lit(NEEDS[k])), pieces(t, PATTERNS[k], i)).otherwise(none) if k in NEEDS else pieces(t, PATTERNS[k], i)
             for i, k in enumerate(KINDS)]
    found += [pieces(t, CANDIDATES[k], code) for k, code in loose.items()]
    one = rows.select(F.monotonically_increasing_id().alias("row"), "key", F.concat(*found).alias("x"))
    each = one.select("row", "key", F.posexplode_outer("x").alias("n", "x")).select("row", "key", "n", "x.*").repartition("row")
    order = W.partitionBy("row", "code").orderBy("n")
    ends = F.sum(F.col("gap") + F.length("m")).over(order.rowsBetween(W.unboundedPreceding, W.currentRow)).cast("int")
    # what stands before: the gap, and where it is short the matches and gaps before it
    earlier = [x for i in range(BACK, 0, -1) for x in (F.coalesce(F.lag("tail", i).over(order), F.lit("")), F.coalesce(F.lag("m", i).over(order), F.lit("")))]
    placed = each.withColumns({
        "e": ends, "before": F.right(F.concat(*earlier, "tail"), F.lit(AROUND)),
        "after": F.left(F.concat("head", F.coalesce(F.lead("m", 1).over(order), F.lit(""))), F.lit(AFTER))})
    placed = placed.withColumn("s", F.col("e") - F.length("m"))
    wrong = F.lit(False)
    for i, kind in enumerate(KINDS):
        wrong = F.when(F.col("code") == i, ~valid(kind, F.col("m"))).otherwise(wrong)
    placed = placed.withColumn("code", F.when(~F.coalesce(wrong, F.lit(True)), F.col("code")))  # a match that fails is no span
    is_base = F.col("code") < len(KINDS)
    place = F.when(is_base, F.col("s") * 2).otherwise(F.col("e") * 2 - 1)  # bases that begin before a candidate's end stand before it
    behind = W.partitionBy("row").orderBy(place).rowsBetween(W.unboundedPreceding, W.currentRow)
    told = placed.withColumn("reach", F.max(F.when(is_base, F.col("e"))).over(behind))
    alone = (F.col("code") >= len(KINDS)) & (F.coalesce(F.col("reach"), F.lit(0)) <= F.col("s"))
    votes, features = F.lit(None).cast("string"), F.lit(None).cast("string")
    kind_of = F.lit(None).cast("int")
    for kind, code in loose.items():
        v, f = judged(kind)
        votes, features = F.when(F.col("code") == code, v).otherwise(votes), F.when(F.col("code") == code, f).otherwise(features)
        kind_of = F.when(F.col("code") == code, F.lit(KINDS.index(kind))).otherwise(kind_of)
    base = F.when(is_base, F.struct(F.col("code").alias("k"), "s", "e"))
    candidate = F.when(alone, F.struct(kind_of.alias("k"), "s", "e", votes.alias("votes"), features.alias("features")))
    packed = told.groupBy("row").agg(F.first("key").alias("key"), F.collect_list(base).alias("base"), F.collect_list(candidate).alias("loose"))
    return packed.select("key", F.array_sort("base").alias("base"), F.array_sort("loose").alias("loose"))


def find(df: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, n_email, n_ip, n_card, n_phone, base, spans): base and spans are arrays of (k, s, e), k the place in KINDS,
    ordered by kind and start; spans holds the base spans and the added ones."""
    rows = cut(spans_of(df.select(F.col(key).alias("key"), whole(text).alias("t"))))
    counts = rows.select(F.explode("loose").alias("c")).groupBy("c.k", "c.votes", "c.features").agg(F.count("*").alias("n")).collect()
    yes = {}  # accepted feature patterns
    for kind in CANDIDATES:
        mine = [r for r in counts if r["k"] == KINDS.index(kind)]
        by_votes: dict[str, int] = {}
        for r in mine:
            by_votes[r["votes"]] = by_votes.get(r["votes"], 0) + r["n"]
        post = reliabilities(sorted(by_votes.items()))
        w = span_classifier(sorted((r["features"], post[r["votes"]], r["n"]) for r in mine))
        good = [f for f in sorted({r["features"] for r in mine}) if sum(w[j] for j, c in enumerate(f) if c == "1") + w[-1] >= 0]
        yes[kind] = F.array(*[F.lit(f) for f in good]).cast("array<string>")
    good = F.filter("loose", lambda x: ((x["k"] == KINDS.index("email")) & F.array_contains(yes["email"], x["features"]))
                    | ((x["k"] == KINDS.index("phone")) & F.array_contains(yes["phone"], x["features"])))
    added = F.transform(good, lambda x: F.struct(x["k"].alias("k"), x["s"].alias("s"), x["e"].alias("e")))

    def number(i: int) -> Column:
        return F.size(F.filter("base", lambda x: x["k"] == i)).cast("long").alias(f"n_{KINDS[i]}")

    return rows.select("key", *[number(i) for i in range(len(KINDS))], F.array_sort("base").alias("base"), F.array_sort(F.concat("base", added)).alias("spans"))
