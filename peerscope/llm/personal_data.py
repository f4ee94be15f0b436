"""Operator 11 -- personal data by weakly supervised spans, in native expressions.

Kinds: email, ip, card and phone.  The *base* spans of a kind are the leftmost non-overlapping matches of its pattern that pass its
rule; they always stay.  *Wide* candidates are looser forms (addresses spelled out, IPv6 and defanged addresses, numbers grouped
otherwise or without a country code); which of them are personal data is learned without labels:

1. Five labelers vote on each candidate, base or wide, for, against or not at all: its form (regular expressions, check digits), a gazetteer
   (top-level domains, reserved networks, issuer prefixes, dialling codes), words before it that announce the kind, words that
   announce something else, and characters grown together with it.
2. Expectation-maximisation over the counts of vote patterns estimates each labeler's reliability and, from these, how probable
   each pattern is personal data (two latent classes a kind, conditionally independent votes).
3. A logistic span classifier is trained on those probabilities with the votes and the span's shape (length, separators, neighbours) as
   features.  A wide candidate is added where it says 0.5 or more.

Plan.  Everything that touches text is Spark's own functions: ``split`` and ``regexp_extract_all`` by the same pattern give the pieces between
the matches and the matches, and running sums of their lengths the places.  Patterns are written so that matching is linear whatever the
text (possessive loops; a run is only entered at its start or where the last match ended), and running sums go by blocks of the square
root of the matches.  Arrays are zipped, never indexed inside a lambda: the optimizer would move a column made once into the lambda and
make it once for each element.  No row is exploded or shuffled for that: a document's candidates are an array in its row, stored once without
the text.  Only the counts of the patterns (votes and shape, at most a few ten thousand rows by construction, whatever the corpus) reach the driver;
they cover all candidates of all documents.

Edge cases: a null text is empty and has no spans; rows are independent of each other, so repeated rows, repeated or null ids give
their own rows; spans of one start are in the order of the kinds; a table without candidates, or an empty one, trains nothing
and adds nothing; texts are read whole, whatever their length; other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerscope.session import materialize

KINDS = ("email", "ip", "card", "phone")
LABELERS = ("form", "gazetteer", "announced", "other", "joined")
ADD_FROM = 0.5
BEFORE, AFTER = 32, 2               # characters of context
LENGTHS, LEFTS, RIGHTS, SEPARATORS = 6, 4, 4, 3     # levels of the shape features

_LOCAL = "A-Za-z0-9._%+-"
#: Base patterns.  A run is entered at its start, or where the last match ended within it; loops never give back.
PATTERNS = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){13,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9](?:[ ().-]*+[0-9]){9,14}+(?![ ().-]*+[0-9])",
}
#: Wide forms, one alternation, so wide candidates never overlap each other.
WIDE = {
    "email": rf"(?<![{_LOCAL}])[{_LOCAL}]{{1,64}}+(?: ?[\[(\x7B] ?(?:at|AT) ?[\])\x7D] ?[A-Za-z0-9-]{{1,63}}+(?:(?:\.| ?[\[(\x7B] ?(?:dot|DOT) ?[\])\x7D] ?)[A-Za-z0-9-]{{1,63}}+){{1,8}}+"
             r"| at [A-Za-z0-9-]{1,63}+(?: dot [A-Za-z0-9-]{1,63}+){1,8}+)",
    "ip": r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])"
          r"|(?<![0-9.])[0-9]{1,3}(?:\[(?:\.|dot)\][0-9]{1,3}){3}(?![0-9.])",
    "card": r"(?<![0-9A-Za-z])[0-9]{4}(?:[ ./_-]?[0-9]{4}){2}[ ./_-]?[0-9]{2,7}(?![0-9A-Za-z])"
            r"|(?<![0-9A-Za-z])3[47][0-9]{2}[ ./_-][0-9]{6}[ ./_-][0-9]{5}(?![0-9A-Za-z])",
    "phone": r"(?<![0-9A-Za-z+(.-])(?:(?:\+|00 ?)[1-9][0-9]{0,2}[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z-])",
}

# Gazetteers and context words: fixed lists.
TOP_LEVEL = ("com org net edu gov mil int info biz name pro io co ai app dev me tv xyz online site eu uk us ca au nz ie in de at ch fr be lu nl "
             "es pt mx ar cl br it pl cz sk hu ro bg gr tr ru ua se no dk fi is ee lv lt jp cn kr tw hk sg za il ae").split()
DIALLING = ("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 "
            "93 94 95 98 211 212 213 216 351 352 353 354 358 370 371 372 380 385 386 420 421 852 886 971 972").split()
RESERVED = r"^(?:0|10|127|2(?:2[4-9]|[3-5][0-9]))\.|^192\.168\.|^169\.254\.|^172\.(?:1[6-9]|2[0-9]|3[01])\."
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[0-9]|6)"
ANNOUNCED = {
    "email": r"e-?mail|mail|contact|write|reply|courriel|correo|kontakt|schreib",
    "ip": r"\bip\b|address|host|server|client|adresse|direcci|login",
    "card": r"card|visa|master|amex|credit|debit|karte|carte|tarjeta|payment",
    "phone": r"phone|tel|call|mobile|cell|fax|whatsapp|anruf|appel|llam|móvil",
}
OTHER = r"version|build|release|isbn|issn|order|invoice|serial|sku|part no|ref|tracking|ticket|commit|hash|sha|uuid|token|look|figure|page|doi"


def _running(df: DataFrame, columns: dict[str, str], combine) -> DataFrame:
    """Adds, for each ``{out: column}``, the running ``combine`` (a sum, a maximum) of an array of longs that are not negative; by blocks,
    so that very many elements do not copy an ever longer array for each of them."""
    zero = F.lit(0).cast("long")

    def scan(values: Column, start: Column) -> Column:
        first = F.struct(start.alias("s"), F.array().cast("array<long>").alias("a"))

        def step(acc, x):
            after = combine(acc["s"], x)
            return F.struct(after.alias("s"), F.concat(acc["a"], F.array(after)).alias("a"))

        return F.aggregate(values, first, step, lambda acc: acc["a"])

    def cut(column: str) -> Column:
        size = F.size(column)
        width = F.greatest(F.ceil(F.sqrt(size)), F.lit(1)).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), (F.ceil(size / width) - 1).cast("int")), lambda b: F.slice(column, b * width + 1, width))
        return F.when(size > 0, blocks).otherwise(F.array().cast("array<array<long>>"))

    def ends(out: str) -> Column:
        heads = F.concat(F.array(zero), F.col(f"__{out}_heads"))
        return F.flatten(F.filter(F.zip_with(f"__{out}_blocks", heads, scan), lambda x: x.isNotNull()))

    df = df.withColumns({f"__{out}_blocks": cut(column) for out, column in columns.items()})
    df = df.withColumns({f"__{out}_heads": scan(F.transform(f"__{out}_blocks", lambda b: F.aggregate(b, zero, combine)), zero) for out in columns})
    return df.withColumns({out: ends(out) for out in columns}).drop(*[f"__{out}_{x}" for out in columns for x in ("blocks", "heads")])


def _located(df: DataFrame, patterns: dict[str, tuple[str, Column]]) -> DataFrame:
    """Replaces the text ``t`` by the matches of each ``{out: (pattern, where it can match)}`` as (start, end, m, before, after), places in
    code points.  Of the pieces between matches only their lengths and ends are kept."""
    def pieces(out: str) -> Column:
        pattern, possible = patterns[out]
        return F.transform(F.when(possible, F.split("t", pattern, -1)).otherwise(F.array("t")), lambda x: F.struct(
            F.length(x).cast("long").alias("n"), F.right(x, F.lit(BEFORE)).alias("before"), F.left(x, F.lit(AFTER)).alias("after")))

    def found(out: str) -> Column:
        return F.when(F.size(f"__{out}_pieces") > 1, F.regexp_extract_all("t", F.lit(patterns[out][0]), F.lit(0))).otherwise(F.array().cast("array<string>"))

    def sizes(out: str) -> Column:
        return F.filter(F.zip_with(out, f"__{out}_pieces", lambda m, p: F.length(m) + p["n"]), lambda x: x.isNotNull())

    def spans(out: str) -> Column:
        around = F.zip_with(f"__{out}_pieces", F.slice(f"__{out}_pieces", 2, 1 << 30), lambda p, q: F.struct(p["before"].alias("before"), q["after"].alias("after")))
        placed = F.zip_with(out, f"__{out}_ends", lambda m, end: F.struct((end - F.length(m)).alias("start"), end.alias("end"), m.alias("m")))
        both = F.zip_with(placed, around, lambda x, y: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["m"].alias("m"),
                                                               y["before"].alias("before"), y["after"].alias("after")))
        return F.filter(both, lambda x: x["m"].isNotNull())

    df = df.withColumns({f"__{out}_pieces": pieces(out) for out in patterns})
    df = df.withColumns({out: found(out) for out in patterns}).drop("t")
    df = df.withColumns({f"__{out}_sizes": sizes(out) for out in patterns})
    df = _running(df, {f"__{out}_ends": f"__{out}_sizes" for out in patterns}, lambda a, b: a + b)
    return df.withColumns({out: spans(out) for out in patterns}).drop(*[f"__{out}_{x}" for out in patterns for x in ("pieces", "sizes", "ends")])


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(m: Column) -> Column:
    digits = F.regexp_extract_all(F.reverse(_digits(m)), F.lit("[0-9]"), F.lit(0))

    def weigh(d: Column, i: Column) -> Column:
        twice = d.cast("int") * (i % 2 + 1)
        return F.when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.transform(digits, weigh), F.lit(0), lambda a, x: a + x) % 10 == 0


def _passes(kind: str, m: Column) -> Column:
    """The rule of a base match."""
    if kind == "ip":
        return F.forall(F.regexp_extract_all(m, F.lit("[0-9]+"), F.lit(0)),
                        lambda p: F.regexp_replace(p, "^0+", "").rlike("^(?:[0-9]{0,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    return _luhn(m) if kind == "card" else F.lit(True)


def _wide_kind(m: Column) -> Column:
    """Which of the wide forms a match is of."""
    return (F.when(m.rlike(r"[ \[(\x7B](?:at|AT)[ \])\x7D]"), "email").when(m.rlike(r":|\["), "ip")
            .when(m.rlike(r"^(?:(?:\+|00 ?)[1-9][0-9]{0,2}[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}$"), "phone").otherwise("card"))


def _vote(for_: Column, against: Column) -> Column:
    return F.when(for_, 2).when(against, 0).otherwise(1).cast("int")       # 1: no vote


def _form(kind: str, m: Column, base: bool) -> Column:
    if base:
        return F.lit(2)
    if kind == "email":
        return _vote(m.rlike(r"[\])\x7D]"), F.lit(False))
    if kind == "ip":
        return _vote(m.contains(":") | F.forall(F.regexp_extract_all(m, F.lit("[0-9]+"), F.lit(0)), lambda p: p.cast("int") <= 255), F.lit(True))
    if kind == "card":
        return _vote(_luhn(m), F.lit(True))
    return _vote(m.rlike(r"^(?:00|\+|\()"), F.lit(False))


def _gazetteer(kind: str, m: Column) -> Column:
    if kind == "email":
        known = F.lower(F.regexp_extract(m, "([A-Za-z0-9-]+)$", 1)).isin(TOP_LEVEL)
        return _vote(known, F.lit(True))
    if kind == "ip":
        return _vote(~m.rlike(RESERVED), F.lit(False))
    digits = _digits(m)
    if kind == "card":
        return _vote(digits.rlike(ISSUERS), F.lit(True))
    code = F.regexp_replace(digits, "^00", "")
    international = m.rlike(r"^(?:\+|00)")
    known = F.substring(code, 1, 1).isin(DIALLING) | F.substring(code, 1, 2).isin(DIALLING) | F.substring(code, 1, 3).isin(DIALLING)
    return _vote(F.when(international, known).otherwise(~digits.rlike("^[01]")), F.lit(True))


def _class_of(c: Column) -> Column:
    return F.when(c == "", 0).when(c.rlike(r"^\s$"), 1).when(c.rlike(r"^[\p{L}0-9_]$"), 3).otherwise(2).cast("int")


def _candidate(kind: str, x: Column, base: bool) -> Column:
    """A candidate's place, votes and shape."""
    m, before = x["m"], F.lower(x["before"])
    left, right = F.right(x["before"], F.lit(1)), F.left(x["after"], F.lit(1))
    gaps = F.length(F.regexp_replace(m, "[A-Za-z0-9]", ""))
    return F.struct(
        x["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), x["end"].alias("end"), F.lit(base).alias("base"),
        _form(kind, m, base).alias("form"), _gazetteer(kind, m).alias("gazetteer"),
        _vote(before.rlike(ANNOUNCED[kind]), F.lit(False)).alias("announced"),
        _vote(F.lit(False), before.rlike(rf"(?:{OTHER})[^\n]{{0,12}}$")).alias("other"),
        _vote(F.lit(False), left.rlike(r"[\p{L}0-9_=/#]") | right.rlike(r"[\p{L}0-9_=/#]")).alias("joined"),
        F.least((F.length(m) / (10 if kind == "email" else 4)).cast("int"), F.lit(LENGTHS - 1)).alias("length"),
        _class_of(left).alias("left"), _class_of(right).alias("right"),
        F.least(gaps, F.lit(SEPARATORS - 1)).cast("int").alias("gaps"))


FEATURES = {"form": 3, "gazetteer": 3, "announced": 3, "other": 3, "joined": 3, "length": LENGTHS, "left": LEFTS, "right": RIGHTS,
            "gaps": SEPARATORS}


def candidates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and ``spans``, the sorted candidates of each document (base ones and the wide ones that overlap none of them)."""
    df = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    digit = F.col("t").rlike("[0-9]")
    possible = {"email": F.contains("t", F.lit("@")), "phone": F.contains("t", F.lit("+"))}
    every = "|".join(f"(?:{WIDE[k]})" for k in KINDS)
    df = _located(df, {**{k: (PATTERNS[k], possible.get(k, digit)) for k in KINDS}, "wide": (every, digit | F.col("t").rlike(r"[ \[(\x7B](?:at|AT)[ \])\x7D]"))})

    def strict(kind: str) -> Column:
        return F.transform(F.filter(kind, lambda x: _passes(kind, x["m"])), lambda x: _candidate(kind, x, True))

    def loose(kind: str) -> Column:
        return F.transform(F.filter("wide", lambda x: _wide_kind(x["m"]) == kind), lambda x: _candidate(kind, x, False))

    df = df.select("doc_id", F.array_sort(F.concat(*map(strict, KINDS), *map(loose, KINDS))).alias("all"))
    df = df.withColumn("ends", F.transform("all", lambda x: F.when(x["base"], x["end"]).otherwise(F.lit(0)).cast("long")))
    df = _running(df, {"covered": "ends"}, lambda a, b: F.greatest(a, b))

    # a wide candidate stays if no base one overlaps it; wide ones are apart from each other
    earlier = F.zip_with("all", F.concat(F.array(F.lit(0).cast("long")), F.col("covered")), lambda x, c: F.struct(x.alias("x"), c.alias("covered")))
    judged = F.zip_with(earlier, F.transform(F.slice("all", 2, 1 << 30), lambda x: x["start"]), lambda e, after: F.struct(e["x"].alias("x"), (
        e["x"]["base"] | ((e["covered"] <= e["x"]["start"]) & F.coalesce(after >= e["x"]["end"], F.lit(True)))).alias("stays")))
    return df.select("doc_id", F.transform(F.filter(judged, lambda j: j["x"].isNotNull() & j["stays"]), lambda j: j["x"]).alias("spans"))


def reliabilities(counts: dict[tuple[int, ...], int], rounds: int = 60) -> tuple[float, list, dict[tuple[int, ...], float]]:
    """Expectation-maximisation over vote patterns of one kind: (share of personal data, P(vote | class) for each labeler, probability of
    each pattern).  A prior of a few votes says that labelers are right more often than not (most of all
    the form, which has the check digits), so the classes cannot change places."""
    n = len(LABELERS)
    prior = [[[4.0, 4.0, 1.0], [1.0, 4.0, 4.0]] for _ in range(n)]        # [class][against, none, for]
    prior[0] = [[36.0, 4.0, 4.0], [0.5, 4.0, 36.0]]     # check digits and number ranges: a random number passes a tenth of the time
    share, table = 0.5, [[[x / sum(c) for x in c] for c in own] for own in prior]
    prob: dict[tuple[int, ...], float] = {}
    for _ in range(rounds):
        for votes in counts:
            no, yes = math.log(1 - share), math.log(share)
            for j, v in enumerate(votes):
                no += math.log(table[j][0][v])
                yes += math.log(table[j][1][v])
            prob[votes] = 1 / (1 + math.exp(min(700.0, no - yes)))
        total = sum(counts.values())
        share = (1 + sum(counts[v] * prob[v] for v in counts)) / (2 + total)
        for j in range(n):
            for c in (0, 1):
                weight = list(prior[j][c])
                for votes, k in counts.items():
                    weight[votes[j]] += k * (prob[votes] if c else 1 - prob[votes])
                table[j][c] = [w / sum(weight) for w in weight]
    return share, table, prob


def _logistic(x: np.ndarray, target: np.ndarray, weight: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Weights of a ridge logistic regression on probabilities, by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (p - target)) + ridge * w
        hessian = (x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit(spans: DataFrame) -> dict[str, list[float]]:
    """Weights of the span classifier: for each feature one number a kind and level, kinds first; ``bias`` one a kind."""
    patterns = spans.select(F.explode("spans").alias("x")).groupBy("x.kind", *[F.col(f"x.{f}") for f in FEATURES]).count().collect()
    weights = {f: [0.0] * (len(KINDS) * n) for f, n in FEATURES.items()}
    weights["bias"] = [-1.0] * len(KINDS)
    for kind in range(len(KINDS)):
        own = sorted((tuple(r[f] for f in FEATURES), r["count"]) for r in patterns if r["kind"] == kind)
        if not own:
            continue
        votes: dict[tuple[int, ...], int] = {}
        for key, k in own:
            votes[key[:len(LABELERS)]] = votes.get(key[:len(LABELERS)], 0) + k
        prob = reliabilities(votes)[2]
        x = np.concatenate([np.eye(n)[[key[j] for key, _ in own]] for j, n in enumerate(FEATURES.values())] + [np.ones((len(own), 1))], 1)
        k = np.array([c for _, c in own], dtype=np.float64)
        w = _logistic(x, np.array([prob[key[:len(LABELERS)]] for key, _ in own]), k / max(1.0, k.sum() / 10_000))
        at = 0
        for f, n in FEATURES.items():
            weights[f][kind * n:(kind + 1) * n] = w[at:at + n].tolist()
            at += n
        weights["bias"][kind] = float(w[-1])
    return weights


def _margin(x: Column, weights: dict[str, list[float]]) -> Column:
    total = F.get(F.lit(weights["bias"]), x["kind"])
    for f, n in FEATURES.items():
        total = total + F.get(F.lit(weights[f]), x["kind"] * n + x[f])
    return total


def decide(spans: DataFrame, weights: dict[str, list[float]], add_from: float = ADD_FROM) -> DataFrame:
    """doc_id and ``found``: the base spans and the wide ones that the classifier accepts, sorted, each (start, kind, end, base)."""
    least = math.log(add_from / (1 - add_from))
    kept = F.filter("spans", lambda x: x["base"] | (_margin(x, weights) >= least))
    return spans.select("doc_id", F.transform(kept, lambda x: F.struct(x["start"], F.get(F.lit(list(KINDS)), x["kind"]).alias("kind"),
                                                                       x["end"], x["base"])).alias("found"))


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and ``found`` of every document; labelers' reliabilities and classifier are fitted on all of them."""
    spans = materialize(candidates(docs, doc_id, text), "spans")
    return decide(spans, fit(spans))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def _is(kind: str):
    return lambda x: x["base"] & (x["kind"] == kind)


def digests(found: DataFrame) -> DataFrame:
    """The contract's columns from ``find``'s rows."""
    base = F.filter("found", lambda x: x["base"])
    counts = [F.size(F.filter("found", _is(kind))).cast("long").alias(f"n_{kind}") for kind in KINDS]
    return found.select("doc_id", *counts, F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"), _joined(F.col("found")).alias("spans"))
