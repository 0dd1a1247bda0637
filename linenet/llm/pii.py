"""Personal data: exact base patterns, and weakly supervised further spans. Spark expressions only."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linenet.llm.scratch import written

KINDS = ["email", "ip", "card", "phone"]

# The base patterns. Possessive repeats and marks of where a run begins change no match; they keep the time
# in proportion to the text. A card's run has 16 to 19 digits, so other runs can be left out at once.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){15,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
# Further candidates, for the labelers to judge.
MORE = {
    "email": r"(?i)\b[a-z0-9._%+-]{1,64}+ ?(?:\(at\)|\[at\]) ?[a-z0-9-]++(?: ?(?:\(dot\)|\[dot\]|\.) ?[a-z0-9-]++)++",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){12,14}+(?![ -]?[0-9])",
    "phone": r"(?<![0-9+.)-])(?<![0-9] )\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9.-])",
}
# Only texts with one of these are searched for the pattern.
SIGN = {"email": "@", "phone": "+"}

# Words of the labelers.
TOP_DOMAINS = "com org net edu gov info io eu de fr es it nl uk ch at be pl us ca".split()
COUNTRY_CODES = "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 54 55 56 57 60 61 62 63 64 65 66 81 82 84 86 90 91".split()
ISSUERS = "34 36 37 38 4 51 52 53 54 55 6011 62 65".split()
FOR = {
    "email": "mail|e-mail|contact|kontakt|contacto|courriel|correo|write to",
    "ip": "ip|host|server|serveur|servidor|address|adresse",
    "card": "card|karte|carte|tarjeta|visa|mastercard|amex|credit",
    "phone": "phone|tel|telefon|telephone|teléfono|call|mobile|fax|handy",
}
AGAINST = {
    "email": "version|commit",
    "ip": "version|release|section|chapter|build|v",
    "card": "isbn|order|invoice|serial|tracking|id|ean",
    "phone": "isbn|order|invoice|serial|tracking|id|version",
}
CONTEXT = 40
VOTERS = ["regex", "gazetteer", "context"]


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(match: Column) -> Column:
    digits = F.reverse(_digits(match))

    def value(i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        return F.when(i % 2 == 1, d).otherwise(2 * d - F.when(d > 4, 9).otherwise(0))

    return F.aggregate(F.transform(F.sequence(F.lit(1), F.length(digits)), value), F.lit(0), lambda a, b: a + b) % 10 == 0


def _octets_fit(match: Column) -> Column:
    return match.rlike(r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?:\.|$)){4}$")


def _valid(kind: str, match: Column) -> Column:
    """Whether a match of a base pattern counts."""
    if kind == "ip":
        return _octets_fit(match)
    if kind == "card":
        return _luhn(match)
    if kind == "phone":
        return F.length(_digits(match)).between(8, 15)
    return F.lit(True)


def _regex_vote(kind: str, match: Column, base: bool) -> Column:
    if kind == "card":
        return F.when(_luhn(match), 1).otherwise(0)
    if kind == "phone":
        return F.when(F.length(_digits(match)).between(10, 15), 1).otherwise(F.lit(None).cast("int"))
    return F.lit(1 if base else None).cast("int")


def _gazetteer_vote(kind: str, match: Column) -> Column:
    if kind == "email":
        return F.when(F.lower(F.regexp_extract(match, r"([A-Za-z0-9-]+)$", 1)).isin(TOP_DOMAINS), 1).otherwise(0)
    if kind == "ip":
        return F.when(match.rlike(r"^0*(?:0|127|2[3-5][0-9])\."), 0).otherwise(F.lit(None).cast("int"))
    if kind == "card":
        return F.when(_digits(match).rlike("^(?:" + "|".join(ISSUERS) + ")"), 1).otherwise(0)
    coded = match.rlike(r"^\+(?:" + "|".join(COUNTRY_CODES) + r")(?![A-Za-z])")
    return F.when(coded, 1).when(match.startswith("+"), 0).otherwise(F.lit(None).cast("int"))


def _context_vote(kind: str, before: Column) -> Column:
    word = lambda words: r"(?i)(?<![\p{L}])(?:" + words + r")(?![\p{L}])"
    return F.when(before.rlike(word(FOR[kind])), 1).when(before.rlike(word(AGAINST[kind])), 0).otherwise(F.lit(None).cast("int"))


SPAN = "struct<kind:int,start:int,end:int,base:boolean,regex:int,gazetteer:int,context:int,shape:int>"


def _spans(text: Column, kind: str, pattern: str, base: bool) -> Column:
    """The matches of a pattern with their places in code points and the votes on them.

    Splitting at the matches gives what lies between them, so places are running sums of lengths.
    """
    none = F.array().cast(f"array<{SPAN}>")
    parts = F.arrays_zip(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("match"), F.split(text, pattern, -1).alias("gap"))

    def step(acc: Column, part: Column) -> Column:
        match, start = part["match"], acc["at"] + F.length(part["gap"])
        before = F.substring(part["gap"], -CONTEXT, CONTEXT)
        span = F.struct(
            F.lit(KINDS.index(kind)).alias("kind"), start.alias("start"), (start + F.length(match)).alias("end"), F.lit(base).alias("base"),
            _regex_vote(kind, match, base).alias("regex"), _gazetteer_vote(kind, match).alias("gazetteer"), _context_vote(kind, before).alias("context"),
            F.least(F.lit(3), F.length(F.regexp_replace(match, r"[\p{L}\p{N}]", ""))).alias("shape"),
        ).cast(SPAN)
        counts = match.isNotNull() & (_valid(kind, match) if base else F.lit(True))
        return F.struct((start + F.coalesce(F.length(match), F.lit(0))).alias("at"), F.when(counts, F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"))

    found = F.aggregate(parts, F.struct(F.lit(0).alias("at"), none.alias("spans")), step, lambda acc: acc["spans"])
    sign = F.contains(text, F.lit(SIGN[kind])) if base and kind in SIGN else text.rlike(pattern)
    return F.when(sign, found).otherwise(none)


def candidates(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``found``, the valid base spans and the further candidates, of every row."""
    text = F.coalesce("text", F.lit(""))
    parts = [_spans(text, k, p, True) for k, p in BASE.items()] + [_spans(text, k, p, False) for k, p in MORE.items()]
    return docs.select("doc_id", F.concat(*parts).alias("found"))


@dataclass
class SpanModel:
    """Weights of the features of a span, named ``feature=value``; the sum's logistic is its probability."""

    reliability: dict[tuple[int, str], tuple[float, float]]
    weights: dict[str, float]


def _features(kind: int, votes: tuple, shape: int) -> list[str]:
    return [f"kind={kind}", f"shape={kind}:{shape}", *[f"{v}={kind}:{'-' if x is None else x}" for v, x in zip(VOTERS, votes)]]


def fit(found: DataFrame, rounds: int = 50, steps: int = 300) -> SpanModel:
    """Estimate the labelers' reliabilities by expectation-maximisation and train the span classifier.

    All that the fit needs is how often each pattern of kind, votes and shape occurs over all candidates of all
    texts: at most 2 * 4 * 3^3 * 4 rows. A labeler has, for each kind, a chance of voting for a true span and
    for a false one; abstaining tells nothing. Base spans count as true; the first guess of the chances weighs as
    much as half of the kind's candidates, so that labelers who always agree can't outvote the rest.
    The classifier is a logistic regression on kind, votes and shape
    that learns the posteriors, weighted by how often a pattern occurs.
    """
    span = F.explode("found").alias("s")
    counted = found.select(span).groupBy("s.kind", "s.base", "s.regex", "s.gazetteer", "s.context", "s.shape").count().collect()
    rows = sorted(((r.kind, (r.regex, r.gazetteer, r.context), r.shape, r["count"], r.base) for r in counted), key=str)
    rate = {(k, v): (0.9, 0.2) for k in range(len(KINDS)) for v in VOTERS}
    prior = dict.fromkeys(range(len(KINDS)), 0.5)
    posterior = [0.5] * len(rows)
    for _ in range(rounds):
        for i, (kind, votes, _, _, base) in enumerate(rows):
            odds = math.log(prior[kind] / (1 - prior[kind]))
            for name, vote in zip(VOTERS, votes):
                if vote is not None:
                    yes, no = rate[kind, name]
                    odds += math.log(yes / no) if vote else math.log((1 - yes) / (1 - no))
            posterior[i] = 0.99 if base else 1 / (1 + math.exp(-odds))
        for kind in prior:
            own = [(p, v, n, base) for p, (k, v, _, n, base) in zip(posterior, rows) if k == kind]
            more = sum(n for *_, n, base in own if not base)
            prior[kind] = (sum(p * n for p, _, n, base in own if not base) + 0.4 * (more + 2)) / (2 * more + 2)
            guess = 10 + 0.5 * sum(n for *_, n, _ in own)
            for j, name in enumerate(VOTERS):
                told = [(p, v[j], n) for p, v, n, _ in own if v[j] is not None]
                yes = (sum(p * v * n for p, v, n in told) + 0.9 * guess) / (sum(p * n for p, _, n in told) + guess)
                no = (sum((1 - p) * v * n for p, v, n in told) + 0.2 * guess) / (sum((1 - p) * n for p, _, n in told) + guess)
                rate[kind, name] = (min(0.99, max(yes, no + 0.01)), max(0.01, min(no, yes - 0.01)))
    weights: dict[str, float] = {}
    total = sum(r[3] for r in rows) or 1
    for _ in range(steps):
        slope: dict[str, float] = {}
        for (kind, votes, shape, n, _), aim in zip(rows, posterior):
            names = _features(kind, votes, shape)
            miss = (aim - 1 / (1 + math.exp(-sum(weights.get(f, 0.0) for f in names)))) * math.sqrt(n / total)
            for f in names:
                slope[f] = slope.get(f, 0.0) + miss
        for f, s in slope.items():
            weights[f] = weights.get(f, 0.0) * 0.999 + 0.5 * s
    return SpanModel(rate, weights)


def probability(span: Column, model: SpanModel) -> Column:
    """The classifier's probability of a span; a feature it never met counts nothing."""
    table = F.create_map(*[F.lit(x) for kv in sorted(model.weights.items()) for x in kv]) if model.weights else F.create_map(F.lit(""), F.lit(0.0))
    said = lambda c: F.coalesce(c.cast("string"), F.lit("-"))
    kind = span["kind"].cast("string")
    names = [F.concat(F.lit("kind="), kind), F.concat(F.lit("shape="), kind, F.lit(":"), said(span["shape"]))]
    names += [F.concat(F.lit(f"{v}="), kind, F.lit(":"), said(span[v])) for v in VOTERS]
    total = F.lit(0.0)
    for n in names:
        total = total + F.coalesce(F.try_element_at(table, n), F.lit(0.0))
    return 1 / (1 + F.exp(-total))


def find_pii(docs: DataFrame, least: float = 0.8) -> DataFrame:
    """``doc_id``, ``base`` and ``spans`` of every row.

    ``base`` are the base spans, in order of kind and start; ``spans`` also has further candidates that the
    classifier gives ``least`` or more and that touch no base span, in the same order. Both hold kind, start and
    end in code points, end exclusive. A null or empty text has no spans; repeated rows and a null ``doc_id`` are
    judged like any row; no rows give no rows; further columns are not returned.
    """
    found = written(candidates(docs), "pii")
    model = fit(found)
    base = F.filter("found", lambda s: s["base"])
    apart = lambda s: ~F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    more = F.filter("found", lambda s: ~s["base"] & (probability(s, model) >= least) & apart(s))
    name = F.array(*[F.lit(k) for k in KINDS])
    told = lambda spans: F.transform(F.array_sort(spans), lambda s: F.struct(F.get(name, s["kind"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return found.select("doc_id", told(base).alias("base"), told(F.concat(base, more)).alias("spans"))
