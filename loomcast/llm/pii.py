"""Personal data by weak supervision, with DataFrame functions only.

Patterns propose candidate spans: the strict base patterns and looser ones (spelled-out
mail addresses, national phone numbers, defanged addresses, dotted card numbers). Five
labelers vote on each candidate: format, gazetteer, context, plausibility, boundary.
Expectation-maximisation over the counts of vote patterns estimates how reliable each
labeler is and how likely each pattern is personal data; these likelihoods train a naive
Bayes classifier on span features, which decides on the loose candidates. Base spans
always stay.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomcast.llm.common import keep

KINDS = ("email", "ip", "card", "phone")

# A match can begin at the end of the last one or where a run of its first class begins,
# and runs never give back what they took: linear time on any text, same matches.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "email": r"(?i)(?:\G|(?<![a-z0-9._%+-]))[a-z0-9._%+-]++ ?(?:\(at\)|\[at\]|\{at\}|(?<= )at(?= )) ?[a-z0-9-]++"
    r"(?: ?(?:\(dot\)|\[dot\]|\{dot\}|(?<= )dot(?= )) ?[a-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]{1,3}(?:(?:\[\.\]|\(\.\))[0-9]{1,3}){3}(?![0-9])",
    "card": r"(?<![0-9._/])[0-9]{4}(?:[._/][0-9]{4}){3}(?![0-9._/])",
    "phone": r"(?<![0-9+(.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9-])"
    r"|(?<![0-9])00[1-9](?:[ ().-]?[0-9]){8,13}(?![0-9])",
}
#: A text without this has no match; looked for first, since it is cheap to find.
GATE = {
    ("email", True): lambda t: F.contains(t, F.lit("@")),
    ("ip", True): lambda t: F.rlike(t, F.lit(r"[0-9]\.[0-9]")),
    ("card", True): lambda t: F.rlike(t, F.lit(r"[0-9]")),
    ("phone", True): lambda t: F.contains(t, F.lit("+")),
    ("email", False): lambda t: F.rlike(t, F.lit(r"(?i)[\[({ ]dot[\])} ]")),
    ("ip", False): lambda t: F.rlike(t, F.lit(r"[0-9][\[(]\.")),
    ("card", False): lambda t: F.rlike(t, F.lit(r"[0-9]{4}[._/][0-9]{4}")),
    ("phone", False): lambda t: F.rlike(t, F.lit(r"[0-9]{3}[ .)-]|00[1-9]")),
}
# The gazetteers and context words.
TOP_DOMAINS = "com org net edu gov io info biz eu uk de fr es it nl ch at be pl se us ca au jp cn in br".split()
CARD_PREFIX = r"^(4|5[1-5]|2[2-7]|34|37|35|36|38|6011|62|64|65)"
PHONE_PREFIX = r"^(1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
WORDS_FOR = {
    "email": "mail|e-mail|email|contact|write|reach",
    "ip": "ip|host|server|address|addr|from|client",
    "card": "card|visa|mastercard|amex|credit|payment",
    "phone": "phone|tel|call|mobile|cell|fax|whatsapp|sms",
}
WORDS_AGAINST = {
    "email": "package|version|repo",
    "ip": "version|release|section|chapter|v",
    "card": "isbn|order|invoice|serial|commit|id|ref",
    "phone": "isbn|order|invoice|serial|version|pages|id|ref",
}
TAG = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]"}

#: Characters of context kept before and after a candidate.
BEFORE, AFTER = 24, 8
#: A loose candidate becomes a span from this probability on.
SURE = 0.9
EM_ROUNDS = 50
LABELERS = 5
#: The labelers whose opinions are features, and the classes of a character beside a span.
OPINIONS = ("gazetteer", "context", "plausible", "boundary")
SIDES = 5


def digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a short string of digits passes the check sum."""

    def value(place: Column) -> Column:
        digit = F.substring(number, F.length(number) - place, 1).cast("int")
        twice = F.when(place % 2 == 1, 2 * digit).otherwise(digit)
        return F.when(twice > 9, twice - 9).otherwise(twice)

    places = F.sequence(F.lit(0), F.length(number) - 1)
    return F.aggregate(F.transform(places, value), F.lit(0), lambda a, x: a + x) % 10 == 0


def parts_fit(match: Column) -> Column:
    """Whether all four numbers are at most 255."""
    numbers = F.transform(F.regexp_extract_all(match, F.lit("[0-9]+"), F.lit(0)), lambda p: F.ltrim(p, F.lit("0")))
    return F.forall(numbers, lambda p: (F.length(p) <= 3) & (F.coalesce(F.try_to_number(F.concat(F.lit("0"), F.left(p, F.lit(3))), F.lit("0000")), F.lit(0)) <= 255))


def passes(kind: str, match: Column) -> Column:
    """The check that a match of the kind's base pattern must pass."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return parts_fit(match)
    number = digits(match)
    if kind == "phone":
        return F.length(number).between(9, 15)
    return F.when(F.length(number).between(12, 19), luhn(number)).otherwise(False)


def candidates(text: Column, kind: str, base: bool) -> Column:
    """Matches in order: array of (match, gap before it, context before, context after)."""
    pattern = F.lit((BASE if base else LOOSE)[kind])
    gaps = F.split(text, (BASE if base else LOOSE)[kind], -1)
    cut = F.transform(
        gaps,
        lambda g: F.struct(
            F.length(g).alias("gap"), F.right(g, F.lit(BEFORE)).alias("before"), F.left(g, F.lit(AFTER)).alias("after")
        ),
    )
    found = F.arrays_zip(F.regexp_extract_all(text, pattern, F.lit(0)).alias("match"), cut.alias("cut"), F.slice(cut, F.lit(2), F.size(cut)).alias("next"))
    rows = F.transform(
        F.filter(found, lambda z: z["match"].isNotNull()),
        lambda z: F.struct(
            z["match"].alias("match"), z["cut"]["gap"].alias("gap"), z["cut"]["before"].alias("before"), z["next"]["after"].alias("after")
        ),
    )
    none = F.array().cast("array<struct<match:string,gap:int,before:string,after:string>>")
    return F.when(GATE[kind, base](text), rows).otherwise(none)


def votes(kind: str, base: bool, match: Column, before: Column, after: Column) -> list[Column]:
    """1, 0 (no opinion) or -1 of each labeler: format, gazetteer, context, plausibility, boundary."""
    yes = lambda c: F.when(c, 1).otherwise(-1)
    number = digits(match)
    form = yes(passes(kind, match)) if base else F.lit(0)
    if kind == "email":
        last = F.lower(F.regexp_extract(match, "([A-Za-z0-9-]+)$", 1))
        known, sound = yes(last.isin(TOP_DOMAINS)), yes(F.rlike(last, F.lit("^[a-z]{2,10}$")))
    elif kind == "ip":
        first = F.regexp_extract(match, "^0*([0-9]*)", 1)
        known, sound = yes(~F.rlike(first, F.lit("^(|0|127|22[4-9]|2[3-9][0-9])$"))), yes(parts_fit(match))
    elif kind == "card":
        known = yes(F.rlike(number, F.lit(CARD_PREFIX)))
        sound = yes(F.when(F.length(number).between(12, 19), luhn(number)).otherwise(False))
    else:
        known = F.when(F.rlike(F.ltrim(number, F.lit("0")), F.lit(PHONE_PREFIX)), 1).otherwise(0)
        sound = yes(F.length(number).between(9, 13))
    near = F.lower(before)
    told = F.when(F.rlike(near, F.lit(rf"\b({WORDS_FOR[kind]})\b")), 1).when(F.rlike(near, F.lit(rf"\b({WORDS_AGAINST[kind]})\b")), -1).otherwise(0)
    free = ~F.rlike(before, F.lit(r"[\p{L}\p{N}]$")) & ~F.rlike(after, F.lit(r"^[\p{L}\p{N}]"))
    return [form, known, told, sound, yes(free)]


def features(votes: Column, before: Column, after: Column) -> list[Column]:
    """Span features as short strings, which base and loose forms share: opinions and the characters on both sides.

    A labeler without an opinion says nothing; the format's vote is left out, as it
    belongs to base forms alone.
    """

    def side(text: Column, pattern: str) -> Column:
        edge = F.regexp_extract(text, pattern, 1)
        return (
            F.when(edge == "", "end").when(F.rlike(edge, F.lit(r"\p{L}")), "letter")
            .when(F.rlike(edge, F.lit(r"\p{N}")), "digit").when(F.rlike(edge, F.lit(r"\s")), "space").otherwise("other")
        )

    opinions = [F.concat(F.lit(f"{name} "), votes[k + 1].cast("string")) for k, name in enumerate(OPINIONS)]
    return [*opinions, F.concat(F.lit("before "), side(before, r"(?s)(.)$")), F.concat(F.lit("after "), side(after, r"(?s)^(.)"))]


def feature_weights(counts: dict[str, tuple[float, float]]) -> dict[str, float]:
    """Log odds of each feature value from its soft counts (personal data, other).

    Opinions start from a few votes that lean to labelers being better than chance. A side's
    characters start from no difference between the classes, so without any counter-example
    they say nothing.
    """
    weights: dict[str, float] = {}
    for name in OPINIONS:
        yes, no = ({v: counts.get(f"{name} {v}", (0.0, 0.0))[c] for v in (1, -1)} for c in (0, 1))
        for v in (1, -1):
            lean = (3, 1) if v == 1 else (1, 3)
            weights[f"{name} {v}"] = math.log((yes[v] + lean[0]) / (sum(yes.values()) + 4)) - math.log((no[v] + lean[1]) / (sum(no.values()) + 4))
    for name in ("before", "after"):
        own = {k: c for k, c in counts.items() if k.startswith(name + " ")}
        yes, no = (sum(c[k] for c in own.values()) for k in (0, 1))
        for key, (y, x) in own.items():
            share = (y + 1) / (yes + SIDES)
            weights[key] = math.log(share) - math.log((x + SIDES * share) / (no + SIDES))
    return weights


@dataclass(frozen=True)
class SpanModel:
    """By kind: how often each labeler's votes are right, and the classifier's log odds."""

    reliability: dict[str, list[float]]
    weights: dict[str, dict[str, float]]

    def sure(self, kind: str, votes: Column, before: Column, after: Column) -> Column:
        """Whether a loose candidate is personal data. Both classes count as equally likely beforehand:
        how common base forms are says nothing about loose ones."""
        weights = self.weights.get(kind, {})
        if not weights:
            return F.lit(False)
        table = F.create_map(*[F.lit(x) for pair in sorted(weights.items()) for x in pair])
        score = F.lit(0.0)
        for name in features(votes, before, after):
            score = score + F.coalesce(F.try_element_at(table, name), F.lit(0.0))
        return score >= math.log(SURE / (1 - SURE))


def em(patterns: list[tuple[tuple[int, ...], int]], fixed: dict[int, float] | None = None, rounds: int = EM_ROUNDS):
    """Vote patterns with counts -> (likelihood of each pattern, prior, reliabilities).

    Two classes; each labeler has its own chance of voting 1 rather than -1 in either
    class, and says nothing by 0. Starts from the balance of votes; counts get a prior of
    a few votes that leans to labelers being better than chance. ``fixed``: likelihoods by the
    first labeler's vote, which anchor the classes where the format decides.
    """
    fixed = fixed or {}
    total = sum(n for _, n in patterns)
    likely = [fixed.get(v[0], min(0.95, max(0.05, 0.5 + 0.5 * sum(v) / LABELERS))) for v, _ in patterns]
    prior, chance = 0.5, {}
    for _ in range(rounds):
        mass = sum(p * n for p, (_, n) in zip(likely, patterns))
        prior = (mass + 1) / (total + 2)
        for k in range(LABELERS):
            for truth in (1, 0):
                seen = {1: 2.0 if truth else 1.0, -1: 1.0 if truth else 2.0}
                for p, (v, n) in zip(likely, patterns):
                    if v[k]:
                        seen[v[k]] += n * (p if truth else 1 - p)
                # a labeler is no worse than chance in either class, or the classes could change places
                wrong = min(0.5, seen[-1 if truth else 1] / sum(seen.values()))
                chance[k, truth] = {1: 1 - wrong, -1: wrong} if truth else {1: wrong, -1: 1 - wrong}
        for i, (v, _) in enumerate(patterns):
            if v[0] not in fixed:
                odds = math.log(prior / (1 - prior))
                odds += sum(math.log(chance[k, 1][v[k]] / chance[k, 0][v[k]]) for k in range(LABELERS) if v[k])
                likely[i] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
    right = [prior * chance[k, 1][1] + (1 - prior) * chance[k, 0][-1] if chance else 0.5 for k in range(LABELERS)]
    return likely, prior, right


def propose(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(rows, spans): every row's _row and doc_id; every candidate with its place and votes."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    slim = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("doc_id"), text.alias("_t"))
    lists = [
        F.when(F.size(c) > 0, F.array(F.struct(F.lit(kind).alias("kind"), F.lit(base).alias("base"), c.alias("found"))))
        for kind in KINDS
        for base in (True, False)
        for c in [candidates(F.col("_t"), kind, base)]
    ]
    empty = F.array().cast("array<struct<kind:string,base:boolean,found:array<struct<match:string,gap:int,before:string,after:string>>>>")
    # one pass over the texts; from here on only the candidates move
    rows = keep(slim.select("_row", "doc_id", F.flatten(F.array(*[F.coalesce(c, empty) for c in lists])).alias("lists")), "candidates")
    each = rows.select("_row", F.explode("lists").alias("l")).select("_row", "l.kind", "l.base", F.posexplode("l.found").alias("_i", "f"))
    size = F.length("f.match").cast("long")
    upto = Window.partitionBy("_row", "kind", "base").orderBy("_i").rowsBetween(Window.unboundedPreceding, 0)
    placed = each.withColumn("end", F.sum(F.col("f.gap") + size).over(upto))
    spans = placed.select(
        "_row", "kind", "base", (F.col("end") - size).alias("start"), "end",
        F.col("f.match").alias("match"), F.col("f.before").alias("before"), F.col("f.after").alias("after"),
    )
    return rows.select("_row", "doc_id"), keep(uncovered(judged(spans)), "spans")


def uncovered(spans: DataFrame) -> DataFrame:
    """All base matches, and the loose ones that overlap no base span of any kind."""
    line = Window.partitionBy("_row").orderBy("start", "end", "kind", "base")
    past, ahead = line.rowsBetween(Window.unboundedPreceding, -1), line.rowsBetween(1, Window.unboundedFollowing)
    reach = F.max(F.when(F.col("valid"), F.col("end"))).over(past)
    coming = F.min(F.when(F.col("valid"), F.col("start"))).over(ahead)
    clear = (F.coalesce("_reach", F.lit(-1)) <= F.col("start")) & (F.coalesce(F.col("_coming"), F.col("end")) >= F.col("end"))
    return spans.withColumns({"_reach": reach, "_coming": coming}).filter(F.col("base") | clear).drop("_reach", "_coming")


def _by_kind(build) -> Column:
    """``build(kind, base)`` for each row's own kind and pattern."""
    out = None
    for kind in KINDS:
        for base in (True, False):
            here = (F.col("kind") == kind) & (F.col("base") == base)
            out = F.when(here, build(kind, base)) if out is None else out.when(here, build(kind, base))
    return out


def judged(spans: DataFrame) -> DataFrame:
    """Adds the votes, and ``valid``: a base match that passes its check."""
    own = (F.col("match"), F.col("before"), F.col("after"))
    return spans.withColumn("votes", _by_kind(lambda kind, base: F.array(*votes(kind, base, *own)))).withColumn(
        "valid", F.col("base") & (F.col("votes")[0] == 1)
    )


def learn(spans: DataFrame) -> SpanModel:
    """Fit on all candidates. Only counts reach the driver: at most 4 x 3^5 vote patterns, and
    the counts of feature values, of which there are a few thousand at most."""
    counted = spans.groupBy("kind", "votes").agg(F.count(F.lit(1)).alias("n")).collect()
    reliability, likely = {}, []
    for kind in KINDS:
        patterns = sorted((tuple(r["votes"]), r["n"]) for r in counted if r["kind"] == kind)
        if patterns:
            found, _, reliability[kind] = em(patterns, {1: 0.98, -1: 0.02})
            likely += [(kind, list(v), p) for (v, _), p in zip(patterns, found)]
    if not likely:
        return SpanModel({}, {})
    given = spans.sparkSession.createDataFrame(likely, "kind string, votes array<int>, likely double")
    soft = spans.join(F.broadcast(given), ["kind", "votes"]).select(
        "kind", "likely", F.array(*features(F.col("votes"), F.col("before"), F.col("after"))).alias("f")
    )
    sums = soft.select("kind", F.explode("f").alias("name"), "likely").groupBy("kind", "name")
    sums = sums.agg(F.round(F.sum("likely"), 6).alias("yes"), F.round(F.sum(1 - F.col("likely")), 6).alias("no")).collect()
    weights = {}
    for kind in KINDS:
        own = {r["name"]: (r["yes"], r["no"]) for r in sums if r["kind"] == kind}
        if own:
            weights[kind] = feature_weights(own)
    return SpanModel(reliability, weights)


def accepted(spans: DataFrame, model: SpanModel) -> DataFrame:
    """(_row, kind, start, end, valid): base spans, and sure loose ones, of overlapping ones of a kind the first."""
    own = (F.col("votes"), F.col("before"), F.col("after"))
    sure = _by_kind(lambda kind, base: F.lit(False) if base else model.sure(kind, *own))
    good = spans.withColumn("_sure", sure).filter("valid or _sure")
    before = Window.partitionBy("_row", "kind").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    good = good.withColumn("_to", F.max("end").over(before))
    clear = F.coalesce("_to", F.lit(-1)) <= F.col("start")
    return good.filter(F.col("valid") | clear).select("_row", "kind", "start", "end", "valid")


def _written(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", F.element_at(F.array(*map(F.lit, KINDS)), s["k"]), s["start"], s["end"])))


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added.

    The four counts and the digest are of base spans: leftmost matches of the base patterns
    that pass their checks. ``spans`` lists these and the n_added spans that the trained
    classifier adds, as kind:start:end in code points, end exclusive, by start and then
    kind. Null text counts as empty; texts without a match have zero counts, the digest
    of the empty string and empty spans. Repeated rows and null ids each get their own row.
    Other columns are ignored, whatever their names. An empty table gives an empty result.
    """
    rows, spans = propose(docs, id_col, text_col)
    good = accepted(spans, learn(spans))
    place = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int")
    item = F.struct("start", place.alias("k"), "end")
    counts = [F.count(F.when(F.col("valid") & (F.col("kind") == kind), 1)).alias(f"n_{kind}") for kind in KINDS]
    lists = good.groupBy("_row").agg(
        *counts,
        F.sort_array(F.collect_list(F.when(F.col("valid"), item))).alias("base"),
        F.sort_array(F.collect_list(item)).alias("every"),
    )
    none = F.array().cast("array<struct<start:bigint,k:int,end:bigint>>")
    return rows.join(lists, "_row", "left").select(
        "doc_id",
        *[F.coalesce(f"n_{kind}", F.lit(0).cast("long")).alias(f"n_{kind}") for kind in KINDS],
        F.sha2(_written(F.coalesce("base", none)), 256).alias("base_sha256"),
        _written(F.coalesce("every", none)).alias("spans"),
        (F.size(F.coalesce("every", none)) - F.size(F.coalesce("base", none))).cast("long").alias("n_added"),
    )


def _replaced(text: Column, kind: str, base: bool, model: SpanModel) -> Column:
    def shown(z: Column) -> Column:
        if base:
            good = passes(kind, z["match"])
        else:
            opinions = F.array(*votes(kind, base, z["match"], z["before"], z["after"]))
            good = model.sure(kind, opinions, z["before"], z["after"])
        return F.when(good, F.lit(TAG[kind])).otherwise(z["match"])

    pieces = F.zip_with(
        F.split(text, (BASE if base else LOOSE)[kind], -1),
        F.transform(candidates(text, kind, base), shown),
        lambda gap, word: F.concat(gap, F.coalesce(word, F.lit(""))),
    )
    return F.when(GATE[kind, base](text), F.array_join(pieces, "")).otherwise(text)


def redact(docs: DataFrame, model: SpanModel, text_col: str = "text") -> DataFrame:
    """``docs`` with personal data in ``text_col`` replaced by its kind in brackets.

    Base patterns come first, then the loose ones as the model decides; kinds are replaced
    one after another. Null texts stay null, and all other columns stay as they were.
    """
    for base in (True, False):
        for kind in KINDS:
            docs = docs.withColumn(text_col, _replaced(F.col(text_col), kind, base, model))
    return docs
