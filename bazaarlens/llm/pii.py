"""Personal data by weak supervision, with Spark's own functions only.

Strict patterns give the base spans. Looser patterns give further candidates. Four
labelers look at every candidate and say yes, no or nothing: the strict pattern, the
candidate's shape, a gazetteer (prefixes, endings) and its context (cue words before
it). Expectation-maximisation over the counts of vote patterns estimates how reliable
each labeler is for each kind, without labels. A naive Bayes span classifier over
votes, length and digits is then trained on those estimates, and decides which loose
candidates become spans.

The patterns of votes and features are few by construction (``MOST_PATTERNS``), so
only their counts reach the driver, however large the corpus.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlens.llm.common import filled, table, without

# The kinds of the base, in their order, then those the method adds.
KINDS = ["email", "ip", "card", "phone", "secret"]
# The strict patterns. Possessive quantifiers and the looks behind only
# skip attempts that cannot match, which keeps long runs of one class linear.
STRICT = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "email": r"\b[A-Za-z0-9._-]{1,64} ?[\[(] ?at ?[\])] ?[A-Za-z0-9-]{1,63}"
    r"(?: ?(?:\.|[\[(] ?dot ?[\])]) ?[A-Za-z0-9-]{1,63}){1,8}",
    "phone": r"(?<![0-9.+-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9.-])",
    "secret": r"(?<![A-Za-z0-9_-])(?=[A-Za-z_-]*[0-9])(?=[0-9_-]*[A-Za-z])[A-Za-z0-9_-]{16,128}(?![A-Za-z0-9_-])",
}
# Gazetteers and cue words.
GAZETTEER = {
    "email": r"(?i)(?:\.|dot ?[\])] ?)(?:com|org|net|edu|gov|io|info|de|fr|es|uk|eu|example|test)$",
    "ip": r"^(?:10|127|192\.168|172\.(?:1[6-9]|2[0-9]|3[01])|[1-9][0-9]{0,2})\.",
    "card": r"^[3-6]",
    "phone": r"^\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])",
    "secret": r"^(?:sk|pk|ghp|gho|xox[abp]|AKIA|ASIA|AIza|key|token)",
}
CUES = {
    "email": r"(?i)mail|contact|write|reach|addr",
    "ip": r"(?i)\bip\b|host|server|address|login",
    "card": r"(?i)card|visa|master|amex|pay|credit",
    "phone": r"(?i)tel|phone|call|fax|mobil|contact",
    "secret": r"(?i)key|token|secret|passw|api|auth",
}
#: Code points before a candidate in which cues count.
CONTEXT = 32
LABELERS = ["strict", "shape", "gazetteer", "context"]
#: kinds x votes (yes, no, nothing) of each labeler x lengths x digit counts
MOST_PATTERNS = len(KINDS) * 3 ** len(LABELERS) * 4 * 4
ROUNDS = 30


def _located(text: Column, pattern: str, kind: str, strict: bool) -> Column:
    """Leftmost non-overlapping matches with start and end in code points.

    What lies between matches and the matches themselves, in turn, give the places.
    """
    gaps = F.split(text, F.lit(pattern), -1)
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    steps = F.zip_with(
        F.slice(gaps, 1, F.size(hits)),
        hits,
        lambda gap, hit: F.struct(F.length(gap).alias("gap"), hit.alias("hit")),
    )
    nothing = F.array().cast("array<struct<start:int,end:int,hit:string>>")

    def step(so_far: Column, x: Column) -> Column:
        start = so_far["at"] + x["gap"]
        end = start + F.length(x["hit"])
        found = F.struct(start.alias("start"), end.alias("end"), x["hit"].alias("hit"))
        return F.struct(end.alias("at"), F.concat(so_far["out"], F.array(found)).alias("out"))

    places = F.aggregate(
        steps,
        F.struct(F.lit(0).alias("at"), nothing.alias("out")),
        step,
        lambda so_far: so_far["out"],
    )
    # most texts hold no such thing and are left after one look
    looks = {"email": text.contains("@"), "phone": text.contains("+")} if strict else {}
    guard = looks.get(kind, F.lit(True))
    if kind == "card":
        guard = text.rlike(r"[0-9](?:[\x20-]?[0-9]){13}")
    else:
        guard = guard & text.rlike(pattern)
    return F.when(guard, places).otherwise(nothing)


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, r"[^0-9]", "")


def _luhn(digits: Column) -> Column:
    backwards = F.reverse(digits)

    def worth(i: Column) -> Column:
        digit = F.substring(backwards, i, F.lit(1)).cast("int")
        twice = digit * 2
        return F.when(i % 2 == 1, digit).when(twice > 9, twice - 9).otherwise(twice)

    total = F.aggregate(
        F.transform(F.sequence(F.lit(1), F.length(digits)), worth), F.lit(0), lambda a, b: a + b
    )
    return total % 10 == 0


def _holds(kind: str, hit: Column) -> Column:
    """Whether a match of the strict pattern is a base span."""
    digits = _digits(hit)
    if kind == "ip":
        return F.forall(
            F.split(hit, r"\."),
            lambda part: F.regexp_replace(part, "^0+(?=[0-9])", "").rlike(
                "^(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"
            ),
        )
    if kind == "card":
        return F.when(F.length(digits).between(14, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, "+").when(no, "-").otherwise("0")


def _described(text: Column, kind: str, number: int, strict: bool) -> Callable[[Column], Column]:
    """From a match to a candidate: kind, place, whether base, votes and features."""

    def describe(x: Column) -> Column:
        hit, digits = x["hit"], F.length(_digits(x["hit"]))
        base = _holds(kind, hit) if strict else F.lit(False)
        before = F.substring(
            text,
            F.greatest(x["start"] - CONTEXT, F.lit(0)) + 1,
            F.least(x["start"], F.lit(CONTEXT)),
        )
        shape = {
            "email": ~hit.rlike(r"[._%+-]{2}"),
            "ip": ~hit.rlike(r"(?:^|\.)0[0-9]"),
            "card": hit.rlike(r"^(?:[0-9]{14,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{2,7})$"),
            "phone": ~hit.rlike(r"[ ().-]{3}"),
            # letters and digits mixed throughout, of one case or both
            "secret": hit.rlike(r"^(?:[0-9a-f]+|[A-Z0-9]+|[A-Za-z0-9]+)$") & (digits >= 2),
        }[kind]
        votes = F.concat(
            _vote(base, F.lit(strict)),
            _vote(shape, ~shape),
            _vote(hit.rlike(GAZETTEER[kind]), F.lit(kind == "card")),
            _vote(before.rlike(CUES[kind]), F.lit(False)),
            # features of the classifier: length and digits in four classes
            F.least(F.length(hit) / 8, F.lit(3)).cast("int").cast("string"),
            F.least(digits / 5, F.lit(3)).cast("int").cast("string"),
        )
        return F.struct(
            x["start"].alias("start"),
            F.lit(number).alias("number"),
            x["end"].alias("end"),
            F.lit(kind).alias("kind"),
            base.alias("base"),
            votes.alias("votes"),
        )

    return describe


def _candidates(text: Column) -> Column:
    """Every candidate of a text, by start and kind."""
    found = []
    for number, kind in enumerate(KINDS):
        for strict, patterns in ((True, STRICT), (False, LOOSE)):
            if kind not in patterns:
                continue
            places = _located(text, patterns[kind], kind, strict)
            if strict and kind == "card":
                # shorter numbers are no candidates
                places = F.filter(
                    places, lambda x: F.length(_digits(x["hit"])).between(14, 19)
                )
            found.append(F.transform(places, _described(text, kind, number, strict)))
    return F.array_sort(F.concat(*found))


@dataclass(frozen=True)
class Model:
    """Reliabilities by kind and labeler, and the classifier's weights by kind."""

    reliability: dict[tuple[str, str], dict[str, float]]
    weights: dict[str, float]


def learn(counts: dict[tuple[str, str], int]) -> Model:
    """Expectation-maximisation over counts of (kind, votes and features), then the classifier."""
    reliability: dict[tuple[str, str], dict[str, float]] = {}
    weights: dict[str, float] = {}
    for kind in KINDS:
        rows = [(votes, n) for (k, votes), n in counts.items() if k == kind]
        # a labeler starts as somewhat reliable
        right = [{"+": 0.7, "0": 0.2, "-": 0.1} for _ in LABELERS]
        wrong = [{"+": 0.2, "0": 0.4, "-": 0.4} for _ in LABELERS]
        share = 0.5
        sure: list[float] = []
        for _ in range(ROUNDS):
            sure = []
            for votes, _n in rows:
                odds = math.log(share / (1 - share)) + sum(
                    math.log(right[i][votes[i]] / wrong[i][votes[i]]) for i in range(len(LABELERS))
                )
                sure.append(1 / (1 + math.exp(-max(-60.0, min(60.0, odds)))))
            yes = sum(p * n for p, (_, n) in zip(sure, rows, strict=True))
            total = sum(n for _, n in rows)
            share = (yes + 1) / (total + 2)
            for i in range(len(LABELERS)):
                for vote in "+0-":
                    seen = [(p, n) for p, (votes, n) in zip(sure, rows, strict=True) if votes[i] == vote]
                    # the start counts as ten candidates, so labelers keep their sense
                    good = 10 * {"+": 0.7, "0": 0.2, "-": 0.1}[vote] + sum(p * n for p, n in seen)
                    bad = 10 * {"+": 0.2, "0": 0.4, "-": 0.4}[vote] + sum((1 - p) * n for p, n in seen)
                    right[i][vote] = good / (yes + 10)
                    wrong[i][vote] = bad / (total - yes + 10)
        for i, labeler in enumerate(LABELERS):
            reliability[kind, labeler] = dict(right[i])
        # the classifier: naive Bayes over votes and features, from the estimates
        weights[f"{kind}:"] = math.log(share / (1 - share))
        yes = sum(p * n for p, (_, n) in zip(sure, rows, strict=True))
        total = sum(n for _, n in rows)
        for i in range(len(LABELERS) + 2):
            for value in "+0-" if i < len(LABELERS) else "0123":
                seen = [(p, n) for p, (votes, n) in zip(sure, rows, strict=True) if votes[i] == value]
                good = (1 + sum(p * n for p, n in seen)) / (yes + 3)
                bad = (1 + sum((1 - p) * n for p, n in seen)) / (total - yes + 3)
                weights[f"{kind}:{i}{value}"] = math.log(good / bad)
    return Model(reliability, weights)


def fit(df: DataFrame) -> Model:
    """Reliabilities and classifier learnt from every candidate in ``text``."""
    patterns = (
        df.select(F.explode(_candidates(filled())).alias("c"))
        .groupBy("c.kind", "c.votes")
        .count()
        .limit(MOST_PATTERNS)  # there cannot be more
        .collect()
    )
    return learn({(r["kind"], r["votes"]): r["count"] for r in patterns})


def find_personal_data(df: DataFrame, model: Model | None = None) -> DataFrame:
    """``df`` with ``spans``: start, end (code points, exclusive), kind, base.

    Spans are in the order of start, then kind. One row for each row, repeated ones
    included; a null or empty text has no spans, texts are read whole, an empty table
    stays empty, a column named ``spans`` is replaced. Base spans all stay, also
    where kinds overlap; a loose candidate is added if the classifier holds it to be
    likelier personal data than not and it overlaps no base span.
    """
    model = model or fit(df)
    names = sorted(model.weights)
    weights = F.create_map(*[F.lit(x) for name in names for x in (name, model.weights[name])])

    def likely(c: Column) -> Column:
        parts = [F.concat(c["kind"], F.lit(":"))] + [
            F.concat(c["kind"], F.lit(f":{i}"), F.substring(c["votes"], i + 1, 1))
            for i in range(len(LABELERS) + 2)
        ]
        total = F.lit(0.0)
        for part in parts:
            total = total + F.coalesce(F.try_element_at(weights, part), F.lit(0.0))
        return total > 0

    def clear(c: Column, base: Column) -> Column:
        return ~F.exists(base, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))

    candidates = F.col("__candidates")
    base = F.filter(candidates, lambda c: c["base"])
    loose = F.filter(
        candidates, lambda c: ~c["base"] & c["votes"].startswith("0") & likely(c)
    )
    spans = F.when(F.size(candidates) == 0, candidates).otherwise(
        F.array_sort(F.concat(base, F.filter(loose, lambda c: clear(c, base))))
    )
    kept = [F.col(f"`{c}`") for c in without(df, ["spans"])]
    return df.select(*kept, _candidates(filled()).alias("__candidates")).select(
        *kept,
        F.transform(
            spans,
            lambda c: F.struct(
                c["start"].alias("start"), c["end"].alias("end"), c["kind"].alias("kind"),
                c["base"].alias("base"),
            ),
        ).alias("spans"),
    )


def redacted(text: Column, spans: Column) -> Column:
    """``text`` with every span replaced by its kind in brackets; overlapping spans once."""

    def step(so_far: Column, s: Column) -> Column:
        fresh = F.array(
            F.substring(text, so_far["at"] + 1, s["start"] - so_far["at"]),
            F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")),
        )
        inside = s["start"] < so_far["at"]
        return F.struct(
            F.greatest(so_far["at"], s["end"]).alias("at"),
            F.when(inside, so_far["out"]).otherwise(F.concat(so_far["out"], fresh)).alias("out"),
        )

    nothing = F.array().cast("array<string>")
    pieces = F.aggregate(
        spans,
        F.struct(F.lit(0).alias("at"), nothing.alias("out")),
        step,
        lambda x: F.concat(x["out"], F.array(F.substring(text, x["at"] + 1, F.length(text)))),
    )
    return F.when(F.size(spans) > 0, F.array_join(pieces, "")).otherwise(text)


def redact(df: DataFrame, model: Model | None = None) -> DataFrame:
    """``df`` with the spans of its ``text`` replaced by ``[KIND]``; a null text stays null."""
    found = find_personal_data(df.withColumn("__spans_of", F.lit(0)), model)
    return found.withColumn("text", redacted(F.col("text"), F.col("spans"))).select(
        *[F.col(f"`{c}`") for c in df.columns]
    )


def _listed(spans: Column) -> Column:
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and places of personal data in every document."""
    found = find_personal_data(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = found.select("doc_id", "spans", F.filter("spans", lambda s: s["base"]).alias("base"))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [
        (F.size("base") - F.size(F.array_remove(kinds, kind))).cast("long").alias(f"n_{kind}")
        for kind in KINDS[:4]
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
        _listed(F.col("spans")).alias("spans"),
    )
