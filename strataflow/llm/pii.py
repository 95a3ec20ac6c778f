"""Personal data by weak supervision, with DataFrame functions only.

Candidates are what strict or loose patterns find. Labelers vote on each (yes, no, or nothing): the strict form with
its checksum, a gazetteer of known issuers, calling codes, address ranges and top-level domains, the words around,
and the neighbouring characters. Expectation-maximisation over the counts of all vote patterns estimates how reliable
each labeler is for each kind, without labels. Its posteriors are the soft labels on which the final span classifier,
a logistic regression over votes and shape, is trained. What is passed to the driver are counts per pattern of votes
and shape, of which there is a fixed number, and what comes back is a handful of weights in an expression.

Strict finds always stay; the classifier decides which other candidates join them.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.session import stage

KINDS = ("email", "ip", "card", "phone")

# Starting only where a run starts, or where the last match ended, keeps long runs linear; no other place could match.
_LOCAL = "[A-Za-z0-9._%+-]"
STRICT = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?(?:\(at\)|\[at\]) ?[A-Za-z0-9-]{1,63}+ ?(?:\(dot\)|\[dot\]|\.) ?[A-Za-z]{2,24}+",
    "phone": r"(?<![0-9+.()-])(?<![0-9+.()-] )(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])",
}

# Gazetteers of the second labeler.
DOMAINS = "ai app at au be biz br ca ch cn co com de dev dk edu es eu fi fr gov ie in info int io it jp mx net nl no nz org pl pt ru se uk us"
CALLING_CODES = "1 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 54 55 56 57 60 61 62 63 64 65 66 81 82 84 86 90 91 351 352 353 354 358 420"
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|35|6011|65|62)"
# Words of the third labeler, for and against each kind.
CUES = {
    "email": (r"mail|contact|kontakt|contacto|write to|reach|cc:|from:|to:", r"example of|git clone|ssh "),
    "ip": (r"\bip\b|address|adresse|server|host|ping|login|client", r"version|release|section|chapter|v\.? ?$"),
    "card": (r"card|carte|karte|tarjeta|visa|master|amex|credit|payment|cvv", r"isbn|order|serial|tracking|invoice|id[:# ]*$"),
    "phone": (r"phone|tel|call|mobile|handy|fax|whatsapp|dial|ring", r"isbn|order|serial|version|score|id[:# ]*$"),
}
WINDOW = 40
LABELERS = ("form", "gazetteer", "context", "border")
ROUNDS = 60
# Expected votes (no, none, yes) of a labeler on spans that are personal data, and that are not. A checksum or strict
# form errs at a known low rate, which is held and so says which class is which. The others' rates are estimated; what
# is expected of them weighs as much as PRIOR_ROWS spans and a tenth of all.
PRIOR_ROWS = 10
HELD = {"form": ((0.01, 0.29, 0.70), (0.60, 0.35, 0.05))}
OTHERWISE = ((0.15, 0.35, 0.50), (0.50, 0.35, 0.15))


def found(text: Column, pattern: str) -> Column:
    """All matches of a pattern as (s, e, m): start and end in code points, end exclusive, and the text."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<s:int,e:int,m:string>>").alias("out"))

    def step(acc, x):
        s = acc["at"] + F.char_length(x["0"])
        e = s + F.char_length(x["1"])
        one = F.struct(s.alias("s"), e.alias("e"), x["1"].alias("m"))
        return F.struct(e.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

    pairs = F.arrays_zip(F.slice(gaps, F.lit(1), F.size(matches)).alias("0"), matches.alias("1"))
    none = F.array().cast("array<struct<s:int,e:int,m:string>>")
    return F.when(F.size(matches) > 0, F.aggregate(pairs, start, step, lambda acc: acc["out"])).otherwise(none)


def digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(number: Column) -> Column:
    back = F.reverse(number)

    def add(total, i):
        d = F.substring(back, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.char_length(number)), F.lit(0), add) % 10 == 0


def valid(kind: str, match: Column) -> Column:
    """Whether a strict match holds the numbers that its kind asks for."""
    if kind == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"
        return match.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        number = digits(match)
        return F.when(F.char_length(number).between(13, 19), luhn(number)).otherwise(False)
    if kind == "phone":
        return F.char_length(digits(match)).between(9, 15)
    return F.lit(True)


def vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def gazetteer(kind: str, match: Column) -> Column:
    if kind == "email":
        known = F.lower(match).rlike(rf"[.)\]] ?(?:{'|'.join(DOMAINS.split())})$")
    elif kind == "ip":
        known = match.rlike(r"^0*(?:[1-9]|[1-9][0-9]|1[0-9]{2}|2[01][0-9]|22[0-3])\.") & ~match.rlike(r"^0*127\.")
    elif kind == "card":
        known = digits(match).rlike(ISSUERS)
    else:
        codes = "|".join(CALLING_CODES.split())
        known = digits(match).rlike(rf"^(?:{codes})") & match.startswith("+") | match.rlike(r"^\(?[2-9][0-9]{2}")
    return vote(known, ~known)


def shape(kind: str, match: Column) -> tuple[Column, Column]:
    """Two small numbers that describe a span: its length and its separators."""
    n = F.char_length(digits(match)) if kind in ("card", "phone") else F.char_length(match)
    size = F.when(n < 9, 0).when(n < 13, 1).when(n < 17, 2).otherwise(3)
    return size, F.when(match.rlike(r"[ ()]"), 1).when(match.rlike("-"), 2).otherwise(0)


CANDIDATE = "kind:int,s:int,e:int,base:boolean,form:int,gazetteer:int,context:int,border:int,size:int,marks:int"


def candidates(text: Column) -> Column:
    """All candidate spans of a whole text with the labelers' votes, those of a kind in order."""

    def judged(kind: str, loose: bool):
        def one(x):
            match = x["m"]
            base = F.lit(False) if loose else valid(kind, match)
            before = F.substring(text, F.greatest(F.lit(1), x["s"] - WINDOW + 1), F.least(x["s"], F.lit(WINDOW)))
            after = F.substring(text, x["e"] + 1, F.lit(1))
            cue, against = CUES[kind]
            context = vote(F.lower(before).rlike(cue), F.lower(before).rlike(against))
            glued = F.regexp_like(F.right(before, F.lit(1)), F.lit(r"[\p{L}0-9_]")) | after.rlike(r"[\p{L}0-9_]")
            size, marks = shape(kind, match)
            form = F.lit(0) if loose else vote(base, ~base)
            fields = {
                "kind": F.lit(KINDS.index(kind)), "s": x["s"], "e": x["e"], "base": base, "form": form,
                "gazetteer": gazetteer(kind, match), "context": context, "border": vote(~glued, glued), "size": size, "marks": marks,
            }
            return F.struct(*[c.alias(name) for name, c in fields.items()])

        return one

    parts = []
    for kind in KINDS:
        strict = found(text, STRICT[kind])
        if kind == "card":  # a run of digits too short or too long for a number is no candidate
            strict = F.filter(strict, lambda x: F.char_length(digits(x["m"])).between(13, 19))
        parts.append(F.transform(strict, judged(kind, False)))
        if kind in LOOSE:
            parts.append(F.transform(found(text, LOOSE[kind]), judged(kind, True)))
    return F.concat(*parts).cast(f"array<struct<{CANDIDATE}>>")


def reliabilities(rows: list[tuple]) -> list[float]:
    """Posterior of each (kind, votes..., count) row: two classes per kind, labelers independent given the class.

    Expectation-maximisation from the expected votes, which also stay in the estimates as a prior.
    """
    out = np.zeros(len(rows))
    for kind in range(len(KINDS)):
        own = [i for i, r in enumerate(rows) if r[0] == kind]
        if not own:
            continue
        votes = np.array([rows[i][1 : 1 + len(LABELERS)] for i in own])
        weight = np.array([rows[i][-1] for i in own], float)
        expected = [HELD.get(name, OTHERWISE) for name in LABELERS]
        start = sum(np.log(np.array(yes) / np.array(no))[votes[:, j] + 1] for j, (yes, no) in enumerate(expected))
        posterior = 1 / (1 + np.exp(-start))
        for _ in range(ROUNDS):
            prior = (posterior @ weight + 1) / (weight.sum() + 2)
            log_odds = np.full(len(own), np.log(prior / (1 - prior)))
            for j, (yes, no) in enumerate(expected):
                strength = 1e12 if LABELERS[j] in HELD else PRIOR_ROWS + weight.sum() / 10
                for value in (-1, 0, 1):
                    at = votes[:, j] == value
                    p = (posterior[at] @ weight[at] + strength * yes[value + 1]) / (posterior @ weight + strength)
                    q = ((1 - posterior[at]) @ weight[at] + strength * no[value + 1]) / ((1 - posterior) @ weight + strength)
                    log_odds[at] += np.log(p / q)
            posterior = 1 / (1 + np.exp(-np.clip(log_odds, -30, 30)))
        out[own] = posterior
    return out.tolist()


def features() -> list[tuple[str, int, int]]:
    """(column, value, kind): the indicator features of the span classifier."""
    values = {c: (-1, 0, 1) for c in LABELERS} | {"size": (0, 1, 2, 3), "marks": (0, 1, 2)}
    return [(c, v, k) for k in range(len(KINDS)) for c, own in values.items() for v in own]


def train(rows: list[tuple], soft: list[float], rounds: int = 300, ridge: float = 1.0) -> np.ndarray:
    """Weights of the logistic regression on (kind, votes..., size, marks, count) rows with soft labels; a bias per kind first."""
    names = ["kind", *LABELERS, "size", "marks"]
    table = np.array([r[:-1] for r in rows]).reshape(-1, len(names))
    x = [table[:, 0] == k for k in range(len(KINDS))]
    x += [(table[:, 0] == k) & (table[:, names.index(c)] == v) for c, v, k in features()]
    x = np.stack(x, axis=1).astype(float)
    weight = np.array([r[-1] for r in rows], float)
    y, w = np.array(soft), np.zeros(x.shape[1])
    for _ in range(rounds):  # Newton steps with a ridge, damped
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (p - y)) + ridge * w
        curvature = (x.T * (weight * p * (1 - p) + 1e-9)) @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(curvature, gradient)
        w -= np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit(rows: DataFrame, column: str) -> np.ndarray:
    """Weights of the span classifier from the counts of every pattern of votes and shape; zeros if there are no candidates."""
    each = rows.select(F.explode(column).alias("c"))
    names = ["kind", *LABELERS, "size", "marks"]
    counts = each.groupBy(*[F.col(f"c.{n}").alias(n) for n in names]).agg(F.count(F.lit(1)).alias("n"))
    patterns = [tuple(r) for r in counts.orderBy(*names).collect()]  # at most 4 * 3^4 * 4 * 3 of them
    if not patterns:
        return np.zeros(len(KINDS) + len(features()))
    return train(patterns, reliabilities([(*p[: 1 + len(LABELERS)], p[-1]) for p in patterns]))


def accepted(c: Column, weights: np.ndarray) -> Column:
    """Whether the classifier takes a candidate."""
    terms = [F.when(c["kind"] == k, float(weights[k])).otherwise(0.0) for k in range(len(KINDS))]
    for (name, value, kind), weight in zip(features(), weights[len(KINDS) :], strict=True):
        if abs(weight) > 1e-9:
            terms.append(F.when((c["kind"] == kind) & (c[name] == value), float(weight)).otherwise(0.0))
    return reduce(lambda a, b: a + b, terms) > 0


def find(df: DataFrame, text: str = "text", column: str = "pii_spans", drop: Sequence[str] = ()) -> DataFrame:
    """Add `column`: all spans of the whole text as an array of (kind, s, e, base) by kind, then start.

    `kind` numbers KINDS; positions are code points, end exclusive. Spans with `base` are the strict ones; a candidate
    that the classifier takes joins them unless it overlaps a strict span or an earlier candidate. Null and empty texts
    have no spans; repeated rows have the same; an empty table gives an empty one. An input column of that name, in any
    case, is replaced; those in `drop` are left out.
    """
    others = [F.col(f"`{c}`") for c in df.columns if c.lower() != column.lower() and c not in drop]
    # Staged, so that the texts are searched once for both the counts and the result.
    told = stage(df.select(*others, candidates(F.coalesce(F.col(text), F.lit(""))).alias("__candidates")), "pii")
    weights = fit(told, "__candidates")
    return told.select(*others, chosen(F.col("__candidates"), weights).alias(column))


def chosen(spans: Column, weights: np.ndarray) -> Column:
    strict = F.filter(spans, lambda c: c["base"])
    taken = F.array_sort(F.filter(spans, lambda c: ~c["base"] & accepted(c, weights)))
    free = F.filter(taken, lambda c: ~F.exists(strict, lambda b: (c["s"] < b["e"]) & (b["s"] < c["e"])))
    narrow = lambda c: F.struct(c["kind"].alias("kind"), c["s"].alias("s"), c["e"].alias("e"), c["base"].alias("base"))
    empty = F.array().cast("array<struct<kind:int,s:int,e:int,base:boolean>>")

    def apart(acc, c):
        return F.when(F.exists(acc, lambda b: (c["s"] < b["e"]) & (b["s"] < c["e"])), acc).otherwise(F.concat(acc, F.array(c)))

    alone = F.aggregate(F.transform(free, narrow), empty, apart)
    return F.array_sort(F.concat(F.transform(strict, narrow), alone))


def printed(spans: Column) -> Column:
    """kind:start:end of spans, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["s"], x["e"])), ","
    )


def redact(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets; overlapping spans go as one, under the first's (longest) kind."""
    tags = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    by_start = F.array_sort(F.transform(spans, lambda x: F.struct(x["s"].alias("s"), (-x["e"]).alias("back"), x["e"].alias("e"), x["kind"].alias("kind"))))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc, x):
        kept = F.substring(text, acc["at"] + 1, x["s"] - acc["at"])
        out = F.concat(acc["out"], kept, F.element_at(tags, x["kind"] + 1))
        after = F.struct(x["e"].alias("at"), out.alias("out"))
        inside = F.struct(F.greatest(acc["at"], x["e"]).alias("at"), acc["out"].alias("out"))
        return F.when(x["s"] >= acc["at"], after).otherwise(inside)

    rest = F.aggregate(by_start, start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.char_length(text))))
    return F.when(F.size(spans) > 0, rest).otherwise(text)
