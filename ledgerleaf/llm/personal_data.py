"""Personal data in texts: patterns, weak labels, and a classifier that their agreement trains.

Only DataFrame functions.  Patterns propose spans; six labelers (format, gazetteer, context,
boundary, variety, digits) vote on each; expectation-maximisation estimates how reliable every
labeler is from the counts of vote patterns alone; its posteriors train a logistic classifier on
features of the span, which decides on the spans beyond the base kinds.  Vote and feature patterns
are finitely many, so what reaches the driver is bounded whatever the input.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import let, staged, text_column

# The base patterns.  Lookbehinds and possessive groups change no match; they keep
# the search linear in runs that cannot match and free of recursion in long ones.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# Further kinds: keys and tokens, national telephone numbers, social security numbers.
SECRET = r"(?<![A-Za-z0-9_])(?=[A-Za-z_]*+[0-9])(?=[0-9_]*+[A-Za-z])[A-Za-z0-9_]{16,}+"
TEL = r"(?<![0-9+(])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[.-][0-9]{4}(?![0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"

KINDS = ("email", "ip", "card", "phone", "secret", "tel", "ssn")
PATTERNS = (EMAIL, IP, CARD, PHONE, SECRET, TEL, SSN)
N_BASE = 4
#: Words that announce personal data shortly before it.
GAZETTEER = (
    "password|passwd|pwd|token|secret|apikey|api[_ -]key|access[_ -]key|key|auth|bearer|"
    "phone|tel|telephone|mobile|call|fax|email|e-mail|mail|contact|ssn|social security|"
    "card|visa|mastercard|amex|iban|account|ip|host|address"
)
CONTEXT = 40
#: So many cuts, at some 100 bytes each, are sent to where the texts are; beyond, the texts are shuffled to them.
SENT_CUTS = 250_000
LABELERS = ("format", "gazetteer", "context", "boundary", "variety", "digits")
FEATURES = ("long", "very_long", "digit_heavy", "upper_heavy", "separated", "spaced_left", "spaced_right", "quoted")


def _proposals(kind: int, text: Column) -> Column:
    """All matches of a pattern with what stands around them; none unless a cheap test passes.

    Matches and the gaps between them alternate, so a match is as far from the one before it as
    its gap is long.
    """
    pattern = F.lit(PATTERNS[kind])
    found = F.struct(F.regexp_extract_all(text, pattern, F.lit(0)).alias("hits"), F.split(text, pattern, -1).alias("gaps"))
    listed = let(found, lambda f: F.transform(f["hits"], lambda h, i: F.struct(
        F.lit(kind).alias("kind"), i.alias("place"), F.length(f["gaps"][i]).cast("long").alias("gap"), h.alias("value"),
        F.right(f["gaps"][i], F.lit(CONTEXT)).alias("before"), F.left(f["gaps"][i + 1], F.lit(4)).alias("after"))))
    likely = text.contains("@") if KINDS[kind] == "email" else text.rlike("[0-9]")
    none = "array<struct<kind:int,place:int,gap:bigint,value:string,before:string,after:string>>"
    return F.when(likely, listed).otherwise(F.array().cast(none))


def _luhn(digits: Column) -> Column:
    def checksum(turned: Column) -> Column:
        def step(total: Column, i: Column) -> Column:
            d = (F.ascii(F.substring(turned, i, F.lit(1))) - 48) * (F.lit(2) - i % 2)
            return total + d - F.when(d > 9, 9).otherwise(0)

        return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), step)

    return let(F.reverse(digits), checksum) % 10 == 0


def _valid(kind: Column, value: Column) -> Column:
    """Whether a base match passes its checks; matches of the other kinds always do."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    count = F.length(digits)
    parts = F.forall(F.split(value, r"\."), lambda p: F.coalesce(p.try_cast("int") <= 255, F.lit(False)))
    return (F.when(kind == 1, parts).when(kind == 2, F.when(count.between(13, 19), _luhn(digits)).otherwise(False))
            .when(kind == 3, count.between(9, 15)).otherwise(True))


def _votes(kind: Column, value: Column, before: Column, after: Column, valid: Column) -> list[Column]:
    """+1, -1 or 0 of every labeler, in the order of LABELERS."""
    digits = F.length(F.regexp_replace(value, "[^0-9]", ""))
    share = digits / F.length(value)
    variety = F.size(F.array_distinct(F.split(F.left(value, F.lit(64)), "")))
    known = value.rlike(r"^(?:AKIA[0-9A-Z]{16}|[0-9a-f]{32,}|[0-9A-F]{32,}|gh[pousr]_[A-Za-z0-9]{20,}|sk_[a-z]+_[A-Za-z0-9]{16,})$")
    return [
        F.when(kind < N_BASE, F.when(valid, 1).otherwise(-1)).when(kind == 4, F.when(known, 1).otherwise(0)).otherwise(0),
        F.when(before.rlike(f"(?i)(?:^|[^a-z])(?:{GAZETTEER})[^a-z]"), 1).otherwise(0),
        F.when(before.rlike("[=:][\\x20\\t]*[\"']?$"), 1).when(before.rlike("[A-Za-z0-9_/-]$"), -1).otherwise(0),
        F.when((after == "") | after.rlike("^[^A-Za-z0-9_/+=-]"), 1).otherwise(-1),
        F.when(variety >= 8, 1).when(variety <= 4, -1).otherwise(0),
        F.when(kind == 4, F.when(share.between(0.1, 0.8), 1).otherwise(-1)).when(kind == 0, 0).when(digits >= 7, 1).otherwise(-1),
    ]


def _features(value: Column, before: Column, after: Column) -> list[Column]:
    """0 or 1 for every name of FEATURES."""
    length = F.length(value)
    tests = [
        length >= 20, length >= 32, F.length(F.regexp_replace(value, "[^0-9]", "")) * 2 > length,
        F.length(F.regexp_replace(value, "[^A-Z]", "")) * 3 > length, value.rlike("[\\x20().@-]"),
        (before == "") | before.rlike("\\s$"), (after == "") | after.rlike("^\\s"), before.rlike("[\"']$") & after.rlike("^[\"']"),
    ]
    return [F.when(t, 1).otherwise(0) for t in tests]


def proposals(docs: DataFrame) -> DataFrame:
    """One row per match of any pattern, at least one per document, without the matched text.

    ``row`` numbers the documents, ``text_key`` is the md5 of the text; ``start`` and ``end`` are
    code points.  A start is the length of everything before it, summed per document and kind.
    """
    texts = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", text_column().alias("text"))
    every = F.concat(*(_proposals(k, F.col("text")) for k in range(len(KINDS))))
    listed = texts.select("row", "doc_id", F.md5("text").alias("text_key"), F.explode_outer(every).alias("p"))
    rows = listed.select("row", "doc_id", "text_key", "p.*")
    kind, value, before, after = (F.col(c) for c in ("kind", "value", "before", "after"))
    rows = rows.withColumn("valid", _valid(kind, value))
    rows = rows.select(
        "row", "doc_id", "text_key", "kind", "place", "gap", F.length("value").cast("long").alias("length"), "valid",
        *(v.alias(f"vote_{n}") for n, v in zip(LABELERS, _votes(kind, value, before, after, F.col("valid")))),
        *(f.alias(f"has_{n}") for n, f in zip(FEATURES, _features(value, before, after))))
    so_far = Window.partitionBy("row", "kind").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("end", F.sum(F.col("gap") + F.col("length")).over(so_far))
    return rows.withColumn("start", F.col("end") - F.col("length")).drop("gap", "length", "place")


def estimate(patterns: list[tuple[int, tuple[int, ...], int]], rounds: int = 60) -> tuple[dict[int, float], list[dict[int, float]]]:
    """Expectation-maximisation over (kind, votes, count): log prior odds by kind, log likelihood ratios by labeler and vote."""
    posterior = [1 / (1 + math.exp(-sum(votes))) for _, votes, _ in patterns]
    prior, ratio = {}, []
    for _ in range(rounds):
        mass: dict[int, list[float]] = {}
        for (kind, _, n), q in zip(patterns, posterior):
            m = mass.setdefault(kind, [1.0, 1.0])
            m[0], m[1] = m[0] + n * q, m[1] + n * (1 - q)
        prior = {k: math.log(a / b) for k, (a, b) in mass.items()}
        ratio = []
        for i in range(len(LABELERS)):
            yes, no = {v: 0.5 for v in (-1, 0, 1)}, {v: 0.5 for v in (-1, 0, 1)}
            for (_, votes, n), q in zip(patterns, posterior):
                yes[votes[i]] += n * q
                no[votes[i]] += n * (1 - q)
            all_yes, all_no = sum(yes.values()), sum(no.values())
            ratio.append({v: math.log(yes[v] / all_yes) - math.log(no[v] / all_no) for v in yes})
        odds = (prior[k] + sum(r[v] for r, v in zip(ratio, votes)) for k, votes, _ in patterns)
        posterior = [1 / (1 + math.exp(-max(-40.0, min(40.0, o)))) for o in odds]
    return prior, ratio


def fit(rows: list[tuple[int, tuple[int, ...], int, float]], steps: int = 400, rate: float = 0.1) -> tuple[np.ndarray, np.ndarray]:
    """Logistic regression on (kind, features, count, summed posterior): kind offsets and feature weights."""
    x = np.zeros((len(rows), len(KINDS) + len(FEATURES)))
    for i, (kind, features, _, _) in enumerate(rows):
        x[i, kind] = 1
        x[i, len(KINDS):] = features
    n = np.array([r[2] for r in rows], dtype=float)
    target = np.array([r[3] for r in rows]) / n
    weight = np.sqrt(n) / np.sqrt(n).sum()  # frequent patterns count more, but drown no rare kind
    w, m, v = np.zeros(x.shape[1]), np.zeros(x.shape[1]), np.zeros(x.shape[1])
    for step in range(1, steps + 1):
        g = x.T @ (weight * (1 / (1 + np.exp(-x @ w)) - target)) + 1e-4 * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w[: len(KINDS)], w[len(KINDS):]


def _chosen(key: Column, values: dict[int, float]) -> Column:
    out = F.lit(0.0)
    for k, v in values.items():
        out = F.when(key == k, F.lit(float(v))).otherwise(out)
    return out


def judged(rows: DataFrame) -> DataFrame:
    """Proposals with the classifier's probability: labelers' votes, reliabilities, classifier, in two small aggregates."""
    real = rows.filter("kind is not null")
    votes = [f"vote_{n}" for n in LABELERS]
    patterns = [(r[0], tuple(r[1:-1]), r[-1]) for r in real.groupBy("kind", *votes).count().collect()]
    prior, ratio = estimate(sorted(patterns))
    odds = _chosen(F.col("kind"), prior)
    for name, by_vote in zip(votes, ratio):
        odds = odds + _chosen(F.col(name), by_vote)
    posterior = F.lit(1.0) / (F.lit(1.0) + F.exp(-odds))
    features = [f"has_{n}" for n in FEATURES]
    counted = real.withColumn("posterior", posterior).groupBy("kind", *features).agg(F.count("*"), F.sum("posterior")).collect()
    if not counted:
        return rows.withColumn("probability", F.lit(0.0))
    offsets, weights = fit(sorted((r[0], tuple(r[1:-2]), r[-2], r[-1]) for r in counted))
    score = _chosen(F.col("kind"), dict(enumerate(offsets)))
    for name, w in zip(features, weights):
        score = score + F.col(name) * float(w)
    return rows.withColumn("probability", F.lit(1.0) / (F.lit(1.0) + F.exp(-score)))


def document_spans(docs: DataFrame) -> DataFrame:
    """``row, doc_id, text_key, spans`` for every row of ``docs(doc_id, text)``.

    ``spans`` are structs ``kind, start, end, base`` sorted by kind, then start: all valid base
    matches, and matches of further kinds that the classifier accepts and no base span overlaps.
    Null texts are empty, empty texts have no spans, repeated rows and null ids their own row.
    """
    rows = judged(staged(proposals(docs), "pii-proposals"))
    base = (F.col("kind") < N_BASE) & F.col("valid")
    more = (F.col("kind") >= N_BASE) & (F.col("probability") >= 0.5)
    span = F.struct("kind", "start", "end", (F.col("kind") < N_BASE).alias("base"))
    grouped = rows.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.first("text_key").alias("text_key"), F.sort_array(F.collect_list(F.when(base | more, span))).alias("all"))
    sure = grouped.withColumn("sure", F.filter("all", lambda s: s["base"]))
    kept = F.filter("all", lambda s: s["base"] | ~F.exists("sure", lambda b: (s["start"] < b["end"]) & (b["start"] < s["end"])))
    return sure.select("row", "doc_id", "text_key", kept.alias("spans"))


def _listed(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def op5(docs: DataFrame) -> DataFrame:
    found = document_spans(docs)
    base = F.filter("spans", lambda s: s["base"])

    def count(kind: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long").alias(f"n_{KINDS[kind]}")

    counts = map(count, range(N_BASE))
    return found.select("doc_id", *counts, F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"))


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with every found span replaced by its kind in brackets, and ``n_chars`` to match.

    Spans depend on the text alone, so they are joined by its md5; overlapping ones become one.
    A null text stays null.
    """
    piece = "array<struct<start:bigint,end:bigint,label:string>>"
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    found = document_spans(docs).filter(F.size("spans") > 0).groupBy("text_key").agg(F.max("spans").alias("spans"))
    sorted_spans = F.sort_array(F.transform("spans", lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), F.element_at(names, s["kind"] + 1).alias("label"))))

    def merge(done: Column, s: Column) -> Column:
        last = F.element_at(done, -1)
        joined = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"), last["label"].alias("label"))
        apart = (F.size(done) == 0) | (s["start"] >= F.try_element_at(done, F.lit(-1))["end"])
        return F.when(apart, F.concat(done, F.array(s))).otherwise(F.concat(F.slice(done, 1, F.size(done) - 1), F.array(joined)))

    found = found.withColumn("sorted", sorted_spans)
    found = found.select("text_key", F.aggregate("sorted", F.array().cast(piece), merge).alias("pii_cuts"))
    found = staged(found.withColumnRenamed("text_key", "pii_key"), "pii-cuts")
    n_cuts = found.agg(F.sum(F.size("pii_cuts"))).first()[0] or 0
    found = F.broadcast(found) if n_cuts <= SENT_CUTS else found
    joined = docs.join(found, F.md5(text_column()) == F.col("pii_key"), "left")
    text, cuts = docs["text"].cast("string"), F.col("pii_cuts")

    def before(i: Column) -> Column:
        begin = F.when(i == 0, F.lit(0)).otherwise(F.try_element_at(cuts, i)["end"]).cast("int")
        cut = F.element_at(cuts, i + 1)
        return F.concat(F.substring(text, begin + 1, cut["start"].cast("int") - begin), cut["label"])

    parts = F.array_join(F.transform(F.sequence(F.lit(0), F.size(cuts) - 1), before), "")
    tail = F.substring(text, F.element_at(cuts, -1)["end"].cast("int") + 1, F.length(text))
    joined = joined.withColumn("pii_text", F.when(F.size(F.coalesce(cuts, F.array().cast(piece))) > 0, F.concat(parts, tail)).otherwise(text))
    new = {"text": F.col("pii_text")} | ({"n_chars": F.length("pii_text").cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {})
    return joined.select(*(new.get(c, docs[f"`{c}`"]).alias(c) for c in docs.columns))
