"""Personal data: labelers vote on candidate spans, EM weighs them, a span classifier decides.

Strict patterns give the base spans of four kinds, and looser ones more candidates. Five
labelers (pattern, checksum or range, gazetteer, context, border) vote yes, no or nothing on
every candidate. Votes shrink to counts per pattern of votes, at most 4 * 3^5 rows, on which
expectation-maximisation estimates how reliable each labeler is. With its probabilities as
labels, a naive Bayes classifier over span features is fitted by one aggregation. Candidates
that it accepts are added; base spans always stay.

Rules for odd input: a null text is empty; texts of any length are read whole, by patterns
without recursion; repeated rows each give a row; columns other than doc_id and text are
ignored (`redact` keeps all columns and replaces `text`); an empty table gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.llm.common import id_text, table
from tagloom.session import materialise

KINDS = ("email", "ip", "card", "phone")

#: The contract's patterns. Loops are possessive and starts guarded, which changes no match
#: but keeps long runs from being tried again at each of their characters.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+(?: ?\[at\] ?| ?\(at\) ?| at )"
    r"[A-Za-z0-9-]{1,63}+(?:(?: ?\[dot\] ?| ?\(dot\) ?| dot |\.)[A-Za-z0-9-]{1,63}+){1,8}+",
    "ip": r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){7}+[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])",
    "card": r"(?<![0-9.])[0-9]{4}([ ./_-]{1,2})[0-9]{4}\1[0-9]{4}\1[0-9]{3,4}(?![0-9])",
    "phone": r"(?<![0-9A-Za-z+.-])(?:\([0-9]{2,4}\)[ -]?|[0-9]{2,4}[ .-])[0-9]{3,4}[ .-][0-9]{3,4}"
    r"(?![0-9A-Za-z])",
}
OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"

#: Gazetteers and context words.
DOMAINS = "com|org|net|edu|gov|info|io|de|fr|es|it|uk|eu|example|test"
ISSUERS = "^(?:4|5[1-5]|2[2-7]|3[47]|6(?:011|5))"
ABOUT = {
    "email": "mail|contact|write|kontakt|correo|courriel",
    "ip": r"\bip\b|address|host|server|adresse",
    "card": "card|visa|pay|karte|carte|tarjeta",
    "phone": r"phone|\btel|call|fax|mobile|telefon|appel",
}
AGAINST = r"version|\bv\.?$|isbn|order|build|figure|section|#$"

#: Characters of context before a span, and matches that are added up in one run.
CONTEXT = 24
RUN = 1000
PIECES = 300
SPAN = "struct<kind: string, start: long, end: long, value: string, left: string, right: string>"


def _bind(value: Column, body) -> Column:
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _length(x: Column) -> Column:
    return F.length(x).cast("long")


def _running(values: Column, zero: Column, op) -> Column:
    """What `op` makes of the values before each place, in runs so that long arrays stay cheap."""

    def whole(held: Column) -> Column:
        def run(b: Column) -> Column:
            before = F.aggregate(F.slice(held, F.lit(1), b * RUN), zero, op)
            return F.slice(
                F.aggregate(
                    F.slice(held, b * RUN + 1, F.lit(RUN)),
                    F.array(before),
                    lambda a, x: F.concat(a, F.array(op(F.element_at(a, -1), x))),
                ),
                F.lit(1),
                F.least(F.size(held) - b * RUN, F.lit(RUN)),
            )

        some = F.flatten(
            F.transform(F.sequence(F.lit(0), ((F.size(held) - 1) / RUN).cast("int")), run)
        )
        return F.when(F.size(held) > 0, some).otherwise(F.array().cast("array<long>"))

    return _bind(values, whole)


def _greater(a: Column, b: Column) -> Column:
    return F.greatest(a, b)


def _less(a: Column, b: Column) -> Column:
    return F.least(a, b)


def _starts(steps: Column) -> Column:
    """Sums of the steps before each place."""
    return _running(steps, F.lit(0).cast("long"), lambda a, x: a + x)


def _apart(base: Column, loose: Column) -> Column:
    """The candidates that overlap no base span; both sides are sorted by start and gone through once."""
    far = F.lit(1 << 62).cast("long")

    def marked(spans: Column, of: int) -> Column:
        return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(of).alias("of"), s.alias("span")))

    def kept(both: Column) -> Column:
        ends = F.transform(both, lambda x: F.when(x["of"] == 0, x["span"]["end"]).otherwise(F.lit(0).cast("long")))
        starts = F.transform(F.reverse(both), lambda x: F.when(x["of"] == 0, x["start"]).otherwise(far))
        return _bind(
            F.struct(
                _running(ends, F.lit(0).cast("long"), _greater).alias("upto"),
                F.reverse(_running(starts, far, _less)).alias("next"),
            ),
            lambda near: F.transform(
                F.filter(
                    F.transform(
                        both,
                        lambda x, i: F.struct(
                            ((x["of"] == 1) & (F.get(near["upto"], i) <= x["start"])
                             & (F.get(near["next"], i) >= x["span"]["end"])).alias("free"),
                            x["span"].alias("span"),
                        ),
                    ),
                    lambda x: x["free"],
                ),
                lambda x: x["span"],
            ),
        )

    both = F.array_sort(F.concat(marked(base, 0), marked(loose, 1)))
    return F.when(F.size(loose) == 0, loose).otherwise(_bind(both, kept))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    def term(i: Column) -> Column:
        d = F.substring(F.reverse(_digits(value)), i, F.lit(1)).cast("int")
        doubled = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return F.when(i % 2 == 0, doubled).otherwise(d)

    places = F.sequence(F.lit(1), F.greatest(F.length(_digits(value)), F.lit(1)))
    return F.aggregate(F.transform(places, term), F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    n = F.length(_digits(value))
    if kind == "ip":
        return value.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    if kind == "card":
        return n.between(16, 19) & _luhn(value)
    return n.between(8, 15) if kind == "phone" else F.lit(True)


def _matches(kind: str, text: Column, pattern: str, may: Column) -> Column:
    """All matches of a pattern with their places in code points; `may` rules texts out cheaply."""

    def spans(found: Column) -> Column:
        values, rest = found["values"], found["rest"]
        steps = F.zip_with(F.slice(rest, F.lit(1), F.size(values)), values,
                           lambda a, b: _length(a) + _length(b))
        return _bind(
            _starts(steps),
            lambda before: F.transform(
                values,
                lambda v, i: F.struct(
                    F.lit(kind).alias("kind"),
                    (F.get(before, i) + _length(F.get(rest, i))).alias("start"),
                    (F.get(before, i) + _length(F.get(rest, i)) + _length(v)).alias("end"),
                    v.alias("value"),
                    F.right(F.get(rest, i), F.lit(CONTEXT)).alias("left"),
                    F.left(F.get(rest, i + 1), F.lit(1)).alias("right"),
                ),
            ),
        )

    found = F.struct(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("values"),
        F.split(text, pattern, -1).alias("rest"),
    )
    none = F.array().cast(f"array<{SPAN}>")
    some = _bind(found, lambda f: F.when(F.size(f["values"]) > 0, spans(f)).otherwise(none))
    return F.when(may, some).otherwise(none)


def find(docs: DataFrame) -> DataFrame:
    """Add `base` and `loose`, the strict matches and the other candidates of every text.

    Nothing is written, since the rows hold whole texts: who reads the result twice matches twice.
    """
    text = F.coalesce("text", F.lit(""))
    number = text.rlike("[0-9]")
    spoken = r" at [A-Za-z0-9-]{1,63}+(?: ?[\[(]dot[\])]| dot |\.)"
    at = text.contains("(at)") | text.contains("[at]") | text.rlike(spoken)
    may = {"email": text.contains("@"), "ip": number, "card": number, "phone": text.contains("+")}
    may_loose = {"email": at, "ip": number & text.contains(":"), "card": number, "phone": number}

    def strict(kind: str) -> Column:
        found = _matches(kind, text, BASE[kind], may[kind])
        return F.filter(found, lambda s: _valid(kind, s["value"]))

    base = [strict(k) for k in KINDS]
    loose = [_matches(k, text, LOOSE[k], may_loose[k]) for k in KINDS]
    found = docs.withColumns({"base": F.concat(*base), "loose": F.concat(*loose)})
    return found.withColumn("loose", _apart(F.col("base"), F.col("loose")))


def _per_kind(kind: Column, by_kind) -> Column:
    return F.coalesce(*[F.when(kind == k, by_kind(k)) for k in KINDS])


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, F.lit("y")).when(no, F.lit("n")).otherwise(F.lit("-"))


def votes(s: Column) -> Column:
    """One letter per labeler: y, n or - for none."""
    value, kind, left = s["value"], s["kind"], F.lower(s["left"])
    strict = _per_kind(kind, lambda k: value.rlike(f"^{BASE[k]}$"))
    right_range = _per_kind(
        kind,
        lambda k: F.length(_digits(value)).between(10, 15) if k == "phone"
        else value.rlike(f"^(?:{OCTET}(?:[.]{OCTET}){{3}}|[0-9A-Fa-f:]{{15,39}})$") if k == "ip"
        else _luhn(value) if k == "card" else F.length(value) < 120,
    )
    known = _per_kind(
        kind,
        lambda k: F.lower(value).rlike(rf"(?:{DOMAINS})$") if k == "email"
        else _digits(value).rlike(ISSUERS) if k == "card"
        else ~value.rlike(r"^(?:0|1\.0\.0|127)\.") if k == "ip" else value.rlike(r"^\+|^\("),
    )
    about = _per_kind(kind, lambda k: left.rlike(ABOUT[k]))
    border = left.rlike(r"(?:^|[\s,;:(<\"'])$") & s["right"].rlike(r"^(?:$|[\s.,;:)>\"'])")
    none = F.lit(False)
    return F.concat(
        _vote(strict, none), _vote(right_range, ~right_range), _vote(known, ~known),
        _vote(about, left.rlike(AGAINST)), _vote(border, ~border),
    )


def features(s: Column) -> Column:
    """What the classifier sees of a span, each with its kind."""
    value, kind = s["value"], s["kind"]
    size = F.length(value)
    n = F.length(_digits(value))
    parts = {
        "length": F.least((size / 4).cast("int"), F.lit(12)),
        "digits": F.when(size > 0, (n * 4 / size).cast("int")),
        "number": F.least(n, F.lit(20)),
        "mark": F.left(F.regexp_replace(value, "[A-Za-z0-9]", ""), F.lit(1)),
        "before": F.regexp_replace(F.right(s["left"], F.lit(1)), "[^ .,;:(]", "x"),
        "after": F.regexp_replace(s["right"], "[^ .,;:)]", "x"),
        "about": _per_kind(kind, lambda k: F.lower(s["left"]).rlike(ABOUT[k])),
        "against": F.lower(s["left"]).rlike(AGAINST),
    }
    return F.array(
        *[F.concat_ws(":", kind, F.lit(name), v.cast("string")) for name, v in parts.items()]
    )


def reliabilities(
    counts: dict[tuple[str, str], int], rounds: int = 30
) -> dict[tuple[str, str], float]:
    """Probability that a span with a kind and pattern of votes is real, by EM over the counts."""
    real = {}
    for (kind, vote) in counts:
        yes, no = vote.count("y"), vote.count("n")
        real[kind, vote] = (yes + 0.5) / (yes + no + 1)
    for _ in range(rounds):
        log_odds: dict[tuple, float] = {}
        for kind in {k for k, _ in counts}:
            own = {v: n for (k, v), n in counts.items() if k == kind}
            total = sum(own.values())
            share = sum(n * real[kind, v] for v, n in own.items())
            log_odds[kind,] = math.log((share + 1) / (total - share + 1))
            for place in range(len(next(iter(own)))):
                for letter in "yn":
                    hit = [(n, real[kind, v]) for v, n in own.items() if v[place] == letter]
                    # A yes is taken to speak for a span, a no against it: two pseudo-votes say so.
                    lean = (2, 1) if letter == "y" else (1, 2)
                    p = (sum(n * r for n, r in hit) + lean[0]) / (share + 4)
                    q = (sum(n * (1 - r) for n, r in hit) + lean[1]) / (total - share + 4)
                    log_odds[kind, place, letter] = math.log(p / q)
        real = {
            (kind, vote): 1 / (1 + math.exp(-max(-30, min(30, log_odds[kind,] + sum(
                log_odds[kind, i, c] for i, c in enumerate(vote) if c != "-"
            )))))
            for kind, vote in counts
        }
    return real


@dataclass
class Model:
    prior: dict[str, float]
    weights: dict[str, float]

    def accepts(self, s: Column) -> Column:
        if not self.weights:
            return F.lit(False)
        table_ = F.create_map(*[F.lit(x) for pair in sorted(self.weights.items()) for x in pair])
        first = _per_kind(s["kind"], lambda k: F.lit(self.prior.get(k, -1.0)))
        return F.aggregate(
            features(s), first, lambda a, f: a + F.coalesce(F.element_at(table_, f), F.lit(0.0))
        ) > 0


def fit(found: DataFrame) -> Model:
    """The span classifier, from votes on all candidates of all texts."""
    each = materialise(
        found.select(F.explode(F.concat("base", "loose")).alias("s")).select(
            F.col("s.kind").alias("kind"), votes(F.col("s")).alias("vote"),
            features(F.col("s")).alias("features"),
        ),
        "spans",
    )
    counts = {(r["kind"], r["vote"]): r["count"] for r in each.groupBy("kind", "vote").count().collect()}
    if not counts:
        return Model({}, {})
    real = reliabilities(counts)
    table_ = F.create_map(*[F.lit(x) for (k, v), p in sorted(real.items()) for x in (f"{k}:{v}", p)])
    p = F.element_at(table_, F.concat_ws(":", "kind", "vote"))
    sums = (
        each.select("kind", p.alias("p"), F.explode("features").alias("feature"))
        .groupBy("kind", "feature")
        .agg(F.sum("p").alias("yes"), F.sum(1 - F.col("p")).alias("no"))
        .collect()
    )
    total = {k: [0.0, 0.0] for k in KINDS}
    for (kind, vote), n in counts.items():
        total[kind][0] += n * real[kind, vote]
        total[kind][1] += n * (1 - real[kind, vote])
    prior = {k: math.log((yes + 1) / (no + 1)) for k, (yes, no) in total.items()}
    weights = {
        r["feature"]: math.log(
            ((r["yes"] + 0.5) / (total[r["kind"]][0] + 5)) / ((r["no"] + 0.5) / (total[r["kind"]][1] + 5))
        )
        for r in sums
    }
    return Model(prior, weights)


def annotate(docs: DataFrame) -> DataFrame:
    """The rows of `docs` with `base` and `spans`: base spans and those that the method adds.

    Reads `docs` twice, first for the classifier, of which only the candidates are written.
    """
    found = find(docs)
    model = fit(found)
    added = F.filter("loose", model.accepts)
    order = {k: i for i, k in enumerate(KINDS)}

    def sorted_(spans: Column) -> Column:
        keyed = F.transform(
            spans,
            lambda s: F.struct(_per_kind(s["kind"], lambda k: F.lit(order[k])), s["start"], s["end"], s["kind"]),
        )
        return F.transform(
            F.array_sort(keyed),
            lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")),
        )

    return found.withColumn("spans", sorted_(F.concat("base", added))).drop("loose")


def _joined(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def redact(docs: DataFrame) -> DataFrame:
    """The rows of `docs` with personal data in `text` replaced by its kind, as <EMAIL>."""
    columns = docs.columns
    inner = docs.select(F.struct("*").alias("row"), F.col("text").cast("string").alias("text"))
    spans = F.array_sort(
        F.transform("spans", lambda s: F.struct(s["start"], s["end"], F.upper(s["kind"]).alias("kind")))
    )
    # Of overlapping spans, the first one stays and the rest of the others goes with it.
    tops = _running(F.transform("s", lambda s: s["end"]), F.lit(0).cast("long"), _greater)
    placed = F.zip_with(
        "s", "top", lambda s, top: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), top.alias("top"))
    )

    def cut(text: Column, start: Column, size: Column) -> Column:
        return F.substring(text, (start + 1).cast("int"), size.cast("int"))

    def run(b: Column) -> Column:
        """The text up to the last span of a run, cut out once so that spans don't go through all of it."""
        own = F.slice("placed", b * PIECES + 1, F.lit(PIECES))
        first = F.get(own, F.lit(0))["top"]

        def hidden(of: Column) -> Column:
            return F.array_join(
                F.transform(
                    own,
                    lambda s: F.when(
                        s["start"] >= s["top"],
                        F.concat(
                            cut(of, s["top"] - first, s["start"] - s["top"]), F.lit("<"), s["kind"], F.lit(">")
                        ),
                    ).otherwise(""),
                ),
                "",
            )

        size = F.greatest(F.element_at(own, -1)["start"] - first, F.lit(0).cast("long"))
        return _bind(cut(F.col("text"), first, size), hidden)

    runs = F.sequence(F.lit(0), ((F.size("placed") - 1) / PIECES).cast("int"))
    last = F.greatest(F.coalesce(F.array_max(F.transform("s", lambda s: s["end"])), F.lit(0)), F.lit(0))
    tail = F.substring(F.col("text"), (last + 1).cast("int"), F.length("text"))
    hidden = F.when(F.size("s") == 0, F.col("text")).otherwise(
        F.concat(F.array_join(F.transform(runs, run), ""), tail)
    )
    return (
        annotate(inner)
        .select("row", "text", spans.alias("s"))
        .withColumn("top", tops)
        .withColumn("placed", placed)
        .select(*[hidden.alias(c) if c == "text" else F.col(f"row.`{c}`") for c in columns])
    )


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = annotate(id_text(table(spark, sf_dir, "documents")).select("doc_id", "text"))
    base = F.transform("base", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    kinds = F.transform("base", lambda s: s["kind"])
    return found.select(
        "doc_id",
        *[
            (F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("long").alias(f"n_{kind}")
            for kind in KINDS
        ],
        F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
    )
