"""Personal data by weak supervision, in built-in functions only.

Four basic kinds (email, ip, card, phone) are found by fixed patterns. Beyond them a
broad search gathers candidates: written-out addresses, groups of digits, account
numbers. Four labelers vote on each candidate or abstain: a strict pattern, gazetteers
(endings of hosts, country codes, calling codes), the words in front, and the shape.
Expectation-maximisation over the counts of vote patterns, one SQL expression over at
most 81 of them, estimates how reliable each labeler is without any label. The expected
labels then train the final classifier, naive Bayes over votes and features of the
span, and candidates it accepts are added where they touch no basic span.

Texts are read once; spans, votes and features go on from a table in the shared folder.
Only counts of vote patterns and features are shuffled, combined before.

Defined results: NULL text is empty; a corpus without candidates adds nothing; repeated
rows are treated alike. Positions are code points of the whole text. Basic spans have any
length. Candidates beyond them have a form, and with it a length: a name of up to 64
characters before the sign and labels of up to 63 after it, as mail addresses are defined,
and numbers of 7 to 41 characters; what is longer is none of them.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.functions.text import let
from gristmill.llm.spans import find_spans, kind_spans, no_spans, not_inside_others, span_text, without_overlap
from gristmill.sources.staging import stage

# The basic kinds. Possessive quantifiers change no match, as what follows
# a run is not in its class, and spare deep recursion; a match may not start inside a run
# (unless right after a match), as it would have started with the run.
EMAIL = (
    r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
)
IP = r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}+"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone")

# Candidates of each family.
HANDLE = (
    r"[A-Za-z0-9._%+-]{1,64}+\x20?(?:\(at\)|\[at\]|@)\x20?[A-Za-z0-9-]{1,63}"
    r"(?:\x20?(?:\.|\(dot\)|\[dot\])\x20?[A-Za-z0-9-]{2,63})+"
)
NUMBER = r"(?<![0-9A-Za-z])[+(]?[0-9][0-9\x20().-]{5,38}[0-9](?![0-9A-Za-z])"
ACCOUNT = r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![0-9A-Za-z])"
FAMILIES = ("handle", "number", "account")
# Gazetteers.
HOST_ENDINGS = (
    "com", "org", "net", "edu", "gov", "info", "io", "biz", "eu", "de", "fr", "es", "uk", "it",
    "nl", "ch", "at", "us", "ca", "mx", "ar", "be", "pl", "pt", "se", "jp", "cn", "in", "br", "ru",
)
ACCOUNT_COUNTRIES = ("DE", "FR", "ES", "GB", "IT", "NL", "CH", "AT", "BE", "PT", "SE", "PL", "IE", "LU")
CALLING = r"^(?:\+|00)(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65)"
BEFORE = (
    "mail", "contact", "phone", "tel", "call", "mobile", "fax", "card", "visa", "ssn", "iban",
    "account", "konto", "cuenta", "compte", "login", "telefon", "kontakt", "courriel", "correo",
)
NOT_BEFORE = ("page", "isbn", "version", "chapter", "issn", "doi", "seite", "total", "price", "figure")

#: Type of an added span.
ADDED = "struct<s:int,k:int,e:int,kind:string>"

LABELERS = ("regex", "gazetteer", "context", "shape")
ABSTAIN = 2
EM_ROUNDS = 40
SMOOTHING = 1.0


def digits(v: Column) -> Column:
    return F.regexp_replace(v, "[^0-9]", "")


def valid_ip(v: Column) -> Column:
    plain = F.transform(F.split(v, r"\."), lambda p: F.ltrim(p, F.lit("0")))
    return F.forall(
        plain, lambda p: (F.length(p) <= 3) & (F.coalesce(p.try_cast("int"), F.lit(0)) <= 255)
    )


def valid_card(v: Column) -> Column:
    return let(digits(v), lambda d: F.length(d).between(13, 19) & F.call_function("luhn_check", d))


def valid_phone(v: Column) -> Column:
    return F.length(digits(v)).between(9, 15)


def base_spans(text: Column) -> Column:
    """Spans of the basic kinds by kind, then start."""
    number = F.rlike(text, F.lit(r"[0-9](?:[\x20-]?[0-9]){12}"))
    return F.concat(
        kind_spans(text, "email", 0, EMAIL, F.contains(text, F.lit("@")), lambda v: F.lit(True)),
        kind_spans(text, "ip", 1, IP, F.rlike(text, F.lit(r"[0-9]\.[0-9]")), valid_ip),
        kind_spans(text, "card", 2, CARD, number, valid_card),
        kind_spans(text, "phone", 3, PHONE, F.contains(text, F.lit("+")), valid_phone),
    )


def any_word(text: Column, words) -> Column:
    found = F.lit(False)
    for word in words:
        found = found | F.contains(text, F.lit(word))
    return found


def vote(yes: Column, no: Column) -> Column:
    return F.when(yes, "1").when(no, "0").otherwise(str(ABSTAIN))


def votes(family: str, v: Column, before: Column) -> Column:
    """One character for each labeler: 1, 0 or the mark for abstaining."""
    never = F.lit(False)
    if family == "handle":
        strict = F.rlike(v, F.lit(r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+$"))
        ending = F.lower(F.regexp_extract(v, r"([A-Za-z0-9-]+)$", 1)).isin(*HOST_ENDINGS)
        named = vote(ending, ~ending)
        shape = vote(F.rlike(v, F.lit(r"^[^@(\[]*[0-9._]")), never)
    elif family == "number":
        strict = (
            (F.rlike(v, F.lit(r"^[0-9]+(?:\.[0-9]+){3}$")) & valid_ip(v))
            | (F.rlike(v, F.lit(r"^[0-9](?:[\x20-]?[0-9])+$")) & valid_card(v))
            | (F.rlike(v, F.lit(r"^\+[0-9]")) & valid_phone(v))
            | F.rlike(v, F.lit(r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$"))
        )
        n = F.length(digits(v))
        code = F.rlike(v, F.lit(CALLING)) | (F.rlike(v, F.lit(ISSUERS)) & n.between(15, 16))
        named = vote(code, never)
        date = F.rlike(v, F.lit(r"^[0-9]{1,4}[-./][0-9]{1,2}[-./][0-9]{1,4}$"))
        decimal = F.rlike(v, F.lit(r"^[0-9]+\.[0-9]+$")) | F.rlike(v, F.lit(r"^0"))
        shape = vote(n.between(9, 19) & ~date & ~decimal, date | decimal | (n < 9))
    else:
        strict = F.length(F.replace(v, F.lit(" "), F.lit(""))).between(15, 34)
        country = F.substring(v, 1, 2).isin(*ACCOUNT_COUNTRIES)
        named = vote(country, ~country)
        shape = vote(F.rlike(v, F.lit(r"^[A-Z]{2}[0-9]{2}[A-Z0-9]{0,4}[0-9\x20]+$")), never)
    context = vote(any_word(before, BEFORE), any_word(before, NOT_BEFORE))
    return F.concat(vote(strict, ~strict), named, context, shape)


def features(family: str, v: Column, ballot: Column) -> Column:
    """Names of the features of a span; each has few values."""
    n = F.least(F.length(digits(v)), F.lit(20)).cast("string")
    size = F.least(F.floor(F.length(v) / 8), F.lit(8)).cast("string")
    mark = F.when(F.rlike(v, F.lit(r"^\+")), "+").when(F.contains(v, F.lit("(")), "(").when(
        F.contains(v, F.lit("-")), "-"
    ).when(F.contains(v, F.lit(".")), ".").otherwise("none")
    named = [F.concat(F.lit(f"{name}="), F.substring(ballot, i + 1, 1)) for i, name in enumerate(LABELERS)]
    return F.array(
        F.lit(f"family={family}"),
        F.concat(F.lit(f"{family}:digits="), n),
        F.concat(F.lit(f"{family}:size="), size),
        F.concat(F.lit(f"{family}:mark="), mark),
        *named,
    )


def candidates(text: Column) -> Column:
    """Array of (s, k, e, kind, votes, features) of the broad search."""
    gates = {
        "handle": F.rlike(text, F.lit(r"@|\(at\)|\[at\]")),
        "number": F.rlike(text, F.lit(r"[0-9][0-9\x20().-]{5}")),
        "account": F.rlike(text, F.lit(r"[A-Z]{2}[0-9]{2}")),
    }

    def described(family: str, k: int):
        def span(x: Column) -> Column:
            return let(
                votes(family, x["v"], F.lower(x["before"])),
                lambda ballot: F.struct(
                    x["s"].alias("s"),
                    F.lit(k).alias("k"),
                    x["e"].alias("e"),
                    F.lit(family).alias("kind"),
                    ballot.alias("votes"),
                    features(family, x["v"], ballot).alias("features"),
                ),
            )

        return span

    found = []
    for i, (family, pattern) in enumerate(zip(FAMILIES, (HANDLE, NUMBER, ACCOUNT), strict=True)):
        spans = F.when(gates[family], find_spans(text, pattern)).otherwise(no_spans())
        found.append(F.transform(spans, described(family, len(KINDS) + i)))
    return F.concat(*found)


def find(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(_key, base, candidates) of each row, without the values."""
    value = F.coalesce(F.col(text), F.lit(""))
    bare = F.transform(
        base_spans(value),
        lambda x: F.struct(x["s"].alias("s"), x["k"].alias("k"), x["e"].alias("e"), x["kind"].alias("kind")),
    )
    return docs.select(
        F.col(key).alias("_key"), bare.alias("base"), candidates(value).alias("candidates")
    )


def place(labeler: int, ballot: Column) -> Column:
    """Index of a labeler's vote in the table of rates, from 1."""
    return F.substring(ballot, labeler + 1, 1).cast("int") + 3 * labeler + 1


def chance(rates: Column, ballot: Column) -> Column:
    product = F.lit(1.0)
    for i in range(len(LABELERS)):
        product = product * F.element_at(rates, place(i, ballot))
    return product


def posterior(state, ballot: Column) -> Column:
    """Probability that a candidate with these votes is personal data."""
    yes = state["prior"] * chance(state["yes"], ballot)
    no = (F.lit(1.0) - state["prior"]) * chance(state["no"], ballot)
    return let(F.struct(yes.alias("y"), no.alias("n")), lambda p: p["y"] / (p["y"] + p["n"]))


def estimate(patterns: DataFrame):
    """Row (prior, yes, no): rates of each labeler's votes for either class, by EM.

    ``patterns`` has (votes, n), at most 81 rows.
    """
    given = patterns.agg(F.collect_list(F.struct("votes", F.col("n").cast("double").alias("n"))).alias("p"))

    def total(rows: Column, value) -> Column:
        return F.aggregate(rows, F.lit(0.0), lambda acc, x: acc + value(x))

    def voted(labeler: int, k: int):
        return lambda x: F.substring(x["votes"], labeler + 1, 1) == str(k)

    def rates(rows: Column, weight) -> Column:
        whole = total(rows, weight)
        return F.array(
            *[
                (total(F.filter(rows, voted(i, k)), weight) + SMOOTHING) / (whole + 3 * SMOOTHING)
                for i in range(len(LABELERS))
                for k in (0, 1, ABSTAIN)
            ]
        )

    # Voting 1 starts as the likelier sign of personal data; EM moves the rates from there.
    first = F.struct(
        F.lit(0.5).alias("prior"),
        F.array(*[F.lit(x) for _ in LABELERS for x in (0.15, 0.6, 0.25)]).alias("yes"),
        F.array(*[F.lit(x) for _ in LABELERS for x in (0.6, 0.15, 0.25)]).alias("no"),
    )

    def step(state: Column, _: Column) -> Column:
        def moved(rows: Column) -> Column:
            yes = lambda x: x["n"] * x["q"]
            no = lambda x: x["n"] * (F.lit(1.0) - x["q"])
            share = (total(rows, yes) + SMOOTHING) / (total(rows, lambda x: x["n"]) + 2 * SMOOTHING)
            return F.struct(
                share.alias("prior"), rates(rows, yes).alias("yes"), rates(rows, no).alias("no")
            )

        scored = F.transform(
            F.col("p"),
            lambda x: F.struct(
                x["votes"].alias("votes"), x["n"].alias("n"), posterior(state, x["votes"]).alias("q")
            ),
        )
        return let(scored, moved)

    rounds = F.sequence(F.lit(1), F.lit(EM_ROUNDS))
    return given.where(F.size("p") > 0).select(F.aggregate(rounds, first, step).alias("s")).select("s.*").first()


@dataclass
class Model:
    """Log-odds of the final classifier."""

    bias: float = 0.0
    weights: dict[str, float] = field(default_factory=dict)

    def accepts(self, names: Column) -> Column:
        if not self.weights:
            return F.lit(False)
        table = F.create_map(*[F.lit(x) for item in sorted(self.weights.items()) for x in item])
        total = F.aggregate(
            names,
            F.lit(self.bias),
            lambda acc, f: acc + F.coalesce(F.try_element_at(table, f), F.lit(0.0)),
        )
        return total > 0


def train(found: DataFrame) -> Model:
    """The classifier from the candidates of the whole corpus."""
    # Combinations of votes and features are few; all that follows works on their counts.
    kinds = stage(
        found.select(F.explode("candidates").alias("c"))
        .groupBy(F.col("c.votes").alias("votes"), F.col("c.features").alias("features"))
        .agg(F.count(F.lit(1)).alias("n")),
        "votes",
    )
    fitted = estimate(kinds.groupBy("votes").agg(F.sum("n").alias("n")))
    if fitted is None:
        return Model()
    state = {
        "prior": F.lit(fitted["prior"]),
        "yes": F.array(*[F.lit(x) for x in fitted["yes"]]),
        "no": F.array(*[F.lit(x) for x in fitted["no"]]),
    }
    weighted = kinds.withColumn("q", posterior(state, F.col("votes")))
    sums = (F.sum(F.col("n") * F.col("q")).alias("yes"), F.sum(F.col("n") * (1 - F.col("q"))).alias("no"))
    whole = weighted.agg(*sums).first()
    by_name = weighted.withColumn("name", F.explode("features")).groupBy("name").agg(*sums).collect()
    yes, no = whole["yes"] + 2 * SMOOTHING, whole["no"] + 2 * SMOOTHING
    weights = {
        r["name"]: math.log((r["yes"] + SMOOTHING) / yes) - math.log((r["no"] + SMOOTHING) / no)
        for r in by_name
    }
    return Model(math.log(yes / no), weights)


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, base, added) for every row of ``docs``."""
    found = stage(find(docs, key, text), "pii")
    model = train(found)
    accepted = F.transform(
        F.filter("candidates", lambda c: model.accepts(c["features"])),
        lambda c: F.struct(c["s"].alias("s"), c["k"].alias("k"), c["e"].alias("e"), c["kind"].alias("kind")),
    )
    apart = without_overlap(accepted, F.col("base"), ADDED).alias("added")
    return found.select(F.col("_key").alias(key), "base", apart).withColumn(
        "added", not_inside_others(F.col("added"), ADDED)
    )


def summary(scanned: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts and digests of each row of ``scan``; spans by kind, then start."""

    def n(kind: str) -> Column:
        return F.size(F.filter("base", of(kind))).cast("long").alias(f"n_{kind}")

    def of(kind: str):
        return lambda x: x["kind"] == kind

    by_kind = [F.filter("added", of(family)) for family in FAMILIES]
    return scanned.select(
        key,
        *[n(kind) for kind in KINDS],
        F.sha2(span_text(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        span_text(F.concat("base", *by_kind)).alias("spans"),
    )
