"""Secrets, told from copied examples by who else has them.

Candidates are found row by row with built-in functions. The hash of each secret is
counted over the whole corpus by distinct repositories (documents) and by distinct owners
(sources): a value that more than ``MAX_OWNERS`` owners or ``MAX_REPOS`` repositories hold
is a widely copied example; a value of fewer that looks random is taken for a live
credential. Of a match only the secret is counted and judged: the value of an assignment,
the password of a login, the token of a header. Only hashes and ids are shuffled, never
texts; distinct pairs are formed before anything is counted, so a value that every
document holds is no hot key, and verdicts return to their documents by the document's key.

Defined results: NULL text is empty. A NULL owner may be anyone, so each of its documents
counts as an owner of its own; a document without a key is named by its text. Documents
that share a key get the same verdict for the same value. Long texts are searched whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.functions.text import let
from gristmill.llm.spans import (
    kind_spans,
    looked_up,
    not_inside_others,
    replaced,
    span_text,
    without_overlap,
)
from gristmill.sources.staging import stage

#: A value more owners, or more documents, than this hold is an example.
MAX_OWNERS = 3
MAX_REPOS = 100
#: A secret has so many characters and so many different ones; more if all are letters.
LENGTH, DIFFERENT = 8, 8
LETTERS_LENGTH, LETTERS_DIFFERENT = 12, 7

FOUND = "struct<s:int,k:int,e:int,kind:string,hash:string,random:boolean>"
COUNTED = "struct<hash:string,n_owners:bigint,n_repos:bigint>"
JUDGED = "struct<s:int,k:int,e:int,kind:string,owners:bigint,repos:bigint,live:boolean>"

# Patterns of the basic kinds. The hexadecimal run is written with its
# least length, which finds the same runs as filtering all of them afterwards.
ASSIGN = (
    r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
BASE_KINDS = ("assign", "access", "hex")
# Public token formats that the basic kinds miss.
EXTRA = {
    "jwt": (r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", "eyJ"),
    "pem": (r"-----BEGIN [A-Z ]*PRIVATE KEY-----[^-]*-----END [A-Z ]*PRIVATE KEY-----", "PRIVATE KEY"),
    "github": (r"gh[pousr]_[A-Za-z0-9]{36,}", "gh"),
    "slack": (r"xox[abprs]-[A-Za-z0-9-]{10,}", "xox"),
    "payment": (r"sk_live_[A-Za-z0-9]{16,}", "sk_live_"),
    "bearer": (r"[Bb]earer [A-Za-z0-9._~+/-]{20,}=*", "earer "),
    "url_login": (r"[a-z][a-z0-9+.-]{1,19}://[^\s/:@]{1,64}:[^\s/@]{3,64}@", "://"),
}
# Words of placeholders.
PLACEHOLDERS = ("example", "changeme", "your", "xxxx", "placeholder", "dummy", "sample", "redacted")
REDACTED = "[SECRET]"


def assigned(v: Column) -> Column:
    return F.regexp_extract(v, ASSIGN, 1)


def gates(text: Column) -> dict[str, Column]:
    """For each kind a cheap test that all texts with a match pass."""
    found = {
        "assign": F.rlike(text, F.lit(r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]")),
        "access": F.contains(text, F.lit("AKIA")),
        "hex": F.rlike(text, F.lit(r"[0-9a-f]{24}")),
    }
    return found | {kind: F.contains(text, F.lit(mark)) for kind, (_, mark) in EXTRA.items()}


def base_spans(text: Column) -> Column:
    """Spans of the basic kinds by start, then kind."""
    gate = gates(text)
    yes = lambda v: F.lit(True)
    return F.array_sort(
        F.concat(
            kind_spans(text, "assign", 0, ASSIGN, gate["assign"], lambda v: F.length(assigned(v)) >= 6),
            kind_spans(text, "access", 1, ACCESS, gate["access"], yes),
            kind_spans(text, "hex", 2, HEX, gate["hex"], yes),
        )
    )


def extra_spans(text: Column) -> Column:
    gate = gates(text)
    yes = lambda v: F.lit(True)
    return F.array_sort(
        F.concat(
            *[
                kind_spans(text, kind, 3 + i, pattern, gate[kind], yes)
                for i, (kind, (pattern, _)) in enumerate(EXTRA.items())
            ]
        )
    )


#: The secret in a match of a kind; of other kinds it is the whole match.
SECRET_PART = {
    "assign": ASSIGN,
    "bearer": r"^[Bb]earer (.*)$",
    "url_login": r"://[^\s/:@]{1,64}:([^\s/@]{3,64})@",
}


def secret_value(span: Column) -> Column:
    """What is secret in a match."""
    value = span["v"]
    for kind, pattern in SECRET_PART.items():
        part = F.regexp_extract(span["v"], pattern, 1)
        value = F.when(span["kind"] == kind, part).otherwise(value)
    return value


def looks_random(v: Column) -> Column:
    """Long and mixed enough, and without a word of a placeholder."""
    different = F.size(F.array_distinct(F.split(v, "")))
    holds = F.lit(False)
    for word in PLACEHOLDERS:
        holds = holds | F.contains(F.lower(v), F.lit(word))
    letters = (F.length(v) >= LETTERS_LENGTH) & (different >= LETTERS_DIFFERENT)
    mixed = (F.length(v) >= LENGTH) & (different >= DIFFERENT) & F.rlike(v, F.lit("[0-9]"))
    return (mixed | letters) & ~holds


def described(spans: Column) -> Column:
    """Spans with a hash of the secret and the look of it, and without the value."""
    return F.transform(
        spans,
        lambda x: let(
            secret_value(x),
            lambda v: F.struct(
                x["s"].alias("s"),
                x["k"].alias("k"),
                x["e"].alias("e"),
                x["kind"].alias("kind"),
                F.md5(v.cast("binary")).alias("hash"),
                looks_random(v).alias("random"),
            ),
        ),
    )


def mark(key: Column, text: Column) -> Column:
    """Name of a document: its key, or without one a hash of its text."""
    return F.coalesce(
        F.concat(F.lit("key:"), key.cast("string")), F.concat(F.lit("text:"), F.md5(text.cast("binary")))
    )


def find(docs: DataFrame, key: str, owner: str, text: str) -> DataFrame:
    """(_key, _mark, _owner, base, extra) of each row."""
    value = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.col(key).alias("_key"),
        mark(F.col(key), value).alias("_mark"),
        F.col(owner).cast("string").alias("_owner"),
        described(base_spans(value)).alias("base"),
        described(extra_spans(value)).alias("extra"),
    )


def ownership(held: DataFrame) -> DataFrame:
    """(hash, n_owners, n_repos) of every candidate value; held has (hash, _mark, _owner)."""
    owner = F.coalesce(
        F.concat(F.lit("owner:"), "_owner"), F.concat(F.lit("of "), F.col("_mark"))
    ).alias("_owner")
    owners = held.select("hash", owner).distinct().groupBy("hash")
    repos = held.select("hash", "_mark").distinct().groupBy("hash")
    return owners.agg(F.count(F.lit(1)).alias("n_owners")).join(
        repos.agg(F.count(F.lit(1)).alias("n_repos")), "hash"
    )


def verdicts(found: DataFrame) -> DataFrame:
    """(_mark, counts): for each document with a candidate its hashes with their counts."""
    held = found.select("_mark", "_owner", F.explode(F.concat("base", "extra")).alias("x")).select(
        "_mark", "_owner", F.col("x.hash").alias("hash")
    )
    joined = held.select("_mark", "hash").distinct().join(ownership(held), "hash")
    return joined.groupBy("_mark").agg(
        F.collect_list(F.struct("hash", "n_owners", "n_repos")).alias("counts")
    )


def judged(spans: Column, counts: Column, max_owners: int, max_repos: int) -> Column:
    """Spans with their counts, by start; live are random-looking ones that few hold."""
    table = F.coalesce(counts, F.array()).cast(f"array<{COUNTED}>")
    pairs = looked_up(spans, table, FOUND, COUNTED)

    def verdict(p: Column) -> Column:
        x = p["x"]
        owners, repos = (F.coalesce(p["found"][n], F.lit(1)) for n in ("n_owners", "n_repos"))
        copied = (owners > max_owners) | (repos > max_repos)
        return F.struct(
            x["s"].alias("s"),
            x["k"].alias("k"),
            x["e"].alias("e"),
            x["kind"].alias("kind"),
            owners.alias("owners"),
            repos.alias("repos"),
            (x["random"] & ~copied).alias("live"),
        ).cast(JUDGED)

    return F.array_sort(F.transform(pairs, verdict))


def live(spans: Column) -> Column:
    return F.filter(spans, lambda x: x["live"])


def scan(
    docs: DataFrame,
    key: str = "doc_id",
    owner: str = "source",
    text: str = "text",
    max_owners: int = MAX_OWNERS,
    max_repos: int = MAX_REPOS,
) -> DataFrame:
    """(key, base, added, live) for every row: basic spans, those the method adds, live ones.

    A span says how many owners and repositories hold its secret.
    """
    # Texts are searched once; the spans, a small table, go on from the shared folder.
    found = stage(find(docs, key, owner, text), "secrets")
    joined = found.join(verdicts(found), "_mark", "left")

    def of(column: str) -> Column:
        return judged(F.col(column), F.col("counts"), max_owners, max_repos)

    # In steps, as one expression would be nested too deeply to be analysed.
    marked = joined.select("_key", of("base").alias("base"), of("extra").alias("extra"))
    apart = without_overlap(live(F.col("extra")), F.col("base"), JUDGED)
    added = marked.select("_key", "base", apart.alias("added"))
    return added.select(
        F.col("_key").alias(key),
        "base",
        not_inside_others(F.col("added"), JUDGED).alias("added"),
        live(F.col("base")).alias("live"),
    )


def redact(
    docs: DataFrame,
    key: str = "doc_id",
    owner: str = "source",
    text: str = "text",
    max_owners: int = MAX_OWNERS,
    max_repos: int = MAX_REPOS,
) -> DataFrame:
    """``docs`` with live secrets replaced by a mark; same rows and columns.

    Only rows that pass the cheap test for candidates are joined with the verdicts;
    all others go straight through.
    """
    value = F.coalesce(F.col(text), F.lit(""))
    suspect = F.lit(False)
    for gate in gates(value).values():
        suspect = suspect | gate
    suspects = docs.where(suspect)
    marks = verdicts(stage(find(suspects, key, owner, text), "secrets"))
    marks = marks.select(F.col("_mark").alias("_gm_key"), F.col("counts").alias("_gm_counts"))
    joined = suspects.join(marks, mark(F.col(key), value) == F.col("_gm_key"), "left")
    # In steps, as one expression would be nested too deeply to be analysed.
    spans = described(F.concat(base_spans(value), extra_spans(value)))
    steps = joined.withColumn("_gm_spans", spans)
    found = live(judged(F.col("_gm_spans"), F.col("_gm_counts"), max_owners, max_repos))
    steps = steps.withColumn("_gm_spans", found)
    steps = steps.withColumn("_gm_spans", not_inside_others(F.col("_gm_spans"), JUDGED))
    cleaned = replaced(F.col(text), F.col("_gm_spans"), REDACTED)
    mended = steps.select(
        *[cleaned.alias(c) if c == text else F.col(c) for c in docs.columns]
    )
    return docs.where(~suspect).unionByName(mended)


def summary(scanned: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts and digests of each row of ``scan``."""

    def n(kind: str) -> Column:
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def most(name: str) -> Column:
        return F.array_max(F.transform(F.concat("base", "added"), lambda x: x[name]))

    return scanned.select(
        key,
        *[n(kind) for kind in BASE_KINDS],
        F.sha2(span_text(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        span_text(F.array_sort(F.concat("base", "added"))).alias("spans"),
        F.size("live").cast("long").alias("n_live"),
        most("owners").alias("max_owners"),
        most("repos").alias("max_repos"),
    )
