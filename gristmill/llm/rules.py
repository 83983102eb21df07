"""Quality rules with risk-controlled thresholds.

Each rule rejects a document whose measure exceeds a cutoff. Cutoffs come from
labelled documents: for every stratum, rule and candidate cutoff the good documents
it would reject are counted, and an exact binomial test asks whether the true share
of good documents rejected may exceed the risk. Of the cutoffs whose test holds at
the error level divided by the number of tests (Bonferroni), the strictest is taken.
The risk is divided among the rules, so all together reject at most ``RISK`` of the
good documents of a stratum with probability ``1 - ERROR`` over all strata.

Measures are row-wise; only (stratum, rule, cutoff) counts of labelled rows are
aggregated, a table whose size does not depend on the data.

Defined results: NULL text has no words and fails the base rules; a stratum without
enough labels, or that is NULL or unseen, gets no cutoff, hence no further rejection;
NULL labels and labels of unknown ids count for nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import exp, lgamma, log, log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.sources.staging import stage

# Characters that count as symbols.
SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

#: Share of good documents the rules of a stratum may reject, and the chance of being wrong.
RISK = 0.05
ERROR = 0.05
#: Candidate cutoffs, fixed before any label is seen: a document beyond the cutoff goes.
CUTOFFS = {
    "symbol_share": (0.005, 0.01, 0.02, 0.05, 0.1, 0.2, 0.3),
    "dup_line_share": (0.05, 0.1, 0.2, 0.3, 0.5, 0.7),
    "repeat_share": (0.05, 0.1, 0.2, 0.3, 0.4),
    "word_length_off": (1.0, 1.5, 2.0, 3.0, 4.0, 6.0),
    "capital_share": (0.1, 0.2, 0.3, 0.5, 0.7),
}
MAX_STRATA = 1_000

SCHEMA = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_lines long, n_capitals long"
)
_FIELDS = [f.split()[0] for f in SCHEMA.split(",")]


def repeat_words(words: list[bytes]) -> int:
    """Words covered by 3-word windows that occur twice or more."""
    if len(words) < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], dtype=np.int64)
    pair = ids[:-1] * len(number) + ids[1:]
    if len(number) > 1_000_000:  # three numbers no longer fit in 63 bits
        pair = np.unique(pair, return_inverse=True)[1]
    window = pair[:-1] * len(number) + ids[2:]
    ordered = np.sort(window)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    twice = twice[np.concatenate([[True], twice[1:] != twice[:-1]])]
    at = np.minimum(np.searchsorted(twice, window), len(twice) - 1)
    hit = np.flatnonzero(twice[at] == window)
    covered = np.zeros(len(words), dtype=bool)
    for k in range(3):
        covered[hit + k] = True
    return int(covered.sum())


def measure(text: str) -> tuple[int, ...]:
    data = text.encode("utf-8", "surrogatepass")
    # Bytes split at space, tab, LF, VT, FF and CR, and nowhere else.
    words = data.split()
    joined = b"".join(words)
    continuation = len(joined) - len(joined.decode("utf-8", "surrogatepass"))
    lines = [x for x in data.split(b"\n") if x.strip()]
    return (
        len(words),
        len(joined) - continuation,
        len(data) - len(data.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeat_words(words),
        len(lines),
        len(joined) - len(joined.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")),
    )


def measures(text: Column) -> Column:
    """Struct of counts of a text."""

    @F.arrow_udf(SCHEMA)
    def counts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            rows = [measure(t.as_py() or "") for t in texts]
            columns = zip(*rows, strict=True) if rows else [[]] * len(_FIELDS)
            yield pa.StructArray.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], _FIELDS
            )

    return counts(text)


def base_failed(m: Column) -> Column:
    return (m["n_words"] < MIN_WORDS) | (
        100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"]
    )


def rule_values(m: Column) -> dict[str, Column]:
    """Measure of each rule; a text without words has 0 everywhere."""

    def share(a: str, b: str) -> Column:
        return F.coalesce(F.try_divide(m[a], m[b]), F.lit(0.0))

    return {
        "symbol_share": share("n_symbols", "word_chars"),
        "dup_line_share": share("n_dup_lines", "n_lines"),
        "repeat_share": share("n_repeat_words", "n_words"),
        "word_length_off": F.abs(share("word_chars", "n_words") - 5.5),
        "capital_share": share("n_capitals", "word_chars"),
    }


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for X ~ Binomial(n, p), summed exactly in logarithms."""
    logs = [
        lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * log(p) + (n - i) * log1p(-p)
        for i in range(k + 1)
    ]
    top = max(logs)
    return min(1.0, exp(top) * sum(exp(x - top) for x in logs))


def choose_cutoffs(
    rows: DataFrame,
    stratum: str = "stratum",
    risk: float = RISK,
    error: float = ERROR,
    cutoffs: dict[str, tuple[float, ...]] = CUTOFFS,
) -> dict[str, dict[str, float]]:
    """Stratum -> rule -> cutoff, from labelled rows (stratum, good, m)."""
    values = rule_values(F.col("m"))
    good = rows.where(F.col("good") & F.col(stratum).isNotNull() & ~base_failed(F.col("m")))
    counts = good.groupBy(stratum).agg(
        F.count(F.lit(1)).alias("n"),
        *[
            F.count_if(values[rule] > cut).alias(f"{rule}:{i}")
            for rule, cuts in cutoffs.items()
            for i, cut in enumerate(cuts)
        ],
    )
    found = counts.limit(MAX_STRATA + 1).collect()
    if len(found) > MAX_STRATA:
        raise ValueError(f"more than {MAX_STRATA} strata")
    n_tests = max(1, len(found) * sum(map(len, cutoffs.values())))
    chosen: dict[str, dict[str, float]] = {}
    for row in found:
        picks = {}
        for rule, cuts in cutoffs.items():
            for i, cut in sorted(enumerate(cuts), key=lambda x: x[1]):
                if binomial_tail(row[f"{rule}:{i}"], row["n"], risk / len(cutoffs)) <= error / n_tests:
                    picks[rule] = cut
                    break
        chosen[row[stratum]] = picks
    return chosen


def rejected(m: Column, stratum: Column, chosen: dict[str, dict[str, float]]) -> Column:
    """True where a rule of the stratum rejects; the table of cutoffs is a literal."""
    values = rule_values(m)
    hit = F.lit(False)
    for name, picks in sorted(chosen.items()):
        for rule, cut in picks.items():
            hit = hit | (F.coalesce(stratum == F.lit(name), F.lit(False)) & (values[rule] > cut))
    return hit


def judge(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    stratum: str = "lang",
    quality: str = "quality",
) -> DataFrame:
    """(key, stratum, m, base_failed, kept) for every row of ``docs``."""
    # Texts are read once; the counts, a small table, serve the labels and the verdicts.
    measured = stage(
        docs.select(
            F.col(key).alias("_key"),
            F.col(stratum).alias("_stratum"),
            measures(F.col(text)).alias("m"),
        ),
        "measures",
    )
    marked = labels.where(F.col(key).isNotNull() & F.col(quality).isNotNull())
    marked = marked.groupBy(F.col(key).alias("_key")).agg((F.max(quality) == 1).alias("good"))
    graded = measured.join(marked, "_key").select(F.col("_stratum").alias("stratum"), "good", "m")
    chosen = choose_cutoffs(graded)
    m = F.col("m")
    failed = base_failed(m)
    return measured.select(
        F.col("_key").alias(key),
        F.col("_stratum").alias("stratum"),
        "m",
        failed.alias("base_failed"),
        (~failed & ~rejected(m, F.col("_stratum"), chosen)).alias("kept"),
    )
