"""Toxicity by compression distance.

Two zstandard dictionaries are built from labelled text. Both hold a part trained
on ordinary text; the toxic one ends with words typical of toxic text (not with a
part zstandard has trained on it, which tells the classes apart much worse), the
ordinary one with filler of the same length, so that offsets cost the same. Each
text is cut in overlapping windows of a few words, and the bytes a window saves
with the toxic dictionary tell how toxic it reads. A logistic curve over the best
windows of a text is calibrated on labelled texts that built no dictionary.

Scoring is row-wise: no shuffle, and what travels to the tasks is a few kilobytes.

Defined results: NULL and empty texts score as a text of one blank window. Without
toxic training texts every score is 0, without ordinary ones 1. Repeated rows score
alike; a label that is NULL, or of an id no document has, is not used, and of
contradicting labels the higher counts.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.llm.common import fold, freed

#: Bounds of the labelled sample: texts per class for the dictionaries, texts for the
#: calibration, characters per text. It is chosen by a hash of the id.
FIT_TOXIC = 1_500
FIT_ORDINARY = 3_000
FIT_CALIBRATION = 4_000
FIT_CHARS = 20_000
#: Folds of the ids (see ``common.fold``) that build dictionaries and calibrate.
DICTIONARY_FOLDS = (1, 2)
CALIBRATION_FOLDS = (3, 4)

WINDOW = 32
STRIDE = 24
LEVEL = 6
DICTIONARY_BYTES = 7_000
#: Chance that anything is taken for typical of toxic text where nothing is.
CHANCE = 0.05
#: Times something typical must be more frequent in toxic than in ordinary text.
RARER = 20
#: Pieces of 96 bytes the dictionary trainer gets; it takes memory on the driver.
TRAINER_SAMPLES = 15_000
#: Bytes in a gram, and on each side of it that tell one use of it from a copy.
GRAM = 6
CONTEXT = 8
#: Savings of a window up to here are noise.
NOISE = 3
#: Bytes of text compressed in one call.
CALL_BYTES = 1_000_000


def plain(text: str) -> bytes:
    return b" " + " ".join(text.lower().split()).encode() + b" "


def _bytes(data: bytes) -> np.ndarray:
    return np.frombuffer(data, dtype=np.uint8).astype(np.uint64)


def grams(data: bytes) -> np.ndarray:
    """All grams of padded bytes as numbers."""
    b = _bytes(data)
    n = max(0, len(b) - GRAM - 2 * CONTEXT + 1)
    gram = np.zeros(n, np.uint64)
    for k in range(GRAM):
        gram |= b[CONTEXT + k : CONTEXT + k + n] << np.uint64(8 * k)
    return gram


def surroundings(data: bytes, at: np.ndarray) -> np.ndarray:
    """A hash of the grams at some places with what stands around them."""
    b, around = _bytes(data), np.zeros(len(at), np.uint64)
    for k in range(GRAM + 2 * CONTEXT):
        around = around * np.uint64(0x9E3779B97F4A7C15) + b[at + k] + np.uint64(1)
    return around


def padded(data: bytes) -> bytes:
    return b" " * CONTEXT + data + b" " * CONTEXT


#: Counting works on so many parts of the grams in turn, which bounds the driver's memory.
PARTS = 4


def frequent(texts: list[bytes], least: float) -> np.ndarray:
    """Grams that occur at least so many times, sorted."""
    found = []
    for part in range(PARTS):
        some = []
        for text in texts:
            g = grams(padded(text))
            some.append(g[(g >> np.uint64(8)) % np.uint64(PARTS) == part])
        gram, n = np.unique(np.concatenate(some), return_counts=True)
        found.append(gram[n >= least])
    return np.sort(np.concatenate(found))


def uses(texts: list[bytes], wanted: np.ndarray) -> tuple[np.ndarray, int]:
    """In how many different surroundings each wanted gram occurs, and the number of all grams.

    Copies of a passage count once.
    """
    count, total = np.zeros(len(wanted), dtype=np.int64), 0
    for part in range(PARTS):
        some = wanted[part::PARTS]
        if not len(some):
            continue
        gram, around = [], []
        for text in texts:
            data = padded(text)
            g = grams(data)
            at = np.minimum(np.searchsorted(some, g), len(some) - 1)
            hit = np.flatnonzero(some[at] == g)
            gram.append(at[hit].astype(np.int32))
            around.append(surroundings(data, hit))
        _, first = np.unique(np.concatenate(around), return_index=True)
        count[part::PARTS] = np.bincount(np.concatenate(gram)[first], minlength=len(some))
    for text in texts:
        total += max(0, len(text) - GRAM + 1)
    return count, total


def typical(n: np.ndarray, total: int, there: np.ndarray, other_total: int) -> np.ndarray:
    """Which counts of toxic text are too high, against ordinary text, to come by chance.

    By Chernoff's bound of the binomial tail and Bonferroni's correction over all counts,
    so how many uses are needed follows from the samples.
    """
    n, there = np.asarray(n, float), np.asarray(there, float)
    share, even = n / (n + there), total / (total + other_total)
    other = np.maximum(1 - share, 1e-300)
    unlike = share * np.log(share / even) + (1 - share) * np.log(other / (1 - even))
    sure = (n + there) * unlike > np.log(max(len(n), 1) / CHANCE)
    return sure & (share > even) & ((there + 1) / other_total * RARER < n / total)


#: What ends a word.
BETWEEN = re.compile(rb"[ .,;:!?]+")


def typical_words(toxic: list[bytes], ordinary: list[bytes]) -> list[bytes]:
    """Words of toxic texts that are typical or hold a typical gram, most frequent first."""
    gram = frequent(toxic, 3)
    n, total = uses(toxic, gram)
    there, other_total = uses(ordinary, gram)
    stems = gram[typical(n, max(total, 1), there, max(other_total, 1))]
    held = Counter(w for t in toxic for w in set(BETWEEN.split(t)) if w)
    held = Counter({w: n for w, n in held.items() if n >= 3})
    seen = Counter(w for t in ordinary for w in set(BETWEEN.split(t)) if w in held)
    words: Counter[bytes] = Counter()
    for text in toxic:
        found = set()
        for i in np.flatnonzero(np.isin(grams(padded(text)), stems)):
            start = i + (text[i : i + 1] == b" ")
            start = text.rfind(b" ", 0, start) + 1
            found.add(text[start : text.find(b" ", start + 1)].strip(b".,;:!?"))
        words.update(w for w in found if w)
    kept = {w: n for w, n in words.items() if n >= 3 and 10 * seen[w] < n}
    # Short words have no gram of their own.
    names = list(held)
    counts = [np.array([c[w] for w in names], dtype=float) for c in (held, seen)]
    for i in np.flatnonzero(typical(counts[0], len(toxic), counts[1], len(ordinary))):
        kept.setdefault(names[i], held[names[i]])
    return sorted(kept, key=lambda w: (-kept[w], w))


def dictionaries(toxic: list[str], ordinary: list[str]) -> tuple[bytes, bytes]:
    """Contents of the toxic and of the ordinary dictionary."""
    import zstandard

    toxic = sorted({plain(t) for t in toxic})
    ordinary = sorted({plain(t) for t in ordinary})
    samples = [t[i : i + 96] for t in ordinary for i in range(0, len(t), 96)]
    samples = samples[:: -(-len(samples) // TRAINER_SAMPLES) or 1]
    try:
        shared = zstandard.train_dictionary(DICTIONARY_BYTES + 1_000, samples).as_bytes()
        shared = shared[-DICTIONARY_BYTES:]
    except (zstandard.ZstdError, ValueError):  # too few samples for the trainer
        shared = b"".join(samples)[:DICTIONARY_BYTES]
    # Nearer to the window is cheaper, so the most frequent words come last.
    words = b"".join(b" " + w + b" " for w in reversed(typical_words(toxic, ordinary)))
    return shared + words, shared + b"\0" * len(words)


def compressor(content: bytes):
    import zstandard

    settings = zstandard.ZstdCompressionParameters.from_level(
        LEVEL,
        write_checksum=0,
        write_content_size=0,
        write_dict_id=0,
        format=zstandard.FORMAT_ZSTD1_MAGICLESS,
    )
    held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    held.precompute_compress(compression_params=settings)
    return zstandard.ZstdCompressor(dict_data=held, compression_params=settings)


def savings(toxic, ordinary, texts: list[bytes]) -> list[np.ndarray]:
    """Bytes each window of each text saves with the toxic dictionary."""
    import zstandard

    starts = [np.arange(0, max(1, len(t) - WINDOW + STRIDE), STRIDE) for t in texts]
    offset = np.cumsum([0] + [len(t) for t in texts])
    cuts = np.concatenate(
        [
            np.stack([s + o, np.minimum(WINDOW, len(t) - s)], 1)
            for s, o, t in zip(starts, offset[:-1], texts, strict=True)
        ]
    ).astype(np.uint64)
    windows = zstandard.BufferWithSegments(b"".join(texts), cuts.tobytes())
    size = [
        np.fromiter((len(w) for w in c.multi_compress_to_buffer(windows, threads=1)), int)
        for c in (ordinary, toxic)
    ]
    return np.split(size[0] - size[1], np.cumsum([len(s) for s in starts])[:-1])


def features(saved: np.ndarray) -> tuple[float, ...]:
    top = np.sort(np.concatenate([saved, [0, 0, 0]]))[::-1]
    above = np.maximum(saved - NOISE, 0).sum()
    return (
        top[0],
        top[1],
        top[2],
        np.log(len(saved)),
        above**0.5,
        above / len(saved) ** 0.5,
        float(top[0] >= 5),
    )


def text_features(toxic, ordinary, texts: list[str]) -> np.ndarray:
    rows, part, size = [], [], 0
    for text in texts:
        part.append(plain(text))
        size += len(part[-1])
        if size >= CALL_BYTES:
            rows += [features(s) for s in savings(toxic, ordinary, part)]
            part, size = [], 0
    if part:
        rows += [features(s) for s in savings(toxic, ordinary, part)]
    return np.array(rows, dtype=float).reshape(-1, 7)


@dataclass
class Model:
    toxic: bytes = b""
    ordinary: bytes = b""
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    weights: np.ndarray | None = None
    constant: float = 0.0

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        z = np.c_[(x - self.mean) / self.scale, np.ones(len(x))] @ self.weights
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def score(self, text: Column) -> Column:
        """Probability that a text is toxic, as a column."""
        if self.weights is None:
            return F.lit(self.constant)
        shared = self

        @F.pandas_udf("double")
        def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            pair = compressor(shared.toxic), compressor(shared.ordinary)
            for texts in freed(batches):
                x = text_features(*pair, texts.fillna("").tolist())
                yield pd.Series(shared.probabilities(x), dtype=float)

        return scored(text)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.01) -> tuple[np.ndarray, ...]:
    """Newton's method; returns means, scales and weights, the constant last."""
    mean, scale = x.mean(0), x.std(0) + 1e-9
    z = np.c_[(x - mean) / scale, np.ones(len(x))]
    w = np.zeros(z.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve(
            (z * (p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(w)), z.T @ (p - y) + ridge * w
        )
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return mean, scale, w


def labelled_sample(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str):
    """Rows (text, label, calibrates) of the sample. Only its ids, a bounded set, are broadcast."""
    marked = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull())
    marked = marked.groupBy(F.col(key).alias("_key")).agg(F.max(label).alias("_label"))
    marked = marked.withColumn("_fold", fold(F.col("_key")))
    mix = F.xxhash64("_key")
    builds = F.col("_fold").isin(*DICTIONARY_FOLDS)
    chosen = (
        marked.where(builds & (F.col("_label") == 1)).orderBy(mix).limit(FIT_TOXIC)
        .unionByName(marked.where(builds & (F.col("_label") != 1)).orderBy(mix).limit(FIT_ORDINARY))
        .unionByName(
            marked.where(F.col("_fold").isin(*CALIBRATION_FOLDS)).orderBy(mix)
            .limit(FIT_CALIBRATION)
        )
    )
    texts = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).where(
        F.col("_text").isNotNull() & (F.length("_text") <= FIT_CHARS)
    )
    rows = texts.join(F.broadcast(chosen), "_key").dropDuplicates(["_key"]).collect()
    return [
        (r["_text"], int(r["_label"] == 1), r["_fold"] in CALIBRATION_FOLDS)
        for r in sorted(rows, key=lambda r: str(r["_key"]))
    ]


def fit(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
) -> Model:
    sample = labelled_sample(docs, labels, key, text, label)
    build = [[t for t, y, c in sample if y == want and not c] for want in (0, 1)]
    graded = [(t, y) for t, y, c in sample if c]
    classes = {y for _, y, _ in sample}
    if len(classes) < 2 or not all(build) or len({y for _, y in graded}) < 2:
        # One class only, or too few rows to compare: the share of toxic rows is all one can say.
        return Model(constant=float(np.mean([y for _, y, _ in sample])) if sample else 0.0)
    toxic, ordinary = dictionaries(build[1], build[0])
    x = text_features(compressor(toxic), compressor(ordinary), [t for t, _ in graded])
    mean, scale, weights = logistic(x, np.array([y for _, y in graded], dtype=float))
    return Model(toxic, ordinary, mean, scale, weights)
