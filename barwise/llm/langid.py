"""Language identification by multinomial naive Bayes over hashed character n-grams.

Training counts the 1- to 3-grams of lower-cased texts (runs of characters
that are not letters read as one boundary mark) over *all* labelled rows, in
``2**BITS`` hash buckets per language, inside the tasks.  The log-probability
matrix (buckets x languages) is broadcast with the scoring function; a batch's
n-grams are a sparse (document, bucket) list whose matrix rows are gathered and
added up per document in numpy.  Its size is bounded by the number of distinct
languages among the labels, which is taken to be a few hundred at most.

``accepted`` also rejects texts that read like none of the learned languages.
The posterior cannot show that, as it adds up over all n-grams; the measure is
the mean log-probability of an n-gram under the best language.  Its typical
value and spread come from all labelled rows of a language, each scored without
its own counts.  It holds out no fold: model and typical values are those of
every labelled row.

Results for odd input: null texts and texts without a letter get ``und`` and
score 0.  Very long texts are scored whole, in blocks.  Training rows without a
language or text are left out; if none is left, every text is ``und`` with
score 0.  Ties go to the alphabetically first language.  Repeated rows get equal results.
An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barwise.llm.counts import summed

BITS = 16
SEED = 17
SMOOTHING = 0.5
#: Characters handled at a time; the arrays of a block stay in a core's cache.
BLOCK = 1 << 17
#: A text whose best language has a lower posterior is rejected by ``accepted``.
LEAST_SCORE = 0.5
#: So many spreads below its best language's typical mean log-probability a text is rejected.
#: In sf0.01, clean documents reach half of it, and 200 random characters of any script are far beyond.
MOST_BELOW = 15.0
#: Decimals of a mean log-probability that its median is taken of; they bound the values that are counted.
DECIMALS = 4
MARK = 1


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """True for the code points of letters."""
    return np.array([chr(i).isalpha() for i in range(0x110000)])


def _blocks(texts: list[str | None], limit: int = BLOCK) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text number, code point) of about ``limit`` characters at a time, with
    three characters of overlap inside a longer text."""
    rows, parts, size = [], [], 0
    for i, text in enumerate(texts):
        text = (text or "").lower()
        for a in range(0, len(text), limit):
            piece = text[max(0, a - 3): a + limit]
            rows.append((i, len(piece)))
            parts.append(piece)
            size += len(piece)
            if size >= limit:
                yield _points(rows, parts)
                rows, parts, size = [], [], 0
    if parts:
        yield _points(rows, parts)


def _points(rows, parts):
    points = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.repeat([r for r, _ in rows], [n for _, n in rows]), points


def grams(row: np.ndarray, point: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text number, bucket) of the n-grams, one n at a time; texts are in order."""
    letter = _letters()[point]
    value = np.where(letter, point, MARK).astype(np.uint64)
    new = np.ones(len(value), bool)
    new[1:] = row[1:] != row[:-1]
    keep = letter.copy()
    keep[1:] |= letter[:-1] & ~new[1:]  # one mark ends a run of letters
    row, value = row[keep], value[keep]
    for n in (1, 2, 3):
        if len(value) < n:
            return
        h = value[: len(value) - n + 1] + np.uint64(n)
        for j in range(1, n):
            h = h * np.uint64(0x9E3779B97F4A7C15) + value[j: len(value) - n + 1 + j]
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        same = row[: len(row) - n + 1] == row[n - 1:]
        if n == 1:
            same &= value != MARK
        yield row[: len(row) - n + 1][same], (h[same] >> np.uint64(64 - BITS)).astype(np.int64)


def counted(labelled: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages and the (buckets x languages) counts, the rows' in the last row, of all rows (text, lang)."""
    def count(batches: Iterator[pa.RecordBatch]) -> dict[str, np.ndarray]:
        out: dict[str, np.ndarray] = {}
        for batch in batches:
            texts, langs = batch.column(0).to_pylist(), np.array(batch.column(1).to_pylist(), object)
            names, code = np.unique(langs.astype(str), return_inverse=True)
            for name in names:
                out.setdefault(name, np.zeros((1 << BITS) + 1, np.int64))
            for name, k in zip(*np.unique(code, return_counts=True)):
                out[names[name]][-1] += k
            for row, point in _blocks(texts):
                for r, bucket in grams(row, point):
                    for c in np.unique(code[r[np.r_[True, r[1:] != r[:-1]]]]) if len(r) else []:
                        out[names[c]][:-1] += np.bincount(bucket[code[r] == c], minlength=1 << BITS)
        return out

    counts = summed(labelled.where("text is not null and lang is not null").select("text", "lang"), count)
    names = sorted(counts)
    return names, np.stack([counts[x] for x in names], axis=1) if names else np.zeros(((1 << BITS) + 1, 0), np.int64)


def fit(labelled: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages and the (buckets x languages) log-probabilities, the class's
    prior in the last row, of all rows (text, lang)."""
    names, table = counted(labelled)
    return names, log_probabilities(table)


def log_probabilities(table: np.ndarray) -> np.ndarray:
    if not table.shape[1]:
        return table.astype(float)
    seen, docs = table[:-1] + SMOOTHING, table[-1].astype(float)
    return np.vstack([np.log(seen / seen.sum(axis=0)), np.log(docs / docs.sum())])


def typical(labelled: DataFrame, names: list[str], table: np.ndarray) -> np.ndarray:
    """(languages, 3): median and variance of the labelled rows' mean
    log-probabilities, and the variance of one n-gram's share in a mean."""
    shared = labelled.sparkSession.sparkContext.broadcast((names, table, table[:-1].sum(axis=0)))

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, table, total = shared.value
        number = {x: k for k, x in enumerate(names)}
        for batch in batches:
            out = []
            for text, lang in zip(batch["text"], batch["lang"]):
                k = number[lang]
                own = np.zeros(1 << BITS, np.int64)
                for row, point in _blocks([text]):
                    own += np.bincount(np.concatenate([np.zeros(0, np.int64), *(b for _, b in grams(row, point))]), minlength=1 << BITS)
                at, n = np.flatnonzero(own), own.sum()
                if n:
                    p = np.log(table[at, k] - own[at] + SMOOTHING) - np.log(total[k] - n + SMOOTHING * (1 << BITS))
                    mean = (p * own[at]).sum() / n
                    out.append((lang, mean, (((p - mean) ** 2) * own[at]).sum() / n))
            yield pd.DataFrame(out, columns=["lang", "mean", "var"])

    scored = (labelled.where("text is not null and lang is not null").select("text", "lang")
              .mapInPandas(rows, "lang string, mean double, var double"))
    usual = scored.groupBy("lang").agg(F.percentile(F.round("mean", DECIMALS), F.lit(0.5)).alias("mid"),
                                       F.var_pop("mean").alias("own"), F.avg("var").alias("each"))
    out = np.full((len(names), 3), -np.inf)  # a language without an n-gram rejects nothing
    for r in usual.collect():                # one row a language
        # n-grams overlap: neighbours share characters, which widens a mean's spread
        out[names.index(r.lang)] = r.mid, r.own, 4 * r.each
    return out


def predict(docs: DataFrame, names: list[str], model: np.ndarray, usual: np.ndarray | None = None) -> DataFrame:
    """doc_id, text_key, lang_pred, score (the posterior) and below (spreads
    below the language's typical mean log-probability, if given) of every row."""
    weights = model.astype(np.float32)
    shared = docs.sparkSession.sparkContext.broadcast((names, weights))

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, weights = shared.value
        for batch in batches:
            texts = batch["text"].tolist()
            total, any_letter = np.zeros((len(texts), max(1, len(names)))), np.zeros(len(texts), bool)
            n, below = np.zeros(len(texts), np.int64), np.zeros(len(texts))
            for row, point in _blocks(texts, max(1024, 4 * BLOCK // max(4, len(names)))):
                for r, bucket in grams(row, point):
                    if len(r):
                        at = np.flatnonzero(np.r_[True, r[1:] != r[:-1]])
                        any_letter[r[at]] = True
                        n[r[at]] += np.diff(np.r_[at, len(r)])
                        if names:
                            total[r[at]] += np.add.reduceat(weights[bucket], at, axis=0, dtype=np.float64)
            if names:
                plain = total.copy()
                total += weights[-1]
                total -= total.max(axis=1, keepdims=True)
                p = np.exp(total)
                p /= p.sum(axis=1, keepdims=True)
                best = p.argmax(axis=1)
                known, score = np.array(names, object)[best], p[np.arange(len(p)), best]
                if usual is not None:
                    mid, own, each = usual[best].T
                    known_usual = np.isfinite(mid) & (n > 0)
                    with np.errstate(all="ignore"):
                        spread = np.sqrt(own + each / n)
                        below = np.where(known_usual & (spread > 0), (mid - plain[np.arange(len(p)), best] / n) / spread, 0.0)
            else:
                known, score = np.array(["und"] * len(texts), object), np.zeros(len(texts))
            yield pd.DataFrame({"doc_id": batch["doc_id"], "text_key": batch["text_key"], "lang_pred": np.where(any_letter, known, "und"),
                                "score": np.where(any_letter, score, 0.0), "below": below})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text").mapInPandas(
        rows, "doc_id long, text_key long, lang_pred string, score double, below double")


def training_rows(docs: DataFrame, folds: int = 4, held_out: int = 2) -> DataFrame:
    """The rows outside the held-out fold (crc32 of the doc_id as text)."""
    return docs.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds != held_out)


def identify(docs: DataFrame, folds: int = 4, held_out: int = 2) -> DataFrame:
    """Predictions for every row from a model fitted outside the held-out fold.

    A null doc_id belongs to no fold: it is not trained on and not held out.
    """
    names, model = fit(training_rows(docs, folds, held_out))
    out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == held_out, F.lit(False))
    return predict(docs, names, model).withColumn("held_out", out)


def accepted(docs: DataFrame, least_score: float = LEAST_SCORE) -> DataFrame:
    """``docs`` without the rows that have no identified language: null texts,
    texts without a letter, texts whose best language is less likely than
    ``least_score``, and texts more than ``MOST_BELOW`` spreads below it."""
    from barwise.llm.setjoin import checked_broadcast
    from barwise.session import written

    names, table = counted(docs)
    found = predict(docs, names, log_probabilities(table), typical(docs, names, table))
    bad = written(found.where((F.col("lang_pred") == "und") | (F.col("score") < least_score) | (F.col("below") > MOST_BELOW)).select(
        F.col("doc_id").alias("__llm_id"), F.col("text_key").alias("__llm_key")).distinct(), "rejected")
    return docs.join(checked_broadcast(bad, bad.count()), F.col("doc_id").eqNullSafe(F.col("__llm_id")) & (F.xxhash64("text") == F.col("__llm_key")), "left_anti")
