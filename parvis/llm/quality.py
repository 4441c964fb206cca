"""Quality rules whose cutoffs are chosen by risk control on labelled documents.

Every rule is a number that is larger for worse texts. Labelled good documents (``quality``
1) of a stratum (language) serve as holdout: a cutoff is valid if the share of good documents
above it is proven to be at most ``risk / number of rules`` by an exact binomial test, i.e. if
the Clopper-Pearson upper bound of that share lies below it. The error ``delta`` of the whole
statement is split over the strata (Bonferroni). ``CHAIN`` of a stratum's share tests the
cutoffs of all rules in one fixed sequence, the most lenient one of every rule first; testing
ends at the first failure, so no further correction is needed and every test has that whole
error. The rest is split over the rules, each of which is also tested alone from its most
lenient cutoff on, so that a rule which ends the sequence does not hold back the others.
Together: with probability ``1 - delta`` no stratum loses more than ``risk`` of its good
documents. A rule without a valid cutoff is not used in that stratum; the strictest valid
cutoff is used otherwise.

Strata are the ``max_strata`` languages with most labels; all others share one. Labels of
documents that are absent, and null labels, are ignored. Documents failing the base rules are
rejected before, so they do not take part in the tests. Null text: no words. Null and
repeated ids are judged row by row; an id labelled twice takes its lowest quality.
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import TEXT_PART, packed, per_row, store, utf8
from .simhash import _marked, _with_mark

SYMBOLS = b"#*$%&|<>"
FEATURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MORE = ["n_lines", "n_marks", "n_top_word"]
OTHERS = "(others)"
CHAIN = 0.9
"""Share of a stratum's error for the sequence over all rules."""

_CONTINUATION = bytes(range(0x80, 0xC0))


def text_features(text: bytes) -> list[int]:
    """The base numbers of one text, then its lines with words, '!' and '?' marks, and uses of its top word."""
    words = text.split()
    n = len(words)
    chars = len(b"".join(words).translate(None, _CONTINUATION))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = [line for line in text.split(b"\n") if line.strip()]
    dup = len(lines) - len(set(lines))
    windows = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(windows)) < len(windows):
        count: dict = {}
        for w in windows:
            count[w] = count.get(w, 0) + 1
        end = 0
        for i, w in enumerate(windows):
            if count[w] > 1:
                repeated += i + 3 - max(i, end)
                end = i + 3
    marks = text.count(b"!") + text.count(b"?")
    top = 0
    if words:
        seen: dict = {}
        for w in words:
            seen[w] = seen.get(w, 0) + 1
        top = max(seen.values())
    return [n, chars, symbols, dup, repeated, len(lines), marks, top]


def measure(docs: DataFrame, *keep: Column) -> DataFrame:
    """``keep`` columns with the features of ``text`` and ``base_failed``."""
    names = [*FEATURES, *MORE]

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            made = list(zip(*[text_features(t) for t in batch.column("body").to_pylist()]))
            kept = [batch.column(c) for c in batch.schema.names if c != "body"]
            columns = kept + [pa.array(c, pa.int64()) for c in made]
            return pa.RecordBatch.from_arrays(columns, [c for c in batch.schema.names if c != "body"] + names)

        return work

    rows = docs.select(*keep, utf8("text").alias("body"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "body")
    measured = per_row(rows, schema + "".join(f", {n} long" for n in names), make, TEXT_PART)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return measured.withColumn("base_failed", failed)


def rules() -> dict[str, Column]:
    """Name and value (larger is worse) of every rule."""
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return {
        "symbols_per_word": F.col("n_symbols") / words,
        "marks_per_word": F.col("n_marks") / words,
        "duplicate_lines": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "repeated_words": F.col("n_repeat_words") / words,
        "top_word": F.col("n_top_word") / words,
    }


GRID = {
    "symbols_per_word": [2.0, 1.0, 0.7, 0.5, 0.3, 0.2, 0.15, 0.1, 0.05],
    "marks_per_word": [2.0, 1.0, 0.7, 0.5, 0.3, 0.2, 0.15, 0.1],
    "duplicate_lines": [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3],
    "repeated_words": [0.45, 0.4, 0.35, 0.3, 0.25],
    "top_word": [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3],
}
"""Cutoffs of each rule from lenient to strict; a value above the cutoff is rejected."""


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for X ~ Binomial(n, p), summed exactly in logarithms."""
    if k >= n:
        return 1.0
    if p <= 0.0 or p >= 1.0:
        return 1.0 if p <= 0.0 else 0.0
    log_p, log_q, log_n = math.log(p), math.log1p(-p), math.lgamma(n + 1)
    terms = [log_n - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * log_p + (n - i) * log_q for i in range(k + 1)]
    top = max(terms)
    return min(1.0, math.exp(top) * math.fsum(math.exp(t - top) for t in terms))


def upper_bound(k: int, n: int, error: float) -> float:
    """Clopper-Pearson: the largest rate under which ``k`` or fewer of ``n`` has chance ``error``."""
    low, high = 0.0, 1.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if binomial_tail(k, n, mid) > error else (low, mid)
    return high


def strictest_valid(counts: Iterable[int], n: int, limit: float, error: float) -> int | None:
    """Index of the last cutoff before the first one whose rejections are not proven rare."""
    last = None
    for i, k in enumerate(counts):
        if n == 0 or binomial_tail(k, n, limit) > error:
            break
        last = i
    return last


def valid_cutoffs(counts: dict[str, list[int]], n: int, limit: float, error: float) -> dict[str, int]:
    """Index of the strictest valid cutoff by rule, from the rejections of ``n`` good documents by each cutoff."""
    sequence = sorted((i, order, r) for order, r in enumerate(counts) for i in range(len(counts[r])))
    last = strictest_valid([counts[r][i] for i, _, r in sequence], n, limit, CHAIN * error)
    valid = {r: i for i, _, r in sequence[: 0 if last is None else last + 1]}
    for r, own in counts.items():
        at = strictest_valid(own, n, limit, (1 - CHAIN) * error / len(counts))
        if at is not None:
            valid[r] = max(at, valid.get(r, at))
    return valid


@dataclass(frozen=True)
class Cutoffs:
    strata: list[str] = field(default_factory=list)
    valid: dict[tuple[str, str], float] = field(default_factory=dict)
    """Cutoff by stratum and rule."""

    def stratum(self) -> Column:
        return F.when(F.col("lang").isin(self.strata), F.col("lang")).otherwise(OTHERS) if self.strata else F.lit(OTHERS)

    def rejected(self) -> Column:
        """Whether any valid cutoff of the row's stratum is exceeded."""
        values, stratum = rules(), self.stratum()
        hits = [(stratum == s) & (values[r] > cut) for (s, r), cut in sorted(self.valid.items())]
        return reduce(Column.__or__, hits, F.lit(False))


def fit_cutoffs(
    measured: DataFrame, labels: DataFrame, risk: float = 0.05, delta: float = 0.05, max_strata: int = 32
) -> Cutoffs:
    """Cutoffs from ``measured`` (doc_id, lang, features) and ``labels`` (doc_id, quality).

    Only counts per stratum, rule and cutoff reach the driver: at most ``max_strata + 1`` rows.
    """
    good = labels.groupBy("doc_id").agg(F.min("quality").alias("quality")).filter("quality = 1").select("doc_id")
    holdout = measured.filter(~F.col("base_failed")).join(good, "doc_id", "left_semi")
    values = rules()
    counts = [F.count_if(values[r] > cut).alias(f"{r}:{i}") for r in GRID for i, cut in enumerate(GRID[r])]
    largest = holdout.filter("lang is not null").groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(max_strata)
    strata = [r["lang"] for r in largest.collect()]
    found = holdout.groupBy(Cutoffs(strata).stratum().alias("stratum")).agg(F.count(F.lit(1)).alias("n"), *counts).collect()
    valid = {}
    for row in found:
        rejections = {r: [row[f"{r}:{i}"] for i in range(len(grid))] for r, grid in GRID.items()}
        for r, at in valid_cutoffs(rejections, row["n"], risk / len(GRID), delta / len(found)).items():
            valid[row["stratum"], r] = GRID[r][at]
    return Cutoffs(strata, valid)


def judge(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """doc_id, lang, features, base_failed and ``kept`` of every document, without texts."""
    measured = store(measure(docs, F.col("doc_id"), F.col("lang")), "features")
    cutoffs = fit_cutoffs(measured, labels, **settings)
    return measured.withColumn("kept", ~F.col("base_failed") & ~cutoffs.rejected())


def measure_labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, lang, features, base_failed) of the labelled documents.

    A bitmap of their ids tells which texts to measure, so that no text is shuffled for the join.
    """
    known = store(labels.filter("quality is not null").select("doc_id").distinct(), "known")
    marks = store(_marked(known, ["doc_id"]), "marks")
    perhaps = _with_mark(docs.select("doc_id", "lang", "text"), marks, ["doc_id"]).filter("marked")
    measured = store(measure(perhaps, F.col("doc_id"), F.col("lang")), "features")
    return measured.join(known, "doc_id", "left_semi")


def keep_good(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """``docs`` without the documents that the rules reject."""
    cutoffs = fit_cutoffs(measure_labelled(docs, labels), labels, **settings)
    rows = packed(docs, F.col("text"), F.col("lang"))
    measured = measure(rows, F.col("row"), F.col("lang"))
    return measured.filter(~F.col("base_failed") & ~cutoffs.rejected()).select("row.*")
