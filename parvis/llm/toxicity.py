"""Toxicity by a support vector machine on a subsequence string kernel with Nyström landmarks.

Words are compared by the gap-weighted subsequence kernel (Lodhi et al. 2002): common
subsequences of three letters count with ``DECAY`` for every letter they span, normalised to 1
for equal words. A word with inserted, split or changed endings thus stays near its source.
Letters inside a token are joined over signs ("i.d.i.o.t"), and so are runs of single letters
("i d i o t"); tokens above ``WIDTH`` letters are read in overlapping pieces.

Training uses a bounded sample of labelled documents (``max_toxic`` and ``max_clean`` per class,
chosen by a hash of the id; copies of a text once):

1. words that documents of class 1 hold more often are candidates for landmarks; candidates
   are chosen greedily by the documents in which they or words near them occur;
2. sentences are the units: each is represented by its word nearest to the landmarks, as the
   Nyström features ``k(word, landmarks) K^(-1/2)``; sentences of clean documents are negative,
   of a toxic document the best sentence is positive (MI-SVM, squared hinge loss);
3. the best sentence's decision value becomes a probability by logistic calibration.

A document scores as its best word does; all words of all texts are scored. A word that shares
too few gapped letter pairs with any landmark has kernel 0 to it. Texts without words get the
score of kernel 0. With labels of one class only, the score is the share of that class.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import per_row, store, utf8

WIDTH = 16
DECAY = 0.6
GAPS = (1, 2, 3)
SHARED = 0.4
"""Share of a landmark's gapped letter pairs that a word must have."""
NEAR = 0.45
"""Kernel value from which a word counts as an occurrence of a candidate."""
CACHE = 400_000

_signs = re.compile(r"[\W\d_]+")
_spelled = re.compile(r"(?<!\S)[^\W\d_](?:[^\w\n]{1,3}[^\W\d_]){2,}(?!\S)")
_sentence = re.compile(r"[.!?\n]+(?:\s|$)|\n")


def letters(token: str) -> str:
    return token if token.isalpha() else _signs.sub("", token)


def spelled(text: str) -> list[str]:
    """Words spelled in single letters."""
    return [_signs.sub("", m) for m in _spelled.findall(text)]


def parts(word: str) -> list[str]:
    """The word, or its overlapping pieces if it is long."""
    if len(word) <= WIDTH:
        return [word]
    step = WIDTH // 2
    return [word[i : i + WIDTH] for i in range(0, len(word) - step, step)]


def codes(words: list[str]) -> np.ndarray:
    """Letters as numbers, one row of ``WIDTH`` per word, 0 after its end."""
    text = "".join([w.ljust(WIDTH, "\0") for w in words])
    return np.frombuffer(text.encode("utf-32-le", "replace"), np.int32).reshape(-1, WIDTH)


def kernel(s: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Subsequence kernel of order 3 of the rows of two code tables, pair by pair."""
    n, decay = len(s), np.float32(DECAY)
    width_s, width_t = int((s > 0).sum(axis=1).max(initial=0)), int((t > 0).sum(axis=1).max(initial=0))
    columns = [np.ascontiguousarray(t[:, k]) for k in range(width_t)]
    zero = np.zeros(n, np.float32)
    one, two = [zero] * (width_t + 1), [zero] * (width_t + 1)
    total = np.zeros(n, np.float32)
    for j in range(width_s):
        letter = np.ascontiguousarray(s[:, j])
        letter = np.where(letter > 0, letter, -1)
        run_one, run_two, new_one, new_two = zero, zero, [zero], [zero]
        for k in range(width_t):
            same = (letter == columns[k]).astype(np.float32) * (decay * decay)
            total += same * two[k]
            run_two = decay * run_two + same * one[k]
            run_one = decay * run_one + same
            new_two.append(decay * two[k + 1] + run_two)
            new_one.append(decay * one[k + 1] + run_one)
        one, two = new_one, new_two
    return total


def sketches(table: np.ndarray) -> np.ndarray:
    """256 bits per word: which gapped letter pairs it has."""
    bits = np.zeros((len(table), 257), bool)
    rows = np.arange(len(table))
    for gap in GAPS:
        for j in range(WIDTH - gap):
            a, b = table[:, j], table[:, j + gap]
            bits[rows, np.where(b > 0, (a * 37 + b * 101) % 256, 256)] = True
    return np.packbits(bits[:, :256], axis=1).view(np.uint64)


class Landmarks:
    """Normalised kernel between words and a fixed list of words."""

    def __init__(self, words: list[str]):
        self.words = words
        self.table = codes(words)
        self.sketch = sketches(self.table)
        self.needed = np.ceil(np.bitwise_count(self.sketch).sum(axis=1) * SHARED)
        self.own = np.sqrt(kernel(self.table, self.table))

    def values(self, words: list[str]) -> np.ndarray:
        result = np.zeros((len(words), len(self.words)), np.float32)
        for at in range(0, len(words), 8192):
            table = codes(words[at : at + 8192])
            mine = sketches(table)
            shared = np.zeros((len(table), len(self.words)), np.int32)
            for b in range(4):
                shared += np.bitwise_count(mine[:, b, None] & self.sketch[None, :, b])
            w, k = np.nonzero(shared >= np.maximum(self.needed, 1))
            if len(w):
                alone = np.unique(w)
                own = np.zeros(len(table), np.float32)
                own[alone] = np.sqrt(kernel(table[alone], table[alone]))
                norm = own[w] * self.own[k]
                value = kernel(table[w], self.table[k])
                result[at + w, k] = np.divide(value, norm, out=np.zeros_like(value), where=norm > 0)
        return result


@dataclass
class Model:
    landmarks: list[str]
    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def decisions(self, kernels: np.ndarray) -> np.ndarray:
        return kernels @ self.weights + self.bias

    def score(self, decision: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * decision + self.offset, -30, 30)))


def nystroem(matrix: np.ndarray) -> np.ndarray:
    """K^(-1/2) of the landmarks' kernel matrix."""
    values, vectors = np.linalg.eigh((matrix + matrix.T) / 2)
    return vectors @ np.diag(1 / np.sqrt(np.maximum(values, 1e-3))) @ vectors.T


def svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 1e-5) -> np.ndarray:
    """Linear SVM (squared hinge, Newton steps); the last coefficient is the bias."""
    x = np.hstack([x, np.ones((len(x), 1))])
    ridge = penalty * np.eye(x.shape[1])
    ridge[-1, -1] = 1e-8
    beta = np.zeros(x.shape[1])
    for _ in range(30):
        active = y * (x @ beta) < 1
        a, w = x[active], weight[active, None]
        new = np.linalg.solve(a.T @ (w * a) + ridge, a.T @ (weight[active] * y[active]))
        if np.allclose(new, beta, atol=1e-8):
            break
        beta = new
    return beta


def calibrate(decision: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve, with a little smoothing of the labels."""
    target = np.where(y > 0, (weight[y > 0].sum() + 1) / (weight[y > 0].sum() + 2), 1 / (weight[y < 0].sum() + 2))
    x = np.stack([decision, np.ones(len(decision))], axis=1)
    beta = np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve(x.T @ ((weight * p * (1 - p))[:, None] * x) + 1e-3 * np.eye(2), x.T @ (weight * (target - p)) - 1e-3 * beta)
        beta = beta + np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-7:
            break
    return float(beta[0]), float(beta[1])


def sentences(text: str) -> list[list[str]]:
    """The words of each sentence."""
    found = []
    for sentence in _sentence.split(text.lower()):
        words = {p for t in sentence.split() for p in parts(letters(t)) if p} | {p for w in spelled(sentence) for p in parts(w)}
        if words:
            found.append(sorted(words))
    return found


def training_sample(docs: DataFrame, labels: DataFrame, train: Column, max_toxic: int, max_clean: int) -> DataFrame:
    """(text, toxic): at most so many labelled documents of each class; written."""
    known = labels.filter("toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.filter(train)
    sides = [known.filter(t).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n) for t, n in (("toxic > 0", max_toxic), ("toxic <= 0", max_clean))]
    chosen = sides[0].unionAll(sides[1])
    rows = docs.select("doc_id", utf8("text").alias("text")).join(chosen, "doc_id")
    rows = rows.groupBy(F.xxhash64("text")).agg(F.first("text").alias("text"), F.max("toxic").alias("toxic"))
    return store(rows.select("text", "toxic"), "sample")


def candidates(sample: DataFrame, most: int) -> tuple[list[str], list[str]]:
    """Words that speak for class 1, and the most common words of class 0."""

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            words, toxic = [], []
            for text, label in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                mine = {w for s in sentences(text.decode("utf-8", "replace")) for w in s if len(w) > 2}
                words += mine
                toxic += [int(label > 0)] * len(mine)
            return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(toxic, pa.int32())], ["word", "toxic"])

        return work

    counted = per_row(sample, "word string, toxic int", make).groupBy("word").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c"))
    counted = store(counted.filter("t > 1 or c > 1"), "words")
    sizes = sample.agg(F.count_if(F.col("toxic") > 0).alias("t"), F.count_if(F.col("toxic") <= 0).alias("c")).first()
    lead = (F.col("t") + 0.5) / (sizes["t"] + 1) / ((F.col("c") + 0.5) / (sizes["c"] + 1))
    speaking = counted.filter("t > 1").orderBy(F.desc(F.log(lead) * F.sqrt("t")), "word").limit(most)
    common = counted.filter("c > 1").orderBy(F.desc("c"), "word").limit(most // 16)
    return [r["word"] for r in speaking.collect()], [r["word"] for r in common.collect()]


def choose(sample: DataFrame, words: list[str], most: int) -> list[str]:
    """Greedy choice of landmarks by the documents in which words near them occur."""

    def make():
        marks = Landmarks(words)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            near = []
            for text in batch.column("text").to_pylist():
                mine = sorted({w for s in sentences(text.decode("utf-8", "replace")) for w in s if len(w) > 2})
                near.append(np.flatnonzero((marks.values(mine) >= NEAR).any(axis=0)))
            return pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(near, pa.list_(pa.int64()))], ["toxic", "near"])

        return work

    rows = per_row(sample, f"toxic {sample.schema['toxic'].dataType.simpleString()}, near array<long>", make).collect()
    table = np.zeros((len(rows), len(words)), bool)
    for i, r in enumerate(rows):
        table[i, r["near"]] = True
    toxic = np.array([r["toxic"] > 0 for r in rows], bool)
    n_toxic, n_clean = max(1, toxic.sum()), max(1, (~toxic).sum())
    cost = table[~toxic].sum(axis=0) / n_clean * n_toxic * 5
    need = np.full(len(rows), 3.0)  # a document is covered by three landmarks
    need[~toxic] = 0
    chosen: list[int] = []
    while len(chosen) < most:
        gain = (np.minimum(need, 1) @ table) - cost
        gain[chosen] = -1
        best = int(np.argmax(gain)) if len(gain) else -1
        if best < 0 or gain[best] < 2:
            break
        chosen.append(best)
        need[table[:, best]] = np.maximum(need[table[:, best]] - 1, 0)
    return [words[i] for i in chosen]


def instances(sample: DataFrame, landmarks: list[str], n_speaking: int, per_text: int) -> list[tuple[bool, np.ndarray]]:
    """Label and kernel rows of the best sentences, near a landmark, of every sampled document."""

    def make():
        marks = Landmarks(landmarks)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = []
            for text in batch.column("text").to_pylist():
                bags = sentences(text.decode("utf-8", "replace"))
                values = marks.values([w for b in bags for w in b])
                best = values[:, :n_speaking].max(axis=1, initial=0)
                rows, at = [], 0
                for bag in bags:
                    rows.append(at + int(np.argmax(best[at : at + len(bag)])))
                    at += len(bag)
                rows = sorted((r for r in rows if best[r] >= NEAR), key=lambda r: -best[r])[:per_text]
                found.append(values[rows].ravel())
            return pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(found, pa.list_(pa.float32()))], ["toxic", "rows"])

        return work

    schema = f"toxic {sample.schema['toxic'].dataType.simpleString()}, rows array<float>"
    rows = per_row(sample, schema, make).collect()
    return [(r["toxic"] > 0, np.array(r["rows"], np.float64).reshape(-1, len(landmarks))) for r in rows]


def fit(
    docs: DataFrame,
    labels: DataFrame,
    train: Column | None = None,
    max_toxic: int = 2000,
    max_clean: int = 4000,
    n_candidates: int = 320,
    n_landmarks: int = 48,
) -> Model:
    """Fit to documents (doc_id, text) and labels (doc_id, toxic) for which ``train`` holds."""
    sample = training_sample(docs, labels, F.lit(True) if train is None else train, max_toxic, max_clean)
    speaking, common = candidates(sample, n_candidates)
    speaking = choose(sample, speaking, n_landmarks)
    landmarks = list(dict.fromkeys(speaking + common[: max(1, n_landmarks // 4)]))
    if not speaking:
        share = sample.agg(F.avg((F.col("toxic") > 0).cast("double"))).first()[0]
        share = min(max(share if share is not None else 0.0, 1e-6), 1 - 1e-6)
        return Model([], np.zeros(0), 0.0, 1.0, float(np.log(share / (1 - share))))
    bags = instances(sample, landmarks, len(speaking), per_text=6)
    root = nystroem(Landmarks(landmarks).values(landmarks).astype(np.float64))
    zero = np.zeros((1, len(landmarks)))
    bags = [(t, np.vstack([rows, zero]) @ root) for t, rows in bags]
    x_clean = np.vstack([zero @ root, *[b for t, b in bags if not t]])
    # A toxic document without a word near any landmark has no witness to learn from.
    toxic = [b for t, b in bags if t and (len(b) > 1)]
    witness = [b[0] for b in toxic]  # the sentence nearest to a landmark
    beta = np.zeros(len(landmarks) + 1)
    for _ in range(4):
        x = np.vstack([x_clean, *witness])
        y = np.append(-np.ones(len(x_clean)), np.ones(len(witness)))
        beta = svm(x, y, np.where(y > 0, 1.0 / max(1, len(witness)), 1.0 / len(x_clean)))
        witness = [b[int(np.argmax(b @ beta[:-1]))] for b in toxic]
    decision = np.array([(b @ beta[:-1]).max() + beta[-1] for _, b in bags])
    y = np.array([1.0 if t else -1.0 for t, _ in bags])
    slope, offset = calibrate(decision, y, np.ones(len(y)))
    return Model(landmarks, root @ beta[:-1], float(beta[-1]), slope, offset)


class Scorer:
    """Scores texts, with a memory of the tokens seen."""

    def __init__(self, model: Model):
        self.model = model
        self.marks = Landmarks(model.landmarks) if model.landmarks else None
        self.known: dict[str, float] = {}

    def learn(self, tokens: Iterable[str]) -> None:
        if len(self.known) > CACHE:
            self.known = {}
        new = [t for t in tokens if t not in self.known]
        words, owner = [], []
        for i, t in enumerate(new):
            for p in parts(letters(t)):
                words.append(p)
                owner.append(i)
        best = np.full(len(new), -np.inf)
        if words:
            np.maximum.at(best, owner, self.model.decisions(self.marks.values(words)))
        self.known.update(zip(new, best.tolist()))

    def scores(self, texts: list[bytes]) -> np.ndarray:
        none = float(self.model.bias)
        best = np.full(len(texts), none)
        if self.marks:
            bags = []
            for text in texts:
                lowered = text.decode("utf-8", "replace").lower()
                bags.append({*lowered.split(), *spelled(lowered)})
            self.learn(set().union(*bags))
            get = self.known
            for i, bag in enumerate(bags):
                if bag:
                    best[i] = max(none, max(map(get.__getitem__, bag)))
        return self.model.score(best)


def score(docs: DataFrame, model: Model, *keep: Column) -> DataFrame:
    """``keep`` columns with ``score`` and ``predicted``."""
    rows = docs.select(*keep, utf8("text").alias("body"))
    names = [f.name for f in rows.schema if f.name != "body"]

    def make():
        scorer = Scorer(model)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = batch.column("body").to_pylist()
            found = np.concatenate([scorer.scores(texts[a : a + 128]) for a in range(0, len(texts), 128)])
            made = [pa.array(found, pa.float64()), pa.array((found >= 0.5).astype(np.int32))]
            return pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], *made], [*names, "score", "predicted"])

        return work

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "body")
    return per_row(rows, schema + ", score double, predicted int", make)
