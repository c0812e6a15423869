"""Toxicity scores from the nearest labelled examples.

Texts become TF-IDF vectors of length one over all terms of the labelled examples: words,
and pairs of characters where a script is written without spaces.  None is left out; beginnings of
words are added where they tell toxic examples, which catches inflections.  Each term weighs by its inverse document frequency times ``FLOOR`` plus the share of the
label's entropy that the term takes away (supervised term weighting, after Debole and Sebastiani).
Without that factor the neighbours of a long text are those on its topic, whatever its tone.
Terms that no example has can't add to a product and have no document frequency; they don't
count in the norm either.

The examples lie in an inverted index in sparse form: postings by term and block of examples, with
the largest weight of each term in each block.  The terms that many examples have form a matrix besides,
whose products with many queries at a time are exact sums to begin with.  A query bounds every block by
these sums and the largest weights of its other terms, and adds these terms' postings in the
blocks that may hold one of the k, so its neighbours are the exact ones.  Neighbours vote with weights that grow with their similarity; the vote is
turned into a probability by a logistic curve fitted on votes that leave the example itself out.

The classifier is fitted on a bounded sample of labelled rows (``examples``, half of it for each
label, in the order of a hash); the sample's terms and its index are bounded with it and are
all that comes to the driver.  Every text is then scored whole.

Null and empty texts, and texts that share no term with an example, have no neighbours and score the
smoothed share of toxic examples among those without a term that tells toxic ones.  Repeated
labels of a document count once, toxic if any says so; null labels and labels of missing
documents don't count.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelattice.llm.common import Packed
from ratelattice.sources.kept import keep

EXAMPLES, NEIGHBOURS, BLOCK = 3_000, 15, 128
CALIBRATED = 2_000  # examples whose own votes calibrate the score
FLOOR = 0.002  # of a term's relevance: what a term weighs that says nothing about the label
FREQUENT = 10  # a term that more than one example in so many has is frequent
TELLING = 25.0  # likelihood ratio of terms that tell toxic examples: beginnings of words that count, words that an empty text lacks
_PREFIXES = (4, 5, 6)
_WORDS = re.compile(r"[^\W\d_]{2,}")
# scripts written without spaces: Thai to Myanmar, Khmer, kana and Han
_UNSPACED = re.compile("[\u0e00-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")
STEEPEST = 8.0  # slope and shift of the calibration curve
_CACHED = 200_000  # words whose terms a worker remembers, no longer than 40 letters each


def word_terms(word: str) -> list[str]:
    if _UNSPACED.search(word):
        return [word[i : i + 2] for i in range(len(word) - 1)]
    return [word, *(f"{word[:n]}*" for n in _PREFIXES if len(word) > n)]


@dataclass
class Index:
    """Block-max inverted index of unit vectors, sparse.

    ``postings`` are sorted by (term, example); an entry is the run of a term's postings in one block.
    """

    idf: Sequence[float]
    number: dict[str, int]
    k: int = NEIGHBOURS
    labels: np.ndarray = field(default_factory=lambda: np.zeros(0))
    names: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int64))
    postings: tuple[np.ndarray, np.ndarray] = field(default_factory=lambda: (np.zeros(0, np.int64), np.zeros(0)))
    entries: tuple[np.ndarray, np.ndarray, np.ndarray] = field(default_factory=lambda: (np.zeros(0, np.int64), np.zeros(0), np.zeros(1, np.int64)))  # block, largest weight, first posting
    first: np.ndarray = field(default_factory=lambda: np.zeros(1, dtype=np.int64))  # of each term: its first entry
    empty_share: float = 0.0
    curve: tuple[float, float] = (1.0, 0.0)
    weight: float = 1.0
    cache: dict[str, tuple[int, ...]] = field(default_factory=dict)
    frequent: tuple[np.ndarray, np.ndarray] | None = None  # row of each term, or -1, and the matrix; made from the postings where it is used

    def __getstate__(self) -> dict:
        return self.__dict__ | {"cache": {}, "frequent": None}

    def _numbers(self, word: str) -> tuple[int, ...]:
        known = self.cache.get(word)
        if known is None:
            known = tuple([self.number[t] for t in word_terms(word) if t in self.number])
            if len(self.cache) < _CACHED and len(word) <= 40:
                self.cache[word] = known
        return known

    def counts(self, text: str | None) -> dict[int, int]:
        """How often each term of the examples occurs."""
        found: dict[int, int] = {}
        known = self.cache.get
        for word, n in Counter(_WORDS.findall((text or "").lower())).items():
            numbers = known(word)
            for t in self._numbers(word) if numbers is None else numbers:
                found[t] = found.get(t, 0) + n
        return found

    def arrays(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Terms in ascending order and weights of a text's unit vector; empty without a known term."""
        found = self.counts(text)
        terms = np.fromiter(found, np.int64, len(found))
        order = np.argsort(terms)
        raw = (1 + np.log(np.fromiter(found.values(), np.float64, len(found))))[order]
        terms = terms[order]
        raw *= np.asarray(self.idf, dtype=np.float64)[terms]
        return terms, raw / math.sqrt(float(raw @ raw)) if len(raw) else raw

    def vector(self, text: str | None) -> dict[int, float]:
        terms, weights = self.arrays(text)
        return dict(zip(terms.tolist(), weights.tolist(), strict=True))

    def build(self, vectors: list[dict[int, float]], labels: list[int], names: list[int]) -> None:
        sizes = np.array([len(v) for v in vectors], dtype=np.int64)
        terms = np.array([t for v in vectors for t in v], dtype=np.int32)
        self.build_sparse(sizes, terms, np.array([w for v in vectors for w in v.values()], dtype=np.float32), labels, names)

    def build_sparse(self, sizes: np.ndarray, terms: np.ndarray, weights: np.ndarray, labels: Sequence[int], names: Sequence[int]) -> None:
        """Index of examples given as sparse rows, in their order."""
        self.labels, self.names = np.array(labels, dtype=np.float64), np.array(names, dtype=np.int64)
        examples = np.repeat(np.arange(len(sizes)), sizes)
        order = np.argsort(terms, kind="stable")
        terms, examples, weights = terms[order], examples[order], weights[order].astype(np.float64)
        blocks = examples // BLOCK
        starts = np.flatnonzero(np.r_[True, (terms[1:] != terms[:-1]) | (blocks[1:] != blocks[:-1])]) if len(terms) else np.zeros(0, np.int64)
        most = np.maximum.reduceat(weights, starts) if len(starts) else weights
        self.postings = (examples, weights)
        self.entries = (blocks[starts], most, np.r_[starts, len(terms)])
        self.first = np.searchsorted(terms[starts], np.arange(len(self.number) + 1))
        self.frequent = None

    def nearest(self, vector: dict[int, float], without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        return self.nearest_to(np.fromiter(vector, np.int64, len(vector)), np.fromiter(vector.values(), np.float64, len(vector)), without)

    def _frequent(self) -> tuple[np.ndarray, np.ndarray]:
        if self.frequent is None:
            runs = self.entries[2][self.first]
            terms = np.flatnonzero(np.diff(runs) * FREQUENT > len(self.labels))
            row, matrix = np.full(len(runs), -1), np.zeros((len(terms), len(self.labels)))
            row[terms] = np.arange(len(terms))
            posting, of = _spread(runs[terms], runs[terms + 1])
            matrix[of, self.postings[0][posting]] = self.postings[1][posting]
            self.frequent = row, matrix
        return self.frequent

    def begun(self, vectors: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Of each vector (terms, weights) the products of its frequent terms with all examples."""
        row, matrix = self._frequent()
        queries = np.zeros((len(vectors), len(matrix)))
        for query, (terms, weights) in zip(queries, vectors, strict=True):
            at = row[terms]
            query[at[at >= 0]] = weights[at >= 0]
        return queries @ matrix

    def nearest_to(self, terms: np.ndarray, weights: np.ndarray, without: int = -1, begun: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Positions and similarities of the k most similar examples (ties: the earlier one), most similar first.

        ``begun`` is the vector's row of ``begun``, which is added to.
        """
        if not len(self.labels):
            return np.zeros(0, np.int64), np.zeros(0)
        similar = self.begun([(terms, weights)])[0] if begun is None else begun
        other = self._frequent()[0][terms] < 0
        terms, weights = terms[other], weights[other]
        least = self._least(similar, without)
        starts = np.arange(0, len(similar), BLOCK)
        entry, at = _spread(self.first[terms], self.first[terms + 1])
        blocks = self.entries[0][entry]
        bounds = np.bincount(blocks, self.entries[1][entry] * weights[at], minlength=len(starts)) + np.maximum.reduceat(similar, starts)
        visit = (bounds > 0) & (bounds >= least - 1e-12)
        if 4 * visit.sum() > len(starts):
            runs = self.entries[2]
            posting, of = _spread(runs[self.first[terms]], runs[self.first[terms + 1]])
        else:
            hit = visit[blocks]
            posting, of = _spread(self.entries[2][entry[hit]], self.entries[2][entry[hit] + 1])
            weights = weights[at[hit]]
        if len(posting):
            similar += np.bincount(self.postings[0][posting], self.postings[1][posting] * weights[of], minlength=len(similar))
        least = self._least(similar, without)
        found = np.flatnonzero(similar >= max(least - 1e-12, 1e-300))
        order = np.lexsort((found, -np.round(similar[found], 12)))[: self.k]
        return found[order], similar[found[order]]

    def _least(self, similar: np.ndarray, without: int) -> float:
        """The k-th largest similarity so far."""
        if without >= 0:
            similar[without] = 0
        return np.partition(similar, -self.k)[-self.k] if len(similar) > self.k else 0.0

    def vote(self, terms: np.ndarray, weights: np.ndarray, without: int = -1, begun: np.ndarray | None = None) -> tuple[float, np.ndarray]:
        """Share of toxic neighbours, weighted by similarity and class, and the neighbours."""
        found, values = self.nearest_to(terms, weights, without, begun)
        if not len(found):
            return self.empty_share, found
        toxic = self.labels[found] > 0
        weights = values**2 / (1.0001 - np.minimum(values, 1.0)) ** 0.5 * np.where(toxic, 1.0, self.weight)
        return float((weights[toxic].sum() + self.empty_share * 0.01) / (weights.sum() + 0.01)), found

    def fit_curve(self, votes: np.ndarray, truth: np.ndarray, weights: np.ndarray) -> None:
        """Logistic calibration by Newton steps, slightly ridged, and bounded as votes may part the labels entirely."""
        x = np.stack([_logit(votes), np.ones(len(votes))], axis=1)
        beta = np.array([1.0, 0.0])
        for _ in range(50):
            p = _logistic(x @ beta)
            slope = x.T @ (weights * (truth - p)) - 1e-2 * (beta - [1.0, 0.0])
            curvature = (x * (weights * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2)
            step = np.linalg.solve(curvature, slope)
            beta = np.clip(beta + step / max(1.0, float(np.abs(step).max())), [0.05, -STEEPEST], [STEEPEST, STEEPEST])
        self.curve = (float(beta[0]), float(beta[1]))

    def score(self, terms: np.ndarray, weights: np.ndarray, begun: np.ndarray | None = None) -> tuple[float, np.ndarray]:
        share, found = self.vote(terms, weights, begun=begun)
        if not len(found):
            return self.empty_share, found
        return float(_logistic(self.curve[0] * _logit(share) + self.curve[1])), found


def _spread(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All positions of the ranges [start, end), and the range of each."""
    sizes = ends - starts
    of = np.repeat(np.arange(len(sizes)), sizes)
    return np.arange(len(of)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + starts[of], of


def _logistic(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _logit(p):
    p = np.clip(p, 1e-3, 1 - 1e-3)
    return np.log(p / (1 - p))


def words_of(text: str | None) -> set[str]:
    return set(_WORDS.findall((text or "").lower()))


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number of examples of each label that have each term."""
    seen: tuple[Counter, Counter] = (Counter(), Counter())
    for batch in batches:
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
            seen[toxic].update({t for w in words_of(text) for t in word_terms(w)})
    for toxic in (0, 1):
        yield pa.record_batch(
            [pa.array(list(seen[toxic]), pa.string()), pa.array([toxic] * len(seen[toxic]), pa.int32()), pa.array(list(seen[toxic].values()), pa.int64())],
            names=["term", "toxic", "n"],
        )


def likelihood_ratio(a: np.ndarray, n_a: int, b: np.ndarray, n_b: int) -> np.ndarray:
    """Likelihood ratio of terms in a of n_a toxic and b of n_b other examples: twice the sample size times the mutual information."""
    total = np.zeros(len(a))
    for seen, n in ((a, n_a), (b, n_b)):
        for k, part in ((seen, a + b), (n - seen, n_a + n_b - a - b)):
            some = k > 0
            total[some] += 2 * k[some] * np.log(k[some] * (n_a + n_b) / (float(n) * part[some]))
    return np.maximum(total, 0.0)


def term_weights(a: np.ndarray, n_a: int, b: np.ndarray, n_b: int) -> np.ndarray:
    """Inverse document frequency of terms times their relevance to the label, never 0."""
    n, share = n_a + n_b, n_a / (n_a + n_b)
    entropy = -share * math.log(share) - (1 - share) * math.log(1 - share)
    return (np.log((1 + n) / (1 + a + b)) + 1) * (FLOOR + likelihood_ratio(a, n_a, b, n_b) / (2 * n * entropy))


def fit(docs: DataFrame, labels: DataFrame, examples: int = EXAMPLES, k: int = NEIGHBOURS, seed: int = 0) -> Index:
    """The classifier, from at most ``examples`` labelled rows of ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic)."""
    truth = labels.filter("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
    truth = keep(truth.withColumn("toxic", (F.col("toxic") > 0).cast("int")), "labels")
    totals = {r["toxic"]: r["count"] for r in truth.groupBy("toxic").count().collect()}
    order = [F.xxhash64("doc_id", F.lit(seed)), F.col("doc_id")]
    chosen = [truth.filter(F.col("toxic") == t).orderBy(*order).limit(examples // 2) for t in (0, 1)]
    chosen = keep(chosen[0].unionByName(chosen[1]), "chosen")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sample = keep(texts.join(F.broadcast(chosen), "doc_id").repartition("doc_id"), "examples")  # ``examples`` rows at most
    n = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    n_toxic, n_other = n.get(1, 0), n.get(0, 0)

    index = Index([], {}, k)
    share = totals.get(1, 0) / max(1, sum(totals.values()))
    if not n_toxic or not n_other:
        index.empty_share = share if not n_toxic else 1.0 - 1 / (2 + n_toxic)
        return index
    counts = sample.mapInArrow(_term_counts, "term string, toxic int, n bigint").groupBy("term")
    counts = counts.agg(*[F.coalesce(F.sum(F.when(F.col("toxic") == t, F.col("n"))), F.lit(0)).alias(name) for t, name in ((1, "a"), (0, "b"))])
    seen = counts.toArrow().sort_by("term")  # as many terms as the sample has
    a, b = (seen.column(c).to_numpy().astype(np.float64) for c in "ab")
    telling = (a * n_other > b * n_toxic) & (likelihood_ratio(a, n_toxic, b, n_other) >= TELLING)
    used = telling | np.array([not t.endswith("*") for t in seen.column("term").to_pylist()], dtype=bool)
    seen, a, b, telling = seen.filter(pa.array(used)), a[used], b[used], telling[used]
    index.idf = term_weights(a, n_toxic, b, n_other)
    index.number = {t: i for i, t in enumerate(seen.column("term").to_pylist())}

    sent = docs.sparkSession.sparkContext.broadcast(Packed(index))
    rows = sample.mapInArrow(_vectors(sent), "doc_id bigint, toxic int, terms array<int>, weights array<float>").toArrow().combine_chunks()
    sent.unpersist()
    # examples with the same strongest terms share blocks, which keeps the bounds close
    vectors = [(t.values.to_numpy(), w.values.to_numpy()) for t, w in zip(rows.column("terms").chunk(0), rows.column("weights").chunk(0), strict=True)]
    names, toxic = rows.column("doc_id").to_pylist(), rows.column("toxic").to_pylist()
    strongest = [t[np.lexsort((t, -w))[:3]].tolist() for t, w in vectors]
    order = sorted(range(len(names)), key=lambda i: (strongest[i], names[i]))
    terms, weights = (np.concatenate([vectors[i][c] for i in order]) for c in (0, 1))
    index.build_sparse(np.array([len(vectors[i][0]) for i in order]), terms, weights, [toxic[i] for i in order], [names[i] for i in order])
    # an example of the rarer label stands for fewer rows
    index.weight = (totals[0] / n_other) / (totals[1] / n_toxic)
    empty = Counter(label for (t, _), label in zip(vectors, toxic, strict=True) if not telling[t].any())
    index.empty_share = (empty[1] + 0.5) / ((empty[1] + 0.5) + (empty[0] + 0.5) * index.weight)
    probes = range(0, len(order), -(-len(order) // CALIBRATED))
    votes = np.array([index.vote(vectors[order[i]][0].astype(np.int64), vectors[order[i]][1].astype(np.float64), i)[0] for i in probes])
    truth = index.labels[list(probes)]
    index.fit_curve(votes, truth, np.where(truth > 0, 1.0, index.weight))
    return index


def _vectors(sent) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = sent.value
        for batch in batches:
            made = [index.arrays(t) for t in batch.column("text").to_pylist()]
            ends = np.cumsum([0, *(len(t) for t, _ in made)]).astype(np.int32)
            lists = [pa.ListArray.from_arrays(ends, np.concatenate([m[c] for m in made]).astype(kind)) if made else pa.array([], pa.list_(pa.from_numpy_dtype(kind))) for c, kind in ((0, np.int32), (1, np.float32))]
            yield pa.record_batch([batch.column("doc_id"), batch.column("toxic"), *lists], names=["doc_id", "toxic", "terms", "weights"])

    return run


def score_texts(docs: DataFrame, index: Index, columns: list[str] | None = None) -> DataFrame:
    """Per row of ``docs``: row (a struct of ``columns``, doc_id if not given), score, evidence.

    The evidence holds the doc_ids of the nearest examples, nearest first.
    """
    # bounded by ``examples``; unpacked once, as a worker's heap would not shrink again if each task unpacked it
    sent = docs.sparkSession.sparkContext.broadcast(Packed(index))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = sent.value
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                scores, evidence = [], []
                vectors = [index.arrays(text) for text in part.column(1).to_pylist()]
                for vector, begun in zip(vectors, index.begun(vectors), strict=True):
                    value, found = index.score(*vector, begun)
                    scores.append(value)
                    evidence.append(index.names[found])
                yield pa.record_batch([part.column(0), pa.array(scores, pa.float64()), pa.array(evidence, pa.list_(pa.int64()))], names=["row", "score", "evidence"])

    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns or ["doc_id"]]).alias("row"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, score double, evidence array<bigint>")


def held_out(doc_id) -> Column:
    """Rows that labels are never learned from: crc32 of the decimal doc_id divisible by 5."""
    return F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 5 == 0
