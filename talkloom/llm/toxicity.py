"""Toxicity by nearest labelled examples under exact TF-IDF cosine.

Terms are all words of the labelled examples; document frequencies are counted over all texts.
A term's inverse document frequency is raised by how surely the labels tie it to toxic texts, so
that a few telling words can outweigh many that say nothing; no term is left out.  Examples lie in
blocks of similar ones.  A query adds up the postings of the terms that can matter most; the
greatest weights that the other terms have in each block bound what is still open there, and only
examples that can reach the nearest are compared in full: the result is that of comparing all.
Votes weigh by squared cosine, and an isotonic fit on the examples themselves turns them into
chances: each group of copies is judged without itself, and once more, if it has several members,
with the others, as a text is that has been seen before.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkloom.llm.common import map_texts, scan_texts, written
from talkloom.llm.quality_classifier import isotonic

_WORD = re.compile(r"[^\W\d_]+")
_COPY = 0.999
#: Postings that a query adds up before it looks at bounds, for each example.
HEAD = 12


@dataclass(frozen=True)
class ToxicConfig:
    """``examples``, ``example_bytes``: at most so many labelled texts of so many bytes in all are
    used, whole, in the order of a hash of their ids; a text of over ``text_bytes`` is no example, so
    that none takes the place of many.  They bound what is sent to tasks."""

    examples: int = 3_000
    example_bytes: int = 24 << 20
    text_bytes: int = 3 << 19
    tie_weight: float = 5.0
    neighbours: int = 15
    prior_weight: float = 0.2
    block: int = 64
    threshold: float = 0.7


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def bounded_examples(docs: DataFrame, labels: DataFrame, learn: Callable[[Column], Column], config: ToxicConfig) -> DataFrame:
    """``(key, label, text)`` of the chosen rows: labelled texts in the order of a hash of their ids, at
    most ``examples`` of them; one that is too long, or does not fit into what is left of the bytes, is
    passed over and the next is looked at.

    Only labels of texts that are there count.  Keys and lengths are ordered; texts are fetched for
    the rows that were chosen.  A row that is there twice is one example.
    """
    wanted = labels.filter(F.col("label").isNotNull() & learn(F.col("key"))).distinct()
    sizes = docs.filter(F.col("text").isNotNull()).select("key", F.xxhash64("text").alias("rank"), F.octet_length("text").cast("bigint").alias("bytes"))
    some = sizes.filter(F.col("bytes") <= config.text_bytes).join(wanted, "key").distinct()
    listed = some.orderBy(F.xxhash64("key"), "key", "label", "rank").limit(config.examples).collect()  # config.examples short rows
    chosen, left = [], config.example_bytes
    for row in listed:
        if row["bytes"] <= left:
            chosen.append((row["key"], row["rank"], row["label"]))
            left -= row["bytes"]
    kinds = T.StructType([some.schema["key"], some.schema["rank"], some.schema["label"]])
    found = docs.withColumn("rank", F.xxhash64("text")).join(F.broadcast(docs.sparkSession.createDataFrame(chosen, kinds)), ["key", "rank"])
    return written(found.select("key", "label", "text").dropDuplicates(["key", "label", "text"]), "examples")


class Terms:
    """The words of the examples, their weights, and unit vectors of texts over them."""

    def __init__(self, words: list[str], weight: np.ndarray):
        self.words, self.weight = words, weight
        self.index = {w: i for i, w in enumerate(words)}

    def __reduce__(self):
        return Terms, (self.words, self.weight)

    def vector(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """(coordinates, values), ascending; empty for a text without a known word."""
        get = self.index.get
        ids = np.array([get(w, -1) for w in words_of(text)], np.int32)
        at, counts = np.unique(ids[ids >= 0], return_counts=True)
        values = (1 + np.log(counts)) * self.weight[at]
        norm = np.linalg.norm(values)
        return (at, values / norm) if norm else (at[:0], values[:0])


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of several ranges, one after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


class BlockMaxIndex:
    """Examples in blocks of similar ones: postings and block maxima of each term, and the
    examples' own vectors."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], labels: list[int], ids: list, coordinates: int, size: int):
        # neighbours in order share their weightiest coordinate, which keeps block maxima tight
        order = sorted(range(len(vectors)), key=lambda i: (int(vectors[i][0][np.argmax(vectors[i][1])]), -float(vectors[i][1].max()), str(ids[i])))
        self.labels, self.ids = np.array([labels[i] for i in order], float), [str(ids[i]) for i in order]
        self.coordinates, self.size, self.blocks = coordinates, size, -(-len(order) // size)
        lengths = np.array([len(vectors[i][0]) for i in order])
        self.own_starts, self.own_sizes = np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths
        self.own_terms = np.concatenate([vectors[i][0] for i in order]).astype(np.int32)
        self.own_values = np.concatenate([vectors[i][1] for i in order])
        rows = np.repeat(np.arange(len(order), dtype=np.int32), lengths)
        by_term = np.argsort(self.own_terms, kind="stable")
        self.places, self.values = rows[by_term], self.own_values[by_term]
        self.sizes = np.bincount(self.own_terms, minlength=coordinates)
        self.starts = np.cumsum(self.sizes) - self.sizes
        cells = self.own_terms[by_term].astype(np.int64) * self.blocks + self.places // size
        first = np.flatnonzero(np.concatenate([[True], cells[1:] != cells[:-1]]))
        self.most_values = np.maximum.reduceat(self.values, first)
        self.most_blocks = (cells[first] % self.blocks).astype(np.int32)
        self.most_sizes = np.bincount(cells[first] // self.blocks, minlength=coordinates)
        self.most_starts = np.cumsum(self.most_sizes) - self.most_sizes
        self.most = np.zeros(coordinates)
        used = np.flatnonzero(self.sizes)
        self.most[used] = np.maximum.reduceat(self.most_values, self.most_starts[used])

    def _added(self, at: np.ndarray, values: np.ndarray) -> np.ndarray:
        """What these terms give to the cosine of every example."""
        sizes = self.sizes[at]
        some = _ranges(self.starts[at], sizes)
        return np.bincount(self.places[some], self.values[some] * np.repeat(values, sizes), len(self.labels))

    def cosines(self, at: np.ndarray, values: np.ndarray) -> np.ndarray:
        """With all examples."""
        return self._added(at, values)

    def nearest(self, at: np.ndarray, values: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and cosines of the k nearest examples, nearest first, ties by place."""
        order = np.argsort(-(values * self.most[at]), kind="stable")
        cut = 1 + int(np.searchsorted(np.cumsum(self.sizes[at[order]]), HEAD * len(self.labels)))
        head, tail = order[:cut], order[cut:]
        found = self._added(at[head], values[head])
        places = np.arange(len(found))
        if len(tail):
            least = np.partition(found, -k)[-k] if k < len(found) else 0.0
            rest, sizes = at[tail], self.most_sizes[at[tail]]
            some = _ranges(self.most_starts[rest], sizes)
            room = np.bincount(self.most_blocks[some], self.most_values[some] * np.repeat(values[tail], sizes), self.blocks)
            places = np.flatnonzero(found + room[places // self.size] >= least - 1e-9)
            if self.own_sizes[places].sum() < 2 * self.sizes[rest].sum():
                query = np.zeros(self.coordinates)
                query[at] = values
                own = _ranges(self.own_starts[places], self.own_sizes[places])
                parts = query[self.own_terms[own]] * self.own_values[own]
                found = np.add.reduceat(parts, np.cumsum(self.own_sizes[places]) - self.own_sizes[places])
            else:
                found = (found + self._added(rest, values[tail]))[places]
        return self._best(places, found, k)

    def _best(self, places: np.ndarray, found: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        if len(found) > 4 * k:
            some = np.flatnonzero(found >= np.partition(found, -k)[-k])
            places, found = places[some], found[some]
        top = np.lexsort((places, -found))[:k]
        top = top[found[top] > 0]
        return places[top], found[top]


@dataclass(frozen=True)
class ToxicModel:
    terms: Terms
    index: BlockMaxIndex | None
    base: float
    config: ToxicConfig
    knots: tuple[np.ndarray, np.ndarray] = field(default=(np.array([0.0, 1.0]), np.array([0.0, 1.0])))

    def vote(self, places: np.ndarray, cosines: np.ndarray) -> float:
        """Votes by squared cosine, drawn to the base rate."""
        weights, c = cosines**2, self.config
        return float((weights @ self.index.labels[places] + c.prior_weight * self.base) / (weights.sum() + c.prior_weight))

    def held_back(self, text: str | None, label: int) -> tuple[float, float | None, int]:
        """Votes on an example, without itself and its copies and, if it has copies, without itself
        alone; and how many there are of it."""
        at, values = self.terms.vector(text)
        if not len(at):
            return self.base, None, 1
        found = self.index.cosines(at, values)
        same = found > _COPY
        vote = lambda cosines: self.vote(*self.index._best(np.arange(len(cosines)), cosines, self.config.neighbours))
        own = np.flatnonzero(same & (self.index.labels == label))
        alone = vote(np.where(np.arange(len(found)) == own[0], 0.0, found)) if same.sum() > 1 and len(own) else None
        return vote(np.where(same, 0.0, found)), alone, max(1, int(same.sum()))

    def score(self, text: str | None) -> tuple[float, list[str], list[float]]:
        """The calibrated chance, and the nearest examples with their cosines."""
        at, values = self.terms.vector(text)
        if not len(at) or self.index is None:
            return self.base, [], []
        places, cosines = self.index.nearest(at, values, self.config.neighbours)
        score = np.clip(np.interp(self.vote(places, cosines), *self.knots), 0.0, 1.0)
        return float(score), [self.index.ids[i] for i in places], cosines.tolist()


def count_terms(examples: DataFrame) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Words of the examples, and how many toxic and other ones have each."""

    def make():
        def work(kept, texts):
            seen = Counter((w, label) for label, text in zip(kept[0].to_pylist(), texts, strict=True) for w in set(words_of(text)))
            words = sorted({w for w, _ in seen})
            yield words, [seen[w, 1] for w in words], [seen[w, 0] for w in words]

        return work

    rows = scan_texts(examples, "text", ["label"], make, [("word", "string"), ("pos", "bigint"), ("neg", "bigint")])
    table = rows.groupBy("word").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).toArrow()  # bounded by config.example_bytes
    words = table.column("word").to_pylist()
    order = sorted(range(len(words)), key=words.__getitem__)
    return [words[i] for i in order], *(table.column(c).to_numpy()[order] for c in ("pos", "neg"))


def document_frequencies(docs: DataFrame, words: list[str]) -> tuple[np.ndarray, int]:
    """How many of all texts have each word, and how many texts there are."""
    sent = docs.sparkSession.sparkContext.broadcast(words)

    def make():
        index = {w: i for i, w in enumerate(sent.value)}
        known, total = index.keys(), np.zeros(len(index) + 1, np.int64)

        def work(_, texts):
            if texts is None:
                some = np.flatnonzero(total)
                for i in range(0, len(some), 100_000):
                    yield some[i : i + 100_000].astype(np.int32), total[some[i : i + 100_000]]
                return
            total[-1] += len(texts)
            found = [index[w] for text in texts for w in known & set(words_of(text))]
            total[:-1] += np.bincount(np.array(found, np.int64), minlength=len(index))

        return work

    counted = scan_texts(docs, "text", [], make, [("word", "int"), ("n", "bigint")], finish=True).groupBy("word").agg(F.sum("n").alias("n")).toArrow()  # a row for each word
    out = np.zeros(len(words) + 1, np.int64)
    out[counted.column("word").to_numpy()] = counted.column("n").to_numpy()
    return out[:-1], int(out[-1])


def term_weights(pos: np.ndarray, neg: np.ndarray, positive: int, negative: int, frequencies: np.ndarray, texts: int, config: ToxicConfig) -> np.ndarray:
    """Inverse document frequency, raised by the tie: the lower end of a 90 % interval of the
    term's log odds ratio between toxic and other examples, where that is above 0."""
    a, b = (pos + 0.5) / (positive + 1.0), (neg + 0.5) / (negative + 1.0)
    tie = np.log(a * (1 - b) / (b * (1 - a))) - 1.64 * np.sqrt(1 / (pos + 0.5) + 1 / (neg + 0.5))
    return np.log1p(texts / np.maximum(frequencies, 1)) * (1 + config.tie_weight * np.maximum(tie, 0.0))


def learn_examples(docs: DataFrame, labels: DataFrame, learn: Callable[[Column], Column], config: ToxicConfig) -> ToxicModel:
    """``docs`` (key, text), ``labels`` (key, label)."""
    context = docs.sparkSession.sparkContext
    examples = bounded_examples(docs, labels, learn, config)
    positive, total = (x or 0 for x in examples.agg(F.sum("label"), F.count("*")).first())
    base = (positive + 0.5) / (total + 1.0) if total else 0.0
    words, pos, neg = count_terms(examples)
    frequencies, texts = document_frequencies(docs, words)
    terms = Terms(words, term_weights(pos, neg, positive, total - positive, frequencies, texts, config))
    sent = context.broadcast(terms)

    def make():
        def work(texts):
            own = [sent.value.vector(t) for t in texts]
            return [[a for a, _ in own], [v for _, v in own]]

        return work

    rows = map_texts(examples, "text", ["key", "label"], make, [("at", "array<int>"), ("values", "array<double>")])
    some = rows.filter(F.size("at") > 0).orderBy("key").toArrow().combine_chunks()  # at most config.examples sparse rows
    if not len(some):
        return ToxicModel(terms, None, base, config)
    ends = some.column("at").chunk(0).offsets.to_numpy()
    at, values = (some.column(c).chunk(0).flatten().to_numpy() for c in ("at", "values"))
    vectors = [(at[a:b], values[a:b]) for a, b in zip(ends[:-1] - ends[0], ends[1:] - ends[0], strict=True)]
    index = BlockMaxIndex(vectors, some.column("label").to_pylist(), some.column("key").to_pylist(), len(words), config.block)
    model = ToxicModel(terms, index, base, config)
    voting = context.broadcast(model)

    def judge():
        def work(texts, labels):
            found = [voting.value.held_back(t, y) for t, y in zip(texts, labels, strict=True)]
            return [[f[k] for f in found] for k in range(3)]

        return work

    judged = map_texts(examples, "text", ["label"], judge, [("vote", "double"), ("alone", "double"), ("copies", "int")], carry=["label"]).toArrow()  # at most config.examples rows
    vote, alone, label, copies = (judged.column(c).to_numpy().astype(float) for c in ("vote", "alone", "label", "copies"))
    # a group of copies counts once as a text of its own and once as one that has been seen before
    seen = ~np.isnan(alone)
    votes, label, weight = np.concatenate([vote, alone[seen]]), np.concatenate([label, label[seen]]), 1 / np.concatenate([copies, copies[seen]])
    values, at = np.unique(votes, return_inverse=True)
    knots = isotonic(values, np.bincount(at, label * weight), np.bincount(at, weight))
    return ToxicModel(terms, index, base, config, knots)


def score_toxicity(
    docs: DataFrame, labels: DataFrame, learn: Callable[[Column], Column], config: ToxicConfig | None = None,
    id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id", label_col: str = "toxic",
) -> DataFrame:
    """``(id, score, predicted, evidence_ids, evidence_cosines)`` of every row.

    Whole texts count, however long.  A text with no word of the examples, as a null or empty one,
    scores the base rate of the examples, without evidence; with no labelled text that rate is
    0.  Null labels are no examples, a null id is none either; repeated rows are scored one by
    one, and examples of equal cosine come in the order of the index; further columns, whatever
    their names, are not read; an empty table gives an empty result.  The model is bounded by ``config`` and the only thing sent to tasks; the texts
    are read to count words and once more to score them, and are never shuffled.
    """
    config = config or ToxicConfig()
    pairs = labels.select(F.col(label_id).alias("key"), F.col(label_col).cast("int").alias("label"))
    model = learn_examples(docs.select(F.col(id_col).alias("key"), F.col(text_col).cast("string").alias("text")), pairs, learn, config)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        def work(texts):
            scored = [sent.value.score(t) for t in texts]
            return [[s for s, _, _ in scored], [int(s >= config.threshold) for s, _, _ in scored], [i for _, i, _ in scored], [c for _, _, c in scored]]

        return work

    fields = [("score", "double"), ("predicted", "int"), ("evidence_ids", "array<string>"), ("evidence_cosines", "array<double>")]
    return map_texts(docs, text_col, [id_col], make, fields)
