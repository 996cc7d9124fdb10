"""Toxicity by classifier chains of linear models.

The categories form a chain. Each category has a logistic regression over the
presence of words and word beginnings, plus the probabilities of all earlier
categories. While the chain is trained those probabilities are out of fold: every
labelled row gets them from models that did not see it, so later models learn how
far earlier ones can be trusted. In use, each model's probability feeds the next.

``labels`` of this corpus hold two judged categories, ``quality`` (its absence is
the first link, ``low_quality``) and ``toxic``; the interface takes any chain.

Training uses a bounded sample of labelled rows (``TrainSpec.max_rows``, half of
them positive for the last category if there are as many, taken by hash of the id);
only their hashed features reach the driver. Sampled rows weigh as many labelled rows
of their class as they stand for, in the models and in the choice of the thresholds,
so probabilities and verdicts refer to the class shares of all labels at any size.
Scoring covers every row.

Defined results: null and empty texts have no features and get the base rate; a very
long text is read whole, in pieces; ties of a threshold's F1 take the middle one;
rows with a null label or id do not train; a category without both classes in the
sample predicts its constant share; repeated rows are each scored; an empty table
gives an empty table; other input columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.columns import free_name, text_bytes
from ledgerline.llm.words import ALNUM, mix, pieces, word_hashes, word_spans

#: Hashed feature space: words in the lower half, beginnings of words in the upper.
BITS = 20
#: A longer word also counts as its beginnings of so many code points (a stem with some ending).
BEGINNINGS = range(4, 11)
#: Bytes of the texts whose features are made together; a longer text is cut between words.
GROUP_BYTES = 1 << 18


@dataclass(frozen=True)
class TrainSpec:
    """Bounds and settings of the training."""

    #: Most labelled rows that are fetched and fitted on.
    max_rows: int = 6000
    folds: int = 5
    #: Features kept for each model, by chi-square with its category.
    features: int = 400
    #: Rows a feature must occur in.
    least_rows: int = 4
    l2: float = 0.3
    steps: int = 25


def _groups(texts: list[bytes]) -> Iterator[tuple[bytes, np.ndarray, np.ndarray]]:
    """(bytes, where texts start in them, their numbers): lower-cased texts, or pieces of a long one, joined by line ends."""
    parts, numbers, held = [], [], 0
    for i, text in enumerate(texts):
        lowered = text.decode("utf-8", "replace").lower().encode()
        raw = np.frombuffer(lowered, np.uint8)
        for lo, hi in pieces(raw, ALNUM):
            if held + hi - lo > GROUP_BYTES and parts:
                yield _joined(parts, numbers)
                parts, numbers, held = [], [], 0
            parts.append(lowered[lo:hi])
            numbers.append(i)
            held += hi - lo + 1
    if parts:
        yield _joined(parts, numbers)


def _joined(parts: list[bytes], numbers: list[int]) -> tuple[bytes, np.ndarray, np.ndarray]:
    sizes = np.array([len(p) + 1 for p in parts])
    return b"\n".join(parts), np.cumsum(sizes) - sizes, np.array(numbers)


def features_in(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text number, hashed feature) of all words and beginnings, with repeats, a group of texts at a time."""
    half = np.uint64(1 << (BITS - 1))
    down = np.uint64(64 - BITS + 1)
    for data, firsts, numbers in _groups(texts):
        starts, ends = word_spans(data, ALNUM)
        of = numbers[np.searchsorted(firsts, starts, "right") - 1]
        yield of, (word_hashes(data, ALNUM) >> down).astype(np.int32)
        raw = np.frombuffer(data, np.uint8)
        chars = np.flatnonzero((raw & 0xC0) != 0x80)  # where code points start
        first, last = np.searchsorted(chars, starts), np.searchsorted(chars, ends)
        chars = np.append(chars, len(raw))
        for size in BEGINNINGS:
            longer = np.flatnonzero(last - first > size)
            to = chars[first[longer] + size]
            yield of[longer], ((span_hashes(raw, starts[longer], to) >> down) + half).astype(np.int32)


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span; spans have few bytes."""
    key, size = np.zeros(len(starts), np.uint64), ends - starts
    for i in range(int(size.max(initial=0))):
        inside = size > i
        byte = raw[np.where(inside, starts + i, 0)]
        key = np.where(inside, key * np.uint64(0x100000001B3) ^ byte, key)
    return mix(key + size.astype(np.uint64))


def features_of(text: bytes) -> np.ndarray:
    """Distinct hashed features of a text, sorted."""
    found = [np.unique(features) for _, features in features_in([text])]
    return np.unique(np.concatenate(found)).astype(np.int32) if found else np.zeros(0, np.int32)


@dataclass
class Link:
    """One fitted model of the chain: chosen features, their weights, those of earlier links, the constant."""

    chosen: np.ndarray
    weights: np.ndarray
    earlier: np.ndarray
    constant: float

    def logits(self, present: np.ndarray, before: np.ndarray) -> np.ndarray:
        return present @ self.weights + before @ self.earlier + self.constant


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35.0, 35.0)))


class Rows:
    """Labelled rows as lists of feature ids; features in fewer than ``least_rows`` rows and those in the same rows as another one go."""

    def __init__(self, features: list[np.ndarray], least_rows: int = 1):
        self.n = len(features)
        feature = np.concatenate(features) if features else np.zeros(0, np.int32)
        row = np.repeat(np.arange(self.n, dtype=np.int32), [len(f) for f in features])
        kept = np.bincount(feature, minlength=1 << BITS)[feature] >= least_rows
        feature, row = feature[kept], row[kept]
        order = np.argsort(feature, kind="stable")
        self.feature, self.row = feature[order], row[order]
        self.ids, at = np.unique(self.feature, return_index=True)
        # Beginnings of one word are often in the same rows: the first of those features stands for them.
        if len(at):
            rows_hash = np.add.reduceat(mix(self.row.astype(np.uint64) + np.uint64(1)), at)
            _, first = np.unique(rows_hash, return_index=True)
            own = np.zeros(len(self.ids), bool)
            own[first] = True
            kept = np.repeat(own, np.diff(np.append(at, len(self.feature))))
            self.feature, self.row, self.ids = self.feature[kept], self.row[kept], self.ids[own]
        self.place = np.searchsorted(self.ids, self.feature)

    def counts(self, weight: np.ndarray) -> np.ndarray:
        """The weight of the rows that hold each feature."""
        return np.bincount(self.place, weights=weight[self.row], minlength=len(self.ids))

    def dense(self, chosen: np.ndarray) -> np.ndarray:
        out = np.zeros((self.n, len(chosen)))
        for i, (a, b) in enumerate(zip(np.searchsorted(self.feature, chosen, "left"),
                                       np.searchsorted(self.feature, chosen, "right"), strict=True)):
            out[self.row[a:b], i] = 1.0
        return out


def choose_features(rows: Rows, y: np.ndarray, train: np.ndarray, spec: TrainSpec, weight: np.ndarray | None = None) -> np.ndarray:
    """Features most dependent on the category among the weighted training rows (chi-square)."""
    weight = np.where(train, np.ones(rows.n) if weight is None else weight, 0.0)
    inside, total, held = rows.counts(weight * (y == 1)), rows.counts(weight), rows.counts(train.astype(float))
    n, positive = float(weight.sum()), float(weight[y == 1].sum())
    expected = total * positive / n
    rest = n - total
    with np.errstate(divide="ignore", invalid="ignore"):
        score = (inside - expected) ** 2 * n / np.maximum(expected, 1e-9) / np.maximum((n - positive) * rest / n, 1e-9) * rest
    score[(held < spec.least_rows) | (held >= train.sum())] = -1.0
    best = np.argsort(-score, kind="stable")[:spec.features]
    return np.sort(rows.ids[best[score[best] > 0]])


def fit_link(rows: Rows, y: np.ndarray, before: np.ndarray, train: np.ndarray, spec: TrainSpec,
             weight: np.ndarray | None = None) -> Link:
    """Logistic regression of weighted rows by Newton steps with an L2 penalty."""
    weight = np.ones(rows.n) if weight is None else weight
    share = float(np.clip(np.average(y[train], weights=weight[train]) if train.any() else 0.0, 1e-4, 1 - 1e-4))
    constant = float(np.log(share / (1 - share)))
    if not train.any() or len(np.unique(y[train])) < 2:
        return Link(np.zeros(0, np.int64), np.zeros(0), np.zeros(before.shape[1]), constant)
    chosen = choose_features(rows, y, train, spec, weight)
    x = np.hstack((rows.dense(chosen), before, np.ones((rows.n, 1))))[train]
    target, weight = y[train].astype(float), weight[train]
    w = np.zeros(x.shape[1])
    w[-1] = constant
    penalty = np.full(len(w), spec.l2)
    penalty[-1] = 0.0
    for _ in range(spec.steps):
        p = sigmoid(x @ w)
        gradient = x.T @ (weight * (p - target)) + penalty * w
        hessian = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x
        hessian[np.diag_indices_from(hessian)] += penalty + 1e-9
        move = np.linalg.solve(hessian, gradient)
        w -= move
        if np.abs(move).max() < 1e-3:
            break
    k = len(chosen)
    return Link(chosen, w[:k], w[k:-1], float(w[-1]))


def fit_chain(features: list[np.ndarray], labels: np.ndarray, spec: TrainSpec, weight: np.ndarray | None = None) -> tuple[list[Link], np.ndarray]:
    """The links in chain order, and the out-of-fold probabilities (row by category)."""
    rows, n, categories = Rows(features, spec.least_rows), len(features), labels.shape[1]
    fold = np.arange(n) % spec.folds
    out_of_fold = np.zeros((n, categories))
    links = []
    for c in range(categories):
        before, y = out_of_fold[:, :c], labels[:, c]
        for f in range(spec.folds):
            held = fold == f
            if held.any():
                link = fit_link(rows, y, before, ~held, spec, weight)
                out_of_fold[held, c] = sigmoid(link.logits(rows.dense(link.chosen), before))[held]
        links.append(fit_link(rows, y, before, np.ones(n, bool), spec, weight))
    return links, out_of_fold


def best_threshold(y: np.ndarray, p: np.ndarray, least: float = 0.3, most: float = 0.7,
                   weight: np.ndarray | None = None) -> float:
    """The threshold between the bounds with the best weighted F1 on out-of-fold probabilities (0.5 without both classes)."""
    if not len(y) or len(np.unique(y)) < 2:
        return 0.5
    tried = np.linspace(least, most, 41).round(2)
    called = p[:, None] >= tried
    weight = np.ones(len(y)) if weight is None else weight
    hits = weight @ (called & (y == 1)[:, None])
    f1 = 2 * hits / (weight @ called + weight @ (y == 1))
    return float(tried[np.flatnonzero(f1 == f1.max())].mean().round(2))


class Chain:
    """The fitted chain as lookup tables for scoring; ``thresholds`` are those of the categories' verdicts."""

    def __init__(self, categories: list[str], links: list[Link], thresholds: list[float] | None = None):
        self.categories, self.links = categories, links
        self.thresholds = dict(zip(categories, thresholds or [0.5] * len(links), strict=True))
        self.chosen = np.unique(np.concatenate([link.chosen for link in links])) if links else np.zeros(0, np.int64)
        self.weights = np.zeros((len(self.chosen), len(links)))
        for c, link in enumerate(links):
            self.weights[np.searchsorted(self.chosen, link.chosen), c] = link.weights

    def probabilities(self, texts: list[bytes]) -> np.ndarray:
        """Text by category, to six decimals."""
        out = np.zeros((len(texts), len(self.links)))
        present = [np.zeros(0, np.int64)]
        place = np.full(1 << BITS, -1, np.int32)
        place[self.chosen] = np.arange(len(self.chosen))
        for of, features in features_in(texts):
            at = place[features]
            hit = at >= 0
            present.append(np.unique(of[hit].astype(np.int64) * len(self.chosen) + at[hit]))
        if len(self.chosen):
            text, at = np.divmod(np.unique(np.concatenate(present)), len(self.chosen))
            for c in range(len(self.links)):
                out[:, c] = np.bincount(text, weights=self.weights[at, c], minlength=len(texts))
        for c, link in enumerate(self.links):
            out[:, c] = sigmoid(out[:, c] + out[:, :c] @ link.earlier + link.constant)
        return out.round(6)


def judged_labels(labels: DataFrame, id_col: str, categories: dict[str, Column]) -> DataFrame:
    """One row for each id with all categories labelled."""
    named = labels.select(F.col(f"`{id_col}`").alias("label_id"), *(c.cast("int").alias(f"y{i}") for i, c in enumerate(categories.values())))
    return named.dropna().groupBy("label_id").agg(*(F.max(f"y{i}").alias(f"y{i}") for i in range(len(categories))))


def sample_labels(labels: DataFrame, id_col: str, categories: dict[str, Column], spec: TrainSpec) -> DataFrame:
    """At most ``max_rows`` labelled ids by hash, half of them positive for the last category if there are as many."""
    last = f"y{len(categories) - 1}"
    judged = judged_labels(labels, id_col, categories)
    order = [F.xxhash64("label_id"), "label_id"]
    positive = judged.where(F.col(last) == 1).orderBy(*order).limit(spec.max_rows // 2)
    negative = judged.where(F.col(last) != 1).orderBy(*order).limit(spec.max_rows // 2)
    return positive.unionByName(negative)


def stands_for(labels: DataFrame, id_col: str, categories: dict[str, Column], spec: TrainSpec) -> dict[bool, float]:
    """How many labelled ids a sampled one stands for, by whether it is positive for the last category."""
    positive = (F.col(f"y{len(categories) - 1}") == 1).alias("positive")
    counts = judged_labels(labels, id_col, categories).groupBy(positive).count().collect()
    return {r["positive"]: max(1.0, r["count"] / (spec.max_rows // 2)) for r in counts}


def train_chain(df: DataFrame, text_col: str, id_col: str, labels: DataFrame, categories: dict[str, Column],
                spec: TrainSpec | None = None, label_id: str = "doc_id") -> Chain:
    """Fit the chain on labelled rows of ``df``; ``categories`` maps names, in chain order, to 0/1 columns of ``labels``."""
    spec = spec or TrainSpec()

    @F.arrow_udf("array<int>")
    def hashed(column: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in column:
            yield pa.array([features_of(t) for t in text_bytes(part)], pa.list_(pa.int32()))

    sample = sample_labels(labels, label_id, categories, spec)  # at most max_rows rows of a few integers: may be broadcast
    rows = df.select(F.col(f"`{id_col}`").alias("label_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    one_each = rows.join(F.broadcast(sample), "label_id").groupBy("label_id").agg(
        F.min("text").alias("text"), *(F.first(f"y{i}").alias(f"y{i}") for i in range(len(categories))))
    fetched = one_each.select("label_id", hashed("text").alias("features"), *(f"y{i}" for i in range(len(categories)))).toArrow()
    ids = fetched["label_id"].to_pylist()
    order = sorted(range(len(ids)), key=lambda i: (hash_order(ids[i]), str(ids[i])))
    features = [fetched["features"][i].values.to_numpy() for i in order]
    y = np.array([[fetched[f"y{c}"][i].as_py() for c in range(len(categories))] for i in order]).reshape(len(order), len(categories))
    times = stands_for(labels, label_id, categories, spec)
    weight = np.array([times[bool(last == 1)] for last in y[:, -1]])
    weight = weight / weight.mean() if len(weight) else weight
    links, out_of_fold = fit_chain(features, y, spec, weight)
    return Chain(list(categories), links,
                 [best_threshold(y[:, c], out_of_fold[:, c], weight=weight) for c in range(len(categories))])


def hash_order(value) -> int:
    """A fixed shuffle of ids, so that folds do not follow their order."""
    return int(word_hashes(str(value).encode("utf-8", "surrogatepass"))[:1].sum())


def score_toxicity(df: DataFrame, text_col: str, chain: Chain, result: str = "toxicity") -> DataFrame:
    """``df`` with a struct of one probability for each category."""
    shared = df.sparkSession.sparkContext.broadcast(chain)  # some thousand weights, bounded by TrainSpec.features
    names = chain.categories

    @F.arrow_udf("struct<" + ",".join(f"`{n}`:double" for n in names) + ">")
    def score(column: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in column:
            p = shared.value.probabilities(text_bytes(part))
            yield pa.StructArray.from_arrays([pa.array(p[:, i]) for i in range(len(names))], names=names)

    return df.withColumn(free_name(df, result), score(f"`{text_col}`"))


def label_chain() -> dict[str, Column]:
    """The chain over the ``labels`` table."""
    return {"low_quality": 1 - F.col("quality"), "toxic": F.col("toxic")}


def op3_toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Category probabilities and verdict of every whole text of ``documents``."""
    docs = documents.select("doc_id", "text")
    chain = train_chain(docs, "text", "doc_id", labels, label_chain())
    scored = score_toxicity(docs, "text", chain)
    return scored.select("doc_id", F.col("toxicity.low_quality").alias("p_low_quality"), F.col("toxicity.toxic").alias("p_toxic"),
                         (F.col("toxicity.toxic") >= chain.thresholds["toxic"]).alias("toxic"))
