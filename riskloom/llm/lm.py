"""Log-bilinear language model trained by noise-contrastive estimation.

Tokens are words with A-Z in lower case, and an end token. The model predicts classes: each of the most
frequent words is a class of its own, the others are classed by their last letter. The score of a class after
two others is bilinear: their vectors, weighted by place, summed and multiplied with the class's vector, plus
its bias. Training compares true classes with noise drawn from the class frequencies; every task trains on its
own documents from common weights, and the weights are averaged by tokens, for a few rounds. The rounds read the
classes of the training tokens from a table, so that a text is split once for all of them. For scoring, the
normaliser of a pair of classes is worked out by a matrix product over all classes, so probabilities sum to
one. Within a class of rarer words a word has its discounted share of the class's tokens, and what the
discount frees is the probability of words never seen in training.

Word counts are exact and cover all training documents. The most frequent words (a fixed number) go to every
executor with their counts; the others are looked up by a join.

Defined results: a null text counts as empty and consists of the end token; a null id counts as empty text in
the fold's checksum; without training documents every token is unknown and has the scores that follow from
counts of zero; repeated rows are scored each; an empty table gives an empty result. Other columns are not
read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import byte_slices, raw, staged, text_of

HEAD = 1000
KNOWN = 1 << 17
SIZE = 16
NOISE = 32
BATCH = 1024
ROUNDS = 2
#: The end token; no word is empty.
END = b""
TAILS = 27
LOG10 = math.log(10)


def tokens(text: bytes) -> list[bytes]:
    return [*text.lower().split(), END]


def tail_of(word: bytes) -> int:
    """The class, from 0, of a word that has none of its own: by its last letter."""
    last = word[-1] - 97 if word else -1
    return last if 0 <= last < 26 else 26


@dataclass
class Weights:
    """Vectors of classes as context and as target, biases, and weights of the two places."""

    context: np.ndarray
    target: np.ndarray
    bias: np.ndarray
    place: np.ndarray

    def rows(self) -> np.ndarray:
        """All weights as rows: one for each class, the start, and the places."""
        wide = np.zeros((len(self.context) + 1, 2 * SIZE + 1))
        wide[:-1, :SIZE] = self.context
        wide[: len(self.target), SIZE:-1] = self.target
        wide[: len(self.bias), -1] = self.bias
        wide[-1, : 2 * SIZE] = self.place.ravel()
        return wide

    @classmethod
    def of(cls, wide: np.ndarray) -> Weights:
        return cls(wide[:-1, :SIZE].astype(np.float32), wide[:-2, SIZE:-1].astype(np.float32), wide[:-2, -1].astype(np.float32), wide[-1, : 2 * SIZE].reshape(2, SIZE).astype(np.float32))


@dataclass
class Language:
    """What scoring needs: frequent words with their classes and counts, and the classes' totals."""

    words: dict[bytes, int]
    word_class: np.ndarray
    word_count: np.ndarray
    class_count: np.ndarray
    discount: np.ndarray
    tail_types: np.ndarray
    n_tokens: int
    n_types: int
    weights: Weights | None = None
    normaliser: np.ndarray | None = field(default=None, repr=False)

    @property
    def classes(self) -> int:
        return len(self.class_count)

    @property
    def kind_type(self) -> type:
        """The smallest type that holds all classes and the start."""
        return np.int16 if self.classes < 1 << 15 else np.int32

    def read(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Place among the frequent words, or -1, and class."""
        at = np.fromiter(map(self.words.get, words, repeat(-1)), np.int64, len(words))
        kind = np.where(at >= 0, self.word_class[at], 0) if len(self.word_class) else np.zeros(len(at), np.int64)
        rare = np.flatnonzero(at < 0)
        kind[rare] = self.classes - TAILS + np.fromiter((tail_of(words[i]) for i in rare.tolist()), np.int64, len(rare))
        return at, kind

    def contexts(self, kinds: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The two classes before each token; before the first ones stands the start."""
        start, first = self.classes, np.cumsum(lengths) - lengths
        one, two = np.append(start, kinds[:-1]), np.append([start, start], kinds[:-2])[: len(kinds)]
        one[first] = two[first] = start
        second = first[lengths > 1] + 1
        two[second] = start
        return one, two

    def class_log10(self, kinds: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        w = self.weights
        one, two = self.contexts(kinds, lengths)
        if self.normaliser is None:
            self.normaliser = np.full((self.classes + 1) ** 2, np.nan, np.float32)
        pair = one * (self.classes + 1) + two
        met = np.unique(pair)
        met = met[np.isnan(self.normaliser[met])]
        for i in range(0, len(met), 512):
            part = met[i : i + 512]
            q = w.context[part // (self.classes + 1)] * w.place[0] + w.context[part % (self.classes + 1)] * w.place[1]
            s = q @ w.target.T
            s += w.bias
            top = s.max(axis=1)
            s -= top[:, None]
            self.normaliser[part] = np.log(np.exp(s, out=s).sum(axis=1)) + top
        q = w.context[one] * w.place[0] + w.context[two] * w.place[1]
        return ((q * w.target[kinds]).sum(axis=1) + w.bias[kinds] - self.normaliser[pair]).astype(np.float64) / LOG10

    def base_log10(self, count):
        return np.log10((count + 0.5) / (self.n_tokens + 0.5 * (self.n_types + 1)))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in byte_slices(batches, "text", 16 << 20):
        counts: Counter = Counter()
        for text in raw(batch.column("text")):
            counts.update(tokens(text))
        yield pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())], ["word", "n"])


def _tail(word: Column) -> Column:
    """As tail_of, from 0, in SQL."""
    code = F.conv(F.hex(F.substring(word, -1, 1)), 16, 10).cast("int") - 97
    return F.when((F.octet_length(word) > 0) & code.between(0, 25), code).otherwise(26)


def _sums(index: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different indices, and the sums of their rows."""
    order = np.argsort(index, kind="stable")
    index = index[order]
    first = np.flatnonzero(np.append(True, index[1:] != index[:-1]))
    return index[first], np.add.reduceat(rows.take(order, axis=0), first, axis=0)


def _climb(value: np.ndarray, past: np.ndarray, at: np.ndarray, slope: np.ndarray, rate: np.float32) -> None:
    """One step of the rows `at`, with step sizes by past slopes; the other rows have no slope."""
    squares = past.take(at, axis=0) + slope * slope
    past[at] = squares
    value[at] += rate * slope / np.sqrt(squares + np.float32(1e-10))


def _learn(batch: tuple[np.ndarray, np.ndarray, np.ndarray], w: Weights, seen: list[np.ndarray], noise: np.ndarray, share: np.ndarray, rate: float) -> None:
    """One step of noise-contrastive estimation on a batch, with step sizes by past slopes."""
    one, two, kind = batch
    n, rate = np.float32(len(kind)), np.float32(rate)
    x, y = w.context.take(one, axis=0), w.context.take(two, axis=0)
    q = x * w.place[0] + y * w.place[1]
    own, others, excess = w.target.take(kind, axis=0), w.target.take(noise, axis=0), w.bias - share
    with np.errstate(over="ignore"):
        true = 1 / (1 + np.exp(np.einsum("ij,ij->i", q, own) + excess.take(kind)))
        false = 1 / (1 + np.exp(-(q @ others.T + excess.take(noise))))
    for_q = (true[:, None] * own - false @ others) / n
    slopes = np.empty((len(kind) + len(noise), SIZE + 1), np.float32)  # of targets and biases
    slopes[: len(kind), :-1], slopes[: len(kind), -1] = true[:, None] * q, true
    slopes[len(kind) :, :-1], slopes[len(kind) :, -1] = -(false.T @ q), -false.sum(axis=0)
    target, slopes = _sums(np.concatenate([kind, noise]), slopes / n)
    context, for_context = _sums(np.concatenate([one, two]), np.concatenate([for_q * w.place[0], for_q * w.place[1]]))
    place = np.stack([np.einsum("ij,ij->j", for_q, x), np.einsum("ij,ij->j", for_q, y)])
    steps = ((context, for_context), (target, slopes[:, :-1]), (target, slopes[:, -1]), (np.arange(2), place))
    for value, past, (at, slope) in zip((w.context, w.target, w.bias, w.place), seen, steps, strict=True):
        _climb(value, past, at, slope, rate)


def _reader(language: Language):
    """The classes of each text's tokens, as bytes of numbers."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "text"):
            lists = [tokens(t) for t in raw(batch.column("text"))]
            kinds = language.read([t for x in lists for t in x])[1].astype(language.kind_type)
            ends = np.cumsum([len(x) for x in lists])
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes() for x in np.split(kinds, ends[:-1])], pa.binary())], ["kinds"])

    return read


def _trainer(language: Language, seed: int):
    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        rng = np.random.default_rng([seed, TaskContext.get().partitionId()])
        w = Weights.of(language.weights.rows())
        seen = [np.zeros_like(v) for v in (w.context, w.target, w.bias, w.place)]
        p = (language.class_count + 0.5) / (language.class_count + 0.5).sum()
        share = np.log(NOISE * p).astype(np.float32)
        edges, met = np.cumsum(p), 0
        for batch in byte_slices(batches, "kinds", 1 << 20):
            rows = batch.column("kinds").to_pylist()
            kinds = np.frombuffer(b"".join(rows), language.kind_type)
            one, two = (x.astype(kinds.dtype) for x in language.contexts(kinds, np.array([len(x) // kinds.itemsize for x in rows])))
            order = rng.permutation(len(kinds))
            for i in range(0, len(order), BATCH):
                at = order[i : i + BATCH]
                noise = np.minimum(np.searchsorted(edges, rng.random(NOISE)), len(p) - 1).astype(kinds.dtype)
                _learn((one[at], two[at], kinds[at]), w, seen, noise, share, 0.1)
            met += len(kinds)
        if met:
            wide = w.rows()
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(wide))), pa.array(np.full(len(wide), met)), pa.array(list(wide), pa.list_(pa.float64()))], ["row", "n", "v"])

    return train


def fit(docs: DataFrame, text_col: str = "text", head: int = HEAD, known: int = KNOWN, rounds: int = ROUNDS) -> tuple[Language, DataFrame]:
    """The model of the documents given, and the table of all their words' counts."""
    spark = docs.sparkSession
    texts = docs.select(text_of(text_col).alias("text"))
    counts = staged(texts.mapInArrow(_count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")), "words")
    size = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    top = counts.orderBy(F.desc("n"), "word").limit(known).collect()  # the fixed number that every executor gets
    own = top[:head]
    tails = counts.join(F.broadcast(spark.createDataFrame([(bytes(r.word),) for r in own], "word binary")), "word", "left_anti")
    tails = tails.groupBy(_tail(F.col("word")).alias("tail")).agg(F.sum("n").alias("n"), F.count("*").alias("v"), F.count(F.when(F.col("n") == 1, 1)).alias("n1"), F.count(F.when(F.col("n") == 2, 1)).alias("n2"))
    class_count = np.zeros(len(own) + TAILS)
    class_count[: len(own)] = [r.n for r in own]
    types, discount = np.zeros(TAILS), np.full(TAILS, 0.5)
    for r in tails.collect():  # at most TAILS rows
        class_count[len(own) + r.tail], types[r.tail] = r.n, r.v
        discount[r.tail] = min(0.9, max(0.1, r.n1 / max(1, r.n1 + 2 * r.n2)))
    words = {bytes(r.word): i for i, r in enumerate(top)}
    kinds = np.array([i if i < len(own) else len(own) + tail_of(bytes(r.word)) for i, r in enumerate(top)], np.int64)
    language = Language(words, kinds, np.array([r.n for r in top], np.int64), class_count, discount, types, int(size.n), int(size.v))
    rng = np.random.default_rng(1)
    c = language.classes
    p = (class_count + 0.5) / (class_count + 0.5).sum()
    weights = Weights(rng.normal(0, 0.3, (c + 1, SIZE)), rng.normal(0, 0.1, (c, SIZE)), np.log(p), np.full((2, SIZE), 0.7))
    kinds_read = staged(texts.mapInArrow(_reader(language), "kinds binary"), "kinds")
    for turn in range(rounds):
        language.weights = Weights.of(weights.rows())
        trained = kinds_read.mapInArrow(_trainer(language, turn), "row long, n long, v array<double>")
        mean = trained.groupBy("row").agg(F.sum("n").alias("n"), *[F.sum(F.col("v")[i] * F.col("n")).alias(f"v{i}") for i in range(2 * SIZE + 1)]).collect()  # a row for each class
        if mean:
            wide = np.zeros((c + 2, 2 * SIZE + 1))
            for r in mean:
                wide[r.row] = [r[f"v{i}"] / r.n for i in range(2 * SIZE + 1)]
            weights = Weights.of(wide)
    language.weights = Weights.of(weights.rows())
    return language, counts


def _within(language: Language, tail: np.ndarray, count: np.ndarray) -> np.ndarray:
    """log10 of a rarer word's share of its class; a count of 0 is any unknown word."""
    total = language.class_count[language.classes - TAILS + tail]
    freed = language.discount[tail] * language.tail_types[tail]
    share = np.where(count > 0, count - language.discount[tail], np.where(total > 0, freed, 1.0)) / np.maximum(total, 1.0)
    return np.log10(np.maximum(share, 1e-300))


SCORED = "id long, n_tokens long, n_known long, base_score double, score double, rare array<struct<word: binary, n: long>>"


def _scorer(shared):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        language: Language = shared.value
        own = language.classes - TAILS
        base = language.base_log10(language.word_count)
        inside = np.zeros(len(language.word_class))
        late = language.word_class >= own
        inside[late] = _within(language, language.word_class[late] - own, language.word_count[late])
        for batch in byte_slices(batches, "text", 2 << 20):
            lists = [tokens(t) for t in raw(batch.column("text"))]
            lengths = np.array([len(x) for x in lists])
            flat = [t for x in lists for t in x]
            at, kinds = language.read(flat)
            found = at >= 0
            value = language.class_log10(kinds, lengths)
            value[found] += inside[at[found]]
            first = np.cumsum(lengths) - lengths
            total = np.add.reduceat(value, first)
            known = np.add.reduceat(found.astype(np.int64), first)
            plain = np.zeros(len(at))
            plain[found] = base[at[found]]
            rare = []
            missing = np.flatnonzero(~found)
            for a, b in zip(np.searchsorted(missing, first), np.searchsorted(missing, first + lengths), strict=True):
                rare.append([{"word": w, "n": n} for w, n in Counter(flat[i] for i in missing[a:b]).items()])
            columns = [batch.column("id"), pa.array(lengths, pa.int64()), pa.array(known), pa.array(np.add.reduceat(plain, first)), pa.array(total), pa.array(rare, pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())])))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n_tokens", "n_known", "base_score", "score", "rare"])

    return score


def score_texts(docs: DataFrame, language: Language, counts: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For every row its tokens, those known from training, and the log10 probabilities of base and model."""
    spark = docs.sparkSession
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), text_of(text_col).alias("text"))
    rows = staged(texts.mapInArrow(_scorer(spark.sparkContext.broadcast(language)), SCORED).withColumn("row", F.monotonically_increasing_id()), "scored")
    rare = rows.select("row", F.explode("rare").alias("r")).select("row", "r.word", F.col("r.n").alias("times")).join(counts, "word", "left")
    count, tail = F.coalesce("n", F.lit(0)), _tail(F.col("word"))
    own = language.classes - TAILS
    total, discount, types = (F.element_at(F.array(*[F.lit(float(x)) for x in v]), tail + 1) for v in (language.class_count[own:], language.discount, language.tail_types))
    share = F.when(count > 0, count - discount).when(total > 0, discount * types).otherwise(F.lit(1.0)) / F.greatest(total, F.lit(1.0))
    base = F.log10((count + 0.5) / F.lit(language.n_tokens + 0.5 * (language.n_types + 1)))
    more = rare.groupBy("row").agg(
        F.sum(F.when(count > 0, F.col("times")).otherwise(0)).alias("more_known"), F.sum(F.col("times") * base).alias("more_base"), F.sum(F.col("times") * F.log10(F.greatest(share, F.lit(1e-300)))).alias("more_score")
    )
    plus = lambda a, b: (F.col(a) + F.coalesce(F.col(b), F.lit(0))).alias(a)
    return rows.drop("rare").join(more, "row", "left").select(
        F.col("id").alias(id_col), "n_tokens", plus("n_known", "more_known"), F.lit(language.n_tokens).cast("long").alias("train_tokens"), plus("base_score", "more_base"), plus("score", "more_score")
    )
