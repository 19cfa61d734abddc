"""Token log-probabilities by a log-bilinear model trained with noise-contrastive estimation.

After Mnih and Teh, "A Fast and Simple Algorithm for Training Neural Probabilistic Language
Models" (2012): the vectors of the two words before, each weighted by its place, add up to a
prediction, whose product with a word's vector, plus the word's bias, is the word's score.

The model's vocabulary is the end of a text, the most frequent words, and one class for all
others. Within that class a word has its share of the class's training counts plus one half,
all unseen words together being one more word. So the probabilities of all words sum to one.

Since a score is the sum of one part per context word, the normaliser of every pair of
context words is an entry of one matrix product; scoring a token is three look-ups.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprep.llm.common import flat, slices, stored, text_of
from tabprep.llm.importance import cut_off
from tabprep.llm.words import HASHED, SOLID, Words

#: Ids of the model: the end of a text, which also stands before its first word, and other words.
END, OTHER = 0, 1
#: Ids in all; numbers per word vector.
VOCABULARY, WIDTH = 1024, 24
#: Words whose counts every task holds; the counts of others are joined.
HEAD = 1 << 18
#: Passes over the training tokens; tokens per step; noise words that a step's tokens share; rate; seed.
PASSES, STEP, NOISE, RATE, SEED = 2, 4096, 128, 0.1, 42
#: Tokens whose ids a training task holds at once.
HELD = 1 << 20


def counts(docs: DataFrame) -> DataFrame:
    """``word, n``: how often each word (by hash) stands in the documents (``text``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def summed() -> pa.RecordBatch:
            word, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(n.astype(np.int64))], names=["word", "n"])

        for part in slices(batches, 0, HASHED):
            held.append(Words(part.column(0), SOLID).hashes)
            size += len(held[-1])
            if size >= 4 * HELD:
                yield summed()
                held, size = [], 0
        if size:
            yield summed()

    return docs.select("text").mapInArrow(run, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


class Lexicon:
    """The most frequent words: sorted hashes, their counts, and their ids in the model. Of bounded size."""

    def __init__(self, hashes: np.ndarray, n: np.ndarray):
        order = np.argsort(hashes)
        ids = np.full(len(hashes), OTHER, np.uint16)
        most = np.lexsort((hashes, -n))[: VOCABULARY - 2]
        ids[most] = np.arange(2, 2 + len(most))
        self.hashes, self.n, self.ids = hashes[order], n[order], ids[order]

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the words, and whether they are there."""
        if not len(self.hashes):
            return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return at, self.hashes[at] == hashes


def encode(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """Every document's model ids and what the lexicon says about its words.

    ``docs`` has ``key, text, held_out``; the result ``key, held_out, n_tokens, n_head,
    head_log, other_log, ids, rest``: words in the lexicon, the sum of log10(count + 0.5) over
    them, the same over those of the class of others, the ids (16 bits each, the end last),
    and the hashes of words not in the lexicon.
    """
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)
    kind = docs.schema["key"].dataType.simpleString()
    schema = f"key {kind}, held_out boolean, n_tokens bigint, n_head bigint, head_log double, other_log double, ids binary, rest array<bigint>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        logs = np.log10(known.n + 0.5)
        for part in slices(batches, 1, HASHED):
            words = Words(part.column(1), SOLID)
            unique, back = np.unique(words.hashes, return_inverse=True)
            at, there = known.find(unique)
            id_of = np.where(there, known.ids[at] if len(known.ids) else OTHER, OTHER).astype("<u2")
            log_of = np.where(there, logs[at] if len(logs) else 0.0, 0.0)
            ids, log, found = id_of[back], log_of[back], there[back]
            first, rows = words.first, part.num_rows
            owner = np.repeat(np.arange(rows), np.diff(first))
            other = log * (ids == OTHER)
            missing = np.flatnonzero(~found)
            edges = np.searchsorted(missing, first)
            rest = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(words.hashes[missing].view(np.int64)))
            raw = ids.tobytes()
            end = np.array([END], "<u2").tobytes()
            spans = zip((2 * first[:-1]).tolist(), (2 * first[1:]).tolist(), strict=True)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0), part.column(2), pa.array(np.diff(first) + 1),
                    pa.array(np.bincount(owner, weights=found, minlength=rows).astype(np.int64)),
                    pa.array(np.bincount(owner, weights=log, minlength=rows).astype(np.float64)),
                    pa.array(np.bincount(owner, weights=other, minlength=rows).astype(np.float64)),
                    pa.array([raw[a:b] + end for a, b in spans], pa.binary()), rest,
                ],
                names=["key", "held_out", "n_tokens", "n_head", "head_log", "other_log", "ids", "rest"],
            )

    return docs.select("key", "text", "held_out").mapInArrow(run, schema)


class Model:
    """Vectors of context and predicted words, weights by place, biases."""

    def __init__(self, share: np.ndarray):
        r = np.random.default_rng(SEED)
        self.share = share
        self.parts = [
            r.normal(0, 0.1, (VOCABULARY, WIDTH)).astype(np.float32),
            r.normal(0, 0.1, (VOCABULARY, WIDTH)).astype(np.float32),
            np.ones((2, WIDTH), np.float32),
            np.log(share).astype(np.float32),
        ]

    def train(self, before: np.ndarray, last: np.ndarray, word: np.ndarray, squares: list[np.ndarray], r: np.random.Generator) -> None:
        """Steps of noise-contrastive estimation over tokens and the two ids before each."""
        context, target, weight, bias = self.parts
        noise_log = np.log(NOISE * self.share).astype(np.float32)
        noise_of = np.cumsum(self.share)
        for a in range(0, len(word), STEP):
            c2, c1, w = before[a : a + STEP], last[a : a + STEP], word[a : a + STEP]
            noise = np.minimum(np.searchsorted(noise_of, r.random(NOISE)), VOCABULARY - 1)
            v2, v1 = context[c2], context[c1]
            guess = v2 * weight[0] + v1 * weight[1]
            tw, tn = target[w], target[noise]
            true = (guess * tw).sum(axis=1) + bias[w] - noise_log[w]
            false = guess @ tn.T + bias[noise] - noise_log[noise]
            up = 1 / (1 + np.exp(true))
            down = -1 / (1 + np.exp(-false))
            back = up[:, None] * tw + down @ tn
            n = np.float32(len(w))
            steps = [
                _summed(np.concatenate([c2, c1]), np.concatenate([back * weight[0], back * weight[1]])),
                _summed(np.concatenate([w, noise]), np.concatenate([up[:, None] * guess, down.T @ guess])),
                np.stack([(back * v2).sum(axis=0), (back * v1).sum(axis=0)]),
                (np.bincount(w, weights=up, minlength=VOCABULARY) + np.bincount(noise, weights=down.sum(axis=0), minlength=VOCABULARY)).astype(np.float32),
            ]
            for part, square, step in zip(self.parts, squares, steps, strict=True):
                step /= n
                square += step * step
                part += RATE * step / np.sqrt(square + 1e-8)

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Log10 parts of a token's probability: by (id two before, id), (id before, id), and (both before)."""
        context, target, weight, bias = (p.astype(np.float64) for p in self.parts)
        far = (context * weight[0]) @ target.T
        near = (context * weight[1]) @ target.T + bias
        most_far, most_near = far.max(axis=1, keepdims=True), near.max(axis=1, keepdims=True)
        sums = np.exp(far - most_far) @ np.exp(near - most_near).T
        normaliser = np.log(sums) + most_far + most_near.T
        return tuple((t / np.log(10)).astype(np.float32) for t in (far, near, normaliser))


def _summed(ids: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Sums of rows by id."""
    order = np.argsort(ids.astype(np.uint16), kind="stable")  # sorted by radix, as wider integers are not
    ordered = ids[order]
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    out = np.zeros((VOCABULARY, rows.shape[1]), np.float32)
    out[ordered[first]] = np.add.reduceat(rows[order], first, axis=0)
    return out


def _contexts(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All tokens of some documents with the two before each, and the documents' borders."""
    raw, borders = flat(column)
    word = np.frombuffer(raw.tobytes(), "<u2").astype(np.int64)
    starts = borders[:-1] // 2
    last, before = np.empty_like(word), np.empty_like(word)
    last[1:], before[2:] = word[:-1], word[:-2]
    last[starts] = END
    before[starts] = END
    second = starts + 1
    before[second[second < borders[1:] // 2]] = END
    return before, last, word, borders // 2


def train(rows: DataFrame, model: Model) -> Model:
    """Passes of training over the documents not held out; each averages the tasks' models by tokens.

    A task trains on its documents one slice at a time, so its memory does not grow with them.
    Models meet in about as many sums as the root of the number of tasks.
    """
    spark = rows.sparkSession
    used = rows.filter("not held_out").select("ids")

    def sums(parts: list[np.ndarray], n: float) -> pa.RecordBatch:
        flat = np.concatenate([p.ravel() for p in parts]).astype(np.float64)
        return pa.RecordBatch.from_arrays([pa.array([n]), pa.array([(flat * n).tobytes()], pa.binary())], names=["n", "sums"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0.0, None
        for batch in batches:
            for m, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                one = np.frombuffer(raw.as_buffer(), np.float64)
                n, total = n + m, one.copy() if total is None else total + one
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([total.tobytes()], pa.binary())], names=["n", "sums"])

    for turn in range(PASSES):
        shared = spark.sparkContext.broadcast(model)

        def run(batches: Iterator[pa.RecordBatch], shared=shared, turn=turn) -> Iterator[pa.RecordBatch]:
            own, n = _copy(shared.value), 0
            squares = [np.zeros_like(p) for p in own.parts]
            r = np.random.default_rng((SEED, turn))
            for part in slices(batches, 0, 2 * HELD):
                before, last, word, _ = _contexts(part.column(0))
                mixed = r.permutation(len(word))
                own.train(before[mixed], last[mixed], word[mixed], squares, r)
                n += len(word)
            if n:
                yield sums(own.parts, float(n))

        trained = stored(used.mapInArrow(run, "n double, sums binary"), "models")
        tasks = trained.count()
        if not tasks:
            return model
        found = trained.repartition(int(np.ceil(np.sqrt(tasks)))).mapInArrow(add, "n double, sums binary").collect()
        mean = sum(np.frombuffer(x["sums"], np.float64) for x in found) / sum(x["n"] for x in found)
        model = _copy(model)
        at = 0
        for i, p in enumerate(model.parts):
            model.parts[i] = mean[at : at + p.size].reshape(p.shape).astype(np.float32)
            at += p.size
    return model


def _copy(model: Model) -> Model:
    new = Model.__new__(Model)
    new.share, new.parts = model.share, [p.copy() for p in model.parts]
    return new


@lru_cache(maxsize=1)
def _tables(content: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A Python worker's tables, which outlive its tasks."""
    import pickle

    return pickle.loads(content).tables()


def log_probabilities(rows: DataFrame, model: Model) -> DataFrame:
    """The rows with ``model_log`` (log10 over the model's ids) and ``n_other`` in place of ``ids``."""
    import pickle

    content = pickle.dumps(model)
    kind = rows.schema["row"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        far, near, normaliser = _tables(content)
        for part in slices(batches, 1, 2 * HELD):
            before, last, word, borders = _contexts(part.column(1))
            log = far[before, word].astype(np.float64) + near[last, word] - normaliser[before, last]
            owner = np.repeat(np.arange(part.num_rows), np.diff(borders))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(np.bincount(owner, weights=log, minlength=part.num_rows)), pa.array(np.bincount(owner, weights=word == OTHER, minlength=part.num_rows).astype(np.int64))],
                names=["row", "model_log", "n_other"],
            )

    return rows.select("row", "ids").mapInArrow(run, f"row {kind}, model_log double, n_other bigint")


def score(df: DataFrame, key: str, text: str, held_out: F.Column) -> DataFrame:
    """``key, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every whole text.

    Tokens are the words (A-Z lowered, between ASCII white space) and one end per text. Counts,
    the vocabulary and the model come from all texts that are not held out. ``base_score`` sums
    log10((c + 0.5) / (N + 0.5 (V + 1))); ``score`` is the model's log10 probability of the text.

    Null and empty texts hold the end alone; a null ``held_out`` is false. Every row gives one
    row, also where keys are null or repeat. An empty table gives an empty result; without
    training texts every word is unseen. Other columns are not read. Words are told apart by
    64-bit hashes.
    """
    docs = df.select(F.col(key).alias("key"), text_of(text).alias("text"), F.coalesce(held_out, F.lit(False)).alias("held_out"))
    training = docs.filter("not held_out")
    table = stored(counts(training), "counts")
    ends = training.count()
    words, types = table.agg(F.sum("n"), F.count("*")).first()
    total, distinct = (words or 0) + ends, types + (ends > 0)
    # fewer than HEAD words stand above the cut; those that tie with it are joined like rarer ones
    cut = cut_off(table, "n", HEAD)
    head = (table if cut is None else table.filter(F.col("n") > cut)).collect()
    lexicon = Lexicon(np.array([r["word"] for r in head], np.int64).view(np.uint64), np.array([r["n"] for r in head], np.int64))
    rows = stored(encode(docs, lexicon).withColumn("row", F.monotonically_increasing_id()), "ids")

    n_of = np.zeros(VOCABULARY)
    modelled = lexicon.ids != OTHER
    n_of[lexicon.ids[modelled]] = lexicon.n[modelled]
    n_of[END] = ends
    n_of[OTHER] = total - n_of.sum()
    model = train(rows, Model((n_of + 0.5) / (n_of + 0.5).sum()))

    # the lexicon holds the most frequent words, so no word of this join is hot
    rest = rows.select("row", F.explode("rest").alias("word")).groupBy("row", "word").agg(F.count("*").alias("times"))
    met = rest.join(table, "word", "left").groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + F.lit(0.5))).alias("rest_log"),
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("n_met"),
    )
    norm = float(np.log10(total + 0.5 * (distinct + 1)))
    others = float(np.log10(n_of[OTHER] + 0.5 * (types - int(modelled.sum()) + 1)))
    end_log = float(np.log10(ends + 0.5))
    rest_log = F.coalesce("rest_log", F.lit(0.0))
    return (
        rows.drop("ids", "rest").join(log_probabilities(rows, model), "row").join(met, "row", "left").select(
            F.col("key").alias(key), "held_out", "n_tokens",
            (F.col("n_head") + F.coalesce("n_met", F.lit(0)) + F.lit(int(ends > 0))).cast("long").alias("n_known"),
            F.lit(total).cast("long").alias("train_tokens"),
            (F.col("head_log") + rest_log + F.lit(end_log) - F.col("n_tokens") * F.lit(norm)).alias("base_score"),
            (F.col("model_log") + F.col("other_log") + rest_log - F.col("n_other") * F.lit(others)).alias("score"),
        )
    )
