"""Document log-likelihood under a gated recurrent language model.

Spark counts every word of the training documents. The counts give the vocabulary,
the classes of the class-factored softmax, its fixed biases and the shares of rare
words. The other weights are fitted in numpy by truncated backpropagation over all
training documents: in each round, tasks start from the same weights, go through
their whole documents of the round, and their weights are averaged by the words
they saw. Every whole document is scored in windows that hand the state on. The words that the model knows by itself and a bounded
head of the counts travel to the tasks; the rarer words of a document, whose
number grows with the corpus, meet their counts in a join.
"""

from __future__ import annotations

from collections import Counter
from itertools import repeat
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from areapulse.llm.common import Emitter, fold, lower_ascii, rows_of
from areapulse.session import stage

FOLDS, HELD_OUT = 7, 2
#: The token after the last word; no word is empty.
END = b""
HEAD_WORDS = 100_000
MODEL_WORDS = 5_000
#: At least so many; as many as the root of the words where that is more.
CLASSES = 40
STATE = 16
#: All training documents are gone through once, in so many parts; the weights are averaged after each.
ROUNDS = 4
TRAIN_LANES = 128
TRAIN_WINDOW = 24
#: Steps of the optimiser that a round is good for at least, by fewer lanes, and words of a task and round at least.
LEAST_STEPS = 1024
TASK_WORDS = 400_000
#: Averages of so many tasks become one before they come together.
AVERAGED_AT_ONCE = 32
WINDOW = 64
LANES = 1024
_FLUSH_WORDS = 400_000


def sigmoid(x: np.ndarray) -> None:
    """In place."""
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    np.reciprocal(x, out=x)


def log_softmax_at(logits: np.ndarray, targets: np.ndarray, shares: bool) -> np.ndarray:
    """Log probability of each column's target; ``logits`` become, with ``shares``, the probabilities less one at the targets."""
    logits -= logits.max(axis=0)
    nth = np.arange(len(targets))
    result = logits[targets, nth]
    np.exp(logits, out=logits)
    sums = logits.sum(axis=0)
    if shares:
        logits /= sums
        logits[targets, nth] -= 1
    return result - np.log(sums)


def frequency_classes(counts: np.ndarray, classes: int) -> tuple[np.ndarray, np.ndarray]:
    """Contiguous classes of about equal sums of root counts: their first words, and the class of each word; the last word alone."""
    share = np.cumsum(np.sqrt(counts[:-1]))
    at = np.minimum((share / share[-1] * (classes - 1)).astype(int), classes - 2) if len(share) else np.empty(0, int)
    _, class_of = np.unique(at, return_inverse=True)
    class_of = np.append(class_of, class_of.max() + 1 if len(class_of) else 0)
    return np.flatnonzero(np.diff(class_of, prepend=-1)), class_of


class GatedModel:
    """A gated recurrent unit with a softmax over classes and one over the words of the class."""

    def __init__(self, counts: np.ndarray, classes: int = CLASSES, state: int = STATE, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.starts, self.class_of = frequency_classes(counts, classes)
        self.ends = np.append(self.starts[1:], len(counts))
        mass = np.add.reduceat(counts + 1.0, self.starts)
        small = lambda *shape: rng.normal(0, 0.08, shape).astype(np.float32)
        self.state = state
        self.weights = {
            "embed": small(len(counts) + 1, state), "into": small(state, 3 * state), "gate_bias": np.zeros(3 * state, np.float32),
            "again": small(state, 3 * state), "class": small(state, len(self.starts)),
            "class_bias": np.log(mass / mass.sum()).astype(np.float32), "word": small(state, len(counts)),
            "word_bias": np.log((counts + 1.0) / mass[self.class_of]).astype(np.float32),
        }

    def step(self, inputs: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, tuple]:
        s, again = self.state, h @ self.weights["again"]
        gates = again[:, : 2 * s] + inputs[:, : 2 * s]
        sigmoid(gates)
        reset, hold = gates[:, :s], gates[:, s:]
        fresh = reset * again[:, 2 * s :]
        fresh += inputs[:, 2 * s :]
        np.tanh(fresh, out=fresh)
        after = h - fresh
        after *= hold
        after += fresh
        return after, (h, reset, hold, fresh, again[:, 2 * s :])

    def outputs(self, h: np.ndarray, words: np.ndarray, gradients: dict | None = None) -> tuple[np.ndarray, np.ndarray | None]:
        """Natural log probability of each word given each state; with ``gradients``, adds to them and returns those of the states."""
        w, learning = self.weights, gradients is not None
        classes = self.class_of[words]
        # rows in order of their classes, one a column: sums over words of a class go down the columns
        order = np.argsort(classes.astype(np.uint16), kind="stable")
        classes, h = classes[order], h[order]
        columns, targets = np.ascontiguousarray(h.T), words[order] - self.starts[classes]
        logits = w["class"].T @ columns
        logits += w["class_bias"][:, None]
        result, dh = log_softmax_at(logits, classes, learning), None
        if learning:
            gradients["class"] += (logits @ h).T
            dh = logits.T @ w["class"].T
        cuts = np.searchsorted(classes, np.arange(len(self.starts) + 1)).tolist()
        by_word, bias = np.ascontiguousarray(w["word"].T), w["word_bias"][:, None]
        for k, (lo, hi) in enumerate(zip(self.starts.tolist(), self.ends.tolist(), strict=True)):
            first, last = cuts[k], cuts[k + 1]
            if hi - lo > 1 and first < last:
                logits = by_word[lo:hi] @ columns[:, first:last]
                logits += bias[lo:hi]
                result[first:last] += log_softmax_at(logits, targets[first:last], learning)
                if learning:
                    gradients["word"][:, lo:hi] += (logits @ h[first:last]).T
                    dh[first:last] += logits.T @ by_word[lo:hi]
        back = np.empty_like(order)
        back[order] = np.arange(len(order))
        return result[back], dh[back] if learning else None

    #: Weights that are learnt; the biases of the softmax come from the counts and stay.
    LEARNT = ("embed", "into", "gate_bias", "again", "class", "word")

    def vector(self) -> np.ndarray:
        return np.concatenate([self.weights[k].ravel() for k in self.LEARNT]).astype(np.float64)

    def load(self, vector: np.ndarray) -> None:
        at = 0
        for k in self.LEARNT:
            old = self.weights[k]
            self.weights[k] = vector[at : at + old.size].reshape(old.shape).astype(np.float32)
            at += old.size

    def fit(self, texts: list[np.ndarray], lanes: int = 32, window: int = TRAIN_WINDOW, rate: float = 0.01, moments: dict | None = None) -> None:
        """One pass of truncated backpropagation: texts follow each other in lanes, states go on from window to window.

        ``moments`` carries the optimiser's averages on to the next call.
        """
        w, s, first = self.weights, self.state, len(self.class_of)
        if not texts:
            return
        moments = {} if moments is None else moments
        moments.setdefault("steps", 0)
        words = np.concatenate(texts).astype(np.int64)
        before = np.append(first, words[:-1])
        before[np.cumsum([0, *map(len, texts[:-1])])] = first
        length = len(words) // lanes
        if not length:
            lanes, length = 1, len(words)
        words, before = (v[: lanes * length].reshape(lanes, length) for v in (words, before))
        for k in self.LEARNT:
            moments.setdefault(k, (np.zeros_like(w[k]), np.zeros_like(w[k])))
        h = np.zeros((lanes, s), np.float32)
        for at in range(0, length, window):
            moments["steps"] = nth = moments["steps"] + 1
            x, y = before[:, at : at + window].T, words[:, at : at + window].T
            gradients = {k: np.zeros_like(w[k]) for k in self.LEARNT}
            kept, states = [], []
            embedded = w["embed"][x]
            inputs = embedded @ w["into"] + w["gate_bias"]
            begins = x == first
            some = begins.any(axis=1).tolist()
            for t in range(len(x)):
                h, parts = self.step(inputs[t], np.where(begins[t][:, None], h.dtype.type(0), h) if some[t] else h)
                kept.append(parts)
                states.append(h)
            _, dflat = self.outputs(np.concatenate(states), y.ravel(), gradients)
            dflat = dflat.reshape(len(x), lanes, s)
            old, reset, hold, fresh, again = (np.stack(parts) for parts in zip(*kept, strict=True))
            # what the gradient of a state is multiplied by on its way to the gates
            to_fresh = (1 - hold) * (1 - fresh * fresh)
            to_reset, to_hold = again * reset * (1 - reset), (old - fresh) * hold * (1 - hold)
            dinputs, dagain, dh = np.empty_like(inputs), np.empty_like(inputs), np.zeros_like(h)
            back = np.ascontiguousarray(w["again"].T)
            for t in range(len(x) - 1, -1, -1):
                dh += dflat[t]
                dfresh = dinputs[t, :, 2 * s :]
                np.multiply(dh, to_fresh[t], out=dfresh)
                np.multiply(dfresh, to_reset[t], out=dinputs[t, :, :s])
                np.multiply(dh, to_hold[t], out=dinputs[t, :, s : 2 * s])
                dagain[t, :, : 2 * s] = dinputs[t, :, : 2 * s]
                np.multiply(dfresh, reset[t], out=dagain[t, :, 2 * s :])
                dh *= hold[t]
                dh += dagain[t] @ back
                if some[t]:
                    dh[begins[t]] = 0
            gradients["again"] += old.reshape(-1, s).T @ dagain.reshape(-1, 3 * s)
            flat_inputs = dinputs.reshape(-1, 3 * s)
            gradients["into"] += embedded.reshape(-1, s).T @ flat_inputs
            gradients["gate_bias"] += flat_inputs.sum(axis=0)
            # rows of one word are added up side by side
            order = np.argsort(x.ravel(), kind="stable")
            met = x.ravel()[order]
            cuts = np.flatnonzero(np.diff(met, prepend=-1))
            gradients["embed"][met[cuts]] = np.add.reduceat((flat_inputs @ w["into"].T)[order], cuts, axis=0)
            for k in self.LEARNT:
                g, (mean, square) = gradients[k], moments[k]
                g /= y.size
                np.clip(g, -1, 1, out=g)
                mean *= 0.9
                mean += 0.1 * g
                np.multiply(g, g, out=g)
                g *= 0.01
                square *= 0.99
                square += g
                np.multiply(square, 1 / (1 - 0.99**nth), out=g)
                np.sqrt(g, out=g)
                g += 1e-6
                np.divide(mean, g, out=g)
                g *= rate / (1 - 0.9**nth)
                w[k] -= g

    def log10_of(self, texts: list[np.ndarray], window: int = WINDOW, lanes: int = LANES) -> np.ndarray:
        """The model's log10 probability of each whole text, all of its windows included."""
        table = self.weights["embed"] @ self.weights["into"] + self.weights["gate_bias"]
        sizes = np.array([len(t) for t in texts], np.int64)
        out = np.zeros(len(texts))
        order = np.argsort(-sizes, kind="stable")
        for first in range(0, len(order), lanes):
            group = order[first : first + lanes]
            size, flat = sizes[group], np.concatenate([texts[i] for i in group])
            offset = np.cumsum(size) - size
            h = np.zeros((len(group), self.state), np.float32)
            total = np.zeros(len(group))
            states, words, owners, held = [], [], [], 0
            longest = int(size[0]) if len(size) else 0
            for t in range(longest):
                n = int(np.searchsorted(-size, -t))
                here = offset[:n] + t
                before = flat[here - 1] if t else np.full(n, len(self.class_of))
                h, _ = self.step(table[before], h[:n])
                states.append(h)
                words.append(flat[here])
                owners.append(np.arange(n))
                held += n
                # where few texts go on, more of their steps are looked up at once
                if 4 * held >= window * lanes or t == longest - 1:
                    logs, _ = self.outputs(np.concatenate(states), np.concatenate(words))
                    total += np.bincount(np.concatenate(owners), logs, len(group))
                    states, words, owners, held = [], [], [], 0
            out[group] = total / np.log(10)
        return out


def tokens_of(text: str | None) -> list[bytes]:
    return [*lower_ascii(text or "").split(), END]


def word_counts(docs: DataFrame) -> DataFrame:
    """``token`` and its count ``c`` over all texts, the end of each included; counted in tasks before the shuffle."""
    schema = pa.schema([("token", pa.binary()), ("c", pa.int64())])

    def count(batches):
        counts: Counter[bytes] = Counter()
        for (text,) in rows_of(batches, "text"):
            counts.update(tokens_of(text))
            if len(counts) >= _FLUSH_WORDS:
                yield pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())], schema=schema)
                counts = Counter()
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], schema=schema)

    return docs.select("text").mapInArrow(count, "token binary, c long").groupBy("token").agg(F.sum("c").alias("c"))


def average(rows: DataFrame, tasks: int) -> tuple[np.ndarray, float] | None:
    """Sum of weighted vectors and of weights over all tasks, added up in groups of tasks until one is left."""
    schema = "weights binary, seen double"

    def add(batches):
        total, seen = None, 0.0
        for weights, n in rows_of(batches, "weights", "seen"):
            vector = np.frombuffer(weights)
            total, seen = vector.copy() if total is None else total + vector, seen + n
        if total is not None:
            yield pa.RecordBatch.from_pydict({"weights": pa.array([total.tobytes()], pa.binary()), "seen": pa.array([seen])})

    while tasks > 1:
        tasks = -(-tasks // AVERAGED_AT_ONCE)
        rows = stage(rows.sparkSession, rows.repartition(tasks).mapInArrow(add, schema), "averages")
    found = rows.collect()
    return (sum(np.frombuffer(r["weights"]) for r in found), sum(r["seen"] for r in found)) if found else None


def train(texts: DataFrame, model: GatedModel, numbers: dict[bytes, int], known: int, words: int, rounds: int = ROUNDS) -> float:
    """Fit ``model`` on all ``texts`` (``doc_id``, ``text``) of so many ``words``, each text in one of the rounds; the words seen.

    ``numbers`` holds the words below ``known``, which stands for all others.
    """
    spark = texts.sparkSession
    shared = spark.sparkContext.broadcast(numbers)

    def number(batches):
        numbers, out = shared.value, Emitter(pa.schema([("part", pa.int64()), ("ids", pa.binary())]))
        for part, text in rows_of(batches, "part", "text"):
            ids = numbered(tokens_of(text), numbers, known)
            out.add(part, ids.astype("<u4").tobytes(), weight=4 * len(ids))
            if out.full:
                yield out.take()
        yield out.take()

    coded = stage(spark, texts.select(round_of(rounds), "text").mapInArrow(number, "part long, ids binary"), "numbered")
    return learn_from(coded, model, words, rounds)


def numbered(tokens: list[bytes], numbers: dict[bytes, int], other: int) -> np.ndarray:
    return np.fromiter(map(numbers.get, tokens, repeat(other)), np.int64, len(tokens))


def round_of(rounds: int):
    """The round a row of ``doc_id`` and ``text`` is learnt from in."""
    return F.pmod(F.xxhash64("doc_id", "text"), F.lit(rounds)).alias("part")


def learn_from(coded: DataFrame, model: GatedModel, words: int, rounds: int = ROUNDS) -> float:
    """Fit ``model`` on the rows of ``coded``, a stored table of the round (``part``) and the packed 32-bit ``ids`` of each text; the words seen.

    A task goes through its documents of a round in slices of lanes, from the
    weights that all tasks of the round start from. Small corpora get few tasks,
    as an average of models that have hardly begun is not better than one.
    """
    spark = coded.sparkSession
    tasks = max(1, words // rounds // TASK_WORDS)
    lanes = max(4, min(TRAIN_LANES, words // rounds // (TRAIN_WINDOW * LEAST_STEPS)))
    seen = 0.0
    for number in range(rounds):
        shared = spark.sparkContext.broadcast(model)

        def learn(batches, shared=shared):
            from copy import deepcopy

            model, moments, held, size, total = deepcopy(shared.value), {}, [], 0, 0
            for (ids,) in rows_of(batches, "ids"):
                held.append(np.frombuffer(ids, "<u4"))
                size += len(held[-1])
                if size >= _FLUSH_WORDS:
                    model.fit(held, lanes, moments=moments)
                    held, size, total = [], 0, total + size
            model.fit(held, lanes, moments=moments)
            total += size
            if total:
                yield pa.RecordBatch.from_pydict({"weights": pa.array([(model.vector() * total).tobytes()], pa.binary()), "seen": pa.array([float(total)])})

        rows = stage(spark, coded.where(F.col("part") == number).select("ids").coalesce(tasks).mapInArrow(learn, "weights binary, seen double"), "fitted")
        if found := average(rows, rows.count()):
            model.load(found[0] / found[1])
            seen += found[1]
        shared.unpersist()
    return seen


def scored(
    docs: DataFrame, head_words: int = HEAD_WORDS, model_words: int = MODEL_WORDS, rounds: int = ROUNDS,
) -> DataFrame:
    """Per row ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score``.

    Scores are log10 probabilities of the whole text and its end. A word outside
    the model has the probability of the model's last word times its share of the
    rarer words' counts, one added. NULL ids belong to the training documents,
    NULL texts are empty. The model learns from all whole training documents;
    documents that repeat are learnt as often as they occur. Without training
    documents every word is unknown; an empty table gives no rows.
    """
    spark = docs.sparkSession
    held_out = F.coalesce(fold("doc_id", FOLDS) == HELD_OUT, F.lit(False))
    texts = docs.select("doc_id", held_out.alias("held_out"), "text")
    counts = stage(spark, word_counts(texts.where(~F.col("held_out"))), "word_counts")
    sums = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("c").alias("v")).first()
    total, distinct = sums["n"], sums["v"]
    head = counts.orderBy(F.col("c").desc(), "token").limit(head_words).collect()
    words = [bytes(r["token"]) for r in head]
    head_counts = np.array([r["c"] for r in head], np.float64)
    known = min(model_words, len(words))
    rest = total - head_counts[:known].sum()
    model = GatedModel(np.append(head_counts[:known], rest), classes=max(CLASSES, isqrt(known)))
    rest_log = np.log10(rest + distinct - known + 1)
    numbers = {w: i for i, w in enumerate(words)}
    # only rarer words than the head's last can be missing from it
    least = int(head_counts[-1]) if len(words) == head_words else 0
    shared = spark.sparkContext.broadcast((numbers, np.log10(head_counts + 1)))

    fields = (
        "doc_id long, held_out boolean, part long, n_tokens long, n_known long, base double, outside double, ids binary, "
        "rare array<struct<token: binary, tf: long>>"
    )
    schema = spark.createDataFrame([], fields).schema

    def number(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        numbers, logs = shared.value
        logs = np.append(logs, 0.0)
        missing = len(logs) - 1
        out = Emitter(to_arrow_schema(schema), rows=2048)
        for doc_id, is_held_out, part, text in rows_of(batches, "doc_id", "held_out", "part", "text"):
            tokens = tokens_of(text)
            ids = numbered(tokens, numbers, missing)
            rare = Counter([tokens[i] for i in np.flatnonzero(ids == missing).tolist()])
            of_words, outside = logs[ids], ids >= known
            out.add(
                doc_id, is_held_out, part, len(tokens), int(np.count_nonzero(ids != missing)), float(of_words.sum()),
                float(of_words[outside].sum() - outside.sum() * rest_log), np.minimum(ids, known).astype("<u4").tobytes(),
                [{"token": w, "tf": n} for w, n in rare.items()], weight=4 * len(tokens) + 32 * len(rare),
            )
            if out.full:
                yield out.take()
        yield out.take()

    coded = texts.withColumn("part", round_of(rounds)).mapInArrow(number, schema).withColumn("_row", F.monotonically_increasing_id())
    stored = stage(spark, coded, "numbered_texts")
    learn_from(stored.where(~F.col("held_out")), model, total, rounds)
    taught = spark.sparkContext.broadcast(model)
    asked = ["_row", "doc_id", "held_out", "n_tokens", "n_known", "base", "outside"]
    fields = "_row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double"
    results = spark.createDataFrame([], fields).schema

    def score(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        out, rows, coded, weight = Emitter(to_arrow_schema(results)), [], [], 0

        def flush():
            for row, value in zip(rows, taught.value.log10_of(coded).tolist(), strict=True):
                out.add(*row[:-1], value + row[-1])
            rows.clear()
            coded.clear()
            return out.take()

        for *row, ids in rows_of(batches, *asked, "ids"):
            rows.append(row)
            coded.append(np.frombuffer(ids, "<u4"))
            weight += row[3]
            if len(rows) >= 16 * LANES or weight > 4_000_000:
                yield flush()
                weight = 0
        yield flush()

    parts = stage(spark, stored.select(*asked, "ids").mapInArrow(score, results), "scored_texts")
    rare = stored.select("_row", F.explode("rare").alias("r")).select("_row", "r.token", "r.tf")
    rarer = counts.where(F.col("c") <= least) if least else counts.where(F.lit(False))
    found = rare.join(rarer, "token").groupBy("_row").agg(
        F.sum(F.col("tf") * F.log10(F.col("c") + 1)).alias("_logs"), F.sum("tf").alias("_known")
    )
    base = F.col("base") + F.coalesce("_logs", F.lit(0.0)) - F.col("n_tokens") * float(np.log10(total + distinct + 1))
    return parts.join(found, "_row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("_known", F.lit(0))).alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"), base.alias("base_score"),
        (F.col("score") + F.coalesce("_logs", F.lit(0.0))).alias("score"),
    )
