"""Language identification by cross-parsing.

Labelled text of each language is turned into a suffix automaton. A document is
parsed against it from left to right into the longest pieces that occur somewhere
in the labelled text; the language that needs the fewest pieces, each weighed by
the bits to point into its text, wins. A letter that a language's text lacks is a
piece of its own, and is spelt out. Automata are dense tables with the restart
after a piece built in, so that many documents step through them together; the
few longest of a batch go on alone.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from areapulse.llm.common import fold, give_back, hold_one

SAMPLE_DOCS = 24
UNKNOWN = "und"
FOLDS, HELD_OUT = 4, 2
_OTHER, _GAP = 0, 1
_SCALAR_LANES = 48
_SPACE = ord(" ")
#: To spell one of all code points.
_LETTER_BITS = np.log2(0x110000)
#: Documents that a task parses together.
SLICE_ROWS = 1500
#: Transitions are a dense table up to so many cells, and sorted keys beyond.
DENSE_CELLS = 1 << 25


def points_of(text: str) -> np.ndarray:
    """Code points of the letters in lower case, runs of other characters between them as one space."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    gap = _gaps()[points]
    keep = ~gap
    keep[:-1] |= gap[:-1] & ~gap[1:]
    keep[: int(np.argmax(~gap)) if not gap.all() else len(gap)] = False
    return np.where(gap, np.uint32(_SPACE), points)[keep]


@lru_cache(maxsize=1)
def _gaps() -> np.ndarray:
    return np.fromiter((not chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


class Alphabet:
    """Numbers for the letters of a language's text; a letter that it lacks is 0, a run of other characters 1."""

    def __init__(self, points: np.ndarray):
        letters = np.setdiff1d(points, [_SPACE])
        self.size = len(letters) + 2
        self.table = np.zeros(0x110000, np.uint16 if self.size <= 1 << 16 else np.uint32)
        self.table[_SPACE] = _GAP
        self.table[letters] = np.arange(2, self.size)

    def codes(self, points: np.ndarray) -> np.ndarray:
        return self.table[points]


def suffix_automaton(codes: list[int]) -> list[dict[int, int]]:
    """Transitions of the smallest automaton that reads exactly the substrings of ``codes``; state 0 is the start."""
    steps, link, length = [{}], [-1], [0]
    last = 0
    for c in codes:
        new, at = len(steps), last
        steps.append({})
        link.append(0)
        length.append(length[last] + 1)
        while at >= 0 and c not in steps[at]:
            steps[at][c] = new
            at = link[at]
        if at >= 0:
            to = steps[at][c]
            if length[to] == length[at] + 1:
                link[new] = to
            else:
                copy = len(steps)
                steps.append(dict(steps[to]))
                link.append(link[to])
                length.append(length[at] + 1)
                while at >= 0 and steps[at].get(c) == to:
                    steps[at][c] = copy
                    at = link[at]
                link[to] = link[new] = copy
        last = new
    return steps


class Steps:
    """For a state's offset (state * size) and a symbol: four times the next offset, plus the pieces that end before or with the symbol."""

    def __init__(self, codes: np.ndarray, size: int, dense_cells: int = DENSE_CELLS):
        steps = suffix_automaton(codes.tolist())
        start = np.full(size, -1, np.int64)
        start[list(steps[0])] = list(steps[0].values())
        #: Without a transition, the piece ends and the next one starts; a symbol that the text lacks is a piece of its own.
        self.restart = np.where(start >= 0, start * size * 4 + 1, 2)
        self.keys = self.table = None
        if len(steps) * size <= dense_cells:
            table = np.tile(self.restart, (len(steps), 1))
            table[0] = np.where(start >= 0, start * size * 4, 1)
            for state, step in enumerate(steps):
                table[state, list(step)] = np.array(list(step.values()), np.int64) * size * 4
            self.table = table.astype(np.int32 if table.max() < 2**31 else np.int64).ravel()
            self.scalar = memoryview(self.table)
        else:
            counts = [len(step) for step in steps]
            state = np.repeat(np.arange(len(steps)), counts) * size
            keys = state + np.fromiter((c for step in steps for c in step), np.int64, sum(counts))
            order = np.argsort(keys)
            self.keys = keys[order]
            self.to = np.fromiter((n for step in steps for n in step.values()), np.int64, sum(counts))[order] * size * 4

    def of(self, offsets: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        if self.table is not None:
            return self.table[offsets + symbols]
        wanted = offsets + symbols
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.to[at], np.where(offsets == 0, 1, self.restart[symbols]))

    def one(self, offset: int, symbol: int) -> int:
        if self.table is not None:
            return self.scalar[offset + symbol]
        return int(self.of(np.array([offset]), np.array([symbol]))[0])


class CrossParser:
    """The learned languages; ``references`` maps a language to its labelled text, which has an alphabet of its own."""

    def __init__(self, references: tuple[tuple[str, str], ...], dense_cells: int = DENSE_CELLS):
        pointed = [(name, points_of(text)) for name, text in references]
        pointed = [(name, points) for name, points in pointed if len(points)]
        self.names = [name for name, _ in pointed]
        self.bits = np.array([np.log2(len(points) + 1) for _, points in pointed])
        self.alphabets = [Alphabet(points) for _, points in pointed]
        self.steps = [Steps(a.codes(points), a.size, dense_cells) for a, (_, points) in zip(self.alphabets, pointed, strict=True)]

    def pieces(self, texts: list[np.ndarray]) -> np.ndarray:
        """Pieces that each language needs for each text (code points), as languages x texts."""
        sizes = np.array([len(t) for t in texts], np.int64)
        order = np.argsort(-sizes, kind="stable")
        points = np.concatenate([texts[i] for i in order]) if len(texts) else np.empty(0, np.uint32)
        sizes = sizes[order]
        offsets = np.cumsum(sizes) - sizes
        out = np.empty((len(self.steps), len(texts)), np.int64)
        for row, (steps, alphabet) in enumerate(zip(self.steps, self.alphabets, strict=True)):
            flat = alphabet.codes(points)
            state, count = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
            step, lanes = 0, int(np.count_nonzero(sizes > 0))
            while lanes >= _SCALAR_LANES:
                until = int(sizes[lanes - 1])
                at, now, pieces = offsets[:lanes] + step, state[:lanes], count[:lanes]
                for _ in range(until - step):
                    found = steps.of(now, flat[at])
                    pieces += found & 3
                    now = found >> 2
                    at += 1
                state[:lanes] = now
                step = until
                lanes = int(np.count_nonzero(sizes > step))
            one = steps.one
            for lane in range(lanes):
                now, pieces = int(state[lane]), 0
                for c in flat[offsets[lane] + step : offsets[lane] + sizes[lane]].tolist():
                    found = one(now, c)
                    pieces += found & 3
                    now = found >> 2
                state[lane] = now
                count[lane] += pieces
            out[row, order] = count + (state > 0)
        return out

    def costs(self, texts: list[np.ndarray]) -> np.ndarray:
        """Bits that each language needs for each text: to point into its own text for a piece, to spell a letter that it lacks."""
        ends = np.cumsum([len(t) for t in texts])
        whole = np.concatenate(texts) if len(texts) else np.empty(0, np.uint32)
        out = self.pieces(texts).astype(np.float64)
        for row, alphabet in enumerate(self.alphabets):
            lacking = np.append(0, np.cumsum(alphabet.codes(whole) == _OTHER))
            spelt = lacking[ends] - lacking[np.append(0, ends[:-1])]
            out[row] = (out[row] - spelt) * self.bits[row] + spelt * _LETTER_BITS
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """The language of each text and its share of likelihood; ``und`` and 0 for texts without a letter."""
        known = [i for i, t in enumerate(texts) if t and self.names and any(map(str.isalpha, t))]
        names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        if known:
            cost = self.costs([points_of(texts[i]) for i in known])
            best = np.argmin(cost, axis=0)
            share = 1 / np.exp2(np.maximum(cost.min(axis=0) - cost, -1000)).sum(axis=0)
            for i, b, s in zip(known, best.tolist(), share.tolist(), strict=True):
                names[i], scores[i] = self.names[b], s
        return names, scores


def cross_parser(references: tuple[tuple[str, str], ...]) -> CrossParser:
    """Built once per Python worker from the labelled text."""
    return hold_one(("languages", references), lambda: CrossParser(references))


def learn(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> tuple[tuple[str, str], ...]:
    """Labelled text per language, from documents outside the held-out fold.

    The sample is bounded by its parameter: so many documents of each language, in
    the order of a hash of their ids, each with its whole text. Languages in
    ascending order, so that a tie goes to the first. Without labelled rows there
    are none, and all texts are ``und``.
    """
    learned = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).where(
        F.coalesce(fold("doc_id", FOLDS) != HELD_OUT, F.lit(True))
    )
    picked = learned.select("lang", F.xxhash64("doc_id").alias("_key"), "text")
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("_key", "text"))
    rows = picked.withColumn("_nth", nth).where(F.col("_nth") <= sample_docs).select("lang", "_nth", "text").collect()
    texts: dict[str, list[tuple[int, str]]] = {}
    for row in rows:
        texts.setdefault(row["lang"], []).append((row["_nth"], row["text"]))
    return tuple((lang, "\n".join(t for _, t in sorted(texts[lang]))) for lang in sorted(texts))


def identify(docs: DataFrame, references: tuple[tuple[str, str], ...], keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns of every row with ``lang_pred`` and ``score``, which replace columns of these names; only the text is used for them."""
    keep = tuple(c for c in keep if c not in ("lang_pred", "score"))
    kept = docs.select(*[F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(keep)], "text")
    schema = kept.drop("text").withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0)}).schema

    def predict(batches):
        parser = cross_parser(references)
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                names, scores = parser.predict(part.column("text").to_pylist())
                columns = [*(part.column(i) for i in range(len(keep))), pa.array(names, pa.string()), pa.array(scores, pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)
        give_back()

    return kept.mapInArrow(predict, schema).withColumnsRenamed({f"_k{i}": c for i, c in enumerate(keep)})


def predictions(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred``, ``score`` of every row; an empty table gives no rows."""
    named = identify(docs, learn(docs))
    held_out = F.coalesce(fold("doc_id", FOLDS) == HELD_OUT, F.lit(False))
    return named.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
