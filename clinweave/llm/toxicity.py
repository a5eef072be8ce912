"""Toxicity of texts written to evade word filters.

A noisy channel turns a word into what is read: letters become look-alike digits and signs, are spread out by separators,
or are repeated. Suspicious spans are decoded by Viterbi over the lattice of letters each character may stand for, under
a character model of order four whose counts come from all documents. The restored text is scored by a logistic model over its
words and word beginnings.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from clinweave.llm.shared import written
from clinweave.llm.vocab import Remembered
from clinweave.llm.words import pieces, text_bytes
from clinweave.session import ship_package

#: Labelled rows that the model is fitted on at most, the ones with the least hash of doc_id.
MAX_LABELLED = 30_000
#: Features that enter the logistic model at most: those whose share among toxic rows stands out most.
MAX_FEATURES = 4_000
#: Letters of a word's beginning that make a feature of their own.
STEM = 5

#: What a sign may stand for besides itself.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "(": "c",
}

_LETTERS = "abcdefghijklmnopqrstuvwxyz"
_SIZE = 28  # 0: no letter, 1-26: a-z, 27: any other letter
_CODE = {c: k + 1 for k, c in enumerate(_LETTERS)}
_BYTE = np.zeros(256, np.int32)
for _c, _k in _CODE.items():
    _BYTE[ord(_c)] = _BYTE[ord(_c.upper())] = _k
_BYTE[0xC3:0xF5] = 27
_BYTE[0x80:0xC0] = 255

#: Costs of the channel in nats: a look-alike read as a letter, a sign kept within a word, a letter written again.
LOOKALIKE_COST, SIGN_COST, REPEAT_COST = 0.7, 7.0, 0.7


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(_SIZE**4, np.int64)
    for piece in pieces(batches):
        data, offsets = text_bytes(piece.column("text"))
        codes = _BYTE[np.insert(data, offsets, 0x20)]
        codes = codes[codes != 255]
        if len(codes) > 3:
            grams = ((codes[:-3] * _SIZE + codes[1:-2]) * _SIZE + codes[2:-1]) * _SIZE + codes[3:]
            total += np.bincount(grams, minlength=_SIZE**4)
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["gram", "n"])


def character_model(docs: DataFrame) -> np.ndarray:
    """Log probability of a letter after three others, from the runs of four in all texts (28 ** 4 numbers)."""
    counts = np.zeros(_SIZE**4)
    grams = docs.select("text").mapInArrow(_count_grams, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    counts[grams.column("gram").to_numpy()] = grams.column("n").to_numpy()
    four = counts.reshape(_SIZE, _SIZE, _SIZE, _SIZE)
    three = four.sum(axis=0)
    two = three.sum(axis=0)
    one = (two.sum(axis=0) + 1) / (two.sum() + _SIZE)
    after_one = (two + 20 * one) / (two.sum(axis=1, keepdims=True) + 20)
    after_two = (three + 5 * after_one) / (three.sum(axis=2, keepdims=True) + 5)
    return np.log((four + 5 * after_two) / (four.sum(axis=3, keepdims=True) + 5))


@lru_cache(maxsize=4096)
def _choices(sign: str) -> tuple[tuple[str, int, float], ...]:
    """Letters a character may stand for: (letter, code, cost)."""
    if sign in _CODE:
        return ((sign, _CODE[sign], 0.0),)
    if sign.isalpha():
        return ((sign, 27, 0.0),)
    stand = tuple((c, _CODE[c], LOOKALIKE_COST) for c in LOOKALIKES.get(sign, ""))
    return (*stand, (sign, 0, SIGN_COST))


def decode(word: str, model: np.ndarray, separator: str = "") -> str:
    """The likeliest words behind `word` (lower case).

    States are the last three letters written; a character may also be a repetition of the last letter, which writes
    none. A separator may stand for nothing or for the end of a word; what the model makes of it decides.
    """
    # (last character, last three codes) -> (cost, path as linked list)
    states = {("", 0, 0, 0): (0.0, None)}
    for sign in word:
        apart = sign == separator
        after: dict[tuple, tuple] = dict(states) if apart else {}
        choices = (("", 0, 0.0),) if apart else _choices(sign)
        for (last, one, two, three), (cost, path) in states.items():
            for letter, code, price in choices:
                total = cost + price - model[one, two, three, code]
                key = (letter, two, three, code)
                if key not in after or total < after[key][0]:
                    after[key] = (total, (path, letter or " "))
                if letter == last and code:
                    total = cost + price + REPEAT_COST
                    key = (last, one, two, three)
                    if key not in after or total < after[key][0]:
                        after[key] = (total, path)
        states = after
    ends = ((cost - model[one, two, three, 0], path) for (_, one, two, three), (cost, path) in states.items())
    path = min(ends, key=lambda x: x[0])[1]
    letters = []
    while path:
        path, letter = path
        letters.append(letter)
    return "".join(reversed(letters))


_SIGNS = re.escape("".join(LOOKALIKES))
#: Signs inside or at the end of a word, a letter three times, single letters spread by equal separators.
_SIGN = re.compile(rf"[^\W\d_][{_SIGNS}]+[^\W\d_]|(?<![\w{_SIGNS}])[{_SIGNS}][^\W\d_]{{2}}|[^\W\d_]{{2}}[@$|+€0-9](?![\w{_SIGNS}])")
_AGAIN = re.compile(r"([^\W\d_])\1\1")
_SPREAD = re.compile(r"(?<![^\W_])[^\W_](?:([ .\-_*·])[^\W_])(?:\1[^\W_])+(?![^\W_])")
_TOKEN = re.compile(rf"[\w{_SIGNS}]+")
_WORDS = re.compile(r"[^\W\d_]+")


class Restorer:
    """Restores texts; remembers decoded spans."""

    def __init__(self, model: np.ndarray):
        self.known = Remembered(lambda word: decode(word, model), 200_000)
        self.spans = Remembered(lambda span: decode(span, model, span[1]), 200_000)

    def _token(self, match: re.Match) -> str:
        token = match.group().rstrip("!")
        marks = match.group()[len(token) :]
        return (self.known[token] if _AGAIN.search(token) or _SIGN.search(token) else token) + marks

    def _spread(self, match: re.Match) -> str:
        return self.spans[match.group()]

    def restore(self, text: str) -> str:
        """Lower-case text with suspicious spans replaced by what they stand for."""
        text = text.lower()
        if _SPREAD.search(text):
            text = _SPREAD.sub(self._spread, text)
        if _SIGN.search(text) or _AGAIN.search(text):
            text = _TOKEN.sub(self._token, text)
        return text


def features(restored: str) -> set[str]:
    """Words of a restored text, and their beginnings marked by a trailing `*`."""
    words = set(_WORDS.findall(restored))
    return words | {word[:STEM] + "*" for word in words if len(word) >= STEM}


@dataclass
class ToxicModel:
    """Character model, feature weights and intercept: what scoring needs."""

    characters: np.ndarray
    weights: dict[str, float]
    intercept: float

    def score(self, found: set[str]) -> float:
        weights = self.weights
        total = self.intercept + sum(weights[f] for f in weights.keys() & found)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, total))))


def _all_features(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(model.value)
        for piece in pieces(batches):
            found = [sorted(features(restorer.restore(text or ""))) for text in piece.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), piece.column("toxic"), pa.array(found, pa.list_(pa.string()))],
                ["doc_id", "toxic", "found"],
            )

    return run


def _logistic(rows: np.ndarray, columns: np.ndarray, shape: tuple[int, int], labels: np.ndarray, penalty: float, rounds: int):
    """Weights and intercept of a ridge logistic regression on a 0/1 matrix given by its ones, by accelerated gradients."""
    weights, intercept = np.zeros(shape[1]), 0.0
    ahead, ahead_b, momentum = weights, intercept, 1.0
    per_row = np.bincount(rows, minlength=shape[0])
    step = 4.0 / (1 + float(per_row.max(initial=0)))
    for _ in range(rounds):
        total = np.bincount(rows, ahead[columns], minlength=shape[0]) + ahead_b
        error = (1 / (1 + np.exp(-np.clip(total, -30, 30))) - labels) / shape[0]
        slope = np.bincount(columns, error[rows], minlength=shape[1]) + penalty * ahead / shape[0]
        new, new_b = ahead - step * slope, ahead_b - step * error.sum()
        grown = (1 + math.sqrt(1 + 4 * momentum**2)) / 2
        ahead = new + (momentum - 1) / grown * (new - weights)
        ahead_b = new_b + (momentum - 1) / grown * (new_b - intercept)
        weights, intercept, momentum = new, new_b, grown
    return weights, intercept


def fit(docs: DataFrame, labels: DataFrame, corpus: DataFrame | None = None) -> ToxicModel:
    """Fit on the rows of `docs` (doc_id, text) that `labels` (doc_id, toxic 0/1) marks.

    The character model is counted over all of `corpus` (default: `docs`). The word model is fitted on at most
    MAX_LABELLED labelled rows. Rows without doc_id or label are not used; of repeated labels of one id the largest
    counts. Without labels of both kinds, the model gives every text the share of toxic rows (a half without any).
    """
    spark = docs.sparkSession
    ship_package(spark)
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    characters = character_model(docs if corpus is None else corpus)
    labels = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    # bounded: MAX_LABELLED rows of 12 bytes
    chosen = labels.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_LABELLED)
    sample = docs.join(F.broadcast(chosen), "doc_id").select("doc_id", "toxic", "text")
    shared = spark.sparkContext.broadcast(characters)
    found = written(sample.mapInArrow(_all_features(shared), "doc_id bigint, toxic int, found array<string>"), "toxic-rows")
    size, positive = found.agg(F.count("*"), F.sum("toxic")).first()
    if not size or not positive or positive == size:
        share = ((positive or 0) + 1) / (size + 2)
        return ToxicModel(characters, {}, math.log(share / (1 - share)))
    base = positive / size
    counted = found.select("toxic", F.explode("found").alias("f")).groupBy("f").agg(F.count("*").alias("n"), F.sum("toxic").alias("t"))
    # standard deviations above the share of toxic rows; at most MAX_FEATURES rows reach the driver
    above = (F.col("t") - base * F.col("n")) / F.sqrt(F.col("n") * base * (1 - base))
    picked = counted.where("t >= 3").withColumn("z", above).where("z > 3").orderBy(F.desc("z"), "f").limit(MAX_FEATURES)
    names = [row["f"] for row in picked.collect()]
    place = {name: k for k, name in enumerate(names)}
    marked = spark.createDataFrame([(n, k) for n, k in place.items()], "f string, k int") if names else None
    # one number per labelled row and feature hit, as arrays: 12 bytes each, bounded by the sample
    rows = found.select("doc_id", "toxic").distinct().toArrow()
    ids, truth = (rows.column(c).to_numpy() for c in ("doc_id", "toxic"))
    order = np.argsort(ids)
    if names:
        hits = found.select("doc_id", F.explode("found").alias("f")).join(F.broadcast(marked), "f").select("doc_id", "k").toArrow()
        at = order[np.searchsorted(ids, hits.column("doc_id").to_numpy(), sorter=order)]
        columns = hits.column("k").to_numpy().astype(np.int64)
        pairs = np.unique(at * len(names) + columns)
        at, columns = pairs // len(names), pairs % len(names)
    else:
        at = columns = np.zeros(0, np.int64)
    weights, intercept = _logistic(at, columns, (len(ids), len(names)), truth.astype(float), penalty=1.0, rounds=600)
    return ToxicModel(characters, {n: float(w) for n, w in zip(names, weights, strict=True) if abs(w) > 1e-3}, float(intercept))


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: ToxicModel = shared.value
        restorer = Restorer(model.characters)
        stems = {f for f in model.weights if f.endswith("*")}
        plain = model.weights.keys() - stems
        stems = {f[:-1] for f in stems}
        for piece in pieces(batches):
            scores = []
            for text in piece.column("text").to_pylist():
                words = set(_WORDS.findall(restorer.restore(text or "")))
                found = plain & words
                found |= {s + "*" for s in stems & {w[:STEM] for w in words if len(w) >= STEM}}
                scores.append(model.score(found))
            yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(scores, pa.float64())], [*piece.schema.names, "score"])

    return run


def toxicity(docs: DataFrame, model: ToxicModel) -> DataFrame:
    """`docs` (with a column text) and score (0 to 1) and predicted (score >= 0.5), which replace columns of that name.

    Null and empty texts get the score of a text without any feature. Rows are scored one by one, so repeated rows and
    null ids are scored like others; no other column than the text enters the score.
    """
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 28 ** 4 numbers and MAX_FEATURES weights at most
    docs = docs.drop("score", "predicted").withColumn("text", F.col("text").cast("string"))
    scored = docs.mapInArrow(_score(shared), StructType([*docs.schema.fields, StructField("score", DoubleType())]))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
