"""Language identification by a byte convolutional network.

Texts are read as bytes, A-Z lower-cased, in windows of fixed length that cover the whole text.
Filters of several widths run over the one-hot bytes of a window, their maxima over the window feed
a softmax, and the log probabilities of the windows add up, weighted by their bytes, to the
prediction of the text. Training and prediction are numpy over batches of windows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqloom.llm import bytewords as bw
from seqloom.llm.common import ready_for_python

WINDOW = 256
WIDTHS, FILTERS = (2, 3, 4), 12
#: Labelled rows a model is fitted on (one of each language at least), windows and number of steps.
TRAINING_ROWS, WINDOWS_PER_STEP, STEPS, RATE = 2000, 128, 400, 0.02
#: A longer text of the sample gives as many pieces of its own, from places drawn by hash.
SAMPLE_CHARS, PIECE_CHARS = 1 << 16, 1 << 10
#: Steps go on until every language was drawn as often.
LEAST_DRAWS = 40
WINDOWS_AT_ONCE = 1024
UNDETERMINED = "und"

_f = np.float32


@dataclass
class Model:
    languages: list[str]
    weights: dict[str, np.ndarray]


def cut_windows(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(windows of bytes, their true lengths, their rows); the last of a text is filled with zeros.

    An empty text has no window.
    """
    sizes = np.diff(bounds)
    per_row = -(-sizes // WINDOW)
    rows = np.repeat(np.arange(len(sizes)), per_row)
    nth = np.arange(len(rows)) - np.repeat(np.cumsum(per_row) - per_row, per_row)
    starts = bounds[:-1][rows] + nth * WINDOW
    lengths = np.minimum(WINDOW, bounds[1:][rows] - starts)
    at = starts[:, None] + np.arange(WINDOW)
    windows = np.where(np.arange(WINDOW) < lengths[:, None], bw.LOWER[raw[np.minimum(at, max(len(raw) - 1, 0))]], 0)
    return windows.astype(np.uint8), lengths, rows


def forward(weights: dict[str, np.ndarray], windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log probabilities, pooled features and the place of each maximum."""
    pooled, places = [], []
    for width in WIDTHS:
        span = WINDOW - width + 1
        taken = np.zeros((len(windows), span, FILTERS), _f)
        for k in range(width):
            taken += weights[f"f{width}"][k][windows[:, k : k + span]]
        place = taken.argmax(1)
        pooled.append(np.take_along_axis(taken, place[:, None], 1)[:, 0])
        places.append(place)
    features = np.maximum(np.concatenate(pooled, 1) + weights["fb"], 0)
    logits = features @ weights["w"] + weights["b"]
    logits -= logits.max(1, keepdims=True)
    return logits - np.log(np.exp(logits).sum(1, keepdims=True)), features, np.concatenate(places, 1)


def fit(texts: list[str], langs: list[str], seed: int = 5) -> Model:
    """Fit on labelled texts; with one language or none the model predicts that one, or nothing."""
    languages = sorted(set(langs))
    rng = np.random.default_rng(seed)
    size = FILTERS * len(WIDTHS)
    weights = {f"f{w}": (rng.standard_normal((w, 256, FILTERS)) * 0.3).astype(_f) for w in WIDTHS}
    weights |= {"fb": np.zeros(size, _f), "w": (rng.standard_normal((size, max(1, len(languages)))) * 0.3).astype(_f)}
    weights["b"] = np.zeros(max(1, len(languages)), _f)
    made = [cut_windows(raw, bounds) + (first,) for first, raw, bounds in bw.blocks(pa.array(texts, pa.large_string()))]
    windows = np.concatenate([m[0] for m in made]) if made else np.zeros((0, WINDOW), np.uint8)
    rows = np.concatenate([m[2] + m[3] for m in made]) if made else np.zeros(0, int)
    number = {x: k for k, x in enumerate(languages)}
    label = np.array([number[x] for x in langs], int)[rows] if len(rows) else rows
    if len(languages) < 2 or not len(windows):
        return Model(languages, weights)
    # every language alike: windows are drawn per language
    members = [np.flatnonzero(label == k) for k in range(len(languages))]
    members = [m for m in members if len(m)]
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in weights.items()}
    steps, turns = max(STEPS, -(-LEAST_DRAWS * len(members) // WINDOWS_PER_STEP)), np.zeros(0, int)
    for step in range(1, steps + 1):
        drawn = members
        if len(members) > WINDOWS_PER_STEP:  # more than a step has windows: they take turns
            if len(turns) < WINDOWS_PER_STEP:
                turns = np.concatenate((turns, rng.permutation(len(members))))
            drawn, turns = [members[k] for k in turns[:WINDOWS_PER_STEP]], turns[WINDOWS_PER_STEP:]
        chosen = np.concatenate([rng.choice(m, WINDOWS_PER_STEP // len(drawn)) for m in drawn])
        batch, target = windows[chosen], label[chosen]
        log_p, features, places = forward(weights, batch)
        dlogits = np.exp(log_p)
        dlogits[np.arange(len(target)), target] -= 1
        dlogits /= len(target)
        grads = {"w": features.T @ dlogits, "b": dlogits.sum(0)}
        dfeatures = (dlogits @ weights["w"].T) * (features > 0)
        grads["fb"] = dfeatures.sum(0)
        for i, width in enumerate(WIDTHS):
            own = slice(i * FILTERS, (i + 1) * FILTERS)
            g = np.zeros_like(weights[f"f{width}"])
            for k in range(width):
                byte = np.take_along_axis(batch, places[:, own] + k, 1)
                np.add.at(g[k], (byte, np.arange(FILTERS)), dfeatures[:, own])
            grads[f"f{width}"] = g
        rate = RATE * (1 - 0.9 * step / steps)
        for k, g in grads.items():
            m, v = moments[k]
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            weights[k] -= (rate / (1 - 0.9**step)) * m / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Model(languages, weights)


def predict(model: Model, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Index of the language of each text and its probability; all windows count."""
    found, sure = np.zeros(len(column), int), np.zeros(len(column))
    for first, raw, bounds in bw.blocks(column):
        windows, lengths, rows = cut_windows(raw, bounds)
        total = np.zeros((len(bounds) - 1, max(1, len(model.languages))))
        for c in range(0, len(windows), WINDOWS_AT_ONCE):
            part = slice(c, c + WINDOWS_AT_ONCE)
            np.add.at(total, rows[part], forward(model.weights, windows[part])[0] * lengths[part, None])
        mean = total / np.maximum(np.diff(bounds), 1)[:, None]
        p = np.exp(mean - mean.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        found[first : first + len(p)] = p.argmax(1)
        sure[first : first + len(p)] = p.max(1)
    return found, sure


def training_rows(docs: DataFrame, usable: Column, most: int = TRAINING_ROWS) -> tuple[list[str], list[str]]:
    """A sample of labelled texts, alike for every language, in the order of a hash of id and text.

    Every language has ``most`` divided by their number, and one row at least. The hash is uniform,
    so rows above a bound that follows from the number of rows are left out where they lie; the
    bound leaves six deviations too many, and only the few rows below it are put in order. A long
    text gives pieces from all over it, ``SAMPLE_CHARS`` characters at most.
    """
    spark = docs.sparkSession
    labelled = docs.filter(F.col("lang").isNotNull() & (F.col("text") != "") & usable).select("doc_id", "text", "lang")
    counts = {r.lang: r.n for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return [], []
    each = max(1, most // len(counts))
    enough = each + 6 * each**0.5 + 20
    # a table of known size, one row per label of the model, which Spark broadcasts by that size
    bounds = spark.createDataFrame(pa.table({"lang": list(counts), "below": [enough / n for n in counts.values()]}))
    drawn = labelled.withColumn("hash", F.xxhash64("doc_id", "text")).join(bounds, "lang")
    few = drawn.filter(F.col("hash") / 2.0**64 + 0.5 < F.col("below"))
    begin = lambda k: F.pmod(F.xxhash64("hash", k), F.length("text") - PIECE_CHARS) + 1
    pieces = F.transform(F.sequence(F.lit(1), F.lit(SAMPLE_CHARS // PIECE_CHARS)), lambda k: F.substring("text", begin(k), PIECE_CHARS))
    text = F.when(F.length("text") > SAMPLE_CHARS, F.array_join(pieces, " ")).otherwise(F.col("text"))
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("hash", "doc_id", "text"))
    found = few.withColumn("nth", nth).filter(F.col("nth") <= each).select(text.alias("text"), "lang").collect()
    rows = sorted((r.lang, r.text) for r in found)
    return [t for _, t in rows], [x for x, _ in rows]


def identify(docs: DataFrame, model: Model, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns ``keep`` of every row with ``lang_pred`` and ``_score``.

    Null texts and those without any letter are ``und`` with score 0, as is every text if nothing
    was learned. The whole text counts. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    ready_for_python(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*shared.value.languages, UNDETERMINED], object)
        for batch in batches:
            found, sure = predict(shared.value, batch.column(0))
            lettered = batch.column(1).to_numpy(zero_copy_only=False).astype(bool) & (len(names) > 1)
            found, sure = np.where(lettered, found, len(names) - 1), np.where(lettered, sure, 0.0)
            columns = [*batch.columns[2:], pa.array(names[found].tolist(), pa.string()), pa.array(sure)]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[2:], "lang_pred", "_score"])

    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    lettered = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))
    return docs.select(F.col(text_col).alias("_text"), lettered.alias("_lettered"), *keep).mapInArrow(run, f"{fields}, lang_pred string, _score double")
