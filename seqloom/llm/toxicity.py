"""Toxicity scores of whole texts: a bidirectional gated recurrent network with attention pooling.

A word enters as a learned vector of its hash and the mean of learned vectors of its hashed
character triples. Texts are read as windows of ``WINDOW`` words, each half over the next; two gated recurrent
layers run over a window in both directions, attention pools their states, and a logistic unit
scores the window. The score of a text is that of its highest window. Training and scoring are
numpy, a batch of windows at a time, without a Python step per word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqloom.llm import bytewords as bw
from seqloom.llm.common import ready_for_python

WINDOW, STRIDE = 48, 24
WORD_SLOTS, TRIPLE_SLOTS = 1 << 16, 1 << 12
WORD_DIM, CHAR_DIM, STATE = 12, 4, 8
#: Bound of the labelled rows a model is fitted on, half of them toxic where there are as many.
TRAINING_ROWS = 3000
EPOCHS, LEAST_STEPS, BATCH_TEXTS, RATE = 5, 240, 48, 0.02
WINDOWS_AT_ONCE = 2048

_U = np.uint64
_f = np.float32


@dataclass
class Model:
    """Weights by name; ``shift`` corrects the logit for the share of toxic rows in the training set."""

    weights: dict[str, np.ndarray]
    shift: float = 0.0
    seen: int = field(default=0)


def featurise(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of texts: (first row, word slots, character triples' slots, first triple per word, first word per row)."""
    for first, raw, bounds in bw.blocks(column):
        starts, ends, hashes, firsts = bw.words(raw, bounds, bw.LETTER)
        low = bw.LOWER[raw].astype(np.uint32)
        pad = np.concatenate((np.zeros(1, np.uint32), low, np.zeros(1, np.uint32)))
        letter = np.concatenate(([False], bw.LETTER[raw], [False]))
        pad[~letter] = 0
        before, after = pad[:-2].copy(), pad[2:].copy()
        edge = bounds[(bounds > 0) & (bounds < len(raw))]  # texts lie side by side
        before[edge], after[edge - 1] = 0, 0
        triple = (before * np.uint32(65599) + pad[1:-1]) * np.uint32(65599) + after
        triple = ((triple * np.uint32(2654435761)) >> np.uint32(20)).astype(np.int32)
        inside = triple[letter[1:-1]]
        lengths = ends - starts
        yield first, (hashes >> _U(48)).astype(np.int32), inside, np.concatenate(([0], np.cumsum(lengths))), firsts


def word_vectors(weights: dict[str, np.ndarray], words: np.ndarray, triples: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Inputs of the recurrent layers, one row per word."""
    out = np.empty((len(words), WORD_DIM + CHAR_DIM), _f)
    out[:, :WORD_DIM] = weights["word"][words]
    if len(words):
        sums = np.add.reduceat(weights["char"][triples], at[:-1], axis=0)
        out[:, WORD_DIM:] = sums / np.diff(at)[:, None]
    return out


def windows_of(firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, number of words and row of every window; the windows of a row cover all its words.

    A row without words has one window of no words.
    """
    counts = np.diff(firsts)
    per_row = 1 + np.maximum(0, -(-(counts - WINDOW) // STRIDE))
    rows = np.repeat(np.arange(len(counts)), per_row)
    nth = np.arange(len(rows)) - np.repeat(np.cumsum(per_row) - per_row, per_row)
    starts = firsts[:-1][rows] + nth * STRIDE
    return starts, np.minimum(WINDOW, firsts[1:][rows] - starts), rows


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def forward(weights: dict[str, np.ndarray], x: np.ndarray, mask: np.ndarray, keep: bool = False):
    """Logits of windows ``x`` (windows, words, inputs); ``keep`` returns what training needs too."""
    n, length, _ = x.shape
    states, steps = np.zeros((n, length, 2 * STATE), _f), []
    for side in range(2):
        given = x @ weights[f"in{side}"] + weights[f"b{side}"]
        u = weights[f"u{side}"]
        h, trail = np.zeros((n, STATE), _f), []
        for t in range(length) if side == 0 else range(length - 1, -1, -1):
            g = given[:, t]
            gates = _sigmoid(g[:, : 2 * STATE] + h @ u[:, : 2 * STATE])
            z, r = gates[:, :STATE], gates[:, STATE:]
            inner = h @ u[:, 2 * STATE :]
            c = np.tanh(g[:, 2 * STATE :] + r * inner)
            new = h + mask[:, t, None] * z * (c - h)
            if keep:
                trail.append((t, h, z, r, inner, c))
            h = new
            states[:, t, side * STATE : (side + 1) * STATE] = h
        steps.append(trail)
    focus = np.tanh(states @ weights["aw"])
    e = focus @ weights["av"]
    e = np.where(mask > 0, e, _f(-1e4))
    e = np.exp(e - e.max(1, keepdims=True)) * mask
    a = e / np.maximum(e.sum(1, keepdims=True), _f(1e-9))
    pooled = (a[:, :, None] * states).sum(1)
    logit = pooled @ weights["ow"] + weights["ob"][0]
    return (logit, states, focus, a, pooled, steps) if keep else logit


def backward(weights: dict[str, np.ndarray], x: np.ndarray, mask: np.ndarray, kept, dlogit: np.ndarray):
    """Gradients of the weights of the layers, and of the inputs."""
    _, states, focus, a, pooled, steps = kept
    grads = {"ow": pooled.T @ dlogit, "ob": np.array([dlogit.sum()], _f)}
    dpooled = dlogit[:, None] * weights["ow"]
    da = (states * dpooled[:, None]).sum(2)
    de = a * (da - (a * da).sum(1, keepdims=True))
    grads["av"] = np.einsum("nt,ntk->k", de, focus)
    dfocus = de[:, :, None] * weights["av"] * (1 - focus * focus)
    grads["aw"] = np.einsum("nts,ntk->sk", states, dfocus)
    dstates = a[:, :, None] * dpooled[:, None] + dfocus @ weights["aw"].T
    dx = np.zeros_like(x)
    for side in range(2):
        u = weights[f"u{side}"]
        du, dgiven = np.zeros_like(u), np.zeros((*x.shape[:2], 3 * STATE), _f)
        dh = np.zeros((len(x), STATE), _f)
        for t, h, z, r, inner, c in reversed(steps[side]):
            dh = dh + dstates[:, t, side * STATE : (side + 1) * STATE]
            m = mask[:, t, None]
            dc = dh * m * z * (1 - c * c)
            dz = dh * m * (c - h) * z * (1 - z)
            dr = dc * inner * r * (1 - r)
            dgates = np.concatenate((dz, dr), 1)
            dinner = dc * r
            du[:, : 2 * STATE] += h.T @ dgates
            du[:, 2 * STATE :] += h.T @ dinner
            dgiven[:, t, : 2 * STATE], dgiven[:, t, 2 * STATE :] = dgates, dc
            dh = dh * (1 - m * z) + dgates @ u[:, : 2 * STATE].T + dinner @ u[:, 2 * STATE :].T
        grads[f"u{side}"], grads[f"b{side}"] = du, dgiven.sum((0, 1))
        grads[f"in{side}"] = np.einsum("nti,ntg->ig", x, dgiven)
        dx += dgiven @ weights[f"in{side}"].T
    return grads, dx


def gather(vectors: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of word vectors with their mask and the word number of each cell."""
    at = starts[:, None] + np.arange(max(1, int(counts.max(initial=1))))
    mask = (np.arange(at.shape[1]) < counts[:, None]).astype(_f)
    at = np.minimum(at, max(len(vectors) - 1, 0))
    x = vectors[at] * mask[:, :, None] if len(vectors) else np.zeros((*at.shape, WORD_DIM + CHAR_DIM), _f)
    return x, mask, at


def fresh_weights(rng: np.random.Generator) -> dict[str, np.ndarray]:
    size = WORD_DIM + CHAR_DIM
    shapes = {"word": (WORD_SLOTS, WORD_DIM), "char": (TRIPLE_SLOTS, CHAR_DIM), "aw": (2 * STATE, STATE), "av": (STATE,), "ow": (2 * STATE,)}
    for side in range(2):
        shapes |= {f"in{side}": (size, 3 * STATE), f"u{side}": (STATE, 3 * STATE)}
    made = {k: (rng.standard_normal(v) * (0.1 if k in ("word", "char") else 0.35)).astype(_f) for k, v in shapes.items()}
    return made | {"b0": np.zeros(3 * STATE, _f), "b1": np.zeros(3 * STATE, _f), "ob": np.zeros(1, _f)}


def telling_words(slots: np.ndarray, firsts: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Smoothed log odds of each word slot, from the texts of either label that hold it."""
    row = np.repeat(np.arange(len(toxic)), np.diff(firsts))
    pair = np.unique(row.astype(np.int64) * WORD_SLOTS + slots)
    held, label = pair % WORD_SLOTS, toxic[pair // WORD_SLOTS]
    with_toxic = np.bincount(held[label == 1], minlength=WORD_SLOTS) / max(1, toxic.sum())
    without = np.bincount(held[label == 0], minlength=WORD_SLOTS) / max(1, (1 - toxic).sum())
    floor = 4 / max(8, len(toxic))
    return np.log((with_toxic + floor) / (without + floor)).astype(_f)


def fit(texts: list[str], toxic: np.ndarray, share: float, seed: int = 1, epochs: int = EPOCHS) -> Model:
    """Fit on labelled texts; ``share`` is the share of toxic rows among all labelled ones.

    A text's logit is that of its highest window, which also takes the gradient. Without texts, or
    with one label only, the model knows the share alone.
    """
    rng = np.random.default_rng(seed)
    weights = fresh_weights(rng)
    prior = float(np.log((share + 1e-3) / (1 - share + 1e-3)))
    if len(set(toxic.tolist())) < 2:
        return Model({k: np.zeros_like(v) for k, v in weights.items()}, prior, len(texts))
    words, triples, ats, counts = [], [], [np.zeros(1, np.int64)], []
    for _, w, t, at, firsts in featurise(pa.array(texts, pa.large_string())):
        words.append(w)
        triples.append(t)
        ats.append(at[1:] + ats[-1][-1])
        counts.append(np.diff(firsts))
    words, triples, at = np.concatenate(words), np.concatenate(triples), np.concatenate(ats)
    firsts = np.concatenate(([0], np.cumsum(np.concatenate(counts))))
    weights["word"][:, 0] = np.clip(telling_words(words, firsts, toxic), -2, 3)
    starts, sizes, rows = windows_of(firsts)
    window_at = np.searchsorted(rows, np.arange(len(toxic) + 1))
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in weights.items()}
    per_epoch = -(-len(toxic) // BATCH_TEXTS)
    epochs = max(epochs, -(-LEAST_STEPS // per_epoch))
    step, total = 0, epochs * per_epoch
    for _ in range(epochs):
        order = rng.permutation(len(toxic))
        for b in range(0, len(order), BATCH_TEXTS):
            chosen = order[b : b + BATCH_TEXTS]
            vectors_of = lambda k: _some_vectors(weights, words, triples, at, starts[k], sizes[k])
            top = []
            own = np.concatenate([np.arange(window_at[i], window_at[i + 1]) for i in chosen])
            logits = np.concatenate([forward(weights, *vectors_of(own[c : c + WINDOWS_AT_ONCE])[:2]) for c in range(0, len(own), WINDOWS_AT_ONCE)])
            c = 0
            for i in chosen:
                n = window_at[i + 1] - window_at[i]
                top.append(own[c + int(np.argmax(logits[c : c + n]))])
                c += n
            x, mask, cells = vectors_of(np.array(top))
            kept = forward(weights, x, mask, keep=True)
            dlogit = ((_sigmoid(kept[0]) - toxic[chosen]) / len(chosen)).astype(_f)
            grads, dx = backward(weights, x, mask, kept, dlogit)
            dx *= mask[:, :, None]
            grads["word"], grads["char"] = _table_gradients(weights, words, triples, at, cells, mask, dx)
            step += 1
            rate = RATE * min(1, step / 10) * (1 - 0.9 * step / total)
            for k, g in grads.items():
                m, v = moments[k]
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                weights[k] -= (rate / (1 - 0.9**step)) * m / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    balance = float(toxic.mean())
    return Model(weights, prior - float(np.log(balance / (1 - balance))), len(texts))


def _some_vectors(weights, words, triples, at, starts, sizes):
    """Windows of words that are looked up on the spot."""
    cells = np.minimum(starts[:, None] + np.arange(max(1, int(sizes.max(initial=1)))), max(len(words) - 1, 0))
    mask = (np.arange(cells.shape[1]) < sizes[:, None]).astype(_f)
    used, back = np.unique(cells[mask > 0], return_inverse=True)
    x = np.zeros((*cells.shape, WORD_DIM + CHAR_DIM), _f)
    if len(used):
        lengths = at[used + 1] - at[used]
        ends = np.cumsum(lengths)
        own = np.arange(ends[-1]) - np.repeat(ends - lengths, lengths) + np.repeat(at[used], lengths)
        x[mask > 0] = word_vectors(weights, words[used], triples[own], np.concatenate(([0], ends)))[back]
    return x, mask, cells


def _table_gradients(weights, words, triples, at, cells, mask, dx):
    cell = cells[mask > 0]
    g = dx[mask > 0]
    word, char = np.zeros_like(weights["word"]), np.zeros_like(weights["char"])
    np.add.at(word, words[cell], g[:, :WORD_DIM])
    lengths = at[cell + 1] - at[cell]
    ends = np.cumsum(lengths)
    if len(cell):
        own = np.arange(ends[-1]) - np.repeat(ends - lengths, lengths) + np.repeat(at[cell], lengths)
        np.add.at(char, triples[own], np.repeat(g[:, WORD_DIM:] / lengths[:, None], lengths, axis=0))
    return word, char


def score_texts(model: Model, column: pa.Array) -> np.ndarray:
    """Probability that each text is toxic: the highest of its windows."""
    scores = np.zeros(len(column))
    for first, words, triples, at, firsts in featurise(column):
        vectors = word_vectors(model.weights, words, triples, at)
        starts, sizes, rows = windows_of(firsts)
        logits = np.empty(len(rows), _f)
        by_size = np.argsort(sizes, kind="stable")  # short windows together, so few cells are empty
        for c in range(0, len(rows), WINDOWS_AT_ONCE):
            some = by_size[c : c + WINDOWS_AT_ONCE]
            x, mask, _ = gather(vectors, starts[some], sizes[some])
            logits[some] = forward(model.weights, x, mask)
        top = np.maximum.reduceat(logits, np.searchsorted(rows, np.arange(len(firsts) - 1))) if len(rows) else logits
        scores[first : first + len(top)] = _sigmoid(top.astype(np.float64) + model.shift)
    return scores


def training_rows(docs: DataFrame, labels: DataFrame, usable: Column, most: int = TRAINING_ROWS) -> tuple[list[str], np.ndarray, float]:
    """A bounded sample of labelled texts, both labels alike, and the share of toxic ones among all.

    Rows come in the order of a hash of their id, so the sample is the same wherever the rows lie.
    """
    labelled = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & usable)
    labelled = labelled.select("doc_id", (F.col("toxic") == 1).cast("int").alias("toxic")).distinct()
    counts = {r.toxic: r.n for r in labelled.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    per_label = [labelled.filter(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most // 2) for k in (0, 1)]
    chosen = per_label[0].union(per_label[1])
    found = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    rows = sorted(found.select("text", "toxic").collect(), key=lambda r: (r.toxic, r.text))
    return [r.text for r in rows], np.array([r.toxic for r in rows], np.int64), share


def score_documents(docs: DataFrame, model: Model, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns ``keep`` of every row with ``_score`` (0 to 1).

    Every window of every whole text is scored. Null and empty texts, and texts without letters,
    have one empty window, whose score is that of the bias. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    ready_for_python(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = [*batch.schema.names[1:], "_score"]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(score_texts(shared.value, batch.column(0)))], names=names)

    fields = ", ".join(f"`{docs.schema[c].name}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select(F.col(text_col).alias("_text"), *keep).mapInArrow(run, f"{fields}, _score double")
