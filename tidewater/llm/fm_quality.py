"""Quality classifier: a factorisation machine over hashed words, structure and metadata.

The score of a text is the logistic of ``bias + w.x + sum of <v_i, v_j> x_i x_j``.
The pairwise part is computed in time linear in the features as
``(square of the sum - sum of the squares) / 2`` for each factor.  The model is
fitted by Adam on a bounded labelled sample in one task; whole texts of all
rows are scored in the tasks that read them.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.sampling import labelled_sample, remainder

BUCKETS = 1 << 12
_MARKS = "|#$%*&{}[]<>=/\\_~^@+"
_STRUCTURE = 16
_UPPER = re.compile("[A-Z]")
_LETTERS = re.compile(r"[^\W\d_]+")
_DIGITS = re.compile(r"\d")


class _Buckets(dict):
    """Word -> hash bucket, remembered up to a bounded number of words."""

    def __missing__(self, word: str) -> int:
        if len(self) > 1_000_000:
            self.clear()
        made = self[word] = zlib.crc32(word.encode()) % BUCKETS
        return made


def row_features(text: str, n_chars: int | None, buckets: _Buckets) -> tuple[np.ndarray, np.ndarray]:
    """(hashed words scaled to unit length, structure and metadata)."""
    words = text.lower().split()
    n, size = max(1, len(words)), max(1, len(text))
    counts = np.bincount(np.fromiter(map(buckets.__getitem__, words), np.int64, len(words)), minlength=BUCKETS).astype(np.float32)
    norm = float(np.sqrt(counts @ counts))
    lines = text.split("\n")
    full = [x for x in lines if x.strip()]
    marks = sum(map(text.count, _MARKS))
    structure = [
        np.log1p(len(text)),
        np.log1p(len(words)),
        np.log1p(size / n),
        len(set(words)) / n,
        marks / n,
        min(1.0, 10 * marks / size),
        len(_DIGITS.findall(text)) / size,
        len(_UPPER.findall(text)) / n,
        (text.count(".") + text.count("!") + text.count("?")) / n,
        text.count(",") / n,
        sum(map(len, _LETTERS.findall(text))) / size,
        np.log1p(len(full)) - np.log1p(n),
        len(set(full)) / max(1, len(full)),
        float(counts.max()) / n,
        1.0 if text else 0.0,
        np.log1p(max(0, n_chars)) if n_chars is not None else np.log1p(len(text)),
    ]
    return counts / (norm or 1.0), np.array(structure, dtype=np.float32)


@dataclass
class Model:
    bias: float
    linear: np.ndarray
    factors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray

    def inputs(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        structure = np.clip((np.stack([s for _, s in rows]) - self.mean) / self.scale, -5, 5)
        return np.concatenate([np.stack([h for h, _ in rows]), structure], axis=1)

    def margin(self, x: np.ndarray) -> np.ndarray:
        together = x @ self.factors
        pairs = 0.5 * (together**2 - (x**2) @ (self.factors**2)).sum(axis=1)
        return self.bias + x @ self.linear + pairs

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30).astype(np.float64)))

    def packed(self) -> bytes:
        return np.concatenate([[self.bias], self.linear, self.factors.ravel(), self.mean, self.scale]).astype("<f4").tobytes()

    @classmethod
    def unpacked(cls, data: bytes) -> Model:
        x, d = np.frombuffer(data, "<f4"), BUCKETS + _STRUCTURE
        rank = (len(x) - 1 - d - 2 * _STRUCTURE) // d
        cut = np.split(x[1:], np.cumsum([d, d * rank, _STRUCTURE]))
        return cls(float(x[0]), cut[0], cut[1].reshape(d, rank), cut[2], cut[3])


def fit(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, *, rank: int = 8, epochs: int = 30, batch: int = 128, rate: float = 0.01, decay: float = 1e-4) -> Model:
    """Adam on the logistic loss; classes weigh alike.  One class only gives its share as constant."""
    rng = np.random.default_rng(0)
    d = BUCKETS + _STRUCTURE
    structure = np.stack([s for _, s in rows]) if rows else np.zeros((1, _STRUCTURE), np.float32)
    model = Model(0.0, np.zeros(d, np.float32), np.zeros((d, rank), np.float32), structure.mean(axis=0), structure.std(axis=0) + 1e-3)
    if not rows or y.min() == y.max():
        model.bias = 2.0 if not rows or y[0] else -2.0
        return model
    x, y = model.inputs(rows).astype(np.float32), y.astype(np.float32)
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean())).astype(np.float32)
    model.factors = rng.normal(0, 0.02, (d, rank)).astype(np.float32)
    state = [np.zeros(1, np.float32), model.linear, model.factors]
    first, second = [np.zeros_like(p) for p in state], [np.zeros_like(p) for p in state]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for at in range(0, len(y), batch):
            rows_at = order[at : at + batch]
            part = x[rows_at]
            together = part @ state[2]
            margin = state[0][0] + part @ state[1] + 0.5 * (together**2 - (part**2) @ (state[2] ** 2)).sum(axis=1)
            slope = weight[rows_at] * (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y[rows_at]) / len(rows_at)
            by_row = part * slope[:, None]
            gradients = [np.array([slope.sum()], np.float32), by_row.sum(axis=0) + decay * state[1], by_row.T @ together - state[2] * (part * by_row).sum(axis=0)[:, None] + decay * state[2]]
            step += 1
            for p, g, m, v in zip(state, gradients, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    model.bias, model.linear, model.factors = float(state[0][0]), state[1], state[2]
    return model


def _fit(table: pa.Table) -> pa.Table:
    table = table.sort_by([("label", "ascending"), ("text", "ascending")])
    buckets = _Buckets()
    rows = [row_features(t, n, buckets) for t, n in zip(table.column("text").to_pylist(), table.column("n_chars").to_pylist(), strict=True)]
    model = fit(rows, table.column("label").to_numpy().astype(np.float32))
    return pa.table({"model": pa.array([model.packed()], pa.binary())})


def _score(packed: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, buckets = Model.unpacked(packed), _Buckets()
        for batch in batches:
            scores = []
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                rows = [row_features(t.as_py() or "", n.as_py(), buckets) for t, n in zip(part.column(1), part.column(2), strict=True)]
                scores.append(model.score(model.inputs(rows)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(scores) if scores else np.array([], float))], names=["id", "score"])

    return run


def score_quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", chars_col: str = "n_chars", *, rows_per_class: int = 3000, threshold: float = 0.7
) -> DataFrame:
    """One row per input row: id, held_out, score, predicted.

    The model is fitted on at most ``rows_per_class`` labelled rows of either
    class with crc32(id) mod 4 other than 2.  Null texts count as empty, null
    sizes as the text's length; a table without the size column is scored
    by its texts.  Without labels of both classes the score is constant;
    repeated rows are scored alike; an empty table gives an empty result.
    """
    chars = F.col(chars_col).cast("long") if chars_col in docs.columns else F.lit(None).cast("long")
    train = labels.filter(remainder(id_col, 4) != 2)
    sample = labelled_sample(docs, train, id_col, text_col, label_col, rows_per_class, n_chars=chars)
    models = sample.groupBy(F.lit(0).alias("one")).applyInArrow(_fit, "model binary").collect()
    packed = bytes(models[0]["model"]) if models else fit([], np.array([])).packed()
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("content"), chars.alias("n_chars"))
    scored = rows.mapInArrow(_score(packed), "id long, score double")
    return scored.select(F.col("id").alias(id_col), (remainder("id", 4) == 2).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
