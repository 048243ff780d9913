"""Quality by ordinal regression: one hashed-text score, ordered thresholds between grades (a cumulative-link model)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .store import quoted, share
from .text import hashed, mix, utf8_pieces, word_spans

#: Most labelled rows that the model is fitted on: those whose ids hash lowest.
SAMPLE = 6000
DIM = 1 << 16
#: Grades, worst first: toxic; not toxic but of low quality; neither.
GRADES = 3
#: Share of the best rows, among those held out, that the cut is to keep.
KEEP = 0.997


def features(column: pa.Array):
    """(rows from, row of each feature, feature, weight) of runs of rows: words, their endings and shapes, and how repetitive the
    text is, hashed; counts are damped and each row has length one."""
    for at, raw, offs in utf8_pieces(column):
        starts, ends, bounds = word_spans(raw, offs)
        rows = len(offs) - 1
        own = np.repeat(np.arange(rows), np.diff(bounds))
        upper = np.concatenate([[0], np.cumsum((raw >= 65) & (raw <= 90))])
        letters = np.concatenate([[0], np.cumsum((raw >= 128) | ((raw | 32) >= 97) & ((raw | 32) <= 122))])
        n = ends - starts
        caps, alpha = upper[ends] - upper[starts], letters[ends] - letters[starts]
        low = np.where((raw >= 65) & (raw <= 90), raw + 32, raw).astype(np.uint8)
        word = hashed(low, starts, ends)
        tail = hashed(raw, np.maximum(starts, ends - 2), ends) ^ np.uint64(1)
        shape = mix((np.minimum(caps, 2) + 4 * np.minimum(n - alpha, 4) + 32 * np.minimum(n, 15) + 7_000_000).astype(np.uint64))
        keys = [own * DIM + (h % np.uint64(DIM)).astype(np.int64) for h in (word, tail, shape)]
        # how often the last words come again, and how long the text is, as one feature each
        n_words = np.diff(bounds)
        distinct = np.bincount(np.unique(own.astype(np.uint64) * np.uint64(1 << 40) + (word >> np.uint64(24)), return_index=True)[0].astype(np.uint64) >> np.uint64(40), minlength=rows) if len(own) else np.zeros(rows, int)
        share = (10 * distinct // np.maximum(n_words, 1)).astype(np.uint64)
        size = np.log2(np.maximum(n_words, 1)).astype(np.uint64)
        row_keys = np.arange(rows) * DIM
        plain = [row_keys + (mix(share + np.uint64(900)) % np.uint64(DIM)).astype(np.int64), row_keys + (mix(share * np.uint64(32) + size + np.uint64(5000)) % np.uint64(DIM)).astype(np.int64)]
        key, count = np.unique(np.concatenate(keys), return_counts=True)
        row, value = key // DIM, np.log1p(count)
        norm = np.sqrt(np.bincount(row, value * value, rows))
        value = value / np.maximum(norm[row], 1e-9)
        key = np.concatenate([key, *plain])
        value = np.concatenate([value, np.full(2 * rows, 0.3)])
        sort = np.argsort(key, kind="stable")
        yield at, key[sort] // DIM, key[sort] % DIM, value[sort]


def _rows(batches):
    for batch in batches:
        for at, row, feature, value in features(batch.column("text")):
            rows = int(row.max()) + 1
            cut = np.searchsorted(row, np.arange(rows + 1))
            lists = lambda x, t: pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(x).cast(t))
            head = batch.select(["doc_id", "grade"]).slice(at, rows)
            yield pa.RecordBatch.from_arrays([*head.columns, lists(feature, pa.int32()), lists(value, pa.float32())], ["doc_id", "grade", "feature", "value"])


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class CumulativeLink:
    """P(grade <= k) = sigmoid(threshold_k - score), score = the text's features by shared weights.

    Features are scaled by how much more often they stand in rows of the best grade than in others; those that hardly differ
    are left out. Fitted to four rows of five; on the fifth, `cut` is the tail probability that KEEP of its best rows reach.
    """

    def __init__(self, grade: np.ndarray, start: np.ndarray, feature: np.ndarray, value: np.ndarray):
        best = grade == GRADES - 1
        held = np.arange(len(grade)) % 5 == 4
        if not (best & held).any() or len(np.unique(grade[~held])) < 2:
            held[:] = False
        rows = np.repeat(np.arange(len(grade)), np.diff(start))
        use = ~held[rows]
        odds = [np.log((np.bincount(feature[use & (best[rows] == side)], minlength=DIM) + 1.0) / ((best[~held] == side).sum() + 2)) for side in (True, False)]
        scale = odds[0] - odds[1]
        scale[np.abs(scale) < 0.2] = 0
        use &= scale[feature] != 0
        index = np.cumsum(~held) - 1
        weights, self.theta = self._fitted(grade[~held], index[rows[use]], feature[use], value[use] * scale[feature[use]])
        self.weights = (weights * scale).astype(np.float32)
        tail = 1 - _sigmoid(self.theta[-1] - np.bincount(rows, value * self.weights[feature], len(grade)))[best & (held if held.any() else True)]
        self.cut = float(np.clip(np.quantile(tail, 1 - KEEP), 0.1, 0.5)) if len(tail) else 0.5

    def _fitted(self, grade, rows, feature, value, steps: int = 250, rate: float = 0.5, shrink: float = 2e-6):
        counts = np.bincount(grade, minlength=GRADES)
        weight = (len(grade) / (np.count_nonzero(counts) * np.maximum(counts, 1)))[grade]
        weight /= weight.sum()
        params = np.zeros(DIM + GRADES - 1)  # weights, first threshold, logs of the steps to the others
        params[DIM] = -1.0
        pace, speed = np.zeros_like(params), np.zeros_like(params)
        for t in range(1, steps + 1):
            theta = self._ordered(params)
            score = np.bincount(rows, value * params[feature], len(grade))
            edge = np.concatenate([[-np.inf], theta, [np.inf]])
            hi, lo = (_sigmoid(np.clip(e - score, -40, 40)) for e in (edge[grade + 1], edge[grade]))
            p = np.maximum(hi - lo, 1e-9)
            d_hi, d_lo = weight * hi * (1 - hi) / p, weight * lo * (1 - lo) / p
            g = np.zeros_like(params)
            g[:DIM] = np.bincount(feature, value * (d_lo - d_hi)[rows], DIM) - shrink * params[:DIM]
            d_theta = np.array([d_hi[grade == k].sum() - d_lo[grade == k + 1].sum() for k in range(GRADES - 1)])
            g[DIM] = d_theta.sum()
            for k in range(1, GRADES - 1):
                g[DIM + k] = d_theta[k:].sum() * np.exp(params[DIM + k])
            pace, speed = 0.9 * pace + 0.1 * g, 0.99 * speed + 0.01 * g * g
            params += rate * (1 - t / (steps + 1)) * (pace / (1 - 0.9**t)) / (np.sqrt(speed / (1 - 0.99**t)) + 1e-9)
        return params[:DIM], self._ordered(params)

    @staticmethod
    def _ordered(params):
        return params[DIM] + np.concatenate([[0.0], np.cumsum(np.exp(params[DIM + 1 :]))])

    def judged(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Expected grade and probability of the best grade of each text."""
        score = np.zeros(len(column))
        for at, row, feature, value in features(column):
            part = np.bincount(row, value * self.weights[feature])
            score[at : at + len(part)] = part
        above = 1 - _sigmoid(self.theta[None, :] - score[:, None])
        return above.sum(1), above[:, -1]


def _graded(labels: DataFrame) -> DataFrame:
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).otherwise(2)
    return labels.where("doc_id is not null and quality is not null and toxic is not null").groupBy("doc_id").agg(F.min(grade).alias("grade"))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> CumulativeLink | None:
    """The model, from the labelled rows of docs, at most `sample` of them; None if these are of one grade only."""
    chosen = _graded(labels).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    joined = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen.select(F.col("doc_id").cast("long").alias("doc_id"), "grade")), "doc_id")
    rows = joined.select("doc_id", "text", "grade").mapInArrow(_rows, "doc_id long, grade int, feature array<int>, value array<float>").toArrow().combine_chunks()
    if not len(rows) or len(set(rows.column("grade").to_pylist())) < 2:
        return None
    order = np.argsort(rows.column("doc_id").to_numpy(), kind="stable")
    rows = rows.take(pa.array(order)).combine_chunks()
    feature = rows.column("feature").chunk(0)
    return CumulativeLink(rows.column("grade").to_numpy(), feature.offsets.to_numpy() - feature.offsets[0].as_py(), feature.flatten().to_numpy(), rows.column("value").chunk(0).flatten().to_numpy().astype(float))


def _judged(model):
    def run(batches):
        own = model()
        for batch in batches:
            grade, tail = own.judged(batch.column("text"))
            yield batch.append_column("expected_grade", pa.array(np.round(grade, 6))).append_column("tail_prob", pa.array(np.round(tail, 6)))

    return run


def rate(docs: DataFrame, labels: DataFrame, least: float | None = None, sample: int = SAMPLE) -> DataFrame:
    """docs with expected_grade (0 to 2), tail_prob (of the best grade) and keep (tail_prob >= least, by default the model's cut)
    added, in place of columns of these names.

    Labels with nulls teach nothing; of several labels of an id the worst holds. A null text is judged as an empty one. Repeated
    rows are judged alike, and teach each. If there are no labels, or all of one grade, nothing can be told: the new numbers are
    null and every row is kept.
    """
    own = [c for c in docs.columns if c not in ("expected_grade", "tail_prob", "keep")]
    docs = docs.select(*[F.col(quoted(c)) for c in own])
    model = fit(docs, labels, sample)
    if model is None:
        return docs.select("*", F.lit(None).cast("double").alias("expected_grade"), F.lit(None).cast("double").alias("tail_prob"), F.lit(True).alias("keep"))
    schema = T.StructType([*docs.schema.fields, T.StructField("expected_grade", T.DoubleType()), T.StructField("tail_prob", T.DoubleType())])
    return docs.mapInArrow(_judged(share(docs.sparkSession, model)), schema).withColumn("keep", F.col("tail_prob") >= (round(model.cut, 6) if least is None else least))
