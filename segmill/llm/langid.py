"""Language of whole texts by a small byte convolutional network, trained here in numpy.

Bytes are embedded, filters of several widths run over fixed-length windows, each filter's largest
answer in the window is kept, and a softmax over these names the language. A text is read in full,
window after window; its prediction is the mean of its windows' probabilities, by their bytes.

Training reads a bounded sample of labelled documents: one window of each, chosen by hash. Held-out
documents (crc32 of the doc_id as text, mod 4, is 2) are never in it. The sample's bound is the
parameter `train_rows`; prediction covers every byte of every document.

Cases: a null text or one without a letter is `und` with score 0.0; a null doc_id is neither held
out nor learned from; repeated rows each get their row; if no document is labelled, every text is
`und`; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segmill.llm.common import configure, text_bytes

WINDOW = 256
WIDTHS = (2, 3, 4, 5)
#: Bytes of windows that are cut and predicted at once.
STRETCH = 1 << 21
#: Labelled documents that training reads at most.
TRAIN_ROWS = 6000
UNKNOWN = "und"
RESULT = T.StructType().add("doc_id", T.LongType()).add("held_out", T.BooleanType()).add("lang_pred", T.StringType()).add("score", T.DoubleType())


@dataclass
class ByteNet:
    """Weights, and the forward and backward passes over windows of bytes (0 is padding)."""

    langs: list[str]
    embed: int = 8
    filters: int = 8
    seed: int = 7
    weights: list[np.ndarray] = field(default_factory=list)

    def __post_init__(self) -> None:
        if not self.weights:
            rng = np.random.default_rng(self.seed)
            total, wide = self.filters * len(WIDTHS), max(WIDTHS)
            scale = 1 / np.sqrt(self.embed * 3)
            kernel = rng.normal(0, scale, (wide * self.embed, total)).astype(np.float32) * self.mask()
            self.weights = [
                rng.normal(0, 0.5, (256, self.embed)).astype(np.float32),
                kernel,
                np.zeros(total, np.float32),
                rng.normal(0, 0.2, (total, len(self.langs))).astype(np.float32),
                np.zeros(len(self.langs), np.float32),
            ]

    def mask(self) -> np.ndarray:
        """Filters of all widths share one matrix; a narrow one has zeros below its width."""
        rows = np.arange(max(WIDTHS)).repeat(self.embed)[:, None]
        return (rows < np.repeat(WIDTHS, self.filters)[None, :]).astype(np.float32)

    def columns(self, windows: np.ndarray) -> np.ndarray:
        """(windows, positions, width x embed): what each filter position sees."""
        wide = max(WIDTHS)
        n, length = windows.shape
        padded = np.zeros((n, length + wide - 1), np.uint8)
        padded[:, :length] = windows
        seen = self.weights[0][padded]
        step = seen.strides
        view = np.lib.stride_tricks.as_strided(seen, (n, length, wide * self.embed), (step[0], step[1], step[2]))
        return np.ascontiguousarray(view)

    def pooled(self, windows: np.ndarray) -> np.ndarray:
        n, length = windows.shape
        answers = self.columns(windows).reshape(n * length, -1) @ self.weights[1]
        return np.maximum(answers.reshape(n, length, -1).max(axis=1) + self.weights[2], 0)

    def predict(self, windows: np.ndarray, block: int = 64) -> np.ndarray:
        """Probabilities of each window's language."""
        out = np.empty((len(windows), len(self.langs)), np.float32)
        for at in range(0, len(windows), block):
            out[at : at + block] = _softmax(self.pooled(windows[at : at + block]) @ self.weights[3] + self.weights[4])
        return out

    def train(self, windows: np.ndarray, labels: np.ndarray, epochs: int = 6, batch: int = 64, rate: float = 0.01) -> None:
        """Adam on cross-entropy; each language weighs the same in total."""
        rng = np.random.default_rng(self.seed)
        share = np.bincount(labels, minlength=len(self.langs)).astype(np.float32)
        weight = (len(labels) / (len(self.langs) * np.maximum(share, 1)))[labels].astype(np.float32)
        first = [np.zeros_like(w) for w in self.weights]
        second = [np.zeros_like(w) for w in self.weights]
        mask, step = self.mask(), 0
        for _ in range(epochs):
            order = rng.permutation(len(windows))
            for at in range(0, len(order), batch):
                rows = order[at : at + batch]
                grads = self._gradients(windows[rows], labels[rows], weight[rows], mask)
                step += 1
                for w, g, m, v in zip(self.weights, grads, first, second, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-7)

    def _gradients(self, windows: np.ndarray, labels: np.ndarray, weight: np.ndarray, mask: np.ndarray) -> list[np.ndarray]:
        n, length = windows.shape
        seen = self.columns(windows)
        answers = (seen.reshape(n * length, -1) @ self.weights[1]).reshape(n, length, -1)
        where = answers.argmax(axis=1)
        raw = np.take_along_axis(answers, where[:, None, :], 1)[:, 0] + self.weights[2]
        pooled = np.maximum(raw, 0)
        off = _softmax(pooled @ self.weights[3] + self.weights[4])
        off[np.arange(n), labels] -= 1
        off *= (weight / n)[:, None]
        back = (off @ self.weights[3].T) * (raw > 0)
        at_max = seen[np.arange(n)[:, None], where]  # (n, filters, width x embed)
        kernel = np.einsum("nf,nfk->kf", back, at_max) * mask
        to_seen = back[:, :, None] * (self.weights[1] * mask).T[None]
        wide = max(WIDTHS)
        padded = np.zeros((n, length + wide - 1), np.uint8)
        padded[:, :length] = windows
        bytes_at = padded[np.arange(n)[:, None, None], where[:, :, None] + np.arange(wide)]
        table = np.zeros_like(self.weights[0])
        np.add.at(table, bytes_at.reshape(-1), to_seen.reshape(-1, self.embed))
        return [table, kernel, back.sum(0), pooled.T @ off, off.sum(0)]


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def window_counts(offsets: np.ndarray, window: int) -> np.ndarray:
    return -(-np.diff(offsets) // window)


def windows_at(data: np.ndarray, offsets: np.ndarray, text: np.ndarray, nth: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """The nth windows of texts (the last of each is padded) and their bytes."""
    start = offsets[text] + nth * window
    size = np.minimum(window, offsets[text + 1] - start)
    at = np.minimum(start[:, None] + np.arange(window), max(len(data) - 1, 0))
    return data[at] * (np.arange(window) < size[:, None]), size


def mean_scores(net: ByteNet, data: np.ndarray, offsets: np.ndarray, window: int) -> np.ndarray:
    """(texts, languages): the mean over each text's windows by their bytes, a stretch of windows at a time."""
    ends = np.cumsum(window_counts(offsets, window))
    total = np.zeros((len(ends), len(net.langs)))
    step = max(1, STRETCH // window)
    for first in range(0, int(ends[-1]) if len(ends) else 0, step):
        every = np.arange(first, min(first + step, ends[-1]))
        text = np.searchsorted(ends, every, side="right")
        windows, size = windows_at(data, offsets, text, every - np.append(0, ends)[text], window)
        np.add.at(total, text, net.predict(windows) * size[:, None])
    return total / np.maximum(np.diff(offsets), 1)[:, None]


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_sample(docs: DataFrame, train_rows: int, window: int, seed: int) -> tuple[np.ndarray, list[str]]:
    """One window of each of about train_rows labelled documents that are not held out."""
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    labelled = rows.count()
    share = min(1.0, train_rows / max(1, labelled))
    rows = rows.where(F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            counts = window_counts(offsets, window)
            ids = np.array(batch.column(0).to_pylist(), np.int64)
            has = np.flatnonzero(counts)
            windows, _ = windows_at(data, offsets, has, (ids[has] * 2654435761 % (1 << 31)) % counts[has], window)
            raw = [w.tobytes() for w in windows]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(has)), pa.array(raw, pa.binary()), batch.column(2).take(pa.array(has))], names=["doc_id", "bytes", "lang"])

    sample = rows.select("doc_id", "text", F.col("lang").cast("string")).mapInArrow(run, "doc_id long, bytes binary, lang string")
    got = sample.orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id", "bytes", "lang").limit(train_rows).collect()
    if not got:
        return np.zeros((0, window), np.uint8), []
    return np.stack([np.frombuffer(bytes(r.bytes), np.uint8) for r in got]), [r.lang for r in got]


def train_langid(docs: DataFrame, train_rows: int = TRAIN_ROWS, window: int = WINDOW, seed: int = 7) -> ByteNet | None:
    """A network fitted on the labelled sample; None if there is nothing to learn from."""
    windows, labels = training_sample(docs, train_rows, window, seed)
    if not labels:
        return None
    langs = sorted(set(labels))
    net = ByteNet(langs, seed=seed)
    at = {lang: i for i, lang in enumerate(langs)}
    epochs = min(60, max(6, -(-30_000 // len(labels))))  # a small sample is seen more often
    net.train(windows, np.array([at[x] for x in labels]), epochs=epochs)
    return net


def has_letter(data: np.ndarray, offsets: np.ndarray, column: pa.Array) -> np.ndarray:
    ascii_letter = ((data | 32) >= 97) & ((data | 32) <= 122)
    sums = np.concatenate([[0], np.cumsum(ascii_letter)])
    found = sums[offsets[1:]] > sums[offsets[:-1]]
    for i in np.flatnonzero(~found).tolist():
        text = column[i].as_py()
        found[i] = bool(text) and any(c.isalpha() for c in text)
    return found


def predict_langid(docs: DataFrame, net: ByteNet | None, window: int = WINDOW) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            langs, score = np.full(n, UNKNOWN, object), np.zeros(n)
            if net is not None:
                names = np.array(net.langs, object)
                data, offsets = text_bytes(batch.column(2))
                letters = has_letter(data, offsets, batch.column(2))
                mean = mean_scores(net, data, offsets, window)
                best = mean.argmax(axis=1)
                langs[letters] = names[best[letters]]
                score[letters] = np.clip(mean[np.arange(n), best], 0, 1)[letters]
            columns = [batch.column(0), batch.column(1), pa.array(langs.tolist(), pa.string()), pa.array(score)]
            yield pa.RecordBatch.from_arrays(columns, names=RESULT.names)

    return docs.select(F.col("doc_id").cast("long"), held_out(F.col("doc_id")), F.col("text").cast("string")).mapInArrow(run, RESULT)


def language_id(spark: SparkSession, docs: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """Train on the labelled sample of docs and predict all of docs."""
    configure(spark)
    return predict_langid(docs, train_langid(docs, train_rows))


def keep_known(spark: SparkSession, docs: DataFrame, least_score: float = 0.5, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """Documents whose language is known with at least least_score; columns stay as they are.

    Without a labelled document only texts without a letter go.

    The prediction is added inside one pass over the texts, so nothing is joined or shuffled.
    """
    configure(spark)
    net = train_langid(docs, train_rows)
    schema, names = docs.schema, docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(names.index("text"))
            data, offsets = text_bytes(texts)
            keep = has_letter(data, offsets, texts)
            if net is not None:
                keep &= mean_scores(net, data, offsets, WINDOW).max(axis=1) >= least_score
            if keep.any():
                yield batch.filter(pa.array(keep))

    return docs.mapInArrow(run, schema)
