"""Quality classifier: a byte-level convolutional network in numpy.

A document is cut into chunks of bytes that overlap and together cover all of it. Each byte is
embedded and gets one further channel that says whether the eight bytes up to it stood
a few bytes earlier already. Learned filters slide over a chunk; each filter's strongest
answer (max-pooling) goes into a small dense layer that gives the chunk's evidence of bad
quality, and the strongest evidence of all chunks gives the document's probability.

The network is trained on the driver from a sample whose size is fixed by parameters
(``per_class`` rows, rows of ``train_chunks`` chunks at most), drawn from the rows that may be learned from.
Scoring covers every byte of every document, a bounded number of chunks at a time.
"""

from __future__ import annotations

from dataclasses import dataclass, fields

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField

from opsmart.llm.common import held_out, labelled_sample, map_texts

CHUNK, OVERLAP = 512, 64
WIDTH, STEP = 8, 4
_PAD = 256
_LAGS = 32
_RUN = 8
_EMBEDDED, _FILTERS, _HIDDEN = 7, 24, 16
#: Chunks that are worked on at once.
_BLOCK = 512


def chunks(data: bytes) -> np.ndarray:
    """Rows of ``CHUNK`` bytes, each starting ``OVERLAP`` bytes before the end of the last; filled up with a pad value."""
    n = 1 + max(0, -(-(len(data) - CHUNK) // (CHUNK - OVERLAP)))
    out = np.full((n, CHUNK), _PAD, np.int16)
    flat = np.frombuffer(data, np.uint8)
    for k in range(n):
        part = flat[k * (CHUNK - OVERLAP) : k * (CHUNK - OVERLAP) + CHUNK]
        out[k, : len(part)] = part
    return out


def repeated(rows: np.ndarray) -> np.ndarray:
    """Where the last ``_RUN`` bytes equal those some 2 to ``_LAGS`` bytes before them."""
    out = np.zeros(rows.shape, bool)
    real = rows != _PAD
    narrow = rows.astype(np.uint8)
    for lag in range(2, _LAGS + 1):
        same = (narrow[:, lag:] == narrow[:, :-lag]) & real[:, lag:]
        size = 1
        while size < _RUN:
            same = same[:, size:] & same[:, :-size]
            size *= 2
        out[:, lag + _RUN - 1 :] |= same
    return out


@dataclass
class Network:
    """Weights: of the embedding, of the filters, of the dense layer and of the answer."""

    embedding: np.ndarray
    filters: np.ndarray
    filter_bias: np.ndarray
    dense: np.ndarray
    dense_bias: np.ndarray
    answer: np.ndarray
    answer_bias: np.ndarray

    @staticmethod
    def fresh(seed: int = 7) -> Network:
        rng = np.random.default_rng(seed)
        draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        channels = _EMBEDDED + 1
        return Network(
            draw(_PAD + 1, _EMBEDDED) * np.float32(8),
            draw(WIDTH * channels, _FILTERS),
            np.zeros(_FILTERS, np.float32),
            draw(_FILTERS, _HIDDEN),
            np.zeros(_HIDDEN, np.float32),
            draw(_HIDDEN, 1)[:, 0],
            np.zeros(1, np.float32),
        )

    def windows(self, rows: np.ndarray, repeats: np.ndarray) -> np.ndarray:
        """``rows x places x (WIDTH * channels)``."""
        x = np.empty((*rows.shape, _EMBEDDED + 1), np.float32)
        x[..., :-1] = self.embedding[rows]
        x[..., -1] = repeats
        n, size, channels = x.shape
        places = (size - WIDTH) // STEP + 1
        view = np.lib.stride_tricks.as_strided(
            x, (n, places, WIDTH * channels), (x.strides[0], x.strides[1] * STEP, x.strides[2])
        )
        return view

    def pooled(self, rows: np.ndarray, repeats: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each filter's strongest answer in each row, and its place."""
        windows = self.windows(rows, repeats)
        answers = windows.reshape(-1, windows.shape[2]) @ self.filters
        answers = answers.reshape(len(rows), -1, _FILTERS)
        at = answers.argmax(axis=1)
        best = np.take_along_axis(answers, at[:, None, :], axis=1)[:, 0] + self.filter_bias
        return np.maximum(best, 0), at

    def evidence(self, pooled: np.ndarray) -> np.ndarray:
        return np.maximum(pooled @ self.dense + self.dense_bias, 0) @ self.answer + self.answer_bias[0]

    def score(self, texts: list) -> np.ndarray:
        """Probability of good quality for each text; a null or empty one is one chunk of padding."""
        best = np.full(len(texts), -np.inf, np.float32)
        held: list[np.ndarray] = []
        owner: list[int] = []
        count = 0

        def flush() -> None:
            nonlocal count
            if held:
                rows = np.concatenate(held)
                who = np.repeat(owner, [len(h) for h in held])
                for k in range(0, len(rows), _BLOCK):
                    part = rows[k : k + _BLOCK]
                    np.maximum.at(best, who[k : k + _BLOCK], self.evidence(self.pooled(part, repeated(part))[0]))
                held.clear()
                owner.clear()
                count = 0

        span = _BLOCK * (CHUNK - OVERLAP)
        for i, text in enumerate(texts):
            data = (text or "").encode()
            # A huge document is taken in stretches that overlap just as its chunks do.
            for start in range(0, max(1, len(data) - OVERLAP), span):
                held.append(chunks(data[start : start + span + OVERLAP]))
                owner.append(i)
                count += len(held[-1])
                if count >= _BLOCK:
                    flush()
        flush()
        return 1 / (1 + np.exp(best.astype(np.float64)))


def train(sample: list[tuple[str, int]], prior_good: float, epochs: int = 12, train_chunks: int = 40, seed: int = 7) -> Network:
    """Fit a network to ``(text, 1 if good)`` rows by Adam on the cross entropy.

    Rows with more than ``train_chunks`` chunks are passed over. ``prior_good`` is the share of good rows among
    all that may be learned from; the answer's bias is moved to it, since the sample is balanced.
    """
    net = Network.fresh(seed)
    made = [(chunks(t.encode()), 1 - good) for t, good in sample]
    made = [(rows, bad) for rows, bad in made if len(rows) <= train_chunks]
    if not made:
        net.answer_bias[0] = -50.0 if prior_good >= 0.5 else 50.0
        return net
    rng = np.random.default_rng(seed)
    names = [f.name for f in fields(net)]
    first = {n: np.zeros_like(getattr(net, n)) for n in names}
    second = {n: np.zeros_like(getattr(net, n)) for n in names}
    step = 0
    repeats = [repeated(rows) for rows, _ in made]
    total = epochs * -(-len(made) // 32)
    for _ in range(epochs):
        order = rng.permutation(len(made))
        for b in range(0, len(order), 32):
            batch = order[b : b + 32]
            rows = np.concatenate([made[i][0] for i in batch])
            reps = np.concatenate([repeats[i] for i in batch])
            sizes = np.array([len(made[i][0]) for i in batch])
            starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
            pooled, at = net.pooled(rows, reps)
            z = net.evidence(pooled)
            chosen = np.array([s + int(z[s : s + n].argmax()) for s, n in zip(starts, sizes, strict=True)])
            target = np.array([made[i][1] for i in batch], np.float32)
            dz = (1 / (1 + np.exp(-z[chosen])) - target) / len(batch)
            grads = _gradients(net, rows[chosen], reps[chosen], pooled[chosen], at[chosen], dz)
            step += 1
            rate = 0.01 * min(1.0, 2.0 * (1 - step / (total + 1)))
            for n in names:
                g = grads[n]
                first[n] = 0.9 * first[n] + 0.1 * g
                second[n] = 0.999 * second[n] + 0.001 * g * g
                move = (first[n] / (1 - 0.9**step)) / (np.sqrt(second[n] / (1 - 0.999**step)) + 1e-8)
                setattr(net, n, (getattr(net, n) - rate * move).astype(np.float32))
    share_bad = sum(bad for _, bad in made) / len(made)
    odds = lambda p: np.log(min(max(p, 1e-3), 1 - 1e-3) / (1 - min(max(p, 1e-3), 1 - 1e-3)))
    net.answer_bias = (net.answer_bias + odds(1 - prior_good) - odds(share_bad)).astype(np.float32)
    return net


def _gradients(net: Network, rows, repeats, pooled, at, dz) -> dict[str, np.ndarray]:
    """Of the loss, through the chunk that decides for each document and each filter's strongest place in it."""
    hidden = np.maximum(pooled @ net.dense + net.dense_bias, 0)
    d_hidden = dz[:, None] * net.answer * (hidden > 0)
    d_pooled = (d_hidden @ net.dense.T) * (pooled > 0)
    windows = net.windows(rows, repeats)
    n = len(rows)
    taken = windows[np.arange(n)[:, None], at]  # rows x filters x width * channels
    d_windows = d_pooled[:, :, None] * net.filters.T[None]
    bytes_at = rows[np.arange(n)[:, None, None], (at * STEP)[:, :, None] + np.arange(WIDTH)]
    d_embedding = np.zeros_like(net.embedding)
    channels = _EMBEDDED + 1
    np.add.at(d_embedding, bytes_at.reshape(-1), d_windows.reshape(n, _FILTERS, WIDTH, channels)[..., :-1].reshape(-1, _EMBEDDED))
    return {
        "embedding": d_embedding,
        "filters": np.einsum("nfw,nf->wf", taken, d_pooled),
        "filter_bias": d_pooled.sum(axis=0),
        "dense": pooled.T @ d_hidden,
        "dense_bias": d_hidden.sum(axis=0),
        "answer": hidden.T @ dz,
        "answer_bias": np.array([dz.sum()], np.float32),
    }


def fit(docs: DataFrame, labels: DataFrame, per_class: int = 1500, epochs: int = 12) -> Network:
    """A network trained on at most ``2 * per_class`` labelled rows that are not held out."""
    usable = labels.where(~held_out(F.col("doc_id")) & F.col("quality").isin(0, 1))
    good = usable.agg(F.avg(F.col("quality").cast("double"))).first()[0]
    sample = [(text, label) for _, text, label in labelled_sample(docs, labels, "quality", per_class)]
    return train(sample, 0.5 if good is None else good, epochs)


def score_quality(docs: DataFrame, network: Network) -> DataFrame:
    """``doc_id, score`` for every row: the probability that the text is of good quality."""
    shared = docs.sparkSession.sparkContext.broadcast(network)  # a few thousand weights, whatever the input

    def worker():
        net = shared.value
        return lambda texts: {"score": net.score(texts)}

    return map_texts(docs, worker, [StructField("score", DoubleType())])


def classify(docs: DataFrame, labels: DataFrame, per_class: int = 1500) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``.

    A null or empty text is scored as one chunk of padding. Rows without ``doc_id`` are scored and count
    as not held out, but no label is learned from them. Repeated rows get the same score; an empty table gives an empty result;
    without usable labels every row gets a score near 1. Only ``text`` goes into a score.
    """
    scored = score_quality(docs, fit(docs, labels, per_class))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, per_class: int = 1500) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text scores ``threshold`` or more."""
    import pyarrow as pa
    import pyarrow.compute as pc
    from pyspark.sql.pandas.types import to_arrow_schema

    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, per_class))
    at = docs.columns.index("text")
    arrow = to_arrow_schema(docs.schema)

    def run(batches):
        for batch in batches:
            good = shared.value.score(batch.column(at).to_pylist()) >= threshold
            table = pa.Table.from_batches([batch]).filter(pa.array(good)) if len(good) else None
            if table is not None:
                for part in table.combine_chunks().to_batches():
                    yield pa.RecordBatch.from_arrays([pc.cast(c, f.type) for c, f in zip(part.columns, arrow, strict=True)], schema=arrow)

    return docs.mapInArrow(run, docs.schema)
