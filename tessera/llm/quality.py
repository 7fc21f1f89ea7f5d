"""Quality classifier: a byte-level convolutional network in numpy.

Bytes are mapped to 64 classes.  Learned filters of six bytes slide over the
whole text; their responses are max-pooled over blocks, and two neighbouring
blocks form one of the overlapping chunks that cover the document.  Each chunk
gives a vector of pooled responses; mean and maximum over the chunks go through
one hidden layer into one probability.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import ship_package, text_slices
from tessera.llm.text import text_bytes

CLASSES, WIDTH, FILTERS, STRIDE, HIDDEN = 64, 6, 32, 2, 16
#: Positions per pooling block; a chunk is two neighbouring blocks (256 bytes, every 128 bytes).
BLOCK = 64
#: Pooling blocks handled by one numpy step.
SLICE_BLOCKS = 2048
#: Bound of the training sample: rows per label.
SAMPLE_PER_LABEL = 1500
THRESHOLD = 0.3


def _byte_classes() -> np.ndarray:
    """0 padding, 1-26 small letters, 27-52 capitals, 53 digits, then blanks, marks and non-ASCII bytes."""
    out = np.full(256, 59, dtype=np.uint8)
    out[0x61:0x7B] = np.arange(1, 27)
    out[0x41:0x5B] = np.arange(27, 53)
    out[0x30:0x3A] = 53
    out[0x20], out[0x0A] = 54, 55
    for byte, cls in zip(b".,!|*#", (56, 57, 58, 60, 61, 61), strict=True):
        out[byte] = cls
    out[0x80:0xC0], out[0xC0:] = 62, 63
    return out


BYTE_CLASS = _byte_classes()


def blocks(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(classes padded per text to whole blocks plus the filter's reach, blocks per text)."""
    lens = np.diff(offsets)
    step = BLOCK * STRIDE
    n_blocks = -(-(lens + WIDTH - STRIDE) // step)  # the windows that reach past a text's last block hold padding only
    out = np.zeros(int(n_blocks.sum()) * step + WIDTH, dtype=np.uint8)
    for at, first, size in zip(((np.cumsum(n_blocks) - n_blocks) * step).tolist(), offsets[:-1].tolist(), lens.tolist(), strict=True):
        out[at : at + size] = BYTE_CLASS[data[first : first + size]]
    return out, n_blocks


class ByteConvNet:
    """Weights of the network; ``score`` needs only numpy."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.conv = (rng.standard_normal((WIDTH, CLASSES, FILTERS)) * 0.3).astype(np.float32)
        self.bias = np.zeros(FILTERS, np.float32)
        self.w1 = (rng.standard_normal((2 * FILTERS, HIDDEN)) / np.sqrt(2 * FILTERS)).astype(np.float32)
        self.b1 = np.zeros(HIDDEN, np.float32)
        self.w2 = (rng.standard_normal(HIDDEN) / np.sqrt(HIDDEN)).astype(np.float32)
        self.b2 = np.zeros(1, np.float32)
        self.shift = 0.0  # log-odds added after training: prior of the labels
        self.constant: float | None = None

    def params(self) -> list[np.ndarray]:
        return [self.conv, self.bias, self.w1, self.b1, self.w2, self.b2]

    def tables(self) -> list[np.ndarray]:
        """Filter weights of two neighbouring bytes in one look-up."""
        return [(self.conv[j][:, None] + self.conv[j + 1][None]).reshape(CLASSES * CLASSES, FILTERS) for j in range(0, WIDTH, 2)]

    def pooled(self, classes: np.ndarray, n_blocks: np.ndarray, tables=None, where: bool = False):
        """Largest response of every filter in each block (and its place)."""
        tables = tables or self.tables()
        n, last = int(n_blocks.sum()), np.cumsum(n_blocks) - 1
        top, place = np.empty((n, FILTERS), np.float32), np.empty((n, FILTERS), np.int64) if where else None
        for a in range(0, n, SLICE_BLOCKS):  # a long text's responses are never held whole
            b = min(n, a + SLICE_BLOCKS)
            own, m = classes[a * BLOCK * STRIDE : b * BLOCK * STRIDE + WIDTH], (b - a) * BLOCK
            pair = own[:-1].astype(np.int32) * CLASSES + own[1:]
            r = tables[0][pair[0 : STRIDE * m : STRIDE]]
            r += tables[1][pair[2 : 2 + STRIDE * m : STRIDE]]
            r += tables[2][pair[4 : 4 + STRIDE * m : STRIDE]]
            r = r.reshape(b - a, BLOCK, FILTERS)
            r[last[(last >= a) & (last < b)] - a, BLOCK - (WIDTH - STRIDE) // STRIDE :] = -np.inf  # they reach into the next text
            top[a:b] = r.max(axis=1)
            if where:
                place[a:b] = r.argmax(axis=1)
        return (top, place) if where else top

    def forward(self, block_max: np.ndarray, n_blocks: np.ndarray):
        """Probability logits per text and what the gradient needs."""
        h = np.maximum(block_max + self.bias, 0)
        first = np.cumsum(n_blocks) - n_blocks
        after = np.minimum(np.arange(len(h)) + 1, np.repeat(first + n_blocks - 1, n_blocks))
        chunk = np.maximum(h, h[after])
        mean = np.add.reduceat(chunk, first) / n_blocks[:, None]
        x = np.concatenate([mean, np.maximum.reduceat(chunk, first)], axis=1)
        z = np.tanh(x @ self.w1 + self.b1)
        return z @ self.w2 + self.b2[0], (h, first, after, chunk, x, z)

    def score(self, data: np.ndarray, offsets: np.ndarray, tables=None) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(offsets) - 1, self.constant)
        classes, n_blocks = blocks(data, offsets)
        logit, _ = self.forward(self.pooled(classes, n_blocks, tables), n_blocks)
        return 1.0 / (1.0 + np.exp(-(logit.astype(np.float64) + self.shift)))

    def fit(self, texts: list[bytes], labels: np.ndarray, steps: int = 900, rate: float = 0.008, batch: int = 64, seed: int = 11) -> None:
        """Adam on the cross entropy; the sample is bounded by the caller.  One label or none gives a constant."""
        if len(set(labels.tolist())) < 2:
            self.constant = float((labels.sum() + 1) / (len(labels) + 2))
            return
        rng, params = np.random.default_rng(seed), self.params()
        # Short pieces of every text, so that short texts are judged as surely as long ones.
        starts = [int(rng.integers(0, max(1, len(t) - 16))) for t in texts]
        texts = texts + [t[a : a + int(rng.integers(16, 160))] for t, a in zip(texts, starts, strict=True)]
        labels = np.concatenate([labels, labels])
        m1, m2 = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        order = np.zeros(0, np.int64)
        for t in range(1, steps + 1):
            if len(order) < batch:
                order = np.concatenate([order, rng.permutation(len(texts))])
            pick, order = order[:batch], order[batch:]
            grads = self._gradient([texts[k] for k in pick], labels[pick])
            step = rate * min(1.0, 4.0 * (1 - t / (steps + 1)), t / 20)
            for p, g, a, b in zip(params, grads, m1, m2, strict=True):
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                p -= step * (a / (1 - 0.9**t)) / (np.sqrt(b / (1 - 0.999**t)) + 1e-6)

    def _gradient(self, texts: list[bytes], labels: np.ndarray) -> list[np.ndarray]:
        data = np.frombuffer(b"".join(texts), np.uint8)
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in texts])])
        classes, n_blocks = blocks(data, offsets)
        n = int(n_blocks.sum())
        top, place = self.pooled(classes, n_blocks, where=True)
        logit, (h, first, after, chunk, x, z) = self.forward(top, n_blocks)
        d = ((1.0 / (1.0 + np.exp(-logit)) - labels) / len(labels)).astype(np.float32)
        dz = d[:, None] * self.w2 * (1 - z * z)
        dx = dz @ self.w1.T
        owner = np.repeat(np.arange(len(texts)), n_blocks)
        is_top = chunk >= x[owner, FILTERS:] - 1e-7
        dchunk = dx[owner, :FILTERS] / n_blocks[owner][:, None] + is_top * dx[owner, FILTERS:] / np.add.reduceat(is_top, first, dtype=np.int64)[owner]
        left = h >= h[after]
        dh = dchunk * left
        np.add.at(dh, after, dchunk * ~left)
        dh *= h > 0
        dconv = np.zeros(WIDTH * CLASSES * FILTERS)
        at = (np.arange(n)[:, None] * BLOCK + place) * STRIDE
        for j in range(WIDTH):
            key = (j * CLASSES + classes[at + j].astype(np.int64)) * FILTERS + np.arange(FILTERS)
            dconv += np.bincount(key.ravel(), weights=dh.ravel(), minlength=len(dconv))
        return [dconv.reshape(self.conv.shape).astype(np.float32), dh.sum(axis=0), x.T @ dz, dz.sum(axis=0), z.T @ d, d.sum(keepdims=True)]


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", per_label: int = SAMPLE_PER_LABEL) -> ByteConvNet:
    """Train on at most ``per_label`` rows of each label whose crc32(doc_id as text) mod 5 is not 0.

    Where rows share an id, the text of least MD5 stands for it, so the sample is the same in every run.
    """
    known = labels.select(F.col("doc_id").alias("id"), F.col("quality").alias("y")).where("id is not null and y in (0, 1)").groupBy("id").agg(F.max("y").alias("y"))
    known = known.where(F.crc32(F.col("id").cast("string").cast("binary")) % 5 != 0)
    rank = F.xxhash64("id")
    pick = known.where("y = 1").orderBy(rank, "id").limit(per_label).unionByName(known.where("y = 0").orderBy(rank, "id").limit(per_label))
    total = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text")).join(F.broadcast(pick), "id")
    one = rows.groupBy("id", "y").agg(F.min_by("text", F.md5(F.col("text").cast("binary"))).alias("text"))
    sample = sorted((r["id"], r["text"], r["y"]) for r in one.collect())
    net, y = ByteConvNet(), np.array([r[2] for r in sample], dtype=np.float32)
    net.fit([r[1].encode() for r in sample], y)
    if net.constant is None:  # from the sample's share of labels to that of all labels
        net.shift = float(np.log(total[1] / total[0]) - np.log(y.sum() / (len(y) - y.sum())))
    return net


def score_quality(docs: DataFrame, net: ByteConvNet, text_col: str = "text", out: str = "score") -> DataFrame:
    """All columns of ``docs`` and ``out``: the probability that the text is of quality 1.

    Whole texts are scored, null like an empty text (one padded block).  An
    existing column named like ``out`` is replaced.
    """
    ship_package(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(net)
    rows = docs.drop(out)
    at, names = rows.columns.index(text_col), rows.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)

    def scan(batches):
        own = model.value
        tables = own.tables()
        for batch in batches:
            col = batch.column(at)
            parts = [own.score(*text_bytes(col.slice(i, n)), tables) for i, n in text_slices(col, 1 << 18)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(parts) if parts else np.zeros(0))], [*names, out])

    return rows.mapInArrow(scan, f"{schema}, `{out}` double")
