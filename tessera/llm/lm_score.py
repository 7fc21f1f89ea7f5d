"""Language-model scores: a hashed maximum-entropy model with a class-factored softmax.

p(word | context) = p(class | context) * p(word | class).

* Words are dealt into classes of about equal token mass by falling frequency;
  the end of a text has a class of its own, and so have rare and unknown words.
* p(class | context) is a softmax over sparse features: the previous word, the
  word before it (a skip feature), both words together, and the classes of
  both.  Words are hashed into a fixed number of feature rows.
* p(word | class) has bias features only, whose best fit is known: smoothed
  relative counts over all training documents.

The weights are trained by distributed gradient updates: in every round each
task sums the gradient over its documents of that round, Spark adds the sums
up, and the driver takes one diagonally scaled step on the (fixed size)
weights.  Every training document is used in one round.  Scores are computed
in numpy batches of sparse look-ups.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import ship_package, store, text_slices
from tessera.llm.text import BLANK_WORDS, U64, mix, text_bytes, words

CLASSES = 32
END_CLASS, RARE_CLASS = 0, CLASSES - 1
END, BEGIN = U64(0x5E9D_0F7E_17A1_0001), U64(0x5E9D_0F7E_17A1_0002)  # stand for the end of a text and for what is before it
#: Feature rows of the four templates: previous word, the one before, both, both classes.
ROWS = (4096, 2048, 4096, CLASSES * CLASSES)
FIRST = np.concatenate([[0], np.cumsum(ROWS)])
#: Most words whose counts and classes every task holds (17 bytes each); the counts of rarer ones are joined.
MAX_WORDS = 500_000
ROUNDS, RATE = 3, 0.4
FIXED = 1 << 16  # gradients are added up as whole numbers of 1 / FIXED, so that the order of addition doesn't matter
PART = 1 << 15  # tokens handled by one softmax step


def sequences(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all tokens (each text's words, then its end), their text numbers and places in the text."""
    hashes, row, counts = words(*text_bytes(column), BLANK_WORDS)
    ends = np.cumsum(counts)
    n = len(counts)
    seq, row = np.insert(hashes, ends, END), np.insert(row, ends, np.arange(n))
    return seq, row, np.arange(len(seq)) - np.repeat(ends - counts + np.arange(n), counts + 1)


@dataclass
class Vocabulary:
    """Counts over the training tokens; ``words`` are the sorted hashes of the words that tasks hold."""

    words: np.ndarray
    counts: np.ndarray
    classes: np.ndarray
    class_mass: np.ndarray  # tokens + distinct words of each class (+ 1 unknown word in the rare class)
    class_tokens: np.ndarray
    tokens: int
    distinct: int

    def look_up(self, seq: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(count, class) of each token; words that are not held count 0 and are rare."""
        if not len(self.words):
            return np.zeros(len(seq), np.int64), np.full(len(seq), RARE_CLASS, np.uint8)
        keys, inverse = np.unique(seq, return_inverse=True)
        at = np.minimum(np.searchsorted(self.words, keys), len(self.words) - 1)
        held = self.words[at] == keys
        return np.where(held, self.counts[at], 0)[inverse], np.where(held, self.classes[at], RARE_CLASS).astype(np.uint8)[inverse]


def features(seq: np.ndarray, place: np.ndarray, cls: np.ndarray) -> list[np.ndarray]:
    """Feature rows of every token, one array per template."""
    one, two = np.roll(seq, 1), np.roll(seq, 2)
    one[place < 1], two[place < 2] = BEGIN, BEGIN
    c1, c2 = np.roll(cls, 1).astype(np.int64), np.roll(cls, 2).astype(np.int64)
    c1[place < 1], c2[place < 2] = END_CLASS, END_CLASS
    hashed = (mix(one ^ U64(1)), mix(two ^ U64(2)), mix(one * U64(3) + mix(two)))
    return [(h % U64(n)).astype(np.int64) + f for h, n, f in zip(hashed, ROWS, FIRST, strict=False)] + [c1 * CLASSES + c2 + FIRST[3]]


def class_probabilities(weights: np.ndarray, bias: np.ndarray, rows: list[np.ndarray]) -> np.ndarray:
    z = weights[rows[0]]
    for r in rows[1:]:
        z += weights[r]
    z += bias
    z -= z.max(axis=1, keepdims=True)
    np.exp(z, out=z)
    z /= z.sum(axis=1, keepdims=True)
    return z


def _count(batches):
    """(hash, n) of the tokens, merged over what a task reads."""
    held, size = [], 0

    def merged():
        keys, inverse = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
        return keys, np.bincount(inverse, weights=np.concatenate([c for _, c in held])).astype(np.int64)

    def row(keys, n):
        return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n)], ["hash", "n"])

    for batch in batches:
        for i, k in text_slices(batch.column(0)):
            held.append(np.unique(sequences(batch.column(0).slice(i, k))[0], return_counts=True))
            size += len(held[-1][0])
            if size > 2_000_000:
                held = [merged()]
                size = len(held[0][0])
                if size > 1_000_000:
                    yield row(*held[0])
                    held, size = [], 0
    if held:
        yield row(*merged())


def read_vocabulary(texts: DataFrame, max_words: int = MAX_WORDS) -> tuple[Vocabulary, DataFrame]:
    """Counts of all tokens of ``texts (text)``: (what tasks hold, the table (hash, n) of all words)."""
    counts = store(texts.mapInArrow(_count, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n")), "lm-counts")
    floors = [1 << k for k in range(48)]
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"), *[F.count_if(F.col("n") >= m).alias(f"from_{m}") for m in floors]).first()
    floor = next(m for m in floors if total[f"from_{m}"] <= max_words)
    end = int(np.array([END]).view(np.int64)[0])
    held = counts.where((F.col("n") >= floor) | (F.col("hash") == end)).toArrow()  # at most max_words + 1 rows
    keys, n = held["hash"].to_numpy().view(U64), held["n"].to_numpy().astype(np.int64)
    order = np.lexsort((keys, -n))
    mass = np.cumsum(n[order]) - n[order]
    cls = np.empty(len(n), np.uint8)
    cls[order] = 1 + np.minimum(mass * (CLASSES - 2) // max(1, int(n.sum())), CLASSES - 3)
    cls[keys == END] = END_CLASS
    tokens, distinct = int(total["tokens"]), int(total["from_1"])
    class_tokens = np.bincount(cls, weights=n, minlength=CLASSES)
    class_mass = class_tokens + np.bincount(cls, minlength=CLASSES)
    class_tokens[RARE_CLASS] = tokens - n.sum()
    class_mass[RARE_CLASS] = class_tokens[RARE_CLASS] + distinct - len(n) + 1
    at = np.argsort(keys)
    return Vocabulary(keys[at], n[at], cls[at], class_mass, class_tokens, tokens, distinct), counts


def _gradient(vocabulary, weights, bias):
    names = ["row", "n", *[f"c{i}" for i in range(CLASSES)]]

    def scan(batches):
        vocab, w = vocabulary.value, weights.value
        total, seen = np.zeros((FIRST[-1], CLASSES)), np.zeros(FIRST[-1])
        for batch in batches:
            for i, k in text_slices(batch.column(0)):
                seq, _, place = sequences(batch.column(0).slice(i, k))
                _, cls = vocab.look_up(seq)
                found = features(seq, place, cls)
                for a in range(0, len(seq), PART):
                    rows, own = [f[a : a + PART] for f in found], cls[a : a + PART]
                    error = -class_probabilities(w, bias, rows)
                    error[np.arange(len(own)), own] += 1
                    for r in rows:
                        order = np.argsort(r.astype(np.uint16), kind="stable")  # radix sort
                        keys, first, n = np.unique(r[order], return_index=True, return_counts=True)
                        total[keys] += np.add.reduceat(error[order], first, axis=0)
                        seen[keys] += n
        used = np.flatnonzero(seen)
        sums = np.rint(total[used] * FIXED).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(seen[used].astype(np.int64)), *[pa.array(sums[:, c]) for c in range(CLASSES)]], names)

    return scan


def train(texts: DataFrame, vocab: Vocabulary, rounds: int = ROUNDS, rate: float = RATE) -> tuple[np.ndarray, np.ndarray]:
    """(weights, bias) after ``rounds`` distributed gradient updates; ``texts (text, part)`` with part from 0 to rounds - 1."""
    cast = texts.sparkSession.sparkContext.broadcast
    prior = (vocab.class_tokens + 1) / (vocab.class_tokens.sum() + CLASSES)
    bias, weights = np.log(prior).astype(np.float32), np.zeros((int(FIRST[-1]), CLASSES), np.float32)
    schema = "row long, n long, " + ", ".join(f"c{i} long" for i in range(CLASSES))
    shared = cast(vocab)
    for k in range(rounds):
        part = texts.where(F.col("part") == k).select("text")
        sums = part.mapInArrow(_gradient(shared, cast(weights), bias), schema).groupBy("row").agg(F.sum("n"), *[F.sum(f"c{i}") for i in range(CLASSES)])
        got = sums.toArrow()  # at most one row per feature row
        at, n = got.column(0).to_numpy(), got.column(1).to_numpy().astype(float)
        g = np.stack([got.column(2 + c).to_numpy() for c in range(CLASSES)], axis=1) / FIXED if len(at) else np.zeros((0, CLASSES))
        weights[at] += (rate * g / (n[:, None] * prior * (1 - prior) + 2.0)).astype(np.float32)
    return weights, bias


def _repeats(row: np.ndarray, seq: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place of one token of each (row, word), how often the row has the word)."""
    order = np.lexsort((seq, row))
    r, h = row[order], seq[order]
    first = np.flatnonzero(np.append(True, (r[1:] != r[:-1]) | (h[1:] != h[:-1]))) if len(r) else np.zeros(0, np.int64)
    return order[first], np.diff(np.append(first, len(r)))


def _score(vocabulary, weights, bias):
    names = ["doc_id", "mark", "n_tokens", "n_known", "base", "model", "hash", "times"]

    def scan(batches):
        vocab, w = vocabulary.value, weights.value
        in_class, scale = np.log10(vocab.class_mass.clip(1)), np.log10(vocab.tokens + vocab.distinct + 1)
        for batch in batches:
            for i, k in text_slices(batch.column(2)):
                ids, marks = batch.column(0).slice(i, k), batch.column(1).slice(i, k)
                seq, row, place = sequences(batch.column(2).slice(i, k))
                n, cls = vocab.look_up(seq)
                found = features(seq, place, cls)
                seen = np.log10(n + 1.0)
                picked = np.empty(len(seq))
                for a in range(0, len(seq), PART):
                    own = cls[a : a + PART]
                    picked[a : a + PART] = class_probabilities(w, bias, [f[a : a + PART] for f in found])[np.arange(len(own)), own]
                model = seen + np.log10(picked.clip(1e-30)) - in_class[cls]
                size = np.bincount(row, minlength=k)
                sums = [size, np.bincount(row, weights=n > 0, minlength=k).astype(np.int64), np.bincount(row, weights=seen, minlength=k) - size * scale]
                sums.append(np.bincount(row, weights=model, minlength=k))
                none = pa.nulls(k, pa.int64())
                yield pa.RecordBatch.from_arrays([ids, marks, *[pa.array(x) for x in sums], none, none], names)
                rest = np.flatnonzero(n == 0)  # rare words, whose counts are in the table only, and unknown ones
                words_in, times = _repeats(row[rest], seq[rest])
                pick = pa.array(row[rest][words_in])
                nothing = [pa.nulls(len(times), t) for t in (pa.int64(), pa.int64(), pa.float64(), pa.float64())]
                yield pa.RecordBatch.from_arrays([ids.take(pick), marks.take(pick), *nothing, pa.array(seq[rest][words_in].view(np.int64)), pa.array(times)], names)

    return scan


def score_texts(
    docs: DataFrame, learn_from, id_col: str = "doc_id", text_col: str = "text", max_words: int = MAX_WORDS, rounds: int = ROUNDS
) -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score`` for every row of ``docs``.

    ``learn_from`` is a condition on the id column that says which rows are
    learned from (null counts as true).  base_score is the add-one unigram log10
    probability, score the model's log10 probability of the text; both include
    its end.  Null and empty texts have one token, their end.  Rows that share
    an id are scored each for itself.  With nothing to learn from, every word
    is unknown.  Words are told apart by 64-bit hashes.
    """
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.coalesce(learn_from, F.lit(True)).alias("learn"))
    texts = rows.where("learn").select("text", F.pmod(F.xxhash64("doc_id"), F.lit(rounds)).alias("part"))
    vocab, counts = read_vocabulary(texts.select("text"), max_words)
    weights, bias = train(texts, vocab, rounds)
    cast = spark.sparkContext.broadcast
    schema = "doc_id long, mark long, n_tokens long, n_known long, base double, model double, hash long, times long"
    scored = rows.select("doc_id", F.xxhash64("text").alias("mark"), "text").mapInArrow(_score(cast(vocab), cast(weights), bias), schema)
    scored = store(scored, "lm-scored")
    # A word that tasks don't hold adds log10(count + 1) to both scores; its other terms are in already.
    rest = scored.where("hash is not null").distinct().join(counts, "hash")
    rest = rest.groupBy("doc_id", "mark").agg(F.sum("times").alias("k"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("s")).alias("r")
    own = scored.where("hash is null").alias("o").join(rest, F.expr("o.doc_id <=> r.doc_id and o.mark = r.mark"), "left")
    known, add = F.col("n_known") + F.coalesce("k", F.lit(0)), F.coalesce("s", F.lit(0.0))
    scored = own.select("o.doc_id", "n_tokens", known.alias("n_known"), (F.col("base") + add).alias("base"), (F.col("model") + add).alias("model"))
    return scored.select("doc_id", "n_tokens", "n_known", F.lit(vocab.tokens).cast("long").alias("train_tokens"), F.col("base").alias("base_score"), F.col("model").alias("score"))
