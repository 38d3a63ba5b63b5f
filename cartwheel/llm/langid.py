"""Operator 4: language identification.

A text's byte n-grams within words are hashed to embeddings, whose average
feeds a linear softmax. The model is trained in numpy by stochastic gradient
descent on snippets of a bounded sample of labelled rows:
``ROWS_PER_LANG`` rows of each language, in hash order, and
``SNIPPETS_PER_ROW`` snippets of up to ``SNIPPET_WORDS`` words from anywhere in
each text. A fifth of the rows is set aside to calibrate: a temperature makes
the scores probabilities, and two thresholds reject. One is on how usual a
text's n-grams are (the mean log frequency of their buckets in training): the
least of the snippets set aside, less ``SPARE`` standard deviations. It catches
other scripts, other languages and gibberish, which a softmax shares out among
the languages it knows. The other is on the score: the highest at which none of
the rightly predicted snippets would go, at most ``OVER_CHANCE`` times chance.
Texts of a known language that are unlike the sample stay.

Averages and the softmax's input are linear in the embeddings, so prediction
uses their product, one row of logits for each hash bucket, which goes to the
executors (``BUCKETS`` x languages numbers). It reads every byte of every text.

Defined results: a text that is null or has no letter is ``und`` with score 0;
so is every text where no row is labelled (``drop_rejected`` then drops the
letterless alone); more than ``MAX_LANGS`` languages are an error; rows with a null id are predicted
but never learned from; of the rows of one id and language the least text is
learned from; repeated rows get equal results; an empty table gives
an empty table; other columns are ignored.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.llm.common import id_and_text, map_slices

#: The bound of the training sample: rows of a language, snippets of a row, words of a snippet.
ROWS_PER_LANG, SNIPPETS_PER_ROW, SNIPPET_WORDS = 800, 6, 50
#: Longest snippet, in characters.
SNIPPET_CHARS = 600
#: Rejected texts score less than this many times an even share among the languages.
OVER_CHANCE = 1.5
#: Standard deviations below the least usual snippet set aside that still pass; languages at most.
SPARE, MAX_LANGS = 3.0, 1000
BUCKETS, DIM, EPOCHS, BATCH, RATE = 1 << 16, 16, 4, 32, 0.5
GRAMS = (3, 4)
#: Bytes whose n-grams are held at once.
WINDOW = 1 << 18
UNKNOWN = "und"


def _letters() -> np.ndarray:
    keep = np.arange(256, dtype=np.uint8)
    small = (keep >= ord("a")) & (keep <= ord("z"))
    return np.where(small | (keep >= 128), keep, 32).astype(np.uint8)


LETTERS = _letters()


def gram_buckets(data: np.ndarray, starts: int) -> tuple[np.ndarray, np.ndarray]:
    """Start positions (below ``starts``) and buckets of the n-grams within
    words and their borders, in order of position for each n."""
    at, bucket = [], []
    for n in GRAMS:
        m = min(starts, len(data) - n + 1)
        if m <= 0:
            continue
        value, inside = data[:m].astype(np.uint32), np.ones(m, bool)
        for k in range(1, n):
            value |= data[k:m + k].astype(np.uint32) << np.uint32(8 * k)
            if k < n - 1:
                inside &= data[k:m + k] != 32
        found = np.flatnonzero(inside)
        value = value[found] * np.uint32(2654435761) + np.uint32(n)
        at.append(found)
        bucket.append((value ^ value >> np.uint32(15)) * np.uint32(2246822519) >> np.uint32(16))
    return (np.concatenate(at), np.concatenate(bucket)) if at else (np.empty(0, int), np.empty(0, np.uint32))


def to_bytes(text: str) -> bytes:
    return b" " + text.lower().encode() + b" "


def gram_lists(texts: list[str]) -> list[np.ndarray]:
    out = []
    for t in texts:
        data = LETTERS[np.frombuffer(to_bytes(t), np.uint8)]
        out.append(gram_buckets(data, len(data))[1])
    return out


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


@dataclass
class Model:
    langs: list[str]
    table: np.ndarray           # a row of logits for each bucket
    bias: np.ndarray
    usual: np.ndarray           # log frequency of each bucket in training
    temperature: float = 1.0
    threshold: float = 0.0
    least_usual: float = -np.inf

    def logits(self, texts: list[str]) -> np.ndarray:
        return self.measure(texts)[0]

    def measure(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Logits of whole texts and how usual their n-grams are (0 where there
        is none), some megabytes of n-grams at a time."""
        sums, counts = np.zeros((len(texts), len(self.langs) + 1)), np.zeros(len(texts))
        group, size = [], 0
        for k, t in enumerate(texts):
            raw = to_bytes(t)
            group.append((k, raw))
            size += len(raw)
            if size >= WINDOW or k == len(texts) - 1:
                self._add(group, sums, counts)
                group, size = [], 0
        means = sums / np.maximum(counts, 1)[:, None]
        return means[:, :-1] + self.bias, means[:, -1]

    def _add(self, group: list, sums: np.ndarray, counts: np.ndarray) -> None:
        data = LETTERS[np.frombuffer(b"".join(raw for _, raw in group), np.uint8)]
        edges = np.cumsum([0, *(len(raw) for _, raw in group)])
        rows = np.array([k for k, _ in group])
        for s in range(0, len(data), WINDOW):
            at, bucket = gram_buckets(data[s:s + WINDOW + max(GRAMS) - 1], min(WINDOW, len(data) - s))
            owner = np.searchsorted(edges, at + s, "right") - 1
            counts[rows] += np.bincount(owner, minlength=len(rows))
            for lang in range(len(self.langs)):
                sums[rows, lang] += np.bincount(owner, self.table[bucket, lang], len(rows))
            sums[rows, -1] += np.bincount(owner, self.usual[bucket], len(rows))

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Languages, calibrated scores, and which texts are rejected."""
        known = np.array([has_letter(t) for t in texts], bool)
        if not self.langs:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), ~known
        logits, usual = self.measure(texts)
        p = softmax(logits / self.temperature)
        best, score = p.argmax(axis=1), p.max(axis=1)
        rejected = ~known | (score < self.threshold) | (usual < self.least_usual)
        return [self.langs[b] if k else UNKNOWN for b, k in zip(best, known)], np.where(known, score, 0.0), rejected


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(snippets: list[tuple[str, str, bool]], seed: int = 7) -> Model:
    """A model from (text, language, for calibration)."""
    langs = sorted({lang for _, lang, _ in snippets})
    if not langs:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0), np.zeros(BUCKETS))
    if len(langs) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    rng = np.random.default_rng(seed)
    grams = gram_lists([t for t, _, _ in snippets])
    label = np.array([langs.index(lang) for _, lang, _ in snippets])
    aside = np.array([c for _, _, c in snippets])
    some = np.array([len(g) > 0 for g in grams])
    learn = np.flatnonzero(some & ~aside)
    embed = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    weight, bias = np.zeros((DIM, len(langs)), np.float32), np.zeros(len(langs), np.float32)
    steps, step = EPOCHS * -(-len(learn) // BATCH), 0
    for _ in range(EPOCHS):
        order = rng.permutation(learn)
        for at in range(0, len(order), BATCH):
            rows = order[at:at + BATCH]
            size = np.array([len(grams[r]) for r in rows])
            flat = np.concatenate([grams[r] for r in rows])
            starts = np.cumsum([0, *size[:-1]])
            hidden = np.add.reduceat(embed[flat], starts, axis=0) / size[:, None].astype(np.float32)
            error = softmax(hidden @ weight + bias)
            error[np.arange(len(rows)), label[rows]] -= 1
            rate = np.float32(RATE * (1 - step / steps))
            back = (error @ weight.T / size[:, None]).astype(np.float32)
            weight -= rate * (hidden.T @ error).astype(np.float32)
            bias -= rate * error.sum(axis=0).astype(np.float32)
            np.subtract.at(embed, flat, np.repeat(rate * back, size, axis=0))
            step += 1
    seen = sum((np.bincount(grams[r], minlength=BUCKETS) for r in learn), np.zeros(BUCKETS))
    usual = np.log((seen + 0.1) / (seen.sum() + 0.1 * BUCKETS))
    model = Model(langs, (embed @ weight).astype(np.float32), bias.astype(float), usual)
    held = np.flatnonzero(some & aside)
    if len(held):
        _calibrate(model, [snippets[h][0] for h in held], label[held])
    return model


def _calibrate(model: Model, texts: list[str], label: np.ndarray) -> None:
    logits, usual = model.measure(texts)
    model.least_usual = float(usual.min() - SPARE * usual.std())
    rows = np.arange(len(texts))
    loss = {t: -np.log(softmax(logits / t)[rows, label] + 1e-12).mean() for t in np.geomspace(0.1, 10, 41)}
    model.temperature = float(min(loss, key=loss.get))
    p = softmax(logits / model.temperature)
    right = p.max(axis=1)[p.argmax(axis=1) == label]
    model.threshold = min(float(right.min(initial=1.0)), OVER_CHANCE / len(model.langs)) if len(right) else 0.0


def held_out(doc_id: Column) -> Column:
    """Rows that the model never learns from: a quarter, and null ids."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(True))


def _snippets(batch: pa.RecordBatch) -> pa.RecordBatch:
    texts, langs, asides = [], [], []
    for text, lang, aside in zip(*(c.to_pylist() for c in batch.columns)):
        words = text.split()
        if words:
            rng = np.random.default_rng(zlib.crc32(text.encode()))
            for size in rng.integers(1, SNIPPET_WORDS + 1, SNIPPETS_PER_ROW):
                at = int(rng.integers(0, max(1, len(words) - size + 1)))
                texts.append(" ".join(words[at:at + size])[:SNIPPET_CHARS])
                langs.append(lang)
                asides.append(aside)
    return pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), pa.array(langs, pa.string()),
                                       pa.array(asides, pa.bool_())], ["text", "lang", "aside"])


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Trains on the bounded sample of labelled rows that aren't held out."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & ~held_out(F.col("doc_id"))).withColumn("h", F.xxhash64("doc_id"))
    # Ids are ranked only among the lowest hashes, some four times as many as are wanted of each language:
    # what meets in a task doesn't grow with the table. (A row for each language is broadcast.)
    counts = rows.groupBy("lang").agg(F.count("*").alias("rows_of")).withColumnRenamed("lang", "c_lang")
    if counts.limit(MAX_LANGS + 1).count() > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    share = F.least(F.lit(1.0), 4.0 * ROWS_PER_LANG / F.col("rows_of"))
    low = F.col("h").cast("double") / 2.0 ** 64 + 0.5 <= share
    order = Window.partitionBy("lang").orderBy("h", "doc_id")
    sample = (rows.join(F.broadcast(counts), (F.col("lang") == F.col("c_lang")) & low).dropDuplicates(["doc_id", "lang"])
              .withColumn("k", F.row_number().over(order)).where(F.col("k") <= ROWS_PER_LANG)
              .select(F.col("doc_id").alias("s_id"), F.col("lang").alias("s_lang"), (F.col("k") % 5 == 0).alias("aside")))
    # The sample's size is bounded by ROWS_PER_LANG for each language, whatever the ids.
    texts = (docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).cast("string").alias("lang"),
                         F.col(text_col).cast("string").alias("text")).where("text is not null")
             .join(F.broadcast(sample), (F.col("doc_id") == F.col("s_id")) & (F.col("lang") == F.col("s_lang")))
             .groupBy("doc_id", "lang", "aside").agg(F.min("text").alias("text")).select("text", "lang", "aside"))
    got = map_slices(texts, _snippets, "text string, lang string, aside boolean").collect()
    return train(sorted((r.text, r.lang, r.aside) for r in got))


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score and rejected (no letter, unusual n-grams, or a
    score below the calibrated threshold) of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        m = shared.value
        langs, scores, gone = m.predict(batch.column(1).to_pylist())
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64()),
                                           pa.array(gone, pa.bool_())], ["doc_id", "lang_pred", "score", "rejected"])

    return map_slices(id_and_text(docs, id_col, text_col), run,
                      "doc_id long, lang_pred string, score double, rejected boolean")


def drop_rejected(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text isn't rejected, with all their columns,
    in one pass over them."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        m = shared.value
        gone = m.predict([t or "" for t in batch.column(at).to_pylist()])[2]
        return batch.filter(pa.array(~gone))

    return map_slices(docs, run, docs.schema)
