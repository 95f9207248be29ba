"""Toxicity by a logistic model over words, regularised with counterfactual sentences.

Words and beginnings of words that tell the classes apart best are found by grouped counts over a
bounded sample of the labelled texts, then weights are fitted on that sample. In every sampled text that names a group, the
name is swapped for each other name of its kind and for a neutral noun; the squared change of the
score's logit over all swaps is a penalty. So a name alone moves no score, and texts that mention a
group neutrally are not taken for toxic.

Only texts are inputs of a score, and all words of a text count. Null and empty texts have the
score of a text without known words. Labels that are null, or whose document is missing, teach
nothing; a document labelled twice is toxic if one label says so. Without labels of both classes
every score is the smoothed share of toxic ones. Rows may repeat. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opinarium.llm.arrays import mapped, Block, block_of, blocks, byte_class, mixed, span_hashes, spans
from opinarium.session import stored

#: At most so many labelled texts are sampled, lowest hash of the id first.
SAMPLE_ROWS = 8_000
#: So many words and beginnings are weighed, besides names of groups.
FEATURES = 512
#: Beginnings have so many bytes; forms of a word that the sample lacks are known by them.
BEGINNINGS = (4, 5)
LEAST_TEXTS = 3
RIDGE = 2e-4
SWAP_PENALTY = 1.0
STEPS = 400
THRESHOLD = 0.3

# Names of groups by kind, each kind with a neutral noun first.
GROUPS = (
    ("people", "women", "men", "girls", "boys", "frauen", "männer", "femmes", "hommes", "mujeres", "hombres"),
    ("person", "woman", "man", "girl", "boy", "lady", "transgender"),
    ("people", "muslims", "christians", "jews", "hindus", "buddhists", "atheists", "catholics"),
    ("person", "muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "catholic"),
    ("people", "immigrants", "refugees", "foreigners", "africans", "asians", "europeans", "mexicans", "arabs"),
    ("person", "immigrant", "refugee", "foreigner", "african", "asian", "european", "mexican", "arab"),
    ("person", "gay", "lesbian", "bisexual", "straight", "queer"),
    ("person", "black", "white", "latino", "indigenous"),
    ("person", "disabled", "blind", "deaf", "autistic", "elderly", "young"),
)

_WORD = byte_class((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFE))


@dataclass
class Model:
    """``words`` are sorted hashes; each present word adds its weight to ``bias``."""

    words: np.ndarray
    weights: np.ndarray
    bias: float

    def scores(self, block: Block) -> np.ndarray:
        logit = np.full(len(block), self.bias)
        rows, features = present(block, self.words)
        np.add.at(logit, rows, self.weights[features])
        return 1.0 / (1.0 + np.exp(-np.clip(logit, -500, 500)))


def _words(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every word, and of the beginnings of longer words."""
    block = block.lowered()
    starts, ends = spans(block.data, _WORD)
    rows, hashes = [block.rows_of(starts)], [span_hashes(block.data, starts, ends)]
    for size in BEGINNINGS:
        longer = ends - starts > size
        rows.append(rows[0][longer])
        begin = starts[longer]
        hashes.append(mixed(span_hashes(block.data, begin, begin + size) ^ np.uint64(size)))
    return np.concatenate(rows), np.concatenate(hashes)


def word_hashes(word: str) -> list[int]:
    """The hash of a word, then those of its beginnings."""
    return [int(h) for h in _words(block_of([word]))[1]]


def present(block: Block, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a row and a known word that its text has, each once."""
    if not len(words):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    rows, hashes = _words(block)
    place = np.minimum(np.searchsorted(words, hashes), len(words) - 1)
    known = words[place] == hashes
    pairs = np.unique(rows[known].astype(np.int64) * len(words) + place[known])
    return pairs // len(words), pairs % len(words)


def held_out(doc_id: Column) -> Column:
    """Whether labels of this id are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _sample(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """The sampled texts with their labels, written once."""
    usable = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    usable = usable.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    chosen = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    # As many ids as the sample has rows at most.
    return stored(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "toxic"),
                  "toxicity-sample")


def _word_counts(sample: DataFrame) -> DataFrame:
    """Per word: in how many toxic and other texts it is."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = batch.column("toxic").to_numpy() > 0
            for block in blocks(batch.column("text")):
                rows, hashes = _words(block)
                order = np.lexsort((hashes, rows))
                rows, hashes = rows[order], hashes[order]
                first = np.append(True, (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1]))[:len(rows)]
                rows, hashes = rows[first], hashes[first]
                words, which = np.unique(hashes, return_inverse=True)
                bad = np.bincount(which, weights=toxic[block.first + rows], minlength=len(words)).astype(np.int64)
                total = np.bincount(which, minlength=len(words))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(words.view(np.int64)), pa.array(bad), pa.array(total - bad)], ["word", "bad", "good"])

    return mapped(sample, run, "word long, bad long, good long").groupBy("word").agg(
        F.sum("bad").alias("bad"), F.sum("good").alias("good"))


def _matrix(sample: DataFrame, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which known words each sampled text has, and its label. Bounded by sample and features."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column("text")):
                rows, features = present(block, words)
                cut = np.searchsorted(rows, np.arange(len(block) + 1))
                yield pa.RecordBatch.from_arrays([
                    pa.array([features[a:b].astype(np.int16).tobytes() for a, b in zip(cut, cut[1:])], pa.binary()),
                    batch.column("toxic").slice(block.first, len(block))], ["features", "toxic"])

    rows = mapped(sample, run, "features binary, toxic int").collect()
    table = np.zeros((len(rows), len(words)), dtype=np.float32)
    for i, row in enumerate(rows):
        table[i, np.frombuffer(row["features"], np.int16)] = 1
    return table, np.array([r["toxic"] > 0 for r in rows], dtype=np.float32)


def _swaps(table: np.ndarray, words: np.ndarray, groups) -> np.ndarray:
    """The matrix S for which w' S w is the mean squared change of the logit over all swaps."""
    index = {int(w): i for i, w in enumerate(words)}
    result, count = np.zeros((len(words), len(words))), 0
    for group in groups:
        own = [[i for h in word_hashes(w) if (i := index.get(h)) is not None] for w in group]
        own = [features for w, features in zip(group, own) if word_hashes(w)[0] in index]
        for a in own:
            for b in own:
                if a is b or not (n := int((table[:, a[0]] * (1 - table[:, b[0]])).sum())):
                    continue
                change = np.zeros(len(words))
                change[a] += 1
                change[b] -= 1
                result += n * np.outer(change, change)
                count += n
    return result / max(1, count)


def fit(table: np.ndarray, label: np.ndarray, swaps: np.ndarray, ridge: float = RIDGE,
        swap_penalty: float = SWAP_PENALTY, steps: int = STEPS) -> tuple[np.ndarray, float]:
    """Weights and bias by accelerated gradient steps on the penalised logistic loss.

    The bias is moved so that ``THRESHOLD`` is where the sample's classes are told apart best.
    """
    rows, count = table.shape
    share = (label.sum() + 1) / (rows + 2)
    weights, bias = np.zeros(count), float(np.log(share / (1 - share)))
    if not rows or label.min() == label.max():
        return weights, bias
    curve = 0.25 * (1 + float((table ** 2).sum(axis=1).max())) + ridge \
        + 2 * swap_penalty * (float(np.linalg.eigvalsh(swaps).max()) if count else 0)
    step, ahead, ahead_bias = 1 / min(curve, 12 + 2 * swap_penalty), weights.copy(), bias
    for t in range(1, steps + 1):
        miss = 1 / (1 + np.exp(-(table @ ahead + ahead_bias))) - label
        slope = table.T @ miss / rows + ridge * ahead + 2 * swap_penalty * (swaps @ ahead)
        new, new_bias = ahead - step * slope, ahead_bias - step * float(miss.mean())
        pull = (t - 1) / (t + 2)
        ahead, ahead_bias = new + pull * (new - weights), new_bias + pull * (new_bias - bias)
        weights, bias = new, new_bias
    logit = table @ weights + bias
    order = np.argsort(-logit)
    hits = np.cumsum(label[order])
    f1 = 2 * hits / (np.arange(1, rows + 1) + label.sum())
    best = int(np.argmax(f1))
    lower = logit[order[best + 1]] if best + 1 < rows else logit[order[best]] - 1
    cut = (logit[order[best]] + lower) / 2
    return weights, bias - float(cut) + float(np.log(THRESHOLD / (1 - THRESHOLD)))


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, features: int = FEATURES,
          groups=GROUPS) -> Model:
    """Fits a model on the sampled labelled texts. Features that count are in several texts."""
    sample = _sample(docs, labels, sample_rows)
    totals = sample.agg(F.coalesce(F.sum((F.col("toxic") > 0).cast("long")), F.lit(0)).alias("bad"),
                        F.count("*").alias("n")).first()
    bad, good = totals["bad"], totals["n"] - totals["bad"]
    chosen: set[int] = {word_hashes(w)[0] for group in groups for w in group}
    if bad and good:
        a, b = F.col("bad"), F.col("good")
        spread = F.pow(a * good - b * bad, F.lit(2.0)) / ((a + b) * (bad + good - a - b + 1))
        best = _word_counts(sample).filter(a + b >= LEAST_TEXTS).orderBy(spread.desc(), "word").limit(features)
        chosen |= {r["word"] & 0xFFFFFFFFFFFFFFFF for r in best.collect()}
    words = np.array(sorted(chosen), dtype=np.uint64)
    table, label = _matrix(sample, words)
    weights, bias = fit(table, label, _swaps(table, words, groups))
    return Model(words, weights, bias)


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    schema = T.StructType([docs.schema["doc_id"]]).add("score", T.DoubleType())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column("text")):
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(block.first, len(block)),
                                                  pa.array(model.scores(block))], schema.names)

    scored = mapped(docs.select("doc_id", "text"), run, schema)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score_documents(docs, train(docs, labels))
