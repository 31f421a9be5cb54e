"""Toxicity of whole texts by a recurrent network over overlapping windows of their words.

The network (`gru`) is trained here, in one task, on a bounded sample of labelled rows.
Only documents are labelled, and a toxic one may hold a few such words among thousands, so
the training has two parts: first every window takes the label of its document, which is
wrong for most windows of a toxic document but right on the whole; then, pass after pass,
the windows that score highest stand for their document. A document's score is that of its
highest window, brought to a probability on documents that were held back.
"""

import functools
import itertools
import pickle
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholaris.llm import gru
from scholaris.llm.arrow import map_batches, small_batches, texts

WORD = re.compile(rf"\w{{1,{gru.LONGEST}}}")
# A document counts as toxic from this score on.
LEAST = 0.7
# Bytes of text that are cut into words at a time, and words that are looked up at a time.
PIECE = 1 << 18
WORDS = 1 << 15
# Distinct words whose gate inputs a worker keeps, and windows that run at a time.
MOST_KEPT = 150_000
WINDOWS = 1024


@dataclass(frozen=True)
class Training:
    """What bounds the sample, and how the network is trained.

    The sample is the `toxic_rows` and `clean_rows` labelled documents of the least digests
    of their ids, of those whose text has at most `most_chars` characters. One in `held_back`
    serves to set the probabilities.
    """

    toxic_rows: int = 800
    clean_rows: int = 1600
    most_chars: int = 20_000
    held_back: int = 5
    vocabulary: int = 4000
    least_documents: int = 5
    windows: int = 12_000
    first_passes: int = 4
    later_passes: int = 6
    batch: int = 64
    rate: float = 1e-2
    unknown: float = 0.6
    seed: int = 7


def words_of(text: bytes) -> Iterator[str]:
    """The words of a text, lower-case, longer ones in pieces; a very long text is read in parts."""
    if len(text) <= PIECE:
        yield from WORD.findall(text.decode().lower())
        return
    start = 0
    while start < len(text):
        stop = min(start + PIECE, len(text))
        if stop < len(text):
            # At the last blank, or where a code point starts if there is none.
            blank = max(text.rfind(b, start, stop) for b in (b" ", b"\n", b"\t"))
            stop = blank + 1 if blank >= start else stop
            while stop < len(text) and text[stop] & 0xC0 == 0x80:
                stop -= 1
        yield from WORD.findall(text[start:stop].decode().lower())
        start = stop


def starts_of(n: int, shape: gru.Shape) -> np.ndarray:
    """Where the windows of n words start: every step, until all words are in some window."""
    return np.arange(0, max(n - (shape.window - shape.step), 1), shape.step)


def windows_of(rows: np.ndarray, shape: gru.Shape) -> tuple[np.ndarray, np.ndarray]:
    """(windows, lengths) over one text, given as its words' rows."""
    first = starts_of(len(rows), shape)
    lengths = np.minimum(shape.window, len(rows) - first)
    padded = np.zeros(int(first[-1]) + shape.window, np.int64)
    padded[: len(rows)] = rows
    return padded[first[:, None] + np.arange(shape.window)], lengths


def segments_of(text: bytes, shape: gru.Shape, most: int = WORDS) -> Iterator[list[str]]:
    """The words of a text, a long one in parts that share words so that no window is lost."""
    overlap, most = shape.window - shape.step, most // shape.step * shape.step
    if len(text) <= min(PIECE, most + overlap):
        # It has no more words than bytes.
        yield WORD.findall(text.decode().lower())
        return
    words = words_of(text)
    held = list(itertools.islice(words, most + overlap))
    while True:
        more = list(itertools.islice(words, most))
        if not more:
            yield held
            return
        yield held
        held = held[-overlap:] + more


class Model:
    """Weights, the words with an embedding of their own, and the line from logits to probabilities."""

    def __init__(self, weights: dict, numbers: dict[str, int], shape: gru.Shape, slope: float = 1.0, offset: float = 0.0):
        self.weights, self.numbers, self.shape, self.slope, self.offset = weights, numbers, shape, slope, offset

    def rows(self, words: list[str]) -> np.ndarray:
        known = np.array([self.numbers.get(w, 0) for w in words], np.int64)
        return gru.word_rows(self.weights, words, known)[0]

    def gates(self, words: list[str]) -> np.ndarray:
        """The same as `gru.by_gate` has it, at most 4,096 words at a time."""
        known = np.array([self.numbers.get(w, 0) for w in words], np.int64)
        parts = [gru.word_gates(self.weights, words[at : at + 4096], known[at : at + 4096]) for at in range(0, len(words), 4096)]
        return np.concatenate(parts, axis=1) if parts else np.zeros((6, 1, self.shape.state), np.float32)

    def logits(self, table: np.ndarray, windows: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Of windows given by their words' places in `gates`."""
        order = np.argsort(-lengths, kind="stable")
        found = np.empty(len(windows), np.float32)
        for at in range(0, len(windows), WINDOWS):
            part = order[at : at + WINDOWS]
            found[part] = gru.scores(self.weights, table, windows[part], lengths[part])
        return found

    def probability(self, logits: np.ndarray) -> np.ndarray:
        return gru.sigmoid(self.slope * np.asarray(logits, np.float64) + self.offset)


class Scorer:
    """Scores one batch of texts after another; keeps the rows of words it has met."""

    def __init__(self, model: Model, most: int = MOST_KEPT):
        self.model, self.most = model, most
        self.forget()

    def forget(self) -> None:
        self.places: dict[str, int] = {}
        self.table = np.zeros((6, 1, self.model.shape.state), np.float32)

    def look_up(self, words: list[str]) -> np.ndarray:
        """The words' places in the table; new words are run through the character network."""
        found = np.fromiter(map(self.places.get, words, itertools.repeat(-1)), np.int64, len(words))
        missing = np.flatnonzero(found < 0).tolist()
        if not missing:
            return found
        new = {words[i] for i in missing}
        if len(self.places) + len(new) > self.most:
            self.forget()
            new, missing = set(words), range(len(words))
        # In order, so that a batch is the same whenever it is run.
        added, start = sorted(new), len(self.places)
        self.places.update(zip(added, range(start, start + len(added)), strict=True))
        if len(self.places) > self.table.shape[1]:
            room = max(len(self.places), min(2 * len(self.places), self.most))
            grown = np.zeros((6, room, self.table.shape[2]), np.float32)
            grown[:, :start] = self.table[:, :start]
            self.table = grown
        self.table[:, start : start + len(added)] = self.model.gates(added)
        found[missing] = [self.places[words[i]] for i in missing]
        return found

    def __call__(self, given: Iterable[bytes]) -> np.ndarray:
        """The greatest logit of any window of each text."""
        best: list[float] = []
        held: list[tuple[int, list[str]]] = []

        def flush() -> None:
            rows = self.look_up([w for _, words in held for w in words])
            ends = np.cumsum([len(words) for _, words in held])
            cut = [windows_of(part, self.model.shape) for part in np.split(rows, ends[:-1])]
            owner = np.repeat([n for n, _ in held], [len(lengths) for _, lengths in cut])
            windows, lengths = (np.concatenate(x) for x in zip(*cut, strict=True))
            found = np.array(best, np.float32)
            np.maximum.at(found, owner, self.model.logits(self.table, windows, lengths))
            best[:] = found.tolist()
            held.clear()

        waiting = 0
        for number, text in enumerate(given):
            best.append(-np.inf)
            for words in segments_of(text, self.model.shape):
                held.append((number, words))
                waiting += len(words) + 1
                if waiting >= WORDS:
                    flush()
                    waiting = 0
        if held:
            flush()
        return np.array(best, np.float32)


@functools.lru_cache(maxsize=1)
def scorer_of(model: Model) -> Scorer:
    """One for a worker process, so that later tasks find the words of earlier ones."""
    return Scorer(model)


def _line(logits: np.ndarray, labels: np.ndarray, pull: float = 0.5, steps: int = 400) -> tuple[float, float]:
    """(slope, offset) of the logistic line from logits to labels, drawn to a moderate one.

    Both classes weigh the same. Steps go down the gradient over logits of mean 0 and
    deviation 1, where the loss bends by 1 at the most.
    """
    middle, spread = float(logits.mean()), max(float(logits.std()), 1e-3)
    x = (logits.astype(np.float64) - middle) / spread
    weights = np.where(labels == 1, 0.5 / max(labels.sum(), 1), 0.5 / max((1 - labels).sum(), 1)) * len(labels)
    slope, offset = 1.0, 0.0
    for _ in range(steps):
        off = weights * (gru.sigmoid(slope * x + offset) - labels)
        slope -= ((off * x).sum() + pull * (slope - 1)) / len(x)
        offset -= (off.sum() + pull * offset) / len(x)
    return max(slope, 0.1) / spread, offset - max(slope, 0.1) * middle / spread


def train(given: list[bytes], labels: np.ndarray, training: Training = Training(), shape: gru.Shape = gru.Shape()) -> Model:  # noqa: B008
    """A model of labelled texts; of one class alone, or none, the network as it starts."""
    rng = np.random.default_rng(training.seed)
    cut = [list(words_of(text)) for text in given]
    documents = Counter(w for words in cut for w in set(words))
    common = [w for w, n in documents.most_common(training.vocabulary) if n >= training.least_documents]
    numbers = {w: i + 1 for i, w in enumerate(common)}
    words = list(documents)
    place = {w: i for i, w in enumerate(words)}
    known = np.array([numbers.get(w, 0) for w in words], np.int64)
    model = Model(gru.start(rng, shape, len(numbers) + 1), numbers, shape)
    if len(set(labels.tolist())) < 2:
        return model
    parts = [windows_of(np.array([place[w] for w in x], np.int64), shape) for x in cut]
    windows, lengths = (np.concatenate(x) for x in zip(*parts, strict=True))
    owner = np.repeat(np.arange(len(parts)), [len(x) for _, x in parts])
    held_back = np.arange(len(parts)) % training.held_back == training.held_back - 1
    taught = ~held_back[owner] & (lengths > 0)
    toxic, clean = (np.flatnonzero(taught & (labels[owner] == x)) for x in (1, 0))
    if not len(toxic) or not len(clean):
        return model
    adam = gru.Adam(model.weights, training.rate)
    passes = training.first_passes + training.later_passes

    def learn(chosen: np.ndarray) -> None:
        each = [max(1, int((labels[owner[chosen]] == x).sum())) for x in (0, 1)]
        chosen = rng.permutation(chosen)
        for at in range(0, len(chosen), training.batch):
            part = chosen[at : at + training.batch]
            part = part[np.argsort(-lengths[part], kind="stable")]
            own, at_row = np.unique(windows[part], return_inverse=True)
            label = labels[owner[part]].astype(np.float32)
            weight = (len(chosen) / 2 / np.array(each, np.float32))[label.astype(int)] / len(part)
            seen = np.where(rng.random(len(own)) < training.unknown, 0, known[own])
            texts_of = [words[i] for i in own]
            _, change = gru.gradients(model.weights, texts_of, seen, at_row.reshape(windows[part].shape), lengths[part], label, weight.astype(np.float32))
            adam.step(change)

    def everything() -> np.ndarray:
        return model.logits(model.gates(words), windows, lengths)

    for turn in range(passes):
        adam.rate = training.rate * (1 - turn / passes) ** 0.5
        if turn < training.first_passes:
            some = [rng.permutation(x)[: training.windows // 2] for x in (toxic, clean)]
        else:
            logits = everything()
            order = np.lexsort((-logits, owner))
            rank = np.arange(len(order)) - np.searchsorted(owner[order], owner[order])
            place_in = np.empty(len(order), np.int64)
            place_in[order] = rank
            # The best window of each document, more of a toxic one's if they look toxic, and some clean ones.
            some = [toxic[(place_in[toxic] == 0) | ((place_in[toxic] < 3) & (logits[toxic] > 0))], clean[place_in[clean] < 2]]
            some.append(rng.permutation(clean[place_in[clean] >= 2])[: len(some[0]) + len(some[1])])
        learn(np.concatenate(some))
    logits = everything()
    best = np.full(len(parts), -np.inf)
    np.maximum.at(best, owner, logits)
    kept = held_back if len(set(labels[held_back].tolist())) == 2 else np.ones(len(parts), bool)
    model.slope, model.offset = _line(best[kept], labels[kept])
    return model


def held_out(id_column: str):
    """Rows that are never learned from: one in three by a checksum of the id; a null id is not one."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, training: Training, id_column: str, text_column: str, label_column: str) -> DataFrame:
    """(text, label) of the rows to learn from, at most as many as `training` says.

    Rows of the least digests of their ids are taken, so that a rerun takes the same. An id
    with both labels counts as toxic; of its texts, if it has more, the least is taken.
    Rows with a null id or label, and labels without a document, are no part of it.
    """
    known = labels.where(F.col(id_column).isNotNull() & F.col(label_column).isin(0, 1) & ~held_out(id_column))
    known = known.groupBy(F.col(id_column).alias("id")).agg(F.max(label_column).alias("label"))
    picked = [
        known.where(F.col("label") == label).orderBy(F.xxhash64("id"), "id").limit(most)
        for label, most in ((1, training.toxic_rows), (0, training.clean_rows))
    ]
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    rows = rows.where(F.length("text") <= training.most_chars)
    # The picked ids are few by their limits, so the documents are filtered where they lie.
    found = rows.join(F.broadcast(picked[0].unionByName(picked[1])), "id")
    return found.groupBy("id", "label").agg(F.min("text").alias("text"))


def trained(docs: DataFrame, labels: DataFrame, training: Training, shape: gru.Shape, id_column: str, text_column: str, label_column: str) -> Model:
    """The model learned from the sample, in one task that may be run again."""
    rows = sample(docs, labels, training, id_column, text_column, label_column)
    together = rows.repartition(1).sortWithinPartitions(F.xxhash64("id"), "id").select("text", "label")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given: list[bytes] = []
        wanted: list[int] = []
        for batch in batches:
            given += texts(batch.column(0))
            wanted += batch.column(1).to_pylist()
        model = train(given, np.array(wanted, np.int64), training, shape)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])

    made = map_batches(together, work, "model binary").first()
    # Without rows Spark may leave the task out.
    return pickle.loads(made["model"]) if made else train([], np.zeros(0, np.int64), training, shape)


def scored(
    docs: DataFrame, labels: DataFrame, training: Training = Training(), shape: gru.Shape = gru.Shape(), least: float = LEAST,  # noqa: B008
    id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic",
) -> DataFrame:
    """(id, held_out, score, predicted) of every row: the probability that its text is toxic.

    The network is trained here on a bounded sample of labelled rows that are not held out.
    Null and empty texts have a score as well, that of a window without words. Rows that
    share an id, or are equal, are scored side by side; an empty table gives no rows, and
    without labels of both kinds the scores are those of an untrained network. Only the
    text enters a score; other columns are neither read nor returned. Texts of any length
    are read to their end, some tens of thousands of words at a time.
    """
    model = docs.sparkSession.sparkContext.broadcast(trained(docs, labels, training, shape, id_column, text_column, label_column))
    rows = docs.select(F.col(id_column).alias(id_column), F.col(text_column).alias("text"))
    kind = rows.schema[id_column].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = scorer_of(model.value)
        for batch in small_batches(batches, "text"):
            scores = model.value.probability(scorer(texts(batch.column(1))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], [id_column, "score"])

    found = map_batches(rows, work, f"`{id_column}` {kind}, score double")
    predicted = (F.col("score") >= least).cast("int").alias("predicted")
    return found.select(id_column, held_out(id_column).alias("held_out"), "score", predicted)
