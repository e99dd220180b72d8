"""Toxicity: subword-bag embeddings, averaged, into a linear softmax; trained jointly in numpy.

A word's vector is the mean of the embeddings of its character n-grams and of the word itself, so a
misspelling that was never seen shares most of its n-grams' vectors. A text's spans of words are
averaged and go to the softmax, and the text's score is the softmax of its most toxic span, so one
insult in a long text counts as much as in a short one. Training knows labels of texts only. It learns
embeddings and softmax together, first on the averages of whole texts, which tells where to look, and
then on the average of each text's most toxic span as the model sees it at that step: what is trained
in the end is what is scored, and nothing is fitted behind the softmax.

Averages and softmax are linear up to the logistic, hence a trained model is one number for each
n-gram bucket; a worker keeps each distinct word's number, and scoring is a table look-up a word.

Defined results: texts without words (null, empty, symbols only) get the score of the bias alone;
texts of any length are read whole; equal texts get equal scores; ids and other columns are no
input. Without any labelled row of one class, or any word in LEAST_TEXTS
of them, every score is 0.5 (no model can be trained).
"""

from __future__ import annotations

from array import array
from collections.abc import Callable, Iterator
from math import fsum

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellstrand.llm.common import fold_of, id_and_text, kept_rows, slices, texts_of

BUCKETS = 1 << 17
DIM = 4
#: Words of a span.
SPAN = 5
#: Averages are multiplied by SCALE before the softmax; RATE, DECAY and STEPS are the descent's.
SCALE, RATE, DECAY, STEPS = 100.0, 0.03, 1e-4, 80
#: Steps of the descent on most toxic spans, its rate, and after how many steps the spans are looked for again.
SPAN_STEPS, SPAN_RATE, RENEWED = 80, 0.003, 4
#: Words in fewer training texts are not trained on.
LEAST_TEXTS = 3
#: Labelled texts that a model is fitted on, at most, of each class, and bytes of such a text, at most.
SAMPLE_EACH = 1500
SAMPLE_TEXT_BYTES = 1 << 18
#: Distinct words, and distinct n-grams, that a worker remembers.
REMEMBERED, REMEMBERED_GRAMS = 200_000, 300_000

WORD = regex.compile(r"[\p{L}\p{N}]+")


def grams_of(word: str) -> set[str]:
    """A lower-case word and its 3- to 5-grams with end marks."""
    marked = f"<{word}>"
    grams = {marked[i : i + n] for n in (3, 4, 5) for i in range(len(marked) - n + 1)}
    grams.add("=" + word)
    return grams


def bucket(gram: str) -> int:
    return xxhash.xxh3_64_intdigest(gram) & (BUCKETS - 1)


def subwords(word: str) -> list[int]:
    """Buckets of a word's n-grams."""
    return [bucket(g) for g in sorted(grams_of(word))]


def words_of(text: str) -> list[str]:
    """Lower-case words, each once, in order of first appearance: repetition is no insult."""
    return list(dict.fromkeys(WORD.findall(text.lower())))


class Weights(dict):
    """Numbers of n-grams, each looked up in `weight` when it is asked for first."""

    def __init__(self, weight: np.ndarray):
        self.weight = weight.tolist()

    def __missing__(self, gram: str) -> float:
        self[gram] = found = self.weight[bucket(gram)]
        return found


class Model:
    """weight: a number for each bucket; a word's is the mean of its buckets'."""

    def __init__(self, weight: np.ndarray, bias: float):
        self.weight, self.bias, self.known, self.grams = weight, bias, {}, Weights(weight)

    def word_numbers(self, words: list[str]) -> np.ndarray:
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        of = self.grams.__getitem__
        for w in set(words).difference(known):
            own = grams_of(w)
            # exact, as a set has no order
            known[w] = fsum(map(of, own)) / len(own)
        if len(self.grams) > REMEMBERED_GRAMS:
            self.grams.clear()
        return np.array([known[w] for w in words])

    def scores(self, texts: list[str]) -> np.ndarray:
        out = np.full(len(texts), self.bias)
        for k, text in enumerate(texts):
            words = words_of(text)
            if words:
                out[k] += span_means(self.word_numbers(words)).max()
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def span_means(numbers: np.ndarray) -> np.ndarray:
    """Means of the spans of SPAN words at every start; one shorter span if there are fewer words."""
    if len(numbers) <= SPAN:
        return numbers.mean(keepdims=True)
    total = np.concatenate([[0.0], np.cumsum(numbers)])
    return (total[SPAN:] - total[:-SPAN]) / SPAN


class Bags:
    """Words of texts as flat numbers, and subwords of words as flat numbers of the subwords that are trained."""

    def __init__(self, texts: list[str]):
        index: dict[str, int] = {}
        rows = [np.array([index.setdefault(w, len(index)) for w in words_of(t)], dtype=np.int64) for t in texts]
        self.size = np.array([len(r) for r in rows], dtype=np.int64)
        self.word = np.concatenate([*rows, np.empty(0, dtype=np.int64)])
        self.text = np.repeat(np.arange(len(rows)), self.size)
        self.begin = np.cumsum(self.size) - self.size
        every, sizes = array("i"), array("i")
        for w in index:
            own = subwords(w)
            every.extend(own)
            sizes.append(len(own))
        flat, self.grams = np.frombuffer(every, dtype=np.int32), np.frombuffer(sizes, dtype=np.int32).astype(np.int64)
        #: buckets of words that stand in LEAST_TEXTS texts are trained, the others stay 0
        often = np.bincount(self.word, minlength=len(index)) >= LEAST_TEXTS
        self.often = often[self.word]
        owner = np.repeat(np.arange(len(index), dtype=np.int32), self.grams)
        self.used = np.unique(flat[often[owner]])
        known = np.isin(flat, self.used)
        self.gram, self.owner = np.searchsorted(self.used, flat[known]).astype(np.int32), owner[known]
        self.first = np.searchsorted(self.owner, np.arange(len(index) + 1))
        #: texts with words
        self.long = np.flatnonzero(self.size > 0)

    def members(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For some words their trained subwords in a row, and whose each is."""
        length = self.first[words + 1] - self.first[words]
        place = np.repeat(self.first[words] - (np.cumsum(length) - length), length) + np.arange(length.sum())
        return self.gram[place], np.repeat(np.arange(len(words)), length)

    def numbers(self, value: np.ndarray) -> np.ndarray:
        """A number for every word, from one for each trained subword."""
        return np.bincount(self.owner, weights=value[self.gram], minlength=len(self.grams)) / self.grams

    def top_spans(self, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last place (in the flat words) of each text's span of highest mean; of texts with words."""
        total = np.concatenate([[0.0], np.cumsum(number[self.word])])
        last = np.minimum(np.arange(len(self.word)) + SPAN, (self.begin + self.size)[self.text])
        whole = (last - np.arange(len(self.word)) == SPAN) | (np.arange(len(self.word)) == self.begin[self.text])
        mean = np.where(whole, (total[last] - total[:-1]) / (last - np.arange(len(self.word))), -np.inf)
        best = np.maximum.reduceat(mean, self.begin[self.long])
        hit = np.flatnonzero(mean == np.repeat(best, self.size[self.long]))
        first = hit[np.unique(self.text[hit], return_index=True)[1]]
        return first, last[first]


def train(texts: list[str], toxic: list[int], steps: int = STEPS, span_steps: int = SPAN_STEPS, seed: int = 7) -> Model:
    """Embeddings and softmax learnt together by adaptive moments with decay: on whole texts' averages, then on top spans'.

    What stands in few texts is left out, so single texts are not learnt by heart.
    """
    untrained = Model(np.zeros(BUCKETS), 0.0)
    if len(set(toxic)) < 2:
        return untrained
    bags, label = Bags(texts), np.array(toxic, dtype=float)
    if not len(bags.used):
        return untrained
    rng = np.random.default_rng(seed)
    embedding, softmax, bias = rng.normal(0, 0.1, (len(bags.used), DIM)), rng.normal(0, 0.5, (2, DIM)), np.zeros(2)
    truth = np.stack([1 - label, label], 1)
    # both classes weigh the same, however many texts they have
    weight = np.where(label == 1, 0.5 / label.sum(), 0.5 / (len(label) - label.sum()))

    def descend(count: int, rate: float, bag: Callable[[], tuple[np.ndarray, np.ndarray, np.ndarray]], renewed: int) -> None:
        """bag: words, the texts that they stand for, and their shares of the average; asked again each `renewed` steps."""
        moving = [(np.zeros_like(x), np.zeros_like(x)) for x in (embedding, softmax, bias)]
        for step in range(1, count + 1):
            if step % renewed == 1:
                word, text, share = bag()
                distinct, number = np.unique(word, return_inverse=True)
                gram, owner = bags.members(distinct)
                size = bags.grams[distinct][:, None]
            vector = summed(owner, embedding[gram], len(distinct)) / size
            hidden = SCALE * summed(text, vector[number] * share[:, None], len(texts))
            logit = hidden @ softmax.T + bias
            odds = np.exp(logit - logit.max(1, keepdims=True))
            slope = (odds / odds.sum(1, keepdims=True) - truth) * weight[:, None]
            to_word = summed(number, (slope @ softmax * SCALE)[text] * share[:, None], len(distinct)) / size
            to_gram = summed(gram, to_word[owner], len(bags.used))
            for value, (first, second), grad in zip((embedding, softmax, bias), moving, (to_gram + DECAY * embedding, slope.T @ hidden, slope.sum(0)), strict=True):
                first += 0.1 * (grad - first)
                second += 0.01 * (grad * grad - second)
                value -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)

    def whole() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return bags.word[bags.often], bags.text[bags.often], 1 / bags.size[bags.text[bags.often]]

    def top_spans() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        first, last = bags.top_spans(bags.numbers(embedding @ (softmax[1] - softmax[0])))
        size = last - first
        place = np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())
        return bags.word[place], bags.text[place], np.repeat(1 / size, size)

    descend(steps, RATE, whole, steps + 1)
    # a span's few words stand out more than a whole text's many: the softmax begins with logits of a spread of about 2
    word, text, share = top_spans()
    logit = np.bincount(text, weights=SCALE * bags.numbers(embedding @ (softmax[1] - softmax[0]))[word] * share)
    softmax /= max(1.0, float(logit[np.unique(text)].std()) / 2)
    descend(span_steps, SPAN_RATE, top_spans, RENEWED)
    number = np.zeros(BUCKETS)
    number[bags.used] = SCALE * (embedding @ (softmax[1] - softmax[0]))
    return Model(number, float(bias[1] - bias[0]))


def summed(owner: np.ndarray, rows: np.ndarray, count: int) -> np.ndarray:
    """Rows added up by owner."""
    return np.stack([np.bincount(owner, weights=column, minlength=count) for column in rows.T], 1)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, allowed: Column, each: int = SAMPLE_EACH) -> list[tuple[str, int]]:
    """At most `each` labelled texts of either class, those of least hash of the id, without any longer than SAMPLE_TEXT_BYTES.

    The label rows are cut down first, so what reaches the documents is bounded and broadcast, and what comes back is bounded too.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).where("doc_id is not null and y in (0, 1)").where(allowed)
    known = known.groupBy("doc_id").agg(F.max("y").alias("y"))
    order = F.xxhash64("doc_id")
    picked = known.where("y = 1").orderBy(order, "doc_id").limit(each).unionByName(known.where("y = 0").orderBy(order, "doc_id").limit(each))
    # of rows that share an id one is taken, so that the sample stays bounded
    rows = id_and_text(docs).join(F.broadcast(picked), "doc_id").where(F.coalesce(F.octet_length("text"), F.lit(0)) <= SAMPLE_TEXT_BYTES).groupBy("doc_id").agg(F.min("text").alias("text"), F.max("y").alias("y")).collect()
    return [(r.text or "", r.y) for r in sorted(rows, key=lambda r: r.doc_id)]


def fit(docs: DataFrame, labels: DataFrame, allowed: Column | None = None, each: int = SAMPLE_EACH) -> Model:
    """A model from labels (doc_id, toxic); `allowed` says, in terms of doc_id, which labels may be learnt."""
    sample = labelled_sample(docs, labels, "toxic", F.lit(True) if allowed is None else allowed, each)
    return train([t for t, _ in sample], [y for _, y in sample])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every text; the model's size is fixed, so it is broadcast."""
    sent = docs.sparkSession.sparkContext.broadcast((model.weight.astype(np.float32), model.bias))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(sent.value[0].astype(float), sent.value[1])
        for batch in slices(batches):
            yield pa.record_batch([batch.column(0), pa.array(model.scores(texts_of(batch.column(1))), pa.float64())], names=["doc_id", "score"])

    return id_and_text(docs).mapInArrow(run, "doc_id long, score double")


def below(docs: DataFrame, model: Model, most: float) -> DataFrame:
    """docs, all columns, without the rows whose text scores `most` or more."""
    sent = docs.sparkSession.sparkContext.broadcast((model.weight.astype(np.float32), model.bias))
    own: list[Model] = []

    def keep(texts: list[str]) -> np.ndarray:
        if not own:
            own.append(Model(sent.value[0].astype(float), sent.value[1]))
        return own[0].scores(texts) < most

    return kept_rows(docs, keep)


def held_out(folds: int, fold: int) -> Column:
    """Whether a row is kept from training; a null id is never learnt from."""
    return F.coalesce(fold_of(F.col("doc_id"), folds) == fold, F.lit(False))
