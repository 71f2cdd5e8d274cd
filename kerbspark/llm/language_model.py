"""Scoring of texts by a log-bilinear model trained with noise-contrastive estimation.

The model's classes are the most frequent words, an end, clusters of all other
frequent words, and one class for words met once or too rarely. A cluster holds
words with like neighbours among the commonest words, so it knows a word's
language and kind. A context of two classes gives a vector, the sum of their
weighted vectors; its product with a class's vector, plus the class's bias, is
that class's score. Training never normalises: it tells the next class from
noise drawn by frequency. Scoring does, with batched matrix products over all
classes. A word's probability is its class's, times its share of the class's
training tokens; for a rare word that share is mixed with a spelling model, so
that every text has a probability.

Word counts, clusters and the model cover every training document. Documents
are dealt to shards by a hash of their content. Each shard trains from a common
start, in an order that the hash gives; the models are averaged by their
tokens, and a second round starts from the average. So the score does not
depend on how the input is partitioned. Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, hash_strings, slices, split_words

CLASSES, CLUSTERS, WIDTH, NOISE, BATCH = 1024, 256, 32, 64, 2048
#: The step size of each round of training.
RATES = (0.1, 0.03)
#: Words whose counts and classes go to every task, at most; the counts of all others are joined.
HEAD_WORDS = 131_072
#: The commonest words, by whose nearness other words are clustered.
SIGNS = 16
#: Training tokens of a shard, about, and those that are shuffled with one another before they are learned from.
SHARD_TOKENS, CHUNK_TOKENS = 1 << 22, 1 << 18
#: Bytes of a word and its end, as the spelling model knows them.
LETTERS = 257
#: The hash that stands for the end of a text, and the classes of the end and of rarer words.
END_HASH, END, RARE = 0, 0, 1


def held_out(key: Column) -> Column:
    """crc32 of the key as text, modulo 7, is 2; a null key counts as an empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 7 == 2


def _coded(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words, their hashes, each word's number among them, and the texts' offsets."""
    words, offsets = split_words(pc.ascii_lower(texts))
    coded = words.dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64) if len(words) else np.empty(0, np.int64)
    return coded.dictionary, hash_strings(coded.dictionary).view(np.int64), codes, offsets


def _letters(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Each letter's number in the spelling table, which is that of the letter before it and its own, and the words' offsets in them.

    A word's letters are its bytes and an end, 256, which also stands before the first.
    """
    at = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    raw = np.frombuffer(words.buffers()[2], np.uint8)[at[0] : at[-1]] if at[-1] > at[0] else np.empty(0, np.uint8)
    letters = np.insert(raw.astype(np.int64), at[1:] - at[0], 256)
    before = np.concatenate([[256], letters[:-1]])
    return before * LETTERS + letters, at - at[0] + np.arange(len(at))


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(kind, id, n): kind 0 counts words by hash and ends, kind 1 pairs of letters."""
    for whole in batches:
        for batch in slices(whole, "text", 8 << 20):
            words, hashes, codes, _ = _coded(batch.column("text"))
            n = np.bincount(codes, minlength=len(words))
            if len(words):
                pairs, offsets = _letters(words)
                letters = np.bincount(pairs, weights=np.repeat(n, np.diff(offsets)), minlength=LETTERS * LETTERS).astype(np.int64)
            else:
                letters = np.zeros(LETTERS * LETTERS, np.int64)
            some = np.flatnonzero(letters)
            kind = np.repeat(np.array([0, 1], np.int32), [len(words) + 1, len(some)])
            ids = np.concatenate([hashes, [END_HASH], some])
            count = np.concatenate([n, [batch.num_rows], letters[some]]).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(kind), pa.array(ids), pa.array(count)], ["kind", "id", "n"])


@dataclass
class Model:
    """``target`` (classes x width + 1, the last column the biases), ``context`` (classes x width), ``weight`` (2 x width)."""

    target: np.ndarray
    context: np.ndarray
    weight: np.ndarray
    #: Sorted hashes of the head words, their training counts, classes and log10 shares of their class.
    hashes: np.ndarray
    counts: np.ndarray
    classes: np.ndarray
    shares: np.ndarray
    #: log probability of each class by frequency.
    noise: np.ndarray
    #: log10 probabilities of a letter after another.
    spelling: np.ndarray
    rare_tokens: int
    new_share: float
    #: Names this model in workers.
    name: str

    def place(self, hashes: np.ndarray) -> np.ndarray:
        """The place of each word in the head, or -1."""
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, at, -1) if len(self.hashes) else np.full(len(hashes), -1)


def contexts(classes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each text's classes with an end after them, and the two classes before each; before a text stand ends."""
    tokens = np.insert(classes, offsets[1:], END)
    starts = (offsets + np.arange(len(offsets)))[:-1]
    one = np.concatenate([[END], tokens[:-1]])
    one[starts] = END
    two = np.concatenate([[END], one[:-1]])
    two[starts] = END
    return tokens, one, two


def _scatter(rows: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """The sums of the values of each row number, from 0 to ``size`` - 1."""
    order = np.argsort(rows.astype(np.int16) if size <= 1 << 15 else rows, kind="stable")
    sorted_rows = rows[order]
    first = np.flatnonzero(np.diff(sorted_rows, prepend=-1))
    out = np.zeros((size, values.shape[1]), values.dtype)
    out[sorted_rows[first]] = np.add.reduceat(values[order], first, axis=0)
    return out


class Trainer:
    """Noise-contrastive estimation by AdaGrad in numpy; noise is shared by a batch."""

    def __init__(self, model: Model, seed: int, rate: float = RATES[0]):
        self.rate = rate
        self.rng = np.random.default_rng(seed)
        self.target, self.context, self.weight = (x.astype(np.float32) for x in (model.target, model.context, model.weight))
        self.log_noise = model.noise.astype(np.float32)
        self.noise = np.exp(model.noise)
        self.noise /= self.noise.sum()
        self.squares = [np.full_like(x, 1e-8) for x in (self.target, self.context, self.weight)]
        self.tokens = 0

    def step(self, tokens: np.ndarray, one: np.ndarray, two: np.ndarray) -> None:
        # all in single precision, which takes half the time
        drawn = self.rng.choice(len(self.noise), NOISE, p=self.noise)
        v1, v2 = self.context[one], self.context[two]
        query = v1 * self.weight[0] + v2 * self.weight[1]
        target, bias = self.target[:, :-1], self.target[:, -1] - self.log_noise - np.float32(np.log(NOISE))
        near, far = target[tokens], target[drawn]
        g_real = np.tanh((np.einsum("ij,ij->i", query, near) + bias[tokens]) * np.float32(0.5)) * np.float32(0.5) - np.float32(0.5)
        fake = query @ far.T
        fake += bias[drawn]
        fake *= np.float32(0.5)
        g_fake = np.tanh(fake, out=fake)
        g_fake *= np.float32(0.5)
        g_fake += np.float32(0.5)
        d_target = _scatter(tokens, np.concatenate([g_real[:, None] * query, g_real[:, None]], axis=1), len(target))
        np.add.at(d_target, drawn, np.concatenate([g_fake.T @ query, g_fake.sum(axis=0)[:, None]], axis=1))
        d_query = g_real[:, None] * near + g_fake @ far
        d_context = _scatter(np.concatenate([one, two]), np.concatenate([d_query * self.weight[0], d_query * self.weight[1]]), len(target))
        d_weight = np.stack([np.einsum("ij,ij->j", d_query, v1), np.einsum("ij,ij->j", d_query, v2)])
        for value, grad, square in zip((self.target, self.context, self.weight), (d_target, d_context, d_weight), self.squares, strict=True):
            grad *= np.float32(1 / len(tokens))
            square += grad * grad
            grad /= np.sqrt(square)
            grad *= np.float32(self.rate)
            value -= grad
        self.tokens += len(tokens)

    def fit(self, tokens: np.ndarray, one: np.ndarray, two: np.ndarray) -> None:
        order = self.rng.permutation(len(tokens))
        for at in range(0, len(order), BATCH):
            pick = order[at : at + BATCH]
            self.step(tokens[pick], one[pick], two[pick])


def count_words(train: DataFrame) -> DataFrame:
    """(kind, id, n) of all training texts, kept in reliable storage."""
    return cut(train.select("text").mapInArrow(_counts, "kind int, id long, n long").groupBy("kind", "id").agg(F.sum("n").alias("n")))


@dataclass
class Counts:
    """What the driver knows of the training texts: sums, a spelling table and the head words, by count."""

    tokens: int
    different: int
    ends: int
    #: The least level of a head word's count; see :func:`level_of`.
    least: int
    once: int
    head: np.ndarray
    counts: np.ndarray
    spelling: np.ndarray


def level_of(n: Column) -> Column:
    """Counts in some thousand levels, whatever the corpus: 0 for one, 16 for two."""
    return F.floor(F.log2(n.cast("double")) * 16)


def gather_counts(counted: DataFrame) -> Counts:
    """The head is all words met more than once, or the most frequent of them that are at most HEAD_WORDS."""
    words = counted.where((F.col("kind") == 0) & (F.col("id") != END_HASH))
    levels = sorted(words.groupBy(level_of(F.col("n")).alias("level")).agg(F.count(F.lit(1)).alias("words"), F.sum("n").alias("n")).collect(), reverse=True)
    ends = next((r["n"] for r in counted.where((F.col("kind") == 0) & (F.col("id") == END_HASH)).collect()), 0)
    total, least = 0, 1 << 30
    for row in levels:
        if total + row["words"] > HEAD_WORDS or row["level"] == 0:
            break
        total, least = total + row["words"], row["level"]
    head = words.where(level_of(F.col("n")) >= F.lit(least)).select("id", "n").toPandas().sort_values(["n", "id"], ascending=[False, True], ignore_index=True)
    letters = np.zeros(LETTERS * LETTERS)
    pairs = counted.where("kind = 1").select("id", "n").toPandas()
    letters[pairs["id"].to_numpy().astype(np.int64)] = pairs["n"].to_numpy()
    after = letters.reshape(LETTERS, LETTERS) + 0.1
    return Counts(
        tokens=int(sum(r["n"] for r in levels) + ends), different=int(sum(r["words"] for r in levels) + (ends > 0)), ends=int(ends), least=int(least), once=int(sum(r["n"] for r in levels if r["level"] == 0)),
        head=head["id"].to_numpy().astype(np.int64), counts=head["n"].to_numpy().astype(np.int64), spelling=np.log10(after / after.sum(axis=1, keepdims=True)).reshape(-1),
    )


def number_texts(train: DataFrame, known: Counts) -> DataFrame:
    """(shard, h, words): each training text's words by their place among the head words, 32-bit numbers, or -1.

    ``h`` is a hash of the text and its key, and gives the shard. Rows are
    sorted by both within the partitions of their shards, so the order in a
    shard is the same for any partitioning of the input.
    """
    order = np.argsort(known.head)
    spread = train.sparkSession.sparkContext.broadcast((known.head[order], order.astype(np.int32)))
    shards = max(1, -(-known.tokens // SHARD_TOKENS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, place = spread.value
        for whole in batches:
            for batch in slices(whole, "text"):
                _, own, codes, offsets = _coded(batch.column("text"))
                at = np.minimum(np.searchsorted(hashes, own), len(hashes) - 1)
                number = np.where(hashes[at] == own, place[at], -1).astype(np.int32) if len(hashes) else np.full(len(own), -1, np.int32)
                words = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer((4 * offsets).astype(np.int32)), pa.py_buffer(number[codes] if len(codes) else number[:0])])
                yield pa.RecordBatch.from_arrays([batch.column("shard"), batch.column("h"), words], ["shard", "h", "words"])

    named = train.select("text", F.xxhash64("key", "text").alias("h")).withColumn("shard", F.pmod("h", F.lit(shards)))
    numbered = named.mapInArrow(run, "shard long, h long, words binary")
    return cut(numbered.repartition(3 * shards, "shard").sortWithinPartitions("shard", "h"))


def _numbers_of(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), np.int32) for x in column]


#: Keeps the words of two texts from being neighbours.
_apart = np.full(2, -1, np.int32)


def signatures(numbered: DataFrame, words: int) -> np.ndarray:
    """(words x SIGNS): how often each head word stands up to two words from each of the SIGNS commonest words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((words, SIGNS), np.int64)
        for batch in batches:
            seq = np.concatenate([_apart, *[x for s in _numbers_of(batch.column("words")) for x in (s, _apart)]])
            for gap in (1, 2):
                for x, y in ((seq[:-gap], seq[gap:]), (seq[gap:], seq[:-gap])):
                    some = (x >= SIGNS) & (y >= 0) & (y < SIGNS)
                    np.add.at(total, (x[some], y[some]), 1)
        met = np.flatnonzero(total.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(met), *[pa.array(total[met, i]) for i in range(SIGNS)]], ["word", *[f"s{i}" for i in range(SIGNS)]])

    names = [f"s{i}" for i in range(SIGNS)]
    found = numbered.select("words").mapInArrow(run, "word long, " + ", ".join(f"{n} long" for n in names)).groupBy("word").agg(*[F.sum(n).alias(n) for n in names])
    got = found.toPandas()  # a row for each head word at most
    out = np.zeros((words, SIGNS))
    out[got["word"].to_numpy().astype(np.int64)] = got[names].to_numpy()
    return out


def cluster(signs: np.ndarray, weights: np.ndarray, clusters: int, rounds: int = 12) -> np.ndarray:
    """The cluster of each row by spherical k-means of the square roots, from the first rows that differ on."""
    x = np.sqrt(signs)
    length = np.linalg.norm(x, axis=1, keepdims=True)
    x = (x / np.maximum(length, 1e-9)).astype(np.float32)
    if not len(x):
        return np.empty(0, np.int64)
    _, first = np.unique(np.round(x, 3), axis=0, return_index=True)
    centre = x[np.sort(first)[:clusters]].copy()
    label = np.zeros(len(x), np.int64)
    for _ in range(rounds):
        label = np.argmax(x @ centre.T, axis=1)
        sums = np.stack([np.bincount(label, weights=x[:, i] * weights, minlength=len(centre)) for i in range(x.shape[1])], axis=1)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        centre = np.where(size > 0, sums / np.maximum(size, 1e-9), centre).astype(np.float32)
    return label


def start_model(known: Counts, signs: np.ndarray) -> Model:
    """An untrained model: classes by frequency and cluster, biases by frequency."""
    own = CLASSES - 2 - CLUSTERS
    classes = np.arange(2, 2 + len(known.head))
    classes[own:] = 2 + own + cluster(signs[own:], np.sqrt(known.counts[own:]), CLUSTERS)
    members = np.bincount(classes, weights=known.counts, minlength=CLASSES)
    rare = known.tokens - known.ends - int(known.counts.sum())
    total = members.copy()
    total[END], total[RARE] = known.ends, rare
    noise = np.log((total + 1) / (total + 1).sum())
    order = np.argsort(known.head)
    rng = np.random.default_rng(7)
    return Model(
        target=np.concatenate([rng.normal(0, 0.1, (CLASSES, WIDTH)), noise[:, None]], axis=1),
        context=rng.normal(0, 0.1, (CLASSES, WIDTH)),
        weight=np.stack([np.ones(WIDTH), np.full(WIDTH, 0.5)]),
        hashes=known.head[order],
        counts=known.counts[order],
        classes=classes[order],
        shares=np.log10(known.counts / members[classes])[order] if len(classes) else np.empty(0),
        noise=noise,
        spelling=known.spelling,
        rare_tokens=max(rare, 1),
        new_share=float(np.clip((known.once + 1) / (rare + 2), 0.001, 0.999)),
        name=uuid.uuid4().hex,
    )


def train_round(model: Model, numbered: DataFrame, class_of: np.ndarray, number: int) -> Model:
    """``model`` after one round: each shard's training from it, averaged by tokens.

    ``class_of`` has the class of each head word by number, and RARE for -1 at
    its end. What returns to the driver is one averaged row for each class vector.
    """
    spread = numbered.sparkSession.sparkContext.broadcast((model, class_of))
    values = [f"v{i}" for i in range(WIDTH + 1)]

    def rows_of(trainer: Trainer) -> pa.RecordBatch:
        rows = np.concatenate([trainer.target, np.pad(trainer.context, ((0, 0), (0, 1))), np.pad(trainer.weight, ((0, 0), (0, 1)))]).astype(np.float64) * trainer.tokens
        columns = [pa.array(np.arange(len(rows), dtype=np.int32)), pa.array(np.full(len(rows), float(trainer.tokens)))]
        return pa.RecordBatch.from_arrays(columns + [pa.array(np.ascontiguousarray(c)) for c in rows.T], ["row", "tokens", *values])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, classes = spread.value
        shard, trainer = None, None
        held: list[np.ndarray] = []
        size = 0

        def learn() -> None:
            nonlocal held, size
            if held:
                trainer.fit(*contexts(np.concatenate(held), np.cumsum([0, *map(len, held)])))
            held, size = [], 0

        for batch in batches:
            for at, seq in zip(batch.column("shard").to_pylist(), _numbers_of(batch.column("words")), strict=True):
                if at != shard:
                    if trainer:
                        learn()
                        yield rows_of(trainer)
                    shard, trainer = at, Trainer(start, 1000 * at + number, RATES[number])
                # chunks end where the shard's own texts say, not where batches do
                held.append(classes[seq])
                size += len(seq) + 1
                if size >= CHUNK_TOKENS:
                    learn()
        if trainer:
            learn()
            yield rows_of(trainer)

    local = numbered.mapInArrow(run, "row int, tokens double, " + ", ".join(f"{v} double" for v in values))
    averaged = local.groupBy("row").agg(*[(F.sum(v) / F.sum("tokens")).alias(v) for v in values]).toPandas().sort_values("row")
    if not len(averaged):
        return model
    rows = averaged[values].to_numpy()
    return replace(model, target=rows[:CLASSES], context=rows[CLASSES : 2 * CLASSES, :-1], weight=rows[2 * CLASSES :, :-1], name=uuid.uuid4().hex)


def train_model(train: DataFrame, known: Counts, rounds: int = len(RATES)) -> Model:
    """A model of the texts of ``train`` (key, text)."""
    numbered = number_texts(train, known)
    model = start_model(known, signatures(numbered, len(known.head)))
    class_of = np.full(len(known.head) + 1, RARE)
    class_of[np.argsort(known.head)] = model.classes
    for number in range(rounds):
        model = train_round(model, numbered, class_of, number)
    return model


class Scorer:
    """log10 probabilities of classes in context; normalisers are kept for the contexts that were met."""

    def __init__(self, model: Model):
        self.model = model
        self.normaliser = np.full(CLASSES * CLASSES, np.nan, np.float32)
        self.target, self.bias = model.target[:, :-1].astype(np.float32), model.target[:, -1].astype(np.float32)
        self.one, self.two = (model.context * model.weight[0]).astype(np.float32), (model.context * model.weight[1]).astype(np.float32)

    def log10(self, tokens: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        pair = one * CLASSES + two
        new = np.unique(pair[np.isnan(self.normaliser[pair])])
        for at in range(0, len(new), 2048):
            some = new[at : at + 2048]
            scores = (self.one[some // CLASSES] + self.two[some % CLASSES]) @ self.target.T + self.bias
            top = scores.max(axis=1)
            self.normaliser[some] = top + np.log(np.exp(scores - top[:, None]).sum(axis=1))
        out = np.empty(len(tokens))
        for at in range(0, len(tokens), 1 << 16):
            t = slice(at, at + (1 << 16))
            query = self.one[one[t]] + self.two[two[t]]
            out[t] = np.einsum("ij,ij->i", query, self.target[tokens[t]]) + self.bias[tokens[t]] - self.normaliser[pair[t]]
        return out / np.log(10)


_SCORERS: dict[str, Scorer] = {}


def score_texts(docs: DataFrame, *, key: str = "doc_id", text: str = "text", rounds: int = len(RATES)) -> DataFrame:
    """One row for each row of ``docs``: key, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``.

    Rows that are not held out are the training texts. ``base_score`` is the
    log10 probability under add-one counts of words, ``score`` the model's,
    after ``rounds`` of training.

    Counts of the at most HEAD_WORDS most frequent words are broadcast; a text's
    other words are joined to their counts by hash, each once for each text.
    These are rare by choice, so no key of that join is hot.

    Cases: a null or empty text is one end; a null key is a training row;
    repeated rows are trained on and scored each; without training rows every
    word is unknown and the untrained model scores; an empty table gives an
    empty table.
    """
    named = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    train = named.where(~held_out(F.col("key")))
    counted = count_words(train)
    known_counts = gather_counts(counted)
    tokens, different, least = known_counts.tokens, known_counts.different, known_counts.least
    model = train_model(train, known_counts, rounds)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        if model.name not in _SCORERS:
            _SCORERS.clear()
            _SCORERS[model.name] = Scorer(model)
        scorer = _SCORERS[model.name]
        for whole in batches:
            for batch in slices(whole, "text"):
                words, hashes, codes, offsets = _coded(batch.column("text"))
                place = model.place(hashes)
                inside = place >= 0
                classes, counts = np.full(len(words), RARE), np.full(len(words), -1)
                classes[inside], counts[inside] = model.classes[place[inside]], model.counts[place[inside]]
                n = batch.num_rows
                text_of = np.repeat(np.arange(n), np.diff(offsets))
                tokens, one, two = contexts(classes[codes] if len(codes) else codes, offsets)
                by_class = np.add.reduceat(scorer.log10(tokens, one, two), (offsets + np.arange(n + 1))[:-1])
                if len(words):
                    pairs, at = _letters(words)
                    spelled = np.add.reduceat(model.spelling[pairs], at[:-1]) + np.log10(model.new_share)
                    word_score, word_base = np.zeros(len(words)), np.zeros(len(words))
                    word_score[inside], word_base[inside] = model.shares[place[inside]], np.log10(counts[inside] + 1.0)
                    known = np.bincount(text_of, weights=(counts >= 0)[codes], minlength=n)
                    score = by_class + np.bincount(text_of, weights=word_score[codes], minlength=n)
                    base = np.bincount(text_of, weights=word_base[codes], minlength=n)
                    tail = np.flatnonzero((counts < 0)[codes])
                    pairs, times = np.unique(text_of[tail] * len(words) + codes[tail], return_counts=True)
                    where, which = pairs // len(words), pairs % len(words)
                    lists = np.searchsorted(where, np.arange(n + 1)).astype(np.int32)
                else:
                    known, base, score = np.zeros(n), np.zeros(n), by_class
                    which, times, spelled, lists = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0), np.zeros(n + 1, np.int32)
                offs = pa.array(lists)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("rid"),
                        batch.column("key"),
                        pa.array(np.diff(offsets) + 1),
                        pa.array(known.astype(np.int64)),
                        pa.array(base),
                        pa.array(score),
                        pa.ListArray.from_arrays(offs, pa.array(hashes[which])),
                        pa.ListArray.from_arrays(offs, pa.array(times.astype(np.int32))),
                        pa.ListArray.from_arrays(offs, pa.array(spelled[which].astype(np.float32))),
                    ],
                    ["rid", "key", "n_tokens", "known", "base", "score", "word", "times", "spelled"],
                )

    kind = docs.schema[key].dataType.simpleString()
    rows = named.withColumn("rid", F.monotonically_increasing_id())
    scored = rows.select("rid", "key", "text").mapInArrow(run, f"rid long, key {kind}, n_tokens long, known long, base double, score double, word array<long>, times array<int>, spelled array<float>")
    # the first entry stands for the text itself; its hash spreads it over the join's tasks
    itself = F.struct(F.xxhash64("rid").alias("word"), F.lit(0).alias("times"), F.lit(0.0).cast("float").alias("spelled"))
    one = F.struct("key", "n_tokens", "known", "base", "score")
    spread = scored.select("rid", one.alias("text"), F.posexplode(F.concat(F.array(itself), F.arrays_zip("word", "times", "spelled"))).alias("no", "w"))
    spread = spread.select("rid", F.when(F.col("no") == 0, F.col("text")).alias("text"), "w.*")
    tail = counted.where((F.col("kind") == 0) & (F.col("id") != END_HASH) & (level_of(F.col("n")) < F.lit(least))).select(F.col("id").alias("word"), "n")
    met = spread.join(tail, "word", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    share = F.lit((1 - model.new_share) / model.rare_tokens)
    mixed = F.when(F.col("n") > 0, F.log10(share * F.col("n") + F.pow(F.lit(10.0), F.col("spelled")))).otherwise(F.col("spelled"))
    t = F.col("times")
    per = met.groupBy("rid").agg(
        F.max("text").alias("t"), F.sum(F.when(F.col("n") > 0, t).otherwise(0)).alias("more_known"), F.sum(t * F.log10(F.col("n") + 1.0)).alias("more_base"), F.sum(F.when(t > 0, t * mixed).otherwise(0.0)).alias("more_score")
    )
    ends = counted.where((F.col("kind") == 0) & (F.col("id") == END_HASH)).first()
    end_count = ends["n"] if ends else 0
    whole = float(np.log10(tokens + different + 1))
    base = F.col("t.base") + F.col("more_base") + float(np.log10(end_count + 1.0)) - F.col("t.n_tokens") * whole
    known = F.col("t.known") + F.col("more_known") + (1 if end_count else 0)
    return per.select(F.col("t.key").alias(key), held_out(F.col("t.key")).alias("held_out"), "t.n_tokens", known.cast("long").alias("n_known"), F.lit(tokens).cast("long").alias("train_tokens"), base.alias("base_score"), (F.col("t.score") + F.col("more_score")).alias("score"))
