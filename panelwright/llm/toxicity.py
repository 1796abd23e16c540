"""Toxicity by a convolutional text classifier, trained in numpy inside tasks.

A word is three rows of hashed embeddings side by side: two by its own hash, so
that two words are taken for each other only if both meet, and one by the hash
of its first bytes, for forms of a word that training has not seen. Filters over one, two and three
words run over the whole text; the maximum of each filter feeds a logistic
output. Scores are calibrated on rows apart from those trained on, and the
threshold for rejecting a document is set for each language.

All labelled rows are learnt from. They are dealt into shards by a hash of their
id, and an epoch trains every shard by itself from the same network; the changes
are averaged, each number over the shards that changed it. They are summed as
whole numbers, so that the result does not depend on tasks or on their order.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.lineage import stored
from panelwright.llm.base import corpus_query, passes, shared, table
from panelwright.llm.hashing import MIX, ranges
from panelwright.llm.sampling import held_out, labelled_rows
from panelwright.llm.words import words_of

FOLDS, FOLD = 4, 2  # crc32 of the id mod 4 is 2: held out
THRESHOLD = 0.3

CALIBRATION_SHARE = 4  # one of so many labelled rows calibrates
SHARD_ROWS, PASS_WORDS = 2000, 1 << 18  # rows of a shard; words that a step of training works on at once, or one row
FIXED = 2.0**32  # changes are summed in units of 1 / FIXED
LOGIT_STEPS = 256  # logits of the calibration are counted in steps of 1 / LOGIT_STEPS
LEAST_TOXIC = 25  # toxic calibration rows of a language with its own threshold

BUCKETS_LOG2, DIM, TABLES = 17, 5, 3
WIDTHS, FILTERS = (1, 2, 3), 8
EPOCHS, BATCH, RATE, SEED = 6, 32, 0.05, 11
GAP = max(WIDTHS)  # padding words behind each text


def keys_of(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """(one key per word and table, words per text)."""
    words = words_of(texts)
    # Fibonacci mixing: the low bits of a product depend on low bits only.
    whole, begun = ((h * MIX) >> np.uint64(64 - 2 * BUCKETS_LOG2) for h in (words.hashes, words.prefixes))
    mask = np.uint64((1 << BUCKETS_LOG2) - 1)
    keys = [whole & mask, whole >> np.uint64(BUCKETS_LOG2), begun & mask]
    return np.stack(keys).astype(np.int32), words.sizes


def packed(texts: Sequence[str]) -> list[bytes]:
    """The keys of every text in 8 bytes a word, for `unpacked`."""
    keys, sizes = keys_of(texts)
    first, second, begun = keys.astype(np.int64)
    words = first | second << BUCKETS_LOG2 | begun << 2 * BUCKETS_LOG2
    ends = np.cumsum(sizes)
    return [words[a:b].tobytes() for a, b in zip(ends - sizes, ends)]


def unpacked(data: bytes) -> np.ndarray:
    words, mask = np.frombuffer(data, np.int64), (1 << BUCKETS_LOG2) - 1
    return np.stack([words >> k * BUCKETS_LOG2 & mask for k in range(TABLES)]).astype(np.int32)


class TextCnn:
    """Embeddings, filters and output of the network; TABLES * DIM * 2 ** 17
    numbers."""

    def __init__(self) -> None:
        rng = np.random.default_rng(SEED)
        size = 1 << BUCKETS_LOG2
        # The last row of each table is the padding word and stays zero.
        self.tables = [self._random(rng, (size + 1, DIM), 0.05) for _ in range(TABLES)]
        for t in self.tables:
            t[size] = 0
        self.filters = [self._random(rng, (w, TABLES * DIM, FILTERS), 0.3) for w in WIDTHS]
        self.bias = np.zeros(len(WIDTHS) * FILTERS, np.float32)
        self.weights = np.abs(self._random(rng, len(WIDTHS) * FILTERS, 0.3))
        self.constant = np.zeros(1)
        self.slope, self.shift = 1.0, 0.0

    @staticmethod
    def _random(rng, shape, scale: float) -> np.ndarray:
        return rng.normal(0, scale, shape).astype(np.float32)

    def buckets(self, keys: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(keys with GAP padding words behind each text, starts of the texts)."""
        padded = sizes + GAP
        starts = np.cumsum(padded) - padded
        out = np.full((TABLES, int(padded.sum())), 1 << BUCKETS_LOG2, np.int32)
        out[:, ranges(starts, sizes)] = keys
        return out, starts

    def embed(self, buckets: np.ndarray) -> np.ndarray:
        return np.concatenate([t[b] for t, b in zip(self.tables, buckets)], 1)

    def convolve(self, words: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Responses of all filters at every word; none where a filter would
        run into the next text."""
        out = np.zeros((len(words), len(self.bias)), np.float32)
        ends = np.append(starts[1:], len(words))
        for k, taps in enumerate(self.filters):
            part = out[:, k * FILTERS : (k + 1) * FILTERS]
            for offset, tap in enumerate(taps):
                part[: len(words) - offset] += words[offset:] @ tap
            for past in range(1, len(taps)):
                part[ends - past] = -np.inf
        return out

    def logits(self, keys: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        if not len(sizes):
            return np.zeros(0)
        buckets, starts = self.buckets(keys, sizes)
        peaks = np.maximum.reduceat(self.convolve(self.embed(buckets), starts), starts, axis=0)
        return np.maximum(peaks + self.bias, 0) @ self.weights + self.constant[0]

    def scores(self, texts: Sequence[str]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.logits(*keys_of(texts)) + self.shift, -30, 30)))

    def start_from(self, seen: np.ndarray, rows: np.ndarray) -> None:
        """Set the first place of each embedding to how much more often its
        bucket occurs in toxic rows, for filters to start on. `seen` has the rows
        of each class by bucket, (class, table * 2 ** 17 + bucket), `rows` those
        of each class."""
        share = (seen + 0.5) / (np.maximum(1, rows)[:, None] + 1)
        odds = np.clip(np.log(share[1] / share[0]) / 3, -1, 1)
        # Words that no row has say nothing.
        odds[seen.sum(axis=0) == 0] = 0
        for table, of_table in zip(self.tables, odds.reshape(TABLES, -1)):
            table[:-1, 0] = of_table
        for taps in self.filters:
            taps[:, ::DIM] = np.abs(taps[:, ::DIM])

    def _dense(self) -> list[np.ndarray]:
        return [*self.filters, self.bias, self.weights, self.constant]

    def state(self) -> np.ndarray:
        """All numbers that are learnt, in rows of DIM: the embeddings, then the
        others and zeros behind."""
        dense = np.concatenate([d.ravel() for d in self._dense()])
        dense = np.append(dense, np.zeros(-len(dense) % DIM)).reshape(-1, DIM)
        return np.concatenate([*[t[:-1] for t in self.tables], dense]).astype(float)

    def set_state(self, state: np.ndarray) -> None:
        size = 1 << BUCKETS_LOG2
        for k, table in enumerate(self.tables):
            table[:size] = state[k * size : (k + 1) * size]
        flat, at = state[TABLES * size :].ravel(), 0
        for d in self._dense():
            d[...] = flat[at : at + d.size].reshape(d.shape)
            at += d.size

    def train(
        self, keys: Sequence[np.ndarray], toxic: np.ndarray, balance: np.ndarray, squares: np.ndarray, seed: Sequence[int]
    ) -> np.ndarray:
        """An epoch over rows weighted by class (AdaGrad). `squares` are the sums
        of squared gradients so far, in the order of `state`; returns the rows of
        the state that can have changed."""
        sizes = np.array([k.shape[1] for k in keys])
        weight, size = balance[toxic], 1 << BUCKETS_LOG2
        order = np.random.default_rng(seed).permutation(len(toxic))
        flat, at = squares[TABLES * size :].reshape(-1), 0
        dense_squares = []
        for d in self._dense():
            dense_squares.append(flat[at : at + d.size].reshape(d.shape))
            at += d.size
        touched = np.zeros(len(squares), bool)
        touched[TABLES * size :] = True
        for i in range(0, len(order), BATCH):
            batch = order[i : i + BATCH]
            grads = [np.zeros(d.shape, np.float32) for d in self._dense()]
            at, rise = [], []
            for run in _runs(sizes[batch]):
                rows = batch[run]
                buckets, starts = self.buckets(np.concatenate([keys[r] for r in rows], 1), sizes[rows])
                words = self.embed(buckets)
                found = self.convolve(words, starts)
                ends = starts + sizes[rows] + GAP
                peak = np.stack([found[a:b].argmax(axis=0) + a for a, b in zip(starts, ends)])
                level = found[peak, np.arange(found.shape[1])] + self.bias
                hidden = np.maximum(level, 0)
                logit = hidden @ self.weights + self.constant[0]
                slope = (1 / (1 + np.exp(-logit)) - toxic[rows]) * weight[rows] / len(batch)
                back = (slope[:, None] * self.weights * (level > 0)).astype(np.float32)
                for k, taps in enumerate(self.filters):
                    cols = slice(k * FILTERS, (k + 1) * FILTERS)
                    for offset, tap in enumerate(taps):
                        place = peak[:, cols] + offset
                        grads[k][offset] += np.einsum("rfd,rf->df", words[place], back[:, cols])
                        at.append(buckets[:, place.ravel()])
                        rise.append((back[:, cols, None] * tap.T).reshape(-1, TABLES * DIM))
                for grad, more in zip(grads[len(self.filters) :], (back, hidden * slope[:, None], slope[:, None])):
                    grad += more.sum(axis=0)
            for value, grad, square in zip(self._dense(), grads, dense_squares):
                square += grad**2
                value -= RATE * grad / np.sqrt(square)
            at, rise = np.concatenate(at, 1), np.concatenate(rise)
            for t, table in enumerate(self.tables):
                bucket, where = np.unique(at[t], return_inverse=True)
                grad = np.zeros((len(bucket), DIM), np.float32)
                np.add.at(grad, where, rise[:, t * DIM : (t + 1) * DIM])
                # Not the padding word, which is the last bucket.
                bucket, grad = bucket[bucket < size], grad[bucket < size]
                rows = t * size + bucket
                touched[rows] = True
                squares[rows] += grad**2
                table[bucket] -= RATE * grad / np.sqrt(squares[rows])
        return np.flatnonzero(touched)

    def calibrate(self, x: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Fit slope and shift of the logit on logits x of rows apart (Platt's
        method, with smoothed targets); the scores at x."""
        ones, zeros = weight[toxic == 1].sum(), weight[toxic == 0].sum()
        target = np.where(toxic == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
        beta = np.array([1.0, 0.0])
        design = np.stack([x, np.ones_like(x)], 1)
        ridge = np.diag([1e-3, 1e-3])
        for _ in range(60):
            p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
            gradient = design.T @ (weight * (p - target)) + ridge @ (beta - [1.0, 0.0])
            curve = (design * (weight * p * (1 - p))[:, None]).T @ design + ridge
            step = np.linalg.solve(curve, gradient)
            beta -= step * min(1.0, 2.0 / max(1e-9, np.abs(step).max()))
            if np.abs(step).max() < 1e-8:
                break
        # A falling slope means that the network has learnt nothing.
        self.slope, self.shift = max(0.0, float(beta[0])), float(beta[1])
        return 1 / (1 + np.exp(-np.clip(self.slope * x + self.shift, -30, 30)))


def _runs(sizes: np.ndarray) -> Iterator[slice]:
    """Runs of rows of at most PASS_WORDS words, or one row."""
    start = 0
    for i in range(1, len(sizes) + 1):
        if i == len(sizes) or sizes[start : i + 1].sum() > PASS_WORDS:
            yield slice(start, i)
            start = i


def best_threshold(scores: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> float:
    """The threshold of highest F1; of equally good ones the nearest to 0.3."""
    order = np.argsort(-scores, kind="stable")
    s, y, w = scores[order], toxic[order], weight[order]
    hit, all_hit = np.cumsum(w * y), (w * y).sum()
    if not all_hit:
        return THRESHOLD
    f1 = 2 * hit / (np.cumsum(w) + all_hit)
    last = np.append(s[1:] < s[:-1], True)  # a threshold cannot part equal scores
    f1 = np.where(last, f1, -1)
    best = np.flatnonzero(f1 >= f1.max() - 1e-12)
    low = np.append(s[1:], 0.0)[best]
    # Any threshold in (low, s] does the same.
    near = np.where((low < THRESHOLD) & (THRESHOLD <= s[best]), THRESHOLD, np.where(s[best] < THRESHOLD, s[best], (low + s[best]) / 2))
    return float(near[np.abs(near - THRESHOLD).argmin()])


class Toxicity:
    """A fitted classifier and the thresholds of the languages."""

    def __init__(self, model: TextCnn | None, thresholds: dict[str, float]) -> None:
        self.model, self.thresholds = model, thresholds


def _shards(rows: DataFrame, count: int) -> DataFrame:
    """(shard, labels, sizes, words): the rows (doc_id, label, words) dealt into
    `count` shards by a hash of their id, each of them one written row of about
    SHARD_ROWS."""

    def gathered(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["doc_id", "words"])
        sizes = frame["words"].map(len).to_numpy(np.int64)
        labels = frame["label"].to_numpy(np.int8)
        row = (frame["shard"].iloc[0], labels.tobytes(), sizes.tobytes(), b"".join(frame["words"]))
        return pd.DataFrame([row], columns=["shard", "labels", "sizes", "words"])

    dealt = rows.select("doc_id", "label", "words", F.pmod(F.xxhash64("doc_id", F.lit("shard")), F.lit(count)).alias("shard"))
    # As many partitions as shards, which are not put together again.
    return stored(
        dealt.repartition(count, "shard")
        .groupBy("shard")
        .applyInPandas(gathered, "shard long, labels binary, sizes binary, words binary"),
        "shards",
    )


def _read(labels: bytes, sizes: bytes, words: bytes) -> tuple[list[np.ndarray], np.ndarray]:
    ends = np.cumsum(np.frombuffer(sizes, np.int64)) // 8
    return np.split(unpacked(words), ends[:-1], axis=1), np.frombuffer(labels, np.int8).astype(np.int64)


def _seen(shards: DataFrame) -> np.ndarray:
    """Of each class the rows that hold a bucket: (class, table * 2 ** 17 + bucket)."""
    size = 1 << BUCKETS_LOG2

    def counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                seen = np.zeros((2, TABLES * size), np.int64)
                for keys, label in zip(*_read(row.labels, row.sizes, row.words)):
                    for t in range(TABLES):
                        seen[label, t * size + np.unique(keys[t])] += 1
                some = np.flatnonzero(seen.any(axis=0))
                yield pd.DataFrame({"row": some, "plain": seen[0, some], "toxic": seen[1, some]})

    found = shards.mapInPandas(counted, "row long, plain long, toxic long")
    found = found.groupBy("row").agg(F.sum("plain").alias("plain"), F.sum("toxic").alias("toxic")).toArrow()
    seen = np.zeros((2, TABLES * size))
    seen[:, found["row"].to_numpy()] = [found["plain"].to_numpy(), found["toxic"].to_numpy()]
    return seen


def _started() -> np.ndarray:
    """State and squares of a new network, side by side."""
    state = TextCnn().state()
    return np.concatenate([state, np.full_like(state, 1e-3)], 1).astype(np.float32)


def _epoch(shards: DataFrame, model: TextCnn, squares: np.ndarray, balance: np.ndarray, number: int) -> np.ndarray:
    """Train every shard from the model; set it to the mean of the shards and
    return their squares. The driver gets a sum per number of the model."""
    both = np.concatenate([model.state(), squares], 1).astype(np.float32)
    # Sent are the first numbers, which counts have set, and the rows that differ
    # elsewhere from a new network, which a task builds itself.
    at = np.flatnonzero((both[:, 1:] != _started()[:, 1:]).any(axis=1))
    sent = shards.sparkSession.sparkContext.broadcast(pickle.dumps((both[:, 0].copy(), at, both[at])))
    names = [f"{kind}{k}" for kind in "vs" for k in range(DIM)]

    def changes(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first, at, rows = pickle.loads(sent.value)
        before = _started()
        before[:, 0], before[at] = first, rows
        for frame in frames:
            for row in frame.itertuples(index=False):
                own, own_squares = TextCnn(), before[:, DIM:].copy()
                own.set_state(before[:, :DIM])
                changed = own.train(*_read(row.labels, row.sizes, row.words), balance, own_squares, [SEED, number, row.shard])
                after = np.concatenate([own.state()[changed], own_squares[changed]], 1)
                moved = np.rint((after - before[changed]) * FIXED).astype(np.int64)
                yield pd.DataFrame({"row": changed, **dict(zip(names, moved.T))})

    found = shards.mapInPandas(changes, "row long, " + ", ".join(f"{n} long" for n in names))
    found = found.groupBy("row").agg(F.count("*").alias("shards"), *[F.sum(n).alias(n) for n in names]).toArrow()
    sent.destroy()
    moved = np.stack([found[n].to_numpy() for n in names], 1)
    rows = found["row"].to_numpy()
    both[rows] = both[rows] + moved / FIXED / found["shards"].to_numpy()[:, None]
    model.set_state(both[:, :DIM])
    return both[:, DIM:].copy()


def fit_toxicity(docs: DataFrame, labels: DataFrame) -> Toxicity:
    """Train on all labelled rows that are not held out but for one in
    CALIBRATION_SHARE, on which scores and thresholds are set. The driver gets
    sums by number of the network (some two million) and counts of logits by
    language. Without rows of both classes there is no model and every score
    is 0."""

    @F.pandas_udf("binary")
    def hashed(texts: pd.Series) -> pd.Series:
        rows = texts.fillna("").tolist()
        return pd.Series([w for p in passes(rows) for w in packed(rows[p])], dtype=object)

    known = labelled_rows(docs, labels, "toxic", FOLDS, FOLD)
    apart = F.pmod(F.xxhash64("doc_id", F.lit("apart")), F.lit(CALIBRATION_SHARE)) == 0
    known = known.select("doc_id", "lang", F.col("label").cast("int").alias("label"), apart.alias("apart"), "text")
    rows = stored(known.withColumn("words", hashed("text")).drop("text"), "labelled-words")
    counts = np.zeros((2, 2), np.int64)
    for is_apart, label, number in rows.groupBy("apart", "label").count().collect():
        counts[int(is_apart), label] = number
    if not counts.sum(axis=0).all():
        return Toxicity(None, {})
    # Where one part lacks a class, all rows train or calibrate.
    train = rows.where("not apart") if counts[0].all() else rows
    judges = rows.where("apart") if counts[1].all() else rows
    of_class = counts[0] if counts[0].all() else counts.sum(axis=0)
    shards = _shards(train, -(-int(of_class.sum()) // SHARD_ROWS))
    model = TextCnn()
    model.start_from(_seen(shards), of_class)
    squares = _started()[:, DIM:]
    balance = 0.5 / of_class * of_class.sum()
    for number in range(EPOCHS):
        squares = _epoch(shards, model, squares, balance, number)
    return Toxicity(model, _calibrated(model, judges))


def _calibrated(model: TextCnn, rows: DataFrame) -> dict[str, float]:
    """Calibrate the model on rows (lang, label, words); the thresholds of the
    languages that have LEAST_TOXIC toxic rows."""
    read = shared(rows.sparkSession, model)

    @F.pandas_udf("long")
    def step(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = read()
        for batch in batches:
            words = batch.tolist()
            sizes, out = np.array([len(w) // 8 for w in words]), []
            for run in _runs(sizes):
                out.append(own.logits(unpacked(b"".join(words[run])), sizes[run]))
            steps = np.rint(np.concatenate([*out, np.zeros(0)]) * LOGIT_STEPS)
            yield pd.Series(np.clip(steps, -30 * LOGIT_STEPS, 30 * LOGIT_STEPS).astype(np.int64))

    language = F.coalesce("lang", F.lit("")).alias("lang")
    found = rows.select(language, "label", step("words").alias("step")).groupBy("lang", "label", "step").count().toPandas()
    found = found.sort_values(["lang", "label", "step"])
    toxic, weight = found["label"].to_numpy(np.int64), found["count"].to_numpy(float)
    scores = model.calibrate(found["step"].to_numpy() / LOGIT_STEPS, toxic, weight)
    languages, thresholds = found["lang"].to_numpy(), {}
    for name in np.unique(languages):
        own = languages == name
        if weight[own & (toxic == 1)].sum() >= LEAST_TOXIC:
            thresholds[str(name)] = best_threshold(scores[own], toxic[own], weight[own])
    return thresholds


def score(spark: SparkSession, fitted: Toxicity, text: Column) -> Column:
    """Score of the whole text, 0 to 1; a null text counts as empty."""
    if fitted.model is None:
        return F.lit(0.0)
    read = shared(spark, fitted.model)

    @F.pandas_udf("double")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = read()
        for batch in batches:
            texts = batch.fillna("").tolist()
            parts = [model.scores(texts[p]) for p in passes(texts)]
            yield pd.Series(np.concatenate([*parts, np.zeros(0)]))

    return of(text)


def threshold(fitted: Toxicity, lang: Column) -> Column:
    """The threshold of the row's language, 0.3 for a language without one."""
    known = [F.lit(x) for pair in fitted.thresholds.items() for x in pair]
    if not known:
        return F.lit(THRESHOLD)
    return F.coalesce(F.create_map(*known)[F.coalesce(lang, F.lit(""))], F.lit(THRESHOLD))


def _language(docs: DataFrame) -> Column:
    return F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted (score >= 0.3),
    threshold of its language and rejected (score >= that).

    Labels are learnt outside the held-out fold only; score and predicted come
    from the text alone. A null text counts as empty; rows that repeat get the
    same score; an empty table gives an empty result."""
    fitted = fit_toxicity(docs, labels)
    return (
        docs.select(
            "doc_id",
            held_out(F.col("doc_id"), FOLDS, FOLD).alias("held_out"),
            score(docs.sparkSession, fitted, F.col("text")).alias("score"),
            threshold(fitted, _language(docs)).alias("threshold"),
        )
        .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
        .withColumn("rejected", F.col("score") >= F.col("threshold"))
    )


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `docs` below the threshold of their language."""
    fitted = fit_toxicity(docs, labels)
    return docs.where(score(docs.sparkSession, fitted, F.col("text")) < threshold(fitted, _language(docs)))


@corpus_query("op3_toxicity")
def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))
