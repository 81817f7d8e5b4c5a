"""Language-model scores by a hashed maximum-entropy model.

The probability of a token is that of its class given its history times that of the token
within its class.  The most frequent words, a fixed number of them, are put into classes
of equal mass, words with the same typical neighbour together; all other words, unknown
ones included, are one more class.  The class is a softmax over weights of hashed
features of the history: the last word, the last two, the one before the last (a skip),
and the latest of a few very frequent words.  The weights start from counts and are then
trained by gradient steps: every task sums its part of the gradient, Spark adds the
parts, and the next step starts from the new weights.  The counts and every step are over
all training tokens.

Within its class a word is found on its way down a Huffman tree of the class's words: at each
node the turn has the odds of the counts, moved by weights of the same features of the history
and the node, hashed into a fixed number of slots.  So the history tells the words of a
class apart, the probabilities of a class sum to one, and a token costs the length of its path and not the
number of words.  These weights start from counts too and follow the same steps, by iterative
scaling: every move is half of the log ratio of observed to expected turns.  The words
that are not frequent share one class, in which the probability is the share of counts.

Word counts are exact and over all training documents.  They are joined to the documents'
words, except for the frequent ones, whose table has a fixed size and is broadcast, as
are the weights.  A word is known by a 64-bit hash.

Defined cases: a null or empty text is the end token alone; a document without an id
belongs to the training part; repeated documents count each time; without training
documents every token has probability 1; an empty table gives no rows.  Only the id and
the text are read, so other columns cannot clash.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .tokens import by_bytes

HELD_OUT, FOLDS = 2, 7
FREQUENT = (1 << 16) - 1  # words with a class of their own; ids fit 16 bits
CLASSES = 32
MARKERS = 16             # very frequent words whose last occurrence is a feature
BUCKETS = 1 << 14        # hashed features
STEPS = 2                # of the gradient, after the start from counts
RATE = 0.5               # of the Adagrad steps
PRIOR = 20.0             # tokens that a feature's start is smoothed with
BLOCK = 256              # features of a row of the gradient
SLOTS = 1 << 20          # hashed pairs of a feature and a node of the classes' trees
SLOT_BLOCK = 1 << 12     # slots of a row of the gradient
VISIT = float(1 << 26)   # in a sum that holds visits and turns, both whole and exact
WALK = 1 << 15           # tokens whose paths are walked at a time
CHUNK = 1 << 13          # tokens scored at a time
PART_TOKENS = 1 << 23    # of training that a part of the gradient covers at least
ADDED = 1 << 15          # histories whose class probabilities are added at a time
FEW = 64                 # runs that are longer than all others, summed one by one
TEXT_BYTES = 4 << 20     # of texts hashed at a time
ID_BYTES = 1 << 19       # of encoded texts whose features are made at a time
END = xxhash.xxh3_64_intdigest(b"\n") - (1 << 63)     # no word has white space
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], np.uint64)


def _hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all tokens, end tokens included, and the place past each text's last."""
    words = [(t or "").encode().lower().split() for t in texts]
    out, stops = np.empty(sum(map(len, words)) + len(words), np.uint64), np.empty(len(words), np.int64)
    at = 0
    for i, w in enumerate(words):
        out[at:at + len(w)] = np.fromiter(map(xxhash.xxh3_64_intdigest, w), np.uint64, len(w))
        at += len(w) + 1
        out[at - 1] = np.uint64(END + (1 << 63))
        stops[i] = at
    return (out ^ np.uint64(1 << 63)).view(np.int64), stops


def _add_rows(out: np.ndarray, place: np.ndarray, rows: np.ndarray) -> None:
    """Add each of ``rows`` to the row of ``out`` at its place: the first rows of all places are added at
    once, then the second ones and so on, and the rest of the few longest runs one by one."""
    order = np.argsort(place, kind="stable")
    own = place[order]
    at = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
    length = np.diff(np.append(at, len(own)))
    by = np.argsort(-length, kind="stable")
    at, length = at[by], length[by]
    total, r, live = rows.take(order[at], axis=0, mode="clip"), 1, np.searchsorted(-length, -1)
    while live > FEW:
        total[:live] += rows.take(order[at[:live] + r], axis=0, mode="clip")
        r += 1
        live = np.searchsorted(-length, -r)
    for i in range(live):
        total[i] += rows[order[at[i] + r:at[i] + length[i]]].sum(0)
    out[own[at]] += total


class Model:
    """What scoring needs; its size is fixed by the parameters."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, neighbour: np.ndarray, total: int, distinct: int):
        self.words, self.counts = words, counts                      # by descending count
        self.total, self.distinct = total, distinct
        order = np.lexsort((-counts, neighbour))
        mass = (np.cumsum(counts[order]) - counts[order]) / max(1, counts.sum())
        self.class_of = np.full(len(words) + 1, CLASSES, np.int64)   # the last stands for other words
        self.class_of[order] = (mass * CLASSES).astype(np.int64)
        self.rest, self.rest_distinct = total - int(counts.sum()), distinct - len(words)
        in_class = np.bincount(self.class_of[:-1], weights=counts, minlength=CLASSES + 1)
        self.mass = in_class + 0.0
        self.mass[CLASSES] = self.rest + 1
        with np.errstate(divide="ignore"):
            self.within = np.append(np.log10(counts / in_class[self.class_of[:-1]]), 0.0)
        share = self.mass / self.mass.sum()
        self.bias = np.where(self.mass > 0, np.log(np.maximum(share, 1e-30)), -1e30).astype(np.float32)
        self.weights = np.zeros((BUCKETS, CLASSES + 1), np.float32)
        self._grow()

    def _grow(self) -> None:
        """A Huffman tree of the words of each class: a word's path, from the leaf up, is a run of entries
        of the node's place among the slots, the turn taken there and the log odds of its counts."""
        up, turn, odds = np.full(2 * len(self.words), -1), np.zeros(2 * len(self.words), bool), np.zeros(2 * len(self.words))
        node, place = len(self.words), np.zeros(2 * len(self.words), np.int64)
        by_class = np.split(np.argsort(self.class_of[:-1], kind="stable"), np.cumsum(
            np.bincount(self.class_of[:-1], minlength=CLASSES))[:-1])
        for c, words in enumerate(by_class):
            heap, start = [(int(self.counts[w]), int(w)) for w in words], node
            heapq.heapify(heap)
            while len(heap) > 1:
                a, left = heapq.heappop(heap)
                b, right = heap[0]
                up[left] = up[right] = node
                turn[right], odds[node] = True, math.log(b / a)
                heapq.heapreplace(heap, (a + b, node))
                node += 1
            # Nodes come by ascending counts; those of the most visited are neighbours, which the caches like.
            place[start:node] = ((c + 1) * int(_ODD[0]) % (1 << 64) >> 33) + np.arange(node - start)[::-1]
        place &= SLOTS - 1
        # All words climb together; an entry is (word, step), and those of a word are put side by side.
        word, at, entries = np.arange(len(self.words)), np.arange(len(self.words)), []
        while len(word := word[(rises := up[at] >= 0)]):
            at = at[rises]
            entries.append((word, place[up[at]], turn[at], odds[up[at]]))
            at = up[at]
        word, self.place, self.turn, self.odds = [np.concatenate(x) for x in zip(*entries)] if entries else [
            np.zeros(0, t) for t in (np.int64, np.int64, bool, np.float64)]
        order = np.argsort(word, kind="stable")
        self.place, self.turn, self.odds = self.place[order].astype(np.int32), self.turn[order], self.odds[order].astype(np.float32)
        self.steps = np.bincount(word, minlength=len(self.words) + 1)     # the last stands for other words
        self.starts = np.cumsum(self.steps) - self.steps
        self.slots = np.zeros(SLOTS, np.float32)

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of the frequent words, FREQUENT for others."""
        if not len(self.words):
            return np.full(len(hashes), FREQUENT, np.uint16)
        at = pc.index_in(pa.array(hashes), value_set=pa.array(self.words))
        return pc.fill_null(at, FREQUENT).to_numpy().astype(np.uint16)

    def classes(self, ids: np.ndarray) -> np.ndarray:
        return self.class_of[np.minimum(ids, len(self.words))]

    def features(self, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """The buckets of each token's history, in columns; a text starts with no history."""
        n, ids = len(ids), ids.astype(np.uint64) + np.uint64(1)
        place = np.arange(n)
        first = np.maximum.accumulate(np.where(starts, place, 0))
        back = lambda k: np.where(place - k >= first, ids[np.maximum(place - k, 0)], np.uint64(0))
        one, two = back(1), back(2)
        marked = np.where((ids <= MARKERS), place, -1)
        latest = np.concatenate([[-1], np.maximum.accumulate(marked)[:-1]])
        marker = np.where(latest >= first, ids[np.maximum(latest, 0)], np.uint64(0))
        keys = (one, one * np.uint64(FREQUENT + 2) + two, two, marker)
        return np.stack([((k + np.uint64(1)) * o + np.uint64(i << 60) >> np.uint64(40)) % np.uint64(BUCKETS)
                         for i, (k, o) in enumerate(zip(keys, _ODD))], 1).astype(np.int64)

    def logits(self, features: np.ndarray) -> np.ndarray:
        """Of every class, less the largest."""
        logits = self.bias + self.weights.take(features[:, 0], axis=0, mode="clip")     # all are within; spares a check
        for k in range(1, features.shape[1]):
            logits += self.weights.take(features[:, k], axis=0, mode="clip")
        logits -= logits.max(1, keepdims=True)
        return logits

    def log_softmax(self, features: np.ndarray) -> np.ndarray:
        logits = self.logits(features)
        return logits - np.log(np.exp(logits).sum(1, keepdims=True))

    def expected(self, features: np.ndarray, times: np.ndarray, out: np.ndarray) -> None:
        """Add the class probabilities of all tokens, ``times`` each, to the rows of their features."""
        for a in range(0, len(times), ADDED):
            f = features[a:a + ADDED].astype(np.uint16)
            p = self.logits(f)
            np.exp(p, out=p)
            p *= (times[a:a + ADDED] / p.sum(1))[:, None].astype(np.float32)
            for k in range(f.shape[1]):
                _add_rows(out, f[:, k], p)

    def walk(self, ids: np.ndarray, features: np.ndarray) -> Iterator[tuple]:
        """The tokens' paths, some tokens at a time: the place of the first and how many, and of each entry the token
        (from the first), the slots of its features, the turn and the log odds that the counts give it."""
        mixed = (features.T.astype(np.uint64) * _ODD[1] >> np.uint64(40)).astype(np.int64)
        for a in range(0, len(ids), WALK):
            known = np.minimum(ids[a:a + WALK], len(self.words))
            steps = self.steps[known]
            token = np.repeat(np.arange(len(known)), steps)
            entry = np.arange(len(token)) + np.repeat(self.starts[known] - np.cumsum(steps) + steps, steps)
            place, at = self.place.take(entry).astype(np.int64), []
            for m in mixed:
                m = m[a:a + WALK].take(token)
                m += place
                m &= SLOTS - 1
                at.append(m)
            yield a, len(known), token, at, self.turn.take(entry), self.odds.take(entry)

    def turns(self, at: list[np.ndarray], odds: np.ndarray) -> np.ndarray:
        """Log odds of the turns, given the history."""
        odds = odds + self.slots.take(at[0], mode="clip")
        for x in at[1:]:
            odds += self.slots.take(x, mode="clip")
        return odds

    def add_turns(self, ids: np.ndarray, features: np.ndarray, times: np.ndarray, out: np.ndarray, observed: bool) -> None:
        """Add to the slots of the tokens' paths, ``times`` each, ``VISIT`` times the visits plus the right turns
        and those that the counts alone expect; or else only those expected given the history."""
        for a, n, token, at, turn, odds in self.walk(ids, features):
            each = times[a:a + n].take(token).astype(np.float64)
            p = each / (1 + np.exp(-(odds if observed else self.turns(at, odds))))
            both = each * (turn + VISIT) if observed else None
            for x in at:
                if observed:
                    np.add.at(out[0], x, both)
                np.add.at(out[-1], x, p)

    def word_given_class(self, ids: np.ndarray, features: np.ndarray) -> np.ndarray:
        """log10 of the probability of each token within its class; 0 for other words."""
        out = np.empty(len(ids))
        for a, n, token, at, turn, odds in self.walk(ids, features):
            z = self.turns(at, odds)
            np.negative(z, where=turn, out=z)
            lost = np.maximum(z, 0) + np.log1p(np.exp(-np.abs(z)))
            out[a:a + n] = np.bincount(token, weights=lost, minlength=n) / -math.log(10)
        return out


def _slices(batch: pa.RecordBatch, column: int, most: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``most`` bytes in a column: what numpy makes of a part is
    many times its size, and an executor holds several workers."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column).cast(pa.binary())), 0)
    for a, b in by_bytes(sizes.to_pylist(), most):
        yield batch.slice(a, b - a)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parts = [(c.field("values").to_numpy(), c.field("counts").to_numpy()) for c in (
                    pa.array(_hashes(x.column(0).to_pylist())[0]).value_counts() for x in _slices(batch, 0, TEXT_BYTES))]
        if parts:
            h, at = np.unique(np.concatenate([h for h, _ in parts]), return_inverse=True)
            n = np.bincount(at, weights=np.concatenate([n for _, n in parts])).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(n)], ["h", "n"])


def _encode(docs: DataFrame, model: Model) -> DataFrame:
    """``row, doc_id, held_out, ids, others``: 16-bit numbers of a document's tokens, and the
    hashes of those that are not frequent."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in (x for whole in batches for x in _slices(whole, 3, TEXT_BYTES)):
            hashes, stops = _hashes(batch.column(3).to_pylist())
            ids = m.ids(hashes)
            raw, other = ids.tobytes(), hashes[ids == FREQUENT]
            ends = np.cumsum(np.concatenate([[0], ids == FREQUENT]))[np.concatenate([[0], stops])]
            begin = [0, *stops[:-1].tolist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3],
                 pa.array([raw[2 * a:2 * b] for a, b in zip(begin, stops.tolist())], pa.binary()),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(other, pa.int64()))],
                ["row", "doc_id", "held_out", "ids", "others"])

    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = dict(docs.dtypes)["doc_id"]
    return stored(docs.withColumn("row", F.monotonically_increasing_id())
                  .select("row", "doc_id", "held_out", "text").mapInArrow(
                      encode, f"row long, doc_id {kind}, held_out boolean, ids binary, others array<long>"), "encoded")


def _texts(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All ids of a batch, where texts start, and the starts' places."""
    raw = column.to_pylist()
    ids = np.frombuffer(b"".join(raw), np.uint16)
    at = np.cumsum([0] + [len(x) // 2 for x in raw])[:-1]
    starts = np.zeros(len(ids), bool)
    starts[at] = True
    return ids, starts, at


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often a frequent word follows each of the markers."""
    for batch in (x for whole in batches for x in _slices(whole, 0, ID_BYTES)):
        ids, starts, _ = _texts(batch.column(0))
        follows = np.zeros(len(ids), bool)
        follows[1:] = (ids[:-1] < MARKERS) & ~starts[1:] & (ids[1:] < FREQUENT)
        at = np.flatnonzero(follows)
        key, n = np.unique(ids[at].astype(np.int64) * MARKERS + ids[at - 1], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(key // MARKERS), pa.array(key % MARKERS), pa.array(n)],
                                         ["w", "m", "n"])


def _distinct(ids: np.ndarray, features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first of the tokens that are the same word with the same history, and how many there are; by the
    last word and the word, so that what they touch lies together."""
    one, pair, skip, marker = features.T
    marker = np.searchsorted(np.unique(marker), marker)            # few values: 14 + 16 + 14 + 14 + 5 bits are enough
    key = (((one << 16 | ids) << 14 | pair) << 14 | skip) << 5 | marker
    order = np.argsort(key)
    key = key[order]
    at = np.flatnonzero(np.diff(key, prepend=-1))
    return order[at], np.diff(np.append(at, len(key)))


def _counted(encoded: DataFrame, model: Model, observed: bool, slots: np.ndarray) -> np.ndarray:
    """Observed, or else expected, counts of (feature, class) over all training tokens.  ``slots``
    is filled with those of the words' paths: visits, right turns and those that the counts alone
    expect, or else the right turns expected given the history."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, width = shared.value, CLASSES + 1
        total = np.zeros((BUCKETS, width))
        paths = np.zeros((2 if observed else 1, SLOTS))
        for batch in (x for whole in batches for x in _slices(whole, 0, ID_BYTES)):
            ids, starts, _ = _texts(batch.column(0))
            features = m.features(ids, starts)
            first, times = _distinct(ids, features)
            ids, features = ids[first], features[first]
            m.add_turns(ids, features, times, paths, observed)
            if observed:
                classes = m.classes(ids)
                for k in range(features.shape[1]):
                    total += np.bincount(features[:, k] * width + classes, weights=times,
                                         minlength=total.size).reshape(total.shape)
            else:
                m.expected(features, times, total)
        if observed:
            visits = np.floor(paths[0] / VISIT)
            paths = np.stack([visits, paths[0] - visits * VISIT, paths[1]])
        # Slots in half the width: they are most of what is shuffled.
        sums = [total[b:b + BLOCK].tobytes() for b in range(0, BUCKETS, BLOCK)]
        sums += [paths[:, b:b + SLOT_BLOCK].astype(np.float32).tobytes() for b in range(0, SLOTS, SLOT_BLOCK)]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(sums)), pa.int32()), pa.array(sums, pa.binary())],
                                         ["block", "sums"])

    def add(t: pa.Table) -> pa.Table:
        kind = np.float64 if t["block"][0].as_py() < BUCKETS // BLOCK else np.float32
        total = sum(np.frombuffer(x.as_buffer(), kind).astype(np.float64) for x in t["sums"])
        return pa.table({"block": t["block"][:1], "sums": pa.array([total.astype(kind).tobytes()], pa.binary())})

    sc = encoded.sparkSession.sparkContext
    shared = sc.broadcast(model)
    # Every task has a sum of its own, of a fixed size, so small files are read together.
    parts = max(sc.defaultParallelism, -(-model.total // PART_TOKENS))
    summed = (encoded.where("not held_out").select("ids").coalesce(parts).mapInArrow(part, "block int, sums binary")
              .groupBy("block").applyInArrow(add, "block int, sums binary"))
    out, first = np.zeros((BUCKETS, CLASSES + 1)), BUCKETS // BLOCK
    for r in summed.collect():                                       # of a fixed size
        if r["block"] < first:
            out[r["block"] * BLOCK:(r["block"] + 1) * BLOCK] = np.frombuffer(r["sums"], np.float64).reshape(
                BLOCK, CLASSES + 1)
        else:
            a = (r["block"] - first) * SLOT_BLOCK
            slots[:, a:a + SLOT_BLOCK] = np.frombuffer(r["sums"], np.float32).reshape(len(slots), -1)
    shared.destroy()
    return out


def _moves(visits: np.ndarray, right: np.ndarray, alone: np.ndarray, expected: np.ndarray) -> np.ndarray:
    """Half of the log ratio of observed to expected turns, to the right less to the left; the
    smoothing has the odds of the counts."""
    share = np.clip(alone / np.maximum(visits, 1), 1e-6, 1 - 1e-6)
    ratio = [np.log((np.maximum(seen, 0) + PRIOR * s) / (np.maximum(want, 0) + PRIOR * s)) for seen, want, s in (
        (right, expected, share), (visits - right, visits - expected, 1 - share))]
    return np.where(visits > 0, (ratio[0] - ratio[1]) / 2, 0).astype(np.float32)


def _train(encoded: DataFrame, model: Model) -> None:
    squares = np.zeros_like(model.weights)
    used = model.mass > 0
    visits, right, alone = turns = np.zeros((3, SLOTS))
    expected = np.zeros((1, SLOTS))
    seen = _counted(encoded, model, True, turns)
    # Each feature alone would move the class shares this way; the features share the move.
    share = np.exp(model.bias)
    near = (seen + PRIOR * share) / (seen.sum(1, keepdims=True) + PRIOR)
    with np.errstate(divide="ignore", invalid="ignore"):
        model.weights = np.where(used, (np.log(near) - model.bias) / 2, 0).astype(np.float32)
    model.slots = _moves(visits, right, alone, alone)
    for _ in range(STEPS):
        # A feature's mean error, so that a rare feature steps as far as a frequent one.
        error = (seen - _counted(encoded, model, False, expected)) / (seen.sum(1, keepdims=True) + PRIOR)
        squares += error ** 2
        model.weights += np.where(used, RATE * error / (np.sqrt(squares) + 1e-2), 0).astype(np.float32)
        model.slots += _moves(visits, right, alone, expected[0])


def fit(docs: DataFrame) -> tuple[Model, DataFrame, DataFrame]:
    """The model, the word counts ``(h, c)`` and the encoded documents; ``docs`` has
    ``doc_id, text, held_out``."""
    vocabulary = stored(docs.where("not held_out").select("text").mapInArrow(_counts, "h long, n long")
                        .groupBy("h").agg(F.sum("n").alias("c")), "vocabulary")
    total, distinct = vocabulary.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    # A fixed number of rows.
    top = vocabulary.orderBy(F.desc("c"), "h").limit(FREQUENT).toArrow()
    words, counts = np.asarray(top["h"]), np.asarray(top["c"]).astype(np.int64)
    encoded = _encode(docs, Model(words, counts, np.zeros(len(words), np.int64), total, distinct))
    lift = F.col("n") / F.get(F.lit([float(c) for c in counts[:MARKERS]] or [1.0]), F.col("m").cast("int"))
    typical = (encoded.where("not held_out").select("ids").mapInArrow(_pairs, "w long, m long, n long")
               .groupBy("w", "m").agg(F.sum("n").alias("n"))
               .groupBy("w").agg(F.max_by("m", F.struct(lift, -F.col("m"))).alias("m")).toArrow())
    neighbour = np.full(len(words), MARKERS, np.int64)
    neighbour[np.asarray(typical["w"])] = np.asarray(typical["m"])
    model = Model(words, counts, neighbour, total, distinct)
    _train(encoded, model)
    return model, vocabulary, encoded


def scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row
    of ``docs``, from a model that has not seen the held-out ones."""
    fold = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % FOLDS
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), (fold == HELD_OUT).alias("held_out"))
    model, vocabulary, encoded = fit(docs)
    unit = math.log10(model.total + model.distinct + 1)
    rest = math.log10(model.rest + model.rest_distinct + 1)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        alone = np.append(np.log10(m.counts + 1.0) - unit, -unit)
        for batch in (x for whole in batches for x in _slices(whole, 3, ID_BYTES)):
            ids, starts, at = _texts(batch.column(3))
            features, known = m.features(ids, starts), np.minimum(ids, len(m.words))
            value = np.empty(len(ids))
            for a in range(0, len(ids), CHUNK):
                p = m.log_softmax(features[a:a + CHUNK])
                value[a:a + CHUNK] = p[np.arange(len(p)), m.class_of[known[a:a + CHUNK]]] / math.log(10)
            value += np.where(ids < FREQUENT, m.word_given_class(ids, features), -rest)
            total = lambda x: pa.array(np.add.reduceat(x, at) if len(at) else x[:0])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], total(np.ones(len(ids), np.int64)), total((ids < FREQUENT).astype(np.int64)),
                 total(alone[known]), total(value)],
                ["row", "doc_id", "held_out", "n_tokens", "n_frequent", "base", "model"])

    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = dict(docs.dtypes)["doc_id"]
    scored = encoded.select("row", "doc_id", "held_out", "ids").mapInArrow(
        score, f"row long, doc_id {kind}, held_out boolean, n_tokens long, n_frequent long, base double, model double")
    # The other words' counts are joined; none of them is frequent, so no key is hot.
    others = encoded.select("row", F.explode("others").alias("h")).join(vocabulary, "h", "left")
    others = others.groupBy("row").agg(F.sum(F.log10(F.coalesce("c", F.lit(0)) + 1)).alias("more"),
                                       F.count("c").alias("n_more"))
    more = F.coalesce("more", F.lit(0.0))
    return scored.join(others, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_frequent") + F.coalesce("n_more", F.lit(0))).alias("n_known"),
        F.lit(model.total).cast("long").alias("train_tokens"), (F.col("base") + more).alias("base_score"),
        (F.col("model") + more).alias("score"))
