"""Quality classifier: random-indexing word vectors, pooled per document, and a small network.

A word is its lower-cased letters without marks at its end, as a 64-bit hash. Its index vector
is sparse, of -1, 0 and 1, and made from that hash, so there is no table of words and no bound
on their number. Its context is the sum of the index vectors of the words within ``REACH`` of
it, over the whole corpus; the word vector is index and context, each of unit length, added and
rounded to whole numbers of four bits. A document is the mean of its word vectors. Three extras
stand beside it: the mean index vector of the forms of its words (first and last character,
capitals, doubled marks, length), the share of words that repeat one of the two before, and the
log of its length.

Contexts are summed per block of words inside a task, then per word by a shuffle. The vectors
are joined to the dictionaries of the documents' blocks, so a word costs one row per block, not
one per document. All sums are whole numbers, the same in any order.

A two-layer network is fitted on at most ``MOST_LABELLED`` labelled documents; its logits are
divided by a temperature fitted on a part held back.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm import blocks
from starloom.llm.common import LEAST, id_of, in_tasks, pieces_of, stored, text_rows
from starloom.llm.words import Words, find_words, mixed, word_hashes

DIMS = 32                       # a vector of four-bit numbers is two 64-bit ones
NONZERO = 4
MOST = 7                        # of four bits with a sign
SCALE = 4.6                     # of a unit vector; index and context together seldom pass ``MOST``
REACH = 2
FULL = 1 << 18                  # words in the dictionary of a block
LONGEST = 1 << 26               # words read into a block, so that its sums stay in 32 bits
SLICE_BYTES = 1 << 20
SIZE = 2 * DIMS + 2             # features of a document
HIDDEN = 32
MOST_LABELLED = 6000
LEAST_SCORE = 0.3
FOLDS = 5
PARTS = [f"v{i}" for i in range(DIMS // 16)]
SUMS = [f"p{i}" for i in range(DIMS)]

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_KIND = np.zeros(256, np.uint8)       # 0 other bytes
_KIND[97:123] = 1
_KIND[65:91] = 2
_KIND[48:58] = 3
_KIND[128:] = 4
for _i, _c in enumerate(b".,;:!?*$%&#|()[]{}<>/\\\"'+-=_@~^`"):
    _KIND[_c] = 5 + _i
_IS_MARK = _KIND >= 5


class Model(NamedTuple):
    centre: np.ndarray
    spread: np.ndarray
    layers: tuple
    temperature: float


def index_vectors(hashes: np.ndarray) -> np.ndarray:
    """The sparse random vector of each hash: ``NONZERO`` times 1 or -1, on dimensions it draws."""
    bits = mixed(hashes ^ np.uint64(0x5851F42D4C957F2D))
    out = np.zeros((len(hashes), DIMS), np.int16)
    rows = np.arange(len(hashes))
    for k in range(NONZERO):
        drawn = (bits >> np.uint64(6 * k)).astype(np.int64)
        out[rows, drawn & (DIMS - 1)] += np.where(drawn & DIMS, 1, -1).astype(np.int16)
    return out


def _cores(words: Words) -> np.ndarray:
    """End of each word without up to four marks at its end; its first byte stays."""
    core = words.end.copy()
    for _ in range(4):
        core = np.where((core > words.start + 1) & _IS_MARK[words.data[core - 1]], core - 1, core)
    return core


def owners(words: Words) -> np.ndarray:
    """The text of each word."""
    return np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))


def hashes_of(words: Words) -> np.ndarray:
    """The hash of each word, lower-cased and without marks at its end."""
    return word_hashes(Words(_LOWER[words.data], words.start, _cores(words), words.first), 3)


def forms_of(words: Words) -> np.ndarray:
    """A hash of each word's form."""
    data, start, end = words.data, words.start, words.end
    if not len(start):
        return np.zeros(0, np.uint64)
    kinds = _KIND[data]
    low = np.concatenate([[0], np.cumsum(kinds == 1)])
    high = np.concatenate([[0], np.cumsum(kinds == 2)])
    lows, highs, length = low[end] - low[start], high[end] - high[start], end - start
    doubled = (length > 1) & (data[end - 1] == data[np.maximum(end - 2, start)])
    form = kinds[start].astype(np.uint64)
    for part in (kinds[end - 1], doubled, lows > 0, np.minimum(highs, 2), np.minimum(length // 4, 4),
                 end - _cores(words)):
        form = form * np.uint64(64) + part.astype(np.uint64)
    return mixed(form + np.uint64(1))


def extras(words: Words, hashed: np.ndarray) -> np.ndarray:
    """Per text the sums of its forms' index vectors, and its words that repeat one of two before."""
    texts, owner = len(words.first) - 1, owners(words)
    forms, at = np.unique(forms_of(words), return_inverse=True)
    share = np.bincount(owner * len(forms) + at, minlength=texts * len(forms)).reshape(texts, len(forms))
    again = np.zeros(len(hashed), bool)
    for back in (1, 2):
        again[back:] |= (hashed[back:] == hashed[:-back]) & (owner[back:] == owner[:-back])
    return np.column_stack([share @ index_vectors(forms).astype(np.int64),
                            np.bincount(owner[again], minlength=texts)])


def contexts(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, sums): the distinct words, and the index vectors within ``REACH`` of each, summed."""
    hashed, owner = hashes_of(words), owners(words)
    if not len(hashed):
        return hashed, np.zeros((0, DIMS), np.int32)
    order = np.argsort(hashed, kind="stable")
    ranked = hashed[order]
    begins = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    at = np.empty(len(hashed), np.int64)
    at[order] = np.repeat(np.arange(len(begins)), np.diff(np.append(begins, len(hashed))))
    own = index_vectors(ranked[begins])[at]
    near = np.zeros_like(own)
    for back in range(1, REACH + 1):
        same = (owner[back:] == owner[:-back])[:, None]
        near[back:] += own[:-back] * same
        near[:-back] += own[back:] * same
    return ranked[begins], np.add.reduceat(near[order], begins, axis=0, dtype=np.int32)


class _Dictionary:
    """Distinct hashes, each with its place in the order of coming."""

    def __init__(self):
        self.hashes, self.places = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def __len__(self) -> int:
        return len(self.hashes)

    def places_of(self, distinct: np.ndarray) -> np.ndarray:
        """Places of ascending distinct hashes; new ones get the next."""
        at = np.searchsorted(self.hashes, distinct)
        known = np.zeros(len(distinct), bool)
        inside = at < len(self)
        known[inside] = self.hashes[at[inside]] == distinct[inside]
        out = np.empty(len(distinct), np.int64)
        out[known] = self.places[at[known]]
        out[~known] = np.arange(len(self), len(self) + int((~known).sum()))
        self.hashes, self.places = (np.insert(self.hashes, at[~known], distinct[~known]),
                                    np.insert(self.places, at[~known], out[~known]))
        return out

    def in_order(self) -> np.ndarray:
        out = np.empty(len(self), np.uint64)
        out[self.places] = self.hashes
        return out


def _halves(numbers: np.ndarray) -> np.ndarray:
    """Rows of numbers from -8 to 7 as four bits each: the first half of a row below the second."""
    low, high = np.hsplit((numbers + 8).astype(np.uint8), 2)
    return low | high << 4


def _whole(packed: np.ndarray) -> np.ndarray:
    return np.hstack([packed & 15, packed >> 4]).astype(np.int64) - 8


def _binary(rows: np.ndarray) -> pa.Array:
    """Each row of a matrix as its bytes."""
    return pa.FixedSizeBinaryArray.from_buffers(
        pa.binary(rows.itemsize * rows.shape[1]), len(rows),
        [None, pa.py_buffer(np.ascontiguousarray(rows))]).cast(pa.binary())


def _rows_of(raw: pa.Array) -> np.ndarray:
    """The sums that ``_binary`` holds in four, eight or 32 bits each."""
    length = pc.binary_length(raw).to_numpy(zero_copy_only=False)
    out = np.zeros((len(raw), DIMS), np.int64)
    for size, kind in ((DIMS // 2, "u1"), (DIMS, "i1"), (4 * DIMS, "<i4")):
        at = np.flatnonzero(length == size)
        if len(at):
            rows = np.frombuffer(b"".join(raw.take(pa.array(at)).to_pylist()), kind).reshape(len(at), -1)
            out[at] = _whole(rows) if size < DIMS else rows
    return out


def context_sums(rows: DataFrame) -> DataFrame:
    """(word, sums): the context of every word of (key, text) rows, once per block of a task."""
    def flushed(words, sums):
        hashes = words.in_order().view(np.int64)
        sums = sums[:len(hashes)]
        most = np.abs(sums).max(axis=1, initial=0)
        for mask, kind in ((most <= MOST, None), ((most > MOST) & (most < 128), np.int8), (most >= 128, np.int32)):
            if mask.any():
                rows = sums[mask]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes[mask]), _binary(rows.astype(kind) if kind else _halves(rows))], ["word", "sums"])

    def work(batches):
        words, sums, read = _Dictionary(), np.zeros((1 << 12, DIMS), np.int32), 0
        for batch in batches:
            for part in pieces_of(batch, "text", SLICE_BYTES):
                found = find_words(part.column(part.schema.get_field_index("text")))
                distinct, near = contexts(found)
                at = words.places_of(distinct)
                while len(words) > len(sums):
                    sums = np.concatenate([sums, np.zeros_like(sums)])
                sums[at] += near
                read += len(found.start)
                if len(words) >= FULL or read >= LONGEST:
                    yield from flushed(words, sums)
                    words, read = _Dictionary(), 0
                    sums[:] = 0
        yield from flushed(words, sums)

    return in_tasks(rows.select("text"), work, "word long, sums binary")


def packed_vectors(hashes: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Word vectors from contexts: ``DIMS`` times four bits as rows of 64-bit numbers."""
    out = np.zeros(sums.shape)
    for part in (index_vectors(hashes).astype(np.float64), sums.astype(np.float64)):
        length = np.sqrt((part * part).sum(1, keepdims=True))
        out += np.divide(part, length, out=np.zeros_like(part), where=length > 0)
    return _halves(np.clip(np.rint(out * SCALE), -MOST, MOST).astype(np.int8)).view("<i8")


def unpacked_vectors(vectors: np.ndarray) -> np.ndarray:
    """The ``DIMS`` numbers of each row of ``packed_vectors``."""
    return _whole(np.ascontiguousarray(vectors).view(np.uint8).reshape(len(vectors), DIMS // 2))


def word_vectors(sums: DataFrame) -> DataFrame:
    """(word, *PARTS): one row per word from its contexts of all blocks."""
    def made(words, total):
        vectors = packed_vectors(words.view(np.uint64), total)
        return pa.RecordBatch.from_arrays(
            [pa.array(words), *(pa.array(np.ascontiguousarray(v)) for v in vectors.T)], ["word", *PARTS])

    def work(batches):
        last = None  # the word a batch ends with may go on in the next one
        for batch in batches:
            if not batch.num_rows:
                continue
            words = batch.column(0).to_numpy()
            begins = np.flatnonzero(np.concatenate([[True], words[1:] != words[:-1]]))
            found, total = words[begins], np.add.reduceat(_rows_of(batch.column(1)), begins, axis=0)
            if last is not None:
                if found[0] == last[0][0]:
                    total[0] += last[1][0]
                else:
                    found, total = np.concatenate([last[0], found]), np.concatenate([last[1], total])
            last = found[-1:].copy(), total[-1:].copy()
            if len(found) > 1:
                yield made(found[:-1], total[:-1])
        if last is not None:
            yield made(*last)

    return in_tasks(sums.repartition("word").sortWithinPartitions("word"), work,
                    ", ".join(["word long", *(f"{p} long" for p in PARTS)]))


def document_words(rows: DataFrame) -> DataFrame:
    """(key, text) rows as blocks of word frequencies, with each text's hash, words and extras."""
    measures = [("key", pa.int64()), ("mark", pa.int64()), ("n_words", pa.int64()), ("extras", pa.list_(pa.int64()))]

    def work(batches):
        out, held = blocks.Blocks(pa.int64(), measures), _Dictionary()
        for batch in batches:
            for part in pieces_of(batch, "text", SLICE_BYTES):
                column = {n: part.column(i) for i, n in enumerate(part.schema.names)}
                words = find_words(column["text"])
                hashed = hashes_of(words)
                distinct, at = np.unique(hashed, return_inverse=True)
                places = held.places_of(distinct)[at]
                more = extras(words, hashed)
                yield out.documents(
                    *blocks.frequencies(owners(words), places, len(held), part.num_rows),
                    [column["key"], column["mark"], pa.array(np.diff(words.first), pa.int64()),
                     pa.FixedSizeListArray.from_arrays(pa.array(more.reshape(-1), pa.int64()), DIMS + 1)
                     .cast(pa.list_(pa.int64()))])
                if len(held) >= FULL:
                    yield from out.dictionary(held.in_order().view(np.int64))
                    held = _Dictionary()
        yield from out.dictionary(held.in_order().view(np.int64))

    return in_tasks(rows.withColumn("mark", F.xxhash64("text")), work,
                    blocks.LAYOUT.format("long") + ", key long, mark long, n_words long, extras array<long>")


def _summed(times, values):
    return (times.astype(np.float64) @ unpacked_vectors(values.T).astype(np.float64)).astype(np.int64).tolist()


def pooled(rows: DataFrame) -> DataFrame:
    """(key, mark, n_words, extras, *SUMS) of each row: the sum of its words' vectors, stored.

    ``mark`` is the hash of the text. Rows of equal texts have equal sums.
    """
    vectors = stored(word_vectors(context_sums(rows)))
    found = stored(document_words(rows))
    # Stored, so that the shuffle of the entries is gone before that of the documents begins.
    values = stored(blocks.entries(found).join(vectors, F.col("entry") == F.col("word")).select("block", "place", *PARTS))
    return stored(blocks.with_values(
        found, values, PARTS, ["key", "mark", "n_words", "extras"], _summed,
        "key long, mark long, n_words long, extras array<long>, " + ", ".join(f"{p} long" for p in SUMS)))


def features_of(n_words: np.ndarray, more: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Means of vectors and extras, and the log of the length."""
    scale = np.maximum(n_words, 1)[:, None]
    return np.hstack([sums / (SCALE * scale), more / scale, np.log1p(n_words)[:, None]])


def _forward(x, layers):
    w1, b1, w2, b2 = layers
    h = np.maximum(0, x @ w1 + b1)
    return h, h @ w2 + b2


def _sigmoid(z):
    return 0.5 * (1 + np.tanh(0.5 * z))


def fit(features: np.ndarray, labels: np.ndarray, steps: int = 1500) -> Model:
    """Train the network on four fifths of the rows and the temperature on the rest.

    Rows of one class only, or none, give a model whose score is that class (or 0.5).
    """
    centre = features.mean(0) if len(features) else np.zeros(SIZE)
    spread = features.std(0) + 1e-3 if len(features) else np.ones(SIZE)
    rng = np.random.default_rng(5)
    layers = [rng.normal(0, np.sqrt(2 / SIZE), (SIZE, HIDDEN)), np.zeros(HIDDEN),
              rng.normal(0, np.sqrt(1 / HIDDEN), HIDDEN), np.zeros(())]
    share = labels.mean() if len(labels) else 0.5
    if len(labels) < 20 or share in (0, 1):
        layers[2][:] = 0
        layers[3] = np.array(np.log((share * 0.98 + 0.01) / (1 - share * 0.98 - 0.01)))
        return Model(centre, spread, tuple(layers), 1.0)
    x = np.clip((features - centre) / spread, -6, 6)
    y = labels.astype(np.float64)
    order = rng.permutation(len(x))
    held, used = order[:len(x) // 5], order[len(x) // 5:]
    first = [np.zeros_like(p) for p in layers]
    second = [np.zeros_like(p) for p in layers]
    best, best_loss = [p.copy() for p in layers], np.inf
    for step in range(1, steps + 1):
        at = used[rng.integers(0, len(used), min(256, len(used)))]
        h, z = _forward(x[at], layers)
        d = (_sigmoid(z) - y[at]) / len(at)
        dh = np.outer(d, layers[2]) * (h > 0)
        slopes = [x[at].T @ dh + 1e-4 * layers[0], dh.sum(0), h.T @ d + 1e-4 * layers[2], d.sum()]
        rate = 3e-3 * (1 - step / (steps + 1)) * np.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step)
        for k, g in enumerate(slopes):
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            layers[k] = layers[k] - rate * first[k] / (np.sqrt(second[k]) + 1e-8)
        if step % 50 == 0:
            loss = _loss(_forward(x[held], layers)[1], y[held])
            if loss < best_loss:
                best, best_loss = [np.copy(p) for p in layers], loss
    z = _forward(x[held], best)[1]
    temperature = min(np.geomspace(0.3, 5, 120), key=lambda t: _loss(z / t, y[held]))
    return Model(centre, spread, tuple(best), float(temperature))


def _loss(z, y):
    return float(np.mean(np.logaddexp(0, z) - y * z))


def scores(features: np.ndarray, model: Model) -> np.ndarray:
    x = np.clip((features - model.centre) / model.spread, -6, 6)
    return _sigmoid(_forward(x, model.layers)[1] / model.temperature)


def is_held_out(doc_id):
    """Rows whose labels are never learned: crc32 of the id as text divides by ``FOLDS``."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def learn(found: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> Model:
    """The network from at most ``most`` labelled rows of ``pooled``.

    ``labels`` has doc_id and quality. Held-out and null ids, null labels and ids with
    contradicting labels are not learned; of the others those with the least hash are. Of
    several rows of one id the one with the least values is learned.
    """
    sample = (labels.select(F.col("doc_id").cast("long").alias("key"), F.col("quality").cast("int").alias("quality"))
              .where(F.col("key").isNotNull() & F.col("quality").isin(0, 1) & ~is_held_out(F.col("key")))
              .groupBy("key").agg(F.min("quality").alias("quality"), F.max("quality").alias("other"))
              .where("quality = other").orderBy(F.xxhash64("key"), "key").limit(most).select("key", "quality"))
    # At most ``most`` narrow rows are sent to every task, and as many come back.
    rows = (found.join(F.broadcast(sample), "key").groupBy("key")
            .agg(F.min(F.struct("quality", "n_words", "extras", F.array(*SUMS).alias("sums"))).alias("r"))
            .select("key", "r.*").collect())
    rows.sort()
    features = features_of(np.array([r["n_words"] for r in rows], np.float64),
                           np.array([r["extras"] for r in rows], np.float64).reshape(len(rows), DIMS + 1),
                           np.array([r["sums"] for r in rows], np.float64).reshape(len(rows), DIMS))
    return fit(features, np.array([r["quality"] for r in rows], np.int64))


def scored(rows: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> DataFrame:
    """(key, mark, score) of each row of (key, text)."""
    found = pooled(rows)
    model = learn(found, labels, most)

    def work(batches):
        for batch in batches:
            column = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            more = column["extras"].flatten().to_numpy().reshape(-1, DIMS + 1)
            sums = np.column_stack([column[p].to_numpy() for p in SUMS])
            x = features_of(column["n_words"].to_numpy(), more, sums)
            yield pa.RecordBatch.from_arrays(
                [column["key"], column["mark"], pa.array(scores(x, model), pa.float64())], ["key", "mark", "score"])

    return in_tasks(found, work, "key long, mark long, score double")


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    most: int = MOST_LABELLED) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    ``score`` (0 to 1) is the calibrated probability of quality label 1, from the whole text
    alone; ``predicted`` is 1 from ``LEAST_SCORE`` on. A null text is empty and is scored as
    such; null ids stay null and are not held out; repeated rows are scored each; without
    usable labels every score is 0.5; other columns are passed over; an empty table gives no rows.
    """
    out = scored(text_rows(docs, id_col, text_col), labels, most).withColumn("doc_id", id_of(F.col("key")))
    return out.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score",
                      F.when(F.col("score") >= LEAST_SCORE, 1).otherwise(0).alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id",
              most: int = MOST_LABELLED) -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores ``LEAST_SCORE`` or more.

    Equal texts have equal scores, so what is rejected is known by id and hash of the text. A
    null text is scored as an empty one; null ids and repeated rows are kept or go like any
    other; without usable labels every row stays; an empty table gives no rows.
    """
    rows = text_rows(docs, id_col, text_col)
    rejected = stored(scored(rows, labels, most).where(F.col("score") < LEAST_SCORE).select("key", "mark").distinct())
    key, text = (F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LEAST)),
                 F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))
    return (docs.select(key.alias("key"), F.xxhash64(text).alias("mark"), F.struct("*").alias("row"))
            .join(rejected, ["key", "mark"], "left_anti").select("row.*"))
