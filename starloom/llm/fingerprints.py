"""Document fingerprints: threshold-scaled sketches of five-word shingles.

One rule for every text: each shingle hash (48 bits) below a fixed share of the hash range is
kept, and the ``LEAST`` smallest hashes are kept as well, so that short texts can be compared
too. The rule looks at hashes only, so sketches of one rule merge into the sketch of both
texts' shingles together. A sketch is complete below its ``reach``: the share's limit, or
beyond it as far as the least hashes go. Two sketches are compared below the lower reach, so
likeness and containment need no common size. With m hashes of both texts compared, a likeness
J is off by about sqrt(J (1 - J) / m); texts of fewer than ``LEAST`` shingles are held whole.

Text form: 12 hex digits of the limit, 4 of the number of least hashes, ``:``, then base64 of
the hashes, ascending, six bytes each, most significant first.
"""

from __future__ import annotations

import base64
import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import LEAST as NO_ID
from starloom.llm.common import as_batch, in_tasks, pieces_of
from starloom.llm.words import find_words, shingles

WORDS = 5
SHARE = 1 / 2
LEAST = 32
_RANGE = 1 << 48


class Sketch(NamedTuple):
    limit: int
    least: int
    hashes: np.ndarray  # distinct, ascending: all below limit and the least ones

    @property
    def reach(self) -> int:
        """Every hash of the text below this one is kept."""
        if len(self.hashes) < self.least:
            return _RANGE
        return max(self.limit, int(self.hashes[-1]) + 1) if self.least else self.limit


def _kept(hashes: np.ndarray, limit: int, least: int) -> Sketch:
    return Sketch(limit, least, hashes[:max(least, int(hashes.searchsorted(limit)))])


def sketch(hashes: np.ndarray, share: float = SHARE, least: int = LEAST) -> Sketch:
    return _kept(np.unique(hashes), int(share * _RANGE), least)


def sketches(texts: list[str], share: float = SHARE, least: int = LEAST) -> list[Sketch]:
    values, first = shingles(find_words(pa.array(texts, pa.large_string())), WORDS)
    values = values >> np.uint64(16)
    return [sketch(values[a:b], share, least) for a, b in zip(first, first[1:])]


def merged(a: Sketch, b: Sketch) -> Sketch:
    """The sketch of both texts' shingles together, under the narrower rule if theirs differ."""
    return _kept(np.union1d(a.hashes, b.hashes), min(a.limit, b.limit), min(a.least, b.least))


def _shared(a: Sketch, b: Sketch) -> tuple[int, int, int]:
    reach = min(a.reach, b.reach)
    x, y = (s.hashes[:s.hashes.searchsorted(reach)] for s in (a, b))
    return len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y)


def likeness(a: Sketch, b: Sketch) -> float:
    """Estimated share of common shingles (Jaccard); 1 for two empty texts, 0 for one."""
    common, x, y = _shared(a, b)
    return common / (x + y - common) if x + y else 1.0


def containment(a: Sketch, b: Sketch) -> float:
    """Estimated share of a's shingles that b has too; 1 for an empty a."""
    common, x, _ = _shared(a, b)
    return common / x if x else float(len(a.hashes) == 0)


def to_string(s: Sketch) -> str:
    raw = s.hashes.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()
    return f"{s.limit:012x}{s.least:04x}:{base64.b64encode(raw).decode()}"


def from_string(text: str) -> Sketch:
    raw = np.frombuffer(base64.b64decode(text[17:]), np.uint8).reshape(-1, 6)
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, 2:] = raw
    return Sketch(int(text[:12], 16), int(text[12:16], 16), wide.reshape(-1).view(">u8").astype(np.uint64))


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by as much of the start of ``following``."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_chars, fingerprint) per row, without any shuffle.

    A null text is empty and its sketch holds nothing; equal texts have equal fingerprints;
    repeated rows and null ids are kept; an empty table gives an empty one.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))

    def work(batches):
        for batch in batches:
            for part in pieces_of(batch, "text"):
                texts = part.column(1).to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(t) for t in texts], pa.int64()),
                     pa.array([to_string(s) for s in sketches(texts)], pa.string())],
                    ["doc_id", "n_chars", "fingerprint"])

    return in_tasks(rows, work, "doc_id long, n_chars long, fingerprint string")


_EDITED = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
           "edited_fingerprint string, near_edited double, near_next double")
_EDITED_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])


def compare_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document's fingerprint against its edited text's and its successor's.

    Documents follow each other by id, then text; null ids come first (and stay null), a null
    text is empty, repeated rows follow each other, and the last row is followed by the first.
    Rows are dealt by quantiles of the id, one shuffle of the texts; the first document of a
    range goes to the range before it as well. An empty table gives an empty one.
    """
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NO_ID)).alias("key"),
                       F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    n_buckets = 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = rows.agg(F.count("*").alias("n"), F.min("key").alias("low")).first()
    buckets = max(1, min(n_buckets, found["n"] // 20))
    cuts: list[int] = [found["low"]] if found["n"] else []
    if buckets > 1:
        shares = [i / buckets for i in range(1, buckets)]
        cuts += rows.agg(F.percentile_approx("key", shares, 20 * buckets).alias("q")).first()["q"]
    cuts = sorted(set(cuts))

    def deal(batches):
        limits = np.array(cuts, np.int64)
        for batch in batches:
            keys = batch.column(0).to_numpy()
            bucket = np.searchsorted(limits, keys, "right") - 1
            opening = np.flatnonzero(limits[bucket] == keys) if len(limits) else np.zeros(0, np.int64)
            take = pa.array(np.concatenate([np.arange(batch.num_rows), opening]))
            before = bucket[opening] - 1
            wrap = before < 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([bucket, np.where(wrap, len(limits) - 1, before)]).astype(np.int32)),
                 pa.array(np.concatenate([np.zeros(batch.num_rows, bool), wrap])),
                 batch.column(0).take(take),
                 pa.array(np.concatenate([np.ones(batch.num_rows, bool), np.zeros(len(opening), bool)])),
                 batch.column(1).take(take)],
                ["bucket", "wrapped", "key", "own", "text"])

    def work(batches):
        held = None  # bucket, key, text, sketch of the last own row
        for batch in batches:
            for part in pieces_of(batch, "text"):
                bucket, _, key, own, texts = (c.to_pylist() for c in part.columns)
                marks = sketches(texts)
                done = []
                for b, k, o, t, s in zip(bucket, key, own, texts, marks):
                    if held and held[0] == b:
                        done.append((*held[1:], t, s))
                        held = None
                    if o:
                        held = (b, k, t, s)
                if done:
                    changed = [edited(t, following) for _, t, _, following, _ in done]
                    new = sketches(changed)
                    yield as_batch(_EDITED_ARROW, [
                        [None if k == NO_ID else k for k, *_ in done],
                        [len(t) for _, t, *_ in done],
                        [hashlib.sha256(c.encode()).hexdigest() for c in changed],
                        [to_string(s) for _, _, s, _, _ in done],
                        [to_string(s) for s in new],
                        [likeness(s, e) for (_, _, s, _, _), e in zip(done, new)],
                        [likeness(s, f) for _, _, s, _, f in done]])

    dealt = in_tasks(rows, deal, "bucket int, wrapped boolean, key long, own boolean, text string")
    dealt = dealt.repartition("bucket").sortWithinPartitions("bucket", "wrapped", "key", F.desc("own"), "text")
    return in_tasks(dealt, work, _EDITED)
