"""Removal of repeated passages through a compacted de Bruijn graph of words.

An edge of the graph is a window of 13 consecutive words; windows that overlap in 12 words
follow each other. Windows are handled as paths: the consecutive windows of a document that
share one anchor, the five words in them with the smallest hash. The anchor depends on the
words of a window alone, so equal windows of any documents lie in paths with equal anchors.

1. Anchors found in two documents or more are kept, with the smallest document and whether
   all paths through the anchor are equal (no branch).
2. A join with the anchors leaves the repeated paths of every document, by their coordinates.
   A path without branch is settled as a whole: later documents repeat the smallest one.
3. Paths that branch are cut back to single windows, whose smallest document is found by
   a second hash of their 13 words together with the anchor's, and joined back.
4. The words at the coordinates found are taken out of their texts.

All groups are reduced by partial aggregates; no path, anchor or passage is gathered in one
place, however many documents share it.
"""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import LEAST, id_of, in_tasks, pieces_of, stored, text_rows
from starloom.llm.words import _ROLL, find_words, mixed, runs_of, whole_runs, word_hashes

WINDOW = 13
ANCHOR = 5
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def paths(texts: pa.Array) -> tuple[np.ndarray, ...]:
    """(document, start, windows, anchor, path, window hashes) of all paths of some texts.

    ``start`` is the word in its text at which the first window begins; the window hashes
    of all paths stand one after the other.
    """
    words = find_words(texts)
    first = words.first
    one, two = word_hashes(words, 1), word_hashes(words, 2)
    valid = whole_runs(first, WINDOW)[:max(0, len(one) - WINDOW + 1)]
    marks = runs_of(one, ANCHOR)
    n = len(valid)
    best, place = marks[:n].copy(), np.arange(n)
    for j in range(1, WINDOW - ANCHOR + 1):
        other = marks[j:j + n]
        less = other < best
        best[less] = other[less]
        place[less] = np.flatnonzero(less) + j
    at = np.flatnonzero(valid)
    place, best = place[at], best[at]
    windows = runs_of(two, WINDOW)[at]
    document = np.searchsorted(first, at, "right") - 1
    opens = np.ones(len(at), bool)
    opens[1:] = (place[1:] != place[:-1]) | (document[1:] != document[:-1])
    start = np.flatnonzero(opens)
    if not len(start):
        none = np.zeros(0, np.int64)
        return none, none, none, none.view(np.uint64), none.view(np.uint64), none.view(np.uint64)
    count = np.diff(np.append(start, len(at)))
    rank = np.arange(len(at)) - np.repeat(start, count)
    path = np.add.reduceat(mixed(windows + rank.astype(np.uint64) * _ROLL), start)
    document = document[start]
    return document, at[start] - first[document], count, best[start], path, windows


def _path_rows(docs: DataFrame) -> DataFrame:
    def work(batches):
        for batch in batches:
            for part in pieces_of(batch, "text"):
                texts = part.column(1)
                document, start, count, anchor, path, _ = paths(texts)
                key = part.column(0).to_numpy()[document]
                check = np.array([zlib.crc32(t.as_buffer()) for t in texts], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor.view(np.int64)), pa.array(path.view(np.int64)), pa.array(key),
                     pa.array(check[document] if len(document) else check[:0]),
                     pa.array(start.astype(np.int32)), pa.array(count.astype(np.int32))],
                    ["anchor", "path", "key", "check", "start", "windows"])

    return in_tasks(docs, work, "anchor long, path long, key long, check long, start int, windows int")


def _single_windows(texts_and_paths: DataFrame) -> DataFrame:
    """The windows of the listed paths of each text."""
    def work(batches):
        for batch in batches:
            for part in pieces_of(batch, "text"):
                document, start, count, anchor, _, windows = paths(part.column(1))
                wanted = part.column(3).to_pylist()
                chosen = [set(w) for w in wanted]
                keep = np.fromiter((s in chosen[d] for d, s in zip(document.tolist(), start.tolist())), bool, len(start))
                every = np.repeat(keep, count)
                at = np.concatenate([[0], np.cumsum(count)])[:-1]
                begin = (np.arange(len(windows)) - np.repeat(at - start, count))[every]
                owner = np.repeat(document, count)[every]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(anchor, count)[every].view(np.int64)), pa.array(windows[every].view(np.int64)),
                     part.column(0).take(pa.array(owner)), part.column(2).take(pa.array(owner)),
                     pa.array(begin.astype(np.int32))],
                    ["anchor", "window", "key", "check", "start"])

    return in_tasks(texts_and_paths, work, "anchor long, window long, key long, check long, start int")


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(key, check, spans): the spans (start, words) of each text whose windows began earlier.

    ``docs`` has key and text; ``check`` is the CRC-32 of the text, so that different texts
    under one key stay apart. Spans may overlap.
    """
    rows = docs.select("key", "text")
    occurring = _path_rows(rows)
    anchors = stored(
        occurring.groupBy("anchor").agg(
            F.min("key").alias("least"), F.max("key").alias("most"),
            F.min("path").alias("path_a"), F.max("path").alias("path_z"))
        .where(F.col("least") < F.col("most"))
        .select("anchor", "least", (F.col("path_a") != F.col("path_z")).alias("branches")))
    repeated = stored(
        occurring.select("anchor", "key", "check", "start", "windows").join(anchors, "anchor")
        .where(F.col("branches") | (F.col("key") > F.col("least")))
        .select("key", "check", "start", "windows", "branches"))
    whole = repeated.where(~F.col("branches")).select(
        "key", "check", "start", (F.col("windows") + WINDOW - 1).alias("words"))
    branching = repeated.where("branches").groupBy("key", "check").agg(F.collect_list("start").alias("starts"))
    texts = rows.withColumn("check", F.crc32(F.col("text").cast("binary")))
    cut = _single_windows(texts.join(branching, ["key", "check"]).select("key", "text", "check", "starts"))
    cut = stored(cut)
    least = cut.groupBy("anchor", "window").agg(F.min("key").alias("least"), F.max("key").alias("most")) \
        .where(F.col("least") < F.col("most")).select("anchor", "window", "least")
    single = cut.join(least, ["anchor", "window"]).where(F.col("key") > F.col("least")).select(
        "key", "check", "start", F.lit(WINDOW).alias("words"))
    return stored(whole.unionByName(single).groupBy("key", "check").agg(
        F.collect_list(F.struct("start", "words")).alias("spans")))


def _without(words: list[str], spans) -> list[str]:
    """The words outside the spans."""
    if not spans:
        return words
    depth = np.zeros(len(words) + 1, np.int32)
    for s in spans:
        depth[s["start"]] += 1
        depth[s["start"] + s["words"]] -= 1
    return [w for w, d in zip(words, np.cumsum(depth[:-1]).tolist()) if d == 0]


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256 and ``kept``.

    A word goes if a window of 13 words that covers it also begins in a document with a
    smaller id, judged on the input. ``kept`` joins the remaining words by one space. A null
    text has no words; a null id counts as smaller than any other and stays null; rows that
    repeat an id do not count against each other; an empty table gives an empty one.
    """
    rows = text_rows(docs, id_col, text_col)
    spans = repeated_spans(rows)
    joined = rows.withColumn("check", F.crc32(F.col("text").cast("binary"))).join(
        spans, ["key", "check"], "left").select("key", "text", "spans")

    def work(batches):
        for batch in batches:
            for part in pieces_of(batch, "text"):
                n_words, n_removed, digests, texts = [], [], [], []
                for text, spans in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                    words = WORD.findall(text)
                    left = _without(words, spans)
                    n_words.append(len(words))
                    n_removed.append(len(words) - len(left))
                    texts.append(" ".join(left))
                    digests.append(hashlib.sha256(texts[-1].encode()).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                     pa.array(digests, pa.string()), pa.array(texts, pa.string())],
                    ["key", "n_words", "n_removed", "kept_sha256", "kept"])

    out = in_tasks(joined, work, "key long, n_words long, n_removed long, kept_sha256 string, kept string")
    return out.select(id_of(F.col("key")).alias("doc_id"), "n_words", "n_removed", "kept_sha256", "kept")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    size_col: str = "n_chars") -> DataFrame:
    """The rows of ``docs``, all columns, with the repeated words taken out of their texts.

    A text that loses words becomes the rest joined by one space, and ``size_col`` its length;
    all other texts stay as they are, nulls too.
    """
    key = F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LEAST))
    body = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    spans = repeated_spans(text_rows(docs, id_col, text_col))
    columns = list(docs.columns)
    marked = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)], key.alias("key"),
                         F.crc32(body.cast("binary")).alias("check")).join(spans, ["key", "check"], "left").drop("key", "check")
    text_at = columns.index(text_col)

    def work(batches):
        for batch in batches:
            texts = batch.column(text_at).to_pylist()
            for i, spans_of in enumerate(batch.column(len(columns)).to_pylist()):
                if spans_of:
                    texts[i] = " ".join(_without(WORD.findall(texts[i]), spans_of))
            yield batch.set_column(text_at, batch.schema.field(text_at), pa.array(texts, batch.schema.field(text_at).type))

    out = in_tasks(marked, work, ", ".join(f"`{c}` {t}" for c, t in marked.dtypes))
    changed = F.col("spans").isNotNull()
    chosen = [F.when(changed, F.length(f"c{text_at}").cast(docs.schema[c].dataType)).otherwise(F.col(f"c{i}"))
              if c == size_col else F.col(f"c{i}") for i, c in enumerate(columns)]
    return out.select(*[x.alias(c) for x, c in zip(chosen, columns)])
