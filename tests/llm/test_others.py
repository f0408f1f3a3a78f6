"""Licences, vectors, chat, segmentations, quality, pages and components."""

import math
import os
import random
import sys
import textwrap
import zlib

import brute
import data
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools")]

import __spark_entry__ as entry  # noqa: E402
import check_oracle  # noqa: E402

from starloom.llm import chat, components, extraction, licences, nbest, quality, vectors  # noqa: E402
from starloom.llm.words import find_words  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def con():
    return check_oracle.connect(FOLDER)


def test_subpackage_queries_are_registered():
    names = entry.queries()
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)] == [1] * 13
    assert "pipeline" in names


@pytest.mark.parametrize("name", sorted(n for n in entry.oracle_sql() if n.startswith("op")))
def test_query_equals_sql(spark, con, name):
    assert check_oracle.compare(entry.queries()[name](spark, FOLDER), con, entry.oracle_sql()[name]) == ""


@pytest.mark.parametrize("name", ["op4_license_scan", "op7_chat_formatting"])
def test_native_queries_stay_in_the_jvm(spark, name):
    plan = entry.queries()[name](spark, FOLDER)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "ExistingRDD"))


# --- components ---------------------------------------------------------------------------------


def test_components_of_chains_stars_and_noise(spark):
    rng = random.Random(4)
    pairs = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)]
    pairs += [(rng.randrange(2000, 2300), rng.randrange(2000, 2300)) for _ in range(150)] + [(5, 5), (None, 3), (7, None)]
    df = spark.createDataFrame(pairs, "a long, b long")
    found = {r.node: r.component for r in components.components(df, "a", "b").collect()}
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in pairs:
        if a is not None and b is not None and a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    assert found == {x: find(x) for x in root}
    assert components.components(df.limit(0), "a", "b").count() == 0


# --- 4 ------------------------------------------------------------------------------------------


def scanned(spark, files):
    df = spark.createDataFrame(files, "path string, text string, licence int, mark string")
    return {r.path: r for r in licences.scan(df).collect()}


def test_headers_and_inheritance(spark):
    rng = random.Random(1)
    long = data.prose(rng, 3000)
    found = scanned(spark, [
        ("a/LICENSE", "Released under the MIT License.", 1, None), ("a/b/c/x.py", "nothing here", None, "m"),
        ("a/b/y.py", long + "\nLicensed under the Apache License, Version 2.0\n" + long, None, None),
        ("a/d/LICENSE.txt", "This work is licensed under the GNU General Public License, version 3.", None, None),
        ("a/d/e/z.py", None, None, None), ("q/w.py", "", None, None), ("top.py", "x", None, None), (None, "y", None, None),
        ("a/d/e/z.py", None, None, None), ("s/k.txt", "words and words " * 50 + "\nAll rights reserved.", None, None)])
    assert (found["a/b/c/x.py"].licence, found["a/b/c/x.py"].origin, found["a/b/c/x.py"].from_dir) == ("MIT", "inherited", "a")
    assert (found["a/b/y.py"].licence, found["a/b/y.py"].origin) == ("Apache-2.0", "header")
    assert (found["a/d/e/z.py"].licence, found["a/d/e/z.py"].from_dir) == ("GPL-3.0", "a/d")
    assert found["q/w.py"].licence is None and found["top.py"].licence is None and found[""].licence is None
    assert found["s/k.txt"].origin == "header" and found["a/LICENSE"].score == 1
    assert len(found) == 9


def test_root_licence_reaches_all(spark):
    found = scanned(spark, [("LICENSE", "Licensed under CC BY-NC 4.0.", None, None), ("x/y/z.txt", "plain", None, None)])
    assert (found["x/y/z.txt"].licence, found["x/y/z.txt"].from_dir) == ("CC-BY-NC-4.0", "")


def test_wrapped_headers_full_texts_and_notices_within_paragraphs(spark):
    rng = random.Random(3)
    blocks = {name: text for name, text in licences.BLOCKS if len(text) > 200 and (name, text) not in licences.OPENINGS}
    filler = [(f"z/{i}.txt", data.prose(rng, 150), None, None) for i in range(60)]

    def wrapped(text, width, before=""):
        return "\n".join(before + line for line in textwrap.wrap(text, width))

    prose = data.prose(rng, 400)
    found = scanned(spark, filler + [
        ("m/TERMS", "MIT License\n\nCopyright (c) 2021 Some Body\n\n" + wrapped(blocks["MIT"], 72), None, None),
        ("m/src/a.py", "print(1)", None, None),
        ("g/b.c", "/*\n" + wrapped(blocks["GPL-3.0"], 70, " * ") + "\n */\n" + prose, None, None),
        ("l/b.c", wrapped(blocks["LGPL-3.0"], 60, "// ") + "\n" + prose, None, None),
        ("b/T", "Copyright (c) 2020, Some Body\nAll rights reserved.\n\n" + wrapped(blocks["BSD-3-Clause"], 76), None, None),
        ("b2/T", "Copyright (c) 2020, Some Body\n\n" + wrapped(blocks["BSD-2-Clause"], 76), None, None),
        ("p/d.py", wrapped(blocks["Apache-2.0"], 68, "# ") + "\n" + prose, None, None),
        ("i/T", wrapped(blocks["ISC"], 50), None, None),
        ("t/x.txt", prose + "\nMIT License\n" + prose, None, None),
        ("s/e.cs", "// Licensed under the MIT License. See LICENSE file in the project root for full license information.\n"
         + prose, None, None),
        ("w/f.txt", prose + " it is licensed under the Apache License, Version 2.0 and " + prose, None, None),
        ("o/T", wrapped(licences.OPENINGS[0][1], 60) + "\n" + data.prose(rng, 2000), None, None), ("o/a/q.c", "x", None, None)])
    assert {p: r.licence for p, r in found.items() if r.origin == "header"} == {
        "m/TERMS": "MIT", "g/b.c": "GPL-3.0", "l/b.c": "LGPL-3.0", "b/T": "BSD-3-Clause", "b2/T": "BSD-2-Clause",
        "p/d.py": "Apache-2.0", "i/T": "ISC", "t/x.txt": "MIT", "s/e.cs": "MIT", "w/f.txt": "Apache-2.0", "o/T": "GPL-3.0"}
    assert (found["m/src/a.py"].licence, found["m/src/a.py"].from_dir) == ("MIT", "m")
    assert (found["o/a/q.c"].licence, found["o/a/q.c"].from_dir) == ("GPL-3.0", "o")


def test_licence_scan_keeps_every_document(spark, tmp_path):
    mit, gpl = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."
    rows = [(1, None, "en", "plain"), (2, "web", None, mit), (None, "code", "de", gpl), (None, None, None, None),
            (5, "books", "en", mit), (5, "books", "en", gpl), (6, "news", "fr", "plain"), (6, "news", "fr", "plain")]
    schema = "doc_id long, source string, lang string, text string"
    run = entry.queries()["op4_license_scan"]

    def scan(name, part):
        spark.createDataFrame(part, schema).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        return run(spark, f"{tmp_path}/{name}")

    found = sorted((r.doc_id or 0, r.path, r.licence or "", r.origin or "") for r in scan("all", rows).collect())
    assert found == [
        (0, "///.txt", "", ""), (0, "code/de//.txt", "GPL-3.0", "header"), (1, "/en/0/1.txt", "", ""),
        (2, "web//0/2.txt", "MIT", "header"), (5, "books/en/0/5.txt", "GPL-3.0", "header"),
        (5, "books/en/0/5.txt", "MIT", "header"), (6, "news/fr/0/6.txt", "", ""), (6, "news/fr/0/6.txt", "", "")]
    # The SQL knows a file by its path alone, so ids are not repeated here.
    ours = scan("nulls", rows[:5])
    con = check_oracle.duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/nulls/documents.parquet/*.parquet')")
    assert check_oracle.compare(ours, con, entry.oracle_sql()["op4_license_scan"]) == ""


def test_words_needed_for_a_match_cover_every_template():
    idf, rows, needed = licences.weigh(licences.TEMPLATES, 1000, {"the": 900, "of": 700})
    for i in range(len(licences.TEMPLATES)):
        rest = sum(v * v for t, _, w, v in rows if t == i and w not in needed)
        assert rest < licences.THRESHOLD ** 2
        assert math.isclose(sum(v * v for t, _, _, v in rows if t == i), 1)


def test_no_files(spark):
    assert scanned(spark, []) == {}


# --- 5 ------------------------------------------------------------------------------------------


def vector_links(rows, cosine=0.93):
    pairs = []
    for i, (_, a, la) in enumerate(rows):
        for j in range(i):
            _, b, lb = rows[j]
            if la is None or la != lb or not a or not b or len(a) != len(b):
                continue
            x, y = (np.array([np.nan if v is None else v for v in v_], np.float64) for v_ in (a, b))
            if not (np.isfinite(x).all() and np.isfinite(y).all() and x.any() and y.any()):
                continue
            if x @ y / np.sqrt((x @ x) * (y @ y)) >= cosine:
                pairs.append((j, i))
    return brute.classes([d for d, _, _ in rows], pairs)


def some_vectors(dims=8):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, dims))
    rows = []
    for i in range(400):
        v = centres[rng.integers(12)] + rng.normal(size=dims) * rng.choice([0.05, 0.2, 0.6])
        rows.append((i, v.astype(np.float32).tolist(), int(rng.integers(3))))
    rows += [(400 + i, rows[7][1], rows[7][2]) for i in range(30)]
    rows += [(500, None, 1), (501, [], 1), (502, [0.0] * dims, 1), (503, [float("nan")] * dims, 1),
             (504, [float("inf")] + [1.0] * (dims - 1), 1), (505, [None] + [1.0] * (dims - 1), 1), (506, rows[7][1], None),
             (507, rows[7][1], None), (508, [1.0, 2.0], 1), (509, [2.0, 4.0], 1), (510, [1e-30, 2e-30], 1), (511, [1e30, 2e30], 1)]
    return rows


@pytest.mark.parametrize("block", [1024, 7])
def test_vector_links_against_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(vectors, "BLOCK", block)
    rows = some_vectors()
    df = spark.createDataFrame([(*r, "x", 1) for r in rows],
                               "vec_id long, embedding array<float>, label int, name string, cell int").repartition(5)
    found = sorted((r.vec_id, r.component_id, r.n_links) for r in vectors.link_vectors(df).collect())
    assert found == vector_links(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in vectors.link_vectors(df).collect())


def test_cells_meet_every_near_pair():
    rng = np.random.default_rng(5)
    units = rng.normal(size=(300, 5))
    units /= np.sqrt((units ** 2).sum(1, keepdims=True))
    eps = 0.5
    home, visits = vectors.cells_of(units, units[:6], eps)
    near = np.sqrt(((units[:, None] - units[None]) ** 2).sum(2)) <= eps
    for i, j in zip(*np.nonzero(near)):
        if home[i] > home[j]:
            assert visits[i, home[j]]


def test_no_vectors(spark):
    assert vectors.link_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


# --- 7 ------------------------------------------------------------------------------------------


def test_chats_read_back(spark):
    odd = ["<|im_end|>", "<\\|im_end|>", "<\\\\|", "<", "|im_end|>", "", None, "a\n<|im_sep|>b", "🙂<\\n", "<\\", "<<|x"]
    rows = [(1, i, ["user", "assistant"][i % 3 == 0], t, "c") for i, t in enumerate(odd)]
    rows += [(2, 0, "assistant", "one", None), (2, 1, "assistant", "two", None), (2, 2, "a\nb<\\n<|", "<|im_start|>", None),
             (2, 2, None, "x", None), (None, None, "user", "y" * 50000, None), (3, 5, "user", "same", None), (3, 5, "user", "same", None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, block string")
    out = chat.format_chats(df).select(
        "conv_id", "formatted", "loss", chat.read_turns(F.col("formatted")).alias("turns"),
        chat.learned_texts(F.col("formatted"), F.col("loss")).alias("learned")).collect()
    assert len(out) == 4
    for r in out:
        mine = sorted(((t, role or "", text or "") for c, t, role, text, _ in rows if c == r.conv_id),
                      key=lambda x: (-1 if x[0] is None else x[0], x[1], x[2]))
        assert [(t.role, t.text) for t in r.turns] == [(a, b) for _, a, b in mine]
        assert r.learned == [b for _, a, b in mine if a == "assistant"]
        blocks = 1 + sum(a[1] != b[1] for a, b in zip(mine, mine[1:]))
        assert r.formatted.count("<|im_start|>") == r.formatted.count("<|im_end|>\n") == blocks
        for s in r.loss:
            assert 0 <= s.start and s.start + s.length <= len(r.formatted)
    assert chat.format_chats(df.limit(0)).count() == 0


# --- 8 ------------------------------------------------------------------------------------------


def every_segmentation(pieces, text):
    if not text:
        return [(0.0, ())]
    unit = nbest.MARK + text.replace(nbest.MARK, nbest._LITERAL).replace(" ", nbest.MARK)
    edges, out = pieces.edges(unit), []

    def go(at, score, ids):
        if at == len(unit):
            out.append((score, ids))
        else:
            for j, s, more in edges[at]:
                go(j, score + s, ids + more)

    go(0, 0.0, ())
    return sorted(out, key=lambda r: -r[0])


def test_n_best_against_all_segmentations():
    pieces = nbest.Pieces(MODEL)
    for text in ["", "a", "the cat", "  x\ny", "é ▁ ①", "no no no", "abcde\n\nfg h", "▁▁", "tab\tx", "a.b!!"]:
        every = every_segmentation(pieces, text)
        for n in (1, 2, 4, 9):
            found = [(s, tuple(np.frombuffer(i, "<u2").tolist())) for s, i in pieces.segmentations(text, n)]
            assert [s for s, _ in found] == [s for s, _ in every[:n]]
            assert len(set(found)) == len(found) and set(found) <= set(every)
            assert all(pieces.decode(ids) == text for _, ids in found)


def test_encode_and_decode_rows(spark):
    texts = data.nasty_texts()
    df = data.documents(spark, texts)
    rows = nbest.decode_ids(nbest.encode_n_best(df, MODEL, 3), MODEL).collect()
    by_doc = {}
    for r in rows:
        assert r.decoded == (texts[r.doc_id] or "")
        by_doc.setdefault(r.doc_id, []).append((r.rank, r.score))
    assert len(by_doc) == len(texts)
    for found in by_doc.values():
        scores = [s for _, s in sorted(found)]
        assert scores == sorted(scores, reverse=True) and [k for k, _ in sorted(found)] == list(range(1, len(found) + 1))
    odd = spark.createDataFrame([([None, 99999, -1],), (None,)], "ids array<int>")
    assert [r.decoded for r in nbest.decode_ids(odd, MODEL).collect()] == ["", None]
    assert nbest.encode_n_best(data.empty(spark), MODEL).count() == 0


def test_n_best_report(spark):
    found = entry.queries()["op8_sentencepiece_nbest"](spark, FOLDER).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    assert len(found) == len(texts)
    pieces = nbest.Pieces(MODEL)
    for r in found:
        assert r.n_chars == len(texts[r.doc_id]) and r.round_trip and r.n_found == min(4, r.n_found)
        if len(texts[r.doc_id]) <= 2000:
            whole = nbest.MARK + texts[r.doc_id].replace(" ", nbest.MARK)
            first = np.frombuffer(pieces.n_best(whole, 4)[0][1], "<u2")
            assert r.best_score == sum(pieces.n_best(whole, 1)[0][:1]) and len(first) > 0
            assert r.last_score == pieces.n_best(whole, 4)[-1][0]


def test_every_segmentation_is_decoded(spark):
    class Wrong(nbest.Pieces):
        """Spoils the segmentation of one rank at one place."""

        def segmentations(self, text, n=4):
            found = super().segmentations(text, n)
            ids = np.frombuffer(found[self.rank][1], "<u2").copy()
            ids[self.at] ^= 1
            found[self.rank] = found[self.rank][0], ids.tobytes()
            return found

    text = "The quick brown fox, jumped \u6f22\u5b57 over\nthe lazy\u2581dogs " * 3
    right, pieces = nbest.Pieces(MODEL), Wrong(MODEL)
    ids = [np.frombuffer(raw, "<u2") for _, raw in right.segmentations(text, 4)]
    assert [right.decode(i.tolist()) for i in ids] == [text] * 4 and right.round_trips(text, ids) == 4
    assert right.round_trips("", [np.zeros(0, "<u2")]) == 1
    for rank in range(4):
        for at in (0, 7, -1):
            pieces.rank, pieces.at = rank, at
            ids = [np.frombuffer(raw, "<u2") for _, raw in pieces.segmentations(text, 4)]
            assert pieces.decode(ids[rank].tolist()) != text
            assert nbest._report(pieces, 1, text, 4)[-2:] == (3, False)
    rows = nbest.report_n_best(data.documents(spark, data.nasty_texts()), MODEL).collect()
    assert all(r.n_round_trips == r.n_found and r.round_trip for r in rows)


def test_ties_do_not_fan_out():
    pieces = nbest.Pieces(MODEL)
    found = pieces.n_best(nbest.MARK + "ab" * 400, 3)
    assert len(found) == 3 and pieces.segmentations("ab" * 400, 3)[0][0] == found[0][0]


# --- 9 ------------------------------------------------------------------------------------------


def test_held_out_quality(spark):
    folder = "/root/testdata/sf0.01"
    rows = entry.queries()["op9_quality_classifier"](spark, folder).collect()
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    assert len(rows) == 1000
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95


def test_scores_of_odd_rows(spark):
    docs = data.documents(spark, data.nasty_texts(), [None, *range(1, len(data.nasty_texts()))])
    labels = spark.createDataFrame([(i, i % 2, None) for i in range(60)] + [(None, 1, 1), (3, None, 1), (4, 0, 1), (4, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    rows = quality.score_documents(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    nothing = quality.score_documents(docs, labels.limit(0)).collect()
    assert {r.score for r in nothing} == {0.5}
    assert quality.score_documents(data.empty(spark), labels).count() == 0
    assert quality.keep_good(docs, labels.limit(0)).count() == docs.count()


def test_held_out_labels_do_not_matter(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    held = quality.is_held_out(F.col("doc_id"))
    turned = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (sorted(map(tuple, quality.score_documents(docs, x).collect())) for x in (labels, turned))
    assert a == b


def _context_by_hand(texts):
    """Context sums, word by word."""
    out = {}
    for text in texts:
        words = find_words(pa.array([text]))
        hashes = quality.hashes_of(words)
        own = quality.index_vectors(hashes).astype(int)
        for i, h in enumerate(hashes.tolist()):
            near = [own[j] for j in range(max(0, i - 2), min(len(own), i + 3)) if j != i]
            out[h] = out.get(h, 0) + sum(near, np.zeros(quality.DIMS, int))
    return out


def test_contexts_and_pooled_vectors_by_hand(spark, monkeypatch):
    texts = ["a b c a", "c d", "", "A, b! c? a.", "x " * 300, "a b c a", *data.nasty_texts()]
    texts = [t or "" for t in texts]
    truth = _context_by_hand(texts)
    monkeypatch.setattr(quality, "FULL", 4)
    rows = spark.createDataFrame(list(enumerate(texts)), "key long, text string").repartition(3)
    vectors = {r.word & (2 ** 64 - 1): r for r in quality.word_vectors(quality.context_sums(rows)).collect()}
    assert vectors.keys() == truth.keys()
    numbers_of = {}
    for h, sums in truth.items():
        made = quality.packed_vectors(np.array([h], np.uint64), np.array([sums]))
        assert [vectors[h][p] for p in quality.PARTS] == made[0].tolist()
        numbers_of[h] = quality.unpacked_vectors(made)[0]
        whole = sum(v / max(np.linalg.norm(v), 1e-9) for v in (quality.index_vectors(np.array([h], np.uint64))[0], sums))
        assert np.abs(numbers_of[h] - np.clip(whole * quality.SCALE, -7, 7)).max() <= 0.5 + 1e-9
    found = {r.key: r for r in quality.pooled(rows).collect()}
    for key, text in enumerate(texts):
        hashes = quality.hashes_of(find_words(pa.array([text]))).tolist()
        assert found[key].n_words == len(hashes)
        total = sum((numbers_of[h] for h in hashes), np.zeros(quality.DIMS, int))
        assert [found[key][p] for p in quality.SUMS] == total.tolist()


def test_no_two_words_share_a_vector():
    words = find_words(pa.array([" ".join(f"w{i}x" for i in range(20_000))]))
    hashes, sums = quality.contexts(words)
    assert len(hashes) == 20_000
    assert len(np.unique(quality.packed_vectors(hashes, sums), axis=0)) == 20_000


def test_good_rows_keep_clashing_columns(spark):
    docs = spark.createDataFrame([(i % 7 if i % 5 else None, "good words here" if i % 2 else None, i, "m", "r")
                                  for i in range(40)], "doc_id long, text string, key long, mark string, row string")
    labels = spark.createDataFrame([(i, 1) for i in range(7)], "doc_id long, quality int")
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert sorted(r.key for r in kept.collect()) == list(range(40))
    assert quality.score_documents(docs, labels).count() == 40


# --- 10 -----------------------------------------------------------------------------------------


def test_pages_against_their_articles(spark):
    import html
    import re

    rows = {r.page_id: r for r in entry.queries()["op10_html_extraction"](spark, FOLDER).collect()}
    for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect():
        article = re.search(r"<article>(.*?)(</article>|$)", r.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>|<br>", article)]
        expected = "\n".join(b for b in blocks if b)
        assert (rows[r.page_id].text, rows[r.page_id].n_chars, rows[r.page_id].url) == (expected, len(expected), r.url)


LONG = "This paragraph goes on for long enough that nobody could take it for a menu or a button, and says a thing or two."
PAGES = [
    ("<p>" + LONG, LONG),
    ("", ""), (None, ""), ("<", "<"[:0]), ("<!-- only", ""), ("<script>var a='<p>" + LONG, ""),
    (f"<body><div id='menu'><a href=1>Home</a></div><div class=content><h1>T &amp; U</h1><p>{LONG}<p>Short&nbsp;one.</div>"
     f"<div class='cookie-notice'><p>{LONG}</p></div><section id=comments><p>{LONG}</p></section>", f"T & U\n{LONG}\nShort one."),
    (f"<main><h2>Head</h2><p>a <b>b</b>c &lt;i&gt;</p><aside><p>{LONG}</p></aside><form><p>{LONG}</p></form><p>x</p></main>"
     f"<footer>{LONG}</footer>", "Head\na bc <i>\nx"),
    (f"<article><header><h1>Title</h1></header><p>{LONG}</p><div class=ad><p>{LONG}</p></div><footer>By me</footer></article>",
     f"Title\n{LONG}"),
    *((f"<body>{opening}<p>{LONG}</p><p>Tiny.</p><p>{LONG}</p></article>", f"{LONG}\nTiny.\n{LONG}") for opening in (
        "<article class='post comments-open'>", "<article class='ad-free'>")),
    *((f"<article><h1>Title</h1>{opening}<p>{LONG}</p>{closing}</article>", f"Title\n{LONG}") for opening, closing in (
        ("<section id=copyright-law>", "</section>"), ("<div class='notice-of-motion'>", "</div>"),
        ("<section id='search'>", "</section>"), ("<div class='article-header'>", "</div>"))),
    *((f"<body>{opening}<h1>Title</h1><p>{LONG}</p>{closing}<p>{LONG}</p>", f"Title\n{LONG}\n{LONG}") for opening, closing in (
        ("<section id=copyright-law>", "</section>"), ("<div class='notice-of-motion'>", "</div>"),
        ("<div class='article-header'>", "</div>"))),
    (f"<article><h2 id='search'>Search</h2><p>{LONG}</p></article>", f"Search\n{LONG}"),
    (f"<body><p>{LONG}</p><h2 id='search'>Search</h2><p>{LONG}</p>", f"{LONG}\nSearch\n{LONG}"),
    (f"<body><p>{LONG}</p><p>The end.</p><ul><li><a href=1>More</a></ul>", f"{LONG}\nThe end."),
    ("<body><p>" + "<a href=1>One of many links in a list that is long</a></p><p>See these too, all new</p><p>".join([""] * 3)
     + f"</p><div><p>{LONG}</p></div>", LONG),
    ("<article><p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn></math> hold.</p></article>", "Let x=1 hold."),
    (f"<article><p>See <span class='comment'>// this</span> and <span class='ad'>buy</span> more.</p><p class=notice>{LONG}</p>"
     "<ol class='commentList'><li>First!</li></ol></article>", f"See // this and\nmore.\n{LONG}"),
    *((f"<body><article><p>{LONG}</p></article><div {name}><p>{LONG}</p><p>{LONG}</p></div>", LONG) for name in (
        "id='remarks'", "class='reader-comments'", "class='site-footer'", "id=cookieBanner", "class='x related box'",
        "role='complementary'", "class='NEWSLETTER'", "hidden")),
    (f"<header><p>{LONG}</p></header><div><p>{LONG}</p><p>Tiny.</p><p>{LONG}</p></div>", f"{LONG}\nTiny.\n{LONG}"),
]


@pytest.mark.parametrize("page, text", PAGES)
def test_page_shapes(page, text):
    assert extraction.main_text(page or "") == text


def test_pages_with_nulls(spark):
    df = spark.createDataFrame([(1, None, None, "t"), (1, None, None, "t"), (None, "u", PAGES[0][0], None)],
                               "page_id long, url string, html string, text string")
    rows = extraction.extract_pages(df).collect()
    assert sorted((r.text, r.n_chars) for r in rows) == [("", 0), ("", 0), (LONG, len(LONG))]
    assert extraction.extract_pages(df.limit(0)).count() == 0


def test_the_tree_fits_its_table():
    tree = extraction.trained_tree()
    assert all(extraction.is_main(tree, r[:-1]) == bool(r[-1]) for r in extraction.LABELLED)

    def used(node):
        return {node[0]} | used(node[2]) | used(node[3]) if isinstance(node, tuple) else set()

    # Words, link density, and both of a neighbour take part; nothing of an article is dropped.
    assert {2, 3} <= used(tree) and used(tree) & {4, 6} and used(tree) & {5, 7}

    def leaves(node):
        if not isinstance(node, tuple):
            return [node]
        if node[0] == 0:
            return leaves(node[3] if node[1] < 1 else node[2])
        return leaves(node[2]) + leaves(node[3])

    assert min(leaves(tree)) >= 0.5
