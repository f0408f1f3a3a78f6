"""Fingerprints, substring removal, the near-duplicate join, packing and the pipeline."""

import hashlib
import random
import zlib
from collections import defaultdict

import brute
import data
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from starloom.llm import fingerprints, forest, packing, substrings, tokens, words

FOLDER = "/root/testdata/sf0.001"
WORD_FILE = public_tokenizers.path("word_bpe_49k.json")


def clashing(docs):
    """Columns named like the operators' own, with nulls in them."""
    names = ["key", "check", "name", "spans", "bucket", "part", "tokens", "c0", "label", "a b"]
    return docs.select("*", *[F.lit(None).cast("string").alias(n) for n in names])


@pytest.fixture(scope="module")
def nasty(spark):
    return data.documents(spark, data.nasty_texts())


@pytest.fixture(scope="module")
def table(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    return sorted((r.doc_id, r.text) for r in rows)


# --- words ------------------------------------------------------------------------------------


def test_words_and_shingles_equal_plain_python():
    texts = [t or "" for t in data.nasty_texts()]
    found = words.find_words(pa.array(texts))
    hashes = words.word_hashes(found)
    seen = {}
    for i, t in enumerate(texts):
        expected = brute.WORD.findall(t)
        a, b = found.first[i], found.first[i + 1]
        assert [bytes(found.data[s:e]).decode() for s, e in zip(found.start[a:b], found.end[a:b])] == expected
        for w, h in zip(expected, hashes[a:b].tolist()):
            assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)
    values, first = words.shingles(found, 5)
    for i, t in enumerate(texts):
        assert len(set(values[first[i]:first[i + 1]].tolist())) == len(brute.shingle_set(t))


# --- 1 ------------------------------------------------------------------------------------------


def test_sketches_compare_unequal_texts():
    rng = random.Random(1)
    whole = data.prose(rng, 20000).split()
    long, short = " ".join(whole), " ".join(whole[:1500])
    a, b = fingerprints.sketches([long, short])
    assert abs(fingerprints.containment(b, a) - 1) < 0.01
    assert abs(fingerprints.containment(a, b) - 1500 / 20000) < 0.03
    assert fingerprints.likeness(fingerprints.merged(a, b), a) == 1
    back = fingerprints.from_string(fingerprints.to_string(a))
    assert back.limit == a.limit and (back.hashes == a.hashes).all()
    nothing, same = fingerprints.sketches(["", " \n"])
    assert fingerprints.likeness(nothing, same) == 1 and fingerprints.likeness(nothing, a) == 0
    assert fingerprints.containment(nothing, a) == 1


def test_merged_sketch_is_that_of_both_texts():
    rng = random.Random(2)
    texts = ["", "one two", *(data.prose(rng, n) for n in (3, 20, 35, 36, 50, 70, 300, 5000))] + data.nasty_texts()[:20]
    found = words.find_words(pa.array([t or "" for t in texts]))
    values, first = words.shingles(found, fingerprints.WORDS)
    sets = [values[a:b] >> np.uint64(16) for a, b in zip(first, first[1:])]
    for share, least in ((1 / 2, 32), (1 / 8, 0), (1 / 8, 1), (1 / 100, 128)):
        marks = [fingerprints.sketch(h, share, least) for h in sets]
        for x, a in zip(sets, marks):
            assert set(a.hashes.tolist()) >= {h for h in x.tolist() if h < a.limit}
            assert set(a.hashes.tolist()) >= {h for h in x.tolist() if h < a.reach}
            for y, b in zip(sets, marks):
                both, union = fingerprints.merged(a, b), fingerprints.sketch(np.concatenate([x, y]), share, least)
                assert both.limit == union.limit and both.hashes.tolist() == union.hashes.tolist()
                assert both.reach == union.reach


def follow(rows):
    out = []
    for i, (d, t) in enumerate(rows):
        following = rows[(i + 1) % len(rows)][1]
        half = len(t) // 2
        changed = t[:len(t) - half] + following[:half]
        own = brute.shingle_set(t)
        out.append((d, len(t), hashlib.sha256(changed.encode()).hexdigest(),
                    brute.jaccard(own, brute.shingle_set(changed)), brute.jaccard(own, brute.shingle_set(following))))
    return out


@pytest.mark.parametrize("ids", ["plain", "repeated"])
def test_next_document_comparison(spark, ids):
    texts = data.nasty_texts()
    numbers = [5 * i for i in range(len(texts))] if ids == "plain" else [i // 3 for i in range(len(texts))]
    if ids == "repeated":
        numbers[0] = None
    docs = clashing(data.documents(spark, texts, numbers).repartition(7))
    found = fingerprints.compare_with_next(docs).collect()
    ordered = sorted(((-1 if n is None else n, t or "") for n, t in zip(numbers, texts)), key=lambda r: (r[0], r[1].encode()))
    expected = sorted(follow(ordered))
    assert len(found) == len(texts)
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_chars, r.edited_sha256, r.near_edited, r.near_next) for r in found)
    for a, b in zip(got, expected):
        assert a[:3] == b[:3]
    assert max(abs(a[3] - b[3]) for a, b in zip(got, expected)) < 0.15
    if ids == "plain":
        prints = {r.doc_id: r.fingerprint for r in found}
        by_text = defaultdict(set)
        for n, t in zip(numbers, texts):
            by_text[t or ""].add(prints[n])
        assert all(len(p) == 1 for p in by_text.values())


def test_fingerprint_query_against_brute_force(spark, table):
    found = {r.doc_id: r for r in entry.queries()["op1_fingerprints"](spark, FOLDER).collect()}
    errors = []
    for d, n, digest, near_edited, near_next in follow(table):
        assert (found[d].n_chars, found[d].edited_sha256) == (n, digest)
        errors += [abs(found[d].near_edited - near_edited), abs(found[d].near_next - near_next)]
    assert max(errors) < 0.15 and sum(errors) / len(errors) < 0.02


# --- 2 ------------------------------------------------------------------------------------------


def spans_of(df):
    return sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in df.collect())


def test_repeats_in_nasty_texts(spark, nasty):
    expected = brute.without_repeats(enumerate(data.nasty_texts()))
    assert spans_of(substrings.remove_repeats(clashing(nasty))) == expected
    assert sum(r[2] for r in expected) > 500


def test_repeats_with_equal_and_null_ids(spark):
    texts = data.nasty_texts(8)
    numbers = [None if i < 3 else i // 4 for i in range(len(texts))]
    found = substrings.remove_repeats(data.documents(spark, texts, numbers)).fillna(-1, ["doc_id"])
    expected = brute.without_repeats([(-1 if n is None else n, t) for n, t in zip(numbers, texts)])
    assert spans_of(found) == expected


def test_repeats_query_against_brute_force(spark, table):
    assert spans_of(entry.queries()["op2_substring_dedup"](spark, FOLDER)) == brute.without_repeats(table)


def test_texts_without_repeats_keep_their_form(spark, nasty):
    out = {r.doc_id: r for r in substrings.without_repeats(nasty).collect()}
    removed = {d: n for d, _, n, _ in brute.without_repeats(enumerate(data.nasty_texts()))}
    for d, t in enumerate(data.nasty_texts()):
        if not removed[d]:
            assert out[d].text == t
        else:
            assert out[d].n_chars == len(out[d].text) and len(out[d].text) < len(t)


# --- 6 ------------------------------------------------------------------------------------------


def test_prefixes_are_shortened_until_the_recall():
    assert forest.prefix_length(0.8, 32, 8, 0.9999) == 6
    assert forest.prefix_length(0.8, 32, 8, 0.99) == 8
    assert forest.prefix_length(0.5, 4, 8, 0.9999999) == 1


def test_links_of_nasty_texts(spark, nasty):
    found = forest.link_documents(clashing(nasty))
    expected = [(d, c, n) for d, c, n in brute.links(list(enumerate(data.nasty_texts())))]
    assert sorted(map(tuple, found.collect())) == expected
    assert sum(n for *_, n in expected) > 100


def test_links_query_against_brute_force(spark, table):
    found = entry.queries()["op6_ngram_jaccard_join"](spark, FOLDER)
    assert sorted(map(tuple, found.select("doc_id", "class_id", "n_links").collect())) == brute.links(table)


def test_blocks_of_a_large_cluster_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(forest, "BLOCK", 4)
    rng = random.Random(2)
    base = data.prose(rng, 150).split()
    texts = []
    for _ in range(40):
        copy = base.copy()
        for _ in range(rng.randint(0, 4)):
            copy[rng.randrange(150)] = data.prose(rng, 1)
        texts.append(" ".join(copy))
    found = sorted(map(tuple, forest.link_documents(data.documents(spark, texts)).collect()))
    assert found == brute.links(list(enumerate(texts)))


@pytest.mark.parametrize("rows", [60, 240])
def test_texts_of_repeated_ids_are_read_once(spark, monkeypatch, rows):
    """Rows without an id, and repeated rows, reach the comparison once per text."""
    rng = random.Random(4)
    base = data.prose(rng, 60).split()
    different = [" ".join(base[:i % 60] + ["other"] + base[i % 60 + 1:]) + " " * (i // 60) for i in range(rows)]
    texts = different + [different[0]] * rows
    compared = []
    plain = forest._compare
    monkeypatch.setattr(forest, "_compare", lambda tasks, threshold: compared.append(tasks) or plain(tasks, threshold))
    docs = data.documents(spark, texts, [None] * rows + [7] * rows)
    found = forest.link_documents(docs).collect()
    assert sorted(r.n_links for r in found) == sorted(n for *_, n in brute.links(list(enumerate(texts))))
    assert {r.class_id for r in found} == {None}
    assert compared[0].count() == len({t.strip() for t in texts})


def test_one_document_of_each_class_stays(spark, nasty):
    classes = {d: c for d, c, _ in brute.links(list(enumerate(data.nasty_texts())))}
    out = forest.keep_one_of_each(nasty)
    assert out.columns == nasty.columns
    assert sorted(r.doc_id for r in out.collect()) == sorted(set(classes.values()))


def test_one_of_repeated_rows_stays(spark):
    docs = data.documents(spark, ["a b c d e f", "a b c d e f", "g h", "g h", None, ""], [1, 1, 1, 2, 3, 3])
    kept = sorted((r.doc_id, r.text or "") for r in forest.keep_one_of_each(docs).collect())
    assert kept == [(1, "a b c d e f"), (1, "g h"), (3, ""), (3, "")]


# --- 3 ------------------------------------------------------------------------------------------


def test_word_ids_equal_the_tokenizer(table):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(WORD_FILE)
    mine = tokens.WordIds(WORD_FILE)
    odd = ["it's WE'LL x'y", "a b\x85c", "\x1cq\x1d", "İstanbul ΑΣ. ß ﬁ é ①²³ ª", "<|endoftext|>x<|startoftext|>",
           "日本語 テスト", "12345 3.14,5", "🙂🙂a", "l'été", "µm ¼ ½"]
    for text in odd + [t for _, t in table] + [t or "" for t in data.nasty_texts()]:
        assert mine.text_ids(text).tolist() == whole.encode(text, add_special_tokens=False).ids, text[:60]


def check_packing(rows, texts, window=2048):
    mine = tokens.WordIds(WORD_FILE)
    expected = defaultdict(int)
    for d, t in texts:
        ids = np.append(mine.text_ids(t or ""), 1).astype("<u4")
        expected[d, len(ids)] += 1
    covered, sequences = defaultdict(int), defaultdict(list)
    ids_of = {d: np.append(mine.text_ids(t or ""), 1).astype("<u4") for d, t in texts}
    for r in rows:
        covered[r.doc_id] += r.length
        sequences[r.sequence_id].append((r.offset, r.length))
        if len(set(d for d, _ in texts)) == len(texts):
            ids = ids_of[r.doc_id]
            assert r.doc_tokens == len(ids)
            assert zlib.crc32(ids[r.start:r.start + r.length].tobytes()) == r.ids_crc32
    total = defaultdict(int)
    for (d, n), k in expected.items():
        total[d] += n * k
    assert covered == total
    padding = 0
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length > 0
            at += length
        assert at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    assert sorted(sequences) == list(range(len(sequences)))
    return padding


def test_packing_of_nasty_texts(spark, nasty):
    texts = list(enumerate(data.nasty_texts()))
    rows = packing.pack(clashing(nasty.repartition(5)), WORD_FILE).collect()
    assert check_packing(rows, texts) < 2 * 2048
    starts = sorted((r.doc_id, r.start, r.length) for r in rows)
    for (d, s, n), (e, t, _) in zip(starts, starts[1:]):
        assert (t == s + n) if d == e else t == 0


def test_packing_repeated_and_null_ids(spark):
    texts = data.nasty_texts(4)
    numbers = [None if i < 2 else i // 2 for i in range(len(texts))]
    rows = packing.pack(data.documents(spark, texts, numbers), WORD_FILE).collect()
    check_packing(rows, list(zip(numbers, texts)))


def test_packing_query_has_little_padding(spark, table):
    rows = entry.queries()["op3_packing"](spark, FOLDER).collect()
    assert check_packing(rows, table) <= 2048


@pytest.mark.parametrize("lengths", ["mixed", "short", "equal", "few"])
def test_plan_places_every_piece_once(lengths):
    rng = np.random.default_rng(7)
    n = {"mixed": rng.lognormal(6.3, 1, 3000).astype(int) + 1, "short": rng.integers(1, 90, 4000),
         "equal": np.full(700, 1607), "few": np.array([5])}[lengths]
    rest = n % 2048
    mains, tails = np.bincount(rest // 16, minlength=129), np.bincount(rest % 16, minlength=16)
    plan = packing.Plan(int((n // 2048).sum()), mains, tails)
    filled = defaultdict(list)

    def put(kind, value, ranks, length):
        for s, o in zip(*plan.place(kind, np.full(len(ranks), value), ranks)):
            filled[int(s)].append((int(o), length))

    put(packing.FULL, 0, np.arange((n // 2048).sum()), 2048)
    for q in range(1, 129):
        put(packing.MAIN, q, np.arange(plan.planned[q]), 16 * q)
        for b in range(7):
            if q >> b & 1:
                put(packing.BIT, b, plan.bit_rank[b][q] + np.arange(mains[q] - plan.planned[q]), 16 << b)
    for t in range(1, 16):
        put(packing.TAIL, t, np.arange(tails[t]), t)
    assert sum(length for s in filled.values() for _, length in s) == n.sum()
    for pieces in filled.values():
        at = 0
        for o, length in sorted(pieces):
            assert o == at
            at += length
        assert at <= 2048
    assert len(filled) == plan.sequences <= n.sum() // 2048 + 4


def test_least_squares_are_optimal():
    rng = np.random.default_rng(3)
    a, b = rng.random((12, 30)), rng.random(12) * 9
    x = packing.nonnegative_least_squares(a, b)
    slope = a.T @ (b - a @ x)
    assert (x >= 0).all() and slope.max() < 1e-3 and abs(slope[x > 0]).max() < 1e-3


# --- empty tables and the pipeline -------------------------------------------------------------


def test_empty_tables(spark):
    none = data.empty(spark)
    assert fingerprints.compare_with_next(none).count() == 0
    assert fingerprints.fingerprint(none).count() == 0
    assert substrings.remove_repeats(none).count() == 0
    assert substrings.without_repeats(none).columns == none.columns
    assert forest.link_documents(none).count() == 0
    assert forest.keep_one_of_each(none).count() == 0
    assert packing.pack(none, WORD_FILE).count() == 0


def test_pipeline_stages_against_brute_force(spark, table):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    from starloom.llm.common import stored

    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = sorted((r.doc_id, r.text) for r in kept.collect())
        kept = stored(stage(spark, kept, FOLDER))
        after = sorted((r.doc_id, r.text) for r in kept.collect())
        assert kept.columns == docs.columns
        if name == "quality_classifier":
            assert set(after) <= set(before) and len(after) > 0.7 * len(before)
        if name == "ngram_jaccard_join":
            assert [d for d, _ in after] == sorted({c for _, c, _ in brute.links(before)})
        if name == "substring_dedup":
            expected = brute.without_repeats(before)
            digests = sorted((d, hashlib.sha256(" ".join(brute.WORD.findall(t)).encode()).hexdigest()) for d, t in after)
            assert digests == [(d, h) for d, _, _, h in expected]
    rows = corpus_pipeline.STAGES[-1][1](spark, kept, FOLDER).collect()
    check_packing(rows, after)
    whole = corpus_pipeline.run(spark, FOLDER)
    assert sorted(whole.select("doc_id", "start", "ids_crc32").collect()) == sorted(
        (r.doc_id, r.start, r.ids_crc32) for r in rows)
