"""Token counts, fill-in-the-middle and tokenizer alignment against plain Python."""

import hashlib
import os
import random
import sys
from collections import Counter

import data
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools")]

import __spark_entry__ as entry  # noqa: E402

from starloom.llm import alignment, counts, fill_middle  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
WORDS = public_tokenizers.path("word_bpe_49k.json")
A = public_tokenizers.path("byte_bpe_50k.json")
B = public_tokenizers.path("piece_bpe_32k.model")

ALPHABET = [
    " ", "  ", "\n", "\t", "\r\n", "\r", "\x0b", "\x1c", "\x85", "\xa0", " ", "　", "​", "▁", "<0x0A>",
    "<s>", "<unk>", "<|endoftext|>", "<|startoftext|>", "'s", "'LL", "1", "23", "½", "é", "é", "É", "İ", "ß", "Σ",
    "ς", "ﬁ", "ǅ", "日本", "한국", "😀", "\x00", "J̌", "a", "bc", "Word", ".", ",", "...", "!?", "_", "#", "①", "ª",
    "<P>", "<S>", "<M>"]


def odd_texts(n=400, seed=5):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(1, 30))) for _ in range(n)]


def all_texts():
    return data.nasty_texts() + odd_texts() + ["word " * 30000, "x" * 5000, " ", "\n", "a\n\nb", " a  b "]


def clashing(spark, rows):
    """(row, body) documents with columns called like those the operators make."""
    names = "text block kind entry n form output key place pieces h1 n_bytes restored"
    return spark.createDataFrame([(i, t, *[7] * len(names.split())) for i, t in rows],
                                 "`row.id` long, `the body` string, " + ", ".join(f"{c} int" for c in names.split()))


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- token counts ---------------------------------------------------------------------


def library_counts(texts):
    from tokenizers import Tokenizer

    return [len(e.ids) for e in Tokenizer.from_file(WORDS).encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_counts_equal_the_library(spark):
    texts = all_texts()
    got = sorted(map(tuple, counts.count_tokens(data.documents(spark, texts).repartition(7), WORDS).collect()))
    want = [(i, len((t or "").encode()), n, n > 2048) for i, (t, n) in enumerate(zip(texts, library_counts(texts)))]
    assert got == want


def test_counts_of_repeated_and_null_ids_clashing_names_and_empty_tables(spark):
    texts = ["one two", "one two", None, "", "three <|endoftext|>!"]
    rows = list(zip([3, 3, None, None, -5], texts))
    got = counts.count_tokens(clashing(spark, rows), WORDS, "row.id", "the body", limit=1)
    want = [(i, len((t or "").encode()), n, n > 1) for (i, t), n in zip(rows, library_counts(texts))]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    nothing = counts.count_tokens(data.empty(spark), WORDS)
    assert nothing.collect() == [] and nothing.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]


def test_each_distinct_pre_token_is_counted_once(spark):
    rows = spark.createDataFrame([(i, "same words, Same WORDS!") for i in range(50)], "key long, text string")
    blocks = counts.frequencies(rows, WORDS)
    found = counts.blocks.entries(blocks)
    assert sorted(r.entry for r in counts.piece_counts(found, WORDS).collect()) == ["!", ",", "same", "words"]


def test_counts_of_the_registered_query(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r.n_tokens for r in entry.queries()["op11_token_counts"](spark, FOLDER).collect()}
    assert got == dict(zip([r.doc_id for r in docs], library_counts([r.text for r in docs])))


# --- fill in the middle ---------------------------------------------------------------


def middle(doc_id, text):
    text = text or ""
    name = digest(f"1:{doc_id}")
    h = [int(name[8 * i:8 * i + 8], 16) for i in range(4)]
    n = len(text)
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, mid, suffix = text[:low], text[low:high], text[high:]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    if h[3] % 100 < 20:
        return n, "spm", low, high - low, f"<S>{suffix}<P>{prefix}<M>{mid}"
    return n, "psm", low, high - low, f"<P>{prefix}<S>{suffix}<M>{mid}"


def test_cut_arranged_and_restored(spark):
    texts = all_texts()
    made = fill_middle.restore(fill_middle.transform(data.documents(spark, texts)))
    got = {r.doc_id: r for r in made.collect()}
    assert len(got) == len(texts)
    forms = Counter()
    for i, text in enumerate(texts):
        n, form, prefix, inner, output = middle(i, text)
        r = got[i]
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == (n, form, prefix, inner, output)
        assert (r.output_sha256, r.restored, r.restored_sha256) == (digest(output), text or "", digest(text or ""))
        buffers = ((text or "").encode(), fill_middle.SENTINELS)
        assert b"".join(buffers[p.buffer][p.start:p.start + p.length] for p in r.pieces).decode() == output
        forms[form] += 1
    assert min(forms[f] for f in ("plain", "psm", "spm")) > 10


def test_middle_of_repeated_and_null_ids_clashing_names_and_empty_tables(spark):
    rows = [(4, "some text"), (4, "some text"), (4, "another"), (None, "ab"), (None, None)]
    made = fill_middle.transform(clashing(spark, rows), "row.id", "the body")
    got = sorted((str(r.doc_id), r.output) for r in made.collect())
    assert got == sorted((str(i), middle("" if i is None else i, t)[4]) for i, t in rows)
    kept = fill_middle.restore(made.select("output", "form", F.lit(1).alias("restored"), F.lit(2).alias("key")))
    assert sorted(r.restored for r in kept.collect()) == sorted(t or "" for _, t in rows)
    assert fill_middle.restore(fill_middle.transform(data.empty(spark))).collect() == []
    lost = spark.createDataFrame([(None, "psm"), ("x", None)], "output string, form string")
    assert [(r.restored, r.restored_sha256) for r in fill_middle.restore(lost).collect()] == [(None, None)] * 2


def test_an_output_without_its_sentinels_fails(spark):
    broken = spark.createDataFrame([("<P>text without the others", "psm")], "output string, form string")
    with pytest.raises(Exception, match="not found"):
        fill_middle.restore(broken).collect()


# --- alignment ------------------------------------------------------------------------


def brute_alignment(texts):
    """Figures of every text by nested loops over the libraries' own encodings."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    letters = {c: v for v, c in alignment.byte_letters().items()}

    def spans(ids, spelled):
        at, out = 0, []
        for i in ids:
            size = len(spelled(i))
            out.append((at, at + size, i))
            at += size
        return out

    def a_bytes(i):
        return bytes(letters[c] for c in a.id_to_token(i))

    def b_bytes(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[1:-1], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()

    total, documents = Counter(), []
    for text in texts:
        whole = " " + (text or "")
        ids_a = a.encode(whole, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        if not text or any(b"".join(map(f, ids)) != whole.encode() for f, ids in ((a_bytes, ids_a), (b_bytes, ids_b))):
            documents.append(([], [], [], ""))
            continue
        sa, sb = spans(ids_a, a_bytes), spans(ids_b, b_bytes)
        links, first = [], 0
        for lo, hi, i in sa:
            while sb[first][1] <= lo:
                first += 1
            k = first
            while k < len(sb) and sb[k][0] < hi:
                links.append((i, sb[k][2]))
                k += 1
        total.update(links)
        common = sorted({x[1] for x in sa} & {x[1] for x in sb})
        groups, x, y = [], 0, 0
        for end in common:
            ga, gb = [], []
            while x < len(sa) and sa[x][1] <= end:
                ga.append(str(sa[x][2]))
                x += 1
            while y < len(sb) and sb[y][1] <= end:
                gb.append(str(sb[y][2]))
                y += 1
            groups.append(",".join(ga) + "|" + ",".join(gb))
        documents.append((ids_a, ids_b, links, ";".join(groups)))
    most = Counter()
    for (_, j), n in total.items():
        most[j] = max(most[j], n)
    return [(len(x), len(y), g.count(";") + 1 if g else 0, len(links), sum(total[p] == most[p[1]] for p in links),
             sum(total[p] for p in links), digest(g) if g else "") for x, y, links, g in documents]


FIGURES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.mark.parametrize("work", [2, 7, 4096])
def test_merge_paths_find_every_overlap(work):
    rng = np.random.default_rng(work)
    for _ in range(60):
        size = int(rng.integers(1, 200))
        a, b = (np.unique(np.append(rng.integers(1, size + 1, rng.integers(0, size + 1)), size)) for _ in range(2))
        i, j = alignment.merge_paths(a, b, work)
        assert (i + j == np.append(np.arange(0, len(a) + len(b), work), len(a) + len(b))).all()
        x, y, closes = alignment.overlaps(a, b, work)
        begin = [np.append(0, ends[:-1]) for ends in (a, b)]
        want = [(p, q) for p in range(len(a)) for q in range(len(b))
                if begin[0][p] < b[q] and begin[1][q] < a[p]]
        assert list(zip(x.tolist(), y.tolist())) == want
        assert np.minimum(a[x], b[y])[closes].tolist() == sorted(set(a.tolist()) & set(b.tolist()))


def test_alignment_equals_nested_loops(spark):
    texts = [t for t in all_texts() if not t or len(t) < 60000]
    got = alignment.align(data.documents(spark, texts).repartition(5), A, B).orderBy("doc_id").select(*FIGURES).collect()
    assert list(map(tuple, got)) == brute_alignment(texts)


def test_alignment_of_repeated_and_null_ids_clashing_names_and_empty_tables(spark):
    texts = ["one two three", "one two three", None, "", "a ▁ mark", "Überall, wo"]
    rows = list(zip([3, 3, None, None, 8, None], texts))
    got = alignment.align(clashing(spark, rows), A, B, "row.id", "the body").select("doc_id", *FIGURES).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(str((i, *f)) for (i, _), f in zip(rows, brute_alignment(texts)))
    nothing = alignment.align(data.empty(spark), A, B)
    assert nothing.collect() == [] and set(nothing.columns) == {"doc_id", *FIGURES}


def test_alignment_of_the_registered_query(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    got = entry.queries()["op13_tokenizer_alignment"](spark, FOLDER).orderBy("doc_id").select(*FIGURES).collect()
    assert list(map(tuple, got)) == brute_alignment([r.text for r in docs])
