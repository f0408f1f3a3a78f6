"""Near-duplicate documents: MinHash bands, then exact Jaccard of five-word shingles.

1. Equal word sequences are one class. Each class has a MinHash signature cut into trees of
   ``DEEPEST`` minima; a tree's label is its first ``prefix_length`` minima, the same number in
   all: the most at which a pair at the threshold meets in some tree with the target
   probability. This is fixed banding, not a forest that shortens labels as it searches.
2. In each bucket of equal labels all sketches (one bit of each minimum) are compared in numpy,
   block against block where a bucket is large. A task returns one root per class that has a
   likely partner, not pairs; components over all trees are the candidate clusters.
3. The clusters that result are only candidates. Every pair of texts in a cluster is compared
   exactly, block against block, in tasks of bounded size that return a count of links and one
   root per text instead of pairs. Components of those roots are the classes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import LEAST, groups, id_of, in_tasks, pieces_of, stored, text_rows
from starloom.llm.components import components
from starloom.llm.words import find_words, mixed, shingles

WORDS = 5
THRESHOLD = 0.8
TREES = 32
DEEPEST = 8
RECALL = 0.9999
# Sketches that agree less cannot belong to a pair at the threshold: its estimate has a
# standard deviation below 0.04, so this is five of them away.
LIKELY = 0.6
BUCKET_BLOCK = 4096
BLOCK = 256


def prefix_length(threshold: float = THRESHOLD, trees: int = TREES, deepest: int = DEEPEST,
                  recall: float = RECALL) -> int:
    """The longest label at which a pair at the threshold shares one with the target probability."""
    for length in range(deepest, 1, -1):
        if 1 - (1 - threshold ** length) ** trees >= recall:
            return length
    return 1


def _names(values: np.ndarray, first: np.ndarray) -> list[str]:
    """128 bits of each text's shingle sequence, as hex."""
    at = np.arange(len(values)) - np.repeat(first[:-1], np.diff(first))
    order = at.astype(np.uint64)
    out = []
    sums = [np.concatenate([[np.uint64(0)], np.cumsum(mixed(values * np.uint64(k) + order * np.uint64(j)))])
            for k, j in ((0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F), (0xFF51AFD7ED558CCD, 0x165667B19E3779F9))]
    one, two = (s[first[1:]] - s[first[:-1]] for s in sums)
    for a, b in zip(mixed(one).tolist(), mixed(two).tolist()):
        out.append(f"{a:016x}{b:016x}")
    return out


def _signatures(rows: DataFrame, threshold: float) -> DataFrame:
    """(key, mark, name, labels, sketch) of every (key, text, mark); name, labels and sketch are
    null for a text without words."""
    length = prefix_length(threshold)
    generator = np.random.default_rng(20)
    # Multiplying by an odd number orders the hashes anew; its minimum is one minimum of a tree.
    factors = generator.integers(1, 1 << 63, TREES * DEEPEST, np.uint64) * np.uint64(2) + np.uint64(1)

    def work(batches):
        for batch in batches:
            for part in pieces_of(batch, "text", 1 << 20):
                values, first = shingles(find_words(part.column(1)), WORDS)
                full = np.flatnonzero(np.diff(first))
                minima = np.empty((TREES, DEEPEST, len(full)), np.uint64)
                if len(full):
                    for i, f in enumerate(factors):
                        np.minimum.reduceat(values * f, first[:-1][full], out=minima[i // DEEPEST, i % DEEPEST])
                bits = (mixed(minima.reshape(TREES * DEEPEST, -1)) >> np.uint64(40)).astype(np.uint8) & np.uint8(1)
                sketch = np.packbits(bits, axis=0).T.copy().view(np.int64)
                labels = np.empty((len(full), TREES), np.uint64)
                for t in range(TREES):
                    label = np.full(len(full), t + 1, np.uint64)
                    for row in minima[t, :length]:
                        label = mixed((label ^ row) * np.uint64(0xD6E8FEB86659FD93))
                    labels[:, t] = label
                names = _names(values, first)
                place = np.full(part.num_rows, -1)
                place[full] = np.arange(len(full))
                take = pa.array(place, mask=place < 0)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array([names[i] for i in full.tolist()], pa.string()).take(take),
                     _lists(labels.view(np.int64)).take(take), _lists(sketch).take(take)],
                    ["key", "mark", "name", "labels", "sketch"])

    return in_tasks(rows, work, "key long, mark long, name string, labels array<long>, sketch array<long>")


def _lists(matrix: np.ndarray) -> pa.Array:
    n, width = matrix.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(0, (n + 1) * width, width, dtype=np.int32)),
                                    pa.array(matrix.reshape(-1)))


def _roots(left: np.ndarray, right: np.ndarray, n: int) -> np.ndarray:
    """The least position that each of n positions is connected to by the links given."""
    root = np.arange(n)
    while len(left):
        least = root.copy()
        np.minimum.at(least, left, root[right])
        np.minimum.at(least, right, root[left])
        least = least[least]
        if (least == root).all():
            break
        root = least
    return root


def likely_roots(sketches: np.ndarray, in_left: np.ndarray, in_right: np.ndarray, threshold: float) -> np.ndarray:
    """Root of each sketch over the pairs of the two blocks that agree enough."""
    most_apart = int((1 - threshold) / 2 * 64 * sketches.shape[1])
    a, b = np.flatnonzero(in_left), np.flatnonzero(in_right)
    left, right = [], []
    for start in range(0, len(a), 64):
        rows = a[start:start + 64]
        apart = np.bitwise_count(sketches[rows, None, :] ^ sketches[None, b, :]).sum(2, dtype=np.int32)
        x, y = np.nonzero((apart <= most_apart) & (rows[:, None] != b[None, :]))
        left.append(rows[x])
        right.append(b[y])
        if sum(map(len, left)) > 1 << 20:
            root = _roots(np.concatenate(left), np.concatenate(right), len(sketches))
            left, right = [np.arange(len(sketches))], [root]
    return _roots(np.concatenate(left), np.concatenate(right), len(sketches)) if left else np.arange(len(sketches))


def _candidate_links(classes: DataFrame) -> DataFrame:
    """(name, root) links between classes whose sketches agree in a common bucket."""
    members = classes.select("name", F.explode("labels").alias("label"))
    shared = stored(members.groupBy("label").agg(F.count("*").alias("n")).where(F.col("n") > 1).select(
        "label", F.ceil(F.col("n") / BUCKET_BLOCK).cast("int").alias("blocks")))
    found = members.join(shared, "label").join(classes.select("name", "sketch"), "name")
    found = found.withColumn("block", F.pmod(F.xxhash64("name"), F.col("blocks")).cast("int")).withColumn(
        "x", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tasks = found.select("label", F.least("block", "x").alias("i"), F.greatest("block", "x").alias("j"),
                         "name", "block", "sketch")
    tasks = tasks.repartition("label", "i", "j").sortWithinPartitions("label", "i", "j")

    def work(batches):
        for table in groups(batches, ["label", "i", "j"]):
            block = table.column("block").to_numpy()
            sketches = table.column("sketch").combine_chunks().flatten().to_numpy().reshape(len(block), -1).view(np.uint64)
            i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
            root = likely_roots(sketches, block == i, block == j, LIKELY)
            at = np.flatnonzero(root != np.arange(len(root)))
            if len(at):
                name = table.column("name").combine_chunks()
                yield pa.RecordBatch.from_arrays([name.take(pa.array(at)), name.take(pa.array(root[at]))], ["name", "root"])

    return in_tasks(tasks, work, "name string, root string")


def exact_links(sets: list[np.ndarray], copies: np.ndarray, left: np.ndarray, right: np.ndarray,
                threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Links among sets: per set the copies it links to and the least set it is connected to.

    Pairs of ``left`` x ``right`` positions count; a pair within both counts once.
    """
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(n), sizes)
    values = np.concatenate(sets)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    column = np.cumsum(new) - 1
    frequent = np.bincount(column)[column] > 1
    column, owner = column[frequent], owner[frequent]
    common = np.zeros((n, n), np.float32)
    if len(column):
        column = np.cumsum(np.concatenate([[0], column[1:] != column[:-1]]))
        width = 4096
        cuts = np.searchsorted(column, np.arange(0, column[-1] + 1 + width, width))
        for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
            if b > a:
                part = np.zeros((n, width), np.float32)
                part[owner[a:b], column[a:b] - i * width] = 1
                common += part @ part.T
    joint = common.astype(np.float64)
    total = sizes[:, None] + sizes[None, :] - joint
    linked = joint >= threshold * total - 1e-9
    allowed = np.zeros((n, n), bool)
    allowed[np.ix_(left, right)] = True
    linked &= allowed | allowed.T
    np.fill_diagonal(linked, False)
    root = _roots(*np.nonzero(linked), n)
    return linked @ copies, root


def _compare(tasks: DataFrame, threshold: float) -> DataFrame:
    """(name, root, links) per text and task, from texts sorted by task."""
    def work(batches):
        for table in groups(batches, ["cluster", "i", "j"]):
            seen: dict[str, tuple] = {}
            for name, block, copies, text in zip(*(table.column(c).to_pylist() for c in ("name", "block", "copies", "text"))):
                seen.setdefault(name, (block, copies, text))
            names = list(seen)
            i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
            blocks = np.array([seen[n][0] for n in names])
            values, first = shingles(find_words(pa.array([seen[n][2] for n in names], pa.large_string())), WORDS)
            sets = [np.unique(values[a:b]) for a, b in zip(first, first[1:])]
            links, root = exact_links(sets, np.array([seen[n][1] for n in names], np.int64),
                                      np.flatnonzero(blocks == i), np.flatnonzero(blocks == j), threshold)
            keep = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays(
                [pa.array([names[k] for k in keep], pa.string()), pa.array([names[root[k]] for k in keep], pa.string()),
                 pa.array(links[keep].astype(np.int64))], ["name", "root", "links"])

    return in_tasks(tasks, work, "name string, root string, links long")


def _classes(rows: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(key, name) of every row, and per name: keeper (key, name) of its class, n_links."""
    # Rows of one id (null ids are one id) are told apart by their texts' hashes.
    rows = rows.withColumn("mark", F.xxhash64("text"))
    signed = stored(_signatures(rows, threshold))
    classes = stored(signed.where("name IS NOT NULL").groupBy("name").agg(
        F.min(F.struct("key", "mark")).alias("row"), F.count("*").alias("copies"),
        F.first("labels").alias("labels"), F.first("sketch").alias("sketch")).select(
        "name", F.col("row.key").alias("least"), F.col("row.mark").alias("mark"), "copies", "labels", "sketch"))
    clusters = components(_candidate_links(classes), "name", "root")
    clusters = stored(clusters.withColumnRenamed("node", "name").withColumnRenamed("component", "cluster"))
    sizes = clusters.groupBy("cluster").agg(F.count("*").alias("members")) \
        .select("cluster", F.ceil(F.col("members") / BLOCK).cast("int").alias("blocks"))
    wanted = clusters.join(sizes, "cluster").join(classes.select("name", "least", "mark", "copies"), "name").select(
        "name", "cluster", "blocks", "copies", F.col("least").alias("key"), "mark",
        F.pmod(F.xxhash64("name"), F.col("blocks")).cast("int").alias("block"))
    repeated = stored(signed.where("name IS NOT NULL").groupBy("key", "mark").agg(F.count("*").alias("n"))
                      .where("n > 1").select("key", "mark"))
    if not repeated.isEmpty():
        once = rows.join(repeated, ["key", "mark"], "left_semi").groupBy("key", "mark").agg(F.first("text").alias("text"))
        rows = rows.join(repeated, ["key", "mark"], "left_anti").unionByName(once)
    texts = _with_own_text(wanted.join(rows, ["key", "mark"]).drop("mark"))
    tasks = texts.withColumn("x", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "cluster", F.least("block", "x").alias("i"), F.greatest("block", "x").alias("j"),
        "name", "block", "copies", "text")
    tasks = tasks.repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j")
    links = stored(_compare(tasks, threshold))
    joined = components(links, "name", "root").withColumnRenamed("node", "name")
    members = classes.select("name", "least", "copies").join(joined, "name", "left") \
        .withColumn("component", F.coalesce("component", "name"))
    keepers = members.groupBy("component").agg(F.min(F.struct(F.col("least").alias("key"), "name")).alias("keeper"))
    counts = links.groupBy("name").agg(F.sum("links").alias("links"))
    result = members.join(keepers, "component").join(counts, "name", "left").select(
        "name", "keeper", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    return signed.select("key", "name"), stored(result)


def link_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, class_id, n_links.

    Documents link whose sets of five-word shingles have a Jaccard similarity of the threshold
    or more (a shorter text is one shingle, equal texts always link). ``class_id`` is the least
    id reachable by links, ``n_links`` counts the other rows linked directly, copies included.
    A null or empty text links with nothing; null ids count as smaller than others and stay
    null; rows that repeat an id are documents of their own; no rows give none.
    """
    named, classes = _classes(text_rows(docs, id_col, text_col), threshold)
    return named.join(classes, "name", "left").select(
        id_of(F.col("key")).alias("doc_id"),
        id_of(F.coalesce(F.col("keeper.key"), F.col("key"))).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, less every document but one of each class.

    The one with the least id (then the least name) stays; of rows that repeat id and text
    one stays. Documents without words all stay.
    """
    rows = text_rows(docs, id_col, text_col)
    named, classes = _classes(rows, threshold)
    named = named.join(classes, "name", "left")
    stays = F.col("name").isNull() | (F.struct("key", "name") == F.col("keeper"))
    key = F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LEAST))
    repeated = stored(named.where("name IS NOT NULL").groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"))
    single = stored(named.where(stays).select("key").distinct().join(repeated, "key", "left_anti"))
    kept = docs.join(single, key == single["key"], "left_semi")
    if repeated.isEmpty():
        return kept
    many = docs.join(repeated, key == repeated["key"], "left_semi")
    columns = list(docs.columns)
    marked = many.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)],
                         key.alias("key"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    named_rows = _with_name(marked)
    keepers = named.where(stays).select("key", F.coalesce("name", F.lit("")).alias("name")).distinct()
    chosen = named_rows.join(keepers, ["key", "name"], "left_semi")
    worded = chosen.where("name != ''").dropDuplicates(["key", "name"])
    both = worded.unionByName(chosen.where("name = ''"))
    return kept.unionByName(both.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(columns)]))


def _with_name(rows: DataFrame) -> DataFrame:
    """Add each text's name, empty for a text without words."""
    def work(batches):
        for batch in batches:
            for part in pieces_of(batch, "text"):
                values, first = shingles(find_words(part.column(part.schema.get_field_index("text"))), WORDS)
                names = [n if c else "" for n, c in zip(_names(values, first), np.diff(first).tolist())]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(names, pa.string())], [*part.schema.names, "name"])

    return in_tasks(rows, work, ", ".join(f"{c} {t}" for c, t in rows.dtypes) + ", name string")


def _with_own_text(texts: DataFrame) -> DataFrame:
    """Keep of the texts of a key the one that bears the row's name."""
    def work(batches):
        for batch in batches:
            for part in pieces_of(batch, "text"):
                values, first = shingles(find_words(part.column(part.schema.get_field_index("text"))), WORDS)
                own = part.column(part.schema.get_field_index("name")).to_pylist()
                yield part.filter(pa.array([a == b for a, b in zip(_names(values, first), own)]))

    return in_tasks(texts, work, ", ".join(f"{c} {t}" for c, t in texts.dtypes))
