"""Near-duplicate vectors: an exact metric range join over pivot cells.

Vectors of one label and length are scaled to length one, where cosine c is the distance
sqrt(2 - 2c). Each goes to the cell of its nearest pivot. If x in cell i and y in cell j are
within eps, the triangle inequality gives d(x, j) <= d(x, i) + 2 eps; in the plane between the
pivots the sharper (d(x, j)^2 - d(x, i)^2) / (2 d(i, j)) <= eps also holds. So x is copied to
every lower cell j for which both hold, and each pair meets exactly once, in the lower of the
two cells. Cells are joined on their own, block against block in tasks of bounded size.

Equal vectors are one class before the join, so copies cost nothing. Tasks return a count of
links and a root per class, not pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import groups, in_tasks, stored
from starloom.llm.components import components

COSINE = 0.93
PIVOTS = 8
BLOCK = 1024


def _usable(vector):
    whole = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    return vector.isNotNull() & whole & F.exists(vector, lambda v: v != 0)


def _units(lists: pa.Array) -> np.ndarray:
    """Vectors of one length as rows of length one, in double precision."""
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(lists), -1)
    flat = flat / np.abs(flat).max(axis=1, keepdims=True)
    return flat / np.sqrt((flat * flat).sum(axis=1, keepdims=True))


def cells_of(units: np.ndarray, pivots: np.ndarray, eps: float) -> tuple[np.ndarray, np.ndarray]:
    """(home cell, mask of the lower cells to visit) of each vector."""
    square = np.maximum(0, ((units * units).sum(1)[:, None] + (pivots * pivots).sum(1)[None, :]
                            - 2 * units @ pivots.T))
    home = square.argmin(1)
    nearest = square[np.arange(len(units)), home]
    between = np.sqrt(((pivots[:, None, :] - pivots[None, :, :]) ** 2).sum(2))[home]
    slack = 1e-9
    near = np.sqrt(square) <= np.sqrt(nearest)[:, None] + 2 * eps + slack
    near &= square - nearest[:, None] <= 2 * (eps + slack) * between + slack
    return home, near & (np.arange(len(pivots))[None, :] < home[:, None])


def _deal(classes: DataFrame, eps: float) -> DataFrame:
    """(label, dims, cell, name, home, copies, vector): each class in its cell and those it visits."""
    def work(batches):
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            pivot_lists = rows.column("pivots").combine_chunks()
            label, dims = rows.column("label").to_pylist(), rows.column("dims").to_pylist()
            by_group: dict[tuple, list[int]] = {}
            for i, group in enumerate(zip(label, dims)):
                by_group.setdefault(group, []).append(i)
            for at in by_group.values():
                part = rows.take(pa.array(at))
                units = _units(part.column("vector").combine_chunks())
                pivots = _units(pivot_lists[at[0]].values)
                home, visits = cells_of(units, pivots, eps)
                who, cell = np.nonzero(visits)
                take = np.concatenate([np.arange(len(at)), who])
                part = part.take(pa.array(take))
                yield from pa.table({
                    "label": part.column("label"), "dims": part.column("dims"),
                    "cell": pa.array(np.concatenate([home, cell]).astype(np.int32)),
                    "name": part.column("name"),
                    "home": pa.array(np.concatenate([np.ones(len(at), bool), np.zeros(len(who), bool)])),
                    "copies": part.column("copies"), "vector": part.column("vector")}).combine_chunks().to_batches()

    kinds = dict(classes.dtypes)
    return in_tasks(classes, work, f"label {kinds['label']}, dims int, cell int, name string, home boolean, "
                                   f"copies long, vector {kinds['vector']}")


def linked(left: np.ndarray, right: np.ndarray, cosine: float) -> np.ndarray:
    return left @ right.T >= cosine


def _compare(tasks: DataFrame, cosine: float) -> DataFrame:
    """(name, root, links) per class and task."""
    def work(batches):
        for table in groups(batches, ["label", "dims", "cell", "i", "j"]):
            table = table.combine_chunks()
            i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
            block = table.column("block").to_numpy()
            units = _units(table.column("vector").combine_chunks())
            copies = table.column("copies").to_numpy()
            name = table.column("name")
            a, b = np.flatnonzero(block == i), np.flatnonzero(block == j)
            hit = linked(units[a], units[b], cosine)
            if i == j:
                np.fill_diagonal(hit, False)
            x, y = np.nonzero(hit)
            x, y = a[x], b[y]
            links = np.bincount(x, copies[y], len(units))
            if i != j:
                links = links + np.bincount(y, copies[x], len(units))
            root = np.arange(len(units))
            while len(x):
                least = root.copy()
                np.minimum.at(least, x, root[y])
                np.minimum.at(least, y, root[x])
                least = least[least]
                if (least == root).all():
                    break
                root = least
            keep = np.flatnonzero(links > 0)
            yield pa.RecordBatch.from_arrays(
                [name.take(pa.array(keep)).combine_chunks(), name.take(pa.array(root[keep])).combine_chunks(),
                 pa.array(links[keep].astype(np.int64))], ["name", "root", "links"])

    return in_tasks(tasks, work, "name string, root string, links long")


def link_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                 label_col: str = "label", cosine: float = COSINE) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Rows link if their labels are equal and not null, their vectors have the same number of
    components and their cosine is at least ``cosine`` in double precision. A vector that is
    null, empty or zero or has null or non-finite components, or a null label, links with
    nothing. ``n_links`` counts other rows, equal vectors included; ``component_id`` is the
    least id reachable (null ids are passed over); ``kept`` says that it is the row's own.
    Rows that repeat an id are vectors of their own; no rows give none.
    """
    name = lambda c: F.col(f"`{c}`")
    rows = vectors.select(name(id_col).alias("vec_id"), name(vector_col).alias("vector"), name(label_col).alias("label"))
    usable = _usable(F.col("vector")) & F.col("label").isNotNull()
    hashed = F.concat(*(F.lpad(F.hex(F.xxhash64(F.lit(i), "label", "vector")), 16, "0") for i in (1, 2)))
    rows = rows.withColumn("name", F.when(usable, hashed))
    classes = stored(rows.where("name IS NOT NULL").groupBy("name").agg(
        F.min("vec_id").alias("least"), F.count("*").alias("copies"),
        F.first("label").alias("label"), F.first("vector").alias("vector")).withColumn("dims", F.size("vector")))
    pivots = classes.groupBy("label", "dims").agg(*(
        F.min(F.struct(F.xxhash64(F.lit(k), "name").alias("h"), "vector"))["vector"].alias(f"p{k}") for k in range(PIVOTS)))
    pivots = pivots.select("label", "dims", F.array(*(f"p{k}" for k in range(PIVOTS))).alias("pivots"))
    eps = float(np.sqrt(2 - 2 * cosine))
    dealt = stored(_deal(classes.join(pivots, ["label", "dims"]).select(
        "label", "dims", "name", "copies", "vector", "pivots"), eps))
    cell = ["label", "dims", "cell"]
    sizes = dealt.groupBy(*cell).agg(F.count_if("home").alias("own"), F.count_if(~F.col("home")).alias("visiting")) \
        .select(*cell, F.ceil(F.col("own") / BLOCK).cast("int").alias("homes"),
                F.ceil(F.col("visiting") / BLOCK).cast("int").alias("visits")).where("homes > 0")
    blocked = dealt.join(sizes, cell)
    number = F.xxhash64("name")
    blocked = blocked.withColumn("block", F.when(F.col("home"), F.pmod(number, F.col("homes"))).otherwise(
        F.col("homes") + F.pmod(number, F.greatest("visits", F.lit(1)))).cast("int"))
    others = F.when(F.col("home"), F.sequence(F.lit(0), F.col("homes") + F.col("visits") - 1)).otherwise(
        F.sequence(F.lit(0), F.col("homes") - 1))
    tasks = blocked.withColumn("x", F.explode(others)).select(
        *cell, F.least("block", "x").alias("i"), F.greatest("block", "x").alias("j"), "name", "block", "copies", "vector")
    tasks = tasks.repartition(*cell, "i", "j").sortWithinPartitions(*cell, "i", "j")
    links = stored(_compare(tasks, cosine))
    joined = components(links, "name", "root").withColumnRenamed("node", "name")
    members = classes.select("name", "least", "copies").join(joined, "name", "left") \
        .withColumn("component", F.coalesce("component", "name"))
    lowest = members.groupBy("component").agg(F.min("least").alias("component_id"))
    counts = links.groupBy("name").agg(F.sum("links").alias("links"))
    result = stored(members.join(lowest, "component").join(counts, "name", "left").select(
        "name", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    found = rows.select("vec_id", "name").join(result, "name", "left")
    component = F.coalesce("component_id", "vec_id")
    return found.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                        component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
