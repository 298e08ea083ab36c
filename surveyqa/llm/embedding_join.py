"""Near-duplicate vectors by an epsilon grid order join.

Method. Unit vectors within an angle are within a distance epsilon. They are projected onto the leading
principal directions (of the second moments of all vectors), sorted by the grid cells of width epsilon
that they fall into, and cut into intervals of up to ``INTERVAL`` vectors with the bounds of their projections.
Intervals are joined recursively: groups of ``FAN`` consecutive intervals first, then the members of
those pairs of groups that are not provably farther than epsilon apart. A projection never lengthens
a distance, so a skipped pair holds no link. Pairs of intervals that are left are compared by one matrix
product in double precision; each gives, for a vector, a number of links and one spanning link.

Results. One row per input row. Vectors are compared when label and dimension are equal. A vector that is
null, empty or zero, or holds null or non-finite components, and one with a null label, has no links and
is its own component. Rows with equal vectors are one class: they are linked with one another (also
rows with the same id), and counted each. A null id takes part; it is a component's id only where all
are null, and such rows are kept. An empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from surveyqa.llm.components import components
from surveyqa.llm.storage import shared_folder, staged

INTERVAL, FAN, LEADING = 512, 16, 8
#: Rounding allowed for in distances between bounds.
SLACK = 1e-6
BLOCK = "block long, label int, dim int, n long, low array<double>, high array<double>, ids binary, counts binary, vectors binary"


def unit_rows(column: pa.Array, dim: int) -> np.ndarray:
    """Vectors of one dimension as unit rows in double precision."""
    rows = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def by_dimension(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, pa.RecordBatch]]:
    dims = batch["dim"].to_numpy()
    for dim in np.unique(dims):
        where = np.flatnonzero(dims == dim)
        yield int(dim), where, batch.take(pa.array(where))


def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task function: sums of the products of every two components."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for dim, _, part in by_dimension(batch):
            rows = unit_rows(part["embedding"], dim)
            sums[dim] = sums.get(dim, 0) + rows.T @ rows
    for dim, total in sums.items():
        i, j = np.divmod(np.arange(dim * dim), dim)
        columns = [pa.array(np.full(dim * dim, dim, np.int32)), pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total.ravel())]
        yield pa.RecordBatch.from_arrays(columns, names=["dim", "i", "j", "total"])


def directions(classes: DataFrame) -> dict[int, np.ndarray]:
    """Leading principal directions of each dimension: a matrix of dimension x dimension sums."""
    totals = classes.select("dim", "embedding").mapInArrow(moments, "dim int, i int, j int, total double")
    matrices: dict[int, np.ndarray] = {}
    for r in totals.groupBy("dim", "i", "j").agg(F.sum("total").alias("total")).collect():
        matrices.setdefault(r.dim, np.zeros((r.dim, r.dim)))[r.i, r.j] = r.total
    return {dim: np.linalg.eigh(m)[1][:, ::-1][:, :LEADING] for dim, m in matrices.items()}


def intervals_of(bases: dict[int, np.ndarray], epsilon: float):
    """Two task functions: grid cells of each class, and intervals of classes in grid order."""

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.zeros((batch.num_rows, LEADING), np.int32)
            for dim, where, part in by_dimension(batch):
                shadow = unit_rows(part["embedding"], dim) @ bases[dim]
                found[where, : shadow.shape[1]] = np.floor(shadow / epsilon)
            columns = [*batch.columns, pa.array(list(found), pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "cells"])

    def block(number: int, label: int, dim: int, ids: list, counts: list, rows: list) -> list:
        rows = np.stack(rows)
        shadow = np.zeros((len(rows), LEADING))
        shadow[:, : bases[dim].shape[1]] = rows @ bases[dim]
        return [
            number, label, dim, len(ids), shadow.min(axis=0).tolist(), shadow.max(axis=0).tolist(),
            np.array(ids, np.int64).tobytes(), np.array(counts, np.int64).tobytes(), rows.tobytes(),
        ]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, key, ids, counts, rows = TaskContext.get().partitionId() << 32, None, [], [], []
        types = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.float64()), *[pa.binary()] * 3]

        def ended() -> pa.RecordBatch:
            made = block(number, *key, ids, counts, rows)
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(made, types)], names=[c.split()[0] for c in BLOCK.split(", ")])

        for batch in batches:
            units = [None] * batch.num_rows
            for dim, where, part in by_dimension(batch):
                for k, row in zip(where, unit_rows(part["embedding"], dim)):
                    units[k] = row
            for own, label, dim, n, row in zip(*(batch[c].to_pylist() for c in ("class", "label", "dim", "n")), units):
                if ids and (key != (label, dim) or len(ids) == INTERVAL):
                    yield ended()
                    number, ids, counts, rows = number + 1, [], [], []
                key = (label, dim)
                ids.append(own)
                counts.append(n)
                rows.append(row)
        if ids:
            yield ended()

    return cells, cut


def linked_parts(links: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least member (rows first, then columns) of the connected part of each row and column."""
    rows, columns = links.shape
    of_row, of_column, far = np.arange(rows), np.arange(rows, rows + columns), rows + columns
    while True:
        least = np.minimum(of_row, np.where(links, of_column, far).min(axis=1, initial=far))
        across = np.minimum(of_column, np.where(links, least[:, None], far).min(axis=0, initial=far))
        if (least == of_row).all() and (across == of_column).all():
            return of_row, of_column
        of_row, of_column = least, across


def compared(least: float):
    """Task function: links between two intervals, as counts and spanning links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, dim, *parts in zip(*(batch[c].to_pylist() for c in ("a", "b", "dim", "ids_a", "counts_a", "vectors_a", "ids_b", "counts_b", "vectors_b"))):
                ids_a, counts_a, ids_b, counts_b = (np.frombuffer(parts[k], np.int64) for k in (0, 1, 3, 4))
                x, y = (np.frombuffer(parts[k]).reshape(-1, dim) for k in (2, 5))
                links = x @ y.T >= least
                if a == b:
                    np.fill_diagonal(links, False)
                of_row, of_column = linked_parts(links)
                ids, counts = np.concatenate([ids_a, ids_b]), np.concatenate([links @ counts_b, counts_a @ links])
                if a == b:
                    counts[len(ids_a) :] = 0
                root = ids[np.concatenate([of_row, of_column])]
                some = np.concatenate([links.any(axis=1), links.any(axis=0)])
                columns = [pa.array(ids[some]), pa.array(root[some]), pa.array(counts[some])]
                yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "links"])

    return run


def near_pairs(blocks: DataFrame, epsilon: float, folder: str) -> DataFrame:
    """Pairs of blocks (a <= b) that may hold links, by recursion over groups of consecutive blocks."""
    rank = F.row_number().over(Window.partitionBy("label", "dim").orderBy("block")) - 1
    nodes = staged(blocks.select("block", "label", "dim", "low", "high").withColumn("node", rank.cast("long")), folder, "nodes")
    most = (nodes.agg(F.max("node")).first()[0] or 0) + 1
    levels = [nodes.select("label", "dim", "node", "low", "high")]
    while most > FAN:
        outer = lambda c, f: F.array(*[f(F.element_at(c, k + 1)) for k in range(LEADING)]).alias(c)
        levels.append(staged(
            levels[-1].groupBy("label", "dim", F.expr(f"node div {FAN}").alias("node")).agg(outer("low", F.min), outer("high", F.max)),
            folder, f"level-{len(levels)}",
        ))
        most = -(-most // FAN)
    apart = " + ".join(
        f"power(greatest(0D, element_at(a.low, {k}) - element_at(b.high, {k}), element_at(b.low, {k}) - element_at(a.high, {k})), 2)"
        for k in range(1, LEADING + 1)
    )
    pairs, near = None, f"{apart} <= {(epsilon + SLACK) ** 2!r} AND a.node <= b.node"
    for depth, level in enumerate(reversed(levels)):
        own = level.withColumn("up", F.expr(f"node div {FAN}"))
        if pairs is None:
            pairs = own.alias("a").join(own.alias("b"), ["label", "dim"])
        else:
            up = "p.label = {0}.label AND p.dim = {0}.dim AND p.{1} = {0}.up"
            pairs = pairs.join(own.alias("a"), F.expr(up.format("a", "x"))).join(own.alias("b"), F.expr(up.format("b", "y")))
        key = ["p.label", "p.dim"] if depth else ["label", "dim"]
        pairs = staged(
            pairs.filter(near).select(*key, F.col("a.node").alias("x"), F.col("b.node").alias("y")), folder, f"pairs-{depth}"
        ).alias("p")
    first, second = (nodes.select(F.col("label").alias(f"l{s}"), F.col("dim").alias(f"d{s}"), F.col("node").alias(f"n{s}"), F.col("block").alias(s)) for s in ("a", "b"))
    joined = pairs.join(first, F.expr("p.label = la AND p.dim = da AND p.x = na")).join(second, F.expr("p.label = lb AND p.dim = db AND p.y = nb"))
    return joined.select("a", "b")


def near_vectors(
    vectors: DataFrame, least: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label"
) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id``, ``kept`` of every row; see the module."""
    spark = vectors.sparkSession
    folder, epsilon = shared_folder(spark), float(np.sqrt(2 - 2 * least))
    named = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("int").alias("label"),
        F.col(vector_col).cast("array<float>").alias("embedding"),
    ).withColumn("dim", F.size("embedding"))
    usable = F.expr(
        "label IS NOT NULL AND dim > 0 AND exists(embedding, x -> x <> 0)"
        " AND forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < float('infinity'))"
    )
    rows = named.withColumns({
        "usable": F.coalesce(usable, F.lit(False)), "h1": F.xxhash64("embedding"), "h2": F.xxhash64(F.lit(7), "embedding", F.lit(7)),
    })
    key = ["label", "dim", "h1", "h2"]
    classes = rows.filter("usable").groupBy(*key).agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"), F.first("embedding").alias("embedding"))
    classes = staged(classes.withColumn("class", F.monotonically_increasing_id()), folder, "classes")
    cells, cut = intervals_of(directions(classes), epsilon)
    placed = classes.select("class", "label", "dim", "n", "embedding").mapInArrow(
        cells, "class long, label int, dim int, n long, embedding array<float>, cells array<int>"
    )
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["label", "dim", "cells", "class"]
    placed = placed.repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("cells")
    blocks = staged(placed.mapInArrow(cut, BLOCK), folder, "blocks")
    pairs = near_pairs(blocks, epsilon, folder)
    for side in ("a", "b"):
        own = blocks.select(F.col("block").alias(side), *(["dim"] if side == "a" else []), *[F.col(c).alias(f"{c}_{side}") for c in ("ids", "counts", "vectors")])
        pairs = pairs.join(own, side)
    found = pairs.select("a", "b", "dim", "ids_a", "counts_a", "vectors_a", "ids_b", "counts_b", "vectors_b")
    found = staged(found.mapInArrow(compared(least), "a long, b long, links long"), folder, "found")
    links = found.groupBy("a").agg(F.sum("links").alias("links"))
    roots = components(found.select("a", "b"), folder)
    members = classes.select(*key, "class", "rep", "n").join(links, F.col("class") == F.col("a"), "left").drop("a")
    members = members.join(roots, F.col("class") == F.col("node"), "left").select(
        *key, "rep", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("root", "class").alias("root")
    )
    least_id = members.groupBy("root").agg(F.min("rep").alias("component"))
    members = members.join(least_id, "root").select(*[F.col(c).alias(f"_{c}") for c in key], "n_links", "component", F.lit(True).alias("_usable"))
    same = [F.col(c) == F.col(f"_{c}") for c in key] + [F.col("usable") == F.col("_usable")]
    component = F.coalesce("component", "vec_id")
    return rows.drop("embedding").join(members, same, "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
