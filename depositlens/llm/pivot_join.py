"""Near-copies among embeddings by an exact metric range join.

On unit vectors a cosine of at least t is a distance of at most r = sqrt(2 - 2t). Pivots, sampled vectors at least 2r apart, cut the vectors of a label
into cells: a vector's home is the cell of its nearest pivot. By the triangle inequality a vector within r of one at home in cell j is at most 2r
nearer to its own pivot than to j's, and at most r beyond the plane between the two pivots; vectors that may be so are copied into cell j as visitors.
So each vector meets all its links in its home cell, cells are joined independently of each other, and links are counted once per end.

Vectors within r/2 of the same pivot, its core, are linked by the triangle inequality: they are counted, not compared, so a cell that holds a third of all
rows as a dense group costs one pass. All others are compared block by block: a cell is dealt into chunks of bounded size, and each pair of
chunks, core against core left out, is a group of its own. A group returns per vector its number of links and one link to the root of its search tree, never pairs. Equal
vectors are one, with a weight.

Nothing is pruned where vectors have no structure: directions spread evenly over many dimensions lie near every plane, and visit most cells.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from depositlens.llm.common import forget, settle
from depositlens.llm.components import components

THRESHOLD = 0.93
CELL = 4096
MAX_PIVOTS = 1024
SAMPLE = 4096
CHUNK = 4096
BLOCK = 1024
SLACK = 1e-9
MEMBER = "cell string, home boolean, core boolean, node long, weight long, vec array<double>"


def radius(threshold: float) -> float:
    return math.sqrt(2 - 2 * threshold)


def marked(rows: DataFrame) -> DataFrame:
    """(id, label, vec) with ``mark``: a digest of the components as doubles; NULL for a vector that links with nothing."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = []
            for label, own in zip(batch.column("label"), batch.column("vec"), strict=True):
                values = own.values
                if not label.is_valid or values is None or values.null_count:
                    marks.append(None)
                    continue
                vector = values.to_numpy(zero_copy_only=False).astype(np.float64) + 0.0
                with np.errstate(over="ignore"):
                    usable = np.isfinite(vector).all() and vector.any()
                marks.append(hashlib.md5(vector.tobytes()).digest() if usable else None)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(marks, pa.binary())], [*batch.schema.names, "mark"])

    return rows.mapInArrow(mark, T.StructType([*rows.schema.fields, T.StructField("mark", T.BinaryType())]))


def matrix(column: pa.Array) -> np.ndarray:
    """Unit vectors, one row each; all of one length. Scaled by the largest component first, so that no square overflows or vanishes."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = flat.reshape(len(column), -1)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def distances(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * (rows @ pivots.T), 0))


def choose_pivots(vectors: DataFrame, total: int, reach: float) -> dict[tuple, np.ndarray]:
    """Pivots by (label, length): one for about ``CELL`` vectors, at least 2r apart, taken from a sample of ``SAMPLE`` vectors at most.

    Those with most of the sample within r/2 come first, so a dense group has its pivot inside. The sample is that of smallest hash, so a
    run repeated after a lost executor chooses the same.
    """
    wanted = min(MAX_PIVOTS, -(-total // CELL))
    sample: dict[tuple, list] = {}
    for label, vec in vectors.orderBy(F.xxhash64("mark"), "mark").limit(SAMPLE).select("label", "vec").collect():
        sample.setdefault((label, len(vec)), []).append(vec)
    units = {key: matrix(pa.array(own, pa.list_(pa.float64()))) for key, own in sample.items()}
    near = {key: (distances(own, own) <= reach / 2).sum(axis=1) for key, own in units.items()}
    found: dict[tuple, list[np.ndarray]] = {}
    for _, key, place in sorted((-int(n), key, place) for key, own in near.items() for place, n in enumerate(own)):
        own, unit = found.setdefault(key, []), units[key][place]
        if wanted and (not own or distances(unit[None], np.array(own)).min() > 2 * reach):
            own.append(unit)
            wanted -= 1
    return {key: np.array(own) for key, own in found.items() if own}


def members(vectors: DataFrame, pivots: dict[tuple, np.ndarray], reach: float) -> DataFrame:
    """``MEMBER`` rows of ``vectors`` (node, weight, label, vec): each at home in one cell and a visitor wherever a link may be.

    A label without pivots is one cell. ``vec`` is the unit vector.
    """
    shared = vectors.sparkSession.sparkContext.broadcast(pivots)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = batch.column("label").to_pylist()
            sizes = np.diff(batch.column("vec").offsets.to_numpy())
            groups: dict[tuple, list[int]] = {}
            for place, key in enumerate(zip(labels, sizes.tolist(), strict=True)):
                groups.setdefault(key, []).append(place)
            for key, places in groups.items():
                for start in range(0, len(places), BLOCK):
                    part = batch.take(pa.array(places[start : start + BLOCK]))
                    yield from of_group(key, part)

    def of_group(key: tuple, part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows = matrix(part.column("vec"))
        name = f"{key[0]}:{key[1]}"
        own = shared.value.get(key)
        if own is None:
            yield batch_of(part, rows, np.arange(len(rows)), [f"{name}:"] * len(rows), np.ones(len(rows), bool), np.zeros(len(rows), bool))
            return
        far = distances(rows, own)
        home = far.argmin(axis=1)
        nearest = far[np.arange(len(rows)), home]
        between = distances(own, own)
        beyond = (far**2 - nearest[:, None] ** 2) / np.maximum(2 * between[home], SLACK)
        visits = (far - nearest[:, None] <= 2 * reach + SLACK) & (beyond <= reach + SLACK)
        visits[np.arange(len(rows)), home] = True
        for cell in np.flatnonzero(visits.any(axis=0)):
            places = np.flatnonzero(visits[:, cell])
            yield batch_of(part, rows, places, [f"{name}:{cell}"] * len(places), home[places] == cell, far[places, cell] <= reach / 2 - SLACK)

    def batch_of(part: pa.RecordBatch, rows: np.ndarray, places: np.ndarray, cells: list[str], home: np.ndarray, core: np.ndarray) -> pa.RecordBatch:
        took = pa.array(places)
        width = rows.shape[1]
        vec = pa.ListArray.from_arrays(pa.array(np.arange(0, (len(places) + 1) * width, width), pa.int32()), pa.array(rows[places].ravel()))
        return pa.RecordBatch.from_arrays(
            [pa.array(cells), pa.array(home), pa.array(core), part.column("node").take(took), part.column("weight").take(took), vec], ["cell", "home", "core", "node", "weight", "vec"]
        )

    return vectors.select("node", "weight", "label", "vec").mapInArrow(deal, MEMBER)


def close(left: np.ndarray, right: np.ndarray, threshold: float) -> np.ndarray:
    """Which rows have a cosine of ``threshold`` or more; those within rounding of it are summed anew without error."""
    cosines = left @ right.T
    found = cosines >= threshold
    for x, y in np.argwhere(np.abs(cosines - threshold) <= SLACK):
        a, b = left[x], right[y]
        found[x, y] = math.fsum(a * b) / math.sqrt(math.fsum(a * a) * math.fsum(b * b)) >= threshold
    return found


def trees(found: np.ndarray, square: bool) -> np.ndarray:
    """For the rows and columns of a link matrix (the same vectors if ``square``) the place of a root each can reach."""
    n, m = found.shape
    roots = np.full(n if square else n + m, -1, np.int64)
    for start in range(n):
        if roots[start] >= 0:
            continue
        roots[start] = start
        open_ = [start]
        while open_:
            place = open_.pop()
            if square:
                new = np.flatnonzero(found[place] & (roots < 0))
            elif place < n:
                new = n + np.flatnonzero(found[place] & (roots[n:] < 0))
            else:
                new = np.flatnonzero(found[:, place - n] & (roots[:n] < 0))
            roots[new] = start
            open_.extend(new.tolist())
    return roots


LINKED = "node long, links long, root long"


def compare(table: pa.Table, threshold: float) -> pa.Table:
    """Links within one pair of chunks: per vector (only those at home count) its number, and a root it is linked to."""
    table = table.combine_chunks()
    rows = matrix(table.column("vec").combine_chunks())
    side = table.column("side").to_numpy()
    node, weight = table.column("node").to_numpy(), table.column("weight").to_numpy()
    home = table.column("home").to_numpy()
    left, right = np.flatnonzero(side < 2), np.flatnonzero(side > 0)  # side 1 is a chunk against itself
    square = bool((side == 1).any())
    found = np.zeros((len(left), len(right)), bool)
    for start in range(0, len(left), BLOCK):
        found[start : start + BLOCK] = close(rows[left[start : start + BLOCK]], rows[right], threshold)
    if square:
        np.fill_diagonal(found, False)
        links = found @ weight[right]
        places, roots = left, trees(found, True)
    else:
        links = np.concatenate([found @ weight[right], weight[left] @ found])
        places, roots = np.concatenate([left, right]), trees(found, False)
        roots = np.where(roots < 0, np.arange(len(roots)), roots)
    told = np.where(home[places], links, 0)
    keep = (told > 0) | (roots != np.arange(len(roots)))
    return pa.table({"node": node[places][keep], "links": told[keep], "root": node[places[roots]][keep]})


def links(dealt: DataFrame, threshold: float) -> DataFrame:
    """``LINKED`` rows of the members: some per vector, links to be added up."""
    cells = dealt.groupBy("cell").agg(
        F.count_if("core").alias("cores"),
        F.sum(F.when(F.col("core"), F.col("weight")).otherwise(0)).alias("core_weight"),
        F.min(F.when(F.col("core"), F.col("node"))).alias("core_node"),
        F.count_if(~F.col("core")).alias("others"),
    )
    cells = cells.select(
        F.col("cell").alias("of_cell"), "core_weight", "core_node",
        F.ceil(F.col("cores") / CHUNK).cast("int").alias("core_chunks"), F.ceil(F.col("others") / CHUNK).cast("int").alias("chunks"),
    )
    placed = dealt.join(cells, dealt["cell"] == cells["of_cell"])
    counted = placed.where("core").select(
        "node", F.when(F.col("home"), F.col("core_weight") - F.col("weight")).otherwise(0).alias("links"), F.col("core_node").alias("root")
    )
    chunk = F.pmod(F.xxhash64("node"), F.greatest(F.when(F.col("core"), F.col("core_chunks")).otherwise(F.col("chunks")), F.lit(1))).cast("int")
    # A chunk of others meets every chunk of others once and every chunk of the core; sides 0 and 2, or 1 for a chunk by itself.
    pair = lambda low, high, side: F.struct(low.alias("low"), high.alias("high"), side.cast("int").alias("side"))
    others = F.sequence(F.lit(0), F.col("chunks") - 1)
    own = F.transform(others, lambda c: pair(F.least(c, F.col("chunk")), F.greatest(c, F.col("chunk")), 1 + F.signum(F.col("chunk") - c)))
    to_core = F.transform(F.sequence(F.lit(-1), -F.col("core_chunks"), F.lit(-1)), lambda c: pair(c, F.col("chunk"), F.lit(2)))
    from_core = F.transform(others, lambda c: pair(-F.col("chunk") - 1, c, F.lit(0)))
    groups = F.when(F.col("core"), from_core).when(F.col("core_chunks") > 0, F.concat(own, to_core)).otherwise(own)
    units = (
        placed.withColumn("chunk", chunk)
        .where("NOT core OR chunks > 0")
        .select("cell", "node", "weight", "home", "vec", F.explode(groups).alias("pair"))
        .select("cell", "pair.low", "pair.high", "pair.side", "node", "weight", "home", "vec")
    )
    compared = units.groupBy("cell", "low", "high").applyInArrow(lambda table: compare(table, threshold), LINKED)
    return counted.unionByName(compared)


def near_copy_classes(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str | None = "label", threshold: float = THRESHOLD) -> DataFrame:
    """Per row of ``vectors`` its id, ``n_links``, ``component_id`` and ``kept``.

    Rows are linked if their labels are equal (none is asked for without ``label_col``) and their cosine in double precision is ``threshold`` or more. A vector that is missing, empty, zero or has a missing or
    non-finite component, and one without a label, links with nothing; neither do vectors of different lengths. ``n_links`` counts the other rows linked directly, copies too.
    ``component_id`` is the smallest id reachable, missing ids aside (a row's own id if it has no links); ``kept`` is true for the rows with
    that id, and for those without id in a component without any. Repeated rows are vectors of their own. An empty table gives no rows. Other columns
    are not read.
    """
    reach = radius(threshold)
    label = F.lit("") if label_col is None else F.col(f"`{label_col}`").cast("string")
    rows = vectors.select(F.col(f"`{id_col}`").alias("id"), label.alias("label"), F.col(f"`{vec_col}`").cast("array<double>").alias("vec"))
    told = settle(marked(rows), "vectors")
    distinct = told.where("mark IS NOT NULL").groupBy("label", "mark").agg(F.count(F.lit(1)).alias("weight"), F.min("id").alias("first"), F.first("vec").alias("vec"))
    nodes = settle(distinct.withColumn("node", F.monotonically_increasing_id()), "nodes")
    dealt = settle(members(nodes, choose_pivots(nodes, nodes.count(), reach), reach), "members")
    linked = settle(links(dealt, threshold).groupBy("node", "root").agg(F.sum("links").alias("links")), "linked")
    counts = linked.groupBy("node").agg(F.sum("links").alias("links"))
    labels, kept = components(linked.select(F.col("node").alias("x"), F.col("root").alias("y")))
    joined = (
        nodes.select("node", F.col("label").alias("of_label"), F.col("mark").alias("of_mark"), "weight", "first")
        .join(counts, "node", "left")
        .join(labels.select(F.col("node").alias("of_node"), F.col("label").alias("component")), F.col("node") == F.col("of_node"), "left")
        .withColumn("component", F.coalesce("component", "node"))
    )
    known = settle(joined.select("of_label", "of_mark", "first", "component", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links")), "classes")
    forget(nodes, dealt, linked, *kept)
    smallest = known.groupBy("component").agg(F.min("first").alias("least"))
    found = known.join(smallest, "component").select("of_label", "of_mark", "n_links", "least")
    result = told.select("id", "label", "mark").join(found, (F.col("label") == F.col("of_label")) & (F.col("mark") == F.col("of_mark")), "left")
    component = F.when(F.col("of_mark").isNull(), F.col("id")).otherwise(F.col("least"))
    return result.select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )
