"""Near-duplicate vectors by collision counting on one-dimensional projections.

Unit vectors of one label are projected on many random directions. Two vectors at the threshold differ along a direction
by about a normal deviate of known width, so a window of ``REACH`` such widths around a query holds its neighbour with a
known chance; the number of windows that must hold it is the largest one that still reaches ``RECALL`` (a binomial tail).
The first projection is sorted into bins as wide as its own, wider window, and only a bin and the one below it meet. Pairs
that pass the count are verified by their cosine in double precision.

Equal vectors of a label are one node with a count. A bin is cut into blocks and every pair of blocks is a task, which
counts windows and verifies by matrix; it gives each node's number of links and as many links as join the same nodes,
never all pairs.

Defined results: vectors that are null, empty, zero or hold null or non-finite components, and rows with a null label,
link with nothing; vectors of different length never link; rows that repeat a vec_id are vectors of their own; null ids
count as links, but a component's id is its smallest that is not null; an empty table gives an empty result; other
columns are never read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from changeloom.llm.common import components, small_batches, stored
from changeloom.llm.jaccard import forest

PROJECTIONS = 32
REACH = 1.5  # half a window, in widths of the difference of a pair at the threshold
FIRST_REACH = 3.5  # the same for the projection that is sorted
RECALL = 0.995
BLOCK = 512


def width(cosine: float, d: int) -> float:
    """Spread of the difference of two unit vectors with this cosine along a random direction."""
    return math.sqrt(max(2 - 2 * cosine, 1e-12) / d)


def least_count(n: int = PROJECTIONS, reach: float = REACH, recall: float = RECALL) -> int:
    """The largest count of colliding windows that a pair at the threshold still reaches with this chance."""
    p = math.erf(reach / math.sqrt(2))
    tail = 0.0
    for k in range(n, -1, -1):
        tail += math.comb(n, k) * p**k * (1 - p) ** (n - k)
        if tail >= recall:
            return k
    return 0


def directions(d: int, n: int = PROJECTIONS) -> np.ndarray:
    """Unit directions, the same in every task; the first is the one that is sorted."""
    r = np.random.default_rng(d).normal(size=(d, n + 1))
    return r / np.linalg.norm(r, axis=0)


def unit(values) -> np.ndarray | None:
    """The vector at length one, or None where it links with nothing."""
    if not values or None in values:
        return None
    v = np.array(values, np.float64)
    top = np.abs(v).max()
    if not np.isfinite(top) or top == 0:
        return None
    v = v / top
    return v / math.sqrt(float(v @ v))


def _nodes(vectors: DataFrame, cosine: float) -> DataFrame:
    """vec_id, label, node, d, bin, u of every row; the last four are null where the vector takes no part."""

    def run(batches):
        for batch in batches:
            ids, labels, column = batch.columns
            rows = []
            for label, values in zip(labels.to_pylist(), column.to_pylist()):
                u = unit(values) if label is not None else None
                if u is None:
                    rows.append((None,) * 4)
                    continue
                raw = np.array(values, np.float64).tobytes()
                cell = math.floor(float(u @ directions_of(len(u))[:, 0]) / (FIRST_REACH * width(cosine, len(u))))
                rows.append((xxhash.xxh3_64_intdigest(f"{label}\0".encode() + raw) - (1 << 63), len(u), cell, u.tobytes()))
            node, d, cell, u = zip(*rows) if rows else ((),) * 4
            yield pa.RecordBatch.from_arrays(
                [ids, labels, pa.array(node, pa.int64()), pa.array(d, pa.int32()), pa.array(cell, pa.int32()), pa.array(u, pa.binary())],
                ["vec_id", "label", "node", "d", "bin", "u"],
            )

    kinds = {f.name: f.dataType.simpleString() for f in vectors.schema}
    return vectors.mapInArrow(run, f"vec_id {kinds['vec_id']}, label {kinds['label']}, node long, d int, bin int, u binary")


_directions: dict[int, np.ndarray] = {}


def directions_of(d: int) -> np.ndarray:
    if d not in _directions:
        _directions[d] = directions(d)
    return _directions[d]


def block_links(a: np.ndarray, b: np.ndarray | None, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of unit vectors that pass the count and the cosine, between two blocks or (``b`` None) within one."""
    d = a.shape[1]
    r = directions_of(d)[:, 1:]
    half = REACH * width(cosine, d)
    pa_, pb = (a @ r).astype(np.float32), ((a if b is None else b) @ r).astype(np.float32)
    count = np.zeros((len(pa_), len(pb)), np.int16)
    for m in range(r.shape[1]):
        count += np.abs(pa_[:, m, None] - pb[None, :, m]) <= half
    i, j = np.nonzero(count >= least_count(r.shape[1]))
    if b is None:
        i, j = i[i < j], j[i < j]
    other = a if b is None else b
    keep = np.concatenate([np.einsum("ij,ij->i", a[i[k : k + 65536]], other[j[k : k + 65536]]) >= cosine for k in range(0, len(i), 65536)]) if len(i) else np.zeros(0, bool)
    return i[keep], j[keep]


def _dealt(classes: DataFrame) -> DataFrame:
    """Every node once for each pair of blocks it belongs to: within its bin, and with the bins next to it."""
    place = ["label", "d"]
    sizes = classes.groupBy(*place, "bin").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    along = Window.partitionBy(*place).orderBy("bin")
    near = lambda f, step: F.when(f("bin").over(along) == F.col("bin") + step, f("blocks").over(along)).otherwise(0)
    sizes = sizes.select("*", near(F.lag, -1).alias("below"), near(F.lead, 1).alias("above"))
    cut = classes.join(sizes, [*place, "bin"]).withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    upto = lambda n: F.when(F.col(n) > 0, F.sequence(F.lit(0), F.col(n) - 1)).otherwise(F.array().cast("array<int>"))
    key = lambda at, kind, x, y, side: F.struct(at.alias("at"), F.lit(kind).alias("kind"), x.alias("x"), y.alias("y"), side.alias("side"))
    own, here = F.col("own"), F.col("bin")
    pairs = F.concat(
        F.transform(upto("blocks"), lambda j: key(here, 0, F.least(own, j), F.greatest(own, j), F.when(own <= j, 0).otherwise(1))),
        F.transform(upto("below"), lambda j: key(here, 1, own, j, F.lit(0))),
        F.transform(upto("above"), lambda j: key(here + 1, 1, j, own, F.lit(1))),
    )
    return cut.select(*place, "node", "n", "u", F.explode(pairs).alias("k")).select(*place, "k.*", "node", "n", "u")


def dedup(vectors: DataFrame, cosine: float = 0.98, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """Per vector: vec_id, n_links, component_id, kept."""
    small_batches(vectors.sparkSession, rows=4096)
    source = vectors.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).alias("v"))
    rows = stored(_nodes(source, cosine), "vectors")
    classes = stored(
        rows.where("node is not null").groupBy("label", "d", "bin", "node")
        .agg(F.count("*").alias("n"), F.min("vec_id").alias("low"), F.first("u").alias("u")), "vector-classes",
    )

    def run(table: pa.Table) -> pa.Table:
        node, n, side = (table.column(c).to_numpy() for c in ("node", "n", "side"))
        d = table.column("d")[0].as_py()
        u = np.frombuffer(b"".join(table.column("u").to_pylist()), np.float64).reshape(-1, d)
        within = table.column("kind")[0].as_py() == 0 and table.column("x")[0].as_py() == table.column("y")[0].as_py()
        first, second = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        if within:
            i, j = block_links(u, None, cosine)
        elif len(first) and len(second):
            i, j = block_links(u[first], u[second], cosine)
            i, j = first[i], second[j]
        else:
            i = j = np.zeros(0, np.int64)
        links = np.bincount(i, n[j], len(node)) + np.bincount(j, n[i], len(node))
        some = np.flatnonzero(links)
        a, b = forest(node[i], node[j])
        return pa.table({
            "a": pa.array(np.concatenate((node[some], a))), "b": pa.array(np.concatenate((node[some], b))),
            "n": pa.array(np.concatenate((links[some].astype(np.int64), np.zeros(len(a), np.int64)))),
        })

    found = stored(_dealt(classes).groupBy("label", "d", "at", "kind", "x", "y").applyInArrow(run, "a long, b long, n long"), "vector-links")
    links = found.where("a = b").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("links"))
    reach = components(found.where("a <> b").select("a", "b"))
    named = classes.select("node", "low", "n").join(reach, "node", "left").withColumn("component", F.coalesce("component", "node"))
    lows = named.groupBy("component").agg(F.min("low").alias("component_id"))
    at = named.join(lows, "component").join(links, "node", "left").select(
        "node", "component_id", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links")
    )
    out = rows.select("vec_id", "node").join(at, "node", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id")
    )
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
