"""Near-duplicate vectors: cells of spherical k-means, blocked cosine products, one vector kept of each group.

1. Spherical k-means is fitted on a bounded sample (one fit for each length of vectors in it), about one
   cell for ``cell_rows`` rows, and every vector goes to the cell of its nearest centroid.
2. Within a cell, vectors around a common direction form a ball whose radius is at most half the angle of the
   threshold: all its members are links of each other, which needs no product. Equal vectors are a ball of
   radius 0, so groups of copies of any size become a few rows, one for each ``block`` of them.
3. Balls and single vectors are compared in blocks with those of their own cell and of the neighbouring cells they
   may have a link in. Two balls are all links or none where the triangle inequality decides; the others
   are listed and compared vector by vector, in blocks. A block gives one number of links for each row and the
   links that hold its groups together, never all pairs.
4. Groups are the connected components of these links; the least id of each stays.

A vector looks for links in its own cell and in each cell whose border lies at most ``reach`` away (its distance to
the hyperplane between the two centroids). A link at the threshold points from a vector in any direction;
``reach`` is ``spread`` standard deviations of such a direction's part across the border, and never
more than the sine of the angle, from where on nothing can be missed. ``spread=None`` takes the sine always.
Either vector may look in the other's cell, so a link is missed only beyond twice the reach.

Vectors that are null, zero, or hold null or non-finite components link with nothing: 0 links, a component of
their own. Vectors of different lengths do not link. Components of any finite size: vectors are scaled by a
power of two first. Null vec_id: links as any other row; components are named by their least other
id, and where there is none the name is null. Repeated vec_ids: each row counts. Empty table:
no rows. Extra columns: ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlane.llm.common import column_of
from wattlane.llm.components import connected_components
from wattlane.session import discard, materialize

SAMPLE_ROWS = 20_000
SAMPLE_VALUES = 8_000_000
EDGE = 1e-9  # angles closer to a limit than this are not decided by it
SINGLE, MEMBER, BALL = 0, 1, 2
COUNT, LINK, OPEN, ROW_COUNT = 0, 1, 2, 3
PLACED = "vec_id long, embedding array<double>, dim int, cell int, row long"
GATHERED = (
    "kind int, row long, vec_id long, entity long, dim int, cell int, embedding array<double>, "
    "radius double, weight long, probes array<int>"
)
MET = "kind int, a long, b long, n long"
ASKING_BLOCKS = 8  # asking rows of a task in blocks, so that a cell's own rows travel less often


def unit_rows(x: np.ndarray) -> np.ndarray:
    """Rows of length 1; each is scaled by a power of two first, so that no square overflows or vanishes."""
    power = np.frexp(np.abs(x).max(axis=1, keepdims=True))[1]
    # Two steps: the power itself may be beyond a double.
    x = np.ldexp(np.ldexp(x, -(power // 2)), -(power - power // 2))
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def matrix_of(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(-1, dim)


def nearest_centre(unit: np.ndarray, centre: np.ndarray, rows: int = 1024) -> np.ndarray:
    """Number of the nearest direction of each row; the first of equals. ``rows`` bounds the products held at once."""
    parts = [(unit[a : a + rows] @ centre.T).argmax(axis=1) for a in range(0, len(unit), rows)]
    return np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64)


def spherical_k_means(unit: np.ndarray, k: int, rounds: int = 10, seed: int = 3) -> np.ndarray:
    """Directions of ``k`` cells (fewer for fewer rows); an empty cell keeps its direction."""
    rng = np.random.default_rng(seed)
    centre = unit[rng.choice(len(unit), min(k, len(unit)), replace=False)]
    for _ in range(rounds):
        near = nearest_centre(unit, centre)
        total = np.zeros_like(centre)
        np.add.at(total, near, unit)
        size = np.sqrt((total * total).sum(axis=1, keepdims=True))
        centre = np.where(size > 1e-12, total / np.maximum(size, 1e-12), centre)
    return centre


@dataclass
class Cells:
    """Centroids for each length of vectors, and how far from a border links may cross it."""

    least: float
    spread: float | None
    centre: dict[int, np.ndarray] = field(default_factory=dict)

    def reach(self, dim: int) -> float:
        sine = math.sqrt(1 - self.least**2)
        if self.spread is None:
            return sine
        return min(sine, self.spread * sine / self.least / math.sqrt(max(dim - 1, 1)))

    def home(self, unit: np.ndarray) -> np.ndarray:
        centre = self.centre.get(unit.shape[1])
        return np.zeros(len(unit), dtype=np.int64) if centre is None else nearest_centre(unit, centre)

    def probes(self, unit: np.ndarray, home: int, radius: np.ndarray) -> list[list[int]]:
        """Other cells in which each row (a ball of that radius around it) may have links."""
        centre = self.centre.get(unit.shape[1])
        if centre is None or len(centre) < 2:
            return [[] for _ in range(len(unit))]
        near = unit @ centre.T
        width = np.sqrt(np.maximum(((centre - centre[home]) ** 2).sum(axis=1), 1e-24))
        margin = (near[:, [home]] - near) / width
        found = margin <= (self.reach(unit.shape[1]) + 2 * np.sin(radius / 2))[:, None]
        found[:, home] = False
        rows, cells = np.nonzero(found)
        cut = np.searchsorted(rows, np.arange(1, len(unit)))
        return [part.tolist() for part in np.split(cells, cut)]


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(vec_id, embedding as doubles or null where the vector links with nothing) of every row."""
    x = F.col(vector).cast("array<double>")
    fit = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(x, lambda v: v != 0)
    return vectors.select(F.col(key).cast("long").alias("vec_id"), F.when(fit, x).alias("embedding"))


def fit_cells(rows: DataFrame, least: float, spread: float | None, cell_rows: int) -> Cells:
    """Cells from at most about ``SAMPLE_ROWS`` vectors or ``SAMPLE_VALUES`` components."""
    cells = Cells(least, spread)
    size = rows.agg(F.count("*").alias("n"), F.sum(F.size("embedding").cast("decimal(38,0)")).alias("values")).first()
    if not size["n"]:
        return cells
    share = min(1.0, SAMPLE_ROWS / size["n"], SAMPLE_VALUES / float(size["values"]))
    draw = F.shiftrightunsigned(F.xxhash64("vec_id", "embedding", F.lit(11)), 11)
    drawn = rows.where(draw < F.lit(share * float(1 << 53))).select("embedding").toPandas()["embedding"]
    of_dim: dict[int, list] = {}
    for x in drawn:
        of_dim.setdefault(len(x), []).append(x)
    for dim, part in of_dim.items():
        k = min(math.ceil(len(part) / share / cell_rows), max(1, len(part) // 4))
        # In the order of their values, so that the fit is the same however rows come in.
        sample = np.array(sorted(map(tuple, part)), dtype=np.float64)
        cells.centre[dim] = spherical_k_means(unit_rows(sample), k)
    return cells


def place(rows: DataFrame, cells: Cells) -> DataFrame:
    """Each usable vector with its cell, and a number of its own."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = column_of(batch, "embedding")
            dims = np.asarray(column.value_lengths())
            cell = np.zeros(batch.num_rows, dtype=np.int32)
            for dim in np.unique(dims).tolist():
                at = np.flatnonzero(dims == dim)
                cell[at] = cells.home(unit_rows(matrix_of(column.take(pa.array(at)), dim)))
            columns = [column_of(batch, "vec_id"), column, pa.array(dims, pa.int32()), pa.array(cell), column_of(batch, "row")]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "embedding", "dim", "cell", "row"])

    numbered = rows.where(F.col("embedding").isNotNull()).withColumn("row", F.monotonically_increasing_id())
    return numbered.mapInArrow(find, PLACED)


def balls_of(unit: np.ndarray, least: float, smallest: int) -> list[tuple[np.ndarray, np.ndarray, float]]:
    """(rows, direction, radius) of disjoint balls of links, each of at least ``smallest`` rows.

    Rows with most links lead. The links of a leader that lie within half the threshold's angle of their mean
    direction form a ball; the mean is taken twice.
    """
    near = unit @ unit.T
    links = (near >= least).sum(axis=1)
    limit = math.acos(least) / 2 - EDGE
    free = np.ones(len(unit), dtype=bool)
    found = []
    for lead in np.argsort(-links, kind="stable"):
        if links[lead] < smallest:
            break
        if not free[lead]:
            continue
        around = np.flatnonzero(free & (near[lead] >= least))
        rows = around
        for _ in range(2):
            if len(rows) < smallest:
                break
            middle = unit[rows].sum(axis=0)
            middle /= np.sqrt((middle * middle).sum())
            # The chord is exact for small angles, where the cosine is not.
            angle = 2 * np.arcsin(np.minimum(np.sqrt(((unit[around] - middle) ** 2).sum(axis=1)) / 2, 1))
            inside = angle <= limit
            rows, radius = around[inside], float(angle[inside].max(initial=0.0))
        if len(rows) >= smallest:
            found.append((rows, middle, radius))
            free[rows] = False
    return found


def gather(placed: DataFrame, cells: Cells, smallest: int, block: int) -> DataFrame:
    """Single vectors, members of balls and the balls, from blocks of about ``block`` rows of a cell."""
    spark = placed.sparkSession
    counts = placed.groupBy("dim", "cell").agg(F.count("*").alias("n")).select("dim", "cell", F.ceil(F.col("n") / block).alias("parts"))

    def form(key, table):
        dim, cell = key[0].as_py(), key[1].as_py()
        table = table.sort_by("row")
        n = table.num_rows
        unit = unit_rows(matrix_of(table.column("embedding"), dim))
        row = table.column("row").to_numpy()
        kind, entity, weight = np.full(n, SINGLE), row.copy(), np.ones(n, dtype=np.int64)
        balls = balls_of(unit, cells.least, smallest)
        for rows, _, _ in balls:
            kind[rows], entity[rows], weight[rows] = MEMBER, row[rows].min(), len(rows)
        probes: list = [None] * n
        alone = np.flatnonzero(kind == SINGLE)
        for i, found in zip(alone.tolist(), cells.probes(unit[alone], cell, np.zeros(len(alone)))):
            probes[i] = found
        b = len(balls)
        radius = np.array([r for _, _, r in balls])
        if b:
            middles = np.array([m for _, m, _ in balls])
            probes += cells.probes(middles, cell, radius)
            ids = np.array([row[rows].min() for rows, _, _ in balls])
            kind, entity = np.append(kind, np.full(b, BALL)), np.append(entity, ids)
            weight = np.append(weight, [len(rows) for rows, _, _ in balls])
            unit = np.vstack([unit, middles])
        total = n + b
        flat = pa.ListArray.from_arrays(pa.array(np.arange(total + 1, dtype=np.int32) * dim, pa.int32()), pa.array(unit.ravel()))
        empty = [None] * b
        return pa.table(
            {
                "kind": pa.array(kind, pa.int32()),
                "row": pa.array(row.tolist() + empty, pa.int64()),
                "vec_id": pa.array(table.column("vec_id").to_pylist() + empty, pa.int64()),
                "entity": pa.array(entity, pa.int64()),
                "dim": pa.array(np.full(total, dim), pa.int32()),
                "cell": pa.array(np.full(total, cell), pa.int32()),
                "embedding": flat,
                "radius": pa.array(np.append(np.zeros(n), radius)),
                "weight": pa.array(weight, pa.int64()),
                "probes": pa.array(probes, pa.list_(pa.int32())),
            }
        )

    parts = materialize(counts, "cell-parts")
    dealt = placed.join(F.broadcast(parts), ["dim", "cell"])  # one row for each cell
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("row"), F.col("parts")))
    return dealt.select("dim", "cell", "part", "row", "vec_id", "embedding").groupBy("dim", "cell", "part").applyInArrow(form, GATHERED)


def _stars(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the same nodes as the pairs (a, b) do: from every node to the least it reaches."""
    nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = place[: len(a)], place[len(a) :]
    name = np.arange(len(nodes))
    while True:
        before = name.copy()
        low = np.minimum(name[a], name[b])
        np.minimum.at(name, a, low)
        np.minimum.at(name, b, low)
        name = name[name]
        if (name == before).all():
            break
    away = np.flatnonzero(name != np.arange(len(nodes)))
    return nodes[away], nodes[name[away]]


def _results(*parts: tuple[int, np.ndarray, np.ndarray | None, np.ndarray | None]) -> pa.Table:
    columns: list[list] = [[], [], [], []]
    for kind, a, b, n in parts:
        for column, values in zip(columns, (np.full(len(a), kind), a, b, n)):
            column.append(np.zeros(len(a), dtype=np.int64) if values is None else values)
    types = (pa.int32(), pa.int64(), pa.int64(), pa.int64())
    return pa.table({name: pa.array(np.concatenate(c), t) for name, c, t in zip("kind a b n".split(), columns, types)})


def _links(x: np.ndarray, y: np.ndarray, least: float) -> np.ndarray:
    """Which rows of unit vectors have a cosine of at least ``least``; those at the limit by the plain formula."""
    near = x @ y.T
    found = near >= least
    for i, j in zip(*np.nonzero(np.abs(near - least) < EDGE)):
        a, b = x[i], y[j]
        found[i, j] = (a * b).sum() / (math.sqrt((a * a).sum()) * math.sqrt((b * b).sum())) >= least
    return found


def _relations(x: np.ndarray, y: np.ndarray, rx: np.ndarray, ry: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """(all members are links, undecided) for pairs of balls; a single vector has radius 0 and is decided by its cosine."""
    linked = _links(x, y, least)
    unsure = np.zeros_like(linked)
    in_x, in_y = np.flatnonzero(rx >= 0), np.flatnonzero(ry >= 0)
    limit = math.acos(least)
    for rows, columns in ((in_x, np.arange(len(y))), (np.flatnonzero(rx < 0), in_y)):
        if len(rows) and len(columns):
            both = np.maximum(rx[rows], 0)[:, None] + np.maximum(ry[columns], 0)[None]
            angle = np.arccos(np.clip(x[rows] @ y[columns].T, -1, 1))
            sure = angle + both <= limit - EDGE
            at = np.ix_(rows, columns)
            linked[at], unsure[at] = sure, ~sure & (angle - both <= limit + EDGE)
    return linked, unsure


def meet(gathered: DataFrame, cells: Cells, block: int) -> DataFrame:
    """Links of single vectors and balls: numbers for each, links that hold groups together, undecided pairs."""
    spark = gathered.sparkSession
    entities = gathered.where(F.col("kind") != MEMBER)
    # A ball is told from a vector by a radius that is not negative.
    radius = F.when(F.col("kind") == BALL, F.col("radius")).otherwise(-1.0)
    entities = entities.select("entity", "dim", F.col("cell").alias("home"), "embedding", radius.alias("radius"), "weight", "probes")
    own = entities.withColumn("cell", F.col("home"))
    asking = entities.withColumn("cell", F.explode(F.concat(F.array("home"), "probes")))
    sizes = own.groupBy("dim", "cell").agg(F.count("*").alias("own"))
    sizes = sizes.join(asking.groupBy("dim", "cell").agg(F.count("*").alias("asking")), ["dim", "cell"])
    cuts = materialize(
        sizes.select(
            "dim",
            "cell",
            F.ceil(F.col("own") / block).cast("int").alias("own_parts"),
            F.ceil(F.col("asking") / (ASKING_BLOCKS * block)).cast("int").alias("asking_parts"),
        ),
        "cell-cuts",
    )

    def parts(df: DataFrame, mine: str, other: str) -> DataFrame:
        """Each row in one part of its own side and in all parts of the other."""
        cut = df.join(F.broadcast(cuts), ["dim", "cell"])  # one row for each cell
        cut = cut.withColumn(f"{mine}_part", F.pmod(F.xxhash64("entity"), F.col(f"{mine}_parts")).cast("int"))
        cut = cut.withColumn(f"{other}_part", F.explode(F.sequence(F.lit(0), F.col(f"{other}_parts") - 1)))
        names = ["dim", "cell", "own_part", "asking_part", "entity", "home", "embedding", "radius", "weight", "probes"]
        # New names for the same columns, as both sides come from one table.
        return cut.select(*(F.col(c).alias(c) for c in names))

    keys = ["dim", "cell", "own_part", "asking_part"]

    def compare(key, here, there):
        dim, cell = key[0].as_py(), key[1].as_py()
        if not here.num_rows or not there.num_rows:
            return _results((COUNT, np.zeros(0, dtype=np.int64), None, None))
        x = matrix_of(here.column("embedding"), dim)
        idx, rx, wx = (here.column(c).to_numpy() for c in ("entity", "radius", "weight"))
        # A pair that meets in both cells counts in the one of the lower number.
        width = len(cells.centre.get(dim, ())) + 1
        lists = here.column("probes").combine_chunks()
        seen = np.repeat(np.arange(len(idx)), np.asarray(lists.value_lengths())) * width + lists.flatten().to_numpy()
        number = np.zeros(len(idx), dtype=np.int64)
        out = []
        for start in range(0, there.num_rows, block):
            asking = there.slice(start, block)
            y = matrix_of(asking.column("embedding"), dim)
            idy, ry, wy, home = (asking.column(c).to_numpy() for c in ("entity", "radius", "weight", "home"))
            linked, unsure = _relations(x, y, rx, ry, cells.least)
            i, j = np.nonzero((linked | unsure) & (idx[:, None] != idy[None]))
            again = (home[j] < cell) & np.isin(i * width + home[j], seen)
            i, j = i[~again], j[~again]
            local, sure = home[j] == cell, linked[i, j]
            # Pairs of the same cell meet twice, once from each side; others once, and count for both.
            number += np.bincount(i[sure], weights=wy[j[sure]], minlength=len(idx)).astype(np.int64)
            far = sure & ~local
            back = np.bincount(j[far], weights=wx[i[far]], minlength=len(idy)).astype(np.int64)
            once = ~sure & (~local | (idx[i] < idy[j]))
            a, b = idx[i[once]], idy[j[once]]
            # The heavier one is the ball that the members of the other are compared with.
            swap = (ry[j[once]] >= 0) & ((rx[i[once]] < 0) | (wy[j[once]] > wx[i[once]]))
            out += [
                (COUNT, idy[back > 0], None, back[back > 0]),
                (LINK, *_stars(idx[i[sure]], idy[j[sure]]), None),
                (OPEN, np.where(swap, b, a), np.where(swap, a, b), None),
            ]
        return _results((COUNT, idx[number > 0], None, number[number > 0]), *out)

    return parts(own, "own", "asking").groupBy(*keys).cogroup(parts(asking, "asking", "own").groupBy(*keys)).applyInArrow(compare, MET)


def decide_open(pairs: DataFrame, gathered: DataFrame, least: float, block: int) -> DataFrame:
    """Links of the members of undecided balls: numbers for each vector, and links between the balls."""
    rows = gathered.where(F.col("kind") != BALL).select("row", "entity", "dim", "embedding")
    others = pairs.select(F.col("a").alias("ball"), F.col("b").alias("entity")).join(rows, "entity")
    sizes = others.groupBy("ball").agg(F.ceil(F.count("*") / block).alias("parts"))
    others = others.join(sizes, "ball").withColumn("part", F.pmod(F.xxhash64("row"), F.col("parts")))
    own = rows.withColumnRenamed("entity", "ball").join(sizes, "ball")
    own = own.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    own = own.select(*(F.col(c).alias(c) for c in ("ball", "part", "row", "dim", "embedding")))

    def compare(key, here, there):
        none = np.zeros(0, dtype=np.int64)
        if not here.num_rows or not there.num_rows:
            return _results((COUNT, none, None, None))
        dim = here.column("dim")[0].as_py()
        x, y = (matrix_of(t.column("embedding"), dim) for t in (here, there))
        found = _links(x, y, least)
        mine, theirs = found.sum(axis=1), found.sum(axis=0)
        entity = np.unique(there.column("entity").to_numpy()[theirs > 0])
        return _results(
            (ROW_COUNT, here.column("row").to_numpy()[mine > 0], None, mine[mine > 0]),
            (ROW_COUNT, there.column("row").to_numpy()[theirs > 0], None, theirs[theirs > 0]),
            (LINK, entity, np.full(len(entity), key[0].as_py()), None),
        )

    return own.groupBy("ball", "part").cogroup(others.groupBy("ball", "part")).applyInArrow(compare, MET)


def near_vectors(
    vectors: DataFrame,
    least: float = 0.9,
    key: str = "vec_id",
    vector: str = "embedding",
    cell_rows: int = 2048,
    block: int = 2048,
    smallest: int = 8,
    spread: float | None = 2.0,
) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row."""
    rows = usable(vectors, key, vector)
    cells = fit_cells(rows.where(F.col("embedding").isNotNull()), least, spread, cell_rows)
    placed = materialize(place(rows, cells), "placed")
    gathered = materialize(gather(placed, cells, smallest, block), "gathered")
    discard(placed)
    met = materialize(meet(gathered, cells, block), "met")
    pairs = met.where(F.col("kind") == OPEN)
    if not pairs.isEmpty():
        met = met.unionByName(materialize(decide_open(pairs, gathered, least, block), "decided"))

    links = met.where(F.col("kind") == LINK).select("a", "b")
    names = connected_components(links, "vector-groups").withColumnRenamed("node", "entity")
    vectors_of = gathered.where(F.col("kind") != BALL).select("row", "vec_id", "entity", "weight")
    counts = met.where(F.col("kind") == COUNT).groupBy(F.col("a").alias("entity")).agg(F.sum("n").alias("links"))
    group = vectors_of.groupBy("entity").agg(F.min("vec_id").alias("least_id")).join(names, "entity", "left")
    group = materialize(group.withColumn("component", F.coalesce("component", "entity")), "groups")
    least_ids = group.groupBy("component").agg(F.min("least_id").alias("component_id"))
    group = group.join(least_ids, "component").join(counts, "entity", "left").select("entity", "component_id", "links")
    extra = met.where(F.col("kind") == ROW_COUNT).groupBy(F.col("a").alias("row")).agg(F.sum("n").alias("more"))
    found = vectors_of.join(group, "entity").join(extra, "row", "left")
    zero = F.lit(0)
    number = F.col("weight") - 1 + F.coalesce("links", zero) + F.coalesce("more", zero)
    result = found.select("vec_id", number.cast("long").alias("n_links"), "component_id")
    alone = rows.where(F.col("embedding").isNull()).select("vec_id", zero.cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return result.unionByName(alone).withColumn("kept", F.equal_null("vec_id", "component_id"))


def oracle_sql() -> str:
    """The same groups by comparison of all pairs and recursion over the links, in DuckDB."""
    return """
    WITH RECURSIVE v AS MATERIALIZED (
      SELECT vec_id, embedding::double[] AS x FROM embeddings
      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0
        AND len(list_filter(embedding, lambda e: e <> 0)) > 0
    ), links AS MATERIALIZED (
      SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
      WHERE list_cosine_similarity(a.x, b.x) >= 0.9
    ), reach AS (
      SELECT a, a AS b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
    ), names AS (SELECT a, min(b) AS least FROM reach GROUP BY a),
    counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
    SELECT e.vec_id, coalesce(c.n, 0) AS n_links, coalesce(m.least, e.vec_id) AS component_id,
      e.vec_id = coalesce(m.least, e.vec_id) AS kept
    FROM embeddings e LEFT JOIN names m ON m.a = e.vec_id LEFT JOIN counts c ON c.a = e.vec_id
    """
