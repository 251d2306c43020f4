"""Near-duplicate vectors by spherical-cap filters, verified by their cosine.

Filter directions are the code words of a random product code: the space is rotated, cut into ``blocks`` parts, and
each part has a list of random unit vectors; a direction is one choice from each list, so ``size ** blocks``
directions need ``size * blocks`` vectors only. A vector falls under every direction whose inner product with it is
``height`` or more. List decoding finds these without trying all directions: partial sums over the parts go on only while the
best rest can still reach the height. Two vectors are compared where they share a direction. Code words of one product code
share parts, so a pair that is unlucky with one is so with many: ``CODES`` codes with rotations of their own even that out.

``plan_codes`` chooses height and number of directions for the dimension, the cosine and the number of vectors:
caps hold ``PER_CAP`` vectors on average, as long as enough of a linked neighbour's caps are shared, and two vectors
at exactly the least cosine share ``SHARED`` directions on average. Nothing in it depends on what the vectors are. A pair
that shares none is missed; closer pairs share more. README has measured recall.

Equal vectors are one class with a number of copies. A direction's vectors are compared in blocks of ``BLOCK`` against each other, each
pair of blocks in a task's turn, so a direction under which very many vectors fall is spread over the cluster.
A linked pair counts only under the first direction both share. A block hands on, for each linked vector, how many
copies it links to and the smallest class it is joined with there: at most a row for each vector, never the pairs.

Vectors that are null, empty, zero, or hold a null or non-finite component link with nothing, each being a row of its own
with its own id. Vectors of different lengths do not link. Repeated rows and rows that share an id are vectors of their own: they
link if their vectors do. Null ids are no smallest id; a group without any other has a null ``component_id``, and its
null rows are kept. An empty table gives no rows. Columns besides ``vec_id`` and ``embedding`` are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from splitmetrics.llm.graph import connected_components
from splitmetrics.llm.rows import importable
from splitmetrics.sources.workspace import stage

LEAST_COSINE = 0.9
#: Directions that two vectors at exactly the least cosine share on average.
SHARED = 16.0
CODES = 8
#: Vectors that a cap holds on average, as long as a neighbour shares at least this part of its caps.
PER_CAP = 64.0
LEAST_OVERLAP = 0.2
#: Vectors of one direction that are compared with as many others at once.
BLOCK = 512
SEED = 20

_ROWS = 2048
#: A cosine this near to the least one is computed anew with exact sums.
_NEAR = 1e-9


def usable(vector: Column) -> Column:
    """Whether a vector can link at all."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def classes_of(embeddings: DataFrame) -> DataFrame:
    """Every distinct usable vector once: node (a number of its own), vector, least id and copies."""
    found = embeddings.where(usable(F.col("embedding"))).groupBy(F.col("embedding").alias("vector"))
    found = found.agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"))
    return found.withColumn("node", F.monotonically_increasing_id())


# --- the code -----------------------------------------------------------------------------------


def _sphere(dimension: int):
    """Angles and their cumulative shares: how a uniform unit vector lies to a fixed one."""
    angle = np.linspace(0, np.pi, 40_001)
    density = np.sin(angle) ** (dimension - 2)
    total = np.concatenate([[0], np.cumsum((density[1:] + density[:-1]) / 2)])
    return angle, total / total[-1]


def _beyond(dimension: int, cosine: np.ndarray) -> np.ndarray:
    """Share of the sphere with at least this cosine to a fixed direction."""
    if dimension == 1:
        return np.where(cosine <= -1, 1.0, np.where(cosine <= 1, 0.5, 0.0))
    angle, share = _sphere(dimension)
    return np.where(cosine > 1, 0.0, np.interp(np.arccos(np.clip(cosine, -1, 1)), angle, share))


def cap_shares(dimension: int, height: float, cosine: float) -> tuple[float, float]:
    """Shares of directions that reach the height with one vector, and with both of two at that cosine."""
    if dimension == 1:
        return 0.5, 0.5
    angle, share = _sphere(dimension)
    inside = angle <= math.acos(height)
    weight = np.diff(share, prepend=0)[inside]
    along, across = cosine * np.cos(angle[inside]), math.sqrt(1 - cosine**2) * np.sin(angle[inside])
    with np.errstate(divide="ignore", invalid="ignore"):
        needed = np.where(across > 1e-12, (height - along) / across, np.where(along >= height, -2.0, 2.0))
    single = float(weight.sum())
    return single, float((weight * _beyond(dimension - 1, needed)).sum())


@dataclass(frozen=True)
class Code:
    """A product code for one dimension: ``size ** blocks`` directions, numbered from ``first``."""

    dimension: int
    height: float
    size: int
    blocks: int
    seed: int
    first: int = 0

    @property
    def directions(self) -> int:
        return self.size**self.blocks

    def parts(self) -> tuple[np.ndarray, list[np.ndarray]]:
        return _parts(self.dimension, self.size, self.blocks, self.seed)


@cache
def _parts(dimension: int, size: int, blocks: int, seed: int) -> tuple[np.ndarray, list[np.ndarray]]:
    draw = np.random.default_rng([seed, dimension, size, blocks])
    if dimension == 1:
        return np.ones((1, 1)), [np.array([[1.0], [-1.0]])]
    rotation = np.linalg.qr(draw.standard_normal((dimension, dimension)))[0]
    words = []
    for columns in np.array_split(np.arange(dimension), blocks):
        part = draw.standard_normal((size, len(columns)))
        words.append(part / np.linalg.norm(part, axis=1, keepdims=True) / math.sqrt(blocks))
    return rotation, words


def plan_codes(
    dimension: int,
    vectors: int,
    cosine: float = LEAST_COSINE,
    shared: float = SHARED,
    codes: int = CODES,
    seed: int = SEED,
) -> list[Code]:
    """The codes for so many vectors of a dimension."""
    if dimension == 1:
        return [Code(1, 0.5, 2, 1, seed)]
    low, high = 0.0, 0.999
    for _ in range(40):
        height = (low + high) / 2
        single, both = cap_shares(dimension, height, cosine)
        if vectors * single > PER_CAP and both > LEAST_OVERLAP * single:
            low = height
        else:
            high = height
    both = cap_shares(dimension, low, cosine)[1]
    blocks = 2 if dimension >= 16 else 1
    size = math.ceil((shared / codes / both) ** (1 / blocks))
    return [Code(dimension, low, size, blocks, seed + k, k * size**blocks) for k in range(codes)]


def decode(unit: np.ndarray, codes: list[Code]) -> tuple[np.ndarray, np.ndarray]:
    """Rows and directions of all inner products that reach the height, in order of row, then direction."""
    found = [_decode(unit, code) for code in codes]
    row, word = (np.concatenate(side) for side in zip(*found, strict=True))
    order = np.lexsort((word, row))
    return row[order], word[order]


def _decode(unit: np.ndarray, code: Code) -> tuple[np.ndarray, np.ndarray]:
    rotation, words = code.parts()
    turned = unit @ rotation
    scores = []
    for part, columns in zip(words, np.array_split(np.arange(code.dimension), code.blocks), strict=True):
        scores.append(turned[:, columns] @ part.T)
    best = np.stack([s.max(axis=1) for s in scores])
    rest = best[::-1].cumsum(axis=0)[::-1]
    count = len(unit)
    row, word, total = np.arange(count), np.zeros(count, np.int64), np.zeros(count)
    for k, score in enumerate(scores):
        after = rest[k + 1] if k + 1 < len(scores) else np.zeros(count)
        # Of each row, the words that can reach the height with the best of all other parts.
        able = score >= (code.height - (rest[0] - best[k]))[:, None]
        lengths = able.sum(axis=1)
        choices, starts = np.nonzero(able)[1], np.cumsum(lengths) - lengths
        reach = lengths[row]
        taken = np.repeat(np.arange(len(row)), reach)
        place = np.arange(len(taken)) - np.repeat(np.cumsum(reach) - reach, reach)
        chosen = choices[starts[row[taken]] + place]
        sums = total[taken] + score[row[taken], chosen]
        kept = sums + after[row[taken]] >= code.height
        row, word, total = row[taken][kept], word[taken][kept] * score.shape[1] + chosen[kept], sums[kept]
    return row, code.first + word


def units(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


# --- Spark --------------------------------------------------------------------------------------


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dimension)


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, _ROWS):
        yield batch.slice(at, _ROWS)


def decoded(classes: DataFrame, codes: dict[int, list[Code]]) -> DataFrame:
    """node and the ascending ``directions`` of every class."""
    importable(classes.sparkSession)
    fields = StructType.fromDDL("node long, directions array<long>")
    schema = to_arrow_schema(fields)

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (piece for whole in source for piece in _slices(whole)):
            nodes, vectors = batch.column(0), batch.column(1)
            dimensions = vectors.value_lengths().to_numpy(zero_copy_only=False)
            for dimension in np.unique(dimensions):
                chosen = pa.array(np.flatnonzero(dimensions == dimension))
                matrix = _matrix(vectors.take(chosen), int(dimension))
                row, word = decode(units(matrix), codes[int(dimension)])
                offsets = np.searchsorted(row, np.arange(len(chosen) + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(word)).cast(schema.field(1).type)
                yield pa.RecordBatch.from_arrays([nodes.take(chosen), lists], schema=schema)

    return classes.select("node", "vector").mapInArrow(batches, fields)


def _in_blocks(classes: DataFrame, found: DataFrame, block: int) -> DataFrame:
    """Every class once for each pair of blocks that it is compared in.

    Directions with one vector are dropped by a join of keys alone; vectors are moved twice, once to
    their directions and once to the pairs of blocks.
    """
    size = F.size("vector")
    listed = stage(classes.join(found, "node").select("node", size.alias("dimension"), "directions"), "directions")
    entries = listed.select("node", "dimension", F.explode("directions").alias("direction"))
    sizes = entries.groupBy("dimension", "direction").agg(F.count("*").alias("members")).where("members > 1")
    sizes = stage(sizes, "direction_sizes")
    met = entries.join(sizes, ["dimension", "direction"])
    met = met.groupBy("node").agg(F.array_sort(F.collect_list(F.struct("direction", "members"))).alias("met"))
    placed = classes.join(stage(met, "shared_directions"), "node").select(
        "node", "copies", "vector", "met", F.explode("met").alias("here")
    )
    direction = F.col("here.direction")
    parts = F.ceil(F.col("here.members") / block).cast("int")
    own = F.pmod(F.xxhash64("node", direction), parts).cast("int")
    earlier = F.transform(F.filter("met", lambda m: m["direction"] < direction), lambda m: m["direction"])
    spread = placed.select(
        size.alias("dimension"),
        direction.alias("direction"),
        "node",
        "copies",
        "vector",
        earlier.alias("earlier"),
        own.alias("own"),
        F.explode(F.sequence(F.lit(0), parts - 1)).alias("other"),
    )
    low, high = F.least("own", "other"), F.greatest("own", "other")
    return spread.select(
        "dimension", "direction", low.alias("low"), high.alias("high"), "own", "node", "copies", "vector", "earlier"
    )


def _exactly(x: np.ndarray, y: np.ndarray) -> float:
    x, y = x / np.abs(x).max(), y / np.abs(y).max()
    return math.fsum(x * y) / math.sqrt(math.fsum(x * x) * math.fsum(y * y))


def _linked(vectors: np.ndarray, unit: np.ndarray, own: np.ndarray, crossed: bool, cosine: float):
    """Row numbers of the linked pairs; in a ``crossed`` pair of blocks rows meet those of the other block only."""
    found = unit @ unit.T
    wanted = np.triu(found >= cosine - _NEAR, 1)
    if crossed:
        wanted &= own[:, None] != own
    left, right = np.nonzero(wanted)
    sure = found[left, right] >= cosine + _NEAR
    for k in np.flatnonzero(~sure):
        sure[k] = _exactly(vectors[left[k]], vectors[right[k]]) >= cosine
    return left[sure], right[sure]


def _share(earlier: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Whether the two of each pair share an earlier direction; rows are padded with -1 and -2."""
    result = np.zeros(len(left), bool)
    step = max(1, (1 << 22) // max(1, earlier.shape[1] ** 2))
    for at in range(0, len(left), step):
        a, b = earlier[left[at : at + step]], earlier[right[at : at + step]]
        result[at : at + step] = ((a[:, :, None] == b[:, None, :]) & (a >= 0)[:, :, None]).any(axis=(1, 2))
    return result


def _joined(count: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For every row the smallest row that it is joined with by the pairs."""
    label = np.arange(count)
    while True:
        least = np.minimum(label[left], label[right])
        after = label.copy()
        np.minimum.at(after, left, least)
        np.minimum.at(after, right, least)
        np.minimum.at(after, label[left], least)
        np.minimum.at(after, label[right], least)
        after = after[after]
        if (after == label).all():
            return label
        label = after


def compare(batch: pa.RecordBatch, dimension: int, starts: np.ndarray, cosine: float) -> tuple[np.ndarray, ...]:
    """Of rows in blocks that begin at ``starts``: those that link, with how many copies, and the first row joined."""
    low, high, own, copies = (batch.column(name).to_numpy(zero_copy_only=False) for name in ("low", "high", "own", "copies"))
    vectors = _matrix(batch.column("vector"), dimension)
    unit = units(vectors)
    lists = batch.column("earlier")
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
    earlier = np.full((len(own), max(1, int(lengths.max(initial=0)))), -1, np.int64)
    earlier[np.arange(earlier.shape[1]) < lengths[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    links, label = np.zeros(len(own), np.int64), np.arange(len(own))
    for first, past in zip(starts, [*starts[1:], len(own)], strict=True):
        run = slice(first, past)
        left, right = _linked(vectors[run], unit[run], own[run], low[first] != high[first], cosine)
        if len(left):
            anew = ~_share(earlier[run], left, right)
            left, right = left[anew], right[anew]
            links[run] += np.bincount(left, copies[run][right], past - first).astype(np.int64)
            links[run] += np.bincount(right, copies[run][left], past - first).astype(np.int64)
            label[run] = first + _joined(past - first, left, right)
    rows = np.flatnonzero(links)
    return rows, links[rows], label[rows]


def _links(blocks: DataFrame, cosine: float) -> DataFrame:
    """node, links, joined: of every row with a link in its block."""
    fields = StructType.fromDDL("node long, links long, joined long")
    schema = to_arrow_schema(fields)
    keys = ["dimension", "direction", "low", "high"]
    ordered = blocks.repartition(*keys).sortWithinPartitions(*keys)

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for whole in source:
            for piece in _slices(whole):
                held = pa.concat_batches([held, piece]) if held is not None else piece
                key = np.stack([held.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in keys])
                begins = np.append(0, np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1)
                if begins[-1]:
                    yield from done(held.slice(0, begins[-1]), key[0, : begins[-1]], begins[:-1])
                held = held.slice(begins[-1])
        if held is not None and held.num_rows:
            yield from done(held, held.column("dimension").to_numpy().astype(np.int64), np.zeros(1, np.int64))

    def done(batch: pa.RecordBatch, dimensions: np.ndarray, begins: np.ndarray) -> Iterator[pa.RecordBatch]:
        for dimension in np.unique(dimensions):
            first, past = np.searchsorted(dimensions, [dimension, dimension + 1])
            part = batch.slice(first, past - first)
            own = begins[(begins >= first) & (begins < past)] - first
            rows, links, label = compare(part, int(dimension), own, cosine)
            nodes = part.column("node").to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(nodes[rows]), pa.array(links), pa.array(nodes[label])], schema=schema)

    importable(blocks.sparkSession)
    return ordered.mapInArrow(batches, fields)


def near_vectors(embeddings: DataFrame, cosine: float = LEAST_COSINE, shared: float = SHARED, block: int = BLOCK) -> DataFrame:
    """Every row's vec_id, n_links, component_id, and kept: whether it is the first of its component."""
    source = embeddings.select("vec_id", "embedding")
    classes = stage(classes_of(source), "vector_classes")
    by_dimension = classes.groupBy(F.size("vector").alias("d")).agg(F.count("*").alias("n")).collect()
    codes = {r["d"]: plan_codes(r["d"], r["n"], cosine, shared) for r in by_dimension}
    found = stage(_links(_in_blocks(classes, decoded(classes, codes), block), cosine), "links")
    per_class = _components(classes, found)
    fits = usable(F.col("embedding"))
    linked = source.where(fits).join(per_class.withColumnRenamed("vector", "embedding"), "embedding")
    alone = source.where(~fits).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    result = linked.select("vec_id", "n_links", "component_id").union(alone)
    return result.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _components(classes: DataFrame, found: DataFrame) -> DataFrame:
    """vector, n_links and component_id of every class, staged."""
    links = stage(found.groupBy("node").agg(F.sum("links").alias("links")), "link_counts")
    below = connected_components(found.selectExpr("node as a", "joined as b"))
    tops = below.select(F.col("root").alias("node")).distinct().select("node", F.col("node").alias("root"))
    members = stage(below.union(tops), "members")
    sharing = stage(members.join(classes.select("node", "least"), "node"), "member_ids")
    first = stage(sharing.groupBy("root").agg(F.min("least").alias("component_id")), "component_ids")
    named = stage(members.join(first, "root").select("node", "component_id"), "named")
    together = classes.join(links, "node", "left").join(named, "node", "left")
    joined = F.when(F.col("links").isNull(), F.col("least")).otherwise(F.col("component_id"))
    return stage(
        together.select(
            "vector", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), joined.alias("component_id")
        ),
        "class_results",
    )
