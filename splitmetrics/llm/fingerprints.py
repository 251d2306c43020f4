"""Document fingerprints: invertible Bloom lookup sketches of paragraphs. DataFrame and SQL functions only.

A text's paragraphs are its lines with a character other than white space; equal ones count once. Each paragraph's 64-bit digest goes
to one cell in each of three blocks of ``CELLS`` cells. A cell has the number of its digests, their exclusive or, and that of their check
values. Subtracting the cells of two versions cancels what they share. What is left is peeled: a
cell with one digest, which its check value confirms, gives that digest away, and it is taken from its other
cells, until nothing is left. The digests of either version that the other lacks are then known, and with the sizes so is the
Jaccard likeness.

If something is left over, the difference is too large for the sketch, and the pair is tried again with
four times the cells: the digests are split by four (16, 64, ...) values of their lowest bits into
sketches of the first size, with other cell positions. So no sketch, and no step of peeling, grows with a document; a level's
work is linear in the paragraphs of the pairs that are left.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from splitmetrics.llm.rows import tag
from splitmetrics.sources.workspace import stage

#: Cells of each of the three blocks of a sketch.
CELLS = 12
#: Ranges of doc_id for each shuffle partition, so that partitions come out alike.
_RANGES_PER_PARTITION = 16
#: What a text is compared with, and the column with its digests.
_KINDS = {"edited": "changed", "next": "following"}
_EMPTY = "named_struct('n', 0, 'key', 0L, 'chk', 0)"


def _let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def paragraphs(text: str) -> str:
    """The digests of the paragraphs of a text expression, each once."""
    full = f"filter(split({text}, '\\n'), p -> p rlike '[^\\\\x20\\\\x09-\\\\x0D]')"
    return f"array_distinct(transform({full}, p -> xxhash64(p)))"


def _places(digest: str, level: int) -> list[str]:
    return [
        f"cast({k * CELLS} + pmod(xxhash64({digest}, {3 * level + k}), {CELLS}L) as int)" for k in range(3)
    ]


def _check(digest: str) -> str:
    return f"hash({digest}, 77)"


def sketch(digests: str, level: int = 0) -> str:
    """The cells of an array of digests."""
    a, b, c = _places("d", level)
    items = f"transform({digests}, d -> named_struct('d', d, 'a', {a}, 'b', {b}, 'c', {c}, 'chk', {_check('d')}))"
    added = "named_struct('n', t.n + 1, 'key', t.key ^ x.d, 'chk', t.chk ^ x.chk)"
    cell = f"aggregate(items, {_EMPTY}, (t, x) -> if(x.a = j or x.b = j or x.c = j, {added}, t))"
    return _let("items", items, f"transform(sequence(0, {3 * CELLS - 1}), j -> {cell})")


def peeled(left: str, right: str, level: int = 0) -> str:
    """What differs between two sketches: a struct of ok, only_left and only_right.

    ``ok`` says that all differing digests were recovered; the other two are their numbers.
    """
    less = "named_struct('n', x.n - y.n, 'key', x.key ^ y.key, 'chk', x.chk ^ y.chk)"
    start = f"named_struct('cells', zip_with({left}, {right}, (x, y) -> {less}), 'l', 0, 'r', 0, 'over', false)"
    pure = f"cast(array_position(transform(s.cells, c -> abs(c.n) = 1 and c.chk = {_check('c.key')}), true) as int)"
    stop = "named_struct('cells', s.cells, 'l', s.l, 'r', s.r, 'over', true)"
    a, b, c = _places("one.key", level)
    taken = "named_struct('n', c.n - one.n, 'key', c.key ^ one.key, 'chk', c.chk ^ one.chk)"
    cells = _let(
        "at", f"array({a}, {b}, {c})", f"transform(s.cells, (c, k) -> if(array_contains(at, k), {taken}, c))"
    )
    moved = f"named_struct('cells', {cells}, 'l', s.l + if(one.n = 1, 1, 0), 'r', s.r + if(one.n = 1, 0, 1), 'over', false)"
    step = f"if(s.over, s, {_let('p', pure, f'if(p = 0, {stop}, {_let("one", "s.cells[p - 1]", moved)})')})"
    clear = "forall(s.cells, c -> c.n = 0 and c.key = 0 and c.chk = 0)"
    result = f"named_struct('ok', {clear}, 'only_left', s.l, 'only_right', s.r)"
    return f"aggregate(sequence(0, {3 * CELLS}), {start}, (s, i) -> {step}, s -> {result})"


def likeness(left: str, right: str, only_left: str, only_right: str) -> str:
    """Jaccard: what both have of what either has, from the sizes and the differences; 1 if both are empty."""
    either = f"(size({left}) + {only_right})"
    return f"if({either} = 0, 1D, cast(size({left}) - {only_left} as double) / {either})"


def _printed(cells: str) -> str:
    cell = "concat(lpad(hex(c.n), 8, '0'), lpad(hex(c.key), 16, '0'), right(lpad(hex(c.chk), 16, '0'), 8))"
    return f"lower(array_join(transform({cells}, c -> {cell}), ''))"


def _ranged(documents: DataFrame) -> DataFrame:
    """Every row in a range of doc_id, and the first document of each range in the one before as well.

    The ranges' first documents, no more than 16 for each shuffle partition, are all that is broadcast and collected.
    """
    rows = documents.select("doc_id", tag(F.col("text")).alias("tag"), F.coalesce("text", F.lit("")).alias("text"))
    keys = stage(rows.select("doc_id", "tag"), "document_keys")
    spread = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    count = max(1, int(_RANGES_PER_PARTITION * spread))
    parts = keys.select("doc_id").repartitionByRange(count, "doc_id")
    lows = parts.groupBy(F.spark_partition_id().alias("p")).agg(F.min("doc_id").alias("low"))
    cuts = sorted({float(row["low"]) for row in lows.where("low is not null").collect()})
    splits = [float("-inf"), *(cuts[1:] or cuts or [0.0]), float("inf")]
    ranges = Bucketizer(splits=splits, inputCol="id", outputCol="range", handleInvalid="keep")

    def placed(frame: DataFrame) -> DataFrame:
        return ranges.transform(frame.withColumn("id", F.coalesce(F.col("doc_id").cast("double"), F.lit(float("nan"))))).drop("id")

    first = placed(keys).groupBy("range").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "tag")).alias("first")
    )
    found = sorted((row["range"], row["first"]) for row in first.collect())
    into = [
        (f["doc_id"], f["tag"], found[k - 1][0]) for k, (_, f) in enumerate(found)
    ]
    ahead = documents.sparkSession.createDataFrame(into, "doc_id long, tag long, into double")
    # A row for each range: without the hint their size is unknown, and all texts would be shuffled to meet them.
    following = rows.alias("l").join(
        F.broadcast(ahead).alias("r"), F.col("l.doc_id").eqNullSafe(F.col("r.doc_id")) & (F.col("l.tag") == F.col("r.tag"))
    )
    following = following.select("l.doc_id", "l.tag", "l.text", F.col("r.into").alias("range"), F.lit(True).alias("ahead"))
    return placed(rows).withColumn("ahead", F.lit(False)).unionByName(following)


def edited_versions(documents: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, and the digests of the text, the edited text and the next text.

    Edited: the last half of the code points, rounded down, replaced by the first as many (or all) of the next
    document in ascending order of doc_id (nulls last), then of the text's checksum; after the last comes the first. Equal rows
    are one document. A null text is an empty one.
    """
    rows = _ranged(documents).withColumn("digests", F.expr(paragraphs("text")))
    over = "over (partition by range order by ahead, doc_id nulls last, tag)"
    key = "struct(ahead, doc_id, tag)"
    rows = rows.withColumn("begins", F.expr(f"not (lag({key}) {over} <=> {key})"))
    rows = rows.withColumn(
        "next", F.expr(f"lead(if(begins, struct(text, digests), null)) ignore nulls {over}")
    ).where("not ahead")
    half = rows.withColumn("n_chars", F.char_length("text").cast("long")).withColumn(
        "edited",
        F.expr("concat(left(text, cast(n_chars - n_chars div 2 as int)), left(next.text, cast(n_chars div 2 as int)))"),
    )
    return half.select(
        "doc_id",
        "n_chars",
        F.sha2(F.encode("edited", "utf-8"), 256).alias("edited_sha256"),
        F.col("digests").alias("own"),
        F.expr(paragraphs("edited")).alias("changed"),
        F.col("next.digests").alias("following"),
    )


def _retried(pairs: DataFrame, level: int) -> DataFrame:
    """row, kind, own, other and ``found`` for pairs, with ``4 ** level`` sketches for each."""
    split = (4**level) - 1
    sides = pairs.select("row", "kind", F.explode("own").alias("d"), F.lit(True).alias("mine")).union(
        pairs.select("row", "kind", F.explode("other").alias("d"), F.lit(False).alias("mine"))
    )
    # Peeling is much work on few bytes, so the number of tasks must not follow from the bytes.
    spread = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sides = sides.withColumn("part", F.expr(f"xxhash64(d, -1) & {split}L"))
    parts = sides.repartition(spread, "row", "kind", "part").groupBy("row", "kind", "part").agg(
        F.expr("collect_list(if(mine, d, null))").alias("l"), F.expr("collect_list(if(mine, null, d))").alias("r")
    )
    cells = parts.select("row", "kind", F.expr(sketch("l", level)).alias("l"), F.expr(sketch("r", level)).alias("r"))
    found = cells.select("row", "kind", F.expr(peeled("l", "r", level)).alias("found"))
    return found.groupBy("row", "kind").agg(
        F.struct(
            F.bool_and("found.ok").alias("ok"),
            F.sum("found.only_left").cast("int").alias("only_left"),
            F.sum("found.only_right").cast("int").alias("only_right"),
        ).alias("found")
    )


def fingerprint_versions(documents: DataFrame, most_levels: int = 16) -> DataFrame:
    """The fingerprints of every text and its edited text, and the likenesses.

    Columns: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next. A fingerprint is
    the first sketch's cells in hexadecimal; it depends on the text alone. An empty table gives an empty result.
    """
    # Fingerprints are long, so they are printed at the very end and never shuffled or staged.
    first = stage(
        edited_versions(documents)
        .withColumns({f"{c}_cells": F.expr(sketch(c)) for c in ("own", "changed", "following")})
        .select(
            F.monotonically_increasing_id().alias("row"),
            *("doc_id", "n_chars", "edited_sha256", "own", "changed", "following"),
            F.expr(peeled("own_cells", "changed_cells")).alias("edited"),
            F.expr(peeled("own_cells", "following_cells")).alias("next"),
        ),
        "sketches",
    )
    pairs = F.array(
        *[
            F.struct(
                F.lit(kind).alias("kind"),
                F.col("own").alias("own"),
                F.col(other).alias("other"),
                F.col(f"{kind}.ok").alias("ok"),
            )
            for kind, other in _KINDS.items()
        ]
    )
    failed = first.select("row", F.explode(pairs).alias("pair")).select("row", "pair.*")
    pending, solved = stage(failed.where("not ok").drop("ok"), "pairs"), []
    for level in range(1, most_levels + 1):
        if pending.isEmpty():
            break
        tried = stage(_retried(pending, level), "retried")
        solved.append(tried.where("found.ok"))
        again = tried.where("not found.ok").select("row", "kind")
        pending = stage(pending.join(again, ["row", "kind"], "left_semi"), "pairs")
    else:
        raise RuntimeError(f"differences remain after {most_levels} enlargements")
    found = first
    if solved:
        late = reduce(DataFrame.union, solved).groupBy("row")
        late = late.agg(
            *[F.max(F.when(F.col("kind") == kind, F.col("found"))).alias(f"{kind}_late") for kind in _KINDS]
        )
        found = found.join(late, "row", "left").withColumns(
            {kind: F.coalesce(F.col(f"{kind}_late"), F.col(kind)) for kind in _KINDS}
        )
    likely = {
        f"near_{kind}": F.expr(likeness("own", other, f"{kind}.only_left", f"{kind}.only_right"))
        for kind, other in _KINDS.items()
    }
    return found.withColumns(likely).select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        F.expr(_let("cells", sketch("own"), _printed("cells"))).alias("fingerprint"),
        F.expr(_let("cells", sketch("changed"), _printed("cells"))).alias("edited_fingerprint"),
        *likely,
    )
