"""Line deduplication by pairwise alignment of overlapping documents.

Documents whose lines are the same throughout form a class, of which only the first takes part in
what follows. Rare lines, those of at most ``rare`` classes, lead every later document that has one to the
earliest document that has it and to the one just before it. Where more documents share a line, that line alone says little: there
a run of lines that may be deleted (``min_lines`` of them, or fewer with a long one) leads to the earliest document
that has the run. Pairs are about as many as lines, never all pairs of a group.

Each pair is aligned by patience diff: equal lines at both ends first, then lines that occur once in either document and lie in
the same order in both (a longest increasing subsequence) are anchors, and between anchors the same is done anew. A stretch
without such a line is aligned by a longest common subsequence in linear space. Lines that follow each other on both sides of the
alignment are a block; blocks of at least ``min_lines`` lines, or with a line of ``min_words`` words, are deleted from the later
document. Lines that are left and repeat a deleted one (a header that is a footer as well) are aligned with the same partner
again until no block is found. Blocks that stand in another order do not align, so one of two swapped blocks stays.

A run that a document keeps, since it did not align with the earliest holder, is tried with the earliest of the documents that
kept it as well, and so on until no run that two documents keep has an untried partner. The earliest copy of a line never goes.

Lines are split at "\\n" and compared without outer white space; lines without a character count for nothing. Lines are
compared by 96 bits and whole documents by 128 bits of their digests.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from splitmetrics.llm.rows import map_rows, tag, with_rows
from splitmetrics.sources.workspace import stage


def aligned(
    later: Sequence[int], earlier: Sequence[int], least: int = 2, long: Sequence[bool] | None = None
) -> list[int]:
    """Places in ``later`` of the blocks that align with ``earlier``, in order.

    A block has ``least`` lines or a line that is ``long``; without ``long`` each line counts as such.
    """
    long = [True] * len(later) if long is None else long
    gone: set[int] = set()
    left = list(range(len(later)))
    while left:
        pairs = matches([later[k] for k in left], earlier)
        found = [k for block in _blocks(pairs, left) if len(block) >= least or any(long[k] for k in block) for k in block]
        if not found:
            break
        gone.update(found)
        repeated = {later[k] for k in gone}
        left = [k for k in range(len(later)) if k not in gone and later[k] in repeated]
    return sorted(gone)


def _blocks(pairs: list[tuple[int, int]], places: list[int]) -> list[list[int]]:
    """The places of matched lines that follow each other on both sides."""
    blocks: list[list[int]] = []
    before = None
    for i, j in pairs:
        if before is not None and (places[i], j) == (before[0] + 1, before[1] + 1):
            blocks[-1].append(places[i])
        else:
            blocks.append([places[i]])
        before = places[i], j
    return blocks


def matches(later: Sequence[int], earlier: Sequence[int]) -> list[tuple[int, int]]:
    """Pairs of equal lines, increasing on both sides, by patience diff."""
    found: list[tuple[int, int]] = []
    ranges = [(0, len(later), 0, len(earlier))]
    while ranges:
        i, to_i, j, to_j = ranges.pop()
        while i < to_i and j < to_j and later[i] == earlier[j]:
            found.append((i, j))
            i, j = i + 1, j + 1
        while i < to_i and j < to_j and later[to_i - 1] == earlier[to_j - 1]:
            to_i, to_j = to_i - 1, to_j - 1
            found.append((to_i, to_j))
        if i == to_i or j == to_j:
            continue
        chain = _anchors(later, earlier, i, to_i, j, to_j)
        if not chain:
            found += _common(later, earlier, i, to_i, j, to_j)
            continue
        found += chain
        for next_i, next_j in [*chain, (to_i, to_j)]:
            ranges.append((i, next_i, j, next_j))
            i, j = next_i + 1, next_j + 1
    return sorted(found)


def _anchors(later, earlier, i: int, to_i: int, j: int, to_j: int) -> list[tuple[int, int]]:
    """Lines that stand once in either range, as many as lie in the same order."""
    once = {h for h, n in Counter(later[i:to_i]).items() if n == 1}
    there = Counter(h for h in earlier[j:to_j] if h in once)
    at = {h: k for k, h in enumerate(earlier[j:to_j], j) if there.get(h) == 1}
    return _increasing([(k, at[h]) for k, h in enumerate(later[i:to_i], i) if h in at])


def _common(later, earlier, i: int, to_i: int, j: int, to_j: int) -> list[tuple[int, int]]:
    """A longest common subsequence of two ranges, by halving, in linear space."""
    shared = set(later[i:to_i]) & set(earlier[j:to_j])
    rows = [k for k in range(i, to_i) if later[k] in shared]
    columns = [k for k in range(j, to_j) if earlier[k] in shared]
    number = {h: k for k, h in enumerate(shared)}
    a = np.array([number[later[k]] for k in rows], np.int32)
    b = np.array([number[earlier[k]] for k in columns], np.int32)
    found, parts = [], [(0, len(a), 0, len(b))]
    while parts:
        top, end, first, past = parts.pop()
        if top == end or first == past:
            continue
        if end - top == 1:
            place = np.flatnonzero(b[first:past] == a[top])
            if len(place):
                found.append((rows[top], columns[first + int(place[0])]))
            continue
        middle = (top + end) // 2
        before = _lengths(a[top:middle], b[first:past])
        after = _lengths(a[middle:end][::-1], b[first:past][::-1])[::-1]
        cut = first + int((before + after).argmax())
        parts += [(top, middle, first, cut), (middle, end, cut, past)]
    return found


def _lengths(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the longest common subsequence of ``a`` and each beginning of ``b``."""
    row = np.zeros(len(b) + 1, np.int32)
    for value in a:
        row[1:] = np.maximum.accumulate(np.maximum(row[1:], np.where(b == value, row[:-1] + 1, 0)))
    return row


def _increasing(anchors: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest subsequence that increases in both parts (the first already does)."""
    tops: list[int] = []
    last: list[int] = []
    before = [-1] * len(anchors)
    for k, (_, j) in enumerate(anchors):
        pile = bisect_left(tops, j)
        before[k] = last[pile - 1] if pile else -1
        tops[pile : pile + 1] = [j]
        last[pile : pile + 1] = [k]
    chain, k = [], last[-1] if last else -1
    while k >= 0:
        chain.append(anchors[k])
        k = before[k]
    return chain[::-1]


def line_sequences(documents: DataFrame) -> DataFrame:
    """doc_id, tag, ``class`` and, for each line with a character, its digests, number and words, in order."""
    text = F.coalesce("text", F.lit(""))
    lines = F.transform(
        F.split(text, "\n"),
        lambda line, k: F.struct(
            F.trim(F.translate(line, "\t\r\x0b\f", "    ")).alias("text"),
            k.cast("int").alias("line"),
            F.regexp_count(line, F.lit("[^\\x20\\x09-\\x0D]+")).cast("int").alias("words"),
        ),
    )
    full = documents.select("doc_id", tag(F.col("text")).alias("tag"), F.filter(lines, lambda x: x["words"] > 0).alias("lines"))
    digests = F.transform(
        "lines",
        lambda x: F.struct(
            F.xxhash64(x["text"]).alias("hash"), (F.crc32(x["text"]) - F.lit(1 << 31)).cast("int").alias("check"), x["line"].alias("line"), x["words"].alias("words")
        ),
    )
    whole = F.md5(F.array_join(F.transform("lines", lambda x: x["text"]), "\n"))
    return full.select("doc_id", "tag", digests.alias("lines"), whole.alias("class"))


_ORDER = ("no_id", "doc_id", "tag")


def _runs(size: int, min_lines: int, min_words: int) -> Column:
    """Keys of the runs of ``size`` lines that may be deleted: with fewer than ``min_lines``, those with a long line.

    Of a document that has lost lines (``gone`` has their places), only runs with a line that is left.
    """
    lines, last = F.col("lines"), F.size("lines") - size
    everywhere = F.filter(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda k: k <= last)
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    around = F.transform(
        left, lambda p: F.filter(F.sequence(F.greatest(p - (size - 1), F.lit(0)), p), lambda k: k <= last)
    )
    starts = F.when(F.col("gone").isNull(), everywhere).otherwise(F.array_distinct(F.flatten(around)))
    if size < min_lines:
        starts = F.filter(starts, lambda k: F.greatest(F.lit(0), *[F.get(lines, k + n)["words"] for n in range(size)]) >= min_words)
    return F.transform(starts, lambda k: F.xxhash64(F.lit(size), *[F.get(lines, k + n)["hash"] for n in range(size)]))


def _kept_runs(sequences: DataFrame, min_lines: int, min_words: int) -> DataFrame:
    """me and key of every run that is not deleted throughout, without repeats."""
    runs = F.concat(*[_runs(size, min_lines, min_words) for size in range(1, min_lines + 1)])
    return sequences.select("me", F.explode(F.array_distinct(runs)).alias("key"))


def _with_first(keys: DataFrame, label: str) -> DataFrame:
    """Keys that several documents have, with the earliest of these.

    The earliest are staged: Spark splits a line that very many documents have only
    in a join of two tables.
    """
    first = keys.groupBy("key").agg(F.min("me").alias("first"), F.count("*").alias("n"))
    return keys.join(stage(first.where("n > 1"), label), "key")


def _by_rare_lines(leading: DataFrame, rare: int) -> DataFrame:
    """Documents that share a rare line: each with the first that has it and with the one before."""
    hashes = F.array_distinct(F.transform("lines", lambda x: x["hash"]))
    shared = _with_first(leading.select("me", F.explode(hashes).alias("key")), "first_lines").where(F.col("n") <= rare)
    # Staged, so that the join alone meets lines that very many documents have.
    shared = stage(shared.select("key", "me", "first"), "rare_lines")
    previous = F.lag("me").over(Window.partitionBy("key").orderBy("me"))
    both = shared.select("me", F.array("first", previous).alias("partners")).select("me", F.explode("partners").alias("first"))
    return both.where("first is not null and me != first").distinct()


def _gone(pairs: DataFrame, leading: DataFrame, min_lines: int, min_words: int) -> DataFrame:
    """me and the places of the lines that align with any partner."""
    whole = F.transform("lines", lambda x: F.struct(x["hash"], x["check"]))
    long_line = F.transform("lines", lambda x: x["words"] >= min_words)
    # Sorted and merged at every size, as lines never fit a broadcast where it matters.
    side = leading.select("me", whole.alias("lines"), long_line.alias("long")).hint("merge")
    other = side.select(F.col("me").alias("first"), F.col("lines").alias("earlier"))
    both = pairs.join(side, "me").join(other.hint("merge"), "first").select("me.*", "lines", "long", "earlier")

    def align(rows: Iterator[tuple]) -> Iterator[tuple]:
        for no_id, doc_id, tag_, lines, long, earlier in rows:
            found = aligned(*([(x["hash"], x["check"]) for x in part] for part in (lines, earlier)), min_lines, long)
            if found:
                yield no_id, doc_id, tag_, found

    found = map_rows(both, align, "no_id boolean, doc_id long, tag long, places array<int>")
    found = found.groupBy(F.struct(*_ORDER).alias("me"))
    return found.agg(F.array_distinct(F.flatten(F.collect_list("places"))).alias("gone"))


def _aligned_places(leading: DataFrame, rare: int, min_words: int, min_lines: int) -> DataFrame:
    """me and ``gone``, the places in ``lines`` that go, after all rounds of partners."""
    keys = _kept_runs(leading.withColumn("gone", F.lit(None).cast("array<int>")), min_lines, min_words)
    open_ = stage(_with_first(keys, "first_runs").select("key", "me", "first"), "shared_runs")
    pairs = open_.where("me != first").select("me", "first").union(_by_rare_lines(leading, rare))
    tried = stage(pairs.distinct(), "partners")
    gone = stage(_gone(tried, leading, min_lines, min_words), "aligned")
    while True:
        # Runs that documents kept though an earlier one has them; their first holder has had its turn.
        waiting = open_.where("me != first").select("key", "me")
        docs = leading.join(waiting.select("me").distinct().hint("merge"), "me", "left_semi")
        docs = docs.join(gone.hint("merge"), "me", "left")
        kept = stage(_kept_runs(docs, min_lines, min_words), "kept_runs")
        open_ = _with_first(waiting.join(kept, ["key", "me"], "left_semi"), "first_kept").select("key", "me", "first")
        open_ = stage(open_, "shared_runs")
        if open_.isEmpty():
            return gone
        pairs = open_.where("me != first").select("me", "first").distinct()
        pairs = stage(pairs.join(tried, ["me", "first"], "left_anti"), "partners")
        if not pairs.isEmpty():
            tried = tried.union(pairs)
            more = gone.union(_gone(pairs, leading, min_lines, min_words)).groupBy("me")
            gone = stage(more.agg(F.array_distinct(F.flatten(F.collect_list("gone"))).alias("gone")), "aligned")


def deleted_lines(
    documents: DataFrame, rare: int = 16, min_words: int = 20, min_lines: int = 2
) -> DataFrame:
    """doc_id, tag and the numbers of the lines to delete, for documents that lose any."""
    found = line_sequences(documents).dropDuplicates(["doc_id", "tag"])
    sequences = stage(
        found.where(F.size("lines") > 0).select(
            F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "tag").alias("me"), "lines", "class"
        ),
        "lines",
    )
    firsts = stage(sequences.groupBy("class").agg(F.min("me").alias("first")), "line_classes")
    classed = sequences.join(firsts, "class").select("me", "lines", (F.col("me") == F.col("first")).alias("leads"))
    classed = stage(classed, "line_sequences")
    leading = classed.where("leads").select("me", "lines")
    places = _aligned_places(leading, rare, min_words, min_lines)

    partly = leading.join(places.hint("merge"), "me").select(
        "me.doc_id", "me.tag", F.array_sort(F.transform("gone", lambda k: F.get("lines", k)["line"])).alias("gone")
    )
    # All of a class but its first is the aligned block of its whole text, by the same rule.
    wholly = classed.where(~F.col("leads")).where(
        (F.size("lines") >= min_lines) | F.exists("lines", lambda x: x["words"] >= min_words)
    )
    return stage(partly.union(wholly.select("me.doc_id", "me.tag", F.transform("lines", lambda x: x["line"]).alias("gone"))), "deleted_lines")


def _without(text, gone):
    """The text without its lines of these numbers; lines are as "\\n" splits them."""

    def rest(lines: Column) -> Column:
        kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
        return F.array_join(F.transform(kept, lambda k: F.get(lines, k)), "\n")

    # The lines are bound to a variable, so that the text is split once.
    cut = F.get(F.transform(F.array(F.split(text, "\n")), rest), 0)
    return F.when(F.size(gone) > 0, cut).otherwise(text)


def drop_repeated_lines(
    documents: DataFrame, rare: int = 16, min_words: int = 20, min_lines: int = 2
) -> DataFrame:
    """The struct ``row`` of every document, its ``cleaned`` text, and ``gone``, the deleted lines' numbers.

    A null text stays null; an empty one stays empty. A document that loses all lines has an empty
    text. Equal rows are one document and keep the same lines. The first of equal documents by doc_id (nulls
    last), then by the text's checksum, keeps everything.
    """
    found = with_rows(documents, deleted_lines(documents, rare, min_words, min_lines).hint("merge"), "left")
    gone = F.coalesce("gone", F.array().cast("array<int>"))
    return found.select("row", gone.alias("gone")).select(
        "row", "gone", _without(F.col("row.text"), F.col("gone")).alias("cleaned")
    )
