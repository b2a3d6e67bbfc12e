"""N-gram Jaccard join: blocked sparse product of the document by n-gram incidence.

A document is the set of its distinct word n-grams, held as sorted 64-bit hashes; exact copies are
one class from the start (equal sets have equal hashes).

1. *Frequency sketch.*  A fixed array of counters orders all n-grams, rare ones first.  Any fixed order
   gives the same links; this one keeps shared passages out of what is filed.
2. *Rare columns.*  By the prefix bound, linked documents of sizes a and b share an n-gram, and as many
   as their sizes force, among the rarest tenth or fifth of each.  Only these are filed.
3. *Overlap counts.*  Pairs are counted over columns of at most ``PAIR_COLUMN`` documents; those that
   cannot reach the bound their sizes set, even with all longer columns and all unfiled n-grams in
   common, are discarded.  Documents that could meet in longer columns alone (large groups of near
   copies) hang together by their least document instead; no pairs are formed there.
4. *Product.*  The documents so connected are cut into row blocks of bounded size.  Each pair of row
   blocks is multiplied column block by column block; rows left without a partner that can still
   reach its size-derived bound are dropped in between.  A spanning forest of the links leaves the task.

Nothing is capped: every linked pair is connected at step 3 and decided exactly at step 4.  What a step
wrote goes as soon as the last step that reads it is written.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vectrace.llm import scan
from vectrace.llm.common import checkpoint, components, release, shuffles_dropped, slices
from vectrace.llm.scan import mix

#: Counters of the frequency sketch, in slices of 65,536; its size never depends on the data.
SKETCH_BITS = 24
#: Columns of up to so many documents are counted pair by pair.
PAIR_COLUMN = 64
#: N-grams filed beyond the prefix bound, so that linked documents share at least one more than this.
EXTRA = 2
#: A row block holds about so many n-grams, a document counting as at least MIN_WEIGHT.
BLOCK_GRAMS = 1 << 18
MIN_WEIGHT = 256
#: Columns multiplied at once.
COLUMNS = 8192


def gram_sets(column: pa.Array, n: int) -> list[np.ndarray]:
    """Each text's distinct n-gram hashes, sorted.

    Words are runs of anything but ASCII white space, A-Z lower-cased.  Fewer than ``n`` words make
    one n-gram, none (as in a null text) make the empty set.
    """
    found = scan.words(column)
    flat = found.hash
    length = max(0, len(flat) - n + 1)
    grams = np.full(length, np.uint64(n))
    for j in range(n):
        grams = mix(grams ^ flat[j : j + length])
    out, at = [], 0
    for size in found.count.tolist():
        if size >= n:
            out.append(np.unique(grams[at : at + size - n + 1]))
        elif size:
            gram = np.array([size], dtype=np.uint64)
            for h in flat[at : at + size]:
                gram = mix(gram ^ h)
            out.append(gram)
        else:
            out.append(flat[:0])
        at += size
    return out


def class_of(grams: np.ndarray) -> bytes:
    """A 128-bit name of the set, the same for equal sets."""
    import xxhash

    return xxhash.xxh3_128_digest(grams.tobytes())


def filed_grams(size: int, percent: int) -> int:
    """How many of its rarest n-grams a set files; 0 where only an equal set could link with it."""
    if (size + size * 100 // percent) * (100 - percent) < 100 + percent:
        return 0
    return min(size, size - -(-percent * size // 100) + 1 + EXTRA)


def rare_grams(grams: np.ndarray, levels: np.ndarray, percent: int) -> np.ndarray:
    """Sort keys (frequency level, then hash) of the n-grams that the set files."""
    count = filed_grams(len(grams), percent)
    keys = (levels[grams >> np.uint64(64 - SKETCH_BITS)].astype(np.uint64) << np.uint64(56)) | (grams >> np.uint64(8))
    return np.sort(keys)[:count]


def links(sets: list[np.ndarray], percent: int, split: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """For each set, the index of the least set in its component of linked sets; and the matrix of all links.

    With ``split``, sets before it are only held against those from it on (they were multiplied among
    themselves elsewhere).
    """
    count = len(sets)
    size = np.array([len(s) for s in sets], dtype=np.int64)
    need = -(-(size[:, None] + size[None, :]) * percent // (100 + percent))
    possible = need <= np.minimum(size[:, None], size[None, :])
    np.fill_diagonal(possible, False)
    if split is not None:
        possible[:split, :split] = possible[split:, split:] = False
    flat = np.concatenate(sets) if count else np.empty(0, dtype=np.uint64)
    owner = np.repeat(np.arange(count), size)
    _, column, seen = np.unique(flat, return_inverse=True, return_counts=True)
    shared = seen[column] > 1
    rank = np.cumsum(seen > 1) - 1
    owner, column = owner[shared], rank[column[shared]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    left = np.bincount(owner, minlength=count)
    overlap = np.zeros((count, count), dtype=np.float32)
    rows = np.arange(count)
    total = int(column[-1]) + 1 if len(column) else 0
    for low in range(0, total, COLUMNS):
        possible[np.ix_(rows, rows)] &= overlap[np.ix_(rows, rows)] + np.minimum(left[rows][:, None], left[rows][None, :]) >= need[np.ix_(rows, rows)]
        rows = rows[possible[np.ix_(rows, rows)].any(axis=1)]
        if not len(rows):
            break
        a, b = np.searchsorted(column, [low, low + COLUMNS])
        place = np.full(count, -1)
        place[rows] = np.arange(len(rows))
        at = place[owner[a:b]]
        dense = np.zeros((len(rows), min(COLUMNS, total - low)), dtype=np.float32)
        dense[at[at >= 0], column[a:b][at >= 0] - low] = 1
        overlap[np.ix_(rows, rows)] += dense @ dense.T
        left -= np.bincount(owner[a:b], minlength=count)
    linked = possible & (overlap >= need)
    label = np.arange(count)
    while True:
        near = np.where(linked, label[None, :], count).min(axis=1, initial=count)
        new = np.minimum(label, near)
        new = new[new]
        if (new == label).all():
            return label, linked
        label = new


def _documents(df: DataFrame, n: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, n_shingles, class_id, mark) per row, and this task's sketch as rows (slice, cells).

    ``mark`` is a hash of the text, by which rows are found again without their n-grams.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(1 << SKETCH_BITS, dtype=np.uint16)
        kind = None
        for part in slices(batches):
            kind, seen = part.column(0).type, {}
            sets = gram_sets(part.column(1), n)
            names = [class_of(s) for s in sets]
            for name, grams in zip(names, sets, strict=True):
                seen[name] = grams
            np.add.at(cells, np.concatenate(list(seen.values())) >> np.uint64(64 - SKETCH_BITS), 1)
            none = [None] * len(sets)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(names, pa.binary()), part.column(2), pa.array(none, pa.int32()), pa.array(none, pa.binary())],
                ["doc_id", "n_shingles", "class_id", "mark", "slice", "cells"],
            )
        if kind is not None:
            packed = [zlib.compress(c.tobytes(), 1) for c in cells.reshape(-1, 1 << 16)]
            none = [None] * len(packed)
            yield pa.RecordBatch.from_arrays(
                [pa.array(none, kind), pa.array(none, pa.int64()), pa.array(none, pa.binary()), pa.array(none, pa.int64()), pa.array(range(len(packed)), pa.int32()), pa.array(packed, pa.binary())],
                ["doc_id", "n_shingles", "class_id", "mark", "slice", "cells"],
            )

    schema = f"doc_id {dict(df.dtypes)[id_col]}, n_shingles long, class_id binary, mark long, slice int, cells binary"
    return df.select(id_col, text_col, F.xxhash64(text_col)).mapInArrow(run, schema)


def _levels(sketches: DataFrame) -> np.ndarray:
    """The summed sketch as one byte per counter, four steps to the doubling: 16 MB, whatever the input."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in slices(batches, 64):
            for at, cells in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                part = np.frombuffer(zlib.decompress(cells), dtype=np.uint16)
                total[at] = total.get(at, 0) + part.astype(np.int64)
        packed = [np.rint(4 * np.log2(1.0 + c)).astype(np.uint8).tobytes() for c in total.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(packed, pa.binary())], ["slice", "levels"])

    with shuffles_dropped(sketches.sparkSession):
        summed = sketches.repartition(32, "slice").mapInArrow(run, "slice int, levels binary").collect()
    levels = np.zeros((1 << SKETCH_BITS >> 16, 1 << 16), dtype=np.uint8)
    for row in summed:
        levels[row["slice"]] = np.frombuffer(row["levels"], dtype=np.uint8)
    return levels.ravel()


def _filed(df: DataFrame, n: int, percent: int, levels: np.ndarray, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, n, grams): what each document files, for one row of each class in a slice."""
    shared = df.sparkSession.sparkContext.broadcast(levels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            ids, filed, seen = part.column(0).to_pylist(), [], set()
            keep, sizes = [], []
            for i, grams in enumerate(gram_sets(part.column(1), n)):
                if ids[i] is None or not filed_grams(len(grams), percent) or (name := class_of(grams)) in seen:
                    continue
                seen.add(name)
                keep.append(i)
                sizes.append(len(grams))
                filed.append(rare_grams(grams, shared.value, percent).view(np.int64))
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate(([0], np.cumsum([len(f) for f in filed]))), pa.int32()),
                pa.array(np.concatenate(filed) if filed else np.empty(0, dtype=np.int64), pa.int64()),
            )
            yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(keep, pa.int64())), pa.array(sizes, pa.int64()), lists], ["doc_id", "n", "grams"])

    return df.select(id_col, text_col).mapInArrow(run, f"doc_id {dict(df.dtypes)[id_col]}, n long, grams array<long>")


def _unfiled(n: Column, percent: int) -> Column:
    return n - F.least(n, n - F.ceil(n * percent / F.lit(100)) + 1 + EXTRA)


def _candidates(lists: DataFrame, percent: int) -> DataFrame:
    """Edges (a, b) that connect every linked pair of different sets, by steps 2 and 3 of the method; a checkpoint.

    An edge from an id to itself stands for several texts under that id.

    Column lengths are counted map-side first and written before they are joined back, so that a
    column of a third of all documents is split over tasks.
    """
    lists = checkpoint(lists)
    filed = lists.select("doc_id", "n", F.explode("grams").alias("gram"))
    lengths = checkpoint(filed.groupBy("gram").agg(F.count("*").alias("c")).filter("c > 1"))
    shared = checkpoint(filed.join(lengths, "gram"))
    release(lists, lengths)
    short = shared.filter(F.col("c") <= PAIR_COLUMN)
    long = shared.filter(F.col("c") > PAIR_COLUMN)
    hidden = long.groupBy("doc_id", "n").agg(F.count("*").alias("s"))
    columns = short.groupBy("gram").agg(F.array_sort(F.collect_list(F.struct("doc_id", "n"))).alias("d"))
    both = columns.select(F.explode(F.flatten(F.transform("d", lambda x, i: F.transform(
        F.filter(F.slice("d", i + 2, PAIR_COLUMN), lambda y: percent * F.greatest(x["n"], y["n"]) <= 100 * F.least(x["n"], y["n"])),
        lambda y: F.struct(x["doc_id"].alias("a"), x["n"].alias("n"), y["doc_id"].alias("b"), y["n"].alias("m")),
    )))).alias("p")).select("p.*")
    pairs = both.groupBy("a", "n", "b", "m").agg(F.count("*").alias("common"))
    side = lambda key, size, name: hidden.select(F.col("doc_id").alias(key), F.col("n").alias(size), F.col("s").alias(name))
    pairs = pairs.join(side("a", "n", "s"), ["a", "n"], "left").join(side("b", "m", "r"), ["b", "m"], "left")
    need = F.greatest(
        F.ceil((F.col("n") + F.col("m")) * percent / F.lit(100 + percent)), F.ceil(F.greatest("n", "m") * percent / F.lit(100))
    )
    most = (
        F.col("common") + F.least(F.coalesce("s", F.lit(0)), F.coalesce("r", F.lit(0)))
        + F.greatest(_unfiled(F.col("n"), percent), _unfiled(F.col("m"), percent))
    )
    found = pairs.filter(most >= need).select("a", "b")
    deep = long.join(hidden.filter(F.col("s") > EXTRA).select("doc_id", "n"), ["doc_id", "n"], "left_semi")
    hubs = checkpoint(deep.groupBy("gram").agg(F.min("doc_id").alias("hub")))
    stars = deep.join(hubs, "gram").select(F.col("hub").alias("a"), F.col("doc_id").alias("b"))
    edges = checkpoint(found.unionByName(stars).distinct())
    release(shared, hubs)
    return edges


def _blocks(classes: DataFrame, percent: int) -> DataFrame:
    """Classes (root, class_id, doc, mark, copies, n) of groups, each with the pairs of row blocks it is multiplied in; a checkpoint.

    A group of more than one block is cut into bands of sizes, each ``percent`` of the next, and a band
    into hash blocks of bounded weight; sets of bands further apart than neighbours cannot link.  So
    nothing but sums is gathered per group, and unlike sizes never meet.
    """
    weight = F.greatest(F.col("n"), F.lit(MIN_WEIGHT))
    groups = checkpoint(classes.groupBy("root").agg(F.count("*").alias("members"), F.sum(weight).alias("weight")).filter("members > 1"))
    ratio = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100 / percent)) + 1e-9).cast("int")
    banded = checkpoint(
        classes.join(groups, "root").withColumn("band", F.when(F.col("weight") > BLOCK_GRAMS, ratio).otherwise(0)).drop("members", "weight")
    )
    blocks = checkpoint(banded.groupBy("root", "band").agg(F.ceil(F.sum(weight) / BLOCK_GRAMS).cast("int").alias("blocks")))
    near = lambda by, name: blocks.select("root", (F.col("band") + by).alias("band"), F.col("blocks").alias(name))
    every = lambda name: F.when(F.col(name).isNull(), F.array().cast("array<int>")).otherwise(F.sequence(F.lit(0), F.coalesce(name, F.lit(1)) - 1))
    pair = lambda band, low, high, cross, side: F.struct(
        F.col("band") + band, low.alias("low"), high.alias("high"), F.lit(cross).alias("cross"), side.cast("int").alias("side")
    )
    me = F.col("block")
    # A pair of neighbouring bands is named by the lower one, whose blocks are side 0.
    pairs = F.concat(
        F.transform(every("blocks"), lambda o: pair(0, F.least(me, o), F.greatest(me, o), False, me > o)),
        F.transform(every("over"), lambda o: pair(0, me, o, True, F.lit(0))),
        F.transform(every("under"), lambda o: pair(-1, o, me, True, F.lit(1))),
    ).cast("array<struct<band:int,low:int,high:int,cross:boolean,side:int>>")
    key = ["root", "band"]
    around = blocks.join(near(-1, "over"), key, "left").join(near(1, "under"), key, "left")
    placed = checkpoint(banded.join(around, key).withColumn("block", F.pmod(F.xxhash64("class_id"), F.col("blocks")).cast("int")).select(
        "root", "class_id", "doc", "mark", "copies", pairs.alias("pairs")
    ))
    release(groups, banded, blocks)
    return placed


def _multiplied(members: DataFrame, percent: int) -> DataFrame:
    """Rows (a, b, links) of classes from members (root, pairs, class_id, copies, grams).

    Of each pair of row blocks, a forest of its links (a, b, 0); and for each class there (a, a, the
    number of documents in the other block, or its own, that it links with).
    """
    key = ["root", "band", "low", "high", "cross"]
    dealt = members.select("root", F.explode("pairs").alias("p"), "class_id", "copies", "grams").select("root", "p.*", "class_id", "copies", "grams")
    ordered = dealt.repartition(*key).sortWithinPartitions(*key, "side", "class_id").select(*key, "side", "class_id", "copies", "grams")

    def product(key: tuple, held: list[tuple]) -> list[tuple[bytes, bytes, int]]:
        # A row that repeats brings its class twice.
        rows = [r for i, r in enumerate(held) if not i or r[:2] != held[i - 1][:2]]
        names, copies = [r[1] for r in rows], np.array([r[2] for r in rows])
        split = sum(r[0] == 0 for r in rows) if key[4] or key[2] != key[3] else None
        label, linked = links([np.frombuffer(r[3], dtype=np.uint64) for r in rows], percent, split)
        out = [(names[i], names[j], 0) for i, j in enumerate(label.tolist()) if i != j]
        return out + [(names[i], names[i], int(n)) for i, n in enumerate((linked @ copies).tolist()) if n]

    def packed(out: list[tuple[bytes, bytes, int]]) -> pa.RecordBatch:
        kinds = (pa.binary(), pa.binary(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)], ["a", "b", "links"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in slices(batches):
            keys = list(zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True))
            sides, names, copies = (batch.column(i).to_pylist() for i in range(5, 8))
            for i, this in enumerate(keys):
                if this != now:
                    if len(held) > 1 and (out := product(now, held)):
                        yield packed(out)
                    now, held = this, []
                held.append((sides[i], names[i], copies[i], batch.column(8)[i].as_py()))
        if len(held) > 1 and (out := product(now, held)):
            yield packed(out)

    return ordered.mapInArrow(run, "a binary, b binary, links long")


def join(df: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: (doc_id, n_shingles, class_id, component_id, n_links).

    Documents link when 100 * intersection >= percent * union of their ``n``-gram sets;
    ``component_id`` is the least id reachable by links, ``n_links`` the number of other rows that a row
    links with, equal sets included.  Null and empty texts have no n-grams and link with nothing, not
    even one another.  Rows with a null id keep a null component and no links but are not joined
    through.  Rows that repeat count as copies; texts under one id are joined each by itself.
    """
    return _labelled(df, n, percent, id_col, text_col).select("doc_id", "n_shingles", "class_id", "component_id", "n_links")


def _labelled(df: DataFrame, n: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``join`` with their text's mark and ``leads``: whether the row's set stands for its component.

    A component's leading set is the least class of those under its least id; ``leads`` is null where
    nothing was joined.
    """
    spark_docs = df.select(id_col, text_col)
    made = checkpoint(_documents(spark_docs, n, id_col, text_col))
    docs = checkpoint(made.filter(F.col("slice").isNull()).select("doc_id", "n_shingles", "class_id", "mark"))
    levels = _levels(made.filter(F.col("slice").isNotNull()).select("slice", "cells"))
    release(made)
    edges = _candidates(_filed(spark_docs, n, percent, levels, id_col, text_col), percent)
    named = docs.filter((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    groups = components(edges)
    sets = checkpoint(named.groupBy("class_id").agg(
        F.min(F.struct("doc_id", "mark")).alias("first"), F.count("*").alias("copies"), F.min("n_shingles").alias("n")
    ))
    nodes = groups.join(named, groups["node"] == named["doc_id"]).select("root", "class_id").distinct()
    classes = checkpoint(nodes.join(sets, "class_id").select(
        "root", "class_id", F.col("first.doc_id").alias("doc"), F.col("first.mark").alias("mark"), "copies", "n"
    ))
    release(edges)
    placed = _blocks(classes, percent)
    found = checkpoint(_multiplied(_with_grams(spark_docs, placed, n, id_col, text_col), percent))
    release(classes, placed)
    linked = components(found.filter("a <> b").select("a", "b"))
    counted = found.filter("links > 0").groupBy(F.col("a").alias("class_id")).agg(F.sum("links").alias("links"))
    # Labels go from group to class to document; each table is written before its join, so that the rows
    # of a large group or of many copies can be split over tasks.
    rooted = checkpoint(
        sets.join(linked.withColumnRenamed("node", "class_id"), "class_id", "left").join(counted, "class_id", "left").select(
            "class_id", F.col("first.doc_id").alias("least"), F.coalesce("root", "class_id").alias("group"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
        )
    )
    release(sets, found)
    least = checkpoint(rooted.groupBy("group").agg(F.min(F.struct("least", "class_id")).alias("lead")))
    labels = checkpoint(rooted.join(least, "group").select(
        F.col("class_id").alias("_class"), F.col("lead.least").alias("component_id"), (F.col("class_id") == F.col("lead.class_id")).alias("leads"), "links"
    ))
    release(rooted, least)
    mine = (docs["class_id"] == labels["_class"]) & (docs["n_shingles"] > 0) & docs["doc_id"].isNotNull()
    return docs.join(labels, mine, "left").select(
        "doc_id", "n_shingles", "class_id", F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce("links", F.lit(0)).alias("n_links"), "mark", "leads",
    )


def _with_grams(df: DataFrame, placed: DataFrame, n: int, id_col: str, text_col: str) -> DataFrame:
    """Members with their n-gram hashes, computed from the candidates' texts only."""
    at = placed.select("root", "pairs", "class_id", "copies", F.col("doc").alias("_doc"), F.col("mark").alias("_mark"))
    source = df.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("_text"), F.xxhash64(text_col).alias("_mark"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            grams = pa.array([s.tobytes() for s in gram_sets(part.column(4), n)], pa.binary())
            yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(4)), grams], ["root", "pairs", "class_id", "copies", "grams"])

    kind = dict(placed.dtypes)
    schema = f"root {kind['root']}, pairs {kind['pairs']}, class_id binary, copies long, grams binary"
    wanted = source.join(at, ["_doc", "_mark"]).select("root", "pairs", "class_id", "copies", "_text")
    return wanted.mapInArrow(run, schema)


def keep_one(df: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component, of its least id, all columns unchanged.

    Each text is decided by itself: under an id that repeats, a clean text stays where another one is a
    near copy.  Rows equal in id and n-gram set are kept once; rows with a null id are joined with
    nothing, so all of them stay.
    """
    found = _labelled(df, n, percent, id_col, text_col)
    first = (
        found.filter(F.coalesce("leads", F.lit(True)) & (F.col("component_id") == F.col("doc_id")))
        .groupBy(F.col("doc_id").alias("_vectrace_first"), "class_id").agg(F.min("mark").alias("_vectrace_text"))
    )
    marked = df.withColumn("_vectrace_mark", F.xxhash64(text_col))
    same = (marked[id_col] == first["_vectrace_first"]) & (marked["_vectrace_mark"] == first["_vectrace_text"])
    kept = marked.join(first, same, "left_semi").dropDuplicates([id_col, "_vectrace_mark"]).drop("_vectrace_mark")
    return kept.unionByName(df.filter(F.col(id_col).isNull()))
