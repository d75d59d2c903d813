"""Exact n-gram Jaccard join with signature trees.

A document is the set of its distinct word shingles, as 64-bit hashes. Two documents link when
``100 * |A & B| >= threshold * |A | B|``. The join is exact; each step only leaves out pairs
that cannot link:

1. Documents with the same set are one *family*, represented by its smallest doc_id.
2. If A links with another set, at most ``slack(n) = n - ceil(threshold * n / 100)`` of its n
   shingles are missing there. Of the shingles below a point in hash space (a half of them),
   all but ``slack`` must then stand in some other set too. One packed shuffle of that half
   counts this, and leaves the families that can have a partner.
3. Two linked sets share one of their first shingles in any order that holds for all; here the
   rarest among the sets left come first, so that common passages don't count. Of the larger
   set ``slack + 1`` shingles must be looked at, of the smaller (or equal) one about half as many,
   as it lacks less of what the sizes of both demand. A shingle counts if it is among the few of one
   set, and for the sets whose sizes fit it. Components over these shingles are the *areas* in
   which links can lie. An area is usually a handful of documents.
4. Signature trees join the documents of an area: all of it if it fits one block, else first its
   blocks of ``chunk`` documents, then new blocks of one document of each group found; these two
   steps join up nearly all of a family of near copies at a cost in proportion to its size. The
   documents that share a shingle of step 3 with another group still, meet in one block of up to
   ``block`` documents or 16 MB; only a larger rest is cut, and its parts meet two by two.
5. Components over the groups that the last step links.

A signature tree holds the documents of a block in leaves of 64, neighbours by smallest hash.
A node has the OR of its documents' 4,096-bit bitmaps, the range of their sizes, and the most
shingles that a document lost to bit collisions. Two nodes are traversed together only if
their sizes and common bits leave room for the overlap a link needs, and they are not joined
already. Pairs of documents that remain are compared exactly.

Definitions and edge cases
  * Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z. A text of fewer than ``k`` words
    is one shingle. Without words (null, empty) the set is empty and links with nothing.
  * Rows that repeat a doc_id are one document, so doc_id must identify a text. A row without
    doc_id is no document and has no row in the result.
  * An empty table gives an empty result. Columns other than doc_id and text don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm import batches as B
from tallyloom.llm.common import documents, parts_for, stage, text_size
from tallyloom.llm.graph import components
from tallyloom.llm.packed import (
    PACKED_TYPE,
    Packer,
    by_document,
    fact_row,
    joined,
    per_key,
    places,
)

_U = np.uint64
#: Shingles with a smaller hash are counted in step 2.
_HALF = _U(1 << 63)
_WORDS = 64  # 64-bit words of a bitmap
_LEAF = 64


def slack(n, threshold: int):
    """Most elements of a set of ``n`` that a linked set may lack."""
    return n - (threshold * n + 99) // 100


def short_slack(n, threshold: int):
    """Most elements of a set of ``n`` that a linked set of as many or more may lack."""
    return n - (2 * threshold * n + 99 + threshold) // (100 + threshold)


def shingle_sets(column: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text in ascending order, and their bounds."""
    words = B.split_words(column, B.NOT_SPACE, B.LOWER)
    h = words.hashes()
    windows = B.window_hashes(h, k)[B.window_starts(words.first, k)] if len(h) >= k else h[:0]
    counts = words.counts
    of = np.maximum(counts - (k - 1), 0)
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        sizes = np.where((counts > 0) & (counts < k), 1, of)
        at = np.concatenate([[0], np.cumsum(sizes)])
        out = np.empty(at[-1], dtype=_U)
        out[np.repeat(at[:-1] - np.concatenate([[0], np.cumsum(of)[:-1]]), of) + np.arange(of.sum())] = windows
        for d in short:
            n = int(counts[d])
            one = B.window_hashes(h[words.first[d] : words.first[d + 1]], n)
            out[at[d]] = B.mix(one ^ _U(n))[0]
    else:
        at, out = np.concatenate([[0], np.cumsum(of)]), windows
    out = B.mix(out)
    for low, high in zip(at[:-1], at[1:], strict=True):
        out[low:high].sort()
    keep = np.ones(len(out), dtype=bool)
    keep[1:] = out[1:] != out[:-1]
    keep[at[:-1][at[:-1] < len(out)]] = True
    return out[keep], np.concatenate([[0], np.cumsum(keep)])[at]


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum per document, modulo 2^64."""
    total = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values, dtype=values.dtype)])
    return total[bounds[1:]] - total[bounds[:-1]]


def _count_tasks(k: int, buckets: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, turn = Packer(buckets, places=False), 0
        for piece in B.pieces(parts):
            ids = piece.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            sets, bounds = shingle_sets(piece.column(1), k)
            low = sets < _HALF
            s1 = B.signed(_sums(B.mix(sets ^ _U(0x5BD1E995)), bounds))
            s2 = B.signed(_sums(B.mix(sets + _U(0x1B873593)), bounds))
            n = np.diff(bounds)
            sampled = _sums(low.astype(np.int64), bounds)
            turn += int(ids[0]) + 1
            yield fact_row(turn % buckets, ids=ids, tags=n, counts=sampled, low=s1, high=s2)
            doc = np.repeat(np.arange(len(ids)), n)[low]
            yield from packer.add(sets[low], doc, ids, tags=s1)
        yield from packer.end()

    return run


_FACTS_TYPE = "doc_id long, n long, sampled long, s1 long, s2 long, shared long"
_FACTS = pa.schema([(c.split()[0], pa.int64()) for c in _FACTS_TYPE.split(", ")])


def _count_bucket(table: pa.Table) -> pa.Table:
    """Facts pass through; per document, how many of the keys here stand in another set too."""
    is_fact = table["keys"].is_null()
    facts = table.filter(is_fact)
    out = [
        pa.table(
            [joined(facts[c], np.int64) for c in ("ids", "tags", "counts", "low", "high")]
            + [np.zeros(len(joined(facts["ids"], np.int64)), np.int64)],
            schema=_FACTS,
        )
    ]
    asked = table.filter(pc.invert(is_fact))
    keys, ids, tags = joined(asked["keys"], np.uint32), per_key(asked, "ids"), per_key(asked, "tags")
    if len(keys):
        order = np.argsort(keys)
        key, tag = keys[order], tags[order]
        start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        differ = np.minimum.reduceat(tag, start) != np.maximum.reduceat(tag, start)
        hit = np.repeat(differ, np.diff(np.append(start, len(key))))
        doc, shared = np.unique(ids[order[hit]], return_counts=True)
        none = pa.nulls(len(doc), pa.int64())
        out.append(pa.table([pa.array(doc), none, none, none, none, pa.array(shared)], schema=_FACTS))
    return pa.concat_tables(out)


def shingle_facts(docs: DataFrame, k: int) -> DataFrame:
    """Per document: set size, size of the counted half, how much of it others have, identity."""
    base = documents(docs).filter("doc_id is not null")
    buckets = parts_for(text_size(base), 8 << 20, 64)
    counted = (
        base.mapInArrow(_count_tasks(k, buckets), PACKED_TYPE)
        .groupBy("bucket")
        .applyInArrow(_count_bucket, _FACTS_TYPE)
    )
    return counted.groupBy("doc_id").agg(
        *(F.max(c).alias(c) for c in ("n", "sampled", "s1", "s2")), F.sum("shared").alias("shared")
    )


# --- joining blocks -----------------------------------------------------------------------


def bitmaps(sets: list[np.ndarray]) -> np.ndarray:
    out = np.zeros((len(sets), _WORDS), dtype=_U)
    for row, s in enumerate(sets):
        bit = s >> _U(52)
        np.bitwise_or.at(out[row], (bit >> _U(6)).astype(np.int64), _U(1) << (bit & _U(63)))
    return out


class SignatureTree:
    """Bitmaps, size ranges and collision counts of documents, leaf by leaf and upwards."""

    def __init__(self, sets: list[np.ndarray]) -> None:
        self.sizes = np.array([len(s) for s in sets])
        self.maps = bitmaps(sets)
        lost = self.sizes - np.bitwise_count(self.maps).sum(axis=1)
        bounds = np.append(np.arange(0, len(sets), _LEAF), len(sets))
        self.lost = lost
        # levels[0] are leaves: (first document, end, OR, smallest, largest, most lost)
        level = [
            (a, b, np.bitwise_or.reduce(self.maps[a:b]), self.sizes[a:b].min(),
             self.sizes[a:b].max(), lost[a:b].max(), ())
            for a, b in zip(bounds[:-1], bounds[1:], strict=True)
        ]
        while len(level) > 1:
            groups = [level[i : i + 8] for i in range(0, len(level), 8)]
            level = [
                (g[0][0], g[-1][1], np.bitwise_or.reduce([x[2] for x in g]), min(x[3] for x in g),
                 max(x[4] for x in g), max(x[5] for x in g), g)
                for g in groups
            ]
        self.root = level[0]


def _may_link(x, y, threshold: int) -> bool:
    """Whether documents of two nodes can overlap enough, by their sizes and bits."""
    if min(x[4], y[4]) * 100 < threshold * max(x[3], y[3]):
        return False
    bits = int(np.bitwise_count(x[2] & y[2]).sum())
    return (bits + min(x[5], y[5])) * (100 + threshold) >= threshold * (x[3] + y[3])


def tree_links(
    sets: list[np.ndarray], group: np.ndarray, side: np.ndarray, threshold: int
) -> list[tuple[int, int]]:
    """Links that join the documents of a block; sets are ascending hashes.

    Documents of equal ``group`` are joined already. With two sides only pairs across count.
    ``group`` is changed so that joined documents are equal in it.
    """
    tree, found = SignatureTree(sets), []
    across = len(np.unique(side)) > 1

    def leaves(x, y) -> None:
        a, b = np.arange(x[0], x[1]), np.arange(y[0], y[1])
        bits = np.bitwise_count(tree.maps[a][:, None] & tree.maps[b][None]).sum(axis=2)
        room = bits + np.minimum(tree.lost[a][:, None], tree.lost[b][None])
        both = tree.sizes[a][:, None] + tree.sizes[b][None]
        open_ = (room * (100 + threshold) >= threshold * both) & (group[a][:, None] != group[b][None])
        if across:
            open_ &= side[a][:, None] != side[b][None]
        for i, j in zip(*np.nonzero(open_), strict=True):
            p, q = a[i], b[j]
            if p >= q and x is y or group[p] == group[q]:
                continue
            same = len(np.intersect1d(sets[p], sets[q], assume_unique=True))
            if 100 * same >= threshold * (tree.sizes[p] + tree.sizes[q] - same):
                found.append((int(p), int(q)))
                low, high = min(group[p], group[q]), max(group[p], group[q])
                group[group == high] = low

    def walk(x, y) -> None:
        low = min(group[x[0] : x[1]].min(), group[y[0] : y[1]].min())
        high = max(group[x[0] : x[1]].max(), group[y[0] : y[1]].max())
        if low == high or not _may_link(x, y, threshold):
            return
        if not x[6] and not y[6]:
            leaves(x, y)
        elif x is y:
            for i, c in enumerate(x[6]):
                for d in x[6][i:]:
                    walk(c, d)
        elif not y[6] or x[6] and x[1] - x[0] >= y[1] - y[0]:
            for c in x[6]:
                walk(c, y)
        else:
            for d in y[6]:
                walk(x, d)

    walk(tree.root, tree.root)
    return found


_LINKS_TYPE = "v long, u long"


def _link_block(threshold: int, across: bool):
    """The links between groups of a block; or, if no group is in other blocks, each group's new head."""

    def run(table: pa.Table) -> pa.Table:
        ids = table["doc_id"].to_numpy()
        first = [np.frombuffer(x, dtype=_U) for x in table["grams"].to_pylist()]
        order = sorted(range(len(first)), key=lambda r: (first[r][:8].tolist(), ids[r]))
        ids = ids[order]
        before, side = table["grp"].to_numpy()[order], table["side"].to_numpy()[order]
        group = before.copy()
        links = tree_links([first[r] for r in order], group, side, threshold)
        if across:
            v, u = ([before[p] for p, _ in links], [before[q] for _, q in links])
        else:
            moved = group != before
            v, u = before[moved], group[moved]
        return pa.table([pa.array(v, pa.int64()), pa.array(u, pa.int64())], names=["v", "u"])

    return run


def _set_tasks(k: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in B.pieces(parts):
            sets, bounds = shingle_sets(piece.column(1), k)
            grams = [sets[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), pa.array(np.diff(bounds)), pa.array(grams, pa.binary())],
                ["doc_id", "n", "grams"],
            )

    return run


def _rank_tasks(buckets: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(buckets)
        for part in parts:
            ids = part.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for k, grams in enumerate(part.column(1)):
                one = np.frombuffer(grams.as_buffer(), dtype=_U)
                none = np.zeros(len(one), np.int64)
                yield from packer.add(one, none, ids[k : k + 1], np.arange(len(one)))
        yield from packer.end()

    return run


def _rank_bucket(table: pa.Table) -> pa.Table:
    """How many sets have the shingle, for shingles of at least two."""
    keys, ids, at = joined(table["keys"], np.uint32), per_key(table, "ids"), places(table)
    _, back, count = np.unique(keys, return_inverse=True, return_counts=True)
    count = count[back]
    shared = count > 1
    return by_document(
        ids[shared], at=at[shared].astype(np.uint32), sets=count[shared].astype(np.uint32)
    )


def _prefix_tasks(threshold: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            ids = part.column("doc_id").to_numpy(zero_copy_only=False)
            keys, short, found = [], [], part.column("found").to_pylist()
            for grams, answers in zip(part.column("grams"), found, strict=True):
                one = np.frombuffer(grams.as_buffer(), dtype=_U)
                sets = np.ones(len(one), np.int64)
                for x in answers:
                    sets[np.frombuffer(x["at"], np.uint32)] = np.frombuffer(x["sets"], np.uint32)
                first = np.lexsort((one, sets))[: slack(len(one), threshold) + 1]
                shared = sets[first] > 1
                keys.append(one[first[shared]])
                short.append((np.arange(len(first)) <= short_slack(len(one), threshold))[shared])
            key = B.signed(np.concatenate([np.empty(0, _U), *keys]))
            counts = [len(k) for k in keys]
            doc, n = np.repeat(ids.astype(np.int64), counts), np.repeat(part.column("n").to_numpy(), counts)
            short = np.concatenate([np.empty(0, bool), *short])
            yield pa.RecordBatch.from_arrays(
                [pa.array(key), pa.array(doc), pa.array(n), pa.array(short)], ["key", "doc_id", "n", "short"]
            )

    return run


def rare_prefixes(sets: DataFrame, threshold: int) -> DataFrame:
    """The rarest ``slack + 1`` shingles of each set, as far as another set has them too.

    Rows are (key, doc_id, n, short); the rarest ``short_slack + 1`` of a set are short.
    """
    size = 8 * (sets.agg(F.sum("n")).first()[0] or 0)
    answers = (
        sets.select("doc_id", "grams")
        .mapInArrow(_rank_tasks(parts_for(size, 8 << 20, 64)), PACKED_TYPE)
        .groupBy("bucket")
        .applyInArrow(_rank_bucket, "doc_id long, at binary, sets binary")
        .groupBy("doc_id")
        .agg(F.collect_list(F.struct("at", "sets")).alias("found"))
    )
    return (
        sets.select("doc_id", "n", "grams")
        .join(answers, "doc_id")
        .mapInArrow(_prefix_tasks(threshold), "key long, doc_id long, n long, short boolean")
    )


def fitting_keys(sets: DataFrame, threshold: int) -> DataFrame:
    """(key, doc_id, hub): the shingles by which a document may link, and a document they are short in."""
    keys = stage(rare_prefixes(sets, threshold), "keys")
    hubs = keys.filter("short").groupBy("key").agg(
        F.min("doc_id").alias("hub"), F.min("n").alias("least"), F.max("n").alias("most"), F.count(F.lit(1)).alias("shorts")
    )
    fits = F.col("short") | ((F.col("n") >= F.col("least")) & (F.col("n") * threshold <= F.col("most") * 100))
    met = keys.join(stage(hubs, "hubs"), "key").filter(fits)
    return stage(met.select("key", "doc_id", "hub"), "keys")


def _chunks(members: DataFrame, most: int, most_bytes: int) -> DataFrame:
    """Members (doc_id, area, n, ...) with the number of chunks of their area and their own."""
    sizes = stage(
        members.groupBy("area").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("s")), "areas"
    )
    by_rows, by_bytes = F.ceil(F.col("c") / most), F.ceil(F.col("s") * 8 / most_bytes)
    sizes = sizes.select("area", F.greatest(by_rows, by_bytes, F.lit(1)).cast("int").alias("m"))
    return members.join(sizes, "area").withColumn("chunk", F.pmod(F.xxhash64("doc_id"), "m").cast("int"))


def _joined_within(
    blocks: DataFrame, sets: DataFrame, by: list[str], threshold: int, across: bool = False
) -> DataFrame:
    """Links within each block of (doc_id, grp, side) rows."""
    return (
        blocks.select("doc_id", "grp", "side", *by)
        .join(sets.select("doc_id", "grams"), "doc_id")
        .groupBy(*by)
        .applyInArrow(_link_block(threshold, across), _LINKS_TYPE)
    )


def _regrouped(state: DataFrame, heads: DataFrame) -> DataFrame:
    """The state with each group v put into the group u."""
    moved = stage(heads.select(F.col("v").alias("grp"), F.col("u").alias("head")), "heads")
    columns = [c for c in state.columns if c != "grp"]
    return state.join(moved, "grp", "left").select(*columns, F.coalesce("head", "grp").alias("grp"))


def similar_sets(sets: DataFrame, threshold: int, chunk: int = 64, block: int = 16_384) -> DataFrame:
    """(node, component) over the linked sets of a staged table (doc_id, n, grams)."""
    most_bytes = 16 << 20
    keys = fitting_keys(sets, threshold)
    stars = keys.filter("doc_id != hub")
    areas = components(stars.select(F.col("doc_id").alias("v"), F.col("hub").alias("u")))
    areas = areas.select(F.col("node").alias("doc_id"), F.col("component").alias("area"))
    state = stage(areas.join(sets.select("doc_id", "n"), "doc_id"), "state")
    state = stage(_chunks(state.withColumn("grp", F.col("doc_id")), chunk, most_bytes), "state")
    own = state.withColumn("side", F.lit(0))
    state = stage(_regrouped(state, _joined_within(own, sets, ["area", "chunk"], threshold)), "state")
    named = state.select(F.col("doc_id").alias("node"), F.col("grp").alias("component"))
    wide = state.filter("m > 1").drop("m", "chunk")  # the other areas are done
    if wide.isEmpty():
        return named

    # One document of each group found so far, in new chunks.
    heads = _chunks(wide.filter("doc_id = grp"), chunk, most_bytes).withColumn("side", F.lit(0))
    heads = stage(heads, "heads")
    wide = stage(_regrouped(wide, _joined_within(heads, sets, ["area", "chunk"], threshold)), "state")

    # What still shares a shingle with another group meets.
    members = stage(open_members(keys, wide), "members")
    last = stage(_joined_within(meetings(members, block, most_bytes), sets, ["area", "i", "j"], threshold, True), "links")
    joined = components(last).select(F.col("node").alias("v"), F.col("component").alias("u"))
    wide = stage(_regrouped(wide, joined), "state")
    done = state.filter("m = 1").select(F.col("doc_id").alias("node"), F.col("grp").alias("component"))
    return done.unionByName(wide.select(F.col("doc_id").alias("node"), F.col("grp").alias("component")))


def open_members(keys: DataFrame, wide: DataFrame) -> DataFrame:
    """The documents that share a key with a document of another group."""
    shared = stage(keys.select("key", "doc_id").join(wide.select("doc_id", "grp"), "doc_id"), "shared")
    mixed = shared.groupBy("key").agg(F.min("grp").alias("a"), F.max("grp").alias("b"))
    mixed = stage(mixed.filter("a != b").select("key"), "mixed")
    open_ = shared.join(mixed, "key", "left_semi").select("doc_id").distinct()
    return wide.join(open_, "doc_id", "left_semi")


def meetings(members: DataFrame, block: int, most_bytes: int) -> DataFrame:
    """Rows of the blocks in which members meet: one block an area, or pairs of parts of a larger one."""
    met = _chunks(members, block, most_bytes).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("m") - 1))
    )
    return met.select(
        "doc_id", "area", "grp",
        F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"),
        (F.col("chunk") > F.col("other")).cast("int").alias("side"),
    )


def near_duplicates(docs: DataFrame, k: int = 5, threshold: int = 80) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest doc_id that links lead to) per document."""
    facts = stage(shingle_facts(docs, k), "facts")
    filled = facts.filter("n > 0")
    same = ["n", "s1", "s2"]
    families = stage(
        filled.groupBy(*same).agg(
            F.min("doc_id").alias("head"), F.max("sampled").alias("sampled"), F.max("shared").alias("shared")
        ),
        "families",
    )
    room = F.col("n") - F.ceil(F.col("n") * threshold / F.lit(100))
    able = families.filter(F.col("sampled") - F.col("shared") <= room).select(F.col("head").alias("doc_id"))
    picked = documents(docs).join(stage(able, "able").hint("shuffle_hash"), "doc_id", "left_semi")
    sets = picked.mapInArrow(_set_tasks(k), "doc_id long, n long, grams binary")
    sets = stage(sets.dropDuplicates(["doc_id"]), "sets")
    linked = stage(similar_sets(sets, threshold), "linked")
    named = families.join(linked, F.col("head") == F.col("node"), "left").select(
        *same, F.coalesce("component", "head").alias("component_id")
    )
    classes = filled.select("doc_id", *same).join(stage(named, "classes"), same)
    alone = facts.filter("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return (
        classes.select("doc_id", "n", "component_id")
        .unionByName(alone)
        .select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    )


def one_of_each(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """The documents that represent their class, in the columns of ``docs``, whatever their names.

    Of rows that repeat a doc_id with the same text one stays; rows of one id with different texts
    all stay, as they are different documents, and rows without doc_id, as no class names them.
    Whether ids repeat at all is seen from the id column alone.
    """
    copies = stage(classes.filter("component_id != doc_id").select(F.col("doc_id").alias("copy")), "copies")
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    rows = docs.select(row, F.col("doc_id").cast("long").alias("key"), "text")
    kept = rows.join(copies.hint("shuffle_hash"), F.col("key") == F.col("copy"), "left_anti")
    ids = docs.filter("doc_id is not null").groupBy("doc_id").count()
    if not ids.filter("count > 1").isEmpty():
        lone = F.when(F.col("key").isNull(), F.monotonically_increasing_id())
        kept = kept.withColumn("lone", lone).dropDuplicates(["key", "text", "lone"])
    return kept.select("row.*")
