"""Operator 3: n-gram Jaccard join by chosen paths.

Documents are linked if the Jaccard similarity of their sets of five-word shingles is
0.8 or more. The join finds all links between different texts and returns a row per
document with its class (the documents connected by links) and its number of links.

1. Texts that are equal are one set with a count; everything below is on sets.
2. Each hash function samples one shingle of a set, the one it hashes lowest; two sets
   sample the same one with the chance of their similarity. A run splits the sets into
   buckets by a sampled shingle. A large bucket is split again, each set going into the
   buckets of its shingles by the next two functions, down to ``LEVELS``; a bucket
   still large is met in blocks, so nothing is given up. Runs repeat until a pair at
   the threshold shares a bucket of some run with probability ``TARGET_RECALL``, split
   or not; ``recall`` works it out.
3. Inside buckets sets are compared by sketches of minwise hashes, four deviations
   below the threshold, and only what connects them is kept. A first round on two
   functions, large buckets cut at random, puts most copies into common components;
   after it, buckets inside one component are passed over, and where one component
   makes up most of a bucket only the others are compared with it.
4. Inside the components so found, all sets are compared exactly, each pair once, in
   blocks of bounded size. Links are counted there; no pair is ever written out.

Edge cases: a NULL, empty or blank text has no shingle, is a class of its own and has no
links, not even to its copies. A text of one to four words is one shingle. Rows that
repeat are documents of their own, linked to their copies. Ties of the id do not matter:
the class id is the least id in the class, NULL only if all are NULL. An empty table
gives an empty table. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from viewlake.llm.components import components
from viewlake.llm.scratch import cut, text_slices
from viewlake.llm.shingles import odd_numbers, shingle_sets

THRESHOLD = 0.8
TARGET_RECALL = 0.9999
LEVELS = 4
SKETCH = 64
#: Sets compared with each other at once.
BLOCK = 512
HALF = BLOCK // 2


def functions_of(run: int, level: int) -> list[int]:
    """The functions by which a run splits at a level: one at first, then two."""
    first = run * (2 * LEVELS - 1)
    return [first] if level == 1 else [first + 2 * level - 3, first + 2 * level - 2]


def recall(runs: int, threshold: float = THRESHOLD) -> float:
    """The chance that a pair at the threshold meets in some run, through all levels."""
    one_run = threshold * (1 - (1 - threshold) ** 2) ** (LEVELS - 1)
    return 1 - (1 - one_run) ** runs


def runs_needed(target: float = TARGET_RECALL) -> int:
    return next(r for r in count(1) if recall(r) >= target)


def text_key(text: Column) -> Column:
    """The md5 of a text; two texts with one key are the same text."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def _slices_of_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for batch in text_slices(batches, "text"):
        texts = batch.column("text")
        bounds = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, texts.offset * 4).astype(np.int64)
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[bounds[0]:bounds[-1]]
        yield batch, shingle_sets(data, bounds - bounds[0])


def signatures(df: DataFrame, runs: int, text_col: str = "text") -> DataFrame:
    """(key, size, sketch, chosen) of every different text with words.

    ``chosen`` holds the shingle that each of the first functions samples.
    """
    functions = runs * (2 * LEVELS - 1)
    minwise = odd_numbers(max(SKETCH, functions), 2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, sets in _slices_of_sets(batches):
            sizes = np.array([len(s) for s in sets], np.int64)
            full = np.flatnonzero(sizes)
            if not len(full):
                continue
            sizes = sizes[full]
            flat = np.concatenate([sets[i] for i in full])
            starts = np.cumsum(sizes) - sizes
            lowest = np.stack([np.minimum.reduceat(flat * factor, starts) for factor in minwise], 1)
            sketch = (lowest[:, -SKETCH:] >> np.uint64(16) & np.uint64(0xFF)).astype(np.uint8)
            chosen = pa.ListArray.from_arrays(pa.array(np.arange(0, len(full) * functions + 1, functions, dtype=np.int32)), pa.array(lowest[:, :functions].ravel().view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("key").take(pa.array(full)), pa.array(sizes.astype(np.int32)), pa.array([row.tobytes() for row in sketch], pa.binary()), chosen], ["key", "size", "sketch", "chosen"])

    texts = df.where(F.col(text_col).isNotNull()).select(text_key(F.col(text_col)).alias("key"), F.col(text_col).alias("text"))
    made = texts.mapInArrow(run, "key binary, size int, sketch binary, chosen array<long>")
    return made.dropDuplicates(["key"])


def _merge(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after joining the components of each a and b; the lesser label stays."""
    while True:
        low, high = np.minimum(labels[a], labels[b]), np.maximum(labels[a], labels[b])
        if not (low != high).any():
            return labels
        np.minimum.at(labels, high, low)
        while (labels != labels[labels]).any():
            labels = labels[labels]


def _groups(batches: Iterator[pa.RecordBatch], work: Callable[[pa.Table, np.ndarray], Iterator[pa.RecordBatch]]) -> Iterator[pa.RecordBatch]:
    """Call ``work`` with rows of whole groups; rows come sorted by ``group``."""
    kept = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        kept = table if kept is None else pa.concat_tables([kept, table])
        groups = kept.column("group").to_numpy()
        if not len(groups):
            continue
        last = np.searchsorted(groups, groups[-1])
        if last:
            yield from work(kept.slice(0, last).combine_chunks(), groups[:last])
            kept = kept.slice(last)
    if kept is not None and kept.num_rows:
        yield from work(kept.combine_chunks(), kept.column("group").to_numpy())


def compare_sketches(rows: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Edges (a, b) that connect what looks similar inside each group.

    ``rows`` are (group, id, size, sketch, comp); sets of one component are not
    compared. Groups hold about ``BLOCK`` rows.
    """
    deviation = (threshold * (1 - threshold) / SKETCH) ** 0.5
    least = int(np.floor(SKETCH * (threshold - 4 * deviation)))

    def work(table: pa.Table, groups: np.ndarray) -> Iterator[pa.RecordBatch]:
        n = len(groups)
        sketches = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(n, SKETCH)
        sizes, ids = table.column("size").to_numpy(), table.column("id").to_numpy()
        # Sets of a component known already start under one label in each group.
        _, first, labels = np.unique(np.stack((groups, table.column("comp").to_numpy())), axis=1, return_index=True, return_inverse=True)
        before = labels = first[labels.ravel()]
        at = np.arange(n)
        for shift in range(1, n):
            at = at[at < n - shift]
            at = at[groups[at] == groups[at + shift]]
            if not len(at):
                break
            a = at[labels[at] != labels[at + shift]]
            a = a[np.minimum(sizes[a], sizes[a + shift]) >= threshold * np.maximum(sizes[a], sizes[a + shift])]
            a = a[(sketches[a] == sketches[a + shift]).sum(1) >= least]
            if len(a):
                labels = _merge(labels.copy(), a, a + shift)
        moved = np.flatnonzero((labels != before) & (before == np.arange(n)))
        yield pa.RecordBatch.from_arrays([pa.array(ids[moved]), pa.array(ids[labels[moved]])], ["a", "b"])

    dealt = rows.select("group", "id", "size", "sketch", "comp").repartition("group").sortWithinPartitions("group")
    return dealt.mapInArrow(lambda batches: _groups(batches, work), "a long, b long")


def _paths(rows: DataFrame, level: int) -> DataFrame:
    """(id, comp, run, path): rows once for each shingle sampled at the level."""
    places = [F.col("run") * functions_of(1, 1)[0] + f + 1 for f in functions_of(0, level)]
    tokens = F.array(*(F.struct(place.alias("function"), F.element_at("chosen", place).alias("token")) for place in places))
    before = ["path"] if level > 1 else []
    longer = rows.select("id", "comp", "run", *before, F.explode(tokens).alias("by"))
    return longer.select("id", "comp", "run", F.xxhash64("by", *before).alias("path"))


def first_round(sets: DataFrame) -> DataFrame:
    """Edges by two functions; large buckets are cut at random, not split."""
    rows = sets.select("id", F.col("id").alias("comp"), "chosen", F.explode(F.array(F.lit(0), F.lit(1))).alias("run"))
    paths = _paths(rows, 1)
    counts = cut(paths.groupBy("path").agg(F.count("*").alias("n")).where("n > 1"))
    cuts = F.ceil(F.col("n") / BLOCK)
    groups = paths.join(counts, "path").select(F.xxhash64("path", F.when(cuts > 1, F.pmod(F.xxhash64("path", "id"), cuts)).otherwise(0)).alias("group"), "id", "comp")
    return compare_sketches(groups.join(sets.select("id", "size", "sketch"), "id"))


def path_groups(sets: DataFrame, comps: DataFrame, runs: int) -> DataFrame:
    """(group, id, size, sketch, comp) of all buckets that hold two components or more."""
    known = sets.join(comps, sets["id"] == comps["node"], "left").select("id", "chosen", F.coalesce("root", "id").alias("comp"))
    paths = cut(_paths(known.withColumn("run", F.explode(F.sequence(F.lit(0), F.lit(runs - 1)))), 1))
    found = []
    for level in range(1, LEVELS + 1):
        mixed = paths.groupBy("path").agg(F.count("*").alias("n"), F.min("comp").alias("low"), F.max("comp").alias("high"))
        mixed = cut(mixed.where("low < high").select("path", "n"))
        held = cut(paths.join(mixed, "path"))
        found.append(held.where(f"n <= {BLOCK}").select(F.col("path").alias("group"), "id", "comp"))
        large = held.where(f"n > {BLOCK}")
        main = large.groupBy("path", "comp").agg(F.count("*").alias("of_comp")).groupBy("path").agg(F.max(F.struct("of_comp", "comp")).alias("main"))
        main = cut(main.select("path", F.col("main.comp").alias("main"), F.col("main.of_comp").alias("of_main")))
        large = large.join(main, "path").withColumn("rest", F.col("n") - F.col("of_main"))
        last = level == LEVELS
        found.append(_meet_main(large if last else large.where(f"rest <= {HALF}")))
        if not last:
            split = large.where(f"rest > {HALF}").select("id", "comp", "run", "path").join(sets.select("id", "chosen"), "id")
            paths = cut(_paths(split, level + 1))
    groups = found[0]
    for more in found[1:]:
        groups = groups.union(more)
    return groups.join(sets.select("id", "size", "sketch"), "id")


def _meet_main(large: DataFrame) -> DataFrame:
    """Blocks of a large bucket in which all sets not of one component meet.

    The main component's sets are cut into blocks, the rest too; each block of the
    rest meets each block of both.
    """
    is_main = F.col("comp") == F.col("main")
    mains, rests = F.ceil(F.col("of_main") / HALF), F.ceil(F.col("rest") / HALF)
    block = F.pmod(F.xxhash64("id", "path"), F.when(is_main, mains).otherwise(rests))
    blocks = large.select("path", "id", "comp", is_main.alias("is_main"), block.alias("block"), mains.alias("mains"), rests.alias("rests"))
    ours, others = F.lit(True), F.lit(False)

    def up_to(n: str) -> Column:
        return F.sequence(F.lit(0).cast("long"), F.col(n) - 1)

    with_rest = F.transform(up_to("rests"), lambda r: F.xxhash64("path", ours, "block", r))
    with_main = F.transform(up_to("mains"), lambda m: F.xxhash64("path", ours, m, "block"))
    among = F.transform(up_to("rests"), lambda r: F.xxhash64("path", others, F.least("block", r), F.greatest("block", r)))
    return blocks.select(F.explode(F.when(F.col("is_main"), with_rest).otherwise(F.concat(with_main, among))).alias("group"), "id", "comp")


def verify(df: DataFrame, sets: DataFrame, comps: DataFrame, counts: DataFrame, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """(id, root, links) from exact comparison of all sets of each component.

    ``links`` counts a set's partners in one block, copies included; ``root`` is a
    set it is connected to.
    """
    sizes = comps.groupBy("root").agg(F.count("*").alias("n"))
    blocks = F.ceil(F.col("n") / HALF).cast("int")
    block = F.when(F.col("n") <= BLOCK, 0).otherwise(F.pmod(F.xxhash64("node"), blocks)).cast("int")
    members = comps.join(sizes, "root").select(F.col("node").alias("id"), "root", block.alias("block"), F.when(F.col("n") <= BLOCK, 1).otherwise(blocks).alias("blocks"))
    members = members.join(sets.select("id", "key"), "id").join(counts.select("key", "n_copies"), "key")
    texts = df.where(F.col(text_col).isNotNull()).select(text_key(F.col(text_col)).alias("key"), F.col(text_col).alias("text"))
    # One text of each key: the rank filter is applied before the shuffle too.
    nth = F.row_number().over(Window.partitionBy("key").orderBy("key"))
    single = texts.withColumn("nth", nth).where("nth = 1").drop("nth")
    held = single.join(members, "key")

    def make_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, made in _slices_of_sets(batches):
            shingles = pa.array([s.view(np.int64) for s in made], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("id", "root", "block", "blocks", "n_copies")), shingles], ["id", "root", "block", "blocks", "n_copies", "shingles"])

    made = held.select("id", "root", "block", "blocks", "n_copies", "text").mapInArrow(make_sets, "id long, root long, block int, blocks int, n_copies long, shingles array<long>")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    spread = made.select("id", "n_copies", "block", "root", "shingles", other)
    rows = spread.select(F.xxhash64("root", F.least("block", "other"), F.greatest("block", "other")).alias("group"), "id", "n_copies", "block", "shingles")

    def work(table: pa.Table, groups: np.ndarray) -> Iterator[pa.RecordBatch]:
        bounds = np.append(np.flatnonzero(np.append(True, groups[1:] != groups[:-1])), len(groups))
        lists = table.column("shingles").chunk(0)
        offsets, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
        ids, copies, block = (table.column(c).to_numpy() for c in ("id", "n_copies", "block"))
        root, links = np.arange(len(groups)), np.zeros(len(groups), np.int64)
        for begin, end in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            near = _similar(flat[offsets[begin]:offsets[end]], np.diff(offsets[begin:end + 1]), threshold)
            side = block[begin:end]
            if side.min() != side.max():  # two blocks: pairs across only
                near &= side[:, None] != side[None, :]
            links[begin:end] = near @ copies[begin:end]
            root[begin:end] = begin + _merge(np.arange(end - begin), *np.nonzero(near))
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(ids[root]), pa.array(links)], ["id", "root", "links"])

    dealt = rows.repartition("group").sortWithinPartitions("group")
    return dealt.mapInArrow(lambda batches: _groups(batches, work), "id long, root long, links long")


def _similar(flat: np.ndarray, sizes: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs of sets reach the threshold, exactly; none with itself."""
    n = len(sizes)
    if n == 2:
        common = len(flat) - len(np.unique(flat))
        near = common >= threshold * (len(flat) - common)
        return np.array([[False, near], [near, False]])
    owner = np.repeat(np.arange(n), sizes)
    _, token, times = np.unique(flat, return_inverse=True, return_counts=True)
    shared = times[token] > 1
    token, owner = np.cumsum(times > 1)[token[shared]] - 1, owner[shared]
    order = np.argsort(token, kind="stable")
    token, owner = token[order], owner[order]
    common = np.zeros((n, n), np.float32)
    width = 8192
    for low in range(0, int(token[-1]) + 1 if len(token) else 0, width):
        part = slice(*np.searchsorted(token, (low, low + width)))
        has = np.zeros((n, width), np.float32)
        has[owner[part], token[part] - low] = 1
        common += has @ has.T
    union = sizes[:, None] + sizes[None, :] - common.astype(np.float64)
    near = common >= threshold * union
    np.fill_diagonal(near, False)
    return near


def text_classes(df: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, has_words, class_id, is_first, n_links) of every different text.

    ``is_first`` marks the text of a class that holds its least document id.
    """
    keyed = df.select(text_key(F.col(text_col)).alias("key"), F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).rlike(r"[^\x20\x09-\x0D]").alias("has_words"))
    counts = cut(keyed.groupBy("key").agg(F.count("*").alias("n_copies"), F.min("doc_id").alias("doc_id"), F.first("has_words").alias("has_words")))
    runs = runs_needed()
    # The numbers are written with the sets, so they stay what they are.
    sets = cut(signatures(df, runs, text_col).withColumn("id", F.monotonically_increasing_id()))
    early = cut(first_round(sets))
    late = compare_sketches(path_groups(sets, components(early), runs))
    found = cut(components(early.union(late)))
    checked = cut(verify(df, sets, found, counts, threshold, text_col))
    links = checked.groupBy("id").agg(F.sum("links").alias("links"))
    roots = components(checked.select(F.col("id").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "id")
    linked = sets.select("key", "id").join(links, "id", "left").join(roots, "id", "left").select("key", "links", F.coalesce("root", "id").alias("class_key"))
    n_links = F.when(F.col("has_words"), F.coalesce("links", F.lit(0)) + F.col("n_copies") - 1).otherwise(0)
    rows = cut(counts.join(linked, "key", "left").select("key", "doc_id", "has_words", "class_key", n_links.alias("n_links")))
    firsts = rows.where("has_words").groupBy("class_key").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("first"))
    first = firsts.select("class_key", F.col("first.doc_id").alias("class_id"), F.col("first.key").alias("first_key"))
    return rows.join(first, "class_key", "left").select("key", "has_words", "class_id", (F.col("key") == F.col("first_key")).alias("is_first"), "n_links")


def jaccard_join(df: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, class_id, n_links) of every document."""
    classes = cut(text_classes(df, threshold, id_col, text_col))
    keyed = df.select(F.col(id_col).cast("long").alias("doc_id"), text_key(F.col(text_col)).alias("key"))
    own = F.when(F.col("has_words"), F.col("class_id")).otherwise(F.col("doc_id"))
    return keyed.join(classes, "key").select("doc_id", own.alias("class_id"), "n_links")


def keep_one_per_class(df: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df``, all columns, that hold the least id of their class.

    Of rows that tie one stays, by a hash of all columns. Rows without words all stay.
    Copies of a text are thinned to one before they are shuffled, by the rank filter.
    """
    kept = cut(text_classes(df, threshold, id_col, text_col).where("is_first").select(F.col("key").alias("kept")))
    rows = df.select(F.struct("*").alias("row"), F.coalesce(F.col(text_col).rlike(r"[^\x20\x09-\x0D]"), F.lit(False)).alias("has_words"))
    worded = rows.where("has_words").select("row", text_key(F.col(f"row.{text_col}")).alias("key"))
    order = Window.partitionBy("key").orderBy(F.col(f"row.{id_col}").asc_nulls_last(), F.xxhash64("row"))
    single = worded.withColumn("nth", F.row_number().over(order)).where("nth = 1")
    stay = single.join(kept, single["key"] == kept["kept"]).select("row")
    return stay.union(rows.where("not has_words").select("row")).select("row.*")
