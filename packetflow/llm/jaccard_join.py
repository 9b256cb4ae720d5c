"""Documents linked by the Jaccard similarity of their word n-grams, found with prefix trees.

1. *Count.* Every different set of n-grams sends each n-gram once to the shard of its hash. A shard
   learns in how many sets an n-gram occurs and passes on those in two or more; an n-gram of a
   single set can not be in an overlap, only its number matters.
2. *Order and cut.* The global order is by that number, then by hash, rarest first. Sets that reach
   the threshold share an n-gram among the first ``n - ceil(t n) + 1`` of each. A set whose rare
   n-grams fill that prefix alone can not be linked and leaves.
3. *Gather.* Sets that share an n-gram of their prefixes are one group (connected components in
   Spark). A group that is too large for a task is cut into blocks, and each pair of blocks is a
   task, so no link is lost.
4. *Join.* A task stores its sets in a prefix tree and walks it once for each set: the overlap with
   a shared path is counted once, and a subtree is left as soon as what remains of the set and of
   the tree can not bring the overlap that its smallest set would need. Branches too short to be
   worth a step each are counted together. All links are found, each pair in one task; the task
   returns a forest of them and the number of links of each set, not all pairs.

Equal sets are one set throughout, so copies cost nothing but their row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from packetflow.llm.common import (
    by_shard,
    chunks,
    grouped_arrow,
    hash_words,
    joined,
    map_arrow,
    mixed,
    runs,
    shard_bits,
    split_words,
    window_hashes,
    window_starts,
)
from packetflow.llm.components import components
from packetflow.operators.joins import in_key_set
from packetflow.session import shared_dir, work_dir

#: N-grams of the sets in one task of the join; a larger group is cut into blocks.
TASK_NGRAMS = 4_000_000

#: Ids that are broadcast to leave out documents (about 24 MB); more are joined by id.
BROADCAST_IDS = 1_000_000

#: N-grams of neighbouring sets that the walk of a tree counts in one step.
STEP_NGRAMS = 1 << 14

_MEMBERS = pa.schema([("doc_id", pa.int64()), ("set", pa.int64()), ("n", pa.int64())])
_MEMBERS_SQL = "doc_id long, set long, n long"
_PARTS = pa.schema(
    [("shard", pa.int32())] + [(name, pa.binary()) for name in ("sets", "sizes", "counts", "grams")]
)
_PARTS_SQL = "shard int, sets binary, sizes binary, counts binary, grams binary"


def shingle_sets(text: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The n-grams of every text, different and sorted; their numbers; a hash of each set.

    A text of fewer words is one n-gram, which equals no longer one. A text without words has none,
    and 0 for its set.
    """
    words = split_words(text)
    hashes = hash_words(words.words)[words.codes] if len(words.codes) else np.zeros(0, np.uint64)
    counts = words.counts
    starts, texts = window_starts(words, width)
    grams = window_hashes(hashes, starts, width)
    ends = np.cumsum(np.bincount(texts, minlength=len(counts)))
    per_text = []
    for i, (end, count) in enumerate(zip(ends, counts, strict=True)):
        if count >= width:
            per_text.append(np.unique(grams[end - (count - width + 1) : end]))
        elif count:
            per_text.append(window_hashes(hashes, words.offsets[i : i + 1], int(count)))
        else:
            per_text.append(np.zeros(0, np.uint64))
    sizes = np.fromiter(map(len, per_text), np.int64, len(per_text))
    flat = np.concatenate(per_text) if per_text else np.zeros(0, np.uint64)
    total = np.zeros(len(sizes), np.uint64)
    full = sizes > 0
    if full.any():
        begins = (np.cumsum(sizes) - sizes)[full]
        total[full] = mixed(np.add.reduceat(mixed(flat), begins) + sizes[full].astype(np.uint64))
    return flat, sizes, total


def _members(width: int):
    """The set of every document and its size."""

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches):
            _, sizes, sets = shingle_sets(chunk.column("text"), width)
            ids = chunk.column("doc_id")
            yield pa.RecordBatch.from_arrays([ids, sets.view(np.int64), sizes], schema=_MEMBERS)

    return members


def _deal(width: int, bits: int):
    """The n-grams of every set, once for each chunk, to the shards of their hashes."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches):
            grams, sizes, sets = shingle_sets(chunk.column("text"), width)
            first = np.zeros(len(sizes), bool)
            first[np.unique(sets, return_index=True)[1]] = True
            owner = np.repeat(np.arange(len(sizes)), sizes)
            chosen = first[owner]
            owner, grams = owner[chosen], grams[chosen]
            for shard, at in by_shard((grams >> np.uint64(64 - bits)).astype(np.int32)):
                begins = runs(owner[at])
                held = owner[at][begins[:-1]]
                yield pa.RecordBatch.from_pylist(
                    [{"shard": shard, "sets": sets[held].tobytes(),
                      "sizes": sizes[held].astype(np.uint32).tobytes(),
                      "counts": np.diff(begins).astype(np.uint32).tobytes(),
                      "grams": grams[at].tobytes()}],
                    _PARTS,
                )

    return deal


_SHARED = pa.schema(
    [("shard", pa.int32())] + [(name, pa.binary()) for name in ("sets", "sizes", "grams", "df")]
)
_SHARED_SQL = "shard int, sets binary, sizes binary, grams binary, df binary"


def _shared(bits: int):
    """Of one shard: n-grams of two or more sets, with their number, by shard of the set."""

    def shared(group: pa.Table) -> pa.Table:
        counts = joined(group.column("counts"), np.uint32)
        grams = joined(group.column("grams"), np.uint64)
        row = np.repeat(np.arange(len(counts)), counts)
        order = np.argsort(grams)
        grams, row = grams[order], row[order]
        bounds = runs(grams)
        several = np.repeat(np.diff(bounds) > 1, np.diff(bounds))
        grams, row = grams[several], row[several]
        sets = joined(group.column("sets"), np.uint64)[row]
        sizes = joined(group.column("sizes"), np.uint32)[row]
        order = np.lexsort((sets, grams))
        grams, sets, sizes = grams[order], sets[order], sizes[order]
        new = np.ones(len(grams), bool)
        new[1:] = (grams[1:] != grams[:-1]) | (sets[1:] != sets[:-1])
        grams, sets, sizes = grams[new], sets[new], sizes[new]
        found = np.diff(runs(grams))
        df = np.repeat(found, found)
        keep = df > 1
        grams, sets, sizes, df = grams[keep], sets[keep], sizes[keep], df[keep]
        rows = [
            {"shard": shard, "sets": sets[at].tobytes(), "sizes": sizes[at].tobytes(),
             "grams": grams[at].tobytes(), "df": df[at].astype(np.uint32).tobytes()}
            for shard, at in by_shard((sets >> np.uint64(64 - bits)).astype(np.int32))
        ]
        return pa.Table.from_pylist(rows, _SHARED)

    return shared


_ALIVE = pa.schema(
    [("set", pa.int64()), ("n", pa.int64()), ("shared", pa.int64()), ("grams", pa.binary()),
     ("df", pa.binary()), ("prefix", pa.list_(pa.int64()))]
)
_ALIVE_SQL = "set long, n long, shared long, grams binary, df binary, prefix array<long>"


def _alive(threshold: int):
    """Of one shard of sets: those whose prefix has an n-gram of other sets, in the global order."""

    def alive(group: pa.Table) -> pa.Table:
        sets, sizes, grams, df = (
            joined(group.column(name), kind)
            for name, kind in zip(
                ("sets", "sizes", "grams", "df"),
                (np.uint64, np.uint32, np.uint64, np.uint32),
                strict=True,
            )
        )
        order = np.lexsort((grams, df, sets))
        sets, sizes, grams, df = sets[order], sizes[order], grams[order], df[order]
        bounds = runs(sets)
        rows = []
        for begin, end in zip(bounds[:-1], bounds[1:], strict=True):
            n = int(sizes[begin])
            prefix = n - -(-threshold * n // 100) + 1 - (n - (end - begin))
            if prefix > 0:
                rows.append(
                    {"set": int(sets[begin].view(np.int64)), "n": n, "shared": int(end - begin),
                     "grams": grams[begin:end].tobytes(), "df": df[begin:end].tobytes(),
                     "prefix": grams[begin : begin + prefix].view(np.int64)}
                )
        return pa.Table.from_pylist(rows, _ALIVE)

    return alive


class _Node:
    """A path of n-grams that the sets ``low`` to ``high`` (not included) have in common.

    Without children it is a set, or neighbouring sets that are counted together.
    """

    __slots__ = ("children", "depth", "high", "longest", "low", "smallest", "start")

    def __init__(self, low: int, high: int, start: int, depth: int, sets, sizes):
        self.low, self.high, self.start, self.depth = low, high, start, depth
        self.children: list[_Node] = []
        self.smallest = min(sizes[low:high])
        self.longest = max(len(sets[i]) for i in range(low, high))


def _grow(sets: list[np.ndarray], sizes: list[int], step: int) -> _Node:
    """The prefix tree of sets in sorted order, single paths joined into one node.

    Neighbouring branches of at most ``step`` n-grams in all are one node without children.
    """
    common = [0] * (len(sets) + 1)  # with the set before
    for i in range(1, len(sets)):
        short = min(len(sets[i - 1]), len(sets[i]))
        differ = np.flatnonzero(sets[i - 1][:short] != sets[i][:short])
        common[i] = int(differ[0]) if len(differ) else short
    ends = np.cumsum([0, *map(len, sets)]).tolist()
    root = _Node(0, len(sets), 0, min(common[1 : len(sets)], default=len(sets[0])), sets, sizes)
    todo = [root]
    while todo:
        node = todo.pop()
        if node.high - node.low == 1 or ends[node.high] - ends[node.low] <= step:
            continue
        cuts = [node.low, *(i for i in range(node.low + 1, node.high) if common[i] == node.depth), node.high]
        at = 0
        while at < len(cuts) - 1:
            low, last = cuts[at], at + 1
            while last < len(cuts) - 1 and ends[cuts[last + 1]] - ends[low] <= step:
                last += 1
            high = cuts[last]
            if last > at + 1:
                depth = node.depth
            else:
                depth = len(sets[low]) if high - low == 1 else min(common[low + 1 : high])
            child = _Node(low, high, node.depth, depth, sets, sizes)
            node.children.append(child)
            if last == at + 1:
                todo.append(child)
            at = last
    return root


def tree_joins(
    grams: list[np.ndarray], df: list[np.ndarray], sizes: list[int], threshold: int,
    copies: list[int], blocks: list[int] | None = None, step: int = STEP_NGRAMS,
    count: bool = True,
) -> tuple[list[tuple[int, int]], np.ndarray]:
    """A forest of links and, of every position, the number of its links.

    The forest has pairs of positions that join all linked sets into groups, at most one less than
    the sets. ``grams`` are the n-grams that a set may share, in the global order, ``sizes`` the
    whole sizes. A link counts as often as the other set has ``copies``. With ``blocks`` only links
    between sets of different blocks are looked for. Without ``count``, sets that are in one group
    already are not compared, so a large group of near copies is not looked through pair by pair.
    """
    degrees = np.zeros(len(sizes), np.int64)
    if len(sizes) < 2:
        return [], degrees
    flat, numbers = np.concatenate(grams), np.concatenate(df)
    ranked = np.lexsort((flat, numbers))
    new = np.ones(len(flat), bool)
    new[1:] = flat[ranked][1:] != flat[ranked][:-1]
    rank = np.empty(len(flat), np.int64)
    rank[ranked] = np.cumsum(new) - 1
    parts = np.split(rank, np.cumsum([len(g) for g in grams])[:-1])
    order = np.array(sorted(range(len(parts)), key=lambda i: parts[i].astype(">i8").tobytes()))
    sets, sizes = [parts[i] for i in order], np.asarray(sizes, np.int64)[order]
    weights = np.asarray(copies, np.int64)[order]
    block = None if blocks is None else np.asarray(blocks)[order]
    root = _grow(sets, sizes.tolist(), step)
    rank = np.concatenate(sets)
    ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    group = np.arange(len(sets))
    inside = np.zeros(int(new.sum()) + 1, bool)
    links = []
    for i, own in enumerate(sets):
        size = int(sizes[i])
        inside[own] = True
        todo = [(root, 0)]
        found = []
        while todo:
            node, overlap = todo.pop()
            if node.high <= i + 1:
                continue
            if not count and (group[max(node.low, i + 1) : node.high] == group[i]).all():
                continue
            rest = len(own)
            if node.depth:
                path = sets[node.low][node.start : node.depth]
                overlap += int(np.count_nonzero(inside[path])) if len(path) else 0
                rest -= int(np.searchsorted(own, sets[node.low][node.depth - 1], "right"))
            most = overlap + min(rest, node.longest - node.depth)
            # 100 o >= t (a + b - o)
            if (100 + threshold) * most < threshold * (size + node.smallest):
                continue
            if node.children:
                todo.extend((child, overlap) for child in node.children)
                continue
            low = max(node.low, i + 1)
            shared = np.concatenate([[0], np.cumsum(inside[rank[ends[low] : ends[node.high]]])])
            overlaps = np.diff(shared[ends[low : node.high + 1] - ends[low]])
            linked = (100 + threshold) * overlaps >= threshold * (size + sizes[low : node.high])
            if block is not None:
                linked &= block[low : node.high] != block[i]
            found.append(low + np.flatnonzero(linked))
        inside[own] = False
        partners = np.concatenate(found) if found else np.zeros(0, np.int64)
        if not len(partners):
            continue
        degrees[order[i]] += weights[partners].sum()
        degrees[order[partners]] += weights[i]
        others, first = np.unique(group[partners], return_index=True)
        joins = others != group[i]
        if joins.any():
            links.extend((int(order[i]), int(order[j])) for j in partners[first[joins]])
            group[np.isin(group, others[joins])] = group[i]
    return links, degrees


def tree_links(
    grams: list[np.ndarray], df: list[np.ndarray], sizes: list[int], threshold: int
) -> list[tuple[int, int]]:
    """The forest of :func:`tree_joins`."""
    return tree_joins(grams, df, sizes, threshold, [1] * len(sizes))[0]


_LINKS = pa.schema([("left", pa.int64()), ("right", pa.int64()), ("links", pa.int64())])
_LINKS_SQL = "left long, right long, links long"


def _join(threshold: int, count: bool):
    """Links, and, if they are to be counted, of each set that has some their number under ``left`` with a null ``right``."""

    def join(group: pa.Table) -> pa.Table:
        group = group.sort_by("set")
        sets = group.column("set").to_numpy()
        grams = [np.frombuffer(x, np.uint64) for x in group.column("grams").to_pylist()]
        df = [np.frombuffer(x, np.uint32) for x in group.column("df").to_pylist()]
        task = group.column("task")[0].as_py()
        blocks = group.column("own").to_numpy() if task["low"] != task["high"] else None
        links, degrees = tree_joins(
            grams, df, group.column("n").to_pylist(), threshold, group.column("copies").to_pylist(),
            blocks, count=count,
        )
        found = np.flatnonzero(degrees if count else degrees[:0])
        left = np.concatenate([sets[[a for a, _ in links]], sets[found]])
        right = pa.array([int(sets[b]) for _, b in links] + [None] * len(found), pa.int64())
        number = pa.array([None] * len(links) + degrees[found].tolist(), pa.int64())
        return pa.table([pa.array(left, pa.int64()), right, number], schema=_LINKS)

    return join


def _tasks(alive: DataFrame, groups: DataFrame, limit: int) -> DataFrame:
    """Every set under the key of each task that needs it: its group, or pairs of its blocks.

    A task of two blocks is for the links between them, those inside a block have their own.
    """
    load = (
        alive.select("set", "shared").join(groups, "set")
        .groupBy("component").agg(F.sum("shared").alias("load"), F.count("*").alias("sets"))
        .filter("sets > 1")
        .select("component", F.ceil(F.col("load") * 2 / limit).cast("int").alias("blocks"))
    )
    blocks = F.when(F.col("blocks") > 2, F.col("blocks")).otherwise(1)
    own = F.pmod(F.xxhash64("set"), blocks)
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    placed = groups.join(load, "component").withColumn("blocks", blocks).withColumn("own", own)
    low, high = F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high")
    pair = F.struct("component", low, high)
    keys = placed.withColumn("other", other).select("set", "own", pair.alias("task"))
    return alive.join(keys, "set")


def _labelled(
    docs: DataFrame, width: int, threshold: int, doc_id: str = "doc_id", text: str = "text",
    task_ngrams: int = TASK_NGRAMS, count_links: bool = True,
) -> DataFrame:
    """``doc_id, set, n, component_id, n_links`` of every row, and the smallest set of its component.

    That is ``component``, which tells components of one name apart; 0 for a text without words.
    ``n_links`` counts copies only where links are not counted.
    """
    spark = docs.sparkSession
    base = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    bits = shard_bits(base)
    folder = work_dir(spark, "jaccard-join")
    map_arrow(base, _members(width), _MEMBERS_SQL).write.parquet(f"{folder}/members")
    members = spark.read.schema(_MEMBERS_SQL).parquet(f"{folder}/members")
    parts = map_arrow(base.select("text"), _deal(width, bits), _PARTS_SQL)
    shared = grouped_arrow(parts, "shard", _shared(bits), _SHARED_SQL)
    grouped_arrow(shared, "shard", _alive(threshold), _ALIVE_SQL).write.parquet(f"{folder}/alive")
    alive = spark.read.schema(_ALIVE_SQL).parquet(f"{folder}/alive")
    prefixes = alive.select("set", F.explode("prefix").alias("gram"))
    heads = prefixes.groupBy("gram").agg(F.min("set").alias("head"), F.count("*").alias("sets"))
    near = prefixes.join(heads.filter("sets > 1").drop("sets"), "gram")
    groups = components(near.select("set", "head"), "set", "head")
    groups = groups.select(F.col("node").alias("set"), "component")
    different = members.groupBy("set").agg(
        F.min("doc_id").alias("first"), F.count("*").alias("copies")
    )
    counted = alive.drop("prefix").withColumn("copies", F.lit(1).cast("long"))
    if count_links:
        counted = counted.drop("copies").join(different.select("set", "copies"), "set")
    tasks = _tasks(counted, groups, task_ngrams)
    joined_sets = grouped_arrow(tasks, "task", _join(threshold, count_links), _LINKS_SQL).checkpoint()
    classes = components(joined_sets.filter("right IS NOT NULL"), "left", "right")
    degrees = (
        joined_sets.filter("right IS NULL").groupBy(F.col("left").alias("set"))
        .agg(F.sum("links").alias("links"))
    )
    named = different.join(classes.select(F.col("node").alias("set"), "component"), "set", "left")
    named = named.withColumn("component", F.coalesce("component", "set"))
    names = named.groupBy("component").agg(F.min("first").alias("component_id"))
    labels = (
        named.join(names, "component").join(degrees, "set", "left")
        .select(
            "set", "component", "component_id",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        )
    )
    full = members.filter("n > 0").join(labels, "set")
    none = F.lit(0).cast("long")
    empty = members.filter("n = 0").select(
        "doc_id", "set", "n", F.col("set").alias("component"),
        F.col("doc_id").alias("component_id"), none.alias("n_links"),
    )
    return full.select(empty.columns).unionByName(empty)


def linked_documents(
    docs: DataFrame, width: int = 5, threshold: int = 80, doc_id: str = "doc_id",
    text: str = "text", task_ngrams: int = TASK_NGRAMS, count_links: bool = True,
) -> DataFrame:
    """``doc_id, n_shingles, component_id, n_links`` of every row of ``docs``.

    Two documents are linked when their sets of ``width``-grams of lower-cased words have
    ``100 * intersection >= threshold * union``; a component is named by its smallest ``doc_id``.
    A text of fewer words is one n-gram. A null, empty or blank text has no n-gram and no links. A
    row with a null id takes part and gets the component of its links, null if there is none with
    an id. Rows that repeat an id are documents of their own with that id. ``n_links`` is the
    number of other documents (rows) that a document is linked to, its copies among them; to count
    them takes work that grows with the square of a group, so without ``count_links`` there is no
    such column. Other columns of ``docs`` play no part.
    """
    found = _labelled(docs, width, threshold, doc_id, text, task_ngrams, count_links)
    columns = ["doc_id", F.col("n").alias("n_shingles"), "component_id"]
    return found.select(*columns, *(["n_links"] if count_links else []))


def _with_set(width: int, names: list[str]):
    """The columns of a row and its set."""

    def with_set(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches):
            _, _, sets = shingle_sets(chunk.column("text"), width)
            columns = [*chunk.columns, pa.array(sets.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names)

    return with_set


def one_of_each(docs: DataFrame, width: int = 5, threshold: int = 80) -> DataFrame:
    """The columns of ``docs``, with one document of each component: that of the smallest id.

    Rows that repeat an id are linked or not by their texts; of those that carry the kept id one
    stays for each component, so different texts under one id all stay. Rows of one id without any
    word are one document. Rows without an id are kept, since no result can name them.
    """
    shared_dir(docs.sparkSession)
    found = _labelled(docs, width, threshold, count_links=False)
    found = found.drop("n", "n_links").checkpoint()
    # few ids go, and few are repeated: the texts of the others are not moved
    repeated = found.groupBy("doc_id").count().filter("count > 1").select("doc_id")
    gone = found.filter("component_id <> doc_id").select("doc_id").unionByName(repeated)
    known = {"max_broadcast": BROADCAST_IDS, "unique": True}  # or nearly so
    single = in_key_set(docs, gone, "doc_id", ["text"], keep_members=False, **known)
    # of repeated ids: a set for each component that is named by the id, then a row for each set
    first = (
        found.filter("doc_id = component_id").join(repeated, "doc_id")
        .groupBy("doc_id", "component").agg(F.min("set").alias("__set"))
    )
    several = in_key_set(docs, first, "doc_id", ["text"]).select(*[f"`{c}`" for c in docs.columns])
    schema = StructType([*docs.schema.fields, StructField("__set", LongType())])
    several = map_arrow(several, _with_set(width, schema.names), schema)
    key = F.struct(F.col("doc_id").cast("long").alias("doc_id"), "__set").alias("__key")
    several = in_key_set(several.withColumn("__key", key), first.select(key), "__key", ["text"])
    window = Window.partitionBy("doc_id", "__set").orderBy(F.xxhash64("text"), F.col("text"))
    several = several.withColumn("__number", F.row_number().over(window)).filter("__number = 1")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return single.select(*columns).unionByName(several.select(*columns))
