"""The prefix trie of conversations as a burst trie.

A node is a distinct sequence of first turns. A container holds the suffixes of
all conversations that share a head, a node of the trie. All begin in the
container of the root. Containers with too many turns burst: the turns that all
their suffixes share become their head, and the next turn id of each suffix
names its new container. What is small enough is sorted, container by container
within shards, and swept into nodes once. Containers of one distinct suffix are a
chain and need no sweep, however long it is.

Nodes with one child share their members, so heads, sweeps and chains give
*edges*: runs of nodes from one depth to another. The nodes of an edge are the
turns of its smallest member at these depths, joined back in the end. Sums over
subtrees go up from the last burst to the first.

Nothing holds a conversation or the members of a node whole: turns are numbered
in ranges of the total order, equal conversations count as one with copies, only
suffixes of containers below ``most_turns`` become arrays, and the digest of the
members that end in a node reads their ids as a sorted stream.

Turns and conversations are known by 128-bit hashes.

Defined cases: turns go by turn (null first), then role and text; a null role or
text is empty; repeated rows are turns of their own; rows without a conv_id
belong to no conversation; ids are integers, negative ones too; an empty table has no
node, not even a root; extra columns are ignored whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tidemark.llm.ordering import placed
from tidemark.scratch import Shelf, stored

WORDS = r"[^\x20\x09-\x0D]+"
MOST_TURNS = 4096
_IDS_PER_CHUNK = 1 << 14

_TURN = ("turn_id", "words", "before")


def turns(df: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv, place, turn_id, words, before) per row: its place in its conversation and the words before it."""
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = df.select(
        F.col(id_col).cast("long").alias("conv"),
        F.col(turn_col).alias("turn"),
        empty(role_col).alias("role"),
        empty(text_col).alias("text"),
    ).where("conv is not null")
    conv, turn = F.col("conv"), F.asc_nulls_first("turn")
    ranges = [conv, turn, F.substring("role", 1, 16), F.substring("text", 1, 64)]
    turn_id = F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")))
    rows = _sorted(rows, ranges, [conv, turn, F.col("role"), F.col("text")], turn_id)
    first = rows.groupBy("conv").agg(F.min("row").alias("_first"), F.min("words_before").alias("_words"))
    numbered = rows.join(first, "conv")
    return numbered.select(
        "conv",
        (F.col("row") - F.col("_first") + 1).alias("place"),
        "turn_id",
        "words",
        (F.col("words_before") - F.col("_words")).alias("before"),
    )


def _sorted(rows: DataFrame, ranges: list[Column], order: list[Column], turn_id: Column) -> DataFrame:
    """(conv, turn_id, words, row, words_before) with running totals over all rows in their order."""
    slim = lambda df: df.select(
        "conv", turn_id.alias("turn_id"), F.regexp_count("text", F.lit(WORDS)).cast("long").alias("words"), "_row_in_task"
    )
    kept = placed(rows, ranges, order, "row", "turns", slim)
    # words by stretches of rows, then within a stretch: no task sees more than one stretch
    stretch = F.col("row").bitwiseAND(F.lit(~0xFFFF))
    sums = kept.groupBy(stretch.alias("_stretch")).agg(F.sum("words").alias("_sum"))
    ahead = Window.orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("_stretch", F.coalesce(F.sum("_sum").over(ahead), F.lit(0)).alias("_ahead"))
    inner = Window.partitionBy("_stretch").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    own = kept.withColumn("_stretch", stretch).withColumn("_inner", F.coalesce(F.sum("words").over(inner), F.lit(0)))
    out = own.join(sums, "_stretch").withColumn("words_before", F.col("_ahead") + F.col("_inner"))
    return out.select("conv", "turn_id", "words", "row", "words_before")


def conversations(numbered: DataFrame) -> DataFrame:
    """(conv, depth, turn_id, words, before) of conversations as they are; depth 0 is the textless root."""
    roots = numbered.select("conv").distinct()
    return _rooted(roots, numbered.select("conv", F.col("place").alias("depth"), *_TURN))


def _rooted(convs: DataFrame, rows: DataFrame) -> DataFrame:
    zero = F.lit(0).cast("long")
    roots = convs.select("conv", zero.alias("depth"), F.lit(b"").alias("turn_id"), zero.alias("words"), zero.alias("before"))
    return roots.unionByName(rows.withColumn("depth", F.col("depth").cast("long")))


def regrafted(numbered: DataFrame, every: int = 20, most: int = 4) -> DataFrame:
    """``conversations`` with new openings: the first h turns of c come from conversation c - c % ``every``.

    h is the checksum of the id modulo ``most``. The other conversation gives
    all its turns where it has fewer, none where it does not exist; c goes on
    after its own first h turns.
    """
    opening = F.struct("place", *_TURN)
    head = numbered.where(F.col("place") < most).groupBy("conv").agg(F.sort_array(F.collect_list(opening)).alias("lead"))
    count = numbered.groupBy("conv").agg(F.count(F.lit(1)).alias("n_turns"))
    convs = count.join(head, "conv")
    h = (F.crc32(F.col("conv").cast("string").cast("binary")) % most).cast("int")
    convs = convs.withColumns({"h": h, "_from": F.col("conv") - F.col("conv") % every})
    lender = convs.select(F.col("conv").alias("_from"), F.col("lead").alias("_lent"))
    convs = convs.join(lender, "_from", "left")
    words = lambda turns: F.aggregate(turns, F.lit(0).cast("long"), lambda s, t: s + t["words"])
    lent = F.coalesce(F.slice("_lent", F.lit(1), F.col("h")), F.slice("lead", 1, 0))
    convs = convs.withColumn("_lent", lent).withColumn("_left", F.slice("lead", F.lit(1), F.col("h")))
    convs = convs.select(
        "conv", "h", "_lent", F.size("_lent").alias("_more"), (words("_lent") - words("_left")).alias("_shift")
    )
    convs = stored(convs, "openings")
    openings = convs.select("conv", F.explode("_lent").alias("t")).select("conv", F.col("t.place").alias("depth"), "t.*")
    own = numbered.join(convs.drop("_lent"), "conv").where("place > h")
    own = own.withColumns({"depth": F.col("place") - F.col("h") + F.col("_more"), "before": F.col("before") + F.col("_shift")})
    columns = ("conv", "depth", *_TURN)
    return _rooted(convs, openings.select(*columns).unionByName(own.select(*columns)))


# -- equal conversations --------------------------------------------------------


def _classes(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rep, len, copies, total): distinct sequences named by their smallest conversation; and (conv, rep) of all."""
    marks = [F.bit_xor(F.xxhash64(F.lit(seed), "depth", "turn_id")).alias(f"_x{seed}") for seed in (1, 2)]
    each = rows.groupBy("conv").agg(F.max("depth").alias("len"), F.sum("words").alias("total"), *marks)
    each = stored(each, "sequences")
    key = ["len", "_x1", "_x2"]
    classes = each.groupBy(*key).agg(
        F.min("conv").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("total").alias("total")
    )
    classes = stored(classes, "classes")
    copied = classes.where("copies > 1").select(*key, "rep")
    return classes.drop("_x1", "_x2"), each.join(copied, key).select("rep", "conv")


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted ids of each class as comma lists, in pieces."""
    rep, held = None, []

    def piece() -> pa.RecordBatch:
        joined = ",".join(map(str, held)).encode()
        return pa.record_batch(
            {"rep": pa.array([rep], pa.int64()), "first": pa.array(held[:1], pa.int64()), "ids": pa.array([joined], pa.binary())}
        )

    for batch in batches:
        for r, conv in zip(batch.column("rep").to_pylist(), batch.column("conv").to_pylist()):
            if held and (r != rep or len(held) == _IDS_PER_CHUNK):
                yield piece()
                held = []
            rep = r
            held.append(conv)
    if held:
        yield piece()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the pieces of each class, which come in order."""
    rep, digest = None, None
    told = lambda: pa.record_batch(
        {"rep": pa.array([rep], pa.int64()), "sha256": pa.array([digest.hexdigest()])}
    )
    for batch in batches:
        for r, ids in zip(batch.column("rep").to_pylist(), batch.column("ids")):
            if digest is not None and r == rep:
                digest.update(b",")
            else:
                if digest is not None:
                    yield told()
                rep, digest = r, hashlib.sha256()
            digest.update(ids.as_py())
    if digest is not None:
        yield told()


def member_digests(classes: DataFrame, members: DataFrame) -> DataFrame:
    """(rep, sha256) of the ids of each class, ascending and joined by commas.

    A digest is one stream by its nature; ids reach it packed, from tasks that
    sort ranges of them.
    """
    one = classes.where("copies = 1").select("rep", F.sha2(F.col("rep").cast("string"), 256).alias("sha256"))
    spread = members.repartitionByRange("rep", "conv").sortWithinPartitions("rep", "conv")
    pieces = spread.mapInArrow(_chunks, "rep long, first long, ids binary")
    streams = pieces.repartition("rep").sortWithinPartitions("rep", "first")
    return one.unionByName(streams.mapInArrow(_digests, "rep long, sha256 string"))


# -- bursts ---------------------------------------------------------------------

_EDGE = (
    "conv long, low long, high long, parent long, up_conv long, up_low long, n_convs long, n_children long, "
    "n_leaves long, below long, upto long, ends long, saved long"
)
_EDGE_NAMES = [c.split()[0] for c in _EDGE.split(", ")]


def _burst(shelf: Shelf, state: DataFrame, big: DataFrame, rows: DataFrame, level: int) -> tuple[DataFrame, DataFrame]:
    """Heads of the big containers, and their suffixes in new containers."""
    name = ["c_conv", "c_low"]
    inside = shelf.put(state.join(big, name), "bursting")
    turn_rows = rows.withColumnRenamed("conv", "rep")
    held = turn_rows.join(inside.select(*name, "rep", "n_classes"), "rep").where("depth >= c_low")
    by_depth = held.groupBy(*name, "depth", "n_classes").agg(
        F.count(F.lit(1)).alias("n"), F.min("turn_id").alias("_lo"), F.max("turn_id").alias("_hi")
    )
    parts = F.min(F.when((F.col("n") < F.col("n_classes")) | (F.col("_lo") != F.col("_hi")), F.col("depth")))
    shared = shelf.put(by_depth.groupBy(*name).agg((parts - 1).alias("high")), "shared")
    at_end = inside.select(*name, "rep", "begun", "up_conv", "up_low", "copies", "len").join(shared, name)
    last = turn_rows.join(at_end.select("rep", "high", "c_conv"), "rep").where("rep = c_conv and depth = high")
    last = last.select(F.col("rep").alias("c_conv"), "high", (F.col("before") + F.col("words")).alias("upto"))
    heads = at_end.groupBy(*name, "high", "up_conv", "up_low", "begun").agg(
        F.sum("copies").alias("n_convs"), F.min(F.when(F.col("len") == F.col("high"), F.col("rep"))).alias("ends")
    )
    heads = shelf.put(heads.join(last, ["c_conv", "high"]), f"heads-{level}")
    going = turn_rows.join(at_end.select(*name, "rep", "high"), "rep").where("depth = high + 1")
    going = shelf.put(going.select(*name, "rep", "turn_id", F.col("depth").alias("_low"), F.col("before").alias("_begun")), "going")
    named = going.groupBy(*name, "turn_id").agg(F.min("rep").alias("_conv"))
    moved = going.join(named, [*name, "turn_id"]).select(
        "rep",
        F.col("_conv").alias("c_conv"),
        F.col("_low").alias("c_low"),
        F.col("c_conv").alias("up_conv"),
        F.col("c_low").alias("up_low"),
        F.col("_begun").alias("begun"),
    )
    return heads, moved.join(inside.select("rep", "copies", "len", "total"), "rep")


def _swept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of containers whose suffixes come sorted, one container after the other."""
    name, out = None, []
    stack: list[dict] = []
    before: list[bytes] = []

    def close(floor: int) -> None:
        """Finish the deepest open run down to ``floor`` shared turns."""
        e = stack.pop()
        above = max(floor, stack[-1]["bottom"] if stack else 0)
        begun = e["uptos"][above - 1] if above else name[4]
        low, high = name[1] + above, name[1] + e["bottom"] - 1
        upto = e["uptos"][e["bottom"] - 1]
        saved = e["below"] + (e["n"] - 1) * (upto - begun)
        for child in e["children"]:
            child[3] = e["rep"]
            out.append(child)
        leaves = e["leaves"] or 1
        edge = [e["rep"], low, high, None, None, None, e["n"], len(e["children"]), leaves, e["below"], upto, e["ends"], saved]
        if not above:
            edge[3:6] = name[2], name[2], name[3]
            out.append(edge)
            return
        if not stack or stack[-1]["bottom"] < above:
            stack.append(opened(above, e["uptos"]))
        parent = stack[-1]
        parent["rep"] = e["rep"] if parent["rep"] is None else min(parent["rep"], e["rep"])
        parent["n"] += e["n"]
        parent["leaves"] += leaves
        parent["below"] += saved
        parent["children"].append(edge)

    def opened(bottom: int, uptos: list[int], rep=None, copies: int = 0) -> dict:
        return {"bottom": bottom, "uptos": uptos, "rep": rep, "n": copies, "leaves": 0, "below": 0, "children": [], "ends": rep}

    def told() -> pa.RecordBatch:
        columns = list(zip(*out))
        out.clear()
        return pa.record_batch({c: pa.array(columns[k], pa.int64()) for k, c in enumerate(_EDGE_NAMES)})

    for batch in batches:
        keys = zip(*(batch.column(c).to_pylist() for c in ("c_conv", "c_low", "up_conv", "up_low", "begun")))
        for k, key in enumerate(keys):
            suffix, uptos = batch.column("suffix")[k].as_py(), batch.column("uptos")[k].as_py()
            rep, copies = batch.column("rep")[k].as_py(), batch.column("copies")[k].as_py()
            if key != name:
                while stack:
                    close(0)
                if len(out) > 10_000:
                    yield told()
                name, before = key, []
            shared = next((j for j, (a, b) in enumerate(zip(before, suffix)) if a != b), min(len(before), len(suffix)))
            while stack and stack[-1]["bottom"] > shared:
                close(shared)
            stack.append(opened(len(suffix), uptos, rep, copies))
            before = suffix
    while stack:
        close(0)
    if out:
        yield told()


def edges(rows: DataFrame, classes: DataFrame, most_turns: int = MOST_TURNS) -> DataFrame:
    """Runs of nodes with equal members; ``rows`` are the turns of the classes' representatives."""
    shelf = Shelf(rows.sparkSession)
    name = ["c_conv", "c_low"]
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    least = classes.agg(F.min("rep")).first()[0]
    state = classes.select(
        "rep", F.lit(least).cast("long").alias("c_conv"), zero.alias("c_low"), none.alias("up_conv"), none.alias("up_low"),
        zero.alias("begun"), "copies", "len", "total",
    )
    done, heads = [], []
    while True:
        level = len(heads)
        turns_left = F.sum(F.col("len") - F.col("c_low") + 1).alias("n_turns")
        sizes = state.groupBy(*name).agg(F.count(F.lit(1)).alias("n_classes"), turns_left)
        sizes = shelf.put(sizes, f"sizes-{level}")
        big = sizes.where((F.col("n_classes") > 1) & (F.col("n_turns") > most_turns)).drop("n_turns")
        small = sizes.where(~((F.col("n_classes") > 1) & (F.col("n_turns") > most_turns))).drop("n_turns")
        done.append(shelf.put(state.join(small, name), f"small-{level}"))
        if big.isEmpty():
            break
        head, moved = _burst(shelf, state, big, rows, level)
        heads.append(head)
        state = shelf.put(moved, f"state-{level}")
    settled = reduce(DataFrame.unionByName, done)
    words = F.col("total") - F.col("begun")
    chains = settled.where("n_classes = 1").select(
        F.col("rep").alias("conv"), F.col("c_low").alias("low"), F.col("len").alias("high"), F.col("up_conv").alias("parent"),
        "up_conv", "up_low", F.col("copies").alias("n_convs"), zero.alias("n_children"), F.lit(1).cast("long").alias("n_leaves"),
        zero.alias("below"), F.col("total").alias("upto"), F.col("rep").alias("ends"),
        ((F.col("copies") - 1) * words).alias("saved"),
    )
    several = settled.where("n_classes > 1").drop("n_classes", "len", "total")
    suffix = rows.withColumnRenamed("conv", "rep").join(several, "rep").where("depth >= c_low")
    key = ("c_conv", "c_low", "up_conv", "up_low", "begun", "rep", "copies")
    packed = suffix.groupBy(*key).agg(
        F.sort_array(F.collect_list(F.struct("depth", "turn_id", (F.col("before") + F.col("words")).alias("upto")))).alias("t")
    )
    packed = packed.select(*key, F.col("t.turn_id").alias("suffix"), F.col("t.upto").alias("uptos"))
    shards = packed.repartition(*name).sortWithinPartitions(*name, "suffix")
    found = [shelf.put(chains, "chains"), shelf.put(shards.mapInArrow(_swept, _EDGE), "swept")]
    # sums go up: the containers of the last burst first
    for level in reversed(range(len(heads))):
        tops = reduce(DataFrame.unionByName, found).where("up_conv is not null")
        up = tops.groupBy(F.col("up_conv").alias("c_conv"), F.col("up_low").alias("c_low")).agg(
            F.count(F.lit(1)).alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("below")
        )
        saved = F.col("below") + (F.col("n_convs") - 1) * (F.col("upto") - F.col("begun"))
        head = heads[level].join(up, name).select(
            F.col("c_conv").alias("conv"), F.col("c_low").alias("low"), "high", F.col("up_conv").alias("parent"), "up_conv",
            "up_low", "n_convs", "n_children", "n_leaves", "below", "upto", "ends", saved.alias("saved"),
        )
        found.append(shelf.put(head, f"edges-{level}"))
    return reduce(DataFrame.unionByName, found)


def trie(rows: DataFrame, most_turns: int = MOST_TURNS) -> DataFrame:
    """The nodes of (conv, depth, turn_id, words, before) rows, as ``conversations`` and ``regrafted`` give them.

    Per node: conv_id, its smallest member; depth; parent_conv_id; n_convs;
    n_children; n_leaves and saved_tokens over its subtree; ends_sha256, the
    digest of the members that end there.
    """
    rows = stored(rows, "trie-rows")
    classes, members = _classes(rows)
    reps = classes.select(F.col("rep").alias("conv"))
    rows = rows.join(reps, "conv", "left_semi")
    if classes.isEmpty():
        runs = rows.sparkSession.createDataFrame([], _EDGE)
    else:
        runs = edges(rows, classes, most_turns)
    # a run may be as long as a conversation, so its depths come in steps
    step = 4096
    split = runs.withColumn("_from", F.explode(F.sequence("low", "high", F.lit(step).cast("long"))))
    until = F.least(F.col("high"), F.col("_from") + step - 1)
    nodes = split.withColumn("depth", F.explode(F.sequence("_from", until))).join(
        rows.select("conv", "depth", "before"), ["conv", "depth"]
    )
    last = F.col("depth") == F.col("high")
    nodes = nodes.select(
        F.col("conv").alias("conv_id"),
        "depth",
        F.when(F.col("depth") == F.col("low"), F.col("parent")).otherwise(F.col("conv")).alias("parent_conv_id"),
        "n_convs",
        F.when(last, F.col("n_children")).otherwise(1).cast("long").alias("n_children"),
        "n_leaves",
        (F.col("below") + (F.col("n_convs") - 1) * (F.col("upto") - F.col("before"))).alias("saved_tokens"),
        F.when(last, F.col("ends")).alias("rep"),
    )
    digests = member_digests(classes, members)
    ended = nodes.where("rep is not null").join(digests, "rep")
    open_ = nodes.where("rep is null").withColumn("sha256", F.sha2(F.lit(""), 256))
    return open_.unionByName(ended).drop("rep").withColumnRenamed("sha256", "ends_sha256")
