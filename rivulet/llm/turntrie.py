"""Prefix trie of conversations by adaptive radix trees over fixed-width turn ids.

A turn's id is the first 16 bytes of the SHA-256 of its role and text, so that ids need no
numbering; a conversation's key is the sequence of its ids, big-endian, one after another.
Keys go into adaptive radix trees: inner nodes of 4, 16, 48 or 256 places that are resized as
children arrive, with path compression. Only byte depths at a turn's end are nodes of the trie.

1. Positions come from range slices, so one conversation may hold any share of the rows.
2. A rebuilt conversation is cut into segments of SEGMENT turns. A segment's tree is named by
   what comes before it: the sum of position-bound hashes of the segments before, a running sum
   over slices. Equal segments are counted before they are sorted.
3. Different segments are range partitioned by (tree, key), so a common first turn is spread
   over tasks. A task builds a tree for each run of at most FLUSH keys. Only nodes on the path of
   a run's first or last key can have members in another run: these edges are merged by name,
   all others are done.
4. What lies in later segments is added along the paths of the conversations that own it: the
   smallest member of a node owns it, and with it all that follows on its own path.

NULL ids belong to no conversation. NULL turns come first; rows with the same turn are ordered by
the turn's id. NULL roles and texts are empty. An empty table gives no node.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.llm.tables import settle
from rivulet.operators.ordered import ordered_lists, row_numbers, running_sum

WIDTH = 16
SEGMENT = 64
#: keys that a task holds in trees at once
FLUSH = 1 << 16
FAMILY, SHARES = 5, 9

NODE = (
    "flush long, edge boolean, top boolean, name binary, parent binary, up array<binary>, depth long, bytes long, "
    "n long, conv long, above long, children long, leaves long, saved long, goes_on boolean, far boolean"
)


class Inner:
    """Node of an adaptive radix tree: a compressed path, then children by their next byte.

    Up to 4 and up to 16 children are byte and child lists in order, up to 48 an index of 256
    bytes into a list, beyond that a list of 256.
    """

    __slots__ = ("path", "room", "bytes", "children", "value")

    def __init__(self, path: bytes, value: int | None = None):
        self.path = path
        self.room = 4
        self.bytes: bytearray = bytearray()
        self.children: list[Inner | None] = []
        self.value = value

    def child(self, byte: int) -> Inner | None:
        if self.room <= 16:
            at = self.bytes.find(byte)
            return None if at < 0 else self.children[at]
        if self.room == 48:
            at = self.bytes[byte]
            return self.children[at - 1] if at else None
        return self.children[byte]

    def put(self, byte: int, node: Inner) -> None:
        """Sets the child at a byte, in a larger layout if this one is full."""
        if self.room <= 16:
            at = self.bytes.find(byte)
            if at >= 0:
                self.children[at] = node
                return
            if len(self.children) == self.room:
                self._grow()
                self.put(byte, node)
                return
            at = sum(b < byte for b in self.bytes)
            self.bytes.insert(at, byte)
            self.children.insert(at, node)
        elif self.room == 48:
            if self.bytes[byte]:
                self.children[self.bytes[byte] - 1] = node
            elif len(self.children) < 48:
                self.children.append(node)
                self.bytes[byte] = len(self.children)
            else:
                self._grow()
                self.put(byte, node)
        else:
            self.children[byte] = node

    def _grow(self) -> None:
        if self.room == 4:
            self.room = 16
        elif self.room == 16:
            index = bytearray(256)
            for at, byte in enumerate(self.bytes):
                index[byte] = at + 1
            self.room, self.bytes = 48, index
        else:
            self.children = [self.children[at - 1] if at else None for at in self.bytes]
            self.room, self.bytes = 256, bytearray()

    def below(self) -> list[Inner]:
        """All children."""
        return [c for c in self.children if c is not None]


def common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n  # a[:low] agrees, a[:high] does not
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


class RadixTree:
    """Maps byte strings to row numbers; a key may be the prefix of another."""

    def __init__(self):
        self.root = Inner(b"")

    def insert(self, key: bytes, value: int) -> None:
        node, at = self.root, 0
        above: Inner | None = None
        while True:
            rest = key[at : at + len(node.path)]
            same = common(node.path, rest)
            if same < len(node.path):  # the path splits here
                split = Inner(node.path[:same])
                byte = node.path[same]
                node.path = node.path[same + 1 :]
                split.put(byte, node)
                if above is None:
                    self.root = split
                else:
                    above.put(key[at - 1], split)
                node = split
            at += same
            if at == len(key):
                node.value = value
                return
            below = node.child(key[at])
            if below is None:
                node.put(key[at], Inner(key[at + 1 :], value))
                return
            above, node, at = node, below, at + 1


def node_name(tree: str, level: int, prefix: bytes) -> bytes:
    """Name of the node at a prefix of less than a whole segment; `end_name` is the same in Spark."""
    return hashlib.sha256(f"{tree}:{level}:{prefix.hex()}".encode()).digest()[:WIDTH]


def end_name() -> Column:
    """Name of the node at the end of a segment."""
    text = F.concat_ws(":", "tree", F.col("level").cast("string"), F.lower(F.hex("key")))
    return F.when(F.col("next").isNotNull(), _whole_name(F.col("next"))).otherwise(_short(F.sha2(text, 256)))


def _short(digest: Column) -> Column:
    return F.unhex(F.substring(digest, 1, 2 * WIDTH))


def _whole_name(tree: Column) -> Column:
    return _short(F.sha2(F.concat(F.lit("tree "), tree), 256))


def tree_name(tree: str) -> bytes:
    """Name of the node that a later segment's tree hangs from."""
    return hashlib.sha256(f"tree {tree}".encode()).digest()[:WIDTH]


class Found:
    """What a run holds of one node: members, and sums over the subtree that is complete in the run."""

    __slots__ = ("prefix", "sample", "edge", "top", "n", "conv", "above", "children", "leaves", "saved", "goes_on", "far")

    def __init__(self, prefix: bytes, sample: int, edge: bool, top: bool):
        self.prefix, self.sample, self.edge, self.top = prefix, sample, edge, top
        self.n = self.children = self.leaves = self.saved = 0
        self.conv = self.above = None
        self.goes_on = self.far = False


def trie_nodes(level: int, rows: list[tuple], opens: bool, closes: bool) -> list[Found]:
    """Nodes of the trie of one tree's segments, which come in key order.

    A row is (key, n, conv, sizes, goes_on): a different segment, the number of conversations that
    have it, their smallest id, the bytes of its texts, whether any of them goes on after it.
    """
    radix = RadixTree()
    for at, row in enumerate(rows):
        radix.insert(row[0], at)
    edges = set()
    for one, key in ((opens, rows[0][0]), (closes, rows[-1][0])):
        if one:
            edges.update(key[:cut] for cut in range(0, len(key) + 1, WIDTH))
    out: list[Found] = []

    def emit(depth: int, above: int, held: int | None, sample: int, parts: list[Found]) -> list[Found]:
        """Closes the nodes at turn ends of (above, depth], deepest first; what is left open above them."""
        key = rows[sample][0]
        for cut in range(depth // WIDTH * WIDTH, above, -WIDTH):
            node = Found(key[:cut], sample, key[:cut] in edges, level > 0 and not cut)
            if held is not None and cut == depth:
                _, node.n, node.conv, _, node.goes_on = rows[held]
                node.far = node.goes_on
            for part in parts:
                node.n += part.n
                node.conv = part.conv if node.conv is None else min(node.conv, part.conv)
                node.far |= part.far
                if not part.edge:
                    node.children += 1
                    node.leaves += part.leaves
                    node.saved += part.saved
            if not node.edge and not node.top:
                for part in parts:
                    part.above = node.conv
                node.saved += (node.n - 1) * (rows[sample][3][cut // WIDTH - 1] if cut else 0)
                node.leaves += not node.children and not node.goes_on
            out.append(node)
            parts = [node]
        return parts

    # trees are as deep as keys are long, so with a stack: [node, depth of its parent, depth, children to do, parts, sample]
    stack = [[radix.root, -1, len(radix.root.path), radix.root.below(), [], None]]
    while stack:
        node, above, depth, waiting, parts, sample = stack[-1]
        if waiting:
            child = waiting.pop()
            stack.append([child, depth, depth + 1 + len(child.path), child.below(), [], None])
            continue
        stack.pop()
        sample = node.value if node.value is not None else sample
        left = emit(depth, above, node.value, sample, parts)
        if stack:
            stack[-1][4].extend(left)
            stack[-1][5] = sample
    return out


def _lines(
    tree: str, level: int, rows: list[tuple], after: list[str | None], segment: int, flush: int, opens: bool, closes: bool
) -> Iterator[tuple]:
    """trie_nodes() as rows of NODE; `after` names the tree after each full segment."""
    names: dict[bytes, bytes] = {}

    def name(prefix: bytes, sample: int) -> bytes:
        known = names.get(prefix)
        if known is None:
            if len(prefix) == segment * WIDTH:
                known = tree_name(after[sample])
            else:
                known = tree_name(tree) if level and not prefix else node_name(tree, level, prefix)
            names[prefix] = known
        return known

    for found in trie_nodes(level, rows, opens, closes):
        cut = len(found.prefix)
        least = WIDTH if level else 0
        up = [name(found.prefix[:c], found.sample) for c in range(least, cut + 1, WIDTH)] if found.edge else None
        yield (
            flush,
            found.edge or found.top,
            found.top,
            name(found.prefix, found.sample),
            name(found.prefix[: cut - WIDTH], found.sample) if cut else None,
            up,
            level * segment + cut // WIDTH,
            rows[found.sample][3][cut // WIDTH - 1] if cut else 0,
            0 if found.top else found.n,
            None if found.top else found.conv,
            found.above,
            found.children,
            0 if found.top else found.leaves,
            0 if found.top else found.saved,
            found.goes_on,
            found.far,
        )


def _planter(schema: pa.Schema, segment: int, most: int):
    """Over rows sorted by (level, tree, key): the tries of runs of at most `most` keys."""

    def plant(held: list[tuple], flush: int) -> pa.RecordBatch:
        lines: list[tuple] = []
        first = 0
        while first < len(held):
            level, tree = held[first][:2]
            end = first
            while end < len(held) and held[end][:2] == (level, tree):
                end += 1
            rows = [(r[2], r[3], r[4], r[6], r[7]) for r in held[first:end]]
            lines.extend(_lines(tree, level, rows, [r[5] for r in held[first:end]], segment, flush, first == 0, end == len(held)))
            first = end
        columns = list(zip(*lines))
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flush, held = TaskContext.get().partitionId() << 32, []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("level", "tree", "key", "n", "conv", "next", "sizes", "goes_on")]
            for row in zip(*columns):
                held.append(row)
                if len(held) == most:
                    yield plant(held, flush)
                    flush, held = flush + 1, []
        if held:
            yield plant(held, flush)

    return run


def _path_namer(segment: int):
    """(name, leaves, saved) for each node on the path of a segment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("level", "tree", "key", "next", "leaves", "saved")]
            names, leaves, saved = [], [], []
            for level, tree, key, after, leaf, save in zip(*columns):
                for cut in range(WIDTH if level else 0, len(key) + 1, WIDTH):
                    names.append(tree_name(after) if cut == segment * WIDTH else node_name(tree, level, key[:cut]))
                    leaves.append(leaf)
                    saved.append(save)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.binary()), pa.array(leaves, pa.int64()), pa.array(saved, pa.int64())], ["name", "leaves", "saved"]
            )

    return run


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each name's parts, which come in order, one after another."""
    name, digest = None, None
    for batch in batches:
        names, hashes = [], []
        for own, part, text in zip(*[batch.column(c).to_pylist() for c in ("name", "part", "text")]):
            if own != name:
                if name is not None:
                    names.append(name)
                    hashes.append(digest.hexdigest())
                name, digest = own, hashlib.sha256()
            elif part:
                digest.update(b",")
            digest.update(text.encode())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(hashes, pa.string())], ["name", "ends_sha256"])
    if name is not None:
        yield pa.RecordBatch.from_arrays([pa.array([name], pa.binary()), pa.array([digest.hexdigest()])], ["name", "ends_sha256"])


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv, at, id, bytes) of each rebuilt turn, and (conv) of each conversation."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv"), "turn", _short(digest).alias("id"), F.octet_length(text).cast("long").alias("bytes")
    )
    turns = settle(row_numbers(rows, ["conv"], ["turn", "id"], "at").drop("turn"), "turns")
    share = F.crc32(F.col("conv").cast("string").cast("binary")) % SHARES
    convs = settle(turns.select("conv").distinct().withColumn("share", share), "convs")
    heads = turns.where(F.col("at") < SHARES).select(F.col("conv").alias("family"), "at", "id", "bytes")
    lent = convs.withColumn("family", F.col("conv") - F.col("conv") % FAMILY).join(heads, "family").where("at <= share")
    own = turns.where(F.col("at") > share).select("conv", F.lit(True).alias("own"), "at", "id", "bytes")
    both = own.unionByName(lent.select("conv", F.lit(False).alias("own"), "at", "id", "bytes"))
    places = row_numbers(both.withColumnRenamed("at", "old"), ["conv"], ["own", "old"], "at")
    return places.select("conv", "at", "id", "bytes"), convs.select("conv")


def segments(turns: DataFrame, convs: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """(conv, level, tree, key, sizes, next, goes_on): all segments of the conversations, empty ones included."""
    listed = F.array_sort(F.collect_list(F.struct("at", F.hex("id").alias("id"), "bytes"))).alias("l")
    grouped = turns.groupBy("conv", F.floor((F.col("at") - 1) / segment).alias("level")).agg(listed)
    key = F.unhex(F.array_join(F.transform("l", lambda x: x["id"]), ""))
    cut = grouped.select("conv", "level", key.alias("key"), F.transform("l", lambda x: x["bytes"]).alias("sizes"))
    nothing = convs.join(turns.select("conv").distinct(), "conv", "left_anti")
    cut = cut.unionByName(
        nothing.select("conv", F.lit(0).cast("long").alias("level"), F.unhex(F.lit("")).alias("key"), F.array().cast("array<bigint>").alias("sizes"))
    )
    cut = settle(cut, "segments")
    whole = F.size("sizes") == segment
    digest = F.sha2(F.concat_ws(":", F.col("level").cast("string"), F.hex("key")), 256)
    high, low = (F.conv(F.substring(digest, a, n), 16, 10).cast("decimal(20,0)") for a, n in ((1, 16), (17, 8)))
    bound = (high * F.lit(1 << 32).cast("decimal(10,0)") + low).cast("decimal(38,0)")
    sums = settle(running_sum(cut.where(whole).select("conv", "level", bound.alias("own")), ["conv"], ["level"], F.col("own"), "next"), "sums")
    named = sums.select("conv", "level", F.col("next").cast("decimal(38,0)").cast("string").alias("next"))
    before = named.select("conv", (F.col("level") + 1).alias("level"), F.col("next").alias("tree"))
    later = cut.where("level > 0").select("conv", (F.col("level") - 1).alias("level"), F.lit(True).alias("goes_on"))
    short = cut.where(~whole).select("*", F.lit(None).cast("string").alias("next"), F.lit(False).alias("goes_on"))
    full = cut.where(whole).join(named, ["conv", "level"]).join(later, ["conv", "level"], "left")
    cut = short.unionByName(full.select("*").withColumn("goes_on", F.coalesce("goes_on", F.lit(False))))
    first = cut.where("level = 0").withColumn("tree", F.lit("0"))
    return first.unionByName(cut.where("level > 0").join(before, ["conv", "level"]).select(*first.columns))


def prefix_trie(conversations: DataFrame, segment: int = SEGMENT, most: int = FLUSH) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) for each node."""
    spark = conversations.sparkSession
    parts = segments(*rebuilt(conversations), segment)
    parts = settle(parts.withColumn("end", end_name()), "parts")
    different = parts.groupBy("level", "tree", "key").agg(
        F.count("*").alias("n"),
        F.min("conv").alias("conv"),
        F.max("next").alias("next"),
        F.max("sizes").alias("sizes"),
        F.max("goes_on").alias("goes_on"),
    )
    slices = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = different.repartitionByRange(slices, "level", "tree", "key").sortWithinPartitions("level", "tree", "key")
    nodes = settle(ranged.mapInArrow(_planter(_arrow_schema(), segment, most), NODE), "nodes")
    inner = nodes.where("NOT edge")

    # edges: one row a node, then their children and sums among themselves
    edges = settle(
        nodes.where("edge")
        .groupBy("name")
        .agg(
            *[F.sum(c).alias(c) for c in ("n", "children", "leaves", "saved")],
            *[F.max(c).alias(c) for c in ("parent", "up", "depth", "bytes", "goes_on", "far")],
            F.min("conv").alias("conv"),
        ),
        "edges",
    )
    grown = edges.where("n > 0").groupBy(F.col("parent").alias("name")).agg(F.count("*").alias("more"))
    edges = settle(edges.join(grown, "name", "left").withColumn("children", F.col("children") + F.coalesce("more", F.lit(0))).drop("more"), "edges")
    leaf = ((F.col("children") == 0) & ~F.col("goes_on")).cast("long")
    own = edges.where("n > 0").select(
        F.explode("up").alias("name"),
        (F.col("leaves") + leaf).alias("leaves"),
        (F.col("saved") + (F.col("n") - 1) * F.col("bytes")).alias("saved"),
    )
    sums = own.groupBy("name").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    owners = edges.where("n > 0").select("name", "conv").unionByName(inner.where("goes_on").select("name", "conv"))
    owners = settle(owners, "owners")

    seen = nodes.where("edge").select("flush", "name").distinct().join(owners, "name")
    seen = seen.select("flush", F.col("name").alias("parent"), F.col("conv").alias("owner"))
    columns = ["name", "depth", "bytes", "n", "conv", "parent_conv", "children", "leaves", "saved", "goes_on", "far"]
    told = inner.where("above IS NOT NULL").withColumn("parent_conv", F.col("above")).select(*columns)
    asked = inner.where("above IS NULL").join(seen, ["flush", "parent"]).withColumn("parent_conv", F.col("owner")).select(*columns)
    above = owners.select(F.col("name").alias("parent"), F.col("conv").alias("parent_conv"))
    rim = edges.where("n > 0").drop("leaves", "saved").join(sums, "name").join(above, "parent", "left").select(*columns)
    trie = settle(told.unionByName(asked).unionByName(rim), "trie")

    # what later segments hold, along the paths of those that own it
    weight = (F.col("n") - 1) * F.col("bytes")
    ends = ((F.col("children") == 0) & ~F.col("goes_on")).cast("long")
    level = F.floor((F.col("depth") - 1) / segment).alias("level")
    owned = trie.where(F.col("depth") > segment).groupBy("conv", level).agg(F.sum(weight).alias("saved"), F.sum(ends).alias("leaves"))
    long = parts.where("goes_on OR level > 0").select("conv", "level", "tree", "key", "next")
    # a conversation owns at most one leaf, so one sum carries both numbers
    both = F.coalesce(F.col("saved") * 2 + F.col("leaves"), F.lit(0)).alias("own")
    held = long.join(owned, ["conv", "level"], "left").select("conv", (-F.col("level")).alias("back"), "level", "tree", "key", "next", both)
    later = running_sum(held, ["conv"], ["back"], F.col("own"), "sum").withColumn("rest", F.col("sum") - F.col("own"))
    rest = later.where("rest > 0").select(
        "level", "tree", "key", "next", (F.col("rest") % 2).alias("leaves"), F.floor(F.col("rest") / 2).alias("saved")
    )
    below = rest.mapInArrow(_path_namer(segment), "name binary, leaves long, saved long").groupBy("name")
    below = below.agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
    tops = edges.where("n = 0").select("name", F.col("children").alias("more_children"))
    zero = F.lit(0)
    grown = trie.where("far").join(below, "name", "left").join(tops, "name", "left")
    for name in ("children", "leaves", "saved"):
        grown = grown.withColumn(name, F.col(name) + F.coalesce(f"more_{name}", zero))
    whole = trie.where("NOT far").unionByName(grown.select(*trie.columns))

    last = parts.where("NOT goes_on").select(F.col("end").alias("name"), "conv")
    lists = ordered_lists(last, ["name"], ["conv"], F.col("conv").cast("string"), "ids")
    text = lists.select("name", "part", F.array_join("ids", ",").alias("text"))
    hashed = text.repartition("name").sortWithinPartitions("name", "part").mapInArrow(_digests, "name binary, ends_sha256 string")
    return whole.join(hashed, "name", "left").select(
        F.col("conv").alias("conv_id"),
        "depth",
        F.col("parent_conv").alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )


def _arrow_schema() -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_schema(_parse_datatype_string(NODE))


ORACLE = r"""
WITH RECURSIVE t AS (
    SELECT conv_id, turn, coalesce(text, '') AS text, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS id
    FROM conversations WHERE conv_id IS NOT NULL),
placed AS (SELECT conv_id, id, strlen(text) AS bytes, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, id[:32]) AS place FROM t),
crc AS (
    SELECT conv_id, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
               lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)),
                                             lambda x, _: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384::BIGINT ELSE 0::BIGINT END))),
               4294967295::BIGINT) % 9 AS h
    FROM (SELECT DISTINCT conv_id FROM t)),
turns AS (
    SELECT c.conv_id, false AS own, place, id, bytes FROM crc c JOIN placed p ON p.conv_id = c.conv_id - c.conv_id % 5 AND place <= h
    UNION ALL SELECT conv_id, true, place, id, bytes FROM placed JOIN crc USING (conv_id) WHERE place > h),
lists AS (
    SELECT c.conv_id, coalesce(ids, []) AS ids, coalesce(sizes, []) AS sizes
    FROM crc c LEFT JOIN (SELECT conv_id, list(id ORDER BY own, place) AS ids, list(bytes ORDER BY own, place) AS sizes FROM turns GROUP BY conv_id) USING (conv_id)),
on_path AS (SELECT conv_id, d, ids[:d] AS prefix, CASE WHEN d = 0 THEN 0 ELSE sizes[d] END AS bytes, d = len(ids) AS ends
            FROM lists, unnest(range(len(ids) + 1)) AS r(d)),
nodes AS (
    SELECT d, prefix, min(conv_id) AS conv_id, count(*) AS n, any_value(bytes) AS bytes,
           sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
    FROM on_path GROUP BY d, prefix),
grown AS (SELECT prefix[:d - 1] AS prefix, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1),
full_nodes AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN grown USING (prefix)),
up AS (SELECT prefix[:a] AS prefix, sum((n - 1) * bytes) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
       FROM full_nodes, unnest(range(d + 1)) AS r(a) GROUP BY 1)
SELECT n.conv_id, n.d AS depth, p.conv_id AS parent_conv_id, n.n AS n_convs, n.n_children, u.n_leaves,
       u.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM full_nodes n JOIN up u USING (prefix) LEFT JOIN nodes p ON n.d > 0 AND p.d = n.d - 1 AND p.prefix = n.prefix[:n.d - 1]"""
