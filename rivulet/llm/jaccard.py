"""Join of documents whose word n-gram sets are at least `threshold` similar (Jaccard), by PartEnum.

Sizes fall into bands; two sets that link lie in the same band or in neighbouring ones, and
differ in at most k elements, k following from the band. Elements are dealt by hash into
(k + 2) // 2 partitions of three cells each. If at most k elements differ, one partition has at
most one of them, so both sets agree on the partition without some one cell: each partition
without each cell gives a signature, and linked sets share one. (With k = 0 the whole set is
the signature.) A signature of no elements would tie what has nothing in common, so it is left
out. Of every SPARE partitions one is to spare: with s of them at least s + 1 agree, so a pair is only lost if
both sets have empty signatures in more than s partitions. Such sets are dealt anew by another hash, up to
LEVELS times; the last time empty signatures count.

1. Equal sets are one: a set is named by some bytes of its digest, as many as the number of documents
   needs, and other bits are taken if two digests ever shared a name. Signatures go into the shuffle packed by
   buckets, in four bytes beside the bucket: what two signatures share by chance is a candidate too many, whose number
   grows with the buckets. Sets with a common signature are candidates, pair by pair; nothing is inferred from
   chains of candidates. They are confirmed on full sets, see `linking`, which gives the
   components, and inside these all links lie.
2. For the numbers of links the sets of a component are compared exactly, each different set once.
   Components above `block_bytes` or 512 sets are cut into blocks, and blocks are compared pairwise; a task
   keeps two. A parity sketch of 1,024 bits bounds the difference from below, so most pairs need no more.

Shingles are compared by 64-bit names from two hashes. A text of fewer than n words has its whole sequence as
its one shingle; without words (empty or NULL) the set is empty and links with nothing, and
the row is its own component. Rows with the same id are one document whose sets all count; a
NULL id has no component. A document's links are the other documents it links to.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from fractions import Fraction
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm.linking import confirmed, set_table, shingles, sketch, sketches
from rivulet.llm.tables import byte_total, component_labels, parts, settle
from rivulet.llm.text_arrays import mix, text_slices, within

CELLS = 3
#: times that a set with too many empty signatures is dealt, and one spare partition for so many
LEVELS, SPARE = 4, 16
BLOCK_BYTES = 1 << 20
BLOCK_SETS = 512
#: text for each bucket of signatures; signatures that a task sorts at once
BUCKET_BYTES = 1 << 19
FLUSH = 1 << 20


@lru_cache(maxsize=8)
def bands(threshold: Fraction, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Largest size of each band and the largest difference of linked sets up to that size."""
    tops, low = [], 1
    while not tops or tops[-1] < most:
        tops.append(math.floor(low / threshold))
        low = tops[-1] + 1
    share = (1 - threshold) / (1 + threshold)
    return np.array(tops), np.array([math.floor(2 * t * share) for t in tops])


def signatures(sets: np.ndarray, bounds: np.ndarray, threshold: Fraction) -> tuple[np.ndarray, np.ndarray]:
    """(row, signature) pairs of all sets."""
    sizes = np.diff(bounds)
    if not len(sets):
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    tops, differences = bands(threshold, 4 << int(sizes.max()).bit_length())  # with a band beyond the largest set's
    band = np.searchsorted(tops, sizes)
    everyone = np.repeat(np.arange(len(sizes)), sizes)
    rows, marks = [], []
    for shift in (0, 1):  # the set's own band, and as the smaller one of a pair
        here = band + shift
        k = differences[here]
        open_ = sizes > 0
        for level in range(LEVELS):
            least = np.maximum(1, (k + 2) // 2)
            parts = np.where(open_, least + least // SPARE, 0)
            firsts = np.concatenate([[0], np.cumsum(parts * CELLS)])
            chosen = open_[everyone]
            owner, elements = everyone[chosen], sets[chosen]
            dealt = mix(elements + np.uint64(level)) if level else elements
            part = (dealt & np.uint64(0xFFFFFFFF)).astype(np.int64) % parts[owner]
            cell = (dealt >> np.uint64(33)).astype(np.int64) % CELLS
            place = firsts[owner] + part * CELLS + cell
            sums = np.zeros(firsts[-1], np.uint64)
            np.add.at(sums, place, mix(elements))
            sums = sums.reshape(-1, CELLS)
            total = sums.sum(axis=1, dtype=np.uint64)
            held = np.bincount(place, minlength=firsts[-1]).reshape(-1, CELLS)
            of = np.repeat(np.arange(len(sizes)), parts)
            salt = (here[of].astype(np.uint64) << np.uint64(32)) + (within(parts).astype(np.uint64) << np.uint64(4))
            salt = mix(salt + np.uint64(2 * level + 1))
            whole = k[of] == 0
            hollow = np.zeros(len(of), bool)
            for drop in range(CELLS):
                left = np.where(whole, total, total - sums[:, drop])
                empty = ~whole & (held.sum(axis=1) == held[:, drop])
                hollow |= empty
                use = ~whole if drop else np.ones(len(of), bool)
                if level + 1 < LEVELS:
                    use &= ~empty
                rows.append(of[use])
                marks.append(mix(left + salt * np.uint64(2 * drop + 3))[use])
            # of `parts` partitions at most k // 2 differ in two elements or more; the others agree
            open_ = np.bincount(of[hollow], minlength=len(sizes)) > least // SPARE
            if not open_.any():
                break
    return np.concatenate(rows), np.concatenate(marks)


def meetings(marks: np.ndarray, names: np.ndarray, state: tuple) -> tuple[tuple, tuple]:
    """Rows (name, hub, several) of the marks that more than one name has, and the state after them.

    The state of a bucket's earlier marks, in order: marks, the first name of each (its hub), the second, how
    many there were (3 stands for more). A mark's rows are `several` from its third name on; then that of the
    second comes again.
    """
    seen, hubs, seconds, counts = state
    order = np.lexsort((names, marks))
    marks, names = marks[order], names[order]
    once = np.ones(len(marks), bool)
    once[1:] = (marks[1:] != marks[:-1]) | (names[1:] != names[:-1])
    marks, names = marks[once], names[once]
    heads = np.flatnonzero(np.concatenate([[True], marks[1:] != marks[:-1]]))
    own = marks[heads]
    which = np.repeat(np.arange(len(own)), np.diff(np.append(heads, len(marks))))
    at = np.searchsorted(seen, own)
    old = np.zeros(len(own), bool)
    old[at < len(seen)] = seen[at[at < len(seen)]] == own[at < len(seen)]
    hub, second, before = names[heads].copy(), np.full(len(own), -1), np.zeros(len(own), np.int64)
    hub[old], second[old], before[old] = hubs[at[old]], seconds[at[old]], counts[at[old]]
    fresh = ~((before[which] >= 1) & (names == hub[which])) & ~((before[which] >= 2) & (names == second[which]))
    total = before + np.bincount(which, weights=fresh, minlength=len(own)).astype(np.int64)
    others = np.flatnonzero(fresh & (names != hub[which]))
    marked, first = np.unique(which[others], return_index=True)
    early = before[marked] < 2
    third = (total >= 3) & (before == 2)
    rows = others[total[which[others]] >= 2]
    out = (
        np.concatenate([second[third], names[rows]]),
        np.concatenate([hub[third], hub[which[rows]]]),
        np.concatenate([np.ones(third.sum(), bool), total[which[rows]] >= 3]),
    )
    second[marked[early]] = names[others[first[early]]]
    total = np.minimum(total, 3)
    hubs, seconds, counts = hubs.copy(), seconds.copy(), counts.copy()
    hubs[at[old]], seconds[at[old]], counts[at[old]] = hub[old], second[old], total[old]
    merged = np.concatenate([seen, own[~old]])
    place = np.argsort(merged, kind="stable")
    added = ((hubs, hub), (seconds, second), (counts, total))
    return out, (merged[place], *[np.concatenate([was, now[~old]])[place] for was, now in added])


def name_bytes(documents: int) -> int:
    """Bytes of a name with which two of so many sets seldom share one; the eighth has a bit less, for the sign."""
    return min(8, max(4, math.ceil((2 * math.log2(max(2, documents)) + 4) / 8)))


def set_name(content: bytes, salt: int, width: int = 8) -> tuple[bytes, int]:
    """Digest of a set, and so many bytes of another one under this salt."""
    digest = hashlib.blake2b(content, digest_size=16).digest()
    named = int.from_bytes(hashlib.blake2b(digest, digest_size=8, salt=salt.to_bytes(8, "big")).digest(), "big") >> 1
    return digest, named & ((1 << 8 * width) - 1)


def packed_names(names: np.ndarray, width: int) -> bytes:
    """The lowest `width` bytes of each name."""
    return np.ascontiguousarray(names, "<i8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def unpacked_names(packed: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(packed) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(packed, np.uint8).reshape(-1, width)
    return out.view("<i8").ravel()


def _namer(n: int, salt: int, width: int):
    """(id, n, name, digest, sketch) of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in text_slices(batch.column("text")):
                sets, bounds = shingles(data, offsets, n)
                both = [set_name(sets[a:b].tobytes(), salt, width) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
                digests, names = zip(*both)
                columns = [batch.column("id").slice(first, end - first), pa.array(np.diff(bounds)), pa.array(names, pa.int64())]
                marks = [sketch(own) for own in np.split(sets, bounds[1:-1])]
                columns += [pa.array(digests, pa.binary()), pa.array(marks, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["id", "n", "name", "digest", "sketch"])

    return run


def _signer(n: int, threshold: Fraction, salt: int, width: int, buckets: int):
    """Marks and names of the sets, packed by buckets of marks; a slice's equal sets are signed once."""

    def packets(marks: np.ndarray, names: np.ndarray) -> pa.RecordBatch:
        own = ((marks >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
        marks = marks.astype(np.uint32)
        order = np.argsort(own, kind="stable")
        own, marks, names = own[order], marks[order], names[order]
        cuts = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1], [True]])) if len(own) else np.array([0])
        bounds = list(zip(cuts[:-1].tolist(), cuts[1:].tolist()))
        columns = [own[cuts[:-1]], [marks[a:b].tobytes() for a, b in bounds], [packed_names(names[a:b], width) for a, b in bounds]]
        kinds = (pa.int32(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["bucket", "marks", "names"])

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks: list[np.ndarray] = []
        owners: list[np.ndarray] = []
        for batch in batches:
            for _, _, data, offsets in text_slices(batch.column("text")):
                sets, bounds = shingles(data, offsets, n)
                known: dict[int, tuple[int, int]] = {}
                for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                    if b > a:
                        known.setdefault(set_name(sets[a:b].tobytes(), salt, width)[1], (a, b))
                if not known:
                    continue
                sizes = np.array([b - a for a, b in known.values()])
                chosen = np.concatenate([sets[a:b] for a, b in known.values()])
                rows, own = signatures(chosen, np.concatenate([[0], np.cumsum(sizes)]), threshold)
                marks.append(own)
                owners.append(np.array(list(known), np.int64)[rows])
                if sum(map(len, marks)) >= FLUSH:
                    yield packets(np.concatenate(marks), np.concatenate(owners))
                    marks, owners = [], []
        if marks:
            yield packets(np.concatenate(marks), np.concatenate(owners))

    return sign


def _meeter(width: int):
    """Over packets sorted by bucket: (rep, hub, several) for the marks that more than one set has.

    A task holds one bucket's different marks, and FLUSH marks more; how many sets have a mark does not matter.
    """

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        empty = tuple(np.empty(0, kind) for kind in (np.uint32, np.int64, np.int64, np.int64))
        bucket, state = None, empty
        marks: list[np.ndarray] = []
        names: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            nonlocal state, marks, names
            found, state = meetings(np.concatenate(marks), np.concatenate(names), state)
            marks, names = [], []
            return pa.RecordBatch.from_arrays([pa.array(c) for c in found], ["rep", "hub", "several"])

        for batch in batches:
            for own, a, b in zip(batch.column("bucket").to_pylist(), batch.column("marks"), batch.column("names")):
                if own != bucket:
                    if marks:
                        yield flush()
                    bucket, state = own, empty
                marks.append(np.frombuffer(a.as_py(), np.uint32))
                names.append(unpacked_names(b.as_py(), width))
                if sum(map(len, marks)) >= FLUSH:
                    yield flush()
        if marks:
            yield flush()

    return meet


def _set_maker(n: int):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in text_slices(batch.column("text")):
                sets, bounds = shingles(data, offsets, n)
                content = [sets[a:b].tobytes() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
                rows = batch.slice(first, end - first)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("grp"), rows.column("id"), pa.array(np.diff(bounds)), pa.array(content, pa.binary())], ["grp", "id", "n", "content"]
                )

    return make


def links(left: list[np.ndarray], right: list[np.ndarray] | None, threshold: Fraction) -> Iterator[tuple[int, np.ndarray]]:
    """(i, all j) for the linked sets left[i] and right[j]; within `left`, j > i, if right is None."""
    others = left if right is None else right
    marks, other_marks = sketches(left), sketches(left if right is None else right)
    sizes, other_sizes = np.array([len(s) for s in left]), np.array([len(s) for s in others])
    over, under = threshold.numerator, threshold.denominator
    for i, own in enumerate(left):
        begin = i + 1 if right is None else 0
        differ = np.bitwise_count(other_marks[begin:] ^ marks[i]).sum(axis=1, dtype=np.int64)
        theirs = other_sizes[begin:]
        # difference d and sizes a, b: intersection (a + b - d) / 2, union (a + b + d) / 2
        total = theirs + sizes[i]
        near = begin + np.flatnonzero(under * (total - differ) >= over * (total + differ))
        if not len(near):
            continue
        content = np.concatenate([others[j] for j in near])
        at = np.searchsorted(own, content)
        shared = own[np.minimum(at, len(own) - 1)] == content
        bounds = np.concatenate([[0], np.cumsum(other_sizes[near])])
        both = np.diff(np.concatenate([[0], np.cumsum(shared)])[bounds])
        sure = near[under * both >= over * (other_sizes[near] + sizes[i] - both)]
        if len(sure):
            yield i, sure


def counted(keys: tuple, ids: list[int], side: list[bool], copies: list[int], sets: list[np.ndarray], threshold: Fraction):
    """Rows (id, links): how many documents each set links to, itself and its copies aside."""
    own = [i for i, s in enumerate(side) if not s]
    far = [i for i, s in enumerate(side) if s]
    counts = [0] * len(ids)
    right = None if keys[1] == keys[2] else [sets[i] for i in far]
    names = own if right is None else far
    for i, found in links([sets[i] for i in own], right, threshold):
        a = own[i]
        for j in found.tolist():
            b = names[j]
            counts[a] += copies[b]
            counts[b] += copies[a]
    for i, id in enumerate(ids):
        if counts[i]:
            yield id, counts[i]


def _comparer(threshold: Fraction):
    """Over rows sorted by (grp, i, j): compares the sets of each, one after another."""

    def flush(keys: tuple, rows: list[tuple]) -> pa.RecordBatch:
        found = list(counted(keys, *[list(c) for c in zip(*rows)], threshold))
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*found) if found else ([], []))], ["id", "links"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, rows = None, []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("grp", "i", "j", "id", "far", "copies", "content")]
            for grp, i, j, id, far, copies, content in zip(*columns):
                if (grp, i, j) != keys:
                    if rows:
                        yield flush(keys, rows)
                    keys, rows = (grp, i, j), []
                rows.append((id, far, copies, np.frombuffer(content, np.uint64)))
        if rows:
            yield flush(keys, rows)

    return run


def similar_components(df: DataFrame, text: str = "text", id: str = "doc_id", n: int = 3, threshold: str = "0.9") -> DataFrame:
    """(id, n, component) for each row: its number of shingles and the smallest id it reaches by links."""
    share = Fraction(threshold)
    rows = df.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    salt, width = 0, name_bytes(rows.count())
    while True:
        named = settle(rows.mapInArrow(_namer(n, salt, width), "id long, n long, name long, digest binary, sketch binary"), "names")
        shared_names = named.groupBy("name").agg(F.min("digest").alias("a"), F.max("digest").alias("b")).where("a != b")
        if shared_names.isEmpty():
            break
        salt += 1
    texts = rows.where("id IS NOT NULL")
    buckets = parts(byte_total(texts, "text"), BUCKET_BYTES)
    signed = texts.mapInArrow(_signer(n, share, salt, width, buckets), "bucket int, marks binary, names binary")
    ordered = signed.repartition("bucket").sortWithinPartitions("bucket")
    met = ordered.mapInArrow(_meeter(width), "rep long, hub long, several boolean")
    near = settle(met.groupBy("rep", "hub").agg(F.max("several").alias("several")), "met")

    # sketch and a document of each set that met another; full sets are made of those alone that sketches cannot part
    holders = named.where("id IS NOT NULL AND n > 0").select("id", "name")
    wanted = near.select(F.explode(F.array("rep", "hub")).alias("rep")).distinct()
    kept = named.where("id IS NOT NULL AND n > 0").withColumnRenamed("name", "rep").join(wanted, "rep").groupBy("rep")
    chosen = settle(kept.agg(F.min("id").alias("id"), F.min("n").alias("n"), F.min("sketch").alias("sketch")), "chosen")

    def sets(reps: DataFrame) -> DataFrame:
        ids = chosen.join(reps, "rep").select("id").distinct()
        return settle(set_table(texts, ids, n, lambda content: set_name(content, salt, width)[1]), "sets")

    links = confirmed(near, chosen.select("rep", "n", "sketch"), sets, share)

    # rows with the same id are one document: their sets are one component
    several = holders.groupBy("id").agg(F.min("name").alias("hub"), F.max("name").alias("top")).where("hub != top").select("id", "hub")
    same = holders.join(several, "id").where("name != hub").select(F.col("name").alias("rep"), "hub")
    labels = component_labels(links.unionByName(same), "rep", "hub")
    own = F.when(F.col("id").isNotNull() & (F.col("n") > 0), F.coalesce("label", "name"))
    labelled = settle(named.join(labels, F.col("name") == F.col("node"), "left").select("id", "n", own.alias("part")), "labelled")
    least = labelled.where("part IS NOT NULL").groupBy("part").agg(F.min("id").alias("least"))
    return labelled.join(least, "part", "left").select("id", "n", F.coalesce("least", "id").alias("component"))


def similar_groups(
    df: DataFrame, text: str = "text", id: str = "doc_id", n: int = 3, threshold: str = "0.9", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """(id, n_shingles, component_id, n_links) for each row."""
    share = Fraction(threshold)
    rows = df.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    named = rows.where("id IS NOT NULL")
    found = settle(similar_components(df, text, id, n, threshold), "components")
    # the documents of components that have more than one
    large = found.where("id IS NOT NULL AND n > 0").groupBy("component").agg((F.min("id") != F.max("id")).alias("links")).where("links")
    labels = found.join(large, "component").select(F.col("id").alias("node"), F.col("component").alias("label")).distinct()

    # links lie inside components, which grow with the documents: never a broadcast; hashing spares sorting the texts
    members = named.join(labels.select(F.col("node").alias("id"), F.col("label").alias("grp")).hint("shuffle_hash"), "id").select("grp", "id", "text")
    sets = settle(members.mapInArrow(_set_maker(n), "grp long, id long, n long, content binary").where("n > 0"), "sets")
    digest = sets.select("grp", "id", "n", F.sha2("content", 256).alias("digest")).distinct()
    alike = settle(digest.groupBy("grp", "n", "digest").agg(F.min("id").alias("rep"), F.count_distinct("id").alias("copies")), "alike")
    copies = digest.join(alike, ["grp", "n", "digest"]).select("id", "rep", "copies")

    # one row for each different set, dealt into blocks where the group is large
    blocks = F.ceil(F.greatest(F.sum("n") * 8 / block_bytes, F.count("*") / BLOCK_SETS)).cast("int")
    wide = settle(alike.groupBy("grp").agg(blocks.alias("blocks"), F.count("*").alias("sets")).where("sets > 1").drop("sets"), "wide")
    single = alike.join(wide, "grp").select("grp", F.col("rep").alias("id"), "n", "digest", "copies", "blocks")
    whole = sets.withColumn("digest", F.sha2("content", 256)).dropDuplicates(["grp", "id", "n", "digest"])
    own = whole.join(single, ["grp", "id", "n", "digest"]).withColumn("block", F.pmod(F.xxhash64("digest"), F.col("blocks")).cast("int"))
    dealt = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "grp",
        F.least("block", "other").alias("i"),
        F.greatest("block", "other").alias("j"),
        "id",
        (F.col("block") > F.col("other")).alias("far"),
        "copies",
        "content",
    )
    dealt = dealt.repartition("grp", "i", "j").sortWithinPartitions("grp", "i", "j", "id")
    compared = settle(dealt.mapInArrow(_comparer(share), "id long, links long"), "compared")
    far = compared.groupBy(F.col("id").alias("rep")).agg(F.sum("links").alias("far"))
    linked = copies.join(far, "rep", "left").groupBy("id").agg(F.sum(F.coalesce("far", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    return found.join(linked, "id", "left").select(
        F.col("id").alias(id),
        F.col("n").alias("n_shingles"),
        F.col("component").alias("component_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
    )


ORACLE = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x20\x09-\x0D]+'), lambda x: x <> '') AS l FROM documents),
sh AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(l) >= 3 THEN list_transform(range(1, len(l) - 1), lambda i: array_to_string(l[i:i + 2], ' '))
           WHEN len(l) > 0 THEN [array_to_string(l, ' ')] ELSE [] END) AS s FROM w),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
linked AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 90 * (x.n + y.n - c)),
reach AS (SELECT DISTINCT a AS node, a AS far FROM linked UNION SELECT node, b FROM reach JOIN linked ON a = far)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(r.component_id, d.doc_id) AS component_id, coalesce(l.n_links, 0) AS n_links
FROM documents d LEFT JOIN n USING (doc_id)
LEFT JOIN (SELECT node AS doc_id, least(node, min(far)) AS component_id FROM reach GROUP BY node) r USING (doc_id)
LEFT JOIN (SELECT a AS doc_id, count(*) AS n_links FROM linked GROUP BY a) l USING (doc_id)"""
