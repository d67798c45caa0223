"""Confirms candidates on full sets: what buckets of sets with something in common link to.

Takes the members of buckets as (rep, hub, several): a set is named by a number, and each bucket has one of its
members as its hub. Every set is tested against the hubs of its buckets. Stars are dealt in chunks, so a set that
many others meet is compared with them in many tasks.

In buckets of more than two, sets that do not link to the hub are compared with the others of the same
hub. Those that link to it are one component and are not compared with each other. Jaccard distance is a metric,
so two sets whose distances to the hub differ by more than a link allows need no comparison either. The others are
dealt in blocks and compared exactly; so no link between components is lost, and no pairs are emitted.

Full sets are only sent where they may link. A parity sketch bounds the difference of two sets from below: pairs it
rules out keep that bound as their distance, and members of blocks that it parts from all others stay out. Its bits
grow with the set, since a sketch much smaller than the difference is half ones and parts nothing; of two sketches the
larger is folded to the smaller one's size. Members of blocks that are one component by their links to hubs, whichever
these are, are not compared either.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm.tables import component_labels, settle
from rivulet.llm.text_arrays import SPACES, mix, span_names, text_slices, word_bounds

#: sets in one chunk of a star, and in one block of a bucket
CHUNK = 256
#: 64-bit words of the smallest sketch and of the largest; sets of more elements than bits are only parted less sharply
SKETCH_WORDS, MOST_SKETCH_WORDS = 16, 2048


def shingles(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct names of each row's n-word sequences, A-Z as a-z, and where each row's begin."""
    starts, ends, firsts = word_bounds(data, offsets, SPACES)
    words = span_names(data, starts, ends, fold=True)
    counts = np.diff(firsts)
    sizes = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    row = np.repeat(np.arange(len(counts)), sizes)
    at = firsts[row] + np.arange(bounds[-1]) - bounds[row]
    lengths = np.minimum(counts, n)[row]
    names = mix(lengths.astype(np.uint64))
    for i in range(n):
        more = i < lengths
        names[more] = mix(names[more] * np.uint64(0xD1342543DE82EF95) + words[at[more] + i])
    order = np.lexsort((names, row))
    names = names[order]
    fresh = np.ones(len(names), bool)
    fresh[1:] = (names[1:] != names[:-1]) | (row[1:] != row[:-1])
    return names[fresh], np.concatenate([[0], np.cumsum(fresh)])[bounds]


def _set_maker(n: int, name: Callable[[bytes], int] | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in text_slices(batch.column("text")):
                sets, bounds = shingles(data, offsets, n)
                content = [sets[a:b].tobytes() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
                names = batch.column("id").slice(first, end - first) if name is None else pa.array(map(name, content), pa.int64())
                yield pa.RecordBatch.from_arrays([names, pa.array(content, pa.binary())], ["rep", "content"])

    return run


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """For each set, one bit per hash class: whether it holds an odd number of that class."""
    bits = 64 * SKETCH_WORDS
    out = np.zeros((len(sets), bits), np.uint8)
    for row, own in enumerate(sets):
        out[row] = np.bincount((own >> np.uint64(13)).astype(np.int64) % bits, minlength=bits) & 1
    return np.packbits(out, axis=1).view(np.uint64)


def sketch(own: np.ndarray) -> bytes:
    """As sketches(), in the least power of two of words that has a bit for each element."""
    bits = 64 * SKETCH_WORDS
    while bits < len(own) and bits < 64 * MOST_SKETCH_WORDS:
        bits *= 2
    odd = np.bincount((own >> np.uint64(13)).astype(np.int64) & (bits - 1), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def folded(marks: np.ndarray, words: int) -> np.ndarray:
    """Sketches (rows, words) as they are with fewer words."""
    return marks if marks.shape[1] == words else np.bitwise_xor.reduce(marks.reshape(len(marks), -1, words), axis=1)


def sketched(sets: DataFrame) -> DataFrame:
    """(rep, n, sketch) of the sets; NULL for a rep with several, of which nothing is ruled out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [np.frombuffer(c.as_py(), np.uint64) for c in batch.column("content")]
            marks = [sketch(o) for o in own]
            yield pa.RecordBatch.from_arrays([batch.column("rep"), pa.array([len(o) for o in own], pa.int64()), pa.array(marks, pa.binary())], ["rep", "n", "sketch"])

    found = sets.mapInArrow(run, "rep long, n long, sketch binary").groupBy("rep").agg(F.count("*").alias("sets"), F.min("n").alias("n"), F.min("sketch").alias("sketch"))
    single = F.col("sets") == 1
    return settle(found.select("rep", F.when(single, F.col("n")).alias("n"), F.when(single, F.col("sketch")).alias("sketch")), "sketched")


def _words(column: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Sketches, zeros for NULL, the words of each, and which are known."""
    held = column.to_pylist()
    known = np.array([h is not None for h in held], bool)
    held = [h or bytes(8 * SKETCH_WORDS) for h in held]
    return held, np.array([len(h) // 8 for h in held], np.int64), known


def _rows(held: list[bytes], chosen: np.ndarray) -> np.ndarray:
    """The chosen sketches, which have the same size."""
    return np.frombuffer(b"".join(held[i] for i in chosen.tolist()), np.uint64).reshape(len(chosen), -1)


def _bounder(threshold: Fraction):
    """Adds to pairs the least distance their sketches leave, NULL where unknown, and whether they may link."""
    over, under = threshold.numerator, threshold.denominator

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (a, width, known), (b, hub_width, also) = _words(batch.column("sketch")), _words(batch.column("hub_sketch"))
            known = known & also
            differ = np.zeros(batch.num_rows, np.int64)
            for pair in set(zip(width.tolist(), hub_width.tolist())):
                rows = np.flatnonzero((width == pair[0]) & (hub_width == pair[1]))
                both = folded(_rows(a, rows), min(pair)) ^ folded(_rows(b, rows), min(pair))
                differ[rows] = np.bitwise_count(both).sum(axis=1, dtype=np.int64)
            n, m = (np.where(known, batch.column(c).fill_null(0).to_numpy(zero_copy_only=False), 0) for c in ("n", "hub_n"))
            differ = np.maximum(differ, abs(n - m))
            # difference d and sizes n, m: intersection (n + m - d) / 2, union (n + m + d) / 2
            total = n + m
            may = ~known | (under * (total - differ) >= over * (total + differ))
            least = np.where(known, 2 * differ / np.maximum(total + differ, 1), np.nan)
            yield pa.RecordBatch.from_arrays(
                [batch.column("rep"), batch.column("hub"), batch.column("several"), pa.array(least, mask=~known), pa.array(may)],
                ["rep", "hub", "several", "distance", "may"],
            )

    return run


def _parter(threshold: Fraction):
    """Over rows sorted by (hub, i, j): those that may link to one with another label they are compared with."""
    over, under = threshold.numerator, threshold.denominator

    def flush(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        block = pa.Table.from_batches(rows).combine_chunks().to_batches()[0]
        held, width, known = _words(block.column("sketch"))
        sizes = np.unique(width).tolist()
        place = {w: np.flatnonzero(width == w) for w in sizes}
        marks = {(w, v): folded(_rows(held, place[w]), v) for w in sizes for v in sizes if v <= w}
        rank = np.empty(len(held), np.int64)
        for w in sizes:
            rank[place[w]] = np.arange(len(place[w]))
        n = np.where(known, block.column("n").fill_null(0).to_numpy(zero_copy_only=False), 0)
        label = block.column("label").to_numpy(zero_copy_only=False)
        near = block.column("near").to_numpy(zero_copy_only=False)
        across = block.column("i")[0].as_py() != block.column("j")[0].as_py()
        keep = np.zeros(len(n), bool)
        for i in range(len(n)):
            total = n + n[i]
            differ = abs(n - n[i])
            for w in sizes:
                v = min(w, int(width[i]))
                odd = np.bitwise_count(marks[w, v] ^ marks[int(width[i]), v][rank[i]]).sum(axis=1, dtype=np.int64)
                differ[place[w]] = np.maximum(differ[place[w]], odd)
            may = (label != label[i]) & (~known | ~known[i] | (under * (total - differ) >= over * (total + differ)))
            keep[i] = (may & (near != near[i])).any() if across else may.any()
        return block.filter(pa.array(keep)).select(["hub", "i", "j", "rep", "label", "near"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []
        for batch in batches:
            columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("hub", "i", "j")]
            new = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
            cuts = [0, *(np.flatnonzero(new) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts[:-1], cuts[1:]):
                if a == b:
                    continue
                own = tuple(c[a] for c in columns)
                if own != key:
                    if rows:
                        yield flush(rows)
                    key, rows = own, []
                rows.append(batch.slice(a, b - a))
        if rows:
            yield flush(rows)

    return run


def shared(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    return int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())


def _star_tester(threshold: Fraction):
    """Over rows sorted by (hub, chunk), the hub's own sets first: each other one's distance, and whether it links."""
    over, under = threshold.numerator, threshold.denominator
    names = ["rep", "hub", "several", "distance", "linked"]
    kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.float64(), pa.bool_())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, hubs = None, []
        for batch in batches:
            out = []
            for hub, chunk, rep, several, content in zip(*[batch.column(c).to_pylist() for c in ("hub", "chunk", "rep", "several", "content")]):
                if (hub, chunk) != key:
                    key, hubs = (hub, chunk), []
                own = np.frombuffer(content, np.uint64)
                if rep == hub:
                    hubs.append(own)
                    continue
                both = [(shared(own, h), len(own) + len(h)) for h in hubs]
                # several sets of one id have no distance of their own
                distance = 1 - both[0][0] / (both[0][1] - both[0][0]) if len(both) == 1 else None
                out.append((rep, hub, several, distance, any(under * s >= over * (t - s) for s, t in both)))
            columns = list(zip(*out)) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return run


def compare(reps: list[int], labels: list[int], sets: list[np.ndarray], near: list[bool], across: bool, threshold: Fraction) -> list[tuple[int, int]]:
    """Links that join components: of sets with different labels, until they are connected.

    With `across`, only a set that is `near` and one that is not are compared.
    """
    over, under = threshold.numerator, threshold.denominator
    root = {label: label for label in labels}

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for i in range(len(reps)):
        for j in range(i):
            if across and near[i] == near[j] or under * min(len(sets[i]), len(sets[j])) < over * max(len(sets[i]), len(sets[j])):
                continue
            a, b = find(labels[i]), find(labels[j])
            if a == b:
                continue
            both = shared(sets[i], sets[j])
            if under * both >= over * (len(sets[i]) + len(sets[j]) - both):
                root[max(a, b)] = min(a, b)
                out.append((reps[i], reps[j]))
    return out


def _block_tester(threshold: Fraction):
    """Over rows sorted by (hub, i, j): links between the components of each block pair."""

    def flush(key: tuple, rows: list[tuple]) -> pa.RecordBatch:
        reps, labels, near, contents = (list(c) for c in zip(*rows))
        found = compare(reps, labels, [np.frombuffer(c, np.uint64) for c in contents], near, key[1] != key[2], threshold)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*found) if found else ([], []))], ["rep", "hub"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("hub", "i", "j", "rep", "label", "near", "content")]
            for hub, i, j, *row in zip(*columns):
                if (hub, i, j) != key:
                    if rows:
                        yield flush(key, rows)
                    key, rows = (hub, i, j), []
                rows.append(row)
        if rows:
            yield flush(key, rows)

    return run


def bounded(pairs: DataFrame, marks: DataFrame, threshold: Fraction) -> DataFrame:
    """Adds the least distance and whether it may link to each different pair (rep, hub, several), on sketches."""
    hubs = marks.select(F.col("rep").alias("hub"), F.col("n").alias("hub_n"), F.col("sketch").alias("hub_sketch"))
    both = pairs.join(marks, "rep").join(hubs, "hub").select("rep", "hub", "several", "n", "sketch", "hub_n", "hub_sketch")
    return settle(both.mapInArrow(_bounder(threshold), "rep long, hub long, several boolean, distance double, may boolean"), "bounded")


def tested(pairs: DataFrame, marks: DataFrame, sets: Callable[[DataFrame], DataFrame], threshold: Fraction) -> DataFrame:
    """Adds the distance and whether it links to each different pair (rep, hub, several).

    Pairs that may link by their sketches are compared on full sets; the others have the sketches' bound as distance.
    """
    known = bounded(pairs, marks, threshold)
    pairs = known.where("may").select("rep", "hub", "several")
    chunks = pairs.groupBy("hub").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"))
    own = F.pmod(F.xxhash64("rep"), F.col("chunks")).cast("int").alias("chunk")
    dealt = pairs.join(chunks, "hub").select("hub", own, "rep", "several")
    middle = chunks.select("hub", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), F.col("hub").alias("rep"), F.lit(False).alias("several"))
    members = pairs.select(F.explode(F.array("rep", "hub")).alias("rep")).distinct()
    both = dealt.unionByName(middle).join(sets(members), "rep").select("hub", "chunk", "rep", "several", "content")
    ordered = both.repartition("hub", "chunk").sortWithinPartitions("hub", "chunk", F.col("rep") != F.col("hub"))
    compared = ordered.mapInArrow(_star_tester(threshold), "rep long, hub long, several boolean, distance double, linked boolean")
    return settle(compared.unionByName(known.where("NOT may").drop("may").withColumn("linked", F.lit(False))), "tested")


def set_table(df: DataFrame, wanted: DataFrame, n: int, name: Callable[[bytes], int] | None = None) -> DataFrame:
    """(rep, content): the sets of the documents (id, text) whose id is in `wanted`, named by the id or from their content.

    The wanted ids grow with the documents: never a broadcast; hashing spares sorting the texts. Equal rows count
    once; they lie in one partition already, so that takes no shuffle.
    """
    members = df.join(wanted.hint("shuffle_hash"), "id").select("id", "text").dropDuplicates(["id", "text"])
    return members.mapInArrow(_set_maker(n, name), "rep long, content binary").where("octet_length(content) > 0")


def confirmed(
    near: DataFrame, marks: DataFrame, sets: Callable[[DataFrame], DataFrame], threshold: Fraction, block: int = CHUNK
) -> DataFrame:
    """(rep, hub): links whose components are those of all links between members of a bucket.

    `near` holds (rep, hub, several) once for each set and hub that share a bucket; `several` if one of
    these buckets has more than two members. Its rows of a hub with itself say nothing. `marks` holds the sketches
    of all sets, see `sketched`; `sets` gives the (rep, content) of at least the reps it is asked for.
    """
    known = tested(near.where("rep != hub"), marks, sets, threshold)
    links = known.where("linked").select("rep", "hub")

    # sets that are one component by their links to any hubs have one label; beside these each set is a component
    labels = component_labels(links, "rep", "hub").withColumnRenamed("node", "rep")
    rows = known.where("several").join(labels, "rep", "left").withColumn("label", F.coalesce("label", "rep"))
    close = F.coalesce("distance", F.lit(0.0))
    far = F.coalesce("distance", F.lit(1.0))
    state = rows.groupBy("hub").agg(
        F.min(F.when(~F.col("linked"), close)).alias("nearest"),
        F.max(F.when(F.col("linked"), far)).alias("farthest"),
        F.count_if(~F.col("linked")).alias("others"),
        F.ceil(F.count_if(~F.col("linked")) / block).cast("int").alias("a"),
        F.ceil(F.count_if("linked") / block).cast("int").alias("b"),
    )
    reach = F.lit(float(1 - threshold) + 1e-9)
    outside = (F.col("others") > 1) | (close - reach <= F.col("farthest"))
    needed = rows.join(state.where("others > 0"), "hub").where(F.when(F.col("linked"), far + reach >= F.col("nearest")).otherwise(outside))
    # blocks of the others, 0 to a - 1, meet all blocks; those of the hub's component, a to a + b - 1, meet these alone
    place = F.xxhash64("rep")
    own = F.when(F.col("linked"), F.col("a") + F.pmod(place, F.col("b"))).otherwise(F.pmod(place, F.col("a"))).cast("int")
    last = F.when(F.col("linked"), F.col("a")).otherwise(F.col("a") + F.col("b")) - 1
    dealt = needed.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), last)))
    dealt = dealt.select(
        "hub",
        F.least("own", "other").alias("i"),
        F.greatest("own", "other").alias("j"),
        "rep",
        "label",
        (F.col("own") <= F.col("other")).alias("near"),
    )
    light = dealt.join(marks, "rep").repartition("hub", "i", "j").sortWithinPartitions("hub", "i", "j")
    parted = light.mapInArrow(_parter(threshold), "hub long, i int, j int, rep long, label long, near boolean")
    parted = settle(parted, "parted")
    ordered = parted.join(sets(parted.select("rep").distinct()), "rep").repartition("hub", "i", "j").sortWithinPartitions("hub", "i", "j")
    rest = settle(ordered.mapInArrow(_block_tester(threshold), "rep long, hub long"), "rest")
    return links.unionByName(rest)
