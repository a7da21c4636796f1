"""Near-duplicate texts: a Jaccard self-join on word shingles by vertical partitioning.

The global order of all shingles runs from rare to frequent (frequencies from a counting sketch over all
texts, ties by hash). Pivots cut the order into fragments, so that each text's set becomes one segment per
fragment. Overlaps are counted per pair and fragment and summed per pair. Pairs to count come from the
rare end of the order: two sets that are similar enough share a shingle there, and how far from the end their
first common one may lie depends on both sizes.

Identical sets are one node throughout. In a large group of near copies the pairs are not all counted:
each node is first compared with one well connected node per shared shingle, and after that only pairs whose
components still differ are. No link between different components is lost, so the components are exact.

Sets are compared by 56-bit shingle hashes and named by a 64-bit hash of the whole set.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsemark.llm.components import connected, relabel
from pulsemark.llm.sizes import store
from pulsemark.llm.text import Words, gives_back, light_batches, mix, released, runs
from pulsemark.session import cut

#: Counters of the frequency sketch, in slots of SLOT counters each. Only the quality of the order depends on it.
SKETCH = 1 << 21
SLOT = 1 << 12
#: Pieces into which the global order is cut.
FRAGMENTS = 8
#: Bits of the filter that tells which texts are read again; past that size it lets more texts through.
FILTER_BITS = 1 << 26
#: Up to so many counted pairs go to every task; more are joined by shuffles.
BROADCAST_PAIRS = 300_000

_ODD = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3,
                 0x589965CC75374CC3, 0x1D8E4E27C47D124F, 0xEB44ACCAB455D165, 0x9C6E6877736C46E3], np.uint64)


def shingle_sets(column: pa.Array, n: int) -> Iterator[np.ndarray]:
    """Per row the sorted distinct 56-bit hashes of its shingles of n words."""
    for lo, hi, data, at in runs(column):
        words = Words(data, at)
        h, bounds = words.hashes, words.bounds
        grams = np.zeros(max(0, len(h) - n + 1), np.uint64)
        for k in range(n):
            grams += mix(h[k: k + len(grams)] + _ODD[k % 8: k % 8 + 1] * np.uint64(k + 1))
            grams *= _ODD[(k + 3) % 8]
        grams = mix(grams) >> np.uint64(8)
        for row in range(hi - lo):
            a, b = int(bounds[row]), int(bounds[row + 1])
            if b - a >= n:
                found = np.sort(grams[a: b - n + 1])
                keep = np.ones(len(found), bool)
                keep[1:] = found[1:] != found[:-1]
                yield found[keep]
            elif b > a:  # fewer words: the whole sequence is the one shingle
                x = np.array([b - a], np.uint64)
                for k in range(a, b):
                    x = mix(x * _ODD[7] + h[k: k + 1])
                yield x >> np.uint64(8)
            else:
                yield np.zeros(0, np.uint64)


def _name(found: np.ndarray) -> int:
    """A 64-bit name of a set."""
    total = mix(found * _ODD[0]).sum(dtype=np.uint64, keepdims=True)
    return int(mix(total + _ODD[1:2] * np.uint64(len(found))).view(np.int64)[0])


def _measure(n: int):
    """Names and sizes of all sets, and the task's counts of the sketch."""
    def run(batches):
        counts = np.zeros(SKETCH, np.int64)
        for batch in released(batches):
            names, sizes = [], []
            for found in shingle_sets(batch.column(1), n):
                names.append(_name(found) if len(found) else None)
                sizes.append(len(found))
                np.add.at(counts, (found & np.uint64(SKETCH - 1)).astype(np.int64), 1)
            nothing = pa.nulls(len(names))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.int64()), pa.array(sizes, pa.int64()),
                 nothing.cast(pa.int32()), nothing.cast(pa.binary())], ["id", "node", "n", "slot", "counts"])
        for lo in range(0, SKETCH // SLOT if counts.any() else 0, 64):
            small = np.minimum(counts.reshape(-1, SLOT)[lo: lo + 64], 2**31 - 1).astype(np.int32)
            nothing = pa.nulls(len(small))
            yield pa.RecordBatch.from_arrays(
                [nothing.cast(pa.int64()), nothing.cast(pa.int64()), nothing.cast(pa.int64()),
                 pa.array(range(lo, lo + len(small)), pa.int32()), pa.array([x.tobytes() for x in small], pa.binary())],
                ["id", "node", "n", "slot", "counts"])
    return gives_back(run)


def _add_up(batches):
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for slot, counts in zip(batch.column(0).to_pylist(), batch.column(1)):
            new = np.frombuffer(counts.as_buffer(), np.int32)
            sums[slot] = sums[slot] + new if slot in sums else new.astype(np.int64)
    if sums:
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())],
            ["slot", "counts"])


def _order(sketched: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Frequency class per counter and the pivots of the fragments; SKETCH / SLOT rows reach the driver."""
    rows = sketched.select("slot", "counts").repartition("slot").mapInArrow(
        gives_back(_add_up), "slot int, counts binary").collect()
    counts = np.zeros(SKETCH, np.int64)
    for row in rows:
        counts[row.slot * SLOT: (row.slot + 1) * SLOT] = np.frombuffer(row.counts, np.int64)
    classes = np.minimum(127, np.floor(3 * np.log2(1 + counts))).astype(np.uint8)
    # Within a class hashes are even, so that the mass of the classes gives even pivots.
    mass = np.bincount(classes, weights=counts, minlength=128)
    ends = np.cumsum(mass)
    pivots = []
    for k in range(1, FRAGMENTS):
        want = ends[-1] * k / FRAGMENTS
        c = int(np.searchsorted(ends, want))
        inside = (want - (ends[c] - mass[c])) / max(mass[c], 1)
        pivots.append((c << 56) + int(inside * (2**56 - 1)))
    return classes, np.array(pivots, np.uint64)


def _ordered(found: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """A set's places in the global order, ascending: class in the high byte, hash below."""
    c = classes[(found & np.uint64(SKETCH - 1)).astype(np.int64)].astype(np.uint64)
    return np.sort((c << np.uint64(56)) | found)


def _rare_ends(n: int, percent: int, shared):
    """Each set's rarest places, as many as a similar set cannot all miss."""
    def run(batches):
        classes = shared.value
        for batch in released(batches):
            keys, nodes, sizes, ranks, spots = [], [], [], [], []
            for found in shingle_sets(batch.column(0), n):
                if not len(found):
                    continue
                places = _ordered(found, classes)
                size = len(places)
                keys.append(places[: size - (-(-percent * size // 100)) + 1])
                # Nodes of frequent shingles come first: an original before its edited copies.
                common = int((places >> np.uint64(56)).sum(dtype=np.int64) * 4 // size)
                nodes.append(np.full(len(keys[-1]), _name(found), np.int64))
                sizes.append(np.full(len(keys[-1]), size, np.int32))
                ranks.append(np.full(len(keys[-1]), -common, np.int32))
                spots.append(np.arange(len(keys[-1]), dtype=np.int32))
                if len(keys) >= 1000:
                    yield _rare_rows(keys, nodes, sizes, ranks, spots)
                    keys, nodes, sizes, ranks, spots = [], [], [], [], []
            if keys:
                yield _rare_rows(keys, nodes, sizes, ranks, spots)
    return gives_back(run)


def _rare_rows(keys, nodes, sizes, ranks, spots):
    keys = [x.view(np.int64) for x in keys]
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate(x)) for x in (keys, nodes, sizes, ranks, spots)],
        ["key", "node", "n", "rank", "spot"])


def _around_centers(batches):
    """From rows sorted by key, rank and node: each later node of a key with the key's first node.

    Keeps the current key's first node only, however many rows a key has.
    """
    key0 = node0 = None
    center, center_n, center_spot = 0, 0, 0
    for batch in batches:
        key, node, size, spot = (batch.column(k).to_numpy() for k in range(4))
        if not len(key):
            continue
        fresh = np.ones(len(key), bool)  # not the row before once more
        fresh[1:] = (key[1:] != key[:-1]) | (node[1:] != node[:-1])
        fresh[0] = key[0] != key0 or node[0] != node0
        begins = np.ones(len(key), bool)
        begins[1:] = key[1:] != key[:-1]
        begins[0] = key[0] != key0
        at = np.maximum.accumulate(np.where(begins, np.arange(len(key)), -1))
        centers = np.where(at < 0, center, node[at])
        centers_n = np.where(at < 0, center_n, size[at]).astype(np.int32)
        spots = np.where(at < 0, center_spot, spot[at]).astype(np.int32)
        key0, node0 = key[-1], node[-1]
        center, center_n, center_spot = int(centers[-1]), int(centers_n[-1]), int(spots[-1])
        out = fresh & (node != centers)
        yield pa.RecordBatch.from_arrays(
            [pa.array(x[out]) for x in (key, node, size, spot, centers, centers_n, spots)],
            ["key", "node", "n", "spot", "center", "center_n", "center_spot"])


def _place(ids: np.ndarray) -> np.ndarray:
    return (mix(ids.view(np.uint64)) % np.uint64(FILTER_BITS)).astype(np.int64)


def _id_places(batches):
    for batch in batches:
        at = _place(batch.column(0).drop_null().to_numpy())
        yield pa.RecordBatch.from_arrays(
            [pa.array(at >> 6), pa.array(np.uint64(1) << (at & 63).astype(np.uint64)).view(pa.int64())], ["word", "bits"])


def _filter_of(ids: DataFrame) -> np.ndarray:
    """A bit per hashed id; at most FILTER_BITS / 64 rows reach the driver."""
    words = ids.mapInArrow(gives_back(_id_places), "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toPandas()
    out = np.zeros(FILTER_BITS // 64, np.uint64)
    out[words.word.to_numpy(np.int64)] = words.bits.to_numpy(np.int64).view(np.uint64)
    return out


def _segments(n: int, shared, wanted, pivots: np.ndarray):
    """The segments, one per fragment, of the sets of the wanted rows and of a few others by chance."""
    def run(batches):
        classes, bits = shared.value, wanted.value
        for batch in released(batches):
            nodes, counts, places = [], [], []
            at = _place(batch.column(1).fill_null(0).to_numpy())
            hit = (bits[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1
            texts = batch.column(0).filter(pa.array(hit | batch.column(1).is_null().to_numpy(zero_copy_only=False)))
            for found in shingle_sets(texts, n):
                if not len(found):
                    continue
                ordered = _ordered(found, classes)
                ends = np.concatenate([[0], np.searchsorted(ordered, pivots), [len(ordered)]])
                nodes.append(_name(found))
                counts.append(np.diff(ends))
                places.append(ordered.view(np.int64))
            if nodes:
                inner = np.concatenate([[0], np.cumsum(np.concatenate(counts))]).astype(np.int32)
                segments = pa.ListArray.from_arrays(pa.array(inner), pa.array(np.concatenate(places)))
                outer = pa.array(np.arange(0, FRAGMENTS * len(nodes) + 1, FRAGMENTS, dtype=np.int32))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(nodes, pa.int64()), pa.ListArray.from_arrays(outer, segments)], ["node", "segments"])
    return gives_back(run)


def _possible(percent: int):
    """Whether a pair can be similar if the shingle at these spots is its first common one in the order."""
    need = F.ceil((F.col("a_n") + F.col("b_n")) * percent / (100 + percent))
    return (F.col("a_n") - F.col("a_spot") >= need) & (F.col("b_n") - F.col("b_spot") >= need)


def _verified(pairs: DataFrame, segments: DataFrame, percent: int) -> tuple[DataFrame, int]:
    """Pairs (a, b) whose overlaps, counted per fragment and summed, reach the threshold; at most how many.

    ``pairs`` is a stored frame.
    """
    count = pairs.count()
    pairs = pairs.select("a", "a_n", "b", "b_n")
    small = F.broadcast(pairs) if count <= BROADCAST_PAIRS else pairs
    ends = pairs.select(F.col("b").alias("node")).distinct()
    left = segments.select(F.col("node").alias("a"), F.col("segments").alias("a_segments"))
    right = segments.join(F.broadcast(ends) if count <= BROADCAST_PAIRS else ends, "node", "left_semi").select(
        F.col("node").alias("b"), F.col("segments").alias("b_segments"))
    partial = [F.size(F.array_intersect(F.col("a_segments")[k], F.col("b_segments")[k])) for k in range(FRAGMENTS)]
    counted = left.join(small, "a").join(right, "b").select("a", "b", "a_n", "b_n", sum(partial, F.lit(0)).alias("c"))
    # A repeated input row repeats its segments.
    total = counted.groupBy("a", "b", "a_n", "b_n").agg(F.max("c").alias("c"))
    close = total.where(F.col("c") * 100 >= percent * (F.col("a_n") + F.col("b_n") - F.col("c"))).select("a", "b")
    return close, count


def near_components(docs: DataFrame, n: int = 5, percent: int = 80, id_column: str = "doc_id",
                    text_column: str = "text") -> DataFrame:
    """Per row its id, the size of its shingle set and the smallest id of its component.

    Words are split at ASCII white space after lower-casing A-Z. Two rows link when
    100 * intersection >= percent * union of their sets of shingles of n words. Null, empty and
    white texts have size 0 and stay alone; their component is their own id. Rows with the same id are each
    returned. A null id stays null and is never a component's name unless all ids of the component are null.
    An empty table gives an empty result. Further columns are ignored.
    """
    spark = light_batches(docs.sparkSession)
    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    measured = cut(rows.mapInArrow(_measure(n), "id long, node long, n long, slot int, counts binary"))
    members = measured.where("slot is null").select("id", "node", "n")
    classes, pivots = _order(measured.where("slot is not null"))
    shared = spark.sparkContext.broadcast(classes)
    rare = rows.select("text").mapInArrow(
        _rare_ends(n, percent, shared), "key long, node long, n int, rank int, spot int")
    grouped = rare.repartition("key").sortWithinPartitions("key", "rank", "node")
    around = cut(grouped.select("key", "node", "n", "spot").mapInArrow(
        gives_back(_around_centers),
        "key long, node long, n int, spot int, center long, center_n int, center_spot int"))

    met = around.select(
        F.col("node").alias("a"), F.col("n").alias("a_n"), F.col("spot").alias("a_spot"),
        F.col("center").alias("b"), F.col("center_n").alias("b_n"), F.col("center_spot").alias("b_spot"))
    rows_met = around.count()
    pairs = store(met.where(_possible(percent)).groupBy("a", "a_n", "b", "b_n").agg(F.count("*").alias("hits")), rows_met)
    touched = around.select("node").union(around.select(F.col("center").alias("node"))).distinct()
    holders = members.join(touched, "node", "left_semi").groupBy("node").agg(F.min("id").alias("id"))
    wanted = spark.sparkContext.broadcast(_filter_of(holders.select("id")))
    segments = cut(rows.select("text", "id").mapInArrow(
        _segments(n, shared, wanted, pivots), "node long, segments array<array<long>>"))
    shared.unpersist()
    wanted.unpersist()

    # 1: every node with the center it shares most rare shingles with.
    best = store(pairs.groupBy("a", "a_n").agg(F.max(F.struct("hits", "b", "b_n")).alias("m")).select(
        "a", "a_n", "m.b", "m.b_n"), pairs.count())
    labels = connected(*_verified(best, segments, percent))
    # 2: its other centers, where the components still differ.
    rest = pairs.join(best.select("a", "b"), ["a", "b"], "left_anti")
    labels = _merged(rest, pairs.count(), labels, segments, percent)
    # 3: all other pairs at a rare shingle, where the components still differ.
    places = around.select("key", "node", "n", "spot").union(around.select(
        "key", F.col("center").alias("node"), F.col("center_n").alias("n"),
        F.col("center_spot").alias("spot")).distinct())
    placed = store(_labelled(places, labels, "node", "label"), 2 * rows_met)
    mixed = placed.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi")
    open_rows = placed.join(mixed.select("key"), "key", "left_semi")
    a, b = (open_rows.select("key", *[F.col(c).alias(f"{side}_{c}") for c in ("node", "n", "spot", "label")])
            for side in "ab")
    left = a.join(b, "key").where(F.col("a_label") < F.col("b_label")).where(_possible(percent)).select(
        F.col("a_node").alias("a"), "a_n", F.col("b_node").alias("b"), "b_n").distinct()
    known = pairs.select("a", "b").union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = _merged(left.join(known, ["a", "b"], "left_anti"), 2 * rows_met, labels, segments, percent)

    named = _labelled(members.where("n > 0"), labels, "node", "label")
    smallest = named.groupBy("label").agg(F.min("id").alias("component"))
    linked = named.join(smallest, "label").select("id", "n", "component")
    alone = members.where("n = 0").select("id", "n", F.col("id").alias("component"))
    return linked.union(alone).select(
        F.col("id").alias(id_column), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


def _labelled(df: DataFrame, labels: DataFrame, node: str, name: str) -> DataFrame:
    """Add each node's label, its own name where it has none."""
    known = labels.select(F.col("node").alias("_node"), F.col("label").alias("_label"))
    return df.join(known, F.col(node) == F.col("_node"), "left").withColumn(
        name, F.coalesce("_label", node)).drop("_node", "_label")


def _merged(pairs: DataFrame, rows: int, labels: DataFrame, segments: DataFrame, percent: int) -> DataFrame:
    """Labels after linking the similar ones among the pairs of different components."""
    both = _labelled(_labelled(pairs, labels, "a", "a_label"), labels, "b", "b_label")
    differ = store(both.where("a_label <> b_label"), rows)
    close, count = _verified(differ, segments, percent)
    joined = close.join(differ.select("a", "b", "a_label", "b_label"), ["a", "b"])
    higher = connected(joined.select(F.col("a_label").alias("a"), F.col("b_label").alias("b")), count)
    return relabel(labels, higher, labels.count() + 2 * count)
