"""N-gram Jaccard join: prefix filters under several global token orders.

Texts are sets of word shingles. Two sets link if their Jaccard similarity is
``percent`` or more. Exact, in these steps:

1. Every text becomes a class id, a hash of its whole set, so equal sets are
   one class from here on. Two frequency sketches of fixed size count the
   shingles of the whole corpus.
2. Under a global order of the shingles, two linked sets share one among the
   first few of each. Order A sorts by the first sketch's count, rare ones
   first, order B by the second sketch's; ties fall by different hashes. Any
   order is right; rare first makes few candidates.
3. Prefixes under A are grouped by shingle. Sizes and places in the prefix
   bound the overlap of a pair and drop most pairs at once.
4. First, every class is paired only with the leader of each of its groups
   (the class that has the shingle earliest). Verified links join classes to
   components. Then all pairs of a group that are still in different
   components are generated. Links inside a component cannot change it, so a
   group of thousands of near copies never makes all its pairs.
5. A pair must also share a shingle of its prefixes under B; only pairs that
   pass both filters get their whole sets for the exact verification.

Shingles and classes are known by 64-bit hashes; a class id that two
different sets share is found by a second hash, and the classes get new ids.

Defined results: a null or empty text has no shingles, size 0, and links with
nothing. Rows with equal ids and different texts are two documents. The
component of a row is the smallest id among the rows of its component, nulls
last. Extra columns are not read, or passed on by ``drop_near_copies``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from playstats.llm import bloom
from playstats.llm.common import mix64, prepare, released, slices, sort_rows, text_column
from playstats.llm.components import components
from playstats.llm.shingles import shingle_sets
from playstats.session import cut_lineage, remove_stage

WORDS, PERCENT = 5, 80
#: Counters of one sketch, and of one slice of it.
LOG2_COUNTERS, SLICE = 22, 1 << 12
ORDERS = 2
#: Bytes of text whose shingles a worker holds at once.
SLICE_BYTES = 1 << 20


def _set_ids(h: np.ndarray, r: np.ndarray, n: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each row two 64-bit hashes of its set, and the set's size."""
    import xxhash

    counts = np.bincount(r, minlength=n)
    ends = np.cumsum(counts)
    data = h.astype("<u8").tobytes()
    raw = [xxhash.xxh3_128_intdigest(data[8 * (e - c) : 8 * e], seed) for e, c in zip(ends.tolist(), counts.tolist())]
    low = np.array([x & (2**64 - 1) for x in raw], np.uint64).view(np.int64)
    high = np.array([x >> 64 for x in raw], np.uint64).view(np.int64)
    return low, high, counts


def _counters(h: np.ndarray, order: int, log2: int) -> np.ndarray:
    return (mix64(h, 100 + order) >> np.uint64(64 - log2)).astype(np.int64)


def _prefix_keys(h: np.ndarray, levels: np.ndarray, order: int, log2: int) -> np.ndarray:
    """Sort keys of shingles under an order: the counter's level, then a hash."""
    level = levels[order][_counters(h, order, log2)].astype(np.uint64)
    return level << np.uint64(56) | mix64(h, 200 + order) >> np.uint64(8)


def _in_order(h: np.ndarray, r: np.ndarray, keys: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first ``length[row]`` shingles of each row by ``keys``: hashes, rows, places."""
    order = sort_rows(r, keys)
    h, r = h[order], r[order]
    counts = np.bincount(r, minlength=len(length))
    place = np.arange(len(h)) - np.repeat(np.cumsum(counts) - counts, counts)
    near = place < length[r]
    return h[near], r[near], place[near]


def _lists(values: np.ndarray, rows: np.ndarray, n: int) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=n))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64)))


def _identified(docs: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    """id, text and a hash of the text, which tells rows with the same id apart."""
    text = F.col(f"`{text_col}`")
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), text.alias("text"), F.xxhash64(text).alias("t"), *more)


def _probe_length(counts: np.ndarray, percent: int) -> np.ndarray:
    """How many of a set's first shingles a linked set may share only one of."""
    return np.where(counts > 0, counts - (percent * counts + 99) // 100 + 1, 0)


class JaccardJoin:
    """The join over one table; ``words`` to a shingle, links from ``percent`` per cent on."""

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT, log2: int = LOG2_COUNTERS):
        self.spark = prepare(docs.sparkSession)
        self.docs = _identified(docs, id_col, text_col)
        self.words, self.percent, self.log2 = words, percent, log2
        self.seed = 0
        self.entries, self.levels = self._enter()
        while self.entries.groupBy("k").agg(F.min("k2").alias("x"), F.max("k2").alias("y")).where("x <> y").limit(1).count():
            self.seed += 1
            self.entries, self.levels = self._enter()

    # sizes and bounds, in whole numbers

    def _needed(self, a: Column, b: Column) -> Column:
        """Least overlap of linked sets of sizes a and b."""
        return F.ceil((a + b) * self.percent / F.lit(100.0 + self.percent) - F.lit(1e-9))

    def _index_length(self, n: Column) -> Column:
        return n - F.ceil(n * (2 * self.percent) / F.lit(100.0 + self.percent) - F.lit(1e-9)) + 1

    # passes over the texts

    def _enter(self) -> tuple[DataFrame, np.ndarray]:
        """(id, t, k, k2, n) of every row, and the sketches' levels."""
        words, log2, seed = self.words, self.log2, self.seed

        def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            counts, held = np.zeros((ORDERS, 1 << log2), np.uint32), []

            def add_up() -> None:
                for order in range(ORDERS if held else 0):
                    counts[order] += np.bincount(_counters(np.concatenate(held), order, log2), minlength=1 << log2).astype(np.uint32)
                held.clear()

            names = ["id", "t", "k", "k2", "n", "slice", "counts"]
            for batch in batches:
                for part in slices(batch, "text", SLICE_BYTES):
                    h, r = shingle_sets(text_column(part, "text"), words)
                    k, k2, n = _set_ids(h, r, part.num_rows, seed)
                    held.append(h)
                    if sum(map(len, held)) >= 1 << 20:
                        add_up()
                    none = [pa.nulls(part.num_rows, pa.int32()), pa.nulls(part.num_rows, pa.binary())]
                    yield pa.RecordBatch.from_arrays([part.column("id"), part.column("t"), pa.array(k), pa.array(k2), pa.array(n.astype(np.int64)), *none], names=names)
            add_up()
            size = min(SLICE, 1 << log2)
            for at, block in enumerate(counts.reshape(-1, size)):
                if block.any():
                    none = [pa.nulls(1, pa.int64())] * 5
                    # in the fewest bytes that hold the counts
                    block = block.astype(np.min_scalar_type(block.max()))
                    yield pa.RecordBatch.from_arrays([*none, pa.array([at], pa.int32()), pa.array([block.tobytes()])], names=names)

        def merge(table: pa.Table) -> pa.Table:
            size = min(SLICE, 1 << log2)
            total = np.zeros(size, np.uint64)
            for block in table.column("counts"):
                block = block.as_py()
                total += np.frombuffer(block, f"u{len(block) // size}")
            level = np.minimum(np.round(8 * np.log2(1 + total.astype(float))), 255).astype(np.uint8)
            return pa.table({"slice": table.column("slice")[:1], "level": pa.array([level.tobytes()])})

        schema = "id bigint, t bigint, k bigint, k2 bigint, n bigint, slice int, counts binary"
        # few tasks, so that there are few sketches to add up
        made = cut_lineage(self.docs.coalesce(self.spark.sparkContext.defaultParallelism).mapInArrow(released(enter), schema), "jaccard-entries")
        size = min(SLICE, 1 << log2)
        levels = np.zeros((ORDERS << log2) // size * size, np.uint8)
        merged = made.where("slice is not null").groupBy("slice").applyInArrow(merge, "slice int, level binary")
        for row in merged.toLocalIterator():  # ORDERS * 2 ** log2 bytes at any input
            levels[row["slice"] * size : (row["slice"] + 1) * size] = np.frombuffer(row["level"], np.uint8)
        return made.where("slice is null").select("id", "t", "k", "k2", "n"), levels.reshape(ORDERS, -1)

    def _prefixes(self) -> DataFrame:
        """(token, k, n, place): the prefix of every class under order A."""
        words, percent, log2, seed = self.words, self.percent, self.log2, self.seed
        shared = self.spark.sparkContext.broadcast(self.levels)

        def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen: set[int] = set()
            for batch in batches:
                for part in slices(batch, "text", SLICE_BYTES):
                    h, r = shingle_sets(text_column(part, "text"), words)
                    k, _, n = _set_ids(h, r, part.num_rows, seed)
                    # a set that this task has had already is not repeated
                    new = np.array([x not in seen and not seen.add(x) for x in k.tolist()], bool)
                    length = np.where(new, _probe_length(n, percent), 0)
                    h, r, place = _in_order(h, r, _prefix_keys(h, shared.value, 0, log2), length)
                    columns = [h.view(np.int64), k[r], n[r].astype(np.int32), place.astype(np.int32)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["token", "k", "n", "place"])

        return self.docs.mapInArrow(released(prefixes), "token bigint, k bigint, n int, place int")

    def _sets(self, ids: DataFrame) -> DataFrame:
        """(k, under_b, shingles) of the rows with these ids."""
        words, percent, log2, seed = self.words, self.percent, self.log2, self.seed
        shared = self.spark.sparkContext.broadcast(self.levels)
        wanted = self.spark.sparkContext.broadcast(bloom.seen_once(ids.select("id")))

        def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = np.frombuffer(wanted.value, np.uint8)
            for batch in batches:
                near = bloom.in_filter(held, batch.column("id").fill_null(-1).to_numpy(), bloom.LOG2_BITS) | batch.column("id").is_null().to_numpy(zero_copy_only=False)
                for part in slices(batch.filter(pa.array(near)), "text", SLICE_BYTES):
                    h, r = shingle_sets(text_column(part, "text"), words)
                    k, _, n = _set_ids(h, r, part.num_rows, seed)
                    b, br, _ = _in_order(h, r, _prefix_keys(h, shared.value, 1, log2), _probe_length(n, percent))
                    yield pa.RecordBatch.from_arrays([pa.array(k), _lists(b, br, part.num_rows), _lists(h, r, part.num_rows)], names=["k", "under_b", "shingles"])

        return self.docs.mapInArrow(released(sets), "k bigint, under_b array<bigint>, shingles array<bigint>")

    # candidates and links

    def _bounded(self, a: str, b: str) -> Column:
        """Whether sizes and places allow a link of the pair that meets at a shingle."""
        na, nb, pa_, pb = (F.col(f"{s}.{c}") for c in ("n", "place") for s in (a, b))
        sizes = F.least(na, nb) * 100 >= F.greatest(na, nb) * self.percent
        rest = 1 + F.least(na - pa_ - 1, nb - pb - 1) >= self._needed(na, nb)
        indexed = F.when(na <= nb, pa_ < self._index_length(na)).otherwise(pb < self._index_length(nb))
        return sizes & rest & indexed

    def _verified(self, pairs: DataFrame, classes: DataFrame, name: str) -> DataFrame:
        """The linked ones of stored distinct pairs (a, b)."""
        if pairs.isEmpty():
            return pairs
        wanted = pairs.select(F.col("a").alias("k")).union(pairs.select(F.col("b"))).distinct()
        ids = wanted.join(classes, "k").select(F.col("label.id").alias("id"))
        sets = cut_lineage(self._sets(ids).join(wanted, "k", "left_semi").dropDuplicates(["k"]), f"jaccard-sets-{name}")
        a, b = (sets.select(F.col("k").alias(s), F.col("under_b").alias(f"u{s}"), F.col("shingles").alias(f"s{s}")) for s in ("a", "b"))
        both = pairs.join(a.select("a", "ua"), "a").join(b.select("b", "ub"), "b").where(F.arrays_overlap("ua", "ub")).select("a", "b")
        whole = both.join(a.select("a", "sa"), "a").join(b.select("b", "sb"), "b")
        whole = whole.select("a", "b", F.size("sa").alias("na"), F.size("sb").alias("nb"), F.size(F.array_intersect("sa", "sb")).alias("common"))
        linked = whole.where(F.col("common") * 100 >= (F.col("na") + F.col("nb") - F.col("common")) * self.percent)
        linked = cut_lineage(linked.select("a", "b"), f"jaccard-links-{name}")
        remove_stage(sets)
        return linked

    def classes(self) -> DataFrame:
        """(k, label, n): the classes with shingles; a label is (no id, smallest id, k, smallest text hash t with that id)."""
        label = F.min(F.struct(F.col("id").isNull().alias("last"), "id", "k", "t"))
        return self.entries.where("n > 0").groupBy("k").agg(label.alias("label"), F.first("n").alias("n"))

    def links(self) -> tuple[DataFrame, DataFrame]:
        """Links (a, b) that join all components, and (k, label) of every linked class."""
        prefixes = cut_lineage(self._prefixes().select("token", "k", "n", "place").dropDuplicates(["token", "k"]), "jaccard-prefixes")
        # added up before the shuffle, and joined so that a token of many classes can be split
        shared = prefixes.groupBy("token").agg(F.min("k").alias("least"), F.max("k").alias("most")).where("least < most")
        groups = cut_lineage(prefixes.join(shared.select("token"), "token"), "jaccard-groups")
        remove_stage(prefixes)
        classes = cut_lineage(self.classes(), "jaccard-classes")

        leaders = cut_lineage(groups.groupBy("token").agg(F.min(F.struct("place", "n", "k")).alias("lead")), "jaccard-leaders")
        led = groups.alias("x").join(leaders.select("token", "lead.*").alias("y"), "token").where(F.col("x.k") != F.col("y.k"))
        pair = (F.least("x.k", "y.k").alias("a"), F.greatest("x.k", "y.k").alias("b"))
        first = cut_lineage(led.where(self._bounded("x", "y")).select(*pair).distinct(), "jaccard-first")
        links = self._verified(first, classes, "first")
        joined = components(links, classes)
        part = groups.join(joined.select("k", F.col("label.k").alias("part")), "k", "left")
        part = cut_lineage(part.withColumn("part", F.coalesce("part", "k")), "jaccard-parts")
        x, y = part.alias("x"), part.alias("y")
        meets = (F.col("x.token") == F.col("y.token")) & (F.col("x.k") < F.col("y.k")) & (F.col("x.part") != F.col("y.part"))
        rest = x.join(y, meets & self._bounded("x", "y")).select(F.col("x.k").alias("a"), F.col("y.k").alias("b")).distinct()
        rest = cut_lineage(rest.join(first, ["a", "b"], "left_anti"), "jaccard-rest")
        links = links.union(self._verified(rest, classes, "rest"))
        remove_stage(groups, leaders, part)
        return links, components(links, classes)

    def row_components(self) -> DataFrame:
        """Of every row: id, t, n, the ``component`` (its smallest id) and whether the row ``leads`` it.

        The leading rows have the smallest id, and of its texts one; a text
        without shingles leads itself.
        """
        _, labels = self.links()
        found = self.classes().select("k", F.col("label").alias("own")).join(labels, "k", "left")
        found = found.select(F.col("k").alias("key"), F.coalesce("label", "own").alias("label"))
        out = self.entries.withColumn("key", F.when(F.col("n") > 0, F.col("k"))).join(found, "key", "left")
        leads = (F.col("n") == 0) | (F.col("id").eqNullSafe(F.col("label.id")) & (F.col("k") == F.col("label.k")) & (F.col("t") == F.col("label.t")))
        component = F.when(F.col("n") > 0, F.col("label.id")).otherwise(F.col("id"))
        return out.select("id", "t", "n", component.alias("component"), leads.alias("leads"))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per row: id, ``n_shingles`` and ``component_id``."""
    found = JaccardJoin(docs, id_col, text_col, words, percent).row_components()
    return found.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``docs``, all columns, with one row for each component: the one with the smallest id.

    Rows that repeat an id and its text are one document.
    """
    found = JaccardJoin(docs, id_col, text_col, words, percent).row_components()
    lead = found.where("leads").select(F.col("id").alias("lead_id"), F.col("t").alias("lead_t")).distinct()
    packed = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = _identified(docs, id_col, text_col, packed).select("id", "t", "row")
    same = F.col("id").eqNullSafe(F.col("lead_id")) & F.col("t").eqNullSafe(F.col("lead_t"))
    return rows.join(lead, same, "left_semi").dropDuplicates(["id", "t"]).select("row.*")
