"""N-gram Jaccard self-join: T-occurrence search over inverted lists, DivideSkip style.

A document is the set of its distinct 5-word shingles (52-bit hashes). Two documents link when
100 * intersection >= 75 * union. A set of n shingles needs T = ceil(0.75 n) of them in common
with any partner; DivideSkip merges the n - T + 1 short lists, counting, and probes the T - 1 long ones.
Here, with lists spread over the cluster:

1. Lists. Map tasks sort runs of documents' shingles and cut them by hash range; a range's task
   merges the runs' lists and counts each shingle's documents. A list of one document is no
   link, so only shingles of two or more documents go back to their run, as blobs of a few
   bytes a shingle. A text's copies within a run post once.
2. Prefixes. A run's task orders each document's shingles by (list length, hash). The n - T + 1
   shortest lists, unshared ones first, must hold a partner: a document with that many unshared
   shingles has none and is done.
3. Stars. Documents left are compared with the most central one among those that share their
   smallest hashed shingle, for a few hash functions: linear in the documents, however large a
   group of near copies. Connected components follow.
4. Merging. Short lists are merged between documents of *different* components (a list within one
   component has nothing to add, so a large group of near copies emits no pairs), by shingle and
   length band, long lists in parts: a grouped count says how many short lists two documents share.
   Those that have the required overlap link; those that can't reach it with all that is behind their
   last shared list are out.
5. Probing. What is left is decided on the long lists: the smaller set's shingles are probed by binary
   search in the larger one's sorted array, which holds the lists that its document is on (shingles of
   a single document can't be common).
6. Components over all links; a document's component_id is the smallest id in its component.

Equal sets are one node throughout (a fingerprint of the set). Nothing of the size of the
documents reaches the driver or is broadcast; intermediate tables lie in the shared folder.

Defined results: null, empty and wordless texts have an empty set and link with nothing; with
fewer words than the width the whole sequence is the one shingle; repeated rows share a
component; null ids take part but are never a component's smallest id unless all are null; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revspark.llm.common import (
    BYTE_VALUES,
    LOWER,
    SPACES,
    U64,
    give_back,
    id_and_text,
    lookup,
    mix,
    shingle_hashes,
    shuffle_partitions,
    slices,
    span_hashes,
    utf8,
    word_spans,
    written,
)
from revspark.llm.components import components
from revspark.llm.packed import pack, unpack

WIDTH = 5
SIMILARITY = 75  # percent
KEY_BITS = 52
RUN_SHINGLES = 1_000_000  # shingles a map task sorts at once: some 100 MB of a worker
ROW_BITS = 24  # of a node's number, for its place in the run
STAR_KEYS = 3
LIST_ROWS = 20_000  # documents of a list that one task merges
PROBED = 500_000  # shingles of the pairs that are probed at once
NOT_SPACE = lookup(SPACES)


def shingle_sets(data: np.ndarray, offs: np.ndarray, width: int = WIDTH
                 ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, shingle) of every row's distinct shingles, sorted, and each row's set size. At most
    4096 rows."""
    n = len(offs) - 1
    starts, ends, before = word_spans(data, offs, NOT_SPACE)
    words = span_hashes(BYTE_VALUES[LOWER[data]], starts, ends)
    counts = np.diff(before)
    rows = np.repeat(np.arange(n, dtype=np.int64), counts)
    keys = []
    if len(words) >= width:
        whole = rows[width - 1:] == rows[: len(rows) - width + 1]
        keys.append(_keyed(rows[: len(whole)][whole], shingle_hashes(words, width)[whole]))
    for r in np.flatnonzero((counts > 0) & (counts < width)):
        own = words[before[r]:before[r + 1]]
        keys.append(_keyed(np.array([r]), shingle_hashes(own, width)))
    if not keys:
        return rows[:0], np.zeros(0, np.uint64), np.zeros(n, np.int64)
    keys = np.unique(np.concatenate(keys))
    rows = (keys >> U64(KEY_BITS)).astype(np.int64)
    return rows, keys & U64((1 << KEY_BITS) - 1), np.bincount(rows, minlength=n)


def _keyed(rows: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    return rows.astype(np.uint64) << U64(KEY_BITS) | hashes >> U64(64 - KEY_BITS)


def fingerprints(rows: np.ndarray, shingles: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """64-bit fingerprint of each row's set."""
    with np.errstate(over="ignore"):
        sums = np.concatenate([[U64(0)], np.cumsum(mix(shingles + U64(1)), dtype=np.uint64)])
        stops = np.cumsum(sizes)
        return mix(sums[stops] - sums[stops - sizes] + mix(sizes.astype(np.uint64)))


def needed(n: np.ndarray, similarity: int = SIMILARITY) -> np.ndarray:
    """The least intersection with any partner of a set of size n."""
    return -(-similarity * n // 100)


def few_rows(batches: Iterator[pa.RecordBatch], most: int = 4096) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, most):
            yield batch.slice(start, most)


def posting_runs(docs: DataFrame, ranges: int, run_shingles: int, width: int = WIDTH
                 ) -> DataFrame:
    """range, run, blob: a run's shingles by hash range (shingle, place); and, as a range of its
    own below 0, what is known of the run's documents."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        held: list[tuple] = []
        bounds = np.array([(i << KEY_BITS) // ranges for i in range(ranges + 1)], np.uint64)

        def flush() -> pa.RecordBatch:
            nonlocal number, held
            run = task << 20 | number
            ids, nulls, keys, sizes, prints = (
                np.concatenate([h[k] for h in held]) for k in range(5))
            shingles = np.concatenate([h[6] for h in held])
            first = np.cumsum([0, *(len(h[0]) for h in held)])
            places = np.concatenate([h[5] + f for h, f in zip(held, first)]).astype(np.uint32)
            _, where, back = np.unique(prints, return_index=True, return_inverse=True)
            same = where[back].astype(np.uint32)  # the first document with an equal set
            own = same[places] == places
            shingles, places = shingles[own], places[own]
            order = np.argsort(shingles)
            shingles, places = shingles[order], places[order]
            cuts = np.searchsorted(shingles, bounds)
            cuts[-1] = len(shingles)
            rows = [(-1 - run, pack(ids, nulls, keys, sizes, prints, same))]
            rows += [(i, pack(shingles[a:b], places[a:b], ascending=1))
                     for i, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]
            number, held = number + 1, []
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()),
                 pa.array([run] * len(rows), pa.int64()),
                 pa.array([r[1] for r in rows], pa.binary())], names=["range", "run", "blob"])

        count = 0
        for batch in few_rows(slices(batches, "text")):
            rows, shingles, sizes = shingle_sets(*utf8(batch.column(1)), width)
            ids = batch.column(0)
            held.append((ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(False),
                         batch.column(2).to_numpy(), sizes,
                         fingerprints(rows, shingles, sizes), rows, shingles))
            count += len(shingles) + len(sizes)
            if count >= run_shingles:
                yield flush()
                count = 0
        if held:
            yield flush()

    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    return keyed.mapInArrow(work, "range long, run long, blob binary")


def count_lists(runs: DataFrame) -> DataFrame:
    """run, meta, blob: for each run its shared shingles (place, shingle, list length)."""

    def work(table: pa.Table) -> pa.Table:
        names, kinds = ["run", "meta", "blob"], [pa.int64(), pa.bool_(), pa.binary()]
        if table.column("range")[0].as_py() < 0:
            out = [table.column("run").to_pylist(), [True] * len(table),
                   table.column("blob").to_pylist()]
            return pa.table({n: pa.array(v, k) for n, v, k in zip(names, out, kinds)})
        numbers = table.column("run").to_numpy()
        parts = [unpack(b.as_buffer()) for b in table.column("blob")]
        shingles = np.concatenate([p[0] for p in parts])
        at = np.sort(shingles)
        new = np.ones(len(at), bool)
        new[1:] = at[1:] != at[:-1]
        first = np.flatnonzero(new)
        lengths = np.diff(np.append(first, len(at)))
        shared = at[first][lengths > 1]
        lengths = lengths[lengths > 1]
        runs, blobs = [], []
        for run, (own, places) in zip(numbers.tolist(), parts):
            if not len(shared):
                break
            where = np.searchsorted(shared, own)
            where[where == len(shared)] = 0
            hit = shared[where] == own
            if hit.any():
                runs.append(run)
                blobs.append(pack(own[hit], places[hit], lengths[where[hit]].astype(np.uint32),
                                  ascending=1))
        out = [runs, [False] * len(runs), blobs]
        del parts, shingles, at, first, lengths, shared
        give_back()
        return pa.table({n: pa.array(v, k) for n, v, k in zip(names, out, kinds)})

    return runs.groupBy("range").applyInArrow(work, "run long, meta boolean, blob binary")


SETS = ("doc_id long, text_key long, n_shingles long, print long, node long, shared binary, prefix array<long>, "
        "offset int, centre double, keys array<long>")


def prefixes(lists: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """One row per document; what follows n_shingles, print and node only for those that may have
    partners: shared (packed, sorted shingles of two or more documents), prefix (of them, in
    order), offset (unshared shingles, which come first), centre, keys."""

    def work(table: pa.Table) -> pa.Table:
        run, meta, parts = table.column("run")[0].as_py(), None, []
        for is_meta, blob in zip(table.column("meta").to_pylist(), table.column("blob")):
            if is_meta:
                meta = unpack(blob.as_buffer())
            else:
                parts.append(unpack(blob.as_buffer()))
        ids, nulls, text_keys, sizes, prints, _ = meta
        n = len(ids)
        columns = {k: [None] * n for k in ("shared", "prefix", "offset", "centre", "keys")}
        if parts:
            shingles, places, lengths = (np.concatenate([p[k] for p in parts]) for k in range(3))
            order = np.lexsort((shingles, lengths, places))
            shingles, places, lengths = shingles[order], places[order], lengths[order]
            counts = np.bincount(places, minlength=n)
            stops = np.cumsum(counts)
            short = sizes - needed(sizes, similarity) + 1 - (sizes - counts)
            salts = mix(np.arange(1, STAR_KEYS + 1, dtype=np.uint64))
            for i in np.flatnonzero((short > 0) & (counts > 0)):
                own = shingles[stops[i] - counts[i]:stops[i]]
                columns["shared"][i] = pack(np.sort(own), ascending=1)
                columns["prefix"][i] = own[:short[i]].astype(np.int64)
                columns["offset"][i] = int(sizes[i] - counts[i])
                weights = np.log(lengths[stops[i] - counts[i]:stops[i]])
                columns["centre"][i] = float(weights.sum() / sizes[i])
                columns["keys"][i] = [int(mix(own ^ s).min() >> U64(1)) for s in salts]
        kinds = {"shared": pa.binary(), "prefix": pa.list_(pa.int64()), "offset": pa.int32(),
                 "centre": pa.float64(), "keys": pa.list_(pa.int64())}
        return pa.table({
            "doc_id": pa.array(ids, mask=nulls), "text_key": pa.array(text_keys), "n_shingles": pa.array(sizes),
            "print": pa.array(prints.view(np.int64)),
            "node": pa.array((run << ROW_BITS) + np.arange(n)),
            **{k: pa.array(columns[k], kinds[k]) for k in kinds}})

    return lists.groupBy("run").applyInArrow(work, SETS)


def in_common(smaller: list[np.ndarray], larger: list[np.ndarray]) -> np.ndarray:
    """How many of each smaller set's shingles are in the larger one: all are probed by one binary
    search, each among its own partner's (sorted arrays, at most 4096 pairs)."""
    tag = lambda sets: np.concatenate(
        [s | U64(i << KEY_BITS) for i, s in enumerate(sets)] or [np.zeros(0, U64)])
    lists, probes = tag(larger), tag(smaller)
    owner = (probes >> U64(KEY_BITS)).astype(np.int64)
    if not len(lists):
        return np.zeros(len(smaller), np.int64)
    at = np.minimum(np.searchsorted(lists, probes), len(lists) - 1)
    return np.bincount(owner[lists[at] == probes], minlength=len(smaller))


def linked(pairs: DataFrame, sets: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """Of distinct candidate pairs (a, b: prints; node_a, node_b), those that link."""

    def decided(batch: pa.RecordBatch) -> Iterator[tuple[int, int]]:
        """(row, common shingles) of a batch's pairs, some thousands of shingles at a time."""
        known: dict[int, np.ndarray] = {}

        def unpacked(row: int, side: str) -> np.ndarray:
            node = batch.column(f"node_{side}")[row].as_py()
            if node not in known:
                known[node] = unpack(batch.column(f"set_{side}")[row].as_buffer())[0]
            return known[node]

        held: list[tuple[np.ndarray, np.ndarray]] = []
        size, first = 0, 0
        for row in range(batch.num_rows):
            a, b = unpacked(row, "a"), unpacked(row, "b")
            held.append((a, b) if len(a) <= len(b) else (b, a))
            size += len(a) + len(b)
            if size >= PROBED or len(held) == 4096 or row == batch.num_rows - 1:
                common = in_common(*(list(x) for x in zip(*held)))
                yield from zip(range(first, row + 1), common.tolist())
                held, size, first = [], 0, row + 1
                known.clear()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            common = np.array([c for _, c in decided(batch)], np.int64)
            sizes = sum(batch.column(c).to_numpy() for c in ("size_a", "size_b"))
            keep = pa.array(100 * common >= similarity * (sizes - common))
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).filter(keep) for c in ("a", "b")], names=["a", "b"])

    side = lambda s: sets.select(F.col("node").alias(f"node_{s}"),
                                 F.col("n_shingles").alias(f"size_{s}"),
                                 F.col("shared").alias(f"set_{s}"))
    both = pairs.join(side("a"), "node_a").join(side("b"), "node_b")
    return both.select("a", "b", "node_a", "node_b", "size_a", "size_b", "set_a", "set_b").mapInArrow(
        work, "a long, b long")


def _alike(a, b, similarity: int):
    return F.least(a, b) * 100 >= F.greatest(a, b) * similarity


def star_links(nodes: DataFrame, sets: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """Links of documents with the most central one of those that share a smallest hash. A
    document linked to a centre isn't compared with the same centre again."""
    links = None
    for k in range(STAR_KEYS):
        keyed = nodes.select("print", "node", "n_shingles", "centre", F.col("keys")[k].alias("key"))
        best = keyed.groupBy("key").agg(
            F.max(F.struct("centre", F.col("print").alias("b"), F.col("node").alias("node_b"),
                           F.col("n_shingles").alias("n_b"))).alias("m"))
        # Written, so that the join deals both sides anew and Spark can split a key of many documents.
        best = written(best.select("key", "m.b", "m.node_b", "m.n_b"), "star-centres")
        pairs = keyed.join(best, "key").where(
            (F.col("print") != F.col("b")) & _alike(F.col("n_shingles"), F.col("n_b"), similarity)
        ).select(F.col("print").alias("a"), "b", F.col("node").alias("node_a"), "node_b").distinct()
        if links is not None:
            # Copies that already hang on one centre need no second one.
            centres = links.groupBy("a").agg(F.min("b").alias("c"))
            pairs = (
                pairs.join(centres, "a", "left")
                .join(centres.select(F.col("a").alias("b"), F.col("c").alias("c_b")), "b", "left")
                .where(F.coalesce("c", "a") != F.coalesce("c_b", "b")).drop("c", "c_b"))
        found = written(linked(pairs, sets, similarity), "star-links")
        links = found if links is None else links.unionByName(found)
    return links


def merged_lists(nodes: DataFrame, labels: DataFrame, similarity: int = SIMILARITY,
                 list_rows: int | None = None) -> DataFrame:
    """Documents of different components that the merged short lists leave as partners: a, b (prints),
    node_a, node_b and how many shingles they have ``merged`` in common; ``enough``: that is the
    required overlap already.

    A list is dealt by shingle and length band (partners are in the same or a neighbouring band), and a
    long one in parts of ``list_rows`` documents. Lists are ordered alike for all documents, so what two
    of them have in common up to the last shared short list is counted in full, and behind it there are
    no more than the shorter rest of either.
    """
    named = nodes.join(labels.select(F.col("node").alias("print"), "component"), "print", "left")
    # A little more than the largest ratio of partners' sizes, so rounding can't part them by two bands.
    band = F.floor(F.log(F.col("n_shingles").cast("double")) / F.lit(
        float(np.log(100 / similarity * 1.01)))).cast("int")
    posted = named.select(
        "print", "node", "n_shingles", F.coalesce("component", "print").alias("component"),
        band.alias("band"), "offset", F.posexplode("prefix").alias("place", "shingle"))
    posted = posted.withColumn("behind", F.col("n_shingles") - F.col("offset") - F.col("place") - 1)
    posted = written(posted.drop("offset", "place"), "prefix-lists")
    sizes = posted.groupBy("shingle", "component").agg(F.count(F.lit(1)).alias("n"))
    # Lists with documents of one component only have nothing to add.
    mixed = sizes.groupBy("shingle").agg(
        F.max(F.struct("n", "component")).alias("largest"), F.count(F.lit(1)).alias("parts"),
        F.ceil(F.sum("n") / F.lit(list_rows or LIST_ROWS)).cast("int").alias("salts")
    ).where("parts > 1").select("shingle", F.col("largest.component").alias("largest"), "salts")
    within = posted.join(mixed, "shingle")
    names = ("print", "node", "n_shingles", "component", "behind")
    side = lambda s: [F.col(c).alias(f"{c}_{s}") for c in names]
    salt = F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt")
    near = F.explode(F.array(*[F.col("band") + d for d in (-1, 0, 1)])).alias("band")
    few = within.where(F.col("component") != F.col("largest")).select(
        "shingle", "largest", near, *side("a"), "salts").select("*", salt).drop("salts")
    every = within.select(
        "shingle", "band", F.pmod(F.xxhash64("print"), F.col("salts")).cast("int").alias("salt"),
        *side("b"))
    once = (F.col("component_b") == F.col("largest")) | (F.col("print_a") < F.col("print_b"))
    need = F.ceil(F.lit(similarity) * (F.col("n_shingles_a") + F.col("n_shingles_b"))
                  / F.lit(100 + similarity))
    # The first list that partners share leaves them enough behind it, so a pair that has no such list
    # is never enumerated.
    reach = 1 + F.least("behind_a", "behind_b") >= need
    common = few.join(every, ["shingle", "band", "salt"]).where(
        (F.col("component_a") != F.col("component_b")) & once & reach
        & _alike(F.col("n_shingles_a"), F.col("n_shingles_b"), similarity))
    # The largest component differs from list to list, so a pair may come from either side.
    a_first = F.col("print_a") < F.col("print_b")
    pick = lambda c, x, y: F.when(a_first, F.col(f"{c}_{x}")).otherwise(F.col(f"{c}_{y}"))
    counted = common.select(
        pick("print", "a", "b").alias("a"), pick("print", "b", "a").alias("b"),
        pick("node", "a", "b").alias("node_a"), pick("node", "b", "a").alias("node_b"),
        need.alias("need"), F.least("behind_a", "behind_b").alias("rest"),
    ).groupBy("a", "b", "node_a", "node_b", "need").agg(
        F.count(F.lit(1)).alias("merged"), F.min("rest").alias("rest"))
    return counted.where(F.col("merged") + F.col("rest") >= F.col("need")).select(
        "a", "b", "node_a", "node_b", "merged", (F.col("merged") >= F.col("need")).alias("enough"))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    width: int = WIDTH, similarity: int = SIMILARITY,
                    run_shingles: int = RUN_SHINGLES, with_key: bool = False) -> DataFrame:
    """doc_id, n_shingles, component_id of every row; with ``with_key`` instead of the last text_key
    (xxhash64 of the text) and component (the component's number, null for empty sets)."""
    docs = id_and_text(df, id_col, text_col)
    runs = posting_runs(docs, shuffle_partitions(df.sparkSession), run_shingles, width)
    sets = written(prefixes(count_lists(runs), similarity), "shingle-sets")
    candidates = sets.where("shared IS NOT NULL")
    nodes = candidates.drop("doc_id", "text_key", "shared").dropDuplicates(["print"])
    nodes = written(nodes, "shingle-nodes")
    stars = star_links(nodes, candidates, similarity)
    merged = written(merged_lists(nodes, components(stars), similarity), "merged-lists")
    reached = merged.where("enough").select("a", "b")
    probed = linked(merged.where("NOT enough"), candidates, similarity)
    links = stars.unionByName(reached).unionByName(written(probed, "rest-links"))
    labels = components(links).select(F.col("node").alias("print"), "component")
    documents = sets.select("doc_id", "text_key", "n_shingles", "print")
    full = documents.where("n_shingles > 0").join(labels, "print", "left").withColumn(
        "component", F.coalesce("component", "print"))
    empty = documents.where("n_shingles = 0").withColumn("component", F.lit(None).cast("long"))
    if with_key:
        columns = ["doc_id", "text_key", "n_shingles", "component"]
        return full.select(*columns).unionByName(empty.select(*columns))
    full = written(full, "document-components")
    least = written(full.groupBy("component").agg(F.min("doc_id").alias("component_id")),
                    "component-ids")
    columns = ["doc_id", "n_shingles", "component_id"]
    return full.join(least, "component").select(*columns).unionByName(
        empty.withColumn("component_id", F.col("doc_id")).select(*columns))
