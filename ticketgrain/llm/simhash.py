"""SimHash near-duplicates by multi-index hashing.

A fingerprint is cut into segments, each with a table of its own: (segment, value) -> fingerprints.
Of two fingerprints within ``bits`` bits some segment differs in at most ``bits // segments``, so
every fingerprint looks up the Hamming ball of that radius around each of its segments, and the
complete distances to what it finds are verified.

A table entry of more than ``ENTRY`` fingerprints is not paired.  Fingerprints that look one up
meet at whole keys instead: all fingerprints within half of the bits.  Whatever lies on a key's far
side links to the smallest on its near side, which needs one row for each fingerprint and key, no
pairs, and connects the same components.

Copies share a fingerprint and are one node of the graph.

Joins are merged by hint: the planner sizes a staged table by its compressed file and a ball like the
one row it is made from, so it would broadcast tables that the driver cannot hold.  What is broadcast
by hand is bounded by ``FEW_EDGES``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticketgrain.llm.common import NULL_ID, id_and_text, map_texts, order_id, quoted, staged

SHINGLE_WORDS = 3
MAX_BITS = 2
SEGMENTS = 2
BITS = 64
SEED = 42
# Table entries of more fingerprints are met by whole keys.
ENTRY = 8
# So many edges, or pointers of their nodes, are looked up in a broadcast table (some MB).
FEW_EDGES = 100_000
# Pointers followed in one contraction.
HOPS = 2


def shingle_hashes(text: bytes, width: int = SHINGLE_WORDS) -> list[int]:
    """XXH64 of every run of ``width`` words, or of all words if they are fewer; none without words."""
    words = text.lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return []
    joined = b" ".join(words)
    if len(words) <= width:
        return [xxhash.xxh64_intdigest(joined, SEED)]
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[:-width]])
    stops = ends[width - 1 :] - 1
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), stops.tolist(), strict=True)]


def simhash(text: bytes, width: int = SHINGLE_WORDS) -> int:
    """Majority bits of the shingles' XXH64, as a signed long; 0 without words."""
    hashes = shingle_hashes(text, width)
    if not hashes:
        return 0
    bits = np.unpackbits(np.array(hashes, dtype=">u8").view(np.uint8).reshape(-1, 8), axis=1)
    majority = 2 * bits.sum(axis=0, dtype=np.int64) > len(hashes)
    return int(np.packbits(majority).view(">i8")[0])


def fingerprints(docs: DataFrame, width: int = SHINGLE_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, tie (hash of the text), fp: one row for each row of ``docs``; null texts have no words."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        fps = pa.array([simhash(t, width) for t in texts], pa.int64())
        return pa.record_batch([batch.column("doc_id"), batch.column("tie"), fps], ["doc_id", "tie", "fp"])

    rows = id_and_text(docs, id_col, text_col).select("doc_id", F.xxhash64("text").alias("tie"), "text")
    return map_texts(rows, run, "doc_id long, tie long, fp long")


def ball(value, width: int, radius: int):
    """All values that differ from ``value`` in at most ``radius`` of the lowest ``width`` bits."""
    flips = F.array(*[F.lit(1 << b if b < 63 else -(2**63)) for b in range(width)])
    found = F.array(value)
    for _ in range(radius):
        further = F.transform(found, lambda near: F.transform(flips, lambda flip: near.bitwiseXOR(flip)))
        found = F.array_distinct(F.concat(found, F.flatten(further)))
    return found


def segment_values(segments: int, radius: int):
    """Structs (segment, value): the ball around each segment of the column fp."""
    width = BITS // segments
    mask = F.lit((1 << width) - 1 if width < BITS else -1)

    def values(number: int):
        own = F.shiftrightunsigned("fp", number * width).bitwiseAND(mask)
        return F.transform(ball(own, width, radius), lambda v: F.struct(F.lit(number).alias("segment"), v.alias("value")))

    return F.concat(*map(values, range(segments)))


def met_links(found: DataFrame, bits: int) -> DataFrame:
    """a, b: links from rows (fp, alike, hot); what they connect is exact.

    Fingerprints with links of their own meet at themselves, with those in ``alike``.  The hot ones
    meet at whole keys, which lie within ``bits // 2`` of the one side of a pair and within the rest
    of the other, so at most as many meet as there are values within the rest: 65 at two bits.
    """
    near, far = bits // 2, bits - bits // 2
    place = lambda own, key, fp: F.struct(F.lit(own).alias("own"), key.alias("met"), fp.alias("fp"))
    own = F.transform(F.array_append("alike", F.col("fp")), lambda o: place(True, F.col("fp"), o))
    keys = F.transform(ball(F.col("fp"), BITS, far), lambda key: place(False, key, F.col("fp")))
    places = F.concat(F.when(F.size("alike") > 0, own).otherwise(F.slice(own, 1, 0)), F.when(F.col("hot"), keys).otherwise(F.slice(own, 1, 0)))
    met = found.select(F.inline(places))
    near_side = F.col("own") | (F.bit_count(F.col("fp").bitwiseXOR(F.col("met"))) <= near)
    least = F.min(F.when(near_side, F.col("fp"))).alias("b")
    groups = met.groupBy("own", "met").agg(least, F.collect_list("fp").alias("fps")).filter("size(fps) > 1")
    return groups.select(F.explode("fps").alias("a"), "b").filter("a != b")


def links(nodes: DataFrame, bits: int = MAX_BITS, segments: int = SEGMENTS, entry: int = ENTRY) -> DataFrame:
    """a, b: fingerprints (column fp, distinct) linked to others, pairs may repeat; what they connect is exact.

    ``segments`` divides 64.  Probes grow with the ball around a segment, whole keys of crowded
    entries with that around a fingerprint: 64 choose half of the bits.
    """
    if BITS % segments:
        raise ValueError("segments of unequal length")
    key = ["segment", "value"]
    entries = nodes.select("fp", F.inline(segment_values(segments, 0)))
    # one more than fit tells that an entry is crowded; the limit holds before the shuffle, too
    place = F.row_number().over(Window.partitionBy(*key).orderBy("fp"))
    table = entries.withColumn("place", place).filter(F.col("place") <= entry + 1).groupBy(key).agg(F.collect_list("fp").alias("others"))
    probes = nodes.select("fp", F.inline(segment_values(segments, bits // segments)))
    near = F.filter("others", lambda o: (o < F.col("fp")) & (F.bit_count(o.bitwiseXOR(F.col("fp"))) <= bits))
    found = probes.join(table.hint("merge"), key).select("fp", F.when(F.size("others") <= entry, near).alias("alike"))
    found = found.filter("alike IS NULL OR size(alike) > 0")
    hot = F.bool_or(F.col("alike").isNull()).alias("hot")
    return met_links(found.groupBy("fp").agg(hot, F.flatten(F.collect_list("alike")).alias("alike")), bits)


def contracted(edges: DataFrame, few: bool) -> DataFrame:
    """Edges (a, b), a > b, that connect the same nodes over shorter ways; stars on the least node stay as they are.

    A node points to its smallest neighbour, if that is smaller.  The smaller end of every edge
    goes ``HOPS`` pointers on, then a node's ends are linked to the smallest of them.  Minima are
    pre-aggregated; the joins back are lookups in a broadcast table if the edges are ``few``,
    else merges, where the edges of a hub can be split by the adaptive planner.
    """
    lookup = F.broadcast if few else (lambda table: table.hint("merge"))
    single = (lambda rows: rows) if few else DataFrame.distinct  # few repeated rows cost less than a shuffle
    pointers = lookup(edges.groupBy(F.col("a").alias("b")).agg(F.min("b").alias("low")))
    for _ in range(HOPS):
        edges = edges.join(pointers, "b", "left").select("a", F.coalesce("low", "b").alias("b"))
    edges = single(edges)
    ends = edges.join(lookup(edges.groupBy("a").agg(F.min("b").alias("low"))), "a")
    # each node has an edge to its least end, so every row gives one row
    return single(ends.select(F.when(F.col("b") == F.col("low"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("low").alias("b")))


def components(edges: DataFrame, few: int = FEW_EDGES) -> DataFrame:
    """node, root (the smallest reachable node) of every node of the edges (a, b), a != b.

    The edges are contracted until nothing changes.
    """
    edges = staged(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen, state = None, _state(edges)
    while state[0] and state != seen:  # if the same, every node hangs on its component's root
        edges = staged(contracted(edges, state[0] <= few), "edges")
        seen, state = state, _state(edges)
    own = F.struct(F.col("b").alias("node"), F.col("b").alias("root"))
    return edges.select(F.inline(F.array(F.struct(F.col("a").alias("node"), F.col("b").alias("root")), own))).distinct()


def _state(edges: DataFrame) -> tuple:
    """Number of edges and sum of their hashes."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _grouped(rows: DataFrame) -> DataFrame:
    """fp, component_id, first (order key and tie of the group's first row) of every fingerprint."""
    nodes = staged(
        rows.groupBy("fp").agg(F.min("doc_id").alias("low"), F.min(F.struct(order_id().alias("key"), "tie")).alias("first")),
        "fingerprint-nodes",
    )
    rooted = nodes.join(components(links(nodes)).withColumnRenamed("node", "fp").hint("merge"), "fp", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "fp"))
    groups = rooted.groupBy("root").agg(F.min("low").alias("component_id"), F.min("first").alias("first"))
    return rooted.select("fp", "root").join(groups.hint("merge"), "root").select("fp", "component_id", "first")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits), component_id: one row for each row of ``docs``.

    ``component_id`` is the smallest id reachable over fingerprints that differ in at most two
    bits, null ids left aside (null if there is no other).  Null, empty and blank texts have
    fingerprint zero and link like any other; repeated rows are in one component.
    """
    rows = staged(fingerprints(docs, id_col=id_col, text_col=text_col), "fingerprints")
    written = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return (
        rows.join(_grouped(rows).select("fp", "component_id").hint("merge"), "fp")
        .select("doc_id", written.alias("fingerprint"), "component_id")
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component: the first by (id, hash of the text), null ids first.

    Of rows equal in id and text any one stays.  Columns are as they were.
    """
    rows = staged(fingerprints(docs, id_col=id_col, text_col=text_col), "fingerprints")
    kept = _grouped(rows).select("first.key", "first.tie").distinct()
    text = F.coalesce(quoted(text_col).cast("string"), F.lit(""))
    whole = docs.select(
        order_id_of(id_col).alias("key"), F.xxhash64(text).alias("tie"), F.struct(*map(quoted, docs.columns)).alias("row")
    )
    return whole.join(kept, ["key", "tie"], "left_semi").dropDuplicates(["key", "tie"]).select("row.*")


def order_id_of(id_col: str):
    return F.coalesce(quoted(id_col).cast("long"), F.lit(NULL_ID))
