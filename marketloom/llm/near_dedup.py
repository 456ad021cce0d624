"""MinHash near-duplicates: bands give candidates, odd sketches and full sets confirm them.

A document's set is that of its distinct 5-word shingles, as 64-bit hashes; with
fewer words, the whole sequence is one. Documents are linked when the Jaccard
similarity of their sets is at least ``percent`` / 100.

How it works.

1. Signatures. Each text gives 192 MinHash samples, a key per band, an odd sketch (the
   samples folded into a bitmap of parities) and a digest of its set. Rows with equal
   sets form a class, and only the class, a node, goes on; copies are never expanded
   into pairs.
2. Hubs. In each band bucket every member is a candidate with the hub of its bucket
   only: the member that shares most buckets with others, as the middle of a group of
   near copies does. This is a join of the members with one row per bucket.
3. Confirming. The number of set bits in the XOR of two odd sketches estimates how many
   samples differ. Pairs beyond what the threshold can explain by six standard
   deviations are left out; the others are confirmed on their full sets.
4. Components by propagation of the smallest node with pointer jumping.
5. The rest. Buckets that still hold several components may hide links. A shingle found
   in one component alone cannot be shared with another, so with p of them in a set of
   n the similarity is at most (n - p) / n; members below the threshold leave.
   The others are compared by their differences d(A) = A xor H to the hub H of a
   bucket, as |A xor B| = |d(A)| + |d(B)| - 2 |d(A) and d(B)|. With
   g(A) = (100 + p) |d(A)| - (100 - p) |A|, A and B are linked exactly when
   2 (100 + p) |d(A) and d(B)| >= g(A) + g(B). Where g(A) + g(B) <= 0 both are linked
   with H. Else they share elements of their differences, at least
   (g(A) + g(B)) / (2 (100 + p)) of them, and so one among the rarest elements of each
   (prefix filter); members meet in keys of (hub, such an element). A member has one row
   for each of its rarest elements, as many as the least g of other members asks for, so
   rows are bounded by its differences, whatever the size of its group. Each row says how
   large the g of a partner may be that is met first there. What a group has in common is
   in no key, and differences that only one component has are in none either.
6. Keys are treated as buckets were: every member is tested with the hub of its key,
   components are joined, and where a key still holds several, the members outside its
   largest component are tested with those of other components. Members whose g is beyond
   each other's bound at a key are not tested there.

So each pair of a bucket is in one component, provably below the threshold, or tested,
and groups whose members are alike never emit their pairs. A pair at the threshold
shares no band with a probability under 1e-6: 2.6e-7 for 85 (32 bands of 6 samples),
2.8e-7 for 80 (38 bands of 5). Nothing that grows with the corpus is collected or
broadcast; intermediate tables are written to the shared folder.

Defined results: null text counts as empty; documents without words have an empty set,
are linked with nothing and stay; very long texts are read whole, in one array of
hashes; rows with equal ids are judged each by its own text, and rows that repeat id and
text share one decision; a row without an id takes the component of rows with its
shingles that have one, and else has none and stays; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketloom.llm import common

WORDS = 5
#: MinHash samples of a document.
SAMPLES = 192
#: 64-bit words of an odd sketch.
SKETCH = 8
_SEEDS = np.random.default_rng(20240229).integers(1, 1 << 32, (2, SAMPLES), dtype=np.uint64).astype(np.uint32)
_STEP, _SHIFT = _SEEDS[0] | np.uint32(1), _SEEDS[1]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def rows_per_band(percent: int) -> int:
    """The most samples a band may have, so that a pair at the threshold is missed with less than 1e-6."""
    fits = (r for r in range(16, 1, -1) if (1 - (percent / 100) ** r) ** (SAMPLES // r) < 1e-6)
    return next(fits, 1)


def shingles(text: str | None) -> np.ndarray:
    """The sorted set of a text's shingle hashes, as unsigned 64-bit integers."""
    # Bytes are split at the six ASCII blanks and lower-cased in A-Z only.
    words = text.encode("utf-8", "replace").lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    codes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = max(len(codes) - WORDS + 1, 1)
    h = np.full(n, min(len(codes), WORDS), np.uint64)
    for k in range(min(len(codes), WORDS)):
        h = _mix(h * np.uint64(0x9E3779B97F4A7C15) + codes[k : k + n])
    return np.unique(h)


def min_hashes(hashes: np.ndarray) -> np.ndarray:
    """The smallest value under each of the linear permutations of 32-bit hashes."""
    low = (hashes >> np.uint64(32)).astype(np.uint32)
    out = np.full(SAMPLES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(low), 1024):
        part = low[at : at + 1024]
        values = part[None, :] * _STEP[:, None]
        values += _SHIFT[:, None]
        values ^= values >> np.uint32(15)
        np.minimum(out, values.min(axis=1), out=out)
    return out


def odd_sketch(samples: np.ndarray) -> np.ndarray:
    """Parities of the cells into which the samples, told apart by their number, fall."""
    numbered = samples.astype(np.uint64) | (np.arange(len(samples), dtype=np.uint64) << np.uint64(32))
    cells = (_mix(numbered) % np.uint64(64 * SKETCH)).astype(np.int64)
    odd = (np.bincount(cells, minlength=64 * SKETCH) & 1).astype(np.uint8)
    return np.packbits(odd).view("<i8")


def most_odd(percent: int) -> int:
    """The most XOR bits that a pair at the threshold shows within six standard deviations."""
    n, cells = SAMPLES, 64 * SKETCH
    miss = 1 - percent / 100
    # Each differing sample throws two values into the cells.
    thrown = 2 * n * miss
    mean = cells / 2 * (1 - (1 - 2 / cells) ** thrown)
    spread = 4 * n * miss * (1 - miss) + thrown
    return int(np.ceil(mean + 6 * np.sqrt(spread)))


def signatures(docs: DataFrame, percent: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, row, n_shingles, set_digest (null for empty sets), sketch, bands; ``row`` tells texts of one id apart."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("row", pa.int64()), ("n_shingles", pa.int64()), ("set_digest", pa.binary())]
        + [("sketch", pa.list_(pa.int64())), ("bands", pa.list_(pa.int64()))]
    )
    n_rows = rows_per_band(percent)
    n_bands = SAMPLES // n_rows

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                rows = []
                for text in part.column("text").to_pylist():
                    hashes = shingles(text)
                    if not len(hashes):
                        rows.append((0, None, None, None))
                        continue
                    samples = min_hashes(hashes)
                    banded = samples[: n_bands * n_rows].reshape(n_bands, n_rows)
                    key = np.arange(n_bands, dtype=np.uint64)
                    for r in range(n_rows):
                        key = _mix(key * np.uint64(0x9E3779B97F4A7C15) + banded[:, r].astype(np.uint64))
                    digest = xxhash.xxh3_128_digest(hashes.tobytes())
                    rows.append((len(hashes), digest, odd_sketch(samples), key.view(np.int64)))
                new = [pa.array(c, schema.field(k + 2).type) for k, c in enumerate(zip(*rows))]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("row"), *new], schema=schema)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), common.text_key(text_col).alias("row"), F.col(text_col).alias("text"))
    return rows.mapInArrow(sign, "doc_id long, row long, n_shingles long, set_digest binary, sketch array<long>, bands array<long>")


def full_sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The shingle sets of the nodes in ``wanted`` (node, rep, set_digest): node, hashes."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("rep", pa.int64()), ("hashes", pa.list_(pa.int64())), ("set_digest", pa.binary())])
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                ids, texts = (c.to_pylist() for c in batch.slice(at, 1000).columns)
                sets = [shingles(t) for t in texts]
                digests = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())), pa.array(digests, pa.binary())], schema=schema)

    texts = docs.select(F.col(id_col).cast("long").alias("rep"), F.col(text_col).alias("text"))
    found = texts.join(wanted.select("rep").distinct(), "rep", "left_semi").mapInArrow(make, "rep long, hashes array<long>, set_digest binary")
    return found.join(wanted, ["rep", "set_digest"]).dropDuplicates(["node"]).select("node", "hashes")


def _enough(shared: Column, union: Column, percent: int) -> Column:
    return 100 * shared >= percent * union


def _near(a: str, b: str, percent: int) -> Column:
    """Whether two odd sketches allow the threshold."""
    odd = sum((F.bit_count(F.col(a)[k].bitwiseXOR(F.col(b)[k])) for k in range(SKETCH)), F.lit(0))
    return odd <= most_odd(percent)


def sketched(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that sizes and odd sketches allow."""
    side = lambda x: nodes.select(F.col("node").alias(x), F.col("n").alias(f"_n{x}"), F.col("sketch").alias(f"_s{x}"))
    fit = pairs.join(side("a"), "a").join(side("b"), "b")
    fit = fit.where(_enough(F.least("_na", "_nb"), F.greatest("_na", "_nb"), percent))
    return fit.where(_near("_sa", "_sb", percent)).select("a", "b")


def confirmed(fit: DataFrame, nodes: DataFrame, docs: DataFrame, percent: int, id_col: str, text_col: str) -> DataFrame:
    """The candidate pairs (a, b) that are links by their full sets, stored."""
    fit = common.materialise(fit, "near-pairs")
    some = fit.select(F.col("a").alias("node")).union(fit.select("b")).distinct()
    wanted = nodes.select("node", "rep", "set_digest").join(some, "node", "left_semi")
    sets = common.materialise(full_sets(docs, wanted, id_col, text_col), "near-sets")
    left, right = sets.withColumnsRenamed({"node": "a", "hashes": "_ha"}), sets.withColumnsRenamed({"node": "b", "hashes": "_hb"})
    both = fit.join(left, "a").join(right, "b")
    shared = F.size(F.array_intersect("_ha", "_hb"))
    near = both.where(_enough(shared, F.size("_ha") + F.size("_hb") - shared, percent)).select("a", "b")
    links = common.materialise(near, "near-confirmed")
    common.discard(fit, sets)
    return links


def components(links: DataFrame, label: str = "near-labels") -> DataFrame:
    """The smallest node reachable from each node of the links (a, b): node, component.

    Each round takes the smallest label among the neighbours and the label of the
    own label, so paths shorten by half; rounds end when no label changes.
    """
    both = links.select("a", "b").union(links.select("b", "a")).distinct()
    both = common.materialise(both, "near-links")
    now = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("component")).withColumnRenamed("a", "node")
    now = common.materialise(now, label)
    while True:
        seen = both.join(now.withColumnRenamed("node", "b"), "b").select(F.col("a").alias("node"), "component")
        least = now.union(seen).groupBy("node").agg(F.min("component").alias("component"))
        up = now.select(F.col("node").alias("component"), F.col("component").alias("_up"))
        jumped = least.join(up, "component", "left").select("node", F.coalesce("_up", "component").alias("component"))
        new = common.materialise(jumped, label)
        old = now.select("node", F.col("component").alias("_old"))
        same = new.join(old, "node").where(F.col("component") != F.col("_old")).isEmpty()
        common.discard(now)
        if same:
            common.discard(both)
            return new
        now = new


def joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The labels after further links (a, b), found on the graph of the components; the old labels are discarded."""
    ends = links
    for x in "ab":
        known = labels.select(F.col("node").alias(x), F.col("component").alias(f"_{x}"))
        ends = ends.join(known, x, "left").withColumn(x, F.coalesce(f"_{x}", x)).drop(f"_{x}")
    ends = common.materialise(ends.where("a <> b").distinct(), "near-links")
    if ends.isEmpty():
        return labels
    small = components(ends)
    up = small.select(F.col("node").alias("component"), F.col("component").alias("_up"))
    old = labels.join(up, "component", "left").select("node", F.coalesce("_up", "component").alias("component"))
    both = common.materialise(old.union(small.join(labels, "node", "left_anti")), "near-labels")
    common.discard(ends, small, labels)
    return both


def _with_component(frame: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows with column ``node`` and the component of it, itself where it has no link."""
    known = labels.select("node", F.col("component").alias("_c"))
    return frame.join(known, "node", "left").withColumn("component", F.coalesce("_c", "node")).drop("_c")


def _mixed(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows with column ``component`` whose keys hold several components."""
    several = rows.groupBy(*keys).agg(F.min("component").alias("_a"), F.max("component").alias("_b")).where("_a <> _b")
    return rows.join(several.select(*keys), list(keys), "left_semi")


def hub_pairs(buckets: DataFrame) -> DataFrame:
    """Each member of a bucket (node, band, central) with its hub: hub, node.

    A node has at most one hub per band, whatever the buckets' sizes, and is its own hub where it is one.
    """
    hubs = buckets.groupBy("band").agg(F.max(F.struct("central", "node")).alias("_h")).select("band", F.col("_h.node").alias("hub"))
    return buckets.join(hubs, "band").select("hub", "node").distinct()


def band_buckets(nodes: DataFrame) -> DataFrame:
    """Members of buckets of two and more: node, band, central (how often a node meets others)."""
    every = nodes.select("node", F.explode("bands").alias("band"))
    sizes = every.groupBy("band").agg(F.count(F.lit(1)).alias("_size")).where("_size > 1")
    members = common.materialise(every.join(sizes, "band"), "near-buckets")
    return members.join(members.groupBy("node").agg(F.sum("_size").alias("central")), "node").drop("_size")


def near_groups(docs: DataFrame, percent: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, row (see ``common.text_key``), n_shingles, component_id, kept."""
    signed = common.materialise(signatures(docs, percent, id_col, text_col), "near-signatures")
    classes = (
        signed.where(F.col("set_digest").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("set_digest")
        .agg(F.min("doc_id").alias("rep"), F.min("n_shingles").alias("n"), F.first("sketch").alias("sketch"), F.first("bands").alias("bands"))
    )
    # Stored at once, so the numbers of the nodes stay as they are.
    nodes = common.materialise(classes.withColumn("node", F.monotonically_increasing_id()), "near-nodes")
    buckets = common.materialise(band_buckets(nodes), "near-buckets")
    pairs = hub_pairs(buckets).where("hub <> node").select(F.col("hub").alias("a"), F.col("node").alias("b"))
    links = confirmed(sketched(pairs, nodes, percent), nodes, docs, percent, id_col, text_col)
    labels = components(links)
    common.discard(links)
    labels = leftover_components(buckets, labels, nodes, docs, percent, id_col, text_col)
    common.discard(buckets)
    # The smallest id of each component.
    linked = labels.join(nodes.select("node", "rep"), "node")
    least = linked.groupBy("component").agg(F.min("rep").alias("first"))
    own = nodes.select("node", "set_digest", "rep").join(linked.join(least, "component").select("node", "first"), "node", "left")
    own = own.select("set_digest", F.coalesce("first", "rep").alias("_c"))
    component = F.coalesce("_c", "doc_id")
    return signed.select("doc_id", "row", "n_shingles", "set_digest").join(own, "set_digest", "left").select(
        "doc_id", "row", "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept")
    )


def differences(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Per hub and member, what tells the member from the hub: hub, node, component, g, base (g of the hub), d."""
    hubs = sets.select(F.col("node").alias("hub"), F.col("hashes").alias("_hub"))
    both = members.join(sets, "node").join(hubs, "hub")
    d = F.concat(F.array_except("hashes", "_hub"), F.array_except("_hub", "hashes"))
    g = ((100 + percent) * F.size(d) - (100 - percent) * F.size("hashes")).cast("long")
    return both.select("hub", "node", "component", g.alias("g"), ((percent - 100) * F.size("_hub")).cast("long").alias("base"), d.alias("d"))


def shared_differences(found: DataFrame) -> DataFrame:
    """Differences that members of several components of a family have, the rarest first: hub, node, component, g, d."""
    each = found.select("hub", "node", "component", F.explode("d").alias("e"))
    counts = each.groupBy("hub", "e").agg(F.count(F.lit(1)).alias("c"), F.min("component").alias("_a"), F.max("component").alias("_b"))
    counts = counts.where("_a <> _b").select("hub", "e", "c")
    kept = each.join(counts, ["hub", "e"]).groupBy("hub", "node").agg(F.sort_array(F.collect_list(F.struct("c", "e"))).alias("_d"))
    return found.drop("d", "base").join(kept, ["hub", "node"]).withColumn("d", F.col("_d.e")).drop("_d")


def difference_keys(shared: DataFrame, percent: int) -> DataFrame:
    """Keys in which members meet that can be linked: hub, key, node, component, g, reach.

    A key is a difference; where two members first meet, the g of each is at most the ``reach`` of the other. Members of
    the hub's component (``_home``) look for members of others only.
    """
    least = shared.groupBy("hub").agg(F.min("g").alias("_all"), F.min(F.when(~F.col("_home"), F.col("g"))).alias("_far")).where("_far IS NOT NULL")
    lowest = F.when(F.col("_home"), F.col("_far")).otherwise(F.col("_all"))
    need = F.greatest(F.ceil((F.col("g") + lowest) / (2.0 * (100 + percent))), F.lit(1)).cast("int")
    rows = shared.join(least, "hub").withColumn("_n", F.size("d")).withColumn("_most", F.col("_n") - need + 1).where("_most > 0")
    rows = rows.select("hub", "node", "component", "g", "_n", F.posexplode(F.slice("d", F.lit(1), F.col("_most"))).alias("_at", "key"))
    reach = 2 * (100 + percent) * (F.col("_n") - F.col("_at")).cast("long") - F.col("g")
    return rows.select("hub", "key", "node", "component", "g", reach.alias("reach"))


def within_reach(keys: DataFrame) -> DataFrame:
    """Rows of keys that hold several components, without those that reach no member of their key."""
    least = keys.groupBy("hub", "key").agg(F.min("component").alias("_a"), F.max("component").alias("_b"), F.min("g").alias("_least")).where("_a <> _b")
    return keys.join(least.select("hub", "key", "_least"), ["hub", "key"]).where("reach >= _least").drop("_least")


def overlapping(pairs: DataFrame, shared: DataFrame, percent: int) -> DataFrame:
    """The pairs (hub, a, b) whose shared differences make them links: a, b."""
    side = lambda x: shared.select("hub", F.col("node").alias(x), F.col("g").alias(f"_g{x}"), F.col("d").alias(f"_d{x}"))
    both = pairs.join(side("a"), ["hub", "a"]).join(side("b"), ["hub", "b"])
    enough = 2 * (100 + percent) * F.size(F.array_intersect("_da", "_db")) >= F.col("_ga") + F.col("_gb")
    return both.where(enough).select("a", "b").distinct()


def key_stars(keys: DataFrame) -> DataFrame:
    """Each member of a key with the member that is nearest to the hub of the family: hub, a, b."""
    middle = keys.groupBy("hub", "key").agg(F.min(F.struct("g", "node", "component", "reach")).alias("_m"))
    pairs = keys.join(middle, ["hub", "key"]).where("component <> _m.component AND g <= _m.reach AND _m.g <= reach")
    pairs = pairs.select("hub", F.col("_m.node").alias("a"), F.col("node").alias("b"))
    return pairs.select("hub", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def key_pairs(keys: DataFrame) -> DataFrame:
    """Members outside the largest component of their key with those of other components: hub, a, b."""
    sizes = keys.groupBy("hub", "key", "component").agg(F.count(F.lit(1)).alias("_n"))
    largest = sizes.groupBy("hub", "key").agg(F.max(F.struct("_n", "component")).alias("_l")).select("hub", "key", F.col("_l.component").alias("_largest"))
    few = keys.join(largest, ["hub", "key"]).where(F.col("component") != F.col("_largest"))
    few = few.select("hub", "key", "_largest", F.col("node").alias("a"), F.col("component").alias("_own"), F.col("g").alias("_g"), F.col("reach").alias("_reach"))
    pairs = few.join(keys, ["hub", "key"]).where((F.col("component") != F.col("_own")) & ((F.col("component") == F.col("_largest")) | (F.col("a") < F.col("node"))))
    pairs = pairs.where("g <= _reach AND _g <= reach")
    return pairs.select("hub", F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b")).distinct()


def leftover_components(buckets: DataFrame, labels: DataFrame, nodes: DataFrame, docs: DataFrame, percent: int, id_col: str, text_col: str) -> DataFrame:
    """The labels after all links of buckets that hold several components, see 5. and 6. above."""
    rows = common.materialise(_mixed(_with_component(buckets, labels), "band"), "near-mixed")
    members = rows.select("node", "component").distinct()
    wanted = nodes.select("node", "rep", "set_digest", "n").join(members, "node")
    sets = common.materialise(full_sets(docs, wanted.select("node", "rep", "set_digest"), id_col, text_col), "near-sets")
    spread = members.join(sets, "node").select("node", "component", F.explode("hashes").alias("h"))
    public = spread.groupBy("h").agg(F.min("component").alias("_a"), F.max("component").alias("_b")).where("_a <> _b").select("h")
    able = spread.join(public, "h").groupBy("node").agg(F.count(F.lit(1)).alias("_open")).join(wanted, "node")
    able = able.where(_enough(F.col("_open"), F.col("n"), percent)).select("node")
    rows = common.materialise(_mixed(rows.join(able, "node", "left_semi"), "band"), "near-mixed")
    if rows.isEmpty():
        return labels
    families = _mixed(_with_component(hub_pairs(rows), labels), "hub")
    found = common.materialise(differences(families, sets, percent), "near-differences")
    # g(A) + g(H) <= 0: linked with the hub.
    links = found.where((F.col("node") != F.col("hub")) & (F.col("g") + F.col("base") <= 0)).select(F.col("hub").alias("a"), F.col("node").alias("b"))
    labels = joined(labels, links)
    home = labels.select(F.col("node").alias("hub"), F.col("component").alias("_hub"))
    found = _with_component(found.drop("component"), labels).join(home, "hub", "left")
    found = found.withColumn("_home", F.col("component") == F.coalesce("_hub", "hub")).drop("_hub")
    shared = common.materialise(shared_differences(_mixed(found, "hub")), "near-differences")
    keys = common.materialise(_mixed(within_reach(difference_keys(shared, percent)), "hub", "key"), "near-keys")
    if keys.isEmpty():
        return labels
    labels = joined(labels, overlapping(key_stars(keys), shared, percent))
    keys = common.materialise(_mixed(_with_component(keys.drop("component"), labels), "hub", "key"), "near-keys")
    if keys.isEmpty():
        return labels
    return joined(labels, overlapping(key_pairs(keys), shared, percent))


def drop_near_copies(docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: of each component the rows of its smallest id."""
    gone = near_groups(docs, percent, id_col, text_col).where("NOT kept").select(F.col("doc_id").alias("_gone_id"), F.col("row").alias("_gone_row")).distinct()
    same = F.col(id_col).cast("long").eqNullSafe(F.col("_gone_id")) & (common.text_key(text_col) == F.col("_gone_row"))
    return docs.join(gone, same, "left_anti")


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(common.table(spark, sf_dir, "documents")).drop("row")
