"""Near-duplicates by a chosen-path join: documents whose sets of word shingles overlap enough.

Documents with equal sets form a class. Classes meet in nodes of independent random trees:
at the root a class follows two minwise tokens of its set, below it one, so a child node holds
classes that agree on a path of tokens. A node of at most ``NODE`` classes is a leaf and is
compared exhaustively by sketches; a larger one branches again, and as every class follows
one token there, a group of near copies does not multiply on its way down. What is still large
at the last level is compared in pairs of blocks, each pair of classes in one of them. Leaves with the same members, from whatever trees,
are compared once, and a pair with several leaves in common is proposed by one of them.

Links count only if confirmed on the full sets. First each leaf proposes a maximum spanning
forest of its sketch similarities, which is enough for most groups. Then leaves propose
the strongest pairs between components not yet joined, and at last all such pairs, so a group
of n copies costs about n confirmations, and yet every pair that sketches let through is
either confirmed, refuted or inside a component. Pairs of these later rounds must also pass
a finer sketch, made from the full sets of the classes still in question.

A pair at the threshold shares a leaf of the first level in one of the trees but for a
probability of 2e-10, one of the second level but for 2e-6, of the third but for 2e-4, and its
sketch passes with probability 0.9995, the finer one with 0.9999; with higher similarity all of
them come closer to 1.
Shingles and classes are known by 64-bit hashes.

Texts without words, empty and null ones have an empty set and link with nothing; they are
their own component. Rows with the same id count as one document per different set and share
their component if linked. A row with a null id is linked through null only and gets a null
component. Every input row gives a row; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.graph import components
from eventloom.llm.tables import free_name, stored
from eventloom.llm.text import Words, by_slices, lists, mixed, rolling, tuned

#: Independent trees, and levels a node can branch.
TREES, LEVELS = 8, 5
#: Largest node that is compared exhaustively, and half of it for blocks.
NODE = 1000
#: Coordinates of the sketch that estimates similarity.
SKETCH = 256
#: Standard errors below the threshold at which a sketch still lets a pair through.
MARGIN = 3.3
#: Bits of the bin number in the finer sketch, and its margin in standard errors.
FINE_BITS, FINE_MARGIN = 10, 4.0
TOKENS = 2 * TREES + TREES * 2 * (LEVELS - 1)

_RANDOM = np.random.default_rng(7)
_MULTIPLY = _RANDOM.integers(0, 2**64, SKETCH, dtype=np.uint64) | np.uint64(1)
_ADD = _RANDOM.integers(0, 2**64, SKETCH, dtype=np.uint64)


def shingle_sets(batch: pa.RecordBatch, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts one after another, and their number per text."""
    words = Words(batch.column("text"), lower=True)
    hashes = words.hashes()
    counts = words.counts
    at = words.window_starts(k)
    doc = words.doc
    codes = mixed(rolling(hashes, k)[at]) if len(at) else np.zeros(0, np.uint64)
    owner = doc[at]
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        whole = []
        for d in short:
            code = np.uint64(counts[d])
            for h in hashes[words.first[d] : words.first[d + 1]]:
                code = mixed(np.array([code * np.uint64(31) + h]))[0]
            whole.append(code)
        codes, owner = np.concatenate([codes, np.array(whole, np.uint64)]), np.concatenate([owner, short])
    order = np.lexsort((codes, owner))
    codes, owner = codes[order], owner[order]
    new = np.ones(len(codes), bool)
    new[1:] = (codes[1:] != codes[:-1]) | (owner[1:] != owner[:-1])
    return codes[new], np.bincount(owner[new], minlength=batch.num_rows)


def class_codes(codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A 64-bit value per set, the same whatever its order; 0 for an empty one."""
    out = np.zeros(len(counts), np.uint64)
    full = np.flatnonzero(counts)
    if len(full):
        begin = (np.cumsum(counts) - counts)[full]
        out[full] = mixed(np.add.reduceat(mixed(codes ^ np.uint64(0x5851F42D4C957F2D)), begin) + counts[full].astype(np.uint64))
    return out.view(np.int64)


def sketch_slice(batch: pa.RecordBatch, k: int) -> pa.RecordBatch:
    with np.errstate(over="ignore"):
        codes, counts = shingle_sets(batch, k)
        classes = class_codes(codes, counts)
        full = np.flatnonzero(counts)
        sketch = np.zeros((batch.num_rows, SKETCH), np.uint32)
        if len(full):
            begin = (np.cumsum(counts) - counts)[full]
            for j in range(SKETCH):
                value = ((codes * _MULTIPLY[j] + _ADD[j]) >> np.uint64(32)).astype(np.uint32)
                sketch[full, j] = np.minimum.reduceat(value, begin)
    small = sketch.astype(np.uint16)
    columns = [
        batch.column("doc_id"),
        pa.array(counts.astype(np.int64)),
        pa.array(classes),
        pa.array([row.tobytes() for row in small], pa.binary()),
        pa.array([row.tobytes() for row in np.ascontiguousarray(sketch[:, :TOKENS])], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "class", "sketch", "tokens"])


def fine_sketches(batches):
    """(class, fine): the least hash of each bin of the hash range, as a byte; 0 for an empty bin."""
    for batch in batches:
        blobs = []
        for blob in batch.column("codes"):
            codes = np.frombuffer(blob.as_buffer(), np.uint64)
            bins, first = np.unique(codes >> np.uint64(64 - FINE_BITS), return_index=True)
            fine = np.zeros(1 << FINE_BITS, np.uint8)
            fine[bins.astype(np.int64)] = codes[first] % np.uint64(255) + np.uint64(1)
            blobs.append(fine.tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("class"), pa.array(blobs, pa.binary())], ["class", "fine"])


def within_reach(fine: np.ndarray, size: np.ndarray, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs the finer sketch lets through.

    Equal bins among those that either set fills estimate the similarity; the fewer elements of
    the union share a bin, the closer. Two bins more are allowed for, as small sets have few.
    """
    share, step, passed = percent / 100, 2000, [np.zeros(0, bool)]
    for i in range(0, len(a), step):
        left, right = a[i : i + step], b[i : i + step]
        x, y = fine[left], fine[right]
        used = ((x | y) > 0).sum(axis=1)
        equal = ((x == y) & (x > 0)).sum(axis=1)
        union = (size[left] + size[right]) / (1 + share)
        variance = share * (1 - share) * np.maximum(union / used - 1, 0) / np.maximum(union - 1, 1)
        passed.append(equal + 2 >= used * (share - FINE_MARGIN * np.sqrt(variance)))
    return np.concatenate(passed)


def branches(level: int):
    """Child nodes of each row: of the root by two tokens in each tree, else by one of its path.

    A path is a tree and its first token, so that paths of a tree have their own tokens.
    """

    def loop(batches):
        for batch in batches:
            n = batch.num_rows
            tokens = np.frombuffer(b"".join(batch.column("tokens").to_pylist()), np.uint32).reshape(n, TOKENS).astype(np.uint64)
            classes = batch.column("class").to_numpy()
            node = np.zeros(n, np.uint64) if level == 0 else batch.column("node").to_numpy().view(np.uint64)
            path = None if level == 0 else batch.column("path").to_numpy()
            for p in range(2 * TREES):
                mine = np.arange(n) if path is None else np.flatnonzero(path == p)
                c = 2 * TREES * level + p
                child = mixed((node[mine] ^ mixed(tokens[mine, c] + np.uint64((c + 1) << 32))) * np.uint64(0x9E3779B97F4A7C15))
                columns = [pa.array(child.view(np.int64)), pa.array(np.full(len(mine), p, np.int32)), pa.array(classes[mine])]
                yield pa.RecordBatch.from_arrays(columns, ["node", "path", "class"])

    return loop


def leaves(classes: DataFrame) -> DataFrame:
    """(node, class, base, own) of all leaves with two or more classes, equal leaves once.

    ``base`` is the node of the path that the leaf belongs to: the leaf itself, or the node of the last level that was
    cut into blocks, where ``own`` is the class' block. A class has one base per path at most.
    """
    named = F.bit_xor(F.xxhash64("class")), F.bit_xor(F.xxhash64(F.lit(1), "class"))
    made, rows = [], classes.select("class", "tokens")
    for level in range(LEVELS):
        entries = stored(rows.mapInArrow(branches(level), "node long, path int, class long"), f"level{level}")
        size = entries.groupBy("node").agg(F.count("*").alias("n"), named[0].alias("x"), named[1].alias("y")).where("n > 1")
        size = stored(size, f"sizes{level}")
        small = size.where(F.col("n") <= NODE).groupBy("n", "x", "y").agg(F.min("node").alias("node"))
        made.append(entries.join(small.select("node"), "node").select("node", "class", F.col("node").alias("base"), F.lit(0).alias("own")))
        large = size.where(F.col("n") > NODE).select("node", "n")
        if not large.limit(1).count():
            break
        hot = entries.join(large, "node")
        if level == LEVELS - 1:
            blocks = F.ceil(2 * F.col("n") / NODE).cast("int")
            own = F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int")
            placed = hot.withColumn("blocks", blocks).withColumn("own", own)
            spread = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            key = F.xxhash64("node", F.least("own", "other"), F.greatest("own", "other"))
            made.append(spread.select(key.alias("node"), "class", F.col("node").alias("base"), "own"))
        else:
            rows = hot.select("node", "path", "class").join(classes.select("class", "tokens"), "class")
    whole = made[0]
    for part in made[1:]:
        whole = whole.unionByName(part)
    return whole


def similar(sketch: np.ndarray) -> np.ndarray:
    """Number of equal coordinates of all pairs of rows."""
    n = len(sketch)
    equal = np.zeros((n, n), np.int16)
    step = max(1, 4_000_000 // (n * SKETCH))
    for i in range(0, n, step):
        equal[i : i + step] = (sketch[i : i + step, None, :] == sketch[None, :, :]).sum(axis=2, dtype=np.int16)
    return equal


def root(parent: list[int], x: int) -> int:
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def forests(pairs: np.ndarray, n: int, most: int) -> np.ndarray:
    """The first pairs, in order, that make up to ``most`` forests without a common pair."""
    left, kept = np.arange(len(pairs)), []
    for _ in range(most):
        if len(left) == 0:
            break
        parent, used = list(range(n)), np.zeros(len(left), bool)
        for i, (a, b) in enumerate(pairs[left].tolist()):
            a, b = root(parent, a), root(parent, b)
            if a != b:
                parent[a] = b
                used[i] = True
        kept.append(left[used])
        left = left[~used]
    return np.concatenate(kept) if kept else left


def met_before(base: int, owner: np.ndarray, home: np.ndarray, n: int) -> np.ndarray:
    """Which pairs of the ``n`` members of a leaf also meet under a base of smaller number than its own;
    ``home`` are the bases of the members ``owner``."""
    earlier = home < base
    owner, home = owner[earlier], home[earlier]
    order = np.argsort(home, kind="stable")
    owner, home = owner[order], home[order]
    shared = np.zeros((n, n), bool)
    edges = np.flatnonzero(np.diff(home)) + 1
    for i, j in zip(np.append(0, edges), np.append(edges, len(home)), strict=True):
        if j - i > 1:
            shared[np.ix_(owner[i:j], owner[i:j])] = True
    return shared


def propose(least: int, most: int, percent: int):
    """Pairs (a, b) of leaf members that sketches and sizes let through, at most ``most`` forests of
    each leaf (0: all), and only between different components where rows have one. A pair that
    shares several leaves is left to the first of them, by number. Rows with a finer sketch are
    held to that as well."""

    def comparable(x, y):
        return 100 * np.minimum(x, y) >= percent * np.maximum(x, y)

    def leaf(base, own, classes, sketch, fine, size, component, owner, home):
        equal = similar(sketch)
        wanted = np.triu(equal >= least, 1) & (component[:, None] != component[None, :])
        if own.min() != own.max():
            # Two blocks of a node: pairs within either are compared in its own leaf.
            wanted &= own[:, None] != own[None, :]
        a, b = np.nonzero(wanted)
        near = comparable(size[a], size[b])
        a, b = a[near], b[near]
        if len(a):
            known = met_before(base, owner, home, len(classes))[a, b]
            a, b = a[~known], b[~known]
        if fine is not None:
            near = within_reach(fine, size, a, b, percent)
            a, b = a[near], b[near]
        if most and len(a) > 1:
            order = np.lexsort((classes[b], classes[a], -equal[a, b]))
            a, b = a[order], b[order]
            # Forests over components: only pairs between different ones matter.
            names, of = np.unique(component, return_inverse=True)
            keep = forests(np.stack([of[a], of[b]], axis=1), len(names), most)
            a, b = a[keep], b[keep]
        return classes[a], classes[b]

    def loop(batches):
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            node = held.column("node").to_numpy()
            last = np.searchsorted(node, node[-1]) if len(node) else 0
            if last:
                yield from leaves_of(held.slice(0, last))
                held = held.slice(last)
        if held is not None and held.num_rows:
            yield from leaves_of(held)

    def leaves_of(table):
        node = table.column("node").to_numpy()
        classes, component, size, base, own = (table.column(c).to_numpy() for c in ("class", "component", "size", "base", "own"))
        sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint16).reshape(len(node), SKETCH)
        fine = None
        if "fine" in table.column_names:
            fine = np.frombuffer(b"".join(table.column("fine").to_pylist()), np.uint8).reshape(len(node), -1)
        begin = np.flatnonzero(np.diff(node, prepend=node[0] - 1 if node[0] > -(2**62) else node[0] + 1))
        end = np.append(begin[1:], len(node))
        two = begin[end - begin == 2]
        ok = ((sketch[two] == sketch[two + 1]).sum(axis=1) >= least) & (component[two] != component[two + 1]) & comparable(size[two], size[two + 1])
        if fine is not None:
            ok &= within_reach(fine, size, two, two + 1, percent)
        found = [(classes[two[ok]], classes[two[ok] + 1])]
        homes = table.column("homes").combine_chunks()
        count, home = pc.list_value_length(homes).to_numpy(), homes.flatten().to_numpy()
        at = np.append(0, np.cumsum(count))
        for i, j in zip(begin, end, strict=True):
            if j - i > 2:
                owner = np.repeat(np.arange(j - i), count[i:j])
                part = None if fine is None else fine[i:j]
                found.append(leaf(base[i], own[i:j], classes[i:j], sketch[i:j], part, size[i:j], component[i:j], owner, home[at[i] : at[j]]))
        a, b = (np.concatenate(x) for x in zip(*found, strict=True))
        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    return loop


def full_sets(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """(class, codes): the whole sorted set of each wanted class, from its least document."""

    def sets(batch: pa.RecordBatch) -> pa.RecordBatch:
        with np.errstate(over="ignore"):
            codes, counts = shingle_sets(batch, k)
            classes = class_codes(codes, counts)
        own = classes == batch.column("class").to_numpy()
        end = np.cumsum(counts)
        blobs = [codes[end[i] - counts[i] : end[i]].tobytes() for i in np.flatnonzero(own)]
        return pa.RecordBatch.from_arrays([pa.array(classes[own]), pa.array(blobs, pa.binary())], ["class", "codes"])

    rows = docs.join(wanted.select("class", "doc_id"), "doc_id").select("class", "text")
    return by_slices(rows, sets, "class long, codes binary").dropDuplicates(["class"])


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets reach the threshold."""
    first = sets.select(F.col("class").alias("a"), F.col("codes").alias("codes_a"))
    second = sets.select(F.col("class").alias("b"), F.col("codes").alias("codes_b"))

    def loop(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("codes_a"), batch.column("codes_b"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(first, "a").join(second, "b").mapInArrow(loop, "a long, b long")


def joined_by(known: DataFrame | None, links: DataFrame) -> DataFrame:
    """Components (class, component) after further links between classes."""
    if known is None:
        return stored(components(links).select(F.col("id").alias("class"), "component"), "components")
    if not links.limit(1).count():
        return known
    lifted = links
    for end in ("a", "b"):
        name = known.select(F.col("class").alias(end), F.col("component").alias("name"))
        other = "b" if end == "a" else "a"
        lifted = lifted.join(name, end, "left").select(F.coalesce("name", end).alias(end), other)
    moved = stored(components(lifted), "moved")
    ends = links.select(F.col("a").alias("class")).union(links.select(F.col("b").alias("class"))).distinct()
    whole = known.join(ends, "class", "full").select("class", F.coalesce("component", "class").alias("id"))
    named = whole.join(moved.withColumnRenamed("component", "to"), "id", "left").select("class", F.coalesce("to", "id").alias("component"))
    return stored(named, "components")


def class_components(docs: DataFrame, classes: DataFrame, k: int, percent: int) -> DataFrame:
    """(class, component) of all classes that are linked with another one."""
    share = percent / 100
    least = int(np.floor(SKETCH * share - MARGIN * np.sqrt(SKETCH * share * (1 - share))))
    met = stored(leaves(classes), "leaves")
    # Two classes under a base meet in one leaf of it, so the bases, one per path, say where a pair meets first.
    homes = stored(met.groupBy("class").agg(F.collect_set("base").alias("homes")), "homes")
    alone = classes.select("class", "sketch", "size", F.col("class").alias("component"))
    components_now = sets = fine = tried = None
    for most in (1, 3, 0):
        if components_now is None:
            member = met.join(alone, "class")
        else:
            # Only classes that resemble another one, and leaves that span components.
            now = sets.select("class").join(components_now, "class", "left").select("class", F.coalesce("component", "class").alias("component"))
            open_ = met.join(now, "class")
            spans = open_.groupBy("node").agg((F.min("component") < F.max("component")).alias("open")).where("open").select("node")
            member = open_.join(spans, "node").join(alone.drop("component"), "class").join(fine, "class")
        ordered = member.join(homes, "class").repartition("node").sortWithinPartitions("node")
        pairs = ordered.mapInArrow(propose(least, most, percent), "a long, b long").distinct()
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = stored(pairs, "pairs")
        if not pairs.limit(1).count():
            if sets is None:
                return alone.select("class", "component").limit(0)
            # What the forests of a leaf have left out may not be tried yet: the last round proposes it.
            continue
        if sets is None:
            ends = pairs.select(F.col("a").alias("class")).union(pairs.select(F.col("b").alias("class"))).distinct()
            sets = stored(full_sets(docs, classes.join(ends, "class"), k), "sets")
            fine = stored(sets.mapInArrow(fine_sketches, "class long, fine binary"), "fine")
        fresh = stored(confirm(pairs, sets, percent), "links")
        tried = pairs if tried is None else tried.unionByName(pairs)
        components_now = joined_by(components_now, fresh)
    return components_now


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 75) -> DataFrame:
    """doc_id, n_shingles, component_id (least id reachable), kept (it is the least one)."""
    tuned(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    shape = "doc_id long, n_shingles long, class long, sketch binary, tokens binary"
    rows = stored(by_slices(docs, lambda part: sketch_slice(part, k), shape), "sketches")
    full = rows.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    classes = full.groupBy("class").agg(F.min("doc_id").alias("doc_id"), F.min("sketch").alias("sketch"), F.min("tokens").alias("tokens"), F.min("n_shingles").alias("size"))
    classes = stored(classes, "classes")
    joined = stored(class_components(docs, classes, k, percent), "joined")
    named = classes.select("class", "doc_id").join(joined, "class", "left")
    least = named.groupBy(F.coalesce("component", "class").alias("component")).agg(F.min("doc_id").alias("component_id"))
    names = named.select("class", F.coalesce("component", "class").alias("component")).join(least, "component").select("class", "component_id")
    # One row per document and class, so that rows of a hot class are not dealt by their class.
    short = rows.select("doc_id", "n_shingles", "class")
    key = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("class"))
    out = short.withColumn("class", key).join(names, "class", "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), (component == F.col("doc_id")).alias("kept"))


def representatives(docs: DataFrame, k: int = 5, percent: int = 75) -> DataFrame:
    """One document of each group, all columns: the one of least id. Rows of one id with the
    same text count once; rows with a null id stay, each text once."""
    name = free_name(docs, "kept_id")
    found = near_duplicates(docs, k, percent).where("kept").select(F.col("doc_id").alias(name)).distinct()
    mine = docs.join(found, F.col("doc_id") == F.col(name), "left_semi").dropDuplicates(["doc_id", "text"])
    return mine.unionByName(docs.where(F.col("doc_id").isNull()).dropDuplicates(["text"]))
