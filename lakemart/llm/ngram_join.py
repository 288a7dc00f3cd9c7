"""N-gram Jaccard join with a prefix tree (operator 4).

A document's set holds the 64-bit hashes of its distinct k-word shingles in
one global order (ascending hash).  Equal sets are one node, so exact copies
meet before any comparison.

Routing.  Two linked sets differ in at most (1-t)/(1+t) * (n1+n2) shingles.
The hash space is cut into one range more than that, so one range holds the
same shingles in both.  A set emits a key for the contents of each of its
ranges; the number of ranges depends on a size class, and a set just below a
class border also emits the upper class's keys.  A range that is empty in
both gives no key.  If all equal ranges of a linked pair are empty, each shingle
of either set lies in a range where they differ, so neither set fills more
ranges than it can differ in shingles.  The few sets that fill so few also emit
their prefix (the first n - ceil(t*n) + 1 shingles), one of which every linked
pair shares.  Sets that share keys, directly or through others,
form a candidate component; each set is in one, so its shingles are shuffled
once, not once for each key.  The keys are shuffled once: sorted, those of a
single set are left out where they arrive.  Keys with the same sets would be
compared alike, so the sketches are sent to one of them only.

Join.  Within a component the sets are stored in a prefix tree over the global
order.  A probe walks it level by level: the overlap up to a node is counted
once for all sets below it, and a subtree is left as soon as the overlap plus
the shingles remaining on either side can't reach the threshold.

A large component is cut into blocks and joined in two passes.  First every
block meets block 0, a set sample by hash: work that grows with the sets.
Sets linked through it already are in one group, and pairs within a group need
no comparison.  So the second pass walks only the sets outside the component's
largest group, against all blocks but block 0, which they have met.

Only a spanning set of links leaves a task's group, never all pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm.components import connected_components, removed, stored, stored_at
from lakemart.llm.textblocks import SPACE_WORD, U, blocks, list_column, map_batches, mix, packed, shingles, unpacked

#: Sets, and shingles of them all, in one block of a large component.
BLOCK_SETS, BLOCK_SHINGLES = 512, 1 << 20
#: Sets of one key up to which sketches are compared, and the least bits of a sketch.
FULL_KEY, SKETCH_BITS = 4096, 1024
#: Upper bits of a key that are stored: few keys among 10^11 are equal by chance, which costs a comparison, never a link.
KEY_BITS = 48


class Threshold:
    """Jaccard of at least num/den, in whole numbers."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        self.ratio = (num / den) ** -3

    def links(self, overlap, sizes):
        """Whether ``overlap`` of sets with ``sizes`` shingles together reaches the threshold."""
        return overlap * (self.num + self.den) >= self.num * sizes

    def class_floor(self, c: int) -> int:
        return math.ceil(self.ratio ** c)

    def classes(self, n: int) -> list[int]:
        """The size classes whose keys a set of n shingles emits."""
        c = int(math.log(n) / math.log(self.ratio)) if n > 1 else 0
        while self.class_floor(c + 1) <= n:
            c += 1
        while c and self.class_floor(c) > n:
            c -= 1
        return [c, c + 1] if n * self.den >= self.num * self.class_floor(c + 1) else [c]

    def ranges(self, c: int) -> int:
        """One more than two linked sets of class c can differ in."""
        return self.apart(2 * (self.class_floor(c + 1) - 1)) + 1

    def differ(self, n: int, c: int) -> int:
        """In how many shingles a set of class c that is linked with one of n shingles can differ from it."""
        return self.apart(n + min(n * self.den // self.num, self.class_floor(c + 1) - 1))

    def apart(self, sizes):
        """In how many shingles two linked sets of these sizes together can differ."""
        return (self.den - self.num) * sizes // (self.den + self.num)

    def prefix(self, n: int) -> int:
        return n - -(-n * self.num // self.den) + 1


def shingle_sets(column: pa.Array, k: int) -> Iterator[np.ndarray]:
    """Each text's sorted distinct shingle hashes (ASCII letters lower-cased).

    Fewer than k words: the whole sequence is the one shingle; no words: empty.
    """
    for block in blocks(column, lower=True):
        start, end, first = block.words(SPACE_WORD)
        wh = block.span_hash(start, end)
        sh, whole = shingles(wh, first, k)
        for lo, hi in zip(first[:-1].tolist(), first[1:].tolist()):
            if hi - lo >= k:
                s = np.sort(sh[lo:hi - k + 1])
                if len(s) > 1:
                    s = s[np.concatenate([[True], s[1:] != s[:-1]])]
                yield s
            elif hi > lo:
                short, _ = shingles(wh[lo:hi], np.array([0, hi - lo]), hi - lo)
                yield mix(short[:1] + U(hi - lo))
            else:
                yield np.zeros(0, U)


def set_id(tokens: np.ndarray) -> int:
    """64-bit identity of a set, as a signed number."""
    total = int(mix(tokens).sum(dtype=U)) + len(tokens) * 0x9E3779B97F4A7C15
    return int(mix(np.array([total & (1 << 64) - 1], U)).astype(np.int64)[0])


def routing_keys(tokens: np.ndarray, t: Threshold) -> np.ndarray:
    """Keys of which two linked sets share at least one."""
    n, out, few_filled = len(tokens), [], False
    spread = mix(tokens)
    for c in t.classes(n):
        r = t.ranges(c)
        if r == 1:
            continue  # only equal sets link, and those are one node
        of = ((tokens >> U(32)) * U(r)) >> U(32)
        begins = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
        sums = np.add.reduceat(spread, begins)
        out.append(mix(sums + mix(of[begins] + U((c + 1) << 40))))
        few_filled |= len(begins) <= t.differ(n, c)
    if few_filled:
        out.append(mix(tokens[:t.prefix(n)] + U(0x51ED270B)))
    return np.concatenate(out) if out else np.zeros(0, U)


def sketch(tokens: np.ndarray) -> bytes:
    """Parities of the shingles by slot; a power of two of slots, two or more for each shingle."""
    bits = max(SKETCH_BITS, 1 << (2 * len(tokens) - 1).bit_length())
    odd = np.bincount((mix(tokens ^ U(0x2545F491)) & U(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def folded(flat: np.ndarray, start: np.ndarray, length: np.ndarray, to: int) -> np.ndarray:
    """Sketches of ``length`` 64-bit words from ``start`` on, folded to ``to`` words each."""
    out = np.empty((len(start), to), U)
    for n in np.unique(length).tolist():
        own = length == n
        rows = flat[start[own][:, None] + np.arange(n)]
        while rows.shape[1] > to:
            half = rows.shape[1] // 2
            rows = rows[:, :half] ^ rows[:, half:]
        out[own] = rows
    return out


def tied(sizes: np.ndarray, sketches: np.ndarray, t: Threshold) -> Iterator[tuple[int, np.ndarray]]:
    """(i, others): ties that span the groups of sets whose sketches allow a link."""
    left = np.arange(len(sizes))
    while len(left):
        queue, left = [int(left[0])], left[1:]
        while queue and len(left):
            i = queue.pop()
            differ = np.bitwise_count(sketches[left] ^ sketches[i]).sum(axis=1, dtype=np.int64)
            near = differ <= t.apart(sizes[left] + sizes[i])
            if near.any():
                yield i, left[near]
                queue += left[near].tolist()
                left = left[~near]


class PrefixTree:
    """Sets (sorted rows of small integers, all different) by shared prefixes, one run of shingles a node."""

    def __init__(self, sets: list[np.ndarray], t: Threshold):
        self.t = t
        order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">i4").tobytes())
        rows = [sets[i] for i in order]
        self.sizes = np.array([len(r) for r in rows])
        base = np.concatenate([[0], np.cumsum(self.sizes)])
        self.tokens = np.concatenate(rows)
        common = np.zeros(len(rows) + 1, np.int64)
        for i in range(1, len(rows)):
            m = min(len(rows[i - 1]), len(rows[i]))
            differ = rows[i - 1][:m] != rows[i][:m]
            at = int(differ.argmax()) if m else 0
            common[i] = at if m and differ[at] else m
        nodes, todo, at = [], [(0, len(rows), 0)], 0
        while at < len(todo):  # breadth first: a node's children lie side by side
            lo, hi, depth = todo[at]
            at += 1
            upto = int(common[lo + 1:hi].min()) if hi - lo > 1 else int(self.sizes[lo])
            ends = lo if self.sizes[lo] == upto else -1
            below = lo + (ends >= 0)
            children = len(todo)
            if below < hi:
                cuts = [below, *(below + 1 + np.flatnonzero(common[below + 1:hi] == upto)).tolist(), hi]
                todo += [(a, b, upto) for a, b in zip(cuts[:-1], cuts[1:])]
            part = self.sizes[lo:hi]
            nodes.append((base[lo] + depth, base[lo] + upto, upto, part.min(), part.max(), children, len(todo),
                          order[ends] if ends >= 0 else -1))
        (self.start, self.end, self.depth, self.least, self.most, self.first, self.last,
         self.ends) = np.array(nodes, np.int64).T

    def linked(self, probe: np.ndarray, marks: np.ndarray) -> np.ndarray:
        """Indexes of the sets that link with the probe; marks: scratch flags, all False."""
        n, marks[probe] = len(probe), True
        active, overlap, found = np.zeros(1, np.int64), np.zeros(1, np.int64), []
        while len(active):
            length = self.end[active] - self.start[active]
            stop = np.cumsum(length)
            at = np.arange(stop[-1]) + np.repeat(self.start[active] - (stop - length), length)
            hits = np.concatenate([[0], np.cumsum(marks[self.tokens[at]])])
            overlap = overlap + hits[stop] - hits[stop - length]
            left = n - np.searchsorted(probe, self.tokens[np.maximum(self.end[active] - 1, 0)], "right")
            left = np.where(self.depth[active] > 0, left, n)
            bound = overlap + np.minimum(left, self.most[active] - self.depth[active])
            keep = self.t.links(bound, n + self.least[active])
            active, overlap = active[keep], overlap[keep]
            end = self.ends[active]
            is_set = end >= 0
            ok = self.t.links(overlap[is_set], n + self.depth[active][is_set])
            found.append(end[is_set][ok])
            fan = self.last[active] - self.first[active]
            stop = np.cumsum(fan)
            overlap = np.repeat(overlap, fan)
            active = np.arange(stop[-1] if len(stop) else 0) + np.repeat(self.first[active] - (stop - fan), fan)
        marks[probe] = False
        return np.concatenate(found)


def tree_links(left: list[np.ndarray], right: list[np.ndarray] | None, t: Threshold) -> list[tuple[int, int]]:
    """Links that span the groups of the left sets (right None) or join left sets with right ones.

    Returned as index pairs; right sets count on from the left ones.
    """
    sets = left + (right or [])
    codes = np.unique(np.concatenate(sets), return_inverse=True)[1].astype(np.int64)
    cuts = np.cumsum([len(s) for s in sets])[:-1]
    sets = np.split(codes, cuts)
    tree, marks = PrefixTree(sets[:len(left)], t), np.zeros(int(codes.max()) + 1, bool)
    parent = list(range(len(sets)))

    def root(i):
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    out = []
    for i in range(len(left) if right is not None else 0, len(sets)):
        for j in tree.linked(sets[i], marks).tolist():
            a, b = root(i), root(j)
            if a != b:
                parent[max(a, b)] = min(a, b)
                out.append((i, j))
    return out


def _describe(k: int, t: Threshold):
    def rows(batch):
        ids = batch.column("doc_id").to_pylist()
        sizes, sids, keys, counts, sketches, seen = [], [], [], [], [], set()
        for doc, tokens in zip(ids, shingle_sets(batch.column("text"), k)):
            sizes.append(len(tokens))
            sid = set_id(tokens) if len(tokens) and doc is not None else None
            sids.append(sid)
            own = routing_keys(tokens, t) if sid is not None and sid not in seen else np.zeros(0, U)
            seen.add(sid)
            sketches.append(sketch(tokens) if sid is not None else None)
            keys.append(own)
            counts.append(len(own))
        yield {"doc_id": batch.column("doc_id"), "mark": batch.column("mark"), "n_shingles": sizes, "set_id": sids, "sketch": sketches,
               "keys": list_column(np.concatenate(keys) >> U(64 - KEY_BITS), np.array(counts))}

    return rows


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows, each once, of keys that two sets or more have, with the key's least set; over rows sorted by key and set.

    One row is held from batch to batch, however many rows a key has.
    """
    key = sid = least = np.zeros(0, np.int64)
    before = np.zeros(0, bool)  # whether the held row follows another of its key
    names = ["key", "set_id", "least"]
    for batch in batches:
        if not batch.num_rows:
            continue
        key = np.concatenate([key, batch.column("key").to_numpy()])
        sid = np.concatenate([sid, batch.column("set_id").to_numpy()])
        once = np.concatenate([[True], (key[1:] != key[:-1]) | (sid[1:] != sid[:-1])])
        key, sid = key[once], sid[once]
        follows = np.concatenate([[False], key[1:] == key[:-1]])
        begin = np.maximum.accumulate(np.where(follows, 0, np.arange(len(key))))
        first = sid.copy()
        if len(before):
            follows[0], first[0] = before[0], least[0]
        least, meets = first[begin], follows.copy()
        meets[:-1] |= key[1:] == key[:-1]
        out = np.flatnonzero(meets[:-1])
        yield pa.RecordBatch.from_arrays([pa.array(x[out]) for x in (key, sid, least)], names)
        key, sid, least, before = key[-1:], sid[-1:], least[-1:], follows[-1:]
    if len(before) and before[0]:
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (key, sid, least)], names)


def _ties(t: Threshold):
    """Ties of each key's sets, over rows sorted by key; a key's rows may go over several batches."""
    def emit(table):
        key = table.column("key").to_numpy()
        sid, size = table.column("set_id").to_numpy(), table.column("n").to_numpy()
        sketches = table.column("sketch").to_pylist()
        flat = np.frombuffer(b"".join(sketches), U)
        length = np.array([len(x) // 8 for x in sketches])
        start = np.cumsum(length) - length
        cuts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]]))
        many = np.diff(cuts)
        two = cuts[:-1][many == 2]
        words = np.minimum(length[two], length[two + 1])
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for n in np.unique(words).tolist():
            at = two[words == n]
            differ = folded(flat, start[at], length[at], n) ^ folded(flat, start[at + 1], length[at + 1], n)
            near = np.bitwise_count(differ).sum(axis=1, dtype=np.int64) <= t.apart(size[at] + size[at + 1])
            a.append(sid[at[near]])
            b.append(sid[at[near] + 1])
        for lo, hi in zip(cuts[:-1][many > 2].tolist(), cuts[1:][many > 2].tolist()):
            own = folded(flat, start[lo:hi], length[lo:hi], int(length[lo:hi].min()))
            for i, others in tied(size[lo:hi], own, t):
                a.append(np.full(len(others), sid[lo + i]))
                b.append(sid[lo:hi][others])
        a, b = np.concatenate(a), np.concatenate(b)
        pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1) if len(a) else np.zeros((2, 0), np.int64)
        return pa.RecordBatch.from_arrays([pa.array(pairs[0], pa.int64()), pa.array(pairs[1], pa.int64())], ["a", "b"])

    def run(batches):
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if held is not None:
                table = pa.concat_tables([held, table]).combine_chunks()
            key = table.column("key").to_numpy()
            whole = int(np.searchsorted(key, key[-1])) if len(key) else 0
            if whole:
                yield emit(table.slice(0, whole))
            held = table.slice(whole)
        if held is not None and held.num_rows:
            yield emit(held)

    return run


def _tokens(k: int):
    def rows(batch):
        out = []
        for want, tokens in zip(batch.column("set_id").to_pylist(), shingle_sets(batch.column("text"), k)):
            out.append(tokens if len(tokens) and set_id(tokens) == want else np.zeros(0, U))
        yield {"component": batch.column("component"), "set_id": batch.column("set_id"),
               "blocks": batch.column("blocks"), "tokens": list_column(np.concatenate(out), np.array([len(x) for x in out]))}

    return rows


def _join_group(t: Threshold):
    """Links of a group's tree sets with its probes, or with each other in the group (part 0, probes 0)."""
    def run(table: pa.Table) -> pa.Table:
        sids = table.column("set_id").to_numpy()
        probes = table.column("is_probe").to_numpy(zero_copy_only=False)
        tokens = table.column("tokens").combine_chunks()
        flat = tokens.flatten().to_numpy().astype(U)
        offs = np.concatenate([[0], np.cumsum(tokens.value_lengths().to_numpy())])
        sides: tuple[dict[int, np.ndarray], dict[int, np.ndarray]] = {}, {}
        for i, (sid, probe) in enumerate(zip(sids.tolist(), probes.tolist())):
            if offs[i + 1] > offs[i]:
                sides[probe][sid] = flat[offs[i]:offs[i + 1]]
        alone = table.column("part")[0].as_py() == table.column("probes")[0].as_py() == 0
        left, right = sides
        names, links = [*left, *right], []
        if left and (len(left) > 1 if alone else right):
            links = tree_links([*left.values()], None if alone else [*right.values()], t)
        return pa.table({"a": pa.array([names[i] for i, _ in links], pa.int64()),
                         "b": pa.array([names[j] for _, j in links], pa.int64())})

    return run


def _blocks() -> Column:
    """Blocks of a group of sets with n shingles each."""
    return F.ceil(F.greatest(F.count("*") / BLOCK_SETS, F.sum("n") / BLOCK_SHINGLES)).cast("int")


def _groups(members: DataFrame, part, probes, is_probe: bool) -> DataFrame:
    """Rows for the groups (component, part, probes); ``part`` or ``probes`` may be an array, a row for each."""
    return members.select("component", part.alias("part"), probes.alias("probes"), F.lit(is_probe).alias("is_probe"),
                          "set_id", "tokens")


def _tree_joins(rows: DataFrame, t: Threshold, spark, name: str) -> DataFrame:
    return stored(rows.groupBy("component", "part", "probes").applyInArrow(_join_group(t), "a long, b long"), spark, name)


def _links(members: DataFrame, t: Threshold, spark) -> DataFrame:
    """Links that span each component's groups; members: (component, set_id, blocks, block, tokens)."""
    zero, others = F.lit(0), F.explode(F.expr("sequence(0, blocks - 1)"))
    first = _tree_joins(_groups(members.where("block = 0"), zero, others, False)
                        .unionAll(_groups(members.where("block > 0"), zero, F.col("block"), True)), t, spark, "links-first")

    many = members.where("blocks > 1")
    part_of = connected_components(first, spark).withColumnRenamed("component", "part_of")
    placed = (many.select("component", "set_id", "block", F.size("tokens").alias("n")).join(part_of, F.col("set_id") == F.col("node"), "left")
              .select("component", "set_id", "block", "n", F.coalesce("part_of", "set_id").alias("part_of")))
    largest = (placed.groupBy("component", "part_of").agg(F.count("*").alias("m"))
               .groupBy("component").agg(F.max_by("part_of", F.struct("m", "part_of")).alias("largest")))
    outside = placed.join(largest, "component").where("part_of <> largest AND block > 0").select("component", "set_id", "n")
    cut = outside.groupBy("component").agg(_blocks().alias("cuts"))
    still = stored(outside.drop("n").join(cut, "component"), spark, "outside")
    cut = still.select("component", "cuts").distinct()
    later = many.where("block > 0")
    probes = later.join(still.select("set_id", "cuts"), "set_id").withColumn("cut", F.pmod(F.xxhash64("set_id", F.lit(1)), F.col("cuts")).cast("int"))
    second = _tree_joins(
        _groups(later.join(cut, "component"), F.col("block"), F.explode(F.expr("sequence(0, cuts - 1)")), False)
        .unionAll(_groups(probes, F.explode(F.expr("sequence(1, blocks - 1)")), F.col("cut"), True)), t, spark, "links-second")
    return first.unionAll(second)


def ngram_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 3,
                     threshold: tuple[int, int] = (90, 100)) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of ``docs``.

    component_id is the least id reachable over links, the row's own included;
    two rows link when the Jaccard similarity of their shingle sets is at least
    threshold[0] / threshold[1].

    Nulls: a null text has no words.  A text without words has an empty set and
    links with nothing.  A row without id links with nothing and has a null
    component_id.  Repeated rows (also with one id) each give a row.  Other
    columns of ``docs`` are left aside whatever their names.  An empty table
    gives no rows.  Texts are taken whole, however long.
    """
    return _components(docs, id_col, text_col, k, threshold).select("doc_id", "n_shingles", "component_id")


def _components(docs: DataFrame, id_col: str, text_col: str, k: int, threshold: tuple[int, int]) -> DataFrame:
    """The rows of ngram_components with ``mark``, the hash of the row's text."""
    spark, t = docs.sparkSession, Threshold(*threshold)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    described_at, described = stored_at(
        map_batches(texts.withColumn("mark", F.xxhash64("text")), _describe(k, t),
                    "doc_id long, mark long, n_shingles long, set_id long, sketch binary, keys array<long>"), spark, "described")
    sets = stored(described.select("doc_id", "mark", "n_shingles", "set_id"), spark, "sets")
    nodes = stored(described.where("set_id IS NOT NULL").groupBy("set_id")
                   .agg(F.min("doc_id").alias("doc_id"), F.max("n_shingles").alias("n"), F.first("sketch").alias("sketch")),
                   spark, "nodes")

    keys = described.select("set_id", F.explode("keys").alias("key"))
    common_at, common = stored_at(keys.repartition("key").sortWithinPartitions("key", "set_id")
                                  .mapInArrow(_shared, "key long, set_id long, least long"), spark, "common-keys")
    removed(spark, described_at)
    # counted here, among the few keys that two sets share, and not in the large shuffle above
    met = stored(common.groupBy("key").agg(F.count("*").alias("m"), F.expr("bit_xor(xxhash64(set_id))").alias("same")), spark, "met-keys")
    full = met.where(F.col("m") > FULL_KEY).select("key")
    one = met.where(F.col("m") <= FULL_KEY).groupBy("same", "m").agg(F.min("key").alias("key")).select("key")
    small = (common.join(one, "key").select("key", "set_id").join(nodes.select("set_id", "n", "sketch"), "set_id")
             .repartition("key").sortWithinPartitions("key", "set_id"))
    ties = small.mapInArrow(_ties(t), "a long, b long").unionAll(
        common.join(full, "key", "left_semi").select(F.col("set_id").alias("a"), F.col("least").alias("b")))
    candidates = stored(connected_components(ties, spark), spark, "candidates")
    removed(spark, common_at)

    placed = nodes.join(candidates, nodes.set_id == candidates.node).select("doc_id", "set_id", "component", "n")
    blocks_of = placed.groupBy("component").agg(_blocks().alias("blocks"))
    chosen = placed.drop("n").join(blocks_of, "component")
    members = map_batches(chosen.join(texts, "doc_id").select("component", "set_id", "blocks", "text"), _tokens(k),
                          "component long, set_id long, blocks int, tokens array<long>")
    members = members.withColumn("block", F.pmod(F.xxhash64("set_id"), F.col("blocks")).cast("int"))
    members_at, members = stored_at(members, spark, "members")
    groups = stored(connected_components(_links(members, t, spark), spark), spark, "groups")
    removed(spark, members_at)

    label = nodes.join(groups, nodes.set_id == groups.node, "left").select("set_id", "doc_id", "component")
    least = label.where("component IS NOT NULL").groupBy("component").agg(F.min("doc_id").alias("least"))
    named = label.join(least, "component", "left").select("set_id", F.coalesce("least", "doc_id").alias("component_id"))
    return (sets.select("doc_id", "mark", "n_shingles", "set_id").join(named, "set_id", "left")
            .select("doc_id", "mark", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5,
             threshold: tuple[int, int] = (80, 100)) -> DataFrame:
    """The rows of ``docs`` that stay: of each group of linked rows the one with the least id.

    Rows without id stay, and so do null and empty texts, which are linked with
    nothing.  Of repeated rows with the group's least id, all stay.  Rows go by id
    and text: where an id has several texts, each is judged by its own group.
    All columns are kept, whatever their names; an empty table gives no rows.
    """
    out = _components(docs, id_col, text_col, k, threshold).where("doc_id <> component_id").select("doc_id", "mark").distinct()
    rows = packed(docs, text_col, doc_id=F.col(id_col).cast("long"), mark=F.xxhash64(F.col(text_col).cast("string")))
    return unpacked(rows.join(out, ["doc_id", "mark"], "left_anti"), docs.columns)


def oracle_sql(k: int = 3, threshold: tuple[int, int] = (90, 100)) -> str:
    """DuckDB SQL for ``op4_ngram_join``'s rows: all pairs that share a shingle, and the links' closure."""
    shingle = " || ' ' || ".join(f"w[i + {j}]" for j in range(k))
    words = (r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
             r"'[^\x20\x09-\x0D]+')")
    return f"""
WITH RECURSIVE w AS (SELECT doc_id, coalesce({words}, []) AS w FROM documents),
s AS MATERIALIZED (SELECT doc_id, CASE WHEN len(w) >= {k} THEN list_distinct(list_transform(range(1, len(w) - {k} + 2), lambda i: {shingle}))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM w),
e AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM s),
links AS MATERIALIZED (SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.x = b.x AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING {threshold[1]} * count(*) >= {threshold[0]} * (a.n + b.n - count(*))),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
first AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT doc_id, len(s) AS n_shingles, least(doc_id, coalesce(b, doc_id)) AS component_id FROM s LEFT JOIN first ON a = doc_id"""
