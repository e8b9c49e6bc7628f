"""SimHash near-dedup: 64-bit fingerprints, linked at ``budget`` or fewer differing bits.

Links come from a self-join of binary tries. Two fingerprints that differ in at most ``budget`` bits
agree on one of ``budget + 1`` blocks of bits at least, so each fingerprint is dealt once for every
block, by the block's value; inside a task the values form tries, one for each block value, that
begin below that block. Pairs of trie nodes are traversed together: a pair's children are paired,
a pair of unlike branches adds one differing bit, and what exceeds the budget is pruned. A block
value with over ``hot`` fingerprints is dealt again by blocks of the remaining bits, which splits it
without loss. A task reports the spanning forest of its links, never all pairs, so what moves stays
in proportion to the fingerprints; components are then found by spreading labels.

Equal fingerprints are one node, with its smallest document id. Defined cases: null and blank texts
have fingerprint 0 and are linked like others; fewer words than the shingle hash whole; very long
texts are read whole; repeated rows are one node; a null id is no component id unless nothing else is in the component (then
null); an empty table gives no rows; any other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.components import Forest, component_labels, connected_components, contracted
from corpusloom.llm.shared import bounded_batches, materialize, pieces_for, slices

BITS = 64
FRONTIER = 1 << 18
NO_ID = (1 << 63) - 1


def fingerprint(text: bytes | None, shingle: int, seed: int = 42) -> int:
    words = (text or b"").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(line, seed)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))[: len(words) - shingle + 1].tolist()
    hash_of = xxhash.xxh64_intdigest
    hashes = np.array([hash_of(line[a:b], seed) for a, b in zip(starts, (ends[shingle - 1 :] - 1).tolist(), strict=True)], np.uint64)
    return majority(hashes)


def majority(hashes: np.ndarray) -> int:
    """The bits that more than half of the hashes have."""
    ones = np.zeros(BITS, np.int64)
    for k in range(0, len(hashes), 32768):
        ones += np.unpackbits(hashes[k : k + 32768].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint16)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def _fingerprints(shingle: int):
    def run(batches):
        for batch in batches:
            text = batch.column("text").cast(pa.large_binary())
            sizes = pc.fill_null(pc.binary_length(text), 0).to_numpy()
            prints = [fingerprint(t, shingle) for a, b in slices(batch, sizes) for t in text.slice(a, b - a).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(np.array(prints, np.uint64).view(np.int64))], ["id", "print"])

    return run


# ---------------------------------------------------------------------------------- tries


def trie_links(values: np.ndarray, roots: np.ndarray, depth: np.ndarray, budget: int):
    """Yield arrays (i, j) of linked places. values: sorted within each root; roots: the first place
    of each trie (ascending); depth: how many leading bits a trie's values share."""
    ends = np.append(roots[1:], len(values))
    stack = [(roots, ends, roots, ends, np.zeros(len(roots), np.int64), depth.astype(np.int64))]
    while stack:
        a, a_end, b, b_end, spent, level = stack.pop()
        if len(a) > FRONTIER:
            half = len(a) // 2
            stack += [tuple(x[half:] for x in (a, a_end, b, b_end, spent, level)), tuple(x[:half] for x in (a, a_end, b, b_end, spent, level))]
            continue
        small = ((a_end - a) * (b_end - b) <= 16) | (level >= BITS)
        if small.any():
            yield from _compare(values, *(x[small] for x in (a, a_end, b, b_end)), budget)
            a, a_end, b, b_end, spent, level = (x[~small] for x in (a, a_end, b, b_end, spent, level))
        if not len(a):
            continue
        a_mid, b_mid = _split(values, a, a_end, level), _split(values, b, b_end, level)
        same = a == b
        children = [
            (a, a_mid, b, b_mid, spent),
            (a_mid, a_end, b_mid, b_end, spent),
            (a, a_mid, b_mid, b_end, spent + 1),
            *[tuple(np.where(same, 0, x) if k < 4 else x for k, x in enumerate((a_mid, a_end, b, b_mid, spent + 1)))],
        ]
        kept = [(*c, level + 1) for c in children]
        kept = [tuple(x[live] for x in c) for c in kept if (live := (c[0] < c[1]) & (c[2] < c[3]) & (c[4] <= budget)).any()]
        if kept:
            stack.append(tuple(np.concatenate(x) for x in zip(*kept, strict=True)))


def _split(values: np.ndarray, low: np.ndarray, high: np.ndarray, level: np.ndarray) -> np.ndarray:
    """Where the bit at ``level`` (0 is the highest) turns to 1 in a range that shares the bits above:
    a bisection of all ranges at once."""
    bit = (np.uint64(1) << (BITS - 1 - level).astype(np.uint64))
    low, high = low.copy(), high.copy()
    while (open_ := low < high).any():
        middle = (low + high) >> 1
        one = (values[np.minimum(middle, len(values) - 1)] & bit) != 0
        high = np.where(open_ & one, middle, high)
        low = np.where(open_ & ~one, middle + 1, low)
    return low


def _compare(values, a, a_end, b, b_end, budget):
    """All pairs of a few small node pairs, in slices; of a long node (equal values), in parts."""
    longest = np.maximum(1, (1 << 22) // np.maximum(1, b_end - b))
    if ((a_end - a) > longest).any():
        cut = [(x, min(x + n, e), f, g) for x, e, f, g, n in zip(a.tolist(), a_end.tolist(), b.tolist(), b_end.tolist(), longest.tolist(), strict=True) for x in range(x, e, n)]
        a, a_end, b, b_end = (np.array(x, np.int64) for x in zip(*cut, strict=True))
    width = b_end - b
    count = (a_end - a) * width
    part_of = np.cumsum(count) >> 22
    edges = np.flatnonzero(np.concatenate(([True], part_of[1:] != part_of[:-1], [True])))
    for start, end in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        part = slice(start, end)
        n = count[part]
        owner = np.repeat(np.arange(len(n)), n)
        k = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
        i, j = a[part][owner] + k // width[part][owner], b[part][owner] + k % width[part][owner]
        near = (i < j) & (np.bitwise_count(values[i] ^ values[j]) <= budget)
        yield i[near], j[near]


def _linking(budget: int, sign_budget: int):
    def run(batches):
        tables = [pa.Table.from_batches([b]) for b in batches if b.num_rows]
        if not tables:
            return
        table = pa.concat_tables(tables)
        kind, depth = table.column("kind").to_numpy(), table.column("depth").to_numpy()
        turned, nodes = table.column("turned").to_numpy().view(np.uint64), table.column("node").to_numpy()
        order = np.lexsort((turned, kind))
        kind, depth, turned, nodes = kind[order], depth[order], turned[order], nodes[order]
        signs = np.frombuffer(b"".join(table.column("sign").to_pylist()), np.uint64).reshape(len(order), -1)[order] if sign_budget >= 0 else None
        head = turned >> (BITS - depth).astype(np.uint64)
        roots = np.flatnonzero(np.concatenate(([True], (kind[1:] != kind[:-1]) | (head[1:] != head[:-1]))))
        forest = Forest(len(turned))
        for i, j in trie_links(turned, roots, depth[roots], budget):
            if signs is not None:
                near = np.bitwise_count(signs[i] ^ signs[j]).sum(axis=1) <= sign_budget
                i, j = i[near], j[near]
            forest.join(i, j)
        parent = forest.roots(np.arange(len(turned)))
        child = np.flatnonzero(parent != np.arange(len(turned)))
        yield pa.RecordBatch.from_pydict({"a": pa.array(nodes[child], pa.int64()), "b": pa.array(nodes[parent[child]], pa.int64())})

    return run


def _bits(value: Column, start: int, width: int) -> Column:
    """``width`` bits from ``start`` (0 is the highest), as the lowest bits of a long."""
    return F.shiftrightunsigned(F.shiftleft(value, start), BITS - width)


def _blocks(start: int, parts: int) -> list[tuple[int, int]]:
    cuts = [start + (BITS - start) * k // parts for k in range(parts + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


def _turn(value: Column, start: int, block: tuple[int, int]) -> Column:
    """Keep the bits before ``start``, then put ``block`` in front of the others."""
    at, width = block
    pieces = [(0, start), (at, width), (start, at - start), (at + width, BITS - at - width)]
    out, left = F.lit(0).cast("long"), BITS
    for a, w in pieces:
        if w:
            left -= w
            out = out.bitwiseOR(F.shiftleft(_bits(value, a, w), left))
    return out


def links(prints: DataFrame, count: int, budget: int, hot: int, sign_budget: int = -1, task_rows: int = 1 << 18) -> DataFrame:
    """Spanning links (a, b) among the nodes of ``prints``: node, family (prints are held against
    those of their family), print, sign. If ``sign_budget`` is not negative, the signs of linked
    nodes differ in at most so many bits as well."""
    ways_each = budget + 1

    def dealt(df: DataFrame, start: int, kind: Column) -> DataFrame:
        ways = [F.struct((kind * (ways_each + 1) + k + 1).cast("int").alias("kind"), F.lit(b[1] + start).alias("depth"), _turn(F.col("turned"), start, b).alias("turned")) for k, b in enumerate(_blocks(start, ways_each))]
        out = df.select("node", "sign", F.explode(F.array(*ways)).alias("way")).select("node", "sign", "way.*")
        return out.withColumn("head", F.expr(f"shiftrightunsigned(turned, {BITS} - depth)"))

    first = dealt(prints.withColumn("turned", F.col("print")), 0, F.col("family"))
    crowded = materialize(first.groupBy("kind", "head").count().where(F.col("count") > hot).select("kind", "head", F.lit(True).alias("hot")), "crowded")
    columns = ["kind", "depth", "turned", "node", "sign", "head"]
    if crowded.isEmpty():
        every = first.select(*columns)
    else:
        first = materialize(first, "blocks")
        marked = first.join(crowded, ["kind", "head"], "left")
        every = marked.where("hot is null").select(*columns)
        for k, (_, width) in enumerate(_blocks(0, ways_each)):
            again = marked.where(F.col("hot") & (F.col("kind") % (ways_each + 1) == k + 1))
            every = every.unionByName(dealt(again, width, F.col("kind") + 1_000_000).select(*columns))
    n = pieces_for(count * ways_each, task_rows, max(8, int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    return every.repartition(n, "kind", "head").mapInArrow(_linking(budget, sign_budget), "a long, b long")


def simhash_dedup(docs: DataFrame, shingle: int = 5, budget: int = 2, id_col: str = "doc_id", text_col: str = "text", hot: int = 50_000) -> DataFrame:
    """id, ``fingerprint`` (16 hexadecimal digits) and ``component_id`` of every row."""
    bounded_batches(docs.sparkSession)
    given = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    rows = materialize(given.mapInArrow(_fingerprints(shingle), "id long, print long"), "prints")
    nodes = materialize(rows.groupBy(F.col("print").alias("node")).agg(F.coalesce(F.min("id"), F.lit(NO_ID)).alias("rank")), "nodes")
    prints = nodes.select("node", F.lit(0).alias("family"), F.col("node").alias("print"), F.lit(None).cast("binary").alias("sign"))
    edges = materialize(links(prints, nodes.count(), budget, hot), "edges")
    labels = connected_components(nodes, materialize(contracted(edges), "forest"))
    whole = materialize(nodes.join(labels, "node", "left").select("node", F.coalesce("least", "rank").alias("least")), "components")
    return rows.join(whole, F.col("print") == F.col("node"), "left").select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), F.nullif("least", F.lit(NO_ID)).alias("component_id"))


# ---------------------------------------------------------------------------------- similarity

#: Texts meet if all minima of one band agree. At a Jaccard similarity of 0.8 all bands fail for
#: (1 - 0.8 ** 8) ** 64 = 8e-6 of the pairs, whatever the edits are.
BANDS, BAND_ROWS = 64, 8
_ODD = np.random.default_rng(64).integers(0, 1 << 32, (BANDS * BAND_ROWS, 1), np.uint32) | np.uint32(1)


class WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def shingles(text: bytes | None, shingle: int, known: WordHash) -> np.ndarray:
    """Hashes of the set of shingles, ascending. A text without words has one, 0; one of fewer words
    than the shingle is one shingle."""
    words = (text or b"").lower().split()
    hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    rolled = np.zeros(max(1, len(words) - shingle + 1), np.uint64)
    for k in range(min(shingle, len(words))):
        rolled = (rolled + hashes[k : k + len(rolled)]) * np.uint64(0x9E3779B97F4A7C15)
        rolled ^= rolled >> np.uint64(31)
    return np.unique(rolled)


def minima(hashes: np.ndarray) -> np.ndarray:
    """A byte of each of the minima of the shingles under ``BANDS * BAND_ROWS`` permutations: the
    share of equal bytes of two sets estimates their Jaccard similarity."""
    x = (hashes >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(_ODD), 0xFFFFFFFF, np.uint32)
    for k in range(0, len(x), 512):
        np.minimum(least, (_ODD * x[k : k + 512]).min(axis=1), out=least)
    return ((least * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8)


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """A key for each band, of its ``BAND_ROWS`` bytes."""
    keys = (minima(hashes).view(np.uint64) + np.arange(1, BANDS + 1, dtype=np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
    return (keys ^ (keys >> np.uint64(29))).view(np.int64)


def _banding(shingle: int):
    def run(batches):
        known = WordHash()
        for batch in batches:
            text = batch.column("text").cast(pa.large_binary())
            sizes = pc.fill_null(pc.binary_length(text), 0).to_numpy()
            sets = (shingles(t, shingle, known) for a, b in slices(batch, sizes) for t in text.slice(a, b - a).to_pylist())
            done = [(len(s), majority(s), band_keys(s)) for s in sets]
            prints = np.array([p for _, p, _ in done], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("node"), pa.array([n for n, *_ in done], pa.int64()), pa.array(prints), pa.array([k for *_, k in done], pa.list_(pa.int64()))], ["id", "node", "size", "print", "keys"])

    return run


def alike(a: np.ndarray, b: np.ndarray, similarity: float) -> bool:
    """Whether the Jaccard similarity of two sets of shingles is ``similarity`` or more."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) >= similarity


def _signing(shingle: int):
    def run(batches):
        known = WordHash()
        for batch in batches:
            signs = [minima(shingles(t.as_py(), shingle, known)).tobytes() for t in batch.column("text").cast(pa.large_binary())]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(signs, pa.binary())], ["node", "sign"])

    return run


def meeting(band, node, size, label, sign, similarity: float):
    """Yield arrays (i, j) of places in one group of a band: pairs apart in ``label`` that meet in no
    earlier band, without those whose sizes, or minima by 5.5 standard deviations, are below ``similarity``."""
    least = BANDS * BAND_ROWS * (similarity - 5.5 * (similarity * (1 - similarity) / (BANDS * BAND_ROWS)) ** 0.5)
    words = sign.view(np.uint64)
    for i in range(len(node)):
        j = np.flatnonzero((node > node[i]) & (label != label[i]) & (np.minimum(size, size[i]) / np.maximum(size, size[i]) >= similarity))
        for k in range(0, len(j), 4096):
            part = j[k : k + 4096]
            part = part[(words[part] == words[i]).argmax(axis=1) == band[i]]
            part = part[(sign[part] == sign[i]).sum(axis=1) >= least]
            yield np.full(len(part), i), part


def _meeting(similarity: float):
    def run(batches):
        tables = [pa.Table.from_batches([b]) for b in batches if b.num_rows]
        if not tables:
            return
        table = pa.concat_tables(tables)
        table = table.take(pc.sort_indices(table, sort_keys=[("key", "ascending")]))
        key, band, node, size, label = (table.column(c).to_numpy() for c in ("key", "band", "node", "size", "label"))
        sign = np.frombuffer(b"".join(table.column("sign").to_pylist()), np.uint8).reshape(len(key), -1)
        edges = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1], [True])))
        for start, end in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            at = slice(start, end)
            for i, j in meeting(band[at], node[at], size[at], label[at], sign[at], similarity):
                if len(i):
                    yield pa.RecordBatch.from_pydict({"a": pa.array(node[at][i]), "b": pa.array(node[at][j])})

    return run


def _confirming(shingle: int, similarity: float):
    def run(batches):
        known, at, one = WordHash(), None, None
        for batch in batches:
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            text_a, text_b = (batch.column(c).cast(pa.large_binary()) for c in ("text_a", "text_b"))
            near = []
            for i, node in enumerate(a):
                if node != at:
                    at, one = node, shingles(text_a[i].as_py(), shingle, known)
                if alike(one, shingles(text_b[i].as_py(), shingle, known), similarity):
                    near.append(i)
            yield pa.RecordBatch.from_pydict({"a": pa.array([a[i] for i in near], pa.int64()), "b": pa.array([b[i] for i in near], pa.int64())})

    return run


def lower_text(text_col: str) -> Column:
    return F.lower(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))


def text_key(text_col: str) -> Column:
    return F.xxhash64(lower_text(text_col), F.octet_length(lower_text(text_col)))


def trie_candidates(nodes: DataFrame, budget: int, hot: int) -> DataFrame:
    """Pairs (a, b) of nodes with fingerprints at ``budget`` or fewer differing bits, by the trie join: the
    spanning forest of its links, and each node of a fingerprint that repeats against the least one."""
    prints = materialize(nodes.groupBy("print").agg(F.min("node").alias("node"), F.max("node").alias("last")), "prints")
    apart = prints.select("node", F.lit(0).alias("family"), "print", F.lit(None).cast("binary").alias("sign"))
    found = materialize(links(apart, prints.count(), budget, hot), "links")
    same = nodes.join(prints.where("node < last").select("print", F.col("node").alias("b")), "print").where("b <> node").select(F.col("node").alias("a"), "b")
    return materialize(contracted(found, 256).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).unionByName(same), "tried")


def near_duplicates(docs: DataFrame, shingle: int = 5, similarity: float = 0.8, budget: int = 3, hot: int = 50_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ``component_id``, ``text_key`` (a hash of the lower-case text) and ``least_key`` (that of the
    component's smallest id), where texts are linked whose sets of ``shingle``-word shingles have a
    Jaccard similarity of ``similarity`` or more: that of each pair linked is computed from the texts.

    The trie join comes first: it gives as candidates what has SimHash fingerprints of the same shingles
    at ``budget`` or fewer differing bits, and those that the exact similarity confirms are linked. At 0.8 a
    pair differs in about ten bits, too many to search for, so beside it candidates are texts that meet
    in a band of minima (see ``BANDS``) and that the trie join has not brought into one component. First
    each is held against the least and the greatest node of every band it is in, which links most of a
    large group by as many pairs as it has texts; then all pairs that meet and are not yet in one
    component, but for those that the share of equal minima tells to be far below (see ``meeting``)."""
    bounded_batches(docs.sparkSession, 256)
    text = lower_text(text_col)
    given = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), text_key(text_col).alias("node"), text.alias("text"))
    rows = materialize(given.mapInArrow(_banding(shingle), "id long, node long, size long, print long, keys array<long>"), "bands")
    nodes = materialize(rows.groupBy("node").agg(F.coalesce(F.min("id"), F.lit(NO_ID)).alias("rank"), F.first("size").alias("size"), F.first("print").alias("print"), F.first("keys").alias("keys")), "nodes")
    ranks = nodes.select("node", "rank")
    tried = trie_candidates(nodes.select("node", "print"), budget, hot)
    each = nodes.select("node", F.posexplode("keys").alias("band", "key"))
    shared = materialize(each.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high").select("key"), "shared")
    met = materialize(each.join(shared, "key", "left_semi"), "met")
    wanted = met.select("node").union(tried.select("a")).union(tried.select("b")).distinct()
    texts = materialize(given.join(wanted, "node", "left_semi").groupBy("node").agg(F.first("text").alias("text")), "texts")

    def fit(a: str, b: str) -> Column:
        return F.least(a, b) / F.greatest(a, b) >= similarity

    def confirmed(pairs: DataFrame, tag: str) -> DataFrame:
        whole = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b").join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
        return materialize(whole.select("a", "b", "text_a", "text_b").mapInArrow(_confirming(shingle, similarity), "a long, b long"), tag)

    def labelled(edges: DataFrame) -> DataFrame:
        labels = component_labels(ranks, materialize(contracted(edges), "forest")).select("node", F.col("label.node").alias("label"))
        return met.join(nodes.select("node", "size").join(labels, "node", "left").select("node", "size", F.coalesce("label", "node").alias("label")), "node")

    trie_edges = confirmed(tried, "trie-edges")
    begun = materialize(labelled(trie_edges), "begun")
    end = F.struct("node", "size", "label")
    ends = materialize(begun.groupBy("key").agg(F.min(end).alias("low"), F.max(end).alias("high"), F.min("label").alias("least"), F.max("label").alias("most")).where("least < most").select("key", "low", "high"), "ends")
    centre = ends.select("key", F.explode(F.array("low", "high")).alias("centre"))
    tested = begun.join(centre, "key").where((F.col("label") != F.col("centre.label")) & fit("size", "centre.size"))
    tested = materialize(tested.select(F.col("centre.node").alias("a"), F.col("node").alias("b")).distinct(), "tested")
    edges = trie_edges.union(confirmed(tested, "edges"))
    now = labelled(edges).select("key", "band", "node", "size", "label")
    mixed = now.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("key")
    now = materialize(now.join(mixed, "key", "left_semi"), "apart")
    signs = texts.join(now.select("node").distinct(), "node", "left_semi").select("node", "text").mapInArrow(_signing(shingle), "node long, sign binary")
    n = pieces_for(now.count(), 1 << 15, max(8, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    rest = now.join(materialize(signs, "signs"), "node").repartition(n, "key").mapInArrow(_meeting(similarity), "a long, b long")
    done = tested.union(tried).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    more = confirmed(materialize(rest.distinct().join(done, ["a", "b"], "left_anti"), "rest"), "edges")
    labels = component_labels(ranks, materialize(contracted(edges.union(more)), "forest"))
    whole = materialize(ranks.join(labels, "node", "left").select("node", F.coalesce("label", F.struct("rank", "node")).alias("least")), "components")
    return rows.select("id", "node").join(whole, "node", "left").select(F.col("id").alias(id_col), F.nullif("least.rank", F.lit(NO_ID)).alias("component_id"), F.col("node").alias("text_key"), F.col("least.node").alias("least_key"))


def op4_simhash_dedup(spark, sf_dir: str) -> DataFrame:
    """Fingerprints and components of all ``documents``, from shingles of three words."""
    return simhash_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"), shingle=3)
