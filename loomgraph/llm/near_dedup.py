"""MinHash near-duplicate detection with bottom-k sketches from one hash function.

1. Every document becomes the set of its hashed word shingles; documents with equal sets form one class.
2. The k smallest hashes of a class are its bottom-k sketch. The inverted lists of retained values generate overlaps.
   Two sets of Jaccard similarity t or more share at least s of k retained values (s is the binomial tail at
   ``miss``), so of each sketch only the rarest ``k - s + 1`` values need lists: what two such sketches share cannot
   all lie in the common rest. A passage that many documents quote is thus skipped without a cap.
3. Candidates are filtered by set size and by the union sketch: the share of the k smallest values of both sketches
   together that lie in both.
4. Survivors are verified by the exact Jaccard similarity of the full shingle sets.

Lists that hold large groups of near copies are not expanded into all pairs. Each list has a hub, its most central
member; every member is compared with the hubs of its lists, and verified links contract components. What is left are
pairs of different components, found exactly in two more passes, each of which verifies its pairs and contracts what is
new once:

* Each member stays with its highest hub. Let C be that hub's set and what half of the hub's members have beside it. Two
  members x, y of one hub that share c hashes outside C have at most min(i_x, i_y) + c in common, where i is what each
  has in common with C; this holds for any C. As |x & y| >= t |x|, x needs c >= t |x| - i_x. So the prefix filter holds
  for what is outside C: only the rarest ``outside - needed + 1`` hashes of a member need lists. Members with many edits
  of their own, which nobody shares, have none. The lists are joined with their hubs first, then in full.
* Pairs without a common hash outside C have |C| less what either lacks in common. If that is enough already, one member
  of the hub, the heaviest, is linked with both; else they lack so many hashes of C both that the prefix filter holds for
  what members lack, with the number that the pair needs.
* Members of one list with different hubs: the list's next hub first, then those outside its dominant hub with the list.

Components are contracted over what is already known: a pass runs the star algorithm on links between components only.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomgraph.llm.batches import Memo, held, small_batches
from loomgraph.operators.components import connected_components
from loomgraph.plans.scratch import cut, discard, release, short_shuffles, stored


@dataclass(frozen=True)
class NearDup:
    """Similarity is num/den or more; ``miss`` bounds the chance that a qualifying pair shares too few retained values.
    With ``k`` None sketches are whole sets: no pair is missed, for more and longer lists."""

    shingle: int = 5
    num: int = 80
    den: int = 100
    k: int | None = 64
    miss: float = 1e-10

    @property
    def most(self) -> int:
        """Values that a sketch holds at most."""
        return self.k or (1 << 31) - 1

    def shared(self) -> int:
        """The largest s with P(Binomial(k, num/den) < s) <= miss."""
        if self.k is None:
            return 1
        t, tail, s = self.num / self.den, 0.0, 0
        while (tail := tail + comb(self.k, s) * t**s * (1 - t) ** (self.k - s)) <= self.miss:
            s += 1
        return max(1, s)


class Shingler:
    """Sorted distinct 64-bit shingle hashes of texts."""

    def __init__(self, width: int):
        self.width, self.memo = width, Memo(xxhash.xxh3_64_intdigest, 100_000)

    def __call__(self, text: bytes | None) -> np.ndarray:
        words = (text or b"").lower().split()  # bytes: lower() takes A-Z only, split() takes \x20 \x09-\x0D only
        if not words:
            return np.empty(0, np.int64)
        ids = np.fromiter(map(self.memo.__getitem__, words), np.uint64, len(words))
        width = min(self.width, len(ids))
        out = np.full(len(ids) - width + 1, width, np.uint64)
        for i in range(width):
            out = _stirred(out * np.uint64(0x9E3779B97F4A7C15) + ids[i : len(ids) - width + 1 + i])
        return np.unique(out.view(np.int64))


@held
def shingler(width: int) -> Shingler:
    return Shingler(width)


def _stirred(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: shifts and odd multipliers."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _texts(docs: DataFrame) -> DataFrame:
    """doc_id, text as bytes. A batch ends at a number of rows or bytes."""
    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))


def _digest(hashes: np.ndarray) -> bytes | None:
    return xxhash.xxh3_128_digest(hashes.tobytes()) if len(hashes) else None


def sketches(docs: DataFrame, p: NearDup, by_text: bool = False) -> DataFrame:
    """doc_id, text_md5 (null unless by_text), n_shingles, fp (128-bit digest of the whole set; null if empty), sketch (k smallest hashes)."""

    def run(batches):
        make = shingler(p.shingle)
        for b in batches:
            n, fp, sketch = [], [], []
            for t in b.column(1):
                hashes = make(t.as_py())
                n.append(len(hashes))
                fp.append(_digest(hashes))
                sketch.append(hashes[: p.k].copy())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array(n, pa.int64()), pa.array(fp, pa.binary()), pa.array(sketch, pa.list_(pa.int64()))], names=["doc_id", "text_md5", "n_shingles", "fp", "sketch"]
            )

    md5 = F.unhex(F.md5("text")) if by_text else F.lit(None).cast("binary")
    return _texts(docs).select("doc_id", "text", md5.alias("text_md5")).mapInArrow(run, "doc_id long, text_md5 binary, n_shingles long, fp binary, sketch array<long>")


def full_sets(docs: DataFrame, nodes: DataFrame, p: NearDup) -> DataFrame:
    """rep, full (the sorted hashes of the whole shingle set, as bytes) of nodes (rep, doc_id, fp). A doc_id that comes with
    several texts stands for the one that has the node's digest; where it comes with that text again, rows repeat."""

    def run(batches):
        make = shingler(p.shingle)
        for b in batches:
            reps, sets = [], []
            for rep, text, fp in zip(b.column(0), b.column(1), b.column(2)):
                hashes = make(text.as_py())
                if _digest(hashes) == fp.as_py():
                    reps.append(rep.as_py())
                    sets.append(hashes.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(reps, pa.int64()), pa.array(sets, pa.binary())], names=["rep", "full"])

    return _texts(docs).join(nodes.select("doc_id", "rep", "fp"), "doc_id").select("rep", "text", "fp").mapInArrow(run, "rep long, full binary")


def _prefix_length(p: NearDup, n: Column) -> Column:
    """How many of a sketch's rarest values need lists. Sets of up to k * num / den values meet only whole sets, so
    there the overlap bound of the sets themselves holds."""
    whole = n - F.ceil(n * p.num / p.den) + 1
    return F.when(n * p.den <= p.most * p.num, whole).otherwise(F.least(n, F.lit(p.most)) - p.shared() + 1)


def rare_lists(nodes: DataFrame, p: NearDup) -> DataFrame:
    """(v, rep, score): inverted lists of the rarest retained values, of values that two classes or more retain. The score
    of a class is the mean number of classes that retain a value of its sketch: near copies of one text have the highest
    where they have the fewest edits."""
    retained = nodes.select("rep", "n", F.explode("sketch").alias("v"))
    counts = retained.groupBy("v").agg(F.count("*").alias("c")).where("c > 1")
    shared = retained.join(counts, "v")
    w = Window.partitionBy("rep")
    ranked = shared.withColumn("lone", F.least("n", F.lit(p.most)) - F.count("*").over(w)).withColumn("r", F.row_number().over(w.orderBy("c", "v")))
    ranked = ranked.withColumn("score", (F.sum("c").over(w) + F.col("lone")) / F.least("n", F.lit(p.most)))
    return ranked.where(F.col("r") <= _prefix_length(p, F.col("n")) - F.col("lone")).select("v", "rep", "score")


def _filtered(pairs: DataFrame, nodes: DataFrame, p: NearDup, loose: bool = False) -> DataFrame:
    """Pairs (a, b) whose set sizes and union-sketch estimate allow the similarity; loose: about a third of it."""
    num, least = (p.num / 2.5, p.most // 4) if loose else (p.num, p.shared())
    side = lambda c: nodes.select(F.col("rep").alias(c), F.col("n").alias(f"n_{c}"), F.col("sketch").alias(f"s_{c}"))
    met = pairs.join(side("a"), "a").join(side("b"), "b").where(F.least("n_a", "n_b") * p.den >= F.greatest("n_a", "n_b") * num)
    union = F.slice(F.array_sort(F.array_union("s_a", "s_b")), 1, p.most)
    common = F.size(F.array_intersect(F.array_intersect("s_a", "s_b"), union))
    whole = F.greatest("n_a", "n_b") <= p.most  # then the sketches are the sets
    exact = F.size(F.array_intersect("s_a", "s_b")) * p.den >= F.size(F.array_union("s_a", "s_b")) * num
    return met.where(F.when(whole, exact).otherwise(common >= least)).select(*pairs.columns)


def _compared(pairs: DataFrame, sets: DataFrame, rest: bool) -> DataFrame:
    """Pairs (a, b, score) with n_a, n_b, i (hashes in common) and, if asked for, rest and gone: the hashes that only a or only b has."""

    def run(batches):
        for x in batches:
            rows = []
            for left, right in zip(x.column(3), x.column(4)):
                left, right = np.frombuffer(left.as_buffer(), np.int64), np.frombuffer(right.as_buffer(), np.int64)
                hit = right[np.minimum(np.searchsorted(right, left), len(right) - 1)] == left if len(right) else np.zeros(len(left), bool)
                rows.append((len(left), len(right), int(hit.sum()), *((left[~hit], np.setdiff1d(right, left, assume_unique=True)) if rest else (None, None))))
            kinds = [pa.int64()] * 3 + [pa.list_(pa.int64())] * 2
            yield pa.RecordBatch.from_arrays([x.column(0), x.column(1), x.column(2), *(pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds))], names=["a", "b", "score", "n_a", "n_b", "i", "rest", "gone"])

    both = pairs.join(sets.select(F.col("rep").alias("a"), F.col("full").alias("fa")), "a").join(sets.select(F.col("rep").alias("b"), F.col("full").alias("fb")), "b")
    return both.select("a", "b", "score", "fa", "fb").mapInArrow(run, "a long, b long, score double, n_a long, n_b long, i long, rest array<long>, gone array<long>")


def _linked(p: NearDup):
    return F.expr(f"i > 0 and {p.den} * i >= {p.num} * (n_a + n_b - i)")


class _Links:
    """The components of listed nodes, as far as verified links have joined them."""

    def __init__(self, nodes: DataFrame, sets: DataFrame, listed: DataFrame, p: NearDup):
        self.nodes, self.sets, self.p = nodes, sets, p
        self.labels = listed.select("rep", F.col("rep").alias("c"))

    def marked(self, rows: DataFrame, name: str = "c", of: str = "rep") -> DataFrame:
        return rows.join(self.labels.select(F.col("rep").alias(of), F.col("c").alias(name)), of)

    def join(self, links: DataFrame) -> None:
        """Joins the components of linked nodes (a, b); only links between components enter the contraction."""
        between = self.marked(self.marked(links.select("a", "b"), "u", "a"), "v", "b").where("u <> v").select("u", "v")
        parts = connected_components(between)
        moved = self.labels.join(parts.select(F.col("node").alias("c"), "component"), "c", "left")
        self.labels = cut(moved.select("rep", F.coalesce("component", "c").alias("c")))
        release(self.labels.sparkSession)

    def by_sets(self, pairs: DataFrame) -> DataFrame:
        """The links among pairs (x, y), after the size and sketch filters, by their full sets."""
        return _compared(_filtered(_ordered(pairs), self.nodes, self.p).withColumn("score", F.lit(0.0)), self.sets, False).where(_linked(self.p)).select("a", "b")

    def by_deltas(self, pairs: DataFrame, deltas: DataFrame) -> DataFrame:
        """The links among pairs (x, y) of one hub. Deltas hold what each has beside the hub's set and lacks of it: that
        gives the exact overlap without moving whole sets."""
        side = lambda c: deltas.select(F.col("rep").alias(c), F.col("n").alias(f"n_{c}"), F.col("rest").alias(f"r_{c}"), F.col("gone").alias(f"g_{c}"), F.col("n_h").alias(f"h_{c}"))
        met = _ordered(pairs).join(side("a"), "a").join(side("b"), "b").withColumn("i", F.col("h_a") - F.size(F.array_union("g_a", "g_b")) + F.size(F.array_intersect("r_a", "r_b")))
        return met.where(_linked(self.p)).select("a", "b")


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _mixed(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows of groups that hold several components c."""
    open_ = rows.groupBy(*keys).agg(F.min("c").alias("_lo"), F.max("c").alias("_hi")).where("_lo < _hi").select(*keys)
    return rows.join(open_, [*keys], "left_semi")


def _outside(group: DataFrame, p: NearDup) -> tuple[DataFrame, DataFrame]:
    """Of the members (h, rep, n, n_h, i, rest, gone, c) of open hubs: those with enough in C to be linked by it alone,
    (h, rep, n_c, w, lacks), and the lists (h, e, rep, size) of the rarest hashes outside C that each member needs; size is
    that of the member's rest. n_c is the size of C, lacks what a member has not of it, w its weight, see :func:`_lacking`."""
    each = group.select("h", "rep", "n", "i", "c", F.size("rest").alias("size"), F.explode("rest").alias("e"))
    kinds = each.groupBy("h", "e").agg(F.count("*").alias("d"), F.min("c").alias("lo"), F.max("c").alias("hi"))
    kinds = kinds.join(group.groupBy("h").agg(F.count("*").alias("m")), "h").withColumn("half", F.expr("2 * d >= m")).where("half or lo < hi")
    met = cut(each.drop("c").join(kinds.select("h", "e", "d", "half"), ["h", "e"]))
    # of one hub: no more hashes than twice a member has
    halves = met.where("half").groupBy("h").agg(F.collect_set("e").alias("common"))
    none = F.array().cast("array<long>")
    members = group.join(halves, "h", "left").withColumn("common", F.coalesce("common", none))
    members = members.withColumn("i", F.col("i") + F.size(F.array_intersect("common", "rest"))).where(f"{p.den} * i >= {p.num} * n")
    members = members.select("h", "rep", (F.col("n_h") + F.size("common")).alias("n_c"), F.expr(f"{p.num + p.den} * i - {p.num} * n").alias("w"), F.array_union("gone", F.array_except("common", "rest")).alias("lacks"))
    w = Window.partitionBy("rep")
    rows = met.withColumn("gain", F.count(F.when(F.col("half"), 1)).over(w)).where("not half")
    rows = rows.withColumn("out", F.col("size") - F.col("gain")).withColumn("lone", F.col("out") - F.count("*").over(w)).withColumn("r", F.row_number().over(w.orderBy("d", "e")))
    needed = F.greatest(F.lit(1), F.ceil(F.col("n") * p.num / p.den) - F.col("i") - F.col("gain"))
    return stored(members, "near-members"), cut(rows.where(F.col("r") <= F.col("out") - needed + 1 - F.col("lone")).select("h", "e", "rep", "size"))


def _heaviest(members: DataFrame) -> DataFrame:
    """(h, y, w_y): the member of each hub that is linked for certain with all that any other is."""
    return members.groupBy("h").agg(F.max(F.struct("w", "rep")).alias("t")).select("h", F.col("t.rep").alias("y"), F.col("t.w").alias("w_y"))


def _lacking(members: DataFrame, links: _Links, p: NearDup) -> DataFrame:
    """Pairs (x, y) of one hub, in different components, that may be linked without a common hash outside C.

    They have n_c - g_x - g_y + s hashes of C in common, where g is how many each lacks and s how many both lack. With
    w = (num + den) i - num n for i = n_c - g, that is enough if w_x + w_y + (num + den) s >= (num + den) n_c. So those
    linked for certain (s = 0) are all linked with the heaviest member; others must lack ``need`` hashes both, and then
    share one within the ``g - need + 1`` rarest that each lacks."""
    unit = p.num + p.den
    tops = links.marked(_heaviest(members), "c_y", "y").select("h", "w_y", "c_y")
    open_ = _mixed(links.marked(members), "h").join(tops, "h").withColumn("g", F.size("lacks")).withColumn("apart", F.col("c") != F.col("c_y"))
    need = lambda other: F.greatest(F.lit(1), F.ceil((unit * F.col("n_c") - F.col("w") - F.col(other)) / F.lit(unit)))
    open_ = open_.withColumn("most", F.col("g") - need("w_y") + 1).where("most > 0")
    each = open_.select("h", "rep", "c", "n_c", "w", "g", "most", "apart", F.explode("lacks").alias("e"))
    counts = each.groupBy("h", "e").agg(F.count("*").alias("d"), F.bool_or("apart").alias("any"), F.min("c").alias("lo"), F.max("c").alias("hi"))
    rows = each.join(counts, ["h", "e"]).withColumn("r", F.row_number().over(Window.partitionBy("rep").orderBy("d", "e"))).where("r <= most and any and lo < hi")
    rows = cut(rows.select("h", "e", "rep", "c", "n_c", "w", "g", "r", "apart"))
    left = rows.where("apart").withColumnRenamed("rep", "x").withColumnRenamed("c", "cx")
    right = rows.select("h", "e", F.col("rep").alias("y"), F.col("c").alias("cy"), F.col("w").alias("w_y"), F.col("g").alias("g_y"), F.col("r").alias("r_y"), F.col("apart").alias("apart_y"))
    both = left.join(right, ["h", "e"]).where((F.col("cx") != F.col("cy")) & (~F.col("apart_y") | (F.col("x") < F.col("y"))) & (F.col("g") - F.col("r") + 1 >= need("w_y")) & (F.col("g_y") - F.col("r_y") + 1 >= need("w_y")))
    return both.select("x", "y")


def class_components(docs: DataFrame, nodes: DataFrame, p: NearDup) -> DataFrame:
    """(rep, c) of all nodes that share a list with another; nodes: rep, doc_id, fp, n, sketch."""
    lists = stored(rare_lists(nodes, p), "near-lists")
    listed = lists.select("rep").distinct()
    sets = full_sets(docs, nodes.join(listed, "rep", "left_semi"), p)
    sets = stored(sets.dropDuplicates(["rep"]) if _repeats(docs) else sets, "near-sets")
    links = _Links(nodes, sets, listed, p)
    release(docs.sparkSession)

    # first pass: each member with the hubs of its lists
    hubs = lists.groupBy("v").agg(F.max(F.struct("score", "rep")).alias("hub")).select("v", F.col("hub.rep").alias("b"), F.col("hub.score").alias("score_b"))
    pairs = lists.join(hubs, "v").where("rep <> b").groupBy(F.col("rep").alias("a"), "b").agg(F.max("score_b").alias("score"))
    near = stored(_compared(_filtered(pairs, nodes, p, loose=True), sets, True), "near-hubs")
    release(docs.sparkSession)
    links.join(near.where(_linked(p)))

    # each member with its highest hub: what it shares with it, what it has beside it and lacks of it
    none = F.array().cast("array<long>")
    own = near.groupBy("b").agg(F.max("score").alias("score"), F.first("n_b").alias("n_b"))
    own = own.select(F.col("b").alias("a"), "b", "score", F.col("n_b").alias("n_a"), "n_b", F.col("n_b").alias("i"), none.alias("rest"), none.alias("gone"))
    highest = near.unionByName(own).groupBy("a").agg(F.max_by(F.struct("b", "n_a", "n_b", "i", "rest", "gone"), F.struct("score", "b")).alias("m"))
    hubbed = stored(highest.select(F.col("a").alias("rep"), F.col("m.b").alias("h"), F.col("m.n_a").alias("n"), F.col("m.i").alias("i"), F.col("m.rest").alias("rest"), F.col("m.gone").alias("gone"), F.col("m.n_b").alias("n_h")), "near-hubbed")
    deltas = hubbed.select("rep", "n", "rest", "gone", "n_h")
    members, outside = _outside(_mixed(links.marked(hubbed), "h"), p)

    release(docs.sparkSession)

    # second pass: members still apart with the next hub of their lists, and with the hubs of the lists outside C
    rows = cut(_mixed(links.marked(lists), "v"))
    first = links.marked(hubs.select("v", F.col("b").alias("rep")), "ch").select("v", "ch")
    tops = rows.join(first, "v").where("c <> ch").groupBy("v").agg(F.max(F.struct("score", "rep", "c")).alias("t"))
    by_list = rows.join(tops, "v").where("rep <> t.rep and c <> t.c").select(F.col("rep").alias("x"), F.col("t.rep").alias("y"))
    rest = cut(_mixed(links.marked(outside), "h", "e"))
    tops = rest.groupBy("h", "e").agg(F.min(F.struct("size", "rep", "c")).alias("t"))
    by_rest = rest.join(tops, ["h", "e"]).where("rep <> t.rep and c <> t.c").select(F.col("rep").alias("x"), F.col("t.rep").alias("y"))
    by_weight = members.join(_heaviest(members), "h").where("rep <> y").select(F.col("rep").alias("x"), "y")
    links.join(links.by_sets(by_list).unionByName(links.by_deltas(by_rest.unionByName(by_weight), deltas)))

    release(docs.sparkSession)

    # last pass: what lists outside C leave open, pairs by what both lack of C, and members of one list under different hubs
    rest = cut(_mixed(links.marked(rest.drop("c")).drop("size"), "h", "e"))
    left, right = (rest.select("h", "e", F.col("rep").alias(z), F.col("c").alias("c" + z)) for z in "xy")
    by_rest = left.join(right, ["h", "e"]).where("x < y and cx <> cy").select("x", "y")
    rows = cut(_mixed(links.marked(rows.select("v", "rep")).join(hubbed.select("rep", "h"), "rep", "left"), "v"))
    most = rows.where("h is not null").groupBy("v", "h").agg(F.count("*").alias("m")).groupBy("v").agg(F.max_by("h", F.struct("m", "h")).alias("most"))
    other = rows.join(most, "v", "left").where("not (h <=> most) or h is null").select("v", F.col("rep").alias("x"), F.col("c").alias("cx"), F.col("h").alias("hx"))
    by_list = other.join(rows.select("v", F.col("rep").alias("y"), "c", "h"), "v").where("x <> y and cx <> c and (hx is null or h is null or hx <> h)").select("x", "y")
    links.join(links.by_sets(by_list).unionByName(links.by_deltas(by_rest.unionByName(_lacking(members, links, p)), deltas)))
    discard(lists, sets, near, hubbed, members)  # the labels are cut from them
    return links.labels


def _repeats(docs: DataFrame) -> bool:
    """Whether a doc_id comes more than once."""
    return not docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").isEmpty()


def near_duplicates(docs: DataFrame, params: NearDup = NearDup(), by_text: bool = False) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of docs (columns doc_id, text; others are not read); by_text
    adds text_md5 (binary), which with doc_id tells rows apart where doc_ids repeat.

    component_id is the smallest doc_id reachable over links, itself included; kept says that it is the row's own.
    Null or empty texts and texts without words have no shingles and are linked with nothing. Every row is judged by its
    own text: a doc_id with two texts stands for two documents, a row that comes again has the verdict of the first. A
    null doc_id has a null component_id and is kept, as nothing can stand for it. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    base = stored(sketches(docs, params, by_text), "near-base")
    classes = base.where("fp is not null and doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch"))
    with short_shuffles(spark):
        # a doc_id with two texts stands for two classes, so nodes have numbers of their own
        nodes = stored(classes.withColumn("rep", F.monotonically_increasing_id()), "near-nodes")
        parts = class_components(docs.select("doc_id", "text"), nodes, params)
        found = parts.join(nodes.select("rep", "doc_id", "fp"), "rep")
        lowest = found.groupBy("c").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("m")).where("m > 1")
        named = stored(found.join(lowest, "c").select("fp", "component_id"), "near-named")
    named = nodes.select("fp", "doc_id").join(named, "fp", "left").select("fp", F.coalesce("component_id", "doc_id").alias("component_id"))
    own = ["text_md5"] if by_text else []
    out = base.select("doc_id", *own, "n_shingles", "fp").join(named, "fp", "left")
    cid = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", *own, "n_shingles", cid.alias("component_id"), F.coalesce(F.col("doc_id") == cid, F.lit(True)).alias("kept"))
