"""Near duplicates by bottom-k sketches from one hash function.

1. Each text becomes its set of word shingles (64-bit hashes) and the ``KEPT`` smallest of them, its sketch. Texts with
   equal sets form one class and go on as one node, so exact copies cost nothing further.
2. Inverted lists of retained values: a value's list holds the nodes that retain it. Two linked texts share at least
   ``need`` retained values (exact for small sets; for others missed with a chance below 1e-9 a link), so it is enough
   to list a node under its rarest values, all but ``need - 2`` of them: two of them are in both nodes' lists. Frequent
   values are left out by this without a cap, and the more frequent of the rest are listed two together.
3. The node of a list whose values are the most frequent ones is its centre (a text among its edited copies is), and is
   compared with the rest: a star, linear in the list. Linked nodes get common labels, and then only nodes of
   *different* labels that meet in a list are compared. Nodes of long lists that still have several labels go on with
   their full sets instead of their sketches, where rare shingles and the number of values that can still be shared tell
   them apart: further star rounds with new centres, and what is left pairwise.
4. Pairs whose sizes fit are filtered by the union sketch: of the smallest values of both sketches together, how many
   are in both. What passes is confirmed on full sets, fetched for those nodes only. Components of all links follow.

Nulls, empty texts and texts without words have an empty set, no links and themselves as component. Repeated rows are
exact copies. A null doc_id takes part, and counts after every other id. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.llm import words as W
from tillcast.llm.graph import components
from tillcast.session import stage

#: Values in a sketch, and how many two linked sketches share at least: of 32 values at a similarity of 0.8, 25.6 on
#: average; fewer than 11 with a chance of about 3e-10.
KEPT = 32
SHARED = 11
#: Values of more nodes are listed two together.
SHORT_LIST = 8
#: Longer lists are hot: their nodes are paired by full sets.
HOT_LIST = 64
#: Star rounds of hot lists at most, and the pairs that they may leave for each entry of all lists.
ROUNDS = 4
PAIRS = 4
#: Rows up to which a side of a join is broadcast: long keys, about 40 bytes each.
BROADCAST_ROWS = 500_000

#: Pairs are of nodes and their scores.
_PAIR = ("u", "us", "v", "vs")


def _sets(size: int, full: bool, keyed: bool):
    """Arrow function: (doc_id, text) to sketches, or to full sets; ``keyed``: with digests of the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text")
            for at, part in W.slices(texts):
                sets = list(W.shingle_sets(W.split(part), size))
                shown = sets if full else [s[:KEPT] for s in sets]
                bounds = np.zeros(len(shown) + 1, np.int32)
                np.cumsum([len(s) for s in shown], out=bounds[1:])
                values = np.concatenate(shown) if shown else np.zeros(0, np.uint64)
                values = (values ^ np.uint64(1 << 63)).view(np.int64)  # signed numbers in the same order
                columns = {
                    "doc_id": ids.slice(at, len(part)),
                    "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                    "digest": pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                    "shingles": pa.ListArray.from_arrays(pa.array(bounds), pa.array(values)),
                }
                if keyed:
                    columns["text_digest"] = pa.array([W.digest(text.as_py()) for text in part], pa.binary())
                yield pa.RecordBatch.from_pydict(columns)

    return run


def shingle_table(docs: DataFrame, size: int, full: bool = False, keyed: bool = False) -> DataFrame:
    """doc_id, n_shingles, digest (of the set), shingles: the ``KEPT`` smallest hashes, or all of them; and text_digest
    where rows are ``keyed``."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    schema = "doc_id long, n_shingles long, digest binary, shingles array<long>"
    return W.by_batch(rows, _sets(size, full, keyed), schema + ", text_digest binary" * keyed)


def _is_small(df: DataFrame) -> bool:
    return df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS


def _small(df: DataFrame) -> DataFrame:
    """Marked for broadcast if it has few rows, which is counted."""
    return F.broadcast(df) if _is_small(df) else df


def _shared(entries: DataFrame) -> DataFrame:
    """(node, n, need, score, shared): the values that other nodes have too, rarest first; entries are (node, n, need,
    value).

    Values of one node only meet nothing, and as they are the rarest, what remains of the rarest all-but-need-1 values
    of a node with m shared ones are its m - need + 1 rarest shared ones. The score says how often its values occur in
    all: of a text and its edited copies, the text itself has the highest.
    """
    frequent = entries.groupBy("value").agg(F.count("*").alias("df")).where("df > 1")
    shared = entries.join(frequent, "value").groupBy("node", "n", "need")
    shared = shared.agg(F.sum("df").alias("score"), F.sort_array(F.collect_list(F.struct("df", "value"))).alias("shared"))
    return shared.where(F.size("shared") >= F.col("need"))


def _sketch_lists(entries: DataFrame) -> DataFrame:
    """(value, node, n, rest, score) from sketches.

    Linked nodes that share ``need`` >= 2 values share two of their rarest all-but-need-2 ones. A value of few nodes is
    a list; of the more frequent ones each two together are, so that lists stay short however often a value occurs.
    Nodes of one shingle have no links.
    """
    rarest = _shared(entries.where("need > 1"))
    rarest = rarest.withColumn("r", F.slice("shared", 1, F.size("shared") - F.col("need") + 2))
    rarest = rarest.withColumn("often", F.transform(F.filter("r", lambda x: x["df"] > SHORT_LIST), lambda x: x["value"]))

    def with_later(x, i):
        return F.transform(F.slice("often", i + 2, F.size("often")), lambda y: F.xxhash64(F.least(x, y), F.greatest(x, y)))

    alone = F.transform(F.filter("r", lambda x: x["df"] <= SHORT_LIST), lambda x: x["value"])
    both = F.flatten(F.transform("often", with_later))
    return rarest.select(F.explode(F.concat(alone, both)).alias("value"), "node", "n", F.col("n").alias("rest"), "score")


def _set_lists(entries: DataFrame) -> DataFrame:
    """(value, node, n, rest, score) from full sets; rest: how many of the node's values come from this one on."""
    rarest = F.slice("shared", 1, F.size("shared") - F.col("need") + 1)
    listed = _shared(entries).select("node", "n", "score", F.size("shared").alias("m"), F.posexplode(rarest).alias("at", "e"))
    return listed.select("e.value", "node", "n", (F.col("m") - F.col("at")).cast("long").alias("rest"), "score")


def _fits(a: str, a_rest: str, b: str, b_rest: str, percent: int):
    """Whether sets of these sizes are similar if they share all that is left from this value on: at the first value
    that two linked sets share they still do. With ``rest`` = n it is the bound on sizes."""
    return (100 + percent) * F.least(a_rest, b_rest) >= percent * (F.col(a) + F.col(b))


def _with_centres(lists: DataFrame, percent: int) -> DataFrame:
    """The lists less their centres, the nodes of the highest score, which stand beside every other entry as u; entries
    that cannot be similar even to the smallest set of their list go."""
    columns = "score", "node", "n", "rest", "label"
    best = lists.groupBy("value").agg(F.max(F.struct(*columns)).alias("c"), F.min("n").alias("least"))
    centres = best.select("value", "least", *(F.col(f"c.{name}").alias(f"u_{name}") for name in columns))
    return lists.join(centres, "value").where("node != u_node").where(_fits("n", "rest", "least", "rest", percent))


def _stars(centred: DataFrame, percent: int) -> DataFrame:
    """Pairs of centres with the entries of their lists, if not known to be connected: linear in the lists."""
    pairs = centred.where("label != u_label").where(_fits("n", "rest", "u_n", "u_rest", percent))
    pairs = pairs.select("u_node", "u_score", "node", "score").distinct()
    return pairs.select(F.col("u_node").alias("u"), F.col("u_score").alias("us"), F.col("node").alias("v"), F.col("score").alias("vs"))


def _labels(links: DataFrame) -> DataFrame:
    """(node, label) of linked nodes: a node that it is connected with. Each node points to the linked one of the highest
    score above its own, and goes three such steps at most; copies of one text get the text, or nearly all do."""
    up = F.struct(F.col("us").alias("score"), F.col("u").alias("node"))
    down = F.struct(F.col("vs").alias("score"), F.col("v").alias("node"))
    pointers = links.select(F.greatest(up, down).alias("up"), F.least(up, down)["node"].alias("node"))
    pointers = stage(pointers.groupBy("node").agg(F.max("up")["node"].alias("label")), "pointers")
    further = pointers.select(F.col("node").alias("at"), F.col("label").alias("next"))
    out = pointers
    for _ in range(2):
        out = out.join(further, F.col("label") == F.col("at"), "left")
        out = out.select("node", F.coalesce("next", "label").alias("label"))
    return stage(out, "labels")


def _labelled(lists: DataFrame, labels: DataFrame) -> DataFrame:
    lists = lists.select("value", "node", "n", "rest", "score")
    return lists.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))


def _open(lists: DataFrame) -> DataFrame:
    """Lists whose nodes have several labels, with their length and the number of pairs of nodes of different labels."""
    own = lists.groupBy("value", "label").agg(F.count("*").alias("c")).groupBy("value")
    own = own.agg(F.sum("c").alias("long"), F.sum(F.col("c") * F.col("c")).alias("same"), F.count("*").alias("labels"))
    cross = ((F.col("long") * F.col("long") - F.col("same")) / 2).cast("long").alias("cross")
    return lists.join(own.where("labels > 1").select("value", "long", cross), "value")


def _across(lists: DataFrame, percent: int) -> DataFrame:
    """Pairs that meet in a list and have different labels."""
    columns = "node", "n", "rest", "score", "label"
    a = lists.select("value", *(F.col(c).alias(f"u_{c}") for c in columns))
    b = lists.select("value", *(F.col(c).alias(f"v_{c}") for c in columns))
    on = (a["value"] == b["value"]) & (F.col("u_node") < F.col("v_node")) & (F.col("u_label") != F.col("v_label"))
    pairs = a.join(b, on & _fits("u_n", "u_rest", "v_n", "v_rest", percent))
    names = {"u": "u_node", "us": "u_score", "v": "v_node", "vs": "v_score"}
    return pairs.select(*(F.col(c).alias(name) for name, c in names.items())).distinct()


def _similar_sketches(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs that agree in enough of the smallest values of both sketches."""
    u = nodes.select(F.col("node").alias("u"), F.col("shingles").alias("a"), F.col("need").alias("un"))
    v = nodes.select(F.col("node").alias("v"), F.col("shingles").alias("b"), F.col("need").alias("vn"))
    union = F.slice(F.array_sort(F.array_union("a", "b")), 1, KEPT)
    both = F.size(F.array_intersect(F.array_intersect("a", "b"), union))
    # A sketch that is its whole set has nothing beyond it, so both needs hold for the union's smallest values too.
    enough = both >= F.least("un", "vn", F.lit(SHARED))
    return pairs.join(u, "u").join(v, "v").where(enough).select(*_PAIR)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets are similar."""
    a = sets.select(F.col("node").alias("u"), F.col("shingles").alias("a"))
    b = sets.select(F.col("node").alias("v"), F.col("shingles").alias("b"))
    inter = F.size(F.array_intersect("a", "b"))
    union = F.size("a") + F.size("b") - inter
    return pairs.join(a, "u").join(b, "v").where(100 * inter >= percent * union).select(*_PAIR)


def _nodes_of(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("u", "v")).alias("node"))


def _full_sets(wanted: DataFrame, nodes: DataFrame, docs: DataFrame, size: int) -> DataFrame:
    """(node, n, shingles) of the wanted nodes, made again from the text of each one's first document, written."""
    known = nodes.join(wanted.distinct(), "node", "left_semi").select("node", "first_id", "digest", "n")
    known = stage(known, "wanted")
    ids = known.select(F.col("first_id").alias("doc_id")).distinct()
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    same = texts["doc_id"].eqNullSafe(ids["doc_id"])
    sets = shingle_table(texts.join(_small(ids), same, "left_semi"), size, full=True)
    made = sets.join(known, (sets["digest"] == known["digest"]) & sets["doc_id"].eqNullSafe(known["first_id"]))
    return stage(made.select("node", "n", "shingles").dropDuplicates(["node"]), "sets")


def _hot_links(hot: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links among hot nodes by their full sets: star rounds, each with the best centre that a list has not had, while
    they find links and lists leave more pairs than ``PAIRS`` times the entries; then all pairs of different labels
    whose sizes and rare values fit. How many rounds there are decides on the work, not on the result."""
    sets = sets.join(hot, "node", "left_semi")
    whole = F.ceil(F.col("n") * percent / 100).cast("int").alias("need")
    lists = stage(_set_lists(sets.select("node", "n", whole, F.explode("shingles").alias("value"))), "hot-lists")
    entries = lists.count()
    lists = lists.withColumn("label", F.col("node"))
    links = None
    for _ in range(ROUNDS):
        centred = stage(_with_centres(lists, percent), "centred")
        found = stage(_confirmed(_stars(centred, percent), sets, percent), "links")
        links = found if links is None else links.unionByName(found)
        lists = stage(_open(_labelled(centred, _labels(links))), "hot-open")
        pairs = lists.agg(F.sum(F.col("cross") / F.col("long"))).first()[0] or 0
        if pairs <= PAIRS * entries or not found.limit(1).count():
            break
    return links.unionByName(stage(_confirmed(_across(lists, percent), sets, percent), "links"))


def _components(docs: DataFrame, size: int, percent: int, keyed: bool = False) -> tuple[DataFrame, DataFrame]:
    """The staged sketches of the rows, and (digest, root, component_id) of every set that is not empty: components
    have different roots, also where they share their smallest doc_id."""
    if not 80 <= percent <= 100:
        raise ValueError("percent must be between 80 and 100, which the size of the sketches is made for")
    sketched = stage(shingle_table(docs, size, keyed=keyed), "sketches")
    classes = sketched.where("n_shingles > 0").groupBy("digest")
    classes = classes.agg(
        F.min("doc_id").alias("first_id"), F.any_value("n_shingles").alias("n"), F.any_value("shingles").alias("shingles")
    )
    # A set whose links all lie within sketches shares percent % of itself; larger ones share SHARED values.
    own = F.ceil(F.col("n") * percent / 100).cast("int")
    need = F.when(F.col("n") <= math.floor(KEPT * percent / 100), own).otherwise(SHARED)
    nodes = stage(classes.withColumn("need", need).withColumn("node", F.monotonically_increasing_id()), "nodes")

    entries = nodes.select("node", "n", "need", F.explode("shingles").alias("value"))
    lists = stage(_sketch_lists(entries), "lists")
    stars = _stars(_with_centres(lists.withColumn("label", F.col("node")), percent), percent)
    pairs = stage(_similar_sketches(stars, nodes), "pairs")
    links = stage(_confirmed(pairs, _full_sets(_nodes_of(pairs), nodes, docs, size), percent), "links")

    left = stage(_open(_labelled(lists, _labels(links))), "open")
    pairs = stage(_similar_sketches(_across(left.where(F.col("long") <= HOT_LIST), percent), nodes), "pairs")
    hot = stage(left.where(F.col("long") > HOT_LIST).select("node").distinct(), "hot")
    sets = _full_sets(_nodes_of(pairs).unionByName(hot), nodes, docs, size)
    links = links.unionByName(stage(_confirmed(pairs, sets, percent), "links"))
    if hot.limit(1).count():
        links = links.unionByName(_hot_links(hot, sets, percent))
    roots = components(links.select("u", "v"))

    placed = nodes.select("node", "digest", "first_id").join(roots, "node", "left")
    placed = placed.withColumn("root", F.coalesce("root", "node"))
    smallest = placed.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return sketched, placed.join(smallest, "root").select("digest", "root", "component_id")


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id of its component) and kept (doc_id = component_id), one row
    per row of ``docs`` (doc_id, text): texts whose sets of ``size``-word shingles have a similarity of at least
    ``percent`` % are linked."""
    sketched, found = _components(docs, size, percent)
    rows = sketched.select("doc_id", "n_shingles", "digest").join(found.drop("root"), "digest", "left")
    own = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    rows = rows.select("doc_id", "n_shingles", own.alias("component_id"))
    return rows.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_first(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each component of near duplicates, one with the smallest doc_id.

    Rows go by their doc_id and text, so null and repeated ids are told apart; equal rows are one. Of rows with the
    smallest doc_id that of the smallest digest stays. Rows without shingles have no links and all stay.
    """
    sketched, found = _components(docs, size, percent, keyed=True)
    rows = sketched.where("n_shingles > 0").select("doc_id", "text_digest", "digest")
    rows = rows.join(found.select("digest", "root"), "digest").groupBy("root", "doc_id", "text_digest")
    judged = stage(rows.agg(F.count("*").alias("n")), "judged")

    order = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("id"), F.col("text_digest").alias("t"))
    several = judged.groupBy("root").agg(F.min(order).alias("first"), F.count("*").alias("rows")).where("rows > 1")
    several = stage(several.select("root", "first"), "several")
    rest = judged.join(_small(several), "root").where(order != F.col("first"))
    dropped = stage(rest.select(F.col("doc_id").alias("own_id"), F.col("text_digest").alias("own_text")), "dropped")

    def same(keys: DataFrame):
        return docs["doc_id"].cast("long").eqNullSafe(keys["own_id"]) & (W.digest_column(docs["text"]) == keys["own_text"])

    dropped = _small(dropped)
    out = docs.join(dropped, same(dropped), "left_anti")
    repeated = judged.where("n > 1").select(F.col("doc_id").alias("own_id"), F.col("text_digest").alias("own_text"))
    if not repeated.limit(1).count():
        return out
    repeated = _small(repeated)
    twice = out.join(repeated, same(repeated), "left_semi")
    once = out.join(repeated, same(repeated), "left_anti")
    return once.unionByName(twice.dropDuplicates(["doc_id", "text"]))
