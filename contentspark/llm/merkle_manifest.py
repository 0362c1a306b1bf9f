"""A Merkle manifest of a dataset, its proofs exchanged by butterfly.

Leaves stand in the order of doc_id within each language, cut into aligned blocks of
``FANOUT ** HEIGHT``; a block is what one partition holds.

1. Leaf digests are computed where the texts are; only digests move from there on. A leaf's
   position is its number in a range partition plus the rows of earlier partitions, so a
   language of any size is spread over all tasks.
2. Each block hashes its own subtree.
3. Butterfly: in round r a block meets the blocks whose number differs in the r-th base-8 digit
   only. They swap the roots of their subtrees, and each of them hashes the parent, which all
   blocks below that parent do alike. So every block holds, after log8(blocks) rounds, the root
   and the siblings on its way up, and nothing is sent down. The last subtree of a level may
   hold fewer blocks than its neighbours; each of its blocks then serves several of theirs.
4. The roots of the languages form a tree above, built by the same steps.
5. Each block joins its upper path to its own levels: every document's proof, and the root
   folded from its leaf (of the altered text, where it is tampered with) and its siblings.

A group of the exchange has at most ``FANOUT`` rows, a block ``FANOUT ** HEIGHT`` digests.

Defined results: null values are ``-``; a null doc_id comes first and is never tampered with; a
null lang is a language of its own, the first. Rows that share a doc_id (and lang) are leaves
each, by leaf digest; equal rows have equal leaves and interchangeable places. A language with
one document has its leaf as subroot, one with nothing else is the root. An empty table gives
no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contentspark.llm.common import by_key, materialize
from contentspark.llm.ranks import positions

FANOUT = 8
HEIGHT = 4            # levels within a block: 4,096 leaves
SORT_ROWS = 65_536    # leaves that one task sorts, on average
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
PATH = "array<struct<left:string,right:string>>"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(columns: dict[str, Column]) -> Column:
    """The digest of a row: each field ``-`` if null, else its UTF-8 byte count, a colon and its value."""
    def field(c: Column) -> Column:
        s = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))
    return F.sha2(F.concat(*[field(columns[name]) for name in FIELDS]), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """doc_id, lang, key (lang without nulls, in the same order), leaf, and tampered: the altered row's leaf."""
    original = {c: F.col(c) for c in FIELDS}
    chosen = F.crc32(F.col("doc_id").cast("long").cast("string")) % 3 == 0
    altered = leaf(original | {"text": F.translate("text", UPPER, LOWER)})
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
        leaf(original).alias("leaf"), F.when(chosen, altered).alias("tampered"))
    return rows.withColumn("key", F.when(F.col("lang").isNull(), "-").otherwise(F.concat(F.lit(":"), "lang")))


def levels(nodes: list[str], upto: int | None) -> list[list[str]]:
    """Each level's nodes from the given ones up: ``upto`` levels of hashing, or until one node remains."""
    out = [nodes]
    while len(out) <= upto if upto is not None else len(out[-1]) > 1:
        out.append([digest("".join(out[-1][i:i + FANOUT])) for i in range(0, len(out[-1]), FANOUT)])
    return out


def steps(tree: list[list[str]], i: int) -> list[tuple[str, str]]:
    """The siblings left and right of leaf i's ancestor, level by level."""
    path = []
    for nodes in tree[:-1]:
        start = i - i % FANOUT
        path.append(("".join(nodes[start:i]), "".join(nodes[i + 1:start + FANOUT])))
        i //= FANOUT
    return path


def _local(rows: pd.DataFrame, height: int) -> list[list[str]]:
    """The levels of one block; a block that is not alone climbs all its levels, even with one node."""
    alone = int(rows["size"].iloc[0]) <= FANOUT ** height
    return levels(rows["node"].tolist(), None if alone else height)


def _block_root(height: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("index")
        return pd.DataFrame({"key": [rows["key"].iloc[0]], "block": [rows["block"].iloc[0]],
                             "size": [rows["size"].iloc[0]], "node": [_local(rows, height)[-1][0]]})

    return run


def butterfly(placed: DataFrame, label: str) -> DataFrame:
    """(key, block, root, path) of every block of ``placed`` (key, index, size, node): the way up from the block's root."""
    block = F.expr(f"index div {FANOUT ** HEIGHT}")
    rows = placed.select("key", block.alias("block"), "index", "size", "node")
    state = rows.groupBy("key", "block").applyInPandas(
        _block_root(HEIGHT), "key string, block bigint, size bigint, node string")
    state = state.select("key", "block", F.expr(f"(size + {FANOUT ** HEIGHT - 1}) div {FANOUT ** HEIGHT}").alias("blocks"),
                         "node", F.array().cast(PATH).alias("path"))
    state = materialize(state, f"{label}-blocks")
    most = state.agg(F.max("blocks")).first()[0] or 0
    width, r = 1, 0
    while width < most:
        digit, parent = F.expr(f"block div {width} % {FANOUT}"), F.expr(f"block div {width * FANOUT}")
        low = F.col("block") % width
        held = F.least(F.lit(width), F.col("blocks") - F.expr(f"block div {width}") * width)  # blocks of its own subtree
        serves = F.when((held < width) & (digit > 0), F.sequence(low, F.lit(width - 1), held)).otherwise(F.array(low))
        met = state.withColumns({"digit": digit, "parent": parent}).withColumn("slot", F.explode(serves))
        group = Window.partitionBy("key", "parent", "slot")
        met = met.withColumn("roots", F.sort_array(F.collect_list(F.struct("digit", "node")).over(group)))
        met = met.where(F.col("slot") == low)
        text = lambda keep: F.array_join(F.transform(F.filter("roots", keep), lambda x: x["node"]), "")
        step = F.struct(text(lambda x: x["digit"] < F.col("digit")).alias("left"),
                        text(lambda x: x["digit"] > F.col("digit")).alias("right"))
        open_ = F.col("blocks") > width  # more than one node is left at this level
        state = materialize(met.select(
            "key", "block", "blocks", F.when(open_, F.sha2(text(lambda x: F.lit(True)), 256)).otherwise(F.col("node")).alias("node"),
            F.when(open_, F.concat("path", F.array(step))).otherwise(F.col("path")).alias("path")), f"{label}-round-{r}")
        width, r = width * FANOUT, r + 1
    return state.select("key", "block", F.col("node").alias("root"), "path")


def _paths(height: int):
    """Every row's whole path: its levels in the block, then the block's way up."""
    def run(rows: pd.DataFrame, upper: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("index")
        tree = _local(rows, height)
        above = [(s["left"], s["right"]) for s in upper["path"].iloc[0]]
        return pd.DataFrame({"key": rows["name"], "root": upper["root"].iloc[0],
                             "path": [[{"left": a, "right": b} for a, b in steps(tree, i) + above] for i in range(len(rows))]})

    return run


def _proofs(height: int):
    """Every document's proof digest and folded root."""
    def run(rows: pd.DataFrame, upper: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("index")
        tree = _local(rows, height)
        above = [(s["left"], s["right"]) for s in upper["path"].iloc[0]]
        proofs, folded = [], []
        for i, (node, tampered) in enumerate(zip(rows["node"], rows["tampered"])):
            path = steps(tree, i) + above
            proofs.append(digest("".join(a + b for a, b in path)))
            now = tampered if isinstance(tampered, str) else node
            for a, b in path:
                now = digest(a + now + b)
            folded.append(now)
        root = upper["root"].iloc[0]
        return pd.DataFrame({"doc_id": rows["doc_id"], "leaf": rows["node"], "subroot": upper["subroot"].iloc[0], "root": root,
                             "proof_sha256": proofs, "folded_root": folded, "verified": [f == root for f in folded]})

    return run


def manifest(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified."""
    rows = materialize(leaves(docs), "merkle-leaves")
    placed = positions(rows, "key", [F.col("doc_id").asc_nulls_first(), F.col("leaf"), F.col("tampered")], "merkle-line",
                       SORT_ROWS).withColumnRenamed("leaf", "node")
    blocks = butterfly(placed, "merkle")
    tops = materialize(blocks.where("block = 0").select(F.col("key").alias("name"), F.col("root").alias("node"),
                                                        F.lit("all").alias("key")), "merkle-subroots")
    # A null lang's key "-" sorts before any ":lang", as null does before them.
    tops = positions(tops, "key", [F.col("name")], "merkle-langs", SORT_ROWS).withColumn("block", F.expr(f"index div {FANOUT ** HEIGHT}"))
    whole = butterfly(tops, "merkle-top")
    over = tops.groupBy("key", "block").cogroup(whole.groupBy("key", "block")).applyInPandas(
        _paths(HEIGHT), f"key string, root string, path {PATH}")
    over = materialize(over.withColumnRenamed("path", "top"), "merkle-top-paths")
    upper = blocks.withColumnRenamed("root", "subroot").join(by_key(over), "key").withColumn("path", F.concat("path", "top")).drop("top")
    line = placed.select("key", F.expr(f"index div {FANOUT ** HEIGHT}").alias("block"), "index", "size", "doc_id", "node", "tampered")
    # doc_id travels as text, for pandas would turn whole numbers beside nulls into floats.
    out = line.withColumn("doc_id", F.col("doc_id").cast("string")).groupBy("key", "block").cogroup(
        upper.groupBy("key", "block")).applyInPandas(
        _proofs(HEIGHT), "doc_id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
    return out.withColumn("doc_id", F.col("doc_id").cast("long"))
