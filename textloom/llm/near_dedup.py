"""Near-duplicate groups from bottom-k sketches of one hash function, with exact verification."""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.support import byte_list, filed, in_batches, named_rows, spread_join, written
from textloom.session import cut_lineage

SKETCH = 64
"""Hashes kept per document for the union-sketch estimate (k)."""

LISTED = 32
"""Lowest hashes that enter inverted lists. Of the union's lowest 32, at least
``shared_least`` are common to both sets of a link with a chance above 1 - 1e-8, so its documents meet in many lists."""

SMALL_LIST = 24
"""Members up to which a list pairs all with all; longer lists use hubs, then blocks."""

BLOCK = 1024
"""Members of a long list per block; a tile holds two blocks."""

LONG = 20_000
"""Shingles beyond which sets are not held by tiles but joined pair by pair, so that a tile's memory is bounded."""

KNOWN_WORDS = 300_000
_WORDS: dict[bytes, int] = {}


def _word_hash(word: bytes) -> int:
    h = _WORDS.get(word)
    if h is None:
        h = xxhash.xxh3_64_intdigest(word)
        if len(_WORDS) >= KNOWN_WORDS:
            _WORDS.clear()
        if len(word) <= 64:
            _WORDS[word] = h
    return h


def shingle_hashes(data: bytes, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of all word shingles; a text of fewer words is one shingle."""
    words = data.lower().split()
    if not words:
        return np.empty(0, np.int64)
    if len(words) < width:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words))], np.uint64).view(np.int64)
    h = np.fromiter(map(_word_hash, words), np.uint64, len(words))
    n = len(h) - width + 1
    mixed = np.zeros(n, np.uint64)
    for i in range(width):
        mixed = (mixed ^ h[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed.view(np.int64))


def _described(docs: DataFrame, width: int) -> DataFrame:
    """``(row, doc_id, n, node, sketch)``: a node is a set, named by 128 bits of its content."""
    schema = pa.schema([("row", pa.string()), ("doc_id", pa.int64()), ("n", pa.int64()), ("node", pa.string()), ("sketch", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for row, doc_id, data in zip(batch["row"].to_pylist(), batch["doc_id"].to_pylist(), byte_list(batch["text"])):
                    s = shingle_hashes(data, width)
                    yield row, doc_id, len(s), xxhash.xxh3_128_hexdigest(s.tobytes()) if len(s) else None, s[:SKETCH].tolist()

        yield from in_batches(rows(), schema, most_rows=4000)

    named = named_rows(docs, F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return named.select("row", "doc_id", "text").mapInArrow(run, "row string, doc_id bigint, n bigint, node string, sketch array<bigint>")


def _sets(docs: DataFrame, width: int) -> DataFrame:
    """``(node, members)`` with the whole sets of ``(text)``, one row of each node."""
    schema = pa.schema([("node", pa.string()), ("members", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for data in byte_list(batch["text"]):
                    s = shingle_hashes(data, width)
                    yield xxhash.xxh3_128_hexdigest(s.tobytes()), s

        yield from in_batches(rows(), schema, lambda r: r[1].nbytes)

    return docs.mapInArrow(run, "node string, members array<bigint>")


def _estimated(pairs: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """Pairs whose sizes allow a link and whose union sketch does not speak against it."""
    side = lambda x: nodes.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("sketch").alias(f"s_{x}"))
    met = pairs.join(side("a"), "a").join(side("b"), "b")
    met = met.where(F.least("n_a", "n_b") >= threshold * F.greatest("n_a", "n_b"))
    union = F.slice(F.array_sort(F.array_union("s_a", "s_b")), 1, SKETCH)
    shared = F.size(F.array_intersect(union, F.array_intersect("s_a", "s_b")))
    return met.where(shared >= estimate_least(threshold) * F.size(union)).select("a", "b")


def _of_rows(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """``text`` of the named rows."""
    return named_rows(docs, F.col("text").cast("string").alias("text")).join(rows, "row", "left_semi").select("text")


def _verified(pairs: DataFrame, docs: DataFrame, owners: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs of sets with ``100 * |both| >= percent * |either|``; only sets of candidates are built again."""
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    rows = owners.join(wanted, "node", "left_semi").select("row")
    sets = written(_sets(_of_rows(docs, rows), width), "sets")
    side = lambda x: sets.select(F.col("node").alias(x), F.col("members").alias(f"m_{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    common = F.size(F.array_intersect("m_a", "m_b"))
    either = F.size("m_a") + F.size("m_b") - common
    return both.where(100 * common >= percent * either).select("a", "b")


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """``(node, root)`` by lowest names passed along links, with shortcuts; each round is kept in the shared folder."""
    both = cut_lineage(links.union(links.select("b", "a")).toDF("node", "other").distinct())
    labels = cut_lineage(both.select("node").distinct().withColumn("root", F.col("node")))
    while True:
        heard = both.join(labels.withColumnRenamed("node", "other"), "other").groupBy("node").agg(F.min("root").alias("heard"))
        lower = labels.join(heard, "node").select("node", F.least("root", "heard").alias("root"), F.col("root").alias("old"))
        jump = lower.select(F.col("node").alias("root"), F.col("root").alias("next"))
        lower = cut_lineage(lower.join(jump, "root", "left").select("node", F.least("root", F.coalesce("next", "root")).alias("root"), "old"))
        if lower.where("root <> old").isEmpty():
            break
        labels = lower.select("node", "root")
    return nodes.select("node").join(labels, "node", "left").select("node", F.coalesce("root", "node").alias("root"))


def shared_least(threshold: float, drawn: int = LISTED) -> int:
    """Of ``drawn`` lowest hashes of a union, those that a link shares with a chance above 1 - 1e-8, by the binomial tail."""
    tail = 0.0
    for k in range(drawn + 1):
        tail += comb(drawn, k) * threshold**k * (1 - threshold) ** (drawn - k)
        if tail > 1e-8:
            return k
    return drawn


def estimate_least(threshold: float) -> float:
    """The estimate that a link reaches with a chance above 1 - 1e-8; unions of up to ``SKETCH`` hashes are estimated exactly."""
    return shared_least(threshold, SKETCH) / SKETCH


class Estimates:
    """Union-sketch estimates of one set against many: sorted sketches as rows of codes, ``empty`` beyond their end."""

    def __init__(self, sketches: list[np.ndarray]) -> None:
        values = np.unique(np.concatenate(sketches))
        self.empty = len(values)
        self.rows = np.full((len(sketches), SKETCH), self.empty, np.int64)
        for row, s in zip(self.rows, sketches):
            row[: len(s)] = np.searchsorted(values, s)
        self.lengths = np.array([len(s) for s in sketches])
        self.places = np.arange(1, SKETCH + 1)

    def against(self, i: int, others: np.ndarray) -> np.ndarray:
        """Share of the union sketch of ``i`` and each of ``others`` that both hold."""
        own = np.zeros(self.empty + 1, bool)
        own[self.rows[i, : self.lengths[i]]] = True
        rows = self.rows[others]
        met = own[rows]
        rank = np.cumsum(own)[rows] + self.places - np.cumsum(met, axis=1)
        union = self.lengths[i] + self.lengths[others] - met.sum(axis=1)
        return (met & (rank <= SKETCH)).sum(axis=1) / np.minimum(union, SKETCH)


TILE = ["value", "low", "high"]


def _cross_candidates(lists: DataFrame, labels: DataFrame, threshold: float) -> DataFrame:
    """``(value, low, high, block, node, root, other)``: sets of long lists with a possible link to another component.

    A link missing so far has all its shared hashes in long lists. Documents with fewer of those than a link shares
    cannot have one, and the first ``hot - least + 1`` of a document's long lists, rarest first (its prefix), meet
    every such partner. Lists of one component are settled. Blocks of the lists are replicated and sketches compared
    within a task; a pair counts only in the tiles of the first value that both prefixes hold. Sets of more than
    ``LONG`` shingles come as pairs with ``other``; any others once per tile, with ``other`` null.
    """
    members = lists.join(labels, "node")
    open_lists = members.groupBy("value").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("value")
    per_node = Window.partitionBy("node")
    hot = members.withColumn("hot", F.count("*").over(per_node)).withColumn("place", F.row_number().over(per_node.orderBy("df", "value")))
    least = F.least(F.lit(shared_least(threshold)), F.ceil(F.col("n") * threshold))
    hot = hot.where((F.col("hot") >= least) & (F.col("place") <= F.col("hot") - least + 1))
    hot = hot.withColumn("prefix", F.collect_list("value").over(per_node)).join(open_lists, "value", "left_semi")
    blocks = F.ceil(F.col("df") / BLOCK).cast("int")
    own = hot.withColumn("block", F.pmod(F.xxhash64("node", "value"), blocks).cast("int")).withColumn("blocks", blocks)
    tiles = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tiles = tiles.select("value", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "node", "root", "n", "sketch", "prefix")

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        value, low, high = (int(frame[c].iloc[0]) for c in TILE)
        estimates = Estimates([np.asarray(s) for s in frame["sketch"]])
        block, n = frame["block"].to_numpy(), frame["n"].to_numpy()
        node, root = frame["node"].tolist(), np.unique(frame["root"].tolist(), return_inverse=True)[1]
        lower = [[v for v in p if v < value] for p in frame["prefix"]]
        codes = {v: c for c, v in enumerate(sorted({v for p in lower for v in p}))}
        before = np.full((len(frame), max(map(len, lower), default=0)), len(codes), np.int64)
        for row, p in zip(before, lower):
            row[: len(p)] = [codes[v] for v in p]
        right = block == high
        inside = np.zeros(len(frame), bool)
        out = []
        for i in np.flatnonzero(block == low).tolist():
            earlier = np.zeros(len(codes) + 1, bool)
            earlier[before[i]] = True
            earlier[-1] = False
            sized = np.minimum(n, n[i]) >= threshold * np.maximum(n, n[i])
            others = np.flatnonzero(right & (root != root[i]) & sized & ~earlier[before].any(axis=1))
            others = others[estimates.against(i, others) >= estimate_least(threshold)]
            long = np.maximum(n[others], n[i]) > LONG
            out += [(value, low, high, 0, node[i], None, node[j]) for j in others[long].tolist()]
            inside[others[~long]] = True
            inside[i] |= not long.all()
        out += [(value, low, high, int(block[i]), node[i], str(root[i]), None) for i in np.flatnonzero(inside).tolist()]
        return pd.DataFrame(out, columns=[*TILE, "block", "node", "root", "other"])

    # Dealt by tile: by value alone, all tiles of a frequent value would be one task.
    return tiles.repartition(*TILE).groupBy(*TILE).applyInPandas(run, "value bigint, low int, high int, block int, node string, root string, other string")


def _tile_links(tiles: DataFrame, docs: DataFrame, owners: DataFrame, width: int, percent: int) -> DataFrame:
    """Links between components within each tile, on whole sets, which a tile holds once rather than per pair.

    Every two sets of components that differ so far are compared, and a link is reported if it joins two of them.
    """
    rows = owners.join(tiles.select("node").distinct(), "node", "left_semi").select("row")
    sets = written(_sets(_of_rows(docs, rows), width), "tile-sets")

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        members = frame["members"].tolist()
        n = np.array([len(m) for m in members])
        values, codes = np.unique(np.concatenate(members), return_inverse=True)
        ends = np.cumsum(n)
        block, node = frame["block"].to_numpy(), frame["node"].tolist()
        root = np.unique(frame["root"].tolist(), return_inverse=True)[1]
        right = block == frame["high"].iloc[0]
        group = root.copy()
        out = []
        for i in np.flatnonzero(block == frame["low"].iloc[0]).tolist():
            own = np.zeros(len(values), bool)
            own[codes[ends[i] - n[i] : ends[i]]] = True
            common = np.add.reduceat(own[codes], ends - n, dtype=np.int64)
            linked = right & (group != group[i]) & (100 * common >= percent * (n + n[i] - common))
            # One link for each group that joins this one: a tile gives fewer links than it has members.
            for j in np.flatnonzero(linked)[np.unique(group[linked], return_index=True)[1]].tolist():
                out.append((min(node[i], node[j]), max(node[i], node[j])))
                group[group == group[j]] = group[i]
        return pd.DataFrame(out, columns=["a", "b"])

    return tiles.join(sets, "node").repartition(*TILE).groupBy(*TILE).applyInPandas(run, "a string, b string").distinct()


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for every row of ``docs``.

    Texts are linked when 100 times the common shingles reach ``percent`` times those of either; ``component_id`` is
    the least doc_id reachable. Texts without words, or null, have no shingles and stand alone. Repeated rows share
    their set and its group. Rows with a null id belong to their group but never name one that has other ids. Other columns are left out; an empty table gives no rows. A text of any length is held whole by one task.

    Equal sets are one node. Every list of a retained hash gives candidates: short lists all pairs, long ones each
    member with the list's hub, and then, in blocks, pairs that are still apart. The union sketch filters candidates
    and whole sets confirm them.
    """
    described, labels = _labelled(docs, width, percent)
    named = written(labels.join(described.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("doc_id")), "node"), "named")
    least = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    by_node = spread_join(named.select("node", "root"), least, "root", "node").select("node", "component_id")
    rows = spread_join(described.drop("sketch"), by_node, "node", "row", "left")
    rows = rows.withColumn("component_id", F.coalesce("component_id", F.when(F.col("n") == 0, F.col("doc_id"))))
    return rows.select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def spare_rows(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``(row)``: names (see ``named_rows``) of the rows that one row of their group makes superfluous.

    Of each group of near duplicates the row with the least doc_id stays, null ids last, then by name. Rows without
    words are in no group. ``docs`` must be a table of files, whose rows have lasting names.
    """
    described, labels = _labelled(docs, width, percent)
    members = written(spread_join(described.select("row", "doc_id", "node").where("node is not null"), labels, "node", "row"), "members")
    stays = members.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first"))
    return spread_join(members.select("row", "root"), stays, "root", "row").where("row <> first.row").select("row")


def _labelled(docs: DataFrame, width: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """``(row, doc_id, n, node, sketch)`` of every row, and ``(node, root)`` of every set."""
    threshold = percent / 100
    docs = filed(docs)
    described = written(_described(docs, width), "described")
    filled = described.where("n > 0")
    nodes = written(filled.groupBy("node").agg(F.min("row").alias("row"), F.first("n").alias("n"), F.first("sketch").alias("sketch")), "nodes")
    owners = nodes.select("node", "row")
    listed = nodes.select("node", "n", F.explode(F.slice("sketch", 1, LISTED)).alias("value"))
    frequent = listed.groupBy("value").agg(F.count("*").alias("df"), F.min_by("node", F.xxhash64("node", "value")).alias("hub")).where("df > 1")
    lists = written(listed.join(frequent, "value"), "lists")
    short = lists.where(F.col("df") <= SMALL_LIST)
    right = short.select("value", F.col("node").alias("b"), F.col("n").alias("n_b"))
    near = (F.col("node") < F.col("b")) & (F.least("n", "n_b") >= threshold * F.greatest("n", "n_b"))
    pairs = short.join(right, "value").where(near).select(F.col("node").alias("a"), "b")
    # A hub differs from list to list, so copies that one hub is too far from meet many others.
    hubs = lists.where((F.col("df") > SMALL_LIST) & (F.col("node") != F.col("hub"))).select(
        F.least("hub", "node").alias("a"), F.greatest("hub", "node").alias("b")
    )
    candidates = written(_estimated(pairs.union(hubs).distinct(), nodes, threshold), "candidates")
    links = written(_verified(candidates, docs, owners, width, percent), "links")
    labels = components(nodes, links)
    long_lists = lists.where(F.col("df") > SMALL_LIST)
    if long_lists.isEmpty():
        return described, labels
    labels = written(labels, "labels")
    cross = written(_cross_candidates(long_lists.join(nodes.select("node", "sketch"), "node"), labels, threshold), "cross")
    if cross.isEmpty():
        return described, labels
    links = written(_tile_links(cross.where("other is null").drop("other"), docs, owners, width, percent), "tile-links")
    apart = cross.where("other is not null").select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()
    if not apart.isEmpty():
        links = links.union(written(_verified(apart, docs, owners, width, percent), "long-links"))
    # The new links join whole components, so only their roots are walked again.
    side = lambda x: labels.select(F.col("node").alias(x), F.col("root").alias(f"root_{x}"))
    between = links.join(side("a"), "a").join(side("b"), "b").select(F.col("root_a").alias("a"), F.col("root_b").alias("b")).where("a <> b")
    wider = components(labels.select(F.col("root").alias("node")).distinct(), between).toDF("root", "wider")
    return described, spread_join(labels, wider, "root", "node").select("node", F.col("wider").alias("root"))
