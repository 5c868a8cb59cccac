"""Near-duplicate documents by bottom-k sketches of their word shingles.

Every shingle gets one 64-bit hash value; the k smallest values of a document are its sketch.

1. One scan of the texts gives sketch, set size and fingerprint. Documents of one fingerprint (equal
   sets) are one class, which its smallest doc_id represents from here on.
2. Inverted lists. Two linked documents share at least ``need`` retained values: for small sets this
   is arithmetic, for larger ones it holds at five standard deviations (``least_shared``). So they
   also share one of the ``shared - need + 1`` rarest of the values that a document shares with any
   other; only these enter the lists. A document that shares fewer than ``need`` values is out.
3. Stars. In each list all documents meet one, its hub: union-sketch estimation on sketches filters
   and the Jaccard similarity of the full sets decides. A hub's group is split into blocks.
4. The rest. Two documents of a list that are both linked to its hub are connected already. Each
   document that is not (a stray) meets the whole group of the hub, in blocks, by the same steps. No
   pair of a list is left out, none is emitted unless it is linked, and of the links of a block only
   those that connect anything new.
5. Links become components by alternating large-star and small-star steps.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kilowatch.llm.common import free_name, matching_rows, stored, tidy, worker_cache

K = 64
BLOCK = 512  # documents of a block
CACHE_WORDS = 100_000
DEVIATIONS = 5.0
TOP = np.iinfo(np.int64).max
SIGNATURE = "doc_id long, n long, fp1 long, fp2 long, sketch array<long>"


def least_shared(k: int, percent: int) -> int:
    """Retained values that two sketches of linked sets share, five deviations below the mean."""
    t = percent / 100
    return max(1, math.floor(k * t - DEVIATIONS * math.sqrt(k * t * (1 - t))))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def shingle_hashes(text: str | None, size: int, known: dict) -> np.ndarray:
    """Sorted distinct hash values of the shingles.

    A-Z are lower-cased and words are what stands between ASCII white space. Fewer words than
    ``size`` make one shingle of them all; without words the result is empty.
    """
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if len(words) < size:
        value = xxhash.xxh64_intdigest(b" ".join(words), seed=1)
        return np.array([value] if words else [], np.uint64).view(np.int64)
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    n = len(words) - size + 1
    x = h[:n].copy()
    for j in range(1, size):
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + h[j : j + n]
    for shift, m in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(m)
    return np.unique((x ^ (x >> np.uint64(31))).view(np.int64))


def _word_cache() -> dict:
    holder = worker_cache("word-hashes")
    if len(holder.get("words", ())) > CACHE_WORDS:
        del holder["words"]
    if "words" not in holder:
        holder["words"] = _WordHashes()
    return holder["words"]


def _signatures(batches: Iterator[pd.DataFrame], size: int, k: int) -> Iterator[pd.DataFrame]:
    import xxhash

    for batch in batches:
        known = _word_cache()
        sets = [shingle_hashes(text, size, known) for text in batch["text"]]
        prints = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
        halves = [(None, None) if p is None else tuple(int(v) for v in np.frombuffer(p, "<i8")) for p in prints]
        yield pd.DataFrame({
            "doc_id": batch["doc_id"].astype("Int64"), "n": [len(s) for s in sets],
            "fp1": pd.array([a for a, _ in halves], "Int64"), "fp2": pd.array([b for _, b in halves], "Int64"),
            # One value more tells a cut sketch from a whole set.
            "sketch": [s[: k + 1] for s in sets],
        })


def _sets(batches: Iterator[pd.DataFrame], size: int) -> Iterator[pd.DataFrame]:
    for batch in batches:
        known = _word_cache()
        yield pd.DataFrame({
            "doc": batch["doc_id"], "members": [shingle_hashes(text, size, known) for text in batch["text"]],
        })


class _Block:
    """Documents of one side: counts how many values each shares with another document."""

    def __init__(self, docs: list[int], sets: list[np.ndarray], k: int):
        self.docs, self.sizes, self.k = np.array(docs), np.array([len(s) for s in sets]), k
        self.sets, self.full = sets, None
        self.retained = self._index([s[:k] for s in sets])
        self.sketches = np.full((len(sets), k), TOP)
        for row, s in zip(self.sketches, sets):
            row[: min(k, len(s))] = s[:k]
        # Up to this value a sketch is complete.
        self.ends = np.array([s[k - 1] if len(s) > k else TOP for s in sets])

    @staticmethod
    def _index(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        values, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        order = np.argsort(values, kind="stable")
        return values[order], owner[order]

    def shared(self, index: tuple[np.ndarray, np.ndarray], other: np.ndarray) -> np.ndarray:
        values, owner = index
        lo, hi = np.searchsorted(values, other, "left"), np.searchsorted(values, other, "right")
        n = hi - lo
        at = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        return np.bincount(owner[at], minlength=len(self.docs))

    def estimates(self, other: np.ndarray) -> np.ndarray:
        """Similarity in the sketch of each union: the values up to where both sketches are complete."""
        sketch = other[: self.k]
        end = sketch[-1] if len(other) > self.k else TOP
        both = self.shared(self.retained, sketch)
        upto = np.minimum(self.ends, end)
        mine = (self.sketches <= upto[:, None]).sum(axis=1) if end < TOP else np.minimum(self.sizes, self.k)
        theirs = np.searchsorted(sketch, upto, "right")
        return both / np.maximum(mine + theirs - both, 1)

    def links(self, other: np.ndarray, percent: int) -> np.ndarray:
        self.full = self.full or self._index(self.sets)
        both = self.shared(self.full, other)
        return 100 * both >= percent * (self.sizes + len(other) - both)


def _walk(batches: Iterator[pd.DataFrame], k: int) -> Iterator[tuple[int, _Block, int, np.ndarray, bool]]:
    """(g, left block, right document, its values, first of its block) for every meeting.

    Rows come sorted by (g, lb, rb, side): a block's left documents, then its right ones. One left
    block is held.
    """
    key, docs, sets, block = None, [], [], None
    for batch in batches:
        for g, lb, rb, side, doc, members in zip(*(batch[c] for c in ("g", "lb", "rb", "side", "doc", "members"))):
            if (g, lb, rb) != key:
                key, docs, sets, block = (g, lb, rb), [], [], None
            if side == 0:
                docs.append(doc)
                sets.append(np.asarray(members))
            elif docs:
                first = block is None
                block = block or _Block(docs, sets, k)
                yield g, block, doc, np.asarray(members), first


def _screen(batches: Iterator[pd.DataFrame], k: int, percent: int) -> Iterator[pd.DataFrame]:
    """Documents (side 0 left, 1 right) whose estimate with any of the other side is high enough."""
    t = percent / 100
    least = t - DEVIATIONS * math.sqrt(t * (1 - t) / k)
    out, current, near = [], None, None

    def close():
        g, block = current
        return [(g, int(d), 0) for d in block.docs[near]]

    for g, block, doc, members, first in _walk(batches, k):
        if first:
            out += close() if current else []
            current, near = (g, block), np.zeros(len(block.docs), bool)
        good = (block.estimates(members) >= least) & (block.docs != doc)
        near |= good
        if good.any():
            out.append((g, doc, 1))
        if len(out) > 10_000:
            yield pd.DataFrame(out, columns=["g", "doc", "side"])
            out = []
    out += close() if current else []
    if out:
        yield pd.DataFrame(out, columns=["g", "doc", "side"])


class _Joined:
    """Which documents of a block are connected by the links emitted so far."""

    def __init__(self):
        self.above: dict[int, int] = {}

    def _top(self, doc: int) -> int:
        while (up := self.above.get(doc, doc)) != doc:
            self.above[doc] = doc = self.above.get(up, up)
        return doc

    def join(self, a: int, b: int) -> bool:
        """Whether the link connects what was apart."""
        a, b = self._top(a), self._top(b)
        self.above[a] = b
        return a != b


def _verify(batches: Iterator[pd.DataFrame], k: int, percent: int) -> Iterator[pd.DataFrame]:
    """Linked pairs by full sets; of each block only so many as connect all that its links connect."""
    out, joined = [], _Joined()
    for g, block, doc, members, first in _walk(batches, k):
        if first:
            joined = _Joined()
        linked = block.docs[block.links(members, percent) & (block.docs != doc)]
        out += [(g, a, doc) for a in linked.tolist() if joined.join(a, doc)]
        if len(out) > 10_000:
            yield pd.DataFrame(out, columns=["g", "a", "b"])
            out = []
    if out:
        yield pd.DataFrame(out, columns=["g", "a", "b"])


def _met(left: DataFrame, right: DataFrame, values: DataFrame) -> DataFrame:
    """The rows of all meetings in order; ``left`` and ``right`` have g and doc.

    Either side of a group is cut into blocks by a hash, and every left block meets every right one.
    """
    sizes = left.groupBy("g").agg(F.count(F.lit(1)).alias("lefts")).join(
        right.groupBy("g").agg(F.count(F.lit(1)).alias("rights")), "g"
    )
    blocks = stored(sizes.select("g", *[F.ceil(F.col(c) / BLOCK).cast("int").alias(c) for c in ("lefts", "rights")]), "blocks")

    def placed(side: DataFrame, number: int, own: str, other: str, own_blocks: str, other_blocks: str) -> DataFrame:
        at = F.pmod(F.xxhash64("doc"), F.col(own_blocks)).cast("int")
        return side.join(blocks, "g").select(
            "g", "doc", F.lit(number).alias("side"), at.alias(own),
            F.explode(F.sequence(F.lit(0), F.col(other_blocks) - 1)).alias(other),
        )

    rows = placed(left, 0, "lb", "rb", "lefts", "rights").unionByName(placed(right, 1, "rb", "lb", "rights", "lefts"))
    return (
        rows.join(values, "doc").repartition("g", "lb", "rb").sortWithinPartitions("g", "lb", "rb", "side")
        .select("g", "lb", "rb", "side", "doc", "members")
    )


def _full_sets(docs: DataFrame, ids: DataFrame, size: int, repeated: bool) -> DataFrame:
    sets = matching_rows(docs, "doc_id", ids).mapInPandas(lambda it: tidy(_sets(it, size)), "doc long, members array<long>")
    return stored(sets.distinct() if repeated else sets, "shingle-sets")


def linked_pairs(sketches: DataFrame, docs: DataFrame, size: int, percent: int, k: int, repeated: bool) -> DataFrame:
    """Links (a, b) between class representatives: enough to connect every two that are linked.

    Sketches are compared first, full sets only of the documents that pass.
    """
    need = F.when(
        F.col("n") <= k * percent // 100, F.floor((F.col("n") * percent + 99) / 100)
    ).otherwise(least_shared(k, percent))
    entries = sketches.select("rep", "n", F.explode(F.slice("sketch", 1, k)).alias("value"))
    often = entries.groupBy("value").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    rarest = (
        entries.join(often, "value").groupBy("rep", "n")
        .agg(F.sort_array(F.collect_list(F.struct("df", "value"))).alias("found"))  # k values at most
        .withColumn("take", (F.size("found") - need + 1).cast("int")).where("take > 0")
        .select("rep", (-F.size("found")).alias("lack"), F.explode(F.slice("found", F.lit(1), F.col("take"))["value"]).alias("value"))
    )
    rarest = stored(rarest, "inverted-lists")
    # The hub shares most values with others: an unedited document rather than one at the rim.
    hubs = rarest.groupBy("value").agg(F.min(F.struct("lack", "rep")).alias("hub"), F.count(F.lit(1)).alias("n"))
    hubs = hubs.where("n > 1").select("value", F.col("hub.rep").alias("g"))
    group = stored(
        rarest.join(hubs, "value").where("rep <> g").select("g", F.col("rep").alias("doc")).distinct(), "hub-groups"
    )
    values = sketches.select(F.col("rep").alias("doc"), F.col("sketch").alias("members"))
    hub = group.select("g", F.col("g").alias("doc")).distinct()

    def screened(left: DataFrame, right: DataFrame, name: str) -> DataFrame:
        return stored(_met(left, right, values).mapInPandas(
            lambda it: tidy(_screen(it, k, percent)), "g long, doc long, side int"
        ).distinct(), name)

    def verified(near: DataFrame, sets: DataFrame, name: str) -> DataFrame:
        left, right = (near.where(F.col("side") == side).select("g", "doc") for side in (0, 1))
        return stored(_met(left, right, sets).mapInPandas(
            lambda it: tidy(_verify(it, k, percent)), "g long, a long, b long"
        ), name)

    near = screened(hub, group, "near-hub")
    some = stored(near.select("doc").distinct(), "near-ids")
    sets = _full_sets(docs, some, size, repeated)
    star = verified(near, sets, "stars")
    # Strays: documents of a list that are not linked to its hub, where there is any other to meet.
    linked = star.select("g", F.col("b").alias("doc")).distinct()
    several = group.groupBy("g").count().where("count > 1").select("g")
    strays = stored(group.join(linked, ["g", "doc"], "left_anti").join(several, "g", "left_semi"), "strays")
    left, right = strays, group.join(strays.select("g").distinct(), "g", "left_semi")
    near = screened(left, right, "near-strays")
    more = stored(near.select("doc").distinct().join(some, "doc", "left_anti"), "more-ids")
    if not more.isEmpty():
        sets = sets.union(_full_sets(docs, more, size, repeated))
    rest = verified(near, sets, "stray-links")
    return star.select("a", "b").union(rest.select("a", "b"))


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every linked node, the root being the smallest node it can reach."""
    edges = stored(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "links"
    )
    state = None
    while True:
        now = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == state or not now[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = now
        # Large star: the greater neighbours of a node point to its least neighbour (or itself).
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Small star: a node and its smaller neighbours point to the least of these.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        edges = stored(small.where("u <> v").distinct(), "links")


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, k: int = K) -> DataFrame:
    """Component of every document: doc_id, n_shingles, component_id, kept.

    ``docs`` has doc_id and text; other columns are not read. Documents are linked where
    100 * |intersection| >= percent * |union| of their shingle sets. Null, empty and blank texts have
    no shingles and are linked with nothing. Several texts of one doc_id count as one document, all
    rows of which are returned. A row without doc_id is returned alone (component_id null, kept).
    An empty table gives an empty result.
    """
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = stored(slim.mapInPandas(lambda it: tidy(_signatures(it, size, k)), SIGNATURE), "signatures")
    rows = signed.where("n > 0 and doc_id is not null").select("doc_id", "n", "fp1", "fp2")
    classes = stored(rows.groupBy("fp1", "fp2", "n").agg(F.min("doc_id").alias("rep")), "classes")
    # Ids that occur with several texts connect their classes.
    several = rows.groupBy("doc_id").agg(F.min("fp1").alias("lo"), F.max("fp1").alias("hi"), F.count(F.lit(1)).alias("rows"))
    several = stored(several.where("rows > 1"), "repeated-ids")
    repeated = not several.isEmpty()
    sketches = signed.select("fp1", "fp2", "doc_id", "n", "sketch").join(
        classes.select("fp1", "fp2", F.col("rep").alias("doc_id")), ["fp1", "fp2", "doc_id"], "left_semi"
    )
    sketches = sketches.select(F.col("doc_id").alias("rep"), "n", "sketch")
    sketches = stored(sketches.distinct() if repeated else sketches, "sketches")
    links = linked_pairs(sketches, slim, size, percent, k, repeated)
    if repeated:
        texts = rows.join(several.where("lo < hi").select("doc_id"), "doc_id").join(classes, ["fp1", "fp2", "n"])
        links = links.union(texts.select("rep", "doc_id").distinct())
    roots = components(links)
    named = classes.join(roots, classes["rep"] == roots["node"], "left").select(
        "fp1", "fp2", F.coalesce("root", "rep").alias("root")
    )
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "doc_id"))
    return signed.select("doc_id", "n", "fp1", "fp2").join(named, ["fp1", "fp2"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )


def without_near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, all columns, of which each group of near-duplicates keeps one: the row of the
    smallest doc_id, null last.

    Rows are numbered and stored first and compared by their numbers, so rows without an id, or with a
    repeated one, are copies or not by their text like any others.
    """
    number = free_name(docs, "neardup_row")
    rows = stored(docs.withColumn(number, F.monotonically_increasing_id()), "numbered")
    slim = rows.select(F.col(number).alias("doc_id"), "text")
    found = near_duplicates(slim, size, percent).select(F.col("doc_id").alias("row"), "component_id")
    found = stored(found.where("row <> component_id or component_id is null"), "near-duplicates")
    groups = found.select(F.col("component_id").alias("row")).distinct().withColumn("component_id", F.col("row"))
    members = found.union(groups).join(rows.select(F.col(number).alias("row"), F.col("doc_id").alias("id")), "row")
    first = F.min_by("row", F.struct(F.col("id").isNull(), "id", "row"))
    keepers = members.groupBy("component_id").agg(first.alias("row")).select("row")
    dropped = members.select("row").join(keepers, "row", "left_anti")
    return matching_rows(rows, number, stored(dropped, "copies"), keep=False).select(*docs.columns)
