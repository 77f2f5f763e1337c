"""Near-duplicate documents by DartMinHash signatures.

A document is a set of shingles, each weighted by how often it occurs.  Darts are thrown at the plane of weight and rank of every
element, the same ones wherever the element occurs; those that land below the element's weight count, and
the dart of the lowest rank per coordinate is the signature's value there.  Runs of coordinates form bands,
documents that agree in a band are candidates, and candidates are compared exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyweir.llm.components import components
from tallyweir.llm.shared import kept, mixed, passed, ranges, shingle_hashes, slices, stored, unit

WORDS = 5
SIMILARITY = 0.8
BANDS = 32
BAND_COORDINATES = 6
BLOCK = 256
_COLUMNS = 4096
_LOW, _LOW_BITS = np.uint64((1 << 24) - 1), np.uint64(24)
# Darts of one unit of area: Poisson with mean 1, by its cumulated probabilities.
_DARTS = np.exp(-1.0) * np.cumsum(1 / np.cumprod([1, *range(1, 17)]))


def dart_signatures(elements: np.ndarray, weights: np.ndarray, counts: np.ndarray, k: int) -> np.ndarray:
    """``[set, k]``: signatures of sets that are given one after another by hashes of distinct elements.

    The probability that two sets agree in a coordinate is their weighted Jaccard similarity.  Ranks are
    taken unit by unit until no coordinate of a set is empty; an empty set has zeros.
    """
    size = len(counts) * k
    dart_of, rank_of = np.zeros(size, dtype=np.uint64), np.full(size, np.inf)
    owner = np.repeat(np.arange(len(counts)), counts)
    total = np.bincount(owner, weights, minlength=len(counts))
    # Units of rank in which, most of the time, every coordinate is hit.
    units = np.ceil((k * np.log(k) + 2 * k) / np.maximum(total, 1e-9)).astype(np.int64)
    done = np.zeros(len(counts), dtype=np.int64)
    missing = total > 0
    while missing.any():
        # Elements of the sets that are not finished, once for every unit of rank and every unit of weight.
        which = np.flatnonzero(missing[owner])
        heights = np.ceil(weights[which]).astype(np.int64)
        cells = units[owner[which]] * heights
        cell, height = ranges(cells), np.repeat(heights, cells)
        at = np.repeat(which, cells)
        rank, weight = done[owner[at]] + cell // height, cell % height
        with np.errstate(over="ignore"):
            seed = mixed(elements[at] ^ mixed(rank.astype(np.uint64) * np.uint64(0xA24BAED4963EE407) + weight.astype(np.uint64)))
            n = np.searchsorted(_DARTS, unit(seed), side="right")
            at, rank, weight = np.repeat(at, n), np.repeat(rank, n), np.repeat(weight, n)
            dart = mixed(np.repeat(seed, n) + (ranges(n).astype(np.uint64) + np.uint64(1)) * np.uint64(0x9FB21C651E98DF25))
        below = weight + 1 <= weights[at]
        if not below.all():
            below |= weight + unit(mixed(dart ^ np.uint64(0x1F83D9ABFB41BD6B))) < weights[at]
            at, rank, dart = at[below], rank[below], dart[below]
        # The low bits of a dart are its coordinate, the high bits its rank.
        place = owner[at] * k + ((dart & _LOW) * np.uint64(k) >> _LOW_BITS).astype(np.int64)
        rank = rank + (dart >> _LOW_BITS).astype(np.float64) * 2.0**-40
        open_places = np.isinf(rank_of)
        np.minimum.at(rank_of, place, rank)
        lowest = (rank == rank_of[place]) & open_places[place]
        dart_of[place[lowest]] = dart[lowest]
        done[missing] += units[missing]
        missing &= np.isinf(rank_of).reshape(len(counts), k).any(axis=1)
    return dart_of.reshape(len(counts), k)


def distinct_elements(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct values of every run, sorted, how often each occurs, and how many each run has."""
    owner = np.repeat(np.arange(len(counts)), counts)
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    first = np.ones(len(hashes), dtype=bool)
    first[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    times = np.diff(np.append(np.flatnonzero(first), len(first)))
    return hashes[first], times, np.bincount(owner[first], minlength=len(counts))


def occurrences(elements: np.ndarray, times: np.ndarray) -> np.ndarray:
    """An element of its own for each time that one occurs, so that what weighted sets share can be counted."""
    with np.errstate(over="ignore"):
        again = ranges(times).astype(np.uint64)
        return np.where(again > 0, mixed(np.repeat(elements, times) + again * np.uint64(0x9FB21C651E98DF25)), np.repeat(elements, times))


def _sets(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of texts, how often each occurs, how many distinct ones and how many in all each text has, and
    two hashes that tell different word sequences apart."""
    hashes, counts = shingle_hashes(texts, WORDS)
    ends = np.cumsum(counts)
    with np.errstate(over="ignore"):
        place = ranges(counts).astype(np.uint64)
        keys = []
        for salt in (np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344)):
            sums = np.append(np.uint64(0), np.cumsum(mixed(hashes ^ mixed(place + salt)), dtype=np.uint64))
            keys.append(sums[ends] - sums[ends - counts])
    return *distinct_elements(hashes, counts), counts, np.stack(keys, axis=1).view(np.int64)


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    k = kept("minhash", lambda: BANDS * BAND_COORDINATES)
    for batch in batches:
        texts = ["" if t is None else t for t in batch.column(1).to_pylist()]
        for low, high in slices(texts, most=256):
            elements, times, distinct, counts, keys = _sets(texts[low:high])
            signature = dart_signatures(elements, times.astype(np.float64), distinct, k).reshape(-1, BANDS, BAND_COORDINATES)
            with np.errstate(over="ignore"):
                band = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), signature.shape[:2])
                for i in range(BAND_COORDINATES):
                    band = mixed(band * np.uint64(0xD6E8FEB86659FD93) + signature[:, :, i])
            bands = pa.ListArray.from_arrays(pa.array(np.arange(0, band.size + 1, BANDS, dtype=np.int32)), pa.array(band.view(np.int64).ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)[low:high], pa.array(keys[:, 0]), pa.array(keys[:, 1]), pa.array(counts.astype(np.int32)), bands],
                ["doc_id", "k1", "k2", "size", "bands"],
            )


def _shingled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        texts = ["" if t is None else t for t in batch["text"]]
        for low, high in slices(texts):
            elements, times, _, counts, keys = _sets(texts[low:high])
            own = np.split(occurrences(elements, times).view(np.int64), np.cumsum(counts)[:-1])
            yield pd.DataFrame({"k1": keys[:, 0], "k2": keys[:, 1], "shingles": own})


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document (``doc_id``, ``text``): ``doc_id``, ``k1``, ``k2``, ``group_id``, ``kept``.

    Two documents are linked if they have the same words, or if their five-word shingles, weighted by how often
    each occurs, have a Jaccard similarity of ``SIMILARITY`` or more; groups are what links connect.  ``group_id`` is the
    smallest ``doc_id`` of the group, and that document is kept.  A text of fewer than five words has one
    shingle; very long ones are read whole.  Texts without words, null ones too, are linked with nothing: ``group_id`` is their own id and
    all are kept.  Every row is returned: a ``doc_id`` with several texts is as many documents, rows that
    repeat both are one.  Null ids come last; a group without any id has a null ``group_id`` and keeps one
    text.  An empty table gives no rows; other columns are ignored.  ``k1``, ``k2`` tell word sequences apart.

    Same texts are first made one; groups of them are only counted.  In a band, members are compared with
    one of them, chosen anew for each band, so thousands of copies give no more comparisons than rows.  Where
    members that this leaves apart may still be alike, the bucket is cut into blocks, and pairs of blocks are
    compared in tasks that return links only.
    """
    rows = stored(
        docs.selectExpr("bigint(doc_id) AS doc_id", "text").mapInArrow(
            _signed, "doc_id bigint, k1 bigint, k2 bigint, size int, bands array<bigint>"
        ),
        "signatures",
    )
    nodes = stored(
        rows.where("size > 0").groupBy("k1", "k2").agg(F.min("doc_id").alias("doc_id"), F.first("size").alias("size"), F.first("bands").alias("bands"))
        .select(F.monotonically_increasing_id().alias("node"), "*"),
        "nodes",
    )
    buckets = nodes.select("node", F.explode("bands").alias("band"))
    # The order of the nodes differs from band to band, so different members are chosen.
    chosen = buckets.groupBy("band").agg(F.min(F.expr("node ^ band")).alias("c"), F.count("*").alias("members")).where("members > 1")
    buckets = stored(buckets.join(chosen, "band").selectExpr("band", "node", "members", "c ^ band AS center"), "buckets")
    pairs = buckets.where("node <> center").selectExpr("least(node, center) AS a", "greatest(node, center) AS b").distinct()
    sizes = nodes.select("node", "size")
    pairs = stored(
        pairs.join(sizes.toDF("a", "m"), "a").join(sizes.toDF("b", "n"), "b").where(f"least(m, n) >= {SIMILARITY} * greatest(m, n)").select("a", "b"),
        "pairs",
    )
    crowded = buckets.where("members > 2")
    needed = pairs.selectExpr("explode(array(a, b)) AS node").union(crowded.select("node")).distinct()
    sets = stored(_sets_of(docs, nodes.join(needed, "node")), "sets")
    links = stored(_verified(pairs, sets), "verified")
    stars = components(links)
    rest = _compared_in_blocks(_unresolved(crowded, stars), sets)
    stars = components(links.union(rest))
    group = nodes.join(stars, "node", "left").selectExpr("k1", "k2", "doc_id", "coalesce(component, node) AS component")
    first = group.groupBy("component").agg(F.min(F.expr("struct(doc_id IS NULL AS unnamed, doc_id, k1, k2)")).alias("first"))
    named = group.join(first, "component").select("k1", "k2", "first")
    without = rows.where("size = 0").selectExpr("doc_id", "k1", "k2", "doc_id AS group_id", "true AS kept")
    return rows.where("size > 0").join(named, ["k1", "k2"]).selectExpr(
        "doc_id", "k1", "k2", "first.doc_id AS group_id", "doc_id <=> first.doc_id AND k1 = first.k1 AND k2 = first.k2 AS kept"
    ).union(without)


def _sets_of(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node``, ``shingles`` of the nodes, from the texts of their documents."""
    wanted = nodes.selectExpr("node", "k1", "k2", "doc_id AS d")
    texts = docs.selectExpr("bigint(doc_id) AS doc_id", "text").join(
        wanted.select("d").distinct(), F.col("doc_id").eqNullSafe(F.col("d")), "left_semi"
    )
    found = texts.select("text").mapInPandas(_shingled, "k1 bigint, k2 bigint, shingles array<bigint>")
    return found.join(wanted.drop("d"), ["k1", "k2"]).select("node", "shingles").dropDuplicates(["node"])


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    a = sets.selectExpr("node AS a", "shingles AS a_shingles")
    b = sets.selectExpr("node AS b", "shingles AS b_shingles")
    both = "size(array_intersect(a_shingles, b_shingles))"
    return (
        pairs.join(a, "a").join(b, "b")
        .selectExpr("a", "b", f"{both} AS n", "size(a_shingles) + size(b_shingles) AS m")
        .where(f"n >= {SIMILARITY} * (m - n)")
        .select("a", "b")
    )


def _unresolved(buckets: DataFrame, stars: DataFrame) -> DataFrame:
    """Members of buckets where others than the chosen one belong to different components."""
    labelled = stored(
        buckets.join(stars, "node", "left").selectExpr("band", "node", "center", "members", "coalesce(component, node) AS component"), "labelled"
    )
    mixed_bands = (
        labelled.where("node <> center").groupBy("band").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x < y")
    )
    return labelled.where("node <> center").join(mixed_bands.select("band"), "band").select("band", "node", "members", "component")


def _compared_in_blocks(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Links ``a``, ``b`` between members of a bucket that are in different components, by pairs of blocks."""
    blocks = members.selectExpr("*", f"int(ceil(members / {BLOCK})) AS blocks").selectExpr("*", "int(pmod(xxhash64(node), blocks)) AS block")
    dealt = blocks.selectExpr(
        "band", "node", "component", "block",
        "explode(transform(sequence(0, blocks - 1), i -> struct(least(i, block) AS low, greatest(i, block) AS high))) AS pair",
    )
    return (
        dealt.join(sets, "node")
        .selectExpr("band", "pair.low AS low", "pair.high AS high", "node", "component", "block", "shingles")
        .groupBy("band", "low", "high")
        .applyInPandas(_block_links, "a bigint, b bigint")
    )


def _block_links(group: pd.DataFrame) -> pd.DataFrame:
    """All members of one block against all of the other, or against each other if the blocks are one."""
    sizes = group["shingles"].map(len).to_numpy()
    _, place, times = np.unique(np.concatenate(group["shingles"].to_list()), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(group)), sizes)
    common = times[place] > 1
    owner, place = owner[common], (np.cumsum(times > 1) - 1)[place[common]]
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    block, component, node = (group[c].to_numpy() for c in ("block", "component", "node"))
    one = group["low"].iloc[0] == group["high"].iloc[0]
    shared = np.zeros((len(group), len(group)), dtype=np.float32)
    for low in range(0, int((times > 1).sum()), _COLUMNS):
        part = slice(*np.searchsorted(place, (low, low + _COLUMNS)))
        has = np.zeros((len(group), _COLUMNS), dtype=np.float32)
        has[owner[part], place[part] - low] = 1
        shared += has @ has.T
    alike = shared >= SIMILARITY * (sizes[:, None] + sizes[None, :] - shared)
    alike &= component[:, None] != component[None, :]
    if not one:
        alike &= block[:, None] != block[None, :]
    a, b = np.nonzero(np.triu(alike, 1))
    return pd.DataFrame({"a": node[a], "b": node[b]})


def deduplicated(docs: DataFrame) -> DataFrame:
    """The documents that ``near_duplicates`` keeps, with all their columns, whatever their names.

    Rows that repeat id and text are one, unless the text has no words: those are all kept.
    """
    found = near_duplicates(docs).where("kept")
    kept = stored(found.groupBy("doc_id", "k1", "k2").agg(F.count("*").alias("rows")), "kept").toDF("d", "x", "y", "rows")
    key = F.pandas_udf(_text_keys, "k1 bigint, k2 bigint")
    keyed = docs.select(passed(docs), F.col("doc_id").cast("bigint").alias("doc_id"), key("text").alias("key"))
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("key.k1") == F.col("x")) & (F.col("key.k2") == F.col("y"))
    once = keyed.join(kept.where("rows = 1 OR x = 0 AND y = 0"), same, "left_semi").select("row.*")
    repeated = keyed.join(kept.where("rows > 1 AND NOT (x = 0 AND y = 0)"), same, "left_semi")
    return once.union(repeated.dropDuplicates(["doc_id", "key"]).select("row.*"))


def _text_keys(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        texts = ["" if t is None else t for t in batch]
        keys = [_sets(texts[low:high])[-1] for low, high in slices(texts)]
        yield pd.DataFrame(np.concatenate(keys), columns=["k1", "k2"])
