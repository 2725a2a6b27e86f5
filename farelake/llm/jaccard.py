"""Join of documents by the Jaccard similarity of their word n-grams, and its connected components.

A document's shingles are ordered rare-first: by the frequency class of a fixed-size table of hashed counts over all
documents, then by hash. Two sets that reach the threshold share a shingle in their prefixes, so only prefixes are
joined.

1. Buckets of documents exchange the hashes of their prefix shingles and learn which recur. Only documents with a
   recurring prefix shingle can have partners; of equal sets, one stands for all (a *class*).
2. Classes meet on prefix shingles, where length, positional and suffix filters drop most pairs.
3. What is left is verified by the exact intersection of the two sets.

A large group of near copies has a quadratic number of links, of which a component needs few; and one of copies that are
just too far from each other has as many pairs that pass the filters, but no links. So classes meet in two rounds. In the
first, each shingle's classes are paired with a few *leaders* among them only. Then components are formed. In the second
round only those postings are kept that pass the filters with one of another component, and the sets travel to them: all
pairs are compared where they meet, each at the first shingle that it shares, and a link is written only if it joins two
components. So no link between different components is lost, and no step writes more rows than a few for each posting.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelake.llm import common
from farelake.llm.common import Words, in_sorted, mix, pack, packed_schema, unpack
from farelake.session import materialize

_COUNT_BITS = 22  # the frequency table has so many cells for any corpus
_SUFFIX_CELLS = 128
_SIEVE_BITS = 23  # cells of the fixed-size sieve of wanted documents
_LEADERS = 3
_BLOCK = 1 << 20  # shingles of the classes of one block
_COMPARED = 1 << 19  # shingles that one set is compared with at a time
_TOGETHER_BYTES = 512 << 10  # of texts
_BUCKET_BYTES = 4 << 20


# --- shingle sets ------------------------------------------------------------------------------------------


def _sets(column, shingle: int, classes: np.ndarray | None) -> Iterator[np.ndarray]:
    """The distinct shingles of each text, rare first: the class in the upper 8 bits, 56 bits of the hash below.

    Made for a few texts at a time: what is held for all their bytes and words goes before the next ones come.
    """
    sizes = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy().astype(np.int64))
    at = 0
    while at < len(column):
        low = int(sizes[at - 1]) if at else 0
        upto = max(at + 1, int(np.searchsorted(sizes, low + _TOGETHER_BYTES, "right")))
        yield from _sets_together(column.slice(at, upto - at), shingle, classes)
        at = upto


def _sets_together(column, shingle: int, classes: np.ndarray | None) -> Iterator[np.ndarray]:
    words = Words(column, lower=True)
    counts = np.diff(words.at)
    places, hashes = words.grams(shingle)
    if classes is not None:
        cell = (hashes >> np.uint64(64 - _COUNT_BITS)).astype(np.int64)
        hashes = (hashes >> np.uint64(8)) | (classes[cell].astype(np.uint64) << np.uint64(56))
    cuts = np.searchsorted(places, words.at)
    for i, n in enumerate(counts.tolist()):
        if n >= shingle:
            yield np.unique(hashes[cuts[i] : cuts[i + 1]])
        elif n:  # the whole sequence is the only shingle
            value = np.uint64(n)
            for h in words.hashes[words.at[i] : words.at[i + 1]]:
                value = mix(np.array([value]) ^ h)[0]
            yield np.array([value >> np.uint64(8)], np.uint64)
        else:
            yield np.empty(0, np.uint64)


def frequency_classes(docs: DataFrame, shingle: int) -> np.ndarray:
    """For each cell of the hashed count table, the logarithm of how many shingles of all documents fall into it."""
    cells = 1 << _COUNT_BITS
    slices = 64

    def count(batches):
        total = np.zeros(cells, np.int32)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                _, hashes = Words(batch.slice(at, 512).column("text"), lower=True).grams(shingle)
                found, n = np.unique(hashes >> np.uint64(64 - _COUNT_BITS), return_counts=True)
                total[found.astype(np.int64)] += n.astype(np.int32)
        # A task's counts end at 255: from there on a shingle is frequent whatever the exact number.
        parts = np.minimum(total, 255).astype(np.uint8).reshape(slices, -1)
        yield pa.RecordBatch.from_arrays([pa.array(range(slices), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())], ["part", "counts"])

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, np.uint8).astype(np.int64) for x in table.column("counts").to_pylist())
        classes = np.minimum(np.log2(total + 1.0) * 4, 254).astype(np.uint8)
        return pa.table({"part": table.column("part")[:1], "counts": pa.array([classes.tobytes()], pa.binary())})

    schema = "part int, counts binary"
    rows = docs.select("text").mapInArrow(count, schema).groupBy("part").applyInArrow(add, schema).collect()  # 4 MB for any corpus
    table = np.zeros(cells, np.uint8).reshape(slices, -1)
    for r in rows:
        table[r["part"]] = np.frombuffer(r["counts"], np.uint8)
    return table.reshape(-1)


class Threshold:
    """``num / den``: exact integer forms of the bounds that follow from a Jaccard threshold."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den

    def prefix(self, n):
        """Length of the prefix in which a set of ``n`` must share a shingle with any partner."""
        return n - -(-self.num * n // self.den) + 1

    def overlap(self, n, m):
        """The least intersection with which sets of ``n`` and ``m`` reach the threshold."""
        return -(-self.num * (n + m) // (self.num + self.den))


# --- classes and postings ------------------------------------------------------------------------------------

_MEMBER = "doc_id long, n_shingles long, signature binary, prefix binary, places binary, suffix binary"
_MEMBER_NAMES = ("doc_id", "n_shingles", "signature", "prefix", "places", "suffix")


def _signature(s: np.ndarray) -> bytes:
    """128 bits that equal sets share."""
    return np.array([mix(s).sum(dtype=np.uint64), mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)], np.uint64).tobytes()


def _members(docs: DataFrame, shingle: int, threshold: Threshold, classes: np.ndarray) -> DataFrame:
    """Every document with its set's size and signature. One of each bucket's equal sets also has its recurring prefix
    shingles, if there are any, their places, and how many of its shingles fall into each of a few cells (which bounds
    the difference of two sets from below)."""
    buckets = common.bucket_count(docs, _BUCKET_BYTES)
    parts = max(64, buckets // 4)
    texts = common.bucketed(docs.select("doc_id", "text"), buckets).select("_bucket", "_id", "_text")
    shared = docs.sparkSession.sparkContext.broadcast(classes)

    def prefixes(table: pa.Table) -> pa.Table:
        # Of each set only the prefix is kept, mixed: partitions are ranges, and shingles begin with their class.
        sets = _sets(table.column("_text"), shingle, shared.value)
        cut = list({_signature(s): mix(s[: threshold.prefix(len(s))]) for s in sets if len(s)}.values())
        hashes, counts = np.unique(np.concatenate(cut) if cut else np.empty(0, np.uint64), return_counts=True)
        return pack(table.column("_bucket")[0].as_py(), parts, hashes, counts > 1)

    def members(table: pa.Table, answer: pa.Table) -> pa.Table:
        again = np.sort(unpack(answer, "_c0", "<u8"))
        ids = common.ids_of(table.column("_id")).tolist() if table.num_rows else []
        rows: list[list] = []
        first: dict[bytes, int] = {}  # of equal sets, the row with the smallest id: it keeps the prefix for all
        for doc_id, s in zip(ids, _sets(table.column("_text"), shingle, shared.value) if ids else (), strict=True):
            signature = _signature(s)
            rows.append([doc_id, len(s), signature, None, None, None])
            held = first.get(signature)
            if not len(s) or held is not None and rows[held][0] <= doc_id:
                continue
            first[signature] = len(rows) - 1
            if held is not None:
                rows[-1][3:], rows[held][3:] = rows[held][3:], [None] * 3
                continue
            places = np.flatnonzero(in_sorted(mix(s[: threshold.prefix(len(s))]), again)).astype(np.int32)
            if len(places):
                cells = np.bincount((s >> np.uint64(20)).astype(np.int64) % _SUFFIX_CELLS, minlength=_SUFFIX_CELLS)
                rows[-1][3:] = s[places].tobytes(), places.tobytes(), np.minimum(cells, 255).astype(np.uint8).tobytes()
        columns = list(zip(*rows, strict=True)) or [()] * 6
        kinds = (pa.int64(), pa.int64(), *[pa.binary()] * 4)
        return pa.table({n: pa.array(c, k) for n, c, k in zip(_MEMBER_NAMES, columns, kinds, strict=True)})

    recurring = common.recurring(texts.groupBy("_bucket").applyInArrow(prefixes, packed_schema(2)))
    return texts.groupBy("_bucket").cogroup(recurring.groupBy("_bucket")).applyInArrow(members, _MEMBER)


_POSTING = "shingle long, rep long, n int, place int, earlier int, shared int, suffix binary"
_POSTING_NAMES = ("rep", "n", "place", "earlier", "shared", "suffix", "component")


def _postings(classes: DataFrame) -> DataFrame:
    """A row for each recurring prefix shingle of each class; ``shared``: how many of those the class has, ``earlier``:
    how many of them come before this one."""

    def each(batches):
        for batch in batches:
            columns: list[list] = [[], [], [], [], [], [], []]
            wanted = [batch.column(c).to_pylist() for c in ("rep", "n_shingles", "prefix", "places", "suffix")]
            for rep, n, prefix, places, suffix in zip(*wanted, strict=True):
                shingles = np.frombuffer(prefix, np.int64).tolist()
                columns[0] += shingles
                columns[1] += [rep] * len(shingles)
                columns[2] += [n] * len(shingles)
                columns[3] += np.frombuffer(places, np.int32).tolist()
                columns[4] += range(len(shingles))
                columns[5] += [len(shingles)] * len(shingles)
                columns[6] += [suffix] * len(shingles)
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary())
            names = ["shingle", "rep", "n", "place", "earlier", "shared", "suffix"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return classes.select("rep", "n_shingles", "prefix", "places", "suffix").mapInArrow(each, _POSTING)


# --- candidate pairs -------------------------------------------------------------------------------------------


class _Group:
    """The postings of one shingle, sorted by set size; ``order``: the rows that they come from."""

    def __init__(self, rows, rep, n, place, earlier, shared, suffix, component):
        order = np.argsort(n[rows], kind="stable")
        self.order = rows = rows[order]
        self.rep, self.component, self.suffix = rep[rows], component[rows], suffix[rows]
        self.n, self.place, self.earlier, self.shared = (x[rows].astype(np.int64) for x in (n, place, earlier, shared))

    def leaders(self) -> np.ndarray:
        """The members that share most of their prefix with others, and so are likely in the middle of a group; and
        one by chance, which is the same for all shingles of a group."""
        chance = mix(self.rep.view(np.uint64))
        central = np.lexsort((chance, -self.shared))[: _LEADERS - 1]
        return np.unique(np.append(central, chance.argmin()))

    def probes(self) -> np.ndarray:
        """All but the members of the largest component, to which they are all compared."""
        _, inverse, sizes = np.unique(self.component, return_inverse=True, return_counts=True)
        return np.flatnonzero(inverse != sizes.argmax())

    def partners(self, i: int, threshold: Threshold) -> np.ndarray:
        """Members that pass the length, positional and suffix filters with member ``i``."""
        n = int(self.n[i])
        low = np.searchsorted(self.n, -(-threshold.num * n // threshold.den))
        high = np.searchsorted(self.n, threshold.den * n // threshold.num, "right")
        among = np.arange(low, high)
        among = among[self.component[among] != self.component[i]]
        least = threshold.overlap(n, self.n[among])
        # Both sets have one order, so what they share from here on is in what is left of either; what they share
        # before is in both prefixes, so it recurs, and is no more than the fewer of the recurring ones before.
        left = np.minimum(n - self.place[i], self.n[among] - self.place[among])
        before = np.minimum(self.earlier[i], self.earlier[among])
        keep = left + before >= least
        among, least = among[keep], least[keep]
        # Cell by cell, the sets differ by at least the difference of their counts.
        kept = [among[:0]]
        for at in range(0, len(among), 4096):
            some = among[at : at + 4096]
            apart = np.abs(self.suffix[some].astype(np.int16) - self.suffix[i].astype(np.int16)).sum(axis=1)
            kept.append(some[(n + self.n[some] - apart) // 2 >= least[at : at + 4096]])
        return np.concatenate(kept)


def _groups(table: pa.Table, *keys: str) -> Iterator[_Group]:
    """The postings of a table by ``keys``, where there are several, of more than one component."""
    by = [table.column(k).to_numpy() for k in keys]
    order = np.lexsort(by[::-1])
    fresh = np.any([k[order][1:] != k[order][:-1] for k in by], axis=0)
    cuts = np.concatenate([[0], np.flatnonzero(fresh) + 1, [len(order)]]).tolist()
    columns = {c: table.column(c).to_numpy() for c in _POSTING_NAMES if c != "suffix"}
    columns["suffix"] = np.frombuffer(b"".join(table.column("suffix").to_pylist()), np.uint8).reshape(-1, _SUFFIX_CELLS)
    component = columns["component"]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        rows = order[a:b]
        if b - a > 1 and (component[rows] != component[rows[0]]).any():
            yield _Group(rows, **columns)


def _dealt(postings: DataFrame, parts: int):
    return postings.withColumn("_part", F.pmod(F.xxhash64("shingle"), F.lit(parts))).groupBy("_part")


def _leader_pairs(postings: DataFrame, threshold: Threshold, parts: int) -> DataFrame:
    """Distinct candidate pairs (a < b) of classes with the leaders of a shingle; in a small group, all."""

    def meet(table: pa.Table) -> pa.Table:
        pairs: set[tuple[int, int]] = set()
        for group in _groups(table, "shingle"):
            size = len(group.rep)
            for i in (group.leaders() if size > _LEADERS + 1 else np.arange(1, size)).tolist():
                own = int(group.rep[i])
                pairs.update((min(own, o), max(own, o)) for o in group.rep[group.partners(i, threshold)].tolist())
        found = np.array(sorted(pairs), np.int64).reshape(-1, 2)
        return pa.table({"a": found[:, 0], "b": found[:, 1]})

    return _dealt(postings, parts).applyInArrow(meet, "a long, b long").distinct()


def _open_postings(postings: DataFrame, threshold: Threshold, parts: int) -> DataFrame:
    """Postings that pass the filters with one of another component, where neither is a leader: those were compared."""

    def meet(table: pa.Table) -> pa.Table:
        wanted = np.zeros(table.num_rows, bool)
        for group in _groups(table, "shingle"):
            if len(group.rep) <= _LEADERS + 1:
                continue  # all pairs were compared
            led = np.zeros(len(group.rep), bool)
            led[group.leaders()] = True
            for i in group.probes().tolist():
                if led[i]:
                    continue
                found = group.partners(i, threshold)
                found = found[~led[found]]
                if len(found):
                    wanted[group.order[i]] = True
                    wanted[group.order[found]] = True
        return table.select(["shingle", *_POSTING_NAMES]).filter(pa.array(wanted))

    return _dealt(postings, parts).applyInArrow(meet, f"{_POSTING}, component long")


def _blocks(postings: DataFrame) -> DataFrame:
    """The postings with their ``_own`` block of the shingle, once for each cell (``_low``, ``_high``) of two blocks that
    it has a part in. Most shingles have one block; of a large group, every two classes still meet in one cell."""
    sizes = postings.groupBy("shingle").agg(F.ceil(F.sum(F.col("n").cast("long")) / F.lit(_BLOCK)).cast("int").alias("_blocks"))
    own = F.pmod(F.xxhash64("rep"), F.col("_blocks")).cast("int")
    placed = postings.join(sizes, "shingle").withColumn("_own", own)
    placed = placed.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    cell = F.least("_own", "_other").alias("_low"), F.greatest("_own", "_other").alias("_high")
    return placed.select(*postings.columns, "_own", *cell)


def _reaching(sets: list[np.ndarray], places: np.ndarray, i: int, among: np.ndarray, threshold: Threshold) -> np.ndarray:
    """Which of ``among`` reach the threshold with set ``i``, of those that share no shingle before their place."""
    heads = [sets[j][: places[j]] for j in among]
    cuts = np.concatenate([[0], np.cumsum([len(h) for h in heads])])
    met = np.concatenate([[0], np.cumsum(in_sorted(np.concatenate(heads), sets[i][: places[i]]))])
    among = among[met[cuts[1:]] == met[cuts[:-1]]]
    if not len(among):
        return among
    sizes = np.array([len(sets[j]) for j in among], np.int64)
    met = in_sorted(np.concatenate([sets[j] for j in among]), sets[i])
    shared = np.add.reduceat(met.astype(np.int64), np.cumsum(sizes) - sizes)
    return among[threshold.den * shared >= threshold.num * (len(sets[i]) + sizes - shared)]


def _joining_links(postings: DataFrame, sets: DataFrame, threshold: Threshold) -> DataFrame:
    """Links (a, b) between classes of different components, from postings in blocks and their classes' (rep, shingles),
    which go once to each partition. It writes only links that join what its earlier ones have not joined: fewer than it
    has classes."""
    # A class has postings in at most all partitions; so many of its postings count as may come to different ones.
    held = postings.groupBy("rep").agg((F.max("n").cast("long") * F.least(F.count("*"), F.lit(64))).alias("held"))
    size = 8 * held.agg(F.coalesce(F.sum("held"), F.lit(0))).first()[0]
    part = F.pmod(F.xxhash64("shingle", "_low", "_high"), F.lit(max(64, -(-size // _BUCKET_BYTES))))
    dealt = postings.withColumn("_part", part)
    given = dealt.select("rep", F.col("_part").alias("_to")).distinct().join(sets, "rep").select("_to", F.col("rep").alias("_of"), "shingles")

    def link(table: pa.Table, given: pa.Table) -> pa.Table:
        known = {r: np.frombuffer(s, np.uint64) for r, s in zip(*(given.column(c).to_pylist() for c in ("_of", "shingles")), strict=True)}
        owns = table.column("_own").to_numpy()
        apart = table.column("_low").to_numpy() != table.column("_high").to_numpy()
        joined: dict[int, int] = {}
        links: list[tuple[int, int]] = []

        def root(component: int) -> int:
            while (above := joined.get(component, component)) != component:
                joined[component] = joined.get(above, above)
                component = above
            return component

        for group in _groups(table, "shingle", "_low", "_high"):
            members = [known[r] for r in group.rep.tolist()]
            own = owns[group.order]
            crossed = apart[group.order[0]]  # the pairs inside each block meet in the block's own cell
            for i in group.probes().tolist():
                found = group.partners(i, threshold)
                if crossed:
                    found = found[own[found] != own[i]]
                step = max(1, _COMPARED // len(members[i]))
                for at in range(0, len(found), step):
                    mine = root(int(group.component[i]))
                    some = found[at : at + step]
                    some = some[np.array([root(c) != mine for c in group.component[some].tolist()], bool)]
                    for j in _reaching(members, group.place, i, some, threshold).tolist() if len(some) else ():
                        x, y = root(int(group.component[i])), root(int(group.component[j]))
                        if x != y:
                            joined[max(x, y)] = min(x, y)
                            links.append((int(group.rep[i]), int(group.rep[j])))
        found = np.array(links, np.int64).reshape(-1, 2)
        return pa.table({"a": found[:, 0], "b": found[:, 1]})

    return dealt.groupBy("_part").cogroup(given.groupBy("_to")).applyInArrow(link, "a long, b long").distinct()


def _sieve(wanted: DataFrame) -> np.ndarray:
    """A bit for each cell that a wanted id falls into; of fixed size, so it also passes a few others."""
    cell = F.pmod(F.xxhash64("least"), F.lit(1 << _SIEVE_BITS))
    bits = F.bit_or(F.expr("shiftleft(1L, cast(cell % 64 as int))"))
    words = wanted.select(cell.alias("cell")).groupBy(F.expr("cell div 64").alias("word")).agg(bits.alias("bits")).collect()
    table = np.zeros(1 << (_SIEVE_BITS - 6), np.int64)
    for r in words:  # at most 131,072, for any number of ids
        table[r["word"]] = r["bits"]
    return table


def _shingles_of(docs: DataFrame, wanted: DataFrame, shingle: int, classes: np.ndarray) -> DataFrame:
    """(rep, shingles) of the classes in ``wanted`` (rep, least, signature), from the text of document ``least``.

    A sieve of fixed size keeps most other documents' sets from being made and moved; the join keeps the rest.
    """
    shared = docs.sparkSession.sparkContext.broadcast((_sieve(wanted), classes))

    def each(batches):
        bits, ranks = shared.value
        for batch in batches:
            cell = batch.column("_cell").to_numpy()
            keep = (bits[cell >> 6] >> (cell & 63)) & 1 == 1
            part = batch.filter(pa.array(keep))
            for at in range(0, part.num_rows, 64):
                some = part.slice(at, 64)
                sets = [(_signature(s), s.tobytes()) for s in _sets(some.column("text"), shingle, ranks)]
                columns = [pa.array([s[i] for s in sets], pa.binary()) for i in range(2)]
                yield pa.RecordBatch.from_arrays([some.column("_id"), *columns], ["_id", "_signature", "shingles"])

    given = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(common.NO_ID)).alias("_id"),
        F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("long"), F.lit(common.NO_ID))), F.lit(1 << _SIEVE_BITS)).alias("_cell"),
        "text",
    )
    found = given.mapInArrow(each, "_id long, _signature binary, shingles binary")
    chosen = found.join(wanted, (F.col("_id") == F.col("least")) & (F.col("_signature") == F.col("signature")))
    chosen = chosen.dropDuplicates(["rep"])  # rows that repeat an id
    return chosen.select("rep", "shingles")


def _verified(pairs: DataFrame, sets: DataFrame, threshold: Threshold) -> DataFrame:
    """Which of the stored pairs have sets that reach the threshold, each compared once."""

    def each(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("sa").to_pylist(), batch.column("sb").to_pylist(), strict=True):
                s, t = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                shared = len(np.intersect1d(s, t, assume_unique=True))
                keep.append(threshold.den * shared >= threshold.num * (len(s) + len(t) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = sets.select(F.col("rep").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("rep").alias("b"), F.col("shingles").alias("sb"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb").mapInArrow(each, "a long, b long")


# --- components -------------------------------------------------------------------------------------------------


def components(links: DataFrame) -> DataFrame:
    """(rep, component) for every node of ``links`` (a, b): the smallest node that it reaches.

    Alternates large stars and small stars, each one aggregation, until nothing changes: a number of rounds that grows
    with the logarithm of the longest chain. Every round is written to the shared folder.
    """
    edges = materialize(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # Large star: the larger neighbours of a node go to its smallest one.
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(large.where("u <> v").distinct(), "large-star")
        # Small star: the smaller neighbours, and the node itself, go to the smallest one.
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(smallest.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        small = materialize(small, "small-star")
        changed = small.exceptAll(edges).limit(1).count() + edges.exceptAll(small).limit(1).count()
        edges = small
        if not changed:
            break
    roots = edges.select(F.col("v").alias("rep")).distinct().select("rep", F.col("rep").alias("component"))
    return edges.select(F.col("u").alias("rep"), F.col("v").alias("component")).unionByName(roots)


def similar_documents(docs: DataFrame, shingle: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id that is reached by links, its own included).

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; a text with fewer words than a shingle has one shingle of all
    its words; a null or empty text has none and links with nothing. Documents link when the Jaccard similarity of
    their sets is at least ``num / den``. Rows that repeat an id are returned each; a null id comes back as null, and is
    no component's id unless nothing else is in it; an empty table gives no rows; other columns are ignored.
    """
    common.bounded_batches(docs.sparkSession)
    threshold = Threshold(num, den)
    ranks = frequency_classes(docs, shingle)
    members = materialize(_members(docs, shingle, threshold, ranks), "members")

    by_set = members.where("n_shingles > 0").groupBy("signature").agg(F.min("doc_id").alias("least"))
    by_set = by_set.withColumn("rep", F.xxhash64("signature"))
    candidates = members.where(F.col("prefix").isNotNull())
    same = (F.col("doc_id") == F.col("least")) & (F.col("signature") == F.col("_signature"))
    chosen = candidates.join(by_set.withColumnRenamed("signature", "_signature"), same)
    classes = chosen.select("rep", "least", "signature", "n_shingles", "prefix", "places", "suffix")
    classes = materialize(classes.dropDuplicates(["rep"]), "classes")
    parts = max(64, common.bucket_count(classes, _BUCKET_BYTES))

    def sets_of(reps: DataFrame) -> DataFrame:
        wanted = materialize(classes.select("rep", "least", "signature").join(reps, "rep", "left_semi"), "wanted")
        return materialize(_shingles_of(docs, wanted, shingle, ranks), "shingles")

    postings = materialize(_postings(classes), "postings")
    alone = postings.withColumn("component", F.col("rep"))
    pairs = materialize(_leader_pairs(alone, threshold, parts), "pairs")
    sets = sets_of(pairs.select(F.explode(F.array("a", "b")).alias("rep")).distinct())
    links = materialize(_verified(pairs, sets, threshold), "links")
    first = materialize(components(links), "components")
    labelled = postings.join(first, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    left = materialize(_open_postings(labelled, threshold, parts), "open")
    sets = sets_of(left.select("rep").distinct())
    more = materialize(_joining_links(materialize(_blocks(left), "blocks"), sets, threshold), "links")

    # Each class goes to its component, and that to the smallest id in it.
    placed = by_set.join(components(links.unionByName(more)), "rep", "left")
    placed = placed.select("signature", "least", F.coalesce("component", "rep").alias("component"))
    named = placed.groupBy("component").agg(F.min(F.nullif("least", F.lit(common.NO_ID))).alias("component_id"))
    by_signature = placed.join(named, "component").select("signature", "component_id")
    doc_id = F.nullif(F.col("doc_id"), F.lit(common.NO_ID))
    # Without shingles a document is alone; it has no signature here.
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(doc_id)
    result = members.select("doc_id", "n_shingles", "signature").join(by_signature, "signature", "left")
    return result.select(doc_id.alias("doc_id"), "n_shingles", component.alias("component_id"))


def op8_jaccard(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return similar_documents(docs, shingle=3, num=9, den=10)


OP8_SQL = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), sets AS (
  SELECT doc_id, list_distinct(CASE
    WHEN len(words) = 0 THEN []
    WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 1), lambda i: array_to_string(words[i:i + 2], ' ')) END) AS shingles
  FROM texts
), postings AS (
  SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM sets
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM postings a JOIN postings b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
), reached AS (
  SELECT doc_id AS a, doc_id AS b FROM sets
  UNION
  SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a
)
SELECT doc_id, CAST(len(any_value(shingles)) AS BIGINT) AS n_shingles, min(b) AS component_id
FROM sets JOIN reached ON doc_id = a
GROUP BY doc_id
"""
