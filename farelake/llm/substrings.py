"""Removal of passages that other documents have already, with Aho-Corasick automata.

A window is ``window`` consecutive words. A word is removed if a window that covers it also starts in a document with a
smaller id. Documents are dealt into buckets of a few MB; the steps are

1. *Anchors.* Of the ``_ANCHOR``-word grams inside a window, the one with the smallest hash is its anchor; equal windows
   have equal anchors, wherever they stand, and neighbouring windows mostly share theirs. Buckets exchange the hashes
   of their anchors, and learn which recur in another document.
2. *Confirmation.* Only windows on a recurring anchor can recur. Buckets exchange the hashes of these windows with the
   smallest id that has each and the place where it stands, and learn in which bucket, at which place, the document is
   that has one of theirs first: its owner.
3. *Phrases.* Places are counted in cells of ``_CELL`` windows of one document. Every bucket asks the owners' buckets for
   the words of the cells it needs; a cell's words are cut out of the owner's text once and joined to those who asked.
4. *Automata.* Each bucket compiles the windows it asked for, as the owners' words, into automata of bounded size, one
   for each portion of its documents that may hold some, and streams these through. Only their matches count: a word
   goes because it stands, with the words around it, in a text that an owner sent. So hashes that happen to be equal
   never remove a word.

Every exchanged hash travels once per bucket, so copies and frequent passages cost no more than one bucket each.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice, repeat

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelake.llm import common
from farelake.llm.common import Words, in_sorted, pack, packed_schema, unpack, unpack_rows

WINDOW = 13
_ANCHOR = 5
_CELL = 64  # windows; a request has one bit for each
_AGAIN = np.uint32(1 << 31)  # marks a place whose window stands in several documents of its bucket
_SLICE_BYTES = 1 << 18  # text of an automaton's documents
_NODES = 750_000  # of an automaton, at about 64 bytes each
_SECOND = 256  # codes of a word's second character
_OTHER_WORD = "\x01\x02"


def _windows(words: Words, window: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window: the place of its first word, and its anchor."""
    short = min(_ANCHOR, window)
    places, hashes = words.grams(short)
    grams = np.zeros(max(len(words.hashes), 1), np.uint64)
    grams[places] = hashes
    count = len(words.hashes) - window + 1
    if count <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    firsts = np.flatnonzero(words.doc[:count] == words.doc[window - 1 :])
    span, smallest = window - short + 1, grams
    size = 1
    while 2 * size <= span:  # minima over 2, 4, 8 ... places, then of two that overlap
        smallest = np.minimum(smallest[:-size], smallest[size:])
        size *= 2
    return firsts, np.minimum(smallest[firsts], smallest[firsts + span - size])


def _smallest_ids(ids: np.ndarray, *keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each distinct key, in the order of the keys: where the smallest id with it stands, and whether another id has
    it too."""
    order = np.lexsort((ids, *reversed(keys)))
    if not len(order):
        return order, np.empty(0, bool)
    changed = np.zeros(len(order) - 1, bool)
    for key in keys:
        changed |= key[order[1:]] != key[order[:-1]]
    first = np.flatnonzero(np.concatenate([[True], changed]))
    last = np.append(first[1:], len(order)) - 1
    return order[first], ids[order[first]] != ids[order[last]]


def _bucket(table: pa.Table) -> int:
    return table.column("_bucket")[0].as_py()


def _sorted_texts(table: pa.Table) -> pa.Table:
    """(_id, _text) in an order that does not depend on how the rows arrived, so that places hold from step to step."""
    texts = table.select(["_id", "_text"])
    return texts.take(pc.sort_indices(texts, sort_keys=[("_id", "ascending"), ("_text", "ascending")]))


def _first_cells(words: Words) -> np.ndarray:
    """The number of each document's first cell. Documents share no cell."""
    sizes = -(-np.diff(words.at) // _CELL)
    return np.concatenate([[0], np.cumsum(sizes)])


def dedup_passages(docs: DataFrame, window: int = WINDOW, hash_bits: int = 64) -> DataFrame:
    """``_row`` (the document's columns), n_words, n_removed and kept (the kept words, joined by one space).

    Words are ``[^\\x20\\x09-\\x0D]+``, unchanged. A null text has no words; a document of fewer words than a window
    keeps all of them; of equal texts the smallest id keeps its words, rows that repeat an id keep theirs alike; a null
    id counts as smaller than all others; an empty table gives no rows. ``hash_bits``: of anchors and windows; fewer make
    more work, not other rows. (Windows are told apart by these and 32 more bits.)
    """
    common.bounded_batches(docs.sparkSession)
    buckets = common.bucket_count(docs)
    parts = max(64, buckets // 4)
    unused = np.uint64(64 - hash_bits)
    dealt = common.bucketed(docs, buckets)
    texts = dealt.select("_bucket", "_id", "_text", "_row")

    def anchored(words: Words) -> tuple[np.ndarray, np.ndarray]:
        firsts, found = _windows(words, window)
        return firsts, found >> unused << unused

    def anchors(table: pa.Table) -> pa.Table:
        words = Words(table.column("_text"))
        ids = common.ids_of(table.column("_id"))
        firsts, found = anchored(words)
        owner = ids[words.doc[firsts]]
        new = np.flatnonzero(np.concatenate([[True], (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])])) if len(found) else firsts
        owner, found = owner[new], found[new]
        best, several = _smallest_ids(owner, found)
        return pack(_bucket(table), parts, found[best], several)

    def candidates(table: pa.Table, answer: pa.Table) -> pa.Table:
        if not table.num_rows or not answer.num_rows:
            return pack(0, parts, np.empty(0, np.uint64), *[np.empty(0, np.uint8)] * 3)
        sorted_texts = _sorted_texts(table)
        words = Words(sorted_texts.column("_text"))
        firsts, found = anchored(words)
        firsts = firsts[in_sorted(found, np.sort(unpack(answer, "_c0", "<u8")))]
        doc = words.doc[firsts]
        ids = common.ids_of(sorted_texts.column("_id"))[doc]
        hashes, checks = _window_hashes(words, firsts, window)
        hashes = hashes >> unused << unused
        best, several = _smallest_ids(ids, hashes, checks)
        places = (_first_cells(words)[doc] * _CELL + firsts - words.at[doc])[best].astype(np.uint32)
        places[several] |= _AGAIN
        return pack(_bucket(table), parts, hashes[best], checks[best], ids[best], places)

    def confirm(table: pa.Table) -> pa.Table:
        hashes, row = unpack_rows(table, "_c0", "<u8")
        checks, ids, places = (unpack(table, c, k) for c, k in (("_c1", "<u4"), ("_c2", "<i8"), ("_c3", "<u4")))
        order = np.lexsort((ids, checks, hashes))
        changed = (hashes[order[1:]] != hashes[order[:-1]]) | (checks[order[1:]] != checks[order[:-1]])
        first = order[np.flatnonzero(np.concatenate([[True], changed]))]
        owner = np.empty(len(order), np.int64)  # the entry of the same window that has the smallest id
        owner[order] = np.repeat(first, np.diff(np.append(np.flatnonzero(np.concatenate([[True], changed])), len(order))))
        keep = (ids[owner] < ids) | (places >= _AGAIN)
        owner, row = owner[keep], row[keep]
        of = np.array(table.column("_bucket").to_pylist(), np.uint64)
        _, owner_row = unpack_rows(table, "_c0", "<u8")
        where = (of[owner_row[owner]] << np.uint64(32)) | (places[owner] & ~_AGAIN).astype(np.uint64)
        cuts = np.searchsorted(row, np.arange(table.num_rows + 1))
        blobs = [where[a:b].tobytes() for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
        columns = {"_bucket": table.column("_bucket"), "_part": table.column("_part"), "_c0": pa.array(blobs, pa.binary())}
        return pa.table(columns).filter(pa.array(np.diff(cuts) > 0))

    def request(table: pa.Table) -> pa.Table:
        places = np.unique(unpack(table, "_c0", "<u8"))
        cells, first = np.unique(places // np.uint64(_CELL), return_index=True)
        bits = np.uint64(1) << (places % np.uint64(_CELL))
        columns = {
            "_owner": (places[first] >> np.uint64(32)).astype(np.int32),
            "_cell": ((places[first] & np.uint64(0xFFFFFFFF)) // np.uint64(_CELL)).astype(np.int32),
            "_bucket": np.full(len(cells), _bucket(table), np.int32),
            "_wanted": np.bitwise_or.reduceat(bits, first).view(np.int64),
        }
        return pa.table(columns)

    def cut_out(table: pa.Table, wanted: pa.Table) -> pa.Table:
        cells = np.sort(wanted.column("_cell").to_numpy()) if table.num_rows else np.empty(0, np.int32)
        of = _bucket(wanted) if len(cells) else 0
        ids, blobs = np.empty(0, np.int64), []
        if len(cells):
            sorted_texts = _sorted_texts(table)
            words = Words(sorted_texts.column("_text"))
            first_cells = _first_cells(words)
            doc = np.searchsorted(first_cells, cells, "right") - 1
            ids = common.ids_of(sorted_texts.column("_id"))[doc]
            begin = words.at[doc] + (cells - first_cells[doc]) * _CELL
            end = np.minimum(begin + _CELL + window - 1, words.at[doc + 1])
            raw = words.raw.tobytes()
            blobs = [raw[a:b] for a, b in zip(words.starts[begin].tolist(), words.ends[end - 1].tolist(), strict=True)]
        return pa.table(
            {
                "_owner": np.full(len(cells), of, np.int32),
                "_cell": cells.astype(np.int32),
                "_first": ids,
                "_words": pa.array(blobs, pa.binary()),
            }
        )

    def remove(table: pa.Table, phrases: pa.Table) -> pa.Table:
        with common.without_cycles():
            return _results(table, _kept(table, phrases, window))

    recurring = common.recurring(texts.groupBy("_bucket").applyInArrow(anchors, packed_schema(2)))
    windows = _together(texts, recurring, candidates, packed_schema(4))
    confirmed = windows.groupBy("_part").applyInArrow(confirm, packed_schema(1))
    requests = confirmed.groupBy("_bucket").applyInArrow(request, "_owner int, _cell int, _bucket int, _wanted long")
    asked = requests.select(F.col("_owner").alias("_bucket"), "_cell").distinct()
    cells = _together(texts, asked, cut_out, "_owner int, _cell int, _first long, _words binary")
    phrases = requests.join(cells, ["_owner", "_cell"]).select("_bucket", "_wanted", "_first", "_words")
    results = T.StructType.fromDDL("n_words long, n_removed long, kept string")
    return _together(texts, phrases, remove, T.StructType([texts.schema["_row"], *results]))


def _together(texts: DataFrame, answers: DataFrame, function, schema) -> DataFrame:
    return texts.groupBy("_bucket").cogroup(answers.groupBy("_bucket")).applyInArrow(function, schema)


def _window_hashes(words: Words, firsts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of the windows from ``firsts`` on, of 64 and of 32 bits, from different polynomials of their words."""
    value, other = words.hashes[firsts], words.hashes[firsts]
    for j in range(1, window):
        word = words.hashes[firsts + j]
        value = value * np.uint64(0xD1342543DE82EF95) + word
        other = other * np.uint64(0x9FB21C651E98DF25) + word
    return common.mix(value), (common.mix(other) >> np.uint64(32)).astype(np.uint32)


def _coded(texts: Iterator[bytes], codes: dict[bytes, str]) -> list[str]:
    """Each text as the codes of its words. Words that are in no phrase share one code."""
    look = codes.get
    return ["".join(map(look, text.split(), repeat(_OTHER_WORD))) for text in texts]


def _kept(table: pa.Table, phrases: pa.Table, window: int) -> list[tuple[int, int, str]]:
    """For each document its number of words, the number of removed ones, and the kept ones.

    Documents that share phrases are taken together, about ``_SLICE_BYTES`` at a time. The phrases with hashes that
    windows of theirs have are compiled into an automaton, and the documents are streamed through it; documents without
    such a window have no phrase.
    """
    found: dict[int, list[np.ndarray]] = {}
    if table.num_rows and phrases.num_rows:
        # What the hashes were made of is free again before the automata take their memory.
        cell, start, hashes = _asked(phrases, window)
        docs, seen, sizes = _hits(table, hashes, window)
        common.release_memory()
        for some in _alike(docs, cell[np.searchsorted(hashes, seen)], sizes):
            mine = in_sorted(hashes, np.unique(seen[np.isin(docs, some)]))
            _match(table.take(some), phrases, cell[mine], start[mine], window, some.tolist(), found)
    return [_without(text.split(), found.get(doc), window) for doc, text in enumerate(_texts(table))]


def _asked(phrases: pa.Table, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The windows asked for, in the order of their hashes: their cells, where they start in these, and the hashes."""
    cells = Words(phrases.column("_words"))
    places, hashes = cells.grams(window)
    cell = cells.doc[places]
    start = (places - cells.at[cell]).astype(np.int32)
    wanted = phrases.column("_wanted").to_numpy().view(np.uint64)
    asked = (wanted[cell] >> start.astype(np.uint64)) & np.uint64(1) == 1
    order = np.flatnonzero(asked)[np.argsort(hashes[asked], kind="stable")]
    return cell[order], start[order], hashes[order]


def _hits(table: pa.Table, hashes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The windows with one of the sorted ``hashes``: their documents and hashes; and the bytes of all documents."""
    words = Words(table.column("_text"))
    places, seen = words.grams(window)
    hit = in_sorted(seen, hashes)
    return words.doc[places[hit]], seen[hit], np.diff(words.offsets)


def _alike(docs: np.ndarray, cells: np.ndarray, sizes: np.ndarray) -> Iterator[np.ndarray]:
    """Documents in portions of about ``_SLICE_BYTES``, but at least one, in the order of a cell that each may share with
    others: the one of its middle hit. ``docs``, ascending, and ``cells``: one entry for each hit."""
    found, first, count = np.unique(docs, return_index=True, return_counts=True)
    found = found[np.argsort(cells[first + count // 2], kind="stable")]
    upto = np.cumsum(sizes[found])
    begin = 0
    while begin < len(found):
        before = upto[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(upto, before + _SLICE_BYTES, "right")))
        yield found[begin:end]
        begin = end


def _match(part: pa.Table, phrases: pa.Table, cell: np.ndarray, start: np.ndarray, window: int, docs: list[int], found: dict) -> None:
    """Note for each document of ``part`` where phrases of owners with smaller ids begin."""
    used, line_of = np.unique(cell, return_inverse=True)
    sent = phrases.take(used)
    owners = sent.column("_first").to_pylist()
    cells = sent.column("_words").to_pylist()
    known = {word for text in cells for word in text.split()}
    # Two characters a word, the first and the second from different ranges, so that a phrase can match at words only,
    # and a node of the automaton has few branches.
    codes = {w: chr(0x100 + i // _SECOND) + chr(0xE000 + i % _SECOND) for i, w in enumerate(known)}
    coded, lines = _coded(cells, codes), _coded(_texts(part), codes)
    ids = common.ids_of(part.column("_id")).tolist()
    # Equal phrases have one owner, unless more were asked for: the smallest comes last, and replaces the others.
    last = np.argsort(common.ids_of(sent.column("_first"))[line_of], kind="stable")[::-1]
    windows = zip(line_of[last].tolist(), (2 * start[last]).tolist(), strict=True)
    while some := list(islice(windows, max(1, _NODES // (2 * window)))):
        automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for line, i in some:
            automaton.add_word(coded[line][i : i + 2 * window], line)
        automaton.make_automaton()
        for doc, doc_id, line in zip(docs, ids, lines, strict=True):
            begins = [end // 2 + 1 - window for end, owner in automaton.iter(line) if owners[owner] < doc_id]
            if begins:
                found.setdefault(doc, []).append(np.array(begins, np.int32))


def _texts(table: pa.Table) -> Iterator[bytes]:
    return ((text.as_py() or "").encode() for text in table.column("_text"))


def _without(words: list[bytes], found: list[np.ndarray] | None, window: int) -> tuple[int, int, str]:
    """The words that no window from a place in ``found`` covers."""
    if not found:
        return len(words), 0, b" ".join(words).decode()
    starts = np.concatenate(found)
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + window, -1)
    kept = [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]
    return len(words), len(words) - len(kept), b" ".join(kept).decode()


def _results(table: pa.Table, results: list[tuple[int, int, str]]) -> pa.Table:
    columns = list(zip(*results, strict=True)) or [(), (), ()]
    kinds = (pa.int64(), pa.int64(), pa.string())
    arrays = {n: pa.array(list(c), k) for n, c, k in zip(("n_words", "n_removed", "kept"), columns, kinds, strict=True)}
    return pa.table({"_row": table.column("_row")} | arrays)


def op7_substrings(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = dedup_passages(docs)
    return found.select("_row.doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


OP7_SQL = r"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), starts AS (
  SELECT r, doc_id, i, array_to_string(words[i:i + 12], ' ') AS phrase
  FROM (SELECT r, doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM texts)
), owners AS (
  SELECT phrase, min(doc_id) AS first FROM starts GROUP BY phrase
), gone AS (
  SELECT DISTINCT r, unnest(range(i, i + 13)) AS k
  FROM starts JOIN owners USING (phrase)
  WHERE first < doc_id
), words AS (
  SELECT r, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS k FROM texts
), kept AS (
  SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY k) AS kept
  FROM words ANTI JOIN gone USING (r, k)
  GROUP BY r
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (r)
"""
