"""Fill-in-the-middle documents: a text cut at two places into prefix, middle and suffix, which are put in another order.

The work on the texts is a pyarrow.compute pipeline over slices of a few MB: every unit is marked with a byte that no
UTF-8 text has and the texts are split there into lists of units; the lists are flattened beside the number of the text
that each unit comes from; its ordinal in the text says which role it has; the units of a role are filtered, rebuilt as
lists, and joined. Nothing passes from one row to another, so there is no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelake.llm.common import bounded_batches

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_PERCENT = 10
SPM_PERCENT = 20

_SLICE_BYTES = 4 << 20
_MARK = b"\xff"  # in no UTF-8 text
# A unit, in the bytes of UTF-8: a run of letters A-Z, another ASCII character, or a character of several bytes.
_UNIT = rb"([A-Za-z]+|[\x00-\x40\x5b-\x60\x7b-\x7f]|[\xc0-\xf7][\x80-\xbf]*)"
_OUT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def _draws(doc_id: Column, seed: int) -> list[Column]:
    """The first four groups of eight hex digits of sha256 of ``seed:doc_id``, as integers (a null id: no digits)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]


def _units(texts: pa.Array) -> pa.LargeListArray:
    """The units of each text."""
    marked = pc.replace_substring_regex(texts, pattern=_UNIT, replacement=b"\\1" + _MARK)
    lists = pc.split_pattern(marked, pattern=_MARK).cast(pa.large_list(pa.large_binary()))
    # A mark ends each unit, so every list has an empty piece at its end, which is no unit.
    offsets = lists.offsets.to_numpy()
    last = np.zeros(len(lists.values), bool)
    last[offsets[1:] - 1] = True
    return pa.LargeListArray.from_arrays(pa.array(offsets - np.arange(len(offsets))), lists.values.filter(pa.array(~last)))


def _pieces(units: pa.LargeListArray, cuts: tuple[np.ndarray, np.ndarray]) -> list[pa.Array]:
    """The units before the first cut, between the cuts, and after the second, joined for each text."""
    flat, parent = pc.list_flatten(units), pc.list_parent_indices(units).to_numpy()
    starts = units.offsets.to_numpy()
    ordinal = np.arange(len(flat)) - starts[parent]
    role = (ordinal >= cuts[0][parent]).astype(np.int8) + (ordinal >= cuts[1][parent])
    pieces = []
    for wanted in range(3):
        mine = role == wanted
        sizes = np.bincount(parent[mine], minlength=len(units))
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        lists = pa.LargeListArray.from_arrays(pa.array(offsets), flat.filter(pa.array(mine)))
        pieces.append(pc.binary_join(lists.cast(pa.list_(pa.large_binary())), _scalar(b"")))
    return pieces


def _scalar(value: bytes) -> pa.Scalar:
    return pa.scalar(value, pa.large_binary())


def _chars(pieces: pa.Array) -> pa.Array:
    return pc.utf8_length(pieces.cast(pa.large_string())).cast(pa.int64())


def _infilled(rows: pa.Table, plain_percent: int, spm_percent: int) -> list[pa.Array]:
    """n, form, prefix_chars, middle_chars and output of a slice of documents."""
    texts = pc.fill_null(rows.column("text").combine_chunks().cast(pa.large_string()), "")
    raw = texts.cast(pa.large_binary())
    h1, h2, h3, h4 = (rows.column(f"h{i}").to_numpy() for i in range(1, 5))
    units = _units(raw)
    n = pc.list_value_length(units).to_numpy().astype(np.int64)
    first, second = h1 % (n + 1), h2 % (n + 1)
    prefix, middle, suffix = _pieces(units, (np.minimum(first, second), np.maximum(first, second)))
    plain = (h3 % 100 >= 100 - plain_percent) | (n == 0)
    for sentinel in (PREFIX, SUFFIX, MIDDLE):
        plain |= pc.match_substring(texts, sentinel).to_numpy(zero_copy_only=False)
    spm = h4 % 100 < spm_percent
    form = pa.array(np.where(plain, "plain", np.where(spm, "spm", "psm")), pa.string())
    p, s, m = (_scalar(x.encode()) for x in (PREFIX, SUFFIX, MIDDLE))
    join = pc.binary_join_element_wise
    psm_out, spm_out = join(p, prefix, s, suffix, m, middle, _scalar(b"")), join(s, suffix, p, prefix, m, middle, _scalar(b""))
    output = pc.if_else(pa.array(plain), raw, pc.if_else(pa.array(spm), spm_out, psm_out))
    none = pa.scalar(None, pa.int64())
    counts = [pc.if_else(pa.array(plain), none, _chars(piece)) for piece in (prefix, middle)]
    return [pa.array(n), form, *counts, output.cast(pa.string())]


def _slices(batch: pa.RecordBatch) -> Iterator[pa.Table]:
    """Stretches of a batch with at most 4 MB of text, or one text."""
    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy().astype(np.int64)
    ends, at = np.cumsum(sizes), 0
    while at < len(sizes):
        low = ends[at] - sizes[at]
        upto = max(at + 1, int(np.searchsorted(ends, low + _SLICE_BYTES, "right")))
        yield pa.Table.from_batches([batch.slice(at, upto - at)])
        at = upto


def fill_in_middle(
    docs: DataFrame, seed: int = 1, plain_percent: int = PLAIN_PERCENT, spm_percent: int = SPM_PERCENT
) -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars and output of every document.

    Units are runs of letters A-Z and single other characters. The cuts and the form follow from the seed and the id:
    ``plain_percent`` of the documents stay as they are, ``spm_percent`` of the others put the suffix first. A text that
    has one of the sentinels stays plain, so that the output can be taken apart again. A null or empty text gives an
    empty plain output with n 0; the ``_chars`` of a plain one are null. A null id draws as the empty text. Rows that
    repeat give repeated, equal rows; an empty table gives none; other columns are ignored, whatever their names. Texts
    are taken whole, a long one as a slice of its own.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in _slices(batch):
                columns = [rows.column("doc_id").combine_chunks(), *_infilled(rows, plain_percent, spm_percent)]
                yield pa.RecordBatch.from_arrays(columns, names)

    bounded_batches(docs.sparkSession)
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    drawn = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"), *_draws(F.col("doc_id"), seed))
    return drawn.mapInArrow(each, _OUT)


def restored(form: Column, output: Column) -> Column:
    """The text that an output was made of. Other than in plain ones, the three sentinels occur once each, at the
    borders of the pieces."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    psm, spm = (F.concat(*(F.get(parts, F.lit(i)) for i in order)) for order in ((1, 3, 2), (2, 3, 1)))
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)


def op11_infill(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    made = fill_in_middle(docs.select("doc_id", "text"))
    text = restored(F.col("form"), F.col("output"))
    return made.select(
        *("doc_id", "n", "form", "prefix_chars", "middle_chars"),
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(text.cast("binary"), 256).alias("restored_sha256"),
    )


OP11_SQL = """
with drawn as (
    select doc_id, coalesce(text, '') as text, sha256('1:' || doc_id) as h,
           regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') as units
    from documents),
cut as (
    select *, len(units) as n,
           ('0x' || h[1:8])::bigint % (len(units) + 1) as a, ('0x' || h[9:16])::bigint % (len(units) + 1) as b,
           case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>')
                     or ('0x' || h[17:24])::bigint % 100 >= 90 then 'plain'
                when ('0x' || h[25:32])::bigint % 100 < 20 then 'spm' else 'psm' end as form
    from drawn),
pieces as (
    select *, array_to_string(units[1:least(a, b)], '') as prefix,
           array_to_string(units[least(a, b) + 1:greatest(a, b)], '') as middle,
           array_to_string(units[greatest(a, b) + 1:], '') as suffix
    from cut)
select doc_id, n::bigint as n, form,
       case when form <> 'plain' then length(prefix) end as prefix_chars,
       case when form <> 'plain' then length(middle) end as middle_chars,
       sha256(case form when 'plain' then text
                        when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
       sha256(case form when 'plain' then text else prefix || middle || suffix end) as restored_sha256
from pieces"""
