"""Fill in middle, importance resampling and mixing against brute force, on test tables and on odd rows."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_operators import SF, documents, empty, odd, rows_of, sorted_rows  # noqa: F401

from farelake.llm import infill, mixing, resampling


def digits(seed, doc_id, n):
    text = sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(text[8 * i : 8 * i + 8], 16) for i in range(n)]


# --- 11: fill in middle ------------------------------------------------------------------------------------


def infilled_by_hand(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    h1, h2, h3, h4 = digits(1, doc_id, 4)
    low, high = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = ("".join(x) for x in (units[:low], units[low:high], units[high:]))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, len(units), "plain", None, None, text
    if h4 % 100 < 20:
        return doc_id, len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


TRICKY = ["<P", "a<P>b", "x<S>", "<M>", "<<P", "a\xffb é́ 日本語 𝒳y", "ÿ" * 50, "\n\r\x00Z", "<S" * 100, "P>S>M>" * 30]


def test_infill_equals_brute_force(spark, odd, documents, empty):  # noqa: F811
    tricky = spark.createDataFrame([(i, t) for i, t in enumerate(TRICKY * 30)], "doc_id long, text string")
    for df in (odd, documents, tricky):
        made = infill.fill_in_middle(df)
        assert sorted_rows(made) == sorted((infilled_by_hand(*r) for r in rows_of(df)), key=repr)
    assert infill.fill_in_middle(empty).collect() == []


def test_infill_can_be_undone(spark, odd):  # noqa: F811
    tricky = spark.createDataFrame([(i, t) for i, t in enumerate(TRICKY * 30)], "doc_id long, text string")
    for df in (odd, tricky):
        made = infill.fill_in_middle(df).select("doc_id", infill.restored(F.col("form"), F.col("output")).alias("text"))
        assert sorted(rows_of(made), key=repr) == sorted(((i, t or "") for i, t in rows_of(df)), key=repr)


def test_infill_forms_follow_their_shares(documents):  # noqa: F811
    marked = {i for i, t in rows_of(documents) if not t or re.search("<[PSM]>", t)}
    for percents, form in (((0, 100), "spm"), ((0, 0), "psm"), ((100, 50), "plain")):
        made = infill.fill_in_middle(documents, plain_percent=percents[0], spm_percent=percents[1]).collect()
        assert {r["form"] for r in made if r["doc_id"] not in marked} == {form}


# --- 12: importance resampling -----------------------------------------------------------------------------


def features(text):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    return len(words), words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def resampled_by_hand(docs, target, buckets, least, percent, seed):
    def counted(rows):
        return Counter(crc32(f.encode()) % buckets for _, text in rows for f in features(text)[1])

    s, t = counted(docs), counted(target)
    s_all, t_all = sum(s.values()) + buckets, sum(t.values()) + buckets
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * t_all**-1 * s_all / (s[b] + 1))) for b in range(buckets)}
    rows = []
    for doc_id, text in docs:
        n_words, found = features(text)
        weight = sum(gain[crc32(f.encode()) % buckets] for f in found) // len(found) if found else 0
        (h,) = digits(seed, doc_id, 1)
        rows.append((doc_id, n_words, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    able = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is not None, r[0], r[1:]))
    rank = {id(r): i + 1 for i, r in enumerate(able[: percent * len(able) // 100])}
    return sorted(((*r, rank.get(id(r))) for r in rows), key=repr)


@pytest.mark.parametrize("percent", [25, 60])
def test_resampling_equals_brute_force(spark, odd, documents, percent):  # noqa: F811
    target = spark.read.parquet(f"{SF}/benchmark.parquet")
    goal = [(r["item_id"], r["text"]) for r in target.collect()]
    for df, least in ((odd, 2), (documents, 20)):
        mine = resampling.resample(df, target, buckets=997, least_words=least, percent=percent)
        assert sorted_rows(mine) == resampled_by_hand(rows_of(df), goal, 997, least, percent, 7)


def test_resampling_of_empty_tables(odd, empty):  # noqa: F811
    assert resampling.resample(empty, odd).collect() == []
    mine = resampling.resample(odd, empty, buckets=97, least_words=1, percent=100)
    assert sorted_rows(mine) == resampled_by_hand(rows_of(odd), [], 97, 1, 100, 7)


def test_crc_matrices_equal_single_calls():
    rng = np.random.default_rng(3)
    raw = rng.integers(0, 3, 20_000).astype(np.uint8)
    starts = rng.integers(0, 19_000, 3000)
    ends = starts + np.concatenate([rng.integers(1, 70, 2990), np.full(10, 900)])
    assert resampling.range_crcs(raw, starts, ends).tolist() == [crc32(raw[a:b]) for a, b in zip(starts, ends, strict=True)]


def test_rows_whose_keys_collide_stay_apart(monkeypatch):
    monkeypatch.setattr(resampling, "mix", lambda x: x * np.uint64(0))  # only the last eight bytes count
    matrix = np.frombuffer(b"aaaaaaaaZZZZZZZZbbbbbbbbZZZZZZZZaaaaaaaaZZZZZZZZ", np.uint8).reshape(3, 16)
    first, code = resampling._distinct(matrix)
    assert (matrix[first][code] == matrix).all() and code[0] == code[2]


# --- 13: mixing --------------------------------------------------------------------------------------------


def targets_by_hand(sizes, weights, most):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, bound = sum(sizes.values()), set()
    while True:
        rest = [s for s in names if s not in bound]
        left = total - sum(most * sizes[s] for s in bound)
        target = {s: float(most * sizes[s]) if s in bound else left * weight[s] / sum(weight[r] for r in rest) for s in names}
        above = {s for s in rest if target[s] >= most * sizes[s]}
        if not above:
            return names, target
        bound |= above


def test_targets_stop_at_their_bound(spark):
    rows = [(i, "w " * n, s) for i, (n, s) in enumerate([(1, "a"), (400, "b"), (2, "c"), (10, None), (300, "B"), (0, "z")])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    sizes = {s: len(t.split()) for _, t, s in rows}
    _, target = targets_by_hand(sizes, (5, 2, 1), 3)
    mine = mixing.mixed(docs, block_words=4).taken().collect()
    assert {r["source"]: pytest.approx(target[r["source"]]) for r in mine} == {r["source"]: r["target"] for r in mine}
    assert sum(target.values()) == pytest.approx(sum(sizes.values()))
    assert {r["source"]: r["taken"] for r in mine} == {s: round(t) for s, t in target.items()}


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@pytest.mark.parametrize("block_words", [3, 128])
def test_mix_against_the_stream_of_each_source(documents, block_words):  # noqa: F811
    """Each source's slots, put together in the order of their numbers, pass over the blocks of the source's words in the
    order of its permutations, and stop at its target."""
    mix = mixing.mixed(documents, block_words=block_words, shard_slots=100)
    texts = defaultdict(dict)
    for r in mix.texts(documents).collect():
        assert r["slot"] not in texts[r["number"]]
        texts[r["number"]][r["slot"]] = r["text"].split(" ")
    streams = defaultdict(list)
    for r in sorted(documents.select("doc_id", "text", "source").collect()):
        streams[r["source"]] += words_of(r["text"])
    names, target = targets_by_hand({s: len(w) for s, w in streams.items()}, (5, 2, 1), 3)
    for number, name in enumerate(names):
        stream = streams[name]
        blocks = [stream[i : i + block_words] for i in range(0, len(stream), block_words)]
        expected, left = [], round(target[name])
        for turn in range(4):
            keys = mixing._passes(np.full(len(blocks), number), np.full(len(blocks), len(blocks)), np.full(len(blocks), turn), mixing.SEED)
            order = mixing.permuted(np.arange(len(blocks)), np.full(len(blocks), len(blocks)), keys)
            assert sorted(order) == list(range(len(blocks)))
            for block in order:
                if left:
                    expected.append(blocks[block][:left])
                    left -= len(expected[-1])
        assert [texts[number][i] for i in range(len(texts[number]))] == expected


def test_taken_counts_agree_with_the_pieces(documents):  # noqa: F811
    mix = mixing.mixed(documents, block_words=16, shard_slots=50)
    taken = {r["doc_id"]: r for r in mix.taken().collect()}
    counts = Counter()
    for r in mix.pieces.collect():
        counts[r["doc_id"]] += r["words"]
    assert len(taken) == documents.count()
    for doc_id, r in taken.items():
        assert r["taken"] == counts[doc_id] <= 3 * r["size"]
    by_source = defaultdict(int)
    for r in taken.values():
        by_source[r["source"], r["target"]] += r["taken"]
    assert all(n == round(target) for (_, target), n in by_source.items())


def test_shards_hold_the_mix_in_proportion(documents):  # noqa: F811
    mix = mixing.mixed(documents, block_words=4, shard_slots=400)
    slots = [tuple(r) for r in mix.pieces.select("shard", "number", "slot").distinct().collect()]
    shards, sources = Counter(s for s, _, _ in slots), Counter(n for _, n, _ in slots)
    assert len(shards) > 10 and min(shards.values()) > 250
    both = Counter((s, n) for s, n, _ in slots)
    for (shard, number), n in both.items():
        expected = sources[number] / len(shards)
        assert abs(n - expected) < 6 * math.sqrt(expected) + 3


def test_mix_of_odd_rows(odd, empty):  # noqa: F811
    once = sorted_rows(mixing.mixed(odd, block_words=7).taken())
    assert once == sorted_rows(mixing.mixed(odd.repartition(5), block_words=7).taken())
    assert len(once) == odd.count()
    sizes = Counter((i, len(words_of(t))) for i, t in rows_of(odd))
    assert Counter((i, n) for i, _, n, *_ in once) == sizes
    assert mixing.mixed(empty).taken().collect() == []


def test_permutation_and_its_inverse():
    for n in (1, 2, 3, 17, 1000):
        index, sizes, keys = np.arange(n), np.full(n, n), np.full(n, 12345, np.uint64)
        there = mixing.permuted(index, sizes, keys)
        assert sorted(there) == list(range(n))
        assert (mixing.permuted(there, sizes, keys, backwards=True) == index).all()
