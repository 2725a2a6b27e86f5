"""Each operator against brute force or an exact round trip, on test tables and on odd rows."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict
from hashlib import sha256
from itertools import pairwise

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from farelake.llm import bpe, catalog, jaccard, language, packing, phrases, quality, scoring, sharding, substrings, topk
from farelake.llm.common import remainder, within

SF = "/root/testdata/sf0.001"
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
WORD = re.compile(rb"[^\x20\x09-\x0D]+")

PASSAGE = " ".join(f"word{i}" for i in range(60))
ODD_TEXTS = [
    None,
    "",
    " \n\t ",
    "a",
    "a b",
    "A b",
    PASSAGE,
    PASSAGE + " and more",
    "x " + PASSAGE,
    PASSAGE,
    "a b c d e " * 40,
    "é ß 日本   x́",
    "<|endoftext|> in a text  with  spaces \n\n here <|startoftext|>",
    "w" * 20_000,
    "long " * 30_000,
    "\x1c\x1d\x85 odd\x00bytes",
]


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    """Odd texts, repeated rows, null ids and columns whose names the operators use themselves."""
    rows = [(i, t, "en" if i % 2 else None, None, "p", 1, "q", 2.0, "r") for i, t in enumerate(ODD_TEXTS)]
    rows += [rows[6], (None, "no id at all", "en", "s", "p", 1, "q", 2.0, "r"), (None, None, None, None, None, None, None, None, None)]
    schema = "doc_id long, text string, lang string, source string, _row string, _bucket int, _text string, score double, `a.b` string"
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def empty(odd):
    return odd.where("false")


def rows_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def sorted_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- 1: byte-pair encoding ---------------------------------------------------------------------------------


def test_bpe_equals_the_tokenizers_library(odd, documents):
    reference = Tokenizer.from_file(BYTE_BPE)
    for df in (odd, documents):
        expected = []
        for doc_id, text in rows_of(df):
            ids = reference.encode(text or "", add_special_tokens=False).ids
            decoded = reference.decode(ids, skip_special_tokens=False)
            packed = np.array(ids, "<u4").tobytes()
            expected.append((doc_id, len(ids), sha256(packed).hexdigest(), sha256(decoded.encode()).hexdigest()))
        assert sorted_rows(bpe.round_trip(df, BYTE_BPE)) == sorted(expected, key=repr)


def test_bpe_decodes_what_it_encodes(odd):
    decoded = bpe.decode(bpe.encode(odd, BYTE_BPE), BYTE_BPE)
    assert sorted_rows(decoded) == sorted(((i, t or "") for i, t in rows_of(odd)), key=repr)


def test_bpe_white_space_and_specials():
    reference, coder, draw = Tokenizer.from_file(BYTE_BPE), bpe.load(BYTE_BPE), random.Random(3)
    for _ in range(3000):
        text = "".join(draw.choice("ab  \n\t'sTllé019!　\x1c\xa0") for _ in range(draw.randint(0, 30)))
        text = text.replace("!", draw.choice(["!", "<|endoftext|>"]))
        assert np.frombuffer(coder.encode_packed(text), "<u4").tolist() == reference.encode(text, add_special_tokens=False).ids


def test_forced_cuts_never_split_a_token():
    coder = bpe.load(BYTE_BPE)
    for token in random.Random(1).sample(list(coder.tokens.values()), 3000):
        assert coder.fragments(token) == [token] or token == b"<|endoftext|>"


# --- 2: quality -----------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def network(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    return quality.learn(docs.select("doc_id", "text"), labels, lambda i: remainder(i, 5) != 0)


def test_quality_on_held_out_rows(spark, network):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", "quality")
    scored = quality.score(docs, network).select("_row.doc_id", "score").join(labels, "doc_id").where(remainder(F.col("doc_id"), 5) == 0)
    found = [(r.score >= 0.3, r.quality == 1) for r in scored.collect()]
    assert len(found) > 50 and sum(a == b for a, b in found) / len(found) > 0.9


def test_quality_of_odd_rows(odd, empty, network):
    scores = quality.score(odd, network).collect()
    assert len(scores) == odd.count() and all(0 <= r.score <= 1 for r in scores)
    by_text = {r["_row"]["text"]: r.score for r in scores}
    assert by_text[""] == by_text[None]
    assert quality.score(empty, network).count() == 0


def test_quality_reads_the_whole_text(network):
    import pyarrow as pa

    junk = " ".join(f"WORD{i}!!" for i in range(100))
    clean = "the and of in to " * 2000
    texts = pa.array([clean, clean + junk, junk], pa.large_string())
    pooled, _, _ = network.pooled(quality._Symbols(texts))
    assert (pooled[1] >= np.maximum(pooled[0], pooled[2]) - 0.2).all()


def test_quality_without_labels(documents):
    labels = documents.selectExpr("doc_id", "cast(null as int) as quality")
    assert isinstance(quality.learn(documents, labels, lambda i: F.lit(True)), quality.Network)


def test_quality_learns_from_the_labelled_documents_that_are_there(spark, documents, monkeypatch):
    monkeypatch.setattr(quality, "SAMPLE_DOCUMENTS", 40)
    everywhere = documents.select("doc_id", F.lit(1).alias("quality")).unionByName(spark.range(10**6, 10**6 + 20_000).selectExpr("id as doc_id", "0 as quality"))
    assert quality.learn(documents.select("doc_id", "text"), everywhere, lambda i: F.lit(True)).learned
    assert not quality.learn(documents.where("doc_id < 0").select("doc_id", "text"), everywhere, lambda i: F.lit(True)).learned


def test_a_long_document_does_not_end_the_sample():
    assert within([2000, 5, 900, 5, 10], 1000) == [False, True, True, True, True]
    assert within([990, 5, 5, 5], 1000) == [False, True, True, True]
    assert within([5] * 300, 1000) == [True] * 200 + [False] * 100


# --- 3: language-model scores ------------------------------------------------------------------------------------


def brute_scores(rows, order, backoff):
    """With plain dictionaries; a context is counted as a gram of its own."""
    grams = [Counter(tuple(ws[i : i + n]) for n in range(1, order + 1) for i in range(len(ws) - n + 1)) for ws in rows]
    total = sum(grams, Counter())
    words = sum(map(len, rows))
    scores = []
    for ws, own in zip(rows, grams, strict=True):
        score, others = 0.0, words - len(ws)
        for i in range(len(ws)):
            longest = min(i, order - 1)
            for n in range(longest, -1, -1):
                gram = tuple(ws[i - n : i + 1])
                count = total[gram] - own[gram]
                if count:
                    context = others if n == 0 else total[gram[:-1]] - own[gram[:-1]]
                    score += np.log10(count / context * backoff ** (longest - n))
                    break
            else:
                score += np.log10(backoff**longest / (others + 1))
        scores.append(score)
    return scores


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_equal_brute_force(documents, odd, empty, order):
    for df in (documents, odd):
        rows = rows_of(df)
        words = [WORD.findall((t or "").encode()) for _, t in rows]
        expected = sorted(zip((i for i, _ in rows), map(len, words), brute_scores(words, order, 0.4), strict=True), key=repr)
        found = sorted_rows(scoring.score_documents(df, order))
        assert [f[:2] for f in found] == [e[:2] for e in expected]
        key = lambda r: (repr(r[0]), r[2])
        assert np.allclose([f[2] for f in sorted(found, key=key)], [e[2] for e in sorted(expected, key=key)])
    assert scoring.score_documents(empty, order).count() == 0


def test_a_registered_query_scores_with_two_words_before(spark, documents):
    rows = rows_of(documents)
    words = [WORD.findall((t or "").encode()) for _, t in rows]
    expected = sorted(zip((i for i, _ in rows), brute_scores(words, 3, 0.4), strict=True))
    found = sorted((r.doc_id, r.log_score) for r in catalog.queries()["op3_lm_scoring"](spark, SF).collect())
    assert [i for i, _ in found] == [i for i, _ in expected]
    assert np.allclose([s for _, s in found], [s for _, s in expected], atol=1e-4)


def test_scores_of_a_longer_context(odd):
    rows = rows_of(odd)
    words = [WORD.findall((t or "").encode()) for _, t in rows]
    found = sorted(r.log_score for r in scoring.score_documents(odd, 4).collect())
    assert np.allclose(found, sorted(brute_scores(words, 4, 0.4)))


# --- 4: fingerprints ----------------------------------------------------------------------------------------------


def test_parser_continues_from_a_mark():
    draw = random.Random(5)
    for _ in range(200):
        a, b, c = ("".join(draw.choice("abé") for _ in range(draw.randint(0, 60))) for _ in range(3))
        both = phrases.fingerprints(a + b, (len(a), c))
        assert both == (phrases.fingerprint(a + b), phrases.fingerprint(a + c))


def plain_mix(x):
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 % 2**64
    x = (x ^ x >> 27) * 0x94D049BB133111EB % 2**64
    return x ^ x >> 31


def plain_fingerprint(text):
    """The definition by sets of byte strings and whole numbers: LZ78 phrases, the least hash of each of 64 slots."""
    seen, phrase = set(), b""
    for byte in text.encode():
        phrase += bytes([byte])
        if phrase not in seen:
            seen.add(phrase)
            phrase = b""
    codes = [plain_mix((b + 1) * 0xD1342543DE82EF95 % 2**64) for b in range(256)]
    slots = {}
    for p in seen | ({phrase} - {b""}):
        value = plain_mix((sum(codes[b] * pow(0x9E3779B97F4A7C15, i, 2**64) for i, b in enumerate(p)) + len(p)) % 2**64)
        slots[value >> 58] = min(value, slots.get(value >> 58, value))
    full = []
    for slot in range(64):
        away = next((d for d in range(64) if (slot + d) % 64 in slots), None)
        value = 2**64 - 1 if away is None else slots[(slot + away) % 64]
        full.append(plain_mix((value + away * 0x9E3779B97F4A7C15) % 2**64) if away else value)
    return "".join(f"{plain_mix(v) % 65536:04x}" for v in full)


def test_fingerprint_equals_its_plain_definition(documents):
    texts = [t or "" for _, t in rows_of(documents.orderBy("doc_id").limit(60))] + [t or "" for t in ODD_TEXTS]
    draw = random.Random(3)
    texts += ["".join(draw.choice("abé ") for _ in range(draw.randint(0, 30))) for _ in range(200)]
    for text in texts:
        assert phrases.fingerprint(text) == plain_fingerprint(text)


def test_fingerprints_equal_brute_force(documents, odd, empty):
    for df in (documents, odd):
        rows = sorted(((i, t or "") for i, t in rows_of(df)), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        expected = []
        for place, (doc_id, text) in enumerate(rows):
            following = rows[(place + 1) % len(rows)][1]
            kept = len(text) - len(text) // 4
            edited = text[:kept] + following[: len(text) // 4]
            own, other = plain_fingerprint(text), plain_fingerprint(edited)
            likeness = phrases.likeness(own, other), phrases.likeness(own, plain_fingerprint(following))
            expected.append((doc_id, len(text), sha256(edited.encode()).hexdigest(), own, other, *likeness))
        assert sorted_rows(phrases.compare_edited(df)) == sorted(expected, key=repr)
    assert phrases.compare_edited(empty).count() == 0


def test_fingerprints_tell_edits_from_strangers(documents):
    found = phrases.compare_edited(documents).collect()
    assert sum(r.near_edited > r.near_next for r in found) > 0.97 * len(found)
    assert phrases.likeness(phrases.fingerprint("abc"), phrases.fingerprint("abc")) == 1


# --- 5: sharding ------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("shards", [1, 3, 16])
def test_shards_are_as_even_as_the_order_allows(documents, odd, empty, shards):
    for df in (documents, odd):
        found = sharding.shard_documents(df, shards).collect()
        assert len(found) == df.count()
        texts = defaultdict(set)
        by_shard = defaultdict(list)
        for r in found:
            texts[r.text_crc32].add(r.shard)
            by_shard[r.shard].append(r.slot)
        assert all(len(s) == 1 for s in texts.values())
        assert all(sorted(slots) == list(range(len(slots))) for slots in by_shard.values())
        groups = df.groupBy(sharding.text_key(F.col("text")).alias("k")).agg(F.sum(F.octet_length(F.coalesce("text", F.lit(""))) + 1).alias("n"))
        sizes = [r.n for r in groups.orderBy("k").collect()]
        largest = max(sum(r.size for r in found if r.shard == s) for s in by_shard)
        assert largest <= smallest_capacity(sizes, shards)
    assert sharding.shard_documents(empty, shards).count() == 0


def smallest_capacity(sizes, shards):
    def needed(capacity):
        count, room = 1, capacity
        for size in sizes:
            if size > room:
                count, room = count + 1, capacity
            room -= size
        return count

    low, high = max(sizes), sum(sizes)
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if needed(middle) <= shards else (middle + 1, high)
    return low


def test_text_hashes(odd):
    for r in sharding.shard_documents(odd, 4).join(odd.dropDuplicates(["doc_id"]), "doc_id").collect():
        raw = (r.text or "").encode()
        assert (r.size, r.text_crc32) == (len(raw) + 1, zlib.crc32(raw))


def test_a_large_group_leaves_the_others_even(spark):
    rows = [(i, "copy " * 50 if i % 3 == 0 else f"text {i} " + "x" * (i % 40)) for i in range(900)]
    found = sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string"), 8).collect()
    sizes = Counter()
    for r in found:
        sizes[r.shard] += r.size
    assert len(sizes) == 8
    rest = sorted(sizes.values())[:-1]
    assert rest[-1] < 1.6 * rest[0]


# --- 6: top-k -----------------------------------------------------------------------------------------------------------


def brute_top(rows, step, k):
    valid = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, v in {i: (i, v) for i, v in valid if i % step == 0}.values():
        scores = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), i) for i, w in valid if i != q)
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scores[:k], 1)]
    return sorted(out)


def test_top_k_equals_brute_force(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    found = topk.top_k(topk.integer_vectors(table), F.col("vec_id") % 10 == 0)
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    assert sorted(tuple(r) for r in found.collect()) == brute_top(rows, 10, 5)


def test_top_k_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [[1.0, 0.0], None, [nan, 1.0], [1.0, None], [inf, 0.0], [0.0, 0.0], [-1.0, 2.5], [0.5], [], [1.0, 0.0], [1.0, 0.0], [3.0, 4.0], [1e6, -1e6]]
    rows = [(i, v, "x") for i, v in enumerate(vectors)] + [(None, [1.0, 1.0], "y")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string")
    found = topk.top_k(topk.integer_vectors(table), F.col("vec_id") % 1 == 0, 4)
    assert sorted(tuple(r) for r in found.collect()) == brute_top([r[:2] for r in rows], 1, 4)
    assert topk.top_k(topk.integer_vectors(table.where("false")), F.col("vec_id") % 1 == 0).count() == 0


def test_top_k_of_scores_beyond_64_bits(spark):
    vectors = [[1e300, 1.0], [-1e300, 2.0], [1e308, -1e308], [1.0, 2.0], [3e7, 4e7], [1e12, 1.0], [-0.5, 2.0], [9e9, -9e9]]
    table = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")
    found = topk.top_k(topk.integer_vectors(table), F.col("vec_id") % 1 == 0, 8).collect()
    most = 2**63 - 1
    whole = [[max(-most - 1, min(most, int(np.floor(x * 256)) if np.isfinite(x * 256) else int(np.sign(x)) * 2**64)) for x in v] for v in vectors]
    expected = []
    for q, v in enumerate(whole):
        scores = sorted((-max(-most, min(most, sum(a * b for a, b in zip(v, w, strict=True)))), i) for i, w in enumerate(whole) if i != q)
        expected += [(q, rank, i, -score) for rank, (score, i) in enumerate(scores, 1)]
    assert sorted(tuple(r) for r in found) == expected


def test_queries_of_like_needs_go_together(spark):
    rows = [(i, [i + 1], float(i + 1), 1000 if i else -5) for i in range(2000)]
    chunks = topk._packed(spark.createDataFrame(rows, "vec_id long, v array<long>, norm double, bound long"), 8).collect()
    ids = [np.frombuffer(c.ids, np.int64) for c in chunks]
    assert sorted(np.concatenate(ids).tolist()) == list(range(2000))
    # Needs fall with the id, but for the query without a bound: no two chunks overlap.
    spans = sorted((i[i > 0].min(), i[i > 0].max()) for i in ids if i.max() > 0)
    assert len(spans) > 8 and all(a[1] < b[0] for a, b in pairwise(spans))


def test_top_k_with_many_copies(spark):
    draw = np.random.default_rng(2)
    rows = [(i, ([0.5] * 8 if i % 3 == 0 else draw.normal(0, 1 + i % 5, 8).tolist())) for i in range(1500)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = topk.top_k(topk.integer_vectors(table), F.col("vec_id") % 50 == 0)
    assert sorted(tuple(r) for r in found.collect()) == brute_top(rows, 50, 5)


# --- 7: passages ------------------------------------------------------------------------------------------------------------


def brute_passages(rows, window):
    words = [(i if i is not None else -(2**63), WORD.findall((t or "").encode())) for i, t in rows]
    owner = {}
    for i, ws in sorted(words, key=lambda r: r[0]):
        for k in range(len(ws) - window + 1):
            owner.setdefault(tuple(ws[k : k + window]), i)
    out = []
    for (doc_id, _), (i, ws) in zip(rows, words, strict=True):
        gone = set()
        for k in range(len(ws) - window + 1):
            if owner[tuple(ws[k : k + window])] < i:
                gone.update(range(k, k + window))
        out.append((doc_id, len(ws), len(gone), b" ".join(w for k, w in enumerate(ws) if k not in gone).decode()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("window", [3, 13, 50])
def test_passages_equal_brute_force(documents, odd, empty, window):
    for df in (documents, odd):
        found = substrings.dedup_passages(df, window).select("_row.doc_id", "n_words", "n_removed", "kept")
        assert sorted_rows(found) == brute_passages(rows_of(df), window)
    assert substrings.dedup_passages(empty, window).count() == 0


@pytest.mark.parametrize("bits", [16, 4])
def test_equal_hashes_of_different_passages_change_nothing(documents, bits):
    found = substrings.dedup_passages(documents, hash_bits=bits).select("_row.doc_id", "n_words", "n_removed", "kept")
    assert sorted_rows(found) == brute_passages(rows_of(documents), 13)


def test_automata_remove_what_an_owner_sent_and_nothing_else():
    table = pa.table({"_id": [5, 2, 9], "_text": ["x a b c d y", "a b c d", "a b  c\nd a b"]})
    sent = {"_wanted": [0b1, 0b1], "_first": [4, 9], "_words": pa.array([b"a b c d", b"c d a"])}
    found = substrings._kept(table, pa.table(sent), 3)
    # The first cell's first window only; nothing of an owner with a greater or the same id.
    assert found == [(6, 3, "x d y"), (4, 0, "a b c d"), (6, 3, "d a b")]


def test_a_passage_longer_than_a_cell_with_gaps(spark):
    long = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(long[:at] + [f"new{i}"] + long[at + 1 :])) for i, at in enumerate(range(3, 400, 61))]
    rows += [(100, " ".join(long[30:300])), (101, " ".join(long[63:76])), (102, " ".join(long[64:76])), (-1, " ".join(long[120:140]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = substrings.dedup_passages(df).select("_row.doc_id", "n_words", "n_removed", "kept")
    assert sorted_rows(found) == brute_passages(rows, 13)


def test_overlapping_passages_of_several_documents(spark):
    draw = random.Random(9)
    pool = ["a", "b", "c"]
    rows = [(i, " ".join(draw.choice(pool) for _ in range(draw.randint(0, 60)))) for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = substrings.dedup_passages(df, 6).select("_row.doc_id", "n_words", "n_removed", "kept")
    assert sorted_rows(found) == brute_passages(rows, 6)


# --- 8: Jaccard join ------------------------------------------------------------------------------------------------------------


def brute_components(rows, shingle, num, den):
    lower = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
    sets = []
    for _, text in rows:
        ws = [w.translate(lower) for w in WORD.findall((text or "").encode())]
        whole = frozenset([tuple(ws)]) if ws else frozenset()
        sets.append(frozenset(tuple(ws[i : i + shingle]) for i in range(len(ws) - shingle + 1)) or whole)
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if den * both >= num * (len(sets[a]) + len(sets[b]) - both):
                    parent[find(a)] = find(b)
    smallest = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            smallest[find(i)].append(doc_id)
    return sorted(((d, len(sets[i]), min(smallest[find(i)], default=None)) for i, (d, _) in enumerate(rows)), key=repr)


@pytest.mark.parametrize(("shingle", "num", "den"), [(3, 9, 10), (5, 4, 5)])
def test_components_equal_brute_force(documents, odd, empty, shingle, num, den):
    for df in (documents, odd):
        assert sorted_rows(jaccard.similar_documents(df, shingle, num, den)) == brute_components(rows_of(df), shingle, num, den)
    assert jaccard.similar_documents(empty, shingle, num, den).count() == 0


def test_chains_and_dense_groups(spark):
    draw = random.Random(4)
    base = [f"t{i}" for i in range(60)]
    rows = []
    for i in range(150):  # near copies of one text, some too far from each other
        ws = list(base)
        for _ in range(draw.randint(0, 3)):
            ws[draw.randrange(60)] = f"n{draw.randrange(400)}"
        rows.append((i, " ".join(ws)))
    for i in range(40):  # a chain: each is near the next one only
        rows.append((1000 - i, " ".join(f"c{j}" for j in range(2 * i, 2 * i + 50))))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted_rows(jaccard.similar_documents(df, 3, 9, 10)) == brute_components(rows, 3, 9, 10)


@pytest.mark.parametrize("block", [jaccard._BLOCK, 400])
def test_copies_too_far_apart_are_not_paired(spark, monkeypatch, block):
    """Of 529 texts any two pass the filters often, but link with their own near copy alone; no table grows with pairs.

    Texts are lines of a plane of 23 by 23 points: 43 words are in all, and two texts share at most one of seven others.
    """
    base = [f"b{i}" for i in range(43)]
    lines = [base + [f"p{x}v{(a * x + b) % 23}" for x in range(7)] for a in range(23) for b in range(23)]
    rows = [(i, " ".join(ws)) for i, ws in enumerate(lines)]
    rows += [(1000 + i, " ".join(lines[i][1:])) for i in range(0, len(lines), 5)]
    written = []

    def count(df, label):
        stored = materialize(df, label)
        written.append((label, stored.count()))
        return stored

    materialize = jaccard.materialize
    monkeypatch.setattr(jaccard, "materialize", count)
    monkeypatch.setattr(jaccard, "_BLOCK", block)
    found = sorted_rows(jaccard.similar_documents(spark.createDataFrame(rows, "doc_id long, text string"), 1, 4, 5))
    assert found == brute_components(rows, 1, 4, 5)
    sizes = dict(written)
    assert max(n for label, n in written if label != "blocks") == sizes["postings"]  # pairs by the filters alone: 19,616
    assert sizes["blocks"] == sizes["open"] if block > 1000 else sizes["blocks"] > sizes["open"]


def test_components_of_links(spark):
    links = [(i, i + 1) for i in range(50)] + [(100, 200), (300, 200), (7, 400)]
    found = dict(tuple(r) for r in jaccard.components(spark.createDataFrame(links, "a long, b long")).collect())
    assert all(found[i] == 0 for i in [*range(51), 400]) and all(found[i] == 100 for i in (100, 200, 300))


# --- 9: language ------------------------------------------------------------------------------------------------------------------


def test_languages_of_held_out_documents(documents):
    models = language.learn(documents, remainder(F.col("doc_id"), 3) != 1)
    judged = language.identify(documents, models).where(remainder(F.col("_row.doc_id"), 3) == 1).collect()
    assert sum(r.lang_pred == r["_row"].lang for r in judged) > 0.95 * len(judged)
    assert sum(r.rejected for r in judged) <= 0.02 * len(judged)


def test_ranking_of_a_language_in_shares(spark):
    narrow = spark.range(5000).selectExpr("if(id % 5 = 0, 'de', 'en') as lang", "id", "id % 7 as n", "xxhash64(id) as h", "0L as t")
    ranked = language._ranked(narrow, 1800)
    expected = []
    for lang in ("de", "en"):
        rows = sorted((r.h, r.id, r.n) for r in narrow.where(F.col("lang") == lang).collect())
        expected += [(lang, i, k) for k, (_, i, _) in enumerate(rows[:1800], 1)]
    assert sorted((r.lang, r.id, r["rank"]) for r in ranked.collect()) == sorted(expected)
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\(lang#\d+, share#\d+", plan)


def test_language_of_odd_rows(odd, empty, documents):
    models = language.learn(documents, F.lit(True))
    judged = language.identify(odd, models).collect()
    assert len(judged) == odd.count() and all(0 <= r.score <= 1 for r in judged)
    for r in judged:
        text = r["_row"]["text"] or ""
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in text))
        assert r.lang_pred != "und" or (r.rejected and r.score == 0)
    assert language.identify(empty, models).count() == 0


def test_kneser_ney_probabilities_add_up_to_at_most_one():
    words = Counter({"abab": 5, "aba": 3, "bab": 2, "b": 1})
    alphabet = "ab\x01"
    rows = [{"lang": "x", "characters": 3} | {f"{n}{o}": a.tobytes() for o, arrays in enumerate(language._fit(words), 1) for n, a in zip("gpcb", arrays, strict=True)}]
    models = language.Models(rows)
    total = 0.0
    for last in alphabet:
        codes, _ = language._coded(["ab" + last])
        places = np.array([language.ORDER - 1 + 2])
        p = np.full((1, 1), models.floor)
        for n, (grams, discounted, contexts, weight) in enumerate(models.orders, 1):
            p *= models._look(language._gram_hashes(codes, places, n - 1, 1), contexts, weight)
            p += models._look(language._gram_hashes(codes, places, n), grams, discounted)
        total += p[0, 0]
    assert 0.9 < total <= 1.0001


def test_languages_without_any_label(odd, documents):
    models = language.learn(documents.withColumn("lang", F.lit(None).cast("string")), F.lit(True))
    assert {r.lang_pred for r in language.identify(odd, models).collect()} == {"und"}


# --- 10: packing ----------------------------------------------------------------------------------------------------------------------


def brute_best_fit(counts, capacity):
    room = []
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            fitting = [(r, i) for i, r in enumerate(room) if r >= length]
            if fitting:
                room[min(fitting)[1]] -= length
            else:
                room.append(capacity - length)
    return sorted(room)


def test_best_fit_over_counts_equals_one_by_one():
    for seed in range(150):
        draw = random.Random(seed)
        capacity = draw.choice([10, 50, 97])
        counts = {n: draw.choice([1, 2, 5, 30]) for n in draw.sample(range(1, capacity + 1), draw.randint(1, capacity))}
        plan, opened = packing.best_fit_decreasing(counts, capacity)
        steps = defaultdict(list)
        for length, rank, first, each, offset in plan.tolist():
            steps[length].append((rank, first, each, offset))
        placed = defaultdict(list)
        for length, own in steps.items():
            for (rank, first, each, offset), (after, *_) in pairwise([*sorted(own), (counts[length],)]):
                for i in range(after - rank):
                    placed[first + i // each].append((offset + i % each * length, length))
        for pieces in placed.values():
            end = 0
            for offset, length in sorted(pieces):
                assert offset == end
                end += length
        assert sorted(placed) == list(range(opened))
        assert sorted(capacity - sum(n for _, n in p) for p in placed.values()) == brute_best_fit(counts, capacity)


def test_packed_pieces(documents, odd, empty):
    reference = Tokenizer.from_file(WORD_BPE)
    for df in (documents, odd):
        found = packing.pack(df, WORD_BPE).collect()
        expected = Counter()
        for doc_id, text in rows_of(df):
            ids = [*reference.encode(text or "", add_special_tokens=False).ids, 1]
            for piece, at in enumerate(range(0, len(ids), 4096)):
                part = ids[at : at + 4096]
                expected[doc_id, piece, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
        assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == expected
        sequences = defaultdict(list)
        for r in found:
            sequences[r.sequence_id].append((r.offset, r.length))
        for pieces in sequences.values():
            end = 0
            for offset, length in sorted(pieces):
                assert offset == end
                end += length
            assert end <= 4096
        lengths = Counter(r.length for r in found)
        assert len(sequences) == len(brute_best_fit(lengths, 4096))
    assert packing.pack(empty, WORD_BPE).count() == 0


def test_words_merged_together_equal_single_merges():
    coder = packing.WordIds(WORD_BPE)
    rng = random.Random(8)
    letters = "etaoinshrdlu" * 3 + "bcfgjkmpqvwxyzéüß"
    words = ["".join(rng.choices(letters, k=rng.randint(1, 40))) for _ in range(3000)] + ["the", "a", "é", "..", "'s"]
    expected = [np.array(coder.tokenizer.encode(w, add_special_tokens=False).ids, "<u4").tobytes() for w in words]
    assert coder._encode_words(words) == expected


def test_remembered_parts_stay_within_their_bytes():
    made = []

    def make(texts):
        made.extend(texts)
        return [t.encode() for t in texts]

    recent = packing._Recent(100_000)
    for i in range(200):
        wanted = {f"part {i} {j}" for j in range(50)} | {"always"}
        known = recent.settle(wanted, make)
        assert all(known[t] == t.encode() for t in wanted)
        assert (len(recent.now) + len(recent.older)) * 200 < 130_000
    assert made.count("always") == 1 and len(made) == 200 * 50 + 1


def test_automata_of_long_passages_stay_small(monkeypatch):
    """However many windows a portion has, no automaton has more nodes than its share of a worker's memory."""
    made = []

    class Counted:
        def __init__(self, kind):
            self.automaton = real(kind)
            self.add_word, self.iter = self.automaton.add_word, self.automaton.iter

        def make_automaton(self):
            self.automaton.make_automaton()
            made.append(self.automaton.get_stats()["nodes_count"])

    real = substrings.ahocorasick.Automaton

    text = " ".join(f"w{i}" for i in range(30_000))
    table = pa.table({"_id": [1], "_text": [text], "_row": [0], "_bucket": [0]})
    words = text.split()
    cells = range(0, len(words) - 49, 64)
    wanted = [-1 if c + 64 + 49 <= len(words) else 1 for c in cells]
    sent = {"_bucket": [0] * len(cells), "_wanted": wanted, "_first": [0] * len(cells)}
    sent["_words"] = [" ".join(words[c : c + 113]).encode() for c in cells]
    monkeypatch.setattr(substrings.ahocorasick, "Automaton", Counted)
    ((n, removed, _),) = substrings._kept(table, pa.table(sent), 50)
    assert n == 30_000 and removed > 29_800
    assert max(made) * 64 < 64 << 20
