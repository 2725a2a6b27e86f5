"""Language identification with interpolated Kneser-Ney character models.

One model per language, over the letters of words: every letter and the end of the word are predicted from up to
``ORDER - 1`` characters before them in the word. A model is kept as sorted arrays of n-gram hashes with their
discounted probabilities and back-off weights. A document goes to the language with the lowest cross-entropy per
predicted character; it is rejected if even that is above a threshold calibrated on labelled documents that the
models have not seen.

The models are learned from a bounded sample of labelled documents: for each language the first ``SAMPLE_DOCUMENTS``
in the order of a hash of their id, as far as they reach ``SAMPLE_BYTES``. The next ``CALIBRATION_DOCUMENTS``
calibrate score and rejection. Every document is scored by its whole text.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelake.llm.common import bounded_batches, mix, remainder, within

ORDER = 4
SAMPLE_DOCUMENTS = 1500
SAMPLE_BYTES = 16 << 20
CALIBRATION_DOCUMENTS = 300
_SHARES = 64  # of a language, ranked apart
UNKNOWN = "und"

_LETTERS = regex.compile(r"\p{L}+")
_START, _END = "\x00", "\x01"
_REMEMBERED = 200_000  # parts that a worker remembers
_LONGEST_REMEMBERED = 64
_TOGETHER = 256  # documents whose new parts are scored together
_SHARPNESS = (0.5, 1, 2, 5, 10, 20, 40, 80)


def _coded(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the words, each after ``ORDER - 1`` start marks and before an end mark; and the word of each."""
    lead = _START * (ORDER - 1)
    codes = np.frombuffer("".join(lead + w + _END for w in words).encode("utf-32-le"), "<u4").astype(np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + ORDER
    return codes, np.repeat(np.arange(len(words)), sizes)


def _gram_hashes(codes: np.ndarray, places: np.ndarray, n: int, back: int = 0) -> np.ndarray:
    """Hashes of the ``n`` characters that end ``back`` before each place; ``n`` may be 0."""
    value = np.full(len(places), n + 1, np.uint64)
    for j in range(n):
        value = value * np.uint64(0x9FB21C651E98DF25) + codes[places - (back + j)]
    return mix(value)


def _fit(words: Counter) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each order: n-gram hashes and discounted probabilities, context hashes and back-off weights."""
    texts = list(words)
    codes, word = _coded(texts)
    weight = np.fromiter((words[t] for t in texts), np.float64, len(texts))[word]
    places = np.flatnonzero(codes != ord(_START))
    weight = weight[places]
    model = []
    for n in range(1, ORDER + 1):
        grams, first = np.unique(_gram_hashes(codes, places, n), return_index=True)
        if n == ORDER:
            inverse = np.searchsorted(grams, _gram_hashes(codes, places, n))
            counts = np.bincount(inverse, weight, len(grams))
        else:  # continuation counts: how many different characters come before
            _, longer = np.unique(_gram_hashes(codes, places, n + 1), return_index=True)
            inverse = np.searchsorted(grams, _gram_hashes(codes, places[longer], n))
            counts = np.bincount(inverse, minlength=len(grams)).astype(float)
        ones, twos = (counts == 1).sum(), (counts == 2).sum()
        discount = min(max(ones / (ones + 2 * twos), 0.1), 0.9) if ones else 0.5
        contexts, context = np.unique(_gram_hashes(codes, places[first], n - 1, 1), return_inverse=True)
        total = np.bincount(context, counts)
        kinds = np.bincount(context)
        probability = np.maximum(counts - discount, 0) / total[context]
        # What the discount has really taken, also where a count is below it.
        taken = np.bincount(context, np.minimum(counts, discount)) / total
        model.append((grams, probability, contexts, np.where(kinds > 0, taken, 1.0)))
    return model


_MODEL = "lang string, characters long, " + ", ".join(f"g{n} binary, p{n} binary, c{n} binary, b{n} binary" for n in range(1, ORDER + 1))


def _fit_language(table: pa.Table) -> pa.Table:
    words: Counter = Counter()
    for text in table.column("text"):
        words.update(_LETTERS.findall(text.as_py().lower()))
    row: dict = {"lang": [table.column("lang")[0].as_py()], "characters": [len(set("".join(words)))]}
    if not words:
        return pa.table({"lang": pa.array([], pa.string()), "characters": pa.array([], pa.int64())} | {f"{x}{n}": pa.array([], pa.binary()) for n in range(1, ORDER + 1) for x in "gpcb"})
    for n, arrays in enumerate(_fit(words), 1):
        for name, values in zip("gpcb", arrays, strict=True):
            row[f"{name}{n}"] = pa.array([values.tobytes()], pa.binary())
    return pa.table(row)


class Models:
    """All languages' models side by side: per order, sorted hashes with one column of values per language."""

    def __init__(self, rows: list):
        rows = sorted(rows, key=lambda r: r["lang"])
        self.languages = [r["lang"] for r in rows]
        self.floor = 1.0 / (1 + max((r["characters"] for r in rows), default=1))
        self.orders = []
        self.sharpness, self.threshold = 1.0, float("inf")
        for n in range(1, ORDER + 1):
            self.orders.append((*self._merge(rows, f"g{n}", f"p{n}", 0.0), *self._merge(rows, f"c{n}", f"b{n}", 1.0)))

    @staticmethod
    def _merge(rows: list, keys: str, values: str, default: float) -> tuple[np.ndarray, np.ndarray]:
        each = [(np.frombuffer(r[keys], np.uint64), np.frombuffer(r[values], np.float64)) for r in rows]
        union = np.unique(np.concatenate([k for k, _ in each])) if each else np.empty(0, np.uint64)
        table = np.full((len(union) + 1, len(rows)), default)  # the last row is for hashes that are not there
        for i, (k, v) in enumerate(each):
            table[np.searchsorted(union, k), i] = v
        return union, table

    @staticmethod
    def _look(hashes: np.ndarray, keys: np.ndarray, table: np.ndarray) -> np.ndarray:
        place = np.searchsorted(keys, hashes)
        place[(place == len(keys)) | (keys[np.minimum(place, len(keys) - 1)] != hashes)] = len(keys)
        return table[place]

    def word_scores(self, words: list[str]) -> np.ndarray:
        """For each word the log-probability in every language, and last the number of predicted characters."""
        scores = np.zeros((len(words), len(self.languages) + 1))
        if not words or not self.languages:
            return scores
        codes, word = _coded(words)
        places = np.flatnonzero(codes != ord(_START))
        probability = np.full((len(places), len(self.languages)), self.floor)
        for n, (grams, discounted, contexts, backoff) in enumerate(self.orders, 1):
            probability *= self._look(_gram_hashes(codes, places, n - 1, 1), contexts, backoff)
            probability += self._look(_gram_hashes(codes, places, n), grams, discounted)
        word = word[places]
        starts = np.flatnonzero(np.diff(word, prepend=-1))
        scores[:, :-1] = np.add.reduceat(np.log(probability), starts)
        scores[:, -1] = np.diff(np.append(starts, len(places)))
        return scores


class _Parts(dict):
    """Row of the score table by what stands between white space."""

    def __init__(self, models: Models):
        super().__init__()
        self.models = models
        self.table = np.zeros((0, len(models.languages) + 1))
        self.pending: list[str] = []

    def __missing__(self, part: str) -> int:
        row = len(self.table) + len(self.pending)
        self.pending.append(part)
        if len(part) <= _LONGEST_REMEMBERED:
            self[part] = row
        return row

    def _settle(self) -> None:
        """Score what is pending."""
        words, owner = [], []
        for i, part in enumerate(self.pending):
            for word in _LETTERS.findall(part):
                words.append(word)
                owner.append(i)
        fresh = np.zeros((len(self.pending), self.table.shape[1]))
        for at in range(0, len(words), 20_000):
            scores = self.models.word_scores(words[at : at + 20_000])
            for column in range(scores.shape[1]):
                fresh[:, column] += np.bincount(owner[at : at + 20_000], scores[:, column], len(fresh))
        self.table = np.concatenate([self.table, fresh])
        self.pending = []

    def documents(self, texts: list[str]) -> np.ndarray:
        """For each text its log-probability in every language, and the number of predicted characters."""
        if len(self.table) > _REMEMBERED:
            self.clear()
            self.table = self.table[:0]
        rows = []
        for text in texts:
            parts = text.lower().split()
            rows.append(np.fromiter(map(self.__getitem__, parts), np.int64, len(parts)))
        self._settle()
        return np.array([self.table[r].sum(axis=0) for r in rows]).reshape(len(texts), -1)


def _classified(entropy: np.ndarray, models: Models) -> tuple[int, float]:
    best = int(entropy.argmin())
    return best, float(1 / np.exp(-models.sharpness * (entropy - entropy[best])).sum())


def _ranked(narrow: DataFrame, most: int) -> DataFrame:
    """The first ``most`` rows (lang, id, t, n, h) of each language by h, and their ``rank``.

    Ranked within shares of a language first, so that the task that ranks a whole language gets their winners only.
    """
    shares = narrow.withColumn("share", F.pmod(F.xxhash64("id", "n", "t"), F.lit(_SHARES)))
    for keys in (["lang", "share"], ["lang"]):
        order = Window.partitionBy(*keys).orderBy("h", "id", "n", "t")
        shares = shares.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
    return shares.drop("share")


def learn(docs: DataFrame, learnable) -> Models:
    """Models and calibration from the rows of ``docs`` (text, lang, doc_id) for which ``learnable`` holds.

    Rows are sampled, not ids, so rows that repeat an id are taken or left one by one; exact copies count once. Each
    language has a budget of bytes, from which a long text takes no more than its own: one that does not fit is passed
    over. A language with no text that fits is learned from its shortest. Rows without a language or a letter are no
    examples. Columns other than the three are ignored, whatever their names. An empty table gives no model.
    """
    spark = docs.sparkSession
    columns = F.col("lang").cast("string").alias("lang"), F.col("text").alias("text"), F.col("doc_id").alias("doc_id")
    known = docs.where(learnable & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select(*columns)
    # ``t`` tells rows of one id apart.
    key = F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("t")
    narrow = known.select("lang", *key, F.octet_length("text").alias("n"), F.xxhash64("doc_id").alias("h")).distinct()
    ranked = _ranked(narrow, SAMPLE_DOCUMENTS + CALIBRATION_DOCUMENTS)
    found: dict[str, list] = {}
    for row in ranked.collect():  # a bounded number for each language
        found.setdefault(row["lang"], []).append(row)
    chosen: list[tuple[str, int | None, int, bool]] = []
    for lang, rows in found.items():
        rows.sort(key=lambda r: r["rank"])
        # A language of few documents gives every fifth one for calibration.
        few = len(rows) <= SAMPLE_DOCUMENTS
        calibrates = [r["rank"] % 5 == 0 if few else r["rank"] > SAMPLE_DOCUMENTS for r in rows]
        taken = within([r["n"] for r in rows], SAMPLE_BYTES)
        if not any(t and not c for t, c in zip(taken, calibrates, strict=True)):
            least = min(range(len(rows)), key=lambda i: rows[i]["n"])
            taken[least], calibrates[least] = True, False
        chosen += [(lang, r["id"], r["t"], c) for r, t, c in zip(rows, taken, calibrates, strict=True) if t]
    if not chosen:
        return Models([])
    ids = spark.createDataFrame(chosen, "_lang string, _id long, _t long, calibrates boolean")
    mine = known.select("*", *key)
    same = (F.col("lang") == F.col("_lang")) & F.col("id").eqNullSafe(F.col("_id")) & (F.col("t") == F.col("_t"))
    sample = mine.join(F.broadcast(ids), same).dropDuplicates(["lang", "id", "t"]).select("lang", "text", "calibrates")
    fitted = sample.where(~F.col("calibrates")).select("lang", "text").groupBy("lang").applyInArrow(_fit_language, _MODEL)
    models = Models(fitted.collect())
    if models.languages:
        _calibrate(models, [(r["lang"], r["text"]) for r in sample.where("calibrates").collect()])
    return models


def _calibrate(models: Models, labelled: list[tuple[str, str]]) -> None:
    """Set the sharpness that gives the lowest log-loss, and a rejection threshold above all labelled documents."""
    entropies, truth = [], []
    totals = _Parts(models).documents([text for _, text in labelled])
    for (lang, _), total in zip(labelled, totals, strict=True):
        if total[-1] and lang in models.languages:
            entropies.append(-total[:-1] / total[-1])
            truth.append(models.languages.index(lang))
    if not entropies:
        return
    table, labels = np.array(entropies), np.array(truth)
    shifted = -(table - table.min(axis=1, keepdims=True))
    own = shifted[np.arange(len(labels)), labels]
    losses = [(np.log(np.exp(s * shifted).sum(axis=1)) - s * own).mean() for s in _SHARPNESS]
    models.sharpness = float(_SHARPNESS[int(np.argmin(losses))])
    models.threshold = float(table.min(axis=1).max() * 1.3)


def identify(docs: DataFrame, models: Models) -> DataFrame:
    """lang_pred, score (0 to 1), cross_entropy (per character) and rejected, after the documents' columns in ``_row``.

    A text that is null or has no letter is ``und``, with score 0, and is rejected; so is any text where no language
    has been learned. Ties go to the language that is first by name. Repeated rows are judged one by one; an empty
    table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(models)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        parts = _Parts(known)
        for batch in batches:
            rows: list[tuple] = []
            texts = pc.struct_field(batch.column("_row"), [place])
            totals = (t for at in range(0, len(texts), _TOGETHER) for t in parts.documents([x or "" for x in texts[at : at + _TOGETHER].to_pylist()]))
            for total in totals:
                if not total[-1]:
                    rows.append((UNKNOWN, 0.0, None, True))
                    continue
                entropy = -total[:-1] / total[-1]
                best, score = _classified(entropy, known)
                rows.append((known.languages[best], score, float(entropy[best]), bool(entropy[best] > known.threshold)))
            names = ["lang_pred", "score", "cross_entropy", "rejected"]
            kinds = [pa.string(), pa.float64(), pa.float64(), pa.bool_()]
            arrays = [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("_row"), *arrays], ["_row", *names])

    bounded_batches(docs.sparkSession)
    given = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    place = docs.columns.index("text")
    results = T.StructType.fromDDL("lang_pred string, score double, cross_entropy double, rejected boolean")
    out = T.StructType([given.schema["_row"], *results])
    return given.mapInArrow(each, out)


def op9_language(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    models = learn(docs, remainder(F.col("doc_id"), 3) != 1)
    judged = identify(docs.select("doc_id", "text"), models)
    held_out = (remainder(F.col("_row.doc_id"), 3) == 1).alias("held_out")
    return judged.select("_row.doc_id", held_out, "lang_pred", "score", "rejected")
