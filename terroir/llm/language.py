"""Language identification by language-bitmask n-gram filters.

For each language the frequent character n-grams of padded words go into a
Bloom filter. The filters are stored bit-sliced: row `p` of the table holds bit
`p` of every language's filter, so the AND of an n-gram's few rows is the mask
of all languages that hold it. A text's score for a language is the share of
its n-grams whose mask has the language's bit, corrected for the false
positives that the fill of that language's slice predicts.

Fitting uses at most about `rows_per_language` labelled rows of each language
(chosen by a hash of the id), whole texts. An n-gram enters a language's filter
when it makes up at least `min_share` of the language's n-grams of its order,
so each filter holds at most `len(ORDERS) / min_share` n-grams, and at least
`min_ratio` of its share in the language where it is most frequent. The table
has `ROWS` rows of one 64-bit word for every 64 languages: its size is fixed
and is what is broadcast.

Null texts and texts without a letter are `und`, score 0. Only id and text are
inputs of a prediction. With ties the language first in the alphabet wins. Rows
without label or text are never learned from; a null id is not held out. With
no labelled rows every prediction is `und`. Repeated rows are judged each on
its own. Very long words are looked at in pieces of `LONG_WORD` characters.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from terroir.llm.common import bounded_batches, mix, slices

ORDERS = (2, 3, 4)
ROWS = 1 << 20
HASHES = 4
LONG_WORD = 256
CACHE_WORDS = 400_000
WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Filters:
    languages: list[str]
    table: np.ndarray        # (ROWS, words of 64 languages), uint64
    false_positive: np.ndarray


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def pieces(words: list[str]) -> tuple[list[str], np.ndarray]:
    """Words, the very long ones in pieces, and the word that each belongs to."""
    if max(map(len, words), default=0) <= LONG_WORD:
        return words, np.arange(len(words))
    out, owner = [], []
    for k, w in enumerate(words):
        cut = [w[j:j + LONG_WORD] for j in range(0, len(w), LONG_WORD)]
        out += cut
        owner += [k] * len(cut)
    return out, np.array(owner)


def grams(words: list[str], n: int) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hashes of the n-grams of the words, padded by a blank on either
    side, and the place of the word that each is from), in order."""
    text = np.frombuffer("".join(f" {w} " for w in words).encode("utf-32-le"), np.uint32).astype(np.uint64)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 2
    owner = np.repeat(np.arange(len(words)), size)
    count = max(0, len(text) - n + 1)
    h = np.full(count, n, np.uint64)
    for k in range(n):
        h = h * np.uint64(0x9E3779B97F4A7C15) + text[k:k + count]
    inside = owner[:count] == owner[n - 1:]
    return mix(h[inside]), owner[:count][inside]


def count_grams(labelled: DataFrame) -> DataFrame:
    """lang, n, gram (64-bit hash), count over `labelled` (lang, text)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            words: dict[str, Counter] = {}
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()):
                words.setdefault(lang, Counter()).update(WORD.findall(text.lower()))
            for lang, seen in words.items():
                parts, owner = pieces(list(seen))
                times = np.fromiter(seen.values(), np.int64, len(seen))[owner]
                for n in ORDERS:
                    gram, own = grams(parts, n)
                    gram, place = np.unique(gram, return_inverse=True)
                    total = np.bincount(place, weights=times[own], minlength=len(gram)).astype(np.int64)
                    yield pa.RecordBatch.from_arrays([
                        pa.array([lang] * len(gram), pa.string()), pa.array(np.full(len(gram), n, np.int32)),
                        pa.array(gram.view(np.int64)), pa.array(total)], names=["lang", "n", "gram", "c"])

    return labelled.mapInArrow(count, "lang string, n int, gram long, c long").groupBy("lang", "n", "gram").agg(
        F.sum("c").alias("c"))


def fit(labelled: DataFrame, rows_per_language: int = 4000, min_share: float = 5e-5, min_ratio: float = 0.25) -> Filters:
    """`labelled`: doc_id, text, lang, the last two not null."""
    bounded_batches(labelled.sparkSession)
    have = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(have)
    if not languages:
        return Filters([], np.zeros((ROWS, 1), np.uint64), np.zeros(0))
    # keep a row when the hash of its id is under the language's share
    spark = labelled.sparkSession
    plan = spark.createDataFrame(list(enumerate(languages)), "code int, lang string")
    draw = F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(1 << 20)) / F.lit(float(1 << 20))
    shares = F.create_map(*[F.lit(x) for lang in languages for x in (lang, float(rows_per_language) / have[lang])])
    counted = count_grams(labelled.filter(draw < shares[F.col("lang")]).select("lang", "text"))
    totals = counted.groupBy("lang", "n").agg(F.sum("c").alias("total"))
    rated = counted.join(totals, ["lang", "n"]).withColumn("rate", F.col("c") / F.col("total")).filter(
        F.col("rate") >= min_share).join(plan, "lang")
    chosen = rated.groupBy("n", "gram").agg(F.max("rate").alias("top"), F.collect_list(F.struct("code", "rate")).alias("of"))
    chosen = chosen.select("gram", F.explode(F.filter("of", lambda x: x["rate"] >= F.col("top") * min_ratio)).alias("x"))
    low, high = F.col("gram").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned("gram", 32).bitwiseOR(F.lit(1))
    at = F.explode(F.array(*[(low + high * j).bitwiseAND(F.lit(ROWS - 1)) for j in range(HASHES)]))
    rows = (chosen.select(at.alias("at"), F.floor(F.col("x.code") / 64).alias("word"), (F.col("x.code") % 64).alias("bit"))
            .groupBy("at", "word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("mask"))).toPandas()
    table = np.zeros((ROWS, -(-len(languages) // 64)), np.uint64)
    table[rows["at"].to_numpy(np.int64), rows["word"].to_numpy(np.int64)] = rows["mask"].to_numpy(np.int64).view(np.uint64)
    fill = [float(((table[:, k // 64] >> np.uint64(k % 64)) & np.uint64(1)).mean()) for k in range(len(languages))]
    return Filters(languages, table, np.array(fill) ** HASHES)


def _sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs, given where each ends."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return np.diff(total[ends], prepend=0)


class Judge:
    """Counts of hits by language for words, remembered between batches."""

    def __init__(self, filters: Filters):
        self.f, self.width = filters, len(filters.languages)
        self.reset()

    def reset(self) -> None:
        self.at: dict[str, int] = {}
        self.rows: list[np.ndarray] = [np.zeros((0, self.width + 1), np.int32)]
        self.n = 0

    def learn(self, words: list[str]) -> None:
        """Rows (hits of each language, n-grams) of new words."""
        parts, word = pieces(words)
        out = np.zeros((len(words), self.width + 1), np.int32)
        for n in ORDERS:
            h, own = grams(parts, n)
            own = word[own]
            low, high = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)
            masks = ~np.zeros((len(h), self.f.table.shape[1]), np.uint64)
            for j in range(HASHES):
                masks &= self.f.table[((low + high * np.uint64(j)) & np.uint64(ROWS - 1)).astype(np.int64)]
            for k in range(self.width):
                hit = ((masks[:, k // 64] >> np.uint64(k % 64)) & np.uint64(1)) > 0
                out[:, k] += np.bincount(own[hit], minlength=len(words)).astype(np.int32)
            out[:, -1] += np.bincount(own, minlength=len(words)).astype(np.int32)
        for k, w in enumerate(words):
            self.at[w] = self.n + k
        self.n += len(words)
        self.rows.append(out)

    def judge(self, texts: pa.Array) -> list[tuple[str, float]]:
        """No word spans ASCII white space: a text's counts are the sums over its chunks."""
        if self.n > CACHE_WORDS:
            self.reset()
        split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        coded = split.flatten().dictionary_encode()
        found = [WORD.findall(c.lower()) for c in coded.dictionary.to_pylist()]
        flat = list(chain.from_iterable(found))
        new = list(dict.fromkeys(w for w in flat if w not in self.at))
        for lo in range(0, len(new), 20_000):
            self.learn(new[lo:lo + 20_000])
        rows = np.concatenate(self.rows)
        self.rows = [rows]
        word = np.fromiter(map(self.at.__getitem__, flat), np.int64, len(flat))
        ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)))
        letters = np.fromiter((bool(ws) and (ws[0][0].isalpha() or any(map(str.isalpha, "".join(ws)))) for ws in found),
                              bool, len(found))
        chunk = coded.indices.to_numpy(zero_copy_only=False)
        last = np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False), dtype=np.int64)
        sums = np.stack([_sums(_sums(rows[word, k], ends)[chunk], last) for k in range(self.width + 1)])
        spoken = _sums(letters[chunk], last) > 0
        out = []
        for k, fine in enumerate(spoken.tolist()):
            if not fine or not self.width:
                out.append(("und", 0.0))
                continue
            share = (sums[:-1, k] / sums[-1, k] - self.f.false_positive) / (1 - self.f.false_positive)
            best = int(np.clip(share, 0, 1).argmax())
            out.append((self.f.languages[best], float(min(1.0, max(0.0, share[best])))))
        return out


def predict(docs: DataFrame, filters: Filters, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score (share of the text's n-grams that the language knows)."""
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(filters)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(shared.value)
        for b in slices(batches, "text"):
            got = judge.judge(b.column("text"))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([x for x, _ in got], pa.string()),
                                              pa.array([x for _, x in got], pa.float64())],
                                             names=["doc_id", "lang_pred", "score"])

    return rows.mapInArrow(run, StructType([rows.schema["doc_id"], StructField("lang_pred", StringType()),
                                            StructField("score", DoubleType())]))


def accepted(docs: DataFrame, filters: Filters, min_score: float, text_col: str = "text") -> DataFrame:
    """The rows of `docs` whose text has letters and whose best language knows
    at least `min_score` of its n-grams, with all their columns."""
    spark = docs.sparkSession
    bounded_batches(spark)
    shared, place = spark.sparkContext.broadcast(filters), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(shared.value)
        for b in slices(batches, place):
            keep = [x != "und" and score >= min_score for x, score in judge.judge(b.column(place))]
            yield b.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def labelled_rows(docs: DataFrame) -> DataFrame:
    """Rows to learn from: labelled, with text, not held out."""
    return docs.filter(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        "doc_id", "text", "lang")
