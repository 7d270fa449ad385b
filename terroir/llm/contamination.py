"""Benchmark decontamination by template canonicalisation.

A text becomes tokens; numbers, and unit words behind numbers, become typed
placeholders. That is its literal template. In the typed template names
(capitalised words inside a sentence) are placeholders too, a run of them one;
in the opened template so are capitalised words that open a sentence, whether
names or not, each with the names behind it. Both are joined with both, since a
word may open the item and not its sentence in the document.
Windows of `WINDOW` tokens of either template are hashed and joined with the
benchmark's windows by hash; a filter of fixed size over the benchmark's hashes
spares the other document windows the shuffle. Joined windows are collected by
document, item and alignment. Windows are consistent when one value of the item
stands for one value of the document in all of them, and that at half of the
value's places on the alignment at least; windows whose slots all have the
item's own values are consistent whatever the others hold. Capitals mark names
only where they are few: languages that write all nouns large share their
frames, so consistent windows may exchange `RENAMES` different names, or one for
each `WINDOW` tokens they cover. A document is
contaminated by an item when consistent windows cover at least
`min(RUN, tokens of the item)` of its tokens on one alignment. This finds
copies, also with some values changed, and questions with other numbers, names
or units.

Windows with fewer than half plain words are not used in the templates with
names; in the literal template they are hashed with their own values, so they
join where the document repeats them exactly. Items of fewer than `WINDOW`
tokens are looked for whole; items of fewer than `SHORTEST` tokens, or without
any plain word, cannot be told from ordinary text and match nothing.

Null and empty texts match nothing. Repeated rows give one result row; null
document ids are reported as null, and rows are told apart by id and text.
Empty tables give no rows. Very long texts are read whole. Only the id and text
columns of either table are read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terroir.llm.common import bounded_batches, key_filter, mix, ragged, slices, without, written

WINDOW, RUN, SHORTEST = 8, 13, 4
TEMPLATE_BYTES = 1 << 19  # text whose templates a worker makes at once: they take about a hundred times as much
SENT = 20_000             # windows in one batch
TOKEN = re.compile(r"\d+(?:[.,:/]\d+)*|[^\W\d_]+(?:['’][^\W\d_]+)*|[.!?\n]")
# Number words and unit words that become placeholders.
NUMBER_WORDS = frozenset("zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen "
                         "sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety "
                         "hundred thousand million billion "
                         "zwei drei vier fünf sechs sieben acht neun zehn elf zwölf zwanzig dreißig vierzig fünfzig sechzig siebzig "
                         "achtzig neunzig hundert tausend "
                         "deux trois quatre cinq sept huit neuf dix onze douze treize quatorze quinze vingt trente quarante "
                         "cinquante soixante mille "
                         "dos tres cuatro cinco seis siete ocho nueve diez doce trece catorce quince veinte treinta cuarenta "
                         "cincuenta sesenta setenta ochenta noventa cien ciento mil".split())
UNIT_WORDS = frozenset("mm cm m km in inch inches ft foot feet yd yard yards mi mile miles mg g kg t lb lbs oz pound pounds "
                       "gram grams kilogram kilograms ton tons ml l liter liters litre litres gallon gallons s sec second "
                       "seconds min minute minutes h hour hours day days week weeks month months year years percent k c f "
                       "degree degrees dollar dollars cent cents euro euros usd eur gbp j w kw v a hz mph kmh meter meters "
                       "metre metres kilometer kilometers centimeter centimeters "
                       "tag tage tagen stunde stunden minuten woche wochen monat monate jahr jahre jahren prozent "
                       "jour jours heure heures semaine semaines mois ans mètre mètres "
                       "día días hora horas minutos semana semanas meses año años metro metros".split())
NUMBER, UNIT, NAME = (np.uint64(x) for x in (11, 13, 17))
LITERAL, TYPED, OPENED = range(3)
RENAMES = 2              # different names that may be exchanged, or one for each WINDOW covered tokens
RENAMED = f"{NAME}:"     # how a name's slot begins
HITS = "key long, doc_id long, text_hash long, kind int, pos int, n int, holes array<int>, slots array<string>"
JUDGED = "doc_id long, text_hash long, item_id long, covered int, literal boolean, same boolean, item_tokens int, token int"


def lexicon(chunks: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(tokens of all chunks, (hash of the lower-case token, flags) of each, tokens of each chunk)."""
    found = [TOKEN.findall(c) for c in chunks]
    tokens = list(chain.from_iterable(found))
    rows = np.zeros((len(tokens), 2), np.uint64)
    low = [t.lower() for t in tokens]
    rows[:, 0] = np.fromiter(map(xxhash.xxh3_64_intdigest, low), np.uint64, len(low))
    rows[:, 1] = np.fromiter((
        (1 if t[0].isdigit() or w in NUMBER_WORDS else 0) | (2 if t in ".!?\n" else 0)
        | (4 if t[0].isupper() and not (len(t) > 1 and t.isupper()) else 0) | (8 if w in UNIT_WORDS else 0)
        for t, w in zip(tokens, low)), np.uint64, len(low))
    return tokens, rows, np.fromiter(map(len, found), np.int64, len(found))


def templates(texts: pa.Array):
    """(token strings, their place by token, [(kind, codes, first token, tokens, text,
    codes of the values themselves or None) of the templates]). No token spans ASCII white space, so a text is its
    chunks' tokens one after the other; line ends become stops."""
    split = pc.ascii_split_whitespace(pc.replace_substring(pc.fill_null(texts, ""), "\n", " . "))
    coded = split.flatten().dictionary_encode()
    words, kinds, per_chunk = lexicon(coded.dictionary.to_pylist())
    chunk = coded.indices.to_numpy(zero_copy_only=False)
    word = ragged((np.cumsum(per_chunk) - per_chunk)[chunk], per_chunk[chunk])
    per_text = pc.list_value_length(split).to_numpy(zero_copy_only=False)
    doc = np.repeat(np.repeat(np.arange(len(texts)), per_text), per_chunk[chunk])
    code, flag = kinds[word, 0], kinds[word, 1]
    stop = (flag & np.uint64(2)) > 0
    fresh = np.ones(len(code), bool)  # behind a sentence's end, or first in its text
    fresh[1:] = stop[:-1] | (doc[1:] != doc[:-1])
    place = np.flatnonzero(~stop)
    code, flag, fresh, doc = code[place], flag[place], fresh[place], doc[place]
    number = (flag & np.uint64(1)) > 0
    after = np.zeros(len(code), bool)
    after[1:] = number[:-1] & (doc[1:] == doc[:-1])
    unit = after & ((flag & np.uint64(8)) > 0) & ~number
    capital = ((flag & np.uint64(4)) > 0) & ~number & ~unit
    own = code.copy()
    code[number], code[unit] = NUMBER, UNIT
    size = np.ones(len(code), np.int64)
    out = [(LITERAL, code, place, size, doc, own)]
    for kind, name in ((TYPED, capital & ~fresh), (OPENED, capital)):
        if (name & fresh).any() if kind == OPENED else name.any():
            inner = np.zeros(len(code), bool)
            inner[1:] = name[1:] & name[:-1] & ~fresh[1:]
            kept = np.flatnonzero(~inner)
            typed = np.where(name, NAME, code)[kept]
            # tokens of a run of names lie side by side, stops never between them
            out.append((kind, typed, place[kept], np.diff(np.append(kept, len(code))), doc[kept], None))
    return words, word, out


def windows(code: np.ndarray, doc: np.ndarray, size: int, typed: bool, own: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """(starts, hashes) of the windows inside one text with enough plain words; by
    their own codes, if given, of the others too."""
    n = len(code) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h = np.full(n, size * 4 + typed, np.uint64)
    for k in range(size):
        h = h * np.uint64(0x9E3779B97F4A7C15) + code[k:k + n]
    plain = np.concatenate([[0], np.cumsum(code > np.uint64(17))])
    inside = doc[:n] == doc[size - 1:]
    ok = inside & (2 * (plain[size:] - plain[:n]) >= size)
    if own is not None:
        rest = np.flatnonzero(inside & ~ok)
        exact = np.full(len(rest), size * 4 + 2, np.uint64)
        for k in range(size):
            exact = exact * np.uint64(0x9E3779B97F4A7C15) + own[rest + k]
        h[rest], ok = exact, inside
    starts = np.flatnonzero(ok)
    return starts, mix(h[starts])


def template_windows(rows: DataFrame, sizes: list[int], bits: np.ndarray | None, whole: bool) -> DataFrame:
    """Windows of `rows` (doc_id, text, text_hash); `bits` keeps those the filter
    may hold, `whole` (the benchmark) adds shorter items as one window. `n` is
    the text's number of tokens in the template."""
    spark = rows.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for b in slices(batches, "text", TEMPLATE_BYTES):
            words, word, kinds = templates(b.column("text"))
            ids, prints = b.column("doc_id").to_pylist(), b.column("text_hash").to_pylist()
            out: list[tuple] = []
            for kind, code, place, run_len, doc, own_code in kinds:
                count = np.bincount(doc, minlength=len(ids))
                worded = np.bincount(doc[code > NAME], minlength=len(ids)) > 0
                first = np.cumsum(count) - count
                for size in sizes:
                    starts, hashes = windows(code, doc, size, kind != LITERAL, own_code)
                    if whole:
                        some = worded[doc[starts]]
                        starts, hashes = starts[some], hashes[some]
                    if whole and size < WINDOW:
                        own = count[doc[starts]] == size
                        starts, hashes = starts[own], hashes[own]
                    if known is not None:
                        at = (hashes & np.uint64(len(known) * 32 - 1)).astype(np.int64)
                        hit = ((known[at // 32] >> (at % 32).astype(np.uint32)) & np.uint32(1)) > 0
                        starts, hashes = starts[hit], hashes[hit]
                    for s, h in zip(starts.tolist(), hashes.view(np.int64).tolist()):
                        d = int(doc[s])
                        holes = [k for k in range(size) if code[s + k] <= NAME]
                        slots = [f"{int(code[k])}:{' '.join(words[w] for w in word[place[k]:place[k] + run_len[k]]).lower()}"
                                 for k in (s + h for h in holes)]
                        out.append((h, ids[d], prints[d], kind, s - int(first[d]), int(count[d]), holes, slots))
                        if len(out) == SENT:
                            yield _sent(out)
                            out = []
            if out:
                yield _sent(out)

    return rows.mapInArrow(run, HITS)


def _sent(out: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (
        pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.string())))],
        names=["key", "doc_id", "text_hash", "kind", "pos", "n", "holes", "slots"])


def agreed(at: list[int], pairs: list[list[tuple[int, str, str]]], size: int, need: int) -> list[int]:
    """Sorted starts of consistent windows that cover `need` tokens, or none. `at`:
    the windows' starts in the item; `pairs`: (place in the item, its value, the
    document's value) of each one's slots.

    Two windows reach from the first to the last of any such windows, and cover
    `need` tokens by themselves: looking at all pairs of windows misses nothing."""
    literal = sorted(a for a, p in zip(at, pairs) if all(i == d for _, i, d in p))
    values: dict[str, dict[int, str]] = {}
    for k, i, d in chain.from_iterable(pairs):
        values.setdefault(i, {})[k] = d
    stands = {i: {d for d, n in Counter(v.values()).items() if 2 * n >= len(v)} for i, v in values.items()}
    # windows by what they choose where two values stand at half of the places each
    chosen: dict[frozenset, list[int]] = {}
    for a, p in sorted(zip(at, pairs)):
        pick = frozenset((i, d) for _, i, d in p if len(stands[i]) > 1)
        if all(d in stands[i] for _, i, d in p) and len(dict(pick)) == len(pick):
            chosen.setdefault(pick, []).append(a)
    reach, best = need - 1, None
    last = sorted(chosen, key=lambda c: -chosen[c][-1])
    for one in chosen:  # by their first windows
        for other in last:
            far = chosen[other][-1] - chosen[one][0] + size
            if far <= reach:
                break
            if len(dict(one | other)) == len(one | other):
                reach, best = far, one | other
                break
    kept: list[int] = []
    for pick in sorted(chosen, key=lambda c: -len(chosen[c])) if best is not None else []:
        if pick <= best or len(dict(best | pick)) == len(best | pick):
            best |= pick
            kept += chosen[pick]
    kept = sorted(kept)
    taken = set(kept)
    renamed = {i for a, p in zip(at, pairs) if a in taken for _, i, d in p if i != d and i.startswith(RENAMED)}
    if len(renamed) > max(RENAMES, cover(kept, size) // WINDOW):
        kept = []
    most = max(literal, kept, key=lambda starts: cover(starts, size))
    return most if cover(most, size) >= need else []


def cover(starts: list[int], size: int) -> int:
    """Tokens that windows at sorted starts cover."""
    return sum(min(size, b - a) for a, b in zip(starts, starts[1:])) + size if starts else 0


def judged(alignments: DataFrame) -> DataFrame:
    """The alignments on which consistent windows cover enough tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for r in b.to_pylist():
                at = [w["item_pos"] for w in r["windows"]]
                pairs = [[(w["item_pos"] + h, i, d) for h, i, d in zip(w["item_holes"], w["item_slots"], w["slots"])] for w in r["windows"]]
                starts = agreed(at, pairs, r["size"], min(RUN, r["item_tokens"]))
                if starts:
                    out.append({"doc_id": r["doc_id"], "text_hash": r["text_hash"], "item_id": r["item_id"], "covered": cover(starts, r["size"]),
                                "literal": r["kind"] == LITERAL, "same": all(i == d for _, i, d in chain.from_iterable(pairs)),
                                "item_tokens": r["item_tokens"], "token": r["shift"] + starts[0]})
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([
                ("doc_id", pa.int64()), ("text_hash", pa.int64()), ("item_id", pa.int64()), ("covered", pa.int32()), ("literal", pa.bool_()),
                ("same", pa.bool_()), ("item_tokens", pa.int32()), ("token", pa.int32())]))

    return alignments.mapInArrow(run, JUDGED)


def _texts(rows: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return rows.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       F.xxhash64(text_col).alias("text_hash"))


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per contaminated document and item: doc_id, text_hash, item_id, typed
    (names were replaced), tokens covered, tokens of the item, whether all slots
    have the item's own values, the first covered token's place in the document."""
    items = _texts(benchmark, item_id_col, item_text_col)
    small = list(range(SHORTEST, WINDOW))
    bench = written(template_windows(items, [*small, WINDOW], None, True).select(
        "key", F.col("doc_id").alias("item_id"), F.col("text_hash").alias("item_hash"), F.col("kind").alias("item_kind"), F.col("pos").alias("item_pos"),
        F.col("n").alias("item_tokens"), F.col("holes").alias("item_holes"), F.col("slots").alias("item_slots")).withColumn(
            "size", F.least("item_tokens", F.lit(WINDOW))), "bench-windows")
    sizes = sorted(r["size"] for r in bench.select("size").distinct().collect())  # 4 to 8 at most
    bits = key_filter(bench, "key", hashed=True)
    hits = template_windows(_texts(docs, id_col, text_col), sizes, bits, False).drop("n", "holes")
    met = hits.join(bench, "key").filter((F.col("kind") == LITERAL) == (F.col("item_kind") == LITERAL))
    on = met.groupBy("doc_id", "text_hash", "item_id", "item_hash", "kind", "item_kind", (F.col("pos") - F.col("item_pos")).alias("shift")).agg(
        F.collect_set(F.struct("item_pos", "item_holes", "item_slots", "slots")).alias("windows"),
        F.first("size").alias("size"), F.first("item_tokens").alias("item_tokens"))
    # what all windows cover; no fewer than the consistent ones
    covered = F.expr("aggregate(transform(at, (x, k) -> least(size, coalesce(try_element_at(at, k + 2) - x, size))), 0, (a, x) -> a + x)")
    near = on.withColumn("at", F.array_sort("windows.item_pos")).filter(covered >= F.least(F.lit(RUN), "item_tokens")).drop("at")
    kept = judged(near)
    best = F.max(F.struct("covered", "literal", "same", "item_tokens", "token"))
    out = kept.groupBy("doc_id", "text_hash", "item_id").agg(best.alias("b"))
    return out.select("doc_id", "text_hash", "item_id", F.col("b.covered").alias("covered"), F.col("b.item_tokens").alias("item_tokens"),
                      F.col("b.literal").alias("literal"), F.col("b.same").alias("same_slots"), F.col("b.token").alias("token"))


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that no item contaminates, with all their columns."""
    found = written(contaminated(docs, benchmark, id_col, text_col).select("doc_id", "text_hash").distinct(), "contaminated")
    return without(docs, [F.col(id_col).cast("long"), F.xxhash64(text_col)], found)
