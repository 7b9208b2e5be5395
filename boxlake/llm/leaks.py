"""Evaluation texts leaking into training text (problem 7).

Seeds are n-grams of letters of an item's words that begin where a word does. One pass over the documents brings each
text to plain words and looks for seeds at every letter, so neither spacing nor words broken at line ends matter; a table
of bits of fixed size tells most places apart, whatever the number of items. Seeds are counted first, as numbers; the
rare ones join the documents to the items, and the passage around them is aligned to the item by banded Smith-Waterman,
which scores edited and paraphrased copies. An exact check of eight consecutive words follows the alignment.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxlake.llm.words import bounds, words
from boxlake.runtime import written

#: Letters per seed, of a seed where eight words have fewer, and the consecutive words that make a leak.
SEED, SHORT_SEED, RUN = 20, 8, 8
#: A seed in more than this number of (document, item) pairs is common: it only counts where no rarer one covers its stretch.
RARE = 1_000_000
#: log2 of the bits in the table of seeds, and words by which an alignment may leave the diagonals of its seeds.
BITS, BAND = 27, 256
#: The least score that is returned where fewer than RUN words match.
LEAST = 0.5
#: Smith-Waterman scores of equal words, different words and gaps.
EQUAL, DIFFERENT, GAP = 2, -1, -1

_BASE = np.uint64(0x9E3779B97F4A7C15)


def window_hashes(codes: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of every window of `size` code points, as signed numbers, put together from windows of powers of two."""
    if len(codes) < size:
        return np.zeros(0, np.int64)
    part, width, power = codes.astype(np.uint64) + np.uint64(1), 1, _BASE
    h, done = np.zeros(len(codes) - size + 1, np.uint64), 0
    with np.errstate(over="ignore"):
        while True:
            if size & width:
                h = h * power + part[done : done + len(h)]
                done += width
            if width * 2 > size:
                break
            part = part[:-width] * power + part[width:]
            power, width = power * power, width * 2
        h = h ^ np.uint64(size)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return (h ^ (h >> np.uint64(32))).astype(np.int64)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def item_seeds(item: list[str]) -> list[tuple[int, int, int, int]]:
    """(hash, letter, word, size) of an item's seeds.

    Every stretch of eight words (or the whole of a shorter item) holds one: its first letters, SEED of them or, where
    it has fewer, SHORT_SEED. An item of fewer letters than that has none.
    """
    starts = np.concatenate([[0], np.cumsum([len(w) for w in item])]).astype(int)
    codes, out = _codes("".join(item)), {}
    long, short = window_hashes(codes, SEED), window_hashes(codes, SHORT_SEED)
    for i in range(len(item)):
        if starts[i] < len(long):
            out[i, SEED] = (int(long[starts[i]]), int(starts[i]), i, SEED)
        end = starts[min(len(item), i + RUN)]
        if (i == 0 or i + RUN <= len(item)) and end - starts[i] < SEED and starts[i] + SHORT_SEED <= end:
            out[i, SHORT_SEED] = (int(short[starts[i]]), int(starts[i]), i, SHORT_SEED)
    return list(out.values())


def repaired(passage: list[str], item: list[str]) -> list[str]:
    """The passage's words with those joined or divided that only then are words of the item."""
    held, pairs = set(item), {a + b: (a, b) for a, b in zip(item, item[1:], strict=False)}
    out, i = [], 0
    while i < len(passage):
        if passage[i] in held:
            out.append(passage[i])
        elif passage[i] in pairs:
            out += pairs[passage[i]]
        else:
            joined = next((n for n in (2, 3, 4) if "".join(passage[i : i + n]) in held and i + n <= len(passage)), 0)
            if joined:
                out.append("".join(passage[i : i + joined]))
                i += joined
                continue
            out.append(passage[i])
        i += 1
    # A word whose beginning is itself a word of the item: joined only where what follows is none.
    k = 0
    while k + 1 < len(out):
        if out[k + 1] not in held and out[k] + out[k + 1] in held:
            out[k : k + 2] = [out[k] + out[k + 1]]
        k += 1
    return out


def align(item: list[str], passage: list[str], band: int | None = None) -> tuple[float, int]:
    """(score, matched) of the best local alignment: score as a share of the item's own, matched words of the item.

    A cell holds score and matched words in one number, so that two rows of the table suffice. With a band, cells
    further than that from the diagonals on which the passage holds three words of the item in a row are left out; where there
    is no such diagonal, none is.
    """
    if not item or not passage:
        return 0.0, 0
    code = {w: i for i, w in enumerate(dict.fromkeys(item))}
    a, b = np.array([code[w] for w in item]), np.array([code.get(w, -1) for w in passage])
    n, one = len(b), 1 << 24
    slope = -GAP * one * np.arange(1, n + 1, dtype=np.int64)
    lo, hi = -len(a), n
    if band is not None and len(a) + n > 2 * band and min(len(a), n) >= 3:
        grams: dict[tuple[int, int, int], list[int]] = {}
        for i in range(len(a) - 2):
            grams.setdefault((int(a[i]), int(a[i + 1]), int(a[i + 2])), []).append(i)
        diagonals = [j - i for j in range(n - 2) for i in grams.get((int(b[j]), int(b[j + 1]), int(b[j + 2])), ())]
        if diagonals:
            lo, hi = min(diagonals) - band, max(diagonals) + band
    best, last = 0, np.zeros(n + 1, np.int64)
    for i, w in enumerate(a):
        j0, j1 = max(0, i + lo), min(n, i + hi + 1)
        if j0 >= j1:
            continue
        row = np.maximum(last[j0:j1] + np.where(b[j0:j1] == w, EQUAL * one + 1, DIFFERENT * one), last[j0 + 1 : j1 + 1] + GAP * one)
        row = np.maximum(row, 0)
        row = np.maximum(np.maximum.accumulate(row + slope[j0:j1]) - slope[j0:j1], 0)
        last = np.zeros(n + 1, np.int64)
        last[j0 + 1 : j1 + 1] = row
        best = max(best, int(row.max()))
    return (best >> 24) / (EQUAL * len(item)), best & (one - 1)


def longest_run(item: list[str], passage: list[str], least: int = RUN) -> int:
    """The most consecutive words of the item that the passage holds; 0 if they are fewer than `least`.

    Compared without spaces, so words broken anywhere in the passage match; a run must begin and end where a word of
    the passage does.
    """
    text, edges, best, k = "".join(passage), bounds(passage), 0, 0
    while k + max(least, best + 1) <= len(item):
        size = max(least, best + 1)
        while k + size <= len(item) and _stands("".join(item[k : k + size]), text, edges):
            best, size = size, size + 1
        k += 1
    return best


def _stands(part: str, text: str, edges: set[int]) -> bool:
    at = text.find(part)
    while at >= 0:
        if at in edges and at + len(part) in edges:
            return True
        at = text.find(part, at + 1)
    return False


def _seed_table(items: DataFrame) -> DataFrame:
    """(item, hash, size, word, n_words) of all items (item, words): a seed begins at `word` and touches n_words words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: list[tuple] = []
            for k, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                item = text.split(" ")
                starts = np.concatenate([[0], np.cumsum([len(w) for w in item])])
                for h, letter, word, size in item_seeds(item):
                    last = int(np.searchsorted(starts, letter + size))  # words up to the one that holds its last letter
                    rows.append((k, h, size, word, last - word))
            cols = list(zip(*rows, strict=True)) or [[]] * 5
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], ["item", "hash", "size", "word", "n_words"])

    return items.select("item", "words").mapInArrow(run, "item bigint, hash bigint, size int, word int, n_words int")


def _bit_table(seeds: DataFrame) -> np.ndarray:
    """Two bits per seed in a table of 2**BITS bits; what is collected is bounded by the table, not by the items."""
    mask = (1 << BITS) - 1
    at = F.explode(F.array(F.col("hash").bitwiseAND(F.lit(mask)), F.shiftrightunsigned("hash", BITS).bitwiseAND(F.lit(mask)))).alias("at")
    held = seeds.select("hash").distinct().select(at).groupBy(F.shiftright("at", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("bits"))
    table = np.zeros(1 << (BITS - 6), np.int64)
    rows = held.toPandas()
    table[rows["w"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64)
    return table.view(np.uint64)


def _holds(table: np.ndarray, h: np.ndarray) -> np.ndarray:
    u, mask = h.view(np.uint64), np.uint64((1 << BITS) - 1)
    out = np.ones(len(h), bool)
    for at in (u & mask, (u >> np.uint64(BITS)) & mask):
        out &= (table[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1
    return out


def _hits(documents: DataFrame, doc_id: str, text: str, table: np.ndarray, sizes: tuple[int, ...]) -> DataFrame:
    """(doc, words, hashes, chars) of documents that hold seeds: their plain words and where in them seeds begin."""
    shared = documents.sparkSession.sparkContext.broadcast(table)  # of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            tokens = [words(t) for t in batch.column(1).to_pylist()]
            wholes = ["".join(t) for t in tokens]
            ends = np.cumsum([len(w) for w in wholes]).astype(np.int64)
            codes = _codes("".join(wholes))
            found: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
            for size in sizes:
                h = window_hashes(codes, size)
                at = np.nonzero(_holds(bits, h))[0]
                if not len(at):
                    continue
                doc = np.searchsorted(ends, at, "right")
                inside = at + size <= ends[doc]
                at, doc = at[inside], doc[inside]
                for d in np.unique(doc).tolist():
                    mine = at[doc == d]
                    found.setdefault(d, []).append((h[mine], mine - (ends[d] - len(wholes[d]))))
            rows, texts, hashes, chars = [], [], [], []
            for d, parts in sorted(found.items()):
                letter = np.concatenate([p[1] for p in parts])
                token = np.searchsorted(np.cumsum([len(w) for w in tokens[d]]), letter, "right")
                rows.append(d)
                texts.append(" ".join(tokens[d]))
                hashes.append(np.concatenate([p[0] for p in parts]))
                chars.append(letter + token)
            lists = [pa.array([x.tolist() for x in col], pa.list_(pa.int64())) for col in (hashes, chars)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), pa.array(texts, pa.string()), *lists], ["doc", "words", "hashes", "chars"])

    rows = documents.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc"), F.col(f"`{text}`").alias("text")).filter("doc is not null and text is not null and text <> ''")
    return rows.mapInArrow(run, "doc bigint, words string, hashes array<bigint>, chars array<bigint>")


def _joining(seeds: DataFrame, hits: DataFrame) -> DataFrame:
    """The seeds (with hash, item, letter, ...) that join: the rare ones, and the rarest of every eight words that documents hold."""
    counts = hits.select(F.explode(F.array_distinct("hashes")).alias("hash")).groupBy("hash").agg(F.count("*").alias("n_docs"))
    owners = seeds.groupBy("hash").agg(F.count_distinct("item").alias("n_items"))
    counted = written(seeds.join(counts.join(owners, "hash"), "hash"), "seeds")  # a seed in no document joins nothing
    rare = F.col("n_docs") * F.col("n_items") <= RARE
    stretch = F.explode(F.sequence(F.greatest(F.lit(0), F.col("word") + F.col("n_words") - RUN), F.col("word"))).alias("stretch")
    least = counted.filter(F.col("n_words") <= RUN).select("item", "hash", "n_docs", "n_items", stretch).groupBy("item", "stretch").agg(F.min(F.struct(F.col("n_docs") * F.col("n_items"), "hash")).alias("m")).select("item", "m.hash").distinct().withColumn("least", F.lit(True))
    return counted.join(least, ["item", "hash"], "left").filter(rare | F.col("least")).select("hash", "item")


def _windows(pairs: DataFrame) -> DataFrame:
    """(row, doc, item, lo, hi): stretches of a document's words, in characters, around the seeds of an item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, los, his = [], [], []
            for i, (at, span) in enumerate(zip(b.column(3).to_pylist(), b.column(4).to_pylist(), strict=True)):
                at, start = sorted(at), 0
                for j in range(1, len(at) + 1):
                    if j < len(at) and at[j] - at[j - 1] <= span:
                        continue
                    rows.append(i)
                    los.append(max(0, at[start] - span))
                    his.append(at[j - 1] + span)
                    start = j
            take = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([*(b.column(k).take(take) for k in range(3)), pa.array(los, pa.int32()), pa.array(his, pa.int32())], ["row", "doc", "item", "lo", "hi"])

    return pairs.select("row", "doc", "item", "at", "span").mapInArrow(run, "row bigint, doc bigint, item bigint, lo int, hi int")


def leaks(documents: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", band: int = BAND, least: float = LEAST) -> DataFrame:
    """(doc_id, item_id, score, matched, run) of documents that hold passages of evaluation items.

    score is the best local alignment's share of the item's own score (1: the whole item, word for word), matched the
    item's words in it, run the most consecutive item words found exactly (0 below eight). Pairs that match fewer than
    eight words and score below `least` are left out; those whose common words cannot reach either are not aligned. Every exact copy of eight
    consecutive words holds a seed that joins; an edited copy is found if it keeps SEED letters of the item that begin
    a word, unless all it keeps are common and a rarer seed of the same words stands in other documents. The documents
    are read once, whatever the number of items. Null and empty texts hold nothing; an item of fewer letters than a
    short seed cannot be found; an item_id given twice is searched in both its texts; documents repeated under other
    ids are returned under each.
    """
    as_words = F.pandas_udf(lambda s: s.map(lambda t: " ".join(words(t)) if t else ""), "string")
    wanted = items.select(F.col(f"`{item_id}`").cast("bigint").alias("item_id"), as_words(F.col(f"`{item_text}`")).alias("words")).filter("item_id is not null and words <> ''").distinct()
    wanted = written(wanted.withColumn("item", F.monotonically_increasing_id()), "items")
    seeds = written(_seed_table(wanted), "item-seeds")
    sizes = tuple(r["size"] for r in seeds.select("size").distinct().collect())  # SEED and perhaps SHORT_SEED
    hits = _hits(documents, doc_id, text, _bit_table(seeds), sizes)
    hits = written(hits.withColumn("row", F.monotonically_increasing_id()), "hits")
    joining = _joining(seeds, hits)
    found = hits.select("row", "doc", F.explode(F.arrays_zip("hashes", "chars")).alias("h")).select("row", "doc", F.col("h.hashes").alias("hash"), F.col("h.chars").alias("at"))
    pairs = found.join(joining, "hash").groupBy("row", "doc", "item").agg(F.collect_list("at").alias("at"))
    # A copy may have more spaces than the item where words are broken: half as much again, and a little.
    pairs = pairs.join(wanted.select("item", (F.length("words") * 3 / 2 + 24).cast("int").alias("span")), "item")
    cut = F.expr("substring(words, lo + 1, hi - lo)")
    passages = _windows(pairs).join(hits.select("row", "words"), "row").select("doc", "item", "lo", (F.length("words") > F.col("hi")).alias("more"), cut.alias("passage"))
    passages = passages.join(wanted.select("item", "item_id", F.col("words").alias("item_words")), "item")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for doc, k, item, passage, lo, more in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                item, tokens = item.split(" "), passage.split(" ")
                # Words that the cut divides are left out.
                tokens = [t for t in tokens[1 if lo else 0 : len(tokens) - 1 if more else None] if t]
                mended = repaired(tokens, item)
                common = sum((Counter(item) & Counter(mended)).values())
                if common < RUN and common < least * len(item):
                    continue
                score, matched = align(item, mended, band)
                if matched >= RUN or score >= least:
                    out.append((doc, k, score, matched, longest_run(item, tokens) if matched >= RUN else 0))
            cols = list(zip(*out, strict=True)) or [[]] * 5
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], ["doc_id", "item_id", "score", "matched", "run"])

    # Alignment costs far more than reading: passages are spread evenly first.
    spread = passages.repartition(passages.sparkSession.sparkContext.defaultParallelism * 2, "doc", "item", "lo")
    scored = spread.select("doc", "item_id", "item_words", "passage", "lo", "more").mapInArrow(run, "doc_id bigint, item_id bigint, score double, matched int, run int")
    best = F.max(F.struct("score", "matched")).alias("b")
    return scored.groupBy("doc_id", "item_id").agg(best, F.max("run").alias("run")).select("doc_id", "item_id", "b.score", "b.matched", "run")
