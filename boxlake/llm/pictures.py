"""Same or near-same records across splits (problem 1).

A picture is brought to one size, normalised for brightness and contrast and turned by a fixed random rotation, so that
whatever sets two pictures apart (noise of pixels or of cells, light that changes over the picture) is spread over all
coordinates alike. Its text is the signs of the coordinates, four to a letter, in passages that name their place.
Passages of the evaluation splits' texts, with all spellings of their least certain signs, go into Aho-Corasick automata,
sharded by passage and head; a shard's automaton scans the parts of all training texts that begin alike, as one text.
Hits whose sketches differ too much are dropped where they arise, the others are merged into the coverage of each
evaluation record and verified by the exact correlation. Equal records (same bytes or same hash) are one class
throughout; a group of copies of any size is one row until the requested pairs of records are written out.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxlake.functions.pictures import THUMB, content_hash, grey_pixels, thumbnail, valid_refs
from boxlake.runtime import written

#: Passages of a text, signs per passage, its first signs that name the shard, and signs that may be spelled otherwise.
PASSAGES, SIGNS, HEAD, UNSURE = 9, 20, 6, 6
#: Signs per letter of a text, and signs of a sketch with the most in which pictures may differ to be compared.
LETTER, SKETCH, APART = 4, 128, 34
#: The correlation from which two pictures count as the same.
SAME = 0.9
#: Passages and parts of texts that one shard holds on average; sketches compared at once.
SHARD_ROWS, BLOCK = 60_000, 2_000


def _rotation(seed: int, rows: int) -> np.ndarray:
    """The first rows of a random rotation of the thumbnails' space; the same everywhere."""
    n = THUMB[0] * THUMB[1]
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((n, n)))
    return (q * np.sign(np.diag(r))).T[:rows].astype(np.float32)


_TURNED = _rotation(1, PASSAGES * SIGNS)
_SKETCHED = _rotation(2, SKETCH)


def normalised(thumbs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(vectors of length 1 around 0, whether the picture has contrast) of thumbnails (n, rows * columns)."""
    x = thumbs - thumbs.mean(1, keepdims=True)
    size = np.sqrt((x * x).sum(1))
    return x / np.maximum(size, 1e-9)[:, None], size > 1e-6


def passages(vectors: np.ndarray, unsure: int = UNSURE) -> tuple[np.ndarray, np.ndarray]:
    """(codes, weak) per picture and passage: the signs as bits, and the bits of the `unsure` least certain ones."""
    x = (vectors @ _TURNED.T).reshape(len(vectors), PASSAGES, SIGNS)
    bit = (1 << np.arange(SIGNS - 1, -1, -1)).astype(np.int32)
    codes = ((x > 0) * bit).sum(-1).astype(np.int32)
    weak = bit[np.argsort(np.abs(x), -1)[..., :unsure]].sum(-1).astype(np.int32)
    return codes, weak


def sketches(vectors: np.ndarray) -> np.ndarray:
    """(n, 2) numbers of 64 signs each; signs of two pictures differ in proportion to their angle."""
    return np.packbits(vectors @ _SKETCHED.T > 0, axis=1).view(np.int64)


def spellings(codes: np.ndarray, weak: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, code) of all codes that differ from a row's in weak bits only."""
    rows, out = np.arange(len(codes)), codes.copy()
    for bit in range(SIGNS):
        may = np.nonzero(weak[rows] & (1 << bit))[0]
        rows, out = np.concatenate([rows, rows[may]]), np.concatenate([out, out[may] ^ (1 << bit)])
    return rows, out


def read_pictures(image_rows: DataFrame) -> DataFrame:
    """(image_id, picture_hash, thumb) of every row with bytes; thumb is null where the picture cannot be read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hashes, thumbs = [], []
            for data in b.column(1).to_pylist():
                hashes.append(content_hash(data))
                pixels = grey_pixels(data)
                thumbs.append(None if pixels is None else np.rint(thumbnail(pixels) * 65535).astype("<u2").tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(hashes, pa.binary()), pa.array(thumbs, pa.binary())], ["image_id", "picture_hash", "thumb"])

    rows = image_rows.select("image_id", F.col("image.bytes").alias("bytes")).filter("image_id is not null and bytes is not null")
    return rows.mapInArrow(run, "image_id string, picture_hash binary, thumb binary")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(len(column), -1).astype(np.float32)


def _parts(classes: DataFrame, unsure: int, shards: int, counted: bool = False) -> DataFrame:
    """(shard, block, code, weak, s0, s1, class_id) of classes (class_id, thumb); one row per spelling of a passage's head.

    With `counted`, only (shard, n): how many of these rows each shard gets, counted in every batch.
    """
    names = ["shard", "block", "code", "weak", "s0", "s1", "class_id"]
    head = ((1 << HEAD) - 1) << (SIGNS - HEAD)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            vectors, usable = normalised(_matrix(b.column(1)))
            codes, weak = passages(vectors, unsure)
            sketch = sketches(vectors)
            at = np.repeat(np.nonzero(usable)[0], PASSAGES)
            block = np.tile(np.arange(PASSAGES, dtype=np.int32), int(usable.sum()))
            code, weak = codes[usable].ravel(), weak[usable].ravel()
            rows, spelled = spellings(code, weak & head)
            at, block, weak = at[rows], block[rows], weak[rows] & ~head
            shard = (((spelled >> (SIGNS - HEAD)).astype(np.int64) * PASSAGES + block) * 0x9E3779B1 % (1 << 32)) % shards
            if counted:
                held, n = np.unique(shard, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(n.astype(np.int64))], ["shard", "n"])
                continue
            columns = [pa.array(shard.astype(np.int32)), pa.array(block), pa.array(spelled.astype(np.int32)), pa.array(weak.astype(np.int32)), pa.array(sketch[at, 0]), pa.array(sketch[at, 1]), b.column(0).take(pa.array(at))]
            yield pa.RecordBatch.from_arrays(columns, names)

    return classes.select("class_id", "thumb").mapInArrow(run, "shard int, n bigint" if counted else "shard int, block int, code int, weak int, s0 bigint, s1 bigint, class_id bigint")


def _text(words: np.ndarray) -> str:
    """Passages (block * 2**SIGNS + code) as one text: a letter for the block, then the signs, LETTER to a letter."""
    code = words & ((1 << SIGNS) - 1)
    shifts = range(SIGNS - LETTER, -1, -LETTER)
    letters = [0x4E00 + (words >> SIGNS), *[0x61 + (code >> s & ((1 << LETTER) - 1)) for s in shifts]]
    return np.stack(letters, 1).astype("<u4").tobytes().decode("utf-32-le")


def _scan(evals: pa.Table, trains: pa.Table) -> pa.Table:
    """Hits of one shard: an automaton over all spellings of its evaluation passages scans its training texts."""
    out = pa.schema([("eval_id", pa.int64()), ("train_id", pa.int64()), ("block", pa.int32())])
    if not evals.num_rows or not trains.num_rows:
        return out.empty_table()
    number = lambda t, name: t[name].to_numpy().astype(np.int64)
    rows, codes = spellings(number(evals, "code"), number(evals, "weak"))
    words, owner = np.unique((number(evals, "block")[rows] << SIGNS) | codes, return_inverse=True)
    order = np.argsort(owner, kind="stable")
    first = np.searchsorted(owner[order], np.arange(len(words) + 1))
    size = 1 + SIGNS // LETTER
    spelled, machine = _text(words), ahocorasick.Automaton(ahocorasick.STORE_INTS)
    for i in range(len(words)):
        machine.add_word(spelled[i * size : (i + 1) * size], i)
    machine.make_automaton()
    text = _text((number(trains, "block") << SIGNS) | number(trains, "code"))
    hits = np.array([(end // size, i) for end, i in machine.iter(text)], np.int64).reshape(-1, 2)
    if not len(hits):
        return out.empty_table()
    hits = hits[np.argsort(hits[:, 1], kind="stable")]
    sketch = lambda t: np.stack([t["s0"].to_numpy(), t["s1"].to_numpy()], 1).astype(np.int64).view(np.uint64)
    es, ts, eid, tid = sketch(evals), sketch(trains), number(evals, "class_id"), number(trains, "class_id")
    blocks = number(evals, "block")
    parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    at = np.nonzero(np.diff(hits[:, 1], prepend=-1))[0]
    for lo, hi in zip(at.tolist(), [*at[1:].tolist(), len(hits)], strict=True):
        word = int(hits[lo, 1])
        mine, theirs = rows[order[first[word] : first[word + 1]]], hits[lo:hi, 0]
        # Compared in blocks, so a passage that very many pictures share costs time but no memory.
        for i in range(0, len(mine), BLOCK):
            e = mine[i : i + BLOCK]
            for j in range(0, len(theirs), BLOCK):
                t = theirs[j : j + BLOCK]
                apart = np.bitwise_count(es[e, 0][:, None] ^ ts[t, 0][None, :]) + np.bitwise_count(es[e, 1][:, None] ^ ts[t, 1][None, :])
                x, y = np.nonzero(apart <= APART)
                if len(x):
                    parts.append((eid[e[x]], tid[t[y]], blocks[e[x]]))
    columns = [np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, np.int64) for k in range(3)]
    return pa.Table.from_arrays([pa.array(c.astype(np.int32) if k == 2 else c) for k, c in enumerate(columns)], schema=out)


def _cut(evals: tuple[DataFrame, int], trains: tuple[DataFrame, int], shards: int) -> tuple[DataFrame, DataFrame]:
    """Both sides' parts with the cell (e, t) of their shard in which they meet.

    A shard that holds far more than SHARD_ROWS, as when very many pictures share a passage, is cut into a grid: each
    passage goes to one row of cells and each part of a text to one column, so every pair still meets exactly once and
    no task gets more than a cell. Other shards are one cell.
    """
    # The parts are counted and then made again: that is cheaper than writing them.
    count = lambda side, name: _parts(*side, shards, True).groupBy("shard").agg(F.ceil(F.sum("n") / SHARD_ROWS).cast("int").alias(name))
    grid = count(evals, "ke").join(count(trains, "kt"), "shard").filter("ke + kt > 4")
    grid = written(grid, "grid")  # at most one row per 120,000 passages; small enough to be broadcast, or joined if not
    side = lambda x: _parts(*x, shards).join(grid, "shard", "left").withColumns({"ke": F.coalesce("ke", F.lit(1)), "kt": F.coalesce("kt", F.lit(1))})
    own = lambda n: F.pmod(F.xxhash64("class_id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    keep = ["shard", "block", "code", "weak", "s0", "s1", "class_id", "e", "t"]
    return side(evals).withColumn("e", own("ke")).withColumn("t", every("kt")).select(*keep), side(trains).withColumn("t", own("kt")).withColumn("e", every("ke")).select(*keep)


def near_pairs(classes: DataFrame, least: float = SAME) -> DataFrame:
    """(eval_id, train_id, coverage, correlation) of classes whose pictures correlate by `least` or more.

    classes: (class_id, thumb, in_train, in_eval); a class in both makes a pair with itself. coverage is the share of the
    evaluation picture's text that lies in matched passages. Pictures without contrast have no correlation and no pairs.
    """
    spark = classes.sparkSession
    shards = max(spark.sparkContext.defaultParallelism, -(-classes.count() * PASSAGES * 2 // SHARD_ROWS))
    evals_cut, trains_cut = _cut((classes.filter("in_eval"), UNSURE), (classes.filter("in_train"), 0), shards)
    by = ("shard", "e", "t")
    # As many tasks as shards, so what a task reads does not grow with the input.
    tasks = max(shards, int(spark.conf.get("spark.sql.shuffle.partitions")))
    evals_cut, trains_cut = evals_cut.repartition(tasks, *by), trains_cut.repartition(tasks, *by)
    hits = evals_cut.groupBy(*by).cogroup(trains_cut.groupBy(*by)).applyInArrow(_scan, "eval_id bigint, train_id bigint, block int")
    # Passages do not overlap, so merged intervals are the set of blocks.
    candidates = hits.groupBy("eval_id", "train_id").agg(F.bit_count(F.expr("bit_or(1 << block)")).alias("n"))
    thumbs = classes.select("class_id", "thumb")
    pairs = candidates.join(thumbs.withColumnsRenamed({"class_id": "eval_id", "thumb": "a"}), "eval_id").join(thumbs.withColumnsRenamed({"class_id": "train_id", "thumb": "b"}), "train_id")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            if not x.num_rows:
                continue
            a, b = (_matrix(x.column(i)).astype(np.float64) for i in (3, 4))
            a, b = a - a.mean(1, keepdims=True), b - b.mean(1, keepdims=True)
            size = np.sqrt((a * a).sum(1) * (b * b).sum(1))
            r = np.where(size > 0, (a * b).sum(1) / np.maximum(size, 1e-12), 0.0)
            keep = pa.array(r >= least - 1e-12)
            yield pa.RecordBatch.from_arrays([x.column(0), x.column(1), pa.array(np.asarray(x.column(2)) / PASSAGES), pa.array(r)], ["eval_id", "train_id", "coverage", "correlation"]).filter(keep)

    return pairs.select("eval_id", "train_id", "n", "a", "b").mapInArrow(verify, "eval_id bigint, train_id bigint, coverage double, correlation double")


def overlapping_classes(row_refs: DataFrame, image_rows: DataFrame, least: float = SAME) -> tuple[DataFrame, DataFrame]:
    """((eval_id, train_id, coverage, correlation), (ref_id, split, dataset, class_id, single)): class pairs and membership.

    A record belongs to the class of its bytes and to that of its content hash; single tells that they are one. Equal
    records whose picture cannot be read or has no contrast are paired by their hash alone, without a correlation.
    """
    pictures = written(read_pictures(image_rows), "pictures")
    refs = valid_refs(row_refs, "dataset").filter("split is not null")
    by_id = pictures.select("image_id", "picture_hash").distinct()
    held = F.array_distinct(F.filter(F.array("picture_hash", "content_hash"), lambda x: x.isNotNull()))
    refs = refs.join(by_id, "image_id", "left").select("ref_id", "split", "dataset", held.alias("held"))
    refs = written(refs.select("ref_id", "split", "dataset", (F.size("held") == 1).alias("single"), F.posexplode("held").alias("pos", "key")), "refs")
    # A class's id is its smallest (record, position of the key in that record): no other class has the same.
    classes = refs.groupBy("key").agg(F.min(F.col("ref_id") * 2 + F.col("pos")).alias("class_id"), F.max(F.col("split") == "train").alias("in_train"), F.max(F.col("split") != "train").alias("in_eval"))
    members = written(refs.join(classes, "key").select("ref_id", "split", "dataset", "class_id", "single", "in_train", "in_eval"), "members")
    looks = pictures.filter("thumb is not null").groupBy(F.col("picture_hash").alias("key")).agg(F.first("thumb").alias("thumb"))
    classed = written(classes.join(looks, "key").select("class_id", "thumb", "in_train", "in_eval"), "looks")
    near = written(near_pairs(classed, least), "near")
    scanned = near.filter("eval_id = train_id").select(F.col("eval_id").alias("class_id"))
    same = members.filter("in_train and in_eval").select("class_id").distinct().join(scanned, "class_id", "left_anti")
    same = same.selectExpr("class_id as eval_id", "class_id as train_id", "1.0D as coverage", "cast(null as double) as correlation")
    return near.unionByName(same), members.drop("in_train", "in_eval")


def cross_split_overlaps(row_refs: DataFrame, image_rows: DataFrame, least: float = SAME) -> DataFrame:
    """All pairs of a training record and a val or test record that hold the same or almost the same picture.

    Returns (eval_ref, train_ref, eval_split, eval_dataset, coverage, correlation). Records are the latest scans; the
    split is read however it is written, and a record in no known split takes no part. Records are the same if their
    bytes or their content hashes are equal (where one is missing the other tells it), near-same if their pictures,
    brought to one size, correlate by `least` or more. Records with neither bytes nor hash, unreadable pictures and
    empty tables give no pairs; repeated rows and extra columns change nothing. The pairs are as many as the result
    asks for; overlap_counts() needs no pairs.
    """
    pairs, members = overlapping_classes(row_refs, image_rows, least)
    left = members.filter("split <> 'train'").selectExpr("class_id as eval_id", "ref_id as eval_ref", "split as eval_split", "dataset as eval_dataset")
    right = members.filter("split = 'train'").selectExpr("class_id as train_id", "ref_id as train_ref")
    return pairs.join(left, "eval_id").join(right, "train_id").select("eval_ref", "train_ref", "eval_split", "eval_dataset", "coverage", "correlation")


def overlap_counts(row_refs: DataFrame, image_rows: DataFrame, least: float = SAME) -> DataFrame:
    """(ref_id, split, dataset, n_train, coverage) of every val or test record that also stands in train.

    n_train counts training records by the sizes of their classes; only records that belong to two classes, whose
    bytes and hash contradict each other, are listed so that none counts twice.
    """
    pairs, members = overlapping_classes(row_refs, image_rows, least)
    train = members.filter("split = 'train'").withColumnRenamed("class_id", "train_id")
    evals = members.filter("split <> 'train'").withColumnRenamed("class_id", "eval_id")
    sizes = train.filter("single").groupBy("train_id").agg(F.count("*").alias("n"))
    by_size = pairs.join(sizes, "train_id", "left").groupBy("eval_id").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.max("coverage").alias("coverage"))
    double = pairs.join(train.filter("not single").select("train_id", "ref_id"), "train_id").groupBy("eval_id").agg(F.count_distinct("ref_id").alias("more"))
    plain = evals.filter("single").join(by_size, "eval_id").join(double, "eval_id", "left").select("ref_id", "split", "dataset", (F.col("n") + F.coalesce("more", F.lit(0))).alias("n_train"), "coverage")
    listed = evals.filter("not single").join(pairs, "eval_id").join(train.select("train_id", F.col("ref_id").alias("train_ref")), "train_id")
    listed = listed.groupBy("ref_id", "split", "dataset").agg(F.count_distinct("train_ref").alias("n_train"), F.max("coverage").alias("coverage"))
    return plain.unionByName(listed).filter("n_train > 0")
