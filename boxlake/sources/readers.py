"""Readers of raw sources: files in, canonical rows and import statistics out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boxlake.functions.headers import size_of
from boxlake.schema import SPLITS, require_canonical
from boxlake.sources import formats as X
from boxlake.sources.config import SourceConfig
from boxlake.sources.ingest import ingest
from boxlake.sources.json_stream import stream_json

# Suffixes of pictures.
PICTURES = ("jpg", "jpeg", "png", "bmp", "webp", "pgm")


def _exists(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        raise FileNotFoundError(path)


def _name(path: Column) -> Column:
    return F.url_decode(F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\+", "%2B"))


def _stem(name: Column) -> Column:
    return F.regexp_replace(name, r"\.[^.]*$", "")


def pictures(spark: SparkSession, folder: str, pattern: str = "*", suffixes: tuple[str, ...] = PICTURES) -> DataFrame:
    """(image_path, name, stem, rel, content, width, height) of the picture files under a folder."""
    _exists(spark, folder)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder)
    path = F.regexp_replace("path", r"^file:/*", "/")
    files = files.select(path.alias("image_path"), _name(F.col("path")).alias("name"), "content").filter(F.lower(F.regexp_extract("name", r"\.([^.]+)$", 1)).isin(*suffixes))
    root = folder.rstrip("/") + "/"
    rel = F.when(F.col("image_path").startswith(root), F.substring("image_path", len(root) + 1, 100_000)).otherwise(F.col("name"))
    return files.withColumn("stem", _stem(F.col("name"))).withColumn("rel", rel).withColumn("s", size_of("content")).select("image_path", "name", "stem", "rel", "content", "s.width", "s.height")


def texts(spark: SparkSession, folder: str, pattern: str = "*.txt") -> DataFrame:
    """(name, stem, value) of whole text files."""
    _exists(spark, folder)
    t = spark.read.text(folder, wholetext=True, pathGlobFilter=pattern, recursiveFileLookup=True)
    t = t.select(_name(F.input_file_name()).alias("name"), "value")
    return t.withColumn("stem", _stem(F.col("name")))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), r"\r?\n")


def _present(o: Column) -> Column:
    return F.filter(o, lambda x: x.isNotNull())


def coco(spark: SparkSession, cfg: SourceConfig, split: str) -> DataFrame:
    """COCO JSON; a picture whose size contradicts the file is skipped, a missing picture raises."""
    s = cfg.split(split)
    _exists(spark, s.path("annotations"))
    images, notes, cats = X.coco_tables(stream_json(spark, s.path("annotations")))
    objects = X.coco_objects(notes, cats)
    files = pictures(spark, s.path("images")).select(F.col("rel").alias("file_name"), "image_path", "content", "width", "height")
    own = images.select("pos", F.col("id").alias("source_id"), "file_name", F.col("width").alias("jw"), F.col("height").alias("jh"))
    df = own.join(files, "file_name", "left").join(objects.withColumnRenamed("image_id", "source_id"), "source_id", "left")
    missing = F.raise_error(F.concat(F.lit("missing picture "), F.col("file_name"))).cast("string")
    df = df.withColumn("image_path", F.coalesce("image_path", missing))
    part = s.meta.get("condition_from_file_name_part")
    condition = F.lit(None).cast("string") if part is None else X.path_part(F.col("file_name"), int(part))
    meta = F.to_json(F.struct(F.lit("coco").alias("source_annotation_format"), F.col("file_name").alias("source_file_name"), F.col("source_id").alias("source_image_id")))
    odd = (F.col("jw") > 0) & (F.col("jh") > 0) & ((F.col("jw") != F.col("width")) | (F.col("jh") != F.col("height")))
    return df.filter(~F.coalesce(odd, F.lit(False))).select("pos", "source_id", "image_path", "width", "height", "content", "raw", condition.alias("condition"), meta.alias("meta_json"))


def bdd100k(spark: SparkSession, cfg: SourceConfig, split: str) -> DataFrame:
    """Scalabel JSON; the condition is the frame's weather, else the source's default, the domain is the road."""
    s = cfg.split(split)
    _exists(spark, s.path("annotations"))
    frames = X.scalabel_frames(stream_json(spark, s.path("annotations")))
    files = pictures(spark, s.path("images")).select(F.col("rel").alias("source_id"), "image_path", "content", "width", "height")
    df = frames.join(files, "source_id", "left")
    missing = F.raise_error(F.concat(F.lit("missing picture "), F.col("source_id"))).cast("string")
    return df.select("pos", "source_id", F.coalesce("image_path", missing).alias("image_path"), "width", "height", "content", "raw", F.coalesce("condition", F.lit(cfg.default_condition)).alias("condition"), F.lit("road").alias("domain"), "meta_json")


def pascal_voc(spark: SparkSession, cfg: SourceConfig, split: str) -> DataFrame:
    """VOC XML for the ids of an image set; missing files raise."""
    s = cfg.split(split)
    for k in ("image_set", "annotations", "images"):
        _exists(spark, s.path(k))
    ids = spark.read.text(s.path("image_set")).select(F.monotonically_increasing_id().alias("pos"), F.get(F.split(F.trim("value"), r"\s+"), F.lit(0)).alias("source_id")).filter("source_id <> ''")
    xml = texts(spark, s.path("annotations"), "*.xml").select(F.col("stem").alias("source_id"), X.voc_objects(F.col("value")).alias("v"))
    df = ids.join(xml, "source_id", "left")
    fail = lambda what: F.raise_error(F.concat(F.lit(f"missing {what} of "), F.col("source_id"))).cast("string")
    df = df.withColumn("name", F.when(F.col("v").isNull(), fail("annotation")).otherwise(F.coalesce(F.nullif(F.trim("v.filename"), F.lit("")), F.concat("source_id", F.lit(".jpg")))))
    files = pictures(spark, s.path("images")).select("name", "image_path", "content", "width", "height")
    df = df.join(files, "name", "left")
    meta = F.to_json(F.struct(F.lit("pascal_voc").alias("source_annotation_format"), F.col("name").alias("source_file_name")))
    return df.select("pos", "source_id", F.coalesce("image_path", fail("picture")).alias("image_path"), "width", "height", "content", F.col("v.raw").alias("raw"), meta.alias("meta_json"))


def visdrone(spark: SparkSession, cfg: SourceConfig, split: str) -> DataFrame:
    s = cfg.split(split)
    files = pictures(spark, s.path("images"), "*.jpg")
    notes = texts(spark, s.path("annotations")).select("stem", "value", F.lit(True).alias("there"))
    df = files.join(notes, "stem", "left")
    fail = F.raise_error(F.concat(F.lit("missing annotation of "), F.col("name"))).cast("string")
    raw = _present(F.transform(_lines(F.col("value")), lambda x, i: X.visdrone_line(x, i + 1)))
    meta = F.to_json(F.struct(F.concat("stem", F.lit(".txt")).alias("source_annotation_file"), F.lit("visdrone_det").alias("source_annotation_format"), F.col("name").alias("source_file_name")))
    return df.select(F.col("stem").alias("source_id"), F.coalesce(F.when(F.col("there"), F.col("image_path")), fail).alias("image_path"), "width", "height", "content", raw.alias("raw"), meta.alias("meta_json"))


def _yolo(spark: SparkSession, cfg: SourceConfig, split: str, names: dict[int, str]) -> DataFrame:
    s = cfg.split(split)
    notes = texts(spark, s.path("labels")).select("stem", "value")
    df = pictures(spark, s.path("images")).join(notes, "stem", "left")
    # A picture without a label file has no objects (and is dropped later).
    raw = F.when(F.col("value").isNull(), F.array().cast(f"array<{X.RAW}>")).otherwise(_present(F.transform(_lines(F.col("value")), lambda x, i: X.yolo_line(x, F.col("width"), F.col("height"), names, i + 1))))
    label_file = F.concat(F.lit(s.path("labels").rstrip("/") + "/"), "stem", F.lit(".txt"))
    meta = F.to_json(F.struct(F.lit("yolo").alias("source_annotation_format"), F.col("name").alias("source_file_name"), label_file.alias("source_label_file")))
    return df.select(F.col("stem").alias("source_id"), "image_path", "width", "height", "content", raw.alias("raw"), meta.alias("meta_json"))


def yolo(spark: SparkSession, cfg: SourceConfig, split: str) -> DataFrame:
    """YOLO text with the class names of the root's data.yaml."""
    import yaml

    path = f"{cfg.split(split).root.rstrip('/')}/data.yaml"
    _exists(spark, path)
    data = yaml.safe_load("\n".join(r["value"] for r in spark.read.text(path).coalesce(1).collect()))  # one small file
    names = data.get("names")
    names = {int(k): str(v) for k, v in names.items()} if isinstance(names, dict) else dict(enumerate(map(str, names or [])))
    if not names or (data.get("nc") is not None and int(data["nc"]) != len(names)):
        raise ValueError(f"{path}: class names are missing or do not match nc")
    return _yolo(spark, cfg, split, names)


def yolo_noyml(spark: SparkSession, cfg: SourceConfig, split: str) -> DataFrame:
    """YOLO text with the class names of the configuration; ids may have gaps."""
    if not cfg.class_names:
        raise ValueError(f"source {cfg.key} needs class_names")
    return _yolo(spark, cfg, split, cfg.class_names)


def nearest_names(left: DataFrame, right: DataFrame, cols: list[str], name: str = "name") -> DataFrame:
    """left with the right row of the same name, or of the same name in other case (the first by name); others are left out."""
    r = right.select(F.lower(name).alias("__k"), F.col(name).alias("__found"), *[F.col(c).alias(f"__{c}") for c in cols])
    j = left.withColumn("__k", F.lower(name)).join(r, "__k").withColumn("__odd", F.col("__found") != F.col(name))
    best = F.min_by(F.struct(*[F.col(f"__{c}").alias(c) for c in cols]), F.struct("__odd", "__found")).alias("__best")
    keep = left.columns
    held = [F.first(c).alias(c) for c in keep if c == "content"]  # pixels are no key
    return j.groupBy(*[c for c in keep if c != "content"]).agg(best, *held).select(*keep, "__best.*")


def exdark(spark: SparkSession, cfg: SourceConfig, split: str) -> DataFrame:
    """ExDark: pictures of the image list in the split; file names match in any case if not exactly, missing ones are skipped."""
    s = cfg.split(split)
    for k in ("image_list", "images", "annotations"):
        _exists(spark, s.path(k))
    listed = spark.read.text(s.path("image_list")).select(X.exdark_list_line(F.col("value")).alias("r")).filter("r is not null").select("r.*").filter(F.col("split") == split)
    files = pictures(spark, s.path("images")).select("name", "image_path", "content", "width", "height")
    notes = texts(spark, s.path("annotations")).select(_stem(F.col("name")).alias("name"), "value")

    df = nearest_names(nearest_names(listed, notes, ["value"]), files, ["image_path", "content", "width", "height"])
    raw = _present(F.transform(_lines(F.col("value")), lambda x, i: X.exdark_line(x, i + 1)))
    meta = F.to_json(F.struct(F.col("class").alias("image_class"), F.col("place").alias("indoor_outdoor"), "lighting", F.lit("exdark").alias("source_annotation_format"), F.col("name").alias("source_file_name")))
    return df.select(F.col("name").alias("source_id"), "image_path", "width", "height", "content", raw.alias("raw"), meta.alias("meta_json"))


READERS: dict[str, Callable[[SparkSession, SourceConfig, str], DataFrame]] = {
    "coco": coco, "bdd100k": bdd100k, "pascal_voc": pascal_voc, "visdrone_det": visdrone, "yolo": yolo, "yolo_noyml": yolo_noyml, "exdark": exdark,
}


def reader(source_format: str) -> Callable[[SparkSession, SourceConfig, str], DataFrame]:
    if source_format not in READERS:
        raise ValueError(f"unknown source format {source_format!r}; supported: {', '.join(sorted(READERS))}")
    return READERS[source_format]


def read_split(spark: SparkSession, cfg: SourceConfig, split: str) -> tuple[DataFrame, DataFrame]:
    """(canonical rows in the source's order, statistics) of one split of a raw source."""
    cfg.split(split)
    return ingest(reader(cfg.source_format)(spark, cfg, split), cfg, split, ordered=True)


def convert(spark: SparkSession, cfg: SourceConfig, output: str, splits: list[str] | None = None, force: bool = False, rows_per_file: int = 0) -> dict[str, dict]:
    """Writes each output split as output/<split>; returns the import statistics per output split.

    Everything is checked before anything is written; an empty split becomes an empty table with the schema.
    """
    plan = cfg.output_splits(splits)
    reader(cfg.source_format)
    if not force:
        p = lambda x: spark._jvm.org.apache.hadoop.fs.Path(x)
        if held := [t for t in plan if p(output).getFileSystem(spark._jsc.hadoopConfiguration()).exists(p(f"{output}/{t}"))]:
            raise FileExistsError(f"{output} already has {', '.join(held)}; use force to replace them")
    out: dict[str, dict] = {}
    for target, name in plan.items():
        rows, stats = read_split(spark, cfg, name)
        rows.write.mode("overwrite" if force else "errorifexists").option("maxRecordsPerFile", rows_per_file).parquet(f"{output}/{target}")
        out[target] = stats.first().asDict()
    return out


def load_canonical(spark: SparkSession, folder: str, split: str | None = None, dataset: str | None = None, position: str | None = None) -> DataFrame:
    """Converted rows of one split, or of all; a folder with other splits, or rows with another schema, raise.

    With `dataset`, rows that name another dataset or split than the folder's raise when they are read. `position` names
    a column for a row's place in the folder's files, which convert() writes in the source's order.
    """
    p = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        raise FileNotFoundError(folder)
    found = sorted(f.getPath().getName() for f in fs.listStatus(p) if f.isDirectory())
    if odd := [f for f in found if f not in SPLITS]:
        raise ValueError(f"unexpected splits in {folder}: {', '.join(odd)}")
    if split is not None and split not in found:
        raise KeyError(f"no split {split!r}; available: {', '.join(found)}")
    parts = []
    for s in found:
        if split in (None, s):
            part = spark.read.parquet(f"{folder}/{s}")
            require_canonical(part)
            if position:
                part = part.select("*", F.struct(F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row")).alias(position))
            if dataset is not None:
                odd = ~(F.col("dataset").eqNullSafe(F.lit(dataset)) & F.col("split").eqNullSafe(F.lit(s)))
                said = F.concat(F.lit(f"row of {dataset}/{s} says "), F.coalesce("dataset", F.lit("nothing")), F.lit("/"), F.coalesce("split", F.lit("nothing")), F.lit(": "), F.coalesce("image_id", F.lit("?")))
                part = part.withColumn("dataset", F.when(odd, F.raise_error(said).cast("string")).otherwise(F.col("dataset")))
            parts.append(part)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def with_fallback_bytes(rows: DataFrame, files: DataFrame) -> DataFrame:
    """rows with missing picture bytes taken from files (image_path, content); a picture with neither raises."""
    path = F.coalesce(F.nullif("image.path", F.lit("")), F.col("image_path"))
    j = rows.withColumn("__p", F.when(F.col("image.bytes").isNull(), path)).join(files.select(F.col("image_path").alias("__p"), F.col("content").alias("__c")), "__p", "left")
    fail = F.raise_error(F.concat(F.lit("no bytes and no file of "), F.col("image_id"))).cast("binary")
    return j.withColumn("image", F.struct(F.coalesce("image.bytes", "__c", fail).alias("bytes"), F.col("image.path").alias("path"))).drop("__p", "__c")


def driving_export(csv: DataFrame, sizes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(images, annotations) of a CSV export of boxes: files of the third version only, ids by sorted file name.

    csv: filename, width, height, class, xmin, ymin, xmax, ymax; sizes: filename, width, height of the picture files.
    Rows of unknown files are skipped; a box without area or outside its picture raises.
    """
    from boxlake.operators.splits import dense_number, timestamp_block_split

    need = {"filename", "width", "height", "class", "xmin", "ymin", "xmax", "ymax"}
    if missing := sorted(need - set(csv.columns)):
        raise ValueError(f"missing columns: {', '.join(missing)}")
    own = sizes.filter(F.col("filename").rlike(X.DRIVING_EXPORT)).select("filename", F.col("width").alias("fw"), F.col("height").alias("fh"))
    stamp = F.regexp_extract("filename", X.DRIVING_EXPORT, 1).cast("decimal(30,0)").cast("bigint")
    first = csv.groupBy("filename").agg(F.max(F.col("width").cast("int")).alias("cw"), F.max(F.col("height").cast("int")).alias("ch"))
    images = dense_number(own, "filename", "id", 1).join(first, "filename", "left").select("id", "filename", F.coalesce("cw", "fw").alias("width"), F.coalesce("ch", "fh").alias("height"), timestamp_block_split(stamp).alias("split"))
    x1, y1, x2, y2 = (F.col(c).cast("double") for c in ("xmin", "ymin", "xmax", "ymax"))
    fine = (x2 > x1) & (y2 > y1) & (x1 >= 0) & (y1 >= 0) & (x2 <= F.col("width")) & (y2 <= F.col("height"))
    box = F.when(fine, F.array(x1, y1, x2 - x1, y2 - y1)).otherwise(F.raise_error(F.concat(F.lit("invalid box in "), F.col("filename"))).cast("array<double>"))
    notes = csv.drop("width", "height").join(images, "filename").select(F.col("id").alias("image_id"), "filename", F.trim("class").alias("category"), box.alias("bbox"), "split", x1.alias("x"), y1.alias("y"), F.monotonically_increasing_id().alias("line"))
    return images, notes
