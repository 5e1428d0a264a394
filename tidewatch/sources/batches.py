"""Batch files: discovery by name, robust reading, and features joined to targets by row position.

A batch is `dataset_<id>_feats.csv` with an optional `dataset_<id>_target.csv`. Either may be one
file or a folder of part files, and either may carry the extension twice.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import clean_category, decimal_convention, normalize_decimal, parse_decimal, to_double
from ..session import pinned
from ..spec import FeatureSpec

# The naming convention of batch files.
_NAME = r"(?i)/dataset_([^/]+?)_(feats|target)\.csv(\.csv)?(?:/[^/]+)?$"
_SOURCE = r"(?i)^(.*/dataset_[^/]+?_(?:feats|target)\.csv(?:\.csv)?)(?:/[^/]+)?$"


def _named(path: Column) -> dict[str, Column]:
    return {
        "batch_id": F.regexp_extract(path, _NAME, 1),
        "kind": F.lower(F.regexp_extract(path, _NAME, 2)),
        "extension": F.lower(F.regexp_extract(path, _NAME, 3)),
        "source": F.regexp_extract(path, _SOURCE, 1),
    }


def _plain(path: Column) -> Column:
    """One spelling of a path: listings and scans differ in the slashes after the scheme."""
    return F.regexp_replace(path, "^([a-z0-9]+):/+", "$1:/")


def batch_files(spark: SparkSession, directory: str) -> DataFrame:
    """(path, length, batch_id, kind, extension, source) of every batch file, empty ones too.

    The names come from the file system: a scan would leave out files without content.
    """
    root = spark._jvm.org.apache.hadoop.fs.Path(directory)
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(root):
        raise FileNotFoundError(f"no batch directory {directory}")
    listing, found = system.listFiles(root, True), []
    while listing.hasNext():
        status = listing.next()
        if not status.getPath().getName().startswith(("_", ".")):
            found.append((status.getPath().toString(), status.getLen()))
    files = spark.createDataFrame(found, "path string, length bigint")
    return files.withColumn("path", _plain(F.col("path"))).withColumns(_named(F.col("path"))).where("batch_id != ''")


def discover_batches(spark: SparkSession, directory: str) -> DataFrame:
    """(batch_id, features, target, has_target) of a directory; no content is read.

    Both sides are paired by the extracted id, case-insensitively on the convention. Of several
    targets the one with the extension of the features wins, then the doubled extension. Several feature files with
    one id are several batches: their batch_id then carries the file's place in the directory.
    """
    sources = batch_files(spark, directory).select("batch_id", "kind", "extension", "source").distinct()
    features = sources.where("kind = 'feats'").select(F.col("batch_id").alias("id"), "extension", F.col("source").alias("features"))
    targets = sources.where("kind = 'target'").select(
        F.col("batch_id").alias("id"), F.col("extension").alias("t_extension"), F.col("source").alias("target"))
    folder = F.regexp_extract("features", "^(.*)/[^/]+$", 1)
    order = F.struct(F.regexp_extract("target", "^(.*)/[^/]+$", 1) != folder, F.col("t_extension") != F.col("extension"),
                     -F.length("t_extension"), "target")
    paired = features.join(targets, "id", "left").groupBy("id", "features").agg(F.min_by("target", order).alias("target"))
    same = Window.partitionBy("id")
    root = _plain(F.lit(str(spark._jvm.org.apache.hadoop.fs.Path(directory).toString()).rstrip("/")))
    place = F.expr("substring(features, greatest(1, locate(_root, features)) + length(_root) + 1)")
    found = paired.withColumns({"_n": F.count("*").over(same), "_root": root}).select(
        F.when(F.col("_n") > 1, F.concat_ws("@", "id", place)).otherwise(F.col("id")).alias("batch_id"), "features", "target",
        F.col("target").isNotNull().alias("has_target"))
    if found.isEmpty():
        raise FileNotFoundError(f"no file named dataset_<id>_feats.csv in {directory}")
    return found.orderBy("features")


def _chosen_files(spark: SparkSession, batches: DataFrame, directory: str) -> DataFrame:
    """(path, length, source, batch_id, kind) of the files of the batches."""
    sources = batches.select("batch_id", F.explode(F.array(
        F.struct(F.lit("feats").alias("kind"), F.col("features").alias("source")),
        F.struct(F.lit("target").alias("kind"), F.col("target").alias("source")))).alias("s")).select("batch_id", "s.*")
    return batch_files(spark, directory).select("path", "length", "source").join(sources, "source")


def _unpacked_sizes(spark: SparkSession, files: DataFrame) -> DataFrame:
    """(path, size) of gzip files: what their last four bytes say about their content, modulo 2^32; -1 if they are too short."""
    sizes = []
    for r in files.where("length > 0").select("path", "length").distinct().collect():  # the listing, one row a file
        path, size = spark._jvm.org.apache.hadoop.fs.Path(r.path), -1
        if r.length >= 18:
            stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).open(path)
            try:
                stream.seek(r.length - 4)
                size = sum(stream.readUnsignedByte() << (8 * k) for k in range(4))
            finally:
                stream.close()
        sizes.append((r.path, size))
    return spark.createDataFrame(sizes, "path string, size bigint")


def failed_files(spark: SparkSession, batches: DataFrame, directory: str, lines: DataFrame) -> DataFrame:
    """(batch_id, path, reason) of files that could not be read as they are: `damaged` or `encoding`.

    A gzip file that ends early or is broken inside gives only its first lines, or none. So the bytes of its lines are held
    against the size in its last bytes (of a file of one member, as writers make it). Plain files have no such
    check: their size is that of the listing. Zero characters tell a file in another encoding, or no text at all.
    """
    files = _chosen_files(spark, batches, directory)
    broken = lines.where(F.contains("value", F.lit("\u0000"))).select("batch_id", "path", F.lit("encoding").alias("reason")).distinct()
    packed = files.where(F.col("path").endswith(".gz"))
    if packed.isEmpty():
        return broken
    seen = (spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.gz").option("ignoreCorruptFiles", "true")
            .option("lineSep", "\n").text(directory)
            .groupBy(F.col("_metadata.file_path").alias("path")).agg(F.sum(F.octet_length("value") + 1).alias("n"))
            .withColumn("path", _plain(F.col("path"))))
    # a last line without an end counts one byte too many, a byte order mark is not counted
    apart = F.pmod(F.coalesce("n", F.lit(0)) - F.col("size"), F.lit(1 << 32))
    whole = apart.isin(0, 1, (1 << 32) - 3, (1 << 32) - 2)
    damaged = (packed.join(_unpacked_sizes(spark, packed), "path").join(seen, "path", "left").where((F.col("size") < 0) | ~whole)
               .select("batch_id", "path", F.lit("damaged").alias("reason")))
    return damaged.unionByName(broken.join(damaged, ["batch_id", "path"], "left_anti"))


def read_lines(spark: SparkSession, batches: DataFrame, directory: str) -> DataFrame:
    """Every non-blank line of the chosen files with its place in the file and its number of quotes, written once.

    Which bytes form a split depends on the cluster, so the lines are pinned before positions are
    counted: later stages must not see another cut. Files that break off give the lines before the break. Only the listing
    of files is broadcast; no line is shuffled or sorted.
    """
    chosen = _chosen_files(spark, batches, directory).drop("length")
    quoted = F.length("value") - F.length(F.translate("value", '"', ""))
    lines = (
        spark.read.option("recursiveFileLookup", "true").option("ignoreCorruptFiles", "true").text(directory)
        .where(F.col("value").rlike("[^ \t\r\ufeff]"))
        .select("value", _plain(F.col("_metadata.file_path")).alias("path"), F.col("_metadata.file_block_start").alias("block_start"))
        .withColumn("line_id", F.monotonically_increasing_id())
        .withColumn("quotes", F.when(F.contains("value", F.lit('"')), quoted).otherwise(0))
    )
    return pinned(lines.join(F.broadcast(chosen), "path"))


def _header_is_data(kind: Column, line: Column) -> Column:
    """A target file whose first line is a number has no header; a feature file always has one."""
    return (kind == "target") & parse_decimal(F.btrim(line, F.lit("\ufeff"))).isNotNull()


SPLIT = ("batch_id", "source", "kind", "path", "block_start")


def _inside_quotes(lines: DataFrame, splits: DataFrame) -> DataFrame:
    """The lines of files that have a line with an odd number of quotes, with `starts`: whether a record begins there.

    A line between quotes that an earlier line opened continues that record. Such files are ordered split by split; the
    list of splits carries the parity over.
    """
    file_of = Window.partitionBy("batch_id", "source", "path")
    earlier = file_of.orderBy("block_start").rowsBetween(Window.unboundedPreceding, -1)
    parity = splits.select(*SPLIT, F.coalesce(F.sum("odd").over(earlier), F.lit(0)).alias("_open"), F.sum("odd").over(file_of).alias("_odd"))
    before = Window.partitionBy(*SPLIT).orderBy("line_id").rowsBetween(Window.unboundedPreceding, -1)
    quotes = F.col("_open") + F.coalesce(F.sum("quotes").over(before), F.lit(0))
    return lines.join(F.broadcast(parity.where("_odd > 0")), list(SPLIT)).withColumn("starts", quotes % 2 == 0).drop("_open", "_odd")


def index_rows(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, headers): data rows with a zero-based `row_index` per source, and (batch_id, source, path, header).

    Lines of one split are consecutive, so a row's place is its distance from the first line of its
    split plus the rows of the splits before it: no window spans more than the list of splits. Only files with line breaks
    inside quotes are counted record by record; blank lines count nowhere. The list of splits is broadcast, so lines stay
    where they are.
    """
    # first lines are looked up by id: a text in the aggregate would have Spark sort all lines for it
    sizes = lines.groupBy(*SPLIT).agg(
        F.count("*").alias("n_lines"), F.min("line_id").alias("first_id"), F.sum(F.col("quotes") % 2).alias("odd"))
    firsts = lines.select("batch_id", F.col("line_id").alias("first_id"), F.col("value").alias("first_line"))
    splits = pinned(firsts.join(F.broadcast(sizes), ["batch_id", "first_id"]))  # one row per split, read for parity, offsets and headers
    inside = pinned(_inside_quotes(lines, splits))
    begun = inside.groupBy(*SPLIT).agg(F.count_if("starts").alias("n_begun"))
    has_header = (F.col("block_start") == 0) & ~_header_is_data(F.col("kind"), F.col("first_line"))
    counted = splits.join(begun, list(SPLIT), "left").withColumns({
        "skip": has_header.cast("int"), "n_records": F.coalesce("n_begun", "n_lines")})
    earlier = (Window.partitionBy("batch_id", "source").orderBy(F.length("path"), "path", "block_start")
               .rowsBetween(Window.unboundedPreceding, -1))
    offsets = counted.select(
        *SPLIT, "first_id", "skip", F.col("n_begun").isNotNull().alias("_quoted"),
        F.coalesce(F.sum(F.col("n_records") - F.col("skip")).over(earlier), F.lit(0)).alias("offset"))
    headers = counted.where("skip = 1").select("batch_id", "source", "kind", "path", F.btrim("first_line", F.lit("\ufeff")).alias("header"))
    plain = lines.join(F.broadcast(offsets.where("not _quoted")), list(SPLIT)).where("line_id >= first_id + skip").withColumn(
        "row_index", F.col("offset") + F.col("line_id") - F.col("first_id") - F.col("skip"))
    upto = Window.partitionBy(*SPLIT).orderBy("line_id")
    numbered = inside.join(F.broadcast(offsets), list(SPLIT)).withColumn(
        "row_index", F.col("offset") + F.sum(F.col("starts").cast("int")).over(upto) - 1 - F.col("skip"))
    parts = F.array_sort(F.collect_list(F.struct("line_id", "value")))
    records = numbered.groupBy("batch_id", "kind", "source", "path", "row_index").agg(
        F.array_join(F.transform(parts, lambda x: x["value"]), "\n").alias("value")).where("row_index >= 0")
    columns = ["batch_id", "kind", "source", "path", "row_index", "value"]
    # the header of a file with quoted breaks has the index before its first row
    starts = offsets.where("_quoted and skip = 1").select("batch_id", "path", F.col("offset").alias("_first"))
    records = records.join(starts.groupBy("batch_id", "path").agg(F.min("_first").alias("_first")), ["batch_id", "path"], "left").where(
        "row_index >= coalesce(_first, 0)")
    return plain.select(*columns).unionByName(records.select(*columns)), headers


def _fields(line: Column, width: int) -> Column:
    """Quoted-aware fields of a CSV record as an array of text, from one parse: taken straight from the struct, every field
    would have a parse of its own."""
    schema = ", ".join(f"_c{i} string" for i in range(width))
    parsed = F.from_csv(line, schema, {"mode": "PERMISSIVE", "quote": '"', "escape": '"', "lineSep": "\u0001"})
    return F.get(F.transform(F.array(parsed), lambda r: F.array(*[r[f"_c{i}"] for i in range(width)])), F.lit(0))


@dataclass(frozen=True)
class LoadedBatches:
    rows: DataFrame      # batch_id, row_index, features, target, has_target, scored, unparsed
    batches: DataFrame   # batch_id, has_target, n_features, n_target
    columns: DataFrame   # batch_id, column: the headers
    failures: DataFrame | None = None  # batch_id, path, reason: files that make their batch unreadable


def parse_features(rows: DataFrame, headers: DataFrame, spec: FeatureSpec) -> tuple[DataFrame, DataFrame]:
    """Typed feature rows and the (batch, column) list of the headers.

    Columns are picked by each file's own header, so files may order or omit columns differently.
    """
    heads = headers.where("kind = 'feats'")
    width = heads.agg(F.max(F.length("header") - F.length(F.translate("header", ",", "")) + 1)).first()[0] or 1
    names = F.transform(_fields(F.col("header"), width), lambda n: F.lower(F.btrim(n, F.lit(" \t\"\ufeff"))))
    heads = heads.select("batch_id", "path", names.alias("names"))
    named = rows.where("kind = 'feats'").join(F.broadcast(heads), ["batch_id", "path"]).withColumn("_f", _fields(F.col("value"), width))

    def pick(column: str) -> Column:
        return F.get("_f", (F.array_position("names", column) - 1).cast("int"))

    text = {c: pick(c) for c in spec.features}
    raw = named.select("batch_id", "row_index", *[e.alias(c) for c, e in text.items()])
    numbers = {c: normalize_decimal(F.col(c)) for c in spec.numeric}
    clean = raw.withColumns(numbers).withColumns({f"_n_{c}": to_double(F.col(c)) for c in spec.numeric})
    failed = [F.when(F.col(c).isNotNull() & F.col(f"_n_{c}").isNull(), F.lit(c)) for c in spec.numeric]
    typed = clean.select(
        "batch_id", "row_index", *[F.col(f"_n_{c}").alias(c) for c in spec.numeric],
        *[clean_category(F.col(c)).alias(c) for c in spec.categorical],
        (F.array_compact(F.array(*failed)) if failed else F.array().cast("array<string>")).alias("unparsed"))
    present = rows.where("kind = 'feats'").select("batch_id", "path").distinct().join(heads, ["batch_id", "path"]) \
        .select("batch_id", F.explode("names").alias("column")).distinct()
    return typed, present


def parse_targets(rows: DataFrame, target: str) -> DataFrame:
    """One number per line, in any decimal convention."""
    text = normalize_decimal(F.col("value"))
    return rows.where("kind = 'target'").select(
        "batch_id", "row_index", to_double(text).alias(target),
        (text.isNotNull() & to_double(text).isNull()).alias("target_failed"))


def target_conventions(rows: DataFrame) -> DataFrame:
    """Decimal convention of each batch's target, from all its rows."""
    return rows.where("kind = 'target'").groupBy("batch_id").agg(decimal_convention(
        F.bool_or(F.contains("value", F.lit(","))), F.bool_or(F.contains("value", F.lit(".")))).alias("convention"))


def join_by_position(features: DataFrame, targets: DataFrame, batches: DataFrame, target: str) -> LoadedBatches:
    """Pair both files row by row; rows beyond the shorter file are kept but not `scored`."""
    n_features = features.groupBy("batch_id").agg(F.count("*").alias("n_features"))
    n_target = targets.groupBy("batch_id").agg(F.count("*").alias("n_target"))
    sizes = (
        batches.select("batch_id", "has_target").join(n_features, "batch_id", "left").join(n_target, "batch_id", "left")
        .select("batch_id", "has_target", F.coalesce("n_features", F.lit(0)).alias("n_features"),
                F.when(F.col("has_target"), F.coalesce("n_target", F.lit(0))).alias("n_target"))
    )
    joined = (
        features.join(targets.withColumn("_paired", F.lit(True)), ["batch_id", "row_index"], "left")
        .join(batches.select("batch_id", "has_target"), "batch_id")
        .withColumn("scored", ~F.col("has_target") | F.coalesce("_paired", F.lit(False))).drop("_paired", "target_failed")
    )
    return LoadedBatches(joined, sizes, None)


def load_batches(spark: SparkSession, directory: str, spec: FeatureSpec) -> LoadedBatches:
    """All batches of a directory: discovered, read, repaired and paired.

    A batch with a file that failed keeps its row in `batches`, without any row of its own: half a batch is not scored. The
    other batches are read as if it were not there.
    """
    batches = discover_batches(spark, directory)
    lines = read_lines(spark, batches, directory)
    failures = pinned(failed_files(spark, batches, directory, lines))
    # at most one row a batch
    lines = lines.join(F.broadcast(failures.select("batch_id").distinct()), "batch_id", "left_anti")
    rows, headers = index_rows(lines)
    features, present = parse_features(rows, headers, spec)
    loaded = join_by_position(features, parse_targets(rows, spec.target), batches, spec.target)
    # a row a batch, and one a column of its header: callers read them several times
    return LoadedBatches(loaded.rows, pinned(loaded.batches), pinned(present), failures)
