"""Daily CSV drop folder: listing (A1), fingerprints (A2), records (A4), machine list (A5).

Files are read with the line-oriented text source, so a large file is split
across tasks like any other input.  Exact 1-based line numbers come from the
scan's row position inside each file block plus the line counts of the earlier
blocks of the same file (one small row per block).  Records that span lines
(a quoted field with a newline) are glued back by grouping only the lines that
belong to such records; everything else stays a one-line record.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hourmeter.functions import exprs as X
from hourmeter.functions.constants import DAILY_FILE_PATTERN
from hourmeter.operators.sliced import sliced_running_max

# A quoted field that is still open after this many lines was not meant to be one.
MAX_RECORD_LINES = 1000

# One CSV token: a quoted run (possibly unterminated), a plain run, or a comma.
_TOKEN = r'("(?:[^"]++|"")*+"?|[^",]++|,)'
_QUOTED_BODY = r'^"((?:[^"]++|"")*+)"?$'


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """The files right in ``folder``, from the file system's listing: (file_name, path, length, modified).

    A listing holds what the readers skip as well: files without a byte.  It is file metadata, one entry a
    file; no content is read.
    """
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(folder)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    rows = [
        (st.getPath().getName(), st.getPath().toString(), st.getLen(), st.getModificationTime())
        for st in (fs.listStatus(p) if fs.exists(p) else [])
        if st.isFile()
    ]
    return spark.createDataFrame(rows, "file_name string, path string, length bigint, modified bigint")


def list_daily_files(spark: SparkSession, folder: str, pattern: str = DAILY_FILE_PATTERN) -> DataFrame:
    """A1: telemetry files in a folder (name matches the daily pattern), empty ones included."""
    return list_files(spark, folder).where(F.col("file_name").rlike(pattern))


def glob_escaped(path: str) -> str:
    """A path that the readers take literally."""
    return re.sub(r"([\\\[\]{}*?,])", r"\\\1", path)


def read_lines(spark: SparkSession, paths) -> DataFrame:
    """Physical lines with exact line numbers: (file_name, file_path, block, line_no, line)."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    if not paths:
        return spark.createDataFrame([], "file_name string, file_path string, block bigint, line_no bigint, line string")
    raw = spark.read.option("lineSep", "\n").text([glob_escaped(p) for p in paths])
    scanned = raw.select(
        F.col("value").alias("line"),
        F.col("_metadata.file_path").alias("file_path"),
        F.url_decode(F.replace("_metadata.file_name", F.lit("+"), F.lit("%2B"))).alias("file_name"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("_mid"),
    )
    blocks = scanned.groupBy("file_path", "block").agg(F.min("_mid").alias("_mid0"), F.count("*").alias("_n"))
    w = Window.partitionBy("file_path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select("file_path", "block", "_mid0", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    return scanned.join(offsets, ["file_path", "block"]).select(
        "file_name",
        "file_path",
        "block",
        (F.col("_off") + F.col("_mid") - F.col("_mid0") + 1).alias("line_no"),
        "line",
    )


def file_fingerprints(lines: DataFrame) -> DataFrame:
    """A2: content fingerprint per file, computed as a distributed aggregate.

    bit_xor of a 64-bit hash of (line number, text) plus the line and byte counts;
    no file is gathered into one task.
    """
    return lines.groupBy("file_name").agg(
        F.concat_ws(
            "-",
            F.lower(F.hex(F.bit_xor(F.xxhash64("line_no", "line")))),
            F.count("*").cast("string"),
            F.sum(F.octet_length("line")).cast("string"),
        ).alias("checksum")
    )


def parse_fields(raw: Column) -> Column:
    """CSV fields of one record (RFC 4180 as the source parser reads it).

    Outside quotes: ',' splits, '\\r' is dropped.  A '"' opens a quoted run anywhere,
    '""' inside it is a literal quote, and an unterminated run lasts to the end.
    Records without a quote take the plain ``split`` path.
    """
    plain = F.split(F.regexp_replace(raw, "\r", ""), ",", -1)
    toks = F.regexp_extract_all(raw, F.lit(_TOKEN), 1)
    init = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("cur"))

    def step(acc, tok):
        piece = F.when(
            F.substring(tok, 1, 1) == '"',
            F.regexp_replace(F.regexp_extract(tok, _QUOTED_BODY, 1), '""', '"'),
        ).otherwise(F.regexp_replace(tok, "\r", ""))
        return F.when(
            tok == ",",
            F.struct(F.concat(acc["done"], F.array(acc["cur"])).alias("done"), F.lit("").alias("cur")),
        ).otherwise(F.struct(acc["done"].alias("done"), F.concat(acc["cur"], piece).alias("cur")))

    quoted = F.aggregate(toks, init, step, lambda acc: F.concat(acc["done"], F.array(acc["cur"])))
    return F.when(raw.contains('"'), quoted).otherwise(plain)


def quoted_spans(odd: DataFrame, last_lines: DataFrame, most_lines: int = MAX_RECORD_LINES) -> DataFrame:
    """(file_path, start, end, closed): the records that span lines, from the lines with an odd number of quotes.

    ``odd`` has file_path, block, line_no.  Such lines open and close records in turn, except that a quote which
    finds no partner within ``most_lines`` lines is stray (end is null), and the next one opens again.  So only
    the place since the last wide gap counts, which is a window inside each file block and one row a block
    beyond it.  A record may also run into the end of the file, as the source parser has it (closed is false),
    if that is not farther away.
    """
    inside = Window.partitionBy("file_path", "block").orderBy("line_no")
    own = odd.select(
        "file_path", "block", "line_no",
        F.row_number().over(inside).alias("_rn"),
        F.lag("line_no").over(inside).alias("_prev"),
        F.lead("line_no").over(inside).alias("_next"),
    )
    blocks = own.groupBy("file_path", "block").agg(F.min("line_no").alias("_a"), F.max("line_no").alias("_z"), F.count("*").alias("_n"))
    wb = Window.partitionBy("file_path").orderBy("block")
    around = blocks.select(
        "file_path", "block",
        F.lag("_z").over(wb).alias("_before"),
        F.lead("_a").over(wb).alias("_after"),
        F.coalesce(F.sum("_n").over(wb.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"),
    )
    placed = own.join(around, ["file_path", "block"]).select(
        "file_path", "block", "line_no",
        (F.col("_off") + F.col("_rn")).alias("_place"),
        F.coalesce("_prev", "_before").alias("_prev"),
        F.coalesce("_next", "_after").alias("_next"),
    )
    wide = F.col("_prev").isNull() | (F.col("line_no") - F.col("_prev") > most_lines)
    since = sliced_running_max(
        placed, keys=["file_path"], order=["line_no"], slice_col=F.col("block"), value=F.when(wide, F.col("_place")), out="_first"
    )
    openers = since.where(F.pmod(F.col("_place") - F.col("_first"), F.lit(2)) == 0).join(last_lines, "file_path")
    closed = F.coalesce(F.col("_next") - F.col("line_no") <= most_lines, F.lit(False))
    to_end = F.col("_next").isNull() & (F.col("last_line") - F.col("line_no") <= most_lines)
    return openers.select(
        "file_path",
        F.col("line_no").alias("start"),
        F.when(closed, F.col("_next")).when(to_end, F.col("last_line")).alias("end"),
        closed.alias("closed"),
    )


def records_from_lines(lines: DataFrame, most_lines: int = MAX_RECORD_LINES) -> DataFrame:
    """A4: (file_name, line_no, raw_line, fields), blank records dropped.

    ``lines`` needs file_name, file_path, block, line_no, line.  A line with a stray quote (see ``quoted_spans``)
    is a record of its own with a single field, which the column count rule rejects; the lines after it are read
    as if it had none.  So no record holds more than ``most_lines`` + 1 lines.
    """
    text = F.when(F.col("line_no") == 1, F.regexp_replace("line", r"^\x{FEFF}", "")).otherwise(F.col("line"))
    q = F.length("line") - F.length(F.regexp_replace("line", '"', ""))
    base = lines.withColumn("line", text).withColumn("_q", q)
    # Fast path: in a file without any quote every line is one record, so the
    # pass over quotes runs only for files that have quotes.  The per-file flag
    # is one small row per file.
    flags = base.groupBy("file_path").agg(F.max(F.col("_q") > 0).alias("_has_q"), F.max("line_no").alias("last_line"))
    base = base.join(flags.select("file_path", "_has_q"), "file_path")
    plain = base.where(~F.col("_has_q")).select(
        "file_name", "line_no", F.regexp_replace("line", "\r", "").alias("raw_line"), F.lit(False).alias("_stray")
    )
    base = base.where(F.col("_has_q")).drop("_has_q")
    odd = base.where(F.col("_q") % 2 == 1).select("file_path", "block", "line_no")
    spans = quoted_spans(odd, flags.select("file_path", "last_line"), most_lines)
    held = spans.select(
        "file_path",
        F.explode(F.sequence("start", F.coalesce("end", "start"))).alias("line_no"),
        F.when(F.col("end").isNotNull(), F.col("start")).alias("_rec"),
        F.col("end").isNull().alias("_stray"),
        F.when(F.col("closed"), F.col("end")).alias("_last"),
    )
    base = base.join(held, ["file_path", "line_no"], "left")
    # a '\r' before the newline is dropped only when the line ends outside quotes
    trimmed = F.regexp_replace("line", "\r$", "")
    single = base.where(F.col("_rec").isNull()).select(
        "file_name", "line_no",
        F.when(F.col("_q") == 0, F.regexp_replace("line", "\r", "")).otherwise(trimmed).alias("raw_line"),
        F.coalesce("_stray", F.lit(False)).alias("_stray"),
    )
    line = F.when(F.col("line_no") == F.col("_last"), trimmed).otherwise(F.col("line"))
    glued = base.where(F.col("_rec").isNotNull()).groupBy("file_path", "file_name", "_rec").agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("line_no", line.alias("line")))), lambda x: x["line"]), "\n"
        ).alias("raw_line")
    )
    glued = glued.select("file_name", F.col("_rec").alias("line_no"), "raw_line", F.lit(False).alias("_stray"))
    recs = plain.unionByName(single).unionByName(glued).where(X.collapse("raw_line") != "")
    fields = F.when(F.col("_stray"), F.array("raw_line")).otherwise(parse_fields(F.col("raw_line")))
    return recs.select("file_name", "line_no", "raw_line", fields.alias("fields"))


def read_daily_csv(spark: SparkSession, paths) -> DataFrame:
    """A4 over files: (file_name, line_no, raw_line, fields).

    One reader for files of any size: lines are numbered from block offsets, and whether a record needs the
    quoted parser is decided from its own text, so neither the records nor the fingerprints depend on a setting.
    """
    return records_from_lines(read_lines(spark, paths))


def machine_index_from_records(records: DataFrame, branch_prefix: str = "") -> DataFrame:
    """A5 from parsed records: (ref_no, branch, machine_type), last duplicate wins.

    Columns are found by header name (first occurrence); blank refs are skipped.
    """
    hdr = records.groupBy("file_name").agg(F.min_by("fields", "line_no").alias("h"), F.min("line_no").alias("hline"))
    keys = F.transform(F.col("h"), lambda s: X.header_key(s))
    hdr = hdr.select(
        "file_name",
        "hline",
        F.array_position(keys, "refno").alias("i_ref"),
        F.array_position(keys, "branchname").alias("i_branch"),
        F.array_position(keys, "machinetype").alias("i_type"),
    )
    data = records.join(hdr, "file_name").where(F.col("line_no") > F.col("hline"))

    def get(i):
        return F.when(F.col(i) > 0, F.try_element_at("fields", F.col(i).cast("int")))

    rows = data.select(
        "line_no",
        X.normalise_ref(get("i_ref")).alias("ref_no"),
        X.normalise_branch(get("i_branch"), branch_prefix).alias("branch"),
        X.collapse(get("i_type")).alias("machine_type"),
    ).where(F.col("ref_no") != "")
    last = rows.groupBy("ref_no").agg(F.max_by(F.struct("branch", "machine_type"), "line_no").alias("m"))
    return last.select("ref_no", "m.branch", "m.machine_type")


def read_machine_list(spark: SparkSession, path: str, branch_prefix: str = "") -> DataFrame:
    """A5: the machine list CSV -> (ref_no, branch, machine_type)."""
    return machine_index_from_records(read_daily_csv(spark, path), branch_prefix)
