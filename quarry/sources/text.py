"""Readers for line-oriented inputs and their record shapes (inventory A1-A9, A12).

All readers return DataFrames with declared columns; nothing is inferred.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.session import write_scratch


# --- A1: lines -------------------------------------------------------------

def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``path`` (file or folder) -> ``value string``, one row per line."""
    return spark.read.text(path)


def text_lines_numbered(spark: SparkSession, path: str, out: str = "ord", line_no: str = "line_no",
                        folders: bool = False) -> tuple[DataFrame, DataFrame]:
    """Lines of a text file or folder, numbered, and the table of their blocks.

    Lines: ``(file, line_no, value, ord)``. ``line_no`` counts from 0 within the
    file, ``ord`` over all files in path order, both dense. Blocks: one row per
    input split with its number of lines ``n``; their sum is the line total.
    With ``folders`` the files of one folder are parts of one long file: ``file``
    names the folder and ``line_no`` counts on from part to part in name order.

    A split is named by its file and start offset, whatever other splits share
    its task, and a line's place in its split is its id minus the split's
    smallest id. The lines are written once with their file, start and id (an
    action), as a second scan may be split otherwise when executors come or go.
    The counts of the splits are taken from that table; prefix sums over them,
    within a file and over files, are joined to its lines on (file, start). No
    line is sorted, and the join is a plain one at every size.
    """
    lines = write_scratch(spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_start"), "value",
        F.monotonically_increasing_id().alias("_id")), "lines")
    blocks = write_scratch(lines.groupBy("file", "_start").agg(F.count(F.lit(1)).alias("n"), F.min("_id").alias("_first")),
                           "line-blocks")
    in_file = Window.partitionBy("file").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    files = blocks.groupBy("file").agg(F.sum("n").alias("_file_n"))
    # one row per file: the listing that planned the scan is as long
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select(F.col("file").alias("_f"), F.coalesce(F.sum("_file_n").over(earlier), F.lit(0)).alias("_file_at"))
    at = (blocks.withColumn("_at", F.coalesce(F.sum("n").over(in_file), F.lit(0)))
          .join(files, F.col("file") == F.col("_f"))
          .select("_f", F.col("_start").alias("_s"), "_first", "_at", "_file_at"))
    named = F.col("file")
    if folders:
        # a folder's files are neighbours in path order
        named = F.regexp_extract("file", r"\A(.*/)", 1)
        of_folder = Window.partitionBy(F.regexp_extract("_f", r"\A(.*/)", 1))
        at = (at.withColumn("_folder_at", F.min("_file_at").over(of_folder))
              .withColumn("_at", F.col("_at") + F.col("_file_at") - F.col("_folder_at"))
              .select("_f", "_s", "_first", "_at", F.col("_folder_at").alias("_file_at")))
    in_block = F.col("_at") + F.col("_id") - F.col("_first")
    numbered = (lines.join(at, (F.col("file") == F.col("_f")) & (F.col("_start") == F.col("_s")))
                .select(named.alias("file"), in_block.alias(line_no), "value", (F.col("_file_at") + in_block).alias(out)))
    return numbered, blocks


def text_line_ordinals(spark: SparkSession, path: str, out: str = "ord") -> DataFrame:
    """``(file, value, ord)``: lines with a dense 0-based ordinal, files in path order."""
    return text_lines_numbered(spark, path, out)[0].select("file", "value", out)


def document_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Split documents into ``(doc_id, line_no, line)``; ``line_no`` is 0-based.

    A document is already one row, so this is a generator on that row: no shuffle,
    and a very long document only makes one row produce many lines.
    """
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.posexplode(F.split(F.col(text_col), "\n")).alias("line_no", "line"),
    ).withColumn("line_no", F.col("line_no").cast("long"))


# --- A2: delimited text with a declared schema ------------------------------

def read_delimited(spark: SparkSession, path: str, schema: T.StructType | str, sep: str = "\t",
                   header: bool = False, strict: bool = False) -> DataFrame:
    """Delimited text, no quoting. Unparsable fields become null unless ``strict``."""
    return (spark.read.schema(schema)
            .option("sep", sep)
            .option("quote", "\u0000")
            .option("header", header)
            .option("mode", "FAILFAST" if strict else "PERMISSIVE")
            .csv(path))


# --- A3: positional split of a line -----------------------------------------

def positional_fields(lines: DataFrame, sep: str, fields: dict[str, tuple[int, str]],
                      line_col: str = "value", keep=()) -> DataFrame:
    """``fields`` maps name -> (0-based index, Spark type). Missing or bad fields
    are null. ``keep`` columns are carried through."""
    split = lines.select(*keep, F.split(F.col(line_col), sep).alias("_parts"))
    cols = [F.try_element_at("_parts", F.lit(i + 1)).try_cast(t).alias(name)
            for name, (i, t) in fields.items()]
    return split.select(*keep, *cols)


# --- A4 / A5: key-value shapes -----------------------------------------------

def key_value_on_tab(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """First tab splits key from the rest; a line without a tab is all key, value ''."""
    parts = F.split(F.col(line_col), "\t", 2)
    return lines.select(parts[0].alias("key"),
                        F.coalesce(F.try_element_at(parts, F.lit(2)), F.lit("")).alias("value"))


def first_two_tokens(lines: DataFrame, line_col: str = "value", keep=(),
                     missing_value: str | None = None) -> DataFrame:
    """First two whitespace tokens become key and value; the rest is dropped.
    Lines without tokens give no row; a lone token gets ``missing_value``."""
    # generator output, so the size filter does not re-run the split
    toks = F.explode(F.array(F.array_remove(F.split(F.col(line_col), r"[ \t\n\r\f]+"), "")))
    value = F.try_element_at("_t", F.lit(2))
    if missing_value is not None:
        value = F.coalesce(value, F.lit(missing_value))
    return (lines.select(*keep, toks.alias("_t"))
            .where(F.size("_t") >= 1)
            .select(*keep, F.col("_t")[0].alias("key"), value.alias("value")))


# --- A6: N lines per record ----------------------------------------------------

def n_line_records(lines: DataFrame, n: int = 2, group_cols=("doc_id",),
                   order_col: str = "line_no", line_col: str = "line") -> DataFrame:
    """Join each run of ``n`` consecutive lines (no separator) into one record.

    ``rec_no`` is 1-based within the group; an incomplete last run stands alone.
    The grouping key includes ``order div n`` so every group holds at most ``n``
    lines, however large the file or document is.
    """
    g = [F.col(c) for c in group_cols]
    rec = F.floor(F.col(order_col) / n).cast("long")
    return (lines.groupBy(*g, rec.alias("_r"))
            .agg(F.array_sort(F.collect_list(F.struct(F.col(order_col).alias("o"),
                                                         F.col(line_col).alias("l")))).alias("_ls"))
            .select(*group_cols, (F.col("_r") + 1).alias("rec_no"),
                    F.array_join(F.transform("_ls", lambda s: s["l"]), "").alias("record")))


def n_line_records_per_document(docs: DataFrame, n: int = 2, id_col: str = "doc_id",
                                text_col: str = "text") -> DataFrame:
    """A6 when a whole file is already one row: records are built inside the row,
    so the plan has no shuffle at all."""
    lines = F.split(F.col(text_col), "\n")
    nrec = F.floor((F.size(lines) + (n - 1)) / n).cast("int")
    recs = F.transform(
        F.sequence(F.lit(0), nrec - 1),
        lambda i: F.array_join(F.slice(lines, i * n + 1, F.lit(n)), ""),
    )
    return docs.select(F.col(id_col).alias("doc_id"),
                       F.posexplode(F.when(nrec > 0, recs)).alias("_i", "record")) \
        .select("doc_id", (F.col("_i") + 1).cast("long").alias("rec_no"), "record")


# --- A7 / A9: multi-line JSON objects ---------------------------------------------

def read_multiline_json_objects(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Objects that open with ``{`` and close with ``}`` in column 0, any number per file.

    An object closes at the first line whose first character is ``}``; what else
    that line holds (a comma, a CR) is dropped, and so is anything before the
    next line that starts with ``{``. The text reader splits on a line break
    plus ``}``, so each record holds one object and files split across tasks
    like any text file; LF and CRLF files both work. Returns the parsed struct
    ``j`` plus ``_corrupt`` (true when the object did not parse) and ``_record``,
    the text of an object that did not.
    """
    st = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
    fields = [f.name for f in st.fields]
    with_bad = T.StructType(st.fields + [T.StructField("_corrupt_record", T.StringType())])
    raw = spark.read.option("lineSep", "\n}").text(path)
    opened = F.regexp_extract(F.col("value"), r"(?s)(?:\A|\n)(\{.*)\z", 1)
    parsed = raw.select(opened.alias("_o")).where(F.col("_o") != "").select(
        F.from_json(F.concat("_o", F.lit("\n}")), with_bad, {"mode": "PERMISSIVE",
                                                              "columnNameOfCorruptRecord": "_corrupt_record"}).alias("_p"))
    return parsed.select(F.struct(*[F.col("_p." + n).alias(n) for n in fields]).alias("j"),
                         F.col("_p._corrupt_record").isNotNull().alias("_corrupt"), F.col("_p._corrupt_record").alias("_record"))


@dataclass
class Quarantine:
    """Parsed objects (``j``), the texts of those that did not parse (``record``), and how many there were."""
    good: DataFrame
    bad: DataFrame
    objects: int
    malformed: int


def quarantine(objects: DataFrame, path: str) -> Quarantine:
    """Write what ``read_multiline_json_objects`` read to ``path``, good and bad objects apart (A9; an action).

    One pass parses, writes and counts: the counts are metrics observed while
    the rows are written, so neither side is parsed again.
    """
    spark, seen = objects.sparkSession, Observation("quarantine")
    rows = objects.observe(seen, F.count(F.lit(1)).alias("objects"), F.count_if("_corrupt").alias("malformed"))
    rows = rows.select("j", F.col("_record").alias("record"), F.col("_corrupt").alias("bad"))
    rows.write.partitionBy("bad").parquet(path)
    table = spark.read.schema(rows.schema).parquet(path)
    return Quarantine(table.where(~F.col("bad")).select("j"), table.where("bad").select("record"),
                      seen.get["objects"] or 0, seen.get["malformed"] or 0)


def json_array_path(df: DataFrame, json_col: str, schema: T.StructType | str, path: str,
                    out: str = "tag", quoted: bool = False) -> DataFrame:
    """Explode ``path`` (dotted, arrays iterate) of parsed JSON; absent keys and
    malformed objects give no rows (A9). ``quoted`` renders each value as JSON
    text, quotes included (I22)."""
    parsed = df.select(F.from_json(F.col(json_col), schema).alias("j"))
    tags = parsed.select(F.explode(F.col("j." + path)).alias(out)).where(F.col(out).isNotNull())
    if quoted:
        from quarry.functions.text import quoted as q
        tags = tags.select(q(F.col(out)).alias(out))
    return tags
