"""Readers with declared schemas; every one returns a DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: A word of a page's JSON.
WORD_JSON = "struct<text: string, tier: string, line: array<double>, bbox: array<double>, printed: string, variants: array<string>>"
PAGE_JSON = f"pdf_page int, consensus string, words array<{WORD_JSON}>"
#: A line of any engine after its adapter.
LINE = "engine string, pdf_page int, text string, x0 double, y0 double, x1 double, y1 double"


def unnest_words(pages: DataFrame, page: str, words: str) -> DataFrame:
    """Array elements as rows, numbered from 0."""
    return pages.select(page, F.posexplode(words).alias("idx", "_w")).select(page, "idx", "_w.*")


def words(spark: SparkSession, glob: str) -> DataFrame:
    """SRC-01: word rows of page files."""
    pages = spark.read.schema(PAGE_JSON).option("multiLine", True).json(glob)
    rows = unnest_words(pages, "pdf_page", "words")
    corner = lambda k: F.get("bbox", F.lit(k)).cast("float")
    return rows.select("pdf_page", "idx", "text", "tier", "printed", "variants", *[corner(k).alias(n) for k, n in enumerate(("x0", "y0", "x1", "y1"))])


def jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """SRC-02: a record a line; blank lines are skipped."""
    return spark.read.schema(schema).json(path)


def leaves(consensus: DataFrame, inventory: DataFrame, sections: DataFrame) -> DataFrame:
    """SRC-03, PF-14: pages with what the inventory says of them and the kind of their section (a later list wins)."""
    rank = F.when(F.col("kind") == "document", 3).when(F.col("kind") == "jurats", 2).otherwise(1)
    kind = sections.groupBy("pdf_page").agg(F.max_by("kind", rank).alias("kind"))
    return consensus.join(inventory, "pdf_page", "left").join(kind, "pdf_page", "left").withColumn("accept_unanimous", F.coalesce("accept_unanimous", F.lit(True)))


def entries(spark: SparkSession, path: str, schema: str, notes: str = "notes") -> tuple[DataFrame, DataFrame]:
    """SRC-04: entries numbered by their place in the file's order of keys, and their notes flattened."""
    raw = jsonl(spark, path, schema)
    return raw.drop(notes), raw.select("*", F.explode_outer(notes).alias("note")).drop(notes)


def comment_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines without blank ones and those that start with '#'."""
    return spark.read.text(path).where("trim(value) <> '' AND NOT startswith(value, '#')")


def truth(spark: SparkSession, path: str) -> DataFrame:
    """SRC-08: key TAB text; comments and the header are skipped, a missing text is empty."""
    cells = F.split("value", "\t", 2)
    return comment_lines(spark, path).where("NOT startswith(value, 'id\t')").select(F.get(cells, F.lit(0)).alias("id"), F.coalesce(F.get(cells, F.lit(1)), F.lit("")).alias("text"))


def dictionary(spark: SparkSession, path: str) -> DataFrame:
    """SRC-09: key TAB value, trimmed; of a repeated key the last stands; empty values are null."""
    cells = F.split("value", "\t", 2)
    rows = comment_lines(spark, path).select(F.trim(F.get(cells, F.lit(0))).alias("key"), F.nullif(F.trim(F.get(cells, F.lit(1))), F.lit("")).alias("value"), F.col("_metadata.file_path").alias("f"), F.monotonically_increasing_id().alias("n"))
    return rows.groupBy("key").agg(F.max_by("value", F.struct("f", "n")).alias("value"))


def edits(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """SRC-19: a log of JSON lines with comments, keyed by leaf and anchor; the last stands."""
    rows = comment_lines(spark, path).select(F.from_json("value", schema).alias("e"), F.monotonically_increasing_id().alias("n"))
    return rows.groupBy("e.leaf", "e.anchor").agg(F.max_by("e", "n").alias("e")).select("e.*")


def ocr_words(spark: SparkSession, path: str, width: int, height: int) -> DataFrame:
    """SRC-10: word rows (level 5) of an engine's TSV, quotes as they are, boxes as shares of the page."""
    schema = "level int, page_num int, block_num int, par_num int, line_num int, word_num int, left int, top int, width int, height int, conf double, text string"
    raw = spark.read.schema(schema).option("sep", "\t").option("header", True).option("quote", "").csv(path).where("level = 5 AND trim(text) <> ''")
    w, h = F.lit(float(width)), F.lit(float(height))
    return raw.select("block_num", "par_num", "line_num", "word_num", "text", (F.col("left") / w).alias("x0"), (F.col("top") / h).alias("y0"), ((F.col("left") + F.col("width")) / w).alias("x1"), ((F.col("top") + F.col("height")) / h).alias("y1"))


def hocr_words(spark: SparkSession, path: str) -> DataFrame:
    """SRC-11: words of compressed hOCR, a line of markup a row: page and line hold until the next one starts."""
    from ..operators.sequence import carry

    raw = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("n"), "value")
    box = lambda k: F.regexp_extract("value", r"bbox (\d+) (\d+) (\d+) (\d+)", k).cast("int")
    own = lambda kind: F.when(F.col("value").contains(f"'{kind}'") | F.col("value").contains(f'"{kind}"'), F.col("n"))
    marked = raw.withColumns({"page": carry(own("ocr_page"), ["file"], ["n"]), "line": carry(own("ocr_line"), ["file"], ["n"])})
    word = marked.where(F.col("value").contains("ocrx_word"))
    text = F.regexp_replace(F.regexp_extract("value", ">([^<]*)</span>", 1), "&amp;", "&")
    return word.select("file", "page", "line", "n", text.alias("text"), *[box(k + 1).alias(c) for k, c in enumerate(("x0", "y0", "x1", "y1"))])


def grouped_lines(words: DataFrame, by: list[str], order: str) -> DataFrame:
    """SRC-12, AG-20: lines from words: texts joined in order, boxes united."""
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, "text"))), lambda x: x["text"]), " ")
    return words.groupBy(*by).agg(text.alias("text"), F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"))


def with_engine(rows: DataFrame, file: str = "file") -> DataFrame:
    """SRC-13: engine and page from paths like .../engine/0007.json."""
    return rows.withColumns({"engine": F.regexp_extract(file, r"([^/]+)/[^/]+$", 1), "pdf_page": F.regexp_extract(file, r"(\d+)\.[^/]+$", 1).cast("int")})


def flip(rows: DataFrame) -> DataFrame:
    """FN-31: boxes measured from the bottom, measured from the top."""
    return rows.withColumns({"y0": F.lit(1.0) - F.col("y1"), "y1": F.lit(1.0) - F.col("y0")})


def adapted(engine: str, rows: DataFrame, width: Column, height: Column, from_bottom: bool = False) -> DataFrame:
    """SRC-14: any engine's lines as LINE."""
    scaled = rows.select(F.lit(engine).alias("engine"), "pdf_page", "text", (F.col("x0") / width).alias("x0"), (F.col("y0") / height).alias("y0"), (F.col("x1") / width).alias("x1"), (F.col("y1") / height).alias("y1"))
    return flip(scaled) if from_bottom else scaled


def targets(inventory: DataFrame, spec: str, pilot: tuple[int, ...] = ()) -> DataFrame:
    """SRC-15, SRC-16: pages of ``pilot``, ``all`` (without blanks), ``every:N`` or a list like 3,5,8."""
    full = inventory.where("section <> 'blank'")
    if spec == "all":
        return full
    if spec.startswith("every:"):
        return full.where(F.col("pdf_page") % int(spec[6:]) == 0)
    pages = list(pilot) if spec == "pilot" else [int(x) for x in spec.split(",")]
    return full.where(F.col("pdf_page").isin(pages))
