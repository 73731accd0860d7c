"""Statute Markdown to articles, paragraphs and items, in built-in functions only.

One row per statute explodes to rows of articles, of paragraphs and of units, so nothing but a statute's
own text meets in a task. Python's `.` and `$` are spelt out for Java's regular expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# What headings, notes, marks and items look like.
ADDENDA = r"(?mU)^##\s*부칙\b[^\n]*$"
HEADER = r"(?m)^#####\s*제(\d+)조(?:의(\d+))?\s*\(([^)]*)\)[ \t]*$"
SECTION = r"(?m)^#{1,4}\s+[^\n]*$"
REVISION = r"<(?:개정|신설|삭제|전문개정)[^>]*>"
MARK = r"\*\*([①-⑳㉑-㉟])\*\*\s*"
ITEM = r"(?m)^([ \t]*)([0-9]+|[가-힣])\\\.\s+([^\n]+)$"
FRONT_MATTER, BOLD, DOT, HEAD = r"(?s)^---\n.*?\n---\n", r"\*\*(.+?)\*\*", r"\\\.", r"(?m)^#+\s*"


def clean_markdown(c: Column) -> Column:
    """Text without front matter, bold marks, escaped dots and heading signs."""
    for pattern, to in ((FRONT_MATTER, ""), (BOLD, "$1"), (DOT, "."), (HEAD, "")):
        c = F.regexp_replace(c, pattern, to)
    return c


def strip_noise(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, SECTION, ""), REVISION, "")


def body(c: Column) -> Column:
    """What stands before the addenda."""
    return F.get(F.split(c, ADDENDA, 2), F.lit(0))


def circled(c: Column) -> Column:
    """1 to 35 from a circled digit."""
    code = F.ascii(c)
    return F.when(code.between(0x2460, 0x2473), code - 0x245F).when(code.between(0x3251, 0x325F), code - 0x323C)


def _strip(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, r"^\s+", ""), r"\s+$", "")


def articles(docs: DataFrame, text: str = "raw_text") -> DataFrame:
    """docs x (article_ord, article_no, article_sub_no, title, article_body): pieces that begin with a header."""
    pieces = F.filter(F.split(body(F.col(text)), f"(?={HEADER})".replace("(?=(?m)", "(?m)(?=")), lambda x: x.rlike(HEADER))
    return _headed(docs.select("*", F.posexplode(pieces).alias("article_ord", "_piece")), docs.columns)


def _headed(rows: DataFrame, kept: list[str]) -> DataFrame:
    """Rows with article_ord and a piece that begins with a header, as articles."""
    part = lambda i: F.regexp_extract("_piece", HEADER, i)
    return rows.select(
        *kept,
        "article_ord",
        part(1).cast("int").alias("article_no"),
        F.nullif(part(2), F.lit("")).cast("int").alias("article_sub_no"),
        part(3).alias("title"),
        strip_noise(F.regexp_replace("_piece", r"\A" + HEADER, "")).alias("article_body"),
    )


def articles_of_pieces(pieces: DataFrame, file: str = "file_path", order: str = "at") -> DataFrame:
    """(file, article_ord, ...) as articles, from the pieces that a file was cut into before each heading of the fifth level.

    pieces (file, at, piece) in order; a piece without a header belongs to the article before it. Nothing behind the
    addenda counts. Windows run over the pieces of a file; no value is longer than an article.
    """
    own = Window.partitionBy(file).orderBy(order)
    before = own.rowsBetween(Window.unboundedPreceding, -1)
    piece = F.col("piece")
    rows = pieces.select(file, order, body(piece).alias("piece"), piece.rlike(ADDENDA).alias("ends"), body(piece).rlike(r"\A" + HEADER).alias("heads"))
    rows = rows.withColumn("over", F.coalesce(F.bool_or("ends").over(before), F.lit(False))).filter("not over")
    rows = rows.withColumn("article_ord", F.sum(F.col("heads").cast("int")).over(own) - 1).filter("article_ord >= 0")
    whole = rows.groupBy(file, F.col("article_ord").cast("int").alias("article_ord")).agg(F.array_sort(F.collect_list(F.struct(order, "piece"))).alias("p"))
    return _headed(whole.select(file, "article_ord", F.array_join(F.transform("p", lambda x: x["piece"]), "").alias("_piece")), [file])


def paragraphs(found: DataFrame) -> DataFrame:
    """articles x (paragraph_ord, paragraph_no, paragraph_text): spans of circled marks, or the whole body without any."""
    marks = F.regexp_extract_all("article_body", F.lit(MARK), F.lit(1))
    spans = F.split("article_body", MARK)
    rest = F.slice(spans, 2, F.greatest(F.size(spans) - 1, F.lit(0)))
    marked = F.transform(F.arrays_zip(marks.alias("m"), rest.alias("t")), lambda x: F.struct(circled(x["m"]).alias("no"), x["t"].alias("text")))
    whole = F.when(truthy_text(F.col("article_body")), F.array(F.struct(F.lit(None).cast("int").alias("no"), F.col("article_body").alias("text")))).otherwise(F.array().cast("array<struct<no:int,text:string>>"))
    rows = found.select("*", F.posexplode(F.when(F.size(marks) > 0, marked).otherwise(whole)).alias("paragraph_ord", "_p"))
    return rows.select(*found.columns, "paragraph_ord", F.col("_p.no").alias("paragraph_no"), F.col("_p.text").alias("paragraph_text"))


def truthy_text(c: Column) -> Column:
    return _strip(c) != ""


def head(c: Column) -> Column:
    """A paragraph's text before its first item."""
    return _strip(F.get(F.split(c, ITEM, 2), F.lit(0)))


def items(c: Column) -> Column:
    """Array of (label, body, depth); an indent of four columns or more is the deeper level. A tab is four columns at least."""
    parts = F.arrays_zip(*(F.regexp_extract_all(c, F.lit(ITEM), F.lit(i)).alias(n) for i, n in ((1, "indent"), (2, "label"), (3, "body"))))
    depth = lambda x: F.when((F.length(x["indent"]) >= 4) | x["indent"].contains("\t"), 1).otherwise(0)
    return F.transform(parts, lambda x: F.struct(x["label"].alias("label"), _strip(x["body"]).alias("body"), depth(x).alias("depth")))


def units(found: DataFrame) -> DataFrame:
    """paragraphs x (unit_ord, unit_text, label, depth): the head, then its items; empty ones are left out."""
    first = F.struct(F.lit(None).cast("string").alias("label"), head(F.col("paragraph_text")).alias("body"), F.lit(-1).alias("depth"))
    rows = found.select("*", F.posexplode(F.concat(F.array(first), items(F.col("paragraph_text")))).alias("unit_ord", "_u"))
    return rows.select(*found.columns, "unit_ord", F.col("_u.body").alias("unit_text"), F.col("_u.label").alias("item_label"), F.col("_u.depth").alias("item_depth")).filter("unit_text <> ''")
