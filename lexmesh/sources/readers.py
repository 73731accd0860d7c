"""Sources: law lists, Markdown folders, manifests, root files and dictionaries."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.names import date_text, normalize, truthy, unused

LAW = (
    "struct<no: int, requested_name: string, matched_dir: string, alias_applied: boolean, "
    "files: array<struct<file: string, `법령구분`: string, `법령MST`: string, `법령ID`: string, `공포일자`: string, `시행일자`: string, `소관부처`: array<string>, `상태`: string>>>"
)
MANIFEST = f"laws array<{LAW}>, missing array<array<string>>"
ROOT_MAP = "root string, edge_type string, edge_type_alt array<string>, needs_context boolean"


def law_list(spark: SparkSession, path: str) -> DataFrame:
    """(no, name) from lines of number, tab, name; blank lines are skipped."""
    return parse_law_list(spark.read.text(path), F.col("value"))


def parse_law_list(lines: DataFrame, line: Column) -> DataFrame:
    part = lambda i: F.get(F.split(F.trim(line), "\t", 2), F.lit(i))
    return lines.filter(F.trim(line) != "").select(part(0).cast("int").alias("no"), part(1).alias("name"))


def markdown(spark: SparkSession, path: str) -> DataFrame:
    """(file_path, raw_text) of all .md files below path."""
    rows = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.md").text(path, wholetext=True)
    return rows.select(F.col("_metadata.file_path").alias("file_path"), F.col("value").alias("raw_text"))


#: What the pieces of a Markdown file begin with.
HEADING = "#####"


def markdown_pieces(spark: SparkSession, path: str, names: str = "*.md") -> DataFrame:
    """(file_path, at, piece) of all files of those names below path, cut before each heading of the fifth level; at is the order in a file.

    The text reader cuts at the heading, so a file is read by as many tasks as it has splits, and no value holds all of it.
    """
    rows = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", names).option("lineSep", f"\n{HEADING}").text(path)
    begin = F.col("_metadata.file_block_start")
    # within a split rows come in the order of the file
    rows = rows.select(F.col("_metadata.file_path").alias("file_path"), F.struct(begin.alias("split"), F.monotonically_increasing_id().alias("row")).alias("at"), "value")
    own = Window.partitionBy("file_path").orderBy("at")
    # what the reader took for a separator: the line's end before a heading, and the heading
    begin, end = F.when(F.row_number().over(own) > 1, HEADING).otherwise(""), F.when(F.lead("at").over(own).isNotNull(), "\n").otherwise("")
    return rows.select("file_path", "at", F.concat(begin, "value", end).alias("piece"))


_KEY = re.compile(r"""("[^"]*"|'[^']*'|[^:#'"\[{]+?)\s*:(?:\s+(.*))?$""")
_ITEM = re.compile(r"""\s*("(?:[^"\\]|\\.)*"|'(?:[^']|'')*'|[^,]*)\s*(?:,|$)""")
_SINGLE, _DOUBLE = re.compile(r"'((?:[^']|'')*)'"), re.compile(r'"((?:[^"\\]|\\.)*)"')


def _scalar(text: str) -> list[str]:
    """The value as a list of one, without quotes or a comment; empty for nothing or null."""
    text = text.strip()
    if found := _SINGLE.match(text):
        return [found[1].replace("''", "'")]
    if found := _DOUBLE.match(text):
        return [re.sub(r"\\(.)", lambda m: {"n": "\n", "t": "\t"}.get(m[1], m[1]), found[1])]
    text = re.sub(r"(^|\s)#.*$", "", text).strip()
    return [] if text in ("", "~", "null", "Null", "NULL") else [text]


def _bracketed(text: str) -> list[str]:
    """The items of a list in brackets."""
    body, out, at = re.sub(r"\]\s*(#.*)?$", "", text[1:]), [], 0
    while at < len(body):
        found = _ITEM.match(body, at)
        out += _scalar(found[1])
        at = max(found.end(), at + 1)
    return out


def parse_block(block: str) -> dict[str, list[str]]:
    """The keys of a YAML block: scalars, quoted ones, lists in brackets or of dashes, and texts behind | or >.

    A scalar is a list of one; nothing, `~` and `null` are an empty list. Of repeated keys the last wins.
    """
    out: dict[str, list[str]] = {}
    key, text = None, ""
    for line in block.split("\n"):
        bare = line.strip()
        inside = line[:1] in (" ", "\t") or bare[:2] in ("-", "- ")
        if text and (inside or not bare):
            out[key] = [(out[key][0] + (" " if text == ">" else "\n") + bare).strip()]
        elif not bare or bare.startswith("#"):
            continue
        elif key is not None and inside:
            out[key] = [*out[key], *_scalar(bare[1:])] if bare.startswith("-") else out[key]
        elif found := _KEY.match(bare):
            value = (found[2] or "").strip()
            key = (_scalar(found[1]) or [""])[0]
            text = value[:1] if value in ("|", ">", "|-", ">-") else ""
            out[key] = [""] if text else _bracketed(value) if value.startswith("[") else _scalar(value)
    return out


def front_matter(text: Column) -> Column:
    """The keys between the opening and closing --- of a text, as a map to scalars, of a list the first; empty without both."""
    return F.transform_values(front_lists(text), lambda _, v: F.get(v, F.lit(0)))


def front_lists(text: Column) -> Column:
    """The keys between the opening and closing --- of a text, as a map to lists; empty without both. A scalar is a list of one."""

    @F.pandas_udf("map<string, array<string>>")
    def run(blocks: pd.Series) -> pd.Series:
        return pd.Series([parse_block(b) if b else {} for b in blocks], dtype=object)

    return run(F.regexp_extract(text, r"(?s)\A---(.*?)\n---", 1))


def one_of(values: Column, key: str) -> Column:
    """A scalar of the front matter, null where it is missing."""
    return F.get(F.try_element_at(values, F.lit(key)), F.lit(0))


def directory_index(files: DataFrame) -> DataFrame:
    """(key, directory): folders by normalised name; of several with one key the last in name order."""
    folder = F.regexp_extract("file_path", r"([^/]+)/[^/]+$", 1)
    return files.select(folder.alias("directory")).distinct().groupBy(normalize(F.col("directory")).alias("key")).agg(F.max("directory").alias("directory"))


def match_laws(laws: DataFrame, index: DataFrame, aliases: dict[str, str]) -> DataFrame:
    """laws with their directory, null if missing, and whether the match is an alias's target.

    Names are normalised, then an alias of the normalised name counts; keys and values of aliases are normalised names.
    """
    table = F.create_map(*(F.lit(x) for kv in aliases.items() for x in kv)) if aliases else F.create_map(F.lit(""), F.lit(""))
    key = normalize(F.col("name"))
    rows = laws.withColumn("key", F.coalesce(F.try_element_at(table, key), key)).join(index, "key", "left")
    return rows.withColumn("alias_applied", F.coalesce((F.trim("name") != F.col("directory")) & F.col("key").isin(*map(str, aliases.values())), F.lit(False)))


def law_files(matched: DataFrame, files: DataFrame) -> DataFrame:
    """matched laws with `files`, the facts of each of their files by name, from its front matter; none for a missing law.

    files (file_path, raw_text). A law's files are few, so they make one value; the laws stay rows.
    """
    m = front_lists(F.col("raw_text"))
    rows = files.select(F.regexp_extract("file_path", r"([^/]+)/[^/]+$", 1).alias("directory"), F.regexp_extract("file_path", r"([^/]+)$", 1).alias("file"), m.alias("m"))
    scalar = lambda k: one_of(F.col("m"), k).alias(k)
    day = lambda k: date_text(one_of(F.col("m"), k)).alias(k)
    entry = F.struct("file", scalar("법령구분"), scalar("법령MST"), scalar("법령ID"), day("공포일자"), day("시행일자"), F.try_element_at("m", F.lit("소관부처")).alias("소관부처"), scalar("상태"))
    each = rows.groupBy("directory").agg(F.array_sort(F.collect_list(entry)).alias("files"))
    laws = matched.select("no", F.col("name").alias("requested_name"), F.col("directory"), F.when(F.col("directory").isNotNull(), F.col("alias_applied")).alias("alias_applied"))
    return laws.join(each, "directory", "left").withColumnRenamed("directory", "matched_dir")


def manifest_documents(manifest: DataFrame) -> DataFrame:
    """A row per file of each law."""
    files = manifest.select(F.explode("laws").alias("l")).select("l.no", "l.requested_name", "l.matched_dir", "l.alias_applied", F.explode("l.files").alias("f"))
    ministries = F.nullif(F.array_join(F.coalesce("f.소관부처", F.array().cast("array<string>")), ", "), F.lit(""))
    return files.select("no", F.col("requested_name").alias("source_law"), F.coalesce("f.법령구분", F.lit("")).alias("doc_type"), F.col("f.법령MST").alias("law_mst"), date_text(F.col("f.공포일자")).alias("promulgation_date"), date_text(F.col("f.시행일자")).alias("enforcement_date"), ministries.alias("competent_ministry"), F.concat_ws("/", "matched_dir", "f.file").alias("file_path"))


def manifest_laws(spark: SparkSession, path: str) -> DataFrame:
    """A manifest of JSON lines, as sinks.manifest writes it, in the shape of one of a single document."""
    return spark.read.text(f"{path}/laws").select(F.array(F.from_json("value", LAW)).alias("laws"))


def documents(spark: SparkSession, manifest_path: str, root: str) -> DataFrame:
    found = manifest_documents(spark.read.schema(MANIFEST).json(manifest_path, multiLine=True))
    texts = markdown(spark, root).withColumn("file_path", F.regexp_extract("file_path", r"([^/]+/[^/]+)$", 1))
    return found.join(texts, "file_path")


def root_map(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.schema(ROOT_MAP).json(path)
    return rows.select(F.col("root").alias("verb_root"), F.col("edge_type").alias("mapped"), F.coalesce("edge_type_alt", F.array().cast("array<string>")).alias("alternatives"), F.coalesce("needs_context", F.lit(False)).alias("needs_context"))


#: A string, or a tag behind what it closes.
_TAGS = re.compile(r'("(?:[^"\\]|\\.)*")|(\{\s*)?(\})?::([A-Za-z0-9_]+)')


def untag(text: str | None) -> tuple[str | None, str | None, str | None]:
    """(tag, json, raw): the outer tag and the text as JSON, or what isn't JSON without its tags as it stands.

    Strings stay as they are. An object tagged as vertex or edge tells so in a field `_agtype`.
    """
    if text is None:
        return None, None, None

    def plain(m: re.Match) -> str:
        if m[1]:
            return m[1]
        begin, end = m[2] or "", m[3] or ""
        kind = f'"_agtype": "{m[4]}"' if end and m[4] in ("vertex", "edge") else ""
        return begin + (", " if kind and not begin else "") + kind + end

    bare = _TAGS.sub(plain, text)
    try:
        json.loads(bare)
    except ValueError:
        return None, None, text
    outer = re.search(r"::([A-Za-z0-9_]+)\s*$", text)
    return outer[1] if outer else None, bare, None


def parsed_value(text: Column) -> Column:
    """untag as struct(tag, json, raw)."""

    @F.pandas_udf("struct<tag: string, json: string, raw: string>")
    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([untag(t) for t in texts], columns=["tag", "json", "raw"], dtype=object)

    return run(text)


def untagged(text: Column, schema: str) -> Column:
    """A value with vertex, edge and path tags behind its parts, as typed rows; null where it isn't JSON without them."""
    return F.from_json(parsed_value(text)["json"], schema)


def tokens(spark: SparkSession, path: str) -> DataFrame:
    """Units that were tokenized elsewhere: JSON lines of (file_path, unit_text, tokens), for a join in place of a tokenizer."""
    return spark.read.schema("file_path string, unit_text string, tokens array<struct<form: string, tag: string>>").json(path)


def root_groups(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.schema("root string, count long, members array<struct<l: string, c: long>>").json(list(paths))


def ambiguous_roots(spark: SparkSession, path: str) -> DataFrame:
    """The roots whose type a verb alone doesn't tell, each once."""
    return root_groups(spark, path).select("root").distinct()


def non_action_roots(spark: SparkSession, *paths: str) -> DataFrame:
    return root_groups(spark, *paths).select("root").distinct()


def dictionary(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, sep="\t").filter(truthy(F.col("form"))) if path else spark.createDataFrame([], "form string, tag string")


def frequencies(rows: DataFrame, column: str) -> DataFrame:
    """(key, n) from JSON arrays of [key, n] pairs."""
    return rows.select(F.explode(F.from_json(column, "array<array<string>>")).alias("p")).select(F.get("p", F.lit(0)).alias("key"), F.get("p", F.lit(1)).cast("long").alias("n"))


def properties(rows: DataFrame, column: str, schema: str) -> DataFrame:
    """rows with the properties of a JSON column as columns; one that is missing, or of another kind, is null."""
    (held,) = unused(rows.columns, "properties")
    return rows.withColumn(held, F.from_json(column, schema)).select(*rows.columns, f"{held}.*")
