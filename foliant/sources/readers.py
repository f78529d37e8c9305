"""Reading publications, lists, trees and decks; writing results."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliant.operators import markdown
from foliant.plans.intake import norm_pub_id


def pub_list(spark: SparkSession, path: str) -> DataFrame:
    """A list file: ``ID``, ``ID path`` or ``ID url`` a line, ``#`` begins a comment. Gives
    (pub_id, path, url); a bad id or one that is listed twice is an error."""
    start = r"(?i)\s(https?://\S.*|\S*[/\\].*|\S+\.pdf.*)$"
    d = spark.read.text(path).select(F.trim(F.regexp_replace("value", "#.*$", "")).alias("l")).where("l <> ''")
    src = F.nullif(F.trim(F.regexp_extract("l", start, 1)), F.lit(""))
    d = d.select(norm_pub_id(F.regexp_replace("l", start, "")).alias("pub_id"), src.alias("src"))
    d = d.withColumn("pub_id", F.when(F.col("pub_id").rlike(r"^[A-Z0-9][A-Z0-9.-]*$"), F.col("pub_id")).otherwise(F.raise_error(F.concat(F.lit("not a publication id: "), F.col("pub_id")))))
    g = d.groupBy("pub_id").agg(F.count("*").alias("n"), F.first("src").alias("src"))
    g = g.withColumn("pub_id", F.when(F.col("n") == 1, F.col("pub_id")).otherwise(F.raise_error(F.concat(F.col("pub_id"), F.lit(" is listed twice")))))
    url = F.col("src").rlike("^https?://")
    return g.select("pub_id", F.when(~url, F.col("src")).alias("path"), F.when(url, F.col("src")).alias("url"))


def allowed(urls: DataFrame, hosts: list[str], col: str = "url") -> DataFrame:
    """Sources on one of ``hosts``; an address without a host is out."""
    return urls.where(F.expr(f"try_parse_url({col}, 'HOST')").isin(*hosts))


def files(spark: SparkSession, glob: str) -> DataFrame:
    """(path, length, sha256) of files, hashed where they are read."""
    return spark.read.format("binaryFile").load(glob).select("path", "length", F.sha2("content", 256).alias("sha256"))


def markdown_files(spark: SparkSession, glob: str) -> DataFrame:
    """One row per Markdown file: its front matter as a map and its body. A file without
    front matter is an error."""

    def split(batches):
        for b in batches:
            got = [markdown.front_matter(x) for x in b["value"]]
            yield pd.DataFrame({"path": b["path"], "front": [f for f, _ in got], "body": [t for _, t in got]})

    d = spark.read.text(glob, wholetext=True).select(F.input_file_name().alias("path"), "value")
    return d.mapInPandas(split, T.StructType([T.StructField("path", T.StringType()), T.StructField("front", T.MapType(T.StringType(), T.StringType())), T.StructField("body", T.StringType())]))


def nodes_of_files(spark: SparkSession, glob: str) -> DataFrame:
    """Node rows of Markdown files, keyed by the ``pub_id`` of their front matter."""
    d = markdown_files(spark, glob).select(F.col("front")["pub_id"].alias("pub_id"), "body")
    return markdown.parse_rows(d, ["pub_id"], "body")


# Fields whose strings are a statement's text.
TEXT_FIELDS = ("text", "label", "detail", "when", "value", "definition", "meaning", "cells")


def statements(spec: str | None) -> list[tuple[str, str, str, str | None, list[str], bool]]:
    """(slide, claim id, text, directive, cites, in notes) of every object of a deck's JSON that
    has ``cite``; the id is its path, such as ``s09.roles[0].duties[2]``. An unreadable or
    null deck gives none."""
    out: list[tuple[str, str, str, str | None, list[str], bool]] = []
    try:
        deck = json.loads(spec) if spec else {}
    except ValueError:
        return out

    def walk(x, at: str, slide: str) -> None:
        if isinstance(x, list):
            for i, v in enumerate(x):
                walk(v, f"{at}[{i}]", slide)
        elif isinstance(x, dict):
            if "cite" in x and at != slide:
                parts: list[str] = []
                for f in TEXT_FIELDS:
                    v = x.get(f)
                    parts += [v] if isinstance(v, str) else [s for s in v if isinstance(s, str)] if isinstance(v, list) else []
                cite = x["cite"] if isinstance(x["cite"], list) else [x["cite"]]
                out.append((slide, at, " ".join(parts), x.get("directive"), [c for c in cite if isinstance(c, str)], ".notes." in at))
            for k, v in x.items():
                if isinstance(v, (list, dict)) and k != "cite":
                    walk(v, f"{at}.{k}", slide)

    for s in deck.get("slides", []) if isinstance(deck, dict) else []:
        if isinstance(s, dict) and isinstance(s.get("id"), str):
            walk(s, s["id"], s["id"])
    return out


_CLAIM = T.ArrayType(T.StructType([T.StructField("slide_id", T.StringType()), T.StructField("claim_id", T.StringType()), T.StructField("text", T.StringType()), T.StructField("directive", T.StringType()), T.StructField("cites", T.ArrayType(T.StringType())), T.StructField("in_notes", T.BooleanType())]))


def claims_of_decks(decks: DataFrame, spec: str = "spec") -> DataFrame:
    """One row per statement of each deck (pub_id, spec as JSON)."""

    @F.pandas_udf(_CLAIM)
    def walk(s: pd.Series) -> pd.Series:
        names = _CLAIM.elementType.names
        return s.map(lambda x: [dict(zip(names, c)) for c in statements(x)])

    return decks.select("pub_id", F.inline(walk(F.col(spec))))


def write_json(df: DataFrame, path: str, by: str = "pub_id") -> None:
    """One folder per publication; only those that are written are replaced."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).json(path)


def write_texts(df: DataFrame, path: str, text: str = "md", by: str = "pub_id") -> None:
    df.select(F.col(text).alias("value"), by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).text(path)
