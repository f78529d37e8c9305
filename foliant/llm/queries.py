"""The queries of the text operators over the project's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.llm import abuse, leakage, markup, mixing, reading, sentences
from foliant.session import table, written


def units(spark: SparkSession, sf: str) -> DataFrame:
    """(src, record_key, body): what is cut into sentences."""
    n = table(spark, sf, "nodes").where(F.col("type").isin("paragraph", "list_item", "text") & F.col("plain").isNotNull())
    d = table(spark, sf, "documents").where((F.col("stage") == "clean") & F.col("text").isNotNull())
    return n.select(F.lit("nodes").alias("src"), F.concat("pub_id", F.lit("/"), "id").alias("record_key"), F.col("plain").alias("body")).unionByName(
        d.select(F.lit("documents").alias("src"), F.col("doc_id").cast("string").alias("record_key"), F.col("text").alias("body"))
    )


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    cut = units(spark, sf).select("src", "record_key", sentences.sentence_spans(F.col("body")).alias("spans"))
    # rows of one key that repeat become one before they are expanded
    once = cut.distinct()
    return once.select("src", "record_key", sentences.exploded("spans"))


def fields(spark: SparkSession, sf: str) -> list[tuple[str, DataFrame]]:
    """(field_name, (src, record_key, body)) of every field that may hold markup."""
    n = table(spark, sf, "nodes")
    key = [F.lit("nodes").alias("src"), F.concat("pub_id", F.lit("/"), "id").alias("record_key")]
    para = n.where(F.col("type").isin("paragraph", "list_item"))
    d = table(spark, sf, "documents").select(F.lit("documents").alias("src"), F.col("doc_id").cast("string").alias("record_key"), F.col("text").alias("body"), "source", "stage")
    return [
        ("text", d),
        ("text", para.select(*key, F.col("text").alias("body"))),
        ("plain", para.select(*key, F.col("plain").alias("body"))),
        ("rows", n.where(F.col("type") == "table").select(*key, F.col("rows").alias("body"))),
    ]


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    out: DataFrame | None = None
    for name, df in fields(spark, sf):
        rows = name == "rows"
        text = F.array_join(F.flatten(F.transform("body", lambda r: F.coalesce(r, F.array().cast("array<string>")))), "\n") if rows else F.col("body")
        # only fields that can hold markup leave the JVM
        held = df.where(markup.may_hold(text))
        found = (markup.row_labels if rows else markup.element_labels)(F.col("body"))
        got = held.select("src", "record_key", F.lit(name).alias("field_name"), F.explode(found).alias("x"))
        out = got if out is None else out.unionByName(got)
    assert out is not None
    two = F.split("x", " ")
    return out.select("src", "record_key", "field_name", two[0].alias("markup"), two[1].alias("element_kind")).distinct()


def p3_clean(spark: SparkSession, sf: str) -> DataFrame:
    """The text of every field without markup. A table's ``clean`` is a line for each row
    with tabs between the cells; ``cells`` holds them as they stood, as JSON."""
    about = table(spark, sf, "documents").select("source", "stage").schema
    out: DataFrame | None = None
    for name, df in fields(spark, sf):
        body, doc, none = F.col("body"), "stage" in df.columns, F.lit(None).cast("string")
        # nodes may repeat
        df = df if doc else df.distinct().select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in about])
        if name == "rows":
            n_before = F.length(F.array_join(F.flatten(F.transform("body", lambda r: F.coalesce(r, F.array().cast("array<string>")))), ""))
            got = df.select("*", n_before.alias("n_before"), markup.clean_cells(body).alias("got"))
            text, cells = markup.table_text(F.col("got")), F.to_json("got")
        else:
            got, cells = df.select("*", F.length(body).alias("n_before")), none
            text = F.when(markup.may_hold(body), markup.clean_text(body, page=doc)).otherwise(F.trim(body))
        got = got.select("src", "record_key", F.lit(name).alias("field_name"), "source", "stage", "n_before", F.coalesce(text, F.lit("")).alias("clean"), cells.alias("cells"))
        out = got if out is None else out.unionByName(got)
    assert out is not None
    return out


def p4_formula(spark: SparkSession, sf: str) -> reading.Formula:
    """Fitted to slide_readability: a slide's grade is the mean over its statements of
    eight words and more. The sample is bounded by ``reading.MAX_LABELS`` slides."""
    docs = table(spark, sf, "documents").where((F.col("stage") == "clean") & F.col("text").isNotNull())
    shares = reading.frequent_words(docs)
    slides = table(spark, sf, "slide_readability").where(F.col("grade").isNotNull()).select("pub_id", "slide_id", "grade", "statements").distinct()
    # the same sample wherever the rows lie
    slides = slides.orderBy(F.xxhash64("pub_id", "slide_id"), "pub_id", "slide_id", "grade").limit(reading.MAX_LABELS)
    said = table(spark, sf, "claims").where(~F.col("in_notes") & F.col("text").isNotNull()).select("pub_id", "slide_id", "claim_id", "text").distinct()
    said = said.where(F.regexp_count("text", F.lit(reading.JAVA_WORD)) >= 8)
    got = said.join(slides, ["pub_id", "slide_id"]).groupBy("pub_id", "slide_id", "grade", "statements").agg(F.sort_array(F.collect_list("text")).alias("ts"))
    rows = got.where(F.size("ts") == F.col("statements")).orderBy("pub_id", "slide_id", "grade").collect()
    return reading.fit(shares, [(r.grade, list(r.ts)) for r in rows])


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    formula = p4_formula(spark, sf)
    said = table(spark, sf, "claims").where(~F.col("in_notes") & F.col("text").isNotNull())
    said = said.select(F.lit("claims").alias("src"), F.concat("pub_id", F.lit("/"), "claim_id").alias("record_key"), "text").distinct()
    docs = table(spark, sf, "documents").where((F.col("stage") == "clean") & F.col("text").isNotNull())
    docs = docs.select(F.lit("documents").alias("src"), F.col("doc_id").cast("string").alias("record_key"), "text")
    a = reading.graded(said, "text", formula, 8)
    b = reading.graded(docs, "text", formula, 40, only_english=True)
    out = a.unionByName(b).where(F.col("grade").isNotNull())
    return out.select("src", "record_key", reading.band(F.col("grade")).cast("int").alias("band")).distinct()


def p4_profile(spark: SparkSession, sf: str) -> DataFrame:
    """How demanding the texts of each source (clean English documents) and of each deck
    (statements, by publication) are: texts and words by band."""
    formula = p4_formula(spark, sf)
    docs = table(spark, sf, "documents").where((F.col("stage") == "clean") & F.col("text").isNotNull())
    docs = docs.select(F.lit("documents").alias("src"), F.col("source").alias("of"), "text")
    said = table(spark, sf, "claims").where(~F.col("in_notes") & F.col("text").isNotNull()).select("pub_id", "claim_id", "text").distinct()
    said = said.select(F.lit("claims").alias("src"), F.col("pub_id").alias("of"), "text")
    g = reading.graded(docs, "text", formula, 40, only_english=True).unionByName(reading.graded(said, "text", formula, 8)).where(F.col("grade").isNotNull())
    return g.groupBy("src", "of", reading.band(F.col("grade")).alias("band")).agg(F.count("*").alias("texts"), F.sum("words").alias("words"))


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    return leakage.leaked(table(spark, sf, "documents"), table(spark, sf, "eval_items"), "doc_id", "text", "item_id", "text")


def p7_report(spark: SparkSession, sf: str) -> DataFrame:
    """Per suite: items, items that leaked and the documents that hold them."""
    found = p7_found(spark, sf)
    items = table(spark, sf, "eval_items").select("item_id", "suite").distinct()
    per = items.join(found, "item_id", "left").groupBy("suite", "item_id").agg(F.count("doc_id").alias("n"))
    return per.groupBy("suite").agg(F.count("*").alias("items"), F.count_if(F.col("n") > 0).alias("leaked"), F.sum("n").alias("hits"))


def _tokenizer() -> tuple[str, str]:
    """Path of the ranks and the pattern that goes with them."""
    import public_tokenizers as P

    return P.path("byte_bpe_50k.tiktoken"), P.PATTERN


def p8_mixture(spark: SparkSession, sf: str) -> DataFrame:
    """Every use of a document in the mixture, with its slot."""
    ranks, pattern = _tokenizer()
    counted = mixing.token_counts(table(spark, sf, "documents").select("source", "doc_id", "text"), "text", ranks, pattern)
    # the counts are dear and used twice
    return mixing.mix(written(counted.select("source", "doc_id", "n_tokens")), table(spark, sf, "mix_targets"))


def p8_shares(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.shares(p8_mixture(spark, sf), table(spark, sf, "mix_targets"))


def p9_model(spark: SparkSession, sf: str) -> abuse.Model:
    """Fitted to ``content_labels``: at most ``abuse.MAX_JUDGED`` documents on whose kinds their
    raters agree, the same ones wherever the rows lie."""
    kinds = F.array_sort(F.collect_set("label"))
    judged = table(spark, sf, "content_labels").where("doc_id is not null and label is not null").groupBy("doc_id").agg(kinds.alias("kinds"))
    judged = judged.where(~F.array_contains("kinds", "none") | (F.size("kinds") == 1)).orderBy(F.xxhash64("doc_id"), "doc_id").limit(abuse.MAX_JUDGED)
    docs = table(spark, sf, "documents").select("doc_id", "text").where("text is not null")
    rows = docs.join(F.broadcast(judged), "doc_id").orderBy("doc_id", "text").collect()
    return abuse.fit([(r.text, frozenset(k for k in r.kinds if k in abuse.KINDS)) for r in rows])


def p9_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Every document's scores."""
    docs = table(spark, sf, "documents").select("doc_id", "source", "text")
    return abuse.scored(docs, "text", p9_model(spark, sf)).drop("text")


def p9_found(spark: SparkSession, sf: str) -> DataFrame:
    return abuse.cases(p9_scores(spark, sf), "doc_id").distinct()


def p9_rates(spark: SparkSession, sf: str) -> DataFrame:
    return abuse.rates(p9_scores(spark, sf), "source")


QUERIES = {f.__name__: f for f in (p1_found, p3_found, p3_clean, p4_found, p4_profile, p7_found, p7_report, p8_mixture, p8_shares, p9_found, p9_scores, p9_rates)}
SQL: dict[str, str] = {}
