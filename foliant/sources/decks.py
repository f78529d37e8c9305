"""Checks of decks and reviews as they are filed: one JSON text each."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.sources.readers import claims_of_decks

TREES = "struct<slides:array<struct<id:string,pattern:string,root:string,nodes:array<struct<key:string,kind:string,yes:string,no:string>>>>>"
REVIEW = "struct<spec_sha256:string,source_sha256:string,verdicts:map<string,string>,findings:array<struct<claim:string,verdict:string,status:string>>>"


def decision_trees(decks: DataFrame, spec: str = "spec") -> DataFrame:
    """(pub_id, slide_id, rule, key): what is wrong with the decision trees of decks (pub_id,
    ``spec``): keys that repeat or lack the root, questions without two branches that exist,
    outcomes that branch, branches that two nodes share or that run in a circle, and nodes that
    the root doesn't reach. A tree is one row; unreadable decks have none."""
    d = decks.select("pub_id", F.explode(F.from_json(spec, TREES)["slides"]).alias("s")).where("s.pattern = 'decision_tree'")
    d = d.select("pub_id", F.col("s.id").alias("slide_id"), F.col("s.root").alias("root"), F.filter(F.coalesce("s.nodes", F.array().cast("array<struct<key:string,kind:string,yes:string,no:string>>")), lambda n: n.isNotNull()).alias("ns"))
    d = d.withColumn("keys", F.transform("ns", lambda n: n["key"]))
    kids = lambda ns: F.flatten(F.transform(ns, lambda n: F.filter(F.array(n["yes"], n["no"]), lambda k: k.isNotNull())))
    grown = F.aggregate(F.sequence(F.lit(0), F.size("ns")), F.array("root"), lambda acc, _: F.array_distinct(F.concat(acc, kids(F.filter("ns", lambda n: F.array_contains(acc, n["key"]))))))
    d = d.withColumn("seen", grown).withColumn("taken", kids(F.filter("ns", lambda n: F.array_contains("seen", n["key"]))))
    has = lambda k: F.coalesce(F.array_contains("keys", k), F.lit(False))
    rule = lambda name, keys: F.transform(keys, lambda k: F.struct(F.lit(name).alias("rule"), k.alias("key")))
    of = lambda cond: F.transform(F.filter("ns", cond), lambda n: n["key"])
    found = F.concat(
        rule("keys", F.filter(F.array("root"), lambda r: ~has(r) | (F.size(F.array_distinct("keys")) < F.size("keys")))),
        rule("question without branches", of(lambda n: (n["kind"] == "question") & ~(has(n["yes"]) & has(n["no"])))),
        rule("outcome with branches", of(lambda n: (n["kind"] == "outcome") & (n["yes"].isNotNull() | n["no"].isNotNull()))),
        rule("shared or circular", F.filter(F.array_distinct("taken"), lambda k: (k == F.col("root")) | (F.size(F.filter("taken", lambda t: t == k)) > 1))),
        rule("unreached", F.array_except("keys", "seen")),
    )
    return d.select("pub_id", "slide_id", F.inline(found))


def review_errors(reviews: DataFrame, decks: DataFrame, review: str = "review", spec: str = "spec") -> DataFrame:
    """(pub_id, error, claim_id): what keeps a review (pub_id, ``review``) from holding for its deck
    (pub_id, ``spec``): another deck's or publication's hash, claims without a verdict, verdicts and
    findings for claims that there are not, and verdicts below pass that no open or accepted
    finding explains. The number of blocking findings is ``blocking``'s. Errors of the whole review
    have a null claim."""
    r = reviews.select("pub_id", F.from_json(review, REVIEW).alias("r")).where("r is not null")
    d = decks.select("pub_id", F.sha2(spec, 256).alias("sha"), F.get_json_object(spec, "$.pub.source_sha256").alias("source"))
    j = r.join(d, "pub_id")
    whole = [
        j.where(~F.col("r.spec_sha256").eqNullSafe(F.col("sha"))).select("pub_id", F.lit("the deck changed after the review").alias("error"), F.lit(None).cast("string").alias("claim_id")),
        j.where(~F.col("r.source_sha256").eqNullSafe(F.col("source"))).select("pub_id", F.lit("another publication").alias("error"), F.lit(None).cast("string").alias("claim_id")),
    ]
    claims = claims_of_decks(decks.select("pub_id", F.col(spec).alias("spec"))).select("pub_id", "claim_id").distinct()
    claims = claims.join(r.select("pub_id"), "pub_id", "left_semi")
    verdicts = r.select("pub_id", F.explode("r.verdicts").alias("claim_id", "verdict"))
    found = r.select("pub_id", F.inline("r.findings")).withColumnRenamed("claim", "claim_id")
    key = ["pub_id", "claim_id"]
    told = found.where(F.col("status").isin("open", "accepted")).select(*key).distinct()
    said = lambda df, what: df.select("pub_id", F.lit(what).alias("error"), "claim_id").distinct()
    parts = [
        said(claims.join(verdicts, key, "left_anti"), "no verdict"), said(verdicts.join(claims, key, "left_anti"), "verdict for an unknown claim"),
        said(found.join(claims, key, "left_anti"), "finding for an unknown claim"), said(verdicts.where("verdict <> 'pass'").join(told, key, "left_anti"), "verdict without a finding"),
    ]
    return functools.reduce(DataFrame.unionByName, whole + parts)


def blocking(reviews: DataFrame, review: str = "review") -> DataFrame:
    """(pub_id, blocking): open findings that are major or critical."""
    f = F.filter(F.from_json(review, REVIEW)["findings"], lambda x: (x["status"] == "open") & x["verdict"].isin("major", "critical"))
    return reviews.select("pub_id", F.size(F.coalesce(f, F.array().cast("array<struct<claim:string,verdict:string,status:string>>"))).alias("blocking"))
