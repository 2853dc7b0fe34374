"""Clauses of texts that name the texts they replace (JN-11)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canonry.functions.text import normal_title, title_keys
from canonry.operators.joins import as_of, first_wins

#: What follows a title that is revised, repealed or renamed, and how a title is shortened.
REVISED = r"(?:进行(?:了)?|作(?:了|出(?:了)?)|予以|已经|已)\s*修订|(?<!年)修订(?:了|为)"
REPEALED = r"(?:同时|同步|一并|予以|即行|决定)\s*废止|按法定程序\s*废止|自[^。\n，；;]{0,40}?起\s*废止"
RENAMED = "将《([^》]{4,120})》修订为《([^》]{4,120})》"
ALIAS = "《([^》]{4,120})》[^。《》]{0,80}?以下简称(?:原)?《([^》]{4,60})》"
REVISION = r"[（(]\s*(?:\d{4}年(?:\d{1,2}月)?)?修订\s*[）)]$"
TITLE = "《([^》]{4,120})》"


def base_title(title: Column) -> Column:
    """A title without the mark of a revision at its end."""
    return F.trim(F.regexp_replace(title, REVISION, ""))


def _named(docs: DataFrame) -> DataFrame:
    """_src, title, inference, rank of every title that a clause of a text replaces."""
    own = docs.select(F.col("id").alias("_src"), "title", "body").where("body is not null")
    # Revision of the text's own base title: the title in the body, and its verb within 80 characters.
    quoted = F.regexp_extract_all("body", F.lit(f"(?s){TITLE}(?=.{{0,80}}?(?:{REVISED}))"), 1)
    revised = own.where(base_title(F.col("title")) != F.col("title")).where(
        F.exists(quoted, lambda q: normal_title(q) == normal_title(base_title(F.col("title"))))
    ).select("_src", base_title(F.col("title")).alias("title"), F.lit("exact_title_revision").alias("inference"), F.lit(0).alias("rank"))
    old, new = (F.regexp_extract_all("body", F.lit(RENAMED), i) for i in (1, 2))
    pairs = own.select("_src", title_keys(F.col("title")).alias("keys"), F.explode(F.arrays_zip(old.alias("old"), new.alias("new"))).alias("p"))
    renamed = pairs.where(F.array_contains("keys", normal_title(F.col("p.new")))).select("_src", F.col("p.old").alias("title"), F.lit("explicit_rename").alias("inference"), F.lit(1).alias("rank"))
    # A clause reaches back from its verb to the last comma or semicolon, or to the head of a list of earlier ones.
    sentences = own.select("_src", F.explode(F.split("body", "[。！？!?]+")).alias("s")).where(F.col("s").rlike(REPEALED))
    clauses = F.concat(F.regexp_extract_all("s", F.lit(f"[^，；;]*(?:{REPEALED})"), 0), F.regexp_extract_all("s", F.lit(rf"(?s)此前发布的\s*(《.*(?:{REPEALED}))"), 1))
    titles = F.array_distinct(F.flatten(F.transform(clauses, lambda c: F.regexp_extract_all(c, F.lit(TITLE), 1))))
    repealed = sentences.select("_src", F.explode(titles).alias("title"), F.lit("explicit_repeal").alias("inference"), F.lit(2).alias("rank"))
    return revised.unionAll(renamed).unionAll(repealed).distinct()


def successors(docs: DataFrame) -> DataFrame:
    """(from_id, to_id, inference, title): texts and the older texts that their clauses replace.

    ``docs`` has id, title, org, day and body. A title names the one text with it among its
    keys, else the one whose whole title it is; a title that no text has is read by the
    text's own short forms (``以下简称``), if these name one title. The target of a revision
    is the one latest earlier text of the same base title and org; a tie names none. Never
    the text itself, never a later one; of a pair the first inference counts.

    Null titles, orgs and days match nothing (a null day rules nothing out); repeated rows
    count once; an empty table gives no rows.
    """
    docs = docs.select("id", "title", "org", "day", "body").where("id is not null")
    named = _named(docs)
    meta = docs.select("id", "title", "org", "day").distinct()
    keyed = meta.select("id", normal_title(F.col("title")).alias("whole"), F.explode(title_keys(F.col("title"))).alias("key"))
    by_key = keyed.groupBy("key").agg(
        F.min("id").alias("a"), F.max("id").alias("b"), F.min(F.when(F.col("whole") == F.col("key"), F.col("id"))).alias("wa"), F.max(F.when(F.col("whole") == F.col("key"), F.col("id"))).alias("wb")
    )
    target = F.when(F.col("a") == F.col("b"), F.col("a")).when(F.col("wa") == F.col("wb"), F.col("wa"))
    resolved = by_key.select("key", target.alias("to_id"), F.lit(True).alias("held"))
    full, short = (F.regexp_extract_all("body", F.lit(ALIAS), i) for i in (1, 2))
    aliases = docs.select(F.col("id").alias("_src"), F.explode(F.arrays_zip(full.alias("full"), short.alias("short"))).alias("p")).select("_src", normal_title(F.col("p.short")).alias("key"), F.col("p.full").alias("full"))
    aliases = aliases.groupBy("_src", "key").agg(F.min("full").alias("full"), F.max("full").alias("other")).where("full = other").drop("other")
    plain = named.where("rank > 0").withColumn("key", normal_title(F.col("title"))).join(resolved, "key", "left")
    direct = plain.where("to_id is not null").select("_src", "to_id", "title", "inference", "rank")
    spoken = plain.where("held is null").select("_src", "key", "inference", "rank").join(aliases, ["_src", "key"]).withColumn("key", normal_title(F.col("full")))
    by_alias = spoken.join(resolved.where("to_id is not null"), "key").select("_src", "to_id", F.col("full").alias("title"), "inference", "rank")
    # Revisions: the last earlier text of the base title and org.
    own = named.where("rank = 0").select("_src", "title", "inference", "rank")
    older = meta.select(normal_title(base_title(F.col("title"))).alias("base"), "org", F.col("day").alias("_day"), F.col("id").alias("_id")).where("base <> '' and org is not null")
    probe = own.join(meta.select(F.col("id").alias("_src"), "org", "day"), "_src").withColumn("base", normal_title(F.col("title"))).where("org is not null and day is not null")
    earlier = as_of(probe, older, ["base", "org"], "day", "_day", "_id", forward=False, unique=True)
    revised = earlier.where("as_of_id is not null").select("_src", F.col("as_of_id").alias("to_id"), "title", "inference", "rank")
    found = direct.unionAll(by_alias).unionAll(revised).where("_src <> to_id")
    days = meta.groupBy("id").agg(F.min("day").alias("day"))
    dated = found.join(days.select(F.col("id").alias("_src"), F.col("day").alias("d0")), "_src", "left").join(days.select(F.col("id").alias("to_id"), F.col("day").alias("d1")), "to_id", "left")
    kept = dated.where("d0 is null or d1 is null or d0 >= d1").select(F.col("_src").alias("from_id"), "to_id", "rank", "inference", "title")
    return first_wins(kept, ["from_id", "to_id"], [F.col("rank")]).select("from_id", "to_id", "inference", "title")
