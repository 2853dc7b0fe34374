"""Problem 3: matching instruments across sources without keys, by a deterministic rule cascade.

Each pass joins on one combination of attributes, exactly; what it resolves is left out of
all later, weaker passes. A rule's confidence is its precision on labelled pairs, smoothed:
of all pairs with the rule's keys whose other attributes can be compared, the share where
they agree, with one success and one failure added.

Rules, strongest first: number and name; number and day; number and nearly the same name;
name and day; nearly the same name and day; number with an unreadable name; name alone;
nearly the same name alone. Days match within three days. Records marked as drafts,
explanations or other versions match nothing that isn't marked alike; two real numbers
that differ rule a match out.

Results in special cases: null, empty and ``unknown`` values take part in no key; partial
dates count only where they contradict; repeated rows count once; equal names of several
instruments that nothing tells apart give no match; empty tables give no rows; extra
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from canonry.functions.dates import china_date, lenient_date
from canonry.session import cut, release, table

#: Days that dates of one instrument may differ.
DAYS = 3
#: Letters of a name part that is a key of its own.
PART = 7
_WIDE = "".join(chr(c) for c in range(0xFF01, 0xFF5F)) + "　"
_NARROW = "".join(chr(c) for c in range(0x21, 0x7F)) + " "
#: Marks of records about an instrument, or of another version of it.
MARKS = "征求意见|意见稿|草案|解读|起草说明|一图读懂|问答|答记者问|修订|修正|废止|consultationdraft|draft|explanat|interpretation|q&a|revis|amended|repeal"
#: What issues or quotes an instrument under its title; group 1 is the title.
WRAPPERS = (
    r"^【[^】]*】(.+)$",
    r"^\[[^\]]*\](.+)$",
    r"^notice:(.+)$",
    r"^.{0,40}?关于(?:发布实施|印发|发布|公布|颁布|转发|下发)《(.+)》(?:有关事项)?的(?:通知|公告|决定|令)$",
    r"^关于(?:发布实施|印发|发布|公布|颁布|转发|下发)(.+)有关事项的(?:通知|公告|决定|令)$",
    r"^《(.+)》$",
    r"^(.+)\((?:全文|英文版|englishtranslation|fulltext)\)$",
)


def _folded(x: Column) -> Column:
    return F.lower(F.translate(x, _WIDE, _NARROW))


def name_core(name: Column) -> tuple[Column, Column, Column]:
    """The title in a name without wrappers, marks, blanks and punctuation; the marks in it
    (sorted, joined); whether it is cut off."""
    x = F.regexp_replace(F.regexp_replace(_folded(name), r"\bthe\b", ""), r"[\s\x{3000}\x{A0}]+", "")
    marks = F.array_join(F.array_sort(F.array_distinct(F.regexp_extract_all(x, F.lit(f"({MARKS})"), 1))), "|")
    short = F.regexp_replace(x, r"(?:…+|\.\.\.+)(?:》.*)?$", "")
    cut_off = short != x
    x = short
    for _ in range(2):
        for w in WRAPPERS:
            x = F.regexp_replace(x, w, "$1")
    x = F.regexp_replace(x, r"[^\p{L}\p{N}]", "")
    return F.nullif(x, F.lit("")), marks, cut_off


def number_key(fileno: Column) -> Column:
    """Issuer, year and serial number of a document number in any notation; else null."""
    x = F.regexp_replace(_folded(fileno), r"[\s\x{3000}]+", "")
    p = r"^([^\d\W]+)[^\p{L}\d]*((?:19|20)\d{2})[^\d]*?0*(\d+)\D*$"
    p = p.replace(r"[^\d\W]", r"[\p{L}]")
    return F.when(x.rlike(p), F.regexp_replace(x, p, "$1|$2|$3"))


def _side(df: DataFrame, key: str, name: Column, fileno: Column, day: Column, raw_date: Column) -> DataFrame:
    core, marks, cut_off = name_core(name)
    year = F.regexp_extract(raw_date, r"^\D*((?:19|20)\d{2})", 1)
    return df.select(
        F.col(key), core.alias("core"), F.coalesce(marks, F.lit("")).alias("marks"), F.coalesce(cut_off, F.lit(False)).alias("cut_off"),
        number_key(fileno).alias("number"), day.alias("day"), F.nullif(year, F.lit("")).cast("int").alias("year"),
        name.rlike(r"[\x{80}-\x{9F}\x{FFFD}\x{FF61}-\x{FF9F}\x{E000}-\x{F8FF}]|[\x{A0}-\x{FF}]{2}").alias("odd"),
    ).where(F.col(key).isNotNull()).distinct()


def sides(law_detail: DataFrame, records: DataFrame) -> tuple[DataFrame, DataFrame]:
    law = law_detail.select(F.col("lawlist.law.secFutrsLawId").alias("law_id"), *(F.col(f"lawlist.law.{c}").alias(c) for c in ("secFutrsLawName", "fileno", "pubDate")))
    day = china_date(F.col("pubDate"))
    a = _side(law, "law_id", F.col("secFutrsLawName"), F.col("fileno"), day, day.cast("string"))
    m = records.select("source_record_id", *(F.col(f"metadata.{c}").alias(c) for c in ("name", "fileno", "pub_date")))
    b = _side(m, "source_record_id", F.col("name"), F.col("fileno"), lenient_date(F.col("pub_date")), F.col("pub_date"))
    return a, b


def _pairs(a: DataFrame, b: DataFrame, keys: list[tuple[Column, Column]]) -> DataFrame:
    """Pairs that share a key; a side's rows without it take no part. Hot keys are split by AQE."""
    x = a.select(F.struct(*a.columns).alias("a"), *(k.alias(f"k{i}") for i, (k, _) in enumerate(keys))).dropna(subset=[f"k{i}" for i in range(len(keys))])
    y = b.select(F.struct(*b.columns).alias("b"), *(k.alias(f"k{i}") for i, (_, k) in enumerate(keys))).dropna(subset=[f"k{i}" for i in range(len(keys))])
    return x.join(y, [f"k{i}" for i in range(len(keys))]).select("a", "b")


def _near(distance: int) -> Column:
    """Nearly the same name: few edits, or cut off behind the same beginning."""
    a, b = F.col("a.core"), F.col("b.core")
    head = F.substring(a, F.lit(1), F.length(b))
    whole = F.levenshtein(a, b, distance) >= 0
    return F.coalesce(
        F.when(F.col("b.cut_off"), (F.length(b) >= 8) & (F.length(b) <= F.length(a)) & (F.levenshtein(head, b, distance) >= 0)).otherwise((F.length(b) >= 8) & whole), F.lit(False)
    )


#: Conditions on a pair, as SQL, so the module can be imported without a session.
_AGREE_DAY = f"abs(datediff(a.day, b.day)) <= {DAYS}"
_SAME_NAME = "coalesce(a.core = b.core, false)"
_SAME_NUMBER = "coalesce(a.number = b.number, false)"
_OTHER_NUMBER = "coalesce(a.number <> b.number, false)"
_NO_DAY = "(a.day is null or b.day is null)"
_YEAR_OK = "coalesce(abs(a.year - b.year) <= 1, true)"
_MARKED_ALIKE = "a.marks = b.marks"


def _part(core: str, where: str) -> Column:
    bare = F.regexp_replace(core, "^关于", "")
    latin = bare.rlike("^[a-z]")
    piece = F.substring(bare, 1, PART) if where == "head" else F.right(bare, F.lit(PART))
    return F.when(F.length(bare) >= PART + 2, F.when(latin, F.substring(bare, 1, 60) if where == "head" else F.right(bare, F.lit(60))).otherwise(piece))


def matches(a: DataFrame, b: DataFrame, labels: bool = True) -> DataFrame:
    """law_id, source_record_id, rule and, with ``labels``, confidence of every match."""
    number, core = ("number", "core")
    by = lambda k: (F.col(k), F.col(k))
    # Days that differ by no more than DAYS meet in a span of 2 * DAYS + 1 days: that of the record, one of the at most two that the law's days touch.
    span = lambda day: F.floor(F.unix_date(day) / (2 * DAYS + 1))
    wide = a.withColumn("near_day", F.explode_outer(F.array_distinct(F.array(span(F.date_sub("day", DAYS)), span(F.date_add("day", DAYS))))))
    by_day = (F.col("near_day"), span(F.col("day")))
    strip = lambda df: df.select(F.struct(*(F.col(f"a.{c}") for c in a.columns)).alias("a"), "b")
    # Rule: pairs by its keys, what must hold, what labels a pair, and whether it is right.
    agree_day, same_name, same_number, other_number, no_day, year_ok, alike = map(F.expr, (_AGREE_DAY, _SAME_NAME, _SAME_NUMBER, _OTHER_NUMBER, _NO_DAY, _YEAR_OK, _MARKED_ALIKE))
    both_numbers = same_number | other_number
    rules = [
        ("number_name", lambda a, b: _pairs(a, b, [by(number), by(core)]), alike, ~no_day, agree_day),
        ("number_day", lambda a, b: strip(_pairs(wide, b, [by(number), by_day])), alike & agree_day, ~F.col("a.odd"), same_name | _near(2)),
        ("number_near_name", lambda a, b: _pairs(a, b, [by(number)]), alike & _near(2) & year_ok, ~no_day, agree_day),
        ("name_day", lambda a, b: strip(_pairs(wide, b, [by(core), by_day])), alike & agree_day, both_numbers, same_number),
        ("near_name_day", lambda a, b: strip(_by_parts(wide, b, [by_day])), alike & agree_day & _near(2), both_numbers, same_number),
        ("number_unreadable_name", lambda a, b: _pairs(a, b, [by(number)]), (F.col("a.odd") | F.col("a.core").isNull()) & no_day & year_ok & (F.col("b.marks") == ""), ~no_day, agree_day),
        ("name", lambda a, b: _pairs(a, b, [by(core)]), alike & no_day & year_ok, both_numbers, same_number),
        ("near_name", lambda a, b: _by_parts(a, b, []), alike & no_day & year_ok & _near(2), both_numbers, same_number),
    ]
    open_records, found, passes = b, None, []
    for i, (rule, pairs, holds, labelled, right) in enumerate(rules):
        kept = cut(
            pairs(a, open_records).where(holds & ~other_number).select(
                F.col("a.law_id").alias("law_id"), F.col("b.source_record_id").alias("source_record_id"), F.lit(rule).alias("rule"), F.lit(i).alias("pass"),
                F.coalesce(F.abs(F.datediff("a.day", "b.day")), F.lit(DAYS + 1)).alias("apart"), F.levenshtein(F.coalesce("a.core", F.lit("")), F.coalesce("b.core", F.lit(""))).alias("edits"),
            )
        )
        passes.append(kept)
        found = kept if found is None else found.unionAll(kept)
        open_records = open_records.join(kept.select("source_record_id").distinct(), "source_record_id", "left_anti")
    # One instrument per record: the nearest; of equally near ones none.
    nearness = F.struct("apart", "edits")
    best = found.groupBy("source_record_id").agg(F.min(nearness).alias("nearest"))
    picked = found.join(best, "source_record_id").where(nearness == F.col("nearest")).groupBy("source_record_id").agg(
        F.min("law_id").alias("law_id"), F.max("law_id").alias("other"), F.min("rule").alias("rule"), F.min("pass").alias("pass")
    ).where("law_id = other")
    picked = cut(picked)
    release(*passes)
    if not labels:
        return picked.select("law_id", "source_record_id", "rule")
    # Labelled pairs are looked for among all records, those that stronger rules resolved included.
    precision = None
    for i, (_, pairs, holds, labelled, right) in enumerate(rules):
        one = pairs(a, b).where(holds & labelled).agg(F.lit(i).alias("pass"), F.round((F.count_if(right) + 1) / (F.count(F.lit(1)) + 2), 6).alias("confidence"))
        precision = one if precision is None else precision.unionAll(one)
    return picked.join(F.broadcast(precision), "pass").select("law_id", "source_record_id", "rule", "confidence")  # a row per rule


def _by_parts(a: DataFrame, b: DataFrame, more: list[tuple[Column, Column]]) -> DataFrame:
    pairs = [_pairs(a, b, [(_part("core", end), _part("core", end)), *more]) for end in ("head", "tail")]
    if more:  # names too short for long parts; these are selective only together with a day
        pairs += [_pairs(a, b, [(_short_part("core", end), _short_part("core", end)), *more]) for end in ("head", "tail")]
    out = pairs[0]
    for p in pairs[1:]:
        out = out.unionAll(p)
    return out.distinct()


def _short_part(core: str, where: str) -> Column:
    """The first four letters of a short name, or the four before its last four."""
    bare = F.regexp_replace(core, "^关于", "")
    piece = F.substring(bare, 1, 4) if where == "head" else F.substring(bare, F.length(bare) - 7, F.lit(4))
    return F.when((F.length(bare) >= 8) & (F.length(bare) < 2 * PART + 3), piece)


def _matched(spark: SparkSession, sf_dir: str, labels: bool) -> DataFrame:
    both = [*map(cut, sides(table(spark, sf_dir, "law_detail"), table(spark, sf_dir, "source_record")))]
    out = cut(matches(*both, labels))
    release(*both)
    return out


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of law_id and source_record_id that are the same instrument."""
    return _matched(spark, sf_dir, False).select("law_id", "source_record_id")


def p3_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same pairs, each with its rule and confidence."""
    return _matched(spark, sf_dir, True)


QUERIES = {"p3_found": p3_found, "p3_confidence": p3_confidence}
