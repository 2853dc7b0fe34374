"""Column functions over text. Whitespace and punctuation are explicit character classes,
because ``\\s`` differs between regex engines on U+00A0 and U+3000."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Class body of everything treated as white space, the ideographic space included.
SPACE = r" \t\n\r\f\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"


def compact(text: Column) -> Column:
    """Text without any white space; null stays null."""
    return F.regexp_replace(text, f"[{SPACE}]+", "")


def narrow(text: Column) -> Column:
    """Full-width letters, digits and marks as their ASCII ones; nothing else changes."""
    return F.translate(text, "".join(map(chr, range(0xFF01, 0xFF5F))), "".join(map(chr, range(0x21, 0x7F))))


def blank(text: Column) -> Column:
    """True for null, empty and white-space-only text."""
    return text.isNull() | (F.length(compact(text)) == 0)


def letters_digits(text: Column) -> Column:
    """Lower-cased text reduced to letters and digits of any script."""
    return F.lower(F.regexp_replace(text, r"[^\p{L}\p{N}]", ""))


def canonical_system(name: Column) -> Column:
    """One spelling of a source system: lower case, no outer blanks, underscores."""
    return F.regexp_replace(F.lower(F.regexp_replace(name, f"^[{SPACE}]+|[{SPACE}]+$", "")), f"[-{SPACE}]+", "_")


def digest(sha: Column) -> Column:
    """A SHA-256 digest as 64 lower-case hex digits, or null where it is none.

    Prefixes such as ``sha256:``, case and blanks don't matter.
    """
    bare = F.regexp_replace(F.lower(compact(sha)), r"^sha-?256[:=]", "")
    return F.when(bare.rlike("^[0-9a-f]{64}$"), bare)


#: White space and punctuation that titles and numbers are compared without.
PUNCT = SPACE + r"，。、；：？！“”‘’（）《》〈〉【】〔〕﹝﹞｜\[\]().,;:?!\"'·—_…|/\\-"
#: What titles and numbers are compared without, and entities that titles can hold.
TITLE_PUNCT = SPACE + "·•,，。；;:：()（）\\[\\]【】《》“”\"'、—-"
ENTITIES = {"&nbsp;": "\u00a0", "&quot;": '"', "&apos;": "'", "&lt;": "<", "&gt;": ">", "&ldquo;": "“", "&rdquo;": "”", "&lsquo;": "‘", "&rsquo;": "’", "&middot;": "·", "&mdash;": "—", "&ndash;": "–", "&hellip;": "…", "&amp;": "&"}
#: Fixed value: what a request for opinions puts before a title.
ORDER_PREFIX = "^(?:关于)?(?:公开征求意见|征求意见)(?:的)?(?:通知|公告)?"
#: What marks a draft or a trial version in a title.
DRAFT = "征求意见稿|草案|意见稿|consultation draft|draft"
TRIAL = "试行|trial"
#: A leading attachment mark and file suffixes of titles.
ATTACHMENT = r"^附件(?:\s*\d+(?:-\d+)?)?\s*[：:、.\-]?\s*"
SUFFIX = r"(?i)\.(?:pdf|docx?|xlsx?|zip|rar|rtf|wps)$"


def unescaped(text: Column) -> Column:
    """Text with the entities of ENTITIES and numeric ones as characters; others stay."""
    number = lambda x, code, n: F.replace(x, code, F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32"))
    valid = lambda n: n.between(1, 0x10FFFF) & ~n.between(0xD800, 0xDFFF)

    def numeric(x: Column, pattern: str, base: int) -> Column:
        found = F.array_distinct(F.regexp_extract_all(x, F.lit(pattern), 0))
        value = lambda code: F.conv(F.regexp_extract(code, pattern, 1), base, 10).cast("bigint")
        return F.aggregate(found, x, lambda t, code: F.when(valid(value(code)), number(t, code, value(code))).otherwise(t))

    x = numeric(numeric(text, "&#([0-9]{1,7});", 10), "&#[xX]([0-9a-fA-F]{1,6});", 16)
    for entity, char in ENTITIES.items():
        x = F.replace(x, F.lit(entity), F.lit(char))
    return F.when(F.contains(text, F.lit("&")), x).otherwise(text)


def clean_title(title: Column) -> Column:
    """Title without entities, outer blanks, a leading attachment mark and a file suffix."""
    x = F.regexp_replace(unescaped(title), f"^[{SPACE}]+|[{SPACE}]+$", "")
    return F.regexp_replace(F.regexp_replace(x, ATTACHMENT, ""), SUFFIX, "")


def normal_title(title: Column) -> Column:
    """Cleaned title without white space and the marks of TITLE_PUNCT, lower case."""
    return F.lower(F.regexp_replace(clean_title(title), f"[{TITLE_PUNCT}]+", ""))


def quoted_titles(text: Column) -> Column:
    """Every title of 4 to 120 characters between 《 and 》, in order."""
    return F.regexp_extract_all(text, F.lit("《([^《》]{4,120})》"), 1)


def title_keys(title: Column) -> Column:
    """Distinct normal forms of a title and of the titles quoted in it, without draft marks and the words of a request for opinions."""
    bare = lambda x: normal_title(F.regexp_replace(F.regexp_replace(F.lower(clean_title(x)), f"[(（]?(?:{DRAFT})[)）]?", ""), ORDER_PREFIX, ""))
    return F.filter(F.array_distinct(F.concat(F.array(bare(title)), F.transform(quoted_titles(title), bare))), lambda x: F.length(x) > 0)


def fileno_key(fileno: Column) -> Column:
    """Issuer, year and serial number of a document number, in any notation; else null."""
    x = F.regexp_replace(F.lower(narrow(fileno)), f"[第号年{PUNCT}]+", "")
    return F.when(x.rlike(r"^\p{L}+(?:19|20)\d{2}\d+$"), x)


def number_keys(fileno: Column) -> Column:
    """Keys of a document number as it is written (TXT-06): without blanks and marks, in lower case,
    and the number of an order in it (``第5号``). Empty for none, null for null."""
    x = F.lower(F.regexp_replace(unescaped(narrow(fileno)), f"[{TITLE_PUNCT}]+", ""))
    order = F.regexp_extract(x, "第[0-9]+号", 0)
    return F.when(x.isNotNull(), F.filter(F.array_distinct(F.array(x, order)), lambda k: k != ""))


def body_hash(text: Column, least: int = 80) -> Column:
    """SHA-256 of the text without white space; null under ``least`` characters."""
    x = compact(text)
    return F.when(F.length(x) >= least, F.sha2(x, 256))


def clean_lines(text: Column) -> Column:
    """Trimmed, non-empty lines with inner blanks squeezed, joined by line feeds."""
    lines = F.split(F.regexp_replace(text, "\r\n?", "\n"), "\n")
    squeezed = F.transform(lines, lambda x: F.regexp_replace(F.regexp_replace(x, f"[{SPACE}]+", " "), "^ | $", ""))
    return F.array_join(F.filter(squeezed, lambda x: F.length(x) > 0), "\n")


def shingle_coverage(source: Column, target: Column, width: int = 20) -> Column:
    """Share of a source's chunks of ``width`` letters and digits found in the target.

    Null for an empty source; 0 or 1 where it is shorter than a chunk.
    """
    s, t = letters_digits(source), letters_digits(target)
    n = F.length(s)
    starts = F.sequence(F.lit(1), F.greatest(n - width + 1, F.lit(1)), F.lit(width))
    hit = F.size(F.filter(starts, lambda i: F.contains(t, F.substring(s, i, F.lit(width)))))
    return F.when(n > 0, F.round(hit / F.size(starts), 6))


def overlap_score(a: Column, b: Column) -> Column:
    """Share of the longer title's distinct characters in both; 1 where one holds the other."""
    x, y = F.array_distinct(F.split(a, "")), F.array_distinct(F.split(b, ""))
    ratio = F.size(F.array_intersect(x, y)) / F.greatest(F.size(x), F.size(y))
    return F.when((F.length(a) == 0) | (F.length(b) == 0), F.lit(0.0)).when(F.contains(a, b) | F.contains(b, a), F.lit(1.0)).otherwise(F.round(ratio, 6))


#: Query keys that only track visitors.
TRACKING = "utm_[a-z]+|_|timestamp|spm|from|source"


def canonical_url(url: Column, keep_query: bool = True) -> Column:
    """Lower-case scheme and host, no double slashes in the path, no fragment, ``/`` for an
    empty path; tracking keys dropped in order, or with ``keep_query`` off the whole query."""
    p = r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)(?:\?([^#]*))?(?:#.*)?$"
    part = lambda i: F.regexp_extract(url, p, i)
    path = F.regexp_replace(part(3), "/{2,}", "/")
    kept = F.array_join(F.filter(F.split(part(4), "&"), lambda k: (F.length(k) > 0) & ~k.rlike(f"(?i)^(?:{TRACKING})(?:=|$)")), "&")
    out = F.concat(F.lower(part(1)), F.lit("://"), F.lower(part(2)), F.when(path == "", F.lit("/")).otherwise(path))
    if keep_query:
        out = F.concat(out, F.when(kept == "", F.lit("")).otherwise(F.concat(F.lit("?"), kept)))
    return F.when(url.rlike(p), out).otherwise(url)


def truncate_utf8(text: Column, size: int) -> Column:
    """The longest beginning of a text that takes at most ``size`` bytes of UTF-8."""
    bytes_of = F.transform(F.split(text, ""), lambda c: F.octet_length(c))
    ends = F.aggregate(bytes_of, F.struct(F.lit(0).alias("bytes"), F.lit(0).alias("chars")), lambda s, b: F.when(
        (s["bytes"] >= 0) & (s["bytes"] + b <= size), F.struct((s["bytes"] + b).alias("bytes"), (s["chars"] + 1).alias("chars"))
    ).otherwise(F.struct(F.lit(-1).alias("bytes"), s["chars"].alias("chars"))))
    return F.substring(text, F.lit(1), ends["chars"])


def slice_between(text: Column, start: Column, end: Column) -> Column:
    """Compact text from the start marker up to the end marker (TXT-09), white space ignored.

    Null unless each marker occurs exactly once and in that order.
    """
    t, a, b = compact(text), compact(start), compact(end)
    times = lambda m: (F.length(t) - F.length(F.replace(t, m, F.lit("")))) / F.length(m)
    i, j = F.instr(t, a), F.instr(t, b)
    return F.when((F.length(a) > 0) & (F.length(b) > 0) & (times(a) == 1) & (times(b) == 1) & (i < j), F.substring(t, i, j - i))


def markdown_body(text: Column) -> Column:
    """Plain text as Markdown (TXT-10): chapters and articles become headings, page numbers go,
    wrapped lines are joined, with a blank only between Latin words, until a sentence ends."""
    lines = F.split(clean_lines(text), "\n")
    heading = lambda x: F.when(x.rlike("^第[一二三四五六七八九十百]+章|^Chapter [0-9]+"), F.concat(F.lit("## "), x)).when(x.rlike("^第[一二三四五六七八九十百]+条|^Article [0-9]+"), F.concat(F.lit("**"), F.regexp_extract(x, "^(第[一二三四五六七八九十百]+条|Article [0-9]+)", 1), F.lit("**"), F.regexp_replace(x, "^(?:第[一二三四五六七八九十百]+条|Article [0-9]+)", "")))
    kept = F.filter(lines, lambda x: ~x.rlike("^[-—– ]*[0-9]{1,4}[-—– ]*$"))

    def joined(pair: Column, i: Column) -> Column:
        """A line with what stands between it and the one before it."""
        x, last = pair["x"], pair["last"]
        open_end = ~last.rlike("[。！？；：.!?;:]$") & ~last.rlike("^第[一二三四五六七八九十百]+章|^Chapter [0-9]+")
        head = heading(x)
        between = F.when(i == 0, F.lit("")).when(head.isNotNull() | ~open_end, F.lit("\n\n")).when(last.rlike("[A-Za-z0-9,;)]$") & x.rlike("^[A-Za-z0-9(]"), F.lit(" ")).otherwise(F.lit(""))
        return F.concat(between, F.coalesce(head, x))

    before = F.concat(F.array(F.lit("")), F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(0))))
    return F.array_join(F.transform(F.arrays_zip(kept.alias("x"), before.alias("last")), joined), "")


def markdown_table(matrix: Column) -> Column:
    """A ragged matrix of cells as a Markdown table (TXT-14), padded, with escaped bars."""
    width = F.array_max(F.transform(matrix, F.size))
    cell = lambda c: F.replace(F.regexp_replace(F.coalesce(c, F.lit("")), r"\s*\n\s*", " "), F.lit("|"), F.lit("\\|"))
    row = lambda r: F.concat(F.lit("| "), F.array_join(F.transform(F.concat(r, F.array_repeat(F.lit(""), width - F.size(r))), cell), " | "), F.lit(" |"))
    rows = F.transform(matrix, row)
    rule = F.concat(F.lit("| "), F.array_join(F.array_repeat(F.lit("---"), width), " | "), F.lit(" |"))
    return F.when(F.size(matrix) > 0, F.array_join(F.concat(F.slice(rows, 1, 1), F.array(rule), F.slice(rows, 2, 1 << 30)), "\n"))


#: Phrases that send the reader to an attachment, and marks of sections.
SEE_ATTACHMENT = "详[细情]?见附件|详情请(?:查看)?附件|全文详见附件|见附件|附件下载|相关文档"
SECTION = "第[一二三四五六七八九十百千零〇0-9]+[条章节编款项部分]"


def low_signal(title: Column, text: Column) -> Column:
    """Whether a text says nothing beyond its title (FIL-10).

    Title, attachment phrases and section marks are taken out of the text without blanks and
    punctuation. True if nothing was there, if only the title was, if a phrase was and at
    most 30 characters are left, or if the title was and at most 8 are. A null text is empty.
    """
    bare = lambda x: F.coalesce(F.regexp_replace(x, f"[{PUNCT}]+", ""), F.lit(""))
    t, x = bare(title), bare(text)
    rest = F.when(t == "", x).otherwise(F.replace(x, t, F.lit("")))
    rest = F.regexp_replace(F.regexp_replace(rest, SEE_ATTACHMENT, ""), SECTION, "")
    return (x == "") | ((t != "") & (rest == "")) | (x.rlike(SEE_ATTACHMENT) & (F.length(rest) <= 30)) | ((t != "") & F.contains(x, t) & (F.length(rest) <= 8))


def resolved_link(href: Column, base: Column) -> Column:
    """Absolute address of a link on a page (FIL-16).

    What leaked behind a quote or blank goes; an address inside another wins; ``//`` means
    https; ``/`` is the host's; anything else is beside the page. Null for null, empty,
    script and mail links and for bare fragments.
    """
    x = F.regexp_replace(F.trim(href), "[\"'\\s<>].*$", "")
    nested = F.regexp_extract(x, "^.+?(https?://.+)$", 1)
    x = F.when(F.length(nested) > 0, nested).otherwise(x)
    host = F.regexp_extract(base, "^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)", 1)
    folder = F.regexp_extract(base, "^([A-Za-z][A-Za-z0-9+.-]*://[^?#]*/)[^/?#]*", 1)
    beside = F.concat(F.when(F.length(folder) > F.length(host) + 1, folder).otherwise(F.concat(host, F.lit("/"))), F.regexp_replace(x, r"^(?:\./)+", ""))
    made = F.when(x.rlike("(?i)^https?://"), x).when(x.startswith("//"), F.concat(F.lit("https:"), x)).when(x.startswith("/"), F.concat(host, x)).otherwise(beside)
    return F.when((F.length(x) > 0) & ~x.rlike("(?i)^(?:javascript|mailto|tel|data):|^#"), made)


def composed_text(parts: Column) -> Column:
    """An array's non-blank values, trimmed, with a blank line between them (TXT-11); empty for none, null for null."""
    bare = F.transform(parts, lambda x: F.regexp_replace(x, f"^[{SPACE}]+|[{SPACE}]+$", ""))
    return F.array_join(F.filter(bare, lambda x: x.isNotNull() & (x != "")), "\n\n")


def markdown_main(markdown: Column) -> Column:
    """Main body of an exported Markdown text (TXT-15): no front matter, first heading, leading
    table and generated sections (relations, sources, attachments)."""
    x = F.regexp_replace(markdown, r"^---\n[\s\S]*?\n---\n*", "")
    x = F.regexp_replace(x, r"^\s*# [^\n]*\n*", "")
    x = F.regexp_replace(x, r"^\s*(?:\|[^\n]*\|\n*)+", "")
    x = F.regexp_replace(x, r"(?:^|\n)## (?:关联关系|来源|附件|Relations|Sources|Attachments)\n[\s\S]*$", "")
    return F.regexp_replace(x, f"^[{SPACE}]+|[{SPACE}]+$", "")


#: Endings of names of institutions and of products.
INSTITUTION = "资产管理有限公司|基金管理有限公司|证券有限公司|有限责任公司|股份有限公司|有限公司|合伙企业"


def institutions(text: Column) -> Column:
    """Distinct names in a text that end as those of institutions do (TXT-19), in order."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(rf"(?:对|，|、|；|。|^|\s)?((?:[\p{{IsHan}}]{{2,12}}?)(?:{INSTITUTION}))"), 1))


def call_arguments(call: Column) -> Column:
    """The quoted arguments of a call as in ``f('a','b')`` (TXT-20)."""
    return F.regexp_extract_all(call, F.lit(r"'([^']*)'"), 1)


def script_safe(json: Column) -> Column:
    """JSON that can stand in a script element (TXT-20): ``</`` can't end it."""
    return F.replace(json, F.lit("</"), F.lit("<\\/"))


def unique_present(values: Column) -> Column:
    """Distinct values in order of first appearance, without nulls and blanks (ARR-01, SET-05)."""
    return F.array_distinct(F.filter(values, lambda x: x.isNotNull() & (F.trim(x) != "")))


def chinese_number(n: Column) -> Column:
    """A number from 1 to 99 in Chinese (NUM-02); null for others."""
    digits = F.array(*map(F.lit, ["", *"一二三四五六七八九"]))
    digit = lambda x: F.element_at(digits, x + 1)
    tens, ones = F.floor(n / 10).cast("int"), (n % 10).cast("int")
    return F.when(n.between(1, 9), digit(ones)).when(n.between(10, 99), F.concat(F.when(tens > 1, digit(tens)).otherwise(F.lit("")), F.lit("十"), digit(ones)))


def unmangled(text: Column) -> Column:
    """Text whose UTF-8 was taken for Latin-1, as it was (TXT-12), also if that happened twice; other
    text stays. Decided by the shape of the bytes, so it needs no model and no Python."""
    shape = r"^[\x{00}-\x{FF}]*$"
    sign = r"[\x{C2}-\x{F4}][\x{80}-\x{BF}]"

    def once(x: Column) -> Column:
        back = F.try_validate_utf8(F.encode(x, "ISO-8859-1"))
        return F.when(x.rlike(shape) & x.rlike(sign), F.coalesce(back, x)).otherwise(x)

    return once(once(text))


def relinked(markdown: Column, prefix: str, to: str) -> Column:
    """Markdown whose links below ``prefix`` go below ``to`` (TXT-14)."""
    quoted = "".join(f"\\{c}" if c in ".^$*+?()[]{}|\\/-" else c for c in prefix)
    return F.regexp_replace(markdown, rf"\]\({quoted}", "](" + to.replace("\\", "\\\\").replace("$", "\\$"))


def legal_basis(text: Column) -> Column:
    """Titles quoted in a text with the article cited of each (HTM-02): an array of title and entry,
    an element per article, with a null entry where none follows; null for null."""
    item = "《([^《》]{2,120})》((?:[、，和及与]?第[一二三四五六七八九十百零〇0-9]+条(?:第[一二三四五六七八九十]+[款项])*)*)"
    titles, lists = (F.regexp_extract_all(text, F.lit(item), i) for i in (1, 2))

    def each(pair: Column) -> Column:
        entries = F.regexp_extract_all(pair["l"], F.lit("第[一二三四五六七八九十百零〇0-9]+条"), 0)
        made = lambda e: F.struct(pair["t"].alias("title"), e.cast("string").alias("entry"))
        return F.when(F.size(entries) > 0, F.transform(entries, made)).otherwise(F.array(made(F.lit(None))))

    return F.flatten(F.transform(F.arrays_zip(titles.alias("t"), lists.alias("l")), each))
