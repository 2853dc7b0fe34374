"""Dates in many notations."""

from __future__ import annotations

from datetime import UTC, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

_SEPARATED = r"^\s*(\d{4})\s*[-/.年]\s*(\d{1,2})\s*[-/.月]\s*(\d{1,2})\s*日?(?:[\sT].*)?$"
_PACKED = r"^\s*(\d{4})(\d{2})(\d{2})\s*$"


def lenient_date(text: Column) -> Column:
    """DATE of ``2013-09-04``, ``2013/9/4``, ``2013.09.04``, ``20130904``, ``2013年9月4日``,
    each also with a time behind it; null for partial, impossible and other values."""

    def made(pattern: str) -> Column:
        y, m, d = (F.regexp_extract(text, pattern, i) for i in (1, 2, 3))
        return F.try_to_timestamp(F.concat_ws("-", y, F.lpad(m, 2, "0"), F.lpad(d, 2, "0")), F.lit("yyyy-MM-dd")).cast("date")

    return F.when(text.rlike(_SEPARATED), made(_SEPARATED)).when(text.rlike(_PACKED), made(_PACKED))


def china_date(epoch_ms: Column) -> Column:
    """DATE at UTC+8 of an epoch in milliseconds."""
    return F.date_add(F.lit("1970-01-01").cast("date"), F.floor((epoch_ms + F.lit(8 * 3600 * 1000)) / F.lit(86400000)).cast("int"))


def published(date: Column, url: Column) -> Column:
    """Publication date as text (DAT-04): the ISO beginning of a date, else ``tYYYYMMDD_`` in the
    address, else the value as it stands."""
    packed = F.regexp_extract(url, r"t((?:19|20)\d{2})(\d{2})(\d{2})_", 0)
    part = lambda i: F.regexp_extract(url, r"t((?:19|20)\d{2})(\d{2})(\d{2})_", i)
    return F.when(date.rlike(r"^\d{4}-\d{2}-\d{2}"), F.substring(date, 1, 10)).when(F.length(packed) > 0, F.concat_ws("-", part(1), part(2), part(3))).otherwise(date)


def effective(text: Column, stated: Column, version: Column, published_on: Column, days: int = 3) -> Column:
    """Date from which a text holds (DAT-03), of its compact text.

    The last clause that names a date from which it holds; a stated date more than ``days``
    away wins over it. Else, where it holds from its publication, the date of its version
    (eight digits), else of its publication, under the same rule. Else the stated date.
    """
    named = F.regexp_extract_all(text, F.lit(r"自((?:19|20)\d{2}年\d{1,2}月\d{1,2}日)起(?:施行|实施|生效|执行)"), 1)
    clause = F.try_element_at(F.filter(F.transform(named, lenient_date), lambda d: d.isNotNull()), F.lit(-1))
    at_once = F.when(text.rlike("自(?:公布|发布|印发)之日起(?:施行|实施|生效|执行)"), F.coalesce(F.when(version.rlike(r"^\d{8}$"), lenient_date(version)), published_on))
    near = lambda d: F.when(stated.isNotNull() & (F.abs(F.datediff(stated, d)) > days), stated).otherwise(d)
    return F.when(clause.isNotNull(), near(clause)).when(at_once.isNotNull(), near(at_once)).otherwise(stated)


def as_of_date(day: str | None = None) -> str:
    """The day that ages and states refer to (DAT-05): ``day``, else today at UTC+8."""
    return day or (datetime.now(UTC) + timedelta(hours=8)).date().isoformat()
