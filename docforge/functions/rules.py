"""Fields of a judgment's header by ordered patterns, as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from docforge.functions import vocab as V
from docforge.functions.text import IGNORE, folded, has_any, has_hint, let, squeeze, strip_chars


def first_match(c: Column, patterns: list[str]) -> Column:
    """Group 1 of the first pattern that occurs; none of the patterns' groups can be empty."""
    return F.coalesce(*(none_if_empty(F.regexp_extract(c, IGNORE + p, 1)) for p in patterns))


def hinted(c: Column, low: Column | None, body: Callable[[Column, Column], Column]) -> Column:
    """``body`` of a text and of it in folded case, in which hints are looked for: ``low`` if it is there already."""
    return let(c, lambda t: let(folded(t), lambda k: body(t, k))) if low is None else body(c, low)


def first_hinted(c: Column, low: Column, patterns: list[str], hints: list[tuple[str, ...]]) -> Column:
    """``first_match``, each pattern sought only where one of its hints stands."""
    return F.coalesce(*(F.when(has_hint(low, *some), none_if_empty(F.regexp_extract(c, IGNORE + p, 1))) for p, some in zip(patterns, hints, strict=True)))


def none_if_empty(c: Column) -> Column:
    return let(c, lambda x: F.when(x != "", x))


def format_date(day: Column, month: Column, year: Column) -> Column:
    """dd/mm/yyyy if day and month are in range; whether the day exists is for the validator."""
    padded = lambda n: F.lpad(n.cast("string"), 2, "0")
    return let(day.try_cast("int"), lambda d: F.when(d.between(1, 31), let(month.try_cast("int"), lambda m: F.when(m.between(1, 12), F.concat_ws("/", padded(d), padded(m), year)))))


def parse_date(c: Column) -> Column:
    """The long form if it occurs, else day, month and year between slashes or hyphens."""
    parts = lambda p: format_date(*(F.regexp_extract(c, IGNORE + p, k) for k in (1, 2, 3)))
    return F.when(F.rlike(c, F.lit(IGNORE + V.DATE_LONG)), parts(V.DATE_LONG)).otherwise(parts(V.DATE_SHORT))


def valid_date(c: Column) -> Column:
    return F.coalesce(F.rlike(c, F.lit(r"^\d{2}/\d{2}/\d{4}$")) & F.try_to_date(c, "dd/MM/yyyy").isNotNull(), F.lit(False))


def docket_number(c: Column, low: Column | None = None) -> Column:
    found = hinted(c, low, lambda t, k: first_hinted(t, k, V.DOCKET, [V.DOCKET_HINTS] * len(V.DOCKET)))
    return strip_chars(F.regexp_replace(found, r"\s+", ""), " .;:")


def docket_date(c: Column, low: Column | None = None) -> Column:
    near = lambda t: F.regexp_extract(t, rf"(?ius){V.DOCKET_LABEL}.{{0,180}}?(ngày\s+\d{{1,2}}\s+tháng\s+\d{{1,2}}\s+năm\s+\d{{4}}|\d{{1,2}}[/-]\d{{1,2}}[/-]\d{{4}})", 1)
    long = rf"{IGNORE}\b{V.DATE_LONG}"
    whole = lambda t: let(F.regexp_extract(t, long, 0), lambda d: F.when(d != "", parse_date(d)))
    first = lambda t, k: F.when(has_hint(k, *V.DOCKET_HINTS), let(near(t), lambda d: F.when(d != "", parse_date(d))))
    then = lambda t, k: F.when(has_hint(k, *V.DATE_HINTS), whole(t))
    return hinted(c, low, lambda t, k: let(F.coalesce(first(t, k), F.lit("")), lambda d: F.when(d != "", d).otherwise(then(t, k))))


def case_type(c: Column, low: Column | None = None) -> Column:
    def named(t: Column, k: Column) -> Column:
        out = F.when(F.lit(False), "")
        for (pattern, name), some in zip(V.CASE_TYPES, V.CASE_TYPE_HINTS, strict=True):
            out = out.when(has_hint(k, *some) & F.rlike(t, F.lit(IGNORE + pattern)), name)
        return out

    return hinted(c, low, named)


def legal_relation(c: Column, low: Column | None = None) -> Column:
    return strip_chars(squeeze(hinted(c, low, lambda t, k: first_hinted(t, k, V.RELATIONS, V.RELATION_HINTS))), " .;:\"'“”")


def clean_name(c: Column) -> Column:
    c = strip_chars(squeeze(F.regexp_replace(c, r"\([^)]*\)", "")), " ,.;:-")
    return F.regexp_replace(c, IGNORE + V.HONORIFIC, "")


def judge(c: Column, low: Column | None = None) -> Column:
    return clean_name(hinted(c, low, lambda t, k: first_hinted(t, k, V.JUDGES, [V.JUDGE_HINTS] * len(V.JUDGES))))


def looks_like_name(c: Column, strict: bool = False) -> Column:
    """5 characters, no digit, 2 to 8 words; with ``strict`` without phrases of attendance or arrest."""
    ok = (F.char_length(c) >= 5) & ~F.rlike(c, F.lit(r"\d")) & F.size(F.split(c, " ")).between(2, 8)
    return ok & ~F.rlike(c, F.lit(IGNORE + r"\b(?:" + "|".join(V.NOT_A_NAME) + r")\b")) if strict else ok


def person_name(c: Column, strict: bool = False) -> Column:
    head = F.regexp_replace(F.regexp_replace(c, "(?ius)" + V.NAME_END + ".*$", ""), "(?s)[;,].*$", "")  # a split would compile its pattern for each value
    head = F.regexp_replace(F.regexp_replace(head, IGNORE + V.NAME_LEAD, ""), r"^\s*\d+\s*[.)-]\s*", "")
    shaped = lambda: let(clean_name(F.regexp_extract(c, V.NAME_SHAPE, 1)), lambda x: F.when(looks_like_name(x, strict), x))
    return let(clean_name(head), lambda x: F.when(looks_like_name(x, strict), x).otherwise(shaped()))


def birth_year(c: Column) -> Column:
    return first_match(c, V.BIRTH_YEARS)


def identity_number(c: Column) -> Column:
    return none_if_empty(F.regexp_replace(F.regexp_extract(c, IGNORE + V.IDENTITY, 1), r"\D", ""))


def address(c: Column) -> Column:
    tail = F.trim(F.regexp_extract(c, IGNORE + V.ADDRESS_LABEL + r"\s*[:：]?\s*(.+)$", 1))
    return none_if_empty(strip_chars(squeeze(F.regexp_replace(tail, "(?ius)" + V.ADDRESS_STOP + ".*$", "")), " .;:-"))


def canonical_role(label: Column) -> Column:
    """The name of the first entry of ROLE_NAMES that stands in the label; else the label."""
    key = F.lower(squeeze(label))
    named = lambda k: F.coalesce(*(F.when(F.contains(k, F.lit(part)), name) for part, name in V.ROLE_NAMES), F.trim(label))
    return let(key, named)


def role_blocks(c: Column, label: str = V.ROLE_LABEL) -> Column:
    """Array of (role label, text up to the next label); blocks without text are dropped."""
    pattern, start, end = IGNORE + label + r"\s*[:：]?", "\ue000", "\ue001"
    labels = lambda t: F.regexp_extract_all(t, F.lit(IGNORE + "(" + label + r")\s*[:：]?"), F.lit(1))
    texts = lambda t: F.transform(let(F.split(t, pattern, -1), lambda t: F.slice(t, F.lit(2), F.greatest(F.size(t) - 1, F.lit(0)))), lambda t: strip_chars(t, " :：\n\t"))
    apart = lambda t: F.zip_with(labels(t), texts(t), lambda a, b: F.struct(a.alias("label"), b.alias("text")))
    # in one pass, as a split would compile its pattern for each text
    pieces = lambda t: let(F.split(F.regexp_replace(t, IGNORE + "(" + label + r")\s*[:：]?", f"{start}$1{end}"), start, -1), lambda x: F.slice(x, F.lit(2), F.greatest(F.size(x) - 1, F.lit(0))))
    marked = lambda t: F.transform(pieces(t), lambda x: F.struct(F.substring_index(x, end, 1).alias("label"), strip_chars(F.substring_index(x, end, -1), " :：\n\t").alias("text")))
    blocks = lambda t: F.filter(F.when(has_any(t, start, end), apart(t)).otherwise(marked(t)), lambda b: b["text"] != "")
    if label != V.ROLE_LABEL:
        return blocks(c)
    none = F.array().cast("array<struct<label:string,text:string>>")
    return hinted(c, None, lambda t, k: F.when(~has_hint(k, *V.ROLE_HINTS), none).otherwise(blocks(t)))


def people(block: Column) -> Column:
    """The numbered items of a block if there are several, else the block."""

    def of(block: Column) -> Column:
        whole = F.filter(F.array(F.btrim(block, F.lit(" \n\t"))), lambda x: x != "")
        items = F.filter(F.transform(F.split(block, V.LIST_ITEM, -1), lambda x: F.btrim(x, F.lit(" \n\t"))), lambda x: x != "")
        several = let(items, lambda found: F.when(F.size(found) > 1, found).otherwise(whole))
        return F.when(F.rlike(block, F.lit(V.LIST_ITEM)), several).otherwise(whole)

    return let(F.regexp_replace(block, IGNORE + V.LIST_LEAD, ""), of)


def party(role: Column, text: Column, strict: bool = False) -> Column:
    raw = F.regexp_replace(strip_chars(squeeze(text), " .;:-"), IGNORE + V.PARTY_LEAD, "")
    return let(raw, lambda r: F.struct(
        role.alias("tu_cach_to_tung"), person_name(r, strict).alias("ho_ten"), birth_year(r).alias("nam_sinh"),
        identity_number(r).alias("cccd"), address(r).alias("dia_chi"), r.alias("raw_text"),
    ))


def parties(c: Column, strict: bool = False) -> Column:
    """Array of parties in the order of their labels."""
    found = F.flatten(F.transform(role_blocks(c), lambda b: let(canonical_role(b["label"]), lambda role: F.transform(people(b["text"]), lambda t: party(role, t, strict)))))
    return F.filter(found, lambda p: p["ho_ten"].isNotNull() | (p["raw_text"] != ""))


def case_info(c: Column) -> Column:
    return hinted(c, None, lambda t, low: F.struct(
        case_type(t, low).alias("loai_an"), docket_number(t, low).alias("so_thu_ly"), docket_date(t, low).alias("ngay_thu_ly"),
        legal_relation(t, low).alias("quan_he_phap_luat"), judge(t, low).alias("chu_toa"),
    ))
