"""Text: tokens, keyword normalising, names, and the formats of report cells."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import words as W

#: Tokens of lexical search: runs of two or more Hangul syllables, ASCII letters or digits.
TOKEN = "([가-힣a-zA-Z0-9]{2,})"
#: What separates words in free input. Java's \w is ASCII only, so the classes are spelled out.
SEPARATORS = r"[^\p{L}\p{M}\p{N}_]+"


def _any(values) -> str:
    return "|".join(re.escape(v) for v in values)


def cell(c: Column) -> Column:
    """A cell as text: trimmed, null as empty."""
    return F.coalesce(F.trim(c.cast("string")), F.lit(""))


def strip(c: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(F.coalesce(c, F.lit("")), r"^\s+|\s+$", "")


def safe_cell(c: Column) -> Column:
    """As cell, with the words nan, none and null (any case) as empty."""
    t = cell(c)
    return F.when(F.lower(t).isin("nan", "none", "null"), "").otherwise(t)


def norm_id(c: Column) -> Column:
    """An id without a trailing .0 left by a numeric column."""
    return F.regexp_replace(cell(c), r"^(\d+)\.0$", "$1")


def tokens(c: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(TOKEN), F.lit(1))


def simple_tokens(c: Column) -> Column:
    """Distinct tokens, case kept."""
    return F.array_distinct(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(TOKEN), F.lit(1)))


def is_meaningless_code(c: Column) -> Column:
    """All digits, or five and more ASCII letters and digits with both; never with Hangul."""
    mixed = c.rlike("^[A-Za-z0-9]{5,}$") & c.rlike("[A-Za-z]") & c.rlike("[0-9]")
    return ~c.rlike("[가-힣]") & (c.rlike(r"^\p{Nd}+$") | mixed)


def _is_filler(t: Column, connectives: bool = True) -> Column:
    words = list(W.STOP_WORDS) + (list(W.CONNECTIVES) if connectives else [])
    return F.lower(t).isin(words)


def noun_keywords(c: Column, profile: str = "full") -> Column:
    """Free input as noun keywords, in order: split; drop short words, fillers and codes; strip trade suffix and particle;
    drop conjugated stop words. profile 'viewer' has no connectives, particles or verb endings."""
    full = profile == "full"
    # The suffixes stand with longer ones first, so a lazy stem before one alternative takes the same suffix as a search in order.
    stem = lambda w: F.regexp_replace(w, f"^(.+?)({_any(W.TRADE_SUFFIXES)})$", "$1")
    particle = lambda w: F.regexp_replace(w, f"^(.{{2,}}?)({_any(W.PARTICLES)})$", "$1")
    verb = f"^({_any(W.STOP_WORDS)})({_any(W.VERB_ENDINGS)})$"
    words = F.filter(F.split(F.coalesce(c, F.lit("")), SEPARATORS), lambda w: (F.length(w) >= 2) & ~_is_filler(w, full) & ~is_meaningless_code(w))
    words = F.transform(words, lambda w: particle(stem(w)) if full else stem(w))
    return F.filter(words, lambda w: (F.length(w) >= 2) & ~_is_filler(w, full) & (~F.lower(w).rlike(verb) if full else F.lit(True)))


def folded(c: Column) -> Column:
    """A text as a key that is blind to case: joins, groups, windows and distinct of such a column take Straße, STRASSE and
    strasse for one. ß becomes ss, as in case folding; the rest is decided by the collation (UNICODE_CI, the root order of
    Unicode at its second level: ligatures are their letters, accents tell words apart)."""
    return F.collate(F.replace(F.replace(c, F.lit("ß"), F.lit("ss")), F.lit("ẞ"), F.lit("SS")), "UNICODE_CI")


def norm_name(c: Column) -> Column:
    """A company name without legal forms and white space, in lower case."""
    return F.lower(F.regexp_replace(F.regexp_replace(F.coalesce(c, F.lit("")), _any(W.LEGAL_FORMS), ""), r"\s+", ""))


def short_name(c: Column) -> Column:
    """A company name without spaces and the commonest legal forms, case kept."""
    out = cell(c)
    for form in W.COMMON_LEGAL_FORMS:
        out = F.replace(out, F.lit(form), F.lit(""))
    return out


def clean_tail(t: Column) -> Column:
    """A Korean token without a particle at its end, one syllable or two; two syllables at least stay."""
    return F.when(t.rlike("[가-힣]"), F.regexp_replace(t, f"^(.{{2,}}?)({_any(W.TAIL_PARTICLES)})$", "$1")).otherwise(t)


def squeeze(c: Column) -> Column:
    """Without any white space."""
    return F.regexp_replace(F.coalesce(c, F.lit("")), r"\s+", "")


def fix_spacing(c: Column) -> Column:
    """A space after a sentence's period where it lacks; decimals and versions stay."""
    return F.regexp_replace(F.coalesce(c, F.lit("")), W.SENTENCE_GAP, "$1. ")


def html_escape(c: Column) -> Column:
    out = F.coalesce(c, F.lit(""))
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ("\n", "<br/>")):
        out = F.replace(out, F.lit(raw), F.lit(safe))
    return out


def dash(c: Column) -> Column:
    return F.coalesce(F.nullif(cell(c), F.lit("")), F.lit("-"))


def yes_no(c: Column) -> Column:
    t = F.upper(safe_cell(c))
    return F.when(t.isin("Y", "YES", "1", "TRUE", "T"), "Y").when(t.isin("N", "NO", "0", "FALSE", "F"), "N").otherwise("")


def ratio_bucket(c: Column) -> Column:
    """1, 5, 10 or 20; anything else null."""
    v = c.try_cast("int")
    return F.when(v.isin(1, 5, 10, 20), v)


def date_cell(c: Column) -> Column:
    """YYYYMMDD as Y.M.D; month or day 00 are left out; other values as they are."""
    t = F.regexp_replace(F.split_part(cell(c), F.lit("."), F.lit(1)), "-", "")
    y, m, d = F.substring(t, 1, 4), F.substring(t, 5, 2), F.substring(t, 7, 2)
    return F.when(~t.rlike(r"^\d{8}$"), cell(c)).when(m == "00", y).when(d == "00", F.concat_ws(".", y, m)).otherwise(F.concat_ws(".", y, m, d))


def money_cell(c: Column) -> Column:
    """Won as 억원 (one decimal), 만원 or 원; text that is no number as it is, blank as '-'."""
    t = F.regexp_replace(cell(c), r"\.0$", "")
    w = t.try_cast("double")
    # format_number rounds halves to even, as the cells want.
    return F.when(w.isNull(), F.coalesce(F.nullif(t, F.lit("")), F.lit("-"))).when(w >= 1e8, F.concat(F.regexp_replace(F.format_number(w / 1e8, 1), ",", ""), F.lit("억원"))).when(w >= 1e4, F.concat(F.format_number(w / 1e4, 0), F.lit("만원"))).otherwise(F.concat(F.format_number(w, 0), F.lit("원")))


def country_name(c: Column) -> Column:
    names = F.create_map(*[F.lit(x) for kv in W.COUNTRIES.items() for x in kv])
    return F.coalesce(F.try_element_at(names, F.upper(cell(c))), cell(c))


def period_years(c: Column) -> Column:
    """Start and end year of a description, or its first year; array of one or two, null without a year."""
    start, end, first = F.regexp_extract(c, W.PERIOD, 1), F.regexp_extract(c, W.PERIOD, 2), F.regexp_extract(c, W.FIRST_YEAR, 1)
    return F.when(start != "", F.array_distinct(F.array(start, end))).when(first != "", F.array(first))


def period_cell(c: Column) -> Column:
    return F.array_join(F.transform(period_years(c), lambda y: F.concat(y, F.lit("년"))), " ~ ")


def year_lines(c: Column) -> Column:
    """The years of a description as lines of a narrow cell: `start ~` and `end`, one year, or empty."""
    y = period_years(c)
    return F.when(y.isNull(), "").when(F.size(y) == 1, F.get(y, F.lit(0))).otherwise(F.concat(F.get(y, F.lit(0)), F.lit(" ~\n"), F.get(y, F.lit(1))))


def is_present(c: Column) -> Column:
    """A value that is there: not null, not blank and none of the words nan and None."""
    return F.coalesce(~cell(c).isin("", "nan", "None"), F.lit(False))


def number_of(c: Column) -> Column:
    """A text key as a number to sort by, null where it is none."""
    return F.trim(c).try_cast("long")


def subject_class(c: Column) -> Column:
    """The field a description says it belongs to: the first valid of several phrasings."""
    found = []
    for p in W.SUBJECT_PHRASES:
        v = F.trim(F.rtrim(F.trim(F.regexp_extract(c, p, 1)), F.lit(".")))
        v = F.trim(F.btrim(F.regexp_replace(v, r"\s*\.\s*", "·"), F.lit("·")))
        found.append(F.when(F.length(v).between(2, 25) & ~v.rlike(W.NO_SUBJECT), v))
    return F.coalesce(*found)


def strip_source_tag(c: Column) -> Column:
    return F.regexp_replace(c, W.SOURCE_TAG, "")


def strip_think(c: Column) -> Column:
    return F.regexp_replace(c, r"(?s)<think>.*?</think>\s*", "")


def first_line(c: Column) -> Column:
    """First line without quotes around it."""
    return F.btrim(F.trim(F.split_part(F.trim(c), F.lit("\n"), F.lit(1))), F.lit("\"'"))


def scrub_absence(c: Column) -> Column:
    """Without the sentences that tell of missing information; as it was if nothing would be left."""
    kept = F.trim(F.array_join(F.filter(F.split(c, r"(?<=[다요]\.)"), lambda s: ~s.rlike(W.ABSENCE)), ""))
    return F.when(~c.rlike(W.ABSENCE), c).otherwise(F.coalesce(F.nullif(kept, F.lit("")), c))


def chat_prompt(messages: Column) -> Column:
    """Messages (role, content) as a prompt with the assistant's turn open."""
    known = F.filter(messages, lambda m: m["role"].isin("system", "user", "assistant"))
    lines = F.transform(known, lambda m: F.concat(F.lit("<|im_start|>"), m["role"], F.lit("\n"), F.trim(m["content"]), F.lit("<|im_end|>")))
    return F.array_join(F.concat(lines, F.array(F.lit("<|im_start|>assistant\n"))), "\n")
