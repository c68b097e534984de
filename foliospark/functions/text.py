"""Scalar text functions, Column to Column; all but NFKC stay in the JVM."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from foliospark.lexicon import DEFAULT, PARAMETER_PATTERN, Lexicon

TOKEN = r"([A-Z]+[0-9]+|[A-Z]+|[0-9]+|[一-鿿])"


def let(c: Column, f: Callable[[Column], Column]) -> Column:
    """f of c, with c computed once however often f names it."""
    return F.get(F.transform(F.array(c), f), F.lit(0))


def strip(c: Column) -> Column:
    """Without white space at both ends; the text is gone through only if there is some."""
    ends = lambda x: F.concat(F.substring(x, 1, 1), F.substring(x, -1, 1))
    return let(c, lambda x: F.when(ends(x).rlike(r"(?U)\s"), F.regexp_replace(x, r"(?U)^\s+|\s+$", "")).otherwise(x))


@F.pandas_udf(StringType())
def _nfkc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x))


def nfkc(c: Column) -> Column:
    """NFKC; the Python step is only taken for text beyond ASCII."""
    return F.when(c.rlike(r"^\p{ASCII}*$"), c).otherwise(_nfkc(c))


def padded(c: Column, digits: int) -> Column:
    """As %0nd gives a whole number; the formatter, which is slow, is only taken for those that need no zeros or are negative."""
    return F.when(c.between(0, 10**digits - 1), F.lpad(c.cast("string"), digits, "0")).otherwise(F.format_string(f"%0{digits}d", c))


def normalize_code(c: Column) -> Column:
    return F.regexp_replace(F.upper(c), r"(?U)[\s\-_]", "")


def may_have_code(c: Column, lex: Lexicon = DEFAULT) -> Column:
    """What each code has, and few other texts: a prefix's last two letters before a digit. Much cheaper than all prefixes."""
    some = lambda at: "[" + "".join(sorted({re.escape(p[at]) for p in lex.prefixes})) + "]"
    two = some(-2) + r"\s*" if all(len(p) > 1 for p in lex.prefixes) else ""
    return c.rlike(r"(?U)\d") & c.rlike(rf"(?iU){two}{some(-1)}\s*[-_]?\s*\d")


def code_spans(c: Column, lex: Lexicon = DEFAULT) -> Column:
    return let(c, lambda x: F.when(~may_have_code(x, lex), F.array().cast("array<string>")).otherwise(F.regexp_extract_all(x, F.lit(lex.code), F.lit(1))))


def codes(c: Column, lex: Lexicon = DEFAULT) -> Column:
    """Sorted distinct normalised codes."""
    return F.array_sort(F.array_distinct(F.transform(code_spans(c, lex), normalize_code)))


def compact_codes(c: Column, lex: Lexicon = DEFAULT) -> Column:
    """Codes as they stand in text, rewritten to their compact form."""
    return let(c, lambda x: F.aggregate(F.array_distinct(code_spans(x, lex)), x, lambda acc, s: F.replace(acc, s, normalize_code(s))))


def canonical(c: Column, lex: Lexicon = DEFAULT, unicode: bool = True) -> Column:
    c = F.coalesce(c, F.lit(""))
    c = F.upper(compact_codes(nfkc(c) if unicode else c, lex))
    # A text that has no run of blanks or line ends is left as it is, which a look for these tells at little cost.
    gaps = lambda x: F.contains(x, F.lit("  ")) | F.contains(x, F.lit("\t")) | F.contains(x, F.lit("\r")) | F.contains(x, F.lit("\f")) | F.contains(x, F.lit("\x0b"))
    c = let(c, lambda x: F.when(gaps(x), F.regexp_replace(x, r"[ \t\r\f\x0B]+", " ")).otherwise(x))
    c = let(c, lambda x: F.when(F.contains(x, F.lit("\n\n\n")), F.regexp_replace(x, r"\n{3,}", "\n\n")).otherwise(x))
    return strip(c)


def tokens(canon: Column) -> Column:
    return F.regexp_extract_all(canon, F.lit(TOKEN), F.lit(1))


def keywords(canon: Column, stop: Column) -> Column:
    return F.filter(tokens(canon), lambda t: ~F.array_contains(stop, t))


def parse_query(c: Column, lex: Lexicon = DEFAULT, unicode: bool = True) -> Column:
    """alarm_codes, keywords (tokens that aren't codes, repeats kept) and the canonical query, as a struct."""
    canon = canonical(c, lex, unicode)
    return F.struct(codes(canon, lex).alias("alarm_codes"), keywords(canon, codes(canon, lex)).alias("keywords"), canon.alias("canonical_query"))


def block_search_text(title: Column, code_list: Column, section: Column, searchable_text: Column, raw: Column) -> Column:
    """What is indexed of a block; repetition is meant, it raises term frequencies."""
    return join_filled(title, F.array_join(code_list, " "), section, searchable_text, raw)


def kb_search_text(entity_list: Column, actions: Column, section: Column, searchable_text: Column, canon: Column, raw: Column) -> Column:
    """What is indexed of a knowledge row."""
    return join_filled(F.array_join(entity_list, " "), F.array_join(actions, " "), section, searchable_text, canon, raw)


def join_filled(*cs: Column, sep: str = "\n") -> Column:
    """Join of the values that aren't blank."""
    return F.array_join(F.filter(F.array(*(F.coalesce(c, F.lit("")) for c in cs)), lambda x: F.trim(x) != ""), sep)


def searchable(title: Column, code_list: Column, section: Column, canon: Column) -> Column:
    return join_filled(title, F.array_join(code_list, " "), section, canon)


def preview(c: Column, n: int = 240) -> Column:
    return F.substring(F.coalesce(c, F.lit("")), 1, n)


def contains_any(c: Column, words: tuple[str, ...]) -> Column:
    return F.exists(F.array(*map(F.lit, words)), lambda w: F.contains(c, w))


def is_chapter(t: Column) -> Column:
    number = F.regexp_extract(t, r"^(\d+)\s+.+", 1)
    return ((number != "") & (F.length(F.ltrim(number, F.lit("0"))) >= 2)) | t.rlike(r"^附录\s*[A-Z]?\s*.+") | t.rlike(r"^第\s*\d+\s*章\s*.+")


def is_section(t: Column) -> Column:
    return t.rlike(r"^\d+\.\d+(?:\.\d+)*\s+.+") | t.rlike(r"^[A-Z]\.\d+(?:\.\d+)*\s+.+")


def is_heading(c: Column) -> Column:
    t = F.trim(c)
    return (t != "") & (F.length(t) <= 90) & (is_chapter(t) | is_section(t))


def section_path(chapter: Column, section: Column, subsection: Column | None = None) -> Column:
    return join_filled(chapter, section, *([] if subsection is None else [subsection]), sep=" > ")


def block_type(text: Column, label: Column, lex: Lexicon = DEFAULT) -> Column:
    return F.when(F.contains(F.lower(label), F.lit("table")), "table_candidate").when(text.rlike(lex.warning), "warning").when(text.rlike(lex.step), "procedure").otherwise("text")


def priority(kind: Column, lex: Lexicon = DEFAULT) -> Column:
    out = F.lit(0.5)
    for k, v in lex.priorities.items():
        out = F.when(kind == k, F.lit(v)).otherwise(out)
    return out


def optional_float(c: Column) -> Column:
    return c.try_cast("double")


def parameters(canon: Column, lex: Lexicon = DEFAULT) -> Column:
    """At least three characters with a digit; one space for each run, no punctuation at the ends."""
    # In the default grammar a digit only comes after one of these signs, so all other texts have none that counts.
    signs = lambda x: F.contains(x, F.lit("#")) | F.contains(x, F.lit("=")) | F.contains(x, F.lit("("))
    some = lambda x: x.rlike("[0-9]") & (signs(x) if lex.parameter == PARAMETER_PATTERN else F.lit(True))
    found = let(canon, lambda x: F.when(~some(x), F.array().cast("array<string>")).otherwise(F.regexp_extract_all(x, F.lit(lex.parameter), F.lit(1))))
    bare = lambda x: F.regexp_replace(F.regexp_replace(x, r"(?U)\s+", " "), "^[ ,.;:]+|[ ,.;:]+$", "")
    return F.array_sort(F.array_distinct(F.filter(F.transform(found, bare), lambda x: (F.length(x) >= 3) & x.rlike("[0-9]"))))


def components(text: Column, words: tuple[str, ...]) -> Column:
    return let(F.lower(text), lambda low: F.array_compact(F.array(*(F.when(F.contains(low, F.lower(F.lit(w))), F.lit(w)) for w in words))))


def entities(canon: Column, lex: Lexicon = DEFAULT) -> Column:
    return F.array_sort(F.array_union(F.array_union(codes(canon, lex), parameters(canon, lex)), components(canon, lex.components)))


def entity_kind(e: Column, lex: Lexicon = DEFAULT) -> Column:
    """By the first two characters and a digit."""
    return F.when(F.substring(e, 1, 2).isin(*lex.prefixes) & e.rlike("[0-9]"), "alarm_code").when(e.rlike("[0-9]"), "parameter").otherwise("component")
